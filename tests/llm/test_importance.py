import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest

from newstide.llm import importance as I

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORDS.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [crc32(g.encode()) % 10_000 for g in grams]


def brute(docs, target):
    """(id, features, weight, score, rank) by the definition; ties to the smaller id, NULL last."""
    found = [(doc, *features(text)) for doc, text in docs]
    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [f for _, _, f in found]), (t, [features(x)[1] for x in target])):
        for bucket in (b for f in texts for b in f):
            counts[bucket] += 1
    gains = [
        math.floor(1000 * math.log((b + 1.0) * (sum(s) + 10_000.0) / ((a + 1.0) * (sum(t) + 10_000.0))))
        for a, b in zip(s, t)
    ]
    rows = []
    for doc, n, f in found:
        weight = sum(gains[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = [r for r in rows if r[1] >= 20]
    fit.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2]))
    drawn = len(fit) * 5 // 100
    ranks = {id(r): i + 1 for i, r in enumerate(fit[:drawn])}
    return [(r[0], *r[2:], ranks.get(id(r))) for r in rows]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v or 0) for v in r))


@pytest.fixture
def corpus(awkward):
    rng = random.Random(11)
    words = [f"t{i}" for i in range(60)]
    more = [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(10, 60))), "en", "a") for i in range(150)]
    more += [(None, more[0][1], "en", "a"), (None, more[1][1], None, None), (107, more[3][1], "en", "a")]
    return awkward + more, [(1, " ".join(words[:30])), (2, None), (3, "T1 t2, t3! t4"), (4, "")]


def test_digest_is_exact(spark, documents, corpus):
    docs, items = corpus
    target = spark.createDataFrame(items, "item_id long, text string")
    found = I.resample_digest(documents(docs), target)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    expected = brute([(d[0], d[1]) for d in docs], [x for _, x in items])
    assert ordered(found.collect()) == ordered(expected)
    assert sum(r[4] is not None for r in expected) > 5


def test_empty_tables(spark, documents, corpus):
    docs, items = corpus
    target = spark.createDataFrame(items, "item_id long, text string")
    assert I.resample_digest(documents(docs).limit(0), target).count() == 0
    found = I.resample_digest(documents(docs[:20]), target.limit(0)).collect()
    assert ordered(found) == ordered(brute([(d[0], d[1]) for d in docs[:20]], []))


def test_drawn_documents_keep_their_columns(spark, documents, corpus):
    docs, items = corpus
    target = spark.createDataFrame(items, "item_id long, text string")
    table = documents(docs).withColumnRenamed("size", "Weight").withColumnRenamed("node", "_part")
    drawn = I.resample(table, target).collect()
    expected = {r[4]: (r[0], r[2]) for r in brute([(d[0], d[1]) for d in docs], [x for _, x in items]) if r[4]}
    assert {r["rank"]: (r.doc_id, r.weight) for r in drawn} == expected
    assert all(r.text in [d[1] for d in docs if d[0] == r.doc_id] and r.shard == "x" for r in drawn)
    assert I.resample(table.limit(3), target).count() == 0


def test_pieces_of_a_text_count_like_the_whole():
    rng = random.Random(4)
    text = "".join(rng.choice("abZ9 .é\n") for _ in range(5000)).encode()
    whole = I.bucket_counts(text, I.ImportanceLimits())
    for piece in (1, 2, 7, 100):
        cut = I.bucket_counts(text, I.ImportanceLimits(piece=piece))
        assert cut[0] == whole[0] and (cut[1] == whole[1]).all()
    assert whole[1].sum() == len(features(text.decode())[1])


@pytest.mark.parametrize("buckets", [1, 63, 64, 65, 1000])
def test_bit_slices_give_the_scalar_product(buckets):
    rng = np.random.default_rng(buckets)
    for top in (1, 2, 1000, 1 << 40):
        counts, gains = rng.integers(0, top, buckets), rng.integers(-5000, 5000, buckets)
        assert I.GainPlanes.of(gains.tolist()).weight(counts) == int((counts * gains).sum())
