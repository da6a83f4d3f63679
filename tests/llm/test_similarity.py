import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from newstide.llm import ngram_join as J
from newstide.llm.decontaminate import leak_digest, without_leaks
from newstide.llm.links import components


def brute_groups(rows, words, num, den):
    sets = {}
    for doc, text in rows:
        found = (text or "").encode().lower().split()
        grams = {tuple(found[k : k + words]) for k in range(len(found) - words + 1)}
        sets[doc] = grams if len(found) >= words else ({tuple(found)} if found else set())
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, shared = defaultdict(list), Counter()
    for doc, grams in sets.items():
        for gram in grams:
            holders[gram].append(doc)
    for docs in holders.values():
        shared.update((a, b) for i, a in enumerate(docs) for b in docs[:i])
    for (a, b), k in shared.items():
        if den * k >= num * (len(sets[a]) + len(sets[b]) - k):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {doc: (len(sets[doc]), root(doc)) for doc in sets}


def groups(df, **limits):
    found = J.similar_groups(df, limits=J.JoinLimits(table=14, **limits)).collect()
    return {r.doc: (r.n_shingles, r.component_id) for r in found}, len(found)


def boilerplate_corpus(n=160):
    """Families of near copies, and passages that most documents share."""
    rng = random.Random(1)
    words = [f"v{i}" for i in range(3000)]
    passages = [[rng.choice(words) for _ in range(45)] for _ in range(3)]
    bases = [[rng.choice(words) for _ in range(rng.choice([8, 60, 75, 130, 300]))] for _ in range(12)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            text[rng.randrange(len(text))] = rng.choice(words)
        for p in passages:
            if rng.random() < 0.7:
                text += p
        if rng.random() < 0.3:
            text = passages[0] + passages[1] + [rng.choice(words) for _ in range(rng.randrange(12))]
        rows.append((i, " ".join(text), "en", "a"))
    return rows


@pytest.mark.parametrize("few,cell", [(32, 1024), (0, 7), (4, 20)])
def test_components_equal_brute_force(documents, few, cell):
    rows = boilerplate_corpus()
    expected = brute_groups([r[:2] for r in rows], 4, 85, 100)
    assert groups(documents(rows), few=few, cell=cell)[0] == expected
    assert len({c for _, c in expected.values()}) < len(expected) - 20


def test_awkward_rows(documents, awkward):
    found, count = groups(documents(awkward))
    assert found == brute_groups([r[:2] for r in awkward], 4, 85, 100)
    assert count == len(awkward)
    assert found[4] == found[5][:1] + (4,)  # A-Z are lower-cased
    assert found[1] == (0, 1) and found[3] == (0, 3)
    assert found[9][1] == 7


def test_empty_table(documents, spark):
    assert groups(documents([(1, "x", "en", "a")]).limit(0)) == ({}, 0)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(documents, awkward):
    df = documents(awkward)
    kept = J.one_of_each(df, J.JoinLimits(words=5, num=80, table=14))
    expected = brute_groups([r[:2] for r in awkward], 5, 80, 100)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in expected.items() if c == d)
    assert kept.columns == df.columns


def test_rows_that_share_an_id_or_have_none_stand_for_themselves(documents):
    words = [f"w{i}" for i in range(400)]
    a, b, c, d, e = (" ".join(words[k : k + 60]) for k in range(0, 350, 70))
    rows = [(5, a), (5, b), (7, d), (8, d), (8, e), (None, c), (None, c), (None, a), (None, "only one"), (None, None), (9, None)]
    kept = J.one_of_each(documents([(i, t, "en", "s") for i, t in rows]), J.JoinLimits(words=5, num=80, table=14))
    found = sorted(repr((r.doc_id, r.text)) for r in kept.collect())
    assert found == sorted(map(repr, [(5, a), (5, b), (7, d), (8, e), (None, c), (None, "only one"), (None, None), (9, None)]))
    assert J.one_of_each(documents([])).count() == 0


def test_similar_sets_share_a_signature_whatever_their_classes():
    rng = np.random.default_rng(3)
    limits = J.JoinLimits()
    for size in (3, 20, 63, 64, 70, 76, 200, 255, 260, 300, 1100):
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            changed = int(size * 0.15 / 2)
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 1 << 63, changed, dtype=np.uint64)]))
            overlap = len(np.intersect1d(a, b))
            if 100 * overlap < 85 * (len(a) + len(b) - overlap):
                continue
            classes = {x: int(x) % 3 if rng.random() < 0.5 else 2 for x in set(a.tolist()) | set(b.tolist())}
            marks = [J.signatures(x, np.array([classes[t] for t in x.tolist()]), limits) for x in (a, b)]
            assert len(np.intersect1d(*marks)), size


def test_bounds():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (5, 100, 3000, 20000)]
    sets.append(np.unique(np.concatenate([sets[1], sets[2][:1500]])))
    exact = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    hists = [J.histogram(x).astype("<u4").tobytes() for x in sets]
    for i, row in enumerate(exact):
        for j, overlap in enumerate(row):
            assert J.overlap_bound(hists[i], hists[j]) >= overlap
    found = J.shared_tokens(sets, 999)
    assert all(found[i][j] == exact[i][j] for i in range(5) for j in range(5) if i != j)


def test_chains_get_one_component(spark, rows):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 102), (101, 102), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert rows(found) == [(i, 1) for i in range(1, 41)] + [(i, 100) for i in (100, 101, 102)]


def test_leaks(documents, spark, awkward, rows):
    item = " ".join(f"q{i}" for i in range(30))
    part = " ".join(f"q{i}" for i in range(26))  # 22 of 26 shingles
    less = " ".join(f"q{i}" for i in range(24))  # 20 of 26
    long = dict((r[0], r[1]) for r in awkward)[6]
    extra = [
        (200, f"{long} {item.upper()}, {long}", "en", "a"), (201, f"x {part} y", "en", "a"), (202, f"x {less} y", "en", "a"),
        (203, item.replace(" ", " -- "), "en", "a"), (203, item.replace(" ", " -- "), "en", "a"), (None, item, "en", "a"),
    ]
    items = spark.createDataFrame(
        [(0, item, 1), (0, item, 1), (1, None, 2), (2, "one two", 3), (3, "", 4)], "item_id long, text string, shared int"
    )
    df = documents(awkward + extra)
    assert rows(leak_digest(df, items)) == [
        (None, 0, 26, 26), (4, 2, 1, 1), (5, 2, 1, 1), (200, 0, 26, 26), (201, 0, 26, 22), (203, 0, 26, 26),
    ]
    left = without_leaks(df, items)
    assert left.columns == df.columns
    assert left.count() == df.count() - 7
    assert without_leaks(df, items.limit(0)).count() == df.count()
    assert leak_digest(df.limit(0), items).count() == 0
