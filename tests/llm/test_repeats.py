import hashlib
import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from newstide.llm import suffix_dedup as S


def brute(rows, length=50):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone, strings = bytearray(len(data)), [data[k : k + length] for k in range(len(data) - length + 1)]
        for k, s in enumerate(strings):
            if s in seen:
                gone[k : k + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out[doc] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
        seen.update(strings)
    return out


def corpus():
    rng = random.Random(2)
    letters = "abcdefgh é"
    passages = ["".join(rng.choice(letters) for _ in range(n)) for n in (49, 50, 51, 90, 400)]
    rows = [(1, None), (2, ""), (3, passages[1]), (4, passages[1]), (5, "a" * 49), (6, "a" * 120), (7, "a" * 70), (8, "ab" * 300)]
    for i in range(60):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(200)))
        for p in passages:
            if rng.random() < 0.4:
                at = rng.randrange(len(text) + 1)
                text = text[:at] + p + text[at:]
        rows.append((10 + i, text))
    rows += [(100, rows[20][1]), (101, rows[20][1] + "x"), (102, "".join(rng.choice(letters) for _ in range(90_000)) + passages[4])]
    return rows


@pytest.mark.parametrize("hot,chunk", [(1000, 4 << 20), (1, 2000)])
def test_equal_to_brute_force(documents, hot, chunk):
    rows = corpus()
    df = documents([(i, t, "en", "a") for i, t in rows])
    found = S.remove_repeats(df, limits=S.RepeatLimits(hot=hot, chunk_bytes=chunk)).collect()
    got = {
        r.doc: (r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
        for r in found
    }
    assert got == brute(rows)
    assert len(found) == len(rows)


def test_digest_repeated_rows_and_empty(documents, awkward):
    df = documents([*awkward, (None, awkward[6][1], "en", "a")])
    found = S.repeat_digest(df).collect()
    assert len(found) == len(awkward) + 1
    rows = list(dict(r[:2] for r in awkward).items()) + [(None, awkward[6][1])]
    expected = brute(rows)
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id] for r in found)
    assert S.repeat_digest(df.limit(0)).count() == 0


def test_merge_sort_orders_suffixes_within_groups():
    rng = np.random.default_rng(1)
    rows = rng.integers(97, 99, (500, 50), dtype=np.uint8)
    rows[100:140] = rows[7]
    group = np.sort(rng.integers(0, 9, 500))
    order = S.merge_sorted(S.Suffixes(rows, S.Powers()), group)
    assert sorted(order) == list(range(500))
    keys = [(group[i], rows[i].tobytes()) for i in order]
    assert keys == sorted(keys)


def test_a_colliding_hash_does_not_pass(monkeypatch):
    """With a hash under which letters look alike, the bytes decide."""
    monkeypatch.setattr(S, "_LETTER", np.ones(256, np.uint64))
    limits = S.RepeatLimits()
    rng = np.random.default_rng(2)
    bodies = rng.integers(97, 100, (40, limits.window - 1 + limits.length), dtype=np.uint8)
    bodies[20:30] = bodies[:10]
    masks = np.full(40, (1 << limits.window) - 1, np.uint64)
    docs = np.arange(40)
    answer = S.repeated_strings(np.zeros(40, np.uint64), bodies, masks, docs, limits, S.Powers())
    assert (answer[20:30] == masks[0]).all() and not answer[:20].any() and not answer[30:].any()


def test_rows_that_share_an_id_or_have_none(documents):
    """Rows of one id, NULL included, are none earlier than the other and keep to themselves."""
    rng = random.Random(9)
    one, two, three = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (81, 3000, 70))
    rows = [(1, one), (2, "head " + one + " tail"), (2, two), (2, "x"), (None, two + one), (None, three), (None, three + "y"), (None, None)]
    expected = []
    seen = {d: {t[k : k + 50] for e, t in rows if (t and e is not None and (d is None or e < d)) for k in range(len(t) - 49)} for d in (1, 2, None)}
    for doc, text in rows:
        data = text or ""
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if data[k : k + 50] in seen[doc]:
                gone[k : k + 50] = b"\x01" * 50
        expected.append((doc, len(data), sum(gone), "".join(c for c, g in zip(data, gone) if not g)))
    for chunk in (4 << 20, 100):
        found = S.remove_repeats(documents([(i, t, "en", "a") for i, t in rows]), limits=S.RepeatLimits(chunk_bytes=chunk))
        got = [(r.doc, r.n_bytes, sum(s.stop - s.start for s in r.spans), bytes(r.kept).decode()) for r in found.collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, expected))
    with pytest.raises(ValueError):
        S.remove_repeats(documents([]), limits=S.RepeatLimits(length=100))


def test_texts_of_one_id_in_one_chunk():
    import pyarrow as pa

    table = pa.table({"doc": [5, 7, 5, 5, 7], "data": [b"b", b"z", b"a", b"b", b"z"]})
    assert S._parts(table) == [1, 0, 0, 1, 0]


def test_a_bucket_takes_time_by_its_anchors_not_by_chunks_times_anchors():
    """Sixteen times the chunks, with as many anchors each: about 16 times the time, not 256."""
    limits, each = S.RepeatLimits(), 100

    def seconds(chunks):
        marks = np.sort(np.random.default_rng(1).integers(0, 5 * chunks, (chunks, each)).astype(np.uint64))
        told = [(0, i, row.tobytes(), np.ones(each, "<u2").tobytes()) for i, row in enumerate(marks)]
        table, best = S._blobs(S._ANCHORS, told), math.inf
        for _ in range(3):
            began = time.process_time()
            found = S.bucket_repeats(limits)((pa.scalar(0),), table)
            best = min(best, time.process_time() - began)
        counts = np.bincount(marks.ravel().astype(np.int64))
        for chunk, own, hot in zip(*(found.column(c).to_pylist() for c in ("chunk", "marks", "hot"))):
            expected = marks[chunk][counts[marks[chunk].astype(np.int64)] >= 2]
            assert (np.frombuffer(own, np.uint64) == expected).all() and len(hot) == len(expected)
        assert found.num_rows == chunks
        return best

    assert seconds(2000) < 80 * seconds(125)
