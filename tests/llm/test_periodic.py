import hashlib
import random
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest

from newstide.llm import periodic_runs as R


def brute(words, least=24, exponent=3):
    """(start, length, smallest period) of all runs, trying every period."""
    n, found = len(words), {}
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([numbers[w] for w in words], np.int64)
    for p in range(1, n // exponent + 1):
        if (ids[:-p] == ids[p:]).sum() < max(least, exponent * p) - p:
            continue
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, exponent * p):
                found.setdefault((i, j - i + p), p)
            i = j
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))


def with_repeats(rng, n, letters):
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a, p = rng.randrange(n), 1 + rng.randrange(12)
        for i in range(a + p, min(n, a + rng.randrange(80))):
            words[i] = words[i - p]
    return words


@pytest.mark.parametrize("least,exponent", [(24, 3), (5, 3), (2, 2), (6, 2), (3, 3), (9, 4)])
def test_runs_equal_brute_force(least, exponent):
    rng = random.Random(least * exponent)
    some = 0
    for _ in range(250):
        words = with_repeats(rng, rng.randrange(1, 140), rng.choice([1, 2, 3, 5, 50]))
        runs = R.find_word_runs(np.array(words, np.int64), R.RunLimits(least, exponent))
        assert runs == brute(words, least, exponent)
        some += len(runs)
    assert some > 50
    assert R.find_word_runs(np.array([], np.int64)) == []


def test_colliding_hashes_cost_time_only(monkeypatch):
    monkeypatch.setattr(R, "_ODD", np.uint64(0))
    rng = random.Random(3)
    for _ in range(60):
        words = with_repeats(rng, 100, 3)
        assert R.find_word_runs(np.array(words, np.int64)) == brute(words)


def test_passages_far_apart_and_long_runs_stay_quick():
    far = [x for i in range(3000) for x in [100 + i, *range(30)]]
    assert R.find_word_runs(np.array(far, np.int64)) == []
    assert R.find_word_runs(np.array([7] * 50_000 + [8], np.int64)) == [(0, 50_000, 1)]
    with pytest.raises(ValueError):
        R.RunLimits(exponent=1)


def expected(doc, text):
    words = (text or "").encode().split()
    n = len(words)
    h = crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    return (
        doc, len(runs), *top, 1000 * top[1] // top[2] if runs else None, hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def test_digest_is_exact(documents, awkward):
    rng = random.Random(8)
    more = [(1000 + i, " \n".join(map(str, with_repeats(rng, 120, 9))), "en", "a") for i in range(120)]
    rows = [*awkward, *more, (None, more[0][1], "en", "a"), (None, None, None, None), more[5]]
    assert crc32(b"6") % 10 == 0, "the long text is one of those repeated"
    found = R.run_digest(documents(rows)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr(expected(r[0], r[1])) for r in rows)
    assert sum(r.n_runs > 0 for r in found) > 20
    assert R.run_digest(documents(rows).limit(0)).count() == 0


def test_whole_rows_come_back(documents):
    rows = [(1, "start " + "a b " * 12 + "end", "en", "a"), (2, None, "en", "a")]
    table = documents(rows).withColumnRenamed("size", "Runs").withColumnRenamed("shard", "collapsed")
    found = {r.doc_id: r for r in R.word_runs(table).collect()}
    assert [tuple(x) for x in found[1].runs] == [(1, 24, 2)]
    assert found[1].collapsed == "start a b end" and found[1].n_words == 26 and found[1].Kept == 2
    assert found[2].runs == [] and found[2].collapsed == "" and found[2].text is None
