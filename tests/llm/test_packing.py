import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from newstide.llm import packing as K  # noqa: E402
from newstide.llm.cutting_stock import plan_patterns  # noqa: E402

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(FILE)


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


def test_texts_give_the_tokenizers_ids(tokenizer, monkeypatch):
    rng = random.Random(3)
    spaces = [chr(i) for i in (9, 10, 11, 12, 13, 32, 28, 29, 31, 0x85, 0xA0, 0x1680, 0x180E, 0x2003, 0x2028, 0x200B, 0x3000, 0xFEFF, 0)]
    letters = [*"ab'stZ1!.,;é中", "'s", "'ll", "'d", " the", " 12", "ñó"] + spaces
    encoders = [K.TextEncoder(FILE, K.PackingLimits(piece=n)) for n in (1, 20, 1 << 20)]
    assert all(e.quick is not None for e in encoders)
    monkeypatch.setattr(K, "merge_ranks", lambda _: None)
    encoders.append(K.TextEncoder(FILE, K.PackingLimits(piece=5)))
    assert encoders[-1].quick is None
    for n in range(1500):
        if n == 1000:
            letters.append("<|endoftext|>")
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(50)))
        ids = as_bytes(tokenizer.encode(text, add_special_tokens=False).ids)
        for encoder in encoders:
            assert encoder.ids(text) == ids, repr(text)


def test_long_texts_without_white_space(tokenizer):
    encoder = K.TextEncoder(FILE, K.PackingLimits(piece=1000))
    for text in ("ab" * 20_000, " " * 30_000 + "x", "!?" * 20_000, "中文" * 10_000, "x\n" * 10_000):
        assert encoder.ids(text) == as_bytes(tokenizer.encode(text, add_special_tokens=False).ids)


def histogram(lengths):
    found = defaultdict(int)
    for n in lengths:
        found[n] += 1
    return dict(found)


@pytest.mark.parametrize("n", [0, 1, 12, 300, 4000])
@pytest.mark.parametrize("size", [8, 64])
def test_patterns_fill_sequences_with_the_pieces_there_are(n, size):
    rng = random.Random(n * size)
    for kind in (lambda: rng.randrange(1, size), lambda: min(size - 1, 1 + int(rng.expovariate(4 / size))), lambda: size // 2):
        counts = histogram(kind() for _ in range(n))
        used = defaultdict(int)
        for pattern in plan_patterns(counts, size):
            assert pattern.copies > 0 and sum(length * many for length, many in pattern.parts) == size
            for length, many in pattern.parts:
                used[length] += many * pattern.copies
        assert all(used[k] <= counts[k] for k in used)
        if n == 4000:
            left = sum(k * (counts[k] - used[k]) for k in counts)
            assert left <= 0.12 * sum(k * m for k, m in counts.items())


def test_pieces_that_fit_nothing_are_left(tokenizer):
    assert plan_patterns({700: 10**9}, 1024) == []
    (whole,) = plan_patterns({512: 2 * 10**12 + 1}, 1024)
    assert whole.parts == ((512, 2),) and whole.copies == 10**12


def check(docs, pieces, tokenizer, size):
    """Every id in exactly one piece, no gaps, every sequence full or a power of two long."""
    known, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        known[p.doc_id, p.doc_tokens].append(p)
        sequences[p.sequence_id].append((p.offset, p.length))
    wanted = defaultdict(list)
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        wanted[doc, len(ids)].append(as_bytes(ids))
    assert set(known) == set(wanted)
    for key, texts in wanted.items():
        spans = sorted((p.start, p.length, crc32(p.ids), bytes(p.ids)) for p in known[key])
        assert all(length > 0 and len(ids) == 4 * length for _, length, _, ids in spans)
        assert sum(length for _, length, _, _ in spans) == key[1] * len(texts)
        # Rows of one id and size may be cut at different places; every piece is one of theirs.
        assert all(any(t[4 * s : 4 * (s + n)] == ids for t in texts) for s, n, _, ids in spans)
        if len(texts) == 1:
            assert b"".join(ids for *_, ids in spans) == texts[0]
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == size or (at < size and at & (at - 1) == 0)
    assert sum(sum(n for _, n in s) < size for s in sequences.values()) <= size.bit_length()


@pytest.mark.parametrize("size,broadcast", [(1024, 32 << 20), (16, 0), (1, 32 << 20)])
def test_packing_is_exact(documents, awkward, tokenizer, size, broadcast):
    rows = [*awkward, (None, "a b c", "en", "a"), (None, None, "en", "a"), (6, "short", "en", "b")]
    if size < 1024:
        rows = [r for r in rows if len(r[1] or "") < 10_000]
    table = documents(rows).withColumnRenamed("size", "Offset")
    pieces = K.packed_pieces(table, FILE, limits=K.PackingLimits(size=size, broadcast_bytes=broadcast))
    assert "Offset" not in pieces.columns and "shard" in pieces.columns
    found = pieces.collect()
    check([(r[0], r[1]) for r in rows], found, tokenizer, size)
    whole = {r.sequence_id: r for r in K.sequences(pieces).collect()}
    assert sum(r.n_tokens for r in whole.values()) == sum(p.length for p in found)
    assert all(len(r.ids) == 4 * r.n_tokens for r in whole.values())


def test_digest_and_empty_table(documents, awkward):
    table = documents(awkward[:9])
    found = K.packing_digest(table, FILE)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    empty = [r for r in found.collect() if r.doc_id == 1]
    assert [(r.start, r.length, r.ids_crc32, r.doc_tokens) for r in empty] == [(0, 1, crc32(b"\0\0\0\0"), 1)]
    assert K.packing_digest(table.limit(0), FILE).count() == 0
