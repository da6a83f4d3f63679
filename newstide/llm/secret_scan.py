"""Secrets in texts, also below layers of encoding.

A worklist starts with the text itself. Each layer is scanned, and whatever in it is URL,
Unicode or base64 encoded or compressed is unwrapped into further layers, until none is new.
Every character of a layer knows the stretch of the original text it came from, so what is
found in a layer is reported where the reader sees it.

Compressed layers are inflated in pieces, over all members and as deep as they go. All that is
in one stands at the one place of its compressed form, so pieces need no maps. A piece ends
where nothing that is looked for can go on; memory follows the longest stretch without such an
end, not the size of the content. Time is not limited: a decompression bomb takes as long as
its content, and one built to hold ever larger copies of itself does not end.

Base64 is read as the run it is and, where lines follow one another, over their ends as well;
a line that is complete by itself is thus also reported by itself. A run that does not decode
to clean text may be glued to other text or hold bytes: it is decoded from each of four places,
and whatever stretches of ASCII or compressed data come out of it are layers.
"""

from __future__ import annotations

import binascii
import hashlib
import io
import re
import tempfile
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame

from newstide.llm.common import bounded_batches, row_batches

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"(?:[Pp][Aa][Ss][Ss](?:[Ww][Oo][Rr][Dd]|[Ww][Dd])|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of the class ends where it ends, so 24+ of it is all of it

_ENCODED_LINE = re.compile(r"%[0-9A-Fa-f]{2}|\\u\{?[0-9A-Fa-f]{2}|\\x[0-9A-Fa-f]{2}|&#[xX]?[0-9A-Fa-f]+;")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
_WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{4,}+(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)+={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_STANDARD = str.maketrans("-_", "+/")
# Base64 of the heads of gzip and zlib data.
_HEAD = r"(?:H4sI|eA[E-H]|eF[4-7]|eJ[w-z]|eN[o-r])"
_PACKED_LINE = re.compile(_HEAD)
_PACKED_AT = re.compile(rf"(?<=[+/]){_HEAD}")
# The shortest of what is looked for has 12 characters, all of them ASCII, like all base64.
_STRETCH = re.compile(rb"[\t\r\n\x20-\x7e]{12,}")
_PRINTABLE = re.compile(r"[\x20-\x7e\t\r\n\u00a0-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]+")


# Where a compressed layer may be cut: after a character that no pattern above has, or after a
# space between plain words, which is in no assignment. Hexadecimal digits may end an escape.
_CUT = re.compile(r"[^A-Za-z0-9+/_.=\x20\t\r\n\"':%\\{}&#;-]|(?<=[g-zG-Z])\x20(?=[A-Za-z])")
PIECE = 1 << 20


def scan(text: str) -> list[tuple[str, int, int]]:
    """Base matches (kind, start, end), leftmost and non-overlapping per kind."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


class Layer:
    """A text and, for each of its characters, where in the original it came from.

    ``place`` is given instead where that is the same for all.
    """

    __slots__ = ("text", "starts", "ends", "place")

    def __init__(self, text: str, starts=None, ends=None, place: tuple[int, int] | None = None):
        self.text, self.starts, self.ends, self.place = text, starts, ends, place

    def at(self, start: int, end: int) -> tuple[int, int]:
        if self.place or self.starts is None:
            return self.place or (start, end)
        return min(self.starts[start:end]), max(self.ends[start:end])


class Packed:
    """Compressed bytes, as a file open for reading, and the place of all that is in them."""

    __slots__ = ("file", "digest", "place")

    def __init__(self, file, digest: bytes, place: tuple[int, int]):
        self.file, self.digest, self.place = file, digest, place


def _substituted(layer: Layer, start: int, end: int, pattern, decode) -> Layer | None:
    """Part of a layer with every match replaced by what it stands for."""
    text, starts, ends, at, changed = [], [], [], start, False
    for m in pattern.finditer(layer.text, start, end):
        value = decode(m)
        if value is None:
            continue
        changed = True
        _copy(layer, at, m.start(), text, starts, ends)
        s, e = layer.at(m.start(), m.end())
        text.append(value)
        if not layer.place:
            starts += [s] * len(value)
            ends += [e] * len(value)
        at = m.end()
    if not changed:
        return None
    _copy(layer, at, end, text, starts, ends)
    return Layer("".join(text), starts, ends, layer.place)


def _copy(layer: Layer, start: int, end: int, text: list, starts: list, ends: list) -> None:
    text.append(layer.text[start:end])
    if layer.place:
        return
    starts += range(start, end) if layer.starts is None else layer.starts[start:end]
    ends += range(start + 1, end + 1) if layer.ends is None else layer.ends[start:end]


def _percent(match) -> str:
    return unquote_to_bytes(match[0]).decode("utf-8", "replace")


def _escape(match) -> str | None:
    code = int(match[5]) if match[5] else int(match[1] or match[2] or match[3] or match[4], 16)
    return chr(code) if code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else None


def is_packed(data: bytes) -> bool:
    """Whether this is, or starts, gzip or zlib data; text such as ``x^2`` has a zlib header too."""
    if data[:2] != b"\x1f\x8b" and (len(data) < 6 or data[0] != 0x78 or (data[0] * 256 + data[1]) % 31):
        return False
    try:
        zlib.decompressobj(47).decompress(data[:4096], 1 << 16)
    except zlib.error:
        return False
    return True


def inflated(file, piece: int) -> Iterator[bytes]:
    """Content of gzip or zlib data in pieces: all members, then what follows them as it is.

    Where the data is broken or breaks off, the content up to there.
    """
    member = zlib.decompressobj(47)
    while data := file.read(piece):
        while data:
            try:
                if content := member.decompress(data, piece):
                    yield content
            except zlib.error:
                return
            if not member.eof:
                data = member.unconsumed_tail
                continue
            data = member.unused_data.lstrip(b"\0")
            while len(data) < 4096 and (rest := file.read(piece)):
                data = (data + rest).lstrip(b"\0")
            if data and not is_packed(data):
                yield b"\0" + data
                while rest := file.read(piece):
                    yield rest
                return
            member = zlib.decompressobj(47)
    # What a last call held back because of its limit.
    while not member.eof:
        try:
            content = member.decompress(b"", piece)
        except zlib.error:
            return
        if not content:
            return
        yield content


def _pieces(packed: Packed, piece: int) -> Iterator[Layer | Packed]:
    """What is in a compressed layer: a compressed layer again, or text in pieces.

    No pattern has characters beyond ASCII, so bytes stand for characters.
    """
    source, head = inflated(packed.file, piece), b""
    for content in source:
        head += content
        if len(head) >= 4096:
            break
    if is_packed(head):
        with tempfile.SpooledTemporaryFile(piece) as file:
            digest = hashlib.sha256()
            while head:
                file.write(head)
                digest.update(head)
                head = next(source, b"")
            file.seek(0)
            yield Packed(file, digest.digest(), packed.place)
        return
    held = []
    while head:
        text, head = head.decode("latin-1"), next(source, b"")
        before = held[-1][-1:] if held else ""
        cut = None
        for start in (max(len(text) - 4096, 0), 0):
            for cut in _CUT.finditer(before + text, start):
                pass
            if cut:
                break
        if cut is None:
            held.append(text)
            continue
        end = cut.end() - len(before)
        yield Layer("".join([*held, text[:end]]), place=packed.place)
        held = [text[end:]] if end < len(text) else []
    yield Layer("".join(held), place=packed.place)


def _readable(data: bytes) -> bool:
    try:
        return bool(_PRINTABLE.fullmatch(data.decode("utf-8")))
    except UnicodeDecodeError:
        return False


def _bytes(run: str) -> bytes:
    """What a run of base64 stands for, without padding; a single last character says nothing."""
    run = run[:-1] if len(run) % 4 == 1 else run
    return binascii.a2b_base64(run + "=" * (-len(run) % 4))


def _base64_layers(layer: Layer, start: int, end: int) -> Iterator[Layer | Packed]:
    """What a run of base64 stands for: it, or whatever is found in it from any place on."""
    raw = layer.text[start:end].rstrip("=").translate(_STANDARD)
    data = _bytes(raw)
    whole = is_packed(data)
    if whole:
        yield _packed(data, layer.at(start, end))
    for m in _PACKED_AT.finditer(raw):
        if is_packed(rest := _bytes(raw[m.start() :])):
            yield _packed(rest, layer.at(start + m.start(), end))
    if whole:
        return
    yield from _stretches(layer, start, data)
    if _readable(data):
        return
    for shift in range(4):
        if shift:
            data = _bytes(raw[shift:])
            yield from _stretches(layer, start + shift, data)
        at = data.find(b"\x1f\x8b\x08")
        while at >= 0:
            if is_packed(data[at:]):
                yield _packed(data[at:], layer.at(start + shift + at * 4 // 3, end))
                break
            at = data.find(b"\x1f\x8b\x08", at + 1)


def _stretches(layer: Layer, start: int, data: bytes) -> Iterator[Layer]:
    for m in _STRETCH.finditer(data):
        text = m[0].decode("ascii")
        if layer.place:
            yield Layer(text, place=layer.place)
            continue
        places = [layer.at(start + i * 4 // 3, start - (-(i + 1) * 4 // 3)) for i in range(m.start(), m.end())]
        yield Layer(text, [p[0] for p in places], [p[1] for p in places])


def _unfolded(layer: Layer, lines: list) -> Layer:
    """Lines of base64 as one run."""
    text = "".join(m[0] for m in lines)
    if layer.place:
        return Layer(text, place=layer.place)
    places = [layer.at(i, i + 1) for m in lines for i in range(m.start(), m.end())]
    return Layer(text, [p[0] for p in places], [p[1] for p in places])


def _blocks(text: str) -> Iterator[list]:
    """Lines that may be one base64 text: after the first, full groups or of equal length."""
    for m in _WRAPPED.finditer(text):
        block = []
        for line in _LINE.finditer(text, m.start(), m.end()):
            size = len(block[-1][0]) if block else 0
            if len(block) > 1 and size % 4 and size != len(block[-2][0]):
                yield block
                block = []
            block.append(line)
        if len(block) > 1:
            yield block


def _packed(data: bytes, place: tuple[int, int]) -> Packed:
    return Packed(io.BytesIO(data), hashlib.sha256(data).digest(), place)


def unwrap(layer: Layer) -> Iterator[Layer | Packed]:
    """Layers one step below; escapes are resolved line by line, to keep their context."""
    text = layer.text
    if "%" in text or "\\" in text or "&#" in text:
        at = 0
        while m := _ENCODED_LINE.search(text, at):
            start, end = text.rfind("\n", 0, m.start()) + 1, text.find("\n", m.start())
            end = len(text) if end < 0 else end
            for pattern, decode in ((_PERCENT, _percent), (_ESCAPE, _escape)):
                if below := _substituted(layer, start, end, pattern, decode):
                    yield below
            at = end
    folded = set()
    for block in _blocks(text) if "\n" in text else ():
        run = _unfolded(layer, block)
        for below in _base64_layers(run, 0, len(run.text)):
            if isinstance(below, Packed):
                folded.update(m.start() for m in block[:1])
                folded.update(m.start() for m in block[1:] if not _PACKED_LINE.match(m[0]))
            yield below
    for m in _BASE64.finditer(text):
        if m.start() not in folded:
            yield from _base64_layers(layer, m.start(), m.end())


def _below(top: Layer, found: Callable[[Layer], None]) -> Iterator[Packed]:
    """Hand all layers below one to ``found``; those that are compressed are returned."""
    work = [top]
    # A layer is new if this content from this place has not been seen: encodings that lead
    # back to themselves end here.
    seen = {(top.text, *(top.place or (0, len(top.text))))}
    while work:
        for below in unwrap(work.pop()):
            if isinstance(below, Packed):
                identity = (below.digest, *below.place)
            else:
                place = below.place or (min(below.starts, default=0), max(below.ends, default=0))
                identity = (below.text, *place)
            if identity in seen:
                continue
            seen.add(identity)
            if isinstance(below, Packed):
                yield below
            else:
                work.append(below)
                found(below)


def find_secrets(text: str, piece: int = PIECE) -> tuple[list, list]:
    """Base spans of the text, and further spans from the layers below it."""
    base = scan(text)
    known, more = set(base), []

    def found(layer: Layer) -> None:
        for kind, start, end in scan(layer.text):
            span = (kind, *layer.at(start, end))
            if span not in known:
                known.add(span)
                more.append(span)

    # Depth first, with a compressed layer open at a time per level. One that is within itself
    # is not opened again, nor is one read on of whose place all kinds are known.
    stack, opened = [(None, _below(Layer(text), found))], set()
    while stack:
        packed, layers = stack[-1]
        done = packed and all((kind, *packed.place) in known for kind in KINDS)
        below = None if done else next(layers, None)
        if below is None:
            stack.pop()
            layers.close()
            if isinstance(packed, Packed):
                opened.discard(packed.digest)
        elif isinstance(below, Layer):
            found(below)
            stack.append((below, _below(below, found)))
        elif below.digest not in opened:
            opened.add(below.digest)
            stack.append((below, _pieces(below, piece)))
    return base, more


def joined(spans) -> str:
    order = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in order)


SECRETS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layered long"


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", piece: int = PIECE) -> DataFrame:
    """Per document: base counts and digest, and all spans, base and unwrapped.

    Spans are code points of the whole text, end exclusive, ``kind:start:end``. NULL is the
    empty text, repeated rows are scanned one by one, an empty table gives an empty result.
    Compressed layers are read whole, ``piece`` bytes at a time.
    Reads two columns and shuffles nothing.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches):
            rows = []
            for value in batch.column(1).to_pylist():
                base, more = find_secrets(value or "", piece)
                counts = [sum(s[0] == kind for s in base) for kind in KINDS]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*counts, digest, joined(base + more), len(more)))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    names = [key, *[c.split()[0] for c in SECRETS.split(", ")]]
    kind = docs.schema[key].dataType.simpleString()
    return bounded_batches(docs).select(key, text).mapInArrow(find, f"`{key}` {kind}, {SECRETS}")
