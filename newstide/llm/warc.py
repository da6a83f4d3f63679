"""WARC archives: monolithic gzip files, their normal form, and an offset index.

Some writers put a whole archive into one gzip stream, in which no record can be reached
without inflating all before it. The normaliser inflates such a file once, rewrites every
record as a gzip member of its own, and notes where the member lies. Files go to a folder all
executors reach; a task names its files by chance and only a task that ends well gets them
listed, so one that is run again after a lost executor leaves at most unlisted files.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from newstide.llm.common import bounded_batches
from newstide.workspace import fresh_path, stage

CHUNK = 1 << 20
_END = b"\r\n\r\n"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file:///" + path[len("file:/") :]
    return fs.FileSystem.from_uri(path)


def record_bytes(fields: dict, payload: bytes) -> bytes:
    """One WARC record: version, named fields, blank line, block, two line ends."""
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields.items() if v is not None]]
    head = "\r\n".join([*lines, f"Content-Length: {len(payload)}"])
    return head.encode("utf-8") + _END + payload + _END


def parse_record(record: bytes) -> tuple[dict, bytes]:
    head, _, rest = record.partition(_END)
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def split_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records out of an inflated stream; holds one record and one chunk."""
    held, need = bytearray(), None
    for chunk in chunks:
        held += chunk
        while True:
            if need is None:
                at = held.find(_END)
                if at < 0:
                    break
                fields = dict(x.split(b": ", 1) for x in bytes(held[:at]).split(b"\r\n")[1:])
                need = at + len(_END) + int(fields[b"Content-Length"]) + len(_END)
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError(f"{len(held)} bytes after the last whole record")


def inflated(source) -> Iterator[bytes]:
    """The content of a gzip file in pieces, one member or several."""
    member = zlib.decompressobj(31)
    while data := source.read(CHUNK):
        while data:
            if piece := member.decompress(data, 4 * CHUNK):
                yield piece
            if member.eof:
                data, member = member.unused_data, zlib.decompressobj(31)
            else:
                data = member.unconsumed_tail
    if piece := member.flush():
        yield piece


def write_monolithic(records: DataFrame, folder: str) -> DataFrame:
    """Write ``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload``.

    One gzip stream per task. Gives the committed files: (file, records).
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        name, count = f"{uuid.uuid4().hex}.warc.gz", 0
        packer, out = zlib.compressobj(6, zlib.DEFLATED, 31), None
        for batch in batches:
            for row in batch.to_pylist():
                out = out or system.open_output_stream(f"{root}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
                number, earlier = row["page_id"], row["refers_to"]
                fields = {
                    "WARC-Type": row["record_type"],
                    "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                    "WARC-Target-URI": None if row["url"] is None else " ".join(row["url"].split()),
                    "WARC-Page-ID": number,
                    "WARC-Refers-To-Page-ID": earlier,
                    "WARC-Payload-Digest": f"sha1:{digest}",
                    "WARC-Payload-Length": row["payload_bytes"],
                    "Content-Type": "text/html; charset=utf-8",
                }
                out.write(packer.compress(record_bytes(fields, row["payload"] or b"")))
                count += 1
        if out:
            out.write(packer.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([count], pa.int64())})

    return stage(records.mapInArrow(write, "file string, records long"), "warc-files")


INDEX = "file string, ordinal long, offset long, length long, record_type string, page_id long"


def normalise(files: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite every listed file of ``source`` with a member per record, and index it.

    The index has a row per record and is also written next to each file as
    ``<file>.index``, a line of ordinal, offset and length per record.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (system, root), (out_system, out_root) = _open(source), _open(target)
        out_system.create_dir(out_root, recursive=True)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                new, offset, index = f"{uuid.uuid4().hex}.warc.gz", 0, []
                with (
                    system.open_input_stream(f"{root}/{name}", compression=None) as old,
                    out_system.open_output_stream(f"{out_root}/{new}", compression=None) as out,
                    out_system.open_output_stream(f"{out_root}/{new}.index", compression=None) as side,
                ):
                    for ordinal, record in enumerate(split_records(inflated(old))):
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = packer.compress(record) + packer.flush()
                        out.write(member)
                        side.write(f"{ordinal} {offset} {len(member)}\n".encode())
                        fields, _ = parse_record(record)
                        number = fields.get("WARC-Page-ID")
                        index.append(
                            (new, ordinal, offset, len(member), fields["WARC-Type"], number and int(number))
                        )
                        offset += len(member)
                        if len(index) >= 10_000:
                            yield _index_batch(index)
                            index = []
                if index:
                    yield _index_batch(index)

    return stage(files.select("file").repartition("file").mapInArrow(rewrite, INDEX), "warc-index")


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    names = ["file", "ordinal", "offset", "length", "record_type", "page_id"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """The records, each read by its offset and checked against its digest and length.

    A revisit carries no payload; its digest and length are those of the full one.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        opened, source = None, None
        for batch in batches:
            rows, held = [], 0
            for row in batch.select(["file", "offset", "length"]).to_pylist():
                if row["file"] != opened:
                    if source:
                        source.close()
                    opened, source = row["file"], system.open_input_file(f"{root}/{row['file']}")
                member = source.read_at(row["length"], row["offset"])
                fields, payload = parse_record(zlib.decompress(member, 31))
                digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
                size = int(fields["WARC-Payload-Length"])
                revisit = fields["WARC-Type"] == "revisit"
                if not revisit and (len(payload) != size or hashlib.sha1(payload).digest() != digest):
                    raise ValueError(f"record at {row} does not match its digest")
                number, earlier = fields.get("WARC-Page-ID"), fields.get("WARC-Refers-To-Page-ID")
                rows.append(
                    (
                        number and int(number), fields.get("WARC-Target-URI"), size, digest.hex(),
                        fields["WARC-Type"], earlier and int(earlier), None if revisit else payload,
                    )
                )
                held += len(payload)
                if held > 8 << 20:
                    yield _record_batch(rows)
                    rows, held = [], 0
            if rows:
                yield _record_batch(rows)
        if source:
            source.close()

    return index.mapInArrow(read, RECORDS)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def warc_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """A record per page; of equal payloads of at least ``least`` bytes one is kept whole.

    That with the largest page_id is the response, the others revisit it. NULL html is an
    empty payload. Repeated rows of the largest page_id are all responses; a NULL page_id
    revisits like any other, unless all are NULL. Only digests are grouped, never payloads.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url") if "url" in pages.columns else F.lit(None).cast("string").alias("url"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
        payload.alias("payload"),
    )
    large = rows.filter(F.col("payload_bytes") >= least).select("page_id", "payload_digest")
    first = large.groupBy("payload_digest").agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies")
    )
    first = first.filter("copies > 1 AND refers_to IS NOT NULL").drop("copies")
    revisits = stage(
        large.join(first, "payload_digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("r_page"), F.col("payload_digest").alias("r_digest"), "refers_to")
        .distinct(),
        "warc-revisits",
    )
    joined = rows.join(
        revisits,
        (F.col("payload_digest") == F.col("r_digest")) & F.col("page_id").eqNullSafe(F.col("r_page")),
        "left",
    )
    revisit = F.col("r_digest").isNotNull()
    return joined.select(
        "page_id", "url", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "refers_to",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as monolithic archives, normalise these, and read all records back."""
    spark = bounded_batches(pages).sparkSession
    raw, final = fresh_path(spark, "warc-raw"), fresh_path(spark, "warc")
    index = normalise(write_monolithic(warc_records(pages), raw), raw, final)
    return read_archives(index, final)


def warc_digest(pages: DataFrame) -> DataFrame:
    return archive_round_trip(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
