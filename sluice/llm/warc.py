"""WARC archives: a writer with one gzip member per record, and a splittable reader.

The reader's tasks take byte ranges of the archives. A task scans its range for the gzip magic number and
validates each candidate by decoding the start of the member: a true record begins with a WARC version line.
A record belongs to the range in which its member starts; its task reads past the range's end to finish it.

Pages with equal payloads are written once, as a response; the others are revisit records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm.common import open_fs, shared_folder, stage

MAGIC = b"\x1f\x8b\x08"
SPLIT = 8 << 20
CHUNK = 1 << 20
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One WARC record as a gzip member. Header values are percent-encoded where a line couldn't hold them."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    body = b"" if refers_to is not None else payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", "WARC-Date: 1970-01-01T00:00:00Z",
             f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 37))) + "".join(map(chr, range(38, 127)))))
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}"]
    head = "\r\n".join([*lines, f"Content-Length: {len(body)}", "", ""]).encode()
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head + body + b"\r\n\r\n") + z.flush()


def write_warc(pages: DataFrame, folder: str, min_payload: int = 0) -> DataFrame:
    """Writes every row of ``pages`` (page_id, url, html) and returns (file, bytes) of the archives.

    Null html is an empty payload. Of rows with equal payloads of at least ``min_payload`` bytes those with the
    smallest page_id are responses, the others revisits; smaller payloads are always responses. Rows that
    repeat the smallest page_id are responses too; rows without page_id are responses unless another row with
    that payload has one. Files have new names, and only those that Spark's committed manifest names count.
    """
    body = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", body.alias("payload"), F.sha1(body).alias("digest"))
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # joined by the reversed digest: the join then has a shuffle of its own, and Spark can split a payload that very many
    # pages share, which it can't right above an aggregation
    first = first.select(F.reverse("digest").alias("d"), "first")
    rows = rows.join(first, F.reverse("digest") == F.col("d"), "left").select(
        "page_id", "url", "payload",
        F.when((F.length("payload") >= min_payload) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = name = None
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    fs, root = open_fs(folder)
                    fs.create_dir(root, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                data = record(*row)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "bytes": [size]})

    return stage(rows.mapInArrow(write, "file string, bytes long"), "warc-manifest")


def _member(f, start: int, size: int) -> tuple[bytes, int] | None:
    """The decoded member at ``start`` and the place where it ends, None if no WARC record starts there. At most
    4 KB are read before the version line is checked; a record that can't be decoded from there on is damaged."""
    z, out, at = zlib.decompressobj(31), [], start
    while not z.eof:
        data = f.read_at(min(CHUNK if out else 4096, size - at), at)
        try:
            text = z.decompress(data)
        except zlib.error as e:
            if not out:
                return None
            raise ValueError(f"damaged WARC record at byte {start}: {e}") from e
        if not out and not text.startswith(b"WARC/1."):
            return None
        if not data:
            raise ValueError(f"WARC record at byte {start} has no end")
        out.append(text)
        at += len(data)
    return b"".join(out), at - len(z.unused_data)


def _parse(data: bytes, start: int):
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    body = rest[: int(fields.get("Content-Length", -1))]
    if rest[len(body):] != b"\r\n\r\n":
        raise ValueError(f"WARC record at byte {start} has another length than its header says")
    return fields, body


def _owned(f, start: int, end: int, size: int) -> Iterator[tuple[bytes, int]]:
    """The decoded records that start in [start, end), with their places. The first is found by its magic number, each
    other starts where the one before ends, and so does the next range's first: bytes that belong to no record raise."""
    area = f.read_at(min(end + len(MAGIC) - 1, size) - start, start)
    i = area.find(MAGIC)
    while i >= 0 and (found := _member(f, start + i, size)) is None:
        i = area.find(MAGIC, i + 1)
    at = start + i if i >= 0 else end
    if start == 0 and at != 0:
        raise ValueError("the archive doesn't begin with a WARC record")
    while at < end:
        yield found[0], at
        at = found[1]
        if at < size and (found := _member(f, at, size) if at < end else _begins(f, at, size)) is None:
            raise ValueError(f"no WARC record at byte {at}")


def _begins(f, at: int, size: int) -> bool | None:
    """True if a record's version line can be decoded at ``at``, else None."""
    try:
        return zlib.decompressobj(31).decompress(f.read_at(min(4096, size - at), at)).startswith(b"WARC/1.") or None
    except zlib.error:
        return None


def read_warc(spark: SparkSession, manifest: DataFrame, folder: str, split: int = SPLIT, payloads: bool = True) -> DataFrame:
    """All records: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload (null for revisits
    and where ``payloads`` is off). payload_digest of a response is computed from what was read. Archives of which a
    byte belongs to no whole record (damaged, cut or foreign members) raise: no record is left out in silence."""
    from urllib.parse import unquote

    ranges = manifest.select("file", "bytes", F.explode(F.sequence(F.lit(0), F.floor((F.col("bytes") - 1) / split))).alias("k"))
    ranges = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "k")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for r in batch.to_pylist():
                start, end = r["k"] * split, min((r["k"] + 1) * split, r["bytes"])
                with fs.open_input_file(f"{root}/{r['file']}") as f:
                    for data, at in _owned(f, start, end, r["bytes"]):
                        h, body = _parse(data, at)
                        response = h["WARC-Type"] == "response"
                        rows.append({
                            "page_id": int(h["X-Page-ID"]) if "X-Page-ID" in h else None,
                            "payload_bytes": len(body) if response else int(h["X-Payload-Length"]),
                            "payload_digest": base64.b32encode(hashlib.sha1(body).digest()).decode() if response
                            else h["WARC-Payload-Digest"].removeprefix("sha1:"),
                            "record_type": h["WARC-Type"], "refers_to": int(h["X-Refers-To-Page"]) if "X-Refers-To-Page" in h else None,
                            "url": unquote(h["WARC-Target-URI"]) if "WARC-Target-URI" in h else None,
                            "payload": body if response and payloads else None})
                        held += len(body) if payloads else 100
                        if held > CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return ranges.mapInArrow(read, RESULT)


def warc_digest(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as archives under the shared folder and reads them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to."""
    spark, folder = pages.sparkSession, shared_folder(pages.sparkSession, "warc")
    out = read_warc(spark, write_warc(pages, folder), folder, payloads=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
