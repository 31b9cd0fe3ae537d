"""Token-id output: flat files of unsigned integers plus 64-bit document offsets.

A data set is a folder with, for every part, ``part-*.bin`` (the ids of its documents one after another,
little-endian, 16 bits if the vocabulary allows, else 32) and ``part-*.idx`` (64-bit: the documents' offsets
in the part, one more than documents, then their ids), and a manifest (one row per part: file, rows, tokens,
first document, base). A part's base is the number of ids in all parts before it: prefix sums over the manifest.

Documents are range-partitioned and sorted by doc_id. A task writes files under a new name and reports them in
the manifest, which Spark commits; files of tasks that were lost or ran twice are in no manifest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from sluice.llm.common import open_fs, shared_folder, stage
from sluice.llm.tokens import encoder, tokenizer_path

END = 0
#: ids are handed to the file in pieces of about this many bytes
BUFFER = 1 << 22
MANIFEST = "file string, n_rows long, n_tokens long, width int, first_doc long, first_null boolean, first_hash long, first_row long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None) -> DataFrame:
    """Writes the ids of all rows of ``docs`` (doc_id, text), each followed by id 0, and returns the manifest
    with a ``base`` per part. Null text is empty. Rows are in ascending doc_id order, null first; rows of equal
    doc_id follow a hash of their text, then their place in the input, so copies may fill several parts."""
    path = tokenizer or tokenizer_path()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("h"),
                       F.monotonically_increasing_id().alias("row"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.col("h").asc(), F.col("row").asc()]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, fs, out, ids, offsets, first = encoder(path), None, None, [], [0], None
        end, pending = np.zeros(1, enc.dtype).tobytes(), []
        width = enc.dtype.itemsize
        for batch in batches:
            if batch.num_rows and first is None:
                first = [batch.column(i)[0].as_py() for i in range(3)]
                fs, root = open_fs(folder)
                fs.create_dir(root, recursive=True)
                name = f"part-{uuid.uuid4().hex}"
                out = fs.open_output_stream(f"{root}/{name}.bin")
            ids += batch.column(0).to_pylist()
            size = 0
            for text in batch.column(3).to_pylist():
                data = enc.encode(text)
                pending += (data, end)
                offsets.append(offsets[-1] + len(data) // width + 1)
                size += len(data)
                if size > BUFFER:
                    out.write(b"".join(pending))
                    pending, size = [], 0
            if pending:
                out.write(b"".join(pending))
                pending = []
        if first is None:
            return
        out.close()
        with fs.open_output_stream(f"{root}/{name}.idx") as idx:
            idx.write(np.array(offsets, "<i8").tobytes())
            known = np.array([i is not None for i in ids], "<i8")
            idx.write(np.array([0 if i is None else i for i in ids], "<i8").tobytes() + known.tobytes())
        yield pa.RecordBatch.from_pydict({
            "file": [name], "n_rows": [len(ids)], "n_tokens": [offsets[-1]], "width": pa.array([width], pa.int32()),
            "first_doc": pa.array([first[0]], pa.int64()), "first_null": [first[0] is None], "first_hash": [first[1]], "first_row": [first[2]]})

    found = stage(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(write, MANIFEST), "manifest")
    # one row per part: the window sees as many rows as the job had tasks
    before = Window.orderBy(F.col("first_null").desc(), "first_doc", "first_hash", "first_row").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone. Local files are
    memory-mapped; a store that can't map them is read in ranges."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        for batch in batches:
            for row in batch.to_pylist():
                base, width, n = row["base"], row["width"], row["n_rows"]
                with fs.open_input_file(f"{root}/{row['file']}.idx") as f:
                    index = np.frombuffer(f.read(), "<i8")
                offsets, ids, known = index[: n + 1], index[n + 1: 2 * n + 1], index[2 * n + 1:]
                name = f"{root}/{row['file']}.bin"
                mapped = np.memmap(name, f"<u{width}", "r") if fs.type_name == "local" else None
                with fs.open_input_file(name) as f:
                    crcs = []
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                        own = mapped[a:b] if mapped is not None else np.frombuffer(f.read_at((b - a) * width, a * width), f"<u{width}")
                        crcs.append(zlib.crc32(own.astype("<u4").tobytes()))
                for i in range(0, n, 10_000):
                    j = min(n, i + 10_000)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(ids[i:j], pa.int64(), mask=known[i:j] == 0), "start": offsets[i:j] + base,
                        "n_tokens": np.diff(offsets[i:j + 1]), "ids_crc32": pa.array(crcs[i:j], pa.int64())})

    manifest = manifest.select("file", "n_rows", "width", "base")
    return manifest.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file").mapInArrow(read, RESULT)


def document_ids(spark: SparkSession, manifest_row: dict, folder: str, i: int) -> np.ndarray:
    """The ids of document ``i`` of a part, read through the index (two small ranged reads)."""
    fs, root = open_fs(folder)
    with fs.open_input_file(f"{root}/{manifest_row['file']}.idx") as f:
        a, b = struct.unpack("<2q", f.read_at(16, 8 * i))
    width = manifest_row["width"]
    with fs.open_input_file(f"{root}/{manifest_row['file']}.bin") as f:
        return np.frombuffer(f.read_at((b - a) * width, a * width), f"<u{width}")


def token_digest(docs: DataFrame) -> DataFrame:
    """Writes ``docs`` to token files under the shared folder, reads them back: doc_id, start, n_tokens, ids_crc32."""
    folder = shared_folder(docs.sparkSession, "tokens")
    return read_tokens(docs.sparkSession, write_tokens(docs, folder), folder)
