"""Repeated passages across documents by sparse suffix arrays.

Only suffixes at content-selected positions are kept: in every window of ``length`` words the one whose
``length`` / 2-word start has the smallest hash (the leftmost of equals). Equal windows select the same position,
so a passage of at least ``length`` words that repeats gives suffixes with equal starts in all its places. About
one word in thirteen starts a kept suffix.

Suffixes are shuffled by the hash of their start; those whose start no other document has are dropped. Around
the others the match is extended left and right over all windows of ``length`` words that selected the suffix.
Comparing only the two neighbours in sorted order would lose matches whose longest left and right extensions
belong to different partners, so extensions are compared with every suffix of equal start, through the
windows' hashes: one row per window, never a pair of suffixes, so a passage in very many documents stays linear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from sluice.llm.common import release, stage
from sluice.llm.hashing import BASE, MULTIPLIER, batches_of, mixed, range_hashes, word_bounds, word_hashes

LENGTH = 50


def _hashes(text: bytes, length: int):
    """(first byte and end of every word, per window of ``length`` words: smallest start hash, window hash),
    None for shorter texts."""
    data = np.frombuffer(text, np.uint8)
    begin, end = word_bounds(data)
    if len(begin) < length:
        return None
    k = length // 2
    with np.errstate(over="ignore"):
        words = word_hashes(data, begin, end)
        at = np.arange(len(words) - k + 1)
        g = range_hashes(words, at, at + k)
        windows, rest = len(words) - length + 1, length - k
        w = mixed((g[:windows] * BASE) ^ (g[rest: rest + windows] * MULTIPLIER))
    # minimum over rest + 1 neighbours, by doubling the span
    least, span = g, 1
    while span * 2 <= rest + 1:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    more = rest + 1 - span
    if more:
        least = np.minimum(least[:-more], least[more:])
    return begin, end, least[:windows], w


def repeated_passages(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, start, end, text_words, first_doc_id: the maximal passages of each row of ``docs`` (doc_id, text) in
    which every window of ``length`` words also stands in a document of another doc_id.

    start and end are code points (end exclusive), words are split at ASCII white space and compared exactly;
    first_doc_id is the smallest doc_id that holds one of the passage's windows. Null and short texts have
    none; rows without doc_id take no part; rows that repeat a doc_id are the same document, its texts told apart by a
    64-bit hash.
    """
    rows = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("part"),
                                                    F.coalesce("text", F.lit("")).alias("text")).filter(F.length("text") >= length)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for batch in batches:
                for doc, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    found = _hashes(text.as_buffer(), length)
                    if found:
                        keys = np.unique(found[2])
                        yield keys.view(np.int64), np.full(len(keys), doc), np.full(len(keys), part)

        yield from batches_of(["key", "doc_id", "part"], each())

    kept = stage(rows.mapInArrow(suffixes, "key long, doc_id long, part long"), "suffixes")
    # joined by an injective function of the key: the join then has a shuffle of its own on both sides, and Spark can
    # split a key or window that very many documents share, which it can't right above an aggregation
    many = kept.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select(F.bitwise_not("key").alias("_k"))
    hits = kept.join(many, F.bitwise_not(kept["key"]) == F.col("_k")).groupBy("doc_id", "part").agg(F.collect_set("key").alias("keys"))

    # the first text of a doc_id is its part 0: a hash in every window row would be a third of what is shuffled
    firsts = kept.groupBy("doc_id").agg(F.min("part").alias("_first")).select(F.bitwise_not("doc_id").alias("_d"), "_first")
    hits = hits.join(firsts, F.bitwise_not(hits["doc_id"]) == F.col("_d")).select(
        "doc_id", "part", "keys", F.when(F.col("part") == F.col("_first"), 0).otherwise(F.col("part")).alias("_part"))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for batch in batches:
                for doc, text, keys, part in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3).to_pylist(), strict=True):
                    data = text.as_buffer()
                    begin, end, least, w = _hashes(data, length)
                    own = np.flatnonzero(np.isin(least, keys.values.to_numpy().view(np.uint64)))
                    # bytes to code points: all but continuation bytes count
                    points = np.zeros(len(data) + 1, np.int64)
                    np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80, out=points[1:])
                    yield w[own].view(np.int64), np.full(len(own), doc), np.full(len(own), part), own, points[begin[own]], points[end[own + length - 1]]

        yield from batches_of(["window", "doc_id", "part", "word", "start", "end"], each())

    # repeated rows are dropped before and in the one shuffle that also joins: whole texts cross the network once
    joined = rows.dropDuplicates(["doc_id", "part"]).join(hits, ["doc_id", "part"]).select("doc_id", "text", "keys", F.col("_part").alias("part"))
    windows = stage(joined.mapInArrow(extend, "window long, doc_id long, part long, word long, start long, end long"), "windows")
    release(kept)
    found = windows.groupBy("window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    found = found.select(F.bitwise_not("window").alias("_k"), "first")
    # as few and as small numbers as can be for the two shuffles: both places in one long, lengths and distances for ends and ids
    places = windows.select("window", "doc_id", "part", F.shiftleft("start", 32).bitwiseOR(F.col("word")).alias("at"),
                            (F.col("end") - F.col("start")).alias("chars"))
    w = places.join(found, F.bitwise_not(places["window"]) == F.col("_k")).select(
        "doc_id", "part", "at", "chars", (F.col("doc_id") - F.col("first")).alias("back")).repartition("doc_id", "part")
    w = w.select("doc_id", "part", F.col("at").bitwiseAND((1 << 32) - 1).alias("word"), F.shiftright("at", 32).alias("start"),
                 (F.shiftright("at", 32) + F.col("chars")).alias("end"), (F.col("doc_id") - F.col("back")).alias("first"))
    order = Window.partitionBy("doc_id", "part").orderBy("word")  # part: the texts of a doc_id
    w = w.withColumn("_new", (F.col("word") - F.lag("word").over(order) != 1).cast("int"))
    w = w.withColumn("_run", F.sum(F.coalesce("_new", F.lit(0))).over(order))
    return w.groupBy("doc_id", "part", "_run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.count(F.lit(1)) + length - 1).alias("text_words"),
        F.min("first").alias("first_doc_id")).drop("part", "_run")
