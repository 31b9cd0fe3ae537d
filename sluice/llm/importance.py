"""Importance resampling towards a target distribution over hashed word n-grams.

Features of a text are its runs of 1 to ``n`` words. Every feature falls into one of ``buckets`` by its crc32. A
bucket's gain is the floored log ratio of its smoothed share in the target texts and in the corpus; a document's
weight is the floored mean of the gains over its features; Gumbel noise drawn from the document's id turns the
highest scores into a sample without replacement in which documents like the target are more likely.

Features are interned block by block in an open-addressed numpy table: slots are found by xxhash64 (all features of
a block at a time), equality is decided by the bytes, and a slot holds its bucket and its count. A document's
features are slot ids, through which counts are summed and gains are gathered. Corpus counts, of a fixed number of
buckets, are summed by Spark over all documents; only they reach the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sluice.llm.common import stage

BUCKETS = 10_000
#: Texts are joined up to about this many bytes (or one longer text); their words are interned this many at a time.
BLOCK_BYTES, BLOCK_WORDS = 4 << 20, 1 << 17

#: Bytes of words, with A-Z lower-cased; 0 elsewhere. All bytes of non-ASCII characters belong to words.
_WORD = np.zeros(256, np.uint8)
for _byte in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _WORD[_byte] = _byte
_WORD[0x41:0x5B] = _WORD[0x61:0x7B]

# The primes of xxhash64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                                  0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _crc_tables() -> np.ndarray:
    """crc32 of one byte with 0 to 7 zero bytes after it, from the reflected polynomial."""
    table = np.zeros((8, 256), np.uint64)
    table[0] = np.arange(256)
    for _ in range(8):
        table[0] = (table[0] >> np.uint64(1)) ^ np.where(table[0] & np.uint64(1), np.uint64(0xEDB88320), np.uint64(0))
    for k in range(1, 8):
        table[k] = table[0][table[k - 1] & np.uint64(255)] ^ (table[k - 1] >> np.uint64(8))
    return table


_CRC = _crc_tables()


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class Bytes:
    """Unaligned little-endian words of a byte array (padded by 16 zero bytes)."""

    def __init__(self, data: np.ndarray):
        self.data = data
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        self.raw = memoryview(padded)
        self.eight = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))
        self.four = np.ndarray(len(data) + 9, "<u4", padded, strides=(1,))
        self.one = padded

    def hashes(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """xxhash64 (seed 0) of data[start:start + size], all at a time; those of 32 bytes or more one by one."""
        h = size.astype(np.uint64) + _P5
        at = start.copy()
        short = size < 32
        for lane in range(3):
            i = np.flatnonzero(short & (size >= 8 * (lane + 1)))
            if len(i):
                k = _turn(self.eight[at[i]] * _P2, 31) * _P1
                h[i] = _turn(h[i] ^ k, 27) * _P1 + _P4
                at[i] += 8
        left = size & 7
        i = np.flatnonzero(short & (left >= 4))
        h[i] = _turn(h[i] ^ (self.four[at[i]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at[i] += 4
        for byte in range(3):
            i = np.flatnonzero(short & ((left & 3) > byte))
            h[i] = _turn(h[i] ^ (self.one[at[i]].astype(np.uint64) * _P5), 11) * _P1
            at[i] += 1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(~short).tolist():
            h[i] = xxhash.xxh64_intdigest(self.raw[start[i]: start[i] + size[i]])
        return h

    def crcs(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """crc32 of data[start:start + size]: eight bytes a step, then single bytes; those above 64 bytes one by one."""
        crc = np.full(len(start), 0xFFFFFFFF, np.uint64)
        at, short, full = start.copy(), size <= 64, np.uint64(255)
        for lane in range(8):
            i = np.flatnonzero(short & (size >= 8 * (lane + 1)))
            if not len(i):
                break
            x = self.eight[at[i]] ^ crc[i]
            step = _CRC[7][x & full]
            for k in range(1, 8):
                step ^= _CRC[7 - k][(x >> np.uint64(8 * k)) & full]
            crc[i] = step
            at[i] += 8
        left = size & 7
        for byte in range(7):
            i = np.flatnonzero(short & (left > byte))
            crc[i] = _CRC[0][(crc[i] ^ self.one[at[i]]) & full] ^ (crc[i] >> np.uint64(8))
            at[i] += 1
        crc ^= np.uint64(0xFFFFFFFF)
        for i in np.flatnonzero(~short).tolist():
            crc[i] = zlib.crc32(self.raw[start[i]: start[i] + size[i]])
        return crc.astype(np.int64)

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Are data[a:a + size] and data[b:b + size] the same bytes? Pairwise, in steps of eight bytes."""
        same = np.ones(len(a), bool)
        for lane in range(8):
            i = np.flatnonzero(same & (size > 8 * lane))
            if not len(i):
                return same
            spare = np.maximum(8 * (lane + 1) - size[i], 0).astype(np.uint64)  # bytes beyond the end, shifted out
            differ = (self.eight[a[i] + 8 * lane] ^ self.eight[b[i] + 8 * lane]) << (np.uint64(8) * spare)
            same[i] = differ == 0
        for i in np.flatnonzero(same & (size > 64)).tolist():
            same[i] = self.raw[a[i]: a[i] + size[i]] == self.raw[b[i]: b[i] + size[i]]
        return same


class NgramTable:
    """Open-addressed table of the n-grams of one block. A taken slot holds its key, the occurrence that took it,
    its bucket and its count."""

    def __init__(self, data: Bytes, occurrences: int, buckets: int):
        self.data, self.buckets = data, buckets
        slots = 1 << max(4, int(2 * occurrences).bit_length())  # load of at most a half
        self.mask = slots - 1
        self.key = np.zeros(slots, np.uint64)
        self.first = np.full(slots, -1, np.int32)
        self.bucket = np.zeros(slots, np.int64)
        self.count = np.zeros(slots, np.int64)

    def intern(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The slot of every occurrence; its bucket is set when the slot is taken, its count grows by one."""
        key = self.data.hashes(start, size)
        slot = (key & np.uint64(self.mask)).astype(np.int64)
        open_ = np.arange(len(key), dtype=np.int32)
        while len(open_):
            own = slot[open_]
            free = self.first[own] < 0
            if free.any():
                claim, at = open_[free], own[free]
                self.first[at] = claim  # of several claims of a slot one stays; the others find it taken
                won = self.first[at] == claim
                claim, at = claim[won], at[won]
                self.key[at] = key[claim]
                self.bucket[at] = self.data.crcs(start[claim], size[claim]) % self.buckets
            holder = self.first[own]
            found = self.key[own] == key[open_]
            other = found & (holder != open_)  # the same key: are the bytes the same too?
            a, b = holder[other], open_[other]
            same = size[a] == size[b]
            same[same] = self.data.equal(start[a[same]], start[b[same]], size[a[same]])
            found[other] = same
            open_ = open_[~found]
            slot[open_] = (slot[open_] + 1) & self.mask
        self.count += np.bincount(slot, minlength=self.mask + 1)
        return slot


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(normalised bytes: words with one separator after each, place of the first byte of every text, and the end)."""
    texts = texts.cast(pa.large_binary())
    _, offsets, values = texts.buffers()
    at = np.frombuffer(offsets, "<i8")[texts.offset: texts.offset + len(texts) + 1]
    data = _WORD[np.frombuffer(values, np.uint8)[at[0]: at[-1]]] if values is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    inside = data != 0
    # a separator is kept after every word; where a text ends within a word, one is put in
    follows = np.zeros(len(data), bool)
    follows[1:] = inside[:-1]
    follows[at[:-1][at[:-1] < len(data)]] = False
    keep = inside | follows
    ends = at[1:][(at[1:] > at[:-1])]
    ends = ends[inside[ends - 1]]
    kept = np.concatenate([[0], np.cumsum(keep)])
    norm = np.insert(data[keep], kept[ends], 0) if len(ends) else data[keep]
    return norm, kept[at] + np.searchsorted(ends, at, "left") + np.isin(at, ends)


def _bounds(norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word of normalised bytes (every word has one separator after it)."""
    ends = np.flatnonzero(norm == 0)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    return starts, ends


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    first, held = 0, 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        if held and held + size > BLOCK_BYTES:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def _interned(texts: pa.Array, n: int, buckets: int):
    """Yields (table, slots, text of every slot id) block by block; lastly the words of every text."""
    norm, begin = _joined(texts)
    starts, ends = _bounds(norm)
    owner = np.searchsorted(begin, starts, "right") - 1 if len(starts) else np.zeros(0, np.int64)
    norm[norm == 0] = 0x20
    data = Bytes(norm)
    for lo in range(0, len(starts), BLOCK_WORDS):
        hi = min(lo + BLOCK_WORDS, len(starts))
        first, last, doc = [], [], []
        for k in range(n):  # runs of k + 1 words that start in this block; they may end in the next
            i = np.arange(lo, min(hi, len(starts) - k))
            i = i[owner[i] == owner[i + k]]
            first.append(starts[i])
            last.append(ends[i + k])
            doc.append(owner[i])
        first, last, doc = np.concatenate(first), np.concatenate(last), np.concatenate(doc)
        table = NgramTable(data, len(first), buckets)
        yield table, table.intern(first, last - first), doc
    return np.bincount(owner, minlength=len(texts))


def _text_column(docs: DataFrame):
    return F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")


def bucket_counts(texts: DataFrame, n: int = 2, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows of ``texts`` (column text) by bucket. A task sums its own; Spark sums over the tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            column = batch.column(0)
            for i, j in _blocks(column):
                for table, _, _ in _interned(column.slice(i, j - i), n, buckets):
                    used = np.flatnonzero(table.count)
                    np.add.at(total, table.bucket[used], table.count[used])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int64()), "n": pa.array(total[some], pa.int64())})

    found = texts.select(_text_column(texts)).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():  # at most one row a bucket
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(ratio)) per bucket of the target's share to the corpus's, each count plus one."""
    s, t, buckets = corpus.astype(float), target.astype(float), len(corpus)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


OWN = ("n_words", "n_features", "weight", "score")


def weighted(docs: DataFrame, gain: np.ndarray, n: int = 2, seed: int = 7, keep_text: bool = True) -> DataFrame:
    """``docs`` plus n_words, n_features, weight and score. Columns named like these are replaced.

    Null text has no words; a text without words has weight 0. Noise comes from the sha256 of ``seed:doc_id``, so
    rows of one doc_id share theirs; a null doc_id counts as an empty one. Repeated rows stay.
    """
    kept = [c for c in docs.columns if c not in {*OWN, "rank", "text"}]
    out = [*kept, "text"] if keep_text else kept
    rows = docs.select(*kept, _text_column(docs))
    schema = T.StructType([*[rows.schema[c] for c in out], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for i, j in _blocks(column):
                features, total = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
                blocks = _interned(column.slice(i, j - i), n, len(gain))
                while True:
                    try:
                        table, slots, doc = next(blocks)
                    except StopIteration as end:
                        words = end.value
                        break
                    features += np.bincount(doc, minlength=j - i)
                    np.add.at(total, doc, gain[table.bucket[slots]])
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in out], *[pa.array(x, pa.int64()) for x in (words, features, weight)]],
                    [*out, "n_words", "n_features", "weight"])

    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(hashed, 1, 8), 16, 10).cast("bigint").cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(u)))
    return rows.mapInArrow(weigh, schema).withColumn("score", F.col("weight") + noise)


def ranked(scored: DataFrame, rate: int = 25, min_words: int = 20) -> DataFrame:
    """``scored`` plus rank: 1, 2, 3 ... by falling score, then doc_id (null first), over the floor(rate * N / 100) best of
    the N rows with at least ``min_words`` words; null elsewhere.

    Rows are range-partitioned and sorted; a range's first rank follows from the counts of the ranges before it, so no
    task ranks all rows. Rows of equal score and doc_id follow their weight, n_features and place in the input.
    """
    spark = scored.sparkSession
    fits = F.col("n_words") >= min_words
    order = [F.col("_fits").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("weight").asc(),
             F.col("n_features").asc(), F.col("_row").asc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # staged first: finding the ranges reads the rows once more, which must not weigh the texts again
    held = stage(scored.withColumns({"_fits": fits, "_row": F.monotonically_increasing_id()}), "importance-scores")
    dealt = stage(held.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                  .withColumn("_part", F.spark_partition_id()), "importance")
    sizes = dealt.groupBy("_part").agg(F.count_if("_fits").alias("n")).orderBy("_part").collect()  # one row a partition
    drawn = rate * sum(r.n for r in sizes) // 100
    base, before = {}, 0
    for r in sizes:
        base[r._part] = before
        before += r.n
    bases = spark.createDataFrame([(p, b) for p, b in base.items()], "_part int, _base long")
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    place = F.col("_base") + within
    return (dealt.join(F.broadcast(bases), "_part")  # as many rows as partitions
            .withColumn("rank", F.when(F.col("_fits") & (place <= drawn), place).cast("bigint"))
            .drop("_part", "_base", "_row", "_fits"))


def importance_scores(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = BUCKETS, rate: int = 25, min_words: int = 20,
                      seed: int = 7, keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with n_words, n_features, weight, score and rank (null if not drawn), towards the texts of
    ``target``. An empty ``docs`` gives no row; an empty ``target`` prefers rare buckets, as the formula has it."""
    gain = gains(bucket_counts(docs, n, buckets), bucket_counts(target, n, buckets))
    return ranked(weighted(docs, gain, n, seed, keep_text), rate, min_words)


def resample(docs: DataFrame, target: DataFrame, **kwargs) -> DataFrame:
    """The drawn rows of ``docs``, all their columns, with weight, score and rank."""
    return importance_scores(docs, target, **kwargs).filter(F.col("rank").isNotNull())


def importance_digest(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return importance_scores(rows, target, keep_text=False).select("doc_id", "n_features", "weight", "score", "rank")


#: The same digest as DuckDB SQL. crc32 is computed byte by byte from its polynomial.
_FEATURES = """
    SELECT id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
    FROM (SELECT id, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {rows})"""
IMPORTANCE_SQL = f"""
    WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
    b AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS t FROM benchmark),
    df AS ({_FEATURES.format(rows='d')}), bf AS ({_FEATURES.format(rows='b')}),
    tab AS (SELECT list(c ORDER BY i) AS tab FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) r(i))),
    words AS (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)),
    crc AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(f)), lambda i:
                      CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
                      lambda c, x: xor(tab[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
            FROM (SELECT f, hex(encode(f)) AS h, tab FROM words, tab)),
    s AS (SELECT bucket, count(*) AS n FROM df JOIN crc USING (f) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS n FROM bf JOIN crc USING (f) GROUP BY bucket),
    gain AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
                    / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS g FROM s LEFT JOIN t USING (bucket)),
    per AS (SELECT id, count(*) AS n, floor(sum(g) / count(*)) AS w FROM df JOIN crc USING (f) JOIN gain USING (bucket) GROUP BY id),
    sc AS (SELECT d.doc_id, coalesce(per.n, 0) AS n_features, CAST(coalesce(per.w, 0) AS BIGINT) AS weight,
                  CAST(coalesce(per.w, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                       / 4294967296::DOUBLE))) AS BIGINT) AS score,
                  coalesce(per.n, 0) >= 39 AS fits  -- 20 words have 39 runs of one or two words
           FROM d LEFT JOIN per USING (id)),
    rk AS (SELECT *, CASE WHEN fits THEN row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) END AS place FROM sc)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN place <= (SELECT 25 * count(*) // 100 FROM sc WHERE fits) THEN place END AS rank FROM rk"""
