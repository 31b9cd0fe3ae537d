"""Exact n-gram Jaccard join over equal parts of sets.

A text's set holds its distinct word n-grams, as 64-bit hashes. Equal sets form one class; only classes are
compared. Linked sets differ in at most d = (1 - t) / (1 + t) of the sum of their sizes. Grams fall into m parts by
hash, m above the largest d of a size class, so at least m - d parts of a linked pair hold the same grams. A set is
indexed under its parts with all their grams as one key, so unrelated sets that share common grams don't meet: they
would have to share all of a part and have nothing else there.

* Of its m parts a set only needs its d + 1 first ones in an order that both sides follow (of the m - d common ones,
  one is among the first d + 1 of each side). The order starts with the parts whose grams are the rarest together, by the
  frequency class of their hash; empty parts and those of few or frequent grams come last.
* m belongs to a size class, the sizes of equal bit length. A set is indexed under its own class and under that of
  the largest set it can be linked to.

Buckets are not expanded into all pairs. Every member is first verified against few pivots of its buckets;
links give components. Where large buckets still hold several, rounds follow in which members meet a bucket's most
linked one that is of another component, so that a large group whose members are only linked in chains becomes one
component by pairs in proportion to its rows. Members of different components in one bucket are then paired
and verified, so the components are those of all links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from sluice.llm.common import release, stage
from sluice.llm.components import components
from sluice.llm.hashing import batches_of, word_bounds, word_hashes

#: Classes by hash whose frequencies tell rare grams from frequent ones.
CLASSES = 1 << 16
#: Parts beyond those that a linked pair can differ in, as a share of these: as many of the least telling are left out.
SPARE = 0.2
PIVOTS = 4
#: Further rounds of pivots while the buckets that hold several components have more pairs than this many a row.
#: A round is the last if a smaller share of its pairs are links.
PAIRS_A_ROW, ROUNDS, YIELD = 128, 2, 0.1
BINS = 256
#: Parity bits of a set: a power of two of about its size, at most this many; sets of up to ``BINS`` grams have ``odd`` alone.
MOST_BITS = 1 << 15
#: Bits in one of Spark's bitmaps, and the most bits by which the texts of the index are told from others.
MARKS, MOST_MARKS = 1 << 15, 1 << 26
#: Smallest keys a row carries, by which most pairs are met under one of their common keys only.
LOWEST = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PART = np.uint64(0xC2B2AE3D27D4EB4F)


def grams(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams; the whole sequence if it has fewer words.

    ``bytes.lower`` knows A-Z only."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    begin, end = word_bounds(data)
    if not len(begin):
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        h = word_hashes(data, begin, end)
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = (out ^ h[i: len(h) - k + 1 + i]) * _MIX
            out ^= out >> np.uint64(29)
    return np.unique(out)


def _set_id(g: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(g.tobytes(), digest_size=8).digest(), "little", signed=True)


def gram_sets(docs: DataFrame, n: int) -> tuple[DataFrame, np.ndarray]:
    """Per row (doc_id, sid, n_shingles, text_hash), staged, and the gram counts of the ``CLASSES`` classes over all rows
    (an array of fixed size, summed per partition before the shuffle)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES, np.int64)
        for batch in batches:
            sets = [grams(t, n) for t in batch.column(1).to_pylist()]
            for g in sets:
                counts += np.bincount((g >> np.uint64(48)).astype(np.int64), minlength=CLASSES) if len(g) > CLASSES else 0
                if len(g) <= CLASSES:
                    np.add.at(counts, (g >> np.uint64(48)).astype(np.int64), 1)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "sid": pa.array([_set_id(g) for g in sets], pa.int64()),
                "n_shingles": pa.array([len(g) for g in sets], pa.int64()), "text_hash": batch.column(2),
                "class": pa.nulls(len(sets), pa.int32()), "n": pa.nulls(len(sets), pa.int64())})
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.nulls(len(seen), pa.int64()), "sid": pa.nulls(len(seen), pa.int64()), "n_shingles": pa.nulls(len(seen), pa.int64()),
            "text_hash": pa.nulls(len(seen), pa.int64()), "class": pa.array(seen, pa.int32()), "n": pa.array(counts[seen], pa.int64())})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    out = stage(rows.mapInArrow(scan, "doc_id long, sid long, n_shingles long, text_hash long, class int, n long"), "gram-sets")
    counts = np.zeros(CLASSES, np.int64)
    for c, k in out.filter("class IS NOT NULL").groupBy("class").agg(F.sum("n")).collect():
        counts[c] = k
    return out.filter("class IS NULL").select("doc_id", "sid", "n_shingles", "text_hash"), counts


def gram_weights(counts: np.ndarray) -> np.ndarray:
    """What sharing a gram of each class tells, in sixteenths of a bit; none is rarer than one in ``CLASSES``."""
    share = np.log2(max(1, counts.sum()) / np.maximum(counts, 1))
    return np.rint(16 * np.clip(share, 0, math.log2(CLASSES))).astype(np.int64)


def _differ(total: int, per_cent: int) -> int:
    """The most grams in which linked sets of so many grams together differ."""
    return (100 - per_cent) * total // (100 + per_cent)


def index_keys(g: np.ndarray, weights: np.ndarray, t: float) -> np.ndarray:
    """The keys under which a set is indexed (see the module's head)."""
    n, per_cent = len(g), round(t * 100)
    if (n + 1) * per_cent > 100 * n:  # no other set can be close enough
        return np.empty(0, np.uint64)
    largest = 100 * n // per_cent
    weight = weights[(g >> np.uint64(48)).astype(np.int64)]
    keys = []
    with np.errstate(over="ignore"):
        h = g * _MIX
        h ^= h >> np.uint64(32)
        for size in range(n.bit_length(), largest.bit_length() + 1):
            top = (1 << size) - 1
            # both sides must agree on the parts, so they follow from the size class alone
            parts = math.ceil((1 + SPARE) * (_differ(2 * top, per_cent) + 1))
            part = ((h >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)
            key = np.zeros(parts, np.uint64)
            np.add.at(key, part, h)
            key = (key ^ np.arange(1, parts + 1, dtype=np.uint64) * _PART ^ np.uint64(size << 56)) * _MIX
            key ^= key >> np.uint64(31)
            # sums of whole numbers: equal parts have equal ones
            tells = np.bincount(part, weights=weight, minlength=parts)
            keys.append(key[np.lexsort((key, -tells))[: _differ(n + min(largest, top), per_cent) + 1]])
    return np.unique(np.concatenate(keys))


def _signatures(texts: DataFrame, n: int) -> DataFrame:
    """(sid, n, odd, fine): a class's grams counted in ``BINS`` bins by hash, and the bins with odd counts as bits of
    longs, for ``BINS`` bins and for about as many as the set has grams. Sets differ in at least as many grams as bins
    are odd in one only, which proves most unrelated pairs apart without their texts: unrelated sets differ in half of
    the bits, and linked ones in a small share of their sizes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [grams(x, n) for x in batch.column(1).to_pylist()]
            counts = [np.bincount((g % np.uint64(BINS)).astype(np.int64), minlength=BINS) for g in sets]
            odd = [np.packbits((c & 1).astype(np.uint8)).view(np.int64) for c in counts]
            yield pa.RecordBatch.from_pydict({"sid": batch.column(0), "n": pa.array([len(g) for g in sets], pa.int32()),
                                              "odd": pa.array(odd, pa.list_(pa.int64())),
                                              "fine": pa.array([_parities(g) for g in sets], pa.list_(pa.int64()))})

    return texts.select("sid", "text").mapInArrow(count, "sid long, n int, odd array<bigint>, fine array<bigint>")


def _parities(g: np.ndarray) -> np.ndarray | None:
    """The bins with odd counts as bits, for a power of two of bins; None for small sets."""
    bits = min(MOST_BITS, 1 << max(len(g) - 1, 0).bit_length())
    if bits <= BINS:
        return None
    counts = np.bincount((g % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _near(x: str, y: str, t: float):
    """Whether the odd bins of two aliased rows (n, odd) allow a similarity of at least ``t``."""
    differ = sum((F.bit_count(F.col(f"{x}.odd")[i].bitwiseXOR(F.col(f"{y}.odd")[i])) for i in range(BINS // 64)), F.lit(0))
    most = (F.col(f"{x}.n") + F.col(f"{y}.n")) * (1 - t) + 1e-6
    # with as many bins as the smaller array has: bits of the larger one that fall into one bin are added (XOR)
    bits = F.least(F.size(f"{x}.fine"), F.size(f"{y}.fine"))

    def folded(side: str, i):
        own = F.col(f"{side}.fine")
        return F.aggregate(F.sequence(i, F.size(own) - 1, bits), F.lit(0).cast("bigint"), lambda a, k: a.bitwiseXOR(F.get(own, k)))

    fine = F.aggregate(F.sequence(F.lit(0), bits - 1), F.lit(0),
                       lambda a, i: a + F.bit_count(folded(x, i).bitwiseXOR(folded(y, i))))
    either_small = F.col(f"{x}.fine").isNull() | F.col(f"{y}.fine").isNull()
    return (differ * (1 + t) <= most) & (either_small | (fine * (1 + t) <= most))


def _possible(pairs: DataFrame, sigs: DataFrame, t: float) -> DataFrame:
    """The pairs (a, b) that their signatures don't prove apart."""
    x, y = sigs.alias("x"), sigs.alias("y")
    full = pairs.select("a", "b").join(x, F.col("a") == F.col("x.sid")).join(y, F.col("b") == F.col("y.sid"))
    return stage(full.filter(_near("x", "y", t)).select("a", "b"), "possible")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, t: float) -> DataFrame:
    """The pairs (a, b) of classes whose Jaccard similarity is at least ``t``. The texts of a pair's classes
    are joined on; Spark splits a pivot with very many partners."""
    full = pairs.join(texts.select(F.col("sid").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("sid").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
    per_cent = round(t * 100)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            a, b, ta, tb = (c.to_pylist() for c in batch.columns)
            good = []
            for i in range(len(a)):
                if last[0] != b[i]:
                    last = (b[i], grams(tb[i], n))
                x, y = grams(ta[i], n), last[1]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= per_cent * (len(x) + len(y) - common):
                    good.append(i)
            yield pa.RecordBatch.from_pydict({"a": pa.array([a[i] for i in good], pa.int64()), "b": pa.array([b[i] for i in good], pa.int64())})

    return stage(full.mapInArrow(check, "a long, b long"), "links")


def _marked(rows: DataFrame, involved: DataFrame) -> DataFrame:
    """The ``rows`` (doc_id, text, h) whose h may be a text_hash of ``involved``: those whose bit is set in a bitmap with
    16 bits a row (of ``MOST_MARKS`` at most, from where more rows pass), so that few other texts are shuffled."""
    bits = min(MOST_MARKS, max(MARKS, 1 << (16 * involved.count()).bit_length()))
    slot = F.pmod(F.col("text_hash"), F.lit(bits))
    marks = np.zeros(bits // 8, np.uint8)
    for at, some in (involved.groupBy(F.shiftright(slot, MARKS.bit_length() - 1).alias("at"))
                     .agg(F.bitmap_construct_agg(F.pmod(slot, F.lit(MARKS)))).collect()):
        marks[at * MARKS // 8: (at + 1) * MARKS // 8] = np.frombuffer(some, np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(marks)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        for batch in batches:
            at = batch.column(2).to_numpy() & (bits - 1)
            yield batch.filter(pa.array((marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1, pa.bool_()))

    return rows.mapInArrow(marked, "doc_id long, text string, h long")


def _round(labelled: DataFrame, mixed: DataFrame, links: DataFrame, done: DataFrame, turn: int, t: float) -> DataFrame:
    """New pairs (a, b) of different components: the members of every mixed bucket with its pivot of this turn, the one
    that linked to most pivots so far and was none itself; at most one pair a row of the index."""
    linked = links.groupBy(F.col("a").alias("sid")).agg(F.count(F.lit(1)).alias("linked"))
    used = done.select(F.col("pivot").alias("sid")).distinct().withColumn("used", F.lit(True))
    rows = labelled.join(mixed.select("key"), "key").join(linked, "sid", "left").join(used, "sid", "left")
    rank = F.struct(F.col("used").isNull().alias("fresh"), F.coalesce("linked", F.lit(0)).alias("linked"),
                    F.xxhash64("sid", F.lit(PIVOTS + turn)).alias("h"), "sid", "n", "root")
    pivots = rows.groupBy("key").agg(F.max(rank).alias("p"))
    pairs = labelled.join(pivots.select("key", F.col("p.sid").alias("b"), F.col("p.n").alias("m"), F.col("p.root").alias("other")), "key")
    pairs = (pairs.filter((F.col("root") != F.col("other")) & (F.least("n", "m") >= F.greatest("n", "m") * t - 1e-6))
             .select(F.col("sid").alias("a"), "b").distinct())
    # each way round: a pair may have been met with the other row as the pivot
    known = done.select("a", "b").union(done.select("b", "a"))
    return stage(pairs.join(known, ["a", "b"], "left_anti"), "pairs")


def near_duplicates(docs: DataFrame, n: int = 4, t: float = 0.85) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    Two documents link when the Jaccard similarity of their sets of word ``n``-grams (A-Z lower-cased) is at
    least ``t``, decided in integers. component_id is the smallest doc_id reachable by links, itself included.
    Null text and texts without words have the empty set and link with nothing. Rows with equal sets are one
    class, whatever their number. A null doc_id counts as larger than any other.
    """
    sets, counts = gram_sets(docs, n)
    some = sets.filter("n_shingles > 0").groupBy("sid", "n_shingles").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash")).alias("at"))
    some = some.select("sid", "n_shingles", F.col("at.doc_id").alias("first"), F.col("at.text_hash").alias("text_hash"))
    classes = stage(some, "classes")
    shared = docs.sparkSession.sparkContext.broadcast(gram_weights(counts))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, seen = shared.value, set()

        def each():
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    g = grams(text, n)
                    sid = _set_id(g)
                    if not len(g) or sid in seen:  # copies have the same keys
                        continue
                    seen.add(sid)
                    keys = index_keys(g, weights, t)
                    if len(keys):
                        yield keys.view(np.int64), np.full(len(keys), sid), np.full(len(keys), len(g), np.int32)

        yield from batches_of(["key", "sid", "n"], each())

    # keys of one class only can't link anything; those of copies fall together
    keys = docs.select("text").mapInArrow(index, "key long, sid long, n int")
    same = Window.partitionBy("key")
    shared_keys = keys.withColumn("lo", F.min("sid").over(same)).withColumn("hi", F.max("sid").over(same)).filter("lo <> hi")
    keys = stage(shared_keys.select("key", "sid", "n").distinct(), "index")

    # few pivots a key: the smallest by one of several hashes, chosen by the key
    turn = F.pmod(F.col("key"), F.lit(PIVOTS))
    pivots = keys.groupBy("key").agg(F.min(F.struct(F.xxhash64("sid", turn).alias("h"), "sid", "n")).alias("p"))
    pairs = (keys.join(pivots.select("key", F.col("p.sid").alias("b"), F.col("p.n").alias("m")), "key")
             .filter((F.col("sid") != F.col("b")) & (F.least("n", "m") >= F.greatest("n", "m") * t - 1e-6))
             .select(F.col("sid").alias("a"), "b").distinct())
    pairs = stage(pairs, "pairs")
    # one text per class that takes part: that of its first row, which may have no doc_id or share it with other texts
    first = classes.select("sid", "first", "text_hash")
    involved = stage(keys.select("sid").distinct().join(first, "sid"), "involved")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    texts = (_marked(rows, involved).join(involved, (F.col("h") == F.col("text_hash")) & F.col("doc_id").eqNullSafe(F.col("first")))
             .groupBy("sid").agg(F.min("text").alias("text")))
    texts = stage(texts, "texts")
    release(involved)
    sigs = stage(_signatures(texts, n), "signatures")
    possible = _possible(pairs, sigs, t)
    links = _verified(possible, texts, n, t)
    roots = stage(components(links), "roots")

    done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("b").alias("pivot"))
    spent = [possible, pairs]
    last = False
    for turn in range(ROUNDS + 1):
        labelled = stage(keys.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid")), "labelled")
        mixed = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size"))
        mixed = stage(mixed.filter("lo <> hi").select("key", "size"), "mixed")
        rows, left = mixed.agg(F.sum("size"), F.sum(F.col("size") * (F.col("size") - 1) / 2)).first()
        if last or turn == ROUNDS or not rows or left <= PAIRS_A_ROW * rows:
            break
        pairs = _round(labelled, mixed, links, done, turn, t)
        possible = _possible(pairs, sigs, t)
        found = _verified(possible, texts, n, t)
        spent += [labelled, mixed, possible, pairs]
        new = found.count()
        if not new:
            break
        last = new < YIELD * pairs.count()  # most of the buckets' other members are not linked to any pivot
        done = done.union(pairs.select(F.least("a", "b"), F.greatest("a", "b"), F.col("b")))
        spent.append(found)
        links = links.union(found)
        roots = stage(components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(found)), "roots")
    mixed = mixed.select("key")
    # A pair is passed over under a key if both rows know a smaller key they share. Under the smallest shared key there
    # is none, so every pair is met. (A key left out above holds one component only, so no pair of two.)
    lowest = keys.groupBy("sid").agg(F.slice(F.array_sort(F.collect_set("key")), 1, LOWEST).alias("low"))
    marks = sigs.select("sid", "odd", "fine").join(lowest, "sid")
    open_ = labelled.join(mixed, "key").join(marks, "sid").withColumn("low", F.filter("low", lambda k: k < F.col("key")))
    open_ = stage(open_, "open")
    x, y = open_.alias("x"), open_.alias("y")
    rest = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.sid") < F.col("y.sid")) & (F.col("x.root") != F.col("y.root"))
                   & (F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * t - 1e-6) & _near("x", "y", t)
                   & ~F.arrays_overlap("x.low", "y.low"))
            .select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b")).distinct())
    rest = stage(rest.join(done.drop("pivot"), ["a", "b"], "left_anti"), "rest")
    release(open_, labelled, mixed, links, keys, sigs, *spent)
    more = _verified(rest, texts, n, t)
    release(rest, texts)
    merged = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    # a component's name is the smallest doc_id of its classes
    named = classes.join(merged.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    names = named.join(smallest, "root").select("sid", "component_id")
    return (sets.join(names.withColumnRenamed("sid", "s"), (F.col("sid") == F.col("s")) & (F.col("n_shingles") > 0), "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def deduplicate(docs: DataFrame, n: int = 5, t: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group (rows that repeat it stay once); rows
    without words or without doc_id stay. Five words and 0.8 are the general values; op9's are its own."""
    found = near_duplicates(docs, n, t)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti").dropDuplicates(docs.columns)
