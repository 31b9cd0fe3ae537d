"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame functions only.

1. *Targets.* A source's share of all words follows its weight, but no source is asked for more than
   ``max_repeats`` times what it has; what it can't give is shared again among the others by weight.
2. *Blocks.* The documents of a source, shuffled by a hash, form one stream of words that is cut into equal blocks
   of at most ``BLOCK_WORDS`` words (to a word). A source gets as many slots of the mix as blocks make its target,
   rounded, at least one.
3. *Schedule.* Slot i of the mix has the golden-ratio point frac(i / phi), as an integer in units of 2^-62. The points, by rank, map through the
   sources' numbers of slots, so every source gets exactly its slots and every stretch of the mix already has the
   shares, up to a few slots. The k-th slot of a source takes its block k, starting over after the last block.
4. Slots and blocks are joined on (source, block).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from sluice.llm.common import WORD, running_sum, stage

#: Words of a block at most, whatever the corpus; a source of fewer words is one block.
BLOCK_WORDS = 64
#: Pieces of the slots' ranks by which they meet the sources' intervals.
CELLS = 4096
ROWS_PER_CHUNK = 20_000
#: 2^62 / phi, made odd: points are 62-bit integers, all different whatever the number of slots.
INVERSE_PHI = 2850178704830799621
_LOW = (1 << 31) - 1


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """(source, source_size, weight, target) from per-source word counts (source, source_size).

    Sources in code-point order (null last) take the weights in turn. Water-filling: a source is filled to
    level * weight, but to ``max_repeats`` times its size at most, with one level for all; sorted by
    limit / weight, those before some point are full, and the level follows from the rest. The windows run
    over one row per source.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turns = F.array(*[F.lit(float(w)) for w in weights])
    by_name = sizes.withColumn("weight", turns[F.pmod(F.row_number().over(place) - 1, F.lit(len(weights)))])
    s = by_name.withColumn("_limit", (F.col("source_size") * max_repeats).cast("double"))
    full = Window.orderBy(F.col("_limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    s = (s.withColumn("_total", F.sum("source_size").over(every).cast("double"))
         # the level if all sources from this one on aren't full
         .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
                     / F.sum("weight").over(after))
         .withColumn("_level", F.max(F.when(F.col("_level") * F.col("weight") <= F.col("_limit"), F.col("_level"))).over(every)))
    return s.select("source", "source_size", "weight",
                    F.least("_limit", F.coalesce(F.col("_level") * F.col("weight"), F.col("_limit"))).alias("target"))


def source_blocks(targets: DataFrame) -> DataFrame:
    """``targets`` plus blocks and slots of every source. Block b starts at word floor(b * source_size / blocks)."""
    t = targets.withColumn("blocks", F.ceil(F.col("source_size") / BLOCK_WORDS).cast("bigint"))
    slots = F.greatest(F.lit(1), F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("bigint"))
    return t.withColumn("slots", F.when((F.col("target") > 0) & (F.col("source_size") > 0), slots).otherwise(0))


def golden_point(slot: Column) -> Column:
    """slot * INVERSE_PHI modulo 2^62, from products of 31-bit halves, none of which overflows."""
    low, high = slot.bitwiseAND(_LOW), F.shiftright(slot, 31)
    middle = (low * (INVERSE_PHI >> 31) + high * (INVERSE_PHI & _LOW)).bitwiseAND(_LOW)
    return (low * (INVERSE_PHI & _LOW) + F.shiftleft(middle, 31)).bitwiseAND((1 << 62) - 1)


def schedule(shares: DataFrame, slots: int) -> DataFrame:
    """(slot, source, rank): the source of every slot of the mix, and the how-manieth of its source it is.

    ``shares`` has (source, slots), which add up to ``slots``."""
    spark = shares.sparkSession
    upto = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    width = max(1, math.ceil(slots / CELLS))
    spans = (shares.filter("slots > 0").withColumn("_hi", F.sum("slots").over(upto)).withColumn("_lo", F.col("_hi") - F.col("slots"))
             .withColumn("cell", F.explode(F.sequence(F.floor(F.col("_lo") / width), F.floor((F.col("_hi") - 1) / width))))
             .select("source", "_lo", "_hi", "cell"))
    pieces = max(1, math.ceil(slots / ROWS_PER_CHUNK))
    points = (spark.range(slots).withColumnRenamed("id", "slot").select("slot", golden_point(F.col("slot")).alias("point"), F.lit(1).cast("bigint").alias("_one"))
              .withColumn("_key", F.lit(0)).withColumn("_piece", F.shiftright(F.shiftright("point", 31) * pieces, 31).cast("int")))
    placed = (running_sum(points, ["_key"], "_piece", ["point", "slot"], "_one", "place")
              .withColumn("cell", F.floor(F.col("place") / width)))
    drawn = (placed.join(spans, "cell").filter("place >= _lo AND place < _hi")
             .select("slot", "source", F.floor(F.col("slot") / 8192).cast("int").alias("_chunk"), "_one"))
    return running_sum(stage(drawn, "slots"), ["source"], "_chunk", ["slot"], "_one", "rank").select("slot", "source", "rank")


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeats: int = 3, keep: Sequence[str] = ()):
    """Lays out the mix of ``docs`` (doc_id, text, source). Returns (rows, plan):

    * rows: one per row of ``docs``: row_id, doc_id, source, size, ``keep``..., source_size, target, taken
    * plan: (slot, source, block, row_id, from_word, to_word): the mix itself, slot by slot

    size counts the words of the text (null: 0). taken is the number of the row's words in the mix, repeats
    counted, and never exceeds ``max_repeats`` * size: a source has at most ``max_repeats`` slots a block. Null sources form one source. Rows without words take nothing.
    Repeated rows are rows of their own. The order of a source's stream is a hash of doc_id and size, so
    reruns agree. ``keep`` names further columns to hand through (they are staged).
    """
    mine = {"source", "size", "doc_id"}
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
                       *[F.col(c) for c in keep if c not in mine])
    rows = stage(rows.withColumn("row_id", F.monotonically_increasing_id()), "mix")
    n = rows.count()
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_blocks(source_targets(sizes, weights, max_repeats)), "targets")

    # the shuffled streams: a hash gives the order, its leading part the chunk
    chunks = max(1, math.ceil(n / ROWS_PER_CHUNK))
    order = F.shiftrightunsigned(F.xxhash64(F.lit(17), F.col("doc_id"), F.col("size")), 1)
    stream = (rows.filter("size > 0").select("row_id", "doc_id", "source", "size", order.alias("_h"))
              .withColumn("_chunk", F.floor(F.col("_h").cast("double") / float(1 << 63) * chunks).cast("int")))
    stream = running_sum(stream, ["source"], "_chunk", ["_h", "doc_id", "row_id"], "size", "_at")
    parts = targets.select(F.col("source").alias("_s"), F.col("source_size").alias("_n"), F.col("blocks").alias("_blocks"))
    cut = stream.join(parts, F.col("source").eqNullSafe(F.col("_s")))

    def block_of(word):  # the last block that starts at this word or before it
        return F.expr(f"((cast({word} as decimal(20, 0)) + 1) * _blocks - 1) div _n")

    def start(b):  # floor(b * _n / _blocks) without large products
        return F.expr(f"{b} * (_n div _blocks) + ({b} * (_n % _blocks)) div _blocks")

    blocks = (cut.withColumn("block", F.explode(F.sequence(block_of("_at"), block_of("(_at + size - 1)"))))
              .select("source", "block", "row_id",
                      F.greatest(start("block") - F.col("_at"), F.lit(0)).alias("from_word"),
                      F.least(start("(block + 1)") - F.col("_at"), F.col("size")).alias("to_word")))
    slots = schedule(targets.select("source", "slots"), targets.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0])
    slots = (slots.join(parts, F.col("source").eqNullSafe(F.col("_s")))
             .select("slot", "source", (F.col("rank") % F.col("_blocks")).alias("block")))

    def on_block(a, b):
        return a["block"].eqNullSafe(b["block"]) & a["source"].eqNullSafe(b["source"])

    used = slots.groupBy("source", "block").agg(F.count(F.lit(1)).alias("_uses"))
    taken = (blocks.join(used, on_block(blocks, used))
             .groupBy("row_id").agg(F.sum((F.col("to_word") - F.col("from_word")) * F.col("_uses")).alias("taken")))
    facts = targets.select(F.col("source").alias("_s"), "source_size", "target")
    out = (rows.join(taken, "row_id", "left").join(facts, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
           .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("bigint")))
    plan = (slots.join(blocks, on_block(slots, blocks))
            .select("slot", slots["source"].alias("source"), slots["block"].alias("block"), "row_id", "from_word", "to_word"))
    return out, plan


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """``docs`` as the mix takes them, whole: a row appears round(taken / size) times (half up), with its
    own columns. Rows of which less than half is taken go; rows without words have no place in a mix and go."""
    names = docs.columns
    data = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    rows, _ = mix(data, weights, max_repeats, keep=["_row"])
    times = F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2)).cast("int")
    rows = rows.filter("size > 0").withColumn("_times", times).filter("_times > 0")
    return rows.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*")


def mixing_digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``docs``."""
    rows, _ = mix(docs)
    return rows.select("doc_id", "size", "source_size", "target", "taken")
