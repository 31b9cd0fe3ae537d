"""Best-fit packing of documents into sequences by a configuration linear program.

Documents become pieces of at most ``capacity`` tokens; what is packed is the histogram of piece lengths
(``capacity`` numbers, whatever the corpus). A configuration is a set of lengths that fits one sequence. The
linear program "least configurations that cover the histogram" has too many columns to write down, so
multiplicative weights solve it: each length has a price, each round a knapsack dynamic program finds the
configuration of the highest price, and prices of the lengths it holds fall. The configurations' averages
are rounded down; the few pieces left over are packed best-fit, largest first.

Configurations are then filled in Spark: pieces of a length are numbered, and the number decides sequence and
place. Only the histogram and the plan (both bounded by the capacity, not by the corpus) are on the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.common import running_sum, stage
from sluice.llm.tokens import encoder, tokenizer_path

CAPACITY = 2048
#: Rounds of multiplicative weights; each is one dynamic program over the capacity.
ROUNDS = 100
ROWS_PER_CHUNK = 20_000
END = 0
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, row_id long"
PLACED = PIECE + ", sequence_id long, offset long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """One row per piece of every row of ``docs``: its ids and an end id, cut only if longer than ``capacity``
    (then the first piece takes the remainder and the others are full). Null text is empty (one end id)."""
    path = tokenizer or tokenizer_path()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row_id"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            out = [[] for _ in range(6)]
            for doc, text, row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids = np.frombuffer(enc.encode(text), enc.dtype).astype("<u4").tobytes() + bytes(4)
                n, at, k = len(ids) // 4, 0, 0
                while at < n:
                    size = min(n - at, (n - at) % capacity or capacity)
                    for col, v in zip(out, (doc, k, at, size, zlib.crc32(ids[at * 4:(at + size) * 4]), row), strict=True):
                        col.append(v)
                    at, k = at + size, k + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(out)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "row_id"])

    return rows.mapInArrow(cut, PIECE)


def best_configuration(price: np.ndarray, lengths: np.ndarray, most: np.ndarray, capacity: int) -> dict[int, int]:
    """Knapsack by dynamic programming: the multiset of lengths with the highest total price that fits, with
    at most ``most`` of each. ``price`` and ``most`` go with ``lengths`` (ascending). A length may repeat:
    its copies are offered in powers of two, so a repetition costs a logarithm."""
    best = np.zeros(capacity + 1)
    steps = []
    for k in np.argsort(-price / lengths, kind="stable"):
        size, left, part = int(lengths[k]), min(int(most[k]), capacity // int(lengths[k])), 1
        while left > 0:
            take = min(part, left)
            weight, gain = take * size, take * price[k]
            tried = best[:-weight] + gain
            better = tried > best[weight:] + 1e-15
            if better.any():
                steps.append((k, take, weight, np.flatnonzero(better) + weight))
                best[weight:][better] = tried[better]
            left, part = left - take, part * 2
    out: dict[int, int] = {}
    room = capacity
    for k, take, weight, improved in reversed(steps):
        i = np.searchsorted(improved, room)
        if i < len(improved) and improved[i] == room:
            out[int(lengths[k])] = out.get(int(lengths[k]), 0) + take
            room -= weight
    return out


def fractional(counts: dict[int, int], capacity: int, rounds: int = ROUNDS) -> list[tuple[float, dict[int, int]]]:
    """Multiplicative weights for the covering program: (copies, configuration), one pair a round. The price of
    a length falls exponentially with the share of its demand that is covered. A round takes as many copies as
    cover the tightest length of its configuration, the largest step that overcovers nothing. ``rounds`` bounds
    the driver's work; what they leave uncovered goes to the rounding step like other remainders."""
    lengths = np.array(sorted(counts))
    demand = np.array([counts[int(s)] for s in lengths], float)
    at = {int(s): i for i, s in enumerate(lengths)}
    covered, chosen = np.zeros(len(lengths)), []
    rate = 2 * math.log(len(lengths) + 1)
    for _ in range(rounds):
        open_ = np.flatnonzero((1 - covered) * demand >= 1)
        if not len(open_):
            break
        left = (1 - covered[open_]) * demand[open_]
        # large pieces are the hard ones to place: their demand weighs more than their length
        price = np.exp(-rate * (covered[open_] - covered[open_].min())) * (lengths[open_] / capacity) ** 1.1
        conf = best_configuration(price, lengths[open_], np.floor(left + 1e-9), capacity)
        copies = min((1 - covered[at[s]]) * demand[at[s]] / m for s, m in conf.items())
        for s, m in conf.items():
            covered[at[s]] += copies * m / demand[at[s]]
        chosen.append((copies, conf))
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[int, dict[int, int]]]:
    """(sequences, configuration) pairs that use every piece of the histogram exactly once: the rounded program
    or, where rounding a small histogram costs more than the program gains, best fit alone."""
    return min((_rounded(counts, capacity, r) for r in (rounds, 0)), key=lambda p: sum(n for n, _ in p))


def _rounded(counts: dict[int, int], capacity: int, rounds: int) -> list[tuple[int, dict[int, int]]]:
    left = {s: n for s, n in counts.items() if n > 0}
    out: list[tuple[int, dict[int, int]]] = []

    def use(times: int, conf: dict[int, int]) -> None:
        for s, m in conf.items():
            left[s] -= times * m
            if not left[s]:
                del left[s]
        out.append((times, conf))

    full = left.get(capacity, 0)
    if full:
        use(full, {capacity: 1})
    for copies, conf in sorted(fractional(dict(left), capacity, rounds), key=lambda x: (-sum(s * m for s, m in x[1].items()), -x[0])):
        times = min([int(copies + 1e-9), *(left.get(s, 0) // m for s, m in conf.items())])
        # a configuration that leaves room open is better filled by what is left
        if times > 0 and sum(s * m for s, m in conf.items()) == capacity:
            use(times, conf)
    while left:  # best fit, largest first, many equal sequences at a time
        sizes = np.array(sorted(left))
        conf, room = {}, capacity
        while True:
            i = int(np.searchsorted(sizes, room, side="right")) - 1
            while i >= 0 and conf.get(int(sizes[i]), 0) >= left[int(sizes[i])]:
                i -= 1
            if i < 0:
                break
            s = int(sizes[i])
            m = min(room // s, left[s] - conf.get(s, 0))
            conf[s] = conf.get(s, 0) + m
            room -= m * s
        use(min(left[s] // m for s, m in conf.items()), conf)
    return out


def _slots(configurations: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """length -> rows (first number, first sequence, pieces per sequence, offset of the first) in order."""
    slots: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for times, conf in configurations:
        offset = 0
        for s, m in sorted(conf.items(), reverse=True):
            slots.setdefault(s, []).append((taken.get(s, 0), sequence, m, offset))
            taken[s] = taken.get(s, 0) + times * m
            offset += s * m
        sequence += times
    return {s: np.array(v, np.int64) for s, v in slots.items()}


def pack(cut: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Staged pieces (columns of ``PIECE``) plus sequence_id and offset. Pieces of one length are alike, so
    ties don't matter; they are numbered within hash chunks, so a length that very many pieces share is split."""
    hist = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = _slots(plan(hist, capacity, rounds))
    total = sum(hist.values())
    chunks = max(1, math.ceil(total / ROWS_PER_CHUNK))
    rows = (cut.withColumn("_one", F.lit(1).cast("bigint"))
            .withColumn("_chunk", F.pmod(F.xxhash64("row_id", "piece"), F.lit(chunks)).cast("int")))
    ranked = running_sum(rows, ["length"], "_chunk", ["row_id", "piece"], "_one", "number")
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "row_id", F.col("number").cast("bigint").alias("number"))
    shared = cut.sparkSession.sparkContext.broadcast(slots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            length, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 6))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for s in np.unique(length):
                own = length == s
                table = known[int(s)]
                row = table[np.searchsorted(table[:, 0], number[own], side="right") - 1]
                k = number[own] - row[:, 0]
                sequence[own], offset[own] = row[:, 1] + k // row[:, 2], row[:, 3] + (k % row[:, 2]) * s
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(sequence), pa.array(offset)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "row_id", "sequence_id", "offset"])

    return ranked.mapInArrow(place, PLACED)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Packs all rows of ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens. Returns one row
    per piece: doc_id, piece, start, length, ids_crc32, row_id (tells repeated rows apart), sequence_id, offset.

    Null text is empty; null doc_id stays null; an empty table gives no rows; other columns don't matter.
    """
    return pack(stage(pieces(docs, capacity, tokenizer), "pieces"), capacity)
