"""Fill-in-the-middle rewriting of whole documents.

A text is cut into units (optional white space and a word; white space at the end is a unit of its own), and two
draws from a hash of the document's id say after how many units the prefix and the middle end. The places are
found without a list of units: the UTF-8 bytes of many texts are viewed as 64-bit words, arithmetic on whole
words marks the bytes that end a unit, ``bitwise_count`` counts them per word, a search in the running counts
finds the word that holds the k-th end, and a multiplication finds the byte in it.

Forms: ``plain`` (the text itself), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix, prefix, middle), each
part after its sentinel. A text that is empty or holds a sentinel's string stays plain, so every output can be
turned back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Texts are handled together up to about this many bytes (or one longer text).
BLOCK_BYTES = 8 << 20

_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_ONES = np.uint64(0x0101010101010101)


def _space_bytes(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a space (0x20) or one of 0x09 to 0x0D."""
    low = words & _LOW7  # sums below stay within their byte
    not_blank = (low ^ (_ONES * np.uint64(0x20))) + _LOW7
    from_tab = low + _ONES * np.uint64(0x80 - 0x09)
    past_cr = low + _ONES * np.uint64(0x80 - 0x0E)
    return (~not_blank | (from_tab & ~past_cr)) & ~words & _HIGH


def _inner_bytes(words: np.ndarray) -> np.ndarray:
    """The high bit of every UTF-8 continuation byte (10xxxxxx)."""
    return words & ~(words << np.uint64(1)) & _HIGH


class MarkedBytes:
    """Rank and select over marked bytes: ``marks`` holds the high bit of every marked byte, eight bytes a word."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.upto = np.cumsum(np.bitwise_count(marks), dtype=np.int64)

    def before(self, places: np.ndarray) -> np.ndarray:
        """Marked bytes before each byte place (a place may be one past the last word)."""
        word = places >> 3
        below = (np.uint64(1) << (np.uint64(8) * (places & 7).astype(np.uint64))) - np.uint64(1)
        own = np.where(word < len(self.marks), self.marks[np.minimum(word, len(self.marks) - 1)], np.uint64(0))
        return np.where(word > 0, self.upto[word - 1], 0) + np.bitwise_count(own & below)

    def place(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th marked byte (k from 0)."""
        word = np.searchsorted(self.upto, k, "right")
        nth = (k - np.where(word > 0, self.upto[word - 1], 0) + 1).astype(np.uint64)
        running = (self.marks[word] >> np.uint64(7)) * _ONES  # byte j: marked bytes among the first j + 1
        reached = ((running | _HIGH) - nth * _ONES) & _HIGH
        return (word << 3) + 8 - np.bitwise_count(reached)


def unit_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[MarkedBytes, MarkedBytes]:
    """(bytes that end a unit, UTF-8 continuation bytes) of texts that lie at data[start:end] one after another."""
    padded = np.full((len(data) // 8 + 2) * 8, 0x20, np.uint8)
    padded[: len(data)] = data
    words = padded.view("<u8")
    space = _space_bytes(words)
    following = space >> np.uint64(8)
    following[:-1] |= space[1:] << np.uint64(56)
    marks = ~space & _HIGH & following
    last = ends[ends > starts] - 1  # a text's last byte ends a unit, whatever comes after it in the buffer
    np.bitwise_or.at(marks, last >> 3, np.uint64(0x80) << (np.uint64(8) * (last & 7).astype(np.uint64)))
    return MarkedBytes(marks), MarkedBytes(_inner_bytes(words))


def cut_places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h1: np.ndarray, h2: np.ndarray):
    """Per text: number of units, first and second cut (bytes), code points before and between the cuts."""
    units, inner = unit_ends(data, starts, ends)
    base = units.before(starts)
    n = units.before(ends) - base
    one, two = h1 % (n + 1), h2 % (n + 1)

    def place(k):
        got = starts.copy()
        some = k > 0
        got[some] = units.place(base[some] + k[some] - 1) + 1
        return got

    a, b = place(np.minimum(one, two)), place(np.maximum(one, two))
    points = [p - inner.before(p) for p in (starts, a, b)]
    return n, a, b, points[1] - points[0], points[2] - points[1]


def _blocks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``BLOCK_BYTES`` of text, or of one row."""
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > BLOCK_BYTES:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def _rewrite(texts: pa.Array, form: np.ndarray, h1: np.ndarray, h2: np.ndarray):
    """(n, prefix code points, middle code points, outputs) of a block of texts without nulls."""
    texts = texts.cast(pa.large_binary())
    _, offsets, values = texts.buffers()
    at = np.frombuffer(offsets, "<i8")[texts.offset: texts.offset + len(texts) + 1]
    raw = memoryview(values)[at[0]: at[-1]] if values is not None else memoryview(b"")
    at = at - at[0]
    n, a, b, before, between = cut_places(np.frombuffer(raw, np.uint8), at[:-1], at[1:], h1, h2)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    out = []
    for kind, i, j, k, l in zip(form.tolist(), at[:-1].tolist(), a.tolist(), b.tolist(), at[1:].tolist(), strict=True):
        if kind == "psm":
            out.append(b"".join((p, raw[i:j], s, raw[k:l], m, raw[j:k])))
        elif kind == "spm":
            out.append(b"".join((s, raw[k:l], p, raw[i:j], m, raw[j:k])))
        else:
            out.append(bytes(raw[i:l]))
    return n, before, between, out


OWN = ("n", "form", "prefix_chars", "middle_chars")


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """``docs`` with ``text`` rewritten, plus n (units), form, prefix_chars and middle_chars (null if plain).

    ``rate`` of 100 texts are rewritten, ``spm_rate`` of 100 of these as spm. The draws come from the sha256 of
    ``seed:doc_id`` alone, so a rerun gives the same rows and rows of one doc_id share their draws; a null doc_id
    counts as an empty one. Null text is empty; it stays plain. Repeated rows stay. Other columns are kept,
    but columns named like the added ones are replaced.
    """
    own = {*OWN, "text"}
    kept = [c for c in docs.columns if c not in own]
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def has(s: str) -> Column:
        return F.contains(F.col("text"), F.lit(s))

    form = (F.when((F.col("text") == "") | has(PREFIX) | has(SUFFIX) | has(MIDDLE) | (h[2] % 100 >= rate), "plain")
            .when(h[3] % 100 < spm_rate, "spm").otherwise("psm"))
    rows = (docs.select(*kept, whole.alias("text")).withColumn("_h", hashed)
            .select(*kept, "text", form.alias("form"), h[0].alias("_h1"), h[1].alias("_h2")))
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("text", T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                           T.StructField("middle_chars", T.LongType())])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            for i, j in _blocks(sizes):
                part = batch.slice(i, j - i)
                kind = part.column("form")
                n, before, between, out = _rewrite(part.column("text"), kind.to_numpy(zero_copy_only=False),
                                                   part.column("_h1").to_numpy(), part.column("_h2").to_numpy())
                plain = pc.equal(kind, "plain").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], pa.array(out, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), kind,
                     pa.array(before, pa.int64(), mask=plain), pa.array(between, pa.int64(), mask=plain)],
                    [*kept, "text", "n", "form", "prefix_chars", "middle_chars"])

    return rows.mapInArrow(rewrite, schema)


def restored(text: Column, form: Column) -> Column:
    """The original text of an output: the parts between the sentinels, put back in order."""
    s, p, m = (F.instr(text, x) for x in (SUFFIX, PREFIX, MIDDLE))

    def between(a: Column, b: Column) -> Column:
        return F.substring(text, a + 3, b - a - 3)

    middle = F.substring(text, m + 3, F.length(text))
    return (F.when(form == "psm", F.concat(between(p, s), middle, between(s, m)))
            .when(form == "spm", F.concat(between(p, m), middle, between(s, p))).otherwise(text))


def fim_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every document."""
    out = fill_in_middle(docs.select("doc_id", "text"))
    return out.select(F.col("doc_id").cast("bigint").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("text", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("text"), F.col("form")), 256).alias("restored_sha256"))


#: The same digest as DuckDB SQL. Units are listed by the pattern; the original text itself stands for the restored one.
_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
FIM_SQL = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h FROM documents),
    u AS (SELECT doc_id, t, regexp_extract_all(t, '{_UNIT}') AS us,
                 CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                 CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
    c AS (SELECT doc_id, t, us, len(us) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a,
                 greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS b,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT doc_id, t, n, form, coalesce(array_to_string(us[1:a], ''), '') AS pre,
                 coalesce(array_to_string(us[a + 1:b], ''), '') AS mid, coalesce(array_to_string(us[b + 1:], ''), '') AS suf FROM c)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                            ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(t) AS restored_sha256 FROM p"""
