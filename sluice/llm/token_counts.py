"""Token counts of whole texts, huge ones in overlapping chunks.

A huge text is never encoded at once: a chunk is encoded with offsets, the next chunk starts some characters
before its end, and the two are spliced where both have a boundary between pre-tokens (the pieces that a
byte-level tokenizer encodes on their own). Such a place is proven, not likely:

* the pre-tokenizer matches its pattern from left to right and looks back at nothing, so two chunks that both end
  a match at p cut everything after p alike, and so does the whole text;
* a match of the earlier chunk that ends at least ``margin`` characters before its end has seen all the characters
  it looks at (its own, at most two more, and no part of an added token that the chunk's end cuts off), so it is a
  match of the whole text too. The first chunk starts where the text does; by induction every splice is a boundary
  of the whole text.

Where the overlap holds no common boundary (a run of one class longer than it, white space, a cut added token),
it is doubled. Once it reaches back to the last proven boundary, that boundary is the start of the new chunk and
chunks grow by doubling, so the loop ends after at most the text itself. Tokenizers for which this proof doesn't hold
(normalizers, other pre-tokenizers, sentencepiece models) encode whole texts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from sluice.llm.tokens import encoder, tokenizer_path

#: Characters of a chunk beyond the overlap, and of the first overlap. Texts of up to ``SIZE`` are encoded whole.
SIZE, OVERLAP = 16_384, 256


def has_proof(config: dict) -> bool:
    """Can texts of this tokenizer be spliced? Byte-level BPE by the usual pattern, nothing added or normalised."""
    pre, model = config.get("pre_tokenizer") or {}, config.get("model") or {}
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in config.get("added_tokens", []))
    return (plain and config.get("normalizer") is None and model.get("type") == "BPE" and not model.get("dropout")
            and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True))


class Chunk:
    """One encoded chunk: its token count and where its pre-tokens start (places in the text, token indices)."""

    def __init__(self, tokenizer, text: str, start: int, end: int):
        got = tokenizer.encode(text[start:end], add_special_tokens=False)
        words = np.array(got.word_ids, np.int64)
        self.end, self.n = end, len(words)
        self.index = np.flatnonzero(np.diff(words, prepend=-1))
        self.place = np.array(got.offsets, np.int64).reshape(-1, 2)[self.index, 0] + start

    def token_at(self, place: int) -> int:
        return int(self.index[np.searchsorted(self.place, place)])


def spliced_count(tokenizer, text: str, size: int = SIZE, overlap: int = OVERLAP, margin: int = 32) -> int:
    """Tokens of ``text`` as the tokenizer encodes it whole, from chunks of about ``size`` + ``overlap`` characters."""
    n, proven, counted, skip = len(text), 0, 0, 0
    left = Chunk(tokenizer, text, 0, min(n, size + overlap))
    while left.end < n:
        back, step = overlap, size
        while True:
            start = max(proven, left.end - back)
            right = Chunk(tokenizer, text, start, min(n, left.end + step))
            if start == proven:  # starts at a boundary of the whole text
                place = proven
                break
            usable = left.place[(left.place >= start) & (left.place <= left.end - margin)]
            common = np.intersect1d(usable, right.place, assume_unique=True)
            if len(common):
                place = int(common[-1])
                break
            back *= 2
            step = max(step, back)
        counted += left.token_at(place) - skip
        proven, skip, left = place, right.token_at(place), right
        size = max(size, left.end - start - overlap) if place == start else size
    return counted + left.n - skip


class Counter:
    """Token counts with one tokenizer file: ``.json`` of the tokenizers library or a sentencepiece ``.model``."""

    def __init__(self, path: str, size: int, overlap: int):
        self.size, self.overlap, self.model = size, overlap, None
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            self.model = SentencePieceProcessor(model_file=path)
            return
        self.encoder = encoder(path)
        self.tokenizer = self.encoder.tokenizer
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        config = json.loads(self.tokenizer.to_str())
        self.spliced = has_proof(config)
        self.margin = 4 + max([len(t["content"]) for t in config.get("added_tokens", [])], default=0)

    def count(self, text: str) -> int:
        if self.model is not None:
            return len(self.model.encode(text))
        if not self.spliced:
            return len(self.tokenizer.encode(text, add_special_tokens=False))
        if len(text) > self.size:
            return spliced_count(self.tokenizer, text, self.size, self.overlap, self.margin)
        return len(self.encoder.encode(text)) // self.encoder.dtype.itemsize


OWN = ("n_bytes", "n_tokens", "over_limit")


def count_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = 1024, size: int = SIZE,
                 overlap: int = OVERLAP) -> DataFrame:
    """``docs`` without ``text``, plus n_bytes (of the UTF-8 text), n_tokens and over_limit (n_tokens > ``limit``).

    Tokens are those that the library gives for the whole text without begin, end or added special tokens; an added
    token's string inside a text is that token, the library's default. Null text is empty (0 tokens); null doc_ids
    and repeated rows stay. Columns named like the added ones are replaced. Nothing is shuffled.
    """
    path = tokenizer or tokenizer_path()
    kept = [c for c in docs.columns if c not in {*OWN, "text"}]
    rows = docs.select(*kept, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, size, overlap)
        for batch in batches:
            found = [counter.count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], batch.column("n_bytes"), pa.array(found, pa.int64())],
                                             [*kept, "n_bytes", "n_tokens"])

    with_bytes = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    return with_bytes.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)


def count_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    out = count_tokens(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")
