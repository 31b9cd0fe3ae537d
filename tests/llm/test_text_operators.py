"""Fill-in-the-middle, importance resampling and token counts against plain Python."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from sluice.llm import fill_in_middle as fim
from sluice.llm import importance, token_counts
from sluice.llm.common import documents
from sluice.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PIECES = ["a", "B", "ab", " ", "  ", "\t\n", "--", "é", "日本語", "🙂", "\x1c", "\x85", "\xa0", "x" * 31, "y" * 33, "z" * 70, "0", "_", "\n", "<P>", "<S", "M>",
          "longword" * 9, "'re", "'l", "'ll", "<|endoftext|>", "<|endof", "text|>", "   ", " 45"]


def strings(count, most, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, most))) for _ in range(count)]


def key(rows):
    return sorted(map(tuple, rows), key=str)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_fim(doc_id, text):
    t = text or ""
    units = UNIT.findall(t)
    n, h = len(units), sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i: i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(t), sha(t)
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(pre), len(mid), sha(f"<S>{suf}<P>{pre}<M>{mid}"), sha(t)
    return doc_id, n, "psm", len(pre), len(mid), sha(f"<P>{pre}<S>{suf}<M>{mid}"), sha(t)


def test_fill_in_middle(spark, odd_docs):
    texts = [*strings(600, 12, 5), "w " * 40_000, " " * 70_000, "é" * 9_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").union(odd_docs.select("doc_id", "text"))
    expected = key(plain_fim(r.doc_id, r.text) for r in docs.collect())
    assert key(fim.fim_digest(docs).collect()) == expected
    forms = Counter(r[2] for r in expected)
    assert min(forms["psm"], forms["spm"], forms["plain"]) > 20


def test_fill_in_middle_small_blocks(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK_BYTES", 20)
    texts = strings(300, 9, 8)
    rng = np.random.default_rng(1)
    h1, h2 = rng.integers(0, 1 << 32, (2, 300))
    sizes = np.array([len(t.encode()) for t in texts])
    for i, j in fim._blocks(sizes):
        own = pa.array(["?", *texts, "?"]).slice(i + 1, j - i)
        n, before, between, out = fim._rewrite(own, np.array(["psm"] * (j - i), object), h1[i:j], h2[i:j])
        for k, t in enumerate(texts[i:j]):
            units = UNIT.findall(t)
            a, b = sorted((h1[i + k] % (len(units) + 1), h2[i + k] % (len(units) + 1)))
            pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
            assert (n[k], before[k], between[k]) == (len(units), len(pre), len(mid))
            assert out[k].decode() == f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle_keeps_other_columns(odd_docs, no_docs):
    out = fim.fill_in_middle(odd_docs.withColumn("form", F.lit("mine")).withColumn("n", F.lit(3)))
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "shard", "text", "n", "form", "prefix_chars", "middle_chars"]
    rows = out.collect()
    assert len(rows) == odd_docs.count() and {r.form for r in rows} <= {"plain", "psm", "spm"}
    assert key(out.collect()) == key(rows)
    assert fim.fill_in_middle(no_docs).count() == 0 == fim.fim_digest(no_docs).count()


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]]


def plain_importance(docs, bench):
    own = [(d, *features(t)) for d, t in docs]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in bench for b in features(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[i] + 1) * (total_s + 10_000) / ((s[i] + 1) * (total_t + 10_000)))) for i in range(10_000)]
    out = []
    for d, n, f in own:
        w = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(sha(f"7:{'' if d is None else d}")[:8], 16)
        out.append([d, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0], r[2], r[1]))
    for i, r in enumerate(fit[: 25 * len(fit) // 100]):
        r[4] = i + 1
    return key(r[:5] for r in out)


def test_importance(spark, odd_docs):
    rng = random.Random(2)
    texts = [(i // 2, " ".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60)))) for i in range(400)]  # ids twice, ties
    docs = spark.createDataFrame(texts + texts[:30], "doc_id long, text string").union(odd_docs.select("doc_id", "text"))
    bench = spark.createDataFrame([("Ab a B longword " * 5,), (None,), ("",), ("日本語 x0 y",)], "text string")
    got = importance.importance_digest(docs, bench).collect()
    expected = plain_importance([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()])
    assert key(got) == expected
    drawn = sorted(r.rank for r in got if r.rank is not None)
    assert drawn == list(range(1, len(drawn) + 1)) and len(drawn) > 50


def test_importance_on_a_table(spark):
    docs, bench = documents(spark, SF), spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = plain_importance([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()])
    assert key(importance.importance_digest(docs, bench).collect()) == expected
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert key(con.execute(importance.IMPORTANCE_SQL).fetchall()) == expected
    assert key(con.execute(fim.FIM_SQL).fetchall()) == key(plain_fim(r.doc_id, r.text) for r in docs.collect())


def test_resample_returns_whole_rows_and_prefers_the_target(spark, odd_docs, no_docs):
    words = [f"w{i}" for i in range(50)]
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(words[:25] if i % 2 else words[25:], k=40)), "s", 5, "x") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight int, extra string")
    target = spark.createDataFrame([(" ".join(rng.choices(words[:25], k=400)),)], "text string")
    drawn = importance.resample(docs, target, rate=40).collect()
    assert len(drawn) == 160 and {(r.doc_id, r.text, r.extra) for r in drawn} <= {(r[0], r[1], r[4]) for r in rows}
    assert sum(r.doc_id % 2 for r in drawn) > 120
    assert importance.importance_digest(no_docs, target).count() == 0
    assert importance.importance_digest(odd_docs, no_docs).count() == odd_docs.count()


@pytest.mark.parametrize("words", [3, 50, 1 << 17])
def test_ngram_table(monkeypatch, words):
    monkeypatch.setattr(importance, "BLOCK_WORDS", words)
    for seed in range(25):
        texts = strings(6, 40, seed)
        blocks, counts, own = importance._interned(pa.array(texts), 2, 10_000), Counter(), np.zeros(6, int)
        while True:
            try:
                table, slots, doc = next(blocks)
            except StopIteration as end:
                n_words = end.value
                break
            assert table.count.sum() == len(slots)
            for b, n in zip(table.bucket[table.count > 0].tolist(), table.count[table.count > 0].tolist(), strict=True):
                counts[b] += n
            own += np.bincount(doc, minlength=6)
        assert counts == Counter(b for t in texts for b in features(t)[1])
        assert [(n, len(f)) for n, f in map(features, texts)] == list(zip(n_words.tolist(), own.tolist(), strict=True))


def test_hashes_of_many_slices():
    rng = np.random.default_rng(5)
    raw = rng.integers(0, 256, 600).astype(np.uint8)
    start, size = rng.integers(0, 500, 3000), rng.integers(0, 90, 3000)
    data = importance.Bytes(raw)
    cut = [raw[a: a + n].tobytes() for a, n in zip(start, size, strict=True)]
    assert data.hashes(start, size).tolist() == [xxhash.xxh64_intdigest(c) for c in cut]
    assert data.crcs(start, size).tolist() == [zlib.crc32(c) for c in cut]
    raw[300:600] = raw[:300]
    data, shift = importance.Bytes(raw), rng.integers(0, 2, 3000)
    a, n = rng.integers(0, 200, 3000), rng.integers(0, 90, 3000)
    b = a + 300 - shift
    assert data.equal(a, b, n).tolist() == [raw[i: i + k].tobytes() == raw[j: j + k].tobytes() for i, j, k in zip(a, b, n, strict=True)]


def test_equal_keys_of_different_ngrams_take_different_slots(monkeypatch):
    monkeypatch.setattr(importance.Bytes, "hashes", lambda self, start, size: (size % 2).astype(np.uint64))
    text = "aa bb aa cc bb aa"
    raw = np.frombuffer(text.encode(), np.uint8)
    start = np.array([0, 3, 6, 9, 12, 15])
    slots = importance.NgramTable(importance.Bytes(raw), 6, 10_000).intern(start, np.full(6, 2))
    assert len(set(slots.tolist())) == 3 and slots[0] == slots[2] == slots[5] and slots[1] == slots[4]


def whole_counts():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return t, lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("size,overlap", [(1, 1), (20, 4), (100, 40)])
def test_spliced_counts(size, overlap):
    tokenizer, whole = whole_counts()
    for text in [*strings(150, 80, size), "q" * 3000 + " " + "a b" * 50, " " * 2000 + "x", "<|endoftext|>" * 90, "🙂" * 300, "\n \n" * 300 + "'"]:
        assert token_counts.spliced_count(tokenizer, text, size, overlap, 17) == whole(text)


def test_token_counts(spark, odd_docs, no_docs):
    _, whole = whole_counts()
    docs = documents(spark, SF).select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    expected = key((r.doc_id, len((r.text or "").encode()), whole(r.text), whole(r.text) > 1024) for r in docs.collect())
    assert key(token_counts.count_digest(docs).collect()) == expected
    small = token_counts.count_tokens(docs, size=700, overlap=60)
    assert key(small.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()) == expected
    out = token_counts.count_tokens(odd_docs.withColumn("n_tokens", F.lit("mine")), limit=3)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "shard", "n_bytes", "n_tokens", "over_limit"]
    assert all(r.over_limit == (r.n_tokens > 3) for r in out.collect())
    assert token_counts.count_tokens(no_docs).count() == 0 == token_counts.count_digest(no_docs).count()


def test_token_counts_of_other_tokenizers(spark):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    texts = ["", "Hello  World 日本", "it's <|endoftext|> x" * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    other = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    for name, count in (("piece_bpe_32k.model", lambda t: len(model.encode(t))),
                        ("word_bpe_49k.json", lambda t: len(other.encode(t, add_special_tokens=False).ids))):
        got = token_counts.count_tokens(docs, tokenizer=tokenizer_path(name), size=40, overlap=10).collect()
        assert {r.doc_id: r.n_tokens for r in got} == {i: count(t) for i, t in enumerate(texts)}
