"""The operators against brute force, on small tables with every odd case and on a driver table."""
import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sluice.llm import (jaccard_join, mixing, neighbours, packing, pii, quality_rules, sharding, suffix_dedup, token_files, warc)
from sluice.llm.common import documents, shared_folder
from sluice.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def direct_ids(text):
    from tokenizers import Tokenizer

    if not hasattr(direct_ids, "t"):
        direct_ids.t = Tokenizer.from_file(tokenizer_path())
    return [*direct_ids.t.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("op", [sharding.shard_documents, mixing.mixing_digest, quality_rules.quality_digest, token_files.token_digest,
                                packing.pack_documents, jaccard_join.near_duplicates, suffix_dedup.repeated_passages, pii.find,
                                quality_rules.filter_documents, jaccard_join.deduplicate, pii.redact, mixing.mixed_documents])
def test_empty_and_odd(op, no_docs, odd_docs):
    assert op(no_docs).count() == 0
    op(odd_docs).collect()


def test_sharding(odd_docs):
    r = sharding.shard_documents(odd_docs).collect()
    assert len(r) == 9 and all(x.grown_shard in (x.shard, 24) for x in r)
    for s in {x.shard for x in r}:
        own = sorted(x.slot for x in r if x.shard == s)
        assert own == list(range(len(own)))
    assert next(x for x in r if x.doc_id == 3).size == 8


def test_sharding_moves_only_to_the_new_shard(spark):
    df = spark.range(20000)
    a = sharding.with_shard(sharding.with_shard(df, "id", 300, "a"), "id", 301, "b").collect()
    assert all(x.b in (x.a, 300) for x in a)
    moved = sum(x.a != x.b for x in a)
    assert 30 < moved < 110


def test_mixing(spark):
    docs = documents(spark, SF)
    r = mixing.mixing_digest(docs).collect()
    sizes = {d.doc_id: len(WORD.findall(d.text or "")) for d in docs.collect()}
    assert {x.doc_id: x.size for x in r} == sizes
    assert all(0 <= x.taken <= 3 * x.size for x in r)
    source = {d.doc_id: d.source for d in docs.collect()}
    taken, target = Counter(), {}
    for x in r:
        taken[source[x.doc_id]] += x.taken
        target[source[x.doc_id]] = x.target
    names = sorted(target)
    cap = Counter()
    for d, s in source.items():
        cap[s] += 3 * sizes[d]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, free, want = sum(sizes.values()), set(names), {}
    while True:
        level = (total - sum(want.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > cap[s]]
        if not over:
            break
        want |= {s: cap[s] for s in over}
        free -= set(over)
    want |= {s: level * weight[s] for s in free}
    assert all(abs(target[s] - want[s]) < 1e-6 * total for s in names)
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 20 for s in names)
    again = mixing.mixing_digest(docs).collect()
    assert sorted(map(tuple, r)) == sorted(map(tuple, again))


def test_quality_measures(spark):
    docs = documents(spark, SF)
    got = {r.doc_id: r for r in quality_rules.quality_digest(docs).collect()}
    for d in docs.collect():
        w = WORD.findall(d.text or "")
        grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        hit = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in (d.text or "").split("\n") if WORD.search(x)]
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(w), sum(map(len, w)), len(hit), len(lines) - len(set(lines)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in d.text or "")
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w)) and not (r.kept and r.base_failed)


@pytest.mark.parametrize("which", ["odd", "table"])
def test_tokens_round_trip(spark, odd_docs, which):
    docs = odd_docs if which == "odd" else documents(spark, SF)
    r = token_files.token_digest(docs).collect()
    want = Counter((d.doc_id, len(i := direct_ids(d.text)), zlib.crc32(np.array(i, "<u4").tobytes())) for d in docs.collect())
    assert Counter((x.doc_id, x.n_tokens, x.ids_crc32) for x in r) == want
    at = 0
    for x in sorted(r, key=lambda x: x.start):
        assert x.start == at
        at += x.n_tokens
    known = [x.doc_id for x in sorted(r, key=lambda x: x.start) if x.doc_id is not None]
    assert known == sorted(known)


def test_packing(spark):
    docs = documents(spark, SF)
    r = packing.pack_documents(docs).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for x in r:
        by_doc[x.doc_id].append(x)
        by_seq[x.sequence_id].append(x)
    for d in docs.collect():
        ids, own = direct_ids(d.text), sorted(by_doc[d.doc_id], key=lambda x: x.piece)
        assert [x.start for x in own] == [0, *np.cumsum([x.length for x in own])[:-1]] and sum(x.length for x in own) == len(ids)
        assert all(x.ids_crc32 == zlib.crc32(np.array(ids[x.start:x.start + x.length], "<u4").tobytes()) for x in own)
        assert all(x.length == 2048 for x in own[1:])
    for own in by_seq.values():
        at = 0
        for x in sorted(own, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= 2048
    total = sum(x.length for x in r)
    assert len(by_seq) <= 1.03 * total / 2048 + 1


def test_warc(spark):
    rows = [(1, "http://a/é\n", "same"), (2, "http://b", "same"), (3, None, None), (4, "c", ""), (None, "d", "same"),
            (5, "e", "x" * 3_000_000), (2, "http://b", "same"), (6, "z", "\x1f\x08é")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = shared_folder(spark, "warc")
    got = warc.read_warc(spark, warc.write_warc(pages, folder), folder, split=1000).collect()
    assert len(got) == len(rows)
    for x in got:
        html = (next(r[2] for r in rows if r[0] == x.page_id) or "").encode()
        assert x.payload_bytes == len(html) and x.payload_digest == base64.b32encode(hashlib.sha1(html).digest()).decode()
        assert x.record_type == ("revisit" if x.refers_to is not None else "response")
        assert x.payload == (html if x.record_type == "response" else None)
    assert {x.page_id: x.refers_to for x in got} == {1: None, 2: 1, None: 1, 3: None, 4: 3, 5: None, 6: None}
    assert next(x.url for x in got if x.page_id == 1) == "http://a/é\n"


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 16)) * rng.uniform(0.5, 2, (3000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3000, None), (3020, [0.0] * 16), (3040, [float("nan")] * 16), (3001, [None] * 16), (None, [1.0] * 16)]
    got = defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    assert set(got) == set(range(0, 3000, 20))
    hit = 0
    for q, own in got.items():
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -s))[:20]
        hit += len({r.vec_id for r in own} & set(best.tolist()))
        assert all(abs(r.score - s[r.vec_id]) < 1e-9 for r in own) and len(own) == 20
    assert hit >= 0.9 * 20 * len(got)


def brute_components(docs, n=4):
    sets = []
    for d in docs:
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), d.text or ""))
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) >= 0.85 * max(len(a), len(b)) and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    best = defaultdict(lambda: None)
    for i, d in enumerate(docs):
        k = find(i)
        if d.doc_id is not None and (best[k] is None or d.doc_id < best[k]):
            best[k] = d.doc_id
    return Counter((d.doc_id, len(s), best[find(i)]) for i, (d, s) in enumerate(zip(docs, sets)))


@pytest.mark.parametrize("which", ["table", "group", "odd"])
def test_jaccard_join(spark, odd_docs, which):
    if which == "table":
        docs = documents(spark, SF)
    elif which == "odd":
        docs = odd_docs
    else:  # a large group of near copies with edits, over few frequent words
        rng = np.random.default_rng(2)
        base = [f"v{i}" for i in rng.integers(0, 400, 150)]
        rows = []
        for i in range(250):
            w = list(base)
            for j in rng.integers(0, 150, int(rng.integers(0, 5))):
                w[j] = f"v{rng.integers(0, 400)}"
            rows.append((i, " ".join(w)))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, jaccard_join.near_duplicates(docs).collect()))
    assert got == brute_components(docs.collect())


def test_index_keys_meet_for_frequent_grams():
    rng = np.random.default_rng(3)
    freq = np.full(jaccard_join.CLASSES, 9)  # every class is frequent
    for n in (6, 20, 100, 700):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = int(0.15 * len(a))
        b = np.sort(rng.permutation(a)[drop:]) if drop else a
        if 100 * len(b) >= 85 * len(a):
            assert len(np.intersect1d(jaccard_join.index_keys(a, freq, 0.85), jaccard_join.index_keys(b, freq, 0.85)))


def test_suffix_dedup(spark):
    docs = documents(spark, SF)
    where, text = defaultdict(set), {}
    for d in docs.collect():
        m = [x.span() for x in WORD.finditer(d.text or "")]
        w = [d.text[a:b] for a, b in m]
        text[d.doc_id] = (m, w)
        for j in range(len(w) - 49):
            where[tuple(w[j:j + 50])].add(d.doc_id)
    want = set()
    for i, (m, w) in text.items():
        hit = [len(where[tuple(w[j:j + 50])]) > 1 for j in range(len(w) - 49)] + [False]
        start = None
        for j, h in enumerate(hit):
            if h and start is None:
                start = j
            if not h and start is not None:
                want.add((i, m[start][0], m[j + 48][1]))
                start = None
    got = suffix_dedup.repeated_passages(docs).collect()
    assert {(x.doc_id, x.start, x.end) for x in got} == want and len(got) == len(want)


def test_pii_base_and_redaction(spark, odd_docs):
    r = next(x for x in pii.find(odd_docs).collect() if x.doc_id == 6)
    assert (r.n_email, r.n_phone) == (1, 1) and {"email:5:29", "phone:33:50"} <= set(r.spans.split(","))
    assert r.base_sha256 == hashlib.sha256(b"email:5:29,phone:33:50").hexdigest()
    out = pii.redact(odd_docs)
    assert out.columns == odd_docs.columns
    assert next(x.text for x in out.collect() if x.doc_id == 6) == "mail [email] or [phone] é"


def test_tagger_gradient_and_held_out_accuracy():
    rng = np.random.default_rng(4)

    def sample():
        pick = rng.integers(0, 4)
        n = lambda k: "".join(map(str, rng.integers(0, 10, k)))
        pii_text = [f"u{n(2)}.x@mail{n(1)}.example.com", f"{rng.integers(1, 255)}.{rng.integers(0, 255)}.{rng.integers(0, 255)}.7",
                    "4111111111111111", f"+1 ({n(3)}) 555-{n(4)}"][pick]
        return " ".join(rng.choice(["the", "of", "inond", "erst", "thly"], 12)) + f" {pii_text} " + " ".join(rng.choice(["and", "tion", "was"], 12))

    x, y = pii.labelled_windows([sample() for _ in range(200)])
    t = pii.Tagger(hidden=3)
    _, g = t.gradients(x[:3, :12], y[:3, :12])
    for k, i in (("fx", (int(x[0, 3]), 2)), ("bh", (1, 4)), ("trans", (0, 0)), ("out", (2, 0))):
        old = t.p[k][i]
        t.p[k][i] = old + 1e-5
        up = t.gradients(x[:3, :12], y[:3, :12])[0]
        t.p[k][i] = old - 1e-5
        down = t.gradients(x[:3, :12], y[:3, :12])[0]
        t.p[k][i] = old
        assert abs((up - down) / 2e-5 - g[k][i]) < 1e-4
    t = pii.Tagger().fit(x, y, steps=100)
    hx, hy = pii.labelled_windows([sample() for _ in range(60)])
    assert (t.decode(hx) == hy).mean() > 0.95
