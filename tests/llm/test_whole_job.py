"""Cases in which an operator once did less than its whole job."""
import random
from collections import Counter

import corpus_pipeline
import numpy as np
from test_operators import brute_components

from sluice.llm import jaccard_join, mixing, quality_rules, suffix_dedup
from sluice.llm.common import documents

SF = "/root/testdata/sf0.001"


def test_pipeline_drops_a_copy_with_two_words_replaced(spark):
    words = [f"w{i}" for i in range(100)]
    copy = list(words)
    copy[30], copy[70] = "x", "y"  # 5-gram similarity 86/106, 4-gram similarity 89/105
    other = list(words)
    other[20], other[50], other[80] = "x", "y", "z"  # 81/111 = 0.73 to the first, 76/116 to the second
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(copy)), (3, " ".join(other))], "doc_id long, text string")
    kept = corpus_pipeline._near_duplicates(spark, docs, "").collect()
    assert {r.doc_id for r in kept} == {1, 3} == {r.doc_id for r in jaccard_join.deduplicate(docs).collect()}
    assert {r.doc_id for r in jaccard_join.deduplicate(docs, n=4, t=0.85).collect()} == {1, 2, 3}


def test_mixing_gives_sources_far_below_a_block_their_target(spark):
    # words of a source: the first, third and fourth are capped at three times their words
    sizes = {"a": [7], "b": [60_000] * 5, "c": [30, 8], "d": [1], "e": [70, 90], "f": [500_000, 3, 40]}
    rows, i = [], 0
    for s, own in sizes.items():
        for n in own:
            rows.append((i, " ".join(["w"] * n), s))
            i += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out, plan = mixing.mix(docs)
    r = out.collect()
    taken, target = Counter(), {x.source: x.target for x in r}
    for x in r:
        assert x.taken <= 3 * x.size
        taken[x.source] += x.taken
    assert all(abs(taken[s] - target[s]) <= mixing.BLOCK_WORDS / 2 + 1 for s in sizes)
    assert all(taken[s] == 3 * sum(sizes[s]) for s in "acde")
    used = Counter()
    for x in plan.collect():
        assert x.from_word < x.to_word
        used[x.row_id] += x.to_word - x.from_word
    assert used == {x.row_id: x.taken for x in r if x.taken}
    copies = Counter(x.doc_id for x in mixing.mixed_documents(docs).collect())
    assert copies[0] == copies[6] == copies[7] == copies[8] == 3
    # every stretch has the shares
    order = [x.source for x in sorted(plan.select("slot", "source").distinct().collect(), key=lambda x: x.slot)]
    share = order.count("f") / len(order)
    for at in range(0, len(order) - 500, 500):
        assert abs(order[at:at + 500].count("f") - 500 * share) <= 8


def brute_kept(rows):
    """The verdict in plain Python, from all values of a group instead of sketches; rows are dicts."""
    def value(r, m):
        num, den, scale = quality_rules.MEASURES[m][:3]
        return scale * r[num] // r[den]

    def bucket(v):
        low = max(0, v.bit_length() - 6)
        return v >> low << low

    def median(x):
        return sorted(x)[(len(x) + 1) // 2 - 1]

    good, kept = [r for r in rows if not r["base_failed"]], {}
    for r in rows:
        ok = not r["base_failed"]
        for m, (*_, up, down) in quality_rules.MEASURES.items():
            for keys in (("lang", "source"), ("lang",), ()):
                x = [bucket(value(g, m)) for g in good if all(g[k] == r[k] for k in keys)]
                if len(x) >= quality_rules.MIN_DOCS:
                    mid = median(x)
                    spread = 10 * median([abs(v - mid) for v in x])
                    v = value(r, m) if r["n_words"] else None
                    ok = ok and not (v > mid + spread + up or (down is not None and v < mid - spread - down))
                    break
        kept[r["doc_id"]] = ok
    return kept


def test_quality_limits_hold_with_junk_in_a_source(spark):
    rng, rows = random.Random(5), []

    def add(source, kind="", symbols=0):
        r = {"doc_id": len(rows), "lang": "en", "source": source, "n_words": 1000, "word_chars": rng.randint(4800, 5200),
             "n_symbols": symbols + rng.choice([0, 0, 0, 4, 30]), "n_dup_lines": rng.choice([0, 0, 2]), "n_repeat_words": rng.choice([0, 0, 9]),
             "base_failed": False}
        r |= {"symbols": {"n_symbols": 800}, "lines": {"n_dup_lines": 600}, "repeats": {"n_repeat_words": 450},
              "long": {"word_chars": 30_000}, "": {}}[kind]
        rows.append(r)
        if kind:
            junk.add(r["doc_id"])

    junk: set = set()
    for source, n, share in (("three", 50, 3), ("tenth", 200, 20), ("third", 200, 60), ("clean", 100, 0)):
        for kind in ("symbols", "lines", "repeats", "long"):
            for i in range(n):
                add(f"{source}-{kind}", kind if i < share else "")
    for _ in range(60):
        add("code", symbols=rng.randint(300, 400))  # another kind of source, not junk
    for kind in ("", "", "symbols"):
        add("tiny", kind)  # judged by its language
    names = list(rows[0])
    df = spark.createDataFrame([tuple(r[k] for k in names) for r in rows],
                               "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
                               "n_dup_lines long, n_repeat_words long, base_failed boolean")
    got = {r.doc_id: r.kept for r in quality_rules.judge(df).collect()}
    assert {i for i, k in got.items() if not k} == junk
    assert got == brute_kept(rows)


def test_quality_verdict_against_plain_python(spark):
    rows = [r.asDict() for r in quality_rules.measured(documents(spark, SF)).drop("text").collect()]
    got = {r.doc_id: r.kept for r in quality_rules.quality_digest(documents(spark, SF)).collect()}
    assert got == brute_kept(rows) and 0 < sum(got.values()) < len(got)


def test_jaccard_join_takes_the_text_of_the_class(spark):
    def words(tag, *changed):
        return " ".join("x%s%d" % (tag, i) if i in changed else f"{tag}{i}" for i in range(120))

    rows = [(1, words("a")), (1, words("b")), (2, words("a", 5)), (3, words("b", 5)), (1, words("z")),  # two texts under one id
            (4, words("c", 1, 2, 3)), (None, words("c")), (5, words("c", 100, 101, 102)),  # 4 and 5 meet only by the row without id
            (None, words("d")), (None, words("d", 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, jaccard_join.near_duplicates(docs, n=4, t=0.85).collect()))
    assert got == brute_components(docs.collect())
    assert {c for d, _, c in got if d in (4, 5)} == {4}


def test_suffix_dedup_with_several_texts_under_one_id(spark):
    def run(tag, n):
        return " ".join(f"{tag}{i}" for i in range(n))

    rows = [(1, run("p", 60)), (1, "short text of less than fifty words but of more than fifty characters"),
            (2, "q " + run("p", 60)), (3, run("p", 55) + " u " + run("r", 50)), (3, "v " + run("r", 70)), (4, run("r", 70))]
    got = suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    size = lambda tag, n: len(run(tag, n))
    want = [(1, 0, size("p", 60), 60), (2, 2, 2 + size("p", 60), 60), (3, 0, size("p", 55), 55),
            (3, size("p", 55) + 3, size("p", 55) + 3 + size("r", 50), 50), (3, 2, 2 + size("r", 70), 70), (4, 0, size("r", 70), 70)]
    assert sorted((x.doc_id, x.start, x.end, x.text_words) for x in got) == sorted(want)


def test_a_large_group_of_near_copies_is_joined_by_few_pairs(spark, monkeypatch):
    """Copies of one text, each with words of its own: most are linked through others only."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(600):
        words = list(base)
        for p in rng.choice(150, min(i, 2), replace=False):
            words[p] = f"x{i}y{p}"
        texts.append(" ".join(words))
    staged = {}

    def counted(df, name, stage=jaccard_join.stage):
        out = stage(df, name)
        staged[name] = staged.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard_join, "stage", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs, 4, 0.85).collect()}
    sets = [jaccard_join.grams(t, 4) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    assert got == dict(enumerate(root)) and len(set(root)) < 300
    assert staged["rest"] <= len(texts), staged


def test_places_far_into_long_texts_survive_the_shuffles(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    long = "é " * 70_000
    docs = spark.createDataFrame([(-3, long + passage), (1 << 40, "Z" * 70_000 + " " + passage)], "doc_id long, text string")
    got = {r.doc_id: (r.start, r.end, r.text_words, r.first_doc_id) for r in suffix_dedup.repeated_passages(docs).collect()}
    assert got == {-3: (140_000, 140_000 + len(passage), 60, -3), 1 << 40: (70_001, 70_001 + len(passage), 60, -3)}
