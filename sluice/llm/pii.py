"""Personal data in whole texts: fixed patterns, and a character tagger that adds what they miss.

The tagger is a bidirectional LSTM over characters with CRF transitions, trained in numpy. Its labelled spans
are the patterns' matches in a bounded sample of the corpus (``SAMPLE`` windows, smallest hash first). A span
always holds a digit or @, so windows without either aren't decoded. Windows of ``WINDOW`` characters overlap by
half; each character takes its tag from the window in which it lies deepest, and the joined tags of the
whole text give the spans. A found span counts if it has the form of its kind (digits, parts) and touches no
span of the patterns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    # no match starts inside a run of digits whose start gives none, so those places aren't tried
    "ip": re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
WINDOW, HIDDEN, SAMPLE, STEPS, BATCH = 64, 16, 512, 150, 64
TAGS = 1 + 2 * len(KINDS)  # none, then begin and inside of each kind
_TRIGGER = re.compile(r"[0-9@]")
_HOST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Characters before and after a labelled span that a training excerpt takes along.
BEFORE, AFTER = 64, 96


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 * (c > "4")) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def accepted(kind: str, s: str) -> bool:
    d = _digits(s)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15 if kind == "phone" else True


def matches(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """The leftmost non-overlapping matches of a kind's pattern. Those of emails are found from each @ outwards,
    which gives the same and stays linear on long runs of word characters."""
    if kind != "email":
        yield from (m.span() for m in PATTERNS[kind].finditer(text))
        return
    done, at = 0, text.find("@")
    while at >= 0:
        a, host = at, _HOST.match(text, at)
        while host and a > done and text[a - 1] in _LOCAL:
            a -= 1
        if a < at:
            done = host.end()
            yield a, done
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as in ``KINDS``, then start; matches that fail are dropped, without retries."""
    if not _TRIGGER.search(text):
        return []
    return [(k, a, b) for k in KINDS for a, b in matches(k, text) if accepted(k, text[a:b])]


def encode(text: str) -> np.ndarray:
    """Characters as 0 .. 97: printable ASCII, other letters and signs, white space."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where((c > 32) & (c < 127), c - 32, np.where(c <= 32, 97, 96))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Forward, training and decoding of the network; ``p`` holds the weights."""

    def __init__(self, seed: int = 5, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p = {"out": rng.normal(0, 0.2, (2 * hidden, TAGS)), "bias": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS))}
        for d in "fb":
            self.p[d + "x"] = rng.normal(0, 0.3, (98, 4 * hidden))
            self.p[d + "h"] = rng.normal(0, 0.2, (hidden, 4 * hidden))

    def _run(self, d: str, x: np.ndarray):
        n, steps = x.shape
        h, c, hist = np.zeros((n, self.h)), np.zeros((n, self.h)), []
        for t in range(steps):
            z = self.p[d + "x"][x[:, t]] + h @ self.p[d + "h"]
            s = _sigmoid(z[:, : 3 * self.h])
            i, f, o, g = s[:, : self.h], s[:, self.h: 2 * self.h], s[:, 2 * self.h:], np.tanh(z[:, 3 * self.h:])
            before, prev = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            hist.append((i, f, o, g, before, prev, tc, h))
        return hist

    def emissions(self, x: np.ndarray):
        f, b = self._run("f", x), self._run("b", x[:, ::-1])
        hs = np.concatenate([np.stack([r[7] for r in f], 1), np.stack([r[7] for r in b[::-1]], 1)], 2)
        return hs @ self.p["out"] + self.p["bias"], hs, f, b

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        e, hs, f, b = self.emissions(x)
        n, steps, _ = e.shape
        tr, g = self.p["trans"], {k: np.zeros_like(v) for k, v in self.p.items()}

        def lse(v, axis):
            m = v.max(axis, keepdims=True)
            return np.log(np.exp(v - m).sum(axis)) + m.squeeze(axis)

        alpha, beta = [e[:, 0]], [np.zeros((n, TAGS))]
        for t in range(1, steps):
            alpha.append(e[:, t] + lse(alpha[-1][:, :, None] + tr, 1))
        for t in range(steps - 1, 0, -1):
            beta.append(lse(tr + (e[:, t] + beta[-1])[:, None, :], 2))
        alpha, beta = np.stack(alpha, 1), np.stack(beta[::-1], 1)
        z = lse(alpha[:, -1], 1)
        rows = np.arange(n)[:, None]
        de = np.exp(alpha + beta - z[:, None, None])
        gold = e[rows, np.arange(steps), y].sum(1) + tr[y[:, :-1], y[:, 1:]].sum(1)
        de[rows, np.arange(steps), y] -= 1
        for t in range(1, steps):
            both = alpha[:, t - 1, :, None] + tr + (e[:, t] + beta[:, t])[:, None, :] - z[:, None, None]
            g["trans"] += np.exp(both).sum(0)
        np.add.at(g["trans"], (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        g["out"], g["bias"] = np.einsum("nth,ntk->hk", hs, de), de.sum((0, 1))
        dh_all = de @ self.p["out"].T
        for d, hist, dh_seq, seq in (("f", f, dh_all[:, :, : self.h], x), ("b", b, dh_all[:, ::-1, self.h:], x[:, ::-1])):
            dh, dc = np.zeros((n, self.h)), np.zeros((n, self.h))
            for t in range(steps - 1, -1, -1):
                i, fg, o, gg, before, prev, tc, _ = hist[t]
                dh = dh + dh_seq[:, t]
                dc = dc + dh * o * (1 - tc ** 2)
                dz = np.concatenate([dc * gg * i * (1 - i), dc * before * fg * (1 - fg), dh * tc * o * (1 - o), dc * i * (1 - gg ** 2)], 1)
                np.add.at(g[d + "x"], seq[:, t], dz)
                g[d + "h"] += prev.T @ dz
                dh, dc = dz @ self.p[d + "h"].T, dc * fg
        return float((z - gold).mean()), {k: v / n for k, v in g.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 3) -> Tagger:
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(w) for k, w in self.p.items()} for _ in range(2))
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(x), min(BATCH, len(x)))
            _, g = self.gradients(x[pick], y[pick])
            for k in self.p:
                m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.99 * v[k] + 0.01 * g[k] ** 2
                self.p[k] -= 0.02 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)
        return self

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tags of each window; a kind's inside only follows its begin or inside."""
        e = self.emissions(x)[0]
        tr = self.p["trans"].copy()
        for k in range(len(KINDS)):
            tr[[t for t in range(TAGS) if t not in (1 + 2 * k, 2 + 2 * k)], 2 + 2 * k] = -1e4
        score, back = e[:, 0], []
        for t in range(1, e.shape[1]):
            s = score[:, :, None] + tr
            back.append(s.argmax(1))
            score = s.max(1) + e[:, t]
        tags = [score.argmax(1)]
        for b in reversed(back):
            tags.append(b[np.arange(len(b)), tags[-1]])
        return np.stack(tags[::-1], 1)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """All spans of the joined tags of a whole text."""
        x = encode(text)
        half = WINDOW // 2
        marks = np.unique([m.start() // half for m in _TRIGGER.finditer(text)]) if _TRIGGER.search(text) else []
        if not len(marks):
            return []
        starts = np.unique(np.concatenate([np.asarray(marks) - 1, np.asarray(marks)])) * half
        padded = np.concatenate([np.full(half, 97), x, np.full(WINDOW, 97)])
        tags, deep = np.zeros(len(padded), np.int64), np.full(len(padded), -1)
        depth = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
        for i in range(0, len(starts), 1024):
            at = starts[i: i + 1024]
            got = self.decode(padded[(at + half)[:, None] + np.arange(WINDOW)])
            for a, row in zip((at + half).tolist(), got, strict=True):
                own = depth > deep[a: a + WINDOW]
                tags[a: a + WINDOW][own], deep[a: a + WINDOW][own] = row[own], depth[own]
        return spans_of(tags[half: half + len(x)])


def spans_of(tags: np.ndarray) -> list[tuple[str, int, int]]:
    out, t = [], 0
    hot = np.flatnonzero(tags)
    for i in hot.tolist():
        if i < t:
            continue
        kind, t = (int(tags[i]) - 1) // 2, i + 1
        while t < len(tags) and tags[t] == 2 + 2 * kind:
            t += 1
        out.append((KINDS[kind], i, t))
    return out


def labelled_windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows around every pattern match of ``texts`` with their tags."""
    xs, ys = [], []
    for text in texts:
        spans = base_spans(text)
        tags, x = np.zeros(len(text) + 2 * WINDOW, np.int64), np.concatenate([np.full(WINDOW, 97), encode(text), np.full(WINDOW, 97)])
        for k, a, b in spans:
            if not tags[WINDOW + a: WINDOW + b].any():
                tags[WINDOW + a], tags[WINDOW + a + 1: WINDOW + b] = 1 + 2 * KINDS.index(k), 2 + 2 * KINDS.index(k)
        for _, a, b in spans:
            at = max(0, WINDOW + (a + b) // 2 - WINDOW // 2 - (a * 7) % 24 + 12)
            xs.append(x[at: at + WINDOW]), ys.append(tags[at: at + WINDOW])
    keep = [i for i, x in enumerate(xs) if len(x) == WINDOW]
    return (np.array([xs[i] for i in keep]), np.array([ys[i] for i in keep])) if keep else (np.empty((0, WINDOW), int),) * 2


def train(docs: DataFrame, sample: int = SAMPLE) -> Tagger | None:
    """A tagger fitted on at most ``sample`` excerpts around base spans of all texts, those of the smallest hashes;
    None where no text has any."""

    def excerpts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, int] = {}  # a task's own smallest; never more than twice ``sample``
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, a, b in base_spans(text or ""):
                    t = text[max(0, a - BEFORE): min(b, a + WINDOW) + AFTER]
                    kept[t] = int.from_bytes(hashlib.blake2b(t.encode(), digest_size=7).digest(), "big")
                    if len(kept) > 2 * sample:
                        kept = dict(sorted(kept.items(), key=lambda x: (x[1], x[0]))[:sample])
        best = sorted(kept.items(), key=lambda x: (x[1], x[0]))[:sample]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in best], pa.string()), pa.array([h for _, h in best], pa.int64())], ["t", "h"])

    some = docs.select("text").mapInArrow(excerpts, "t string, h long").distinct().orderBy("h", "t").limit(sample)
    x, y = labelled_windows([r["t"] for r in some.collect()])
    return Tagger().fit(x, y) if len(x) else None


def all_spans(text: str, tagger: Tagger | None) -> list[tuple[str, int, int]]:
    """The patterns' spans and the tagger's, by kind and start."""
    base = base_spans(text)
    more = []
    for k, a, b in tagger.spans(text) if tagger is not None else []:
        s = text[a:b]
        form = {"email": "@" in s and "." in s, "ip": s.count(".") == 3 and len(_digits(s)) >= 4 and s.replace(".", "").isdigit(),
                "card": True, "phone": True}[k]
        if form and accepted(k, s) and not any(a < e and c < b for _, c, e in base):
            more.append((k, a, b))
    return sorted(base + more, key=lambda x: (KINDS.index(x[0]), x[1]))


def _text(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans per row of ``docs`` (doc_id, text; null: empty).

    The counts and base_sha256 are those of the patterns' spans; spans holds the tagger's as well.
    """
    weights = docs.sparkSession.sparkContext.broadcast(train(docs))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans")}
            out["doc_id"] = batch.column(0)
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s[0] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(_text(base).encode()).hexdigest())
                out["spans"].append(_text(all_spans(text or "", weights.value)))
            yield pa.RecordBatch.from_pydict(out)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets; overlapping spans become one."""
    weights = docs.sparkSession.sparkContext.broadcast(train(docs))

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for k, a, b in sorted(all_spans(text, weights.value), key=lambda x: x[1:]):
            if a >= at:
                out += [text[at:a], f"[{k}]"]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index("text")
            yield batch.set_column(i, "text", pa.array([clean(t) for t in batch.column(i).to_pylist()], pa.string()))

    return docs.mapInArrow(scan, docs.schema)
