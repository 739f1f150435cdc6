"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A text is a row of words (lower case runs of letters, digits and underscores; longer
ones than WORD_CHARS are cut into several). A word enters as the sum of two inputs'
projections: its own hashed vector, and the mean of the vectors of its hashed character
n-grams; words and n-grams of few documents learned from count as unknown, so that the
network cannot remember single documents. The network scores every window of WINDOW words, each half overlapping the
next; the highest window score, put on a logistic scale, is the document's.

Training learns from whole documents' labels: a toxic document's best windows stand
for it, a clean one's worst, chosen anew again and again. One component of the vectors
of words and n-grams starts with the log-odds of their documents, which helps where few
toxic documents are labelled; untrained, the network scores no better than chance.

Defined results: a null text is an empty one; a text without words gets the score of
an empty window. Without labelled rows of both classes every score is that class's
value (0 or 1; 0 without any label). Rows stand alone: repeats and order do not
matter. Repeated labels of an id count by majority. Further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm import common

QUERY = "op3_toxicity"

#: Words of a window and between the starts of two windows; characters of a word.
WINDOW, STRIDE, WORD_CHARS = 32, 16, 24
#: Hashed word and n-gram vectors, their width, and the width of a direction's state.
WORDS, GRAMS, WIDTH, HIDDEN = 1 << 14, 1 << 14, 16, 8
#: Learned from at most so many labelled documents of each class, whole ones, of so many characters together.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 900, 1300, 4_000_000
#: Steps of training at every size, windows of a step, first rate.
STEPS, BATCH, RATE = 240, 128, 0.01
#: Words and n-grams are known from so many learned documents on.
SEEN = 4
#: Share of the training after which the parameters' mean is taken.
AVERAGED = 0.3
#: Windows by which a toxic document teaches, in equal parts of the training.
TAKEN = (6, 6, 4, 3, 2, 2)
#: Distinct words a worker remembers with their projections, in two generations.
MEMORY = 150_000
#: Windows scored side by side; words of a text whose windows are held at once.
SIDE_BY_SIDE, LONG = 2048, 1 << 15

_WORD = re.compile(rf"\w{{1,{WORD_CHARS}}}")
#: Mixing constants for hashes of characters.
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def pieces(text: str | None) -> Iterator[list[str]]:
    """Runs of at most LONG words, each sharing its last window with the next: their windows are the text's."""
    if len(text or "") < LONG:
        yield words_of(text)
        return
    words: list[str] = []
    for m in _WORD.finditer(text.lower()):
        words.append(m[0])
        if len(words) == LONG:
            yield words
            words = words[-WINDOW:]
    yield words


def inputs_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word: its hash, its n-grams' hashes [word, slot], and which slots count.

    N-grams are those of 3 and 4 characters of the word with a mark at both ends.
    """
    wide = WORD_CHARS + 2
    codes = np.array(["\x02" + w + "\x03" for w in words], f"U{wide}").view(np.uint32).reshape(len(words), wide).astype(np.uint64)
    n = (codes > 0).sum(axis=1)
    powers = np.cumprod(np.full(wide, 0x01000193, np.uint64))
    whole = ((codes * powers).sum(axis=1) * _MIX[0]) >> np.uint64(17)
    slots, live = [], []
    for k in (3, 4):
        h = np.zeros((len(words), wide - k + 1), np.uint64)
        for j in range(k):
            h = (h ^ codes[:, j : wide - k + 1 + j]) * _MIX[j]
            h ^= h >> np.uint64(15)
        slots.append((h + np.uint64(k)) * _MIX[3] >> np.uint64(13))
        live.append(np.arange(wide - k + 1) + k <= n[:, None])
    grams = np.concatenate(slots, axis=1) % np.uint64(GRAMS)
    return (whole % np.uint64(WORDS)).astype(np.int32), grams.astype(np.int32), np.concatenate(live, axis=1)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters, forward pass over windows of projected words, and gradients."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        f = lambda *s, scale=1.0: (rng.standard_normal(s) * scale).astype(np.float32)
        h, d = HIDDEN, WIDTH
        self.p = {
            "word": f(WORDS, d, scale=0.1),
            "gram": f(GRAMS, d, scale=0.1),
            "in": f(2 * d, 2 * 3 * h, scale=(2 * d) ** -0.5),
            "bias": np.zeros(2 * 3 * h, np.float32),
            "state": f(2, h, 3 * h, scale=h**-0.5),
            "attend": f(2 * h, h, scale=(2 * h) ** -0.5),
            "focus": f(h, scale=h**-0.5),
            "out": f(2 * h, scale=(2 * h) ** -0.5),
            "out_bias": np.zeros(1, np.float32),
        }
        self.known_words, self.known_grams = np.ones(WORDS, bool), np.ones(GRAMS, bool)
        self.slope, self.shift = 1.0, 0.0

    def inputs(self, words: list[str]):
        """inputs_of(words) without what is unknown: hash 0 stands for an unknown word."""
        whole, grams, live = inputs_of(words)
        return np.where(self.known_words[whole], whole, 0), grams, live & self.known_grams[grams]

    def features(self, inputs) -> np.ndarray:
        whole, grams, live = inputs
        n = np.maximum(live.sum(axis=1, keepdims=True), 1)
        mean = np.empty((len(whole), WIDTH), np.float32)
        for k in range(0, len(whole), 8192):
            s = slice(k, k + 8192)
            mean[s] = (self.p["gram"][grams[s]] * live[s, :, None]).sum(axis=1) / n[s]
        return np.concatenate([self.p["word"][whole], mean], axis=1)

    def project(self, inputs) -> np.ndarray:
        """[word, both directions' gates]."""
        return self.features(inputs) @ self.p["in"] + self.p["bias"]

    def forward(self, rows: np.ndarray, index: np.ndarray, live: np.ndarray, keep: bool = False):
        """Scores of windows; rows are projected words, index [window, place], live [window, place]."""
        b, t = index.shape
        h = HIDDEN
        u = self.p["state"]
        states = np.zeros((t, 2, b, h), np.float32)
        now = np.zeros((2, b, h), np.float32)
        held = []
        gates = rows.reshape(len(rows), 2, 3 * h)
        for k in range(t):
            x = np.empty((2, b, 3 * h), np.float32)
            x[0], x[1] = gates[index[:, k], 0], gates[index[:, t - 1 - k], 1]
            a = now @ u
            zr = _sigmoid(x[:, :, : 2 * h] + a[:, :, : 2 * h])
            z, r = zr[:, :, :h], zr[:, :, h:]
            n = np.tanh(x[:, :, 2 * h :] + r * a[:, :, 2 * h :])
            m = np.stack([live[:, k], live[:, t - 1 - k]])[:, :, None]
            new = n + z * (now - n)
            if keep:
                held.append((now, z, r, n, a[:, :, 2 * h :], m))
            now = np.where(m, new, now)
            states[k, 0] = now[0]
            states[t - 1 - k, 1] = now[1]
        both = states.transpose(2, 0, 1, 3).reshape(b, t, 2 * h)
        look = np.tanh(both @ self.p["attend"])
        weight = np.where(live, look @ self.p["focus"], -1e9)
        weight = np.exp(weight - weight.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        pooled = (weight[:, :, None] * both).sum(axis=1)
        score = pooled @ self.p["out"] + self.p["out_bias"]
        return (score, (held, both, look, weight, pooled)) if keep else score

    def gradients(self, inputs, index, live, error, kept, rows_x):
        """Gradients of sum(error * score); embeddings come as (which, values)."""
        held, both, look, weight, pooled = kept
        b, t = index.shape
        h, p, g = HIDDEN, self.p, {}
        error = error[:, None]
        g["out"], g["out_bias"] = (error * pooled).sum(axis=0), error.sum(axis=0)
        d_pooled = error * p["out"]
        d_both = weight[:, :, None] * d_pooled[:, None]
        d_weight = (both * d_pooled[:, None]).sum(axis=2)
        d_weight = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        g["focus"] = (d_weight[:, :, None] * look).sum(axis=(0, 1))
        d_look = d_weight[:, :, None] * p["focus"] * (1 - look**2)
        g["attend"] = np.tensordot(both, d_look, ((0, 1), (0, 1)))
        d_both = d_both + d_look @ p["attend"].T
        d_state = d_both.reshape(b, t, 2, h)
        g["state"] = np.zeros_like(p["state"])
        gates = np.empty((b, t, 2, 3 * h), np.float32)
        d_now = np.zeros((2, b, h), np.float32)
        for k in range(t - 1, -1, -1):
            before, z, r, n, a_n, m = held[k]
            d = d_now.copy()
            d[0] += d_state[:, k, 0]
            d[1] += d_state[:, t - 1 - k, 1]
            d_new = np.where(m, d, 0)
            d_n = d_new * (1 - z) * (1 - n**2)
            d_z = d_new * (before - n) * z * (1 - z)
            d_r = d_n * a_n * r * (1 - r)
            d_gate = np.concatenate([d_z, d_r, d_n], axis=2)
            d_a = np.concatenate([d_z, d_r, d_n * r], axis=2)
            g["state"] += before.transpose(0, 2, 1) @ d_a
            d_now = np.where(m, d_new * z, d) + d_a @ p["state"].transpose(0, 2, 1)
            gates[:, k, 0], gates[:, t - 1 - k, 1] = d_gate
        hit, summed = _summed(index.ravel(), gates.reshape(b * t, -1))
        d_rows = np.zeros((len(rows_x), 6 * h), np.float32)
        d_rows[hit] = summed
        g["in"], g["bias"] = rows_x.T @ d_rows, d_rows.sum(axis=0)
        d_x = d_rows @ p["in"].T
        whole, grams, slots = inputs
        share = slots / np.maximum(slots.sum(axis=1, keepdims=True), 1)
        who, slot = np.nonzero(slots)
        return g, {"word": (whole, d_x[:, :WIDTH]), "gram": (grams[who, slot], d_x[who, WIDTH:] * share[who, slot, None])}

    def probability(self, best: np.ndarray) -> np.ndarray:
        return _sigmoid(np.clip(self.slope * best + self.shift, -60, 60))


class Rows:
    """Numbers of words, growing with the words asked for; 0 is the filler."""

    def __init__(self):
        self.of: dict[str, int] = {}

    def __call__(self, words: list[str]) -> list[int]:
        of = self.of
        return [of.setdefault(w, len(of) + 1) for w in words]


def windows(n: int) -> list[tuple[int, int]]:
    """Starts and ends of the overlapping windows of n words; the last reaches the end."""
    if n <= WINDOW:
        return [(0, n)]
    starts = [*range(0, n - WINDOW, STRIDE), n - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def grid(numbered: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts: word numbers [window, place], which places live, owner of each."""
    sizes = np.array([len(x) for x in numbered], np.int64)
    flat = np.array([w for x in numbered for w in x] + [0] * WINDOW, np.int64)
    first = np.cumsum(sizes) - sizes
    spans = [windows(int(n)) for n in sizes]
    owner = np.repeat(np.arange(len(numbered)), [len(s) for s in spans])
    edges = np.array([e for s in spans for e in s], np.int64).reshape(-1, 2)
    index = flat[(first[owner] + edges[:, 0])[:, None] + np.arange(WINDOW)]
    live = np.arange(WINDOW) < (edges[:, 1] - edges[:, 0])[:, None]
    return np.where(live, index, 0), live, owner


def _by_owner(scores: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    best = np.full(n, -np.inf, np.float32)
    np.maximum.at(best, owner, scores)
    return best


def _know(net: Network, rows: Rows, numbered: list[list[int]], y: np.ndarray, start: bool = True) -> np.ndarray:
    """Mark the words and n-grams of enough documents; with start, one of their vectors' components begins with the log-odds of their documents.

    Returns the log-odds of each numbered word.
    """
    whole, grams, live = inputs_of(["", *rows.of])
    words, parts = np.zeros((2, WORDS)), np.zeros((2, GRAMS))
    for x, label in zip(numbered, y.astype(int), strict=True):
        mine = np.array(sorted(set(x)), np.int64)
        words[label, np.unique(whole[mine])] += 1
        parts[label, np.unique(grams[mine][live[mine]])] += 1
    n = np.bincount(y.astype(int), minlength=2)[:, None]
    for name, counts in (("word", words), ("gram", parts)):
        known = counts.sum(axis=0) >= SEEN
        setattr(net, f"known_{name}s", known)
        if start:
            odds = np.log((counts + 2) / (n + 4))
            net.p[name][:, 0] = np.where(known, np.clip(odds[1] - odds[0], -3, 3) / 3, 0)
    net.p["word"][0], net.known_words[0] = 0, True
    return np.where(net.known_words[whole], net.p["word"][whole, 0], 0) if start else np.zeros(len(whole))


def _summed(who: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in who, and the sums of their rows of values."""
    order = np.argsort(who, kind="stable")
    hit, begin = np.unique(who[order], return_index=True)
    return hit, np.add.reduceat(values[order], begin, axis=0) if len(hit) else values[:0]


def train(texts: list[str], labels: list[int], seed: int = 7, start: bool = True, steps: int = STEPS) -> Network:
    """Fit the network on whole documents; start and steps are for ablation."""
    net, rng = Network(seed), np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        net.p["out"][:], net.slope, net.shift = 0, 0.0, (60.0 if labels and labels[0] else -60.0)
        return net
    rows = Rows()
    numbered = [rows(words_of(t)) for t in texts]
    index, live, owner = grid(numbered)
    odds = _know(net, rows, numbered, y, start)
    inputs = net.inputs(["", *rows.of])
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items() if k not in ("word", "gram")}
    squares = {k: np.full(len(net.p[k]), 1e-6, np.float32) for k in ("word", "gram")}
    mean, averaged, step = {k: np.zeros_like(v) for k, v in net.p.items()}, 0, 0

    def scored(which):
        if not len(which):
            return np.zeros(0, np.float32)
        projected = net.project(inputs)
        return np.concatenate([net.forward(projected, index[w], live[w]) for w in np.array_split(which, -(-len(which) // SIDE_BY_SIDE))])

    everything = np.arange(len(owner))
    clean = everything[y[owner] == 0]
    toxic = everything[y[owner] == 1]
    while step < steps:
        # A clean document's worst windows are sought in a third of its windows, another in each epoch.
        scores = rng.random(len(owner)).astype(np.float32) - 1e6
        if not step and start:
            scores = odds[index].max(axis=1)
        if step:
            asked = np.concatenate([toxic, clean[rng.random(len(clean)) < 0.34]])
            scores[asked] = scored(asked)
        order = np.lexsort((-scores, owner))
        place = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        # At first a toxic document teaches by many windows, later by its best.
        take = place < np.where(y[owner[order]] == 1, TAKEN[step * len(TAKEN) // max(1, steps)], 2)
        chosen = np.concatenate([order[take], rng.choice(clean, min(len(texts) // 2, len(clean)), replace=False)])
        chosen = rng.permutation(chosen)
        # Both classes weigh the same.
        up = max(1.0, float((y[owner[chosen]] == 0).sum()) / max(1.0, float((y[owner[chosen]] == 1).sum())))
        rate = RATE * (1 - step / max(1, steps)) + 1e-4
        for k in range(0, BATCH * min(-(-len(chosen) // BATCH), steps - step), BATCH):
            some = chosen[k : k + BATCH]
            own, local = np.unique(index[some], return_inverse=True)
            local = local.reshape(len(some), WINDOW)
            mine = tuple(x[own] for x in inputs)
            x = net.features(mine)
            score, kept = net.forward(x @ net.p["in"] + net.p["bias"], local, live[some], keep=True)
            target = y[owner[some]]
            error = (_sigmoid(score) - target) * np.where(target == 1, up, 1.0).astype(np.float32) / len(some)
            g, sparse = net.gradients(mine, local, live[some], error, kept, x)
            step += 1
            for name, v in g.items():
                v = np.clip(v + 1e-4 * net.p[name], -1, 1)
                m = moments[name]
                m[0] = 0.9 * m[0] + 0.1 * v
                m[1] = 0.999 * m[1] + 0.001 * v * v
                net.p[name] -= (rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            for name, (who, v) in sparse.items():
                hit, v = _summed(who, v)
                squares[name][hit] += (v**2).mean(axis=1)
                net.p[name][hit] -= 5 * rate * v / np.sqrt(squares[name][hit])[:, None]
            if step > AVERAGED * steps:
                for name, v in net.p.items():
                    mean[name] += v
                averaged += 1
    if averaged:
        net.p = {name: v / averaged for name, v in mean.items()}
    # A logistic scale for the best window's score, fitted by Newton's steps.
    best = _by_owner(scored(everything), owner, len(texts)).astype(float)
    a, b = 1.0, 0.0
    smooth = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(50):
        q = _sigmoid(np.clip(a * best + b, -60, 60))
        w = np.maximum(q * (1 - q), 1e-6)
        grad = np.array([((q - smooth) * best).sum() + 1e-2 * (a - 1), (q - smooth).sum()])
        hess = np.array([[(w * best * best).sum() + 1e-2, (w * best).sum()], [(w * best).sum(), w.sum()]])
        da, db = np.clip(np.linalg.solve(hess, grad), -1, 1)
        a, b = max(a - da, 0.05), b - db
    net.slope, net.shift = float(a), float(b)
    return net


class Scorer:
    """Scores texts with a trained network; remembers words' projections."""

    def __init__(self, net: Network):
        self.net = net
        self.filler = net.project(net.inputs([""]))
        self.of: dict[str, int] = {}
        self.rows = np.zeros((MEMORY + 1, self.filler.shape[1]), np.float32)
        self.rows[0] = self.filler[0]

    def _number(self, words: list[list[str]]) -> list[list[int]]:
        of = self.of
        new = list({w for x in words for w in x if w not in of})
        if len(of) + len(new) > MEMORY:
            of.clear()
            new = list({w for x in words for w in x})
        if len(new) > len(self.rows) - 1:  # more distinct words in one batch than are remembered
            self.rows = np.resize(self.rows, (len(new) + 1, self.rows.shape[1]))
            self.rows[0] = self.filler[0]
        for k in range(0, len(new), 4096):
            some = new[k : k + 4096]
            at = len(of) + 1
            self.rows[at : at + len(some)] = self.net.project(self.net.inputs(some))
            of.update((w, at + j) for j, w in enumerate(some))
        return [[of[w] for w in x] for x in words]

    def _best(self, words: list[list[str]]) -> np.ndarray:
        """The highest window score of each run of words."""
        index, live, owner = grid(self._number(words))
        scores = [self.net.forward(self.rows, index[k : k + SIDE_BY_SIDE], live[k : k + SIDE_BY_SIDE]) for k in range(0, len(owner), SIDE_BY_SIDE)]
        return _by_owner(np.concatenate(scores), owner, len(words))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        best = np.full(len(texts), -np.inf)
        held: list[list[str]] = []
        owner: list[int] = []
        size = 0
        for k, text in enumerate(texts):
            for words in pieces(text):
                held.append(words)
                owner.append(k)
                size += len(words)
                if size >= LONG:
                    np.maximum.at(best, owner, self._best(held))
                    held, owner, size = [], [], 0
        if held:
            np.maximum.at(best, owner, self._best(held))
        return self.net.probability(best)


def learn(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Network:
    """Train on a bounded hash sample of the documents (doc_id, text) with a label (label_id, y)."""
    counts = {r["y"]: r["n"] for r in labels.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return train([], [])
    at = F.pmod(F.xxhash64("label_id"), F.lit(1_000_000))
    share = F.when(F.col("y") == 1, F.lit(toxic / max(1, counts.get(1, 0)))).otherwise(F.lit(clean / max(1, counts.get(0, 0))))
    some = labels.where(at < 1_000_000 * share).limit(2 * (toxic + clean))
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = own.join(F.broadcast(some), own["doc_id"] == some["label_id"]).select("doc_id", "text", "y").distinct()
    # Of each class the first by hash that hold so many characters together, so that the driver's part is bounded.
    first = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum(F.length("text") + F.lit(1)).over(first)).where(F.col("upto") <= SAMPLE_CHARS)
    rows = sorted(rows.select("doc_id", "text", "y").collect(), key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"] for r in rows], [r["y"] for r in rows])


def score(docs: DataFrame, net: Network, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns and score of every whole text."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    shipped = spark.sparkContext.broadcast(net)
    source = docs.select(*keep, F.col("text").alias("__text"))

    def run(batches):
        scorer = Scorer(shipped.value)
        for batch in batches:
            found = scorer(batch.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(found, pa.float64())], names=[*keep, "score"])
        del scorer
        common.tidy()

    return source.mapInArrow(run, source.select(*keep).schema.add("score", "double"))


def train_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that may be learned from: the folds other than the held-out one."""
    labels = common.label_of(common.read(spark, sf_dir, "labels"), "toxic")
    return labels.where(common.fold(F.col("label_id"), 5) != 0)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    out = score(docs, learn(docs, train_labels(spark, sf_dir)))
    return out.select(
        "doc_id",
        F.coalesce(common.fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
