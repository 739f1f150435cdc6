"""Language identification by cross-parsing entropy.

One suffix automaton per language is built from labelled text. A text is parsed from
left to right into the longest phrases that occur in a language's text; the language
needing the fewest phrases, each weighted by the bits that name a place in its text
(log2 of that text's length) and divided by the text's length, wins.

Defined results: a text that is null or has no letter is `und` with score 0; so is
every text if no labelled text was learned. Ties go to the alphabetically first
language. Text is compared in lower case with every run of other characters than
letters as one space. Rows stand alone: repeats and order do not matter; further
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import common

QUERY = "op4_language"

#: Learned from at most so many documents, whole ones, and so many letters and spaces of a language.
SAMPLE_DOCUMENTS, SAMPLE_CHARS = 120, 40_000
#: Symbols with a column of their own in the tables of transitions; those of others are sorted pairs.
ALPHABET = 62
#: A text is parsed in stretches of this many characters, at whose ends a phrase ends too.
STRETCH = 512
#: Stretches parsed side by side.
SIDE_BY_SIDE = 8192


def letters(text: str) -> str:
    """Lower case letters, with one space for each run of anything else."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class Symbols:
    """Numbers for characters: 1.. for the learned ones, most frequent first, 0 for all others."""

    def __init__(self, samples: dict[str, str]):
        counts: dict[str, int] = {}
        for text in samples.values():
            for c in text:
                counts[c] = counts.get(c, 0) + 1
        known = sorted(counts, key=lambda c: (-counts[c], c))
        self.size = len(known) + 1
        self.wide = min(self.size, ALPHABET + 1)
        self.of = {c: k + 1 for k, c in enumerate(known)}
        self.table = np.zeros(0x10000, np.int32)
        for c, k in self.of.items():
            if ord(c) < 0x10000:
                self.table[ord(c)] = k
        letter = np.array([chr(c).isalpha() for c in range(0x10000)])
        self.letter = letter
        self.space = self.of.get(" ", 0)

    def numbers(self, text: str) -> np.ndarray:
        """letters(text) as numbers."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        low = np.minimum(codes, 0xFFFF)
        is_letter = self.letter[low]
        beyond = np.flatnonzero(codes > 0xFFFF)
        if len(beyond):
            is_letter[beyond] = [chr(c).isalpha() for c in codes[beyond].tolist()]
        out = self.table[low]
        if len(beyond):
            out[beyond] = [self.of.get(chr(c), 0) for c in codes[beyond].tolist()]
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]  # the first of a run of others stays, as a space
        out[~is_letter] = self.space
        kept = out[keep]
        if len(kept) and keep[0] and not is_letter[0]:
            kept = kept[1:]
        if len(kept) and not is_letter[-1] and len(is_letter) > 1 and is_letter[:-1].any() and keep[-1]:
            kept = kept[:-1]
        elif len(kept):
            last = np.flatnonzero(keep)[-1]
            if not is_letter[last]:
                kept = kept[:-1]
        return kept


def automaton(numbers: list[int], size: int, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix automaton's transitions: [state, symbol] for symbols below wide, and keys state * size + symbol, sorted, with targets for the others; 0, the root, stands for none."""
    after: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in numbers:
        now = len(after)
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in after[p]:
            after[p][c] = now
            p = link[p]
        if p >= 0:
            q = after[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                twin = len(after)
                after.append(dict(after[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and after[p].get(c) == q:
                    after[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    out = np.zeros((len(after), wide), np.int32)
    rare = []
    for s, row in enumerate(after):
        for c, to in row.items():
            if c < wide:
                out[s, c] = to
            else:
                rare.append((s * size + c, to))
    # The last key is beyond all others, so that every search ends on one.
    rare = np.array([*sorted(rare), (len(after) * size, 0)], np.int64)
    return out.ravel(), rare[:, 0], rare[:, 1].astype(np.int32)


class CrossParser:
    """Phrase costs of texts in every learned language."""

    def __init__(self, samples: dict[str, str]):
        samples = {k: v for k, v in sorted(samples.items()) if v.strip()}
        self.names = list(samples)
        self.symbols = Symbols(samples)
        self.tables, self.bits = [], []
        for text in samples.values():
            numbers = [self.symbols.of.get(c, 0) for c in text]
            self.tables.append(automaton(numbers, self.symbols.size, self.symbols.wide))
            self.bits.append(math.log2(len(numbers) + 1))

    def phrases(self, stretches: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """[language, stretch] number of phrases; stretches are sorted by falling length."""
        out = np.zeros((len(self.names), len(lengths)), np.int64)
        size, wide = self.symbols.size, self.symbols.wide
        rare = stretches >= wide if size > wide else None
        rare_at = rare.any(axis=0) if rare is not None else np.zeros(stretches.shape[1], bool)
        for k, (table, keys, targets) in enumerate(self.tables):

            def follow(state: np.ndarray, c: np.ndarray, some: bool) -> np.ndarray:
                if not some:
                    return table[state * wide + c]
                few = c >= wide
                to = table[state * wide + np.where(few, 0, c)]
                key = state[few].astype(np.int64) * size + c[few]
                at = np.searchsorted(keys, key)
                to[few] = np.where(keys[at] == key, targets[at], 0)
                return to

            state = np.zeros(len(lengths), np.int32)
            count = out[k]
            live = np.searchsorted(-lengths, -np.arange(1, stretches.shape[1] + 1), side="right")
            for t in range(stretches.shape[1]):
                n = live[t]
                if not n:
                    break
                c = stretches[:n, t]
                to = follow(state[:n], c, rare_at[t])
                lost = np.flatnonzero(to == 0)
                if len(lost):
                    count[lost] += 1
                    to[lost] = follow(np.zeros(len(lost), np.int32), c[lost], rare_at[t])
                state[:n] = to
            count += 1  # the last phrase
        return out

    def costs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """[text, language] bits a character, and each text's number of characters."""
        numbers = [self.symbols.numbers(t) if t else np.zeros(0, np.int32) for t in texts]
        sizes = np.array([len(x) for x in numbers], np.int64)
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        total = np.zeros((len(texts), len(self.names)))
        flat = np.concatenate([np.zeros(0, np.int32), *numbers])
        first = np.cumsum(sizes) - sizes
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = first[owner] + nth * STRETCH
        length = np.minimum(STRETCH, sizes[owner] - nth * STRETCH)
        order = np.argsort(-length, kind="stable")
        flat = np.concatenate([flat, np.zeros(STRETCH, np.int32)])
        for k in range(0, len(order), SIDE_BY_SIDE):
            some = order[k : k + SIDE_BY_SIDE]
            block = flat[begin[some][:, None] + np.arange(int(length[some[0]]))]
            found = self.phrases(block, length[some])
            for j, bits in enumerate(self.bits):
                np.add.at(total[:, j], owner[some], found[j] * bits)
        return total / np.maximum(sizes, 1)[:, None], sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.names:
            return ["und"] * len(texts), [0.0] * len(texts)
        cost, sizes = self.costs(texts)
        best = cost.argmin(axis=1)
        ordered = np.sort(cost, axis=1)
        second = ordered[:, 1] if len(self.names) > 1 else np.full(len(texts), np.inf)
        with np.errstate(invalid="ignore"):
            score = np.where(np.isinf(second), 1.0, 1 - ordered[:, 0] / np.maximum(ordered[:, 0] + second, 1e-12))
        none = sizes == 0
        names = [("und" if none[i] else self.names[b]) for i, b in enumerate(best)]
        return names, np.where(none, 0.0, score).tolist()


def learn(labelled: DataFrame, documents: int = SAMPLE_DOCUMENTS, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Per language, the letters of a bounded sample of whole documents (text, lang, doc_id)."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    # A hash picks the sample, so that it does not depend on the order of rows; of rows too long for it one is the last resort.
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2 * documents / n))])
    at = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1_000_000)) / 1_000_000
    fits = F.length("text") <= chars
    some = labelled.where(fits & (at < share[F.col("lang")])).select("lang", "text", at.alias("at"), "doc_id").limit(4 * documents * len(counts)).collect()
    rows = sorted(some, key=lambda r: (r["lang"], r["at"], r["doc_id"] or 0, r["text"]))
    short = labelled.groupBy("lang").agg(F.min_by(F.substring("text", 1, chars), F.struct(F.length("text"), "text")).alias("text")).collect()
    out: dict[str, str] = {}
    used: dict[str, int] = {}
    for r in [*rows, *sorted(short, key=lambda r: r["lang"])]:
        lang, text = r["lang"], letters(r["text"])
        # Whole documents, as long as they fit.
        if text and used.get(lang, 0) < documents and len(out.get(lang, "")) + len(text) < chars or lang not in out:
            used[lang] = used.get(lang, 0) + 1
            out[lang] = (out.get(lang, "") + " " + text).strip()
    return {k: v[:chars] for k, v in out.items()}


def identify(docs: DataFrame, samples: dict[str, str], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns, lang_pred and score of every whole text."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    parser = CrossParser(samples)
    shipped = spark.sparkContext.broadcast(parser)
    source = docs.select(*keep, F.col("text").alias("__text"))
    schema = source.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        parser = shipped.value
        for batch in batches:
            names, scores = parser.predict(batch.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    return source.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    remainder = common.fold(F.col("doc_id"), 4)
    samples = learn(docs.where((remainder != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang"))
    out = identify(docs, samples)
    return out.select("doc_id", F.coalesce(common.fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
