"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A text's k-mers are its runs of five and of three words (runs without ASCII white
space), each labelled with its occurrence, so that repeats differ. A sketch holds,
under each of SKETCHES orders of hashes for the long and SHORT_SKETCHES for the short
ones, the KMERS least labelled k-mers in the order in which they stand in the text; it
is sensitive to edits and moves, not to sets alone. Texts that agree in one of them
share a bucket and are candidates.

Equal texts are first made one. A candidate pair counts if its edit similarity over
words, 1 - distance / longer length, reaches SIMILARITY, by an alignment in a band that
just holds the edits this allows. In each of ROUNDS rounds every bucket has a leader for
each span of sizes, by an order of the round, and a text is compared with one leader,
that with which it shares most buckets. A bucket whose members are then linked to each
other, if through other buckets, is settled and takes no further part. Then, in all
others, every pair that is not yet linked is compared, in blocks of BLOCK by BLOCK
members: those that differ too much in their counts of words to be similar need no
alignment, the others are aligned by 16 bits of each word, which can only make them more
alike, and what a block's own links have joined needs no further look. The links a block
finds are aligned again by whole words; should one of them not hold, all pairs of its
bucket still not linked are looked at once more, without that saving.
Classes are the connected components of the links; a class is named by its least doc_id.
Keys that many rows share (a bucket, a leader, a hub, a root, a text) are dealt into
SALTS parts wherever rows meet by them.

Defined results: null and empty texts are equal texts; texts of fewer words than a
k-mer are one k-mer. Repeated rows are in one class. A null doc_id counts as less than all
others. Further columns are kept by deduplicate().
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import common

QUERY = "op7_neardup"

#: Words of a k-mer, edit similarity of near duplicates.
WORDS, SIMILARITY = 5, 0.8
#: Orders of hashes, and k-mers sampled under each.
SKETCHES, KMERS = 12, 2
#: Words of a short k-mer, and orders of hashes for those.
SHORT, SHORT_SKETCHES = 3, 32
#: Hashes of k-mers that are ordered at once.
AT_ONCE = 1 << 17
#: Places of a text's counts of words, a power of two from its number of words on; members on a side of a block of pairs.
PLACES, MOST_PLACES, BLOCK = 64, 8192, 256
#: Words up to which a block holds the words of a text; of longer ones it holds their counts alone.
MOST_WORDS = 1 << 14
#: Edits up to which an alignment follows diagonals rather than columns.
FEW = 6
#: Rounds in which a text is compared with one leader, before all pairs not linked by then.
ROUNDS = 2
#: Rows from which on a key counts as hot, parts its rows are dealt into, hot keys that are broadcast at most (24 bytes each).
HOT, SALTS, BROADCAST_KEYS = 1024, 32, 200_000
#: Distinct texts by whose hashes a task knows that it has sketched them.
KNOWN = 1 << 17
#: Rounds of labels after which something must be wrong (they halve every path).
MOST_JOINS = 300

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _seeds(n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * _ODD)


class Words:
    """64-bit hashes of a text's words, its runs without ASCII white space.

    A word's hash is a sum over its bytes of a byte's number times a power for its
    place, mixed with the word's length; all words of a text at once.
    """

    def __init__(self):
        self.number = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
        self.number[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = 0
        self.power = np.ones(1, np.uint64)

    def __call__(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        number = self.number[raw]
        inside = number != 0
        starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
        if not len(starts):
            return np.zeros(0, np.uint64)
        spans = np.diff(np.r_[starts, len(raw)])
        longest = int(spans.max())
        if longest > len(self.power):
            self.power = np.cumprod(np.full(2 * longest, _ODD))
        place = np.arange(starts[0], len(raw)) - np.repeat(starts, spans)
        sums = np.add.reduceat(number[starts[0] :] * self.power[place], starts - starts[0])
        lengths = np.add.reduceat(inside[starts[0] :].astype(np.uint64), starts - starts[0])
        return _mixed(sums + lengths * _ODD)


def kmers(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Hashes of the occurrence-labelled k-mers, in order of the text."""
    n = len(words)
    if n == 0:
        return np.zeros(1, np.uint64)
    k = min(size, n)
    h = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        h = _mixed(h + words[j : n - k + 1 + j] + _ODD)
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    fresh = np.r_[True, ranked[1:] != ranked[:-1]]
    if not fresh.all():
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(h)), 0))
        label = np.empty(len(h), np.uint64)
        label[order] = (np.arange(len(h)) - start).astype(np.uint64)
        # First occurrences keep their number: another text may have the k-mer once.
        h = np.where(label > 0, _mixed(h + label * _ODD), h)
    return h


def order_min_hash(words: np.ndarray, sketches: int = SKETCHES, sampled: int = KMERS, size: int = WORDS) -> np.ndarray:
    """One 64-bit number for each sketch: the sampled k-mers in order of the text."""
    h = kmers(words, size)
    take = min(sampled, len(h))
    seeds = _seeds(sketches)
    number = seeds.copy()
    # As many orders at once as AT_ONCE numbers allow.
    step = max(1, AT_ONCE // len(h))
    for a in range(0, sketches, step):
        some = slice(a, a + step)
        x = _mixed(h ^ seeds[some, None])
        places = np.argpartition(x, take - 1, axis=1)[:, :take] if take < len(h) else np.tile(np.arange(take), (len(x), 1))
        picked = h[np.sort(places, axis=1)]
        for k in range(take):
            number[some] = _mixed(number[some] + picked[:, k] + _ODD)
    return number


def band_values(words: np.ndarray) -> np.ndarray:
    """The numbers of a text's buckets: its sketches of long, then of short k-mers."""
    return np.concatenate([order_min_hash(words), order_min_hash(words, SHORT_SKETCHES, KMERS, SHORT)])


def word_counts(words: np.ndarray) -> np.ndarray:
    """Counts of words by places, dealt by their hashes; capped, which only lessens differences."""
    places = min(MOST_PLACES, max(PLACES, 1 << max(0, len(words) - 1).bit_length()))
    return np.minimum(np.bincount((words % np.uint64(places)).astype(np.int64), minlength=places), 0xFF).astype(np.uint8)


def held_of(words: np.ndarray) -> bytes:
    """What a block holds of a text: 16 bits of each word's hash in order, or the counts of words of a long one."""
    return (words & np.uint64(0xFFFF)).astype("<u2").tobytes() if len(words) <= MOST_WORDS else word_counts(words).tobytes()


def may_be_similar(sizes: np.ndarray, counts: list[np.ndarray], more_sizes: np.ndarray, more_counts: list[np.ndarray], asked: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Of the pairs asked [i, j], those whose texts can be similar: as far as their counts of words tell, enough is shared."""
    longest = np.maximum(sizes[:, None], more_sizes[None, :])
    most = ((1 - similarity) * longest + 1e-9).astype(np.int64)
    out = asked & (np.abs(sizes[:, None] - more_sizes[None, :]) <= most)
    places = np.array([len(c) for c in more_counts])
    at = np.zeros(len(more_counts), np.int64)
    held: dict[tuple[int, int], np.ndarray] = {}  # counts of the others by their places, folded to fewer
    for n in np.unique(places).tolist():
        same = np.flatnonzero(places == n)
        at[same] = np.arange(len(same))
        held[n, n] = np.stack([more_counts[j] for j in same])
    for i in np.flatnonzero(out.any(axis=1)):
        js = np.flatnonzero(out[i])
        mine = counts[i]
        beyond = int(sizes[i]) - int(mine.sum(dtype=np.int64))  # words over the cap
        for n in np.unique(places[js]).tolist():
            some = js[places[js] == n]
            to = min(n, len(mine))
            if (n, to) not in held:
                held[n, to] = held[n, n].reshape(-1, n // to, to).sum(axis=1, dtype=np.int32)
            own = mine if len(mine) == to else mine.reshape(-1, to).sum(axis=0, dtype=np.int32)
            shared = np.minimum(own, held[n, to][at[some]]).sum(axis=1, dtype=np.int64) + beyond
            out[i, some] = longest[i, some] - shared <= most[i, some]
    return out


def distance_within(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance over words if it is at most most, else most + 1: alignment in a band about the diagonal."""
    if len(a) > len(b):
        a, b = b, a
    # Equal ends need no alignment.
    n = len(a)
    same = a == b[:n]
    head = n if same.all() else int(same.argmin())
    a, b = a[head:], b[head:]
    n = len(a)
    same = a[::-1] == b[::-1][:n]
    tail = n if same.all() else int(same.argmin())
    a, b = a[: n - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    if m - n > most:
        return most + 1
    if n == 0:
        return m
    # Words that one has in excess of the other bound the distance from below.
    both = np.concatenate([a, b])
    _, which = np.unique(both, return_inverse=True)
    size = int(which.max()) + 1
    shared = int(np.minimum(np.bincount(which[:n], minlength=size), np.bincount(which[n:], minlength=size)).sum())
    if m - shared > most:
        return most + 1
    if most <= FEW:
        return _along_diagonals(which[:n], which[n:], most)
    return _by_bits(which[:n].tolist(), which[n:].tolist(), most)


def _by_bits(a: list[int], b: list[int], most: int) -> int:
    """Edit distance if it is at most most, else most + 1: a column of the alignment is two numbers, of a bit a row."""
    n, m = len(a), len(b)
    full, high = (1 << n) - 1, 1 << (n - 1)
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    up, down, distance = full, 0, n
    for j, y in enumerate(b, 1):
        same = places.get(y, 0)
        either = same | down
        across = (((same & up) + up) ^ up) | same
        more = down | (full & ~(across | up))
        less = up & across
        if more & high:
            distance += 1
        elif less & high:
            distance -= 1
        if distance - (m - j) > most:
            return most + 1
        more = more << 1 | 1
        up = (less << 1 | ~(either | more)) & full
        down = more & either & full
    return distance if distance <= most else most + 1


def _along_diagonals(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance if it is at most most, else most + 1.

    In a band of diagonals about the main one that widens with every edit spent, each
    diagonal holds the furthest row that so many edits reach; from there a diagonal is
    followed to its next mismatch. Memory is that of the texts and two rows of the band.
    """
    n, m = len(a), len(b)
    rows, columns = a.tolist(), b.tolist()

    def follow(k: int, i: int) -> int:
        """The row of the first mismatch on diagonal k (column = row + k) from row i on."""
        end, step = min(n, m - k), 16
        if i >= end or rows[i] != columns[i + k]:
            return i
        while i < end:
            differs = a[i : min(end, i + step)] != b[i + k : min(end, i + step) + k]
            at = int(differs.argmax())
            if differs[at]:
                return i + at
            i += len(differs)
            step *= 2
        return end

    goal = m - n
    reach = {0: follow(0, 0)}
    if goal == 0 and reach[0] >= n:
        return 0
    none = -1 << 60
    for e in range(1, most + 1):
        new = {}
        # Diagonals from which the rest of the edits can't reach the goal are left out.
        for k in range(max(-e, -n, goal - (most - e)), min(e, m, goal + (most - e)) + 1):
            i = max(reach.get(k, none) + 1, reach.get(k - 1, none), reach.get(k + 1, none) + 1)
            i = min(i, n, m - k)
            if i < 0 or i + k < 0:
                continue
            new[k] = follow(k, i)
        if new.get(goal, none) >= n:
            return e
        reach = new
    return most + 1


def distance_at_most(a: np.ndarray, b: np.ndarray, span: int = 3) -> int:
    """A bound of the edit distance from above: the cost of one alignment.

    Runs of span words that occur once in either text, in the same order, are its
    anchors; what lies between two neighbouring anchors is aligned on its own.
    """
    if min(len(a), len(b)) < span:
        return max(len(a), len(b))
    runs = []
    for x in (a, b):
        h = np.zeros(len(x) - span + 1, np.uint64)
        for j in range(span):
            h = _mixed(h + x[j : len(x) - span + 1 + j] + _ODD)
        value, first, times = np.unique(h, return_index=True, return_counts=True)
        runs.append((value[times == 1], first[times == 1]))
    _, i, j = np.intersect1d(runs[0][0], runs[1][0], assume_unique=True, return_indices=True)
    i, j = runs[0][1][i], runs[1][1][j]
    order = np.argsort(i)
    i, j = i[order], j[order]
    # Only anchors that no other crosses.
    if len(j):
        free = (j == np.maximum.accumulate(j)) & (j == np.minimum.accumulate(j[::-1])[::-1])
        i, j = i[free], j[free]
    i, j = np.r_[0, i, len(a)], np.r_[0, j, len(b)]
    rows, columns = np.diff(i), np.diff(j)
    level = rows == columns
    # Between anchors on one diagonal words stand against each other.
    on = np.repeat(level, rows)
    against = np.arange(len(a)) + np.repeat(j[:-1] - i[:-1], rows)
    cost = int((a[on] != b[against[on]]).sum())
    for k in np.flatnonzero(~level):
        x, y = a[i[k] : i[k + 1]], b[j[k] : j[k + 1]]
        longest = max(len(x), len(y))
        cost += distance_within(x, y, longest) if longest <= 200 else longest
    return cost


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    longest = max(len(a), len(b))
    most = int((1 - similarity) * longest + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    return distance_at_most(a, b) <= most or distance_within(a, b, most) <= most


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, t1, t2) with two hashes that name the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(text, F.lit("second")).alias("t2"))


def meet(rows: DataFrame, side: DataFrame, keys: list[str], hot: DataFrame, by: str, how: str = "inner") -> DataFrame:
    """rows joined with side by keys; the rows of keys in hot are dealt by the column by, with a copy of side's row for each part."""
    n = hot.limit(BROADCAST_KEYS + 1).count()
    if not n:
        return rows.join(side, keys, how)
    many = F.lit(True)  # more hot keys than can be broadcast: every key is dealt out
    if n <= BROADCAST_KEYS:
        mark = F.broadcast(hot.select(*keys, F.lit(True).alias("__hot")))
        rows, side, many = rows.join(mark, keys, "left"), side.join(mark, keys, "left"), F.col("__hot").isNotNull()
    parts = F.when(many, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("__salt", F.when(many, F.pmod(F.xxhash64(by, F.lit("salt")), F.lit(SALTS)).cast("int")).otherwise(0)).drop("__hot")
    side = side.withColumn("__salt", F.explode(parts)).drop("__hot")
    return rows.join(side, [*keys, "__salt"], how).drop("__salt")


def hot_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys of more than HOT rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > HOT).drop("__n")


def sketches(docs: DataFrame) -> DataFrame:
    """(t1, t2, keys, size, held): bucket numbers, number of words and what a block holds of every distinct text, some of them more than once."""
    common.bound_batches(docs.sparkSession)
    source = _texts(docs).select("t1", "t2", "text")

    def run(batches):
        words = common.worker_state("neardup_words", Words)
        known: set[tuple[int, int]] = set()
        for batch in batches:
            if len(known) > KNOWN:
                known.clear()
            names, new = zip(batch.column("t1").to_pylist(), batch.column("t2").to_pylist(), strict=True), []
            for name in names:
                new.append(name not in known)
                known.add(name)
            batch = batch.filter(pa.array(new, pa.bool_()))
            texts = [words(t) for t in batch.column("text").to_pylist()]
            keys = pa.array([band_values(w).view(np.int64) for w in texts], pa.list_(pa.int64()))
            sizes = pa.array([len(w) for w in texts], pa.int32())
            held = pa.array([held_of(w) for w in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("t1"), batch.column("t2"), keys, sizes, held], names=["t1", "t2", "keys", "size", "held"])
        common.tidy()

    return source.mapInArrow(run, "t1 long, t2 long, keys array<long>, size int, held binary")


def unlinked_pairs(members: DataFrame, sparing: bool = True) -> DataFrame:
    """Pairs (a, b, known, band, value) of a bucket's members that are not linked yet and are similar, as far as 16 bits of each word tell (known) or counts of words; members: (band, value, n, node, root, size, keys, held).

    A bucket of n members is dealt into blocks, and every two blocks meet in a task of
    their own, so that no task holds more than two blocks. A pair that shares several
    buckets is looked at in the first of them. sparing: what a block's known pairs join
    is not looked at again there, so that a block gives fewer pairs than it has members.
    """
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = members.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("node", F.lit("block")), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    ends = [F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")]
    rows = F.collect_list(F.struct("own", "node", "root", "size", "keys", "held")).alias("rows")
    blocks = dealt.groupBy("band", "value", *ends).agg(rows).where(F.size("rows") > 1).select("band", "value", "low", "high", "rows")

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                band, value, low, high = (batch.column(k)[at].as_py() for k in ("band", "value", "low", "high"))
                rows = batch.column("rows")[at].values
                own, node, root, size = (rows.field(k).to_numpy(zero_copy_only=False) for k in range(4))
                size = size.astype(np.int64)
                earlier = np.array([k[:band] for k in rows.field(4).to_pylist()], np.int64).reshape(len(own), band)
                x, y = np.flatnonzero(own == low), np.flatnonzero(own == high)
                asked = root[x][:, None] != root[y][None, :]
                if low == high:
                    asked = np.triu(asked, 1)
                for k in range(band):
                    asked &= earlier[x, k][:, None] != earlier[y, k][None, :]
                held = rows.field(5).to_pylist()
                words = [np.frombuffer(h, "<u2") if n <= MOST_WORDS else None for h, n in zip(held, size, strict=True)]
                counts = [np.frombuffer(h, np.uint8) if w is None else word_counts(w) for h, w in zip(held, words, strict=True)]
                i, j = np.nonzero(may_be_similar(size[x], [counts[k] for k in x], size[y], [counts[k] for k in y], asked))
                up: dict[int, int] = {}  # from a root to one that a pair has joined it with

                def top(r: int) -> int:
                    while r in up:
                        r = up[r]
                    return r

                found = []
                for p, q in zip(x[i].tolist(), y[j].tolist(), strict=True):
                    known = words[p] is not None and words[q] is not None
                    if known:
                        r, t = top(int(root[p])), top(int(root[q]))
                        if sparing and r == t or not similar(words[p], words[q]):
                            continue
                        if r != t:
                            up[r] = t
                    found.append((min(node[p], node[q]), max(node[p], node[q]), known))
                first, second, known = zip(*found, strict=True) if found else ((), (), ())
                bucket = [pa.array([band] * len(found), pa.int32()), pa.array([value] * len(found), pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(known, pa.bool_()), *bucket], names=["a", "b", "known", "band", "value"])
        common.tidy()

    return blocks.mapInArrow(run, "a long, b long, known boolean, band int, value long")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (a, b) of nodes with ok, whether their texts are similar; texts: (node, text).

    Both joins are by shuffle at every size: the texts are the large side. The pairs of
    a text that is in many are dealt out.
    """
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("ta")).hint("merge")
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("tb")).hint("merge")
    rows = meet(meet(pairs, first, ["a"], hot_keys(pairs, "a"), "b"), second, ["b"], hot_keys(pairs, "b"), "a")

    def run(batches):
        words = common.worker_state("neardup_words", Words)
        for batch in batches:
            last, held = None, None
            ok = []
            for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                if x != last:
                    last, held = x, words(x)
                ok.append(similar(held, words(y)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])
        common.tidy()

    return rows.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, ok boolean")


def _texts_of(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text) of the nodes in pairs, each once, written to the shared folder.

    A text is read from the row of its least doc_id: copies have other ids and do not
    meet in a task. Later rounds need no other texts.
    """
    involved = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    chosen = nodes.select("node", "least", "repeats").join(involved, "node", "left_semi")
    rows = _texts(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("least"), F.xxhash64("t1", "t2").alias("node"), "text")
    found = common.table(rows.hint("merge").join(chosen, ["least", "node"]).select("node", "text", "repeats"), "texts")
    if found.where("repeats > 1").limit(1).count():  # rows that repeat with their id
        found = common.table(found.dropDuplicates(["node"]), "texts")
    return found.select("node", "text")


def components(links: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(node, root, name) of the nodes in links (a, b): the node of least name of each connected component, and that name.

    names gives (node, name); without it a node is its own name. Every round gives each
    node the least label among its own and its neighbours', then its label's label; all
    aggregates combine before the shuffle.
    """
    both = common.table(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    nodes = both.select(F.col("a").alias("node")).distinct()
    named = nodes.withColumn("name", F.col("node")) if names is None else nodes.join(names.select("node", "name"), "node")
    labels = common.table(named.select("node", F.struct("name", F.col("node").alias("root")).alias("label")), "labels")
    hubs = common.table(hot_keys(both, "b"), "hubs")
    for _ in range(MOST_JOINS):
        near = meet(both, labels.withColumnRenamed("node", "b"), ["b"], hubs, "a").groupBy("a").agg(F.min("label").alias("near"))
        new = labels.join(near, labels["node"] == near["a"]).select("node", F.least("near", "label").alias("next"), "label")
        new = common.table(new.withColumn("up", F.col("next.root")), "labels")
        up = labels.select(F.col("node").alias("up"), F.col("label").alias("upper"))
        new = meet(new, up, ["up"], hot_keys(new, "up"), "node").select("node", F.least("next", "upper").alias("label"), F.col("label").alias("old"))
        new = common.table(new, "labels")
        moved = new.where("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels.select("node", "label.root", "label.name")
    raise RuntimeError("labels did not settle")


def _led(buckets: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Round k over buckets (node, size, root, band, value): those of several members with their number n, and a pair (a, b) for each member and the leader of another root with which it shares most buckets.

    A bucket has a leader for every span of sizes, as texts that differ much in size
    tell each other nothing; the spans are half a span further in every round.
    """
    span = F.floor(F.log(F.col("size") + F.lit(1.0)) / F.lit(-math.log(SIMILARITY)) + F.lit(k / 2))
    buckets = buckets.withColumn("span", span)
    order = F.struct(F.xxhash64("node", F.lit(k)).alias("by"), "node", "size", "root")
    leaders = buckets.groupBy("band", "value", "span").agg(F.min(order).alias("l"), F.count("*").alias("n"))
    leaders = leaders.groupBy("band", "value").agg(F.sum("n").alias("n"), F.collect_list(F.struct("span", "l")).alias("leaders")).where("n > 1")
    leaders = common.table(leaders, "leaders")
    led = meet(buckets, leaders, ["band", "value"], leaders.where(F.col("n") > HOT).select("band", "value"), "node")
    led = led.withColumn("l", F.filter("leaders", lambda x: x["span"] == F.col("span"))[0]["l"])
    own = ["node", "size", "root", "band", "value", "n"]
    led = common.table(led.select(*own, F.col("l.node").alias("leader"), F.col("l.size").alias("leader_size"), F.col("l.root").alias("leader_root")), "led")
    longest = F.greatest("size", "leader_size")
    close = F.abs(F.col("size") - F.col("leader_size")) <= F.floor(F.lit(1 - SIMILARITY) * longest + F.lit(1e-9))
    shared = led.where((F.col("root") != F.col("leader_root")) & close).groupBy("node", "leader").agg(F.count("*").alias("bands"))
    chosen = shared.groupBy("node").agg(F.max(F.struct("bands", "leader")).alias("c")).select("node", "c.leader")
    pairs = chosen.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    return led.select(*own), pairs


def _linked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, names: DataFrame, links: DataFrame | None, roots: DataFrame | None) -> tuple[DataFrame | None, DataFrame | None]:
    """links with the pairs whose texts are similar, and the components they make."""
    if not pairs.limit(1).count():
        return links, roots
    found = common.table(_verified(pairs, _texts_of(docs, nodes, pairs)), "judged").where("ok").select("a", "b")
    if not found.limit(1).count():
        return links, roots
    links = found if links is None else links.unionByName(found)
    return links, components(links, names)


def _open(buckets: DataFrame) -> DataFrame:
    """The buckets whose members have more than one root."""
    buckets = common.table(buckets.select("node", "size", "root", "band", "value", "n"), "rooted")
    found = buckets.groupBy("band", "value").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("band", "value")
    hot = buckets.where(F.col("n") > HOT).select("band", "value").distinct()
    return common.table(meet(buckets, found, ["band", "value"], hot, "node"), "open")


def _rooted(buckets: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The buckets still open under the roots given."""
    if roots is not None:
        buckets = buckets.drop("root").join(roots.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    return _open(buckets)


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, t1, t2, copies, root, class_id) of every distinct row, and links (a, b) between distinct texts.

    copies counts equal rows of one doc_id and text; root tells classes apart that have
    one name, as their least doc_ids are null or repeat with different texts.
    """
    least = F.lit(-(1 << 63))
    named = _texts(docs).select(F.coalesce(F.col("doc_id").cast("long"), least).alias("doc_id"), "t1", "t2")
    members = common.table(named.groupBy("doc_id", "t1", "t2").agg(F.count("*").alias("copies")), "members")
    # A node is a distinct text.
    node = F.xxhash64("t1", "t2")
    nodes = members.groupBy("t1", "t2").agg(F.min("doc_id").alias("least"), F.max("copies").alias("repeats"), F.count("*").alias("n"))
    nodes = common.table(nodes.select(node.alias("node"), "*"), "nodes")
    keyed = sketches(docs).groupBy("t1", "t2").agg(F.min("keys").alias("keys"), F.min("size").alias("size"), F.min("held").alias("held"))
    keyed = common.table(keyed.select(node.alias("node"), "keys", "size", "held"), "sketches")
    bands = F.expr("transform(keys, (k, i) -> struct(i as band, k as value))")
    buckets = keyed.select("node", "size", F.explode(bands).alias("k")).select("node", "size", "k.band", "k.value", F.col("node").alias("root"))
    names = nodes.select("node", F.col("least").alias("name"))
    judged = links = roots = None
    for k in range(ROUNDS):
        buckets, pairs = _led(buckets.drop("n"), k)
        if judged is not None:
            pairs = pairs.join(judged, ["a", "b"], "left_anti")
        pairs = common.table(pairs, "pairs")
        links, roots = _linked(docs, nodes, pairs, names, links, roots)
        judged = pairs if judged is None else judged.unionByName(pairs)
        buckets = _rooted(buckets, roots)
    for sparing in (True, False):
        found = common.table(unlinked_pairs(buckets.join(keyed.select("node", "keys", "held"), "node"), sparing), "found")
        rest = common.table(found.select("a", "b").distinct().join(judged, ["a", "b"], "left_anti"), "rest")
        links, roots = _linked(docs, nodes, rest, names, links, roots)
        wrong = found.where("known")
        if links is not None:
            wrong = wrong.join(links, ["a", "b"], "left_anti")
        wrong = common.table(wrong.select("band", "value").distinct(), "wrong")
        if not wrong.limit(1).count():
            break
        # Two words agree in 16 bits: a pair that is none after all may have spared others.
        judged = judged.unionByName(rest)
        buckets = _rooted(buckets.join(wrong, ["band", "value"], "left_semi"), roots)
    if roots is None:  # no two texts are similar
        links = rest.limit(0)
        roots = names.select("node", F.col("node").alias("root"), "name")
    of_text = nodes.join(roots, "node", "left").select("t1", "t2", F.coalesce("root", "node").alias("root"), F.coalesce("name", "least").alias("class_id"))
    null = lambda c: F.when(F.col(c) != least, F.col(c)).alias(c)
    out = meet(members, of_text, ["t1", "t2"], nodes.where(F.col("n") > HOT).select("t1", "t2"), "doc_id")
    return out.select(null("doc_id"), "t1", "t2", "copies", "root", null("class_id")), links


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs with one row of each class: that of the class's least doc_id (of these, the one with the least text hash)."""
    out, _ = classes(docs)
    kept = out.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "t1", "t2", "copies")).alias("k")).select("k.*")
    kept = common.table(kept.select(F.col("doc_id").alias("__id"), F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), "copies"), "kept")
    text = F.coalesce("text", F.lit(""))
    marked = docs.withColumn("__h1", F.xxhash64(text)).withColumn("__h2", F.xxhash64(text, F.lit("second")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__h1") == F.col("__t1")) & (F.col("__h2") == F.col("__t2"))
    rows = marked.join(kept.drop("copies"), same, "left_semi")
    if kept.where("copies > 1").limit(1).count():
        rows = rows.dropDuplicates(["doc_id", "__h1", "__h2"])
    return rows.drop("__h1", "__h2")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = classes(common.read(spark, sf_dir, "documents"))
    rows = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select("doc_id", "class_id")
