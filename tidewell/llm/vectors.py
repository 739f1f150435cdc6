"""Approximate nearest neighbours: inverted file with product-quantised residuals.

Coarse centroids cut the vectors into cells; a vector's residual to its centroid is
cut into sub-vectors, each named by its nearest code word. A query visits the cells
whose centroids promise most, scores their vectors by its table of inner products with
all code words (asymmetric: the query itself is not quantised), and reranks the best
of them by exact inner products on the original vectors.

The quantisers are fitted on a bounded sample; every row is indexed. How many cells a
query visits is measured: sampled queries are searched by brute force over all rows and
by the index, product quantisation and reranking included, and cells and reranked rows
are raised until the index finds TARGET_RECALL of the true neighbours. Cells visited
hold more than k rows at least.

The unit of work is a set of rows of bounded size: a cell that holds most rows, or
copies of one vector, is spread over units, small cells share one. Units are dealt into
SPLITS splits, however many there are, and queries into parts of bounded size. A query
goes once to each split that holds a cell it visits; there a part's queries pass through
the split's units one after another and keep their k best, so that a query gives k rows
a split at most, and no task gathers more than a unit and a part.

Defined results: vectors that are null, zero, of another length than most, or that
hold null or non-finite components take no part; ties go to the smaller vec_id; a row
is no neighbour of rows with its own vec_id; rows repeated with one vec_id count once
as a candidate (the first in order of components) and once as a query; null vec_ids
take no part. Further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm import common

QUERY = "op9_vectors"

#: Sampled rows the quantisers are fitted on, sampled queries that set the number of cells, and cells at most.
SAMPLE, SAMPLE_QUERIES, MOST_CELLS = 12_000, 200, 4096
#: Components of a sub-vector, code words for each, rounds of k-means.
SUB, CODES, ROUNDS = 8, 256, 8
#: Rows of a unit at least and at most, and queries of a part.
LEAST_UNIT, UNIT, PART = 1024, 16_384, 16_384
#: Splits of the units: what a query gives at most is its k best of each.
SPLITS = 16
#: Measured recall of sampled queries that is enough.
TARGET_RECALL = 0.95
#: Candidates of a unit that are reranked exactly at first, as multiples of k.
RERANK = 8


def _assign(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Nearest centroid of each row, in slices of bounded size."""
    half = (centroids**2).sum(axis=1) / 2
    return np.concatenate([(x[k : k + 4096] @ centroids.T - half).argmax(axis=1) for k in range(0, len(x), 4096)] or [np.zeros(0, int)])


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids; empty ones move to rows far from theirs."""
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    k = max(1, min(k, len(x)))
    centroids = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        owner = _assign(x, centroids)
        counts = np.bincount(owner, minlength=k)
        order = np.argsort(owner, kind="stable")
        full = counts > 0
        sums = np.add.reduceat(x[order], (np.cumsum(counts) - counts)[full], axis=0)
        centroids[full] = sums / counts[full, None]
        if not full.all():
            far = ((x - centroids[owner]) ** 2).sum(axis=1).argsort()[::-1]
            centroids[~full] = x[far[: (~full).sum()]]
    return centroids


class Index:
    """Coarse centroids and code words; rows of each cell; cells a query visits and rows reranked."""

    def __init__(self, sample: np.ndarray, rows: int, seed: int = 5):
        self.size = sample.shape[1]
        cells = int(np.clip(round(rows**0.5), 1, min(MOST_CELLS, max(1, len(sample) // 4))))
        self.cells = k_means(sample, cells, seed)
        residual = sample - self.cells[_assign(sample, self.cells)]
        self.cuts = [slice(a, min(a + SUB, self.size)) for a in range(0, self.size, SUB)]
        self.words = [k_means(residual[:, c], CODES, seed + j) for j, c in enumerate(self.cuts)]
        self.counts = np.zeros(len(self.cells), np.int64)
        self.probes, self.rerank = len(self.cells), 1

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and code of each row."""
        cell = _assign(x, self.cells)
        residual = x - self.cells[cell]
        codes = np.stack([_assign(residual[:, c], w) for c, w in zip(self.cuts, self.words, strict=True)], axis=1)
        return cell, codes.astype(np.uint8)

    def lay_out(self, counts: dict[int, int], unit: int) -> list[tuple[int, int, int]]:
        """(cell, first unit, number of units): cells of unit rows and more have units of their own, others share one."""
        for c, n in counts.items():
            self.counts[c] = n
        self.first, self.units = np.zeros(len(self.cells), np.int64), np.zeros(len(self.cells), np.int64)
        at, filled = 0, 0
        for c in np.flatnonzero(self.counts).tolist():
            n = int(self.counts[c])
            if n >= unit:
                at += filled > 0
                filled = 0
                self.first[c], self.units[c] = at, -(-n // unit)
                at += int(self.units[c])
            else:
                if filled + n > unit:
                    at, filled = at + 1, 0
                self.first[c], self.units[c] = at, 1
                filled += n
        return [(c, int(self.first[c]), int(self.units[c])) for c in np.flatnonzero(self.counts).tolist()]

    def visits(self, q: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Units that hold cells which each query visits, and the least promise of those cells."""
        promise = q @ self.cells.T
        order = np.argsort(-promise, axis=1, kind="stable")
        # One row may be the query's own.
        enough = (self.counts[order].cumsum(axis=1) < k + 1).sum(axis=1) + 1
        asked = np.minimum(np.maximum(enough, self.probes), order.shape[1])
        reach = promise[np.arange(len(q)), order[np.arange(len(q)), asked - 1]]
        out = []
        for row, n in zip(order, asked, strict=True):
            first, units = self.first[row[:n]], self.units[row[:n]]
            spread = np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)
            out.append(np.unique(np.repeat(first, units) + spread))
        return out, reach

    def search(self, q: np.ndarray, reach: np.ndarray, own: np.ndarray, cell: np.ndarray, codes: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
        """Of one unit, whose rows are in order of ids: (query id, id, exact score) of each query's k best in the cells it visits."""
        here, cell = np.unique(cell, return_inverse=True)
        promise = q @ self.cells[here].T
        seen = (promise >= reach[:, None] - 1e-9)[:, cell]
        rough = promise.astype(np.float32)[:, cell]
        for j, (c, w) in enumerate(zip(self.cuts, self.words, strict=True)):
            rough += (q[:, c] @ w.T).astype(np.float32)[:, codes[:, j]]
        rough[~seen] = -np.inf
        take = min(len(ids), self.rerank * k + 1)
        least = np.partition(rough, len(ids) - take, axis=1)[:, len(ids) - take] if take < len(ids) else np.full(len(q), -np.inf)
        out = []
        for j in range(len(q)):
            row = rough[j]
            mine = np.flatnonzero(row > least[j])
            if np.isfinite(least[j]):  # of equal rough scores the smaller ids stay
                mine = np.concatenate([mine, np.flatnonzero(row == least[j])[: take - len(mine)]])
            mine = mine[ids[mine] != own[j]]
            exact = (x[mine] * q[j]).sum(axis=1)
            order = np.lexsort((ids[mine], -exact))[:k]
            out.append((np.full(len(order), own[j]), ids[mine][order], exact[order]))
        return out


class Nearest:
    """The k best so far of a part's queries, as they pass through units."""

    def __init__(self, index: Index, own: np.ndarray, q: np.ndarray, reach: np.ndarray, k: int):
        self.index, self.own, self.q, self.reach, self.k = index, own, q, reach, k
        self.ids, self.scores = np.zeros((len(own), k), np.int64), np.full((len(own), k), -np.inf)

    def meet(self, cell: np.ndarray, codes: np.ndarray, x: np.ndarray, ids: np.ndarray) -> None:
        """Search a unit, whose rows are in order of ids, for the queries that visit a cell of it."""
        k, cells = self.k, self.index.cells[np.unique(cell)]
        visit = [(self.q[a : a + 4096] @ cells.T >= self.reach[a : a + 4096, None] - 1e-9).any(axis=1) for a in range(0, len(self.q), 4096)]
        who = np.flatnonzero(np.concatenate(visit))
        for a in range(0, len(who), 256):
            some = who[a : a + 256]
            i, s = (np.pad(z[some], ((0, 0), (0, k)), constant_values=v) for z, v in ((self.ids, 0), (self.scores, -np.inf)))
            for j, (_, new, score) in enumerate(self.index.search(self.q[some], self.reach[some], self.own[some], cell, codes, x, ids, k)):
                i[j, k : k + len(new)], s[j, k : k + len(new)] = new, score
            order = np.lexsort((i, -s), axis=1)[:, :k]
            self.ids[some], self.scores[some] = np.take_along_axis(i, order, axis=1), np.take_along_axis(s, order, axis=1)

    def rows(self) -> pa.RecordBatch:
        fine = np.isfinite(self.scores)
        who = np.repeat(self.own, fine.sum(axis=1))
        return pa.RecordBatch.from_arrays([pa.array(who), pa.array(self.ids[fine]), pa.array(self.scores[fine])], names=["query_id", "vec_id", "score"])


def _runs(batches, names: tuple[str, ...]):
    """(values, rows) of each run of rows that agree in the columns named."""
    values, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        by = np.stack([batch.column(c).to_numpy() for c in names], axis=1)
        starts = [0, *(np.flatnonzero((by[1:] != by[:-1]).any(axis=1)) + 1).tolist()]
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            now = tuple(by[a].tolist())
            if held and now != values:
                yield values, pa.Table.from_batches(held)
                held = []
            values = now
            held.append(batch.slice(a, b - a))
    if held:
        yield values, pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """Rows of a column of lists of one size."""
    held = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return held.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def clean(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): one row per id with a finite vector that is not zero, as doubles."""
    v = F.transform(vec_col, lambda x: x.cast("double"))
    fine = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & fine)
    return out.groupBy("vec_id").agg(F.min("v").alias("v"))


def brute_force(coded: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, cell, rank) of each given query's k nearest among all rows; queries are few."""
    size, scale = q.shape[1], (q**2).sum(axis=1)

    def best(batches):
        held = None  # the best so far: query number, id, cell, score
        for batch in batches:
            x, mine, cell = _matrix(batch.column("v"), size), batch.column("vec_id").to_numpy(), batch.column("cell").to_numpy()
            order = np.argsort(mine, kind="stable")
            x, mine, cell = x[order], mine[order], cell[order]
            # Sums of one vector's copies may differ in their last digits by place.
            score = np.round((q @ x.T) / scale[:, None], 12)
            score[ids[:, None] == mine[None, :]] = -np.inf
            take = min(k, len(mine))
            least = np.partition(score, len(mine) - take, axis=1)[:, len(mine) - take]
            near = []
            for row, bound in zip(score, least, strict=True):
                more = np.flatnonzero(row > bound)
                near.append(np.concatenate([more, np.flatnonzero(row == bound)[: take - len(more)]]))
            near = np.array(near)
            who = np.repeat(np.arange(len(q)), take)
            new = (who, mine[near].ravel(), cell[near].ravel(), np.take_along_axis(score, near, axis=1).ravel())
            held = new if held is None else tuple(np.concatenate(z) for z in zip(held, new, strict=True))
            order = np.lexsort((held[1], -held[3], held[0]))
            held = tuple(z[order] for z in held)
            place = np.arange(len(order)) - np.searchsorted(held[0], held[0])
            keep = (place < k) & np.isfinite(held[3])
            held = tuple(z[keep] for z in held)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(ids[held[0]]), *map(pa.array, held[1:])], names=["query_id", "vec_id", "cell", "score"])

    found = coded.select("vec_id", "cell", "v").mapInArrow(best, "query_id long, vec_id long, cell int, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class Search:
    """An index over all rows, written to the shared folder."""

    def __init__(self, good: DataFrame, n: int, size: int, k: int):
        spark = self.spark = good.sparkSession
        self.good, self.size, self.k, self.n = good, size, k, n
        share = int(min(1.0, 1.5 * SAMPLE / n) * 1_000_000)
        sampled = good.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < share).limit(SAMPLE).collect()
        if not sampled:  # a handful of rows, none of them drawn
            sampled = good.limit(SAMPLE).collect()
        sampled.sort(key=lambda r: r["vec_id"])
        sample = np.array([r["v"] for r in sampled], float)
        index = self.index = Index(sample, n)
        shipped = spark.sparkContext.broadcast(index)

        def encode(batches):
            for batch in batches:
                cell, codes = shipped.value.encode(_matrix(batch.column("v"), size))
                code = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), batch.column("vec_id"), code, batch.column("v")], names=["cell", "vec_id", "code", "v"])

        self.coded = common.table(good.mapInArrow(encode, "cell int, vec_id long, code binary, v array<double>"), "index")
        counts = {r["cell"]: r["n"] for r in self.coded.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row per cell, MOST_CELLS at most
        unit = int(np.clip(n // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), LEAST_UNIT, UNIT))
        laid = spark.createDataFrame(index.lay_out(counts, unit), "cell int, first int, units int")
        dealt = self.coded.join(F.broadcast(laid), "cell")
        self.stored = dealt.select("cell", "vec_id", "code", "v", (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("units"))).cast("int").alias("unit"))
        step = max(1, len(sampled) // SAMPLE_QUERIES)
        self._measure(np.array([r["vec_id"] for r in sampled[::step]], np.int64)[:SAMPLE_QUERIES], sample[::step][:SAMPLE_QUERIES])

    def _measure(self, ids: np.ndarray, q: np.ndarray) -> None:
        """Set the cells visited and the rows reranked by the recall of the queries given; recall holds what was measured."""
        index, k = self.index, self.k
        truth = brute_force(self.coded, ids, q, k).select("query_id", "vec_id", "cell").collect()  # k rows for each of few queries
        order = np.argsort(-(q @ index.cells.T), axis=1, kind="stable")
        place = {int(i): {int(c): at for at, c in enumerate(row)} for i, row in zip(ids, order, strict=True)}
        needed = sorted(place[r["query_id"]][r["cell"]] for r in truth)
        if not needed:
            self.recall = 1.0
            return
        want = {(r["query_id"], r["vec_id"]) for r in truth}
        asked = self.spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, q, strict=True)], "vec_id long, v array<double>")
        goal = TARGET_RECALL
        index.probes, index.rerank = 0, RERANK
        while True:
            goal = (1 + goal) / 2  # of the neighbours lie in the cells visited
            index.probes = min(len(index.cells), max(index.probes + 1, needed[min(len(needed) - 1, int(goal * len(needed)))] + 1))
            found = {(r["query_id"], r["vec_id"]) for r in self.run(asked, len(ids)).select("query_id", "vec_id").collect()}
            self.recall = len(found & want) / len(want)
            if self.recall >= TARGET_RECALL or (index.probes == len(index.cells) and index.rerank * k > UNIT):
                return
            index.rerank *= 2

    def run(self, queries: DataFrame, n: int) -> DataFrame:
        """query_id, rank, vec_id, score of the k nearest of each of n queries (vec_id, v)."""
        k, size = self.k, self.size
        shipped = self.spark.sparkContext.broadcast(self.index)
        parts = -(-n // PART)

        def visit(batches):
            for batch in batches:
                for a in range(0, batch.num_rows, 256):
                    some = batch.slice(a, 256)
                    units, reach = shipped.value.visits(_matrix(some.column("v"), size), k)
                    splits = [np.unique(u % SPLITS) for u in units]
                    which = pa.array(np.repeat(np.arange(len(splits)), [len(u) for u in splits]))
                    split = pa.array(np.concatenate(splits).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([split, some.column("vec_id").take(which), some.column("v").take(which), pa.array(reach).take(which)], names=["split", "vec_id", "v", "reach"])

        asked = queries.select("vec_id", "v").mapInArrow(visit, "split int, vec_id long, v array<double>, reach double")
        asked = asked.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit("part")), F.lit(parts)).cast("int")).withColumn("unit", F.lit(-1))
        stored = self.stored.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("split", (F.col("unit") % SPLITS).cast("int"))
        # Of a part and a split the queries come first, then the rows by their units.
        both = asked.unionByName(stored, allowMissingColumns=True).repartition("part", "split").sortWithinPartitions("part", "split", "unit", "vec_id")

        def best(batches):
            place, asking = None, None
            for (part, split, unit), rows in _runs(batches, ("part", "split", "unit")):
                ids, x = rows.column("vec_id").to_numpy(), _matrix(rows.column("v"), size)
                if unit < 0:
                    if asking:
                        yield asking.rows()
                    place, asking = (part, split), Nearest(shipped.value, ids, x, rows.column("reach").to_numpy(), k)
                elif place == (part, split):  # else no query of the part visits the split
                    codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
                    asking.meet(rows.column("cell").to_numpy(), codes, x, ids)
            if asking:
                yield asking.rows()

        near = both.mapInArrow(best, "query_id long, vec_id long, score double")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def index_of(rows: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> Search | None:
    """The index of all rows whose vectors take part; None if there is none."""
    common.bound_batches(rows.sparkSession)
    good = clean(rows, id_col, vec_col)
    sizes = good.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    if not sizes:
        return None
    return Search(good.where(F.size("v") == sizes[0]["size"]), sizes[0]["n"], sizes[0]["size"], k)


def search(rows: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows whose id is divisible by every, against all: query_id, rank, vec_id, score."""
    index = index_of(rows, k, id_col, vec_col)
    if index is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = index.coded.where(F.col("vec_id") % every == 0)
    return index.run(queries, max(1, queries.count()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(common.read(spark, sf_dir, "embeddings"))
