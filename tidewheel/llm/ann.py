"""Approximate nearest neighbours by cosine: balanced posting lists, a graph over their centroids.

Fitting splits a bounded sample of unit vectors by recursive two-means with median cuts, so that
all leaves (posting lists) hold equally many of it. Indexing enters every vector in its nearest
list and, at a boundary, in up to REPLICAS lists whose centroids are nearly as near. Lists are found
by walking a neighbour graph over the centroids in memory. A query visits the lists whose centroid
is at most `ratio` times as far as the nearest one; the ratio is fitted on the sample, as the least
one that finds TARGET of the true neighbours there.

A table of more than MAX_LISTS times LIST_SIZE vectors has lists of two levels: the first level's lists
are cells, and each cell is fitted and split on its own, in tasks, so lists keep their size however many
vectors there are. Equal vectors are one: only the smallest ids of them can be among a query's nearest, and
equal queries are answered together. Lists and their queries meet in blocks of at most about BLOCK rows,
split further by hash where a list or its queries are more, so no task holds a whole hot list; each block
gives its own nearest per query and these are ranked at the end. Queries whose lists hold too few vectors
visit more lists, until they have all they can have. A fit, its centroids and graph are bounded by SAMPLE
and MAX_LISTS, however many vectors there are.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.shared import broadcast, forget, looked_up, written

#: Vectors in the sample that the index is fitted on (about: the hash decides), and the lists it may have.
SAMPLE, MAX_LISTS = 20_000, 4096
LIST_SIZE, REPLICAS, BOUNDARY = 512, 3, 1.1
NEIGHBOURS, TARGET, BLOCK = 16, 0.97, 4096
#: Rows of a cell that a task enters in the cell's own lists.
CELL_ROWS = 1 << 14


def units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision."""
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each row of a with the same row of b; equal pairs of rows give equal results."""
    a, b = np.asarray(a, np.float64), np.asarray(b, np.float64)
    n = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
    out = (a * b).sum(axis=1) / np.where(n > 0, n, 1)
    odd = ~np.isfinite(n) | (n < 1e-290)
    if odd.any():  # lengths that doubles can't square
        out[odd] = (units(a[odd]) * units(b[odd])).sum(axis=1)
    return out


def _leaves(x: np.ndarray, rows: np.ndarray, k: int, draw: np.random.Generator) -> list[np.ndarray]:
    """Rows in k groups of equal size (but for rounding), by recursive two-means with a cut at the median."""
    if k == 1 or len(rows) < 2 * k:
        return [rows]
    part = x[rows]
    a, b = part[draw.choice(len(rows), 2, replace=False)]
    for _ in range(6):
        side = part @ (a - b)
        cut = np.partition(side, len(side) // 2)[len(side) // 2]
        low = side < cut
        if not low.any() or low.all():
            break
        a, b = part[~low].mean(axis=0), part[low].mean(axis=0)
    order = np.argsort(part @ (a - b), kind="stable")
    at = len(rows) * (k // 2) // k
    return _leaves(x, rows[order[:at]], k // 2, draw) + _leaves(x, rows[order[at:]], k - k // 2, draw)


@dataclass
class Index:
    """Unit centroids of the lists, a neighbour graph over them and the ratio that queries are pruned at."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    ratio: float = 1.0

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, seed: int = 11) -> "Index":
        draw = np.random.default_rng(seed)
        x = units(sample)
        groups = _leaves(x, np.arange(len(x)), lists, draw)
        means = np.stack([x[g].mean(axis=0) for g in groups])
        lengths = np.sqrt((means * means).sum(axis=1, keepdims=True))
        centroids = np.where(lengths > 1e-9, means / np.maximum(lengths, 1e-9), np.stack([x[g[0]] for g in groups]))
        n = len(centroids)
        near = min(NEIGHBOURS, n - 1)
        graph = np.argsort(-(centroids @ centroids.T) + 4 * np.eye(n), axis=1, kind="stable")[:, :near]
        # a ring through all of them keeps the graph connected, and a few far links make it shallow
        graph = np.hstack([graph, (np.arange(n)[:, None] + 1) % n, draw.integers(0, n, (n, 2))])
        out = cls(centroids, graph, np.unique(draw.integers(0, n, 8)))
        out.ratio = out._fitted_ratio(x, draw)
        return out

    def _fitted_ratio(self, x: np.ndarray, draw: np.random.Generator, k: int = 5, queries: int = 256) -> float:
        """The least ratio at which TARGET of the sample's true neighbours stand in a visited list."""
        asked = draw.choice(len(x), min(queries, len(x)), replace=False)
        near = x[asked] @ x.T
        near[np.arange(len(asked)), asked] = -np.inf
        k = min(k, len(x) - 1)
        if k < 1:
            return 1.0
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        to = np.sqrt(np.maximum(2 - 2 * (x[asked] @ self.centroids.T), 0))
        least = np.maximum(to.min(axis=1), 1e-9)
        rows, lists = self.assign(x[np.unique(best)])
        of: dict[int, list[int]] = {}
        for r, c in zip(np.unique(best)[rows].tolist(), lists.tolist()):
            of.setdefault(r, []).append(c)
        needed = [min(to[q, c] for c in of[v]) / least[q] for q, vs in enumerate(best.tolist()) for v in vs]
        return float(np.quantile(needed, TARGET)) + 1e-9

    def search(self, x: np.ndarray, ratio: float, at_least: int) -> tuple[np.ndarray, np.ndarray]:
        """Walks the graph for all unit rows at once: (distances to the centroids seen, which of them are within
        ratio times the nearest or among the at_least nearest)."""
        n, c = len(x), len(self.centroids)
        dist = np.full((n, c), np.inf)
        open_ = np.zeros((n, c), bool)
        at_least = min(at_least, c)

        def see(rows: np.ndarray, cols: np.ndarray) -> None:
            new = np.isinf(dist[rows, cols])
            rows, cols = np.divmod(np.unique(rows[new] * c + cols[new]), c)
            dist[rows, cols] = np.sqrt(np.maximum(2 - 2 * (x[rows] * self.centroids[cols]).sum(axis=1), 0))
            open_[rows, cols] = True

        see(np.repeat(np.arange(n), len(self.entries)), np.tile(self.entries, n))
        while True:
            limit = np.maximum(dist.min(axis=1) * ratio, np.partition(dist, at_least - 1, axis=1)[:, at_least - 1])
            rows, cols = np.nonzero(open_ & (dist <= limit[:, None]))
            if not len(rows):
                return dist, dist <= limit[:, None]
            open_[rows, cols] = False
            to = self.graph[cols]
            see(np.repeat(rows, to.shape[1]), to.ravel())

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list): for each unit row its nearest list, and others nearly as near, REPLICAS at most."""
        dist, _ = self.search(x, BOUNDARY, REPLICAS)
        k = min(REPLICAS, dist.shape[1])
        near = np.argsort(dist, axis=1, kind="stable")[:, :k]
        d = np.take_along_axis(dist, near, axis=1)
        keep = d <= np.maximum(d[:, :1] * BOUNDARY, 1e-12)
        keep[:, 0] = True
        rows, cols = np.nonzero(keep)
        return rows, near[rows, cols]


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Key and vector of the rows that take part: a key; a vector that is neither null, empty nor zero and
    holds no null or non-finite component; of the length that most of these have (of equals, the larger)."""
    v = F.col(vector)
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"), v.alias("vector")).filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.filter(~F.exists("vector", odd) & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.filter(F.size("vector") == (sizes["size"] if sizes else 0))


def fit(rows: DataFrame, sample: int = SAMPLE) -> Index | None:
    """An index fitted on about `sample` rows (equal ones count once); None if there is no row. Its lists are cells
    (see split) where there would have to be more than MAX_LISTS."""
    n = rows.count()
    drawn = rows if n <= sample else rows.filter(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    table = drawn.select("vec_id", "vector").distinct().toArrow().sort_by("vec_id")
    if not len(table):
        return None
    return Index.fit(matrix(table.column("vector").combine_chunks()), max(1, min(n // LIST_SIZE, MAX_LISTS)))


def _entered(index: Index, part: pa.RecordBatch) -> tuple[np.ndarray, pa.RecordBatch]:
    """The lists of a batch (id, vector), and its rows repeated for them."""
    own, lists = index.assign(units(matrix(part.column(1))))
    return lists, part.take(pa.array(own))


def postings(rows: DataFrame, index: Index) -> DataFrame:
    """The index itself, as a written table: list, vec_id, vector; every row in one list at least."""
    shared = broadcast(rows.sparkSession, index)

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 1024):
                lists, taken = _entered(shared.value, b.slice(at, 1024))
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int64()), *taken.columns], ["list", "vec_id", "vector"])

    return written(rows.select("vec_id", "vector").mapInArrow(entered, f"list bigint, vec_id bigint, vector {rows.schema['vector'].dataType.simpleString()}"))


def _visited(index: Index, part: pa.RecordBatch, at_least: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, list): the lists that each query of a batch (id, vector) visits."""
    return np.nonzero(index.search(units(matrix(part.column(1))), index.ratio, at_least)[1])


def _visits(queries: DataFrame, index: Index, at_least: int) -> DataFrame:
    shared = broadcast(queries.sparkSession, index)

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                own, lists = _visited(shared.value, part, at_least)
                for s in range(0, len(own), 4096):
                    taken = part.take(pa.array(own[s : s + 4096]))
                    yield pa.RecordBatch.from_arrays([pa.array(lists[s : s + 4096], pa.int64()), *taken.columns], ["list", "query_id", "vector"])

    return written(queries.select("query_id", "vector").mapInArrow(visited, f"list bigint, query_id bigint, vector {queries.schema['vector'].dataType.simpleString()}"))


def cells(entries: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """list, rows, index: for each cell its rows and an index of its own, fitted on about `sample` of them."""
    sizes = F.broadcast(entries.groupBy("list").agg(F.count("*").alias("rows")))  # MAX_LISTS rows at most
    drawn = entries.join(sizes, "list").filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) * F.col("rows") / (1 << 30) < sample)

    def fitted(t: pa.Table) -> pa.Table:
        t = t.sort_by("vec_id")
        n = t.column("rows")[0].as_py()
        index = Index.fit(matrix(t.column("vector").combine_chunks()), max(1, min(n // LIST_SIZE, MAX_LISTS)))
        return pa.table([t.column("list")[:1], pa.array([n], pa.int64()), pa.array([pickle.dumps(index)], pa.binary())], names=["list", "rows", "index"])

    return written(drawn.groupBy("list").applyInArrow(fitted, "list bigint, rows bigint, index binary"))


def split(rows: DataFrame, of: DataFrame, at_least: int = 0) -> DataFrame:
    """rows (list, an id, vector) with their cells' own lists in place of the cells: all that a row is entered in or,
    with at_least, that a query visits. Cells go to tasks in parts of about CELL_ROWS."""
    key = rows.columns[1]
    parts = F.broadcast(rows.groupBy("list").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("parts")))  # MAX_LISTS rows at most
    left = rows.join(parts, "list").withColumn("part", F.pmod(F.xxhash64(key), F.col("parts")).cast("int")).drop("parts")
    right = of.select("list", "index").join(parts, "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    kind = rows.schema["vector"].dataType.simpleString()
    factor = MAX_LISTS

    def dealt(a: pa.Table, b: pa.Table) -> pa.Table:
        index, out = pickle.loads(b.column("index")[0].as_py()), []
        for batch in a.select([key, "vector"]).to_batches(max_chunksize=512):
            if at_least:
                own, lists = _visited(index, batch, at_least)
                taken = batch.take(pa.array(own))
            else:
                lists, taken = _entered(index, batch)
            base = b.column("list")[0].as_py() * factor
            out.append(pa.RecordBatch.from_arrays([pa.array(lists + base, pa.int64()), *taken.columns], ["list", key, "vector"]))
        return pa.Table.from_batches(out)

    met = left.groupBy("list", "part").cogroup(right.groupBy("list", "part"))
    schema = pa.schema([("list", pa.int64()), (key, pa.int64()), ("vector", pa.list_(pa.float64() if "double" in kind else pa.float32()))])
    return written(met.applyInArrow(lambda a, b: dealt(a, b) if len(a) and len(b) else schema.empty_table(), f"list bigint, {key} bigint, vector {kind}"))


def nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vec_id, cosine) of each query's k nearest among vectors; ties to smaller ids."""
    u, v = units(queries), units(vectors)
    out_q, out_v, out_s = [], [], []
    for at in range(0, len(u), 256):
        s = u[at : at + 256] @ v.T
        for row, q, x in zip(s, query_ids[at : at + 256].tolist(), queries[at : at + 256]):
            least = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -2.0
            near = np.flatnonzero(row >= least - 1e-9)
            exact = cosines(np.broadcast_to(x, (len(near), len(x))), vectors[near])
            best = np.lexsort((ids[near], -exact))[:k]
            out_q += [q] * len(best)
            out_v.append(ids[near][best])
            out_s.append(exact[best])
    return np.array(out_q, np.int64), np.concatenate(out_v) if out_v else np.empty(0, np.int64), np.concatenate(out_s) if out_s else np.empty(0)


def _met(entries: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the k nearest of every query in the lists that it visits, as a written table."""
    # in how many blocks a list and its queries are split
    blocks = lambda df, name: df.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name), F.count("*").alias(f"n_{name}"))
    plan = written(blocks(entries, "vs").join(blocks(visits, "qs"), "list"))
    placed = lambda df, name: looked_up(df, plan.select("list", "vs", "qs"), ["list"], plan.select("list", F.col(name).alias("n"))).filter("vs is not null")
    own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed(entries, "n_vs").withColumn("v", own("vec_id", "vs")).withColumn("q", every("qs")).select("list", "v", "q", "vec_id", "vector")
    right = placed(visits, "n_qs").withColumn("q", own("query_id", "qs")).withColumn("v", every("vs")).select("list", "v", "q", "query_id", "vector")

    def met(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.table([[], [], []], pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))
        cols = lambda t, name: t.column(name).combine_chunks()
        got = nearest(cols(b, "query_id").to_numpy(), matrix(cols(b, "vector")), cols(a, "vec_id").to_numpy(), matrix(cols(a, "vector")), k)
        return pa.table(list(got), names=["query_id", "vec_id", "score"])

    found = left.groupBy("list", "v", "q").cogroup(right.groupBy("list", "v", "q")).applyInArrow(met, "query_id bigint, vec_id bigint, score double").dropDuplicates()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    out = written(found.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank"))
    forget(plan)
    return out


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, at_least: int = 8) -> DataFrame:
    """query_id, rank, vec_id, score: for every query (rows of vec_id, vector) its k nearest found among vectors
    (vec_id, vector) but rows of its own id, by cosine; all of these, if they are fewer.

    Both sides come from usable(). Ties go to the smaller vec_id; repeated rows of vectors count once,
    repeated queries are answered once (the smallest vector, if they differ). at_least: lists that a
    query visits at least. Without vectors there is no row.
    """
    index = fit(vectors)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    # of equal vectors, the k nearest of any query hold none but those with the k + 1 smallest ids, its own among them
    copy = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    there = written(vectors.distinct().withColumn("copy", copy).filter(F.col("copy") <= k + 1).drop("copy"))
    single = written(queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector")))
    firsts = written(single.groupBy("vector").agg(F.min("query_id").alias("first"), F.count("*").alias("n")))  # a vector that many ask for is answered once
    asked = written(looked_up(single, firsts.select("vector", "first"), ["vector"], firsts.select("vector", "n")))
    open_ = asked.filter("query_id = first").select("query_id", "vector")
    deep = vectors.count() // LIST_SIZE > MAX_LISTS
    entries = postings(there, index)
    inner = cells(entries) if deep else None
    if deep:
        entries = split(entries, inner)
    whole = min(k + 1, there.select("vec_id").distinct().count())
    parts = []
    while True:
        visits = _visits(open_, index, at_least)
        if deep:
            visits = split(visits, inner, at_least)
        found = _met(entries, visits, k + 1)
        forget(visits)
        parts.append(found)
        full = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= whole)
        lacking = written(open_.join(full, "query_id", "left_anti"))
        if at_least > MAX_LISTS or lacking.isEmpty():
            break
        open_, at_least = lacking, 8 * at_least  # they visit more lists
    near = parts[0]
    for p in parts[1:]:
        near = near.unionByName(p)
    near = near.distinct().groupBy(F.col("query_id").alias("first")).agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")).alias("near"))  # some k + 1 a part
    each = looked_up(asked.select("query_id", "first"), near, ["first"])
    others = F.slice(F.filter(F.array_sort("near"), lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = each.select("query_id", F.posexplode(others).alias("rank", "at"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("at.vec_id").alias("vec_id"), (-F.col("at.s")).alias("score"))
