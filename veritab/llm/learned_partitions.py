"""Nearest neighbours with learned partitions: a balanced cut of a neighbour graph, and a classifier that routes queries."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.common import stored
from veritab.llm.vectors import matrix, sound_vectors

#: Neighbours of a result; ids of queries are divisible by this.
NEIGHBOURS, QUERY_EVERY = 10, 100
#: Different vectors on which a model is fitted at most, for each number of components; of these, how many tune the routing.
TRAIN_ROWS, HELD_OUT = 10_000, 1000
#: Neighbours in the graph; units of the classifier's hidden layer; turns over the sample; most partitions.
GRAPH, HIDDEN, EPOCHS, MOST_PARTS = 10, 64, 25, 256
#: Share of the neighbours, within the sample, that routing has to find. Neighbours in the whole table are nearer and easier.
RECALL = 0.96
#: Rows, and queries, of a partition that meet in one group.
ROWS_OF_GROUP, QUERIES_OF_GROUP = 4096, 1024


def parts_for(rows: int) -> int:
    """Number of partitions: the square root of the table's rows over eight, as a power of two, up to MOST_PARTS."""
    return min(MOST_PARTS, 1 << max(0, round(math.log2(max(1.0, math.sqrt(rows) / 8)))))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), np.int64)
    size = (x * x).sum(axis=1)
    for low in range(0, len(x), 1024):
        far = size - 2 * (x[low : low + 1024] @ x.T)
        far[np.arange(len(far)), np.arange(low, low + len(far))] = np.inf
        near = np.argpartition(far, k - 1, axis=1)[:, :k]
        out[low : low + 1024] = np.take_along_axis(near, np.take_along_axis(far, near, axis=1).argsort(axis=1), axis=1)
    return out


def _bisect(a: np.ndarray, b: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Two halves of equal size of a graph with edges a-b: the median of its slowest mode, then swaps that cut fewer edges."""
    pull = lambda x: np.bincount(a, x[b], n) + np.bincount(b, x[a], n)
    degree = np.maximum(pull(np.ones(n)), 1e-9)
    mode = rng.standard_normal(n)
    for _ in range(150):
        mode = pull(mode) / degree + mode
        mode -= (mode * degree).sum() / degree.sum()
        mode /= np.abs(mode).max() + 1e-300
    side = np.zeros(n, bool)
    side[np.argsort(mode, kind="stable")[n // 2 :]] = True
    cut = int((side[a] != side[b]).sum())
    for _ in range(40):
        to_one = pull(side.astype(float))
        gain = np.where(side, degree - 2 * to_one, 2 * to_one - degree)  # edges that are cut no more if a row changes sides
        ones, zeros = (np.flatnonzero(s)[np.argsort(-gain[s], kind="stable")] for s in (side, ~side))
        m = min(len(ones), len(zeros))
        some = int((gain[ones[:m]] + gain[zeros[:m]] > 0).sum())
        while some:  # neighbours that change sides together gain less; then fewer do
            other = side.copy()
            other[ones[:some]], other[zeros[:some]] = False, True
            now = int((other[a] != other[b]).sum())
            if now < cut:
                break
            some //= 2
        if not some:
            break
        side, cut = other, now
    return side


def balanced_partition(graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Parts of equal size (give or take one for each halving) of a neighbour graph that cut few edges, by halving."""
    out = np.zeros(len(graph), np.int64)
    a, b = np.repeat(np.arange(len(graph)), graph.shape[1]), graph.ravel()
    for _ in range(parts.bit_length() - 1):
        nxt = out * 2
        for p in np.unique(out).tolist():
            rows = np.flatnonzero(out == p)
            at = np.full(len(graph), -1)
            at[rows] = np.arange(len(rows))
            inside = (out[a] == p) & (out[b] == p)
            nxt[rows] += _bisect(at[a[inside]], at[b[inside]], len(rows), rng)
        out = nxt
    return out


@dataclass
class Router:
    """A classifier with one hidden layer, from vectors to probabilities of partitions, and how much of them is searched."""

    mean: np.ndarray
    scale: float
    layers: list[np.ndarray]
    mass: float = 1.0

    def _hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            z = np.clip((x - self.mean) / self.scale, -100, 100)
        return z, np.maximum(0, z @ self.layers[0] + self.layers[1])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z, h = self._hidden(x)
        s = h @ self.layers[2] + z @ self.layers[4] + self.layers[3]
        s = np.exp(s - s.max(axis=1, keepdims=True))
        return s / s.sum(axis=1, keepdims=True)

    def partition(self, x: np.ndarray) -> np.ndarray:
        return self.probabilities(x).argmax(axis=1)

    def _order(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Partitions by falling probability, and the mass of those before each."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        p = np.take_along_axis(p, order, axis=1)
        return order, np.cumsum(p, axis=1) - p

    def routes(self, x: np.ndarray, rows_of_part: np.ndarray, least: int) -> list[np.ndarray]:
        """The most probable partitions of each query: up to the tuned mass, and until they hold ``least`` rows."""
        order, before = self._order(x)
        held = np.cumsum(rows_of_part[order], axis=1) - rows_of_part[order]
        return [o[(m <= self.mass) | (n < least)] for o, m, n in zip(order, before, held, strict=True)]

    def fit(self, x: np.ndarray, target: np.ndarray, rng: np.random.Generator) -> None:
        """Cross entropy to shares of neighbours in partitions, by Adam."""
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.layers]
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(x))
            for low in range(0, len(x), 256):
                rows = order[low : low + 256]
                z, h = self._hidden(x[rows])
                off = (self.probabilities(x[rows]) - target[rows]) / len(rows)
                back = (off @ self.layers[2].T) * (h > 0)
                grads = [z.T @ back, back.sum(axis=0), h.T @ off, off.sum(axis=0), z.T @ off]
                step += 1
                rate = 3e-3 * (1 - epoch / EPOCHS)
                for w, g, (m, v) in zip(self.layers, grads, moments, strict=True):
                    m += 0.1 * (g + 1e-4 * w - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def tune(self, queries: np.ndarray, answers: np.ndarray, part_of: np.ndarray) -> None:
        """The least mass with which the partitions searched hold the wanted share of the answers."""
        order, before = self._order(queries)
        rank = np.argsort(order, axis=1)
        needed = np.take_along_axis(before, np.take_along_axis(rank, part_of[answers], axis=1), axis=1)
        self.mass = float(np.quantile(needed, RECALL, method="higher"))


def fit_router(x: np.ndarray, parts: int, seed: int = 1) -> Router:
    """A router for different vectors in an order that does not depend on what they hold."""
    rng = np.random.default_rng(seed)
    middle = x.mean(axis=0)
    scale = float(np.sqrt(((x - middle) ** 2).mean())) or 1.0
    sizes = [(x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, parts), (parts,), (x.shape[1], parts)]
    router = Router(middle, scale, [rng.standard_normal(s) / math.sqrt(s[0]) * (len(s) == 2) for s in sizes])
    if parts == 1:
        return router
    graph = neighbour_graph((x - middle) / scale, GRAPH)
    part = balanced_partition(graph, parts, rng)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1 / (graph.shape[1] + 1))
    target[np.arange(len(x)), part] += 1 / (graph.shape[1] + 1)
    held = min(HELD_OUT, len(x) // 5)
    router.fit(x[held:], target[held:], rng)
    router.tune(x[:held], graph[:held], router.partition(x))
    return router


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [x if x is not None and x.any() else None for x in sound_vectors(batch.column("vector"))]
        some = pa.array([i for i, x in enumerate(vectors) if x is not None], pa.int64())
        known = [x for x in vectors if x is not None]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id_value").take(some), pa.array([len(x) for x in known], pa.int64()), pa.array([x.astype("<f8").tobytes() for x in known], pa.binary())],
            names=["id_value", "dim", "vector"],
        )


def _sound(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    narrow = vectors.select(F.col(id_column).cast("long").alias("id_value"), F.col(vector_column).alias("vector"))
    return narrow.mapInArrow(_packed, "id_value long, dim long, vector binary")


def train(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> dict[int, Router]:
    """A router for each number of components, fitted on at most TRAIN_ROWS different vectors of it.

    The sample is a share of the different vectors by hash, so that copies count once. Lengths with so few vectors that
    one partition is enough need no model. What reaches the driver is the sample.
    """
    rows = _sound(vectors, id_column, vector_column)
    out = {}
    for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():
        dim, n = r["dim"], r["n"]
        if (parts := parts_for(n)) == 1:
            continue
        mark = F.xxhash64("vector")
        share = min(1.0, 2 * TRAIN_ROWS / n)
        some = rows.where((F.col("dim") == dim) & (F.abs(F.pmod(mark, F.lit(1 << 30))) < int(share * (1 << 30))))
        sample = some.select("vector").distinct().orderBy(mark, "vector").limit(TRAIN_ROWS).collect()
        x = matrix([s["vector"] for s in sample], "<f8")
        x = x[np.abs(x).max(axis=1) < 1e100]  # squares of others do not fit in a double
        while parts > 1 and len(x) < 16 * parts:
            parts //= 2
        if parts > 1:
            out[dim] = fit_router(x, parts)
    return out


def _with_parts(routers: dict[int, Router]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, raws = batch.column("dim").to_numpy(), batch.column("vector").to_pylist()
            part = np.zeros(len(raws), np.int32)
            for dim in np.unique(dims).tolist():
                if dim in routers:
                    at = np.flatnonzero(dims == dim)
                    part[at] = routers[dim].partition(matrix([raws[i] for i in at.tolist()], "<f8"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], names=[*batch.schema.names, "part"])

    return run


def _routed(routers: dict[int, Router], sizes: dict[tuple[int, int], int], least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, raws = batch.column("dim").to_pylist(), batch.column("vector").to_pylist()
            routes = [np.zeros(1, np.int64)] * len(raws)
            for dim in {d for d in dims if d in routers}:
                at = [i for i, d in enumerate(dims) if d == dim]
                counts = np.array([sizes.get((dim, p), 0) for p in range(routers[dim].layers[3].shape[0])])
                for i, route in zip(at, routers[dim].routes(matrix([raws[i] for i in at], "<f8"), counts, least), strict=True):
                    routes[i] = route
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tolist() for r in routes], pa.list_(pa.int32()))], names=[*batch.schema.names, "parts"])

    return run


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to a query; differences that are too large or small to be squared are scaled first."""
    with np.errstate(over="ignore"):
        off = x - q
        out = np.sqrt((off * off).sum(axis=1))
        most = np.abs(off).max(axis=1)
    odd = (most > 1e150) | ((most < 1e-150) & (most > 0))
    if odd.any():
        # Halved first, as a difference of two finite numbers may be infinite.
        half = x[odd] / 2 - q / 2
        half = np.where(most[odd, None] > 1e150, half, off[odd])
        unit = np.abs(half).max(axis=1, keepdims=True)
        with np.errstate(over="ignore"):
            out[odd] = np.sqrt(((half / unit) ** 2).sum(axis=1)) * unit[:, 0] * np.where(most[odd] > 1e150, 2.0, 1.0)
    return out


def _best(k: int):
    """The k nearest rows of a group for each query of it, not the query's own."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list[np.ndarray]] = {"query_row": [], "query_id": [], "vec_id": [], "row": [], "score": []}
        if left.num_rows and right.num_rows:
            ids, rows = right.column("id_value").to_pandas().to_numpy(object), right.column("row").to_numpy()
            x, q = matrix(right.column("vector").to_pylist(), "<f8"), matrix(left.column("vector").to_pylist(), "<f8")
            sort_ids = np.array([np.inf if i is None or i != i else 0 for i in ids])
            whole = np.array([0 if s else int(i) for i, s in zip(ids, sort_ids, strict=True)], np.int64)
            with np.errstate(over="ignore", invalid="ignore"):
                size = (x * x).sum(axis=1)
                for i, (own, own_id) in enumerate(zip(left.column("row").to_pylist(), left.column("id_value").to_pylist(), strict=True)):
                    own_size = float((q[i] * q[i]).sum())
                    about = size + own_size - 2 * (x @ q[i])
                    error = 1e-9 * (size + own_size) + 1e-290
                    others = rows != own
                    bound = np.sort(np.where(others, np.where(np.isfinite(about + error), about + error, np.inf), np.inf))[min(k, len(x)) - 1]
                    some = np.flatnonzero(others & ~(about - error > bound))
                    score = distances(x[some], q[i])
                    first = np.lexsort((rows[some], whole[some], sort_ids[some], score))[:k]
                    some = some[first]
                    out["query_row"].append(np.full(len(some), own))
                    out["query_id"].append(np.full(len(some), own_id))
                    out["vec_id"].append(np.where(sort_ids[some] > 0, None, whole[some]))
                    out["row"].append(rows[some])
                    out["score"].append(score[first])
        kinds = {"query_row": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "row": pa.int64(), "score": pa.float64()}
        return pa.table({n: pa.array(np.concatenate(v).tolist() if v else [], kinds[n]) for n, v in out.items()})

    return run


def nearest(
    vectors: DataFrame, routers: dict[int, Router], id_column: str = "vec_id", vector_column: str = "embedding", every: int = QUERY_EVERY, k: int = NEIGHBOURS
) -> DataFrame:
    """The k nearest vectors found for each vector whose id ``every`` divides, by Euclidean distance.

    Columns: query_id, rank (from 1), vec_id, score. Ties go to the smaller id (null last).

    The classifier puts every row into the partition that it holds most probable. A query is sent to its most probable
    partitions, up to the mass that the sample asked for, and further until they hold k other rows; there its distance
    to all rows is taken. Rows and queries of a large partition are dealt into groups of bounded size, every group of
    rows with every group of queries, so no partition is one task; a group gives k rows per query.

    Only vectors with as many components as the query are compared. Vectors that are null, empty, zero or hold a null
    or non-finite component take no part. Rows that repeat are vectors, and queries, of their own. Null ids are no
    queries. Other columns are ignored. An empty table gives an empty result.
    """
    rows = stored(_sound(vectors, id_column, vector_column).mapInArrow(_with_parts(routers), "id_value long, dim long, vector binary, part int").withColumn("row", F.monotonically_increasing_id()), "index")
    counts = rows.groupBy("dim", "part").agg(F.count(F.lit(1)).alias("n"))
    # Partitions of lengths with a model; others are one partition each.
    modelled = counts.where(F.col("dim").isin(*routers)) if routers else counts.limit(0)
    sizes = {(r["dim"], r["part"]): r["n"] for r in modelled.collect()}
    asked = rows.where(F.col("id_value") % every == 0).select("id_value", "row", "dim", "vector")
    queries = stored(asked.mapInArrow(_routed(routers, sizes, k + 1), "id_value long, row long, dim long, vector binary, parts array<int>"), "queries")
    queries = queries.select("id_value", "row", "dim", "vector", F.explode("parts").alias("part"))

    asked_counts = queries.groupBy("dim", "part").agg(F.count(F.lit(1)).alias("asked"))
    groups = counts.join(asked_counts, ["dim", "part"]).select(
        "dim", "part", F.ceil(F.col("n") / ROWS_OF_GROUP).alias("row_groups"), F.ceil(F.col("asked") / QUERIES_OF_GROUP).alias("query_groups")
    )
    groups = stored(groups, "groups")
    deal = lambda column: F.pmod(F.xxhash64("row"), F.col(column))
    spread = lambda column: F.explode(F.sequence(F.lit(0).cast("long"), F.col(column) - 1))
    right = rows.join(groups, ["dim", "part"]).select("id_value", "row", "vector", "dim", "part", deal("row_groups").alias("g"), spread("query_groups").alias("h"))
    left = queries.join(groups, ["dim", "part"]).select("id_value", "row", "vector", "dim", "part", spread("row_groups").alias("g"), deal("query_groups").alias("h"))
    keys = ["dim", "part", "g", "h"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_best(k), "query_row long, query_id long, vec_id long, row long, score double")
    order = Window.partitionBy("query_row").orderBy("score", F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
