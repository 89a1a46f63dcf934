"""Centroid clustering in whole numbers, with centroids filtered by n-simplex projection."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import stored
from veritab.llm.vectors import sound_vectors

#: Clusters; rounds that move centroids; components of a vector; steps of the integer grid in one unit.
CLUSTERS, ROUNDS, DIM, SCALE = 16, 3, 64, 64
#: Bounds are taken as if they were wrong by this share of the squared distances to the first pivot.
SLACK = 1e-5
#: Rows that a task compares at once; bits of a digit of a sum.
LOT, DIGIT = 2048, 40
_NONE = np.iinfo(np.int64).max


def small_limit(dim: int) -> int:
    """Components up to this size have squared distances that fit in 64 bits; others are kept as Python integers."""
    return math.isqrt((1 << 62) // max(dim, 1)) // 2


def grid_vector(x: np.ndarray, scale: int = SCALE) -> list[int]:
    """floor(scale * x) of each component, for any size."""
    return [math.floor(scale * v) if abs(v) < 2.0**52 else scale * int(v) for v in x.tolist()]


def _prepared(dim: int, scale: int):
    """Ids and integer vectors of sound rows: packed if all components are small, else as decimal numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = small_limit(dim)
        for batch in batches:
            vectors = sound_vectors(batch.column("vector"))
            some = [i for i, x in enumerate(vectors) if x is not None and len(x) == dim]
            small, wide = [], []
            for i in some:
                x = vectors[i]
                easy = np.abs(x).max(initial=0) * scale < limit
                small.append(np.floor(x * scale).astype("<i4").tobytes() if easy else None)
                wide.append(None if easy else ",".join(map(str, grid_vector(x, scale))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id_value").take(pa.array(some, pa.int64())), pa.array(small, pa.binary()), pa.array(wide, pa.string())], names=["id_value", "small", "wide"]
            )

    return run


def _numbers(small: bytes | None, wide: str | None) -> list[int]:
    return np.frombuffer(small, "<i4").tolist() if small is not None else [int(x) for x in wide.split(",")]


class Simplex:
    """Apex coordinates over a base of pivots.

    The pivots are corners of a simplex. A point with known distances to them is the apex of one simplex more: its
    coordinates are its projection on the space of the pivots, and its height above it. Between two apexes the
    Euclidean distance with heights on the same side is a lower bound of the distance of the points, and with
    heights on opposite sides an upper one.
    """

    def __init__(self, candidates: list[list[int]], limit: int, dim: int):
        """Pivots are those candidates that are small and far enough from the space of the ones before."""
        easy = [c for c in candidates if max(map(abs, c), default=0) <= limit]
        self.pivots = np.array(easy[:1], np.int64).reshape(-1, dim)
        for c in easy[1:]:
            edges = np.array([*self.pivots[1:], c], np.float64) - self.pivots[0]
            spread = np.abs(np.diag(np.linalg.qr(edges.T)[1])) if len(edges) <= edges.shape[1] else np.zeros(1)
            if spread[-1] > 1e-3 * max(spread.max(), 1):
                self.pivots = np.vstack([self.pivots, c])
        edges = (self.pivots[1:] - self.pivots[:1]).astype(np.float64) if len(self.pivots) else np.zeros((0, 1))
        self.lengths = (edges * edges).sum(axis=1)
        self.base = np.linalg.cholesky(edges @ edges.T) if len(edges) else None

    def apexes(self, x: np.ndarray) -> np.ndarray:
        """Coordinates of integer points from their distances to the pivots; the last one is the height."""
        if not len(self.pivots):
            return np.zeros((len(x), 0))
        squared = np.stack([((x - p) ** 2).sum(axis=1) for p in self.pivots], axis=1).astype(np.float64)
        flat = np.zeros((len(x), 0))
        if self.base is not None:
            flat = np.linalg.solve(self.base, (squared[:, :1] + self.lengths - squared[:, 1:]).T / 2).T
        height = np.sqrt(np.maximum(0, squared[:, 0] - (flat * flat).sum(axis=1)))
        return np.concatenate([flat, height[:, None]], axis=1)


def possible(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centres may be nearest to which points, by bounds of apexes; apexes that are not numbers rule nothing out."""
    if not points.shape[1]:
        return np.ones((len(points), len(centres)), bool)
    size = (points * points).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)
    lower = size - 2 * (points @ centres.T)
    upper = lower + 4 * points[:, -1:] * centres[:, -1]
    best = np.where(np.isnan(upper), np.inf, upper + SLACK * size).min(axis=1)
    return ~(lower - SLACK * size > best[:, None])


class Centres:
    """Centroids of a round, with their apexes."""

    def __init__(self, rows: list[list[int]], simplex: Simplex, limit: int):
        self.rows = rows
        self.easy = np.array([max(map(abs, r), default=0) <= limit for r in rows], bool)
        self.matrix = np.array([r if e else [0] * len(r) for r, e in zip(rows, self.easy, strict=True)], np.int64)
        self.apexes = simplex.apexes(self.matrix)
        self.apexes[~self.easy] = np.nan

    def nearest(self, small: list[bytes | None], wide: list[str | None], apexes: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
        """Number of the nearest centre, and the squared distance, for each row; and which rows are small."""
        is_small = np.array([s is not None for s in small], bool)
        x = np.zeros((len(small), self.matrix.shape[1]), np.int64)
        x[is_small] = np.frombuffer(b"".join(s for s in small if s is not None), "<i4").reshape(-1, x.shape[1])
        may = possible(apexes, self.apexes)
        simple = may & is_small[:, None] & self.easy
        i, k = np.nonzero(simple)
        squared = np.full(may.shape, _NONE)
        for low in range(0, len(i), 4 * LOT):
            a, b = i[low : low + 4 * LOT], k[low : low + 4 * LOT]
            squared[a, b] = ((x[a] - self.matrix[b]) ** 2).sum(axis=1)
        cluster = squared.argmin(axis=1)  # the first of equal ones
        distance = squared[np.arange(len(x)), cluster].tolist()
        for r in np.flatnonzero((may & ~simple).any(axis=1)).tolist():
            own = _numbers(small[r], wide[r])
            exact = [(sum((p - q) ** 2 for p, q in zip(own, self.rows[c], strict=True)), c) for c in np.flatnonzero(may[r]).tolist()]
            distance[r], cluster[r] = min(exact)
        return cluster, distance, is_small


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list, list, np.ndarray]]:
    for batch in batches:
        for low in range(0, batch.num_rows, LOT):
            lot = batch.slice(low, LOT)
            raw = lot.column("apex").to_pylist()
            yield lot, lot.column("small").to_pylist(), lot.column("wide").to_pylist(), np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)


def _with_apexes(simplex: Simplex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            small = batch.column("small").to_pylist()
            width = len(simplex.pivots)
            known = [s for s in small if s is not None]
            at = iter(simplex.apexes(np.frombuffer(b"".join(known), "<i4").astype(np.int64).reshape(len(known), -1)) if known else ())
            raw = [(next(at) if s is not None else np.full(width, np.nan)).astype("<f8").tobytes() for s in small]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, "apex"])

    return run


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """A whole number of any size as signed digits, which can be added up in long columns."""
    place = 0
    while not -(1 << DIGIT) <= value < 1 << DIGIT:
        yield place, value & ((1 << DIGIT) - 1)
        value, place = value >> DIGIT, place + 1
    yield place, value


def _sums(centres: Centres):
    """Counts (component -1) and sums of the vectors of each cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, dim = len(centres.rows), centres.matrix.shape[1]
        counts, sums = [0] * n, np.zeros((n, dim), object)
        for _, small, wide, apexes in _lots(batches):
            cluster, _, is_small = centres.nearest(small, wide, apexes)
            x = np.frombuffer(b"".join(s for s in small if s is not None), "<i4").astype(np.int64).reshape(-1, dim)
            for c in np.unique(cluster).tolist():
                counts[c] += int((cluster == c).sum())
                sums[c] += x[cluster[is_small] == c].sum(axis=0).astype(object)
            for r in np.flatnonzero(~is_small).tolist():
                sums[cluster[r]] += np.array(_numbers(None, wide[r]), object)
        rows = [(c, k, place, digit) for c in range(n) if counts[c] for k, v in [(-1, counts[c]), *enumerate(sums[c].tolist())] for place, digit in _digits(int(v))]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cluster", "component", "place", "digit"])

    return run


def _assigned(centres: Centres):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot, small, wide, apexes in _lots(batches):
            cluster, distance, _ = centres.nearest(small, wide, apexes)
            distance = [d if d <= _NONE else None for d in distance]
            yield pa.RecordBatch.from_arrays([lot.column("id_value"), pa.array(cluster.astype(np.int32)), pa.array(distance, pa.int64())], names=["id_value", "cluster", "distance"])

    return run


def _moved(rows: DataFrame, centres: Centres) -> list[list[int]]:
    """Centroids after a round. What reaches the driver are a few digits for each component of each centroid."""
    found = rows.mapInArrow(_sums(centres), "cluster long, component long, place long, digit long").groupBy("cluster", "component", "place").agg(F.sum("digit").alias("digit")).collect()
    totals: dict[tuple[int, int], int] = {}
    for r in found:
        key = r["cluster"], r["component"]
        totals[key] = totals.get(key, 0) + (r["digit"] << (DIGIT * r["place"]))
    out = []
    for c, own in enumerate(centres.rows):
        n = totals.get((c, -1))
        out.append([totals[c, k] // n for k in range(len(own))] if n else own)
    return out


def cluster(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, salt: str = "1:"
) -> DataFrame:
    """Clusters of the vectors with ``dim`` components, all finite, on an integer grid of ``scale`` steps a unit.

    Columns: the id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256. One row per vector kept.

    Centroids start as the vectors with the least hashes of salt and id (ties: by vector). Distances of each vector to
    the starting centroids, as pivots, are taken once and stored as apex coordinates; in each round bounds from them
    rule centroids out, and the others are compared exactly, in whole numbers. Sums of a cluster are exact as well:
    tasks send digits, which are added up in Spark; no row of the table is shuffled or reaches the driver but the
    starting centroids.

    Rows that repeat are vectors of their own; where ids repeat, packed vectors decide which one starts a centroid. A
    null id counts as an empty one in the hash. Vectors that are null,
    have another number of components, or hold a null or non-finite one are left out. With fewer vectors than
    ``clusters`` there are as many centroids as vectors. Components of any size are compared exactly; a distance or
    inertia that does not fit in a long is null. Other columns are ignored. An empty table gives an empty result.
    """
    narrow = vectors.select(F.col(id_column).alias("id_value"), F.col(vector_column).alias("vector"))
    kind = narrow.schema["id_value"].dataType.simpleString()
    whole = narrow.mapInArrow(_prepared(dim, scale), f"id_value {kind}, small binary, wide string")
    mark = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id_value").cast("string"), F.lit(""))).cast("binary"), 256)
    first = whole.withColumn("mark", mark).orderBy("mark", "small", "wide").limit(clusters).collect()
    starts = [_numbers(r["small"], r["wide"]) for r in first]

    limit = small_limit(dim)
    simplex = Simplex(starts, limit, dim)
    rows = stored(whole.mapInArrow(_with_apexes(simplex), f"id_value {kind}, small binary, wide string, apex binary"), "apexes")
    centres = Centres(starts, simplex, limit)
    for _ in range(rounds if starts else 0):
        centres = Centres(_moved(rows, centres), simplex, limit)
    if not starts:
        centres = Centres([[0] * dim], simplex, limit)
    found = stored(rows.mapInArrow(_assigned(centres), f"id_value {kind}, cluster int, distance long"), "assigned")

    wholly = F.count("distance") == F.count(F.lit(1))
    sums = found.groupBy("cluster").agg(F.when(wholly, F.sum(F.col("distance").cast("decimal(19,0)"))).alias("s")).collect()  # a row per cluster
    fits = lambda x: x if x is not None and x <= _NONE else None
    by_cluster = {r["cluster"]: None if r["s"] is None else int(r["s"]) for r in sums}
    total = None if None in by_cluster.values() else sum(by_cluster.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.rows]
    pick = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster"))
    return found.select(
        F.col("id_value").alias(id_column),
        "cluster",
        "distance",
        pick([fits(by_cluster.get(c)) for c in range(len(digests))], "long").alias("cluster_inertia"),
        F.lit(fits(total)).cast("long").alias("inertia"),
        pick(digests, "string").alias("centroid_sha256"),
    )
