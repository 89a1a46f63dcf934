"""Near duplicates of embeddings by an epsilon grid order join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import stored
from veritab.llm.components import components, labels_of

#: Least cosine; leading principal dimensions of the grid; vectors of a block; vectors of an interval that is joined at once.
COSINE, LEADING, BLOCK, INTERVAL = 0.98, 6, 512, 128


def _flat(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors in single or double precision as they came; None for those that link with nothing."""
    out = []
    for v in column:
        x = None
        if v.is_valid and len(v.values) and not v.values.null_count:
            x = v.values.to_numpy(zero_copy_only=False)
            if not np.isfinite(x).all() or not x.any():
                x = None
        out.append(x)
    return out


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = _flat(batch.column("vector"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id_value"), batch.column("label"), pa.array([None if x is None else x.astype("<f8").tobytes() for x in vectors], pa.binary())],
            names=["id_value", "label", "vector"],
        )


def _matrix(raws: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raws), "<f8").reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    """Directions; lengths are taken out in two steps, so that large and small numbers do not overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums, and sums of products, of directions, by number of dimensions."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        raws = batch.column("vector").to_pylist()
        for dim in {len(r) // 8 for r in raws}:
            u = _unit(_matrix([r for r in raws if len(r) == 8 * dim], dim))
            own = np.concatenate([[len(u)], u.sum(axis=0), (u.T @ u).ravel()])
            sums[dim] = sums.get(dim, 0) + own
    for dim, s in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), dim), pa.int64()), pa.array(np.arange(len(s)), pa.int64()), pa.array(s)], names=["dim", "k", "value"])


def principal_directions(vectors: DataFrame, leading: int = LEADING) -> dict[int, np.ndarray]:
    """Leading directions of variance for each number of dimensions; what reaches the driver is a matrix for each."""
    rows = vectors.mapInArrow(_moments, "dim long, k long, value double").groupBy("dim", "k").agg(F.sum("value").alias("value")).collect()
    out = {}
    for dim in {r["dim"] for r in rows}:
        s = np.zeros(1 + dim + dim * dim)
        for r in rows:
            if r["dim"] == dim:
                s[r["k"]] = r["value"]
        mean = s[1 : 1 + dim] / s[0]
        spread = s[1 + dim :].reshape(dim, dim) / s[0] - np.outer(mean, mean)
        out[dim] = np.linalg.eigh(spread)[1][:, ::-1][:, : min(leading, dim)].copy()
    return out


def _grid(directions: dict[int, np.ndarray], eps: float, leading: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column("vector").to_pylist()
            cells = np.zeros((len(raws), leading), np.int32)
            for dim in {len(r) // 8 for r in raws}:
                rows = [i for i, r in enumerate(raws) if len(r) == 8 * dim]
                at = np.floor(_unit(_matrix([raws[i] for i in rows], dim)) @ directions[dim] / eps)
                cells[rows, : at.shape[1]] = at
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(r) // 8 for r in raws], pa.int64()), *[pa.array(cells[:, k]) for k in range(leading)]],
                names=[*batch.schema.names, "dim", *[f"c{k}" for k in range(leading)]],
            )

    return run


_BLOCKS = "block long, label string, dim long, cell_lo int, cell_hi int, lo array<double>, hi array<double>, ids binary, weights binary, vectors binary"


def _blocks(directions: dict[int, np.ndarray], block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def flush():
            nonlocal number, held
            label, dim = held[0][:2]
            at = _unit(_matrix([h[5] for h in held], dim)) @ directions[dim]
            row = [number, label, dim, min(h[2] for h in held), max(h[2] for h in held), at.min(axis=0).tolist(), at.max(axis=0).tolist(),
                   np.array([h[3] for h in held], "<i8").tobytes(), np.array([h[4] for h in held], "<i8").tobytes(), b"".join(h[5] for h in held)]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
            number, held = number + 1, []
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[x.split()[0] for x in _BLOCKS.split(", ")])

        for batch in batches:
            for row in zip(*[batch.column(n).to_pylist() for n in ("label", "dim", "c0", "cls", "weight", "vector")], strict=True):
                if held and (len(held) == block or row[:2] != held[0][:2]):
                    yield flush()
                held.append(row)
        if held:
            yield flush()

    return run


def _join(directions: dict[int, np.ndarray], cosine: float, eps: float, interval: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                side = []
                for s in ("a", "b"):
                    x = np.frombuffer(row[f"vectors_{s}"], "<f8").reshape(-1, dim)
                    u = _unit(x)
                    side.append((np.frombuffer(row[f"ids_{s}"], "<i8"), np.frombuffer(row[f"weights_{s}"], "<i8"), u, u @ directions[dim]))
                (ids_a, w_a, u_a, p_a), (ids_b, w_b, u_b, p_b) = side
                mask = np.zeros((len(ids_a), len(ids_b)), bool)
                _intervals(mask, u_a, p_a, u_b, p_b, 0, len(ids_a), 0, len(ids_b), cosine, eps, interval)
                same = row["a"] == row["b"]
                if same:
                    np.fill_diagonal(mask, False)
                label_a, label_b = labels_of(mask, ids_a, ids_b)
                out = [(ids_a, label_a, mask @ w_b)]
                if not same:
                    out.append((ids_b, label_b, mask.T @ w_a))
                for ids, label, links in out:
                    any_ = links > 0
                    yield pa.RecordBatch.from_arrays([pa.array(ids[any_]), pa.array(label[any_]), pa.array(links[any_])], names=["cls", "root", "links"])

    return run


def _intervals(mask, u_a, p_a, u_b, p_b, a0, a1, b0, b1, cosine, eps, interval):
    """Join two intervals of the order: skipped if their boxes are farther apart than eps, halved if they are large."""
    lo_a, hi_a, lo_b, hi_b = p_a[a0:a1].min(0), p_a[a0:a1].max(0), p_b[b0:b1].min(0), p_b[b0:b1].max(0)
    gap = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    if (gap * gap).sum() > eps * eps:
        return
    if a1 - a0 <= interval and b1 - b0 <= interval:
        mask[a0:a1, b0:b1] = u_a[a0:a1] @ u_b[b0:b1].T >= cosine
        return
    cuts_a = [a0, (a0 + a1) // 2, a1] if a1 - a0 > interval else [a0, a1]
    cuts_b = [b0, (b0 + b1) // 2, b1] if b1 - b0 > interval else [b0, b1]
    for s, t in zip(cuts_a, cuts_a[1:], strict=False):
        for v, w in zip(cuts_b, cuts_b[1:], strict=False):
            _intervals(mask, u_a, p_a, u_b, p_b, s, t, v, w, cosine, eps, interval)


def near_embeddings(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", cosine: float = COSINE) -> DataFrame:
    """Links between vectors of a label with a cosine of at least ``cosine``, one row per vector.

    Columns: the id, n_links, component_id (least id that links reach), kept.

    Equal vectors of a label are joined once, with their number as weight. Directions are put on a grid whose cells
    are as wide as the largest distance of linked directions, over their leading principal dimensions, and sorted by
    label and cell. Blocks of this order are paired if their boxes are near enough (first by equality of the first
    cell, give or take one), and pairs of blocks are joined by halving them, skipping what is provably too far.
    A pair of blocks gives at most one row per vector: its number of links, and its least partner.

    A null label, and a vector that is null, empty, zero or holds a null or non-finite number, link with nothing;
    vectors of different lengths do not link. Null ids are larger than all others. Rows that repeat are vectors of
    their own. An empty table gives an empty result.
    """
    leading, eps = LEADING, math.sqrt(2 - 2 * cosine) * (1 + 1e-9) + 1e-12
    kind = vectors.schema[id_column].dataType.simpleString()
    narrow = vectors.select(F.col(id_column).alias("id_value"), F.col(label_column).cast("string").alias("label"), F.col(vector_column).alias("vector"))
    rows = stored(narrow.mapInArrow(_prepared, f"id_value {kind}, label string, vector binary"), "vectors")
    usable = F.col("label").isNotNull() & F.col("vector").isNotNull()
    classes = rows.where(usable).groupBy("label", "vector").agg(F.count(F.lit(1)).alias("weight"), F.min("id_value").alias("least"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")

    directions = principal_directions(classes)
    names = [f"c{k}" for k in range(leading)]
    grid = classes.select("label", "vector", "weight", "cls").mapInArrow(
        _grid(directions, eps, leading), f"label string, vector binary, weight long, cls long, dim long, {', '.join(f'{n} int' for n in names)}"
    )
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "dim", *names, "cls"]
    blocks = stored(grid.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_blocks(directions, BLOCK), _BLOCKS), "blocks")

    boxes = blocks.select("block", "label", "dim", "cell_lo", "cell_hi", "lo", "hi")
    left = boxes.select(F.col("block").alias("a"), "label", "dim", F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"), F.explode(F.sequence("cell_lo", "cell_hi")).alias("cell"))
    right = boxes.select(F.col("block").alias("b"), "label", "dim", F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"), F.explode(F.sequence(F.col("cell_lo") - 1, F.col("cell_hi") + 1)).alias("cell"))
    gaps = F.transform(
        F.arrays_zip("lo_a", "hi_a", "lo_b", "hi_b"),
        lambda x: F.greatest(F.lit(0.0), x["lo_a"] - x["hi_b"], x["lo_b"] - x["hi_a"]),
    )
    distance = F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x)
    near = left.join(right, ["label", "dim", "cell"]).where((F.col("a") <= F.col("b")) & (distance <= eps * eps)).select("a", "b").distinct()
    # A pair may be seen from the larger block's side only.
    payload = blocks.select("block", "dim", "ids", "weights", "vectors")
    side = lambda s: payload.select(F.col("block").alias(s), *([F.col("dim")] if s == "a" else []), *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "weights", "vectors")])
    joined = near.join(side("a"), "a").join(side("b"), "b").mapInArrow(_join(directions, cosine, eps, INTERVAL), "cls long, root long, links long")
    found = stored(joined, "links")

    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    parts = components(found.select("cls", "root"))
    linked = classes.select("cls", "label", "vector", "weight", "least").join(links, "cls", "left").join(parts, F.col("cls") == F.col("node"), "left")
    linked = stored(linked.select("label", "vector", "least", F.coalesce("component", "cls").alias("component"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "linked")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    info = linked.join(least, "component").select("label", "vector", "n_links", "component_id")
    out = rows.join(info, ["label", "vector"], "left")
    alone = ~usable
    return out.select(
        F.col("id_value").alias(id_column),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(alone, F.col("id_value")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, True).otherwise(F.col("id_value").eqNullSafe(F.col("component_id"))).alias("kept"),
    )
