"""Removal of repeated byte strings: sparse suffix sorting at anchors, deep and shallow."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import mixed, stored

#: Least length of a repeated string, length of the grams that anchors are chosen by, bytes that are worked on at once.
LENGTH, GRAM, CHUNK = 200, 40, 1 << 18
#: Bytes by which suffixes are sorted in columns before tries go on; contexts that are compared at once.
SHALLOW, CONTEXTS = 64, 10_000
_BASE = 0x9E3779B97F4A7C15
_POSITION = np.uint64((1 << 24) - 1)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.concatenate([[np.uint64(1)], np.full(n, _BASE, np.uint64)]).cumprod(dtype=np.uint64)
        down = np.concatenate([[np.uint64(1)], np.full(n, inverse, np.uint64)]).cumprod(dtype=np.uint64)
    return up, down


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and gram hashes of anchors in texts that lie one after another in ``data``.

    Each string of ``length`` bytes within a text has an anchor: the gram with the least hash, the first of equals.
    It depends on the string alone, so equal strings have it at the same place.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    window, n = length - gram + 1, len(data) - gram + 1
    if n < window:
        return none
    size = 1 << max(16, (len(data) + 1).bit_length())
    up, down = _powers(size)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)])
    hashes = mixed((sums[gram:] - sums[:-gram]) * down[:n])
    keyed = (hashes & ~_POSITION) | np.arange(n, dtype=np.uint64)
    rows = -(-n // window)
    padded = np.full(rows * window, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keyed
    blocks = padded.reshape(rows, window)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(since[: n - window + 1], upto[window - 1 : n])
    inside = np.zeros(len(data) + 2, np.int8)
    long = ends - starts >= length
    inside[starts[long]] += 1
    inside[ends[long] - length + 1] -= 1
    valid = np.cumsum(inside[: len(least)], dtype=np.int8) > 0
    at = (least[valid] & _POSITION).astype(np.int64)
    if not len(at):
        return none
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    return at, hashes[at]


def _pieces(texts: pa.Array, length: int, chunk: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts in lots of about ``chunk`` bytes: number, offset and bytes. Long texts come in pieces that overlap by length - 1."""
    lot, size = [], 0
    for i, value in enumerate(texts):
        text = value.as_py()
        for at in range(0, max(len(text) - length + 1, 1), chunk):
            piece = text[at : at + chunk + length - 1]
            lot.append((i, at, piece))
            size += len(piece)
            if size >= chunk:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def _anchors(text: str, length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("k1").to_numpy()
            for lot in _pieces(batch.column(text), length, CHUNK):
                sizes = np.fromiter((len(p) for _, _, p in lot), np.int64, len(lot))
                ends = np.cumsum(sizes)
                at, hashes = anchors(np.frombuffer(b"".join(p for _, _, p in lot), np.uint8), ends - sizes, ends, length, gram)
                of = np.searchsorted(ends, at, "right")
                number, offset = np.array([x[0] for x in lot], np.int64), np.array([x[1] for x in lot], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(keys[number[of]]), pa.array(at - (ends - sizes)[of] + offset[of])], names=["h", "k1", "pos"]
                )

    return run


def _contexts(length: int, gram: int):
    """Surroundings of anchors, each at most twice per partition, and for each text the references of its anchors."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        following = TaskContext.get().partitionId() << 40
        known: dict[tuple[bytes, bytes], list[int]] = {}
        def out(rows):
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CONTEXT, strict=True)], schema=_CONTEXT)

        rows = []
        for batch in batches:
            for k1, k2, text, places in zip(*[batch.column(c) for c in ("k1", "k2", "text_value", "places")], strict=True):
                k1, k2, text, places, refs = k1.as_py(), k2.as_py(), text.as_py(), places.as_py(), []
                for p in places:
                    left, right = text[max(p - reach, 0) : p], text[p : p + length]
                    seen = known.setdefault((left, right), [following, 0])
                    following += seen[1] == 0
                    if seen[1] < 2:
                        seen[1] += 1
                        rows.append((xxhash.xxh3_64_intdigest(right[:gram]) - (1 << 63), left, right, seen[0], None, None, None, None))
                    refs.append(seen[0])
                rows.append((k1, None, None, None, k1, k2, refs, places))
                if len(rows) > CONTEXTS:
                    yield out(rows)
                    rows = []
        yield out(rows)

    return run


_CONTEXT = pa.schema([("g", pa.int64()), ("left", pa.binary()), ("right", pa.binary()), ("ref", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("refs", pa.list_(pa.int64())), ("places", pa.list_(pa.int64()))])
_RANGE = pa.schema([("ref", pa.int64()), ("before", pa.int64()), ("after", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("refs", pa.list_(pa.int64())), ("places", pa.list_(pa.int64()))])


def _common(a: bytes, b: bytes) -> int:
    """Length of the common beginning, by halving."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class BlindTrie:
    """Sorts strings that share a long beginning, looking at the places where they part.

    A node has the depth at which its strings part and a child for each next byte (-1: the string ends). A string is
    brought down by these bytes alone to some leaf, compared with it once, and put in where the two part.
    """

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None
        for i in range(len(strings)):
            self._insert(i)

    def _next(self, s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    def _insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        node = self.root
        while isinstance(node, tuple):
            node = node[1].get(self._next(s, node[0])) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        depth = _common(s, other)
        if depth == len(s) == len(other):
            node.append(i)
            return
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            above, node = node, node[1][self._next(s, node[0])]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][self._next(s, depth)] = [i]
            return
        split = (depth, {self._next(other, depth): node, self._next(s, depth): [i]})
        if above is None:
            self.root = split
        else:
            above[1][self._next(s, above[0])] = split

    def order(self) -> list[int]:
        out, todo = [], [self.root] if self.root else []
        while todo:
            node = todo.pop()
            if isinstance(node, tuple):
                todo += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out += node
        return out


def deep_shallow_sort(strings: list[bytes], groups: np.ndarray, width: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings within their groups, and the length that each shares with the one before (-1: another group).

    Columns of eight bytes are sorted up to the shallow depth; strings that still agree go through a blind trie.
    """
    m = len(strings)
    sizes = np.fromiter(map(len, strings), np.int64, m)
    grid = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(m, width)
    deep = min(shallow, width) // 8 * 8
    columns = np.ascontiguousarray(grid[:, :deep]).view(">u8").astype(np.uint64)
    short = np.minimum(sizes, deep)
    order = np.lexsort([short, *columns.T[::-1], groups])

    def neighbours(order):
        x, g, size = grid[order], groups[order], sizes[order]
        differ = x[1:] != x[:-1]
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        shared = np.minimum(shared, np.minimum(size[1:], size[:-1]))
        return np.concatenate([[-1], np.where(g[1:] == g[:-1], shared, -1)]) if m else np.zeros(0, np.int64)

    ties = neighbours(order) >= deep
    starts = np.flatnonzero(~ties)
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), m], strict=True):
        if hi - lo > 1:
            own = order[lo:hi]
            order[lo:hi] = own[BlindTrie([strings[i] for i in own.tolist()]).order()]
    return order, neighbours(order)


def reaches(left: list[bytes], right: list[bytes], groups: np.ndarray, weights: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """How far before and after its anchor each context is covered by strings of ``length`` that occur again; 0, 0: not at all.

    left, right: the bytes before an anchor and from it on; equal contexts come once, with their number as weight.
    Both sides are sorted, which gives for each depth the contexts that agree up to it. A string that starts o bytes
    before the anchor occurs again if another context agrees on o bytes before and length - o after.
    """
    m, reach = len(left), length - gram
    n_left, n_right = np.fromiter(map(len, left), np.int64, m), np.fromiter(map(len, right), np.int64, m)
    most, least = np.full(m, -1), np.full(m, length + 1)
    alone = (weights > 1) & (n_left + n_right >= length)
    most[alone], least[alone] = n_left[alone], np.maximum(length - n_right[alone], 0)
    _, inverse, counts = np.unique(groups, return_inverse=True, return_counts=True)
    some = np.flatnonzero(counts[inverse] > 1)
    if len(some):
        sides = []
        for strings, width in (([left[i][::-1] for i in some.tolist()], -(-reach // 8) * 8), ([right[i] for i in some.tolist()], -(-length // 8) * 8)):
            sides.append(deep_shallow_sort(strings, groups[some], width))
        (order_l, shared_l), (order_r, shared_r) = sides
        k = len(some)
        class_l, class_r = np.empty(k, np.int64), np.empty(k, np.int64)
        for o in range(reach + 1):
            class_l[order_l] = np.cumsum(shared_l < o)
            class_r[order_r] = np.cumsum(shared_r < length - o)
            key = class_l * (k + 1) + class_r
            by = np.argsort(key, kind="stable")
            same = key[by][1:] == key[by][:-1]
            hit = np.zeros(k, bool)
            hit[by] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            at = some[hit]
            most[at] = np.maximum(most[at], o)
            least[at] = np.minimum(least[at], o)
    covered = most >= 0
    return np.where(covered, most, 0), np.where(covered, length - least, 0)


def _ranges(length: int, gram: int):
    def work(rows: list[tuple]) -> pa.RecordBatch:
        contexts: dict[tuple, list[int]] = {}
        for g, left, right, ref in rows:
            contexts.setdefault((g, left, right), []).append(ref)
        keys = list(contexts)
        groups = np.fromiter((x[0] for x in keys), np.int64, len(keys))
        weights = np.fromiter(map(len, contexts.values()), np.int64, len(keys))
        before, after = reaches([x[1] for x in keys], [x[2] for x in keys], groups, weights, length, gram)
        out = [(r, int(b), int(a), None, None, None, None) for refs, b, a in zip(contexts.values(), before, after, strict=True) if a for r in set(refs)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [()] * 7, _RANGE, strict=True)], schema=_RANGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            is_text = batch.column("left").is_null()
            texts = batch.filter(is_text)
            none = pa.nulls(len(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, *[texts.column(c) for c in ("k1", "k2", "refs", "places")]], schema=_RANGE)
            contexts = batch.filter(pc.invert(is_text))
            held += zip(*[contexts.column(c).to_pylist() for c in ("g", "left", "right", "ref")], strict=True)
            if len(held) > CONTEXTS:  # whole groups only: rows are sorted by g
                last = held[-1][0]
                cut = next((i for i in range(len(held) - 1, -1, -1) if held[i][0] != last), -1) + 1
                if cut:
                    yield work(held[:cut])
                    held = held[cut:]
        if held:
            yield work(held)

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes that stay when ranges are taken out, and the number and total of maximal removed runs."""
    for batch in batches:
        out = []
        for k1, k2, text, ranges in zip(*[batch.column(c) for c in ("k1", "k2", "text_value", "ranges")], strict=True):
            k1, k2, text, ranges, runs = k1.as_py(), k2.as_py(), text.as_py(), ranges.as_py(), []
            for lo, hi in sorted((r["lo"], r["hi"]) for r in ranges):
                if runs and lo <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], hi)
                else:
                    runs.append([lo, hi])
            kept = b"".join(text[a:b] for a, b in zip([0, *(r[1] for r in runs)], [*(r[0] for r in runs), len(text)], strict=True))
            out.append((k1, k2, len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["of_k1", "of_k2", "n_removed", "n_spans", "kept_sha256", "kept_text"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 6, kinds, strict=True)], names=names)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Take out each byte that is covered by a string of ``length`` bytes that also starts anywhere else.

    Columns: the id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and kept_text: what is left, in
    binary as borders may cut characters; null where nothing was removed. One row per document.

    Texts are UTF-8 bytes; matches stay within a document, and the input alone decides. Of each string of ``length``
    bytes one gram is the anchor. Anchors whose gram occurs once are dropped after counting. For the others, the
    suffixes from the anchor and the reversed prefixes before it are sorted within the anchors of a gram: in columns to
    a shallow depth, then by blind tries. Lengths shared with neighbours then tell exactly which strings occur again.
    Equal surroundings are sent at most twice by each partition.

    A null text counts as empty. Rows that agree in id and text count as places of their own. Ids may be null. Other
    columns are ignored. An empty table gives an empty result.
    """
    text = F.encode(F.coalesce(F.col(text_column).cast("string"), F.lit("")), "UTF-8")
    keyed = docs.select(F.col(id_column).alias("id_value"), text.alias("text_value"))
    keyed = keyed.select("id_value", "text_value", F.xxhash64("id_value", "text_value").alias("k1"), F.xxhash64(F.lit(1), "text_value").alias("k2"))
    # Anchors follow from the texts, so they are made twice rather than stored.
    found = keyed.select("k1", "text_value").mapInArrow(_anchors("text_value", length, gram), "h long, k1 long, pos long")
    # Stored, so that the join deals out the anchors by itself and can split those of a very common gram.
    again = stored(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "grams")
    places = found.join(again, "h").groupBy("k1").agg(F.sort_array(F.collect_set("pos")).alias("places"))
    texts = stored(keyed.select("k1", "k2", "text_value").join(places, "k1"), "texts")

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    contexts = texts.mapInArrow(_contexts(length, gram), "g long, left binary, right binary, ref long, k1 long, k2 long, refs array<long>, places array<long>")
    ranges = stored(
        contexts.repartition(n, "g").sortWithinPartitions("g").mapInArrow(_ranges(length, gram), "ref long, before long, after long, k1 long, k2 long, refs array<long>, places array<long>"),
        "ranges",
    )
    members = ranges.where("k1 is not null").select("k1", "k2", F.explode(F.arrays_zip("refs", "places")).alias("m")).select("k1", "k2", F.col("m.refs").alias("ref"), F.col("m.places").alias("pos"))
    covered = ranges.where("ref is not null").groupBy("ref").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    spans = members.join(covered, "ref").select("k1", "k2", F.struct((F.col("pos") - F.col("before")).alias("lo"), (F.col("pos") + F.col("after")).alias("hi")).alias("range"))
    spans = spans.distinct().groupBy("k1", "k2").agg(F.collect_list("range").alias("ranges"))
    cut = texts.select("k1", "k2", "text_value").dropDuplicates(["k1", "k2"]).join(spans, ["k1", "k2"])
    cut = cut.select("k1", "k2", "text_value", "ranges").mapInArrow(_kept, "of_k1 long, of_k2 long, n_removed long, n_spans long, kept_sha256 string, kept_text binary")
    rows = keyed.select("id_value", "k1", "k2", F.length("text_value").cast("long").alias("n_bytes"), F.sha2("text_value", 256).alias("whole"))
    out = rows.join(cut, (rows["k1"] == cut["of_k1"]) & (rows["k2"] == cut["of_k2"]), "left")
    return out.select(
        F.col("id_value").alias(id_column),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        "kept_text",
    )
