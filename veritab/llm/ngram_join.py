"""Near duplicates by the Jaccard similarity of word n-grams, found with signature trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import byte_column, identified, mixed, releasing, step, stored
from veritab.llm.components import components, labels_of

#: Words of a shingle; least similarity in hundredths.
WORDS, PERCENT = 4, 85
#: Documents from which a shingle counts as frequent, and how many frequent shingles are told to all tasks at most.
FREQUENT, MOST_FREQUENT = 64, 200_000
#: Turns in which sets are compared with hubs before the trees name the rest.
TURNS = 2
#: Bits of a signature in a tree (pairs are screened by signatures of four bits per shingle); entries of a leaf of the
#: tree; entries of a shingle that meet in one tree.
SIGNATURE_BITS, LEAF, PIECE = 256, 16, 8192
#: Sets of a block, and how many shingles they have at most (or one set); sets that a task compares with a block.
BLOCK, BLOCK_SHINGLES, ASKING = 128, 1 << 17, 4096
#: Rows that name sets to compare: a task looks for repeated ones when so many more have come, and holds so many different ones.
NAMED_AT_ONCE, NAMED = 100_000, 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Words whose hashes a task remembers before it starts anew; texts, and bytes of them, that are worked on at once.
REMEMBERED, LOT, LOT_BYTES = 100_000, 500, 2 << 20


class _Hashes(dict):
    """64-bit hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_sets(texts: list[bytes], known: dict, words: int = WORDS) -> Iterator[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes; a shorter text is one shingle as a whole."""
    if len(known) > REMEMBERED:
        known.clear()
    for text in texts:
        own = text.lower().split()  # of bytes: A-Z only, blanks as in WORD
        if not own:
            yield np.zeros(0, np.uint64)
            continue
        h = np.fromiter(map(known.__getitem__, own), np.uint64, len(own))
        n = min(words, len(own))
        s = np.full(len(own) - n + 1, n, np.uint64)
        for k in range(n):
            s = s * _STEP + h[k : len(own) - n + 1 + k]
        yield np.unique(mixed(s))


def _lots(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Rows whose texts are few and short enough to be worked on at once; a longer text is alone."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        low = 0
        while low < batch.num_rows:
            start = ends[low - 1] if low else 0
            high = min(max(low + 1, int(np.searchsorted(ends, start + LOT_BYTES, "right"))), low + LOT)
            yield batch.slice(low, high - low)
            low = high


def _local_counts(text: str, words: int, least: int = 2):
    """Shingles that several different sets of a lot share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in _lots(batches, text):
            new = {xxhash.xxh3_128_digest(s.tobytes()): s for s in shingle_sets(byte_column(batch, text), known, words)}
            values, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *new.values()]), return_counts=True)
            some = counts >= least
            yield pa.RecordBatch.from_arrays([pa.array(values[some].view(np.int64)), pa.array(counts[some].astype(np.int64))], names=["token", "n"])

    return run


def frequent_shingles(docs: DataFrame, text: str, words: int = WORDS) -> np.ndarray:
    """Shingles of very many documents, sorted; they only decide in which order shingles are looked at."""
    counts = docs.select(text).mapInArrow(releasing(_local_counts(text, words)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "token").limit(MOST_FREQUENT).select("token").collect()
    return np.sort(np.array([r["token"] for r in rows], np.int64).view(np.uint64))


def in_order(s: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """A set in the order that all sets share: rare shingles first, then frequent ones, each by hash; and the number of rare ones."""
    if not len(frequent):
        return s, len(s)
    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
    hot = frequent[at] == s
    return np.concatenate([s[~hot], s[hot]]), len(s) - int(hot.sum())


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Sets that are similar enough share a shingle among so many first ones."""
    return n + (-percent * n) // 100 + 1  # n - ceil(percent * n / 100) + 1


def signature(s: np.ndarray, size: int = SIGNATURE_BITS) -> np.ndarray:
    """Bitmap of a set; the first bits of a hash say which bit it sets. size: a power of two, at least 64."""
    bits = np.zeros(size, bool)
    bits[s >> np.uint64(65 - size.bit_length())] = True
    return np.packbits(bits)


def wide_signature(s: np.ndarray) -> np.ndarray:
    return signature(s, max(64, 1 << (4 * len(s)).bit_length()))


def most_common(n_a: int, a: bytes, n_b: int, b: bytes) -> int:
    """The largest overlap that two signatures allow: a common bit may stand for one common shingle, and for as many more
    as a set has shingles beyond its bits. The longer signature is folded to the length of the shorter.
    """
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        n_a, x, n_b, y = n_b, y, n_a, x
    if len(x) > len(y):
        x = np.packbits(np.unpackbits(x).reshape(8 * len(y), -1).any(axis=1))
    count = lambda v: int(np.bitwise_count(v.view(np.uint64)).sum())
    return count(x & y) + min(n_a - count(x), n_b - count(y))


def _set_key(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(s.astype("<u8").tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _described(text: str, words: int, percent: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hot = _Hashes(), frequent.value
        for batch in _lots(batches, text):
            n, rare, keys, signatures, wide, prefixes = [], [], [], [], [], [np.zeros(0, np.int64)]
            for s in shingle_sets(byte_column(batch, text), known, words):
                ordered, cold = in_order(s, hot)
                n.append(len(s)), rare.append(cold), keys.append(_set_key(s)), signatures.append(signature(s).tobytes()), wide.append(wide_signature(s).tobytes())
                prefixes.append(ordered[: prefix_length(len(s), percent) if len(s) else 0].view(np.int64))
            offsets = np.cumsum([len(p) for p in prefixes]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.drop_columns([text]).columns, pa.array(n, pa.int64()), pa.array(rare, pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(signatures, pa.binary()), pa.array(wide, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefixes)))],
                names=[*(c for c in batch.schema.names if c != text), "n", "rare", "k1", "k2", "signature", "wide", "prefix"],
            )

    return run


def needed_overlap(a, b, percent: int = PERCENT):
    """Least number of common shingles of similar sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of whole runs of equal tokens, many runs at a time."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            now = [np.concatenate([h, x]) for h, x in zip(held, now, strict=True)]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))  # tokens are sorted
        if cut:
            yield [x[:cut] for x in now]
        held = [x[cut:] for x in now]
    if held is not None and len(held[0]):
        yield held


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of shingles that several sets have in their prefixes; entries come sorted by shingle."""
    last_token, waiting = None, None  # of the batch before: its last shingle, and its last entry if that has no company yet
    for batch in batches:
        token, place, cls = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "place", "cls")]
        if not len(token):
            continue
        if waiting is not None:
            token, place, cls = [np.concatenate([[w], x]) for w, x in zip(waiting, (token, place, cls), strict=True)]
        same = token[1:] == token[:-1]
        company = np.concatenate([[waiting is None and token[0] == last_token], same]) | np.concatenate([same, [False]])
        waiting, last_token = (None if company[-1] else (token[-1], place[-1], cls[-1])), token[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(token[company]), pa.array(cls[company]), pa.array(place[company] >> 31), pa.array(place[company] & ((1 << 31) - 1))], names=["token", "cls", "n", "pos"]
        )


def _similar_leaves(n, rest, spare, part, bits, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of entries in different parts that may be similar."""
    some = part[i] != part[j]
    i, j = i[some], j[some]
    small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    need = needed_overlap(small, large, percent)
    common = np.bitwise_count(bits[i] & bits[j]).sum(axis=1).astype(np.int64) + np.minimum(spare[i], spare[j])
    some = (small * 100 >= percent * large) & (np.minimum(rest[i], rest[j]) >= need) & (common >= need)
    return i[some], j[some]


class _Tree:
    """A signature tree over the entries of a shingle: nodes hold united bitmaps, ranges of sizes, and what may still be shared."""

    def __init__(self, n, rest, spare, part, bits):
        self.n, self.rest, self.spare, self.part, self.bits = n, rest, spare, part, bits
        self.nodes: dict[tuple[int, int], tuple] = {}

    def node(self, lo: int, hi: int) -> tuple:
        if (lo, hi) not in self.nodes:
            part = self.part[lo:hi]
            self.nodes[lo, hi] = (
                int(self.n[lo]), int(self.n[hi - 1]), int(self.rest[lo:hi].max()), int(self.spare[lo:hi].max()),
                int(part[0]) if (part == part[0]).all() else None, np.bitwise_or.reduce(self.bits[lo:hi]),
            )
        return self.nodes[lo, hi]

    def pairs(self, a: tuple[int, int], b: tuple[int, int], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of entries of two nodes that may be similar and are in different parts. Entries are sorted by size."""
        low_a, high_a, rest_a, spare_a, part_a, bits_a = self.node(*a)
        low_b, high_b, rest_b, spare_b, part_b, bits_b = self.node(*b)
        if part_a is not None and part_a == part_b or high_a * 100 < percent * low_b or high_b * 100 < percent * low_a:
            return
        need = needed_overlap(low_a, low_b, percent)
        if min(rest_a, rest_b) < need or int(np.bitwise_count(bits_a & bits_b).sum()) + min(spare_a, spare_b) < need:
            return
        if a[1] - a[0] <= LEAF and b[1] - b[0] <= LEAF:
            i, j = (x.ravel() for x in np.meshgrid(np.arange(*a), np.arange(*b), indexing="ij"))
            i, j = _similar_leaves(self.n, self.rest, self.spare, self.part, self.bits, i[i < j], j[i < j], percent)
            if len(i):
                yield i, j
            return
        halves = lambda x: [x] if x[1] - x[0] <= LEAF else [(x[0], (x[0] + x[1]) // 2), ((x[0] + x[1]) // 2, x[1])]
        if a == b:
            left, right = halves(a)
            yield from self.pairs(left, left, percent)
            yield from self.pairs(left, right, percent)
            yield from self.pairs(right, right, percent)
            return
        for x in halves(a):
            for y in halves(b):
                yield from self.pairs(x, y, percent)


def _screen(percent: int):
    """Pairs that may be similar by their wide signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (a, b)
                for a, b, n_a, n_b, x, y in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "n_a", "n_b", "wide_a", "wide_b")], strict=True)
                if 100 * min(n_a, n_b) >= percent * max(n_a, n_b) and most_common(n_a, x, n_b, y) >= needed_overlap(n_a, n_b, percent)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], names=["a", "b"])

    return run


def _may_link(n_a: np.ndarray, a: list[bytes], part_a: np.ndarray, n_b: np.ndarray, b: list[bytes], part_b: np.ndarray, percent: int) -> np.ndarray:
    """Which sets of two lists are in different parts and may be similar by their sizes and wide signatures."""
    out = np.zeros((len(a), len(b)), bool)
    size_a, size_b = (np.array([len(x) for x in v], np.int64) for v in (a, b))
    count = lambda v: np.bitwise_count(np.ascontiguousarray(v).view(np.uint64)).sum(axis=1).astype(np.int64)
    for x in np.unique(size_a).tolist():
        for y in np.unique(size_b).tolist():
            i, j = np.flatnonzero(size_a == x), np.flatnonzero(size_b == y)
            alike = 100 * np.minimum.outer(n_a[i], n_b[j]) >= percent * np.maximum.outer(n_a[i], n_b[j])
            alike &= part_a[i][:, None] != part_b[j]
            if not alike.any():
                continue
            # The longer signature is folded to the length of the shorter.
            u, v = (np.frombuffer(b"".join(raws[k] for k in at.tolist()), np.uint8).reshape(len(at), -1) for raws, at in ((a, i), (b, j)))
            u, v = (w if w.shape[1] == min(x, y) else np.packbits(np.unpackbits(w, axis=1).reshape(len(w), 8 * min(x, y), -1).any(axis=2), axis=1) for w in (u, v))
            spare_u, spare_v = n_a[i] - count(u), n_b[j] - count(v)
            u = np.ascontiguousarray(u).view(np.uint64)
            v = np.ascontiguousarray(v).view(np.uint64)
            for k in np.flatnonzero(alike.any(axis=1)).tolist():
                common = np.bitwise_count(u[k] & v).sum(axis=1).astype(np.int64) + np.minimum(spare_u[k], spare_v)
                out[i[k], j] = alike[k] & (common >= needed_overlap(n_a[i[k]], n_b[j], percent))
    return out


def _asked(percent: int):
    """(block, cls, asks): sets that may be similar by the trees of the shingles that they share.

    Of a pair, one set belongs to its block, and the other one asks there if its own block is another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, new = [], 0

        def distinct():
            return pa.concat_tables(held).group_by(["block", "cls", "asks"], use_threads=False).aggregate([])

        for token, cls, n, pos, part, block, raw in _groups(batches):
            bits = np.frombuffer(b"".join(raw), np.uint64).reshape(len(token), -1)
            spare = n - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
            starts = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1, [len(token)]])
            found = []
            two = starts[:-1][np.diff(starts) == 2]  # trees of two leaves, all at once
            if len(two):
                found.append(_similar_leaves(n, n - pos, spare, part, bits, two, two + 1, percent))
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if hi - lo > 2:
                    tree = _Tree(n[lo:hi], (n - pos)[lo:hi], spare[lo:hi], part[lo:hi], bits[lo:hi])
                    found += [(i + lo, j + lo) for i, j in tree.pairs((0, hi - lo), (0, hi - lo), percent)]
            for low in range(0, len(found), 64):
                i, j = (np.concatenate(x) for x in zip(*found[low : low + 64], strict=True))
                i, j = np.where(block[i] <= block[j], i, j), np.where(block[i] <= block[j], j, i)
                of, who, asks = np.tile(block[i], 2), np.concatenate([cls[i], cls[j]]), np.concatenate([np.zeros(len(i), bool), block[i] != block[j]])
                held.append(pa.table({"block": of, "cls": who, "asks": asks}))
                new += 2 * len(i)
                if new > NAMED_AT_ONCE:
                    held, new = [distinct()], 0
                    if held[0].num_rows > NAMED:
                        yield from held[0].to_batches()
                        held = []
        if held:
            yield from distinct().to_batches()

    return run


def _sets(text: str, words: int):
    """Sets of the texts whose keys are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in _lots(batches, text):
            wanted = zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "cls")], strict=True)
            out = [(c, s.astype("<u8").tobytes()) for s, (k1, k2, c) in zip(shingle_sets(byte_column(batch, text), known, words), wanted, strict=True) if _set_key(s) == (k1, k2)]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["cls", "elements"])

    return run


class _Block:
    """Sets that others are compared with, all at once, over the shingles that they hold."""

    def __init__(self, cls: list[int], raws: list[bytes]):
        self.cls = np.array(cls, np.int64)
        self.sizes = np.array([len(r) // 8 for r in raws], np.int64)
        flat = np.frombuffer(b"".join(raws), "<u8")
        order = np.argsort(flat, kind="stable")
        self.tokens, self.owner = flat[order], np.repeat(np.arange(len(raws)), self.sizes)[order]

    def similar(self, raws: list[bytes], percent: int) -> np.ndarray:
        """Which of the other sets (rows) are similar to which of its own."""
        out = np.zeros((len(raws), len(self.cls)), bool)
        for k, raw in enumerate(raws):
            s = np.frombuffer(raw, "<u8")
            low, high = np.searchsorted(self.tokens, s, "left"), np.searchsorted(self.tokens, s, "right")
            runs = high - low
            total = int(runs.sum())
            if total:
                at = np.repeat(low - (np.cumsum(runs) - runs), runs) + np.arange(total)
                common = np.bincount(self.owner[at], minlength=len(self.cls))
                out[k] = 100 * common >= percent * (len(s) + self.sizes - common)
        return out


def _stars(mask: np.ndarray, asking: np.ndarray, own: np.ndarray) -> pa.RecordBatch | None:
    """At most one row per set that has a link: its least partner among those that links reach here."""
    rows, columns = mask.any(axis=1), mask.any(axis=0)
    if not rows.any():
        return None
    a, b = labels_of(mask[rows][:, columns], asking[rows], own[columns])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([asking[rows], own[columns]])), pa.array(np.concatenate([a, b]))], names=["cls", "root"])


def _by_block(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[list[tuple], list[tuple], bool]]:
    """The own rows of a block, and some rows that ask there, again and again; rows come sorted by block, its own first.

    The last value says whether the own rows are to be compared with each other as well, which happens once a block.
    """
    now, own, asking, size, fresh = None, [], [], 0, False
    for batch in batches:
        for *key, asks, row in zip(*[batch.column(x).to_pylist() for x in ("block", "portion", "asks")], zip(*[batch.column(c).to_pylist() for c in columns], strict=True), strict=True):
            if key != now or len(asking) == LOT or size > LOT_BYTES:
                if own and (asking or fresh):
                    yield own, asking, fresh
                asking, size, fresh = [], 0, False
            if key != now:
                now, own, fresh = key, [], key[1] == 0
            (asking if asks else own).append(row)
            size += len(row[-1]) * asks
    if own and (asking or fresh):
        yield own, asking, fresh


def _narrowed(percent: int):
    """(block, cls, asks): what is left of the questions when wide signatures are compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, asking, fresh in _by_block(batches, ("block", "cls", "n", "part", "wide")):
            block, own_cls, own_n, own_part, own_wide = (list(x) for x in zip(*own, strict=True))
            side = (np.array(own_n), own_wide, np.array(own_part))
            left = np.zeros(len(own), bool)
            if fresh:
                left |= _may_link(*side, *side, percent).any(axis=1)
            asks = []
            if asking:
                _, cls, n, part, wide = (list(x) for x in zip(*asking, strict=True))
                mask = _may_link(*side, np.array(n), wide, np.array(part), percent)
                left |= mask.any(axis=1)
                asks = np.array(cls)[mask.any(axis=0)].tolist()
            found = np.array(own_cls)[left].tolist() + asks
            yield pa.RecordBatch.from_arrays(
                [pa.array([block[0]] * len(found), pa.int64()), pa.array(found, pa.int64()), pa.array([False] * int(left.sum()) + [True] * len(asks), pa.bool_())], names=["block", "cls", "asks"]
            )

    return run


def _answers(percent: int):
    """Links inside blocks, and of the sets that ask there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, None
        for own, asking, fresh in _by_block(batches, ("cls", "elements")):
            if own is not last:
                last, block = own, _Block(*(list(x) for x in zip(*own, strict=True)))
            raws = [raw for _, raw in own]
            if fresh and len(own) > 1:
                mask = block.similar(raws, percent)
                np.fill_diagonal(mask, False)
                if (out := _stars(mask, block.cls, block.cls)) is not None:
                    yield out
            if asking:
                cls, raws = (list(x) for x in zip(*asking, strict=True))
                if (out := _stars(block.similar(raws, percent), np.array(cls, np.int64), block.cls)) is not None:
                    yield out

    return run


def _numbered_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block for each set, cut by sets and by shingles; rows come sorted by what near copies share."""
    number, sets, shingles = TaskContext.get().partitionId() << 32, 0, 0
    for batch in batches:
        blocks = []
        for n in batch.column("n").to_pylist():
            if sets and (sets == BLOCK or shingles + n > BLOCK_SHINGLES):
                number, sets, shingles = number + 1, 0, 0
            sets, shingles = sets + 1, shingles + n
            blocks.append(number)
        yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(blocks, pa.int64())], names=["cls", "block"])


class _Join:
    """The state of a join: entries of shared shingles, whole sets that were asked for, and what is connected so far."""

    def __init__(self, docs: DataFrame, groups: DataFrame, classes: DataFrame, shared: DataFrame, words: int, percent: int):
        self.docs, self.groups, self.classes, self.shared, self.words, self.percent = docs, groups, classes, shared, words, percent
        self.spark = classes.sparkSession
        self.parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.sets = self.connected = None

    def _open_entries(self) -> DataFrame:
        """Entries of the shingles whose sets are not all connected yet, with the part that each set is in."""
        if self.connected is None:
            return self.shared.withColumn("part", F.col("cls"))
        part = self.connected.select(F.col("node").alias("cls"), F.col("component").alias("part"))
        entries = stored(self.shared.join(part, "cls", "left").withColumn("part", F.coalesce("part", "cls")), "entries")
        open_ = entries.groupBy("token").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("token")
        return entries.join(open_, "token")

    def _fetch(self, requests: DataFrame) -> None:
        """Whole sets of the classes asked for, made anew from the texts, each once. Joins are alike at all sizes."""
        wanted = requests.select("cls").distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("cls"), "cls", "left_anti")
        wanted = self.groups.join(wanted, "cls").select("cls", "k1", "k2", "least").hint("merge")
        texts = self.docs.join(wanted, self.docs["id_value"].eqNullSafe(wanted["least"])).select("text_value", "cls", "k1", "k2")
        # Rows that agree in id and set give a set twice, which does no harm.
        new = stored(texts.mapInArrow(releasing(_sets("text_value", self.words)), "cls long, elements binary"), "sets")
        self.sets = new if self.sets is None else self.sets.unionByName(new)

    def _dealt(self, requests: DataFrame) -> DataFrame:
        """Requests by portion: the questions to a block are dealt to several tasks if they are many, and its own sets to each."""
        counts = requests.groupBy("block").agg(F.ceil(F.sum(F.col("asks").cast("long")) / ASKING).alias("portions"))
        sent = requests.join(counts, "block").withColumn("portions", F.greatest("portions", F.lit(1)))
        every = F.sequence(F.lit(0).cast("long"), F.col("portions") - 1)
        return sent.select("block", "asks", "cls", F.explode(F.when(F.col("asks"), F.array(F.pmod(F.xxhash64("cls"), "portions"))).otherwise(every)).alias("portion"))

    def _sorted(self, sent: DataFrame) -> DataFrame:
        return sent.repartition(self.parts, "block", "portion").sortWithinPartitions("block", "portion", "asks")

    def _links(self, requests: DataFrame) -> DataFrame:
        """Links among the own sets of each block, and of those with the sets that ask."""
        sent = self._sorted(self._dealt(requests).join(self.sets.hint("merge"), "cls"))
        return stored(sent.mapInArrow(releasing(_answers(self.percent)), "cls long, root long"), "links")

    def _ask(self, requests: DataFrame) -> None:
        def run():
            links = self._links(requests)
            if self.connected is not None:
                links = links.unionByName(self.connected.select(F.col("node").alias("cls"), F.col("component").alias("root")))
            return components(links)

        self._fetch(requests)
        self.connected = step(self.spark, run, "connected")

    def hubs(self, turn: int) -> None:
        """A set is compared with the hub that it meets most often: of each shingle's sets one is the hub, that of least hash.

        So a family mostly has one hub, and is connected in as many comparisons as it has members.
        """

        def run():
            entries = self._open_entries()
            hubs = entries.groupBy("token").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "cls").alias("mark"), "cls", "n", "part")).alias("hub"))
            alike = (F.col("part") != F.col("hub.part")) & (100 * F.least("n", "hub.n") >= self.percent * F.greatest("n", "hub.n"))
            met = entries.join(hubs, "token").where(alike).groupBy("cls", F.col("hub.cls").alias("hub")).agg(F.count(F.lit(1)).alias("times"))
            pairs = met.groupBy(F.col("cls").alias("a")).agg(F.max(F.struct("times", "hub"))["hub"].alias("b"))
            marks = self.classes.select("cls", "n", "wide")
            side = lambda s: marks.select(F.col("cls").alias(s), F.col("n").alias(f"n_{s}"), F.col("wide").alias(f"wide_{s}")).hint("merge")
            pairs = stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(releasing(_screen(self.percent)), "a long, b long"), "screened")
            own = pairs.select(F.col("b").alias("block"), F.col("b").alias("cls"), F.lit(False).alias("asks")).distinct()
            return own.unionByName(pairs.select(F.col("b").alias("block"), F.col("a").alias("cls"), F.lit(True).alias("asks")))

        self._ask(step(self.spark, run, "asked"))

    def trees(self) -> None:
        """The trees name the sets that have to be compared. Blocks hold sets that are connected already, as these have
        their partners in common. Entries of a shingle with very many are dealt into pieces, and each pair of pieces has
        its tree."""

        def run():
            entries = stored(self._open_entries(), "open")
            order = stored(entries.groupBy("cls").agg(F.first("part").alias("part"), F.first("n").alias("n")), "order")
            ranged = order.repartitionByRange(self.parts, "part", "cls").sortWithinPartitions("part", "cls")
            placed = stored(ranged.mapInArrow(releasing(_numbered_blocks), "cls long, block long"), "placed")
            marks = self.classes.select("cls", "signature").join(placed, "cls")
            pieces = entries.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / PIECE).alias("pieces"))
            other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("other")
            dealt = entries.join(pieces, "token").select("token", "cls", "n", "pos", "part", F.pmod(F.xxhash64("cls"), "pieces").alias("piece"), other)
            # A number for each tree, as a token may have several.
            tree = F.xxhash64("token", F.least("piece", "other"), F.greatest("piece", "other"))
            ordered = dealt.withColumn("tree", tree).join(marks.hint("merge"), "cls").repartition(self.parts, "tree").sortWithinPartitions("tree", "n", "cls")
            ordered = ordered.select("tree", "cls", "n", "pos", "part", "block", "signature")
            named = stored(ordered.mapInArrow(releasing(_asked(self.percent)), "block long, cls long, asks boolean").distinct(), "named")
            known = order.select("cls", "part").join(self.classes.select("cls", "n", "wide"), "cls")
            sent = self._sorted(self._dealt(named).join(known.hint("merge"), "cls"))
            return sent.mapInArrow(releasing(_narrowed(self.percent)), "block long, cls long, asks boolean").distinct()

        self._ask(step(self.spark, run, "asked"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of at least ``percent`` hundredths.

    Columns: the id, n_shingles, component_id (least id that links reach). One row per document.

    Equal sets are one class. Each class lists the first shingles of its set in an order that all share (frequent
    ones last); similar sets share a listed one. The classes of a shingle, sorted by size, form a signature tree: a
    node has the united bitmap of its sets, the range of their sizes, and the most shingles that may follow the shared
    one. Two nodes are compared only if the largest overlap that this allows is enough for their sizes, down to pairs
    of sets, which longer signatures then screen. Sets are dealt into blocks; what the trees name are the sets of a
    block and others that have to be compared with them. These meet as whole sets in one task, and each gives one
    row at most, so pairs of documents are never rows. Before that, in a few turns, each set is compared with the one
    that it shares most shingles with among those of least hash (hubs), which connects families of copies; the trees
    look only at shingles whose sets are not all connected then.

    Shingles and sets are 64- and 128-bit hashes; words are compared by hash. A null text has no words; documents
    without words link with nothing. A shorter text is one shingle. Null ids are larger than all others. Repeated rows
    are copies. Other columns are ignored. An empty table gives an empty result.
    """
    return step(docs.sparkSession, lambda: _components(docs, id_column, text_column, words, percent), "near")


def _components(docs: DataFrame, id_column: str, text_column: str, words: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_column).alias("id_value"), F.col(text_column).cast("string").alias("text_value"))
    kind = narrow.schema["id_value"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(narrow, "text_value", words))
    described = narrow.mapInArrow(releasing(_described("text_value", words, percent, frequent)), f"id_value {kind}, n long, rare long, k1 long, k2 long, signature binary, wide binary, prefix array<long>")
    described = stored(described.withColumn("cls", F.monotonically_increasing_id()), "described")
    frequent.unpersist()
    # Of rows with equal sets the first stands for all.
    groups = described.where("n > 0").groupBy("k1", "k2").agg(F.min("id_value").alias("least"), F.min("cls").alias("cls"), F.count(F.lit(1)).alias("copies"))
    groups = stored(groups, "groups")
    copied = groups.where("copies > 1").select("k1", "k2", F.col("cls").alias("of_group"))
    others = described.select("k1", "k2", "cls").join(copied, ["k1", "k2"]).where("cls != of_group").select("cls")
    classes = described.where("n > 0").join(stored(others, "copies"), "cls", "left_anti")

    # Size and position share a long, so entries sort by size within a shingle. Frequent shingles have company anyway.
    entries = classes.select(F.posexplode("prefix").alias("pos", "token"), "n", "rare", "cls")
    entries = entries.select("token", (F.shiftleft("n", 31) + F.col("pos")).alias("place"), "cls", "n", F.col("pos").cast("long").alias("pos"), "rare")
    rare = entries.where("pos < rare").select("token", "place", "cls").repartition(parts, "token").sortWithinPartitions("token", "place", "cls")
    shared = rare.mapInArrow(releasing(_shared), "token long, cls long, n long, pos long").unionByName(entries.where("pos >= rare").select("token", "cls", "n", "pos"))
    shared = stored(shared, "shared")

    join = _Join(narrow, groups, classes, shared, words, percent)
    for turn in range(TURNS):
        join.hubs(turn)
    join.trees()

    connected = join.connected
    of_class = groups.select("k1", "k2", "cls", "least").join(connected, F.col("cls") == F.col("node"), "left")
    of_class = stored(of_class.select("k1", "k2", "least", F.coalesce("component", "cls").alias("component")), "of-class")
    lowest = of_class.groupBy("component").agg(F.min("least").alias("lowest"))
    named = stored(of_class.join(lowest, "component").select("k1", "k2", "lowest"), "named")
    out = described.select("id_value", "n", "k1", "k2").join(named, ["k1", "k2"], "left")
    return out.select(
        F.col("id_value").alias(id_column), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("id_value")).alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT, in_files: bool = False) -> DataFrame:
    """One document of each component stays: the one with the least id, the first of equal ids; null ids come last."""
    rows, row = identified(docs, in_files)
    key = rows.select(F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.col(row).alias("row")).alias("key"), F.col(text_column).alias("text_value"))
    groups = near_duplicates(key, "key", "text_value", words, percent)
    dropped = groups.where(F.col("key.row") != F.col("component_id.row")).select(F.col("key.row").alias(row))
    return rows.join(stored(dropped, "dropped"), row, "left_anti").select(*docs.columns)
