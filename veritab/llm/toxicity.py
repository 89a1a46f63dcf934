"""Toxicity scores by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import byte_column

#: The bounded sample that the model is fitted on: rows of each label; documents of it that a term is in at least.
TRAIN_ROWS, LEAST_DOCS = 8000, 3
#: Standard errors that a term's share differs by between the labels from which on it decays no faster than others, and
#: how many times as fast the weight, and at most the factors, of a term decay that does not differ.
LEAST_ERRORS, SHRINK_WEIGHT, SHRINK_FACTORS = 4.0, 3e4, 1e4
#: Hash space of terms, letters of a beginning, factors of a term, and where a score counts as toxic.
TERM_BITS, BEGINNING, FACTORS, THRESHOLD = 20, 4, 6, 0.7
REMEMBERED = 1_000_000


class _Terms(dict):
    """Hashed terms of a word: the word in lower case without marks around it, and its beginning; -1: none."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        text = word.decode("utf-8", "replace").lower()
        lo, hi = 0, len(text)
        while lo < hi and not text[lo].isalnum():
            lo += 1
        while hi > lo and not text[hi - 1].isalnum():
            hi -= 1
        text, mask = text[lo:hi], (1 << TERM_BITS) - 1
        one = xxhash.xxh3_64_intdigest(text.encode()) & mask if text else -1
        two = xxhash.xxh3_64_intdigest(b"^" + text[:BEGINNING].encode()) & mask if len(text) > BEGINNING else -1
        self[word] = out = (one, two)
        return out


def terms_of(text: bytes, known: _Terms) -> np.ndarray:
    """The distinct hashed terms of a text, sorted."""
    if len(known) > REMEMBERED:
        known.clear()
    words = set(text.split())
    terms = {t for pair in map(known.__getitem__, words) for t in pair}
    terms.discard(-1)
    return np.array(sorted(terms), np.int32)


@dataclass
class FactorizationMachine:
    """score = sigmoid(bias + sum of weights + sum over pairs of terms of the product of their factors)."""

    bias: float = 0.0
    place: np.ndarray = field(default_factory=lambda: np.full(1 << TERM_BITS, -1, np.int32))  # of a term in the model, or -1
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS)))

    def places(self, terms: np.ndarray) -> np.ndarray:
        at = self.place[terms]
        return at[at >= 0]

    def margin(self, terms: np.ndarray) -> float:
        at = self.places(terms)
        if not len(at):
            return self.bias
        v = self.factors[at]
        return float(self.bias + self.weights[at].sum() + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v * v).sum()))

    def score(self, terms: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(terms), -30, 30))))


def known_terms(docs: list[np.ndarray]) -> np.ndarray:
    """Terms of ``LEAST_DOCS`` documents at least. How they differ between the labels does not matter: a term may count
    only beside another one, and then be as frequent under either label; decay shrinks those that tell nothing."""
    return np.flatnonzero(np.bincount(np.concatenate([np.zeros(0, np.int32), *docs]), minlength=1 << TERM_BITS) >= LEAST_DOCS)


def shrinkage(docs: list[np.ndarray], labels: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """How many times as fast each term decays: the less its share differs between the labels, in standard errors, the
    faster, so that terms which tell nothing stay small. None is left out."""
    flat = np.concatenate([np.zeros(0, np.int32), *docs])
    of = np.repeat(labels, [len(d) for d in docs])
    hit, miss = (np.bincount(flat[of == y], minlength=1 << TERM_BITS)[terms] for y in (1, 0))
    n_hit, n_miss = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    share = (hit + miss) / (n_hit + n_miss)
    z = np.abs(hit / n_hit - miss / n_miss) / np.sqrt(share * (1 - share) * (1 / n_hit + 1 / n_miss) + 1e-9)
    return SHRINK_WEIGHT ** (1 - np.minimum(z / LEAST_ERRORS, 1) ** 3)


def fit(docs: list[np.ndarray], labels: np.ndarray, rate: float, rounds: int = 30, lot: int = 128, step: float = 0.2, decay: float = 1e-4, seed: int = 7) -> FactorizationMachine:
    """Logistic loss, steps that shrink as gradients add up. rate: share of label 1 among all rows, which sets the bias.

    Without rows the score is one half; with rows of one label only it is their label's rate, kept off 0 and 1.
    """
    labels = np.asarray(labels, np.int64)
    model = FactorizationMachine()
    if not len(labels):
        return model
    model.bias = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    if labels.min() == labels.max():
        return model
    terms = known_terms(docs)
    model.place[terms] = np.arange(len(terms))
    rows = [model.places(d) for d in docs]
    shrink = shrinkage(docs, labels, terms)
    decay_w, decay_v = decay * shrink, decay * np.clip(shrink, 10, SHRINK_FACTORS)[:, None]
    random = np.random.default_rng(seed)
    w, v = np.zeros(len(terms)), random.normal(0, 0.02, (len(terms), FACTORS))
    sum_w, sum_v = np.full(len(terms), 1e-2), np.full((len(terms), FACTORS), 1e-2)
    # Both labels weigh the same, so a score says how the text bears on the label, not how rare the label is.
    share = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    model.bias = sum_b = 0.0
    for _ in range(rounds):
        order = random.permutation(len(rows))
        for low in range(0, len(order), lot):
            own = order[low : low + lot]
            n = np.array([len(rows[i]) for i in own])
            own, n = own[n > 0], n[n > 0]
            if not len(own):
                continue
            at = np.concatenate([rows[i] for i in own])
            starts, of = np.cumsum(n) - n, np.repeat(np.arange(len(own)), n)
            va = v[at]
            s = np.add.reduceat(va, starts)
            margin = model.bias + np.add.reduceat(w[at], starts) + 0.5 * ((s * s).sum(1) - np.add.reduceat((va * va).sum(1), starts))
            each = share[own] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[own])
            g = each[of]
            sum_b += each.sum() ** 2
            model.bias -= step * 0.1 * each.sum() / np.sqrt(sum_b + 1)
            grad_w = np.bincount(at, g, len(terms)) + decay_w * w
            grad_v = np.stack([np.bincount(at, x, len(terms)) for x in (g[:, None] * (s[of] - va)).T], axis=1)
            grad_v += decay_v * v
            sum_w += grad_w * grad_w
            sum_v += grad_v * grad_v
            w -= step * grad_w / np.sqrt(sum_w)
            v -= step * 0.1 * grad_v / np.sqrt(sum_v)
    model.weights, model.factors = w, v
    return model


def held_out(id_column: str) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 1 when divided by 3. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", most: int = TRAIN_ROWS) -> FactorizationMachine:
    """Fit on at most about ``most`` rows of each label, chosen by a hash of the id, of those that are not held out.

    Of several labels of an id the largest counts; null labels are left out. The sample of ids is bounded, so it is
    sent to all tasks, and texts are not shuffled; only hashed terms of sampled texts reach the driver.
    """
    known = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull()).groupBy(F.col(id_column).alias("label_id")).agg(F.max(label_column).cast("int").alias("y"))
    known = known.where(~held_out("label_id"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        return fit([], np.zeros(0), 0.5)
    keep = F.lit(False)
    for y, n in counts.items():
        keep = keep | ((F.col("y") == y) & (F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < int(min(1.0, most / n) * (1 << 30))))
    sample = known.where(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Terms()
        for batch in batches:
            found = [terms_of(t, cache).tobytes() for t in byte_column(batch, "text_value")]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.binary())], names=["y", "terms"])

    texts = docs.select(F.col(id_column).alias("id_value"), F.col(text_column).cast("string").alias("text_value"))
    rows = texts.join(F.broadcast(sample), F.col("id_value") == F.col("label_id")).select("y", "text_value").mapInArrow(run, "y int, terms binary").distinct().collect()
    rows.sort(key=lambda r: (r["terms"], r["y"]))
    return fit([np.frombuffer(r["terms"], np.int32) for r in rows], np.array([r["y"] for r in rows], np.int64), counts.get(1, 0) / total)


def score(docs: DataFrame, model: FactorizationMachine, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns: the id, held_out, score, predicted, one row per document. Null texts count as empty and get the bias.

    Only the text goes into a score. Texts of any length are scored as a whole, row by row; further columns are
    ignored, ids may be null or repeat, and an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(F.col(id_column).alias("id_value"), held_out(id_column).alias("held_out"), F.col(text_column).cast("string").alias("text_value"))
    kind = narrow.schema["id_value"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, fitted = _Terms(), shared.value
        for batch in batches:
            scores = [fitted.score(terms_of(t, cache)) for t in byte_column(batch, "text_value")]
            yield pa.RecordBatch.from_arrays([batch.column("id_value"), batch.column("held_out"), pa.array(scores, pa.float64())], names=["id_value", "held_out", "score"])

    out = narrow.mapInArrow(run, f"id_value {kind}, held_out boolean, score double")
    return out.select(F.col("id_value").alias(id_column), "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
