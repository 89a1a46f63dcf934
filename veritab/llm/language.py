"""Language identification by fusing evidence from text, declared language, address suffix and host."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import byte_column, free_name, identified, releasing, step, stored

#: Distinct texts of each language that likelihoods are fitted on, about so many at most; hash space of character trigrams.
TRAIN_ROWS, GRAM_BITS = 20_000, 15
#: Trigrams of a text overlap: each counts as a third. Share of odd trigrams (names, numbers, code) in any language's text.
#: Weight of the level above in a host's prior; of the uniform in a table.
TEMPER, ODD, HOST_WEIGHT, TABLE_WEIGHT = 1 / 3, 0.25, 8.0, 1.0
#: Text that is no known language, and where a posterior is enough.
UNKNOWN, CONFIDENT = "und", 0.5


@dataclass
class TextModel:
    """Languages, the unknown one last, and log likelihoods of trigram buckets by language."""

    languages: list[str]
    table: np.ndarray


def _buckets(text: bytes) -> np.ndarray:
    """Hash buckets of the byte trigrams that hold a letter or a byte beyond ASCII, of the text in lower case."""
    b = np.frombuffer(text.lower(), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    h = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    letter = ((b >= 97) & (b <= 122)) | (b >= 128)
    h = h[letter[:-2] | letter[1:-1] | letter[2:]]
    return ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)).astype(np.int64)


def _counts(text: str, label: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, t in zip(batch.column(batch.schema.get_field_index(label)).to_pylist(), byte_column(batch, text), strict=True):
                sums[lang] = sums.get(lang, 0) + np.bincount(_buckets(b" " + t + b" "), minlength=1 << GRAM_BITS)
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(s[at], pa.int64())], names=["lang", "bucket", "n"])

    return run


def training_texts(docs: DataFrame, text_column: str, label_column: str, most: int) -> tuple[list[str], DataFrame]:
    """Languages that texts with letters are declared to be in, and about ``most`` distinct texts of each (lang, text_value).

    Distinct texts are counted for each language over the whole table, by hash, so texts are not shuffled for it. A
    language with more than ``most`` has its share chosen by hash, at least one; of the others all texts are taken.
    Rows without a declared language, or declared unknown, are left out.
    """
    lang = F.lower(F.col(label_column).cast("string"))
    narrow = docs.select(F.col(text_column).cast("string").alias("text_value"), lang.alias("lang")).where(F.col("lang") != UNKNOWN)
    narrow = narrow.where(F.col("text_value").rlike(r"[A-Za-z]|[^\x00-\x7F]"))  # others have no trigram that counts
    place = F.pmod(F.xxhash64("text_value"), F.lit(1 << 30))
    each = narrow.select("lang", F.xxhash64("text_value").alias("hash"), place.alias("place")).distinct()
    counts = each.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least")).collect()
    ends = [x for r in counts for x in (F.lit(r["lang"]), F.lit(max(int(min(1.0, most / r["n"]) * (1 << 30)), r["least"] + 1)))]
    chosen = narrow.where(place < F.create_map(*ends)[F.col("lang")]) if ends else narrow.limit(0)
    return sorted(r["lang"] for r in counts), chosen.distinct()


def fit_text_model(docs: DataFrame, text_column: str = "text", label_column: str = "lang", most: int = TRAIN_ROWS) -> TextModel:
    """Trigram likelihoods of each declared language from about ``most`` distinct texts of it, chosen by a hash of the
    text; of a language with fewer from all of them.

    A language's text may hold some odd trigrams, which cost it little against the unknown language; that one spreads
    evenly over all buckets. What reaches the driver is a table of fixed size per language.
    """
    languages, part = training_texts(docs, text_column, label_column, most)
    rows = part.mapInArrow(releasing(_counts("text_value", "lang")), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((len(languages) + 1, 1 << GRAM_BITS))
    for r in rows:
        counts[languages.index(r["lang"]), r["bucket"]] += r["n"]
    counts[-1] = 1
    shares = (1 - ODD) * counts / np.maximum(counts.sum(axis=1, keepdims=True), 1) + ODD / (1 << GRAM_BITS)
    return TextModel([*languages, UNKNOWN], np.log(shares / shares.sum(axis=1, keepdims=True)).T.astype(np.float32).copy())


def _likelihoods(text: str, model):
    """Tempered log likelihoods of each text, whether it has letters, and its posterior under equal priors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value.table
        for batch in batches:
            logs, shares, letters = [], [], []
            for t in byte_column(batch, text):
                own, low = np.zeros(table.shape[1]), 0
                t = b" " + t + b" "  # so that a short word has trigrams too
                while low < len(t):  # in pieces, as a text may be very long; two bytes are shared
                    at = _buckets(t[max(low - 2, 0) : low + (1 << 20)])
                    own += table[at].sum(axis=0, dtype=np.float64)
                    low += 1 << 20
                letters.append(bool(own.any()))
                own = TEMPER * own
                own -= own.max()
                p = np.exp(own)
                logs.append(own.tolist()), shares.append((p / p.sum()).tolist())
            rest = batch.drop_columns([text])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(logs, pa.list_(pa.float64())), pa.array(shares, pa.list_(pa.float64())), pa.array(letters, pa.bool_())],
                names=[*rest.schema.names, "text_log", "share", "letters"],
            )

    return run


def _sums(df: DataFrame, keys: list[str], n: int, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.array(*[F.sum(F.col("share")[i]) for i in range(n)]).alias(out))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _smoothed(counts: Column, above: Column, weight: float) -> Column:
    """Shares from counts, pulled towards the level above."""
    return F.zip_with(counts, above, lambda c, a: (c + weight * a) / (_total(counts) + weight))


def identify(rows: DataFrame, model: TextModel, text: str, declared: str | None, suffix: str | None, hosts: list[str]) -> DataFrame:
    """Language, confidence and text_language of each row; ``letters`` says whether its text has any.

    ``hosts`` names levels from the widest to the narrowest (domain, host). Text likelihoods under equal priors are
    added up by host, domain, declared language and suffix. A host's prior is its own share of languages, pulled
    towards its domain's, which is pulled towards that of all rows; a row's own share is taken out first, so no row
    is evidence for itself. Declared language and suffix count by how often they come with each language. The log of
    all of them is added and normed.

    Null texts count as empty and have no text evidence. A null declared language, suffix or host counts as one more
    value. Sums are aggregated before they are shuffled and joined as tables, so a host may have any part of the rows.
    """
    n = len(model.languages)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    known = rows.withColumn("text_value", F.col(text).cast("string"))
    levels = [f"level{i}" for i in range(len(hosts))]
    tables = [c for c in (declared, suffix) if c]
    values = [f"value{i}" for i in range(len(tables))]
    keep = [c for c in rows.columns if c not in (text, *hosts, *tables)]
    known = known.select(*keep, "text_value", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(x) for c, x in zip([*hosts, *tables], [*levels, *values], strict=True)])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in known.schema if f.name != "text_value")
    out = stored(known.mapInArrow(releasing(_likelihoods("text_value", shared)), f"{schema}, text_log array<double>, share array<double>, letters boolean"), "likelihoods")

    told = out.where("letters")  # rows without text evidence are no evidence for others
    overall = [float(x or 0) for x in _sums(told, [], n, "s").first()["s"]]
    everywhere = F.array(*[F.lit((x + TABLE_WEIGHT) / (sum(overall) + n * TABLE_WEIGHT)) for x in overall])
    own = F.when(F.col("letters"), F.col("share")).otherwise(F.array_repeat(F.lit(0.0), n))
    none = F.array_repeat(F.lit(0.0), n)
    prior = everywhere
    for i, level in enumerate(levels):
        # The narrower level is within the wider one.
        sums = stored(_sums(told, [level], n, f"sum_{level}"), "host-sums")
        out = out.join(sums.withColumnRenamed(level, "of_level"), F.col(level) == F.col("of_level"), "left").drop("of_level")
        others = F.zip_with(F.coalesce(f"sum_{level}", none), own, lambda s, p: F.greatest(s - p, F.lit(0.0)))
        out = out.withColumn(f"prior{i}", _smoothed(others, prior, HOST_WEIGHT))
        prior = F.col(f"prior{i}")
    score = F.zip_with("text_log", prior, lambda t, p: t + F.log(p))
    for i, value in enumerate(values):
        sums = stored(_sums(told, [value], n, f"sum_{value}"), "value-sums")
        kinds = sums.count()
        out = out.join(sums.withColumnRenamed(value, "of_value"), F.col(value) == F.col("of_value"), "left").drop("of_value")
        others = F.zip_with(F.coalesce(f"sum_{value}", none), own, lambda s, p: F.greatest(s - p, F.lit(0.0)))
        whole = F.array(*[F.lit(x + TABLE_WEIGHT * max(kinds, 1)) for x in overall])
        out = out.withColumn(f"like{i}", F.zip_with(others, whole, lambda s, w: F.log((s + TABLE_WEIGHT) / w)))
        score = F.zip_with(score, F.col(f"like{i}"), lambda a, b: a + b)
    out = out.withColumn("score", score)
    out = out.withColumn("weight", F.transform("score", lambda x: F.exp(x - F.array_max("score"))))
    names = F.array(*[F.lit(x) for x in model.languages])
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return out.select(
        *keep,
        best(F.col("score")).alias("language"),
        (F.lit(1.0) / _total(F.col("weight"))).alias("confidence"),
        F.when(F.col("letters"), best(F.col("text_log"))).alias("text_language"),
        "letters",
    )


def page_evidence(pages: DataFrame) -> DataFrame:
    """Text, declared language, address suffix, domain and host of pages. Nulls give empty texts and null evidence."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    tag = F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1))
    text = F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>", " ")
    labels = F.split(host, r"\.")
    return pages.select(
        "page_id",
        text.alias("text"),
        F.nullif(tag, F.lit("")).alias("declared"),
        F.nullif(F.element_at(labels, -1), F.lit("")).alias("suffix"),
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("domain"),
        host.alias("host"),
    )


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """page_id, language, confidence, text_language and accepted for each page. Pages without text are not accepted."""
    out = identify(page_evidence(pages), model, "text", "declared", "suffix", ["domain", "host"])
    return out.select("page_id", "language", "confidence", "text_language", _accepted().alias("accepted"))


def _accepted() -> Column:
    return F.col("letters") & (F.col("language") != UNKNOWN) & (F.col("confidence") >= CONFIDENT)


def keep_known_languages(docs: DataFrame, model: TextModel, text_column: str = "text", declared_column: str = "lang", host_column: str = "source", in_files: bool = False) -> DataFrame:
    """Documents whose language is known and sure enough; the others are rejected: texts without letters, texts that are
    like no language, and ties. The source stands for the host. All columns stay as they are."""
    rows, row = identified(docs, in_files)
    names = ["text", "declared", "host"]
    key = free_name(rows.select(row), "key")
    evidence = rows.select(F.col(row).alias(key), *[F.col(c).alias(n) for c, n in zip((text_column, declared_column, host_column), names, strict=True)])
    found = lambda: identify(evidence, model, "text", "declared", None, ["host"]).where(~_accepted()).select(F.col(key).alias(row))
    return rows.join(step(docs.sparkSession, found, "rejected"), row, "left_anti").select(*docs.columns)
