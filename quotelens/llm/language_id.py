"""Language identification by Bayesian fusion of text, declared language, address suffix and host.

The posterior of a language is proportional to

    P(text | language)^TEMPER * P(declared | language) * P(suffix | language) * P(language | host)

Text likelihoods come from byte trigrams. The other terms are estimated from the corpus
itself: every row adds its posterior by text alone to the counts of its (host, declared,
suffix), and sums of that one grouped table give the rest. A host's distribution is
shrunk to its domain's and that to the whole corpus', so a host with few rows says little.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelens.llm.common import give_back, in_slices, stored
from quotelens.llm.tokenizing import forget

UNKNOWN = "und"
CELLS = 1 << 15
#: Labelled rows the trigram model is fitted on, about, in equal parts by label; every row of a label that has fewer.
TRAINING_ROWS = 20_000
#: A label is a language of the model if it marks at least so many rows and is among the most frequent ones. Rows that
#: declare another label are accepted as what they declare.
LEAST_ROWS = 20
LANGUAGES = 100
#: Labelled rows are sampled by a hash of so many values.
HASH_VALUES = 1 << 53
#: Codes that stand for no one language.
NO_LANGUAGE = ("und", "mis", "mul", "zxx")
SMOOTHING = 0.5
#: Neighbouring trigrams overlap, so each counts for a part.
TEMPER = 0.3
#: Rows that a domain's (or the corpus') distribution weighs at a host (or a domain).
SHRINK = 20.0
#: Prior share of rows in no language of the model.
UNKNOWN_SHARE = 0.001
#: A language less certain than this is not accepted.
LEAST_CONFIDENCE = 0.5
#: Combinations of host, declared language and suffix that may go to every task.
BROADCAST_ROWS = 100_000

EVIDENCE = "__language_likelihood"

#: Letters in lower case; anything else ASCII is a space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def cells(text: bytes):
    """Cell of each trigram of letters and single spaces."""
    import numpy as np

    data = np.frombuffer(b" ".join((b" " + text.translate(LETTERS) + b" ").split()), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.uint32)
    code = data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77) + data[2:] * np.uint32(0xC2B2AE3D)
    return (code ^ (code >> np.uint32(15))) >> np.uint32(17)


@dataclass(frozen=True)
class TrigramModel:
    """Languages in order, UNKNOWN last, and log probabilities by cell and language."""

    languages: tuple[str, ...]
    table: object

    @property
    def classes(self) -> tuple[str, ...]:
        return (*self.languages, UNKNOWN)


def primary(code: Column) -> Column:
    """The primary subtag of a language code, `-` where it names no language: at most 27^3 values."""
    found = F.regexp_extract(F.lower(F.coalesce(code, F.lit(""))), "^([a-z]{2,3})(?:$|[-_])", 1)
    return F.when(found.isin("", *NO_LANGUAGE), F.lit("-")).otherwise(found)


def sampled_parts(sizes: dict[str, int], rows: int) -> dict[str, float]:
    """Which part of each label's rows makes about `rows` in all, in equal numbers as far as labels have them."""
    parts = {}
    for i, (label, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        take = min(n, rows / (len(sizes) - i))
        parts[label], rows = take / n, rows - take
    return parts


def fit(docs: DataFrame, key: str, text: str, label: str) -> TrigramModel:
    """A model of the labels, from a sample by the hash of key and text, in which rare labels have their share."""
    import numpy as np
    import pyarrow as pa

    rows = docs.where(F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), primary(F.col(label)).alias("label")
    ).where("label != '-'")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # at most 27^3
    frequent = sorted((x for x, n in sizes.items() if n >= LEAST_ROWS), key=lambda x: (-sizes[x], x))[:LANGUAGES]
    languages = tuple(sorted(frequent))
    index = {x: i for i, x in enumerate(languages)}
    hashed = F.pmod(F.xxhash64("key", "text"), F.lit(HASH_VALUES))
    chosen = F.lit(False)
    for label, part in sampled_parts({x: sizes[x] for x in languages}, TRAINING_ROWS).items():
        chosen = chosen | ((F.col("label") == label) & (hashed < math.ceil(part * HASH_VALUES)))
    sample = rows.where(chosen)

    def run(batches):
        counts = np.zeros((CELLS, len(index)), np.int64)
        for batch in batches:
            for data, name in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("label").to_pylist()):
                counts[:, index[name]] += np.bincount(cells(data), minlength=CELLS)
        at, language = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(language), pa.array(counts[at, language])], names=["cell", "language", "n"])

    counts = np.zeros((CELLS, len(languages)))
    if languages:
        found = sample.select("text", "label").mapInArrow(run, "cell long, language long, n long")
        for r in found.groupBy("cell", "language").agg(F.sum("n").alias("n")).collect():  # at most CELLS x 100
            counts[r["cell"], r["language"]] = r["n"]
    likely = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * CELLS))
    table = np.concatenate((likely, np.full((CELLS, 1), -math.log(CELLS))), axis=1)
    return TrigramModel(languages, table.astype(np.float32))


def log_likelihoods(model: TrigramModel, column):
    """A row of tempered log likelihoods for each text; null and texts without letters say nothing."""
    import numpy as np
    import pyarrow as pa

    out = np.zeros((len(column), len(model.classes)))
    for i, data in enumerate(column.cast(pa.binary()).to_pylist()):
        at = cells(data or b"")
        for j in range(0, len(at), 1 << 20):
            out[i] += model.table[at[j : j + (1 << 20)]].sum(axis=0, dtype=np.float64)
    return TEMPER * out


def with_likelihoods(docs: DataFrame, text: str, model: TrigramModel) -> DataFrame:
    """Adds the column EVIDENCE, an array by class."""
    import pyarrow as pa

    schema = T.StructType([*docs.schema.fields, T.StructField(EVIDENCE, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in in_slices(batches, text):
            found = log_likelihoods(model, batch.column(batch.schema.get_field_index(text)))
            ends = pa.array(range(0, found.size + 1, found.shape[1]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(found.reshape(-1), pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, EVIDENCE])
        give_back()

    return docs.mapInArrow(run, schema)


def evidence_table(rows: DataFrame, model: TrigramModel) -> DataFrame:
    """(host, declared, suffix, other): log of all terms but the text's, as an array by class; stored.

    `rows` has host, domain, declared, suffix and EVIDENCE. Rows without text add nothing to the counts.
    """
    k = len(model.classes)
    names = [f"p{i}" for i in range(k)]
    own = ["host", "domain", "declared", "suffix"]
    # Likelihoods relative to the highest, then divided by their sum: the posterior by text alone.
    says = F.exists(EVIDENCE, lambda x: x != 0)
    relative = rows.select(*own, says.alias("says"), EVIDENCE, F.array_max(EVIDENCE).alias("top")).select(
        *own, "says", F.transform(EVIDENCE, lambda x: F.exp(x - F.col("top"))).alias("parts")
    ).withColumn("whole", F.aggregate("parts", F.lit(0.0), lambda sum, x: sum + x))
    posterior = [
        F.when(F.col("says"), F.element_at("parts", i + 1) / F.col("whole")).otherwise(0.0).alias(c) for i, c in enumerate(names)
    ]
    # Sums of doubles depend on their order in the last digits; rounded, they do not.
    counted = stored(
        relative.select(*own, *posterior).groupBy(own).agg(*[F.round(F.sum(c), 4).alias(c) for c in names]), "languages"
    )

    def sums(by: list[str], mark: str) -> DataFrame:
        found = counted.groupBy(by).agg(*[F.sum(c).alias(f"{mark}{i}") for i, c in enumerate(names)])
        return found.withColumn(f"{mark}_all", sum((F.col(f"{mark}{i}") for i in range(1, k)), F.col(f"{mark}0")))

    total = counted.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in names]).first()
    shares = [(t + 1.0) / (sum(total) + k) for t in total]
    shares = [s * (1 - UNKNOWN_SHARE) / sum(shares[:-1]) for s in shares[:-1]] + [UNKNOWN_SHARE] if k > 1 else [1.0]
    n_declared, n_suffix = counted.agg(F.count_distinct("declared"), F.count_distinct("suffix")).first()
    every = counted.select(own).join(sums(["domain", "host"], "h"), ["domain", "host"]).join(sums(["domain"], "d"), ["domain"])
    every = every.join(sums(["declared"], "l"), "declared").join(sums(["suffix"], "s"), "suffix")

    terms = []
    for i in range(k):
        domain = (F.col(f"d{i}") + SHRINK * shares[i]) / (F.col("d_all") + SHRINK)
        host = (F.col(f"h{i}") + SHRINK * domain) / (F.col("h_all") + SHRINK)
        declared = (F.col(f"l{i}") + 1) / (total[i] + n_declared)
        suffix = (F.col(f"s{i}") + 1) / (total[i] + n_suffix)
        terms.append(
            F.log(host)
            + F.when(F.col("declared") != "-", F.log(declared)).otherwise(0.0)
            + F.when(F.col("suffix") != "-", F.log(suffix)).otherwise(0.0)
        )
    return stored(every.select("host", "domain", "declared", "suffix", F.array(*terms).alias("other")), "evidence")


def host_parts(host: Column) -> dict[str, Column]:
    """host, its domain (the last two labels) and suffix (the last); `-` for what it lacks."""
    name = F.lower(F.coalesce(host, F.lit("-")))
    labels = F.split(name, r"\.")
    dotted = F.size(labels) > 1
    return {
        "host": name,
        "domain": F.when(dotted, F.concat_ws(".", F.slice(labels, -2, 2))).otherwise(name),
        "suffix": F.when(dotted, F.element_at(labels, -1)).otherwise(F.lit("-")),
    }


def identify(docs: DataFrame, text: str, declared: Column, host: Column, model: TrigramModel) -> DataFrame:
    """Adds __language, __confidence and __accepted to the rows; other columns stay.

    A text that is null or has no letters leaves the decision to the other terms, but
    is only accepted if a language was declared. The first of equally likely languages
    counts. A row that declares a language the model does not have is accepted as that
    language, with no confidence. The other terms reach a row by a join on (host,
    declared, suffix), which goes to every task while it has at most BROADCAST_ROWS rows;
    beyond that the rows move with their texts.
    """
    inputs = docs.columns
    parts = {f"__{k}": v for k, v in (host_parts(host) | {"declared": primary(declared)}).items()}
    scored = with_likelihoods(docs.withColumns(parts), text, model)
    plain = docs.select(F.col(text).alias("text"), *[v.alias(k.removeprefix("__")) for k, v in parts.items()])
    other = evidence_table(with_likelihoods(plain, "text", model), model)
    if other.count() <= BROADCAST_ROWS:
        other = F.broadcast(other)
    keys = [f"__{c}" for c in ("host", "domain", "declared", "suffix")]
    joined = scored.join(other.toDF(*keys, "__other"), keys)
    out = joined.withColumn("__scores", F.zip_with(EVIDENCE, "__other", lambda a, b: a + b))
    out = out.withColumn("__top", F.array_max("__scores"))
    # The highest score names the language (the first one of a tie), and its share of all is the confidence.
    whole = F.aggregate("__scores", F.lit(0.0), lambda sum, x: sum + F.exp(x - F.col("__top")))
    named = F.element_at(F.array(*map(F.lit, model.classes)), F.array_position("__scores", F.col("__top")).cast("int"))
    unmodelled = (F.col("__declared") != "-") & ~F.col("__declared").isin(*model.languages)
    out = out.withColumns({
        "__language": F.when(unmodelled, F.col("__declared")).otherwise(named),
        "__confidence": F.when(~unmodelled, 1 / whole),
    })
    says = F.exists(EVIDENCE, lambda x: x != 0) | (F.col("__declared") != "-")
    accepted = says & (F.col("__language") != UNKNOWN) & (F.col("__confidence") >= LEAST_CONFIDENCE)
    return out.withColumn("__accepted", unmodelled | accepted).select(*inputs, "__language", "__confidence", "__accepted")


HTML_LANGUAGE = r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]{2,3}(?:[-_][a-z0-9]+)*)"
NOT_TEXT = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


def page_rows(pages: DataFrame) -> DataFrame:
    """page_id, visible text, declared language and host of raw pages."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            texts = [None if h is None else NOT_TEXT.sub(" ", h) for h in batch.column("html").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("html"), "html", pa.array(texts, pa.string()))

    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.when(host != "", host).alias("host"),
        F.regexp_extract(F.coalesce("html", F.lit("")), HTML_LANGUAGE, 1).alias("declared"), "html",
    )
    return rows.mapInArrow(run, rows.schema).withColumnRenamed("html", "text")


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """All documents and all pages. A document's source is its host and `lang` what it declares; doc_id or page_id is null."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    pages = page_rows(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    model = fit(docs, "doc_id", "text", "lang")
    found = identify(docs, "text", F.col("lang"), F.col("source"), model).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), F.col("lang").alias("declared"),
        "__language", "__confidence", "__accepted",
    )
    in_pages = identify(pages, "text", F.col("declared"), F.col("host"), model).select(
        F.lit(None).cast("long").alias("doc_id"), "page_id", "declared", "__language", "__confidence", "__accepted"
    )
    columns = {"__language": "language", "__confidence": "confidence", "__accepted": "accepted"}
    return found.union(in_pages).withColumnsRenamed(columns)
