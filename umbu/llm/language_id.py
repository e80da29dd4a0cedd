"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the likelihood of the text, of the declared
(markup) language, and of the address suffix, and a prior of the host.

* Text: naive Bayes over hashed byte trigrams, whose counts are summed over all
  texts of a declared language. The languages are those declared by rows with enough
  text to learn from, also a grouped sum. One more class, ``und``, gives every
  trigram the same chance; it takes what is no language the model knows.
* Declared language and suffix: how often each value goes with each language,
  measured by grouped sums of the text's posterior over the whole table.
* Host: its share of each language, smoothed towards its suffix's, which is
  smoothed towards the table's.

A declaration is thus believed as far as it agrees with texts elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.llm.tables import COUNTED, counted, if_small, keep, only, summed, table, text_hash
from umbu.llm.words import LOWER, pieces

# A declared language is learned if so many rows with text declare it and hold so many
# characters, and not more languages than this, those of most text: a model has 256 kB
# for each.
MIN_ROWS, MIN_CHARS, MOST_LANGUAGES = 10, 2000, 256
UNKNOWN = "und"
# Codes that say that a text is of no one language.
NO_LANGUAGE = ("mis", "mul", "und", "zxx")
TRIGRAM_BITS = 16
# Trigrams overlap, so each counts as a third of an independent observation.
TEMPER = 1 / 3
# Imaginary observations of the level above: in a host, and in a suffix.
HOST_WEIGHT, SUFFIX_WEIGHT, VALUE_WEIGHT = 10.0, 10.0, 5.0
MIN_POSTERIOR = 0.5
# Share of rows taken to be no known language before any evidence.
UNKNOWN_SHARE = 0.01

_ODD = np.uint32(0x9E3779B1)


def _trigrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of each text and where each text's begin.

    White space is a blank, A-Z is a-z, digits and ASCII marks are left out, and a
    text has a blank on either side, so even one letter is a trigram.
    """
    low = LOWER[data]
    letter = ((low >= 97) & (low <= 122)) | (low >= 128)
    blank = (low == 32) | ((low >= 9) & (low <= 13))
    used = letter | blank
    total = np.append(0, np.cumsum(used))[bounds]
    n = np.diff(total)
    out = np.full(total[-1] + 2 * len(n), 32, dtype=np.uint32)
    at = total[:-1] + 2 * np.arange(len(n))
    place = np.ones(len(out), dtype=bool)
    place[at] = False
    place[at + n + 1] = False
    out[place] = np.where(letter, low, 32)[used]
    triple = out[:-2] << np.uint32(16) | out[1:-1] << np.uint32(8) | out[2:]
    hashed = (triple * _ODD) >> np.uint32(32 - TRIGRAM_BITS)
    # The trigrams of blanks only say nothing, nor do those across two texts.
    good = triple != 0x202020
    for k in range(len(at) - 1):
        good[at[k] + n[k] : at[k + 1]] = False
    ends = np.append(0, np.cumsum(good))
    heads = np.append(ends[np.minimum(at, len(good))], ends[-1])
    return hashed[good], heads


def _counter(languages: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), 1 << TRIGRAM_BITS), dtype=np.int64)
        for batch in batches:
            declared = batch.column(0).to_pylist()
            for piece in pieces(batch.column(1)):
                found, heads = _trigrams(piece.data, piece.bounds)
                label = np.array(
                    [languages.index(x) if x in languages else -1 for x in declared[piece.first : piece.last]]
                )
                of = np.repeat(label, np.diff(heads))
                for k in range(len(languages)):
                    counts[k] += np.bincount(found[of == k], minlength=counts.shape[1])
        yield from counted(counts.ravel())

    return run


def trigram_model(rows: DataFrame, languages: Sequence[str]) -> np.ndarray:
    """Log chances (trigram, language and unknown) from all declared texts."""
    counts = np.zeros(len(languages) << TRIGRAM_BITS, dtype=np.int64)
    if languages:
        parts = rows.select("declared", "text").mapInArrow(_counter(languages), COUNTED)
        counts = summed(parts, len(counts))
    counts = counts.reshape(len(languages), 1 << TRIGRAM_BITS) + 0.05
    chances = np.log(counts / counts.sum(axis=1, keepdims=True))
    # No trigram counts less than half of the unknown's even chance.
    even = -TRIGRAM_BITS * np.log(2)
    chances = np.maximum(chances, even - np.log(2))
    flat = np.full((1, counts.shape[1]), even)
    return np.ascontiguousarray(np.vstack([chances, flat]).T.astype(np.float32))


def _scorer(model, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chances = model.value
        for batch in batches:
            out = np.zeros((batch.num_rows, classes))
            for piece in pieces(batch.column(batch.num_columns - 1)):
                found, heads = _trigrams(piece.data, piece.bounds)
                sums = np.zeros((len(found) + 1, classes))
                np.cumsum(chances[found], axis=0, dtype=np.float64, out=sums[1:])
                out[piece.first : piece.last] = sums[heads[1:]] - sums[heads[:-1]]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * classes),
                        pa.array((out * TEMPER).ravel()),
                    ),
                ],
                names=[*batch.schema.names[:-1], "logs"],
            )

    return run


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda x: x / total)


def _sums(rows: DataFrame, key: Sequence[str], n: int, name: str) -> DataFrame:
    """Summed posteriors by key, as an array."""
    sums = rows.groupBy(*key).agg(*[F.sum(F.col("text_p")[i]).alias(f"s{i}") for i in range(n)])
    return sums.select(*key, F.array(*[f"s{i}" for i in range(n)]).alias(name))


def _joined(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Every row with its key's entry; null keys have one too."""
    side = side.withColumnRenamed(key, "_key")
    return rows.join(if_small(side), rows[key].eqNullSafe(side["_key"]), "left").drop("_key")


def declared_languages(
    rows: DataFrame, min_rows: int = MIN_ROWS, min_chars: int = MIN_CHARS, most: int = MOST_LANGUAGES
) -> list[str]:
    """The languages that rows (text, declared) hold enough text of, in order of name."""
    sums = rows.where(F.col("declared").isNotNull() & ~F.col("declared").isin(*NO_LANGUAGE)).groupBy("declared")
    sums = sums.agg(
        F.sum(F.length("text").cast("bigint")).alias("chars"), F.count_if(F.length("text") > 0).alias("n")
    ).where((F.col("chars") >= min_chars) & (F.col("n") >= min_rows))
    return sorted(r["declared"] for r in sums.orderBy(F.desc("chars"), "declared").limit(most).collect())


def identify(rows: DataFrame, languages: Sequence[str] | None = None) -> DataFrame:
    """Language of every row of (id, text_hash, text, declared, suffix, host).

    The ``languages`` to tell apart are given, or those of ``declared_languages``.
    Without any, nothing is accepted.

    Returns id, text_hash, lang, posterior, text_lang (by the text alone), and
    accepted: the language is a known one, with at least ``MIN_POSTERIOR``.

    A null or empty text, or one without letters, has no text evidence; it is
    never accepted, whatever is declared. A null declaration or suffix is no
    evidence; a null host has the prior of its suffix. Declarations are compared
    by their first subtag, lower-cased; only those of a learned language teach
    the text model. Ties go to the language that comes first. Repeated rows each
    have their row, an empty table gives none.
    """
    spark = rows.sparkSession
    tag = F.lower(F.regexp_extract("declared", r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))
    rows = rows.select("id", "text_hash", F.nullif(tag, F.lit("")).alias("declared"), "suffix", "host", "text")
    languages = list(languages) if languages is not None else declared_languages(rows)
    classes = [*languages, UNKNOWN]
    n = len(classes)
    model = spark.sparkContext.broadcast(trigram_model(rows, languages))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in rows.columns[:-1]) + ", logs array<double>"
    scored = keep(rows.mapInArrow(_scorer(model, n), schema), "language-scores")

    silent = F.forall("logs", lambda x: x == 0)
    flat = F.array(*[F.lit((1 - UNKNOWN_SHARE) / max(1, len(languages)))] * len(languages), F.lit(UNKNOWN_SHARE))
    start = F.transform(F.arrays_zip(F.col("logs").alias("l"), flat.alias("p")), lambda x: x["l"] + F.ln(x["p"]))
    scored = scored.withColumn("silent", silent).withColumn("text_p", _softmax(start))

    seen = scored.where("not silent")
    total = _sums(seen.withColumn("all", F.lit(0)), ["all"], n, "sums").first()
    counts = np.array(total["sums"] if total else np.zeros(n)) + np.append(np.ones(n - 1), 0.1)
    prior = counts / counts.sum()
    whole = F.array(*[F.lit(float(x)) for x in prior])

    def smoothed(sums: Column, above: Column, weight: float) -> Column:
        size = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x)
        both = F.arrays_zip(sums.alias("s"), above.alias("a"))
        return F.transform(both, lambda x: (x["s"] + weight * x["a"]) / (size + F.lit(weight)))

    def evidence(sums: Column) -> Column:
        """Log of how much likelier a value is with each language than overall."""
        share = smoothed(sums, whole, VALUE_WEIGHT)
        return F.transform(F.arrays_zip(share.alias("s"), whole.alias("w")), lambda x: F.ln(x["s"] / x["w"]))

    declared = _sums(seen.where("declared is not null"), ["declared"], n, "sums")
    declared = keep(declared.select("declared", evidence(F.col("sums")).alias("by_declared")), "declared-languages")
    suffix = keep(_sums(seen, ["suffix"], n, "suffix_sums"), "suffixes")
    suffix_prior = suffix.select(
        "suffix",
        F.when(F.col("suffix").isNotNull(), evidence(F.col("suffix_sums"))).alias("by_suffix"),
        smoothed(F.col("suffix_sums"), whole, SUFFIX_WEIGHT).alias("suffix_prior"),
    )
    suffix_prior = keep(suffix_prior, "suffix-priors")
    hosts = keep(_sums(seen.where("host is not null"), ["host", "suffix"], n, "host_sums"), "hosts")
    hosts = _joined(hosts, suffix_prior.drop("by_suffix"), "suffix")
    hosts = keep(
        hosts.select(
            F.struct("host", "suffix").alias("host_key"),
            smoothed(F.col("host_sums"), F.col("suffix_prior"), HOST_WEIGHT).alias("host_prior"),
        ),
        "host-priors",
    )
    out = scored.withColumn("host_key", F.struct("host", "suffix"))
    for side, key in ((declared, "declared"), (suffix_prior, "suffix"), (hosts, "host_key")):
        out = _joined(out, side, key)
    zero = F.array(*[F.lit(0.0)] * n)
    parts = F.arrays_zip(
        F.col("logs").alias("a"),
        F.coalesce("by_declared", zero).alias("b"),
        F.coalesce("by_suffix", zero).alias("c"),
        F.coalesce("host_prior", "suffix_prior", whole).alias("d"),
    )
    fused = _softmax(F.transform(parts, lambda x: x["a"] + x["b"] + x["c"] + F.ln(x["d"])))
    names = F.array(*[F.lit(x) for x in classes])
    best = lambda p: F.element_at(names, F.array_position(p, F.array_max(p)).cast("int"))
    out = out.withColumn("p", fused).withColumn("lang", best(F.col("p")))
    posterior = F.array_max("p")
    return out.select(
        "id",
        "text_hash",
        F.when(F.col("silent"), UNKNOWN).otherwise(F.col("lang")).alias("lang"),
        posterior.alias("posterior"),
        F.when(F.col("silent"), UNKNOWN).otherwise(best(F.col("text_p"))).alias("text_lang"),
        (~F.col("silent") & (F.col("lang") != UNKNOWN) & (posterior >= MIN_POSTERIOR)).alias("accepted"),
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents name a language and a source; the source stands for the host."""
    return docs.select(
        F.col("doc_id").alias("id"),
        text_hash(),
        "text",
        F.col("lang").alias("declared"),
        F.lit(None).cast("string").alias("suffix"),
        F.col("source").alias("host"),
    )


# Parts of a page that are no prose.
_MARKUP = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;"
_LANG = r"""(?is)<html\b[^>]*?\slang\s*=\s*["']?([A-Za-z-]+)"""
_HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def page_evidence(pages: DataFrame) -> DataFrame:
    """The visible text, markup language, last label of the address, and host."""
    found = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    host = F.lower(found("url", _HOST))
    return pages.select(
        F.col("page_id").alias("id"),
        F.xxhash64("html").alias("text_hash"),
        F.regexp_replace("html", _MARKUP, " ").alias("text"),
        found("html", _LANG).alias("declared"),
        F.nullif(F.regexp_extract(host, r"\.([^.]+)$", 1), F.lit("")).alias("suffix"),
        host.alias("host"),
    )


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The documents whose language is accepted, with all their columns.

    Rows equal in id and text that differ in what they declare go if any of them is
    rejected; null and repeated ids are told apart by the text. See ``identify``
    for null, empty and tied cases.
    """
    found = identify(document_evidence(docs)).where("not accepted")
    bad = found.select(F.col("id").alias("doc_id"), "text_hash").distinct()
    return only(docs, keep(bad, "rejected"), "left_anti")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; see ``identify`` for all cases."""
    found = identify(document_evidence(table(spark, sf_dir, "documents")))
    return found.drop("text_hash").withColumnRenamed("id", "doc_id")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator on pages, which have all four kinds of evidence."""
    found = identify(page_evidence(table(spark, sf_dir, "pages")))
    return found.drop("text_hash").withColumnRenamed("id", "page_id")
