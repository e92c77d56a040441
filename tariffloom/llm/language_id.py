"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence meet in one posterior for each document:

* the text: likelihood of its hashed byte trigrams under each language, as the
  mean for a trigram times a bounded number of trigrams (they depend on each
  other, so a long text must not count as that many independent witnesses);
* the language that the markup (or the record) declares, by how often such
  declarations agree with the text over all rows;
* the address suffix and the host: the prior of a host is smoothed towards
  that of its suffix, and the suffix's towards the whole, from counts of the
  text's best language by grouped aggregation over all rows.

A text that fits none of the known languages (one in another language, or
gibberish) has no evidence: its words' mean log likelihood for a trigram stays
below the floor of each language. A floor is set from rows of the language that
its model has not seen.

The trigram model and the floors are trained on a bounded sample of rows with
a known language; all else is counted over all rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import bound_batches, fresh, materialize, small

BUCKETS = 1 << 15
#: Rows with a known language that the trigram model is trained on, about.
SAMPLE_ROWS = 5_000
#: Independent trigrams that a text counts as at most.
EFFECTIVE_TRIGRAMS = 60
#: Rows that the counts of the level above weigh as.
SMOOTHING = 20.0
#: Rows of the table of host priors up to which it is broadcast (about 20 MB).
BROADCAST_HOSTS = 50_000
MIN_CONFIDENCE = 0.5
#: A language's floor lies so far (log likelihood for a trigram) below this quantile of the texts declared in it, up to a quarter of which may be wrongly declared.
FLOOR_QUANTILE, FLOOR_MARGIN = 0.25, 3.25
#: No floor is lower than what evenly drawn trigrams reach; languages with fewer texts to set one by have this one.
EVEN, FLOOR_ROWS = -math.log(BUCKETS), 5
#: Kinds of bytes: 1 of letters (beyond ASCII all bytes), 2 digits, 0 what separates words.
_KIND = np.array([1 if b >= 0x80 or chr(b).isalpha() else 2 if chr(b).isdigit() else 0 for b in range(256)], np.uint8)


def words_of(text: str) -> np.ndarray:
    """The bytes of the text's words in lower case, each between spaces.

    Words are runs of letters; those that touch a digit (keys, numbers) only
    count in texts that have no others.
    """
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    kind = _KIND[data]
    letter, digit = kind == 1, kind == 2
    if digit.any():
        inside = kind > 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        touched = np.logical_or.reduceat(digit, np.flatnonzero(first))
        pure = letter.copy()
        pure[inside] &= ~touched[(np.cumsum(first) - 1)[inside]]
        letter = pure if pure.any() else letter
    with_space = letter.copy()
    with_space[1:] |= letter[:-1]
    out = np.where(letter, data, np.uint8(32))[with_space]
    return np.concatenate([np.full(1, 32, np.uint8), out, np.full(1 if len(out) and out[-1] != 32 else 0, 32, np.uint8)])


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the text's words."""
    data = words_of(text).astype(np.uint32)
    return (((data[:-2] << 16) | (data[1:-1] << 8) | data[2:]) * np.uint32(2654435761)) >> np.uint32(17)


@dataclass(frozen=True)
class TextModel:
    languages: list[str]
    logs: np.ndarray = field(repr=False)  # BUCKETS x languages
    floors: np.ndarray  # by language

    def fits(self, found: np.ndarray) -> np.ndarray:
        """Mean log likelihood for a trigram by language; -inf without trigrams."""
        if not len(found):
            return np.full(len(self.languages), -np.inf)
        total = np.zeros(len(self.languages))
        for k in range(0, len(found), 1 << 16):
            total += self.logs[found[k : k + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return total / len(found)

    def evidence(self, text: str | None) -> np.ndarray:
        """Log likelihood of a text by language; zeros if it has no words or fits no language."""
        found = trigrams(text or "")
        fits = self.fits(found)
        if not (fits >= self.floors).any():
            return np.zeros(len(self.languages), np.float32)
        return (fits * min(len(found), EFFECTIVE_TRIGRAMS)).astype(np.float32)


def train(df: DataFrame, text: Column, language: Column, key: Column, *, sample_rows: int = SAMPLE_ROWS) -> TextModel:
    """Trigram counts by language on about ``sample_rows`` rows, chosen by a hash of ``key``.

    Rows without a language or text don't take part. What comes to the driver
    is at most two numbers for each bucket and language, and one for each row of
    half the sample: the other half's model judges these to set the floors.
    """
    bound_batches(df.sparkSession)
    known = df.select(text.alias("text"), language.alias("language"), key.alias("key")).where("language is not null and text is not null")
    n = known.count()
    share = min(1.0, sample_rows / max(1, n))
    sample = known.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    sample = sample.select("text", "language", F.pmod(F.xxhash64(F.lit(3), "key", "text"), F.lit(2)).cast("int").alias("half"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for t, *group in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                own = sums.setdefault(tuple(group), np.zeros(BUCKETS, np.int64))
                own += np.bincount(trigrams(t), minlength=BUCKETS)
        for (language, half), own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(at), pa.string()), pa.array([half] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())], names=["language", "half", "bucket", "n"])

    counted = sample.mapInArrow(count, "language string, half int, bucket int, n bigint").groupBy("language", "half", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["language"].unique())
    counts = np.zeros((2, BUCKETS, len(languages)))
    counts[counted["half"].to_numpy(int), counted["bucket"].to_numpy(int), [languages.index(x) for x in counted["language"]]] = counted["n"].to_numpy()
    logs = lambda table: np.log((table + 0.1) / (table + 0.1).sum(axis=0)).astype(np.float32)
    even = np.full(len(languages), EVEN)
    first = TextModel(languages, logs(counts[0]), even)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = [languages.index(x) for x in batch.column(1).to_pylist()]
            fits = [float(first.fits(trigrams(t))[k]) for t, k in zip(batch.column(0).to_pylist(), place, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(fits, pa.float64())], names=["place", "fit"])

    unseen = sample.where("half = 1").mapInArrow(judge, "place int, fit double").where(F.col("fit") > float("-inf")).toPandas()
    floors = even.copy()
    for k, own in unseen.groupby("place")["fit"]:
        if len(own) >= FLOOR_ROWS:
            floors[k] = max(EVEN, own.quantile(FLOOR_QUANTILE) - FLOOR_MARGIN)
    return TextModel(languages, logs(counts.sum(axis=0)), floors)


def text_evidence(model: TextModel, text: str) -> Column:
    """array<float>: the log likelihood by language of the column ``text``; only texts go to Python, and only scores come back."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            scores = [model.evidence(t.as_py()) for t in batch]
            flat = pa.array(np.concatenate(scores) if scores else np.zeros(0, np.float32), pa.float32())
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(scores) + 1) * len(model.languages), pa.int32()), flat)

    # nondeterministic: a filter on what follows must not run it a second time
    return F.arrow_udf(run, ArrayType(FloatType())).asNondeterministic()(F.col(text))


@dataclass(frozen=True)
class Priors:
    """Agreement of declarations, counts of the whole, and the table of hosts."""

    agreement: float
    whole: list[float]
    hosts: DataFrame  # host, prior array<double>
    few: bool


def priors(scored: DataFrame, model: TextModel) -> Priors:
    """Priors from all rows of (best, declared, host, suffix), aggregated before they are shuffled.

    ``best``: index of the text's best language, null if the text says nothing.
    """
    k = len(model.languages)
    counts = scored.where("best is not null").groupBy("host", "suffix", "best").agg(F.count("*").alias("n"), F.sum(F.when(F.col("declared") == F.col("best"), 1).otherwise(0)).alias("agree"), F.count("declared").alias("said"))
    counts = materialize(counts, "language-counts")
    total = {r["best"]: r for r in counts.groupBy("best").agg(F.sum("n").alias("n"), F.sum("agree").alias("agree"), F.sum("said").alias("said")).collect()}
    rows = [float(total[b]["n"]) if b in total else 0.0 for b in range(k)]
    whole = [(x + 1.0) / (sum(rows) + k) for x in rows]
    said, agree = (sum(r[c] or 0 for r in total.values()) for c in ("said", "agree"))
    agreement = (agree + 9.0) / (said + 10.0)

    def by(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(*(F.sum(F.when(F.col("best") == b, F.col("n")).otherwise(0)).alias(f"n{b}") for b in range(k)), F.sum("n").alias("n"))

    suffixes = by(counts, "suffix").select(F.col("suffix").alias("of_suffix"), F.array(*[(F.col(f"n{b}") + SMOOTHING * whole[b]) / (F.col("n") + SMOOTHING) for b in range(k)]).alias("above"))
    hosts = by(counts, "host", "suffix").join(suffixes, F.col("suffix").eqNullSafe(F.col("of_suffix")))
    hosts = hosts.select(F.col("host").alias("of_host"), F.col("suffix").alias("of_suffix"), F.array(*[(F.col(f"n{b}") + SMOOTHING * F.col("above")[b]) / (F.col("n") + SMOOTHING) for b in range(k)]).alias("prior"))
    few = counts.select("host", "suffix").distinct().count() <= BROADCAST_HOSTS
    return Priors(agreement, whole, hosts, few)


def identify(df: DataFrame, model: TextModel, *, text: str, declared: Column, host: Column, suffix: Column, near: Callable[[DataFrame], DataFrame] | None = None, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """All columns of ``df``, language, confidence, declared_language and language_kept.

    Null or empty texts, texts without a letter, and texts that fit no
    language of the model have no evidence of their own: the declared language and the host decide, and the row is not
    kept. A row is kept if the posterior of its language reaches
    ``min_confidence``; of equal posteriors the language that comes first by
    name wins. Whole texts are read, however long. Columns of ``df`` that bear the names of the new ones
    are replaced, others are kept whatever their names. Repeated rows are judged each; an empty table gives none.
    ``near`` joins columns that host and suffix are taken from, one row to each; it is applied to scored rows, so that
    what it shuffles for the priors holds no texts.
    """
    k, near = len(model.languages), near or (lambda scored: scored)
    new = ["language", "confidence", "declared_language", "language_kept"]
    rows = df.drop(*new)
    if not k:
        return rows.select("*", F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("confidence"), declared.alias("declared_language"), F.lit(False).alias("language_kept"))
    names = F.array(*map(F.lit, model.languages))
    index = F.array_position(names, declared).cast("int") - 1
    said, place, own_host, own_suffix, evidence, logs, top = fresh(rows, "said", "place", "host", "suffix", "evidence", "logs", "top")
    given = {said: declared, place: F.when(index >= 0, index), own_host: host, own_suffix: suffix}
    has_evidence = F.exists(evidence, lambda x: x != 0)
    best = F.when(has_evidence, F.array_position(F.col(evidence), F.array_max(evidence)).cast("int") - 1)
    scored = near(rows.withColumn(evidence, text_evidence(model, text))).withColumns(given)
    known = priors(scored.select(best.alias("best"), F.col(place).alias("declared"), F.col(own_host).alias("host"), F.col(own_suffix).alias("suffix")), model)
    of_host, of_suffix, prior = fresh(rows, "of_host", "of_suffix", "prior")
    hosts = known.hosts.select(F.col("of_host").alias(of_host), F.col("of_suffix").alias(of_suffix), F.col("prior").alias(prior))
    full = scored.join(F.broadcast(hosts) if known.few else hosts, F.col(own_host).eqNullSafe(F.col(of_host)) & F.col(own_suffix).eqNullSafe(F.col(of_suffix)), "left")
    yes, no = math.log(known.agreement), math.log((1 - known.agreement) / max(1, k - 1))
    each = [F.col(evidence)[b].cast("double") + F.log(F.coalesce(F.col(prior)[b], F.lit(known.whole[b]))) + F.when(F.col(place).isNull(), 0.0).when(F.col(place) == b, yes).otherwise(no) for b in range(k)]
    full = full.withColumn(logs, F.array(*each)).withColumn(top, F.array_max(logs))
    norm = F.aggregate(logs, F.lit(0.0), lambda s, x: s + F.exp(x - F.col(top)))
    confidence = 1 / norm
    kept = has_evidence & (confidence >= min_confidence)
    return full.select(
        *rows.columns, F.get(names, F.array_position(F.col(logs), F.col(top)).cast("int") - 1).alias("language"), confidence.alias("confidence"),
        F.col(said).alias("declared_language"), kept.alias("language_kept"),
    )


def addresses(pages: DataFrame) -> DataFrame:
    """(doc_id, host, suffix) of the documents that pages show: of several pages the one of the least page_id, of its URLs the first."""
    from .url_filter import document_of, host_of

    shown = pages.select(document_of(F.col("url")).alias("doc_id"), "page_id", "url").where(F.col("doc_id").isNotNull() & (host_of(F.col("url")) != ""))
    host = host_of(F.col("first")["url"])
    return shown.groupBy("doc_id").agg(F.min(F.struct("page_id", "url")).alias("first")).select("doc_id", host.alias("host"), F.nullif(F.substring_index(host, ".", -1), F.lit("")).alias("suffix"))


def identify_documents(docs: DataFrame, pages: DataFrame | None = None, *, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Documents: the record's lang is the declaration, host and suffix are those of the page that shows the document.

    Where no page shows it, ``source`` stands for the host, and there is no suffix.
    """
    model = train(docs, F.col("text"), F.col("lang"), F.col("doc_id"), sample_rows=sample_rows)
    if pages is None:
        return identify(docs, model, text="text", declared=F.col("lang"), host=F.col("source"), suffix=F.lit(None).cast("string"))
    shown, at, end = fresh(docs, "shown_doc", "address_host", "address_suffix")
    known = small(materialize(addresses(pages), "addresses").toDF(shown, at, end))
    near = lambda scored: scored.join(known, F.col("doc_id") == F.col(shown), "left")
    return identify(docs, model, text="text", declared=F.col("lang"), host=F.coalesce(at, "source"), suffix=F.col(end), near=near)


def identify_pages(pages: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Pages: the markup's lang attribute is the declaration; host and its last label come from the URL."""
    from .url_filter import host_of

    host = host_of(F.col("url"))
    stripped = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>", " ")
    declared = F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})", 1)), F.lit(""))
    rows = pages.select("page_id", "url", stripped.alias("_page_text"), declared.alias("_markup"), host.alias("_page_host"), F.nullif(F.substring_index(host, ".", -1), F.lit("")).alias("_page_suffix"))
    model = train(rows, F.col("_page_text"), F.col("_markup"), F.col("page_id"), sample_rows=sample_rows)
    out = identify(rows, model, text="_page_text", declared=F.col("_markup"), host=F.col("_page_host"), suffix=F.col("_page_suffix"))
    return out.drop("_page_text", "_markup", "_page_host", "_page_suffix")
