"""Quality classifier by co-training of two views.

One view sees a text's content (shares of kinds of characters, word and line
statistics), the other the record's metadata (source, language, length). Both
are logistic regressions. In each round a view labels the unlabelled rows
that it is surest of and hands them to the *other* view's training rows. In
the end each view's score is calibrated on labelled rows held out from all
training, the calibrated log odds are added (less the prior that both hold),
and a cut is set on the held-out rows that keeps nearly all good ones.

All unlabelled rows take part: in each round both views score all of them, and
the bounds of what is sure enough are quantiles over all of them. A view hands
over classes in the proportion in which labels have them. What a regression is
fitted on is bounded (documented parameters): a sample of the labelled rows and,
of the rows handed over in a round, a sample by hash. A round after which
held-out rows are told apart worse does not count, and ends the exchange.
Scoring covers every row.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, fresh, materialize

#: Labelled rows in training at most, and rows that a view hands over in a round at most.
LABELLED_ROWS, HANDED_ROWS = 6_000, 600
ROUNDS = 4
#: Share of the unlabelled rows that a view hands over in a round, and how sure it must be.
HANDED, SURE = 0.05, 0.9
#: Share of held-out good rows that the cut keeps.
KEEP_GOOD = 0.997
META_BUCKETS = 64
#: Kinds of bytes: each gives a share.
MARKS = b"!#$%&*|.,;:?\n-_/\\<>{}[]()\"'"


def text_features(text: str | None) -> np.ndarray:
    """Content of a whole text; null counts as empty."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(1, len(data))
    counts = np.bincount(data, minlength=256).astype(np.float64)
    words = text.split()
    lines = text.split("\n")
    upper, lower, digit, high = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum(), counts[128:].sum()
    share = counts[counts > 0] / n
    base = [
        upper / n, lower / n, digit / n, high / n, counts[32] / n, upper / max(1.0, upper + lower),
        len(set(words)) / max(1, len(words)), sum(map(len, words)) / max(1, len(words)) / 10, len(set(lines)) / len(lines),
        -(share * np.log(share)).sum() / 5, np.log1p(len(data)) / 10, np.log1p(len(words)) / 10, np.log1p(len(words) / len(lines)) / 5,
        sum(1 for w in words if w[-1] in "!#$%&*|") / max(1, len(words)),
    ]
    return np.concatenate([base, np.sqrt(counts[np.frombuffer(MARKS, np.uint8)] / n), [1.0]])


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Metadata of a record; a null is a value of its own."""
    out = np.zeros(2 * META_BUCKETS + 4)
    out[zlib.crc32(f"source={source}".encode()) % META_BUCKETS] = 1
    out[META_BUCKETS + zlib.crc32(f"lang={lang}".encode()) % META_BUCKETS] = 1
    size = np.log1p(max(0, n_chars or 0)) / 10
    out[-4:] = size, size * size, n_chars is None, 1
    return out


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method, with a ridge penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w, -30, 30)


@dataclass(frozen=True)
class CoTrained:
    """Weights of both views, their calibrations (slope, shift), the prior log odds and the cut."""

    text: np.ndarray
    meta: np.ndarray
    text_line: np.ndarray
    meta_line: np.ndarray
    prior: float
    cut: float
    accuracy: float = 0.0

    def log_odds(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        a = odds(text, self.text) * self.text_line[0] + self.text_line[1]
        b = odds(meta, self.meta) * self.meta_line[0] + self.meta_line[1]
        return np.clip(a + b - self.prior, -30, 30)


#: Keeps every row: for tables without labels of both classes.
def _neutral() -> CoTrained:
    return CoTrained(np.zeros(len(text_features(""))), np.zeros(len(meta_features(None, None, None))), np.zeros(2), np.zeros(2), 0.0, -1.0)


@dataclass(frozen=True)
class Views:
    """Weights of both views while they are trained."""

    text: np.ndarray
    meta: np.ndarray


#: What a pool gives for two views and the share of good labels: for each view the rows that it hands over, as (features of the *other* view, labels).
Pool = Callable[[Views, float], dict[str, tuple[np.ndarray, np.ndarray]]]


def calibrated(views: Views, text: np.ndarray, meta: np.ndarray, y: np.ndarray) -> CoTrained:
    """Both views calibrated on held-out rows, with the cut and the accuracy there."""
    lines = [fit(np.stack([odds(x, w), np.ones(len(y))], axis=1), y, penalty=1e-2) for x, w in ((text, views.text), (meta, views.meta))]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = CoTrained(views.text, views.meta, *lines, float(np.log(share / (1 - share))), 0.0)
    score = model.log_odds(text, meta)
    cut = min(0.0, float(np.quantile(score[y == 1], 1 - KEEP_GOOD)) - 0.5)
    return CoTrained(model.text, model.meta, *lines, model.prior, cut, float(((score >= cut) == (y == 1)).mean()))


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool: Pool | None, *, rounds: int = ROUNDS) -> CoTrained:
    """Train on labelled rows (every fourth is held out) and on what the views hand each other from a pool of unlabelled ones."""
    held = np.arange(len(y)) % 4 == 3
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        return _neutral()
    own = {"text": text[~held], "meta": meta[~held]}
    views = Views(fit(own["text"], y[~held]), fit(own["meta"], y[~held]))
    best = calibrated(views, text[held], meta[held], y[held])
    for _ in range(rounds if pool is not None else 0):
        handed = pool(views, float(y.mean()))
        got = {"text": handed["meta"], "meta": handed["text"]}  # each learns from the other
        weights = {v: fit(np.concatenate([own[v], x]), np.concatenate([y[~held], c])) if len(c) else getattr(views, v) for v, (x, c) in got.items()}
        views = Views(weights["text"], weights["meta"])
        model = calibrated(views, text[held], meta[held], y[held])
        if model.accuracy < best.accuracy:
            break  # a round that tells held-out rows apart worse doesn't count
        best = model
    return best


#: Columns that the views see.
INPUT = ["text", "source", "lang", "n_chars"]


def _features(text: pa.Array, *meta: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return np.array([text_features(t.as_py()) for t in text]), np.array([meta_features(*m) for m in zip(*(c.to_pylist() for c in meta), strict=True)])


def features(docs: DataFrame) -> DataFrame:
    """doc_id, text and meta (features as arrays) and a number that shuffles rows, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 1024) for k in range(0, batch.num_rows, 1024)):
                both = _features(*(part.column(1 + k) for k in range(len(INPUT))))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(list(x.astype(np.float32)), pa.list_(pa.float32())) for x in both)], names=["doc_id", "text", "meta"])

    kind = dict(docs.dtypes)["doc_id"]
    made = docs.select("doc_id", *INPUT).mapInArrow(run, f"doc_id {kind}, text array<float>, meta array<float>")
    return made.withColumn("place", F.xxhash64(F.lit(5), "doc_id", "text", "meta"))


def least_places(rows: DataFrame, limit: int, expected: float) -> DataFrame:
    """The ``limit`` rows with the least ``place``, of about ``expected`` ones.

    All others are left out where they lie, so that no more than a few times
    ``limit`` rows meet, however many partitions there are.
    """
    share = min(1.0, (2 * limit + 100) / max(1.0, expected))
    return rows.where(F.col("place") <= min(2**63 - 1, int(share * 2**64) - 2**63)).orderBy("place").limit(limit)


def distributed_pool(rows: DataFrame, *, handed: float = HANDED, handed_rows: int = HANDED_ROWS) -> Pool:
    """The pool of all ``rows`` (text, meta, place): scored where they lie, with bounds from quantiles over all of them."""

    n = rows.count()

    def give(views: Views, good: float) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for text, meta in batches:
                scores = [odds(np.stack(x.to_numpy(zero_copy_only=False)), w) if len(x) else np.zeros(0) for x, w in ((text, views.text), (meta, views.meta))]
                yield pa.StructArray.from_arrays([pa.array(z, pa.float64()) for z in scores], names=["text", "meta"])

        scored = rows.withColumn("odds", F.arrow_udf(run, "text double, meta double").asNondeterministic()("text", "meta"))
        shares = [handed * (1 - good), 1 - handed * good]
        bounds = scored.agg(*(F.percentile_approx(f"odds.{v}", shares, 10_000).alias(v) for v in ("text", "meta"))).first()
        sure = float(np.log(SURE / (1 - SURE)))
        out = {}
        for view, other in (("text", "meta"), ("meta", "text")):
            parts = []
            for label, share in ((0, 1 - good), (1, good)):
                limit = bounds[view][label] if bounds[view] else 0.0
                z = F.col(f"odds.{view}")
                chosen = (z <= min(limit, -sure)) if label == 0 else (z >= max(limit, sure))
                # at most so many rows come to the driver, those with the least hash
                few = least_places(scored.where(chosen), max(1, round(handed_rows * share)), handed * share * n)
                parts.append(few.select(F.col(other).alias("x"), F.lit(label).alias("y")))
            got = parts[0].unionByName(parts[1]).toPandas()
            x = np.stack(got["x"]).astype(np.float64) if len(got) else np.zeros((0, len(views.meta if other == "meta" else views.text)))
            out[view] = x, got["y"].to_numpy(np.float64)
        return out

    return give


def train(docs: DataFrame, labels: DataFrame, *, labelled_rows: int = LABELLED_ROWS, handed_rows: int = HANDED_ROWS) -> CoTrained:
    """Co-train on documents and labels. Repeated labels of a document: the worst counts; null ones don't.

    Without labels of both classes the model keeps every row.
    """
    bound_batches(docs.sparkSession)
    one = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.min("quality").alias("quality"))
    rows = materialize(features(docs), "features").join(one, F.col("doc_id") == F.col("label_id"), "left")
    labelled = rows.where("quality is not null")
    got = least_places(labelled, labelled_rows, labelled.count()).select("text", "meta", "quality").toPandas()
    if not len(got):
        return _neutral()
    text, meta = (np.stack(got[c]).astype(np.float64) for c in ("text", "meta"))
    unlabelled = materialize(rows.where("quality is null").select("text", "meta", "place"), "unlabelled")
    pool = None if unlabelled.isEmpty() else distributed_pool(unlabelled, handed_rows=handed_rows)
    return co_train(text, meta, (got["quality"].to_numpy() > 0).astype(float), pool)


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """All columns of ``docs``, quality_score (probability of good) and quality_kept.

    Null and empty texts are scored as empty ones. Columns of these names are
    replaced; missing metadata counts as null. Repeated rows are scored each.
    """
    bound_batches(docs.sparkSession)
    docs = docs.drop("quality_score", "quality_kept")

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            z = model.log_odds(*_features(*columns)) if len(columns[0]) else np.zeros(0)
            yield pa.StructArray.from_arrays([pa.array(1 / (1 + np.exp(-z)), pa.float64()), pa.array(z >= model.cut, pa.bool_())], names=["score", "kept"])

    # only these columns go to Python and only the scores come back; nondeterministic, so that a filter doesn't run it twice
    judged = F.arrow_udf(run, "score double, kept boolean").asNondeterministic()(*map(F.col, INPUT))
    (own,) = fresh(docs, "judged")
    return docs.withColumn(own, judged).select(*docs.columns, F.col(f"{own}.score").alias("quality_score"), F.col(f"{own}.kept").alias("quality_kept"))
