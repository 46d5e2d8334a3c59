"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a linear score of figures of its text. Of each pair of
a good and a bad training document the good one is preferred, and the chance of
that is logistic in the difference of the scores; the weights minimise that loss
over the pairs. A document passes if its score is above a quantile of the
training scores: the share of bad documents among the training rows.

All labelled rows of the training folds are learnt from, and all their pairs count.
The tasks add the figures up by class and score, in steps of 1 / `PER_POINT`; as the
chance of a pair depends on the two scores alone, the sums of the steps give the sums
over the pairs, each score taken as the mean of its step. The quantile is exact. Every
whole text is scored in the tasks.

Defined results: null and empty texts get the score of a text without words;
without two classes to learn from, every score is 0.5; repeated rows get equal
scores; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import cut as stored
from .common import documents, fold
from .compression_rules import duplicate_lines, repeated_words
from .features import labelled

MAX_PAIRS = 100_000  # of `fit`
PER_POINT = 32
REACH = 16  # scores beyond it share a step
FEW = 10_000
DIGITS = 6  # of the weights, beyond which the order of additions shows
RIDGE = 1e-3
CUT = 0.3

_CLASSES = np.zeros((256, 7), dtype=np.float32)
for _i, _chars in enumerate(
    (b"#*$%&<>^~_=+@\\/[]{}", b"|", b"!?", b"0123456789", bytes(range(65, 91)), b".,;:'\"()-")
):
    _CLASSES[list(_chars), _i] = 1
_CLASSES[128:, 6] = 1


def figures(raw: bytes, words: np.ndarray) -> list[float]:
    """Shares of kinds of characters and words, as logarithms where small ones matter."""
    n, size = len(words), max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    shares = (counts @ _CLASSES) / size
    lines = raw.count(b"\n") + 1
    distinct = len(np.unique(words))
    same = int((words[1:] == words[:-1]).sum())
    some = max(1, n)
    log = lambda x: float(np.log(0.005 + x))
    return [
        *(log(x) for x in shares),
        float(np.log1p(n)),
        float(np.log1p(n) < np.log(21)),
        min(30.0, size / some),
        log(duplicate_lines(raw) / lines),
        log(repeated_words(words) / some),
        log(same / some),
        float(np.log((1 + distinct) / (1 + n))),
    ]


N_FIGURES = 14


def _table(batch: pa.RecordBatch) -> np.ndarray:
    texts = tokens.utf8(batch.column("text"))
    rows = [figures(t, w) for t, w in zip(texts, tokens.word_hashes(texts), strict=True)]
    return np.array(rows, dtype=np.float64).reshape(len(rows), N_FIGURES)


def _least(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], digits: int | None = None) -> np.ndarray:
    """The weights of least loss, from the loss's gradient and curvature at given weights."""
    w = np.zeros(N_FIGURES)
    for _ in range(30):  # Newton steps; the loss is convex
        gradient, curve = sums(w)
        step = np.linalg.solve(curve + RIDGE * np.eye(len(w)), gradient + RIDGE * w)
        w = w - step / max(1.0, np.abs(step).max())
        if digits is not None:
            w = np.round(w, digits)
        if np.abs(step).max() < (1e-6 if digits is None else 10.0 ** (2 - digits)):
            break
    return w


def fit(x: np.ndarray, label: np.ndarray) -> dict:
    """The weights, scaling and threshold of rows in memory and pairs drawn of them; no
    weights without both classes. `train` does so for all rows and pairs of a table."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return {}
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = (x - mean) / spread
    rng = np.random.default_rng(0)
    pairs = min(MAX_PAIRS, 50 * max(len(good), len(bad)))
    diff = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]

    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
        return -(diff * p[:, None]).mean(axis=0), (diff * (p * (1 - p))[:, None]).T @ diff / pairs

    w = _least(sums)
    at = float(np.quantile(z @ w, len(bad) / len(label), method="linear"))
    return {"mean": mean, "spread": spread, "w": w, "at": at}


FIGURES = [f"x_{i}" for i in range(N_FIGURES)]


def training_rows(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """label and figures of every id to learn from, of its text of least hash. No text
    is shuffled."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [pa.array(c) for c in _table(batch).T]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("hash"), *columns], ["doc_id", "hash", *FIGURES]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash"))
    fields = ["doc_id long", "hash long", *(f"{n} double" for n in FIGURES)]
    figured = rows.filter("doc_id IS NOT NULL").mapInArrow(measured, ", ".join(fields))
    first = figured.groupBy("doc_id").agg(*[F.min_by(n, "hash").alias(n) for n in FIGURES])
    return first.join(labelled(labels, column), "doc_id").select("label", *FIGURES)


def _scaled(batch: pa.RecordBatch, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Scaled figures and scores of training rows."""
    x = np.column_stack([batch.column(n).to_numpy() for n in FIGURES])
    z = (x - model["mean"]) / model["spread"]
    return z, (z * model["w"]).sum(axis=1)


def _steps(batch: pa.RecordBatch, score: np.ndarray) -> np.ndarray:
    """The number of each row's class and step of the score."""
    step = np.floor((np.clip(score, -REACH, REACH) + REACH) * PER_POINT).astype(np.int64)
    return 2 * step + (batch.column("label").to_numpy() == 1)


N_STEPS = 2 * (2 * REACH * PER_POINT + 1)
SUMS = ["n", "s", *FIGURES]


def _step_sums(rows: DataFrame, model: dict) -> np.ndarray:
    """Row count, scores and scaled figures added up by class and step of the score."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((N_STEPS, len(SUMS)))
        for batch in batches:
            z, score = _scaled(batch, model)
            at = _steps(batch, score)
            for i, c in enumerate((np.ones(len(at)), score, *z.T)):
                total[:, i] += np.bincount(at, c, N_STEPS)
        met = np.flatnonzero(total[:, 0])
        columns = [pa.array(met), *(pa.array(c) for c in total[met].T)]
        yield pa.RecordBatch.from_arrays(columns, ["step", *SUMS])

    parts = rows.mapInArrow(added, ", ".join(["step long", *(f"{n} double" for n in SUMS)]))
    out = np.zeros((N_STEPS, len(SUMS)))
    # One row for each step, N_STEPS at most.
    for step, *sums in parts.groupBy("step").agg(*[F.sum(n).alias(n) for n in SUMS]).collect():
        out[step] = sums
    return out


def _products(rows: DataFrame, model: dict, weight: np.ndarray) -> np.ndarray:
    """The weighted sum of the rows' products of two figures; a step's rows weigh alike."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((N_FIGURES, N_FIGURES))
        for batch in batches:
            z, score = _scaled(batch, model)
            total += (z * weight[_steps(batch, score)][:, None]).T @ z
        columns = [pa.array(np.arange(N_FIGURES)), *(pa.array(c) for c in total.T)]
        yield pa.RecordBatch.from_arrays(columns, ["row", *FIGURES])

    parts = rows.mapInArrow(added, ", ".join(["row long", *(f"{n} double" for n in FIGURES)]))
    found = parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in FIGURES]).orderBy("row").collect()
    return np.array([r[1:] for r in found], dtype=np.float64)


def _pair_sums(rows: DataFrame, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the mean loss over all pairs of a good and a bad row."""
    sums = _step_sums(rows, model)
    bad, good = (np.flatnonzero(sums[c::2, 0]) * 2 + c for c in (0, 1))
    (n_bad, s_bad, *_), (n_good, s_good, *_) = sums[bad].T, sums[good].T
    pairs = n_bad.sum() * n_good.sum()
    apart = (s_good / n_good)[:, None] - (s_bad / n_bad)[None, :]
    p = 1 / (1 + np.exp(np.clip(apart, -30, 30)))
    x_bad, x_good = sums[bad, 2:], sums[good, 2:]
    gradient = x_bad.T @ (n_good @ p) - x_good.T @ (p @ n_bad)
    q = p * (1 - p)
    weight = np.zeros(N_STEPS)
    weight[bad], weight[good] = n_good @ q, q @ n_bad
    cross = x_good.T @ q @ x_bad
    return gradient / pairs, (_products(rows, model, weight) - cross - cross.T) / pairs


def _ranked(scores: DataFrame, rank: int) -> float:
    """The score of a rank from 0. The range that holds it is cut until few are left."""
    low, high, left = scores.agg(F.min("s"), F.max("s"), F.count("s")).first()
    part = scores
    while left > FEW and low < high:
        place = (F.col("s") - low) / (high - low) * N_STEPS
        cells = part.groupBy(F.floor(place).alias("cell")).agg(
            F.count("s").alias("n"), F.min("s").alias("low"), F.max("s").alias("high")
        )
        for _, n, low, high in sorted(cells.collect()):
            if rank < n:
                break
            rank -= n
        left, part = n, scores.filter(F.col("s").between(low, high))
    return low if low == high else sorted(r.s for r in part.collect())[rank]


def _quantile(scores: DataFrame, n: int, share: float) -> float:
    at = share * (n - 1)
    low = int(at)
    first, second = (_ranked(scores, r) for r in (low, min(low + 1, n - 1)))
    return first + (second - first) * (at - low)


def train(docs: DataFrame, labels: DataFrame, column: str) -> dict:
    """The weights, scaling and threshold; no weights without both classes."""
    rows = stored(training_rows(docs, labels, column))
    n, good, *rest = rows.agg(
        F.count("*"),
        F.coalesce(F.sum((F.col("label") == 1).cast("int")), F.lit(0)),
        *[F.avg(c) for c in FIGURES],
        *[F.stddev_pop(c) for c in FIGURES],
    ).first()
    rows = rows.filter("label IN (0, 1)")
    bad = rows.filter("label = 0").count()
    if not good or not bad:
        return {}
    mean, spread = np.round(np.array(rest, dtype=np.float64).reshape(2, N_FIGURES), 9)
    model = {"mean": mean, "spread": spread + 1e-9}
    model["w"] = _least(lambda w: _pair_sums(rows, {**model, "w": w}), DIGITS)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_scaled(batch, model)[1])], ["s"])

    scores = stored(rows.mapInArrow(scored, "s double"))
    return {**model, "at": _quantile(scores, good + bad, bad / n)}


def score_documents(
    docs: DataFrame, model: dict, cut: float = CUT, names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """`docs` with score (0 to 1; `cut` is the threshold) and predicted, or other
    `names` where it has columns of these."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model:
                z = (_table(batch) - model["mean"]) / model["spread"]
                s = (z * model["w"]).sum(axis=1) - model["at"] + np.log(cut / (1 - cut))
                score = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
            else:
                score = np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= cut).astype(np.int32))],
                [*batch.schema.names, *names],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    added = [f"`{names[0]}` double", f"`{names[1]}` int"]
    return docs.mapInArrow(scored, ", ".join([*fields, *added]))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels, "quality")
    scored = score_documents(docs.select("doc_id", "text"), model)
    held_out = (fold(F.col("doc_id")) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


def op10_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(documents(spark, sf_dir), labels)
