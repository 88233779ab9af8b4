"""A toxicity classifier that is told to ignore which group a text names."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.llm.text import slices

#: Words that name groups of people, without an inflection of their own. Fixed values.
IDENTITY_TERMS = tuple(
    """
    african africans american americans arab arabs asian asians black blacks blind catholic catholics chinese christian
    christians deaf disabled elderly european europeans female females foreigner foreigners gay gays german germans
    hindu hindus hispanic homosexual immigrant immigrants indian indians jew jewish jews latina latino lesbian lesbians
    male males men mexican mexicans migrant migrants muslim muslims native queer refugee refugees sikh straight
    trans transgender white whites woman women young
    frauen männer muslime juden christen schwule lesben ausländer flüchtlinge behinderte schwarze
    femmes hommes musulmans juifs chrétiens homosexuels étrangers réfugiés handicapés noirs
    mujeres hombres musulmanes judíos cristianos homosexuales extranjeros refugiados discapacitados negros
    """.split()
)
#: Bytes of a word's beginning that count as a feature of their own.
PREFIXES = (4, 5, 6)
#: ASCII characters that are no letters part words.
_BREAK = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


@dataclass(frozen=True)
class Fit:
    """``rows``: the bound of the sample of labelled rows the classifier is fitted on, taken
    in the order of a hash of doc_id. ``features``: the bound of the features that are kept,
    those of the strongest association with the label. A feature needs ``documents`` of the
    sample and a likelihood ratio of ``association`` with the label. ``swap``: weight of the penalty on score changes under swapped identity terms."""

    rows: int = 20_000
    features: int = 4_096
    documents: int = 3
    association: float = 12.0
    swap: float = 1.0
    sparsity: float = 5e-5
    rounds: int = 400


class Model:
    def __init__(self, features: list[bytes], weights: np.ndarray, intercept: float) -> None:
        self.features, self.weights, self.intercept = features, weights, intercept
        self.by_feature = {f: float(w) for f, w in zip(features, weights) if w}

    def score(self, text: str | None) -> float:
        by = self.by_feature
        logit = self.intercept + sum(by[f] for f in features_of(text) if f in by)
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


_IDENTITY = frozenset(t.encode() for t in IDENTITY_TERMS)


def features_of(text: str | None) -> set[bytes]:
    """The distinct words of a text in small letters, and the beginnings of longer words.

    Words that name groups have no beginnings, so that a swap exchanges them entirely."""
    words = set(text.lower().encode().translate(_BREAK).split()) if text else set()
    found = set(words)
    for n in PREFIXES:
        found.update([w[:n] + b"*" for w in words if len(w) > n and w not in _IDENTITY])
    return found


def swapped(features: set[bytes], seed: int) -> set[bytes]:
    """``features`` with each identity term exchanged for another one; ``seed`` draws how far
    the terms are moved along their list."""
    terms = sorted(_IDENTITY)
    step = 1 + seed % (len(terms) - 1)
    moved = {terms[(i + step) % len(terms)] for i, term in enumerate(terms) if term in features}
    return (features - _IDENTITY) | moved


def labelled_sample(docs: DataFrame, labels: DataFrame, fit: Fit) -> DataFrame:
    """(doc_id, text, toxic) of at most ``fit.rows`` labelled doc_ids, one row each; toxic if any
    label says so. Of the rows under one doc_id the text of the smallest hash counts, so that a
    repeated doc_id is no more than one row of the fit.

    The drawn ids, bounded by ``fit.rows``, go to the documents, whose texts stay where they are;
    only those of the sample are shuffled, after each task has kept one per id.
    """
    marked = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    drawn = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.rows).withColumnRenamed("doc_id", "_id")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))
    one = F.min_by(F.struct("text", "toxic"), F.xxhash64("text")).alias("one")
    return found.groupBy("doc_id").agg(one).select("doc_id", "one.text", "one.toxic")


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    """A logistic model over word features of labelled rows.

    Document counts of all features of the sample are made by a distributed aggregation;
    the strongest ``fit.features`` reach the driver, then the sampled rows as lists of those.
    The loss adds, for each row that names a group, the squared change of its score when its
    identity terms are swapped. Without labels of both kinds all scores are the base rate.
    """
    sample = labelled_sample(docs, labels, fit).persist()
    try:
        totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        pos, neg = totals.get(1, 0), totals.get(0, 0)
        if not pos or not neg:
            base = pos / (pos + neg) if pos + neg else 0.0
            return Model([], np.zeros(0), float(np.log((base + 1e-3) / (1 - base + 1e-3))))
        chosen = _strongest(sample, pos, neg, fit)
        vocabulary = sorted(set(chosen) | _IDENTITY)
        rows = _indexed(sample, vocabulary).collect()  # one per drawn id, so fit.rows at most
    finally:
        sample.unpersist()
    weights, intercept = _optimise(rows, len(vocabulary), fit)
    return Model(vocabulary, weights, intercept)


def _strongest(sample: DataFrame, pos: int, neg: int, fit: Fit) -> list[bytes]:
    """Features by their likelihood ratio (G) with the label, strongest first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                seen[1 if toxic else 0].update(features_of(text.as_py()))
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), *(pa.array([seen[k][f] for f in names], pa.int64()) for k in (1, 0))],
                ["feature", "pos", "neg"],
            )

    counted = sample.select("text", "toxic").mapInArrow(count, "feature binary, pos bigint, neg bigint")
    summed = counted.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    n = F.col("pos") + F.col("neg")

    def part(seen, total: int):
        return F.when(seen > 0, seen * F.log(seen * float(pos + neg) / (n * float(total)))).otherwise(0.0)

    g = 2 * (part(F.col("pos"), pos) + part(F.col("neg"), neg))
    g += 2 * (_absent(F.col("pos"), pos, n, pos + neg) + _absent(F.col("neg"), neg, n, pos + neg))
    strong = summed.where(n >= fit.documents).select("feature", g.alias("g")).where(F.col("g") >= fit.association)
    return [bytes(r["feature"]) for r in strong.orderBy(F.desc("g"), "feature").limit(fit.features).collect()]


def _absent(seen, total: int, n, everything: int):
    rest = float(total) - seen
    return F.when(rest > 0, rest * F.log(rest * float(everything) / ((float(everything) - n) * float(total)))).otherwise(0.0)


def _indexed(sample: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Each row as (toxic, its features, what a swap takes away and adds)."""
    number = {f: i for i, f in enumerate(vocabulary)}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, lost, won = [], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                found = features_of(text.as_py())
                other = swapped(found, zlib.crc32(str(doc_id.as_py()).encode()))
                own.append(sorted(number[f] for f in found if f in number))
                lost.append([number[f] for f in found - other if f in number])
                won.append([number[f] for f in other - found if f in number])
            lists = (pa.array(x, pa.list_(pa.int32())) for x in (own, lost, won))
            yield pa.RecordBatch.from_arrays([batch.column(2), *lists], ["toxic", "own", "lost", "won"])

    fields = "toxic int, own array<int>, lost array<int>, won array<int>"
    return sample.select("doc_id", "text", "toxic").mapInArrow(index, fields)


def _optimise(rows: list, size: int, fit: Fit) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient on the mean logistic loss, the swap penalty and an L1 term."""
    y = np.array([1.0 if r["toxic"] else 0.0 for r in rows])

    def sparse(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        return at, np.array([i for x in lists for i in x], dtype=np.int64)

    row, col = sparse([r["own"] for r in rows])
    named = [r for r in rows if r["lost"]]
    lost_row, lost_col = sparse([r["lost"] for r in named])
    won_row, won_col = sparse([r["won"] for r in named])
    n, k = len(y), max(1, len(named))

    def change(w: np.ndarray) -> np.ndarray:
        out = np.bincount(won_row, w[won_col], len(named)) if len(named) else np.zeros(0)
        return out - (np.bincount(lost_row, w[lost_col], len(named)) if len(named) else 0)

    def back(d: np.ndarray) -> np.ndarray:
        if not len(named):
            return np.zeros(size)
        return np.bincount(won_col, d[won_row], size) - np.bincount(lost_col, d[lost_row], size)

    # A curvature bound of its own for each weight (a separable surrogate of the loss), so
    # that rare features move as fast as frequent ones.
    ones = np.bincount(row, minlength=n).astype(float) + 1
    curve = 0.25 / n * np.bincount(col, ones[row], size)
    if len(named):
        lengths = (np.bincount(lost_row, minlength=len(named)) + np.bincount(won_row, minlength=len(named))).astype(float)
        curve += 2 * fit.swap / k * (np.bincount(lost_col, lengths[lost_row], size) + np.bincount(won_col, lengths[won_row], size))
    step, step_b = 1.0 / np.maximum(curve, 1e-12), 1.0 / (0.25 * ones.mean())
    prior = y.mean()
    w, b = np.zeros(size), float(np.log(prior / (1 - prior)))
    v, c, t = w, b, 1.0
    for _ in range(fit.rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, v[col], n) + c, -30, 30)))
        error = (p - y) / n
        slope = np.bincount(col, error[row], size) + back(change(v)) * (2 * fit.swap / k)
        new = v - step * slope
        new = np.sign(new) * np.maximum(0.0, np.abs(new) - step * fit.sparsity)
        new_b = c - step_b * error.sum()
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
    return w, b


def score_texts(docs: DataFrame, model: Model, score: str = "score") -> DataFrame:
    """``docs`` with a toxicity score from 0 to 1 for each whole text.

    Null and empty texts get the score of a text without any feature. Every row and column
    comes back; a column named as ``score`` is replaced. The model, bounded by its feature
    limit, goes to the tasks with the function; there is no shuffle.
    """

    @F.arrow_udf("double")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([model.score(t.as_py()) for t in batch], pa.float64())

    return docs.withColumn(score, rate(F.col("text").cast("string")))
