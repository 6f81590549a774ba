"""Severity of toxic text by cumulative-link ordinal regression over sparse text features (operator 8).

Grades are ordered integers from 0. One weight per word is shared by all thresholds:
P(grade > k) = 1 / (1 + exp(t_k - w.x)), with rising thresholds t_0 < t_1 < ... The features x say which known words
a text holds. Expected severity is the sum of P(grade > k) over k.

The model is fitted on at most about ``per_grade`` labelled documents of each grade, chosen by a hash, in one
task: its input is bounded by that parameter. Words are features when they occur in ``min_documents`` documents
of the sample and their share differs between toxic and other documents beyond chance. Prediction covers every
document and its whole text.

Defined cases: NULL and empty texts have no features and get the severity of the thresholds alone; several
labels of a document count as the highest grade; repeated documents count once in the fit; without labels, or with
a single grade, every severity is that grade (0 without labels).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PENALTY = 3e-4
WORD = re.compile(r"[^\W\d_]+")
MODEL = "word string, weight double, threshold double, lowest long"


def grade(quality: str = "quality", toxic: str = "toxic") -> Column:
    """0: not toxic, 1: toxic, 2: toxic in a document of poor quality."""
    poor = F.when(F.coalesce(F.col(quality), F.lit(1)) == 0, 2).otherwise(1)
    return F.when(F.col(toxic) == 1, poor).otherwise(0)


@dataclass(frozen=True)
class SeverityModel:
    lowest: int
    words: dict[str, float]
    thresholds: tuple[float, ...]  # rising; one less than there are grades


def features(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def _likelihood_ratio(a: int, n1: int, b: int, n0: int) -> float:
    """How much better two shares, a of n1 and b of n0, explain the counts than one share for both."""
    both = (a + b) / (n1 + n0)

    def part(seen: int, n: int) -> float:
        return sum(k * np.log(k / (n * share)) for k, share in ((seen, both), (n - seen, 1 - both)) if k)

    return 2 * (part(a, n1) + part(b, n0))


def fit_weights(
    texts: list[str | None], grades: np.ndarray, min_documents: int = 3, evidence: float = 11.0, steps: int = 400
) -> SeverityModel:
    """Maximum likelihood with a small penalty on the weights, by gradient steps on the sparse features."""
    kinds = np.unique(grades)
    if len(kinds) < 2:
        return SeverityModel(int(kinds[0]) if len(kinds) else 0, {}, ())
    lowest, highest = int(kinds[0]), int(kinds[-1])
    bags = [features(t) for t in texts]
    high = grades > lowest
    among, others = Counter(), Counter()
    for bag, is_high in zip(bags, high):
        (among if is_high else others).update(bag)
    n1, n0 = int(high.sum()), int((~high).sum())
    words = []
    for word in among.keys() | others.keys():
        a, b = among[word], others[word]
        if a + b < min_documents:
            continue
        if _likelihood_ratio(a, n1, b, n0) > evidence:
            words.append(word)
    place = {word: k for k, word in enumerate(sorted(words))}
    rows = np.array([r for r, bag in enumerate(bags) for w in bag if w in place], np.int64)
    cols = np.array([place[w] for bag in bags for w in bag if w in place], np.int64)
    n, levels = len(bags), np.arange(lowest, highest)
    # Toxic and other documents weigh the same in all, so that rare toxic ones are not drowned.
    share = np.where(high, 1 / n1, 1 / n0) / 2
    # Thresholds are a start and positive steps, so that they rise.
    weights, start, steps_log = np.zeros(len(place)), 0.0, np.zeros(len(levels) - 1)
    moments = [np.zeros(len(place) + len(levels)) for _ in range(2)]
    for step in range(1, steps + 1):
        score = np.bincount(rows, weights[cols], n) if len(rows) else np.zeros(n)
        thresholds = start + np.concatenate([[0.0], np.cumsum(np.exp(steps_log))])
        above = 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -35, 35)))
        # Probability of the observed grade as a difference of neighbouring cumulative ones.
        upper = np.concatenate([np.ones((n, 1)), above], axis=1)
        lower = np.concatenate([above, np.zeros((n, 1))], axis=1)
        at = grades - lowest
        up, low = upper[np.arange(n), at], lower[np.arange(n), at]
        p = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p, low * (1 - low) / p  # of the log-likelihood
        w_up, w_low = d_up * share, d_low * share
        d_score = (d_up - d_low) * share
        d_threshold = np.zeros(len(levels))
        for k in range(len(levels)):
            d_threshold[k] = w_low[at == k].sum() - w_up[at == k + 1].sum()
        tails = np.cumsum(d_threshold[::-1])[::-1]
        gradient = np.concatenate([
            (np.bincount(cols, d_score[rows], len(place)) if len(rows) else np.zeros(len(place))) - PENALTY * weights,
            [tails[0]], tails[1:] * np.exp(steps_log),
        ])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        move = 0.1 * moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
        weights += move[: len(place)]
        start += move[len(place)]
        steps_log += move[len(place) + 1 :]
    thresholds = start + np.concatenate([[0.0], np.cumsum(np.exp(steps_log))])
    return SeverityModel(lowest, {w: float(weights[k]) for w, k in place.items()}, tuple(map(float, thresholds)))


def fit(docs: DataFrame, grades: DataFrame, per_grade: int = 4_000) -> SeverityModel:
    """Fit on ``docs`` (doc_id, text) and ``grades`` (doc_id, grade)."""
    labels = (
        grades.select(F.col("doc_id").cast("long"), F.col("grade").cast("long")).dropna()
        .groupBy("doc_id").agg(F.max("grade").alias("grade"))
    )
    counts = {r["grade"]: r["count"] for r in labels.groupBy("grade").count().collect()}  # a row per grade
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col("grade") == value, F.lit(min(1.0, per_grade / n))).otherwise(share)
    chosen = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = pd.concat([*frames]) if frames else pd.DataFrame()
        sample = sample.drop_duplicates(["text", "grade"]) if len(sample) else sample
        if not len(sample):
            return
        model = fit_weights(list(sample["text"]), sample["grade"].to_numpy(np.int64))
        rows = [(None, None, t, model.lowest) for t in model.thresholds] or [(None, None, None, model.lowest)]
        rows += [(word, weight, None, model.lowest) for word, weight in model.words.items()]
        yield pd.DataFrame(rows, columns=["word", "weight", "threshold", "lowest"])

    # The sample's ids are bounded by per_grade, so they can be broadcast.
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    sample = texts.join(F.broadcast(chosen), "doc_id").select("text", "grade").repartition(1)
    rows = sample.sortWithinPartitions(F.xxhash64("text"), "grade").mapInPandas(learn, MODEL).collect()
    lowest = rows[0]["lowest"] if rows else 0
    words = {r["word"]: r["weight"] for r in rows if r["word"] is not None}
    return SeverityModel(lowest, words, tuple(sorted(r["threshold"] for r in rows if r["threshold"] is not None)))


def severity(docs: DataFrame, model: SeverityModel, text: str = "text") -> Column:
    """Struct column: severity (expected grade), grade (most probable), toxic_score (P(grade > lowest))."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        thresholds, known = np.array(m.thresholds), m.words
        sums = np.array([sum(known[w] for w in features(t) if w in known) for t in texts], float)
        above = 1 / (1 + np.exp(np.clip(thresholds[None, :] - sums[:, None], -500, 500)))
        edge = np.concatenate([np.ones((len(sums), 1)), above, np.zeros((len(sums), 1))], axis=1)
        return pd.DataFrame({
            "severity": m.lowest + above.sum(axis=1), "grade": m.lowest + (edge[:, :-1] - edge[:, 1:]).argmax(axis=1),
            "toxic_score": above[:, 0] if len(thresholds) else np.full(len(sums), float(m.lowest > 0)),
        })

    return F.pandas_udf(score, "severity double, grade long, toxic_score double")(F.col(text))


def predict(docs: DataFrame, model: SeverityModel, cut: float = 0.5) -> DataFrame:
    """doc_id, severity, grade, toxic_score, toxic of every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    rows = rows.withColumn("found", severity(rows, model)).select("doc_id", "found.*")
    return rows.withColumn("toxic", F.col("toxic_score") >= cut)
