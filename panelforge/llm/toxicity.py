"""Toxic passages by maximum-scoring segment search.

Every token has a score, its log-odds between toxic and clean documents under an
informative Dirichlet prior taken from all documents: above zero for tokens of toxic
documents, below it for tokens of clean ones. A token whose log-odds cannot be told
from zero takes a little off a segment. One linear scan over a text finds all maximal
segments of high total score. Segment totals of clean text follow an extreme-value law
with parameters lambda and K, which gives the probability of seeing the best r
segments by chance, for every r, and a logistic fit on learnable rows turns that
evidence into a score between 0 and 1.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import held_out, learnable, map_arrow, require, thinned
from panelforge.session import land

#: Bounds of the training sample (rows of each label).
TOXIC_ROWS, CLEAN_ROWS = 6000, 12000
#: Weight of the prior as a share of the sample; least documents of the token's side, log-odds and z, of either sign, of a scored token.
PRIOR_SHARE, LEAST_DOCUMENTS, LEAST_ODDS, LEAST_Z = 0.1, 2, 1.5, 2.5
#: Tokens that a task counts before it passes their counts on.
TOKENS_HELD = 100_000
#: Parts of the sample; evidence for the logistic fit comes from tokens learned on the other parts.
FOLDS = 4
#: What a token without a score takes off a segment.
GAP_COST = 0.05
#: The sum statistic holds for sums of at least this much for each segment beyond the first.
SUM_HOLDS = 8.0
#: Chance probability below which a single segment is reported as a passage.
SIGNIFICANT = 0.01
#: Evidence beyond this counts as this much.
MOST_EVIDENCE = 40.0
WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    """Lower-case runs of letters."""

    return WORD.findall((text or "").lower())


def segments(hits: list[tuple[int, float]], gap: float = GAP_COST) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first token, last token) of a text.

    ``hits`` are the scored tokens (position, score) in order; every token between them
    scores ``-gap``. Linear time: each candidate remembers the nearest earlier one that
    begins lower, and is dropped when it is merged.
    """

    found: list[tuple[float, float, int, int, int]] = []  # sum before, sum after, first, last, link
    total, position = 0.0, -1
    for at, score in hits:
        total -= gap * (at - position - 1)
        position = at
        if score <= 0:
            total += score
            continue
        low, first = total, at
        total += score
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= low:
                j = found[j][4]
            if j < 0 or found[j][1] >= total:
                found.append((low, total, first, at, j))
                break
            low, first = found[j][0], found[j][2]
            del found[j:]
    return [(after - before, first, last) for before, after, first, last, _ in found]


@dataclass
class ToxicityModel:
    """Token scores, extreme-value parameters and the logistic fit."""

    scores: dict[str, float]
    rate: float = 1.0  # lambda
    scale: float = 1.0  # K
    slope: float = 0.0
    offset: float = -50.0

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        get = self.scores.get
        return [(i, s) for i, w in enumerate(words) if (s := get(w)) is not None]

    def surprise(self, score: float, length: int) -> float:
        """Minus the logarithm of the chance that a clean text of that length has such a segment."""

        expected = self.scale * max(length, 1) * math.exp(-min(self.rate * score, 700.0))
        return -math.log(max(-math.expm1(-expected), 1e-300))

    def evidence(self, scores: list[float], length: int) -> float:
        """Minus the logarithm of the least chance probability of the best r segments, r = 1, 2, ... all.

        The number of segments of a clean text that reach a score is Poisson, so seeing r of
        them has at most the probability of Chernoff's bound. Where the sum of the r scores
        is large for their number, its own law tells more.
        """

        best, total = 0.0, 0.0
        for r, score in enumerate(sorted(scores, reverse=True), 1):
            above = self.rate * score - math.log(self.scale * max(length, 1))
            total += above
            gains = [0.0]
            if math.log(r) + above > 0:  # more than the exp(-above) to be expected
                gains.append(r * (math.log(r) + above - 1) + math.exp(-above))
            if total > 0 and total >= SUM_HOLDS * (r - 1):
                gains.append(total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r))
            best = max(best, max(gains) - r * math.log(2))  # allows for trying several r
        return best

    def judge(self, text: str | None) -> tuple[float, float, list[tuple[int, int, float]]]:
        """Score, evidence and significant passages (first token, last token, segment score)."""

        words = tokens(text)
        found = segments(self.hits(words))
        evidence = self.evidence([s for s, _, _ in found], len(words))
        passages = [
            (first, last, s) for s, first, last in found if self.surprise(s, len(words)) > -math.log(SIGNIFICANT)
        ]
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.slope * min(evidence, MOST_EVIDENCE) + self.offset)))), evidence, passages


def _family(words: list[str]) -> int:
    """The least hash of the text's word triples; copies and near copies mostly share it."""

    triples = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    return min((xxhash.xxh64_intdigest(t, 11) >> 1 for t in triples), default=0)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str
) -> DataFrame:
    """(id, toxic, family, words, text) of a bounded sample, one row per family of near copies.

    The sample holds, of each label, the learnable rows with the smallest id hash. Copies
    would make chance words look telling, so one of each family is kept. It is stored.
    """

    known = (
        labels.where(learnable(id_column) & F.col(label_column).isin(0, 1))
        .groupBy(F.col(id_column).alias("id"))
        .agg(F.max(F.col(label_column).cast("int")).alias("toxic"))
    )
    order = [F.xxhash64("id"), F.col("id")]
    sizes = Counter({r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()})
    picked = [
        row
        for label, limit in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))
        for row in known.where((F.col("toxic") == label) & thinned(F.col("id"), sizes[label], limit))
        .orderBy(*order).limit(limit).collect()
    ]
    ids = docs.sparkSession.createDataFrame(picked, known.schema)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).join(
        F.broadcast(ids), "id"  # at most TOXIC_ROWS + CLEAN_ROWS ids
    )

    def add_family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [tokens(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("toxic"), pa.array([_family(w) for w in words], pa.int64()),
                    pa.array([sorted(set(w)) for w in words], pa.list_(pa.string())), batch.column("text"),
                ],
                names=["id", "toxic", "family", "words", "text"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    told = map_arrow(rows, add_family, f"id {kind}, toxic int, family bigint, words array<string>, text string")
    first = F.min(F.struct("id", "text", "toxic", "words")).alias("row")
    return land(told.groupBy("family").agg(first).select("family", "row.*"), "toxicity-sample")


def _document_counts(docs: DataFrame, text_column: str) -> DataFrame:
    """(token, n): in how many of all documents each token occurs."""

    def flush(found: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["token", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(set(tokens(text)))
                if len(found) >= TOKENS_HELD:
                    yield flush(found)
                    found.clear()
        yield flush(found)

    counts = map_arrow(docs.select(F.col(text_column).cast("string")), count, "token string, n bigint")
    return counts.groupBy("token").agg(F.sum("n").alias("n"))


def _token_score(y1: Column, y0: Column, share: Column, toxic: int, clean: int) -> Column:
    """Log-odds of a token in ``y1`` of ``toxic`` and ``y0`` of ``clean`` documents; null if it cannot be told from zero.

    ``share`` of all documents hold the token; the prior has that share of ``PRIOR_SHARE`` of the sample.
    """

    weight = PRIOR_SHARE * (toxic + clean)
    a, b = y1 + share * weight, y0 + share * weight
    odds = F.log(a / F.greatest(toxic + weight - a, F.lit(0.5))) - F.log(b / F.greatest(clean + weight - b, F.lit(0.5)))
    told = (F.abs(odds) >= LEAST_ODDS) & (F.abs(odds) / F.sqrt(1 / a + 1 / b) >= LEAST_Z)
    return F.when(told & (F.when(odds > 0, y1).otherwise(y0) >= LEAST_DOCUMENTS), odds)


def _extreme_value(rows: list[tuple[int, list[tuple[int, float]]]]) -> tuple[float, float]:
    """lambda and K from the scored tokens of clean texts, given as (number of tokens, hits).

    lambda makes the mean of exp(lambda * token score) one. K matches the share of
    clean texts whose best segment reaches the median hit.
    """

    values: Counter[float] = Counter()
    for length, hits in rows:
        values.update(round(s, 2) for _, s in hits)
        values[-GAP_COST] += length - len(hits)
    hit_scores = [v for v in values.elements() if v > 0] or [3.0]
    s = np.array([*values, max(hit_scores)])
    p = np.array([*values.values(), 1.0])
    p /= p.sum()  # with one more hit, so that a root exists
    low, high = 0.0, 50.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if float((p * np.exp(np.minimum(middle * s, 600))).sum()) < 1 else (low, middle)
    rate = min(max(low, 0.1), 5.0)
    typical = float(np.median(hit_scores))
    best = [max((x for x, _, _ in segments(hits)), default=0.0) for _, hits in rows]
    share = (sum(x >= typical for x in best) + 0.5) / (len(best) + 1)
    mean = float(np.mean([max(1, n) for n, _ in rows])) if rows else 1.0
    return rate, min(max(-math.log1p(-min(share, 0.99)) * math.exp(rate * typical) / mean, 1e-6), 1e3)


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic"
) -> ToxicityModel:
    """Learn from the learnable labelled rows; without rows of both labels every score is near 0."""

    sample = labelled_sample(docs, labels, id_column, text_column, label_column).withColumn(
        "fold", F.pmod(F.xxhash64("family"), F.lit(FOLDS)).cast("int")
    )
    sizes = Counter({(r["fold"], r["toxic"]): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()})
    toxic, clean = (sum(sizes[f, y] for f in range(FOLDS)) for y in (1, 0))
    model = ToxicityModel({})
    if not toxic or not clean:
        return model
    per_fold = [
        F.count_if((F.col("toxic") == y) & (F.col("fold") == f)).alias(f"y{y}_{f}") for y in (1, 0) for f in range(FOLDS)
    ]
    counted = (
        sample.select("toxic", "fold", F.explode("words").alias("token"))
        .groupBy("token")
        .agg(F.sum("toxic").alias("y1"), F.count_if(F.col("toxic") == 0).alias("y0"), *per_fold)
        .where(F.greatest("y1", "y0") >= LEAST_DOCUMENTS)
        .join(_document_counts(docs, text_column), "token")
    )
    share = F.greatest("n", F.lit(0.5)) / max(1, docs.count())
    scored = counted.select(
        "token", _token_score(F.col("y1"), F.col("y0"), share, toxic, clean).alias("all"),
        *[
            _token_score(
                F.col("y1") - F.col(f"y1_{f}"), F.col("y0") - F.col(f"y0_{f}"), share,
                toxic - sizes[f, 1], clean - sizes[f, 0],
            ).alias(f"without_{f}")
            for f in range(FOLDS)
        ],
    )
    names = scored.columns[1:]
    told = scored.where(F.coalesce(*names).isNotNull()).collect()  # telling tokens of a bounded sample
    model.scores, *others = ({r["token"]: r[n] for r in told if r[n] is not None} for n in names)
    others = [ToxicityModel(scores) for scores in others]

    def hits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [tokens(t) for t in batch.column("text").to_pylist()]
            hits = [others[f].hits(w) for f, w in zip(batch.column("fold").to_pylist(), words)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic"), pa.array([len(w) for w in words], pa.int32()),
                    pa.array([[i for i, _ in h] for h in hits], pa.list_(pa.int32())),
                    pa.array([[s for _, s in h] for h in hits], pa.list_(pa.float64())),
                ],
                names=["toxic", "size", "at", "scores"],
            )

    found = map_arrow(
        sample.select("toxic", "fold", "text"), hits_of, "toxic int, size int, at array<int>, scores array<double>"
    ).collect()  # the hits of a bounded sample
    rows = sorted((r["toxic"], r["size"], list(zip(r["at"], r["scores"]))) for r in found)
    model.rate, model.scale = _extreme_value([(n, h) for y, n, h in rows if not y])
    x = np.array([model.evidence([s for s, _, _ in segments(h)], n) for _, n, h in rows])
    model.slope, model.offset = _logistic(np.minimum(x, MOST_EVIDENCE), np.array([y for y, _, _ in rows], dtype=float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of a lightly damped logistic fit, by Newton steps."""

    design = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - p) - 1e-2 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(w[0]), 0.0), float(w[1])


def score_texts(
    docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: id, ``score``, ``evidence`` and ``passages`` (first and last token, score).

    Null and empty texts have no evidence and get the score of a text without hits.
    Nothing but the text reaches the model; repeated rows each get a row.
    """

    require(docs, id_column, text_column)
    kind = docs.schema[id_column].dataType.simpleString()
    passage = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [model.judge(t) for t in batch.column(1).to_pylist()]
            spans = [[{"first": a, "last": b, "score": s} for a, b, s in j[2]] for j in judged]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([j[0] for j in judged], pa.float64()),
                    pa.array([j[1] for j in judged], pa.float64()), pa.array(spans, pa.list_(passage)),
                ],
                names=["id", "score", "evidence", "passages"],
            )

    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return map_arrow(
        picked, run, f"id {kind}, score double, evidence double, passages array<struct<first: int, last: int, score: double>>"
    ).withColumnRenamed("id", id_column)


def toxic_documents(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", threshold: float = 0.7,
) -> DataFrame:
    """Learn, then score every document: id, ``held_out``, ``score``, ``predicted``, evidence and passages."""

    require(labels, id_column, label_column)
    model = fit(docs, labels, id_column, text_column, label_column)
    return score_texts(docs, model, id_column, text_column).select(
        id_column, held_out(id_column).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence", "passages",
    )
