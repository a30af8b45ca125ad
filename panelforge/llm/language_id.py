"""Language identification with a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.byte_gru import ByteGru, train
from panelforge.llm.common import filter_rows, held_out, learnable, map_arrow, require, slices, text_views

#: Bounds of the training sample: documents of a language, characters of a document, windows of it, bytes in one.
DOCUMENTS, EXTRACT, WINDOWS, STEPS = 300, 1500, 6, 64
#: Parts of a language that are searched for the smallest hashes side by side.
PARTS = 64
#: A document whose best language has a lower mean probability is rejected by the pipeline.
REJECT_BELOW = 0.4


def training_sample(df: DataFrame, id_column: str, text_column: str, lang_column: str) -> list[tuple[str, str]]:
    """(language, extract) of the ``DOCUMENTS`` learnable rows with the smallest id hash of each language.

    Every label of a learnable row with a letter counts as a language, however rare. Ids are
    picked first; only the picked rows' texts are read, at most ``DOCUMENTS`` extracts a language.
    """

    labelled = df.where(
        learnable(id_column) & F.col(lang_column).isNotNull() & F.col(text_column).rlike(r"\p{L}")
    ).select(F.col(id_column).alias("id"), F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"))
    # The smallest hashes of each of a few parts of a language, then of those the smallest: a
    # frequent language is not gathered in one task.
    place = F.xxhash64("id")
    within = Window.partitionBy("lang", "part").orderBy("place", "id")
    overall = Window.partitionBy("lang").orderBy("place", "id")
    picked = (
        labelled.select("id", "lang", place.alias("place"), F.pmod(place, F.lit(PARTS)).alias("part"))
        .withColumn("nth", F.row_number().over(within)).where(F.col("nth") <= DOCUMENTS)
        .withColumn("nth", F.row_number().over(overall)).where(F.col("nth") <= DOCUMENTS)
        .select("id", "lang")
        .collect()
    )
    ids = df.sparkSession.createDataFrame(picked, labelled.select("id", "lang").schema).distinct()
    start = F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.lit(1), F.char_length("text") - EXTRACT)).cast("int")
    rows = (
        labelled.join(ids, ["id", "lang"])  # Spark knows how many ids there are
        .select("id", "lang", F.lower(F.substring("text", start + 1, F.lit(EXTRACT))).alias("text"))
        .groupBy("id", "lang").agg(F.min("text").alias("text"))  # one of the rows that share an id
    )
    return sorted((r["lang"], r["text"]) for r in rows.collect())


def fit(sample: list[tuple[str, str]], seed: int = 7) -> ByteGru | None:
    """A trained network, or None without examples."""

    labels = sorted({lang for lang, _ in sample})
    if not labels:
        return None
    random = np.random.default_rng(seed)
    windows, target = [], []
    for lang, text in sample:
        data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
        for _ in range(WINDOWS):
            start = int(random.integers(0, max(1, len(data) - STEPS + 1)))
            piece = data[start : start + STEPS]
            windows.append(np.resize(piece, STEPS) if len(piece) else np.zeros(STEPS, np.uint8))
            target.append(labels.index(lang))
    return train(np.stack(windows), np.array(target), labels, seed=seed)


def _judge(model: ByteGru | None, letters: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Label and score of each text of a batch."""

    data, bounds = text_views(text)
    best = np.full(len(text), -1)
    score = np.zeros(len(text))
    for low, high in slices(bounds) if model is not None else ():
        pooled = model.pooled(data, bounds[low : high + 1])
        best[low:high] = pooled.argmax(axis=1)
        score[low:high] = pooled.max(axis=1)
    best = np.where(letters.to_numpy(zero_copy_only=False), best, -1)
    names = np.array([*(model.labels if model else []), "und"], dtype=object)
    return names[best], np.where(best >= 0, score, 0.0).clip(0, 1)


def _inputs(text_column: str) -> dict[str, Column]:
    text = F.col(text_column).cast("string")
    return {"letters": F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), "text": F.lower(text)}


def predict_languages(df: DataFrame, model: ByteGru | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: the id, ``lang_pred`` and ``score``, over every byte of the text.

    The score is the mean, over all positions, of the probability of the language
    with the highest mean; ties go to the first label in sorted order. Null text and text
    without a letter give ``und`` with score 0, as does a missing model. Ids and other
    columns never reach the model; repeated rows each get a row.
    """

    require(df, id_column, text_column)
    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("id"), *[c.alias(n) for n, c in _inputs(text_column).items()])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, score = _judge(model, batch.column(1), batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(label, pa.string()), pa.array(score)], names=["id", "lang_pred", "score"]
            )

    return map_arrow(rows, predict, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_column)


def identify(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """Train on the learnable rows, predict all: id, ``held_out``, ``lang_pred``, ``score``."""

    require(df, id_column, text_column, lang_column)
    model = fit(training_sample(df, id_column, text_column, lang_column))
    found = predict_languages(df, model, id_column, text_column)
    return found.select(id_column, held_out(id_column).alias("held_out"), "lang_pred", "score")


def keep_identified(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """The rows with a language: not ``und`` and scored at least ``REJECT_BELOW``, with all columns.

    Without any labelled row there is no model, and every row with a letter stays.
    """

    require(df, id_column, text_column, lang_column)
    model = fit(training_sample(df, id_column, text_column, lang_column))

    def known(letters: pa.Array, text: pa.Array) -> np.ndarray:
        if model is None:
            return letters.to_numpy(zero_copy_only=False)
        label, score = _judge(model, letters, text)
        return (label != "und") & (score >= REJECT_BELOW)

    return filter_rows(df, _inputs(text_column), known)
