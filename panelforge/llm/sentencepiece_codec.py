"""SentencePiece encoding and decoding of a table of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import map_arrow, release_memory, require, slices, text_views
from panelforge.llm.piece_viterbi import PieceModel, load_model

#: Default vocabulary file of a public tokenizer; callers may name another.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text whose distinct parts are segmented together; a longer text is a step of its own.
STEP_BYTES = 2 << 20
#: Rows of token ids that are decoded at a time.
STEP_ROWS = 512

_models: dict[str, PieceModel] = {}


def shared_model(path: str) -> PieceModel:
    """The model of a path, built once per process, with its memory of words."""

    if path not in _models:
        _models[path] = load_model(path)
    return _models[path]


def encode_texts(
    df: DataFrame, text_column: str = "text", model_path: str = MODEL_PATH, ids: str = "ids",
    count: str = "n_tokens", intact: str = "round_trip",
) -> DataFrame:
    """``df`` with three more columns: token ids, their number, and whether decoding gives the text back.

    Null counts as empty and has no tokens. The space mark U+2581 is read as a space, so a
    text that holds one does not come back. An existing column of one of the three names is
    replaced. Rows are encoded where they are; nothing is shuffled. The model file must lie
    at ``model_path`` on every executor.
    """

    require(df, text_column)
    if text_column in (ids, count, intact):
        raise ValueError("the text column would be replaced")
    kept = df.drop(*[c for c in (ids, count, intact) if c in df.columns])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    position = kept.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from encoded(batches)
        finally:
            release_memory()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_model(model_path)
        for whole in batches:
            for low, high in slices(text_views(whole.column(position))[1], STEP_BYTES):
                batch = whole.slice(low, high - low)
                texts = [text or "" for text in batch.column(position).to_pylist()]
                flat, bounds = model.encode_all(texts)
                places = bounds.tolist()
                same = [model.decode(flat[a:b].tolist()) == t for t, a, b in zip(texts, places, places[1:])]
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, lists, pa.array(np.diff(bounds).astype(np.int32)), pa.array(same)],
                    names=[*batch.schema.names, ids, count, intact],
                )

    return map_arrow(kept, run, f"{schema}, `{ids}` array<int>, `{count}` int, `{intact}` boolean")


def decode_texts(df: DataFrame, ids: str = "ids", text: str = "text", model_path: str = MODEL_PATH) -> DataFrame:
    """``df`` with a column ``text`` decoded from token ids; null ids give null, no ids an empty text."""

    require(df, ids)

    kept = df.drop(text) if text in df.columns else df
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    position = kept.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_model(model_path)
        for whole in batches:
            for low in range(0, whole.num_rows, STEP_ROWS):
                batch = whole.slice(low, STEP_ROWS)
                found = [None if x is None else model.decode(x) for x in batch.column(position).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, text]
                )

    return map_arrow(kept, run, f"{schema}, `{text}` string")


def token_ids(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", model_path: str = MODEL_PATH) -> DataFrame:
    """Id, ``n_tokens``, ``round_trip`` and ``ids`` of each row."""

    require(df, id_column, text_column)
    picked = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    found = encode_texts(picked, "text", model_path)
    return found.select(F.col("id").alias(id_column), "n_tokens", "round_trip", "ids")
