"""Token counts from flat token files without an index.

A flat token file holds the token ids of many documents one after the other, two
or four bytes each, every document closed by the end-of-document id. Files are cut
into blocks of fixed size. Each block is searched for the separator in one
vectorised comparison; where a document begins in one block and ends in a later
one, a prefix scan over one summary row per block supplies the missing begin and
the number of documents before the block. Blocks are independent tasks, so one
huge file is read in parallel.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.llm.common import map_arrow, require
from panelforge.session import land, work_dir

#: Vocabulary file of a public tokenizer, and the free id that closes a document.
RANKS_PATH, END_OF_DOCUMENT = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken", 50256
#: The published split pattern of that tokenizer family (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Tokens of a block; blocks that the first level of the prefix scan takes together.
BLOCK_TOKENS, SCAN_BLOCKS = 1 << 20, 1024


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The byte-level tokenizer of a rank file, built once per process."""

    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("flat-files", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it."""

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_token_files(
    docs: DataFrame, folder: str, id_column: str = "doc_id", text_column: str = "text", ranks_path: str = RANKS_PATH,
    end: int = END_OF_DOCUMENT, width: int = 2,
) -> DataFrame:
    """Tokenize texts into one flat file per task below ``folder``; returns the stored manifest (file, ordinal, id).

    A file appears under its name only when it is complete, so a repeated task replaces it
    with the same content. Null counts as empty: just the closing id. The folder must be
    reachable from all executors.
    """

    require(docs, id_column, text_column)
    kind = docs.schema[id_column].dataType.simpleString()
    dtype = np.dtype("<u2" if width == 2 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}.bin"
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        draft = f"{root}/_{name}-{task.taskAttemptId()}"
        encode, closing, ordinal = tokenizer(ranks_path).encode_ordinary, np.array([end], dtype), 0
        with store.open_output_stream(draft) as out:
            for batch in batches:
                for text in batch.column(1).to_pylist():
                    out.write(np.array(encode(text or ""), dtype).tobytes())
                    out.write(closing.tobytes())
                numbers = np.arange(ordinal, ordinal + batch.num_rows)
                ordinal += batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * batch.num_rows, pa.string()), pa.array(numbers), batch.column(0)],
                    names=["file", "ordinal", "id"],
                )
        if ordinal:
            store.move(draft, f"{root}/{name}")
        else:
            store.delete_file(draft)

    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string"))
    return land(map_arrow(picked, run, f"file string, ordinal bigint, id {kind}"), "token-manifest")


def _file_blocks(spark: SparkSession, folder: str, block_tokens: int, width: int) -> DataFrame:
    """(file, block, tokens) of the ``*.bin`` files of a folder; only their lengths are read."""

    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), F.expr(f"length div {width}").alias("size"))
        .where("size > 0")
    )
    blocks = files.select(
        "file", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(size - 1) div {block_tokens}"))).alias("block")
    )
    tokens = F.least(F.lit(block_tokens), F.col("size") - F.col("block") * block_tokens)
    return blocks.select("file", "block", tokens.cast("int").alias("tokens")).repartition("file", "block")


def _search_blocks(folder: str, end: int, block_tokens: int, width: int):
    dtype = np.dtype("<u2" if width == 2 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for batch in batches:
            for file, block, tokens in zip(*[batch.column(n).to_pylist() for n in ("file", "block", "tokens")]):
                begin = block * block_tokens
                with store.open_input_file(f"{root}/{file}") as source:
                    found = np.frombuffer(source.read_at(tokens * width, begin * width), dtype)
                at = np.flatnonzero(found == end) + begin
                lengths = np.diff(at, prepend=-1) - 1  # the first is settled by the scan
                size = len(at) + 1
                # The last row is the block's summary: its separators, the last of them, and its end.
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file] * size, pa.string()), pa.array(np.full(size, block, np.int64)),
                        pa.array(np.append(np.arange(len(at)), -1)), pa.array(np.append(lengths, len(at))),
                        pa.array(np.append(at, at[-1] if len(at) else -1)),
                        pa.array(np.append(np.full(len(at), -1), begin + tokens)),
                    ],
                    names=["file", "block", "nth", "n", "at", "stop"],
                )

    return run


def prefix_scan(summaries: DataFrame) -> DataFrame:
    """Per block the documents closed before it (``base``) and the last separator before it (``carry``, -1 if none).

    Two levels: blocks are scanned within groups of ``SCAN_BLOCKS``, and one row per group
    is scanned per file, so no task holds more than a group or one file's groups.
    """

    grouped = summaries.withColumn("wide", F.floor(F.col("block") / SCAN_BLOCKS))
    inside = Window.partitionBy("file", "wide").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("file").orderBy("wide").rowsBetween(Window.unboundedPreceding, -1)
    wide = (
        grouped.groupBy("file", "wide")
        .agg(F.sum("n").alias("n"), F.max("at").alias("at"), F.max("block").alias("top"))
        .select(
            "file", "wide", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("wide_base"),
            F.coalesce(F.max("at").over(across), F.lit(-1)).alias("wide_carry"),
            (F.max("wide").over(Window.partitionBy("file")) == F.col("wide")).alias("last_wide"), "top",
        )
    )
    return (
        grouped.select(
            "file", "wide", "block", "stop", "n", "at", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("b"),
            F.coalesce(F.max("at").over(inside), F.lit(-1)).alias("c"),
        )
        .join(wide, ["file", "wide"])
        .select(
            "file", "block", "stop", "n", "at", (F.col("wide_base") + F.col("b")).alias("base"),
            F.greatest("wide_carry", "c").alias("carry"),
            (F.col("last_wide") & (F.col("block") == F.col("top"))).alias("final"),
        )
    )


def count_tokens(
    spark: SparkSession, folder: str, end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS, width: int = 2
) -> DataFrame:
    """``file``, ``ordinal`` (from 0) and ``n_tokens`` of every document in the flat files of a folder.

    The closing id does not count. Adjacent closing ids are empty documents. Tokens after
    the last closing id of a file are a document of their own. Empty files have none, and
    a trailing part of a token is ignored.
    """

    blocks = _file_blocks(spark, folder, block_tokens, width)
    found = land(
        map_arrow(
            blocks, _search_blocks(folder, end, block_tokens, width),
            "file string, block bigint, nth bigint, n bigint, at bigint, stop bigint",
        ),
        "separators",
    )
    scan = land(prefix_scan(found.where("nth < 0").select("file", "block", "n", "at", "stop")), "block-scan")
    closed = (
        found.where("nth >= 0")
        .join(scan.select("file", "block", "base", "carry"), ["file", "block"])
        .select(
            "file", (F.col("base") + F.col("nth")).alias("ordinal"),
            F.when(F.col("nth") == 0, F.col("at") - F.col("carry") - 1).otherwise(F.col("n")).alias("n_tokens"),
        )
    )
    last = F.greatest("carry", "at")
    open_end = scan.where(F.col("final") & (F.col("stop") - 1 > last)).select(
        "file", (F.col("base") + F.col("n")).alias("ordinal"), (F.col("stop") - 1 - last).alias("n_tokens")
    )
    return closed.unionByName(open_end)


def document_token_counts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", ranks_path: str = RANKS_PATH,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Write the texts as flat token files, count by scanning the files, and name the documents again.

    One row per input row: id, ``n_tokens``, ``file``, ``ordinal``. An empty table gives an empty result.
    """

    spark = docs.sparkSession
    folder = f"{work_dir(spark, 'token-files')}"
    manifest = write_token_files(docs, folder, id_column, text_column, ranks_path)
    kind = docs.schema[id_column].dataType.simpleString()
    if manifest.isEmpty():
        return spark.createDataFrame([], f"`{id_column}` {kind}, n_tokens bigint, file string, ordinal bigint")
    counts = count_tokens(spark, folder, block_tokens=block_tokens)
    return manifest.join(counts, ["file", "ordinal"]).select(
        F.col("id").alias(id_column), "n_tokens", "file", "ordinal"
    )
