"""Exact deduplication by deterministic block naming.

A text (``A-Z`` lower-cased, nothing else changed) is cut into blocks of ``block_bytes``. Equal blocks get the
same integer name, different blocks different ones: blocks are dealt to buckets by hash and numbered in sorted
order inside each bucket, comparing whole contents. Then adjacent names are paired and the pairs named the same
way, until each document has one name. Two documents have the same (level, name) exactly if their texts are
equal; no digest decides.

Hot blocks: each batch of documents first replaces its blocks by a local dictionary, so a block reaches the
shuffle once per batch however often it occurs. Pair names are found on distinct pairs and joined back, where
AQE splits hot pairs. Whole texts are shuffled once (their distinct blocks), never collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.llm.common import checkpointed, releasing, with_row_id

BLOCK_BYTES = 4096
#: Buckets of the naming sort: many, so that each holds few blocks at any size of corpus.
BUCKETS = 1 << 20

_BLOCKS = pa.schema([("chunk", pa.int64()), ("local", pa.int32()), ("block", pa.binary())])
_ROWS = pa.schema([("chunk", pa.int64()), ("row_id", pa.int64()), ("doc_id", pa.int64()),
                   ("text_sha256", pa.string()), ("blocks", pa.list_(pa.int32()))])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, list[bytes]]]:
    """Batches with normalised texts and a number that depends on place and content."""
    part = TaskContext.get().partitionId()
    for at, batch in enumerate(batches):
        texts = [b"" if t is None else t.lower() for t in batch.column("text").cast(pa.binary()).to_pylist()]
        mark = xxhash.xxh3_64(f"{part}:{at}:{len(texts)}:".encode())
        for row, text in zip(batch.column("row_id").to_pylist(), texts):
            mark.update(f"{row}:{len(text)}:".encode())
            mark.update(text)
        yield mark.intdigest() - (1 << 63), batch, texts


def _local_names(texts: list[bytes], size: int) -> tuple[dict[bytes, int], list[list[int]]]:
    names: dict[bytes, int] = {}
    return names, [[names.setdefault(t[i:i + size], len(names)) for i in range(0, max(1, len(t)), size)]
                   for t in texts]


def _dictionary(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for chunk, _, texts in _chunks(batches):
        blocks = list(_local_names(texts, size)[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk] * len(blocks), pa.int64()), pa.array(range(len(blocks)), pa.int32()),
             pa.array(blocks, pa.binary())], schema=_BLOCKS)


def _rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for chunk, batch, texts in _chunks(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk] * len(texts), pa.int64()), batch.column("row_id"), batch.column("doc_id"),
             pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
             pa.array(_local_names(texts, size)[1], _ROWS.field("blocks").type)], schema=_ROWS)


def _named(items: DataFrame, *key: str) -> DataFrame:
    """Integer names in the sorted order of ``key``, the same for equal keys."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*key))
    return items.withColumn("bucket", bucket).withColumn(
        "name", F.shiftleft("bucket", 40) + rank).drop("bucket")


def _gathered(items: DataFrame, expected: Column) -> DataFrame:
    """One row per document with its names in order. A missing name means that ``docs`` was not stored."""
    whole = items.groupBy("row_id").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_sha256").alias("text_sha256"), F.first(expected).alias("n"),
        F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("names"))
    names = F.when(F.size("names") == F.col("n"), F.col("names.name")).otherwise(
        F.raise_error(F.lit("the documents changed between two reads: store them first")))
    return checkpointed(whole.select("row_id", "doc_id", "text_sha256", names.alias("names")))


def document_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str, DataFrame]:
    """Identities of all rows: ``row_id, doc_id, text_sha256, level, name``.

    Also returns ``docs`` with its row number and the name of that column. ``docs`` has to be a stored table."""
    rows, row_id = with_row_id(docs)
    source = rows.select(F.col(row_id).alias("row_id"), F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).cast("string").alias("text"))
    blocks = source.mapInArrow(releasing(_dictionary, size=block_bytes), "chunk long, local int, block binary")
    names = _named(blocks, "block").select("chunk", "local", "name")
    placed = source.mapInArrow(
        releasing(_rows, size=block_bytes),
        "chunk long, row_id long, doc_id long, text_sha256 string, blocks array<int>",
    ).select("chunk", "row_id", "doc_id", "text_sha256", F.size("blocks").alias("n"),
             F.posexplode("blocks").alias("pos", "local"))
    state = _gathered(placed.join(names, ["chunk", "local"]), F.col("n"))
    done, level = [], 0
    longest = state.agg(F.max(F.size("names"))).first()[0] or 1
    while True:
        done.append(state.where(F.size("names") == 1).select(
            "row_id", "doc_id", "text_sha256", F.lit(level).alias("level"), F.col("names")[0].alias("name")))
        if longest <= 1:
            break
        pair = F.transform(
            F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int")),
            lambda i: F.struct(F.get("names", 2 * i).alias("left"),
                               F.coalesce(F.get("names", 2 * i + 1), F.lit(-1)).alias("right")))
        pairs = state.where(F.size("names") > 1).select(
            "row_id", "doc_id", "text_sha256", F.ceil(F.size("names") / 2).alias("n"),
            F.posexplode(pair).alias("pos", "pair")).select("*", "pair.*").drop("pair")
        named = _named(pairs.select("left", "right").distinct(), "left", "right")
        state = _gathered(pairs.join(named, ["left", "right"]), F.col("n"))
        longest, level = (longest + 1) // 2, level + 1
    identities = done[0]
    for part in done[1:]:
        identities = identities.unionByName(part)
    return rows, row_id, identities


def _verdicts(identities: DataFrame) -> DataFrame:
    groups = identities.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "row_id")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    return identities.join(groups, ["level", "name"])


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest id stays (null ids last; of repeated rows with the same id exactly
    one). Null text counts as empty, all empty texts are equal. An empty table gives no rows. Other columns of
    ``docs`` are not read, whatever their names."""
    _, _, identities = document_names(docs, id_col, text_col, block_bytes)
    return _verdicts(identities).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("keep.row_id") == F.col("row_id")).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (a stored table) with one row of each group of equal texts, all columns as they are."""
    rows, row_id, identities = document_names(docs, id_col, text_col, block_bytes)
    kept = _verdicts(identities).where(F.col("keep.row_id") == F.col("row_id")).select(F.col("row_id").alias(row_id))
    return rows.join(kept, row_id, "left_semi").drop(row_id)
