"""Token shards in training order.

Every document reserves as many numbers as it can have sequences of ``seq_tokens`` tokens (from its bytes, so the
texts are tokenised once). A keyed Feistel permutation of [0, all numbers), walking the cycle while a value falls
outside, scatters the numbers; their order is the training order. Range partitions of equal width become shards:
records of one fixed length, sorted, gaps closed. The global slot of a record is its place over all shards; the
manifest (records per shard, from the file sizes) gives slot s its shard and byte offset, so a run can resume
anywhere by seeking.

The records are shuffled once, straight to their shards, and written by Spark's own writer, so a lost executor's
shards are written again. The permutation spreads every source and long document evenly over the shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardlens.llm.tokens import default_tokenizer, document_tokens

SEQ_TOKENS = 512
#: Bytes of text for each shard, on average.
SHARD_BYTES = 64 << 20
ROUNDS = 6
#: Words that a worker remembers (see ``tokens``): this job holds little else.
CACHE_WORDS = 280_000
#: A byte of text gives three tokens at most: lower case and normalising can lengthen a character that much.
TOKENS_PER_BYTE = 3
#: Before the tokens of a record: scattered number and document (signed 64 bits), shard, piece and length (signed 32).
HEADER = np.dtype([("number", "<i8"), ("doc_id", "<i8"), ("shard", "<i4"), ("piece", "<i4"), ("length", "<i4")])
#: Stands for a null document id in a record.
NO_ID = -(1 << 63)

RECORD = "number long, doc_id long, shard int, piece int, length int, ids_crc32 long"


def stride(seq_tokens: int = SEQ_TOKENS) -> int:
    """Bytes of a record: header, 16-bit tokens, line end."""
    return HEADER.itemsize + 2 * seq_tokens + 1


class Feistel:
    """A keyed permutation of [0, n)."""

    def __init__(self, n: int, key: int):
        self.n, self.half = n, max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = np.random.default_rng(key).integers(1, 1 << 63, ROUNDS, dtype=np.uint64)

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (x ^ (x >> np.uint64(29))) & self.mask

    def _walk(self, values: np.ndarray, once) -> np.ndarray:
        out = once(np.asarray(values, np.uint64))
        while len(outside := np.flatnonzero(out >= np.uint64(self.n))):
            out[outside] = once(out[outside])
        return out.astype(np.int64)

    def scatter(self, numbers: np.ndarray) -> np.ndarray:
        def once(x: np.ndarray) -> np.ndarray:
            left, right = x >> np.uint64(self.half), x & self.mask
            for key in self.keys:
                left, right = right, left ^ self._mix(right, key)
            return (left << np.uint64(self.half)) | right

        return self._walk(numbers, once)

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        def once(x: np.ndarray) -> np.ndarray:
            left, right = x >> np.uint64(self.half), x & self.mask
            for key in self.keys[::-1]:
                left, right = right ^ self._mix(left, key), left
            return (left << np.uint64(self.half)) | right

        return self._walk(numbers, once)


def _records(batches: Iterator[pa.RecordBatch], path: str, seq_tokens: int, width: int, order: Feistel,
             firsts: dict[int, int]) -> Iterator[pa.RecordBatch]:
    size = stride(seq_tokens)
    free = firsts.get(TaskContext.get().partitionId(), 0)
    for batch, documents in document_tokens(batches, path, cache_words=CACHE_WORDS):
        counts = np.array([-(-len(ids) // seq_tokens) for ids in documents])
        reserved = batch.column("reserved").to_numpy()
        if (counts > reserved).any():
            raise ValueError("a text has more tokens than its bytes allow")
        starts = free + np.concatenate([[0], np.cumsum(reserved)])
        free, n = starts[-1], int(counts.sum())
        ends = np.cumsum(counts)
        pieces = np.arange(n) - np.repeat(ends - counts, counts)
        head = np.zeros(n, HEADER)
        head["number"] = order.scatter(np.repeat(starts[:-1], counts) + pieces)
        head["shard"], head["piece"], head["length"] = head["number"] // width, pieces, seq_tokens
        head["length"][ends - 1] = [len(ids) - (count - 1) * seq_tokens for ids, count in zip(documents, counts)]
        head["doc_id"] = np.repeat([NO_ID if d is None else d for d in batch.column("doc_id").to_pylist()], counts)
        data = np.zeros((n, size - 1), np.uint8)
        data[:, :HEADER.itemsize] = head.view(np.uint8).reshape(n, -1)
        for ids, end, count in zip(documents, ends, counts):
            if ids.max() > 0xFFFF:
                raise ValueError("the tokenizer has ids of more than 16 bits")
            padded = np.zeros(count * seq_tokens, "<u2")
            padded[:len(ids)] = ids
            data[end - count:end, HEADER.itemsize:] = padded.view(np.uint8).reshape(count, -1)
        for start in range(0, n, 8192):
            block, top = data[start:start + 8192], head[start:start + 8192]
            cuts = np.arange(len(block) + 1, dtype=np.int32) * (size - 1)
            records = pa.Array.from_buffers(pa.binary(), len(block), [
                None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(block))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(top["shard"].copy()), pa.array(top["number"].copy()), records],
                names=["shard", "number", "record"])


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", key: int = 0,
                 seq_tokens: int = SEQ_TOKENS, shard_bytes: int = SHARD_BYTES, tokenizer: str | None = None) -> None:
    """Write all sequences of ``docs`` (a stored table) to shards below ``path``.

    A document's tokens end with the end id and are cut every ``seq_tokens``; the last piece is padded with zeros.
    Null text is empty: one sequence with the end id. Null ids are written as ``NO_ID``; repeated rows are written
    each. An empty table writes no records. Other columns are not read."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    reserved = F.floor((F.octet_length(text).cast("long") * TOKENS_PER_BYTE + seq_tokens) / seq_tokens)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), reserved.alias("reserved"))
    splits = source.groupBy(F.spark_partition_id().alias("part")).agg(
        F.sum("reserved").alias("numbers"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).collect()
    firsts, total = {}, 0
    for split in sorted(splits):
        firsts[split.part] = total
        total += split.numbers
    shards = max(1, -(-sum(s.bytes for s in splits) // shard_bytes))
    run = partial(_records, path=tokenizer or default_tokenizer(), seq_tokens=seq_tokens, width=max(1, -(-total // shards)),
                  order=Feistel(total, key), firsts=firsts)
    records = source.mapInArrow(run, "shard int, number long, record binary")
    placed = records.repartitionById(shards, F.col("shard")).sortWithinPartitions("number")
    placed.select(F.col("record").cast("string").alias("value")).write.text(path)


def manifest(spark: SparkSession, path: str, seq_tokens: int = SEQ_TOKENS) -> DataFrame:
    """``shard, file, records, first_slot`` of each shard that has records, from the file sizes alone."""
    files = spark.read.format("binaryFile").load(f"{path}/part-*").select(
        F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"), F.col("path").alias("file"),
        (F.col("length") / stride(seq_tokens)).cast("long").alias("records")).where("records > 0")
    return files.withColumn("first_slot", F.sum("records").over(Window.orderBy("shard")) - F.col("records"))


def _parsed(records: Iterator[bytes], seq_tokens: int) -> Iterator[tuple]:
    for record in records:
        number, doc_id, shard, piece, length = np.frombuffer(record, HEADER, 1)[0].item()
        ids = np.frombuffer(record, "<u2", length, HEADER.itemsize).astype("<u4")
        yield number, None if doc_id == NO_ID else doc_id, shard, piece, length, zlib.crc32(ids.tobytes())


def read_shards(spark: SparkSession, path: str, seq_tokens: int = SEQ_TOKENS) -> DataFrame:
    """What the shards hold, record by record: ``slot, shard, doc_id, piece, length, ids_crc32``."""
    records = spark.sparkContext.binaryRecords(path, stride(seq_tokens))
    rows = spark.createDataFrame(records.mapPartitions(partial(_parsed, seq_tokens=seq_tokens)), RECORD)
    firsts = manifest(spark, path, seq_tokens).select("shard", "first_slot")
    place = F.row_number().over(Window.partitionBy("shard").orderBy("number")) - 1
    return rows.withColumn("place", place).join(firsts, "shard").select(
        (F.col("first_slot") + F.col("place")).alias("slot"), "shard", "doc_id", "piece", "length", "ids_crc32")


def read_from(shard: bytes, first: int, seq_tokens: int = SEQ_TOKENS) -> Iterator[np.ndarray]:
    """Token ids of a shard's records from the ``first`` on, without padding: how a training run resumes."""
    size = stride(seq_tokens)
    for at in range(first * size, len(shard), size):
        length = int(np.frombuffer(shard, HEADER, 1, at)["length"][0])
        yield np.frombuffer(shard, "<u2", length, at + HEADER.itemsize)
