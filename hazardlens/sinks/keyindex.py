"""What each file of a table can hold: the range of its keys and a Bloom filter, kept beside the table.

An insert-once batch asks the index first and then opens only the files that may hold one of its keys. Filters are built
and asked inside tasks, one row per file; of a batch only a bounded number of keys is sent along, larger batches read the
key column of all files.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import partial
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits for each key and probes: about one file in a hundred is opened in vain for a key that it does not hold.
BITS, PROBES = 10, 7
#: Keys of a batch that are asked one by one.
MAX_KEYS = 200_000

SCHEMA = "file string, rows long, low string, high string, filter binary"


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key, by double hashing."""
    values = hashes.view(np.uint64)
    step = (values >> np.uint64(32)) | np.uint64(1)
    return ((values & np.uint64(0xFFFFFFFF))[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) % np.uint64(bits)


def bits_for(rows: int) -> int:
    return max(64, -(-rows * BITS // 64) * 64)


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial key ranges and filters: one for each file that a task reads a part of."""
    open_file, bitmap, low, high = None, None, None, None
    for batch in batches:
        files, rows, hashes = batch.column("file").to_pylist(), batch.column("rows").to_numpy(), batch.column("hash").to_numpy()
        keys = batch.column("key")
        cuts = [0, *(i for i in range(1, len(files)) if files[i] != files[i - 1]), len(files)]
        for start, stop in zip(cuts[:-1], cuts[1:]):
            if start == stop:
                continue
            if files[start] != open_file:
                if open_file is not None:
                    yield _row(open_file, low, high, bitmap)
                open_file, bitmap, low, high = files[start], np.zeros(bits_for(int(rows[start])), bool), None, None
            bitmap[_places(hashes[start:stop], len(bitmap)).ravel()] = True
            ends = pc.min_max(keys.slice(start, stop - start)).as_py()
            low = ends["min"] if low is None else min(low, ends["min"])
            high = ends["max"] if high is None else max(high, ends["max"])
    if open_file is not None:
        yield _row(open_file, low, high, bitmap)


def _row(file: str, low: bytes, high: bytes, bitmap: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"file": [file], "low": pa.array([low], pa.binary()), "high": pa.array([high], pa.binary()),
                                       "filter": pa.array([np.packbits(bitmap).tobytes()], pa.binary())})


def _joined(key: tuple, parts: pa.Table) -> pa.Table:
    whole = np.bitwise_or.reduce([np.frombuffer(p, np.uint8) for p in parts.column("filter").to_pylist()])
    ends = [pc.min(parts.column("low")), pc.max(parts.column("high"))]
    return pa.Table.from_batches([_row(key[0].as_py(), *[e.as_py() for e in ends], np.unpackbits(whole))])


def index_of(rows: DataFrame, key: str) -> DataFrame:
    """The index of the files that ``rows`` were read from. Rows without a key are in no filter."""
    text = F.col(key).cast("string")
    # Files lie at <commit>/<folders>/<name> below the data folder.
    file = F.regexp_extract(F.col("_metadata.file_path"), r"/data/(.*)$", 1)
    # Keys travel as bytes, whose order is that of Spark's strings.
    held = rows.select(file.alias("file"), text.cast("binary").alias("key"), F.xxhash64(text).alias("hash"))
    counts = held.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    counted = held.where(F.col("key").isNotNull()).join(F.broadcast(counts), "file").select("file", "rows", "key", "hash")
    # The range is found with the filter: Spark's least and greatest of a string sort all rows of a task.
    kind = "file string, low binary, high binary, filter binary"
    filters = counted.mapInArrow(_filled, kind).groupBy("file").applyInArrow(lambda key, group: _joined(key, group), kind)
    return counts.join(filters, "file", "left").select(
        "file", "rows", F.col("low").cast("string").alias("low"), F.col("high").cast("string").alias("high"), "filter")


def write(rows: DataFrame, key: str, path: str) -> None:
    index_of(rows, key).write.parquet(path)


def _possible(batches: Iterator[pa.RecordBatch], keys: list[str], hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for file, low, high, bitmap in zip(*(batch.column(c).to_pylist() for c in ("file", "low", "high", "filter"))):
            if bitmap is None:
                continue
            first = bisect_left(keys, low)
            last = bisect_left(keys, high)
            last += last < len(keys) and keys[last] == high
            if first >= last:
                continue
            bits = np.unpackbits(np.frombuffer(bitmap, np.uint8)).astype(bool)
            if bits[_places(hashes[first:last], len(bits))].all(axis=1).any():
                found.append(file)
        yield pa.RecordBatch.from_pydict({"file": pa.array(found, pa.string())})


def possible_files(spark: SparkSession, paths: list[str], keys: DataFrame, key: str, max_keys: int = MAX_KEYS) -> set[str] | None:
    """Files that may hold one of ``keys``, or None if there are too many keys to ask for each."""
    text = F.col(key).cast("string")
    asked = keys.select(text.alias("key"), F.xxhash64(text).alias("hash")).where(F.col("key").isNotNull()).limit(max_keys + 1).collect()
    if len(asked) > max_keys:
        return None
    asked.sort(key=lambda r: r.key)
    names, hashes = [r.key for r in asked], np.array([r.hash for r in asked], np.int64)
    if not names:
        return set()
    index = spark.read.schema(SCHEMA).parquet(*paths).where((F.col("low") <= names[-1]) & (F.col("high") >= names[0]))
    found = index.select("file", "low", "high", "filter").mapInArrow(partial(_possible, keys=names, hashes=hashes), "file string")
    return {unquote(r.file) for r in found.toLocalIterator()}
