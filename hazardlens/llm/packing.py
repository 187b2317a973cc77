"""Best-fit decreasing packing of token sequences.

Documents are tokenised where they lie; only (id, piece, length) rows travel. The pieces are dealt evenly to groups
of about ``group_pieces``, and each group is packed by best fit, longest first, with a segment tree over remaining
capacities: the tightest open sequence is found in logarithmic time. A group leaves at most a few sequences open,
so next to one packing of everything the groups cost about one sequence in thousands.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.llm.common import checkpointed
from hazardlens.llm.tokens import default_tokenizer, document_tokens

CAPACITY = 4096
GROUP_PIECES = 16_384

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64())])


class CapacityTree:
    """Open bins by remaining capacity; ``pop(need)`` takes out the tightest bin that has room for ``need``."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.width)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        at = room + self.width
        while at:
            self.counts[at] += by
            at >>= 1

    def push(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        self._add(room, 1)

    def pop(self, need: int) -> tuple[int, int] | None:
        counts, at = self.counts, need + self.width
        if not counts[at]:
            while at > 1 and (at & 1 or not counts[at + 1]):     # up, until something lies to the right
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.width:
                at = 2 * at if counts[2 * at] else 2 * at + 1
        room = at - self.width
        self._add(room, -1)
        return room, self.bins[room].pop()


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """Bin and offset of each length. The lengths are placed in the given order."""
    tree, bins, offsets, opened = CapacityTree(capacity), [], [], 0
    for length in lengths:
        found = tree.pop(length)
        if found is None:
            found, opened = (capacity, opened), opened + 1
        room, number = found
        bins.append(number)
        offsets.append(capacity - room)
        tree.push(room - length, number)
    return bins, offsets


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    schema = _PIECES.append(pa.field("ids", pa.binary())) if keep_ids else _PIECES
    for batch, documents in document_tokens(batches, path):
        out: list[list] = [[] for _ in schema]
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), documents):
            for piece, start in enumerate(range(0, len(ids), capacity)):
                data = ids[start:start + capacity].tobytes()
                row = (doc_id, piece, start, len(data) // 4, zlib.crc32(data), data)
                for values, value in zip(out, row):
                    values.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
           capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Every document as pieces of at most ``capacity`` tokens: ``doc_id, piece, start, length, ids_crc32``, and
    with ``keep_ids`` the ids themselves (little-endian unsigned 32-bit). Null text is empty: one piece with the
    end id. Repeated rows and null ids give pieces of their own. Other columns are not read."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    run = partial(_cut, path=tokenizer or default_tokenizer(), capacity=capacity, keep_ids=keep_ids)
    return source.mapInArrow(run, PIECES + (", ids binary" if keep_ids else ""))


def _pack_group(group: pa.Table, capacity: int) -> pa.Table:
    group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                           ("ids_crc32", "ascending"), ("place", "ascending")])
    bins, offsets = best_fit(group.column("length").to_pylist(), capacity)
    first = (group.column("part")[0].as_py() if len(group) else 0) << 32
    return group.drop_columns(["part", "place"]).append_column(
        "sequence_id", pa.array([first + b for b in bins], pa.int64())).append_column(
        "offset", pa.array(offsets, pa.int64()))


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``cut`` (rows of :func:`pieces` without ids) with ``sequence_id`` and ``offset``. An empty table stays empty."""
    stored = checkpointed(cut)
    groups = max(1, -(-stored.count() // group_pieces))
    dealt = stored.withColumn("place", F.monotonically_increasing_id()).withColumn(
        "part", F.pmod(F.xxhash64("place"), F.lit(groups)))
    return dealt.groupBy("part").applyInArrow(
        lambda group: _pack_group(group, capacity), PIECES + ", sequence_id long, offset long")


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """All pieces of all documents with their place in as few sequences of ``capacity`` tokens as found."""
    return pack(pieces(docs, id_col, text_col, tokenizer, capacity), capacity)


def sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
              capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, doc_ids, offsets, ids`` (ids of all pieces in order)."""
    placed = packed_documents(docs, id_col, text_col, tokenizer, capacity)
    held = pieces(docs, id_col, text_col, tokenizer, capacity, keep_ids=True)
    # Pieces with equal ids and content are interchangeable: the n-th of one side gets the n-th place.
    key = ["doc_id", "piece", "length", "ids_crc32"]
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))
    a, b = placed.withColumn("nth", nth), held.select(*key, "ids").withColumn("nth", nth)
    same = [a[c].eqNullSafe(b[c]) for c in (*key, "nth")]
    whole = a.join(b, same).select(a["sequence_id"], a["offset"], a["doc_id"], b["ids"])
    in_order = whole.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return in_order.select(
        "sequence_id", F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"),
        F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x.ids)).alias("ids"))
