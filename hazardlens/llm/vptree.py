"""Approximate nearest neighbours by cosine with vantage-point trees per shard.

Vectors are dealt to shards by hash, so copies of one vector do not meet in one place. Each shard becomes a tree: a node's
vantage point splits the others at the median of their angles to it, and the node keeps the least and greatest angle of
either half. Angles between vectors are a metric, so if all angles of a half differ from the query's by ``gap`` or more,
nothing there is nearer than ``gap``; the half is left out when ``gap * factor`` exceeds the angle of the query's k-th
best. Factor 1 is exact, larger factors visit less. Halves are split by place, so equal vectors cannot unbalance a tree.

The index is a table of all vectors in tree order. A search joins blocks of queries with blocks of shards; a block holds a
bounded number of values, whatever the number of rows or dimensions. A task walks its trees with all its queries at once
and returns each query's best; blocks are merged by rank. Scores are computed on the vectors as given.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlens.llm.common import checkpointed, with_row_id

#: Values (rows times dimensions) of a shard, of the shards of a task and of the queries of a task.
SHARD_VALUES, CELL_VALUES, QUERY_VALUES = 1 << 19, 1 << 21, 1 << 18
LEAF_ROWS = 64
#: Vantage points are chosen from so many candidates by the spread of angles to so many rows.
CANDIDATES, PROBES = 4, 128
FACTOR = 3.0
_SLACK = 1e-6           # of angles in radians: more than the rounding of an arc cosine
_TIE = 1e-12            # of cosines: more than the rounding of a dot product


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors times a power of two, so that nothing overflows (no digit changes), and their lengths."""
    _, exponents = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    near_one = np.ldexp(vectors, -exponents[:, None])
    return near_one, np.sqrt(np.einsum("ij,ij->i", near_one, near_one))


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def build_tree(unit: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows in the tree, and for each inner node (at its vantage point's place) the least and greatest angles of
    its inner and outer half. A node over ``[low, high)`` has its vantage point at ``low`` and splits the rest in the middle."""
    chance, order = np.random.default_rng(seed), np.arange(len(unit))
    bounds = np.full((len(unit), 4), np.nan)
    todo = [(0, len(unit))]
    while todo:
        low, high = todo.pop()
        if high - low <= LEAF_ROWS:
            continue
        rows = order[low:high]
        tried = chance.integers(0, len(rows), CANDIDATES)
        probes = unit[rows[chance.integers(0, len(rows), PROBES)]]
        best = tried[np.argmax(angles(probes @ unit[rows[tried]].T).std(axis=0))]
        rows[0], rows[best] = rows[best], rows[0]
        far = angles(unit[rows[1:]] @ unit[rows[0]])
        sorting = np.argsort(far, kind="stable")
        order[low + 1:high], far = rows[1:][sorting], far[sorting]
        middle = (low + 1 + high) // 2
        cut = middle - low - 1
        bounds[low] = far[0], far[cut - 1], far[cut], far[-1]
        todo += [(low + 1, middle), (middle, high)]
    return order, bounds


class Best:
    """The ``k`` best so far of a block of queries: by cosine, then id (null last), then row."""

    def __init__(self, vectors: np.ndarray, rows: np.ndarray, k: int):
        self.scaled, self.lengths = scaled(vectors)
        self.unit, self.rows = self.scaled / self.lengths[:, None], rows
        self.score = np.full((len(rows), k), -np.inf)
        self.id = np.full((len(rows), k), np.iinfo(np.int64).max)
        self.row = np.full((len(rows), k), -1)

    def offer(self, queries: np.ndarray, shard: Shard, low: int, high: int) -> np.ndarray:
        """Compare some queries with a run of a shard's rows; gives the cosines."""
        cosines = self.unit[queries] @ shard.unit[low:high].T
        hits = (cosines >= self.score[queries, -1:] - _TIE) & (self.rows[queries, None] != shard.row[low:high])
        at, col = np.nonzero(hits)
        if len(at):
            self._merge(queries[at], shard, low + col)
        return cosines

    def _merge(self, query: np.ndarray, shard: Shard, place: np.ndarray) -> None:
        exact = np.einsum("ij,ij->i", self.scaled[query], shard.scaled[place]) / (self.lengths[query] * shard.lengths[place])
        touched, k = np.unique(query), self.score.shape[1]
        query = np.concatenate([query, np.repeat(touched, k)])
        score = np.concatenate([exact, self.score[touched].ravel()])
        ids = np.concatenate([shard.id[place], self.id[touched].ravel()])
        rows = np.concatenate([shard.row[place], self.row[touched].ravel()])
        order = np.lexsort((rows, ids, -score, query))
        starts = np.searchsorted(query[order], touched)
        chosen = order[(starts[:, None] + np.arange(k))]
        self.score[touched], self.id[touched], self.row[touched] = score[chosen], ids[chosen], rows[chosen]


class Shard:
    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, bounds: np.ndarray):
        self.scaled, self.lengths = scaled(vectors)
        self.unit = self.scaled / self.lengths[:, None]
        self.id, self.row, self.bounds = ids, rows, bounds

    def search(self, best: Best, factor: float) -> None:
        if len(self.row):
            self._visit(best, np.arange(len(best.rows)), 0, len(self.row), factor)

    def _visit(self, best: Best, queries: np.ndarray, low: int, high: int, factor: float) -> None:
        if high - low <= LEAF_ROWS:
            best.offer(queries, self, low, high)
            return
        angle = angles(best.offer(queries, self, low, low + 1)[:, 0])
        inner_low, inner_high, outer_low, outer_high = self.bounds[low]
        inner = np.maximum(0.0, np.maximum(inner_low - angle, angle - inner_high))
        outer = np.maximum(0.0, np.maximum(outer_low - angle, angle - outer_high))
        middle, inside = (low + 1 + high) // 2, angle < outer_low
        for first, gaps, start, stop in ((inside, inner, low + 1, middle), (np.ones_like(inside), outer, middle, high),
                                         (~inside, inner, low + 1, middle)):
            near = first & (gaps * factor <= angles(best.score[queries, -1]) + _SLACK)
            if near.any():
                self._visit(best, queries[near], start, stop, factor)


def _matrix(column: pa.ChunkedArray, dimensions: int) -> np.ndarray:
    values = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in column.chunks]
    return np.concatenate(values or [np.empty(0)]).astype(np.float64).reshape(-1, dimensions)


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(np.iinfo(np.int64).max).to_numpy()


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components are finite numbers."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def build_index(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 0,
                shard_values: int = SHARD_VALUES) -> DataFrame:
    """All usable rows of ``table`` (a stored table) in tree order: ``dims, shard, pos, row_id, vec_id, vector, bounds``.

    Vectors that are null, zero, empty or hold null or non-finite components take no part. Vectors of different length
    have no angle, so each length has shards of its own. Repeated rows and null ids are rows like others; an empty table
    has an empty index. Other columns are not read, whatever their names."""
    rows, row_id = with_row_id(table)
    kept = table.schema[vector_col].dataType
    kind = "float" if isinstance(kept, T.ArrayType) and isinstance(kept.elementType, T.FloatType) else "double"
    held = rows.select(F.col(row_id).alias("row_id"), F.col(id_col).cast("long").alias("vec_id"),
                       F.col(vector_col).cast(f"array<{kind}>").alias("vector")).where(usable(F.col("vector"))).withColumn(
        "dims", F.size("vector"))
    sizes = checkpointed(held.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).select(
        "dims", F.ceil(F.col("n") * F.col("dims") / shard_values).alias("shards")))
    dealt = held.join(sizes, "dims").withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "row_id"), "shards")).drop("shards")

    def tree(key: tuple, group: pa.Table) -> pa.Table:
        dims, shard = (k.as_py() for k in key)
        group = group.sort_by("row_id")
        near_one, lengths = scaled(_matrix(group.column("vector"), dims))
        order, bounds = build_tree(near_one / lengths[:, None], seed + shard)
        ordered = group.select(["dims", "shard", "row_id", "vec_id", "vector"]).take(pa.array(order))
        inner = ~np.isnan(bounds[:, 0])
        return ordered.append_column("pos", pa.array(range(len(order)), pa.int32())).append_column(
            "bounds", pa.array([b.tolist() if i else None for i, b in zip(inner, bounds)], pa.list_(pa.float64())))

    return dealt.groupBy("dims", "shard").applyInArrow(
        tree, f"dims int, shard long, row_id long, vec_id long, vector array<{kind}>, pos int, bounds array<double>")


def search(index: DataFrame, queries: DataFrame, k: int = 5, factor: float = FACTOR, cell_values: int = CELL_VALUES,
           query_values: int = QUERY_VALUES) -> DataFrame:
    """The ``k`` nearest rows found for each of ``queries`` (rows of ``index``, stored): ``query_row, query_id, rank, vec_id,
    row_id, score``.

    A row is never its own neighbour, but another row with the same id can be. Equal cosines go by id (null last), then by
    row. Where fewer rows take part than ``k``, all are returned. ``factor`` 1 finds exactly the nearest."""
    count = lambda df, name: df.groupBy("dims").agg(F.count(F.lit(1)).alias(name))
    shards = index.groupBy("dims").agg(F.count(F.lit(1)).alias("n"), (F.max("shard") + 1).alias("shards"))
    per_cell = F.greatest(F.lit(1), F.floor(F.lit(cell_values) * F.col("shards") / (F.col("n") * F.col("dims"))))
    sizes = checkpointed(shards.join(count(queries, "q"), "dims").select(
        "dims", per_cell.alias("per_cell"), F.ceil(F.col("shards") / per_cell).alias("shard_blocks"),
        F.ceil(F.col("q") * F.col("dims") / query_values).alias("query_blocks")))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    cell = ["dims", "shard_block", "query_block"]
    asked = queries.select(*(F.col(c).alias(f"q_{c}") for c in ("row_id", "vec_id", "vector")), "dims").join(sizes, "dims").withColumn(
        "query_block", F.pmod(F.xxhash64("q_row_id"), "query_blocks")).withColumn("shard_block", every("shard_blocks")).select(
        *(F.col(c).alias(c) for c in cell), "q_row_id", "q_vec_id", "q_vector")
    held = index.join(sizes, "dims").withColumn("shard_block", F.floor(F.col("shard") / F.col("per_cell"))).withColumn(
        "query_block", every("query_blocks")).select(*cell, "shard", "pos", "row_id", "vec_id", "vector", "bounds")

    def find(key: tuple, asking: pa.Table, rows: pa.Table) -> pa.Table:
        dims = key[0].as_py()
        asking = asking.sort_by("q_row_id")
        best = Best(_matrix(asking.column("q_vector"), dims), asking.column("q_row_id").to_numpy(), k)
        rows = rows.sort_by([("shard", "ascending"), ("pos", "ascending")])
        vectors, ids, numbers = _matrix(rows.column("vector"), dims), _ids(rows.column("vec_id")), rows.column("row_id").to_numpy()
        bounds = np.full((len(numbers), 4), np.nan)
        inner = np.flatnonzero(rows.column("bounds").is_valid().to_numpy())
        if len(inner):
            bounds[inner] = _matrix(rows.column("bounds").drop_null(), 4)
        cuts = [*np.flatnonzero(rows.column("pos").to_numpy() == 0), len(numbers)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            Shard(vectors[low:high], ids[low:high], numbers[low:high], bounds[low:high]).search(best, factor)
        at, place = np.nonzero(best.row >= 0)
        ids, found = best.id[at, place], best.row[at, place]
        known = dict(zip(numbers.tolist(), rows.column("vec_id").to_pylist()))
        return pa.table({
            "query_row": pa.array(best.rows[at], pa.int64()), "query_id": asking.column("q_vec_id").take(pa.array(at)),
            "vec_id": pa.array([known[r] for r in found.tolist()], pa.int64()), "row_id": pa.array(found, pa.int64()),
            "score": pa.array(best.score[at, place], pa.float64())})

    found = asked.groupBy(*cell).cogroup(held.groupBy(*cell)).applyInArrow(
        find, "query_row long, query_id long, vec_id long, row_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_row", "query_id", "rank", "vec_id", "row_id", "score")
