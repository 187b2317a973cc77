from __future__ import annotations

import math

import numpy as np
import pytest

from hazardlens.llm import vptree
from hazardlens.llm.common import checkpointed, table
from hazardlens.llm.queries import op13_vantage_trees

SCHEMA = "vec_id long, embedding array<double>, label int, row_id string, shard string, dims int, pos int"


def plain(rows, k=5, asks=lambda i: i is not None and i % 50 == 0):
    """Every query against all other rows of its length: sorted (query, rank, id, score)."""
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for at, (qid, q) in enumerate(good):
        if not asks(qid):
            continue
        scores = []
        for other, (i, v) in enumerate(good):
            if other != at and len(v) == len(q):
                a, b = q / abs(q).max(), v / abs(v).max()
                scores.append((-round(float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)), 9), math.inf if i is None else i))
        out += [(qid, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def shown(df):
    return sorted((r.query_id, r.rank, math.inf if r.vec_id is None else r.vec_id, round(r.score, 9)) for r in df.collect())


def found(spark, rows, folder, factor=1.0, **sizes):
    spark.createDataFrame([(i, v, 1, "x", "y", 2, 3) for i, v in rows], SCHEMA).write.parquet(f"{folder}/vectors")
    index = checkpointed(vptree.build_index(spark.read.parquet(f"{folder}/vectors"), **{k: v for k, v in sizes.items() if k == "shard_values"}))
    return vptree.search(index, index.where("vec_id % 50 = 0"), factor=factor, **{k: v for k, v in sizes.items() if k != "shard_values"})


def clustered(n, dims, seed=0):
    chance = np.random.default_rng(seed)
    centres = chance.normal(size=(10, dims))
    return [(i, (centres[chance.integers(10)] + 0.2 * chance.normal(size=dims)).tolist()) for i in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"shard_values": 2000, "cell_values": 5000, "query_values": 50}])
def test_factor_one_is_exact(spark, folder, sizes):
    rows = clustered(1500, 8)
    assert shown(found(spark, rows, folder, **sizes)) == plain(rows)


def test_copies_ties_and_hot_vectors(spark, folder):
    rows = clustered(400, 5) + [(1000 + i, [1.0, 0.0, 0.0, 0.0, 0.0]) for i in range(600)] + [(50, [1.0, 0.0, 0.0, 0.0, 0.0])] * 2
    assert shown(found(spark, rows, folder, shard_values=1500)) == plain(rows)


def test_rows_that_take_no_part(spark, folder):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (100, None), (150, []), (200, [0.0, 0.0]), (250, [1.0, None]), (300, [nan, 1.0]),
            (350, [inf, 1.0]), (None, [2.0, 2.0]), (None, [2.0, 2.0]), (1, [-1.0, 0.0]), (400, [1.0, 2.0, 3.0]), (-50, [2.0**900, 2.0**900]),
            (450, [2.0**-900, 2.0**-899]), (50, [1.0, 1.0])]
    got = shown(found(spark, rows, folder))
    assert got == plain(rows) and {r[0] for r in got} == {0, 50, -50, 450}


def test_empty_table(spark, folder):
    assert found(spark, [(1, None)], folder).count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert vptree.search(checkpointed(vptree.build_index(empty)), checkpointed(vptree.build_index(empty))).count() == 0


def test_index_holds_every_row_in_tree_order(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = vptree.build_index(vectors, shard_values=40_000).collect()
    assert sorted(r.vec_id for r in rows) == sorted(r.vec_id for r in vectors.select("vec_id").collect())
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    assert len(shards) == 4
    for held in shards.values():
        assert sorted(r.pos for r in held) == list(range(len(held)))


def test_query_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding)) for r in table(spark, folder, "embeddings").collect()]
    got, want = shown(op13_vantage_trees(spark, folder)), plain(rows)
    assert len(got) == len(want) and len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) >= 0.97 * len(want)
    scores = {(q, i): s for q, _, i, s in want}
    assert all(scores.get((q, i), s) == s for q, _, i, s in got)


def test_larger_factors_visit_less():
    vectors = np.array([v for _, v in clustered(4000, 16)])
    near, lengths = vptree.scaled(vectors)
    order, bounds = vptree.build_tree(near / lengths[:, None])
    seen = []

    class Counting(vptree.Best):
        def offer(self, queries, shard, low, high):
            seen[-1] += len(queries) * (high - low)
            return super().offer(queries, shard, low, high)

    for factor in (1.0, 2.0, 6.0):
        seen.append(0)
        best = Counting(vectors[:50], np.arange(50), 5)
        vptree.Shard(vectors[order], order, order, bounds).search(best, factor)
    assert 50 * 4000 > seen[0] > seen[1] > seen[2]


def test_equal_vectors_keep_the_tree_balanced():
    order, bounds = vptree.build_tree(np.tile([[1.0, 0.0]], (5000, 1)))
    assert sorted(order) == list(range(5000)) and not np.isnan(bounds[0]).any()


def test_scaling_changes_no_digit():
    vectors = np.array([[1e300, 3e299], [3.0, 4.0]])
    near, lengths = vptree.scaled(vectors)
    assert lengths[1] * 8 == 5.0 and np.isfinite(near).all() and (near[1] == [0.375, 0.5]).all()
