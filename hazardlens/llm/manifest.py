"""Merkle manifest of a dataset, stored by content, with proofs read by descent.

Rows are leaves. The leaves of a tree (here: of a language) lie in order; every two neighbours become their parent, and so
on up to the tree's root. The roots of all trees, in order, become the root of the dataset in the same way.

Levels are built ``height`` at a time. A segment is a node together with the up to ``2 ** height`` nodes that far below it;
they meet in one group. So n rows take log2(n) / height rounds, each a small part of the one before. What is stored is one
record for every inner node, digest to children, under the digest of its segment's top; equal segments are stored once.

Requests descend. A segment is looked up by its digest, the way down follows the digits of the rank, and the children not
taken are collected; reversed, they are that segment of the path upwards. A segment is asked for once for all requests
that pass it, so the root's record is not joined with every request.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.llm.common import checkpointed, ordered_index
from hazardlens.session import scratch_path

#: Levels of a segment, which then has at most 1024 nodes at its bottom.
HEIGHT = 10
#: Number of the tree above the trees.
ABOVE = -1

_BUILT = pa.schema([("tree", pa.int64()), ("pos", pa.int64()), ("digest", pa.string()), ("count", pa.int64()),
                    ("node", pa.string()), ("children", pa.list_(pa.string()))])
BUILT = "tree long, pos long, digest string, count long, node string, children array<string>"
PATH = "array<struct<left:boolean,digest:string>>"


def digest_of(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def levels_above(count: int) -> int:
    return max(0, count - 1).bit_length()


def _build_segment(key: tuple, group: pa.Table, height: int) -> pa.Table:
    """The records of one segment, and its top as a node of the next round (a row without ``node``)."""
    tree, segment = (k.as_py() for k in key)
    nodes = group.sort_by("pos").column("digest").to_pylist()
    count = group.column("count")[0].as_py()
    records: dict[str, list[str]] = {}
    for _ in range(min(height, levels_above(count))):
        pairs = [nodes[at:at + 2] for at in range(0, len(nodes), 2)]
        nodes = [digest_of(*pair) for pair in pairs]
        records |= zip(nodes, pairs)
    n = len(records) + 1
    return pa.Table.from_arrays([
        pa.array([tree] * n, pa.int64()), pa.array([segment] * n, pa.int64()), pa.array(nodes * n, pa.string()),
        pa.array([-(-count // (1 << height))] * n, pa.int64()),
        pa.array([None, *records], pa.string()), pa.array([None, *records.values()], pa.list_(pa.string()))], schema=_BUILT)


@dataclass
class Manifest:
    """``root`` is null for an empty table. ``leaves`` holds ``tree, pos, count, digest, payload``, ``trees`` has
    ``tree, digest, count`` and ``store`` the records ``digest, node, children`` by the digest of the segment's top."""
    root: str | None
    leaves: DataFrame
    trees: DataFrame
    store: DataFrame
    tree_count: int
    longest: int
    height: int


def _rounds(count: int, height: int) -> int:
    return -(-levels_above(count) // height)


def _build(nodes: DataFrame, rounds: int, height: int, path: str) -> tuple[DataFrame, list[DataFrame]]:
    """All rounds over ``nodes`` (tree, pos, count, digest): the trees' tops, and what each round stored."""
    spark, tops, stored = nodes.sparkSession, nodes.where("count = 1").select("tree", "digest"), []
    for number in range(rounds):
        place = f"{path}/{number}"
        nodes.where("count > 1").select("tree", "pos", "count", "digest", F.shiftright("pos", height).alias("segment")).groupBy(
            "tree", "segment").applyInArrow(
            lambda key, group: _build_segment(key, group, height), BUILT).write.parquet(place)
        stored.append(spark.read.parquet(place))
        nodes = stored[-1].where("node IS NULL").select("tree", "pos", "count", "digest")
        tops = tops.unionByName(nodes.where("count = 1").select("tree", "digest"))
    return tops, stored


def build(rows: DataFrame, tree: Column, order: Column, leaf: Column, payload: Column | None = None, path: str | None = None,
          height: int = HEIGHT) -> Manifest:
    """The manifest of ``rows``: leaves of one ``tree`` value are a tree, in ascending ``order`` and, where that is equal,
    by digest. Null comes first in both orders; a null tree is a tree of its own. Repeated rows are leaves each. An empty
    table has no root. Texts are read once, only digests and ``payload`` go on. ``path`` is where records are written."""
    spark, path = rows.sparkSession, path or scratch_path(rows.sparkSession, "manifest")
    hashed = checkpointed(rows.select(F.array(tree).alias("key"), order.alias("order"), leaf.alias("digest"),
                                      (F.struct(F.lit(None).cast("int").alias("none")) if payload is None else payload).alias("payload")))
    placed = checkpointed(ordered_index(hashed, F.col("key")[0], "order", "digest", name="at"))
    groups = placed.groupBy("key").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("count"))
    trees = checkpointed(ordered_index(checkpointed(groups), "first", name="tree"))
    tree_count, longest = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("count"), F.lit(0))).first()
    place = f"{path}/leaves"
    placed.join(trees, "key").select("tree", (F.col("at") - F.col("first")).alias("pos"), "count", "digest", "payload").write.parquet(place)
    leaves = spark.read.parquet(place)
    tops, stored = _build(leaves, _rounds(longest, height), height, f"{path}/trees")
    tops = checkpointed(tops)
    nodes = tops.select(F.lit(ABOVE).cast("long").alias("tree"), F.col("tree").alias("pos"),
                        F.lit(tree_count).cast("long").alias("count"), "digest")
    top, above = _build(nodes, _rounds(tree_count, height), height, f"{path}/above")
    root = top.first()
    store = spark.createDataFrame([], BUILT)
    for part in (*stored, *above):
        store = store.unionByName(part)
    return Manifest(root.digest if root else None, leaves, tops.join(trees.select("tree", "count"), "tree"),
                    store.where("node IS NOT NULL").select("digest", "node", "children"), tree_count, longest, height)


def _walk(key: tuple, requests: pa.Table, segment: pa.Table, height: int) -> pa.Table:
    """From a segment's top down to each request's node, by the digits of its place."""
    children, top, above = {}, None, []
    for node, kids, digest, path in zip(*(segment.column(c).to_pylist() for c in ("node", "children", "digest", "path"))):
        if node is None:
            top, above = digest, [(step["left"], step["digest"]) for step in path]
        else:
            children[node] = kids
    digests, ends, lefts, siblings = [], [0], [], []
    for pos, count in zip(requests.column("pos").to_pylist(), requests.column("count").to_pylist()):
        node, passed = top, []
        for digit in reversed(range(min(height, levels_above(count)))):
            pair, taken = children[node], pos >> digit & 1
            passed.append((taken == 1, pair[1 - taken] if len(pair) == 2 else ""))
            node = pair[taken]
        digests.append(node)
        whole = [*reversed(passed), *above]
        lefts += [left for left, _ in whole]
        siblings += [sibling for _, sibling in whole]
        ends.append(len(lefts))
    steps = pa.StructArray.from_arrays([pa.array(lefts, pa.bool_()), pa.array(siblings, pa.string())], ["left", "digest"])
    return pa.Table.from_arrays(
        [*(requests.column(c) for c in ("tree", "pos", "payload")), pa.array(digests, pa.string()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)], names=["tree", "pos", "payload", "digest", "path"])


def _descend(manifest: Manifest, requests: DataFrame, heads: DataFrame, rounds: int) -> DataFrame:
    """``requests`` (tree, pos, count, payload) with ``digest`` and ``path``; ``heads`` (tree, digest, path, count) are the
    tops of their trees, which are ``rounds`` rounds high at most."""
    height, found = manifest.height, None
    payload = requests.schema["payload"].dataType.simpleString()
    for number in reversed(range(rounds)):
        span = height * number
        asked = requests.where(F.col("count") > (1 << span))
        if number:      # the segments that the requests pass, once each
            up = F.shiftright(F.col("count") + ((1 << span) - 1), span)
            asked = asked.select("tree", F.shiftright("pos", span).alias("pos"), up.alias("count")).distinct().withColumn(
                "payload", F.lit(None).cast(payload))
        tops = heads.where((F.col("count") > (1 << span)) & (F.col("count") <= (1 << span + height))).select(
            "tree", F.lit(0).cast("long").alias("segment"), "digest", "path")
        if found is not None:
            tops = tops.unionByName(found.select("tree", F.col("pos").alias("segment"), "digest", "path"))
        records = manifest.store.dropDuplicates(["digest", "node"])
        segments = tops.select("tree", "segment", "digest").join(records, "digest").withColumn(
            "path", F.lit(None).cast(PATH)).unionByName(tops.withColumns({
                "node": F.lit(None).cast("string"), "children": F.lit(None).cast("array<string>")}))
        found = asked.withColumn("segment", F.shiftright("pos", height)).groupBy("tree", "segment").cogroup(
            segments.groupBy("tree", "segment")).applyInArrow(
            lambda key, asked, segment: _walk(key, asked, segment, height), f"tree long, pos long, payload {payload}, digest string, path {PATH}")
        if number:
            found = checkpointed(found)
    lone = requests.where("count = 1").select("tree", "pos", "payload").join(heads.select("tree", "digest", "path"), "tree").select(
        "tree", "pos", "payload", "digest", "path")
    return lone if found is None else found.unionByName(lone)


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """For each requested leaf (rows of ``manifest.leaves``; default: all) ``tree, pos, payload, digest, path``.

    ``digest`` is what the descent from the root ends at. ``path`` leads from there to the root: at each level the sibling
    (empty where a node has none) and whether it lies to the left."""
    requests = manifest.leaves if requests is None else requests
    spark, height = requests.sparkSession, manifest.height
    trees = requests.select("tree").distinct().select(
        F.lit(ABOVE).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(manifest.tree_count).cast("long").alias("count"),
        F.struct(F.lit(None).cast("int").alias("none")).alias("payload"))
    whole = spark.createDataFrame([(ABOVE, manifest.root, [], manifest.tree_count)], f"tree long, digest string, path {PATH}, count long")
    heads = checkpointed(_descend(manifest, trees, whole, _rounds(manifest.tree_count, height)))
    heads = heads.select(F.col("pos").alias("tree"), "digest", "path").join(manifest.trees.select("tree", "count"), "tree")
    return _descend(manifest, requests, heads, _rounds(manifest.longest, height))


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.when(step.left, F.concat(step.digest, node)).otherwise(
        F.concat(node, step.digest)), 256))


def path_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: step.digest), ""), 256)
