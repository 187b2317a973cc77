"""N-gram Jaccard join with Bayesian candidate pruning.

1. One pass over the texts gives each document its MinHash values (one byte each), 32 band hashes and a digest of
   its words. Documents with the same words are copies; one of them stands for all.
2. Candidates share a band. Four values a band, 32 bands: a pair of similarity 0.8 is missed once in 10^7.
3. Every member of a bucket is compared with the bucket's first one: MinHash values are compared step by step, and
   a pair goes when the posterior probability that it reaches the threshold falls below ``tolerance``. What is left
   joins documents to families.
4. In buckets that still hold several families, blocks of members are compared inside tasks by the same pruning, and
   families that may be linked become one. A task tells only what joins families, so it never lists the pairs.
5. Each document is verified exactly against its whole family, in blocks. What comes out is its number of links in a
   block and one link for each part of the block that it connects; those links give the classes.

So no pair list of a group is ever written, all links between different texts count, and no bucket is capped. Large
buckets and groups are cut into blocks that go to different tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.llm.common import checkpointed, partitions_of, releasing, slices, with_row_id
from hazardlens.llm.components import components
from hazardlens.llm.wordhash import mixed, shingles, words

SHINGLE_WORDS = 5
THRESHOLD = 0.8
HASHES, BANDS = 128, 32
STEP = 16               #: MinHash values compared before each look at the posterior
TOLERANCE = 1e-6
BLOCK_ROWS = 512        #: members of a bucket or group that one task compares at once
GUEST_ROWS = 4096       #: documents that one task verifies against a block
SLICE_BYTES = 1 << 20

_A, _B = (np.random.default_rng(7).integers(1, 1 << 63, (2, HASHES, 1), dtype=np.uint64) | np.uint64(1))
_SALTS = np.random.default_rng(8).integers(1, 1 << 63, (BANDS, HASHES // BANDS), dtype=np.uint64) | np.uint64(1)

_PROFILE = "row_id long, doc_id long, words binary, n int, bands array<long>, mins binary"
_PROFILE_SCHEMA = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("words", pa.binary()), ("n", pa.int32()),
                             ("bands", pa.list_(pa.int64())), ("mins", pa.binary())])


def shingle_sets(texts: list[str | None], size: int = SHINGLE_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes and distinct shingles of each text; ``A-Z`` count as ``a-z``. Null text has none."""
    coded = [b"" if t is None else t.encode().lower() for t in texts]
    for start, stop in slices(map(len, coded), SLICE_BYTES):
        hashes, begins = words(coded[start:stop])
        for a, b in zip(begins[:-1], begins[1:]):
            yield hashes[a:b], shingles(hashes[a:b], size)


def min_hashes(items: np.ndarray) -> np.ndarray:
    """The 128 smallest hash values (32 bits) of a set."""
    low = np.full(HASHES, np.uint64(0xFFFFFFFF))
    for start in range(0, len(items), 2048):
        np.minimum(low, ((items[start:start + 2048] * _A + _B) >> np.uint64(32)).min(axis=1), out=low)
    return low


def _profiles(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, counts, bands, mins = [], [], [], []
        for hashes, items in shingle_sets(batch.column("text").to_pylist(), size):
            counts.append(len(items))
            if not len(items):
                digests.append(None)
                bands.append([])
                mins.append(None)
                continue
            low = min_hashes(items)
            digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
            bands.append(mixed((low.reshape(BANDS, -1) * _SALTS).sum(axis=1)).view(np.int64))
            mins.append((low & np.uint64(255)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(counts, pa.int32()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(mins, pa.binary())], schema=_PROFILE_SCHEMA)


@lru_cache
def fewest_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For 16, 32, ... compared values: the fewest matches that keep a pair.

    Prior: any similarity is as likely as any other. One-byte values also match by chance, once in 256."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    match = grid + (1 - grid) / 256
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for matches in range(n + 1):
            log = matches * np.log(match) + (n - matches) * np.log1p(-match + 1e-300)
            weight = np.exp(log - log.max())
            if weight[grid >= threshold].sum() >= tolerance * weight.sum():
                out.append(matches)
                break
    return tuple(out)


def survivors(left: np.ndarray, right: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Which rows of two MinHash matrices (pairs by row) may reach the threshold, comparing step by step."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for i, fewest in enumerate(fewest_matches(threshold, tolerance)):
        part = slice(i * STEP, (i + 1) * STEP)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= fewest]
    return alive


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


def _prune(batches: Iterator[pa.RecordBatch], threshold: float, tolerance: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = survivors(_matrix(batch.column("left")), _matrix(batch.column("right")), threshold, tolerance)
        yield batch.select(["a", "b"]).take(pa.array(kept))


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), pa.array([s.tobytes() for _, s in shingle_sets(batch.column("text").to_pylist(), size)],
                                              pa.binary())], names=["row_id", "items"])


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, bool]]:
    """Parts of sorted batches that have equal keys, and whether a part begins a new key."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1), batch.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:]):
            key = tuple(values[start])
            yield batch.slice(start, stop - start), key != last
            last = key


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for part, new in _runs(batches, keys):
        if new and held:
            yield pa.Table.from_batches(held)
            held = []
        held.append(part)
    if held:
        yield pa.Table.from_batches(held)


class _Families:
    """Families joined so far in a task."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        top = x
        while (up := self.parent.get(top, top)) != top:
            top = up
        while x != top:
            self.parent[x], x = top, self.parent.get(x, x)
        return top


def _bridges(batches: Iterator[pa.RecordBatch], threshold: float, tolerance: float) -> Iterator[pa.RecordBatch]:
    """Pairs of families that may be linked; what follows from earlier pairs is left out."""
    families, out = _Families(), []

    def flush() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in out], pa.int64()),
                                           "b": pa.array([b for _, b in out], pa.int64())})
        out.clear()
        return rows

    for group in _groups(batches, ["bucket", "lo", "hi"]):
        mins = _matrix(group.column("mins").combine_chunks())
        blocks = group.column("block").to_numpy()
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        roots = np.array([families.root(x) for x in group.column("comp").to_pylist()])
        right = np.flatnonzero(blocks == hi)
        for i in np.flatnonzero(blocks == lo):
            others = right[roots[right] != roots[i]]
            if lo == hi:
                others = others[others > i]
            if not len(others):
                continue
            near = survivors(np.broadcast_to(mins[i], (len(others), HASHES)), mins[others], threshold, tolerance)
            for other in np.unique(roots[others[near]]).tolist():
                own = int(roots[i])
                out.append((own, other))
                families.parent[max(own, other)] = min(own, other)
                roots[(roots == own) | (roots == other)] = min(own, other)
        if len(out) > 20_000 or len(families.parent) > 200_000:
            yield flush()
            families.parent.clear()
    yield flush()


class _Block:
    """Shingle sets of up to a few hundred documents, for counting one document's links to all of them."""

    def __init__(self, part: pa.RecordBatch):
        sets = [np.frombuffer(x, np.uint64) for x in part.column("items").to_pylist()]
        self.rows, self.copies = part.column("row_id").to_numpy(), part.column("copies").to_numpy()
        self.sizes = np.array([len(s) for s in sets])
        items = np.concatenate(sets)
        order = np.argsort(items, kind="stable")
        self.items, self.owner = items[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

        self.parts = np.arange(len(sets))

    def links(self, row: int, items: np.ndarray, threshold: float, tells: bool) -> tuple[int, list[int]]:
        """Linked documents (copies count), and if it ``tells`` one linked row for each part of the block that this
        connects."""
        first, last = np.searchsorted(self.items, items), np.searchsorted(self.items, items, side="right")
        spread = np.repeat(first - np.concatenate([[0], np.cumsum(last - first)[:-1]]), last - first)
        both = np.bincount(self.owner[spread + np.arange(len(spread))], minlength=len(self.sizes))
        linked = np.flatnonzero((both >= threshold * (len(items) + self.sizes - both)) & (self.rows != row))
        if not len(linked):
            return 0, []
        count = int(self.copies[linked].sum())
        if not tells:
            return count, []
        parts, at = np.unique(self.parts[linked], return_index=True)
        if len(parts) > 1:
            self.parts[np.isin(self.parts, parts)] = parts[0]
        return count, self.rows[linked[at]].tolist()


def _count_links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Guests after hosts in each (comp, block, part): the links of each guest to the hosts."""
    hosts: list[_Block] = []
    for part, new in _runs(batches, ["comp", "block", "part"]):
        if new:
            hosts = []
        guest = part.column("guest").to_numpy()
        if (guest == 0).any():
            hosts.append(_Block(part.filter(pa.array(guest == 0))))
        coming = part.filter(pa.array(guest == 1))
        rows, counts, others = [], [], []
        for row, tells, items in zip(*(coming.column(c).to_pylist() for c in ("row_id", "tells", "items"))):
            for block in hosts:
                count, linked = block.links(row, np.frombuffer(items, np.uint64), threshold, tells)
                if count:
                    linked = linked or [None]
                    rows += [row] * len(linked)
                    counts += [count, *[0] * (len(linked) - 1)]
                    others += linked
        yield pa.RecordBatch.from_pydict({"row_id": pa.array(rows, pa.int64()), "other": pa.array(others, pa.int64()),
                                          "links": pa.array(counts, pa.int64())})


def _spread(key: Column, parts: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(salt)), parts).cast("int")


def _in_order(df: DataFrame, keys: list[str], *more: str) -> DataFrame:
    return df.repartition(partitions_of(df), *keys).sortWithinPartitions(*keys, *more)


def linked_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
                  threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[DataFrame, str, DataFrame]:
    """``row_id, doc_id, group, copy_of, n_links`` of every row of ``docs`` (a stored table), before it ``docs``
    with its row number and that column's name. ``group`` and ``copy_of`` are row numbers."""
    rows, row_id = with_row_id(docs)
    source = rows.select(F.col(row_id).alias("row_id"), F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).cast("string").alias("text"))
    profile = checkpointed(source.mapInArrow(releasing(_profiles, size=shingle_words), _PROFILE))
    filled = profile.where("n > 0")
    firsts = checkpointed(filled.groupBy("words").agg(
        F.min(F.struct("doc_id", "row_id", "bands", "mins")).alias("first"), F.count(F.lit(1)).alias("copies"))
        .select("words", F.col("first.row_id").alias("row_id"), "copies", "first.bands", "first.mins"))

    # Buckets of several documents, each with its first one.
    banded = firsts.select("row_id", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("row_id").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = checkpointed(banded.join(shared, "bucket"))
    mins = firsts.select("row_id", "mins")
    stars = members.where("row_id <> center").select(F.col("center").alias("a"), F.col("row_id").alias("b")).distinct()
    likely = checkpointed(
        stars.join(mins.toDF("a", "left"), "a").join(mins.toDF("b", "right"), "b").select("a", "b", "left", "right")
        .mapInArrow(releasing(_prune, threshold=threshold, tolerance=tolerance), "a long, b long"))
    grouped = components(likely)
    in_family = checkpointed(members.select("row_id").distinct().join(
        grouped.withColumnRenamed("id", "row_id"), "row_id", "left").select(
        "row_id", F.coalesce("comp", "row_id").alias("comp")))

    # Buckets with several families: every member outside the largest one meets all members, in blocks.
    placed = members.select("bucket", "row_id").join(in_family, "row_id")
    parts = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    several = parts.groupBy("bucket").agg(
        F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("families")).where("families > 1")
    blocks = several.select(
        "bucket", F.col("top.comp").alias("top"), F.ceil(F.col("top.n") / BLOCK_ROWS).cast("int").alias("large"),
        F.ceil((F.col("n") - F.col("top.n")) / BLOCK_ROWS).cast("int").alias("small"))
    in_block = placed.join(blocks, "bucket").withColumn("block", F.when(
        F.col("comp") == F.col("top"), _spread(F.col("row_id"), F.col("large"), 1)).otherwise(
        F.col("large") + _spread(F.col("row_id"), F.col("small"), 1)))
    meeting = in_block.withColumn("other", F.explode(F.sequence(
        F.when(F.col("block") < F.col("large"), F.col("large")).otherwise(F.lit(0)),
        F.col("large") + F.col("small") - 1))).select(
        "bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "row_id", "comp")
    bridges = _in_order(meeting.join(mins, "row_id"), ["bucket", "lo", "hi"]).select(
        "bucket", "lo", "hi", "block", "comp", "mins").mapInArrow(
        releasing(_bridges, threshold=threshold, tolerance=tolerance), "a long, b long")
    united = components(bridges).select(F.col("id").alias("comp"), F.col("comp").alias("low"))
    sizes_of = lambda df: df.groupBy("comp").agg(F.count(F.lit(1)).alias("n"))
    families = in_family.join(united, "comp", "left").select("row_id", F.coalesce("low", "comp").alias("comp"))
    families = checkpointed(families.join(sizes_of(families).where("n > 1"), "comp"))

    # Every document against its own family, exactly.
    sets = checkpointed(source.select("row_id", "text").join(families.select("row_id"), "row_id", "left_semi").mapInArrow(
        releasing(_sets, size=shingle_words), "row_id long, items binary"))
    cut = families.withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")).withColumn(
        "parts", F.ceil(F.col("n") / GUEST_ROWS).cast("int")).withColumn(
        "home", _spread(F.col("row_id"), F.col("blocks"), 3))   # of two blocks, only the earlier one's guests tell links
    guests = cut.withColumn("part", _spread(F.col("row_id"), F.col("parts"), 2)).select(
        "row_id", "comp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "part",
        F.lit(1).alias("guest"), "home").withColumn("tells", F.col("block") >= F.col("home")).drop("home")
    hosts = cut.select(
        "row_id", "comp", F.col("home").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(0).alias("guest"), F.lit(False).alias("tells"))
    held = sets.join(firsts.select("row_id", "copies"), "row_id")
    tasks = _in_order(guests.unionByName(hosts).join(held, "row_id"), ["comp", "block", "part"], "guest").select(
        "comp", "block", "part", "guest", "tells", "row_id", "copies", "items")
    counted = checkpointed(tasks.mapInArrow(
        releasing(_count_links, threshold=threshold), "row_id long, other long, links long"))
    classes = components(counted.where("other IS NOT NULL").select(F.col("row_id").alias("a"), F.col("other").alias("b")))
    groups = counted.groupBy("row_id").agg(F.sum("links").alias("links")).join(
        classes.select(F.col("id").alias("row_id"), F.col("comp").alias("group")), "row_id")
    stands = firsts.join(groups, "row_id", "left").select(
        "words", F.col("row_id").alias("copy_of"), F.coalesce("group", "row_id").alias("group"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    result = profile.select("row_id", "doc_id", "words").join(stands, "words", "left").select(
        "row_id", "doc_id", F.coalesce("group", "row_id").alias("group"), F.coalesce("copy_of", "row_id").alias("copy_of"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return rows, row_id, checkpointed(result)


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs`` (a stored table): ``doc_id, class_id, n_links``.

    ``n_links`` counts the other documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or
    more, copies included; ``class_id`` is the smallest id among all documents that such links connect. A text of
    one to four words has one shingle of all its words. Null, empty and blank texts have no shingles: no links, each
    a class of its own. Repeated rows are copies of each other. Null ids are allowed (a class of null ids only has
    a null ``class_id``). An empty table gives no rows; other columns are not read."""
    _, _, linked = linked_groups(docs, id_col, text_col, **options)
    least = linked.groupBy("group").agg(F.min("doc_id").alias("class_id"))
    return linked.join(least, "group").select("doc_id", "class_id", "n_links")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` (a stored table) with one row of each class: the one with the smallest id. All columns stay.

    A null id comes after all others; of rows with the same id the one that lies first in the table stays. Texts without a
    shingle (null, empty, blank) are classes of their own and all stay. An empty table gives no rows."""
    rows, row_id, linked = linked_groups(docs, id_col, text_col, **options)
    first = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row_id")
    stay = linked.groupBy("group").agg(F.min(first).alias("stay")).select(
        F.col("stay.row_id").alias(row_id))
    return rows.join(stay, row_id, "left_semi").drop(row_id)
