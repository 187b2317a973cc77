"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Targets: all words are shared by weight; a source stops at ``max_repeats`` times its size and the excess is
   shared again until none is above.
2. The mix is ``total / block_words`` blocks. Blocks go to sources by the highest quotients
   ``target / (2 k + 1)``. The same rule applied to the first 1/n, 2/n, ... of the blocks gives the integer quota
   of each of n shards as a difference (the rule never takes a block back when the mix grows).
3. Each source's documents lie on a ring in seeded order; the source's blocks are taken one after another from a
   seeded block on, going round at most ``max_repeats`` times. So a source is cut at its two ends only.

Everything is built from aggregates, bounded windows and arithmetic on (id, source, size) rows; texts are read
once and never shuffled. Word positions are two-level prefix sums: a hot source is spread over hash buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.llm.common import WORD, checkpointed, fresh, ordered_index, with_row_id

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SHARDS = 8
#: A block has at most this many words, and at most 1/BLOCKS_EACH of the smallest target.
BLOCK_WORDS, BLOCKS_EACH = 4096, 256
#: Documents in one bucket of the prefix sums, on average.
BUCKET_ROWS = 1_000


@dataclass
class Mix:
    rows: DataFrame     #: the documents with their row number
    row_id: str         #: that column's name
    plan: DataFrame     #: row_id, doc_id, size, source_size, target, taken, first, run, bounds
    block_words: int


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded(seed: int, key: Column) -> Column:
    """Hex digest that orders ``key`` by chance, the same in every run."""
    return F.md5(F.concat(F.lit(f"mix:{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))


def _place(doc_id: Column, size: Column) -> Column:
    """What orders documents: rows with one id (or none) are told apart by size, so that they do not lie in one bucket."""
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), size.cast("string"))


def _number(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def targets(sources: DataFrame, total: int, weights: tuple[int, ...] = WEIGHTS,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sources`` (source_no, source_size) with ``weight`` and ``target``."""
    each = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    weighed = sources.withColumn("weight", each)
    most = F.col("source_size") * max_repeats
    share, stopped = None, -1
    while True:
        full = F.lit(False) if share is None else most <= share * F.col("weight")
        n, held, rest = weighed.agg(
            F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()
        if n == stopped or not rest:
            break
        share, stopped = (total - held) / rest, n
    return weighed.withColumn("target", F.least(most.cast("double"), F.lit(float(share or 0)) * F.col("weight")))


def quotas(sources: DataFrame, blocks: int, block_words: int, shards: int = SHARDS,
           max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Sainte-Lague: ``source_no`` with ``bounds``, its blocks in the first 1, 2, ... shards.

    Only awards near the fair share can be the last ones, so the others are counted, not listed; if the choice
    touches the edge of what is listed, more is listed."""
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    around = 2
    while True:
        houses = sources.withColumn("house", F.explode(F.sequence(F.lit(1), F.lit(shards)))).withColumn(
            "seats", F.floor(F.lit(blocks) * F.col("house") / shards))
        fair = F.when(F.lit(total) > 0, F.col("target") * F.col("seats") / total).otherwise(0)
        most = F.ceil(F.col("source_size") * max_repeats / block_words)
        edges = houses.withColumn("low", F.greatest(F.lit(0), F.least(most, F.floor(fair)) - around)).withColumn(
            "high", F.least(most, F.ceil(fair) + around))
        sure = edges.groupBy("house").agg((F.first("seats") - F.sum("low")).alias("open"))
        listed = edges.where("high > low").withColumn("k", F.explode(F.expr("sequence(low, high - 1)"))).withColumn(
            "quotient", F.col("target") / (2 * F.col("k") + 1))
        place = F.row_number().over(Window.partitionBy("house").orderBy(F.desc("quotient"), "source_no", "k"))
        won = listed.withColumn("place", place).join(sure, "house").where("place <= open").groupBy(
            "source_no", "house").agg(F.count(F.lit(1)).alias("won"))
        got = checkpointed(edges.join(won, ["source_no", "house"], "left").select(
            "source_no", "house", "low", "high", most.alias("most"),
            (F.col("low") + F.coalesce("won", F.lit(0))).alias("quota")))
        tight = F.expr("(quota = low AND low > 0) OR (quota = high AND high < most)")
        if got.where(tight).isEmpty():
            break
        around *= 4
    return got.groupBy("source_no").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("house", "quota"))), lambda x: x.quota).alias("bounds"))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, shards: int = SHARDS,
             seed: int = 0) -> Mix:
    """The mix of ``docs`` (a stored table), one plan row per document.

    ``taken`` counts the words that the mix takes, repeats included; ``first`` is the document's first word on
    its source's line of taken words (modulo the source's size), ``run`` that line's length, ``bounds`` the
    source's blocks up to each shard. Null text has size 0; a null source is a source of its own, last in order;
    repeated rows count each; rows without words take nothing; an empty table gives an empty plan. Documents with
    equal ids lie in order of size. Other columns are not read.

    Blocks follow the smallest target, down to one word, so that no source is lost."""
    rows, row_id = with_row_id(docs)
    key = F.array(F.col(source_col).cast("string"))     # an array, so that null joins null
    sized = checkpointed(rows.select(
        F.col(row_id).alias("row_id"), F.col(id_col).alias("doc_id"), key.alias("source"),
        word_count(F.col(text_col)).alias("size")).withColumn("mixed", seeded(seed, _place(F.col("doc_id"), F.col("size")))))
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = checkpointed(ordered_index(
        per_source, F.col("source")[0].isNull(), F.col("source")[0], name="source_no"))
    total, n = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    aimed = checkpointed(targets(sources, total, weights, max_repeats))
    least = aimed.where("target > 0").agg(F.min("target")).first()[0] or 1.0
    block = max(1, min(BLOCK_WORDS, int(least) // BLOCKS_EACH))
    blocks = int(total / block + 0.5)
    shares = quotas(aimed, blocks, block, shards, max_repeats)
    size = F.col("source_size")
    start = _number(seeded(seed, F.concat(F.lit("source:"), F.col("source_no").cast("string"))), 15) % F.greatest(
        F.lit(1), F.floor(size / block)) * block
    by_source = aimed.join(shares, "source_no").select(
        "source", "source_no", "source_size", "target", "bounds", start.alias("start"),
        F.least(F.element_at("bounds", -1) * block, size * max_repeats).alias("run"))
    buckets = max(1, n // BUCKET_ROWS)
    bucketed = sized.withColumn("bucket", F.floor(_number(F.col("mixed"), 7) * buckets / (1 << 28)))
    sums = bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words")
    in_bucket = Window.partitionBy("source", "bucket").orderBy("mixed", "size", "row_id").rowsBetween(
        Window.unboundedPreceding, 0)
    placed = bucketed.withColumn("upto", F.sum("size").over(in_bucket)).join(
        sums.select("source", "bucket", before.alias("before")), ["source", "bucket"]).join(by_source, "source")
    first = F.pmod(F.col("before") + F.col("upto") - F.col("size") - F.col("start"), F.greatest(size, F.lit(1)))
    taken = sum((_overlap(turn) for turn in range(-1, max_repeats + 1)), F.lit(0))
    plan = placed.withColumn("first", first).withColumn("taken", taken.cast("long")).select(
        "row_id", "doc_id", "size", "source_size", "target", "taken", "first", "run", "bounds")
    return Mix(rows, row_id, plan, block)


def _overlap(turn: int) -> Column:
    """Words of the document that the line takes on its ``turn``-th time round (-1: begun before the start)."""
    at = F.col("first") + F.col("source_size") * turn
    return F.greatest(F.lit(0), F.least(F.col("run"), at + F.col("size")) - F.greatest(F.lit(0), at))


def spans(mix: Mix, max_repeats: int = MAX_REPEATS, by_shard: bool = True) -> DataFrame:
    """What the mix takes: ``row_id, doc_id, size, turn, shard, word_from, word_to`` (words from 0, end exclusive).

    With ``by_shard`` a span ends where its shard's quota ends; without, ``shard`` is where it begins."""
    limit = F.transform("bounds", lambda b: F.least(b * mix.block_words, F.col("run")))
    line = mix.plan.where("taken > 0").withColumn(
        "turn", F.explode(F.sequence(F.lit(-1), F.lit(max_repeats)))).withColumn(
        "at", F.col("first") + F.col("source_size") * F.col("turn"))
    line = line.withColumn("lo", F.greatest(F.lit(0), F.col("at"))).withColumn(
        "hi", F.least(F.col("run"), F.col("at") + F.col("size"))).where("hi > lo").withColumn("ends", limit)
    if by_shard:
        line = line.select("*", F.posexplode("ends").alias("shard", "end")).withColumn(
            "begin", F.when(F.col("shard") > 0, F.get("ends", F.col("shard") - 1)).otherwise(F.lit(0)))
        line = line.withColumn("lo", F.greatest("lo", "begin")).withColumn("hi", F.least("hi", "end")).where("hi > lo")
    else:
        line = line.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("lo"))))
    return line.select("row_id", "doc_id", "size", "turn", "shard", (F.col("lo") - F.col("at")).alias("word_from"),
                       (F.col("hi") - F.col("at")).alias("word_to"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                    **options) -> DataFrame:
    """The mix as rows like those of ``docs``: one per document and time it is taken, in no order.

    Where a source's run begins or ends inside a document, only the words taken are kept, with single spaces. Texts without
    a word (null, empty, blank) are taken by no mix and go. Repeated rows and null ids are documents of their own, a null
    source is a source; all other columns stay as they are. An empty table gives no rows."""
    mix = plan_mix(docs, id_col, source_col, text_col, **options)
    taken = spans(mix, options.get("max_repeats", MAX_REPEATS), by_shard=False).select(
        F.col("row_id").alias(mix.row_id), "size", "word_from", "word_to")
    names = {c: fresh(docs.columns, f"_{c}") for c in ("size", "word_from", "word_to")}
    joined = mix.rows.join(taken.withColumnsRenamed(names), mix.row_id)
    size, start, end = (F.col(names[c]) for c in ("size", "word_from", "word_to"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0))
    text = F.when(end - start == size, F.col(text_col)).otherwise(F.array_join(
        F.slice(words, (start + 1).cast("int"), (end - start).cast("int")), " "))
    return joined.withColumn(text_col, text).select(*docs.columns)
