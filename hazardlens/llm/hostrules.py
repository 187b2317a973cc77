"""Quality rules judged per host.

Document rules are array expressions over the words and lines of a text. Their failures are counted per host and
shrunk by a beta prior that is fitted to all hosts (moments of the beta-binomial), so a host with few documents
is judged near the average. The verdict on a host goes back to its documents. Only (id, host, counts) rows are
shuffled, and failures are counted before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.llm.common import WORD, checkpointed, let

WINDOW_WORDS = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: A host is rejected when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
SYMBOLS = r"[#*$%&|<>]"


def _covered(windows: Column, width: int) -> Column:
    """Words inside windows whose value is found twice or more. ``windows``: one hash per start."""
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
    same = lambda a, b: F.coalesce(a.hash == b.hash, F.lit(False))
    repeated = let(ordered, lambda o: F.sort_array(F.transform(
        F.filter(F.transform(o, lambda x, i: F.struct(
            x["at"].alias("at"), (same(F.get(o, i - 1), x) | same(F.get(o, i + 1), x)).alias("again"))),
            lambda x: x.again), lambda x: x["at"])))
    return let(repeated, lambda r: F.aggregate(
        F.transform(r, lambda at, i: F.least(F.lit(width), F.coalesce(F.get(r, i + 1) - at, F.lit(width)))),
        F.lit(0), lambda total, x: total + x))


def repeated_words(words: Column, width: int = WINDOW_WORDS) -> Column:
    """Words in windows of ``width`` words that occur twice or more in the text, first ones included.

    Windows are compared by 64-bit hashes of hashed words."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = let(hashes, lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])))
    return F.when(F.size(words) <= width, F.lit(0)).otherwise(let(windows, lambda w: F.when(
        F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_covered(w, width))))


def document_counts(text: Column) -> Column:
    """Struct of ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text; null counts as empty."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD))
    of_words = let(F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words")))
    return F.struct(
        of_words.n_words.alias("n_words"), of_words.word_chars.alias("word_chars"),
        (F.char_length(whole) - F.char_length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        of_words.n_repeat_words.alias("n_repeat_words"))


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, null where there is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def fitted_prior(hosts: DataFrame) -> tuple[float, float]:
    """Beta prior of the failure rates of ``hosts`` (n, failed), by the moments of the beta-binomial."""
    total, failed, count, squares = hosts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("failed"), F.lit(0)), F.count(F.lit(1)),
        F.coalesce(F.sum(F.col("n").cast("double") * F.col("n")), F.lit(0.0))).first()
    if not total:
        return 1.0, 1.0
    mean = min(max(failed / total, 0.5 / total), 1 - 0.5 / total)
    spread = hosts.agg(F.sum(F.col("n") * F.pow(F.col("failed") / F.col("n") - F.lit(mean), 2))).first()[0]
    room = total - squares / total - (count - 1)
    within = (spread / (mean * (1 - mean)) - (count - 1)) / room if room > 0 else 0.0
    within = min(max(within, 1e-3), 0.999)      # no or full correlation inside hosts would mean no prior at all
    strength = 1 / within - 1
    return mean * strength, (1 - mean) * strength


def judge(docs: DataFrame, host: Column, id_col: str = "doc_id", text_col: str = "text",
          max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the counts, ``base_failed``, ``host_rate`` and ``kept``.

    A document fails with fewer than 20 words or with more than 30 % repeated words. ``kept`` is false for those and
    for all documents of a host whose shrunk failure rate is above ``max_host_rate``. Documents without a host are
    one host. Null and empty texts have no words and fail. Repeated rows count each; an empty table gives no rows;
    other columns are not read."""
    measured = docs.select(F.col(id_col).alias("doc_id"), F.array(host.cast("string")).alias("host"),
                           document_counts(F.col(text_col)).alias("counts")).select("doc_id", "host", "counts.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = checkpointed(measured.withColumn("base_failed", failed))
    hosts = checkpointed(rows.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("base_failed"), 1)).alias("failed")))
    a, b = fitted_prior(hosts)
    rates = hosts.select("host", ((F.col("failed") + a) / (F.col("n") + (a + b))).alias("host_rate"))
    return rows.join(rates, "host").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate",
        (~F.col("base_failed") & (F.col("host_rate") <= max_host_rate)).alias("kept"))
