"""Reports over the enriched table: volume, timing, severity, geography and data quality.

Every report starts from :func:`hub_base` (one narrow scan) and aggregates map-side; windows and pivots
run on the aggregated rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.schema import QUALITY_FLAGS, QUALITY_LABELS, SEVERITY_BANDS, WEEKDAYS

def _n(df: DataFrame, name: str = "n") -> Column:
    """Events of a group. Rows with a ``weight`` stand for that many (see :mod:`hazardlens.operators.rollups`)."""
    return (F.sum("weight") if "weight" in df.columns else F.count(F.lit(1))).alias(name)


def _mean(df: DataFrame, c: str) -> Column:
    if "weight" not in df.columns:
        return F.avg(c)
    return F.sum(F.col(c) * F.col("weight")) / F.sum(F.when(F.col(c).isNotNull(), F.col("weight")))


# ---- base columns ----

def _present(c: str) -> Column:
    return F.col(c).isNotNull() & (F.trim(c) != "")


def resolved_country() -> Column:
    return (F.when(_present("country"), F.col("country"))
            .when(_present("geo_country"), F.col("geo_country")).otherwise("UNK"))


def quality_flags() -> dict[str, Column]:
    tests = {
        "has_raw_coords": F.col("lat").isNotNull() & F.col("lon").isNotNull(),
        "has_geo_coords": F.col("geo_lat").isNotNull() & F.col("geo_lon").isNotNull(),
        "has_country": _present("country"),
        "has_geo_country": _present("geo_country"),
        "has_text": _present("text"),
        "has_classify_conf": F.col("classify_conf").isNotNull(),
    }
    return {name: F.when(test, 1).otherwise(0) for name, test in tests.items()}


def flagged_events(enriched: DataFrame) -> DataFrame:
    """Source, type, time, severity, resolved country and the six quality flags."""
    return enriched.select(
        "source", "event_type", "ts", "severity", resolved_country().alias("country_resolved"),
        *[flag.alias(name) for name, flag in quality_flags().items()])


def fill_defaults(flagged: DataFrame) -> DataFrame:
    defaults = {"severity": 0.0, "source": "unknown", "event_type": "unknown", "country_resolved": "UNK",
                **{flag: 0 for flag in QUALITY_FLAGS}}
    return flagged.na.drop(subset=["ts"]).na.fill({c: v for c, v in defaults.items() if c in flagged.columns})


def time_window(df: DataFrame, days: int, sources: list[str] | None = None,
                anchor: DataFrame | None = None) -> DataFrame:
    """Rows of the last ``days`` calendar days up to the newest row, optionally of some sources.

    ``anchor`` is a cheaper frame with the same newest ``ts`` (for example the stored table).
    """
    newest = (anchor if anchor is not None else df).agg(F.max("ts")).scalar()
    start = F.date_trunc("day", newest) - F.make_interval(days=F.lit(days - 1))
    kept = df.where(F.col("ts") >= start)
    return kept.where(F.col("source").isin(sources)) if sources else kept


def _decimal(severity: Column) -> Column:
    """The score as a decimal number, free of 32-bit widening (0.7, not 0.69999998)."""
    return F.round(severity.cast("double"), 6)


def severity_band(severity: Column) -> Column:
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), _decimal(severity)))
    very_low, low, medium, high, critical = SEVERITY_BANDS
    return (F.when(severity.isNull(), None).when(clipped <= 0.2, very_low).when(clipped <= 0.4, low)
            .when(clipped <= 0.6, medium).when(clipped <= 0.8, high).otherwise(critical))


def derive_columns(df: DataFrame) -> DataFrame:
    flags = [F.col(f) for f in QUALITY_FLAGS]
    return df.withColumns({
        "day": F.date_trunc("day", "ts"),
        "month": F.date_format("ts", "yyyy-MM"),
        "weekday": F.date_format("ts", "E"),
        "hour": F.hour("ts"),
        "has_any_geo": F.greatest("has_raw_coords", "has_geo_coords"),
        "completeness_score": sum(flags[1:], flags[0]) / len(flags),
        "severity_band": severity_band(F.col("severity")),
    })


def hub_base(enriched: DataFrame, days: int = 180, sources: list[str] | None = None,
             anchor: DataFrame | None = None) -> DataFrame:
    return derive_columns(time_window(fill_defaults(flagged_events(enriched)), days, sources, anchor))


def known_country(base: DataFrame) -> DataFrame:
    return base.where(F.col("country_resolved") != "UNK")


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values with their counts; the value breaks ties."""
    return df.groupBy(column).agg(_n(df)).orderBy(F.col("n").desc(), column).limit(n)


def only_top(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose value is among the ``n`` most frequent. The list has at most ``n`` rows: broadcast."""
    return df.join(F.broadcast(top_values(df, column, n).select(column)), column, "left_semi")


# ---- overview ----

def daily_totals(base: DataFrame) -> DataFrame:
    return base.groupBy("day").agg(_n(base))


def daily_by_source(base: DataFrame) -> DataFrame:
    return base.groupBy("day", "source").agg(_n(base))


def kpis(base: DataFrame, top_countries: int = 12) -> DataFrame:
    """One row of headline figures from a single pass.

    Grouping sets count the events per day, source, type, country and severity at once. What is left is
    as small as these dimensions together (severity has at most 1001 values), and every figure, the exact
    median included, is read from it.
    """
    dims = ["day", "source", "event_type", "country_resolved", "severity"]
    sets = [[F.col(d)] for d in dims]
    kind = F.concat_ws("", *[F.when(F.grouping(d) == 0, F.lit(d)) for d in dims])
    return kpi_figures(base.groupingSets(sets, *dims).agg(_n(base), kind.alias("kind")), top_countries)


def kpi_figures(counts: DataFrame, top_countries: int = 12) -> DataFrame:
    """The headline figures from counts ``n`` per value of each ``kind``."""
    by_size = Window.partitionBy("kind").orderBy(
        F.when(F.col("country_resolved") == "UNK", 1).otherwise(0), F.col("n").desc(), "country_resolved")
    counts = counts.withColumn("rank", F.row_number().over(by_size))
    n, is_known = F.col("n"), F.col("country_resolved") != "UNK"

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    figures = counts.agg(
        F.sum(of("day", n)).alias("events"),
        F.count(of("day", n)).alias("active_days"),
        F.max(of("day", n)).alias("peak_day_volume"),
        F.count(of("source", n)).alias("sources"),
        F.count(of("event_type", n)).alias("event_types"),
        F.count(of("country_resolved", F.when(is_known, n))).alias("countries"),
        F.sum(of("country_resolved", F.when(is_known & (F.col("rank") <= top_countries), n))).alias("leading"),
        F.expr("percentile(severity, 0.5D, if(kind = 'severity', n, 0L))").alias("median_severity"),
    )
    return figures.select(
        "events", (F.col("events") / F.greatest(F.lit(1), "active_days")).alias("avg_per_day"),
        "peak_day_volume", "median_severity", "sources", "countries", "event_types",
        (100.0 * F.coalesce("leading", F.lit(0)) / F.col("events")).alias("top_country_share_pct"))


def peak_day(base: DataFrame) -> DataFrame:
    """Busiest day, the earlier one on a tie."""
    return daily_totals(base).orderBy(F.col("n").desc(), "day").limit(1)


def rolling_mean(daily: DataFrame, rows: int = 7) -> DataFrame:
    """Mean of the last ``rows`` listed days. One row per day, so a single ordered window is small."""
    frame = Window.orderBy("day").rowsBetween(1 - rows, 0)
    return daily.withColumn("rolling_7d", F.avg("n").over(frame))


def rolling_mean_calendar(daily: DataFrame, days: int = 7) -> DataFrame:
    """Mean over the last ``days`` calendar days; days without events lie in the range but have no row."""
    day_no = F.unix_timestamp("day") / 86400
    frame = Window.orderBy(day_no.cast("long")).rangeBetween(1 - days, 0)
    return daily.withColumn("rolling_7d", F.avg("n").over(frame))


def share_of_day(base: DataFrame) -> DataFrame:
    total = F.sum("n").over(Window.partitionBy("day"))
    return daily_by_source(base).withColumn("share_pct", F.col("n") / total * 100.0)


def count_matrix(base: DataFrame, rows: str, columns: str, values: list) -> DataFrame:
    """Zero-filled counts of ``rows`` x ``columns``; the listed values become columns."""
    return base.groupBy(rows).pivot(columns, values).agg(_n(base)).na.fill(0)


# ---- timing ----

def weekday_hour_matrix(base: DataFrame) -> DataFrame:
    """Seven rows in week order with one column per hour; weekdays without events are all zero."""
    spark = base.sparkSession
    hours = list(range(24))
    counts = base.groupBy("weekday").pivot("hour", hours).agg(_n(base))
    rows = ", ".join(f"('{d}', {i})" for i, d in enumerate(WEEKDAYS))
    week = spark.sql(f"SELECT * FROM VALUES {rows} AS week(weekday, weekday_no)")
    joined = week.join(counts, "weekday", "left").na.fill(0, [str(h) for h in hours])
    return joined.select("weekday_no", "weekday", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])


def source_tempo(base: DataFrame) -> DataFrame:
    tempo = daily_by_source(base).groupBy("source").agg(
        F.avg("n").alias("avg_daily"), F.max("n").alias("peak_day"), F.count_distinct("day").alias("active_days"))
    return tempo.withColumn("peak_to_avg", F.round(F.col("peak_day") / F.col("avg_daily"), 2))


def top_type_trend(base: DataFrame, n: int = 8) -> DataFrame:
    return only_top(base, "event_type", n).groupBy("day", "event_type").agg(_n(base))


# ---- severity ----

def severity_boxes(base: DataFrame, n: int = 8) -> DataFrame:
    """Box figures per frequent type, with the number of points beyond 1.5 times the quartile range.

    Works on (type, severity) counts: at most 1001 severities per type.
    """
    counts = only_top(base, "event_type", n).groupBy("event_type", "severity").agg(_n(base))
    sev = F.col("severity").cast("double")
    boxes = counts.groupBy("event_type").agg(
        F.sum("n").alias("events"), F.min(sev).alias("min_severity"),
        F.expr("percentile(CAST(severity AS DOUBLE), 0.25, n)").alias("q1"),
        F.expr("percentile(CAST(severity AS DOUBLE), 0.5, n)").alias("median"),
        F.expr("percentile(CAST(severity AS DOUBLE), 0.75, n)").alias("q3"), F.max(sev).alias("max_severity"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    outside = (sev < F.col("q1") - reach) | (sev > F.col("q3") + reach)
    far = (counts.join(boxes.select("event_type", "q1", "q3"), "event_type")
           .groupBy("event_type").agg(F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outliers")))
    return boxes.join(far, "event_type")


def severity_histogram(base: DataFrame, bins: int = 30) -> DataFrame:
    """Counts by source in equal bins of [0, 1]; the last bin includes 1."""
    bin_no = F.least(F.width_bucket(_decimal(F.col("severity")), F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins))
    return base.groupBy("source", bin_no.cast("int").alias("bin")).agg(_n(base))


def severity_mix(base: DataFrame) -> DataFrame:
    """Counts and share per source and band, every band present."""
    counts = base.groupBy("source", "severity_band").agg(_n(base))
    grid = counts.select("source").distinct().withColumn(
        "severity_band", F.explode(F.array(*[F.lit(b) for b in SEVERITY_BANDS])))
    filled = grid.join(counts, ["source", "severity_band"], "left").na.fill(0, ["n"])
    total = F.sum("n").over(Window.partitionBy("source"))
    return filled.withColumn("pct", F.col("n") / total * 100.0)


def mean_severity_matrix(base: DataFrame, types: list[str], n: int = 8) -> DataFrame:
    return only_top(base, "event_type", n).groupBy("source").pivot("event_type", types).agg(_mean(base, "severity")).na.fill(0.0)


# ---- geography ----

def country_counts(base: DataFrame, n: int | None = None) -> DataFrame:
    known = known_country(base)
    return known.groupBy("country_resolved").agg(_n(known)) if n is None else top_values(known, "country_resolved", n)


def country_risk(base: DataFrame, n: int = 12) -> DataFrame:
    risk = known_country(base).groupBy("country_resolved").agg(
        _n(base, "events"), _mean(base, "severity").alias("avg_severity"),
        F.max("severity").alias("max_severity"), F.round(_mean(base, "has_any_geo") * 100.0, 1).alias("geo_coverage"))
    return risk.orderBy(F.col("events").desc(), "country_resolved").limit(n)


def country_latest(base: DataFrame, n: int = 12) -> DataFrame:
    latest = known_country(base).groupBy("country_resolved").agg(
        _n(base, "events"), _mean(base, "severity").alias("avg_severity"),
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm").alias("latest_ts"))
    return latest.orderBy(F.col("events").desc(), "country_resolved").limit(n)


def month_by_country(base: DataFrame, n: int = 12) -> DataFrame:
    return only_top(known_country(base), "country_resolved", n).groupBy("month", "country_resolved").agg(_n(base))


def country_source_matrix(base: DataFrame, sources: list[str], n: int = 12) -> DataFrame:
    return count_matrix(only_top(known_country(base), "country_resolved", n), "country_resolved", "source", sources)


# ---- data quality ----

INDICATORS = [*QUALITY_FLAGS, "has_any_geo", "completeness_score"]


def quality_summary(base: DataFrame) -> DataFrame:
    """Mean of each indicator, one row per indicator."""
    means = base.agg(*[_mean(base, c).alias(c) for c in INDICATORS])
    pairs = ", ".join(f"'{QUALITY_LABELS[c]}', {c}" for c in INDICATORS)
    longform = means.select(F.expr(f"stack({len(INDICATORS)}, {pairs}) AS (metric, coverage)"))
    return longform.withColumn("coverage_pct", F.round(F.col("coverage") * 100, 1))


def quality_by(base: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    return base.groupBy(key).agg(*[F.round(_mean(base, c) * 100, 1).alias(c) for c in columns or INDICATORS])


def quality_trend(base: DataFrame) -> DataFrame:
    columns = ["completeness_score", "has_any_geo", "has_text", "has_classify_conf"]
    return base.groupBy("day").agg(*[_mean(base, c).alias(c) for c in columns])


def quality_by_top_type(base: DataFrame, n: int = 8) -> DataFrame:
    return quality_by(only_top(base, "event_type", n), "event_type", QUALITY_FLAGS)
