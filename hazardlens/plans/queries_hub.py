"""Queries for the hub reports."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.operators.explore import distinct_values
from hazardlens.operators.rollups import CUBE_INPUTS, Rollups
from hazardlens.plans import hub as H
from hazardlens.plans.inputs import EVENT_TYPES, SOURCES, Inputs
from hazardlens.plans.registry import query, rounded, sql_of
from hazardlens.schema import QUALITY_FLAGS, QUALITY_LABELS, SEVERITY_BANDS
from hazardlens.session import checkpointed, scratch_path


def _count_columns(column: str, values: list[str]) -> str:
    return ", ".join(f"count(*) FILTER ({column} = '{v}') AS \"{v}\"" for v in values)


def _percent_columns(columns: list[str]) -> str:
    return ", ".join(f"round(avg({c}) * 100, 1) AS {c}" for c in columns)


@query("a04_kpi_block", """SELECT count(*) AS events,
    round(count(*) / CAST(count(DISTINCT day) AS DOUBLE), 6) AS avg_per_day,
    (SELECT max(n) FROM (SELECT count(*) AS n FROM hub GROUP BY day)) AS peak_day_volume,
    round(quantile_cont(CAST(severity AS DOUBLE), 0.5), 6) AS median_severity,
    count(DISTINCT source) AS sources,
    count(DISTINCT country_resolved) FILTER (country_resolved <> 'UNK') AS countries,
    count(DISTINCT event_type) AS event_types,
    round(100.0 * (SELECT sum(n) FROM top_countries) / count(*), 6) AS top_country_share_pct FROM hub""")
def _(i: Inputs) -> DataFrame:
    return rounded(H.kpis(i.hub), "avg_per_day", "median_severity", "top_country_share_pct")


@query("a05_daily_totals", "SELECT day, count(*) AS n FROM hub GROUP BY day")
def _(i: Inputs) -> DataFrame:
    return H.daily_totals(i.hub)


@query("a06_daily_by_source", "SELECT day, source, count(*) AS n FROM hub GROUP BY day, source")
def _(i: Inputs) -> DataFrame:
    return H.daily_by_source(i.hub)


@query("a07_source_type_matrix",
       f"SELECT source, {_count_columns('event_type', EVENT_TYPES)} FROM hub GROUP BY source")
def _(i: Inputs) -> DataFrame:
    return H.count_matrix(i.hub, "source", "event_type", EVENT_TYPES)


_HOURS = ", ".join(f"count(*) FILTER (hour = {h}) AS h{h:02d}" for h in range(24))


@query("a08_weekday_hour_matrix",
       ", week(weekday_no, weekday) AS (VALUES (0, 'Mon'), (1, 'Tue'), (2, 'Wed'), (3, 'Thu'), (4, 'Fri'), (5, 'Sat'), "
       f"(6, 'Sun')) SELECT weekday_no, weekday, {_HOURS} FROM week LEFT JOIN hub USING (weekday) "
       "GROUP BY weekday_no, weekday")
def _(i: Inputs) -> DataFrame:
    return H.weekday_hour_matrix(i.hub)


@query("a09_source_tempo", """, d AS (SELECT day, source, count(*) AS n FROM hub GROUP BY day, source)
    SELECT source, round(avg(n), 6) AS avg_daily, max(n) AS peak_day, count(DISTINCT day) AS active_days,
    round(max(n) / avg(n), 2) AS peak_to_avg FROM d GROUP BY source""")
def _(i: Inputs) -> DataFrame:
    return rounded(H.source_tempo(i.hub), "avg_daily")


@query("a10_top_type_trend",
       "SELECT day, event_type, count(*) AS n FROM hub WHERE event_type IN (SELECT event_type FROM top_types) GROUP BY ALL")
def _(i: Inputs) -> DataFrame:
    return H.top_type_trend(i.hub)


@query("a11_severity_boxes", """, s AS (SELECT event_type, CAST(severity AS DOUBLE) AS v FROM hub WHERE event_type IN
      (SELECT event_type FROM top_types)),
    b AS (SELECT event_type, count(*) AS events, min(v) AS lo, quantile_cont(v, 0.25) AS q1,
      quantile_cont(v, 0.5) AS mid, quantile_cont(v, 0.75) AS q3, max(v) AS hi FROM s GROUP BY event_type)
    SELECT event_type, any_value(events) AS events, round(any_value(lo), 6) AS min_severity, round(any_value(q1), 6) AS q1,
      round(any_value(mid), 6) AS median, round(any_value(q3), 6) AS q3, round(any_value(hi), 6) AS max_severity,
      count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
    FROM s JOIN b USING (event_type) GROUP BY event_type""")
def _(i: Inputs) -> DataFrame:
    return rounded(H.severity_boxes(i.hub), "min_severity", "q1", "median", "q3", "max_severity")


@query("a12_severity_histogram", """SELECT source,
    CAST(least(floor(round(CAST(severity AS DOUBLE), 6) * 30) + 1, 30) AS INTEGER) AS bin, count(*) AS n
    FROM hub GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    return H.severity_histogram(i.hub)


_BANDS = ", ".join(f"('{b}')" for b in SEVERITY_BANDS)
_MIX = (f", bands(severity_band) AS (VALUES {_BANDS}), mix AS (SELECT s.source, b.severity_band, count(h.source) AS n "
        "FROM (SELECT DISTINCT source FROM hub) s CROSS JOIN bands b LEFT JOIN hub h ON h.source = s.source "
        "AND h.severity_band = b.severity_band GROUP BY ALL) ")


@query("a13_severity_bands", _MIX + "SELECT source, severity_band, n FROM mix")
def _(i: Inputs) -> DataFrame:
    return H.severity_mix(i.hub).drop("pct")


@query("w04_band_share_of_source",
       _MIX + "SELECT source, severity_band, n, round(n / CAST(sum(n) OVER (PARTITION BY source) AS DOUBLE) * 100.0, 6) "
              "AS pct FROM mix")
def _(i: Inputs) -> DataFrame:
    return rounded(H.severity_mix(i.hub), "pct")


_MEANS = ", ".join(f"coalesce(round(avg(severity) FILTER (event_type = '{t}'), 6), 0.0) AS \"{t}\"" for t in EVENT_TYPES)


@query("a14_mean_severity_matrix", f"SELECT source, {_MEANS} FROM hub WHERE event_type IN (SELECT event_type FROM "
                                   "top_types) GROUP BY source")
def _(i: Inputs) -> DataFrame:
    return rounded(H.mean_severity_matrix(i.hub, EVENT_TYPES), *EVENT_TYPES)


@query("a15_country_risk", """SELECT country_resolved, count(*) AS events, round(avg(severity), 6) AS avg_severity,
    max(severity) AS max_severity, round(avg(has_any_geo) * 100.0, 1) AS geo_coverage FROM known
    GROUP BY country_resolved ORDER BY events DESC, country_resolved LIMIT 12""")
def _(i: Inputs) -> DataFrame:
    return rounded(H.country_risk(i.hub), "avg_severity")


@query("a16_country_counts", "SELECT country_resolved, count(*) AS n FROM known GROUP BY country_resolved")
def _(i: Inputs) -> DataFrame:
    return H.country_counts(i.hub)


@query("a17_month_by_country", "SELECT month, country_resolved, count(*) AS n FROM known WHERE country_resolved IN "
                               "(SELECT country_resolved FROM top_countries) GROUP BY ALL")
def _(i: Inputs) -> DataFrame:
    return H.month_by_country(i.hub)


@query("a18_country_source_matrix",
       f"SELECT country_resolved, {_count_columns('source', SOURCES)} FROM known WHERE country_resolved IN "
       "(SELECT country_resolved FROM top_countries) GROUP BY country_resolved")
def _(i: Inputs) -> DataFrame:
    return H.country_source_matrix(i.hub, SOURCES)


@query("a19_country_latest", """SELECT country_resolved, count(*) AS events, round(avg(severity), 6) AS avg_severity,
    strftime(max(ts), '%Y-%m-%d %H:%M') AS latest_ts FROM known GROUP BY country_resolved
    ORDER BY events DESC, country_resolved LIMIT 12""")
def _(i: Inputs) -> DataFrame:
    return rounded(H.country_latest(i.hub), "avg_severity")


_INDICATORS = [*QUALITY_FLAGS, "has_any_geo", "completeness_score"]


@query("a20_quality_summary", " UNION ALL ".join(
    f"SELECT '{QUALITY_LABELS[c]}' AS metric, round(avg({c}), 6) AS coverage, round(avg({c}) * 100, 1) AS coverage_pct "
    "FROM hub" for c in _INDICATORS))
def _(i: Inputs) -> DataFrame:
    return rounded(H.quality_summary(i.hub), "coverage")


@query("a21_quality_by_source", f"SELECT source, {_percent_columns(_INDICATORS)} FROM hub GROUP BY source")
def _(i: Inputs) -> DataFrame:
    return H.quality_by(i.hub, "source")


@query("a22_quality_trend", """SELECT day, round(avg(completeness_score), 6) AS completeness_score,
    round(avg(has_any_geo), 6) AS has_any_geo, round(avg(has_text), 6) AS has_text,
    round(avg(has_classify_conf), 6) AS has_classify_conf FROM hub GROUP BY day""")
def _(i: Inputs) -> DataFrame:
    return rounded(H.quality_trend(i.hub), "completeness_score", "has_any_geo", "has_text", "has_classify_conf")


@query("a23_quality_by_type", f"SELECT event_type, {_percent_columns(QUALITY_FLAGS)} FROM hub WHERE event_type IN "
                              "(SELECT event_type FROM top_types) GROUP BY event_type")
def _(i: Inputs) -> DataFrame:
    return H.quality_by_top_type(i.hub)


_DAILY = ", d AS (SELECT day, count(*) AS n FROM hub GROUP BY day) "


@query("w02_rolling_7d", _DAILY + "SELECT day, n, round(avg(n) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND "
                                  "CURRENT ROW), 6) AS rolling_7d FROM d")
def _(i: Inputs) -> DataFrame:
    return rounded(H.rolling_mean(H.daily_totals(i.hub)), "rolling_7d")


@query("w02_rolling_7d_calendar",
       ", d AS (SELECT day, count(*) AS n FROM hub GROUP BY day) SELECT day, n, round(avg(n) OVER "
       "(ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 6) AS rolling_7d FROM d")
def _(i: Inputs) -> DataFrame:
    return rounded(H.rolling_mean_calendar(H.daily_totals(i.hub)), "rolling_7d")


@query("w03_share_of_day", """, d AS (SELECT day, source, count(*) AS n FROM hub GROUP BY day, source)
    SELECT day, source, n, round(n / CAST(sum(n) OVER (PARTITION BY day) AS DOUBLE) * 100.0, 6) AS share_pct FROM d""")
def _(i: Inputs) -> DataFrame:
    return rounded(H.share_of_day(i.hub), "share_pct")


@query("w08_peak_day", _DAILY + "SELECT day, n FROM d ORDER BY n DESC, day LIMIT 1")
def _(i: Inputs) -> DataFrame:
    return H.peak_day(i.hub)


@query("l03_top_countries", "SELECT country_resolved, n FROM top_countries")
def _(i: Inputs) -> DataFrame:
    return H.country_counts(i.hub, 12)


@query("l03_top_types", "SELECT event_type, n FROM top_types")
def _(i: Inputs) -> DataFrame:
    return H.top_values(i.hub, "event_type", 8)


@query("j11_top_type_rows", "SELECT source, event_type, ts FROM hub WHERE event_type IN (SELECT event_type FROM hub "
                            "GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 3)")
def _(i: Inputs) -> DataFrame:
    return H.only_top(i.hub, "event_type", 3).select("source", "event_type", "ts")


@query("u08_country_list", "SELECT DISTINCT country_resolved FROM hub ORDER BY country_resolved LIMIT 200")
def _(i: Inputs) -> DataFrame:
    return distinct_values(i.hub, "country_resolved", 200)


# ---- the same reports from daily cubes ----

_ROLLUPS: dict[tuple[str, str], str] = {}
_ROLLUPS_LOCK = threading.Lock()
_REPLACED = "2024-01-10"


def _rollups(i: Inputs) -> Rollups:
    """Cubes of all events, written once per application: two batches, the second with late rows of every day, then a day that
    was counted twice and is replaced."""
    key = (i.spark.sparkContext.applicationId, i.folder)
    with _ROLLUPS_LOCK:
        if key not in _ROLLUPS:
            path = scratch_path(i.spark, "rollups")
            cubes, late = Rollups(i.spark, path), F.col("event_id").cast("long") % 3 == 2
            cubes.add(i.enriched.where(~late), ("events", 0))
            cubes.add(i.enriched.where(late), ("events", 1))
            cubes.add(i.enriched.where(late), ("events", 1))       # a replay adds nothing
            day = checkpointed(i.enriched.where(F.to_date("ts") == _REPLACED).select(*CUBE_INPUTS))
            cubes.add(day)
            cubes.replace_days(day, [_REPLACED])
            cubes.tidy()
            _ROLLUPS[key] = path
    return Rollups(i.spark, _ROLLUPS[key])


def _from_rollups(name: str, of: str, report: Callable[[Rollups], DataFrame]) -> None:
    """Register a report from cubes beside the one from events: both have the same counterpart."""
    query(name, sql_of(of))(lambda i: report(_rollups(i)))


_from_rollups("a04_kpi_block_rollup", "a04_kpi_block", lambda r: rounded(
    r.kpis(), "avg_per_day", "median_severity", "top_country_share_pct"))
_from_rollups("a05_daily_totals_rollup", "a05_daily_totals", lambda r: H.daily_totals(r.base("hours")))
_from_rollups("a07_source_type_matrix_rollup", "a07_source_type_matrix", lambda r: H.count_matrix(
    r.base("types"), "source", "event_type", EVENT_TYPES))
_from_rollups("a08_weekday_hour_matrix_rollup", "a08_weekday_hour_matrix", lambda r: H.weekday_hour_matrix(r.base("hours")))
_from_rollups("a11_severity_boxes_rollup", "a11_severity_boxes", lambda r: rounded(
    H.severity_boxes(r.base("severities")), "min_severity", "q1", "median", "q3", "max_severity"))
_from_rollups("a12_severity_histogram_rollup", "a12_severity_histogram", lambda r: H.severity_histogram(r.base("severities")))
_from_rollups("a13_severity_bands_rollup", "a13_severity_bands", lambda r: H.severity_mix(r.base("severities")).drop("pct"))
_from_rollups("a15_country_risk_rollup", "a15_country_risk", lambda r: rounded(H.country_risk(r.base("places")), "avg_severity"))
_from_rollups("a17_month_by_country_rollup", "a17_month_by_country", lambda r: H.month_by_country(r.base("places")))
_from_rollups("a19_country_latest_rollup", "a19_country_latest", lambda r: rounded(H.country_latest(r.base("places")), "avg_severity"))


@query("a20_quality_summary_rollup", f"SELECT metric, coverage FROM ({sql_of('a20_quality_summary')})")
def _(i: Inputs) -> DataFrame:
    return rounded(H.quality_summary(_rollups(i).base("quality")), "coverage").drop("coverage_pct")
