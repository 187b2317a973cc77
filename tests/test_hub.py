"""Hub reports on literal frames."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hazardlens.plans import hub as H

COLUMNS = ("source string, event_type string, ts timestamp, severity float, country string, geo_country string, "
           "lat double, lon double, geo_lat double, geo_lon double, text string, classify_conf float")


def _row(source, kind, day, severity=0.5, country="US", hour=0, geo=None, lat=1.0, text="x"):
    return (source, kind, datetime(2024, 1, day, hour), severity, country, geo, lat, lat, None, None, text, 1.0)


@pytest.fixture(scope="module")
def base(spark):
    rows = [
        _row("usgs", "quake", 1, 0.0), _row("usgs", "quake", 1, 0.2, hour=23), _row("gdelt", "flood", 1, 0.2001, "  ", geo="PH"),
        _row("gdelt", "flood", 3, 1.0, None), _row(None, None, 3, None, "PH", lat=None, text=" "),
        _row("usgs", "quake", 10, 0.6, "DE"),
    ]
    return H.hub_base(spark.createDataFrame(rows, COLUMNS)).persist()


def test_base_columns(base):
    rows = sorted(base.collect(), key=lambda r: (r.ts, r.severity))
    assert [r.country_resolved for r in rows] == ["US", "PH", "US", "PH", "UNK", "DE"]
    assert [r.severity_band for r in rows] == ["very low", "low", "very low", "very low", "critical", "medium"]
    gap = rows[3]
    assert (gap.source, gap.event_type, gap.severity) == ("unknown", "unknown", 0.0)
    assert (gap.has_raw_coords, gap.has_text, gap.has_any_geo) == (0, 0, 0)
    assert gap.completeness_score == pytest.approx(2 / 6)
    assert rows[0].weekday == "Mon" and rows[2].hour == 23


def test_window_keeps_whole_first_day(spark, base):
    kept = H.time_window(base, 8).select("day").distinct().collect()
    assert {r.day.day for r in kept} == {3, 10}
    assert H.time_window(base, 30, ["gdelt"]).count() == 2


def test_kpis(base):
    k = H.kpis(base, top_countries=1).first()
    assert (k.events, k.peak_day_volume, k.sources, k.countries, k.event_types) == (6, 3, 3, 3, 3)
    assert k.avg_per_day == pytest.approx(2.0)
    assert k.median_severity == pytest.approx((0.2 + 0.2001) / 2, abs=1e-6)
    assert k.top_country_share_pct == pytest.approx(100 * 2 / 6)


def test_rolling_rows_and_calendar_days_differ_on_gaps(base):
    daily = H.daily_totals(base)
    rows = [(r.day.day, r.rolling_7d) for r in H.rolling_mean(daily).orderBy("day").collect()]
    assert rows == [(1, 3.0), (3, 2.5), (10, 2.0)]
    days = [(r.day.day, r.rolling_7d) for r in H.rolling_mean_calendar(daily).orderBy("day").collect()]
    assert days == [(1, 3.0), (3, 2.5), (10, 1.0)]


def test_shares_and_zero_filled_bands(base):
    shares = {(r.day.day, r.source): r.share_pct for r in H.share_of_day(base).collect()}
    assert shares[(1, "usgs")] == pytest.approx(200 / 3) and shares[(10, "usgs")] == 100.0
    mix = {(r.source, r.severity_band): (r.n, r.pct) for r in H.severity_mix(base).collect()}
    assert len(mix) == 15 and mix[("usgs", "critical")] == (0, 0.0) and mix[("gdelt", "critical")] == (1, 50.0)


def test_weekday_hours_keep_empty_days(base):
    rows = H.weekday_hour_matrix(base).orderBy("weekday_no").collect()
    assert [r.weekday for r in rows] == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert rows[0].h00 == 2 and rows[0].h23 == 1 and rows[6].h12 == 0


def test_boxes_count_outliers(spark):
    rows = [_row("usgs", "quake", 1, s) for s in [0.4, 0.4, 0.5, 0.5, 0.5, 0.6, 0.6, 1.0, 0.0]]
    box = H.severity_boxes(H.hub_base(spark.createDataFrame(rows, COLUMNS))).first()
    assert box.events == 9 and box.median == pytest.approx(0.5, abs=1e-6) and box.outliers == 2


def test_histogram_last_bin_includes_one(base):
    got = {(r.source, r.bin): r.n for r in H.severity_histogram(base).collect()}
    assert got[("gdelt", 30)] == 1 and got[("usgs", 1)] == 1 and got[("usgs", 19)] == 1


def test_country_reports(base):
    risk = {r.country_resolved: r for r in H.country_risk(base).collect()}
    assert set(risk) == {"US", "PH", "DE"} and risk["PH"].events == 2 and risk["PH"].geo_coverage == 50.0
    assert [r.country_resolved for r in H.country_counts(base, 2).orderBy(F.col("n").desc(), "country_resolved").collect()] == [
        "PH", "US"]
    latest = {r.country_resolved: r.latest_ts for r in H.country_latest(base).collect()}
    assert latest["US"] == "2024-01-01 23:00"
    assert H.peak_day(base).first().day.day == 1


def test_quality_reports(base):
    summary = {r.metric: r.coverage_pct for r in H.quality_summary(base).collect()}
    assert summary["raw coordinates"] == 83.3 and summary["classification confidence"] == 100.0
    assert {r.source for r in H.quality_by(base, "source").collect()} == {"usgs", "gdelt", "unknown"}
    assert H.quality_trend(base).count() == 3 and H.quality_by_top_type(base, 1).count() == 1


def test_matrices(base):
    matrix = {r.source: r.asDict() for r in H.count_matrix(base, "source", "event_type", ["quake", "flood"]).collect()}
    assert matrix["usgs"] == {"source": "usgs", "quake": 3, "flood": 0}
    means = {r.source: r.flood for r in H.mean_severity_matrix(base, ["quake", "flood"]).collect()}
    assert means["usgs"] == 0.0 and means["gdelt"] == pytest.approx(0.60005, abs=1e-5)
