"""Paging by position and daily cubes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hazardlens.operators import explore as X
from hazardlens.operators import pages as P
from hazardlens.operators import rollups as R
from hazardlens.operators.rollups import Rollups
from hazardlens.plans import hub as H


@pytest.fixture(scope="module")
def paged(spark, tmp_path_factory):
    rows = spark.range(50_000).select(
        F.format_string("e%05d", F.col("id")).alias("event_id"),
        F.when(F.col("id") % 97 > 0, F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 5000)).alias("ts"))
    path = f"{tmp_path_factory.mktemp('pages')}/t"
    P.write_pages(rows, path, files=10, rows_per_file=2000)
    return rows, path


@pytest.mark.parametrize("page_no, size", [(0, 20), (9_999, 5), (10_000, 1), (199, 250), (24, 2000), (12_499, 4), (12_500, 4), (7, 7142)])
def test_deep_pages_open_few_files(spark, paged, page_no, size):
    rows, path = paged
    page = P.page_at(spark, path, page_no, size)
    want = [tuple(r) for r in X.page(rows, page_no, size).collect()]
    assert [tuple(r) for r in page.rows.collect()] == want
    assert page.files >= 25 and page.files_opened <= size // 1000 + 2 and (page.files_opened == 0) == (not want)


def test_empty_table(spark, folder):
    P.write_pages(spark.createDataFrame([], "event_id string, ts timestamp"), folder + "/p")
    assert P.page_at(spark, folder + "/p", 0, 10).rows.count() == 0


REPORTS = {
    "hours": [H.daily_totals, H.daily_by_source, H.share_of_day, H.source_tempo, H.weekday_hour_matrix],
    "types": [H.top_type_trend, lambda b: H.count_matrix(b, "source", "event_type", ["view", "click"])],
    "severities": [H.severity_boxes, H.severity_histogram, H.severity_mix],
    "places": [H.country_risk, H.country_latest, H.month_by_country],
    # Shares of whole numbers come out the same; a mean of sixths can fall on either side of a rounding edge.
    "quality": [lambda b: H.quality_summary(b).drop("coverage_pct"), H.quality_trend, H.quality_by_top_type,
                lambda b: H.quality_by(b, "source", H.QUALITY_FLAGS)],
}


def figures(df):
    columns = sorted(df.columns)
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(*columns).collect())


def test_reports_from_cubes(spark, inputs, folder):
    enriched = inputs.enriched.cache()
    cubes, day = Rollups(spark, folder + "/r"), "2024-01-10"
    number = F.col("event_id").cast("long")
    changed = F.to_date("ts") == day
    cubes.add(enriched.where(number % 2 == 0), ("s", 0))
    cubes.add(enriched.where(number % 2 == 1), ("s", 1))
    cubes.add(enriched.where(number % 2 == 1), ("s", 1))
    for step in ("appended", "replaced", "tidied"):
        if step == "replaced":
            enriched = enriched.where(~changed | (number % 5 == 0)).withColumn(
                "severity", F.when(changed, F.lit(0.9).cast("float")).otherwise(F.col("severity")))
            old = {f["file"] for f in cubes.table.snapshot().files}
            cubes.replace_days(enriched, [day])
            new = {f["file"] for f in cubes.table.snapshot().files}
            assert {f.split("/")[1] for f in (old ^ new)} == {f"date={day}"}        # other days were not touched
        if step == "tidied":
            cubes.table.compact(tier_files=2)
        base = H.hub_base(enriched)
        assert figures(cubes.kpis()) == figures(H.kpis(base)), step
        for cube, reports in REPORTS.items():
            for k, report in enumerate(reports if step == "replaced" else reports[:1]):
                assert figures(report(cubes.base(cube))) == figures(report(base)), (step, cube, k)
    assert figures(H.daily_totals(cubes.base("hours", days=7))) == figures(H.daily_totals(H.hub_base(enriched, days=7)))


def test_replaced_days_compare_dates_first(spark, inputs, folder, monkeypatch):
    made = []
    monkeypatch.setattr(R, "checkpointed", lambda df: made.append(df) or df)
    rollups = Rollups(spark, folder + "/cubes")
    rollups.add(inputs.enriched)
    before = {tuple(r) for r in H.daily_totals(rollups.base("hours")).collect()}
    rollups.replace_days(inputs.enriched, ["2024-01-10", "no day", "2024-1-11"])
    assert {tuple(r) for r in H.daily_totals(rollups.base("hours")).collect()} == before
    condition = made[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "19732" in condition or "= 2024-01-10" in condition
