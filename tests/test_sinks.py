"""Writers: layout, verification, key de-duplication, insert-only merge."""

from __future__ import annotations

import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hazardlens.operators import explore as X
from hazardlens.schema import REGION_DATE
from hazardlens.sinks import tables as K
from hazardlens.sources import tables as T


@pytest.fixture(scope="module")
def events(spark):
    return spark.range(400).select(
        F.col("id").cast("string").alias("event_id"), F.when(F.col("id") < 300, "gdelt").otherwise("usgs").alias("source"),
        F.lit("t").alias("title"), F.lit("x").alias("text"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"),
        F.timestamp_seconds(1700000000 + F.col("id") * 86400).alias("ts"),
        F.when(F.col("id") % 4 == 0, F.lit(None)).when(F.col("id") % 4 == 1, "1").otherwise("PH").alias("country"),
        F.lit("flood").alias("event_type"), F.lit(0.5).cast("float").alias("severity"),
        F.lit(0.9).cast("float").alias("classify_conf"), F.lit(3).alias("cluster_id"))


def test_by_source_layout(spark, events, folder):
    K.write_by_source(events, folder + "/a")
    K.write_by_source(events, folder + "/b", {"gdelt": 4})
    for name in ("a", "b"):
        back = T.read_table(spark, f"{folder}/{name}")
        assert back.count() == 400 and back.where("source = 'gdelt'").count() == 300
    assert 1 < len(glob.glob(folder + "/b/source=gdelt/*.parquet")) <= 4
    assert T.read_tree(spark, folder + "/b").count() == 400


def test_partition_filter_prunes_folders(spark, events, folder):
    K.write_by_source(events, folder + "/a")
    plan = T.read_table(spark, folder + "/a").where("source = 'usgs'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan


def test_verified_write_reports_rows_and_mismatch(spark, events, folder, monkeypatch):
    assert K.write_verified(events, folder + "/v") == 400
    monkeypatch.setattr(K, "write_parquet", lambda df, path, **kw: (df.count(), df.limit(5).write.parquet(path)))
    with pytest.raises(K.RowCountMismatch):
        K.write_verified(events, folder + "/w")


def test_file_count_and_lines(spark, events, folder):
    K.write_parquet(events, folder + "/p", files=3)
    assert len(glob.glob(folder + "/p/*.parquet")) == 3
    K.write_lines(events.select("event_id", "source"), folder + "/l", files=2)
    assert spark.read.text(folder + "/l").where("value = '7\tgdelt'").count() == 1
    assert K.write_keywords(events.where("false"), folder + "/none") is False
    K.write_documents(events, folder + "/d")
    assert len(spark.read.parquet(folder + "/d").columns) == 12


def test_region_date_table_upserts_and_prunes(spark, events, folder):
    K.write_region_date(events.unionByName(events), folder + "/r")
    table = K.read_region_date(spark, folder + "/r")
    assert table.count() == 400 and table.columns and set(table.columns) == set(REGION_DATE.names)
    assert {r.country for r in table.select("country").distinct().collect()} == {"UNK", "1", "PH"}
    months = X.region_months(table, "1", "2024-01-31", 2)
    assert months.count() == events.where("country = '1' AND date_format(ts, 'yyyy-MM') IN ('2024-01', '2023-12')").count()
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan and "date_bucket" in plan.split("PartitionFilters")[1][:200]


def test_insert_only_is_repeatable(spark, events, folder):
    rows = events.select("event_id", "ts", F.lit("old").alias("origin"))
    store = K.event_store(spark, folder + "/s")
    store.append(rows.where("event_id < '2'"))
    stored = store.read().count()
    incoming = rows.withColumn("origin", F.lit("new"))
    later = incoming.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    stats = K.insert_only(spark, later.unionByName(incoming), folder + "/s")
    assert stats == {"fetched": 800, "inserted": 400 - stored}
    assert K.insert_only(spark, incoming, folder + "/s") == {"fetched": 400, "inserted": 0}
    back = store.read()
    assert back.count() == 400 and back.where("origin = 'old'").count() == stored
    assert back.where("origin = 'new'").join(incoming, ["event_id", "ts"], "left_anti").count() == 0  # earliest kept


def test_registered_tables(spark, events, folder):
    K.write_by_source(events, folder + "/t")
    names = T.register_tables(spark, {"events_enriched": folder + "/t"}, "sinktest_")
    assert spark.sql(f"SELECT count(*) FROM {names[0]} WHERE source = 'usgs'").first()[0] == 100
    assert T.register_tables(spark, {"events_enriched": folder + "/t"}, "sinktest_") == names  # kept, not replaced


def test_paging_and_recent(spark, events):
    first = [r.event_id for r in X.page(events, 0, 5).collect()]
    second = [r.event_id for r in X.page(events, 1, 5).collect()]
    last = events.where(F.col("event_id") == first[-1]).first()
    assert [r.event_id for r in X.page_after(events, last.ts, last.event_id, 5).collect()] == second
    live = events.withColumn("source", F.lit("bluesky_live"))
    as_of = F.lit(datetime(2023, 11, 14, 22, 20))
    assert [r.event_id for r in X.recent_live(live, as_of).where("ts <= '2023-11-14 22:20'").collect()] in ([], ["0"])
    assert X.map_points(events.withColumn("lat", F.lit(90.0))).count() == 0
    assert X.map_points(events.withColumn("lon", F.lit(-179.99))).count() == 400


def test_upsert_replaces_equal_keys_and_keeps_the_rest(spark, events, folder):
    path = folder + "/u"
    K.upsert_region_date(spark, events.where("event_id < '5'"), path)
    first = K.read_region_date(spark, path).count()
    K.upsert_region_date(spark, events.where("event_id >= '3'").withColumn("title", F.lit("new")), path)
    table = K.read_region_date(spark, path)
    assert first < 400 and table.count() == 400
    assert table.where("title = 'new'").count() == events.where("event_id >= '3'").count()
    K.upsert_region_date(spark, events.where("event_id >= '3'").withColumn("title", F.lit("new")), path)
    assert K.read_region_date(spark, path).count() == 400


def test_failed_overwrite_leaves_the_old_table(spark, events, folder):
    K.write_parquet(events, folder + "/t")
    broken = events.withColumn("lat", F.when(F.col("event_id") == "7", F.raise_error(F.lit("broken"))).otherwise(F.col("lat")))
    with pytest.raises(Exception, match="broken"):
        K.write_parquet(broken, folder + "/t")
    assert spark.read.parquet(folder + "/t").count() == 400
    assert [p for p in glob.glob(folder + "/*")] == [folder + "/t"]
    K.write_parquet(events.where("event_id = '7'"), folder + "/t")
    assert spark.read.parquet(folder + "/t").count() == 1


def test_poll_statistics_count_unusable_rows(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None), (None, "x"), ("c", "x")], "event_id string, text string")
    store = spark.createDataFrame([("c",)], "event_id string")
    got = K.poll_statistics(rows, store, readable=F.col("text").isNotNull()).first()
    assert (got.fetched, got.inserted, got.errors) == (5, 1, 2)
