"""Streams: several files, restart, replay, repeats and late rows."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from hazardlens.schema import STREAM
from hazardlens.sinks.snapshots import SnapshotTable
from hazardlens.sinks.tables import event_store
from hazardlens.streaming import live as L
from hazardlens.streaming import windows as W


def _drop(folder, name, events, indent=2):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(e, indent=indent) for e in events))


def _event(key, text="10 dead", ts="2024-01-01T00:00:00Z"):
    return {"event_id": key, "source": "s", "title": "t", "text": text, "lat": 1.0, "lon": 2.0, "ts": ts, "country": "PH"}


def test_multi_line_files_restart_and_both_sinks(spark, folder):
    incoming = folder + "/in"
    for k in range(7):
        _drop(incoming, f"{k}.json", [_event(f"a{k}")])

    def run():
        stream = L.enrich_stream(L.read_events(spark, incoming, files_per_trigger=2))
        L.run_to_end(L.to_parquet(stream, folder + "/out", folder + "/c1", once=True),
                     L.to_batches(stream, L.batch_store(folder + "/batches"), folder + "/c2", once=True))
        return spark.read.parquet(folder + "/out"), spark.read.parquet(folder + "/batches")

    files, batches = run()
    assert files.count() == 7 and batches.count() == 7
    assert batches.select("batch_id").distinct().count() > 1  # at most two files per batch
    row = files.first()
    assert (row.event_type, row.classify_conf, round(row.severity, 3), row.cluster_id) == ("streaming", 0.0, 0.6, None)
    _drop(incoming, "later.json", [_event("b", "calm")])
    files, batches = run()
    assert files.count() == 8 and batches.count() == 8  # old files are not read again


def test_replayed_batches_change_nothing(spark, folder):
    rows = spark.createDataFrame([("1", datetime(2024, 1, 1)), ("2", datetime(2024, 1, 2))], "event_id string, ts timestamp")
    store = L.batch_store(folder + "/b")
    store(rows, 4)
    store(rows, 4)
    assert spark.read.parquet(folder + "/b").count() == 2
    event_store(spark, folder + "/s").append(rows.where("event_id = '1'"))
    once = L.insert_once(folder + "/s")
    once(rows, 0)
    once(rows, 0)
    assert event_store(spark, folder + "/s").read().count() == 2


def test_small_files_are_merged_and_replays_of_merged_batches_add_nothing(spark, folder):
    write, table = L.append_once(folder + "/t", "s"), SnapshotTable(spark, folder + "/t")
    for k in range(20):
        write(spark.range(k * 10, k * 10 + 10).select(F.col("id").cast("string").alias("event_id")).coalesce(1), k)
        assert len(table.snapshot().files) <= 2 * 3
    before = sorted(r.event_id for r in table.read().collect())
    assert before == sorted(map(str, range(200))) and any(table.snapshot(v).operation == "compact" for v in table.versions())
    for k in (0, 7, 19):
        write(spark.range(k * 10, k * 10 + 10).select(F.col("id").cast("string").alias("event_id")), k)
    assert sorted(r.event_id for r in table.read().collect()) == before


def test_a_batch_of_one_file_is_scored_on_all_cores(spark, folder):
    spark.range(400).select(F.col("id").cast("string").alias("event_id"), F.lit("M6.0 near").alias("title"), F.lit(None).cast("string").alias("text"),
                            F.timestamp_seconds("id").alias("ts")).coalesce(1).write.parquet(folder + "/in")
    batch, tasks = spark.read.parquet(folder + "/in"), []
    assert batch.rdd.getNumPartitions() == 1
    append = L.append_once(folder + "/t", "s")

    def write(scored, batch_id):
        tasks.append(scored.groupBy(F.spark_partition_id()).count().count())
        append(scored, batch_id)

    L.enriched(write, "event_id", "ts")(batch, 0)
    table = SnapshotTable(spark, folder + "/t")
    assert tasks == [spark.sparkContext.defaultParallelism] and len(table.snapshot().files) == 1
    assert table.read().where("severity > 0").count() == 400


def _counts(df):
    return sorted((r.window_start, r.event_type, r.n) for r in df.collect())


def test_corrected_counts_after_a_stop(spark, folder):
    rows = [("a", 3600 * 10), ("b", 3600 * 200), ("c", 3600 * 200 + 5), ("d", 60), ("e", 3600 * 400), ("f", 3600 * 10 + 1), ("g", 70)]
    schema = "event_id string, ts timestamp, event_type string"
    for part, names in enumerate(("abcd", "efg")):
        for event_id, at in rows:
            if event_id in names:
                spark.createDataFrame([(event_id, datetime.fromtimestamp(at, timezone.utc), "x")], schema).coalesce(1).write.mode(
                    "append").parquet(folder + "/in")
        stream = L.read_events(spark, folder + "/in", spark.read.parquet(folder + "/in").schema, "parquet", files_per_trigger=1)
        query = L.to_batches(W.corrected_window_counts(stream, keep_minutes=60), L.batch_store(folder + "/out"), folder + "/c",
                             once=True, mode="update")
        L.run_to_end(query)
    changes = spark.read.parquet(folder + "/out")
    want = spark.read.parquet(folder + "/in").groupBy(F.window("ts", "15 minutes").start.alias("window_start"), "event_type").agg(
        F.count(F.lit(1)).alias("n"))
    assert _counts(W.newest_counts(changes)) == _counts(want)
    assert changes.where("revision > 1").count() >= 1 and changes.where("part > 0").count() >= 1
    # All but the newest windows have given their counters back.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8


def test_empty_batches_are_skipped(spark, folder):
    _drop(folder + "/in", "a.json", [_event("1")])
    calls = []
    stream = L.read_events(spark, folder + "/in").where(F.col("event_id") == "none")
    L.run_to_end(L.to_batches(stream, lambda df, k: calls.append(k), folder + "/c", once=True))
    assert calls == []


def test_repeats_and_late_rows(spark, folder):
    start = datetime(2024, 1, 1)

    def at(minutes):
        return (start + timedelta(minutes=minutes)).isoformat() + "Z"

    incoming = folder + "/in"
    batches = [[_event("a", ts=at(0)), _event("a", ts=at(1))], [_event("b", ts=at(300)), _event("a", ts=at(2))],
               [_event("d", ts=at(301)), _event("b", ts=at(302))], [_event("c", ts=at(1))]]
    for k, rows in enumerate(batches):
        _drop(incoming, f"{k}.json", rows, indent=None)
        os.utime(os.path.join(incoming, f"{k}.json"), (1_700_000_000 + k, 1_700_000_000 + k))
    stream = L.read_events(spark, incoming, STREAM, multi_line=False, files_per_trigger=1)
    L.run_to_end(L.to_parquet(L.drop_repeats(stream, delay="1 hour"), folder + "/o", folder + "/c", once=True))
    got = sorted(r.event_id for r in spark.read.parquet(folder + "/o").collect())
    assert got == ["a", "b", "d"]  # "c" came after the watermark had passed its time
    counts = L.windowed_counts(L.read_events(spark, incoming, STREAM, multi_line=False, files_per_trigger=1), keys=("country",))
    L.run_to_end(L.to_parquet(counts, folder + "/w", folder + "/cw", once=True))
    closed = [(r.window_start, r.n) for r in spark.read.parquet(folder + "/w").collect()]
    assert (start, 3) in closed  # late "c" is not counted
    assert all(r[0] < start + timedelta(minutes=285) for r in closed)  # later windows are still open


def test_partial_counts_keep_late_rows_and_open_windows(spark, folder):
    rows = [("a", 3600 * 10), ("b", 3600 * 20), ("c", 3600 * 30), ("d", 60), ("e", 3600 * 30 + 5)]
    for event_id, at in rows:       # the fourth file is older than all before it
        spark.createDataFrame([(event_id, at, "x")], "event_id string, at long, event_type string").select(
            "event_id", F.timestamp_seconds("at").alias("ts"), "event_type").coalesce(1).write.mode("append").parquet(folder + "/in")
    schema = spark.read.parquet(folder + "/in").schema
    stream = L.read_events(spark, folder + "/in", schema, "parquet", files_per_trigger=1)
    L.run_to_end(L.to_batches(stream, L.partial_window_counts(folder + "/out"), folder + "/check", once=True))
    totals = L.window_totals(spark, folder + "/out")
    assert sorted(r.n for r in totals.collect()) == [1, 1, 1, 2]
