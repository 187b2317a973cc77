"""Snapshot tables: versions, failures between files, overlapping writers, key index, merging, clean-up."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from hazardlens.sinks import keyindex, snapshots
from hazardlens.sinks.snapshots import Change, SnapshotTable


def rows(spark, start, stop, value="old", parts=4):
    return spark.range(start, stop).select(
        F.col("id").cast("string").alias("event_id"), F.concat(F.lit("p+ %:"), F.col("id") % parts).alias("part"), F.lit(value).alias("value"))


def content(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def table(spark, folder):
    return SnapshotTable(spark, folder + "/t", ("part",))


def test_versions_and_partition_values(spark, table):
    assert table.read().count() == 0
    table.append(rows(spark, 0, 40))
    table.append(rows(spark, 40, 50, parts=1).withColumn("part", F.when(F.col("event_id") > "44", "1")))
    assert content(table.read(1)) == content(rows(spark, 0, 40))
    assert table.read().count() == 50 and table.read().where("part IS NULL").count() == 5 and table.read().where("part = '1'").count() == 5
    table.overwrite(rows(spark, 0, 3).select("event_id", "part"))
    assert table.read().columns == ["event_id", "part"] and table.read(2).count() == 50
    with pytest.raises(ValueError, match="does not fit"):
        table.append(rows(spark, 0, 3))
    assert table.versions() == [1, 2, 3]


def test_stop_between_folders_leaves_the_old_version(spark, table, monkeypatch):
    table.append(rows(spark, 0, 40))
    before = content(table.read())
    broken = rows(spark, 0, 40, "new").withColumn("value", F.when(F.col("event_id") == "39", F.raise_error(F.lit("broken"))).otherwise("new"))
    with pytest.raises(Exception, match="broken"):
        table.overwrite(broken)
    # All files are written, the version is not.
    monkeypatch.setattr(table, "_put", lambda snapshot: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        table.upsert(rows(spark, 0, 40, "new"), ["event_id", "part"])
    monkeypatch.undo()
    assert content(table.read()) == before and table.versions() == [1]
    table.upsert(rows(spark, 0, 40, "new"), ["event_id", "part"])
    assert content(table.read()) == content(rows(spark, 0, 40, "new"))
    assert table.vacuum(keep_versions=1) >= 2 and content(table.read()) == content(rows(spark, 0, 40, "new"))
    assert len(glob.glob(f"{table.path}/data/*")) == 1


def test_two_writers_of_the_same_folders(spark, table):
    table.append(rows(spark, 0, 40))
    key = ["event_id", "part"]
    late = table.upserting(rows(spark, 0, 20, "late"), key)
    other = table.upserting(rows(spark, 10, 30, "early"), key)
    other.commit()
    assert late.commit().version == 3 and late.attempts == 2 and other.attempts == 1
    want = content(rows(spark, 0, 20, "late").union(rows(spark, 20, 30, "early")).union(rows(spark, 30, 40)))
    assert content(table.read()) == want
    assert len(glob.glob(f"{table.path}/data/*")) == 3      # what the first attempt wrote is gone


def test_two_writers_of_different_folders_do_not_meet(spark, table):
    table.append(rows(spark, 0, 40))
    late = table.upserting(rows(spark, 0, 1, "late"), ["event_id", "part"])
    table.upsert(rows(spark, 1, 2, "early"), ["event_id", "part"])
    late.commit()
    assert late.attempts == 1 and table.read().where("value <> 'old'").count() == 2 and table.read().count() == 40


def test_a_taken_number_is_not_taken_twice(spark, table):
    table.append(rows(spark, 0, 4))
    held = table.snapshot()
    assert not table._put(held) and table.versions() == [1]
    with pytest.raises(snapshots.Conflict):
        table.commit(held, Change("x", [], held.schema, removed=frozenset({"no such file"})))


def test_conflict_that_lasts_is_raised(spark, table, monkeypatch):
    table.append(rows(spark, 0, 4))
    monkeypatch.setattr(snapshots, "ATTEMPTS", 2)
    attempts = []

    def make(base):
        attempts.append(base.version)
        SnapshotTable(spark, table.path, ("part",)).append(rows(spark, 4, 5))
        return Change("insert", [], base.schema, read=None)

    with pytest.raises(snapshots.Conflict):
        table.begin(make).commit()
    assert len(attempts) == 2


@pytest.fixture()
def store(spark, folder):
    """A hundred files, each with keys that lie between those of the others."""
    held = SnapshotTable(spark, folder + "/s", index_key="event_id")
    spread = spark.range(5000).select(F.format_string("k%06d", F.col("id") * 2).alias("event_id"), F.lit("old").alias("value"),
                                      (F.col("id") % 100).cast("int").alias("file"))
    held.append(spread.repartitionById(100, "file").drop("file"))
    assert len(held.snapshot().files) == 100
    return held


def test_insert_opens_only_files_that_can_hold_a_key(spark, store):
    batch = spark.createDataFrame([("k000200", "new"), ("k000201", "new"), ("k000201", "newer"), (None, "new"), ("z", "new")],
                                  "event_id string, value string")
    store.insert_new(batch)
    assert 1 <= store.files_opened <= 8
    assert store.read().count() == 5002 and store.read().where("value <> 'old'").count() == 2
    store.insert_new(batch)
    assert 1 <= store.files_opened <= 10 and store.read().count() == 5002
    outside = spark.createDataFrame([("a", "new")], "event_id string, value string")
    store.insert_new(outside)
    assert store.files_opened == 0 and store.read().count() == 5003


def test_large_batches_read_all_keys(spark, store, monkeypatch):
    monkeypatch.setattr(keyindex.possible_files, "__defaults__", (100,))
    store.insert_new(spark.range(5000).select(F.format_string("k%06d", F.col("id")).alias("event_id"), F.lit("new").alias("value")))
    assert store.files_opened == 100
    assert store.read().count() == 5000 + 2500 and store.read().where("value = 'new'").count() == 2500


def test_inserts_of_two_writers(spark, store):
    batch = spark.createDataFrame([("n1", "a"), ("n2", "a")], "event_id string, value string")
    late = store.inserting(batch)
    store.insert_new(batch.withColumn("value", F.lit("b")).limit(1))
    late.commit()
    assert late.attempts == 2 and late.change.rows == 1 and store.read().where("event_id LIKE 'n%'").count() == 2


def test_filters_hold_all_their_keys(spark, store):
    index = spark.read.schema(keyindex.SCHEMA).parquet(*glob.glob(f"{store.path}/_index/*"))
    assert index.count() == 100 and index.agg(F.sum("rows")).first()[0] == 5000
    keys = spark.range(0, 10000, 1).select(F.format_string("k%06d", F.col("id")).alias("event_id"))
    folders = glob.glob(f"{store.path}/_index/*")
    assert keyindex.possible_files(spark, folders, keys, "event_id") == {f["file"] for f in store.snapshot().files}
    assert keyindex.possible_files(spark, folders, keys.where("event_id = 'none'"), "event_id") == set()


def test_merging_by_size(spark, table):
    for k in range(5):
        table.append(rows(spark, k * 40, k * 40 + 40).repartition(2, "event_id"))
    before, old = content(table.read()), table.snapshot()
    assert table.compact().operation == "compact"
    merged = table.snapshot()
    assert content(table.read()) == before and len(merged.files) == 4 and len(old.files) >= 20
    assert {f["folder"] for f in merged.files} == {f["folder"] for f in old.files} and content(table.read(old.version)) == before
    assert table.compact().version == merged.version        # nothing to do


def test_target_size_and_concurrent_changes(spark, table, monkeypatch):
    for k in range(8):
        table.append(rows(spark, k * 500, k * 500 + 500, parts=1))
    table.compact(target_bytes=max(1, sum(f["bytes"] for f in table.snapshot().files) // 2), tier_files=2)
    assert 2 <= len(table.snapshot().files) <= 3 and table.read().count() == 4000
    for k in range(4):
        table.append(rows(spark, 4000 + k, 4001 + k, parts=1))
    write = table._write

    def overtaken(df, parts=None):
        SnapshotTable(spark, table.path, ("part",)).overwrite(rows(spark, 0, 7))
        return write(df, parts)

    monkeypatch.setattr(table, "_write", overtaken)
    table.compact()
    assert table.read().count() == 7        # the overwrite stands


def test_key_ranges_are_found_without_a_sort_of_the_rows(spark, folder):
    keys = [None, "b", "", "\u00e9", "\U0001f600", "\uffee", "a"]
    data = spark.createDataFrame([(k, i % 2) for i, k in enumerate(keys)] + [(None, 2)] * 3, "event_id string, part int")
    data.repartition(1).write.partitionBy("part").parquet(folder + "/t/data/c")
    index = keyindex.index_of(spark.read.parquet(folder + "/t/data/c"), "event_id")
    assert "SortAggregate" not in index._jdf.queryExecution().executedPlan().toString()
    found = {r.file.split("/")[1]: r for r in index.collect()}
    assert {k: (r.rows, r.low, r.high, r["filter"] is None) for k, r in found.items()} == {
        "part=0": (4, "", "\U0001f600", False), "part=1": (3, "b", "\uffee", False), "part=2": (3, None, None, True)}
