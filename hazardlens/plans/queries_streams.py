"""Streaming jobs run to the end of the available data; the result table is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.operators.places import resolve_places
from hazardlens.plans.inputs import Inputs
from hazardlens.plans.queries_feeds import PUBLISHED_ENCODING, _publish
from hazardlens.plans.registry import query
from hazardlens.schema import OFFICIAL_SOURCES, POSTS_RAW, STREAM
from hazardlens.session import scratch_path
from hazardlens.sinks.snapshots import SnapshotTable
from hazardlens.sinks.tables import event_store
from hazardlens.sources.feeds import normalise_posts
from hazardlens.streaming import live as L
from hazardlens.streaming import windows as W

_BATCH = ("SELECT event_id, source, title, text, lat, lon, ts, country, 'streaming' AS event_type, CAST(0.0 AS FLOAT) AS "
          "classify_conf, severity, CAST(NULL AS INTEGER) AS cluster_id FROM scored")


def _stream_session(i: Inputs) -> SparkSession:
    """Own settings for stateful queries: the number of state partitions is fixed at the first start, so
    it follows the cores of the cluster instead of a default."""
    session = i.spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", str(i.spark.sparkContext.defaultParallelism))
    # Keyed state with timers needs a store of this kind, whatever the session was built with.
    session.conf.set("spark.sql.streaming.stateStore.providerClass",
                     "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return session


def _landed(i: Inputs) -> str:
    """The canonical view as landed JSON files, one object per line."""
    path = scratch_path(i.spark, "incoming")
    i.canonical.select(*STREAM.names).write.json(path)
    return path


def _out_of_order(i: Inputs, df: DataFrame, files: int = 12) -> str:
    """Rows as a dozen files or more, each with rows of all times, so that late rows come in every micro-batch."""
    path = scratch_path(i.spark, "mixed")
    rows = df.count() // files + 1
    df.orderBy(F.xxhash64(df.columns[0])).write.option("maxRecordsPerFile", rows).parquet(path)
    return path


def _events_stream(session: SparkSession, i: Inputs) -> DataFrame:
    schema = i.table("events").schema
    raw = L.read_events(session, i.folder, schema, "parquet", pathGlobFilter="events.parquet")
    return Inputs(session, i.folder).events_as_canonical(raw)


def _read(i: Inputs, path: str) -> DataFrame:
    return i.spark.read.parquet(path)


@query("s10_json_file_stream", "SELECT source, count(*) AS n FROM typed GROUP BY source")
def _(i: Inputs) -> DataFrame:
    session, out, check = _stream_session(i), scratch_path(i.spark, "out"), scratch_path(i.spark, "check")
    stream = L.read_events(session, _landed(i), multi_line=False)
    L.run_to_end(L.to_parquet(stream, out, check, once=True))
    return _read(i, out).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("s10_multi_line_stream", "SELECT source, count(*) AS n FROM typed GROUP BY source")
def _(i: Inputs) -> DataFrame:
    # Files that hold a list of events each, over many lines.
    session, out, check = _stream_session(i), scratch_path(i.spark, "out"), scratch_path(i.spark, "check")
    landed = _publish(i.canonical, scratch_path(i.spark, "lists"), None, F.struct(*STREAM.names))
    stream = L.read_events(session, landed, multi_line=True, files_per_trigger=10_000, encoding=PUBLISHED_ENCODING)
    L.run_to_end(L.to_parquet(stream, out, check, once=True))
    return _read(i, out).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("p29_stream_enrichment", _BATCH)
def _(i: Inputs) -> DataFrame:
    return L.enrich_stream(i.canonical.select(*STREAM.names))


@query("r01_stream_to_parquet", _BATCH)
def _(i: Inputs) -> DataFrame:
    session, out, check = _stream_session(i), scratch_path(i.spark, "out"), scratch_path(i.spark, "check")
    stream = L.enrich_stream(_events_stream(session, i).select(*STREAM.names))
    L.run_to_end(L.to_parquet(stream, out, check, once=True))
    return _read(i, out)


@query("r01_stream_with_places", "SELECT event_id, geo_lat, geo_lon, geo_country, severity FROM placed")
def _(i: Inputs) -> DataFrame:
    # Stream-static lookup: the gazetteer is small (checked) and broadcast to every micro-batch.
    session, out, check = _stream_session(i), scratch_path(i.spark, "out"), scratch_path(i.spark, "check")
    stream = L.enrich_stream(_events_stream(session, i).select(*STREAM.names))
    missing = F.col("country").isNull() | F.col("lat").isNull() | F.col("lon").isNull()
    placed = resolve_places(stream, Inputs(session, i.folder).gazetteer, F.coalesce("text", "title"), missing)
    chosen = placed.select("event_id", "geo_lat", "geo_lon", "geo_country", "severity")
    L.run_to_end(L.to_parquet(chosen, out, check, once=True))
    return _read(i, out)


@query("k10_stream_append_restart", "SELECT event_id, severity FROM scored")
def _(i: Inputs) -> DataFrame:
    # Two runs on one checkpoint: the second finds nothing new and writes nothing twice.
    session, out, check = _stream_session(i), scratch_path(i.spark, "out"), scratch_path(i.spark, "check")
    source = _landed(i)
    for _run in range(2):
        stream = L.enrich_stream(L.read_events(session, source, multi_line=False))
        L.run_to_end(L.to_parquet(stream, out, check, once=True))
    return _read(i, out).select("event_id", "severity")


@query("k11_stream_batches", "SELECT event_id, severity FROM scored")
def _(i: Inputs) -> DataFrame:
    session, out, check = _stream_session(i), scratch_path(i.spark, "out"), scratch_path(i.spark, "check")
    stream = L.enrich_stream(L.read_events(session, _landed(i), multi_line=False))
    L.run_to_end(L.to_batches(stream, L.batch_store(out), check, once=True))
    return _read(i, out).select("event_id", "severity")


@query("k10_compacted_stream", "SELECT event_id, severity FROM scored")
def _(i: Inputs) -> DataFrame:
    # One small file in a micro-batch, merged by size as they come; the second run finds nothing new.
    session, out, check = _stream_session(i), scratch_path(i.spark, "out"), scratch_path(i.spark, "check")
    # Files as large as their rows make them, not one for each core.
    session.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    landed = _out_of_order(i, i.canonical.select("event_id", *[c for c in STREAM.names if c != "event_id"]))
    for _run in range(2):
        stream = L.read_events(session, landed, STREAM, "parquet", files_per_trigger=1)
        L.run_to_end(L.to_batches(stream, L.enriched(L.append_once(out, "events"), "event_id", "ts"), check, once=True))
    return SnapshotTable(i.spark, out).read().select("event_id", "severity")


@query("r02_two_sinks", "SELECT s.sink, t.event_id, t.severity FROM scored t, (VALUES ('files'), ('batches')) s(sink)")
def _(i: Inputs) -> DataFrame:
    session = _stream_session(i)
    files, batches = scratch_path(i.spark, "files"), scratch_path(i.spark, "batches")
    stream = L.enrich_stream(L.read_events(session, _landed(i), multi_line=False))
    L.run_to_end(
        L.to_parquet(stream, files, scratch_path(i.spark, "check"), once=True),
        L.to_batches(stream, L.batch_store(batches), scratch_path(i.spark, "check"), once=True))
    columns = ["event_id", "severity"]
    return _read(i, files).select(F.lit("files").alias("sink"), *columns).unionByName(
        _read(i, batches).select(F.lit("batches").alias("sink"), *columns))


@query("r03_wait_for_end", "SELECT count(*) AS n FROM typed")
def _(i: Inputs) -> DataFrame:
    session, out, check = _stream_session(i), scratch_path(i.spark, "out"), scratch_path(i.spark, "check")
    running = L.to_parquet(_events_stream(session, i).select("event_id"), out, check, once=True)
    L.wait_for_any(session, 600)
    L.run_to_end(running)
    return _read(i, out).agg(F.count(F.lit(1)).alias("n"))


@query("r04_stream_insert_once", "SELECT event_id, CASE WHEN source IN ('usgs', 'eonet', 'gdacs', 'reliefweb') THEN "
                                 "'stored' ELSE 'new' END AS origin FROM typed")
def _(i: Inputs) -> DataFrame:
    session, store, check = _stream_session(i), scratch_path(i.spark, "store"), scratch_path(i.spark, "check")
    known = i.canonical.where(F.col("source").isin(OFFICIAL_SOURCES))
    event_store(i.spark, store).append(known.select("event_id", "ts", F.lit("stored").alias("origin")))
    # Every event twice, in different files and micro-batches.
    new = i.canonical.select("event_id", "ts", F.lit("new").alias("origin"))
    landed = _out_of_order(i, new.unionByName(new).select("ts", "event_id", "origin"))
    stream = L.read_events(session, landed, i.spark.read.parquet(landed).schema, "parquet", files_per_trigger=3)
    L.run_to_end(L.to_batches(stream, L.insert_once(store), check, once=True))
    return event_store(i.spark, store).read().select("event_id", "origin")


@query("r04_live_posts_once", "SELECT 'bsky_' || split_part(uri, '/', -1) AS event_id, handle AS author FROM posts")
def _(i: Inputs) -> DataFrame:
    session, landed = _stream_session(i), scratch_path(i.spark, "posts")
    out, check = scratch_path(i.spark, "out"), scratch_path(i.spark, "check")
    i.posts.unionByName(i.posts).write.json(landed)
    posts = normalise_posts(L.read_events(session, landed, POSTS_RAW, multi_line=False, files_per_trigger=1))
    L.run_to_end(L.to_batches(posts, L.insert_once(out), check, once=True))
    return event_store(i.spark, out).read().select("event_id", "author")


@query("r05_windowed_counts", """SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
    time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end, event_type, count(*) AS n FROM typed
    GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    session, out, check = _stream_session(i), scratch_path(i.spark, "out"), scratch_path(i.spark, "check")
    landed = _out_of_order(i, i.typed.select("event_id", "ts", "event_type"))
    stream = L.read_events(session, landed, i.spark.read.parquet(landed).schema, "parquet", files_per_trigger=3)
    L.run_to_end(L.to_batches(stream, L.partial_window_counts(out), check, once=True))
    return L.window_totals(i.spark, out)


@query("r05_corrected_counts", """SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
    time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end, event_type, count(*) AS n FROM typed
    WHERE ts IS NOT NULL GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    # Late rows in every micro-batch, and a stop in between: the second half lands while the stream is down.
    session, out, check = _stream_session(i), scratch_path(i.spark, "out"), scratch_path(i.spark, "check")
    rows, landed = i.typed.select("event_id", "ts", "event_type"), scratch_path(i.spark, "landed")
    for half in range(2):
        rows.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half).repartition(3, "event_id").write.mode("append").parquet(landed)
        stream = L.read_events(session, landed, rows.schema, "parquet", files_per_trigger=3)
        L.run_to_end(L.to_batches(W.corrected_window_counts(stream), L.batch_store(out), check, once=True, mode="update"))
    return W.newest_counts(_read(i, out))
