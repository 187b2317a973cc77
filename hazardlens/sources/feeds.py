"""Loaders: one raw feed in, canonical rows out.

Feed documents may span lines (``multi_line=True``, the published form) or be landed one document per
line (``multi_line=False``), which Spark can split across tasks and which is the form to use at volume.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlens import schema as S
from hazardlens.functions.text import last_segment
from hazardlens.operators.normalize import drop_duplicate_events, first_per_key, to_canonical, union_all, usable_rows

#: Different headers in one folder.
MAX_SHAPES = 1000
GDELT_FIELDS = {"id": 0, "day": 1, "actors": (26, 5, 15), "country": 53, "lat": 56, "lon": 57, "url": 60}


def _json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool, encoding: str | None) -> DataFrame:
    """Without an ``encoding`` each document's own is found out, which reads it byte by byte: several times slower."""
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    return (reader.option("encoding", encoding) if encoding else reader).json(path)


def _items(df: DataFrame, column: str) -> DataFrame:
    """One row per array item. A document without the array gives no rows."""
    return df.select(F.explode(column).alias("r"))


def _at(array: str, i: int) -> Column:
    return F.get(F.col(array), F.lit(i))


def _time(column: Column, fmt: str | None = None) -> Column:
    return F.try_to_timestamp(column, F.lit(fmt)) if fmt else F.try_to_timestamp(column)


def load_usgs(spark: SparkSession, path: str, multi_line: bool = True, encoding: str | None = None) -> DataFrame:
    rows = _items(_json(spark, path, S.USGS_RAW, multi_line, encoding), "features")
    return to_canonical(
        rows, "usgs", raw=F.col("r"),
        event_id=F.col("r.id"), title=F.col("r.properties.title"), text=F.col("r.properties.place"),
        lat=_at("r.geometry.coordinates", 1), lon=_at("r.geometry.coordinates", 0),
        ts=F.timestamp_millis("r.properties.time"))


def load_eonet(spark: SparkSession, path: str, multi_line: bool = True, encoding: str | None = None) -> DataFrame:
    """One row per event: its earliest geometry. A polygon is located at its first vertex."""
    rows = _items(_json(spark, path, S.EONET_RAW, multi_line, encoding), "events")
    points = rows.select("r", F.explode("r.geometry").alias("g"))

    def coordinate(i: int) -> Column:
        found = F.coalesce(F.get_json_object("g.coordinates", f"$[0][0][{i}]"),
                           F.get_json_object("g.coordinates", f"$[{i}]"))
        return found.try_cast("double")

    return drop_duplicate_events(to_canonical(
        points, "eonet", raw=F.col("r"),
        event_id=F.col("r.id"), title=F.col("r.title"), text=F.col("r.description"),
        lat=coordinate(1), lon=coordinate(0), ts=_time(F.col("g.date"))))


def load_reliefweb(spark: SparkSession, path: str, multi_line: bool = True, encoding: str | None = None) -> DataFrame:
    rows = _items(_json(spark, path, S.RELIEFWEB_RAW, multi_line, encoding), "data")
    return to_canonical(
        rows, "reliefweb", raw=F.col("r"),
        event_id=F.col("r.id"), title=F.col("r.fields.title"), text=F.col("r.fields.`body-html`"),
        ts=_time(F.col("r.fields.date.created")), country=F.col("r.fields.primary_country.iso3"))


def load_gdacs(spark: SparkSession, path: str, multi_line: bool = True, encoding: str | None = None) -> DataFrame:
    rows = _items(_json(spark, path, S.GDACS_RAW, multi_line, encoding), "features")
    return drop_duplicate_events(to_canonical(
        rows, "gdacs", raw=F.col("r"),
        event_id=F.col("r.properties.eventid"), title=F.col("r.properties.name"),
        text=F.col("r.properties.description"),
        lat=_at("r.geometry.coordinates", 1), lon=_at("r.geometry.coordinates", 0),
        ts=_time(F.col("r.properties.fromdate")), country=F.col("r.properties.iso3")))


def load_gdelt(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(S.GDELT_RAW).option("sep", "\t").csv(path)

    def at(name: str) -> Column:
        return F.col(f"c{GDELT_FIELDS[name]}")

    return to_canonical(
        rows, "gdelt",
        event_id=at("id"), title=F.concat_ws(" - ", *[F.col(f"c{i}") for i in GDELT_FIELDS["actors"]]),
        text=at("url"), lat=at("lat").try_cast("double"), lon=at("lon").try_cast("double"),
        ts=_time(at("day"), "yyyyMMdd"), country=at("country"))


@dataclass(frozen=True)
class Shape:
    separator: str
    header: str
    files: tuple[str, ...]


def file_shapes(spark: SparkSession, path: str) -> list[Shape]:
    """The different headers of the text files below ``path``, each with its separator and its files.

    One pass finds every file's first line; of a large file only its first split is looked at. Of tab and comma the one
    that cuts the header into more columns is the separator. Files without a line have no shape."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"))
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    shapes = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).limit(MAX_SHAPES + 1).collect()
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"{path}: more than {MAX_SHAPES} different headers")
    return [Shape(max("\t,", key=r.header.count), r.header, tuple(map(unquote, r.files))) for r in sorted(shapes, key=lambda r: r.header)]


def read_shape(spark: SparkSession, shape: Shape) -> DataFrame:
    return spark.read.options(sep=shape.separator, header=True).csv(list(shape.files))


def load_social(spark: SparkSession, path: str, as_of: Column | None = None) -> DataFrame:
    """Labelled posts in tab- or comma-separated files with a header, searched recursively. A folder may hold files of
    different separators, columns and column orders: each is read in its own shape.

    Posts carry no time: ``as_of`` (default: now) is used for all of them."""
    shapes = [read_shape(spark, shape) for shape in file_shapes(spark, path)]
    return union_all([_social_rows(rows, as_of) for rows in shapes or [spark.createDataFrame([], "text string")]])


def _social_rows(rows: DataFrame, as_of: Column | None) -> DataFrame:
    by_name = {c.lower(): c for c in rows.columns}

    def pick(*names: str) -> str | None:
        return next((by_name[n] for n in names if n in by_name), None)

    text = pick("tweet_text", "text") or rows.columns[-1]
    key = pick("tweet_id", "id") or text
    event = pick("event_name", "event")
    return to_canonical(
        rows, "social",
        event_id=F.col(f"`{key}`"), text=F.col(f"`{text}`"),
        title=F.coalesce(F.col(f"`{event}`"), F.lit("")) if event else F.lit(""),
        ts=as_of if as_of is not None else F.current_timestamp())


def normalise_posts(posts: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Live posts (batch or stream) as enriched-style rows; posts without URI or text are dropped.

    An unreadable time becomes ``as_of`` (default: now). Author and URI are kept for links.
    """
    now = as_of if as_of is not None else F.current_timestamp()
    text = F.col("record.text")
    return posts.where((F.col("uri") != "") & (text != "")).select(
        F.concat(F.lit("bsky_"), last_segment(F.col("uri"))).alias("event_id"),
        F.lit(S.LIVE_SOURCE).alias("source"),
        F.substring(text, 1, 140).alias("title"), text.alias("text"),
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"),
        F.coalesce(_time(F.col("record.createdAt")), now).alias("ts"),
        F.lit(None).cast("string").alias("country"),
        F.lit("live").alias("event_type"), F.lit(0.4).cast("float").alias("severity"),
        F.lit(None).cast("int").alias("cluster_id"),
        F.coalesce("author.handle", F.lit("unknown")).alias("author"), "uri",
    )


def first_post_per_uri(posts: DataFrame) -> DataFrame:
    """Earliest post per URI (a poll over several search words returns the same post again)."""
    return first_per_key(posts, ["uri"], [F.col("record.createdAt"), F.col("record.text")])


LOADERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "usgs": load_usgs, "eonet": load_eonet, "reliefweb": load_reliefweb,
    "gdacs": load_gdacs, "gdelt": load_gdelt, "social": load_social,
}


class NoSourceError(RuntimeError):
    pass


@dataclass
class FeedReport:
    loaded: list[str] = field(default_factory=list)
    empty: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)


def load_feeds(feeds: dict[str, Callable[[], DataFrame]]) -> tuple[DataFrame, FeedReport]:
    """Union of the usable rows of every feed that loads and has rows.

    A failing feed (missing folder, unreadable files) is reported and skipped. With none left the job
    stops with :class:`NoSourceError`.
    """
    report, frames = FeedReport(), []
    for name, load in feeds.items():
        try:
            rows = usable_rows(load())
            if rows.isEmpty():
                report.empty.append(name)
            else:
                frames.append(rows)
                report.loaded.append(name)
        except PySparkException as error:
            report.failed[name] = type(error).__name__
    if not frames:
        raise NoSourceError(f"no feed has usable rows: {report}")
    return union_all(frames), report
