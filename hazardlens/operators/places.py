"""Gazetteer build and place lookup."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.functions.text import capitalised_tokens
from hazardlens.operators.normalize import first_per_key

MIN_POPULATION = 100_000
INLINE_NAMES = 10_000
SPREAD_KEYS = 100_000


def build_cities(cities: DataFrame, min_population: int = MIN_POPULATION) -> DataFrame:
    """Large cities keyed by lower-case name; the most populous one wins a shared name."""
    large = cities.where(F.col("population") >= min_population).withColumn("key", F.lower("name"))
    order = [F.col("population").desc(), F.col("countrycode"), F.col("latitude"), F.col("longitude")]
    return first_per_key(large, ["key"], order).select("key", "latitude", "longitude", "countrycode")


def build_countries(countries: DataFrame) -> DataFrame:
    keyed = countries.where(F.col("code") != "").withColumn("key", F.lower("name"))
    return first_per_key(keyed, ["key"], [F.col("code")]).select("key", "code")


@dataclass(frozen=True)
class Gazetteer:
    """Country and city tables as the builders make them. The name lists are set only for a small
    gazetteer, whose tables are then local relations."""

    countries: DataFrame
    cities: DataFrame
    country_names: list[str] | None = None
    city_names: list[str] | None = None

    @property
    def inline(self) -> bool:
        return self.country_names is not None


_COUNTRY_TYPE = pa.schema([("key", pa.string()), ("code", pa.string())])
_CITY_TYPE = pa.schema([("key", pa.string()), ("latitude", pa.float64()), ("longitude", pa.float64()),
                        ("countrycode", pa.string())])


def fetch_small(countries: DataFrame, cities: DataFrame, limit: int = INLINE_NAMES) -> tuple[pa.Table, pa.Table] | None:
    """Both tables as Arrow data if neither has more than ``limit`` rows, else None (one job, never more
    than ``limit`` + 1 rows of each)."""
    def part(df: DataFrame, kind: str, columns: list[str]) -> DataFrame:
        return df.limit(limit + 1).select(F.lit(kind).alias("kind"), *[F.col(c) for c in columns])

    rows = part(countries, "country", _COUNTRY_TYPE.names).unionByName(
        part(cities, "city", _CITY_TYPE.names), allowMissingColumns=True).collect()
    by_kind = {kind: [r.asDict() for r in rows if r.kind == kind] for kind in ("country", "city")}
    if any(len(found) > limit for found in by_kind.values()):
        return None
    return (pa.Table.from_pylist(by_kind["country"], _COUNTRY_TYPE), pa.Table.from_pylist(by_kind["city"], _CITY_TYPE))


def local_gazetteer(spark: SparkSession, small: tuple[pa.Table, pa.Table]) -> Gazetteer:
    nations, towns = small
    return Gazetteer(spark.createDataFrame(nations), spark.createDataFrame(towns),
                     nations["key"].to_pylist(), towns["key"].to_pylist())


def load_gazetteer(countries: DataFrame, cities: DataFrame, inline_limit: int = INLINE_NAMES) -> Gazetteer:
    """Read a small gazetteer once for all lookups; a larger one stays a pair of distributed tables."""
    small = fetch_small(countries, cities, inline_limit)
    return local_gazetteer(countries.sparkSession, small) if small else Gazetteer(countries, cities)


def _first_known(tokens: Column, names: list[str]) -> Column:
    if not names:
        return F.lit(None).cast("string")
    return F.get(F.filter(tokens, lambda t: t.isin(names)), F.lit(0))


def resolve_places(df: DataFrame, gazetteer: Gazetteer, text: Column, needed: Column | None = None) -> DataFrame:
    """Add ``geo_lat``, ``geo_lon``, ``geo_country``.

    The first capitalised token that names a country decides; only without one does the first city
    count. A small gazetteer (size checked when loaded) is tested inside the row by a hash set and then
    joined by broadcast: the events are not shuffled. A larger one is joined on exploded tokens.
    """
    wanted = F.when(needed, text) if needed is not None else text
    if not gazetteer.inline:
        return _resolve_by_join(df, gazetteer, wanted)
    keep = df.columns
    keyed = (df.withColumn("__tokens", F.transform(capitalised_tokens(wanted), F.lower))
             .withColumns({"__nation": _first_known(F.col("__tokens"), gazetteer.country_names),
                           "__town": _first_known(F.col("__tokens"), gazetteer.city_names)}))
    nations = gazetteer.countries.select(F.col("key").alias("__nation"), F.col("code").alias("__code"))
    towns = gazetteer.cities.select(F.col("key").alias("__town"), "latitude", "longitude", "countrycode")
    located = (keyed.join(F.broadcast(nations), "__nation", "left")
               .join(F.broadcast(towns), "__town", "left"))
    by_town = F.col("__code").isNull()
    return located.select(
        *keep,
        F.when(by_town, F.col("latitude")).alias("geo_lat"),
        F.when(by_town, F.col("longitude")).alias("geo_lon"),
        F.coalesce(F.col("__code"), F.col("countrycode")).alias("geo_country"),
    )


def place_of_text(texts: DataFrame, countries: DataFrame, cities: DataFrame) -> DataFrame:
    """Table form: each distinct ``place_text`` that names a known place, with the place found."""
    keyed = texts.where(F.col("place_text") != "").withColumn("__key", F.sha2("place_text", 256))
    names = keyed.select("__key", "place_text").dropDuplicates(["__key"])
    return _places_by_key(keyed, F.col("place_text"), countries, cities).join(names, "__key").drop("__key").select(
        "place_text", "geo_lat", "geo_lon", "geo_country")


def _places_by_key(keyed: DataFrame, text: Column, countries: DataFrame, cities: DataFrame) -> DataFrame:
    """The place of each ``__key`` (a digest of ``text``) that names a known one.

    Only tokens travel, never texts. A repeated text's tokens fall together map-side; the first country hit and the
    first city hit are picked by aggregation, whatever the gazetteer's size.
    """
    tokens = keyed.select("__key", F.posexplode(capitalised_tokens(text)).alias("pos", "tok")).groupBy(
        "__key", F.lower("tok").alias("key")).agg(F.min("pos").alias("pos"))
    hits = (tokens.join(countries, "key", "left").join(cities, "key", "left")
            .where(F.col("code").isNotNull() | F.col("countrycode").isNotNull()))
    town = F.struct("pos", "latitude", "longitude", "countrycode")
    picked = hits.groupBy("__key").agg(
        F.min(F.when(F.col("code").isNotNull(), F.struct("pos", "code"))).alias("nation"),
        F.min(F.when(F.col("countrycode").isNotNull(), town)).alias("town"),
    )
    by_town = F.col("nation").isNull()
    return picked.select(
        "__key",
        F.when(by_town, F.col("town.latitude")).alias("geo_lat"),
        F.when(by_town, F.col("town.longitude")).alias("geo_lon"),
        F.coalesce(F.col("nation.code"), F.col("town.countrycode")).alias("geo_country"),
    )


def _resolve_by_join(df: DataFrame, gazetteer: Gazetteer, text: Column) -> DataFrame:
    keep = df.columns
    keyed = df.withColumn("__key", F.when(text != "", F.sha2(text, 256)))
    places = _places_by_key(keyed.where(F.col("__key").isNotNull()), text, gazetteer.countries, gazetteer.cities)
    # Rows that need no place get keys of their own, spread out, so that they do not meet in one task.
    spread = F.concat(F.lit("-"), F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in keep]), F.lit(SPREAD_KEYS)))
    return (keyed.withColumn("__key", F.coalesce("__key", spread)).join(places, "__key", "left")
            .select(*keep, "geo_lat", "geo_lon", "geo_country"))
