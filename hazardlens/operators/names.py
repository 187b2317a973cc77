"""Place names of one or more words, found in running text: longest name first, left to right, without overlap.

The gazetteer is a token trie kept as two tables: roots (first word, how many words the names beginning with it have) and
leaves (whole name). Words of a text meet the roots first, so little is left of most texts; where a name can begin, one
candidate of each possible length goes on to the leaves. Both tables are broadcast when the gazetteer is small (its size is
checked) and joined on the first word and on the whole name otherwise, so a gazetteer of any size is spread. What travels
is a window of words no longer than the longest name, never the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.operators.normalize import first_per_key
from hazardlens.session import checkpointed

#: Words of a text. A name begins at a word with a capital letter; the words after it may be small ("Rio de Janeiro").
WORD = r"[\p{L}\p{N}_][\p{L}\p{N}_'\-]*"
#: A gazetteer of at most so many names is broadcast.
BROADCAST_NAMES = 100_000


@dataclass(frozen=True)
class NameTrie:
    roots: DataFrame        #: first, lengths
    leaves: DataFrame       #: name, place
    longest: int            #: words of the longest name
    small: bool


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def spelled(name: Column) -> Column:
    """A name as it is looked up: its words in small letters, one blank apart."""
    return F.array_join(F.transform(words_of(name), F.lower), " ")


def build_trie(names: DataFrame, name: str, place: Column, order: list[Column], broadcast_names: int = BROADCAST_NAMES) -> NameTrie:
    """``place`` (a struct) is kept for each spelling of ``name``; of equal spellings the first in ``order`` wins. Null names
    and names without a word are left out."""
    spelling = names.withColumn("__spelled", spelled(F.col(name))).where(F.col("__spelled") != "")
    leaves = checkpointed(first_per_key(spelling, ["__spelled"], order).select(F.col("__spelled").alias("name"), place.alias("place")))
    words = F.split("name", " ")
    roots = leaves.select(words[0].alias("first"), F.size(words).alias("length")).groupBy("first").agg(
        F.sort_array(F.collect_set("length")).alias("lengths"))
    count, longest = leaves.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(words)), F.lit(1))).first()
    return NameTrie(roots, leaves, longest, count <= broadcast_names)


def find_names(df: DataFrame, trie: NameTrie, key: str, text: str = "text") -> DataFrame:
    """``key, pos, words, name, place`` for each name found in the texts of ``df``; ``pos`` counts words from 0.

    At each place the longest name counts, and the search goes on behind it. ``key`` tells the rows of ``df`` apart; rows with a
    null key or text have no names."""
    table = F.broadcast if trie.small else (lambda whole: whole)
    said = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), words_of(F.col(text)).alias("said"))
    # Windows are cut inside the row: words exploded beside their text would copy it once for each word.
    windows = F.transform("said", lambda word, pos: F.when(F.substring(word, 1, 1) != F.lower(F.substring(word, 1, 1)), F.struct(
        pos.alias("pos"), F.slice("said", pos + 1, trie.longest).alias("window"))))
    starts = said.select("key", F.explode(F.filter(windows, lambda start: start.isNotNull())).alias("start")).select(
        "key", "start.*", F.lower(F.col("start.window")[0]).alias("first"))
    candidates = starts.join(table(trie.roots), "first").withColumn("words", F.explode("lengths")).where(
        F.col("words") <= F.size("window")).select("key", "pos", "words", F.lower(F.array_join(F.slice("window", 1, F.col("words")), " ")).alias("name"))
    found = candidates.join(table(trie.leaves), "name").select("key", "pos", "words", "name", "place")
    return _apart(found).withColumnRenamed("key", key)


def _apart(found: DataFrame) -> DataFrame:
    """Of the names of each text the first and longest, then the next one behind it, and so on. The names of one text meet in
    one task, one after the other; none is held."""
    in_order = found.repartition("key").sortWithinPartitions("key", "pos", F.col("words").desc(), "name")
    return in_order.mapInArrow(_kept, found.schema)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by text and position, that begin behind the last one kept."""
    text, free = None, 0
    for batch in batches:
        kept = []
        for key, pos, words in zip(*(batch.column(c).to_pylist() for c in ("key", "pos", "words"))):
            if key != text:
                text, free = key, 0
            kept.append(pos >= free)
            if kept[-1]:
                free = pos + words
        yield batch.filter(pa.array(kept, pa.bool_()))


def place_names(countries: DataFrame, cities: DataFrame) -> DataFrame:
    """Both tables of :mod:`places` as one table of names: ``name, code, latitude, longitude, countrycode``."""
    nations = countries.select(F.col("key").alias("name"), "code")
    return nations.unionByName(cities.withColumnRenamed("key", "name"), allowMissingColumns=True)


def resolve_long_names(df: DataFrame, countries: DataFrame, cities: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, geo_lat, geo_lon, geo_country``: the first country named decides, only without one the first town. A name that
    is both a country's and a town's counts as the country."""
    place = F.struct("code", "latitude", "longitude", "countrycode")
    trie = build_trie(place_names(countries, cities), "name", place, [F.col("code").isNull(), F.col("code"), F.col("countrycode")])
    found = find_names(df, trie, key, text).select(key, "pos", "place.*")
    nation = F.min_by("code", F.when(F.col("code").isNotNull(), F.col("pos")))
    town = F.min_by(F.struct("latitude", "longitude", "countrycode"), F.when(F.col("code").isNull(), F.col("pos")))
    picked = found.groupBy(key).agg(nation.alias("nation"), town.alias("town"))
    by_town = F.col("nation").isNull()
    return picked.select(key, F.when(by_town, F.col("town.latitude")).alias("geo_lat"), F.when(by_town, F.col("town.longitude")).alias("geo_lon"),
                         F.coalesce("nation", "town.countrycode").alias("geo_country"))
