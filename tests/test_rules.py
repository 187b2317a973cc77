"""Severity, typing and place rules against expected values and plain-Python restatements."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from hazardlens.functions import severity as S
from hazardlens.functions.severity import with_severity
from hazardlens.functions.sqlfuncs import register_sql_functions
from hazardlens.functions.typing import rule_event_type
from hazardlens.operators import places as PL
from hazardlens.operators.enrich import enrich, normalise_country, type_events
from hazardlens.schema import CANONICAL, CITIES, COUNTRIES, ENRICHED

SEVERITY_CASES = {
    None: 0.0, "": 0.0, "calm": 0.0,
    "M5.8 earthquake reported near Manila": 0.36, "m 10 quake": 0.0, "M9.5": 1.0, "magnitude 7": 0.0,
    "9 dead": 0.3, "10 dead": 0.6, "100 killed": 0.85, "1000 missing": 1.0, "0 dead": 0.0, "3 casualties": 0.3,
    "999 displaced": 0.0, "1000 displaced": 0.5, "10000 evacuated": 0.7, "100000 homeless": 0.9,
    "red alert orange alert": 0.85, "orange  alert": 0.55, "Red Alert": 0.85, "scored alert": 0.0,
    "town destroyed, 5 killed": 0.65, "1 killed then 5000 killed": 0.3, "wiped out": 0.65,
    "x" * 20_000 + " 5000 dead": 1.0, "12345678 dead": 1.0,
}


def _texts(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")


def test_severity_cases(spark):
    rows = with_severity(_texts(spark, list(SEVERITY_CASES)), "text").orderBy("id").collect()
    got = {r.text: round(r.severity, 4) for r in rows}
    assert got == SEVERITY_CASES


def _expected_severity(text):
    found = [0.0]
    if m := re.search(r"(?i)\bm\s?(\d(\.\d)?)", text):
        found.append(min(1.0, (float(m[1]) - 4) / 5))
    if m := re.search(r"(?i)(\d{1,6})\s*(dead|deaths|killed|fatalities|casualty|casualties|missing)", text):
        found.append(next((s for n, s in ((1000, 1.0), (100, 0.85), (10, 0.6), (1, 0.3)) if int(m[1]) >= n), 0.0))
    if m := re.search(r"(?i)(\d{1,7})\s*(displaced|evacuated|homeless|affected)", text):
        found.append(next((s for n, s in ((100000, 0.9), (10000, 0.7), (1000, 0.5)) if int(m[1]) >= n), 0.0))
    if re.search(r"(?i)\bred\s+alert\b", text):
        found.append(0.85)
    elif re.search(r"(?i)\borange\s+alert\b", text):
        found.append(0.55)
    if re.search(r"(?i)\b(destroyed|devastated|collapsed|wiped out|catastrophic|massive damage)\b", text):
        found.append(0.65)
    return round(max(found), 3)


def test_severity_matches_plain_rule_on_random_text(spark):
    rng = random.Random(7)
    parts = ["M", "m", "5.8", "9", "12", "450", "12000", "200000", "dead", "killed", "missing", "displaced", "affected",
             "red", "orange", "alert", "destroyed", "wiped out", "a", "-", "é", ".", "\t", "casualty", "homeless"]
    texts = ["".join(rng.choice(["", " ", "  "]) + rng.choice(parts) for _ in range(rng.randint(1, 9)))
             for _ in range(3000)]
    rows = with_severity(_texts(spark, texts), "text").collect()
    wrong = [(r.text, r.severity) for r in rows if abs(r.severity - _expected_severity(r.text)) > 1e-6]
    assert not wrong


FOLDED = ["5 \u212aILLED", "7 mi\u017f\u017fing", "12 casualt\u0130es", "2000 d\u0131\u017fplaced", "20000 homele\u017fs", "de\u017ftroyed",
          "w\u0130ped out", "ma\u017f\u017fIve DAMAGE", "red\u2003ALERT", "M\u2003\u0665", "\u0661\u0662 dead", "m7", "5 Fatalit\u0131es", None, ""]


@pytest.mark.parametrize("ascii_words", [False, True])
def test_what_patterns_need_is_in_every_match(spark, ascii_words):
    texts = [t for text in [*FOLDED, *SEVERITY_CASES] for t in (text, text and f"\u0130\u03a3 {text.swapcase()}!")]
    scored = with_severity(_texts(spark, texts), "text", ascii_words=ascii_words)
    spelt = S._in_ascii if ascii_words else str
    numbers = [S._number("text", spelt(p), kind) for p, kind in ((S.MAGNITUDE, "DOUBLE"), (S.DEATHS, "INT"), (S.DISPLACED, "INT"))]
    plain = S._combine("text", *numbers, spelt=spelt)
    assert scored.withColumn("plain", F.expr(plain)).where("NOT severity <=> plain").collect() == []
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(") == 16 and plan.count("[mM]") == 1      # no pattern is tried on a text that cannot match


@pytest.mark.parametrize("source,title,expected", [
    ("usgs", None, "earthquake"), ("USGS", "x", "earthquake"), ("eonet", "Camp Fire", "wildfire"),
    ("eonet", "Tropical Storm and flood", "storm"), ("eonet", "Flood of 1", "flood"), ("eonet", "Iceberg A", "other"),
    ("eonet", None, "other"), ("gdacs", "EQ 5", "earthquake"), ("gdacs", "Flood in X", "flood"),
    ("gdacs", "Earthquake in X", "other"), ("gdacs", "tc-1", "storm"), ("gdelt", "fire", ""), (None, "fire", ""),
])
def test_rule_event_type(spark, source, title, expected):
    row = spark.createDataFrame([(source, title)], "source string, title string")
    assert row.select(rule_event_type(F.col("source"), F.col("title"))).first()[0] == expected


def test_full_word_option(spark):
    row = spark.createDataFrame([("gdacs", "Earthquake in X")], "source string, title string")
    assert row.select(rule_event_type(F.col("source"), F.col("title"), full_words=True)).first()[0] == "earthquake"


def _gazetteer(spark, **kw):
    cities = spark.createDataFrame([
        ("Manila", 14.6, 121.0, "PH", 1_780_148), ("Springfield", 1.0, 1.0, "AA", 150_000),
        ("Springfield", 2.0, 2.0, "BB", 900_000), ("Springfield", 3.0, 3.0, "CC", 120_000),
        ("Hamlet", 9.0, 9.0, "ZZ", 500)], CITIES)
    countries = spark.createDataFrame([("Philippines", "PH"), ("United States", "US"), ("Chad", "TD")], COUNTRIES)
    return countries, cities, PL.load_gazetteer(PL.build_countries(countries), PL.build_cities(cities), **kw)


PLACES = {
    "Flood in Manila Philippines": (None, None, "PH"), "flood in manila": (None, None, None),
    "Storm hits United States": (None, None, None), "Manila then Springfield": (14.6, 121.0, "PH"),
    "In Springfield": (2.0, 2.0, "BB"), "Hamlet": (None, None, None), "CHAD MANILA": (None, None, "TD"),
    "": (None, None, None), None: (None, None, None), "x" * 9_000 + " Manila": (14.6, 121.0, "PH"),
    "(Manila)": (14.6, 121.0, "PH"), "éManila": (None, None, None),
}


def _place(rows):
    return {r.text: (r.geo_lat, r.geo_lon, r.geo_country) for r in rows}


def test_places_inline_and_joined_forms_agree(spark):
    countries, cities, inline = _gazetteer(spark)
    texts = _texts(spark, list(PLACES))
    assert inline.inline
    assert _place(PL.resolve_places(texts, inline, F.col("text")).collect()) == PLACES
    joined = PL.load_gazetteer(PL.build_countries(countries), PL.build_cities(cities), inline_limit=1)
    assert not joined.inline
    assert _place(PL.resolve_places(texts, joined, F.col("text")).collect()) == PLACES
    texts.createOrReplaceTempView("place_texts")
    for names in (10, 1):       # as an expression, and as a lookup of any size
        register_sql_functions(spark, countries, cities, inline_names=names)
        rows = spark.sql("SELECT text, p.* FROM (SELECT text, geoparse_text(text) AS p FROM place_texts)").collect()
        assert _place(rows) == PLACES


def test_rows_without_a_place_do_not_meet_in_one_task(spark):
    countries, cities, _ = _gazetteer(spark)
    rows = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("In Manila "), F.col("id").cast("string")))
                                    .alias("text"))
    big = PL.Gazetteer(PL.build_countries(countries), PL.build_cities(cities))
    placed = PL.resolve_places(rows, big, F.col("text"))
    assert placed.where("geo_country = 'PH'").count() == 400
    keyed = placed.select("id").rdd.glom().map(len).collect()
    assert sum(keyed) == 4000
    keys = rows.select(F.pmod(F.xxhash64(F.col("id").cast("string"), F.col("text")), F.lit(PL.SPREAD_KEYS)).alias("k"))
    assert keys.distinct().count() > 3500


def test_small_gazetteer_keeps_events_unshuffled(spark, inputs):
    plan = PL.resolve_places(inputs.canonical, inputs.gazetteer, F.col("text"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text and "Python" not in text


def test_enrich_rows(spark):
    _, _, gazetteer = _gazetteer(spark)
    rows = [
        ("1", "usgs", "M6 x", "near Manila", None, None, None, None, None),
        ("2", "gdelt", "Chad 20 killed", None, 5.0, 6.0, None, None, None),
        ("3", None, "t", "t", None, None, None, None, None),
        ("4", "social", "", "calm", 1.0, 2.0, None, "XX", None),
    ]
    got = {r.event_id: r for r in enrich(spark.createDataFrame(rows, CANONICAL), gazetteer).collect()}
    assert sorted(got) == ["1", "2", "4"]  # a row without source belongs to neither branch
    assert (got["1"].event_type, got["1"].classify_conf, got["1"].severity) == ("earthquake", 1.0, 0.0)
    assert (got["1"].lat, got["1"].lon, got["1"].country) == (14.6, 121.0, "PH")
    assert (got["2"].event_type, got["2"].lat, got["2"].country) == ("other", 5.0, "TD")
    assert round(got["2"].severity, 3) == 0.6
    assert got["4"].country == "XX" and got["4"].geo_country is None
    frame = enrich(spark.createDataFrame(rows, CANONICAL), gazetteer, text_mode="concat")
    assert frame.schema.names == ENRICHED.names
    assert [f.dataType for f in frame.schema.fields] == [f.dataType for f in ENRICHED.fields]
    assert round(frame.where("event_id = '1'").first().severity, 3) == 0.4  # the title is no longer hidden


def test_country_codes_can_be_unified(spark):
    codes = spark.createDataFrame([("PHL", "PH"), ("RP", "PH")], "spelling string, code string")
    events = spark.createDataFrame([("1", "PHL"), ("2", "RP"), ("3", "JP"), ("4", None)], "event_id string, country string")
    got = {r.event_id: r.country for r in normalise_country(events, codes).collect()}
    assert got == {"1": "PH", "2": "PH", "3": "JP", "4": None}


def test_cue_scorer(spark):
    rows = [("a", "social", None, "flood flood quake"), ("b", "social", None, "nothing"), ("c", "usgs", None, "flood"),
            ("d", "gdelt", "lava and tsunami", None), ("e", "social", None, "firefighters")]
    df = spark.createDataFrame(rows, "event_id string, source string, title string, text string")
    got = {r.event_id: (r.event_type, round(r.classify_conf, 3)) for r in type_events(df, scorer="cues").collect()}
    assert got == {"a": ("flood", 0.667), "b": ("other", 0.0), "c": ("earthquake", 1.0), "d": ("volcano", 0.5),
                   "e": ("other", 0.0)}


def test_chosen_signals_and_ascii_words(spark):
    texts = ["password=e31f8f02dead059b5a", "5 killed", "red alert", "M5.8", "town destroyed", "éM5.8", "çdestroyed"]
    chosen = with_severity(_texts(spark, texts), "text", signals=("magnitude", "damage"), ascii_words=True).orderBy("id").collect()
    assert [round(r.severity, 4) for r in chosen] == [0.0, 0.0, 0.0, 0.36, 0.65, 0.36, 0.65]
    every = with_severity(_texts(spark, texts), "text").orderBy("id").collect()
    assert [round(r.severity, 4) for r in every] == [0.3, 0.3, 0.85, 0.36, 0.65, 0.0, 0.0]
