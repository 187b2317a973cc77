"""Loaders on hand-written raw files, good and bad."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hazardlens.operators.normalize import usable_rows
from hazardlens.schema import CANONICAL, POSTS_RAW
from hazardlens.sources import feeds as S
from hazardlens.sources import tables as T


def _put(folder, name, content):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(content if isinstance(content, str) else json.dumps(content, indent=1))
    return folder


def _rows(df):
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in CANONICAL.fields]
    return sorted(df.collect(), key=lambda r: (r.event_id or "", str(r.ts)))


def test_usgs(spark, folder):
    _put(folder, "a.json", {"features": [
        {"id": "u1", "properties": {"title": "M5", "place": "near X", "time": 1700000000123}, "geometry":
            {"coordinates": [10.5, -3.25, 7]}},
        {"id": None, "properties": {"title": "t", "place": "p", "time": 0}, "geometry": {"coordinates": [1, 2]}},
        {"id": "u2", "properties": {"title": None, "place": None, "time": 1}, "geometry": {"coordinates": [1]}},
        {"id": "u3", "properties": {"title": "t", "place": "", "time": None}, "geometry": None},
    ]})
    rows = _rows(S.load_usgs(spark, folder))
    assert len(rows) == 4
    one = next(r for r in rows if r.event_id == "u1")
    assert (one.source, one.lat, one.lon, one.country) == ("usgs", -3.25, 10.5, None)
    assert one.ts == datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert json.loads(one.raw_json)["properties"]["title"] == "M5"
    short = next(r for r in rows if r.event_id == "u2")
    assert (short.lat, short.lon) == (None, 1.0)
    assert [r.event_id for r in usable_rows(S.load_usgs(spark, folder)).collect()] == ["u1"]


def test_eonet_keeps_earliest_geometry_of_any_shape(spark, folder):
    _put(folder, "a.json", {"events": [
        {"id": "e1", "title": "Fire", "description": "d", "geometry": [
            {"coordinates": [3, 4], "date": "2024-01-03T00:00:00Z"}, {"coordinates": [1, 2], "date": "2024-01-01T00:00:00Z"}]},
        {"id": "e2", "title": "Flood", "description": None, "geometry": [
            {"coordinates": [[[7.5, 8.5], [9, 9]]], "date": "2024-02-01T00:00:00Z"}]},
        {"id": "e3", "title": "bad", "description": None, "geometry": [{"coordinates": "x", "date": "soon"}]},
    ]})
    rows = _rows(S.load_eonet(spark, folder))
    assert [(r.event_id, r.lat, r.lon) for r in rows] == [("e1", 2.0, 1.0), ("e2", 8.5, 7.5), ("e3", None, None)]
    assert rows[0].ts == datetime(2024, 1, 1) and rows[2].ts is None


def test_reliefweb(spark, folder):
    _put(folder, "a.json", {"data": [
        {"id": 77, "fields": {"title": "T", "body-html": "<p>b</p>", "date": {"created": "2024-03-01T10:00:00+02:00"},
                              "primary_country": {"iso3": "phl"}}},
        {"id": "78", "fields": {"title": "T"}}]})
    rows = _rows(S.load_reliefweb(spark, folder))
    assert (rows[0].event_id, rows[0].text, rows[0].country, rows[0].lat) == ("77", "<p>b</p>", "phl", None)
    assert rows[0].ts == datetime(2024, 3, 1, 8) and rows[1].ts is None


def test_gdacs_drops_duplicates(spark, folder):
    item = {"properties": {"eventid": 5, "name": "EQ", "description": "d", "fromdate": "2024-01-02T00:00:00", "iso3": "JPN"},
            "geometry": {"coordinates": [1, 2]}}
    later = {**item, "properties": {**item["properties"], "fromdate": "2024-01-05T00:00:00"}}
    _put(folder, "a.json", {"features": [later, item]})
    rows = _rows(S.load_gdacs(spark, folder))
    assert [(r.event_id, r.ts, r.lat) for r in rows] == [("5", datetime(2024, 1, 2), 2.0)]


def test_gdelt(spark, folder):
    def line(**cells):
        row = [""] * 61
        for k, v in cells.items():
            row[int(k[1:])] = v
        return "\t".join(row)

    _put(folder, "a.csv", "\n".join([
        line(c0="9", c1="20240105", c5="USA", c15="CHN", c26="190", c53="US", c56="1.5", c57="-2.5", c60="http://x"),
        line(c0="10", c1="notadate", c26="1", c56="abc", c57=""), "short\tline"]))
    rows = _rows(S.load_gdelt(spark, folder))
    by_id = {r.event_id: r for r in rows}
    assert (by_id["9"].title, by_id["9"].lat, by_id["9"].lon) == ("190 - USA - CHN", 1.5, -2.5)
    assert by_id["9"].ts == datetime(2024, 1, 5) and by_id["9"].country == "US"
    assert (by_id["10"].title, by_id["10"].lat, by_id["10"].ts) == ("1", None, None)
    assert "short" in by_id


@pytest.mark.parametrize("sep", ["\t", ","])
def test_social_either_separator_nested(spark, folder, sep):
    _put(folder, "x/y/a.csv", sep.join(["Tweet_ID", "event_name", "class_label", "TWEET_TEXT"]) + "\n"
         + sep.join(["1", "storm_2017", "c", '"hello there"']) + "\n" + sep.join(["2", "", "c", "bye"]) + "\n")
    as_of = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    rows = _rows(S.load_social(spark, folder, as_of))
    assert [(r.event_id, r.title, r.text) for r in rows] == [("1", "storm_2017", "hello there"), ("2", "", "bye")]
    assert rows[0].ts == datetime(2024, 1, 1)


def test_social_files_of_different_shapes(spark, folder):
    _put(folder, "a/a.tsv", "tweet_id\tevent_name\ttweet_text\n1\te\thi, there\n")
    _put(folder, "b/a.csv", "Tweet_Text,other,tweet_id\n\"a, b\",x,2\n")
    _put(folder, "b/c d+e%20.csv", "Tweet_Text,other,tweet_id\nsecond,x,3\n")
    _put(folder, "c.txt", "message\nplain\n")
    _put(folder, "empty.csv", "")
    shapes = S.file_shapes(spark, folder)
    assert sorted((s.separator, len(s.files)) for s in shapes) == [("\t", 1), ("\t", 1), (",", 2)]
    rows = {(r.event_id, r.title, r.text) for r in _rows(S.load_social(spark, folder))}
    assert rows == {("1", "e", "hi, there"), ("2", "", "a, b"), ("3", "", "second"), ("plain", "", "plain")}
    _put(folder + "/none", "a.csv", "")
    assert S.load_social(spark, folder + "/none").count() == 0


def test_social_column_fallbacks(spark, folder):
    _put(folder, "a.csv", "label,message\nx,hi\n")
    rows = _rows(S.load_social(spark, folder))
    assert (rows[0].event_id, rows[0].text, rows[0].title) == ("hi", "hi", "") and rows[0].ts is not None


def test_feed_union_skips_and_reports(spark, folder):
    good = _put(os.path.join(folder, "g"), "a.json", {"features": [
        {"id": "1", "properties": {"title": "t", "time": 1}, "geometry": {"coordinates": [1, 2]}}]})
    wrong = _put(os.path.join(folder, "w"), "a.json", {"other": []})
    feeds = {"usgs": lambda: S.load_usgs(spark, good), "eonet": lambda: S.load_eonet(spark, wrong),
             "gdacs": lambda: S.load_gdacs(spark, folder + "/missing")}
    rows, report = S.load_feeds(feeds)
    assert rows.count() == 1
    assert (report.loaded, report.empty, list(report.failed)) == (["usgs"], ["eonet"], ["gdacs"])
    with pytest.raises(S.NoSourceError):
        S.load_feeds({"gdacs": feeds["gdacs"], "eonet": feeds["eonet"]})


def test_posts(spark, folder):
    posts = [
        {"uri": "at://did:1/app/k1", "author": {"handle": "h"}, "record": {"text": "é" * 200,
                                                                           "createdAt": "2024-01-01T00:00:00.5Z"}},
        {"uri": "at://did:1/app/k2", "record": {"text": "b", "createdAt": "never"}},
        {"uri": "", "record": {"text": "b"}}, {"uri": "at://did:1/app/k3", "record": {"text": ""}},
        {"uri": None, "record": {"text": "x"}}]
    _put(folder, "a.json", "\n".join(json.dumps(p) for p in posts))
    as_of = F.to_timestamp(F.lit("2030-01-01 00:00:00"))
    rows = S.normalise_posts(spark.read.schema(POSTS_RAW).json(folder), as_of).orderBy("event_id").collect()
    assert [r.event_id for r in rows] == ["bsky_k1", "bsky_k2"]
    assert len(rows[0].title) == 140 and len(rows[0].text) == 200 and rows[0].ts == datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert rows[1].ts == datetime(2030, 1, 1) and rows[1].author == "unknown"


def test_keyword_text_drops_rows_without_year(spark, folder):
    _put(folder, "a.tsv", "2024\tPH\tflood\t3\n\tPH\tflood\t1\n2023\tUNK\taid\tx\n")
    rows = T.read_keywords(spark, folder).orderBy("year").collect()
    assert [(r.year, r.country, r.term, r["count"]) for r in rows] == [("2023", "UNK", "aid", None), ("2024", "PH", "flood", 3)]


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1"])
def test_named_encoding(spark, folder, encoding):
    item = {"id": "7", "fields": {"title": "Überflutung", "body-html": "Société", "date": {"created": "2024-01-02T03:04:05Z"},
                                  "primary_country": {"iso3": "FRA"}}}
    with open(os.path.join(folder, "a.json"), "w", encoding=encoding) as f:
        json.dump({"data": [item, item]}, f, indent=1, ensure_ascii=False)
    rows = _rows(S.load_reliefweb(spark, folder, encoding=encoding))
    assert [(r.title, r.text, r.country) for r in rows] == 2 * [("Überflutung", "Société", "FRA")]


def test_published_documents_are_read_in_their_encoding(inputs):
    """Finding out the encoding of each document takes several times as long as reading it."""
    from hazardlens.plans.registry import all_queries
    for name in ("s01_usgs_published", "s02_eonet_published", "s03_reliefweb_published", "s04_gdacs_published"):
        plan = all_queries()[name](inputs.spark, inputs.folder)._jdf.queryExecution().analyzed()
        assert "encoding" in str(plan.collectLeaves().head().relation().options()), name
