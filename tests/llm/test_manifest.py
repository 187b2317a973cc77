from __future__ import annotations

import hashlib
import zlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazardlens.llm import manifest
from hazardlens.llm.common import table
from hazardlens.llm.queries import op12_merkle_manifest
from tests.llm.conftest import ODD_ROWS, ODD_SCHEMA


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def grown(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, pos):
    out = []
    for nodes in levels[:-1]:
        out.append((pos & 1 == 1, nodes[pos ^ 1] if pos ^ 1 < len(nodes) else ""))
        pos >>= 1
    return out


def expected(rows):
    """Rows (doc_id, text, lang, source, n_chars) by the definition."""
    def leaf(doc_id, text, lang, source, n_chars):
        return sha(*map(coded, (doc_id, source, lang, n_chars, text)))
    by = {}
    for row in rows:
        by.setdefault(row[2], []).append(row)
    trees = {}
    for lang, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[lang] = grown([leaf(*r) for r in own])
    order = sorted(by, key=lambda lang: (lang is not None, (lang or "").encode()))
    top = grown([trees[lang][-1][0] for lang in order])
    out = []
    for number, lang in enumerate(order):
        for pos, row in enumerate(by[lang]):
            path = siblings(trees[lang], pos) + siblings(top, number)
            node, n = leaf(*row), row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and n is not None:
                node = leaf(*row[:4], n + 1)
            for left, sibling in path:
                node = sha(sibling, node) if left else sha(node, sibling)
            out.append((str(row[0]), leaf(*row), trees[lang][-1][0], top[-1][0], sha(*(s for _, s in path)), node, node == top[-1][0]))
    return sorted(out)


def shown(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def query_on(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return op12_merkle_manifest(spark, folder)


def test_odd_rows(spark, folder):
    many = [*ODD_ROWS, (9, "x", "İ", "a", 2**63 - 1, 1, "y", 1), (14, "ü", "zz", None, None, 1, "y", 1)]
    assert shown(query_on(spark, folder, many, ODD_SCHEMA)) == expected([r[:5] for r in many])


@pytest.mark.parametrize("count", [1, 2, 3, 5])
def test_few_rows(spark, folder, count):
    rows = [(i, f"t{i}", "en", "a", i) for i in range(count)]
    assert shown(query_on(spark, folder, rows, "doc_id long, text string, lang string, source string, n_chars long")) == expected(rows)


def test_empty_table(spark, folder):
    assert query_on(spark, folder, [], ODD_SCHEMA).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert shown(op12_merkle_manifest(spark, folder)) == expected([tuple(r) for r in rows])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None, "c"]), st.integers(0, 3)), min_size=1, max_size=40), st.sampled_from([1, 2, 3]))
def test_many_rounds(spark, rows, height):
    """Low segments, so that trees need several rounds; equal rows give equal segments."""
    frame = spark.createDataFrame([(k, v) for k, v in rows], "k string, v int")
    built = manifest.build(frame, F.col("k"), F.col("v"), F.sha2(F.col("v").cast("string"), 256), height=height)
    proofs = manifest.prove(built).select("*", manifest.folded(F.col("digest"), F.col("path")).alias("root")).collect()
    assert len(proofs) == len(rows) and {r.root for r in proofs} == {built.root}
    assert sorted(r.digest for r in proofs) == sorted(sha(str(v)) for _, v in rows)


def test_some_requests(spark):
    rows = [(k, i) for k in "abc" for i in range(9)]
    frame = spark.createDataFrame(rows, "k string, v int")
    built = manifest.build(frame, F.col("k"), F.col("v"), F.sha2(F.concat("k", "v"), 256), F.struct("k", "v"), height=2)
    asked = manifest.prove(built, built.leaves.where("payload.v % 4 = 3")).select("payload.*", "digest", "path").collect()
    assert {(r.k, r.v) for r in asked} == {(k, v) for k, v in rows if v % 4 == 3}
    assert all(r.digest == sha(r.k, str(r.v)) and len(r.path) == 4 + 2 for r in asked)


def test_store_holds_each_node_once_for_its_content(spark):
    frame = spark.createDataFrame([("a", 1)] * 16, "k string, v int")
    built = manifest.build(frame, F.col("k"), F.col("v"), F.lit("0" * 64), height=2)
    assert built.store.select("digest", "node").distinct().count() == 4
    assert all(r.node == sha(*r.children) for r in built.store.collect())
