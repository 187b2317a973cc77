from __future__ import annotations

import re
import string
from collections import Counter

import corpus_pipeline
from hazardlens.llm import langid, mixing
from hazardlens.llm.common import table
from tests.llm.conftest import ODD_ROWS, ODD_SCHEMA
from tests.llm.test_jaccard import brute_force
from tests.llm.test_packing import brute_force as token_ids

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def outputs(spark, docs, folder):
    """What each stage returns, written and read again."""
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, out[-1], folder).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def check_stages(spark, docs, folder):
    given, known, single, apart, mixed, packed = outputs(spark, docs, folder)
    for stage in (known, single, apart, mixed):
        assert stage.columns == given.columns
    model = langid.learn(given)
    rows = given.collect()
    named, scores, sizes = langid.classify([r.text for r in rows], model)
    want = [r for r, n, s, k in zip(rows, named, scores, sizes) if n != "und" and (s >= 0.2 or k < langid.FEW_GRAMS)]
    assert Counter(map(str, known.collect())) == Counter(map(str, want))
    best = {}
    for r in want:
        key = (r.text or "").translate(LOWER)
        best[key] = max(best.get(key, r), r, key=lambda x: (x.doc_id is not None, x.doc_id or 0))
    assert sorted(str(r.doc_id) for r in single.collect()) == sorted(str(r.doc_id) for r in best.values())
    classes = brute_force([(r.doc_id, r.text) for r in single.collect()])
    assert sorted(str(r.doc_id) for r in apart.collect()) == sorted({c for _, c, _ in classes})
    plan = mixing.plan_mix(apart).plan.collect()
    taken = Counter()
    for r in mixed.collect():
        taken[r.doc_id] += len(WORD.findall(r.text))
    assert taken == Counter({r.doc_id: r.taken for r in plan if r.taken})
    texts = [r.asDict() for r in mixed.collect()]
    rows = packed.collect()
    assert sum(r.length for r in rows) == sum(map(len, token_ids([t["text"] for t in texts])))
    assert len(rows) >= len(texts)
    return texts, rows


def test_stages(spark, folder):
    texts, rows = check_stages(spark, table(spark, "/root/testdata/sf0.001", "documents"), folder)
    assert {r.doc_id for r in rows} == {t["doc_id"] for t in texts}


def test_odd_rows(spark, stored, folder):
    docs = stored([r for r in ODD_ROWS if r[0] is not None], ODD_SCHEMA)
    check_stages(spark, docs, folder)


def test_null_ids(spark, stored, folder):
    given, known, single, apart, mixed, packed = outputs(spark, stored(ODD_ROWS, ODD_SCHEMA), folder)
    assert {r.text for r in known.collect() if r.doc_id is None} == {"The the"}
    assert sum(r.doc_id is None for r in single.collect()) == sum(r.doc_id is None for r in apart.collect()) == 1
    assert any(r.doc_id is None for r in mixed.collect()) and any(r.doc_id is None for r in packed.collect())


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 50


def test_empty_table(spark, stored, folder):
    docs = stored([], ODD_SCHEMA)
    assert [d.count() for d in outputs(spark, docs, folder)] == [0] * 6
