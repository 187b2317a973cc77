from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hazardlens.llm import hostrules
from hazardlens.llm.common import table
from tests.llm.conftest import ODD_ROWS, ODD_SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


def verdicts(rows, most=0.5):
    """(doc_id, counts, base_failed, kept) from the definitions."""
    measured = [(d, host, counts(t)) for d, t, host in rows]
    failed = [c[0] < 20 or 100 * c[4] > 30 * c[0] for _, _, c in measured]
    hosts = defaultdict(list)
    for (_, host, _), bad in zip(measured, failed):
        hosts[host].append(bad)
    n = len(rows)
    mean = min(max(sum(failed) / n, 0.5 / n), 1 - 0.5 / n)
    spread = sum(len(b) * (sum(b) / len(b) - mean) ** 2 for b in hosts.values())
    room = n - sum(len(b) ** 2 for b in hosts.values()) / n - (len(hosts) - 1)
    within = (spread / (mean * (1 - mean)) - (len(hosts) - 1)) / room if room > 0 else 0
    strength = 1 / min(max(within, 1e-3), 0.999) - 1
    rate = {h: (sum(b) + mean * strength) / (len(b) + strength) for h, b in hosts.items()}
    return sorted((str(d), *c, bad, not bad and rate[host] <= most) for (d, host, c), bad in zip(measured, failed))


def result(docs, **options):
    return sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
                  for r in hostrules.judge(docs, F.col("source"), **options).collect())


def test_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert result(docs) == verdicts([(r.doc_id, r.text, r.source) for r in docs.collect()])


def test_odd_rows(stored):
    assert result(stored(ODD_ROWS, ODD_SCHEMA)) == verdicts([(r[0], r[1], r[3]) for r in ODD_ROWS])


def test_repeats_in_many_shapes(stored):
    chance = random.Random(2)
    rows = []
    for i in range(200):
        words = [chance.choice("abcdef") for _ in range(chance.randrange(40))]
        for _ in range(chance.randrange(3)):
            at, to = chance.randrange(len(words) + 1), chance.randrange(len(words) + 1)
            words[to:to] = words[at:at + chance.randrange(20)]
        lines = chance.choice([" ", "\n", "\t", " \n \n"]).join(words)
        rows.append((i, lines, f"h{i % 5}"))
    assert result(stored(rows, "doc_id long, text string, source string")) == verdicts(rows)


def test_bad_hosts_take_their_documents_along(stored):
    good, bad = " ".join(f"w{i}" for i in range(30)), "too short"
    rows = [(i, bad if i % 10 else good, "bad") for i in range(100)]
    rows += [(100 + i, good if i % 10 else bad, "good") for i in range(100)]
    rows += [(200 + i, good, f"small{i}") for i in range(5)]
    got = result(stored(rows, "doc_id long, text string, source string"))
    assert got == verdicts(rows)
    kept = {int(r[0]) for r in got if r[-1]}
    assert kept == {100 + i for i in range(100) if i % 10} | set(range(200, 205))


def test_hosts_of_urls(spark):
    urls = [("http://A.example/x",), ("no url",), (None,), ("https://b.example:8080/?q",)]
    rows = spark.createDataFrame(urls, "url string").select(hostrules.host_of(F.col("url")).alias("h")).collect()
    assert [r.h for r in rows] == ["a.example", None, None, "b.example"]


@pytest.mark.parametrize("rows", [[], [(None, None, None)]])
def test_hardly_any_rows(stored, rows):
    docs = stored(rows, "doc_id long, text string, source string")
    assert result(docs) == (verdicts(rows) if rows else [])


def test_no_python_in_the_plan(documents):
    plan = hostrules.judge(documents, F.col("source"))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
