from __future__ import annotations

import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from hazardlens.llm import mixing
from hazardlens.llm.queries import op9_source_mixing
from tests.llm.conftest import ODD_ROWS, ODD_SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fair_targets(sizes, weights, repeats=3):
    """By source in order: all words by weight, none above its limit."""
    total, open_, target = sum(sizes), set(range(len(sizes))), {}
    while open_:
        rest, weight = total - sum(target.values()), sum(weights[i] for i in open_)
        full = {i for i in open_ if repeats * sizes[i] <= Fraction(rest) * weights[i] / weight}
        if not full:
            target |= {i: Fraction(rest) * weights[i] / weight for i in open_}
            break
        target |= {i: Fraction(repeats * sizes[i]) for i in full}
        open_ -= full
    return [float(target[i]) for i in range(len(sizes))]


def award(targets, sizes, blocks, block, repeats=3):
    quota = [0] * len(targets)
    for _ in range(blocks):
        able = [i for i in range(len(targets)) if quota[i] < -(-sizes[i] * repeats // block)]
        if not able:
            break
        quota[max(able, key=lambda i: (targets[i] / (2 * quota[i] + 1), -i))] += 1
    return quota


def check(rows, mix):
    by = defaultdict(list)
    for r in mix.plan.collect():
        by[r.source_size, r.target].append(r)
        assert 0 <= r.taken <= 3 * r.size
    for (_, target), members in by.items():
        assert abs(sum(m.taken for m in members) - target) <= mix.block_words
    assert sum(r.taken for m in by.values() for r in m) <= sum(len(WORD.findall(r[1] or "")) for r in rows) + mix.block_words


def test_odd_rows(stored):
    docs = stored(ODD_ROWS, ODD_SCHEMA)
    mix = mixing.plan_mix(docs)
    assert mix.plan.count() == len(ODD_ROWS)
    check(ODD_ROWS, mix)


def test_targets_and_repeatability(documents):
    mix = mixing.plan_mix(documents)
    rows = mix.plan.collect()
    given = {r.doc_id: r for r in documents.collect()}
    size = defaultdict(int)
    for r in rows:
        assert r.size == len(WORD.findall(given[r.doc_id].text or ""))
        size[given[r.doc_id].source] += r.size
    names = sorted(size, key=lambda s: (s is None, s))
    want = dict(zip(names, fair_targets([size[n] for n in names], [i % 3 + 1 for i in range(len(names))])))
    for r in rows:
        source = given[r.doc_id].source
        assert r.source_size == size[source] and r.target == pytest.approx(want[source])
    again = mixing.plan_mix(documents.repartition(3).sortWithinPartitions("doc_id")).plan.collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


@pytest.mark.parametrize("seed", range(3))
def test_quotas_are_the_highest_quotients(spark, seed):
    chance = random.Random(seed)
    sizes = [chance.choice([1, 5, 40, 300, 2000, 9000]) for _ in range(7)]
    targets = fair_targets(sizes, [i % 3 + 1 for i in range(7)])
    block, shards = 16, 4
    blocks = int(sum(targets) / block + 0.5)
    table = spark.createDataFrame(list(zip(range(7), sizes, targets)), "source_no long, source_size long, target double")
    got = {r.source_no: r.bounds for r in mixing.quotas(table, blocks, block, shards).collect()}
    for house in range(1, shards + 1):
        assert [got[i][house - 1] for i in range(7)] == award(targets, sizes, blocks * house // shards, block)


def test_spans_cover_what_is_taken(documents):
    mix = mixing.plan_mix(documents, shards=5)
    taken = {r.row_id: r.taken for r in mix.plan.collect()}
    for by_shard in (True, False):
        words = defaultdict(int)
        for r in mixing.spans(mix, by_shard=by_shard).collect():
            assert 0 <= r.word_from < r.word_to <= r.size and 0 <= r.shard < 5
            words[r.row_id] += r.word_to - r.word_from
        assert words == {k: v for k, v in taken.items() if v}


def test_mixed_rows(stored):
    docs = stored(ODD_ROWS, ODD_SCHEMA)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = sum(len(WORD.findall(r.text)) for r in mixed.collect())
    assert words == sum(r.taken for r in mixing.plan_mix(docs).plan.collect())


@pytest.mark.parametrize("long_docs", [3, 12])
def test_tiny_sources_beside_very_long_documents(stored, long_docs):
    rows = [(i, "word " * (20_000 + i), "long" if i % 2 else "other") for i in range(long_docs)]
    rows += [(100, "a single short line", "tiny"), (101, "one", "word"), (102, "two short documents", "zwei"), (103, "of few words", "zwei")]
    docs = stored(rows, "doc_id long, text string, source string")
    sizes, source = defaultdict(int), {r[0]: r[2] for r in rows}
    for _, text, name in rows:
        sizes[name] += len(WORD.findall(text))
    names = sorted(sizes)
    want = dict(zip(names, fair_targets([sizes[n] for n in names], [i % 3 + 1 for i in range(len(names))])))
    taken, mixed = defaultdict(int), defaultdict(int)
    for r in mixing.plan_mix(docs).plan.collect():
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[n] - want[n]) <= 1 for n in names), (dict(taken), want)
    for r in mixing.mixed_documents(docs).collect():
        mixed[r.source] += len(WORD.findall(r.text))
    assert mixed == taken and set(mixed) == set(names)


@pytest.mark.parametrize("words", range(1, 11))
def test_query_keeps_tiny_sources(spark, folder, words):
    rows = [(i, "word " * (20_000 + i), "long") for i in range(3)] + [(9, "word " * words, "tiny"), (10, "one", "xs")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in op9_source_mixing(spark, folder).collect()}
    assert abs(got[9].taken - got[9].target) <= 1 and abs(got[10].taken - got[10].target) <= 1
    assert abs(sum(got[i].taken for i in range(3)) - got[0].target) <= 1 and got[9].target > 0 < got[10].target


def test_empty_table(documents):
    assert mixing.plan_mix(documents.where("doc_id < 0")).plan.count() == 0
