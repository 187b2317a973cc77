from __future__ import annotations

import random
import re

import numpy as np
import pytest

from hazardlens.llm import jaccard
from hazardlens.llm.common import table
from hazardlens.llm.components import components
from hazardlens.llm.wordhash import words
from tests.llm.conftest import ODD_ROWS, ODD_SCHEMA

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").encode().lower())
    n = min(5, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute_force(rows, threshold=0.8):
    """(doc_id, class_id, n_links) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        near = {j for x in s for j in holders[x] if j > i}
        for j in near:
            both = len(s & sets[j])
            if both >= threshold * (len(s) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[root(j)] = root(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted((str(d), str(least.get(root(i))), links[i]) for i, (d, _) in enumerate(rows))


def result(docs, **options):
    rows = jaccard.similarity_classes(docs, **options).collect()
    return sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in rows)


def test_words_match_the_pattern():
    texts = [b"", b" a  bb\tc\n", "x y ein\x1cs é".encode(), b"w" * 200 + b" z", b"\x0b\x0c", b"ab ba ab"]
    hashes, begins = words(texts)
    want = [WORD.findall(t) for t in texts]
    assert np.diff(begins).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat))
    for a, x in zip(flat, hashes):
        for b, y in zip(flat, hashes):
            assert (a == b) == (x == y)


def test_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    assert result(docs) == brute_force([(r.doc_id, r.text) for r in docs.collect()])


def test_near_copies_in_blocks(stored, monkeypatch):
    chance = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(3):
        base = [chance.choice(vocabulary) for _ in range(120)]
        for _ in range(60):
            text = list(base)
            for _ in range(chance.randrange(6)):
                text[chance.randrange(len(text))] = chance.choice(vocabulary)
            rows.append((len(rows), " ".join(text)))
            base = text if chance.random() < 0.2 else base      # the group drifts: some of it is not linked
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 7)
    monkeypatch.setattr(jaccard, "GUEST_ROWS", 10)
    assert result(stored(rows, "doc_id long, text string")) == brute_force(rows)


def test_odd_rows(stored):
    docs = stored(ODD_ROWS, ODD_SCHEMA)
    assert result(docs) == brute_force([(r[0], r[1]) for r in ODD_ROWS])
    left = jaccard.keep_one_of_each(docs)
    assert left.columns == docs.columns
    assert left.count() == 8        # three rows with the six words leave one


def test_pruning_keeps_what_may_reach_the_threshold():
    fewest = jaccard.fewest_matches(0.8, 1e-6)
    assert all(a < b for a, b in zip(fewest[1:], fewest[2:])) and 70 < fewest[-1] < 95
    left = np.zeros((3, jaccard.HASHES), np.uint8)
    right = left.copy()
    right[1, ::2] = 1
    right[2, ::7] = 1
    assert jaccard.survivors(left, right, 0.8, 1e-6).tolist() == [0, 2]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 7), (20, 21)]
    got = {r.id: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20}


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")]])
def test_nothing_to_compare(stored, rows):
    assert result(stored(rows, "doc_id long, text string")) == brute_force(rows)


def test_null_ids_come_last(stored):
    text = "one two three four five six seven"
    docs = stored([(None, text), (5, text), (3, text), (None, "another text of a few words"), (None, ""), (None, None)], "doc_id long, text string")
    kept = sorted((str(r.doc_id), str(r.text)) for r in jaccard.keep_one_of_each(docs).collect())
    assert kept == [("3", text), ("None", ""), ("None", "None"), ("None", "another text of a few words")]
