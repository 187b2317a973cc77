from __future__ import annotations

import hashlib
import string
from collections import defaultdict

import pytest

from hazardlens.llm import blocknames
from tests.llm.conftest import ODD_ROWS, ODD_SCHEMA

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(str(i), str(keep), len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out)


@pytest.mark.parametrize("block", [1, 3, 64, 4096])
def test_odd_rows(stored, block):
    docs = stored([(r[0], (r[1] or "")[:2000] if block < 64 else r[1], *r[2:]) for r in ODD_ROWS], ODD_SCHEMA)
    rows = blocknames.exact_duplicates(docs, block_bytes=block).collect()
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in rows)
    given = docs.select("doc_id", "text").collect()
    assert got == expected([(r.doc_id, r.text) for r in given])
    kept = [r for r in rows if r.kept]
    assert len(kept) == len({r.text_sha256 for r in rows}) and all(r.doc_id == r.keep_id for r in kept)


def test_documents_with_small_blocks(documents):
    rows = blocknames.exact_duplicates(documents, block_bytes=100).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in rows) == expected(
        [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])


def test_names_do_not_confuse_order_or_length(stored):
    texts = ["abab", "abba", "ab", "aba", "babab", "", "a" * 9, "a" * 8, "a" * 7]
    rows = blocknames.exact_duplicates(stored(list(enumerate(texts)), "doc_id long, text string"), block_bytes=2).collect()
    assert all(r.group_size == 1 and r.kept for r in rows) and len(rows) == len(texts)


def test_drop_keeps_columns(stored):
    docs = stored(ODD_ROWS, ODD_SCHEMA)
    left = blocknames.drop_duplicates(docs)
    assert left.columns == docs.columns
    assert left.count() == len({(r[1] or "").translate(LOWER) for r in ODD_ROWS})


def test_empty_table(documents):
    assert blocknames.exact_duplicates(documents.where("doc_id < 0")).count() == 0
