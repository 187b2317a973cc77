from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import pytest

from hazardlens.llm import shards
from hazardlens.llm.common import table
from tests.llm.conftest import ODD_ROWS, ODD_SCHEMA
from tests.llm.test_packing import brute_force


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_slots_are_a_permutation(n):
    order = shards.Feistel(n, key=3)
    slots = order.scatter(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert order.gather(slots).tolist() == list(range(n))
    if n > 100:
        assert shards.Feistel(n, key=4).scatter(np.arange(n)).tolist() != slots.tolist()
        assert abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.1


def wanted(rows, seq_tokens):
    out = []
    for (doc_id, _), ids in zip(rows, brute_force([t for _, t in rows])):
        for piece, start in enumerate(range(0, len(ids), seq_tokens)):
            part = np.array(ids[start:start + seq_tokens], "<u4")
            out.append((str(doc_id), piece, len(part), zlib.crc32(part.tobytes())))
    return sorted(out)


def check(spark, docs, rows, path, seq_tokens, shard_bytes):
    shards.write_shards(docs, path, seq_tokens=seq_tokens, shard_bytes=shard_bytes)
    back = shards.read_shards(spark, path, seq_tokens).collect()
    assert sorted((str(r.doc_id), r.piece, r.length, r.ids_crc32) for r in back) == wanted(rows, seq_tokens)
    assert sorted(r.slot for r in back) == list(range(len(back)))
    by_slot = {r.slot: r for r in back}
    parts = shards.manifest(spark, path, seq_tokens).orderBy("shard").collect()
    assert len(parts) > 1 and sum(p.records for p in parts) == len(back)
    for part in parts:
        data = Path(part.file.removeprefix("file:")).read_bytes()
        assert len(data) == part.records * shards.stride(seq_tokens)
        assert part.records <= 3 * len(back) / len(parts) + 10
        for i, ids in enumerate(shards.read_from(data, part.records // 2, seq_tokens)):
            record = by_slot[part.first_slot + part.records // 2 + i]
            assert record.shard == part.shard
            assert zlib.crc32(ids.astype("<u4").tobytes()) == record.ids_crc32


def test_documents(spark, folder):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    check(spark, docs, [(r.doc_id, r.text) for r in docs.collect()], f"{folder}/shards", 128, 50_000)


def test_odd_rows(spark, stored, folder):
    docs = stored(ODD_ROWS, ODD_SCHEMA)
    check(spark, docs, [(r[0], r[1]) for r in ODD_ROWS], f"{folder}/shards", 64, 10_000)


def test_texts_that_grow_when_normalised(spark, stored, folder):
    texts = ["\u0958" * 200, "\U0001d160" * 100, "\u0130" * 300, "\u023a" * 300, "a" * 100]
    rows = list(enumerate(texts))
    check(spark, stored(rows, "doc_id long, text string"), rows, f"{folder}/shards", 16, 200)


def test_empty_table(spark, stored, folder):
    shards.write_shards(stored([], ODD_SCHEMA), f"{folder}/shards")
    assert shards.read_shards(spark, f"{folder}/shards").count() == 0
