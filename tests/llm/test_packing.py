from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from hazardlens.llm import packing, tokens
from hazardlens.llm.tokens import WordTokens, default_tokenizer, loaded
from tests.llm.conftest import ODD_ROWS, ODD_SCHEMA


def brute_force(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_ids_are_the_tokenizers(texts):
    texts = [*texts, "It's <|endoftext|> ĲǅİΣΑΣ é a b x\x1cy 12½ don'T", "  \n"]
    found = list(loaded(default_tokenizer()).documents(pa.array(texts)))
    assert len(found) == len(texts)
    for text, ids, want in zip(texts, found, brute_force(texts)):
        assert ids.tolist() == want[:-1], text


def test_words_are_cut_in_few_passes(monkeypatch):
    class Counted:
        passes, pattern = 0, tokens._PIECES

        def findall(self, text):
            Counted.passes += 1
            return self.pattern.findall(text)

    monkeypatch.setattr(tokens, "_PIECES", Counted())
    monkeypatch.setattr(tokens, "CUT_CHARS", 4000)
    words = [odd for i in range(400) for odd in (f"word{i}'s", f"É{i},ȺɄ", f"漢{i}", f"<|endoftext|>{i}")]
    found = list(WordTokens(default_tokenizer(), cache_words=50).documents(pa.array([" ".join(words), "", "<| 漢"])))
    assert [ids.tolist() for ids in found] == [ids[:-1] for ids in brute_force([" ".join(words), "", "<| 漢"])]
    assert Counted.passes < 10


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_takes_the_tightest_bin(lengths):
    lengths = sorted(lengths, reverse=True)
    bins, offsets = packing.best_fit(lengths, 50)
    rooms: list[int] = []
    for length, number, offset in zip(lengths, bins, offsets):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            assert rooms[number] == min(fitting)
        else:
            assert number == len(rooms)
            rooms.append(50)
        assert offset == 50 - rooms[number]
        rooms[number] -= length


def check(rows, texts, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for doc_id, ids in texts:
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start:start + capacity]
            want[doc_id].append((piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= total / capacity * 1.02 + 2


def test_documents(documents):
    rows = packing.packed_documents(documents).collect()
    given = documents.select("doc_id", "text").collect()
    check(rows, list(zip([r.doc_id for r in given], brute_force([r.text for r in given]))), 4096)


def test_odd_rows(stored):
    docs = stored(ODD_ROWS, ODD_SCHEMA)
    rows = packing.packed_documents(docs, capacity=128).collect()
    check(rows, list(zip([r[0] for r in ODD_ROWS], brute_force([r[1] for r in ODD_ROWS]))), 128)


def test_several_groups(documents):
    cut = packing.pieces(documents, capacity=256)
    rows = packing.pack(cut, 256, group_pieces=100).collect()
    assert len(rows) == cut.count()
    assert len({r.sequence_id >> 32 for r in rows}) > 3


def test_sequences_hold_the_ids(stored):
    docs = stored(ODD_ROWS, ODD_SCHEMA)
    whole = packing.sequences(docs, capacity=128).collect()
    want = sorted(zip([r[0] or -1 for r in ODD_ROWS], map(len, brute_force([r[1] for r in ODD_ROWS]))))
    assert sum(len(r.ids) // 4 for r in whole) == sum(n for _, n in want)
    assert all(len(r.ids) <= 128 * 4 and r.offsets == sorted(r.offsets) for r in whole)


def test_empty_table(documents):
    assert packing.packed_documents(documents.limit(0)).count() == 0
