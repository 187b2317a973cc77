"""Whole texts to token ids with a public tokenizer file, word by word through a bounded cache.

White space never reaches a token of this tokenizer, so a text's ids are the ids of its words in order. Words are
told apart inside Arrow, each distinct word is cut into pieces once, many words in one pass, each distinct piece is
tokenised once, and the ids are gathered as arrays.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hazardlens.llm.common import slices

END_OF_DOCUMENT = 1
#: Half of the pieces, and words that are no plain ones, that one worker remembers since the last and the last but one turnover.
CACHE_WORDS = 120_000
#: Texts whose words are told apart together, words whose ids are gathered together, texts handed on together.
SLICE_BYTES, PART_WORDS, OUTPUT_BYTES = 32 << 20, 500_000, 4 << 20
#: Characters of the words that are cut into pieces together.
CUT_CHARS = 4 << 20

#: Words of these characters need no further normalising than lower case; others go to the library as a whole.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ɏ]+")
_PLAIN_LINES = re.compile(r"[!-~À-ÖØ-öø-ɏ\n]*")
#: What plain words have for letters once they are in lower case.
_LETTERS = "a-zß-öø-ʯⱥⱦ"
#: Fixed value: how the tokenizer file splits a word into pieces; for plain words in lower case, one a line.
_PIECES = re.compile(rf"\n|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s0-9{_LETTERS}]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Recent(dict):
    """A bounded cache: what was used since the last turnover, and behind it what was used before."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.before = limit, {}

    def older(self, key):
        """What was used before the last turnover; from now on it counts as used."""
        found = self.before.get(key)
        if found is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[key] = value


def _gathered(known: list[bytes], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``known[i]`` for each ``i`` of ``which``, one after the other, and where each ends, after a first 0."""
    lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
    return _picked(np.frombuffer(b"".join(known), "<u4"), lengths, np.cumsum(lengths) - lengths, which)


def _picked(pool: np.ndarray, lengths: np.ndarray, sources: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    each = lengths[which]
    ends = np.concatenate([[0], np.cumsum(each)])
    return pool[np.repeat(sources[which] - ends[:-1], each) + np.arange(ends[-1])], ends


class WordTokens:
    """Ids of words, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.known = _Recent(2 * cache_words)

    def _piece(self, piece: str) -> bytes:
        found = self.known.older(piece)
        if found is None:
            shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            found = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            self.known.put(piece, found)
        return found

    def _odd_word(self, word: str) -> bytes:
        key = "\n" + word      # no piece
        found = self.known.get(key) or self.known.older(key)
        if found is None:
            found = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
            self.known.put(key, found)
        return found

    def _cut(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lines, odd = "\n".join(words), {}
        if "<|" in lines or not _PLAIN_LINES.fullmatch(lines):
            odd = {i: self._odd_word(w) for i, w in enumerate(words) if "<|" in w or not _PLAIN.fullmatch(w)}
            lines = "\n".join(["" if i in odd else w for i, w in enumerate(words)])
        coded = pa.array([*_PIECES.findall(lines.lower()), "\n"], pa.string()).dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        ends_word = pieces.index("\n")
        known = list(map(self.known.get, pieces))
        known[ends_word] = b""
        for i, found in enumerate(known):
            if found is None:
                known[i] = self._piece(pieces[i])
        which = coded.indices.to_numpy(zero_copy_only=False)
        ids, ends = _gathered(known, which)
        ends = ends[:-1][which == ends_word]
        lengths = np.diff(ends, prepend=0)
        if odd:
            at, found = np.fromiter(odd, np.int64, len(odd)), list(odd.values())
            more = np.fromiter(map(len, found), np.int64, len(found)) // 4
            ids = np.insert(ids, np.repeat(ends[at], more), np.frombuffer(b"".join(found), "<u4"))
            lengths[at] += more
        return ids, lengths

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``words`` (no white space in them) one after the other, and how many ids each has."""
        found = [self._cut(words[start:stop]) for start, stop in slices(map(len, words), CUT_CHARS)]
        if not found:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        return np.concatenate([ids for ids, _ in found]), np.concatenate([lengths for _, lengths in found])

    def documents(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each of ``texts`` (no nulls). Words are told apart over all of them, ids are gathered in parts."""
        split = pc.ascii_split_whitespace(texts)
        begins = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        del split
        pool, lengths = self.of_words(coded.dictionary.to_pylist())
        which = coded.indices.to_numpy(zero_copy_only=False)
        sources = np.cumsum(lengths) - lengths
        del coded
        for start, stop in slices(np.diff(begins).tolist(), PART_WORDS):
            ids, ends = _picked(pool, lengths, sources, which[begins[start]:begins[stop]])
            places = ends[begins[start:stop + 1] - begins[start]]
            for a, b in zip(places[:-1], places[1:]):
                yield ids[a:b]


_LOADED: dict[str, WordTokens] = {}


def loaded(path: str, cache_words: int = CACHE_WORDS) -> WordTokens:
    """The tokenizer of this worker."""
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path, cache_words)
    return _LOADED[path]


def document_tokens(batches: Iterator[pa.RecordBatch], path: str, column: str = "text", cache_words: int = CACHE_WORDS,
                    ) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches with the ids of each document, the end id included. Null text is empty."""
    tokens, end = loaded(path, cache_words), np.array([END_OF_DOCUMENT], "<u4")
    for batch in batches:
        texts = pc.fill_null(batch.column(column), "")
        sizes = pc.binary_length(texts).to_pylist()
        for start, stop in slices(sizes, SLICE_BYTES):
            ids = tokens.documents(texts.slice(start, stop - start))
            for first, last in slices(sizes[start:stop], OUTPUT_BYTES):
                yield batch.slice(start + first, last - first), [
                    np.concatenate([next(ids), end]) for _ in range(last - first)]
