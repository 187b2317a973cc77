"""Secret scan: fixed patterns, and character Markov models for random strings.

Two first-order Markov models over the characters of identifiers, one of random strings and one of ordinary names,
are learned from labelled samples: values that the patterns find (and seeded uniform strings) against the other
words of the texts. A token whose log-likelihood ratio favours the random model clearly is a secret too. Patterns
and models run in one pass over whole texts; nothing but spans comes out.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The patterns, in this order, and the shortest value or match of each.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16

#: Tokens that the models judge, and the words that count as ordinary when learning.
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
NAME = re.compile(r"[A-Za-z0-9_]{4,}")
LETTERS = string.ascii_letters + string.digits + "+/_-="
_NUMBER = np.full(128, len(LETTERS))
_NUMBER[[ord(c) for c in LETTERS]] = range(len(LETTERS))
STATES = len(LETTERS) + 1       # the last one stands before the first character

#: Expected number of documents that the models learn from.
SAMPLE_DOCS = 20_000
#: Log-likelihood ratio a token needs, in nats: in all and per character.
MIN_RATIO, MIN_PER_CHARACTER = 12.0, 0.5

_WORD_STARTS = ("passw", "secret", "token", "api")
_HEX_RUN = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))
_TOKEN_RUN = bytes(1 if b < 128 and chr(b) in LETTERS else 0 for b in range(256))

SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, kind number, kind, end) of all pattern matches, leftmost first for each kind."""
    found = []
    lower = text.lower()
    if any(w in lower for w in _WORD_STARTS):
        found += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    if b"\1" * HEX_MIN in text.encode("latin-1", "replace").translate(_HEX_RUN):
        found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _codes(token: str) -> np.ndarray:
    return _NUMBER[np.frombuffer(token.encode("ascii"), np.uint8)]


def _steps(token: str) -> np.ndarray:
    """State changes of a token, as one number each."""
    codes = np.concatenate([[STATES - 1], _codes(token)])
    return codes[:-1] * STATES + codes[1:]


def _values(text: str, spans: list[tuple[int, int, str, int]]) -> list[str]:
    out = []
    for start, _, kind, end in spans:
        value = ASSIGN.fullmatch(text[start:end])[2] if kind == "assign" else text[start:end]
        out += re.findall(r"[A-Za-z0-9+/_=-]{8,}", value)
    return out


def _count_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of state changes in secrets (label 1) and in other words, as written and in capitals (label 0)."""
    counts = np.zeros((2, STATES * STATES), np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            if not text:
                continue
            spans = base_spans(text)
            for value in _values(text, spans):
                np.add.at(counts[1], _steps(value), 1)
            rest, last = [], 0
            for start, _, _, end in spans:
                rest.append(text[last:max(start, last)])
                last = max(last, end)
            rest.append(text[last:])
            words = NAME.findall(" ".join(rest))
            if words:
                for version in (words, [w.upper() for w in words]):
                    letters = np.frombuffer(" ".join(version).encode("ascii"), np.uint8)
                    codes = np.where(letters == 32, STATES - 1, _NUMBER[letters])
                    codes = np.concatenate([[STATES - 1], codes])
                    keep = codes[1:] != STATES - 1
                    counts[0] += np.bincount((codes[:-1] * STATES + codes[1:])[keep], minlength=STATES * STATES)
    label, step = np.nonzero(counts)
    yield pa.RecordBatch.from_pydict({"label": pa.array(label, pa.int32()), "step": pa.array(step, pa.int32()),
                                      "n": pa.array(counts[label, step], pa.int64())})


def _uniform_steps(strings: int = 3000, seed: int = 1) -> np.ndarray:
    """State changes in uniformly random strings over hex, base 36, base 62 and base 64 letters."""
    chance, counts = np.random.default_rng(seed), np.zeros(STATES * STATES)
    lower = string.ascii_lowercase + string.digits
    for letters in ("0123456789abcdef", lower, lower.upper(), string.ascii_letters + string.digits, LETTERS[:-1]):
        for _ in range(strings):
            np.add.at(counts, _steps("".join(letters[i] for i in chance.integers(0, len(letters), 24))), 1)
    return counts


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """Log-likelihood ratio of each state change (random over ordinary), from a sample chosen by a hash of the id.

    The counts are summed in Spark; at most two numbers per pair of characters reach the driver."""
    rows = docs.count()
    draw = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) < int(min(1.0, sample_docs / max(rows, 1)) * (1 << 30))
    found = docs.where(draw).select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        _count_steps, "label int, step int, n long").groupBy("label", "step").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((2, STATES * STATES))
    counts[found.column("label").to_numpy(), found.column("step").to_numpy()] = found.column("n").to_numpy()
    random = counts[1] / max(counts[1].sum(), 1) * 1e5 + _uniform_steps()
    likely = []
    for table, base in ((random, 1.0), (counts[0], 0.5)):
        smooth = table.reshape(STATES, STATES) + base
        likely.append(np.log(smooth / smooth.sum(axis=1, keepdims=True)))
    return (likely[0] - likely[1]).ravel()


def is_random(token: str, ratios: np.ndarray) -> bool:
    ratio = ratios[_steps(token)].sum()
    return bool(ratio >= MIN_RATIO and ratio >= MIN_PER_CHARACTER * len(token))


def find(text: str | None, ratios: np.ndarray) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets by start, then kind. Null and empty texts have none; ends are exclusive and
    count code points. Tokens that touch a pattern's match are left to it."""
    if not text:
        return []
    base = base_spans(text)
    added = []
    if b"\1" * 16 in text.encode("latin-1", "replace").translate(_TOKEN_RUN):
        for m in TOKEN.finditer(text):
            if not any(start < m.end() and m.start() < end for start, _, _, end in base) and is_random(m[0], ratios):
                added.append((m.start(), 3, "random", m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(base + added)]


def _scan(batches: Iterator[pa.RecordBatch], ratios: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find(text, ratios)]
                 for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _SPANS)], names=["doc_id", "spans"])


def scan(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row of ``docs``; ``spans`` holds (kind, start, end) as :func:`find` gives them.

    Ids may be null or repeated; an empty table gives no rows; other columns are not read."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        partial(_scan, ratios=ratios), f"doc_id long, spans {SPANS}")
