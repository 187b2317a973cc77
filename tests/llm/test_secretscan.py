from __future__ import annotations

import hashlib
import random
import re
import string

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hazardlens.llm import secretscan
from hazardlens.llm.common import table
from hazardlens.llm.queries import op1_secret_scan
from tests.llm.conftest import ODD_ROWS, ODD_SCHEMA


def plain(text):
    """The patterns by their wording, one after another, without shortcuts."""
    letters = "".join(f"[{c}{c.upper()}]" for c in "x")[:0]
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    words = "|".join(either(w) for w in ("password", "passwd", "secret", "token", "api")) + letters
    words = words.replace(either("api"), either("api") + "_?" + either("key"))
    assign = re.compile(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = []
    for number, (kind, pattern, ok) in enumerate((
            ("assign", assign, lambda m: len(m[2]) >= 12), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
            ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16))):
        out += [(m.start(), number, kind, m.end()) for m in pattern.finditer(text) if ok(m)]
    return sorted(out)


pieces = st.sampled_from(["token", "TOKEN = ", "ſecret=", "Kapi_key", "ApiKey:'", "password\"  : \"", "AKIA", "A1B2C3D4E5F6G7H8",
                          "0123456789abcdef", "abc", "İ", "é", " ", "=", "secret_", "x" * 12, "\n", "passwd=token=abcdefabcdef.x"])


@settings(max_examples=400, deadline=None)
@given(st.lists(pieces, max_size=12).map("".join))
def test_base_spans(text):
    assert secretscan.base_spans(text) == plain(text)


@pytest.fixture(scope="module")
def ratios(spark):
    return secretscan.learn(table(spark, "/root/testdata/sf0.01", "documents"))


def test_random_strings_are_told_from_names(ratios):
    chance = random.Random(1)
    drawn = ["".join(chance.choice(letters) for _ in range(32)) for _ in range(300)
             for letters in (string.ascii_letters + string.digits, string.ascii_lowercase + string.digits)]
    assert sum(secretscan.is_random(t, ratios) for t in drawn) >= 0.98 * len(drawn)
    names = ["theretionerandingthat", "ANDTHTHTIONEDERANDING", "thatereandonthationing", "eratingthehandoring_of_ther"]
    assert not any(secretscan.is_random(t, ratios) for t in names)


def test_ratio_matches_a_plain_sum(ratios):
    token, previous, total = "Zq3vX9_kT+ab==", secretscan.STATES - 1, 0.0
    for c in token:
        here = secretscan.LETTERS.index(c)
        total += ratios[previous * secretscan.STATES + here]
        previous = here
    assert np.isclose(ratios[secretscan._steps(token)].sum(), total)


def test_added_spans_keep_clear_of_base_spans(ratios):
    text = "é token = Zq3vX9kTa8LmW2pQ and qX7Rk2Vb9Zt4Lw8Yp3Nc6Hd1 or 0123456789abcdef0 plainwords"
    found = secretscan.find(text, ratios)
    assert [k for k, _, _ in found] == ["assign", "random", "hex"]
    assert [text[a:b] for _, a, b in found][1] == "qX7Rk2Vb9Zt4Lw8Yp3Nc6Hd1"
    assert secretscan.find(None, ratios) == secretscan.find("", ratios) == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    rows = op1_secret_scan(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id] or "")
        named = [f"{kind}:{start}:{end}" for start, _, kind, end in base]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(b[2] == k for b in base) for k in secretscan.KINDS[:3]]
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == named
    assert sum(r.n_random > 0 for r in rows) <= 0.002 * len(rows)


def test_odd_rows(stored, ratios):
    docs = stored(ODD_ROWS, ODD_SCHEMA)
    assert secretscan.scan(docs, ratios).count() == len(ODD_ROWS)
    assert secretscan.scan(docs.where("doc_id < 0"), ratios).count() == 0
    assert np.isfinite(secretscan.learn(docs.where("doc_id < 0"))).all()
