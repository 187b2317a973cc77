"""Severity score in [0, 1] as native expressions.

Five signals are read from the text and the strongest one wins: earthquake magnitude, death count,
displaced count, alert colour and heavy-damage wording. Only the first match of a pattern counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns, tiers and scores of the severity rule. (?U) makes \b, \s and \d Unicode-aware.
MAGNITUDE = r"(?iU)\bM\s?(\d(?:\.\d)?)"
DEATHS = r"(?iU)(\d{1,6})\s*(?:dead|deaths|killed|fatalities|casualt(?:y|ies)|missing)"
DISPLACED = r"(?iU)(\d{1,7})\s*(?:displaced|evacuated|homeless|affected)"
RED_ALERT = r"(?iU)\bred\s+alert\b"
ORANGE_ALERT = r"(?iU)\borange\s+alert\b"
HEAVY_DAMAGE = r"(?iU)\b(destroyed|devastated|collapsed|wiped out|catastrophic|massive damage)\b"
DEATH_TIERS = [(1000, 1.0), (100, 0.85), (10, 0.6), (1, 0.3)]
DISPLACED_TIERS = [(100_000, 0.9), (10_000, 0.7), (1_000, 0.5)]
RED_SCORE, ORANGE_SCORE, DAMAGE_SCORE = 0.85, 0.55, 0.65
#: Without these no match: a pattern, or parts of each word in lower case, none with a letter (i, k, s) that other than ASCII
#: letters fold to. They are cheap to look for, and most texts have few of them.
MAGNITUDE_NEEDS = r"(?U)[mM]\s?\d"
DEATHS_NEED = ["dea", "lled", "fatal", "ualt", "ng"]
DISPLACED_NEED = ["placed", "evacuated", "homele", "affected"]
ALERT_NEEDS = ["alert"]
DAMAGE_NEEDS = ["troyed", "tated", "collap", "ped out", "trop", "damage"]
SIGNALS = ("magnitude", "deaths", "displaced", "alert", "damage")


def _in_ascii(pattern: str) -> str:
    """``pattern`` with words, blanks and digits of ASCII only; cases still fold in Unicode. Spelled out, as what a plain
    \\b means in Java depends on its version. A leading \\b stands before a word, any other one behind a word."""
    word = "[0-9A-Za-z_]"
    begun = pattern.replace(r"(?iU)\b", f"(?iu)(?<!{word})").replace("(?iU)", "(?iu)")
    return begun.replace(r"\b", f"(?!{word})").replace(r"\s", r"[ \t\n\f\r]").replace(r"\d", "[0-9]")


def _number(text: str, pattern: str, dtype: str) -> str:
    # No match gives '', which must not reach the cast: a failed number parse is a costly exception.
    return f"try_cast(nullif(regexp_extract({text}, r'{pattern}', 1), '') AS {dtype})"


def _holds(lower: str, needed: list[str]) -> str:
    return "(" + " OR ".join(f"contains({lower}, '{part}')" for part in needed) + ")"


def _tiers(value: str, tiers: list[tuple[int, float]]) -> str:
    arms = " ".join(f"WHEN {value} >= {floor} THEN {score}D" for floor, score in tiers)
    return f"CASE {arms} ELSE 0D END"


def _combine(text: str, magnitude: str, deaths: str, displaced: str, signals: tuple[str, ...] = SIGNALS,
             spelt: Callable[[str], str] = str, lower: str | None = None) -> str:
    """``lower``: the text in lower case, if patterns are to be tried only where it holds what they need."""
    calm = "" if lower is None else f"WHEN NOT {_holds(lower, ALERT_NEEDS)} THEN 0D "
    damaged = "" if lower is None else f"{_holds(lower, DAMAGE_NEEDS)} AND "
    # least() skips NULL, so a missing magnitude must be caught first or it would score 1.0.
    quake = f"CASE WHEN {magnitude} IS NULL THEN 0D ELSE least(1D, ({magnitude} - 4D) / 5D) END"
    alert = (f"CASE {calm}WHEN {text} RLIKE r'{spelt(RED_ALERT)}' THEN {RED_SCORE}D "
             f"WHEN {text} RLIKE r'{spelt(ORANGE_ALERT)}' THEN {ORANGE_SCORE}D ELSE 0D END")
    damage = f"CASE WHEN {damaged}{text} RLIKE r'{spelt(HEAVY_DAMAGE)}' THEN {DAMAGE_SCORE}D ELSE 0D END"
    parts = [quake, _tiers(deaths, DEATH_TIERS), _tiers(displaced, DISPLACED_TIERS), alert, damage]
    return f"CAST(round(greatest(0D, {', '.join(p for name, p in zip(SIGNALS, parts) if name in signals)}), 3) AS FLOAT)"


def _scanned(text: str, max_chars: int | None) -> str:
    return text if max_chars is None else f"substring({text}, 1, {max_chars})"


def severity_sql(text: str, max_chars: int | None = None) -> str:
    """One-expression form for ``CREATE FUNCTION``; ``text`` is any SQL string expression. The whole text is read
    unless ``max_chars`` is given."""
    head = _scanned(text, max_chars)
    return _combine(head, _number(head, MAGNITUDE, "DOUBLE"), _number(head, DEATHS, "INT"),
                    _number(head, DISPLACED, "INT"))


def with_severity(df: DataFrame, text: str = "coalesce(text, title)", out: str = "severity",
                  max_chars: int | None = None, signals: tuple[str, ...] = SIGNALS, ascii_words: bool = False) -> DataFrame:
    """Staged form: each number is extracted once and reused by its tiers. Only ``signals`` (at least one) count; with
    ``ascii_words`` an accented letter is no part of a word."""
    spelt = _in_ascii if ascii_words else str
    keep = [c for c in df.columns if c != out]
    head = df.withColumn("__head", F.expr(_scanned(text, max_chars))).withColumn("__lower", F.lower("__head"))

    def found(needs: str, pattern: str) -> Column:
        return F.expr(f"CASE WHEN {needs} THEN regexp_extract(__head, r'{spelt(pattern)}', 1) END")

    texts = head.withColumns({
        "__mag": found(f"__head RLIKE r'{MAGNITUDE_NEEDS}'", MAGNITUDE),
        "__dead": found(_holds("__lower", DEATHS_NEED), DEATHS),
        "__moved": found(_holds("__lower", DISPLACED_NEED), DISPLACED),
    })
    # No match gives '', which must not reach the cast: a failed number parse is a costly exception.
    numbers = texts.withColumns({c: F.expr(f"try_cast(nullif({c}, '') AS {kind})")
                                 for c, kind in (("__mag", "DOUBLE"), ("__dead", "INT"), ("__moved", "INT"))})
    combined = _combine("__head", "__mag", "__dead", "__moved", signals, spelt, "__lower")
    return numbers.select(*keep, F.expr(combined).alias(out))
