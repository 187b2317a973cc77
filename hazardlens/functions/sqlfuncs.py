"""SQL-callable forms of the native scorers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.functions.severity import severity_sql
from hazardlens.functions.text import CAPITALISED
from hazardlens.operators.places import INLINE_NAMES, build_cities, build_countries, fetch_small

#: A gazetteer that a SQL function may hold: so many countries and so many towns, and their bytes.
LOOKUP_NAMES, LOOKUP_BYTES = 200_000, 32 << 20
PLACE = "geo_lat double, geo_lon double, geo_country string"


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _inline(nations: dict[str, str], towns: dict[str, tuple]) -> str:
    """One expression: the words are found once, then looked up in literal maps."""
    def literal(entries: list[str], kind: str) -> str:
        return f"map({', '.join(entries)})" if entries else f"CAST(map() AS MAP<STRING, {kind}>)"

    codes = literal([f"{_quoted(k)}, {_quoted(code)}" for k, code in nations.items()], "STRING")
    spots = literal([f"{_quoted(k)}, named_struct('geo_lat', {lat!r}D, 'geo_lon', {lon!r}D, 'geo_country', {_quoted(code)})"
                     for k, (lat, lon, code) in towns.items()], "STRUCT<geo_lat: DOUBLE, geo_lon: DOUBLE, geo_country: STRING>")
    nothing = "CAST(NULL AS DOUBLE)"
    words = f"array(transform(regexp_extract_all(t, r'{CAPITALISED}', 1), x -> lower(x)))"
    return (f"get(transform({words}, w -> coalesce("
            f"get(transform(filter(w, x -> {codes}[x] IS NOT NULL), x -> named_struct('geo_lat', {nothing}, 'geo_lon', "
            f"{nothing}, 'geo_country', {codes}[x])), 0), "
            f"get(transform(filter(w, x -> {spots}[x] IS NOT NULL), x -> {spots}[x]), 0), "
            f"named_struct('geo_lat', {nothing}, 'geo_lon', {nothing}, 'geo_country', CAST(NULL AS STRING)))), 0)")


def _register_lookup(spark: SparkSession, nations: dict[str, str], towns: dict[str, tuple]) -> None:
    """Beyond what fits an expression: the same rule over Arrow batches with a broadcast dictionary."""
    import re

    shared = spark.sparkContext.broadcast((nations, towns))
    pattern = re.compile(CAPITALISED.removeprefix("(?U)"))

    @F.pandas_udf(PLACE)
    def geoparse_text(texts: pd.Series) -> pd.DataFrame:
        nations, towns = shared.value

        def place(text: str | None) -> tuple:
            words = [w.lower() for w in pattern.findall(text or "")]
            code = next((nations[w] for w in words if w in nations), None)
            if code is not None:
                return None, None, code
            return next((towns[w] for w in words if w in towns), (None, None, None))

        return pd.DataFrame([place(t) for t in texts], columns=["geo_lat", "geo_lon", "geo_country"])

    spark.udf.register("geoparse_text", geoparse_text)


def register_sql_functions(spark: SparkSession, countries: DataFrame | None = None, cities: DataFrame | None = None,
                           inline_names: int = INLINE_NAMES) -> None:
    """Expose ``score_severity(text)`` and, given a gazetteer, ``geoparse_text(text)`` to SQL text.

    ``countries`` and ``cities`` are raw name tables; they are built like those of ``operators.places``, so both forms
    know the same places (towns above the least population, the largest of a shared name). A gazetteer of up to
    ``inline_names`` names becomes an expression that stays inside the JVM; one of up to ``LOOKUP_NAMES`` is looked up by a
    vectorised function with the same results. No more than that is ever fetched: a larger gazetteer is an error, as a
    function cannot be spread; :func:`hazardlens.operators.places.resolve_places` joins it instead.
    """
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION score_severity(t STRING) RETURNS FLOAT "
              f"RETURN {severity_sql('t')}")
    if countries is None or cities is None:
        return
    small = fetch_small(build_countries(countries), build_cities(cities), max(inline_names, LOOKUP_NAMES))
    if small is None or sum(table.nbytes for table in small) > LOOKUP_BYTES:
        raise ValueError(f"more than {LOOKUP_NAMES} names or {LOOKUP_BYTES} bytes: join the gazetteer with resolve_places")
    nations = {r["key"]: r["code"] for r in small[0].to_pylist()}
    towns = {r["key"]: (r["latitude"], r["longitude"], r["countrycode"]) for r in small[1].to_pylist()}
    spark.sql("DROP TEMPORARY FUNCTION IF EXISTS geoparse_text")
    if max(len(nations), len(towns)) > inline_names:
        _register_lookup(spark, nations, towns)
    else:
        spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION geoparse_text(t STRING) RETURNS STRUCT<geo_lat: DOUBLE, "
                  f"geo_lon: DOUBLE, geo_country: STRING> RETURN {_inline(nations, towns)}")
