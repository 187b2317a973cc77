"""Registry coverage, entry point, plan shapes and a sample of oracle comparisons."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

import __spark_entry__ as entry_module
from check_oracle import TABLES, compare
from hazardlens.plans import registry

SF = "/root/testdata/sf0.001"
COUNTS = {"s": 12, "k": 12, "p": 29, "j": 11, "a": 36, "w": 8, "l": 8, "u": 8, "x": 8, "r": 5}
NO_ORACLE = {"x03_trained_classifier", "x05_theme_terms", "x06_theme_assignment"}
QUERIES = sorted(n for n in entry_module.queries() if n in registry.all_queries())


def test_every_operator_has_a_query():
    names = set(entry_module.queries())
    missing = [f"{letter}{k:02d}" for letter, n in COUNTS.items() for k in range(1, n + 1)
               if not any(name.startswith(f"{letter}{k:02d}_") for name in names)]
    assert missing == []
    without = {n for n in names - set(entry_module.oracle_sql()) if not n.startswith("op") and n != "pipeline"}
    assert without == NO_ORACLE


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["event_type", "n", "avg_sev"] and df.count() == 5


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def compared(spark, database):
    """Every registered query of this part of the library, a few at a time, against its counterpart on the same tables."""
    build, oracles = entry_module.queries(), entry_module.oracle_sql()

    def line(name):
        try:
            return compare(spark, SF, name, build[name], oracles.get(name), database.cursor())
        except Exception as error:
            return f"ERROR {name} {type(error).__name__}: {str(error)[:400]}"

    with ThreadPoolExecutor(6) as pool:
        return dict(zip(QUERIES, pool.map(line, QUERIES)))


@pytest.mark.parametrize("name", QUERIES)
def test_query(compared, name):
    assert compared[name].startswith(("ok", "ROWS") if name in NO_ORACLE else ("ok", "EMPTY")), compared[name]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "a04_kpi_block", "a13_severity_bands", "a30_source_share", "a34_type_country_term_counts", "j01_interval_join",
    "j07_keyless_join", "j09_scalar_subquery", "a02_lead_time_summary", "a20_quality_summary", "enriched_events"])
def test_no_product_joins_and_no_python(spark, name):
    plan = _plan(entry_module.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert name == "a02_lead_time_summary" or ("Python" not in plan and "Pandas" not in plan)


def test_reports_read_only_needed_columns(spark):
    plan = _plan(entry_module.queries()["a05_daily_totals"](spark, SF))
    events = [part for part in plan.split("FileScan parquet")[1:] if "events.parquet" in part]
    assert events and all("props" not in part.split("ReadSchema")[1][:200] for part in events)


def test_first_per_key_limits_groups_before_the_shuffle(spark):
    assert _plan(entry_module.queries()["u05_drop_duplicate_events"](spark, SF)).count("WindowGroupLimit") == 2
