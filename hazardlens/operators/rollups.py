"""Daily cubes of the enriched table: reports without a scan of the events.

A cube counts events by a few columns for each day. Counts add up, so the cubes of a batch are appended as they are and
summed when they are read, late rows included; only a day whose events were replaced is counted again. Severity has at
most 1001 values, so counts by severity give exact quantiles. Reports are those of :mod:`hazardlens.plans.hub`: a cube row
stands for ``weight`` events.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.plans import hub as H
from hazardlens.schema import QUALITY_FLAGS
from hazardlens.session import checkpointed
from hazardlens.sinks.snapshots import Change, Snapshot, SnapshotTable

#: The columns of each cube besides the day.
CUBES = {
    "hours": ["hour", "source"],
    "types": ["source", "event_type"],
    "severities": ["source", "event_type", "severity"],
    "places": ["country_resolved", "source", "severity", "has_any_geo"],
    "quality": ["source", "event_type", *QUALITY_FLAGS],
}
#: What cubes are made from.
CUBE_INPUTS = ["source", "event_type", "ts", "severity", "country", "geo_country", "lat", "lon", "geo_lat", "geo_lon", "text", "classify_conf"]
COLUMNS = ["hour", "source", "event_type", "severity", "country_resolved", "has_any_geo", *QUALITY_FLAGS]


def cubes_of(enriched: DataFrame) -> DataFrame:
    """All cubes of the given events in one pass: ``day, cube, <columns>, weight, ts`` (the newest time)."""
    base = H.fill_defaults(H.flagged_events(enriched)).withColumns({
        "day": F.date_trunc("day", "ts"), "hour": F.hour("ts"), "has_any_geo": F.greatest("has_raw_coords", "has_geo_coords")})
    keys = ["day", *COLUMNS]
    kind = F.lit("")
    sets: list[list[Column]] = []
    for name, columns in CUBES.items():
        sets.append([F.col(c) for c in ("day", *columns)])
        absent = [F.grouping(c) == (0 if c in columns else 1) for c in COLUMNS]
        test = absent[0]
        for other in absent[1:]:
            test = test & other
        kind = F.when(test, name).otherwise(kind)
    counted = base.groupingSets(sets, *keys).agg(F.count(F.lit(1)).alias("weight"), F.max("ts").alias("ts"), kind.alias("cube"))
    return counted.select("cube", *COLUMNS, "weight", "ts", F.date_format("day", "yyyy-MM-dd").alias("date"))


class Rollups:
    """Cubes in a snapshot table with a folder for each day."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = SnapshotTable(spark, path, ("date",))

    def add(self, enriched: DataFrame, batch: tuple[str, int] | None = None) -> None:
        """Count further events, of whatever days. A ``batch`` (stream, number) counts once."""
        self.table.append(cubes_of(enriched), batch)

    def replace_days(self, enriched: DataFrame, days: list[str]) -> None:
        """Forget what was counted for ``days`` (``yyyy-MM-dd``) and count ``enriched``, all events of these days, instead."""
        folders = {f"date={day}" for day in days}
        # Comparing dates costs little; only rows near these days are written out as text.
        near = [F.to_date("ts") == F.try_to_date(F.lit(day)) for day in days]
        years = F.to_date("ts").between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date"))     # written as they are
        wanted = reduce(lambda a, b: a | b, near, ~years) & F.date_format("ts", "yyyy-MM-dd").isin(days)
        cubes = checkpointed(cubes_of(enriched.where(wanted)))

        def make(base: Snapshot) -> Change:
            old = frozenset(f["file"] for f in base.files if f["folder"] in folders)
            return Change("replace days", self.table._write(cubes), base.schema or cubes.schema, old, frozenset(folders))

        self.table.begin(make).commit()

    def tidy(self) -> None:
        """Merge the small files of days that were added to often."""
        self.table.compact()

    def base(self, cube: str, days: int = 180) -> DataFrame:
        """The cube of the last ``days`` calendar days up to the newest, in the shape that the reports expect. Only the
        folders of these days are read."""
        rows = self.table.read()
        newest = rows.agg(F.max("date")).first()[0]
        columns = CUBES[cube]
        kept = rows.where((F.col("cube") == cube) & (F.col("date") >= F.date_format(F.date_sub(F.lit(newest).cast("date"), days - 1), "yyyy-MM-dd")))
        day = F.to_timestamp("date", "yyyy-MM-dd")
        derived = {"day": day, "month": F.date_format(day, "yyyy-MM"), "weekday": F.date_format(day, "E")}
        if "severity" in columns:
            derived["severity_band"] = H.severity_band(F.col("severity"))
        if cube == "quality":
            flags = [F.col(f) for f in QUALITY_FLAGS]
            derived |= {"has_any_geo": F.greatest("has_raw_coords", "has_geo_coords"), "completeness_score": sum(flags[1:], flags[0]) / len(flags)}
        wanted = [*columns, "weight", "ts"]
        return kept.select(*wanted, "date").withColumns(derived).select(*wanted, *derived)

    def kpis(self, days: int = 180, top_countries: int = 12) -> DataFrame:
        """:func:`hazardlens.plans.hub.kpis` from the cubes."""
        parts = []
        dims = {"day": ("hours", "timestamp"), "source": ("hours", "string"), "event_type": ("types", "string"),
                "country_resolved": ("places", "string"), "severity": ("severities", "float")}
        for dim, (cube, _) in dims.items():
            counts = self.base(cube, days).groupBy(dim).agg(F.sum("weight").alias("n"))
            parts.append(counts.select(*[F.col(d).cast(kind) if d == dim else F.lit(None).cast(kind).alias(d) for d, (_, kind) in dims.items()],
                                       "n", F.lit(dim).alias("kind")))
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return H.kpi_figures(whole, top_countries)
