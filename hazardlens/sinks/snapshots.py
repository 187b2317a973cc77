"""Tables of immutable files with a versioned list of what belongs to them.

A version is one JSON file below ``_versions`` that names all files of the table. Data files are written first, where no
reader looks; a version file then takes the next number by a rename that fails if the number is taken. So a reader sees
one version or the next, never a mixture, and a writer that stops leaves files that no version names.

Writers do not lock. A change is prepared on the version it read; if others came first, it is put on top of theirs as long
as they touched none of the folders that it read and all files it replaces are still there, and is made anew otherwise.
The rename has to be exclusive, as on HDFS and local disks; an object store needs a committer with conditional puts.

The list of files is what passes through the driver, as in any file source; rows never do.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlens.operators.normalize import first_per_key
from hazardlens.session import checkpointed
from hazardlens.sinks import keyindex

MAX_ROWS_PER_FILE = 5_000_000
TARGET_BYTES = 128 << 20
#: So many files of about one size in a folder are merged; sizes are told apart by powers of this number.
TIER_FILES = 4
ATTEMPTS = 10
COMMIT = "snapshot_commit"


class Conflict(RuntimeError):
    """Another writer changed what this change was made from."""


@dataclass(frozen=True)
class Snapshot:
    version: int
    schema: T.StructType | None = None
    files: tuple[dict, ...] = ()
    touched: frozenset[str] | None = frozenset()        #: folders that this version changed; None: any
    batches: dict[str, int] = field(default_factory=dict)
    operation: str = ""


@dataclass
class Change:
    operation: str
    added: list[dict]
    schema: T.StructType
    removed: frozenset[str] | None = frozenset()        #: files; None: all there are when it is committed
    read: frozenset[str] | None = frozenset()           #: folders whose content decided what is added; None: any
    batch: tuple[str, int] | None = None
    rows: int | None = None                             #: counted while they were written


class SnapshotTable:
    """``partition_by`` gives the folders; ``index_key`` keeps a key index beside the files (see :mod:`keyindex`)."""

    def __init__(self, spark: SparkSession, path: str, partition_by: tuple[str, ...] = (), sort_by: tuple = (),
                 index_key: str | None = None, max_rows: int = MAX_ROWS_PER_FILE):
        self.spark, self.path = spark, path.rstrip("/")
        self.partition_by, self.sort_by, self.index_key, self.max_rows = partition_by, sort_by, index_key, max_rows
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.files_opened = 0       #: by the last key lookup

    # ---- versions ----

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def versions(self) -> list[int]:
        folder = self._path("_versions")
        if not self._fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The given version or the newest one; version 0 is the table before its first change."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return Snapshot(0)
        stream = self._fs.open(self._path(f"_versions/{version:012d}.json"))
        try:
            held = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        return Snapshot(version, T.StructType.fromJson(held["schema"]), tuple(held["files"]),
                        None if held["touched"] is None else frozenset(held["touched"]), held["batches"], held["operation"])

    def _put(self, snapshot: Snapshot) -> bool:
        """Store a version file; false if its number is taken."""
        body = json.dumps({
            "operation": snapshot.operation, "schema": snapshot.schema.jsonValue(), "files": list(snapshot.files),
            "touched": None if snapshot.touched is None else sorted(snapshot.touched), "batches": snapshot.batches})
        staged, final = self._path(f"_versions/.{uuid.uuid4().hex}"), self._path(f"_versions/{snapshot.version:012d}.json")
        stream = self._fs.create(staged, False)
        try:
            stream.write(bytearray(body.encode()))
        finally:
            stream.close()
        jvm = self.spark._jvm
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        never = self.spark.sparkContext._gateway.new_array(rename, 1)
        never[0] = rename.NONE
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            files.rename(staged, final, never)
            return True
        except Exception as error:
            if not self._fs.exists(final):
                raise error
            self._fs.delete(staged, False)
            return False

    # ---- reading ----

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.snapshot(version))

    def _rows(self, snapshot: Snapshot, files: list[dict] | None = None) -> DataFrame:
        files = snapshot.files if files is None else files
        if not files:
            return self.spark.createDataFrame([], snapshot.schema or T.StructType())
        # The stored schema keeps the type of partition values: a country called "1" must not turn into a number.
        schema = T.StructType([*snapshot.schema.fields, T.StructField(COMMIT, T.StringType())])
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/data/{f['file']}" for f in files]).select(*snapshot.schema.names)

    # ---- writing ----

    def _write(self, df: DataFrame, parts: DataFrame | None = None) -> list[dict]:
        """Data files that no version names yet."""
        commit = uuid.uuid4().hex[:16]
        root = f"data/{COMMIT}={commit}"
        placed = parts if parts is not None else df.hint("rebalance", *self.partition_by) if self.partition_by else df
        if self.sort_by:
            placed = placed.sortWithinPartitions(*self.partition_by, *self.sort_by)
        writer = placed.write.option("maxRecordsPerFile", self.max_rows)
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(f"{self.path}/{root}")
        found, listed = [], self._fs.listFiles(self._path(root), True)
        top = self._fs.makeQualified(self._path("data")).toString()
        while listed.hasNext():
            status = listed.next()
            name = status.getPath().toString().removeprefix(top + "/")
            if name.rsplit("/", 1)[1].startswith("part-"):
                folder = name.split("/", 1)[1].rpartition("/")[0]
                found.append({"file": name, "folder": folder, "bytes": status.getLen()})
        if self.index_key and found:
            keyindex.write(self.spark.read.option("basePath", f"{self.path}/data").parquet(f"{self.path}/{root}"),
                           self.index_key, f"{self.path}/_index/{COMMIT}={commit}")
        return found

    def _discard(self, files: list[dict]) -> None:
        for commit in {f["file"].split("/", 1)[0] for f in files}:
            for root in ("data", "_index"):
                self._fs.delete(self._path(f"{root}/{commit}"), True)

    def commit(self, base: Snapshot, change: Change) -> Snapshot:
        """Put ``change``, made from ``base``, on top of the newest version or raise :class:`Conflict`."""
        while True:
            latest = self.snapshot()
            for version in range(base.version + 1, latest.version + 1):
                later = self.snapshot(version)
                touched = later.touched
                if later.operation == "compact":        # moved rows only
                    continue
                if change.read is None or touched is None and change.read or touched and touched & change.read:
                    raise Conflict(f"{change.operation}: version {version} changed what it was made from")
            live = {f["file"] for f in latest.files}
            if change.removed is not None and not change.removed <= live:
                raise Conflict(f"{change.operation}: files to be replaced are gone")
            gone = live if change.removed is None else change.removed
            schema = change.schema
            if latest.schema is not None and change.removed is not None:
                schema = latest.schema          # columns go by name, in whatever order
                if sorted(map(repr, schema)) != sorted(map(repr, change.schema)):
                    raise ValueError(f"{change.operation}: {change.schema.simpleString()} does not fit {schema.simpleString()}")
            batches = dict(latest.batches)
            if change.batch:
                batches[change.batch[0]] = max(change.batch[1], batches.get(change.batch[0], -1))
            touched = None if change.removed is None else frozenset(
                f["folder"] for f in (*change.added, *(f for f in latest.files if f["file"] in gone)))
            new = Snapshot(latest.version + 1, schema, (*(f for f in latest.files if f["file"] not in gone), *change.added),
                           touched, batches, change.operation)
            if self._put(new):
                return new

    def begin(self, make: Callable[[Snapshot], Change]) -> Transaction:
        return Transaction(self, make)

    def overwrite(self, df: DataFrame) -> Snapshot:
        return self.begin(lambda base: Change("overwrite", self._write(df), _nullable(df.schema), removed=None)).commit()

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None) -> Snapshot:
        """Add rows. A ``batch`` (stream, number) that was added before adds nothing."""
        if batch and self.snapshot().batches.get(batch[0], -1) >= batch[1]:
            return self.snapshot()
        return self.begin(lambda base: Change("append", self._write(df), _nullable(df.schema), batch=batch)).commit()

    def upserting(self, df: DataFrame, key: list[str]) -> Transaction:
        """Rows replace stored rows of equal key (null equals null); partition columns are part of the key. Only the folders that
        hold new rows are read and written anew."""
        parts = list(self.partition_by)
        # Spark stores an empty partition value as null.
        fresh = checkpointed(df.withColumns({c: F.nullif(c, F.lit("")) for c in parts if isinstance(df.schema[c].dataType, T.StringType)}))

        def make(base: Snapshot) -> Change:
            if not base.files:
                return Change("upsert", self._write(fresh), _nullable(df.schema), read=None)
            touched = {self._folder(row) for row in fresh.select(*[F.col(c).cast("string") for c in parts]).distinct().toLocalIterator()} if parts else {""}
            old = [f for f in base.files if f["folder"] in touched]
            stored = self._rows(base, old)
            new = fresh.select(*[F.col(c).alias(f"new_{c}") for c in key])
            same = reduce(lambda a, b: a & b, [stored[c].eqNullSafe(new[f"new_{c}"]) for c in key])
            merged = fresh.unionByName(stored.join(new, same, "left_anti"))
            return Change("upsert", self._write(merged), _nullable(df.schema), frozenset(f["file"] for f in old), frozenset(touched))

        return self.begin(make)

    def upsert(self, df: DataFrame, key: list[str]) -> Snapshot:
        return self.upserting(df, key).commit()

    def _folder(self, row) -> str:
        name = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        return "/".join(name(c, row[c]) for c in self.partition_by)

    def inserting(self, df: DataFrame, order: list | None = None, batch: tuple[str, int] | None = None) -> Transaction:
        """Rows whose ``index_key`` is not stored yet, one per key; stored rows stay. Rows without a key go."""
        key = self.index_key
        order = order or [F.col(c) for c in sorted(df.columns, key=lambda c: (c != "ts", c)) if c != key]
        first = checkpointed(first_per_key(df.where(F.col(key).isNotNull()), [key], order))

        def make(base: Snapshot) -> Change:
            known, written = self.known_keys(first, base), Observation()
            fresh = first if known is None else first.join(known, key, "left_anti").select(*df.columns)
            added = self._write(fresh.observe(written, F.count(F.lit(1)).alias("n")))
            return Change("insert", added, _nullable(df.schema), read=None, batch=batch, rows=written.get["n"])

        return self.begin(make)

    def insert_new(self, df: DataFrame, batch: tuple[str, int] | None = None) -> Snapshot:
        if batch and self.snapshot().batches.get(batch[0], -1) >= batch[1]:
            return self.snapshot()
        return self.inserting(df, batch=batch).commit()

    def known_keys(self, df: DataFrame, base: Snapshot | None = None) -> DataFrame | None:
        """Stored keys that occur in ``df``; only files that can hold them are opened. None if no file can."""
        base = base or self.snapshot()
        commits = sorted({f["file"].split("/", 1)[0] for f in base.files})
        if not commits:
            self.files_opened = 0
            return None
        asked = df.select(self.index_key).distinct()
        possible = keyindex.possible_files(self.spark, [f"{self.path}/_index/{c}" for c in commits], asked, self.index_key)
        files = [f for f in base.files if possible is None or f["file"] in possible]
        self.files_opened = len(files)
        return self._rows(base, files).select(self.index_key).join(asked, self.index_key, "left_semi") if files else None

    # ---- upkeep ----

    def compact(self, target_bytes: int = TARGET_BYTES, tier_files: int = TIER_FILES) -> Snapshot:
        """Merge files of about one size where a folder has ``tier_files`` of them, into files of ``target_bytes``.

        A row is written again about once for each power of ``tier_files`` between the size of its first file and the
        target, and a folder keeps fewer than ``tier_files`` files of a size below it. Rows and their order of commits do not
        change, so nothing that others added meanwhile is in the way; if others replaced a file, theirs stands."""
        base = self.snapshot()
        tiers: dict[tuple[str, int], list[dict]] = defaultdict(list)
        for f in base.files:
            if f["bytes"] < target_bytes / 2:
                tiers[f["folder"], int(math.log(max(f["bytes"], 1 << 12), tier_files))].append(f)
        chosen = [f for files in tiers.values() if len(files) >= tier_files for f in files]
        if not chosen:
            return base
        size: dict[str, int] = defaultdict(int)
        for f in chosen:
            size[f["folder"]] += f["bytes"]
        rows = self._rows(base, chosen)
        added = self._write(rows, self._packed(rows, {folder: -(-b // target_bytes) for folder, b in size.items()}))
        try:
            return self.commit(base, Change("compact", added, base.schema, frozenset(f["file"] for f in chosen)))
        except Conflict:
            self._discard(added)
            return self.snapshot()

    def _packed(self, rows: DataFrame, files: dict[str, int]) -> DataFrame:
        """Exactly so many partitions for each folder, rows dealt evenly, sorted for few open writers."""
        first, total = {}, 0
        for folder, count in files.items():
            first[folder], total = total, total + count
        plan = self.spark.createDataFrame([(k, first[k], n) for k, n in files.items()], "folder string, first int, parts int")
        own = [f"packed_{c}" for c in ("folder", "number", "part")]
        # The path in the metadata is encoded once more than the folder's name.
        name = F.regexp_extract(F.col("_metadata.file_path"), rf"{COMMIT}=[^/]+/(?:(.*)/)?[^/]+$", 1)
        dealt = rows.withColumn(own[0], F.url_decode(F.regexp_replace(name, r"\+", "%2B"))).withColumn(own[1], F.monotonically_increasing_id())
        placed = dealt.join(F.broadcast(plan), dealt[own[0]] == plan["folder"]).withColumn(
            own[2], (F.col("first") + F.pmod(F.col(own[1]), F.col("parts"))).cast("int"))
        return placed.repartitionById(total, own[2]).select(*rows.columns)

    def vacuum(self, keep_versions: int = 10) -> int:
        """Delete version files older than the last ones, and commits that none of these names. Readers and writers that began
        on older versions must have ended. Gives the number of commits deleted."""
        numbers = self.versions()
        kept = [self.snapshot(v) for v in numbers[-keep_versions:]]
        for version in numbers[:-keep_versions]:
            self._fs.delete(self._path(f"_versions/{version:012d}.json"), False)
        named = {f["file"].split("/", 1)[0] for s in kept for f in s.files}
        stored = {s.getPath().getName() for s in self._fs.listStatus(self._path("data"))} if self._fs.exists(self._path("data")) else set()
        self._discard([{"file": f"{commit}/"} for commit in stored - named])
        return len(stored - named)


class Transaction:
    """A change that is prepared at once and committed later; made anew from the newest version when others were faster."""

    def __init__(self, table: SnapshotTable, make: Callable[[Snapshot], Change]):
        self.table, self.make, self.attempts = table, make, 1
        self.base = table.snapshot()
        self.change = make(self.base)

    def commit(self) -> Snapshot:
        while True:
            try:
                return self.table.commit(self.base, self.change)
            except Conflict:
                self.table._discard(self.change.added)
                if self.attempts >= ATTEMPTS:
                    raise
                self.attempts += 1
                self.base = self.table.snapshot()
                self.change = self.make(self.base)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
