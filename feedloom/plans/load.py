"""Load modes over catalog tables stored as Parquet.

A table without partitions is replaced by writing a new folder and then pointing
the table at it, one catalog change: a failed write leaves the old rows in place.
A merge into a partitioned table rewrites only the partitions the source touches.
"""

from __future__ import annotations

import hashlib
import logging
import uuid
from dataclasses import dataclass, replace
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import lenient_cast
from feedloom.functions.predicates import any_null
from feedloom.operators.checks import LOAD_TYPES
from feedloom.operators.layout import Bucketing, laid_out, parse_layout, with_fields, without_layout
from feedloom.operators.merge import INSERT, UPDATE, merge, repeated_keys, typed
from feedloom.operators.project import quoted
from feedloom.operators.watermark import above_target
from feedloom.session import shared_folder
from feedloom.specs import LoadSpec

log = logging.getLogger(__name__)

OUTCOME = "__outcome"
# Table option that lets an overwrite replace only the partitions it has rows for.
OVERWRITE_MODE = "partitionOverwriteMode"
# Table properties: the folder of the rows, the one it replaced, and the layout.
FOLDER, REPLACED, LAYOUT = "feedloom.folder", "feedloom.replaced", "feedloom.layout"
# Folders beside the rows, which scans pass over: names of loaded batches, and rows of one on their way.
BATCHES, ARRIVING = "_batches", "_arriving"
KEPT_BATCHES = 64  # names that a replaced folder hands on, the newest
# Fixed value: how a partition folder names NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class LoadResult:
    """Row counts of one load."""

    target: str
    before: int
    after: int
    inserted: int
    updated: int = 0
    deleted: int = 0


def load(
    spark: SparkSession,
    spec: LoadSpec,
    data: DataFrame | None,
    root: str,
    schema: T.StructType | None = None,
    unique: bool = False,
    batch: str | None = None,
) -> LoadResult:
    """Load ``data`` into ``spec.target``, a catalog table kept below ``root``.

    With a layout, given when the table is created, merges open and rewrite only the buckets that
    the source's keys fall into; ``table_rows`` leaves its columns out. The rows of ``spec.query`` replace ``data`` when it is given. ``schema`` is what
    a missing table is created with; for a query all its columns are text then. ``unique`` says the keys of ``data`` are known
    to be unique, which saves the check a merge needs.

    With a name in ``batch`` the rows are loaded once: a load of a name that is known adds nothing.
    The name becomes known together with the rows, when rows are appended or a folder is replaced, whatever
    else changes the table and wherever a run breaks off. Merging into partitions comes before its
    name; such a merge, when repeated, gives the same rows, but for those with a NULL key.
    """
    mode = spec.mode.strip().lower()
    if mode not in LOAD_TYPES:
        raise ValueError(f"load mode {spec.mode!r} is not one of {', '.join(LOAD_TYPES)}")
    query = spec.custom_query()
    if query:
        data, unique = spark.sql(query), False
        schema = T.StructType([T.StructField(name, T.StringType()) for name in data.columns])
    if data is None:
        raise ValueError("a load needs rows or a custom query")
    exists = spark.catalog.tableExists(spec.target)
    if not exists:
        create_table(spark, spec, schema or data.schema, root)
    spec, layout = _as_partitioned(spark, spec)
    if layout:
        data = laid_out(data, spark.table(spec.target).schema, layout)
        unique_by = {k.lower() for k in spec.keys}
        spec = replace(spec, keys=spec.keys + tuple(b.name for b in layout if b.column.lower() in unique_by))
    before = spark.table(spec.target).count() if exists else 0
    if batch and is_loaded(spark, spec.target, batch):
        return LoadResult(spec.target, before, before, inserted=0)
    if mode in ("full", "bulk"):
        return _replace_all(spark, spec, data, root, before, batch)
    if mode == "append":
        return _append(spark, spec, data, exists, before, batch)
    return _merge(spark, spec, data, root, exists, before, unique, batch)


def _as_partitioned(spark: SparkSession, spec: LoadSpec) -> tuple[LoadSpec, tuple[Bucketing, ...]]:
    """The spec with the partition columns that the table has, those of its layout among them."""
    actual = tuple(c.name for c in spark.catalog.listColumns(spec.target) if c.isPartition)
    layout = table_layout(spark, spec.target)
    asked = parse_layout(spec.layout)
    if asked and asked != layout:
        raise ValueError(f"{spec.target} is laid out by {[str(b) for b in layout]}, not by {list(spec.layout)}")
    plain = [p.lower() for p in actual if p not in {b.name for b in layout}]
    if spec.partition_by and [p.lower() for p in spec.partition_by] != plain:
        raise ValueError(f"{spec.target} is partitioned by {actual}, not by {spec.partition_by}")
    return replace(spec, partition_by=actual), layout


def table_layout(spark: SparkSession, table: str) -> tuple[Bucketing, ...]:
    """The layout a table was created with."""
    known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return parse_layout(known.get(LAYOUT))


def table_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table without the columns of its layout."""
    return without_layout(spark.table(table), table_layout(spark, table))


def create_table(spark: SparkSession, spec: LoadSpec, schema: T.StructType, root: str) -> None:
    """An empty external Parquet table; partition columns come last, as Spark stores them."""
    layout = parse_layout(spec.layout)
    schema = with_fields(schema, layout)
    spec = replace(spec, partition_by=spec.partition_by + tuple(b.name for b in layout))
    parts = {p.lower() for p in spec.partition_by}
    ordered = sorted(schema.fields, key=lambda f: f.name.lower() in parts)
    _declare(spark, spec, T.StructType(ordered), _new_folder(spec.target, root))


def _declare(
    spark: SparkSession, spec: LoadSpec, schema: T.StructType, folder: str, replaced: str = ""
) -> None:
    """Declare the table over a folder, in which its rows are or will be."""
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    by = ""
    if spec.partition_by:
        names = ", ".join(quoted(p) for p in spec.partition_by)
        by = f"OPTIONS ({OVERWRITE_MODE} 'dynamic') PARTITIONED BY ({names})"
    kept = f"TBLPROPERTIES ('{FOLDER}' = '{folder}', '{REPLACED}' = '{replaced}', '{LAYOUT}' = '{'; '.join(spec.layout)}')"
    spark.sql(f"CREATE TABLE {spec.target} ({columns}) USING parquet {by} LOCATION '{folder}' {kept}")


def _new_folder(table: str, root: str) -> str:
    return f"{root.rstrip('/')}/{table.replace('.', '/')}/{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of a file system that Spark reaches; failure only warns."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception as error:
        log.warning("folder %s was not removed: %s", folder, error)


def _overwrites_by_partition(spark: SparkSession, table: str) -> bool:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Storage Properties'")
    return any(OVERWRITE_MODE.lower() in row["data_type"].lower() for row in described.collect())


def conform(data: DataFrame, target: DataFrame) -> DataFrame:
    """The target's columns in its order; columns the rows lack become NULL."""
    given = {f.name.lower(): f for f in data.schema.fields}
    columns = []
    for field in target.schema.fields:
        actual = given.get(field.name.lower())
        if actual is None:
            value = F.lit(None).cast(field.dataType)
        elif actual.dataType == field.dataType:
            value = F.col(quoted(actual.name))
        else:
            value = lenient_cast(F.col(quoted(actual.name)), actual.dataType, field.dataType.simpleString())
        columns.append(value.alias(field.name))
    return data.select(*columns)


class _Folder:
    """Files of a folder that Spark reaches, as far as loads move them about."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.of = spark._jvm.org.apache.hadoop.fs.Path
        self.path = self.of(path)
        self.files = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.of(self.path, name)

    def names(self, below: str) -> list[str]:
        """Names of a subfolder's files, the oldest first; none if it is not there."""
        at = self._at(below)
        found = self.files.listStatus(at) if self.files.exists(at) else []
        return [p.getPath().getName() for p in sorted(found, key=lambda p: (p.getModificationTime(), p.getPath().getName()))]

    def below(self, name: str) -> list[str]:
        """Paths of all data files below a subfolder, relative to it."""
        root, out = self.files.makeQualified(self._at(name)).toString().rstrip("/"), []
        walk = self.files.listFiles(self._at(name), True)
        while walk.hasNext():
            path = walk.next().getPath()
            if path.getName()[0] not in "._":
                out.append(path.toString()[len(root) + 1 :])
        return sorted(out)

    def has(self, name: str) -> bool:
        return self.files.exists(self._at(name))

    def touch(self, name: str) -> None:
        self.files.create(self._at(name), True).close()

    def move(self, name: str, to: str) -> None:
        target = self._at(to)
        self.files.mkdirs(target.getParent())
        if not self.files.rename(self._at(name), target):
            raise OSError(f"{name} was not moved to {to} in {self.path}")

    def remove(self, name: str) -> None:
        self.files.delete(self._at(name), True)


def _table_folder(spark: SparkSession, table: str) -> _Folder:
    known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return _Folder(spark, known[FOLDER])


def _file_name(batch: str) -> str:
    return hashlib.sha256(batch.encode()).hexdigest()[:40]


def is_loaded(spark: SparkSession, table: str, batch: str) -> bool:
    """Whether the table holds the rows of a batch of that name."""
    return _table_folder(spark, table).has(f"{BATCHES}/{_file_name(batch)}")


def _replace_all(spark: SparkSession, spec: LoadSpec, data: DataFrame, root: str, before: int, batch: str | None) -> LoadResult:
    publish(spark, spec, conform(data, spark.table(spec.target)), root, batch)
    written = spark.table(spec.target).count()
    return LoadResult(spec.target, before, written, inserted=written, deleted=before)


def publish(spark: SparkSession, spec: LoadSpec, rows: DataFrame, root: str, batch: str | None = None) -> None:
    """Write the rows to a new folder, then make it the table's content.

    The folder replaced stays for those still reading it; the one before it goes. The names of
    loaded batches lie in the folder, so that they and the rows become the table's at once.
    """
    folder = _new_folder(spec.target, root)
    known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {spec.target}").collect()}
    old, older = known.get(FOLDER, ""), known.get(REPLACED, "")
    if spec.partition_by:
        _by_partition(rows, spec).write.mode("overwrite").partitionBy(*spec.partition_by).parquet(folder)
        _repoint(spark, spec, folder)
    else:
        rows.write.mode("overwrite").parquet(folder)
    names = [*_Folder(spark, old).names(BATCHES)[-KEPT_BATCHES:]] if old else []
    for name in [*names, *([_file_name(batch)] if batch else [])]:
        _Folder(spark, folder).touch(f"{BATCHES}/{name}")
    spark.sql(f"ALTER TABLE {spec.target} SET LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {spec.target} SET TBLPROPERTIES ('{FOLDER}' = '{folder}', '{REPLACED}' = '{old}')")
    spark.catalog.refreshTable(spec.target)
    if older and older not in (old, folder):
        remove_folder(spark, older)


def _repoint(spark: SparkSession, spec: LoadSpec, folder: str) -> None:
    """Point every partition of the table at its part of a folder, and drop those it lacks.

    The table stays declared, with all its properties. A partition shows its old rows until it is
    pointed at the new ones, and the partitions that are to go are dropped last, so that a run that
    breaks off loses no rows and the next one puts things right.
    """
    shown = lambda table: {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    before, written = shown(spec.target), _partition_folders(spark, folder, len(spec.partition_by))
    names = {}
    for name in written:
        clause = _partition_clause(name)
        names[clause] = f"{folder}/{name}"
    old = {_partition_clause(name) for name in before}
    for clause in sorted(names.keys() & old):
        spark.sql(f"ALTER TABLE {spec.target} PARTITION ({clause}) SET LOCATION {_literal(names[clause])}")
    fresh = [f"PARTITION ({c}) LOCATION {_literal(names[c])}" for c in sorted(names.keys() - old)]
    for i in range(0, len(fresh), 500):
        spark.sql(f"ALTER TABLE {spec.target} ADD IF NOT EXISTS {' '.join(fresh[i : i + 500])}")
    for clause in sorted(old - names.keys()):
        spark.sql(f"ALTER TABLE {spec.target} DROP IF EXISTS PARTITION ({clause})")


def _partition_folders(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """The partition folders below a folder, as Spark wrote them."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "/".join(["*=*"] * depth)))
    paths = [found[i].getPath() for i in range(len(found))]
    out = []
    for path in paths:
        parts = []
        for _ in range(depth):
            parts.append(path.getName())
            path = path.getParent()
        out.append("/".join(reversed(parts)))
    return out


def _partition_clause(name: str) -> str:
    """``a=1/b=x`` as the inside of a PARTITION clause."""
    parts = []
    for part in name.split("/"):
        column, _, value = part.partition("=")
        text = "null" if value == NULL_PARTITION else _literal(unquote(value))
        parts.append(f"{quoted(unquote(column))} = {text}")
    return ", ".join(parts)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _by_partition(rows: DataFrame, spec: LoadSpec) -> DataFrame:
    """Gather rows by partition, so that few files are written; large ones are split again."""
    return rows.hint("rebalance", *[F.col(quoted(p)) for p in spec.partition_by])


def _append(spark: SparkSession, spec: LoadSpec, data: DataFrame, exists: bool, before: int, batch: str | None) -> LoadResult:
    target = spark.table(spec.target)
    fresh = data
    if spec.watermark and exists:
        fresh = above_target(data, target, spec.watermark)
    rows = conform(fresh, target)
    if spec.partition_by:
        rows = _by_partition(rows, spec)
    if batch:
        _append_once(spark, spec, rows, _file_name(batch))
    else:
        rows.write.insertInto(spec.target)
    after = spark.table(spec.target).count()
    return LoadResult(spec.target, before, after, inserted=after - before)


def _append_once(spark: SparkSession, spec: LoadSpec, rows: DataFrame, name: str) -> None:
    """Add rows under names that a repeated load of the batch would give them again.

    The rows are written whole beside the table's, then moved into place file by file, and last the
    batch's name is put down. A load that breaks off in between is gone on with where it stopped: what was
    written is not written again, and what was moved is no longer there to be moved.
    """
    folder = _table_folder(spark, spec.target)
    arriving = f"{ARRIVING}/{name}"
    if not folder.has(f"{arriving}/_SUCCESS"):
        writer = rows.write.mode("overwrite")
        writer = writer.partitionBy(*spec.partition_by) if spec.partition_by else writer
        writer.parquet(f"{folder.path.toString()}/{arriving}")
    for path in folder.below(arriving):
        part, _, file = path.rpartition("/")
        folder.move(f"{arriving}/{path}", f"{part}/{name}-{file}" if part else f"{name}-{file}")
    if spec.partition_by:
        spark.sql(f"MSCK REPAIR TABLE {spec.target} ADD PARTITIONS")
    folder.touch(f"{BATCHES}/{name}")
    folder.remove(arriving)
    spark.catalog.refreshTable(spec.target)


def stage(spark: SparkSession, rows: DataFrame, path: str | None = None) -> DataFrame:
    """Write rows to a shared folder and read them back: computed once, lineage cut."""
    folder = path or shared_folder(spark, "stage")
    rows.write.mode("overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def staging_copy(spark: SparkSession, rows: DataFrame, folder: str, destination: str) -> DataFrame:
    """Keep a Parquet copy of the rows below ``folder`` and go on with that copy.

    When the copy cannot be written the load goes on without it.
    """
    path = f"{folder.rstrip('/')}/staging/{destination.replace('.', '/')}"
    try:
        return stage(spark, rows, path)
    except Exception as error:
        log.warning("staging copy to %s failed: %s", path, error)
        return rows


def _merge(
    spark: SparkSession,
    spec: LoadSpec,
    data: DataFrame,
    root: str,
    exists: bool,
    before: int,
    unique: bool,
    batch: str | None,
) -> LoadResult:
    if not spec.keys:
        raise ValueError("an incremental load needs keys")
    fresh = data
    if spec.watermark and exists:
        fresh = above_target(data, spark.table(spec.target), spec.watermark)
    folder = shared_folder(spark, "stage")
    staged = stage(spark, fresh, folder)
    try:
        if staged.isEmpty():
            return LoadResult(spec.target, before, before, inserted=0)
        return _merge_staged(spark, spec, staged, root, before, unique, batch)
    finally:
        remove_folder(spark, folder)


def _merge_staged(
    spark: SparkSession, spec: LoadSpec, staged: DataFrame, root: str, before: int, unique: bool, batch: str | None
) -> LoadResult:
    target = spark.table(spec.target)
    if not unique and not repeated_keys(staged, spec.keys, staged.count()).isEmpty():
        raise ValueError(f"the source holds several rows for one key of {spec.target}")

    by_key = {p.lower() for p in spec.partition_by} <= {k.lower() for k in spec.keys}
    scoped = bool(spec.partition_by) and by_key and _overwrites_by_partition(spark, spec.target)
    touched = _touched(target, staged, spec.partition_by) if scoped else target
    seen = Observation()
    merged = merge(touched, staged, spec.keys, OUTCOME).observe(
        seen,
        F.count_if(F.col(OUTCOME) == INSERT).alias("inserted"),
        F.count_if(F.col(OUTCOME) == UPDATE).alias("updated"),
    )
    rows = merged.drop(OUTCOME)
    if scoped:
        _by_partition(rows, spec).write.mode("overwrite").insertInto(spec.target)
        if batch:
            _table_folder(spark, spec.target).touch(f"{BATCHES}/{_file_name(batch)}")
    else:
        publish(spark, spec, rows, root, batch)
    counts = seen.get
    return LoadResult(
        spec.target, before, before + counts["inserted"], counts["inserted"], counts["updated"]
    )


def _touched(target: DataFrame, staged: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Target rows in the partitions the source has rows for.

    The source's values are given the target's types first, as the merge does, and
    joined. The values of each partition column, no more than the table will have
    partitions, also become a filter, so that the scan does not open other
    partitions. The partition of NULL values is always kept in: it is rewritten as a
    whole when the source adds to it, and NULL equals nothing in a join.
    """
    parts = [F.col(quoted(c)) for c in columns]
    unknown = any_null(parts)
    given = {f.name.lower(): f for f in staged.schema.fields}
    kinds = {f.name.lower(): f for f in target.schema.fields}
    new = [f"__part_{i}" for i in range(len(columns))]
    used = staged.select(
        *[typed(given[c.lower()], kinds[c.lower()]).alias(n) for c, n in zip(columns, new, strict=True)]
    ).distinct()
    used = used.filter(~any_null([F.col(n) for n in new]))
    found = used.agg(*[F.collect_set(F.col(n).cast("string")).alias(n) for n in new]).first()
    named = reduce(
        Column.__and__,
        [
            part.isin(*[F.lit(v).cast(kinds[c.lower()].dataType) for v in found[n]]) if found[n] else F.lit(False)
            for part, c, n in zip(parts, columns, new, strict=True)
        ],
    )
    same = reduce(Column.__and__, [part == F.col(n) for n, part in zip(new, parts, strict=True)])
    known = target.filter(~unknown & named)
    if len(columns) > 1:
        known = known.join(used, same, "left_semi")
    return known.unionByName(target.filter(unknown))
