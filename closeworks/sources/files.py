"""Changing some files of a table and leaving the others as they are: compaction, updates, tagged appends.

New files are written beside the table's own, under a folder that readers skip. A plan of the swap (old files to
remove, new files to move in) is written last; from then on the swap is decided. ``recover`` finishes a swap whose driver was
lost after that point and drops one that was lost before it. One writer at a time may change a table; a reader that
lists a folder during its swap can miss the rows on the move.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closeworks import schemas
from closeworks.sources import tables

#: Size that files are merged to, and the share of it from which a file stays as it is.
TARGET_BYTES = 128 << 20
FULL_SHARE = 0.75

_SWAP = "_swap-"
_GROUP = "_file_group"


@dataclass(frozen=True)
class DataFile:
    """A file by its folder below the table ("" for tables without partitions), name, place and size."""

    folder: str
    name: str
    path: str
    size: int


# --- files ------------------------------------------------------------------


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def list_files(spark: SparkSession, path: str) -> list[DataFile]:
    """The data files of a table. Spark lists them; none is opened."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
        .select("path", "length").collect()
    )
    fs, root = _file_system(spark, path)
    prefix = fs.makeQualified(root).toString().rstrip("/") + "/"
    found = []
    for full, size in listed:
        folder, _, name = full[len(prefix) :].rpartition("/")
        if not any(part.startswith("_") and "=" not in part for part in folder.split("/")):
            found.append(DataFile(folder, name, full, size))
    return sorted(found, key=lambda f: (f.folder, f.name))


def _period_of(folder: str) -> str | None:
    value = folder.partition("=")[2]
    return None if value in ("", "__HIVE_DEFAULT_PARTITION__") else value


# --- swaps ------------------------------------------------------------------


def _swap(spark: SparkSession, path: str, stage: str, remove: list[str], moves: list[tuple[str, str]]) -> None:
    """Decide a swap by its plan, carry it out, and remove what is left of it."""
    rows = [(x, None, None) for x in remove] + [(None, a, b) for a, b in moves]
    plan = spark.createDataFrame(rows, "remove string, source string, target string")
    plan.coalesce(1).write.json(f"{stage}/plan")
    _carry_out(spark, rows)
    fs, target = _file_system(spark, stage)
    fs.delete(target, True)


def _carry_out(spark: SparkSession, rows: Sequence[tuple]) -> None:
    """May be done again from the start: removed files stay removed, moved files are not moved twice."""
    for remove, _, _ in rows:
        if remove is not None:
            fs, target = _file_system(spark, remove)
            fs.delete(target, False)
    for _, source, target in rows:
        if source is not None:
            fs, old = _file_system(spark, source)
            if fs.exists(old):
                new = _path(spark, target)
                fs.mkdirs(new.getParent())
                if not fs.rename(old, new):
                    raise OSError(f"{source} could not be moved to {target}")


def recover(spark: SparkSession, path: str) -> int:
    """Finish or drop the swaps that were interrupted. Returns how many there were."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return 0
    found = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(_SWAP)]
    for stage in found:
        plan = f"{stage.toString()}/plan"
        if fs.exists(_path(spark, f"{plan}/_SUCCESS")):
            layout = "remove string, source string, target string"
            _carry_out(spark, [tuple(r) for r in spark.read.schema(layout).json(plan).collect()])
        fs.delete(stage, True)
    return len(found)


def _stage(path: str) -> str:
    return f"{path.rstrip('/')}/{_SWAP}{uuid.uuid4().hex}"


def rewrite_files(
    spark: SparkSession,
    root: str,
    name: str,
    groups: list[list[DataFile]],
    change: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replace each group of files, all of one folder, by one file with their rows, changed by ``change``.

    Only these files are read. ``change`` must keep further columns and may drop rows; a group without rows leaves no file.
    """
    if not groups:
        return
    path, layout = tables.table_path(root, name), schemas.schema(name)
    partitioned = schemas.is_partitioned(name)
    chosen = spark.createDataFrame(
        [(_period_of(f.folder), f.name, i) for i, g in enumerate(groups) for f in g],
        f"_period string, _name string, {_GROUP} int",
    )
    rows = spark.read.schema(layout).option("basePath", path).parquet(*[f.path for g in groups for f in g])
    rows = rows.select(*layout.fieldNames(), F.col("_metadata.file_name").alias("_own_name"))
    same = F.col("_own_name") == F.col("_name")
    if partitioned:
        same &= F.col(schemas.PARTITION_COLUMN).eqNullSafe(F.col("_period"))
    marked = rows.join(chosen, same).drop("_own_name", "_name", "_period")
    marked = change(marked) if change else marked
    order = [k for k in schemas.CLUSTER_KEYS.get(name, ()) if k != schemas.PARTITION_COLUMN]
    folders = [*([schemas.PARTITION_COLUMN] if partitioned else []), _GROUP]
    stage = _stage(path)
    (
        marked.select(*layout.fieldNames(), _GROUP)
        .repartition(len(groups), _GROUP).sortWithinPartitions(*folders, *order)
        .write.partitionBy(*folders).parquet(f"{stage}/data")
    )
    batch, moves = uuid.uuid4().hex[:12], []
    for i, f in enumerate(list_files(spark, f"{stage}/data")):
        own, _, group = f.folder.rpartition("/")
        target = "/".join(x for x in (path, own, f"part-{batch}-{group.partition('=')[2]}-{i}.parquet") if x)
        moves.append((f.path, target))
    _swap(spark, path, stage, [f.path for g in groups for f in g], moves)


# --- compaction -------------------------------------------------------------


def compaction_groups(files: list[DataFile], target: int, full: float = FULL_SHARE) -> list[list[DataFile]]:
    """Files of a folder that together make one of about ``target`` bytes; a file of ``full`` of that stays alone.

    Files are taken in the order of their names. Only groups of two files or more are worth a rewrite.
    """
    groups: list[list[DataFile]] = []
    folder, size = None, 0
    for f in files:
        if f.size >= full * target:
            continue
        if f.folder != folder or size + f.size > target:
            groups.append([])
            folder, size = f.folder, 0
        groups[-1].append(f)
        size += f.size
    return [g for g in groups if len(g) > 1]


def compact(spark: SparkSession, root: str, name: str, target: int = TARGET_BYTES, period: str | None = None) -> int:
    """Merge the small files of a table, or of one period, and leave the others. Returns how many files were merged.

    Afterwards each folder has at most one file smaller than about half the target for each group that was full.
    """
    path = tables.table_path(root, name)
    recover(spark, path)
    files = list_files(spark, path)
    if period is not None:
        files = [f for f in files if _period_of(f.folder) == period]
    groups = compaction_groups(files, target)
    rewrite_files(spark, root, name, groups)
    return sum(map(len, groups))


# --- updates ----------------------------------------------------------------


def update_where(
    spark: SparkSession,
    root: str,
    name: str,
    matches: Column,
    change: Callable[[DataFrame], DataFrame],
    period: str | None = None,
) -> int:
    """Apply ``change`` to the files that hold a row for which ``matches`` is true. Returns how many were rewritten.

    The rows are found by a scan of the columns of ``matches`` alone. ``change`` sees all rows of those files, so it must leave
    alone what does not match. Running it again finds nothing to do if the change makes ``matches`` false.
    """
    path = tables.table_path(root, name)
    recover(spark, path)
    rows = tables.read_table(spark, root, name)
    if period is not None:
        rows = rows.filter(F.col(schemas.PARTITION_COLUMN) == period)
    folder = F.col(schemas.PARTITION_COLUMN) if schemas.is_partitioned(name) else F.lit(None).cast("string")
    hit = rows.filter(matches).select(folder.alias("period"), F.col("_metadata.file_name").alias("name")).distinct()
    wanted = {tuple(r) for r in hit.collect()}  # at most one row per file
    if not wanted:
        return 0
    files = [f for f in list_files(spark, path) if (_period_of(f.folder), f.name) in wanted]
    rewrite_files(spark, root, name, [[f] for f in files], change)
    return len(files)


# --- tagged appends ---------------------------------------------------------


def append_once(df: DataFrame, path: str, tag: str) -> None:
    """Append ``df`` under a tag; doing so again with the tag replaces what it appended before, so a repeat adds nothing."""
    spark = df.sparkSession
    stage = _stage(path)
    df.write.parquet(f"{stage}/data")
    # The stage lies in the table's folder, so that exists now.
    old = [f.path for f in list_files(spark, path) if f.name.startswith(f"{tag}-")]
    batch = uuid.uuid4().hex[:12]
    new = list_files(spark, f"{stage}/data")
    _swap(spark, path, stage, old, [(f.path, f"{path.rstrip('/')}/{tag}-{batch}-{i}.parquet") for i, f in enumerate(new)])
