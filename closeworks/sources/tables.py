"""Close tables as parquet directories ``<root>/<layer>/<table>``.

Processed, reporting and audit tables are partitioned by ``closure_period``, so a
report of one period reads that period's files only, and a period is replaced by
overwriting its partition.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closeworks import schemas
from closeworks.config import local_frame
from closeworks.functions.ranks import with_curve

# --- paths and reading ------------------------------------------------------


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{schemas.LAYER[name]}/{name}"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan with the fixed schema: no file is opened to infer one."""
    return spark.read.schema(schemas.schema(name)).parquet(table_path(root, name)).select(
        *schemas.schema(name).fieldNames()
    )


def ensure_tables(spark: SparkSession, root: str, names: list[str] | None = None) -> list[str]:
    """Create the missing tables, empty. Returns the names created."""
    created = []
    for name in names or list(schemas.LAYER):
        if not _exists(spark, table_path(root, name)):
            empty = spark.createDataFrame([], schemas.schema(name))
            _writer(empty, name, "errorifexists", partitioned=False).parquet(table_path(root, name))
            created.append(name)
    return created


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("closure_period string").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def table_summary(spark: SparkSession, root: str) -> DataFrame:
    """One row per table: layer, name, whether it has been created and holds rows."""
    rows = []
    for name, layer in schemas.LAYER.items():
        exists = _exists(spark, table_path(root, name))
        rows.append((layer, name, exists, exists and not read_table(spark, root, name).isEmpty()))
    layout = T.StructType(
        [
            T.StructField("layer", T.StringType()),
            T.StructField("table_name", T.StringType()),
            T.StructField("is_created", T.BooleanType()),
            T.StructField("has_rows", T.BooleanType()),
        ]
    )
    return local_frame(spark, rows, layout)


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


# --- landing ----------------------------------------------------------------


REJECTED = "rejected_record"


def read_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """CSV files with a header in the raw layout without lineage, and ``rejected_record``.

    The header must name the columns of the layout, in their order; a file with another header is an
    error. ``rejected_record`` holds the whole line if a field cannot be read as its type or there are too many
    or too few of them, else it is NULL.
    """
    lineage = {"load_id", "loaded_at", "file_name"}
    given = [T.StructField(f.name, f.dataType) for f in schemas.schema(name).fields if f.name not in lineage]
    return (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .schema(T.StructType([*given, T.StructField(REJECTED, T.StringType())]))
        .option("enforceSchema", False)
        .csv(path)
    )


def _with_lineage(lines: DataFrame, load_id: str | None, loaded_at: str | None) -> DataFrame:
    return lines.withColumns(
        {
            "load_id": F.lit(load_id or str(uuid.uuid4())),
            "loaded_at": F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp(),
            "file_name": F.col("_metadata.file_path"),
        }
    )


def ingest_csv(
    spark: SparkSession, path: str, name: str, load_id: str | None = None, loaded_at: str | None = None
) -> DataFrame:
    """CSV files to the raw layout, with lineage columns; see ``read_csv``.

    A field that cannot be read as its type is NULL and is then caught by validation; ``rejected_csv`` has the
    text of such lines.
    """
    return _with_lineage(read_csv(spark, path, name), load_id, loaded_at).select(*schemas.schema(name).fieldNames())


def rejected_csv(
    spark: SparkSession, path: str, name: str, load_id: str | None = None, loaded_at: str | None = None
) -> DataFrame:
    """The lines that ``ingest_csv`` could not read in full: their text, how many fields were read, load, time and file."""
    given = [f for f in schemas.schema(name).fieldNames() if f not in {"load_id", "loaded_at", "file_name"}]
    lines = _with_lineage(read_csv(spark, path, name), load_id, loaded_at)
    known = sum((F.col(c).isNotNull().cast("int") for c in given), F.lit(0))
    return lines.filter(F.col(REJECTED).isNotNull()).select(
        REJECTED, known.alias("fields_read"), "load_id", "loaded_at", "file_name"
    )


# --- writing ----------------------------------------------------------------


def row_id(keys: list[str] | None = None) -> Column:
    """A random id, or one that is the same on every run: a digest of the key columns."""
    if not keys:
        return F.uuid()
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in keys]), 256)


def stamp(df: DataFrame, name: str, at: str | None = None, id_keys: list[str] | None = None) -> DataFrame:
    """Bring a frame to the layout of its table.

    The first column of a layout is the row id and is added when absent, as are
    the time columns ``at`` fills; other missing columns become typed NULLs.
    """
    now = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    filled_at = {"processed_at", "published_at", "approved_at", "calculated_at", "checked_at", "sent_at", "requested_at"}
    if name == "approvals":
        filled_at -= {"approved_at"}
    columns = []
    for i, f in enumerate(schemas.schema(name).fields):
        if f.name in df.columns:
            c = F.col(f.name)
        elif i == 0:
            c = row_id(id_keys)
        elif f.name in filled_at:
            c = now
        else:
            c = F.lit(None)
        columns.append(c.cast(f.dataType).alias(f.name))
    return df.select(*columns)


def audit_rows(spark: SparkSession, rows: list[dict], name: str) -> DataFrame:
    """A few audit rows with the explicit schema of their table; absent fields are NULL."""
    layout = schemas.schema(name)
    return spark.createDataFrame([tuple(r.get(f) for f in layout.fieldNames()) for r in rows], layout)


# Partitions that a write starts from; those of one period are merged or split by size.
WRITE_PARTITIONS = 32


def _spread(df: DataFrame, name: str) -> DataFrame:
    """Bring the rows of a period together.

    Without it every task writes a file for every period it meets. The rebalance splits a period that is large and
    merges those that are small, by the sizes it finds.
    """
    return df.hint("rebalance", WRITE_PARTITIONS, schemas.PARTITION_COLUMN) if schemas.is_partitioned(name) else df


def _writer(df: DataFrame, name: str, mode: str, partitioned: bool = True, spread: bool = True):
    if not (partitioned and schemas.is_partitioned(name)):
        return df.write.mode(mode)
    return (_spread(df, name) if spread else df).write.mode(mode).partitionBy(schemas.PARTITION_COLUMN)


def append(df: DataFrame, root: str, name: str) -> None:
    _writer(df, name, "append").parquet(table_path(root, name))


def overwrite(df: DataFrame, root: str, name: str) -> None:
    """Replace the whole table, with whatever columns ``df`` has."""
    _writer(df, name, "overwrite").option("partitionOverwriteMode", "static").parquet(table_path(root, name))


def replace_periods(df: DataFrame, root: str, name: str, period: str | None = None) -> None:
    """Replace the periods present in ``df`` and leave the others: publishing twice equals publishing once.

    With a ``period`` only its rows are written, and if there are none the period is emptied: publishing
    nothing leaves nothing. The files of a period are swapped when the job commits, so a job that loses
    executors and fails leaves the old period readable.
    """
    if period is not None:
        df = df.filter(F.col(schemas.PARTITION_COLUMN) == period)
        if df.isEmpty():
            _clear_period(df.sparkSession, root, name, period)
            return
    _writer(df, name, "overwrite").option("partitionOverwriteMode", "dynamic").parquet(table_path(root, name))


def replace_period_counted(df: DataFrame, root: str, name: str, period: str, **counts: Column) -> dict[str, int]:
    """``replace_periods`` of one period, and aggregates of the rows written, gathered by the tasks that write them.

    ``rows`` is always among them. The aggregates stand behind the last shuffle: a task of that stage counts once, however
    often it or an earlier stage is run again.
    """
    seen = Observation()
    wanted = _spread(df.filter(F.col(schemas.PARTITION_COLUMN) == period), name)
    watched = wanted.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()])
    _writer(watched, name, "overwrite", spread=False).option("partitionOverwriteMode", "dynamic").parquet(table_path(root, name))
    found = {n: int(v or 0) for n, v in seen.get.items()}
    if not found["rows"]:
        _clear_period(df.sparkSession, root, name, period)
    return found


def _clear_period(spark: SparkSession, root: str, name: str, period: str) -> None:
    """Remove the folder of a period, through the file system that the table lies in."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{table_path(root, name)}/{schemas.PARTITION_COLUMN}={period}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def rewrite(df: DataFrame, root: str, name: str) -> None:
    """Overwrite periods of a table with a frame that was read from the same table.

    Spark cannot overwrite files it is still reading. The frame is cut from them by
    a reliable checkpoint, which survives the loss of executors.
    """
    replace_periods(reliable_checkpoint(df), root, name)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Checkpoint into the folder the cluster names in ``spark.checkpoint.dir``."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Take the folder for checkpoints from the session, which must name one that all executors share."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(shared)


def write_clustered(
    df: DataFrame, root: str, name: str, keys: tuple[str, str] | None = None, files: int | None = None
) -> None:
    """Write along a curve through two keys, so that min/max statistics let readers skip on either key alone.

    Rows are spread by range over the period and their place on the curve; with F files a filter on one key
    meets about the root of F of them. A key that is the period itself is left to its folders, and the other one alone
    orders the rows. ``files`` is the number of ranges; by default Spark sizes them.
    """
    wanted = [schemas.PARTITION_COLUMN] if schemas.is_partitioned(name) else []
    chosen = [k for k in keys or schemas.CLUSTER_KEYS[name] if k not in wanted]
    curved = with_curve(df, chosen, "_curve") if len(chosen) > 1 else df.withColumn("_curve", F.lit(0))
    columns = [*wanted, "_curve", *chosen]
    spread = curved.repartitionByRange(files, *columns) if files else curved.repartitionByRange(*columns)
    _writer(spread.sortWithinPartitions(*columns).drop("_curve"), name, "overwrite", spread=False).option(
        "partitionOverwriteMode", "static"
    ).parquet(table_path(root, name))
