"""Incremental landing: each CSV file of a folder is loaded once, whenever the landing runs and however it ends.

Spark's file stream remembers in its checkpoint which files each batch has; a batch that was lost is run again with the
same files and the same number. Batches are appended under that number, and a second append under it replaces the
first, so neither a file nor a line is ever loaded twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closeworks import schemas
from closeworks.sources import files, tables

LINEAGE = ("load_id", "loaded_at", "file_name")


@dataclass(frozen=True)
class Landed:
    """What one run has loaded: batches, lines, and lines among them that could not be read in full."""

    batches: int
    lines: int
    rejected: int


def rejected_path(root: str, name: str) -> str:
    """The table of rejected lines stands beside the raw table."""
    return f"{tables.table_path(root, name)}_rejected"


def read_rejected(spark: SparkSession, root: str, name: str) -> DataFrame:
    layout = f"{tables.REJECTED} string, fields_read int, load_id string, loaded_at timestamp, file_name string"
    return spark.read.schema(layout).parquet(rejected_path(root, name))


def _stream(spark: SparkSession, source: str, name: str, files_per_batch: int) -> DataFrame:
    given = [T.StructField(f.name, f.dataType) for f in schemas.schema(name).fields if f.name not in LINEAGE]
    return (
        spark.readStream.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", tables.REJECTED)
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .schema(T.StructType([*given, T.StructField(tables.REJECTED, T.StringType())]))
        .csv(source)
        .withColumn("file_name", F.col("_metadata.file_path"))
    )


def land_csv(
    spark: SparkSession,
    source: str,
    root: str,
    name: str,
    checkpoint: str,
    load: str = "landing",
    loaded_at: str | None = None,
    files_per_batch: int = 1000,
) -> Landed:
    """Load the files of ``source`` (a folder or a pattern) that are new since the last run, then stop.

    Lines go to the raw table with ``load_id`` = load and number of the batch; those that could not be read in full go there
    with NULL for what was not read, and as text to the table of rejected lines. ``checkpoint`` is a folder
    of this landing alone, shared by the cluster. A file with another header than the layout's ends the run with an error;
    the next run tries its batch again. A file that is changed after it was loaded is not loaded again.
    """
    spark_schema = schemas.schema(name)
    target, refused = tables.table_path(root, name), rejected_path(root, name)
    tables.ensure_tables(spark, root, [name])
    for path in (target, refused):
        files.recover(spark, path)
    done: dict[int, tuple[int, int]] = {}

    def load_batch(batch: DataFrame, number: int) -> None:
        tag = f"{load}-{number:09d}"
        stamped = batch.withColumns(
            {"load_id": F.lit(tag), "loaded_at": F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()}
        )
        seen = Observation()
        counted = stamped.observe(
            seen, F.count(F.lit(1)).alias("lines"), F.count_if(F.col(tables.REJECTED).isNotNull()).alias("rejected")
        )
        files.append_once(counted.select(*spark_schema.fieldNames()), target, tag)
        lines, rejected = seen.get["lines"], seen.get["rejected"]
        if rejected:
            known = sum((F.col(f).isNotNull().cast("int") for f in spark_schema.fieldNames() if f not in LINEAGE), F.lit(0))
            bad = stamped.filter(F.col(tables.REJECTED).isNotNull())
            files.append_once(bad.select(tables.REJECTED, known.alias("fields_read"), *LINEAGE), refused, tag)
        done[number] = (lines, rejected)

    query = (
        _stream(spark, source, name, files_per_batch)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return Landed(len(done), sum(a for a, _ in done.values()), sum(b for _, b in done.values()))
