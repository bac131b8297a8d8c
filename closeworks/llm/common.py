"""Small helpers that the operators share."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Word separators: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"

# Stands for a null id, so that joins on ids need no null handling; it sorts first.
NULL_ID = -(1 << 63)

#: Bits that tell which rows of a corpus are looked at once more; 1 MB whatever the input is. Where they fill up, more rows are
#: shuffled in vain; no result depends on them.
ROW_BITS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_of(column: str) -> Column:
    """The id as a long; null is the smallest long."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def id_or_null(column: str = "_id") -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column))


def text_of(column: str) -> Column:
    """The text; null is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text as an array, in order; empty for a text without words."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_PATTERN))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. A folder of our own only where the session names none, as in tests."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = getattr(spark, "_closeworks_shared", None)
    if own is None:
        own = spark._closeworks_shared = "file://" + tempfile.mkdtemp(prefix="closeworks-")
    return own


def stored(df: DataFrame) -> DataFrame:
    """The frame written as a table in the shared folder and read again: cuts its lineage and its cost if used twice.

    What was shuffled to make it is of no more use. Spark frees it once the driver has collected its garbage,
    which can take long on an idle driver, so that is asked for.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/closeworks-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    read = spark.read.schema(df.schema).parquet(path)
    read._closeworks_path = path
    return read


def dropped(df: DataFrame) -> None:
    """Remove a table of ``stored``. What was made of it must be stored itself by then."""
    spark = df.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._closeworks_path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def row_place(*columns: str) -> Column:
    """The bit of a row among ``ROW_BITS``."""
    return F.pmod(F.xxhash64(*columns), F.lit(ROW_BITS))


def bitmap(places: DataFrame, size: int) -> bytes:
    """``size`` bits, a power of two from 32,768 on: those of the column ``place`` are set. Made in Spark, bounded by ``size``."""
    parts = (
        places.groupBy(F.floor(F.col("place") / 32768).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg((F.col("place") % 32768).cast("long")).alias("bits")).toPandas()
    )
    out = bytearray(size // 8)
    for part, bits in zip(parts["part"], parts["bits"]):  # size / 32768 at most
        out[part * 4096 : part * 4096 + 4096] = bits
    return bytes(out)


def has_bit(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
