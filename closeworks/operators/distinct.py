"""Exact distinct counts that can be added up over periods: bitmaps over dictionary codes.

Every value of a column has a code, a whole number that never changes. The values of a group are a set of bits, cut into
buckets of 32,768 codes; sets of several periods are joined by OR, and their bits are counted. What is kept of a
group is bounded by the dictionary, not by the rows, and a new period adds its own sets only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closeworks.functions.exprs import amount_of, unit_sum

#: Parts in which new values are numbered, each in a task of its own.
NUMBERED_IN = 256


def new_codes(values: DataFrame, known: DataFrame) -> DataFrame:
    """``value, code`` for the values that ``known`` has not. NULL has no code.

    Values are dealt to parts by their hash and numbered there, after the last number of the part; part and
    number make the code. Hashes are even, so codes stay dense, and no task numbers all values.
    """
    part = F.pmod(F.xxhash64("value"), F.lit(NUMBERED_IN))
    taken = known.groupBy(part.alias("part")).agg(F.max(F.floor((F.col("code") - 1) / NUMBERED_IN)).alias("last"))
    fresh = values.filter(F.col("value").isNotNull()).distinct().join(known.select("value"), "value", "left_anti")
    place = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    return (
        fresh.withColumn("part", part).withColumn("place", place).join(taken, "part", "left")
        .select("value", ((F.coalesce("last", F.lit(-1)) + F.col("place")) * NUMBERED_IN + F.col("part") + 1).cast("long").alias("code"))
    )


def value_sets(rows: DataFrame, keys: list[str], column: str, dictionary: DataFrame) -> DataFrame:
    """``keys, column_name, bucket, bits``: which values of a column each group has.

    Rows are combined per group and value by hash first; only those combinations meet the dictionary and the bitmaps.
    """
    combos = rows.filter(F.col(column).isNotNull()).select(*keys, F.col(column).cast("string").alias("value")).distinct()
    return (
        combos.join(dictionary, "value")
        .groupBy(*keys, F.bitmap_bucket_number("code").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits"))
        .select(*keys, F.lit(column).alias("column_name"), "bucket", "bits")
    )


def count_values(sets: DataFrame, keys: list[str], column: str, alias: str) -> DataFrame:
    """Distinct values per ``keys``, whatever further keys the sets have."""
    joined = sets.filter(F.col("column_name") == column).groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return joined.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(alias))


SEGMENT_KEYS = ["closure_period", "bu_code", "segment_type"]


def segment_sums(segments: DataFrame) -> DataFrame:
    """Rows and amounts of the valid segments per ``SEGMENT_KEYS``, in parts that can be added up."""
    return (
        segments.filter(F.col("is_validated"))
        .groupBy(*SEGMENT_KEYS)
        .agg(
            F.count("*").alias("_rows"),
            F.count("usd_amount").alias("_amounts"),
            unit_sum("usd_amount").cast("decimal(38,0)").alias("_sum"),
        )
    )


def segments_by_type(sums: DataFrame, sets: DataFrame) -> DataFrame:
    """The report of that name from stored sums and sets of any number of periods."""
    values = count_values(sets, ["segment_type"], "segment_value", "unique_values")
    totals = sums.groupBy("segment_type").agg(
        F.sum("_rows").alias("record_count"),
        amount_of(F.sum("_sum")).alias("total_usd"),
        F.try_divide(amount_of(F.sum("_sum")), F.sum("_amounts")).alias("avg_usd"),
    )
    found = totals.alias("t").join(values.alias("v"), F.col("t.segment_type").eqNullSafe(F.col("v.segment_type")), "left")
    return found.select(
        "t.segment_type", "record_count", F.coalesce("unique_values", F.lit(0)).alias("unique_values"), "total_usd", "avg_usd"
    ).orderBy("segment_type")


def segments_by_bu(sums: DataFrame, sets: DataFrame) -> DataFrame:
    """The report of that name from stored sums and sets of any number of periods."""
    totals = sums.groupBy("bu_code").agg(
        F.sum("_rows").alias("record_count"),
        F.countDistinct("segment_type").alias("segment_types"),
        amount_of(F.sum("_sum")).alias("total_usd"),
    )
    accounts = count_values(sets, ["bu_code"], "account_code", "accounts")
    found = totals.alias("t").join(accounts.alias("v"), F.col("t.bu_code").eqNullSafe(F.col("v.bu_code")), "left")
    return found.select(
        "t.bu_code", "record_count", "segment_types", F.coalesce("accounts", F.lit(0)).alias("accounts"), "total_usd"
    ).orderBy("bu_code")
