"""Where a key stands among all keys of a frame, by a bounded sample of them and without a sort of all rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sampled_keys(rows: DataFrame, key: Column, hashed: Column, most: int, per_key: int | None = None) -> Column:
    """Keys of ``most`` rows or fewer, sorted, equal ones as often as they are drawn; one value worked out by the query.

    Drawn are the rows with the smallest hashes, which are spread over the ranks whatever the types are. As hashes
    are even, the largest of those drawn tells how many rows there are; with ``per_key`` only so many keys are
    kept that each stands for about that many rows. An empty frame has one NULL instead of keys.
    """
    found = (
        rows.select(hashed.alias("hash"), key.alias("key"))
        .orderBy("hash", "key")
        .limit(most)
        .agg(F.sort_array(F.collect_list(F.struct("hash", "key"))).alias("drawn"))
    )
    if per_key is not None:
        share = F.get("drawn", F.size("drawn") - 1)["hash"].cast("double") / F.lit(2.0**64) + F.lit(0.5)
        seen = F.when(F.size("drawn") < most, F.size("drawn").cast("double")).otherwise(F.lit(float(most)) / share)
        wanted = F.greatest(F.least(F.ceil(seen / per_key), F.lit(most)), F.lit(1)).cast("int")
        found = found.select(F.slice("drawn", F.lit(1), wanted).alias("drawn"))
    return found.select(F.array_sort(F.transform("drawn", lambda x: x["key"]))).scalar()


def place(key: Column, keys: Column, most: int) -> Column:
    """How many of the sorted ``keys`` (``most`` at most) are below ``key``: first by steps of a row of keys, then in the row."""
    row = max(1, math.isqrt(most))
    steps = F.transform(F.sequence(F.lit(1), F.greatest(F.size(keys), F.lit(1)), F.lit(row)), lambda i: F.get(keys, i - 1))
    before = F.greatest(F.size(F.filter(steps, lambda k: k < key)) - 1, F.lit(0)) * row
    return before + F.size(F.filter(F.slice(keys, before + 1, F.lit(row)), lambda k: k < key))


#: Rows drawn to rank the keys of a curve, and bits of a rank on it.
CURVE_SAMPLE = 1024
CURVE_BITS = 10


def with_curve(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add the place of a row on a curve through the ranks of all ``keys``: the bits of the ranks take turns.

    Rows that are near on the curve are near in every key, so a range of it bounds them all. Ranks come from a
    sample, equal values count as often as they occur: a key with few or uneven values still fills all bits. NULL ranks first.
    """
    boxed = [F.struct(F.col(k).alias("k")) for k in keys]
    drawn = (
        rows.select(F.xxhash64(*keys, F.monotonically_increasing_id()).alias("hash"), *[b.alias(f"k{i}") for i, b in enumerate(boxed)])
        .orderBy("hash")
        .limit(CURVE_SAMPLE)
        .agg(F.struct(*[F.array_sort(F.collect_list(f"k{i}")).alias(f"k{i}") for i in range(len(keys))]).alias("drawn"))
        .scalar()
    )
    drawn_rows = rows.withColumn("_drawn", drawn)
    out = F.lit(0).cast("long")
    for i, key in enumerate(boxed):
        known = F.col(f"_drawn.k{i}")
        below = place(key, known, CURVE_SAMPLE)
        rank = F.floor(below * (1 << CURVE_BITS) / F.greatest(F.size(known), F.lit(1))).cast("long")
        drawn_rows = drawn_rows.withColumn(f"_rank{i}", F.least(rank, F.lit((1 << CURVE_BITS) - 1)))
        for bit in range(CURVE_BITS):
            at = bit * len(keys) + len(keys) - 1 - i
            out = out.bitwiseOR(F.shiftleft(F.shiftright(f"_rank{i}", bit).bitwiseAND(F.lit(1)), at))
    return drawn_rows.withColumn(name, out).select(*rows.columns, name)
