"""URL filter by a cascade of Bloom filters.

The listed keys go into the first filter. Its false positives among all keys that the corpus can
ask for go into the second, the listed keys that the second holds by mistake into the third, and
so on until a level has none. For every key of that universe the answer is then exact, and asking
needs no join: the cascade travels to the tasks and its size depends on the list, not on the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import stored

#: Largest size of a whole cascade, which is broadcast. About 30 million listed keys.
MAX_CASCADE_BYTES = 128 << 20
MAX_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    """``path`` is empty or starts with a slash."""

    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass
class Level:
    bits: int
    hashes: int
    words: np.ndarray

    def has(self, low: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Whether the filter holds the keys with these two hashes."""
        found = np.full(len(low), self.bits > 0)
        for i in range(self.hashes):
            at = (low + i * step) % self.bits
            found &= (self.words[at >> 6] >> (at & 63)) & 1 == 1
        return found


def hash_pair(key: Column, level: int) -> Column:
    """Two hashes of 40 bits of a key for one level, as an array; the second is odd."""
    low, step = (F.xxhash64(F.lit(2 * level + i), key).bitwiseAND(F.lit((1 << 40) - 1)) for i in (0, 1))
    return F.array(low, step.bitwiseOR(F.lit(1).cast("long")))


def _has(level: Level):
    """The filter as a function of a column of hash pairs."""

    @F.pandas_udf("boolean")
    def has(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pairs in parts:
            values = np.array(pairs.tolist(), dtype=np.int64).reshape(-1, 2)
            yield pd.Series(level.has(values[:, 0], values[:, 1]))

    return has


def _filter_of(keys: DataFrame, n: int, rate: float, level: int, budget: int) -> Level:
    """A Bloom filter over ``n`` keys: positions are set in Spark, 64 to a word; only the filter comes back."""
    if n == 0:
        return Level(0, 0, np.zeros(0, dtype=np.int64))
    hashes = max(1, round(math.log2(1 / rate)))
    bits = max(64, math.ceil(n * hashes / math.log(2)))
    if bits // 8 > budget:
        raise ValueError(f"{n} keys need {bits // 8} bytes, {budget} are left: split the list and ask part by part")
    low, step = (hash_pair(F.col("key"), level)[i] for i in (0, 1))
    at = [(low + F.lit(i) * step) % F.lit(bits) for i in range(hashes)]
    rows = (
        keys.select(F.explode(F.array(*at)).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(at & 63L))")).alias("set"))
        .toPandas()
    )
    words = np.zeros((bits + 63) // 64, dtype=np.int64)
    words[rows["word"].to_numpy(dtype=np.int64)] = rows["set"].to_numpy(dtype=np.int64)
    return Level(bits, hashes, words)


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_CASCADE_BYTES) -> list[Level]:
    """Levels that tell the keys of ``listed`` from all other keys of ``universe`` without error.

    Both frames have one column ``key``; repeats are fine, nulls are left out, either may be empty. The
    first level has a rate of |listed| / |universe|, the others of one half, which keeps all levels
    together at a few bits per listed key. The sets that are still to be told apart stay in Spark.
    """
    keys = stored(
        listed.select("key", F.lit(True).alias("listed"))
        .unionByName(universe.select("key", F.lit(False).alias("listed")))
        .filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max("listed").alias("listed"))
    )
    sides = {side: keys.filter(F.col("listed") == side).select("key") for side in (True, False)}
    inside, levels, total = True, [], sides[False].count()
    while (n := sides[inside].count()) or not levels:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not come to an end")
        rate = min(0.5, max(n, 1) / (math.sqrt(2) * max(total, 1))) if not levels else 0.5
        spent = sum(x.words.nbytes for x in levels)
        level = _filter_of(sides[inside], n, rate, len(levels), max_bytes - spent)
        levels.append(level)
        inside = not inside
        wrong = sides[inside].filter(_has(level)(hash_pair(F.col("key"), len(levels) - 1)))
        sides[inside] = stored(wrong)
    return levels


def is_listed(levels: Sequence[Level]):
    """Function of a column: for an array of arrays of hash pairs (one per key, one pair per level), which keys are listed.

    A key is listed if the number of levels that hold it, counted from the first without a gap, is odd.
    """
    depth = len(levels)

    @F.pandas_udf("array<boolean>")
    def member(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in parts:
            sizes = rows.map(len).to_numpy()
            flat = [pair for keys in rows for pairs in keys for pair in pairs]
            hashes = np.array(flat, dtype=np.int64).reshape(-1, depth, 2)
            held, odd = np.ones(len(hashes), dtype=bool), np.zeros(len(hashes), dtype=bool)
            for i, level in enumerate(levels):
                held &= level.has(hashes[:, i, 0], hashes[:, i, 1])
                odd ^= held
            ends = np.cumsum(sizes)
            yield pd.Series([odd[e - s : e].tolist() for s, e in zip(sizes, ends)])

    return member


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """Every key a rule that fits can have, longest first: suffixes of the host by labels, prefixes of the path."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )
    prefixes = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(set(path_lengths))])
    pairs = F.flatten(
        F.transform(
            suffixes,
            lambda s: F.transform(F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.struct(
                (-F.length(s) - F.length(p)).alias("order"), F.concat(s, p).alias("key")
            )),
        )
    )
    return F.transform(F.array_sort(F.array_distinct(pairs)), lambda x: x["key"])


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    max_bytes: int = MAX_CASCADE_BYTES,
) -> DataFrame:
    """``page_id, host, path, rule, verdict``, one row per row of ``pages``.

    The rules are the listed keys, the candidate keys of all urls the universe. The longest rule that fits
    gives the verdict; of two of one length the one that comes first as text. A url that no rule fits gets
    ``default``. A url that is null or has no ``://`` has an empty host and path and fits no rule, as no rule has
    an empty host. Without rules all get ``default``. Repeated rows stay; ids may be null; other columns are not looked at.
    """
    if any(not r.host for r in rules):
        raise ValueError("a rule needs a host")
    spark = pages.sparkSession
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    if not rules:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    lengths = sorted({len(r.path) for r in rules})
    keyed = rows.withColumn("_keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    listed = spark.createDataFrame([(r.key,) for r in rules], "key string")
    universe = rows.select("host", "path").distinct().select(
        F.explode(candidate_keys(F.col("host"), F.col("path"), lengths)).alias("key")
    )
    levels = build_cascade(listed, universe, max_bytes)
    pairs = F.transform("_keys", lambda k: F.array(*[hash_pair(k, i) for i in range(len(levels))]))
    found = keyed.withColumn("_in", is_listed(levels)(pairs)).withColumn(
        "rule", F.try_element_at(F.filter("_keys", lambda k, i: F.get("_in", i)), F.lit(1))
    )
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.key, r.verdict)])
    return found.select(
        "page_id", "host", "path", "rule", F.coalesce(F.try_element_at(verdicts, "rule"), F.lit(default)).alias("verdict")
    )
