"""Importance resampling toward a target distribution: documents are drawn by weight plus random noise, the highest first.

1. Words are counted per bucket over the corpus and over the target; an array holds the gain of each bucket.
2. Each text is scored by that array. Scores are whole numbers, so the order of sums does not matter.
3. A quantile sketch of the scores brackets the one at which the wanted number is reached. Exact counts above
   and inside of the bracket validate it; where it missed, it is widened, in the end to all scores. Only rows inside are
   sorted for the cutoff. Drawn rows are numbered by ranges: a count per range, then the place in it.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import id_of, id_or_null, stored, text_of

KNOWN_WORDS = 300_000
#: Distinct scores that are sorted for the cutoff, at most.
SORTED = 50_000
#: Letters are lowered, digits and bytes above 7F stay, all others separate words.
AS_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


@dataclass(frozen=True)
class Resampling:
    """``percent`` of the documents with at least ``min_words`` words are drawn. ``error`` is the rank error of the sketch, as
    a share of them; ``ranges`` the parts in which drawn rows are sorted, None for as many as the session shuffles into."""

    buckets: int = 10_000
    max_run: int = 1
    min_words: int = 20
    percent: int = 10
    seed: int = 2024
    error: float = 0.005
    ranges: int | None = None


class Buckets(dict):
    """Buckets of features; words seen first are remembered."""

    def __init__(self, resampling: Resampling):
        super().__init__()
        self.resampling = resampling

    def __missing__(self, feature: bytes) -> int:
        value = zlib.crc32(feature) % self.resampling.buckets
        if len(self) < KNOWN_WORDS and len(feature) < 64:
            self[feature] = value
        return value

    def of(self, text: str) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of each feature."""
        words = text.encode("utf-8", "surrogatepass").translate(AS_WORDS).split()
        found = [np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))]
        for n in range(2, self.resampling.max_run + 1):
            runs = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
            found.append(np.fromiter(map(self.__getitem__, runs), dtype=np.int64, count=len(runs)))
        return len(words), np.concatenate(found)


def bucket_counts(texts: DataFrame, resampling: Resampling) -> np.ndarray:
    """Features per bucket over all rows of ``_text``. Each task sends one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, total = Buckets(resampling), np.zeros(resampling.buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column("_text"):
                total += np.bincount(buckets.of(text.as_py())[1], minlength=resampling.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    found = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(resampling.buckets, dtype=np.int64)
    out[found["bucket"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of both smoothed shares, rounded down, for each bucket."""
    smooth = float(len(corpus))
    all_s, all_t = float(corpus.sum()) + smooth, float(target.sum()) + smooth
    gains = [math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array(gains, dtype=np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise in thousandths, the same for an id on every run. A null id is ``null``."""
    h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_rows(documents: DataFrame, gains: np.ndarray, resampling: Resampling) -> DataFrame:
    """``_id, no_id, n_words, n_features, weight, score, key`` of rows ``_id, no_id, _text``; ``key`` tells texts apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(resampling)
        for batch in batches:
            rows = []
            for i, no_id, text in zip(*(batch.column(c).to_pylist() for c in ("_id", "no_id", "_text"))):
                words, found = buckets.of(text)
                weight = int(gains[found].sum())
                score = weight + noise(resampling.seed, None if no_id else i)
                key = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                rows.append((i, no_id, words, len(found), weight, score, int.from_bytes(key, "little", signed=True)))
            columns = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.bool_(), *[pa.int64()] * 5)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["_id", "no_id", "n_words", "n_features", "weight", "score", "key"],
            )

    schema = "_id long, no_id boolean, n_words long, n_features long, weight long, score long, key long"
    return documents.mapInArrow(run, schema)


def cutoff_score(scores: DataFrame, wanted: int, error: float) -> int:
    """The score of rank ``wanted`` from the top in the column ``score``; ``1 <= wanted <=`` number of rows.

    The sketch only proposes the bracket; counts over all rows decide. A bracket of more than ``SORTED`` whole numbers is
    halved by such counts first, so what is sorted is bounded whatever the scores are.
    """
    total, least, most = scores.agg(F.count("*"), F.min("score"), F.max("score")).first()
    share, width = 1 - wanted / total, max(error, 1.0 / total)
    while True:
        low, high = least, most
        if width < 1:
            ends = [max(0.0, share - width), min(1.0, share + width)]
            # The relative error of the sketch is a quarter of the bracket.
            found = scores.agg(F.percentile_approx("score", ends, F.lit(math.ceil(4 / width)))).first()[0]
            low, high = (found[0] if ends[0] > 0 else least), (found[1] if ends[1] < 1 else most)
        above, inside = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if above < wanted <= above + inside:
            break
        width *= 4
    while high - low >= SORTED:
        middle = (low + high) // 2
        n = scores.filter(F.col("score") > middle).count()
        low, high, above = (middle + 1, high, above) if n >= wanted else (low, middle, n)
    bracket = scores.filter(F.col("score").between(low, high)).groupBy("score").agg(F.count("*").alias("n"))
    for row in bracket.orderBy(F.desc("score")).collect():
        above += row["n"]
        if above >= wanted:
            return row["score"]
    raise AssertionError("the bracket holds the wanted rank")


def number_rows(rows: DataFrame, order: list[Column], ranges: int | None) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... in the given order, without a window over all rows.

    Rows are dealt to ranges and sorted there; Spark's row ids tell the range and the place in it. The result is
    stored, so that all see the same ranges, and one count per range gives the rank of its first row.
    """
    dealt = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
    placed = stored(dealt.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    starts, before = [], 0
    for p, n in sizes:
        starts.append((p, before))
        before += n
    spark = rows.sparkSession
    first = spark.createDataFrame(starts, "_part long, _start long")  # one row per range
    return (
        placed.withColumn("_part", part).join(F.broadcast(first), "_part")
        .withColumn("rank", F.col("_start") + place + 1).drop("_at", "_part", "_start")
    )


def resample(
    documents: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    resampling: Resampling = Resampling(),
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``, one row per row of ``documents``; ``rank`` is null for those not drawn.

    A null text has no word. Equal scores go to the smaller id; a null id comes last and shares the noise of ``null``;
    rows that repeat an id go by the hash of their text, and rows equal in all of that are alike, so either may be
    drawn. With an empty target the gains are those of its smoothing; without documents there are no rows.
    Other columns are not looked at.
    """
    r = resampling
    rows = documents.select(id_of(id_col).alias("_id"), F.col(id_col).isNull().alias("no_id"), text_of(text_col).alias("_text"))
    gains = bucket_gains(
        bucket_counts(rows.select("_text"), r), bucket_counts(target.select(text_of(target_col).alias("_text")), r)
    )
    scored = stored(score_rows(rows, gains, r))
    able = scored.filter(F.col("n_words") >= r.min_words)
    wanted = able.count() * r.percent // 100
    columns = [id_or_null().alias("doc_id"), "n_features", "weight", "score"]
    unranked = lambda df: df.select(*columns, F.lit(None).cast("long").alias("rank"))
    if wanted == 0:
        return unranked(scored)
    cut = cutoff_score(able, wanted, r.error)
    # Whoever is above the cutoff is drawn; at the cutoff the first in order fill what is left. Rows that are alike in all else
    # go by their place in the table, so that ranges can part them.
    order = [F.desc("score"), *map(F.asc, ("no_id", "_id", "key", "n_features", "place"))]
    last = able.filter(F.col("score") >= cut).withColumn("place", F.monotonically_increasing_id())
    ranked = number_rows(last, order, r.ranges)
    drawn = F.when(F.col("rank") <= wanted, F.col("rank"))
    rest = scored.filter((F.col("n_words") < r.min_words) | (F.col("score") < cut))
    return ranked.select(*columns, drawn.alias("rank")).unionByName(unranked(rest))
