"""Language identification by mixture inference.

Each language is a distribution over hashed character trigrams, learned from all texts that may be learned from.
A document is a mixture: expectation-maximisation finds the proportions, and languages enter the set one by one, as
long as the likelihood gains more than the penalty for one more of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import id_of, id_or_null, text_of

LETTER = re.compile(r"[^\W\d_]")
NOT_LETTERS = re.compile(r"[\W\d_]+")
UNKNOWN = "und"


@dataclass(frozen=True)
class Mixture:
    """``penalty``: log likelihood one more language must gain, per unit of log(number of trigrams)."""

    bits: int = 16
    smoothing: float = 0.5
    rounds: int = 25
    tolerance: float = 1e-4
    penalty: float = 4.0
    max_languages: int = 512


def trigram_buckets(text: str, bits: int) -> np.ndarray:
    """Buckets of the trigrams of a text in lower case, with all that is no letter as one space."""
    points = np.frombuffer(f" {NOT_LETTERS.sub(' ', text.lower())} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = points[:-2] * np.uint32(0x9E3779B1) + points[1:-1] * np.uint32(0x85EBCA77) + points[2:] * np.uint32(0xC2B2AE3D)
    return (code ^ (code >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(32 - bits)


def _count_batches(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("_lang").to_pylist(), batch.column("_text").to_pylist()):
                if LETTER.search(text):
                    table = totals.setdefault(lang, np.zeros(1 << bits, dtype=np.int64))
                    np.add.at(table, trigram_buckets(text, bits), 1)
        for lang, table in totals.items():
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(table[used], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    return run


@dataclass
class Model:
    mixture: Mixture
    languages: list[str]
    chances: np.ndarray  # bucket, language

    def proportions(self, p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions and log likelihood of a document with trigram chances ``p`` and counts ``n``."""
        share, total = np.full(p.shape[1], 1 / p.shape[1]), n.sum()
        for _ in range(self.mixture.rounds if p.shape[1] > 1 else 0):
            mixed = p @ share
            new = share * ((n / mixed) @ p) / total
            done = np.abs(new - share).max() < self.mixture.tolerance
            share = new
            if done:
                break
        return share, float(n @ np.log(p @ share))

    def infer(self, text: str) -> list[tuple[str, float]]:
        """Languages with their proportions, the largest first; empty if the text has no letter."""
        if not self.languages or not LETTER.search(text):
            return []
        buckets, n = np.unique(trigram_buckets(text, self.mixture.bits), return_counts=True)
        p = self.chances[buckets]
        share, _ = self.proportions(p, n)
        order = np.argsort(-share, kind="stable")
        cost = self.mixture.penalty * np.log(n.sum() + 1)
        chosen, (best, level) = order[:1], self.proportions(p[:, order[:1]], n)
        for size in range(2, len(order) + 1):
            if share[order[size - 1]] < 1 / (n.sum() + 1):
                break
            more, gained = self.proportions(p[:, order[:size]], n)
            if gained - level <= cost:
                break
            chosen, best, level = order[:size], more, gained
        ranked = sorted(zip(-best, chosen))
        return [(self.languages[i], float(-s)) for s, i in ranked]


def learn(documents: DataFrame, mixture: Mixture) -> Model:
    """The model from rows ``_lang, _text``. Counts are summed in Spark; the result has a fixed size per language."""
    counts = (
        documents.mapInArrow(_count_batches(mixture.bits), "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    languages = sorted(r["_lang"] for r in documents.select("_lang").distinct().limit(mixture.max_languages + 1).collect())
    if len(languages) > mixture.max_languages:
        raise ValueError(f"more than {mixture.max_languages} languages: raise max_languages, the model grows with it")
    table = np.zeros((1 << mixture.bits, len(languages)))
    found = counts.toPandas()
    place = {lang: i for i, lang in enumerate(languages)}
    table[found["bucket"].to_numpy(dtype=np.int64), found["lang"].map(place).to_numpy(dtype=np.int64)] = found["n"]
    # A language whose texts have no letter is not learned.
    kept = table.sum(0) > 0
    table = table[:, kept] + mixture.smoothing
    return Model(mixture, [x for x, k in zip(languages, kept) if k], (table / table.sum(0)).astype(np.float32).astype(float))


def identify_languages(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 3,
    held_out_fold: int = 1,
    mixture: Mixture = Mixture(),
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, languages``, one row per row of ``documents``.

    Learned from texts with a language whose crc32(id as text) mod ``folds`` is not ``held_out_fold``; a null id
    is never held out. ``score`` is the proportion of the predicted language, ``languages`` all of the set with
    their proportions. A text that is null or has no letter, or any text when nothing could be learned, is
    ``und`` with score 0. Of equal proportions the language that comes first as text is predicted.
    """
    in_fold = F.pmod(F.crc32(F.col("_id").cast("string").cast("binary")), F.lit(folds)) == held_out_fold
    held_out = (F.col("_id") != F.lit(-(1 << 63))) & in_fold
    rows = documents.select(
        id_of(id_col).alias("_id"), text_of(text_col).alias("_text"), F.col(lang_col).cast("string").alias("_lang")
    )
    # The model travels with the function below, which Spark broadcasts.
    model = learn(rows.filter(F.col("_lang").isNotNull() & ~held_out).select("_lang", "_text"), mixture)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in batches:
            found = [model.infer(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array([x[0][0] if x else UNKNOWN for x in found], pa.string()),
                    pa.array([min(1.0, x[0][1]) if x else 0.0 for x in found], pa.float64()),
                    pa.array([[{"lang": a, "share": s} for a, s in x] for x in found], kind),
                ],
                names=["_id", "lang_pred", "score", "languages"],
            )

    schema = "_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    predicted = rows.select("_id", "_text").mapInArrow(run, schema)
    return predicted.select(id_or_null().alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score", "languages")
