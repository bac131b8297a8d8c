"""Toxicity by logistic regression, trained with FTRL-proximal on hashed word n-grams and skip-grams.

A feature is the 32-bit hash of a word, of its stem, of a pair of neighbours, or of two words with one or two others between
them; it is present or not. A stem is the start of a longer word and stands for its inflected forms. Each coordinate has a learning rate of its own, and an L1 penalty leaves most weights at zero.
What is left is a short sorted list of hashes and weights, which travels to the tasks that score all texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import NULL_ID, id_of, id_or_null, stored, text_of

WORD = re.compile(r"[^\W_]+")
KNOWN_WORDS = 300_000
#: Characters of the stems; a word has those that are shorter than itself.
STEMS = (5,)
#: Multipliers of the first and the second word: neighbours, one word between, two words between. Odd numbers.
PAIRS = ((1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9, 0xD6E8FEB86659FD93), (3, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))


@dataclass(frozen=True)
class Ftrl:
    """``sample``: labelled texts that are learned from, those with the smallest hash of id and text; ``features``: no
    more than so many features of them in all, so the driver holds 4 bytes of each. ``alpha``, ``beta``: rate of a coordinate,
    alpha / (beta + root of its squared gradients). ``threshold`` is the score from which 1 is predicted."""

    sample: int = 8192
    features: int = 12_000_000
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 12.0
    l2: float = 1.0
    epochs: int = 6
    threshold: float = 0.3


def word_hash(word: str) -> int:
    raw = word.encode("utf-8", "surrogatepass")
    return zlib.crc32(raw) | zlib.adler32(raw, 0x5BD1) << 32


class Hasher:
    """Hashes of the features of a text. Words are remembered with their stems, as most come again."""

    def __init__(self):
        self.known: dict[str, tuple[int, ...]] = {}

    def _word(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            stems = (word_hash(word[:n] + "-") if n < len(word) else 0 for n in STEMS)
            found = (word_hash(word), *stems)
            if len(self.known) < KNOWN_WORDS and len(word) < 64:
                self.known[word] = found
        return found

    def features(self, text: str) -> np.ndarray:
        """All of them, repeats included, in no order."""
        words = WORD.findall(text.lower())
        forms = np.array([self._word(w) for w in words], dtype=np.uint64).reshape(len(words), 1 + len(STEMS))
        ids, stems = forms[:, 0], forms[:, 1:]
        parts = [ids * np.uint64(0xA0761D6478BD642F), stems[stems > 0] * np.uint64(0xE7037ED1A0B428DB)]
        parts += [ids[:-gap] * np.uint64(a) + ids[gap:] * np.uint64(b) for gap, a, b in PAIRS if len(ids) > gap]
        mixed = np.concatenate(parts)
        mixed ^= mixed >> np.uint64(29)
        return (mixed * np.uint64(0x94D049BB133111EB) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Weights:
    """Sorted hashes with their weights, and a bitmap over the last bits of the hashes that most features fail."""

    hashes: np.ndarray
    values: np.ndarray
    bias: float
    bits: int = 20

    def table(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, dtype=bool)
        out[self.hashes & np.uint32((1 << self.bits) - 1)] = True
        return out

    def score(self, features: np.ndarray, table: np.ndarray) -> float:
        likely = np.unique(features[table[features & np.uint32((1 << self.bits) - 1)]])
        total = self.bias
        if len(likely) and len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, likely), len(self.hashes) - 1)
            total += float(self.values[at][self.hashes[at] == likely].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def train(examples: list[np.ndarray], labels: np.ndarray, ftrl: Ftrl) -> Weights:
    """FTRL-proximal over ``examples`` (sorted distinct hashes of each), in an order drawn anew for each epoch.

    A feature of a single example says nothing of others and is left out. Without examples every score is 0.
    """
    none = Weights(np.zeros(0, np.uint32), np.zeros(0), -500.0)
    if not len(examples):
        return none
    flat = np.sort(np.concatenate(examples))
    again = flat[1:][flat[1:] == flat[:-1]]
    vocabulary = again[np.r_[True, again[1:] != again[:-1]]] if len(again) else again
    del flat, again
    rows = []
    for x in examples:
        at = np.searchsorted(vocabulary, x)
        at[at == len(vocabulary)] = 0
        # The last coordinate is the bias: it has no penalty and starts at the odds of the sample.
        rows.append(np.r_[at[vocabulary[at] == x] if len(vocabulary) else at[:0], len(vocabulary)].astype(np.int32))
    size = len(vocabulary) + 1
    z, n, l1 = np.zeros(size), np.zeros(size), np.full(size, ftrl.l1)
    l1[-1], rate = 0.0, (labels.sum() + 0.5) / (len(labels) + 1)
    start = np.log(rate / (1 - rate))

    def weight(at):
        held = np.abs(z[at]) - l1[at]
        return np.where(held > 0, -np.sign(z[at]) * held / ((ftrl.beta + np.sqrt(n[at])) / ftrl.alpha + ftrl.l2), 0.0)

    rng = np.random.default_rng(0)
    for _ in range(ftrl.epochs):
        for i in rng.permutation(len(rows)):
            at = rows[i]
            w = weight(at)
            g = 1 / (1 + np.exp(-np.clip(start + w.sum(), -500, 500))) - labels[i]
            squared = n[at] + g * g
            z[at] += g - (np.sqrt(squared) - np.sqrt(n[at])) / ftrl.alpha * w
            n[at] = squared
    w = weight(np.arange(size))
    used = np.flatnonzero(w[:-1])
    return Weights(vocabulary[used], w[used].astype(np.float32), float(start + w[-1]))


def _example_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features of each text; a text that a task has already seen under its id is left out."""
    hasher, seen = Hasher(), set()
    for batch in batches:
        out = []
        for i, h, label, place, text in zip(*(batch.column(c).to_pylist() for c in ("_id", "_h", "_label", "_place", "_text"))):
            if (i, h) not in seen:
                seen.add((i, h))
                found = np.unique(hasher.features(text))
                out.append((i, h, label, place, len(found), found.tobytes()))
        columns = list(zip(*out)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["_id", "_h", "_label", "_place", "n", "found"]
        )


def labelled_sample(rows: DataFrame, labels: DataFrame, learnable: Column, ftrl: Ftrl) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and labels of the sample, in the order of their hashes.

    Ids are chosen first, then texts of them, each once however many rows repeat it; so both bounds hold for any input.
    """
    place = F.xxhash64("_id", "_h")
    ids = stored(
        labels.filter(F.col("_label").isNotNull() & learnable)
        .groupBy("_id").agg(F.max("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(ftrl.sample)
    )
    chosen = stored(
        rows.join(F.broadcast(ids), "_id").groupBy("_id", "_h").agg(F.max("_label").alias("_label"))
        .withColumn("_place", place).orderBy("_place", "_id", "_h").limit(ftrl.sample)
    )
    texts = rows.join(F.broadcast(chosen), ["_id", "_h"]).select("_id", "_h", "_label", "_place", "_text")
    schema = "_id long, _h long, _label int, _place long, n long, found binary"
    examples = stored(texts.mapInArrow(_example_batches, schema).dropDuplicates(["_id", "_h"]))
    sizes = examples.select("_place", "n").toPandas().sort_values(["_place", "n"])
    fits = sizes[sizes["n"].cumsum() <= ftrl.features]
    if fits.empty:
        return [], np.zeros(0, dtype=np.int64)
    last = int(fits["_place"].iloc[-1])
    found = examples.filter(F.col("_place") <= last).select("_place", "_label", "found").toPandas()
    found = found.sort_values(["_place", "_label", "found"])
    return [np.frombuffer(x, dtype=np.uint32) for x in found["found"]], found["_label"].to_numpy(dtype=np.int64)


def score_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "toxic",
    folds: int = 4,
    held_out_fold: int = 2,
    ftrl: Ftrl = Ftrl(),
) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``documents``.

    Learned only from labels whose crc32(id as text) mod ``folds`` is not ``held_out_fold``; a null id is never
    held out and has no label. A null text is empty, and an empty text gets the score of the bias. Of an id with
    several labels the largest counts; null labels and labels without a document teach nothing; where nothing can be learned
    every score is 0. Rows that repeat id and text are one example. Only texts enter the score, other columns
    are not looked at.
    """
    in_fold = F.pmod(F.crc32(F.col("_id").cast("string").cast("binary")), F.lit(folds)) == held_out_fold
    held_out = (F.col("_id") != F.lit(NULL_ID)) & in_fold
    rows = documents.select(id_of(id_col).alias("_id"), text_of(text_col).alias("_text"))
    marked = labels.filter(F.col(label_id_col).isNotNull()).select(
        id_of(label_id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")
    )
    keyed = rows.withColumn("_h", F.xxhash64("_text"))
    weights = train(*labelled_sample(keyed, marked, ~held_out, ftrl), ftrl)  # travels with the function below

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), weights.table()
        for batch in batches:
            scores = [weights.score(hasher.features(t.as_py()), table) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(scores, pa.float64())], names=["_id", "score"])

    scored = rows.mapInArrow(run, "_id long, score double")
    return scored.select(
        id_or_null().alias("doc_id"), held_out.alias("held_out"), "score",
        (F.col("score") >= ftrl.threshold).cast("int").alias("predicted"),
    )
