"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Texts become hashed, weighted counts of words and of word shapes; a singular value decomposition of a bounded
sample of labelled texts gives the latent space. The labelled vectors travel to the tasks, which compute the exact
cosine of every document to every one of them, block by block, and weight the labels of the nearest by it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import id_of, id_or_null, stored, text_of


@dataclass(frozen=True)
class Knn:
    """``sample``: labelled texts that are kept, those with the smallest hash of their id; at most so many rows. The model has
    ``sample * rank`` numbers and is broadcast. ``threshold`` is the score from which 1 is predicted."""

    sample: int = 4000
    word_buckets: int = 768
    shape_buckets: int = 256
    rank: int = 48
    neighbours: int = 15
    power: float = 4.0
    threshold: float = 0.3
    block: int = 512

    @property
    def buckets(self) -> int:
        return self.word_buckets + self.shape_buckets


def shape_of(word: str) -> str:
    """Classes of characters without repeats: ``a`` lower, ``A`` upper, ``9`` digit, other characters themselves."""
    out = []
    for c in word:
        k = "a" if c.islower() else "A" if c.isupper() else "9" if c.isdigit() else "x" if c.isalpha() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out[:6])


class Features:
    """Hashed counts of a text. Buckets of words and shapes are remembered, as most words come again."""

    def __init__(self, knn: Knn):
        self.knn, self.known = knn, {}

    def _buckets(self, word: str) -> tuple[int, int]:
        found = self.known.get(word)
        if found is None:
            k = self.knn
            w = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % k.word_buckets
            s = k.word_buckets + zlib.crc32(shape_of(word).encode("utf-8", "surrogatepass")) % (k.shape_buckets - 16)
            found = (w, s)
            if len(self.known) < 200_000 and len(word) < 64:
                self.known[word] = found
        return found

    def vector(self, text: str) -> np.ndarray:
        """Counts. The last 16 buckets hold figures of the whole text, as shares of its words or lines."""
        out = np.zeros(self.knn.buckets, dtype=np.float32)
        words = text.split()
        counts = Counter(words)
        for word, n in counts.items():
            w, s = self._buckets(word)
            out[w] += n
            out[s] += n
        lines = text.split("\n")
        n = max(len(words), 1)
        pairs = sum(a == b for a, b in zip(words, words[1:]))
        triples = Counter(zip(words, words[1:], words[2:]))
        again = sum(c for c in triples.values() if c > 1)
        figures = (
            1.0, not words, pairs / n, again / n, 1 - len(counts) / n, 1 - len(set(lines)) / len(lines),
            len(words) < 10, len(words) < 50, len(text) / n > 12, len(text) / n < 3, max(counts.values(), default=0) / n,
        )
        out[self.knn.buckets - 16 :][: len(figures)] = figures
        return out


@dataclass
class Model:
    knn: Knn
    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    cut: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weighted(counts, self.knn, self.weights) @ self.axes)

    def vote(self, latent: np.ndarray, leave_out: bool = False) -> np.ndarray:
        """Share of label 1 among the nearest, weighted by a power of the cosine. All products are computed."""
        out, k = np.full(len(latent), 0.5), min(self.knn.neighbours, len(self.labels) - leave_out)
        for a in range(0, len(latent) if k > 0 else 0, self.knn.block):
            cosine = latent[a : a + self.knn.block] @ self.vectors.T
            if leave_out:
                rows = np.arange(len(cosine))
                cosine[rows, a + rows] = -2
            near = np.argpartition(cosine, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 1e-6) ** self.knn.power
            out[a : a + self.knn.block] = (weight * self.labels[near]).sum(1) / weight.sum(1)
        return out

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Votes, bent so that the cut learned from the sample stands at the threshold."""
        vote, t = self.vote(self.latent(counts)), self.knn.threshold
        bent = np.where(vote < self.cut, vote / self.cut * t, t + (vote - self.cut) / (1 - self.cut) * (1 - t))
        return np.clip(bent, 0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _weighted(counts: np.ndarray, knn: Knn, weights: np.ndarray) -> np.ndarray:
    """Log counts times their weights; words, shapes and figures each at one length."""
    w, b = knn.word_buckets, knn.buckets - 16
    logs = np.log1p(counts[:, :b]) * weights[:b]
    return np.hstack([0.5 * _unit(logs[:, :w]), _unit(logs[:, w:]), counts[:, b:]]).astype(np.float32)


def fit(counts: np.ndarray, labels: np.ndarray, knn: Knn) -> Model:
    """The latent space, the labelled vectors in it, and the cut with the best balanced accuracy on the sample."""
    n = max(len(counts), 1)
    weights = np.log((1 + n) / (1 + (counts > 0).sum(0))).astype(np.float32) + 0.1
    x = _weighted(counts, knn, weights)
    _, axes = np.linalg.eigh(x.T @ x)
    axes = np.ascontiguousarray(axes[:, ::-1][:, : knn.rank]).astype(np.float32)
    model = Model(knn, weights, axes, np.zeros((0, knn.rank)), np.zeros(0), knn.threshold)
    if len(counts):
        model.vectors, model.labels = model.latent(counts), labels.astype(np.float32)
        votes = model.vote(model.vectors, leave_out=True)
        if 0 < labels.sum() < len(labels):
            cuts = np.linspace(0.05, 0.95, 91)
            good = [(votes[labels == 1] >= c).mean() + (votes[labels == 0] < c).mean() for c in cuts]
            model.cut = float(np.mean(cuts[np.isclose(good, max(good))]))
    return model


def _count_batches(knn: Knn):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(knn)
        for batch in batches:
            vectors = [features.vector(t).tobytes() for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_label"), pa.array(vectors, pa.binary())], names=["label", "counts"]
            )

    return run


def labelled_sample(documents: DataFrame, labels: DataFrame, learnable: Column, knn: Knn) -> tuple[np.ndarray, np.ndarray]:
    """Counts and labels of the sample. Texts are counted in Spark; of each only its buckets come back.

    An example is an id and a text: rows that repeat both are one, and of an id with many texts no more than
    ``knn.sample`` count, so the bound holds for what comes back however many rows an id has.
    """
    first = [F.xxhash64("_id"), "_id"]
    chosen = stored(
        labels.filter(F.col("_label").isNotNull() & learnable)
        .groupBy("_id").agg(F.max("_label").alias("_label"))
        .orderBy(*first)
        .limit(knn.sample)
    )
    keyed = documents.withColumn("_hash", F.xxhash64("_text"))
    examples = stored(
        keyed.join(F.broadcast(chosen), "_id")
        .select("_id", "_hash", "_label").distinct()
        .orderBy(*first, "_hash")
        .limit(knn.sample)
    )
    texts = keyed.join(F.broadcast(examples), ["_id", "_hash"]).groupBy("_id", "_hash").agg(
        F.max("_label").alias("_label"), F.min("_text").alias("_text")
    )
    found = texts.mapInArrow(_count_batches(knn), "label int, counts binary").toPandas()
    # The order of the rows must not matter to the result.
    found = found.sort_values(["label", "counts"], ignore_index=True)
    counts = np.frombuffer(b"".join(found["counts"]), dtype=np.float32).reshape(-1, knn.buckets)
    return counts, found["label"].to_numpy(dtype=np.int64)


def score_quality(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
    folds: int = 5,
    held_out_fold: int = 0,
    knn: Knn = Knn(),
) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``documents``.

    Learned only from labels whose crc32(id as text) mod ``folds`` is not ``held_out_fold``. A null text is
    empty, and empty texts are scored like others. Of an id with several labels the largest counts; null labels
    and labels without a document teach nothing; rows that repeat an id and its text teach once; without any labels every score is 0.5. A null id is never
    held out. Only texts enter the score.
    """
    in_fold = F.pmod(F.crc32(F.col("_id").cast("string").cast("binary")), F.lit(folds)) == held_out_fold
    held_out = F.coalesce((F.col("_id") != F.lit(-(1 << 63))) & in_fold, F.lit(False))
    rows = documents.select(id_of(id_col).alias("_id"), text_of(text_col).alias("_text"))
    marked = labels.filter(F.col(label_id_col).isNotNull()).select(
        id_of(label_id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")
    )
    counts, given = labelled_sample(rows, marked, ~held_out, knn)
    model = fit(counts, given, knn)  # travels with the function below, which Spark broadcasts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.knn)
        for batch in batches:
            scores = []
            for a in range(0, batch.num_rows, model.knn.block):
                texts = batch.column("_text").slice(a, model.knn.block).to_pylist()
                scores.append(model.score(np.stack([features.vector(t) for t in texts])))
            flat = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(flat, pa.float64())], names=["_id", "score"])

    scored = rows.mapInArrow(run, "_id long, score double")
    return scored.select(
        id_or_null().alias("doc_id"), held_out.alias("held_out"), "score",
        (F.col("score") >= knn.threshold).cast("int").alias("predicted"),
    )
