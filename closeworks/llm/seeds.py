"""Repeated windows of a corpus, brought together without comparing documents to each other.

A window is a fixed number of consecutive symbols (bytes or words). Each has a seed: the gram with the
smallest hash inside it. Equal windows have equal seeds at equal places, and neighbouring windows mostly share
theirs, so a document becomes a row of fragments, one per seed, that hold all its windows once.

Only seeds that occur twice matter. Their fragments are combined with all equal ones by a hash, which leaves the
earliest occurrence of each distinct fragment, and every other occurrence is a repeat as a whole. What is left to
compare are distinct fragments with one seed: the edges of repeated passages. Only their symbols are fetched, and go to
an index in blocks of whole seeds, by the method of the operator. A seed with more distinct fragments than a block
holds is not gathered in one place: its fragments are cut again by seeds of twice the length, and for what is then still
too much, windows are taken one by one and combined by hash, which gives the same answer.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import id_of, stored, text_of

#: Places inside a stretch of a document take so many bits; the hash that orders grams has the others.
PLACE_BITS = 24
#: Windows that are worked on at a time.
STRETCH = 1 << 19

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Windows:
    """``window`` symbols are compared at a time, by seeds of ``gram`` symbols.

    ``symbols`` makes an array of unsigned integers from a text. ``block`` symbols go into one index, and with
    them at most ``max_fragments`` fragments of one seed.
    """

    window: int
    gram: int
    symbols: Callable[[str], np.ndarray]
    max_fragments: int = 4096
    block: int = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def gram_hashes(symbols: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` symbols, joined from runs of half the length."""
    n = len(symbols) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    code, have = symbols.astype(np.uint64) + np.uint64(1), 1
    while have < size:
        step = min(have, size - have)
        a, b = code[: len(code) - step], code[step:]
        code = (a * MULTIPLIER) ^ (b + (a >> np.uint64(32)))
        code *= MULTIPLIER
        have += step
    return mixed(code)


def _stretch_seeds(symbols: np.ndarray, w: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    hashes = gram_hashes(symbols, w.gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    key = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    span, size = w.window - w.gram + 1, 1
    while size < span:
        step = min(size, span - size)
        key = np.minimum(key[:-step], key[step:])
        size += step
    first = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    end = np.append(first[1:], len(key))
    # Grams side by side from the first to the last hold all symbols of a fragment.
    last = end + w.window - 1 - w.gram
    content = (end - first).astype(np.uint64)
    for at in range(0, w.window + span, w.gram):
        content = (content ^ hashes[np.minimum(first + at, last)]) * MULTIPLIER
        content ^= content >> np.uint64(32)
    return first, end, hashes[(key[first] & low).astype(np.int64)], content


def seeds_of(symbols: np.ndarray, w: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, end of windows, seed, hash of the content) of each fragment of a document.

    Long documents are taken in stretches; a fragment that a stretch cuts in two is two fragments, which only
    means that their windows are found in two places.
    """
    n = len(symbols) - w.window + 1
    if n <= 0:
        return (*(np.zeros(0, dtype=np.int64) for _ in range(2)), *(np.zeros(0, dtype=np.uint64) for _ in range(2)))
    parts = []
    for a in range(0, n, STRETCH):
        first, end, seed, content = _stretch_seeds(symbols[a : a + STRETCH + w.window - 1], w)
        parts.append((first + a, end + a, seed, content))
    return tuple(np.concatenate(x) for x in zip(*parts))  # type: ignore[return-value]


def keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id, _h, _text``: a row of the corpus is known by its id and a hash of its text."""
    text = text_of(text_col)
    return documents.select(id_of(id_col).alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_text"))


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def _join(parts: list[np.ndarray], kind: type = np.int64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)


SEED_SCHEMA = "_id long, _h long, first long, n int, seed long, content long"


def _seed_batches(w: Windows):
    names = ["_id", "_h", "first", "n", "seed", "content"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [seeds_of(w.symbols(text), w) for text in batch.column("_text").to_pylist()]
            take = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            first, end = _join([f[0] for f in found]), _join([f[1] for f in found])
            hashes = [_longs(_join([f[i] for f in found], np.uint64)) for i in (2, 3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(take), batch.column("_h").take(take), pa.array(first),
                 pa.array((end - first).astype(np.int32)), *hashes],
                names=names,
            )

    return run


FRAGMENT_SCHEMA = "_id long, _h long, first long, seed long, symbols binary"


def _fragment_batches(w: Windows):
    """Symbols of chosen fragments: each of ``chosen`` has first, n and seed."""
    names = ["_id", "_h", "first", "seed", "symbols"]
    kinds = [pa.int64()] * 4 + [pa.binary()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            columns = [batch.column(n).to_pylist() for n in ("_id", "_h", "_text", "chosen")]
            for i, h, text, chosen in zip(*columns):
                symbols = w.symbols(text)
                for c in chosen:
                    a = c["first"]
                    rows.append((i, h, a, c["seed"], symbols[a : a + c["n"] + w.window - 1].tobytes()))
                if len(rows) >= OUT_ROWS:
                    yield out(rows)
                    rows = []
            yield out(rows)

    return run


#: Rows that a task gathers before it passes them on.
OUT_ROWS = 20_000


@dataclass
class Block:
    """Fragments of whole seeds, in the order of the corpus. ``text`` has them one after the other."""

    text: np.ndarray
    starts: np.ndarray  # of each fragment in the text
    windows: np.ndarray  # number of windows of each fragment


def window_ranks(block: Block, window: int) -> np.ndarray:
    """A number for each place of the text; two places have the same one if the windows that start there are equal.

    Numbers follow the order of the windows as text. The order by longer runs of symbols comes from the order by
    shorter ones: as many numbers side by side as fit into 62 bits are sorted as one.
    """
    rank = np.unique(block.text, return_inverse=True)[1].astype(np.int64) + 1
    have = 1
    while have < window:
        bits = int(rank.max()).bit_length()
        key, reach = rank.copy(), have
        for _ in range(62 // bits - 1):
            if reach == window:
                break
            # The next run may overlap the last, so that exactly the window is covered.
            start = min(reach, window - have)
            key = key << bits
            key[: len(rank) - start] |= rank[start:]
            reach = start + have
        order = np.argsort(key)
        new = np.empty(len(rank), dtype=np.int64)
        new[order] = np.cumsum(np.diff(key[order], prepend=-1) != 0)
        rank, have = new, reach
    # A place whose window reaches into the next fragment is like no other.
    valid = np.zeros(len(rank) + 1, dtype=np.int64)
    np.add.at(valid, block.starts, 1)
    np.add.at(valid, block.starts + block.windows, -1)
    wrong = np.flatnonzero(np.cumsum(valid)[:-1] == 0)
    rank[wrong] = len(rank) + 1 + wrong
    return rank


#: What a method does with a block: for each fragment, which of its windows occur earlier in the block.
IndexWindows = Callable[[Block, int], list[np.ndarray]]


def _index_batches(w: Windows, dtype: str, repeats: IndexWindows):
    """Collect whole seeds into blocks and mark the windows that an earlier fragment has too."""

    def answer(rows: list[tuple]) -> pa.RecordBatch:
        # Repeated rows of the corpus bring a fragment twice.
        rows = [r for _, r in sorted({r[:3]: r for r in rows}.items())]
        parts = [np.frombuffer(r[4], dtype=dtype) for r in rows]
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        block = Block(
            np.concatenate(parts) if parts else np.zeros(0, dtype), np.cumsum(lengths) - lengths, lengths - w.window + 1
        )
        out = []
        for r, hit in zip(rows, repeats(block, w.window) if rows else []):
            edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
            out += [(r[0], r[1], r[2] + int(a), r[2] + int(b) + w.window - 1) for a, b in zip(edges[::2], edges[1::2])]
        columns = list(zip(*out)) or [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["_id", "_h", "start", "end"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, last = 0, None
        names = ["_id", "_h", "first", "seed", "symbols"]
        for batch in batches:
            for row in zip(*[batch.column(n).to_pylist() for n in names]):
                if row[3] != last and size >= w.block:
                    yield answer(rows)
                    rows, size = [], 0
                last = row[3]
                rows.append(row)
                size += len(row[4]) // np.dtype(dtype).itemsize
        yield answer(rows)

    return run


def _refined_batches(w: Windows, dtype: str):
    """Fragments cut into fragments of longer seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, h, first, data in zip(*[batch.column(n).to_pylist() for n in ("_id", "_h", "first", "symbols")]):
                symbols = np.frombuffer(data, dtype=dtype)
                for a, b, seed in zip(*seeds_of(symbols, w)[:3]):
                    rows.append((i, h, first + int(a), int(seed.view(np.int64)), symbols[a : b + w.window - 1].tobytes()))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["_id", "_h", "first", "seed", "symbols"]
            )

    return run


def _window_batches(w: Windows, dtype: str):
    """Every window of a fragment on its own, by a hash of 128 bits."""
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, h, first, data in zip(*[batch.column(n).to_pylist() for n in ("_id", "_h", "first", "symbols")]):
                for j in range(len(data) // width - w.window + 1):
                    digest = hashlib.blake2b(data[j * width : (j + w.window) * width], digest_size=16).digest()
                    out.append((i, h, first + j, *struct.unpack("<qq", digest)))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["_id", "_h", "first", "f1", "f2"]
            )

    return run


def _by_size(fragments: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Fragments of seeds with 2 to ``most`` fragments, and of those with more. A seed with one has nothing to compare."""
    sizes = fragments.groupBy("seed").agg(F.count("*").alias("_n")).filter("_n > 1")
    counted = fragments.join(sizes, "seed")
    return tuple(counted.filter(c).drop("_n") for c in (F.col("_n") <= most, F.col("_n") > most))  # type: ignore[return-value]


def repeated_spans(documents: DataFrame, w: Windows, dtype: str, repeats: IndexWindows) -> DataFrame:
    """``_id, _h, spans``: stretches of symbols covered by windows that start earlier too, per row that has any.

    Earlier means: smaller ``_id``, then smaller ``_h``, then an earlier place. ``documents`` is what ``keyed``
    gives. Spans may overlap and come in any order; a row has no more of them than windows.
    """
    seeds = documents.select("_id", "_h", "_text").mapInArrow(_seed_batches(w), SEED_SCHEMA)
    # Stored, so that its shuffle is freed before the next one and a hot seed can be split in the join.
    again = stored(
        seeds.groupBy("seed")
        .agg(F.count("*").alias("_n"), F.min("content").alias("_lo"), F.max("content").alias("_hi"))
        .filter("_n > 1")
        .select("seed", (F.col("_lo") != F.col("_hi")).alias("mixed"))
    )
    found = stored(seeds.join(again, "seed"))
    place = F.struct("_id", "_h", "first")
    distinct = stored(
        found.groupBy("seed", "content", "mixed").agg(F.min(place).alias("at"), F.min("n").alias("n"), F.count("*").alias("copies"))
    )
    whole = (
        found.join(distinct.filter("copies > 1").select("seed", "content", "at"), ["seed", "content"])
        .filter(place != F.col("at"))
        .select("_id", "_h", F.col("first").alias("start"), (F.col("first") + F.col("n") + w.window - 1).alias("end"))
    )
    mixed_first = distinct.filter("mixed")
    chosen = mixed_first.groupBy("at._id", "at._h").agg(F.collect_list(F.struct("at.first", "n", "seed")).alias("chosen"))
    one_row = documents.select("_id", "_h", "_text").join(chosen, ["_id", "_h"])
    symbols = stored(one_row.mapInArrow(_fragment_batches(w), FRAGMENT_SCHEMA))
    few, many = _by_size(symbols, w.max_fragments)
    finer = stored(many.mapInArrow(_refined_batches(replace(w, gram=2 * w.gram), dtype), FRAGMENT_SCHEMA))
    few_finer, many_finer = _by_size(finer, w.max_fragments)
    edges = (
        few.unionByName(few_finer)
        .repartition("seed")
        .sortWithinPartitions("seed")
        .mapInArrow(_index_batches(w, dtype, repeats), "_id long, _h long, start long, end long")
    )
    single = stored(
        many_finer.repartition("_id", "first").mapInArrow(
            _window_batches(w, dtype), "_id long, _h long, first long, f1 long, f2 long"
        )
    )
    earliest = single.groupBy("f1", "f2").agg(F.min(place).alias("at"), F.count("*").alias("n")).filter("n > 1")
    crowded = (
        single.join(earliest, ["f1", "f2"])
        .filter(place != F.col("at"))
        .select("_id", "_h", F.col("first").alias("start"), (F.col("first") + w.window).alias("end"))
    )
    return (
        whole.unionByName(edges).unionByName(crowded)
        .groupBy("_id", "_h").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Spans in order, joined where they touch or overlap."""
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or []):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
