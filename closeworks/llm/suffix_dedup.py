"""Duplicate byte runs by a run-length index.

The fragments that ``seeds`` brings together are sorted by their windows, which gives a Burrows-Wheeler order of the
block. The step from a row to the row of the place before it maps stretches of rows onto stretches of rows; only
these runs are kept, each with the place of its first row as a sample. Matching statistics are then streamed: all
fragments at once walk from their last window to their first, run by run, and a window matches earlier text if
the sample at the head of its group of equal windows lies before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import id_or_null
from closeworks.llm.seeds import Block, Windows, keyed, merged, repeated_spans, window_ranks


def text_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8"), dtype=np.uint8)


@dataclass
class RunIndex:
    """Runs of rows. ``first``: their first rows. ``target``: the row that the first row steps to. ``sample``: its place.
    ``head``: the earliest place of the group of equal windows that the run belongs to."""

    first: np.ndarray
    target: np.ndarray
    sample: np.ndarray
    head: np.ndarray

    def run_of(self, row: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, row, "right") - 1

    def step(self, row: np.ndarray, run: np.ndarray) -> np.ndarray:
        """The rows of the places one before."""
        return self.target[run] + (row - self.first[run])


def build_index(ranks: np.ndarray) -> tuple[RunIndex, np.ndarray]:
    """The index, and the row of each place, of which only the fragments' last windows are used to start from.

    Equal windows stand in the order of their places, so the first row of a group is its earliest occurrence.
    """
    n = len(ranks)
    places = np.argsort(ranks * n + np.arange(n))
    row_of = np.empty(n, dtype=np.int64)
    row_of[places] = np.arange(n)
    steps = row_of[places - 1]  # the first place steps to the last
    group = ranks[places]
    new_group = np.diff(group, prepend=-1) != 0
    first = np.flatnonzero(new_group | (np.diff(steps, prepend=-2) != 1))
    head_rows = np.maximum.accumulate(np.where(new_group, np.arange(n), 0))
    sample = places[first]
    head = places[head_rows[first]]
    return RunIndex(first, steps[first], sample, head), row_of


def earlier_windows(block: Block, window: int) -> list[np.ndarray]:
    """For each fragment, which of its windows match one that starts earlier in the block."""
    index, row_of = build_index(window_ranks(block, window))
    slot = np.cumsum(block.windows) - block.windows
    hit = np.zeros(int(block.windows.sum()), dtype=bool)
    cursor = block.windows - 1
    row = row_of[block.starts + cursor]
    active = np.arange(len(cursor))
    while len(active):
        run = index.run_of(row)
        hit[slot[active] + cursor[active]] = index.head[run] < block.starts[active] + cursor[active]
        row = index.step(row, run)
        cursor[active] -= 1
        alive = cursor[active] >= 0
        active, row = active[alive], row[alive]
    return np.split(hit, slot[1:])


BYTES = Windows(window=100, gram=32, symbols=text_bytes)

RESULT = "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _result_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        sizes, removed, counts, digests = [], [], [], []
        for text, spans in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist()):
            data, cut = text.encode("utf-8"), merged(spans)
            digest, at = hashlib.sha256(), 0
            for a, b in cut:
                digest.update(data[at:a])
                at = b
            digest.update(data[at:])
            sizes.append(len(data))
            removed.append(sum(b - a for a, b in cut))
            counts.append(len(cut))
            digests.append(digest.hexdigest())
        kinds = [pa.int64()] * 3 + [pa.string()]
        arrays = [pa.array(c, k) for c, k in zip((sizes, removed, counts, digests), kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), *arrays], names=names)


def dedup_bytes(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", windows: Windows = BYTES
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per row of ``documents``.

    A byte is removed if a window of 100 bytes that covers it also starts earlier: in a document with a smaller
    id, or earlier in the same one. A null text is empty. A null id counts as the smallest id and stays null. Rows with
    the same id and text are one document and get equal results; texts that share an id stand in the order
    of a hash. Other columns are not looked at.
    """
    rows = keyed(documents, id_col, text_col)
    spans = repeated_spans(rows, windows, "u1", earlier_windows)
    joined = rows.join(spans, ["_id", "_h"], "left").select("_id", "_text", "spans")
    out = joined.mapInArrow(_result_batches, RESULT)
    return out.select(id_or_null().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
