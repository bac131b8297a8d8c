"""Duplicate word runs by relative Lempel-Ziv parsing.

The fragments that ``seeds`` brings together form reference blocks. Each fragment is factored greedily against the
part of its block that stands before it: a factor is the longest copy of an earlier place. A greedy factor hides
windows that begin inside it and end behind it, so those at its boundary are looked up one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame

from closeworks.llm.common import id_or_null
from closeworks.llm.seeds import Block, Windows, keyed, merged, repeated_spans, window_ranks


def text_words(text: str) -> list[bytes]:
    """Words as bytes. Bytes split at the six ASCII separators only, as the definition has it."""
    return text.encode("utf-8").split()


def word_symbols(text: str) -> np.ndarray:
    """64-bit hashes (SipHash) of the words of a text, all in one call."""
    return hash_array(np.array(text_words(text), dtype=object), categorize=False)


def earliest_places(ranks: np.ndarray) -> np.ndarray:
    """For each place the earliest place with the same window."""
    places = np.argsort(ranks * len(ranks) + np.arange(len(ranks)))
    new = np.diff(ranks[places], prepend=-1) != 0
    heads = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
    out = np.empty(len(ranks), dtype=np.int64)
    out[places] = heads
    return out


def parse(block: Block, fragment: int, window: int, earliest: np.ndarray) -> np.ndarray:
    """Factor one fragment greedily; which of its windows occur earlier. A factor's source stays in one fragment."""
    text, start, windows = block.text, int(block.starts[fragment]), int(block.windows[fragment])
    hit = np.zeros(windows, dtype=bool)
    end, at = start + windows + window - 1, start
    while at < start + windows:
        source = int(earliest[at])
        if source >= at:
            at += 1
            continue
        owner = int(np.searchsorted(block.starts, source, "right")) - 1
        limit = int(block.starts[owner] + block.windows[owner]) + window - 1
        length = window
        while at + length < end and source + length < limit and text[source + length] == text[at + length]:
            length += 1
        hit[at - start : at - start + length - window + 1] = True
        # Windows that begin in the factor's last words end behind it.
        at += length - window + 1
        stop = min(at + window - 1, start + windows)
        inside = np.arange(at, stop)
        hit[inside - start] = earliest[inside] < inside
        at = stop
    return hit


def earlier_windows(block: Block, window: int) -> list[np.ndarray]:
    earliest = earliest_places(window_ranks(block, window))
    return [parse(block, f, window, earliest) for f in range(len(block.starts))]


WORDS = Windows(window=20, gram=6, symbols=word_symbols, block=1 << 18)

RESULT = "_id long, n_words long, n_removed long, kept_sha256 string"


def _result_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, digests = [], [], []
        for text, spans in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist()):
            words, kept, at = text_words(text), [], 0
            for a, b in merged(spans):
                kept += words[at:a]
                at = b
            kept += words[at:]
            sizes.append(len(words))
            removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        arrays = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), *arrays], names=["_id", "n_words", "n_removed", "kept_sha256"]
        )


def dedup_words(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", windows: Windows = WORDS
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256``, one row per row of ``documents``.

    A word is removed if a window of 20 words that covers it also starts earlier: in a document with a smaller
    id, or earlier in the same one. Words are compared as they are, by hashes of 64 bits. A null text has no
    words. A null id counts as the smallest id and stays null. Rows with the same id and text are one document and
    get equal results; texts that share an id stand in the order of a hash. Other columns are not looked at.
    """
    rows = keyed(documents, id_col, text_col)
    spans = repeated_spans(rows, windows, "u8", earlier_windows)
    joined = rows.join(spans, ["_id", "_h"], "left").select("_id", "_text", "spans")
    out = joined.mapInArrow(_result_batches, RESULT)
    return out.select(id_or_null().alias("doc_id"), "n_words", "n_removed", "kept_sha256")
