"""Benchmark decontamination by q-gram filtering and banded alignment.

An item occurs in a text if some region of the text comes from the item by at most k edits, k being a share of
the item's length. Such a region shares at least m - q + 1 - k * q of the item's q-grams (m its length), and they
lie within k diagonals of each other. Hits are counted in bands of diagonals that overlap by half, each wide
enough for one region; bands that reach the bound are verified by an alignment that stays in the band.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import dropped, id_of, id_or_null, stored, text_of

#: Characters of items that one pass over the documents looks for; what is broadcast is about 40 times that in bytes.
BLOCK_CHARS = 1 << 20
#: Characters of text that are worked on at a time.
CHUNK_CHARS = 1 << 19

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Budget:
    """``q``: length of the grams. ``edit_share``: edits allowed per character of an item."""

    q: int = 10
    edit_share: float = 0.06

    def edits(self, m: int) -> int:
        """Edits for an item of ``m`` characters: no more than leave one shared gram; 0 if it is shorter than a gram."""
        return max(0, min(int(self.edit_share * m), (m - self.q) // self.q))


def normal(text: str) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join(text.lower().split())


def gram_codes(points: np.ndarray, q: int) -> np.ndarray:
    """A hash of each window of ``q`` code points, by joining windows of half the length."""
    n = len(points) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    code, size, done, have = points.astype(np.uint64), 1, None, 0
    rest = q
    while rest:
        if rest & 1:
            done = code if done is None else done[: len(code) - have] * MULTIPLIER + code[have:] if have else code
            have += size
        rest >>= 1
        if rest:
            a, b = code[:-size], code[size:]
            code = (a * MULTIPLIER + b) ^ (a >> np.uint64(29))
            size *= 2
    return done[:n]


def _spread(low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each ``low`` on, ``n`` of them, and the row each belongs to."""
    of = np.repeat(np.arange(len(n)), n)
    return low[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n), of


def _summed(rows: np.ndarray) -> np.ndarray:
    """Rows of (text, item, slot, n), sorted, with the counts of equal ones added up."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.flatnonzero(np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)))
    return np.column_stack([rows[first, :3], np.add.reduceat(rows[:, 3], first)])


class Index:
    """Grams of a block of items, sorted, behind a bitmap of their lowest bits.

    Places of one gram in one item that lie no further apart than a band's step are one entry, from the first to the
    last of them: a place in a text then meets every slot of diagonals between the two, none in between is left out.
    So a gram that an item repeats costs a few slots per place in a text, not one pair per repeat.
    """

    BITS = 22
    #: Slots that are counted at a time.
    SLOTS = 1 << 21
    #: Diagonals that bands are joined to.
    DIAGONALS = 1 << 14

    def __init__(self, items: list[tuple[int, str]], budget: Budget):
        self.budget = budget
        self.items = [(i, t) for i, t in ((i, normal(t)) for i, t in items) if t]
        self.exact = [n for n, (_, t) in enumerate(self.items) if len(t) < budget.q]
        self.edits = np.array([budget.edits(len(t)) for _, t in self.items], dtype=np.int64)
        codes, owners, places = [], [], []
        for n, (_, t) in enumerate(self.items):
            c = gram_codes(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), budget.q)
            codes.append(c)
            owners.append(np.full(len(c), n))
            places.append(np.arange(len(c)))
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, dtype=kind)
        code, owner, place = join(codes, np.uint64), join(owners, np.int64), join(places, np.int64)
        order = np.lexsort((place, owner, code))
        code, owner, place = code[order], owner[order], place[order]
        new = np.ones(len(code), dtype=bool)
        new[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1]) | (np.diff(place) > self.edits[owner[1:]] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(code))[: len(first)] - 1
        self.code, self.owner, self.first, self.last = code[first], owner[first], place[first], place[last]
        self.bitmap = np.zeros(1 << self.BITS, dtype=bool)
        self.bitmap[self.code & np.uint64((1 << self.BITS) - 1)] = True

    def slots(self, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, slot, n), sorted: places of the text that share a gram with the item in a slot of diagonals.

        ``points`` holds several texts, each from its place in ``starts``. A slot is as many diagonals as the item
        may have edits, and one. A place counts once per slot, however often the item repeats the gram there.
        """
        codes = gram_codes(points, self.budget.q)
        at = np.flatnonzero(self.bitmap[codes & np.uint64((1 << self.BITS) - 1)])
        low, high = np.searchsorted(self.code, codes[at], "left"), np.searchsorted(self.code, codes[at], "right")
        at, low, n = at[high > low], low[high > low], (high - low)[high > low]
        parts = [np.zeros((0, 4), dtype=np.int64)]
        done, ends = 0, np.cumsum(n)
        while done < len(at):
            until = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + self.SLOTS // 16, "right")))
            entry, place = _spread(low[done:until], n[done:until])
            parts.append(self._count(entry, at[done:until][place], starts))
            if sum(len(p) for p in parts[1:]) > self.SLOTS:
                parts = [_summed(np.concatenate(parts))]
            done = until
        return tuple(_summed(np.concatenate(parts)).T)

    def _count(self, entry: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
        text = np.searchsorted(starts, at, "right") - 1
        inside, step = at - starts[text], self.edits[self.owner[entry]] + 1
        low, high = (inside - self.last[entry]) // step, (inside - self.first[entry]) // step
        slot, of = _spread(low, high - low + 1)
        # Entries of one gram and item lie more than a step apart, so no two of them meet in a slot.
        return _summed(np.stack([text[of], self.owner[entry][of], slot, np.ones(len(of), dtype=np.int64)], axis=1))

    def regions(self, item: np.ndarray, slot: np.ndarray, held: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first diagonal, last diagonal) of the bands, two slots each, that reach the bound of their item.

        Takes the slots of one text, sorted. Bands of an item come in the order of their diagonals; those that overlap
        are joined, up to a width, as one alignment of both costs less than two.
        """
        length = np.array([len(self.items[n][1]) for n in item.tolist()], dtype=np.int64)
        k = self.edits[item]
        least = length - self.budget.q + 1 - k * self.budget.q
        after = np.zeros(len(item), dtype=bool)
        after[:-1] = (item[1:] == item[:-1]) & (slot[1:] == slot[:-1] + 1)
        with_next = held + np.where(after, np.append(held[1:], 0), 0) >= least
        before = np.append(False, after[:-1])
        alone = ~before & (held >= least)
        rows = [(item[alone], slot[alone] - 1, k[alone]), (item[with_next], slot[with_next], k[with_next])]
        n, s, k = (np.concatenate(x) for x in zip(*rows))
        order = np.lexsort((s, n))
        n, s, step = n[order], s[order], k[order] + 1
        out: list[tuple[int, int, int]] = []
        for n, first, last in zip(n.tolist(), (s * step).tolist(), ((s + 2) * step - 1).tolist()):
            margin = 2 * int(self.edits[n])  # an alignment looks that far beyond its band, half of it on each side
            if out and out[-1][0] == n and first <= out[-1][2] + margin and last - out[-1][1] < self.DIAGONALS:
                out[-1] = (n, out[-1][1], last)
            else:
                out.append((n, first, last))
        return out

    def find(self, text: str, slots: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits) in a normalised text: the best region of each item."""
        best: dict[int, tuple[int, int, int]] = {}
        for n, first, last in self.regions(*slots):
            if n in best and best[n][0] == 0:
                continue  # bands further on hold no earlier unchanged region
            item = self.items[n][1]
            k = self.budget.edits(len(item))
            start = max(0, first - k)
            window = text[start : last + len(item) + k]
            found = window.find(item)
            if found >= 0:
                edits, a, b = 0, found, found + len(item)
            else:
                edits, a, b = banded_alignment(item, window, first - k - start, last + k - start)
            if edits <= k and (n not in best or (edits, start + a) < best[n][:2]):
                best[n] = (edits, start + a, start + b)
        for n in self.exact:
            if (a := text.find(self.items[n][1])) >= 0:
                best[n] = (0, a, a + len(self.items[n][1]))
        return [(n, a, b, e) for n, (e, a, b) in sorted(best.items())]


def banded_alignment(item: str, window: str, first: int, last: int) -> tuple[int, int, int]:
    """Fewest edits between all of ``item`` and a part of ``window``, and that part.

    The alignment keeps to the diagonals (place in window - place in item) from ``first`` to ``last``. Ends in the
    window are free. Each row of the table is worked out at once; inserted characters are a running minimum.
    """
    x = np.frombuffer(window.encode("utf-32-le"), dtype=np.uint32)
    p = np.frombuffer(item.encode("utf-32-le"), dtype=np.uint32)
    width, far = last - first + 1, len(p) + len(x) + 1
    steps = np.arange(width)
    columns = first + steps  # place in the window of diagonal j in row 0
    cost = np.where((columns >= 0) & (columns <= len(x)), 0, far)
    origin = columns.copy()
    for i in range(1, len(p) + 1):
        columns = first + i + steps
        inside = (columns >= 1) & (columns <= len(x))
        same = np.zeros(width, dtype=bool)
        same[inside] = x[columns[inside] - 1] == p[i - 1]
        across = cost + ~same
        across[~inside] = far
        down = np.append(cost[1:] + 1, far)
        down[(columns < 0) | (columns > len(x))] = far
        new = np.minimum(across, down)
        start = np.where(across <= down, origin, np.append(origin[1:], 0))
        level = new - steps
        run = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == run, steps, -1))
        cost, origin = np.minimum(run + steps, far), start[source]
        cost[(columns < 0) | (columns > len(x))] = far
    j = int(np.argmin(cost))
    return int(cost[j]), int(origin[j]), int(first + len(p) + j)


def _texts_matches(index: Index, texts: list[str]) -> Iterator[tuple[int, str, list[tuple[int, int, int, int]]]]:
    """(row, normalised text, matches) of the texts that have any. Texts are worked on together in chunks."""
    if not index.items:
        return
    row = 0
    while row < len(texts):
        part, chars, first = [], 0, row
        while row < len(texts) and (not part or chars < CHUNK_CHARS):
            part.append(normal(texts[row]))
            chars += len(part[-1]) + 1
            row += 1
        # No item holds a NUL that the text lacks, and a text's own NULs only take hits away from their place.
        starts = np.cumsum([0] + [len(t) + 1 for t in part])
        points = np.frombuffer("\0".join(part).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        owner, item, slot, held = index.slots(points, starts)
        bounds = np.searchsorted(owner, np.arange(len(part) + 1))
        for i, text in enumerate(part):
            a, b = bounds[i], bounds[i + 1]
            if b > a or index.exact:
                found = index.find(text, (item[a:b], slot[a:b], held[a:b]))
                if found:
                    yield first + i, text, found


MATCH_SCHEMA = "_id long, item_id long, start long, end long, edits long, matched string"


def _match_batches(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id").to_pylist()
            rows = [
                (ids[r], index.items[n][0], a, b, e, text[a:b])
                for r, text, found in _texts_matches(index, batch.column("_text").to_pylist())
                for n, a, b, e in found
            ]
            names = ["_id", "item_id", "start", "end", "edits", "matched"]
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64()] * 5 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Items in order, in blocks of about ``block_chars`` characters; the driver holds one block at a time."""
    block, chars = [], 0
    ordered = benchmark.select(id_of(item_col).alias("_item"), text_of(text_col).alias("_text"))
    for row in ordered.orderBy("_item", "_text").toLocalIterator():
        block.append((row["_item"], row["_text"]))
        chars += len(row["_text"])
        if chars >= block_chars:
            yield block
            block, chars = [], 0
    if block:
        yield block


def _with_more(blocks: Iterator) -> Iterator[tuple]:
    """Each block, and whether another one follows."""
    block = next(blocks, None)
    while block is not None:
        after = next(blocks, None)
        yield block, after is not None
        block = after


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    budget: Budget = Budget(),
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id, item_id, start, end, edits, matched``: the best region of each item in each document that has one.

    Places count in the normalised text (lower case, single spaces), end exclusive. The benchmark is the query
    set: it is passed over all documents in blocks of bounded size. The matches of all blocks but the last are stored
    before the next block is read, so the driver holds one index, and the items of the next block. Null and empty texts have no match and are
    no items; an item shorter than a gram must occur unchanged. Repeated rows and items give repeated
    matches; null ids stay null; other columns are not looked at.
    """
    rows = documents.select(id_of(id_col).alias("_id"), text_of(text_col).alias("_text"))
    out = documents.sparkSession.createDataFrame([], MATCH_SCHEMA)
    for block, more in _with_more(item_blocks(benchmark, item_col, item_text_col, block_chars)):
        found = rows.mapInArrow(_match_batches(Index(block, budget)), MATCH_SCHEMA)
        out = out.unionByName(stored(found) if more else found)
    return out.select(id_or_null().alias("doc_id"), id_or_null("item_id").alias("item_id"), "start", "end", "edits", "matched")


def _leaked(index: Index):
    """Function of a column of texts: whether an item of the block occurs."""

    @F.pandas_udf("boolean")
    def leaked(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            hit = np.zeros(len(texts), dtype=bool)
            for row, _, _ in _texts_matches(index, texts.tolist()):
                hit[row] = True
            yield pd.Series(hit)

    return leaked


def drop_leaked(
    documents: DataFrame, benchmark: DataFrame, budget: Budget = Budget(), block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The rows of ``documents`` in whose ``text`` no benchmark item occurs.

    Blocks of the benchmark are worked off one after the other; what one keeps is stored for the next.
    """
    before = None
    for block, more in _with_more(item_blocks(benchmark, "item_id", "text", block_chars)):
        kept = documents.filter(~_leaked(Index(block, budget))(text_of("text")))
        if not more:
            return kept
        documents = stored(kept)
        if before is not None:
            dropped(before)
        before = documents
    return documents
