"""Near duplicates by a join in the metric space of Jaccard distances.

Distance is 1 - Jaccard similarity; documents link at a distance of at most 1/4.

1. Candidates. Linked sets share a shingle in any quarter of either, so shingles with a small hash suffice to bring them
   together, and a set leaves the join when more than a quarter of its shingles occur in no other set.
2. Pivots. Of the sets that hold a shingle the one with the fewest shingles of its own is a candidate, as the original of
   many near copies is; candidates without a stronger one near them are pivots. Sets farther than ``COVER`` from every pivot
   choose among themselves, and what is left after some rounds are pivots too. The nearest pivot found so is the home of a set.
3. Regions. Let x and y link, and y be no farther from its home than x. Then x is at most 1/4 + d(y, home of y) from the home
   of y, which is at most 1/4 + d(x, home of x) and at most 1/4 + the largest distance of a set at home there: so a set is
   replicated to the pivots in both windows, and every link is met in a region where one of both is at home.
   Distances are measured only to the homes of sets that it may link with. A set with more than a quarter of shingles that no
   set of another home has can link with none there. With the shingles of the others in one order, rarest first, linked sets
   share one of their first, and have room for enough to share behind it (see ``_meetings``). So a passage that many sets have
   brings no pairs, unless it is most of them.
4. Rings. Around its pivot a region is cut into rings a quarter wide; by the triangle inequality only members of
   neighbouring rings can link. A ring with many members is cut once more, into blocks. Two blocks at a time are joined
   in a task, exactly; it returns only links that connect what it does not know to be connected yet.
5. Links become components. Regions whose members are in one component through their pivots are not joined at all.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closeworks.llm.common import NULL_ID, ROW_BITS, bitmap, dropped, has_bit, id_of, id_or_null, row_place, stored, text_of
from closeworks.llm.components import components
from closeworks.llm.seeds import gram_hashes, keyed

SHINGLE = 5
KNOWN_WORDS = 300_000
#: Sets of no more shingles count with all of them.
SMALL = 128
#: Sets are at most so far from their home, or pivots themselves; less than 3/4, so that windows end before distance 1.
COVER = 0.45
#: Sizes of linked sets differ by a factor of 4/3 at most, less than from one band of sizes to the next but one.
SIZE_BAND = 1.4
#: Rounds in which sets without a near pivot choose pivots among themselves.
PIVOT_ROUNDS = 4
#: Sets and shingles of a block, about. Two blocks meet in a task.
BLOCK_SETS = 1024
BLOCK_SHINGLES = 1 << 20
#: Bits that tell which shingles may be shared, 8 MB whatever the input is, as ``ROW_BITS`` tell which rows are looked at for their
#: whole sets. Where they fill up, more rows are shuffled in vain; the result does not depend on them.
SHINGLE_BITS = 1 << 26
#: Columns of the incidence matrix that are multiplied at once.
COLUMNS = 4096


class WordHashes(dict):
    """64-bit hashes of words in lower case; those seen first are remembered."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) < KNOWN_WORDS and len(word) < 64:
            self[word] = value
        return value


_HASHES = WordHashes()


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words, A-Z lowered; of all words if there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    symbols = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    return np.unique(gram_hashes(symbols, min(size, len(words))) + np.uint64(len(words) if len(words) < size else 0))


def share_used(n: float) -> float:
    """Share of the hash range in which a set of ``n`` shingles counts; a little over a quarter, all for small sets."""
    return 1.0 if n <= SMALL else min(1.0, 0.28 + 1.2 / math.sqrt(n))


def _bound(share: float) -> int:
    return min(int(share * 2.0**64), (1 << 64) - 1)


@dataclass(frozen=True)
class Profile:
    """A set, the part of it that counts, and the part that smaller sets may look for."""

    shingles: np.ndarray

    @property
    def key(self) -> tuple[int, int]:
        return struct.unpack("<qq", hashlib.blake2b(self.shingles.tobytes(), digest_size=16).digest())

    def counted(self) -> int:
        return int(np.searchsorted(self.shingles, np.uint64(_bound(share_used(len(self.shingles)))), "right"))

    def sent(self) -> int:
        """All, if what counts is no more than a quarter of the set: then it could miss a shared shingle."""
        n = len(self.shingles)
        if self.counted() <= n // 4:
            return n
        least = _bound(share_used(math.floor(0.75 * n)))
        return int(np.searchsorted(self.shingles, np.uint64(least), "right"))


def _profile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and key of the set of each text, and what of it is sent: of equal sets of a batch once, the others send NULL."""
    for batch in batches:
        n, k1, k2, counted, sent, seen = [], [], [], [], [], set()
        for text in batch.column("_text").to_pylist():
            p = Profile(shingle_set(text))
            a, b = p.key
            n.append(len(p.shingles))
            k1.append(a)
            k2.append(b)
            counted.append(p.counted())
            sent.append(None if (a, b) in seen or not len(p.shingles) else p.shingles[: p.sent()].view(np.int64))
            seen.add((a, b))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_h"), *[pa.array(x, pa.int64()) for x in (n, k1, k2, counted)],
             pa.array(sent, pa.list_(pa.int64()))],
            names=["_id", "_h", "n", "k1", "k2", "counted", "sent"],
        )


def _set_batches(bits: bytes):
    """Key and whole set of each text whose row may be among those in ``bits``; a task sends a set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = np.frombuffer(bits, dtype=np.uint8), set()
        for batch in batches:
            place = batch.column("_place").to_numpy()
            wanted = np.flatnonzero(has_bit(known, place))
            profiles = {p.key: p for p in (Profile(shingle_set(t)) for t in batch.column("_text").take(pa.array(wanted)).to_pylist())}
            keys = [k for k in profiles if k not in seen]
            profiles = [profiles[k] for k in keys]
            seen.update(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array([p.shingles.view(np.int64) for p in profiles], pa.list_(pa.int64()))],
                names=["k1", "k2", "shingles"],
            )

    return run


def _sent_batches(bits: bytes):
    """A row per sent shingle that may be shared, with its place in the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bits, dtype=np.uint8)
        for batch in batches:
            column = batch.column("sent")
            ends = column.offsets.to_numpy()
            flat = column.values.to_numpy()[ends[0] : ends[-1]]
            kept = np.flatnonzero(has_bit(known, flat & (SHINGLE_BITS - 1)))
            row = np.searchsorted(ends - ends[0], kept, "right") - 1
            plain = [pa.array(batch.column(c).to_numpy()[row]) for c in ("k1", "k2", "n", "counted")]
            place = pa.array(kept - (ends - ends[0])[row], pa.int64())
            yield pa.RecordBatch.from_arrays([*plain, place, pa.array(flat[kept])], names=["k1", "k2", "n", "counted", "place", "shingle"])

    return run


def _whole_sets(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, shingles`` of ``nodes`` (node, k1, k2, _id, _h), from one text each.

    Bits of a fixed number tell the tasks which rows to look at, so other texts are not shuffled. A row that the bits let
    through in vain goes when its key finds no node.
    """
    place = row_place("_id", "_h")
    bits = bitmap(nodes.select(place.alias("place")), ROW_BITS)
    found = rows.select(place.alias("_place"), "_text").mapInArrow(_set_batches(bits), "k1 long, k2 long, shingles array<long>")
    # Several tasks may send the set; which of them it is from is all the same.
    return stored(found.dropDuplicates(["k1", "k2"]).join(nodes.select("node", "k1", "k2"), ["k1", "k2"]).select("node", "shingles"))


def _distance(both: Column, a: Column, b: Column) -> Column:
    return F.lit(1.0) - both / (a + b - both)


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with their distance ``d`` and whether they link. ``sets``: (node, n, shingles)."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    counted = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("both"))
    return counted.select(
        "a", "b", _distance(F.col("both"), F.col("na"), F.col("nb")).alias("d"),
        (F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * 75).alias("linked"),
    )


def _ordered(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``node, n, shingles`` from ``rows`` (node, shingle): the shingles that another set has too, those of the fewest sets first.

    With a column ``home`` in ``rows``, the shingles that a set of another home has too. A shingle is once in what is joined
    to the rows, so that side of a partition is hashed and the rows need no sort.
    """
    several = F.min("home") != F.max("home") if "home" in rows.columns else F.count("*") > 1
    shared = rows.groupBy("shingle").agg(F.count("*").alias("sets"), several.alias("several")).filter("several").drop("several")
    held = (
        rows.select("node", "shingle").join(shared.hint("shuffle_hash"), "shingle").repartition("node")
        .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("sets", "shingle"))).alias("held"))
    )
    return held.join(sizes, "node").select("node", "n", F.col("held.shingle").alias("shingles"))


def _open_sets(whole: DataFrame, sizes: DataFrame, homes: DataFrame | None = None) -> DataFrame:
    """``node, n, shingles`` of sets with at most a quarter of shingles that no other set has, as ``_ordered`` has them.

    With ``homes`` (node, home), that no set of another home has: only such sets can link with one of another home.
    Each pass frees shingles for the next.
    """
    sets = whole
    for _ in range(2):
        placed = sets if homes is None else sets.join(homes.select("node", "home"), "node")
        rows = placed.select("node", *([] if homes is None else ["home"]), F.explode("shingles").alias("shingle"))
        before, sets = sets, stored(_ordered(rows, sizes).filter(F.col("n") - F.size("shingles") <= F.floor(F.col("n") / 4)))
        if before is not whole:
            dropped(before)
    return sets


def _first(similarity: Column) -> Column:
    """Shingles of which a set shares one with any set that is so similar.

    Such sets share at least ``similarity * n`` shingles, so fewer than that many may come after the first shared one. Shingles
    that no other set has would be the first in the order, and are not in the list. The other set may be cut by a
    similarity of its own: the first shingle that both have comes early enough in both.
    """
    needed = F.ceil(similarity * F.col("n") - 0.001)  # rounding may take one more, never one less
    return F.slice("shingles", F.lit(1), F.greatest(F.size("shingles") - needed + 1, F.lit(0)).cast("int"))


def _first_shingles(similarity: Column) -> Column:
    return F.explode(_first(similarity)).alias("shingle")


def _nearest(near: DataFrame) -> DataFrame:
    """``node, home, least, linked``: of each ``a`` of ``near`` (a, b, d, linked) the nearest ``b``."""
    first = near.groupBy("a").agg(F.min(F.struct("d", "b", "linked")).alias("at"))
    return first.select(F.col("a").alias("node"), F.col("at.b").alias("home"), F.col("at.d").alias("least"), "at.linked")


def _at_itself(pivots: DataFrame) -> DataFrame:
    return pivots.select("node", F.col("node").alias("home"), F.lit(0.0).alias("least"), F.lit(True).alias("linked"))


def _homes(sets: DataFrame) -> DataFrame:
    """``node, home, least, linked``: for each of ``sets`` (see ``_open_sets``) a pivot near it; see step 2 of the module.

    The strongest holder of a shingle is a candidate, and a pivot if no stronger candidate is near it. Sets near a
    pivot are covered and leave; so a group has few pivots, however many shingles it has. A pivot is at home at itself.
    """
    homes, left = None, sets
    # Linked sets differ in at most a seventh of their sizes together; less the shingles that are the set's own.
    slack = F.col("n") / 7 - (F.col("n") - F.size("shingles"))
    strength = ((slack * 1024).cast("long") * (1 << 32) + F.pmod(F.xxhash64("node"), F.lit(1 << 32))).alias("strength")
    for _ in range(PIVOT_ROUNDS):
        rows = left.select("node", strength, _first_shingles(F.lit(1 - COVER)))
        heads = stored(rows.groupBy("shingle").agg(F.max_by("node", "strength").alias("pivot")))
        pairs = rows.join(heads.hint("shuffle_hash"), "shingle").filter("node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        near = stored(_measured(pairs.distinct(), left).filter(F.col("d") <= COVER))
        chosen = stored(
            heads.select(F.col("pivot").alias("node")).distinct().join(near.select(F.col("a").alias("node")).distinct(), "node", "left_anti")
        )
        covered = _nearest(near.join(chosen.withColumnRenamed("node", "b"), "b"))
        settled = stored(covered.unionByName(_at_itself(chosen)))
        homes = settled if homes is None else homes.unionByName(settled)
        left = stored(left.join(settled, "node", "left_anti"))
        if left.isEmpty():
            break
    return stored(homes.unionByName(_at_itself(left)))


def _meetings(sets: DataFrame, sizes: DataFrame, homes: DataFrame) -> DataFrame:
    """``a, b``: sets and pivots other than their homes at which a set may be at home that they link with.

    Sets that cannot link with one of another home leave first. Of the others, two that link share one of their first
    shingles. Seen from the first one that both have, neither has more to share than what comes from there on, and linked sets
    share 3/7 of their sizes together; one is at most a third larger, so it is in the same or the next band; and one of the two
    is no farther from its home. Extremes over the sets of a home and a band that hold the shingle tell whether one may be so.
    """
    border = _open_sets(sets, sizes, homes).join(homes.select("node", "home", "least"), "node")
    held = border.select("*", F.size("shingles").alias("held"), F.posexplode(_first(F.lit(0.75))).alias("place", "shingle"))
    firsts = stored(held.select(
        "shingle", F.floor(F.log(F.col("n")) / math.log(SIZE_BAND)).cast("int").alias("band"), "node", "home", "least", "n",
        ((F.col("held") - F.col("place")) * 7 - F.col("n") * 3).alias("spare"),
    ))
    of_home = firsts.groupBy("shingle", F.col("home").alias("pivot"), "band").agg(
        F.min("least").alias("lo"), F.min("n").alias("n_lo"), F.max("n").alias("n_hi"), F.max("spare").alias("spare_hi")
    )
    bands = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band")
    may_link = (
        "home != pivot AND lo <= least AND 4 * n >= 3 * n_lo AND 4 * n_hi >= 3 * n AND spare >= 3 * n_lo AND spare_hi >= 3 * n"
    )
    met = firsts.join(of_home.select("shingle", "pivot", "lo", "n_lo", "n_hi", "spare_hi", bands), ["shingle", "band"]).filter(may_link)
    return stored(met.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct())


def _members(sets: DataFrame, sizes: DataFrame, homes: DataFrame) -> DataFrame:
    """``pivot, node, d, n, linked, home``: members of the regions; see step 3 of the module."""
    slack = 1e-9  # distances are doubles; a little more is replicated, never less
    radius = stored(homes.groupBy("home").agg(F.max("least").alias("radius")))
    pairs = _meetings(sets, sizes, homes)
    met = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    near = _measured(pairs, sets.join(met, "node", "left_semi")).withColumnRenamed("a", "node").withColumnRenamed("b", "pivot")
    replicas = (
        near.join(homes.select("node", "least"), "node").join(radius.withColumnRenamed("home", "pivot"), "pivot")
        .filter(F.col("d") <= F.least("least", "radius") + 0.25 + slack)
        .select("pivot", "node", "d", "linked", F.lit(False).alias("home"))
    )
    at_home = homes.select(F.col("home").alias("pivot"), "node", F.col("least").alias("d"), "linked", F.lit(True).alias("home"))
    return stored(at_home.unionByName(replicas).join(sizes, "node").select("pivot", "node", "d", "n", "linked", "home"))


def _regions(shingles: DataFrame, sizes: DataFrame, pivots: DataFrame) -> DataFrame:
    """Members of the regions of given ``pivots`` (node), with each set (rows node, shingle) at home at the nearest of them."""
    sets = stored(_ordered(shingles, sizes))
    rows = sets.select("node", _first_shingles(F.lit(1 - COVER)))
    of_pivot = rows.join(pivots, "node").select(F.col("node").alias("b"), "shingle")
    pairs = rows.join(pivots, "node", "left_anti").join(of_pivot, "shingle").select(F.col("node").alias("a"), "b").distinct()
    near = _measured(pairs, sets).filter(F.col("d") <= COVER)
    return _members(sets, sizes, stored(_nearest(near).unionByName(_at_itself(pivots))))


def _blocks(members: DataFrame) -> DataFrame:
    """Members with the two blocks (``lo``, ``hi``) they meet in, once for each; see step 4 of the module."""
    slack = 1e-9
    ringed = members.withColumn("ring", F.floor(F.col("d") / (0.25 + slack)).cast("int"))
    rings = ringed.groupBy("pivot", "ring").agg(F.count("*").alias("sets"), F.sum("n").alias("size"))
    cuts = rings.select(
        "pivot", "ring",
        F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("size") / BLOCK_SHINGLES), F.lit(1)).cast("int").alias("cuts"),
    )
    # There are at most five rings, so this is one small map per region.
    known = cuts.groupBy("pivot").agg(F.map_from_entries(F.collect_list(F.struct("ring", "cuts"))).alias("cuts"))
    placed = ringed.join(known, "pivot").withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(1)), F.try_element_at("cuts", "ring").cast("long")).cast("int")
    )
    own = F.struct("ring", "block")

    def of_ring(step: int) -> Column:
        ring = F.col("ring") + step
        cuts_there = F.coalesce(F.try_element_at("cuts", ring), F.lit(0))
        there = F.when(cuts_there > 0, F.sequence(F.lit(0), cuts_there - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(there, lambda b: F.struct(ring.alias("ring"), b.alias("block")))

    other = F.explode(F.concat(of_ring(-1), of_ring(0), of_ring(1))).alias("other")
    met = placed.select("pivot", "node", "home", own.alias("own"), other)
    return met.select(
        F.xxhash64("pivot", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "node", "home",
        (F.col("own") <= F.col("other")).alias("first"), (F.col("own") >= F.col("other")).alias("second"),
    )


def _join_unit(nodes: np.ndarray, labels: np.ndarray, home: np.ndarray, first: np.ndarray, second: np.ndarray, sets: list[np.ndarray]):
    """Links between the ``first`` and the ``second`` sets, of which one is at home, that connect different labels."""
    known = {}

    def root(x: int) -> int:
        while known.get(x, x) != x:
            known[x] = known.get(known[x], known[x])
            x = known[x]
        return x

    size = np.array([len(x) for x in sets], dtype=np.int64)
    one, two = np.flatnonzero(first), np.flatnonzero(second)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    again = np.zeros(len(flat), dtype=bool)
    same = ordered[1:] == ordered[:-1]
    again[1:] |= same
    again[:-1] |= same
    owner = np.repeat(np.arange(len(sets)), size)[order][again]
    column = np.cumsum(np.diff(ordered[again], prepend=ordered[again][:1]) != 0) if again.any() else np.zeros(0, dtype=np.int64)
    both = np.zeros((len(one), len(two)), dtype=np.float32)  # counts below 2^24 are exact
    row_of, column_of = np.full(len(sets), -1), np.full(len(sets), -1)
    row_of[one], column_of[two] = np.arange(len(one)), np.arange(len(two))
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [a, a + COLUMNS])
        width = int(column[hi - 1]) - a + 1
        sides = []
        for place, count in ((row_of, len(one)), (column_of, len(two))):
            side = np.zeros((count, width), dtype=np.float32)
            at = place[owner[lo:hi]]
            side[at[at >= 0], column[lo:hi][at >= 0] - a] = 1
            sides.append(side)
        both += sides[0] @ sides[1].T
    shared = both.astype(np.int64)
    linked = shared * 100 >= (size[one][:, None] + size[two][None] - shared) * 75
    linked &= (labels[one][:, None] != labels[two][None]) & (home[one][:, None] | home[two][None])
    for i, j in zip(*np.nonzero(linked)):
        a, b = root(int(labels[one[i]])), root(int(labels[two[j]]))
        if a != b:
            known[max(a, b)] = min(a, b)
            yield int(nodes[one[i]]), int(nodes[two[j]])


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each unit. Rows come sorted by unit; those of the last one wait for the next batch."""
    waiting: list[tuple] = []

    def joined(rows: list[tuple]) -> pa.RecordBatch:
        _, nodes, labels, home, first, second, sets = zip(*rows)
        few = [np.array(x) for x in (nodes, labels, home, first, second)]
        links = list(_join_unit(*few, list(sets))) if len(set(labels)) > 1 else []
        a, b = zip(*links) if links else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        column = batch.column("shingles")
        values, ends = column.values.to_numpy(), column.offsets.to_numpy()
        plain = [batch.column(c).to_pylist() for c in ("unit", "node", "label", "home", "first", "second")]
        for i, row in enumerate(zip(*plain)):
            if waiting and waiting[-1][0] != row[0]:
                yield joined(waiting)
                waiting = []
            waiting.append((*row, values[ends[i] : ends[i + 1]].copy()))
    if waiting:
        yield joined(waiting)


def link_sets(whole: DataFrame, sizes: DataFrame) -> DataFrame:
    """Links ``a, b`` between sets that connect all that are connected. ``whole``: (node, shingles); ``sizes``: (node, n)."""
    sets = _open_sets(whole, sizes)
    members = _members(sets, sizes, _homes(sets))
    by_pivot = members.filter("linked AND node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    labels = stored(components(by_pivot))
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node"))
    mixed = labelled.groupBy("pivot").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi")
    met = _blocks(members.join(mixed.select("pivot"), "pivot"))
    units = met.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node"))
    # Units of one component are left out before sets are moved.
    open_units = stored(units.groupBy("unit").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("unit"))
    rows_of_units = stored(units.join(open_units, "unit")).join(whole, "node")
    columns = ["unit", "node", "label", "home", "first", "second", "shingles"]
    sorted_rows = rows_of_units.select(*columns).repartition("unit").sortWithinPartitions("unit", "node")
    found = sorted_rows.mapInArrow(_unit_batches, "a long, b long")
    return stored(by_pivot.unionByName(found))


def _linked_rows(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id, _h, n, first``, one row per row of ``documents``, known by id and hash of the text.

    ``first`` is the smallest row of the component: (without an id, id, hash of the text), so that ids come before nulls.
    """
    rows = keyed(documents, id_col, text_col)
    profiled = stored(
        rows.mapInArrow(_profile_batches, "_id long, _h long, n long, k1 long, k2 long, counted long, sent array<long>")
    )
    base = stored(profiled.drop("sent"))
    own = F.struct((F.col("_id") == NULL_ID).alias("no_id"), "_id", "_h")
    # Sets are numbered, as ids of documents may be null or repeat. The numbers are stored before they are used.
    sets = stored(
        base.filter("n > 0").groupBy("k1", "k2").agg(
            F.min(own).alias("first"), F.max("n").alias("n"), F.max("counted").alias("counted")
        ).withColumn("node", F.monotonically_increasing_id())
    )
    sent = profiled.filter("sent IS NOT NULL").select("k1", F.explode("sent").alias("shingle"))
    # Shingles of one set only are most of all rows; they go here, by the first half of the set's key.
    # Stored, so that the shuffle is freed before the next one and a hot shingle can be split in the join.
    shared = stored(
        sent.groupBy("shingle").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).filter("lo != hi").select("shingle")
    )
    bits = bitmap(shared.select(F.pmod("shingle", F.lit(SHINGLE_BITS)).alias("place")), SHINGLE_BITS)
    likely = profiled.filter("sent IS NOT NULL").select("k1", "k2", "n", "counted", "sent").mapInArrow(
        _sent_batches(bits), "k1 long, k2 long, n long, counted long, place long, shingle long"
    )
    # All of a set's rows meet in one place, which also tells how many of its shingles others have.
    mine = Window.partitionBy("k1", "k2")
    found = (
        likely.join(shared.hint("shuffle_hash"), "shingle").repartition("k1", "k2")
        .groupBy("k1", "k2", "shingle").agg(F.min("place").alias("place"), F.max("n").alias("n"), F.max("counted").alias("counted"))
        .withColumn("seen", F.count_if(F.col("place") < F.col("counted")).over(mine))
        .filter(F.col("counted") - F.col("seen") <= F.floor(F.col("n") / 4))
        .select("k1", "k2").distinct()
    )
    nodes = stored(found.join(sets, ["k1", "k2"]).select("node", "k1", "k2", "first._id", "first._h"))
    dropped(shared)
    dropped(profiled)
    links = link_sets(_whole_sets(rows, nodes), sets.select("node", "n"))
    labelled = sets.join(components(links), "node", "left").select(
        "k1", "k2", "first", F.coalesce("component", "node").alias("_c")
    )
    least = labelled.groupBy("_c").agg(F.min("first").alias("first"))
    of_set = stored(labelled.drop("first").join(least, "_c").select("k1", "k2", "first"))
    linked = base.filter("n > 0").join(of_set, ["k1", "k2"]).select("_id", "_h", "n", "first")
    return linked.unionByName(base.filter("n = 0").select("_id", "_h", "n", own.alias("first")))


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``documents``.

    Sets with equal shingles are one set from the start. A document without words, null texts among them, has no
    shingle and is its own component. Rows are known by id and text: different texts with one id, or without an id,
    link by their texts only. ``component_id`` is the smallest id of the component, null if no row in it has
    one. Other columns are not looked at.
    """
    return _linked_rows(documents, id_col, text_col).select(
        id_or_null().alias("doc_id"), F.col("n").alias("n_shingles"), id_or_null("first._id").alias("component_id")
    )


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the row with its smallest id, or without any id the smallest hash; the columns of ``documents``.

    Of rows that share both id and text one stays.
    """
    found = _linked_rows(documents.select(id_col, text_col), id_col, text_col)
    first = found.filter((F.col("_id") == F.col("first._id")) & (F.col("_h") == F.col("first._h"))).select("_id", "_h")
    boxed = documents.select(
        id_of(id_col).alias("_id"), F.xxhash64(text_of(text_col)).alias("_h"), F.struct(*documents.columns).alias("_row")
    )
    return boxed.join(first.distinct(), ["_id", "_h"], "left_semi").dropDuplicates(["_id", "_h"]).select("_row.*")
