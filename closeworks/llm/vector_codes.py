"""Vector codes by product quantisation, with whole-number k-means on metric trees.

Vectors are cut into parts. In each task, blocks of vectors become one tree per part, built once from the middle: anchors
take over the points that are nearer to them, neighbouring anchors are merged upwards, and each anchor is split by the
same rule downwards. A ball caches number and sum of its points. In each round the codebook goes down the trees: a
ball inherits the entries its parent left over and drops those that lose to another one on all of the ball. When one is left,
the ball is wholly owned, and its cached sums count without a look at its points. Sums per entry meet in Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import stored

#: Largest whole number of a component, so that sums of squares stay exact.
LARGEST = 1 << 26


@dataclass(frozen=True)
class Codes:
    """``block``: vectors of a tree, fewer where they are long (``numbers``); ``leaf``: points of a ball that is not split."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    block: int = 4096
    numbers: int = 1 << 21
    leaf: int = 24


# --- trees ------------------------------------------------------------------


@dataclass
class Tree:
    """Balls in preorder over points in the order ``place``: those of ball i are ``first[i]`` to ``first[i] + count[i]``, and
    its subtree ends before ball ``after[i]``. A leaf has ``after[i] == i + 1``."""

    place: np.ndarray
    first: np.ndarray
    count: np.ndarray
    after: np.ndarray
    radius: np.ndarray
    sums: np.ndarray

    FIELDS = ("place", "first", "count", "after", "radius", "sums")

    def packed(self) -> list[bytes]:
        kinds = (np.int32, np.int32, np.int32, np.int32, np.float64, np.int64)
        return [np.ascontiguousarray(getattr(self, f), k).tobytes() for f, k in zip(self.FIELDS, kinds)]

    @classmethod
    def unpacked(cls, raw: list[bytes], width: int) -> Tree:
        kinds = (np.int32, np.int32, np.int32, np.int32, np.float64, np.int64)
        out = [np.frombuffer(r, k) for r, k in zip(raw, kinds)]
        out[-1] = out[-1].reshape(-1, width)
        return cls(*out)


def _anchors(points: np.ndarray, wanted: int) -> list[np.ndarray]:
    """Members of each anchor. The farthest member of the widest anchor becomes the next one and takes what is nearer to it.

    Members of an anchor closer to it than half the distance of the two stay without being looked at.
    """
    owned = [np.arange(len(points))]
    centres = [points[0]]
    far = [np.sqrt(((points - points[0]) ** 2).sum(1))]
    widest = [far[0].max()]
    while len(owned) < wanted:
        a = int(np.argmax(widest))
        if widest[a] == 0:
            break
        new = points[owned[a][int(np.argmax(far[a]))]]
        taken, taken_far = [], []
        for b in range(len(owned)):
            between = float(np.sqrt(((centres[b] - new) ** 2).sum()))
            if 2 * widest[b] < between:
                continue
            open_ = np.flatnonzero(2 * far[b] >= between)
            d = np.sqrt(((points[owned[b][open_]] - new) ** 2).sum(1))
            moves = open_[d < far[b][open_]]
            if len(moves):
                taken.append(owned[b][moves])
                taken_far.append(d[d < far[b][open_]])
                owned[b], far[b] = np.delete(owned[b], moves), np.delete(far[b], moves)
                widest[b] = far[b].max() if len(far[b]) else 0.0
        owned.append(np.concatenate(taken))
        far.append(np.concatenate(taken_far))
        centres.append(new)
        widest.append(far[-1].max())
    return [o for o in owned if len(o)]


def _merged(points: np.ndarray, groups: list[np.ndarray]) -> tuple | int:
    """A binary tree over the groups as nested pairs: the two whose common ball would be smallest are merged first."""
    centre = np.array([points[g].mean(0) for g in groups])
    size = np.array([float(len(g)) for g in groups])
    radius = np.array([np.sqrt(((points[g] - c) ** 2).sum(1)).max() for g, c in zip(groups, centre)])
    nodes: list = list(range(len(groups)))
    gap = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(2)) + radius[:, None] + radius[None]
    np.fill_diagonal(gap, np.inf)
    last = 0
    for _ in range(len(groups) - 1):
        a, b = divmod(int(np.argmin(gap)), len(gap))
        joined = (centre[a] * size[a] + centre[b] * size[b]) / (size[a] + size[b])
        reach = [np.sqrt(((centre[x] - joined) ** 2).sum()) + radius[x] for x in (a, b)]
        nodes[a] = (nodes[a], nodes[b])
        centre[a], radius[a], size[a] = joined, max(reach), size[a] + size[b]
        gap[b, :] = gap[:, b] = np.inf
        alive = np.isfinite(gap[a])
        alive[b] = False
        row = np.where(alive, np.sqrt(((centre - centre[a]) ** 2).sum(1)) + radius + radius[a], np.inf)
        row[a] = np.inf
        gap[a, :] = gap[:, a] = row
        last = a
    return nodes[last]


def build_tree(points: np.ndarray, leaf: int) -> Tree:
    """The tree of whole-number ``points`` (n, width), n at least 1."""
    as_float = points.astype(np.float64)
    place, balls = [], []  # balls: (first, count, after)

    def add(members: np.ndarray) -> None:
        """One ball over ``members`` and all below it, in preorder."""
        todo: list = [("split", members)]
        open_balls: list[int] = []
        while todo:
            kind, x = todo.pop()
            if kind == "close":
                i = open_balls.pop()
                balls[i][1], balls[i][2] = len(place) - balls[i][0], len(balls)
            elif kind == "merged" and isinstance(x[0], tuple):
                balls.append([len(place), 0, 0])
                open_balls.append(len(balls) - 1)
                todo += [("close", None), ("merged", (x[0][1], x[1])), ("merged", (x[0][0], x[1]))]
            elif kind == "merged":
                todo.append(("split", x[1][x[0]]))
            else:
                groups = [x]
                if len(x) > leaf:
                    found = _anchors(as_float[x], max(2, int(np.sqrt(len(x)))))
                    groups = [x[g] for g in found]
                if len(groups) == 1:  # few points, or all in one place
                    balls.append([len(place), len(x), len(balls) + 1])
                    place.extend(x.tolist())
                else:
                    todo.append(("merged", (_merged(as_float, groups), groups)))

    add(np.arange(len(points)))
    order = np.array(place, dtype=np.int64)
    first, count, after = (np.array(c, dtype=np.int64) for c in zip(*balls))
    ordered = points[order]
    totals = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(ordered, 0, dtype=np.int64)])
    sums = totals[first + count] - totals[first]
    radius = np.empty(len(balls))
    for i, (a, n) in enumerate(zip(first, count)):
        centre = sums[i] / n
        radius[i] = np.sqrt(((ordered[a : a + n] - centre) ** 2).sum(1).max())
    return Tree(order, first, count, after, radius, sums)


# --- assignment -------------------------------------------------------------


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest entry, the first of equal ones, and its squared distance. Exact."""
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * top * top * points.shape[1] < 1 << 52:  # whole numbers that doubles hold exactly
        p, e = points.astype(np.float64), entries.astype(np.float64)
        d = (p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)[None]
    else:
        d = np.stack([((points - e) ** 2).sum(1) for e in entries], axis=1)
    at = d.argmin(1)
    return at, d[np.arange(len(at)), at].astype(np.int64)


def owners(tree: Tree, points: np.ndarray, entries: np.ndarray) -> Iterator[tuple[int, int, int | np.ndarray]]:
    """(ball, points from its first on, owner) for balls with one owner, or with an owner per point in leaves.

    ``points`` are in the order of the tree. An entry e leaves the list of a ball with centre c and radius r if the best entry b
    of the centre is nearer on the whole ball: |c-e|^2 - |c-b|^2 > 2 r |e-b|. Equal distances never drop an entry.
    """
    as_float = entries.astype(np.float64)
    todo = [(0, np.arange(len(entries)))]
    while todo:
        ball, left = todo.pop()
        if len(left) > 1:
            centre = tree.sums[ball] / tree.count[ball]
            those = as_float[left]
            d = ((those - centre) ** 2).sum(1)
            b = int(d.argmin())
            lead = d - d[b]
            # Distances are doubles here; a little more is kept, never less.
            reach = 2 * tree.radius[ball] * np.sqrt(((those - those[b]) ** 2).sum(1))
            left = left[lead <= reach + 1e-9 * (d + reach) + 1e-6]
        if len(left) == 1:
            yield ball, int(tree.count[ball]), int(left[0])
        elif tree.after[ball] == ball + 1:
            a, n = tree.first[ball], tree.count[ball]
            yield ball, int(n), left[nearest(points[a : a + n], entries[left])[0]]
        else:
            right = tree.after[ball + 1]
            todo += [(right, left), (ball + 1, left)]


def entry_sums(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the points of each entry."""
    n, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    for ball, count, owner in owners(tree, points, entries):
        if isinstance(owner, int):
            n[owner] += count
            sums[owner] += tree.sums[ball]
        else:
            a = tree.first[ball]
            np.add.at(n, owner, 1)
            np.add.at(sums, owner, points[a : a + count])
    return n, sums


def codes_of(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each point, in the order that the points were given to the tree."""
    found = np.empty(len(points), np.int64)
    for ball, count, owner in owners(tree, points, entries):
        a = tree.first[ball]
        found[a : a + count] = owner
    error = ((points - entries[found]) ** 2).sum(1)
    code, out = np.empty_like(found), np.empty_like(error)
    code[tree.place], out[tree.place] = found, error
    return code, out


# --- Spark ------------------------------------------------------------------


def _vectors(batch: pa.RecordBatch, width: int, scale: int) -> np.ndarray:
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    scaled = np.floor(values * float(scale))
    if np.abs(scaled).max(initial=0) > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} / {scale}: sums of squares would not be exact")
    return scaled.astype(np.int64)


def _block_batches(codes: Codes, width: int) -> Callable:
    """One row per block: ids and labels of its rows, and per part the tree with its points in the order of the tree."""
    step, block = width // codes.parts, max(1, min(codes.block, codes.numbers // width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, block):
                piece = batch.slice(a, block)
                whole = _vectors(piece, width, codes.scale)
                trees = []
                for k in range(codes.parts):
                    points = whole[:, k * step : (k + 1) * step]
                    tree = build_tree(points, codes.leaf)
                    trees.append([*tree.packed(), points[tree.place].astype(np.int32).tobytes()])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([piece.column("id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([piece.column("label").to_pylist()], pa.list_(pa.string())),
                        pa.array([trees], pa.list_(pa.list_(pa.binary()))),
                    ],
                    names=["ids", "labels", "trees"],
                )

    return run


def _unpacked(raw: list[bytes], step: int) -> tuple[Tree, np.ndarray]:
    return Tree.unpacked(raw[:-1], step), np.frombuffer(raw[-1], np.int32).reshape(-1, step).astype(np.int64)


def _sum_batches(books: np.ndarray) -> Callable:
    """Per part, entry and position (-1: the number of points) the sum over all blocks of a task."""
    parts, entries, step = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, step + 1), np.int64)
        for batch in batches:
            for trees in batch.column("trees"):
                for k, raw in enumerate(trees.as_py()):
                    n, sums = entry_sums(*_unpacked(raw, step), books[k])
                    total[k, :, 0] += n
                    total[k, :, 1:] += sums
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total.ravel()[used])], names=["cell", "n"])

    return run


def _code_batches(books: np.ndarray) -> Callable:
    parts, _, step = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, trees in zip(*(batch.column(c) for c in ("ids", "labels", "trees"))):
                found = [codes_of(*_unpacked(raw, step), books[k]) for k, raw in enumerate(trees.as_py())]
                code = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
                error = sum(e for _, e in found)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values, pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error, pa.int64())],
                    names=["id", "label", "code", "error"],
                )

    return run


def encode_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    codes: Codes = Codes(),
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``, one row per kept row of ``vectors``.

    Rows whose vector is null, empty or holds null or non-finite components are dropped, as are vectors of another length than
    that of the first kept row. Rows are ordered by id for the first codebook, null ids last; rows that repeat an id go by
    their vectors. Fewer rows than entries give a codebook of that many. Labels are compared as text, nulls
    are one label. A length that the parts do not divide, and components beyond ``LARGEST`` units, are errors. Other
    columns are not looked at. Without rows there is no result.
    """
    if not 1 <= codes.entries <= 256:
        raise ValueError("codes of two hex digits need 1 to 256 entries")
    spark = vectors.sparkSession
    given = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = given.filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    order = [F.col("id").isNull(), "id", "vector"]
    first = kept.orderBy(*order).limit(1).collect()
    empty = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if not first:
        return spark.createDataFrame([], empty)
    width = len(first[0]["vector"])
    if width % codes.parts:
        raise ValueError(f"vectors of length {width} cannot be cut into {codes.parts} parts")
    kept = kept.filter(F.size("vector") == width)
    step = width // codes.parts
    start = np.array([r["vector"] for r in kept.orderBy(*order).limit(codes.entries).select("vector").collect()])
    start = np.floor(start * float(codes.scale)).astype(np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), codes.parts, step).transpose(1, 0, 2))

    blocks = stored(
        kept.mapInArrow(_block_batches(codes, width), "ids array<long>, labels array<string>, trees array<array<binary>>")
    )
    for _ in range(codes.rounds):
        cells = blocks.select("trees").mapInArrow(_sum_batches(books), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
        total = np.zeros((codes.parts, len(start), step + 1), np.int64)
        found = cells.toPandas()  # parts * entries * (step + 1) numbers at most
        total.ravel()[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
        n, sums = total[:, :, :1], total[:, :, 1:]
        books = np.where(n > 0, np.floor_divide(sums, np.maximum(n, 1)), books)

    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = stored(blocks.mapInArrow(_code_batches(books), "id long, label string, code string, error long"))
    none = F.col("label").isNull().alias("none")
    key = F.coalesce("label", F.lit("")).alias("key")
    sums_of = coded.groupBy(none, key).agg(F.sum("error").alias("label_error"))
    return (
        coded.withColumns({"none": F.col("label").isNull(), "key": F.coalesce("label", F.lit(""))})
        .join(sums_of, ["none", "key"])
        .select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
    )
