"""Vector bin packing of token pieces into sequences.

A piece has three sizes: tokens, one segment, and tokens that bear loss. A sequence holds limited amounts of each.
The dot-product heuristic fills one sequence at a time: of the pieces that fit, it takes the one whose sizes,
as shares of the limits, have the largest dot product with the room that is left. Tasks pack on their own, from
a pool of bounded size, so no sequence needs rows of two tasks and a lost task is repeated alone.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import id_of, id_or_null, text_of

#: The id that ends a document.
END_ID = 1
#: Fixed value: the splitting pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space in a row from which a text goes through the tokenizer file: the rank library fails at a million.
LONG_SPACE = 100_000


@dataclass(frozen=True)
class Limits:
    """Room of one sequence, and the pieces that a task holds open while it packs.

    The first token of a document bears no loss, as nothing comes before it.
    """

    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048
    pool: int = 128


PIECE_SCHEMA = (
    "_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
)


class Encoder:
    """Ids of a text by a tokenizer file.

    ``ranks_path`` may name the same vocabulary as ranks. Texts in Latin-1, where the splitting patterns of both
    libraries agree character by character, are then encoded from it, which gives the same ids in a quarter of
    the time; all other texts, and all texts without it, go through the tokenizer file, as do texts that hold one
    of its special strings and texts with very long white space, which the rank library cannot split.
    """

    def __init__(self, path: str, ranks_path: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _needs_file(self, text: str) -> bool:
        if any(special in text for special in self.special):
            return True
        return len(text) >= LONG_SPACE and any(len(m[0]) >= LONG_SPACE for m in re.finditer(r"\s+", text))

    def encode(self, text: str) -> np.ndarray:
        if self.plain is not None and not self._needs_file(text):
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                return np.array(self.plain.encode_ordinary(text), dtype="<u4")
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


def _encoder(path: str, ranks_path: str | None) -> Encoder:
    """The worker's encoder for a file; it stays with the imported library, so later tasks find it warm."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_closeworks_encoders", {})
    if (path, ranks_path) not in kept:
        kept[path, ranks_path] = Encoder(path, ranks_path)
    return kept[path, ranks_path]


@dataclass
class Piece:
    doc: int
    start: int
    ids: np.ndarray
    doc_tokens: int

    @property
    def loss(self) -> int:
        return len(self.ids) - (self.start == 0)

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.start, self.ids[:n], self.doc_tokens),
            Piece(self.doc, self.start + n, self.ids[n:], self.doc_tokens),
        )


class Packer:
    """Packs the pieces of one task. ``rows`` are finished rows of the result."""

    def __init__(self, limits: Limits, first_sequence: int):
        self.limits, self.next_sequence = limits, first_sequence
        self.pool: list[Piece] = []
        self.rows: list[tuple] = []

    def add(self, doc: int, ids: np.ndarray) -> None:
        whole, size = Piece(doc, 0, ids, len(ids)), min(self.limits.tokens, self.limits.loss_tokens)
        while len(whole.ids) > size:
            part, whole = whole.cut(size)
            self.close([part])
        if len(whole.ids) == size:
            self.close([whole])
        else:
            self.pool.append(whole)

    def close(self, pieces: list[Piece]) -> None:
        """Close a sequence. One that is not full is dealt out by powers of two, lengths that need no padding."""
        left = sum(len(p.ids) for p in pieces)
        while left:
            size = self.limits.tokens if left == self.limits.tokens else 1 << (left.bit_length() - 1)
            offset = 0
            while offset < size:
                p = pieces.pop(0)
                if len(p.ids) > size - offset:
                    p, after = p.cut(size - offset)
                    pieces.insert(0, after)
                crc = zlib.crc32(np.ascontiguousarray(p.ids).tobytes())
                self.rows.append((p.doc, p.start, len(p.ids), crc, p.doc_tokens, self.next_sequence, offset, p.loss))
                offset += len(p.ids)
            self.next_sequence += 1
            left -= size

    def pack(self, at_most: int) -> None:
        """Close sequences until no more than ``at_most`` pieces are left."""
        limit = np.array([self.limits.tokens, self.limits.segments, self.limits.loss_tokens], dtype=float)
        while len(self.pool) > at_most:
            sizes = np.array([(len(p.ids), 1, p.loss) for p in self.pool], dtype=float)
            free = np.ones(len(self.pool), dtype=bool)
            room, taken, rest = limit.copy(), [], None
            while room[0] > 0 and free.any():
                fits = free & (sizes <= room).all(axis=1)
                if not fits.any():
                    break
                score = (sizes / limit) @ (room / limit)
                best = int(np.argmax(np.where(fits, score, -1.0)))
                free[best] = False
                room -= sizes[best]
                taken.append(self.pool[best])
            if room.min() >= 1 and free.any():
                # Nothing fits whole: the longest piece gives what fills the room.
                best = int(np.argmax(np.where(free, sizes[:, 0], -1.0)))
                n = int(min(room[0], room[2], sizes[best, 0] - 1))
                if n >= 1:
                    part, rest = self.pool[best].cut(n)
                    free[best] = False
                    taken.append(part)
            self.pool = [p for p, f in zip(self.pool, free) if f] + ([rest] if rest is not None else [])
            self.close(taken)


def _pack_batches(
    batches: Iterator[pa.RecordBatch], path: str, ranks_path: str | None, limits: Limits
) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(path, ranks_path)
    # Sequence ids are unique over tasks: the upper bits are the partition, the lower ones a running number.
    packer = Packer(limits, TaskContext.get().partitionId() << 40)
    names = PIECE_SCHEMA.replace(" long", "").split(", ")

    def out() -> pa.RecordBatch:
        columns = list(zip(*packer.rows)) or [[]] * len(names)
        packer.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    for batch in batches:
        for doc, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist()):
            packer.add(doc, np.append(encoder.encode(text), np.uint32(END_ID)).astype("<u4"))
            if len(packer.pool) >= 2 * limits.pool:
                packer.pack(limits.pool)
        yield out()
    packer.pack(0)
    yield out()


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limits: Limits = Limits(),
    ranks_path: str | None = None,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens``, one row per piece.

    Every document ends with id 1; a null or empty text is that id alone. Documents are cut where a
    sequence has room, so each id is in one piece. Repeated rows are packed once each. Null ids stay null. The
    pool of a task is bounded by ``limits.pool``; a long document leaves whole sequences at once.
    """
    rows = documents.select(id_of(id_col).alias("_id"), text_of(text_col).alias("_text"))
    packed = rows.mapInArrow(lambda batches: _pack_batches(batches, tokenizer_path, ranks_path, limits), PIECE_SCHEMA)
    return packed.withColumn("doc_id", id_or_null()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"
    )
