"""Examples packed into sequences under several limits at once.

An example is a row's token ids and an end id. A sequence holds pieces of examples
up to three limits: tokens, segments (pieces), and loss-bearing tokens, which are
those that a model is trained to give: all behind the prompt, or, without a prompt,
all but the first id. That is vector bin packing, and the dot-product heuristic does
it: sequences are filled one by one, each time with the example that fits and whose
demand, weighed by the average demand in each dimension, has the largest dot
product with the room that is left.

What is longer than a whole sequence is cut into full ones first. With ``cut``, an
example is also cut where nothing fits the rest of a sequence whole, one at most per
sequence; and a sequence that still is not full when its segments or all examples
have run out is divided at powers of two, which need no padding. Without it,
examples that fit stay whole and the rest of a sequence is padding.

Every task packs the rows it reads: nothing is shuffled. It holds a window of
examples, so the heuristic has a choice of ``WINDOW`` at least until its rows end.

A null text or prompt counts as empty; an example without ids is its end id alone.
Very long texts are examples like others. Ties go to the earlier example. Rows with
equal or null keys are examples of their own; repeated rows are packed one by one.
Extra columns are ignored; a key column that is called like a result is an error.
An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.stages import require_columns
from .tokens import encoder

END_ID = 0
#: Examples that a task holds at least while it packs.
WINDOW = 2048
OUT_ROWS = 8192


class Limits(NamedTuple):
    """What a sequence holds at most."""

    tokens: int = 1024
    segments: int = 128
    loss: int = 1024


class Piece(NamedTuple):
    """Ids of an example: its key and number of ids, where these start in it, and
    how many of the first of them bear no loss."""

    key: object
    total: int
    start: int
    ids: np.ndarray
    free: int

    def cut(self, take: int) -> tuple[Piece, Piece]:
        head = self._replace(ids=self.ids[:take], free=min(self.free, take))
        rest = self._replace(start=self.start + take, ids=self.ids[take:], free=max(0, self.free - take))
        return head, rest


class Packer:
    """Packs pieces; a sequence is the list of its pieces."""

    def __init__(self, limits: Limits, cut: bool = True, window: int = WINDOW):
        self.limits, self.may_cut, self.window = limits, cut, window
        self.held: list[Piece] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Take one more example; yields the sequences that are done."""
        while True:
            take = self._prefix(piece, self.limits.tokens, self.limits.loss)
            if take == len(piece.ids) and take < self.limits.tokens:
                break
            head, piece = piece.cut(take)
            yield from self._closed([head])
            if not len(piece.ids):
                return
        # A copy, so that the end of a long example does not hold all of it.
        self.held.append(piece._replace(ids=piece.ids.copy()) if piece.start else piece)
        if len(self.held) >= 2 * self.window:
            yield from self.pack(self.window)

    @staticmethod
    def _prefix(piece: Piece, tokens: int, loss: int) -> int:
        return min(len(piece.ids), tokens, piece.free + loss)

    def pack(self, leave: int = 0) -> Iterator[list[Piece]]:
        """Fill sequences until only ``leave`` examples are left."""
        pieces, limits = self.held, self.limits
        size = np.array([len(p.ids) for p in pieces], np.int64)
        free = np.array([p.free for p in pieces], np.int64)
        there = np.ones(len(pieces), bool)
        left = len(pieces)
        while left > leave:
            loss = size - np.minimum(free, size)
            # Average demand weighs a dimension; all pieces are one segment each.
            by_tokens = size[there].mean() / limits.tokens**3
            by_loss = loss[there].mean() / limits.loss**3
            sequence: list[Piece] = []
            tokens, bearing = limits.tokens, limits.loss
            room = np.where(there, size, limits.tokens + 1)
            while len(sequence) < limits.segments:
                fits = (room <= tokens) & (loss <= bearing)
                score = np.where(fits, by_tokens * tokens * size + by_loss * bearing * loss, -1.0)
                best = int(score.argmax())
                if score[best] < 0:
                    break
                sequence.append(pieces[best])
                there[best] = False
                room[best] = limits.tokens + 1
                tokens -= int(size[best])
                bearing -= int(loss[best])
                left -= 1
            if self.may_cut and tokens and left and len(sequence) < limits.segments:
                take = np.where(there, np.minimum(np.minimum(size, tokens), free + bearing), 0)
                longest = take.max()
                if longest > 0:
                    score = np.where(take == longest, by_tokens * size + by_loss * loss, -1.0)
                    best = int(score.argmax())
                    head, rest = pieces[best].cut(int(longest))
                    sequence.append(head)
                    pieces[best] = rest
                    size[best], free[best] = len(rest.ids), rest.free
            yield from self._closed(sequence)
        self.held = [p for p, t in zip(pieces, there) if t]

    def _closed(self, sequence: list[Piece]) -> Iterator[list[Piece]]:
        """The sequence, divided at powers of two where it would need padding."""
        total = sum(len(p.ids) for p in sequence)
        whole = self.limits.tokens
        if not self.may_cut or total == whole:
            yield sequence
            return
        pieces = sequence[::-1]
        while pieces:
            wanted = 1 << (total.bit_length() - 1)
            total -= wanted
            part: list[Piece] = []
            while wanted:
                piece = pieces.pop()
                if len(piece.ids) > wanted:
                    piece, rest = piece.cut(wanted)
                    pieces.append(rest)
                wanted -= len(piece.ids)
                part.append(piece)
            yield part


def padded_tokens(total: int, tokens: int) -> int:
    """The length of a sequence of ``total`` tokens with its padding."""
    return total if total & (total - 1) == 0 else tokens


def pack_examples(
    df: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    prompt: str | None = None,
    limits: Limits = Limits(),
    cut: bool = True,
    end_id: int = END_ID,
    with_ids: bool = False,
    window: int = WINDOW,
) -> DataFrame:
    """One row per piece: the key, ``start`` (ids of its example before it),
    ``length``, ``loss`` (loss-bearing ids in it), ``ids_crc32`` and, if asked for,
    ``ids`` (both of the ids as little-endian 32-bit numbers), ``doc_tokens`` (ids of
    its example), ``sequence_id``, and ``offset``, its place there.

    ``tokenizer`` is the path of a tokenizer file. A ``prompt`` column is put before
    the text and bears no loss.
    """
    texts = [text] if prompt is None else [prompt, text]
    require_columns(df, key, *texts)
    results = "start long, length long, loss long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    results += ", ids binary" if with_ids else ""
    names = [field.split()[0] for field in results.split(", ")]
    if key.lower() in names:
        raise ValueError(f"column(s) already there: {key}")
    if min(limits) < 1:
        raise ValueError("every limit must be 1 or more")
    picked = df.select(F.col(key).alias("key"), *[F.col(t).cast("string").alias(f"t{i}") for i, t in enumerate(texts)])
    kind = picked.schema["key"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, cut, window)
        number = TaskContext.get().partitionId() << 40
        end = np.array([end_id], np.uint32)
        key_type = pa.null()

        def sequences() -> Iterator[list[Piece]]:
            nonlocal key_type
            for batch in batches:
                key_type = batch.column(0).type
                found = [encoder(tokenizer).encode(batch.column(1 + i)) for i in range(len(texts))]
                for i, value in enumerate(batch.column(0).to_pylist()):
                    parts = [ids[places[i] : places[i + 1]] for ids, places in found]
                    ids = np.concatenate([*parts, end])
                    yield from packer.add(Piece(value, len(ids), 0, ids, len(parts[0]) if prompt else 1))
            yield from packer.pack()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [key_type, *[pa.int64()] * 7, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", *names])

        rows: list[tuple] = []
        for sequence in sequences():
            offset = 0
            for piece in sequence:
                raw = piece.ids.astype("<u4", copy=False).tobytes()
                size = len(piece.ids)
                loss = size - min(piece.free, size)
                row = (piece.key, piece.start, size, loss, zlib.crc32(raw), piece.total, number, offset)
                rows.append((*row, raw) if with_ids else row)
                offset += size
            number += 1
            if len(rows) >= OUT_ROWS:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    return picked.mapInArrow(pack, f"key {kind}, {results}").withColumnRenamed("key", key)
