"""Vector codes: product quantisation with exact assignment by memoised grid cells.

Vectors of whole numbers are cut into equal consecutive parts. Every part
position has a codebook that begins as the parts of the first vectors, by id,
and is refined in rounds: every part goes to the nearest entry (squared
distance, ties to the lower index), every entry becomes the mean of its parts,
rounded down; an entry without parts stays. A last assignment gives the codes.

The nearest entry is found by cells: space is cut into boxes, and the hash of a
part's box leads to the entries that can be nearest anywhere inside it, those
whose least distance to the box is not above another entry's greatest one. A
task computes that list once per box and keeps it for the round; only listed
entries are compared exactly with a part. A box beyond ``MEMO_CELLS`` has its
list computed again when it comes back, and a part whose box shares the hash of
another is compared with all entries, so codes are exact at any size.

A round is one pass over the staged vectors. A task sends one row per entry
with the sum and number of its parts, and the driver sees ``parts * entries``
rows, whatever the number of vectors.

Rows whose vector is null, or holds null or non-finite components, go. Vectors
shorter than the longest, rounded up to a multiple of the parts, count as
filled up with zeros. Null ids come last and null labels belong together. Rows
with equal ids are ordered by their components; repeated rows are coded one by
one. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.stages import counted_stage, require_columns, shared_folder, stage
from .components import salted_join
from .vectors import matrix_of, whole_vectors
from .words import mixed

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Side of a box against the mean size of a component.
CELL_SHARE = 0.5
#: Boxes that a task keeps per part, rows handled at once, and pairs of a part
#: and an entry that are compared at once.
MEMO_CELLS = 1 << 16
CHUNK_ROWS = 4096
PAIRS = 1 << 17

_random = np.random.default_rng(13)
_AXIS = _random.integers(0, 1 << 63, 1 << 12, dtype=np.uint64) * 2 + 1


class CellMemo:
    """The entries of one codebook that can be nearest in each box seen so far."""

    def __init__(self, book: np.ndarray, side: int, room: int = MEMO_CELLS):
        self.book, self.side, self.room = book, side, room
        self.slots: dict[int, int] = {}
        self.cells: list[np.ndarray] = []
        self.lists: list[np.ndarray] = []

    def candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """Per box the entries that no other entry beats all over the box."""
        near = np.zeros((len(cells), len(self.book)), np.int64)
        far = np.zeros_like(near)
        for axis in range(self.book.shape[1]):
            places, at = np.unique(cells[:, axis], return_inverse=True)
            entry = self.book[None, :, axis]
            low = places[:, None] * self.side
            high = low + self.side - 1
            gap = np.maximum(np.maximum(low - entry, entry - high), 0)
            reach = np.maximum(entry - low, high - entry)
            near += (gap * gap)[at]
            far += (reach * reach)[at]
        kept = near <= far.min(1)[:, None]
        owner, entry = np.nonzero(kept)
        return np.split(entry, np.cumsum(np.bincount(owner, minlength=len(cells)))[:-1])

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of every part, and its squared distance."""
        cells = parts // self.side
        axes = _AXIS[np.arange(cells.shape[1]) % len(_AXIS)] + np.arange(cells.shape[1], dtype=np.uint64)
        keys = mixed((cells.astype(np.uint64) * axes).sum(1, dtype=np.uint64))
        keys, first, which = np.unique(keys, return_index=True, return_inverse=True)
        lists: list[np.ndarray | None] = [None] * len(keys)
        odd = (cells != cells[first][which]).any(1)
        new = []
        for i, key in enumerate(keys.tolist()):
            slot = self.slots.get(key)
            if slot is None:
                new.append(i)
            elif (self.cells[slot] == cells[first[i]]).all():
                lists[i] = self.lists[slot]
            else:
                odd |= which == i
        for i, found in zip(new, self.candidates(cells[first[new]]) if new else ()):
            lists[i] = found
            if len(self.lists) < self.room:
                self.slots[int(keys[i])] = len(self.lists)
                self.cells.append(cells[first[i]])
                self.lists.append(found)
        everything = np.arange(len(self.book))
        lists = [everything if x is None else x for x in lists]
        return self._exact(parts, lists, which, odd)

    def _exact(
        self, parts: np.ndarray, lists: list[np.ndarray], which: np.ndarray, odd: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        if odd.any():
            lists = [*lists, np.arange(len(self.book))]
            which = np.where(odd, len(lists) - 1, which)
        sizes = np.array([len(x) for x in lists])
        starts, flat = np.cumsum(sizes) - sizes, np.concatenate(lists)
        counts = sizes[which]
        code, error = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        ends = np.cumsum(counts)
        row = 0
        while row < len(parts):
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] - counts[row] + PAIRS, "right")))
            n = counts[row:stop]
            begin = np.cumsum(n) - n
            owner = np.repeat(np.arange(stop - row), n)
            entry = flat[np.repeat(starts[which[row:stop]] - begin, n) + np.arange(n.sum())]
            apart = parts[row:stop][owner] - self.book[entry]
            distance = np.einsum("ij,ij->i", apart, apart)
            least = np.minimum.reduceat(distance, begin)
            hit = np.flatnonzero(distance == least[owner])
            _, at = np.unique(owner[hit], return_index=True)
            code[row:stop], error[row:stop] = entry[hit[at]], least
            row = stop
        return code, error


def _chunks(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    for first in range(0, batch.num_rows, CHUNK_ROWS):
        part = batch.slice(first, CHUNK_ROWS)
        yield first, first + part.num_rows, matrix_of(part.column(column), width)


def _sums(rows: DataFrame, books: np.ndarray, side: int) -> list:
    """Per part and entry with any parts their number and the sum of each
    component, combined in the tasks and before the shuffle."""
    parts, entries, size = books.shape
    axes = [f"s{i}" for i in range(size)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = [CellMemo(book, side) for book in books]
        total, number = np.zeros((parts, entries, size), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, _, values in _chunks(batch, 0, parts * size):
                for p, memo in enumerate(memos):
                    mine = values[:, p * size : (p + 1) * size]
                    code, _ = memo.nearest(mine)
                    number[p] += np.bincount(code, minlength=entries)
                    order = np.argsort(code, kind="stable")
                    heads = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
                    total[p][code[order][heads]] += np.add.reduceat(mine[order], heads)
        part, entry = np.nonzero(number)
        columns = [pa.array(part), pa.array(entry), pa.array(number[part, entry])]
        columns += [pa.array(total[part, entry, i]) for i in range(size)]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", *axes])

    schema = ", ".join(f"{c} long" for c in ["part", "entry", "n", *axes])
    found = rows.select("values").mapInArrow(add, schema).groupBy("part", "entry")
    return found.agg(*[F.sum(c).alias(c) for c in ["n", *axes]]).collect()


def fit_codebooks(
    rows: DataFrame, width: int, side: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> np.ndarray:
    """The codebooks (part, entry, position) of staged ``vec_id, values``."""
    size = width // parts
    heads = rows.orderBy(F.col("vec_id").asc_nulls_last(), "values").select("values").limit(entries).collect()
    first = matrix_of(pa.array([r["values"] for r in heads], pa.list_(pa.int32())), width)
    books = np.stack([first[:, p * size : (p + 1) * size] for p in range(parts)])
    for _ in range(rounds):
        new = books.copy()
        for row in _sums(rows, books, side):
            new[row["part"], row["entry"]] = np.array(row[3:], np.int64) // row["n"]
        books = new
    return books


def assign_codes(rows: DataFrame, books: np.ndarray, side: int) -> DataFrame:
    """``vec_id, label, code, error`` of ``vec_id, label, values``."""
    parts, entries, size = books.shape
    digits = max(2, len(f"{max(entries - 1, 0):x}"))
    names = [f"{i:0{digits}x}" for i in range(entries)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = [CellMemo(book, side) for book in books]
        for batch in batches:
            codes, errors = [], []
            for _, _, values in _chunks(batch, 2, parts * size):
                found = [memo.nearest(values[:, p * size : (p + 1) * size]) for p, memo in enumerate(memos)]
                codes += ["".join(names[c] for c in row) for row in zip(*(code.tolist() for code, _ in found))]
                errors.append(sum(error for _, error in found))
            error = np.concatenate(errors) if errors else np.zeros(0, np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    kinds = dict(rows.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return rows.select("vec_id", "label", "values").mapInArrow(assign, schema)


def _with_label_error(coded: DataFrame) -> DataFrame:
    """Add the error summed over rows of the same label. A label's one row is
    repeated for the tasks that its rows are dealt to."""
    known = F.col("label").isNotNull()
    keyed = coded.withColumns({"__known": known, "__label": F.xxhash64("label")})
    sums = keyed.groupBy("__known", "__label").agg(F.sum("error").alias("label_error"))
    return salted_join(keyed, sums, ["__known", "__label"], "vec_id").drop("__known", "__label")


def encode_vectors(
    df: DataFrame,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error, label_error`` of every vector, and the final
    codebooks. A code has two hexadecimal digits per part (more beyond 256
    entries); the error is the sum of squared distances of the parts."""
    require_columns(df, vec_id, label, vector)
    folder = shared_folder(df.sparkSession)
    whole = whole_vectors(df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector")), "vector", scale)
    size = F.aggregate("values", F.lit(0).cast("long"), lambda a, v: a + F.abs(v))
    rows, seen = counted_stage(
        whole.select("vec_id", "label", "values"), f"{folder}/vectors",
        width=F.max(F.size("values")), total=F.sum(size), count=F.sum(F.size("values")),
    )
    if not seen["width"]:
        rows, seen = rows.limit(0), {"width": 0, "total": 0, "count": 0}
    width = -(-max(seen["width"], 1) // parts) * parts
    side = max(1, round(CELL_SHARE * seen["total"] / max(1, seen["count"])))
    books = fit_codebooks(rows, width, side, parts, entries, rounds)
    coded = stage(assign_codes(rows, books, side), f"{folder}/codes")
    return _with_label_error(coded), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
