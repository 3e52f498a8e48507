"""Exact substring dedup: bytes covered by a long string that starts earlier.

Every ``length``-byte window of a text has an anchor, the 32-byte string in it
with the smallest hash, so equal windows have equal anchors and lie equally
around them. Windows of one place that share an anchor are a run; its bytes are
its context. Runs meet by anchor, packed into few large rows. Of runs with equal
anchor and context all but the first are repeats throughout, found in the task
or the bucket they meet in. Where one anchor has several contexts, the first run
of each context goes on: their texts are indexed together, and the expansion of
prefix intervals on the Burrows-Wheeler transform (``bwt``) tells which of their
windows are equal. An anchor with very many contexts is divided before that by
the bytes that its windows have in common. Texts that meet under one key and are
more than ``HOT_BYTES`` together are not gathered: their windows go on one by one,
by digest, and the first place of each is found by a combining aggregate.

Texts are UTF-8 bytes; matches never cross documents. Nulls count as empty. A
null id comes before all others. Rows that repeat id and text are treated alike
and do not remove each other; rows that share only the id count as one document
for the order of places. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..sources.stages import counted_stage, drop_stages, require_columns, shared_folder, stage
from .bwt import repeats_of_length
from .components import salted_join, salted_lookup
from .jaccard_join import FIRST_ID
from .verification import groups_in_order
from .words import mixed, runs_of_texts, text_buffers

LENGTH = 100
GRAM = 32
#: Bytes hashed at once; a longer text is taken in pieces.
PIECE_BYTES = 1 << 18
PLACE_BITS = 20
#: Runs that a task holds before it combines equal ones and passes them on.
FLUSH_RUNS = 1 << 20
#: Buckets of anchors per shuffle partition.
BUCKETS = 4
#: From so many contexts on, an anchor's windows are divided further.
MANY_CONTEXTS = 512
PARTS = 4
#: Bytes of text indexed together.
INDEX_BYTES = 1 << 18
#: Bytes of one key that are gathered in a task, and keys beyond that whose list is
#: broadcast (8 bytes each); a longer list is joined.
HOT_BYTES = 1 << 20
HOT_KEYS = 1 << 20

_random = np.random.default_rng(8)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * 2 + 1
_FACTOR = 0x5851F42D4C957F2D
_MASK64 = (1 << 64) - 1


def _powers(factor: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate(
            [[np.uint64(1)], np.cumprod(np.full(n, factor & _MASK64, np.uint64))]
        )


_UP = _powers(_FACTOR, PIECE_BYTES + 1024)
_DOWN = _powers(pow(_FACTOR, -1, 1 << 64), PIECE_BYTES + 1024)

RUN = np.dtype(
    [("anchor", "u8"), ("context", "u8"), ("doc", "i8"), ("name", "i8"),
     ("start", "i4"), ("more", "u1"), ("ahead", "u1")]
)


def runs_of(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """The runs of a piece of texts: anchor, context, first window (``start``),
    number of further windows (``more``), and the anchor's place after the first
    window (``ahead``)."""
    n, width = len(data), length - GRAM + 1
    empty = {k: np.zeros(0, np.int64) for k in ("anchor", "context", "start", "more", "ahead")}
    if n < length:
        return empty
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _UP[:n], out=total[1:])
    grams = mixed((total[GRAM:] - total[:-GRAM]) * _DOWN[: n - GRAM + 1])
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    place = (least & low).astype(np.int32)
    valid = np.ones(len(place), bool)
    for e in ends[1:-1]:
        valid[max(0, e - length + 1) : e] = False
    differs = np.ones(len(place) + 1, bool)
    differs[1:-1] = place[1:] != place[:-1]
    shut = np.ones(len(place) + 2, bool)
    shut[1:-1] = ~valid
    start = np.flatnonzero(valid & (differs[:-1] | shut[:-2]))
    stop = np.flatnonzero(valid & (differs[1:] | shut[2:]))
    if not len(start):
        return empty
    more, ahead = stop - start, place[start] - start
    context = (total[stop + length] - total[start]) * _DOWN[start]
    context = mixed(context + (more * 256 + ahead).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return {"anchor": grams[place[start]], "context": context, "start": start, "more": more, "ahead": ahead}


def text_name(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


def _runs_of_column(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """The runs of a column of texts as records."""
    for first, last in runs_of_texts(offsets, PIECE_BYTES - 1024):
        low, high = int(offsets[first]), int(offsets[last])
        names = np.array(
            [text_name(data[a:b].tobytes()) for a, b in zip(offsets[first:last], offsets[first + 1 : last + 1])], np.int64
        )
        step = PIECE_BYTES - 1024
        for base in range(low, max(low + 1, high), step):
            top = min(high, base + step + length - 1)
            ends = offsets[first : last + 1] - base if last - first > 1 else np.array([0, top - base])
            found = runs_of(data[base:top], ends, length)
            if not len(found["start"]):
                continue
            out = np.zeros(len(found["start"]), RUN)
            place = found["start"] + base
            row = np.searchsorted(offsets[first : last + 1], place, "right") - 1
            out["anchor"], out["context"] = found["anchor"], found["context"]
            out["more"], out["ahead"] = found["more"], found["ahead"]
            out["doc"], out["name"] = ids[first + row], names[row]
            out["start"] = place - offsets[first + row]
            yield out


def firsts(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first run of every anchor and context, in that order, and the others."""
    order = np.lexsort((runs["start"], runs["doc"], runs["context"], runs["anchor"]))
    runs = runs[order]
    first = np.ones(len(runs), bool)
    first[1:] = (runs["anchor"][1:] != runs["anchor"][:-1]) | (runs["context"][1:] != runs["context"][:-1])
    # Rows that repeat a document do not come after themselves.
    head = np.maximum.accumulate(np.where(first, np.arange(len(runs)), 0))
    same = (runs["doc"] == runs["doc"][head]) & (runs["start"] == runs["start"][head])
    return runs[first], runs[~first & ~same]


PACKED_SCHEMA = "bucket int, repeats boolean, runs binary"


def enter_runs(docs: DataFrame, buckets: int, length: int) -> DataFrame:
    """All runs of all texts, packed by bucket of anchors. Equal runs are
    combined within a task: all but the first are passed on as repeats."""

    def packed(runs: np.ndarray) -> Iterator[pa.RecordBatch]:
        kept, repeats = firsts(runs)
        bucket = (mixed(kept["anchor"]) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        kept, bucket = kept[order], bucket[order]
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
        rows = [(int(bucket[a]), False, p.tobytes()) for a, p in zip(cuts, np.split(kept, cuts[1:]))]
        spread = int(kept["context"][0] % np.uint64(buckets)) if len(kept) else 0
        for number, part in enumerate(np.array_split(repeats, max(1, len(repeats) >> 14))):
            rows.append(((spread + number) % buckets, True, part.tobytes()))
        for start in range(0, len(rows), 256):
            columns = list(zip(*rows[start : start + 256]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.binary())],
                ["bucket", "repeats", "runs"],
            )

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = text_buffers(batch.column(1))
            for part in _runs_of_column(ids, data, offsets, length):
                held.append(part)
                count += len(part)
                if count >= FLUSH_RUNS:
                    yield from packed(np.concatenate(held))
                    held, count = [], 0
        if held:
            yield from packed(np.concatenate(held))

    return docs.mapInArrow(enter, PACKED_SCHEMA)


MET_SCHEMA = (
    "open boolean, doc_id long, name long, start int, stop int, anchor long, more int, ahead int, many boolean"
)


def meet_runs(packed: DataFrame, length: int) -> DataFrame:
    """What comes of the runs of each bucket: byte ranges that are repeats, and
    (``open``) the first run of each context of anchors that have several."""

    def batch_of(runs: np.ndarray, is_open: bool, many: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(runs), 1 << 16):
            r, m = runs[at : at + (1 << 16)], many[at : at + (1 << 16)]
            stop = r["start"].astype(np.int32) + r["more"] + length
            columns = [
                np.full(len(r), is_open), r["doc"], r["name"], r["start"], stop.astype(np.int32),
                r["anchor"].astype(np.int64), r["more"].astype(np.int32), r["ahead"].astype(np.int32), m,
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(c)) for c in columns], [f.split()[0] for f in MET_SCHEMA.split(", ")]
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_in_order(batches, ["bucket"]):
            flags = table.column("repeats").to_pylist()
            rows = [np.frombuffer(r.as_py(), RUN) for r in table.column("runs")]
            for part in (r for r, f in zip(rows, flags) if f):
                yield from batch_of(part, False, np.zeros(len(part), bool))
            runs = [r for r, f in zip(rows, flags) if not f]
            if not runs:
                continue
            runs = np.concatenate(runs)
            ordered = np.sort(runs["anchor"])
            again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
            if not len(again):
                continue
            at = np.minimum(np.searchsorted(again, runs["anchor"]), len(again) - 1)
            kept, repeats = firsts(runs[again[at] == runs["anchor"]])
            yield from batch_of(repeats, False, np.zeros(len(repeats), bool))
            _, place, counts = np.unique(kept["anchor"], return_inverse=True, return_counts=True)
            several = counts[place] > 1
            yield from batch_of(kept[several], True, counts[place][several] > MANY_CONTEXTS)

    ordered = packed.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(meet, MET_SCHEMA)


PIECES_SCHEMA = "key long, doc_id long, name long, start int, bytes binary"


def cut_pieces(docs: DataFrame, opened: DataFrame, length: int) -> DataFrame:
    """The bytes of open runs. Runs of an anchor with many contexts are divided
    by where their windows lie around it, and keyed by what these have in
    common, so that only windows with most of their bytes equal meet."""
    wanted = opened.groupBy("doc_id", "name").agg(
        F.collect_set(F.struct("anchor", "start", "more", "ahead", "many")).alias("wanted")
    )
    step = -(-(length - GRAM + 1) // PARTS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for row in batch.to_pylist():
                text, doc, name = row["text"].encode(), row["doc_id"], row["name"]
                if text_name(text) != name:
                    continue
                for run in row["wanted"]:
                    start, more = run["start"], run["more"]
                    if not run["many"]:
                        rows.append((run["anchor"], doc, name, start, text[start : start + more + length]))
                        continue
                    place = start + run["ahead"]
                    for part in range(PARTS):
                        # Windows that begin between ``step * part`` and the next
                        # step before the anchor.
                        low = max(start, place - step * (part + 1) + 1)
                        high = min(start + more, place - step * part)
                        if low > high:
                            continue
                        core = text[place - step * part : place - step * (part + 1) + 1 + length]
                        key = xxhash.xxh3_64_intdigest(core, run["anchor"] & _MASK64 ^ part)
                        key = key - (1 << 64) if key >> 63 else key
                        rows.append((key, doc, name, low, text[low : high + length]))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in PIECES_SCHEMA.split(", ")]
            )

    joined = docs.join(wanted, "doc_id").select("doc_id", "text", "name", "wanted")
    return joined.mapInArrow(cut, PIECES_SCHEMA)


RANGES_SCHEMA = "doc_id long, name long, start int, stop int"


def repeats_in(pieces: pa.Table, length: int) -> list[np.ndarray]:
    """Byte ranges of the pieces' windows that equal an earlier one: columns of
    document, name, start and stop."""
    parts = [np.frombuffer(b.as_py(), np.uint8) for b in pieces.column("bytes")]
    docs, names = pieces.column("doc_id").to_numpy(), pieces.column("name").to_numpy()
    starts = pieces.column("start").to_numpy().astype(np.int64)
    sizes = np.array([len(p) for p in parts])
    base = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.zeros(base[-1], np.uint8)
    for b, p in zip(base, parts):
        text[b : b + len(p)] = p
    inside = np.ones(len(text), bool)
    inside[base[1:] - 1] = False
    # 0xFF is no byte of UTF-8, so a character NUL can lend it its place.
    text[inside & (text == 0)] = 0xFF
    order, new = repeats_of_length(text, length)
    kind = np.empty(len(text), np.int64)
    kind[order] = np.cumsum(new)
    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(parts)), windows)
    offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    kinds, doc, start = kind[base[owner] + offset], docs[owner], starts[owner] + offset
    by_kind = np.lexsort((start, doc, kinds))
    k = kinds[by_kind]
    head = np.ones(len(k), bool)
    head[1:] = k[1:] != k[:-1]
    first = by_kind[np.maximum.accumulate(np.where(head, np.arange(len(k)), 0))]
    later = np.zeros(len(k), bool)
    later[by_kind] = (doc[by_kind] != doc[first]) | (start[by_kind] != start[first])
    edge = np.diff(np.concatenate([[0], later.astype(np.int8), [0]]))
    change = np.zeros(len(later) + 1, bool)
    change[1:-1] = owner[1:] != owner[:-1]
    begins = np.flatnonzero((edge[:-1] == 1) | (change[:-1] & later))
    stops = np.flatnonzero((edge[1:] == -1) | (change[1:] & later))
    return [doc[begins], names[owner[begins]], start[begins], start[stops] + length]


def compare_pieces(pieces: DataFrame, length: int) -> DataFrame:
    """Ranges of repeats among pieces with equal keys, none of more than
    ``HOT_BYTES``. Groups are indexed together up to a bound; one piece alone has
    nothing to repeat."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def indexed() -> pa.RecordBatch:
            columns = repeats_in(pa.concat_tables(held), length)
            kinds = [np.int64, np.int64, np.int32, np.int32]
            return pa.RecordBatch.from_arrays(
                [pa.array(c.astype(k)) for c, k in zip(columns, kinds)], ["doc_id", "name", "start", "stop"]
            )

        for table in groups_in_order(batches, ["key"]):
            if table.num_rows < 2:
                continue
            held.append(table)
            size += table.column("bytes").nbytes
            if size >= INDEX_BYTES:
                yield indexed()
                held, size = [], 0
        if held:
            yield indexed()

    ordered = pieces.repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(compare, RANGES_SCHEMA)


WINDOWS_SCHEMA = "high long, low long, doc_id long, name long, start int"


def compare_windows(pieces: DataFrame, length: int) -> DataFrame:
    """The same for pieces of keys that are too large to gather: every window is a
    row with its 128-bit digest. The first place of a digest is combined before the
    shuffle and comes back spread over many join keys."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, owners, starts = [], [], []
            begins = batch.column(2).to_pylist()
            for i, piece in enumerate(batch.column(3).to_pylist()):
                n = len(piece) - length + 1
                digests += [xxhash.xxh3_128_digest(piece[k : k + length]) for k in range(n)]
                owners += [i] * n
                starts += range(begins[i], begins[i] + n)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            at = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(halves[:, 0]), pa.array(halves[:, 1]), batch.column(0).take(at),
                    batch.column(1).take(at), pa.array(starts, pa.int32()),
                ],
                ["high", "low", "doc_id", "name", "start"],
            )

    found = pieces.select("doc_id", "name", "start", "bytes").mapInArrow(windows, WINDOWS_SCHEMA)
    firsts = found.groupBy("high", "low").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    met = salted_join(found, firsts, ["high", "low"], "name")
    later = met.where(F.struct("doc_id", "start") != F.col("first"))
    return later.select("doc_id", "name", "start", (F.col("start") + length).cast("int").alias("stop"))


def _compared(pieces: DataFrame, length: int, folder: str) -> DataFrame:
    sizes = pieces.groupBy("key").agg(F.sum(F.octet_length("bytes")).alias("size"))
    hot, seen = counted_stage(sizes.where(F.col("size") > HOT_BYTES).select("key"), f"{folder}/hot", n=F.count("*"))
    if not seen["n"]:
        return compare_pieces(pieces, length)
    hot = hot.withColumn("hot", F.lit(True))
    if seen["n"] <= HOT_KEYS:
        marked = pieces.join(F.broadcast(hot), "key", "left")
    else:
        marked = salted_lookup(pieces, hot, "key", "name", "hot")
    small = compare_pieces(marked.where("hot IS NULL").drop("hot"), length)
    return small.unionByName(compare_windows(marked.where("hot"), length))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Byte ranges (``doc_id, name, start, stop``) covered by a string of
    ``length`` bytes that also starts earlier; they may overlap. ``name`` tells
    texts apart that share an id."""
    if not 2 * GRAM <= length <= 255:
        raise ValueError(f"length must lie between {2 * GRAM} and 255")
    spark = docs.sparkSession
    folder = shared_folder(spark)
    texts = _keyed(docs)
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = stage(meet_runs(enter_runs(texts, buckets, length), length), f"{folder}/met")
    pieces = stage(cut_pieces(texts, met.where("open"), length), f"{folder}/pieces")
    compared = stage(_compared(pieces, length, folder), f"{folder}/compared")
    drop_stages(spark, f"{folder}/pieces", f"{folder}/hot")
    return met.where("NOT open").select("doc_id", "name", "start", "stop").unionByName(compared)


KEPT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def remove_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Per document row: ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed
    runs) and ``kept``, the remaining bytes. Ranges meet per document."""
    require_columns(docs, "doc_id", "text")
    per_document = (
        ranges.groupBy("doc_id", "name")
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("name", "spans")).alias("named"))
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text = row["text"].encode()
                name = text_name(text) if row["named"] else None
                spans = sorted(
                    (s["start"], s["stop"]) for n in row["named"] or () if n["name"] == name for s in n["spans"]
                )
                kept, at, removed, runs = [], 0, 0, 0
                reach = -1
                for start, stop in spans:
                    if start > reach:
                        runs += 1
                        kept.append(text[at:start])
                    removed += max(0, stop - max(start, at))
                    at = reach = max(reach, stop)
                kept.append(text[at:])
                rows.append((row["doc_id"], len(text), removed, runs, b"".join(kept)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in KEPT_SCHEMA.split(", ")]
            )

    out = _keyed(docs).join(per_document, "doc_id", "left").select("doc_id", "text", "named")
    return out.mapInArrow(remove, KEPT_SCHEMA).withColumn("doc_id", F.nullif("doc_id", F.lit(FIRST_ID)))


def dedupe_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Remove every byte that a repeated string of ``length`` bytes covers."""
    return remove_ranges(docs, repeated_ranges(docs, length))


def brute_force(rows: list[tuple[int, str | None]], length: int = LENGTH) -> dict[int, tuple]:
    """The same for a few documents, window by window."""
    seen: set[bytes] = set()
    out = {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = True
            seen.add(window)
        gone = gone[: len(data)]
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
        out[doc] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out
