"""Near-duplicate paragraphs: MinHash banding, exact check, removal by component.

A paragraph is a line of at least ``MIN_WORDS`` words. Shorter lines in a row,
with no empty one between them, are together one, if they have as many words;
``repeated_paragraphs`` leaves these blocks out. Paragraphs with equal shingle sets are one class. The bands of a class's
MinHash signature are tuned so that a pair right at the threshold shares one
with the target probability; classes that collide in a band become candidates,
and candidates are compared exactly within their components, by Jaccard
similarity of word shingles. Of each component of links the first paragraph, by
document id and place, stays and all others are removed.

Passages that repeat inside otherwise different paragraphs, or over several
lines, are found in a second step. Seeds, short runs of words picked by their
hashes alone, meet; around the seeds that stand in several places all runs of
``MIN_RUN_WORDS`` words are compared, and the words of every run that also
stands earlier are removed, to the word. Removed paragraphs take no part in
that, so the first place of a run is one that stays. Shorter repeats, such as
headings that many documents share, are left alone.

Null and empty texts have no paragraphs and come back unchanged, as do texts
without repeats. Rows that share an id, or have none, are documents of their own,
told apart and ordered by the hash of their text; rows with equal id and text are
one document, given more than once, and all lose the same. A null id comes before
all others. Other columns pass through; if one is called ``removed_lines`` or
``removed_words``, that is an error, and ``names`` can rename these. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.stages import drop_stages, require_columns, shared_folder, stage
from .components import connected_components, salted_join
from .jaccard_join import FIRST_ID, named_texts
from .verification import groups_in_order, link_members
from .words import (
    mixed, runs_of_texts, set_keys, set_minima, shingle_hashes, shingle_sets, text_buffers, unused, word_hashes,
)

SHINGLE_WORDS = 5
TENTHS = 8
MIN_WORDS = 30
TARGET_RECALL = 0.9999
MAX_BANDS = 16
#: A repeated passage outside of repeated paragraphs goes from so many words on.
MIN_RUN_WORDS = 20
#: Runs of so many words are seeds, at least one of any so many in a row. A
#: passage must hold one, so both together are at most MIN_RUN_WORDS + 1.
SEED_WORDS = 8
SEED_GAP = 13
#: Pieces that a task holds before it passes them on, and buckets per partition.
FLUSH_PIECES = 1 << 20
BUCKETS = 4

PIECE = np.dtype([("piece", "u8"), ("doc", "i8"), ("name", "i8"), ("start", "u4")])
SPAN = np.dtype([("doc", "i8"), ("name", "i8"), ("start", "u4"), ("words", "u4")])
_WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")

_random = np.random.default_rng(9)
_PERMUTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * 2 + 1
_BAND = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * 2 + 1
_BASE = _random.integers(0, 1 << 61, dtype=np.uint64) * 8 + 5
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def tune_bands(similarity: float = 0.8, recall: float = TARGET_RECALL, most: int = MAX_BANDS) -> tuple[int, int]:
    """Bands and rows per band: the most rows, so the fewest false collisions,
    at which at most ``most`` bands still give the recall."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - similarity)), 1)
    for rows in range(1, 16):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands <= most:
            best = (bands, rows)
    return best


def band_keys(tokens: np.ndarray, ends: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per set (none empty) and band of its MinHash signature."""
    low = set_minima(tokens ^ (tokens >> np.uint64(29)), ends, _PERMUTE[: bands * rows])
    joined = (mixed(low).reshape(-1, bands, rows) * _BAND[:rows]).sum(2, dtype=np.uint64)
    return mixed(joined + _BAND[rows : rows + bands]).astype(np.int64)


class Paragraphs(NamedTuple):
    """The paragraphs of some texts: number of the text, first line, number of
    lines and of words of each; all shingle sets in one array, and the n+1 places
    where they begin."""

    row: np.ndarray
    line: np.ndarray
    lines: np.ndarray
    words: np.ndarray
    tokens: np.ndarray
    ends: np.ndarray


def line_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where every line of some texts begins, and the n+1 numbers of the first
    line of each text. A text of n line breaks has n + 1 lines."""
    breaks = np.flatnonzero(data[: offsets[-1]] == 10) + 1
    text = np.searchsorted(offsets, breaks - 1, "right") - 1
    count = np.bincount(text, minlength=len(offsets) - 1) + 1
    first = np.concatenate([[0], np.cumsum(count)])
    starts = np.empty(first[-1], np.int64)
    inner = np.ones(first[-1], bool)
    inner[first[:-1]] = False
    starts[first[:-1]], starts[inner] = offsets[:-1], breaks
    return starts, first


def paragraphs_of(data: np.ndarray, offsets: np.ndarray, blocks: bool) -> Paragraphs:
    """The paragraphs of a run of texts; with ``blocks``, shorter lines in a row,
    none of them without words, are one."""
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    starts, first = line_starts(data, offsets)
    words, firsts = word_hashes(data, np.append(starts, len(data)))
    count = np.diff(firsts)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begins = count > 0
    if blocks:
        short = begins & (count < MIN_WORDS)
        goes_on = short.copy()
        goes_on[1:] &= short[:-1] & (row[1:] == row[:-1])
        goes_on[:1] = False
        begins &= ~goes_on
    at = np.flatnonzero(begins)
    part = np.cumsum(begins)[count > 0] - 1
    lines = np.bincount(part, minlength=len(at))
    sizes = np.diff(np.append(firsts[at], len(words)))
    keep = sizes >= MIN_WORDS
    kept = np.concatenate([[0], np.cumsum(sizes[keep])])
    hashes, places = shingle_hashes(words[np.repeat(keep, sizes)], kept, SHINGLE_WORDS)
    at, lines, sizes = at[keep], lines[keep], sizes[keep]
    return Paragraphs(row[at], at - first[row[at]], lines, sizes, *shingle_sets(hashes, places))


def enter_paragraphs(docs: DataFrame, bands: int, rows: int, blocks: bool = False) -> DataFrame:
    """One row per paragraph: document, text name, line number, number of lines,
    class, words, and the band keys of its class."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(2))
            for first, last in runs_of_texts(offsets):
                found = paragraphs_of(data, offsets[first : last + 1], blocks)
                if not len(found.row):
                    continue
                marks = band_keys(found.tokens, found.ends, bands, rows)
                at = pa.array(first + found.row)
                places = pa.array(np.arange(len(found.row) + 1, dtype=np.int32) * bands)
                columns = [
                    batch.column(0).take(at), batch.column(1).take(at),
                    pa.array(found.line.astype(np.int32)), pa.array(found.lines.astype(np.int32)),
                    pa.array(set_keys(found.tokens, found.ends)), pa.array(found.words.astype(np.int32)),
                    pa.ListArray.from_arrays(places, pa.array(marks.ravel())),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "name", "line", "lines", "class", "words", "bands"]
                )

    schema = "doc_id long, name long, line int, lines int, class long, words int, bands array<long>"
    return named_texts(docs).mapInArrow(enter, schema)


def class_bands(paragraphs: DataFrame) -> DataFrame:
    """``band, class`` with every class once; copies combine before the shuffle."""
    classes = paragraphs.groupBy("class").agg(F.first("bands").alias("bands"))
    return classes.select(F.explode("bands").alias("band"), "class")


def colliding(bands: DataFrame) -> DataFrame:
    """Edges from every class to the smallest class in each of its bands. A band
    that many classes share is never gathered."""
    least = bands.groupBy("band").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    several = least.where("least < most").select("band", "least")
    met = salted_join(bands, several, ["band"], "class")
    return met.where("class <> least").select(F.col("class").alias("a"), F.col("least").alias("b"))


def _sets(docs: DataFrame, wanted: DataFrame, blocks: bool) -> DataFrame:
    """``class, tokens`` of the wanted classes, each read at its first place
    (``doc_id, name, class``)."""
    places = wanted.groupBy("doc_id", "name").agg(F.collect_set("class").alias("wanted"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted_here = [set(x) for x in batch.column(1).to_pylist()]
            data, offsets = text_buffers(batch.column(0))
            for first, last in runs_of_texts(offsets):
                found = paragraphs_of(data, offsets[first : last + 1], blocks)
                keys = set_keys(found.tokens, found.ends).tolist()
                picked = [i for i, key in enumerate(keys) if key in wanted_here[first + found.row[i]]]
                tokens = [found.tokens[found.ends[i] : found.ends[i + 1]].tobytes() for i in picked]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[i] for i in picked], pa.int64()), pa.array(tokens, pa.binary())], ["class", "tokens"]
                )

    texts = named_texts(docs).join(places, ["doc_id", "name"]).select("text", "wanted")
    return texts.mapInArrow(sets, "class long, tokens binary").dropDuplicates(["class"])


def repeated_paragraphs(docs: DataFrame, tenths: int = TENTHS) -> DataFrame:
    """Every paragraph that has a near duplicate: ``doc_id, line, words,
    first_doc_id, first_line`` (where the component's first paragraph stands)
    and ``removed``, false for that one only."""
    require_columns(docs, "doc_id", "text")
    found = _repeated(docs, tenths, shared_folder(docs.sparkSession)).drop("lines", "name")
    named = {c: F.nullif(c, F.lit(FIRST_ID)) for c in ("doc_id", "first_doc_id")}
    return found.withColumns(named)


def _repeated(docs: DataFrame, tenths: int, folder: str, blocks: bool = False) -> DataFrame:
    spark = docs.sparkSession
    bands, rows = tune_bands(tenths / 10)
    paragraphs = stage(enter_paragraphs(docs, bands, rows, blocks), f"{folder}/paragraphs")
    entered = stage(class_bands(paragraphs), f"{folder}/bands")
    candidates = connected_components(colliding(entered)).select(F.col("node").alias("class"), F.col("component").alias("group"))
    candidates = stage(candidates, f"{folder}/groups")
    drop_stages(spark, f"{folder}/bands")
    here = F.struct("doc_id", "name", "line")
    firsts = paragraphs.groupBy("class").agg(F.min(here).alias("first"), F.count("*").alias("copies"))
    classes = stage(firsts.join(candidates, "class", "left").where("copies > 1 OR group IS NOT NULL"), f"{folder}/classes")
    wanted = classes.where("group IS NOT NULL")
    sets = _sets(docs, wanted.select("first.doc_id", "first.name", "class"), blocks)
    members = wanted.join(sets, "class").select(
        "group", F.col("class").alias("id"), F.col("copies").alias("weight"), "tokens"
    )
    links = stage(link_members(members, tenths), f"{folder}/links")
    found = connected_components(links.select(F.col("id").alias("a"), F.col("head").alias("b")))
    found = stage(found.select(F.col("node").alias("class"), "component"), f"{folder}/found")
    drop_stages(spark, f"{folder}/groups", f"{folder}/links")
    named = classes.join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))
    heads = named.groupBy("component").agg(
        F.min("first").alias("first"), F.sum("copies").alias("n")
    ).where("n > 1").select("component", "first")
    placed = salted_join(named.select("class", "component"), heads, ["component"], "class")
    out = salted_join(paragraphs, placed.select("class", "first"), ["class"], "doc_id")
    return out.select(
        "doc_id", "name", "line", "lines", "words",
        F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.line").alias("first_line"),
        (here != F.col("first")).alias("removed"),
    )


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` words, also of those across texts."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    powers, back = (np.full(len(words), b, np.uint64) for b in (_BASE, _INVERSE))
    powers[0] = back[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(powers))])
    return mixed((sums[size:] - sums[:-size]) * np.cumprod(back)[: len(words) - size + 1])


def _sliding(values: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of every ``size`` values in a row."""
    done = 1
    while done < size:
        step = min(done, size - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def cut_places(words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where the pieces of some texts begin: at every text's first word, and where
    a run of ``SEED_WORDS`` words has the least hash of ``SEED_GAP`` such runs in
    a row. Every ``SEED_WORDS + SEED_GAP - 1`` words of a text hold such a run,
    the same one wherever those words stand."""
    least = np.zeros(len(words), bool)
    least[firsts[:-1][np.diff(firsts) > 0]] = True
    whole = SEED_WORDS + SEED_GAP - 1
    if len(words) >= whole:
        owner = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        grams = run_hashes(words, SEED_WORDS)
        low = _sliding(grams, SEED_GAP, np.minimum)
        low = np.where(owner[whole - 1 :] == owner[: len(low)], low, np.uint64(0))
        rim = np.zeros(SEED_GAP - 1, np.uint64)
        high = _sliding(np.concatenate([rim, low, rim]), SEED_GAP, np.maximum)
        least[: len(grams)] |= (grams == high) & (high > 0)
    return np.flatnonzero(least)


def pieces_of(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash of its first ``SEED_WORDS`` words, text, first word and number of
    words of every piece. Near the end of a text the hash stands for nothing."""
    at = cut_places(words, firsts)
    grams = np.concatenate([run_hashes(words, SEED_WORDS), np.zeros(SEED_WORDS, np.uint64)])
    text = np.searchsorted(firsts, at, "right") - 1
    return grams[at], text, at - firsts[text], np.diff(np.append(at, len(words)))


def _pieces(hashes: np.ndarray, docs: np.ndarray, names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(hashes), PIECE)
    out["piece"], out["doc"], out["name"], out["start"] = hashes, docs, names, starts
    return out


def cut_seeds(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The seeds of ``doc_id, name, text``."""
    ids, names = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    data, offsets = text_buffers(batch.column(2))
    for first, last in runs_of_texts(offsets):
        words, firsts = word_hashes(data, offsets[first : last + 1])
        hashes, text, start, _ = pieces_of(words, firsts)
        long = np.diff(firsts)[text] >= SEED_WORDS + SEED_GAP - 1
        yield _pieces(hashes[long], ids[first + text[long]], names[first + text[long]], start[long])


def cut_runs(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """The runs of ``size`` words of ``doc_id, name, text, lines, spans`` that begin
    in a span and touch none of the lines."""
    ids, names = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    data, offsets = text_buffers(batch.column(2))
    gone, spans = batch.column(3).to_pylist(), batch.column(4).to_pylist()
    for first, last in runs_of_texts(offsets):
        inside = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        starts, line = line_starts(part, inside)
        words, of_lines = word_hashes(part, np.append(starts, len(part)))
        hashes = run_hashes(words, size)
        firsts = of_lines[line]
        lost = np.zeros(len(words) + 1, np.int64)
        for row in range(last - first):
            for number in gone[first + row] or ():
                if line[row] + number < line[row + 1]:
                    lost[of_lines[line[row] + number] + 1 : of_lines[line[row] + number + 1] + 1] = 1
        lost = np.cumsum(lost)
        for row in range(last - first):
            begin, stop = int(firsts[row]), int(firsts[row + 1]) - size + 1
            if stop <= begin:
                continue
            open_at = np.zeros(stop - begin, bool)
            for span in spans[first + row]:
                open_at[span["start"] : span["start"] + span["words"]] = True
            at = begin + np.flatnonzero(open_at)
            at = at[lost[at + size] == lost[at]]
            who = [np.full(len(at), x[first + row]) for x in (ids, names)]
            yield _pieces(hashes[at], *who, at - begin)


def first_pieces(pieces: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first of equal pieces, and the spans of the others. Pieces at the same
    place of repeated rows are not repeats of each other. The spans are: for seeds
    (``size`` below 0) where runs of ``-size`` words around any of the equal ones
    begin, and for runs of ``size`` words what lies behind the first one."""
    order = np.argsort(pieces["piece"])
    ordered = pieces["piece"][order]
    shared = np.zeros(len(order), bool)
    shared[1:] = ordered[1:] == ordered[:-1]
    shared[:-1] |= shared[1:]
    single, pieces = pieces[order[~shared]], pieces[order[shared]]
    pieces = pieces[np.lexsort((pieces["start"], pieces["name"], pieces["doc"], pieces["piece"]))]
    new = np.ones(len(pieces), bool)
    new[1:] = pieces["piece"][1:] != pieces["piece"][:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(pieces)), 0))
    doc, name, start = pieces["doc"], pieces["name"], pieces["start"].astype(np.int64)
    near = (doc == doc[head]) & (name == name[head])
    again = ~near | (start != start[head])
    if size < 0:
        again[head[again]] = True
        stop = start + 1
        start = np.maximum(stop + size + SEED_WORDS - 1, 0)
    else:
        stop = start + size
        start = np.where(near, np.maximum(start, start[head] + size), start)
    spans = merged_spans(doc[again], name[again], start[again], stop[again])
    return np.concatenate([single, pieces[new]]), spans


def merged_spans(doc: np.ndarray, name: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Spans of words, those of a document that meet or overlap made one."""
    if not len(doc):
        return np.zeros(0, SPAN)
    order = np.lexsort((start, name, doc))
    doc, name, start, stop = doc[order], name[order], start[order], stop[order]
    shift = np.cumsum(np.append(0, (doc[1:] != doc[:-1]) | (name[1:] != name[:-1]))) << 33
    furthest = np.maximum.accumulate(stop + shift)
    at = np.flatnonzero(np.append(True, (start + shift)[1:] > furthest[:-1]))
    out = np.zeros(len(at), SPAN)
    out["doc"], out["name"], out["start"] = doc[at], name[at], start[at]
    out["words"] = (furthest - shift)[np.append(at[1:], len(doc)) - 1] - start[at]
    return out


def meeting_pieces(docs: DataFrame, cut: Callable[[pa.RecordBatch], Iterator[np.ndarray]], size: int) -> DataFrame:
    """Spans ``doc_id, name, start, words`` of equal pieces, see ``first_pieces``. Of equal
    pieces in a task the first is passed on, packed by bucket of hashes, and the
    spans of the others are found at once."""
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def packed(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        kept, repeats = first_pieces(np.concatenate(parts), size)
        bucket = (mixed(kept["piece"]) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        kept, bucket = kept[order], bucket[order]
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
        rows = [(int(bucket[a]), False, x.tobytes()) for a, x in zip(cuts, np.split(kept, cuts[1:]))]
        first = int(kept["piece"][0] % np.uint64(buckets)) if len(kept) else 0
        for number, x in enumerate(np.array_split(repeats, max(1, len(repeats) >> 14))):
            rows.append(((first + number) % buckets, True, x.tobytes()))
        for start in range(0, len(rows), 256):
            bucket_ids, flags, runs = zip(*rows[start : start + 256])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket_ids, pa.int32()), pa.array(flags), pa.array(runs, pa.binary())],
                ["bucket", "repeats", "pieces"],
            )

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for out in cut(batch):
                held.append(out)
                count += len(out)
                if count >= FLUSH_PIECES:
                    yield from packed(held)
                    held, count = [], 0
        if held:
            yield from packed(held)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_in_order(batches, ["bucket"]):
            rows = list(zip(table.column("repeats").to_pylist(), table.column("pieces").to_pylist()))
            parts = [np.frombuffer(r, SPAN) for repeats, r in rows if repeats]
            open_rows = [np.frombuffer(r, PIECE) for repeats, r in rows if not repeats]
            if open_rows:
                pieces = np.concatenate(open_rows)
                ordered = np.sort(pieces["piece"])
                again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
                if len(again):
                    at = np.minimum(np.searchsorted(again, pieces["piece"]), len(again) - 1)
                    parts.append(first_pieces(pieces[again[at] == pieces["piece"]], size)[1])
            for part in parts:
                if len(part):
                    columns = [pa.array(part["doc"]), pa.array(part["name"])]
                    columns += [pa.array(part[c].astype(np.int32)) for c in ("start", "words")]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "name", "start", "words"])

    entered = docs.mapInArrow(enter, "bucket int, repeats boolean, pieces binary")
    ordered = entered.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(meet, "doc_id long, name long, start int, words int")


def _removed_lines(repeats: DataFrame) -> DataFrame:
    line = F.explode(F.sequence("line", F.col("line") + F.col("lines") - 1)).alias("line")
    removed = repeats.where("removed").select("doc_id", "name", line)
    return removed.groupBy("doc_id", "name").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def _spans(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("doc_id", "name").agg(F.collect_list(F.struct("start", "words")).alias("pieces"))


def repeated_runs(docs: DataFrame, repeats: DataFrame, folder: str) -> DataFrame:
    """Spans ``doc_id, name, start, words`` of the document's words, counted through
    all its lines, that lie in runs of ``MIN_RUN_WORDS`` words which also stand
    earlier. Runs in removed lines are none. Seeds that several places share tell
    which runs to compare; no run is compared otherwise."""
    size = MIN_RUN_WORDS
    seeds = stage(meeting_pieces(named_texts(docs), cut_seeds, -size), f"{folder}/seeds")
    found = _spans(seeds).join(_removed_lines(repeats), ["doc_id", "name"], "left")
    texts = named_texts(docs).join(found, ["doc_id", "name"]).select("doc_id", "name", "text", "lines", "pieces")
    return meeting_pieces(texts, lambda batch: cut_runs(batch, size), size)


def kept_text(text: str, lines: list[int], pieces: list[dict]) -> tuple[str, int]:
    """A text without some lines and without some spans of words, and the number
    of words in those spans. A line of which no word is left goes as well."""
    spans: list[list[int]] = []
    for start, stop in sorted((p["start"], p["start"] + p["words"]) for p in pieces):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(stop, spans[-1][1])
        else:
            spans.append([start, stop])
    gone, out, removed, first, at_span = set(lines), [], 0, 0, 0
    for number, line in enumerate(text.split("\n")):
        places = [m.start() for m in _WORD.finditer(line)] if at_span < len(spans) else []
        last = first + len(places)
        runs = []
        while at_span < len(spans) and spans[at_span][0] < last:
            start, stop = max(spans[at_span][0], first) - first, min(spans[at_span][1], last) - first
            if start < stop:
                runs.append((start, stop))
            if spans[at_span][1] > last:
                break
            at_span += 1
        first = last
        if number in gone:
            continue
        if runs:
            edges = [0, *places[1:], len(line)]
            parts, at = [], 0
            for start, stop in runs:
                parts.append(line[at : edges[start]])
                at = edges[stop]
                removed += stop - start
            line = "".join([*parts, line[at:]]).rstrip() if at == len(line) else "".join([*parts, line[at:]])
            if not _WORD.search(line):
                continue
        out.append(line)
    return "\n".join(out), removed


def remove_repeats(
    docs: DataFrame,
    repeats: DataFrame,
    pieces: DataFrame,
    names: tuple[str, str] = ("removed_lines", "removed_words"),
) -> DataFrame:
    """Documents without the removed lines and without some spans of words; adds
    ``removed_lines`` and ``removed_words`` (those of spans), or columns of other
    names. What is removed meets per document id and text."""
    require_columns(docs, "doc_id", "text")
    clash = [c for c in names if c in docs.columns]
    if clash:
        raise ValueError(f"column(s) already there: {', '.join(clash)}")
    doc_id, name, lines, runs, kept = (unused([*docs.columns, *names], f"__{c}") for c in ("id", "name", "lines", "runs", "kept"))
    found = _removed_lines(repeats).join(_spans(pieces), ["doc_id", "name"], "full").toDF(doc_id, name, lines, runs)
    named = docs.withColumns(
        {
            doc_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)),
            name: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))),
        }
    )
    joined = named.join(found, [doc_id, name], "left")

    @F.arrow_udf("struct<text:string,words:long>")
    def keep(texts: pa.Array, lines: pa.Array, pieces: pa.Array) -> pa.Array:
        rows = [
            {"text": t, "words": 0} if t is None or not (n or p) else dict(zip(("text", "words"), kept_text(t, n or [], p or [])))
            for t, n, p in zip(texts.to_pylist(), lines.to_pylist(), pieces.to_pylist())
        ]
        return pa.array(rows, pa.struct([("text", pa.string()), ("words", pa.int64())]))

    done = joined.withColumn(kept, keep(F.col("text").cast("string"), F.col(lines), F.col(runs)))
    columns = [F.col(f"{kept}.text").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return done.select(
        *columns,
        F.coalesce(lines, F.array().cast("array<int>")).alias(names[0]),
        F.col(f"{kept}.words").alias(names[1]),
    )


def dedupe_paragraphs(
    docs: DataFrame, tenths: int = TENTHS, names: tuple[str, str] = ("removed_lines", "removed_words")
) -> DataFrame:
    """Documents without their repeated paragraphs and without long passages
    elsewhere that also stand earlier; see ``remove_repeats``."""
    require_columns(docs, "doc_id", "text")
    folder = shared_folder(docs.sparkSession)
    repeats = stage(_repeated(docs, tenths, folder, blocks=True), f"{folder}/repeats")
    drop_stages(docs.sparkSession, *[f"{folder}/{name}" for name in ("paragraphs", "classes", "found")])
    pieces = stage(repeated_runs(docs, repeats, folder), f"{folder}/pieces")
    drop_stages(docs.sparkSession, f"{folder}/seeds")
    return remove_repeats(docs, repeats, pieces, names)
