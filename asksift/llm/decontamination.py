"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` turns documents into index blocks: whole documents of about
one megabyte, with a sorted term list and, per term, the word positions. It is
partitioned by document, so it needs no shuffle, its blocks are bounded and a
term that fills a third of all postings is spread over all of them.

Test phrases are looked up block by block, for all phrases at once whose rarest term
the block has: its list gives candidate starts, and those that the lists of the
next rarest terms, shifted by their offsets, do not have drop out until all terms
agree. How rare a term is, is counted over all blocks. Test items are taken in passes
of bounded bytes, so neither the driver nor a task holds a whole large benchmark.

Nulls and empty texts have no words. Repeated rows are indexed one by one, and
so are rows with equal or null ids. A null item id counts as "null", an item
without words has no phrases, and items that are given twice count once. Extra
columns are ignored, or pass through where documents come back. An empty corpus
gives an empty result; without test phrases nothing is hit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.stages import require_columns, shared_folder, stage
from .words import runs_of_texts, text_buffers, unused, word_hashes

INDEX_SCHEMA = (
    "block long, doc_ids array<long>, doc_words array<int>, "
    "terms binary, counts binary, positions binary"
)
WINDOW_WORDS = 13
#: Bytes of text in one index block; a longer document is a block of its own.
BLOCK_BYTES = 1 << 20
#: Bytes of test items that are looked up together; more take several passes, a
#: longer item one of its own.
PASS_BYTES = 2 << 20


class Phrases(NamedTuple):
    """Distinct phrases of some items: all words of the items as numbers in the
    sorted ``vocabulary``, where each phrase starts there and how long it is, the
    names of the items, and those that contain each phrase: ``owners`` from
    ``firsts`` on."""

    vocabulary: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    names: list[str]
    firsts: np.ndarray
    owners: np.ndarray


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Index blocks with the postings of every word of every document.

    Positions count the words of a block; ``doc_words`` says where documents
    end. Write the result once (``stage``) and query it often.
    """
    require_columns(docs, doc_id, text)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0)
            data, offsets = text_buffers(batch.column(1))
            for first, last in runs_of_texts(offsets, BLOCK_BYTES):
                words, places = word_hashes(data, offsets[first : last + 1])
                order = np.argsort(words, kind="stable")
                ordered = words[order]
                heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
                terms, counts = ordered[heads], np.diff(np.append(heads, len(ordered)))
                row = [
                    [number],
                    [ids.slice(first, last - first).to_pylist()],
                    [np.diff(places).astype(np.int32).tolist()],
                    [terms.tobytes()],
                    [counts.astype(np.int32).tobytes()],
                    [order.astype(np.int32).tobytes()],
                ]
                kinds = [
                    pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                    pa.binary(), pa.binary(), pa.binary(),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(row, kinds)],
                    ["block", "doc_ids", "doc_words", "terms", "counts", "positions"],
                )
                number += 1

    picked = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return picked.mapInArrow(blocks, INDEX_SCHEMA)


def test_phrases(rows: list[tuple[str, str | None]], window: int | None) -> Phrases:
    """The distinct windows of ``window`` words of (item, text) rows; a shorter
    text, or any text if ``window`` is None, is one phrase."""
    data, offsets = text_buffers(pa.array([text for _, text in rows], pa.string()))
    hashes, places = word_hashes(data, offsets)
    vocabulary, words = np.unique(hashes, return_inverse=True)
    words = words.astype(np.int32)
    counts = np.diff(places)
    sizes = counts if window is None else np.minimum(counts, window)
    n = np.where(counts > 0, counts - sizes + 1, 0)
    row = np.repeat(np.arange(len(rows)), n)
    starts = np.repeat(places[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    lengths = sizes[row]
    names = sorted({item for item, _ in rows})
    number = {name: i for i, name in enumerate(names)}
    owner = np.array([number[item] for item, _ in rows], np.int64)[row] if len(rows) else row
    # Equal phrases get one number, by the runs of words they hold.
    key = np.zeros(len(starts), np.int64)
    for size in np.unique(lengths).tolist():
        mine = np.flatnonzero(lengths == size)
        seen = np.zeros(len(mine), np.int64)
        for j in range(size):
            pair = seen * len(vocabulary) + words[starts[mine] + j]
            seen = np.unique(pair, return_inverse=True)[1]
        key[mine] = seen + key.max(initial=-1) + 1
    key, first, which = np.unique(key, return_index=True, return_inverse=True)
    pairs = np.unique(which * max(1, len(names)) + owner)
    phrase, owners = np.divmod(pairs, max(1, len(names)))
    firsts = np.searchsorted(phrase, np.arange(len(key) + 1))
    return Phrases(vocabulary, words, starts[first], lengths[first], names, firsts, owners)


def term_counts(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How often each term of the sorted vocabulary occurs in the whole index.

    One row per block and known term is combined before the shuffle; the
    result has at most as many rows as the vocabulary.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column(0), batch.column(1)):
                there = np.frombuffer(terms.as_py(), np.uint64)
                _, mine, theirs = np.intersect1d(
                    vocabulary, there, assume_unique=True, return_indices=True
                )
                total[mine] += np.frombuffer(counts.as_py(), np.int32)[theirs]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["term", "n"]
        )

    rows = (
        index.select("terms", "counts")
        .mapInArrow(counted, "term long, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    out = np.zeros(len(vocabulary), np.int64)
    for row in rows:
        out[row.term] = row.n
    return out


class _Block:
    """The postings of one index block."""

    def __init__(self, doc_words: list[int], terms: bytes, counts: bytes, positions: bytes):
        self.terms = np.frombuffer(terms, np.uint64)
        self.ends = np.cumsum(np.frombuffer(counts, np.int32))
        self.positions = np.frombuffer(positions, np.int32)
        self.docs = np.concatenate([[0], np.cumsum(np.array(doc_words, np.int64))])
        #: Which term's list has each position.
        self.lists = np.empty(len(self.positions), np.int32)
        self.lists[self.positions] = np.repeat(np.arange(len(self.terms), dtype=np.int32), np.frombuffer(counts, np.int32))

    def list_of(self, place: int) -> np.ndarray:
        return self.positions[self.ends[place - 1] if place else 0 : self.ends[place]]

    def near(self, places: list[int], reach: int) -> np.ndarray:
        """Positions of the rarest term that have every other term within
        ``reach`` words, in the same document."""
        spots = self.list_of(places[0]).astype(np.int64)
        doc = np.searchsorted(self.docs, spots, "right") - 1
        low = np.maximum(spots - reach, self.docs[doc])
        high = np.minimum(spots + reach, self.docs[doc + 1] - 1)
        for place in places[1:]:
            there = self.list_of(place)
            ok = np.searchsorted(there, low, "left") < np.searchsorted(there, high, "right")
            spots, low, high = spots[ok], low[ok], high[ok]
        return spots


HITS_SCHEMA = (
    "block long, row int, doc_id long, n_words long, "
    "starts array<int>, ends array<int>, items array<string>"
)
Found = tuple[np.ndarray, np.ndarray, np.ndarray]


class _Lookup:
    """Phrases with their terms from the rarest on, and by their rarest term."""

    def __init__(self, phrases: Phrases, rare: np.ndarray):
        self.phrases = phrases
        longest = int(phrases.lengths.max(initial=1))
        weight = np.full((len(phrases.starts), longest), np.iinfo(np.int64).max)
        for j in range(longest):
            has = np.flatnonzero(phrases.lengths > j)
            weight[has, j] = rare[phrases.words[phrases.starts[has] + j]]
        #: Offsets in each phrase, that of the rarest term first.
        self.order = np.argsort(weight, axis=1, kind="stable").astype(np.int32)
        rarest = self.terms(np.arange(len(phrases.starts)), 0)
        self.by_term = np.argsort(rarest, kind="stable")
        self.ends = np.searchsorted(rarest[self.by_term], np.arange(len(phrases.vocabulary) + 1))

    def terms(self, which: np.ndarray, rank: int) -> np.ndarray:
        """The term of some phrases that so many are rarer than."""
        return self.phrases.words[self.phrases.starts[which] + self.order[which, rank]]

    def candidates(self, block: _Block) -> tuple[np.ndarray, np.ndarray]:
        """The phrases whose terms are all in the block; where the block has each
        term of the vocabulary, or -1."""
        vocabulary = self.phrases.vocabulary
        at = np.searchsorted(vocabulary, block.terms)
        known = np.flatnonzero(at < len(vocabulary))
        known = known[vocabulary[at[known]] == block.terms[known]]
        place = np.full(len(vocabulary), -1, np.int64)
        place[at[known]] = known
        here = np.sort(at[known])
        n = self.ends[here + 1] - self.ends[here]
        which = self.by_term[np.repeat(self.ends[here] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        for rank in range(1, self.order.shape[1]):
            # A phrase without so many terms asks for its rarest again.
            asked = np.where(self.phrases.lengths[which] > rank, self.order[which, rank], self.order[which, 0])
            which = which[place[self.phrases.words[self.phrases.starts[which] + asked]] >= 0]
        return which, place


def _hits(index: DataFrame, phrases: Phrases, spans: Callable[[_Block, _Lookup], Found]) -> DataFrame:
    """One row per indexed document with what ``spans`` finds in its block: phrase,
    start and end of every match."""
    lookup = _Lookup(phrases, term_counts(index, phrases.vocabulary))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row["doc_words"], row["terms"], row["counts"], row["positions"])
                phrase, start, end = spans(block, lookup)
                doc = np.searchsorted(block.docs, start, "right") - 1
                order = np.lexsort((start, doc))
                phrase, start, end, doc = phrase[order], start[order], end[order], doc[order]
                n = len(row["doc_ids"])
                places = np.searchsorted(doc, np.arange(n + 1))
                # Every item of every match, once per document.
                many = phrases.firsts[phrase + 1] - phrases.firsts[phrase]
                owner = phrases.owners[
                    np.repeat(phrases.firsts[phrase] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                ]
                pairs = np.unique(np.repeat(doc, many) * max(1, len(phrases.names)) + owner)
                of_doc, item = np.divmod(pairs, max(1, len(phrases.names)))
                items = np.searchsorted(of_doc, np.arange(n + 1))
                columns = [
                    pa.array([row["block"]] * n, pa.int64()),
                    pa.array(range(n), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["doc_words"], pa.int64()),
                    _listed(places, pa.array((start - block.docs[doc]).astype(np.int32))),
                    _listed(places, pa.array((end - block.docs[doc]).astype(np.int32))),
                    _listed(items, pa.array([phrases.names[i] for i in item.tolist()], pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["block", "row", "doc_id", "n_words", "starts", "ends", "items"]
                )

    return index.mapInArrow(found, HITS_SCHEMA)


def _listed(places: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), values)


def _exact(block: _Block, lookup: _Lookup) -> Found:
    """Every occurrence of every phrase. The rarest term's list gives the starts;
    a start stays while the list of each further term has its place."""
    which, place = lookup.candidates(block)
    lengths = lookup.phrases.lengths
    term = place[lookup.terms(which, 0)]
    low = np.where(term > 0, block.ends[np.maximum(term - 1, 0)], 0)
    n = block.ends[term] - low
    begins = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
    phrase = np.repeat(which, n)
    start = block.positions[begins].astype(np.int64) - lookup.order[phrase, 0]
    doc = np.maximum(np.searchsorted(block.docs, start, "right") - 1, 0)
    inside = (start >= block.docs[doc]) & (start + lengths[phrase] <= block.docs[np.minimum(doc + 1, len(block.docs) - 1)])
    phrase, start = phrase[inside], start[inside]
    for rank in range(1, lookup.order.shape[1]):
        if not len(phrase):
            break
        long = lengths[phrase] > rank
        offset = np.where(long, lookup.order[phrase, rank], lookup.order[phrase, 0])
        term = place[lookup.phrases.words[lookup.phrases.starts[phrase] + offset]]
        stays = block.lists[start + offset] == term
        phrase, start = phrase[stays], start[stays]
    return phrase, start, start + lengths[phrase]


def _near(reach: int) -> Callable[[_Block, _Lookup], Found]:
    def spans(block: _Block, lookup: _Lookup) -> Found:
        which, place = lookup.candidates(block)
        phrase, start = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for p in which.tolist():
            ranks = range(int(lookup.phrases.lengths[p]))
            terms = [int(place[lookup.terms(np.array([p]), rank)[0]]) for rank in ranks]
            found = block.near(list(dict.fromkeys(terms)), reach)
            phrase.append(np.full(len(found), p))
            start.append(found)
        start = np.concatenate(start)
        return np.concatenate(phrase), start, start + 1

    return spans


def _in_passes(
    index: DataFrame,
    items: DataFrame,
    item_id: str,
    text: str,
    window: int | None,
    spans: Callable[[_Block, _Lookup], Found],
) -> DataFrame:
    """Look items up, so many bytes at a time; rows of several passes are merged."""
    require_columns(items, item_id, text)
    named = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
        F.col(text).cast("string").alias("text"),
    ).distinct()
    size = named.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    passes = max(1, -(-size // PASS_BYTES))
    share = F.pmod(F.xxhash64("item", "text"), F.lit(passes))
    parts = []
    for n in range(passes):
        rows = sorted(tuple(r) for r in named.where((share == n) & F.col("text").isNotNull()).collect())
        parts.append(_hits(index, test_phrases(rows, window), spans))
    if passes == 1:
        return parts[0]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    joined = {c: F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")}
    return out.groupBy("block", "row", "doc_id", "n_words").agg(
        joined["starts"], joined["ends"], F.array_distinct(joined["items"]).alias("items")
    )


def phrase_matches(
    index: DataFrame,
    items: DataFrame,
    window: int | None = WINDOW_WORDS,
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """Exact occurrences of the windows of the items, one row per document:
    spans of word numbers (``starts``, ``ends`` past the last) and the items.
    ``window=None`` looks for whole items."""

    return _in_passes(index, items, item_id, text, window, _exact)


def proximity_matches(
    index: DataFrame,
    items: DataFrame,
    reach: int,
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """Places where all distinct terms of an item stand within ``reach`` words
    of its rarest term, in any order. Spans are the place of that term."""

    return _in_passes(index, items, item_id, text, None, _near(reach))


def covered(starts: str, ends: str) -> F.Column:
    """Number of words inside any span: spans are taken by start, and each adds
    what lies past the furthest end so far."""
    pairs = F.array_sort(F.arrays_zip(F.col(starts).alias("s"), F.col(ends).alias("e")))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    return F.aggregate(
        pairs,
        zero,
        lambda a, x: F.struct(
            (a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["reach"]), F.lit(0))).alias("n"),
            F.greatest(a["reach"], x["e"]).alias("reach"),
        ),
        lambda a: a["n"].cast("long"),
    )


def judge(hits: DataFrame, one_in: int) -> DataFrame:
    """Add ``n_hit`` and ``contaminated`` to rows of ``phrase_matches``."""
    n_hit = F.col("n_hit")
    return hits.withColumn("n_hit", covered("starts", "ends")).withColumn(
        "contaminated", (n_hit > 0) & (n_hit * one_in >= F.col("n_words"))
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW_WORDS,
    one_in: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per document row: ``doc_id, n_words, n_hit, items, contaminated``.

    A word is hit if it lies in an occurrence of a window; a document is
    contaminated if at least one word in ``one_in`` is hit, and any at all.
    """
    folder = shared_folder(docs.sparkSession)
    index = stage(build_index(docs, doc_id, text), f"{folder}/index")
    hits = judge(phrase_matches(index, benchmark, window), one_in)
    return hits.select("doc_id", "n_words", "n_hit", "items", "contaminated")


def decontaminate_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, one_in: int = 20
) -> DataFrame:
    """The documents that are not contaminated, with all their columns, whatever
    their names. Rows are told apart by their text alone, so each row, with a
    shared id or none, is judged on its own."""
    require_columns(docs, "doc_id", "text")
    name = unused(docs.columns, "__name")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = docs.withColumn(name, F.xxhash64(text))
    found = decontaminate(named, benchmark, window, one_in, doc_id=name).where("contaminated")
    bad = found.select(F.col("doc_id").alias(name)).distinct()
    return named.join(bad, name, "left_anti").select(*docs.columns)
