"""Token ids of many texts at once, by the files of public tokenizers.

``Encoder`` reads a file of the tokenizers library. If that describes a plain
byte-level BPE, texts are first cut where a blank follows a visible ASCII character or
a Latin letter, and where a mark or digit follows a Latin letter: the tokenizer begins
a new word there, whatever stands around it, so the pieces' ids in a row are the text's. Equal pieces are encoded once, by the same merges
in tiktoken; very long pieces and those with special tokens go through the tokenizers
library, as do the whole texts of any other tokenizer.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .words import runs_of_texts, text_buffers

#: Bytes of text whose pieces are told apart at once; a longer text is taken alone.
RUN_BYTES = 4 << 20
#: Distinct pieces that are kept with their ids; more are encoded when they come.
MEMO_PIECES = 1 << 19
LONGEST_PIECE = 1 << 11

# How byte-level BPE splits a text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_names() -> dict[str, int]:
    """The visible character that stands for each byte in a byte-level vocabulary:
    itself where it is visible in Latin-1, else the next one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


def plain_ranks(spec: dict) -> dict[bytes, int] | None:
    """Bytes and id of every token, if ids alone say which pair merges first."""
    model, split = spec.get("model") or {}, spec.get("pre_tokenizer") or {}
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    plain = (
        model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        and not split.get("add_prefix_space") and not spec.get("normalizer") and not any(model.get(x) for x in odd)
    )
    if not plain:
        return None
    names, vocabulary = byte_names(), model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [vocabulary.get("".join(pair), -1) for pair in pairs]
    special = {t["content"] for t in spec.get("added_tokens", ())}
    single = [vocabulary[t] for t in vocabulary if len(t) == 1]
    if made != sorted(set(made)) or len(single) != 256 or (made and max(single) > made[0]):
        return None
    if len(vocabulary.keys() - special) != 256 + len(made):
        return None
    return {bytes(names[c] for c in t): i for t, i in vocabulary.items() if t not in special}


class Encoder:
    """Ids of texts by one tokenizer file, without added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_file(path)
        self.special = [t["content"].encode() for t in spec.get("added_tokens", ())]
        self.words = None
        ranks = plain_ranks(spec)
        if ranks:
            import tiktoken

            self.words = tiktoken.Encoding(path, pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.memo: dict[bytes, bytes] = {}

    def _piece(self, piece: bytes, special: list[bytes]) -> bytes:
        text = piece.decode()
        if len(piece) > LONGEST_PIECE or (special and any(s in piece for s in special)):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.words.encode_ordinary(text)
        found = array("I", ids).tobytes()
        if len(self.memo) < MEMO_PIECES:
            self.memo[piece] = found
        return found

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, a null counting as empty, and the n+1
        places where those of a text begin."""
        data, offsets = text_buffers(column)
        parts, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for first, last in runs_of_texts(offsets, RUN_BYTES):
            run = data[offsets[first] : offsets[last]]
            inside = offsets[first : last + 1] - offsets[first]
            by_pieces = self.words and not any(s.split() != [s] for s in self.special)
            ids, count = (self._by_pieces if by_pieces else self._by_texts)(run, inside)
            parts.append(ids)
            counts.append(count)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(counts))])

    def _by_texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw, ends = data.tobytes(), offsets.tolist()
        texts = [raw[a:b].decode() for a, b in zip(ends[:-1], ends[1:])]
        found = [np.array(e.ids, np.uint32) for e in self.whole.encode_batch(texts, add_special_tokens=False)]
        return np.concatenate(found), np.array([len(x) for x in found], np.int64)

    def _by_pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        special = [s for s in self.special if s in raw]
        blank = (data == 32) | (data == 10)
        visible = (data > 32) & (data < 127)
        low = data | 32
        latin = (low >= ord("a")) & (low <= ord("z"))
        mark = visible & ~latin
        # U+00C0 to U+00FF, by their second byte, but for two signs.
        latin[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        begins = np.zeros(len(data) + 1, bool)
        begins[1:-1] = blank[1:] & (visible | latin)[:-1]
        if not special:  # these have marks inside
            begins[1:-1] |= mark[1:] & latin[:-1]
        begins[offsets] = True
        cuts = np.flatnonzero(begins)
        cuts = cuts.astype(np.int32 if len(data) < 1 << 31 else np.int64)
        kind = pa.binary() if cuts.dtype == np.int32 else pa.large_binary()
        buffers = [None, pa.py_buffer(cuts), pa.py_buffer(raw)]
        pieces = pa.Array.from_buffers(kind, len(cuts) - 1, buffers).dictionary_encode()
        known = self.memo.get
        found = [known(p) or self._piece(p, special) for p in pieces.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        which = pieces.indices.to_numpy()
        n = sizes[which]
        ends = np.concatenate([[0], np.cumsum(n)])
        starts = np.cumsum(sizes) - sizes
        ids = flat[np.repeat(starts[which] - ends[:-1], n) + np.arange(ends[-1])]
        of_texts = ends[np.searchsorted(cuts, offsets)]
        return ids, np.diff(of_texts)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a file, read once per Python worker."""
    return Encoder(path)
