"""Tokens of whole texts through a tokenizers file, each distinct chunk encoded once as long as a worker remembers it.

A text is cut at places where neither tokenizer can join what stands on both sides; so the ids of a text are those of
its chunks, one after the other, exactly as the library gives them for the whole text.
"""

import os
from itertools import chain

import numpy as np
import pandas as pd

from .spans import prefix_sums, ragged, span_hash, words

SLOTS, POOL = 1 << 21, 1 << 23  #: chunks and ids that a worker remembers at most; what is forgotten is encoded again
_codecs: dict = {}

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_STOP = np.zeros(256, bool)  # ASCII signs that are no letter, figure, white space or apostrophe (which begins 's and the like)
_STOP[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = True


def _sign_cuts(buf: np.ndarray) -> np.ndarray:
    """Places between a Latin letter and a sign after it, or a sign and an ASCII letter after it: always a border of pre-tokens."""
    letter, stop = _ASCII_LETTER[buf], _STOP[buf]
    out = np.zeros(len(buf), bool)
    out[1:] = (letter[:-1] & stop[1:]) | (stop[:-1] & letter[1:])
    wide = (buf[:-2] == 0xC3) & (buf[1:-1] != 0x97) & (buf[1:-1] != 0xB7) & stop[2:]  # a letter of two bytes
    out[2:] |= wide
    return out


def space_led(buf: np.ndarray, offsets: np.ndarray):
    """Chunks that begin a text, begin with a space before a character that isn't white space, or stand between a letter and a
    sign; they cover every byte.

    After a run of white space, a GPT-2 style pattern gives the last space to the next word and all before it to a token
    of its own, whether or not the word follows. Bytes that may begin other white space are never cut before.
    """
    if not len(buf):
        return (np.zeros(0, np.int64),) * 3
    after = np.append(buf[1:], np.uint8(32))
    cut = (buf == 32) & (after > 32) & (after != 0xC2) & (after != 0xE1) & (after != 0xE2) & (after != 0xE3)
    begins = offsets[:-1][np.diff(offsets) > 0]
    cut[offsets[1:][np.diff(offsets) > 0] - 1] = False
    cut |= _sign_cuts(buf)
    cut[begins] = True
    start = np.flatnonzero(cut)
    return start, np.append(start[1:], len(buf)), np.searchsorted(offsets, start, "right") - 1


def word_parts(buf: np.ndarray, offsets: np.ndarray):
    """Words between white space, cut further between a letter and a sign."""
    start, end, text = words(buf, offsets)
    if not len(start):
        return start, end, text
    inside = np.flatnonzero(_sign_cuts(buf))
    word = np.searchsorted(start, inside, "right") - 1
    keep = (word >= 0) & (inside > start[word]) & (inside < end[word])
    inside, word = inside[keep], word[keep]
    starts = np.concatenate([start, inside])
    order = np.argsort(starts, kind="stable")
    owner = np.concatenate([np.arange(len(start)), word])[order]
    starts = starts[order]
    last = np.append(owner[1:] != owner[:-1], True)
    ends = np.where(last, end[owner], np.append(starts[1:], 0))
    return starts, ends, text[owner]


class Codec:
    """encode(strings) -> lists of ids; chunks(buf, offsets) -> start, end, text of each chunk.

    Ids of chunks that came before are kept in one array, found by a table with one place for each hash."""

    def __init__(self, encode, chunks):
        self.encode, self.chunks = encode, chunks
        self._forget()

    def _forget(self):
        self.key, self.start, self.size = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        self.pool, self.used = np.zeros(POOL, "<u4"), 0

    def _add(self, seen: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        slot = (seen & np.uint64(SLOTS - 1)).astype(np.int64)
        self.key[slot] = seen
        won = self.key[slot] == seen  # of those that share a place, one stays
        self.start[slot[won]], self.size[slot[won]] = start[won], size[won]

    def _known(self, seen: np.ndarray, strings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Array of ids, and start and size there of each of the distinct hashes; strings(i) gives the chunks to encode."""
        slot = (seen & np.uint64(SLOTS - 1)).astype(np.int64)
        hit = self.key[slot] == seen
        start, size = np.where(hit, self.start[slot], 0).astype(np.int64), np.where(hit, self.size[slot], 0).astype(np.int64)
        new = np.flatnonzero(~hit)
        if not len(new):
            return self.pool, start, size
        found = self.encode(strings(new))
        size[new] = np.fromiter(map(len, found), np.int64, len(new))
        flat = np.fromiter(chain.from_iterable(found), "<u4", int(size[new].sum()))
        if self.used + len(flat) > len(self.pool):
            flat = np.concatenate([self.pool[ragged(start[hit], size[hit])], flat])
            order = np.concatenate([np.flatnonzero(hit), new])
            start[order] = np.cumsum(size[order]) - size[order]
            self._forget()
            if len(flat) > len(self.pool):  # one block's ids alone are too many to remember
                return flat, start, size
            new = order
        else:
            start[new] = self.used + np.cumsum(size[new]) - size[new]
        self.pool[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self._add(seen[new], start[new], size[new])
        return self.pool, start, size

    def ids(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and each text's count."""
        start, end, text = self.chunks(buf, offsets)
        number, seen = pd.factorize(span_hash(prefix_sums(buf), start, end))
        first = np.zeros(len(seen), np.int64)
        first[number[::-1]] = np.arange(len(number) - 1, -1, -1)
        data = buf.tobytes()

        def strings(some):
            return [data[s:e].decode("utf-8", "replace") for s, e in zip(start[first[some]].tolist(), end[first[some]].tolist(), strict=True)]

        pool, place, size = self._known(seen, strings)
        count = size[number]
        return pool[ragged(place[number], count)], np.bincount(text, weights=count, minlength=len(offsets) - 1).astype(np.int64)


def file_codec(path: str, kind: str) -> Codec:
    """kind: "space" for byte-level BPE that keeps white space, "words" for tokenizers that drop it."""
    if (path, kind) not in _codecs:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        _codecs[path, kind] = Codec(lambda texts: [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], {"space": space_led, "words": word_parts}[kind])
    return _codecs[path, kind]


def with_end(ids: np.ndarray, count: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with end_id after each text's ids."""
    total = count + 1
    out = np.full(int(total.sum()), end_id, "<u4")
    out[ragged(np.cumsum(total) - total, count)] = ids
    return out, total
