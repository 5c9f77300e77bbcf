"""Token ids of whole texts by the tokenizers library, with each distinct piece encoded once.

Byte-level BPE merges only inside pieces of a text (a word with its leading space, a run of digits,
...). The pieces of a batch are found with array operations over the code points, hashed, and only
pieces that this worker hasn't met are handed to the library; the ids of a text are those of its
pieces in a row. Texts are ordinary text: strings of special tokens in them aren't special.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from footmark.llm.common import CHUNK_CHARS, chunks, codepoints, hash_runs

VOCABULARY = "byte_bpe_50k.json"
#: Pieces that a worker remembers (about 30 bytes each); then it starts anew.
CACHE_PIECES = 1 << 21


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """1 letter, 2 number, 3 white space, 0 other, by code point."""
    import regex
    table = np.zeros(0x110000, dtype=np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every, at = "".join(map(chr, points)), np.array(points)
    for code, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
        for m in regex.finditer(pattern, every):
            table[at[m.start():m.end()]] = code
    return table


def piece_starts(cp: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the pieces begin: runs of letters, of numbers and of other characters, each with one
    space (U+0020) before it; of white space before a run, all but its last character is a piece,
    and the last one too if it isn't a space; apostrophe endings ('s 't 're 've 'm 'll 'd) are
    pieces of their own if no space precedes them."""
    n = len(cp)
    if not n:
        return np.zeros(0, dtype=np.int64)
    k = _classes()[cp]
    head = np.zeros(n + 4, dtype=bool)          # first character of a text
    head[off[:-1][off[:-1] < n]] = True
    head[n:] = True
    start = head[:n].copy()
    start[1:] |= k[1:] != k[:-1]
    last = np.zeros(n, dtype=bool)              # last white space before something else
    last[:-1] = (k[:-1] == 3) & (k[1:] != 3) & ~head[1:n]
    start |= last
    joins = np.flatnonzero(last & (cp == 32)) + 1
    start[joins] = False
    q = np.flatnonzero((cp == 39) & start & ~head[1:n + 1])
    q = q[q + 1 < n]
    if len(q):
        pad = np.append(cp, [0, 0, 0])
        c1 = pad[q + 1]
        c2 = np.where(head[q + 2], 0, pad[q + 2])
        pair = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) \
            | ((c1 == ord("l")) & (c2 == ord("l")))
        one = (c1 == ord("s")) | (c1 == ord("t")) | (c1 == ord("m")) | (c1 == ord("d"))
        size = np.where(one, 1, np.where(pair, 2, 0))
        q, size = q[size > 0], size[size > 0]
        start[q + 1] = False
        ends = q + 1 + size
        start[ends[ends < n]] = True
    return np.flatnonzero(start)


def _merge(a: tuple, b: tuple) -> tuple:
    both = [np.concatenate(x) for x in zip(a, b)]
    order = np.argsort(both[0])
    return tuple(x[order] for x in both)


class Encoder:
    """Encodes lists of texts; see :func:`encoder`."""

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path or default_tokenizer())
        self.tok.encode_special_tokens = True
        # the pieces are cut already: only the byte alphabet is left to the library's pre-tokeniser
        self.tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        self.id_bytes = np.zeros(size, dtype=np.int64)  # the byte alphabet has one character a byte
        for token, i in self.tok.get_vocab(with_added_tokens=False).items():
            self.id_bytes[i] = len(token)
        self._clear()

    def _clear(self):
        # two sorted tables of (hash, first id, number of ids); the small one takes what is new
        self.tables = [tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.int64)) for _ in range(2)]
        self.pool = np.zeros(1 << 16, dtype=self.dtype)
        self.used = 0

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encodes new pieces; (first id, number of ids) of each."""
        e = self.tok.encode_batch_fast([pieces], is_pretokenized=True, add_special_tokens=False)[0]  # without offsets
        ids = np.array(e.ids, dtype=self.dtype)
        # where a piece's ids end: where their bytes reach the piece's bytes
        ends = np.searchsorted(np.cumsum(self.id_bytes[ids]), np.cumsum([len(p.encode("utf-8")) for p in pieces])) + 1
        n = np.diff(ends, prepend=0)
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool) + len(ids), dtype=self.dtype)])
        self.pool[self.used:self.used + len(ids)] = ids
        first = np.cumsum(n) - n + self.used
        self.tables[1] = _merge(self.tables[1], (hashes, first, n))
        self.used += len(ids)
        if len(self.tables[1][0]) > 50_000 + len(self.tables[0][0]) // 8:
            self.tables = [_merge(*self.tables), tuple(x[:0] for x in self.tables[1])]
        return first, n

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first id, number of ids) of each piece; 0 ids: not met yet (each piece has an id)."""
        first, count = (np.zeros(len(hashes), dtype=np.int64) for _ in range(2))
        for known, at, n in self.tables:
            if len(known):
                slot = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = np.flatnonzero(known[slot] == hashes)
                first[hit], count[hit] = at[slot[hit]], n[slot[hit]]
        return first, count

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids start, with the end)."""
        joined, cp, off = codepoints(texts)
        at = piece_starts(cp, off)
        if not len(at):
            return np.zeros(0, dtype=self.dtype), np.zeros(len(texts) + 1, dtype=np.int64)
        hashes, where, inverse = np.unique(hash_runs(cp, at), return_index=True, return_inverse=True)
        if sum(len(t[0]) for t in self.tables) + len(hashes) > CACHE_PIECES:
            self._clear()
        first, count = self._find(hashes)
        new = count == 0
        if new.any():
            ends = np.append(at[1:], len(cp))
            first[new], count[new] = self._learn(hashes[new], [joined[s:e] for s, e in zip(at[where[new]].tolist(), ends[where[new]].tolist())])
        first, count = first[inverse], count[inverse]
        ends = np.cumsum(count)
        take = np.repeat(first - (ends - count), count) + np.arange(int(ends[-1]))
        starts = np.concatenate([[0], ends])[np.searchsorted(at, off)]
        return self.pool[take], starts

    def batches(self, texts: list[str]):
        """(first text, last text, ids, starts) for one chunk of the texts after another."""
        for lo, hi in chunks(texts, CHUNK_CHARS):
            yield lo, hi, *self.encode(texts[lo:hi])


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Encoder:
    """One encoder a worker process: what it has met serves all tasks of the process."""
    return Encoder(path)
