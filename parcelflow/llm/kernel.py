"""Vectorised text kernels that run inside Arrow batches on executors.

Nothing here loops over characters or words in Python, but for words of hundreds of bytes.  Buffers are
cut into segments of about `SEGMENT` characters; only a longer run of one kind of character stays whole.
"""

from __future__ import annotations

import hashlib
import re
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes or characters that are worked on at once.
SEGMENT = 1 << 19
_BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64


def worker_cache(key: object, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task: tables and caches that any task may rebuild."""
    store = sys.modules.setdefault("_parcelflow_worker", types.ModuleType("_parcelflow_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    x = x + U(seed & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> U(33)
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def make(size: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        return out[0], out[1]

    size = 1 << max(20, int(n).bit_length())
    if size > 1 << 21:
        return make(size)
    return worker_cache(("powers", size), lambda: make(size))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span, by prefix sums of a polynomial modulo 2**64."""
    power, inverse = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls; offsets count from the first byte."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(off, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _byte_table() -> tuple[np.ndarray, np.ndarray]:
    code = np.arange(256, dtype=np.uint8)
    code[65:91] += 32
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return code, space


#: Longer words are hashed whole.
_LONG = 256
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def _hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span, eight bytes a step; spans of one length up to 8 never collide."""
    size = end - start
    eight = np.ndarray(len(data), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).tobytes(), 0, (1,))
    out = mix(size.astype(U) * U(0xD6E8FEB86659FD93), seed)
    at, k = np.flatnonzero(size <= _LONG), 0
    while len(at := at[size[at] > k]):
        out[at] = mix(out[at] ^ (eight[start[at] + k] & _MASKS[np.minimum(size[at] - k, 8)]), seed)
        k += 8
    for i in np.flatnonzero(size > _LONG):
        raw = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, key=seed.to_bytes(8, "little"))
        out[i] = int.from_bytes(raw.digest(), "little")
    return out


#: One seed for each lane of a word's hash.
LANES = (0x243F6A8885A308D3, 0x13198A2E03707344)


def words(col: pa.Array, lanes: int = 1, fold: bool = True) -> tuple[np.ndarray, ...]:
    """(64-bit hash of each word in order, a second independent one with lanes=2, first word of each text and then the number of words).

    A word is a maximal run of characters other than blanks and U+0009 to U+000D; with `fold`, A-Z count as a-z.
    """
    data, offsets = buffers(col)
    lower, space = worker_cache("bytes", _byte_table)
    at, where = 0, [np.zeros(0, np.int64)]
    hashes: list[list[np.ndarray]] = [[np.zeros(0, U)] for _ in range(lanes)]
    while at < len(data):
        stop = min(at + SEGMENT, len(data))
        if stop < len(data):  # cut at a blank; a longer word is taken whole
            gap = np.flatnonzero(space[data[at:stop]])
            while not len(gap) and stop < len(data):
                more = min(stop + SEGMENT, len(data))
                gap, stop = np.flatnonzero(space[data[stop:more]]) + stop - at, more
            if len(gap):
                stop = at + int(gap[-1]) + 1
        part = lower[data[at:stop]] if fold else data[at:stop]
        inside = np.zeros(len(part) + 2, bool)
        inside[1:-1] = ~space[part]
        cuts = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, stop, "right")] - at
        cut = np.zeros(len(part) + 1, bool)
        cut[cuts] = True
        start = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
        end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
        for out, seed in zip(hashes, LANES[:lanes], strict=True):
            out.append(_hashed(part, start, end, seed))
        where.append(start + at)
        at = stop
    return *map(np.concatenate, hashes), np.searchsorted(np.concatenate(where), offsets)


def distinct(pairs: np.ndarray) -> np.ndarray:
    """Sorted distinct rows of an array of two columns."""
    pairs = pairs[np.argsort(pairs[:, 0])]
    same = pairs[1:, 0] == pairs[:-1, 0]
    if (pairs[1:, 1] != pairs[:-1, 1])[same].any():  # one first hash, two second ones
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        same = (pairs[1:] == pairs[:-1]).all(1)
    return pairs[np.append(True, ~same)[: len(pairs)]]


def shingles(col: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text, the distinct 128-bit hashes of its runs of `size` words: two columns, sorted.

    A text of fewer words gives its whole sequence as one shingle; a text without words gives none.
    """
    *lanes, first = words(col, 2)
    runs = []
    for hashed, seed in zip(lanes, LANES, strict=True):
        run = mix(hashed, seed + size)
        for j in range(1, size):
            run = mix(run[: max(0, len(hashed) - j)] ^ mix(hashed[j:], seed + j), seed)
        runs.append(run)
    both = np.stack(runs, 1) if len(runs[0]) else np.zeros((0, 2), U)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            yield distinct(both[a : b - size + 1])
        elif b > a:
            x = np.full(2, b - a, U)
            for k in range(a, b):
                x = mix(x ^ np.array([lane[k] for lane in lanes], U), LANES[0])
            yield x[None, :]
        else:
            yield np.zeros((0, 2), U)


class HashIndex:
    """Open addressing over 64-bit keys, probed and filled by whole arrays."""

    def __init__(self, bits: int = 16) -> None:
        self.keys, self.values, self.size = np.zeros(1 << bits, U), np.zeros(1 << bits, np.int32), 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * U(0x9E3779B97F4A7C15)) >> U(65 - len(self.keys).bit_length())

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none.  Key 0 stands for nothing and is never held."""
        out = np.full(len(keys), -1, np.int32)
        mask, rest, slot = U(len(self.keys) - 1), np.arange(len(keys)), self._slot(keys)
        while len(rest):
            held = self.keys[slot]
            hit = held == keys[rest]
            out[rest[hit]] = self.values[slot[hit]]
            on = ~hit & (held != 0)
            rest, slot = rest[on], (slot[on] + U(1)) & mask
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Hold distinct keys that are not yet held."""
        if (self.size + len(keys)) * 2 > len(self.keys):
            old = self.keys != 0
            bits = max(len(self.keys) * 2, 4 * (self.size + len(keys)))
            k, v = self.keys[old], self.values[old]
            self.keys, self.values, self.size = np.zeros(1 << (bits - 1).bit_length(), U), np.zeros(1 << (bits - 1).bit_length(), np.int32), 0
            self._put(k, v)
        self._put(keys, values)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.size += len(keys)
        mask = U(len(self.keys) - 1)
        slot = self._slot(keys)
        values = values.astype(np.int32)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] == 0)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.values[slot[won]] = keys[won], values[won]
            left = np.ones(len(keys), bool)
            left[won] = False
            keys, values, slot = keys[left], values[left], (slot[left] + U(1)) & mask


_OTHER, _LETTER, _NUMBER, _WHITE = 0, 1, 2, 3


def classes(members: Callable[[str, str], str]) -> np.ndarray:
    """The kind of each code point, as the engine that defines a vocabulary's pattern sees it.

    members(regex, text) gives the characters of a text that match; surrogates, which no text holds,
    count as other signs.
    """
    out = np.zeros(0x110000, np.uint8)
    for at in range(0, len(out), 1 << 12):
        text = "".join(chr(c) for c in range(at, at + (1 << 12)) if not 0xD800 <= c < 0xE000)
        for kind, regex in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_WHITE, r"\s")):
            out[np.frombuffer(members(regex, text).encode("utf-32-le"), np.uint32)] = kind
    return out


def runs_of(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of runs of equal values: what a driver that has probed an engine sends to its workers."""
    at = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1]))
    return np.diff(np.append(at, len(kinds))), kinds[at]


def _starts(cp: np.ndarray, first: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the pieces begin that the pattern of the public byte-level vocabularies cuts.

    The pattern takes contractions, runs of letters, of numbers and of other signs, each with one
    blank before it, and white space.  `first` has the places where texts begin.
    """
    n = len(cp)
    kind = kinds[cp]
    new = np.zeros(n + 1, bool)
    new[first] = True
    new[n] = True
    white, blank = kind == _WHITE, cp == 32
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    change |= new[:-1]
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1]
    after_blank &= ~new[:-1]
    start = change & (white | ~after_blank)
    ends = np.append(~white[1:], True) & white & ~new[1:]  # the last white character before another sign
    start |= ends
    # contractions: a lone apostrophe, not after a blank, with letters behind it
    lone = np.flatnonzero((cp == 39) & change & ~after_blank)
    lone = lone[~new[lone + 1]]
    lone = lone[kind[lone + 1] == _LETTER]
    if len(lone):
        a = cp[lone + 1]
        two = np.minimum(lone + 2, n - 1)
        b = np.where(new[lone + 2], 0, cp[two])
        short = np.isin(a, [ord(c) for c in "stmd"])
        long = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l")))
        start[lone[short | long] + 1] = False
        for at, more in ((lone[short], 2), (lone[long], 3)):
            at = at + more
            at = at[at < n]
            at = at[(kind[at] == _LETTER) & ~new[at]]
            start[at] = True
    return np.flatnonzero(start | new[:-1])


class PieceEncoder:
    """Token ids of whole texts, by pieces whose ids are kept once they are known.

    `encode` gives the ids of pieces, one after the other, and how many each has; `kinds` are the character classes of the pattern; `special`
    are strings that are one id wherever they stand.  At most `most` pieces are kept, then all are
    forgotten.  A kept piece is found by its hash and compared by its characters.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], kinds: np.ndarray, special: dict[str, int] | None = None, most: int = 1 << 19) -> None:
        self.encode, self.kinds, self.special, self.most = encode, kinds, special or {}, most
        self.cuts = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if special else None
        self._forget()

    def _forget(self) -> None:
        self.index, self.count = HashIndex(18), 0
        # of each piece its ids and its characters, one after the other
        self.ids, self.chars = _Runs(np.int32), _Runs(np.uint32)

    def _store(self, text: str, cp: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of new entries for text[start:end]; `cp` has the code points of the text."""
        ids, lengths = self.encode([text[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)])
        self.ids.add(ids, lengths)
        size = end - start
        self.chars.add(cp[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())], size)
        self.count += len(start)
        return np.arange(self.count - len(start), self.count)

    def _part(self, text: str, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of a segment, and how many each of its texts has."""
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        start = _starts(cp, first, self.kinds)
        end = np.append(start[1:], len(cp))
        keys = span_hashes(mix(cp.astype(U), 0x1B873593), start, end)
        keys[keys == 0] = 1
        if self.count > self.most:
            self._forget()
        found = self.index.get(keys)
        new = np.flatnonzero(found < 0)
        if len(new):
            distinct_, at = np.unique(keys[new], return_index=True)
            self.index.add(distinct_, self._store(text, cp, start[new[at]], end[new[at]]))
            found[new] = self.index.get(keys[new])
        # pieces whose hash is that of other characters get entries of their own
        place = np.minimum(np.repeat(self.chars.start[found] - start, end - start) + np.arange(len(cp)), len(self.chars.flat) - 1)
        same = np.logical_and.reduceat(self.chars.flat[place] == cp, start) & (self.chars.length[found] == end - start) if len(start) else np.zeros(0, bool)
        if not same.all():
            found[~same] = self._store(text, cp, start[~same], end[~same])
        lengths = self.ids.length[found].astype(np.int64)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids.flat[np.repeat(self.ids.start[found] - (ends - lengths), lengths) + np.arange(total)]
        upto = np.append(0, ends)[np.searchsorted(start, np.append(first, len(cp)))]
        return ids, np.diff(upto)

    def _cut(self, text: str) -> Iterator[str | int]:
        """Parts of a text and special ids, in order."""
        at = 0
        for m in self.cuts.finditer(text) if self.cuts else ():
            yield text[at : m.start()]
            yield self.special[m.group()]
            at = m.end()
        yield text[at:] if at else text

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out: list[list] = [[] for _ in texts]
        batch: list[tuple[int, int, str]] = []
        held = 0

        def flush() -> None:
            sizes = np.array([len(t) for _, _, t in batch], np.int64)
            ids, counts = self._part("".join(t for _, _, t in batch), np.cumsum(sizes) - sizes)
            for (i, k, _), part in zip(batch, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                out[i][k] = part
            batch.clear()

        for i, text in enumerate(texts):
            for piece in self._cut(text):
                if isinstance(piece, int):
                    out[i].append(np.array([piece], np.int32))
                    continue
                for part in safe_parts(piece, self.kinds):
                    batch.append((i, len(out[i]), part))
                    out[i].append(None)
                    held += len(part)
                    if held >= SEGMENT:
                        flush()
                        held = 0
        if batch:
            flush()
        return [np.concatenate(x) if len(x) != 1 else x[0] for x in (y or [np.zeros(0, np.int32)] for y in out)]


class _Runs:
    """Arrays of different lengths kept one after the other."""

    def __init__(self, kind: type) -> None:
        self.start, self.length, self.flat = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 14, kind)
        self.count = self.used = 0

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        total, n = len(flat), len(lengths)
        while self.count + n > len(self.start):
            self.start, self.length = np.concatenate([self.start, self.start]), np.concatenate([self.length, self.length])
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, self.flat])
        self.start[self.count : self.count + n] = self.used + np.cumsum(lengths) - lengths
        self.length[self.count : self.count + n] = lengths
        self.flat[self.used : self.used + total] = flat
        self.count, self.used = self.count + n, self.used + total


def safe_parts(text: str, kinds: np.ndarray) -> Iterator[str]:
    """A text in parts of about SEGMENT characters, cut where a run of letters or numbers ends: there a piece begins."""
    at = 0
    while len(text) - at > SEGMENT:
        cut = at + SEGMENT
        while cut < len(text):
            near = kinds[np.frombuffer(text[cut - 1 : cut + SEGMENT].encode("utf-32-le", "surrogatepass"), np.uint32)]
            ends = np.flatnonzero(((near[:-1] == _LETTER) | (near[:-1] == _NUMBER)) & (near[1:] != near[:-1]))
            if len(ends):
                cut += int(ends[0])
                break
            cut += len(near) - 1
        yield text[at:cut]
        at = cut
    if at < len(text):
        yield text[at:] if at else text
