"""Open-addressed NumPy table that interns the n-grams of a batch of texts.

Everything works on whole arrays: words are cut from one byte buffer, n-grams are
byte ranges of it, their xxhash64 keys are computed for all of them at once, and
the table resolves all pending n-grams one probe at a time.  A slot holds the place
of its n-gram's bytes, its bucket and its count; a key match counts only after the
bytes are compared, so n-grams whose keys collide get slots of their own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # bytes interned at once; bounds memory, changes no result
_PAD = 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Word bytes after lower-casing: digits, a-z and every byte of a character above 0x7F.
_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True

# The five primes of xxhash64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _words8(buf: np.ndarray) -> np.ndarray:
    """The eight bytes that start at each place of a padded buffer."""
    return np.ndarray(shape=(len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))


def xxhash64(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of many byte ranges of a buffer padded by 16 bytes.

    Ranges under 32 bytes are hashed together, lane by lane; longer ones one by one."""
    import xxhash
    with np.errstate(over="ignore"):
        h = _P5 + lens.astype(np.uint64)
        at8 = _words8(buf)
        at4 = np.ndarray(shape=(len(buf) - 3,), dtype="<u4", buffer=buf, strides=(1,))
        for lane in range(3):
            i = np.flatnonzero(lens >= 8 * lane + 8)
            if not len(i):
                break
            k = _rotl(at8[starts[i] + 8 * lane] * _P2, 31) * _P1
            h[i] = _rotl(h[i] ^ k, 27) * _P1 + _P4
        at, rest = starts + (lens & ~7), lens & 7
        i = np.flatnonzero(rest >= 4)
        h[i] = _rotl(h[i] ^ (at4[at[i]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at, rest = at + (rest & 4), rest & 3
        for b in range(3):
            i = np.flatnonzero(rest > b)
            h[i] = _rotl(h[i] ^ (buf[at[i] + b].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
    for i in np.flatnonzero(lens >= 32):
        h[i] = xxhash.xxh64_intdigest(buf[starts[i]:starts[i] + lens[i]].tobytes())
    return h


def _same_bytes(buf: np.ndarray, a: np.ndarray, b: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Whether ranges of equal lengths hold equal bytes, eight bytes at a time."""
    at8, ok = _words8(buf), np.ones(len(a), dtype=bool)
    for lane in range(8):
        i = np.flatnonzero(lens > 8 * lane)
        if not len(i):
            return ok
        left = np.minimum(lens[i] - 8 * lane, 8).astype(np.uint64)
        diff = at8[a[i] + 8 * lane] ^ at8[b[i] + 8 * lane]
        ok[i] &= (diff << (np.uint64(64) - np.uint64(8) * left)) == 0
    for i in np.flatnonzero(ok & (lens > 64)):
        ok[i] = np.array_equal(buf[a[i]:a[i] + lens[i]], buf[b[i]:b[i] + lens[i]])
    return ok


class NgramTable:
    """``slot`` of every occurrence; per slot ``count`` and ``bucket``."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray, buckets: int, hashes=xxhash64):
        n = len(starts)
        mask = (1 << max(4, (2 * n).bit_length())) - 1  # at most half full
        owner = np.full(mask + 1, -1, dtype=np.int64)
        keys = hashes(buf, starts, lens)
        slot = np.empty(n, dtype=np.int64)
        todo, at = np.arange(n), (keys & np.uint64(mask)).astype(np.int64)
        while len(todo):
            free = owner[at] < 0
            owner[at[free]] = todo[free]  # of several claims of one slot the last stands
            who = owner[at]
            same = (keys[who] == keys[todo]) & (lens[who] == lens[todo])
            i = np.flatnonzero(same)
            same[i] = _same_bytes(buf, starts[who[i]], starts[todo[i]], lens[todo[i]])
            slot[todo[same]] = at[same]
            todo, at = todo[~same], (at[~same] + 1) & mask
        used = np.flatnonzero(owner >= 0)
        compact = np.empty(mask + 1, dtype=np.int64)
        compact[used] = np.arange(len(used))
        self.slot = compact[slot]
        self.count = np.bincount(self.slot, minlength=len(used))
        first = owner[used]
        view = memoryview(buf)
        self.bucket = np.fromiter((zlib.crc32(view[s:s + m]) % buckets for s, m in
                                   zip(starts[first].tolist(), lens[first].tolist())), np.int64, len(first))


def _ngrams(raw: np.ndarray, offsets: np.ndarray, max_n: int, carried: int = 0):
    """Words and n-grams of the texts ``raw[offsets[i]:offsets[i + 1]]``.

    Returns (buffer, starts, lengths, text of each n-gram, words per text, places of
    words in ``raw``).  ``carried``: that many words of the (only) text were counted
    before; n-grams that end in them are left out."""
    low = _LOWER[raw]
    word = _WORD[low]
    n = len(low)
    inner = offsets[(offsets > 0) & (offsets < n)]
    before = np.zeros(n, dtype=bool)
    before[1:] = word[:-1]
    before[inner] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = word[1:]
    after[inner - 1] = False
    ws, we = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    cut = np.searchsorted(ws, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(cut))
    wl = we - ws
    if max_n == 1:
        buf = np.zeros(n + _PAD, dtype=np.uint8)
        buf[:n] = low
        return buf, ws[carried:], wl[carried:], text[carried:], np.diff(cut), ws
    # words joined by one space, so that every n-gram is one range
    ends = np.cumsum(wl + 1) - 1
    buf = np.full((int(ends[-1]) + 1 if len(ends) else 0) + _PAD, 0x20, dtype=np.uint8)
    buf[np.arange(int(wl.sum())) + np.repeat(np.arange(len(wl)), wl)] = low[word]
    ss, ls, ts = [], [], []
    for k in range(1, max_n + 1):
        last = np.arange(max(k - 1, carried), len(ws))
        last = last[text[last - k + 1] == text[last]]
        s = ends[last - k + 1] - wl[last - k + 1]
        ss.append(s)
        ls.append(ends[last] - s)
        ts.append(text[last])
    return buf, np.concatenate(ss), np.concatenate(ls), np.concatenate(ts), np.diff(cut), ws


def interned(texts: pa.Array, buckets: int, max_n: int, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple]:
    """Yields (first row, number of rows, table, row of each occurrence (from 0 in
    the slice), new words of each row) over slices of an Arrow text column; null
    counts as empty.  A text longer than a slice comes in several slices."""
    arr = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row, rows = 0, len(arr)
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + slice_bytes, "right")) - 1)
        end = min(end, rows)
        lo, hi = int(offsets[row]), int(offsets[end])
        if hi - lo <= slice_bytes:
            buf, s, m, text, n_words, _ = _ngrams(raw[lo:hi], offsets[row:end + 1] - lo, max_n)
            yield row, end - row, NgramTable(buf, s, m, buckets), text, n_words
        else:
            carried, at = 0, lo
            while at < hi:
                cut = min(at + slice_bytes, hi)
                while cut < hi:  # back to the last gap between words, else on to the next one
                    gaps = np.flatnonzero(~_WORD[_LOWER[raw[at:cut]]])
                    if len(gaps) and gaps[-1] > 0 and at + gaps[-1] + 1 < hi:
                        part = raw[at:at + int(gaps[-1]) + 1]
                        new = np.count_nonzero(_WORD[_LOWER[part]][:-1] & ~_WORD[_LOWER[part]][1:])
                        if new > carried:
                            cut = at + int(gaps[-1]) + 1
                            break
                    cut = min(cut + slice_bytes, hi)
                buf, s, m, text, n_words, ws = _ngrams(raw[at:cut], np.array([0, cut - at]), max_n, carried)
                yield row, 1, NgramTable(buf, s, m, buckets), text, n_words - carried
                if cut >= hi:
                    break
                keep = min(max_n - 1, len(ws))
                carried, at = keep, (at + int(ws[-keep]) if keep else cut)
        row = end
