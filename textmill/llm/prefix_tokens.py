"""Exact BPE token counts of every prefix by dynamic programming.

Within one pre-split piece, the encoding of a prefix that ends at byte i is the
encoding of a shorter prefix plus one last token t, and t is the last token if
and only if the pair (last token of the shorter prefix, t) survives encoding by
itself.  So ``count[i] = count[i - len(t)] + 1``: one left-to-right pass gives
the exact token count of all prefixes, and questions such as "how many tokens
has the first n characters" or "how much text fits a budget" need no further
encoding.

A text is cut into chunks before each space that precedes a non-space (the
pre-split never crosses that place), and chunk results are remembered, so the
work follows the distinct chunks, not the bytes.
"""

from __future__ import annotations

import json
import re

import numpy as np

_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?:\s|\Z)")
_ODD_PAIRS = [" " + chr(c) for c in (32, 9, 10, 11, 12, 13, 28, 29, 30, 31)]
# The published pre-split pattern of byte-level BPE vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def chunks(text: str) -> list[str]:
    """Parts of a text; all but the first lost one leading space."""
    if text.isascii():  # a few substring searches are quicker than the pattern
        odd = text.endswith(" ") or any(pair in text for pair in _ODD_PAIRS)
    else:
        odd = _ODD.search(text) is not None
    return _CUT.split(text) if odd else text.split(" ")


class PrefixCounter:
    """Prefix token counts for one byte-level BPE vocabulary file (.json)."""

    def __init__(self, path: str, limit: int = 600_000):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()

        def raw(token: str) -> bytes:
            return bytes(alphabet[c] for c in token)

        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        single = {bytes([b]): b for b in range(256)}
        # internal ids follow merge order: bytes first, then the result of each merge
        self.id_of, self.split, self.joined = dict(single), [(b, b) for b in range(256)], {}
        for m in spec["model"]["merges"]:
            left, right = (raw(x) for x in (m.split(" ") if isinstance(m, str) else m))
            a, b = self.id_of[left], self.id_of[right]
            self.joined[a, b] = len(self.split)
            self.id_of[left + right] = len(self.split)
            self.split.append((a, b))
        # the longest token by its last bytes: a bound for the search
        self.reach: dict[bytes, int] = {}
        for t in self.id_of:
            for k in (1, 2, 3):
                if len(t) >= k:
                    self.reach[t[-k:]] = max(len(t), self.reach.get(t[-k:], 0))
        self.pattern = regex.compile(PATTERN)
        self.special_split = re.compile("|".join(re.escape(s) for s in self.special)) if self.special else None
        self.limit = limit
        self._pairs: dict[int, bool] = {}
        self._pieces: dict[str, int] = {}
        self.spaced: dict[str, int] = {}

    def _apart(self, left: int, right: int) -> bool:
        """Whether two tokens next to each other stay as they are: undo merges
        from the later one down and see that no earlier merge joins the seam."""
        joined, split, bound = self.joined, self.split, 1 << 60
        while True:
            both = joined.get((left, right))
            if both is not None and both < bound:
                return False
            if left > right or right < 256:
                if left < 256:
                    return True
                bound, left = left, split[left][1]
            else:
                bound, right = right + 1, split[right][0]

    def _fill(self, piece: bytes, last: list[int], count: list[int]) -> None:
        """Extend the states of a prefix of ``piece`` to all of it."""
        ids, reach, pairs = self.id_of, self.reach, self._pairs
        for i in range(len(last), len(piece) + 1):
            far = reach.get(piece[i - 3:i], 2) if i >= 3 else i
            for j in range(i - far if far < i else 0, i):
                t = ids.get(piece[j:i])
                if t is None:
                    continue
                before = last[j]
                if before >= 0:
                    key = before << 20 | t
                    ok = pairs.get(key)
                    if ok is None:
                        ok = pairs[key] = self._apart(before, t)
                    if not ok:
                        continue
                last.append(t)
                count.append(count[j] + 1)
                break

    def piece_prefixes(self, piece: bytes) -> list[int]:
        """Token count of every byte prefix of one pre-split piece."""
        last, count = [-1], [0]
        self._fill(piece, last, count)
        return count

    def _learn_pieces(self, pieces: set[str]) -> None:
        """Counts of new pieces; sorted, so that each starts from the states of
        the prefix it shares with the one before."""
        last, count, prev = [-1], [0], b""
        for raw, piece in sorted((p.encode("utf-8", "surrogatepass"), p) for p in pieces):
            k, n = 0, min(len(prev), len(raw))
            while k < n and prev[k] == raw[k]:
                k += 1
            del last[k + 1:], count[k + 1:]
            self._fill(raw, last, count)
            self._pieces[piece], prev = count[-1], raw

    def learn(self, texts: list[list[str]]) -> None:
        """Make sure that ``spaced`` knows all chunks but the first of each text."""
        if len(self.spaced) > self.limit:
            self.spaced.clear()
        if len(self._pieces) > self.limit // 2:
            self._pieces.clear()
        if len(self._pairs) > 2_000_000:
            self._pairs.clear()
        new = {c for cs in texts for c in cs[1:]}
        new.difference_update(self.spaced)
        split = {c: self._plain_parts(" " + c) for c in new}
        pieces = {p for parts in split.values() for part in parts for p in part}
        pieces.difference_update(self._pieces)
        self._learn_pieces(pieces)
        known = self._pieces
        for c, parts in split.items():
            self.spaced[c] = sum(known[p] for part in parts for p in part) + len(parts) - 1

    def _plain_parts(self, chunk: str) -> list[list[str]]:
        """Pieces of the stretches between special tokens (one token each)."""
        if self.special_split is not None and any(s in chunk for s in self.special):
            return [self.pattern.findall(x) for x in self.special_split.split(chunk)]
        return [self.pattern.findall(chunk)]

    def _count_plain(self, text: str) -> int:
        pieces = self.pattern.findall(text)
        self._learn_pieces({p for p in pieces if p not in self._pieces})
        return sum(map(self._pieces.__getitem__, pieces))

    def _count_chunk(self, chunk: str) -> int:
        parts = self._plain_parts(chunk)
        self._learn_pieces({p for part in parts for p in part if p not in self._pieces})
        return sum(self._pieces[p] for part in parts for p in part) + len(parts) - 1

    def count(self, text: str | None) -> int:
        """Tokens of a whole text: the last entry of its prefix table."""
        return self.count_and_fit([text], 0)[0][0]

    def _char_prefixes(self, piece: str) -> list[int]:
        """Counts after each character of one piece."""
        by_byte, at, out = self.piece_prefixes(piece.encode("utf-8", "surrogatepass")), 0, []
        for c in piece:
            at += len(c.encode("utf-8", "surrogatepass"))
            out.append(by_byte[at])
        return out

    def _plain_prefixes(self, text: str) -> list[int]:
        """Counts after each character of a text without special tokens."""
        out, base, space_at = [], 0, None
        for m in self.pattern.finditer(text):
            piece = m.group()
            if piece.isspace():
                # an ending run of spaces is one piece, however the full text divides it
                if space_at is None or space_at[1] != m.start():
                    space_at = [m.start(), m.end(), base]
                run = text[space_at[0]:m.end()]
                counts = self._char_prefixes(run)
                out += [space_at[2] + c for c in counts[m.start() - space_at[0]:]]
                space_at[1] = m.end()
            elif len(piece) == 3 and piece in ("'re", "'ve", "'ll"):
                # cut inside, the apostrophe and the letter are pieces of their own
                out += [base + 1, base + 2, base + self._count_plain(piece)]
            else:
                out += [base + c for c in self._char_prefixes(piece)]
            base += self._count_plain(piece)
        return out

    def chunk_prefixes(self, chunk: str) -> list[int]:
        """Counts after each character of a chunk (leading space included)."""
        if self.special_split is None or not any(s in chunk for s in self.special):
            return self._plain_prefixes(chunk)
        out, base, at = [], 0, 0
        for m in self.special_split.finditer(chunk):
            plain = chunk[at:m.start()]
            # inside the special string the prefix is ordinary text
            out += [base + c for c in self._plain_prefixes(plain)]
            out += [base + self._count_plain(chunk[at:i]) for i in range(m.start() + 1, m.end())]
            base += self._count_plain(plain) + 1
            out.append(base)
            at = m.end()
        return out + [base + c for c in self._plain_prefixes(chunk[at:])]

    def table(self, text: str | None) -> np.ndarray:
        """Exact token count after each character of the text."""
        out, base = [], 0
        for i, c in enumerate(chunks(text or "")):
            c = c if i == 0 else " " + c
            out += [base + x for x in self.chunk_prefixes(c)]
            base += self._count_chunk(c)
        return np.array(out, dtype=np.int32)

    def count_and_fit(self, texts: list[str | None], budget: int) -> list[tuple[int, int]]:
        """For each text: (its tokens, characters of its longest prefix within ``budget``)."""
        cut = [chunks(t or "") for t in texts]
        self.learn(cut)
        out = []
        for text, cs in zip(texts, cut, strict=True):
            if not text:
                out.append((0, 0))
                continue
            counts = [self._count_chunk(cs[0]), *map(self.spaced.__getitem__, cs[1:])]
            total = sum(counts)
            out.append((total, len(text) if total <= budget else self._fit(cs, counts, budget)))
        return out

    def _fit(self, cs: list[str], counts: list[int], budget: int) -> int:
        """Characters that fit, for a text over budget: whole chunks, then the
        table of the chunk in which the budget ends."""
        used = chars = i = 0
        while used + counts[i] <= budget:
            used += counts[i]
            chars += len(cs[i]) + (i > 0)
            i += 1
        inside = self.chunk_prefixes(cs[i] if i == 0 else " " + cs[i])
        return chars + max((k + 1 for k, c in enumerate(inside) if used + c <= budget), default=0)


_LOADED: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter a worker process and vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = PrefixCounter(path)
    return _LOADED[path]
