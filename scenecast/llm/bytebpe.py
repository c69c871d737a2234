"""Byte-level BPE vocabulary: reading the file, pre-tokens, and the merge loop.

The merge loop keeps a word's parts and the ranks of adjacent pairs in two
contiguous arrays: it scans for the smallest rank, joins that pair, deletes
the boundary and refreshes the two neighbouring ranks, until no pair is in
the table.  Short words are merged side by side: the arrays of words of similar length are
the rows of one matrix, and each step does the same for all rows.  Words longer
than ``SHORT`` bytes take the same merges from a heap, so one endless word costs
n log n instead of n squared.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import regex

# The byte-level pre-token pattern of the vocabulary file and
# the printable stand-ins it writes for bytes.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

# Code points that the tokenizer library, built for an older Unicode
# version, takes for neither letters nor numbers, though ``regex`` does.
UNKNOWN = (
    r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd"
    r"\ua7e2\ua7f1\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7"
    r"\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9"
    r"\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    r"\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    r"\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2"
    r"\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81"
    r"\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2"
    r"\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    r"\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479"
    r"\U0003d000-\U0003fc3f")

NO_PAIR = 1 << 60
SHORT = 64
CACHE_WORDS = 400_000
GROUP = 2_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable Latin-1 for itself, others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def latin_pattern() -> str:
    """``PATTERN`` for texts of code points below 256, with its classes written out.

    The standard library's faster matcher knows no letter classes of its own.
    """
    def members(name: str) -> str:
        return "".join(map(re.escape, regex.findall(name, "".join(map(chr, range(256))))))

    letters, numbers, spaces = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return (PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
            .replace(r"\p{L}+", f"[{letters}]+").replace(r"\p{N}+", f"[{numbers}]+")
            .replace(r"\s+", f"[{spaces}]+").replace(r"(?!\S)", f"(?![^{spaces}])"))


class Vocabulary:
    """Tokens and merges of one byte-level BPE file.

    ``pairs`` maps ``left_id << 20 | right_id`` to ``rank << 20 | merged_id``,
    so one integer comparison orders merges and one mask gives the new part.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, model = byte_letters(), spec["model"]
        ids = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_bytes = {i: bytes(letters[c] for c in t) for t, i in ids.items()
                            if t not in self.added}
        self.token_bytes |= {i: t.encode() for t, i in self.added.items()}
        self.byte_id = np.zeros(256, dtype=np.int64)
        for t, i in ids.items():
            if len(t) == 1:
                self.byte_id[letters[t]] = i
        self.pairs: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs.setdefault(ids[a] << 20 | ids[b], rank << 20 | ids[a + b])
        self._keys = np.array(sorted(self.pairs), dtype=np.int64)
        self._merged = np.array([self.pairs[k] for k in self._keys.tolist()], dtype=np.int64)
        self._find = regex.compile(PATTERN).findall
        self._find_latin = re.compile(latin_pattern()).findall
        known = (PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{UNKNOWN}])")
                 .replace(r"\p{L}+", rf"[\p{{L}}--[{UNKNOWN}]]+")
                 .replace(r"\p{N}+", rf"[\p{{N}}--[{UNKNOWN}]]+"))
        self._find_known = regex.compile(known, regex.V1).findall
        self._unknown = regex.compile(f"[{UNKNOWN}]").search
        # longest first, so that of two that start together the longer one is taken
        names = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None

    def find(self, text: str) -> list[str]:
        """Pre-tokens of a text without special tokens."""
        if text.isascii():
            return self._find_latin(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._find_known(text) if self._unknown(text) else self._find(text)
        return self._find_latin(text)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and merged id of pairs of parts (``NO_PAIR`` where the table has none)."""
        keys = left << 20 | right
        at = np.searchsorted(self._keys, keys)
        at[at == len(self._keys)] = 0
        return np.where(self._keys[at] == keys, self._merged[at], NO_PAIR)

    def merge_short(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of words of 1 to ``SHORT`` bytes, merged side by side."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        width = int(sizes.max())
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8)
        ids = self.byte_id[raw.reshape(-1, width)]
        lane = np.arange(width - 1)
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        ranks[lane >= sizes[:, None] - 1] = NO_PAIR
        out: list = [None] * len(words)
        rows = np.arange(len(words))
        while len(rows):
            if ranks.shape[1]:
                best = ranks.argmin(axis=1)                 # the leftmost of equal ranks
                lowest = ranks[np.arange(len(rows)), best]
            done = np.ones(len(rows), bool) if not ranks.shape[1] else lowest == NO_PAIR
            if done.any():
                for r, line, n in zip(rows[done], ids[done], sizes[rows[done]]):
                    out[r] = line[:n]
                go = ~done
                rows, ids, ranks = rows[go], ids[go], ranks[go]
                if not len(rows):
                    break
                best, lowest = best[go], lowest[go]
            each = np.arange(len(rows))
            ids[each, best] = lowest & 0xFFFFF
            # delete the boundary: parts behind it move up by one
            behind = np.arange(ids.shape[1] - 1)[None, :] > best[:, None]
            ids = np.where(behind, ids[:, 1:], ids[:, :-1])
            ranks = np.where(behind[:, :-1] | (lane[None, :ranks.shape[1] - 1] == best[:, None]),
                             ranks[:, 1:], ranks[:, :-1])
            sizes[rows] -= 1
            # refresh the neighbouring ranks
            last = sizes[rows] - 1
            for at in (best - 1, best):
                ok = np.flatnonzero((at >= 0) & (at < last))
                if len(ok):
                    ranks[ok, at[ok]] = self.rank(ids[ok, at[ok]], ids[ok, at[ok] + 1])
        return out

    def merge_all(self, words: list[str]) -> list[np.ndarray]:
        """Token ids of distinct pre-tokens, in their order."""
        raw = [w.encode() for w in words]
        out: list = [None] * len(raw)
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(raw):
            if len(w) > SHORT:
                out[i] = np.array(self._merge_long(self.byte_id[list(w)].tolist()))
            else:
                groups.setdefault(-(-len(w) // 4), []).append(i)
        for rows in groups.values():
            for a in range(0, len(rows), 1 << 14):
                part = rows[a:a + (1 << 14)]
                for i, ids in zip(part, self.merge_short([raw[i] for i in part])):
                    out[i] = ids
        return out

    def _merge_long(self, ids: list[int]) -> list[int]:
        get, n = self.pairs.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1)
                if (r := get(ids[i] << 20 | ids[i + 1], NO_PAIR)) != NO_PAIR]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or get(ids[i] << 20 | ids[j], NO_PAIR) != best:
                continue  # the pair has changed since it was put here
            ids[i], ids[j] = best & 0xFFFFF, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (r := get(ids[i] << 20 | ids[after[i]], NO_PAIR)) != NO_PAIR:
                    heapq.heappush(heap, (r, i))
            if (p := before[i]) >= 0 and (r := get(ids[p] << 20 | ids[i], NO_PAIR)) != NO_PAIR:
                heapq.heappush(heap, (r, p))
        return [t for t in ids if t >= 0]

    def pieces(self, text: str):
        """Yield (pre-tokens, special id or None) runs of the text in order."""
        start = 0
        if self.special is not None:
            for m in self.special.finditer(text):
                yield self.find(text[start:m.start()]), self.added[m.group()]
                start = m.end()
        yield self.find(text[start:] if start else text), None


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """The vocabulary at ``path``, read once per process."""
    return Vocabulary(path)


def groups(texts: list[str | None]):
    """Runs of texts of about ``GROUP`` characters (one text at least); null is empty."""
    group, size = [], 0
    for t in texts:
        t = t or ""
        if group and size + len(t) > GROUP:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


class Memo(dict):
    """Values by pre-token.  ``learn`` adds those of many words at once; when it is full it
    forgets all but the fixed ones and starts again."""

    def __init__(self, make, fixed: dict | None = None, room: int = CACHE_WORDS):
        super().__init__(fixed or {})
        self.make, self.fixed, self.room = make, fixed or {}, room + len(fixed or {})

    def learn(self, words: list[str]) -> None:
        """Values of all the words that are not here yet."""
        new = [w for w in set(words) if w not in self]
        if len(self) + len(new) > self.room:
            self.clear()
            self.update(self.fixed)
            new = [w for w in set(words) if w not in self]
        self.update(zip(new, self.make(new)))
