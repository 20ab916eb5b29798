"""Byte-pair encoding: merge tables, adjacency checks, exact merging, and the codec.

``Merges.compatible`` decides for many token pairs at once whether two tokens can
stand next to each other in an encoding. Merging replays ranks in ascending
order, so a pair is impossible exactly if some merge across the boundary had its
turn while both of its parts existed. The check walks back in time: it undoes
whichever of the two tokens was made last and looks the new neighbours up. A word
whose tokens exist on their own and are pairwise compatible is encoded right;
any other word is merged exactly.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable
from functools import lru_cache

import ahocorasick
import numpy as np
import regex

NEVER = np.iinfo(np.int64).max
# Words whose codes a task remembers.
REMEMBERED = 300_000


@lru_cache(maxsize=1)
def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the rest are numbered from U+0100.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=1)
def _to_alphabet() -> dict[int, str]:
    return dict(enumerate(byte_alphabet()))


def spelled(word: str) -> str:
    """A word in the byte alphabet."""
    return word.encode("utf-8").decode("latin-1").translate(_to_alphabet())


class Merges:
    """A vocabulary and its ordered merges."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.size = max(vocab.values()) + 1
        self.strings = [""] * self.size
        for s, i in vocab.items():
            self.strings[i] = s
        self.left = np.full(self.size, -1)
        self.right = np.full(self.size, -1)
        #: The rank of the merge that makes a token; -1 for single symbols.
        self.birth = np.full(self.size, -1)
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for k, (a, b) in enumerate(merges):
            pair, made = (vocab[a], vocab[b]), vocab[a + b]
            if self.birth[made] >= 0:
                raise ValueError("a token is made by two merges")
            self.left[made], self.right[made], self.birth[made] = *pair, k
            self.rank[pair] = (k, made)
        keys = np.fromiter((a * self.size + b for a, b in self.rank), np.int64, len(self.rank))
        order = np.argsort(keys)
        self._keys = keys[order]
        self._ranks = np.arange(len(keys))[order]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of merging each pair, NEVER where there is none."""
        if not len(self._keys):
            return np.full(len(a), NEVER)
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge happens across each boundary a|b.

        With ``until``: none before that rank, and the pair itself is not looked up.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        ok = np.ones(len(a), bool)
        rows = np.arange(len(a))
        limit = np.full(len(a), NEVER) if until is None else until.astype(np.int64)
        look = until is None
        while len(rows):
            if look:
                fits = self.ranks(a, b) >= limit
                ok[rows[~fits]] = False
            else:
                fits = np.ones(len(rows), bool)
            look = True
            going = fits & ((self.birth[a] >= 0) | (self.birth[b] >= 0))
            rows, a, b, limit = rows[going], a[going], b[going], limit[going]
            born_a, born_b = self.birth[a], self.birth[b]
            # Of two equal merges the left one goes first, so on a tie b is younger.
            undo = born_a > born_b
            # a's last part is gone once a is made; b's first part could still be
            # taken at b's own rank, because the pair to the left goes first.
            limit = np.minimum(limit, np.where(undo, born_a, born_b + 1))
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return ok

    def whole(self) -> np.ndarray:
        """For each token, whether its own string encodes to just this token."""
        made = np.flatnonzero(self.birth >= 0)
        inside = np.ones(self.size, bool)
        inside[made] = self.compatible(self.left[made], self.right[made], self.birth[made])
        out = np.array([bool(s) for s in self.strings])
        for t in made[np.argsort(self.birth[made])]:  # parts are made before the whole
            out[t] = inside[t] and out[self.left[t]] and out[self.right[t]]
        return out

    def merge(self, word: str) -> list[int]:
        """Exact encoding of a word in the byte alphabet: lowest rank first, leftmost first."""
        symbols = list(word)
        if symbols:
            symbols[-1] += self.suffix
        ids = [self.vocab[s] for s in symbols if s in self.vocab]
        return self._merge_long(ids) if len(ids) > 64 else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, none = self.rank.get, (NEVER, -1)
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best[1] < 0:
                break
            i = ranks.index(best)
            ids[i:i + 2] = [best[1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap, for words of any length."""
        n, rank = len(ids), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p][0], i, rank[p][1], p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in rank]
        heapq.heapify(heap)
        while heap:
            _, i, made, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] != pair[0] or j >= n or ids[j] != pair[1]:
                continue  # one of the two has changed since
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n and (p := (ids[x], ids[after[x]])) in rank:
                    heapq.heappush(heap, (rank[p][0], x, rank[p][1], p))
        return [i for i in ids if i >= 0]


class Recent(dict):
    """What was met lately: holds up to twice ``room`` entries, the older half goes first."""

    def __init__(self, room: int = REMEMBERED):
        self.room, self.older = room, {}

    def age(self) -> None:
        if len(self) > self.room:
            self.older = dict(self)
            self.clear()

    def unmet(self, words: Iterable[str]) -> list[str]:
        """The words that are not known; those of the older half move to the newer."""
        new = []
        for w in {w for w in words if w not in self}:
            if w in self.older:
                self[w] = self.older[w]
            else:
                new.append(w)
        return new


def load(path: str) -> tuple[Merges, dict[str, int]]:
    """Merges and special tokens of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return (Merges(model["vocab"], pairs, model.get("end_of_word_suffix") or ""),
            {t["content"]: t["id"] for t in spec["added_tokens"]})


def splitter(specials: dict[str, int]):
    """Pattern whose split() puts the special strings of a text at odd places."""
    longest = sorted(specials, key=len, reverse=True)
    return regex.compile("(" + "|".join(regex.escape(s, special_only=False) for s in longest) + ")" if longest else r"(?!)()")


# How byte-level BPE splits a text before merging. White space is
# that of Unicode (the library's), which excludes U+001C to U+001F.
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


class Codec:
    """Speculating encoder and decoder of a byte-level BPE file."""

    def __init__(self, path: str):
        self.merges, self.specials = load(path)
        self.split, self.words = splitter(self.specials), regex.compile(WORDS)
        self.alone = self.merges.whole()
        self.length = np.array([len(s) for s in self.merges.strings])
        self.finder = ahocorasick.Automaton()
        for s, i in self.merges.vocab.items():
            self.finder.add_word(s, i)
        self.finder.make_automaton()
        self.known = Recent()
        self.merged = 0
        back = {c: b for b, c in enumerate(byte_alphabet())}
        top = max([self.merges.size - 1, *self.specials.values()]) + 1
        self.bytes = [b""] * top
        for i, s in enumerate(self.merges.strings):
            self.bytes[i] = bytes(back[c] for c in s)
        for s, i in self.specials.items():
            self.bytes[i] = s.encode("utf-8")

    def learn(self, words: list[str]) -> None:
        """Codes of new words: proposed, checked pair by pair, merged where a check fails."""
        if not words:
            return
        texts = [spelled(w) for w in words]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        found = list(self.finder.iter_long("\n".join(texts)))  # no word in the byte alphabet has a line end
        ends = np.fromiter((e for e, _ in found), np.int64, len(found))
        ids = np.fromiter((i for _, i in found), np.int64, len(found))
        of = np.searchsorted(starts, ends, "right") - 1
        covered = np.bincount(of, self.length[ids], len(words)) == sizes
        wrong = ~covered
        np.logical_or.at(wrong, of[~self.alone[ids]], True)
        near = np.flatnonzero(of[1:] == of[:-1])
        pairs, which = np.unique(ids[near] * self.merges.size + ids[near + 1], return_inverse=True)
        fits = self.merges.compatible(pairs // self.merges.size, pairs % self.merges.size)
        np.logical_or.at(wrong, of[near[~fits[which]]], True)
        flat = ids.astype("<u4").tobytes()
        bounds = np.searchsorted(of, np.arange(len(words) + 1)) * 4
        for k, w in enumerate(words):
            if wrong[k]:
                self.merged += 1
                self.known[w] = np.array(self.merges.merge(texts[k]), "<u4").tobytes()
            else:
                self.known[w] = flat[bounds[k]:bounds[k + 1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces = []
        for t in texts:
            parts = self.split.split(t) if self.specials else [t]
            pieces.append([self.words.findall(p) if k % 2 == 0 else p for k, p in enumerate(parts)])
        self.known.age()
        self.learn(self.known.unmet(w for doc in pieces for p in doc if isinstance(p, list) for w in p))
        code = self.known.__getitem__
        return [b"".join([b"".join(map(code, p)) if isinstance(p, list) else self.specials[p].to_bytes(4, "little")
                          for p in doc]) for doc in pieces]

    def decode(self, ids: bytes) -> str:
        """Text of ids; special tokens are written out."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
