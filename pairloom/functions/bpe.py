"""Cutting one pre-token into symbols by merge rank."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pairloom.functions.runs import every_other

NONE = np.iinfo(np.int32).max  # the rank of a pair without a merge
REMEMBERED = 1 << 16  # pieces whose ids a task keeps
LONGEST_REMEMBERED = 64  # bytes of such a piece


class MergeRanks:
    """Ranks of merges over small integer symbols; symbols 0..255 are the bytes.

    Symbols are told apart by their bytes, and a repeated pair has its last
    rank.
    """

    def __init__(self, merges: Iterable[tuple[bytes, bytes]]) -> None:
        self.symbols: list[bytes] = [bytes([b]) for b in range(256)]
        number = {b: i for i, b in enumerate(self.symbols)}

        def intern(symbol: bytes) -> int:
            if symbol not in number:
                number[symbol] = len(self.symbols)
                self.symbols.append(symbol)
            return number[symbol]

        self.ranks: dict[tuple[int, int], tuple[int, int]] = {
            (intern(l), intern(r)): (rank, intern(l + r)) for rank, (l, r) in enumerate(merges)
        }

    def cut(self, word: bytes) -> list[int]:
        """Symbols left when no pair has a rank any more.

        Each turn takes the lowest rank present and merges all its places from
        left to right.  Places wait in a heap and neighbours are linked, so a
        very long word costs n log n.
        """
        syms = list(word)
        n = len(syms)
        left = list(range(-1, n - 1))
        right = list(range(1, n + 1))
        heap: list[tuple[int, int]] = []
        ranks = self.ranks

        def offer(i: int) -> None:
            if i >= 0 and right[i] < n:
                found = ranks.get((syms[i], syms[right[i]]))
                if found is not None:
                    heappush(heap, (found[0], i))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank = heap[0][0]
            merged = []
            while heap and heap[0][0] == rank:
                i = heappop(heap)[1]
                if syms[i] < 0 or right[i] >= n:
                    continue
                j = right[i]
                found = ranks.get((syms[i], syms[j]))
                if found is None or found[0] != rank:
                    continue
                syms[i], syms[j] = found[1], -1
                right[i] = right[j]
                if right[j] < n:
                    left[right[j]] = i
                merged.append(i)
            for i in merged:
                if syms[i] >= 0:
                    offer(left[i])
                    offer(i)
        return [s for s in syms if s >= 0]


class MergeTable:
    """The same cuts for many words at once, on flat arrays.

    In a turn every word merges all places of the lowest rank that it holds, from left to right; words that hold none
    are done.  Words longer than ``LONGEST`` bytes may take as many turns as they have bytes and go one at a time.
    """

    LONGEST = 256
    DENSE = 1024  # with so many symbols at most, ranks are looked up in a square

    def __init__(self, merges: MergeRanks) -> None:
        self._single, self.n = merges, len(merges.symbols)
        pairs = sorted((left * self.n + right, rank, made) for (left, right), (rank, made) in merges.ranks.items())
        self._keys = np.array([p[0] for p in pairs], np.int64)
        self._ranks = np.array([p[1] for p in pairs], np.int32)
        self._made = np.zeros(max((p[1] for p in pairs), default=0) + 1, np.int32)  # by rank
        self._made[self._ranks] = [p[2] for p in pairs]
        self._square = None
        if self.n <= self.DENSE:
            self._square = np.full(self.n * self.n, NONE, np.int32)
            self._square[self._keys] = self._ranks

    def _ranks_of(self, symbols: np.ndarray) -> np.ndarray:
        """The rank of the pair that begins at each place; ``NONE`` where there is no merge."""
        found = np.full(len(symbols), NONE, np.int32)
        if len(symbols) < 2 or not len(self._keys):
            return found
        at = np.flatnonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0))
        keys = symbols[at].astype(np.int64) * self.n + symbols[at + 1]
        if self._square is not None:
            found[at] = self._square[keys]
        else:
            place = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
            found[at] = np.where(self._keys[place] == keys, self._ranks[place], NONE)
        return found

    def cut(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words one after another, and how many each word has."""
        words = words.cast(pa.large_string())
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        data = words.buffers()[2]
        every = np.frombuffer(b"" if data is None else data, np.uint8)[bounds[0] : bounds[-1]]
        number = np.arange(len(words))
        ended = np.full(len(every) + len(words), -1, np.int32)  # every word ends in -1
        ended[np.arange(len(every)) + np.repeat(number, sizes)] = every
        long = sizes > self.LONGEST
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # numbers, sizes, symbols
        for k in number[long]:
            found = np.array(self._single.cut(every[bounds[k] - bounds[0] : bounds[k + 1] - bounds[0]].tobytes()), np.int32)
            done.append((number[k : k + 1], np.array([len(found)]), found))
        number, symbols = number[~long], ended[np.repeat(~long, sizes + 1)]
        while len(number):
            ranks = self._ranks_of(symbols)
            ends = np.flatnonzero(symbols < 0)
            sizes = np.diff(ends, prepend=-1)
            least = np.minimum.reduceat(ranks, ends - sizes + 1)
            rest = least < NONE
            kept = np.repeat(rest, sizes)
            done.append((number[~rest], sizes[~rest] - 1, symbols[~kept & (symbols >= 0)]))
            number, symbols, ranks = number[rest], symbols[kept], ranks[kept]
            places = every_other(np.flatnonzero((ranks < NONE) & (ranks == np.repeat(least[rest], sizes[rest]))))
            symbols[places] = self._made[ranks[places]]
            symbols = np.delete(symbols, places + 1)
        if not done:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        number, sizes, symbols = (np.concatenate(x) for x in zip(*done))
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(number)
        return symbols[spread(starts[order], sizes[order])], sizes[order]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs one after another: of each run from its start as many as its size."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class PieceEncoder:
    """Ids of pre-tokens and special tokens.

    The first ``REMEMBERED`` short pieces that it meets are kept with their ids.
    """

    def __init__(
        self,
        merges: Iterable[tuple[bytes, bytes]],
        token_ids: Mapping[bytes, int],
        special_tokens: Iterable[str] = (),
    ) -> None:
        ranks = MergeRanks(merges)
        self._table = MergeTable(ranks)
        self._ids = np.array([token_ids.get(s, -1) for s in ranks.symbols], np.int32)
        special = {t: token_ids[t.encode()] for t in special_tokens}
        self._special = pa.array(list(special), pa.string())
        self._special_ids = np.array(list(special.values()), np.int32)
        self._known = pa.array([], pa.string())
        self._known_ids, self._known_sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all distinct pieces one after another, and how many each piece has."""
        pieces = pieces.cast(pa.string())
        found = pc.fill_null(pc.index_in(pieces, self._known), -1).to_numpy(zero_copy_only=False)
        fresh = found < 0
        if fresh.all():
            ids, sizes = self._encode(pieces)
            self._remember(pieces, ids, sizes)
            return ids, sizes
        new = pieces.filter(pa.array(fresh))
        new_ids, new_sizes = self._encode(new)
        pool, every = np.concatenate([self._known_ids, new_ids]), np.concatenate([self._known_sizes, new_sizes])
        which = np.where(fresh, len(self._known) + np.cumsum(fresh) - 1, found)
        sizes = every[which]
        ids = pool[spread((np.cumsum(every) - every)[which], sizes)]
        self._remember(new, new_ids, new_sizes)
        return ids, sizes

    def _remember(self, pieces: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        room = REMEMBERED - len(self._known)
        if room <= 0:
            return
        short = pc.less_equal(pc.binary_length(pieces), LONGEST_REMEMBERED).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(short)[:room]
        self._known = pa.concat_arrays([self._known, pieces.take(pa.array(at))])
        self._known_ids = np.concatenate([self._known_ids, ids[spread((np.cumsum(sizes) - sizes)[at], sizes[at])]])
        self._known_sizes = np.concatenate([self._known_sizes, sizes[at]])

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        which = pc.fill_null(pc.index_in(pieces, self._special), -1).to_numpy(zero_copy_only=False)
        special = np.flatnonzero(which >= 0)
        plain = pc.if_else(pa.array(which >= 0), pa.scalar(""), pieces) if len(special) else pieces
        symbols, sizes = self._table.cut(plain)
        ids = self._ids[symbols]
        if len(ids) and ids.min() < 0:
            piece = pieces[int(np.searchsorted(np.cumsum(sizes), int(np.argmin(ids)), "right"))].as_py()
            raise KeyError(f"the vocabulary lacks a token needed for {piece!r}")
        if not len(special):
            return ids, sizes
        ids = np.insert(ids, (np.cumsum(sizes) - sizes)[special], self._special_ids[which[special]])
        sizes[special] = 1
        return ids, sizes

    def ids(self, piece: str) -> list[int]:
        return self.encode(pa.array([piece], pa.string()))[0].tolist()
