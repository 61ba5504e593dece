"""Packed words as flat arrays of code points, for tasks that count or merge neighbours of many words at once.

A word's characters follow each other and end in ``END``, so that no run reaches from one word into the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END = -1
BITS = 21  # of a code point, so three fit a long
SYMBOLS = 1 << 19  # worked on at once; bounds a task's memory

Batches = Iterator[pa.RecordBatch]
Merges = Sequence[tuple[str, str]]  # pairs and the symbols that they become, in order


def flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each word ended by ``END``, and the words' lengths."""
    words = words.cast(pa.string())
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    text = b"" if data is None else memoryview(data)[bounds[0] : bounds[-1]].tobytes()
    points = np.frombuffer(text.decode("utf-8").encode("utf-32-le"), np.int32)
    out = np.full(len(points) + len(words), END, np.int32)
    out[np.arange(len(points)) + np.repeat(np.arange(len(words)), lengths)] = points
    return out, lengths


def strings(points: np.ndarray, lengths: np.ndarray) -> pa.StringArray:
    """Words from their code points, without ``END``."""
    sizes = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    bounds = upto[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int32)
    data = points.astype(np.int32).tobytes().decode("utf-32-le").encode("utf-8")
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(bounds.tobytes()), pa.py_buffer(data))


def every_other(places: np.ndarray) -> np.ndarray:
    """Of sorted places the first, third, ... of each run of adjacent ones: what is merged from left to right without overlaps."""
    if len(places) < 2:
        return places
    begins = np.concatenate([[True], places[1:] != places[:-1] + 1])
    number = np.arange(len(places))
    first = np.maximum.accumulate(np.where(begins, number, 0))
    return places[(number - first) % 2 == 0]


def merged(points: np.ndarray, pair: str, result: str) -> np.ndarray:
    """Every place of the pair replaced, left to right and without overlaps."""
    left, right = map(ord, pair)
    places = np.flatnonzero((points[:-1] == left) & (points[1:] == right))
    if not len(places):
        return points
    if left == right:
        places = every_other(places)
    points = points.copy()
    points[places] = ord(result)
    return np.delete(points, places + 1)


def all_merged(points: np.ndarray, merges: Merges) -> np.ndarray:
    for pair, result in merges:
        points = merged(points, pair, result)
    return points


def runs(points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all runs of ``width`` (2 or 3) adjacent characters, and where they begin."""
    n = max(0, len(points) - width + 1)
    inside = np.ones(n, bool)
    keys = np.zeros(n, np.int64)
    for k in range(width):
        part = points[k : n + k]
        inside &= part != END
        keys = (keys << BITS) | part
    at = np.flatnonzero(inside)
    return keys[at], at


def added_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[begins], np.add.reduceat(counts[order], begins)


def named(keys: np.ndarray, width: int) -> pa.StringArray:
    """The runs of keys as strings."""
    shifts = np.arange(width - 1, -1, -1, dtype=np.int64) * BITS
    points = (keys[:, None] >> shifts) & ((1 << BITS) - 1)
    return strings(points.reshape(-1), np.full(len(keys), width, np.int64))


def _counts(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("cnt").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _weights(points: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The count of the word that each place belongs to."""
    return np.repeat(counts, np.diff(np.flatnonzero(points == END), prepend=-1))


def _gathered(batches: Batches, column: str) -> Iterator[pa.RecordBatch]:
    """The rows with a word, in batches of about ``SYMBOLS`` bytes."""
    held, size = [], 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, SYMBOLS * batch.num_rows // max(1, batch.column(column).nbytes))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            size += part.nbytes
            if size >= SYMBOLS:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def counter(width: int, since: Merges = (), near: Sequence[str] | None = None) -> Callable[[Batches], Batches]:
    """Maps ``(seq, cnt)`` to ``(run, cnt)``, sums of a part of the rows, of the words after the merges ``since``.

    All runs are counted, or those that begin or end in one of the pairs ``near``.
    """
    wanted = None if near is None else np.sort(np.array([(ord(p[0]) << BITS) | ord(p[1]) for p in near], np.int64))

    def begins_one(points: np.ndarray) -> np.ndarray:
        """Which places are the first of a wanted pair: few left sides come to be looked up."""
        found = np.zeros(len(points), bool)
        lefts = np.zeros(max(int(points.max(initial=0)), int(wanted[-1] >> BITS)) + 1, bool)
        lefts[wanted >> BITS] = True
        at = np.flatnonzero(lefts[np.maximum(points[:-1], 0)] & (points[:-1] != END) & (points[1:] != END))
        pairs = (points[at].astype(np.int64) << BITS) | points[at + 1]
        found[at] = wanted[np.minimum(np.searchsorted(wanted, pairs), len(wanted) - 1)] == pairs
        return found

    def run(batches: Batches) -> Batches:
        for batch in _gathered(batches, "seq"):
            points = all_merged(flat(batch.column("seq"))[0], since)
            keys, at = runs(points, width)
            if wanted is not None:
                begins = begins_one(points)
                keep = begins[at] | begins[at + width - 2]
                keys, at = keys[keep], at[keep]
            weights = _weights(points, _counts(batch))[at]
            keys, sums = added_up(keys, weights)
            yield pa.RecordBatch.from_arrays([named(keys, width), pa.array(sums)], ["run", "cnt"])

    return run


def merger(merges: Merges) -> Callable[[Batches], Batches]:
    """Maps ``(seq, cnt)`` to the words after the merges, in order."""

    def run(batches: Batches) -> Batches:
        for batch in _gathered(batches, "seq"):
            points = all_merged(flat(batch.column("seq"))[0], merges)
            lengths = np.diff(np.flatnonzero(points == END), prepend=-1) - 1
            words = strings(points[points != END], lengths)
            yield pa.RecordBatch.from_arrays([words, batch.column("cnt")], ["seq", "cnt"])

    return run


def changer(since: Merges, merges: Merges) -> Callable[[Batches], Batches]:
    """Maps ``(seq, cnt)`` to ``(pair, cnt)``: what the merges do to the pairs of words that are the given ones after ``since``.

    Pairs of the new words less those of the old, sums of a part of the rows.
    """

    def run(batches: Batches) -> Batches:
        for batch in _gathered(batches, "seq"):
            old = all_merged(flat(batch.column("seq"))[0], since)
            new, found = all_merged(old, merges), []
            if new is old:
                continue
            counts = _counts(batch)
            for points, sign in ((new, 1), (old, -1)):
                keys, at = runs(points, 2)
                found.append(added_up(keys, sign * _weights(points, counts)[at]))
            keys, sums = added_up(*(np.concatenate(x) for x in zip(*found)))
            keys, sums = keys[sums != 0], sums[sums != 0]
            yield pa.RecordBatch.from_arrays([named(keys, 2), pa.array(sums)], ["pair", "cnt"])

    return run
