"""Packed symbol sequences: one character per symbol.

A word is kept as a string in which every character stands for one symbol.
The 256 single bytes are the characters U+0000..U+00FF; each further symbol
gets the next free character.  A merge is then an ordinary ``replace``, which
works left to right without overlaps, and a pair is a two-character string.
Symbols are identified by their bytes, so equal bytes share one character.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SURROGATES_FROM, _SURROGATES_TO = 0xD800, 0xDFFF
_LAST_CHAR = 0x10FFFF

UNUSED = chr(_LAST_CHAR)  # a character that never stands for a symbol


def pack_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text as one character per byte."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def string_array(values: Sequence[str]) -> Column:
    """Array literal of packed strings, folded once when the query is planned."""
    return F.split(F.lit(UNUSED.join(values)), UNUSED)


def bracketed(text: Column) -> Column:
    """Readable byte symbols, e.g. ``<20><74>``."""
    return F.regexp_replace(F.hex(F.encode(text, "UTF-8")), "(..)", "<$1>")


def neighbours(seq: Column, width: int = 2) -> Column:
    """All runs of ``width`` adjacent symbols, overlapping ones included.

    A look-ahead takes the run while one character is consumed, so the time is
    linear in the word's length.
    """
    return F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{{width}}}))."), F.lit(1))


def _any_of(pairs: Iterable[str]) -> Column:
    """Pattern that finds any of the pairs.

    Regular expression functions that take the pattern as a column keep it out of
    the generated code (``rlike`` writes it in), so that rounds with other
    pairs reuse the compiled classes.
    """
    seconds: dict[str, str] = {}
    for left, right in pairs:
        seconds[left] = seconds.get(left, "") + rf"\x{{{ord(right):x}}}"
    return F.lit("|".join(rf"\x{{{ord(left):x}}}[{rights}]" for left, rights in seconds.items()))


def holds_any(seq: Column, pairs: Iterable[str]) -> Column:
    """Whether the word holds one of the pairs, found in one pass over it."""
    return F.regexp_instr(seq, _any_of(pairs)) > 0


def first_of(seq: Column, pairs: Iterable[str]) -> Column:
    """The pair of the list that comes first in the word, or null."""
    return F.regexp_substr(seq, _any_of(pairs))


class Alphabet:
    """Character <-> bytes table of packed sequences; at most one entry per symbol."""

    def __init__(self, symbols: Iterable[bytes] = ()) -> None:
        self._bytes = [bytes([b]) for b in range(256)]
        self._chars = {b: chr(i) for i, b in enumerate(self._bytes)}
        for symbol in symbols:
            self.add(symbol)

    def __len__(self) -> int:
        return len(self._bytes)

    def __contains__(self, symbol: bytes) -> bool:
        return symbol in self._chars

    def add(self, symbol: bytes) -> str:
        """Character of a symbol, assigned on first use."""
        known = self._chars.get(symbol)
        if known is not None:
            return known
        point = len(self._bytes)
        if point >= _SURROGATES_FROM:
            point += _SURROGATES_TO - _SURROGATES_FROM + 1
        if point >= _LAST_CHAR:
            raise ValueError("more symbols than Unicode has characters")
        self._bytes.append(symbol)
        self._chars[symbol] = chr(point)
        return chr(point)

    def char(self, symbol: bytes) -> str:
        return self._chars[symbol]

    def bytes_of(self, char: str) -> bytes:
        point = ord(char)
        if point > _SURROGATES_TO:
            point -= _SURROGATES_TO - _SURROGATES_FROM + 1
        return self._bytes[point]

    def learned(self) -> list[bytes]:
        """Symbols beyond the single bytes, in order of their characters."""
        return self._bytes[256:]

    def hex_of(self, char: Column) -> Column:
        """Upper-case hex of a one-character column; hex order is byte order.

        The table is a folded literal with one entry per symbol.
        """
        table = F.split(F.lit(" ".join(b.hex().upper() for b in self._bytes)), " ")
        point = F.ascii(char)
        index = F.when(point > _SURROGATES_TO, point - (_SURROGATES_TO - _SURROGATES_FROM + 1)).otherwise(point)
        return F.get(table, index)

    def hex_sequence(self, seq: Column) -> Column:
        """A packed sequence in the bracketed form."""
        return F.array_join(
            F.transform(F.split(seq, ""), lambda c: F.concat(F.lit("<"), self.hex_of(c), F.lit(">"))), ""
        )
