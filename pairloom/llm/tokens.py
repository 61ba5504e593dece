"""Token counts of every prefix of a text by dynamic programming.

A byte-pair encoding has a local form: a sequence of tokens is the encoding of
its bytes exactly if every two neighbours, encoded together, come out as these
two tokens.  So the encoding of a prefix ends in the one vocabulary entry that
fits the last token of the encoding before it, and its size is that one's size
plus one.  One pass over a piece gives the counts of all its prefixes; the
counts of a text follow from those of its pieces.

The counts are kept as steps, one small integer a character: the sum of the
first n is the number of tokens of the first n characters.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import kind_of, map_batches

# Fixed values of the byte-level vocabulary: how it cuts texts, and its pieces of two or more characters after a mark.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")

#: Pieces remembered in a Python worker; beyond it the memory starts anew.
REMEMBERED = 1_000_000


def byte_letters() -> list[str]:
    """The letter for each byte: printable ones stand for themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class PrefixCounter(dict):
    """Maps a piece to its steps; computed once and remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.specials = [t["content"] for t in described["added_tokens"] if t["special"]]
        if described["normalizer"] is not None or not described["pre_tokenizer"].get("use_regex"):
            raise ValueError("a byte-level vocabulary without normalizer is needed")
        self.model = Tokenizer.from_file(path).model
        letters = byte_letters()
        self.letters = {b: letters[b] for b in range(256)}
        # an entry that does not encode to itself never ends an encoding
        self.vocab = {t for t in described["model"]["vocab"] if t not in self.specials and self._encoded(t) == [t]}
        # the longest entry that ends in these two letters: nothing longer is tried
        self.longest: dict[str, int] = {}
        for token in self.vocab:
            self.longest[token[-2:]] = max(self.longest.get(token[-2:], 1), len(token))
        self.fits: dict[str, dict[str, bool]] = {}
        self.known = 0
        self.pieces = regex.compile(PIECES)
        self.spaces = regex.compile(r"\s\s+")

    def _encoded(self, letters: str) -> list[str]:
        return [t.value for t in self.model.tokenize(letters)]

    def _fit(self, left: str, right: str) -> bool:
        if self.known >= REMEMBERED:
            self.fits.clear()
            self.known = 0
        self.known += 1
        found = self.fits.setdefault(left, {})[right] = self._encoded(left + right) == [left, right]
        return found

    def byte_counts(self, piece: str) -> list[int]:
        """Tokens of every byte prefix of a piece."""
        shown = piece.encode("utf-8").decode("latin-1").translate(self.letters)
        vocab, longest, fits = self.vocab, self.longest, self.fits
        counts, last, unknown = [0], [""], {}
        for end in range(1, len(shown) + 1):
            reach = longest.get(shown[end - 2 : end], 1) if end > 1 else 1
            for begin in range(end - reach if end > reach else 0, end):
                token = shown[begin:end]
                if token in vocab:
                    if begin:
                        left = last[begin]
                        fit = fits.get(left, unknown).get(token)
                        if not (self._fit(left, token) if fit is None else fit):
                            continue
                    counts.append(counts[begin] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends {piece[:50]!r} at byte {end}")
        return counts

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        counts = self.byte_counts(piece)
        if piece in LONG_CONTRACTIONS:  # before its last letter it is two pieces
            counts[2] = 2
        if not piece.isascii():
            counts = [0, *(counts[e] for e in accumulate(len(c.encode("utf-8")) for c in piece))]
        self[piece] = found = bytes([(b - a) & 255 for a, b in pairwise(counts)])
        return found

    def _tokens(self, piece: str) -> int:
        return int(np.frombuffer(self[piece], np.int8).sum())

    def _plain(self, text: str) -> np.ndarray:
        """Steps of a text without special tokens."""
        steps = np.frombuffer(b"".join(map(self.__getitem__, self.pieces.findall(text))), np.int8).copy()
        for run in self.spaces.finditer(text):
            if run.end() < len(text):
                # with its last character only, the white space before a word is one piece, not two
                white, at = run.group(), run.end() - 1
                more = self._tokens(white) - self._tokens(white[:-1]) - self._tokens(white[-1])
                if more:
                    steps[at] += more
                    steps[at + 1] -= more
        return steps

    def steps(self, text: str | None) -> np.ndarray:
        """One step a character: the change in the number of tokens."""
        if not text:
            return np.zeros(0, np.int8)
        found = [(text.find(s), s) for s in self.specials if s in text]
        parts = []
        while found:
            at, special = min(found, key=lambda x: (x[0], -len(x[1])))
            part = self._plain(text[:at] + special[:-1])
            before, whole = int(part[:at].sum(dtype=np.int64)), int(part.sum(dtype=np.int64))
            parts += [part, np.array([before + 1 - whole], np.int8)]
            text = text[at + len(special) :]
            found = [(text.find(s), s) for s in self.specials if s in text]
        parts.append(self._plain(text))
        return np.concatenate(parts)


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """One counter a Python worker and vocabulary."""
    return PrefixCounter(path)


def prefix_table(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    budgets: tuple[int, ...] = (),
    keep_steps: bool = True,
) -> DataFrame:
    """Exact token counts of all prefixes: ``(id, n_bytes, n_chars, n_tokens, fit_<budget>..., steps)``.

    ``n_tokens`` is the count of the whole text; ``fit_<b>`` the characters of
    the longest prefix of at most ``b`` tokens; ``steps`` (``keep_steps``)
    answers any later question by ``tokens_in_prefix`` and ``longest_prefix``.
    Null and empty texts have no tokens and no steps.  Special strings in a
    text are the special tokens.  A repeated row yields a repeated row; other
    columns of ``docs`` are not looked at.
    """
    names = [f"fit_{b}" for b in budgets]

    def make():
        count = counter(path)

        def work(batch: pa.RecordBatch) -> dict:
            texts = batch.column(1).to_pylist()
            out = {id_column: batch.column(0), "n_bytes": [], "n_chars": [], "n_tokens": [], "steps": [], **{n: [] for n in names}}
            for text in texts:
                steps = count.steps(text)
                out["n_bytes"].append(len(text.encode("utf-8")) if text else 0)
                out["n_chars"].append(len(steps))
                if budgets:
                    counts = np.cumsum(steps, dtype=np.int64)
                    for budget, name in zip(budgets, names, strict=True):
                        fit = np.flatnonzero(counts <= budget)
                        out[name].append(int(fit[-1]) + 1 if len(fit) else 0)
                    out["n_tokens"].append(int(counts[-1]) if len(counts) else 0)
                else:
                    out["n_tokens"].append(int(steps.sum(dtype=np.int64)))
                if keep_steps:
                    out["steps"].append(steps)
            return out

        return work

    schema = f"`{id_column}` {kind_of(docs, id_column)}, n_bytes long, n_chars long, n_tokens long"
    schema += "".join(f", {n} long" for n in names) + ", steps array<tinyint>" * keep_steps
    return map_batches(docs.select(id_column, text_column), make, schema)


def tokens_in_prefix(steps: Column | str, n_chars: Column | int) -> Column:
    """Tokens of the first ``n_chars`` characters, from stored steps."""
    n = F.lit(n_chars) if isinstance(n_chars, int) else n_chars
    return F.aggregate(F.slice(steps, F.lit(1), n.cast("int")), F.lit(0), lambda a, x: a + x.cast("int"))


def longest_prefix(steps: Column | str, budget: Column | int) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens, from stored steps."""
    most = F.lit(budget) if isinstance(budget, int) else budget
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("tokens"), F.lit(0).alias("fit"))

    def step(a: Column, x: Column) -> Column:
        at, tokens = a["at"] + 1, a["tokens"] + x.cast("int")
        return F.struct(at.alias("at"), tokens.alias("tokens"), F.when(tokens <= most, at).otherwise(a["fit"]).alias("fit"))

    return F.aggregate(steps, start, step, lambda a: a["fit"])
