"""Regular expressions and column expressions for cutting text into pieces."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
PRETOKEN_PATTERN = (
    r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
END_OF_TEXT = "<|endoftext|>"
# ----------------------------------------------------------------------------

# Java's \s is ASCII-only unless the pattern asks for Unicode classes.
UNICODE_CLASSES = "(?U)"
# Unicode white space, which Java finds faster in a class of its own
WHITE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
# the same pieces; runs that nothing can follow are not given back
FAST_PATTERN = rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}++| ?\p{{N}}++| ?[^{WHITE}\p{{L}}\p{{N}}]++|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"

LINE_PATTERN = r"[^\n]*\n|[^\n]+"


def special_pattern(special_tokens: Sequence[str]) -> str:
    """Alternation of the escaped special tokens, longest first."""
    ordered = sorted(set(special_tokens), key=lambda t: (-len(t), t))
    if not ordered or "" in ordered:
        raise ValueError("special tokens must be non-empty strings")
    return "|".join(re.sub(r"([^\w])", r"\\\1", t, flags=re.ASCII) if t.isascii()
                    else re.sub(r"([!-/:-@\[-`{-~])", r"\\\1", t) for t in ordered)


def segments(text: Column, special_tokens: Sequence[str]) -> Column:
    """Ordered ``array<struct<segment, is_special>>`` without empty segments."""
    if not special_tokens:
        whole = F.array(F.struct(text.alias("segment"), F.lit(False).alias("is_special")))
        return F.filter(whole, lambda s: F.length(s["segment"]) > 0)
    alternation = special_pattern(special_tokens)
    between = F.split(text, alternation)
    tokens = F.regexp_extract_all(text, F.lit(alternation), F.lit(0))
    woven = F.transform(
        F.arrays_zip(between.alias("between"), tokens.alias("token")),
        lambda z: F.array(
            F.struct(z["between"].alias("segment"), F.lit(False).alias("is_special")),
            F.struct(z["token"].alias("segment"), F.lit(True).alias("is_special")),
        ),
    )
    return F.filter(F.flatten(woven), lambda s: F.length(s["segment"]) > 0)


def pretokens(text: Column, pattern: str = PRETOKEN_PATTERN) -> Column:
    """Ordered pre-tokens of a text that holds no special token."""
    asked = FAST_PATTERN if pattern == PRETOKEN_PATTERN else UNICODE_CLASSES + pattern
    return F.regexp_extract_all(text, F.lit(asked), F.lit(0))


def pieces(
    text: Column,
    special_tokens: Sequence[str] = (),
    pattern: str = PRETOKEN_PATTERN,
    keep_special: bool = True,
) -> Column:
    """Ordered pre-tokens and special tokens of a text.

    A pre-token never equals a special token, because the text between two
    special tokens holds none, so the piece alone tells which of both it is.
    Texts without any special token skip the split.
    """
    plain = pretokens(text, pattern)
    if not special_tokens:
        return plain
    cut = F.flatten(
        F.transform(
            segments(text, special_tokens),
            lambda s: F.when(
                s["is_special"], F.array(s["segment"]) if keep_special else F.array().cast("array<string>")
            ).otherwise(pretokens(s["segment"], pattern)),
        )
    )
    return F.when(_holds_any(text, special_tokens), cut).otherwise(plain)


def _holds_any(text: Column, special_tokens: Sequence[str]) -> Column:
    found = F.lit(False)
    for token in special_tokens:
        found = found | F.contains(text, F.lit(token))
    return found


def parts(text: Column, special_tokens: Sequence[str] = ()) -> Column:
    """Special tokens of a text and what is between them, in order, as valid UTF-8; no pre-token reaches over two."""
    text = F.make_valid_utf8(text)
    whole = F.array_compact(F.array(text))
    if not special_tokens:
        return whole
    cut = F.transform(segments(text, special_tokens), lambda s: s["segment"])
    return F.when(_holds_any(text, special_tokens), cut).otherwise(whole)


def line_parts(text: Column, special_tokens: Sequence[str] = ()) -> Column:
    """The same when every line is cut on its own."""
    return F.flatten(F.transform(lines(text), lambda t: parts(t, special_tokens)))


def lines(text: Column) -> Column:
    """Lines of a text, each with its own line feed."""
    return F.regexp_extract_all(text, F.lit(LINE_PATTERN), F.lit(0))


def line_pieces(
    text: Column,
    special_tokens: Sequence[str] = (),
    pattern: str = PRETOKEN_PATTERN,
) -> Column:
    """Pieces of a text when every line is cut on its own."""
    return F.flatten(F.transform(lines(text), lambda t: pieces(t, special_tokens, pattern)))
