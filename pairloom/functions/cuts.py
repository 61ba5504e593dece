"""Cutting many texts at once into the pieces of ``PRETOKEN_PATTERN``, on flat arrays of code points.

The pieces are those of Spark's regular expression: what is a letter, a number or white space is asked of it once a
session.  They lie in the texts' own bytes, so no piece is copied.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pairloom.functions.patterns import UNICODE_CLASSES
from pairloom.functions.runs import END, flat

POINTS = 0x110000
OTHER, LETTER, NUMBER, SPACE, BORDER = range(5)
BLANK, QUOTE = 0x20, 0x27

_kinds: dict[str, Broadcast] = {}


def kinds(spark: SparkSession) -> Broadcast:
    """The kind of every code point, and of ``END`` at last, as a broadcast."""
    key = spark.sparkContext.applicationId
    if key not in _kinds:
        ids = spark.range(POINTS).filter(~F.col("id").between(0xD800, 0xDFFF))
        point = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
        kind = F.lit(OTHER)
        for number, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
            kind = F.when(F.regexp_like(point, F.lit(UNICODE_CLASSES + pattern)), number).otherwise(kind)
        rows = ids.select("id", kind.alias("kind")).filter(F.col("kind") != OTHER).toArrow()  # of a million code points at most
        found = np.zeros(POINTS + 1, np.uint8)
        found[rows["id"].to_numpy()] = rows["kind"].to_numpy()
        found[END] = BORDER
        _kinds[key] = spark.sparkContext.broadcast(found)
    return _kinds[key]


def cut(texts: pa.Array, kinds: np.ndarray, whole: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """The pieces of all texts one after another, and how many each has; of texts marked ``whole`` each is one piece."""
    if not len(texts):
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    texts = texts.cast(pa.string())
    points, lengths = flat(texts)
    kind = kinds[points]
    before, after = np.append([np.uint8(BORDER)], kind[:-1]), np.append(kind[1:], [np.uint8(BORDER)])
    start = kind != before
    # of white space the last character stands apart where text follows, and a blank goes with that text
    start |= (kind == SPACE) & (after != SPACE) & (after != BORDER)
    start[1:] &= ~((points[:-1] == BLANK) & (kind[1:] != SPACE) & (kind[1:] != BORDER))
    quotes = np.flatnonzero((points == QUOTE) & start)
    first, second = points[quotes + 1], points[np.minimum(quotes + 2, len(points) - 1)]
    short = np.isin(first, [ord(c) for c in "sdmt"])
    long = np.isin(first, [ord(c) for c in "lvr"]) & (second == np.where(first == ord("l"), ord("l"), ord("e")))
    size = short + 2 * long
    quotes, size = quotes[size > 0], size[size > 0]
    start[quotes + 1] = False
    start[quotes + 1 + size] = True
    if whole.any():
        start &= ~np.repeat(whole, lengths + 1)
        start[(np.cumsum(lengths + 1) - lengths - 1)[whole & (lengths > 0)]] = True
    inside = points != END
    places = np.flatnonzero(start & inside)
    width = inside.astype(np.uint8) + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    upto = np.cumsum(width, dtype=np.int32)
    offsets = np.append(upto[places] - width[places], upto[-1:]).astype(np.int32)
    if not len(places):
        offsets = np.zeros(1, np.int32)
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    own = pa.py_buffer(b"") if data is None else data.slice(int(bounds[0]), int(bounds[-1] - bounds[0]))
    pieces = pa.StringArray.from_buffers(len(places), pa.py_buffer(offsets), own)
    return pieces, np.diff(np.searchsorted(places, np.flatnonzero(~inside)), prepend=0)
