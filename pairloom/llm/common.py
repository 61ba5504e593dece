"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows of an Arrow batch that one step works on; keeps Python's copies of long texts small.
STEP = 512

Work = Callable[[pa.RecordBatch], dict]


def kind_of(frame: DataFrame, column: str) -> str:
    return frame.schema[column].dataType.simpleString()


def map_batches(frame: DataFrame, make: Callable[[], Work], schema: str, step: int = STEP) -> DataFrame:
    """A narrow map: ``make`` runs once a task, its result once a batch of at most ``step`` rows."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                columns = work(batch.slice(at, step))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in arrow],
                    schema=arrow,
                )

    return frame.mapInArrow(run, schema)


def unit_hash(seed: int, *keys: Column | str) -> Column:
    """A 60-bit integer from seed and keys that SQL engines with MD5 give as well."""
    parts = [F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string") if isinstance(k, str) else k.cast("string"), F.lit("")) for k in keys)]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("bigint")


def free_name(frame: DataFrame, stem: str) -> str:
    """``stem``, longer if need be, so that no column of ``frame`` begins with it."""
    while any(c.lower().startswith(stem.lower()) for c in frame.columns):
        stem += "_"
    return stem
