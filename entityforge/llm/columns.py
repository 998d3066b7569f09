"""Python over Arrow batches, as columns of plain Python values (integers stay integers beside nulls)."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Columns = dict[str, list]
#: Rows, and bytes of Arrow data, that are Python values at one time; one longer row is so by itself.
SLICE, SLICE_BYTES = 2000, 4_000_000
#: A worker of so few bytes has nothing to give back.
LITTLE_BYTES = 110 << 20


def _held_bytes() -> int:
    """Memory of this process, by the system's page count; very much where that is not told."""
    try:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
    except (OSError, ValueError, IndexError):
        return 1 << 62


def release(keep_tokenizer: bool = False) -> None:
    """Gives memory of earlier tasks back: workers are reused, and an executor's share is fixed."""
    module = sys.modules.get("entityforge.llm.tokens")
    held = module is not None and not keep_tokenizer and module.tokenizer.cache_info().currsize > 0
    if held:
        module.tokenizer.cache_clear()
    elif _held_bytes() < LITTLE_BYTES:
        return
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def nested(df: DataFrame) -> DataFrame:
    """All columns as fields of one struct `row`, so that helper columns beside it clash with none of them."""
    return df.select(F.struct(*[F.col("`{}`".format(c.replace("`", "``"))) for c in df.columns]).alias("row"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with `value` computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _bytes_before(data: pa.Array | pa.RecordBatch) -> np.ndarray:
    """Bytes of texts and binaries in the rows before each row, and in all."""
    upto = np.zeros(len(data) + 1, dtype=np.int64)
    for column in data.columns if isinstance(data, pa.RecordBatch) else data.flatten() if pa.types.is_struct(data.type) else [data]:
        if any(test(column.type) for test in (pa.types.is_string, pa.types.is_binary, pa.types.is_large_string, pa.types.is_large_binary)):
            upto[1:] += np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    return upto


def slices(data: pa.Array | pa.RecordBatch) -> Iterator[pa.Array | pa.RecordBatch]:
    """Consecutive slices of a few rows and bytes."""
    upto, at = _bytes_before(data), 0
    while at < len(data):
        fits = int(np.searchsorted(upto, upto[at] + SLICE_BYTES, side="right")) - 1
        end = min(max(fits, at + 1), at + SLICE, len(data))
        yield data.slice(at, end - at)
        at = end


def text_udf(say_of: Callable[[], Callable[[list], list[tuple]]], ddl: str):
    """A column function from a text column to a struct of type `ddl`: `say_of()` makes, once per task, what
    turns some texts into tuples. Only the texts travel to Python; other columns stay in the JVM."""
    kind = StructType.fromDDL(ddl)
    target = pa.struct(list(to_arrow_schema(kind)))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        say = say_of()
        for batch in batches:
            found = [pa.array([dict(zip(kind.names, r)) for r in say(part.to_pylist())], type=target) for part in slices(batch)]
            yield pa.concat_arrays(found) if found else pa.array([], type=target)

    # said to be nondeterministic, so that no rule of the optimizer evaluates it twice
    return arrow_udf(run, kind).asNondeterministic()


def names(schema: str) -> list[str]:
    """Column names of a flat DDL schema; needs no session."""
    return [c.split()[0] for c in schema.split(",")]


def map_columns(
    df: DataFrame, run: Callable[[Iterator[Columns]], Iterator[Columns]], schema: str, arrays: bool = False, keep_tokenizer: bool = False
) -> DataFrame:
    """`run` over the rows of each partition, some at a time; it takes and yields name → list of values.

    With `arrays` it takes whole batches as NumPy arrays, for columns of numbers without nulls.
    """
    target = to_arrow_schema(StructType.fromDDL(schema))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        for batch in batches:
            if arrays:
                yield {n: c.to_numpy(zero_copy_only=False) for n, c in zip(batch.schema.names, batch.columns)}
                continue
            for part in slices(batch):
                yield {n: c.to_pylist() for n, c in zip(part.schema.names, part.columns)}

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(keep_tokenizer)
        for out in run(read(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in target], schema=target)

    return df.mapInArrow(wrapped, schema)


def as_columns(rows: list[tuple], keys: list[str]) -> Columns:
    """Rows turned to columns."""
    return dict(zip(keys, map(list, zip(*rows)))) if rows else {k: [] for k in keys}
