"""Rows carried through a computation on their texts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.text import raw_texts, slices


def rows_of(docs: DataFrame) -> Column:
    """All columns as one struct, so that results never clash with a column's name."""
    return F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(work: Work) -> Work:
    """The same work for ``mapInArrow``; its worker, which goes on to other tasks, gives unused memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
            if trim:
                trim(0)

    return run


def annotated(
    docs: DataFrame, fields: str, compute: Callable[[Sequence[bytes]], list[pa.Array]], most: int | None = None,
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """Each row of docs as ``row``, next to the fields that ``compute`` makes of its ``text``.

    ``compute`` gets the UTF-8 texts of a slice of a batch (a null is empty), ``most`` of them
    at a time, and returns one array per field. ``done`` is called at the end of a task.
    """
    names = StructType.fromDDL(fields).fieldNames()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            texts = raw_texts(pc.struct_field(rows, "text"))
            for low, high in slices(texts, most=most):
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(low, high - low), *compute(texts[low:high])], names=["row", *names]
                )
        if done:
            done()

    frame = docs.select(rows_of(docs))
    return frame.mapInArrow(tidy(work), StructType([frame.schema["row"], *StructType.fromDDL(fields).fields]))
