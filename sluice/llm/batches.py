"""Running a text kernel over Arrow batches in bounded slices."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from sluice.session import ship

#: Rows handed to a kernel at once.
SLICE_ROWS = 512

Kernel = Callable[[pa.RecordBatch], dict]


def schema_of(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def give_back() -> None:
    """Return what a task has freed to the system: workers live on, and allocators keep it for themselves."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def map_slices(df: DataFrame, make: Callable[[], Kernel], ddl: str, rows: int = SLICE_ROWS) -> DataFrame:
    """Apply a kernel to every slice of every partition.

    ``make`` runs once in each task and returns the kernel, which turns a slice
    into columns by name. State that outlives a slice belongs to the kernel and
    must be bounded; a kernel may have a function ``release`` for what would
    outlive the task in a worker that is used again. Rows without any output
    are fine.
    """
    ship(df.sparkSession)
    schema = schema_of(ddl)
    names = schema.fieldNames()

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make()
        arrow = to_arrow_schema(schema)
        for batch in source:
            for start in range(0, batch.num_rows, rows):
                out = kernel(batch.slice(start, rows))
                arrays = [
                    out[n] if isinstance(out[n], (pa.Array, pa.ChunkedArray)) else pa.array(out[n], arrow.field(n).type)
                    for n in names
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        getattr(kernel, "release", lambda: None)()
        kernel = batch = out = arrays = None
        give_back()

    return df.mapInArrow(run, ddl)


#: Ids one list after the other, and where each list begins; one more place for the end.
Lists = tuple[np.ndarray, np.ndarray]


def lists_of(packed: list[bytes]) -> Lists:
    """Packed ids (little-endian unsigned 32-bit) as lists."""
    ends = np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed))) // 4
    return np.frombuffer(b"".join(packed), "<u4"), np.concatenate([[0], ends])


def joined_ids(split: pa.Array, ids_of: Callable[[pa.Array], Lists]) -> Lists:
    """The ids of texts that are given as lists of parts. Parts repeat: they are told apart in Arrow, and ``ids_of`` gets the distinct ones."""
    coded = split.values.dictionary_encode()
    every, firsts = ids_of(coded.dictionary)
    code = coded.indices.to_numpy()
    size = np.diff(firsts)[code]
    ends = np.cumsum(size)
    ids = every[np.repeat(firsts[:-1][code] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
    return ids, np.concatenate([[0], ends])[split.offsets.to_numpy()]


def packed_lists(lists: Lists) -> list[bytes]:
    ids, firsts = lists
    cuts = firsts.tolist()
    return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice; null is the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]
