"""Arrow batches of texts for ``mapInArrow`` steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def text_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts have about ``max_bytes`` together (one row at least)."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        run = np.cumsum(sizes) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; a null is an empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def with_columns(batch: pa.RecordBatch, keep: list[str], **new) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column(k) for k in keep] + [v if isinstance(v, pa.Array) else pa.array(v) for v in new.values()],
        names=[*keep, *new])
