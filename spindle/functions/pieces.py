"""Arrow batches of texts in pieces, so that what Python holds at a time is bounded by bytes, not by rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of texts that are Python strings at a time, about; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def pieces(*texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and length of runs of rows whose texts have so many bytes together, one row at least."""
    size = sum(np.asarray(pc.fill_null(pc.binary_length(x), 0), np.int64) for x in texts)
    ends = np.cumsum(size)
    start = 0
    while start < len(ends):
        end = max(int(np.searchsorted(ends, ends[start] - size[start] + PIECE_BYTES, "right")), start + 1)
        yield start, end - start
        start = end


def by_pieces(kind: pa.DataType, f, *texts: pa.Array) -> pa.Array:
    """``f`` of each row's texts, null ones as empty, as a column of a kind."""
    out = [pa.array([f(*(x or "" for x in row)) for row in zip(*(x.slice(a, n).to_pylist() for x in texts))], kind) for a, n in pieces(*texts)]
    return pa.concat_arrays(out) if out else pa.array([], kind)
