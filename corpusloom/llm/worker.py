"""What Python workers share: state kept between tasks, and slices of bounded size."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# These functions travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def kept(name: str, make: Callable[[], Any]) -> Any:
    """``make()``, called once per worker process; loaded files and caches live here."""
    module = "corpusloom_worker_state"
    state = sys.modules.setdefault(module, types.ModuleType(module)).__dict__
    if name not in state:
        state[name] = make()
    return state[name]


#: Bytes of text that a worker takes up at once; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def sliced(batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices whose texts in ``column`` take ``limit`` bytes or less."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            room = limit + (ends[first - 1] if first else 0)
            last = max(first + 1, int(np.searchsorted(ends, room, side="right")))
            yield batch.slice(first, last - first)
            first = last


def gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces ``flat[start[i] : start[i] + length[i]]`` of every i of index in a row, and their lengths."""
    n = length[index]
    ends = np.cumsum(n)
    place = np.repeat(start[index] - (ends - n), n)
    place += np.arange(len(place))
    return flat[place], n
