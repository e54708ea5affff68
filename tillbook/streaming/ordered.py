"""A reorder buffer for keyed folds over a stream (ST02, ST06, ST07, ST10, ST14).

A fold over a key's rows needs them in time order, but files bring them out of order. ``in_order``
holds rows in state until the watermark has passed them, and hands each key's rows that are due,
sorted, to the fold. As no row can arrive before the watermark any more, the fold sees every key's rows
once and in order, however the input was cut into files and micro-batches.

Keys are dealt by hash into ``GROUPS`` groups, and a group is one row of the state store: its rows that are not due, and
what the folds of its keys carry, both in Arrow. So a micro-batch sorts and packs once a group and not once a
key, and a key costs little more than its rows. One timer a group wakes it when its next row is due or when a
fold asked for it (a deadline of its own, such as full time); only keys with rows or a deadline that are due are
folded. A key whose fold gives up its state leaves its group, and a group without keys and rows the state store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

GROUPS = 1024

# fold(key, rows in order (arrays by column name), carried state or None, watermark in us)
#   -> (output rows, state to carry or None, next deadline in us or None)
Fold = Callable[[object, "Rows", tuple | None, int], tuple[list[tuple], tuple | None, int | None]]


class Rows:
    """A key's rows: a slice of its group's arrays, by column name."""

    def __init__(self, arrays: dict[str, np.ndarray], at: slice):
        self._arrays, self._at = arrays, at

    def __getitem__(self, column: str) -> np.ndarray:
        return self._arrays[column][self._at]

    def __len__(self) -> int:
        return self._at.stop - self._at.start


def _pack(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(t)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _slices(keys: np.ndarray) -> Iterator[tuple[object, slice]]:
    """Every key of a sorted array with the slice of its rows."""
    if len(keys):
        ends = [*(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        yield from zip(keys[[0, *ends[:-1]]].tolist(), map(slice, [0, *ends[:-1]], ends), strict=True)


def in_order(rows: DataFrame, key: str, order: Sequence[str], out: T.StructType, carry: T.StructType, fold: Fold) -> DataFrame:
    """Fold each key's rows in the order of ``ts_us``, then ``order``.

    ``rows`` is a stream with a watermark; it has ``key``, ``ts_us`` and the columns the fold reads. The state
    of a group is what the folds carry (``carry``) and the rows that are not due yet. Rows without a key are a group of their own.
    """
    names = [f.name for f in out.fields]
    sort = [key, "ts_us", *order]
    used = [c for c in rows.columns if c != "_et"]
    nothing = {f.name: pd.Series(dtype="object") for f in out.fields}
    kept = pa.schema([("key", to_arrow_type(rows.schema[key].dataType)), ("deadline", pa.int64()),
                      *[(f.name, to_arrow_type(f.dataType)) for f in carry.fields]])

    def run(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        upto = now * 1000
        held_bytes, kept_bytes = state.get if state.exists else (None, None)
        frames = [] if held_bytes is None else [_unpack(bytes(held_bytes)).to_pandas()]
        if not state.hasTimedOut:
            frames += [p[used].copy() for p in pdfs]  # a view would hold the whole Arrow batch, which has the state in it
        held = pd.concat(frames, ignore_index=True) if frames else pd.DataFrame({c: [] for c in used})
        carried = {}
        if kept_bytes is not None:
            t = _unpack(bytes(kept_bytes)).to_pydict()
            carried = {x: (deadline, tuple(c)) for x, deadline, *c in zip(*t.values(), strict=True)}
        due = held["ts_us"].to_numpy() <= upto
        ready = held[due].sort_values(sort, kind="mergesort")
        arrays = {c: ready[c].to_numpy() for c in used}
        keys = arrays[key] if k[0] >= 0 else np.zeros(len(ready), dtype="int64")
        todo = dict(_slices(keys)) if k[0] >= 0 else {None: x for _, x in _slices(keys)}
        for x, (deadline, _) in carried.items():
            if deadline is not None and deadline <= upto:
                todo.setdefault(x, slice(0, 0))
        got = []
        for x, at in todo.items():
            before = carried.pop(x, (None, None))[1]
            if before is not None and all(v is None for v in before):
                before = None
            more, after, deadline = fold(x, Rows(arrays, at), before, upto)
            got += more
            if after is not None:
                carried[x] = (None if deadline is None else int(deadline), after)
        rest = held[~due]
        if not carried and not len(rest):
            if state.exists:
                state.remove()
        else:
            columns = [list(carried), [d for d, _ in carried.values()], *zip(*[c for _, c in carried.values()])]
            table = pa.Table.from_arrays([pa.array(list(c), f.type, from_pandas=True) for c, f in zip(columns, kept)], schema=kept) if carried else None
            state.update((_pack(pa.Table.from_pandas(rest, preserve_index=False)) if len(rest) else None,
                          None if table is None else _pack(table)))
            wake = [int(rest["ts_us"].min())] if len(rest) else []
            wake += [d for d, _ in carried.values() if d is not None]
            if wake:
                state.setTimeoutTimestamp(max(-(-min(wake) // 1000), now + 1))
        yield pd.DataFrame(got, columns=names) if got else pd.DataFrame(nothing)

    state = T.StructType([T.StructField("held", T.BinaryType()), T.StructField("carried", T.BinaryType())])
    group = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(key), F.lit(GROUPS)).cast("int"))
    return rows.withColumn("_group", group).groupBy("_group").applyInPandasWithState(run, out, state, "append", GroupStateTimeout.EventTimeTimeout)
