"""User aggregates with a state of their own, in two phases.

:class:`StateAggregate` is the user's side: ``init``, ``iterate`` over a batch of
values, ``merge`` and ``terminate``, and the state as bytes.  A task keeps one
state for each key of the rows it reads and emits it once, as one binary value;
only these states are shuffled.  They are merged in a tree (first those of
``FAN_IN`` neighbouring tasks, then the rest), so that a key that every task holds
is not merged by one task alone, and ``terminate`` makes the result.

Built-in aggregates, and those that are sums of built-ins
(:class:`~sparkwright.functions.udfs.UserAggregate`), need none of this.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from fractions import Fraction
from typing import Any, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: States of one key that one merge step takes.
FAN_IN = 32
#: A task that holds states of more keys than this emits them and starts anew.
MAX_KEYS = 200_000


class StateAggregate:
    """init / iterate / merge / terminate; a state is any value, null input is the aggregate's affair."""

    #: Spark type of the result.
    result: str = "double"

    def init(self) -> Any:
        raise NotImplementedError

    def iterate(self, state: Any, values: pa.Array) -> Any:
        """The state after some more values of the key, in any order."""
        raise NotImplementedError

    def merge(self, a: Any, b: Any) -> Any:
        raise NotImplementedError

    def terminate(self, state: Any) -> Any:
        raise NotImplementedError

    def to_bytes(self, state: Any) -> bytes:
        return pickle.dumps(state, protocol=4)

    def from_bytes(self, data: bytes) -> Any:
        return pickle.loads(data)


class Maximum(StateAggregate):
    """The largest integer; nulls are skipped, null for none."""

    result = "long"

    def init(self):
        return None

    def iterate(self, state, values):
        top = pc.max(values).as_py()
        return self.merge(state, top)

    def merge(self, a, b):
        return b if a is None else a if b is None else max(a, b)

    def terminate(self, state):
        return state


class Mean(StateAggregate):
    """Mean of doubles from (sum, count); nulls are skipped, null for none.

    The sum is exact, a whole number for each binary exponent, so the result is
    the same however the rows are dealt.  NaN and infinities are summed apart and
    win.
    """

    def init(self):
        return {}, 0, None

    def iterate(self, state, values):
        sums, n, odd = state
        v = values.drop_null().to_numpy(zero_copy_only=False)
        finite = np.isfinite(v)
        if not finite.all():
            odd = (odd or 0.0) + float(v[~finite].sum())
        mantissa, exponent = np.frexp(v[finite])
        whole = np.ldexp(mantissa, 53).astype(np.int64)
        sums = dict(sums)
        for e in np.unique(exponent):
            own = whole[exponent == e]
            high, low = own >> 26, own & ((1 << 26) - 1)
            sums[int(e)] = sums.get(int(e), 0) + (int(high.sum()) << 26) + int(low.sum())
        return sums, n + len(v), odd

    def merge(self, a, b):
        sums = dict(a[0])
        for e, s in b[0].items():
            sums[e] = sums.get(e, 0) + s
        return sums, a[1] + b[1], a[2] if b[2] is None else (a[2] or 0.0) + b[2]

    def terminate(self, state):
        sums, n, odd = state
        if not n or odd is not None:
            return odd
        least = min(sums, default=0)
        total = sum(s << (e - least) for e, s in sums.items())
        return float(Fraction(total) * Fraction(2) ** (least - 53) / n)


class LongestRun(StateAggregate):
    """The longest run of consecutive days (dates) that all occur; nulls are skipped, 0 for none.

    The state is a bit for each day, kept by its number since 1970 in words of
    64 days: a set that grows with the days there are, not with the rows.
    """

    result = "int"

    def init(self):
        return {}

    def iterate(self, state, values):
        days = np.unique(pc.cast(values.drop_null(), pa.int32()).to_numpy(zero_copy_only=False))
        for word, bits in zip(days >> 6, np.uint64(1) << (days & 63).astype(np.uint64)):
            state[int(word)] = state.get(int(word), 0) | int(bits)
        return state

    def merge(self, a, b):
        for word, bits in b.items():
            a[word] = a.get(word, 0) | bits
        return a

    def terminate(self, state):
        best = run = 0
        last = None
        for word in sorted(state):
            bits = state[word]
            if last is not None and word != last + 1:
                run = 0
            for k in range(64):
                run = run + 1 if bits >> k & 1 else 0
                best = max(best, run)
            last = word
        return best


def _split(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[tuple, pa.Array]]:
    """(key, places) for each key of a batch; a null is a key like another."""
    code = np.zeros(batch.num_rows, dtype=np.int64)
    for k in keys:
        column = batch.column(k)
        part = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        code = np.unique(code * (int(part.max(initial=0)) + 1) + part, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
        if len(places):
            yield tuple(batch.column(k)[int(places[0])].as_py() for k in keys), pa.array(places)


def task_states(df: DataFrame, keys: Sequence[str], value: str, aggregate: StateAggregate) -> DataFrame:
    """``(*keys, task, state)``: one state a key and task.

    A task with more than ``MAX_KEYS`` keys emits several rounds of them, so its
    memory is bounded; the merge takes any number of states a key.
    """
    types = [df.schema[k] for k in keys]
    out = T.StructType([*types, T.StructField("_task", T.IntegerType()), T.StructField("_state", T.BinaryType())])
    arrow = [df.select(*keys).limit(0).toArrow().schema.field(k).type for k in keys]

    def emit(states: dict) -> pa.RecordBatch:
        columns = [pa.array([key[i] for key in states], t) for i, t in enumerate(arrow)]
        task = pa.array([TaskContext.get().partitionId()] * len(states), pa.int32())
        return pa.RecordBatch.from_arrays([*columns, task, pa.array(map(aggregate.to_bytes, states.values()), pa.binary())],
                                          names=[*keys, "_task", "_state"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, Any] = {}
        for batch in batches:
            for key, places in _split(batch, keys):
                state = states[key] if key in states else aggregate.init()
                states[key] = aggregate.iterate(state, batch.column(value).take(places))
            if len(states) > MAX_KEYS:
                yield emit(states)
                states = {}
        if states:
            yield emit(states)

    return df.select(*keys, value).mapInArrow(run, out)


def _merged(states: DataFrame, keys: Sequence[str], aggregate: StateAggregate, by: int | None, name: str) -> DataFrame:
    """One merge step; with ``by`` it joins the states of so many neighbouring tasks, without it all that are left."""
    schema = states.schema if by else T.StructType(
        [*(states.schema[k] for k in keys), T.StructField(name, T._parse_datatype_string(aggregate.result))])

    def run(table: pa.Table) -> pa.Table:
        state = None
        for i, data in enumerate(table.column("_state")):
            one = aggregate.from_bytes(data.as_py())
            state = one if i == 0 else aggregate.merge(state, one)
        first = table.slice(0, 1)
        if by:
            return first.set_column(first.schema.get_field_index("_state"), first.schema.field("_state"),
                                    pa.array([aggregate.to_bytes(state)], pa.binary()))
        out = first.select(list(keys)) if keys else None
        result = pa.array([aggregate.terminate(state)], to_arrow_type(schema[name].dataType))
        return out.append_column(name, result) if keys else pa.table({name: result})

    if not by:
        return states.groupBy(*keys).applyInArrow(run, schema)
    tasks = states.withColumn("_task", F.floor(F.col("_task") / by).cast("int"))
    return tasks.groupBy(*keys, "_task").applyInArrow(run, schema)


def aggregate_states(df: DataFrame, keys: Sequence[str], value: str, aggregate: StateAggregate, name: str) -> DataFrame:
    """``(*keys, name)``: the aggregate of ``value`` for each key.

    Keys that only have nulls get what ``terminate`` makes of them; without
    keys an empty input has no row.
    """
    states = _merged(task_states(df, keys, value, aggregate), keys, aggregate, FAN_IN, name)
    return _merged(states, keys, aggregate, None, name)
