"""Row functions with a set-up for each task and an emitter.

:class:`RowFunction` is the user's side.  The object that travels to the tasks is
only a description; what cannot travel (a compiled automaton, a handle) is made
by ``initialize`` in the task, once, before its first row, and let go by
``cleanup``.  ``process`` calls ``emit`` any number of times for a row.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from typing import Any, Callable

import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame

#: Rows that are emitted at once.
BATCH_ROWS = 10_000


class RowFunction:
    """initialize, process for each row, cleanup."""

    def initialize(self) -> None:
        """Once a task, before the first row."""

    def process(self, row: dict[str, Any], emit: Callable[..., None]) -> None:
        """One input row; ``emit(*values)`` gives one output row."""
        raise NotImplementedError

    def cleanup(self, emit: Callable[..., None]) -> None:
        """Once a task, behind the last row; may still emit."""


def parallel_do(df: DataFrame, function: RowFunction, schema: str, setups: Accumulator | None = None) -> DataFrame:
    """Rows that the function emits for the rows of ``df``.

    Rows come in Arrow batches and are looked at one by one; emitted rows leave in
    batches of at most ``BATCH_ROWS``.  A task without rows makes no object.
    ``setups`` counts the set-ups.  A task that is run again is set up again.
    """
    fields = df.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def emit(*values) -> None:
            if len(values) != len(fields):
                raise ValueError(f"{len(values)} values for {len(fields)} columns")
            rows.append(values)

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)], names=fields.names)
            rows.clear()
            return batch

        own = None
        for batch in batches:
            if own is None and batch.num_rows:
                own = copy.copy(function)
                own.initialize()
                if setups is not None:
                    setups.add(1)
            for i in range(batch.num_rows):
                own.process({n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}, emit)
                if len(rows) >= BATCH_ROWS:
                    yield out()
        if own is not None:
            own.cleanup(emit)
            if rows:
                yield out()

    return df.mapInArrow(run, schema)


class PhraseCounter(RowFunction):
    """Occurrences of many phrases in a text, by one automaton over all of them.

    The automaton is built in the task; only the phrases are sent.  Emits
    (id, phrase, times) for each phrase that occurs; a null text has none.
    Occurrences that overlap all count.
    """

    def __init__(self, phrases: list[str], id: str, text: str):
        self.phrases, self.id, self.text = [p for p in dict.fromkeys(phrases) if p], id, text

    def initialize(self) -> None:
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for number, phrase in enumerate(self.phrases):
            self.automaton.add_word(phrase, number)
        if self.phrases:
            self.automaton.make_automaton()

    def process(self, row, emit) -> None:
        if not self.phrases or not row[self.text]:
            return
        times: dict[int, int] = {}
        for _, number in self.automaton.iter(row[self.text]):
            times[number] = times.get(number, 0) + 1
        for number, n in times.items():
            emit(row[self.id], self.phrases[number], n)


def count_phrases(docs: DataFrame, id: str, text: str, phrases: DataFrame, phrase: str,
                  max_bytes: int = 8 << 20, setups: Accumulator | None = None) -> DataFrame:
    """``id, phrase, n`` of every phrase that occurs in a text.

    The distinct phrases are sent to the tasks in slices of at most about
    ``max_bytes``, their size being counted first; each slice is one pass.
    """
    from pyspark.sql import functions as F
    some = phrases.select(F.col(phrase).alias("phrase")).where("phrase <> ''").distinct()
    size = some.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    slices, out = max(1, -(-size // max_bytes)), None
    kind = docs.schema[id].dataType.simpleString()
    for s in range(slices):
        own = some.where(F.pmod(F.xxhash64("phrase"), F.lit(slices)) == s) if slices > 1 else some
        found = parallel_do(docs.select(id, text), PhraseCounter([r.phrase for r in own.collect()], id, text),
                            f"`{id}` {kind}, phrase string, n long", setups)
        out = found if out is None else out.unionByName(found)
    return out
