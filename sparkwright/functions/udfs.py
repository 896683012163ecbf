"""User functions: SQL functions, macros and user-defined aggregates.

Everything a user would reach for a UDF for is written as a SQL function
(inlined by the analyzer, so it stays inside whole-stage codegen) or as a
Column-returning Python function.  The user aggregate is declared as
algebraic partials + a final expression, so Spark still runs it as a
partial aggregate before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scalar import GOOD_QUALITY_CODES


def register_sql_functions(spark: SparkSession) -> None:
    """Temporary SQL functions used by the SQL-facing jobs.

    ``isgood(q)``: good quality code, null -> false.
    ``strip(s [, chars])``: one name, two arities (DEFAULT parameter); SQL
    function names are case-insensitive, so STRIP works too.
    """
    codes = ", ".join(str(q) for q in GOOD_QUALITY_CODES)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION isgood(q INT) RETURNS BOOLEAN "
              f"RETURN coalesce(q IN ({codes}), false)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION strip(s STRING, chars STRING DEFAULT NULL) "
              "RETURNS STRING RETURN CASE WHEN chars IS NULL THEN regexp_replace(s, r'^\\s+|\\s+$', '') ELSE btrim(s, chars) END")


def invoke(name: str, *args) -> Column:
    """Call any built-in or registered function by name."""
    return F.call_function(name, *[F.col(a) if isinstance(a, str) else a for a in args])


def max_by_group(df: DataFrame, key: str, field: str, name: str | None = None) -> DataFrame:
    """Macro: relation, key, field -> (key, max of field).

    Use with ``df.transform(lambda d: max_by_group(d, 'year', 'temp'))``.
    The grouped max over a bag's field folds into one partial+final
    aggregate instead of building the bag.
    """
    return df.groupBy(key).agg(F.max(field).alias(name or f"max_{field}"))


@dataclass(frozen=True)
class UserAggregate:
    """A user aggregate in init/iterate/merge/terminate form.

    ``partials`` maps a partial name to the built-in aggregate that
    computes it (Spark runs init/iterate per task and merge after the
    shuffle); ``terminate`` turns the merged partials into the result.
    """

    partials: dict[str, Callable[[Column], Column]]
    terminate: Callable[[dict[str, Column]], Column]

    def __call__(self, value) -> Column:
        v = F.col(value) if isinstance(value, str) else value
        parts = {k: f(v) for k, f in self.partials.items()}
        return self.terminate(parts)


# Integer maximum: nulls skipped, null on empty input.
MAXIMUM = UserAggregate({"m": F.max}, lambda p: p["m"])

# Double mean from (sum, count) partials: null on empty input.  The sum is
# exact (decimal) so the result does not depend on task order.
MEAN = UserAggregate(
    {"s": lambda v: F.sum(v.cast("decimal(38,6)")), "n": F.count},
    lambda p: F.when(p["n"] > 0, p["s"].cast("double") / p["n"]))
