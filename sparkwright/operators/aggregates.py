"""Grouped and global aggregations.

Every aggregate here is algebraic (max, sum, count, max_by over a struct,
collect_set over a bounded domain), so Spark plans it as a partial
aggregate before the exchange and a final one after it: a hot key sends one
partial row per map task across the network, never its raw rows.  Distinct
counts use Spark's expand/two-level rewrite, which shuffles on
(key, value) first, so a hot key's distinct values are spread over tasks too.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalar import GOOD_QUALITY_CODES, is_good_quality, trunc_div


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_readings(df: DataFrame, temperature="temperature", quality="quality",
                   missing: str | None = "missing") -> DataFrame:
    """Keep readings that are present and have a good quality code."""
    cond = _c(quality).isin(*GOOD_QUALITY_CODES) & _c(temperature).isNotNull()
    if missing:
        cond = cond & ~F.coalesce(_c(missing), F.lit(False))
    return df.where(cond)


def max_per_key(df: DataFrame, key, value, name: str = "max_value") -> DataFrame:
    """Maximum of ``value`` per ``key`` (partial + final hash aggregate)."""
    keys = key if isinstance(key, (list, tuple)) else [key]
    return df.groupBy(*keys).agg(F.max(value).alias(name))


def argmax_per_key(df: DataFrame, key: str, order_by: str, cols: Iterable[str]) -> DataFrame:
    """The whole record holding the max of ``order_by`` per key.

    ``max(struct(order_by, *cols))`` compares field by field, so ties on
    ``order_by`` are broken by the remaining fields: deterministic output.
    """
    cols = [c for c in cols if c != order_by]
    best = F.max(F.struct(F.col(order_by).alias(order_by), *[F.col(c) for c in cols]))
    return df.groupBy(key).agg(best.alias("_best")).select(key, "_best.*")


def global_argmax(df: DataFrame, order_by: str) -> DataFrame:
    """One row: the record with the largest non-null ``order_by``."""
    cols = [c for c in df.columns if c != order_by]
    best = F.max(F.struct(F.col(order_by), *[F.col(c) for c in cols]))
    return (df.where(F.col(order_by).isNotNull()).agg(best.alias("_best"))
            .where(F.col("_best").isNotNull()).select("_best.*").select(*df.columns))


def group_all_count(df: DataFrame, col: str | None = None) -> DataFrame:
    """GROUP ALL + COUNT: one row keyed 'all'; empty input gives no row."""
    n = F.count(F.lit(1)) if col is None else F.count(col)
    return (df.groupBy(F.lit("all").alias("group")).agg(n.alias("n")))


def nested_group_stats(df: DataFrame, key: str, distinct_col: str, quality: str) -> DataFrame:
    """Per key: distinct count, good-record count and total count."""
    return df.groupBy(key).agg(
        F.count_distinct(distinct_col).alias("distinct_count"),
        F.count_if(is_good_quality(quality)).alias("good_count"),
        F.count(F.lit(1)).alias("record_count"))


def histogram_truncated(df: DataFrame, value: str, width: int = 10) -> DataFrame:
    """Readings per bin, bin = value / width truncated toward zero."""
    return df.groupBy(trunc_div(value, width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def daily_max(df: DataFrame, station: str, ts: str, value: str) -> DataFrame:
    """Max per (station, day); the day is a 'yyyy-MM-dd' string."""
    return df.groupBy(F.col(station).alias("station_id"),
                      F.date_format(ts, "yyyy-MM-dd").alias("day")).agg(
        F.max(value).alias("max_value"))


def mean_of_daily_max(daily: DataFrame) -> DataFrame:
    """Mean of daily maxima per (station, 'MMdd'), floor division."""
    mmdd = F.concat(F.substring("day", 6, 2), F.substring("day", 9, 2))
    return daily.groupBy("station_id", mmdd.alias("month_day")).agg(
        F.floor(F.sum("max_value") / F.count(F.lit(1))).cast("long").alias("mean_max"))


def words(df: DataFrame, text: str = "text", lower: bool = True) -> DataFrame:
    """One row per whitespace-separated word of every text (whole texts)."""
    t = F.lower(text) if lower else F.col(text)
    # one separator, so that the split needs no regular expression; runs of it leave empty words
    return (df.select(F.explode(F.split(F.translate(t, "\t\n\r\f", "    "), " ")).alias("word"))
            .where(F.col("word") != ""))


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    return words(df, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def count_histogram(df: DataFrame, text: str = "text") -> DataFrame:
    """How many words occur exactly n times: (n, words)."""
    return (word_count(df, text).groupBy(F.col("n").alias("occurrences"))
            .agg(F.count(F.lit(1)).alias("words")))


def quality_counters(df: DataFrame, temperature="temperature", quality="quality",
                     missing="missing", malformed: str | None = None,
                     over_range: float = 1000) -> DataFrame:
    """Data-quality counters as one aggregate row (one scan)."""
    exprs = [F.count_if(F.coalesce(_c(missing), F.lit(False))).alias("missing"),
             F.count_if(_c(temperature) > over_range).alias("over_range"),
             F.count(F.lit(1)).alias("records")]
    if malformed:
        exprs.append(F.count_if(_c(malformed)).alias("malformed"))
    return df.agg(*exprs)


def observed(df: DataFrame, name: str, **counters: Column):
    """Attach side counters to ``df`` (filled by the first action on it)."""
    obs = Observation(name)
    return df.observe(obs, *[c.alias(k) for k, c in counters.items()]), obs


def track_report(listens: DataFrame) -> DataFrame:
    """Per-track listeners, plays, scrobbles, radio plays and skips.

    Listeners count distinct users among rows that are listens (scrobble or
    radio play); the sums cover every parsed row.  One grouped aggregate.
    """
    is_listen = (F.col("scrobbles") > 0) | (F.col("radio") > 0)
    return (listens.where(F.col("track_id").isNotNull())
            .groupBy("track_id").agg(
                F.count_distinct(F.when(is_listen, F.col("user_id"))).alias("listeners"),
                F.sum(F.col("scrobbles") + F.col("radio")).cast("long").alias("plays"),
                F.sum("scrobbles").cast("long").alias("scrobbles"),
                F.sum("radio").cast("long").alias("radio_plays"),
                F.sum("skip").cast("long").alias("skips")))
