"""Weather-style views over the driver tables.

The jobs in this package are written against weather readings (station,
time, temperature, quality), small lookup tables and listening logs.  These
functions expose driver tables in those shapes, as projections only, so
every query built on them scans the whole table and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: quantity that stands for a missing reading.
MISSING_QUANTITY = 50.0


def lineitem_readings(lineitem: DataFrame) -> DataFrame:
    """One reading per line item.

    station_id = supplier, observed_at = ship date, temperature = extended
    price, quality = line number, missing = quantity 50.
    """
    return lineitem.select(
        F.col("l_suppkey").alias("station_id"),
        F.col("l_shipdate").alias("observed_at"),
        F.year("l_shipdate").alias("year"),
        F.col("l_extendedprice").alias("temperature"),
        F.col("l_linenumber").alias("quality"),
        # null-safe (never null), so filters on it push down to the scan
        F.col("l_quantity").eqNullSafe(MISSING_QUANTITY).alias("missing"),
    )


def lineitem_ncdc_fields(lineitem: DataFrame) -> DataFrame:
    """Fields of a fixed-width weather line derived from a line item.

    temperature (tenths) = floor(extended price / 100) - 500, or the missing
    sentinel for quantity 50; usaf = supplier key, wban = line number.
    """
    temp = F.when(F.col("l_quantity") == MISSING_QUANTITY, F.lit(9999)).otherwise(
        (F.floor(F.col("l_extendedprice") / 100) - 500).cast("int"))
    return lineitem.select(
        F.col("l_suppkey").alias("usaf"),
        F.col("l_linenumber").alias("wban"),
        F.col("l_shipdate").alias("observed_at"),
        temp.alias("temperature"),
        F.col("l_linenumber").alias("quality"),
    )


def event_listens(events: DataFrame) -> DataFrame:
    """A listening log from the event stream.

    user = user_id, track = the ``k`` number in ``props``; a 'view' is a
    scrobble, a 'click' a radio play, an 'error' a skip.  Other kinds are
    rows with no listen (counted, then dropped by the listener job).
    """
    return events.select(
        F.col("user_id").alias("user_id"),
        F.regexp_extract("props", r'"k": (\d+)', 1).try_cast("int").alias("track_id"),
        (F.col("event_type") == "view").cast("int").alias("scrobbles"),
        (F.col("event_type") == "click").cast("int").alias("radio"),
        (F.col("event_type") == "error").cast("int").alias("skip"),
    )
