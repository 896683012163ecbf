"""Fixed-width weather readings, station metadata and monthly climate text.

All parsers take a DataFrame of text lines (column ``value``, as produced by
``spark.read.text``) and return typed columns.  Everything is a projection,
so a parser fuses into the scan's codegen stage and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import GOOD_QUALITY_CODES, MISSING_TEMPERATURE, parse_compact_ts

# 1-based column positions of the fixed-width weather record.
NCDC_USAF = (5, 6)        # start, length
NCDC_WBAN = (11, 5)
NCDC_DATETIME = (16, 12)  # yyyyMMddHHmm
NCDC_YEAR = (16, 4)
NCDC_SIGN = 88
NCDC_TEMP_DIGITS = (89, 4)
NCDC_QUALITY = 93
# Station metadata layout and minimum line length.
STATION_USAF = (1, 6)
STATION_WBAN = (8, 5)
STATION_NAME = (14, 29)
STATION_MIN_LEN = 42
# Monthly climate layout (year, tmax) and its missing marker.
CLIMATE_YEAR = (4, 4)
CLIMATE_TMAX = (14, 5)
CLIMATE_MIN_LEN = 18
CLIMATE_MISSING = "---"


def _sub(line: Column, span: tuple[int, int]) -> Column:
    return F.substring(line, span[0], span[1])


def parse_ncdc(lines: DataFrame, col: str = "value") -> DataFrame:
    """Typed weather readings.

    Columns: station_id ('usaf-wban'), observed_at (timestamp), year (int),
    temperature (int tenths of a degree; null when malformed), quality
    (string, one char), malformed / missing / valid flags.
    """
    line = F.col(col)
    sign = F.substring(line, NCDC_SIGN, 1)
    digits = _sub(line, NCDC_TEMP_DIGITS)
    temp = (F.when(sign == "+", digits.try_cast("int"))
            .when(sign == "-", F.concat(F.lit("-"), digits).try_cast("int")))
    quality = F.substring(line, NCDC_QUALITY, 1)
    malformed = temp.isNull()
    missing = F.coalesce(temp == MISSING_TEMPERATURE, F.lit(False))
    good_q = quality.rlike("^[" + "".join(str(q) for q in GOOD_QUALITY_CODES) + "]$")
    return lines.select(
        F.concat(_sub(line, NCDC_USAF), F.lit("-"), _sub(line, NCDC_WBAN)).alias("station_id"),
        parse_compact_ts(_sub(line, NCDC_DATETIME)).alias("observed_at"),
        _sub(line, NCDC_YEAR).try_cast("int").alias("year"),
        temp.alias("temperature"),
        quality.alias("quality"),
        malformed.alias("malformed"),
        missing.alias("missing"),
        (~malformed & ~missing & good_q).alias("valid"),
    )


def render_ncdc(df: DataFrame, station_usaf: Column, station_wban: Column,
                observed_at: Column, temperature: Column, quality: Column) -> DataFrame:
    """Inverse of :func:`parse_ncdc`: one fixed-width line per row.

    Fields not modelled are filled with a constant so the line has the full
    record width; a null temperature is written as the missing sentinel.
    """
    t = F.coalesce(temperature.cast("int"), F.lit(MISSING_TEMPERATURE))
    sign = F.when(t < 0, F.lit("-")).otherwise(F.lit("+"))
    line = F.concat(
        F.lit("0000"),
        F.lpad(station_usaf.cast("string"), 6, "0"),
        F.lpad(station_wban.cast("string"), 5, "0"),
        F.date_format(observed_at, "yyyyMMddHHmm"),
        F.lit("4+00000+000000FM-12+000099999V0200000N00001220001CN9999999N9"),
        sign,
        F.lpad(F.abs(t).cast("string"), 4, "0"),
        quality.cast("string"),
        F.lit("+99999999999"),
    )
    return df.select(line.alias("value"))


def parse_station_metadata(lines: DataFrame, col: str = "value") -> DataFrame:
    """(station_id, station_name) from fixed-width station lines.

    Lines shorter than 42 characters (headers) and lines whose USAF id is not
    numeric are dropped.
    """
    line = F.col(col)
    usaf = _sub(line, STATION_USAF)
    return (lines
            .where((F.length(line) >= STATION_MIN_LEN) & usaf.rlike(r"^[+-]?[0-9]+$"))
            .select(F.concat(usaf, F.lit("-"), _sub(line, STATION_WBAN)).alias("station_id"),
                    _sub(line, STATION_NAME).alias("station_name")))


def render_station_metadata(df: DataFrame, usaf: Column, wban: Column, name: Column) -> DataFrame:
    """Fixed-width station lines (inverse of :func:`parse_station_metadata`)."""
    return df.select(F.concat(
        F.lpad(usaf.cast("string"), 6, "0"), F.lit(" "),
        F.lpad(wban.cast("string"), 5, "0"), F.lit(" "),
        F.rpad(name, 29, " "), F.lit(" US   +00000+000000+00000")).alias("value"))


def parse_metoffice(lines: DataFrame, col: str = "value") -> DataFrame:
    """(year, temperature) from monthly climate text; headers skipped.

    ``---`` marks a missing value (row dropped).  Decimal degrees are scaled
    by ten exactly (decimal arithmetic, no float rounding).
    """
    line = F.col(col)
    year = _sub(line, CLIMATE_YEAR)
    raw = F.trim(_sub(line, CLIMATE_TMAX))
    tenths = (raw.try_cast("decimal(10,2)") * F.lit(10)).try_cast("int")
    return (lines
            .where((F.length(line) >= CLIMATE_MIN_LEN) & year.rlike(r"^[+-]?[0-9]+$")
                   & (raw != CLIMATE_MISSING))
            .select(year.alias("year"), tenths.alias("temperature")))
