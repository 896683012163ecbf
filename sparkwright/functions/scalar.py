"""Column-level scalar functions (all JVM-side, codegen friendly)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quality codes that mark a reading as trustworthy.
GOOD_QUALITY_CODES = (0, 1, 4, 5, 9)
# Fixed value: the sentinel for a missing temperature reading.
MISSING_TEMPERATURE = 9999
# Fixed value: largest signed 64-bit integer, base of the reversed time key.
MAX_LONG = 9223372036854775807


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_good_quality(q) -> Column:
    """True for a good quality code; null or anything else is False."""
    return F.coalesce(_c(q).isin(*GOOD_QUALITY_CODES), F.lit(False))


def quoted(text: str) -> str:
    """A pattern that matches the text itself."""
    return re.sub(r"([^A-Za-z0-9_\s])", r"\\\1", text)


def java_trim(s) -> Column:
    """Trim every char <= U+0020 at both ends (spaces, tabs, controls)."""
    return F.regexp_replace(_c(s), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def strip(s, chars: str | None = None) -> Column:
    """Strip whitespace, or any of ``chars``, from both ends."""
    if chars is None:
        return F.regexp_replace(_c(s), r"^\s+|\s+$", "")
    return F.btrim(_c(s), F.lit(chars))


def char_length(s) -> Column:
    """Length in Unicode code points."""
    return F.char_length(_c(s))


def byte_length(s) -> Column:
    """Length in UTF-8 bytes."""
    return F.octet_length(_c(s))


def find_char(s, sub: str) -> Column:
    """0-based code-point index of ``sub`` in ``s``; -1 when absent."""
    return F.instr(_c(s), sub) - 1


def find_byte(s, sub: str) -> Column:
    """0-based UTF-8 byte offset of ``sub`` in ``s``; -1 when absent."""
    pos = F.instr(_c(s), sub)
    return F.when(pos > 0, F.octet_length(F.substring(_c(s), 1, pos - 1))).otherwise(F.lit(-1))


def code_points(s) -> Column:
    """Array of the code points of ``s`` (one element per character)."""
    chars = F.split(_c(s), "")
    return F.transform(F.filter(chars, lambda ch: ch != ""), lambda ch: F.ascii(ch))


def byte_offsets(s) -> Column:
    """UTF-8 byte offset of every character of ``s``."""
    chars = F.filter(F.split(_c(s), ""), lambda ch: ch != "")
    return F.transform(chars, lambda ch, i: F.octet_length(F.substring(_c(s), F.lit(1), i)))


def month_day(date_str) -> Column:
    """'MMdd' of a 'yyyy-MM-dd' date string."""
    return F.concat(F.substring(_c(date_str), 6, 2), F.substring(_c(date_str), 9, 2))


def minute_format(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm")


def reverse_time_key(ts) -> Column:
    """MAX_LONG - epoch millis: newer rows sort first in ascending key order."""
    millis = F.unix_millis(_c(ts).cast("timestamp"))
    return F.lit(MAX_LONG).cast("long") - millis


def parse_compact_ts(s) -> Column:
    """Parse ``yyyyMMddHHmm``; bad text gives null."""
    return F.try_to_timestamp(_c(s), F.lit("yyyyMMddHHmm"))


def safe_cast(c, to: str) -> Column:
    """Cast that yields null instead of raising (ANSI stays on)."""
    return _c(c).try_cast(to)


def trunc_div(a, b: int) -> Column:
    """Integer division truncated toward zero (the Java rule)."""
    a = _c(a).cast("long")
    return ((a - a % b) / b).cast("long")


def find_char_from(s, sub: str, start: Column) -> Column:
    """Code-point index of the first ``sub`` at or after index ``start`` (0 if that is below 0); -1 if there is none."""
    return (F.call_function("locate", F.lit(sub), _c(s), F.greatest(start, F.lit(0)) + 1) - 1).cast("int")
