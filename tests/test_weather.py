"""Parsers and the max-temperature family on the literal fixtures."""
from pyspark.sql import functions as F

from sparkwright.operators import aggregates as A
from sparkwright.sources.weather import parse_metoffice, parse_ncdc, parse_station_metadata

# Weather lines in the fixed-width format, whose fields the readers must give.
NCDC = [
    "0067011990999991950051507004+68750+023550FM-12+038299999V0203301N00671220001CN9999999N9+00001+99999999999",
    "0043011990999991950051512004+68750+023550FM-12+038299999V0203201N00671220001CN9999999N9+00221+99999999999",
    "0043011990999991950051518004+68750+023550FM-12+038299999V0203201N00261220001CN9999999N9-00111+99999999999",
    "0043012650999991949032412004+62300+010750FM-12+048599999V0202701N00461220001CN0500001N9+01111+99999999999",
    "0043012650999991949032418004+62300+010750FM-12+048599999V0202701N00461220001CN0500001N9+00781+99999999999",
]


def test_ncdc_fields(spark):
    r = parse_ncdc(spark.createDataFrame([(x,) for x in NCDC], "value string")).collect()
    assert [x.temperature for x in r] == [0, 22, -11, 111, 78]
    assert r[0].station_id == "011990-99999" and r[0].year == 1950 and r[0].quality == "1"
    assert str(r[0].observed_at) == "1950-05-15 07:00:00"
    assert all(x.valid for x in r)


def test_max_by_year_golden(spark):
    r = parse_ncdc(spark.createDataFrame([(x,) for x in NCDC], "value string"))
    out = A.max_per_key(r.where("valid"), "year", "temperature", "m").orderBy("year").collect()
    assert [(x.year, x.m) for x in out] == [(1949, 111), (1950, 22)]


def test_invalid_quality_and_missing(spark):
    bad_q = NCDC[0][:92] + "2" + NCDC[0][93:]
    missing = NCDC[0][:87] + "+9999" + NCDC[0][92:]
    malformed = NCDC[0][:87] + "x0000" + NCDC[0][92:]
    r = parse_ncdc(spark.createDataFrame([(bad_q,), (missing,), (malformed,)], "value string")).collect()
    assert [x.valid for x in r] == [False, False, False]
    assert r[1].missing and not r[1].malformed
    assert r[2].malformed and r[2].temperature is None


def test_counters_malformed(spark):
    malformed = NCDC[0][:87] + "x0000" + NCDC[0][92:]
    r = parse_ncdc(spark.createDataFrame([(malformed,)], "value string"))
    c = A.quality_counters(r, malformed="malformed").first()
    assert c.malformed == 1 and c.records == 1
    assert r.where("valid").count() == 0


def test_metoffice(spark):
    header = "Cardiff Bute Park"
    rows = ["   1978   1    7.5     2.0       6   104.6    47.3",
            "   1978   2  -17.5     2.0       6   104.6    47.3",
            "   1978   3    ---     2.0       6   104.6    47.3", header]
    r = parse_metoffice(spark.createDataFrame([(x,) for x in rows], "value string")).collect()
    assert [(x.year, x.temperature) for x in r] == [("1978", 75), ("1978", -175)]


def test_station_metadata(spark):
    line = "715390 99999 MOOSE JAW CS                  CN CA SA CZMJ  +50317 -105550 +05770"
    rows = [line, "short header", "USAF   WBAN  STATION NAME                  CTRY  ST CALL  LAT    LON     ELEV(.1M)"]
    r = parse_station_metadata(spark.createDataFrame([(x,) for x in rows], "value string")).collect()
    assert len(r) == 1
    assert r[0].station_id == "715390-99999"
    assert r[0].station_name.strip() == "MOOSE JAW CS"


def test_histogram_truncates_toward_zero(spark):
    df = spark.createDataFrame([(-7,), (7,), (-11,), (15,)], "t int")
    out = {r.bin: r.n for r in A.histogram_truncated(df, "t", 10).collect()}
    assert out == {0: 2, -1: 1, 1: 1}


def test_mean_of_daily_max_floor(spark):
    daily = spark.createDataFrame([("s", "1950-01-01", 3), ("s", "1951-01-01", 4)],
                                  "station_id string, day string, max_value int")
    r = A.mean_of_daily_max(daily).first()
    assert (r.month_day, r.mean_max) == ("0101", 3)
