"""Weather-style jobs over ``lineitem`` (and ``customer`` / ``part``).

Analogy (see ``plans.analogs``): station = supplier, reading time = ship
date, temperature = extended price, quality = line number, missing =
quantity 50.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import state_aggregate as S
from ..functions import transform as T
from ..functions.udfs import MAXIMUM, MEAN, max_by_group, register_sql_functions
from ..operators import aggregates as A
from ..plans.analogs import lineitem_readings
from ..session import scratch_path, table
from .registry import query

VALID_SQL = "l_linenumber IN (0, 1, 4, 5, 9) AND l_quantity <> 50"


def _readings(spark: SparkSession, sf: str) -> DataFrame:
    return lineitem_readings(table(spark, sf, "lineitem"))


def max_by_year(spark: SparkSession, sf: str) -> DataFrame:
    valid = A.valid_readings(_readings(spark, sf))
    return A.max_per_key(valid, "year", "temperature", "max_temperature")


query("max_by_year", f"""
SELECT CAST(year(l_shipdate) AS INT) AS year, max(l_extendedprice) AS max_temperature
FROM lineitem WHERE {VALID_SQL} GROUP BY 1""", "A01 A02 A03 P06")(max_by_year)


@query("max_by_year_sql", f"""
SELECT CAST(year(l_shipdate) AS INT) AS year, max(l_extendedprice) AS max_temperature
FROM lineitem WHERE l_linenumber IN (0, 1, 4, 5, 9) AND l_quantity <> 50 GROUP BY 1""",
       "A03 X14")
def max_by_year_sql(spark, sf):
    # A parameterised script: input table and the missing marker are arguments.
    return spark.sql(
        "SELECT CAST(year(l_shipdate) AS INT) AS year, max(l_extendedprice) AS max_temperature "
        "FROM {src} WHERE l_linenumber IN (0, 1, 4, 5, 9) AND l_quantity <> :missing "
        "GROUP BY 1", args={"missing": 50.0}, src=table(spark, sf, "lineitem"))


@query("max_by_year_macro", f"""
SELECT CAST(year(l_shipdate) AS INT) AS year, max(l_extendedprice) AS max_temperature
FROM lineitem WHERE {VALID_SQL} GROUP BY 1""", "X13 A05")
def max_by_year_macro(spark, sf):
    valid = A.valid_readings(_readings(spark, sf))
    return valid.transform(lambda d: max_by_group(d, "year", "temperature", "max_temperature"))


@query("max_by_year_udf", """
SELECT CAST(year(l_shipdate) AS INT) AS year, max(l_extendedprice) AS max_temperature
FROM lineitem WHERE coalesce(l_linenumber IN (0, 1, 4, 5, 9), false) AND l_quantity <> 50
GROUP BY 1""", "X01 F21")
def max_by_year_udf(spark, sf):
    register_sql_functions(spark)
    return spark.sql(
        "SELECT year, max(temperature) AS max_temperature FROM {r} "
        "WHERE isgood(quality) AND NOT missing GROUP BY year", r=_readings(spark, sf))


@query("max_by_year_script", f"""
SELECT CAST(year(l_shipdate) AS VARCHAR) AS year, max(l_extendedprice) AS max_temperature
FROM lineitem WHERE {VALID_SQL} GROUP BY 1""", "X09 X10 X11 X12")
def max_by_year_script(spark, sf):
    r = _readings(spark, sf).where(~F.col("missing"))
    return T.map_combine_reduce(r, "year", "temperature", "quality",
                                T.script_command(spark, "max_temp_map.py"),
                                T.script_command(spark, "max_temp_reduce.py"),
                                "max_temperature")


@query("argmax_per_year", f"""
SELECT year, temperature, station_id, observed_at, quality FROM (
  SELECT CAST(year(l_shipdate) AS INT) AS year, l_extendedprice AS temperature,
         l_suppkey AS station_id, l_shipdate AS observed_at, l_linenumber AS quality,
         row_number() OVER (PARTITION BY year(l_shipdate) ORDER BY l_extendedprice DESC,
           l_suppkey DESC, l_shipdate DESC, l_linenumber DESC) AS rn
  FROM lineitem WHERE {VALID_SQL}) WHERE rn = 1""", "A11 X06 O05")
def argmax_per_year(spark, sf):
    valid = A.valid_readings(_readings(spark, sf))
    return A.argmax_per_key(valid, "year", "temperature",
                            ["station_id", "observed_at", "quality"])


@query("global_argmax", """
SELECT p_retailprice, p_partkey, p_name, p_brand, p_type, p_size FROM (
  SELECT *, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey DESC, p_name DESC,
    p_brand DESC, p_type DESC, p_size DESC) AS rn FROM part) WHERE rn = 1""", "A12")
def global_argmax(spark, sf):
    return A.global_argmax(table(spark, sf, "part"), "p_retailprice").select(
        "p_retailprice", "p_partkey", "p_name", "p_brand", "p_type", "p_size")


@query("user_max_mean", """
SELECT c_mktsegment, max(CAST(trunc(c_acctbal) AS INT)) AS max_balance,
       round(CAST(sum(CAST(c_acctbal AS DECIMAL(38,6))) AS DOUBLE) / count(c_acctbal), 6)
         AS mean_balance
FROM customer GROUP BY c_mktsegment""", "A13 A14 X05")
def user_max_mean(spark, sf):
    c = table(spark, sf, "customer")
    return c.groupBy("c_mktsegment").agg(
        MAXIMUM(F.col("c_acctbal").cast("int")).alias("max_balance"),
        F.round(MEAN("c_acctbal"), 6).alias("mean_balance"))


@query("user_state_by_year", """
SELECT CAST(year(l_shipdate) AS INT) AS year, round(avg(l_extendedprice), 4) AS mean_price,
       max(l_orderkey) AS max_order
FROM lineitem GROUP BY 1""", "A13 A14 X05")
def user_state_by_year(spark, sf):
    """The mean and the maximum as aggregates with a state of their own: one binary state a key and task."""
    li = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    mean = S.aggregate_states(li, ["year"], "l_extendedprice", S.Mean(), "mean_price")
    top = S.aggregate_states(li, ["year"], "l_orderkey", S.Maximum(), "max_order")
    return mean.withColumn("mean_price", F.round("mean_price", 4)).join(top, "year")


@query("longest_daily_run", """
WITH d AS (SELECT DISTINCT l_suppkey AS station_id, CAST(year(l_shipdate) AS INT) AS year, CAST(l_shipdate AS DATE) AS day FROM lineitem),
r AS (SELECT station_id, year, day - CAST(row_number() OVER (PARTITION BY station_id, year ORDER BY day) AS INT) AS run FROM d)
SELECT station_id, year, CAST(max(n) AS INT) AS days
FROM (SELECT station_id, year, run, count(*) AS n FROM r GROUP BY 1, 2, 3) GROUP BY 1, 2""", "X05")
def longest_daily_run(spark, sf):
    """An aggregate that no built-in gives: most days in a row with a reading, by station and year."""
    r = _readings(spark, sf).select("station_id", "year", F.col("observed_at").cast("date").alias("day"))
    return S.aggregate_states(r, ["station_id", "year"], "day", S.LongestRun(), "days")


@query("daily_max", f"""
SELECT l_suppkey AS station_id, strftime(l_shipdate, '%Y-%m-%d') AS day,
       max(l_extendedprice) AS max_value
FROM lineitem WHERE {VALID_SQL} GROUP BY 1, 2""", "A15 F12")
def daily_max(spark, sf):
    valid = A.valid_readings(_readings(spark, sf))
    return A.daily_max(valid, "station_id", "observed_at", "temperature")


@query("mean_daily_max", f"""
WITH d AS (SELECT l_suppkey AS station_id, strftime(l_shipdate, '%Y-%m-%d') AS day,
                  max(CAST(floor(l_extendedprice) AS BIGINT)) AS max_value
           FROM lineitem WHERE {VALID_SQL} GROUP BY 1, 2)
SELECT station_id, substr(day, 6, 2) || substr(day, 9, 2) AS month_day,
       CAST(floor(sum(max_value) / count(*)) AS BIGINT) AS mean_max
FROM d GROUP BY 1, 2""", "A16 F13 G04")
def mean_daily_max(spark, sf):
    valid = A.valid_readings(_readings(spark, sf)).withColumn(
        "temperature", F.floor("temperature"))
    return A.mean_of_daily_max(A.daily_max(valid, "station_id", "observed_at", "temperature"))


@query("histogram_trunc", """
SELECT CAST(trunc(trunc(c_acctbal) / 10) AS BIGINT) AS bin, count(*) AS n
FROM customer GROUP BY 1""", "A17")
def histogram_trunc(spark, sf):
    c = table(spark, sf, "customer")
    return A.histogram_truncated(c.select(F.col("c_acctbal").cast("long").alias("t")), "t", 10)


@query("year_stats", """
SELECT CAST(year(l_shipdate) AS INT) AS year, count(DISTINCT l_suppkey) AS distinct_count,
       count(*) FILTER (WHERE l_linenumber IN (0, 1, 4, 5, 9)) AS good_count,
       count(*) AS record_count
FROM lineitem GROUP BY 1""", "A09 U04")
def year_stats(spark, sf):
    return A.nested_group_stats(_readings(spark, sf), "year", "station_id", "quality")


@query("multi_insert_stats", f"""
WITH s AS (SELECT year(l_shipdate) AS y, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1),
     r AS (SELECT year(l_shipdate) AS y, count(*) AS n FROM lineitem GROUP BY 1),
     g AS (SELECT year(l_shipdate) AS y, count(*) AS n FROM lineitem WHERE {VALID_SQL} GROUP BY 1)
SELECT CAST(s.y AS INT) AS year, s.n AS stations, r.n AS records, g.n AS good_records
FROM s JOIN r ON s.y = r.y JOIN g ON s.y = g.y""", "K12 J10 A08")
def multi_insert_stats(spark, sf):
    """One scan feeds three outputs (stations, records, good records per
    year); the grouped result is written once, the outputs are written from
    it, and they are star-joined back together."""
    from ..operators.joins import star_join
    from ..sinks.tables import multi_insert
    r = _readings(spark, sf)
    good = ~F.col("missing") & F.col("quality").isin(0, 1, 4, 5, 9)
    # a single grouped pass computes all three measures (one shuffle)
    per_year = r.groupBy("year").agg(
        F.count_distinct("station_id").alias("stations"),
        F.count(F.lit(1)).alias("records"),
        F.count_if(good).alias("good_records"))
    outs = multi_insert(per_year, {
        "stations": (["year", "stations"], None),
        "records": (["year", "records"], None),
        "good_records": (["year", "good_records"], F.col("good_records") > 0),
    })
    return star_join(outs["stations"], [outs["records"], outs["good_records"]], "year")


@query("group_all_count", """
SELECT 'all' AS "group", count(*) AS n FROM events WHERE value IS NOT NULL""", "A07 P07")
def group_all_count(spark, sf):
    e = table(spark, sf, "events").where(F.col("value").isNotNull())
    return A.group_all_count(e)


@query("quality_counters", """
SELECT count(*) FILTER (WHERE l_quantity = 50) AS missing,
       count(*) FILTER (WHERE l_extendedprice > 100000) AS over_range,
       count(*) AS records
FROM lineitem""", "A32")
def quality_counters(spark, sf):
    return A.quality_counters(_readings(spark, sf), over_range=100000)


@query("quality_code_counts", """
SELECT l_linenumber AS quality, count(*) AS n FROM lineitem GROUP BY 1""", "A32")
def quality_code_counts(spark, sf):
    return _readings(spark, sf).groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@query("quality_report", """
SELECT l_linenumber AS quality, count(*) AS n,
       (SELECT count(*) FROM lineitem WHERE l_quantity = 50) AS missing,
       (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS malformed
FROM lineitem GROUP BY 1""", "A32")
def quality_report(spark, sf):
    """Counters for missing and malformed records and the counts by quality
    code, all from one scan: a line whose flag is R has no number."""
    number = F.when(F.col("l_returnflag") == "R", "?").otherwise(F.col("l_quantity").cast("string"))
    path = scratch_path(spark, "quality-lines")
    table(spark, sf, "lineitem").select(
        F.concat_ws(" ", F.col("l_linenumber").cast("string"), number,
                    (F.col("l_quantity") == 50).cast("string")).alias("value")).write.text(path)
    part = F.split("value", " ")
    lines = spark.read.text(path).select(F.get(part, 0).cast("int").alias("quality"),
                                         F.get(part, 1).try_cast("double").alias("number"), F.get(part, 2).alias("gone"))
    counted, obs = A.observed(lines, "quality", missing=F.count_if(F.col("gone") == "true"),
                              malformed=F.count_if(F.col("number").isNull()))
    out = scratch_path(spark, "quality-codes")
    counted.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).write.parquet(out)
    return spark.read.parquet(out).select(
        "*", *[F.lit(obs.get[c]).cast("long").alias(c) for c in ("missing", "malformed")])


@query("missing_pct", """
SELECT round(100.0 * count(*) FILTER (WHERE l_quantity = 50) / count(*), 6) AS missing_pct
FROM lineitem""", "A33")
def missing_pct(spark, sf):
    r = _readings(spark, sf)
    return r.agg(F.round(F.lit(100.0) * F.count_if("missing") / F.count(F.lit(1)), 6)
                 .alias("missing_pct"))


@query("side_count", f"""
SELECT CAST(year(l_shipdate) AS INT) AS year, max(l_extendedprice) AS max_temperature,
       (SELECT count(*) FROM lineitem WHERE NOT ({VALID_SQL})) AS rejected
FROM lineitem WHERE {VALID_SQL} GROUP BY 1""", "A36")
def side_count(spark, sf):
    """Main result plus a counter computed by the same scan (an Observation)."""
    r = _readings(spark, sf)
    good = F.col("quality").isin(0, 1, 4, 5, 9) & ~F.col("missing")
    counted, obs = A.observed(r, "rejected", rejected=F.count_if(~good))
    result = counted.where(good).groupBy("year").agg(F.max("temperature").alias("max_temperature"))
    path = scratch_path(spark, "counted")
    result.write.parquet(path)  # the job that writes the result fills the observation
    return spark.read.parquet(path).withColumn("rejected", F.lit(obs.get["rejected"]).cast("long"))


# --- two differently formatted sources, unioned ---------------------------------

def _climate_text(spark, sf):
    """Orders rendered as monthly climate lines: year, month, tmax with one
    decimal (tenths = floor(total price / 1000)); status 'P' is missing."""
    from ..session import scratch_path
    o = table(spark, sf, "orders")
    tenths = F.floor(F.col("o_totalprice") / 1000).cast("long")
    tmax = F.when(F.col("o_orderstatus") == "P", F.lit("---")).otherwise(
        F.concat((tenths / 10).cast("long").cast("string"), F.lit("."), (tenths % 10).cast("string")))
    line = F.concat(F.lit("   "), F.year("o_orderdate").cast("string"),
                    F.lpad(F.month("o_orderdate").cast("string"), 4, " "), F.lit("  "),
                    F.lpad(tmax, 5, " "), F.lit("     2.0       6   104.6"))
    path = scratch_path(spark, "climate")
    o.select(line.alias("value")).write.text(path)
    return path


@query("multi_source_max", f"""
WITH a AS (SELECT CAST(year(l_shipdate) AS INT) AS year,
                  CAST(floor(l_extendedprice / 100) AS INT) - 500 AS temperature
           FROM lineitem WHERE {VALID_SQL}),
     b AS (SELECT CAST(year(o_orderdate) AS INT) AS year,
                  CAST(floor(o_totalprice / 1000) AS INT) AS temperature
           FROM orders WHERE o_orderstatus <> 'P')
SELECT year, max(temperature) AS max_temperature FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
GROUP BY 1""", "U03 S05 S01 F19")
def multi_source_max(spark, sf):
    """Fixed-width readings and monthly climate lines parsed by their own
    readers, unioned, then max per year."""
    from ..sources.weather import parse_metoffice, parse_ncdc
    from .io_formats import _ncdc_text
    ncdc = parse_ncdc(spark.read.text(_ncdc_text(spark, sf))).where("valid").select(
        "year", "temperature")
    climate = parse_metoffice(spark.read.text(_climate_text(spark, sf))).select(
        F.col("year").cast("int").alias("year"), "temperature")
    return ncdc.unionByName(climate).groupBy("year").agg(
        F.max("temperature").alias("max_temperature"))


# --- small collection operations -----------------------------------------------

@query("group_by_length", """
SELECT CAST(length(p_name) AS INT) AS name_length, count(*) AS n FROM part GROUP BY 1""",
       "A06 F06 A22")
def group_by_length(spark, sf):
    p = table(spark, sf, "part")
    return p.groupBy(F.length("p_name").alias("name_length")).agg(F.count(F.lit(1)).alias("n"))


@query("collection_stats", """
SELECT count(c_name) AS n, min(c_name) AS lowest, max(c_name) AS highest FROM customer""", "A23")
def collection_stats(spark, sf):
    c = table(spark, sf, "customer")
    return c.agg(F.count("c_name").alias("n"), F.min("c_name").alias("lowest"),
                 F.max("c_name").alias("highest"))


@query("element_counts", """
SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1""", "A24")
def element_counts(spark, sf):
    c = table(spark, sf, "customer")
    return c.groupBy(F.col("c_mktsegment").alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query("sum_by_key", """
SELECT o_orderpriority AS key, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total,
       count(*) AS n
FROM orders GROUP BY 1""", "A25")
def sum_by_key(spark, sf):
    """reduceByKey(+) / foldByKey(0)(+): an exact (decimal) sum per key."""
    o = table(spark, sf, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("key")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
        F.count(F.lit(1)).alias("n"))


@query("global_sum", """
SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders""", "A26")
def global_sum(spark, sf):
    o = table(spark, sf, "orders")
    return o.agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
