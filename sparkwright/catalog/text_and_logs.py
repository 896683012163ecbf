"""Text functions over documents / orders / part, listening logs over
events, a keyed time-series table, nested values, per-partition functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as X
from ..functions.row_function import count_phrases
from ..functions.udfs import invoke, register_sql_functions
from ..operators import aggregates as A
from ..operators import distinct_sets as D
from ..operators.ordering import first_per_group
from ..plans.analogs import event_listens
from ..sinks.tables import keyed_table, latest_cells
from ..session import scratch_path, table
from .registry import query

_WORDS_SQL = """
WITH w AS (SELECT unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\f]+')) AS word
           FROM documents)"""


@query("word_count", _WORDS_SQL + """
SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1""", "A28 F05 F09 P14")
def word_count(spark, sf):
    return A.word_count(table(spark, sf, "documents")).orderBy("word")


@query("count_histogram", _WORDS_SQL + """,
c AS (SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1)
SELECT n AS occurrences, count(*) AS words FROM c GROUP BY 1""", "A27 P17")
def count_histogram(spark, sf):
    return A.count_histogram(table(spark, sf, "documents"))


@query("text_measures", """
SELECT doc_id, CAST(length(text) AS INT) AS chars, CAST(strlen(text) AS INT) AS bytes,
       CAST(CASE WHEN instr(text, ' ') > 0 THEN strlen(substr(text, 1, instr(text, ' ') - 1))
            ELSE -1 END AS INT) AS first_space_byte,
       CAST(instr(text, ' ') - 1 AS INT) AS first_space_char,
       CAST(unicode(substr(text, 2, 1)) AS INT) AS second_code_point,
       CAST(coalesce(list_sum(list_transform(string_split(text, ''), lambda c: unicode(c))), 0) AS BIGINT) AS code_point_sum,
       CAST(CASE WHEN instr(text, ' ') > 0 AND instr(substr(text, instr(text, ' ') + 1), ' ') > 0
            THEN instr(text, ' ') + instr(substr(text, instr(text, ' ') + 1), ' ') - 1 ELSE -1 END AS INT) AS second_space_char,
       encode(text) < encode('The m') AS before_the_m
FROM documents""", "F06 F08")
def text_measures(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.char_length("text").alias("chars"),
                    X.byte_length("text").alias("bytes"),
                    X.find_byte("text", " ").alias("first_space_byte"),
                    X.find_char("text", " ").alias("first_space_char"),
                    F.get(X.code_points("text"), 1).alias("second_code_point"),
                    F.aggregate(X.code_points("text"), F.lit(0).cast("long"), lambda a, c: a + c).alias("code_point_sum"),
                    X.find_char_from("text", " ", X.find_char("text", " ") + 1).alias("second_space_char"),
                    (F.encode("text", "utf-8") < F.encode(F.lit("The m"), "utf-8")).alias("before_the_m"))


@query("strip_chars", """
SELECT p_partkey, trim(p_name, 'abc') AS stripped, trim('  ' || p_type || '  ') AS trimmed,
       lower(p_brand) AS brand_lower, p_brand || ':' || CAST(p_size AS VARCHAR) AS joined
FROM part""", "F02 F03 F04 F05 X02 X03 X04")
def strip_chars(spark, sf):
    """strip(s, chars) and strip(s) through one SQL function with a default
    argument; a built-in called by name."""
    register_sql_functions(spark)
    p = table(spark, sf, "part")
    return p.select("p_partkey",
                    F.expr("STRIP(p_name, 'abc')").alias("stripped"),
                    F.expr("strip(concat('  ', p_type, '  '))").alias("trimmed"),
                    invoke("lower", "p_brand").alias("brand_lower"),
                    F.concat("p_brand", F.lit(":"), "p_size").alias("joined"))


@query("conversions", """
SELECT o_orderkey, o_orderstatus || CAST(o_totalprice > 100000 AS VARCHAR) AS status_flag,
       CAST(o_orderdate AS VARCHAR) AS date_text,
       CAST(o_custkey + CAST('2' AS BIGINT) AS BIGINT) AS plus_text,
       CAST(o_custkey + CAST(o_totalprice > 100000 AS INT) AS BIGINT) AS plus_bool,
       CAST(o_custkey + epoch(o_orderdate) AS BIGINT) AS plus_seconds,
       TRY_CAST(o_orderpriority AS INT) AS priority_int
FROM orders""", "F04 F15 F16 F17")
def conversions(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        F.concat("o_orderstatus", (F.col("o_totalprice") > 100000).cast("string")).alias("status_flag"),
        F.col("o_orderdate").cast("string").alias("date_text"),
        F.expr("o_custkey + '2'").cast("long").alias("plus_text"),
        (F.col("o_custkey") + (F.col("o_totalprice") > 100000).cast("int")).alias("plus_bool"),
        (F.col("o_custkey") + F.unix_seconds(F.col("o_orderdate").cast("timestamp")))
        .cast("long").alias("plus_seconds"),
        X.safe_cast("o_orderpriority", "int").alias("priority_int"))


@query("decimals", """
SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(12, 2)) * 100 AS BIGINT) AS cents,
       greatest(c_acctbal, 0.0) AS non_negative, abs(c_acctbal) AS magnitude,
       CAST(c_custkey % 7 AS BIGINT) AS remainder
FROM customer""", "F18 F19")
def decimals(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey",
                    (F.col("c_acctbal").cast("decimal(12,2)") * 100).cast("long").alias("cents"),
                    F.greatest("c_acctbal", F.lit(0.0)).alias("non_negative"),
                    F.abs("c_acctbal").alias("magnitude"),
                    (F.col("c_custkey") % 7).alias("remainder"))


@query("dates", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d%H%M') AS compact,
       strptime(strftime(o_orderdate, '%Y%m%d%H%M'), '%Y%m%d%H%M') AS parsed,
       strftime(o_orderdate, '%m%d') AS month_day,
       strftime(o_orderdate, '%Y-%m-%d %H:%M') AS minute,
       9223372036854775807 - epoch_ms(o_orderdate) AS reverse_key
FROM orders""", "F12 F13 F14 F20")
def dates(spark, sf):
    o = table(spark, sf, "orders")
    compact = F.date_format("o_orderdate", "yyyyMMddHHmm")
    return o.select("o_orderkey", compact.alias("compact"),
                    X.parse_compact_ts(compact).cast("timestamp_ntz").alias("parsed"),
                    X.month_day(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("month_day"),
                    X.minute_format("o_orderdate").alias("minute"),
                    X.reverse_time_key("o_orderdate").alias("reverse_key"))


@query("regex_match", """
SELECT lang, count(*) FILTER (WHERE regexp_full_match(text, '(?s)[A-Z][a-z]+ [a-z].*')) AS matching,
       count(*) AS docs
FROM documents GROUP BY 1""", "F10")
def regex_match(spark, sf):
    """Full-string match (anchored like a Java String.matches)."""
    d = table(spark, sf, "documents")
    hit = F.col("text").rlike(r"^[A-Z][a-z]+ [a-z](?s:.*)$")
    return d.groupBy("lang").agg(F.count_if(hit).alias("matching"), F.count(F.lit(1)).alias("docs"))


# --- listening log ----------------------------------------------------------

_LISTENS_SQL = """
WITH l AS (SELECT user_id, TRY_CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INT) AS track_id,
                  CAST(event_type = 'view' AS INT) AS scrobbles,
                  CAST(event_type = 'click' AS INT) AS radio,
                  CAST(event_type = 'error' AS INT) AS skip FROM events)"""


@query("track_listeners", _LISTENS_SQL + """
SELECT track_id, count(DISTINCT user_id) AS listeners FROM l
WHERE track_id IS NOT NULL AND (scrobbles > 0 OR radio > 0) GROUP BY 1""", "A29")
def track_listeners(spark, sf):
    """Unique listeners per track."""
    ls = event_listens(table(spark, sf, "events"))
    is_listen = (F.col("scrobbles") > 0) | (F.col("radio") > 0)
    return (ls.where(is_listen & F.col("track_id").isNotNull())
            .groupBy("track_id").agg(F.count_distinct("user_id").alias("listeners")))


@query("track_listeners_counted", _LISTENS_SQL + """
SELECT track_id, count(DISTINCT user_id) AS listeners,
       (SELECT count(*) FROM l WHERE NOT (scrobbles > 0 OR radio > 0)) AS not_listen,
       (SELECT count(*) FROM l WHERE track_id IS NULL) AS invalid FROM l
WHERE track_id IS NOT NULL AND (scrobbles > 0 OR radio > 0) GROUP BY 1""", "A29")
def track_listeners_counted(spark, sf):
    """Unique listeners, and the dropped rows counted by the job that writes them."""
    ls = event_listens(table(spark, sf, "events"))
    is_listen = (F.col("scrobbles") > 0) | (F.col("radio") > 0)
    counted, obs = A.observed(ls, "listens", not_listen=F.count_if(~is_listen),
                              invalid=F.count_if(F.col("track_id").isNull()))
    path = scratch_path(spark, "listeners")
    (counted.where(is_listen & F.col("track_id").isNotNull())
     .groupBy("track_id").agg(F.count_distinct("user_id").alias("listeners")).write.parquet(path))
    return spark.read.parquet(path).select("*", *[F.lit(obs.get[c]).cast("long").alias(c) for c in ("not_listen", "invalid")])


@query("track_totals", _LISTENS_SQL + """
SELECT track_id, CAST(sum(scrobbles + radio) AS BIGINT) AS plays,
       CAST(sum(scrobbles) AS BIGINT) AS scrobbles, CAST(sum(radio) AS BIGINT) AS radio_plays,
       CAST(sum(skip) AS BIGINT) AS skips
FROM l WHERE track_id IS NOT NULL GROUP BY 1""", "A30")
def track_totals(spark, sf):
    return A.track_report(event_listens(table(spark, sf, "events"))).drop("listeners")


@query("track_report", _LISTENS_SQL + """
SELECT track_id, count(DISTINCT CASE WHEN scrobbles > 0 OR radio > 0 THEN user_id END) AS listeners,
       CAST(sum(scrobbles + radio) AS BIGINT) AS plays, CAST(sum(scrobbles) AS BIGINT) AS scrobbles,
       CAST(sum(radio) AS BIGINT) AS radio_plays, CAST(sum(skip) AS BIGINT) AS skips
FROM l WHERE track_id IS NOT NULL GROUP BY 1""", "A31 J18")
def track_report(spark, sf):
    """Listeners and totals in one grouped pass (no separate jobs + merge)."""
    return A.track_report(event_listens(table(spark, sf, "events")))


# --- keyed time-series table -----------------------------------------------------

def _keyed_events(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select(
        F.concat(F.lpad(F.col("user_id").cast("string"), 10, "0"), F.lit(":"),
                 F.lpad(X.reverse_time_key("ts").cast("string"), 19, "0")).alias("row_key"),
        "user_id", "ts", "value")
    path = scratch_path(spark, "keyed")
    keyed_table(rows, ["row_key"], path)
    return spark.read.parquet(path)


@query("keyed_table_count", """
SELECT user_id, count(*) AS n FROM events GROUP BY 1""", "K20 S23 A34")
def keyed_table_count(spark, sf):
    """Load a keyed table (station + reversed time), count rows per station."""
    return _keyed_events(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("keyed_scan_latest", """
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
  FROM events WHERE ts < TIMESTAMP '2024-01-15') WHERE rn <= 5""", "O11 F14 F20")
def keyed_scan_latest(spark, sf):
    """Latest 5 observations per station before a start time: on the keyed
    layout the newest rows of a station sort first."""
    k = _keyed_events(spark, sf).where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    top = first_per_group(k, ["user_id"], [F.col("row_key").asc()], 5)
    return top.select("user_id", X.minute_format("ts").alias("minute"), "value")


# --- nested values -------------------------------------------------------------

@query("tuple_flatten", """
SELECT p_partkey, p_name AS name, p_size AS size, 2 AS bag_size, p_brand AS map_value
FROM part""", "P23 F11 F07")
def tuple_flatten(spark, sf):
    """TOTUPLE / TOBAG / TOMAP constructors; FLATTEN of the tuple."""
    p = table(spark, sf, "part")
    nested = p.select("p_partkey",
                      F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size")).alias("t"),
                      F.array(F.struct(F.col("p_name").alias("v")),
                              F.struct(F.col("p_type").alias("v"))).alias("bag"),
                      F.create_map(F.lit("brand"), "p_brand").alias("m"))
    return nested.select("p_partkey", "t.*", F.size("bag").alias("bag_size"),
                         F.col("m")["brand"].alias("map_value"))


@query("complex_access", """
SELECT vec_id, embedding[1] AS first, embedding[1001] AS past_end,
       CAST(len(embedding) AS INT) AS dims, label
FROM embeddings""", "P26 F07")
def complex_access(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.get("embedding", 0).alias("first"),
                    F.get("embedding", 1000).alias("past_end"),
                    F.size("embedding").alias("dims"), "label")


@query("table_fn", """
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS pos,
       unnest(embedding) AS x FROM embeddings""", "X08 P25")
def table_fn(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.posexplode("embedding").alias("pos", "x"))


@query("setup_fn", """
WITH p AS (SELECT DISTINCT unnest([p_name, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)]) AS phrase FROM part)
SELECT doc_id, phrase, CAST((length(text) - length(replace(text, phrase, ''))) / length(phrase) AS BIGINT) AS n
FROM documents, p WHERE contains(text, phrase)""", "X07")
def setup_fn(spark, sf):
    """All part names and their words in whole documents: one automaton is built in each task, rows are emitted."""
    names = table(spark, sf, "part").select(F.explode(F.array(
        "p_name", *(F.split_part("p_name", F.lit(" "), F.lit(i)) for i in (1, 2)))).alias("phrase"))
    return count_phrases(table(spark, sf, "documents"), "doc_id", "text", names, "phrase")


@query("keyed_table_latest_cell", """
SELECT user_id, minute, value FROM (
  SELECT user_id, strftime(ts, '%Y-%m-%d %H') AS minute, value,
         row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d %H') ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type <> 'error') WHERE rn = 1""", "K20 S23")
def keyed_table_latest_cell(spark, sf):
    """Valid rows only are loaded; a row key that comes again keeps its newest cell."""
    e = table(spark, sf, "events").where(F.col("event_type") != "error")
    rows = e.select(F.struct("user_id", F.date_format("ts", "yyyy-MM-dd HH").alias("minute")).alias("k"),
                    F.struct("ts", "event_id").alias("cell_time"), "value")
    path = scratch_path(spark, "cells")
    keyed_table(latest_cells(rows.select("k.*", "cell_time", "value"), ["user_id", "minute"], "cell_time"),
                ["user_id", "minute"], path)
    return spark.read.parquet(path).select("user_id", "minute", "value")


@query("union_access", """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 0 ELSE 1 END AS tag,
       CASE WHEN p_size % 2 = 0 THEN p_size END AS as_int, CASE WHEN p_size % 2 = 1 THEN p_name END AS as_text
FROM part""", "P26")
def union_access(spark, sf):
    """A tagged union (one of an int and a text), read by its tag."""
    even = F.col("p_size") % 2 == 0
    p = table(spark, sf, "part").select("p_partkey", F.struct(
        F.when(even, 0).otherwise(1).alias("tag"), F.when(even, F.col("p_size")).alias("m0"),
        F.when(~even, F.col("p_name")).alias("m1")).alias("u"))
    return p.select("p_partkey", "u.tag", F.col("u.m0").alias("as_int"), F.col("u.m1").alias("as_text"))


@query("random_values", "SELECT count(*) AS rows, true AS in_range, true AS mean_near_half, true AS all_differ FROM customer", "F22")
def random_values(spark, sf):
    """rand(): one value in [0, 1) for each row."""
    r = table(spark, sf, "customer").select(F.rand(11).alias("r"))
    n = F.count(F.lit(1))
    return r.agg(n.alias("rows"), (F.count_if((F.col("r") >= 0) & (F.col("r") < 1)) == n).alias("in_range"),
                 (F.abs(F.avg("r") - 0.5) < 0.1).alias("mean_near_half"),
                 (F.count_distinct("r") > 0.99 * n).alias("all_differ"))


# --- distinct sets that are kept by day -------------------------------------------

_PERIODS = (("all", None, None), ("first week", "2024-01-01", "2024-01-07"), ("later", "2024-01-10", None))


def _listener_sets(spark, sf):
    """Listeners by track and day, read from the log once and stored."""
    e = table(spark, sf, "events")
    is_listen = F.col("event_type").isin("view", "click")
    track = F.regexp_extract("props", r'"k": (\d+)', 1).try_cast("int")
    log = e.where(is_listen).select("user_id", "ts", track.alias("track_id")).where(F.col("track_id").isNotNull())
    path = scratch_path(spark, "listener-sets")
    D.daily_sets(log, ["track_id"], F.col("ts"), "user_id").write.parquet(path)
    return spark.read.parquet(path)


_TRACK_DAYS = """
WITH l AS (SELECT user_id, CAST(ts AS DATE) AS day, TRY_CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INT) AS track_id
           FROM events WHERE event_type IN ('view', 'click'))"""


@query("listeners_by_period", _TRACK_DAYS + """
SELECT period, track_id, count(DISTINCT user_id) AS listeners
FROM l, (VALUES ('all', DATE '0001-01-01', DATE '9999-01-01'), ('first week', DATE '2024-01-01', DATE '2024-01-07'),
                ('later', DATE '2024-01-10', DATE '9999-01-01')) p(period, a, b)
WHERE track_id IS NOT NULL AND day BETWEEN a AND b GROUP BY 1, 2""", "A29 A08")
def listeners_by_period(spark, sf):
    """Unique listeners of each track in three periods, all from one stored table of bitmaps."""
    sets = _listener_sets(spark, sf)
    parts = [D.distinct_counts(sets, ["track_id"], first, last, "listeners").withColumn("period", F.lit(name))
             for name, first, last in _PERIODS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("returning_listeners", _TRACK_DAYS + """
SELECT track_id, count(*) AS returning FROM (
  SELECT DISTINCT track_id, user_id FROM l WHERE track_id IS NOT NULL AND day <= DATE '2024-01-09'
  INTERSECT SELECT track_id, user_id FROM l WHERE day >= DATE '2024-01-10') GROUP BY 1""", "A29")
def returning_listeners(spark, sf):
    """Listeners of a track in both of two periods."""
    return D.returning_counts(_listener_sets(spark, sf), ["track_id"], (None, "2024-01-09"), ("2024-01-10", None), "returning")
