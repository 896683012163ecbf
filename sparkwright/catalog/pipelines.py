"""Multi-step and iterative jobs, directory streams."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ..plans.pagerank import max_delta, pagerank
from ..session import scratch_path, table
from ..streaming import committed as M
from ..streaming import spool as T
from .registry import query

# --- link ranking: user -> referenced item k (props) of the event stream ---

ROUNDS = 5
DAMPING = 0.5


def _edges(spark, sf):
    e = table(spark, sf, "events")
    return e.select(F.col("user_id").cast("string").alias("src"),
                    F.regexp_extract("props", r'"k": (\d+)', 1).alias("dst")).where(
        F.col("dst") != "")


def _pagerank_sql(rounds: int, d: float) -> str:
    ctes = ["""e AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS src,
                      regexp_extract(props, '"k": (\\d+)', 1) AS dst FROM events
             WHERE regexp_extract(props, '"k": (\\d+)', 1) <> '')""",
            "n AS (SELECT src AS page, count(*) AS outdeg FROM e GROUP BY 1)",
            "s0 AS (SELECT page, CAST(1.0 AS DOUBLE) AS score FROM n)"]
    for i in range(1, rounds + 1):
        ctes.append(f"""s{i} AS (SELECT n.page, {d} + {1 - d} * coalesce(x.inflow, 0.0) AS score
          FROM n LEFT JOIN (SELECT e.dst AS page, sum(p.score / m.outdeg) AS inflow
                            FROM e JOIN s{i - 1} p ON e.src = p.page JOIN n m ON m.page = p.page
                            GROUP BY 1) x ON n.page = x.page)""")
    return "WITH " + ",\n".join(ctes)


@query("pagerank", _pagerank_sql(ROUNDS, DAMPING) + f"""
SELECT s{ROUNDS}.page, round(s{ROUNDS}.score, 6) AS score,
       round(abs(s{ROUNDS}.score - s{ROUNDS - 1}.score), 6) AS change
FROM s{ROUNDS} JOIN s{ROUNDS - 1} ON s{ROUNDS}.page = s{ROUNDS - 1}.page""", "G01")
def pagerank_query(spark, sf):
    """A fixed number of rounds."""
    pages, _, _ = pagerank(_edges(spark, sf), d=DAMPING, rounds=ROUNDS)
    return pages.select("page", F.round("score", 6).alias("score"),
                        F.round(F.abs(F.col("score") - F.col("last")), 6).alias("change"))


@query("score_delta", _pagerank_sql(ROUNDS, DAMPING) + f"""
SELECT round(max(abs(s{ROUNDS}.score - s{ROUNDS - 1}.score)), 6) AS delta
FROM s{ROUNDS} JOIN s{ROUNDS - 1} ON s{ROUNDS}.page = s{ROUNDS - 1}.page""", "A35")
def score_delta(spark, sf):
    pages, _, _ = pagerank(_edges(spark, sf), d=DAMPING, rounds=ROUNDS)
    return max_delta(pages).select(F.round("delta", 6).alias("delta"))


UNROLLED = 16     # the change halves each round: more than 0.01 needs


def _converged_sql() -> str:
    rounds = range(1, UNROLLED + 1)
    deltas = " UNION ALL ".join(f"""SELECT {i} AS r, (SELECT max(abs(a.score - b.score)) FROM s{i} a
      JOIN s{i - 1} b ON a.page = b.page) AS delta""" for i in rounds)
    scores = " UNION ALL ".join(f"SELECT {i} AS r, page, score FROM s{i}" for i in rounds)
    return _pagerank_sql(UNROLLED, DAMPING) + f""", d AS ({deltas}), f AS (SELECT min(r) AS r FROM d WHERE delta <= 0.01)
SELECT page, round(score, 6) AS score, CAST(f.r AS INT) AS rounds, round(d.delta, 6) AS delta
FROM ({scores}) s JOIN f ON s.r = f.r JOIN d ON d.r = f.r"""


@query("pagerank_converged", _converged_sql(), "G01")
def pagerank_converged(spark, sf):
    """Iterate until the largest change is at most 0.01; report rounds."""
    pages, rounds, delta = pagerank(_edges(spark, sf), d=DAMPING, tol=0.01)
    return pages.select("page", F.round("score", 6).alias("score"),
                        F.lit(rounds).alias("rounds"), F.lit(round(delta, 6)).alias("delta"))


# --- materialised intermediates --------------------------------------------

@query("result_map", """
SELECT string_agg(p_brand || '=' || CAST(n AS VARCHAR), ',' ORDER BY p_brand) AS brand_counts
FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1)""", "G03")
def result_map(spark, sf):
    """A grouped result brought back as one map value (bounded: one entry
    per brand)."""
    per = table(spark, sf, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    m = per.agg(F.map_from_entries(F.collect_list(F.struct("p_brand", "n"))).alias("m"))   # an entry for each brand
    entries = F.array_sort(F.map_entries("m"))
    return m.select(F.array_join(F.transform(entries, lambda x: F.concat(
        x["key"], F.lit("="), x["value"].cast("string"))), ",").alias("brand_counts"))


@query("shared_intermediate", """
WITH v AS (SELECT l_orderkey, l_extendedprice FROM lineitem
           WHERE l_linenumber IN (0, 1, 4, 5, 9) AND l_quantity <> 50)
SELECT 'count' AS measure, CAST(count(*) AS DOUBLE) AS value FROM v
UNION ALL SELECT 'max', max(l_extendedprice) FROM v""", "G02 K13")
def shared_intermediate(spark, sf):
    """One intermediate, written once to the shared folder, feeds two outputs."""
    li = table(spark, sf, "lineitem")
    v = li.where(F.col("l_linenumber").isin(0, 1, 4, 5, 9) & (F.col("l_quantity") != 50)).select(
        "l_orderkey", "l_extendedprice")
    path = scratch_path(spark, "shared")
    v.write.parquet(path)
    v = spark.read.parquet(path)
    a = v.agg(F.lit("count").alias("measure"), F.count(F.lit(1)).cast("double").alias("value"))
    b = v.agg(F.lit("max").alias("measure"), F.max("l_extendedprice").alias("value"))
    return a.unionByName(b)


# --- directory streams --------------------------------------------------------

_EVENT_SCHEMA = "event_id long, user_id long, event_type string"


def _spool(spark, sf, files=None):
    """Events dropped into a folder as JSON-lines files."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    e = e.repartition(files) if files else e
    path = scratch_path(spark, "spool")
    e.select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    return path


def _payload(df, col="value"):
    return df.select(F.from_json(col, _EVENT_SCHEMA).alias("e")).select("e.*")


@query("stream_append", "SELECT event_id, user_id, event_type FROM events", "T01 T06")
def stream_append(spark, sf):
    """Spooled files -> appended text files (committed through the sink log)."""
    out = T.run_to_files(T.spool_source(spark, _spool(spark, sf)).select("value"),
                         scratch_path(spark, "stream-out"))
    return _payload(spark.read.text(out))


@query("stream_partitioned", "SELECT event_id, user_id, event_type FROM events", "T02")
def stream_partitioned(spark, sf):
    """Arrival-time stamped, stored under year/month/day folders."""
    s = T.with_arrival_time(T.spool_source(spark, _spool(spark, sf)).select("value"))
    out = T.run_to_files(s, scratch_path(spark, "stream-part"), fmt="parquet",
                         partition_by=["year", "month", "day"])
    back = spark.read.parquet(out)
    assert {"year", "month", "day"} <= set(back.columns)
    return _payload(back)


@query("stream_envelope", """
SELECT event_id, user_id, event_type, 2 AS header_count FROM events""", "T03")
def stream_envelope(spark, sf):
    """Events kept as {headers, body}, written as snappy parquet."""
    s = T.envelope(T.spool_source(spark, _spool(spark, sf)))
    out = T.run_to_files(s, scratch_path(spark, "stream-env"), fmt="parquet",
                         options={"compression": "snappy"})
    back = spark.read.parquet(out)
    return (back.select(F.from_json("body", _EVENT_SCHEMA).alias("e"),
                        F.size("headers").alias("header_count"))
            .select("e.*", "header_count"))


@query("stream_fanout", """
SELECT event_id, user_id, event_type, sink FROM events, (VALUES ('required'), ('best effort')) s(sink)""", "T04")
def stream_fanout(spark, sf):
    """Each batch goes to a required sink and a best-effort sink; a third
    one, best effort too, is always down and costs the others nothing."""
    required_path = scratch_path(spark, "fan-required")
    optional_path = scratch_path(spark, "fan-optional")

    def required(batch, batch_id):
        # one folder per batch id, overwritten on replay: exactly-once output
        batch.select("value").write.mode("overwrite").text(f"{required_path}/batch_id={batch_id}")

    def best_effort(batch, batch_id):
        batch.select("value").write.mode("overwrite").text(f"{optional_path}/batch_id={batch_id}")

    def down(batch, batch_id):
        raise ConnectionError("sink down")

    src = T.spool_source(spark, _spool(spark, sf), max_files_per_trigger=4).select("value")
    T.run_fanout(src, required, [down, best_effort])
    return (_payload(spark.read.text(required_path)).withColumn("sink", F.lit("required"))
            .unionByName(_payload(spark.read.text(optional_path)).withColumn("sink", F.lit("best effort"))))


@query("stream_committed", """
SELECT event_id, user_id, event_type, true AS in_batches FROM events""", "T06")
def stream_committed(spark, sf):
    """A stream whose readers go by a manifest: a batch that is written and not committed is not seen.

    The run fails between the write and the commit of its second batch and is
    started again; every row is there once.
    """
    out, checkpoint, failed = scratch_path(spark, "committed"), scratch_path(spark, "committed-ckpt"), []

    def fail_once(number):
        if number == 1 and not failed:
            failed.append(number)
            raise ConnectionError("lost before the commit")

    folder = _spool(spark, sf, 8)

    def run():
        return M.run_committed(T.spool_source(spark, folder, max_files_per_trigger=3).select("value"), out, checkpoint, fail_once)

    try:
        run()
    except StreamingQueryException:
        assert failed and [r.batch for r in M.read_committed(spark, out).select("batch").distinct().collect()] == [0]
    batches = run()
    seen = M.read_committed(spark, out)
    return (seen.select(F.from_json("value", _EVENT_SCHEMA).alias("e"), "batch")
            .select("e.*", F.col("batch").between(0, batches - 1).alias("in_batches")))
