"""Iterative link ranking over an edge list.

Each round: every page sends score / outdegree along each of its links;
a page's new score is ``d + (1 - d) * inflow`` (a page with no inbound
links gets ``d``).  Only pages that have outbound links are ranked (links
to other pages carry no state).  The loop stops when the largest score
change is at most ``tol``, or after a given number of ``rounds``.  A round
shrinks the change by ``1 - d``, so the loop ends for any ``tol`` above 0.

The edges move once.  They are dealt into blocks, (page, slot, targets), of
about ``BLOCK`` targets each, and stored in a table that is bucketed by page and
slot; a page with more than ``SLOT_BLOCKS`` blocks has several slots, so that it
lies in several buckets.  A round sends each page's share to its slots, joins it
with the blocks where they lie, sums what the targets get before the shuffle,
and joins the sums with the pages: only scores are shuffled.  The page table is
checkpointed to the shared folder every round, so lineage stays one round deep and
a lost executor recomputes at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir, table_name

BLOCK = 1024
SLOT_BLOCKS = 64


def link_table(edges: DataFrame, src: str = "src", dst: str = "dst", buckets: int | None = None,
               block: int = BLOCK, slot_blocks: int = SLOT_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """(blocks of the distinct edges, pages with outdegree, slots and initial score 1.0).

    A target's block comes from its hash, so no task gathers a page's links.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct().write.parquet(path)
    e = spark.read.parquet(path)
    pages = (e.groupBy(F.col("src").alias("page")).agg(F.count(F.lit(1)).alias("outdeg"))
             .withColumn("slots", F.ceil(F.col("outdeg") / (block * slot_blocks)).cast("int")))
    large = pages.where(F.col("outdeg") > block).select(F.col("page").alias("src"), F.ceil(F.col("outdeg") / block).alias("blocks"), "slots")
    number = F.pmod(F.xxhash64("dst"), F.coalesce("blocks", F.lit(1)))
    blocks = (e.join(large, "src", "left").withColumn("number", number)
              .withColumn("slot", F.pmod("number", F.coalesce("slots", F.lit(1))).cast("int"))
              .groupBy("src", "slot", "number").agg(F.collect_list("dst").alias("targets")))
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = table_name("links")
    (blocks.repartition(buckets, "src", "slot").write.bucketBy(buckets, "src", "slot").sortBy("src", "slot")
     .option("path", scratch_path(spark, "links")).saveAsTable(name))
    return spark.table(name), pages.select("page", "outdeg", "slots", F.lit(1.0).alias("score"), F.lit(0.0).alias("last"))


def rank_round(blocks: DataFrame, pages: DataFrame, d: float) -> DataFrame:
    """One round: new score from inbound contributions."""
    shares = pages.select(F.col("page").alias("src"), F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"),
                          (F.col("score") / F.col("outdeg")).alias("share"))
    contrib = (blocks.join(shares, ["src", "slot"]).select(F.explode("targets").alias("page"), "share")
               .groupBy("page").agg(F.sum("share").alias("inflow")))
    return (pages.join(contrib, "page", "left")
            .select("page", "outdeg", "slots",
                    (F.lit(d) + F.lit(1.0 - d) * F.coalesce(F.col("inflow"), F.lit(0.0))).alias("score"),
                    F.col("score").alias("last")))


def max_delta(pages: DataFrame) -> DataFrame:
    """Largest change between the last two score sets (one row)."""
    return pages.agg(F.max(F.abs(F.col("score") - F.col("last"))).alias("delta"))


def pagerank(edges: DataFrame, d: float = 0.5, tol: float = 0.01, rounds: int | None = None,
             src: str = "src", dst: str = "dst", **layout) -> tuple[DataFrame, int, float]:
    """Iterate until max change <= tol, or exactly ``rounds`` rounds; returns (pages, rounds, delta).

    ``layout`` goes to :func:`link_table`.  The change is measured by the
    checkpoint's own job.
    """
    if rounds is None and not (tol > 0 and 0 < d <= 1):
        raise ValueError("without a number of rounds tol and d must be above 0")
    shared_dir(edges.sparkSession)  # make sure a checkpoint folder is configured
    blocks, pages = link_table(edges, src, dst, **layout)
    pages = pages.checkpoint(eager=True)
    done, delta = 0, float("inf")
    while done < rounds if rounds is not None else delta > tol:
        seen = Observation()
        change = F.max(F.abs(F.col("score") - F.col("last"))).alias("delta")
        pages = rank_round(blocks, pages, d).observe(seen, change).checkpoint(eager=True)
        delta = seen.get["delta"] or 0.0
        done += 1
    return pages, done, delta
