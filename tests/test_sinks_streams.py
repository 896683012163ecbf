"""Writers, checkpointed intermediates and directory streams."""
import pytest
from pyspark.sql import functions as F

from sparkwright.sinks import tables as K
from sparkwright.streaming import spool as T


def test_colon_store(spark, tmp_path):
    a = spark.createDataFrame([("Joe", "cherry", 2), ("Ali", "apple", 3)], "a string, b string, c int")
    path = str(tmp_path / "out")
    K.delimited(a.coalesce(1), path, sep=":")
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ["Ali:apple:3", "Joe:cherry:2"]


def test_write_mode_errors(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "m")
    K.write_mode(df, path, "errorifexists")
    with pytest.raises(Exception):
        K.write_mode(df, path, "errorifexists")
    assert K.write_mode(df, path, "append").count() == 6
    assert K.write_mode(df, path, "overwrite").count() == 3


def test_checkpointed_reuses(spark, tmp_path):
    path = str(tmp_path / "ck")
    first = K.checkpointed(spark.range(5), path)
    again = K.checkpointed(spark.range(0), path)
    assert first.count() == again.count() == 5


def test_kv_text_and_gzip(spark, tmp_path):
    df = spark.createDataFrame([("1949", 111), ("1950", 22)], "k string, v int")
    path = str(tmp_path / "gz")
    K.kv_text(df, "k", "v", path, compression="gzip")
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["1949\t111", "1950\t22"]


def test_stream_append(spark, tmp_path):
    src = tmp_path / "spool"
    src.mkdir()
    (src / "a.txt").write_text("one\ntwo\n")
    (src / "b.txt").write_text("three\n")
    out = T.run_to_files(T.spool_source(spark, str(src)).select("value"), str(tmp_path / "sink"),
                         checkpoint=str(tmp_path / "ck"))
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["one", "three", "two"]
    # a second run with the same checkpoint processes nothing new
    T.run_to_files(T.spool_source(spark, str(src)).select("value"), out, checkpoint=str(tmp_path / "ck"))
    assert spark.read.text(out).count() == 3


def test_fanout_optional_failure_ignored(spark, tmp_path):
    src = tmp_path / "spool"
    src.mkdir()
    for i in range(3):
        (src / f"f{i}.txt").write_text(f"line{i}\n")
    req = str(tmp_path / "req")

    def required(b, i):
        b.write.mode("overwrite").text(f"{req}/batch_id={i}")

    def broken(b, i):
        raise RuntimeError("sink down")

    s = T.spool_source(spark, str(src), max_files_per_trigger=1).select("value")
    ignored = T.run_fanout(s, required, [broken], checkpoint=str(tmp_path / "ck"))
    assert len(ignored) == 3
    assert spark.read.text(req).count() == 3


def test_compaction_sized_from_metadata(spark, tmp_path):
    src = tmp_path / "small"
    src.mkdir()
    for c in "abcde":
        (src / c).write_bytes(bytes([ord(c)]) * 10)
    out = str(tmp_path / "packed")
    n = K.compact(spark, str(src) + "/*", out, target_bytes=25)
    assert n == 2
    packed = spark.read.parquet(out)
    assert packed.count() == 5 and packed.agg(F.sum(F.length("content"))).first()[0] == 50


def test_by_key_folders(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "station string, t int")
    out = str(tmp_path / "by")
    K.by_key(df, out, ["station"])
    assert sorted(p.name for p in (tmp_path / "by").iterdir() if p.is_dir()) == [
        "station=a", "station=b"]
    assert spark.read.parquet(out).where("station = 'a'").count() == 2


def test_best_effort_sink_holds_the_batches_it_could_write(spark, tmp_path):
    src = tmp_path / "spool"
    src.mkdir()
    for i in range(3):
        (src / f"f{i}.txt").write_text(f"line{i}\n")
    req, opt = str(tmp_path / "req"), str(tmp_path / "opt")

    def store(path):
        def sink(b, i):
            b.write.mode("overwrite").text(f"{path}/batch_id={i}")
        return sink

    def down_at_first(b, i):
        if i == 0:
            raise RuntimeError("sink down")
        store(opt)(b, i)

    s = T.spool_source(spark, str(src), max_files_per_trigger=1).select("value")
    ignored = T.run_fanout(s, store(req), [down_at_first], checkpoint=str(tmp_path / "ck"))
    assert len(ignored) == 1
    assert (spark.read.text(req).count(), spark.read.text(opt).count()) == (3, 2)


def test_half_written_copy_is_written_anew(spark, tmp_path):
    path = tmp_path / "half"
    spark.range(3).write.parquet(str(path))
    (path / "_SUCCESS").unlink()
    assert K.checkpointed(spark.range(7), str(path)).count() == 7
    with pytest.raises(FileNotFoundError):
        K.checkpointed(spark.range(7), str(path), inputs=[str(tmp_path / "no-such")])


def test_no_quoting_in_delimited_text(spark, tmp_path, tmp_text):
    from sparkwright.sources import text as S
    from pyspark.sql import types as ST
    schema = ST.StructType([ST.StructField(c, ST.StringType()) for c in "abc"])
    got = S.load_delimited(spark, tmp_text(["1\t\"ab\tc", "2\t\tx"]), "\t", schema).collect()
    assert [tuple(r) for r in got] == [("1", '"ab', "c"), ("2", "", "x")]
    out = str(tmp_path / "o")
    K.delimited(spark.createDataFrame([("", 'q"q', None)], "a string, b string, c string"), out, sep="|")
    assert [r.value for r in spark.read.text(out).collect()] == ['|q"q|']


def test_show_partitions_and_hot_key_files(spark, tmp_path):
    out = str(tmp_path / "p")
    K.by_key(spark.range(100).select((F.col("id") % 3).alias("k"), "id"), out, ["k"])
    assert sorted(r[0] for r in K.list_partitions(spark, out, ["k"]).collect()) == ["k=0", "k=1", "k=2"]


def test_many_folders_are_listed_in_few_tasks(spark, tmp_path):
    out = str(tmp_path / "many")
    K.by_key(spark.range(200).select((F.col("id") % 100).alias("k"), "id"), out, ["k"])
    sc = spark.sparkContext
    sc.setJobGroup("listing", "listing")
    try:
        found = spark.read.parquet(out)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert tasks and max(tasks) <= 64
    assert found.count() == 200 and found.select("k").distinct().count() == 100


def test_shared_folder_is_needed_on_a_cluster():
    from sparkwright.session import is_local, shared_dir

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)
            getConf = staticmethod(Conf)

    with pytest.raises(RuntimeError):
        shared_dir(Session())
    assert is_local("local[4]") and not is_local("local-cluster[2,1,1024]")


def test_cleanup_deletes_scratch(spark):
    import os

    from sparkwright.session import cleanup, scratch_path
    path = scratch_path(spark, "tidy")
    spark.range(1).write.parquet(path)
    assert cleanup(spark) >= 1
    assert not os.path.exists(path.removeprefix("file:"))
