"""Session helpers: the checkpoint folder comes from the session; lineage cuts
are written tables below it (never a local checkpoint)."""

from bagyard.session import SCALE_DEFAULTS, checkpoint_dir, cut_lineage


def test_checkpoint_dir_from_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark).rstrip("/") == configured.rstrip("/")


def test_cut_lineage_writes_below_checkpoint_dir(spark):
    df = cut_lineage(spark.range(10).withColumnRenamed("id", "x"), "unit")
    files = df.inputFiles()
    assert files and all(checkpoint_dir(spark).rstrip("/").removeprefix("file:") in f for f in files)
    assert "/tables/unit-" in files[0]
    assert sorted(r.x for r in df.collect()) == list(range(10))


def test_scale_defaults_applied_only_when_unset(spark):
    for key in SCALE_DEFAULTS:
        assert spark.conf.get(key) is not None
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_intermediate_tables_are_dropped(spark):
    import os

    from bagyard.session import checkpoint_dir, cut_lineage, intermediate_tables

    def there():
        folder = checkpoint_dir(spark).removeprefix("file:") + "/tables"
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    kept = cut_lineage(spark.range(3).toDF("x"), "kept")
    before = there()
    with intermediate_tables(spark):
        inner = cut_lineage(spark.range(5).toDF("x"), "inner")
        assert inner.count() == 5 and len(there()) == len(before) + 1
        with intermediate_tables(spark):
            cut_lineage(spark.range(2).toDF("x"), "inmost")
        assert len(there()) == len(before) + 1 and inner.count() == 5
    assert there() == before and kept.count() == 3


def test_keys_of_a_compressed_table_are_not_broadcast_by_estimate(spark, tmp_path):
    """The keys of a wide table that compresses well are a few MB by file size and column widths, whatever their number."""
    from pyspark.sql import functions as F

    wide = spark.range(400_000).select("id", *[F.concat(F.lit(f"c{i}-"), F.col("id") * (i + 1)).alias(f"c{i}") for i in range(6)])
    wide.coalesce(1).write.parquet(f"{tmp_path}/wide")
    left = spark.range(10_000_000).withColumn("x", F.lit(1))
    plan = left.join(spark.read.parquet(f"{tmp_path}/wide").select("id"), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert "BroadcastHashJoin" in left.join(spark.range(25).where("id > 3").withColumnRenamed("id", "k").selectExpr("k AS id"), "id")._jdf.queryExecution().executedPlan().toString()


def test_a_session_keeps_its_own_broadcast_threshold():
    from bagyard.session import BROADCAST, configure

    class Conf(dict):
        set = dict.__setitem__

    class Session:
        conf = Conf({"spark.sql.autoBroadcastJoinThreshold": "1m"})

    configure(Session)
    assert Session.conf["spark.sql.autoBroadcastJoinThreshold"] == "1m" and "spark.sql.adaptive.autoBroadcastJoinThreshold" not in Session.conf
    Session.conf = Conf()
    configure(Session)
    assert BROADCAST.items() <= Session.conf.items()


def test_a_table_of_a_hundred_thousand_keys_is_not_broadcast_by_its_measure(spark):
    """The driver holds a broadcast table several times over, and a job has a dozen of them at once."""
    from pyspark.sql import functions as F

    from bagyard.session import BROADCAST

    keys = spark.range(300_000).groupBy((F.col("id") % 100_000).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    few = spark.range(300_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    left = spark.range(2_000_000).select((F.col("id") * 7 % 1_000_000).alias("k")).distinct()
    assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == BROADCAST["spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for right, broadcast in ((keys, False), (few, True)):
        joined = left.join(right, "k", "left_semi")
        assert len(joined.collect()) == right.count()
        final = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert ("BroadcastHashJoin" in final) is broadcast


def test_tasks_stay_small_by_default():
    """A task reads 8 MB of a file or 4 MB of a shuffle, which keys and constants fill with a hundred times as much memory."""
    size = lambda v: int(v[:-1]) << 20 if v.endswith("m") else int(v)
    assert size(SCALE_DEFAULTS["spark.sql.files.maxPartitionBytes"]) <= 8 << 20
    advisory = size(SCALE_DEFAULTS["spark.sql.adaptive.advisoryPartitionSizeInBytes"])
    assert advisory <= 4 << 20 and int(SCALE_DEFAULTS["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) * advisory >= 6 << 30
