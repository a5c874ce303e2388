import pytest

from tabreg.session import checkpoint_dir, size_shuffle_partitions


def test_checkpoint_dir_read_from_session(spark):
    d = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == d


def test_size_shuffle_partitions(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        n = size_shuffle_partitions(spark, 100 * (1 << 40), target_bytes=256 << 20)
        assert n == 409600 and spark.conf.get("spark.sql.shuffle.partitions") == "409600"
        assert size_shuffle_partitions(spark, 10) == spark.sparkContext.defaultParallelism
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_release_of_single_tables(spark):
    from tabreg.session import cut_lineage, release_tables
    a, b = cut_lineage(spark.range(5)), cut_lineage(spark.range(7))
    release_tables(a, spark.range(3))
    assert b.count() == 7
    with pytest.raises(Exception):
        a.count()
    release_tables(a, b)
