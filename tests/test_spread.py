"""Steps that hold many rows of a task are dealt over enough tasks."""

from uptrail.operators import fold as fo


def test_small_partitions_are_not_merged_again(spark):
    """Partitions of some bytes: adaptive execution would make one task of them."""
    number = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert fo.spread(spark.range(1000), ["id"]).rdd.getNumPartitions() == number
    assert fo.dealt_anew(spark.range(1000), ["id"]).rdd.getNumPartitions() == number


def test_a_union_is_dealt_anew_though_its_sides_are_by_key(spark):
    one = spark.range(1000).groupBy("id").count()
    both = fo.dealt_anew(one.unionByName(spark.range(500).groupBy("id").count()), ["id"]).groupBy("id").count()
    assert both.rdd.getNumPartitions() == 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert both.where("count = 2").count() == 500
