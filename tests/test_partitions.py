"""Partitions of a shuffle follow the input."""

from footmark.session import PARTITIONS_CONF, prefer_partitions


def test_partitions_follow_the_input_unless_given(spark):
    before = spark.conf.get(PARTITIONS_CONF, None)
    try:
        spark.conf.unset(PARTITIONS_CONF)
        prefer_partitions(spark, 300)
        assert spark.conf.get(PARTITIONS_CONF) == "300"
        prefer_partitions(spark, 2)  # the smaller tables of the next query
        assert spark.conf.get(PARTITIONS_CONF) == spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set(PARTITIONS_CONF, "77")
        prefer_partitions(spark, 300)
        assert spark.conf.get(PARTITIONS_CONF) == "77"
    finally:
        spark.conf.unset(PARTITIONS_CONF)
        if before is not None:
            spark.conf.set(PARTITIONS_CONF, before)
