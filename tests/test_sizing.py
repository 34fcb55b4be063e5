from martforge.session import sizing


def test_sizing_scales_with_input_and_keeps_a_floor():
    big = sizing(100 * 2**40, 8000)
    assert big["spark.sql.shuffle.partitions"] == "102400"
    assert big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "102400"
    small = sizing(10**6, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(big["spark.sql.autoBroadcastJoinThreshold"]) == 64 << 20
