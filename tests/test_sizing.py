"""Partition and bucket sizing rules (pure functions)."""

from tidewell.session import sizing
from tidewell.sources.tables import buckets_for

MiB = 1024 * 1024


def test_shuffle_partitions_follow_input_size():
    assert sizing(0)["spark.sql.shuffle.partitions"] == "200"
    assert sizing(10 ** 9)["spark.sql.shuffle.partitions"] == "200"
    big = int(sizing(100 * 10 ** 12)["spark.sql.shuffle.partitions"])
    assert 100 * 10 ** 12 / big <= 256 * MiB < 100 * 10 ** 12 / (big - 1)
    assert int(sizing(10 ** 18)["spark.sql.shuffle.partitions"]) > 1_000_000
    assert sizing(10 ** 12)["spark.sql.files.maxPartitionBytes"] == str(256 * MiB)


def test_bucket_counts_are_powers_of_two_within_bounds():
    assert buckets_for(0) == 8 and buckets_for(10 * MiB) == 8
    assert buckets_for(9 * 256 * MiB) == 16
    assert buckets_for(100 * 10 ** 12) * 256 * MiB >= 100 * 10 ** 12
    for b in (1, 10 ** 6, 10 ** 9, 10 ** 12):
        n = buckets_for(b)
        assert n & (n - 1) == 0
