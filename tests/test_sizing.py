"""Partition counts follow the data."""

from __future__ import annotations

from hypnolith.plans.mart import RAW_BYTES_PER_BUCKET, epoch_partitions
from hypnolith.schemas import EPOCHS
from hypnolith.sources.storage import MOST_BUCKETS, write_epochs


def test_epoch_partitions(spark):
    assert epoch_partitions(spark, 1000) == 4
    assert epoch_partitions(spark, 1 << 30) == 256
    for raw_bytes in (1 << 30, 1 << 40, 100 * (1 << 40)):
        assert raw_bytes / epoch_partitions(spark, raw_bytes) == RAW_BYTES_PER_BUCKET


def test_buckets_beyond_the_default_limit(spark, tmp_path):
    default = spark.conf.get(MOST_BUCKETS)
    spark.conf.set(MOST_BUCKETS, "3")
    try:
        epochs = spark.createDataFrame([(1, 0, 0, 30, "W"), (2, 0, 0, 30, "N1")], EPOCHS)
        assert write_epochs(epochs, str(tmp_path / "epochs"), buckets=5).count() == 2
    finally:
        spark.conf.set(MOST_BUCKETS, default)
