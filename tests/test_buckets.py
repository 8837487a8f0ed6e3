"""Buckets stay small enough to be sorted by one task."""

from tidewright.sources.bucketed import buckets_for


def test_buckets_stay_small(spark, tmp_path):
    with open(tmp_path / "rows.parquet", "wb") as f:
        f.truncate(160 << 20)
    assert buckets_for(spark, f"file://{tmp_path}") == 10
