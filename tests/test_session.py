"""What a task takes at once stays small."""

from tidewright.session import PIECES, TASK_SIZES, tune


def test_tasks_are_kept_small_and_smaller_ones_stay(spark):
    sizes, pieces = list(TASK_SIZES), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {k: spark.conf.get(k) for k in (*sizes, pieces)}
    try:
        spark.conf.set(sizes[0], "128MB")
        spark.conf.set(sizes[1], "1m")
        spark.conf.set(pieces, "8")
        tune(spark)
        assert spark.conf.get(sizes[0]) == str(TASK_SIZES[sizes[0]])
        assert spark.conf.get(sizes[1]) == "1m"
        assert spark.conf.get(pieces) == str(PIECES)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
