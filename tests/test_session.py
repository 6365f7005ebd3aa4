import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from assaylake.session import SHUFFLE_CLEANUP, materialize, shuffles_dropped


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_written_step_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    written = materialize(spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n")))
    assert not shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert written.agg(F.sum("n")).first()[0] == 499_500


def test_written_steps_are_packed(spark):
    path = materialize(spark.range(1000), "packed").inputFiles()[0].removeprefix("file:")
    assert pq.ParquetFile(path).metadata.row_group(0).column(0).compression == "ZSTD"


def test_shuffles_dropped_puts_the_setting_back(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP)
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(SHUFFLE_CLEANUP) == before
