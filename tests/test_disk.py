"""Shuffle files do not outlive the job that wrote them."""

import glob
import os
import tempfile
import time

from pyspark.sql import functions as F

from kinomill.session import apply_conf


def _shuffle_files(spark):
    roots = {os.environ.get("SPARK_LOCAL_DIRS", ""), spark.conf.get("spark.local.dir", ""), tempfile.gettempdir()} - {""}
    return {f for r in roots for pattern in ("blockmgr-*", "spark-*/blockmgr-*") for f in glob.glob(f"{r}/{pattern}/*/shuffle_*.data")}


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    apply_conf(spark)
    before = _shuffle_files(spark)
    spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).count().write.parquet(str(tmp_path / "counted"))
    end = time.time() + 15
    while (left := _shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
