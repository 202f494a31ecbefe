"""Tasks of partitioned writes stay small however many rows one partition value has."""

import pytest
from pyspark.sql import functions as F

from larder.sources import land_by_partition, write_arrivals
from larder.sources.published import write_parts
from larder.sources.settings import ADVISORY_SIZE, setting, size_in_bytes
from larder.streaming import stream_files, stream_to_partitions

ROWS = 400_000


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Rows of one day, less than Spark's own 64 MB and far more than 16 MB when shuffled."""
    path = str(tmp_path_factory.mktemp("hot") / "in")
    rows = spark.range(0, ROWS, numPartitions=16).withColumn("day", F.lit("2024-01-10"))
    rows.withColumn("text", F.sha2(F.col("id").cast("string"), 512)).write.parquet(path)
    return path


def to_partitions(spark, hot, folder):
    schema = spark.read.parquet(hot).schema
    stream = stream_files(spark, hot, schema, "parquet")
    stream_to_partitions(stream, f"{folder}/landed", f"{folder}/progress", ["day"])
    return f"{folder}/landed"


def landing(spark, hot, folder):
    land_by_partition(spark.read.parquet(hot), f"{folder}/landed", ["day"])
    return f"{folder}/landed"


def parts(spark, hot, folder):
    made = write_parts(spark.read.parquet(hot), folder, "1", F.col("day"))
    return f"{folder}/{made['2024-01-10']}"


def arrivals(spark, hot, folder):
    write_arrivals(spark.read.parquet(hot), f"{folder}/landed", "day", "parquet")
    return f"{folder}/landed/2024/01/10"


def rows_by_file(spark, path):
    read = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.count("id").alias("n"))
    return [r["n"] for r in read.collect()]


@pytest.mark.parametrize("write", [to_partitions, landing, parts, arrivals])
def test_hot_value_is_cut_into_small_tasks(spark, hot, tmp_path, write):
    before = spark.conf.get(ADVISORY_SIZE)
    path = write(spark, hot, str(tmp_path))
    counts = rows_by_file(spark, path)
    assert sum(counts) == spark.read.parquet(path).select("id").distinct().count() == ROWS
    assert len(counts) > 1
    assert max(counts) <= ROWS / 2
    assert spark.conf.get(ADVISORY_SIZE) == before


def test_smaller_size_of_the_session_holds(spark, hot, tmp_path):
    with setting(spark, ADVISORY_SIZE, "4m"):
        counts = rows_by_file(spark, to_partitions(spark, hot, str(tmp_path)))
        assert spark.conf.get(ADVISORY_SIZE) == "4m"
    assert max(counts) <= ROWS / 8


def test_setting_is_put_back_after_an_error(spark):
    before = spark.conf.get(ADVISORY_SIZE)
    with pytest.raises(RuntimeError), setting(spark, ADVISORY_SIZE, "1m"):
        assert spark.conf.get(ADVISORY_SIZE) == "1m"
        raise RuntimeError
    assert spark.conf.get(ADVISORY_SIZE) == before


@pytest.mark.parametrize(
    "text, size",
    [("64MB", 64 << 20), ("16m", 16 << 20), ("67108864b", 64 << 20), ("1024", 1024), ("8 k", 8192), ("1g", 1 << 30)],
)
def test_sizes_as_settings_give_them(text, size):
    assert size_in_bytes(text) == size
