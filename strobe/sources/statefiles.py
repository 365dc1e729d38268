"""Saved-state files as ordered lines: (file, line_no, line).

Files are read as text in splits, so a large one is read by several tasks; the
place of a split in its file and the order of the lines in a task give the line
numbers, with an ordered scan that no large file goes through whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strobe.operators.ordering import position_within


def read_state_files(spark: SparkSession, path: str) -> DataFrame:
    """Lines end with a newline; the last one may do without."""
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"),
    )
    return position_within(raw, ["file"], ["split", "row"], out="line_no").select("file", "line_no", "line")


def write_state_files(lines: DataFrame, keys: list[str], path: str) -> None:
    """Write ordered state lines back as text, one file per snapshot key.

    Lines are grouped per snapshot (one device's configuration, bounded) and
    joined in ``line_no`` order into one text value per file."""
    whole = lines.groupBy(*keys).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n"
        ).alias("value")
    )
    # the text writer ends each value with a newline, as a save file ends
    whole.select(*keys, "value").write.mode("overwrite").partitionBy(*keys).text(path)
