"""The row-local stages on streams: the batch functions serve as they are; what needs a whole table stays batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ..operators.extract import filter_single_line, purify, separate_sections
from ..operators.finetune import format_records
from ..operators.stats import filter_by_diff


def read_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def triplets(responses: DataFrame) -> DataFrame:
    rows = separate_sections(responses)
    return purify(filter_single_line(rows.filter("reason is null").drop("reason")))


def small_edits(mixed: DataFrame, max_modify_lines: int = 70, max_hunk_num: int = 7) -> DataFrame:
    return filter_by_diff(mixed, max_modify_lines=max_modify_lines, max_hunk_num=max_hunk_num)


def records(mixed: DataFrame, layout: str = "share_gpt", **options) -> DataFrame:
    return format_records(mixed, layout, **options)


def to_jsonl(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Appends each row once: the file sink's log and the checkpoint see to that when a query is started again."""
    return stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
