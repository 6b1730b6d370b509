"""Sinks: JSON lines, appended statistics, and derived names."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame


def write_jsonl(df: DataFrame, path: str, append: bool = False, ascii_only: bool = False) -> None:
    """A folder of JSON-lines files in plain UTF-8, or with escapes for all that isn't ASCII. A DataFrame that is ordered is
    written in its order, part file by part file."""
    df.write.option("writeNonAsciiCharacterAsCodePoint", ascii_only).mode("append" if append else "overwrite").option("ignoreNullFields", True).json(path)


def append_statistics(df: DataFrame, path: str) -> None:
    """Rows appended to a CSV folder; every part file has the header."""
    df.write.mode("append").option("header", True).csv(path)


def split_rejected(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Rows without a reason to reject them, and the quarantine: the others with theirs."""
    return df.filter(df[reason].isNull()).drop(reason), df.filter(df[reason].isNotNull())


def _beside(path: str, suffix: str) -> str:
    p = PurePosixPath(path)
    return str(p.with_name(f"{p.stem}_{suffix}{p.suffix or '.jsonl'}"))


def diff_filtered_path(path: str) -> str:
    return _beside(path, "diff_filtered")


def dt_filtered_path(path: str) -> str:
    return _beside(path, "dt_filtered")


def topic_sampled_path(path: str, total: int | None = None, per_topic: int | None = None) -> str:
    return _beside(path, f"topic_sampled_total_{total}" if total is not None else f"topic_sampled_topic_{per_topic}")
