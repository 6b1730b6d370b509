"""Jobs from file to file, told by YAML configurations; each returns the path that it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators.balance import in_input_order
from ..operators.finetune import format_records
from ..operators.mix import sample_and_mix
from ..sources.jsonl import FilterConfig, MixConfig, read_jsonl, read_numbered, read_yaml
from ..sources.sinks import dt_filtered_path, write_jsonl
from .pipelines import dt_filter, extract_triplets


def _text(spark: SparkSession, path: str) -> str:
    """A small file, read by Spark, so that it may be in any store."""
    return spark.read.text(path, wholetext=True).first()[0]


def run_extraction(spark: SparkSession, path: str, output: str, quarantine: str | None = None) -> str:
    """Responses to triplets; rejected responses with their reasons to ``quarantine``."""
    good, bad = extract_triplets(read_jsonl(spark, path, schemas.RESPONSES))
    write_jsonl(good, output)
    if quarantine:
        write_jsonl(bad, quarantine)
    return output


def run_mix(spark: SparkSession, config_path: str) -> str:
    """Triplet files to one file of mixed records, as :class:`MixConfig` says."""
    c = MixConfig.of(read_yaml(_text(spark, config_path)))
    read = {p: read_numbered(spark, p, schemas.TRIPLETS, strict=True) for p in dict.fromkeys(c.input_files)}
    names = [f"{p}:{k}" for k, p in enumerate(c.input_files)]
    mixed = sample_and_mix([read[p] for p in c.input_files], c.instr_types, c.model_names, c.ratios, c.total_samples, c.random_seed or 0, "row_id", names)
    write_jsonl(mixed, c.output_file)
    return c.output_file


def run_filter(spark: SparkSession, config_path: str, cache: str | None = None, **options) -> str:
    """Mixed records through the diff and topic filter, as :class:`FilterConfig` says, to a file beside the input, in
    the order of the input."""
    c = FilterConfig.of(read_yaml(_text(spark, config_path)))
    rows = read_numbered(spark, c.jsonl_path, schemas.MIXED)
    out = dt_filtered_path(c.jsonl_path)
    write_jsonl(in_input_order(dt_filter(rows, c, "row_id", cache, **options), "row_id").drop("row_id"), out)
    return out


def run_format(spark: SparkSession, path: str, output: str, layout: str = "share_gpt", **options) -> str:
    """Mixed records to fine-tuning records."""
    write_jsonl(format_records(read_jsonl(spark, path, schemas.MIXED), layout, **options), output)
    return output
