"""Compositions: each is one lazy plan from DataFrame to DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.code_tokens import topic_tokens
from ..operators.balance import balance_by_group
from ..operators.extract import filter_single_line, purify, separate_sections
from ..operators.finetune import format_records
from ..operators.hdp import HdpModel
from ..operators.mix import in_sample
from ..operators.stats import count_pairs, filter_by_diff, top_groups, top_pairs, verb_objects
from ..operators.topics import cached_fit
from ..sources.jsonl import FilterConfig, edit_prompt_text
from ..sources.sinks import split_rejected
from ..sources.store import stored

__all__ = ["dt_filter", "extract_triplets", "format_records", "group_balanced", "topic_report", "topic_sample", "verb_object_report"]


def extract_triplets(responses: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Triplets and the quarantine of responses without marks or with empty sections."""
    good, bad = split_rejected(separate_sections(responses))
    return purify(filter_single_line(good), **options), bad


def group_balanced(df: DataFrame, group: str, row_id: str, config: FilterConfig, old: str = "code_before_purify", new: str = "code_after_purify") -> DataFrame:
    """The diff filter, then a sample balanced by any column. Only ids and groups of what the filter leaves are stored."""
    small = stored(filter_by_diff(df, old, new, config.max_modify_lines, config.max_hunk_num).select(row_id, group), "small")
    drawn = stored(balance_by_group(small, group, row_id, config.max_samples_total, config.max_samples_per_topic, config.random_seed or 0), "drawn")
    return in_sample(df, drawn.select(row_id), drawn.count(), row_id)


def dt_filter(mixed: DataFrame, config: FilterConfig, row_id: str, cache: str | None = None, **options) -> DataFrame:
    """The diff filter, then a sample balanced by the topics of a model fitted on what is left.

    Ids and tokens of what the filter leaves are stored, and then topics by id; only drawn rows are read in full.
    """
    small = filter_by_diff(mixed, max_modify_lines=config.max_modify_lines, max_hunk_num=config.max_hunk_num)
    text = edit_prompt_text(F.coalesce("code_before_purify", F.lit("")), F.coalesce("instruct_purify", F.lit("")))
    held = stored(small.select(row_id, topic_tokens(text).alias("__tokens")), "tokens")
    seed = config.random_seed or 0
    model = cached_fit(held, cache, "__tokens", refit=config.refit, seed=seed, kind=HdpModel, **options) if cache else HdpModel.fit(held, "__tokens", seed=seed, **options)
    topics = stored(model.assign(held, "__tokens", "__topic", row_id).select(row_id, "__topic"), "topics")
    drawn = stored(topic_sample(topics, "__topic", row_id, config).select(row_id), "drawn")
    return in_sample(mixed, drawn, drawn.count(), row_id)


def topic_sample(topics: DataFrame, topic: str, row_id: str, config: FilterConfig) -> DataFrame:
    """The balance over topics that :func:`dt_filter` ends with; rows of topic -1, without tokens, are a group like any."""
    return balance_by_group(topics, topic, row_id, config.max_samples_total, config.max_samples_per_topic, config.random_seed or 0)


def topic_report(df: DataFrame, row_id: str, tokens: str = "tokens", **options) -> tuple[DataFrame, DataFrame]:
    """The twenty largest topics, and the words of each topic."""
    held = stored(df.select(row_id, tokens), "tokens")
    model = HdpModel.fit(held, tokens, **options)
    return top_groups(model.assign(held, tokens, key=row_id), "topic", row_id), model.describe()


def verb_object_report(df: DataFrame, text: str, verbs: int = 20, objects: int = 10, drop_other: bool = True) -> DataFrame:
    counts = stored(count_pairs(verb_objects(df, text)), "pairs")  # read twice
    return top_pairs(counts, verbs, objects, drop_other)
