"""Sources: JSON lines, polymorphic fields, instruction loaders and job configurations."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import stored

#: Splits of the input whose first positions are sent to every task; more are joined by a shuffle.
MOST_SPLITS = 100_000


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Rows of a JSON-lines file or folder; a malformed line fails the read. Blank lines are skipped; ``strict`` refuses them."""
    if strict:
        blank = F.raise_error(F.lit("a line is blank")).cast("string")
        line = F.when(F.trim("value") == "", blank).otherwise(F.col("value"))
        return spark.read.text(path).select(F.from_json(line, schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``row_id, value``: the lines of text files with their positions from 0, by path and within a file by place.

    Positions don't depend on how the files are split: one pass counts the lines of each split of a file, a row a split,
    and the lines of a split follow on those before it. So equal lines have different numbers, and their order is that of the
    input. Nothing but the counts is shuffled.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    splits = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))
    splits = stored(splits.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift")), "splits")
    known = F.broadcast(splits) if splits.count() <= MOST_SPLITS else splits
    return lines.join(known, ["file", "block"]).select((F.col("at") + F.col("shift")).alias("row_id"), "value")


def read_numbered(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Rows of JSON-lines files behind ``row_id``, their position (:func:`numbered_lines`).

    A malformed line fails the read with its position. Blank lines are skipped, but counted; ``strict`` refuses them.
    """
    lines = numbered_lines(spark, path)
    at = F.concat(F.lit("row "), F.col("row_id").cast("string"))
    blank = F.trim("value") == ""
    if not strict:
        lines = lines.filter(~blank)
    corrupt = "__corrupt"
    row = F.from_json("value", f"{schema}, {corrupt} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    lines = lines.withColumn("r", row)
    wrong = F.when(blank, F.raise_error(F.concat(at, F.lit(" is blank")))).when(F.col(f"r.{corrupt}").isNotNull() | F.col("r").isNull(), F.raise_error(F.concat(at, F.lit(" is no record of the schema"))))
    checked = F.coalesce(wrong.cast("long"), F.col("row_id")).alias("row_id")
    names = [f.name for f in lines.schema["r"].dataType.fields if f.name != corrupt]
    return lines.select(checked, *[F.col("r")[n].alias(n) for n in names])


def read_polymorphic(spark: SparkSession, path: str, schema: str, fields: tuple[str, ...] = ("commit",)) -> DataFrame:
    """Like :func:`read_jsonl`; each of ``fields`` may be a string or an array and is read as an array of strings."""
    rows = spark.read.text(path).filter(F.trim("value") != "")
    v = F.parse_json("value")
    rest = F.from_json("value", schema, {"mode": "FAILFAST"})
    return rows.select(rest.alias("r"), v.alias("v")).select("r.*", *[as_array(F.col("v"), f).alias(f) for f in fields])


def as_array(variant: Column, name: str) -> Column:
    is_array = F.schema_of_variant(F.try_variant_get(variant, f"$.{name}", "variant")).startswith("ARRAY")
    return F.when(is_array, F.try_variant_get(variant, f"$.{name}", "array<string>")).otherwise(F.array(F.try_variant_get(variant, f"$.{name}", "string")))


def joined_commit(c: Column | str) -> Column:
    """Commits of a record as one string."""
    return F.array_join(c, ",")


def edit_prompt_text(before: Column, instruction: Column) -> Column:
    return F.concat(F.lit("## Code Before:\n"), before, F.lit("\n## Instruction:\n"), instruction, F.lit("\n## Code After:\n"))


def load_instructions(df: DataFrame, field_name: str | list[str], data_format: str, commit: str = "commit") -> DataFrame:
    """``instruction, commit`` of records in the ``sharegpt`` or ``general`` layout.

    sharegpt: texts of the user turns of the first field, joined by line ends; a record without one fails. general: two
    fields fill the edit prompt, else the first field is taken as it is. A null commit fails.
    """
    names = [field_name] if isinstance(field_name, str) else list(field_name)
    if data_format == "sharegpt":
        said = F.transform(F.filter(names[0], lambda m: m["role"] == "user"), lambda m: m["content"])
        text = F.when(F.size(said) > 0, F.array_join(said, "\n")).otherwise(F.raise_error(F.lit("a record has no user turn")).cast("string"))
    elif data_format == "general":
        text = edit_prompt_text(F.col(names[0]), F.col(names[1])) if len(names) == 2 else F.col(names[0])
    else:
        raise ValueError(f"unknown data format {data_format!r}")
    known = F.when(F.col(commit).isNotNull(), F.col(commit)).otherwise(F.raise_error(F.lit("a record has no commit")))
    return df.select(text.alias("instruction"), known.alias("commit"))


def user_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The sharegpt loader for turns as rows: texts of the user turns of each conversation, in order."""
    own = turns.filter(F.col(role) == "user").groupBy(conv).agg(F.sort_array(F.collect_list(F.struct(turn, text))).alias("t"))
    return own.select(conv, F.array_join(F.transform("t", lambda t: t[text]), "\n").alias("instruction"))


def remaining(requests: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Requests without a response yet; each once, however often a run was broken off."""
    return requests.join(done.select(*keys).distinct(), keys, "left_anti")


@dataclass(frozen=True)
class FilterConfig:
    jsonl_path: str
    field_name: list[str]
    data_format: str
    random_seed: int | None = None
    max_modify_lines: int = 70
    max_hunk_num: int = 7
    max_samples_total: int | None = 10_000
    max_samples_per_topic: int | None = None
    refit: bool = False

    @classmethod
    def of(cls, d: dict[str, Any]) -> FilterConfig:
        names = d["field_name"]
        known = {k: v for k, v in (d.get("filter_settings") or {}).items() if k in cls.__dataclass_fields__}
        if known.get("max_samples_per_topic") is not None:
            known.setdefault("max_samples_total", None)
        return cls(d["jsonl_path"], [names] if isinstance(names, str) else list(names), d["data_format"], d.get("random_seed"), **known)


@dataclass(frozen=True)
class MixConfig:
    input_files: list[str]
    ratios: list[float]
    instr_types: list[str]
    model_names: list[str | None]
    output_file: str
    total_samples: int
    random_seed: int | None = None
    extra: dict[str, Any] = field(default_factory=dict)

    @classmethod
    def of(cls, d: dict[str, Any]) -> MixConfig:
        names = set(cls.__dataclass_fields__) - {"extra"}
        return cls(**{k: v for k, v in d.items() if k in names}, extra={k: v for k, v in d.items() if k not in names})

    @classmethod
    def preset(cls, styles: list[str], files: list[str], models: list[str], output: str) -> MixConfig:
        """Equal shares of each model and style: 60,000 rows, seed 42."""
        n = len(styles) * len(files)
        return cls([f for _ in styles for f in files], [1 / n] * n, [s for s in styles for _ in files], [m for _ in styles for m in models], output, 60_000, 42)


def read_yaml(text: str) -> dict[str, Any]:
    import yaml

    return yaml.safe_load(text)
