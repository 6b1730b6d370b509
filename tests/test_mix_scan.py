"""A mix makes the rows that it draws, and no others, once the keys are known."""

import re

from pyspark.sql import functions as F

from spindle.operators import mix


def test_rows_that_are_not_drawn_are_sorted_out_below_generators(spark):
    """No join passes a generator, so each source made all its rows for every read of the sample."""
    base = spark.range(200).select(F.col("id").alias("row_id"), F.lit("c").alias("commit"), F.array(F.lit("s")).alias("code_snippet"))
    fields = ("code_before_purify", "code_after_purify", "instruct_descriptive_purify", "instruct_lazy_purify")
    df = base.select("*", F.inline(F.array(F.struct(*[F.concat(F.lit("t"), F.col("row_id")).alias(f) for f in fields]))))
    got = mix.sample_and_mix([df, df], ["lazy", "descriptive"], [None, None], [0.5, 0.5], 20, 7, names=["a", "b"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("Generate inline")[1:]
    assert len(below) == 2 and all(re.search(r"Filter .*md5\(", x) for x in below)
    rank = lambda name, i: F.md5(F.concat_ws(":", F.lit("7"), F.lit(name), F.lit(str(i))))
    ranks = spark.range(1).select(*[rank(name, i).alias(f"{name}{i}") for name in "ab" for i in range(200)]).first()
    want = sorted(f"t{i}" for name in "ab" for i in sorted(range(200), key=lambda i: ranks[f"{name}{i}"])[:10])
    assert sorted(r.instruct_purify for r in got.collect()) == want
    assert mix.sample_and_mix([df, df], ["lazy", "lazy"], [None, None], [1.0, 0.0], 20, 7).count() == 20
