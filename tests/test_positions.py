"""JSON lines with positions: any split of the files, equal rows, order, and lines that are no records."""

import json
from collections import Counter

import pytest

from spindle import schemas
from spindle.plans import jobs
from spindle.sources import jsonl


def lines_of(n):
    return [f"{k} " + "x" * (k * 37 % 200) for k in range(n)]


@pytest.mark.parametrize("size", ["128m", "4k", "700"])
def test_positions_do_not_depend_on_splits(spark, tmp_path, size):
    want = lines_of(600)
    for name, part in (("b.txt", want[250:]), ("a.txt", want[:100]), ("a2.txt", want[100:250])):
        (tmp_path / name).write_text("\n".join(part) + ("\n" if name != "b.txt" else ""))
    (tmp_path / "empty.txt").write_text("")
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        got = jsonl.numbered_lines(spark, f"file://{tmp_path}")
        parts = got.rdd.getNumPartitions()
        rows = {r.row_id: r.value for r in got.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)
    assert rows == dict(enumerate(want)) and (parts > 10 or size != "700")


def test_lines_that_are_no_records(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"commit": "a"}\n\n{"commit": "b", "more": 1}\n')
    (tmp_path / "bad.jsonl").write_text('{"commit": "a"}\n{"commit": }\n')
    at = f"file://{tmp_path}"
    assert [tuple(r) for r in jsonl.read_numbered(spark, f"{at}/x.jsonl", "commit string").collect()] == [(0, "a"), (2, "b")]
    with pytest.raises(Exception, match="row 1 is blank"):
        jsonl.read_numbered(spark, f"{at}/x.jsonl", "commit string", strict=True).collect()
    with pytest.raises(Exception, match="row 1 is no record"):
        jsonl.read_numbered(spark, f"{at}/bad.jsonl", "commit string").collect()


def test_files_of_equal_rows(spark, tmp_path):
    """9,000 equal rows among 9,100: sampled, mixed and filtered like any, and in the order of the input."""
    code = lambda k: f"x = {k}\ny = 1"
    row = lambda k: {"commit": f"c{k}", "code_snippet": ["s"], "code_before_purify": code(k), "code_after_purify": f"{code(k)}\nz = 2", "instruct_descriptive_purify": f"add z {k}", "instruct_lazy_purify": "z"}
    rows = [row(0 if k % 91 else k) for k in range(9100)]
    (tmp_path / "t.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    at = f"file://{tmp_path}"
    mix = {"input_files": [f"{at}/t.jsonl"], "ratios": [1.0], "instr_types": ["descriptive"], "model_names": ["m"], "output_file": f"{at}/mixed", "total_samples": 500, "random_seed": 42}
    (tmp_path / "mix.yaml").write_text(json.dumps(mix))
    taken = lambda path: Counter(r.commit for r in jsonl.read_jsonl(spark, path, schemas.MIXED).collect())
    got = taken(jobs.run_mix(spark, f"{at}/mix.yaml"))
    assert sum(got.values()) == 500 and 480 <= got["c0"] < 500
    assert taken(jobs.run_mix(spark, f"{at}/mix.yaml")) == got
    mixed = [{k: v for k, v in r.items() if not k.startswith("instruct")} | {"instruct_purify": r["instruct_descriptive_purify"], "instr_type": "m", "code_before_purify": f"n = {k}\n{r['code_before_purify']}"} for k, r in enumerate(rows[:3000])]
    (tmp_path / "m.jsonl").write_text("".join(json.dumps(r) + "\n" for r in mixed))
    settings = {"jsonl_path": f"{at}/m.jsonl", "field_name": ["code_before_purify", "instruct_purify"], "data_format": "general", "random_seed": 42, "filter_settings": {"max_samples_total": 200}}
    (tmp_path / "filter.yaml").write_text(json.dumps(settings))
    out = jsonl.numbered_lines(spark, jobs.run_filter(spark, f"{at}/filter.yaml", k=2, iterations=2)).orderBy("row_id").collect()
    places = [int(json.loads(r.value)["code_before_purify"].split("\n")[0][4:]) for r in out]
    assert len(places) == 200 and places == sorted(set(places))
