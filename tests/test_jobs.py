"""The two jobs: growing input, broken runs, reruns, odd rows, and the command line."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobs import build_training_set, ingest_seeds
from jobs.queries import QUERIES

ROOT = Path(__file__).resolve().parent.parent
SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def text(i, lines=12):
    return "\n".join(f"line {k} of {i}" for k in range(lines))


@pytest.fixture()
def grown(spark, tmp_path):
    """Adds a file of documents to a folder."""

    def add(*rows):
        spark.createDataFrame(rows, DOCS).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")

    return add, f"file://{tmp_path}/in", f"file://{tmp_path}/out", f"file://{tmp_path}/mark"


def test_only_new_files_are_taken(spark, grown):
    add, documents, out, mark = grown
    run = lambda: ingest_seeds.run(spark, documents, out, mark)
    add((1, text("a"), "en", "s"), (2, text("b"), None, "s"), (3, "short", "en", "s"), (4, None, "en", "s"), (1, text("a"), "en", "s"))
    first = run()
    assert [(r["read"], r["too_short"], r["repeated"], r["kept"], r["batch"]) for r in first] == [(5, 2, 1, 2, 0)]
    before = rows_of(ingest_seeds.read_seeds(spark, out))
    assert run() == [] and rows_of(ingest_seeds.read_seeds(spark, out)) == before
    # The least id of an equal snippet stays within a batch, the earlier one between batches.
    same = ingest_seeds.read_seeds(spark, out).filter("doc_id = 1").first().snippet
    add((0, same, "en", "s"), (5, text("c", 5), "", "s"), (6, text("c", 5), "de", None), (None, text("d"), "fr", "s"))
    second = run()
    assert [(r["read"], r["kept"], r["batch"]) for r in second] in ([(4, 2, 1)], [(4, 3, 1)])  # a part of that snippet may be drawn
    after = rows_of(ingest_seeds.read_seeds(spark, out))
    assert [r for r in after if r[6] == 0] == before
    new = {r[0]: (r[1], r[7]) for r in after if r[6] == 1 and r[0] != 0}
    assert new == {5: ("", "und"), None: ("fr", "fr")}
    assert {r[7] for r in before} == {"en", "und"}


def test_whole_table_at_once_or_by_files(spark, grown):
    """The seeds of documents that share none are the same, however the files came."""
    add, documents, out, mark = grown
    docs = [(i, text(i), "en", "s") for i in range(40)]
    for k in range(4):
        add(*docs[k * 10 : k * 10 + 10])
    assert len(ingest_seeds.run(spark, documents, out, mark, files_per_batch=1)) == 4
    want = ingest_seeds.cut_seeds(spark.createDataFrame(docs, DOCS), 5, 15, 42)
    got = ingest_seeds.read_seeds(spark, out)
    assert rows_of(got.select(want.columns)) == rows_of(want)


def test_a_broken_batch_is_made_again(spark, grown, monkeypatch):
    add, documents, out, mark = grown
    add(*[(i, text(i), "en", "s") for i in range(5)])
    calls, read = [], ingest_seeds.read_seeds

    def breaks(session, output):
        calls.append(1)
        if len(calls) == 2:  # the seeds are written, the report isn't
            raise RuntimeError("lost")
        return read(session, output)

    monkeypatch.setattr(ingest_seeds, "read_seeds", breaks)
    with pytest.raises(Exception, match="lost"):
        ingest_seeds.run(spark, documents, out, mark)
    monkeypatch.undo()
    add((9, text(9), "de", "s"))
    report = ingest_seeds.run(spark, documents, out, mark)
    assert [(r["read"], r["kept"]) for r in report] == [(5, 5), (1, 1)]
    assert sorted(r.doc_id for r in read(spark, out).collect()) == [0, 1, 2, 3, 4, 9]


def test_an_empty_input_gives_empty_tables(spark, grown):
    add, documents, out, mark = grown
    spark.createDataFrame([], DOCS).write.parquet(documents)
    ingest_seeds.run(spark, documents, out, mark)
    assert read_all(spark, out) == []


def read_all(spark, out):
    return ingest_seeds.read_seeds(spark, out).collect()


def test_training_set(spark, tmp_path):
    docs = [(i, text(i, 60), ["en", "en", "en", "de", None, ""][i % 6], "s") for i in range(120)] + [(500, None, "en", "s"), (None, text(1), "en", "s"), (7, text(7, 60), "en", "s"), (501, "one line", "fr", "s")]
    labels = [(i, 0, 0) for i in range(0, 20)] + [(20, 1, 1), (21, 1, 0), (None, 0, 0), (3, None, None)]
    at = f"file://{tmp_path}"
    spark.createDataFrame(docs, DOCS).write.parquet(f"{at}/docs")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels")
    run = lambda **o: build_training_set.run(spark, f"{at}/docs", f"{at}/labels", f"{at}/out", total=30, **o)
    report = {r["language"]: r for r in run()}
    got = rows_of(build_training_set.read_records(spark, f"{at}/out"))
    assert {r["language"]: r["records"] for r in report.values()} == {"en": 10, "de": 10, "und": 10, "fr": 0} and len(got) == 30
    ids = {r[0] for r in got}
    assert len(ids) == 30 and not ids & {*range(0, 21), 500, None}
    for r in build_training_set.read_records(spark, f"{at}/out").collect():
        full, cut = r.new_code.split("\n"), r.old_code.split("\n")
        assert full == text(r.doc_id, 60).split("\n") and [x for x in full if x in cut] == cut and 0 < len(full) - len(cut) <= 70
        assert r.messages[1].content.count("Restore") == 1 and full[0] in r.messages[2].content
    run()
    assert rows_of(build_training_set.read_records(spark, f"{at}/out")) == got
    # No language of an earlier run is left over, and the other layout has its own columns.
    spark.createDataFrame([d for d in docs if d[2] == "de"], DOCS).write.mode("overwrite").parquet(f"{at}/docs")
    run(layout="alpaca", max_lines=1)
    again = build_training_set.read_records(spark, f"{at}/out", "alpaca")
    assert {r.language for r in again.collect()} <= {"de"} and "instruction" in again.columns
    spark.createDataFrame([], DOCS).write.mode("overwrite").parquet(f"{at}/docs")
    assert run() == [] and read_count(spark, f"{at}/out") == 0


def read_count(spark, out):
    return build_training_set.read_records(spark, out).count()


def test_registered_jobs_leave_their_files_and_settings(spark):
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for name, query in QUERIES.items():
        one, two = query(spark, SMALL), query(spark, SMALL)
        assert one.count() and rows_of(one) == rows_of(two), name
        assert not set(one.inputFiles()) & set(two.inputFiles())
    assert before == (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.sources.partitionOverwriteMode"))


def test_command_line(tmp_path):
    config = json.loads((ROOT / "jobs/ingest_seeds.json").read_text())
    (tmp_path / "job.json").write_text(json.dumps(config | {"documents": f"{SMALL}/documents.parquet", "output": f"{tmp_path}/out", "checkpoint": f"{tmp_path}/mark"}))
    env = os.environ | {"PYTHONPATH": str(ROOT), "PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell"}
    said = subprocess.run([sys.executable, "-m", "jobs.ingest_seeds", "--config", str(tmp_path / "job.json"), "--output", f"{tmp_path}/other"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr[-2000:]
    assert "read=200" in said.stderr and list(tmp_path.glob("other/seeds/batch=0/language=*/*.parquet")) and not (tmp_path / "out").exists()


def test_configurations_name_the_parameters():
    import inspect

    for job in (ingest_seeds, build_training_set):
        config = json.loads((ROOT / f"jobs/{job.__name__.split('.')[-1]}.json").read_text())
        names = inspect.signature(job.run).parameters
        assert set(config) <= set(names) and all(p.default is not inspect.Parameter.empty or n in config for n, p in names.items() if n != "spark")


def test_pattern_of_one_path():
    assert ingest_seeds.files("s3://b/x.parquet") == "s3://b/x.parque[t]" and ingest_seeds.files("/a/b/") == "/a/[b]" and ingest_seeds.files("/a/*.parquet") == "/a/*.parquet"
