"""Settings from a table, deductions made whole, and runs that are committed once."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cardlens.operators import fusion as U
from cardlens.sources import adapters as A
from cardlens.sources import settings as T
from cardlens.sources.writers import commit_run, read_run, result_rows, summary_row

SF = "/root/testdata/sf0.001"
METRICS = "doc_id long, dimension string, name string, ord long, score double, weight double, confidence double, status string"
DEDUCTIONS = "doc_id long, ord long, code string, severity string, delta double, evidence string, magnitude double, hint string"


@pytest.fixture(scope="module")
def facts(spark):
    return A.metric_facts(spark, SF), A.deduction_facts(spark, SF)


def test_unknown_settings_are_reported_and_have_no_effect(spark):
    rows = [("dimension", "layout", "weight", "2"), ("dimension", "layout", "wieght", "3"), ("colour", "x", "y", "z"), ("grade", None, "minimum", "3"), ("cap", "c", "base", "lots"), ("cap", "c", "base", "NaN"), (None, None, None, None), ("template", "c", "reason", None)]
    table = spark.createDataFrame(rows, T.SCHEMA).withColumn("reason", F.lit("mine"))
    got = {(r.kind, r.key, r.value): r.reason for r in T.unknown_settings(table.drop("reason")).collect()}
    assert got == {("dimension", "wieght", "3"): "unknown key", ("colour", "y", "z"): "unknown kind", ("grade", "minimum", "3"): "no name", ("cap", "base", "lots"): "no number", ("cap", "base", "NaN"): "no number", (None, None, None): "unknown kind", ("template", "reason", None): "no value"}
    s = T.settings_of(table)
    assert s.dimensions == {"layout": 2.0} and s.caps == T.DEFAULTS.caps and s.grades is None and s.templates == {}
    assert T.settings_of(spark.createDataFrame([], T.SCHEMA)) == T.DEFAULTS


def test_another_file_changes_scores_without_a_change_of_code(spark, facts, tmp_path):
    metrics, deductions = facts
    before = {r.doc_id: r for r in U.capped_overall(metrics, deductions).collect()}
    rows = [{"kind": "calibration", "name": "all", "key": "a", "value": "0"}, {"kind": "calibration", "key": "b", "value": "71"}, {"kind": "grade", "name": "top", "key": "minimum", "value": "71"}, {"kind": "cap", "name": "layout.overlap", "key": "base", "value": "0"}]
    (tmp_path / "s.json").write_text("\n".join(map(json.dumps, rows)))
    s = T.settings_of(T.read_settings(spark, str(tmp_path / "s.json")))
    assert s.calibration == (0.0, 71.0)
    after = {r.doc_id: r for r in U.capped_overall(metrics, deductions, s).collect()}
    assert {r.calibrated for r in after.values()} == {71.0} and {r.grade for r in after.values()} == {"top"}
    assert before.keys() == after.keys() and any(r.effective is None or r.effective >= 40 for r in after.values())


def test_weights_of_metrics(spark):
    rows = [(1, "geometry", "padding", 1, 100.0, 1.0, 1.0, "ok"), (1, "geometry", "grid", 2, 0.0, 1.0, 1.0, "ok"), (1, None, None, 3, 5.0, 7.0, 1.0, "ok")]
    s = T.settings_of(spark.createDataFrame([("metric", "geometry.padding", "weight", "3")], T.SCHEMA))
    out = s.weighted(spark.createDataFrame(rows, METRICS))
    assert [r.weight for r in out.orderBy("ord").collect()] == [3.0, 1.0, 7.0]
    assert U.dimension_scores(out, s).filter("dimension = 'geometry'").first().score == 75.0


def test_enriched(spark):
    s = T.settings_of(spark.createDataFrame([("template", "a.b", "reason", "R"), ("template", "a.b", "prompt_hint", "P")], T.SCHEMA))
    names = "id long, dimension string, metric string, code string, source string, severity string, delta double, reason string, evidence string, fix_hint string, prompt_hint string, magnitude double"
    rows = [(1, "a", "b", None, None, None, None, None, None, None, None, None), (2, "a", "b", "x.y", "s", "high", -2.0, "", "e", "f", "", 0.5), (3, "a", "b", "", "", "", 1.0, "own", None, None, "mine", None)]
    got = [tuple(r)[3:] for r in U.enriched(spark.createDataFrame(rows, names), s).orderBy("id").collect()]
    assert got == [("a.b", "a", "low", 0.0, "R", "", "", "P", None), ("x.y", "s", "high", -2.0, "x.y", "e", "f", "", 0.5), ("a.b", "a", "low", 1.0, "own", "", "", "mine", None)]


def test_a_run_is_written_once(spark, facts, tmp_path):
    metrics, deductions = facts
    results, path = result_rows(metrics, deductions), str(tmp_path / "runs")
    wanted = spark.range(-2, 0).withColumnRenamed("id", "doc_id").unionByName(results.select("doc_id"))
    folder = commit_run(results, path, "a", wanted)
    files = lambda: sorted((p, os.path.getmtime(os.path.join(p, f)), f) for p, _, fs in os.walk(path) for f in fs)
    first = files()
    assert commit_run(results.limit(1), path, "a", wanted) == folder and files() == first
    assert sorted(os.listdir(path)) == ["run=a"]
    back = spark.read.schema(results.schema).json(f"{folder}/results")
    assert sorted(back.collect()) == sorted(results.collect())
    line = read_run(spark, path, "a", "summary").first()
    rows = results.collect()
    assert (line.docs, line.missing, line.high) == (len(rows), 2, sum(d.severity == "high" for r in rows for d in r.deductions))
    assert {k: v for k, v in line.grades.asDict().items()} == {g: sum(r.grade == g for r in rows) for g in {r.grade for r in rows}}


def test_a_failed_run_leaves_nothing(spark, facts, tmp_path):
    bad = result_rows(*facts).withColumn("overall", F.when(F.col("doc_id") >= 0, F.raise_error(F.lit("lost"))).cast("double"))
    with pytest.raises(Exception, match="lost"):
        commit_run(bad, str(tmp_path / "runs"), "b")
    assert not os.path.exists(tmp_path / "runs") or os.listdir(tmp_path / "runs") == []
    commit_run(result_rows(*facts), str(tmp_path / "runs"), "b")
    assert os.listdir(tmp_path / "runs") == ["run=b"]


def test_empty_tables(spark, tmp_path):
    none = result_rows(spark.createDataFrame([], METRICS), spark.createDataFrame([], DEDUCTIONS))
    line = summary_row(none).first()
    assert (line.docs, line.high, line.missing, line.mean, line.grades) == (0, 0, 0, None, {})
    commit_run(none, str(tmp_path), "e")
    assert spark.read.schema(none.schema).json(f"{tmp_path}/run=e/results").count() == 0
