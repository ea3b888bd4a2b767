import json
import sys

import pytest

from lakemill.operators.materialize import Kept, configure_arrow, new_run_id, resolve_mode
from lakemill.sources import bronze, lexicons, names, sinks

LINE = '{"review_id":"%s","user_id":"u","business_id":"b","stars":4,"useful":1,"funny":0,"cool":0,"text":"t","date":"2020-01-02 03:04:05","odd":1}\n'


def test_convert_once(spark, tmp_path):
    src, out = tmp_path / "review.json", str(tmp_path / "review")
    src.write_text(LINE % "a" + LINE % "b")
    data = bronze.DATASETS["review"]
    assert sinks.convert(spark, data, str(src), out, 2) == "converted" and sinks.convert(spark, data, str(src), out, 2) == "skipped"
    got = bronze.read_bronze(spark, "review", str(tmp_path))
    row = got.first()
    assert got.count() == 2 and row.stars == 4.0 and "odd" not in got.columns
    assert row._source_file.endswith(".parquet") and "/review/" in row._source_file and row._ingested_at
    (tmp_path / "review" / "_SUCCESS").unlink()
    with pytest.raises(RuntimeError):
        sinks.convert(spark, data, str(src), out, 2)
    assert sinks.convert(spark, data, str(src), out, 2, overwrite=True) == "converted"
    with pytest.raises(ValueError):
        sinks.convert(spark, data, str(src), out, 0)


def test_bad_line_aborts(spark, tmp_path):
    (tmp_path / "x.json").write_text(LINE % "a" + "{broken\n")
    with pytest.raises(Exception):
        bronze.read_json(spark, bronze.DATASETS["review"].schema, str(tmp_path / "x.json")).collect()


def test_find_one_and_staging(spark, tmp_path):
    for d in ("a", "b"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "twice.tsv").write_text("x")
    (tmp_path / "b" / "once.tsv").write_text("body")
    assert bronze.find_one(spark, str(tmp_path), "once.tsv").endswith("once.tsv")
    for name in ("twice.tsv", "none.tsv"):
        with pytest.raises(ValueError):
            bronze.find_one(spark, str(tmp_path), name)
    with bronze.staged(spark, str(tmp_path), ["once.tsv"]) as got:
        path = got["once.tsv"]
        assert open(path).read() == "body"
    with pytest.raises(FileNotFoundError):
        open(path)


def test_names_and_paths():
    assert names.table_name("a", "b_1") == "`a`.`b_1`" and names.quote_table("c.s.t") == "`c`.`s`.`t`"
    for bad in ("a; DROP", "", "1a", "a-b", "é"):
        with pytest.raises(ValueError):
            names.identifier(bad)
    assert names.join_path("s3://bucket/x/", "/y", "z") == "s3://bucket/x/y/z" and names.join_path("/a", "b") == "/a/b"


def test_tables_audit_and_log(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    sinks.ensure_schema(spark, "lm_test")
    sinks.save_external(df, str(tmp_path / "t"), "lm_test.t")
    with pytest.raises(RuntimeError):
        sinks.save_external(df, str(tmp_path / "t"), "lm_test.t", "errorifexists")
    sinks.save_external(df.withColumnRenamed("v", "w"), str(tmp_path / "t"), "lm_test.t")
    assert spark.table("lm_test.t").columns == ["id", "w"]
    with pytest.raises(ValueError):
        sinks.save_external(df, str(tmp_path / "t"), "lm_test.t", "append")
    spark.sql("DROP TABLE lm_test.t")
    for outcome in ("succeeded", "failed"):
        sinks.append_audit(spark, str(tmp_path / "audit"), "gold", outcome, {"n": None, "nested": {"a": [1]}})
    assert spark.read.parquet(str(tmp_path / "audit")).count() == 2
    for kind in ("csv", "json", "parquet"):
        sinks.write(df, str(tmp_path / kind), kind)
    with pytest.raises(ValueError):
        sinks.write(df, str(tmp_path / "z"), "avro")
    log = tmp_path / "log.json"
    log.write_text('{"run": 0}')
    sinks.log_run({"run": 1, "m": {"a": None}}, str(log))
    assert [r["run"] for r in json.loads(log.read_text())] == [0, 1]
    sinks.log_run({"run": 1, "m": {"a": None}, "none": None}, f"file://{tmp_path}/remote", spark)
    assert json.loads(spark.read.json(f"file://{tmp_path}/remote").first().record_json)["m"] == '{"a": null}'


def test_kept_frames(spark):
    df = spark.range(5)
    for mode in ("persist", "table", "none"):
        with Kept(spark, mode) as kept:
            assert kept.keep(df, "stage").count() == 5 and kept.counts == {"stage": 5}
            kept._undo.insert(0, ("broken", lambda: 1 / 0))
        assert len(kept.warnings) == 1
    assert resolve_mode("auto", True) == "table" and resolve_mode("auto", False) == "persist"
    with pytest.raises(ValueError):
        resolve_mode("cache", False)
    assert new_run_id() != new_run_id() and new_run_id().startswith("r_")
    assert all(configure_arrow(spark, 10_000).values())


def test_lexicon_layouts(spark, tmp_path):
    w = lambda n, t: ((tmp_path / n).write_text(t), str(tmp_path / n))[1]
    vad = {r.term: r for r in lexicons.load_vad(spark, w("vad", "term\tvalence\tarousal\tdominance\nnull\t0.5\t0.1\t-0.2\ntwo words\t1\t1\t1\nSun\t1\t0\t0\n")).collect()}
    assert set(vad) == {"null", "sun"} and vad["null"].valence == 0.5
    assert {r.term for r in lexicons.load_worry(spark, w("worry", "Term\tMajorityLabel\nnull\t2\ncalm\t1\nFear\t3\n")).collect()} == {"null", "fear"}
    social = lexicons.load_social(spark, w("wcst", "term\twarmth (W)\tcompetence (C)\tsociability (S)\ttrust (T)\nnull\t0.1\t0.2\t0.3\t0.4\n")).first()
    assert (social.term, social.social_trust) == ("null", 0.4)
    affect = {r.term: r.affect for r in lexicons.load_affect(spark, w("aff", "good\t1.5\tx\nshort\nbad\tnot a number\ngood\t2.5\nnull\t-1\n")).collect()}
    assert affect == {"good": 2.5, "null": -1.0}
    inten = {r.term: r for r in lexicons.load_intensity(spark, w("int", "null\tjoy\t0.5\nnull\tjoy\t0.7\nnull\tfear\t0.1\n")).collect()}
    assert inten["null"].int_joy == 0.7 and inten["null"].int_fear == 0.1 and inten["null"].int_anger is None
    with pytest.raises(SystemExit, match="--wcst"):
        lexicons.resolve_paths(vad="a", worry="b")
    assert lexicons.resolve_paths("/x", vad="own")["vad"] == "own" and lexicons.resolve_paths("s3://b/x")["worry"] == "s3://b/x/worry.tsv"


def test_nothing_outside_needs_the_llm_part():
    import lakemill.plans.catalog  # noqa: F401

    assert "lakemill.llm" not in "".join(m for m in sys.modules if m.startswith("lakemill.plans"))
