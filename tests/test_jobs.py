import json

import pytest

from lakemill import jobs


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    raw = root / "raw"
    raw.mkdir()
    put = lambda n, rows: (raw / f"{n}.json").write_text("\n".join(map(json.dumps, rows)))
    mood = ["bad awful", "good nice", "good", "bad", "fine good good"]
    put("review", [
        {"review_id": f"r{i}", "user_id": f"u{i % 7}", "business_id": f"b{i % 3}", "stars": float([1, 5, 4, 2, 5][i % 5]), "useful": 0, "funny": 0, "cool": 0,
         "text": f"{mood[i % 5]} place number {i} " + "word " * (i % 9), "date": f"2021-{i % 12 + 1:02d}-03 10:00:00"} for i in range(120)
    ])
    put("business", [{"business_id": f"b{i}", "name": f"Cafe {i}", "city": "Reno", "state": "NV", "latitude": 1.0 + i, "longitude": 2.0, "stars": 4.0, "review_count": 9, "is_open": 1, "attributes": {"a": "b"}, "categories": "Food, Coffee", "hours": None} for i in range(4)])
    put("user", [{"user_id": f"u{i}", "name": f"N{i}", "review_count": 2, "average_stars": 3.5} for i in range(9)])
    put("tip", [{"user_id": "u1", "business_id": "b1", "text": "t", "date": "2020-01-01", "compliment_count": 0}])
    put("checkin", [{"business_id": "b3", "date": "2020-01-01"}])
    lex = root / "lex"
    lex.mkdir()
    (lex / "vad.tsv").write_text("term\tvalence\tarousal\tdominance\ngood\t0.9\t0.1\t0.2\nbad\t-0.8\t0.3\t0.1\nnice\t0.7\t0\t0\nplace\t0.1\t0.2\t0.3\n")
    (lex / "worry.tsv").write_text("Term\tMajorityLabel\nbad\t3\n")
    (lex / "wcst.tsv").write_text("term\twarmth (W)\tcompetence (C)\tsociability (S)\ttrust (T)\ngood\t0.5\t0.4\t0.3\t0.2\nbad\t-0.5\t0.1\t-0.3\t-0.2\n")
    (lex / "affect.tsv").write_text("good\t1.5\nbad\t-1.5\n")
    (lex / "intensity.tsv").write_text("bad\tanger\t0.5\ngood\tjoy\t0.75\n")
    return root


def test_every_job(spark, lake, capsys):
    go = lambda *a: jobs.main([str(x) for x in a], spark)
    at = lambda n: str(lake / n)
    assert go("bronze", "--source", at("raw"), "--target", at("bronze"), "--partitions", 2) == 0
    go("bronze", "--source", at("raw"), "--target", at("bronze"), "--partitions", 2)
    assert "skipped" in capsys.readouterr().out
    from lakemill.sources.lexicons import resolve_paths

    got = jobs.run_silver(spark, at("bronze"), at("small"), at("audit"), resolve_paths(at("lex")), size=50, mode="persist", check_features=False)
    assert got["rows"] == {"reviews": 50, "silver": 50} and spark.read.parquet(at("small/bronze_checkin")).count() == 0
    full = jobs.run_silver(spark, at("bronze"), at("full"), at("audit"), resolve_paths(at("lex")), groups=["linguistic", "vad", "nrc-emotion", "domain-lexicons", "time-weighting"], check_features=False)
    assert full["rows"]["silver"] == 120
    silver = spark.read.parquet(at("full/silver"))
    assert {"worry_word_count", "weighted_star", "primary_industry"} <= set(silver.columns) and silver.where("Valence_avg > 0").count() > 0
    go("gold", "--source", at("full/silver"), "--target", at("state"), "--audit", at("audit"), "--level", "state", "--state", "nv", "--min-stars", 2, "--sentiment-column", "Valence_avg")
    assert spark.read.parquet(at("state")).first().gold_variant_value == "NV"
    go("gold", "--source", at("full/silver"), "--target", at("rows"), "--audit", at("audit"), "--level", "sample", "--size", 500)
    rows = spark.read.parquet(at("rows"))
    assert rows.count() == 120 and "gold_created_at" in rows.columns
    go("serving", "--source", at("rows"), "--target", at("serving"), "--audit", at("audit"))
    assert spark.read.parquet(at("serving/business_summary")).count() == 3 and spark.read.parquet(at("serving/monthly_summary")).count() == 12
    with pytest.raises(ValueError):
        go("serving", "--source", at("state"), "--target", at("never"), "--audit", at("audit"))
    with pytest.raises(AssertionError):
        go("gold", "--source", at("full/silver"), "--target", at("never"), "--audit", at("audit"), "--level", "state", "--state", "zz")
    audit = [(r.task, r.outcome) for r in spark.read.parquet(at("audit")).orderBy("recorded_at_utc").collect()]
    assert audit == [("silver", "succeeded")] * 2 + [("gold:state", "succeeded"), ("gold:sample", "succeeded"), ("serving", "succeeded"), ("serving", "failed"), ("gold:state", "failed")]
