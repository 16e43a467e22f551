import json

from conftest import SF_SMALL
from tillroll.__main__ import main
from tillroll.session import scratch_path


def test_cli_runs_the_daily_paths(spark, capsys):
    lake = scratch_path(spark, "t_cli")
    common = ["--master", "local[4]", "--sf-dir", SF_SMALL, "--lake", lake]
    assert main(["extract", *common]) == 0
    extracted = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert {r["status"] for r in extracted} == {"success"} and len(extracted) == 5
    assert main(["process", *common]) == 0
    processed = {r["dataset"]: r["rows"] for r in map(json.loads, capsys.readouterr().out.splitlines())}
    assert processed["daily_sales"] > 0 and processed["order_items"] > 0
    # sf0.001 has 147 LTV customers, so the floor of 500 must stop the gate.
    try:
        main(["quality", *common])
        raise AssertionError("gate should fail at this scale")
    except ValueError as e:
        assert "customer_ltv_min_row_count" in str(e)
    try:
        main(["publish", *common, "--database", "t_cli_marts"])
        raise AssertionError("results that did not pass must not be published")
    except ValueError:
        pass
    capsys.readouterr()
    assert main(["quality", *common, "--floors", '{"customer_ltv": 100}']) == 0
    assert '"critical_failures": 0' in capsys.readouterr().out
    assert main(["publish", *common, "--database", "t_cli_marts"]) == 0
    published = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert published["marts/daily_sales"] == processed["daily_sales"] and published["raw/orders"] > 0
    assert spark.table("t_cli_marts.customer_ltv").count() == processed["customer_ltv"]
    assert main(["report", "ltv_segments", *common, "--database", "t_cli_marts"]) == 0
    segments = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert sum(r["customer_count"] for r in segments) == processed["customer_ltv"]


def test_cli_query_unknown_key(spark, capsys):
    assert main(["query", "nope", "--master", "local[2]"]) == 2


def test_cli_needs_a_lake(capsys):
    import pytest
    with pytest.raises(SystemExit):
        main(["extract", "--master", "local[2]", "--sf-dir", SF_SMALL])
