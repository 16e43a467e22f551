"""Driver contract: smoke entry, every query runs, every oracle twin agrees."""
import math
import sys
from pathlib import Path

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, str(ROOT))
import __spark_entry__ as E  # noqa: E402
from tillroll.plans import catalog  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def test_entry_returns_flagship(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sale_date", "category", "num_orders", "units_sold", "gross_revenue",
                          "total_cost", "gross_profit", "margin_pct", "avg_discount_pct"]


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    vals = pdf[cols].astype(object).where(pdf[cols].notna(), None).values.tolist()
    return cols, sorted((tuple(_norm(v) for v in r) for r in vals), key=repr)


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, key):
    if key == "pipeline_full":
        pytest.skip("quality floor of 500 customers cannot be met at sf0.001 (150 customers)")
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    want = duck.sql(E.oracle_sql()[key]).to_arrow_table().to_pandas()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_pipeline_full_gate_blocks_publish_at_tiny_scale(spark):
    from tillroll.operators.quality import QualityGateError
    with pytest.raises(QualityGateError):
        E.queries()["pipeline_full"](spark, SF_SMALL)


def test_published_mart_keys_run_the_pipeline_in_each_call(spark, monkeypatch):
    from tillroll.plans import catalog
    runs = []

    def full(spark, d, floors=None, incremental=False):
        spark.range(len(runs) + 1).selectExpr("id", "1 AS _processed_at").createOrReplaceGlobalTempView("daily_sales")
        runs.append(d)
        return None, "global_temp"

    monkeypatch.setattr(catalog, "_full", full)
    assert [catalog._published(spark, "/t_each_call", "daily_sales").count() for _ in range(2)] == [1, 2]
    assert runs == ["/t_each_call"] * 2
    spark.catalog.dropGlobalTempView("daily_sales")
