"""What a fold has changed is marked in its rows, not joined back; sums are whole numbers; tables run side by side."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillroll import schemas
from tillroll.functions import exact, money_round
from tillroll.operators import deltas as D
from tillroll.operators.dedupe import CHANGED, OLD, merge_latest
from tillroll.plans import sums
from tillroll.sinks import writers as K
from tillroll.sources import extract as S
from tillroll.streaming import incremental as I

STAMP = dt.datetime(2024, 1, 1)


def customers(spark, rows):
    """Rows (customer_id, city, day of the stamp)."""
    df = spark.createDataFrame(rows, "customer_id long, city string, day int")
    return K.conform(df.select("customer_id", "city", F.lit("a").alias("first_name"), F.lit("e").alias("email"),
                               (S.ntz(STAMP) + F.make_dt_interval("day")).alias("updated_at")), schemas.CUSTOMERS)


def pairs(df):
    return sorted(((r.customer_id, r.city) for r in df.collect()), key=str)


def test_merged_rows_say_what_the_batch_changed(spark):
    before = spark.createDataFrame([(1, 1, "a"), (2, 5, "b"), (None, 1, "c")], "id long, stamp int, v string")
    batch = spark.createDataFrame([(2, 4, "late"), (None, 2, "d"), (3, 1, "e")], "id long, stamp int, v string")
    got = {r.id: (r.v, r[CHANGED], r[OLD] and r[OLD].v) for r in merge_latest(before, batch, "id", "stamp", marked=True).collect()}
    assert got == {1: ("a", False, None), 2: ("b", True, "b"), None: ("d", True, "c"), 3: ("e", True, None)}


def test_a_fold_tells_old_new_and_unchanged_rows_without_a_join(spark, tmp_path):
    latest = f"{tmp_path}/latest"
    args = (spark, f"{tmp_path}/raw/customers", schemas.CUSTOMERS, "customer_id", "updated_at", latest, f"{tmp_path}/ckpt")
    K.land_raw(customers(spark, [(k, "x", 1) for k in (1, 2, 3, 4, None)]), f"{tmp_path}/raw", "customers", "2024-02-01")
    assert I.maintain_latest(*args) == 0
    assert I.unchanged_rows(spark, latest, schemas.CUSTOMERS, 0, True).isEmpty()
    K.land_raw(customers(spark, [(1, "y", 2), (2, "late", 0), (5, "new", 2), (None, "z", 2)]), f"{tmp_path}/raw", "customers", "2024-02-02")
    assert I.maintain_latest(*args) == 1
    old, new = I.changed_rows(spark, latest, schemas.CUSTOMERS, 1)
    same = I.unchanged_rows(spark, latest, schemas.CUSTOMERS, 1, True)
    assert pairs(old) == sorted([(1, "x"), (2, "x"), (None, "x")], key=str)
    assert pairs(new) == sorted([(1, "y"), (2, "x"), (5, "new"), (None, "z")], key=str)
    assert pairs(same) == [(3, "x"), (4, "x")]
    assert pairs(same.unionByName(new)) == pairs(I.read_latest(spark, latest, schemas.CUSTOMERS))
    assert sorted(r[0] or 0 for r in I.changed_keys(spark, latest, schemas.CUSTOMERS, "customer_id", 1).collect()) == [0, 1, 2, 5]
    assert "Join" not in same._jdf.queryExecution().optimizedPlan().toString()


def test_the_changed_states_of_a_run_are_put_together_from_the_marks(spark, tmp_path, monkeypatch):
    """The keys of the changes are not joined to the touched items, and both states are those of the joins."""
    from tillroll.operators import clean as C
    base = str(tmp_path)
    day = S.ntz(STAMP)

    def land(rows, items, when):
        o = spark.createDataFrame(rows, "order_id long, customer_id long, status string, total_amount double, day int")
        o = o.withColumns({"order_date": day, "updated_at": day + F.make_dt_interval("day"), "discount_pct": F.lit(5.0)})
        i = spark.createDataFrame(items, "item_id long, order_id long, product_id long, quantity int, line_total double, day int")
        i = i.withColumns({"unit_price": F.lit(1.5), "discount_pct": F.lit(0.0), "created_at": day + F.make_dt_interval("day")})
        p = spark.createDataFrame([(1, "p", "A"), (2, "q", "B")], "product_id long, product_name string, category string")
        p = p.withColumns({"unit_price": F.lit(2.0), "cost_price": F.lit(1.0), "updated_at": day})
        for t, df in (("orders", o), ("order_items", i), ("products", p), ("customers", customers(spark, [(1, "x", 1)]))):
            K.land_raw(K.conform(df, schemas.SOURCES[t]), f"{base}/raw", t, when)

    from tillroll.plans.pipeline import latest_versions, refresh_latest
    land([(k, 1, "pending", 3.0, 1) for k in (1, 2, 3, 4)], [(k * 10 + n, k, n, 1, 2.5, 1) for k in (1, 2, 3, 4) for n in (1, 2)], "2024-02-01")
    shown = (refresh_latest(spark, base), latest_versions(spark, base))[1]
    land([(1, 1, "pending", 4.0, 2), (4, 1, "cancelled", 3.0, 2)], [(21, 3, 1, 7, 9.0, 2), (51, 1, 2, 1, 1.0, 2)], "2024-02-02")
    after = C.clean_all(refresh_latest(spark, base), deduped=True)
    ch = sums.changes(spark, base, shown, latest_versions(spark, base))
    joined = D.touched_states(after, D.Changes(ch.keys, ch.old, ch.new))
    want = [[sorted(map(str, f(s).collect())) for f in (D.daily_rows, D.product_rows)] for s in joined]
    monkeypatch.setattr(D, "of_keys", lambda *a, **k: pytest.fail("keys were joined"))
    got = [[sorted(map(str, f(s).collect())) for f in (D.daily_rows, D.product_rows)] for s in D.touched_states(after, ch)]
    assert got == want and all(rows for state in got for rows in state)


VALUES = [0.0, -0.0, 1.005, -1.005, 0.005, 4.9999995, 0.1234565, -12345.1234565, 5e-7, 99999999.995, 1e8, -1e15, 9.9e20, 123456.0000005, None]


def test_sums_are_whole_numbers_and_equal_decimal_sums(spark):
    df = spark.createDataFrame([(n % 4, v) for n, v in enumerate(VALUES * 5)], "k int, x double")
    got = df.groupBy("k").agg(D._value("x").alias("v"), F.sum(exact("x")).alias("want"))
    assert not any(isinstance(f.dataType, DecimalType) for f in got.schema["v"].dataType.fields)
    assert all(r.s == r.want and 0 <= r.v.low < 10 ** 9 and 0 <= r.v.mid < 10 ** 9
               for r in got.select("*", D._sum("v").alias("s")).collect())
    many = df.filter("x is not null").select(D._times(F.col("x"), F.lit(10 ** 6)).alias("v"), exact("x").alias("want")).select(D._sum("v").alias("s"), "want")
    assert all(r.s == r.want * Decimal(10 ** 6) for r in many.collect())


@pytest.mark.parametrize("scale", [0, 2, 6, 7])
def test_money_round_by_millionths_is_that_by_decimal(spark, scale):
    df = spark.createDataFrame([(v,) for v in VALUES + [float("nan"), float("inf")]], "x double")
    want = F.round(F.col("x").cast("decimal(38,6)"), scale).cast("double")
    assert [str(r[0]) for r in df.select(money_round("x", scale)).collect()] == [str(r[0]) for r in df.select(want).collect()]


def test_jobs_that_must_all_succeed_raise_after_all_have_ended(spark):
    ended = []

    def fail():
        raise RuntimeError("broken")

    with pytest.raises(RuntimeError, match="broken"):
        S.all_done({"a": fail, "b": lambda: ended.append(1)})
    assert ended and S.all_done({"b": lambda: 2, "a": lambda: 1}) == {"b": 2, "a": 1}
