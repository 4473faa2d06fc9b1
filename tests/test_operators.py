"""Ranking, rolling, shares, dedupe against brute force on skewed fixtures; rules; SKU map; functions."""

from __future__ import annotations

import datetime as dt
import hashlib
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarspark.functions import dates, labels, money
from bazaarspark.functions.scalars import number_text
from bazaarspark.operators import rules, sku
from bazaarspark.operators.dedupe import keep_one
from bazaarspark.operators.ranking import with_ntile, with_position
from bazaarspark.operators.rolling import rolling_days, rolling_rows
from bazaarspark.operators.shares import with_share


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value of one group; some values are NULL."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        group = "hot" if i % 4 else rng.choice("abc")
        value = None if i % 97 == 0 else 1.0 if i % 3 == 0 else round(rng.lognormvariate(0, 4), 2)
        data.append((group, value, f"id{i}"))
    return data, spark.createDataFrame(data, "g string, v double, id string")


@pytest.mark.parametrize("descending", [True, False])
def test_positions_match_a_full_sort(skewed, descending):
    data, df = skewed
    got = {r.id: (r._row_number, r._rank, r._group_rows) for r in with_position(df, ["g"], "v", "id", descending).collect()}
    assert len(got) == len(data)
    for group in {g for g, _, _ in data}:
        rows = [(v, i) for g, v, i in data if g == group]
        order = lambda v: float("inf") if v is None else (-v if descending else v)
        rows.sort(key=lambda x: (order(x[0]), hashlib.md5(x[1].encode()).hexdigest(), x[1]))
        first = {}
        for n, (v, i) in enumerate(rows, 1):
            first.setdefault(order(v), n)
            assert got[i] == (n, first[order(v)], len(rows))


def test_ntile_sizes(skewed):
    data, df = skewed
    counts = {(r.g, r.tile): r["count"] for r in with_ntile(df, ["g"], "v", "id", "tile", 5).groupBy("g", "tile").count().collect()}
    for group in {g for g, _, _ in data}:
        n = sum(g == group for g, _, _ in data)
        assert [counts[group, t] for t in range(1, 6)] == [n // 5 + (t <= n % 5) for t in range(1, 6)]


def test_ranking_never_windows_over_a_whole_group(skewed):
    plan = with_position(skewed[1], ["g"], "v", "id")._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "row_number" in line:
            assert "_range" in line.split("], [")[1]


def test_rolling_rows_matches_brute_force(spark):
    rng = random.Random(3)
    start = dt.date(2024, 1, 1)
    data = set()
    for _ in range(900):
        key = "hot" if rng.random() < 0.5 else rng.choice("xyz")
        data.add((key, start + dt.timedelta(days=rng.randrange(40)), None if rng.random() < 0.05 else f"t{rng.randrange(9)}"))
    rows = [(k, d, t, float(rng.randrange(100)), None if rng.random() < 0.2 else float(rng.randrange(50))) for k, d, t in data]
    df = spark.createDataFrame(rows, "k string, d date, t string, a double, b double")
    got = {
        (r.k, r.d, r.t): (r.sa, r.ab)
        for r in rolling_rows(df, ["k"], "d", ["t"], {"sa": ("sum", "a"), "ab": ("avg", "b")}).collect()
    }
    assert len(got) == len(rows)
    days = {(r.k, r.d, r.t): r.sa for r in rolling_days(df, ["k"], "d", {"sa": ("sum", "a")}).collect()}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2] is not None, r[2] or ""))
        for i, r in enumerate(mine):
            frame = mine[max(0, i - 6) : i + 1]
            bs = [x[4] for x in frame if x[4] is not None]
            expected = (sum(x[3] for x in frame), sum(bs) / len(bs) if bs else None)
            assert got[r[0], r[1], r[2]] == pytest.approx(expected), r
            week = [x[3] for x in mine if r[1] - dt.timedelta(days=6) <= x[1] <= r[1]]
            assert days[r[0], r[1], r[2]] == pytest.approx(sum(week))


def test_keep_one_is_deterministic(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 5, "n"), (None, 6, "m")], "k string, n int, v string")
    for parts in (1, 7):
        assert {tuple(r) for r in keep_one(df.repartition(parts), ["k"], newest=["n"]).collect()} == {("a", 2, "z"), (None, 6, "m")}
        assert {tuple(r) for r in keep_one(df.repartition(parts), ["k"], oldest=["n"]).collect()} == {("a", 1, "x"), (None, 5, "n")}


def test_share_with_null_groups_and_zero_total(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0), ("z", 0.0)], "k string, v double")
    assert sorted((r.k or "", r.v, r.s) for r in with_share(df, "v", ["k"], "s").collect()) == [
        ("", 2.0, 1.0), ("a", 1.0, 0.25), ("a", 3.0, 0.75), ("z", 0.0, None)]
    assert sorted(r.s for r in with_share(df, "v", [], "s").collect()) == pytest.approx([0, 1 / 6, 2 / 6, 3 / 6])


METRICS = "platform string, entity_type string, entity_id string, entity_name string, date date, roas double, cpa double, revenue_change_pct double, conversion_rate double, cancellation_rate double"


def metric_rows(spark, *rows):
    return spark.createDataFrame([("shopee", "daily", f"e{i}", f"E{i}", dt.date(2024, 1, 1), *r) for i, r in enumerate(rows)], METRICS)


def test_rules_first_match_and_nulls(spark):
    df = metric_rows(spark, (1.3, 350.0, None, 0.02, None), (None,) * 5, (1.5, 300.0, -0.2, 0.01, 0.15), (1.99, 501.0, -0.31, 0.009, 0.16))
    got = sorted((r.entity_id, r.alert_type, r.severity, r.threshold) for r in rules.evaluate(df).collect())
    assert got == [
        ("e0", "high_cpa", "warning", 300.0),
        ("e0", "low_roas", "critical", 1.5),
        ("e2", "low_roas", "warning", 2.0),
        ("e3", "high_cancellation_rate", "warning", 0.15),
        ("e3", "high_cpa", "critical", 500.0),
        ("e3", "low_conversion_rate", "warning", 0.01),
        ("e3", "low_roas", "warning", 2.0),
        ("e3", "revenue_drop", "critical", -0.3),
    ]
    message = {r.alert_type: r.message for r in rules.evaluate(df).where("entity_id = 'e3'").collect()}
    assert message["low_roas"] == "ROAS is 1.99, below threshold of 2.0"
    assert message["revenue_drop"] == "Revenue dropped by 31.0% compared to previous period"
    assert message["low_conversion_rate"] == "Conversion rate is 0.90%, below threshold of 1.0%"


def test_rule_list_editing_and_order(spark):
    df = metric_rows(spark, (1.0, None, None, None, None))
    base = rules.default_rules()
    assert len(base) == 10 and len(rules.remove_rule(base, "Low ROAS - Critical")) == 9 and len(rules.remove_rule(base, "no")) == 10
    severity = lambda rs: [r.severity for r in rules.evaluate(df, rs).collect()]
    # List order decides, not severity.
    assert severity([base[1], base[0]]) == ["warning"]
    off = rules.Rule("off", "low_roas", "", "lt", 9.0, "info", enabled=False)
    other = rules.Rule("other", "low_roas", "", "lte", 1.0, "info", platforms=("lazada",))
    mine = rules.Rule("mine", "low_roas", "", "eq", 1.0, "info", platforms=("shopee",))
    assert severity([off, other]) == [] and severity([off, other, mine]) == ["info"]
    assert rules.rules_of_type([off, mine], "low_roas") == [mine]
    assert rules.rules_from_frame(rules.rules_frame(spark, [*base, off, mine])) == [*base, off, mine]
    assert rules.evaluate(df.drop("roas"), base).count() == 0


def test_sku_map_from_csv(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text(
        "master_sku,platform,platform_sku,product_name,variation,notes\n"
        "M-1, Shopee ,SP-1,Shirt,M,n\nM-1,lazada,LZ-1,Shirt,,\n,shopee,SP-2,,,\nM-2,amazon,AM-1,,,\nM-9,shopee, SP-1 ,Later,,\n"
    )
    raw = sku.read_map(spark, str(path))
    assert raw.count() == 3
    latest = sku.latest_mapping(raw, "line")
    assert {(r.platform, r.platform_sku, r.master_sku) for r in latest.collect()} == {("shopee", "SP-1", "M-9"), ("lazada", "LZ-1", "M-1")}
    assert {r.platform: (r.mappings, r.master_skus) for r in sku.map_statistics(latest).collect()} == {
        "shopee": (1, 1), "lazada": (1, 1), "all": (2, 2)}
    products = spark.createDataFrame(
        [("Shopee", "SP-1", "a", "", 1), ("shopee", "NEW", "New Thing Here", "v", 2), ("SHOPEE", "NEW", "later", "w", 3), ("lazada", None, "x", "", 4)],
        "platform string, sku string, name string, variation string, n int")
    mapped = {(r.sku, r.n): (r.master_sku, r.is_mapped) for r in sku.map_products(products, latest).collect()}
    assert mapped[("SP-1", 1)] == ("M-9", True) and mapped[("NEW", 2)] == (None, False) and mapped[(None, 4)] == (None, False)
    unmapped = sku.unmapped_skus(products, latest, "n")
    assert [tuple(r) for r in unmapped.collect()] == [("shopee", "NEW", "New Thing Here", "v")]
    assert sku.proposed_mappings(products, latest, "n").collect()[0].master_sku == "NETHHE-NEW"
    sku.write_unmapped(unmapped, f"{tmp_path}/out")
    back = spark.read.csv(f"{tmp_path}/out", header=True)
    assert back.columns == list(sku.COLUMNS) and back.collect()[0].platform_sku == "NEW"
    bad = tmp_path / "bad.csv"
    bad.write_text("master_sku,platform\na,b\n")
    with pytest.raises(ValueError, match="platform_sku"):
        sku.read_map(spark, str(bad))


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).collect()[0])


def test_money(spark):
    assert money.rate_between("USD", "THB") == 35 and money.rate_between("EUR", "USD") == Decimal("38") * Decimal("0.0286")
    assert money.rate_between("THB", "GBP") == 1 / Decimal(44) and money.rate_between("GBP", "JPY") == 1
    assert money.rate_table(spark).count() == 121
    lit = F.lit
    got = one(
        spark,
        money.convert(lit("1,000.005"), lit("thb")).cast("string").alias("a"),
        money.convert(lit(100), lit("usd")).cast("string").alias("b"),
        money.convert(lit(None).cast("string"), lit("USD")).cast("string").alias("c"),
        money.convert(lit("3"), lit("XYZ")).cast("string").alias("d"),
        money.money_text(lit("1234567.5"), lit("THB")).alias("e"),
        money.money_text(lit(12), lit("gbp")).alias("f"),
        money.percentage(lit(1), lit(3)).cast("double").alias("g"),
        money.change(lit(5), lit(0)).cast("double").alias("h"),
        money.change(lit(0), lit(0)).cast("double").alias("i"),
        money.change(lit(5), lit(8), relative=False).cast("double").alias("j"),
    )
    assert got == ("1000.01", "3500.00", "0.00", "3.00", "1,234,567.50 ฿", "£12.00", 33.33, 100.0, 0.0, -3.0)
    parsed = one(spark, *[money.amount_and_currency(lit(t)).alias(f"x{i}") for i, t in enumerate(("$100.00", "฿500", "100 thb", "1,200"))])
    assert [(float(p.amount), p.currency) for p in parsed] == [(100.0, "USD"), (500.0, "THB"), (100.0, "THB"), (1200.0, "THB")]


def test_dates(spark):
    as_of = dt.date(2024, 3, 10)
    assert dates.named_period("last_month", as_of) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert dates.named_period("last_7_days", as_of) == (dt.date(2024, 3, 4), as_of)
    with pytest.raises(ValueError):
        dates.named_period("next_year", as_of)
    assert dates.day_spine(spark, dt.date(2024, 2, 27), dt.date(2024, 3, 1)).count() == 4
    texts = ["1704067200", "2024-01-01T00:00:00Z", "2024-01-01T07:00:00+07:00", "2024-01-01T00:00:00", "2024-01-01", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(dates.parse_instant("t").alias("x"))
    assert [r.x for r in df.collect()] == [dt.datetime(2024, 1, 1)] * 5 + [None, None]
    late = spark.createDataFrame([("2024-01-01T20:00:00Z",)], "t string").select(dates.local_day(dates.parse_instant("t")).alias("x"))
    assert late.collect()[0].x == dt.date(2024, 1, 2)


def test_channel_groups(spark):
    cases = {
        ("(direct)", "(none)"): "Direct", ("direct", None): "Direct", ("google", "organic"): "Organic Search", ("google", "CPC "): "Paid Search",
        ("x", "banner"): "Display", ("facebook", "paid_social"): "Paid Social", ("tiktok", "video"): "Social", ("news", "email"): "Email",
        ("y", "video"): "Video", ("z", "push"): "Mobile Push", (None, None): "Other", ("facebook", None): "Social",
    }
    df = spark.createDataFrame([(*k, v) for k, v in cases.items()], "s string, m string, want string")
    assert df.where(labels.channel_grouping("s", "m") != F.col("want")).count() == 0


def test_number_text(spark):
    assert one(spark, *[number_text(F.lit(x)).alias(f"c{i}") for i, x in enumerate((1.5, 2.0, 12345678.9, 100.0, 0.126))]) == (
        "1.5", "2", "12345678.9", "100", "0.13")
