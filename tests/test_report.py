import pytest
from pyspark.sql import functions as F

from quotelens.config import MarketConfig
from quotelens.operators import report
from quotelens.operators.report import ReportFilters
from tests import frames

CONFIG = MarketConfig()


def by_company(frame, state="IL"):
    return {r.CompanyName: r for r in frame.where(F.col("State") == state).collect()}


def company(name, quotes, premium, bridged=0, bridged_premium=0.0, **more):
    return {"CompanyName": name, "Quotes": quotes, "SumPremium": premium, "BridgingCount": bridged,
            "SumBridgingPremium": bridged_premium, **more}


MARKET = [
    company("UIC", 10, 1000.0, 4, 500.0), company("SIC", 20, 2000.0, 2, 200.0), company("GEICO", 10, 3000.0, 1, 50.0),
    company("Other", 60, 9000.0, 10, 1000.0), company("AmFreedom", 5, 100.0, Term=12),
]


def test_figures(spark):
    rows = by_company(report.company_report(frames.cube(spark, *MARKET), CONFIG))
    uic = rows["UIC"]
    assert (uic.Quotes, uic.SizePct, uic.AvgPremium, uic.BridgeRate, uic.AvgBridgingPremium) == (10, 10, 100, 0.4, 125)
    assert {n: (r.WrittenRank, r.BridgeRank, r.RankDiff) for n, r in rows.items()} == {
        "UIC": (1, 4, -3), "SIC": (1, 2, -1), "Other": (3, 2, 1), "GEICO": (4, 1, 3),
        "AmFreedom": (None, None, None), "TOTAL": (None, None, None)}
    assert uic.VsCompareCo == 0 and uic.VsSIC == 0.25
    assert {n for n, r in rows.items() if r.IsReference} == {"UIC", "SIC"}


def test_total(spark):
    rows = by_company(report.company_report(frames.cube(spark, *MARKET), CONFIG))
    total = rows["TOTAL"]
    assert (total.Quotes, total.BridgingCount, total.SizePct, total.AvgPremium) == (100, 17, 100, 150)
    assert total.Quotes == sum(r.Quotes for n, r in rows.items() if n != "TOTAL")
    assert total.VsCompareCo == pytest.approx((1250 / 13) / 125 - 1)
    assert total.VsSIC == pytest.approx((1550 / 15) / 100 - 1)


def test_company_without_rows_in_the_slice_gets_zeros(spark):
    row = by_company(report.company_report(frames.cube(spark, *MARKET), CONFIG))["AmFreedom"]
    assert (row.Quotes, row.SizePct, row.AvgPremium, row.BridgeRate) == (0, 0, None, None)


def test_empty_slice_has_no_total(spark):
    filters = ReportFilters(county="NOWHERE")
    rows = by_company(report.company_report(frames.cube(spark, *MARKET), CONFIG, filters))
    assert "TOTAL" not in rows and rows["UIC"].Quotes == 0 and rows["UIC"].SizePct is None


def test_only_company_purchased_leaves_no_comparison_in_the_total(spark):
    cube = frames.cube(spark, company("UIC", 2, 10.0, 1, 5.0), company("GEICO", 2, 10.0))
    assert by_company(report.company_report(cube, CONFIG))["TOTAL"].VsCompareCo is None


def test_display_order(spark):
    cube = frames.cube(spark, *[company(n, 1, 1.0) for n in ("Other", "AmericanAlliance", "AmFreedom", "zeta", "77")])
    names = [r.CompanyName for r in report.company_report(cube, CONFIG).collect()]
    assert names == ["77", "AmericanAlliance", "AmFreedom", "zeta", "Other", "TOTAL"]


def test_sorting_keeps_total_last(spark):
    made = report.company_report(frames.cube(spark, *MARKET), CONFIG)
    down = [r.CompanyName for r in report.sort_report(made, "Quotes", ascending=False).collect()]
    assert down == ["Other", "SIC", "GEICO", "UIC", "AmFreedom", "TOTAL"]
    up = [r.CompanyName for r in report.sort_report(made, "AvgPremium").collect()]
    assert up == ["SIC", "UIC", "Other", "GEICO", "AmFreedom", "TOTAL"]
    with pytest.raises(ValueError):
        report.sort_report(made, "CompanyName")


def test_states_are_ranked_apart(spark):
    cube = frames.cube(spark, *MARKET, company("SunCoast", 5, 50.0, State="AZ"))
    rows = report.company_report(cube, CONFIG)
    assert by_company(rows, "AZ")["SunCoast"].WrittenRank == 1
    assert by_company(rows, "AZ")["SunCoast"].VsSIC is None


@pytest.mark.parametrize("filters, kept", [
    (ReportFilters(), {1, 2, 5, 6, 7, 8}),
    (ReportFilters(term=12), {3}),
    (ReportFilters(premium_max=5000), {1, 2, 6, 7, 8}),
    (ReportFilters(premium_min=5000), {5}),
    (ReportFilters(month_from=202502), {2}),
    (ReportFilters(month_to=202501), {1, 5, 6, 7, 8}),
    (ReportFilters(credit_min=650), {1, 2, 5, 7, 8}),
    (ReportFilters(credit_max=850), set()),
    (ReportFilters(county="O'BRIEN"), {7}),
    (ReportFilters(non_owner=True), {8}),
    (ReportFilters(non_owner=False, prior_insurance=False), set()),
    (ReportFilters(liab="25/50", pay_plan="Full pay", num_drivers="1", num_vehicles="1", year_bin="2020+"),
     {1, 2, 5, 6, 7, 8}),
    (ReportFilters(provider="Any"), {1, 2, 5, 6, 7, 8}),
    (ReportFilters(provider="EZ Lynx"), set()),
])
def test_filters(spark, filters, kept):
    cube = frames.cube(
        spark, {"Quotes": 1}, {"Quotes": 2, "YYYYMM": 202502}, {"Quotes": 3, "Term": 12}, {"Quotes": 4, "Term": None},
        {"Quotes": 5, "PremBin": 5000}, {"Quotes": 6, "CreditBin": None}, {"Quotes": 7, "County": "O'BRIEN"},
        {"Quotes": 8, "NonOwner": 1},
    )
    assert {r.Quotes for r in report.slice_cube(cube, filters).collect()} == kept


def test_provider_column_is_used_where_it_exists(spark):
    cube = frames.cube(spark, {"Quotes": 1}, {"Quotes": 2}).withColumn(
        "RateSource", F.when(F.col("Quotes") == 1, "ITC").otherwise("EZ Lynx"))
    for provider, kept in {"ITC": {1}, "EZ Lynx": {2}, "Any": {1, 2}}.items():
        assert {r.Quotes for r in report.slice_cube(cube, ReportFilters(provider=provider)).collect()} == kept


def test_filters_reach_the_scan(spark, tmp_path):
    frames.cube(spark, *MARKET).write.partitionBy("State", "YYYYMM").parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    sliced = report.slice_cube(stored.where(F.col("State") == "IL"), ReportFilters(month_from=202501, liab="25/50"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = report.company_slice(sliced, CONFIG)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = plan[plan.index("FileScan"):]
    assert "YYYYMM" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "EqualTo(LiabLimits,25/50)" in scan and "EqualTo(Term,6)" in scan
    assert "SumCompPremium" not in scan and "County" not in scan


def discounted(spark, discounts, *rows):
    return by_company(report.company_slice(frames.cube(spark, *rows), CONFIG, discounts))


def test_discount_applies_to_our_companies_only(spark):
    rows = discounted(spark, {"LiabBI": 50, "Comp": 10}, *MARKET)
    assert rows["UIC"].SumPremium == pytest.approx(940) and rows["UIC"].SumBridgingPremium == pytest.approx(470)
    assert rows["GEICO"].SumPremium == 3000 and rows["GEICO"].SumBridgingPremium == 50


@pytest.mark.parametrize("percent, premium", [(100, 900), (150, 900), (-50, 1050), (0, 1000), (float("nan"), 1000),
                                              (float("inf"), 1000)])
def test_discount_bounds(spark, percent, premium):
    assert discounted(spark, {"Coll": percent}, *MARKET)["UIC"].SumPremium == pytest.approx(premium)


def test_discount_has_no_floor_and_leaves_zero_premium_purchases(spark):
    row = company("UIC", 1, 0.0, 1, 40.0)
    got = discounted(spark, {"Coll": 100}, row)["UIC"]
    assert (got.SumPremium, got.SumBridgingPremium) == (-100.0, 40.0)


def test_no_discount_is_the_identity(spark):
    cube = frames.cube(spark, *MARKET)
    assert report.company_report(cube, CONFIG, discounts={"Comp": 0}).collect() == \
        report.company_report(cube, CONFIG).collect()


def test_formatted(spark):
    rows = by_company(report.formatted_report(report.company_report(frames.cube(spark, *MARKET), CONFIG)))
    assert tuple(rows["UIC"])[2:] == ("10", "10.0%", "$100", "1", "4", "40.0%", "$125", "4", "-3", "+0.0%", "+25.0%")
    assert tuple(rows["AmFreedom"])[2:] == ("0", "0.0%", "", "", "0", "", "", "", "", "", "")


def test_visible_columns():
    assert report.visible_columns(["SIC", "UIC"], "UIC", "SIC") == report.REPORT_COLUMNS
    assert not {"VsCompareCo", "VsSIC"} & set(report.visible_columns(["7000001"], None, "SIC"))


def test_report_keeps_companies_that_the_list_lacks(spark):
    sums = spark.createDataFrame(
        [("IL", "A", 5.0, 50.0, 1.0, 9.0), ("IL", None, 2.0, 20.0, 0.0, 0.0)],
        "State string, CompanyName string, Quotes double, SumPremium double, BridgingCount double, SumBridgingPremium double",
    )
    listed = spark.createDataFrame([("IL", "B")], "State string, CompanyName string")
    filled = {r.CompanyName: r.Quotes for r in report.zero_fill(listed, sums).collect()}
    assert filled == {"A": 5.0, "UNKNOWN": 2.0, "B": 0.0}


def test_unknown_coverage_is_an_error():
    with pytest.raises(ValueError, match="comp"):
        report.clean_discounts({"comp": 10})


def test_one_scan_of_the_cube(spark, tmp_path):
    frames.cube(spark, *MARKET).write.parquet(str(tmp_path / "cube"))
    stored = spark.read.parquet(str(tmp_path / "cube"))
    made = report.company_report(stored, CONFIG)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and plan.count("Expand") == 1
    physical = made._jdf.queryExecution().executedPlan().toString()
    # companies; grouping sets; windows; display order
    assert physical.count("FileScan parquet") == 1 and physical.count("Exchange ") <= 4


@pytest.mark.parametrize("filters", [ReportFilters(), ReportFilters(num_drivers="2"), ReportFilters(term=99)])
def test_totals_and_company_lists_agree(spark, filters):
    """The one pass gives what the separate total and a list of companies beside the slice give."""
    cube = frames.cube(spark, *MARKET)
    listed = cube.select("State", "CompanyName").distinct()
    made = report.company_report(cube, CONFIG, filters).collect()
    assert made == report.company_report(cube, CONFIG, filters, companies=listed).collect()
    total = report.report_total(report.report_rows(cube, CONFIG, filters), CONFIG)
    figures = ["State", "CompanyName", "Quotes", "BridgingCount", "BridgeRate", "AvgPremium", "SizePct", "VsCompareCo", "VsSIC"]
    assert [tuple(r[c] for c in figures) for r in made if r.IsTotal] == [tuple(r) for r in total.select(figures).collect()]
