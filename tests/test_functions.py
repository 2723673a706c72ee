import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quotelens import fixed_values as fixed
from quotelens.functions import bins, credit, metrics, payplan
from quotelens.functions.lookup import cents, total


def values(spark, kinds, rows, *expressions):
    out = spark.createDataFrame(rows, kinds).select(*expressions).collect()
    return [tuple(r) if len(expressions) > 1 else r[0] for r in out]


def test_percent_is_derived_only_above_hundred(spark):
    rows = [
        (25.0, Decimal(1), Decimal(4)), (250.0, Decimal(1), Decimal(4)), (250.0, Decimal(1), Decimal(0)),
        (250.0, None, Decimal(4)), (250.0, Decimal(9), Decimal(4)), (250.0, Decimal(-9), Decimal(4)),
        (250.0, Decimal(1), Decimal(8)), (250.0, Decimal(3), Decimal(8)), (None, Decimal(1), Decimal(4)),
        (math.nan, Decimal(1), Decimal(4)), (100.0, Decimal(1), Decimal(4)), (100.4, Decimal(1), Decimal(4)),
    ]
    got = values(spark, "p double, d decimal(12,2), t decimal(12,2)", rows,
                 payplan.repaired_percent(F.col("p"), F.col("d"), F.col("t")))
    # 12.5 and 37.5 are ties and go to the even neighbour
    assert got == [25.0, 25.0, 0.0, 0.0, 100.0, 0.0, 12.0, 38.0, None, None, 100.0, 25.0]


def test_percent_rounds_half_even_and_merges_once(spark):
    percents = [16.65, 16.25, 16.5, 99.99, 20.3, 16.66, 16.74, 15.0, 8.04, 9.0, 41.7, 16.9]
    got = values(spark, "p double", [(p,) for p in percents],
                 payplan.merged_hundredths(payplan.percent_tenths(F.col("p"))))
    assert got == [1660, 1620, 1650, 10000, 2000, 1666, 1666, 1666, 833, 833, 4170, 1690]


def test_payment_count_tests_the_unrounded_percent(spark):
    got = values(spark, "p double, n int", [(100.0, 5), (99.99, 5), (25.0, 3), (25.0, None), (100.0, None)],
                 payplan.payment_count(F.col("p"), F.col("n")))
    assert got == [1, 6, 4, None, 1]


def test_plans_are_the_fourteen_in_order(spark):
    labels = [r.PayPlan for r in payplan.pay_plans(spark).collect()]
    assert len(labels) == 14 and labels[0] == "8% down, 12 payments" and labels[-1] == "Full pay"
    order = values(spark, "l string", [(x,) for x in labels], payplan.pay_plan_order(F.col("l")))
    assert order == list(range(14))


def test_county(spark):
    rows = [("\tcook \n",), ("",), (None,), ("  ",), (" lake ",), ("du  page",)]
    got = values(spark, "c string", rows, bins.clean_county(F.col("c")))
    assert got == ["COOK", "UNKNOWN", "UNKNOWN", "UNKNOWN", "LAKE", "DU  PAGE"]


def test_premium_bin(spark):
    rows = [(Decimal(x) if x is not None else None,) for x in ["-1", "0", "499.99", "500", "5000", "99999", None]]
    got = values(spark, "p decimal(12,2)", rows, bins.premium_bin(F.col("p")))
    assert got == [-500, 0, 0, 500, 5000, 5000, None]


def test_vehicle_year_bin(spark):
    rows = [(y,) for y in [0, 1, 2009, 2010, 2014, 2019, 2020, 9999, 10000, None]]
    got = values(spark, "y int", rows, bins.vehicle_year_bin(F.col("y")))
    assert got == [None, "pre-2010", "pre-2010", "2010-2014", "2010-2014", "2015-2019", "2020+", "2020+", None, None]


def test_capped_counts(spark):
    rows = [(n,) for n in [0, 1, 3, 4, 5, 9, None]]
    got = values(spark, "n bigint", rows, bins.driver_count_label(F.col("n")), bins.vehicle_count_label(F.col("n")))
    assert [g[0] for g in got] == ["0", "1", "3", "4+", "4+", "4+", "1"]
    assert [g[1] for g in got] == ["0", "1", "3", "4", "5+", "5+", "1"]


def test_limits_label(spark):
    rows = [(25, 50), (50, 100), (100, 300), (25, 100), (None, 50)]
    got = values(spark, "a int, b int", rows, bins.liability_label(F.col("a"), F.col("b")))
    assert got == ["25/50", "50/100", "100/300", None, None]


def test_month_label(spark):
    got = values(spark, "m int", [(202405,), (2024,)], bins.month_label(F.col("m")))
    assert got == ["05/2024", "2024"]


def test_london_time(spark):
    got = values(spark, "t string", [("2026-05-03 02:03:07",), ("2026-12-03 02:03:07",)],
                 bins.london_time_label(F.to_timestamp("t")))
    assert got == ["03 May 2026, 03:03 (London time)", "03 Dec 2026, 02:03 (London time)"]


def test_carrier_state(spark):
    rows = [(0, 0), (1, 0), (1, None), (1, 5), (1, -5), (None, 5)]
    got = values(spark, "p int, l int", rows, credit.carrier_state(F.col("p"), F.col("l")))
    assert got == ["NO_PC", "NO_LAPSE", "NO_LAPSE", "LAPSE", "NO_PC", "NO_PC"]


def test_duration_points(spark):
    rows = [(0, 40), (1, 5), (1, 6), (1, 12), (1, 13), (1, None), (1, -3)]
    got = values(spark, "p int, m int", rows, credit.duration_points(F.col("p"), F.col("m")))
    assert got == [-50, -50, 0, 0, 70, -50, -50]


def test_vehicle_age_points(spark):
    got = values(spark, "a int", [(-2,), (0,), (2,), (3,), (9,), (10,), (None,)], credit.vehicle_age_points(F.col("a")))
    assert got == [110, 110, 110, 35, 35, -40, 0]


def test_age_points(spark):
    rows = [(17, "NO_PC"), (18, "LAPSE"), (45, "NO_LAPSE"), (56, "LAPSE"), (70, "NO_PC"), (71, "LAPSE"), (101, "NO_PC"),
            (None, "NO_PC")]
    got = values(spark, "a int, s string", rows, credit.age_points("a", "s"))
    assert got == [0, -40, 10, -10, 100, 0, 0, 0]


def test_other_points(spark):
    got = values(spark, "n bigint, l string, r string",
                 [(0, "25/50", "O"), (1, "50/100", "R"), (5, "100/300", None), (8, None, "O")],
                 credit.vehicle_count_points(F.col("n")), credit.limits_points(F.col("l")),
                 credit.homeowner_points(F.col("r")))
    assert got == [(0, 0, 100), (27, 100, 0), (135, 200, 0), (135, 0, 100)]


def test_credit_bin(spark):
    assert values(spark, "s int", [(899,), (900,), (None,)], credit.credit_bin(F.col("s"))) == [850, 900, None]


def test_cents_and_totals_are_exact(spark):
    amounts = [Decimal("0.01"), Decimal("9999999999.99"), Decimal("-0.01"), Decimal("1.15"), None]
    frame = spark.createDataFrame([(a,) for a in amounts], "m decimal(12,2)")
    assert [r[0] for r in frame.select(cents("m")).collect()] == [1, 999999999999, -1, 115, None]
    assert frame.agg(total("m")).first()[0] == 10000000001.14
    assert frame.limit(0).agg(total("m")).first()[0] == 0.0


def test_ratios(spark):
    got = values(spark, "n double, d double", [(1.0, 2.0), (1.0, 0.0), (1.0, -2.0), (None, 2.0)],
                 metrics.ratio(F.col("n"), F.col("d")), metrics.versus(F.col("n"), F.col("d")))
    assert got == [(0.5, -0.5), (None, None), (None, None), (None, None)]


@pytest.mark.parametrize("format_of, value, text", [
    (metrics.grouped_number, 1234567.5, "1,234,568"), (metrics.grouped_number, 0.5, "1"),
    (metrics.grouped_number, 2.5, "3"), (metrics.grouped_number, None, ""),
    (metrics.dollar_amount, 3509.02, "$3,509"), (metrics.dollar_amount, None, ""),
    (metrics.percent_text, 16.25, "16.3%"), (metrics.percent_text, 0.15, "0.1%"), (metrics.percent_text, 12345.0, "12345.0%"),
    (metrics.share_text, 0.1234, "12.3%"), (metrics.share_text, None, ""),
    (metrics.signed_share_text, 0.0, "+0.0%"), (metrics.signed_share_text, -0.0625, "-6.3%"),
    (metrics.signed_share_text, 0.0625, "+6.3%"), (metrics.signed_share_text, None, ""),
])
def test_display_text(spark, format_of, value, text):
    assert values(spark, "v double", [(value,)], format_of(F.col("v"))) == [text]


def test_signed_integers(spark):
    got = values(spark, "v int", [(3,), (0,), (-3,), (None,)], metrics.signed_integer_text(F.col("v")))
    assert got == ["+3", "0", "-3", ""]


def test_score_stays_within_the_offered_range():
    low = fixed.CREDIT_BASE - 81 - 50 - 40 - 40 + 27
    high = fixed.CREDIT_BASE + 121 + 70 + 110 + 120 + 200 + 135 + 100
    assert fixed.CREDIT_RANGE[0] <= low and high <= fixed.CREDIT_RANGE[1]
