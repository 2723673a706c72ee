from datetime import date

from quotelens.config import MarketConfig
from quotelens.operators import rates
from tests import frames

CONFIG = MarketConfig(company_names={"IL": {7000000: "National", 7000002: "UIC", 7000003: "UIC"}})


def cleaned(spark, *rows):
    return rates.clean_rates(frames.rate(spark, *rows), CONFIG).collect()


def test_rated_month_drops_other_months_nulls_and_the_far_date(spark):
    rows = frames.rate(
        spark, {"RateId": 1}, {"RateId": 2, "RatedDate": date(9999, 12, 31)}, {"RateId": 3, "RatedDate": None},
        {"RateId": 4, "RatedDate": date(2025, 2, 1)}, {"RateId": 5, "RatedDate": date(2024, 1, 5)},
    )
    assert [r.RateId for r in rates.in_rated_month(rows).collect()] == [1]


def test_inconsistent_policies_ignore_nulls_and_stay_within_the_slice(spark):
    rows = frames.rate(
        spark,
        {"PolicyLinkID": 1, "NonOwner": 0}, {"PolicyLinkID": 1, "NonOwner": 1},
        {"PolicyLinkID": 2, "NonOwner": None}, {"PolicyLinkID": 2, "NonOwner": 1},
        {"PolicyLinkID": 3, "AssumedCredit": 1}, {"PolicyLinkID": 3, "AssumedCredit": 2},
        {"PolicyLinkID": 4, "NonOwner": 0}, {"PolicyLinkID": 4, "NonOwner": 1, "Year_Month": "202502"},
        {"PolicyLinkID": None, "NonOwner": 0}, {"PolicyLinkID": None, "NonOwner": 1},
    )
    assert [r.PolicyLinkID for r in rates.inconsistent_policies(rows).orderBy("PolicyLinkID").collect()] == [1, 3]
    kept = sorted(str(r.PolicyLinkID) for r in rates.drop_inconsistent_policies(rows).collect())
    assert kept == ["2", "2", "4", "4", "None", "None"]


def test_dropped_plans_still_count_for_consistency(spark):
    rows = [{"PolicyLinkID": 1}, {"PolicyLinkID": 1, "PercentDown": 11.1, "NonOwner": 1}, {"PolicyLinkID": 2}]
    assert [r.PolicyLinkID for r in cleaned(spark, *rows)] == [2]


def test_earliest_iteration_then_lowest_premium(spark):
    rows = [
        {"RateIteration": 2, "TotalPremium": 10, "RateId": 1}, {"RateIteration": 1, "TotalPremium": 90, "RateId": 2},
        {"RateIteration": 1, "TotalPremium": 80, "RateId": 3}, {"RateIteration": None, "TotalPremium": 1, "RateId": 4},
        {"RateIteration": 1, "TotalPremium": None, "RateId": 5},
    ]
    for order in (rows, rows[::-1]):
        [kept] = cleaned(spark, *order)
        assert (kept.RateId, float(kept.TotalPremium)) == (3, 80.0)


def test_purchase_of_a_dropped_iteration_counts(spark):
    [kept] = cleaned(spark, {"RateIteration": 1}, {"RateIteration": 2, "Purchased": 1})
    assert (kept.RateIteration, kept.PurchasedFinal, kept.Purchased) == (1, 1, 0)


def test_purchase_needs_policy_and_company(spark):
    rows = cleaned(spark, {"PolicyLinkID": None, "Purchased": 1, "CompanyId": 7},
                   {"CompanyId": None, "Purchased": 1}, {"PolicyLinkID": 9, "Purchased": 1})
    flags = {(r.PolicyLinkID, r.CompanyId): r.PurchasedFinal for r in rows}
    assert flags == {(None, 7): None, (1, None): None, (9, 7000000): 1}


def test_ids_of_one_name_are_separate_quotes(spark):
    rows = cleaned(spark, {"CompanyId": 7000002}, {"CompanyId": 7000003}, {"CompanyId": 55})
    assert sorted((r.CompanyId, r.CompanyName) for r in rows) == [(55, "55"), (7000002, "UIC"), (7000003, "UIC")]


def test_names_belong_to_their_state(spark):
    [kept] = cleaned(spark, {"State_Name": "AZ"})
    assert kept.CompanyName == "7000000"


def test_no_configured_names(spark):
    rows = rates.with_company_name(frames.rate(spark, {}), MarketConfig(company_names={}))
    assert rows.first().CompanyName == "7000000"


def test_zero_premium_with_dollar_code_has_no_plan(spark):
    assert cleaned(spark, {"TotalPremium": 0, "PercentDown": 250.0, "NumOfPayments": 4}) == []


def test_dollar_code_repaired_to_everything_is_full_pay(spark):
    [kept] = cleaned(spark, {"TotalPremium": 100, "DownPayment": 100, "PercentDown": 100.5, "NumOfPayments": 5})
    assert (kept.PayPlan, kept.PercentDown) == ("Full pay", 100.0)


def test_almost_everything_down_keeps_its_payments(spark):
    assert cleaned(spark, {"PercentDown": 99.99, "NumOfPayments": 5}) == []
    [kept] = cleaned(spark, {"PercentDown": 99.99, "NumOfPayments": 0})
    assert kept.PayPlan == "Full pay"


def test_cube_order_is_the_head_of_the_whole_order(spark):
    rows = frames.rate(spark, *[
        {"RateIteration": i % 2, "TotalPremium": 100 + i % 3, "RateId": 10 - i, "Term": 6 + i % 2 * 6} for i in range(9)
    ])
    whole = rates.clean_rates(rows, CONFIG).select(*rates.QUOTE, *rates.EARLIEST_FOR_CUBE).collect()
    short = rates.clean_rates(rows, CONFIG, rates.EARLIEST_FOR_CUBE).select(
        *rates.QUOTE, *rates.EARLIEST_FOR_CUBE).collect()
    assert whole == short
