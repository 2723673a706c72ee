import pytest
from pyspark.sql import functions as F

from quotelens.operators import cube as cubes
from quotelens.operators import months
from quotelens.schemas import CUBE, MEASURES, SLICE
from quotelens.sources.facts import in_slices
from tests import frames
from verification.mapping import CONFIG, mapped_facts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def facts(spark):
    cached = {name: table.cache() for name, table in mapped_facts(spark, SF).items()}
    yield cached
    for table in cached.values():
        table.unpersist(blocking=True)


def built(facts):
    return cubes.monthly_cube(facts["rate"], facts["car"], facts["driver"], CONFIG)


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def one(spark, rates=({},), cars=({},), people=({},)):
    return cubes.monthly_cube(
        frames.rate(spark, *rates), frames.car(spark, *cars), frames.driver(spark, *people), CONFIG).collect()


def test_schema(facts):
    assert [(f.name, f.dataType) for f in built(facts).schema] == [(f.name, f.dataType) for f in CUBE]


def test_single_quote(spark):
    [row] = one(spark, rates=[{"Purchased": 1}])
    assert (row.State, row.YYYYMM, row.CompanyName, row.PremBin) == ("IL", 202501, "National", 1000)
    assert (row.Quotes, row.SumPremium, row.BridgingCount, row.SumBridgingPremium) == (1, 1200.0, 1, 1200.0)
    # 865 + insured without lapse 121 + twelve months 0 + three years old 35 + age 40 10 + limits 0 + one vehicle 27
    assert row.CreditBin == 1050 and 865 + 121 + 0 + 35 + 10 + 0 + 27 == 1058


def test_rate_without_drivers_is_kept_without_credit(spark):
    [row] = one(spark, people=[{"RateLinkID": 99}])
    assert (row.NumDrivers, row.PriorInsurance, row.CreditBin) == ("1", 0, None)


def test_rate_without_vehicles_is_dropped(spark):
    assert one(spark, cars=[{"RateLinkID": 99}]) == []


def test_states_without_formula_have_no_credit(spark):
    slices = [{"State_Name": "TX"}]
    [row] = one(spark, rates=slices, cars=slices, people=slices)
    assert row.CreditBin is None and row.CompanyName == "7000000"


def test_null_premium_is_no_quote_but_brings_its_coverages(spark):
    rates = [{"TotalPremium": None}, {"TotalPremium": None, "PolicyLinkID": 2, "Purchased": 1}]
    [row] = one(spark, rates=rates)
    assert (row.PremBin, row.Quotes, row.SumPremium, row.BridgingCount, row.SumBridgingPremium) == (None, 0, 0.0, 1, 0.0)
    assert row.SumCompPremium == 200.0


def test_null_dimensions_are_kept(spark):
    [row] = one(spark, rates=[{"Term": None, "NonOwner": None}], cars=[{"Year": None}])
    assert (row.Term, row.NonOwner, row.YearBin, row.NumVehicles, row.CreditBin) == (None, 0, None, "0", None)


def test_shared_rate_equals_the_plain_join(spark, facts):
    """The eager combination per rate gives what joining quote by quote gives."""
    joined = cubes.rate_car_driver(facts["rate"], facts["car"], facts["driver"], CONFIG)
    plain = joined.agg(F.count("TotalPremium"), F.sum("PurchasedFinal"), F.sum("CompCents"), F.sum("UninsPDCents")).first()
    cube = built(facts).agg(
        F.sum("Quotes"), F.sum("BridgingCount"), F.round(F.sum("SumCompPremium") * 100),
        F.round(F.sum("SumUninsPDPremium") * 100)).first()
    assert list(plain) == [int(v) for v in cube]


def test_hot_rate_is_combined_before_the_join(spark):
    """A rate shared by many policies reaches the join as one row per dimension value."""
    many = [{"PolicyLinkID": i, "TotalPremium": 1200, "Purchased": i % 2} for i in range(500)]
    cleaned = frames.rate(spark, *many)
    from quotelens.operators.rates import clean_rates
    combined = cubes.quotes_by_rate(clean_rates(cleaned, CONFIG)).collect()
    assert [(r.QuoteRows, r.Quotes, r.PremiumCents, r.BridgingCount) for r in combined] == [(500, 500, 60_000_000, 250)]


def test_all_months_at_once_equal_single_months(facts):
    slices = [tuple(r) for r in facts["rate"].select(*SLICE).distinct().collect()]
    parts = []
    for month in sorted({m for _, m in slices}):
        wanted = in_slices([s for s in slices if s[1] == month])
        parts.append(built({name: table.where(wanted) for name, table in facts.items()}))
    assert rows_of(months.union_months(*parts)) == rows_of(built(facts))


def test_result_does_not_depend_on_partitioning(spark, facts):
    expected = rows_of(built(facts))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        shuffled = {name: table.repartition(5) for name, table in facts.items()}
        assert rows_of(built(shuffled)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_plan_stays_in_the_jvm_and_prunes(spark, tmp_path):
    from quotelens.sources.facts import read_facts, write_facts
    write_facts(mapped_facts(spark, SF), str(tmp_path))
    stored = read_facts(spark, str(tmp_path))
    wanted = in_slices([("IL", "202501")])
    plan = built({name: table.where(wanted) for name, table in stored.items()})._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    assert "PartitionFilters: [isnotnull" in plan.replace("PartitionFilters: [(", "PartitionFilters: [isnotnull(")
    assert "RateVehicleId" in plan and "AtFault" not in plan


def test_measures_are_additive(facts):
    cube = built(facts)
    whole = cube.agg(*[F.round(F.sum(m), 2) for m in MEASURES]).first()
    by_state = cube.groupBy("State").agg(*[F.sum(m).alias(m) for m in MEASURES])
    assert by_state.agg(*[F.round(F.sum(m), 2) for m in MEASURES]).first() == whole


def shuffles(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_quotes_are_shuffled_once_for_their_rate(spark):
    """The combination of quotes and the join with the profiles share a shuffle."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    held = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        quotes = cubes.quotes_by_rate(frames.rate(spark, {}).repartition(2).selectExpr(
            "*", "string(CompanyId) CompanyName", "string(NumOfPayments) PayPlan", "Purchased PurchasedFinal"))
        profile = spark.range(3).selectExpr("id % 2 RateId", "string(id) State_Name", "string(id) Year_Month").distinct()
        assert (shuffles(quotes), shuffles(quotes.join(profile, cubes.RATE_KEY))) == (1, 2)
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
