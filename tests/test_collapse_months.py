import pytest
from pyspark.sql import DataFrame, functions as F

from quotelens.config import MarketConfig
from quotelens.operators import collapse, months
from quotelens.schemas import CUBE_KEYS, MEASURES
from tests import frames

CONFIG = MarketConfig(
    company_names={"IL": {1: "UIC"}, "AZ": {1: "SunCoast"}}, exhaustive_states=("IL",), top_counties=2)


def quotes_by(frame, *keys):
    return {tuple(r[:-1]) if len(keys) > 1 else r[0]: r[-1]
            for r in frame.groupBy(*keys).agg(F.sum("Quotes")).collect()}


def unmapped(state, volumes):
    return [{"State": state, "CompanyName": name, "Quotes": q} for name, q in volumes.items()]


def test_exhaustive_state_folds_all_unmapped(spark):
    cube = frames.cube(spark, {"Quotes": 5}, *unmapped("IL", {"11": 9, "12": 1, "Other": 2}))
    assert quotes_by(collapse.company_top_n(cube, CONFIG), "CompanyName") == {"UIC": 5, "Other": 12}


def test_mapped_state_keeps_five_ties_by_name(spark):
    volumes = {str(n): 10 for n in range(101, 107)} | {"99": 50, "Other": 1}
    folded = collapse.company_top_n(frames.cube(spark, *unmapped("AZ", volumes)), CONFIG)
    assert quotes_by(folded, "CompanyName") == {"99": 50, "101": 10, "102": 10, "103": 10, "104": 10, "Other": 21}


def test_other_states_keep_fifteen(spark):
    volumes = {str(n): n for n in range(100, 120)}
    folded = quotes_by(collapse.company_top_n(frames.cube(spark, *unmapped("TX", volumes)), CONFIG), "CompanyName")
    assert set(folded) == {str(n) for n in range(105, 120)} | {"Other"}
    assert folded["Other"] == sum(range(100, 105))


def test_volume_counts_all_months(spark):
    rows = [{"State": "AZ", "CompanyName": str(n), "Quotes": 10} for n in range(100, 105)]
    rows += [{"State": "AZ", "CompanyName": "200", "Quotes": 6, "YYYYMM": m} for m in (202501, 202502)]
    folded = quotes_by(collapse.company_top_n(frames.cube(spark, *rows), CONFIG), "CompanyName")
    assert folded == {"200": 12, "100": 10, "101": 10, "102": 10, "103": 10, "Other": 10}


def test_counties_keep_the_top_and_fold_null(spark):
    rows = [{"County": c, "Quotes": q} for c, q in {"A": 5, "B": 5, "C": 5, None: 90}.items()]
    rows.append({"County": "C", "State": "AZ", "Quotes": 1})
    folded = quotes_by(collapse.county_top_n(frames.cube(spark, *rows), CONFIG), "State", "County")
    assert folded == {("IL", "A"): 5, ("IL", "B"): 5, ("IL", "Other"): 95, ("AZ", "C"): 1}


def test_state_cube_equals_both_steps_and_keeps_every_measure(spark):
    rows = [
        {"State": s, "CompanyName": c, "County": y, "Quotes": q, "SumPremium": q * 1.1, "Term": t}
        for s in ("IL", "AZ", "TX") for q, (c, y) in enumerate(
            [("UIC", "A"), ("21", "B"), ("22", "C"), ("22", "A"), ("23", "D"), ("Other", None), ("24", "E")], start=1)
        for t in (6, 12, None)
    ]
    cube = frames.cube(spark, *rows)
    at_once = collapse.state_cube(cube, CONFIG)
    in_steps = collapse.county_top_n(collapse.company_top_n(cube, CONFIG), CONFIG)
    assert sorted(map(str, at_once.collect())) == sorted(map(str, in_steps.collect()))
    sums = [F.round(F.sum(m), 2) for m in MEASURES]
    assert at_once.agg(*sums).first() == cube.agg(*sums).first()


def sparse_cube(spark):
    """One row per key; labels that fold, that stay, that are Other or null, and months that are null."""
    rows = [
        {"State": s, "YYYYMM": m, "CompanyName": c, "County": y, "Quotes": q, "SumPremium": q * 1.1, "SumCompPremium": None}
        for s in ("IL", "AZ", None) for m in (202501, 202502, None) for q, (c, y) in enumerate(
            [("UIC", "A"), ("UIC", "B"), ("UIC", "C"), ("UIC", None), ("21", "B"), ("22", "B"), ("SunCoast", "A"),
             ("23", "D"), ("Other", "A"), (None, "A"), (None, "Other"), ("24", "E"), ("25", "B"), ("26", "B")], start=1)
    ]
    return frames.cube(spark, *rows)


def test_a_distinct_cube_is_folded_alike(spark):
    cube = sparse_cube(spark)
    folded, plain = collapse.state_cube(cube, CONFIG, distinct=True), collapse.state_cube(cube, CONFIG)
    assert folded.columns == plain.columns and 0 < plain.count() < cube.count()
    assert sorted(map(str, folded.collect())) == sorted(map(str, plain.collect()))
    fresh = cube.where("YYYYMM is null or YYYYMM = 202502").withColumn("Quotes", F.col("Quotes") * 3)
    merged = [collapse.merge_folded(plain, fresh, CONFIG, distinct=d) for d in (True, False)]
    assert sorted(map(str, merged[0].collect())) == sorted(map(str, merged[1].collect()))


def test_rows_of_a_cube_may_repeat(spark):
    twice = sparse_cube(spark).union(sparse_cube(spark))
    assert collapse.state_cube(twice, CONFIG).count() == collapse.state_cube(sparse_cube(spark), CONFIG).count()


def test_only_rows_that_fold_are_shuffled(spark, tmp_path):
    """Of a thousand companies in a thousand rows, one folds; the plan as written shuffles all rows to be regrouped."""
    rows = [{"CompanyName": f"Mapped {n}", "County": "A"} for n in range(999)] + [{"CompanyName": "21", "County": "A"}]
    frames.cube(spark, *rows).write.parquet(str(tmp_path / "cube"))
    cube = spark.read.parquet(str(tmp_path / "cube"))

    def shuffled(frame):
        """Rows that meet all their dimensions in a shuffle."""
        sizes, nodes = [], [frame._jdf.queryExecution().optimizedPlan()]
        while nodes:
            node = nodes.pop()
            if node.nodeName() == "Aggregate" and node.groupingExpressions().size() == len(CUBE_KEYS):
                sizes.append(DataFrame(getattr(spark._jvm.org.apache.spark.sql.classic, "Dataset").ofRows(
                    spark._jsparkSession, node.child()), spark).count())
            nodes += [node.children().apply(i) for i in range(node.children().size())]
        return sum(sizes)

    assert shuffled(collapse.state_cube(cube, CONFIG)) == 1000
    assert shuffled(collapse.state_cube(cube, CONFIG, distinct=True)) == 1


def test_top_lists_are_cut_before_the_shuffle(spark):
    plan = collapse.top_counties(frames.cube(spark, {}), CONFIG)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_discovery(spark):
    rate = frames.rate(
        spark, {}, {}, {"Year_Month": "202412 "}, {"State_Name": "AZ"}, {"State_Name": None}, {"Year_Month": None})
    found = months.discover_state_months(rate)
    assert [tuple(r) for r in found.collect()] == [("AZ", "202501"), ("IL", "202412"), ("IL", "202501")]
    assert {r.State: r.months for r in months.state_months(found).collect()} == {
        "AZ": ["202501"], "IL": ["202412", "202501"]}
    assert months.discover_state_months(rate, 100.0).count() == 3
    for percent in (0, -1, 101):
        with pytest.raises(ValueError):
            months.discover_state_months(rate, percent)


def test_upsert_replaces_only_the_fresh_months_and_is_idempotent(spark):
    stored = frames.cube(spark, {"Quotes": 1}, {"Quotes": 2, "YYYYMM": 202502}, {"Quotes": 4, "State": "AZ"})
    fresh = frames.cube(spark, {"Quotes": 7, "YYYYMM": 202502}, {"Quotes": 8, "YYYYMM": 202503})
    once = months.upsert_months(stored, fresh)
    expected = {("IL", 202501): 1, ("IL", 202502): 7, ("IL", 202503): 8, ("AZ", 202501): 4}
    assert quotes_by(once, "State", "YYYYMM") == expected
    assert quotes_by(months.upsert_months(once, fresh), "State", "YYYYMM") == expected


def test_older_parts_get_nulls(spark):
    older = frames.cube(spark, {"Quotes": 3}).drop("County", "CreditBin")
    whole = months.union_months(older, frames.cube(spark, {"YYYYMM": 202502}))
    assert [(r.County, r.CreditBin) for r in whole.orderBy("YYYYMM").collect()] == [(None, None), ("COOK", 900)]
    folded = collapse.county_top_n(whole, CONFIG)
    assert quotes_by(folded, "County") == {"Other": 3, "COOK": 1}


def test_missing_months(spark):
    slices = spark.createDataFrame([("IL", "202501"), ("IL", "202502"), ("AZ", "202501")], "State_Name string, Year_Month string")
    missing = months.missing_months(slices, frames.cube(spark, {}))
    assert sorted(tuple(r) for r in missing.collect()) == [("AZ", 202501), ("IL", 202502)]
