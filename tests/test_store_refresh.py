import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quotelens.operators import catalog, months
from quotelens.operators.cube import monthly_cube
from quotelens.operators.report import ReportFilters
from quotelens.plans import refresh as job
from quotelens.plans.reporting import export_csv, report_states, state_report
from quotelens.schemas import CUBE, FACTS, fact_schema
from quotelens.sources import facts as sources
from quotelens.sources.store import SHUFFLE_CLEANUP, CubeStore
from tests import frames
from verification.mapping import CONFIG, mapped_facts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("facts"))
    sources.write_facts(mapped_facts(spark, SF), root)
    return sources.read_facts(spark, root)


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def slices_of(facts):
    return sorted(tuple(r) for r in months.discover_state_months(facts["rate"]).collect())


def test_partition_columns_stay_text(facts):
    for name, table in facts.items():
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in fact_schema(name)]


def test_missing_tables_are_empty(spark, tmp_path):
    assert all(t.count() == 0 for t in sources.read_facts(spark, str(tmp_path)).values())
    assert all(t.count() == 0 for t in sources.read_dump(spark, str(tmp_path)).values())
    assert sources.scan_dump(spark, str(tmp_path)).count() == 0
    assert sources.scan_slices(spark, str(tmp_path)).count() == 0


def test_folders_and_rows_give_the_same_slices(spark, tmp_path):
    rate = frames.rate(spark, {}, {"Year_Month": "202412"}, {"State_Name": "AZ"})
    sources.write_facts({"rate": rate}, str(tmp_path))
    expected = [("AZ", "202501"), ("IL", "202412"), ("IL", "202501")]
    assert [tuple(r) for r in sources.scan_slices(spark, str(tmp_path)).collect()] == expected
    assert [tuple(r) for r in months.discover_state_months(rate).collect()] == expected


def test_other_stored_types_are_converted(spark, tmp_path):
    rate = frames.rate(spark, {"TotalPremium": "12.34"}).withColumns({
        "RatedDate": F.to_timestamp(F.lit("2025-01-05 10:00:00")), "TotalPremium": F.col("TotalPremium").cast("double"),
    }).drop("AssumedCredit")
    rate.write.partitionBy("State_Name", "Year_Month").parquet(str(tmp_path / "rate"))
    table = sources.read_facts(spark, str(tmp_path))["rate"]
    row = table.first()
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in fact_schema("rate")]
    assert (str(row.RatedDate), float(row.TotalPremium), row.AssumedCredit) == ("2025-01-05", 12.34, None)


def test_a_slice_is_fetched_by_partition(facts):
    table = sources.fetch_table(facts["rate"], "rate", "IL", "202501")
    assert table.columns == FACTS["rate"].fieldNames()
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: []" in plan and "PartitionFilters: []" not in plan


@pytest.mark.parametrize("state, month", [("il", "202501"), ("ILL", "202501"), ("IL", "2025"), ("IL", "2025010"),
                                          ("IL'", "202501"), ("IL", "20250x")])
def test_bad_slices_are_refused(facts, state, month):
    with pytest.raises(ValueError):
        sources.fetch_table(facts["rate"], "rate", state, month)
    with pytest.raises(ValueError):
        sources.slice_conditions([(state, month)])


def test_jdbc_conditions():
    assert sources.slice_conditions([("IL", "202502"), ("AZ", "202501"), ("IL", "202501"), ("IL", "202501")]) == [
        "State_Name = 'AZ' AND Year_Month = '202501'", "State_Name = 'IL' AND Year_Month = '202501'",
        "State_Name = 'IL' AND Year_Month = '202502'"]


def test_refresh_all_then_nothing_is_missing(spark, facts, tmp_path):
    store = CubeStore(spark, str(tmp_path))
    discovered = lambda: months.discover_state_months(facts["rate"])
    assert rows_of(store.monthly()) == [] and rows_of(store.index()) == []
    chosen = job.choose_slices(discovered, store, CONFIG, mode="missing")
    assert chosen == [s for s in slices_of(facts) if s[0] in ("AZ", "IL")]
    result = job.refresh(facts, store, CONFIG, chosen)
    assert result.states == ["AZ", "IL"] and result.cube_rows == store.states().count() > 0
    assert job.choose_slices(discovered, store, CONFIG, mode="missing") == []
    assert job.choose_slices(discovered, store, CONFIG, mode="missing", state="IL") == []
    assert report_states(store) == ["AZ", "IL"]

    before = rows_of(store.states())
    job.refresh(facts, store, CONFIG, chosen[:1])
    assert rows_of(store.states()) == before


def test_month_by_month_equals_all_at_once(spark, facts, tmp_path):
    at_once, in_steps = CubeStore(spark, str(tmp_path / "a")), CubeStore(spark, str(tmp_path / "b"))
    wanted = [s for s in slices_of(facts) if s[0] == "IL"]
    job.refresh(facts, at_once, CONFIG, wanted)
    for one in wanted[::-1]:
        job.refresh(facts, in_steps, CONFIG, [one])
    assert rows_of(at_once.states()) == rows_of(in_steps.states())
    assert rows_of(at_once.index()) == rows_of(in_steps.index())


def test_a_month_without_output_keeps_what_is_stored(spark, facts, tmp_path):
    store = CubeStore(spark, str(tmp_path))
    job.refresh(facts, store, CONFIG, [("IL", "202501")])
    before = rows_of(store.monthly())
    empty = {name: table.limit(0) for name, table in facts.items()}
    job.refresh(empty, store, CONFIG, [("IL", "202501")])
    assert rows_of(store.monthly()) == before


def test_dry_run_writes_nothing(spark, facts, tmp_path):
    store = CubeStore(spark, str(tmp_path / "s"))
    result = job.refresh(facts, store, CONFIG, [("IL", "202501")], dry_run=True, prune=True)
    assert result.cube_rows > 0 and not (tmp_path / "s").exists()


def test_choice_of_slices(spark, facts, tmp_path):
    store = CubeStore(spark, str(tmp_path))
    discovered = lambda: months.discover_state_months(facts["rate"])
    assert job.choose_slices(discovered, store, CONFIG, mode="state", state="TX", months=["202502", "202501"]) == [
        ("TX", "202501"), ("TX", "202502")]
    assert {s for s, _ in job.choose_slices(discovered, store, CONFIG, mode="state", state="TX")} == {"TX"}
    assert {s for s, _ in job.choose_slices(discovered, store, CONFIG, mode="all")} == {"AZ", "IL"}
    for wrong in ({"mode": "state"}, {"mode": "x"}, {"mode": "state", "state": "tx", "months": ["202501"]}):
        with pytest.raises(ValueError):
            job.choose_slices(discovered, store, CONFIG, **wrong)


def test_dry_run_scans_the_facts_once(spark, facts, tmp_path):
    held = lambda: set(spark.sparkContext._jsc.getPersistentRDDs())
    before, scanned = held(), spark.sparkContext.accumulator(0)

    def tally(batches):
        for batch in batches:
            scanned.add(batch.num_rows)
            yield batch

    watched = facts | {"rate": facts["rate"].mapInArrow(tally, facts["rate"].schema)}
    stored = CubeStore(spark, str(tmp_path / "a"))
    wet = job.refresh(facts, stored, CONFIG, [("IL", "202501")])
    dry = job.refresh(facts, CubeStore(spark, str(tmp_path / "b")), CONFIG, [("IL", "202501")], dry_run=True)
    assert dry.cube_rows == wet.cube_rows and held() == before
    job.refresh(watched, CubeStore(spark, str(tmp_path / "c")), CONFIG, [("IL", "202501")], dry_run=True)
    assert scanned.value == facts["rate"].count()


def test_a_dump_gives_all_its_states(spark, facts, tmp_path):
    store = CubeStore(spark, str(tmp_path))
    discovered = lambda: months.discover_state_months(facts["rate"])
    every = job.choose_slices(discovered, store, CONFIG, mode="all", active_only=False)
    assert every == slices_of(facts) and "TX" in {s for s, _ in every}
    two = job.choose_slices(discovered, store, CONFIG, mode="state", state=["TX", "AZ"])
    assert two == [s for s in every if s[0] in ("AZ", "TX")]


@pytest.mark.parametrize("wrong", [
    ["--store", "x"], ["--facts", "x", "--jdbc", "y", "--store", "z"], ["--jdbc", "y", "--dump", "--store", "z"],
    ["--facts", "x", "--sample", "1", "--store", "z"]])
def test_sources_of_the_command_line(wrong):
    with pytest.raises(SystemExit):
        job.main(wrong)


def test_sampled_discovery_finds_no_other_slices(facts):
    found = {tuple(r) for r in months.discover_state_months(facts["rate"], sample_percent=50).collect()}
    assert found and found <= set(slices_of(facts))


def test_prune(spark, facts, tmp_path):
    store = CubeStore(spark, str(tmp_path))
    job.refresh(facts, store, CONFIG, [s for s in slices_of(facts) if s[1] == "202501"])
    assert store.prune_inactive(CONFIG, dry_run=True) == ["TX"]
    assert {r.state for r in store.index().collect()} == {"AZ", "IL", "TX"}
    source = store.index_source()
    assert store.prune_inactive(CONFIG) == ["TX"]
    assert source and store.index_source() == source
    for kept in (store.monthly(), store.states(), store.index().withColumnRenamed("state", "State")):
        assert {r.State for r in kept.select("State").distinct().collect()} == {"AZ", "IL"}
    assert store.prune_inactive(CONFIG) == []


def test_catalogue_document(spark, facts, tmp_path):
    store = CubeStore(spark, str(tmp_path))
    job.refresh(facts, store, CONFIG, [("IL", "202501"), ("TX", "202502")])
    job.refresh(facts, store, CONFIG, [("IL", "202502")])
    [part] = Path(store.index_folder()).glob("part-*")
    document = json.loads(part.read_text())
    assert set(document) == {"generated_at", "source", "states"} and set(document["states"]) == {"IL", "TX"}
    entry = document["states"]["IL"]
    assert list(entry) == ["state", "rows", "months", "companies", "counties", "curated", "comparison_company",
                           "our_companies"]
    assert entry["months"] == [202501, 202502] and entry["comparison_company"] == "UIC" and entry["curated"]
    assert document["states"]["TX"]["comparison_company"] is None and document["states"]["TX"]["our_companies"] == []


def test_broken_catalogue_reads_as_empty(spark, tmp_path):
    store = CubeStore(spark, str(tmp_path))
    Path(store.index_folder()).mkdir()
    (Path(store.index_folder()) / "part-0").write_text("{broken")
    assert store.index().collect() == []


def test_state_report_and_csv(spark, facts, tmp_path):
    store = CubeStore(spark, str(tmp_path))
    job.refresh(facts, store, CONFIG, [("IL", "202501"), ("TX", "202501")])
    made = state_report(store, "IL", CONFIG, ReportFilters(term=12))
    assert "VsCompareCo" in made.columns and {r.State for r in made.collect()} == {"IL"}
    assert "VsCompareCo" not in state_report(store, "TX", CONFIG).columns
    export_csv(made, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == made.columns and back.count() == made.count()
    with pytest.raises(ValueError):
        state_report(store, "ZZ", CONFIG)
    store.register_view("IL", "one_state")
    assert spark.sql("SELECT count(*) FROM one_state").first()[0] == store.states().where(F.col("State") == "IL").count()


def test_dump_files_give_the_same_cube(spark, facts, tmp_path):
    from quotelens import fixed_values as fixed
    wanted = [("IL", "202501"), ("AZ", "202502")]
    for name, table in fixed.DUMP_TABLES.items():
        folder = tmp_path / table
        folder.mkdir()
        for state, month in wanted:
            # Dumps hold no slice columns and plain doubles.
            rows = sources.fetch_table(facts[name], name, state, month).toPandas()
            for column in rows.columns:
                if column.endswith("Premium") or column == "DownPayment":
                    rows[column] = rows[column].astype(float)
            rows.to_parquet(folder / f"{table}_{state}_{month}.parquet")
    (tmp_path / "fact_Rate" / "fact_Rate_notes.parquet").write_bytes(
        (tmp_path / "fact_Rate" / "fact_Rate_IL_202501.parquet").read_bytes())
    assert [tuple(r) for r in sources.scan_dump(spark, str(tmp_path)).collect()] == sorted(wanted)
    dump = sources.read_dump(spark, str(tmp_path))
    where = sources.in_slices(wanted)
    build = lambda f: monthly_cube(*(f[n].where(where) for n in ("rate", "car", "driver")), CONFIG)
    assert rows_of(build(dump)) == rows_of(build(facts))


def test_command_line(spark, facts, tmp_path, capsys):
    root, store = str(tmp_path / "facts"), str(tmp_path / "store")
    sources.write_facts({n: t.where("State_Name = 'IL'") for n, t in facts.items()}, root)
    assert job.main(["--facts", root, "--store", store, "--mode", "discover"]) == 0
    assert "202504" in capsys.readouterr().out
    assert job.main(["--facts", root, "--store", store, "--mode", "state", "--state", "IL", "--months", "202501"]) == 0
    assert job.main(["--facts", root, "--store", store]) == 0
    assert "3 slices" in capsys.readouterr().out
    assert job.main(["--facts", root, "--store", store]) == 0
    assert "nothing to refresh" in capsys.readouterr().out


def test_top_stats_and_selectors(spark):
    cube = frames.cube(spark, {}, {"CompanyName": "Other", "YYYYMM": 202503}, {"CompanyName": "123"})
    index = catalog.state_index(cube, CONFIG)
    sums = cube.groupBy("State", "CompanyName").agg(F.sum("Quotes").cast("double").alias("Quotes"))
    [row] = catalog.top_stats(index, sums).collect()
    assert tuple(row) == ("IL", 3.0, "01/2025", "03/2025", 2, 1)
    choices = catalog.selector_values()
    assert choices["premium"][0] == 0 and choices["premium"][-1] == 5500 and len(choices["premium"]) == 12
    assert choices["credit"][0] == 600 and choices["credit"][-1] == 1750 and choices["num_vehicles"][-1] == "5+"


def write_slices(frame, folder, slices):
    """Each slice as it is stored, with types and columns of its own."""
    for (state, month), columns in slices.items():
        frame.select(*columns).write.parquet(f"{folder}/State_Name={state}/Year_Month={month}")


@pytest.mark.parametrize("dump", [False, True])
def test_slices_of_other_types_and_columns_are_read_together(spark, tmp_path, dump):
    from quotelens import fixed_values as fixed
    driver = frames.driver(spark, {"Age": 41}, {"Age": None, "RateLinkID": 2}).drop("State_Name", "Year_Month")
    whole = driver.columns
    ways = {
        ("AZ", "202501"): [F.col("Age").cast("double").alias("Age") if c == "Age" else c for c in whole],
        ("IL", "202501"): [F.col("Age").cast("long").alias("Age") if c == "Age" else c for c in whole],
        ("IL", "202502"): [c for c in whole if c != "Age"],
    }
    if dump:
        table = fixed.DUMP_TABLES["driver"]
        (tmp_path / table).mkdir()
        for (state, month), columns in ways.items():
            import pyarrow.parquet as pq
            pq.write_table(driver.select(*columns).toArrow(), tmp_path / table / f"{table}_{state}_{month}.parquet")
        read = sources.read_dump(spark, str(tmp_path))["driver"]
    else:
        write_slices(driver, tmp_path / "driver", ways)
        read = sources.read_facts(spark, str(tmp_path))["driver"]
    assert [(f.name, f.dataType) for f in read.schema] == [(f.name, f.dataType) for f in fact_schema("driver")]
    found = sorted((r.State_Name, r.Year_Month, r.RateLinkID, r.Age) for r in read.collect())
    assert found == [("AZ", "202501", 1, 41), ("AZ", "202501", 2, None), ("IL", "202501", 1, 41),
                     ("IL", "202501", 2, None), ("IL", "202502", 1, None), ("IL", "202502", 2, None)]
    assert read.where(sources.in_slices([("IL", "202501")])).count() == 2


def test_a_needed_column_that_one_slice_lacks_is_an_error(spark, tmp_path):
    rate = frames.rate(spark, {}).drop("State_Name", "Year_Month")
    write_slices(rate, tmp_path / "rate", {
        ("AZ", "202501"): rate.columns, ("IL", "202501"): [c for c in rate.columns if c != "PercentDown"]})
    with pytest.raises(ValueError, match="IL.*PercentDown"):
        sources.read_facts(spark, str(tmp_path))


def test_every_table_prunes_partitions(facts):
    for name, table in facts.items():
        plan = sources.fetch_table(table, name, "IL", "202501")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(State_Name" in plan, plan


def test_discovery_in_a_database_is_one_statement():
    assert sources.discovery_query() == (
        "SELECT DISTINCT RTRIM(State_Name) AS State_Name, RTRIM(Year_Month) AS Year_Month FROM dbo.fact_Rate")
    assert sources.discovery_query("x", 1).endswith("FROM x.fact_Rate TABLESAMPLE (1 PERCENT)")
    with pytest.raises(ValueError):
        sources.discovery_query(sample_percent=0)


def test_a_cube_is_written_without_a_shuffle(spark, tmp_path):
    """Each task writes its own rows, so as many files lie in a month as tasks had some of it."""
    store = CubeStore(spark, str(tmp_path))
    row = {f.name: None for f in CUBE.fields} | {"State": "IL", "YYYYMM": 202501, "RateSource": "ITC", "Quotes": 1}
    cube = spark.createDataFrame([row | {"PremBin": n} for n in range(4)], CUBE).repartition(4)
    places = store.stage("monthly", cube)
    [version] = places["IL"].values()
    month = tmp_path / "versions" / "monthly_cube" / f"version={version}" / "State=IL" / "YYYYMM=202501"
    held = cube.select(F.spark_partition_id()).distinct().count()
    assert len(list(month.glob("*.parquet"))) == held > 1
    assert sorted(r.PremBin for r in store.read("monthly", places).collect()) == [0, 1, 2, 3]


def test_shuffle_files_go_when_a_cube_is_written(spark, tmp_path):
    """Spark else keeps them beside the next cube's, until the JVM has collected their plan."""

    def files():
        kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {kept.apply(i).getName() for i in range(kept.size()) if kept.apply(i).getName().endswith(".data")}

    rows = frames.cube(spark, *[{"PremBin": n} for n in range(40)]).repartition(4)
    before, setting = files(), spark.conf.get(SHUFFLE_CLEANUP)
    places = CubeStore(spark, str(tmp_path)).stage("monthly", rows)
    for _ in range(50):  # they are deleted in the background
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before and spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert CubeStore(spark, str(tmp_path)).read("monthly", places).count() == 40
    assert rows.count() == 40
