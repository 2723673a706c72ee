"""Reading the four fact tables: partitioned parquet, JDBC, dump files."""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quotelens import fixed_values as fixed
from quotelens.schemas import FACTS, NEEDED, SLICE, SLICE_FIELDS, fact_schema

Slice = tuple[str, str]


def check_slice(state: str, month: str) -> Slice:
    """Two capital letters and six digits, or an error."""
    if not re.fullmatch(fixed.STATE_PATTERN, state):
        raise ValueError(f"state must be two capital letters, got {state!r}")
    if not re.fullmatch(fixed.MONTH_PATTERN, month):
        raise ValueError(f"month must be six digits, got {month!r}")
    return state, month


def _by_state(slices: Iterable[Slice]) -> dict[str, list[str]]:
    grouped: dict[str, list[str]] = {}
    for state, month in slices:
        check_slice(state, month)
        grouped.setdefault(state, []).append(month)
    return {state: sorted(set(months)) for state, months in sorted(grouped.items())}


def in_slices(slices: Iterable[Slice]) -> Column:
    """Condition for a set of (state, month) slices; prunes partitions when pushed to a scan."""
    state, month = (F.col(name) for name in SLICE)
    per_state = [(state == code) & month.isin(months) for code, months in _by_state(slices).items()]
    return reduce(Column.__or__, per_state, F.lit(False))


def fetch(table: DataFrame, columns: Iterable[str], state: str, month: str) -> DataFrame:
    """The given columns of one slice of a fact table."""
    return table.where(in_slices([(state, month)])).select(*columns)


def fetch_table(table: DataFrame, name: str, state: str, month: str) -> DataFrame:
    """All columns of the named fact table for one slice."""
    return fetch(table, FACTS[name].fieldNames(), state, month)


_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet under a path with the given schema; no rows if the path does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in _NOTHING_THERE:
            raise
        return spark.createDataFrame([], schema)


def _listed(spark: SparkSession, folder: str) -> DataFrame | None:
    """Paths of the files under a folder, none opened; None if there is no such folder."""
    try:
        return spark.read.format("binaryFile").load(folder).select("path")
    except AnalysisException as error:
        if error.getCondition() not in _NOTHING_THERE:
            raise
        return None


#: Footers that the driver asks for at the same time.
_FOOTERS = 16


def _read_alike(spark: SparkSession, name: str, paths: list[str], slices_in: str | None = None) -> list[DataFrame]:
    """The paths, one per slice, read in one scan for each set of stored types among them.

    A column may be a whole number in one slice and a double in the next, or lack in
    some: a single scan would take the types of one file for all. `slices_in` is the
    folder whose subfolders name the slices.
    """
    columns = FACTS[name].fieldNames()

    def stored(path: str) -> T.StructType:
        found = spark.read.parquet(path).schema
        return T.StructType([found[c] for c in columns if c in found.names])

    with ThreadPoolExecutor(_FOOTERS) as pool:
        schemas = list(pool.map(stored, paths))
    alike: dict[str, tuple[T.StructType, list[str]]] = {}
    for path, schema in zip(paths, schemas):
        lacking = [c for c in NEEDED[name] if c not in schema.names]
        if lacking:
            raise ValueError(f"{name}: {path} lacks {', '.join(lacking)}")
        alike.setdefault(schema.simpleString(), (schema, []))[1].append(path)
    reader = spark.read if slices_in is None else spark.read.option("basePath", slices_in)
    more = [] if slices_in is None else SLICE_FIELDS
    return [reader.schema(T.StructType(schema.fields + more)).parquet(*group) for schema, group in alike.values()]


def _together(spark: SparkSession, name: str, parts: list[DataFrame]) -> DataFrame:
    conformed = [_conform(part, name) for part in parts]
    return reduce(DataFrame.unionByName, conformed) if conformed else spark.createDataFrame([], fact_schema(name))


_SLICE_FOLDER = r"^(.*/State_Name=[^/]+/Year_Month=[^/]+)/[^/]+$"


def read_facts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Fact tables stored as `<root>/<table>/State_Name=.../Year_Month=...`.

    Stored types may differ from the schema and between slices (timestamps for
    dates, doubles for money or whole numbers). The files of one slice are written
    by one job and share their types. A needed column that a slice lacks is an
    error, another one is null there; missing tables are empty.
    """
    facts = {}
    for name in FACTS:
        files = _listed(spark, f"{root}/{name}")
        # One row per slice.
        found = [] if files is None else [
            r[0] for r in files.select(F.regexp_extract("path", _SLICE_FOLDER, 1)).distinct().collect()
        ]
        if "" in found:
            raise ValueError(f"{name}: files outside the folders of a state and month")
        facts[name] = _together(spark, name, _read_alike(spark, name, sorted(found), f"{root}/{name}"))
    return facts


def scan_slices(spark: SparkSession, root: str) -> DataFrame:
    """Slices of the partitioned quote table, from its folders alone: one row per file, none opened."""
    files = _listed(spark, f"{root}/rate")
    if files is None:
        return spark.createDataFrame([], T.StructType(SLICE_FIELDS))
    return _slices_in(files, "/State_Name=([A-Z]{2})/Year_Month=([0-9]{6})/")


def _slices_in(files: DataFrame, pattern: str) -> DataFrame:
    return (
        files.where(F.col("path").rlike(pattern))
        .select(F.regexp_extract("path", pattern, 1).alias("State_Name"),
                F.regexp_extract("path", pattern, 2).alias("Year_Month"))
        .distinct().orderBy(*SLICE)
    )


def write_facts(facts: dict[str, DataFrame], root: str) -> None:
    """Store fact tables in the layout `read_facts` reads."""
    for name, table in facts.items():
        (table.select(*fact_schema(name).fieldNames()).hint("rebalance", *SLICE)
         .write.partitionBy(*SLICE).mode("overwrite").parquet(f"{root}/{name}"))


# --- JDBC ------------------------------------------------------------------

def slice_conditions(slices: Iterable[Slice]) -> list[str]:
    """One SQL condition per slice; each becomes a task of the JDBC scan."""
    return [
        f"State_Name = '{state}' AND Year_Month = '{month}'"
        for state, months in _by_state(slices).items() for month in months
    ]


def discovery_query(schema_name: str = "dbo", sample_percent: float | None = None) -> str:
    """The statement by which a database lists its slices; a sample of its pages may miss rare ones."""
    state, month = SLICE
    table = f"{schema_name}.{fixed.DUMP_TABLES['rate']}"
    if sample_percent is not None:
        if not 0 < sample_percent <= 100:
            raise ValueError(f"sample must be above 0 and at most 100 percent, got {sample_percent!r}")
        table += f" TABLESAMPLE ({sample_percent:g} PERCENT)"
    return f"SELECT DISTINCT RTRIM({state}) AS {state}, RTRIM({month}) AS {month} FROM {table}"


def discover_jdbc(
    spark: SparkSession, url: str, *,
    schema_name: str = "dbo", sample_percent: float | None = None, properties: dict[str, str] | None = None,
) -> DataFrame:
    """Slices of a database. It does the work itself and returns one row per state and month."""
    query = f"({discovery_query(schema_name, sample_percent)}) slices"
    return spark.read.jdbc(url, query, properties=properties).orderBy(*SLICE)


def read_jdbc(
    spark: SparkSession, url: str, slices: Iterable[Slice], *,
    schema_name: str = "dbo", properties: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Fact tables of the given slices over JDBC; only used columns are transferred.

    The source is scanned once per slice and table, so the slices run in
    parallel as far as the source allows.
    """
    conditions = slice_conditions(slices)
    facts = {}
    for name, table in fixed.DUMP_TABLES.items():
        rows = spark.read.jdbc(url, f"{schema_name}.{table}", predicates=conditions, properties=properties)
        facts[name] = _conform(rows.withColumns({c: F.rtrim(c) for c in SLICE}), name)
    return facts


# --- dump files ------------------------------------------------------------

def _conform(rows: DataFrame, name: str) -> DataFrame:
    """Columns of a fact table in its types. A needed column that the rows lack is an error, others become null."""
    present = set(rows.columns)
    lacking = [c for c in NEEDED[name] if c not in present]
    if lacking:
        raise ValueError(f"{name} lacks {', '.join(lacking)}")
    return rows.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in fact_schema(name).fields
    ])


def _file_pattern(name: str) -> str:
    return rf"{fixed.DUMP_TABLES[name]}_([A-Z]{{2}})_([0-9]{{6}})\.parquet$"


def scan_dump(spark: SparkSession, root: str) -> DataFrame:
    """Slices of a dump, from the names of its quote files."""
    files = _listed(spark, f"{root}/{fixed.DUMP_TABLES['rate']}")
    if files is None:
        return spark.createDataFrame([], T.StructType(SLICE_FIELDS))
    return _slices_in(files, "/" + _file_pattern("rate"))


def read_dump(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Fact tables of a dump with one file per table, state and month.

    The slice of a row is taken from its file name; other files are left out.
    Types may differ between files and columns may lack as in `read_facts`.
    Missing tables are empty.
    """
    facts = {}
    for name, table in fixed.DUMP_TABLES.items():
        files, pattern = _listed(spark, f"{root}/{table}"), _file_pattern(name)
        # One row per slice.
        paths = [] if files is None else [r[0] for r in files.where(F.col("path").rlike("/" + pattern)).collect()]
        file_name = F.col("_metadata.file_name")
        slices = {c: F.regexp_extract(file_name, pattern, i + 1) for i, c in enumerate(SLICE)}
        parts = [part.withColumns(slices) for part in _read_alike(spark, name, sorted(paths))]
        facts[name] = _together(spark, name, parts)
    return facts
