"""The four fact tables as a projection of the test tables.

The test tables hold no insurance data, so quotes, vehicles, drivers and
violations are derived from lineitem, orders and customer. The text runs
unchanged in Spark SQL and in the oracle, as the head of a longer query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from quotelens.config import MarketConfig
from quotelens.schemas import FACTS

# Company ids of the mapped quotes are 7000000 to 7000023.
CONFIG = MarketConfig(
    company_names={
        "IL": {
            7000000: "National", 7000001: "Progressive", 7000002: "UIC", 7000003: "UIC",
            7000004: "SIC", 7000005: "GEICO", 7000006: "Kemper",
        },
        "AZ": {
            7000000: "NatGen", 7000001: "Progressive", 7000002: "SunCoast", 7000003: "SIC",
            7000004: "AssuranceAmerica", 7000005: "AssuranceAmerica",
        },
    },
)

FACTS_SQL = """\
WITH plans AS (
  SELECT * FROM (VALUES
    (0, 16.7, 5), (1, 16.1, 5), (2, 100.0, 0), (3, 100.0, 5), (4, 8.3, 11), (5, 20.3, 5),
    (6, 25.0, 4), (7, 25.0, 3), (8, 50.0, 1), (9, 25.0, 5), (10, 20.0, 4), (11, 10.0, 11),
    (12, 22.0, 5), (13, 41.7, 4), (14, 30.0, 4), (15, 40.0, 2), (16, 33.3, 5), (17, 250.0, 4)
  ) AS p(i, pct, n)),
base AS (
  SELECT l.*, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, o.o_custkey, c.c_nationkey, c.c_mktsegment
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN customer c ON o.o_custkey = c.c_custkey),
fx_rate AS (
  SELECT CASE c_nationkey % 3 WHEN 0 THEN 'IL' WHEN 1 THEN 'AZ' ELSE 'TX' END AS State_Name,
         CAST(202501 + o_custkey % 4 AS STRING)                               AS Year_Month,
         o_custkey                                                            AS PolicyLinkID,
         l_orderkey                                                           AS RateId,
         7000000 + l_suppkey % 24                                             AS CompanyId,
         l_linenumber                                                         AS RateIteration,
         make_date(2025, CAST(1 + (o_custkey + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) % 4 AS INT), 5) AS RatedDate,
         CAST(CAST((cents - cents % 15) / 15 AS BIGINT) / 100 AS DECIMAL(12,2))                          AS TotalPremium,
         CAST(CAST((cents - cents % 60) / 60 AS BIGINT) / 100 AS DECIMAL(12,2))                          AS DownPayment,
         CAST(p.pct AS DOUBLE)                                                AS PercentDown,
         p.n                                                                  AS NumOfPayments,
         CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN 1 ELSE 0 END AS Purchased,
         CASE WHEN o_custkey % 50 = 7 THEN CAST(l_orderkey % 2 AS INT)
              WHEN o_custkey % 10 = 0 THEN 1 WHEN o_custkey % 10 = 1 THEN NULL ELSE 0 END AS NonOwner,
         CASE WHEN o_custkey % 40 = 3 THEN CAST(l_linenumber % 2 AS INT) ELSE 1 END       AS AssumedCredit,
         CASE WHEN l_linestatus = 'F' THEN 6 ELSE 12 END                      AS Term,
         CASE WHEN l_suppkey % 7 = 0 THEN 'EZ Lynx' WHEN l_suppkey % 7 = 1 THEN NULL WHEN l_suppkey % 7 = 2 THEN ' '
              WHEN l_suppkey % 7 = 3 THEN ' ITC ' ELSE 'ITC' END              AS Rate_Source
  FROM base JOIN plans p ON p.i = CASE WHEN o_custkey % 2 = 0 THEN l_partkey % 18 ELSE l_partkey % 3 END),
fx_car AS (
  SELECT CASE c_nationkey % 3 WHEN 0 THEN 'IL' WHEN 1 THEN 'AZ' ELSE 'TX' END AS State_Name,
         CAST(202501 + o_custkey % 4 AS STRING) AS Year_Month,
         l_orderkey AS RateLinkID, l_partkey AS RateVehicleId,
         CASE WHEN l_orderkey % 17 = 0 AND l_linenumber = 1 THEN 15
              WHEN (l_orderkey + l_partkey) % 3 = 0 THEN 25 WHEN (l_orderkey + l_partkey) % 3 = 1 THEN 50 ELSE 100 END AS LiabLimits1,
         CASE WHEN (l_orderkey + l_partkey) % 3 = 0 THEN 50 WHEN (l_orderkey + l_partkey) % 3 = 1 THEN 100 ELSE 300 END AS LiabLimits2,
         CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE CAST(2003 + l_partkey % 23 AS INT) END AS Year,
         CASE WHEN (c_nationkey + l_partkey) % 11 = 0 THEN '  ' WHEN (c_nationkey + l_partkey) % 11 = 1 THEN NULL
              ELSE concat(' ', lower(c_mktsegment), ' ', CAST(c_nationkey % 4 AS STRING)) END AS County,
         CAST(CAST((cents - cents % 60) / 60 AS BIGINT) / 100 AS DECIMAL(12,2)) AS LiabBIPremium,
         CAST(CAST((cents - cents % 90) / 90 AS BIGINT) / 100 AS DECIMAL(12,2)) AS LiabPDPremium,
         CAST(CAST((cents - cents % 120) / 120 AS BIGINT) / 100 AS DECIMAL(12,2)) AS CompPremium,
         CAST(CAST((cents - cents % 150) / 150 AS BIGINT) / 100 AS DECIMAL(12,2)) AS CollPremium,
         CAST(CAST((cents - cents % 180) / 180 AS BIGINT) / 100 AS DECIMAL(12,2)) AS MedPayPremium,
         CAST(CAST((cents - cents % 200) / 200 AS BIGINT) / 100 AS DECIMAL(12,2)) AS UIMBIPremium,
         CAST(CAST((cents - cents % 240) / 240 AS BIGINT) / 100 AS DECIMAL(12,2)) AS UIMPDPremium,
         CAST(CAST((cents - cents % 300) / 300 AS BIGINT) / 100 AS DECIMAL(12,2)) AS UninsBIPremium,
         CAST(CAST((cents - cents % 360) / 360 AS BIGINT) / 100 AS DECIMAL(12,2)) AS UninsPDPremium
  FROM base),
fx_driver AS (
  SELECT DISTINCT CASE c_nationkey % 3 WHEN 0 THEN 'IL' WHEN 1 THEN 'AZ' ELSE 'TX' END AS State_Name,
         CAST(202501 + o_custkey % 4 AS STRING) AS Year_Month,
         l_orderkey AS RateLinkID, l_orderkey * 10 + l_linenumber AS RateDriverId,
         CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 1 ELSE 0 END AS PriorInsurance,
         CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE CAST(16 + (l_orderkey * 7 + l_linenumber) % 70 AS INT) END AS Age,
         CASE WHEN l_linenumber = 2 THEN 'I' WHEN l_linenumber = 3 THEN NULL ELSE 'S' END AS Relation,
         CASE WHEN l_orderkey % 2 = 0 THEN 'O' ELSE 'R' END AS ResidencyStatus,
         CAST(l_orderkey % 20 AS INT) AS PriorMonthsCovg,
         CASE WHEN l_orderkey % 4 = 0 THEN 12 ELSE 0 END AS PriorDaysLapse
  FROM base WHERE l_linenumber <= 5 AND l_orderkey % 23 <> 0),
fx_violation AS (
  SELECT CASE c_nationkey % 3 WHEN 0 THEN 'IL' WHEN 1 THEN 'AZ' ELSE 'TX' END AS State_Name,
         CAST(202501 + o_custkey % 4 AS STRING) AS Year_Month,
         l_orderkey * 10 + l_linenumber AS RateDriverLinkId,
         CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS AtFault
  FROM base WHERE l_returnflag = 'A')
"""

SOURCE_TABLES = ["lineitem", "orders", "customer"]

# The joins of `base`, and the same joins with the narrow tables first: the wide rows are then shuffled once, by
# the order, which vehicles are grouped by. Quotes are grouped by the customer, the last key of the joins as written.
JOINS = """\
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN customer c ON o.o_custkey = c.c_custkey"""
NARROW_FIRST = "FROM lineitem l JOIN (orders o JOIN customer c ON o.o_custkey = c.c_custkey) ON l.l_orderkey = o.o_orderkey"

# Line items as the joins carry them: the price is cut to cents before it is shuffled, and quotes need parts and
# suppliers only by their remainders, of which those of 18 and 168 = 24 * 7 hold all that is taken.
CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT) AS cents"
CENTS_OF_BASE = f" {CENTS},"
CAR_LINES = f"SELECT l_orderkey, l_partkey, l_linenumber, {CENTS} FROM lineitem"
PURCHASED = "CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN 1 ELSE 0 END"
TERM = "CASE WHEN l_linestatus = 'F' THEN 6 ELSE 12 END"
RATE_LINES = (
    "SELECT l_orderkey, l_partkey % 18 AS l_partkey, l_suppkey % 168 AS l_suppkey, l_linenumber,"
    f" {PURCHASED} AS purchased, {TERM} AS term, {CENTS} FROM lineitem"
)

# Drivers are distinct, and all of a driver follows from its slice, order and line number. So lines and slices of
# orders are made distinct, each on its side of the join, and the rest is derived from what they give.
DRIVER_BASE = """\
base AS (
  SELECT l_orderkey, l_linenumber, c_nationkey, o_custkey
  FROM (SELECT DISTINCT l_orderkey, l_linenumber
        FROM (SELECT l_orderkey, l_linenumber FROM lineitem
              WHERE l_linenumber <= 5 AND l_orderkey % 23 <> 0 DISTRIBUTE BY l_orderkey))
  JOIN (SELECT DISTINCT o_orderkey, c_nationkey, o_custkey
        FROM (SELECT o_orderkey, o_custkey % 4 AS o_custkey,
                     CASE c_nationkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS c_nationkey
              FROM orders JOIN customer ON o_custkey = c_custkey DISTRIBUTE BY o_orderkey))
  ON l_orderkey = o_orderkey),
"""

#: Line items of one task, in tables of more than MANY_LINES, for the facts that are grouped by the order, and for
#: quotes that are spread by their policy beside them. Adaptive execution would gather many millions of these narrow
#: rows in a task, and what it sorts there would spill.
TASK_LINES = 500_000
MANY_LINES = 4_000_000


def _spread(spark: SparkSession, lineitem: DataFrame) -> int | None:
    """How many partitions the lines are spread over by their order; None leaves it to Spark."""
    lines = lineitem.count()  # from the footers
    if lines <= MANY_LINES:
        return None
    return max(lines // TASK_LINES, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _text(name: str, partitions: int | None, by_policy: bool = False) -> str:
    """The rows of one fact as Spark derives them: those of FACTS_SQL, with less of them carried."""
    plans, base, *facts = re.split(r"\n(?=base AS \(|fx_\w+ AS \()", FACTS_SQL.rstrip() + ",")
    [fact] = [f for f in facts if f.startswith(f"fx_{name} ")]
    if name == "driver":
        base, fact = DRIVER_BASE.rstrip(), fact.replace("SELECT DISTINCT", "SELECT", 1)
        if partitions:
            for key in ("l_orderkey", "o_orderkey"):
                base = base.replace(f"(SELECT {key}, ", f"(SELECT /*+ REPARTITION({partitions}, {key}) */ {key}, ")
                base = base.replace(f" DISTRIBUTE BY {key}", "")
    elif name in ("rate", "car"):
        fact = fact.replace(PURCHASED, "purchased").replace(TERM, "term")
        lines, joins = (RATE_LINES, JOINS) if name == "rate" else (CAR_LINES, NARROW_FIRST)
        if name == "car" and partitions:
            lines = lines.replace("SELECT", f"SELECT /*+ REPARTITION({partitions}, l_orderkey) */", 1)
            joins = joins.replace("(orders o", f"(SELECT /*+ REPARTITION({partitions}, o_orderkey) */ * FROM orders o")
            joins = joins.replace(") ON", ") AS o ON")
            base = base.replace("o.o_custkey, c.c_nationkey, c.c_mktsegment", "o_custkey, c_nationkey, c_mktsegment")
        for old, new in ((CENTS_OF_BASE, ""), (JOINS, joins), ("FROM lineitem l", f"FROM ({lines}) l")):
            base = base.replace(old, new)
        if name == "rate" and by_policy and partitions:
            base = base.replace("SELECT", f"SELECT /*+ REPARTITION({partitions}, o_custkey) */", 1)
        elif name == "rate" and by_policy:
            base = base.removesuffix("),") + " DISTRIBUTE BY o_custkey),"
    return "\n".join([plans, base, fact.removesuffix(",")])


def mapped_facts(spark: SparkSession, sf_dir: str, *names: str, by_policy: bool = False) -> dict[str, DataFrame]:
    """The named fact tables (all four by default) over the test tables of one scale factor.

    Quotes that are to be cleaned are best spread by their policy (`by_policy`) while they are narrow, also where
    customers are broadcast: they are then combined and checked for consistency without a further shuffle.
    """
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in SOURCE_TABLES}
    for name, table in tables.items():
        # Views of the fixture's own, so that a session's views of these names stay. They
        # are resolved when the query is analysed, so reusing their names is safe.
        table.createOrReplaceTempView(f"quotelens_fixture_{name}")
    names = names or tuple(FACTS)
    by_order = any(name in ("car", "driver") for name in names)
    partitions = _spread(spark, tables["lineitem"]) if by_order else None
    found = {}
    for name in names:
        text = _text(name, partitions, by_policy)
        for table in SOURCE_TABLES:
            text = re.sub(rf"\b(FROM |JOIN \(?){table}\b", rf"\1quotelens_fixture_{table}", text)
        found[name] = spark.sql(f"{text} SELECT * FROM fx_{name}")
    return found
