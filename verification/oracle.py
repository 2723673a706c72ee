"""The registered queries once more, as plain SQL on the same tables.

Written against the rules, not against the Spark code: the cleaning uses
windows and row joins where the Spark side aggregates.
"""

from __future__ import annotations

from verification.mapping import CONFIG, FACTS_SQL

COVERAGES = ["LiabBI", "LiabPD", "Comp", "Coll", "MedPay", "UIMBI", "UIMPD", "UninsBI", "UninsPD"]
DIMS = ("CompanyName, PremBin, LiabLimits, PayPlan, NonOwner, NumDrivers, NumVehicles, County, "
        "PriorInsurance, YearBin, Term, CreditBin, RateSource")
DIM_LIST = DIMS.split(", ")
COUNTS = ["Quotes", "BridgingCount"]
MONEY = ["SumPremium", "SumBridgingPremium"] + [f"Sum{c}Premium" for c in COVERAGES]


def dbl(*names: str, of: str = "") -> str:
    return ", ".join(f"CAST({of}{n} AS DOUBLE) AS {n}" for n in names)


def names_values() -> str:
    return ", ".join(
        f"('{s}', {i}, '{n}')" for s, names in CONFIG.company_names.items() for i, n in names.items())


DIMENSION_TABLES = f"""
names AS (SELECT * FROM (VALUES {names_values()}) AS n(State_Name, CompanyId, Name)),
merges AS (SELECT CAST(a AS DOUBLE) AS near, CAST(b AS DOUBLE) AS target FROM (VALUES
  (16.7, 16.66), (16.1, 16.66), (16.0, 16.66), (15.0, 16.66), (17.0, 16.66), (18.0, 16.66),
  (9.0, 8.33), (8.0, 8.33), (8.3, 8.33), (20.3, 20.0)) AS m(a, b)),
plan_dim AS (SELECT CAST(a AS DOUBLE) AS pct, n, label, ord FROM (VALUES
  (8.33, 12, '8% down, 12 payments', 0), (10.0, 12, '10% down, 12 payments', 1),
  (16.66, 6, '17% down, 6 payments', 2), (20.0, 5, '20% down, 5 payments', 3),
  (20.0, 6, '20% down, 6 payments', 4), (22.0, 6, '22% down, 6 payments', 5),
  (25.0, 4, '25% down, 4 payments', 6), (25.0, 5, '25% down, 5 payments', 7),
  (25.0, 6, '25% down, 6 payments', 8), (30.0, 5, '30% down, 5 payments', 9),
  (40.0, 3, '40% down, 3 payments', 10), (41.7, 5, '42% down, 5 payments', 11),
  (50.0, 2, '50% down, 2 payments', 12), (100.0, 1, 'Full pay', 13)) AS p(a, n, label, ord)),
limits AS (SELECT * FROM (VALUES (25, 50, '25/50', 0), (50, 100, '50/100', 100), (100, 300, '100/300', 200))
  AS l(l1, l2, label, pts)),
ages AS (SELECT * FROM (VALUES
  (18, 35, 'NO_PC', -15), (18, 35, 'NO_LAPSE', -15), (18, 35, 'LAPSE', -40),
  (36, 45, 'NO_PC', 0), (36, 45, 'NO_LAPSE', 10), (36, 45, 'LAPSE', -40),
  (46, 55, 'NO_PC', 25), (46, 55, 'NO_LAPSE', 40), (46, 55, 'LAPSE', -40),
  (56, 65, 'NO_PC', 65), (56, 65, 'NO_LAPSE', 85), (56, 65, 'LAPSE', -10),
  (66, 70, 'NO_PC', 100), (66, 70, 'NO_LAPSE', 120), (66, 70, 'LAPSE', 30)) AS a(lo, hi, st, pts))"""


def planned(source: str, result: str) -> str:
    """CTEs that repair the percent and find the plan of the rows of `source`."""
    return f"""
{result}_r AS (SELECT * EXCLUDE (PercentDown), PercentDown AS RawPercent,
    CASE WHEN PercentDown > 100 THEN
      least(greatest(coalesce(round_even(CAST(DownPayment AS DOUBLE) / nullif(CAST(TotalPremium AS DOUBLE), 0) * 100, 0), 0), 0), 100)
      ELSE PercentDown END AS PercentDown FROM {source}),
{result}_n AS (SELECT r.*, coalesce(m.target, round_even(PercentDown * 10, 0) / 10) AS NormalPercent,
    CASE WHEN PercentDown = 100 THEN 1 ELSE NumOfPayments + 1 END AS PaymentCount
    FROM {result}_r r LEFT JOIN merges m ON m.near = round_even(PercentDown * 10, 0) / 10),
{result} AS (SELECT x.*, p.label AS PayPlan FROM {result}_n x
    LEFT JOIN plan_dim p ON p.pct = x.NormalPercent AND p.n = x.PaymentCount)"""


def bad_policies(source: str) -> str:
    return f"""SELECT State_Name, Year_Month, PolicyLinkID FROM {source} WHERE PolicyLinkID IS NOT NULL
    GROUP BY ALL HAVING count(DISTINCT NonOwner) > 1 OR count(DISTINCT AssumedCredit) > 1"""


def consistent(source: str) -> str:
    return f"""SELECT r.* FROM {source} r WHERE NOT EXISTS (SELECT 1 FROM ({bad_policies(source)}) b
    WHERE b.State_Name = r.State_Name AND b.Year_Month = r.Year_Month AND b.PolicyLinkID = r.PolicyLinkID)"""


QUOTE_KEY = "State_Name, Year_Month, PolicyLinkID, CompanyId, PayPlan"
EARLY = ("RateIteration, TotalPremium, RateId, Term, NonOwner, Rate_Source, RatedDate, DownPayment, PercentDown, "
         "NumOfPayments, Purchased, AssumedCredit")


def deduped(source: str) -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in EARLY.split(", "))
    return f"""SELECT * FROM (SELECT *,
      CASE WHEN PolicyLinkID IS NOT NULL AND CompanyId IS NOT NULL THEN max(Purchased) OVER (PARTITION BY {QUOTE_KEY}) END AS PurchasedFinal,
      row_number() OVER (PARTITION BY {QUOTE_KEY} ORDER BY {order}) AS rn
    FROM {source}) WHERE rn = 1"""


CLEAN = f"""{DIMENSION_TABLES},
rated AS (SELECT * FROM fx_rate WHERE year(RatedDate) * 100 + month(RatedDate) = CAST(Year_Month AS INTEGER)),
agreed AS ({consistent('rated')}),
{planned('agreed', 'plans_of')},
kept AS (SELECT * FROM plans_of WHERE PayPlan IS NOT NULL),
dedup AS ({deduped('kept')}),
clean AS (SELECT d.*, coalesce(n.Name, CAST(d.CompanyId AS VARCHAR)) AS CompanyName
  FROM dedup d LEFT JOIN names n ON n.State_Name = d.State_Name AND n.CompanyId = d.CompanyId)"""

COUNTY = r"coalesce(nullif(upper(regexp_replace(County, '^\s+|\s+$', '', 'g')), ''), 'UNKNOWN')"

VEHICLES = f"""
labelled AS (SELECT c.* EXCLUDE (County), l.label AS LiabLimits, {COUNTY} AS County
  FROM fx_car c LEFT JOIN limits l ON l.l1 = c.LiabLimits1 AND l.l2 = c.LiabLimits2),
valid AS (SELECT * FROM labelled v WHERE NOT EXISTS (SELECT 1 FROM labelled b WHERE b.LiabLimits IS NULL
  AND b.State_Name = v.State_Name AND b.Year_Month = v.Year_Month AND b.RateLinkID = v.RateLinkID)),
first_car AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY State_Name, Year_Month, RateLinkID
    ORDER BY RateVehicleId NULLS LAST, LiabLimits, County) AS rn FROM valid) WHERE rn = 1),
cars AS (SELECT v.State_Name, v.Year_Month, v.RateLinkID AS RateId, f.LiabLimits, f.County,
    count(v.Year) AS NumVehicles, max(v.Year) AS Year,
    {', '.join(f'coalesce(sum(v.{c}Premium), 0) AS {c}Premium' for c in COVERAGES)}
  FROM valid v JOIN first_car f USING (State_Name, Year_Month, RateLinkID) GROUP BY ALL)"""

DRIVERS = """
faults AS (SELECT State_Name, Year_Month, RateDriverLinkId AS RateDriverId, max(CASE WHEN AtFault <> 0 THEN 1 ELSE 0 END) AS AtFault
  FROM fx_violation GROUP BY ALL),
flagged AS (SELECT d.*, coalesce(f.AtFault, 0) AS AtFault FROM fx_driver d
  LEFT JOIN faults f USING (State_Name, Year_Month, RateDriverId)),
insured AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY State_Name, Year_Month, RateLinkID
    ORDER BY CASE WHEN Relation IS NOT DISTINCT FROM 'I' THEN 0 ELSE 1 END, RateDriverId NULLS LAST,
      Age NULLS LAST, ResidencyStatus NULLS LAST, PriorMonthsCovg NULLS LAST, PriorDaysLapse NULLS LAST) AS rn
  FROM flagged) WHERE rn = 1),
drivers AS (SELECT f.State_Name, f.Year_Month, f.RateLinkID AS RateId,
    CAST(max(CASE WHEN f.PriorInsurance <> 0 THEN 1 ELSE 0 END) AS INTEGER) AS PriorInsurance,
    CAST(max(f.AtFault) AS INTEGER) AS AtFault, count(f.RateDriverId) AS NumDrivers,
    i.Age AS NamedInsuredAge, i.ResidencyStatus, i.PriorMonthsCovg, i.PriorDaysLapse
  FROM flagged f JOIN insured i USING (State_Name, Year_Month, RateLinkID)
  GROUP BY f.State_Name, f.Year_Month, f.RateLinkID, i.Age, i.ResidencyStatus, i.PriorMonthsCovg, i.PriorDaysLapse)"""

JOINED = """
joined AS (SELECT r.*, c.LiabLimits, c.County, c.NumVehicles AS VehicleCount, c.Year,
    """ + ", ".join(f"c.{c}Premium" for c in COVERAGES) + """,
    coalesce(d.PriorInsurance, 0) AS PriorInsurance, d.NumDrivers AS DriverCount,
    d.NamedInsuredAge, d.ResidencyStatus, d.PriorMonthsCovg, d.PriorDaysLapse
  FROM clean r JOIN cars c USING (State_Name, Year_Month, RateId)
  LEFT JOIN drivers d USING (State_Name, Year_Month, RateId)),
carrier AS (SELECT *, CASE WHEN PriorInsurance = 1 AND coalesce(PriorDaysLapse, 0) = 0 THEN 'NO_LAPSE'
    WHEN PriorInsurance = 1 AND PriorDaysLapse > 0 THEN 'LAPSE' ELSE 'NO_PC' END AS CarrierState FROM joined),
parts AS (SELECT k.*,
    CASE CarrierState WHEN 'NO_LAPSE' THEN 121 WHEN 'LAPSE' THEN -81 ELSE 0 END AS CarrierPoints,
    CASE WHEN PriorInsurance = 0 OR coalesce(PriorMonthsCovg, 0) <= 5 THEN -50
         WHEN PriorMonthsCovg <= 12 THEN 0 ELSE 70 END AS DurationPoints,
    CASE WHEN Year IS NULL THEN 0 WHEN year(RatedDate) - Year < 3 THEN 110
         WHEN year(RatedDate) - Year < 10 THEN 35 ELSE -40 END AS VehicleAgePoints,
    coalesce(a.pts, 0) AS AgePoints, l.pts AS LimitsPoints,
    27 * CASE WHEN VehicleCount > 5 THEN 5 ELSE VehicleCount END AS VehicleCountPoints,
    CASE WHEN ResidencyStatus = 'O' THEN 100 ELSE 0 END AS HomeownerPoints
  FROM carrier k LEFT JOIN ages a ON k.NamedInsuredAge BETWEEN a.lo AND a.hi AND a.st = k.CarrierState
  JOIN limits l ON l.label = k.LiabLimits),
scored AS (SELECT *, CASE WHEN State_Name IN ('IL', 'AZ') AND NamedInsuredAge IS NOT NULL AND Year IS NOT NULL THEN
    CAST(865 + CarrierPoints + DurationPoints + VehicleAgePoints + AgePoints + LimitsPoints + VehicleCountPoints
      + HomeownerPoints AS INTEGER) END AS PredictedCredit FROM parts),
binned AS (SELECT * EXCLUDE (NonOwner), coalesce(NonOwner, 0) AS NonOwner,
    CASE WHEN trim(Rate_Source) <> '' THEN trim(Rate_Source) ELSE 'ITC' END AS RateSource,
    CAST(floor(CASE WHEN TotalPremium > 5000 THEN 5000 ELSE CAST(TotalPremium AS DOUBLE) END / 500) * 500 AS INTEGER) AS PremBin,
    CASE WHEN DriverCount IS NULL THEN '1' WHEN DriverCount >= 4 THEN '4+' ELSE CAST(DriverCount AS VARCHAR) END AS NumDrivers,
    CASE WHEN VehicleCount >= 5 THEN '5+' ELSE CAST(VehicleCount AS VARCHAR) END AS NumVehicles,
    CASE WHEN Year > 0 AND Year <= 2009 THEN 'pre-2010' WHEN Year > 2009 AND Year <= 2014 THEN '2010-2014'
         WHEN Year > 2014 AND Year <= 2019 THEN '2015-2019' WHEN Year > 2019 AND Year <= 9999 THEN '2020+' END AS YearBin,
    CAST(floor(PredictedCredit / 50.0) * 50 AS INTEGER) AS CreditBin
  FROM scored)"""

SUMS = ", ".join(f"sum({m}) AS {m}" for m in ["Quotes", "SumPremium", "BridgingCount", "SumBridgingPremium"]
                 + [f"Sum{c}Premium" for c in COVERAGES])

CUBE = f"""
cube AS (SELECT State_Name AS State, CAST(Year_Month AS INTEGER) AS YYYYMM, {DIMS},
    count(TotalPremium) AS Quotes, coalesce(sum(TotalPremium), 0) AS SumPremium,
    coalesce(sum(PurchasedFinal), 0) AS BridgingCount,
    coalesce(sum(CASE WHEN PurchasedFinal = 1 THEN TotalPremium ELSE 0 END), 0) AS SumBridgingPremium,
    {', '.join(f'sum({c}Premium) AS Sum{c}Premium' for c in COVERAGES)}
  FROM binned GROUP BY ALL)"""


def regrouped(source: str) -> str:
    return f"SELECT State, YYYYMM, {DIMS}, {SUMS} FROM {source} GROUP BY ALL"


def folded_companies(source: str) -> str:
    return f"""SELECT c.* REPLACE (CASE WHEN regexp_matches(c.CompanyName, '^[0-9]+$') AND t.CompanyName IS NULL THEN 'Other'
      ELSE c.CompanyName END AS CompanyName)
    FROM {source} c LEFT JOIN (
      SELECT State, CompanyName FROM (
        SELECT State, CompanyName, row_number() OVER (PARTITION BY State ORDER BY sum(Quotes) DESC, CompanyName) AS rn
        FROM {source} WHERE regexp_matches(CompanyName, '^[0-9]+$') GROUP BY State, CompanyName)
      WHERE rn <= CASE State WHEN 'IL' THEN 0 WHEN 'AZ' THEN 5 ELSE 15 END) t
    ON t.State = c.State AND t.CompanyName = c.CompanyName"""


def folded_counties(source: str) -> str:
    return f"""SELECT c.* REPLACE (CASE WHEN t.County IS NULL THEN 'Other' ELSE c.County END AS County)
    FROM {source} c LEFT JOIN (
      SELECT State, County FROM (
        SELECT State, County, row_number() OVER (PARTITION BY State ORDER BY sum(Quotes) DESC, County) AS rn
        FROM {source} WHERE County IS NOT NULL GROUP BY State, County) WHERE rn <= 10) t
    ON t.State = c.State AND t.County = c.County"""


STATE = f"""
folded1 AS ({folded_companies('cube')}),
folded2 AS ({regrouped('folded1')}),
folded3 AS ({folded_counties('folded2')}),
scube AS ({regrouped('folded3')})"""

UP_TO_RATE = f"{FACTS_SQL}, {CLEAN}"
UP_TO_JOIN = f"{UP_TO_RATE}, {VEHICLES}, {DRIVERS}, {JOINED}"
UP_TO_CUBE = f"{UP_TO_JOIN}, {CUBE}"
UP_TO_STATE = f"{UP_TO_CUBE}, {STATE}"

CUBE_OUT = (f"State, YYYYMM, {DIMS}, CAST(Quotes AS BIGINT) AS Quotes, CAST(BridgingCount AS BIGINT) AS BridgingCount, "
            + dbl(*MONEY))

# --- report ----------------------------------------------------------------

ANY_PROVIDER = "PremBin >= 0 AND PremBin < 5500 AND Term = 6"
DEFAULT_WHERE = f"{ANY_PROVIDER} AND RateSource = 'ITC'"
COMPARE = "CASE State WHEN 'IL' THEN 'UIC' WHEN 'AZ' THEN 'SunCoast' END"
OURS = ("((State = 'IL' AND CompanyName IN ('UIC', 'SIC')) OR (State = 'AZ' AND CompanyName IN ('SunCoast', 'SIC')))")


def without(company: str) -> str:
    """Average purchased premium of all companies but one."""
    return f"""CAST(sum(CASE WHEN CompanyName <> {company} THEN SumBridgingPremium END) AS DOUBLE)
      / nullif(sum(CASE WHEN CompanyName <> {company} THEN BridgingCount END), 0)"""


def report(where: str = DEFAULT_WHERE, discounts: dict[str, float] | None = None) -> str:
    """CTEs up to `ranked` (one row per company) and `total` (one row per state)."""
    # Sums stay decimals, so that adding and comparing them is exact.
    written, purchased, digits = "sum(SumPremium)", "sum(SumBridgingPremium)", 2
    if discounts:
        digits = 10
        off = " + ".join(f"CAST({p / 100!r} AS DOUBLE) * CAST(Sum{c}Premium AS DOUBLE)" for c, p in discounts.items())
        adjusted = f"CASE WHEN {OURS} THEN CAST(SumPremium AS DOUBLE) - ({off}) ELSE CAST(SumPremium AS DOUBLE) END"
        scale = f"CASE WHEN SumPremium > 0 THEN ({adjusted}) / CAST(SumPremium AS DOUBLE) ELSE 1 END"
        written, purchased = f"sum({adjusted})", f"sum(({scale}) * CAST(SumBridgingPremium AS DOUBLE))"
    return f"""
slice_sums AS (SELECT State, CompanyName, CAST(sum(Quotes) AS DOUBLE) AS Quotes,
    CAST({written} AS DECIMAL(28, {digits})) AS SumPremium, CAST(sum(BridgingCount) AS DOUBLE) AS BridgingCount,
    CAST({purchased} AS DECIMAL(28, {digits})) AS SumBridgingPremium
  FROM scube WHERE {where} GROUP BY State, CompanyName),
filled AS (SELECT c.State, c.CompanyName, coalesce(Quotes, 0) AS Quotes, coalesce(SumPremium, 0) AS SumPremium,
    coalesce(BridgingCount, 0) AS BridgingCount, coalesce(SumBridgingPremium, 0) AS SumBridgingPremium
  FROM (SELECT DISTINCT State, CompanyName FROM scube) c LEFT JOIN slice_sums s
  ON s.State = c.State AND s.CompanyName = c.CompanyName),
ratios AS (SELECT *, CASE WHEN Quotes > 0 THEN BridgingCount / Quotes END AS BridgeRate,
    CASE WHEN Quotes > 0 THEN CAST(SumPremium AS DOUBLE) / Quotes END AS AvgPremium,
    CASE WHEN BridgingCount > 0 THEN CAST(SumBridgingPremium AS DOUBLE) / BridgingCount END AS AvgBridgingPremium,
    CASE WHEN sum(Quotes) OVER (PARTITION BY State) > 0
      THEN Quotes / sum(Quotes) OVER (PARTITION BY State) * 100 END AS SizePct FROM filled),
ranks AS (SELECT *,
    CASE WHEN AvgPremium IS NOT NULL THEN CAST(1 + (SELECT count(*) FROM ratios o WHERE o.State = r.State
      AND o.AvgPremium < r.AvgPremium) AS INTEGER) END AS WrittenRank,
    CASE WHEN AvgBridgingPremium IS NOT NULL THEN CAST(1 + (SELECT count(*) FROM ratios o WHERE o.State = r.State
      AND o.AvgBridgingPremium < r.AvgBridgingPremium) AS INTEGER) END AS BridgeRank FROM ratios r),
refs AS (SELECT s.State, c.AvgBridgingPremium AS RefCompare, h.AvgBridgingPremium AS RefHouse
  FROM (SELECT DISTINCT State FROM ratios) s
  LEFT JOIN ratios c ON c.State = s.State AND c.CompanyName = CASE s.State WHEN 'IL' THEN 'UIC' WHEN 'AZ' THEN 'SunCoast' END
  LEFT JOIN ratios h ON h.State = s.State AND h.CompanyName = 'SIC'),
ranked AS (SELECT r.*, WrittenRank - BridgeRank AS RankDiff, RefCompare, RefHouse,
    CASE WHEN RefCompare > 0 THEN AvgBridgingPremium / RefCompare - 1 END AS VsCompareCo,
    CASE WHEN RefHouse > 0 THEN AvgBridgingPremium / RefHouse - 1 END AS VsSIC,
    coalesce(CompanyName = {COMPARE}, false) OR CompanyName = 'SIC' AS IsReference
  FROM ranks r JOIN refs USING (State)),
total AS (SELECT f.State, 'TOTAL' AS CompanyName, sum(Quotes) AS Quotes, sum(SumPremium) AS SumPremium,
    sum(BridgingCount) AS BridgingCount, sum(SumBridgingPremium) AS SumBridgingPremium,
    sum(BridgingCount) / sum(Quotes) AS BridgeRate, CAST(sum(SumPremium) AS DOUBLE) / sum(Quotes) AS AvgPremium,
    CASE WHEN sum(BridgingCount) > 0 THEN CAST(sum(SumBridgingPremium) AS DOUBLE) / sum(BridgingCount) END
      AS AvgBridgingPremium,
    CAST(100 AS DOUBLE) AS SizePct,
    CASE WHEN max(RefCompare) > 0 THEN {without(COMPARE.replace('State', 'f.State'))} / max(RefCompare) - 1 END AS VsCompareCo,
    CASE WHEN max(RefHouse) > 0 THEN {without("'SIC'")} / max(RefHouse) - 1 END AS VsSIC
  FROM filled f JOIN refs USING (State) GROUP BY f.State HAVING sum(Quotes) > 0)"""


REPORT_FIGURES = ["SizePct", "AvgPremium", "BridgeRate", "AvgBridgingPremium", "VsCompareCo", "VsSIC"]
RATIOS_OUT = ", ".join(REPORT_FIGURES)
ROUNDED_OUT = ", ".join(f"round({c}, 8) AS {c}" for c in REPORT_FIGURES)
SUMS_OUT = f"Quotes, BridgingCount, {dbl('SumPremium', 'SumBridgingPremium')}"


def report_out(where: str = DEFAULT_WHERE, discounts: dict[str, float] | None = None, having: str = "true") -> str:
    columns = f"State, CompanyName, Quotes, BridgingCount, {ROUNDED_OUT if discounts else RATIOS_OUT}"
    return f"""{UP_TO_STATE}, {report(where, discounts)}, whole AS (
    SELECT {columns}, WrittenRank, BridgeRank, RankDiff, IsReference, false AS IsTotal FROM ranked
    UNION ALL
    SELECT {columns}, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), false, true FROM total)
    SELECT * FROM whole WHERE {having}"""


FILTERED = ("YYYYMM >= 202501 AND YYYYMM <= 202503 AND PremBin >= 1000 AND PremBin < 5000 AND Term = 12 "
            "AND LiabLimits = '50/100' AND NumDrivers = '4+' AND PriorInsurance = 1 AND NonOwner = 0 AND RateSource = 'ITC'")
CREDIT_RANGE = f"{DEFAULT_WHERE} AND CreditBin IS NOT NULL AND CreditBin >= 900 AND CreditBin <= 1200"
ONE_PLAN = f"{DEFAULT_WHERE} AND PayPlan = 'Full pay' AND NumVehicles = '1' AND YearBin = '2020+'"
WHAT_IF = {"LiabBI": 10, "Comp": 25, "Coll": -15, "UninsPD": 100}

RATE_ROW = "State_Name, Year_Month, PolicyLinkID, RateId, CompanyId, RateIteration"
COVERAGE_OUT = dbl(*[f"{c}Premium" for c in COVERAGES])
SLICE_WHERE = "State_Name = 'IL' AND Year_Month = '202501'"


def facts(sql: str) -> str:
    return f"{FACTS_SQL} {sql}"


def dims(sql: str, extra: str = "") -> str:
    return f"{FACTS_SQL}, {DIMENSION_TABLES}{', ' + extra if extra else ''} {sql}"


def index_out(source: str) -> str:
    return f"""SELECT State AS state, count(*) AS rows,
      array_to_string(list_sort(list(DISTINCT CAST(YYYYMM AS VARCHAR))), ',') AS months,
      array_to_string(list_sort(list(DISTINCT CompanyName)), ',') AS companies,
      array_to_string(list_sort(list(DISTINCT County)), ',') AS counties,
      State IN ('IL', 'AZ') AS curated, {COMPARE} AS comparison_company,
      CASE State WHEN 'IL' THEN 'UIC,SIC' WHEN 'AZ' THEN 'SunCoast,SIC' ELSE '' END AS our_companies
    FROM {source} GROUP BY State"""


def index_json_out(source: str) -> str:
    def listed(name: str) -> str:
        return f"CASE WHEN {name} = '' THEN [] ELSE string_split({name}, ',') END"

    return f"""entries AS ({index_out(source)}),
      texts AS (SELECT state, CAST(to_json(struct_pack(state := state, rows := rows,
        months := CAST({listed('months')} AS INTEGER[]), companies := {listed('companies')},
        counties := {listed('counties')}, curated := curated, comparison_company := comparison_company,
        our_companies := {listed('our_companies')})) AS VARCHAR) AS entry FROM entries)
    SELECT '{{"generated_at":"2026-01-01T00:00:00+00:00","source":"parquet","states":{{'
      || string_agg('"' || state || '":' || entry, ',' ORDER BY state) || '}}}}' AS value FROM texts"""


def formatted_out() -> str:
    """Display text; halves are rounded away from zero."""
    def whole(value: str, unit: str = "") -> str:
        return f"coalesce('{unit}' || format('{{:,}}', CAST(round({value}) AS BIGINT)), '')"

    def percent(value: str, sign: bool = False) -> str:
        outwards = f"CASE WHEN abs({value} * 4) % 2 = 1 THEN {value} + sign({value}) * 0.001 ELSE {value} END"
        plus = f"CASE WHEN {value} >= 0 THEN '+' ELSE '' END || " if sign else ""
        return f"coalesce({plus}printf('%.1f%%', {outwards}), '')"

    return f"""SELECT State, CompanyName, {whole('Quotes')} AS Quotes, {percent('SizePct')} AS SizePct,
      {whole('AvgPremium', '$')} AS AvgPremium, {whole('WrittenRank')} AS WrittenRank,
      {whole('BridgingCount')} AS BridgingCount, {percent('(BridgeRate * 100)')} AS BridgeRate,
      {whole('AvgBridgingPremium', '$')} AS AvgBridgingPremium, {whole('BridgeRank')} AS BridgeRank,
      coalesce(CASE WHEN RankDiff > 0 THEN '+' ELSE '' END || CAST(RankDiff AS VARCHAR), '') AS RankDiff,
      {percent('(VsCompareCo * 100)', True)} AS VsCompareCo, {percent('(VsSIC * 100)', True)} AS VsSIC
    FROM ({report_out()})"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # scans
    sql["scan_rate"] = facts(f"""SELECT PolicyLinkID, RateId, CompanyId, RateIteration, CAST(RatedDate AS VARCHAR) AS RatedDate,
      {dbl('TotalPremium', 'DownPayment')}, PercentDown, NumOfPayments, Purchased, NonOwner, AssumedCredit, Term, Rate_Source
      FROM fx_rate WHERE {SLICE_WHERE}""")
    sql["scan_car"] = facts(f"""SELECT RateLinkID, RateVehicleId, LiabLimits1, LiabLimits2, Year, County, {COVERAGE_OUT}
      FROM fx_car WHERE {SLICE_WHERE}""")
    sql["scan_driver"] = facts(f"""SELECT RateLinkID, RateDriverId, PriorInsurance, Age, Relation, ResidencyStatus,
      PriorMonthsCovg, PriorDaysLapse FROM fx_driver WHERE {SLICE_WHERE}""")
    sql["scan_violation"] = facts(f"SELECT RateDriverLinkId, AtFault FROM fx_violation WHERE {SLICE_WHERE}")
    for name in ("rate", "car", "driver", "violation"):
        sql[f"scan_stored_{name}"] = sql[f"scan_{name}"].replace(f"WHERE {SLICE_WHERE}", "").replace(
            " FROM fx_", ", State_Name, Year_Month FROM fx_").replace("\n      FROM fx_", ", State_Name, Year_Month FROM fx_")
    sql["discover_state_months"] = facts("SELECT DISTINCT State_Name, Year_Month FROM fx_rate ORDER BY ALL")
    sql["state_months"] = facts("""SELECT State_Name AS State,
      array_to_string(list_sort(list(DISTINCT Year_Month)), ',') AS months FROM fx_rate GROUP BY State_Name""")
    sql["active_states"] = facts("""SELECT DISTINCT State_Name, Year_Month FROM fx_rate WHERE State_Name IN ('IL', 'AZ')""")

    # quotes
    sql["filter_rated_month"] = facts(f"""SELECT {RATE_ROW}, CAST(RatedDate AS VARCHAR) AS RatedDate FROM fx_rate
      WHERE CAST(strftime(RatedDate, '%Y%m') AS VARCHAR) = Year_Month""")
    sql["drop_inconsistent_policies"] = facts(
        f"SELECT {RATE_ROW}, NonOwner, AssumedCredit FROM ({consistent('fx_rate')})")
    rows = planned("fx_rate", "pl")
    sql["percent_down_repair"] = dims(
        f"SELECT {RATE_ROW}, RawPercent, PercentDown FROM pl", rows)
    sql["percent_down_normalize"] = dims(
        f"SELECT {RATE_ROW}, PercentDown, NormalPercent FROM pl", rows)
    sql["pay_plan"] = dims(
        f"SELECT {RATE_ROW}, PercentDown, PaymentCount, PayPlan FROM pl WHERE PayPlan IS NOT NULL", rows)
    sql["purchased_flag"] = dims(
        f"SELECT {QUOTE_KEY}, max(Purchased) AS PurchasedFinal FROM pl WHERE PayPlan IS NOT NULL GROUP BY ALL", rows)
    sql["earliest_quote"] = dims(
        f"""SELECT {QUOTE_KEY}, RateId, RateIteration, CAST(TotalPremium AS DOUBLE) AS TotalPremium, Term
        FROM ({deduped('(SELECT * FROM pl WHERE PayPlan IS NOT NULL)')})""", rows)
    sql["company_name"] = dims(f"""SELECT {', '.join('r.' + c for c in RATE_ROW.split(', '))},
      coalesce(n.Name, CAST(r.CompanyId AS VARCHAR)) AS CompanyName FROM fx_rate r LEFT JOIN names n
      ON n.State_Name = r.State_Name AND n.CompanyId = r.CompanyId""")
    sql["rate_clean"] = f"""{UP_TO_RATE} SELECT {QUOTE_KEY}, CompanyName, PurchasedFinal, RateIteration, RateId, Term,
      NonOwner, Rate_Source, CAST(RatedDate AS VARCHAR) AS RatedDate, {dbl('TotalPremium', 'DownPayment')}, PercentDown,
      NumOfPayments, Purchased, AssumedCredit FROM clean"""

    # vehicles and drivers
    cars, drivers = f"{FACTS_SQL}, {DIMENSION_TABLES}, {VEHICLES}", f"{FACTS_SQL}, {DRIVERS}"
    sql["county_clean"] = f"{cars} SELECT State_Name, Year_Month, RateLinkID, RateVehicleId, County FROM labelled"
    sql["liability_label"] = f"""{cars} SELECT State_Name, Year_Month, RateLinkID, RateVehicleId, LiabLimits1, LiabLimits2,
      LiabLimits FROM labelled"""
    sql["drop_invalid_liability_rates"] = f"""{cars} SELECT State_Name, Year_Month, RateLinkID, RateVehicleId,
      LiabLimits FROM valid"""
    sql["car_profile"] = f"""{cars} SELECT State_Name, Year_Month, RateId, LiabLimits, County, NumVehicles, Year,
      {COVERAGE_OUT} FROM cars"""
    sql["driver_at_fault"] = f"""{drivers} SELECT State_Name, Year_Month, RateLinkID, RateDriverId, Relation,
      CAST(AtFault AS INTEGER) AS AtFault FROM flagged"""
    sql["named_insured"] = f"""{drivers} SELECT State_Name, Year_Month, RateLinkID, RateDriverId, Age AS NamedInsuredAge,
      ResidencyStatus, PriorMonthsCovg, PriorDaysLapse FROM insured"""
    sql["driver_profile"] = f"{drivers} SELECT * FROM drivers"

    # quotes with vehicles and drivers
    joined_key = "State_Name, Year_Month, PolicyLinkID, RateId, CompanyName, PayPlan"
    sql["rate_car_driver"] = f"""{UP_TO_JOIN} SELECT {joined_key}, PurchasedFinal, CAST(TotalPremium AS DOUBLE) AS TotalPremium,
      LiabLimits, County, VehicleCount, Year, PriorInsurance, DriverCount, NamedInsuredAge, ResidencyStatus,
      PriorMonthsCovg, PriorDaysLapse, {COVERAGE_OUT} FROM joined"""
    sql["premium_bin"] = f"{UP_TO_JOIN} SELECT {joined_key}, CAST(TotalPremium AS DOUBLE) AS TotalPremium, PremBin FROM binned"
    sql["year_bin"] = f"{UP_TO_JOIN} SELECT {joined_key}, Year, YearBin FROM binned"
    sql["cap_counts"] = f"{UP_TO_JOIN} SELECT {joined_key}, DriverCount, NumDrivers, VehicleCount, NumVehicles FROM binned"
    points = ["CarrierPoints", "DurationPoints", "VehicleAgePoints", "AgePoints", "LimitsPoints", "VehicleCountPoints",
              "HomeownerPoints"]
    sql["credit_components"] = f"""{UP_TO_JOIN} SELECT {joined_key},
      {', '.join(f'CAST({p} AS INTEGER) AS {p}' for p in points)} FROM parts"""
    sql["predicted_credit"] = f"{UP_TO_JOIN} SELECT {joined_key}, PredictedCredit FROM scored"
    sql["credit_bin"] = f"{UP_TO_JOIN} SELECT {joined_key}, PredictedCredit, CreditBin FROM binned"

    # cubes
    sql["monthly_cube"] = f"{UP_TO_CUBE} SELECT {CUBE_OUT} FROM cube"
    older = ", ".join(d for d in DIM_LIST if d not in ("County", "CreditBin", "RateSource"))
    sql["union_months"] = f"""{UP_TO_CUBE}, whole AS (
      SELECT State, YYYYMM, {older}, {SUMS} FROM cube WHERE YYYYMM <= 202502 GROUP BY ALL
      UNION ALL BY NAME SELECT * FROM cube WHERE YYYYMM > 202502) SELECT {CUBE_OUT} FROM whole"""
    sql["upsert_months"] = f"""{UP_TO_CUBE}, whole AS (
      SELECT * REPLACE (Quotes * 2 AS Quotes) FROM cube WHERE YYYYMM < 202503
      UNION ALL BY NAME SELECT * FROM cube WHERE YYYYMM >= 202503) SELECT {CUBE_OUT} FROM whole"""
    sql["retained_months"] = f"{UP_TO_CUBE} SELECT {CUBE_OUT} FROM cube WHERE YYYYMM < 202503"
    sql["missing_months"] = facts("""SELECT DISTINCT State_Name AS State, CAST(Year_Month AS INTEGER) AS YYYYMM FROM fx_rate
      WHERE CAST(Year_Month AS INTEGER) >= 202503""")
    sql["company_top_n"] = f"{UP_TO_CUBE}, f AS ({folded_companies('cube')}), g AS ({regrouped('f')}) SELECT {CUBE_OUT} FROM g"
    sql["county_top_n"] = f"{UP_TO_CUBE}, f AS ({folded_counties('cube')}), g AS ({regrouped('f')}) SELECT {CUBE_OUT} FROM g"
    sql["state_cube"] = f"{UP_TO_STATE} SELECT {CUBE_OUT} FROM scube"
    sql["merge_folded"] = f"""{UP_TO_STATE}, mixed AS (SELECT * FROM scube WHERE YYYYMM < 202503
      UNION ALL BY NAME SELECT * FROM cube WHERE YYYYMM >= 202503),
      m1 AS ({folded_companies('mixed')}), m2 AS ({regrouped('m1')}), m3 AS ({folded_counties('m2')}),
      m4 AS ({regrouped('m3')}) SELECT {CUBE_OUT} FROM m4"""
    sql["prune_inactive"] = f"{UP_TO_STATE} SELECT {CUBE_OUT} FROM scube WHERE State IN ('IL', 'AZ')"

    # catalogue
    sql["state_index"] = f"{UP_TO_STATE} {index_out('scube')}"
    sql["upsert_index"] = f"""{UP_TO_STATE}, fresh AS ({index_out('scube')}),
      old AS ({index_out("(SELECT * FROM scube WHERE YYYYMM < 202503)")})
      SELECT * FROM fresh WHERE state IN ('IL', 'AZ') UNION ALL SELECT * FROM old WHERE state NOT IN ('IL', 'AZ')"""
    sql["index_after_prune"] = f"SELECT * FROM ({sql['state_index']}) WHERE state IN ('IL', 'AZ')"
    sql["index_json"] = f"{UP_TO_STATE}, {index_json_out('scube')}"
    sql["displayable_states"] = f"""{UP_TO_STATE} SELECT DISTINCT State AS state FROM scube WHERE State IN ('IL', 'AZ')"""
    sql["distinct_pay_plans"] = f"""{UP_TO_STATE} SELECT DISTINCT s.State, s.PayPlan, p.ord AS PlanOrder
      FROM scube s JOIN plan_dim p ON p.label = s.PayPlan"""
    sql["distinct_counties"] = f"{UP_TO_STATE} SELECT DISTINCT State, County FROM scube WHERE County IS NOT NULL"
    sql["month_label"] = f"""{UP_TO_CUBE} SELECT DISTINCT State, YYYYMM,
      substr(CAST(YYYYMM AS VARCHAR), 5, 2) || '/' || substr(CAST(YYYYMM AS VARCHAR), 1, 4) AS MonthLabel FROM cube"""
    sql["top_stats"] = f"""{UP_TO_STATE}, {report()} SELECT s.State, coalesce(q.TotalQuotes, 0) AS TotalQuotes,
      s.first AS FirstMonth, s.last AS LastMonth, s.n AS MonthCount, s.named AS NamedCompanies FROM (
        SELECT State, strftime(make_date(min(YYYYMM) // 100, min(YYYYMM) % 100, 1), '%m/%Y') AS first,
          strftime(make_date(max(YYYYMM) // 100, max(YYYYMM) % 100, 1), '%m/%Y') AS last,
          CAST(count(DISTINCT YYYYMM) AS INTEGER) AS n,
          CAST(count(DISTINCT CompanyName) FILTER (NOT regexp_matches(CompanyName, '^[0-9]+$')
            AND NOT starts_with(CompanyName, 'Other')) AS INTEGER) AS named
        FROM scube GROUP BY State) s
      LEFT JOIN (SELECT State, sum(Quotes) AS TotalQuotes FROM filled GROUP BY State) q ON q.State = s.State"""

    # report
    sql["slice_filter"] = f"{UP_TO_STATE} SELECT {CUBE_OUT} FROM scube WHERE {FILTERED}"
    sql["slice_credit_range"] = f"{UP_TO_STATE} SELECT {CUBE_OUT} FROM scube WHERE {CREDIT_RANGE}"
    sql["slice_provider"] = f"""{UP_TO_STATE}, p AS (SELECT * FROM (VALUES ('ITC'), ('EZ Lynx'), ('Any')) AS v(Provider))
      SELECT p.Provider, count(s.State) AS CubeRows, CAST(coalesce(sum(s.Quotes), 0) AS BIGINT) AS Quotes
      FROM p LEFT JOIN (SELECT * FROM scube WHERE {ANY_PROVIDER}) s ON p.Provider IN ('Any', s.RateSource) GROUP BY p.Provider"""
    sql["company_slice"] = f"{UP_TO_STATE}, {report()} SELECT State, CompanyName, {SUMS_OUT} FROM slice_sums"
    sql["zero_fill_companies"] = f"{UP_TO_STATE}, {report(FILTERED)} SELECT State, CompanyName, {SUMS_OUT} FROM filled"
    sql["discount_what_if"] = f"""{UP_TO_STATE}, {report(DEFAULT_WHERE, WHAT_IF)}
      SELECT State, CompanyName, Quotes, BridgingCount, round(CAST(SumPremium AS DOUBLE), 4) AS SumPremium,
      round(CAST(SumBridgingPremium AS DOUBLE), 4) AS SumBridgingPremium FROM slice_sums"""
    sql["company_metrics"] = f"""{UP_TO_STATE}, {report()} SELECT State, CompanyName, {SUMS_OUT},
      BridgeRate, AvgPremium, AvgBridgingPremium FROM ratios"""
    sql["market_share"] = f"{UP_TO_STATE}, {report()} SELECT State, CompanyName, Quotes, SizePct FROM ratios"
    sql["company_ranks"] = f"""{UP_TO_STATE}, {report()} SELECT State, CompanyName, WrittenRank, BridgeRank, RankDiff
      FROM ranked"""
    sql["vs_reference"] = f"""{UP_TO_STATE}, {report()} SELECT State, CompanyName,
      AvgBridgingPremium, VsCompareCo, VsSIC FROM ranked"""
    sql["report_total"] = f"""{UP_TO_STATE}, {report()} SELECT State, CompanyName, {SUMS_OUT}, {RATIOS_OUT} FROM total"""
    sql["company_report"] = report_out()
    sql["company_report_filtered"] = report_out(ONE_PLAN)
    sql["company_report_what_if"] = report_out(DEFAULT_WHERE, WHAT_IF)
    sql["report_sorted"] = report_out()
    sql["formatted_report"] = formatted_out()
    sql["report_where"] = report_out(having="Quotes > 300 AND NOT IsTotal")
    return sql
