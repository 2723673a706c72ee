"""Fixed values of the data model.

Everything in this module is given from outside: ids, labels, boundaries and
points that results depend on. Change them only together with the data.
"""

# --- companies -------------------------------------------------------------

# State -> company id -> display name. Several ids may share a name.
COMPANY_NAMES = {
    "IL": {
        7870394: "National",
        8915607: "Progressive",
        9246038: "Safeway",
        19663428: "AmericanHeartland",
        48959310: "UIC",
        48959311: "UIC",
        95816297: "AmFreedom",
        95817115: "AmFreedom",
        107678282: "UnitedEquitable",
        110761262: "Kemper",
        128913468: "FirstChicago",
        128914375: "FirstChicago",
        128914886: "USIC",
        128914919: "USIC",
        128915050: "FirstChicago",
        128915051: "USIC",
        133697356: "AmericanAlliance",
        136187915: "SIC",
        156245551: "GEICO",
    },
    "AZ": {
        7869459: "NatGen",
        10031862: "Hallmark",
        8917016: "Progressive",
        2629060: "Kemper",
        3870881: "General",
        145628779: "Alpine",
        126227624: "GAINSCO",
        8130598: "Mendota",
        30741178: "Bristol West",
        139073527: "Falcon",
        9244878: "Safeway",
        105189666: "Dairyland",
        131141924: "SunCoast",
        136190126: "SIC",
        130096799: "AssuranceAmerica",
        130093319: "AssuranceAmerica",
    },
}
EXHAUSTIVE_STATES = ["IL"]          # every unmapped company folds into Other
ACTIVE_STATES = ["AZ", "IL"]
COMPARISON_COMPANY = {"IL": "UIC", "AZ": "SunCoast"}
OUR_COMPANIES = {"IL": ["UIC", "SIC"], "AZ": ["SunCoast", "SIC"]}
HOUSE_COMPANY = "SIC"
OTHER = "Other"

# Unmapped companies / counties kept by name per state; the rest fold into Other.
TOP_COMPANIES_EXHAUSTIVE = 0
TOP_COMPANIES_MAPPED = 5
TOP_COMPANIES_UNMAPPED = 15
TOP_COUNTIES = 10
UNKNOWN_COUNTY = "UNKNOWN"
UNKNOWN_COMPANY = "UNKNOWN"

# --- pay plans -------------------------------------------------------------

# Down-payment percents (after rounding to a tenth) merged onto another percent.
MERGED_PERCENTS = {
    16.7: 16.66, 16.1: 16.66, 16.0: 16.66, 15.0: 16.66, 17.0: 16.66, 18.0: 16.66,
    9.0: 8.33, 8.0: 8.33, 8.3: 8.33,
    20.3: 20.0,
}

# (percent down, payments, label) in display order. Other pairs are dropped.
PAY_PLANS = [
    (8.33, 12, "8% down, 12 payments"),
    (10.0, 12, "10% down, 12 payments"),
    (16.66, 6, "17% down, 6 payments"),
    (20.0, 5, "20% down, 5 payments"),
    (20.0, 6, "20% down, 6 payments"),
    (22.0, 6, "22% down, 6 payments"),
    (25.0, 4, "25% down, 4 payments"),
    (25.0, 5, "25% down, 5 payments"),
    (25.0, 6, "25% down, 6 payments"),
    (30.0, 5, "30% down, 5 payments"),
    (40.0, 3, "40% down, 3 payments"),
    (41.7, 5, "42% down, 5 payments"),
    (50.0, 2, "50% down, 2 payments"),
    (100.0, 1, "Full pay"),
]

# --- limits, coverages, bins -----------------------------------------------

LIABILITY_LIMITS = {(25, 50): "25/50", (50, 100): "50/100", (100, 300): "100/300"}
COVERAGES = ["LiabBI", "LiabPD", "Comp", "Coll", "MedPay", "UIMBI", "UIMPD", "UninsBI", "UninsPD"]

PREMIUM_STEP = 500
PREMIUM_CAP = 5000
# (above, up to and including, label)
VEHICLE_YEAR_BINS = [
    (0, 2009, "pre-2010"),
    (2009, 2014, "2010-2014"),
    (2014, 2019, "2015-2019"),
    (2019, 9999, "2020+"),
]
MAX_DRIVERS = 4
MAX_VEHICLES = 5

# --- predicted credit ------------------------------------------------------

CREDIT_STATES = ["IL", "AZ"]
CREDIT_BASE = 865
CREDIT_STEP = 50
CREDIT_RANGE = (600, 1750)          # outer bounds offered by the report
CARRIER_POINTS = {"NO_PC": 0, "NO_LAPSE": 121, "LAPSE": -81}
# (months up to, points); longer than the last -> LONG_DURATION_POINTS
DURATION_POINTS = [(5, -50), (12, 0)]
LONG_DURATION_POINTS = 70
# (vehicle age up to, points); older than the last -> OLD_VEHICLE_POINTS
VEHICLE_AGE_POINTS = [(2, 110), (9, 35)]
OLD_VEHICLE_POINTS = -40
# (age from, age to, points by carrier state); other ages -> 0
AGE_POINTS = [
    (18, 35, {"NO_PC": -15, "NO_LAPSE": -15, "LAPSE": -40}),
    (36, 45, {"NO_PC": 0, "NO_LAPSE": 10, "LAPSE": -40}),
    (46, 55, {"NO_PC": 25, "NO_LAPSE": 40, "LAPSE": -40}),
    (56, 65, {"NO_PC": 65, "NO_LAPSE": 85, "LAPSE": -10}),
    (66, 70, {"NO_PC": 100, "NO_LAPSE": 120, "LAPSE": 30}),
    (71, 100, {"NO_PC": 0, "NO_LAPSE": 0, "LAPSE": 0}),
]
LIMITS_POINTS = {"25/50": 0, "50/100": 100, "100/300": 200}
POINTS_PER_VEHICLE = 27             # capped at MAX_VEHICLES vehicles
HOMEOWNER_POINTS = 100
HOMEOWNER_CODE = "O"
NAMED_INSURED_CODE = "I"

# --- cube ------------------------------------------------------------------

DIMENSIONS = [
    "CompanyName", "PremBin", "LiabLimits", "PayPlan", "NonOwner", "NumDrivers",
    "NumVehicles", "County", "PriorInsurance", "YearBin", "Term", "CreditBin", "RateSource",
]

# --- market providers ------------------------------------------------------

LOADED_PROVIDER = "ITC"             # the provider of all rows that name none
PROVIDERS = ["ITC", "EZ Lynx", "Any"]

# --- names of dump files ---------------------------------------------------

DUMP_TABLES = {
    "rate": "fact_Rate",
    "car": "fact_Rate_Car",
    "driver": "fact_Rate_Driver",
    "violation": "fact_Rate_Violation",
}
STATE_PATTERN = r"^[A-Z]{2}$"
MONTH_PATTERN = r"^\d{6}$"
