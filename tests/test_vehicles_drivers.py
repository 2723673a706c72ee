from quotelens.operators import drivers, vehicles
from tests import frames


def test_one_invalid_vehicle_drops_its_rate(spark):
    rows = frames.car(
        spark, {"RateLinkID": 1}, {"RateLinkID": 1, "LiabLimits1": 15}, {"RateLinkID": 2}, {"RateLinkID": None},
        {"RateLinkID": 3, "LiabLimits2": None}, {"RateLinkID": 1, "State_Name": "AZ"},
    )
    expected = [(1, "AZ"), (2, "IL")]
    assert sorted((r.RateLinkID, r.State_Name) for r in vehicles.drop_invalid_rates(rows).collect()) == expected
    assert sorted((r.RateId, r.State_Name) for r in vehicles.car_profile(rows).collect()) == expected


def test_car_profile(spark):
    rows = frames.car(
        spark,
        {"RateVehicleId": 5, "County": "lake", "LiabLimits1": 50, "LiabLimits2": 100, "Year": 2010, "CompPremium": 0.1},
        {"RateVehicleId": 3, "County": " cook ", "Year": None, "CompPremium": 0.2, "CollPremium": None},
        {"RateVehicleId": None, "County": "a", "Year": 2015, "CompPremium": None, "CollPremium": None},
    ).repartition(3)
    [profile] = vehicles.car_profile(rows).collect()
    assert (profile.LiabLimits, profile.County, profile.NumVehicles, profile.Year) == ("25/50", "COOK", 2, 2015)
    assert (profile.CompPremium, profile.CollPremium, profile.LiabBIPremium) == (0.3, 100.0, 300.0)


def test_all_null_coverage_sums_to_zero(spark):
    [profile] = vehicles.car_profile(frames.car(spark, {"MedPayPremium": None})).collect()
    assert profile.MedPayPremium == 0.0


def test_at_fault(spark):
    people = frames.driver(spark, {"RateDriverId": 1}, {"RateDriverId": 2}, {"RateDriverId": 3}, {"RateDriverId": None})
    faults = frames.violation(
        spark, {"RateDriverLinkId": 1, "AtFault": 0}, {"RateDriverLinkId": 1, "AtFault": 1},
        {"RateDriverLinkId": 2, "AtFault": None}, {"RateDriverLinkId": None}, {"RateDriverLinkId": 3, "State_Name": "AZ"},
    )
    flagged = drivers.driver_at_fault(people, faults).collect()
    assert sorted((str(r.RateDriverId), r.AtFault) for r in flagged) == [("1", 1), ("2", 0), ("3", 0), ("None", 0)]


def test_named_insured_comes_first_then_the_lowest_id(spark):
    people = frames.driver(
        spark,
        {"RateLinkID": 1, "RateDriverId": 1, "Relation": "S", "Age": 20},
        {"RateLinkID": 1, "RateDriverId": 2, "Relation": "I", "Age": 50},
        {"RateLinkID": 2, "RateDriverId": 9, "Relation": None, "Age": 30},
        {"RateLinkID": 2, "RateDriverId": 4, "Relation": "S", "Age": 31},
        {"RateLinkID": 3, "RateDriverId": None, "Relation": "I", "Age": 60},
        {"RateLinkID": 3, "RateDriverId": 1, "Relation": "I", "Age": None},
    )
    picked = {r.RateLinkID: (r.RateDriverId, r.NamedInsuredAge) for r in drivers.named_insured(people).collect()}
    assert picked == {1: (2, 50), 2: (4, 31), 3: (1, None)}


def test_driver_profile(spark):
    people = frames.driver(
        spark,
        {"RateLinkID": 1, "RateDriverId": 1, "PriorInsurance": 0, "Relation": "S"},
        {"RateLinkID": 1, "RateDriverId": 2, "PriorInsurance": 1, "PriorDaysLapse": 7},
        {"RateLinkID": 1, "RateDriverId": None, "PriorInsurance": None, "Relation": None},
        {"RateLinkID": 2, "RateDriverId": 3, "PriorInsurance": None},
        {"RateLinkID": None, "RateDriverId": 4},
    )
    rows = drivers.driver_profile(people, frames.violation(spark, {"RateDriverLinkId": 1})).collect()
    got = {r.RateId: (r.PriorInsurance, r.NumDrivers, r.PriorDaysLapse, r.AtFault) for r in rows}
    assert got == {1: (1, 2, 7, 1), 2: (0, 1, 0, 0)}
