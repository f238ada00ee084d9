"""Dirty text to typed columns."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.functions import calendar, parsing, serialise
from tallyworks.plans import cleaning


def one(spark, value, column):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text, expected", [
    ("true", True), (" TRUE ", True), ("True\t", True), ("yes", False), ("1", False), ("", False), (None, False),
])
def test_flag(spark, text, expected):
    assert one(spark, text, parsing.flag) is expected


@pytest.mark.parametrize("text, expected", [
    ("12.34", "12.34"), (" 7 ", "7.00"), ("1e2", "100.00"), ("12.345", "12.35"), ("abc", "0.00"),
    ("NaN", "0.00"), ("", "0.00"), (None, "0.00"), ("-3.5", "-3.50"),
])
def test_money(spark, text, expected):
    assert one(spark, text, parsing.money) == Decimal(expected)


@pytest.mark.parametrize("text, expected", [
    ("4", 4), ("4.0", 4), ("4.9", 4), ("-1", -1), ("Y", None), ("", None), (None, None), (" 5 ", 5),
])
def test_whole_number(spark, text, expected):
    assert one(spark, text, parsing.whole_number) == expected


@pytest.mark.parametrize("text, expected", [
    ("2015-08-31", date(2015, 8, 31)), (" 2015-08-31 ", date(2015, 8, 31)), ("2015-8-31", None), ("2015-13-01", None),
    ("08/31/2015", None), ("2015", None), ("2015-08-31 10:00:00", None), (None, None),
])
def test_iso_date(spark, text, expected):
    assert one(spark, text, parsing.iso_date) == expected


@pytest.mark.parametrize("text, expected", [
    ("2024-10-01 12:30:00", datetime(2024, 10, 1, 12, 30)), ("2024-10-01", datetime(2024, 10, 1)),
    ("2024-10-01T12:30:00.5", datetime(2024, 10, 1, 12, 30, 0, 500000)),
    ("2024-10-01T23:30:00+02:00", datetime(2024, 10, 1, 23, 30)), ("soon", None), (None, None),
])
def test_wall_clock(spark, text, expected):
    assert one(spark, text, parsing.wall_clock) == expected


@pytest.mark.parametrize("text, expected", [
    ("300x250", (300, 250)), (" 300x250 ", (300, 250)), ("300 x 250", (300, 250)), ("300X250", (None, None)),
    ("1x2x3", (None, None)), ("x", (None, None)), ("10x", (None, None)), ("axb", (None, None)), ("300", (None, None)),
    (None, (None, None)),
])
def test_slot_size(spark, text, expected):
    slot = one(spark, text, parsing.slot_size)
    assert (slot["width"], slot["height"]) == expected


CANONICAL = "12345678-1234-5678-1234-567812345678"


@pytest.mark.parametrize("text", [
    CANONICAL, "{" + CANONICAL + "}", "urn:uuid:" + CANONICAL, CANONICAL.replace("-", ""), CANONICAL.upper(),
])
def test_valid_uuid_is_canonical(spark, text):
    assert one(spark, text, lambda c: parsing.uuid_text(c, c)) == CANONICAL


@pytest.mark.parametrize("text", ["bad", "", None, CANONICAL[:-1], "g" + CANONICAL[1:]])
def test_bad_uuid_is_replaced_the_same_way_each_time(spark, text):
    first, second = (one(spark, text, lambda c: parsing.uuid_text(c, c)) for _ in range(2))
    assert first == second and len(first) == 36 and first.count("-") == 4


def test_replacement_ids_differ_by_row(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 2)], "id string, n int")
    ids = [r[0] for r in df.select(parsing.uuid_text("id", "id", "n")).collect()]
    assert ids[0] != ids[1] and ids[1] == ids[2]


def raw_events(spark, *rows):
    names = schemas.AD_EVENTS_RAW.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.AD_EVENTS_RAW)


def test_clean_events(spark):
    row = cleaning.clean_events(raw_events(spark, {
        "EventID": CANONICAL, "AdvertiserName": " A ", "CampaignName": "C\t", "CampaignTargetingCountry": None,
        "UserID": "17.0", "Timestamp": "2024-10-01 01:02:03", "AdCost": "abc", "WasClicked": " TRUE ",
        "ClickTimestamp": "never", "AdRevenue": "1.005", "Location": "", "BidAmount": "x",
    })).first()
    assert (row["advertiser_name"], row["campaign_name"], row["target_country"]) == ("A", "C", None)
    assert row["user_id"] == 17 and row["was_clicked"] is True and row["click_timestamp"] is None
    assert row["ad_cost"] == Decimal("0.00") and row["ad_revenue"] == Decimal("1.01") and row["bid_amount"] is None
    assert row["event_date"] == date(2024, 10, 1) and row["location"] == ""


def test_missing_names_do_not_become_text(spark):
    row = cleaning.clean_events(raw_events(spark, {"AdvertiserName": None})).first()
    assert row["advertiser_name"] is None and row["event_timestamp"] is None and row["was_clicked"] is False


REVIEW = {
    "review_id": "R1", "product_id": "P1", "customer_id": "U1", "star_rating": "5", "verified_purchase": "1",
    "review_date": "2015-08-31", "vine": "0", "helpful_votes": "2", "total_votes": "3",
}


def raw_reviews(spark, *rows):
    names = schemas.REVIEWS_RAW.fieldNames()
    return spark.createDataFrame([tuple({**REVIEW, **r}.get(n) for n in names) for r in rows], schemas.REVIEWS_RAW)


@pytest.mark.parametrize("change, kept, kept_verified", [
    ({}, True, True),
    ({"customer_id": None}, False, True),
    ({"review_id": None}, False, False),
    ({"product_id": None}, False, False),
    ({"star_rating": None}, False, False),
    ({"star_rating": "0"}, False, True),
    ({"star_rating": "6"}, False, True),
    ({"star_rating": "Y"}, False, True),
    ({"star_rating": "4.0"}, True, True),
    ({"review_date": None}, False, False),
    ({"review_date": "31.08.2015"}, False, False),
    ({"verified_purchase": "0"}, True, False),
    ({"verified_purchase": "Y"}, True, False),
    ({"verified_purchase": None}, True, False),
])
def test_review_rules(spark, change, kept, kept_verified):
    raw = raw_reviews(spark, change)
    assert cleaning.clean_reviews(raw).count() == int(kept)
    assert cleaning.clean_verified_reviews(raw).count() == int(kept_verified)


def test_clean_users_and_campaigns(spark):
    users = spark.createDataFrame([("1", "30", " F ", "USA", "a, b", "2020-01-02"), (None, "x", None, None, None, None)],
                                  schemas.USERS_RAW)
    assert [tuple(r) for r in cleaning.clean_users(users).collect()] == [
        (1, 30, "F", "USA", "a, b", date(2020, 1, 2))]
    campaigns = spark.createDataFrame(
        [("7", "A", "C", "2024-01-01", "bad", "Age 18-25", "300x250", "1000.5")], schemas.CAMPAIGNS_RAW)
    row = cleaning.clean_campaigns(campaigns).first()
    assert row["end_date"] is None and row["slot"]["height"] == 250 and row["budget"] == Decimal("1000.50")


def test_date_range_is_checked():
    assert calendar.parse_date_range("2015-01-01", "2015-01-31") == (date(2015, 1, 1), date(2015, 1, 31))
    for start, end in (("2015-02-01", "2015-01-31"), ("01/02/2015", "2015-03-01"), ("2015-01-01", "x")):
        with pytest.raises(ValueError):
            calendar.parse_date_range(start, end)


def test_months_touched_over_a_year_end(spark):
    df = spark.createDataFrame([(date(2014, 11, 15), date(2015, 2, 1))], "a date, b date")
    months = df.select(calendar.months_touched(F.col("a"), F.col("b"))).first()[0]
    assert months == [date(2014, 11, 1), date(2014, 12, 1), date(2015, 1, 1), date(2015, 2, 1)]


def test_plain_values(spark):
    df = spark.createDataFrame(
        [(Decimal("1.50"), float("nan"), date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), "x")],
        "m decimal(10,2), d double, day date, ts timestamp_ntz, s string")
    assert tuple(serialise.plain_values(df).first()) == (1.5, None, "2024-01-02", "2024-01-02T03:04:05", "x")


def test_times_in_other_forms(spark):
    texts = ["2024-05-01 10:00:00", "05/01/2024 10:00", "1 May 2024 10:00:05", " 2024-05-01T10:00:00 ", "soon", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parsing.wall_clock_of("t", ["MM/dd/yyyy HH:mm", "d MMM yyyy HH:mm:ss"])).collect()]
    at = datetime(2024, 5, 1, 10)
    assert got == [at, at, at.replace(second=5), at, None, None, None]
    assert [r[0] for r in df.select(parsing.wall_clock_of("t")).collect()] == [at, None, None, at, None, None, None]
