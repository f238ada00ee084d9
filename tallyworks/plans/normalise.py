"""From flat advertising files to the normalised model: dictionaries, campaigns, facts and the junction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyworks.functions.parsing import clean_text, slot_size, uuid_text
from tallyworks.operators.keyed import newest_per_key
from tallyworks.operators.ranking import number_rows
from tallyworks.operators.surrogates import attach_ids, lookup_dimension


def normalise_advertisers(events: DataFrame) -> DataFrame:
    """advertiser_id, name"""
    return lookup_dimension(events, "advertiser_name", "advertiser_id", "name")


def normalise_campaigns(events: DataFrame, advertisers: DataFrame) -> DataFrame:
    """campaign_id, advertiser_id, campaign_name, budget: the distinct (campaign, advertiser) pairs.

    Pairs with an unknown advertiser are dropped. Budgets are not in the event file and start at zero.
    """
    pairs = events.select("campaign_name", "advertiser_name").dropna().distinct()
    owned = attach_ids(pairs, "advertiser_name", advertisers, "name", "advertiser_id")
    numbered = number_rows(owned, ["campaign_name", "advertiser_id"], "campaign_id")
    return numbered.select(
        "campaign_id", "advertiser_id", "campaign_name", F.lit(0).cast("decimal(14,2)").alias("budget")
    )


def normalise_slots(sizes: DataFrame, col: str) -> DataFrame:
    """slot_id, width, height: the distinct readable slot sizes."""
    parsed = sizes.select(slot_size(col).alias("slot")).select("slot.width", "slot.height").dropna().distinct()
    return number_rows(parsed, ["width", "height"], "slot_id").select("slot_id", "width", "height")


def normalise_events(
    events: DataFrame, campaigns: DataFrame, locations: DataFrame | None = None, devices: DataFrame | None = None
) -> DataFrame:
    """Fact rows with surrogate keys.

    Undated events and events of unknown campaigns are dropped. A campaign name that stands for
    several campaigns gets the last id. Unknown places and devices keep a null key. Dimensions are
    broadcast only after a count has shown them small.
    """
    dated = events.filter(F.col("event_timestamp").isNotNull())
    facts = dated.withColumn("event_id", uuid_text("event_id", *dated.columns))
    facts = attach_ids(facts, "campaign_name", campaigns, "campaign_name", "campaign_id")
    if locations is not None:
        place = locations.select(F.col("country_id").alias("location_id"), F.col("country_name").alias("location"))
        facts = attach_ids(facts, "location", place, "location", "location_id", "left")
    if devices is not None:
        gadget = devices.select("device_id", F.col("device_name").alias("device"))
        facts = attach_ids(facts, "device", gadget, "device", "device_id", "left")
    optional = [c for c in ("location_id", "device_id", "bid_amount") if c in facts.columns]
    return facts.select(
        "event_id", "campaign_id", "user_id", *optional, F.col("event_timestamp").alias("timestamp"),
        "ad_cost", "was_clicked", "click_timestamp", "ad_revenue",
    )


def first_per_event(facts: DataFrame) -> DataFrame:
    """Insert-ignore on the event id within one load: the earliest row of an id stays."""
    rest = [F.col(c).asc_nulls_last() for c in facts.columns if c not in ("event_id", "timestamp")]
    return newest_per_key(facts, ["event_id"], [F.asc("timestamp"), *rest])


def interest_names(users: DataFrame, sep: str = ",") -> DataFrame:
    """user_id, interest_name: one row per distinct interest of a user, blanks left out."""
    single = users.select("user_id", F.explode(F.split("interests", F.lit(f"\\Q{sep}\\E"))).alias("one"))
    named = single.select("user_id", clean_text("one").alias("interest_name"))
    return named.filter(F.col("interest_name") != "").distinct()


def user_interests(users: DataFrame, sep: str = ",", interests: DataFrame | None = None) -> DataFrame:
    """The junction user_id, interest_id. Interest ids are dense unless a dictionary is given."""
    pairs = interest_names(users, sep)
    if interests is None:
        interests = lookup_dimension(pairs, "interest_name", "interest_id", "interest_name")
    return attach_ids(pairs, "interest_name", interests, "interest_name", "interest_id").select(
        "user_id", "interest_id"
    )


def normalise_model(events: DataFrame, campaigns: DataFrame, users: DataFrame, sep: str = ",") -> dict[str, DataFrame]:
    """All tables of the model from the three cleaned files.

    Dictionaries take every spelling that occurs in any of the files, so no name lacks an id. Users that only the
    events name are users too, with nothing else known of them.
    """
    seen = events.select("user_id").where(F.col("user_id").isNotNull()).distinct().join(users, "user_id", "left_anti")
    users = users.unionByName(seen, allowMissingColumns=True)
    place = events.select("location").unionByName(users.select("location"))
    locations = lookup_dimension(place, "location", "country_id", "country_name")
    names = events.select("advertiser_name").unionByName(campaigns.select("advertiser_name"))
    advertisers = lookup_dimension(names, "advertiser_name", "advertiser_id", "name")
    devices = lookup_dimension(events, "device", "device_id", "device_name")
    pairs = interest_names(users, sep)
    interests = lookup_dimension(pairs, "interest_name", "interest_id", "interest_name")
    sizes = campaigns.select("slot.width", "slot.height").dropna().distinct()
    slots = number_rows(sizes, ["width", "height"], "slot_id").select("slot_id", "width", "height")

    owned = attach_ids(campaigns, "advertiser_name", advertisers, "name", "advertiser_id")
    sized = (
        owned.select("*", "slot.width", "slot.height").drop("slot")
        .join(slots, ["width", "height"], "left").drop("width", "height")
    )
    known = campaigns.select("campaign_id", "campaign_name")
    where = locations.withColumnRenamed("country_name", "location")
    return {
        "locations": locations,
        "advertisers": advertisers,
        "interests": interests,
        "devices": devices,
        "ad_slot_sizes": slots,
        "campaigns": sized.select("campaign_id", "advertiser_id", "slot_id", "campaign_name", "start_date",
                                  "end_date", "targeting_criteria", "budget"),
        "users": attach_ids(users, "location", where, "location", "country_id", "left").select(
            "user_id", "age", "gender", "country_id", "signup_date"),
        "user_interests": attach_ids(pairs, "interest_name", interests, "interest_name", "interest_id").select(
            "user_id", "interest_id"),
        "ad_events": first_per_event(normalise_events(events, known, locations, devices)),
    }
