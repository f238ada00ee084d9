"""The domain frames, derived from the given tables.

Line items play the events and the reviews, parts the campaigns, brands the advertisers, customers the
users, order priorities the devices and nations the places. Web events play the page creations and the
short messages. Each view joins only the tables its requested columns come from; every join is to a
unique key that is always present, so leaving one out changes no rows. No side is broadcast by hint: Spark
broadcasts a table whose file size is under its limit and shuffles it otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

EVENT_COLUMNS = (
    "event_id", "advertiser_name", "campaign_name", "target_country", "user_id", "location", "device",
    "ad_slot_size", "event_timestamp", "bid_amount", "ad_cost", "was_clicked", "click_timestamp",
    "ad_revenue", "event_date",
)
FACT_COLUMNS = (
    "event_id", "campaign_id", "user_id", "location_id", "device_id", "timestamp", "bid_amount", "ad_cost",
    "was_clicked", "click_timestamp", "ad_revenue",
)
WEB_DOMAINS = ("click", "view", "purchase")  # the event types taken as allowed sites


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the file once per process and not for every query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def name_id(name: Column) -> Column:
    """A number from a name, the same wherever and whenever it is computed."""
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")


def _campaign_name() -> Column:
    return F.concat_ws("/", "p_brand", "p_type")


def _line_key() -> Column:
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").cast("string")
    )


def _line_columns() -> dict[str, Column]:
    clicked = F.col("l_returnflag") == "R"
    cost = F.col("l_extendedprice").cast("decimal(12,2)")
    return {
        "event_id": F.md5(_line_key()),
        "event_timestamp": F.col("l_shipdate"),
        "timestamp": F.col("l_shipdate"),
        "event_date": F.to_date("l_shipdate"),
        "was_clicked": clicked,
        "click_timestamp": F.when(clicked, F.col("l_shipdate") + F.make_dt_interval(mins=F.col("l_linenumber"))),
        "bid_amount": F.col("l_quantity").cast("decimal(10,2)"),
        "ad_cost": cost,
        "ad_revenue": (cost * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(12,2)"),
    }


def _lines(spark: SparkSession, sf_dir: str, wanted: set[str], lines: DataFrame | None = None) -> DataFrame:
    """Line items (all, or those given) with the source columns of `wanted` joined to them."""
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    if wanted & {"campaign_name", "advertiser_name", "campaign_id", "ad_slot_size"}:
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"),
            _campaign_name().alias("campaign_name"),
            name_id(_campaign_name()).alias("campaign_id"),
            F.col("p_brand").alias("advertiser_name"),
            F.concat("p_size", F.lit("x"), F.col("p_size") * 2).alias("ad_slot_size"),
        )
        lines = lines.join(part, "l_partkey")
    if wanted & {"user_id", "device", "device_id", "location", "location_id"}:
        orders = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderpriority").alias("device"),
            _device_id().alias("device_id"),
        )
        if wanted & {"location", "location_id"}:
            customer = table(spark, sf_dir, "customer").select(
                F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("location_id")
            )
            if "location" in wanted:
                nation = table(spark, sf_dir, "nation").select(
                    F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("location")
                )
                customer = customer.join(nation, "location_id")
            orders = orders.join(customer, "user_id")
        lines = lines.join(orders, "l_orderkey")
    if "target_country" in wanted:
        supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        nation = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("target_country")
        )
        lines = lines.join(supplier.join(nation, "s_nationkey"), "l_suppkey")
    return lines


def _project(lines: DataFrame, wanted: tuple[str, ...]) -> DataFrame:
    computed = _line_columns()
    return lines.select(*[computed[c].alias(c) if c in computed else F.col(c) for c in wanted])


def ad_events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Cleaned flat events."""
    wanted = columns or EVENT_COLUMNS
    return _project(_lines(spark, sf_dir, set(wanted)), wanted)


def ad_events_of(spark: SparkSession, sf_dir: str, lines: DataFrame, *columns: str) -> DataFrame:
    """Cleaned flat events of some of the line items: a stream of them, or one batch."""
    return _project(_lines(spark, sf_dir, set(columns), lines), columns)


def ad_facts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Events of the normalised model."""
    wanted = columns or FACT_COLUMNS
    return _project(_lines(spark, sf_dir, set(wanted)), wanted)


def dirty_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of which some have no campaign (quantity 50) or one that nobody knows (quantity 49)."""
    lines = _lines(spark, sf_dir, set(FACT_COLUMNS))
    qty = F.col("l_quantity").cast("int")
    known = F.when(qty == 50, None).when(qty == 49, F.lit(-1)).otherwise(F.col("campaign_id"))
    return _project(lines.withColumn("campaign_id", known), FACT_COLUMNS)


def advertisers(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("name")).distinct()
    return brands.select(name_id(F.col("name")).alias("advertiser_id"), "name")


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand and type of a part; the budget is 2080 times the summed retail price."""
    price = F.sum(F.col("p_retailprice").cast("decimal(12,2)"))
    return (
        table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(price.alias("price"))
        .select(
            name_id(_campaign_name()).alias("campaign_id"),
            name_id(F.col("p_brand")).alias("advertiser_id"),
            _campaign_name().alias("campaign_name"),
            (F.col("price").cast("decimal(16,2)") * 2080).cast("decimal(18,2)").alias("budget"),
        )
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("country_name")
    )


def _device_id() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return used.select(_device_id().alias("device_id"), F.col("o_orderpriority").alias("device_name"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; one with a negative balance has no country."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        (18 + F.col("c_nationkey") * 2).cast("smallint").alias("age"),
        F.when(F.col("c_mktsegment") < "F", "F").otherwise("M").alias("gender"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("country_id"),
        F.concat_ws(
            ", ", F.lower("c_mktsegment"),
            F.when(F.col("c_acctbal") < 0, "credit").when(F.col("c_acctbal") > 5000, "savings"),
            F.lit(""),
        ).alias("interests"),
        "c_acctbal",
    )


def solvent_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users(spark, sf_dir).filter(F.col("c_acctbal") >= 0).select("user_id")


def raw_ad_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns as a file would hold them, some of them dirty.

    Lines numbered 7 have an unreadable time, those of quantity 50 an unreadable cost, of quantity 49 no
    event id, of quantity 48 no user, and return flag A leaves the place without a name.
    """
    e = _lines(spark, sf_dir, {"campaign_name", "advertiser_name", "user_id", "device", "location",
                               "target_country", "ad_slot_size"})
    line = _line_columns()
    qty = F.col("l_quantity").cast("int")
    text = "yyyy-MM-dd HH:mm:ss"
    return e.select(
        F.when(qty == 49, None).otherwise(F.concat(F.lit("{"), F.upper(line["event_id"]), F.lit("}"))).alias("EventID"),
        F.concat(F.lit(" "), F.col("advertiser_name")).alias("AdvertiserName"),
        F.concat(F.col("campaign_name"), F.lit("  ")).alias("CampaignName"),
        F.col("target_country").alias("CampaignTargetingCountry"),
        F.when(qty != 48, F.col("user_id")).cast("string").alias("UserID"),
        F.when(F.col("l_returnflag") != "A", F.col("location")).alias("Location"),
        F.col("device").alias("Device"),
        F.col("ad_slot_size").alias("AdSlotSize"),
        F.when(F.col("l_linenumber") == 7, "not a time")
        .otherwise(F.date_format("l_shipdate", text)).alias("Timestamp"),
        line["bid_amount"].cast("string").alias("BidAmount"),
        F.when(qty == 50, "abc").otherwise(line["ad_cost"].cast("string")).alias("AdCost"),
        F.when(F.col("l_returnflag") == "R", " TRUE ").when(F.col("l_returnflag") == "A", "yes")
        .otherwise("false").alias("WasClicked"),
        F.date_format(line["click_timestamp"], text).alias("ClickTimestamp"),
        line["ad_revenue"].cast("string").alias("AdRevenue"),
    )


def _rating() -> Column:
    """1 to 5 from the quantity; parts of size 46 and up are liked: 4 or 5."""
    qty = F.col("l_quantity").cast("int")
    return F.when(F.col("p_size") >= 46, F.when(qty % 5 == 0, 4).otherwise(5)).otherwise(1 + qty % 5)


def _review_columns() -> dict[str, Column]:
    return {
        "review_id": _line_key(),
        "product_id": F.col("l_partkey").cast("string"),
        "customer_id": F.col("o_custkey").cast("string"),
        "marketplace": F.col("l_returnflag"),
        "product_title": F.col("p_name"),
        "product_category": F.col("p_type"),
        "star_rating": _rating(),
        "helpful_votes": F.col("l_linenumber"),
        "total_votes": F.col("l_quantity").cast("int"),
        "vine": F.when(F.col("l_tax") > 0.04, 1).otherwise(0),
        "verified_purchase": F.when(F.col("l_linestatus") == "O", 1).otherwise(0),
        "review_headline": F.concat_ws(" ", "p_brand", "p_name"),
        "review_body": F.concat_ws(" ", "p_name", "p_type", "l_returnflag"),
        "review_date": F.to_date("l_shipdate"),
    }


def reviews(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Cleaned reviews. Lines are joined to the orders before the texts of the parts make them wide."""
    computed = _review_columns()
    wanted = columns or tuple(computed)
    lines = table(spark, sf_dir, "lineitem")
    if "customer_id" in wanted:
        orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        lines = lines.join(orders, "l_orderkey")
    if set(wanted) & {"product_title", "product_category", "star_rating", "review_headline", "review_body"}:
        part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
        lines = lines.join(part, "l_partkey")
    return lines.select(*[computed[c].alias(c) for c in wanted])


def verified_reviews(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    kept = reviews(spark, sf_dir, *columns, "verified_purchase")
    return kept.filter(F.col("verified_purchase") == 1).select(*columns)


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review text columns, some dirty: lines numbered 7 have an unreadable date, quantity 50 a rating of
    6, 49 the rating "Y", 48 no customer, 47 no date, and ratings of quantity 46 are written as decimals."""
    qty = F.col("l_quantity").cast("int")
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey"), "l_partkey")
        .join(
            table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"),
            "l_orderkey",
        )
    )
    columns = {name: c.cast("string") for name, c in _review_columns().items()}
    columns["star_rating"] = (
        F.when(qty == 50, "6").when(qty == 49, "Y").when(qty == 46, F.concat(columns["star_rating"], F.lit(".0")))
        .otherwise(columns["star_rating"])
    )
    columns["customer_id"] = F.when(qty != 48, columns["customer_id"])
    columns["review_date"] = (
        F.when(F.col("l_linenumber") == 7, F.date_format("l_shipdate", "MM/dd/yyyy"))
        .when(qty != 47, columns["review_date"])
    )
    return lines.select(*[c.alias(name) for name, c in columns.items()])


def _page_event(domain: Column) -> Column:
    return F.to_json(F.struct(
        F.struct(domain.alias("domain"), _iso("ts").alias("dt")).alias("meta"),
        F.concat(F.lit("page_"), F.get_json_object("props", "$.k")).alias("page_title"),
        F.struct(F.col("user_id"), (F.col("user_id") % 5 == 0).alias("user_is_bot")).alias("performer"),
    ))


def page_messages(events: DataFrame) -> DataFrame:
    """Page-creation messages from web events (a batch frame or a stream)."""
    return events.select(_page_event(F.col("event_type")).alias("value"))


def intake_messages(events: DataFrame) -> DataFrame:
    """The same messages as they may arrive: those of a value below 1 are blank, below 2 cut off in the
    middle, and above 300 without a domain."""
    amount = F.col("value")
    text = _page_event(F.when(amount <= 300, F.col("event_type")))
    return events.select(
        F.when(amount < 1, "  ").when(amount < 2, F.substring(text, 1, 20)).otherwise(text).alias("value")
    )


def _iso(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def dirty_tweets(events: DataFrame) -> DataFrame:
    """The same rows as messages, of which those of a value below 1 are cut off and below 2 have no readable time."""
    amount = F.col("value")
    row = F.struct(
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(amount < 2, F.concat(F.lit("on "), _iso("ts"))).otherwise(_iso("ts")).alias("review_date"),
        F.col("props").alias("review_body"))
    return events.select(F.when(amount < 1, F.substring(F.to_json(row), 1, 20)).otherwise(F.to_json(row)).alias("value"))


def tweets(events: DataFrame) -> DataFrame:
    """Rows of the short-message topic."""
    return events.select(
        F.col("user_id").cast("string").alias("customer_id"),
        _iso("ts").alias("review_date"),
        F.col("props").alias("review_body"),
    )
