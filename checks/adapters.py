"""The given test tables as the four topics.

Each ``raw_*`` function returns a table in the shape of the raw layer; ``messages`` turns such a
table back into JSON messages. The same definitions in SQL are in oracle.py. They plant what
test data lacks: replays, missing keys, short and unknown dwell times, orders without items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierlake.schemas import LINE_ITEM, TOPICS
from tierlake.session import apply_runtime_options

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_runtime_options(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def _user(number: str) -> Column:
    return _padded("USR-", F.col(number), 6)


def _shift_minutes(ts: str, minutes: Column) -> Column:
    return F.col(ts) + F.make_dt_interval(mins=minutes)


def _pick(index: Column, *values: str) -> Column:
    """The value at position ``index``, the last one for any larger index."""
    *most, last = values
    out = F.lit(last)
    for i, value in reversed(list(enumerate(most))):
        out = F.when(index == i, value).otherwise(out)
    return out


def _copies(df: DataFrame, replayed: Column) -> DataFrame:
    """Each row as copy 1, and the replayed ones as copy 2 too."""
    both = F.array(F.lit(1), F.lit(2))
    return df.withColumn("copy", F.explode(F.when(replayed, both).otherwise(F.array(F.lit(1)))))


def _as_raw(df: DataFrame, folder: str) -> DataFrame:
    """Columns and types of the raw table of a topic."""
    df = df.withColumn("ingestion_date", F.to_date("ingested_at"))
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in TOPICS[folder].raw.fields))


def raw_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("event_ts", F.col("ts").cast("timestamp"))
    i, kind = F.col("event_id"), F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    return _as_raw(e.select(
        F.lit("clickstream").alias("topic"),
        (i % 3).cast("int").alias("partition"),
        i.alias("offset"),
        F.col("event_ts").alias("kafka_ts"),
        F.when(i % 97 != 0, F.concat(F.lit("S-"), F.col("user_id").cast("string"), F.lit("-"),
                                     F.date_format("event_ts", "yyyyMMdd"))).alias("session_id"),
        _user("user_id").alias("user_id"),
        F.when(kind == "click", "scroll").when(kind == "signup", "search")
        .when(kind == "purchase", "add_to_cart").when(kind == "error", "remove_from_cart")
        .otherwise("view").alias("event_type"),
        F.concat(F.lit("/p"), (i % 8).cast("string")).alias("page"),
        _pick(i % 3, "mobile_app", "desktop_web", "tablet_web").alias("platform"),
        _pick(i % 3, "organic", "email", "direct").alias("traffic_src"),
        F.when((kind == "signup") & (i % 13 != 0),
               F.concat(_pick(i % 2, "KW", "kw"), (k % 3).cast("string"))).alias("keyword"),
        F.when(i % 5 < 2, _padded("SKU-", i % 250, 5)).alias("sku"),
        F.when(i % 53 != 0, F.floor(F.col("value") * 10)).alias("dwell_ms"),
        F.concat(F.lit("10."), (F.col("user_id") % 256).cast("string"), F.lit("."),
                 (i % 256).cast("string"), F.lit(".7")).alias("ip"),
        "event_ts", F.col("event_ts").alias("ingested_at"),
    ), "clickstream")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return table(spark, sf_dir, "orders").withColumn(
        "event_ts", F.col("o_orderdate").cast("timestamp") + hour)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, items``. An order is one message, so its items are bounded by the message
    size; they are sorted to make the array independent of row order."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    # Lines move to their order before they are collected: collecting in the join's tasks first would
    # sort, and spill, all lines there for next to nothing, as those tasks have lines by part.
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).repartition("l_orderkey")
    sort_first = F.struct(
        _padded("SKU-", F.col("l_partkey"), 5).alias("sku"),
        F.col("l_extendedprice").alias("subtotal"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("p_name").alias("title"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"))
    grouped = joined.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sort_array(F.collect_list(sort_first)).alias("sorted"))
    return grouped.select("o_orderkey", F.transform(
        "sorted", lambda s: F.struct(*(s[n].alias(n) for n in LINE_ITEM.names))).alias("items"))


def raw_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    m5 = key % 5
    orders = _orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "event_ts", cents.alias("total_cents"),
        F.expr("(cast(round(o_totalprice * 100) as bigint) * (100 - (o_orderkey % 5) * 5) + 50)"
               " div 100").alias("final_cents"))
    first_of_replayed = (F.col("copy") == 1) & (key % 10 == 0)
    at = _shift_minutes("event_ts", F.col("copy") - 1)
    heads = _copies(orders, key % 10 == 0).join(
        order_items(spark, sf_dir), "o_orderkey", "left")
    return _as_raw(heads.select(
        F.lit("purchases").alias("topic"),
        (key % 3).cast("int").alias("partition"),
        (key * 2 + F.col("copy")).alias("offset"),
        at.alias("kafka_ts"),
        F.concat(F.lit("ORD-"), key.cast("string")).alias("order_id"),
        F.when(key % 89 != 0, _user("o_custkey")).alias("user_id"),
        F.when(first_of_replayed, "placed").when(status == "P", "returned")
        .when(status == "F", "delivered").otherwise("placed").alias("status"),
        F.coalesce("items", F.array().cast("array<struct<sku:string,title:string,category:string,"
                                           "qty:int,unit_price:double,subtotal:double>>"))
        .alias("items"),
        (F.col("total_cents").cast("double") / 100).alias("total_amount"),
        (m5 * 5).cast("double").alias("discount_pct"),
        (F.col("final_cents").cast("double") / 100).alias("final_amount"),
        _pick(key % 4, "card", "upi", "wallet", "cod").alias("payment_method"),
        F.when(m5 < 3, "success").when(m5 == 3, "failed").otherwise("pending")
        .alias("payment_status"),
        F.lit("IN").alias("ship_country"),
        ((status == "P") & ~first_of_replayed).alias("is_return"),
        "event_ts", at.alias("ingested_at"),
    ), "purchases")


def _document_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text"))


def _with_text(df: DataFrame, spark: SparkSession, sf_dir: str, number: str) -> DataFrame:
    """Attach the text of document ``number % count(documents)``. Rows come out sorted by their
    document, so that files hold its copies side by side."""
    total = table(spark, sf_dir, "documents").agg(F.count("*").alias("_docs"))
    picked = df.crossJoin(F.broadcast(total)).withColumn("_doc", F.col(number) % F.col("_docs"))
    texts = _document_text(spark, sf_dir).hint("merge")
    return picked.join(texts, "_doc", "left").drop("_doc", "_docs")


def _label(hundredths: Column) -> Column:
    return F.when(hundredths >= 5, "positive").when(hundredths <= -5, "negative").otherwise(
        "neutral")


def raw_product_reviews(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    key = F.col("o_orderkey")
    hundredths = (key * 37) % 201 - 100
    at = _shift_minutes("event_ts", F.col("copy") - 1)
    rows = _copies(_orders(spark, sf_dir), key % 9 == 0)
    if with_text:
        rows = _with_text(rows, spark, sf_dir, "o_orderkey")
    return _as_raw(rows.select(
        F.lit("product-reviews").alias("topic"),
        (key % 2).cast("int").alias("partition"),
        (key * 2 + F.col("copy")).alias("offset"),
        at.alias("kafka_ts"),
        F.concat(F.lit("RVW-"), key.cast("string")).alias("review_id"),
        # Some users never have a review of their own, so that profiles miss that section.
        F.when((key % 83 != 0) & (F.col("o_custkey") % 7 != 0), _user("o_custkey"))
        .alias("user_id"),
        _padded("SKU-", key % 250, 5).alias("sku"),
        F.when((F.col("copy") == 1) & (key % 9 == 0), 3)
        .otherwise(6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("rating"),
        (F.col("_text") if with_text else F.lit(None)).alias("review_text"),
        (key % 5 != 0).alias("verified_purchase"),
        (key % 81).alias("helpful_votes"),
        _label(hundredths).alias("sentiment_label"),
        (hundredths.cast("double") / 100).alias("sentiment_score"),
        "event_ts", at.alias("ingested_at"),
    ), "product_reviews")


def raw_social_buzz(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    i = F.col("event_id")
    hundredths = (i * 53) % 201 - 100
    e = table(spark, sf_dir, "events")
    rows = _copies(e.withColumn("event_ts", F.col("ts").cast("timestamp")), i % 11 == 0)
    if with_text:
        rows = _with_text(rows, spark, sf_dir, "event_id")
    at = _shift_minutes("event_ts", F.col("copy") - 1)
    tags = F.filter(F.array(F.when(i % 3 != 1, "#a"), F.when(i % 3 != 2, "#b")),
                    lambda t: t.isNotNull())
    return _as_raw(rows.select(
        F.lit("social-buzz").alias("topic"),
        (i % 2).cast("int").alias("partition"),
        (i * 2 + F.col("copy")).alias("offset"),
        at.alias("kafka_ts"),
        F.when(i % 101 != 0, F.concat(F.lit("PST-"), i.cast("string"))).alias("post_id"),
        _pick(i % 4, "instagram", "twitter", "facebook", "youtube").alias("platform"),
        F.when((i % 7 != 0) & (F.col("user_id") % 11 != 0), _user("user_id")).alias("user_id"),
        (F.col("_text") if with_text else F.lit(None)).alias("content"),
        tags.alias("hashtags"),
        F.when((F.col("copy") == 1) & (i % 11 == 0), 0).otherwise(F.floor("value"))
        .alias("likes"),
        F.get_json_object("props", "$.k").cast("int").alias("shares"),
        _label(hundredths).alias("sentiment_label"),
        (hundredths.cast("double") / 100).alias("sentiment_score"),
        F.lit("en").alias("lang"),
        "event_ts", at.alias("ingested_at"),
    ), "social_buzz")


#: The free text of the topics that have one; it is read only where a query shows it.
TEXT_COLUMNS = {"product_reviews": "review_text", "social_buzz": "content"}

RAW = {
    "clickstream": raw_clickstream,
    "purchases": raw_purchases,
    "product_reviews": raw_product_reviews,
    "social_buzz": raw_social_buzz,
}


def messages(raw: DataFrame, folder: str) -> DataFrame:
    """A raw table as the messages it was parsed from."""
    topic = TOPICS[folder]
    stamp = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp")
    body = [stamp if n == "timestamp" else F.col(n) for n in topic.message.names]
    return raw.select(
        F.to_json(F.struct(*body)).cast("binary").alias("value"),
        "topic", "partition", "offset", F.col("kafka_ts").alias("timestamp"))
