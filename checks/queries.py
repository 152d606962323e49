"""Every operator as a query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, StringType, StructField, StructType, TimestampType)

from checks import adapters
from tierlake.functions import bands, privacy
from tierlake.functions.numeric import ratio
from tierlake.functions.text import title_text
from tierlake.operators import metrics, profiles, quality, segments, sentiment
from tierlake.operators.clean import clean_topic, explode_items
from tierlake.operators.dedup import dedup_topic
from tierlake.plans import incremental, jobs, serving
from tierlake.schemas import METRICS, PROFILE, TOPICS
from tierlake.session import COMPRESSION, materialise, run_together, scratch_path
from tierlake.sinks.keyed import by_month
from tierlake.sinks.parquet import write_layer
from tierlake.sources.messages import FileLog, parse_topic, quarantine, read_topic_batch
from tierlake.sources.tables import scan_table, table_stream
from tierlake.streaming.clean_log import CleanLog, stream_clean
from tierlake.streaming.metrics import metric_table, stream_hourly, stream_sentiment
from tierlake.streaming.profiles import profile_table, stream_profiles
from tierlake.streaming.raw import stream_raw
from tierlake.streaming.run import DRAIN, wait_for

AS_OF = datetime(2002, 1, 1)
EARLIER = datetime(2001, 12, 1)
HORIZON_AS_OF = datetime(2001, 6, 30)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Times as zone-less UTC wall-clock times, so that every client prints them alike."""
    return df.select(*(F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, TimestampType) else F.col(f.name)
                       for f in df.schema.fields))


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(build(spark, sf_dir))

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return run


def _raw(spark: SparkSession, sf_dir: str, folder: str, with_text: bool = False) -> DataFrame:
    texts = {"with_text": True} if with_text and folder in adapters.TEXT_COLUMNS else {}
    return adapters.RAW[folder](spark, sf_dir, **texts)


def _clean(spark: SparkSession, sf_dir: str, folder: str, with_text: bool = False) -> DataFrame:
    return clean_topic(_raw(spark, sf_dir, folder, with_text), folder)


def _stored_clean(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """What profiles read of a clean table, at rest: they read each more than once."""
    return materialise(_clean(spark, sf_dir, folder).select(*profiles.READS[folder]), folder)


def _messages(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """With whole documents as the texts of reviews and posts."""
    return adapters.messages(_raw(spark, sf_dir, folder, with_text=True), folder)


# -- sources ---------------------------------------------------------------------------------

def _append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("compression", COMPRESSION).parquet(path)


def _topic_files(spark: SparkSession, sf_dir: str, folders=tuple(TOPICS)) -> FileLog:
    """The topics as archived logs."""
    log = FileLog(scratch_path(spark, "topics"))
    run_together(spark, lambda f: _append(_messages(spark, sf_dir, f), log.path(TOPICS[f])),
                 folders)
    return log


def _write_in_parts(rows: DataFrame, path: str, parts: int = 3) -> int:
    """Append rows in parts by their offset, each written by as many tasks as the rows have; copies
    of a message fall into any part. Returns the files of a part: a stream that takes so many at a
    time has a part in each batch."""
    stored = materialise(rows, "source")
    for part in range(parts):
        _append(stored.filter(F.pmod(F.xxhash64("offset"), F.lit(parts)) == part), path)
    written = rows.sparkSession.read.schema(rows.schema).parquet(path).inputFiles()
    return -(-len(written) // parts)


def _parsed(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    return _parse(_messages(spark, sf_dir, folder), folder)


def _parse(messages: DataFrame, folder: str) -> DataFrame:
    return parse_topic(messages, TOPICS[folder].message, F.col("kafka_ts"))


@query
def ingest_topic_batch(spark, sf_dir):
    """Bounded read of a topic, parsed."""
    log = _topic_files(spark, sf_dir, ("product_reviews",))
    topic = TOPICS["product_reviews"]
    return parse_topic(read_topic_batch(spark, log, topic), topic.message,
                       F.col("kafka_ts"))


@query
def ingest_topic_stream(spark, sf_dir):
    """Stream over a topic in several micro-batches, parsed and stamped with one load time."""
    return _streamed_raw(spark, sf_dir, "product_reviews", F.lit(AS_OF))


@query
def stream_raw_to_parquet(spark, sf_dir):
    return _streamed_raw(spark, sf_dir, "clickstream", F.col("kafka_ts"))


def _streamed_raw(spark: SparkSession, sf_dir: str, folder: str,
                  ingested_at: Column) -> DataFrame:
    root = scratch_path(spark, "topics")
    files = _write_in_parts(_messages(spark, sf_dir, folder), FileLog(root).path(TOPICS[folder]))
    log = FileLog(root, {"maxFilesPerTrigger": str(files)})
    path, checkpoint = scratch_path(spark, "raw"), scratch_path(spark, "checkpoint")
    wait_for([stream_raw(spark, log, TOPICS[folder], path, checkpoint, DRAIN,
                         ingested_at)])
    return scan_table(spark, path, TOPICS[folder].raw)


@query
def parse_clickstream(spark, sf_dir):
    return _parsed(spark, sf_dir, "clickstream")


def _items_as_text(df: DataFrame) -> DataFrame:
    def line(i):
        return F.concat_ws("|", i["sku"], i["title"], i["category"], i["qty"].cast("string"),
                           i["unit_price"].cast("decimal(16,2)").cast("string"),
                           i["subtotal"].cast("decimal(16,2)").cast("string"))

    return df.withColumns({"n_items": F.size("items").cast("long"),
                           "items": F.array_join(F.transform("items", line), ";")})


@query
def parse_purchases(spark, sf_dir):
    return _items_as_text(_parsed(spark, sf_dir, "purchases"))


@query
def parse_reviews(spark, sf_dir):
    return _parsed(spark, sf_dir, "product_reviews")


@query
def parse_social(spark, sf_dir):
    return _parsed(spark, sf_dir, "social_buzz").withColumn(
        "hashtags", F.array_join("hashtags", ","))


@query
def parse_quarantine(spark, sf_dir):
    """Click messages of which some are cut short, hold a wrong type, a bad time or nothing."""
    text, n = F.col("value").cast("string"), F.col("offset")
    damaged = (F.when(n % 61 == 0, F.expr("left(cast(value as string), 25)"))
               .when(n % 67 == 0, F.regexp_replace(text, '"page":"[^"]*"', '"dwell_ms":"zz"'))
               .when(n % 71 == 0, F.regexp_replace(text, '"timestamp":"[^"]*"',
                                                   '"timestamp":"nope"'))
               .when(n % 73 != 0, text))
    messages = _messages(spark, sf_dir, "clickstream").withColumn(
        "value", damaged.cast("binary"))
    return quarantine(messages, TOPICS["clickstream"].message).select(
        "topic", "partition", "offset", "kafka_ts", "reason")


@query
def scan_parquet(spark, sf_dir):
    """Scan of a stored raw table, restricted to a range of its date partitions."""
    path = scratch_path(spark, "raw")
    write_layer(_raw(spark, sf_dir, "clickstream"), path)
    return scan_table(spark, path, TOPICS["clickstream"].raw,
                      dates=(date(2024, 1, 10), date(2024, 1, 19)))


# -- sinks -----------------------------------------------------------------------------------

@query
def write_partitioned(spark, sf_dir):
    """Overwrite a table, then only some of its dates."""
    path = scratch_path(spark, "raw")
    raw = _raw(spark, sf_dir, "clickstream")
    write_layer(raw, path)
    redo = raw.filter(F.col("ingestion_date").between(F.lit(date(2024, 1, 5)),
                                                      F.lit(date(2024, 1, 7))))
    write_layer(redo.withColumn("dwell_ms", F.lit(0)), path, only_written_dates=True,
                gather=True)
    return scan_table(spark, path, TOPICS["clickstream"].raw).groupBy("ingestion_date").agg(
        F.count("*").alias("n"), F.sum("dwell_ms").alias("dwell_ms"))


@query
def upsert_profiles(spark, sf_dir):
    """Profiles stored for all users, then stored again, later, for the ids ending in 3."""
    table = profile_table(spark, scratch_path(spark, "profiles"), buckets=8)
    rows = materialise(_profiles(spark, sf_dir), "profiles")
    table.upsert(rows.withColumn("updated_at", F.lit(EARLIER)))
    table.upsert(rows.filter(F.col("user_id").endswith("3")))
    return profiles.flatten_profiles(table.read())


@query
def conform_metrics(spark, sf_dir):
    table = METRICS["hourly_sentiment"]
    rows = metrics.hourly_sentiment(_clean(spark, sf_dir, "product_reviews"),
                                    _clean(spark, sf_dir, "social_buzz"))
    loose = rows.withColumn("mean_sentiment", F.when(
        F.col("total_cnt") > 1, F.col("mean_sentiment").cast("string")))
    return quality.fill_defaults(quality.conform(loose, table, F.lit(AS_OF)), table)


@query
def contract_violations(spark, sf_dir):
    rows = metrics.hourly_sales(_clean(spark, sf_dir, "purchases"))
    planted = rows.withColumn("category", F.when(F.col("num_orders") != 2, F.col("category")))
    return quality.contract_violations(planted, METRICS["hourly_sales"])


@query
def pk_violations(spark, sf_dir):
    return quality.pk_violations(_raw(spark, sf_dir, "purchases"), ["order_id"])


@query
def profile_validation(spark, sf_dir):
    """Profiles whose update time went missing, here for users without browsing data."""
    rows = _profiles(spark, sf_dir).withColumn(
        "updated_at", F.when(F.col("browsing").isNotNull(), F.col("updated_at")))
    _, invalid = quality.split_profiles(rows)
    return invalid.select("user_id")


@query
def layer_audit(spark, sf_dir):
    """Rows in and out of each clean table, counted by the job that writes it."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    jobs.raw_job(spark, _topic_files(spark, sf_dir), lake, F.lit(AS_OF))
    rows = [(o.table, o.rows_in, o.rows_out) for o in jobs.clean_job(spark, lake)]
    return spark.createDataFrame(rows, "table string, rows_in long, rows_out long")


# -- clean -----------------------------------------------------------------------------------

@query
def dedup_clickstream(spark, sf_dir):
    return dedup_topic(_raw(spark, sf_dir, "clickstream"), "clickstream")


@query
def dedup_purchases(spark, sf_dir):
    return dedup_topic(_raw(spark, sf_dir, "purchases").drop("items"), "purchases")


@query
def dedup_reviews(spark, sf_dir):
    return dedup_topic(_raw(spark, sf_dir, "product_reviews", with_text=True), "product_reviews")


@query
def dedup_social(spark, sf_dir):
    return dedup_topic(_raw(spark, sf_dir, "social_buzz", with_text=True), "social_buzz").select(
        "post_id", "user_id", "platform", "content", "likes", "shares", "offset", "ingested_at")


@query
def clean_clickstream(spark, sf_dir):
    return _clean(spark, sf_dir, "clickstream")


@query
def clean_purchases(spark, sf_dir):
    return _clean(spark, sf_dir, "purchases")


@query
def clean_reviews(spark, sf_dir):
    return _clean(spark, sf_dir, "product_reviews", with_text=True)


@query
def clean_social(spark, sf_dir):
    return _clean(spark, sf_dir, "social_buzz", with_text=True).withColumn(
        "hashtags", F.array_join("hashtags", ","))


@query
def explode_items_query(spark, sf_dir):
    return explode_items(_raw(spark, sf_dir, "purchases").select("order_id", "offset", "items"))


QUERIES["explode_items"] = QUERIES.pop("explode_items_query")


@query
def spend_band(spark, sf_dir):
    """Bands of order amounts scaled down so that all three occur."""
    amount = F.when(F.col("offset") % 50 != 1, F.col("final_amount") / 100)
    return _raw(spark, sf_dir, "purchases").select(
        "offset", amount.alias("amount")).withColumn("spend_band", bands.spend_band("amount"))


@query
def sentiment_band(spark, sf_dir):
    score = F.when(F.col("offset") % 50 != 1, F.col("sentiment_score"))
    return _raw(spark, sf_dir, "social_buzz").select("offset", score.alias("score")).withColumn(
        "sentiment_band", bands.sentiment_band("score"))


@query
def rating_group(spark, sf_dir):
    rating = F.when(F.col("offset") % 50 != 1, F.col("rating"))
    return _raw(spark, sf_dir, "product_reviews").select(
        "offset", rating.alias("rating")).withColumn("rating_group", bands.rating_group())


@query
def engagement_score(spark, sf_dir):
    score = bands.engagement_score()
    return _raw(spark, sf_dir, "social_buzz").select(
        "offset", "likes", "shares", score.alias("engagement_score"),
        (score > bands.VIRAL_SCORE).alias("is_viral"))


@query
def mask_pii(spark, sf_dir):
    """Free text of all documents with addresses and numbers masked."""
    docs = adapters.table(spark, sf_dir, "documents")
    return docs.select("doc_id", privacy.mask_text(F.col("text")).alias("text"))


@query
def mask_click_identity(spark, sf_dir):
    """Clicks with the last octet of the address masked and the user replaced by a digest."""
    return _raw(spark, sf_dir, "clickstream").select(
        "offset", privacy.mask_ip(F.col("ip")).alias("ip"),
        privacy.pseudonym(F.col("user_id"), "salt:").alias("user_digest"))


@query
def clean_reviews_masked(spark, sf_dir):
    """Clean reviews, with whole documents as their texts, masked."""
    clean = _clean(spark, sf_dir, "product_reviews", with_text=True)
    return privacy.mask_table(clean, "salt:").select(
        "review_id", "user_id", "review_text")


@query
def score_sentiment(spark, sf_dir):
    return sentiment.score_sentiment(adapters.table(spark, sf_dir, "documents"), "doc_id",
                                     "text")


@query
def sentiment_label(spark, sf_dir):
    scored = sentiment.score_sentiment(adapters.table(spark, sf_dir, "documents"), "doc_id",
                                       "text")
    return scored.groupBy("sentiment_label").agg(F.count("*").alias("n"))


@query
def order_amount_check(spark, sf_dir):
    return quality.order_amount_check(
        dedup_topic(_raw(spark, sf_dir, "purchases"), "purchases"))


# -- metrics ---------------------------------------------------------------------------------

@query
def hourly_sales(spark, sf_dir):
    return metrics.hourly_sales(_clean(spark, sf_dir, "purchases"))


@query
def hourly_search_trends(spark, sf_dir):
    return metrics.hourly_search_trends(_clean(spark, sf_dir, "clickstream"))


@query
def hourly_site_traffic(spark, sf_dir):
    return metrics.hourly_site_traffic(_clean(spark, sf_dir, "clickstream"))


@query
def hourly_sentiment(spark, sf_dir):
    return metrics.hourly_sentiment(_clean(spark, sf_dir, "product_reviews"),
                                    _clean(spark, sf_dir, "social_buzz"))


@query
def distinct_exact(spark, sf_dir):
    clicks = _clean(spark, sf_dir, "clickstream")
    return clicks.groupBy("platform").agg(
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("session_id").alias("sessions"))


@query
def distinct_approx(spark, sf_dir):
    """Exact counts, and whether the approximate ones are within three standard errors."""
    clicks = materialise(_clean(spark, sf_dir, "clickstream").select(
        "platform", "user_id", "session_id"), "clicks")
    error = 0.02
    # Apart, because exact counts are grouped by their values first: in one aggregate each value
    # would hold the sketches of its own.
    exact = clicks.groupBy("platform").agg(
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("session_id").alias("sessions"))
    rough = clicks.groupBy(F.col("platform").alias("_platform")).agg(
        F.approx_count_distinct("user_id", error).alias("_users"),
        F.approx_count_distinct("session_id", error).alias("_sessions"))

    def close(column: str) -> Column:
        return (F.abs(F.col(f"_{column}") - F.col(column)) <= 3 * error * F.col(column)).alias(
            f"{column}_close")

    both = exact.join(rough, F.col("platform").eqNullSafe(F.col("_platform")))
    return both.select("platform", "users", close("users"), "sessions", close("sessions"))


# -- segments --------------------------------------------------------------------------------

def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(segments.user_stats(_clean(spark, sf_dir, "purchases"),
                                           _clean(spark, sf_dir, "product_reviews")), "stats")


def _segments(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return segments.user_segments(
        _clean(spark, sf_dir, "purchases"), _clean(spark, sf_dir, "product_reviews"),
        **{"as_of": AS_OF, **options})


@query
def user_spend(spark, sf_dir):
    return segments.user_spend(_clean(spark, sf_dir, "purchases"))


@query
def user_ratings(spark, sf_dir):
    return segments.user_ratings(_clean(spark, sf_dir, "product_reviews"))


@query
def spend_percent_rank(spark, sf_dir):
    return segments.spend_percent_rank(_stats(spark, sf_dir)).select(
        "user_id", "revenue_30d", "spend_rank")


@query
def churn_score(spark, sf_dir):
    return segments.score_churn(_stats(spark, sf_dir)).select("user_id", "churn_score")


@query
def user_segments(spark, sf_dir):
    return _segments(spark, sf_dir)


@query
def user_segments_order_grain(spark, sf_dir):
    return _segments(spark, sf_dir, grain=segments.ORDER)


@query
def user_segments_30d(spark, sf_dir):
    return _segments(spark, sf_dir, horizon_days=30, as_of=HORIZON_AS_OF)


# -- profiles --------------------------------------------------------------------------------

def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = run_together(spark, lambda f: _stored_clean(spark, sf_dir, f), TOPICS)
    tables = dict(zip(TOPICS, stored))
    snapshot = segments.user_segments(tables["purchases"], tables["product_reviews"], AS_OF)
    return profiles.user_profiles(
        tables["purchases"], tables["product_reviews"], tables["clickstream"],
        tables["social_buzz"], snapshot, AS_OF)


@query
def profile_purchases(spark, sf_dir):
    return profiles.profile_purchases(_stored_clean(spark, sf_dir, "purchases"))


@query
def profile_purchases_order_grain(spark, sf_dir):
    return profiles.profile_purchases(_stored_clean(spark, sf_dir, "purchases"), segments.ORDER)


@query
def profile_reviews(spark, sf_dir):
    return profiles.profile_reviews(_clean(spark, sf_dir, "product_reviews"))


@query
def profile_browsing(spark, sf_dir):
    return profiles.profile_browsing(_stored_clean(spark, sf_dir, "clickstream"))


@query
def profile_social(spark, sf_dir):
    return profiles.profile_social(_clean(spark, sf_dir, "social_buzz")).withColumn(
        "platforms", F.array_join("platforms", ","))


@query
def preferred_payment(spark, sf_dir):
    return profiles.preferred_payment(_clean(spark, sf_dir, "purchases"))


@query
def top_platform(spark, sf_dir):
    return profiles.top_platform(_clean(spark, sf_dir, "clickstream"))


@query
def profile_keys(spark, sf_dir):
    return profiles.profile_keys(*(_clean(spark, sf_dir, f) for f in TOPICS))


@query
def user_profiles(spark, sf_dir):
    return profiles.flatten_profiles(_profiles(spark, sf_dir))


@query
def user_profiles_nested(spark, sf_dir):
    """Profiles as one JSON document each: fields in their order, without those that are null,
    measures as decimals with four places."""
    rows = _profiles(spark, sf_dir)
    sections = [_json_field(F.col(f.name), f) for f in PROFILE.fields if f.name != "updated_at"]
    return rows.select("user_id", F.concat(F.lit("{"), F.concat_ws(",", *sections), F.lit("}"))
                       .alias("document"))


def _json_field(value: Column, field: StructField) -> Column:
    """``"name":value``, null for a null value."""
    kind = field.dataType
    if isinstance(kind, StructType):
        inner = F.concat_ws(",", *(_json_field(value[f.name], f) for f in kind.fields))
        text = F.when(value.isNotNull(), F.concat(F.lit("{"), inner, F.lit("}")))
    elif isinstance(kind, ArrayType):
        text = F.concat(F.lit('["'), F.array_join(value, '","'), F.lit('"]'))
    elif isinstance(kind, DoubleType):
        text = value.cast("decimal(20,4)").cast("string")
    elif isinstance(kind, StringType):
        text = F.concat(F.lit('"'), value, F.lit('"'))
    else:
        text = value.cast("string")
    return F.concat(F.lit(f'"{field.name}":'), text)


@query
def profiles_limited(spark, sf_dir):
    return profiles.flatten_profiles(profiles.first_users(_profiles(spark, sf_dir), 50))


# -- read queries ----------------------------------------------------------------------------

@query
def kpi_sales(spark, sf_dir):
    return serving.kpi_sales(metrics.hourly_sales(_clean(spark, sf_dir, "purchases")))


@query
def kpi_traffic(spark, sf_dir):
    return serving.kpi_traffic(
        metrics.hourly_site_traffic(_clean(spark, sf_dir, "clickstream")))


@query
def segment_counts(spark, sf_dir):
    return serving.segment_counts(_segments(spark, sf_dir))


@query
def segment_share(spark, sf_dir):
    return serving.segment_share(_segments(spark, sf_dir))


@query
def revenue_by_category(spark, sf_dir):
    return serving.revenue_by_category(
        metrics.hourly_sales(_clean(spark, sf_dir, "purchases")))


@query
def traffic_series(spark, sf_dir):
    return serving.traffic_series(
        metrics.hourly_site_traffic(_clean(spark, sf_dir, "clickstream")))


@query
def top_keywords(spark, sf_dir):
    return serving.top_keywords(
        metrics.hourly_search_trends(_clean(spark, sf_dir, "clickstream")))


@query
def sentiment_breakdown(spark, sf_dir):
    return serving.sentiment_breakdown(metrics.hourly_sentiment(
        _clean(spark, sf_dir, "product_reviews"), _clean(spark, sf_dir, "social_buzz")))


@query
def profile_sentiment(spark, sf_dir):
    return serving.profile_sentiment(_profiles(spark, sf_dir))


@query
def recent_profiles(spark, sf_dir):
    return serving.recent_profiles(_profiles(spark, sf_dir))


@query
def profile_lookup(spark, sf_dir):
    found = serving.profile_lookup(_profiles(spark, sf_dir), " USR-000042 ")
    return profiles.flatten_profiles(found).join(
        found.select("user_id", "churn_level"), "user_id")


@query
def live_risk_count(spark, sf_dir):
    return serving.live_risk_count(_profiles(spark, sf_dir))


def _risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users at risk; only their list is a list of the top ones."""
    return serving.churn_risk_users(_segments(spark, sf_dir), top_n=None)


@query
def churn_risk_users(spark, sf_dir):
    return serving.churn_risk_users(_segments(spark, sf_dir))


@query
def churn_risk_summary(spark, sf_dir):
    return serving.churn_risk_summary(_risk(spark, sf_dir))


@query
def churn_histogram(spark, sf_dir):
    return serving.churn_histogram(_risk(spark, sf_dir))


@query
def churn_scatter(spark, sf_dir):
    return serving.churn_scatter(_risk(spark, sf_dir))


@query
def scalar_functions(spark, sf_dir):
    """Every scalar function the tables use, one row per click message."""
    ts = F.col("event_ts")
    hour = F.window("event_ts", "1 hour")
    return _raw(spark, sf_dir, "clickstream").select(
        "offset",
        F.col("page").cast("binary").cast("string").alias("text_of_bytes"),
        F.col("offset").cast("int").alias("as_int"),
        F.col("dwell_ms").cast("long").alias("as_long"),
        (F.col("dwell_ms") / 100).cast("decimal(16,2)").alias("as_decimal"),
        F.from_json(F.format_string('{"k": %d}', F.col("offset")), "k int")["k"].alias("json_k"),
        F.try_to_timestamp(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")).alias("ts"),
        F.try_to_timestamp(F.lit("nope")).isNull().alias("bad_ts_is_null"),
        F.to_date(ts).alias("day"), F.hour(ts).alias("hour"), F.dayofweek(ts).alias("weekday"),
        hour["start"].alias("window_start"), hour["end"].alias("window_end"),
        F.lower("keyword").alias("lowered"), title_text("event_type").alias("title"),
        F.trim(F.concat(F.lit("  "), F.col("user_id"), F.lit(" "))).alias("trimmed"),
        F.round(F.col("dwell_ms").cast("double") / 7, 2).alias("seventh"),
        ratio(F.col("offset"), F.col("offset") % 4, 2).alias("guarded"),
        F.when(F.col("dwell_ms") < 500, "short").otherwise("long").alias("length"),
        F.coalesce("keyword", F.lit("none")).alias("keyword_or_none"),
        F.col("event_type").isin("view", "scroll").alias("is_reading"),
        (~(F.col("dwell_ms") < 120)).alias("not_bot"),
        (F.col("keyword").isNotNull() & (F.col("event_type") == "search")).alias("searched"),
        F.sort_array(F.array("platform", "traffic_src"))[0].alias("first_of_two"),
    )


# -- jobs ------------------------------------------------------------------------------------

def _ran(outcomes: list[jobs.Outcome]) -> None:
    bad = [o for o in outcomes if o.status != jobs.DONE]
    if bad:
        raise RuntimeError(f"not done: {bad}")


def _lake(spark: SparkSession) -> jobs.Lake:
    return jobs.Lake(scratch_path(spark, "lake"))


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@query
def job_raw(spark, sf_dir):
    """The raw job over all topics; rows and last offset by table and date."""
    lake = _lake(spark)
    _ran(jobs.raw_job(spark, _topic_files(spark, sf_dir), lake, F.lit(AS_OF)))
    return _union(
        scan_table(spark, lake.path("raw", f), t.raw).groupBy(
            F.lit(f).alias("table"), "ingestion_date").agg(
                F.count("*").alias("n"), F.max("offset").alias("last_offset"))
        for f, t in TOPICS.items())


@query
def job_clean(spark, sf_dir):
    """Raw and clean jobs over all topics; rows and sum of offsets by table and date."""
    lake = _lake(spark)
    _ran(jobs.raw_job(spark, _topic_files(spark, sf_dir), lake, F.lit(AS_OF)))
    _ran(jobs.clean_job(spark, lake))
    return _union(
        scan_table(spark, lake.path("clean", f)).groupBy(
            F.lit(f).alias("table"), "ingestion_date").agg(
                F.count("*").alias("n"), F.sum("offset").alias("offsets"))
        for f in TOPICS)


def _full(spark: SparkSession, sf_dir: str) -> jobs.Lake:
    lake = _lake(spark)
    _ran(jobs.full_job(spark, _topic_files(spark, sf_dir), lake, F.lit(AS_OF), AS_OF))
    return lake


@query
def job_metrics(spark, sf_dir):
    """All jobs up to the metrics; rows and windows of each metric table."""
    lake = _full(spark, sf_dir)
    return _union(
        jobs.read_metric(spark, lake, name).agg(
            F.lit(name).alias("table"), F.count("*").alias("n"),
            F.count_distinct("window_start").alias("windows"))
        for name in METRICS).select("table", "n", "windows")


@query
def job_full(spark, sf_dir):
    """Topics to metrics, tables stored in between; the stored hourly sales."""
    return jobs.read_metric(spark, _full(spark, sf_dir), "hourly_sales").drop("created_at")


@query
def job_profiles(spark, sf_dir):
    """All jobs, with the profiles at the end."""
    lake = _full(spark, sf_dir)
    _ran([jobs.profiles_job(spark, lake, AS_OF, buckets=8)])
    table = profile_table(spark, lake.path("profiles", "user_profiles"), 8)
    return profiles.flatten_profiles(table.read())


def _incremental(spark: SparkSession, sf_dir: str) -> jobs.Lake:
    """All topics in two runs, the later one with a third of the messages: copies of messages fall
    into either, also the newer copy into the earlier run."""
    lake = incremental.incremental_lake(scratch_path(spark, "lake"))
    log = FileLog(scratch_path(spark, "topics"))
    for late in (False, True):
        def write(folder: str) -> None:
            messages = _messages(spark, sf_dir, folder)
            arrives_late = F.pmod(F.hash("offset"), F.lit(3)) == 0
            _append(messages.filter(arrives_late if late else ~arrives_late),
                    log.path(TOPICS[folder]))

        run_together(spark, write, TOPICS)
        _ran(incremental.incremental_job(spark, log, lake, F.trunc("kafka_ts", "month").cast(
            "timestamp"), AS_OF, part=incremental.MONTH))
    return lake


@query
def job_incremental(spark, sf_dir):
    """Two runs over what is new; the hourly sales they leave."""
    return incremental.read_hourly(spark, _incremental(spark, sf_dir), "hourly_sales").drop(
        "created_at")


# -- streams ---------------------------------------------------------------------------------

def _raw_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """A raw table as a stream of several batches; copies of a message fall into any of them."""
    path = scratch_path(spark, "raw")
    files = _write_in_parts(_raw(spark, sf_dir, folder, with_text=True), path)
    return table_stream(spark, path, TOPICS[folder].raw, files)


def _clean_logs(spark: SparkSession, sf_dir: str, *folders: str, masked: bool = False,
                salt: str | None = None) -> dict[str, CleanLog]:
    """Clean logs filled by streams, all topics at the same time."""
    root = scratch_path(spark, "logs")
    logs = {f: CleanLog(spark, f"{root}/{f}", f, "month") for f in folders}
    wait_for([stream_clean(_raw_stream(spark, sf_dir, f), log,
                           scratch_path(spark, "checkpoint"), DRAIN, masked, salt)
              for f, log in logs.items()])
    return logs


def _streamed_clean(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    return _clean_logs(spark, sf_dir, folder)[folder].clean()


@query
def stream_clean_clickstream(spark, sf_dir):
    return _streamed_clean(spark, sf_dir, "clickstream")


@query
def stream_clean_purchases(spark, sf_dir):
    return _streamed_clean(spark, sf_dir, "purchases")


@query
def stream_clean_reviews(spark, sf_dir):
    return _streamed_clean(spark, sf_dir, "product_reviews")


@query
def stream_clean_reviews_masked(spark, sf_dir):
    """The clean log of a stream that masks what it lands."""
    logs = _clean_logs(spark, sf_dir, "product_reviews", masked=True, salt="salt:")
    return logs["product_reviews"].clean().select("review_id", "user_id", "review_text")


@query
def stream_clean_social(spark, sf_dir):
    return _streamed_clean(spark, sf_dir, "social_buzz").withColumn(
        "hashtags", F.array_join("hashtags", ","))


def _streamed_metric(spark: SparkSession, sf_dir: str, name: str, *folders: str) -> DataFrame:
    logs = _clean_logs(spark, sf_dir, *folders)
    table = metric_table(spark, scratch_path(spark, name), name, by_month)
    wait_for([stream_hourly(logs, name, table, scratch_path(spark, "checkpoint"), DRAIN)])
    return table.read()


@query
def stream_hourly_sales(spark, sf_dir):
    return _streamed_metric(spark, sf_dir, "hourly_sales", "purchases")


@query
def stream_hourly_search_trends(spark, sf_dir):
    return _streamed_metric(spark, sf_dir, "hourly_search_trends", "clickstream")


@query
def stream_hourly_site_traffic(spark, sf_dir):
    return _streamed_metric(spark, sf_dir, "hourly_site_traffic", "clickstream")


@query
def stream_hourly_sentiment(spark, sf_dir):
    return _streamed_metric(spark, sf_dir, "hourly_sentiment", "product_reviews", "social_buzz")


def _clean_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """A clean table as a stream of several files in no order of time."""
    path = scratch_path(spark, "clean")
    clean = _clean(spark, sf_dir, folder).select("event_ts", "sentiment_score", "offset")
    clean.repartition(3, "offset").write.parquet(path)
    return table_stream(spark, path, clean.schema, 1)


def _incremental_sentiment(spark: SparkSession, events: DataFrame, late_by: str) -> DataFrame:
    table = metric_table(spark, scratch_path(spark, "sentiment"), "hourly_sentiment", by_month)
    wait_for([stream_sentiment(events, table, scratch_path(spark, "checkpoint"), late_by,
                               DRAIN)])
    return table.read()


@query
def stream_upsert_metrics(spark, sf_dir):
    """Changed windows of each micro-batch replace their rows in the keyed table."""
    events = metrics.sentiment_events(_clean_stream(spark, sf_dir, "product_reviews"),
                                      _clean_stream(spark, sf_dir, "social_buzz"))
    return _incremental_sentiment(spark, events, "40 years")


@query
def stream_late_data(spark, sf_dir):
    """Rows that come late, but within the watermark's delay, still change their hour. The
    files are in no order of time and span less than the delay, so no row may be lost."""
    events = metrics.scored_events(_clean_stream(spark, sf_dir, "social_buzz"), "social_buzz")
    return _incremental_sentiment(spark, events, "31 days")


@query
def stream_profile_refresh(spark, sf_dir):
    """Profiles kept by a stream over the clean logs of all topics."""
    logs = _clean_logs(spark, sf_dir, *TOPICS)
    snapshot = materialise(_segments(spark, sf_dir), "segments")
    table = profile_table(spark, scratch_path(spark, "profiles"), buckets=8)
    wait_for([stream_profiles(logs, lambda: snapshot, table, scratch_path(spark, "checkpoint"), DRAIN,
                              AS_OF)])
    return profiles.flatten_profiles(table.read())
