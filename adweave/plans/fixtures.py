"""Input tables of the registered queries, derived from the given parquet tables.

Each fixture is given twice: as a DataFrame and as the text of a common table expression for the
independent SQL check. Both use the same arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adweave.functions import scalar as fn

# Channels of the derived tables, in index order.
CHANNELS = ["search", "social", "display", "email", "direct"]
UPLIFT_DAY = "2001-03-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def channel_of_props() -> F.Column:
    return _pick(CHANNELS, F.get_json_object("props", "$.k").cast("int") % 5)


def exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type").isin("view", "click"))
        .select(F.col("event_id").alias("exposure_id"), "user_id", F.col("ts").alias("ts_exposure"), channel_of_props().alias("channel"))
    )


def conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .select(F.col("event_id").alias("conversion_id"), "user_id", F.col("ts").alias("ts_conversion"), F.col("value").alias("conversion_value"))
    )


SQL = {}
SQL["exposures"] = """SELECT event_id AS exposure_id, user_id, ts AS ts_exposure,
  CASE CAST(json_extract_string(props,'$.k') AS INT) % 5 WHEN 0 THEN 'search' WHEN 1 THEN 'social'
  WHEN 2 THEN 'display' WHEN 3 THEN 'email' ELSE 'direct' END AS channel
  FROM events WHERE event_type IN ('view','click')"""
SQL["conversions"] = """SELECT event_id AS conversion_id, user_id, ts AS ts_conversion, value AS conversion_value
  FROM events WHERE event_type = 'purchase'"""


def joined_sql(lookback_days: int, min_lag_hours: int = 0) -> str:
    return f"""SELECT c.conversion_id, c.user_id, c.ts_conversion, c.conversion_value, e.exposure_id, e.channel,
  e.ts_exposure, date_diff('microsecond', e.ts_exposure, c.ts_conversion)/3.6e9 AS hours
  FROM conversions c JOIN exposures e ON e.user_id = c.user_id
  AND date_diff('microsecond', e.ts_exposure, c.ts_conversion)/3.6e9 BETWEEN {min_lag_hours} AND {lookback_days * 24}"""


SQL["joined"] = joined_sql(7)


def identity_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    person = F.floor(key / 3).cast("long")
    email = F.concat(
        F.lit("user"), person.cast("string"), F.when(key % 3 == 1, ".2").otherwise(""), F.lit("@mail"), (person % 4).cast("string"), F.lit(".example")
    )
    return (
        table(spark, sf_dir, "customer")
        .select(
            key.alias("record_id"),
            person.alias("person_id"),
            F.concat(F.lit("first"), (person % 20).cast("string"), F.lit(" last"), (person % 11).cast("string")).alias("name"),
            F.when(key % 7 == 0, "").otherwise(email).alias("email"),
            F.when(key % 5 == 0, "")
            .otherwise(F.lpad(((person * 7919 + 1234567) % 10_000_000_000).cast("string"), 10, "0"))
            .alias("phone"),
            F.when(key % 11 == 0, "").otherwise(F.concat(F.lit("city"), (person % 6).cast("string"))).alias("city"),
            F.lower("c_mktsegment").alias("user_agent"),
        )
        .withColumn("email_hash", fn.email_hash("email"))
        .withColumn("cookie_id", F.when(F.col("record_id") % 13 == 0, "").otherwise(F.concat(F.lit("ck"), F.col("record_id").cast("string"))))
    )


SQL["identity"] = """SELECT *, CASE WHEN email = '' THEN '' ELSE left(sha256(email), 16) END AS email_hash,
  CASE WHEN record_id % 13 = 0 THEN '' ELSE 'ck' || record_id END AS cookie_id FROM (
  SELECT c_custkey AS record_id, person AS person_id,
  'first' || (person % 20) || ' last' || (person % 11) AS name,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'user' || person ||
    CASE WHEN c_custkey % 3 = 1 THEN '.2' ELSE '' END || '@mail' || (person % 4) || '.example' END AS email,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE
    lpad(CAST((person * 7919 + 1234567) % 10000000000 AS VARCHAR), 10, '0') END AS phone,
  CASE WHEN c_custkey % 11 = 0 THEN '' ELSE 'city' || (person % 6) END AS city,
  lower(c_mktsegment) AS user_agent
  FROM (SELECT c_custkey, c_mktsegment, c_custkey // 3 AS person FROM customer))"""


def mix_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = lambda p: F.coalesce(F.sum(F.when(F.col("o_orderpriority") == p, F.col("o_totalprice"))), F.lit(0.0)) * 0.1
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(
            F.sum("o_totalprice").alias("revenue"),
            spend("1-URGENT").alias("spend_search"),
            spend("2-HIGH").alias("spend_social"),
            spend("3-MEDIUM").alias("spend_display"),
            spend("5-LOW").alias("spend_email"),
        )
    )


SQL["mix"] = """SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS revenue,
  coalesce(sum(o_totalprice) FILTER (o_orderpriority = '1-URGENT'),0)*CAST(0.1 AS DOUBLE) AS spend_search,
  coalesce(sum(o_totalprice) FILTER (o_orderpriority = '2-HIGH'),0)*CAST(0.1 AS DOUBLE) AS spend_social,
  coalesce(sum(o_totalprice) FILTER (o_orderpriority = '3-MEDIUM'),0)*CAST(0.1 AS DOUBLE) AS spend_display,
  coalesce(sum(o_totalprice) FILTER (o_orderpriority = '5-LOW'),0)*CAST(0.1 AS DOUBLE) AS spend_email
  FROM orders GROUP BY 1"""


def mix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows as (date, channel text, spend, revenue), one per order."""
    name = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Paid Search ")
        .when(F.col("o_orderpriority") == "2-HIGH", "Facebook")
        .when(F.col("o_orderpriority") == "3-MEDIUM", " Banner")
        .when(F.col("o_orderpriority") == "5-LOW", "Newsletter")
        .otherwise("Other")
    )
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"),
        name.alias("channel"),
        (F.col("o_totalprice") * 0.1).alias("spend"),
        F.col("o_totalprice").alias("revenue"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, key, label, p) for two models per event."""
    base = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("key"),
        F.col("event_type").isin("purchase", "signup").cast("int").alias("label"),
        (((F.col("event_id") * 7919 + 104729) % 1000).cast("double") / F.lit(1000.0).cast("double")).alias("p_a"),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("value") / 400.0)).alias("p_b"),
    )
    return base.select("key", "label", F.expr("stack(2, 'a', p_a, 'b', p_b) as (model, p)"))


SQL["scored"] = """SELECT key, label, model, p FROM (
  SELECT event_id AS key, CASE WHEN event_type IN ('purchase','signup') THEN 1 ELSE 0 END AS label,
  CAST((event_id * 7919 + 104729) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS p_a,
  least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE), value / CAST(400 AS DOUBLE))) AS p_b FROM events)
  CROSS JOIN LATERAL (VALUES ('a', p_a), ('b', p_b)) v(model, p)"""


def uplift(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderdate") >= F.lit(UPLIFT_DAY).cast("timestamp_ntz"))
        .select(F.col("o_custkey").alias("c_custkey"), F.lit(1).alias("late"))
        .distinct()
    )
    return (
        table(spark, sf_dir, "customer")
        .join(late, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("key"),
            (F.col("c_custkey") % 2).cast("int").alias("treatment"),
            F.coalesce("late", F.lit(0)).alias("outcome"),
            (((F.col("c_custkey") * 7919 + 104729) % 1000).cast("double") / 1000.0).alias("score"),
            "c_acctbal",
            "c_nationkey",
            "c_mktsegment",
        )
    )


SQL["uplift"] = f"""SELECT c_custkey AS key, CAST(c_custkey % 2 AS INT) AS treatment,
  CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '{UPLIFT_DAY}') THEN 1 ELSE 0 END AS outcome,
  CAST((c_custkey * 7919 + 104729) % 1000 AS DOUBLE)/CAST(1000 AS DOUBLE) AS score FROM customer"""


def churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer churn table: order history before the cut day as features, silence after it as label."""
    cut = F.lit(UPLIFT_DAY).cast("timestamp_ntz")
    before = F.col("o_orderdate") < cut
    history = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count_if(before).alias("tenure"),
            F.avg(F.when(before, F.col("o_totalprice"))).alias("MonthlyCharges"),
            F.sum(F.when(before, F.col("o_totalprice"))).alias("TotalCharges"),
            F.mode(F.when(before, F.col("o_orderpriority")), True).alias("Contract"),
            F.count_if(~before).alias("later"),
        )
    )
    return (
        table(spark, sf_dir, "customer")
        .join(history, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("customerID"),
            F.coalesce("tenure", F.lit(0)).alias("tenure"),
            "MonthlyCharges",
            "TotalCharges",
            "Contract",
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
            F.when(F.coalesce("later", F.lit(0)) == 0, "Yes").otherwise("No").alias("Churn"),
        )
    )


SQL["churn"] = f"""SELECT c_custkey AS "customerID", coalesce(h.tenure, 0) AS tenure, h."MonthlyCharges", h."TotalCharges",
  h."Contract", c_mktsegment AS segment, c_acctbal AS balance,
  CASE WHEN coalesce(h.later, 0) = 0 THEN 'Yes' ELSE 'No' END AS "Churn"
  FROM customer LEFT JOIN (
    SELECT o_custkey, count(*) FILTER (o_orderdate < TIMESTAMP '{UPLIFT_DAY}') AS tenure,
    avg(o_totalprice) FILTER (o_orderdate < TIMESTAMP '{UPLIFT_DAY}') AS "MonthlyCharges",
    sum(o_totalprice) FILTER (o_orderdate < TIMESTAMP '{UPLIFT_DAY}') AS "TotalCharges",
    (SELECT p FROM (SELECT o2.o_orderpriority AS p, count(*) AS n FROM orders o2 WHERE o2.o_custkey = o.o_custkey
       AND o2.o_orderdate < TIMESTAMP '{UPLIFT_DAY}' GROUP BY 1) ORDER BY n DESC, p LIMIT 1) AS "Contract",
    count(*) FILTER (o_orderdate >= TIMESTAMP '{UPLIFT_DAY}') AS later
    FROM orders o GROUP BY o_custkey) h ON h.o_custkey = c_custkey"""


def with_ctes(names: list[str], body: str, **extra: str) -> str:
    """Check query: named fixture expressions, further expressions, then the body."""
    parts = [f"{n} AS ({SQL[n]})" for n in names] + [f"{n} AS ({t})" for n, t in extra.items()]
    return "WITH " + ", ".join(parts) + " " + body if parts else body
