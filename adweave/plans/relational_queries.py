"""Registered queries: projection, cleaning, predicates, sets, windows, aggregates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from adweave.functions import scalar as fn
from adweave.operators import credit_flow, joins
from adweave.operators import features as fea
from adweave.operators import relational as rel
from adweave.plans import fixtures as fx
from adweave.plans.fixtures import with_ctes

QUERIES, ORACLE = {}, {}


def _register(name, sql=None):
    def wrap(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return wrap


def _t(spark, d, name):
    return fx.table(spark, d, name)


@_register(
    "prj2_coerce_numeric",
    """SELECT p_partkey, TRY_CAST(split_part(p_name, ' ', 1) AS DOUBLE) AS name_number, coalesce(CAST(TRY_CAST(right(p_brand, 2) AS DOUBLE) AS INT), 0) AS brand_number,
      coalesce(CAST(TRY_CAST(p_type AS DOUBLE) AS INT), 0) AS type_number FROM part""",
)
def _(spark, d):
    parts = _t(spark, d, "part").select(
        "p_partkey", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("name_number"), F.right("p_brand", F.lit(2)).alias("brand_number"), F.col("p_type").alias("type_number")
    )
    return rel.coerce_numeric(rel.coerce_numeric(parts, ["name_number"]), ["brand_number", "type_number"], fill=0, kind="int")


@_register("prj3_drop_null_rows", with_ctes(["churn"], 'SELECT "customerID", tenure FROM churn WHERE "MonthlyCharges" IS NOT NULL AND "Contract" IS NOT NULL'))
def _(spark, d):
    return rel.drop_null_rows(fx.churn(spark, d), ["MonthlyCharges", "Contract"]).select("customerID", "tenure")


@_register("prj4_epoch_to_timestamp", "SELECT event_id, epoch_us(ts) AS micros FROM events")
def _(spark, d):
    seconds = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)") / 1e6
    rows = _t(spark, d, "events").select("event_id", seconds.alias("seconds")).withColumn("ts", fn.epoch_to_ts("seconds"))
    return rows.select("event_id", F.unix_micros("ts").alias("micros"))


@_register("prj5_project_rename_drop", "SELECT o_orderkey AS id, o_totalprice * 2 AS doubled, o_orderstatus AS status FROM orders")
def _(spark, d):
    table = _t(spark, d, "orders").withColumnRenamed("o_orderkey", "id").withColumn("doubled", F.col("o_totalprice") * 2)
    return table.drop("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority").withColumnRenamed("o_orderstatus", "status")


@_register(
    "prj6_normalize_channel",
    """SELECT channel, count(*) AS n FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'search' WHEN '2-HIGH' THEN 'social' WHEN '3-MEDIUM' THEN 'display'
      WHEN '5-LOW' THEN 'email' ELSE 'other' END AS channel FROM orders) GROUP BY 1""",
)
def _(spark, d):
    return fx.mix_long(spark, d).groupBy(fn.normalize_channel("channel").alias("channel")).agg(F.count(F.lit(1)).alias("n"))


@_register(
    "prj9_binary_labels",
    with_ctes(
        ["churn"],
        """SELECT "customerID", CASE "Churn" WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS churned, CAST(coalesce(balance, 0) > 0 AS INT) AS in_credit,
        CAST(segment <> 'BUILDING' AS INT) AS treated, CAST(lower(segment) NOT LIKE '%no%' AS INT) AS treated_text FROM churn""",
    ),
)
def _(spark, d):
    return fx.churn(spark, d).select(
        "customerID", fn.yes_no("Churn").alias("churned"), fn.positive_flag("balance").alias("in_credit"),
        fn.treated_segment("segment", "BUILDING").alias("treated"), fn.treated_by_text("segment").alias("treated_text"),
    )


@_register("prj12_last_char_key", "SELECT event_id, right(event_type, 1) AS cohort FROM events")
def _(spark, d):
    return _t(spark, d, "events").select("event_id", fn.last_char_key("event_type").alias("cohort"))


@_register("prj13_detect_columns", with_ctes(["uplift"], "SELECT 'treatment' AS treatment_column, CAST(sum(treatment) AS BIGINT) AS treated FROM uplift"))
def _(spark, d):
    table = fx.uplift(spark, d)
    treatment, _ = fea.detect_columns(table.columns)
    return table.agg(F.lit(treatment).alias("treatment_column"), F.sum(treatment).alias("treated"))


@_register(
    "prj14_predicates",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 10 AND l_discount BETWEEN 0.02::DOUBLE AND 0.05::DOUBLE
      AND l_returnflag IN ('A', 'R') AND l_tax IS NOT NULL AND l_linestatus = 'F'""",
)
def _(spark, d):
    return (
        _t(spark, d, "lineitem")
        .where((F.col("l_quantity") >= 10) & F.col("l_discount").between(0.02, 0.05) & F.col("l_returnflag").isin("A", "R"))
        .where(F.col("l_tax").isNotNull() & (F.col("l_linestatus") == "F"))
        .select("l_orderkey", "l_linenumber", "l_quantity")
    )


@_register(
    "prj15_right_closed_bins",
    """SELECT bin, count(*) AS n FROM (SELECT CASE WHEN l_quantity < 1 THEN NULL WHEN l_quantity <= 10 THEN 'low' WHEN l_quantity <= 30 THEN 'mid'
      WHEN l_quantity <= 45 THEN 'high' END AS bin FROM lineitem) GROUP BY 1""",
)
def _(spark, d):
    bins = fn.bin_right_closed("l_quantity", [1, 10, 30, 45], ["low", "mid", "high"])
    return _t(spark, d, "lineitem").groupBy(bins.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@_register("jn10_align_by_id", with_ctes(["identity"], "SELECT a.record_id, a.person_id, b.city FROM identity a JOIN identity b ON b.record_id = a.person_id"))
def _(spark, d):
    records = fx.identity_records(spark, d)
    other = records.select(F.col("record_id").alias("person_id"), "city")
    return records.select("record_id", "person_id").join(other, "person_id").select("record_id", "person_id", "city")


@_register(
    "win1_group_shares",
    with_ctes(
        ["conversions"],
        """SELECT conversion_id, row_number() OVER (PARTITION BY user_id ORDER BY ts_conversion, conversion_id) - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS group_n,
        round(conversion_value / sum(conversion_value) OVER (PARTITION BY user_id), 6) AS share FROM conversions""",
    ),
)
def _(spark, d):
    table = rel.group_shares(fx.conversions(spark, d), "user_id", "ts_conversion", "conversion_id", "conversion_value")
    return table.select("conversion_id", "pos", "group_n", F.round("share", 6).alias("share"))


@_register(
    "win2_percent_rank",
    """WITH h AS (SELECT l_quantity AS q, count(*) AS n FROM lineitem GROUP BY 1) SELECT q AS l_quantity, round((coalesce(sum(n) OVER (ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      + (n + 1) / 2.0::DOUBLE) / sum(n) OVER (), 6) AS pct FROM h""",
)
def _(spark, d):
    return rel.percent_rank_average(_t(spark, d, "lineitem"), "l_quantity").withColumn("pct", F.round("pct", 6))


@_register(
    "win2_dense_rank",
    "SELECT o_orderstatus, o_orderpriority, n, dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY n DESC) AS rank FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)",
)
def _(spark, d):
    counts = _t(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return rel.dense_ranks(counts, ["o_orderstatus"], F.desc("n"))


@_register("srt1_sort", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC NULLS LAST, c_custkey")
def _(spark, d):
    return _t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal").orderBy("c_mktsegment", F.desc_nulls_last("c_acctbal"), "c_custkey")


@_register("top1_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(spark, d):
    return rel.top_k(_t(spark, d, "orders").select("o_orderkey", "o_totalprice"), 20, F.desc("o_totalprice"), "o_orderkey")


@_register("set1_stack_tables", "SELECT c_custkey AS id, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier UNION ALL SELECT p_partkey, 'part' FROM part")
def _(spark, d):
    pick = lambda name, key: _t(spark, d, name).select(F.col(key).alias("id"), F.lit(name).alias("kind"))
    return rel.stack_tables([pick("customer", "c_custkey"), pick("supplier", "s_suppkey"), pick("part", "p_partkey")])


@_register("set2_union_and_difference", with_ctes(["exposures", "conversions", "joined"], "SELECT user_id FROM (SELECT user_id FROM exposures UNION SELECT user_id FROM conversions) WHERE user_id NOT IN (SELECT user_id FROM joined WHERE hours <= 2)"))
def _(spark, d):
    exp, conv = fx.exposures(spark, d), fx.conversions(spark, d)
    matched = credit_flow.window_counts(exp, conv, 2 / 24)[0].where("n > 0").select("user_id").distinct()
    return rel.difference(rel.distinct_union(exp, conv, "user_id"), matched, "user_id")


@_register("set3_first_per_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def _(spark, d):
    return rel.first_per_key(_t(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@_register("set3_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(spark, d):
    return _t(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@_register(
    "agg1_grouped_aggregates",
    """SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty, round(avg(l_extendedprice), 4) AS avg_price, max(l_discount) AS max_discount,
      min(l_tax) AS min_tax, count(DISTINCT l_suppkey) AS suppliers, round(stddev_samp(l_quantity), 6) AS sd_qty,
      arg_min(l_quantity, (l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS first_qty FROM lineitem GROUP BY 1""",
)
def _(spark, d):
    key = F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return _t(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
        F.max("l_discount").alias("max_discount"), F.min("l_tax").alias("min_tax"), F.count_distinct("l_suppkey").alias("suppliers"),
        F.round(F.stddev_samp("l_quantity"), 6).alias("sd_qty"), F.min_by("l_quantity", key).alias("first_qty"),
    )


_FLAGS = ["A", "N", "R"]


@_register(
    "agg2_pivot_shares",
    "SELECT l_linenumber, " + ", ".join(f"""round(coalesce(sum(l_quantity) FILTER (l_returnflag = '{f}'), 0) / sum(l_quantity), 6) AS "{f}" """ for f in _FLAGS) + " FROM lineitem GROUP BY 1",
)
def _(spark, d):
    table = rel.pivot_sum(_t(spark, d, "lineitem"), "l_linenumber", "l_returnflag", _FLAGS, "l_quantity", normalise=True)
    return table.select("l_linenumber", *[F.round(f, 6).alias(f) for f in _FLAGS])


@_register(
    "fn_text_functions",
    """SELECT c_custkey, lower(trim('  ' || c_mktsegment || ' ')) AS cleaned, contains(lower(c_mktsegment), 'build') AS has_build, split_part(c_name, '#', 2) AS digits,
      left(c_name, 4) AS prefix, right(c_name, 3) AS suffix, concat_ws('|', c_name, nullif(c_mktsegment, 'BUILDING')) AS joined, left(sha256(c_name), 16) AS digest,
      len(list_distinct(string_split(c_mktsegment, 'U'))) AS pieces FROM customer""",
)
def _(spark, d):
    seg = F.col("c_mktsegment")
    return _t(spark, d, "customer").select(
        "c_custkey", F.lower(F.trim(F.concat(F.lit("  "), seg, F.lit(" ")))).alias("cleaned"), F.lower(seg).contains("build").alias("has_build"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("digits"), F.left("c_name", F.lit(4)).alias("prefix"), F.right("c_name", F.lit(3)).alias("suffix"),
        F.concat_ws("|", "c_name", F.nullif(seg, F.lit("BUILDING"))).alias("joined"), F.left(F.sha2("c_name", 256), F.lit(16)).alias("digest"),
        F.size(F.array_distinct(F.split(seg, "U"))).cast("long").alias("pieces"),
    )


@_register(
    "fn_time_functions",
    """SELECT event_id, CAST(isodow(ts) - 1 AS INT) AS dow, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
      round(date_diff('microsecond', TIMESTAMP '2024-01-01', ts) / 3.6e9, 6) AS hours, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events""",
)
def _(spark, d):
    rows = _t(spark, d, "events").withColumn("start", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    return rows.select(
        "event_id", F.weekday("ts").alias("dow"), F.date_format("ts", "yyyyMMdd").alias("day"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
        F.round(fn.hours_between("start", "ts"), 6).alias("hours"), F.to_date("ts").cast("string").alias("date"),
    )


@_register(
    "fn_numeric_functions",
    """SELECT event_id, round(exp(-value / 100), 6) AS e, round(ln(value), 6) AS l, round(ln(1 + value), 6) AS l1, round(value * value, 4) AS sq,
      least(greatest(value, 5.0::DOUBLE), 50.0::DOUBLE) AS clipped, round(abs(value - 40), 6) AS off, CAST(ceil(value / 10) AS BIGINT) AS up, event_id // 7 AS whole,
      CAST(trunc(value) AS INT) AS cut, coalesce(nullif(user_id, 8), -1) AS masked, user_id IN (8, 46) AS listed FROM events""",
)
def _(spark, d):
    v = F.col("value")
    return _t(spark, d, "events").select(
        "event_id", F.round(F.exp(-v / 100), 6).alias("e"), F.round(F.ln(v), 6).alias("l"), F.round(F.log1p(v), 6).alias("l1"), F.round(v * v, 4).alias("sq"),
        F.least(F.greatest(v, F.lit(5.0)), F.lit(50.0)).alias("clipped"), F.round(F.abs(v - 40), 6).alias("off"), F.ceil(v / 10).alias("up"),
        F.expr("event_id div 7").alias("whole"), v.cast("int").alias("cut"), F.coalesce(F.nullif(F.col("user_id"), F.lit(8)), F.lit(-1)).alias("masked"), F.col("user_id").isin(8, 46).alias("listed"),
    )


@_register(
    "fn_array_functions",
    """SELECT user_id, len(list_distinct(list(event_type))) AS kinds, list_contains(list(event_type), 'purchase') AS bought FROM events GROUP BY 1""",
)
def _(spark, d):
    kinds = _t(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("k"))
    return kinds.select("user_id", F.size("k").cast("long").alias("kinds"), F.array_contains("k", "purchase").alias("bought"))


@_register(
    "fn_dense_cosine",
    """SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def _(spark, d):
    table = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    following = table.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    return table.join(following, "vec_id").select("vec_id", F.round(fn.cosine("a", "b"), 5).alias("cosine"))
