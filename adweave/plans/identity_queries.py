"""Registered queries: identity resolution and journeys."""

from __future__ import annotations

from pyspark.sql import functions as F

from adweave.functions import scalar as fn
from adweave.operators import identity as idn
from adweave.operators import segments
from adweave.plans import fixtures as fx
from adweave.plans.fixtures import with_ctes
from adweave.session import cut_lineage

QUERIES, ORACLE = {}, {}


def _register(name, sql=None):
    def wrap(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return wrap


_DOMAIN = "CASE WHEN email LIKE '%@%' THEN split_part(email, '@', 2) ELSE '' END"
_KEYS = f"""SELECT record_id, person_id, nullif({_DOMAIN}, '') AS domain, nullif(CASE WHEN length(phone) >= 4 THEN right(phone, 4) ELSE '' END, '') AS phone4,
  nullif(city || '|' || user_agent, '|') AS city_ua, nullif(email_hash, '') AS email_hash, nullif(lower(name), '') AS name, string_split(lower(name), ' ') AS tokens FROM identity"""
_ALL_PAIRS = """SELECT a.person_id = b.person_id AS same FROM keys a JOIN keys b ON a.record_id < b.record_id
  AND (a.domain = b.domain OR a.phone4 = b.phone4 OR a.city_ua = b.city_ua)"""
_PAIRS = " UNION ".join(
    f"SELECT a.record_id AS i, b.record_id AS j, CAST(a.person_id = b.person_id AS INT) AS same_person FROM keys a JOIN keys b ON a.record_id < b.record_id AND {same}"
    for same in (
        "a.email_hash = b.email_hash", "a.name = b.name AND a.domain = b.domain", "a.name = b.name AND a.city_ua = b.city_ua",
        "a.phone4 = b.phone4 AND len(list_intersect(a.tokens, b.tokens)) > 0",
    )
)
PAIR_CTES = {"keys": _KEYS, "pairs": _PAIRS}


@_register(
    "jn8_blocking_counts",
    with_ctes(["identity"], "SELECT count(*) AS candidate_pairs, CAST(count(*) FILTER (same) AS BIGINT) AS same_person_pairs FROM everyone", keys=_KEYS, everyone=_ALL_PAIRS),
)
def _(spark, d):
    return idn.blocking_counts(fx.identity_records(spark, d))


@_register("jn9_candidate_pairs", with_ctes(["identity"], "SELECT i, j FROM pairs", **PAIR_CTES))
def _(spark, d):
    return idn.candidate_pairs(fx.identity_records(spark, d))


def _labelled(spark, d):
    records = fx.identity_records(spark, d)
    return records, idn.label_pairs(idn.candidate_pairs(records, idn.feature_inputs(records)), records)


@_register("idn1_labelled_pairs", with_ctes(["identity"], "SELECT * FROM pairs", **PAIR_CTES))
def _(spark, d):
    records = fx.identity_records(spark, d)
    return idn.label_pairs(idn.candidate_pairs(records, records.select("record_id", "person_id")), records).drop("rows_i", "rows_j")


TFIDF_CTES = {
    "words": """SELECT record_id, ' ' || unnest(string_split_regex(trim(concat_ws(' ', nullif(lower(name), ''), nullif(lower(email), ''), nullif(phone, ''),
      nullif(lower(city), ''), nullif(lower(user_agent), ''))), '\\s+')) || ' ' AS w FROM identity""",
    "grams": "SELECT record_id, substr(w, s, n) AS term FROM (SELECT record_id, w, n, unnest(range(1, length(w) - n + 2)) AS s FROM words, (VALUES (3), (4), (5)) g(n) WHERE length(w) >= n)",
    "tf": "SELECT record_id, term, count(*) AS tf FROM grams GROUP BY 1, 2",
    "dfs": "SELECT term, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 2",
    "raw": "SELECT record_id, term, tf * (ln((1.0::DOUBLE + (SELECT count(*) FROM identity)) / (1 + df)) + 1) AS w FROM tf JOIN dfs USING (term)",
    "vectors": "SELECT record_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY record_id)) AS weight FROM raw",
}


@_register("idn2_char_tfidf", with_ctes(["identity"], "SELECT record_id, term, round(weight, 6) AS weight FROM vectors", **TFIDF_CTES))
def _(spark, d):
    return idn.tfidf(fx.identity_records(spark, d)).withColumn("weight", F.round("weight", 6))


@_register("idn3_svd_embedding")
def _(spark, d):
    return idn.svd_embedding(idn.tfidf(fx.identity_records(spark, d)))


_COS = """SELECT i, j, round(coalesce(c, 0), 6) AS cosine FROM pairs LEFT JOIN (SELECT i, j, sum(a.weight * b.weight) AS c FROM pairs
  JOIN vectors a ON a.record_id = i JOIN vectors b ON b.record_id = j AND b.term = a.term GROUP BY 1, 2) USING (i, j)"""


@_register("idn4_pair_cosine", with_ctes(["identity"], _COS, **PAIR_CTES, **TFIDF_CTES).replace(" AS (", " AS MATERIALIZED ("))
def _(spark, d):
    records = fx.identity_records(spark, d)
    return idn.sparse_cosine(idn.candidate_pairs(records), idn.tfidf(records)).withColumn("cosine", F.round("cosine", 6))


_FEATURES = """SELECT i, j, same_person, CAST(a.email_hash <> '' AND a.email_hash = b.email_hash AS INT) AS email_hash_match,
  CAST(a.email <> '' AND split_part(a.email, '@', 2) = split_part(b.email, '@', 2) AS INT) AS email_domain_match,
  CAST(length(a.phone) >= 4 AND right(a.phone, 4) = right(b.phone, 4) AS INT) AS phone_last4_match,
  CAST(a.city <> '' AND a.city = b.city AS INT) AS city_match, CAST(a.user_agent = b.user_agent AS INT) AS ua_match,
  len(list_intersect(string_split(lower(a.name), ' '), string_split(lower(b.name), ' ')))::DOUBLE
  / len(list_distinct(string_split(lower(a.name), ' ') || string_split(lower(b.name), ' '))) AS jac
  FROM pairs JOIN identity a ON a.record_id = i JOIN identity b ON b.record_id = j"""
FEATURE_CTES = dict(PAIR_CTES, features=_FEATURES)
_FLAGS = ["email_hash_match", "email_domain_match", "phone_last4_match", "city_match", "ua_match"]


@_register("idn5_match_features", with_ctes(["identity"], f"SELECT i, j, same_person, {', '.join(_FLAGS)} FROM features", **FEATURE_CTES))
def _(spark, d):
    records, pairs = _labelled(spark, d)
    return idn.pair_features(pairs, records).drop("name_jaccard")


@_register("idn6_name_jaccard", with_ctes(["identity"], "SELECT i, j, round(jac, 6) AS name_jaccard FROM features", **FEATURE_CTES))
def _(spark, d):
    records, pairs = _labelled(spark, d)
    return idn.pair_features(pairs, records).select("i", "j", F.round("name_jaccard", 6).alias("name_jaccard"))


def _features(spark, d):
    records = fx.identity_records(spark, d)
    embedding = idn.svd_embedding(idn.tfidf(records))
    pairs = idn.label_pairs(idn.candidate_pairs(records, idn.feature_inputs(records, embedding)), records)
    return records, idn.pair_features(pairs, records, embedding)


@_register("idn7_linkage_model")
def _(spark, d):
    _, features = _features(spark, d)
    _, holdout, _ = idn.train_linker(cut_lineage(features))
    return idn.linker_report(holdout)


# Deterministic link rule for the checkable cluster queries: shared e-mail hash, or shared phone end and a close name.
_CLOSE = "phone_last4_match = 1 AND name_jaccard >= 0.5"
_RULE = f"email_hash_match = 1 OR ({_CLOSE})"
RESOLVE_CTES = dict(
    FEATURE_CTES,
    links="SELECT i, j FROM features WHERE email_hash_match = 1 OR (phone_last4_match = 1 AND jac >= 0.5)",
    edges="SELECT i AS a, j AS b FROM links UNION SELECT j, i FROM links",
    reach="SELECT record_id AS n, record_id AS r FROM identity UNION SELECT e.b, reach.r FROM reach JOIN edges e ON e.a = reach.n",
    resolved="SELECT n AS record_id, min(r) AS resolved_id FROM reach GROUP BY n",
    people="SELECT * FROM identity JOIN resolved USING (record_id)",
)


def _recursive(body: str) -> str:
    return with_ctes(["identity"], body, **RESOLVE_CTES).replace("WITH ", "WITH RECURSIVE ", 1)


def _resolved(spark, d):
    records, pairs = _labelled(spark, d)
    close = idn.pair_features(pairs, records).where(_CLOSE).select("i", "j")
    return idn.resolve(records, idn.key_edges(records, "email_hash").unionByName(close))


@_register("idn8_resolved_ids", _recursive("SELECT record_id, resolved_id FROM people"))
def _(spark, d):
    return _resolved(spark, d).select("record_id", "resolved_id")


@_register(
    "idn9_cluster_purity",
    _recursive(
        """SELECT count(*) AS n_resolved_clusters, round(avg(share), 6) AS avg_cluster_purity FROM (SELECT resolved_id, max(n) / sum(n)::DOUBLE AS share
        FROM (SELECT resolved_id, person_id, count(*) AS n FROM people GROUP BY 1, 2) GROUP BY 1)"""
    ),
)
def _(spark, d):
    return idn.cluster_purity(_resolved(spark, d)).withColumn("avg_cluster_purity", F.round("avg_cluster_purity", 6))


@_register("idn10_largest_clusters", _recursive("SELECT resolved_id, count(*) AS n_records FROM people GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"))
def _(spark, d):
    return idn.largest_clusters(_resolved(spark, d))


@_register(
    "idn10_mixed_clusters",
    _recursive("SELECT resolved_id, count(DISTINCT person_id) AS unique_true_person_ids FROM people GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"),
)
def _(spark, d):
    return idn.mixed_clusters(_resolved(spark, d))


@_register("idn11_signal_loss")
def _(spark, d):
    return idn.signal_loss(_features(spark, d)[1])


@_register("idn8_linked_by_model")
def _(spark, d):
    """Scores all candidates with the linkage model, links from 0.70 on and resolves."""
    records, features = _features(spark, d)
    features = cut_lineage(features)
    model, _, columns = idn.train_linker(features)
    links = idn.link_pairs(model, features, columns).where("pred_match = 1").select("i", "j")
    return idn.cluster_purity(idn.resolve(records, links))


_SHARE = " + ".join(f"CAST({c} <> '' AS INT)" for c in idn.COMPLETENESS_FIELDS)


@_register(
    "idn12_completeness_report",
    with_ctes(
        ["identity"],
        """SELECT b AS completeness_bucket, count(bucket) AS n_pairs, round(avg(m), 6) AS predicted_match_rate, round(avg(same_person), 6) AS true_match_rate
        FROM (VALUES ('0-40%'), ('40-60%'), ('60-80%'), ('80-100%')) v(b) LEFT JOIN (SELECT *, CASE WHEN c <= 0.4::DOUBLE THEN '0-40%' WHEN c <= 0.6::DOUBLE THEN '40-60%'
        WHEN c <= 0.8::DOUBLE THEN '60-80%' ELSE '80-100%' END AS bucket FROM (SELECT same_person, CAST(email_hash_match = 1 OR (phone_last4_match = 1 AND jac >= 0.5) AS INT) AS m,
        (x.s + y.s) / 2.0::DOUBLE AS c FROM features JOIN filled x ON x.record_id = i JOIN filled y ON y.record_id = j)) ON bucket = b GROUP BY b""",
        **FEATURE_CTES,
        filled=f"SELECT record_id, ({_SHARE}) / 5.0::DOUBLE AS s FROM identity",
    ),
)
def _(spark, d):
    records, pairs = _labelled(spark, d)
    scored = idn.pair_features(pairs, records).withColumn("pred_match", F.expr(_RULE).cast("int"))
    report = idn.completeness_report(scored, records)
    return report.withColumns({c: F.round(c, 6) for c in ("predicted_match_rate", "true_match_rate")})


@_register("idn13_fragmentation", with_ctes(["identity"], "SELECT count(DISTINCT person_id) AS n_people, count(*) AS n_records, round(count(*) / count(DISTINCT person_id)::DOUBLE, 2) AS avg_records_per_person FROM identity"))
def _(spark, d):
    return idn.fragmentation(fx.identity_records(spark, d))


_STEPS = """SELECT user_id % 10 AS record_id, user_id // 10 AS resolved_id, event_id AS event_order, CASE CAST(json_extract_string(props,'$.k') AS INT) % 5
  WHEN 0 THEN 'search' WHEN 1 THEN 'social' WHEN 2 THEN 'display' WHEN 3 THEN 'email' ELSE 'direct' END AS channel,
  CAST(event_type = 'purchase' AS INT) AS conversion_event FROM events"""
_JOURNEYS = "SELECT resolved_id, string_agg(channel, ' > ' ORDER BY event_order, record_id) AS path, max(conversion_event) AS converted FROM steps GROUP BY 1"


def _steps(spark, d):
    return fx.table(spark, d, "events").select(
        (F.col("user_id") % 10).alias("record_id"),
        F.floor(F.col("user_id") / 10).alias("resolved_id"),
        F.col("event_id").alias("event_order"),
        fx.channel_of_props().alias("channel"),
        (F.col("event_type") == "purchase").cast("int").alias("conversion_event"),
    )


@_register("jrn1_journeys", f"WITH steps AS ({_STEPS}) {_JOURNEYS}")
def _(spark, d):
    return segments.journeys(_steps(spark, d))


@_register(
    "jrn1_journey_steps",
    f"WITH steps AS ({_STEPS}) SELECT resolved_id, row_number() OVER (PARTITION BY resolved_id ORDER BY event_order, record_id) AS step, channel FROM steps",
)
def _(spark, d):
    return segments.journey_steps(_steps(spark, d))


# Short paths: one journey per user and day, so that equal paths occur.
_DAILY = _STEPS.replace("user_id // 10 AS resolved_id", "user_id * 100 + day(ts) AS resolved_id")


@_register(
    "jrn2_top_paths",
    f"WITH steps AS ({_DAILY}) SELECT path, count(*) AS n_converted_users FROM ({_JOURNEYS}) WHERE converted = 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
)
def _(spark, d):
    steps = fx.table(spark, d, "events").select(
        (F.col("user_id") % 10).alias("record_id"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("resolved_id"),
        F.col("event_id").alias("event_order"),
        fx.channel_of_props().alias("channel"),
        (F.col("event_type") == "purchase").cast("int").alias("conversion_event"),
    )
    return segments.top_paths(steps)


_TEXT = "trim(concat_ws(' ', nullif(lower(name), ''), nullif(lower(email), ''), nullif(phone, ''), nullif(lower(city), ''), nullif(lower(user_agent), '')))"


@_register(
    "prj7_identity_keys",
    with_ctes(["identity"], f"SELECT record_id, {_DOMAIN} AS domain, CASE WHEN length(phone) >= 4 THEN right(phone, 4) ELSE '' END AS phone4, email_hash FROM identity"),
)
def _(spark, d):
    records = fx.identity_records(spark, d)
    return records.select("record_id", fn.email_domain("email").alias("domain"), fn.phone_last4("phone").alias("phone4"), fn.email_hash("email").alias("email_hash"))


@_register("prj8_profile_text", with_ctes(["identity"], f"SELECT record_id, {_TEXT} AS profile FROM identity"))
def _(spark, d):
    return fx.identity_records(spark, d).select("record_id", fn.profile_text(idn.PROFILE).alias("profile"))
