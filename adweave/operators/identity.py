"""Identity resolution: blocking, pair features, linkage model, clusters and quality reports."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adweave.functions import scalar as fn
from adweave.operators import models
from adweave.operators.components import connected_components
from adweave.operators.metrics import classification_report, confusion, ranking_metrics
from adweave.session import cut_lineage

# Blocking keys.
BLOCKING = ("domain", "phone4", "city_ua")
PROFILE = ("name", "email", "phone", "city", "user_agent")
LINK_THRESHOLD = 0.70
PAIR_FEATURES = [
    "cosine_profile_emb", "email_hash_match", "email_domain_match", "phone_last4_match", "city_match", "ua_match", "name_jaccard",
]
# Feature groups dropped in the signal-loss report.
SIGNAL_GROUPS = {
    "all_signals": [],
    "drop_email_signals": ["email_hash_match", "email_domain_match"],
    "drop_device_signals": ["ua_match", "phone_last4_match"],
    "drop_geo_signals": ["city_match"],
    "drop_identity_keys": ["email_hash_match", "email_domain_match", "phone_last4_match", "city_match", "ua_match"],
}
COMPLETENESS_FIELDS = ["email_hash", "phone", "city", "user_agent", "cookie_id"]
BUCKETS = ["0-40%", "40-60%", "60-80%", "80-100%"]
BUCKET_EDGES = [0.0, 0.4, 0.6, 0.8, 1.0]


def _clean(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def blocking_keys(records: DataFrame) -> DataFrame:
    """record_id with the blocking keys, e-mail hash, name and its distinct tokens; an empty key is null.

    A missing city with a known agent still gives a city|agent key; only the fully empty key is dropped.
    """
    place = F.concat(_clean("city"), F.lit("|"), _clean("user_agent"))
    name = F.lower(F.trim(_clean("name")))
    return records.select(
        "record_id",
        F.nullif(fn.email_domain("email"), F.lit("")).alias("domain"),
        F.nullif(fn.phone_last4("phone"), F.lit("")).alias("phone4"),
        F.nullif(place, F.lit("|")).alias("city_ua"),
        F.nullif(_clean("email_hash"), F.lit("")).alias("email_hash"),
        F.nullif(name, F.lit("")).alias("name"),
        F.array_distinct(F.array_remove(F.split(name, r"\s+"), "")).alias("tokens"),
    )


def blocking_counts(records: DataFrame) -> DataFrame:
    """Exact number of record pairs that share at least one blocking key, and how many are the same person.

    Worked out from block sizes by inclusion and exclusion, so no pair is ever built: a block of any size
    costs one row.
    """
    keys = blocking_keys(records).join(records.select("record_id", "person_id"), "record_id")
    sets = [(c, (-1) ** (k + 1)) for k in (1, 2, 3) for c in combinations(BLOCKING, k)]
    rows = F.array(
        *[
            F.when(
                F.coalesce(*[F.when(F.col(c).isNull(), 1) for c in combo], F.lit(0)) == 0,
                F.struct(F.lit(sign).alias("sign"), F.concat_ws("\u0001", F.lit("+".join(combo)), *combo).alias("key")),
            )
            for combo, sign in sets
        ]
    )
    tagged = keys.select("person_id", F.explode(F.array_compact(rows)).alias("b")).select("person_id", "b.*")
    per_person = tagged.groupBy("sign", "key", "person_id").agg(F.count(F.lit(1)).alias("n"))
    per_block = per_person.groupBy("sign", "key").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("same")
    )
    return per_block.agg(
        F.sum(F.col("sign") * F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("candidate_pairs"),
        F.sum(F.col("sign") * F.col("same")).cast("long").alias("same_person_pairs"),
    )


def candidate_pairs(records: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """Distinct (i, j), i < j, of all record pairs that meet one fixed rule, whatever the sizes of the blocks.

    A pair is a candidate if the e-mail hashes are equal, or the names are equal together with the e-mail domain or with
    city and agent, or the phone ends are equal together with a token of the names. A common domain or place alone is
    no evidence, so no block is the share of a mail provider. Blocks are join keys, and an adaptive plan splits the
    partitions of large ones.

    A record carries its other block keys, and a pair comes out of the first block it shares, so pairs are made once and never
    shuffled. With ``keep`` (see ``feature_inputs``) they come with ``rows_i`` and ``rows_j``, the rows of both records there as arrays of
    structs, and ``label_pairs`` and ``pair_features`` need no join.
    """
    keys = blocking_keys(records)
    key = lambda kind, *parts: F.when(F.coalesce(*[F.when(p.isNull(), 1) for p in parts], F.lit(0)) == 0, F.concat_ws("\u0001", F.lit(kind), *parts))
    # in the order of their kinds; most pairs share the first
    exact = F.array(key("1domain", F.col("domain"), F.col("name")), key("2place", F.col("city_ua"), F.col("name")), key("3mail", F.col("email_hash")))
    phone = F.transform("tokens", lambda t: F.when(F.col("phone4").isNotNull(), F.concat_ws("\u0001", F.lit("4phone"), F.col("phone4"), t)))
    blocks = keys.select("record_id", F.array_compact(F.concat(exact, phone)).alias("blocks"))
    blocks = blocks.groupBy("record_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("blocks")))).alias("blocks"))
    extra = []
    if keep is not None:
        blocks, extra = blocks.join(_kept(keep, keep.columns[1:]).hint("merge"), "record_id"), ["rows"]
    sides = blocks.select("record_id", *extra, "blocks", F.posexplode("blocks").alias("at", "block"))
    sides = sides.select("record_id", *extra, "block", F.slice("blocks", 1, F.col("at")).alias("earlier"))
    side = lambda s: sides.select("block", F.col("record_id").alias(s), F.col("earlier").alias(f"earlier_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in extra])
    # sizes guessed from compressed files are far too small here, so none of these is broadcast
    pairs = side("i").join(side("j").hint("merge"), "block").where("i < j").where(~F.arrays_overlap("earlier_i", "earlier_j"))
    return pairs.select("i", "j", *[f"{c}_{s}" for c in extra for s in "ij"])


def _kept(records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(record_id, rows): the rows of each record."""
    return records.groupBy("record_id").agg(F.collect_list(F.struct(*columns)).alias("rows"))


def _with_rows(pairs: DataFrame, records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``pairs`` with one row for each row of i and each of j, as ``_i`` and ``_j``: from the pairs, or by joins with the records."""
    if "rows_i" not in pairs.columns:
        side = lambda s: _kept(records, columns).select(F.col("record_id").alias(s), F.col("rows").alias(f"rows_{s}"))
        pairs = pairs.join(side("i").hint("merge"), "i").join(side("j").hint("merge"), "j")
    return pairs.withColumn("_i", F.explode("rows_i")).withColumn("_j", F.explode("rows_j"))


def feature_inputs(records: DataFrame, embedding: DataFrame | None = None) -> DataFrame:
    """record_id, the known person and what ``pair_features`` compares, worked out once for each record."""
    base = records.select(
        "record_id", *[c for c in records.columns if c == "person_id"], "email_hash", "city", "user_agent", fn.email_domain("email").alias("domain"), fn.phone_last4("phone").alias("phone4"), fn.tokens("name").alias("tokens"),
    )
    return base if embedding is None else base.join(embedding.hint("merge"), "record_id", "left")


def key_edges(records: DataFrame, column: str) -> DataFrame:
    """(i, j) from the first record of each non-empty value of ``column`` to its others: the same components as all pairs, without them."""
    held = records.select("record_id", F.nullif(_clean(column), F.lit("")).alias("value")).where("value is not null")
    firsts = held.groupBy("value").agg(F.min("record_id").alias("i"))
    return held.join(firsts, "value").where("record_id > i").select("i", F.col("record_id").alias("j"))


def label_pairs(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Adds ``same_person`` from the known person ids."""
    joined = _with_rows(pairs, records, ["person_id"])
    same = (F.col("_i.person_id") == F.col("_j.person_id")).cast("int").alias("same_person")
    return joined.select("i", "j", same, *[c for c in pairs.columns if c.startswith("rows_")])


def char_ngrams(text: str, low: int = 3, high: int = 5) -> Column:
    """All character n-grams inside each space-padded word, with repeats."""
    words = F.array_remove(F.split(F.lower(F.col(text)), r"\s+"), "")
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def grams(w, n):
        starts = F.sequence(F.lit(1), F.length(w) - (n - 1))
        return F.when(F.length(w) >= n, F.transform(starts, lambda s: F.substring(w, s, F.lit(n)))).otherwise(
            F.array().cast("array<string>")
        )

    return F.flatten(F.transform(padded, lambda w: F.concat(*[grams(w, n) for n in range(low, high + 1)])))


def tfidf(records: DataFrame, columns: Sequence[str] = PROFILE, min_df: int = 2, low: int = 3, high: int = 5) -> DataFrame:
    """(record_id, term, weight): smoothed idf ln((1+N)/(1+df))+1, unit length per record.

    The words of a record are dealt by record before they are cut, so only words are shuffled and their n-grams are counted where
    they are cut; no table of n-grams is ever broadcast, whatever size is guessed for it.
    """
    split = F.array_remove(F.split(F.lower(fn.profile_text(columns)), r"\s+"), "")
    words = records.select("record_id", F.explode(split).alias("_word")).repartition("record_id")
    held = words.groupBy("record_id", "_word").agg(F.count(F.lit(1)).alias("_n"))
    opened = held.select("record_id", "_n", F.explode(char_ngrams("_word", low, high)).alias("term"))
    counts = cut_lineage(opened.groupBy("record_id", "term").agg(F.sum("_n").alias("tf")))
    n = records.count()
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df)
    raw = counts.join(df.hint("merge"), "term").select("record_id", "term", (F.col("tf") * (F.ln((1.0 + n) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("record_id")))
    return raw.select("record_id", "term", (F.col("w") / norm).alias("weight"))


def sparse_cosine(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(i, j, cosine) of unit sparse vectors by joining on (record, term); no shared term → 0."""
    left = pairs.select("i", "j").join(vectors.withColumnRenamed("record_id", "i").hint("merge"), "i")
    right = vectors.select(F.col("record_id").alias("j"), "term", F.col("weight").alias("w2"))
    dots = left.join(right.hint("merge"), ["j", "term"]).groupBy("i", "j").agg(F.sum(F.col("weight") * F.col("w2")).alias("cosine"))
    return pairs.select("i", "j").join(dots, ["i", "j"], "left").select("i", "j", F.coalesce("cosine", F.lit(0.0)).alias("cosine"))


def svd_embedding(vectors: DataFrame, components: int = 48, index: str = "record_id") -> DataFrame:
    """(record_id, embedding): truncated SVD coordinates of each sparse row. Component signs are arbitrary."""
    from adweave.operators.decomposition import truncated_svd

    return truncated_svd(vectors, index, components)


def pair_features(pairs: DataFrame, records: DataFrame, embedding: DataFrame | None = None) -> DataFrame:
    """Match features per labelled pair; the embedding cosine is added when vectors are given."""
    base = feature_inputs(records, embedding)
    joined = _with_rows(pairs, base, base.columns[1:])
    one, two = lambda c: F.col(f"_i.{c}"), lambda c: F.col(f"_j.{c}")
    both = lambda c: F.coalesce((one(c) != "") & (one(c) == two(c)), F.lit(False)).cast("int")
    features = [
        both("email_hash").alias("email_hash_match"),
        both("domain").alias("email_domain_match"),
        both("phone4").alias("phone_last4_match"),
        both("city").alias("city_match"),
        (F.coalesce(one("user_agent"), F.lit("")) == F.coalesce(two("user_agent"), F.lit(""))).cast("int").alias("ua_match"),
        fn.jaccard(one("tokens"), two("tokens")).alias("name_jaccard"),
    ]
    if embedding is not None:
        features.insert(0, F.coalesce(fn.cosine("_i.embedding", "_j.embedding"), F.lit(0.0)).alias("cosine_profile_emb"))
    return joined.select(*[c for c in pairs.columns if not c.startswith("rows_")], *features)


def pair_key(features: DataFrame) -> DataFrame:
    """Adds a non-negative long ``pair_id`` for hash splits."""
    return features.withColumn("pair_id", F.shiftrightunsigned(F.xxhash64("i", "j"), 33))


def train_linker(features: DataFrame, columns: Sequence[str] = PAIR_FEATURES, share: float = 0.25) -> tuple[Model, DataFrame, list[str]]:
    """Balanced logistic pair scorer. Returns the model, the scored holdout and the columns used."""
    split = models.stratified_holdout(pair_key(features), "pair_id", "same_person", share)
    columns = [c for c in columns if c in features.columns]
    ready = models.assemble(split, columns).withColumn("label", F.col("same_person").cast("double"))
    train = models.balanced_weights(ready.where(~F.col("is_test")), "label").select("label", "weight", "features").persist()
    model = models.logistic(train.count(), max_iter=100, weight="weight").fit(train)
    train.unpersist()
    return model, models.positive_probability(model, ready.where("is_test")), columns


def linker_report(holdout: DataFrame) -> DataFrame:
    """ROC-AUC, PR-AUC and precision, recall, F1 at p ≥ 0.5 in one row."""
    scored = holdout.withColumn("model", F.lit("linker"))
    report = classification_report(confusion(scored, 0.5, strict=False)).where("class = '1'")
    return ranking_metrics(scored).join(report.select("model", "precision", "recall", "f1"), "model")


def link_pairs(model: Model, features: DataFrame, columns: Sequence[str], threshold: float = LINK_THRESHOLD) -> DataFrame:
    """Pairs with their probability and ``pred_match`` at the link threshold."""
    scored = models.positive_probability(model, models.assemble(features, columns)).drop("features")
    return scored.withColumn("pred_match", (F.col("p") >= threshold).cast("int"))


def resolve(records: DataFrame, links: DataFrame) -> DataFrame:
    """records plus ``resolved_id``, the smallest record id of the linked component."""
    return records.join(connected_components(records, links), "record_id")


def cluster_purity(resolved: DataFrame) -> DataFrame:
    """Mean over clusters of the largest person share, with the cluster count."""
    people = resolved.groupBy("resolved_id", "person_id").agg(F.count(F.lit(1)).alias("n"))
    shares = people.groupBy("resolved_id").agg((F.max("n") / F.sum("n")).alias("share"))
    return shares.agg(F.count(F.lit(1)).alias("n_resolved_clusters"), F.avg("share").alias("avg_cluster_purity"))


def largest_clusters(resolved: DataFrame, k: int = 10) -> DataFrame:
    return resolved.groupBy("resolved_id").agg(F.count(F.lit(1)).alias("n_records")).orderBy(F.desc("n_records"), "resolved_id").limit(k)


def mixed_clusters(resolved: DataFrame, k: int = 20) -> DataFrame:
    """Clusters with the most distinct true persons."""
    table = resolved.groupBy("resolved_id").agg(F.count_distinct("person_id").alias("unique_true_person_ids"))
    return table.orderBy(F.desc("unique_true_person_ids"), "resolved_id").limit(k)


def signal_loss(features: DataFrame, columns: Sequence[str] = PAIR_FEATURES) -> DataFrame:
    """Holdout ROC and PR AUC with each signal group removed, and the drop against all signals."""
    cached = features.persist()
    parts = None
    for scenario, dropped in SIGNAL_GROUPS.items():
        keep = [c for c in columns if c not in dropped]
        _, holdout, _ = train_linker(cached, keep)
        row = ranking_metrics(holdout.withColumn("model", F.lit(scenario))).first()
        parts = (parts or []) + [(scenario, row["roc_auc"], row["pr_auc"])]
    cached.unpersist()
    full = parts[0]
    less = lambda a, b: None if a is None or b is None else a - b  # noqa: E731  a holdout of one class has no area
    rows = [(s, r, p, less(full[1], r), less(full[2], p)) for s, r, p in parts]
    schema = "scenario string, roc_auc double, pr_auc double, roc_drop_vs_full double, pr_drop_vs_full double"
    return features.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("pr_drop_vs_full"))


def completeness_report(scored_pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs, predicted and true match rate per completeness bucket; empty buckets stay with null rates."""
    present = sum((F.when(_clean(c) != "", 1).otherwise(0) for c in COMPLETENESS_FIELDS), F.lit(0))
    filled = records.select("record_id", (present / float(len(COMPLETENESS_FIELDS))).alias("share"))
    side = lambda s: filled.select(F.col("record_id").alias(s), F.col("share").alias(f"_{s}"))
    rows = scored_pairs.join(side("i"), "i").join(side("j"), "j")
    bucket = fn.bin_right_closed((F.col("_i") + F.col("_j")) / 2.0, BUCKET_EDGES, BUCKETS)
    table = rows.groupBy(bucket.alias("completeness_bucket")).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.avg("pred_match").alias("predicted_match_rate"),
        F.avg("same_person").alias("true_match_rate"),
    )
    frame = records.sparkSession.createDataFrame([(b,) for b in BUCKETS], "completeness_bucket string")
    joined = frame.join(table, "completeness_bucket", "left")
    return joined.withColumn("n_pairs", F.coalesce("n_pairs", F.lit(0)))


def fragmentation(records: DataFrame) -> DataFrame:
    """People, records and records per person."""
    table = records.agg(F.count_distinct("person_id").alias("n_people"), F.count(F.lit(1)).alias("n_records"))
    return table.withColumn("avg_records_per_person", F.round(F.col("n_records") / F.col("n_people"), 2))
