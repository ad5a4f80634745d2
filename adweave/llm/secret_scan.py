"""Secret scan with a random forest against false positives (operator 3), with DataFrame functions only.

Findings are runs of token characters with a digit or sixteen capitals in a row. The forest judges them by length, character mix and
transitions, what common words and letter pairs of the corpus explain of them, the path they stand in and the words
around them. It is trained on labelled findings; ``weak_labels`` labels those whose format or surroundings leave no doubt.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.llm.common import saved
from adweave.llm.spans import matches, replace_in, word_counts

SAMPLE = 20_000  # labelled findings that the forest is trained on
WORDS, PAIRS = 500, 400  # most frequent words and letter pairs of the corpus that make the dictionary
AROUND = 40  # code points before and after a finding that are looked at

_TOKEN = "A-Za-z0-9+/_-"
PATTERN = rf"(?<![{_TOKEN}])(?:(?=[A-Za-z+/_-]*+[0-9])|(?=[A-Z]{{16}}))[{_TOKEN}]{{12,}}+={{0,2}}"
# formats of common providers' keys (fixed values)
FORMATS = r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}|AIza[A-Za-z0-9_-]{35})$"
_SECRET_WORD = r"(?i)(?:token|secret|passw|passwd|pwd|api[_ -]?key|access[_ -]?key|auth|bearer|credential|private)"
_HASH_WORD = r"(?i)(?:sha-?[0-9]*|md5|commit|checksum|digest|uuid|revision|etag|hash)\W*$"
_PLAIN_PATH = r"(?i)(?:test|example|sample|fixture|mock|vendor|lock|docs?/)"
FEATURES = [
    "f_length", "f_digits", "f_upper", "f_lower", "f_other", "f_changes", "f_hex", "f_pairs", "f_words", "f_in_path", "f_plain_path", "f_secret_word", "f_assigned", "f_quoted", "f_hash_word",
]


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """(doc_id, text_key, start, stop, found, features…) of every candidate in every whole text.

    The dictionary is the corpus' most frequent words and their letter pairs, counted over all texts.
    """
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(path, F.lit("")).alias("path"))
    counts = saved(word_counts(F.col("text"), rows).where(F.col("term").rlike(r"^\p{L}{2,15}$")).orderBy(F.desc("n"), "term").limit(20 * WORDS), "dictionary")
    common = counts.where(F.length("term") >= 4).orderBy(F.desc("n"), "term").limit(WORDS).select("term").collect()
    pairs = counts.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("term") - 1), lambda i: F.substring("term", i, F.lit(2)))).alias("pair"))
    pairs = pairs.groupBy("pair").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pair").limit(PAIRS).collect()
    # both tables are bounded and stand in the plan as literals
    dictionary = F.array(*[F.lit(r["term"]) for r in common]).cast("array<string>")
    pair_set = F.array(*[F.lit(r["pair"]) for r in pairs]).cast("array<string>")

    spans = F.when(F.col("text").rlike("[0-9]|[A-Z]{16}"), matches(F.col("text"), PATTERN)).otherwise(F.array().cast("array<struct<start:int,stop:int,found:string>>"))
    around = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), s["found"].alias("found"),
            F.substring(F.col("text"), F.greatest(s["start"] - AROUND, F.lit(0)) + 1, F.least(s["start"], F.lit(AROUND))).alias("before"),
            F.substring(F.col("text"), s["stop"] + 1, F.lit(AROUND)).alias("after"),
        ),
    )
    found = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "path", F.explode(around).alias("s")).select("doc_id", "text_key", "path", "s.*")
    found = saved(found, "candidates")
    n = F.length("found")
    low = F.lower("found")
    share = lambda kind: F.length(F.regexp_replace("found", f"[^{kind}]", "")) / n
    number = lambda flag: flag.cast("double")
    pairs_known = F.size(F.filter(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(low, i, F.lit(2))), lambda p: F.array_contains(pair_set, p)))
    covered = F.aggregate(dictionary, F.lit(0), lambda a, w: a + F.when(F.contains(low, w), F.length(w)).otherwise(0))
    return found.select(
        "doc_id", "text_key", "start", "stop", "found", "before",
        n.cast("double").alias("f_length"), share("0-9").alias("f_digits"), share("A-Z").alias("f_upper"), share("a-z").alias("f_lower"),
        (F.length(F.regexp_replace("found", "[A-Za-z0-9]", "")) / n).alias("f_other"),
        ((F.regexp_count("found", F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")) - 1) / n).alias("f_changes"),
        number(F.col("found").rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")).alias("f_hex"),
        (pairs_known / (n - 1)).alias("f_pairs"), F.least(covered / n, F.lit(1.0)).alias("f_words"),
        number(F.col("before").rlike(r"[/\\]$") | F.col("found").contains("/")).alias("f_in_path"), number(F.col("path").rlike(_PLAIN_PATH)).alias("f_plain_path"),
        number(F.col("before").rlike(_SECRET_WORD)).alias("f_secret_word"), number(F.col("before").rlike(r"[=:]\s*[\"']?$")).alias("f_assigned"),
        number(F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).alias("f_quoted"), number(F.col("before").rlike(_HASH_WORD)).alias("f_hash_word"),
    )


def weak_labels(found: DataFrame) -> DataFrame:
    """``found`` with a label: 1 for a provider's format or an assignment to a secret's name, 0 for numbers, named hashes and what words explain, else null."""
    secret = F.col("found").rlike(FORMATS) | ((F.col("f_secret_word") == 1) & (F.col("f_assigned") == 1) & (F.col("f_length") >= 20))
    plain = F.col("found").rlike("^[0-9+/_-]+$") | (F.col("f_hash_word") == 1) | (F.col("f_words") > 0.6)
    return found.withColumn("label", F.when(secret & ~plain, 1.0).when(plain & ~secret, 0.0))


def train(labelled: DataFrame, trees: int = 30, depth: int = 6, sample: int = SAMPLE, seed: int = 5):
    """A random forest on at most ``sample`` labelled findings (those with the smallest hashes); null without both classes."""
    rows = labelled.where("label is not null").orderBy(F.xxhash64("found", "doc_id", "start"), "doc_id", "start").limit(sample).select("label", *FEATURES)
    rows = saved(rows, "labelled")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, labelCol="label", featuresCol="features")
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))


def judged(labelled: DataFrame, model) -> DataFrame:
    """(doc_id, text_key, start, stop, found, score, is_secret); without a model the label decides, no label means no secret."""
    keep = ["doc_id", "text_key", "start", "stop", "found"]
    if model is None:
        return labelled.select(*keep, F.coalesce("label", F.lit(0.0)).alias("score")).withColumn("is_secret", F.col("score") >= 0.5)
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(labelled))
    return scored.select(*keep, vector_to_array("probability")[1].alias("score")).withColumn("is_secret", F.col("score") >= 0.5)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """All findings of all whole texts with scores, judged by a forest trained on the sure ones among them.

    Null and empty texts have no findings; equal findings of rows alike in id and text are listed for each row; other columns are not
    read; an empty table gives no rows. Places are code points, ``stop`` exclusive.
    """
    labelled = saved(weak_labels(findings(docs, id_col, text_col, path_col)), "findings")
    return judged(labelled, train(labelled))


def redacted(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by ``[SECRET]``; all rows and columns stay."""
    spans = found.where("is_secret").groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "stop", F.lit("secret").alias("kind"))).alias("spans"))
    return replace_in(docs, spans, id_col, text_col)
