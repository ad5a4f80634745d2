"""The registered queries of this subpackage and the SQL that checks those SQL can express."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adweave.llm import collocations, decontamination, language_id, lm_scoring, ngram_join, packing, periodic_runs, pii, secret_scan, substring_dedup, token_files, toxicity, vector_neardup
from adweave.llm.common import fold_of, scratch, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), errors=0.2).drop("text_key")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"), path_col="source")
    return found.where("is_secret").select("doc_id", "start", "stop", "found", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), held_fold=0))
    return scored.select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_windows(table(spark, sf_dir, "documents"), WORD_BPE, with_ids=False)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"), folds=5, held_fold=1)


def op7_vector_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_neardup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"), words=3, percent=90).select("doc_id", "n_shingles", "component_id")


def _is(kind: str):
    return lambda k: k == kind


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter(F.col("base")["kind"], _is(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    base, spans = pii.listed(F.col("base")), pii.listed(F.concat("base", "terms"))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    token_files.write_token_ids(table(spark, sf_dir, "documents"), path, WORD_BPE)
    return token_files.written_index(spark, path)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=10, most=2_000)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, folds=5, held_fold=0)
    return language_id.identify(docs, model).select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), "lang_pred", "score", "languages")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic_runs.looped("doc_id", "text").alias("text"))
    found = periodic_runs.find_runs(docs).withColumn("top", periodic_runs.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period", F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {"op1_substring_dedup": op1_substring_dedup, "op2_decontamination": op2_decontamination, "op3_secret_scan": op3_secret_scan, "op4_toxicity": op4_toxicity, "op5_packing": op5_packing, "op6_lm_scoring": op6_lm_scoring, "op7_vector_neardup": op7_vector_neardup, "op8_ngram_join": op8_ngram_join, "op9_pii": op9_pii, "op10_token_files": op10_token_files, "op11_collocations": op11_collocations, "op12_language_id": op12_language_id, "op13_periodic_runs": op13_periodic_runs, "pipeline": corpus_pipeline.run}
_WORDS = r"[^\x20\x09-\x0D]+"
_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# crc32 of a text bit by bit: every byte is followed by eight shifts, written as -1
_CRC = """xor(list_reduce(flatten(list_transform(string_split({0}, ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s % 2 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END, CAST(4294967295 AS BIGINT)), 4294967295)"""

ORACLE: dict[str, str] = {
    "op1_substring_dedup": rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
  places AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35),
  windows AS MATERIALIZED (SELECT r, p, array_to_string(w[p:p + 34], ' ') AS s FROM places),
  again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
  gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS i FROM windows JOIN again USING (s)),
  every AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
  kept AS (SELECT r, count(*) AS n, string_agg(w[i], ' ' ORDER BY i) AS t FROM every ANTI JOIN gone USING (r, i) GROUP BY r)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)""",
    "op7_vector_neardup": """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS MATERIALIZED (SELECT a.vec_id AS i, b.vec_id AS j FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
  reach AS (SELECT vec_id AS n, vec_id AS r FROM embeddings UNION SELECT l.j, reach.r FROM reach JOIN links l ON l.i = reach.n),
  low AS (SELECT n, min(r) AS component_id FROM reach GROUP BY n)
  SELECT vec_id, (SELECT count(*) FROM links WHERE i = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN low ON n = vec_id""",
    "op8_ngram_join": rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_AZ}, '{_WORDS}') AS w FROM documents),
  shingles AS MATERIALIZED (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda p: array_to_string(w[p:p + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d)),
  sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
  shared AS MATERIALIZED (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  links AS MATERIALIZED (SELECT i, j FROM shared JOIN sizes x ON x.doc_id = i JOIN sizes y ON y.doc_id = j WHERE 100 * c >= 90 * (x.n + y.n - c)),
  reach AS (SELECT doc_id AS n, doc_id AS r FROM documents UNION SELECT l.j, reach.r FROM reach JOIN links l ON l.i = reach.n),
  low AS (SELECT n, min(r) AS component_id FROM reach GROUP BY n)
  SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id FROM d JOIN low ON low.n = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id""",
    "op11_collocations": rf"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_AZ}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
  w AS MATERIALIZED (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
  grams AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM w, range(1, 4) t(m) WHERE len(w) >= m),
  f AS MATERIALIZED (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 10),
  cuts AS (SELECT lang, m, phrase, w, a, unnest(range(1, m)) AS k FROM f WHERE m > 1),
  priced AS (SELECT c.lang, c.m, c.phrase, c.a, k, l.a AS l, r.a AS r, CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(l.a AS HUGEINT) * r.a) AS score FROM cuts c
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
  lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM priced) WHERE o = 1),
  covers AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM f WHERE m = 3) GROUP BY ALL),
  n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
  ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM lowest LEFT JOIN covers USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
  SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_periodic_runs": rf"""WITH h AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w, {_CRC.format("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
  g AS (SELECT r, doc_id, w, len(w) AS n, h, h // 10 AS g FROM h),
  p AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM g),
  d AS MATERIALIZED (SELECT r, doc_id, CASE WHEN a IS NULL THEN w ELSE w[1:a] || list_transform(range(0, n - a), lambda i: w[1 + a + i % (1 + (n - a) // (3 + g % 8))]) END AS w FROM p),
  t AS MATERIALIZED (SELECT r, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM d),
  e AS (SELECT x.r, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.r = y.r AND x.x = y.x AND y.i > x.i),
  o AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS stretch FROM e),
  s AS (SELECT r, min(i) AS start, count(*) + q AS length, q FROM o GROUP BY r, q, stretch HAVING count(*) + q >= greatest(6, 4 * q)),
  runs AS MATERIALIZED (SELECT r, start, length, min(q) AS period FROM s GROUP BY r, start, length),
  top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY CAST(length AS DECIMAL(18, 0)) / period DESC, start, period) AS k FROM runs) WHERE k = 1),
  lines AS (SELECT r, count(*) AS c, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS l FROM runs GROUP BY r),
  gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
  kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS l FROM t ANTI JOIN gone USING (r, i) GROUP BY r)
  SELECT doc_id, coalesce(c, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(coalesce(lines.l, '')) AS runs_sha256, sha256(coalesce(kept.l, '')) AS collapsed_sha256
  FROM d LEFT JOIN top USING (r) LEFT JOIN lines USING (r) LEFT JOIN kept USING (r)""",
}
