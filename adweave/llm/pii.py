"""Personal data by patterns and by what corpus co-occurrence discloses (operator 9), with DataFrame functions only.

Protected entities are the mail addresses, network addresses, card and phone numbers of all texts. A term near an
entity discloses it if most of the term's occurrences in the corpus lie near that entity and their information,
log2 p(entity | term) / p(entity), passes a threshold; such terms are removed from the entity's surroundings, and the entities
themselves are generalised to their kinds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adweave.llm.common import saved
from adweave.llm.spans import WORD_MARKS, matches, replace_in, word_counts

KINDS = ("email", "ip", "card", "phone")
AROUND = 120  # code points on each side of an entity that are its surroundings
SUPPORT = 2  # different surroundings that a term and an entity must share
SHARE = 0.5  # least share of a term's occurrences near the entity
BITS = 6.0  # least information in bits

_MAIL = r"[A-Za-z0-9._%+-]"
# The forms of the contract in possessive Java syntax: no position is tried twice and no repetition recurses, so long
# runs cost linear time. ``\G`` lets a match begin right after the one before it.
_PATTERNS = {
    "email": rf"(?:(?<!{_MAIL})|\G){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(c, i):
        n = c.cast("int")
        return F.when(i % 2 == 1, F.when(n > 4, n * 2 - 9).otherwise(n * 2)).otherwise(n)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        digits = _digits(found)
        return F.length(digits).between(16, 19) & _luhn(F.substring(digits, 1, 19))
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    return F.lit(True)


_NO_SPANS = "array<struct<kind:string,start:int,stop:int,found:string>>"


def _of_kind(text: Column, kind: str) -> Column:
    spans = F.filter(matches(text, _PATTERNS[kind]), lambda s: _valid(kind, s["found"]))
    spans = F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["found"].alias("found")))
    return F.when(text.rlike(_HINTS[kind]), spans).otherwise(F.array().cast(_NO_SPANS))


def entities(text: Column) -> Column:
    """The base spans of a text as array<struct<kind, start, stop, found>> by kind, then start; empty for null."""
    return F.coalesce(F.concat(*[_of_kind(text, kind) for kind in KINDS]), F.array().cast(_NO_SPANS))


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", around: int = AROUND, support: int = SUPPORT, share: float = SHARE, bits: float = BITS,
) -> DataFrame:
    """(doc_id, text_key, base, terms) of every row: spans (kind, start, stop, found) in code points, stop exclusive.

    ``base`` holds the entities by kind, then start, ``terms`` the disclosing terms (kind ``term``) by start. Null and
    empty texts have none. Rows alike in id and text have the same spans, each of equal ids otherwise its own; other columns are
    not read; an empty table gives no rows. ``text_key`` tells rows with equal ids apart.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # one row per document, and the surroundings of each entity in it
    based = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text", entities(F.col("text")).alias("base"))
    texts = F.transform(
        F.col("base"),
        lambda e: F.struct(
            e["kind"].alias("kind"), e["stop"].alias("stop"), F.lower(e["found"]).alias("entity"),
            F.substring(F.col("text"), F.greatest(e["start"] - around, F.lit(0)) + 1, F.least(e["start"], F.lit(around))).alias("before"),
            F.greatest(e["start"] - around, F.lit(0)).alias("first"),
            F.substring(F.col("text"), e["stop"] + 1, F.lit(around)).alias("after"),
        ),
    )
    found = saved(based.select("doc_id", "text_key", "base", texts.alias("near")), "entities")

    taken = F.transform("base", lambda e: F.struct(e["start"].alias("start"), e["stop"].alias("stop"))).alias("taken")
    near = found.where(F.size("near") > 0).select(F.struct("doc_id", "text_key").alias("doc"), taken, F.explode("near").alias("n")).select("doc", "taken", "n.*")
    sides = F.array(
        # a word that the border of the surroundings may cut is left out
        F.struct(F.when(F.col("first") > 0, F.regexp_replace("before", r"^[^\x20\x09-\x0D]+", "")).otherwise(F.col("before")).alias("side"), (F.col("first") + F.length("before")).alias("ends"), F.lit(None).cast("int").alias("begins")),
        F.struct(F.when(F.length("after") == around, F.regexp_replace("after", r"[^\x20\x09-\x0D]+$", "")).otherwise(F.col("after")).alias("side"), F.lit(None).cast("int").alias("ends"), F.col("stop").alias("begins")),
    )
    near = near.select("doc", "taken", "kind", "entity", F.xxhash64("before", "after").alias("context"), F.explode(sides).alias("s"))
    near = near.select("doc", "taken", "kind", "entity", "context", F.coalesce("s.begins", F.col("s.ends") - F.length("s.side")).alias("origin"), F.explode(matches(F.col("s.side"), r"[^\x20\x09-\x0D]+")).alias("w"))
    lead = F.length("w.found") - F.length(F.ltrim("w.found", F.lit(WORD_MARKS)))
    term = F.trim("w.found", F.lit(WORD_MARKS))
    near = near.select("doc", "taken", "kind", "entity", "context", F.lower(term).alias("term"), (F.col("origin") + F.col("w.start") + lead).alias("start"), F.length(term).alias("long"))
    # any word may be a term, but not a part of an entity
    outside = ~F.exists("taken", lambda e: (e["start"] < F.col("start") + F.col("long")) & (e["stop"] > F.col("start")))
    near = saved(near.where(F.col("term").rlike(r"[\p{L}\p{N}]") & outside).drop("taken"), "surroundings")

    place = F.struct("doc", "start")  # a null id is a value here
    pairs = near.groupBy("kind", "entity", "term").agg(F.count_distinct("context").alias("shared"), F.count_distinct(place).alias("times")).where(F.col("shared") >= support)
    pairs = saved(pairs, "pairs")
    seen = near.groupBy("kind", "entity").agg(F.count_distinct(place).alias("words_near"))
    wanted = pairs.select("term").distinct()
    # every word of every text is counted, before the join with the terms that matter
    corpus = word_counts(F.col("text"), rows)
    counted = saved(corpus.join(wanted.withColumn("wanted", F.lit(True)), "term", "left").groupBy(F.when(F.col("wanted"), F.col("term")).alias("term")).agg(F.sum("n").alias("n")), "term-counts")
    total = counted.agg(F.sum("n")).first()[0] or 0
    told = pairs.join(counted, "term").join(seen, ["kind", "entity"])
    given = F.col("times") / F.col("n")
    told = told.where((given >= share) & (F.log2(given * F.lit(float(total)) / F.col("words_near")) >= bits)).select("kind", "entity", "term")
    told = near.join(told, ["kind", "entity", "term"]).select("doc.doc_id", "doc.text_key", "start", (F.col("start") + F.col("long")).alias("stop"), "term").distinct()
    terms = told.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("start", "stop", "term"))).alias("terms"))
    terms = terms.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.transform("terms", lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"), t["stop"].alias("stop"), t["term"].alias("found"))).alias("terms"))
    none = F.array().cast(_NO_SPANS)
    joined = found.join(terms, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    return joined.select("doc_id", "text_key", "base", F.coalesce("terms", none).alias("terms"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def sanitised(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the texts cleaned: entities become their kinds in brackets, disclosing terms ``[TERM]``.

    Of overlapping spans the one that begins first is replaced, of those the longest. Rows without spans stay as they are.
    """
    return replace_in(docs, found.select("doc_id", "text_key", F.concat("base", "terms").alias("spans")), id_col, text_col)
