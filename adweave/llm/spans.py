"""Places of regular-expression matches, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adweave.llm.common import unused

BROADCAST_SPANS = 100_000  # most spans that are broadcast, about 10 MB
WORD_MARKS = ".,;:!?|\"'()[]{}<>%$#&*=`"  # trimmed off both ends of a word


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as array<struct<start, stop, found>>, in code points; null for null.

    The texts between the matches and the matches alternate, so places are running sums of their lengths. ``pattern``
    needs a Java form that cannot match the empty text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("found"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,found:string>>").alias("out"))

    def add(state, pair):
        begin = state["at"] + F.length(pair["gap"])
        stop = begin + F.length(pair["found"])
        here = F.struct(begin.alias("start"), stop.alias("stop"), pair["found"].alias("found"))
        return F.struct(stop.alias("at"), F.concat(state["out"], F.array(here)).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(pairs, start, add, lambda s: s["out"])).otherwise(F.array().cast("array<struct<start:int,stop:int,found:string>>"))


def word_counts(texts: Column, docs: DataFrame) -> DataFrame:
    """(term, n) of all words of all texts, in lower case and without marks at their ends. Counts are summed in the map tasks first."""
    words = docs.select(F.explode(F.split(texts, "[\\x20\\x09-\\x0D]+")).alias("w"))
    return words.groupBy(trimmed(F.col("w")).alias("term")).agg(F.count(F.lit(1)).alias("n")).where("term <> ''")


def replaced(text: Column, spans: Column) -> Column:
    """``text`` with each span (start, stop, kind) replaced by its kind in brackets.

    Of overlapping spans the one that begins first counts, of those the longest.
    """
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("back"), F.upper(s["kind"]).alias("kind"))))

    def cut(state, s):
        piece = F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit("["), s["kind"], F.lit("]"))
        return F.when(s["start"] >= state["at"], F.struct((-s["back"]).alias("at"), piece.alias("out"))).otherwise(state)

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(ordered, begin, cut, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def replace_in(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the spans (doc_id, text_key, spans) of their rows replaced; all columns stay, rows without spans too.

    A few spans are broadcast after they are counted; more are joined by a shuffle.
    """
    own_id, key, held_spans = (unused(docs, n) for n in ("_id", "_key", "_spans"))
    found = spans.where(F.size("spans") > 0).select(F.col("doc_id").alias(own_id), F.col("text_key").alias(key), F.col("spans").alias(held_spans)).dropDuplicates([own_id, key])
    held = found.agg(F.sum(F.size(held_spans))).first()[0] or 0
    found = F.broadcast(found) if held <= BROADCAST_SPANS else found
    text = F.col(text_col)
    match = F.col(id_col).cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(text.cast("string")) == F.col(key))
    both = docs.join(found, match, "left")
    return both.withColumn(text_col, F.when(F.col(held_spans).isNotNull(), replaced(text, F.col(held_spans))).otherwise(text)).select(docs.columns)


def trimmed(word: Column) -> Column:
    return F.trim(F.lower(word), F.lit(WORD_MARKS))
