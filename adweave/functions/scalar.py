"""Column expressions shared by the operators. All are builtins, so they stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Channel name fragments, tested in this order; the first hit wins.
CHANNEL_FRAGMENTS = [
    ("search", "search"),
    ("social", "social"),
    ("facebook", "social"),
    ("instagram", "social"),
    ("tiktok", "social"),
    ("display", "display"),
    ("banner", "display"),
    ("email", "email"),
    ("newsletter", "email"),
]


def normalize_channel(name: str | Column) -> Column:
    """Maps free channel text to search, social, display, email or other."""
    text = F.lower(F.trim(name if isinstance(name, Column) else F.col(name)))
    expr = None
    for fragment, channel in CHANNEL_FRAGMENTS:
        hit = text.contains(fragment)
        expr = F.when(hit, channel) if expr is None else expr.when(hit, channel)
    return expr.otherwise("other")


def hours_between(earlier: str, later: str) -> Column:
    """Fractional hours from ``earlier`` to ``later`` at microsecond resolution."""
    return F.expr(f"timestampdiff(MICROSECOND, {earlier}, {later}) / 3.6e9D")


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, independent of the session time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def epoch_to_ts(seconds: str) -> Column:
    """Epoch seconds (possibly fractional) to timestamp."""
    return F.timestamp_micros(F.round(F.col(seconds).cast("double") * 1e6).cast("long"))


def to_number(column: str, kind: str = "double", fill: float | None = None) -> Column:
    """Numeric parse where bad text becomes null, or ``fill``."""
    parsed = F.col(column).try_cast(kind)
    return parsed if fill is None else F.coalesce(parsed, F.lit(fill).cast(kind))


def email_domain(email: str) -> Column:
    """Text after the first ``@``; empty when there is none."""
    return F.coalesce(F.split_part(F.col(email), F.lit("@"), F.lit(2)), F.lit(""))


def phone_last4(phone: str) -> Column:
    """Last four characters of a phone of at least four, else empty."""
    return F.when(F.length(phone) >= 4, F.right(F.col(phone), F.lit(4))).otherwise("")


def email_hash(email: str) -> Column:
    """First 16 hex digits of SHA-256; empty stays empty."""
    return F.when(F.coalesce(F.col(email), F.lit("")) == "", "").otherwise(
        F.left(F.sha2(F.col(email), 256), F.lit(16))
    )


def profile_text(columns: Sequence[str]) -> Column:
    """Lower-cased non-empty fields joined by one space."""
    return F.concat_ws(" ", *[F.nullif(F.lower(F.col(c)), F.lit("")) for c in columns])


def last_char_key(column: str) -> Column:
    return F.right(F.col(column).cast("string"), F.lit(1))


def yes_no(column: str) -> Column:
    """Yes → 1, No → 0, anything else null."""
    return F.when(F.col(column) == "Yes", 1).when(F.col(column) == "No", 0)


def positive_flag(column: str) -> Column:
    """1 when the numeric value is above zero, else 0 (bad or missing text counts as 0)."""
    return (to_number(column, fill=0.0) > 0).cast("int")


def treated_segment(column: str, control: str = "No E-Mail") -> Column:
    """1 unless the segment is the named control arm."""
    return (F.col(column) != control).cast("int")


def treated_by_text(column: str) -> Column:
    """1 unless the lower-cased segment text contains ``no``."""
    return (~F.lower(F.col(column)).contains("no")).cast("int")


def bin_right_closed(value: str | Column, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = True) -> Column:
    """(a, b] bins; with ``include_lowest`` the first bin also takes its left edge. Outside → null."""
    column = value if isinstance(value, Column) else F.col(value)
    expr = None
    for i, label in enumerate(labels):
        above = column >= F.lit(edges[i]) if i == 0 and include_lowest else column > F.lit(edges[i])
        hit = above & (column <= F.lit(edges[i + 1]))
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return expr


def lookup(column: str, mapping: Mapping[str, float], default: float) -> Column:
    """Dictionary lookup with a default."""
    expr = None
    for key, value in mapping.items():
        hit = F.col(column) == F.lit(key)
        expr = F.when(hit, F.lit(value)) if expr is None else expr.when(hit, F.lit(value))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def token_jaccard(a: str, b: str) -> Column:
    """Jaccard similarity of the lower-cased whitespace tokens; both empty → 0."""
    return jaccard(tokens(a), tokens(b))


def jaccard(left: Column, right: Column) -> Column:
    """Jaccard similarity of two arrays without repeats; both empty → 0."""
    both = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - both
    return F.when(either == 0, F.lit(0.0)).otherwise(both / either)


def tokens(column: str) -> Column:
    """The distinct lower-cased whitespace tokens."""
    words = F.split(F.lower(F.coalesce(F.col(column), F.lit(""))), r"\s+")
    return F.array_distinct(F.array_remove(words, ""))


def cosine(a: str, b: str) -> Column:
    """Cosine of two dense arrays; null when either is all zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    left, right = F.col(a), F.col(b)
    norm = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.when(norm > 0, dot(left, right) / norm)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, null for a zero denominator."""
    return top / F.nullif(bottom, F.lit(0).cast("double"))
