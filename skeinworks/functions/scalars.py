"""Scalar expressions: buckets, splits, identifiers, clamps, page ranges, statistics on counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits_bucket(n: Column) -> Column:
    return F.when(n <= 1, "1").when(n <= 4, n.cast("string")).when(n <= 8, "5-8").otherwise("9+")


def places_bucket(n: Column) -> Column:
    return F.when(n <= 0, "0").when(n <= 2, n.cast("string")).otherwise("3+")


def steps_bucket(n: Column) -> Column:
    return F.when(n <= 1, "1").when(n == 2, "2").otherwise("3+")


def grade_band(grade: Column) -> Column:
    return F.when(grade <= 2, "low").when(grade <= 4, "mid").otherwise("high")


def size_band(n: Column) -> Column:
    return F.when(n <= 1, "1").when(n <= 4, "2-4").otherwise("5+")


def md5_split(key: Column) -> Column:
    """``val`` if the last hexadecimal digit of the md5 is even, else ``test``."""
    return F.when(F.conv(F.substring(F.md5(key.cast("string")), 32, 1), 16, 10).cast("int") % 2 == 0, "val").otherwise("test")


def last_segment(name: Column, separator: str = "/") -> Column:
    return F.element_at(F.split(name, separator), -1)


def ordered_distinct(items: Column) -> Column:
    """Distinct items in order of first appearance."""
    return F.array_distinct(items)


def clamp_confidence(text: Column) -> Column:
    """A number in [0, 1]; anything else counts as 0."""
    number = text.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)))


def json_object(text: Column) -> Column:
    """The JSON object inside fences or other text: from the first ``{`` to the last ``}``; null if that does not parse."""
    return F.try_parse_json(F.regexp_extract(text, r"(?s)(\{.*\})", 1))


def page_numbers(ranges: Column, last: int) -> Column:
    """``"1-8,3"`` as sorted distinct pages from 1 to ``last``."""
    parts = F.filter(F.transform(F.split(ranges, ","), lambda p: F.trim(p)), lambda p: p.rlike(r"^\d+(-\d+)?$"))
    spans = F.transform(parts, lambda p: F.struct(F.greatest(F.lit(1), F.split(p, "-")[0].cast("int")).alias("a"), F.least(F.lit(last), F.element_at(F.split(p, "-"), -1).cast("int")).alias("b")))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(spans, lambda s: s.a <= s.b), lambda s: F.sequence(s.a, s.b)))))


def normal_term(text: Column) -> Column:
    """Lower case without white space and punctuation (compatibility forms are folded by the caller)."""
    return F.lower(F.regexp_replace(text, r"[\s\p{Punct}\p{IsPunctuation}]+", ""))


def text_key(model: str, text: Column) -> Column:
    """SHA-256 of the model's name and the text, the key of cached vectors and answers."""
    return F.sha2(F.concat(F.lit(model + "\n"), text), 256)


def wilson(k: Column, n: Column, z: float = 1.96) -> Column:
    """``struct(p, lo, hi)`` rounded to 4 places; nulls for no trial."""
    k, n = k.cast("double"), F.nullif(n.cast("double"), F.lit(0.0))
    p = k / n
    d = 1 + z * z / n
    centre = (p + z * z / (2 * n)) / d
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / d
    within = lambda x: F.when(n.isNotNull(), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)), 4))
    return F.struct(F.round(p, 4).alias("p"), within(centre - half).alias("lo"), within(centre + half).alias("hi"))


def f1(p: Column, r: Column) -> Column:
    """Of rounded precision and recall; null if either is; 0 if both are 0."""
    return F.when(p.isNull() | r.isNull(), None).when(p + r == 0, 0.0).otherwise(F.round(2 * p * r / (p + r), 4))


def verdict(met: Column, total: Column) -> Column:
    return F.when(met == total, "covered").when(met == 0, "not_covered").otherwise("partial")
