"""Column expressions that the modelling operators share. All compile to built-in functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(value: Column, floors: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first floor that ``value`` exceeds; NULL values get ``default``."""
    out = None
    for floor, label in floors:
        hit = value > F.lit(floor)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)


def classify(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """First matching ``LIKE`` pattern wins; text without a match is kept as it is."""
    out = None
    for pattern, label in rules:
        hit = text.like(pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return text if out is None else out.otherwise(text)


def host_of(url: Column) -> Column:
    """Lower-case host name of an absolute URL; empty for anything else."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def channel(url: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the first rule whose domain is the URL's host or one of its parents; other URLs are kept as they are.

    A domain that ends in a dot stands for all endings, so ``google.`` is google.com and google.co.uk alike.
    """
    host, out = F.concat(F.lit("."), host_of(url)), None
    for domain, label in rules:
        hit = host.contains(f".{domain}") if domain.endswith(".") else host.endswith(f".{domain}")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return url if out is None else out.otherwise(url)


CHANNEL_DOMAINS = (("linkedin.com", "Linkedin"), ("t.co", "Twitter"), ("google.", "Google"), ("lnkd.in", "Linkedin"))

# Public referrer patterns and their channels, the literal form (it also hits names that contain one).
REFERRER_RULES = (
    ("%linkedin%", "Linkedin"),
    ("%t.co%", "Twitter"),
    ("%google%", "Google"),
    ("%lnkd%", "Linkedin"),
)


def minutes(text: Column) -> Column:
    """``mm:ss`` as fractional minutes; NULL for anything that is not two numbers."""
    whole = F.split_part(text, F.lit(":"), F.lit(1)).try_cast("double")
    seconds = F.split_part(text, F.lit(":"), F.lit(2)).try_cast("double")
    return whole + seconds / F.lit(60.0)


def mentions(text: Column, token: str) -> Column:
    """True when ``token`` occurs in ``text``; NULL text mentions nothing."""
    return F.coalesce(F.locate(token, text) > 0, F.lit(False))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Division in which a zero divisor counts as one."""
    return top / F.when(bottom == 0, F.lit(1.0)).otherwise(bottom)


def first_token(text: Column, separator: str = " ") -> Column:
    return F.get(F.split(text, separator), F.lit(0))


def iso_timestamp(text: Column) -> Column:
    """ISO timestamps with milliseconds and a literal Z; NULL when the text does not parse."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def json_object(**fields: Column) -> Column:
    """JSON text that keeps NULL fields, which ``to_json`` drops by default."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe equality over two lists of columns; two empty lists are equal."""
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & a.eqNullSafe(b)
    return out
