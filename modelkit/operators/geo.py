"""IP address to location by range lookup, in place of one web request per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelkit.functions.scalars import json_object
from modelkit.functions.skew import BROADCAST_BYTES, measured_bytes, salted_join

BUCKET_BITS = 16
# Parts that the addresses of a bucket are split into where the ranges cannot be broadcast.
SALTS = 16


def ip_number(ip: Column) -> Column:
    """Dotted IPv4 text as a number; NULL unless it is four numbers from 0 to 255."""
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    parts = F.split(ip, r"\.")
    total = F.lit(0).cast("long")
    for i, weight in enumerate((1 << 24, 1 << 16, 1 << 8, 1)):
        total = total + F.get(parts, F.lit(i)).cast("long") * F.lit(weight).cast("long")
    return F.when(ip.rlike(rf"^{octet}(\.{octet}){{3}}$"), total)


def bucket_of(number: Column) -> Column:
    return F.call_function("shiftright", number, F.lit(BUCKET_BITS))


def geo_lookup(
    df: DataFrame, ranges: DataFrame, ip: str = "ip", name: str = "geodata", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add location JSON ``{country, state, city}``, or ``{}`` where no range holds the address.

    ``ranges`` has disjoint ``start_ip`` / ``end_ip`` numbers. Each range is repeated per /16 bucket it
    touches, which turns the range condition into an equi join with a check. That repeated table is
    broadcast if its measured size allows; otherwise rows and buckets are salted by a hash of the address.
    """
    location = json_object(country=F.col("country"), state=F.col("state"), city=F.col("city"))
    table = ranges.select(
        F.explode(F.sequence(bucket_of(F.col("start_ip")), bucket_of(F.col("end_ip")))).alias("__bucket"),
        F.col("start_ip").alias("__start"),
        F.col("end_ip").alias("__end"),
        location.alias("__location"),
    )
    rows = df.withColumn("__ip", ip_number(F.col(ip))).withColumn("__b", bucket_of(F.col("__ip")))
    columns = [*df.columns, F.coalesce("__location", F.lit("{}")).alias(name)]
    within = F.col("__ip").between(F.col("__start"), F.col("__end"))
    if measured_bytes(table) <= max_bytes:
        return rows.join(F.broadcast(table), (F.col("__b") == F.col("__bucket")) & within, "left").select(*columns)
    # A /16 bucket with much traffic is split by address: each part meets a copy of the bucket's ranges.
    salted = rows.withColumn("__salt", F.pmod("__ip", F.lit(SALTS)))
    copies = table.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    match = (F.col("__b") == F.col("__bucket")) & (F.col("__salt") == F.col("__part")) & within
    return salted.join(copies, match, "left").select(*columns)


def by_country(df: DataFrame, geodata: str = "geodata") -> DataFrame:
    """Row count per country of the location JSON (NULL for unknown)."""
    return df.groupBy(F.get_json_object(geodata, "$.country").alias("country")).agg(
        F.count(F.lit(1)).alias("num_events")
    )


def _bits(digits: Column, base: int, width: int) -> Column:
    """Digits of a number base, an array of text, as one string of binary digits."""
    return F.array_join(F.transform(digits, lambda d: F.lpad(F.conv(d, base, 2), width, "0")), "")


def address_bits(ip: Column) -> Column:
    """An IPv4 or IPv6 address as '4:' or '6:' and its binary digits; NULL for any other text.

    IPv6 groups may be left out once by '::'; zones and embedded IPv4 notation are not taken.
    """
    four = F.concat(F.lit("4:"), _bits(F.split(ip, r"\."), 10, 8))
    halves = F.split(ip, "::", -1)
    groups = [F.filter(F.split(F.get(halves, F.lit(i)), ":"), lambda g: g != "") for i in (0, 1)]
    left, right = groups[0], F.coalesce(groups[1], F.array().cast("array<string>"))
    gap = F.size(halves) == 2
    missing = 8 - F.size(left) - F.size(right)
    whole = F.when(gap, F.concat(left, F.array_repeat(F.lit("0"), missing.cast("int")), right)).otherwise(left)
    valid = ip.rlike("^[0-9A-Fa-f:]+$") & F.forall(F.split(ip, ":", -1), lambda g: F.length(g) <= 4) & F.when(
        # A group left out stands for one zero group at least; without one there are eight, none of them empty.
        gap, (F.size(halves) == 2) & (missing >= 1) & ~ip.rlike(":::") & ~ip.rlike("(^:[^:])|([^:]:$)")
    ).otherwise((F.size(halves) == 1) & (F.size(left) == 8) & (F.size(F.split(ip, ":", -1)) == 8))
    return F.when(ip_number(ip).isNotNull(), four).when(valid, F.concat(F.lit("6:"), _bits(whole, 16, 16)))


def prefix_lookup(df: DataFrame, prefixes: DataFrame, columns: Sequence[str], ip: str = "ip", prefix: str = "prefix") -> DataFrame:
    """All rows of ``df`` with the ``columns`` of the longest prefix (``address/length``) that holds their address, else NULL.

    Prefixes may be nested and of both families; a text that is no prefix holds nothing, and of equal prefixes the
    smallest columns count. Only distinct addresses are looked up: each is cut to the lengths that occur in its
    family, which makes the lookup one equi join on the cut address, and the longest match of an address is kept.
    """
    columns = list(columns)
    length = F.try_to_number(F.split_part(prefix, F.lit("/"), F.lit(2)), F.lit("999")).cast("int")
    bits = address_bits(F.split_part(prefix, F.lit("/"), F.lit(1)))
    table = prefixes.select(bits.alias("__bits"), length.alias("__length"), *columns)
    table = table.where(F.col("__bits").isNotNull() & F.col("__length").between(0, F.length("__bits") - 2))
    # The family and its colon come before the digits.
    table = table.groupBy(F.expr("substr(__bits, 1, __length + 2)").alias("__cut")).agg(F.min(F.struct(*columns)).alias("__found"))
    lengths = table.agg(F.collect_set(F.struct(F.substring("__cut", 1, 1).alias("family"), F.length("__cut").alias("n")))).scalar()
    addresses = df.select(F.col(ip).alias("__ip")).where(F.col("__ip").isNotNull()).distinct()
    known = addresses.select("__ip", address_bits(F.col("__ip")).alias("__bits")).where(F.col("__bits").isNotNull()).withColumn("__lengths", lengths)
    fits = F.filter("__lengths", lambda x: x["family"] == F.substring("__bits", 1, 1))
    cut = known.withColumn("__x", F.explode(fits)).select("__ip", F.expr("substr(__bits, 1, __x.n)").alias("__cut"))
    longest = cut.join(table, "__cut").groupBy("__ip").agg(F.max_by("__found", F.length("__cut")).alias("__found")).withColumnRenamed("__ip", ip)
    spread = [c for c in df.columns if c != ip] or [ip]
    joined = salted_join(df, longest, [ip], spread, "left")
    return joined.select(*df.columns, *[F.col(f"__found.{c}").alias(c) for c in columns])
