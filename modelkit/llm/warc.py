"""Not-modified revisits: each 304 capture gets the body of the latest earlier full response of its URL.

An as-of join by canonical URL. Captures of one URL are cut into blocks of time, so that a URL with a
large share of all captures is spread over many tasks: the latest full response inside a block comes from
a window over the block, the one before it from a running maximum over one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Headers a 304 response may bring up to date; all others stay as stored with the full response.
UPDATES = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that name a visit, not a page.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)="
# Seconds of a block of captures.
BLOCK_SECONDS = 86_400


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host without www., default port, fragment, tracking parameters and last slash; parameters sorted.

    Null for a null url. What does not look like scheme://host is only trimmed and loses its fragment.
    """
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    parts = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(?:\?(.*))?$"
    scheme, host, path, query = (F.regexp_extract(bare, parts, i) for i in range(1, 5))
    host = F.regexp_replace(F.regexp_replace(F.lower(host), r"^([^@]*@)?(www\.)?", ""), r":(80|443)$", "")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    path = F.regexp_replace(path, r"/+$", "")
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    plain = F.concat(F.regexp_replace(F.lower(scheme), "^https$", "http"), F.lit("://"), host, path, tail)
    return F.when(bare.rlike(parts), plain).otherwise(bare)


def _opaque(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(tag, "^W/", "")


def resolve(captures: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Resolve the revisits among ``captures`` (capture_id, url, ts, status, headers, body).

    ``ts`` is in seconds, ``headers`` a map with lower-case names. Returns every capture with
    ``canonical``, ``source_id`` (the full response it stands for: itself if status is 200), ``outcome``
    and the merged ``headers`` and ``body``. Outcomes:

    * ``full``: a 200 response;
    * ``resolved``: a 304 whose entity tag, or, if it brings none, whose last-modified date equals that of the
      latest earlier full response; one that brings neither is resolved too;
    * ``changed``: the latest earlier full response has another validator, or lacks the one asked for;
    * ``orphan``: no earlier full response, or a null url or ts;
    * ``other``: any other status, or none.

    "Earlier" is by ts, then capture_id; of equal captures none is earlier. Null headers count as empty, a
    repeated header of the 304 wins if it is in ``UPDATES``. Extra columns are dropped; an empty table gives
    an empty result.
    """
    rows = captures.select(
        "capture_id",
        "url",
        canonical_url(F.col("url")).alias("canonical"),
        F.col("ts").cast("long").alias("ts"),
        F.col("status").cast("int").alias("status"),
        F.coalesce("headers", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("headers"),
        "body",
    )
    usable = F.col("canonical").isNotNull() & F.col("ts").isNotNull()
    full = F.coalesce(F.col("status") == 200, F.lit(False))
    placed = rows.withColumn("block", F.floor(F.col("ts") / block_seconds))
    # The body stays where it is: only keys and validators go through the windows.
    order = F.struct("ts", "capture_id", F.element_at("headers", F.lit("etag")).alias("etag"), F.element_at("headers", F.lit("last-modified")).alias("modified"))
    slim = placed.where(usable & (full | (F.col("status") == 304))).select(
        "canonical", "block", "ts", "capture_id", "status", order.alias("own"), F.when(full, order).alias("response")
    )
    before = W.partitionBy("canonical").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carry = (
        slim.groupBy("canonical", "block")
        .agg(F.max("response").alias("last"))
        .withColumn("carry", F.max("last").over(before))
        .select("canonical", "block", "carry")
    )
    # All rows strictly before in (ts, capture_id); equal ones are peers and not seen.
    inside = W.partitionBy("canonical", "block").orderBy("ts", "capture_id")
    peers = slim.groupBy("canonical", "block", "ts", "capture_id").agg(
        F.max("response").alias("response"), F.max((F.col("status") == 304).cast("int")).alias("asks")
    )
    seen = peers.withColumn("seen", F.max("response").over(inside.rowsBetween(W.unboundedPreceding, -1))).where("asks = 1")
    located = (
        seen.join(carry, ["canonical", "block"], "left")
        .select("canonical", "ts", "capture_id", F.coalesce("seen", "carry").alias("match"))
        .where("match is not null")
        .select("canonical", "ts", "capture_id", F.col("match.ts").alias("source_ts"), F.col("match.capture_id").alias("source_id"))
    )
    stored = (
        rows.where(usable & full)
        .groupBy("canonical", F.col("ts").alias("source_ts"), F.col("capture_id").alias("source_id"))
        .agg(F.max(F.struct(F.map_entries("headers").alias("headers"), "body")).alias("stored"))
    )
    asked = rows.where(usable & (F.col("status") == 304)).join(located, ["canonical", "ts", "capture_id"], "left")
    joined = asked.join(stored, ["canonical", "source_ts", "source_id"], "left")
    kept = F.map_from_entries("stored.headers")
    tag, date = F.element_at("headers", F.lit("etag")), F.element_at("headers", F.lit("last-modified"))
    same = F.when(tag.isNotNull(), F.coalesce(_opaque(tag) == _opaque(F.element_at(kept, F.lit("etag"))), F.lit(False))).otherwise(
        F.when(date.isNotNull(), F.coalesce(date == F.element_at(kept, F.lit("last-modified")), F.lit(False))).otherwise(True)
    )
    outcome = F.when(F.col("source_id").isNull(), "orphan").when(same, "resolved").otherwise("changed")
    fresh = F.map_filter("headers", lambda k, _: k.isin(*UPDATES))
    merged = F.map_concat(F.map_filter(kept, lambda k, _: ~F.array_contains(F.map_keys(fresh), k)), fresh)
    good = F.col("outcome") == "resolved"
    revisits = joined.withColumn("outcome", outcome).select(
        "capture_id",
        "url",
        "canonical",
        "ts",
        "status",
        F.when(good, F.col("source_id")).alias("source_id"),
        "outcome",
        F.when(good, merged).otherwise(F.col("headers")).alias("headers"),
        F.when(good, F.col("stored.body")).alias("body"),
    )
    rest = rows.where(~(usable & F.coalesce(F.col("status") == 304, F.lit(False)))).select(
        "capture_id",
        "url",
        "canonical",
        "ts",
        "status",
        F.when(full, F.col("capture_id")).alias("source_id"),
        F.when(full, "full").when(F.col("status") == 304, "orphan").otherwise("other").alias("outcome"),
        "headers",
        "body",
    )
    return revisits.unionByName(rest)


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl history of ``pages`` (page_id, url, html), told by the pages themselves.

    Page p is fetched at second 3600 * p: a full response with the hash of its body as entity tag. Later
    visits send validators: one to its own url a day on with the same tag, one 40 days on that repeats only the date,
    and for every third page one whose tag is of another body. Every fifth page is asked for an hour before
    its first fetch. All pages and their whole bodies are used.
    """
    tag, pid = F.md5(F.coalesce("html", F.lit(""))), F.col("page_id")
    modified = F.concat(F.lit("day "), F.floor(pid / 24))

    def visit(kind: int, after: int, status: int, headers: dict[str, Column], body: Column, when: Column) -> Column:
        names = F.array(*[F.lit(k) for k in headers])
        return F.when(
            when,
            F.struct(
                (pid * 8 + kind).alias("capture_id"),
                (pid * 3600 + after).alias("ts"),
                F.lit(status).alias("status"),
                F.map_from_arrays(names, F.array(*headers.values())).alias("headers"),
                body.alias("body"),
            ),
        )

    none, always = F.lit(None).cast("string"), F.lit(True)
    text = {"content-type": F.lit("text/html"), "content-length": F.length("html").cast("string")}
    visits = [
        visit(0, 0, 200, {"etag": tag, "last-modified": modified, "date": F.lit("first"), **text}, F.col("html"), always),
        visit(1, 86_400, 304, {"etag": F.concat(F.lit("W/"), tag), "date": F.lit("second"), "content-length": F.lit("0")}, none, always),
        visit(2, 40 * 86_400, 304, {"last-modified": modified, "expires": F.lit("later")}, none, always),
        visit(3, 43_200, 304, {"etag": F.md5(F.concat(tag, F.lit("x")))}, none, pid % 3 == 0),
        visit(4, -3_600, 304, {"date": F.lit("before")}, none, pid % 5 == 0),
    ]
    return pages.withColumn("visit", F.explode(F.filter(F.array(*visits), lambda v: v.isNotNull()))).select("url", "visit.*")
