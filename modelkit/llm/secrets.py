"""Secret scans with an incremental blob ledger, made of DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds, per blob and
rule version, the findings (an empty list if there are none). A run scans the blobs whose pair with the
current rule version the ledger lacks, appends them, and joins the findings back to all paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelkit.session import scratch_dir

RULE_VERSION = "3"

# The base patterns. Where a shortest length is asked of a run that a match takes whole, the
# pattern holds it; the value of an assignment is measured after the match, as a short one uses up its text.
ASSIGN = (
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
# Further rules of the library: key blocks, signed web tokens, and tokens with a vendor's prefix.
MORE = {
    "pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "jwt": r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
    "prefixed": r"\b(gh[opsu]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})",
}
# ``done`` is where the findings before a finding end: a finding that starts earlier lies over one of them.
FINDINGS = "array<struct<start:int,rank:int,kind:string,end:int,done:int>>"
LEDGER_SCHEMA = f"blob string, rule_version string, findings {FINDINGS}"
# Code points of the segments that a text is cut into before it is redacted.
SEGMENT = 4096


def steps_of(text: Column, kind: str, rank: int, pattern: str) -> Column:
    """Matches of a pattern in order, each as the length of the text before it and its own."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2 if kind == "assign" else 0))
    # The value of an assignment has six characters at least; shorter ones still use up their text.
    kept = F.transform(values, lambda v: F.length(v) >= 6 if kind == "assign" else F.lit(True))
    steps = F.zip_with(
        F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"))),
        kept,
        lambda x, k: F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["gap"].alias("gap"), x["size"].alias("size"), k.alias("kept")),
    )
    return F.when(text.rlike(pattern), steps).otherwise(F.array().cast("array<struct<rank:int,kind:string,gap:int,size:int,kept:boolean>>"))


def findings_of(blobs: DataFrame) -> DataFrame:
    """(blob, findings) of every row of (blob, content), one row per blob; findings by start, then rule.

    The matches of a blob become rows; running sums over its gaps and matches give the positions, so the
    work follows the number of matches. Null content has no findings.
    """
    steps = F.concat(*(steps_of(F.col("content"), kind, rank, p) for rank, (kind, p) in enumerate({**BASE, **MORE}.items())))
    steps = F.when(F.col("content").isNotNull(), steps)
    rows = blobs.select("blob", F.posexplode_outer(steps).alias("place", "step")).select("blob", "place", "step.*")
    # All windows run inside a blob, so the rows stay where the blobs are.
    along = W.partitionBy("blob", "rank").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    ends = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(along).cast("int")).withColumn("start", F.col("end") - F.col("size"))
    shown = ends.where(F.col("kept") | F.col("place").isNull() | (F.col("place") == 0))
    # The first row of a blob stays even if its match does not count, so that every blob has a row.
    counts = F.coalesce("kept", F.lit(False))
    before = W.partitionBy("blob").orderBy("start", "rank").rowsBetween(W.unboundedPreceding, -1)
    done = F.coalesce(F.max(F.when(counts, F.col("end"))).over(before), F.lit(0))
    finding = F.struct("start", "rank", "kind", "end", F.col("done"))
    found = shown.withColumn("done", done).groupBy("blob").agg(F.collect_list(F.when(counts, finding)).alias("findings"))
    return found.withColumn("findings", F.array_sort("findings").cast(FINDINGS))


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def open_ledger(spark: SparkSession, path: str | None = None) -> tuple[str, DataFrame | None]:
    """The ledger's folder and its rows; None for one that does not exist yet."""
    path = path or scratch_dir(spark, "secret-ledger")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return path, spark.read.schema(LEDGER_SCHEMA).parquet(path) if there else None


def scan(versions: DataFrame, ledger: str | None = None, text: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """Add ``blob`` and ``findings`` to every row of ``versions`` (one row per path and version).

    ``ledger`` is the folder of the ledger; without one a fresh ledger is made for this run. A null text is
    the empty blob. Equal texts are scanned once. Repeated rows and clashing column names stay as they are
    (``blob`` and ``findings`` are replaced). An empty table gives an empty result.
    """
    versions = versions.drop("blob", "findings")
    addressed = versions.withColumn("blob", blob_of(F.col(text)))
    path, known = open_ledger(versions.sparkSession, ledger)
    unseen = addressed.select("blob", F.col(text).alias("content"))
    if known is not None:
        unseen = unseen.join(known.where(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
    # One test tells the blobs without findings, whose text need not be moved.
    risky = F.col("content").rlike("|".join(f"(?:{p})" for p in {**BASE, **MORE}.values()))
    new = unseen.select("blob", F.when(risky, F.col("content")).alias("content")).groupBy("blob").agg(F.first("content").alias("content"))
    made = findings_of(new).select("blob", F.lit(rule_version).alias("rule_version"), "findings")
    made.write.mode("append").parquet(path)
    rows = versions.sparkSession.read.schema(LEDGER_SCHEMA).parquet(path)
    # Runs that overlap may both append a pair; it counts once.
    found = (
        rows.where((F.col("rule_version") == rule_version) & (F.size("findings") > 0))
        .groupBy("blob")
        .agg(F.first("findings").alias("findings"))
    )
    return addressed.join(found, "blob", "left").withColumn("findings", F.coalesce("findings", F.array().cast(FINDINGS)))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""

    def as_text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda s: s["rank"] < len(BASE))
    return found.select(key, *map(of, BASE), F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("findings")).alias("spans"))


def redacted(text: Column, findings: Column, mark: str = "[SECRET]") -> Column:
    """The text with every finding replaced by ``mark``; findings that overlap are replaced together.

    What is kept between findings is taken from segments of bounded size, so no finding costs a walk through the text.
    """

    def piece(segments: Column, begin: Column, end: Column) -> Column:
        first, last = F.floor(begin / SEGMENT).cast("int"), F.floor(end / SEGMENT).cast("int")
        inside, beyond = begin % SEGMENT, end % SEGMENT
        head, tail = F.coalesce(F.get(segments, first), F.lit("")), F.coalesce(F.get(segments, last), F.lit(""))
        return F.when(first == last, F.substr(head, inside + 1, end - begin)).otherwise(
            F.concat(
                F.substr(head, inside + 1, F.lit(SEGMENT)),
                F.array_join(F.slice(segments, first + 2, last - first - 1), ""),
                F.substr(tail, F.lit(1), beyond),
            )
        )

    def whole(segments: Column) -> Column:
        kept = F.transform(F.filter(findings, lambda s: s["start"] >= s["done"]), lambda s: F.concat(piece(segments, s["done"], s["start"]), F.lit(mark)))
        rest = piece(segments, F.array_max(F.transform(findings, lambda s: s["end"])), F.length(text))
        return F.concat(F.array_join(kept, ""), rest)

    # A one-element array binds the segments to a name, so that they are made once.
    segments = F.array(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{SEGMENT}}}"), F.lit(0)))
    return F.when(F.size(findings) > 0, F.get(F.transform(segments, whole), F.lit(0))).otherwise(text)
