"""Secret scans over a ledger of content-addressed blobs, in DataFrame functions only.

Every version of every file is addressed by the SHA-256 of its text, its blob. The ledger is a folder of written scans: a row holds a
blob, the rule versions that it was scanned with, and the spans found, also where there are none. A scan takes the
blobs of the given versions, leaves out the pairs of blob and rule version that the ledger holds, and appends the others; so a text is scanned once
for each rule, whatever the number of paths and commits that hold it, and a changed rule is a new version that scans
all blobs again, but with that rule only. Findings are joined back to all versions by blob.

A rule's matches are the leftmost non-overlapping ones of its pattern; those whose group is too short are dropped after
matching. Spans count code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .common import materialise, new_run_dir


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a Java pattern, and the least number of code points of one of its groups."""

    kind: str
    pattern: str
    min_chars: int = 1
    group: int = 0

    @property
    def version(self) -> str:
        """Changes with the rule."""
        return hashlib.sha256(repr((self.kind, self.pattern, self.min_chars, self.group)).encode()).hexdigest()[:16]


#: The three base kinds. A run of signs of 16 or 14 more is the whole run, so its length may stand in the pattern.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Kinds with a form of their own: tokens with a prefix, signed web tokens, heads of private keys.
FURTHER = (
    Rule("prefixed", r"gh[oprsu]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{20,}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]{2,12} ){0,2}PRIVATE KEY-----"),
)
RULES = BASE + FURTHER

#: Parts that the versions of one blob are dealt to when findings are joined back; findings, one row a blob that has any, are repeated as often.
SALTS = 8

LEDGER = "blob string, rules array<string>, spans array<struct<rule: string, start: int, end: int>>"


def blob_of(text: Column) -> Column:
    """Address of a text; null is the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All scans below a folder; a folder that does not exist yet is an empty ledger."""
    try:
        return spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LEDGER)
        raise


def _pieces(text: Column, rule: Rule) -> Column:
    """For each match, in order: the code points before it since the last one, its own, and whether it is long enough."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.pattern, -1)
    each = F.transform(
        F.arrays_zip(F.transform(found, F.length).alias("width"), F.transform(group, F.length).alias("chars"), F.slice(F.transform(gaps, F.length), 1, F.size(found)).alias("gap")),
        lambda x, k: F.struct(F.lit(rule.version).alias("rule"), k.alias("place"), x["gap"].alias("gap"), x["width"].alias("width"), (x["chars"] >= rule.min_chars).alias("kept")),
    )
    return F.when(text.rlike(rule.pattern), each).otherwise(F.array().cast("array<struct<rule: string, place: int, gap: int, width: int, kept: boolean>>"))


def update(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, text_column: str = "text") -> None:
    """Scan the pairs of blob and rule version that the ledger lacks and append them. Runs jobs.

    Copies of a text fold before they are moved, so that a text that a third of all rows hold costs a partition one row; only lengths
    and flags of matches are moved after that, one row a match. A scan is one written folder, which readers see whole; if a job fails, the
    next one scans the same pairs again. Null texts are empty ones. Of an empty table nothing is written.
    """
    spark = versions.sparkSession
    texts = versions.select(blob_of(F.col(text_column)).alias("blob"), F.coalesce(text_column, F.lit("")).alias("text"))
    texts = texts.groupBy("blob").agg(F.any_value("text").alias("text"))
    seen = read_ledger(spark, ledger).select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    asked = F.array(*[F.lit(r.version) for r in rules])
    missing = F.array_except(asked, F.coalesce("seen", F.array().cast("array<string>")))
    unseen = texts.join(seen, "blob", "left").select("blob", "text", missing.alias("rules")).where(F.size("rules") > 0)
    each = [F.when(F.array_contains("rules", r.version), _pieces(F.col("text"), r)) for r in rules]
    nothing = F.array().cast("array<struct<rule: string, place: int, gap: int, width: int, kept: boolean>>")
    pieces = reduce(F.concat, [F.coalesce(x, nothing) for x in each])
    scanned = materialise(unseen.select("blob", "rules", pieces.alias("pieces")), "scan")
    order = Window.partitionBy("blob", "p.rule").orderBy("p.place").rowsBetween(Window.unboundedPreceding, 0)
    placed = scanned.select("blob", F.explode("pieces").alias("p")).repartition("blob").withColumn("end", F.sum(F.col("p.gap") + F.col("p.width")).over(order).cast("int"))
    span = F.struct(F.col("p.rule").alias("rule"), (F.col("end") - F.col("p.width")).alias("start"), "end")
    spans = placed.where("p.kept").groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    rows = scanned.select("blob", "rules").join(spans, "blob", "left")
    rows = rows.select("blob", "rules", F.coalesce("spans", F.array().cast("array<struct<rule: string, start: int, end: int>>")).alias("spans"))
    rows.write.parquet(f"{ledger}/{new_run_dir(spark, 'scan').rsplit('/', 1)[1]}")


def findings(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, text_column: str = "text") -> DataFrame:
    """All rows and columns of ``versions`` but the text, with ``_blob`` and ``_findings``: what the ledger has for these rules.

    ``_findings`` is an array of (start, kind, end), by start, then by the order of ``rules``, then by end; it is empty where a blob has no secret or was never
    scanned. A pair that two scans hold counts once. Columns of these two names are replaced. The versions of a blob are dealt to
    ``SALTS`` parts by their other columns, and are a written table, so that a part may be split further where a blob is in very many versions.
    """
    spark = versions.sparkSession
    plain = versions.drop("_blob", "_findings").withColumn("_blob", blob_of(F.col(text_column))).drop(text_column)
    further = [f"further_{k}" for k in range(len(plain.columns) - 1)]
    simple = [c for c, f in zip(further, plain.schema.fields, strict=False) if isinstance(f.dataType, (T.NumericType, T.StringType, T.DateType, T.TimestampType))]
    addressed = plain.toDF(*further, "_blob").withColumn("_salt", F.pmod(F.xxhash64("_blob", *simple), F.lit(SALTS)))
    addressed = materialise(addressed, "versions")
    number = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.version, k)])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = read_ledger(spark, ledger).select("blob", F.explode("spans").alias("s")).withColumn("no", number[F.col("s.rule")]).where("no is not null")
    found = spans.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("s.start", "no", "s.end"))).alias("found"))
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("salt", F.col("salt").cast("long"))
    listed = F.transform("found", lambda x: F.struct(x["start"].alias("start"), F.get(kinds, x["no"]).alias("kind"), x["end"].alias("end")))
    empty = F.array().cast("array<struct<start: int, kind: string, end: int>>")
    near = (addressed["_blob"] == found["blob"]) & (addressed["_salt"] == found["salt"])
    out = addressed.join(found, near, "left").select(*further, "_blob", F.coalesce(listed, empty).alias("_findings"))
    return out.toDF(*plain.columns, "_findings")


def scan(versions: DataFrame, ledger: str | None = None, rules: Sequence[Rule] = RULES, text_column: str = "text") -> DataFrame:
    """``update`` and ``findings`` in one; without a ``ledger`` a new one in the shared folder."""
    ledger = ledger or new_run_dir(versions.sparkSession, "ledger")
    update(versions, ledger, rules, text_column)
    return findings(versions, ledger, rules, text_column)


def span_text(found: Column) -> Column:
    """Findings as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
