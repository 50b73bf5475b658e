"""Secret scans over an incremental ledger of blobs.

A blob is a text under the digest of its content. The ledger holds one row per (blob, rule version)
with what was found, so a text is scanned once per rule version, whichever documents, paths or
historical versions hold it. Findings are joined back to all of them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.llm.common import text_or_empty

SPANS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob binary, rules string, spans {SPANS}"


@dataclass(frozen=True)
class SecretRule:
    """Matches of a pattern, leftmost and not overlapping; ``group`` must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = True


#: Matches of the base kinds are what the base pattern gives: for runs of one character class, a
#: run is at least so long exactly if the bounded pattern matches it.
RULES = (
    SecretRule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", r"[0-9a-f]{24,}"),
    SecretRule("key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
)


def rules_version(rules: tuple[SecretRule, ...] = RULES) -> str:
    """Changes whenever a rule does."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def scan_text(text: str, compiled: list[tuple[SecretRule, re.Pattern]]) -> list[tuple[str, int, int]]:
    """Spans in code points by start, then in the order of the rules."""
    found = []
    for place, (rule, pattern) in enumerate(compiled):
        for m in pattern.finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((m.start(), place, rule.kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def scanned(text: Column, rules: tuple[SecretRule, ...] = RULES) -> Column:
    @F.pandas_udf(SPANS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compiled = [(r, re.compile(r.pattern, re.ASCII)) for r in rules]
        for batch in batches:
            yield pd.Series([scan_text(text or "", compiled) for text in batch])

    return scan(text)


def blob_of(text: Column) -> Column:
    """Content address: the SHA-256 of the text, null counting as empty."""
    return F.unhex(F.sha2(text_or_empty(text), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at a path of the shared folder; empty if nothing was written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def unseen(docs: DataFrame, ledger: DataFrame, version: str) -> DataFrame:
    """``(blob, text)``, once for each blob that the ledger doesn't hold under this version.

    Copies collapse before the shuffle, so a text that a third of all rows share is one row a task.
    """
    blobs = docs.select(blob_of(F.col("text")).alias("blob"), text_or_empty(F.col("text")).alias("text"))
    seen = ledger.where(F.col("rules") == version).select("blob")
    return blobs.dropDuplicates(["blob"]).join(seen, "blob", "left_anti")


def update_ledger(docs: DataFrame, path: str, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks, append it, and return the ledger's rows of this version.

    Running it again, after a failure too, adds only what is missing. A blob that two writers add at
    once has two equal rows; readers take one.
    """
    spark = docs.sparkSession
    version = rules_version(rules)
    fresh = unseen(docs, read_ledger(spark, path), version).select(
        "blob", F.lit(version).alias("rules"), scanned(F.col("text"), rules).alias("spans")
    )
    fresh.write.mode("append").parquet(path)
    return read_ledger(spark, path).where(F.col("rules") == version)


def findings(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every document with the spans of its blob: ``doc_id, blob, spans`` (an empty list for none).

    Only blobs with findings take part in the join.
    """
    hits = ledger.where(F.size("spans") > 0).select(F.col("blob").alias("_b"), "spans").dropDuplicates(["_b"])
    own = docs.select("doc_id", blob_of(F.col("text")).alias("blob"))
    none = F.array().cast(SPANS)
    return own.join(hits, F.col("blob") == F.col("_b"), "left").select(
        "doc_id", "blob", F.coalesce("spans", none).alias("spans")
    )
