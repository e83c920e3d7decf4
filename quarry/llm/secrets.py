"""Secret scans over an incremental ledger of content-addressed blobs (operator 6).

Every version of every path is addressed by the SHA-256 of its text.  The ledger holds, for
each (blob, rule version) that was ever scanned, the spans found in it (also none).  A scan
looks for the blobs whose (blob, rule version) is not in the ledger, scans one text of each,
adds them to the ledger, and joins the ledger's spans back to all paths.  Copies, old
versions and unchanged files thus cost one scan in all; new rules have another version.

All work is column expressions, joins and aggregates; a blob's copies meet only as (path,
digest) rows, which adaptive joins split when one blob holds many paths.

Defined cases: a null text is the empty blob; repeated (path, text) rows are each reported;
a null path keeps its row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.spans import listing, matches, tagged

# kind -> pattern, in the order of the report; the first three are the fixed base patterns.
BASE = ("assign", "access", "hex")
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}+",
    "private_key": r"-----BEGIN (?:[A-Z0-9]+ ){0,4}PRIVATE KEY-----",
    "web_token": r"\beyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
    "code_host": r"\b(?:gh[oprsu]_[A-Za-z0-9]{36,}+|glpat-[A-Za-z0-9_-]{20,}+)",
    "chat": r"\bxox[abeoprs]-[A-Za-z0-9-]{10,}+",
    "cloud_key": r"\b(?:AIza[A-Za-z0-9_-]{35}|ASIA[A-Z0-9]{16,}+)",
    "login_url": r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,100}:[^\s/:@]{1,100}@",
    "bearer": r"\b[Bb]earer\x20+[A-Za-z0-9._~+/=-]{20,}+",
}
#: A text without this cannot match the pattern.
NEEDS = {"access": "AKIA", "private_key": "PRIVATE KEY-----", "web_token": "eyJ", "login_url": "://", "bearer": "earer"}
_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""


def rule_version(patterns: dict | None = None) -> str:
    return hashlib.sha256(repr(sorted((patterns or PATTERNS).items())).encode()).hexdigest()[:16]


def _kept(kind: str, found: Column) -> Column:
    """The matches of a base kind that pass its length test."""
    if kind == "assign":
        return F.filter(found, lambda m: F.length(F.regexp_extract(m["text"], _VALUE, 1)) >= 6)
    if kind == "access":
        return F.filter(found, lambda m: F.length(m["text"]) >= 20)
    return found


def secret_spans(text: Column, patterns: dict | None = None) -> Column:
    """All spans (start, rank, end, kind) of a text, sorted."""
    parts = []
    for rank, (kind, pattern) in enumerate((patterns or PATTERNS).items()):
        need = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else None
        parts.append(tagged(_kept(kind, matches(text, pattern, need)), kind, rank))
    return F.array_sort(F.concat(*parts))


def scan(versions: DataFrame, ledger: DataFrame | None = None, path: str = "doc_id", text: str = "text",
         patterns: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings per version row, new ledger entries).

    findings: (path, blob, spans).  ledger: (blob, rule_version, spans), for the caller to
    append to its table.
    """
    version = rule_version(patterns)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    addressed = versions.select(F.col(path).alias("path"), body.alias("body")).withColumn("blob", F.sha2("body", 256))
    paths = addressed.select("path", "blob")
    wanted = paths.groupBy("blob").agg(F.min("path").alias("rep"))
    if ledger is not None:
        known = ledger.where(F.col("rule_version") == version).select("blob", "spans")
        wanted = wanted.join(known.select("blob"), "blob", "left_anti")
    w = wanted.select(F.col("blob").alias("wanted"), "rep")
    texts = addressed.join(w, (F.col("blob") == F.col("wanted")) & F.col("path").eqNullSafe(F.col("rep")), "left_semi")
    fresh = texts.select("blob", secret_spans(F.col("body"), patterns).alias("spans")).dropDuplicates(["blob"])
    entries = fresh.select("blob", F.lit(version).alias("rule_version"), "spans")
    every = fresh if ledger is None else fresh.unionByName(known)
    return paths.join(every, "blob", "left").select("path", "blob", "spans"), entries


def report(findings: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and listing of all spans per version row."""
    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return findings.select(F.col("path").alias("doc_id"), *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
                           F.sha2(listing(base), 256).alias("base_sha256"), listing(F.col("spans")).alias("spans"))
