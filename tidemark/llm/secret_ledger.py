"""Secret scans with an incremental ledger of blobs.

A text is a blob, known by its SHA-256. The ledger is a table in the shared folder with one row per
scanned pair of blob and rule version. A call scans only the blobs that have no row for the present
rule version, each once however many documents (paths, versions of a path) hold it, appends what it
found, and joins the ledger back to all documents.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh
from tidemark.session import checkpoint_root

# Kind, pattern, group that is measured, least length. The first three are the base; their spans
# stay whatever else is added.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
RULES = [
    ("assign", ASSIGN, 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # Shorter runs fail anyway, and a run is matched whole or not at all.
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
    ("pem", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----"), 0, 1),
    ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 1),
    ("github", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), 0, 1),
    ("slack", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"), 0, 1),
]
BASE = ("assign", "access", "hex")
RULE_VERSION = hashlib.sha256(repr([(k, p.pattern, p.flags, g, n) for k, p, g, n in RULES]).encode()).hexdigest()[:16]

LEDGER = (
    "blob string, rule_version string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
)
FINDINGS = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def find(text: str) -> list[tuple[int, int, int]]:
    """Start, place of the kind in RULES, end of every match that is long enough, in order."""
    found = []
    for place, (_, pattern, group, least) in enumerate(RULES):
        for match in pattern.finditer(text):
            if match.end(group) - match.start(group) >= least:
                found.append((match.start(), place, match.end()))
    return sorted(found)


def _joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{RULES[place][0]}:{start}:{end}" for start, place, end in found)


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for blob, text in zip(batch["blob"], batch["text"]):
            found = find(text)
            base = [f for f in found if f[1] < len(BASE)]
            counts = [sum(f[1] == place for f in base) for place in range(len(BASE))]
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            rows.append((blob, RULE_VERSION, *counts, digest, _joined(found)))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in LEDGER.split(", ")])


def _ledger(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan(docs: DataFrame, ledger: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Bring the ledger at ``ledger`` up to ``docs``; the number of blobs scanned is what it grows by.

    A null text is the empty blob. Rows that repeat an id or a text add nothing. An empty table
    leaves the ledger as it is.
    """
    spark = docs.sparkSession
    blobs = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("blob", F.sha2("text", 256))
    seen = _ledger(spark, ledger).filter(F.col("rule_version") == RULE_VERSION).select("blob")
    # One carrier of each unseen blob, chosen on narrow rows; only then the texts are moved.
    carriers = (
        blobs.groupBy("blob").agg(F.min("doc_id").alias("carrier")).join(seen, "blob", "left_anti")
    ).withColumnRenamed("blob", "carried")
    unseen = (
        blobs.join(carriers, F.col("doc_id").eqNullSafe(F.col("carrier")) & (F.col("blob") == F.col("carried")))
        .select("blob", "text")
    )
    unseen.mapInPandas(_scan, LEDGER).write.mode("append").parquet(ledger)
    return _ledger(spark, ledger)


def with_findings(docs: DataFrame, ledger: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the columns of the ledger's row of its text: n_assign, n_access, n_hex,
    base_sha256 and spans (kind:start:end, code points, end exclusive, by start and then kind).

    Every row of ``docs`` comes back once, repeated rows too. Columns of these names are replaced.
    """
    docs = docs.drop(*FINDINGS)
    known = scan(docs, ledger, doc_id, text).filter(F.col("rule_version") == RULE_VERSION).drop("rule_version")
    # A carrier that is in the table twice, or a retried append, may leave a blob twice.
    content, blob = fresh(docs, "content", "found_in")
    known = known.dropDuplicates(["blob"]).withColumnRenamed("blob", blob)
    keyed = docs.withColumn(content, F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    return keyed.join(known, F.col(content) == F.col(blob), "left").drop(content, blob)


def new_ledger(spark) -> str:
    return f"{checkpoint_root(spark)}/blob-ledger-{uuid.uuid4().hex}"


@F.pandas_udf(T.StringType())
def redacted(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts with every span (merged where they overlap) replaced by [secret]."""
    out = []
    for text, found in zip(texts, spans):
        if text and found:
            parts, done = [], 0
            for start, end in sorted(tuple(map(int, s.split(":")[1:])) for s in found.split(",")):
                if start >= done:
                    parts += [text[done:start], "[secret]"]
                done = max(done, end)
            text = "".join(parts) + text[done:]
        out.append(text)
    return pd.Series(out, dtype=object)
