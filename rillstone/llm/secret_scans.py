"""Secret scans with an incremental ledger of blobs.

Every version of a file is addressed by the digest of its content. The ledger has one row for each pair of blob and rule
version that was ever scanned. A run scans only pairs that the ledger lacks, each blob once however many paths and
versions hold it, and joins the findings back to all of them.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.common import add_columns, table
from rillstone.session import shared_folder

KINDS = ("assign", "access", "hex", "pem", "jwt")
BASE = 3  # the first so many kinds make up the digest
RULE_VERSION = "2"

_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

FINDINGS = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
LEDGER = "blob string, rule_version string, " + FINDINGS
FOUND = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")
NOTHING = hashlib.sha256(b"").hexdigest()


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if "-----BEGIN" in text:
        out += [("pem", *m.span()) for m in _PEM.finditer(text)]
    if "eyJ" in text:
        out += [("jwt", *m.span()) for m in _JWT.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _scan(texts):
    rows = []
    for t in texts:
        spans = spans_of(t or "")
        base = [s for s in spans if s[0] in KINDS[:BASE]]
        counts = [sum(s[0] == k for s in base) for k in KINDS[:BASE]]
        rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
    return [*zip(*rows)]


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All pairs scanned so far; no row for a ledger that does not exist yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def scan(
    versions: DataFrame, ledger: str, path: str = "path", text: str = "text", version: str | None = None, rules: str = RULE_VERSION
) -> DataFrame:
    """``versions`` without its text, with ``blob`` and the findings of its content; the ledger in folder ``ledger`` grows.

    A null text is an empty blob. Repeated rows, null paths and copies share one scan and each get its findings. Columns
    that already have one of the new names are replaced. An empty table gives an empty one and scans nothing.
    """
    spark = versions.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    places = [path] + ([version] if version else [])
    named = versions.withColumn("blob", F.sha2(content, 256))
    seen = read_ledger(spark, ledger).filter(F.col("rule_version") == rules).select("blob")
    # One place stands for each unseen blob; the texts of the others are not moved.
    place = F.struct(*[F.col(c) for c in places])
    first = named.groupBy("blob").agg(F.min(place).alias("_place")).join(seen, "blob", "left_anti")
    first = first.select(F.col("blob").alias("_blob"), "_place").hint("shuffle_hash")
    same = (F.col("blob") == F.col("_blob")) & place.eqNullSafe(F.col("_place"))
    texts = named.select("blob", F.col(text).alias("_text"), *places).join(first, same, "left_semi")
    found = add_columns(texts.select("blob", "_text"), ["_text"], FINDINGS, _scan, keep=["blob"])
    found.dropDuplicates(["blob"]).select("blob", F.lit(rules).alias("rule_version"), *FOUND).write.mode("append").parquet(ledger)
    hits = read_ledger(spark, ledger).filter((F.col("rule_version") == rules) & (F.col("spans") != "")).drop("rule_version")
    kept = [c for c in named.columns if c != text and c.lower() not in FOUND]
    joined = named.select(*[f"`{c}`" for c in kept]).join(hits.dropDuplicates(["blob"]), "blob", "left")
    counts = [F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in FOUND[:3]]
    return joined.select(
        *[f"`{c}`" for c in kept], *counts, F.coalesce("base_sha256", F.lit(NOTHING)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans")
    )


def op9_blob_ledger(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scan(docs, shared_folder(spark, "secret-ledger"), path="doc_id")


QUERIES = {"op9_blob_ledger": op9_blob_ledger}
SQL: dict[str, str] = {}
