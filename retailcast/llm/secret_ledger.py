"""Secret scan with an incremental blob ledger.

Every version of a text is addressed by its SHA-256. The ledger (Parquet, in a
shared folder) holds the findings of each scanned pair of blob and rule version;
a run scans one representative of each unseen pair, appends the findings and
joins them back to all paths. A new rule version scans everything anew, an
unchanged corpus nothing.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from retailcast.llm import textvec as V
from retailcast.session import materialize


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` has fewer
    than ``least`` characters are dropped. A text without any of ``hints`` (ASCII
    letters in either case, as lower case) has no match."""
    kind: str
    pattern: str
    least: int
    group: int = 0
    hints: tuple[str, ...] = ()
    ignore_case: bool = False


# ---- fixed values: the rules, base kinds first ----
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2,
         ("passw", "secret", "token", "api"), True),
    Rule("access", r"AKIA[A-Z0-9]+", 20, 0, ("akia",)),
    Rule("hex", r"[0-9a-f]+", 24),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----", 60, 0, ("private key",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30, 0, ("eyj",)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40, 0, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("basic_auth", r"://[^\s/:@]+:[^\s/:@]+@", 8, 0, ("://",)),
)
RULES = BASE_RULES + MORE_RULES
#: A run shorter than this can't be a long hexadecimal run: lets the scan skip in C.
HEX_LEAST = 24


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern if r.kind != "hex" else f"[0-9a-f]{{{HEX_LEAST},}}", re.ASCII | (re.I if r.ignore_case else 0)),
                       [h.encode() for h in r.hints]) for r in rules]

    def spans(self, text: str, low: bytes) -> list[tuple[int, int, str]]:
        """(start, end, kind) in code points, by start and then by the rules' order."""
        out = []
        for order, (rule, pattern, hints) in enumerate(self.rules):
            if hints and not any(h in low for h in hints):
                continue
            for m in pattern.finditer(text):
                if len(m[rule.group]) >= rule.least:
                    out.append((m.start(), order, m.end(), rule.kind))
        return [(s, e, k) for s, _, e, k in sorted(out)]


FOUND = "blob string, findings array<struct<start:long,end:long,kind:string>>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def _scan_pass(rules: tuple[Rule, ...], words):
    @V.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            part = batch.filter(pa.array(V.in_bitmap(words, batch.column("slot").to_numpy())))
            found = []
            for text in part.column("text"):
                raw = (text.as_buffer() or b"") and text.as_buffer().to_pybytes()
                spans = scanner.spans(raw.decode(), raw.lower())
                found.append([{"start": s, "end": e, "kind": k} for s, e, k in spans])
            yield pa.RecordBatch.from_arrays([part.column("blob"), pa.array(found, SPANS)], ["blob", "findings"])
    return run


def blob_address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def read_ledger(spark: SparkSession, path: str, version: str) -> DataFrame:
    """(blob, findings) of a rule version; a blob written twice (a repeated run) is read once."""
    try:
        rows = spark.read.schema(f"{FOUND}, version string, run string").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], f"{FOUND}, version string, run string")     # no run has written yet
    return rows.filter(F.col("version") == version).groupBy("blob").agg(F.first("findings").alias("findings"))


def update_ledger(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scans the unseen blobs of ``docs`` (doc_id, text), appends them to the ledger
    and returns them: (blob, findings)."""
    spark, version = docs.sparkSession, rule_version(rules)
    path = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    texts = docs.select(path.alias("path"), F.coalesce("text", F.lit("")).alias("text"), blob_address(F.col("text")).alias("blob"))
    seen = read_ledger(spark, ledger, version).select("blob")
    # the copies of a blob are combined by each task, before anything is dealt by blob
    unseen = texts.groupBy("blob").agg(F.min("path").alias("path")).join(seen, "blob", "left_anti")
    unseen = materialize(unseen, "unseen_blobs")
    run = f"{ledger.rstrip('/')}/version={version}/run={uuid.uuid4().hex}"
    slot = F.shiftrightunsigned(F.xxhash64("path"), 64 - V.ID_BITS)
    scanned = (texts.select("blob", "text", slot.alias("slot"))
               .mapInArrow(_scan_pass(rules, V.id_bitmap(unseen.select("path"))), FOUND))
    (scanned.join(unseen.select("blob"), "blob", "left_semi").groupBy("blob").agg(F.first("findings").alias("findings"))
     .write.parquet(run))
    return spark.read.parquet(run).select("blob", "findings")


def span_text(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")


def secrets(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, findings) of every row of ``docs``, through the ledger.

    A null text is the empty blob. Rows with null ids and repeated rows are all
    returned; other columns are ignored; an empty table scans nothing. A span's
    positions are code points, its end exclusive.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    update_ledger(docs, ledger, rules)
    known = materialize(read_ledger(docs.sparkSession, ledger, rule_version(rules)), "known_blobs")     # a plain table: the join can split a hot blob
    return docs.select("doc_id", blob_address(F.col("text")).alias("blob")).join(known, "blob", "left").select("doc_id", "blob", "findings")


def secret_report(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) from ``secrets``."""
    kinds = [r.kind for r in BASE_RULES]
    of = lambda *some: F.filter("findings", lambda x: x.kind.isin(*some))
    base = of(*kinds)
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("findings")).alias("spans"))
