"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its bytes. Only pairs of blob and rule
version that the ledger does not hold are scanned, each blob once; the findings are joined back to all
paths that carry the blob.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.common import fresh, per_batch, text_bytes
from tidewright.session import cut_lineage
from tidewright.sources.tables import BATCH, read_table

# The base rules.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
KINDS = ("assign", "access", "hex")

SPAN = "array<struct<kind:string,start:long,end:long>>"
LEDGER = f"blob string, rules string, spans {SPAN}"


@dataclass(frozen=True)
class Rules:
    """Patterns with the shortest value they report; ``extra`` adds (kind, pattern) rules to the base."""

    extra: tuple[tuple[str, str], ...] = ()

    @property
    def version(self) -> str:
        said = repr((ASSIGN, ACCESS, HEX, ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH, self.extra))
        return hashlib.sha256(said.encode()).hexdigest()[:16]


def scan(text: str, rules: Rules = Rules()) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then in the order of the kinds.

    A match runs as far as its pattern does; one that is too short is dropped with all it covers.
    """
    found = []
    if ":" in text or "=" in text:
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LENGTH:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    for n, (_, pattern) in enumerate(rules.extra):
        found += [(m.start(), 3 + n, m.end()) for m in re.finditer(pattern, text) if m.end() > m.start()]
    names = KINDS + tuple(kind for kind, _ in rules.extra)
    return [(names[k], s, e) for s, k, e in sorted(found)]


_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
# A maximal run of hex digits is at least this long or not reported: the same as HEX with the short ones dropped.
_LONG_HEX = re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{HEX_LENGTH},}}")


def scan_blobs(blobs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Ledger rows for (blob, raw), one text each."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = []
        for raw in batch.column(1):
            text = raw.as_buffer().to_pybytes().decode("utf-8", "replace")
            spans.append([{"kind": k, "start": s, "end": e} for k, s, e in scan(text, rules)])
        version = pa.array([rules.version] * batch.num_rows, pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), version, pa.array(spans, kind)], names=["blob", "rules", "spans"])

    return blobs.select("blob", "raw").mapInArrow(per_batch(work), LEDGER)


def addressed(docs: DataFrame, path: str, text: str) -> DataFrame:
    """(path, blob, raw): every version with its content address; a null text is the empty blob."""
    raw = text_bytes(text)
    return docs.select(F.col(path).alias("path"), F.sha2(raw, 256).alias("blob"), raw.alias("raw"))


def _ledger_rows(rows: DataFrame, rules: Rules, ledger: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(all ledger rows of this rule version, those new among them) for addressed rows; only unseen blobs are scanned, each once."""
    unseen = rows.select("blob", "raw")
    if ledger is None:
        new = cut_lineage(scan_blobs(unseen.dropDuplicates(["blob"]), rules))
        return new, new
    known = ledger.where(F.col("rules") == rules.version).select("blob", "rules", "spans").dropDuplicates(["blob"])
    new = cut_lineage(scan_blobs(unseen.join(known.select("blob"), "blob", "left_anti").dropDuplicates(["blob"]), rules))
    return new.unionByName(known), new


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All ledger rows recorded below ``folder``; empty before the first run."""
    return read_table(spark, folder, spark.createDataFrame([], LEDGER).schema)


def record(new: DataFrame, folder: str, batch_id: str) -> None:
    """Add new ledger rows as a batch; a retry under the same id replaces what the first attempt left. Blobs that two runs
    recorded side by side count once when they are read for a scan."""
    new.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")


def scan_versions(
    docs: DataFrame, path: str = "doc_id", text: str = "text", rules: Rules = Rules(), ledger: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(findings, new ledger rows).

    Findings: one row per row of ``docs`` with ``path``, ``blob`` and ``spans``. The new rows are
    already on shared storage; add them to the ledger after use. Repeated blobs are combined before and
    in the shuffle, so a text that fills a third of the table is scanned once; blobs without a finding
    stay in the ledger too, so they are not scanned again. Null texts are the empty blob, null and
    repeated paths keep their rows, an empty table gives empty results, other columns are not read.
    """
    rows = addressed(docs, path, text)
    full, new = _ledger_rows(rows, rules, ledger)
    # Only blobs with findings meet the paths; the others have none.
    hits = full.where(F.size("spans") > 0).select("blob", "spans")
    findings = rows.drop("raw").join(hits, "blob", "left").select(
        F.col("path").alias(path), "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans")
    )
    return findings, new


def mask(
    docs: DataFrame, by: str, path: str = "doc_id", text: str = "text", length: str = "n_chars", rules: Rules = Rules(),
    ledger: DataFrame | None = None,
) -> DataFrame:
    """All documents with their secrets replaced by ``by`` (overlapping spans by one), and the length
    column set anew where the text changed. Null texts stay null, repeated rows stay, an empty table stays empty.

    The spans come from the ledger scan; only blobs with findings meet the documents again. Blobs that ``ledger`` holds
    under this rule version are not scanned; to record the others, scan with `scan_versions` first.
    """
    full, _ = _ledger_rows(addressed(docs, path, text), rules, ledger)
    hits = full.where(F.size("spans") > 0).select(
        F.col("blob").alias(fresh(docs, "_blob")), F.col("spans").alias(fresh(docs, "_spans"))
    )
    blob, spans = hits.columns

    def step(done, span):
        s, e = span["start"].cast("int"), span["end"].cast("int")
        given = F.concat(done["out"], F.substring(F.col(text), done["at"] + 1, s - done["at"]), F.lit(by))
        return F.struct(
            F.when(s >= done["at"], given).otherwise(done["out"]).alias("out"), F.greatest(done["at"], e).alias("at")
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    rest = lambda done: F.concat(done["out"], F.substring(F.col(text), done["at"] + 1, F.length(text)))
    joined = docs.join(hits, F.sha2(text_bytes(text), 256) == F.col(blob), "left")
    changed = F.when(F.col(spans).isNotNull(), F.aggregate(spans, start, step, rest)).otherwise(F.col(text))
    out = joined.withColumn(text, changed)
    if length in docs.columns:
        kind = docs.schema[length].dataType
        out = out.withColumn(length, F.when(F.col(spans).isNotNull(), F.length(text).cast(kind)).otherwise(F.col(length)))
    return out.select(*docs.columns)
