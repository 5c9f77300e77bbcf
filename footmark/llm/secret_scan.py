"""Secret scan over an incremental blob ledger.

Every historical version of a document is content-addressed (sha-256 of its text). The ledger, a
parquet table, has one row for each blob and rule version that was scanned, with what was found
(also if nothing was). A run scans only the blobs that the ledger lacks under the current rule
version, appends them, and joins the findings back to all paths of a blob.

Plan: hash all texts (JVM); smallest row of each blob (partial aggregation takes hot copies);
anti join with the ledger; fetch the texts of the unseen blobs only; scan them in Arrow batches;
append; join by blob. The last join has the narrow path table as its stream side, which adaptive
execution splits when one blob has very many paths.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footmark.llm.common import cut, new_path, prepare, quoted, texts_of, unused

#: The base rules, in the order of the kinds (pattern, group whose length counts, least length).
BASE_RULES = (
    ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # [0-9a-f]+ of 24 and more: a run is matched whole or not at all, so the length can be in the pattern
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
#: Further rules of this operator (listed after the base kinds).
MORE_RULES = (
    ("pem", re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"), 0, 1),
    ("jwt", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 1),
    ("github", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}"), 0, 1),
)
KINDS = [r[0] for r in BASE_RULES + MORE_RULES]
#: The ledger's key besides the blob: changes with any rule.
RULES_VERSION = hashlib.sha256("\n".join(f"{k} {p.pattern} {p.flags} {g} {n}" for k, p, g, n in BASE_RULES + MORE_RULES)
                               .encode()).hexdigest()[:16]

_SPAN = "struct<kind:string,start:long,end:long>"
LEDGER_SCHEMA = f"blob string, rules string, spans array<{_SPAN}>"


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed; code points, end exclusive."""
    found = []
    for order, (kind, pattern, group, least) in enumerate(BASE_RULES + MORE_RULES):
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def _scan_batches(batches):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t)] for t in texts_of(batch.column(1))]
        yield pa.record_batch([batch.column(0), pa.array(spans, kind)], names=["blob", "spans"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ledger: str | None = None,
         rules: str = RULES_VERSION) -> DataFrame:
    """One row per input row: doc_id, blob, spans (array of kind, start, end).

    ``ledger`` is the folder of the ledger table (a new one below the checkpoint folder if not
    given); a second run over the same blobs and rules scans nothing. Null texts read as empty;
    repeated rows, several versions of one id and null ids each keep their own row; ties (equal
    texts) share one blob; an empty table gives no rows; other columns aren't read."""
    spark = docs.sparkSession
    prepare(spark)
    ledger = ledger or new_path(spark, "ledger")
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").parquet(ledger)
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    blob = F.sha2(F.col("text").cast("binary"), 256).alias("blob")
    paths = cut(src.select("doc_id", blob, F.xxhash64("doc_id").alias("at")), "paths")
    seen = spark.read.schema(LEDGER_SCHEMA).parquet(ledger).filter(F.col("rules") == rules).select("blob")
    todo = cut(paths.groupBy("blob").agg(F.min("at").alias("at")).join(seen, "blob", "left_anti"), "unseen")
    # One text of each unseen blob: repeated rows are dropped where the join has put them, so that
    # texts move once.
    unseen = src.select(blob, F.xxhash64("doc_id").alias("at"), "text").join(todo.hint("merge"), ["blob", "at"], "left_semi") \
        .groupBy("blob", "at").agg(F.first("text").alias("text")).select("blob", "text")
    unseen.mapInArrow(_scan_batches, f"blob string, spans array<{_SPAN}>") \
        .select("blob", F.lit(rules).alias("rules"), "spans").write.mode("append").parquet(ledger)
    known = spark.read.schema(LEDGER_SCHEMA).parquet(ledger).filter(F.col("rules") == rules) \
        .dropDuplicates(["blob"])
    found = cut(known.filter(F.size("spans") > 0).select("blob", "spans"), "findings")
    return paths.select("doc_id", "blob").join(found, "blob", "left") \
        .select("doc_id", "blob", F.coalesce("spans", F.array().cast(f"array<{_SPAN}>")).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans as text, from :func:`scan`'s rows."""
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    line = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line("spans").alias("spans"))


def masked(text: str, spans) -> str:
    parts, at = [], 0
    for s in spans:
        if s["end"] <= at:
            continue
        if s["start"] >= at:
            parts += [text[at:s["start"]], "[SECRET]"]
        at = s["end"]
    return "".join([*parts, text[at:]])


def _mask_column(text: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array([None if s is None else masked(t, s) for t, s in zip(text.to_pylist(), spans.to_pylist())], pa.string())


def mask(docs: DataFrame, text_col: str = "text", ledger: str | None = None) -> DataFrame:
    """``docs`` with every found span replaced by ``[SECRET]``; other rows and columns unchanged.

    Findings of the ledger are joined to the rows by blob, once; only texts with findings go to the
    masking function. Null and empty texts stay as they are; repeated rows and texts that several rows
    share (ties) are masked in each row; long texts are masked whole; columns of any name are kept;
    an empty table gives no rows."""
    taken = docs.columns
    text = F.col(quoted(text_col)).cast("string")
    blob = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
    found = scan(docs.select(F.lit(None).cast("long").alias("doc_id"), text.alias("text")), ledger=ledger)
    dirty = cut(found.filter(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"]), "dirty")
    key, spans = unused("blob", taken), unused("spans", taken)
    dirty = dirty.select(F.col("blob").alias(key), F.col("spans").alias(spans))
    out = docs.withColumn(key, blob).join(dirty, key, "left")
    clean = F.arrow_udf(_mask_column, "string")
    new = F.coalesce(clean(F.when(F.col(spans).isNotNull(), text), F.col(spans)), F.col(quoted(text_col)))
    return out.select(*[new.alias(c) if c == text_col else F.col(quoted(c)) for c in taken])
