"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. A
ledger table holds one row for each (blob, rule version) that was scanned, with
its spans; only pairs that it lacks are scanned, each content once however many
paths hold it, and findings join back to all paths. Digests alone tell what is
unseen; texts are fetched for that only. A row is the proof of the scan and its
result at once, so a run that dies between two writes leaves nothing half done.
The ledger has a folder for each rule version, so a run reads its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import new_folder, staged
from .spans import SPAN, digest_columns, matches, span

LEDGER = f"blob string, rule_version string, spans array<{SPAN}>"
SALTS = 64
#: Unseen blobs up to which their digests are broadcast (about 100 bytes each).
MOST_BROADCAST = 500_000


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and which of the matches count."""

    kind: str
    pattern: str
    holds: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class RuleSet:
    """Rules in their order; another version name makes the ledger scan every blob again."""

    version: str
    rules: tuple[Rule, ...]


ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE_KINDS = ("assign", "access", "hex")
RULES = RuleSet(
    "2",
    (
        Rule("assign", ASSIGN, lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 1)) >= 6),
        Rule("access", "AKIA[A-Z0-9]{16,}"),
        Rule("hex", "[0-9a-f]{24,}"),
        Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
        Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    ),
)


def secret_spans(text: Column, rules: RuleSet = RULES) -> Column:
    """Sorted array of the rules' spans in a text."""

    def of(place: int, rule: Rule) -> Column:
        hits = matches(text, rule.pattern)
        if rule.holds is not None:
            hits = F.filter(hits, lambda m: rule.holds(m["hit"]))
        return F.transform(hits, lambda m: span(place, rule.kind, m["start"], m["end"]))

    return F.array_sort(F.concat(*[of(place, rule) for place, rule in enumerate(rules.rules)]))


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table at path, made empty where there is none."""
    _append(spark.createDataFrame([], LEDGER), path, "ignore")
    return spark.read.schema(LEDGER).parquet(path).select("blob", "rule_version", "spans")


def _append(rows: DataFrame, path: str, mode: str = "append") -> None:
    rows.write.mode(mode).partitionBy("rule_version").parquet(path)


def compact_ledger(spark: SparkSession, path: str, target: str, *, files: int = 64) -> None:
    """Writes the ledger at path anew to target, an unused path: each pair once, in at most `files` files for each rule version.

    Many small runs leave many small files, and runs at the same time equal
    rows. The ledger at path stays as it is; an empty one gives an empty one.
    """
    pairs = open_ledger(spark, path).groupBy("blob", "rule_version").agg(F.first("spans").alias("spans"))
    open_ledger(spark, target)
    _append(pairs.repartition(files, "blob"), target)


def _unseen_contents(versions: DataFrame, blob: Column, text: Column, blobs: DataFrame, most_broadcast: int) -> DataFrame | None:
    """The distinct (blob, text) of versions whose blob isn't known in blobs (blob, known); None where all are."""
    contents = versions.select(blob.alias("blob"), text.alias("text"))
    unseen = blobs.filter("NOT known").select("blob")
    counts = blobs.agg(F.count_if("known").alias("known"), F.count_if(~F.col("known")).alias("unseen")).first()
    if not counts["unseen"]:
        return None
    if not counts["known"]:
        return contents.distinct()
    if counts["unseen"] <= most_broadcast:
        return contents.join(F.broadcast(unseen), "blob", "left_semi").distinct()  # texts of known blobs are in no shuffle
    return contents.distinct().join(unseen, "blob", "left_semi")  # equal texts merge in map tasks first: no hot blob


def scan_versions(versions: DataFrame, ledger_path: str, path_col: str = "path", text_col: str = "text", *, rules: RuleSet = RULES, salts: int = SALTS, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Scans what the ledger lacks, appends it, and returns one row for each version: path, blob, spans.

    versions has a row for every historical version of a path. Null text is
    the empty blob. Repeated rows give repeated results; null paths are kept;
    an empty table gives no rows and leaves the ledger as it was. Spans are
    sorted by start and rule. Other columns play no part. A content that is
    unseen reaches its scan once for each task that reads it, and is scanned
    once; one that is known is only digested.
    """
    spark = versions.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    blob = F.sha2(text, 256)
    salt = F.pmod(F.xxhash64(F.col(path_col)), F.lit(salts)).cast("int")
    addressed = staged(versions.select(F.col(path_col).alias("path"), blob.alias("blob"), salt.alias("salt")), "blob-paths")
    scanned = open_ledger(spark, ledger_path).filter(F.col("rule_version") == rules.version).select("blob").distinct().withColumn("known", F.lit(True))
    blobs = addressed.select("blob").distinct().join(scanned, "blob", "left").select("blob", F.coalesce("known", F.lit(False)).alias("known"))
    contents = _unseen_contents(versions, blob, text, staged(blobs, "blobs"), most_broadcast)
    if contents is not None:
        _append(contents.select("blob", F.lit(rules.version).alias("rule_version"), secret_spans(F.col("text"), rules).alias("spans")), ledger_path)

    # Two runs at once may have scanned the same pair; their rows are alike.
    found = open_ledger(spark, ledger_path).filter((F.col("rule_version") == rules.version) & (F.size("spans") > 0)).groupBy("blob").agg(F.first("spans").alias("spans"))
    spread = addressed.select("blob", "salt").distinct().join(found, "blob")  # at most `salts` rows for a blob
    out = addressed.join(spread, ["blob", "salt"], "left")
    return out.select(F.col("path").alias(path_col), "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, ledger_path: str | None = None) -> DataFrame:
    """One row for each document: id, n_assign, n_access, n_hex, base_sha256, spans, blob.

    Without ledger_path, a new ledger in the shared folder is used.
    """
    ledger_path = ledger_path or new_folder(docs.sparkSession, "secret-ledger")
    out = scan_versions(docs, ledger_path, id_col, text_col)
    return out.select(id_col, *digest_columns(F.col("spans"), BASE_KINDS), "blob")


def _sql_matches(kind: str, place: int, pattern: str, holds: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
found_{kind} AS (SELECT k, doc_id, '{kind}' AS kind, {place} AS place, hits[i] AS hit,
    CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i
        FROM (SELECT k, doc_id, string_split_regex(text, '{quoted}') AS gaps, regexp_extract_all(text, '{quoted}') AS hits FROM d))),
good_{kind} AS (SELECT k, kind, place, s, s + length(hit) AS e FROM found_{kind} WHERE {holds})"""


def op3_sql() -> str:
    """DuckDB SQL for `scan_documents` (each base pattern as it stands, failing matches dropped)."""
    quoted = ASSIGN.replace("'", "''")
    parts = [
        _sql_matches("assign", 0, ASSIGN, f"length(regexp_extract(hit, '{quoted}', 1)) >= 6"),
        _sql_matches("access", 1, "AKIA[A-Z0-9]+", "length(hit) >= 20"),
        _sql_matches("hex", 2, "[0-9a-f]+", "length(hit) >= 24"),
        _sql_matches("pem", 3, RULES.rules[3].pattern, "true"),
        _sql_matches("jwt", 4, RULES.rules[4].pattern, "true"),
    ]
    joined = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),{",".join(parts)},
every AS (SELECT * FROM good_assign UNION ALL SELECT * FROM good_access UNION ALL SELECT * FROM good_hex UNION ALL SELECT * FROM good_pem UNION ALL SELECT * FROM good_jwt),
per AS (SELECT k, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
               {joined} FILTER (place < 3) AS base, {joined} AS spans FROM every GROUP BY k)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(text) AS blob
FROM d LEFT JOIN per USING (k)"""
