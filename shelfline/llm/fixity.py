"""Merkle fixity audit of archived web records and their replica.

Records lie in files of a fixed number of records, each with its offset and length. Leaves hash
records; an inner node hashes its children's digests together with their ordered offset ranges.
The audit compares the roots of both copies and goes down only where digests differ, so what is
compared grows with the damage. All of it is DataFrame code over digests: a record's bytes are read
once, for its leaf, and never shuffled.

Cases: null url or html counts as empty; a null page_id sorts first; repeated pages are separate
records; an empty table has no files and no findings. A record missing on one side is reported as
`missing` (from the replica) or `extra`, one with other bytes as `corrupt`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfline.llm.texts import table
from shelfline.session import cut_lineage

FANOUT = 16
LEVELS = 3
FILE_RECORDS = FANOUT**LEVELS
CRLF = "\r\n"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A page as a WARC resource record."""
    body = F.coalesce(html, F.lit(""))
    head = [
        F.lit(f"WARC/1.0{CRLF}WARC-Type: resource{CRLF}WARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(f">{CRLF}WARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit(f"{CRLF}Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(CRLF * 2),
    ]
    return F.concat(*head, body, F.lit(CRLF * 2))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with `position`, their place in the whole order, without one task seeing them all: sorted
    ranges are numbered in themselves and shifted by the sizes of the ranges before."""
    tie = "_tie"
    tagged = rows.withColumn(tie, F.monotonically_increasing_id())  # spreads equal rows over ranges
    ranges = tagged.repartitionByRange(*order, tie).sortWithinPartitions(*order, tie)
    stored = cut_lineage(ranges.drop(tie).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = {r["part"]: r["n"] for r in stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # one row per range
    if not sizes:
        return stored.withColumn("position", F.col("_at")).drop("_at")
    before, starts = 0, []
    for p in sorted(sizes):
        starts += [F.lit(p).cast("bigint"), F.lit(before).cast("bigint")]
        before += sizes[p]
    place = F.element_at(F.create_map(*starts), part.cast("bigint")) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.withColumn("position", place).drop("_at")


def manifest(records: DataFrame) -> DataFrame:
    """Adds file_id, seq and rec_offset to (position, rec_length, ...). A file has FILE_RECORDS records
    at most, whatever the keys, so the running sum below works on bounded groups."""
    placed = records.withColumns(
        {"file_id": F.floor(F.col("position") / FILE_RECORDS).cast("bigint"), "seq": (F.col("position") % FILE_RECORDS).cast("int")}
    ).drop("position")
    before = Window.partitionBy("file_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("rec_offset", F.coalesce(F.sum("rec_length").over(before), F.lit(0)).cast("bigint"))


def tree(leaves: DataFrame) -> DataFrame:
    """All nodes (file_id, level, node, first, last, digest) over leaves (file_id, seq, rec_offset,
    rec_length, digest). One shuffle, by file: every level groups within it, in lists of FANOUT."""
    level = leaves.repartition("file_id").select(
        "file_id",
        F.lit(0).alias("level"),
        F.col("seq").alias("node"),
        F.col("rec_offset").alias("first"),
        (F.col("rec_offset") + F.col("rec_length")).alias("last"),
        "digest",
    )
    levels = [level]
    for depth in range(1, LEVELS + 1):
        children = F.array_sort(F.collect_list(F.struct("node", "first", "last", "digest")))
        text = F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["first"].cast("string"), c["last"].cast("string"), c["digest"])), "\n")
        level = (
            level.groupBy("file_id", F.floor(F.col("node") / FANOUT).cast("int").alias("node"))
            .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sha2(text, 256).alias("digest"))
            .select("file_id", F.lit(depth).alias("level"), "node", "first", "last", "digest")
        )
        levels.append(level)
    return cut_lineage(reduce(DataFrame.unionByName, levels))


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Leaves that differ: file_id, seq, status, digests of both. Arguments are node tables of `tree`."""
    suspects = None
    for depth in range(LEVELS, -1, -1):
        sides = [side.where(F.col("level") == depth).select("file_id", "node", F.struct("first", "last", "digest").alias(name)) for side, name in ((primary, "p"), (replica, "r"))]
        if suspects is not None:
            sides = [s.join(suspects, (s["file_id"] == suspects["in_file"]) & (F.floor(s["node"] / FANOUT) == suspects["parent"]), "left_semi") for s in sides]
        differing = sides[0].join(sides[1], ["file_id", "node"], "full_outer").where(~F.col("p").eqNullSafe(F.col("r")))
        suspects = differing.select(F.col("file_id").alias("in_file"), F.col("node").alias("parent"))
    status = F.when(F.col("r").isNull(), "missing").when(F.col("p").isNull(), "extra").otherwise("corrupt")
    return differing.select("file_id", F.col("node").alias("seq"), status.alias("status"), F.col("p.digest").alias("primary_sha256"), F.col("r.digest").alias("replica_sha256"))


def op2_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as an archive, audited against a replica that lost some records and had the first
    character of others overwritten, both by page_id over the whole table."""
    html = F.coalesce(F.col("html"), F.lit(""))
    damaged = F.when(F.col("page_id") % 97 == 5, F.concat(F.lit("§"), F.substring(html, 2, 2**31 - 1))).otherwise(html)
    whole = record(F.col("page_id"), F.col("url"), html)
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.coalesce("url", F.lit("")).alias("url"),
        F.sha2(whole, 256).alias("digest"),
        F.sha2(record(F.col("page_id"), F.col("url"), damaged), 256).alias("copy"),
        F.octet_length(whole).cast("bigint").alias("rec_length"),
        F.coalesce(F.col("page_id") % 389 == 11, F.lit(False)).alias("lost"),
    )
    records = cut_lineage(manifest(numbered(pages, ["page_id", "url", "digest"])))
    primary = tree(records)
    replica = tree(records.where(~F.col("lost")).withColumn("digest", F.col("copy")))
    found = audit(primary, replica)
    return found.join(records.select("file_id", "seq", "page_id", "rec_offset", "rec_length"), ["file_id", "seq"])


OP2_SQL = f"""
WITH cleaned AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
), copies AS (
  SELECT *, CASE WHEN page_id % 97 = 5 THEN '§' || substr(html, 2) ELSE html END AS damaged FROM cleaned
), heads AS (
  SELECT *, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
    || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
    || 'Content-Length: ' AS head, chr(13) || chr(10) || chr(13) || chr(10) AS gap FROM copies
), written AS (
  SELECT page_id, url, head || CAST(strlen(html) AS VARCHAR) || gap || html || gap AS record,
    head || CAST(strlen(damaged) AS VARCHAR) || gap || damaged || gap AS copy FROM heads
), ordered AS (
  SELECT *, sha256(record) AS digest, sha256(copy) AS copy_digest, strlen(record) AS rec_length,
    row_number() OVER (ORDER BY page_id NULLS FIRST, url, sha256(record)) - 1 AS place FROM written
), placed AS (
  SELECT *, place // {FILE_RECORDS} AS file_id, CAST(place % {FILE_RECORDS} AS INTEGER) AS seq,
    CAST(coalesce(sum(rec_length) OVER (PARTITION BY place // {FILE_RECORDS} ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rec_offset
  FROM ordered
)
SELECT file_id, seq, CASE WHEN page_id % 389 = 11 THEN 'missing' ELSE 'corrupt' END AS status, digest AS primary_sha256,
  CASE WHEN page_id % 389 = 11 THEN NULL ELSE copy_digest END AS replica_sha256, page_id, rec_offset, rec_length
FROM placed WHERE page_id % 389 = 11 OR digest <> copy_digest
"""
