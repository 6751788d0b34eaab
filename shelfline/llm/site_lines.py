"""Cross-site boilerplate lines: HyperLogLog sketches of the sites of every line, merged by
aggregation; lines near the threshold get an exact distinct count before anything is removed.

A line is compared without outer white space; blank lines never count. Its sites are the different
values of `source` (null is a site of its own). A line of at least `min_sites` sites is boilerplate.

It is removed from every document that also holds a line of its own; a document of nothing but
boilerplate is a true copy and stays whole for the near-duplicate stage. Lines of a few words recur by
chance and need MIN_SITES sites; a line of LONG_WORDS words or more needs LONG_SITES sites.

`without_boilerplate`, the pipeline's stage, asks more of long lines: they must lie in LONG_SITES
documents that are not near copies of each other. Else every copy of a page would lose its text
there, before the near-duplicate stage keeps one of them. `spread_lines`, the registered query, has no
near-duplicate stage behind it and does without.

Cases: null text stays null with no lines; an empty table gives an empty result; rows with the same
doc_id and text are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.minhash import Plan, near_duplicates
from shelfline.llm.texts import fresh_name, table
from shelfline.session import cut_lineage

MIN_SITES = 10
LONG_WORDS = 8
LONG_SITES = 3
SKETCH_BITS = 10  # 1,024 registers: relative error 1.04 / sqrt(1024), about 3.3 %
MARGIN = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)  # four standard errors
BLANK = " \t\n\x0b\f\r"


def keys(line: Column) -> Column:
    """128 bits that stand for the line."""
    trimmed = F.btrim(line, F.lit(BLANK))
    return F.struct(F.xxhash64(trimmed).alias("a"), F.xxhash64(F.lit("second"), trimmed).alias("b"))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, site, place, line key and words of every non-blank line."""
    parts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("site"), F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    parts = parts.where(F.btrim("line", F.lit(BLANK)) != "")
    words = F.size(F.split(F.btrim("line", F.lit(BLANK)), r"[\x20\x09-\x0D]+"))
    return parts.select("doc_id", "text_key", "site", "place", keys(F.col("line")).alias("key"), words.alias("words"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, long_sites: int | None = None) -> DataFrame:
    """Keys and words of lines on at least min_sites sites, or long_sites for long lines. The sketch of a
    line has a bounded size, so a line that is everywhere costs no more than any other, and partial
    sketches merge before the shuffle."""
    spread = lines.groupBy("key").agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"), F.first("words").alias("words"))
    least = F.when(F.col("words") >= LONG_WORDS, min_sites if long_sites is None else long_sites).otherwise(min_sites)
    spread = spread.select("key", "words", F.hll_sketch_estimate("sketch").alias("sites"), least.alias("least"))
    low, high = F.col("least") * (1 - MARGIN) - 1, F.col("least") * (1 + MARGIN) + 1
    seen = cut_lineage(spread.where(F.col("sites") >= low))
    near = seen.where(F.col("sites") <= high).select("key")
    exact = lines.join(near, "key", "left_semi").select("key", "site").distinct().groupBy("key").count()
    exact = seen.join(exact, "key").where(F.col("count") >= F.col("least"))
    return seen.where(F.col("sites") > high).select("key", "words").unionByName(exact.select("key", "words"))


def in_different_documents(lines: DataFrame, found: DataFrame, docs: DataFrame, least: int) -> DataFrame:
    """Those keys of found whose lines lie in at least `least` groups of near copies, a document without
    copies being a group of its own. Only documents that hold such a line are compared."""
    hits = cut_lineage(lines.join(found, "key", "left_semi").select("key", F.col("doc_id").cast("bigint").alias("doc_id"), "text_key").distinct(), ids=True)
    groups = near_duplicates(docs, Plan(), hits.select("doc_id", "text_key").distinct()).select("doc_id", "text_key", "component_id").distinct()
    # A document without an id is in no group; its text stands for it.
    placed = hits.join(groups, ["doc_id", "text_key"], "left")
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("text_key")))
    different = placed.select("key", group.alias("group")).distinct().groupBy("key").count().where(F.col("count") >= least)
    return found.join(different, "key", "left_semi")


def spread_lines(docs: DataFrame, min_sites: int = MIN_SITES, long_sites: int = LONG_SITES) -> DataFrame:
    """docs with n_lines, n_removed and text without boilerplate, as OP3_SQL has it."""
    lines = lines_of(docs)
    return _without(docs, lines, boilerplate(lines, min_sites, long_sites))


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, long_sites: int = LONG_SITES) -> DataFrame:
    """The same, where long lines must also lie in documents that are not near copies."""
    lines = lines_of(docs)
    wide = cut_lineage(boilerplate(lines, min_sites, long_sites), ids=True)
    long = in_different_documents(lines, wide.where(F.col("words") >= LONG_WORDS), docs, long_sites)
    wide = wide.where(F.col("words") < LONG_WORDS).unionByName(long)
    return _without(docs, lines, wide)


def _without(docs: DataFrame, lines: DataFrame, wide: DataFrame) -> DataFrame:
    """docs with n_lines, n_removed and text without the lines in wide, where a document holds others too;
    all other columns as they were.

    Only keys and places of lines are shuffled before the one join that brings the places to remove
    back to their documents."""
    names = {n: fresh_name(docs, f"_{n}") for n in ("text_key", "places", "id", "key", "hits")}
    hits = lines.join(wide, "key", "left_semi")
    removed = hits.groupBy(F.col("doc_id").alias(names["id"]), F.col("text_key").alias(names["key"])).agg(F.collect_set("place").alias(names["hits"]))
    rows = docs.withColumn(names["text_key"], F.xxhash64("text"))
    joined = rows.join(removed, rows["doc_id"].eqNullSafe(removed[names["id"]]) & (rows[names["text_key"]] == removed[names["key"]]), "left")
    text_lines = F.split("text", "\n", -1)
    n_lines = F.size(F.filter(text_lines, lambda line: F.btrim(line, F.lit(BLANK)) != ""))
    hits = F.col(names["hits"])
    kept = F.array_join(F.filter(text_lines, lambda line, i: ~F.array_contains(F.col(names["places"]), i)), "\n")
    joined = joined.withColumn(names["places"], F.when(F.size(hits) < n_lines, hits))
    text = F.when(F.col(names["places"]).isNotNull(), kept).otherwise(F.col("text"))
    others = [c for c in docs.columns if c != "text"]
    out = joined.select(*others, text.alias("text"), F.coalesce(F.when(F.col("text").isNotNull(), n_lines), F.lit(0)).alias(fresh_name(docs, "n_lines")), F.coalesce(F.size(names["places"]), F.lit(0)).alias(fresh_name(docs, "n_removed")))
    return out


def op3_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread_lines(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    removed = F.when(F.col("n_removed") < 0, 0).otherwise(F.col("n_removed"))
    return rows.select("doc_id", F.col("n_lines").cast("bigint").alias("n_lines"), removed.cast("bigint").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP3_SQL = f"""
WITH ws AS (SELECT chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS blank),
whole AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce('s' || source, '') AS site, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), cells AS (
  SELECT doc_id, text, site, unnest(parts) AS line, unnest(generate_series(1, len(parts))) AS place FROM whole
), lines AS (
  SELECT doc_id, text, site, place, line, trim(line, blank) AS bare FROM cells, ws
), filled AS (
  SELECT *, len(regexp_split_to_array(bare, '[\\x20\\x09-\\x0D]+')) AS words FROM lines WHERE bare <> ''
), wide AS (
  SELECT bare FROM filled GROUP BY bare HAVING count(DISTINCT site) >= CASE WHEN any_value(words) >= {LONG_WORDS} THEN {LONG_SITES} ELSE {MIN_SITES} END
), marked AS (
  SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN bare IN (SELECT bare FROM wide) THEN 1 ELSE 0 END) AS hits FROM filled GROUP BY doc_id
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.place) AS text FROM lines l LEFT JOIN marked m USING (doc_id)
  WHERE NOT (coalesce(m.hits, 0) > 0 AND m.hits < m.n_lines AND l.bare IN (SELECT bare FROM wide)) GROUP BY l.doc_id
)
SELECT w.doc_id, CAST(coalesce(m.n_lines, 0) AS BIGINT) AS n_lines,
  CAST(CASE WHEN m.hits < m.n_lines THEN m.hits ELSE 0 END AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS text_sha256
FROM whole w LEFT JOIN marked m USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
