"""Near-duplicates by b-bit MinHash.

Minima of a document's shingle hashes give band keys, which make candidates, and their low bits,
packed into a short signature. Equal low bits, corrected for chance collisions, estimate the
similarity of candidates; what may reach the threshold is confirmed on the full shingle sets.

Equal sets become one class first. In every band bucket the smallest document is compared with the
others; most groups are one component after that. In buckets that still hold several components,
the documents outside their first document's component are compared with the rest, in blocks of
bounded size and inside the tasks, which return links and never pairs. So no link is lost by a large
bucket, and a group of copies costs one comparison each.

Cases: null or empty text has an empty set and is linked with nothing, not even with its like; a
null doc_id is linked with nothing and kept; rows with the same doc_id are one document; extra
columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.components import components
from shelfline.llm.shingles import shingle_set, similar
from shelfline.llm.texts import fresh_name, groups, handing_back, map_texts, may_be_among, table
from shelfline.session import cut_lineage

ROWS = 4  # minima per band
BITS = 4  # low bits kept of each minimum
PER_LONG = 64 // BITS
MISSED = 1e-5  # accepted chance that a pair at the threshold shares no band
DEVIATIONS = 5.5  # how far below the threshold an estimate may lie
STAR_PART = 64  # members compared with one copy of their bucket's first document
BLOCK_SHINGLES = 500_000  # shingles of a block that a task holds at once (one document may be longer)


class Plan:
    """Numbers of bands and minima for a similarity of `percent` hundredths on `words` words."""

    def __init__(self, words: int = 5, percent: int = 80):
        self.words, self.percent = words, percent
        level = percent / 100
        self.bands = math.ceil(math.log(MISSED) / math.log(1 - level**ROWS))
        self.minima = self.bands * ROWS
        self.longs = math.ceil(self.minima / PER_LONG)
        chance = 2.0**-BITS
        equal = level + (1 - level) * chance
        error = math.sqrt(equal * (1 - equal) / self.minima) / (1 - chance)
        self.least_equal = math.ceil(self.minima * (chance + max(0.0, level - DEVIATIONS * error) * (1 - chance)))
        random = np.random.Generator(np.random.PCG64(20))
        self.factors = random.integers(0, 1 << 63, self.minima, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.masks = random.integers(0, 1 << 63, self.minima, dtype=np.uint64)

    def sketch(self, hashes: np.ndarray) -> tuple[list[int], list[int]]:
        """Band keys and packed low bits of a set that is not empty."""
        lowest = np.full(self.minima, np.iinfo(np.uint64).max)
        for start in range(0, len(hashes), 1 << 16):
            part = hashes[start : start + (1 << 16)]
            for i in range(self.minima):
                lowest[i] = min(lowest[i], ((part ^ self.masks[i]) * self.factors[i]).min())
        keys = [int.from_bytes(hashlib.blake2b(bytes([b]) + lowest[b * ROWS : (b + 1) * ROWS].tobytes(), digest_size=8).digest(), "little", signed=True) for b in range(self.bands)]
        low = np.zeros(self.longs * PER_LONG, np.uint64)
        low[: self.minima] = (lowest >> np.uint64(8)) & np.uint64((1 << BITS) - 1)
        shifts = np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)
        return keys, np.bitwise_or.reduce(low.reshape(-1, PER_LONG) << shifts, axis=1).astype(np.int64).tolist()

    def equal_minima(self, a: Column, b: Column) -> Column:
        """How many minima agree in their low bits: bit counts of the differing groups."""
        differ = F.lit(0)
        for i in range(self.longs):
            x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
            folded = x
            for shift in range(1, BITS):
                folded = folded.bitwiseOR(F.shiftrightunsigned(x, shift))
            differ = differ + F.bit_count(folded.bitwiseAND(F.lit(0x1111111111111111)))
        return F.lit(self.minima) - differ

    def equal_in_block(self, rows: np.ndarray, one: np.ndarray) -> np.ndarray:
        x = rows ^ one
        folded = (x | (x >> np.uint64(1)) | (x >> np.uint64(2)) | (x >> np.uint64(3))) & np.uint64(0x1111111111111111)
        return self.minima - np.bitwise_count(folded).sum(axis=1, dtype=np.int64)


def sketches(docs: DataFrame, plan: Plan) -> DataFrame:
    """doc_id, text_key, size, set key (k1, k2), bands and signature of every row of docs."""

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in ("size", "k1", "k2", "bands", "signature")}
        for text in batch.column("text").to_pylist():
            hashes = shingle_set(text, plan.words)
            digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            keys, signature = plan.sketch(hashes) if len(hashes) else ([], [])
            halves = (int.from_bytes(digest[i : i + 8], "little", signed=True) for i in (0, 8))
            for name, value in zip(out, (len(hashes), *halves, keys, signature)):
                out[name].append(value)
        kinds = {"bands": pa.list_(pa.int64()), "signature": pa.list_(pa.int64())}
        return {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), **{n: pa.array(v, kinds.get(n, pa.int64())) for n, v in out.items()}}

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_texts(
        rows.withColumn("text_key", F.xxhash64("text")),
        work,
        "doc_id bigint, text_key bigint, size bigint, k1 bigint, k2 bigint, bands array<bigint>, signature array<bigint>",
    )


def near_duplicates(docs: DataFrame, plan: Plan, among: DataFrame | None = None) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and kept for every row of docs. With `among`
    (doc_id, text_key), the same for those documents alone, as if the others were not there."""
    if among is not None:
        flag = fresh_name(docs, "_among")
        docs = may_be_among(docs, F.col("doc_id").cast("bigint"), among.select("doc_id"), flag).where(flag)
    seen = sketches(docs, plan)
    seen = cut_lineage(seen if among is None else seen.join(among, ["doc_id", "text_key"], "left_semi"))
    usable = seen.where("size > 0 AND doc_id IS NOT NULL")
    # One row per class of equal sets: its smallest document stands for it.
    first = F.min(F.struct("doc_id", "text_key", "size", "bands", "signature"))
    nodes = cut_lineage(usable.groupBy("k1", "k2").agg(first.alias("c")).select("k1", "k2", F.col("c.doc_id").alias("node"), "c.text_key", "c.size", "c.bands", "c.signature"))
    members = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = members.groupBy("band", "key").agg(F.min("node").alias("first"), F.count("*").alias("rows")).where("rows > 1")
    shared = cut_lineage(members.join(buckets, ["band", "key"]))
    texts = _texts(docs, nodes, shared.select("node").distinct())
    stars = shared.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = cut_lineage(_star_links(_likely(stars, nodes, plan), texts, plan), ids=True)
    joint = components(links)
    more = cut_lineage(_block_links(shared.where("rows > 2"), joint, nodes, texts, plan), ids=True)
    if not more.isEmpty():
        joint = components(links.unionByName(more))
    classes = nodes.select("k1", "k2", "node").join(joint, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component"))
    joined = seen.select("doc_id", "text_key", "size", "k1", "k2").join(classes, ["k1", "k2"], "left")
    component = F.when((F.col("size") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    rows = joined.select("doc_id", "text_key", F.col("size").alias("n_shingles"), component.alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _likely(pairs: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """Pairs whose sizes allow the threshold and whose signatures estimate it, within the error."""
    side = lambda name: nodes.select(F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col("signature").alias(f"signature_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    fits = 100 * F.least("size_a", "size_b") >= plan.percent * F.greatest("size_a", "size_b")
    return both.where(fits & (plan.equal_minima(F.col("signature_a"), F.col("signature_b")) >= plan.least_equal)).select("a", "b")


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the nodes that share a bucket: the only texts that are moved."""
    chosen = cut_lineage(nodes.select("node", "text_key").join(wanted, "node"), ids=True)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    rows = may_be_among(rows, F.col("node"), chosen.select("node"), "flag").where("flag").drop("flag")
    return cut_lineage(rows.join(chosen, ["node", "text_key"]).dropDuplicates(["node", "text_key"]).select("node", "text"))


def _star_links(pairs: DataFrame, texts: DataFrame, plan: Plan) -> DataFrame:
    """Links among pairs (a, b). The members of one `a` are dealt over parts of about STAR_PART, each
    with its own copy of a's text; a task streams them and holds one set at a time."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR_PART).cast("int").alias("parts"))
    dealt = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), F.col("b").alias("node"), F.lit(1).alias("role"))
    heads = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("node"), F.lit(0).alias("role"))
    rows = heads.unionByName(dealt).join(texts, "node").repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def run(batches):
        at, heads = None, []
        for batch in chain.from_iterable(map(groups, batches)):
            found: list[tuple[int, int]] = []
            for a, part, role, node, text in zip(*(batch.column(c).to_pylist() for c in ("a", "part", "role", "node", "text"))):
                if at != (a, part):
                    at, heads = (a, part), []
                hashes = shingle_set(text, plan.words)
                if role == 0:
                    heads.append(hashes)
                elif any(similar(h, hashes, plan.percent) for h in heads):
                    found.append((a, node))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.select("a", "part", "role", "node", "text").mapInArrow(handing_back(run), "a bigint, b bigint").distinct()


def _block_links(shared: DataFrame, joint: DataFrame, nodes: DataFrame, texts: DataFrame, plan: Plan) -> DataFrame:
    """Links that the stars left open, in buckets whose other members form several components.

    Those buckets are found first, from ids and components alone; most inputs have none or few, and only
    their rows go on. Base rows lie in one block each. Rows outside the first document's component, the
    strays, also visit every block of their bucket as queries, so what is repeated grows with the strays only."""
    others = shared.where("node <> first").select("band", "key", "node", "first")
    component = F.coalesce("component", "node")
    told = others.join(joint, "node", "left").groupBy("band", "key").agg(F.min(component).alias("low"), F.max(component).alias("high"))
    unsettled = cut_lineage(told.where("low <> high").select("band", "key"), ids=True)
    if unsettled.isEmpty():
        return joint.select(F.col("node").alias("a"), F.col("component").alias("b")).limit(0)
    rows = others.join(unsettled, ["band", "key"]).join(joint, "node", "left").withColumn("component", component)
    heads = joint.select(F.col("node").alias("first"), F.col("component").alias("main"))
    rows = rows.join(heads, "first", "left").withColumn("stray", F.col("component") != F.coalesce("main", "first"))
    rows = cut_lineage(rows.join(nodes.select("node", "size", "signature", "bands"), "node").drop("first", "main"))
    bucket = rows.groupBy("band", "key").agg(F.ceil(F.sum("size") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    place = lambda block, role: F.struct(block.alias("block"), F.lit(role).alias("role"))
    visits = F.when(F.col("stray"), F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: place(b, 1)))
    own = F.array(place(F.pmod(F.xxhash64("node"), "blocks").cast("int"), 0))
    columns = ["band", "key", "node", "component", "size", "signature", "bands", "stray"]
    dealt = rows.join(bucket, ["band", "key"]).select(*columns, F.inline(F.when(F.col("stray"), F.concat(own, visits)).otherwise(own)))
    dealt = dealt.join(texts, "node").repartition("band", "key", "block").sortWithinPartitions("band", "key", "block", "role", "node")

    def run(batches):
        at, block = None, None
        for batch in chain.from_iterable(map(groups, batches)):
            found: list[tuple[int, int]] = []
            for row in batch.to_pylist():
                if at != (row["band"], row["key"], row["block"]):
                    at, block = (row["band"], row["key"], row["block"]), _Block(row["band"], plan)
                if row["role"] == 0:
                    block.add(row)
                else:
                    found += block.links(row)
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return dealt.select(*columns, "block", "role", "text").mapInArrow(handing_back(run), "a bigint, b bigint").distinct()


class _Block:
    """Base rows of one block; a query is compared with those of other components."""

    def __init__(self, band: int, plan: Plan):
        self.band, self.plan, self.rows, self.sets, self.parent = band, plan, [], {}, {}

    def add(self, row: dict) -> None:
        self.rows.append(row)

    def _root(self, c: int) -> int:
        while (up := self.parent.get(c, c)) != c:
            self.parent[c] = c = self.parent.get(up, up)
        return c

    def _ready(self) -> None:
        if not isinstance(self.rows, list):
            return
        rows = self.rows
        self.texts = [r["text"] for r in rows]
        self.nodes, self.components, self.sizes = (np.array([r[c] for r in rows], np.int64) for c in ("node", "component", "size"))
        self.strays = np.array([r["stray"] for r in rows], bool)
        self.signatures = np.array([r["signature"] for r in rows], np.int64).view(np.uint64).reshape(len(rows), -1)
        self.bands = np.array([r["bands"][: self.band] for r in rows], np.int64).reshape(len(rows), -1)
        self.rows = None

    def links(self, query: dict) -> list[tuple[int, int]]:
        if self.rows == []:
            return []
        self._ready()
        plan = self.plan
        # A pair of strays is met twice and is compared by its larger node; a pair that shares an
        # earlier band is compared there.
        open_ = (self.components != query["component"]) & (~self.strays | (self.nodes < query["node"]))
        open_ &= 100 * np.minimum(self.sizes, query["size"]) >= plan.percent * np.maximum(self.sizes, query["size"])
        open_ &= ~(self.bands == np.array(query["bands"][: self.band], np.int64)).any(axis=1)
        at = np.flatnonzero(open_)
        at = at[plan.equal_in_block(self.signatures[at], np.array(query["signature"], np.int64).view(np.uint64)) >= plan.least_equal]
        out, hashes = [], shingle_set(query["text"], plan.words) if len(at) else None
        for i in at.tolist():
            left, right = self._root(query["component"]), self._root(int(self.components[i]))
            if left == right:
                continue
            if i not in self.sets:
                self.sets[i] = shingle_set(self.texts[i], plan.words)
            if similar(self.sets[i], hashes, plan.percent):
                self.parent[right] = left
                out.append((int(self.nodes[i]), query["node"]))
        return out


def one_of_each(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """docs with the smallest document of each component; all columns as they were. A row goes by doc_id
    and text, so another text under the same doc_id stays; repeated rows that are kept all stay."""
    gone, gone_text, key, flag = (fresh_name(docs, c) for c in ("_dropped", "_dropped_text", "_key", "_flag"))
    found = near_duplicates(docs, plan or Plan()).where("NOT kept")
    found = cut_lineage(found.select(F.col("doc_id").alias(gone), F.col("text_key").alias(gone_text)), ids=True)
    rows = may_be_among(docs.withColumn(key, F.col("doc_id").cast("bigint")), F.col(key), found.select(gone), flag)
    # Only texts of documents that may have to go are moved.
    same = (F.col(key) == F.col(gone)) & (F.xxhash64(F.col("text").cast("string")) == F.col(gone_text))
    unsure = rows.where(flag).join(found, same, "left_anti")
    return rows.where(~F.col(flag)).select(*docs.columns).union(unsure.select(*docs.columns))


def op7_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"), Plan(words=3, percent=85))
    return rows.select("doc_id", "n_shingles", "component_id", "kept")
