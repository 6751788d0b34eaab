"""Exact top-k inner products over norm-sorted vectors with rotated partial sums.

Vectors are rotated by the right singular vectors of the candidate matrix, so that leading coordinates
carry most of an inner product. A task holds one block of queries and meets one stripe of the candidates
by descending length. After each group of coordinates, Cauchy-Schwarz bounds what the rest can add;
a pair whose bound is below the query's k-th score goes, and a stripe ends where even the length of
its next vector is too small. What is left is scored exactly on the whole numbers.

Rows without an id, and vectors that are null or hold null, NaN or infinite components, take no part.
A shorter vector goes on with zeros. Rows with the same id and vector count once; a vector is never its
own query's candidate, nor is another row under the query's id. Ties go to the smaller id. An empty table
gives an empty result. Scores beyond 2^53 are summed in extended doubles, exact up to a long; components
beyond +-2^53 count as that and scores beyond a long as its limit.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.texts import table
from shelfline.llm.vectors import blocks, dense, finite, merged

# Components become floor(SCALE * x), queries are the ids divisible by EVERY.
SCALE, EVERY, TOP = 256, 50, 5
LIMIT = float(1 << 53)
# Queries that a task holds, and candidates of one stripe: bounds of a tile, not of the search.
QUERY_BLOCK, STRIPE_ROWS = 1 << 15, 1 << 20
# Candidates scored at a time, and shares of the coordinates after which pairs are dropped.
BATCH, CHECKS = 2048, (0.25, 0.5)
# Scores are whole numbers, so half a unit is free; the share of both lengths covers the rounding of bounds.
SLACK, SLACK_SHARE = 0.5, 1e-12

LONG = float(1 << 63)
FOUND = "query_id bigint, query_key bigint, vec_id bigint, score bigint"


def whole_vectors(df: DataFrame, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """vec_id and x, the components as whole numbers, of every row that takes part."""
    cell = lambda c: F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), c.cast("double") * scale))).cast("double")
    rows = df.where(finite(df[vector]) & df[key].isNotNull())
    return rows.select(df[key].cast("bigint").alias("vec_id"), F.transform(df[vector], cell).alias("x"))


def _pack(count: int, queries: int, gram: np.ndarray) -> bytes:
    return np.concatenate([[count, queries, len(gram)], gram.ravel()]).tobytes()


def _unpack(part: bytes) -> tuple[int, int, np.ndarray]:
    flat = np.frombuffer(part)
    return int(flat[0]), int(flat[1]), flat[3:].reshape(int(flat[2]), int(flat[2]))


def _sum(parts: list[bytes]) -> bytes:
    found = [_unpack(p) for p in parts]
    gram = np.zeros((max((len(g) for *_, g in found), default=0),) * 2)
    for _, _, g in found:
        gram[: len(g), : len(g)] += g
    return _pack(sum(f[0] for f in found), sum(f[1] for f in found), gram)


def rotation(rows: DataFrame, is_query: Column) -> tuple[int, int, np.ndarray]:
    """Rows, queries and the right singular vectors of all rows, from one width x width sum per task."""

    def work(batches):
        held = _pack(0, 0, np.zeros((0, 0)))
        for part, x in blocks(batches, "x"):
            held = _sum([held, _pack(len(x), int(np.count_nonzero(part.column("asks").to_numpy(zero_copy_only=False))), x.T @ x)])
        yield pa.RecordBatch.from_arrays([pa.array([held], pa.binary())], ["part"])

    parts = rows.select("x", is_query.alias("asks")).mapInArrow(work, "part binary")
    count, queries, gram = _unpack(_sum(merged(parts, _sum)))
    values, vectors = np.linalg.eigh(gram)
    return count, queries, np.ascontiguousarray(vectors[:, np.argsort(-values)])


class Held:
    """The queries of one tile with their best candidates so far."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, x: np.ndarray, turn: np.ndarray, top: int):
        self.ids, self.keys, self.x, self.turn, self.top = ids, keys, x, turn, top
        self.cuts = sorted({max(1, int(len(turn) * s)) for s in CHECKS if len(turn)} | {len(turn)})
        self.y, self.rest = rotated(x, turn, self.cuts)
        self.length = np.sqrt((x * x).sum(axis=1))
        self.least = np.full(len(ids), -np.inf)
        self.found = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))  # query, score, id

    def offer(self, ids: np.ndarray, x: np.ndarray) -> bool:
        """Scores candidates, the longest first; False when no later one can enter any list."""
        length = math.sqrt(float((x[0] * x[0]).sum()))
        if self.length.max() * length >= LIMIT:
            self.x, self.least = self.x.astype(np.longdouble), self.least.astype(np.longdouble)
        open_ = np.flatnonzero(self.length * length * (1 + SLACK_SHARE) >= self.least - SLACK)
        if not len(open_):
            return False
        y, rest = rotated(x, self.turn, self.cuts)
        for start in range(0, len(open_), 1024):
            rows = open_[start : start + 1024]
            self.score(rows, self.least[rows] - SLACK - SLACK_SHARE * self.length[rows] * length, ids, x.astype(self.x.dtype), y, rest)
        return True

    def score(self, rows: np.ndarray, floor: np.ndarray, ids: np.ndarray, x: np.ndarray, y: np.ndarray, rest: np.ndarray) -> None:
        """Partial sums over growing groups of coordinates; exact products of what stays above `floor`."""
        sums, begin, alive, few = np.zeros((len(rows), len(ids))), 0, None, False
        for level, cut in enumerate(self.cuts[:-1] if np.isfinite(floor).any() else []):
            sums += self.y[rows, begin:cut] @ y[:, begin:cut].T
            alive = sums + np.outer(self.rest[level, rows], rest[level]) >= floor[:, None]
            begin, few = cut, alive.mean() < 0.02
            if few:
                break
        if few:
            at, to = np.nonzero(alive)
            scores = (self.x[rows[at]] * x[to]).sum(axis=1)
        else:
            whole = self.x[rows] @ x.T
            whole[self.ids[rows, None] == ids[None, :]] = -np.inf
            bar = self.least[rows]
            if len(ids) > self.top:
                bar = np.maximum(bar, np.partition(whole, len(ids) - self.top, axis=1)[:, len(ids) - self.top])
            at, to = np.nonzero((whole >= bar[:, None]) & np.isfinite(whole))
            scores = whole[at, to]
        keep = (scores >= self.least[rows[at]]) & (self.ids[rows[at]] != ids[to])
        if keep.any():
            self.keep(rows[at[keep]], scores[keep], ids[to[keep]])

    def keep(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        mine = np.isin(self.found[0], query)
        query, score, ids = (np.concatenate([old[mine], new]) for old, new in zip(self.found, (query, score, ids)))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        last = place == self.top - 1
        self.least[query[last]] = score[last]
        best = place < self.top
        self.found = tuple(np.concatenate([old[~mine], new[best]]) for old, new in zip(self.found, (query, score, ids)))

    def rows(self) -> pa.RecordBatch:
        query, score, ids = self.found
        return pa.RecordBatch.from_arrays([pa.array(a) for a in (self.ids[query], self.keys[query], ids, whole_longs(score))], ["query_id", "query_key", "vec_id", "score"])


def whole_longs(score: np.ndarray) -> np.ndarray:
    inside = np.abs(score) < LONG
    return np.where(inside, np.where(inside, score, 0).astype(np.int64), np.where(score > 0, np.iinfo(np.int64).max, np.iinfo(np.int64).min))


def rotated(x: np.ndarray, turn: np.ndarray, cuts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rotated coordinates, and the length of what follows each cut."""
    y = x @ turn
    tail = np.cumsum((y * y)[:, ::-1], axis=1)[:, ::-1]
    return y, np.array([np.sqrt(tail[:, c]) if c < y.shape[1] else np.zeros(len(y)) for c in cuts])


def top_products(rows: DataFrame, is_query: Column, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id and score: the `top` largest inner products of every query row.

    rows: vec_id bigint, x array<double> of whole numbers. One exchange: a query goes to every stripe of
    candidates, a candidate to every block of queries, both dealt by hash, so that no length, id or
    vector gathers in one tile. Tiles return `top` rows a query at most."""
    count, queries, turn = rotation(rows, is_query)
    spark = rows.sparkSession
    asked = max(1, math.ceil(queries / QUERY_BLOCK))
    stripes = max(math.ceil(count / STRIPE_ROWS), math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / asked), 1)
    width = len(turn)
    shared = spark.sparkContext.broadcast(turn)  # width x width numbers

    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    stripe = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n)).cast("int")
    length = F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c).alias("length")
    asking = rows.where(is_query).select(F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), block(asked).alias("block"), F.lit(0).alias("kind"), length, "vec_id", F.xxhash64("x").alias("key"), "x")
    offered = rows.select(stripe(stripes).alias("stripe"), F.explode(F.sequence(F.lit(0), F.lit(asked - 1))).alias("block"), F.lit(1).alias("kind"), length, "vec_id", F.xxhash64("x").alias("key"), "x")
    tiles = asking.union(offered).repartition(asked * stripes, "block", "stripe")
    tiles = tiles.sortWithinPartitions("block", "stripe", "kind", F.desc("length"), "vec_id", "key")

    def work(batches):
        turn, tile, held, waiting, busy, last = shared.value, None, None, [], True, None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("block", "stripe", "kind", "vec_id", "key")}
            marks = np.stack([names["block"], names["stripe"], names["kind"]])
            edges = np.r_[0, np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1, batch.num_rows]
            for begin, end in zip(edges[:-1], edges[1:]):
                kind, now = int(marks[2, begin]), tuple(marks[:2, begin].tolist())
                if tile != now:
                    if held is not None:
                        yield held.rows()
                    tile, held, waiting, busy = now, None, [], True
                for start in range(begin, end, BATCH):
                    if kind == 1 and not (busy and (held or waiting)):
                        break  # a tile without queries, or nothing later can enter a list
                    stop = min(end, start + BATCH)
                    ids, keys = names["vec_id"][start:stop], names["key"][start:stop]
                    fresh = np.r_[last != (now, kind, ids[0], keys[0]), (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])]
                    last = (now, kind, ids[-1], keys[-1])
                    if not fresh.any():
                        continue
                    part = (ids[fresh], keys[fresh], dense(batch.column("x").slice(start, stop - start), width)[fresh])
                    if kind == 0:
                        waiting.append(part)
                        continue
                    if held is None:
                        held, waiting = Held(*(np.concatenate(p) for p in zip(*waiting)), turn, top), []
                    busy = held.offer(part[0], part[2])
        if held is not None:
            yield held.rows()

    best = tiles.mapInArrow(work, FOUND)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op13_norm_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id and score for every row of `embeddings` whose vec_id is divisible by EVERY."""
    rows = whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_products(rows, F.col("vec_id") % EVERY == 0)


OP13_SQL = f"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda c: floor(CAST(c AS DOUBLE) * {SCALE})) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}
"""
