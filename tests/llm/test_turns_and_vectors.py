"""Turn repair, whitening and exact top-k against plain versions, and on awkward rows."""

import collections
import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pytest

from shelfline.llm import bidiagonal, inner_products, turn_repair, vectors, whitening

TURNS = "conv_id bigint, turn bigint, role string, text string, later string, _copy int, mark string"
VECTORS = "vec_id bigint, embedding array<double>, label int, x int, block string, whitened double"


def plain_repair(rows):
    """Every sequence of edits with at most three inserts in a row, the cheapest by (cost, audit)."""
    best = None
    for edits in itertools.product("KuaD", repeat=len(rows)):
        for gaps in itertools.product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
            cost, audit, roles, texts = 0, "", "", []
            for k, gap in enumerate(gaps):
                for r in gap:
                    cost, audit, roles = cost + 2, audit + "I", roles + r
                    texts.append({"u": "user:", "a": "assistant:"}[r])
                if k == len(rows):
                    break
                role, text, fault = rows[k]
                if edits[k] == "D":
                    cost, audit = cost + 3, audit + "D"
                    continue
                if fault in ("blank", "duplicate"):
                    break
                new = role if edits[k] == "K" else {"u": "user", "a": "assistant"}[edits[k]]
                cost += (edits[k] != "K") * 2 + (fault == "truncated")
                audit, roles = audit + ("K" if edits[k] == "K" else "R"), roles + (new[:1] or "-")
                texts.append(f"{new}:{text}")
            else:
                continue
            if len(audit) - audit.count("I") == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
                best = min(best or (cost, audit, texts), (cost, audit, texts))
    return best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest()


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        out.append((role, text, turn_repair.fault_of(text, (role, text) in seen)))
        seen.add((role, text))
    return out


def test_parser_against_all_edits():
    rnd = random.Random(3)
    for _ in range(120):
        rows = [(rnd.choice(["user", "assistant", "system", "tool", ""]), rnd.choice(["a.", "b", "", "c!"])) for _ in range(rnd.randint(1, 3))]
        seen, stream = set(), []
        for k, (role, text) in enumerate(rows):
            stream.append((1, k, role, text, (role, text) in seen))
            seen.add((role, text))
        steps = list(turn_repair.parse(iter(stream)))
        texts = [f"{s[6]}:{s[3] or ''}" for s in steps if s[5] != "D"]
        got = sum(s[7] for s in steps), "".join(s[5] for s in steps), hashlib.sha256("\n".join(texts).encode()).hexdigest()
        assert got == plain_repair(faults(rows)), rows


def test_stream_gives_settled_edits_early(monkeypatch):
    rnd = random.Random(4)
    rows = [(1, k, rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice([f"t{k}.", f"t{k}", ""]), False) for k in range(3000)]
    monkeypatch.setattr(turn_repair, "SETTLE", 10**9)
    whole = list(turn_repair.parse(iter(rows)))
    monkeypatch.setattr(turn_repair, "SETTLE", 1)
    read = 0

    def counted():
        nonlocal read
        for row in rows:
            read += 1
            yield row

    early = []
    for step in turn_repair.parse(counted()):
        early.append((read, step))
    assert [s for _, s in early] == whole
    assert early[len(early) // 2][0] < len(rows) * 0.6  # half of the edits are out after about half of the rows


def turns_of(spark):
    rnd, rows = random.Random(5), []
    for c in range(150):
        for _ in range(rnd.randint(1, 9)):
            role, text = rnd.choice(["user", "assistant", "system", None, "tool", "", ".", "u", "User"]), rnd.choice([None, "", "a.", "b", "c! ", "x?\n", " ", "d. "])
            rows.append((c if rnd.random() < 0.98 else None, rnd.choice([None, *range(6), 2**40]), role, text, "l", 1, "m"))
    rows += rows[:20] + [(900, 1, "user", "long " * 50_000, "l", 1, "m")]
    return rows, spark.createDataFrame(rows, TURNS)


def test_repair_of_awkward_rows_against_sql(spark):
    rows, df = turns_of(spark)
    found = turn_repair.every_conversation(df, turn_repair.summaries(turn_repair.repair(turn_repair.damaged(df))))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [r[:4] for r in rows])
    assert collections.Counter(map(tuple, found.collect())) == collections.Counter(con.execute(turn_repair.OP11_SQL).fetchall())


def test_repair_of_empty_table(spark):
    df = spark.createDataFrame([], TURNS)
    assert turn_repair.every_conversation(df, turn_repair.summaries(turn_repair.repair(turn_repair.damaged(df)))).collect() == []


def test_repair_moves_texts_once(spark, sf_dir):
    plan = turn_repair.op11_turn_repair(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Window" not in plan


def brute_top(rows, top):
    usable = {(i, tuple(v)) for i, v, *_ in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for i, v in usable:
        if i % 50 == 0:
            whole = lambda u: [int(np.floor(c * 256)) for c in u]
            scores = sorted((-sum(a * b for a, b in zip(whole(v), whole(u))), j) for j, u in usable if j != i)
            out += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scores[:top])]
    return collections.Counter(out)


def top_of(df):
    rows = inner_products.whole_vectors(df)
    return collections.Counter(map(tuple, inner_products.top_products(rows, rows["vec_id"] % 50 == 0).collect()))


def vectors_of(count, width, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(c) for c in v], 1, 2, "b", 0.5) for i, v in zip(rng.permutation(count), rng.normal(size=(count, width)) * rng.exponential(size=(count, 1)))]
    rows += [(i + 5000, rows[0][1], 1, 2, "b", 0.5) for i in range(40)]  # ties
    return rows + rows[:7] + [(50, None, 1, 2, None, None), (100, [], 1, 2, None, None), (150, [1.0], 1, 2, None, None), (200, [None, 1.0], 1, 2, None, None), (250, [float("nan")], 1, 2, None, None), (None, [1.0, 1.0], 1, 2, None, None)]


@pytest.mark.parametrize("count, width, block", [(400, 5, 1 << 15), (700, 24, 3)])
def test_top_products_against_all_pairs(spark, monkeypatch, count, width, block):
    monkeypatch.setattr(inner_products, "QUERY_BLOCK", block)  # several blocks of queries
    rows = vectors_of(count, width, count)
    assert top_of(spark.createDataFrame(rows, VECTORS)) == brute_top(rows, 5)


def test_top_products_of_very_large_components(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(c) for c in rng.integers(-(1 << 20), 1 << 20, 4)], 1, 2, "b", 0.5) for i in range(120)]
    assert top_of(spark.createDataFrame(rows, VECTORS)) == brute_top(rows, 5)


def test_top_products_of_few_and_no_rows(spark):
    assert top_of(spark.createDataFrame([], VECTORS)) == {}
    assert top_of(spark.createDataFrame([(0, [1.0], 1, 2, "", 0.0)], VECTORS)) == {}
    assert top_of(spark.createDataFrame([(0, [1.0], 1, 2, "", 0.0), (3, [-1.0], 1, 2, "", 0.0)], VECTORS)) == {(0, 1, 3, -65536): 1}


def test_pruning_drops_pairs_before_they_are_scored():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(4000, 16)) * 2.0 ** -np.arange(16) * 4000)
    x = x[np.argsort(-(x * x).sum(axis=1))]
    turn = np.linalg.svd(x, full_matrices=False)[2].T
    held = inner_products.Held(np.arange(20) + 10**6, np.zeros(20, np.int64), x[::200], turn, 5)
    steps = [held.offer(np.arange(k, k + 100), x[k : k + 100]) for k in range(0, 4000, 100)]
    assert not all(steps)  # the stripe ends before its shortest vectors
    for q, s, _ in zip(*held.found):
        assert s in np.sort(x[::200][q] @ x.T)[-5:]


def plain_whitening(rows):
    width = max(len(v) for v in rows)
    x = np.array([[np.floor(1024 * c) + 100_000 for c in v] + [100_000.0] * (width - len(v)) for v in rows])
    centred = x - x.mean(axis=0)
    e, u = np.linalg.eigh(centred.T @ centred / len(x))
    return x, e[::-1], centred @ u[:, ::-1] / np.sqrt(np.maximum(e[::-1], 1e-300)), np.trace(centred.T @ centred / len(x))


def whitened(df):
    rows = whitening.usable(df)
    return whitening.by_component(rows, rows.columns[-1]).collect()


def test_whitening_against_eigenvectors(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    x, e, want, total = plain_whitening([r["embedding"] for r in rows])
    found = sorted(whitening.op12_qd_whitening(spark, sf_dir).collect(), key=lambda r: (r["vec_id"], r["component"]))
    got = np.array([r["whitened"] for r in found]).reshape(len(rows), 8)
    signs = np.sign((got * want[:, :8]).sum(axis=0))
    assert np.abs(got * signs - want[:, :8]).max() < 1e-9
    sums, n = [int(s) for s in x.sum(axis=0)], len(x)
    for k, r in enumerate(found):
        assert r["deviation"] == sum((n * int(a) - s) ** 2 for a, s in zip(x[k // 8], sums)) and r["n"] == n
        assert abs(r["explained"] / (e[k % 8] / total) - 1) < 1e-9 and r["identity_error"] < 1e-9


def test_whitening_of_awkward_rows(spark):
    tail = (1, 2, "b", 0.5)
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [3.0]), (7, []), (None, [1.0, 1.5])]
    odd = [(8, None), (9, [float("nan"), 1.0]), (11, [None, 1.0]), (12, [float("inf"), 1.0])]
    found = whitened(spark.createDataFrame([(*r, *tail) for r in rows + odd], VECTORS))
    _, e, want, total = plain_whitening([r[1] for r in rows])
    assert len(found) == 10 and {r["n"] for r in found} == {5}
    for component in (1, 2):
        got = sorted(abs(r["whitened"]) for r in found if r["component"] == component)
        assert np.allclose(got, sorted(abs(want[:, component - 1])))
    assert whitened(spark.createDataFrame([], VECTORS)) == []
    assert whitened(spark.createDataFrame([(1, [1.0, 2.0], *tail)] * 3, VECTORS)) == []  # no variance
    assert whitened(spark.createDataFrame([(1, [], *tail)], VECTORS)) == []


def test_deviation_beyond_a_long(spark):
    found = whitened(spark.createDataFrame([(k, [s * 1e9, float(k)], 1, 2, "", 0.0) for k, s in enumerate([1, -1, 1, 1])], VECTORS))
    x = np.array([[int(s * 1e9 * 1024), k * 1024] for k, s in enumerate([1, -1, 1, 1])], dtype=object)
    for r in found:
        exact = sum((4 * a - s) ** 2 for a, s in zip(x[r["vec_id"]], x.sum(axis=0)))
        assert r["deviation_exact"] == str(exact) and r["deviation"] == (exact if exact < 2**63 else None)


@pytest.mark.parametrize("kind", ["random", "falling", "low rank", "equal", "nearly equal", "wide", "blocks", "huge"])
def test_bidiagonal_solver(kind):
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    a = {
        "random": rng.normal(size=(90, 40)),
        "falling": rng.normal(size=(90, 40)) * 10.0 ** -np.arange(40),
        "low rank": rng.normal(size=(90, 5)) @ rng.normal(size=(5, 40)),
        "equal": np.vstack([np.eye(40)] * 2),
        "nearly equal": np.linalg.qr(rng.normal(size=(90, 40)))[0] * (1 + 1e-9 * rng.normal(size=40)) @ turn,
        "wide": rng.normal(size=(3, 40)),
        "blocks": np.kron(np.eye(4), rng.normal(size=(12, 10))),
        "huge": rng.normal(size=(90, 40)) * 1e150,
    }[kind]
    squares, v = bidiagonal.right_vectors(whitening._square(a), 8)
    values = np.linalg.svd(a, compute_uv=False)
    assert np.allclose(np.sqrt(squares), values[: len(squares)], rtol=1e-12, atol=0)
    assert len(squares) == min(8, int((values > 1e-12 * values[0]).sum()))
    assert np.abs(v.T @ v - np.eye(len(squares))).max() < 1e-11
    assert np.allclose(np.linalg.norm((a / values[0]) @ v, axis=0), np.sqrt(squares) / values[0], rtol=1e-9)
    diagonal, above, _ = bidiagonal.bidiagonalise(np.linalg.qr(a / values[0])[1] if len(a) >= 40 else whitening._square(a / values[0]))
    small = np.linalg.svd(np.diag(diagonal) + np.diag(above, 1), compute_uv=False)
    assert np.allclose(np.sqrt(np.maximum(bidiagonal.dqds(diagonal, above), 0)), small, rtol=1e-9, atol=1e-15)


def test_short_vectors_go_on_with_zeros():
    import pyarrow as pa

    column = pa.array([[1.0], [], [2.0, 3.0]]).slice(0, 3)
    assert vectors.dense(column, 3).tolist() == [[1, 0, 0], [0, 0, 0], [2, 3, 0]]


def test_removed_lines_with_clashing_columns(spark):
    """Helper names of the join as columns of the documents."""
    from shelfline.llm import site_lines

    shared = "one line that very many different sites do share here"
    rows = [(k, f"own text number {k} of this page with quite a few more words that no other page has\n{shared}", f"s{k}", k, "k", "h", "t", k) for k in range(12)] + [(99, None, "s", 1, "k", "h", "t", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _id int, _key string, _hits string, _text_key string, _places int")
    for found in (site_lines.spread_lines(docs), site_lines.without_boilerplate(docs)):
        got = {r["doc_id"]: r for r in found.collect()}
        assert all(got[k]["text"] == f"own text number {k} of this page with quite a few more words that no other page has" and (got[k]["_id"], got[k]["_hits"]) == (k, "h") for k in range(12))
        assert got[99]["text"] is None
