"""Secret scan through a trigram index: each rule's regular expression yields a Boolean query over
trigrams that every match must contain; postings are intersected and only candidates are verified.

The index is sharded by document, as search engines shard theirs: every task indexes the trigrams
that the rules ask for over its own group of texts, so nothing is shuffled. Rules without mandatory
trigrams are run over every text. Matching is on whole texts, leftmost and without overlaps.

Cases: null text counts as empty and has no spans; repeated rows are scanned alike; equal starts are
ordered by the rules' order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as sre_parser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.texts import map_texts, table

MOST_STRINGS = 64  # alternatives followed while a literal run is exact


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Fixed values of the statement.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
# Public formats of well-known credentials.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("hosted_code", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
)
RULES = BASE + MORE


def trigram_query(pattern: str):
    """Nested ("and" | "or", parts) of lower-case trigrams, or True if none is mandatory."""
    strings, query = _walk(sre_parser.parse(pattern, re.ASCII))
    return _both(query, _of_strings(strings))


def _of_strings(strings: set[str] | None):
    if not strings or min(map(len, strings)) < 3:
        return True
    parts = [("and", tuple(sorted({s[i : i + 3] for i in range(len(s) - 2)}))) for s in sorted(strings)]
    return parts[0] if len(parts) == 1 else ("or", tuple(dict.fromkeys(parts)))


def _both(*parts):
    real = tuple(p for p in parts if p is not True)
    return True if not real else real[0] if len(real) == 1 else ("and", real)


def _walk(items) -> tuple[set[str] | None, object]:
    """(the strings that the items match exactly, None if unknown; what any match must contain)."""
    run: set[str] = {""}
    query, exact = True, True
    for op, arg in items:
        found, inner = _step(op, arg)
        query = _both(query, inner)
        if found is not None and len(found) * len(run) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, found)}
        else:
            query, run, exact = _both(query, _of_strings(run)), {""} if found is None else found, False
    return (run, query) if exact else (None, _both(query, _of_strings(run)))


def _step(op, arg) -> tuple[set[str] | None, object]:
    if op is sre.LITERAL:
        return {chr(arg).lower()}, True
    if op is sre.AT or op in (sre.ASSERT, sre.ASSERT_NOT):
        return {""}, True
    if op is sre.IN and all(kind is sre.LITERAL for kind, _ in arg):
        return {chr(value).lower() for _, value in arg}, True
    if op is sre.SUBPATTERN:
        return _walk(arg[-1])
    if op is sre.BRANCH:
        sides = [_walk(side) for side in arg[1]]
        if all(strings is not None for strings, _ in sides):
            return set().union(*(strings for strings, _ in sides)), True
        queries = [_both(query, _of_strings(strings)) for strings, query in sides]
        return None, True if any(q is True for q in queries) else ("or", tuple(queries))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = arg
        strings, query = _walk(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, True
        return None, (_both(query, _of_strings(strings)) if low else True)
    return None, True


def trigrams(query) -> set[str]:
    if isinstance(query, str):
        return {query}
    return set() if query is True else set().union(*map(trigrams, query[1]))


def rows_of(query, postings: dict[str, int], everything: int) -> int:
    """Rows of a group that satisfy the query, as a bit set."""
    if query is True:
        return everything
    if isinstance(query, str):
        return postings[query]
    parts = [rows_of(q, postings, everything) for q in query[1]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


def postings_of(texts: list[str], wanted: list[str]) -> dict[str, int]:
    """Trigram to the bit set of the texts that contain it, in any case."""
    found = dict.fromkeys(wanted, 0)
    for i, text in enumerate(texts):
        low, bit = text.lower(), 1 << i
        for t in wanted:
            if t in low:
                found[t] |= bit
    return found


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and `spans`: kind, start and end (code points, end exclusive), by start, then rule."""

    def work(batch: pa.RecordBatch) -> dict:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        queries = [trigram_query(r.pattern) for r in rules]
        postings = postings_of(texts, sorted(set().union(*map(trigrams, queries))))
        spans: list[list] = [[] for _ in texts]
        for rank, (rule, query) in enumerate(zip(rules, queries)):
            matches = re.compile(rule.pattern, re.ASCII).finditer
            rows = rows_of(query, postings, (1 << len(texts)) - 1)
            while rows:
                i = (rows & -rows).bit_length() - 1
                rows &= rows - 1
                spans[i] += [(m.start(), rank, m.end()) for m in matches(texts[i]) if m.end(rule.group) - m.start(rule.group) >= rule.least]
        found = [[{"kind": rules[rank].kind, "start": start, "end": end} for start, rank, end in sorted(s)] for s in spans]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return {"doc_id": batch.column("doc_id"), "spans": pa.array(found, kind)}

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return map_texts(rows, work, "doc_id bigint, spans array<struct<kind:string,start:int,end:int>>")


def op1_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    return found.select(
        "doc_id",
        *[F.size(of(r.kind)).cast("bigint").alias(f"n_{r.kind}") for r in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
