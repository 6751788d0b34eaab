"""Byte-level BPE as a streaming transducer with a bounded lookahead, and its incremental decoder.

A token is emitted as soon as no further input can change it. How many more bytes that takes is a
property of the merge list (`sufficient_lookahead`), so a piece of any length is encoded with a
buffer of constant size. Decoding feeds the bytes of each token to a UTF-8 state machine.

Null text counts as empty: no tokens, empty decoded text.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from shelfline.llm.texts import map_texts, table

# Fixed value: the pattern that splits text into pieces before the merges. Contractions come third here: nothing
# that starts with an apostrophe is letters or digits, and most pieces are, so they are tried first.
PIECES = regex.compile(r""" ?\p{L}+| ?\p{N}+|'(?:s|t|re|ve|m|ll|d)| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
# The unbounded piece classes; a piece that outgrows the buffer goes on in one of them.
RUNS = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+")]
HELD_CHARS = 3  # longest contraction: what a piece's end may still depend on
LONG_PIECE = 4096  # characters of an unfinished piece after which it is streamed
CACHE_PIECES = 120_000  # encodings remembered by a task; the memory bound, not a limit on the text
SHORT_BYTES = 64  # longest piece that is remembered
CHUNK_CHARS = 1 << 16
BATCH_CHARS = 1 << 19  # text cut into pieces before they are looked up, whatever the documents' lengths
FEW_ROWS = 32  # pieces of one length that are sooner merged one by one
NEVER = np.int32(2**31 - 1)  # rank of a pair that does not merge


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file, back to the byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """A vocabulary with its ranked merges and the lookahead that they need."""

    def __init__(self, source: str):
        spec = json.loads(source)
        letters = byte_letters()
        self.ids = {bytes(letters[c] for c in shown): i for shown, i in spec["model"]["vocab"].items()}
        pairs = [tuple(p.split(" ") if isinstance(p, str) else p) for p in spec["model"]["merges"]]
        self.ranks = {tuple(bytes(letters[c] for c in side) for side in p): r for r, p in reversed(list(enumerate(pairs)))}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.split = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.lookahead = sufficient_lookahead(self.ranks)
        self._tabulate()

    def _tabulate(self) -> None:
        """Arrays for `merge_rows`: pairs of ids as sorted numbers with their ranks, the id that each rank gives.
        For `joined`: all tokens' bytes in a row, each id's start and length there."""
        self.base = max(self.ids.values()) + 1
        pairs = np.array([(self.ids[u] * self.base + self.ids[v], r, self.ids[u + v]) for (u, v), r in self.ranks.items()], np.int64).reshape(-1, 3)
        pairs = pairs[pairs[:, 0].argsort()]
        self.pairs = np.append(pairs[:, 0], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(pairs[:, 1], NEVER).astype(np.int32)
        self.gives = np.zeros(pairs[:, 1].max(initial=0) + 1, np.int32)
        self.gives[pairs[:, 1]] = pairs[:, 2]
        self.byte_ids = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.byte_ranks = self.rank(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)).reshape(256, 256)
        self.row_bytes = min(SHORT_BYTES, self.lookahead) if (self.byte_ids >= 0).all() else 0  # longest piece for `merge_rows`
        tokens = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = self.lengths.cumsum() - self.lengths
        self.letters = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of tokens, one after the other."""
        lengths = self.lengths[ids]
        at = np.repeat(self.starts[ids] - (lengths.cumsum() - lengths), lengths)
        at += np.arange(len(at))
        return self.letters[at].tobytes()

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left.astype(np.int64) * self.base + right
        at = self.pairs.searchsorted(pair)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.pair_ranks[at], NEVER)

    def merge_rows(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """`merge` for many pieces of one length, a row of bytes each: row numbers and the rows' ids, as rows get done.

        Each round makes the first merge of lowest rank in every row, so all rows stay of one length."""
        rows, parts, here = np.arange(len(data)), self.byte_ids[data], self.byte_ranks[data[:, :-1], data[:, 1:]]
        while len(rows) and parts.shape[1] > 1:
            at = here.argmin(1)
            best = here[np.arange(len(rows)), at]
            done = best == NEVER
            if done.any():
                yield rows[done], parts[done]
                rows, parts, here, at, best = (x[~done] for x in (rows, parts, here, at, best))
            (n, width), line = parts.shape, np.arange(len(rows))
            parts[line, at] = self.gives[best]
            parts = _without(parts, line, at + 1).reshape(n, width - 1)
            here = _without(here, line, at).reshape(n, width - 2)
            for some, first in ((np.flatnonzero(at > 0), -1), (np.flatnonzero(at < width - 2), 0)):
                left = at[some] + first
                here[some, left] = self.rank(parts[some, left], parts[some, left + 1])
        if len(rows):
            yield rows, parts

    def merge(self, piece: bytes) -> list[bytes]:
        """All merges in order of rank, then position, over a linked list of parts."""
        ranks, parts = self.ranks, [piece[i : i + 1] for i in range(len(piece))]
        if len(parts) <= 64:
            never = len(ranks)
            here = [ranks.get(pair, never) for pair in zip(parts, parts[1:])]
            while here and (best := min(here)) < never:
                at = here.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                del here[at]
                if at:
                    here[at - 1] = ranks.get((parts[at - 1], parts[at]), never)
                if at < len(here):
                    here[at] = ranks.get((parts[at], parts[at + 1]), never)
            return parts
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        queue = [(ranks[pair], i, pair) for i, pair in enumerate(zip(parts, parts[1:])) if pair in ranks]
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < len(parts) and (parts[left], parts[right]) in ranks:
                    heapq.heappush(queue, (ranks[parts[left], parts[right]], left, (parts[left], parts[right])))
        return [p for p in parts if p is not None]


def _without(rows: np.ndarray, line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The entries of a matrix but one of each row."""
    kept = np.ones(rows.shape, bool)
    kept[line, at] = False
    return rows[kept]


def sufficient_lookahead(ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Bytes after a token that settle it, for any text.

    Whether merge (u, v) happens depends on text right of v only through merges of lower rank: those
    that form u or v, those that take v with something on its right, and those that take u with
    something on its left. `need` of a merge is the furthest of these, found in order of rank, so
    every merge refers to finished ones only. A token is settled once each merge that could take it
    as its left part is decided, and each that could form it or take it as its right part.
    """
    forms: dict[bytes, int] = {}
    takes_left: dict[bytes, int] = {}
    takes_right: dict[bytes, int] = {}
    most = 0
    for u, v in sorted(ranks, key=ranks.get):
        need = max(forms.get(v, 0), takes_left.get(v, 0), forms.get(u, 0) - len(v), takes_left.get(u, 0) - len(v), takes_right.get(u, 0) - len(v))
        forms[u + v] = max(forms.get(u + v, 0), need)
        takes_left[u] = max(takes_left.get(u, 0), len(v) + need)
        takes_right[v] = max(takes_right.get(v, 0), need)
        most = max(most, len(v) + need)
    return most


class Transducer:
    """One piece, fed in bytes: `feed` returns the tokens that are settled, `finish` the rest."""

    def __init__(self, merges: Merges):
        self.merges, self.buffer = merges, b""

    def feed(self, data: bytes) -> list[bytes]:
        self.buffer += data
        if len(self.buffer) < 4 * self.merges.lookahead + 1024:
            return []
        settled, end, out = len(self.buffer) - self.merges.lookahead, 0, []
        for token in self.merges.merge(self.buffer):
            end += len(token)
            if end > settled:
                break
            out.append(token)
        self.buffer = self.buffer[sum(map(len, out)) :]
        return out

    def finish(self) -> list[bytes]:
        rest, self.buffer = self.buffer, b""
        return self.merges.merge(rest)


class _Pieces(dict):
    """Piece to its ids as comma-joined text, filled on first use. When half of CACHE_PIECES are held they
    become the earlier half, in place of the last one; a piece found there comes back, so frequent ones stay."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.earlier: dict[str, str] = {}
        self.merges, self.names = merges, {b: str(i) for b, i in merges.ids.items()}

    def __missing__(self, piece: str) -> str:
        found = self.earlier.get(piece)
        if found is None:
            data = piece.encode()
            found = ",".join([self.names[t] for t in _stream(self.merges, data)])
            if len(data) > SHORT_BYTES:
                return found
        self._keep(piece, found)
        return found

    def _keep(self, piece: str, found: str) -> None:
        if len(self) >= CACHE_PIECES // 2:
            self.earlier = dict(self)
            self.clear()
        self[piece] = found

    def look_up(self, pieces: set[str]) -> dict[str, str]:
        """The ids of many pieces: unknown ones of one length are merged together, others one by one."""
        found: dict[str, str] = {}
        unknown: dict[int, list[str]] = {}
        for piece in pieces:
            if (ids := self.get(piece)) is not None:
                found[piece] = ids
            elif piece in self.earlier:
                found[piece] = self[piece]
            else:
                unknown.setdefault(len(piece) if piece.isascii() else len(piece.encode()), []).append(piece)
        for length, group in unknown.items():
            if len(group) < FEW_ROWS or length > self.merges.row_bytes:
                found.update((piece, self[piece]) for piece in group)
                continue
            for rows, ids in self.merges.merge_rows(np.frombuffer("".join(group).encode(), np.uint8).reshape(-1, length)):
                shown = ",".join(["%d"] * ids.shape[1])
                new = {group[row]: shown % tuple(x) for row, x in zip(rows.tolist(), ids.tolist())}
                found.update(new)
                for piece, x in new.items():
                    self._keep(piece, x)
        return found


def _stream(merges: Merges, data: bytes) -> list[bytes]:
    if len(data) <= merges.lookahead:
        return merges.merge(data)
    run, out = Transducer(merges), []
    for i in range(0, len(data), LONG_PIECE):
        out += run.feed(data[i : i + LONG_PIECE])
    return out + run.finish()


class Encoder:
    """Text in chunks to ids. It holds back what later text may still change: the last piece, a
    possible contraction, and the possible start of a special token."""

    def __init__(self, merges: Merges, known: _Pieces | None = None):
        self.merges, self.known = merges, known if known is not None else _Pieces(merges)
        self.buffer, self.open, self.run = "", None, None
        self.hold = max([HELD_CHARS, *(len(s) for s in merges.special)])

    def feed(self, chunk: str, last: bool = False) -> list[str]:
        """Ids as texts of comma-joined numbers, one per list of pieces or run of settled tokens."""
        return list(_looked_up(self.known, self.cut(chunk, last)))

    def cut(self, chunk: str, last: bool = False) -> list[list[str] | str]:
        """What is done of the text: lists of pieces, and ids as comma-joined numbers of what had to be streamed."""
        self.buffer += chunk
        out: list[list[str] | str] = []
        start = 0
        for found in self.merges.split.finditer(self.buffer):
            self._plain(self.buffer[start : found.start()], True, out)
            out.append(str(self.merges.special[found[0]]))
            start = found.end()
        rest = self.buffer[start:]
        self.buffer = rest[self._plain(rest, last, out) :]
        return [x for x in out if x]

    def _plain(self, text: str, last: bool, out: list[list[str] | str]) -> int:
        """Encodes text without special tokens; returns how many characters are done."""
        safe = len(text) if last else len(text) - self.hold
        done = self._go_on(text, last, safe, out) if self.run else 0
        if self.run:
            return done
        if last:
            out.append(PIECES.findall(text, done))
            return len(text)
        pieces: list[str] = []
        out.append(pieces)
        for found in PIECES.finditer(text, done):
            if found.end() >= safe:
                self._open(text[done:safe], out)
                return safe if self.run else done
            pieces.append(found[0])
            done = found.end()
        return done

    def _open(self, head: str, out: list[list[str] | str]) -> None:
        """Starts streaming a piece that has outgrown the buffer (white space waits for its end)."""
        if len(head) > LONG_PIECE and not head.isspace():
            self.open = next(r for r in RUNS if r.match(head[-1]))
            self.run = Transducer(self.merges)
            self._emit(self.run.feed(head.encode()), out)

    def _go_on(self, text: str, last: bool, safe: int, out: list[list[str] | str]) -> int:
        found = self.open.match(text, 0, max(safe, 0))
        done = found.end() if found else 0
        self._emit(self.run.feed(text[:done].encode()), out)
        if last or done < safe:
            self._emit(self.run.finish(), out)
            self.run = None
        return done

    def _emit(self, tokens: list[bytes], out: list[list[str] | str]) -> None:
        out.append(",".join(str(self.merges.ids[t]) for t in tokens))


class Decoder:
    """Ids to text, some at a time; bytes of an unfinished character wait for the next token."""

    def __init__(self, merges: Merges):
        self.merges, self.state = merges, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self.state.decode(self.merges.joined(np.asarray(ids, np.int64)))

    def finish(self) -> str:
        return self.state.decode(b"", True)


@lru_cache(maxsize=2)
def _loaded(source: str) -> Merges:
    return Merges(source)


def encode_decode(docs: DataFrame, source: str, ids: bool = False) -> DataFrame:
    """Per document: n_tokens, ids_sha256, decoded_sha256, and with `ids` the ids themselves.

    `source` is the vocabulary file's content (a fixed size, sent with the task). Nothing moves
    between tasks. Null text gives 0 tokens and the digests of nothing.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(source)
    pieces: list[_Pieces] = []  # of one task: a worker that goes on to other stages keeps only the merges

    def work(batch: pa.RecordBatch) -> dict:
        merges = _loaded(shared.value)
        if not pieces:
            pieces.append(_Pieces(merges))
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        row = _Row(merges, ids)
        for part in _chunks(merges, pieces[0], batch.column("text").to_pylist()):
            if part is not None:
                row.add(part)
                continue
            for name, value in zip(out, row.finish()):
                out[name].append(value)
            row = _Row(merges, ids)
        return {
            "doc_id": batch.column("doc_id"),
            **{k: pa.array(v, pa.int64() if k == "n_tokens" else pa.string()) for k, v in out.items() if k != "ids"},
            "ids": pa.array(out["ids"], pa.list_(pa.int32())),
        }

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return map_texts(rows, work, schema, after=pieces.clear)


class _Row:
    """One document's count and digests, from its ids in comma-joined parts."""

    def __init__(self, merges: Merges, ids: bool):
        self.decoder, self.ids = Decoder(merges), ids
        self.count, self.digest, self.plain, self.kept = 0, hashlib.sha256(), hashlib.sha256(), []

    def add(self, part: str) -> None:
        tokens = np.fromstring(part, np.int64, sep=",")
        self.digest.update(f",{part}".encode() if self.count else part.encode())
        self.count += len(tokens)
        self.plain.update(self.decoder.feed(tokens).encode())
        if self.ids:
            self.kept.extend(tokens.tolist())

    def finish(self) -> tuple[int, str, str, list[int]]:
        self.plain.update(self.decoder.finish().encode())
        return self.count, self.digest.hexdigest(), self.plain.hexdigest(), self.kept


def _chunks(merges: Merges, known: _Pieces, texts: list[str | None]) -> Iterator[str | None]:
    """Ids of the texts, comma-joined, in parts of a chunk at most; None ends each text. About BATCH_CHARS of text
    are cut before their pieces are looked up, so that unknown ones of short texts are encoded together as well."""
    waiting: list[list[str] | str | None] = []
    held = 0
    for text in texts:
        encoder, text = Encoder(merges, known), text or ""
        for i in range(0, len(text), CHUNK_CHARS):
            chunk = text[i : i + CHUNK_CHARS]
            waiting += encoder.cut(chunk, i + CHUNK_CHARS >= len(text))
            held += len(chunk)
            if held >= BATCH_CHARS:
                yield from _looked_up(known, waiting)
                waiting, held = [], 0
        waiting.append(None)
    yield from _looked_up(known, waiting)


def _looked_up(known: _Pieces, waiting: list[list[str] | str | None]) -> Iterator[str | None]:
    found = known.look_up(set().union(*[part for part in waiting if isinstance(part, list)]))
    for part in waiting:
        yield ",".join(map(found.__getitem__, part)) if isinstance(part, list) else part


def vocabulary(path: str | None = None) -> str:
    """Content of a vocabulary file; the default is the public 50k byte-level one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), vocabulary())
