"""Text operators against plain versions on the smallest tables and on awkward rows."""

import collections
import hashlib
import random
import re
import subprocess
import sys

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from shelfline.llm import bpe, components as component_rounds, fixity, hyper_lang, leaks, minhash, queries, repeats, secrets, site_lines, suffixes, texts, toxicity, weak_rules
from shelfline.session import FILES_PER_CORE, cut_lineage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept int, line string, size int"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with clashing names."""
    long_text = " ".join(f"word{i % 5000}" for i in range(30_000))
    texts = [None, "", "   ", "!!!", "short one", "x" * 20_000, long_text, long_text, "password = hunter2hunter2\nBuy now", "one two three four five six"]
    rows = [(i, t, "en", f"s{i}", len(t or ""), "a", 1, "b", 2) for i, t in enumerate(texts)]
    rows += [rows[9], (None, "a null id with some words", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def found(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    result = con.execute(queries.ORACLE_SQL[name])
    places = [[c[0] for c in result.description].index(n) for n in names]
    assert collections.Counter(map(tuple, df.select(*names).collect())) == collections.Counter(tuple(r[i] for i in places) for r in result.fetchall())


def test_secrets(spark, sf_dir, docs):
    kinds = [("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32)]
    for doc, row in found(queries.QUERIES["op1_trigram_secrets"](spark, sf_dir)).items():
        spans = sorted((m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, (kind, p, g, n) in enumerate(kinds) for m in re.finditer(p, docs[doc], re.A | re.I * (k == 0)) if len(m[g]) >= n)
        assert row["base_sha256"] == hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind, *_ in kinds] == [sum(s[1] == k for s in spans) for k in range(3)]
        more = [(m.start(), 3 + k, f"{r.kind}:{m.start()}:{m.end()}") for k, r in enumerate(secrets.MORE) for m in re.finditer(r.pattern, docs[doc], re.A)]
        assert row["spans"] == ",".join(s[2] for s in sorted(spans + more))


def test_every_added_rule_is_found(spark):
    samples = {
        "private_key": "-----BEGIN RSA PRIVATE KEY-----",
        "web_token": "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl",
        "hosted_code": "ghp_" + "Zq" * 18,
        "chat": "xoxb-12345-abcdef",
        "maps": "AIza" + "Bc_-5" * 7,
        "payment": "sk_live_" + "Xy" * 8,
    }
    assert set(samples) == {r.kind for r in secrets.MORE}
    rows = [(i, f"see {sample} there") for i, sample in enumerate(samples.values())] + [(90, "nothing to see there"), (91, None)]
    seen = found(secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")))
    for i, (kind, sample) in enumerate(samples.items()):
        assert (kind, 4, 4 + len(sample)) in [tuple(s) for s in seen[i]["spans"]]
    assert seen[90]["spans"] == seen[91]["spans"] == []


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]+") is True
    query = secrets.trigram_query("(?:foobar|bar.*bazz)x?")
    texts_ = ["xfoobar", "BAR and bazz", "foobaz", "bar", "bazz", "foo oba oob"]
    assert secrets.trigrams(query) == {"foo", "oob", "oba", "bar", "baz", "azz"}
    assert secrets.rows_of(query, secrets.postings_of(texts_, sorted(secrets.trigrams(query))), 0b111111) == 0b000011


def test_weak_rules_counts(spark, sf_dir, docs):
    for doc, r in found(queries.QUERIES["op8_weak_rules"](spark, sf_dir)).items():
        words, places = WORD.findall(docs[doc]), collections.defaultdict(list)
        for i in range(len(words) - 7):
            places[tuple(words[i : i + 8])].append(i)
        covered = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
        lines = [x for x in docs[doc].split("\n") if WORD.search(x)]
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in docs[doc])
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_bpe_equals_library(spark, sf_dir, docs, awkward):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc, row in found(queries.QUERIES["op9_bpe"](spark, sf_dir)).items():
        ids = plain.encode(docs[doc], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(plain.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert found(bpe.encode_decode(awkward, bpe.vocabulary()))[0]["n_tokens"] == 0


@pytest.mark.parametrize("chunk", [3, 700, 5000])
def test_bpe_chunks_do_not_matter(chunk):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain, merges = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), bpe.Merges(bpe.vocabulary())
    dice = random.Random(5)
    for text in ["a" * 9000, " " * 9000 + "x", "<|endoftext|> we'll <|end", "".join(dice.choices("etaoin", k=12_000)), "日本é'" * 900]:
        encoder, ids = bpe.Encoder(merges), []
        for i in range(0, len(text), chunk):
            for part in encoder.feed(text[i : i + chunk], i + chunk >= len(text)):
                ids += map(int, part.split(","))
        assert ids == plain.encode(text, add_special_tokens=False).ids
        assert len(encoder.buffer) == 0


def components(texts, words, percent):
    sets = {}
    for doc, text in texts.items():
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        sets[doc] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    label = {d: d for d in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {d: low if c == high else c for d, c in label.items()}
    return {d: (len(sets[d]), label[d]) for d in ids}


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, sf_dir, docs, words, percent):
    rows = minhash.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), minhash.Plan(words, percent))
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in found(rows).items()} == components(docs, words, percent)


def test_near_duplicates_chain_and_hot_group(spark):
    """A chain whose ends are not alike, and a group larger than a star part."""
    dice = random.Random(3)
    base = [f"w{dice.randrange(10**6)}" for _ in range(120)]
    texts = {i: " ".join([*[f"n{j}" for j in range(3 * i)], *base[3 * i :]]) for i in range(6)}
    group = [f"g{dice.randrange(10**6)}" for _ in range(100)]
    texts |= {100 + i: " ".join([*group, f"end{i}"]) for i in range(150)}
    rows = minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), minhash.Plan(3, 85))
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in found(rows).items()} == components(texts, 3, 85)


def brute_repeats(texts):
    seen, out = set(), {}
    for doc, text in sorted(texts.items()):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(data[p : p + 100])
        left = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[doc] = (len(data), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("hot_rows", [100_000, 4])
def test_repeats(spark, sf_dir, docs, hot_rows):
    rows = repeats.without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), hot_rows)
    assert {d: tuple(r)[1:] for d, r in found(rows).items()} == brute_repeats(docs)


def test_suffix_order():
    dice = random.Random(1)
    for _ in range(60):
        text = np.frombuffer(bytes(dice.choices(b"ab\x00\xff", k=dice.randint(1, 300))), np.uint8)
        order = suffixes.suffix_order(text, np.ones(len(text), bool), 104)
        whole = text.tobytes() + b"\x00\x01"
        assert [whole[i : i + 104] for i in order] == sorted(whole[i : i + 104] for i in range(len(text)))


def test_leaks(spark, sf_dir, docs):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = {r["item_id"]: r["text"].lower() for r in items.collect()}
    rows = found(queries.QUERIES["op4_qgram_leaks"](spark, sf_dir))
    for doc, text in docs.items():
        assert {i for i, t in texts.items() if t in text.lower()} <= set(rows[doc]["item_ids"])


def test_edited_leak_and_none(spark):
    item = "the quick brown fox jumps over the lazy dog while seven wizards brew strong coffee at dawn"
    edited = item.replace("brown", "brwn").replace("seven", "sevven")
    docs = spark.createDataFrame([(1, "x " * 50 + edited.upper() + " y" * 50), (2, "nothing of it " * 30), (3, None)], "doc_id int, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "tiny")], "item_id bigint, text string")
    rows = found(queries.leaks.find_leaks(docs, bench))
    assert {x["item_id"] for x in rows[1]["leaks"]} == {7} and not rows[2]["leaks"] and not rows[3]["leaks"]
    assert leaks.without_leaks(docs, bench).count() == 2
    assert leaks.without_leaks(docs, bench.limit(0)).count() == 3


@pytest.mark.parametrize("low, high, replaced", [(8, 23, 0.0), (24, 59, 0.0), (60, 87, 0.8), (88, 250, 1.0)])
def test_leak_recall(low, high, replaced):
    """Random items in random texts: unchanged, as a part of 13 words, with one replaced word, or not at all."""
    dice = random.Random(low)
    words = ["".join(dice.choices("abcdefghijklmnop", k=dice.randint(3, 9))) for _ in range(3000)]
    items = {}
    while len(items) < 60:
        item = " ".join(dice.choices(words, k=dice.randint(2, 40)))
        if low <= len(item) <= high:
            items[len(items)] = item
    index = leaks.Index(leaks.segments(list(items.items())))

    def caught(item=""):
        host = dice.choices(words, k=150)
        host.insert(dice.randrange(150), item)
        text = " ".join(host)
        return {i for i, _, _ in index.search(text)} - {i for i, t in items.items() if t != item and f" {t} " in f" {text} "}

    changed = 0
    for i, item in items.items():
        parts = item.split()
        assert caught(item) == {i} and not caught()
        assert not caught(f"x{item}x") or len(item) >= leaks.EXACT
        if len(parts) >= 26:
            at = dice.randrange(len(parts) - 12)
            part = " ".join(parts[at : at + 13])
            assert len(part) < 1.5 * leaks.SEGMENT or caught(part) == {i}
        parts[dice.randrange(len(parts))] = dice.choice(words)
        changed += i in caught(" ".join(parts))
    assert changed >= replaced * len(items)


def test_language(spark):
    rows = [(i, text * 20, lang) for i, (text, lang) in enumerate([("the house is over there with them ", "en"), ("der hund und die katze sind nicht hier ", "de")] * 4)]
    docs = spark.createDataFrame([*rows, (90, None, None), (91, "123 !?", "en")], "doc_id bigint, text string, lang string")
    pred = found(hyper_lang.identify(docs, hyper_lang.prototypes(docs)))
    assert all(pred[i]["lang_pred"] == lang for i, _, lang in rows)
    assert pred[90]["lang_pred"] == pred[91]["lang_pred"] == "und"
    assert {r["lang_pred"] for r in hyper_lang.identify(docs, {}).collect()} == {"und"}


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    pred = found(hyper_lang.op6_hyper_lang(spark, sf))
    rows = spark.read.parquet(f"{sf}/documents.parquet").where("lang IS NOT NULL").select("doc_id", "lang").collect()
    held = [pred[r["doc_id"]]["lang_pred"] == r["lang"] for r in rows if pred[r["doc_id"]]["held_out"]]
    assert len(held) > 200 and sum(held) >= 0.95 * len(held)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    scores = found(toxicity.op5_toxicity(spark, sf))
    marks = [(r["toxic"], scores[r["doc_id"]]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [(t, s["predicted"]) for t, s in marks if s["held_out"]]
    assert all(0 <= s["score"] <= 1 for s in scores.values())
    caught, toxic, flagged = sum(t == p == 1 for t, p in held), sum(t == 1 for t, _ in held), sum(p for _, p in held)
    assert toxic > 50 and caught >= 0.85 * toxic and caught >= 0.95 * flagged


def test_audit_statuses(spark):
    leaf = "file_id bigint, seq int, rec_offset bigint, rec_length bigint, digest string"
    rows = [(f, s, s * 10, 10, f"d{f}-{s}") for f in range(3) for s in range(300)]
    other = [r if r[:2] != (1, 17) else (*r[:4], "bad") for r in rows if r[:2] != (2, 299)] + [(3, 0, 0, 10, "new")]
    found_ = fixity.audit(fixity.tree(spark.createDataFrame(rows, leaf)), fixity.tree(spark.createDataFrame(other, leaf)))
    assert {(r["file_id"], r["seq"], r["status"]) for r in found_.collect()} == {(1, 17, "corrupt"), (2, 299, "missing"), (3, 0, "extra")}


def test_awkward_rows(spark, awkward, empty):
    bench = spark.createDataFrame([(1, "some benchmark item that is long enough")], "item_id bigint, text string")
    runs = [
        secrets.scan,
        site_lines.spread_lines,
        lambda d: leaks.find_leaks(d, bench),
        lambda d: hyper_lang.identify(d, {}),
        lambda d: minhash.near_duplicates(d, minhash.Plan()),
        weak_rules.weigh,
        lambda d: bpe.encode_decode(d, bpe.vocabulary()),
        repeats.without_repeats,
        lambda d: toxicity.fit(d.selectExpr("doc_id", "text", "CAST(NULL AS INT) AS toxic")).score(d, "p"),
    ]
    for run in runs:
        assert run(awkward).count() == awkward.count()
        assert run(empty).count() == 0
    assert minhash.one_of_each(awkward).columns == awkward.columns
    assert minhash.one_of_each(awkward).count() == awkward.count() - 1  # one of the two long copies goes


def test_filter_before_joins_loses_no_row(spark):
    docs = spark.createDataFrame([(i, "a", True) for i in range(2000)] + [(None, "b", None)], "doc_id bigint, _word string, _bits boolean")
    rows = texts.may_be_among(docs, docs["doc_id"], docs.where("doc_id % 7 = 0").select("doc_id"), "flag")
    assert rows.columns == [*docs.columns, "flag"] and rows.count() == 2001
    marked = {r["doc_id"] for r in rows.where("flag").collect()}
    assert set(range(0, 2000, 7)) <= marked and len(marked) < 400
    assert texts.may_be_among(docs, docs["doc_id"], docs.limit(0).select("doc_id"), "flag").where("flag").isEmpty()


def test_pages_of_mostly_boilerplate_are_cleaned(spark):
    """Pipeline rule: only a document without any line of its own stays whole. The pages are two thirds
    shared, too much for the half rule and too little for near copies."""
    import corpus_pipeline

    shared = " ".join(f"shared{i}" for i in range(60))
    own = [" ".join(f"own{i}x{j}" for j in range(30)) for i in range(12)]
    rows = [(i, f"{shared}\n{own[i]}\n", f"s{i}") for i in range(12)]
    rows += [(50, f"{shared}\n\n", "s0"), (51, "nothing shared", "s1")]
    out = found(corpus_pipeline.remove_boilerplate(spark, spark.createDataFrame(rows, "doc_id bigint, text string, source string"), ""))
    assert {i: r["text"] for i, r in out.items()} == {i: f"{own[i]}\n" if i < 12 else t for i, t, _ in rows}


@pytest.mark.parametrize("n", [3, 4, 6, 8, 10, 12])
def test_query_removes_passages_of_a_few_sites(spark, n):
    """The registered rule, on a passage of most of each page; two sites and a wholly shared page are left."""
    shared, pair = (" ".join(f"{name}{i}" for i in range(60)) for name in ("shared", "pair"))
    rows = [(i, f"own line {i}\n{shared}", f"s{i}") for i in range(n)]
    rows += [(50, shared, "s0"), (51, f"one\n{pair}", "s1"), (52, f"other\n{pair}", "s2"), (53, None, None)]
    out = found(site_lines.spread_lines(spark.createDataFrame(rows, "doc_id bigint, text string, source string")))
    assert {i: (r["text"], r["n_removed"]) for i, r in out.items()} == {i: (f"own line {i}", 1) if i < n else (t, 0) for i, t, _ in rows}


def test_long_passages_of_a_few_different_pages(spark):
    """Long lines go from three sites on, short ones from ten, and pages copied to several sites keep theirs."""
    import corpus_pipeline

    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    rows, want = [], {}

    def page(site, text, left):
        rows.append((len(rows), text, site))
        want[len(rows) - 1] = left

    for n in (3, 5, 9, 12):  # a passage in n different pages
        for i in range(n):
            own = words(f"own{n}x{i}x", 30)
            page(f"s{i}", f"{own}\n{words(f'passage{n}x', 60)}", own)
    for i in range(4):  # one hot site and two others
        own = words(f"hot{i}x", 30)
        page("s0" if i < 2 else f"s{i}", f"{own}\n{words('common', 60)}", own)
    for i in range(5):  # few words, or two sites only
        for text in (f"{words(f'few{i}x', 30)}\nread more here", f"{words(f'pair{i}x', 30)}\n{words('two', 60)}"):
            page(f"s{i}" if "read" in text else f"s{i % 2}", text, text)
    for i in range(12):  # near copies of one page
        text = f"{words('copied', 60)}\n{words('again', 60)}\nnumber {i}"
        page(f"s{i}", text, text)
    out = found(corpus_pipeline.remove_boilerplate(spark, spark.createDataFrame(rows, "doc_id bigint, text string, source string"), ""))
    assert {i: r["text"] for i, r in out.items()} == want


def without_lines(rows):
    """The pipeline's line rule, plainly: rows are (doc_id, text, source)."""
    groups = {d: c for d, (_, c) in components({d: t for d, t, _ in rows}, 5, 80).items()}
    sites, held = collections.defaultdict(set), collections.defaultdict(set)
    for d, text, source in rows:
        for line in filter(None, map(str.strip, text.split("\n"))):
            sites[line].add(source)
            held[line].add(groups[d])
    wide = {x for x in sites if (len(sites[x]) >= 3 and len(held[x]) >= 3 if len(x.split()) >= 8 else len(sites[x]) >= 10)}
    out = {}
    for d, text, _ in rows:
        lines = text.split("\n")
        whole = all(x.strip() in wide for x in lines if x.strip())
        out[d] = text if whole else "\n".join(x for x in lines if x.strip() not in wide)
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    """Columns, ids and texts after each of the five stages, and the tokens of what is left."""
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    dice = random.Random(11)
    letters = lambda n: ["".join(dice.choices("abcdefghij", k=6)) for _ in range(n)]
    item = " ".join(letters(30))
    rows, toxic = [], set()
    for i in range(200):
        text = " ".join(letters(40))
        if i % 3 == 0:
            words = letters(40)
            for _ in range(12):
                words.insert(dice.randrange(len(words)), dice.choice(["zorgon", "blatter", "grunkle"]))
            text, toxic = " ".join(words), toxic | {i}
        elif i % 10 == 1:
            text += "\nread more here"
        elif i % 40 == 2:
            text += "\n" + " ".join(["passage", *map("{}th".format, range(30))])
        elif i % 50 == 5:
            text += f" {item} " + " ".join(letters(5))
        rows.append((i, text, f"s{i // 10}"))
    plain = [r for r in rows if r[0] not in toxic]
    rows += [(300 + i, plain[i][1], "s1") for i in range(3)]  # copies, and copies with one more word
    rows += [(310 + i, plain[10 + i][1] + " end", "s2") for i in range(3)]
    spark.createDataFrame([(d, t, s, len(t)) for d, t, s in rows], "doc_id bigint, text string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i in toxic)) for i in range(200)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    steps = [{d: t for d, t, _ in rows if d not in toxic}]
    steps.append(without_lines([r for r in rows if r[0] in steps[0]]))
    steps.append({d: steps[1][d] for d, (_, c) in components(steps[1], 5, 80).items() if c == d})
    steps.append({d: t for d, t in steps[2].items() if item not in t})
    assert steps[1] != steps[0] and len({len(s) for s in steps} | {len(rows)}) == 4

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES, [*steps, None]):
        docs = cut_lineage(stage(spark, docs, str(tmp_path)))
        got = found(docs)
        assert docs.count() == len(got)
        if want is not None:
            assert docs.columns == columns, name
            assert {d: (r["text"], r["n_chars"]) for d, r in got.items()} == {d: (t, len(t)) for d, t in want.items()}, name
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: library.encode(t, add_special_tokens=False).ids for d, t in steps[3].items()}
    assert {d: (r["n_tokens"], r["ids_sha256"]) for d, r in got.items()} == {d: (len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for d, x in ids.items()}


def test_other_text_of_a_dropped_doc_id_stays(spark):
    copied, other = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    docs = spark.createDataFrame([(1, copied), (5, copied), (5, other)], "doc_id bigint, text string")
    assert sorted(map(tuple, minhash.one_of_each(docs).collect())) == [(1, copied), (5, other)]


def test_settled_buckets_of_near_copies_ask_for_no_texts(spark):
    joint = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "node bigint, component bigint")
    shared = spark.createDataFrame([(0, 7, n, 1, 3) for n in (1, 2, 3)], "band int, key bigint, node bigint, first bigint, rows bigint")
    assert minhash._block_links(shared, joint, None, None, minhash.Plan(3, 85)).collect() == []


def test_workers_import_no_models():
    """Python workers import the module with the features; the driver's model classes took 27 MB of each."""
    code = "import sys, shelfline.llm.toxicity; print(sorted({'pyspark.ml', 'pandas'} & set(sys.modules)))"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.strip() == "[]"


def test_lexicon_starts_no_python_rows(spark, monkeypatch):
    """Rows made on the driver go through Python workers of another kind, which stay beside the others."""
    training = toxicity.labelled(*(texts.table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels")))
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: pytest.fail("rows from the driver"))
    words = toxicity.lexicon(training)
    assert 0 < len(words) <= toxicity.LEXICON_WORDS and min(words.values()) > 2


def test_remembered_pieces_are_few_and_frequent_ones_stay(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 20)
    known = bpe._Pieces(bpe._loaded(bpe.vocabulary()))
    calls = []
    monkeypatch.setattr(bpe, "_stream", lambda merges, data, f=bpe._stream: calls.append(data) or f(merges, data))
    plain = {f"w{i}": ",".join(known.names[t] for t in known.merges.merge(f"w{i}".encode())) for i in range(200)}
    for piece, ids in plain.items():
        assert known[piece] == ids and known["often"] and len(known) + len(known.earlier) <= 20
    assert calls.count(b"often") == 1


def test_unknown_pieces_are_merged_together(monkeypatch):
    """Words that are new are the cost of BPE; one call for each took most of 962 CPU seconds a GB."""
    import public_tokenizers
    from tokenizers import Tokenizer

    plain, merges = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), bpe._loaded(bpe.vocabulary())
    calls = []
    monkeypatch.setattr(bpe, "_stream", lambda merges, data, f=bpe._stream: calls.append(data) or f(merges, data))
    dice = random.Random(3)
    text = " ".join("".join(dice.choices("etaoinshéß'1", k=dice.randint(1, 12))) for _ in range(4000))
    got = ",".join(bpe.Encoder(merges).feed(text, True))
    assert got == ",".join(map(str, plain.encode(text, add_special_tokens=False).ids))
    assert len(calls) < len(set(bpe.PIECES.findall(text))) / 5


def test_many_short_texts_share_a_look_up(monkeypatch):
    merges, texts_ = bpe._loaded(bpe.vocabulary()), ["", None, *(f"word{i}s of{i * 7}" for i in range(3000)), "<|endoftext|>", "a" * 9000, "x"]
    want = [",".join(bpe.Encoder(merges).feed(t or "", True)) for t in texts_]
    for size in (1, 500, bpe.BATCH_CHARS):
        monkeypatch.setattr(bpe, "BATCH_CHARS", size)
        rows, parts = [], []
        for part in bpe._chunks(merges, bpe._Pieces(merges), texts_):
            if part is None:
                rows.append(",".join(parts))
            parts = [] if part is None else [*parts, part]
        assert rows == want and not parts


def test_rows_of_pieces_merge_as_single_ones():
    merges, dice = bpe._loaded(bpe.vocabulary()), random.Random(8)
    for length in (1, 2, 3, 7, 30, 64):
        for letters in (b"ab", b" etaoin", bytes(range(256))):
            data = [bytes(dice.choices(letters, k=length)) for _ in range(60)]
            found = {}
            for rows, ids in merges.merge_rows(np.frombuffer(b"".join(data), np.uint8).reshape(-1, length)):
                found |= dict(zip(rows.tolist(), ids.tolist()))
            assert [found[i] for i in range(60)] == [[merges.ids[t] for t in merges.merge(d)] for d in data]
            assert [merges.joined(np.array(found[i])) for i in range(60)] == data


def test_bpe_pieces_are_those_of_the_given_pattern():
    import public_tokenizers
    import regex

    dice = random.Random(4)
    for _ in range(3000):
        text = "".join(dice.choices(["'", "s", "t", "re", "ll", "'d", "S", " ", "  ", "\n", "7", "²", "é", "日", "!", "\u00a0", "\x85", "̈"], k=12))
        assert bpe.PIECES.findall(text) == regex.findall(public_tokenizers.PATTERN, text)


def test_pipeline_sends_small_batches(spark, sf_dir):
    """Each of the pipeline's stages, also when it is called alone."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = texts.table(spark, sf_dir, "documents").limit(20)
    before = spark.conf.get(setting)
    try:
        for name, stage in corpus_pipeline.STAGES[-2:]:
            spark.conf.set(setting, "64m")
            stage(spark, docs, sf_dir)
            assert int(spark.conf.get(setting)) <= texts.GROUP_BYTES, name
        rows = spark.range(0, 10_000, 1, 1).selectExpr("id AS doc_id", "repeat('x', 2000) AS text")
        sizes = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n bigint").collect()
        assert sum(r["n"] for r in sizes) > 20_000_000 and max(r["n"] for r in sizes) < 2 * texts.GROUP_BYTES
    finally:
        spark.conf.set(setting, before)


def test_ids_are_stored_in_few_files(spark, monkeypatch):
    """As many as the cores ask for, not the shuffle partitions; components come out the same."""
    chain = [(i, i + 1) for i in range(0, 40) if i % 10 != 9]
    counts, partitions = [], "spark.sql.shuffle.partitions"
    before, plain = spark.conf.get(partitions), cut_lineage
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    monkeypatch.setattr(component_rounds, "cut_lineage", lambda df, **k: counts.append((out := plain(df, **k)).rdd.getNumPartitions()) or out)
    try:
        spark.conf.set(partitions, "211")
        spark.conf.set(merging, "false")
        found = component_rounds.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()
    finally:
        spark.conf.set(partitions, before)
        spark.conf.unset(merging)
    assert {r["node"]: r["component"] for r in found} == {i: i // 10 * 10 for i in range(40)}
    assert max(counts) <= FILES_PER_CORE * spark.sparkContext.defaultParallelism < 211
