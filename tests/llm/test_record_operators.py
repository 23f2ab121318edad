"""Decontamination, chat formatting, URL filters, the pipeline and the query catalogue."""

import hashlib
import itertools
import os
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tillwise.llm import chat, decontaminate, packing, quality, secrets, simhash, urls
from ..conftest import SF
from .conftest import messy_rows, prose
from .test_text_operators import brute_print, brute_quality, brute_roots, brute_spans


# ---- decontamination ----------------------------------------------------------------------

ITEMS = [(i, prose(700 + i, 12, 2000) + ("\n" if i % 2 else " ") + prose(800 + i, 15, 2000)) for i in range(30)] + [
    (100, None), (101, ""), (102, "!!! ... \n"), (103, "word"), (None, prose(990, 25, 2000)), (104, ITEM := prose(991, 200, 2000)), (105, ITEM)]


def brute_leaks(text, index):
    """All passages beside all items, with the same scores."""
    words = [index.vocab.get(w, -1) for w in decontaminate.words_of(text or "")]
    best = {}
    for at in range(0, max(1, len(words)), index.cell):
        for start in (at - index.cell, at):
            passage = words[max(0, start): max(0, start) + 2 * index.cell]
            for i in range(len(index.ids)):
                score = round(sum(w for t, w in zip(index.terms[i].tolist(), index.weights[i].tolist()) if t in passage), 9)
                over = [index.overlap(p, passage) for p in index.parts[i]]
                if score >= decontaminate.THRESHOLD and min(over) >= decontaminate.MIN_OVERLAP:
                    best[i] = max(best.get(i, (0,)), (score, *over))
    return [(index.ids[i], *best[i]) for i in sorted(best)]


def test_leaks(spark, messy, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rng = np.random.default_rng(1)
    texts = [t for _, t in messy_rows() if t is None or len(t) < 50_000]
    for i in range(30):
        words = ITEMS[i][1].split()
        texts += [prose(i, 40 + 9 * i, 2000) + " " + " ".join(words) + " " + prose(50 + i, 30, 2000),
                  " ".join(words[: len(words) // 2]) + " " + prose(i, 50), " ".join(rng.permutation(words)),
                  ITEMS[i][1].upper().replace(" ", ", ") + "."]
    texts += [ITEM, ITEM[:500], prose(3, 5000, 2000) + " " + ITEM + " tail"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = defaultdict(list)
    for r in decontaminate.find_leaks(docs, items).collect():
        got[r.doc_id].append((r.item_id, r.score, r.question_overlap, r.answer_overlap))
    (index,) = decontaminate.indexes(items)
    for i, t in enumerate(texts):
        assert sorted(got[i], key=str) == sorted(brute_leaks(t, index), key=str)
    n = len(texts) - 123
    for i in range(30):
        assert i in {x[0] for x in got[n + 4 * i]} and i in {x[0] for x in got[n + 4 * i + 3]}
        assert i not in {x[0] for x in got[n + 4 * i + 1]} and i not in {x[0] for x in got[n + 4 * i + 2]}
    assert {x[0] for x in got[len(texts) - 1]} == {104, 105}
    assert decontaminate.find_leaks(empty, items).count() == 0
    none = items.where("false")
    assert decontaminate.find_leaks(messy, none).count() == 0 and decontaminate.keep_clean(messy, none).count() == messy.count()
    assert decontaminate.keep_clean(messy, items).columns == messy.columns


def test_leaks_in_parts(spark, monkeypatch):
    """More parts of the index find the same."""
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(i, prose(i, 60, 2000) + " " + t) for i, t in ITEMS if t], "doc_id long, text string")
    whole = {tuple(r[:2]): round(r.score, 6) for r in decontaminate.find_leaks(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "PART_ITEMS", 8)
    assert len(list(decontaminate.indexes(items))) > 2
    assert {tuple(r[:2]): round(r.score, 6) for r in decontaminate.find_leaks(docs, items).collect()} == whole and len(whole) >= 30


def test_leaks_do_not_depend_on_size_or_files(spark, monkeypatch):
    """600 items, which are split into parts, in two file layouts; question and answer of an item stand some hundred words apart."""
    rows = [(i, prose(3000 + i, 12, 3000) + "\n" + prose(4000 + i, 12, 3000)) for i in range(599)] + [(599, prose(5000, 300, 3000) + "\n" + prose(5001, 300, 3000))]
    texts = [q + " " + prose(7000 + i, 250, 3000) + " " + a for i, (q, a) in ((i, rows[i][1].split("\n")) for i in range(0, 599, 60))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = []
    for items in (rows, rows[300:] + rows[:300]):
        frame = spark.createDataFrame(items, "item_id long, text string").repartition(1 + len(found) * 5)
        found.append(sorted(tuple(r) for r in decontaminate.find_leaks(docs, frame).collect()))
    assert found[0] == found[1] and len(found[0]) == len(texts)
    monkeypatch.setattr(decontaminate, "CELLS", 1)
    monkeypatch.setattr(decontaminate, "PART_ITEMS", 10 ** 6)
    assert sorted(tuple(r) for r in decontaminate.find_leaks(docs, frame).collect()) == found[0]


# ---- chat ---------------------------------------------------------------------------------

TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi <|im_start|> there"), (1, 2, "assistant", "</s>[INST] ok [/INST] <\\/s> [\\\\INST]"),
    (2, 0, "assistant", "first"), (2, 1, "user", None), (3, 5, "user", "late"), (3, None, None, "no role"), (3, 5, "assistant", "tie"),
    (4, 0, "user", "x"), (4, 0, "user", "x"), (None, 0, "user", ""), (None, 1, "assistant", "<|im_sep|>a<|im_end|>é🙂$1\\2"), (5, 0, "user<|im_sep|>\n", "<"), (5, 1, "assistant", "|im_end|><"),
]


def test_chat(spark):
    df = spark.createDataFrame([(*r, 1, "x") for r in TURNS], "conv_id long, turn long, role string, text string, state int, turns string")
    out = chat.format_conversations(df)
    got = {r.conv_id: r for r in out.select("*", chat.read_turns(out["formatted"]).alias("read"), chat.read_loss(out["segments"]).alias("loss")).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    for c, r in got.items():
        rows = sorted(((t is not None, t or 0), role or "", text or "") for k, t, role, text in TURNS if k == c)
        assert [(x.role, x.text) for x in r.read] == [(a, b) for _, a, b in rows]
        assert r.loss == "".join(b for _, a, b in rows if a == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(rows) and "</s>" not in r.formatted
        state = "start"
        for _, role, _ in rows:
            state = chat.TEMPLATE["moves"].get((state, role), "broken")
        assert r.state == state and r.valid == (state in chat.TEMPLATE["accept"])
    assert got[1].valid and not got[2].valid and not got[4].valid
    assert chat.format_conversations(df.where("false")).count() == 0


def test_chat_query(spark):
    got = {r.conv_id: r for r in E.queries()["op7_chat_formatting"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    said = "</s>[INST] ok [/INST]"
    talks = defaultdict(list)
    for r in [*map(tuple, rows), (-7, 0, "user", said), (-7, 1, "assistant", said)]:
        talks[r[0]].append((r[1], r[2], r[3] or ""))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert set(got) == set(talks)
    for c, turns in talks.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))


# ---- urls ---------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme/net/", "http://net/", "http://net", "https://a.B.NET/x", "https://example.net/en/1", "https://sub.example.net/en", "https://xexample.net/en/1", "http://example.com/de/", "http://www.example.com/de",
    "http://w.example.com/de/x?y#z", "http://example.com?u=http://net/", "http://a.org/fr/1", "http://org/fr/", "http://a.org/FR/1", "x://y://z.net/", "://net/", "http://net:80/", "http://é.net/ü", "http://a.net/\nen", "http://net/?", "http://x.com/a.net/",
]


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [h + p for h, p, _ in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


def brute_mined(pages, labels):
    """Rules by counting every token set of bad labelled pages."""
    tokens = defaultdict(list)
    for i, t in pages:
        tokens[i].append(frozenset(t))
    seen = [(held, q == 0 or t == 1) for d, q, t in labels for held in tokens.get(d, ())]
    bad = Counter(c for held, is_bad in seen if is_bad for n in range(1, len(held) + 1) for c in itertools.combinations(sorted(held), n))
    often = {c: n for c, n in bad.items() if n >= urls.MIN_PAGES}
    return [set(c) for c, n in often.items() if n / sum(set(c) <= held for held, _ in seen) >= urls.MIN_CONFIDENCE]


def test_url_rules(spark):
    rows = list(enumerate(URLS)) + [(3, URLS[3])]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, tokens string").select("page_id", "url")
    got = urls.judge(pages, labels).collect()
    assert len(got) == len(rows)
    verdicts = {h + p: v for h, p, v in urls.RULES}
    for r in got:
        host, path, rule = brute_rule(URLS[r.page_id])
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdicts.get(rule, "allow")), URLS[r.page_id]
    assert urls.judge(pages.where("false"), labels).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_url_mining(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", urls.tokens_of(urls.F.col("url")).alias("tokens")).collect()
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    rules = brute_mined([(r.page_id, r.tokens) for r in pages], labels)
    verdicts = {h + p: v for h, p, v in urls.RULES}
    got = {r.page_id: r for r in E.queries()["op8_url_filters"](spark, sf).collect()}
    assert len(got) == len(pages)
    for r in pages:
        host, path, rule = brute_rule(r.url)
        hit = any(x <= set(r.tokens) for x in rules)
        assert (got[r.page_id].host, got[r.page_id].path, got[r.page_id].rule) == (host, path, rule)
        assert got[r.page_id].verdict == verdicts.get(rule, "block" if hit else "allow")


def url_fixture():
    """A bad host far below one page in a hundred, tokens that are bad only four together, one bad page too few, null and repeated labels."""
    urls_, labels = [], []

    def add(url, bad, n=1):
        for _ in range(n):
            labels.append((len(urls_), 0 if bad else 1, 0))
            urls_.append(url)
    add("http://spam.example/a", True, 12)
    add("http://few.example/a", True, 9)
    for left in range(5):
        parts = [p for i, p in enumerate("wxyz") if i != left]
        add("https://shop.example/" + "/".join(parts), left == 4, 12)
    add("https://fine.example/p/q?id=1#top", False, 2500)
    urls_ += ["http://spam.example/other", "https://shop.example/z/y/x/w/new", "https://shop.example/x/y/z", "http://few.example/b", None, "no url"]
    labels += [(0, None, 1), (None, 0, 1), (3, 0, None), (10 ** 9, 0, 0), (len(urls_) - 1, None, None)]
    return list(enumerate(urls_)), labels


def test_url_mining_decides(spark):
    pages, labels = url_fixture()
    frame = spark.createDataFrame(pages, "page_id long, url string")
    known = frame.select("page_id", urls.tokens_of(urls.F.col("url")).alias("tokens")).collect()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = brute_mined([(r.page_id, r.tokens) for r in known], labels)
    assert any(len(r) >= 4 for r in rules) and {"host:spam"} in rules and not any("host:few" in r for r in rules)
    got = {r.page_id: r for r in urls.judge(frame, marks).collect()}
    verdicts = {h + p: v for h, p, v in urls.RULES}
    for r in known:
        rule = brute_rule(pages[r.page_id][1])[2]
        assert got[r.page_id].verdict == verdicts.get(rule, "block" if any(x <= set(r.tokens) for x in rules) else "allow"), pages[r.page_id]
    at = len(pages) - 6
    assert [got[at + k].verdict for k in range(6)] == ["block", "block", "allow", "allow", "allow", "allow"]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", pages)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    assert sorted(con.execute(E.oracle_sql()["op8_url_filters"]).fetchall()) == sorted((i, r.host, r.path, r.rule, r.verdict) for i, r in got.items())


# ---- pipeline and catalogue ---------------------------------------------------------------

def test_pipeline_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}

    def good(t):
        q = brute_quality(t)
        return not (q["n_words"] < 50 or 100 * q["n_repeat_words"] > 50 * q["n_words"] or q["dup_line_chars"] > quality.MAX_LINE_SHARE * q["line_chars"]
                    or any(q[f"dup_chars_{n}"] > s * q["word_chars"] for n, s in quality.MAX_RUN_SHARE.items()))

    want = {d for d, t in rows.items() if good(t)}
    ids = sorted(want)
    want = {ids[i] for i in set(brute_roots([brute_print(rows[d]) for d in ids]))}
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    joined = lambda w: b" " + b" ".join(w) + b" "
    want = {d for d in want if not any(joined(w) in joined(decontaminate.words_of(rows[d])) for w in items if w)}
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF)
        assert left.columns == docs.columns, name
    left = {r.doc_id: r for r in left.collect()}
    assert set(left) == want and 0 < len(want) < len(rows)
    for d, r in left.items():
        assert (r.text == rows[d]) == (not brute_spans(rows[d])[1]) and r.n_chars == len(r.text)
        assert not any(rows[d][a:e] in r.text for a, e, _ in brute_spans(rows[d])[0])
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == want
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_catalogue():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


LLM_ORACLES = [n for n in E.oracle_sql() if re.match(r"op\d+_", n)]


@pytest.mark.parametrize("name", LLM_ORACLES)
def test_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    df = E.queries()[name](spark, SF)
    want = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(str, map(tuple, df.select(*cols).collect()))) == sorted(map(str, want.fetchall()))


def test_url_rule_of_four_tokens(spark):
    """Four tokens that are bad only together make a rule."""
    bad, good = "http://a.b/c/d", ("http://z.b/c/d", "http://a.z/c/d", "http://a.b/z/d", "http://a.b/c/z")
    urls_ = [bad] * 3 + [u for u in good for _ in range(3)]
    pages = spark.createDataFrame([*enumerate(urls_), (99, bad + "/e")], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(u != bad), 0) for i, u in enumerate(urls_)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in urls.judge(pages, labels, min_pages=3).collect()}
    assert got == {i: "block" if i < 3 or i == 99 else "allow" for i in got} and len(got) == 16
