from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpuslab.llm import ledger, periods, queries, ranking
from corpuslab.llm.common import ship

# ---- blob ledger ----

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
FURTHER = [re.compile(r.pattern) for r in ledger.FURTHER]
KINDS = [r.kind for r in ledger.RULES]


def plain_spans(text):
    """By matching every kind whole and dropping short matches afterwards."""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 16]
    spans += [(m.start(), 3 + k, m.end()) for k, p in enumerate(FURTHER) for m in p.finditer(text)]
    return [(a, KINDS[k], z) for a, k, z in sorted(spans)]


TEXTS = [
    None, "", "no secret", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" and more', "é𝄞 password:abcdefghijkl\nTOKEN='short'",
    "token=passwd = 'abcdefghijklmno'", "secret=token=abcdefghijkl", "api_key: x api-key: abcdefghijklmn API_KEY==abcdefghijkl", "AKIA" * 9 + "é" + "AKIA0123456789ABCD", "AKIA0123456789ABC",
    "0123456789abcde 0123456789abcdef", "deadbeef" * 500, "ghp_" + "a1" * 18 + " xoxb-" + "1-" * 12, "eyJhbGciOiJI.eyJzdWIiOiIxMj.c2lnbmF0dXJl", "-----BEGIN RSA PRIVATE KEY-----\nx",
    "token: abcdefghijkl " * 400,
]


def got(found):
    return sorted(((r["path"], [tuple(f) for f in r["_findings"]]) for r in found.collect()), key=repr)


def versions(spark, rows):
    """Rows with columns whose names the operator uses itself."""
    return spark.createDataFrame([(p, t, 1, "b", [3]) for p, t in rows], "path string, text string, end int, blob string, spans array<int>")


def test_findings_equal_plain_regular_expressions(spark):
    rows = [(f"p{k}", t) for k, t in enumerate(TEXTS)] + [("again", TEXTS[3])] * 3 + [(None, TEXTS[3])]
    found = ledger.scan(versions(spark, rows))
    assert found.columns == ["path", "end", "blob", "spans", "_blob", "_findings"]
    assert got(found) == sorted(((p, plain_spans(t)) for p, t in rows), key=repr)
    assert ledger.scan(versions(spark, [])).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["token", "SECRET", "passwd", "=", ":", " ", '"', "abcdefghijkl", "AKIA", "0123456789ABCDEF", "deadbeef", "é", "\n"]), max_size=30).map("".join))
def test_length_in_the_pattern_is_length_after_matching(text):
    access, hexes = re.compile(ledger.BASE[1].pattern), re.compile(ledger.BASE[2].pattern)
    plain = plain_spans(text)
    assert [(m.start(), "access", m.end()) for m in access.finditer(text)] == [s for s in plain if s[1] == "access"]
    assert [(m.start(), "hex", m.end()) for m in hexes.finditer(text)] == [s for s in plain if s[1] == "hex"]


def test_only_unseen_pairs_are_scanned(spark, out):
    first = versions(spark, [("a", TEXTS[3]), ("b", TEXTS[3]), ("c", "plain")])
    ledger.update(first, out)
    pairs = lambda: sorted((r.blob, tuple(r.rules)) for r in ledger.read_ledger(spark, out).collect())
    assert len(pairs()) == 2  # one row a blob, also without findings
    ledger.update(first, out)
    assert len(pairs()) == 2
    second = versions(spark, [("a", "now token: abcdefghijklmnop"), ("b", TEXTS[3])])
    ledger.update(second, out)
    assert len(pairs()) == 3
    assert got(ledger.findings(first.union(second), out)) == sorted([(p, plain_spans(t)) for p, t in [("a", TEXTS[3]), ("b", TEXTS[3]), ("c", "plain"), ("a", "now token: abcdefghijklmnop"), ("b", TEXTS[3])]], key=repr)
    # a changed rule scans all blobs again, with itself only
    wider = ledger.Rule("hex", "[0-9a-f]{8,}")
    rules = (*ledger.BASE[:2], wider)
    ledger.update(first, out, rules)
    fresh = [r for r in pairs() if r[1] == (wider.version,)]
    assert len(fresh) == 2 and len(pairs()) == 5
    kinds = {k for _, found in got(ledger.findings(first, out, rules)) for _, k, _ in found}
    assert kinds == {"assign", "hex"}
    # a scan that was written twice counts once
    ledger.read_ledger(spark, out).write.parquet(f"{out}/repeated")
    assert got(ledger.findings(first, out)) == sorted([("a", plain_spans(TEXTS[3])), ("b", plain_spans(TEXTS[3])), ("c", [])], key=repr)


def test_ledger_uses_no_python(spark, out):
    rows = versions(spark, [("a", TEXTS[3])])
    ledger.update(rows, out)
    plan = ledger.findings(rows, out)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- periodic runs ----


def plain_runs(words, least=6):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            begin = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - begin + q >= max(least, 4 * q) and i > begin:
                found.setdefault((begin, i - begin + q), q)
            i += i == begin
    return sorted((a, n, q) for (a, n), q in found.items())


def plain_collapse(words):
    gone = {i for a, n, q in plain_runs(words) for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


_cycle = st.tuples(st.lists(st.integers(0, 3), max_size=5), st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12)).map(lambda x: x[0] + x[1] * x[2])
_text = st.lists(_cycle, max_size=4).map(lambda parts: [w for p in parts for w in p])


@settings(max_examples=300, deadline=None)
@given(st.lists(_text, max_size=5))
def test_runs_equal_brute_force(documents):
    want = [(k, *run) for k, d in enumerate(documents) for run in plain_runs(d)]
    found = periods.find_runs([np.array(d, np.int64) for d in documents])
    assert list(zip(*(x.tolist() for x in found), strict=True)) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=300), st.randoms())
def test_grammar_extensions_equal_comparison(symbols, rng):
    grammar = periods.Grammar(np.array([*symbols, 9]))
    pairs = [(a, b) for a, b in ((rng.randrange(len(symbols)), rng.randrange(len(symbols))) for _ in range(60)) if a != b]
    if pairs:
        a, b = np.array(pairs).T
        whole = [*symbols, 9]
        plain = [next(k for k in range(len(whole)) if whole[x + k] != whole[y + k]) for x, y in pairs]
        assert grammar.common(a, b).tolist() == plain


def test_grammar_grows_with_the_logarithm_of_repetition():
    rng = np.random.default_rng(3)
    cycle = rng.integers(0, 50, 200)
    names = [sum(len(np.unique(level.symbols)) for level in periods.Grammar(np.r_[np.tile(cycle, k), 99]).levels) for k in (20, 2000)]
    assert names[1] < 1.5 * names[0]


def test_collapse_of_odd_rows(spark, monkeypatch):
    ship(spark)
    rng = random.Random(5)
    long = " ".join(rng.choice("abcdefgh") for _ in range(3000)) + " x y" * 500 + " é\x0b" * 30
    texts = [None, "", " \n", "a a a a a a", "a a a a a", "a b a b a b a b", "a\x85a " * 9, long, long, "x " * 50_000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "b b b b b b b")]
    docs = spark.createDataFrame([(i, t, 1, []) for i, t in rows], "doc_id long, text string, collapsed int, runs array<int>")
    found = {r["doc_id"]: r for r in periods.collapse(docs).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        if len(words) < 10_000:
            assert [tuple(r) for r in found[i]["runs"]] == plain_runs(words)
            assert found[i]["collapsed"] == plain_collapse(words) and found[i]["n_words"] == len(words)
    assert [tuple(r) for r in found[9]["runs"]] == [(0, 50_000, 1)] and found[9]["collapsed"] == "x"
    assert periods.collapse(docs.limit(0)).count() == 0


def test_longest_run_breaks_ties_by_start_then_period(spark):
    runs = spark.sql("SELECT array(named_struct('start', 5L, 'length', 9L, 'period', 1L), named_struct('start', 2L, 'length', 9L, 'period', 2L), named_struct('start', 2L, 'length', 9L, 'period', 1L)) AS runs")
    assert tuple(runs.select(periods.longest_run(F.col("runs")).alias("r")).first()["r"]) == (2, 9, 1)
    none = runs.select(periods.longest_run(F.slice("runs", 1, 0)).alias("r"), periods.run_lines(F.slice("runs", 1, 0)).alias("t")).first()
    assert none["r"] is None and none["t"] == ""


# ---- NRA ----


def plain_terms(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower)


def plain_search(docs, items, k=10):
    counts = [Counter(plain_terms(t)) for _, t in docs]
    n_docs, n_terms = sum(1 for c in counts if c), sum(c.total() for c in counts)
    df = Counter(w for c in counts for w in c)
    out = []
    for item, text in items:
        scored = []
        for (i, _), c in zip(docs, counts, strict=True):
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms if c else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m)) for w in set(plain_terms(text)) if w in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def tables(spark, docs, items):
    ship(spark)
    left = spark.createDataFrame([(i, t, 1, "r") for i, t in docs], "doc_id long, text string, n int, rank string")
    return left, spark.createDataFrame([(i, t, 2) for i, t in items], "item_id string, text string, score int")


@pytest.mark.parametrize("shard", [1 << 21, 40])
def test_search_equals_full_scores(spark, monkeypatch, shard):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(60)] + ["é", "ñandú"]
    weights = [1 / (1 + k) for k in range(len(words))]
    text = lambda n: " ".join(rng.choices(words, weights, k=n)).replace("w1 ", "W1,")
    docs = [(i, text(rng.randint(1, 60))) for i in range(400)]
    docs += [(1000 + i, "w5 w7 w9") for i in range(30)] + [(2000, None), (2001, ""), (2002, " .,- "), (None, "w5 w7 w9"), (7, "w5 w7 w9"), (2003, "w3 " * 20_000), (2004, "x\x85y w5")]
    rng.shuffle(docs)
    items = [(f"i{k}", text(rng.randint(1, 30))) for k in range(40)] + [("none", None), ("blank", " "), ("strange", "nowhere"), (None, "w5 w9"), ("i0", "w5"), ("i0", "w5")]
    items.append(("every", "w0 w1 w2 w5 w7 w9 x\x85y"))
    left, right = tables(spark, docs, items)
    monkeypatch.setattr(ranking, "BLOCK_ITEMS", 30)
    monkeypatch.setattr(ranking, "SHARD_POSTINGS", shard)
    got = sorted((tuple(r) for r in ranking.search(left, right).collect()), key=repr)
    assert got == plain_search(docs, items)
    assert ranking.search(left.limit(0), right).count() == 0 and ranking.search(left, right.limit(0)).count() == 0


def test_nra_skips_what_cannot_matter():
    """Two long lists whose heads decide: only heads, and the rests for the documents that are left, count."""
    rng = np.random.default_rng(1)
    n = 5000
    docs = np.concatenate([rng.permutation(n), rng.permutation(n)])
    gain = np.concatenate([np.sort(rng.integers(1, 1000, n))[::-1], np.sort(rng.integers(1, 1000, n))[::-1]])
    gain[:20] += 50_000
    lists = ranking.Lists.of(docs, np.repeat([0, 1], n), gain, n, 2)
    total = np.bincount(docs, gain, n).astype(np.int64)
    order = np.lexsort((np.arange(n), -total))[:10]
    best, score = ranking.nra(lists, np.array([0, 1]), 10)
    assert best.tolist() == order.tolist() and score.tolist() == total[order].tolist()
    none, _ = ranking.nra(lists, np.array([0, 1]), 10, floor=int(total.max()) + 1)
    assert not len(none)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 6), st.integers(1, 9)), max_size=120), st.integers(1, 5), st.integers(1, 25))
def test_nra_equals_full_scores_with_ties(postings, k, floor):
    unique = {(d, t): g for d, t, g in postings}
    docs, terms, gain = (np.array(x, np.int64) for x in ([d for d, _ in unique], [t for _, t in unique], list(unique.values())))
    lists = ranking.Lists.of(docs, terms, gain, 31, 7)
    total = np.bincount(docs, gain, 31).astype(np.int64) if len(docs) else np.zeros(31, np.int64)
    order = [d for d in np.lexsort((np.arange(31), -total)).tolist() if total[d] >= floor][:k]
    ranking.FIRST_STEP, was = 1, ranking.FIRST_STEP
    try:
        best, score = ranking.nra(lists, np.arange(7), k, floor)
    finally:
        ranking.FIRST_STEP = was
    assert best.tolist() == order and score.tolist() == total[order].tolist()


# ---- queries ----


def test_cycles_follow_their_rule(spark, sf):
    import zlib

    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()] + [(9990 + k, t) for k, t in enumerate([None, "", "one", "a b c"])]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    changed = {r["doc_id"]: r["text"] for r in queries.with_cycles(table).collect()}
    hit = 0
    for i, text in docs:
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert changed[i] == " ".join(words[j] if j < a else words[a + (j - a) % p] for j in range(n))
            hit += 1
        else:
            assert changed[i] == text
    assert hit > 5


def test_digests_of_the_runs(spark, sf):
    row = next(r for r in queries.op12_recompression_runs(spark, sf).collect() if r["n_runs"] == 0)
    assert row["runs_sha256"] == hashlib.sha256(b"").hexdigest() and row["start"] is None and row["exponent_milli"] is None
