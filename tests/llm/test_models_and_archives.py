from __future__ import annotations

import base64
import hashlib
import io
import itertools
import random
import struct
from collections import Counter

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings, strategies as st

from corpuslab.llm import crosspolytope as cp, factorisation as fm, latent, pseudonyms, warc
from corpuslab.llm.common import ship

# ---- WARC ----

PAGES = "page_id long, url string, html string, path string, _first int"


def pages(spark, rows):
    ship(spark)
    return spark.createDataFrame([(i, f"http://x/{i}\n", h, "p", 1) for i, h in rows], PAGES)


def test_archives_round_trip(spark):
    rng = random.Random(1)
    body = lambda: "<p>" + " ".join(rng.choice(["the", "dog", "é", "runs"]) for _ in range(80)) + "</p>"
    rows = [(i, body()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(50)] + [(400, None), (401, ""), (402, "x\r\n\r\ny"), (403, "z" * 300_000), (7, rows[7][1]), (None, rows[7][1]), (None, "alone")]
    found = warc.write_archives(pages(spark, rows), archive_bytes=20_000)
    assert found.count() > 5 and found.agg({"n_records": "sum"}).first()[0] == len(rows)
    first = {}
    for i, h in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault((h or "").encode(), i)
    want = []
    for i, h in rows:
        raw = (h or "").encode()
        again = first.get(raw) not in (None, i)
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((i, len(raw), sha, "revisit" if again else "response", first[raw] if again else None, None if again else raw))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload)) for r in warc.read_archives(found).collect()]
    blank = lambda r: (*r[:5], r[5] or None)
    assert sorted(map(blank, got), key=repr) == sorted(map(blank, want), key=repr)
    assert warc.read_archives(warc.write_archives(pages(spark, []))).count() == 0


def test_small_payloads_are_never_revisits(spark):
    found = warc.read_archives(warc.write_archives(pages(spark, [(1, "ab"), (2, "ab"), (3, "abc"), (4, "abc")]), min_bytes=3))
    assert {r.page_id: r.refers_to for r in found.collect()} == {1: None, 2: None, 3: None, 4: 3}


def test_layout_of_an_archive():
    records = [warc.record(b"response", k, "u", f"<p>{k} some html text for the page</p>".encode() * 9, "S", None, "d") for k in range(200)]
    raw = b"".join(warc.archive(records))
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D and size > 1000
    packer = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + size]))
    one = packer.decompressobj()
    assert one.decompress(raw[8 + size :]) == records[0] and one.unused_data  # a frame for each record
    assert list(warc.expand(io.BytesIO(raw))) == records
    plain = sum(len(zstandard.compress(r)) for r in records)
    assert len(raw) - size < 0.8 * plain
    with pytest.raises(Exception):
        list(warc.expand(io.BytesIO(raw[:-5])))


# ---- embeddings ----


def vectors(spark, rows):
    ship(spark)
    return spark.createDataFrame([(i, v, 1, b"n") for i, v in rows], "vec_id long, embedding array<float>, label int, node binary")


def plain_links(rows, least=0.9):
    good = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = {k: np.array(rows[k][1], np.float32).astype(float) for k in good}
    x = {k: v / np.linalg.norm(v) for k, v in x.items()}
    return [(a, b) for a, b in itertools.combinations(good, 2) if len(x[a]) == len(x[b]) and x[a] @ x[b] >= least]


def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows, at = [], 0
    for _ in range(60):
        base = rng.standard_normal(48)
        for spread in (0, 0.05, 0.1, 0.3):
            rows.append((at, (base + spread * rng.standard_normal(48) * np.sqrt(2)).astype(np.float32).tolist()))
            at += 1
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, None), (503, []), (504, [0.0] * 48), (505, [float("nan")] + [1.0] * 47), (506, [None] + [1.0] * 47), (507, [float("inf")] * 48)]
    rows += [(508, [1.0, 2.0]), (509, [2.0, 4.0]), (510, [1e-30] * 48), (511, [1e30] * 48), (512, [3.0]), (513, [5.0])]
    links = plain_links(rows)
    ids = [i for i, _ in rows]
    degree, root = dict.fromkeys(ids, 0), {i: i for i in ids}
    for a, b in links:
        for k in (a, b):
            degree[ids[k]] += 1
    for _ in ids:
        for a, b in links:
            root[ids[a]] = root[ids[b]] = min(root[ids[a]], root[ids[b]])
    got = {r.vec_id: r for r in cp.near_duplicates(vectors(spark, rows)).collect()}
    assert len(links) > 100
    assert {i: r.n_links for i, r in got.items()} == degree
    assert {i: r.component_id for i, r in got.items()} == root


def test_vector_rows_without_or_with_equal_ids(spark):
    one = [1.0, 2.0, 3.0, 4.0]
    got = cp.near_duplicates(vectors(spark, [(4, one), (4, one), (9, one), (None, one)])).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == sorted([(4, 2, 4), (4, 2, 4), (9, 2, 4), (None, 0, None)], key=repr)
    assert cp.near_duplicates(vectors(spark, [])).count() == 0


@pytest.mark.parametrize("size", [16, 48, 64, 300])
def test_recall_at_the_threshold(size):
    rng = np.random.default_rng(size)
    x = cp.unit(rng.standard_normal((1500, size)))
    side = rng.standard_normal((1500, size))
    side = cp.unit(side - (side * x).sum(axis=1, keepdims=True) * x)
    (ix, px), (iy, py) = (cp.keys(v, cp.Settings()) for v in (x, 0.9 * x + np.sqrt(1 - 0.81) * side))
    found = (ix[:, :, None] == py).any((1, 2)) | (iy[:, :, None] == px).any((1, 2))
    assert found.mean() >= 0.95
    assert np.allclose(np.linalg.norm(cp.rotate(x, 1, 0), axis=1), 1)


# ---- factorisation machine ----


def test_the_identity_gives_the_pairwise_sum():
    rng = np.random.default_rng(3)
    model = fm.Machine(0.3, rng.normal(size=fm.N_FEATURES), rng.normal(size=(fm.N_FEATURES, 4)) * 0.3)
    rows = [(rng.choice(fm.N_FEATURES, n, replace=False).astype(np.int32), rng.normal(size=n)) for n in (1, 2, 7, 30)]
    for (ids, x), got in zip(rows, model.score(rows), strict=True):
        pairs = sum(model.factors[i] @ model.factors[j] * a * b for (i, a), (j, b) in itertools.combinations(zip(ids, x, strict=True), 2))
        assert got == pytest.approx(1 / (1 + np.exp(-(0.3 + model.linear[ids] @ x + pairs))))
    again = fm.Machine.unpack(model.pack())
    assert again.score(rows) == pytest.approx(model.score(rows), abs=1e-4)


def test_held_out_accuracy(spark, sf):
    ship(spark)
    docs, labels = (spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/{t}.parquet") for t in ("documents", "labels"))
    model = fm.fit(docs, labels.where(fm.held_in()))
    scored = fm.score(docs, model).join(labels, "doc_id").where(~fm.held_in()).select("_score", "quality").toPandas()
    assert len(scored) > 100 and ((scored._score >= 0.5) == (scored.quality == 1)).mean() > 0.95


def test_scores_of_odd_rows_and_without_labels(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, None, None, "a", 0.1), (1, "", 0, "b", 0.2), (None, "x " * 40_000, -5, "c", 0.3), (2, "", 0, "b", 0.2)], "doc_id long, text string, n_chars long, _id string, _score double")
    labels = spark.createDataFrame([(1, 7), (None, 1)], "doc_id long, quality int")
    got = fm.score(docs, fm.fit(docs, labels)).collect()
    assert len(got) == 4 and {r._score for r in got} == {0.5}
    taught = spark.createDataFrame([(1, 1), (1, 0), (99, 0)], "doc_id long, quality int")
    got = fm.score(docs, fm.fit(docs, taught)).collect()
    assert all(0 <= r._score <= 1 for r in got)
    empty = docs.limit(0)
    assert fm.score(empty, fm.fit(empty, labels)).count() == 0


# ---- latent retrieval ----


def plain_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _step(row, x, b)
    return row[-1]


def _step(row, x, b):
    new = [0]
    for k, y in enumerate(b):
        new.append(row[k] + 1 if x == y else max(row[k + 1], new[-1]))
    return new


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.lists(st.integers(0, 5), max_size=60))
def test_common_subsequence(item, words):
    assert latent.common_subsequence(item, words) == plain_subsequence(item, words)


def test_paraphrased_items_are_found_and_clean_documents_kept(spark):
    ship(spark)
    rng = random.Random(6)
    words = [f"w{k}" for k in range(3000)]
    common = ["the", "of", "and", "a", "is"]
    make = lambda n: [rng.choice(words if rng.random() < 0.5 else common) for _ in range(n)]
    items = [make(rng.randrange(15, 60)) for _ in range(40)] + [make(200)]
    rows, want = [], set()
    for i in range(160):
        text = make(rng.randrange(300))
        if i % 4 == 0:
            item = (i // 4) % len(items)
            inside = [w for w in items[item] if rng.random() > 0.08]  # words left out
            inside = [rng.choice(words) if rng.random() < 0.05 else w for w in inside]  # or replaced
            at = rng.randrange(len(text) + 1)
            text = text[:at] + [w.upper() + "," for w in inside] + text[at:]
            want.add((i, item))
        rows.append((i, " ".join(text), "x"))
    rows += [(500, None, "x"), (501, "", "x"), (502, "the of and " * 5000, "x"), (7, rows[7][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, terms string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(900, None), (901, " ")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in latent.contaminated(docs, bench).collect()}
    assert got == want
    blocks = {(r.doc_id, r.item_id) for r in latent.contaminated(docs, bench, settings=latent.Settings(block_items=15)).collect()}
    assert len(blocks ^ want) <= 1
    kept = latent.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, _ in rows if i not in {d for d, _ in want})
    assert latent.clean(docs.limit(0), bench).count() == 0
    assert latent.clean(docs, bench.limit(0)).count() == len(rows)


def plain_matches(item, words, weights):
    """Whether a stretch of about the item's length holds enough of the item, of its weight and of its answer."""
    n = len(item)
    tail, total = item[n - -(-n // 5) :], sum(weights[w] for w in item)
    for at in range(len(words)):
        part = [w for w in words[at : at + max(n + 4, int(n * 1.6))] if w in item]
        if len(part) < 0.6 * n or words[at] not in item or latent.common_subsequence(item, part) < 0.6 * n:
            continue
        share = sum(weights[w] * k for w, k in (Counter(part) & Counter(item)).items())
        if share >= 0.3 * total and latent.common_subsequence(tail, part) >= 0.4 * len(tail):
            return True
    return False


def test_a_thousand_short_items_in_one_block_equal_brute_force(spark):
    ship(spark)
    rng = np.random.default_rng(12)
    odds = 1 / np.arange(10, 4010)
    make = lambda n: rng.choice(4000, n, p=odds / odds.sum()).tolist()
    items = [make(rng.integers(10, 28)) for _ in range(1000)] + [make(n) for n in (1, 70, 300)]
    docs = []
    for at in range(0, 1000, 4):
        text = make(5)
        for item in items[at : at + 4]:
            keep = 1.0 if at % 8 else rng.uniform(0.6, 1)
            text += [w if rng.random() < keep else int(rng.integers(4000)) for w in item] + make(rng.integers(40))
        docs.append(text)
    docs.append(make(50) + items[-1] + make(50) + items[-2])
    passages = [set(x[k : k + 64]) for x in docs for k in range(0, len(x), 64)]
    weights = np.log((len(passages) + 1) / (np.bincount([w for p in passages for w in p], minlength=4000) + 1)) + 1e-9
    counts, want = np.array([np.bincount(x, minlength=4000) for x in items], np.int16), set()
    for d, x in enumerate(docs):
        used = np.unique(x)
        shared = np.minimum(counts[:, used], np.bincount(x, minlength=4000)[used]).sum(axis=1)
        want |= {(d, i) for i in np.flatnonzero(shared >= 0.6 * counts.sum(axis=1)).tolist() if plain_matches(items[i], x, weights)}
    assert {(i // 4, i) for i in range(1000) if i // 4 % 2} <= want and len(want) > 850
    text = lambda x: " ".join(f"w{w}" for w in x)
    table = spark.createDataFrame([(k, text(x)) for k, x in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, text(x)) for k, x in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in latent.contaminated(table, bench).collect()}
    assert want <= got and len(got - want) <= len(want) // 50  # stretches may be a quarter of an item longer


def test_randomised_svd_equals_the_dense_one(spark):
    ship(spark)
    rng = np.random.default_rng(8)
    found = [rng.integers(0, 25, rng.integers(3, 30)).tolist() for _ in range(60)]
    idf = rng.uniform(0.5, 3, 25)
    table = spark.createDataFrame([(x,) for x in found], "terms array<bigint>")
    space, values = latent.randomised_svd(table, idf, 10, 15)
    dense = np.zeros((60, 25))
    for k, x in enumerate(found):
        np.add.at(dense[k], x, 1.0)
    dense *= idf
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    _, s, v = np.linalg.svd(dense)
    assert values == pytest.approx(s[:10], rel=1e-6)
    assert np.abs((space * v[:10].T).sum(axis=0)) == pytest.approx(np.ones(10), abs=1e-4)


# ---- pseudonyms ----


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def changed(spark, texts, key="secret"):
    docs = spark.createDataFrame([(k, t, "n") for k, t in enumerate(texts)], "doc_id int, text string, _kinds string")
    return {r.doc_id: r for r in pseudonyms.pseudonymise(docs, key).collect()}


def test_pseudonyms_keep_format_and_links(spark):
    texts = ["pay 4111 1111 1111 1111 or 4111111111111111.", "again 4111-1111-1111-1111", "no 4111111111111112", "mail A.b-7@mail7.example.com!", "ip 10.0.0.1, 300.0.0.1 1.2.3.4.5",
             "2024-02-29 29.02.2024 02/29/2024", "2023-02-29 31.04.2024", "123-45-6789 666-45-6789", "+1 (017) 555-7713", "DE89 3704 0044 0532 0130 00 DE88370400440532013000", None, "", "v1.2 in 1999", "4111111111111111" * 2000]
    got = changed(spark, texts)
    a, b = got[0].text.split(" or ")
    assert a[4:].replace(" ", "") == b[:-1] and luhn(b[:-1]) and b[:-1] != "4111111111111111"
    assert got[1].text.split()[1].replace("-", "") == b[:-1]
    assert [got[k].text for k in (2, 6, 10, 11, 12, 13)] == [texts[k] for k in (2, 6, 10, 11, 12, 13)]
    assert got[3].text.endswith("@mail7.example.com!") and got[3].text != texts[3] and got[3].text[6] == "."
    assert got[4].text.endswith(", 300.0.0.1 1.2.3.4.5") and got[4]._n_private == 1
    iso, dotted, slashed = got[5].text.split()
    assert iso == "-".join(reversed(dotted.split("."))) and slashed == f"{iso[5:7]}/{iso[8:]}/{iso[:4]}" and iso != "2024-02-29"
    assert got[7].text.endswith("666-45-6789") and not got[7].text.startswith("123-45-6789")
    assert got[8].text.startswith("+1 (") and len(got[8].text) == len(texts[8]) and got[8].text != texts[8]
    good, bad = got[9].text.rsplit(" ", 1)
    plain = good.replace(" ", "")
    assert bad == "DE88370400440532013000" and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 and good != texts[9][: len(good)]
    assert [got[k]._n_private for k in (0, 2, 5, 10, 11)] == [2, 0, 3, 0, 0] and got[0]._kinds == ["card"]
    assert changed(spark, texts[:1], "other key")[0].text != got[0].text


def test_permutations_have_no_collisions(spark):
    import pyspark.sql.functions as F

    rows = spark.range(5000)
    parts = pseudonyms.permute_parts(F.col("id") % 50, F.floor(F.col("id") / 50), (50, 100), F.lit("k"), "t")
    found = {(r[0].a, r[0].b) for r in rows.select(parts).collect()}
    assert found == {(a, b) for a in range(50) for b in range(100)}
    signs = rows.select(pseudonyms.permute_signs(F.lpad(F.col("id").cast("string"), 5, "0"), F.lit("k"), "t")).collect()
    assert len({r[0] for r in signs}) == 5000 and all(len(r[0]) == 5 and r[0].isdigit() for r in signs)


def test_pseudonyms_of_an_empty_table_and_the_plan(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    out = pseudonyms.pseudonymise(docs, "k")
    assert out.count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_values_followed_by_numbers_and_capitals(spark):
    card, iban = "4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00"
    texts = [
        f"{card} 123", f"{card} 12/27", f"{card}", f"{iban} 12 May", "GB82 WEST 1234 5698 7654 32 OK", iban, "at 2024-01-15T08:00 sharp", "2024-01-15",
        f"{iban} {card} 123", f"{card} 123, 5500 0000 0000 0004 456", f"{card} 12.03.2024", f"\ue000 {card} 123 \ue000\ue000", "4111 1111 1111 1112 123", None, "",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: (r.text, r._n_private) for r in pseudonyms.pseudonymise(docs, "k").collect()}
    fresh, account = got[2][0], got[5][0]
    assert fresh != card and account != iban
    assert got[0] == (f"{fresh} 123", 1) and got[1] == (f"{fresh} 12/27", 1) and got[3] == (f"{account} 12 May", 1)
    assert got[4][1] == 1 and got[4][0].endswith(" OK") and got[4][0] != texts[4]
    assert got[6] == (f"at {got[7][0]}T08:00 sharp", 1) and got[7][0] != texts[7]
    assert got[8] == (f"{account} {fresh} 123", 2)
    assert got[9][1] == 2 and got[9][0].startswith(f"{fresh} 123, ") and got[9][0].endswith(" 456")
    assert got[10][1] == 2 and got[10][0].startswith(fresh)
    assert got[11] == (f"\ue000 {fresh} 123 \ue000\ue000", 1)
    assert [got[k] for k in (12, 13, 14)] == [(texts[12], 0), (None, 0), ("", 0)]
