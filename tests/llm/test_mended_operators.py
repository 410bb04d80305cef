"""Cases that earlier rounds got wrong: rows that share ids, large records, block sizes, dates and cards; pseudonyms against plain Python."""

from __future__ import annotations

import datetime as dt
import hashlib
import itertools
import random
import re
import struct

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpuslab.llm import factorisation as fm, latent, lines, pseudonyms as ps, simhash, warc
from corpuslab.llm.common import ship

# ---- pseudonyms in plain Python ----


def keyed(key, kind, r, value):
    return hashlib.sha256("|".join([key, kind, str(r), str(value), key]).encode()).hexdigest()


def parts(a, b, radix, key, kind):
    for r in range(8):
        if r % 2 == 0:
            a = (a + int(keyed(key, kind, r, b)[:14], 16)) % radix[0]
        else:
            b = (b + int(keyed(key, kind, r, a)[:14], 16)) % radix[1]
    return a, b


def shift(text, digest):
    out = []
    for at, c in enumerate(text):
        by = int(digest[at % 32 * 2 : at % 32 * 2 + 2], 16)
        for first, n in (("0", 10), ("A", 26), ("a", 26)):
            if first <= c <= chr(ord(first) + n - 1):
                c = chr((ord(c) - ord(first) + by) % n + ord(first))
                break
        out.append(c)
    return "".join(out)


def signs(text, key, kind):
    a, b = text[: len(text) // 2], text[len(text) // 2 :]
    for r in range(8):
        if r % 2 == 0:
            a = shift(a, keyed(key, kind, r, b))
        else:
            b = shift(b, keyed(key, kind, r, a))
    return a + b


def luhn(digits):
    return sum(d - 9 * (d > 9) for d in (int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits)))) % 10 == 0


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def fill(template, fresh):
    left = iter(fresh)
    return "".join(next(left) if c.isalnum() else c for c in template)


EPOCH = dt.date(1800, 1, 1)


def plain_value(kind, m, key):
    """Pseudonym of a match, None if it is not valid."""
    digits = "".join(c for c in m if c.isdigit())
    if kind == "email":
        local, _, host = m.partition("@")
        return f"{signs(local, key, kind)}@{host}"
    if kind == "phone":
        if not 7 <= len(digits) <= 15:
            return None
        kept = max(len(digits) - 10, int(m.startswith("+")))
        return fill(m, digits[:kept] + signs(digits[kept:], key, kind))
    if kind == "iban":
        plain = m.replace(" ", "")
        account = signs(plain[4:], key, kind)
        return fill(m, f"{plain[:2]}{98 - mod97(account + plain[:2] + '00'):02d}{account}") if mod97(plain[4:] + plain[:4]) == 1 else None
    if kind == "card":
        payload = signs(digits[:-1], key, kind)
        return fill(m, payload + next(c for c in "0123456789" if luhn(payload + c))) if luhn(digits) else None
    if kind == "ip":
        o = [int(x) for x in m.split(".")]
        if max(o) > 255:
            return None
        a, b = parts(o[0] * 256 + o[1], o[2] * 256 + o[3], (65536, 65536), key, kind)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if kind == "ssn":
        area, group, serial = int(m[:3]), int(m[4:6]), int(m[7:])
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        a, b = parts(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, (898, 99 * 9999), key, kind)
        return f"{a + 1 + (a + 1 >= 666):03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"
    forms = ["%Y-%m-%d"] if "-" in m else ["%d.%m.%Y"] if "." in m else ["%d/%m/%Y" if m[:2] > "12" else "%m/%d/%Y"]
    try:
        number = (dt.datetime.strptime(m, forms[0]).date() - EPOCH).days
    except ValueError:
        return None
    if not 0 <= number < 189 * 773:
        return None
    while True:
        a, b = parts(number // 773, number % 773, (189, 773), key, "date")
        number = a * 773 + b
        day = EPOCH + dt.timedelta(number)
        if forms[0] != "%d/%m/%Y" or day.day > 12:
            return {"%Y-%m-%d": f"{day.year}-{day.month:02d}-{day.day:02d}", "%d.%m.%Y": f"{day.day:02d}.{day.month:02d}.{day.year}", "%m/%d/%Y": f"{day.month:02d}/{day.day:02d}/{day.year}", "%d/%m/%Y": f"{day.day:02d}/{day.month:02d}/{day.year}"}[forms[0]]


ASKED = [(kind, re.compile(f"(?:{p})", re.ASCII)) for kind, p in ps.PATTERNS.items()]
LENGTHS = {c: n for n, names in ps.IBAN_SIGNS.items() for c in names.split()}


def next_match(text, at):
    for k in range(at, len(text)):
        for kind, pattern in ASKED:
            if m := pattern.match(text, k):
                return kind, m
    return None


def usual(digits):
    wanted = 15 if digits[:2] in ("34", "37") else 16 if digits[:1] in ("2", "4", "5", "6") else 0
    return len(digits) == wanted


def valid_reading(kind, m):
    plain = re.sub("[ -]", "", m)
    if kind == "iban":
        return 15 <= len(plain) <= 34 and LENGTHS.get(plain[:2], len(plain)) == len(plain) and mod97(plain[4:] + plain[:4]) == 1
    return 13 <= len(plain) <= 19 and luhn(plain)


def parted(text):
    """The text with a sign behind every shorter reading, as long as there are any."""
    while True:
        out, at, more = [], 0, False
        while found := next_match(text, at):
            kind, m = found
            value, cut = m[0], None
            if kind in ("iban", "card") and len(value) > 13:
                short = [n for n in range(len(value) - 1, 11, -1) if value[n] in " -" and valid_reading(kind, value[:n])]
                best = [n for n in short if kind == "card" and usual(re.sub("[ -]", "", value[:n]))]
                if best and not usual(re.sub("[ -]", "", value)):
                    cut = best[0]
                elif short and not valid_reading(kind, value):
                    cut = short[0]
            out.append(text[at : m.start()] + (value if cut is None else value[:cut] + "" + value[cut:]))
            more, at = more or cut is not None, m.end()
        text = "".join(out) + text[at:]
        if not more:
            return text


def plain_pseudonyms(text, key):
    if text is None:
        return None, 0
    text, out, at, n = parted(text), [], 0, 0
    while found := next_match(text, at):
        kind, m = found
        value = plain_value(kind, m[0], key)
        n += value is not None
        out.append(text[at : m.start()] + (m[0] if value is None else value))
        at = m.end()
    return ("".join(out) + text[at:]).replace("", ""), n


def changed(spark, texts, key="k"):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r.doc_id: (r.text, r._n_private) for r in ps.pseudonymise(docs, key).collect()}


def test_whole_texts_equal_plain_python(spark, sf):
    rng = random.Random(2)
    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004", "340000000000009", "6011 0000 0000 0004", "4222222222222", "4111111111111112"]
    values = [*cards, "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 33", "a.b-7@mail7.example.com", "10.0.0.1", "300.1.1.1", "2024-02-29", "2023-02-29",
              "29.02.2024", "12/31/2020", "31/12/2020", "05/03/2020", "13/13/2020", "123-45-6789", "666-45-6789", "+1 (017) 555-7713", "(030) 123 4567", "+49 30 1234 5678", "+123456"]
    after = [" ", ", ", " 123 ", " 12/27 ", ".", " OK ", "T08:00 ", "\n", "-1 ", " 4567 "]
    texts = ["".join(rng.choice(values) + rng.choice(after) for _ in range(rng.randint(1, 5))) for _ in range(150)]
    texts += [None, "", "no value", "4111 1111 1111 1111 " * 400, "1 2 3 4 5 6 7 8 9 0 " * 300]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 3000").select("text").collect()]
    got = changed(spark, texts, "secret")
    for k, text in enumerate(texts):
        assert got[k] == plain_pseudonyms(text, "secret"), text


def test_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "10.0.0.1", "x", 2)] * 3 + [(None, "10.0.0.1", "x", 2)], "doc_id int, text string, _seen string, _n_private int")
    assert {(r.text, r._n_private) for r in ps.pseudonymise(docs, "k").collect()} == {(plain_pseudonyms("10.0.0.1", "k")[0], 1)}


def test_no_two_dates_share_a_pseudonym(spark):
    days = spark.range(0, 189 * 773, 3).select(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    forms = {"yyyy-MM-dd": "\\d{4}-", "dd.MM.yyyy": "\\d\\d\\.", "MM/dd/yyyy": "\\d\\d/", "dd/MM/yyyy": "\\d\\d/"}
    texts = None
    for form in forms:
        part = days.select(F.date_format("d", form).alias("text"))
        texts = part if texts is None else texts.union(part)
    asked = texts.distinct()
    made = ps.pseudonymise(asked, "k")
    total = asked.count()
    counted = made.agg(F.count_distinct("text").alias("n"), F.sum("_n_private").alias("p")).first()
    assert (counted["n"], counted["p"]) == (total, total)


def test_a_card_keeps_its_pseudonym_before_every_number(spark):
    texts = [f"4111 1111 1111 1111 {k:03d}" for k in range(1000)]
    got = changed(spark, texts)
    assert len({t[:19] for t, _ in got.values()}) == 1 and all(got[k][0].endswith(f" {k:03d}") for k in range(1000))


# ---- WARC: records of any size, folders as URIs, text ids ----


def first_dictionary(path):
    with open(path.removeprefix("file:"), "rb") as f:
        magic, size = struct.unpack("<II", f.read(8))
    assert magic == warc.DICTIONARY_MAGIC
    return size


@pytest.mark.parametrize("n, size", [(40, 300_000), (3, 2_000_000), (1, 500), (200, 900)])
def test_archives_of_any_record_size_have_a_dictionary(spark, out, n, size):
    rng = random.Random(size)
    words = ["<div class='item'>", "</div>", "article", "footer", "lorem", "ipsum"] + [f"w{k}" for k in range(400)]
    one = lambda: "".join(rng.choices(words, k=size // 7))[:size]
    pages = spark.createDataFrame([(f"page/{k} >", "http://x", one()) for k in range(n)], "page_id string, url string, html string").repartition(1)
    ship(spark)
    found = warc.write_archives(pages, f"file:{out}")
    assert all(first_dictionary(r.path) > 100 for r in found.collect())
    back = {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(found, id_type="string").collect()}
    assert back == {r.page_id: r.html for r in pages.collect()}


def test_samples_are_bounded_and_spread():
    records = [bytes([k]) * 100_000 for k in range(100)]
    found = warc.samples(records, 1 << 20, 8 << 10)
    assert sum(map(len, found)) <= 1 << 20 and len({x[0] for x in found}) == 100
    assert warc.dictionary_of([b""]) is None and warc.samples([]) == []


# ---- rows that share or lack an id ----


def test_unrelated_texts_of_one_id_stay(spark):
    ship(spark)
    a, b, c = ("red fox jumps over some lazy dog " * 9, "completely other words are in this long row " * 9, "third text about nothing at all in here " * 9)
    rows = [(1, a), (1, b), (1, b), (2, a), (3, c), (None, a), (None, a), (4, b + " x"), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, root int")
    for one in (simhash.one_of_each, simhash.one_of_similar):
        got = sorted(((r.doc_id, r.text) for r in one(docs).collect()), key=repr)
        assert got == sorted([(1, a), (1, b), (3, c), (None, a), (None, a), (5, None)], key=repr), one
        assert one(docs).columns == docs.columns and one(docs.limit(0)).count() == 0


def test_lines_of_rows_without_an_id(spark):
    ship(spark)
    rows = [(None, f"own {k}\nshared\n") for k in range(30)] + [(7, f"seven {k}\nshared") for k in range(30)] + [(k, f"row {k}\nnot shared") for k in range(100, 105)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r._kept_text for r in lines.drop_frequent_lines(docs).collect())
    assert got == sorted([f"own {k}\n" for k in range(30)] + [f"seven {k}" for k in range(30)] + [f"row {k}\nnot shared" for k in range(100, 105)])


def test_a_labelled_id_with_many_rows_counts_once(spark):
    ship(spark)
    base = [(k, f"good clean prose number {k} and more" if k % 2 else "$$$ spam ### %%%", None) for k in range(20)]
    many = base + [(2, f"row {k} of a repeated id", None) for k in range(10_000)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    counted = []
    kept = fm.train
    model = fm.fit(spark.createDataFrame(many, "doc_id long, text string, n_chars long"), labels)
    again = fm.fit(spark.createDataFrame(list(reversed(many)), "doc_id long, text string, n_chars long"), labels)
    assert np.array_equal(model.linear, again.linear) and fm.train is kept and not counted
    assert abs(model.bias) < 3


# ---- latent retrieval: ids of any type, blocks of any number ----


def test_blocks_agree_and_ids_may_be_text(spark):
    ship(spark)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [(f"item-{k}", " ".join(word() for _ in range(rng.randint(8, 30)))) for k in range(250)]
    items += [(None, "null item has some words of its own here"), ("item-3", items[3][1]), ("none", None)]
    docs = []
    for k in range(120):
        text = " ".join(word() for _ in range(60))
        if k % 3 == 0:
            text = f"{text} {items[k][1]} {text[:50]}"
        docs.append((None if k % 10 == 9 else k, text))
    left = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, overlap int")
    right = spark.createDataFrame(items, "item_id string, text string")
    pairs = {}
    for size in (100, 1000):
        found = latent.contaminated(left, right, settings=latent.Settings(block_items=size))
        assert found.schema["item_id"].dataType.simpleString() == "string"
        pairs[size] = sorted(((r.doc_id, r.item_id) for r in found.collect()), key=repr)
        stays = latent.clean(left, right, settings=latent.Settings(block_items=size))
        gone = sorted({t for _, t in docs} - {r.text for r in stays.collect()})
        hit = {i for i, _ in pairs[size]}
        assert gone == sorted(t for k, (i, t) in enumerate(docs) if k % 3 == 0) and stays.columns == left.columns
        assert {i for i, t in docs if t in gone} == hit
    assert pairs[100] == pairs[1000]
    assert {i for _, i in pairs[100]} >= {f"item-{k}" for k in range(0, 120, 3)}


# ---- near-duplicates by similarity ----


def plain_similar(texts, least=0.8):
    sets = [set(zip(*(w[k:] for k in range(min(5, len(w)))), strict=False)) if (w := (t or "").lower().split()) else set() for t in texts]
    links = []
    for a, b in itertools.combinations(range(len(texts)), 2):
        both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if not union or both >= least * union:
            links.append((a, b, 1.0 if not union else both / union))
    return links


def test_similar_groups_hold_the_links_and_no_others(spark):
    ship(spark)
    rng = random.Random(12)
    vocabulary = [f"word{k}" for k in range(300)]
    texts = []
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 400))]
        texts.append(" ".join(base))
        for share in (0.003, 0.01, 0.02, 0.03, 0.05):
            texts.append(" ".join(w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in base))
    texts += [None, "", " \n", "one two", "ONE two", "one two three", "x " * 5000, "x x x x x x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = {r.doc_id: r.root for r in simhash.similar_groups(docs).collect()}
    links = plain_similar(texts)
    found = [(a, b) for a, b, _ in links if root[a] == root[b]]
    assert len(links) > 150 and len(found) >= 0.97 * len(links)
    # no group holds documents that links do not connect
    least = list(range(len(texts)))
    for _ in texts:
        for a, b, _ in links:
            least[a] = least[b] = min(least[a], least[b])
    groups = {}
    for k in range(len(texts)):
        groups.setdefault(root[k], set()).add(least[k])
    assert all(len(g) == 1 for g in groups.values())


def test_a_group_of_near_copies_is_not_paired(spark, monkeypatch):
    ship(spark)
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**5)}" for _ in range(300)]
    texts = [" ".join([*base[:k], f"own{k}", *base[k + 1 :]]) for k in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    kept = simhash._verified
    monkeypatch.setattr(simhash, "_verified", lambda p, pairs, least: (seen.append(pairs.count()), kept(p, pairs, least))[1])
    assert len({r.root for r in simhash.similar_groups(docs).collect()}) == 1
    assert sum(seen) < 20 * len(texts)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=115, max_size=115))
def test_near_codewords_are_those_that_fit_best(values):
    found = simhash.near_codewords(np.array([values + [0] * 13]))[0]
    code = np.where(simhash._CODE > 0, -1, 1)  # plus one where a bit is set
    for word in range(5):
        fit = code @ np.array(values[word * 23 : word * 23 + 23])
        assert fit[found[word]].tolist() == sorted(fit, reverse=True)[:4]
