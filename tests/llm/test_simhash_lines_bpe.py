from __future__ import annotations

import collections
import hashlib
import itertools
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from corpuslab.llm import bpe, lines, simhash
from corpuslab.llm.common import ship
from corpuslab.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, key string, part int, id int, fp string"


def table(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    ship(spark)
    return spark.createDataFrame([(i, t, "k", 1, 2, "f") for i, t in rows], DOCS)


# ---- SimHash ----


def plain_print(text):
    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 4]), 42) for k in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, links):
    root = {k: k for k in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {k: find(k) for k in prints}


def test_golay_decoding_finds_the_nearest_codeword():
    rng = np.random.default_rng(1)
    index = rng.integers(0, 4096, 300)
    code = np.array([next(w for w in [i << 11 | s for s in [int(simhash._syndrome(np.array([i << 11]))[0])]]) for i in index])
    assert (simhash._syndrome(code) == 0).all()
    for weight in range(4):
        for _ in range(3):
            error = sum(1 << int(b) for b in rng.choice(23, weight, replace=False))
            assert (simhash.own(code ^ error) == index).all()


def test_every_word_within_two_bits_shares_a_near_index():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 23, 200)
    for weight in (1, 2):
        other = words ^ np.array([sum(1 << int(b) for b in rng.choice(23, weight, replace=False)) for _ in words])
        a, b = (collections.defaultdict(set) for _ in range(2))
        for found, side in ((simhash.near(words), a), (simhash.near(other), b)):
            for row, index in zip(*found, strict=True):
                side[int(row)].add(int(index))
        assert all(a[k] & b[k] for k in range(len(words)))
        assert {len(x) for x in a.values()} <= {1, 6}


def test_all_error_patterns_of_four_bits_meet_in_a_key():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    other = base.copy()
    for k in range(len(base)):
        for b in rng.choice(64, rng.integers(1, 5), replace=False):
            other[k] ^= np.uint64(1) << np.uint64(b)
    index, probe = simhash.fuzzy_keys(base)[0], simhash.fuzzy_keys(other)[1]
    met = set(zip(*(x.tolist() for x in index), strict=True)) & set(zip(*(x.tolist() for x in probe), strict=True))
    assert {row for row, _ in met} == set(range(len(base)))


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(120):
        base = [rng.choice(words) for _ in range(60)]
        rows.append((3 * i, " ".join(base)))
        for j in (1, 2):
            base[rng.randrange(60)] = "x"
            rows.append((3 * i + j, " ".join(base)))
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "One"), (1004, "oNE"), (1005, "é É"), (1006, "word " * 30_000)]
    prints = {i: plain_print(t) for i, t in rows}
    close = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = plain_components(prints, close)
    got = {r.doc_id: r for r in simhash.near_duplicates(table(spark, rows)).collect()}
    assert len(got) == len(rows) and len(close) > 30
    assert {i: r.fp % (1 << 64) for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == want


def test_keys_are_not_broadcast(spark):
    """Spark knows the table of fingerprints, not how many keys they have."""
    ship(spark)
    prints = simhash.materialise(spark.createDataFrame([(5,), (7,), (-1,)], "fp long"), "prints")
    found = simhash.links(prints)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert [tuple(r) for r in found.collect()] == [(5, 7)]


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (7, "a b c d e"), (None, "a b c d e"), (None, "other words are here now")]
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(table(spark, rows)).collect()), key=repr)
    assert got == sorted([(5, 5), (5, 5), (7, 5), (None, 5), (None, None)], key=repr)
    kept = simhash.one_of_each(table(spark, rows))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([5, None, None], key=repr)
    assert kept.columns == table(spark, rows).columns
    assert simhash.near_duplicates(table(spark, [])).count() == 0


# ---- lines ----


def plain_lines(rows, least):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({a: a + 32 for a in range(65, 91)})
    count = collections.Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} - {""})
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        kept = [x for x in parts if not (key(x) and count[key(x)] >= least)]
        out.append((i, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=repr)


def test_lines_equal_brute_force(spark):
    rng = random.Random(5)
    pool = ["Read more", " read MORE\t", "É", "é", "", "  ", "\x0b\x0c", "a\rb", " x", "Terms"] + [f"line {k}" for k in range(30)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for i in range(60)]
    rows += [(3, "Terms\nTerms\nown"), (None, "Terms\nonly"), (None, None), (99, "x" * 200_000 + "\nterms")]
    got = lines.drop_frequent_lines(table(spark, rows), min_docs=4)
    assert got.columns[:6] == table(spark, rows).columns
    assert sorted(((r.doc_id, r._kept_text, r._n_lines, r._n_dropped) for r in got.collect()), key=repr) == plain_lines(rows, 4)
    assert lines.drop_frequent_lines(table(spark, [])).count() == 0


# ---- BPE ----


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path())
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def encoder():
    with open(tokenizer_path(), encoding="utf-8") as file:
        return bpe.Bpe(file.read())


def same(encoder, reference, texts):
    for (n, ids, back), want in zip(encoder.encode(texts), reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids == " ".join(map(str, want.ids)) and n == len(want.ids)
        assert back == reference.decode(want.ids, skip_special_tokens=False) == encoder.decode(want.ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcdehilnorstABCΣσİßé'’.,!#019 \n\t\x1c\x85 中ª½👍<|>") | st.characters(max_codepoint=0x24F), max_size=40), max_size=8))
def test_codec_equals_the_library(encoder, reference, texts):
    same(encoder, reference, texts)


def test_codec_on_special_cases(encoder, reference):
    same(encoder, reference, ["", "aaaa aaaaa !!!!!", "<|endoftext|>x<|startoftext|>", "It's WE'RE ΣΑΣ", "é ﬁ", "xy" * 20_000])


def test_one_by_one_merges_keep_the_order_of_single_merges(encoder):
    """A rank whose result pairs at a lower rank is applied word by word, leftmost first, like single merges."""
    spec = {
        "added_tokens": [], "normalizer": {"normalizers": [{"type": "NFC"}, {"type": "Replace"}, {"type": "Lowercase"}]},
        "pre_tokenizer": {"pretokenizers": [{"type": "Split", "pattern": {"Regex": "[a-z]+"}}, {"type": "ByteLevel"}]},
    }
    signs = bpe.byte_symbols()
    vocab = {s: k for k, s in enumerate(signs + [s + "</w>" for s in signs] + ["abc", "bc", "abca", "ab"])}
    spec["model"] = {"type": "BPE", "vocab": vocab, "end_of_word_suffix": "</w>", "merges": [["abc", "a"], ["b", "c"], ["a", "bc"]]}
    import json

    own = bpe.Bpe(json.dumps(spec))
    assert own.one_by_one == {2}
    assert own.encode(["abcabcx"])[0][2] == "abca bc x</w>"


def test_codec_rows(spark, reference):
    rows = [(1, None), (1, ""), (None, "Hello  world"), (2, "Hello  world")]
    docs = table(spark, rows).withColumnRenamed("fp", "_ids")
    got = bpe.encode(docs, tokenizer_path())
    assert got.columns == ["doc_id", "text", "key", "part", "id", "_n_tokens", "_ids", "_decoded"]
    ids = " ".join(map(str, reference.encode("Hello  world", add_special_tokens=False).ids))
    assert sorted(((r.doc_id, r._n_tokens, r._ids) for r in got.collect()), key=repr) == sorted([(1, 0, ""), (1, 0, ""), (None, 2, ids), (2, 2, ids)], key=repr)
    digest = bpe.digests(docs, tokenizer_path()).where("doc_id = 2").first()
    assert digest.ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
    assert bpe.digests(table(spark, []), tokenizer_path()).count() == 0
