"""Repeated byte strings and word windows against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from corpuslab.llm import anchors, phrases
from corpuslab.llm.common import ship

KIND = "doc_id long, text string, block int, part int, key string, state int"


def table(spark, rows):
    ship(spark)
    return spark.createDataFrame([(i, t, 1, 2, "k", 3) for i, t in rows], KIND)


def corpus(seed):
    """Documents with shared passages, near copies, repeats inside a document, uniform runs and rows without text."""
    rng = random.Random(seed)
    words = ["a", "the", "of", "é", "日本", "x" * 30] + [f"w{k}" for k in range(300)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [make(n) for n in (20, 21, 30, 60)]
    rows = [(2 * i, make(rng.randrange(80)) + " " + rng.choice(shared) + "\n" + make(rng.randrange(40))) for i in range(60)]
    base = make(150)
    rows += [(201 + 2 * k, base[: 37 * k] + "!" + base[37 * k + 1 :]) for k in range(12)]
    rows += [(400, make(30) * 3), (401, "ab" * 400), (402, "ab" * 401), (403, "z" * 1000), (404, None), (405, ""), (406, " \n "), (407, "z" * 99), (408, "q " * 60), (409, "q " * 50)]
    rng.shuffle(rows)
    return rows


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def plain_bytes(rows, width):
    seen, out = set(), {}
    for i, text in order(rows):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - width + 1):
            if raw[k : k + width] in seen:
                gone[k : k + width] = True
            seen.add(raw[k : k + width])
        edges = np.diff(np.r_[0, gone.astype(int), 0])
        out[i] = (len(raw), np.frombuffer(raw, np.uint8)[~gone].tobytes(), np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist())
    return out


def plain_words(rows, width):
    seen, out = set(), {}
    for i, text in order(rows):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - width + 1):
            window = tuple(words[k : k + width])
            if window in seen:
                gone[k : k + width] = [True] * width
            seen.add(window)
        out[i] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("width", [100, 40])
def test_bytes_equal_brute_force(spark, width, monkeypatch):
    rows = corpus(width) + [(None, "once " * 50)]
    got = phrases.drop_repeats(table(spark, rows).repartition(5), width=width).collect()
    want = plain_bytes(rows, width)
    assert len(got) == len(rows) and sum(len(w[2]) for w in want.values()) > 30
    assert {r.id: (r.n_bytes, bytes(r.kept), r.span_starts, r.span_ends) for r in got} == want


@pytest.mark.parametrize("width", [20, 8])
def test_words_equal_brute_force(spark, width):
    rows = corpus(width) + [(None, "once upon " * 30)]
    got = anchors.drop_repeats(table(spark, rows).repartition(5), width=width).collect()
    want = plain_words(rows, width)
    assert sum(w[1] for w in want.values()) > 300
    assert {r.id: (r.n_words, r.n_removed, bytes(r.kept)) for r in got} == want


def test_repeated_ids_and_empty_tables(spark):
    text = " ".join(f"t{k}" for k in range(60))
    rows = [(1, text), (1, text), (1, text + " more"), (None, text), (None, text)]
    got = anchors.drop_repeats(table(spark, rows)).collect()
    assert sorted(r.n_removed for r in got) == [0, 60, 60, 60, 60]
    assert [r.n_removed for r in got if r.id is None].count(0) == 1  # rows without an id come first
    whole = phrases.drop_repeats(table(spark, rows)).collect()
    assert sorted(len(r.kept) for r in whole)[-1] == len(text) and sum(len(r.span_starts) for r in whole) == 4
    again = phrases.drop_repeats(table(spark, rows).repartition(4)).collect()
    assert sorted((r.id or 0, len(r.kept)) for r in whole) == sorted((r.id or 0, len(r.kept)) for r in again)
    assert anchors.drop_repeats(table(spark, [])).count() == phrases.drop_repeats(table(spark, [])).count() == 0


def test_phrases_are_cut_alike_wherever_a_text_stands():
    rng = np.random.default_rng(3)
    core = rng.integers(97, 123, 600).astype(np.uint8)
    cuts = []
    for pad in (0, 137):
        data = np.r_[rng.integers(97, 123, pad).astype(np.uint8), core]
        first, last, at = phrases.triggers(data, np.array([len(data)]), 100)
        assert (np.repeat(at, last - first + 1) - np.arange(first[0], last[-1] + 1) <= 75).all()
        assert first[0] == 0 and last[-1] == len(data) - 100 and (first[1:] == last[:-1] + 1).all()
        cuts.append({int(x) - pad for x in at if x >= pad + 100})
    assert cuts[1] >= {x for x in cuts[0] if x >= 100}
