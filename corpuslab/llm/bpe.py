"""BPE encoding and decoding with a pair occurrence index.

Works with tokenizer files of the ``tokenizers`` library whose model is BPE with an end-of-word suffix behind a
``Split`` and ``ByteLevel`` pre-tokenizer. Words are encoded together, a partition's distinct words at a time: all symbols lie in one
array, linked inside each word; an index maps every pair that has a merge to all its positions. The pairs with the
lowest rank are merged at all their positions at once, and the pairs that arise left and right of them enter
the index, until no pair with a merge is left.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from .common import as_bytes, narrow

#: Words whose encodings a task remembers; beyond, it starts anew. Results don't depend on it.
REMEMBERED = 100_000
#: Texts that are coded at once.
TEXTS = 256


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, else from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    fresh = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(fresh)) for b in range(256)]


# The word pattern of the public word-BPE file. For texts of Latin characters ``re`` says the same faster.
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_CLASSES = r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_OTHER = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]")


class _Numbers(dict):
    """Numbers words in the order of their first look-up."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Bpe:
    """Encoder for one tokenizer definition (the text of its JSON file)."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or [p["type"] for p in pre] != ["Split", "ByteLevel"] or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a word BPE with NFC, white space and lower-case normalisation")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None
        pattern = pre[0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.latin = re.compile(_ENDINGS + "|[^\\W\\d_]+|[0-9]|(?:[^\\w\\s]|_)+") if pattern == _ENDINGS + _CLASSES else None
        symbols = byte_symbols()
        self.plain = np.array([self.vocab[s] for s in symbols], np.int64)
        self.final = np.array([self.vocab[s + self.suffix] for s in symbols], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([self.vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        self.made = np.array([self.vocab[a + b] for a, b in merges], np.int64)
        self.left, self.right, self.base = left, right, max(self.tokens) + 1
        keys = left * self.base + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        # merges whose result takes part in a pair of a lower rank: these are applied one per word at a time
        first = np.full(self.base, len(merges))
        np.minimum.at(first, left, np.arange(len(merges)))
        np.minimum.at(first, right, np.arange(len(merges)))
        self.one_by_one = set(np.nonzero(first[self.made] <= np.arange(len(merges)))[0].tolist())
        self.names = {i: str(i) for i in self.tokens}
        self.forget()

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 where there is none."""
        keys = a * self.base + b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the non-empty words, one after the other, and how many each has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym = self.plain[raw]
        sym[ends - 1] = self.final[raw[ends - 1]]
        n = len(sym)
        word = np.repeat(np.arange(len(words)), sizes)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Put the pairs that begin at these positions into the index."""
            at = at[after[at] >= 0]
            rank = self.ranks(sym[at], sym[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            starts, stops = [0, *cuts.tolist()], [*cuts.tolist(), len(at)]
            for r, start, stop in zip(rank[starts].tolist(), starts, stops, strict=True):
                part = at[start:stop]
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(heap, r)

        enter(np.arange(n))
        while heap:
            rank = heapq.heappop(heap)
            lists = index.pop(rank)
            at = np.sort(np.concatenate(lists))
            a, b = self.left[rank], self.right[rank]
            at = at[np.r_[True, at[1:] != at[:-1]]]  # a position may have entered twice
            at = at[alive[at] & (sym[at] == a) & (after[at] >= 0)]
            at = at[sym[after[at]] == b]
            if rank in self.one_by_one and len(at):
                lead = np.r_[True, word[at[1:]] != word[at[:-1]]]
                if not lead.all():
                    index[rank] = [at[~lead]]
                    heapq.heappush(heap, rank)
                at = at[lead]
            elif a == b and len(at) > 1:  # of overlapping pairs every second one counts, from the left
                starts = np.r_[True, after[at[:-1]] != at[1:]]
                run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            sym[at] = self.made[rank]
            alive[gone] = False
            follow = after[gone]
            after[at] = follow
            inner = follow >= 0
            before[follow[inner]] = at[inner]
            ahead = before[at]
            enter(np.concatenate([ahead[ahead >= 0], at]))
        return sym[alive], np.bincount(word[alive], minlength=len(words))

    def _units(self, text: str) -> list[str]:
        """Words of a text in order, normalised; a special token that the text spells out is a unit of its own."""
        units: list[str] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                units.append(part)
            elif part:
                # lower case by character: no rule for a sigma at the end of a word
                plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                units += (self.words if self.latin is None or _OTHER.search(plain) else self.latin).findall(plain)
        return units

    def learn(self, words: list[str]) -> None:
        """Encode words and remember them under the next numbers: number of ids, ids, tokens."""
        flat, counts = self.encode_words([w.encode() for w in words])
        flat = flat.tolist()
        names, texts = [self.names[i] for i in flat], [self.tokens[i] for i in flat]
        ends = np.cumsum(counts).tolist()
        cuts = list(zip([0, *ends[:-1]], ends, strict=True))
        self.count.extend(counts.tolist())
        self.ids.extend([" ".join(names[a:b]) for a, b in cuts])
        self.text.extend([" ".join(texts[a:b]) for a, b in cuts])

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For every text the number of ids, the ids joined by a space, and the text decoded from them."""
        if len(self.number) > REMEMBERED:
            self.forget()
        known, number = len(self.number), self.number.__getitem__
        found = [np.array(list(map(number, self._units(t))), np.int32) for t in texts]
        if len(self.number) > known:
            self.learn(list(islice(self.number, known, None)))
        out = []
        for part in found:
            at = part.tolist()
            n = sum(map(self.count.__getitem__, at))
            out.append((n, " ".join(map(self.ids.__getitem__, at)), " ".join(map(self.text.__getitem__, at))))
        return out

    def forget(self) -> None:
        """Remember the special tokens only. No word equals one: their signs and letters fall into different words."""
        self.number = _Numbers((t, k) for k, t in enumerate(self.special))
        self.count = [1] * len(self.special)
        self.ids = [str(i) for i in self.special.values()]
        self.text = list(self.special)

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by a space, as the file names no decoder; unknown ids are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


_LOADED: dict[str, Bpe] = {}


def encoder(definition: str) -> Bpe:
    """The encoder of a definition, built once per worker."""
    if definition not in _LOADED:
        _LOADED.clear()
        _LOADED[definition] = Bpe(definition)
    return _LOADED[definition]


def encode(docs: DataFrame, path: str, text_column: str = "text", tokens: bool = True) -> DataFrame:
    """All columns of ``docs`` and ``_n_tokens``, ``_ids`` (decimal ids joined by a space), ``_decoded``.

    ``path`` names the tokenizer file on the driver; its text, of fixed size, goes to the tasks. Null and empty
    texts have no ids. Special tokens that a text spells out become their ids; none are added. Rows are independent of each
    other, so repeated rows and ids, null ids and further columns of any name pass through. ``tokens=False`` leaves
    ``_decoded`` null. Columns of the added names are replaced.
    """
    added = T.StructType().add("_n_tokens", "long").add("_ids", "string").add("_decoded", "string")

    def out(n: int, ids: str, back: str) -> tuple:
        return n, ids, back if tokens else None

    return _coded(docs, path, text_column, added, out)


def _coded(docs: DataFrame, path: str, text_column: str, added: T.StructType, out: Callable[[int, str, str], tuple]) -> DataFrame:
    """``docs`` with the columns ``added``, which ``out`` makes of each text's result."""
    docs = docs.drop(*added.names)
    with open(path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    at, width = docs.columns.index(text_column), len(docs.columns)
    names = [*docs.columns, *added.names]
    kinds = [pa.int64() if f.dataType == T.LongType() else pa.string() for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(definition.value)
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(start, TEXTS)
                found = [out(*x) for x in bpe.encode([t.decode() for t in as_bytes(batch.column(at))])]
                made = [pa.array([x[k] for x in found], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], *made], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))


def digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, number of tokens, and SHA-256 of the ids and of the decoded text."""
    added = T.StructType().add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def out(n: int, ids: str, back: str) -> tuple:
        return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    return _coded(narrow(docs, id_column, text_column), path, text_column, added, out).drop(text_column)
