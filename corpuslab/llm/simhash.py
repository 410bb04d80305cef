"""SimHash near-duplicates with Golay-code fuzzy keys.

A fingerprint of 64 bits is cut into three segments of 22, 21 and 21 bits, each padded to a 23-bit word of the
perfect binary Golay code: every word lies within three bits of exactly one of the 4,096 codewords, whose 12-bit index
is the segment's fuzzy key. ``near`` lists the indices of a word and of its 23 neighbours: one where the word is at most
two bits from its codeword, six where it is three bits away. Hence

* words at distance 1: the index of either is among the near indices of the other;
* words at distance 2: they have a near index in common (that of the word between them).

Pigeonhole for up to four errors over three segments: either two segments have at most one error each, or the
errors are (0, 2, 2). So a row gives two families of keys for each of the three segment pairs:

* pair keys: the index side gives near(a) with own(b), the probe side own(a) with near(b);
* exact keys: segment a itself with near(b), on both sides.

All pairs with four or fewer differing bits meet in at least one key; the join verifies the distance before it
gives a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .blocks import mix
from .common import as_bytes, materialise
from .components import components

# Generator polynomial of the [23,12,7] Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
GENERATOR, WORD, DATA, PARITY = 0b101011100011, 23, 12, 11
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift, bits
MAX_BITS = 4


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles (repeats count); no words give zero, fewer than ``shingle`` words one shingle."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the separators \\x20 \\x09-\\x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = [b" ".join(words[i : i + shingle]) for i in range(n)]
    return majority(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in joined), np.uint64, n))


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _syndrome(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.int64)
    for bit in range(WORD - 1, PARITY - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - PARITY)), rest)
    return rest


def _error_table() -> np.ndarray:
    """Error pattern of every syndrome: all patterns of at most three bits."""
    patterns = [sum(1 << b for b in c) for k in range(4) for c in combinations(range(WORD), k)]
    table = np.zeros(1 << PARITY, np.int64)
    table[_syndrome(np.array(patterns))] = patterns
    return table


_ERRORS = _error_table()


def own(words: np.ndarray) -> np.ndarray:
    """Index (0 to 4,095) of the codeword nearest to each 23-bit word."""
    words = words.astype(np.int64)
    return (words ^ _ERRORS[_syndrome(words)]) >> PARITY


def near(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indices of each word and its neighbours, as (row, index) arrays."""
    found = np.concatenate([[own(words)], [own(words ^ (1 << b)) for b in range(WORD)]]).T
    found.sort(axis=1)
    fresh = np.ones(found.shape, bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    rows, at = np.nonzero(fresh)
    return rows, found[rows, at]


def fuzzy_keys(prints: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """(row, key) of the index side and of the probe side for an array of unsigned 64-bit fingerprints."""
    words = [((prints >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    owns, nears = [own(w) for w in words], [near(w) for w in words]
    index, probe = [], []
    for a in range(3):
        b = (a + 1) % 3
        (ra, ka), (rb, kb) = nears[a], nears[b]
        pair, exact = a << 60, (a + 3) << 60
        index.append((ra, pair | ka << 12 | owns[b][ra]))
        probe.append((rb, pair | owns[a][rb] << 12 | kb))
        both = (rb, exact | words[a][rb] << 12 | kb)
        index.append(both)
        probe.append(both)
    join = lambda side: (np.concatenate([r for r, _ in side]), np.concatenate([k for _, k in side]))
    return join(index), join(probe)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4) -> DataFrame:
    """Columns ``id_column``, ``fp`` (the fingerprint as a signed long) and ``tie`` (a hash of the text) of every row; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in as_bytes(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), batch.column(2)], names=[id_column, "fp", "tie"])

    kept = docs.select(id_column, text_column, F.xxhash64(text_column).alias("tie"))
    return kept.mapInArrow(run, f"{id_column} {kept.schema[id_column].dataType.simpleString()}, fp long, tie long")


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct fingerprint pairs ``a`` < ``b`` at most ``max_bits`` (4 or fewer) apart, of a table with distinct ``fp``.

    Spark takes the keys for as small as the table they are made of, though a fingerprint has up to 36 on each side, so it is told not to broadcast them.
    """
    if max_bits > MAX_BITS:
        raise ValueError("the keys guarantee pairs up to four bits apart")

    def keyed(side: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                whole = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                for at in range(0, len(whole), 4096):
                    part = whole[at : at + 4096]
                    rows, keys = fuzzy_keys(part.view(np.uint64))[side]
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], names=["key", "fp"])

        return prints.select("fp").mapInArrow(run, "key long, fp long")

    index, probe = keyed(0).withColumnRenamed("fp", "a").hint("merge"), keyed(1).withColumnRenamed("fp", "b").hint("merge")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return index.join(probe, (index["key"] == probe["key"]) & (F.col("a") < F.col("b")) & apart).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4, max_bits: int = MAX_BITS
) -> DataFrame:
    """Columns ``id_column``, ``fp``, ``component_id``: fingerprint and smallest id reachable by links, for every row.

    Rows with equal fingerprints form one class and are compared once; classes are linked at ``max_bits`` or fewer
    differing bits. Null and blank texts have fingerprint zero and are linked like any other. A null id is never a
    component's smallest id; a component of null ids only has a null ``component_id``. Repeated rows stay rows. An empty table
    gives no rows.
    """
    found = _grouped(docs, id_column, text_column, shingle, max_bits)
    return found.select(id_column, "fp", "component_id")


def _grouped(docs: DataFrame, id_column: str, text_column: str, shingle: int = 4, max_bits: int = MAX_BITS) -> DataFrame:
    """Columns ``id_column``, ``fp``, ``tie``, ``root`` (a fingerprint that names the component) and ``component_id`` for every row."""
    prints = materialise(fingerprints(docs, id_column, text_column, shingle), "prints")
    classes = materialise(prints.groupBy("fp").agg(F.min(id_column).alias("least")), "classes")
    roots = components(links(classes, max_bits), "a", "b")
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialise(rooted, "rooted")
    least = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = materialise(rooted.join(least, "root").select("fp", "root", "component_id"), "named")
    return prints.join(named, "fp", "left")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, without near-duplicates by the bits of their fingerprints; see ``keep_one``."""
    return keep_one(docs, _grouped(docs, id_column, text_column), id_column, text_column)


def keep_one(docs: DataFrame, grouped: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Of every component of ``grouped`` (id, ``tie``, ``root``) the row of ``docs`` with the smallest id.

    Decided by id and text: of rows that repeat an id, those with unrelated texts belong to components of their own and stay; of those
    in one component the one with the smallest hash of its text stays, and of rows with the same id and text one. Rows without an id
    can't be named and stay.
    """
    found = materialise(grouped.where(F.col(id_column).isNotNull()).select(id_column, "tie", "root"), "grouped")
    kept = found.groupBy("root").agg(F.min(F.struct(F.col(id_column).alias("kept_id"), F.col("tie").alias("kept_tie"))).alias("k")).select("k.*")
    kept = materialise(kept, "kept")
    repeated = found.groupBy(id_column, "tie").count().where("count > 1").limit(1).count() > 0
    out = docs.join(kept, (docs[id_column] == kept["kept_id"]) & (F.xxhash64(docs[text_column]) == kept["kept_tie"]), "left_semi")
    out = out.dropDuplicates([id_column, text_column]) if repeated else out
    return out.select(docs.columns).unionByName(docs.where(F.col(id_column).isNull()))


# ---- near-duplicates by similarity -------------------------------------------------------------------------------
#
# Four bits of 64 are next to equality: documents that share 0.8 of their shingles differ in about ten. Here a fingerprint has five
# whole Golay words, and a word is decoded softly: by the surplus of set over unset bits at each place, so that a bit
# that was nearly even counts little. A word's near codewords are the four that its surpluses fit best. Two documents meet where
# the best codeword of one is near the other's in one segment, and the other way round in a second segment; over the ten pairs of
# segments 0.95 of the pairs at similarity 0.8 do, and more above. Sketches thin the chance meetings: 64 places that no word uses, or
# else the texts that met by chance in two words would have most of their sketches in common as well. Shingles decide.

FUZZY_WORDS, FUZZY_NEAR = 5, 4
#: Differing bits of 64 that a pair may have; at similarity 0.8 the mean is 9.7 and the deviation 2.9.
SKETCH_BITS = 20
#: Parts that the rows of a class are dealt to when they get their component.
PARTS_OF_A_CLASS = 8
_PAIRS = list(combinations(range(FUZZY_WORDS), 2))
#: Seeds of the second and the third 64 places.
_PLACES = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


def _codewords() -> np.ndarray:
    """All codewords as rows of plus one (bit unset) and minus one."""
    shifted = np.arange(1 << DATA, dtype=np.int64) << PARITY
    words = shifted ^ _syndrome(shifted)
    return (1 - 2 * (words[:, None] >> np.arange(WORD) & 1)).astype(np.float32)


_CODE = _codewords()


def shingle_set(text: bytes, shingle: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles, A-Z lower-cased; fewer words than ``shingle`` are one, none none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = {w: xxhash.xxh64_intdigest(w, 42) for w in set(words)}
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        total = (total + hashes[k : k + len(total)]) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(mix(total))


def surpluses(hashes: np.ndarray) -> np.ndarray:
    """Set minus unset bits at each of 192 places over some hashes."""
    counts = np.zeros(192, np.int64)
    for at in range(0, len(hashes), 1 << 15):  # bounded memory for very long texts
        part = hashes[at : at + (1 << 15)]
        places = np.stack([part, *(mix(part ^ seed) for seed in _PLACES)], axis=1).astype("<u8")
        counts += np.unpackbits(places.view(np.uint8).reshape(len(part), 24), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return 2 * counts - len(hashes)


def near_codewords(surplus: np.ndarray) -> np.ndarray:
    """For rows of surpluses the numbers of the ``FUZZY_NEAR`` codewords that fit each word best, the best first."""
    words = surplus[:, : FUZZY_WORDS * WORD].reshape(-1, WORD).astype(np.float32)
    out = np.empty((len(words), FUZZY_NEAR), np.int64)
    for at in range(0, len(words), 512):
        fit = words[at : at + 512] @ _CODE.T  # a set bit is a minus one, so the least fits best
        for k in range(FUZZY_NEAR):  # ties go to the smaller number
            best = out[at : at + 512, k] = fit.argmin(axis=1)
            fit[np.arange(len(fit)), best] = np.inf
    return out.reshape(len(surplus), FUZZY_WORDS, FUZZY_NEAR)


def _fuzzy_prints(docs: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    """``id_column``, ``tie``, ``cls`` (digest of the shingle set), ``sketch`` (64 fingerprint bits), ``near`` (codeword numbers) and ``shingles`` of every row.

    The shingles are kept as sorted 32-bit digests, which decide about a pair: of two texts of n shingles n^2 / 2^32 meet by chance, 0.00006 for 500.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                sets = [shingle_set(t, shingle) for t in as_bytes(batch.column(1))]
                surplus = np.stack([surpluses(x) for x in sets])
                classes = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets], np.uint64)
                sketch = np.packbits(surplus[:, 128:] > 0, axis=1, bitorder="little").view("<u8")[:, 0]
                near = near_codewords(surplus).astype("<u2")
                short = [np.unique((x >> np.uint64(32)).astype("<u4")).tobytes() for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(2), pa.array(classes.view(np.int64)), pa.array(sketch.view(np.int64)),
                        pa.array([x.tobytes() for x in near], pa.binary()), pa.array(short, pa.binary()),
                    ],
                    names=[id_column, "tie", "cls", "sketch", "near", "shingles"],
                )

    kept = docs.select(id_column, text_column, F.xxhash64(text_column).alias("tie"))
    return kept.mapInArrow(run, f"`{id_column}` {kept.schema[id_column].dataType.simpleString()}, tie long, cls long, sketch long, near binary, shingles binary")


def _fuzzy_keys(classes: DataFrame, side: int) -> DataFrame:
    """``key``, ``cls``, ``sketch``, ``comp`` (null: the class alone) of one side: near codewords of one segment with the best one of the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                near = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<u2").astype(np.int64).reshape(-1, FUZZY_WORDS, FUZZY_NEAR)
                keys = []
                for number, (a, b) in enumerate(_PAIRS):
                    first, second = (near[:, a], near[:, b, :1]) if side == 0 else (near[:, a, :1], near[:, b])
                    keys.append(number << 24 | first << 12 | second)
                keys = np.concatenate(keys, axis=1)
                rows = pa.array(np.repeat(np.arange(len(near)), keys.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().astype(np.int32)), *(batch.column(k).take(rows) for k in range(3))], names=["key", "cls", "sketch", "comp"])

    return classes.select("cls", "sketch", "comp", "near").mapInArrow(run, "key int, cls long, sketch long, comp long")


def _verified(prints: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs of classes (``a``, ``b``) whose shingle sets have a Jaccard similarity of at least ``similarity``; a written table."""
    pairs = materialise(pairs, "pairs")
    wanted = materialise(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "wanted")
    # one row of every class that is asked for, whatever the number of its copies
    sets = prints.select("cls", "shingles").join(wanted, "cls", "left_semi").groupBy("cls").agg(F.any_value("shingles").alias("shingles"))
    sets = materialise(sets, "sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                if min(len(p), len(q)) < similarity * max(len(p), len(q)):
                    good.append(False)
                    continue
                at = np.minimum(np.searchsorted(q, p), len(q) - 1) if len(q) else np.zeros(0, int)
                shared = int((q[at] == p).sum()) if len(q) else 0
                good.append(shared >= similarity * (len(p) + len(q) - shared) - 1e-9)
            yield pa.RecordBatch.from_arrays(list(batch.filter(pa.array(good, pa.bool_())).columns[:2]), names=["a", "b"])

    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("p"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("q"))
    return materialise(pairs.join(left, "a").join(right, "b").select("a", "b", "p", "q").mapInArrow(check, "a long, b long"), "links")


def similar_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5, similarity: float = 0.8, sketch_bits: int = SKETCH_BITS
) -> DataFrame:
    """``id_column``, ``tie`` (hash of the text) and ``root`` (of the component) for every row: links are verified similarities of shingle sets.

    Texts with equal shingle sets are one class, also those without words. Candidates come from the fuzzy keys, so a link at the least similarity is found
    with a probability of about 0.95, more above; none is found below it. A group of copies is not paired: first every class is compared
    with the least class of each of its keys, then only classes that are not connected yet are. Classes are 64-bit digests.
    """
    prints = materialise(_fuzzy_prints(docs, id_column, text_column, shingle), "prints")
    classes = prints.groupBy("cls").agg(F.any_value("sketch").alias("sketch"), F.any_value("near").alias("near")).withColumn("comp", F.lit(None).cast("long"))
    classes = materialise(classes, "classes")
    alike = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= sketch_bits
    both = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))

    hubs = _fuzzy_keys(classes, 0).groupBy("key").agg(F.min("cls").alias("hub"), F.min_by("sketch", "cls").alias("hub_sketch"))
    met = _fuzzy_keys(classes, 1).join(hubs, "key").where((F.col("cls") != F.col("hub")) & alike(F.col("sketch"), F.col("hub_sketch")))
    first = _verified(prints, met.select(*both(F.col("cls"), F.col("hub"))).distinct(), similarity)

    roots = materialise(components(first, "a", "b"), "roots")
    joined = classes.drop("comp").join(roots, classes["cls"] == roots["node"], "left").select("cls", "sketch", "near", F.col("root").alias("comp"))
    joined = materialise(joined, "classes")
    # most classes have no link yet; their null components cost nothing in the exchange of the keys
    component = lambda end="": F.coalesce(f"comp{end}", f"cls{end}")
    index, probe = _fuzzy_keys(joined, 0), _fuzzy_keys(joined, 1)
    probe = probe.select("key", *[F.col(c).alias(f"{c}_") for c in ("cls", "sketch", "comp")])
    rest = index.join(probe, "key").where((component() != component("_")) & alike(F.col("sketch"), F.col("sketch_")))
    second = _verified(prints, rest.select(*both(F.col("cls"), F.col("cls_"))).distinct(), similarity)

    # only links between components are left; components are contracted to their roots
    at = joined.select(F.col("cls").alias("at"), component().alias("comp"))
    ends = second.join(at, second["a"] == at["at"]).select(F.col("comp").alias("u"), "b").join(at, F.col("b") == at["at"]).select("u", F.col("comp").alias("v"))
    merged = components(ends, "u", "v")
    named = joined.select("cls", component().alias("comp")).join(merged, F.col("comp") == merged["node"], "left").select("cls", F.coalesce("root", "comp").alias("root"))
    # the rows of one class, exact copies, are dealt to parts, and the class's row is repeated as often
    named = materialise(named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(PARTS_OF_A_CLASS - 1)))), "named")
    rows = prints.select(id_column, "tie", "cls").withColumn("salt", F.pmod(F.xxhash64(F.col(id_column).cast("string")), F.lit(PARTS_OF_A_CLASS)).cast("int"))
    return rows.join(named, ["cls", "salt"]).select(id_column, "tie", "root")


def one_of_similar(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """Rows of ``docs``, all columns, without near-duplicates by the similarity of their shingles; see ``similar_groups`` and ``keep_one``."""
    return keep_one(docs, similar_groups(docs, id_column, text_column, shingle, similarity), id_column, text_column)
