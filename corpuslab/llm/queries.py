"""One query for each operator of this subpackage, over the whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import anchors, bpe, crosspolytope, factorisation as fm, latent, ledger, lines, periods, phrases, pseudonyms, ranking, simhash, warc
from .common import read_table, ship

TOKENIZER = "word_bpe_49k.json"
#: Key of the registered query only; a user passes a secret of their own.
PSEUDONYM_KEY = "corpuslab-demo-key"


def tokenizer_path() -> str:
    """Place of the public tokenizer file, asked of the installed package."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_latent_retrieval(spark: SparkSession, sf: str) -> DataFrame:
    return latent.contaminated(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def op2_feistel_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    changed = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)
    return changed.select("doc_id", "text", F.col("_n_private").alias("n_private"), F.array_join("_kinds", ",").alias("kinds"))


def op3_warc_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    archives = warc.write_archives(read_table(spark, sf, "pages"))
    records = warc.read_archives(archives, payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_prefix_free_parsing(spark: SparkSession, sf: str) -> DataFrame:
    kept = phrases.drop_repeats(read_table(spark, sf, "documents"))
    return kept.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("span_starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_cross_polytope(spark: SparkSession, sf: str) -> DataFrame:
    found = crosspolytope.near_duplicates(read_table(spark, sf, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op6_factorisation_machine(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    model = fm.fit(docs, labels.where(fm.held_in()))
    scored = fm.score(docs.select("doc_id", "text", "n_chars"), model)
    return scored.select(
        "doc_id",
        (~fm.held_in()).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_block_anchors(spark: SparkSession, sf: str) -> DataFrame:
    kept = anchors.drop_repeats(read_table(spark, sf, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = lines.drop_frequent_lines(read_table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2("_kept_text", 256).alias("kept_sha256"),
    )


def op9_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf, "documents"), tokenizer_path())


def op10_simhash_golay(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op11_blob_ledger(spark: SparkSession, sf: str) -> DataFrame:
    found = ledger.scan(read_table(spark, sf, "documents").select("doc_id", "text"))
    of = lambda *kinds: F.filter("_findings", lambda x: x["kind"].isin(*kinds))
    counts = [F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in ledger.BASE]
    base = of(*[r.kind for r in ledger.BASE])
    return found.select("doc_id", *counts, F.sha2(ledger.span_text(base), 256).alias("base_sha256"), ledger.span_text(F.col("_findings")).alias("spans"))


def with_cycles(docs: DataFrame) -> DataFrame:
    """Input of op12: the texts, those of ids with a crc32 divisible by ten made periodic from word a on with period p."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size("_words")
    marked = docs.select("doc_id", "text", h.alias("_h"), g.alias("_g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("_words"))
    marked = marked.withColumn("_a", (F.col("_g") % n).cast("int"))
    marked = marked.withColumn("_p", (1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    cycle = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    whole = F.concat(F.slice("_words", F.lit(1), F.col("_a")), F.flatten(F.array_repeat(cycle, F.ceil((n - F.col("_a")) / F.col("_p")).cast("int"))))
    return marked.select("doc_id", F.when(n > 0, F.array_join(F.slice(whole, F.lit(1), n), " ")).otherwise(F.col("text")).alias("text"))


def op12_recompression_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periods.collapse(with_cycles(read_table(spark, sf, "documents").select("doc_id", "text")))
    top = found.withColumn("_top", periods.longest_run(F.col("runs")))
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_top.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * _top.length div _top.period").alias("exponent_milli"),
        F.sha2(periods.run_lines(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_nra_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.search(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def _shipped(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(build)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship(spark)
        return build(spark, sf)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f)
    for f in (
        op1_latent_retrieval,
        op2_feistel_pseudonyms,
        op3_warc_dictionary,
        op4_prefix_free_parsing,
        op5_cross_polytope,
        op6_factorisation_machine,
        op7_block_anchors,
        op8_line_dedup,
        op9_bpe_codec,
        op10_simhash_golay,
        op11_blob_ledger,
        op12_recompression_runs,
        op13_nra_search,
    )
}
_REFERS = "CASE WHEN page_id <> first_id THEN first_id END"
# Base32 sign k of a SHA-1 in hexadecimal digits: bits 5k to 5k + 4.
_HEX = "(strpos('0123456789abcdef', substr(h, CAST(5 * k // 4 + {} AS BIGINT), 1)) - 1)"
_BASE32 = f"""array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((((16 * {_HEX.format(1)} + {_HEX.format(2)}) >> (3 - CAST(5 * k % 4 AS INTEGER))) & 31) + 1 AS BIGINT), 1)), '')"""

# Matches, groups and parts between matches of every kind of secret, as literal strings of the other dialect.
_EITHER_CASE = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"


def _found_sql() -> str:
    out = []
    for no, rule in enumerate(ledger.RULES):
        pattern = rule.pattern
        if rule.kind == "assign":
            pattern = _EITHER_CASE + pattern[pattern.index(")", 5) + 1 :]
        quoted = "'" + pattern.replace("'", "''") + "'"
        out.append(
            f"SELECT doc_id, {no} AS no, '{rule.kind}' AS kind, {rule.min_chars} AS least_chars, regexp_extract_all(t, {quoted}, 0) AS m, "
            f"regexp_extract_all(t, {quoted}, {rule.group}) AS c, string_split_regex(t, {quoted}) AS p FROM d"
        )
    return " UNION ALL ".join(out)


_FOUND = _found_sql()

#: DuckDB SQL of the queries that SQL can express. The others have models, a tokenizer, XXH64 or keyed permutations in them.
ORACLE: dict[str, str] = {
    "op3_warc_dictionary": f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, {_REFERS} AS refers_to
FROM d
""",
    "op4_prefix_free_parsing": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, place, substr(b, CAST(2 * place + 1 AS BIGINT), 200) AS s
      FROM (SELECT doc_id, b, unnest(range(0, greatest(n - 99, 0))) AS place FROM d)),
late AS (SELECT doc_id, place FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, place) > 1),
runs AS (SELECT doc_id, place, sum(fresh) OVER (PARTITION BY doc_id ORDER BY place) AS run
         FROM (SELECT doc_id, place, CASE WHEN place - lag(place) OVER (PARTITION BY doc_id ORDER BY place) <= 100 THEN 0 ELSE 1 END AS fresh FROM late)),
spans AS (SELECT doc_id, min(place) AS a, max(place) + 100 AS z FROM runs GROUP BY doc_id, run),
kept AS (SELECT doc_id, a AS upto, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans
         UNION ALL SELECT d.doc_id, n, coalesce(max(z), 0) FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id, n),
texts AS (SELECT doc_id, string_agg(substr(b, CAST(2 * since + 1 AS BIGINT), CAST(2 * (upto - since) AS BIGINT)), '' ORDER BY since) AS left_
          FROM kept JOIN d USING (doc_id) GROUP BY doc_id),
gone AS (SELECT doc_id, sum(z - a) AS r, count(*) AS k FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(r, 0) AS BIGINT) AS n_removed, CAST(coalesce(k, 0) AS BIGINT) AS n_spans,
       sha256(unhex(left_)) AS kept_sha256
FROM d JOIN texts USING (doc_id) LEFT JOIN gone USING (doc_id)
""",
    "op5_cross_polytope": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
          WHERE list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2]))
                >= 0.9 * sqrt(list_sum(list_transform(a.e, lambda x: x * x))) * sqrt(list_sum(list_transform(b.e, lambda x: x * x)))),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
root AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM root LEFT JOIN degree USING (vec_id)
""",
    "op7_block_anchors": """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, place, array_to_string(w[place : place + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS place FROM d)),
late AS (SELECT doc_id, place FROM s QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, place) > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d),
marked AS (SELECT doc_id, place, word, coalesce(place - last_value(l.place IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY place) < 20, false) AS gone
           FROM words LEFT JOIN late l USING (doc_id, place)),
left_ AS (SELECT doc_id, count(*) FILTER (gone) AS r, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS t FROM marked GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(r, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN left_ USING (doc_id)
""",
    "op8_line_dedup": """
WITH x AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
k AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS place FROM x),
n AS (SELECT doc_id, place, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM k),
f AS (SELECT key FROM n WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM n LEFT JOIN f USING (key) GROUP BY doc_id
""",
    "op11_blob_ledger": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_FOUND}),
x AS (SELECT doc_id, no, kind, least_chars, unnest(m) AS m, unnest(c) AS c, unnest(p[1 : len(m)]) AS p, unnest(range(0, len(m))) AS k FROM f WHERE len(m) > 0),
s AS (SELECT *, sum(length(p) + length(m)) OVER (PARTITION BY doc_id, no ORDER BY k) AS z FROM x),
spans AS (SELECT doc_id, no, kind, z - length(m) AS a, kind || ':' || CAST(z - length(m) AS BIGINT) || ':' || CAST(z AS BIGINT) AS span
          FROM s WHERE length(c) >= least_chars),
g AS (SELECT doc_id, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access, count(*) FILTER (no = 2) AS n_hex,
             string_agg(span, ',' ORDER BY a, no) FILTER (no < 3) AS base, string_agg(span, ',' ORDER BY a, no) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
""",
    "op12_recompression_runs": """
WITH b AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, CAST(doc_id AS VARCHAR) AS s FROM documents),
c AS (SELECT doc_id, w, len(w) AS n, xor(CAST(4294967295 AS BIGINT), list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
             list_transform(range(0, 8 * length(s)), lambda k: CASE WHEN k % 8 = 0 THEN CAST(ascii(substr(s, k // 8 + 1, 1)) AS BIGINT) ELSE 0 END)),
             lambda h, v: xor(xor(h, v) >> 1, CAST(3988292384 AS BIGINT) * (xor(h, v) & 1)))) AS h FROM b),
a AS (SELECT doc_id, w, n, h, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM c),
p AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[CAST(i + 1 AS BIGINT)]
             ELSE w[CAST(a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1 AS BIGINT)] END) END AS w FROM a),
x AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM p),
same AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM x JOIN x y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isle AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM same),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM isle GROUP BY doc_id, q, k)
         WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
top AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
sums AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
left_ AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT p.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
       CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(sums.t, '')) AS runs_sha256, sha256(coalesce(left_.t, '')) AS collapsed_sha256
FROM p LEFT JOIN sums USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN left_ USING (doc_id)
""",
    "op13_nra_search": r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
len AS (SELECT doc_id, sum(tf) AS n FROM c GROUP BY doc_id),
totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM len),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM c GROUP BY term), totals),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * CAST(n AS BIGINT) * nd) // l)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN c USING (term) JOIN len USING (doc_id), totals GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
""",
}
