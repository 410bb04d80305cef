"""Input relations of the registered queries, derived from the driver tables.

The texts are plain SQL that Spark and DuckDB read alike; table names are in
braces. Every relation covers its tables completely.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import read_table

# Stubs (very short documents) stand for failed or blank fetches, source src7 for articles without URL.
ARTICLES = """
SELECT CAST(doc_id AS STRING) AS story_id,
       CASE WHEN source = 'src7' THEN '' ELSE concat('https://', CASE WHEN lang = 'en' THEN 'www.' ELSE '' END,
            source, '.example.org/', lang, '/', CAST(doc_id AS STRING)) END AS url,
       split_part(text, '.', 1) AS title,
       CASE WHEN n_chars < 150 THEN '' WHEN n_chars < 300 THEN '   ' ELSE text END AS text,
       source AS media_id, lang AS language, 'archive' AS source,
       DATE '2024-01-01' + CAST(doc_id % 365 AS INT) AS publish_date,
       TIMESTAMP '2025-01-01 00:00:00' AS retrieved_at,
       CASE WHEN n_chars < 150 THEN 'failed_no_text' ELSE 'success' END AS status,
       'corpus' AS query,
       doc_id AS seq
FROM {documents}
"""

# Labelled documents are the ones already in the index; some entries are not valid.
INDEX = """
SELECT CAST(d.doc_id AS STRING) AS story_id,
       CASE WHEN l.quality = 1 THEN 'success' ELSE 'failed_no_text' END AS status,
       TIMESTAMP '2024-06-01 00:00:00' AS retrieved_at,
       d.source AS title,
       CASE WHEN l.toxic = 1 THEN CAST(0 AS BIGINT) ELSE d.n_chars END AS text_length,
       'earlier' AS query,
       concat('https://', d.source, '.example.org/', d.lang) AS url,
       DATE '2024-01-01' AS publish_date
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id
"""

NEW_TASKS = """
SELECT CASE WHEN source = 'src3' THEN NULL ELSE CAST(doc_id AS STRING) END AS story_id, doc_id AS task_seq
FROM {documents}
"""

PROJECT_TASKS = "SELECT CAST(doc_id AS STRING) AS story_id FROM {labels}"

RECORDS = "SELECT doc_id AS record_id, text, lang AS label FROM {documents}"

GROUPED = """
SELECT doc_id AS record_id, CASE WHEN source = 'src5' THEN NULL ELSE concat(source, '-', CAST(doc_id % 7 AS STRING)) END AS source,
       CASE WHEN doc_id % 11 = 0 OR source = 'src6' THEN NULL ELSE lang END AS label
FROM {documents}
"""

# Every third page in double quotes, single quotes and without quotes; one link without scheme and one with an entity each; links in a comment and in a script, which are none.
LINK_FORMS = """
SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN h WHEN 1 THEN replace(h, '"', chr(39)) ELSE replace(h, '"', '') END AS html
FROM (SELECT page_id, url, concat(html, '<a href="//cdn.example.net/p', CAST(page_id AS STRING), '">x</a><A class="n" HREF = "/q?a=1&amp;b=2">y</A><!-- <a href="/hidden/', CAST(page_id AS STRING), '">z</a> --><script>w("<a href=/s>s</a>")</script>') AS h
      FROM {pages}) p
"""

DATED_PAGES = """
SELECT page_id, url, concat(CASE page_id % 4
    WHEN 0 THEN concat('<meta property="article:published_time" content="2024-0', CAST(1 + page_id % 9 AS STRING), '-15T08:00:00Z">')
    WHEN 1 THEN concat('<time class="d" datetime="2024-1', CAST(page_id % 3 AS STRING), '-05">')
    WHEN 2 THEN '<time datetime="2024-13-45">' ELSE '' END, html) AS html
FROM {pages}
"""

# Total order of the copies of one order line: day of shipping, then part and price.
ORDER_KEY = """(CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS BIGINT) * 1000000 + l_partkey)
       * 100000 + CAST(floor(l_extendedprice) AS BIGINT) % 100000"""

RATINGS = """
SELECT 'returnflag' AS control, l_orderkey AS subject, l_linenumber AS rater, l_returnflag AS label,
       {order_key} AS ann_pos
FROM {lineitem}
"""

PREDICTIONS = """
SELECT m.model_name AS model_name, d.doc_id AS record_id, d.lang AS y_true,
       CASE WHEN m.model_name = 'm1' AND d.n_chars < 400 THEN 'en'
            WHEN m.model_name = 'm2' AND d.source = 'src5' THEN 'xx'
            WHEN m.model_name = 'm3' AND d.lang = 'es' THEN 'fr'
            ELSE d.lang END AS y_pred
FROM {documents} d{each_model}
"""

# Every article URL, labelled ones a second time, and page URLs that no article has.
URL_LIST = """
SELECT seq AS line_no, url FROM ({articles}) a
UNION ALL
SELECT a.seq + 1000000000 AS line_no, a.url FROM ({articles}) a JOIN {labels} l ON a.seq = l.doc_id
UNION ALL
SELECT page_id + 2000000000 AS line_no, url FROM {pages}
"""

CATALOGUE = """
SELECT page_id AS row_no, concat('Source ', CAST(page_id AS STRING)) AS source_name,
       CASE WHEN page_id % 9 = 0 THEN NULL ELSE url END AS homepage_url,
       CASE page_id % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN ' yes ' WHEN 2 THEN 'no' WHEN 3 THEN 'yes?' ELSE NULL END AS present
FROM {pages}
"""

LEXICON = """
SELECT * FROM (VALUES ('the', 1.5, 0.4, 0.6), ('and', 0.8, 0.2, 0.3), ('that', -1.1, -0.3, 0.5),
  ('than', -2.0, -0.6, 0.9), ('der', 0.5, 0.1, 0.2), ('die', -2.9, -0.8, 0.4), ('und', 0.3, 0.1, 0.1),
  ('de', -0.4, -0.1, 0.2), ('la', 1.9, 0.5, 0.7), ('que', -0.7, -0.2, 0.3), ('les', 2.4, 0.7, 0.8),
  ('et', 0.2, 0.1, 0.1)) AS t(term, valence, polarity, subjectivity)
"""

SNAPSHOTS = """
SELECT doc_id, text AS old_text,
       CASE WHEN lang = 'en' THEN concat(text, chr(10), 'added line')
            WHEN lang = 'fr' THEN replace(text, ' de ', ' DE ') ELSE text END AS new_text
FROM {documents}
"""

_TABLE = re.compile(r"\{(documents|labels|pages|lineitem|embeddings|conversations|benchmark)\}")


def expand(sql: str) -> str:
    """Replace nested fixtures; only table names stay in braces."""
    return sql.replace("{articles}", ARTICLES).replace("{order_key}", ORDER_KEY)


def for_duckdb(sql: str) -> str:
    """Fixture text with the registered view names."""
    models = ", (VALUES ('m1'), ('m2'), ('m3')) AS m(model_name)"
    return _TABLE.sub(r"\1", expand(sql).replace("{each_model}", models))


def relation(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Fixture as a DataFrame over the tables of ``sf_dir``."""
    models = " LATERAL VIEW explode(array('m1', 'm2', 'm3')) m AS model_name"
    text = expand(sql).replace("{each_model}", models)
    names = sorted(set(_TABLE.findall(text)))
    tables = {name: table(spark, sf_dir, name) for name in names}
    return spark.sql(text, **tables)


def table(spark: SparkSession, sf_dir: str, name: str, rebalance: bool = True) -> DataFrame:
    """Driver table. The text-heavy ones may hold all rows in one row group of one file and are dealt to all cores first.

    A table whose files give work to half of the cores is read as it lies, so that its texts are not moved; ``rebalance=False`` asks for that anyway.
    """
    rows = read_table(spark, sf_dir, name)
    key = {"documents": "doc_id", "pages": "page_id"}.get(name)
    cores = spark.sparkContext.defaultParallelism
    if not rebalance or key is None or 2 * len(rows.inputFiles()) >= max(cores, 3):
        return rows
    return rows.repartition(cores, key)


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.sql(LEXICON).select(
        "term", *[F.col(c).cast("double").alias(c) for c in ("valence", "polarity", "subjectivity")]
    )


# Labelling tasks: three annotations for every labelled document, some of them
# with flipped labels, cancelled, or made by the same person twice.
N_ANNOTATIONS = 3

_CHOICE = (
    "named_struct('type', 'choices', 'from_name', '{c}', 'value', parse_json(concat("
    "'{{\"choices\":[\"{c}_', CASE WHEN {c} = CASE WHEN (id * 7919 + k * 104729) % 10 < 2 THEN 0 ELSE 1 END "
    "THEN 'yes' ELSE 'no' END, '\"]}}')))"
)
_RATING = "named_struct('type', 'rating', 'from_name', 'stars', 'value', parse_json('{\"rating\":3}'))"
_NOTE = (
    "named_struct('type', 'textarea', 'from_name', 'note', 'value', parse_json(CASE k "
    "WHEN 0 THEN concat('{\"text\":\"note_', lang, '\"}') "
    "WHEN 1 THEN concat('[\"note_', lang, '\",\"extra\"]') "
    "ELSE concat('\"note_', lang, '\"') END))"
)


def annotated_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested tasks in the export layout, built row by row from documents and labels."""
    joined = (
        table(spark, sf_dir, "documents")
        .join(read_table(spark, sf_dir, "labels"), "doc_id")
        .withColumnRenamed("doc_id", "id")
    )
    results = (
        f"CASE WHEN source = 'src9' AND k = 0 THEN array({_CHOICE.format(c='quality')}, {_RATING}, {_NOTE}) "
        f"ELSE array({_CHOICE.format(c='quality')}, {_RATING}, {_NOTE}, {_CHOICE.format(c='toxic')}) END"
    )
    annotation = (
        "named_struct('id', concat(CAST(id AS STRING), '-', CAST(k AS STRING)), "
        "'completed_by', CASE WHEN source = 'src2' AND k = 2 THEN 'ann0' ELSE concat('ann', CAST(k AS STRING)) END, "
        "'created_by', CAST(NULL AS STRING), 'created_at', '2025-01-01T00:00:00', "
        "'was_cancelled', source = 'src4' AND k = 1, 'cancelled', CAST(NULL AS BOOLEAN), "
        "'skipped', CAST(NULL AS BOOLEAN), 'lead_time', CAST((id * 31 + k * 17) % 120 AS DOUBLE) / 2, "
        f"'result', {results})"
    )
    data = (
        "named_struct('text', text, 'story_id', CAST(id AS STRING), 'title', source, "
        "'url', CAST(NULL AS STRING), 'language', lang, 'publish_date', CAST(NULL AS STRING)) AS data"
    )
    return joined.selectExpr(
        "id", data, f"transform(sequence(0, {N_ANNOTATIONS - 1}), k -> {annotation}) AS annotations"
    )


# Flat twin of the nested tasks for DuckDB: one row per annotation and control.
ANNOTATIONS_FLAT = """
SELECT l.doc_id AS task_id, k.k AS ann_pos,
       CASE WHEN d.source = 'src2' AND k.k = 2 THEN 'ann0' ELSE concat('ann', CAST(k.k AS STRING)) END AS annotator,
       c.control AS control, 0 AS label_pos,
       CASE WHEN (CASE WHEN c.control = 'quality' THEN l.quality ELSE l.toxic END)
                 = (CASE WHEN (l.doc_id * 7919 + k.k * 104729) % 10 < 2 THEN 0 ELSE 1 END)
            THEN concat(c.control, '_yes') ELSE concat(c.control, '_no') END AS label,
       CAST((l.doc_id * 31 + k.k * 17) % 120 AS DOUBLE) / 2 AS lead_time
FROM labels l JOIN documents d ON d.doc_id = l.doc_id
CROSS JOIN (VALUES (0), (1), (2)) AS k(k)
CROSS JOIN (VALUES ('quality'), ('toxic')) AS c(control)
WHERE NOT (c.control = 'toxic' AND d.source = 'src9' AND k.k = 0)
  AND NOT (d.source = 'src4' AND k.k = 1)
"""
REQUIRED_LABELS = ("quality_yes", "quality_no", "toxic_yes")
