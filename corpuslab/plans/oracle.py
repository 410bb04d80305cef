"""DuckDB SQL twins of the registered queries, written independently of the operators."""

from __future__ import annotations

from ..functions.text import WHITESPACE
from . import fixtures as fx

_ART = fx.for_duckdb(fx.ARTICLES)
_IDX = fx.for_duckdb(fx.INDEX)
_ANN = fx.ANNOTATIONS_FLAT
_WS = "'" + WHITESPACE + "'"

_ARTICLES = f"WITH articles AS ({_ART})"
_INGEST = f"""
{_ARTICLES}, idx AS ({_IDX}),
ok AS (SELECT DISTINCT story_id FROM idx WHERE status = 'success' AND text_length > 0),
fresh AS (SELECT a.*, CASE WHEN length(a.text) > 0 THEN 'success' ELSE 'failed_no_text' END AS st
          FROM articles a WHERE a.story_id NOT IN (SELECT story_id FROM ok) AND a.url <> ''),
old AS (SELECT a.* FROM articles a WHERE a.story_id IN (SELECT story_id FROM ok))
"""

_W = r"[^\p{L}\p{N}_]"
_HAY = "lower(concat_ws(chr(10), title, text))"


def _term(pattern: str, prefix: bool = False) -> str:
    end = "" if prefix else rf"({_W}|$)"
    return rf"regexp_matches({_HAY}, '(^|{_W}){pattern}{end}')"


_SEARCH = f"""
publish_date BETWEEN DATE '2024-02-01' AND DATE '2024-11-30'
AND ({_term('the')} OR {_term(r'der' + chr(92) + 's+di', prefix=True)})
AND NOT {_term('les')}
"""

_REQUIRED = f"({_ANN}) AS r0 WHERE label IN ('quality_yes', 'quality_no', 'toxic_yes')"
_LONG = f"WITH long AS (SELECT * FROM {_REQUIRED})"

# Training view of the annotations: quality label, then the note, then the toxic label.
_TRAINING = f"""
WITH ann AS (
  SELECT l.doc_id AS task_id, k.k AS ann_pos,
         concat(CAST(l.doc_id AS VARCHAR), '-', CAST(k.k AS VARCHAR)) AS annotation_id, d.lang AS language, d.text AS text,
         CASE WHEN d.source = 'src2' AND k.k = 2 THEN 'ann0' ELSE concat('ann', CAST(k.k AS VARCHAR)) END AS annotated_by,
         CASE WHEN l.quality = (CASE WHEN (l.doc_id * 7919 + k.k * 104729) % 10 < 2 THEN 0 ELSE 1 END)
              THEN 'quality_yes' ELSE 'quality_no' END AS q,
         CASE WHEN d.source = 'src9' AND k.k = 0 THEN NULL
              WHEN l.toxic = (CASE WHEN (l.doc_id * 7919 + k.k * 104729) % 10 < 2 THEN 0 ELSE 1 END)
              THEN 'toxic_yes' ELSE 'toxic_no' END AS t
  FROM labels l JOIN documents d USING (doc_id) CROSS JOIN (VALUES (0), (1), (2)) AS k(k)
  WHERE NOT (d.source = 'src4' AND k.k = 1)
)"""

_SIMPLE = f"""
{_LONG},
records AS (SELECT task_id, count(DISTINCT ann_pos) AS n_records FROM long GROUP BY task_id),
multi AS (SELECT * FROM records WHERE n_records > 1),
grid AS (SELECT m.task_id, m.n_records, c.control FROM multi m CROSS JOIN (SELECT DISTINCT control FROM long) c),
per_label AS (SELECT task_id, control, label, count(*) AS n, min(ann_pos) AS first_pos FROM long GROUP BY ALL),
per_control AS (SELECT task_id, control, sum(n) AS n_valid, max(n) AS n_top, count(*) AS n_labels,
    arg_max(label, n * 1000 - first_pos) AS most_common_label,
    string_agg(label || '=' || CAST(n AS VARCHAR), ',' ORDER BY label) AS label_distribution
  FROM per_label GROUP BY ALL),
simple AS (SELECT g.task_id, g.control, g.n_records,
    CAST(coalesce(p.n_valid, g.n_records) AS BIGINT) AS num_annotators,
    CAST(p.n_top AS DOUBLE) / p.n_valid AS agreement_ratio,
    coalesce(p.n_labels = 1, false) AS all_agree, p.most_common_label, p.label_distribution
  FROM grid g LEFT JOIN per_control p USING (task_id, control)),
per_task AS (SELECT task_id, max(n_records) AS num_annotators,
    round(avg(round(agreement_ratio, 3)), 3) AS overall_simple_agreement,
    bool_or(num_annotators > 1 AND NOT all_agree) AS has_disagreement
  FROM simple GROUP BY task_id)
"""


def _coefficients(rated: str) -> str:
    """CTEs ending in ``coef(control, krippendorff_alpha, gwet_ac1)``; ``rated`` gives the ratings."""
    return f"""
rated AS ({rated}),
valid AS (SELECT control, subject FROM rated GROUP BY ALL HAVING count(*) >= 2),
last_r AS (SELECT control, subject, rater, arg_max(label, ann_pos) AS label
           FROM rated JOIN valid USING (control, subject) GROUP BY ALL),
uk AS (SELECT control, subject, label, count(*) AS n FROM last_r GROUP BY ALL),
u AS (SELECT control, subject, sum(n) AS m, sum(n * n) AS sq FROM uk GROUP BY ALL),
k2 AS (SELECT uk.control, label, sum(n) AS nk FROM uk JOIN u USING (control, subject) WHERE m >= 2 GROUP BY ALL),
kt AS (SELECT control, sum(nk) AS n, sum(nk) * sum(nk) - sum(nk * nk) AS de FROM k2 GROUP BY ALL),
du AS (SELECT control, sum((m * m - sq) / (m - 1)) AS dobs, avg((sq - m) / (m * (m - 1))) AS pa
       FROM u WHERE m >= 2 GROUP BY ALL),
subj AS (SELECT control, count(*) AS ns FROM u GROUP BY ALL),
pik AS (SELECT uk.control, label, sum(n / m) / any_value(ns) AS pi
        FROM uk JOIN u USING (control, subject) JOIN subj USING (control) GROUP BY ALL),
pe AS (SELECT control, count(*) AS q, sum(pi * (1 - pi)) AS s FROM pik GROUP BY ALL),
coef AS (SELECT control,
    CASE WHEN q >= 2 THEN 1 - (n - 1) * dobs / de END AS krippendorff_alpha,
    CASE WHEN q >= 2 THEN (pa - s / (q - 1)) / (1 - s / (q - 1)) END AS gwet_ac1
  FROM pe JOIN du USING (control) JOIN kt USING (control))
"""


_TASK_RATINGS = f"""
SELECT control, task_id AS subject, annotator AS rater, ann_pos, label FROM (SELECT * FROM {_REQUIRED}) a
WHERE task_id IN (SELECT task_id FROM (SELECT * FROM {_REQUIRED}) b GROUP BY task_id HAVING count(DISTINCT ann_pos) > 1)
"""

_SPLIT = """
records AS (SELECT doc_id AS record_id, text, lang AS label, md5(concat('42:', CAST(doc_id AS VARCHAR))) AS k FROM documents),
counts AS (SELECT label, count(*) AS n, CAST(floor(0.8 * (SELECT count(*) FROM documents)) AS BIGINT) AS n_train,
                  (SELECT count(*) FROM documents) AS total FROM records GROUP BY label),
base AS (SELECT *, (n_train * n) // total AS b, (n_train * n) % total AS r FROM counts),
quota AS (SELECT label, b + CASE WHEN row_number() OVER (ORDER BY r DESC, label) <= n_train - (SELECT sum(b) FROM base)
                                 THEN 1 ELSE 0 END AS q FROM base),
ranked AS (SELECT r.*, q, row_number() OVER (PARTITION BY r.label ORDER BY k, record_id) AS rn
           FROM records r JOIN quota USING (label)),
split AS (SELECT record_id, text, label, CASE WHEN rn <= q THEN 'train' ELSE 'test' END AS split FROM ranked)
"""
_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
_TF = f"""
tf AS (SELECT record_id, label, split, term, count(*) AS tf
       FROM (SELECT record_id, label, split, unnest({_TOKENS}) AS term FROM split) GROUP BY ALL),
vocab AS (SELECT term, count(*) AS df, sum(tf) AS total_tf,
                 ln((1.0 + (SELECT count(*) FROM split WHERE split = 'train')) / (1.0 + count(*))) + 1.0 AS idf
          FROM tf WHERE split = 'train' GROUP BY term),
raw AS (SELECT record_id, label, split, term, tf * idf AS w FROM tf JOIN vocab USING (term)),
norm AS (SELECT record_id, sqrt(sum(w * w)) AS size FROM raw GROUP BY record_id),
weights AS (SELECT record_id, label, split, term, w / size AS weight FROM raw JOIN norm USING (record_id))
"""
_NB_FIT = f"""
{_SPLIT}, {_TF},
nct AS (SELECT label, term, sum(weight) AS n FROM weights WHERE split = 'train' GROUP BY ALL),
nc AS (SELECT label, sum(n) AS n FROM nct GROUP BY label),
vsize AS (SELECT count(*) AS v FROM vocab),
prior AS (SELECT label, ln(count(*) / (SELECT count(*) FROM split WHERE split = 'train')) AS lp
          FROM split WHERE split = 'train' GROUP BY label)
"""


def _nb_scores(alpha: str = "1.0", docs: str = "test_docs") -> str:
    """Scores of all classes for the documents of relation ``docs(record_id)``, weights in ``weights``."""
    return f"""
SELECT d.record_id, p.label,
       p.lp + coalesce(s.total, 0) * (ln({alpha}) - ln(nc.n + {alpha} * v)) + coalesce(g.gain, 0) AS score
FROM (SELECT record_id FROM {docs}) d CROSS JOIN prior p JOIN nc USING (label) CROSS JOIN vsize
LEFT JOIN (SELECT record_id, sum(weight) AS total FROM weights GROUP BY record_id) s USING (record_id)
LEFT JOIN (SELECT w.record_id, nct.label, sum(w.weight * (ln(nct.n + {alpha}) - ln({alpha}))) AS gain
           FROM weights w JOIN nct USING (term) GROUP BY ALL) g
  ON g.record_id = d.record_id AND g.label = p.label
"""


_NB = f"""
WITH {_NB_FIT},
test_docs AS (SELECT record_id, label FROM split WHERE split = 'test'),
scores AS ({_nb_scores()}),
pred AS (SELECT record_id, label AS y_pred FROM scores
         QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY round(score, 9) DESC, label) = 1)
"""


def _metrics(relation: str, by: str) -> str:
    """Weighted metrics of ``relation(by, y_true, y_pred)``."""
    return f"""
SELECT {by}, sum(tp) / sum(support) AS accuracy,
       sum(support * CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END) / sum(support) AS precision,
       sum(support * CASE WHEN support > 0 THEN tp / support ELSE 0 END) / sum(support) AS recall,
       sum(support * CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END) / sum(support) AS f1,
       CAST(sum(support) AS BIGINT) AS n_rows
FROM (SELECT {by}, label, CAST(sum(s) AS DOUBLE) AS support, CAST(sum(p) AS DOUBLE) AS predicted,
             CAST(sum(t) AS DOUBLE) AS tp
      FROM (SELECT {by}, y_true AS label, 1 AS s, 0 AS p, CASE WHEN y_true = y_pred THEN 1 ELSE 0 END AS t FROM {relation}
            UNION ALL SELECT {by}, y_pred, 0, 1, 0 FROM {relation}) GROUP BY ALL)
GROUP BY {by}
"""


_ROUND4 = (
    "round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, "
    "round(recall, 6) AS recall, round(f1, 6) AS f1"
)
_PRED = fx.for_duckdb(fx.PREDICTIONS)
_BOARD = f"""
WITH predictions AS ({_PRED}), m AS ({_metrics('predictions', 'model_name')}),
rows_ AS (SELECT model_name, {_ROUND4}, CAST(NULL AS VARCHAR) AS error FROM m
          UNION ALL SELECT 'm0', NULL, NULL, NULL, NULL, 'model file is missing'),
board AS (SELECT *, CAST(row_number() OVER (ORDER BY f1 DESC NULLS LAST, model_name) AS INTEGER) AS rank FROM rows_)
"""

_URLS = f"SELECT * FROM ({fx.for_duckdb(fx.URL_LIST)}) AS listed WHERE trim(url) <> ''"
_LOOKUP = f"""
articles AS ({_ART}), urls AS ({_URLS}),
first_hit AS (SELECT url, arg_min(story_id, seq) AS story_id, arg_min(text, seq) AS text FROM articles
              WHERE publish_date BETWEEN DATE '2024-01-01' AND DATE '2024-10-31' GROUP BY url),
looked AS (SELECT u.line_no, u.url, f.story_id, f.text FROM urls u LEFT JOIN first_hit f USING (url))
"""
# The texts of the found stories are scored with the model of the training split.
_INFER = f"""
WITH {_LOOKUP}, {_NB_FIT.replace('weights AS', 'weights_t AS').replace('FROM weights WHERE', 'FROM weights_t WHERE')},
stories AS (SELECT DISTINCT story_id AS record_id, text FROM looked WHERE story_id IS NOT NULL),
stf AS (SELECT record_id, term, count(*) AS tf FROM (SELECT record_id, unnest({_TOKENS}) AS term FROM stories) GROUP BY ALL),
sraw AS (SELECT record_id, term, tf * idf AS w FROM stf JOIN vocab USING (term)),
weights AS (SELECT record_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY record_id)) AS weight FROM sraw),
scores AS ({_nb_scores(docs='stories')}),
pred AS (SELECT record_id, label AS y_pred FROM scores
         QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY round(score, 9) DESC, label) = 1),
inferred AS (SELECT l.line_no, l.story_id, l.url, 'nb' AS model_used, p.y_pred
             FROM looked l JOIN pred p ON p.record_id = l.story_id)
"""

# Pages.
_HREF = r"""(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)"""
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
_HIDDEN = (
    r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<noscript[^>]*>.*?</noscript>"
)
_BREAK = r"(?i)<br\s*/?>|</?(p|h[1-6]|li|ul|ol|div|tr|table|blockquote)(\s[^>]*)?>"


def _decode(sql: str) -> str:
    for entity, character in (
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"),
        ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
    ):
        sql = f"replace({sql}, '{entity}', '{character}')"
    return sql


_VISIBLE = f"regexp_replace(html, '{_HIDDEN}', '', 'g')"
_BODY = (
    f"regexp_replace(regexp_replace(regexp_extract({_VISIBLE}, '(?is)<article[^>]*>(.*?)</article>', 1), "
    rf"'\s+', ' ', 'g'), '{_BREAK}', chr(10), 'g')"
)
_PLAIN = _decode(f"regexp_replace({_BODY}, '(?s)<[^>]*>', '', 'g')")
_TITLE = _decode(
    "regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '(?s)<[^>]*>', '', 'g')"
)
_EXTRACT = f"""
SELECT page_id, url, trim({_TITLE}, {_WS}) AS title,
       trim(regexp_replace({_PLAIN}, ' *\\n[ \\n]*', chr(10), 'g'), {_WS}) AS text,
       CAST(NULL AS DATE) AS publish_date
FROM pages
"""



def _hrefs(pages: str = "pages") -> str:
    """Distinct links of the pages with their raw values."""
    value = _decode("""regexp_replace(h, '^["'']|["'']$', '', 'g')""")
    return rf"""
SELECT DISTINCT page_id, CASE WHEN h LIKE '//%' THEN concat(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*:)//', 1), h)
       WHEN h LIKE '/%' THEN concat(regexp_extract(url, '{_ORIGIN}', 1), h) ELSE h END AS link, h
FROM (SELECT page_id, url, {value} AS h FROM (SELECT page_id, url, unnest(regexp_extract_all({_VISIBLE}, '{_HREF}', 1)) AS h FROM {pages}))
"""


_HREFS = _hrefs()

_DOMAIN = "replace(regexp_extract({}, '^[^:]*://([^/?#]*)', 1), 'www.', '')"
_MATCH = f"""
WITH cat AS ({fx.for_duckdb(fx.CATALOGUE)}),
dir AS (SELECT {_DOMAIN.format('url')} AS domain, page_id,
               CASE WHEN {_DOMAIN.format('url')} LIKE '%.org' THEN concat('id-', CAST(page_id AS VARCHAR))
                    ELSE CAST(page_id AS VARCHAR) END AS id FROM pages),
ids AS (SELECT domain, arg_min(id, page_id) AS id FROM dir WHERE domain NOT LIKE '%.net' GROUP BY domain),
present AS (SELECT *, {_DOMAIN.format('homepage_url')} AS clean_domain FROM cat
            WHERE regexp_matches(lower(trim(present)), '^yes')),
matched AS (SELECT p.*, TRY_CAST(i.id AS BIGINT) AS source_id FROM present p LEFT JOIN ids i ON p.clean_domain = i.domain)
"""

_CONFIG_CTES = f"""
{_SPLIT},
toks AS (SELECT record_id, label, split, {_TOKENS} AS t FROM split),
grams AS (SELECT record_id, label, split, 1 AS n, unnest(t) AS term FROM toks
          UNION ALL
          SELECT record_id, label, split, 2 AS n, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term
          FROM toks WHERE len(t) >= 2),
cfg(config_id, alpha, hi, min_df, max_share) AS (VALUES ('nb_alpha_001', 0.01::DOUBLE, 1, 1, 1.0::DOUBLE),
    ('nb_alpha_100', 1.0::DOUBLE, 1, 2, 0.9::DOUBLE), ('nb_bigrams', 0.1::DOUBLE, 2, 3, 1.0::DOUBLE),
    ('nb_nothing', 1.0::DOUBLE, 1, 1000000000, 1.0::DOUBLE)),
ntrain AS (SELECT count(*) AS nt FROM split WHERE split = 'train'),
tf AS (SELECT record_id, label, split, n, term, count(*) AS tf FROM grams GROUP BY ALL),
dfs AS (SELECT n, term, count(*) AS df FROM tf WHERE split = 'train' GROUP BY ALL),
vocab AS (SELECT config_id, alpha, n, term, ln((1.0 + nt) / (1.0 + df)) + 1.0 AS idf
          FROM dfs JOIN cfg ON n <= hi AND df >= min_df CROSS JOIN ntrain WHERE df <= max_share * nt),
raw AS (SELECT record_id, label, split, config_id, alpha, term, tf * idf AS w FROM tf JOIN vocab USING (n, term)),
weights AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY record_id, config_id)) AS weight FROM raw),
nct AS (SELECT config_id, alpha, label, term, sum(weight) AS n FROM weights WHERE split = 'train' GROUP BY ALL),
nc AS (SELECT config_id, alpha, label, sum(n) AS n FROM nct GROUP BY ALL),
vsize AS (SELECT config_id, count(*) AS v FROM vocab GROUP BY ALL),
prior AS (SELECT label, ln(count(*) / (SELECT nt FROM ntrain)) AS lp FROM split WHERE split = 'train' GROUP BY label),
test_w AS (SELECT * FROM weights WHERE split = 'test'),
total AS (SELECT record_id, config_id, sum(weight) AS w FROM test_w GROUP BY ALL),
gain AS (SELECT t.record_id, t.config_id, nct.label, sum(t.weight * (ln(nct.n + nct.alpha) - ln(nct.alpha))) AS g
         FROM test_w t JOIN nct ON nct.config_id = t.config_id AND nct.term = t.term GROUP BY ALL),
scores AS (SELECT d.record_id, d.label AS y_true, nc.config_id, nc.label,
                  lp + coalesce(total.w, 0) * (ln(nc.alpha) - ln(nc.n + nc.alpha * v)) + coalesce(g, 0) AS score
           FROM (SELECT record_id, label FROM split WHERE split = 'test') d CROSS JOIN nc
           JOIN prior ON prior.label = nc.label JOIN vsize ON vsize.config_id = nc.config_id
           LEFT JOIN total ON total.record_id = d.record_id AND total.config_id = nc.config_id
           LEFT JOIN gain ON gain.record_id = d.record_id AND gain.config_id = nc.config_id AND gain.label = nc.label),
pred AS (SELECT config_id, record_id, y_true, label AS y_pred FROM scores
         QUALIFY row_number() OVER (PARTITION BY config_id, record_id ORDER BY round(score, 9) DESC, label) = 1)
"""

_SWEEP = f"""
WITH {_NB_FIT},
test_docs AS (SELECT record_id, label AS y_true FROM split WHERE split = 'test'),
trials(trial, alpha) AS (VALUES (0, 0.01::DOUBLE), (1, 0.1::DOUBLE), (2, 1.0::DOUBLE), (3, 10.0::DOUBLE), (4, 0.0::DOUBLE)),
good AS (SELECT * FROM trials WHERE alpha > 0),
total AS (SELECT record_id, sum(weight) AS w FROM weights WHERE split = 'test' GROUP BY ALL),
gain AS (SELECT w.record_id, nct.label, trial, sum(w.weight * (ln(nct.n + alpha) - ln(alpha))) AS g
         FROM weights w JOIN nct USING (term) CROSS JOIN good WHERE w.split = 'test' GROUP BY ALL),
scores AS (SELECT d.record_id, d.y_true, t.trial, p.label,
                  p.lp + coalesce(total.w, 0) * (ln(t.alpha) - ln(nc.n + t.alpha * v)) + coalesce(g, 0) AS score
           FROM test_docs d CROSS JOIN good t CROSS JOIN prior p JOIN nc ON nc.label = p.label CROSS JOIN vsize
           LEFT JOIN total ON total.record_id = d.record_id
           LEFT JOIN gain ON gain.record_id = d.record_id AND gain.trial = t.trial AND gain.label = p.label),
pred AS (SELECT trial, record_id, y_true, label AS y_pred FROM scores
         QUALIFY row_number() OVER (PARTITION BY trial, record_id ORDER BY round(score, 9) DESC, label) = 1),
m AS ({_metrics('pred', 'trial')})
SELECT t.trial, t.alpha, CASE WHEN t.alpha <= 0 THEN 0.0 ELSE round(accuracy, 6) END AS accuracy,
       CASE WHEN t.alpha <= 0 THEN 0.0 ELSE round(precision, 6) END AS precision,
       CASE WHEN t.alpha <= 0 THEN 0.0 ELSE round(recall, 6) END AS recall,
       CASE WHEN t.alpha <= 0 THEN 0.0 ELSE round(f1, 6) END AS f1
FROM trials t LEFT JOIN m USING (trial)
"""

_SCORED_WORDS = f"""
SELECT doc_id AS record_id, term, count(*) AS tf
FROM (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents) GROUP BY ALL
"""

_FLAT_TASKS = f"""
{_ARTICLES}, t AS (SELECT trim(text, {_WS}) AS text, story_id, title, url, language, publish_date FROM articles)
SELECT md5(text) AS text_md5, story_id, md5(nullif(title, '')) AS title_md5, nullif(url, '') AS url,
       nullif(language, '') AS language, CAST(publish_date AS VARCHAR) AS publish_date,
       concat('mc_story_', story_id) AS external_id
FROM t WHERE length(text) > 0
"""

_KAPPA = """
lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
                 row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey
                                    ORDER BY l_shipdate DESC, l_extendedprice DESC) AS rn FROM lineitem),
pairs AS (SELECT CASE WHEN l_returnflag = 'N' THEN 'O' ELSE 'F' END AS a, l_linestatus AS b FROM lines WHERE rn = 1),
tot AS (SELECT count(*) AS n, count(*) FILTER (a = b) AS same FROM pairs),
pe AS (SELECT sum(na * nb) AS cross_ FROM
       (SELECT a AS label, CAST(count(*) AS DOUBLE) AS na FROM pairs GROUP BY a) JOIN
       (SELECT b AS label, CAST(count(*) AS DOUBLE) AS nb FROM pairs GROUP BY b) USING (label))
"""

_VECTOR_SPLIT = _SPLIT.replace(
    "doc_id AS record_id, text, lang AS label, md5(concat('42:', CAST(doc_id AS VARCHAR))) AS k",
    "vec_id AS record_id, embedding AS text, CAST(label AS VARCHAR) AS label, md5(concat('42:', CAST(vec_id AS VARCHAR))) AS k",
).replace("documents", "embeddings")
_BATCH = f"""
WITH {_VECTOR_SPLIT},
dims AS (SELECT record_id, label, split, unnest(text) AS x, generate_subscripts(text, 1) AS dim FROM split),
mean AS (SELECT label, dim, avg(CAST(x AS DOUBLE)) AS c FROM dims WHERE split = 'train' GROUP BY ALL),
bias AS (SELECT label, -0.5 * sum(c * c) AS b FROM mean GROUP BY label),
score AS (SELECT d.record_id AS vec_id, d.label AS label, m.label AS cls, sum(CAST(d.x AS DOUBLE) * m.c) + any_value(b) AS s
          FROM dims d JOIN mean m USING (dim) JOIN bias ON bias.label = m.label WHERE d.split = 'test' GROUP BY ALL)
SELECT vec_id, label, cls AS y_pred FROM score
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, cls) = 1
"""

ORACLE: dict[str, str] = {
    "story_search": f"{_ARTICLES} SELECT story_id, media_id, language, publish_date FROM articles WHERE {_SEARCH}",
    "story_phrase_search": f"{_ARTICLES} SELECT story_id, media_id FROM articles WHERE {_term('of' + chr(92) + 's+the')} "
    "AND media_id IN ('src1', 'src2', 'src3') AND publish_date BETWEEN DATE '2020-01-01' AND DATE '2024-12-31'",
    "story_count_by_source": f"{_ARTICLES} SELECT media_id, count(*) AS n_stories FROM articles WHERE {_SEARCH} GROUP BY media_id",
    "source_listing": f"{_ARTICLES} SELECT DISTINCT media_id FROM articles "
    "WHERE publish_date BETWEEN DATE '2024-03-01' AND DATE '2024-03-10'",
    "url_prefix_search": f"{_ARTICLES} SELECT story_id, url FROM articles WHERE starts_with(url, 'https://src1.example.org/fr/') "
    "AND publish_date BETWEEN DATE '2020-01-01' AND DATE '2024-12-31'",
    "keyword_articles": f"{_ARTICLES} SELECT story_id, language FROM articles "
    "WHERE contains(lower(title), 'que les') OR contains(lower(text), 'que les') "
    "OR contains(lower(title), 'and the') OR contains(lower(text), 'and the')",
    "ingest_new_articles": f"{_INGEST} SELECT story_id, url, st AS status, 'new' AS origin, seq, CAST(length(text) AS INTEGER) AS text_length FROM fresh "
    "UNION ALL SELECT story_id, url, status, 'existing', seq, CAST(length(text) AS INTEGER) FROM old",
    "ingest_with_limit": f"{_INGEST}, cut AS (SELECT seq FROM fresh ORDER BY seq LIMIT 1 OFFSET 99) "
    "SELECT story_id, url, st AS status, 'new' AS origin, seq FROM fresh WHERE seq <= coalesce((SELECT seq FROM cut), seq) "
    "UNION ALL SELECT story_id, url, status, 'existing', seq FROM old WHERE seq < coalesce((SELECT seq FROM cut), seq + 1)",
    "index_merge": f"{_ARTICLES}, idx AS ({_IDX}), fresh AS (SELECT story_id, status, CAST(length(text) AS BIGINT) AS text_length, query "
    "FROM articles WHERE url <> '') SELECT * FROM fresh UNION ALL SELECT story_id, status, text_length, query FROM idx "
    "WHERE story_id NOT IN (SELECT story_id FROM fresh)",
    "retrieval_status": f"{_ARTICLES} SELECT status, count(*) AS n, round((SELECT 100.0 * count(*) FILTER (status = 'success') / count(*) "
    "FROM articles), 6) AS success_rate FROM articles GROUP BY status",
    "text_length_stats": f"{_ARTICLES}, l AS (SELECT length(text) AS len FROM articles WHERE length(text) > 0), "
    "o AS (SELECT len, row_number() OVER (ORDER BY len) AS rn, count(*) OVER () AS n FROM l) "
    "SELECT round((SELECT avg(len) FROM l), 6) AS mean_length, CAST((SELECT min(len) FROM l) AS INTEGER) AS min_length, "
    "CAST((SELECT max(len) FROM l) AS INTEGER) AS max_length, CAST(len AS INTEGER) AS median_length FROM o WHERE rn = n // 2 + 1",
    "language_breakdown": f"{_ARTICLES} SELECT coalesce(language, 'unknown') AS language, count(*) AS n FROM articles GROUP BY 1",
    "save_counts": f"{_ARTICLES}, idx AS ({_IDX}) SELECT CAST(count(*) FILTER (status = 'success' AND story_id NOT IN "
    "(SELECT story_id FROM idx)) AS BIGINT) AS n_new_saved, CAST(count(*) FILTER (status <> 'success') AS BIGINT) AS n_failed "
    "FROM articles WHERE url <> ''",
    "failed_urls": f"{_ARTICLES} SELECT url FROM articles WHERE url <> '' AND status <> 'success'",
    "label_tasks": _FLAT_TASKS,
    "task_json": f"SELECT external_id, story_id, url, text_md5 FROM ({_FLAT_TASKS})",
    "new_tasks": f"WITH new_t AS ({fx.for_duckdb(fx.NEW_TASKS)}), old_t AS ({fx.for_duckdb(fx.PROJECT_TASKS)}) "
    "SELECT story_id, task_seq FROM new_t WHERE story_id IS NULL OR story_id NOT IN (SELECT story_id FROM old_t)",
    "labelled_records": f"{_TRAINING} SELECT task_id, ann_pos, annotation_id, q AS label, "
    "concat_ws('|', q, concat('note_', language), CASE WHEN ann_pos = 1 THEN 'extra' END, t) AS labels, language, annotated_by, "
    f"md5(trim(text, {_WS})) AS text_md5 FROM ann",
    "target_label_records": f"{_TRAINING} SELECT task_id, ann_pos, annotation_id, t AS label, t AS labels, language, annotated_by, "
    f"md5(trim(text, {_WS})) AS text_md5 FROM ann WHERE t IS NOT NULL",
    "label_distribution": f"{_TRAINING}, x AS (SELECT q AS label FROM ann UNION ALL SELECT concat('note_', language) FROM ann "
    "UNION ALL SELECT 'extra' FROM ann WHERE ann_pos = 1 UNION ALL SELECT t FROM ann WHERE t IS NOT NULL) "
    "SELECT label, count(*) AS n FROM x GROUP BY label",
    "skipped_tasks": f"SELECT count(*) AS n_tasks, CAST(count(*) FILTER (length(trim(text, {_WS})) = 0) AS BIGINT) AS n_skipped "
    "FROM labels JOIN documents USING (doc_id)",
    "analysis_records": f"SELECT * FROM ({_ANN})",
    "required_labels": f"{_LONG} SELECT * FROM long",
    "project_summary": f"{_LONG}, t AS (SELECT task_id, count(DISTINCT ann_pos) AS n FROM long GROUP BY task_id) "
    "SELECT count(*) AS total_tasks, CAST(sum(n) AS BIGINT) AS total_annotations, "
    "CAST(count(*) FILTER (n > 1) AS BIGINT) AS tasks_with_multiple_annotations, "
    "(SELECT count(DISTINCT annotator) FROM long) AS unique_annotators, "
    "CAST(round_even(CAST(sum(n) AS DECIMAL(18, 6)) / count(*), 2) AS DOUBLE) AS average_annotations_per_task FROM t",
    "several_raters": f"{_LONG}, t AS (SELECT task_id, count(DISTINCT annotator) AS n FROM long GROUP BY task_id) "
    "SELECT CAST(count(*) FILTER (n > 1) AS BIGINT) AS n_tasks FROM t",
    "annotator_counts": f"{_LONG} SELECT annotator, count(DISTINCT (task_id, ann_pos)) AS n_annotations, min(task_id) AS first_task, "
    "arg_min(ann_pos, task_id * 1000 + ann_pos) AS first_pos FROM long GROUP BY annotator",
    "annotator_extremes": f"{_LONG}, c AS (SELECT annotator, count(DISTINCT (task_id, ann_pos)) AS n, "
    "min(task_id * 1000 + ann_pos) AS seen FROM long GROUP BY annotator) SELECT "
    "(SELECT annotator FROM c ORDER BY n DESC, seen LIMIT 1) AS most_active, (SELECT max(n) FROM c) AS most_n, "
    "(SELECT annotator FROM c ORDER BY n, seen DESC LIMIT 1) AS least_active, (SELECT min(n) FROM c) AS least_n",
    "label_grouping_sets": f"{_LONG} SELECT annotator, control, label, count(*) AS n, CAST(grouping(annotator, control, label) AS BIGINT) AS level FROM long "
    "GROUP BY GROUPING SETS ((label), (control, label), (annotator, control, label))",
    "label_schema": f"SELECT control, string_agg(DISTINCT label, '|' ORDER BY label) AS labels FROM ({_ANN}) GROUP BY control",
    "label_share": f"{_LONG} SELECT label, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM long), 6) AS percent FROM long GROUP BY label",
    "lead_time_stats": f"{_LONG}, r AS (SELECT DISTINCT task_id, ann_pos, lead_time FROM long) SELECT round(avg(lead_time), 6) AS average_lead_time, "
    "min(lead_time) AS min_lead_time, max(lead_time) AS max_lead_time, round(median(lead_time), 6) AS median_lead_time FROM r WHERE lead_time > 0",
    "simple_agreement": f"{_SIMPLE} SELECT task_id, control, n_records, num_annotators, round(agreement_ratio, 6) AS agreement_ratio, all_agree, "
    "most_common_label, label_distribution FROM simple",
    "task_agreement": f"{_SIMPLE} SELECT * FROM per_task",
    "agreement_summary": f"{_SIMPLE} SELECT count(*) AS n_tasks, round(avg(overall_simple_agreement), 6) AS mean_agreement, "
    "min(overall_simple_agreement) AS min_agreement, max(overall_simple_agreement) AS max_agreement, "
    "CAST(count(*) FILTER (has_disagreement) AS BIGINT) AS n_disagreement FROM per_task",
    "agreement_metrics": f"WITH {_coefficients(_TASK_RATINGS)} SELECT control, round(krippendorff_alpha, 6) AS krippendorff_alpha, "
    "round(gwet_ac1, 6) AS gwet_ac1 FROM coef WHERE coalesce(krippendorff_alpha, gwet_ac1) IS NOT NULL",
    "agreement_bands": f"WITH {_coefficients(_TASK_RATINGS)}, m AS (SELECT control, 'krippendorff_alpha' AS metric, krippendorff_alpha AS v FROM coef "
    "UNION ALL SELECT control, 'gwet_ac1', gwet_ac1 FROM coef) SELECT control, metric, round(v, 6) AS value, "
    "CASE WHEN v >= 0.8 THEN 'Excellent' WHEN v >= 0.6 THEN 'Good' WHEN v >= 0.4 THEN 'Moderate' WHEN v >= 0.2 THEN 'Fair' "
    "WHEN v >= 0 THEN 'Poor' ELSE 'Worse than random' END AS band FROM m WHERE v IS NOT NULL",
    "krippendorff_alpha": f"WITH {_coefficients(fx.for_duckdb(fx.RATINGS))} SELECT control, round(krippendorff_alpha, 6) AS krippendorff_alpha FROM coef",
    "gwet_ac1": f"WITH {_coefficients(fx.for_duckdb(fx.RATINGS))} SELECT control, round(gwet_ac1, 6) AS gwet_ac1 FROM coef",
    "cohen_kappa": f"WITH {_KAPPA} SELECT 'flags' AS control, round((same / n - cross_ / n / n) / (1 - cross_ / n / n), 6) AS cohen_kappa FROM tot, pe",
    "stratified_split": f"WITH {_SPLIT} SELECT record_id, label, split FROM split",
    "split_summary": f"WITH {_SPLIT} SELECT split, label, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share "
    "FROM split GROUP BY split, label",
    "split_sizes": f"WITH {_SPLIT} SELECT split, count(*) AS n_rows, count(DISTINCT label) AS n_labels, "
    "round(count(*) / (SELECT count(*) FROM split), 6) AS ratio FROM split GROUP BY split",
    "task_id_range": f"{_TRAINING} SELECT min(task_id) AS min_task_id, max(task_id) AS max_task_id FROM ann",
    "tokens": f"{_SCORED_WORDS}",
    "bigram_vocabulary": f"WITH d AS (SELECT doc_id, list_filter({_TOKENS}, lambda x: x NOT IN ('the', 'de', 'der')) AS t FROM documents), "
    "g AS (SELECT doc_id, unnest(t) AS term FROM d UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) "
    "FROM d WHERE len(t) >= 2), tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL), n AS (SELECT count(*) AS n FROM documents) "
    "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf, round(ln((1.0 + any_value(n)) / (1.0 + count(*))) + 1.0, 6) AS idf "
    "FROM tf, n GROUP BY term HAVING count(*) >= 3 AND count(*) <= 0.5 * any_value(n)",
    "top_vocabulary": f"WITH tf AS ({_SCORED_WORDS}), n AS (SELECT count(*) AS n FROM documents) "
    "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf, round(ln((1.0 + any_value(n)) / (1.0 + count(*))) + 1.0, 6) AS idf "
    "FROM tf, n GROUP BY term ORDER BY total_tf DESC, term LIMIT 500",
    "idf": f"WITH {_SPLIT}, {_TF} SELECT term, df, CAST(total_tf AS BIGINT) AS total_tf, round(idf, 6) AS idf FROM vocab",
    "tfidf_l2": f"WITH {_SPLIT}, {_TF} SELECT record_id, term, round(weight, 6) AS weight FROM weights WHERE split = 'test'",
    "truncated_tokens": f"SELECT doc_id AS record_id, CAST(len({_TOKENS}[1:256]) AS INTEGER) AS n_tokens, "
    f"md5(array_to_string({_TOKENS}[1:256], ' ')) AS tokens_md5 FROM documents",
    "label_encoding": "SELECT lang AS label, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS class_id "
    "FROM (SELECT DISTINCT lang FROM documents)",
    "nb_params": f"WITH {_NB_FIT} SELECT p.label, vocab.term, round(ln(coalesce(nct.n, 0) + 1.0) - ln(nc.n + v), 6) AS log_lik "
    "FROM vocab CROSS JOIN prior p JOIN nc USING (label) CROSS JOIN vsize LEFT JOIN nct ON nct.label = p.label AND nct.term = vocab.term",
    "nb_predict": f"{_NB} SELECT t.record_id, t.label, y_pred FROM test_docs t JOIN pred USING (record_id)",
    "nb_proba": f"{_NB}, top AS (SELECT record_id, max(score) AS m FROM scores GROUP BY record_id) "
    "SELECT record_id, label, round(exp(score - m) / sum(exp(score - m)) OVER (PARTITION BY record_id), 6) AS probability "
    "FROM scores JOIN top USING (record_id)",
    "nb_evaluate": f"{_NB}, x AS (SELECT 'nb' AS model_name, label AS y_true, y_pred FROM test_docs JOIN pred USING (record_id)), "
    f"m AS ({_metrics('x', 'model_name')}) SELECT model_name, {_ROUND4} FROM m",
    "nb_configs": f"WITH {_CONFIG_CTES}, m AS ({_metrics('pred', 'config_id')}) SELECT cfg.config_id, {_ROUND4} FROM cfg LEFT JOIN m USING (config_id)",
    "nb_alpha_sweep": _SWEEP,
    "confusion": f"WITH p AS ({_PRED}) SELECT model_name, y_true, y_pred, count(*) AS n FROM p GROUP BY ALL",
    "weighted_metrics": f"WITH p AS ({_PRED}), m AS ({_metrics('p', 'model_name')}) SELECT model_name, {_ROUND4}, n_rows FROM m",
    "model_leaderboard": f"{_BOARD} SELECT * FROM board",
    "best_model": f"{_BOARD} SELECT model_name, accuracy, precision, recall, f1 FROM board WHERE rank = 1",
    "url_lookup": f"WITH {_LOOKUP} SELECT line_no, url, story_id, md5(text) AS text_md5 FROM looked",
    "inference_misses": f"WITH {_LOOKUP} SELECT count(*) AS n_urls, count(story_id) AS n_found, "
    "CAST(count(*) FILTER (story_id IS NULL) AS BIGINT) AS n_missing FROM looked",
    "url_inference": f"{_INFER} SELECT * FROM inferred",
    "prediction_distribution": f"{_INFER} SELECT y_pred, count(*) AS n FROM inferred GROUP BY y_pred",
    "batch_scoring": _BATCH,
    "page_links": f"SELECT DISTINCT page_id, link FROM ({_HREFS})",
    "section_links": f"SELECT DISTINCT link FROM ({_HREFS}) WHERE regexp_matches(h, '^/[A-Z]')",
    "page_text": _EXTRACT,
    "fetch_and_filter": f"SELECT title, url, publish_date, concat(replace(substr(text, 1, 300), chr(10), ' '), '...') AS snippet "
    f"FROM ({_EXTRACT}) WHERE length(text) >= 200 AND (contains(lower(title), 'climate') OR contains(lower(text), 'climate') "
    "OR contains(lower(title), ' the ') OR contains(lower(text), ' the ') OR contains(lower(title), 'der ') OR contains(lower(text), 'der '))",
    "source_match": f"{_MATCH} SELECT * FROM matched",
    "source_match_counts": f"{_MATCH} SELECT count(*) AS n_sources, CAST(count(*) FILTER (source_id IS NULL) AS BIGINT) AS n_without_id, "
    "CAST(count(*) FILTER (clean_domain IS NULL) AS BIGINT) AS n_without_domain FROM matched",
    "unmatched_sources": f"{_MATCH} SELECT row_no, clean_domain FROM matched WHERE source_id IS NULL",
    "full_text_fallback": f"WITH articles AS ({_ART}), urls AS ({_URLS}), ex AS ({_EXTRACT}), "
    "a AS (SELECT url, arg_min(text, seq) AS t FROM articles GROUP BY url), "
    "p AS (SELECT url, arg_min(concat(title, chr(10), chr(10), text), page_id) AS t FROM ex GROUP BY url) "
    "SELECT line_no, CASE WHEN a.t IS NOT NULL THEN 'archive' WHEN p.t IS NOT NULL THEN 'page' ELSE 'none' END AS origin, "
    "md5(coalesce(a.t, p.t, '')) AS text_md5 FROM urls LEFT JOIN a USING (url) LEFT JOIN p USING (url)",
    "lexicon_sentiment": f"WITH w AS ({_SCORED_WORDS}), lex AS ({fx.LEXICON}), "
    "s AS (SELECT record_id, sum(tf) AS hits, sum(tf * valence::DOUBLE) AS v, sum(tf * polarity::DOUBLE) AS p, sum(tf * subjectivity::DOUBLE) AS j "
    "FROM w JOIN lex USING (term) GROUP BY record_id), "
    "a AS (SELECT doc_id AS record_id, coalesce(hits, 0) AS hits, coalesce(v, 0) AS v, p, j FROM documents LEFT JOIN s ON doc_id = record_id) "
    "SELECT record_id, CAST(hits AS BIGINT) AS n_hits, round(v / sqrt(v * v + 15), 6) AS compound, "
    "CASE WHEN v / sqrt(v * v + 15) >= 0.05 THEN 'Positive' WHEN v / sqrt(v * v + 15) <= -0.05 THEN 'Negative' ELSE 'Neutral' END AS sentiment, "
    "round(coalesce(p, 0), 6) AS polarity, round(coalesce(j, 0), 6) AS subjectivity FROM a",
    "line_diff": f"WITH snap AS ({fx.for_duckdb(fx.SNAPSHOTS)}), "
    "n AS (SELECT doc_id, unnest(string_split(new_text, chr(10))) AS line, 1 AS d FROM snap), "
    "o AS (SELECT doc_id, unnest(string_split(old_text, chr(10))) AS line, -1 AS d FROM snap), "
    "t AS (SELECT doc_id, line, sum(d) AS delta FROM (SELECT * FROM n UNION ALL SELECT * FROM o) GROUP BY ALL) "
    "SELECT doc_id, md5(line) AS line_md5, CAST(delta AS BIGINT) AS delta FROM t WHERE delta <> 0",
    "stream_ingest": f"{_ARTICLES} SELECT story_id, url, 'success' AS status, CAST(CASE WHEN text = '' THEN 10 ELSE length(text) END AS INTEGER) AS text_length "
    "FROM articles WHERE url <> '' AND (text <> '' OR seq % 2 = 0)",
    "stream_tasks": _FLAT_TASKS,
    "stream_scores": f"WITH {_NB_FIT}, all_docs AS (SELECT record_id FROM split), scores AS ({_nb_scores(docs='all_docs')}) "
    "SELECT record_id, label AS y_pred FROM scores QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY round(score, 9) DESC, label) = 1",
}

_NB_ALPHA = _NB.replace("scores AS (", f"scores_a AS ({_nb_scores('0.01')}), pred_a AS (SELECT record_id, label AS y_pred FROM scores_a "
    "QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY round(score, 9) DESC, label) = 1), scores AS (", 1)
# Units of the grouped split: a source, with all rows that have none as one more.
_GROUPED = f"""
WITH records AS ({fx.for_duckdb(fx.GROUPED)}),
units AS (SELECT source, min(label) AS label, md5(concat('42:', coalesce(source, ''))) AS k FROM records GROUP BY source),
known AS (SELECT * FROM units WHERE label IS NOT NULL),
counts AS (SELECT label, count(*) AS n FROM known GROUP BY label),
totals AS (SELECT sum(n) AS total, CAST(floor(0.8 * sum(n)) AS BIGINT) AS n_train, min(n) < 2 AS plain FROM counts),
base AS (SELECT label, (n_train * n) // total AS b, (n_train * n) % total AS r, n_train, plain FROM counts, totals),
quota AS (SELECT CASE WHEN plain THEN 'all' ELSE label END AS stratum, label,
                 CASE WHEN plain THEN n_train ELSE b + CASE WHEN row_number() OVER (ORDER BY r DESC, label) <= n_train - (SELECT sum(b) FROM base)
                 THEN 1 ELSE 0 END END AS q FROM base),
ranked AS (SELECT u.source, row_number() OVER (PARTITION BY stratum ORDER BY k, u.source) AS rn, q FROM known u JOIN quota USING (label))
SELECT record_id, r.source, r.label, CASE WHEN rn <= q THEN 'train' WHEN rn > q THEN 'test' END AS split
FROM records r LEFT JOIN ranked ON r.source IS NOT DISTINCT FROM ranked.source
"""
_PLAIN_DATE = """CASE page_id % 4 WHEN 0 THEN make_date(2024, CAST(1 + page_id % 9 AS INTEGER), 15)
    WHEN 1 THEN make_date(2024, CAST(10 + page_id % 3 AS INTEGER), 5) END"""

ORACLE |= {
    "article_store": f"{_ARTICLES} SELECT story_id, url, status, publish_date, media_id, md5(text) AS text_md5, md5(title) AS title_md5 FROM articles",
    "article_index": f"{_ARTICLES}, idx AS ({_IDX}), fresh AS (SELECT story_id, status, CAST(length(text) AS BIGINT) AS text_length, query "
    "FROM articles WHERE url <> '') SELECT * FROM fresh WHERE CAST(story_id AS BIGINT) % 2 = 0 OR story_id NOT IN (SELECT story_id FROM idx) "
    "UNION ALL SELECT story_id, status, text_length, query FROM idx "
    "WHERE NOT (CAST(story_id AS BIGINT) % 2 = 0 AND story_id IN (SELECT story_id FROM fresh))",
    "article_csv": f"{_ARTICLES} SELECT story_id, nullif(url, '') AS url, md5(concat('\"q\", ', title)) AS title_md5, md5(nullif(text, '')) AS text_md5 FROM articles",
    "task_export": _FLAT_TASKS,
    "failed_url_list": ORACLE["failed_urls"],
    "url_list": f"SELECT trim(url) AS url FROM ({_URLS}) AS u",
    "annotated_export": ORACLE["analysis_records"],
    "split_store": ORACLE["stratified_split"],
    "source_catalogue": f"SELECT source_name, homepage_url, present, CAST(NULL AS VARCHAR) AS has_health, CAST(NULL AS VARCHAR) AS has_climate, "
    f"concat('say \"yes\",', chr(10), 'then ', source_name) AS notes FROM ({fx.for_duckdb(fx.CATALOGUE)}) AS c",
    "leaderboard_store": ORACLE["model_leaderboard"],
    "prediction_store": f"SELECT * FROM ({_PRED}) AS p",
    "agreement_report": f"{_SIMPLE} SELECT p.task_id, p.num_annotators, p.overall_simple_agreement, p.has_disagreement, s.control, "
    "s.num_annotators AS control_num_annotators, round(s.agreement_ratio, 6) AS control_agreement_ratio, s.all_agree AS control_all_agree, "
    "s.most_common_label AS control_most_common_label FROM per_task p JOIN simple s USING (task_id)",
    "grouped_split": _GROUPED,
    "nb_reloaded": ORACLE["nb_predict"],
    "fitted_models": f"{_NB_ALPHA}, answers AS (SELECT 'nb' AS model_name, label AS y_true, y_pred FROM pred JOIN test_docs USING (record_id) "
    "UNION ALL SELECT 'nb_alpha', label, y_pred FROM pred_a JOIN test_docs USING (record_id)), "
    f"m AS ({_metrics('answers', 'model_name')}), rows_ AS (SELECT model_name, {_ROUND4}, false AS failed, f1 AS f FROM m "
    "UNION ALL SELECT 'nb_broken', NULL, NULL, NULL, NULL, true, NULL) "
    "SELECT model_name, accuracy, precision, recall, f1, failed, CAST(row_number() OVER (ORDER BY f DESC NULLS LAST, model_name) AS INTEGER) AS rank FROM rows_",
    "page_links_forms": f"SELECT DISTINCT page_id, link FROM ({_hrefs('(' + fx.for_duckdb(fx.LINK_FORMS) + ') AS formed')})",
    "dated_articles": f"SELECT page_id, {_PLAIN_DATE} AS publish_date FROM pages WHERE {_PLAIN_DATE} IS NULL "
    f"OR {_PLAIN_DATE} BETWEEN DATE '2024-03-01' AND DATE '2024-09-30'",
}


def _variant(t: str, tf: str = "tf", idf: str = "ln((1.0 + n) / (1.0 + df)) + 1.0", size: str = "sqrt(sum(w * w))", tokens: str = _TOKENS, prior: str = "ln(k / n)") -> str:
    """CTEs ``weights_t`` and ``pred_t`` of one variant, with alpha 0.5; ``n`` documents, ``k`` of a class, ``c`` classes, ``i`` its place."""
    return f"""
tf_{t} AS (SELECT record_id, label, split, term, count(*) AS tf FROM (SELECT record_id, label, split, unnest({tokens}) AS term FROM split) GROUP BY ALL),
voc_{t} AS (SELECT term, count(*) AS df, (SELECT count(*) FROM split WHERE split = 'train') AS n FROM tf_{t} WHERE split = 'train' GROUP BY term),
raw_{t} AS (SELECT record_id, label, split, term, CAST(({tf}) * ({idf}) AS DOUBLE) AS w FROM tf_{t} JOIN voc_{t} USING (term)),
size_{t} AS (SELECT record_id, {size} AS size FROM raw_{t} GROUP BY record_id),
weights_{t} AS (SELECT record_id, label, split, term, w / size AS weight FROM raw_{t} JOIN size_{t} USING (record_id)),
nct_{t} AS (SELECT label, term, sum(weight) AS m FROM weights_{t} WHERE split = 'train' GROUP BY ALL),
cls_{t} AS (SELECT label, lp, coalesce(m, 0) AS m, v FROM (SELECT label, {prior} AS lp FROM (
              SELECT label, CAST(count(*) AS DOUBLE) AS k, sum(count(*)) OVER () AS n, count(*) OVER () AS c, row_number() OVER (ORDER BY label) AS i
              FROM split WHERE split = 'train' GROUP BY label))
            LEFT JOIN (SELECT label, sum(m) AS m FROM nct_{t} GROUP BY label) USING (label), (SELECT count(*) AS v FROM voc_{t})),
pred_{t} AS (SELECT record_id, y_true, cl AS y_pred FROM (
    SELECT d.record_id, d.label AS y_true, p.label AS cl,
           round(p.lp + coalesce(s.total, 0) * (ln(0.5) - ln(p.m + 0.5 * v)) + coalesce(g.gain, 0), 9) AS score
    FROM (SELECT record_id, label FROM split WHERE split = 'test') d CROSS JOIN cls_{t} p
    LEFT JOIN (SELECT record_id, sum(weight) AS total FROM weights_{t} GROUP BY record_id) s USING (record_id)
    LEFT JOIN (SELECT w.record_id, x.label AS cl, sum(w.weight * (ln(x.m + 0.5) - ln(0.5))) AS gain
               FROM weights_{t} w JOIN nct_{t} x USING (term) GROUP BY ALL) g ON g.record_id = d.record_id AND g.cl = p.label)
  QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY score DESC, cl) = 1)
"""


_VARIANTS = {
    "binary_l1": _variant("binary_l1", tf="1.0", size="sum(w)"),
    "sublinear_plain": _variant("sublinear_plain", tf="1.0 + ln(tf)", idf="ln(n / df) + 1.0", size="1.0"),
    "counts": _variant("counts", idf="1.0", size="1.0", prior="-ln(c)"),
    "cased_stops": _variant(
        "cased_stops", prior="ln([0.1, 0.2, 0.3, 0.4][i])",
        tokens=f"list_filter({_TOKENS.replace('lower(text)', 'text')}, lambda z: z NOT IN ('the', 'der', 'und', 'la'))",
    ),
}
_ALL_VARIANTS = f"WITH {_SPLIT}, " + ", ".join(_VARIANTS.values())
ORACLE |= {
    "tfidf_variants": f"{_ALL_VARIANTS} " + " UNION ALL ".join(
        f"SELECT '{t}' AS variant, record_id, term, round(weight, 6) AS weight FROM weights_{t} WHERE split = 'test'" for t in _VARIANTS
    ),
    "nb_documented_parameters": f"{_ALL_VARIANTS}, answers AS (" + " UNION ALL ".join(f"SELECT '{t}' AS config_id, y_true, y_pred FROM pred_{t}" for t in _VARIANTS)
    + f"), m AS ({_metrics('answers', 'config_id')}) SELECT config_id, {_ROUND4} FROM m",
    "sweep_resume": f"WITH trials AS ({ORACLE['nb_alpha_sweep']}) SELECT trial, alpha, f1 AS value FROM trials ORDER BY f1 DESC, trial LIMIT 1",
}


def _softmax(split: str, features: str, epochs: int, rate: float, decay: float) -> str:
    """CTEs ending in ``pred(epoch, record_id, y_true, y_pred)`` of the test side and ``hist(epoch, metrics)``, from zero weights.

    ``split`` gives ``split(record_id, label, split)``, ``features`` is a query of ``(record_id, split, feature, x)``.
    """
    parts = [
        split,
        f"f AS MATERIALIZED ({features})",
        "rec AS MATERIALIZED (SELECT record_id, label, split FROM split)",
        "cnt AS (SELECT count(*) AS n FROM rec WHERE split = 'train')",
        "b0 AS MATERIALIZED (SELECT DISTINCT label AS cls, 0.0::DOUBLE AS b FROM rec WHERE split = 'train')",
        "w0 AS MATERIALIZED (SELECT feature, cls, 0.0::DOUBLE AS w FROM (SELECT DISTINCT feature FROM f WHERE split = 'train') CROSS JOIN b0)",
    ]
    for e in range(epochs + 1):
        parts.append(
            f"z{e} AS MATERIALIZED (SELECT rec.record_id, rec.label, rec.split, b.cls, b.b + coalesce(s.s, 0) AS z FROM rec CROSS JOIN b{e} b LEFT JOIN "
            f"(SELECT f.record_id, w.cls, sum(f.x * w.w) AS s FROM f JOIN w{e} w USING (feature) GROUP BY ALL) s ON s.record_id = rec.record_id AND s.cls = b.cls)"
        )
        if e < epochs:
            parts += [
                f"r{e} AS MATERIALIZED (SELECT record_id, cls, exp(z - m) / sum(exp(z - m)) OVER (PARTITION BY record_id) - CASE WHEN label = cls THEN 1 ELSE 0 END AS r "
                f"FROM (SELECT *, max(z) OVER (PARTITION BY record_id) AS m FROM z{e} WHERE split = 'train'))",
                f"w{e + 1} AS MATERIALIZED (SELECT w.feature, w.cls, w.w - {rate} * (g / n + {decay} * w.w) AS w FROM w{e} w JOIN "
                f"(SELECT f.feature, r.cls, sum(f.x * r.r) AS g FROM f JOIN r{e} r USING (record_id) GROUP BY ALL) g USING (feature, cls) CROSS JOIN cnt)",
                f"b{e + 1} AS MATERIALIZED (SELECT cls, b - {rate} * g / n AS b FROM b{e} JOIN (SELECT cls, sum(r) AS g FROM r{e} GROUP BY cls) USING (cls) CROSS JOIN cnt)",
            ]
    each = " UNION ALL ".join(
        f"SELECT {e - 1} AS epoch, record_id, label AS y_true, cls AS y_pred FROM z{e} WHERE split = 'test' "
        "QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY round(z, 9) DESC, cls) = 1"
        for e in range(1, epochs + 1)
    )
    parts += [f"pred AS MATERIALIZED ({each})", f"hist AS MATERIALIZED ({_metrics('pred', 'epoch')})", "top AS (SELECT epoch FROM hist ORDER BY round(f1, 9) DESC, epoch LIMIT 1)"]
    return "WITH " + ", ".join(parts)


_TEXT_FIT = _softmax(f"{_SPLIT}, {_TF}", "SELECT record_id, split, term AS feature, weight AS x FROM weights", 3, 20.0, 0.0)
_VECTOR_FIT = _softmax(
    _VECTOR_SPLIT, "SELECT record_id, split, generate_subscripts(text, 1) - 1 AS feature, CAST(unnest(text) AS DOUBLE) AS x FROM split", 3, 5.0, 0.01
)
_TRIAL_CTES = (
    _CONFIG_CTES[: _CONFIG_CTES.index("cfg(config_id")]
    + """cfg(config_id, alpha, hi, min_df, max_share, norm) AS (VALUES (0, 0.5::DOUBLE, 1, 1, 1.0::DOUBLE, 'l1'),
    (1, 0.1::DOUBLE, 1, 1000000000, 1.0::DOUBLE, 'l2'), (2, 0.05::DOUBLE, 2, 2, 0.9::DOUBLE, NULL)),
"""
    + _CONFIG_CTES[_CONFIG_CTES.index("ntrain AS") :]
).replace(
    "weights AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY record_id, config_id)) AS weight FROM raw)",
    "weights AS (SELECT raw.*, w / CASE norm WHEN 'l2' THEN sqrt(sum(w * w) OVER (PARTITION BY record_id, raw.config_id)) "
    "WHEN 'l1' THEN sum(abs(w)) OVER (PARTITION BY record_id, raw.config_id) ELSE 1 END AS weight FROM raw JOIN cfg USING (config_id))".replace("raw.*", "raw.record_id, raw.label, raw.split, raw.config_id, raw.alpha, raw.term, raw.w"),
)
_BEST_URL = "(SELECT min(url) FROM articles WHERE url <> '')"
_AT = "retrieved_at + to_microseconds(CAST(seq * 1000000 + 250000 * (seq % 2) AS BIGINT))"

ORACLE |= {
    "indexed_story_search": ORACLE["story_search"],
    "indexed_phrase_search": ORACLE["story_phrase_search"],
    "indexed_count_by_source": ORACLE["story_count_by_source"],
    "url_prefix_layout": ORACLE["url_prefix_search"],
    "url_exact_search": f"{_ARTICLES} SELECT story_id, url FROM articles WHERE url = {_BEST_URL} AND publish_date BETWEEN DATE '2020-01-01' AND DATE '2024-12-31'",
    "keyword_hits": f"{_ARTICLES}, k AS (SELECT DISTINCT k FROM (SELECT unnest({_TOKENS}) AS k FROM benchmark) WHERE length(k) >= 6), "
    "low AS (SELECT story_id, lower(coalesce(title, '')) AS a, lower(coalesce(text, '')) AS b FROM articles) "
    "SELECT story_id, count(*) AS n_keywords, md5(string_agg(k, '|' ORDER BY k)) AS keywords_md5 FROM low JOIN k ON contains(a, k) OR contains(b, k) GROUP BY story_id",
    "observed_counts": f"{_ARTICLES}, idx AS ({_IDX}) SELECT count(*) AS n_articles, CAST(count(*) FILTER (length(trim(coalesce(text, ''), {_WS})) = 0) AS BIGINT) AS n_blank, "
    "CAST(count(*) FILTER (url <> '' AND status = 'success' AND story_id NOT IN (SELECT story_id FROM idx)) AS BIGINT) AS n_new_saved, "
    "CAST(count(*) FILTER (url <> '' AND status <> 'success') AS BIGINT) AS n_failed FROM articles",
    "timestamp_forms": f"{_ARTICLES} SELECT story_id, strftime(t, '%Y-%m-%dT%H:%M:%S') || CASE WHEN seq % 2 = 1 THEN '.250000' ELSE '' END AS iso, "
    f"strftime(t, '%Y%m%d_%H%M%S') AS compact FROM (SELECT story_id, seq, {_AT} AS t FROM articles)",
    "label_decoding": "SELECT doc_id AS record_id, c.label FROM documents LEFT JOIN (SELECT lang AS label, row_number() OVER (ORDER BY lang) - 1 AS class_id "
    "FROM (SELECT DISTINCT lang FROM documents)) c ON c.class_id = doc_id % 5",
    "retrieval_days": f"{_ARTICLES} SELECT CAST(retrieved_at + to_days(CAST(seq % 7 AS INTEGER)) + to_hours(seq % 24) AS DATE) AS retrieved_day, count(*) AS n FROM articles GROUP BY 1",
    "evaluation_summary": f"{_BOARD} SELECT count(*) AS total_models, CAST(count(*) FILTER (error IS NULL) AS BIGINT) AS successful_models, "
    "CAST(count(*) FILTER (error IS NOT NULL) AS BIGINT) AS failed_models, arg_min(model_name, rank) AS best_model FROM board",
    "batch_probabilities": _BATCH.replace("SELECT vec_id, label, cls AS y_pred FROM score\nQUALIFY", "SELECT vec_id, cls AS y_pred, round(exp(s - max(s) OVER p) / sum(exp(s - m)) OVER p, 6) AS probability "
    "FROM (SELECT *, max(s) OVER (PARTITION BY vec_id) AS m FROM score) WINDOW p AS (PARTITION BY vec_id)\nQUALIFY"),
    "linear_recipe": f"{_VECTOR_FIT} SELECT record_id AS vec_id, y_true AS label, y_pred FROM pred WHERE epoch = (SELECT epoch FROM top)",
    "linear_text": f"{_TEXT_FIT} SELECT record_id, y_true AS label, y_pred FROM pred WHERE epoch = (SELECT epoch FROM top)",
    "linear_text_epochs": f"{_TEXT_FIT} SELECT CAST(epoch AS INTEGER) AS epoch, {_ROUND4}, epoch = (SELECT epoch FROM top) AS best FROM hist",
    "sweep_trials": f"WITH {_TRIAL_CTES}, m AS ({_metrics('pred', 'config_id')}) SELECT cfg.config_id AS trial, alpha, hi AS ngram_hi, norm, "
    "coalesce(round(accuracy, 6), 0) AS accuracy, coalesce(round(precision, 6), 0) AS precision, coalesce(round(recall, 6), 0) AS recall, "
    "coalesce(round(f1, 6), 0) AS f1, accuracy IS NULL AS failed FROM cfg LEFT JOIN m USING (config_id)",
}
