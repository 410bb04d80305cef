"""What may be moved: texts of many files, packed records and frequent terms stay where they lie."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslab.operators import features, softmax
from corpuslab.plans import fixtures as fx, queries
from corpuslab.session import materialise
from helpers import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_of_many_files_are_read_as_they_lie(spark, tmp_path):
    docs = spark.range(64).selectExpr("id AS doc_id", "concat('t', id) AS text")
    docs.repartition(16).write.parquet(f"{tmp_path}/many/documents.parquet")
    docs.coalesce(1).write.parquet(f"{tmp_path}/one/documents.parquet")
    many, one = (fx.table(spark, f"{tmp_path}/{name}", "documents") for name in ("many", "one"))
    assert "Exchange" not in plan(many) and "Exchange" in plan(one)
    assert rows(many) == rows(one) == rows(docs)


def test_packed_records_stay_in_their_buckets(spark):
    table = spark.createDataFrame([(k, "ab"[k % 2], [float(k), 1.0]) for k in range(40)], "record_id long, label string, embedding array<double>")
    packed = softmax.pack(softmax.vector_features(table), table)
    residuals = spark.createDataFrame([(k, [0.5, -0.5]) for k in range(40)], "record_id long, r array<double>")
    assert plan(packed.join(residuals.hint("shuffle_hash"), "record_id")).count("Exchange hashpartitioning") == 1
    model = softmax.fit(packed, packed, softmax.SoftmaxParams(epochs=2))
    assert "collect_list" not in plan(model.predict(packed))


def test_norms_are_divided_out_in_the_packed_row(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "record_id long, label string")
    feats = spark.createDataFrame([(1, 7, 3.0), (1, 8, -4.0), (2, 7, 2.0)], "record_id long, feature int, x double")
    for norm, want in (("l2", [0.6, -0.8]), ("l1", [3 / 7, -4 / 7]), (None, [3.0, -4.0])):
        got = {r["record_id"]: sorted((f["feature"], f["x"]) for f in r["features"]) for r in softmax.pack(feats, table, norm=norm).collect()}
        assert [x for _, x in got[1]] == want and got[3] == [] and len(got[2]) == 1


def test_heads_are_bounded_and_joins_whole(spark):
    """Equal terms are all in the head or all out; what a head can't hold meets in the other part."""
    side = materialise(spark.range(100).selectExpr("concat('w', id) AS term", "CASE WHEN id < 3 THEN 50 WHEN id < 10 THEN 7 ELSE 1 END AS df"), "side")
    assert features.head_bound(side, "df", 5) == 50 and features.head_bound(side, "df", 10) == 7
    assert side.where(F.col("df") >= features.head_bound(side, "df", 2)).count() == 0
    tokens = spark.range(300).selectExpr("id", "concat('w', id % 120) AS term")
    want = rows(tokens.join(side, "term"), "id", "term", "df")
    for head_rows in (2, 5, 50, 1000):
        assert rows(features.join_terms(tokens, side, head_rows=head_rows), "id", "term", "df") == want


def test_variants_tokenise_once_a_rule(spark, sf, monkeypatch):
    counted = []
    plain = features.count_table
    monkeypatch.setattr(features, "count_table", lambda *a, **k: counted.append(1) or plain(*a, **k))
    monkeypatch.setattr(features, "term_frequencies", None)
    queries.tfidf_variants(spark, sf)
    assert len(counted) == 4  # two sides, two token rules


def test_moved_documents_come_back_whole(spark):
    """Terms of any kind, also with the separator, empty ones and none; null keys meet."""
    docs = [(1, ["a", "bb"]), (2, ["x\u0001y", "z"]), (3, [""]), (4, []), (None, ["q", ""])]
    table = spark.createDataFrame([(k, [(1, t, 2**20 + i) for i, t in enumerate(ts)]) for k, ts in docs], "record_id long, counts array<struct<n: int, term: string, tf: bigint>>")
    sizes = spark.createDataFrame([(k, 0.5) for k, _ in docs], "record_id long, norm double")
    got = features.join_sizes(table, sizes)
    assert got.schema["counts"].dataType == table.schema["counts"].dataType
    assert rows(got, "record_id", "counts") == rows(table, "record_id", "counts") and got.where("norm = 0.5").count() == 5
