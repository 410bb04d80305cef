from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import agreement as ag
from corpuslab.operators import annotations as an
from corpuslab.sources.annotations import read_annotated_tasks, write_agreement_report
from helpers import close, one, rows


def result(value, kind="choices", control="c"):
    return {"type": kind, "from_name": control, "value": value}


def annotation(results, **extra):
    return {"id": "x", "completed_by": "p1", "created_at": "now", "result": results, **extra}


def tasks_of(spark, tmp_path, tasks):
    path = tmp_path / "tasks.json"
    path.write_text("\n".join(json.dumps(t) for t in tasks))
    return read_annotated_tasks(spark, str(path))


def task(i, annotations, text="some text"):
    return {"id": i, "data": {"text": text, "story_id": f"s{i}"}, "annotations": annotations}


@pytest.mark.parametrize(
    "value, kind, want",
    [
        ({"choices": ["A", "B"]}, "choices", ["A", "B"]),
        ({"text": "A"}, "textarea", ["A"]),
        ({"text": ["A", "B"]}, "textarea", ["A", "B"]),
        (["A", "B"], "choices", ["A", "B"]),
        ("A", "textarea", ["A"]),
        ({"choices": [["A", "B"], ["C"]]}, "choices", ["A", "B", "C"]),
        ({"choices": []}, "choices", None),
        ({"rating": 3}, "choices", None),
        ({"choices": ["A"]}, "rating", None),
        (None, "choices", None),
    ],
)
def test_every_value_shape(spark, tmp_path, value, kind, want):
    df = an.labelled_records(tasks_of(spark, tmp_path, [task(1, [annotation([result(value, kind)])])]), multi=True)
    got = [r["labels"] for r in df.collect()]
    assert got == ([] if want is None else [want])


def test_skips_cancelled_blank_and_unannotated(spark, tmp_path):
    good = [result({"choices": ["A"]})]
    tasks = [
        task(1, [annotation(good), annotation(good, was_cancelled=True), annotation([])]),
        task(2, [annotation(good)], text=" \n"),
        task(3, []),
        {"id": 4, "data": {"text": "t"}},
    ]
    df = tasks_of(spark, tmp_path, tasks)
    assert rows(an.labelled_records(df), "task_id", "label") == [(1, "A")]
    assert tuple(one(an.skipped_tasks(df))) == (4, 3)


def test_target_label_and_single_versus_multi(spark, tmp_path):
    df = tasks_of(spark, tmp_path, [task(1, [annotation([result({"choices": ["Sport", "climate news", "Climate"]})])])])
    single = one(an.labelled_records(df, target_label="CLIMATE"))
    assert (single["label"], single["labels"]) == ("climate news", ["climate news"])
    multi = one(an.labelled_records(df, target_label="CLIMATE", multi=True))
    assert multi["labels"] == ["climate news", "Climate"]
    assert rows(an.label_distribution(an.labelled_records(df, multi=True))) == [
        ("Climate", 1), ("Sport", 1), ("climate news", 1),
    ]


def test_analysis_view_orders_distinct_labels_per_control(spark, tmp_path):
    ann = annotation(
        [
            result({"choices": ["B", "A", "B"]}, control="x"),
            result({"choices": ["Z"]}, control=""),
            result({"choices": ["A", "C"]}, control="x"),
            result({"choices": "not a list"}, control="x"),
            result({"text": "t"}, kind="textarea", control="x"),
        ],
        lead_time=None,
    )
    other = annotation([result({"choices": ["A"]})], completed_by=None, created_by="maker", lead_time=2.5)
    stopped = annotation([result({"choices": ["A"]})], skipped=True)
    df = an.analysis_records(tasks_of(spark, tmp_path, [task(1, [ann, other, stopped])]))
    assert rows(df, "ann_pos", "annotator", "control", "label_pos", "label", "lead_time") == [
        (0, "p1", "label", 0, "Z", 0.0),
        (0, "p1", "x", 0, "B", 0.0),
        (0, "p1", "x", 1, "A", 0.0),
        (0, "p1", "x", 2, "C", 0.0),
        (1, "maker", "c", 0, "A", 2.5),
    ]


LONG = "task_id long, ann_pos int, annotator string, control string, label_pos int, label string, lead_time double"


def long_of(spark, data):
    return spark.createDataFrame(data, LONG)


# Worked example of Krippendorff (2011): four observers, twelve units, gaps.
KRIPPENDORFF = [
    [1, 2, 3, 3, 2, 1, 4, 1, 2, None, None, None],
    [1, 2, 3, 3, 2, 2, 4, 1, 2, 5, None, 3],
    [None, 3, 3, 3, 2, 3, 4, 2, 2, 5, 1, None],
    [1, 2, 3, 3, 2, 4, 4, 1, 2, 5, 1, None],
]


def rated(spark, matrix):
    data = [
        ("c", u, f"r{o}", 0, str(v))
        for o, line in enumerate(matrix)
        for u, v in enumerate(line)
        if v is not None
    ]
    return spark.createDataFrame(data, "control string, subject int, rater string, ann_pos int, label string")


def test_published_example(spark):
    # Unit 12 has one rating; rating it twice by the same observer keeps it as a subject of AC1.
    twice = spark.createDataFrame(
        [("c", 11, "r1", -1, "1")], "control string, subject int, rater string, ann_pos int, label string"
    )
    got = one(ag.chance_corrected(rated(spark, KRIPPENDORFF).unionByName(twice)))
    assert round(got["krippendorff_alpha"], 4) == 0.7434
    assert round(got["gwet_ac1"], 4) == 0.7754


def brute_ac1(matrix):
    units = [[line[u] for line in matrix if line[u] is not None] for u in range(len(matrix[0]))]
    units = [u for u in units if len(u) >= 2]
    labels = {v for u in units for v in u}
    pa = sum(sum(u.count(k) * (u.count(k) - 1) for k in labels) / (len(u) * (len(u) - 1)) for u in units) / len(units)
    pi = {k: sum(u.count(k) / len(u) for u in units) / len(units) for k in labels}
    pe = sum(p * (1 - p) for p in pi.values()) / (len(labels) - 1)
    return (pa - pe) / (1 - pe)


def test_ac1_against_its_definition(spark):
    got = one(ag.chance_corrected(rated(spark, KRIPPENDORFF)))
    assert close(got["gwet_ac1"], brute_ac1(KRIPPENDORFF))


def test_perfect_agreement_and_single_label(spark):
    perfect = rated(spark, [[1, 2, 1], [1, 2, 1]])
    got = one(ag.chance_corrected(perfect))
    assert close(got["krippendorff_alpha"], 1.0) and close(got["gwet_ac1"], 1.0)
    assert close(one(ag.cohen_kappa(perfect))["cohen_kappa"], 1.0)
    flat = rated(spark, [[1, 1], [1, 1]])
    got = one(ag.chance_corrected(flat))
    assert got["krippendorff_alpha"] is None and got["gwet_ac1"] is None
    assert one(ag.cohen_kappa(flat))["cohen_kappa"] is None


def test_kappa_needs_exactly_two_raters(spark):
    a = [1, 1, 2, 2, 1, 2, 1, 1, 2, 2]
    b = [1, 2, 2, 2, 1, 1, 1, 1, 2, 1]
    po = sum(x == y for x, y in zip(a, b)) / 10
    pe = sum((a.count(k) / 10) * (b.count(k) / 10) for k in (1, 2))
    assert close(one(ag.cohen_kappa(rated(spark, [a, b])))["cohen_kappa"], (po - pe) / (1 - pe))
    assert one(ag.cohen_kappa(rated(spark, [a, b, a])))["cohen_kappa"] is None


def test_one_person_rating_twice_counts_for_ac1_shares_only(spark):
    data = [
        ("c", 1, "r1", 0, "A"), ("c", 1, "r2", 1, "A"),
        ("c", 2, "r1", 0, "B"), ("c", 2, "r2", 1, "A"),
        ("c", 3, "r1", 0, "A"), ("c", 3, "r1", 1, "B"),  # last one wins, one rater left
        ("c", 4, "r2", 0, "B"),  # a single annotation is no subject
    ]
    df = spark.createDataFrame(data, "control string, subject int, rater string, ann_pos int, label string")
    got = one(ag.chance_corrected(df))
    # alpha: subjects 1 and 2; n=4, A=3, B=1, one disagreeing subject.
    assert close(got["krippendorff_alpha"], 1 - 3 * 2 / 6)
    pa, pi_a = 0.5, (1 + 0.5 + 0) / 3
    pe = 2 * pi_a * (1 - pi_a)
    assert close(got["gwet_ac1"], (pa - pe) / (1 - pe))


def test_simple_agreement_rules(spark):
    long = long_of(
        spark,
        [
            (1, 0, "p", "q", 0, "B", 1.0), (1, 1, "r", "q", 0, "A", 0.0), (1, 2, "s", "q", 0, "A", 3.0),
            (2, 0, "p", "q", 0, "B", 2.0), (2, 1, "r", "q", 0, "A", 2.0),  # tie: first seen wins
            (3, 0, "p", "q", 0, "A", 1.0), (3, 1, "r", "t", 0, "X", 1.0),  # one valid label each
            (4, 0, "p", "q", 0, "A", 1.0),  # a single annotation is no agreement
        ],
    )
    simple = ag.simple_agreement(long)
    got = {
        (r["task_id"], r["control"]): (r["num_annotators"], r["agreement_ratio"], r["all_agree"], r["most_common_label"])
        for r in simple.collect()
    }
    assert got[(1, "q")] == (3, pytest.approx(2 / 3), False, "A")
    assert got[(2, "q")] == (2, 0.5, False, "B")
    assert got[(3, "q")] == (1, 1.0, True, "A")
    assert got[(1, "t")] == (3, None, False, None)
    assert (4, "q") not in got
    per_task = {r["task_id"]: tuple(r)[1:] for r in ag.task_agreement(simple).collect()}
    # Unused control t makes tasks 1 and 2 disagree anyway; task 3 has one label per control.
    assert per_task == {1: (3, 0.667, True), 2: (2, 0.5, True), 3: (2, 1.0, False)}
    strict = {r["task_id"]: r["has_disagreement"] for r in ag.task_agreement(simple, strict=True).collect()}
    assert strict == {1: True, 2: True, 3: False}
    assert one(ag.agreement_summary(ag.task_agreement(simple)))["n_disagreement"] == 2


def test_summaries(spark):
    long = long_of(
        spark,
        [
            (1, 0, "p", "q", 0, "A", 1.0), (1, 0, "p", "t", 0, "X", 1.0), (1, 1, "p", "q", 0, "A", 2.0),
            (2, 0, "r", "q", 0, "B", 0.0), (3, 0, "s", "q", 0, "A", 4.0),
        ],
    )
    assert tuple(one(ag.project_summary(long))) == (3, 4, 1, 3, 1.33)
    assert one(ag.tasks_with_several_raters(long))["n_tasks"] == 0
    counts = ag.annotator_counts(long)
    assert tuple(one(ag.annotator_extremes(counts))) == ("p", 2, "s", 1)
    stats = one(ag.lead_time_stats(long))
    assert (stats["average_lead_time"], stats["median_lead_time"]) == (pytest.approx(7 / 3), 2.0)
    assert rows(ag.label_schema(long)) == [("q", ["A", "B"]), ("t", ["X"])]
    assert [r["label"] for r in ag.label_shares(long).collect()] == ["A", "B", "X"]
    levels = ag.label_grouping_sets(long)
    assert levels.where("control is null and annotator is null").count() == 3
    assert rows(an.require_labels(long, ["B"]), "task_id") == [(2,)]


def test_report_is_written_flat(spark, out):
    long = long_of(spark, [(1, 0, "p", "q", 0, "A", 1.0), (1, 1, "r", "q", 0, "B", 0.0)])
    simple = ag.simple_agreement(long)
    report = ag.agreement_report(simple, ag.task_agreement(simple))
    write_agreement_report(report, out)
    back = one(spark.read.option("header", True).option("escape", '"').csv(out))
    assert back["control"] == "q" and back["control_agreement_ratio"] == "0.5"
    assert json.loads(back["control_label_distribution"]) == [{"label": "A", "n": 1}, {"label": "B", "n": 1}]


def test_rater_ids_of_other_types(spark):
    df = rated(spark, [[1, 2, 1], [1, 2, 2]]).withColumn("rater", F.regexp_replace("rater", "r", "").cast("int"))
    assert one(ag.cohen_kappa(df))["cohen_kappa"] is not None
