import pytest

from precedent import build_index, evaluate, tf_idf
from precedent.errors import InputError
from precedent.operators.metrics import case_results, mrr_by_category, regression_check, summary
from tests.helpers import evidence, tickets

SCHEMA = "id string, category string, query string, expected_ticket_id string"
CASES = [("one", "auth", "Cannot sign in", "SR001"), ("two", "none", "Change the logo", None)]


def run(spark, lists, cases=CASES):
    results = case_results(
        spark.createDataFrame(cases, SCHEMA), evidence(spark, lists).drop("issue")
    )
    return {r.id: r for r in results.collect()}, summary(results, 3), results


def passed(totals, floor=0.0):
    return regression_check(totals, floor).head().passed


def test_a_right_rank_can_still_be_a_false_abstention(spark):
    rows, totals, _ = run(spark, {"one": [("SR001", 0.49)], "two": [("SR001", 0.2)]})
    assert rows["one"].outcome == "FALSE_ABSTENTION" and rows["two"].outcome == "PASS"
    row = totals.head()
    assert (row.recall, row.mrr, row.supported_false_abstentions) == (1.0, 1.0, 1)
    assert not passed(totals)


def test_second_rank_counts_half_and_the_floor_is_enforced(spark):
    lists = {"one": [("SR002", 0.7), ("SR001", 0.6)], "two": [("SR001", 0.2)]}
    rows, totals, _ = run(spark, lists)
    assert totals.head().mrr == 0.5
    assert passed(totals, 0.5) and not passed(totals, 0.9)
    assert rows["one"].top_result == "SR002" and rows["one"].expected == "SR001"


@pytest.mark.parametrize(
    "lists, outcomes",
    [
        ({"one": [("SR001", 0.7)], "two": [("SR001", 0.6)]}, ("PASS", "REVIEW")),
        ({"one": [("SR002", 0.7)], "two": [("SR001", 0.2)]}, ("MISS", "PASS")),
        ({}, ("FALSE_ABSTENTION", "PASS")),
    ],
)
def test_failing_sets(spark, lists, outcomes):
    lists = lists or {"other": []}
    rows, totals, _ = run(spark, lists)
    assert (rows["one"].outcome, rows["two"].outcome) == outcomes
    assert not passed(totals)


def test_report_rows_without_any_ticket(spark):
    rows, _, _ = run(spark, {"other": []})
    assert (rows["one"].top_result, rows["one"].top_score) == ("none", 0.0)
    assert rows["two"].expected == "abstain"


def test_one_sided_sets_never_pass_and_do_not_divide_by_zero(spark):
    lists = {"one": [("SR001", 0.9)], "two": [("SR001", 0.1)]}
    for case in CASES:
        _, totals, _ = run(spark, lists, [case])
        assert not passed(totals)
    row = run(spark, lists, CASES[1:])[1].head()
    assert (row.supported_count, row.recall, row.mrr) == (0, 0.0, 0.0)


def test_published_figures_follow_from_their_ranks(spark):
    """Eleven supported cases, ten at rank 1 and one of three in its category at rank 2."""
    cases, lists = [], {}
    for i in range(11):
        category = "sync" if i < 3 else f"c{i % 4}"
        cases.append((f"E{i}", category, "a labelled query", "SR001"))
        lists[f"E{i}"] = [("SR002", 0.8), ("SR001", 0.7)] if i == 0 else [("SR001", 0.8)]
    for i in range(2):
        cases.append((f"U{i}", "none", "an unanswerable query", None))
        lists[f"U{i}"] = [("SR001", 0.3)]
    _, totals, results = run(spark, lists, cases)
    row = totals.head()
    assert row.recall == 1.0 and row.mrr == pytest.approx(21 / 22, abs=1e-12)
    assert (row.unsupported_correct, row.unsupported_count) == (2, 2)
    assert passed(totals, 0.9545) and not passed(totals, 0.955)
    by_category = {r.category: r.mrr for r in mrr_by_category(results).collect()}
    assert round(by_category["sync"], 3) == 0.833 and "none" not in by_category


def test_floor_range(spark):
    with pytest.raises(InputError):
        regression_check(spark.range(1), 1.5)


def test_evaluate_from_an_index(spark, tmp_path):
    index = build_index(tickets(spark), str(tmp_path / "index"), tf_idf())
    cases = spark.createDataFrame(
        [
            ("a", "door", "Badge is refused at the north gate", "SR905"),
            ("b", "print", "Pages come out blank", "SR904"),
            ("c", "other", "Where is the cafeteria", None),
        ],
        SCHEMA,
    )
    result = evaluate(index, cases, tf_idf(), 3)
    assert result.check().head().passed
    assert {r.outcome for r in result.cases.collect()} == {"PASS"}
    assert [r.category for r in result.by_category.collect()] == ["door", "print"]
    with pytest.raises(InputError):
        evaluate(index, cases, tf_idf(), 0)
    with pytest.raises(InputError):
        evaluate(index, cases.union(cases), tf_idf())
