import pytest
from pyspark.sql import functions as F

from precedent.errors import InputError
from precedent.operators.validate import (
    case_violations,
    issue_status,
    require_top_k,
    require_unique_queries,
    require_valid_cases,
    require_valid_tickets,
    ticket_violations,
)
from precedent.schemas import TICKET_FIELDS
from tests.helpers import TICKETS, tickets

CASE_SCHEMA = "id string, category string, query string, expected_ticket_id string"
CASES = [("a", "mail", "Mail is not sent", "SR901"), ("b", "other", "Change the logo", None)]


def fault(check, *args):
    with pytest.raises(InputError) as caught:
        check(*args)
    return caught.value


def test_good_tickets_pass(spark):
    require_valid_tickets(tickets(spark))
    assert {r.n_bad for r in ticket_violations(tickets(spark)).collect()} == {0}


@pytest.mark.parametrize("field", TICKET_FIELDS)
@pytest.mark.parametrize("value", ["", "   ", "\x1c ", None])
def test_blank_values_are_refused(spark, field, value):
    row = dict(zip(TICKET_FIELDS, TICKETS[0])) | {field: value}
    error = fault(require_valid_tickets, tickets(spark, [tuple(row[f] for f in TICKET_FIELDS)]))
    assert error.rule == "blank_field" and field in str(error)


@pytest.mark.parametrize("field", TICKET_FIELDS)
def test_numbers_are_refused(spark, field):
    rows = tickets(spark).withColumn(field, F.lit(123))
    assert fault(require_valid_tickets, rows).rule == "blank_field"


@pytest.mark.parametrize("bad_id", ["bad", "SR1", "SR9011", "sr901", "SR901\n", "SR١٢٣", " SR901"])
def test_malformed_ids_are_refused(spark, bad_id):
    rows = tickets(spark, [(bad_id, *TICKETS[0][1:])])
    assert fault(require_valid_tickets, rows).rule == "id_format"


def test_table_faults(spark):
    assert fault(require_valid_tickets, tickets(spark, [])).rule == "empty_table"
    assert fault(require_valid_tickets, tickets(spark, TICKETS[:1] * 2)).rule == "id_repeated"
    error = fault(require_valid_tickets, tickets(spark).drop("issue", "product"))
    assert error.rule == "missing_columns" and "issue, product" in str(error)


def test_first_rule_wins_and_no_row_text_is_shown(spark):
    rows = tickets(spark, [("private", "p", " ", "r"), ("private", "p", "i", "r")])
    error = fault(require_valid_tickets, rows)
    assert error.rule == "blank_field" and "private" not in str(error)


def test_issue_boundaries(spark):
    texts = ["  hello  ", "abcd", "x" * 2000, " " + "x" * 2000 + "\n", "x" * 2001, "", "  ab  ", None,
             "\U0001f600" * 5]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "query_id string, issue string")
    found = {r.query_id: r for r in issue_status(rows, 3).collect()}
    assert [found[str(i)].status for i in range(len(texts))] == [
        None, "invalid_issue", None, None, "invalid_issue", "invalid_issue", "invalid_issue",
        "invalid_issue", None,
    ]
    assert found["0"].issue == "hello" and found["0"].top_k == 3


def test_row_top_k(spark):
    rows = spark.createDataFrame(
        [("a", "issue", 0), ("b", "issue", 1), ("c", "issue", 5), ("d", "issue", 6),
         ("e", "issue", None), ("f", "bad", 9), ("g", "issue", 2**40)],
        "query_id string, issue string, top_k long",
    )
    found = {r.query_id: r.status for r in issue_status(rows, 3).collect()}
    assert found == {"a": "invalid_top_k", "b": None, "c": None, "d": "invalid_top_k",
                     "e": "invalid_top_k", "f": "invalid_issue", "g": "invalid_top_k"}


@pytest.mark.parametrize("value", [0, 6, True, 1.0, "3", None])
def test_scalar_top_k(value):
    fault(require_top_k, value)
    assert require_top_k(1) == 1 and require_top_k(5) == 5


def test_issue_columns_are_strict_and_names_stay_private(spark):
    rows = spark.createDataFrame([("a", "an issue", "x")], "query_id string, issue string, secret string")
    error = fault(issue_status, rows, 3)
    assert error.rule == "unknown_columns" and "secret" not in str(error)
    for kind in ("boolean", "string", "double"):
        typed = rows.select("query_id", "issue", F.lit(None).cast(kind).alias("top_k"))
        assert fault(issue_status, typed, 3).rule == "top_k"


def test_query_ids_are_unique(spark):
    for ids in (["a", "a"], ["a", None]):
        rows = spark.createDataFrame([(i,) for i in ids], "query_id string")
        assert fault(require_unique_queries, rows).rule == "query_id"


@pytest.mark.parametrize(
    "rows, rule",
    [
        ([], "empty_table"),
        (CASES[:1] * 2, "id_repeated"),
        ([("", *CASES[0][1:])], "blank_field"),
        ([("a", None, *CASES[0][2:])], "blank_field"),
        ([("a", "mail", "", "SR901")], "query_length"),
        ([("a", "mail", None, "SR901")], "query_length"),
        ([("a", "mail", "Mail is not sent", " ")], "blank_expected"),
    ],
)
def test_bad_cases_are_refused(spark, rows, rule):
    assert fault(require_valid_cases, spark.createDataFrame(rows, CASE_SCHEMA)).rule == rule


def test_good_cases_pass(spark):
    cases = spark.createDataFrame(CASES, CASE_SCHEMA)
    require_valid_cases(cases)
    assert case_violations(cases).count() == 6
    assert fault(require_valid_cases, cases.drop("query")).rule == "missing_columns"
