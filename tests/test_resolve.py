import os

import pytest
from pyspark.sql import functions as F

from precedent import build_index, resolve, run_metrics, tf_idf, vector_column
from precedent.errors import InputError, VectorizerMismatch
from precedent.operators.gate import gate_and_select
from precedent.plans.resolve import answer_routed, response_rows
from precedent.schemas import HEADINGS
from tests.helpers import GOOD, answer, evidence, tickets

DENIAL = answer([*GOOD[:3], "No evidence."])


def counting(folder, replies):
    """A generator that notes each call in a file; ``replies`` by issue and turn."""

    def generate(messages):
        name = messages[1]["content"].split("\n")[1].removeprefix("issue ")
        turn = 0 if len(messages) == 2 else 1
        with open(os.path.join(folder, f"{name}-{turn}"), "a") as file:
            file.write("x")
        reply = replies[name][turn]
        if isinstance(reply, Exception):
            raise reply
        return reply

    return generate


def calls(folder):
    return {name: len((folder / name).read_text()) for name in os.listdir(folder)}


def test_routes_repairs_and_faults(spark, tmp_path):
    strong = [("SR901", 0.65), ("SR902", 0.52)]
    replies = {
        "good": [f"  {answer(GOOD)}\n"],
        "fixed": ["invalid", answer(GOOD)],
        "twice": ["invalid", DENIAL],
        "blank": [" \n"],
        "number": [42],
        "down": [RuntimeError("private")],
        "down later": ["invalid", RuntimeError("private")],
        # The runner-up was retrieved, but not sent to the generator.
        "unsent": [answer(["x", "y", "SR902", "z"]), answer(GOOD)],
    }
    lists = {name: strong for name in replies}
    lists |= {"shut": [("SR901", 0.49)], "none": []}
    routed = gate_and_select(evidence(spark, lists))
    rows = answer_routed(routed, counting(str(tmp_path), replies)).collect()
    found = {r.query_id: r for r in rows}
    assert len(rows) == len(lists)
    assert {q: (r.status, r.reason_code, r.attempts) for q, r in found.items()} == {
        "good": ("answered", None, 1),
        "fixed": ("repaired", None, 2),
        "twice": ("invalid_model_response", "contradiction", 2),
        "blank": ("invalid_model_response", "invalid_model_response", 1),
        "number": ("invalid_model_response", "invalid_model_response", 1),
        "down": ("generator_unavailable", "generator_unavailable", 1),
        "down later": ("generator_unavailable", "generator_unavailable", 2),
        "unsent": ("repaired", None, 2),
        "shut": ("abstained", None, 0),
        "none": ("index_unavailable", "index_unavailable", 0),
    }
    assert found["good"].answer == found["fixed"].answer == answer(GOOD)
    assert "None." in found["shut"].answer
    assert found["twice"].answer is None and found["down"].answer is None
    # The whole list is returned although only its best ticket was sent.
    assert [e.ticket_id for e in found["good"].evidence] == ["SR901", "SR902"]
    assert found["good"].sent_ticket_ids == ["SR901"]
    # No call for abstained rows, none beyond one repair, none repeated.
    assert calls(tmp_path) == {
        "good-0": 1, "fixed-0": 1, "fixed-1": 1, "twice-0": 1, "twice-1": 1, "blank-0": 1,
        "number-0": 1, "down-0": 1, "down later-0": 1, "down later-1": 1, "unsent-0": 1,
        "unsent-1": 1,
    }
    assert "private" not in str(rows)


def template():
    """A generator that cites the best ticket. Inner functions reach workers by value."""

    def generate(messages):
        ticket = messages[1]["content"].split("Historical ticket ")[1].split("\n")[0]
        texts = ["A fault.", "A fix.", ticket, "No material gap."]
        return "\n".join(f"{heading}\n{text}" for heading, text in zip(HEADINGS, texts))

    return generate


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    return build_index(tickets(spark), str(tmp_path_factory.mktemp("index") / "i"), tf_idf())


def test_resolve_end_to_end(spark, index):
    issues = spark.createDataFrame(
        [("a", "Badge is refused at the north gate"), ("b", "Where is the cafeteria"), ("c", "no")],
        "query_id string, issue string",
    )
    rows = resolve(index, issues, tf_idf(), template(), top_k=2)
    found = {r.query_id: r for r in rows.collect()}
    assert {q: r.status for q, r in found.items()} == {
        "a": "answered", "b": "abstained", "c": "invalid_issue"
    }
    assert "SR905" in found["a"].answer and len(found["a"].evidence) == 2
    assert found["a"].evidence_sufficient and not found["b"].evidence_sufficient
    assert found["c"].evidence == [] and found["c"].attempts == 0
    totals = {r.status: (r.n_rows, r.n_generator_calls) for r in run_metrics(rows).collect()}
    assert totals == {"answered": (1, 1), "abstained": (1, 0), "invalid_issue": (1, 0)}
    assert response_rows(rows).columns == [
        "query_id", "status", "answer", "evidence_sufficient", "evidence"
    ]


def test_bad_arguments_stop_before_any_generation(spark, index):
    issues = spark.createDataFrame([("a", "an issue")], "query_id string, issue string")
    with pytest.raises(InputError):
        resolve(index, issues, tf_idf(), template(), top_k=0)
    with pytest.raises(InputError):
        resolve(index, issues.union(issues), tf_idf(), template())
    with pytest.raises(InputError):
        resolve(index, issues.withColumn("x", F.lit(1)), tf_idf(), template())
    with pytest.raises(VectorizerMismatch):
        resolve(index, issues.withColumn("vector", F.array(F.lit(1.0))), vector_column(), template())


def test_two_answers_to_one_request_are_refused(spark):
    routed = gate_and_select(evidence(spark, {"a": [("SR901", 0.65)]}))
    answers = spark.createDataFrame(
        [("a", 1, answer(GOOD)), ("a", 1, "another")], "query_id string, attempt int, answer string"
    )
    with pytest.raises(InputError):
        answer_routed(routed, answers)
