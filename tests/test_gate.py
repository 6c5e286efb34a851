import pytest
from pyspark.sql import functions as F

from precedent.functions.prompts import (
    NO_TICKETS_TEXT,
    abstain_answer,
    evidence_text,
    prompt_messages,
    repair_messages,
)
from precedent.operators.gate import gate_and_select
from precedent.operators.rank import (
    evidence_lists,
    ranked_listing,
    top_k_per_query,
    with_ticket_fields,
)
from precedent.schemas import HEADINGS
from tests.helpers import evidence, tickets


def gated(spark, lists):
    rows = gate_and_select(evidence(spark, lists)).collect()
    return {
        r.query_id: (r.route, r.evidence_sufficient, [e.ticket_id for e in r.generation_evidence])
        for r in rows
    }


def test_gate_and_selection_edges(spark):
    both = ["A", "B"]
    expected = {
        "below": ([("A", 0.49), ("B", 0.1)], ("abstain", False, both)),
        "at gate": ([("A", 0.5), ("B", 0.4)], ("generate", True, both)),
        "under gate": ([("A", 0.49999999999)], ("abstain", False, ["A"])),
        "clear": ([("A", 0.60), ("B", 0.54)], ("generate", True, ["A"])),
        "close": ([("A", 0.60), ("B", 0.59)], ("generate", True, both)),
        "strong": ([("A", 0.65), ("B", 0.52)], ("generate", True, ["A"])),
        "alone": ([("A", 0.60)], ("generate", True, ["A"])),
        "weak alone": ([("A", 0.59)], ("generate", True, ["A"])),
        "margin": ([("A", 0.75), ("B", 0.71875)], ("generate", True, ["A"])),
        "tie": ([("A", 0.9), ("B", 0.9)], ("generate", True, both)),
        "empty": ([], ("index_unavailable", False, [])),
    }
    assert gated(spark, {q: lists for q, (lists, _) in expected.items()}) == {
        q: result for q, (_, result) in expected.items()
    }


def test_a_query_without_a_list_counts_as_empty(spark):
    rows = evidence(spark, {"q": [("A", 0.9)]}).withColumn(
        "evidence", F.when(F.col("query_id") != "q", F.col("evidence"))
    )
    row = gate_and_select(rows).head()
    assert row.route == "index_unavailable" and row.evidence == []


def test_rank_ties_are_broken_by_id_and_missing_scores_are_zero(spark):
    scored = spark.createDataFrame(
        [("q", "C", 0.3 + 1e-12), ("q", "B", 0.3), ("q", "A", None), ("q", "D", 0.2)],
        "query_id string, ticket_id string, similarity_score double",
    )
    ranked = top_k_per_query(scored, 4)
    assert [(r.rank, r.ticket_id) for r in ranked.orderBy("rank").collect()] == [
        (1, "B"), (2, "C"), (3, "D"), (4, "A")
    ]
    fields = [F.lit("x").alias(name) for name in ("product", "issue", "resolution")]
    rows = ranked.select("*", *fields)
    assert [e.similarity_score for e in evidence_lists(rows).head().evidence][-1] == 0.0
    assert ranked_listing(rows).where("rank = 1").head().similarity_score == 0.3


def test_ticket_fields_come_by_broadcast_or_by_salted_join(spark):
    ranked = spark.createDataFrame(
        [(f"Q{i}", 1, "SR901" if i % 3 else f"SR90{i % 5 + 1}", 0.5) for i in range(60)],
        "query_id string, rank int, ticket_id string, similarity_score double",
    )
    found = [
        sorted(map(str, with_ticket_fields(ranked, tickets(spark), size).collect()))
        for size in (1 << 20, 0)
    ]
    assert found[0] == found[1] and len(found[0]) == 60
    assert "Mail Relay" in found[0][0]


def test_evidence_and_prompts(spark):
    rows = evidence(spark, {"q": [("SR901", 0.9), ("SR902", 0.8)], "none": []})
    messages = prompt_messages(F.col("issue"), F.col("evidence"))
    found = {
        r.query_id: r
        for r in rows.select(
            "query_id",
            evidence_text(F.col("evidence")).alias("text"),
            messages.alias("messages"),
            repair_messages(messages, F.lit("bad answer"), F.lit("the problem.")).alias("repair"),
            abstain_answer().alias("abstain"),
        ).collect()
    }
    block = "Historical ticket {}\nProduct: product\nIssue: issue\nResolution: resolution"
    assert found["q"].text == block.format("SR901") + "\n\n" + block.format("SR902")
    assert found["none"].text == NO_TICKETS_TEXT
    system, user = found["q"].messages
    assert (system.role, user.role) == ("system", "user")
    assert all(heading in system.content for heading in HEADINGS)
    assert "issue q" in user.content and found["q"].text in user.content
    assert [m.role for m in found["q"].repair] == ["system", "user", "assistant", "user"]
    assert found["q"].repair[2].content == "bad answer"
    assert "the problem." in found["q"].repair[3].content
    assert "None." in found["q"].abstain


@pytest.mark.parametrize("score", [0.49, 0.5])
def test_thresholds_are_parameters(spark, score):
    row = gate_and_select(evidence(spark, {"q": [("A", score)]}), min_score=0.495).head()
    assert row.evidence_sufficient == (score >= 0.495)
