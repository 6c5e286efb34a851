"""A table of issues in, a table of grounded answers out."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precedent.functions.grounding import violation
from precedent.functions.prompts import abstain_answer, prompt_messages, repair_messages
from precedent.operators.gate import gate_and_select
from precedent.operators.generate import Generator, generate, look_up_answers
from precedent.operators.rank import evidence_lists
from precedent.operators.validate import issue_status, require_top_k
from precedent.operators.vectorize import Vectorizer
from precedent.plans.retrieve import require_same_vectorizer, retrieve
from precedent.schemas import (
    ABSTAINED,
    ANSWERED,
    CITATION_PATTERN,
    DEFAULT_TOP_K,
    EVIDENCE,
    GATE_SCORE,
    HIGH_CONFIDENCE_MARGIN,
    HIGH_CONFIDENCE_SCORE,
    INDEX_UNAVAILABLE,
    INVALID_MODEL_RESPONSE,
    REPAIRED,
    ROUTE_ABSTAIN,
    ROUTE_GENERATE,
    ROUTE_INDEX_UNAVAILABLE,
)
from precedent.session import materialize
from precedent.sources.index_store import TicketIndex


def _row(status, reason_code, answer, attempts):
    """The shape every route ends in; the full evidence list always stays."""
    return [
        "query_id",
        status.alias("status"),
        reason_code.cast("string").alias("reason_code"),
        answer.cast("string").alias("answer"),
        "evidence_sufficient",
        "evidence",
        F.transform("generation_evidence", lambda item: item["ticket_id"]).alias("sent_ticket_ids"),
        F.lit(attempts).alias("attempts"),
    ]


def generation_requests(routed: DataFrame) -> DataFrame:
    """Queries that pass the gate, with the ``messages`` for the generator."""
    return routed.where(F.col("route") == ROUTE_GENERATE).withColumn(
        "messages", prompt_messages(F.col("issue"), F.col("generation_evidence"))
    )


def with_violation(answered: DataFrame, citation_pattern: str = CITATION_PATTERN) -> DataFrame:
    """Adds the first rule an answer breaks, against the evidence that was sent."""
    sent = F.col("generation_evidence.ticket_id")
    return answered.withColumn("violation", violation(F.col("answer"), sent, citation_pattern))


def repair_requests(answered: DataFrame) -> DataFrame:
    """Queries whose answer was rejected, with the ``messages`` that ask for a repair."""
    rejected = answered.where(F.col("fault").isNull() & F.col("violation.code").isNotNull())
    return rejected.withColumn(
        "messages",
        repair_messages(F.col("messages"), F.col("answer"), F.col("violation.detail")),
    ).drop("answer", "fault", "violation")


def answer_routed(
    routed: DataFrame,
    generator: Generator | DataFrame,
    citation_pattern: str = CITATION_PATTERN,
    generate_tasks: int | None = None,
) -> DataFrame:
    """Final rows for gated queries ``(query_id, issue, evidence, route, ...)``.

    ``generator`` is a function of the messages, or a table ``(query_id, attempt,
    answer)`` with answers to :func:`generation_requests` (attempt 1) and
    :func:`repair_requests` (attempt 2) that were written elsewhere.

    Only queries routed to generation reach Python workers. Each answer is checked
    against the evidence that was sent; a rejected one is repaired once, and a
    second rejection is an error row. Answers are kept reliably after each pass, so
    that no check makes the generator run again.
    """
    null = F.lit(None)

    def answered(rows, attempt):
        if isinstance(generator, DataFrame):
            rows = look_up_answers(rows, generator, attempt)
        else:
            if generate_tasks:
                rows = rows.repartition(generate_tasks, "query_id")
            rows = generate(rows, generator)
        return materialize(with_violation(rows, citation_pattern))

    first = answered(generation_requests(routed), 1)
    second = answered(repair_requests(first), 2)

    faults = first.where(F.col("fault").isNotNull())
    accepted = first.where(F.col("fault").isNull() & F.col("violation.code").isNull())
    repaired = (
        F.when(F.col("fault").isNotNull(), F.col("fault"))
        .when(F.col("violation.code").isNotNull(), F.lit(INVALID_MODEL_RESPONSE))
        .otherwise(F.lit(REPAIRED))
    )
    repaired_answer = F.when(repaired == REPAIRED, F.col("answer"))
    unavailable = routed.where(F.col("route") == ROUTE_INDEX_UNAVAILABLE)
    abstained = routed.where(F.col("route") == ROUTE_ABSTAIN)
    parts = [
        unavailable.select(*_row(F.lit(INDEX_UNAVAILABLE), F.lit(INDEX_UNAVAILABLE), null, 0)),
        abstained.select(*_row(F.lit(ABSTAINED), null, abstain_answer(), 0)),
        accepted.select(*_row(F.lit(ANSWERED), null, F.col("answer"), 1)),
        faults.select(*_row(F.col("fault"), F.col("fault"), null, 1)),
        second.select(
            *_row(repaired, F.coalesce("fault", "violation.code"), repaired_answer, 2)
        ),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def resolve(
    index: TicketIndex,
    issues: DataFrame,
    vectorizer: Vectorizer,
    generator: Generator | DataFrame,
    top_k: int = DEFAULT_TOP_K,
    min_score: float = GATE_SCORE,
    high_score: float = HIGH_CONFIDENCE_SCORE,
    margin: float = HIGH_CONFIDENCE_MARGIN,
    citation_pattern: str = CITATION_PATTERN,
    generate_tasks: int | None = None,
    **retrieval,
) -> DataFrame:
    """``(query_id, status, reason_code, answer, evidence_sufficient, evidence, ...)``.

    One row per issue, invalid ones included. ``generator`` gets a list of
    ``{role, content}`` messages and returns text; it should be deterministic, as a
    lost task is run again. It may also be a table, see :func:`answer_routed`.
    ``retrieval`` goes to :func:`retrieve`.
    """
    require_top_k(top_k)
    require_same_vectorizer(index, vectorizer)
    extra = [vectorizer.column] if vectorizer.column else []
    checked = issue_status(issues, top_k, extra).withColumn(
        "query_id", F.col("query_id").cast("string")
    )
    found = evidence_lists(retrieve(index, issues, vectorizer, top_k, **retrieval))
    valid = checked.where(F.col("status").isNull()).select("query_id", "issue")
    routed = gate_and_select(
        valid.join(found, "query_id", "left"), min_score, high_score, margin
    )
    nothing = F.array().cast(EVIDENCE)
    invalid = (
        checked.where(F.col("status").isNotNull())
        .withColumn("evidence_sufficient", F.lit(False))
        .withColumn("evidence", nothing)
        .withColumn("generation_evidence", nothing)
    )
    answered = answer_routed(materialize(routed), generator, citation_pattern, generate_tasks)
    return answered.unionByName(
        invalid.select(*_row(F.col("status"), F.col("status"), F.lit(None), 0))
    )


def response_rows(resolved: DataFrame) -> DataFrame:
    """What a requester sees: answer, gate flag and the whole evidence list."""
    return resolved.select("query_id", "status", "answer", "evidence_sufficient", "evidence")


def run_metrics(resolved: DataFrame) -> DataFrame:
    """Rows per status; counts only, no text of any issue or answer."""
    return resolved.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("attempts").cast("long").alias("n_generator_calls"),
    )
