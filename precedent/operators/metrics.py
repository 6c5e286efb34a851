"""Retrieval quality against labelled cases."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precedent.errors import InputError
from precedent.operators.gate import is_sufficient
from precedent.operators.rank import scores
from precedent.schemas import EVIDENCE, GATE_SCORE

PASS = "PASS"
MISS = "MISS"
REVIEW = "REVIEW"
FALSE_ABSTENTION = "FALSE_ABSTENTION"


def reciprocal_rank(ticket_ids: Column, expected: Column) -> Column:
    """1 / place of the expected ticket, 0.0 where it is absent."""
    place = F.array_position(ticket_ids, expected)
    return F.coalesce(F.try_divide(F.lit(1.0), place.cast("double")), F.lit(0.0))


def case_results(
    cases: DataFrame, evidence: DataFrame, min_score: float = GATE_SCORE
) -> DataFrame:
    """One row per case. ``evidence`` is ``(query_id, evidence)``, joined on the case id.

    A left join: a case without any ticket still counts.
    """
    found = evidence.select(F.col("query_id").alias("id"), "evidence")
    listed = F.coalesce("evidence", F.array().cast(EVIDENCE))
    rows = cases.join(found, "id", "left").withColumn("evidence", listed)
    supported = F.col("expected_ticket_id").isNotNull()
    gate_open = is_sufficient(F.col("evidence"), min_score)
    rr = reciprocal_rank(F.col("evidence.ticket_id"), F.col("expected_ticket_id"))
    outcome = (
        F.when(supported & ~F.col("gate_open"), FALSE_ABSTENTION)
        .when(supported & (F.col("reciprocal_rank") > 0), PASS)
        .when(supported, MISS)
        .when(F.col("gate_open"), REVIEW)
        .otherwise(PASS)
    )
    best, _ = scores(F.col("evidence"))
    return (
        rows.withColumn("gate_open", gate_open)
        .withColumn("reciprocal_rank", F.when(supported, rr))
        .select(
            "id",
            "category",
            outcome.alias("outcome"),
            F.coalesce("expected_ticket_id", F.lit("abstain")).alias("expected"),
            F.coalesce(F.get("evidence", F.lit(0))["ticket_id"], F.lit("none")).alias("top_result"),
            best.alias("top_score"),
            supported.alias("supported"),
            "gate_open",
            "reciprocal_rank",
            "query",
        )
    )


def summary(results: DataFrame, top_k: int) -> DataFrame:
    """One row of totals over all cases; one partial aggregate per partition."""
    supported = F.col("supported")
    n_supported = F.count_if(supported)
    hits = F.count_if(supported & (F.col("reciprocal_rank") > 0))
    return results.agg(
        F.lit(top_k).cast("long").alias("top_k"),
        n_supported.alias("supported_count"),
        F.coalesce(F.try_divide(hits, n_supported), F.lit(0.0)).alias("recall"),
        F.coalesce(F.avg("reciprocal_rank"), F.lit(0.0)).alias("mrr"),
        F.count_if(supported & ~F.col("gate_open")).alias("supported_false_abstentions"),
        F.count_if(~supported).alias("unsupported_count"),
        F.count_if(~supported & ~F.col("gate_open")).alias("unsupported_correct"),
    )


def mrr_by_category(results: DataFrame) -> DataFrame:
    """Mean reciprocal rank of the supported cases of each category."""
    return (
        results.where("supported")
        .groupBy("category")
        .agg(F.avg("reciprocal_rank").alias("mrr"), F.count(F.lit(1)).alias("n_cases"))
        .orderBy("category")
    )


def regression_check(totals: DataFrame, min_mrr: float = 0.0) -> DataFrame:
    """Adds ``passed``: coverage, full recall, the MRR floor and correct gating.

    The floor is compared with the unrounded mean.
    """
    if not 0 <= min_mrr <= 1:
        raise InputError("min_mrr", "min_mrr must be between 0 and 1.")
    passed = (
        (F.col("supported_count") > 0)
        & (F.col("unsupported_count") > 0)
        & (F.col("recall") == 1.0)
        & (F.col("mrr") >= F.lit(float(min_mrr)))
        & (F.col("supported_false_abstentions") == 0)
        & (F.col("unsupported_correct") == F.col("unsupported_count"))
    )
    return totals.withColumn("passed", passed)
