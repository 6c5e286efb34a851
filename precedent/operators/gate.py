"""Is the evidence good enough, and which part of it reaches the generator."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precedent.operators.rank import scores
from precedent.schemas import (
    GATE_SCORE,
    HIGH_CONFIDENCE_MARGIN,
    HIGH_CONFIDENCE_SCORE,
    ROUTE_ABSTAIN,
    ROUTE_GENERATE,
    ROUTE_INDEX_UNAVAILABLE,
)


def is_sufficient(evidence: Column, min_score: float = GATE_SCORE) -> Column:
    """The list is not empty and its best score reaches the gate."""
    best, _ = scores(evidence)
    return (F.size(evidence) > 0) & (best >= F.lit(min_score))


def selected(
    evidence: Column,
    high_score: float = HIGH_CONFIDENCE_SCORE,
    margin: float = HIGH_CONFIDENCE_MARGIN,
) -> Column:
    """Only the best ticket when it is strong and clear of the next, else all."""
    best, runner_up = scores(evidence)
    alone = (best >= F.lit(high_score)) & (best - runner_up >= F.lit(margin))
    return F.when(alone, F.slice(evidence, 1, 1)).otherwise(evidence)


def route(evidence: Column, min_score: float = GATE_SCORE) -> Column:
    """What happens to the query next."""
    return (
        F.when(F.size(evidence) == 0, F.lit(ROUTE_INDEX_UNAVAILABLE))
        .when(~is_sufficient(evidence, min_score), F.lit(ROUTE_ABSTAIN))
        .otherwise(F.lit(ROUTE_GENERATE))
    )


def gate_and_select(
    queries: DataFrame,
    min_score: float = GATE_SCORE,
    high_score: float = HIGH_CONFIDENCE_SCORE,
    margin: float = HIGH_CONFIDENCE_MARGIN,
) -> DataFrame:
    """Adds ``evidence_sufficient``, ``route`` and ``generation_evidence``.

    ``evidence`` stays whole; only ``generation_evidence`` is cut. Narrow.
    """
    evidence = F.coalesce("evidence", F.array().cast(queries.schema["evidence"].dataType))
    return (
        queries.withColumn("evidence", evidence)
        .withColumn("evidence_sufficient", is_sufficient(F.col("evidence"), min_score))
        .withColumn("route", route(F.col("evidence"), min_score))
        .withColumn("generation_evidence", selected(F.col("evidence"), high_score, margin))
    )
