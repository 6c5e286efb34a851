"""Labelled cases in, retrieval quality out: one pass for all cases."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precedent.operators.metrics import case_results, mrr_by_category, regression_check, summary
from precedent.operators.rank import evidence_lists
from precedent.operators.validate import require_top_k, require_valid_cases
from precedent.operators.vectorize import Vectorizer
from precedent.plans.retrieve import retrieve
from precedent.schemas import DEFAULT_TOP_K, GATE_SCORE
from precedent.session import materialize
from precedent.sources.index_store import TicketIndex


@dataclass(frozen=True)
class Evaluation:
    """Per-case rows, one row of totals, and one row per supported category."""

    cases: DataFrame
    summary: DataFrame
    by_category: DataFrame

    def check(self, min_mrr: float = 0.0) -> DataFrame:
        return regression_check(self.summary, min_mrr)


def evaluate(
    index: TicketIndex,
    cases: DataFrame,
    vectorizer: Vectorizer,
    top_k: int = DEFAULT_TOP_K,
    min_score: float = GATE_SCORE,
    **retrieval,
) -> Evaluation:
    """Recall@k, MRR overall and by category, and gate outcomes of labelled cases.

    A vector column announced by ``vectorizer`` may ride along in ``cases``.
    """
    require_valid_cases(cases)
    require_top_k(top_k)
    extra = [vectorizer.column] if vectorizer.column else []
    issues = cases.select(F.col("id").alias("query_id"), F.col("query").alias("issue"), *extra)
    found = evidence_lists(retrieve(index, issues, vectorizer, top_k, **retrieval))
    results = materialize(case_results(cases, found, min_score))
    return Evaluation(results, summary(results, top_k), mrr_by_category(results))
