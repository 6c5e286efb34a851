"""Evidence retrieval and grounded answers for tables of issues, on Spark."""

from precedent.operators.vectorize import embed_function, tf_idf, vector_column
from precedent.plans.evaluate import evaluate
from precedent.plans.resolve import resolve, response_rows, run_metrics
from precedent.plans.retrieve import retrieve
from precedent.sources.index_store import build_index, index_status, open_index
from precedent.sources.tickets import read_cases_json, read_tickets_csv
from precedent.streaming.resolve_stream import resolve_stream

__all__ = [
    "build_index",
    "embed_function",
    "evaluate",
    "index_status",
    "open_index",
    "read_cases_json",
    "read_tickets_csv",
    "resolve",
    "resolve_stream",
    "response_rows",
    "retrieve",
    "run_metrics",
    "tf_idf",
    "vector_column",
]
