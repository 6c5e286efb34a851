"""Cutting to k, fetching ticket fields, and the ordered evidence list."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precedent.operators.skew import BROADCAST_BYTES, salted_join, text_bytes
from precedent.schemas import RANK_DIGITS
from precedent.session import materialize

def top_k_per_query(scored: DataFrame, k, query_col: str = "query_id") -> DataFrame:
    """Rows ``rank <= k`` of each query: best score first, ticket id on ties.

    Catalyst limits every partition to k rows per query before the exchange, so
    a query with many candidates does not fill one task.
    """
    order = Window.partitionBy(query_col).orderBy(
        F.desc(F.round("similarity_score", RANK_DIGITS)), F.asc("ticket_id")
    )
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def with_ticket_fields(
    ranked: DataFrame, tickets: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Ticket texts joined to ``(query_id, rank, ticket_id, similarity_score)``.

    Texts stay out of the similarity join and are fetched only for the winners.
    The winners are kept, measured, and broadcast when small, so that the ticket table
    is not shuffled; otherwise a ticket that wins often is salted.
    """
    fields = tickets.select("ticket_id", "product", "issue", "resolution")
    ranked = materialize(ranked)
    if text_bytes(ranked, "query_id", "ticket_id") <= broadcast_bytes:
        joined = fields.join(F.broadcast(ranked), "ticket_id")
    else:
        joined = salted_join(ranked, fields, "ticket_id", "query_id", "inner")
    return joined.select(
        "query_id", "rank", "ticket_id", "product", "issue", "resolution", "similarity_score"
    )


def evidence_lists(retrieved: DataFrame) -> DataFrame:
    """One row per query with its evidence in rank order (at most k entries)."""
    item = F.struct(
        F.col("rank").cast("int").alias("rank"),
        "ticket_id",
        "product",
        "issue",
        "resolution",
        F.coalesce("similarity_score", F.lit(0.0)).alias("similarity_score"),
    )
    return retrieved.groupBy("query_id").agg(F.sort_array(F.collect_list(item)).alias("evidence"))


def ranked_listing(retrieved: DataFrame) -> DataFrame:
    """The retrieval report: one line per ticket, score to three places."""
    return retrieved.select(
        "query_id",
        "rank",
        "ticket_id",
        "product",
        F.round(F.coalesce("similarity_score", F.lit(0.0)), 3).alias("similarity_score"),
        "issue",
        "resolution",
    )


def scores(evidence: Column) -> tuple[Column, Column]:
    """Score of the best ticket and of the runner-up, 0.0 where there is none."""

    def at(position):
        item = F.get(evidence, F.lit(position))
        return F.coalesce(item["similarity_score"], F.lit(0.0))

    return at(0), at(1)
