"""Answers from the caller's text generator, or from a table written elsewhere."""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precedent.errors import InputError
from precedent.functions.text import WHITESPACE, is_blank, strip
from precedent.schemas import GENERATOR_UNAVAILABLE, INVALID_MODEL_RESPONSE
from precedent.session import ship_package

Generator = Callable[[list[dict[str, str]]], str]


def generate(rows: DataFrame, generator: Generator) -> DataFrame:
    """Adds ``answer`` and ``fault`` to rows that carry ``messages``.

    Only ``messages`` is turned into Python objects; every other column passes
    through as Arrow. A generator that raises, or returns anything but text with
    content, leaves a coded fault in its row and the run goes on; the text of the
    error is not kept. The caller materialises the result, since a lazy plan may
    run this more than once.
    """
    ship_package(rows.sparkSession)
    schema = T.StructType(
        [
            *rows.schema.fields,
            T.StructField("answer", T.StringType()),
            T.StructField("fault", T.StringType()),
        ]
    )

    def ask(messages):
        try:
            answer = generator(messages)
        except Exception:
            return None, GENERATOR_UNAVAILABLE
        if not isinstance(answer, str) or not answer.strip(WHITESPACE):
            return None, INVALID_MODEL_RESPONSE
        return answer.strip(WHITESPACE), None

    def run(batches):
        for batch in batches:
            pairs = [ask(messages) for messages in batch.column("messages").to_pylist()]
            yield batch.append_column(
                "answer", pa.array([answer for answer, _ in pairs], pa.string())
            ).append_column("fault", pa.array([fault for _, fault in pairs], pa.string()))

    return rows.mapInArrow(run, schema)


def require_unique_answers(answers: DataFrame) -> None:
    """Refuses a table with more than one row for a query and attempt."""
    keys = answers.select(F.col("query_id").cast("string").alias("query_id"), "attempt")
    if not keys.groupBy("query_id", "attempt").count().where("count > 1").isEmpty():
        raise InputError("answer_repeated", "There must be one answer per query_id and attempt.")


def look_up_answers(rows: DataFrame, answers: DataFrame, attempt: int) -> DataFrame:
    """Adds ``answer`` and ``fault`` from ``answers (query_id, attempt, answer)``.

    The same faults as for a generator: no row means it was not available, a blank
    answer is an invalid one. Two answers to one request are refused.
    """
    require_unique_answers(answers)
    found = answers.where(F.col("attempt") == attempt).select(
        F.col("query_id").cast("string").alias("query_id"),
        F.col("answer").alias("given"),
        F.lit(True).alias("present"),
    )
    fault = F.when(F.col("present").isNull(), F.lit(GENERATOR_UNAVAILABLE)).when(
        is_blank(F.col("given")), F.lit(INVALID_MODEL_RESPONSE)
    )
    return (
        rows.join(found, "query_id", "left")
        .withColumn("answer", F.when(fault.isNull(), strip(F.col("given"))))
        .withColumn("fault", fault)
        .drop("given", "present")
    )
