"""Issues arriving over time, each batch against the index that is current then.

An id is answered once: a row whose ``query_id`` came before, in its batch or in one of the ``remember``
batches before it, becomes a coded row instead of a second answer, and so does a row without id. The stored results
are the memory for that, so it survives a restart with them, and a batch that is delivered again sees what it saw at first.
"""

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from precedent.operators.generate import Generator
from precedent.operators.vectorize import Vectorizer
from precedent.plans.resolve import resolve
from precedent.sources.index_store import TicketIndex, open_index

RESULTS = "results"
METRICS = "metrics"
INVALID_QUERY_ID = "invalid_query_id"
REMEMBER_BATCHES = 1000


def earlier_ids(spark, out_path: str, batch_id: int, remember: int) -> DataFrame | None:
    """Ids of the batches before this one; only as many folders are read."""
    try:
        results = spark.read.parquet(f"{out_path}/{RESULTS}")
    except PySparkException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    before = (F.col("batch_id") < batch_id) & (F.col("batch_id") >= batch_id - remember)
    # Coded rows of ids that were there before need not be remembered again.
    return results.where(before & (F.col("status") != INVALID_QUERY_ID)).select("query_id").distinct()


def mark_repeats(issues: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """``issues`` with ``_fault``: null for the first row of an id that did not come before, else a reason."""
    numbered = issues.withColumn("_at", F.monotonically_increasing_id()).withColumn("_id", F.col("query_id").cast("string"))
    # One row per id, whatever the number of its rows.
    first = numbered.where("_id is not null").groupBy("_id").agg(F.min("_at").alias("_first"))
    if earlier is not None:
        known = earlier.select(F.col("query_id").alias("_id"), F.lit(True).alias("_known"))
        first = first.join(known, "_id", "left")
    else:
        first = first.withColumn("_known", F.lit(False))
    again = F.coalesce("_known", F.lit(False)) | (F.col("_at") != F.col("_first"))
    fault = F.when(F.col("_id").isNull(), F.lit("missing_query_id")).when(again, F.lit("repeated_query_id"))
    return numbered.join(first, "_id", "left").withColumn("_fault", fault).drop("_at", "_id", "_first", "_known")


def coded_rows(repeats: DataFrame, like: DataFrame) -> DataFrame:
    """Rows of the result's form for issues that are not looked at."""
    values = {
        "query_id": F.col("query_id"),
        "status": F.lit(INVALID_QUERY_ID),
        "reason_code": F.col("_fault"),
        "evidence_sufficient": F.lit(False),
        "attempts": F.lit(0),
    }

    def value(field):
        if field.name in values:
            return values[field.name]
        return F.array() if field.dataType.typeName() == "array" else F.lit(None)

    return repeats.select(*(value(f).cast(f.dataType).alias(f.name) for f in like.schema.fields))


def write_batch(
    index: TicketIndex,
    issues: DataFrame,
    batch_id: int,
    out_path: str,
    vectorizer: Vectorizer,
    generator: Generator,
    remember: int = REMEMBER_BATCHES,
    **options,
) -> None:
    """Resolve one batch and store it under its id.

    A batch that is delivered again replaces its own folder, so nothing is written
    twice. The metrics row is counted while the results are written and holds
    numbers only.
    """
    seen = Observation(f"resolve-{batch_id}")
    status = F.col("status")
    spark = issues.sparkSession
    marked = mark_repeats(issues, earlier_ids(spark, out_path, batch_id, remember)).persist()
    answered = resolve(index, marked.where("_fault is null").drop("_fault"), vectorizer, generator, **options)
    resolved = answered.unionByName(coded_rows(marked.where("_fault is not null"), answered)).observe(
        seen,
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(status == "answered").alias("n_answered"),
        F.count_if(status == "repaired").alias("n_repaired"),
        F.count_if(status == "abstained").alias("n_abstained"),
        F.count_if(status.startswith("invalid_") & (status != "invalid_model_response")).alias(
            "n_invalid_input"
        ),
        F.count_if(
            status.isin("invalid_model_response", "generator_unavailable", "index_unavailable")
        ).alias("n_failed"),
        F.coalesce(F.sum("attempts"), F.lit(0)).alias("n_generator_calls"),
    )
    try:
        resolved.write.mode("overwrite").parquet(f"{out_path}/{RESULTS}/batch_id={batch_id}")
    finally:
        marked.unpersist()
    counted = seen.get
    names = sorted(counted)
    row = spark.createDataFrame(
        [tuple(int(counted[name]) for name in names)], ", ".join(f"{name} long" for name in names)
    )
    row.coalesce(1).write.mode("overwrite").parquet(f"{out_path}/{METRICS}/batch_id={batch_id}")


def resolve_stream(
    index: TicketIndex,
    issues: DataFrame,
    out_path: str,
    checkpoint_path: str,
    vectorizer: Vectorizer,
    generator: Generator,
    trigger: dict | None = None,
    remember: int = REMEMBER_BATCHES,
    **options,
) -> StreamingQuery:
    """Start a streaming query that resolves every micro-batch of ``issues``.

    Ranking needs whole micro-batches and no state across them but the ids already answered, so there
    is no watermark. ``trigger`` holds the keyword arguments of ``DataStreamWriter.trigger``.
    """

    checked = {index.folder}

    def resolve_batch(batch: DataFrame, batch_id: int) -> None:
        # The batch is read several times below; each read would re-read the source.
        held = batch.persist()
        try:
            # A rebuilt index is used from the next batch on.
            current = open_index(batch.sparkSession, index.path, verify=False)
            if current.folder not in checked:
                current = open_index(batch.sparkSession, index.path)
                checked.add(current.folder)
            write_batch(current, held, batch_id, out_path, vectorizer, generator, remember, **options)
        finally:
            held.unpersist()

    writer = issues.writeStream.option("checkpointLocation", checkpoint_path)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.foreachBatch(resolve_batch).start()
