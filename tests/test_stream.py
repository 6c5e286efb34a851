from precedent import build_index, resolve, resolve_stream, tf_idf
from precedent.streaming.resolve_stream import METRICS, RESULTS, write_batch
from tests.helpers import tickets
from tests.test_resolve import template

SCHEMA = "query_id string, issue string"


def issues(spark):
    texts = ["Badge is refused at the gate", "Mail stays in the outbox", "no", "Where is the cafeteria",
             "Attachments above ten megabytes", "Jobs vanish before the printer starts"]
    return spark.createDataFrame([(f"Q{i}", t) for i, t in enumerate(texts)], SCHEMA)


def plain(rows):
    return sorted(
        (r.query_id, r.status, r.answer, [e.ticket_id for e in r.evidence], r.attempts)
        for r in rows.collect()
    )


def test_stream_equals_batch_and_counts_rows(spark, tmp_path):
    index = build_index(tickets(spark), str(tmp_path / "index"), tf_idf())
    expected = plain(resolve(index, issues(spark), tf_idf(), template()))
    incoming, out = str(tmp_path / "in"), str(tmp_path / "out")
    issues(spark).repartition(3, "query_id").write.parquet(incoming)

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(incoming)
        resolve_stream(
            index, stream, out, str(tmp_path / "checkpoint"), tf_idf(), template(),
            trigger={"availableNow": True},
        ).awaitTermination()

    run()
    assert plain(spark.read.parquet(f"{out}/{RESULTS}")) == expected
    # A restart has nothing left to do.
    run()
    assert plain(spark.read.parquet(f"{out}/{RESULTS}")) == expected
    counted = spark.read.parquet(f"{out}/{METRICS}").groupBy().sum().head()
    assert counted["sum(n_rows)"] == 6 and counted["sum(n_invalid_input)"] == 1
    assert counted["sum(n_answered)"] + counted["sum(n_abstained)"] == 5

    # The same batch delivered again replaces itself.
    for _ in range(2):
        write_batch(index, issues(spark), 7, str(tmp_path / "again"), tf_idf(), template())
    assert plain(spark.read.parquet(str(tmp_path / "again" / RESULTS))) == expected
    assert spark.read.parquet(str(tmp_path / "again" / METRICS)).count() == 1


def test_repeated_and_missing_ids_are_coded(spark, tmp_path):
    index = build_index(tickets(spark), str(tmp_path / "index"), tf_idf())
    out = str(tmp_path / "out")

    def run(batch_id, rows, **options):
        batch = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        write_batch(index, batch, batch_id, out, tf_idf(), template(), **options)

    gate, mail = "Badge is refused at the gate", "Mail stays in the outbox"
    run(0, [("A", gate), ("A", mail), ("B", mail), (None, gate), (None, gate)])
    run(1, [("A", gate), ("C", mail), ("C", "no")])
    run(2, [("A", gate), ("C", mail)], remember=1)
    for _ in range(2):
        # Delivered again: it still sees only what came before it.
        run(1, [("A", gate), ("C", mail), ("C", "no")])
    found = {
        batch: sorted((str(r.query_id), r.status, str(r.reason_code), r.attempts) for r in spark.read.parquet(f"{out}/{RESULTS}/batch_id={batch}").collect())
        for batch in range(3)
    }
    again = ("invalid_query_id", "repeated_query_id", 0)
    assert found[0] == [
        ("A", "answered", "None", 1), ("A", *again), ("B", "answered", "None", 1),
        *[("None", "invalid_query_id", "missing_query_id", 0)] * 2,
    ]
    assert found[1] == [("A", *again), ("C", "answered", "None", 1), ("C", *again)]
    # Forgotten after one batch.
    assert found[2] == [("A", "answered", "None", 1), ("C", *again)]
    metrics = spark.read.parquet(f"{out}/{METRICS}").groupBy().sum("n_rows", "n_invalid_input").head()
    assert tuple(metrics) == (10, 6)
