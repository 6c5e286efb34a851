import os

import pytest
from pyspark.sql import functions as F

from precedent import build_index, index_status, open_index, retrieve, tf_idf, vector_column
from precedent.errors import (
    InputError,
    IndexUnavailable,
    RetrievalUnavailable,
    VectorizerMismatch,
)
from precedent.operators.vectorize import embed_function
from precedent.sources import index_store
from precedent.sources.index_store import remove_old_versions
from tests.helpers import TICKETS, tickets


def broken():
    """A vectorizer whose model cannot be loaded."""

    def load():
        raise OSError("model unavailable")

    return embed_function(load, "m")


def lengths():
    """A vectorizer by simple counts. Inner functions reach workers by value."""

    def load():
        return lambda texts: [[1.0, float(len(t)), float(t.count("e"))] for t in texts]

    return embed_function(load, "lengths")


def issues(spark, *texts):
    return spark.createDataFrame(
        [(f"Q{i}", text) for i, text in enumerate(texts)], "query_id string, issue string"
    )


def status(spark, path):
    row = index_status(spark, path).head()
    return row.status, row.reason, row.n_tickets


def test_build_open_and_search(spark, tmp_path):
    path = str(tmp_path / "index")
    build_index(tickets(spark), path, tf_idf())
    index = open_index(spark, path)
    assert (index.version, index.n_tickets) == (1, 5)
    stored = {r.ticket_id: r for r in index.table("tickets").collect()}
    assert stored["SR905"].retrieval_text == (
        "Product: Door Access\nIssue: Badge is refused at the north gate"
    )
    assert stored["SR905"].resolution == "Enrol the badge again."
    found = retrieve(index, issues(spark, "The badge was refused", "Printer jobs vanish"), tf_idf(), 2)
    best = {r.query_id: (r.ticket_id, r.product) for r in found.where("rank = 1").collect()}
    assert best == {"Q0": ("SR905", "Door Access"), "Q1": ("SR903", "Print Queue")}
    # Every valid issue gets min(k, n) tickets.
    assert found.groupBy("query_id").count().where("count <> 2").count() == 0
    assert retrieve(index, issues(spark, "zzz qqq"), tf_idf(), 5).count() == 5


def test_plans_of_a_stored_lexical_index_agree(spark, tmp_path):
    index = build_index(tickets(spark), str(tmp_path / "index"), tf_idf())
    asked = issues(spark, *[f"{t[2]} {t[1]}" for t in TICKETS])
    found = [
        sorted(map(str, retrieve(index, asked, tf_idf(), 3, **plan).collect()))
        for plan in ({}, {"broadcast_queries": 0})
    ]
    assert found[0] == found[1]


def test_missing_index_is_reported_and_nothing_is_created(spark, tmp_path):
    path = str(tmp_path / "missing")
    with pytest.raises(IndexUnavailable):
        open_index(spark, path)
    assert status(spark, path) == ("unavailable", "index_unavailable", 0)
    assert not os.path.exists(path)


def test_empty_and_unreadable_indexes_differ(spark, tmp_path):
    path = tmp_path / "index"
    build_index(tickets(spark), str(path), tf_idf())
    assert status(spark, str(path)) == ("ok", None, 5)
    (path / "empty" / "manifest").mkdir(parents=True)
    assert status(spark, str(path / "empty"))[1] == "index_unavailable"
    (path / "bad" / "manifest").mkdir(parents=True)
    (path / "bad" / "manifest" / "part-0.parquet").write_text("private text, not parquet")
    with pytest.raises(RetrievalUnavailable) as caught:
        open_index(spark, str(path / "bad"))
    assert "private" not in str(caught.value)
    assert status(spark, str(path / "bad")) == ("unavailable", "retrieval_unavailable", 0)


def test_nonempty_index_is_kept_without_reset(spark, tmp_path):
    path = str(tmp_path / "index")
    build_index(tickets(spark), path, tf_idf())
    # The vectorizer is not touched: a broken one goes unnoticed.
    kept = build_index(tickets(spark, TICKETS[:2]), path, broken())
    assert (kept.version, kept.n_tickets, kept.vectorizer_id) == (1, 5, tf_idf().id)
    for version, n in ((2, 2), (3, 3)):
        index = build_index(tickets(spark, TICKETS[:n]), path, tf_idf(), reset=True)
        assert (index.version, index.n_tickets) == (version, n)
        assert open_index(spark, path).table("tickets").count() == n


def test_a_version_never_changes(spark, tmp_path):
    path = str(tmp_path / "index")
    first = build_index(tickets(spark, TICKETS[:3]), path, tf_idf())
    before = sorted(map(str, retrieve(first, issues(spark, TICKETS[0][2]), tf_idf(), 3).collect()))
    for n in (5, 2, 4):
        build_index(tickets(spark, TICKETS[:n]), path, tf_idf(), reset=True)
    assert first.table("tickets").count() == first.n_tickets == 3
    after = retrieve(first, issues(spark, TICKETS[0][2]), tf_idf(), 3).collect()
    assert sorted(map(str, after)) == before
    removed = remove_old_versions(spark, path, keep=2)
    assert len(removed) == 2 and first.folder in removed
    assert open_index(spark, path).table("tickets").count() == 4
    with pytest.raises(InputError):
        remove_old_versions(spark, path, keep=0)


def test_a_failing_model_leaves_the_old_index(spark, tmp_path):
    path = str(tmp_path / "index")
    build_index(tickets(spark), path, tf_idf())
    with pytest.raises(Exception, match="model unavailable"):
        build_index(tickets(spark), path, broken(), reset=True)
    index = open_index(spark, path)
    assert index.version == 1 and index.table("forward").count() == 5


def test_bad_tickets_never_open_storage(spark, tmp_path):
    path = str(tmp_path / "index")
    with pytest.raises(InputError):
        build_index(tickets(spark, [("SR901", "p", "", "r")]), path, tf_idf(), reset=True)
    assert not os.path.exists(path)


def test_queries_need_the_same_vectorizer(spark, tmp_path):
    index = build_index(tickets(spark), str(tmp_path / "index"), tf_idf())
    with pytest.raises(VectorizerMismatch):
        retrieve(index, issues(spark, "an issue"), tf_idf("[a-z]+"), 1)
    with pytest.raises(VectorizerMismatch):
        retrieve(index, issues(spark, "an issue"), vector_column(), 1)


def test_repeated_query_ids_are_refused(spark, tmp_path):
    index = build_index(tickets(spark), str(tmp_path / "index"), tf_idf())
    asked = issues(spark, "an issue")
    with pytest.raises(InputError):
        retrieve(index, asked.union(asked), tf_idf(), 1)


def test_embedding_function_and_row_top_k(spark, tmp_path):
    model = lengths()
    index = build_index(tickets(spark), str(tmp_path / "index"), model, n_cells=2)
    assert index.dim == 3
    asked = issues(spark, "Badge is refused", "bad", "Mail stays").withColumn(
        "top_k", F.when(F.col("query_id") == "Q0", 2).otherwise(4)
    )
    found = retrieve(index, asked, model)
    assert {r.query_id: r["count"] for r in found.groupBy("query_id").count().collect()} == {
        "Q0": 2, "Q2": 4
    }
    through_cells = retrieve(index, asked, model, broadcast_bytes=0)
    assert sorted(map(str, through_cells.collect())) == sorted(map(str, found.collect()))


def test_given_vectors(spark, tmp_path):
    given = vector_column("embedding", "test")
    rows = tickets(spark).withColumn(
        "embedding",
        F.array(*[F.when(F.col("ticket_id").endswith(str(i)), 1.0).otherwise(0.0) for i in range(1, 6)]),
    )
    index = build_index(rows, str(tmp_path / "index"), given, n_cells=2)
    asked = issues(spark, "a valid issue").withColumn(
        "embedding", F.array(*[F.lit(float(i == 3)) for i in range(1, 6)])
    )
    best = retrieve(index, asked, given, 1).head()
    assert (best.ticket_id, best.similarity_score) == ("SR903", pytest.approx(1.0))


def random_vectors(spark, n, prefix, seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    rows = [(f"{prefix}{i:03d}", "p", f"issue text {i}", "r", [float(x) for x in rng.normal(size=5)]) for i in range(n)]
    return spark.createDataFrame(rows, "ticket_id string, product string, issue string, resolution string, vector array<double>")


def top(found):
    return sorted((r.query_id, r["rank"], r.ticket_id, round(r.similarity_score, 9)) for r in found.collect())


def test_stored_cells_of_every_kind_answer_alike(spark, tmp_path):
    rows = random_vectors(spark, 200, "SR", 1)
    asked = random_vectors(spark, 30, "Q", 2).select(F.col("ticket_id").alias("query_id"), "issue", "vector")
    given = vector_column("vector", "given")
    plans = {"one": {}, "borders": {"border_share": 0.5, "n_cells": 20}, "two": {"two_levels": True, "leaf_rows": 10}}
    index = {name: build_index(rows, str(tmp_path / name), given, **plan) for name, plan in plans.items()}
    exact = top(retrieve(index["one"], asked, given, 4))
    assert len(exact) == 120
    for name in plans:
        opened = open_index(spark, index[name].path)
        assert opened.vectors().count() == 200
        assert top(retrieve(opened, asked, given, 4, broadcast_bytes=0)) == exact
    assert index["two"].tree().leaves.count() == index["two"].n_leaves > 10
    assert index["one"].tree() is None and 280 < index["borders"].vectors(copies=True).count() < 320
    for name in ("one", "borders"):
        found = top(retrieve(index[name], asked, given, 4, recall_target=0.95))
        assert len(found) == 120 and len({x[::2] for x in found} & {x[::2] for x in exact}) >= 0.95 * 120
    with pytest.raises(InputError):
        retrieve(index["two"], asked, given, 4, recall_target=0.9)
    with pytest.raises(InputError):
        build_index(rows, str(tmp_path / "both"), given, two_levels=True, border_share=0.1)


def test_of_two_builds_each_has_a_number_of_its_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "index")
    with ThreadPoolExecutor(2) as pool:
        built = list(pool.map(lambda _: build_index(tickets(spark), path, tf_idf(), reset=True), range(2)))
    rows = spark.read.json(f"{path}/manifest").select("version", "folder").collect()
    assert sorted(r.version for r in rows) == [1, 2] and len({r.folder for r in rows}) == 2
    assert {b.version for b in built} <= {1, 2}
    current = open_index(spark, path)
    assert current.version == 2 and current.table("tickets").count() == 5


def test_a_number_is_given_once(spark, tmp_path):
    from precedent.sources import index_store

    path = str(tmp_path / "index")
    row = {"version": 1, "folder": "version-a", "kind": "dense", "vectorizer_id": "v", "n_tickets": 3, "dim": 1,
           "n_blocks": 0, "first_ids": [], "n_leaves": None}
    assert index_store._take_number(spark, path, row)
    assert not index_store._take_number(spark, path, row | {"folder": "version-b"})
    # The loser sees the winner's index, or takes the next number to replace it.
    assert index_store._commit(spark, path, row | {"folder": "version-b"}, reset=False).folder == "version-a"
    replaced = index_store._commit(spark, path, row | {"folder": "version-c"}, reset=True)
    assert (replaced.version, replaced.folder) == (2, "version-c")
    # A builder that died after taking a number leaves an empty file, which nobody takes for a version.
    (tmp_path / "index" / "manifest" / f"{3:012d}.json").touch()
    assert index_store._current(spark, path).folder == "version-c"
    assert index_store._commit(spark, path, row | {"folder": "version-d"}, reset=True).version == 4


@pytest.mark.parametrize("table", ["tickets", "forward", "vocabulary"])
@pytest.mark.parametrize("cut", [True, False])
def test_a_lost_or_cut_file_is_noticed(spark, tmp_path, table, cut):
    path = tmp_path / "index"
    index = build_index(tickets(spark), str(path), tf_idf())
    assert status(spark, str(path)) == ("ok", None, 5)
    file = next((path / index.folder / table).glob("*.parquet"))
    if cut:
        file.write_bytes(file.read_bytes()[:-9])
    else:
        file.unlink()
    assert status(spark, str(path)) == ("unavailable", "retrieval_unavailable", 0)
    with pytest.raises(RetrievalUnavailable):
        open_index(spark, str(path))


def test_a_lexical_index_keeps_no_counts_and_no_shuffle_files(spark, tmp_path, monkeypatch):
    """What a build needs on its way is deleted; the settings of the session stay as they were."""
    settings, setting = index_store.settings, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    given, before = [], spark.conf.get(setting)

    def recorded(session, values):
        given.append(values[setting])
        return settings(session, values)

    monkeypatch.setattr(index_store, "settings", recorded)
    index = build_index(tickets(spark), str(tmp_path / "index"), tf_idf())
    stored = set(os.listdir(tmp_path / "index" / index.folder))
    assert stored == {"tickets", "vocabulary", "forward", "heads", "block_terms", "seal"}
    assert given == ["true"] * 5
    assert spark.conf.get(setting) == before
    asked = issues(spark, "The badge was refused", "Printer jobs vanish")
    assert retrieve(index, asked, tf_idf(), 3, broadcast_queries=0).count() == 6
