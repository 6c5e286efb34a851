import workload


def test_renumbered_tickets_meet_no_other(spark, tmp_path):
    """Turn 1 of conversation 0 and turn 0 of conversation 1000 once got the same id; SR0 is an id as well."""
    turns = [(c, t, role, f"text {c} {t}") for c in (0, 1, 1000, 1_000_000) for t, role in enumerate(["user", "assistant", "user", "assistant"])]
    turns += [(0, 1, "user", "an issue"), (0, 2, "assistant", "a remedy")]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows.write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.step: (r.version, r.n_tickets) for r in workload.index_versions(spark, str(tmp_path)).collect()}
    n = workload.chat_tickets(spark, str(tmp_path)).count()
    assert found == {"built": (1, n), "kept": (1, n), "reset": (2, 2 * n)}
