"""Merkle manifest of a table: one tree per source, one tree over their roots, and a proof per row.

Leaves of a source stand in order of id; every ``FANOUT`` consecutive nodes become their hash until
one node is left. Rows are numbered by ``ordering.place_rows``, so a source of any size is spread
over the cluster. ``BLOCK`` consecutive leaves form a block that holds whole subtrees of ``LEVELS``
levels. Inside a block the node of a level lives on the row of its first leaf: per level, lag and
lead columns at the fixed offsets one and two node widths, masked by slot and run length, supply
the siblings, and first-child rows hash parents. All levels of a block share one exchange and one
sort. The roots of blocks are the leaves of the next pass, which has 1/729 of the rows. Proofs come
back down by equi-joins on (source, block).

Edge cases: a null source is a tree of its own and comes first; null values hash as ``-``; a null id
comes before the others; rows with one id follow the order of their leaves, equal rows any; an
empty table has no rows and no root; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precedent.llm.common import Tables
from precedent.llm.ordering import TIE, group_key, place_rows, with_tie

FANOUT = 3
LEVELS = 6
BLOCK = FANOUT**LEVELS
#: Columns of a row that its leaf covers, in order.
COVERED = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<before:string,after:string>"


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(values: list[Column]) -> Column:
    """Digest of the values, each ``-`` if null, else its UTF-8 byte count, a colon, and the value."""
    texts = [v.cast("string") for v in values]
    return hashed(
        *(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)
    )


def _nodes(n: Column, width: int) -> Column:
    """Nodes of a level whose nodes span ``width`` leaves, of ``n`` leaves."""
    return F.floor((n + (width - 1)) / width).cast("long")


def _climb(rows: DataFrame) -> DataFrame:
    """Up to ``LEVELS`` levels over (``_group``, ``_row``, ``_rows``, ``digest``): adds ``steps`` and, on the first row of a block, ``top``.

    ``steps`` has one entry per level at which the row's node has a parent.
    """
    rows = rows.withColumn("_block", F.floor(F.col("_row") / BLOCK).cast("long"))
    along = Window.partitionBy("_group", "_block").orderBy("_row")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    row, found = F.col("_row"), rows.withColumn("top", F.col("digest"))
    for level in range(LEVELS):
        width = FANOUT**level
        found = found.select(
            "*",
            *(F.lag("top", width * k).over(along).alias(f"_lag{k}") for k in (1, 2)),
            *(F.lead("top", width * k).over(along).alias(f"_lead{k}") for k in (1, 2)),
        )
        node, nodes = F.floor(row / width).cast("long"), _nodes(F.col("_rows"), width)
        slot = node % FANOUT
        run = F.least(F.lit(FANOUT).cast("long"), nodes - (node - slot))
        none = F.lit("")
        before = F.when(slot == 2, F.concat("_lag2", "_lag1")).when(slot == 1, F.col("_lag1")).otherwise(none)
        after = (
            F.when((slot == 0) & (run == 3), F.concat("_lead1", "_lead2"))
            .when(((slot == 0) & (run == 2)) | ((slot == 1) & (run == 3)), F.col("_lead1"))
            .otherwise(none)
        )
        # The digest of a level stands on the first row of its node; others carry null from the level on.
        is_node, climbs = row % width == 0, nodes > 1
        found = found.withColumn(f"_step{level}", F.when(is_node & climbs, F.struct(before.alias("before"), after.alias("after"))))
        parent = F.when(climbs, hashed(F.col("top"), F.col(f"_step{level}.after"))).otherwise(F.col("top"))
        found = found.withColumn("top", F.when(row % (width * FANOUT) == 0, parent)).drop("_lag1", "_lag2", "_lead1", "_lead2")
    # The step of a row's ancestor is the last one at or before it.
    steps = [F.last(f"_step{k}", ignorenulls=True).over(so_far).alias(f"_step{k}") for k in range(LEVELS)]
    plain = [c for c in found.columns if not c.startswith("_step")]
    filled = found.select(*plain, *steps)
    all_steps = F.array(*(F.col(f"_step{k}") for k in range(LEVELS)))
    return filled.select(*plain, F.filter(all_steps, lambda s: s.isNotNull()).alias("steps"))


def _floors(leaves: DataFrame, tables: Tables, name: str) -> list[DataFrame]:
    """Passes of ``_climb`` up to one row per group; the first has a row per leaf, each next one a row per block of the last."""
    floors, current, most = [], leaves, None
    while most is None or most > 1:
        floors.append(tables.store(_climb(current), f"{name}-{len(floors)}"))
        if most is None:
            most = floors[0].agg(F.max("_rows")).head()[0] or 0
        most = -(-most // BLOCK)
        current = floors[-1].where(F.col("_row") % BLOCK == 0).select(
            "_group", F.col("_block").alias("_row"), _nodes(F.col("_rows"), BLOCK).alias("_rows"), F.col("top").alias("digest")
        )
    floors.append(tables.store(current, f"{name}-roots"))
    return floors


def _descend(floors: list[DataFrame], above: DataFrame, roots: list[str]) -> DataFrame:
    """The first floor with steps up to the top and the columns ``roots``, both taken from ``above`` (one row per ``_group``)."""
    above = above.withColumn("_block", F.lit(0).cast("long"))
    for floor in reversed(floors):
        upper = above.select("_group", "_block", F.col("steps").alias("_upper"), *roots)
        joined = floor.join(upper, ["_group", "_block"]).withColumn("steps", F.concat("steps", "_upper"))
        above = joined.drop("_upper", "_block", "top").withColumn("_block", F.col("_row"))
    return above.drop("_block")


def manifest(docs: DataFrame, carried: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, leaf, subroot, root, ``steps`` and the ``carried`` columns.

    ``steps`` lists, from the leaf up, the digests of a run's other nodes: those before the row's own joined, those after it joined.
    """
    tables = Tables(docs.sparkSession, "merkle")
    carried = carried or {}
    rows = docs.select(
        F.col("doc_id"),
        F.col("source"),
        leaf_digest([F.col(c) for c in COVERED]).alias("digest"),
        *(value.alias(f"_carried_{c}") for c, value in carried.items()),
    )
    stored = tables.store(with_tie(rows), "leaves")
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()]
    placed = place_rows(stored, tables, "leaf", group_key(F.col("source")), order, F.lit(0)).drop("_sum", "_total", TIE)
    floors = _floors(placed, tables, "tree")
    # The last floor holds the one root of every source; these are the leaves of the tree above.
    subroots = floors.pop().select(F.col("_group").alias("source_key"), "digest")
    named = tables.store(with_tie(subroots), "subroots")
    ranked = place_rows(named, tables, "subroot", F.lit("all"), [F.col("source_key").asc()], F.lit(0)).drop("_sum", "_total", TIE)
    upper = _floors(ranked, tables, "top")
    root = upper.pop().select("_group", F.col("digest").alias("root"), F.array().cast(f"array<{STEP}>").alias("steps"))
    tops = _descend(upper, root, ["root"]).select(
        F.col("source_key").alias("_group"), "steps", F.col("digest").alias("subroot"), "root"
    )
    return _descend(floors, tables.store(tops, "tops"), ["subroot", "root"]).select(
        "doc_id",
        "source",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "steps",
        *(F.col(f"_carried_{c}").alias(c) for c in carried),
    )


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings of a proof, level by level."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings of a proof lead to."""
    return F.aggregate(steps, leaf, lambda digest, s: hashed(s["before"], digest, s["after"]))


def tampered(docs: DataFrame) -> Column:
    """The text as the audit tampers with it: where 2 divides the crc32 of the id (a null id counts as the empty text), line feeds go."""
    chosen = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 2 == 0
    return F.when(chosen & F.col("text").contains("\n"), F.translate("text", "\n", ""))


def audit(docs: DataFrame) -> DataFrame:
    """Leaves, roots and proofs of ``docs``, and what a check of the tampered rows against the manifest finds."""
    changed = tampered(docs)
    other = leaf_digest([changed if c == "text" else F.col(c) for c in COVERED])
    rows = manifest(docs, {"changed_leaf": F.when(changed.isNotNull(), other)})
    folded = fold(F.coalesce("changed_leaf", "leaf"), F.col("steps"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
