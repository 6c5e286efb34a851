"""Mixing sources to target weights that change over the course of training.

Every source has a weight schedule, piecewise linear over training time 0 to 1. Its integral is
the source's weight; weights share a budget of words, and no source gives more than its size times
``max_repeats`` (what is above goes to the others by weight, until none is above). A source's
documents stand in a seeded order, pass after pass. The integral of its schedule up to time t is
the share of its words needed by then; the inverse of that gives the time, the training position,
at which a copy's first word is due. Documents are range-sorted by the position of their first copy.

Sizes are words. The copy in which the target is reached is taken up to the target, so that the
taken words of a source are its target, rounded. Edge cases: null texts and texts without words
have size 0 and are never taken; a null source is a source, the last one; rows with one id stand by
their text, equal rows in any order; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precedent.llm.common import Tables
from precedent.llm.ordering import TIE, group_key, place_rows, with_tie

BUDGET = 1.5
MAX_REPEATS = 2
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"

#: Knots (time, weight) of the schedules that the sources take in turn: fading, rising, and strongest half-way. Integrals 3, 1, 2.
SCHEDULES = (
    ((0.0, 4.0), (1.0, 2.0)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 1.0), (0.5, 3.0), (1.0, 1.0)),
)

KNOTS = "array<struct<at:double,weight:double>>"


def knots(points: tuple[tuple[float, float], ...]) -> Column:
    return F.array(*(F.struct(F.lit(float(t)).alias("at"), F.lit(float(w)).alias("weight")) for t, w in points)).cast(KNOTS)


def turn_schedule(place: Column) -> Column:
    """The schedule of the source at ``place`` (from 0)."""
    found = knots(SCHEDULES[-1])
    for turn, points in enumerate(SCHEDULES[:-1]):
        found = F.when(place % len(SCHEDULES) == turn, knots(points)).otherwise(found)
    return found


def segments(schedule: Column) -> Column:
    """The linear pieces of a schedule, each with the integral up to its begin and end."""
    pairs = F.zip_with(
        F.slice(schedule, F.lit(1), F.size(schedule) - 1),
        F.slice(schedule, F.lit(2), F.size(schedule) - 1),
        lambda a, b: F.struct(
            a["at"].alias("at"),
            a["weight"].alias("weight"),
            ((b["weight"] - a["weight"]) / (b["at"] - a["at"])).alias("slope"),
            ((a["weight"] + b["weight"]) / 2 * (b["at"] - a["at"])).alias("area"),
        ),
    )
    empty = F.array().cast("array<struct<at:double,weight:double,slope:double,begin:double,end:double>>")

    def add(done: Column, s: Column) -> Column:
        begin = F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(0.0))
        return F.concat(
            done,
            F.array(
                F.struct(s["at"].alias("at"), s["weight"].alias("weight"), s["slope"].alias("slope"), begin.alias("begin"), (begin + s["area"]).alias("end"))
            ),
        )

    return F.aggregate(pairs, empty, add)


def due_time(pieces: Column, area: Column) -> Column:
    """The time up to which the schedule's integral is ``area``: its inverse, piece by piece."""
    piece = F.try_element_at(F.filter(pieces, lambda s: s["end"] > area), F.lit(1))
    rest = area - piece["begin"]
    root = piece["weight"] + F.sqrt(piece["weight"] * piece["weight"] + 2 * piece["slope"] * rest)
    return piece["at"] + F.when(rest <= 0, F.lit(0.0)).otherwise(2 * rest / root)


def source_targets(sources: DataFrame, budget: float = BUDGET, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sources`` (size, weight) with ``target``: shares of ``budget`` times all sizes by weight, none above ``max_repeats`` times its size.

    Each round is one aggregate: what the sources at their bound leave is shared by the others' weight.
    """
    bound = F.col("size") * max_repeats
    total = sources.agg(F.sum("size")).head()[0] or 0
    level = None
    while True:
        full = F.lit(False) if level is None else (F.col("weight") * level > bound)
        given, weight = sources.agg(
            F.coalesce(F.sum(F.when(full, bound)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))
        ).head()
        # Nothing is left to share where every source is at its bound.
        again = (budget * total - given) / weight if weight > 0 else level
        if again is None or again == level:
            break
        level = again
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    share = F.col("weight") * level
    return sources.withColumn("target", F.when(share > bound, bound.cast("double")).otherwise(share))


def mix(
    docs: DataFrame,
    schedule: Callable[[Column], Column] = turn_schedule,
    budget: float = BUDGET,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken, ``copies`` and ``position``.

    ``schedule`` gives the knots of the source at a place, counted from 0 by code points. ``copies`` lists (copy, position, words)
    of the passes that take the document; ``position`` is that of the first one, null if there is none. Rows are range-sorted by it.
    """
    tables = Tables(docs.sparkSession, "mix")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        "source",
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("_draw"),
        F.xxhash64("text").alias("_text"),
    )
    stored = tables.store(with_tie(rows), "sizes")
    sums = stored.groupBy(group_key(F.col("source")).alias("source_key")).agg(F.sum("size").alias("size"))
    sums = tables.store(with_tie(sums), "sources")
    # The key of the null source sorts first; here it has to be the last.
    order = [(F.col("source_key") == "").asc(), F.col("source_key").asc()]
    ranked = place_rows(sums, tables, "source", F.lit("all"), order, F.lit(0))
    weighed = ranked.select("source_key", "size", segments(schedule(F.col("_row"))).alias("pieces"))
    weighed = tables.store(weighed.withColumn("weight", F.element_at("pieces", -1)["end"]), "weights")
    targets = tables.store(source_targets(weighed, budget, max_repeats), "targets").select(
        F.col("source_key").alias("_group"), "pieces", "weight", "target"
    )
    by = [F.col("_draw").asc(), F.col("doc_id").asc(), F.col("_text").asc(), F.col("size").asc()]
    placed = place_rows(stored, tables, "document", group_key(F.col("source")), by, F.col("size")).join(targets, "_group")
    quota = F.floor(F.col("target") + 0.5).cast("long")

    def copy(k: Column) -> Column:
        begin = k.cast("long") * F.col("_total") + F.col("_sum")
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), quota - begin))
        # The last word is due before the schedule ends, also where the target was rounded up.
        share = F.least(F.try_divide(begin, F.col("target")), F.lit(1 - 1e-12))
        return F.struct(k.alias("copy"), due_time(F.col("pieces"), F.col("weight") * share).alias("position"), words.alias("words"))

    copies = F.filter(F.transform(F.array(*map(F.lit, range(max_repeats))), copy), lambda c: c["words"] > 0)
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"])
    found = placed.withColumn("copies", copies).select(
        "doc_id",
        "source",
        "size",
        F.col("_total").alias("source_size"),
        "target",
        taken.alias("taken"),
        "copies",
        F.try_element_at("copies", F.lit(1))["position"].alias("position"),
        TIE,
    )
    return found.orderBy(F.col("position").asc_nulls_last(), "doc_id", TIE).drop(TIE)


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy that the mix takes, range-sorted by position: doc_id, source, copy, position, words."""
    copies = mixed.select("doc_id", "source", F.explode("copies").alias("c")).select("doc_id", "source", "c.*")
    return copies.orderBy("position", "doc_id", "copy")
