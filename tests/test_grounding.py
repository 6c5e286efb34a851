from itertools import permutations

from pyspark.sql import functions as F

from precedent.functions.grounding import violation
from precedent.schemas import HEADINGS
from tests.helpers import GOOD, answer


def codes(spark, answers, known=("SR901",)):
    rows = spark.createDataFrame(list(enumerate(answers)), "i int, answer string")
    known = F.array(*[F.lit(k) for k in known])
    found = rows.select("i", violation(F.col("answer"), known).alias("v")).orderBy("i")
    return [(r.v.code, r.v.detail) for r in found.collect()]


def test_accepts_grounded_answers(spark):
    assert codes(
        spark,
        [
            answer(GOOD),
            answer(["SR901 is about this.", "Do as in SR901: restart.", "SR901", "Few tickets."]),
            answer(["Unknown.", "Ask for more.", "None.", "There is no direct evidence."]),
        ],
    ) == [(None, None)] * 3


def test_rejects_every_wrong_order(spark):
    orders = [order for order in permutations(HEADINGS) if order != HEADINGS]
    found = codes(spark, [answer(["Text."] * 4, order) for order in orders])
    assert [code for code, _ in found] == ["heading_order"] * 23


def test_rejects_missing_and_repeated_headings(spark):
    broken = ["nothing", answer(GOOD) + "\nLikely Cause", answer(GOOD[:3], HEADINGS[:3])]
    assert [code for code, _ in codes(spark, broken)] == ["heading_count"] * 3


def test_rejects_blank_sections_and_names_them(spark):
    grid = [(i, blank) for i in range(4) for blank in ("", " \t\n ", "　\x1c")]
    answers = [
        answer([blank if at == i else "Text." for at in range(4)]) for i, blank in grid
    ]
    found = codes(spark, answers)
    assert [code for code, _ in found] == ["blank_section"] * len(grid)
    assert all(HEADINGS[i] in detail for (i, _), (_, detail) in zip(grid, found))


def test_rejects_unknown_ids_in_any_section_and_sorts_them(spark):
    answers = [
        answer([text + (" See SR999 and SR100." if at == i else "") for at, text in enumerate(GOOD)])
        for i in range(4)
    ]
    for code, detail in codes(spark, answers):
        assert code == "unknown_citation"
        assert "SR100, SR999" in detail


def test_rejects_a_citation_next_to_a_denial(spark):
    denials = ["There is NO DIRECT evidence.", "No evidence.", "Given without evidence."]
    found = codes(spark, [answer([*GOOD[:3], denial]) for denial in denials])
    assert [code for code, _ in found] == ["contradiction"] * 3
