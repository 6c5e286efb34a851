import sys

from pyspark.sql import functions as F

from precedent.functions.text import WHITESPACE, citations, literal_count, section, strip


def column(spark, values, build):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return [r.x for r in rows.select("i", build(F.col("text")).alias("x")).orderBy("i").collect()]


def test_strip_is_the_same_as_in_python(spark):
    every_space = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    assert sorted(every_space) == sorted(WHITESPACE)
    values = [f"{s}a{s}b{s}" for s in every_space] + ["", "  ", "x", "​x​"]
    assert column(spark, values, strip) == [v.strip() for v in values]


def test_sections_end_at_the_next_heading_or_at_the_end(spark):
    values = ["HEAD one NEXT two", "HEAD one", "NEXT zero HEAD one", "none", "HEAD \n NEXT"]
    assert column(spark, values, lambda c: section(c, "HEAD", "NEXT")) == [
        "one", "one", "one", "", ""
    ]
    assert column(spark, values, lambda c: section(c, "NEXT")) == [
        "two", "", "zero HEAD one", "", ""
    ]


def test_citations_are_whole_words_and_distinct(spark):
    values = ["SR002, SR001 and SR002.", "XSR001 SR0011 SR01", "(SR123)", "SR١٢٣", "ÄSR001"]
    assert column(spark, values, citations) == [
        ["SR001", "SR002"], [], ["SR123"], ["SR١٢٣"], []
    ]


def test_literal_count(spark):
    values = ["aa-aa", "", "a", "aaaaa"]
    assert column(spark, values, lambda c: literal_count(c, "aa")) == [v.count("aa") for v in values]
