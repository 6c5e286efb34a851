"""Rules on whole tables (tickets, cases) and on single rows (issues).

Table rules come back as a violation table ``(rule_order, rule, column_name,
n_bad)``; ``require_*`` raises on the first rule broken. Row rules set ``status``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precedent.errors import InputError
from precedent.functions.text import is_blank, strip
from precedent.schemas import (
    CASE_FIELDS,
    DEFAULT_TOP_K,
    INVALID_ISSUE,
    INVALID_TOP_K,
    ISSUE_FIELDS,
    MAX_ISSUE_CHARS,
    MAX_TOP_K,
    MIN_ISSUE_CHARS,
    MIN_TOP_K,
    TICKET_FIELDS,
    TICKET_ID_PATTERN,
)


def require_columns(df: DataFrame, required) -> None:
    """All required columns are present; names them sorted when not."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise InputError("missing_columns", f"Required columns are missing: {', '.join(missing)}")


def whole_match(text: Column, pattern: str) -> Column:
    """The entire text matches, without Java's leniency about a last newline."""
    return text.rlike(rf"\A(?:{pattern})\z")


def _count(bad: Column) -> Column:
    return F.count_if(F.coalesce(bad, F.lit(False)))


def _blank_or_not_text(df: DataFrame, name: str) -> Column:
    """A column that is not text breaks the text rule in every row."""
    if not isinstance(df.schema[name].dataType, T.StringType):
        return F.lit(True)
    return is_blank(F.col(name))


def _repeats(df: DataFrame, name: str) -> Column:
    """Rows that repeat an earlier value; one distinct aggregate, combined map-side."""
    value = F.col(name)
    return F.count(value) - F.count_distinct(value)


def _violations(df: DataFrame, rules: list[tuple[str, str | None, Column]]) -> DataFrame:
    """One aggregate over the table, unpivoted to one row per rule."""
    counts = df.agg(*[count.cast("long").alias(f"c{i}") for i, (_, _, count) in enumerate(rules)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).cast("long").alias("rule_order"),
                F.lit(rule).alias("rule"),
                F.lit(column).cast("string").alias("column_name"),
                F.col(f"c{i}").alias("n_bad"),
            )
            for i, (rule, column, _) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows))


def _raise_first(violations: DataFrame) -> None:
    """At most one row per rule comes to the driver."""
    first = violations.where("n_bad > 0").orderBy("rule_order").head()
    if first is not None:
        where = f" in {first.column_name}" if first.column_name else ""
        raise InputError(first.rule, f"Rule {first.rule} is broken{where} ({first.n_bad} rows).")


def ticket_violations(tickets: DataFrame, id_pattern: str = TICKET_ID_PATTERN) -> DataFrame:
    """Every table rule on tickets with the number of rows that break it."""
    require_columns(tickets, TICKET_FIELDS)
    bad_id = (
        ~whole_match(F.col("ticket_id"), id_pattern)
        if isinstance(tickets.schema["ticket_id"].dataType, T.StringType)
        else F.lit(True)
    )
    rules = [("empty_table", None, F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))]
    rules += [
        ("blank_field", name, _count(_blank_or_not_text(tickets, name)))
        for name in sorted(TICKET_FIELDS)
    ]
    rules.append(("id_format", "ticket_id", _count(bad_id)))
    rules.append(("id_repeated", "ticket_id", _repeats(tickets, "ticket_id")))
    return _violations(tickets, rules)


def require_valid_tickets(tickets: DataFrame, id_pattern: str = TICKET_ID_PATTERN) -> None:
    """Refuse the whole table on the first rule broken."""
    _raise_first(ticket_violations(tickets, id_pattern))


def issue_is_valid(issue: Column) -> Column:
    """Text of 5 to 2000 characters once trimmed."""
    length = F.length(strip(issue))
    return F.coalesce(length.between(MIN_ISSUE_CHARS, MAX_ISSUE_CHARS), F.lit(False))


def case_violations(cases: DataFrame) -> DataFrame:
    """Every table rule on labelled cases with the number of rows that break it."""
    require_columns(cases, CASE_FIELDS)

    def is_text(name):
        return isinstance(cases.schema[name].dataType, T.StringType)

    # A column of nulls only has no text type to show, yet null is a legal
    # expected id.
    expected_type = cases.schema["expected_ticket_id"].dataType
    if is_text("expected_ticket_id"):
        bad_expected = F.col("expected_ticket_id").isNotNull() & is_blank(F.col("expected_ticket_id"))
    elif isinstance(expected_type, T.NullType):
        bad_expected = F.lit(False)
    else:
        bad_expected = F.col("expected_ticket_id").isNotNull()
    bad_query = ~issue_is_valid(F.col("query")) if is_text("query") else F.lit(True)
    return _violations(
        cases,
        [
            ("empty_table", None, F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)),
            ("blank_field", "id", _count(_blank_or_not_text(cases, "id"))),
            ("blank_field", "category", _count(_blank_or_not_text(cases, "category"))),
            ("id_repeated", "id", _repeats(cases, "id")),
            ("query_length", "query", _count(bad_query)),
            ("blank_expected", "expected_ticket_id", _count(bad_expected)),
        ],
    )


def require_valid_cases(cases: DataFrame) -> None:
    """Refuse the whole set on the first rule broken."""
    _raise_first(case_violations(cases))


def require_top_k(top_k) -> int:
    """A real integer from 1 to 5; booleans, floats and text are refused."""
    if type(top_k) is not int or not MIN_TOP_K <= top_k <= MAX_TOP_K:
        raise InputError("top_k", f"top_k must be an integer from {MIN_TOP_K} to {MAX_TOP_K}.")
    return top_k


def require_issue_columns(issues: DataFrame, extra=()) -> None:
    """``query_id`` and ``issue`` are there, ``top_k`` may be, nothing else is.

    ``extra`` names a vector column the caller announced.

    Unknown names are counted, not repeated: a column name may hold private text.
    """
    require_columns(issues, ("query_id", "issue", *extra))
    unknown = [name for name in issues.columns if name not in (*ISSUE_FIELDS, *extra)]
    if unknown:
        raise InputError("unknown_columns", f"{len(unknown)} column(s) of the issues are not known.")
    if not isinstance(issues.schema["issue"].dataType, T.StringType):
        raise InputError("issue_type", "The issue column must be text.")
    if "top_k" in issues.columns and not isinstance(
        issues.schema["top_k"].dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)
    ):
        raise InputError("top_k", "The top_k column must be an integer column.")


def issue_status(issues: DataFrame, top_k: int = DEFAULT_TOP_K, extra=()) -> DataFrame:
    """Trimmed issue, row ``top_k`` and ``status`` (null where the row is valid).

    Narrow: no shuffle, and placed before any join with the index.
    """
    require_issue_columns(issues, extra)
    asked = F.col("top_k").try_cast("int") if "top_k" in issues.columns else F.lit(require_top_k(top_k))
    in_range = F.coalesce(asked.between(MIN_TOP_K, MAX_TOP_K), F.lit(False))
    status = F.when(~issue_is_valid(F.col("issue")), F.lit(INVALID_ISSUE)).when(
        ~in_range, F.lit(INVALID_TOP_K)
    )
    return issues.select(
        "query_id",
        strip(F.col("issue")).alias("issue"),
        asked.alias("top_k"),
        status.alias("status"),
        *extra,
    )


def require_unique_queries(issues: DataFrame) -> None:
    """``query_id`` names one row each; results are grouped by it."""
    counts = issues.agg(
        F.count_if(F.col("query_id").isNull()).alias("n_null"),
        _repeats(issues, "query_id").alias("n_repeated"),
    ).head()
    if counts.n_null or counts.n_repeated:
        raise InputError("query_id", "query_id must be present and unique.")
