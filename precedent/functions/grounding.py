"""Checks on a generated answer, all as column expressions.

Rules run in a fixed order and the first one broken is the one reported.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from precedent.functions.text import citations, literal_count, section
from precedent.schemas import CITATION_PATTERN, HEADINGS, NO_EVIDENCE_PHRASES

SECTION_NAMES = ("likely_cause", "suggested_resolution", "ticket_ids", "limitations")


def answer_sections(answer: Column) -> dict[str, Column]:
    """One column per required section, ``""`` where a heading is missing."""
    following = HEADINGS[1:] + (None,)
    return {
        name: section(answer, heading, after)
        for name, heading, after in zip(SECTION_NAMES, HEADINGS, following)
    }


def headings_once(answer: Column) -> Column:
    """Every required heading occurs exactly once."""
    checks = [literal_count(answer, heading) == 1 for heading in HEADINGS]
    return checks[0] & checks[1] & checks[2] & checks[3]


def headings_ordered(answer: Column) -> Column:
    """The first occurrences of the headings are in the required order."""
    places = F.array(*[F.locate(heading, answer) for heading in HEADINGS])
    return F.sort_array(places) == places


def first_blank_heading(answer: Column) -> Column:
    """Heading of the first empty section, or null."""
    sections = answer_sections(answer)
    return F.coalesce(
        *[
            F.when(sections[name] == "", F.lit(heading))
            for name, heading in zip(SECTION_NAMES, HEADINGS)
        ]
    )


def unknown_citations(answer: Column, known_ids: Column, pattern: str = CITATION_PATTERN) -> Column:
    """Cited ids that were not among the ids given to the generator, sorted."""
    return F.sort_array(F.array_except(citations(answer, pattern), known_ids))


def contradicts_itself(answer: Column, pattern: str = CITATION_PATTERN) -> Column:
    """A ticket is cited although the limitations deny that evidence exists."""
    limits = F.lower(section(answer, HEADINGS[3]))
    denied = F.lit(False)
    for phrase in NO_EVIDENCE_PHRASES:
        denied = denied | limits.contains(phrase)
    return (F.size(citations(answer, pattern)) > 0) & denied


def violation(answer: Column, known_ids: Column, pattern: str = CITATION_PATTERN) -> Column:
    """``struct<code, detail>`` of the first rule broken; both null when none is."""
    blank = first_blank_heading(answer)
    unknown = unknown_citations(answer, known_ids, pattern)

    def found(code: str, detail: Column) -> Column:
        return F.struct(F.lit(code).alias("code"), detail.alias("detail"))

    nothing = F.struct(
        F.lit(None).cast("string").alias("code"), F.lit(None).cast("string").alias("detail")
    )
    return (
        F.when(
            ~headings_once(answer),
            found("heading_count", F.lit("Each of the four headings has to appear one time only.")),
        )
        .when(
            ~headings_ordered(answer),
            found("heading_order", F.lit("The four headings are not in their required order.")),
        )
        .when(
            blank.isNotNull(),
            found("blank_section", F.concat(F.lit("Nothing is written below "), blank, F.lit("."))),
        )
        .when(
            F.size(unknown) > 0,
            found(
                "unknown_citation",
                F.concat(
                    F.lit("These cited tickets were not supplied: "),
                    F.array_join(unknown, ", "),
                    F.lit("."),
                ),
            ),
        )
        .when(
            contradicts_itself(answer, pattern),
            found(
                "contradiction",
                F.lit("A ticket is cited while the limitations say that evidence is absent."),
            ),
        )
        .otherwise(nothing)
    )
