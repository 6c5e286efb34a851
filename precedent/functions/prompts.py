"""Texts handed to the generator and the fixed text used when it is not asked."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from precedent.schemas import HEADINGS

# Layout of one evidence block and the text of an empty list.
EVIDENCE_LABELS = ("Historical ticket ", "\nProduct: ", "\nIssue: ", "\nResolution: ")
NO_TICKETS_TEXT = "No historical tickets were retrieved."

SYSTEM_TEXT = (
    "You help support staff by reading earlier tickets.\n"
    "Everything you state must come from the tickets listed in the next message. "
    "If they do not answer the question, say that plainly instead of guessing.\n"
    "Name a ticket id only where that ticket itself backs the cause or the fix. "
    "Under the last heading describe real gaps in the tickets, and never deny the "
    "evidence of a ticket you named.\n"
    "Write these four headings, each once, in this order, each followed by text:\n"
    + "\n".join(HEADINGS)
)

ABSTAIN_TEXT = (
    f"{HEADINGS[0]}\nNo earlier ticket is close enough to this issue to name a cause.\n\n"
    f"{HEADINGS[1]}\nNo fix is proposed. Ask for more details or hand the issue to a specialist.\n\n"
    f"{HEADINGS[2]}\nNone.\n\n"
    f"{HEADINGS[3]}\nThe best match scored below the relevance gate, so no text was generated."
)


def evidence_text(evidence: Column) -> Column:
    """The evidence list as blocks of four lines, best ticket first."""
    heading, product, issue, resolution = EVIDENCE_LABELS
    blocks = F.transform(
        evidence,
        lambda item: F.concat(
            F.lit(heading),
            item["ticket_id"],
            F.lit(product),
            item["product"],
            F.lit(issue),
            item["issue"],
            F.lit(resolution),
            item["resolution"],
        ),
    )
    return F.when(F.size(evidence) > 0, F.array_join(blocks, "\n\n")).otherwise(
        F.lit(NO_TICKETS_TEXT)
    )


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def prompt_messages(issue: Column, evidence: Column) -> Column:
    """System message with the rules, user message with issue and evidence."""
    request = F.concat(
        F.lit("Issue to resolve:\n"), issue, F.lit("\n\nEarlier tickets:\n"), evidence_text(evidence)
    )
    return F.array(_message("system", F.lit(SYSTEM_TEXT)), _message("user", request))


def repair_messages(messages: Column, answer: Column, problem: Column) -> Column:
    """The first conversation, the rejected answer, and what was wrong with it."""
    request = F.concat(
        F.lit("Rewrite your answer from the same tickets only. Problem found: "),
        problem,
        F.lit(" Reply with the four headings and their text, nothing else."),
    )
    return F.concat(messages, F.array(_message("assistant", answer), _message("user", request)))


def abstain_answer() -> Column:
    """The answer given when the relevance gate is shut."""
    return F.lit(ABSTAIN_TEXT)
