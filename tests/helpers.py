"""Small tables in the shapes the library reads. All rows are invented."""

from precedent.schemas import EVIDENCE, HEADINGS

TICKETS = [
    ("SR901", "Mail Relay", "Outgoing mail stays in the outbox", "Restart the relay."),
    ("SR902", "Mail Relay", "Attachments above ten megabytes are dropped", "Raise the size limit."),
    ("SR903", "Print Queue", "Jobs vanish before the printer starts", "Clear the spool folder."),
    ("SR904", "Print Queue", "Pages come out blank after an update", "Install the older driver."),
    ("SR905", "Door Access", "Badge is refused at the north gate", "Enrol the badge again."),
]
TICKET_SCHEMA = "ticket_id string, product string, issue string, resolution string"


def tickets(spark, rows=TICKETS):
    return spark.createDataFrame(rows, TICKET_SCHEMA)


def item(rank, ticket_id, score):
    return (rank, ticket_id, "product", "issue", "resolution", score)


def evidence(spark, lists):
    """``{query_id: [(ticket_id, score), ...]}`` as ``(query_id, issue, evidence)``."""
    rows = [
        (query, f"issue {query}", [item(i, t, s) for i, (t, s) in enumerate(found, 1)])
        for query, found in lists.items()
    ]
    return spark.createDataFrame(rows, f"query_id string, issue string, evidence {EVIDENCE}")


def answer(contents, headings=HEADINGS):
    return "\n".join(f"{heading}\n{content}" for heading, content in zip(headings, contents))


GOOD = ("A stuck queue.", "Restart it.", "SR901", "No material gap.")
