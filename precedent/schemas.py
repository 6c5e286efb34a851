"""Record shapes, status codes and bounds shared by every module."""

from pyspark.sql import types as T

# Bounds, thresholds, patterns and headings of the contract.
MIN_ISSUE_CHARS = 5
MAX_ISSUE_CHARS = 2000
MIN_TOP_K = 1
MAX_TOP_K = 5
DEFAULT_TOP_K = 3
GATE_SCORE = 0.50
HIGH_CONFIDENCE_SCORE = 0.60
HIGH_CONFIDENCE_MARGIN = 0.03
TICKET_ID_PATTERN = "SR[0-9]{3}"
CITATION_PATTERN = r"SR\d{3}"
HEADINGS = (
    "Likely Cause",
    "Suggested Resolution",
    "Relevant Historical Ticket IDs",
    "Evidence Limitations",
)
NO_EVIDENCE_PHRASES = ("no direct evidence", "no evidence", "without evidence")

TICKET_FIELDS = ("ticket_id", "product", "issue", "resolution")
CASE_FIELDS = ("id", "category", "query", "expected_ticket_id")
ISSUE_FIELDS = ("query_id", "issue", "top_k")

TICKETS = T.StructType([T.StructField(name, T.StringType()) for name in TICKET_FIELDS])
CASES = T.StructType([T.StructField(name, T.StringType()) for name in CASE_FIELDS])

EVIDENCE_ITEM = (
    "struct<rank:int,ticket_id:string,product:string,issue:string,"
    "resolution:string,similarity_score:double>"
)
EVIDENCE = f"array<{EVIDENCE_ITEM}>"
MESSAGES = "array<struct<role:string,content:string>>"

# Routes before generation.
ROUTE_INDEX_UNAVAILABLE = "index_unavailable"
ROUTE_ABSTAIN = "abstain"
ROUTE_GENERATE = "generate"

# Final row statuses.
ANSWERED = "answered"
REPAIRED = "repaired"
ABSTAINED = "abstained"
INVALID_ISSUE = "invalid_issue"
INVALID_TOP_K = "invalid_top_k"
INDEX_UNAVAILABLE = "index_unavailable"
GENERATOR_UNAVAILABLE = "generator_unavailable"
INVALID_MODEL_RESPONSE = "invalid_model_response"

# Decimal places on which scores are compared when ranking, so that the order
# of floating point additions cannot decide between two equal tickets.
RANK_DIGITS = 9
