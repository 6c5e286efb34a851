"""Job-level faults. Row-level faults are ``status`` / ``reason_code`` columns.

Messages name rules and counts only; they never repeat text from a row.
"""


class EvidenceError(Exception):
    """Base of every fault this library raises on purpose."""

    code = "service_unavailable"


class IndexUnavailable(EvidenceError):
    """The index is missing or holds no tickets."""

    code = "index_unavailable"

    def __init__(self):
        super().__init__("The ticket index is missing or empty; build it first.")


class RetrievalUnavailable(EvidenceError):
    """The index exists but could not be read."""

    code = "retrieval_unavailable"

    def __init__(self):
        super().__init__("The ticket index could not be read.")


class VectorizerMismatch(EvidenceError):
    """Queries were vectorised differently from the index."""

    code = "vectorizer_mismatch"

    def __init__(self):
        super().__init__("Queries and index were vectorised by different vectorizers.")


class InputError(EvidenceError, ValueError):
    """A whole input table or a scalar argument breaks a rule."""

    code = "invalid_input"

    def __init__(self, rule, message):
        self.rule = rule
        super().__init__(message)
