"""Secrets in text with native column expressions: base patterns and windowed entropy.

Candidate strings are runs of 24 or more key characters with letters and digits. A window of 24
slides over each; counts per character are updated by the one that enters and the one that
leaves, and with them the sum of c log c, so the Shannon entropy of every window costs one step.
The threshold depends on the character class of the string. Strings on the allow list, and those a base
pattern has found already, are not added.

Edge cases: a null or empty text has no spans; spans count code points, ends exclusive; input
columns that carry a name of the result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precedent.llm.common import others, spare_names

# The base patterns.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Longer runs than this only can be a hex secret; the runs are maximal, so the rest is skipped.
HEX_LONG = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")
CANDIDATE = r"[A-Za-z0-9+/_=-]{24,}"
WINDOW = 24
# Alphabets of the classes.
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
ALPHABET = DIGITS + LOWER + LOWER.upper() + "+/_=-"
#: (class, pattern of the whole candidate, least entropy in bits of its best window)
CLASSES = (
    ("hex", r"^[0-9a-fA-F]+$", 3.0),
    ("alphanumeric", r"^[0-9A-Za-z]+$", 3.7),
    ("base64", r"^[0-9A-Za-z+/_=-]+$", 3.9),
)
#: Candidates that match are no secrets: UUIDs, counting and alphabet runs, placeholders, paths.
ALLOW = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)0123456789|abcdefghij",
    r"(?i)example|sample|placeholder|your[_-]?(api|key|token|secret)|x{6,}",
    r"^/?([A-Za-z]{3,}[0-9]{0,4}/)+[A-Za-z]{3,}[0-9]{0,4}/?$",
    r"^[A-Za-z]+([_-][A-Za-z]+)*[_=-]*[0-9]{0,4}$",
)
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _none() -> Column:
    return F.array().cast(SPAN)


def _located(text: Column, pattern: str) -> Column:
    """(start, end, value) of every match, in code points.

    The pieces between the matches and the matches themselves alternate, so the running sum of
    their lengths gives the positions.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    sizes = F.zip_with(between, found, lambda b, m: F.struct(F.length(b).alias("gap"), m.alias("value")))
    sizes = F.slice(sizes, 1, F.size(found))
    state = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"),
    )

    def step(acc: Column, piece: Column) -> Column:
        begin = acc["at"] + piece["gap"]
        end = begin + F.length(piece["value"])
        span = F.struct(begin.alias("start"), end.alias("end"), piece["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.aggregate(sizes, state, step, lambda acc: acc["out"])


def _spans(located: Column, kind: int) -> Column:
    return F.transform(
        located, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
    )


def base_spans(text: Column) -> tuple[Column, Column, Column]:
    """Spans of the three base kinds."""

    def assigned(m: Column) -> Column:
        return F.length(F.regexp_extract(m["value"], "^" + ASSIGN + "$", 2)) >= 12

    assign = F.when(text.rlike(ASSIGN), _spans(F.filter(_located(text, ASSIGN), assigned), 0))
    access = F.when(
        text.contains("AKIA"),
        _spans(F.filter(_located(text, ACCESS), lambda m: F.length(m["value"]) >= 18), 1),
    )
    hexes = F.when(text.rlike(HEX_LONG), _spans(_located(text, HEX_LONG), 2))
    return tuple(F.coalesce(c, _none()) for c in (assign, access, hexes))


def _c_log_c(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def best_entropy(value: Column) -> Column:
    """Largest Shannon entropy (bits) of any window of ``WINDOW`` characters; 0 for shorter strings."""
    codes = F.transform(F.split(value, ""), lambda ch: F.instr(F.lit(ALPHABET), ch) - 1)
    return _named(F.filter(codes, lambda code: code >= 0), _best_window)


def _named(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda variable holds it."""
    return F.transform(F.array(value), use)[0]


def _changed(state: Column, code: Column, by: int) -> tuple[Column, Column]:
    """Counts and sum of c log c once the count of ``code`` has changed."""
    old = F.get(state["counts"], code)
    total = state["total"] + _c_log_c(old + by) - _c_log_c(old)
    return F.transform(state["counts"], lambda c, i: F.when(i == code, c + by).otherwise(c)), total


def _best_window(codes: Column) -> Column:
    def step(acc: Column, at: Column) -> Column:
        counts, total = _changed(acc, F.get(codes, at), 1)
        entered = F.struct(counts.alias("counts"), total.alias("total"))
        return _named(entered, lambda now: _after(now, codes, at, acc["best"]))

    state = F.struct(
        F.transform(F.sequence(F.lit(1), F.lit(len(ALPHABET))), lambda _: F.lit(0)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0.0).alias("best"),
    )
    places = F.sequence(F.lit(0), F.size(codes) - 1)
    return F.when(
        F.size(codes) >= WINDOW, F.aggregate(places, state, step, lambda acc: acc["best"])
    ).otherwise(F.lit(0.0))


def _after(now: Column, codes: Column, at: Column, best: Column) -> Column:
    """State once a character has entered: measure a full window, then let its first leave."""
    full = at >= WINDOW - 1
    entropy = F.log2(F.lit(float(WINDOW))) - now["total"] / WINDOW
    counts, total = _changed(now, F.get(codes, at - (WINDOW - 1)), -1)
    return F.struct(
        F.when(full, counts).otherwise(now["counts"]).alias("counts"),
        F.when(full, total).otherwise(now["total"]).alias("total"),
        F.when(full, F.greatest(best, entropy)).otherwise(best).alias("best"),
    )


def entropy_spans(text: Column, allow: tuple[str, ...] = ALLOW) -> Column:
    """Spans of candidate strings whose entropy is that of a random string of their class."""

    def likely(value: Column) -> Column:
        mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
        for pattern in allow:
            mixed = mixed & ~value.rlike(pattern)
        return mixed

    def random(value: Column) -> Column:
        least = F.lit(None).cast("double")
        for _, pattern, bits in reversed(CLASSES):
            least = F.when(value.rlike(pattern), F.lit(bits)).otherwise(least)
        return best_entropy(value) >= least

    any_likely = F.exists(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), likely)
    found = F.filter(_located(text, CANDIDATE), lambda m: F.when(likely(m["value"]), random(m["value"])).otherwise(F.lit(False)))
    return F.coalesce(F.when(any_likely, _spans(found, 3)), _none())


def _written(spans: Column) -> Column:
    def one(s: Column) -> Column:
        kind = F.lit(None).cast("string")
        for i, k in enumerate(KINDS):
            kind = F.when(s["kind"] == i, F.lit(k)).otherwise(kind)
        return F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))

    return F.array_join(F.transform(spans, one), ",")


def scan_secrets(docs: DataFrame, text: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, base_spans, secret_spans (all, sorted by start, then kind),
    and both written as text."""
    added = ["n_assign", "n_access", "n_hex", "base_spans", "secret_spans", "base_text", "spans"]
    kept = others(docs, added)
    names = spare_names(docs, ["_assign", "_access", "_hex", "_entropy"])
    assigned, accessed, hexed, random = names
    whole = F.coalesce(F.col(text), F.lit(""))
    assign, access, hexes = base_spans(whole)
    step = docs.select(
        *kept,
        assign.alias(assigned),
        access.alias(accessed),
        hexes.alias(hexed),
        entropy_spans(whole, allow).alias(random),
    )
    step = step.withColumn("base_spans", F.sort_array(F.concat(assigned, accessed, hexed)))
    new = F.filter(
        random,
        lambda e: ~F.exists("base_spans", lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"])),
    )
    step = step.withColumn("secret_spans", F.sort_array(F.concat("base_spans", new)))
    return step.select(
        *kept,
        F.size(assigned).cast("long").alias("n_assign"),
        F.size(accessed).cast("long").alias("n_access"),
        F.size(hexed).cast("long").alias("n_hex"),
        "base_spans",
        "secret_spans",
        _written(F.col("base_spans")).alias("base_text"),
        _written(F.col("secret_spans")).alias("spans"),
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span of the sorted ``spans`` replaced; overlapping spans become one mark."""

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], before, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate(
        spans, state, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)
