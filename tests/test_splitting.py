import csv
import json
import random

import pytest

from precedent import read_cases_json, read_tickets_csv
from precedent.errors import InputError
from precedent.operators.validate import require_valid_cases
from precedent.sources import splitting


@pytest.fixture
def small_ranges(spark):
    """Byte ranges so small that records cross them."""

    def set_bytes(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_bytes
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def random_value(rng):
    parts = ["a", "é", '"', '""', ",", "\n", "\r\n", " ", "word", "\\", "\n\n", "{", "}"]
    return "".join(rng.choices(parts, k=rng.randint(1, 12)))


@pytest.mark.parametrize("size", [100, 900])
def test_csv_with_line_breaks_is_read_in_ranges(spark, tmp_path, small_ranges, size):
    rng = random.Random(size)
    rows = [(f"SR{i}", *("x" + random_value(rng) + "y" for _ in range(3))) for i in range(40)]
    rows.append(("SR900", "p", "q\n" * 200 + "end", "r"))
    for name, part, quoting in (("a", rows[:20], csv.QUOTE_MINIMAL), ("b", rows[20:], csv.QUOTE_ALL)):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as file:
            writer = csv.writer(file, quoting=quoting, lineterminator="\r\n" if name == "b" else "\n")
            writer.writerow(["ticket_id", "product", "issue", "resolution"])
            writer.writerows(part)
    small_ranges(size)
    found = read_tickets_csv(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > 2
    assert sorted(map(tuple, found.collect())) == sorted(rows)


@pytest.mark.parametrize("line", ['SR1,p,5" pipe,r', 'SR1,p,"open,r', 'SR1,p,"a"b,r'])
def test_misplaced_quotes_are_refused(spark, tmp_path, line):
    (tmp_path / "a.csv").write_text(f"ticket_id,product,issue,resolution\nSR0,a,b,c\n{line}\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED"):
        read_tickets_csv(spark, str(tmp_path)).collect()


def test_empty_and_quoted_empty_fields_as_before(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ticket_id,product,issue,resolution\nSR0,,"",\n\nSR1, a ,"b ", c\n', encoding="utf-8")
    split, whole = (sorted(map(str, read_tickets_csv(spark, str(tmp_path), split=s).collect())) for s in (True, False))
    assert split == whole


def random_case(rng, i):
    query = "".join(rng.choices(["a", '"', "\\", "{", "}", "[", "]", ",", "\n", "é", "\\\"}", " "], k=rng.randint(1, 20)))
    return {"id": f"c{i}", "category": "k", "query": "query " + query, "expected_ticket_id": rng.choice([None, "SR1}"]), "more": [{"x": [1]}, {}]}


@pytest.mark.parametrize("size", [60, 900])
@pytest.mark.parametrize("indent", [None, 2])
def test_one_json_array_is_read_in_ranges(spark, tmp_path, small_ranges, size, indent):
    rng = random.Random(size)
    cases = [random_case(rng, i) for i in range(15)]
    (tmp_path / "cases.json").write_text("\n" + json.dumps(cases, indent=indent, ensure_ascii=indent is None) + "\n", encoding="utf-8")
    small_ranges(size)
    rows = read_cases_json(spark, str(tmp_path))
    assert {(r.id, r.query, r.expected_ticket_id) for r in rows.collect()} == {
        (c["id"], c["query"], c["expected_ticket_id"]) for c in cases
    }
    require_valid_cases(rows)
    assert splitting.ranges(spark, str(tmp_path), "}").rdd.getNumPartitions() > 3


CASE = json.dumps({"id": "a", "category": "c", "query": "a query", "expected_ticket_id": None})


@pytest.mark.parametrize(
    "text",
    ["", " ", "[", "[]", f"[{CASE}", f"{CASE}]", f"[{CASE} {CASE}]", f"[{CASE},]", f"[{CASE}, 1, {CASE}]",
     f"[{CASE}]]", f"[[{CASE}]]", f"[{CASE}] x", f'["{{}}", {CASE}]', f"[{CASE},, {CASE}]", CASE],
)
def test_broken_arrays_are_refused(spark, tmp_path, text):
    (tmp_path / "cases.json").write_text(text, encoding="utf-8")
    with pytest.raises(InputError):
        read_cases_json(spark, str(tmp_path))
