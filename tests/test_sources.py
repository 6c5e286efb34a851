import json

import pytest

from precedent import read_cases_json, read_tickets_csv
from precedent.errors import InputError
from precedent.operators.validate import require_valid_cases, require_valid_tickets
from precedent.session import shared_dir
from precedent.sources.tickets import ticket_documents

CASE = {"id": "a", "category": "c", "query": "a query", "expected_ticket_id": "SR901"}


def test_csv_by_name_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "tickets.csv"
    path.write_text(
        'issue,ticket_id,resolution,product\n"Says ""no"", twice\nper day",SR901,NA,123\n',
        encoding="utf-8",
    )
    rows = read_tickets_csv(spark, str(path))
    row = rows.head()
    assert row.issue == 'Says "no", twice\nper day'
    # Every value is text: NA and 123 are legal here.
    assert (row.ticket_id, row.resolution, row.product) == ("SR901", "NA", "123")
    require_valid_tickets(rows)
    assert ticket_documents(rows).head().retrieval_text == f"Product: 123\nIssue: {row.issue}"


def test_csv_empty_field_is_refused(spark, tmp_path):
    path = tmp_path / "tickets.csv"
    path.write_text("ticket_id,product,issue,resolution\nSR901,p,,r\n", encoding="utf-8")
    with pytest.raises(InputError, match="issue"):
        require_valid_tickets(read_tickets_csv(spark, str(path)))


def write_files(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def test_csv_files_with_columns_in_other_orders(spark, tmp_path):
    path = write_files(
        tmp_path,
        a="ticket_id,product,issue,resolution\nSR901,p,broken,mended\n",
        b='resolution,"issue",product,ticket_id\r\nreplaced,torn,q,SR902\r\n',
    )
    rows = {r.ticket_id: (r.product, r.issue, r.resolution) for r in read_tickets_csv(spark, path).collect()}
    assert rows == {"SR901": ("p", "broken", "mended"), "SR902": ("q", "torn", "replaced")}


def test_csv_files_with_other_columns_are_refused(spark, tmp_path):
    path = write_files(tmp_path, a="ticket_id,product\nSR901,p\n", b="ticket_id,issue\nSR902,i\n")
    with pytest.raises(InputError):
        read_tickets_csv(spark, path)


@pytest.mark.parametrize("row", ["SR901,p,i,r,more", "SR901,p,i"])
def test_csv_row_of_another_length_is_refused(spark, tmp_path, row):
    path = write_files(tmp_path, a=f"ticket_id,product,issue,resolution\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_tickets_csv(spark, path).collect()


def read_cases(spark, tmp_path, value):
    path = tmp_path / "cases.json"
    path.write_text(json.dumps(value, indent=2), encoding="utf-8")
    return read_cases_json(spark, str(path))


def test_cases_from_one_array(spark, tmp_path):
    rows = read_cases(spark, tmp_path, [CASE, CASE | {"id": "b", "expected_ticket_id": None}])
    require_valid_cases(rows)
    assert [(r.id, r.expected_ticket_id) for r in rows.orderBy("id").collect()] == [
        ("a", "SR901"), ("b", None)
    ]


@pytest.mark.parametrize(
    "value",
    [
        [],
        {},
        [{}],
        CASE,
        [CASE, "text"],
        [CASE, {k: v for k, v in CASE.items() if k != "expected_ticket_id"}],
        [CASE | {"id": 7}],
        [CASE | {"query": None}],
        [CASE | {"expected_ticket_id": 1}],
    ],
)
def test_misshapen_cases_are_refused(spark, tmp_path, value):
    with pytest.raises(InputError):
        read_cases(spark, tmp_path, value)


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
