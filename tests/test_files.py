"""Inspection and scan of files."""

import csv
import gzip
import zipfile

import pytest

from siftwright import errors
from siftwright.contract import ColumnContract, DatasetContract, Dialect
from siftwright.errors import InspectionError, StructureError
from siftwright.operators import classify
from siftwright.sources import checked_csv, inspect

ORDERS = DatasetContract(
    "orders", "orders_*.csv*",
    (ColumnContract("order_id", nullable=False), ColumnContract("customer_id", nullable=False), ColumnContract("order_date", "date", format="%Y-%m-%d"), ColumnContract("amount", "decimal", precision=6, scale=2)),
)
PAIR = DatasetContract("pair", "*", (ColumnContract("id", nullable=False), ColumnContract("name", nullable=False)), chunk_size=1000)
HEAD = "order_id,customer_id,order_date,amount\n"


def put(folder, data, name="f.csv"):
    p = folder / name
    p.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(p)


def scanned(path, contract):
    plan = inspect.inspect(path, contract)
    return [*checked_csv.read_records(plan, contract)]


def refusal(path, contract):
    with pytest.raises((StructureError, InspectionError)) as e:
        scanned(path, contract)
    return e.value.code


@pytest.mark.parametrize(
    "text, code",
    [
        ("order_id,customer_id,order_date\n1,2,2026-01-01\n", errors.MISSING_REQUIRED_COLUMN),
        (HEAD.replace("amount", "amount,other") + "1,2,2026-01-01,1.00,x\n", errors.EXTRA_UNEXPECTED_COLUMN),
        ("order_id,Order_ID,order_date,amount\n1,2,2026-01-01,1.00\n", errors.DUPLICATE_COLUMN_NAME),
        ("", errors.NO_HEADER_ROW),
        ("1,2,2026-01-01,1.00\n2,3,2026-01-01,2.00\n", errors.NO_HEADER_ROW),
        (HEAD.replace(",", ";") + "1;2;2026-01-01;1.00\n2;2;2026-01-01;1.00\n", errors.DETECT_DIALECT_MISMATCH),
        ((HEAD + "1,é,2026-01-01,1.00\n").encode("utf-16"), errors.DETECT_ENCODING_MISMATCH),
    ],
)
def test_refused_files(tmp_path, text, code):
    assert refusal(put(tmp_path, text), ORDERS) == code


def test_header_only_and_mark(tmp_path):
    assert scanned(put(tmp_path, HEAD), ORDERS) == []
    assert [r[1][0] for r in scanned(put(tmp_path, b"\xef\xbb\xbf" + (HEAD + "1,2,,\n").encode()), ORDERS)] == ["1"]


def test_preamble_footer_and_repeated_header(tmp_path):
    text = "report of today\n\nid,name\nA,x\nid,name\nB,y\nTOTAL\n"
    rows = scanned(put(tmp_path, text), PAIR)
    assert [(n, f) for n, f, _ in rows] == [(1, ["A", "x"]), (2, ["B", "y"]), (3, ["TOTAL"])]
    with_footer = DatasetContract("pair", "*", PAIR.columns, Dialect(has_footer=True))
    assert [f for _, f, _ in scanned(put(tmp_path, text), with_footer)] == [["A", "x"], ["B", "y"]]


def test_quotes_newlines_and_nul(tmp_path):
    rows = scanned(put(tmp_path, 'id,name\nA,"x\ny"\nB,"p,q"\nC,"say ""hi"""\nD,a\x00b\n'), PAIR)
    assert [f[1] for _, f, _ in rows] == ["x\ny", "p,q", 'say "hi"', "a\x00b"]
    assert rows[0][2] == 'y"\n'  # the record's last line


def test_archives_by_content(tmp_path):
    data = ("id,name\n" + "".join(f"A{i},x\n" for i in range(50))).encode()
    assert len(scanned(put(tmp_path, gzip.compress(data), "plain.csv"), PAIR)) == 50
    with zipfile.ZipFile(tmp_path / "z", "w") as z:
        z.writestr("a.csv", data)
    assert len(scanned(str(tmp_path / "z"), PAIR)) == 50
    with zipfile.ZipFile(tmp_path / "zz", "w") as z:
        z.writestr("a.csv", data)
        z.writestr("b.csv", data)
    assert refusal(str(tmp_path / "zz"), PAIR) == errors.CORRUPTED_ARCHIVE
    assert refusal(put(tmp_path, gzip.compress(data)[:-20], "cut"), PAIR) == errors.CORRUPTED_ARCHIVE
    bomb = put(tmp_path, gzip.compress(b"id,name\n" + b"A,x\n" * 100_000), "bomb")
    with pytest.raises(InspectionError) as e:
        [*checked_csv.read_records(inspect.inspect(bomb, PAIR), PAIR, ceiling=100_000)]
    assert e.value.code == errors.DECOMPRESSION_BOMB_EXCEEDED


@pytest.mark.parametrize("has_footer", [False, True])
@pytest.mark.parametrize("bad", [0, 1, 2])
def test_nothing_is_lost_at_the_end_of_the_sample(tmp_path, has_footer, bad):
    contract = DatasetContract("pair", "*", PAIR.columns, Dialect(has_footer=has_footer))
    lines, size = ["id,name"], 8
    while size <= inspect.SAMPLE_BYTES:
        lines.append(f"ID{len(lines):06d},Name{len(lines):06d}")
        size += len(lines[-1]) + 1
    for k in range(bad):
        lines[-1 - k] = "BADROW" + "0" * 13
    lines += [f"ID{i:06d},Name{i:06d}" for i in range(10_000, 13_000)]
    rows = scanned(put(tmp_path, "\n".join(lines) + "\n"), contract)
    assert len(rows) == len(lines) - 1 and sum(len(f) == 1 for _, f, _ in rows) == bad


@pytest.mark.parametrize(
    "there, boundary, run",
    [(set(), 10, set()), ({5}, 5, {5}), ({3, 4, 5}, 5, {3, 4, 5}), ({1, 2, 7, 8}, 8, {7, 8}), ({0, 1, 2}, 2, {0, 1, 2}), ({5}, 0, set()), ({0}, 0, {0}), ({6}, 5, set())],
)
def test_unprovable_run(there, boundary, run):
    assert inspect.unprovable_run(there, boundary) == run


def test_delimiters():
    for d in inspect.DELIMITERS:
        assert inspect.detect_delimiter(f"a{d}b{d}c\n1{d}2{d}3\n4{d}5{d}6\n") == d
    assert inspect.detect_delimiter("one\ntwo\n") is None and inspect.detect_delimiter("a,b\0\n") is None


def test_encodings():
    assert inspect.detect_encoding(b"plain ascii text, nothing else").name == "ascii"
    assert inspect.detect_encoding("größer, schöner, éléphant, garçon und Übermut".encode()).name == "utf-8"
    assert inspect.detect_encoding("x".encode("utf-16")).source == "bom"
    assert inspect.detect_encoding(b"x", "latin-1").source == "contract"


def test_ragged_and_blank_rows_through_spark(spark, tmp_path):
    path = put(tmp_path, HEAD + "1,10,2026-01-05,1.00\n2,10\n\n3,10,2026-01-05,1.00,x\n4,,bad,1\n5,10,,\n")
    records, header = checked_csv.scan(spark, [path], ORDERS)
    marked = classify.classify(records, ORDERS, header)
    bad = {r.row_number: r for r in classify.invalid_rows(marked, ORDERS, header).collect()}
    assert {n: r.error_code for n, r in bad.items()} == {2: "WRONG_COLUMN_COUNT", 3: "WRONG_COLUMN_COUNT", 4: "WRONG_COLUMN_COUNT", 5: "NULL_VIOLATION"}
    assert bad[2].order_date is None and bad[2].error_message == "expected 4 fields, got 2" and bad[3].order_id is None
    assert bad[5].customer_id == "" and bad[5].order_date == "bad" and bad[5].raw_line == "4,,bad,1\n"
    good = classify.valid_rows(marked, ORDERS, header).collect()
    assert [r.order_id for r in good] == ["1", "5"] and good[1].amount is None


def test_optional_column_may_be_absent(spark, tmp_path):
    contract = DatasetContract("pair", "*", (ColumnContract("id", nullable=False), ColumnContract("name", required=False)))
    path = put(tmp_path, "id,more\n") and put(tmp_path, "id\nA\nB\n")
    records, header = checked_csv.scan(spark, [path], contract)
    rows = classify.valid_rows(classify.classify(records, contract, header), contract, header).collect()
    assert [(r.id, r.name) for r in rows] == [("A", None), ("B", None)]


def test_many_files_are_one_scan(spark, tmp_path):
    paths = [put(tmp_path, f"id,name\nA{i},x\n", f"f{i}.csv") for i in range(5)]
    records, _ = checked_csv.scan(spark, paths, PAIR)
    assert records.count() == 5 and records.rdd.getNumPartitions() == 5
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        records, _ = checked_csv.scan(spark, paths, PAIR)
        one = records.filter("source_file = 'f3.csv'")
        assert [r.fields[0] for r in one.collect()] == ["A3"] and one.rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_dialect_of_a_sample():
    one = inspect.detect_dialect("a;b\n'x;1';2\n'it''s';3\n")
    assert (one.delimiter, one.quotechar) == (";", "'")
    assert list(csv.reader(["'x;1';2"], **inspect.reader_options(one))) == [["x;1", "2"]]
    two = inspect.detect_dialect('a,b\n"x,1",it\'s\n')
    assert (two.delimiter, two.quotechar) == (",", '"')
    assert inspect.detect_dialect("whatever", "|").delimiter == "|"
    assert inspect.detect_dialect("single\ncolumn\n") is None
    with pytest.raises(InspectionError) as e:
        inspect.reader_options(None)
    assert e.value.code == "dialect-detection-declined"


def test_many_files_are_inspected_in_tasks(spark, tmp_path):
    paths = [str(tmp_path / f"f{k}") for k in range(5)]
    for k, p in enumerate(paths):
        open(p, "w").write(f"id,name\nA{k},x\nB{k},y\n")
    records, header = checked_csv.scan(spark, paths, PAIR)
    assert header == ["id", "name"] and sorted(r.fields[0] for r in records.collect()) == sorted(f"{c}{k}" for c in "AB" for k in range(5))
    open(paths[3], "w").write("id;name\nA;x\nB;y\n")
    with pytest.raises(StructureError) as e:
        checked_csv.scan(spark, paths, PAIR)
    assert e.value.code == "DETECT_DIALECT_MISMATCH"
    open(paths[3], "w").write("name,id\nx,A\ny,B\n")
    with pytest.raises(InspectionError):
        checked_csv.scan(spark, paths, PAIR)
