import gzip
from datetime import date, datetime

import pytest

from siftwright.contract import ColumnContract, DatasetContract, Targets, contract_of, contract_path, load_contract
from siftwright.errors import ContractError, FilenameError, Status
from siftwright.operators import retention, sink
from siftwright.operators.engine import Rules, Store, process
from siftwright.sources import filename
from siftwright.streaming import ingest

CUSTOMERS = DatasetContract("customers", "customers_*.csv*", (ColumnContract("customer_id", nullable=False), ColumnContract("name", nullable=False)), targets=Targets("customers_valid", "customers_invalid"))
ORDERS = DatasetContract("orders", "orders_*.csv*", (ColumnContract("order_id", nullable=False), ColumnContract("customer_id", nullable=False), ColumnContract("amount", "decimal", precision=6, scale=2)), targets=Targets("orders_valid", "orders_invalid"))
KEYED = Rules(key=("order_id",), parents={"customer_id": (CUSTOMERS, "customer_id")}, widths={"order_id": 8})


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    p = tmp_path / "customers_20260101.csv"
    p.write_text("customer_id,name\nC1,Ann\nC2,Bob\n")
    assert process(spark, str(p), CUSTOMERS, s).status == Status.SUCCESS
    return s


def load(spark, store, folder, text, name="orders_20260101.csv", rules=KEYED):
    p = folder / name
    p.write_bytes(text if isinstance(text, bytes) else text.encode())
    return process(spark, str(p), ORDERS, store, rules)


HEAD = "order_id,customer_id,amount\n"


def test_valid_and_invalid_rows(spark, store, tmp_path):
    r = load(spark, store, tmp_path, HEAD + "1,C1,1.00\n2,C2,x\n3,C2,\n")
    assert (r.status, r.total_rows, r.valid_rows, r.invalid_rows) == (Status.SUCCESS_WITH_INVALID_ROWS, 3, 2, 1)
    assert store.table(ORDERS).count() == 2 and store.table(ORDERS, False).first().error_code == "TYPE_MISMATCH"
    again = load(spark, store, tmp_path, HEAD + "1,C1,1.00\n2,C2,x\n3,C2,\n", "orders_20260102.csv")  # other name, same content
    assert (again.status, again.total_rows, again.checksum) == (r.status, 3, r.checksum)
    assert store.table(ORDERS).count() == 2 and store.ledger().filter("dataset = 'orders'").count() == 1


@pytest.mark.parametrize("text", ["1,C1,1.00\n1,C2,2.00\n", "1,C9,1.00\n", "123456789,C1,1.00\n"])
def test_broken_constraints_leave_nothing(spark, store, tmp_path, text):
    r = load(spark, store, tmp_path, HEAD + text)
    assert r.status == Status.DATABASE_ERROR and r.total_rows > 0
    assert store.table(ORDERS).count() == 0 and store.ledger().filter("dataset = 'orders'").count() == 0


def test_key_of_an_earlier_load(spark, store, tmp_path):
    assert load(spark, store, tmp_path, HEAD + "1,C1,1.00\n").status == Status.SUCCESS
    assert load(spark, store, tmp_path, HEAD + "1,C2,5.00\n", "orders_2.csv").status == Status.DATABASE_ERROR
    assert store.table(ORDERS).count() == 1


def test_other_ends(spark, store, tmp_path):
    assert process(spark, str(tmp_path / "none.csv"), ORDERS, store).status == Status.FILE_NOT_FOUND
    assert load(spark, store, tmp_path, "a,b\n1,2\n").status == Status.INVALID_FILE
    assert load(spark, store, tmp_path, gzip.compress(HEAD.encode() * 50)[:-9]).status == Status.PROCESSING_ERROR
    bad = DatasetContract("orders", "*", ())
    assert process(spark, str(tmp_path), bad, store).status == Status.CONFIGURATION_ERROR
    assert load(spark, store, tmp_path, HEAD).status == Status.SUCCESS


def test_uncommitted_rows_are_invisible(spark, store, tmp_path):
    store.write(spark.createDataFrame([("9", "C1", None)], ORDERS.valid_schema), "orders_valid", "0" * 64, datetime(2026, 1, 1))
    assert store.table(ORDERS).count() == 0


def test_stale_claim_is_taken_over(spark, store, tmp_path):
    from siftwright.operators.engine import sha256_of

    p = tmp_path / "orders_1.csv"
    p.write_text(HEAD + "1,C1,1.00\n")
    assert store.claim("orders", sha256_of(str(p))) and not store.claim("orders", sha256_of(str(p)))
    assert process(spark, str(p), ORDERS, store, wait_seconds=0.1).status == Status.SUCCESS


def test_two_loaders_of_one_content(spark, store, tmp_path, monkeypatch):
    from concurrent.futures import ThreadPoolExecutor
    from contextlib import nullcontext

    p = tmp_path / "orders_1.csv"
    p.write_text(HEAD + "".join(f"{k},C1,1.00\n" for k in range(200)))
    monkeypatch.setattr(Store, "renewing", lambda *_: nullcontext())  # so the claim goes stale while its holder is at work
    with ThreadPoolExecutor(3) as pool:
        ends = [*pool.map(lambda _: process(spark, str(p), ORDERS, store, wait_seconds=0.05), range(3))]
    assert {(r.status, r.total_rows, r.valid_rows) for r in ends} == {(Status.SUCCESS, 200, 200)}
    assert store.table(ORDERS).count() == 200 and store.ledger().filter("dataset = 'orders'").count() == 1
    assert len({r.id for r in store.ledger().collect()}) == 2


def test_a_renewed_claim_is_not_taken_over(store):
    import time

    assert store.claim("orders", "x")
    with store.renewing("orders", "x", 0.1):
        time.sleep(1)
        assert not store.claim("orders", "x", 0.7)
    time.sleep(1)
    assert store.claim("orders", "x", 0.7)


def test_one_entry_for_a_content(store):
    from dataclasses import replace
    from datetime import timezone

    from siftwright.operators.engine import Result

    r = Result(Status.SUCCESS, "orders", "a.csv", "c" * 64, 1, 1, 0)
    at = datetime(2026, 1, 1, 12, tzinfo=timezone.utc)
    assert store.record(r, at, "first") and not store.record(replace(r, file_name="b.csv"), at, "second")
    assert [(x.file_name, x.processed_at.astimezone(timezone.utc)) for x in store.ledger().filter("dataset = 'orders'").collect()] == [("a.csv", at)]


def test_paths_of_streams():
    assert ingest.path_of("file:///a/b%20c.csv") == "/a/b c.csv" and ingest.path_of("/a/b.csv") == "/a/b.csv"
    for uri in ("s3a://bucket/k.csv", "hdfs://nn/a/b.csv"):
        assert ingest.path_of(uri) == uri


def test_stream_tries_again(spark, store, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    sink.write_csv([["1", "C1", "1.00"]], ORDERS, str(folder / "orders_20260101.csv"))
    broken = [2]

    def flaky(*args):
        broken[0] -= 1
        return process(*args) if broken[0] < 0 else ingest.Result(Status.PROCESSING_ERROR, "orders", "x")

    monkeypatch.setattr(ingest, "process", flaky)
    run = lambda n: ingest.stream(spark, str(folder), ORDERS, store, str(tmp_path / "ck"), retries=n, sleep=lambda s: None).awaitTermination(120)
    with pytest.raises(Exception, match="could not be loaded"):
        run(0)
    assert store.table(ORDERS).count() == 0
    run(1)  # delivered again: fails once more, then loads
    assert store.table(ORDERS).count() == 1 and broken[0] == -1


def test_cascade_branches_and_schedule(spark, store, tmp_path):
    bad = lambda: process(spark, str(tmp_path), DatasetContract("orders", "*", ()), store)
    ran = ingest.cascade([("load", bad), ("next", lambda: 1), ("report", lambda: 2)], report="report")
    assert list(ran) == ["load", "report"] and ran["load"].status == Status.CONFIGURATION_ERROR
    now = [100.0]

    def step():
        now[0] += 200

    with pytest.raises(TimeoutError):
        ingest.cascade([("a", step), ("b", step), ("c", step)], timeout=240, clock=lambda: now[0])
    now, due = [1000.0], []

    def run(t):
        due.append(t)
        now[0] += 700 if len(due) == 2 else 10
        if len(due) == 1:
            raise ValueError("ends this run only")

    def sleep(s):
        now[0] += s

    ended = ingest.every(300, run, 4, sleep=sleep, clock=lambda: now[0])
    assert due == [1200, 1500, 2400, 2700] and isinstance(ended[0], ValueError)


def test_stream_loads_each_content_once(spark, store, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for k, name in enumerate(["orders_20260102.csv", "orders_20260101.csv", "other.csv"]):
        sink.write_csv([[str(k), "C1", "1.00"]], ORDERS, str(folder / name))
    told = []
    run = lambda: ingest.stream(spark, str(folder), ORDERS, store, str(tmp_path / "ck"), told=told.append).awaitTermination(120)
    run()
    assert [r.file_name for r in told] == ["orders_20260101.csv", "orders_20260102.csv"]
    sink.write_csv([["0", "C1", "1.00"]], ORDERS, str(folder / "orders_20260103.csv.gz"), compress=True)
    run()
    assert store.table(ORDERS).count() == 3 and len(told) == 3


def test_stream_of_buckets(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts")
    events.write.parquet(f"{tmp_path}/e")
    live = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/e")
    q = ingest.bucket_counts(live, "ts").writeStream.outputMode("complete").format("memory").queryName("buckets").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(spark.table("buckets").collect()) == sorted(ingest.bucket_counts(events, "ts").collect())


def test_readiness_policy():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    answers = iter([OSError(), OSError(), False, OSError(), True])

    def ready():
        a = next(answers)
        if isinstance(a, Exception):
            raise a
        return a

    ingest.wait_until(ready, poke=30, sleep=sleep, clock=lambda: now[0])
    assert slept == [1, 2, 30, 1]
    with pytest.raises(TimeoutError):
        ingest.wait_until(lambda: False, poke=30, timeout=180, sleep=sleep, clock=lambda: now[0])

    def broken():
        raise OSError

    with pytest.raises(OSError):
        ingest.wait_until(broken, poke=1, timeout=1e9, sleep=sleep, clock=lambda: now[0])


def test_cascade_stops_at_a_failed_load(spark, store, tmp_path):
    ran = ingest.cascade([("a", lambda: 1), ("load", lambda: load(spark, store, tmp_path, "a,b\n1,2\n")), ("report", lambda: 2)])
    assert list(ran) == ["a", "load"]
    assert ingest.ready_today(store.ledger(), ["customers"]) and not ingest.ready_today(store.ledger(), ["customers", "orders"])


def test_retention(tmp_path):
    for n in ["orders_20250101.csv", "orders_20250102.csv.gz", "orders_20260101.csv", "orders_x.csv", "orders_20251399.csv"]:
        (tmp_path / n).write_text("")
    deleted, left = retention.sweep(str(tmp_path), "orders", date(2025, 1, 2))
    assert deleted == ["orders_20250101.csv"] and {n for n, _ in left} == {"orders_x.csv", "orders_20251399.csv"}
    assert ingest.latest_file(str(tmp_path), "orders_2*.csv") == str(tmp_path / "orders_20260101.csv")


def test_truncate_and_verify(spark, store, tmp_path):
    from siftwright.operators import verify

    assert load(spark, store, tmp_path, HEAD + "1,C1,1.00\n").status == Status.SUCCESS
    assert verify.differences("orders_valid", store.table(ORDERS).schema, ORDERS.valid_schema) == []
    wrong = DatasetContract("orders", "*", (ColumnContract("order_id", "integer"), ColumnContract("more")))
    assert [(d.column, d.problem) for d in verify.differences("t", store.table(ORDERS).schema, wrong.valid_schema)] == [("more", "missing"), ("order_id", "is string, not decimal(38,0)")]
    store.table(ORDERS).createOrReplaceTempView("orders_view")
    assert [d.table for d in verify.catalogue(spark, {"orders_view": ORDERS.valid_schema, "none": ORDERS.valid_schema})] == ["none"]
    store.truncate(ORDERS)
    assert store.table(ORDERS).count() == 0 and store.table(CUSTOMERS).count() == 2
    assert load(spark, store, tmp_path, HEAD + "1,C1,1.00\n").status == Status.SUCCESS and store.table(ORDERS).count() == 1


def test_correlated_rows(spark):
    from siftwright.operators import generate

    parents, children = generate.correlated(spark, CUSTOMERS, ORDERS, "customer_id", 50, 300, 3, 0.2)
    ids = {r.fields[0] for r in parents.collect() if r.broken is None}
    assert 20 < len(ids) < 50 and {r.fields[1] for r in children.collect() if r.broken is None} <= ids
    assert generate.csv_lines(children, ORDERS).count() == 300


def test_masks():
    m = "{dataset}_{country}_{day:%Y%m%d}[_{part:03d}].csv"
    assert filename.parse(m, "orders_BR_20260105_007.csv") == {"dataset": "orders", "country": "BR", "day": date(2026, 1, 5), "part": 7}
    assert "part" not in filename.parse(m, "orders_BR_20260105.csv")
    for bad in ("orders_BR_20260105.csv.gz", "x_orders.csv"):
        with pytest.raises(FilenameError):
            filename.parse(m, bad)
    for bad in ("[a", "a]", "[a[b]]", "{a:%q}", "{a:3d}", "{a"):
        with pytest.raises(ValueError):
            filename.compile_mask(bad)


def test_contracts(tmp_path):
    good = {"dataset": "d", "file_pattern": "*", "columns": [{"name": "a", "type": "decimal", "precision": 6, "scale": 2}, {"name": "t", "type": "timestamp", "format": "%Y-%m-%dT%H:%M:%S%z"}]}
    assert contract_of(good).valid_schema.simpleString() == "struct<a:decimal(8,2),t:timestamp>"
    broken = [
        good | {"columns": [{"name": "1a"}]},
        good | {"columns": [{"name": "a"}, {"name": "a"}]},
        good | {"columns": [{"name": "a", "type": "float"}]},
        good | {"columns": [{"name": "a", "type": "decimal", "precision": 2, "scale": 3}]},
        good | {"columns": [{"name": "a", "type": "date"}]},
        good | {"csv": {"delimiter": ".", "decimal_separator": "."}},
        good | {"csv": {"doublequote": False}},
        good | {"targets": {"valid_table": "T", "invalid_table": "t"}},
        good | {"more": 1},
        good | {"processing": {"chunk_size": 0}},
        {"dataset": "d"},
    ]
    for b in broken:
        with pytest.raises(ContractError):
            contract_of(b)
    import json

    (tmp_path / "defaults.json").write_text(json.dumps({"csv": {"delimiter": ";", "quotechar": "'"}}))
    (tmp_path / "d.json").write_text(json.dumps(good | {"csv": {"delimiter": "|"}}))
    c = load_contract(tmp_path / "d.json", tmp_path / "defaults.json")
    assert (c.csv.delimiter, c.csv.quotechar) == ("|", '"')  # blocks are replaced whole
    with pytest.raises(ContractError):
        load_contract(tmp_path / "none.json")
    assert contract_path(tmp_path, "d.json", "d", {"d"}).name == "d.json"
    for args in (("../d.json", "d"), ("/etc/passwd", "d"), ("d.json", "e")):
        with pytest.raises(ContractError):
            contract_path(tmp_path, *args, {"d"})


def test_summary(spark, store):
    from datetime import timezone
    from decimal import Decimal

    from siftwright.operators import summary

    at = datetime(2026, 1, 2, 3, tzinfo=timezone.utc)
    report = spark.createDataFrame([("A|B", date(2026, 1, 1), 3, Decimal("1.50"), Decimal("0.50")), (None, None, 1, None, None)], "region string, order_month date, order_count long, total_amount decimal(9,2), avg_amount decimal(9,2)")
    body = summary.render(store.ledger(), report, at)
    assert "| Region | Order Month | Order Count | Total Amount | Avg Amount |\n|---|---|---|---|---|\n| A\\|B | 2026-01 | 3 | 1.50 | 0.50 |\n| None | None | 1 | None | None |" in body
    assert "| customers | customers_20260101.csv | 2 | 2 | 0 | SUCCESS | " in body and "`2026-01-02T03:00:00+00:00`" in body
    once = summary.splice("# Mine\n", body)
    assert once.startswith(summary.START) and once.endswith("# Mine\n") and summary.splice(once, body) == once
    assert summary.splice(f"a\n{summary.START}old{summary.END}\nb", "new") == f"a\n{summary.START}\n\nnew\n{summary.END}\nb"
    assert "_(no rows yet: load both datasets first)_" in summary.render(store.ledger(), report.limit(0), at)
