import pytest
from pyspark.sql import functions as F

from corpusproof.operators import ledger
from corpusproof.operators.checks import checks_of
from corpusproof.sources import tables

def now():
    return F.lit("2024-01-02 03:04:05").cast("timestamp")


def make(spark, rows):
    return spark.createDataFrame(rows, "key string, status string, attempts string, notes string, title string")


def test_third_failure_needs_a_human(spark):
    rows = make(spark, [("a", "done", "0", "", ""), ("b", "done", "1", "x", ""), ("c", "done", "2", "", ""), ("d", "done", "", "", "")])
    judged = ledger.verdicts(checks_of(rows, "key", {"C": (F.col("key") == "d", "bad  \n one")}))
    got = {r.key: (r.status, r.attempts, r.notes) for r in ledger.with_verdicts(rows, judged, "key", now()).collect()}
    assert got == {"a": ("failed", "1", "2024-01-02 03:04 C: bad one"), "b": ("failed", "2", "x | 2024-01-02 03:04 C: bad one"), "c": ("needs_human", "3", "2024-01-02 03:04 C: bad one"), "d": ("verified", "", "")}
    assert ledger.with_verdicts(rows, judged, "key", now(), check_only=True).collect() == rows.collect()


def test_verified_is_refused_by_hand(spark):
    rows = make(spark, [("a", "done", "0", "", "")])
    keys = spark.createDataFrame([("a",)], "key string")
    with pytest.raises(ValueError):
        ledger.with_fields(rows, keys, "key", {"status": "verified"})
    with pytest.raises(ValueError):
        ledger.bulk_set(rows, {}, {"status": "verified"})
    with pytest.raises(KeyError):
        ledger.with_fields(rows, spark.createDataFrame([("z",)], "key string"), "key", {"title": "t"})
    with pytest.raises(KeyError):
        ledger.bulk_set(rows, {"nope": "1"}, {"title": "t"})
    got = ledger.with_fields(ledger.with_fields(rows, keys, "key", {"notes": " one  two "}), keys, "key", {"notes": "three", "title": "t"}).first()
    assert (got.notes, got.title) == ("one two | three", "t")


def test_merge_twice_changes_nothing(spark):
    rows = make(spark, [("a", "done", "1", "n", "old")])
    new = spark.createDataFrame([("a", "new"), ("b", None)], "key string, title string")
    once = ledger.merged(rows, new, "key").drop("merge")
    assert sorted(map(tuple, once.collect())) == [("a", "done", "1", "n", "old"), ("b", "pending", "0", "", "")]
    assert sorted(map(tuple, ledger.merged(once, new, "key").drop("merge").collect())) == sorted(map(tuple, once.collect()))
    assert {r.key: r.title for r in ledger.merged(rows, new, "key", update=True).collect()} == {"a": "new", "b": ""}


def test_a_ledger_does_not_differ_from_itself(spark):
    rows = make(spark, [("a", "done", "0", "", "t"), ("b", "x", "0", "", None)])
    assert ledger.ledger_diff(rows, rows, "key", ["title", "status", "absent"]).count() == 0


def test_csv_round_trip(spark, tmp_path):
    rows = make(spark, [("a", "done", "0", 'quo"te,\nline', None)])
    tables.write_ledger(rows, str(tmp_path / "l"), ["key", "notes", "status", "other"])
    got = tables.read_ledger(spark, str(tmp_path / "l"), ["key", "notes", "status", "other"]).first()
    assert tuple(got) == ("a", 'quo"te,\nline', "done", "")


def test_inventory_lines_are_judged(spark, tmp_path):
    (tmp_path / "i.jsonl").write_text('{"key": "a", "title": "t"}\n\n{"key": "b", "odd": 1}\n{"key": " "}\n{broken\n{"key": "c", "status": "verified"}\n')
    got = tables.read_inventory(spark, str(tmp_path / "i.jsonl"), ["key", "title", "status"], "key")
    assert sorted(r.problem or "" for r in got.collect()) == ["", "blank key", "broken JSON", "status verified cannot be set", "unknown field: odd"]
    with pytest.raises(Exception, match="refused"):
        tables.accepted(got).collect()


def test_next_batch_and_pilot(spark):
    rows = spark.createDataFrame([(str(i), s, i, "" if i == 0 else "0", str(i % 5)) for i, s in enumerate(["pending", "failed", "done", "pending", "failed", "verified", "pending", "pending", "pending", "pending", "pending", "pending"])], "page_id string, status string, row_no int, parent_id string, attachment_count string")
    assert [r.page_id for r in ledger.next_batch(rows, 4).collect()] == ["1", "4", "0", "3"]
    assert [r.page_id for r in ledger.pilot_pages(rows).collect()][:3] == ["0", "4", "9"]
    assert ledger.pilot_pages(rows).count() == 10


def test_reconcile(spark):
    old = make(spark, [("a", "verified", "1", "n", "t"), ("b", "verified", "0", "", "t"), ("c", "done", "0", "", "t")])
    new = spark.createDataFrame([("a", "t"), ("b", "u"), ("d", "v")], "key string, title string")
    got = {r.key: (r.status, r.change, r.attempts) for r in ledger.reconciled(old, new, "key", ["title"]).collect()}
    assert got == {"a": ("verified", "same", "1"), "b": ("pending", "changed", "0"), "c": ("removed_at_source", "removed", "0"), "d": ("pending", "added", "0")}


def test_files_become_lines(spark, tmp_path):
    (tmp_path / "r1" / "src").mkdir(parents=True)
    (tmp_path / "r1" / "node_modules").mkdir()
    (tmp_path / "r1" / "src" / "a.py").write_text("one\ntwo\n")
    (tmp_path / "r1" / "node_modules" / "b.js").write_text("x")
    (tmp_path / "r1" / "z.png").write_bytes(b"\x00")
    got = tables.file_lines(tables.read_files(spark, str(tmp_path)))
    assert sorted(map(tuple, got.collect())) == [("r1", "src/a.py", 1, "one"), ("r1", "src/a.py", 2, "two"), ("r1", "src/a.py", 3, "")]


def test_numbering_without_one_task_for_all(spark):
    rows = spark.range(0, 1000).selectExpr("concat('PAY-', cast(id * 7919 % 10007 + 1 as string)) as key").repartition(5)
    got = {r.key: r.place for r in ledger.numbered(rows, ledger.numeric_key_order(F.col("key"))).collect()}
    want = sorted(got, key=lambda k: int(k.split("-")[1]))
    assert [got[k] for k in want] == list(range(1, 1001))
    assert ledger.numbered(rows.limit(0), [F.col("key")]).count() == 0
