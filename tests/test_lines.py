"""Files read in splits and documents written in parts, against whole files and whole documents."""

import os
import random

import pytest
from pyspark.sql import functions as F

from corpusproof.sources import lines as sources
from corpusproof.sources import tables


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def put(folder, name, body):
    os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(body)


def test_lines_of_files_larger_than_a_split(spark, tmp_path, tiny_splits):
    draw = random.Random(3)
    long = "\n".join("x" * draw.choice([0, 1, 5, 40, 900]) + "é" for _ in range(900))
    bodies = {
        "r1/src/long.py": long.encode(),
        "r1/src/long and+odd %41 name.py": (long + "\n").encode(),
        "r1/one.txt": b"one",
        "r1/feeds.txt": b"\n\n\n" * 5000,
        "r1/carriage.txt": b"a\r\nb\rc\n",
        "r1/empty.txt": b"",
        "r2/mark.txt": b"\xef\xbb\xbfhead\ntail",
        "r2/mark closed.txt": b"\xef\xbb\xbf\nx\n",
        "r2/mark only.txt": b"\xef\xbb\xbf",
        "r2/three.txt": b"abc",
    }
    for name, body in bodies.items():
        put(tmp_path, name, body)
    got = sources.numbered_lines(spark, str(tmp_path))
    want = sorted((name, k + 1, text) for name, body in bodies.items() for k, text in enumerate(body.decode().split("\n")) if body)
    assert sorted(map(tuple, got.collect())) == want
    splits = sources._stored(spark, str(tmp_path), None).where("name = 'r1/src/long.py'").select("start").distinct().count()
    assert splits > 10


def test_same_lines_as_whole_files(spark, tmp_path, tiny_splits):
    put(tmp_path, "r1/src/a.py", b"one\ntwo\n")
    put(tmp_path, "r1/node_modules/b.js", b"x")
    put(tmp_path, "r1/z.png", b"\x00")
    put(tmp_path, "r1/early.txt", b"ab\n" * 1000 + b"x\x00y\nlast")  # the NUL is character 3002
    put(tmp_path, "r1/late.txt", b"ab\n" * 1400 + b"x\x00y\nlast")  # character 4202
    put(tmp_path, "r2/edge.txt", b"a" * 4095 + b"\x00")
    put(tmp_path, "r2/past.txt", b"a" * 4096 + b"\x00")
    put(tmp_path, "r2/large.txt", b"words\n" * 200_000)
    whole = tables.file_lines(tables.read_files(spark, str(tmp_path)))
    got = sources.read_lines(spark, str(tmp_path))
    assert got.columns == whole.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
    assert {r.path for r in got.select("path").distinct().collect()} == {"src/a.py", "late.txt", "past.txt"}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    anything = sources.read_lines(spark, str(tmp_path), most_bytes=None).where("path = 'large.txt'")
    assert anything.agg(F.count("*"), F.max("line"), F.countDistinct("line")).first() == (200_001, 200_001, 200_001)


def test_documents_in_parts(spark, tmp_path, tiny_splits):
    rows = [("big/1: a=b%", k, f"line {k * 7 % 1000}") for k in range(3000)] + [("one", 1, ""), ("one", 2, "\ufeffmarked"), (None, 5, "of none"), ("", 1, "of blank"), ("none", 1, "named none"), ("tie", 1, "b"), ("tie", 1, "a"), ("tie", None, "z"), ("gap", 1, None), ("gap", 2, "kept"), ("bom", 1, "\ufefffirst")]
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame(rows, "doc string, seq long, line string")
    manifest = sources.write_ordered(table.repartition(7), str(tmp_path / "d"))
    parts = manifest.where("doc = 'big/1: a=b%'").orderBy("part").collect()
    assert len(parts) > 1 and sum(p.lines for p in parts) == 3000 and parts[0].first_line == 1
    assert all(b.first_line == a.first_line + a.lines for a, b in zip(parts, parts[1:], strict=False))
    got = sorted(map(tuple, sources.read_ordered(spark, str(tmp_path / "d")).collect()), key=repr)
    bodies = {r.doc: r.body for r in tables.rendered(table).collect()}
    assert got == sorted(((doc, k + 1, text) for doc, body in bodies.items() for k, text in enumerate(body.split("\n"))), key=repr)
    # a part's file is plain text in order
    files = sorted((tmp_path / "d" / "text").glob("doc=-big*/part=*/*.txt"), key=lambda f: int(f.parent.name.split("=")[1]))
    assert "".join(f.read_text() for f in files) == bodies["big/1: a=b%"] + "\n"


def test_no_documents_and_lost_parts(spark, tmp_path):
    assert sources.write_ordered(spark.createDataFrame([], "doc string, seq long, line string"), str(tmp_path / "e")).count() == 0
    assert sources.read_ordered(spark, str(tmp_path / "e")).count() == 0
    sources.write_ordered(spark.range(100).selectExpr("'d' as doc", "id as seq", "'x' as line"), str(tmp_path / "f"))
    file = next((tmp_path / "f" / "text").glob("doc=-d/part=*/*.txt"))
    os.remove(file)
    with pytest.raises(Exception, match="lines lost or added"):
        sources.read_ordered(spark, str(tmp_path / "f")).count()
