"""Records over lines are the same whether one task reads a file or many do."""

import json
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructType

from gridloom.sources import records, scans

SCHEMA = StructType().add("a", IntegerType()).add("text", StringType()).add("b", DoubleType())


@contextmanager
def splits_of(spark, size):
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, (size, 1)):
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def rows_of(df):
    return listed(tuple(r) for r in df.collect())


def listed(rows):
    """Spark's own reader changes line breaks inside text where lines end in both characters."""
    return sorted((tuple(x.replace("\r\n", "\n") if isinstance(x, str) else x for x in r) for r in rows), key=repr)


def free_text(draw):
    parts = ["x", "word", " ", "\n", "\r\n", ";", '""', "\n\n", "é", "," * 9, "y" * 40]
    return "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))


def csv_file(path, rows, header="a;text;b", end="\n"):
    lines = [header] + [f'{a};"{text}";{b}' for a, text, b in rows]
    path.write_bytes((end.join(lines) + end).encode())


@pytest.fixture
def landed(tmp_path):
    draw = random.Random(3)
    rows = [(i, free_text(draw), i / 4) for i in range(240)]
    rows[150] = (150, "long\n" * 300, 0.5)
    csv_file(tmp_path / "one.csv", rows[:200])
    csv_file(tmp_path / "two.csv", rows[200:], end="\r\n")
    (tmp_path / "none.csv").write_text("a;text;b\n")
    return str(tmp_path), rows


@pytest.mark.parametrize("size", [400, 5000, 1 << 20])
def test_csv_equals_the_one_task_read(spark, landed, size):
    path, rows = landed
    whole = rows_of(scans.read_csv(spark, path, SCHEMA, free_text=True))
    with splits_of(spark, size):
        found = scans.parse_csv(spark, path, SCHEMA, free_text=True)
        if size < 5000:
            assert found.rdd.getNumPartitions() > 5
        got = found.collect()
    assert all(r[scans.MALFORMED] is None for r in got) and len(got) == len(rows)
    assert listed(tuple(r)[:3] for r in got) == whole


def test_many_tasks_read_one_file(spark, landed):
    path, rows = landed
    with splits_of(spark, 300):
        lines = records.csv_lines(spark, f"{path}/one.csv")
        starts = records.open_starts(lines, records.splits_of(lines))
        assert len(starts) > 5
        found = records.records(lines, starts)
        tasks = found.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 10 and found.count() == 201
        assert found.where("first").select("text").first()[0] == "a;text;b"


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    csv_file(tmp_path / "a.csv", [(1, "first", 0.5)])
    (tmp_path / "b.csv").write_text('b;"text";a\n2.5;second;2\nbroken;"a;text;b";3\n2.5;"a\nb";4;5\n')
    got = {r["a"]: r for r in scans.parse_csv(spark, str(tmp_path), SCHEMA, free_text=True).collect()}
    assert tuple(got[1])[:3] == (1, "first", 0.5) and tuple(got[2])[:3] == (2, "second", 2.5)
    assert got[3][scans.MALFORMED] == 'broken;"a;text;b";3' and got[3]["b"] is None
    assert got[4][scans.MALFORMED] == '2.5;"a\nb";4;5'
    (tmp_path / "c.csv").write_text("a;text;c\n1;x;2\n")
    with pytest.raises(ValueError, match=r"c\.csv has the columns \['a', 'text', 'c'\]"):
        scans.parse_csv(spark, str(tmp_path), SCHEMA, free_text=True)


def test_quarantine_is_written_once_however_often_it_is_read(spark, tmp_path):
    path, aside = tmp_path / "in", str(tmp_path / "aside")
    path.mkdir()
    csv_file(path / "a.csv", [(1, "x\ny", 0.5), ("no", "bad\nline", 1.5)])
    for _ in range(2):
        good = scans.read_csv(spark, str(path), SCHEMA, free_text=True, quarantine=aside)
        assert rows_of(good) == [(1, "x\ny", 0.5)]
        lines = [r.value for r in spark.read.option("lineSep", "\0").text(aside).collect()]
        assert [x.strip("\0\n") for x in lines] == ['no;"bad\nline";1.5']


def test_a_quote_that_never_closes_takes_the_rest_of_its_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a;text;b\n1;x;2\n2;"open;3\n4;y;5\n' + "6;z;7\n" * 50)
    (tmp_path / "b.csv").write_text("a;text;b\n8;w;9\n")
    with splits_of(spark, 32):
        got = scans.parse_csv(spark, str(tmp_path), SCHEMA, free_text=True).collect()
    assert len(got) == 3 and {1, 8} <= {r["a"] for r in got}


INNER = StructType().add("list", ArrayType(IntegerType()))
JSON_SCHEMA = StructType().add("a", IntegerType()).add("text", StringType()).add("inner", INNER)


@pytest.mark.parametrize("layout", ["lines", "indented", "several", "one line", "objects"])
@pytest.mark.parametrize("size", [300, 1 << 20])
def test_json_arrays_equal_the_one_task_read(spark, tmp_path, layout, size):
    draw = random.Random(5)
    texts = ["", 'a "quoted" one', "}{][", "back\\slash\\", "line\nbreak", "é,"]
    objects = [{"a": i, "text": draw.choice(texts), "inner": {"list": [i, 2]}} for i in range(120)]
    shown = [json.dumps(o) for o in objects]
    whole = {
        "lines": "[" + ",\n".join(shown) + "]",
        "indented": json.dumps(objects, indent=2),
        "several": "[\n" + ",\n".join(",".join(shown[k : k + 7]) for k in range(0, 120, 7)) + "\n]\n",
        "one line": json.dumps(objects),
        "objects": "[" + "\n,".join(shown) + "\n]",
    }[layout]
    (tmp_path / "a.json").write_text(whole)
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text("[\n]\n")
    wanted = rows_of(scans.read_json_documents(spark, f"{tmp_path}/a.json", JSON_SCHEMA))
    assert len(wanted) == 120
    with splits_of(spark, size):
        assert rows_of(scans.read_json_array(spark, str(tmp_path), JSON_SCHEMA)) == wanted
