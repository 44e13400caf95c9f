"""The log of landed files and the newest file by it."""

import re
from datetime import datetime
from os import utime
from pathlib import Path

import pytest

from checks import source_queries
from gridloom.sources import manifest, scans


def land(zone, name, minute, text="x"):
    path = Path(zone, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    when = datetime(2024, 1, 1, 0, minute).timestamp()
    utime(path, (when, when))


def test_newest_noted_file(spark, folder):
    Path(folder, "zone").mkdir()
    zone = f"{folder}/zone"
    with pytest.raises(FileNotFoundError):
        manifest.latest_file(spark, zone)
    land(zone, "a/telemetry_1.json", 1)
    land(zone, "a/telemetry_2.json", 5)
    land(zone, "other.json", 9)
    manifest.feed(spark, zone)
    assert manifest.latest_file(spark, zone, "telemetry_").endswith("/a/telemetry_2.json")
    assert manifest.latest_file(spark, zone).endswith("/other.json")
    assert manifest.latest_file(spark, zone, "nothing") is None
    keys = {(r.key, r.length) for r in manifest.entries(spark, zone).collect()}
    assert keys == {("a/telemetry_1.json", 1), ("a/telemetry_2.json", 1), ("other.json", 1)}
    # A file that nobody has noted yet does not count; jobs do not list the zone.
    land(zone, "a/telemetry_3.json", 7)
    assert manifest.latest_file(spark, zone, "telemetry_").endswith("/a/telemetry_2.json")
    manifest.feed(spark, zone)
    assert manifest.latest_file(spark, zone, "telemetry_").endswith("/a/telemetry_3.json")
    assert manifest.entries(spark, zone).count() == 4


def test_larger_tables_land_in_larger_files_and_every_row_does(spark, folder, monkeypatch):
    monkeypatch.setattr(source_queries, "MANY_FILES", 20)
    for rows in (0, 9, 1000):
        source_queries.land_many(spark.range(rows), f"{folder}/{rows}")
        files = list(Path(folder, str(rows)).glob("part-*"))
        assert len(files) <= max(1, min(rows, 25)) and (rows < 1000 or len(files) >= 20)
        assert sorted(int(n) for f in files for n in re.findall(r"\d+(?=})", f.read_text())) == list(range(rows))


def test_compaction_keeps_one_entry_per_key_and_the_answers(spark, folder):
    zone = f"{folder}/zone"
    for k in (1, 2):
        land(zone, f"k{k}.json", k, "x" * k)
        manifest.feed(spark, zone)
    # A key that two batches have noted, as after a move of the zone.
    again = manifest.entries(spark, zone).where("key = 'k1.json'").selectExpr(
        "key", "path", "length + 5 AS length", "modificationTime", "batch + 7 AS batch"
    )
    again.write.parquet(f"{zone}/_manifest/log/batch=7")
    assert manifest.entries(spark, zone).count() == 3
    before = manifest.latest_file(spark, zone, "k")
    manifest.compact(spark, zone)
    assert {(r.key, r.length) for r in manifest.entries(spark, zone).collect()} == {("k1.json", 6), ("k2.json", 2)}
    assert manifest.latest_file(spark, zone, "k") == before
    manifest.compact(spark, zone)
    assert manifest._parts(spark, zone) == (7, [])


def test_the_log_is_no_part_of_the_zone(spark, folder):
    zone = f"{folder}/zone"
    land(zone, "one.json", 1)
    manifest.feed(spark, zone)
    manifest.feed(spark, zone)
    assert scans.list_files(spark, zone).count() == manifest.entries(spark, zone).count() == 1
