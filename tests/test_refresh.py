from gridloom.streaming import refresh as r

SCHEMA = "k int, x double, m string"


def listed(spark, path, schema):
    rows = [tuple(row) for row in r.read_fact(spark, path, schema).collect()]
    return sorted(rows, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


FIRST = [(1, 1.0, "2024-01"), (1, 1.0, "2024-01"), (2, None, None)]
SECOND = [(1, 1.0, "2024-01"), (1, 2.0, "2024-01"), (2, None, None), (3, 0.0, "2024-02")]
BOTH = sorted([(1, 1.0, "2024-01"), (2, None, None), (1, 2.0, "2024-01"), (3, 0.0, "2024-02")], key=repr)


def test_appends_only_what_is_missing(spark, folder):
    path, schema = f"{folder}/fact", frame(spark, FIRST).schema
    for rows in ([], FIRST, SECOND, [], SECOND, FIRST):
        r.append_new_rows(frame(spark, rows), path, schema, "m")
    assert listed(spark, path, schema) == BOTH


def test_a_half_written_batch_is_completed(spark, folder):
    path, schema = f"{folder}/fact", frame(spark, FIRST).schema
    r.append_new_rows(frame(spark, FIRST), path, schema, "m")
    # what a crash in the middle of committing the second batch leaves behind; the filter comes first
    r.digests.add(frame(spark, SECOND), path, "m", schema.names)
    frame(spark, SECOND[3:]).write.mode("append").partitionBy("m").parquet(path)
    r.append_new_rows(frame(spark, SECOND), path, schema, "m")
    assert listed(spark, path, schema) == BOTH


def test_refresh_reads_each_landed_file_once(spark, folder):
    landing, path, checkpoint = (f"{folder}/{n}" for n in ("landing", "fact", "checkpoint"))
    schema = frame(spark, FIRST).schema
    seen = []

    def rows(batch):
        seen.append(batch.count())
        return batch

    for load in (FIRST, SECOND):
        frame(spark, load).coalesce(1).write.mode("append").parquet(landing)
        for _ in range(2):
            r.refresh(r.landed_parquet(spark, landing, schema), rows, path, schema, "m", checkpoint)
    assert seen == [3, 4]
    assert listed(spark, path, schema) == BOTH


def spied(monkeypatch):
    """How many rows of the history each append reads."""
    seen = []
    whole = r._touched

    def touched(history, batch, month):
        found = whole(history, batch, month)
        seen.append(found.count())
        return found

    monkeypatch.setattr(r, "_touched", touched)
    return seen


def test_only_months_with_hits_are_read(spark, folder, monkeypatch):
    path, schema = f"{folder}/fact", frame(spark, FIRST).schema
    old = [(k, float(k), f"2024-0{1 + k % 3}") for k in range(300)]
    seen = spied(monkeypatch)
    r.append_new_rows(frame(spark, old), path, schema, "m")
    r.append_new_rows(frame(spark, [(1000 + k, None, "2024-01") for k in range(20)]), path, schema, "m")
    # Two rows are repeats, both of one month; a false hit elsewhere is as good as excluded here.
    r.append_new_rows(frame(spark, [old[0], old[3], (5000, 0.5, "2024-02"), (None, None, None)]), path, schema, "m")
    assert seen == [0, 120]
    got = listed(spark, path, schema)
    new = [(1000 + k, None, "2024-01") for k in range(20)] + [(5000, 0.5, "2024-02"), (None, None, None)]
    assert got == sorted(old + new, key=repr)


def test_a_missing_filter_changes_no_result(spark, folder, monkeypatch):
    path, schema = f"{folder}/fact", frame(spark, FIRST).schema
    r.append_new_rows(frame(spark, FIRST), path, schema, "m")
    with monkeypatch.context() as m:
        m.setattr(r.digests, "exists", lambda *_: False)
        r.append_new_rows(frame(spark, SECOND), path, schema, "m")
    assert listed(spark, path, schema) == BOTH
    # The rows that were added without it are found again once the filter is rebuilt.
    r.digests.compact(spark, path, schema, "m")
    r.append_new_rows(frame(spark, SECOND), path, schema, "m")
    assert listed(spark, path, schema) == BOTH


def test_a_filter_hits_all_its_rows_and_few_others(spark):
    rows = spark.range(20_000).selectExpr("id k", "cast(id % 7 as double) x", "if(id % 5 = 0, null, 'm') m")
    filters = r.digests.blocks_of(rows, "m", ["k", "x", "m"])
    assert r.digests.maybe_stored(rows, filters, "m", ["k", "x", "m"]).count() == 20_000
    others = rows.selectExpr("k + 100000 k", "x", "m")
    assert r.digests.maybe_stored(others, filters, "m", ["k", "x", "m"]).count() < 400


def test_state_forgets_no_repeat_across_a_restart(spark, folder, monkeypatch):
    landing, path, checkpoint = (f"{folder}/{n}" for n in ("landing", "fact", "checkpoint"))
    schema = frame(spark, FIRST).schema
    met = []
    append = r.append_new_rows

    def counted(new, *rest):
        met.append(new.count())
        append(new, *rest)

    monkeypatch.setattr(r, "append_new_rows", counted)
    old = [(9, 9.0, "1999-01")]
    for load in (FIRST, SECOND, FIRST + old, SECOND + old):
        frame(spark, load).coalesce(1).write.mode("append").parquet(landing)
        landed = r.landed_parquet(spark, landing, schema)
        r.refresh(landed, lambda rows: rows, path, schema, "m", checkpoint, remembered="1 day")
    # Each run is a query of its own: later ones go by the state that the first has left.
    assert [n for n in met if n] == [2, 2, 1]
    assert listed(spark, path, schema) == sorted(BOTH + old, key=repr)
