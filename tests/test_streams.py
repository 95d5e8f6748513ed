import datetime as dt

import pytest
from pyspark.sql import functions as F

from aljibe.plans import control
from aljibe.sinks import changes, tables
from aljibe.streaming import landing, lines
from aljibe.streaming.tables import BATCH, write_batch

D = dt.date


@pytest.fixture
def schema_name(spark, request):
    name = f"st_{abs(hash(request.node.name)) % 10**8}"
    tables.create_schemas(spark, name)
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def test_a_replayed_batch_changes_nothing(spark, schema_name, tmp_path, rows):
    source, checkpoint, table = tmp_path / "in", tmp_path / "check", f"{schema_name}.sales"
    source.mkdir()
    for i in range(3):
        (source / f"{i}.txt").write_text(f"{i},{100 * i}\nBAD_LINE\n")
    lines.stream_sales_into(spark, str(source), table, str(checkpoint), files_per_batch=1).awaitTermination()
    expected = [(0, 0.0, "BAJO"), (1, 100.0, "BAJO"), (2, 200.0, "BAJO")]
    assert rows(spark.table(table), "id", "amount", "band") == expected and spark.table(table).select(BATCH).distinct().count() == 3
    # the stream stopped after the write and before the commit of its last batch
    commits = sorted((checkpoint / "commits").glob("[0-9]*"), key=lambda path: int(path.name))
    for lost in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        lost.unlink(missing_ok=True)
    lines.stream_sales_into(spark, str(source), table, str(checkpoint), files_per_batch=1).awaitTermination()
    assert rows(spark.table(table), "id", "amount", "band") == expected
    (source / "9.txt").write_text("9,900\n")
    lines.stream_sales_into(spark, str(source), table, str(checkpoint)).awaitTermination()
    assert rows(spark.table(table), "id", "amount", "band") == [*expected, (9, 900.0, "ALTO")]
    # a batch that now has fewer rows, or none, replaces the old ones
    left = rows(spark.table(table).where(F.col(BATCH) != 1), "id")
    write_batch(spark.table(table).drop(BATCH).where("false"), 1, table)
    assert rows(spark.table(table), "id") == left and len(left) == 3


def test_files_land_in_a_table(spark, schema_name, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(b"1")
    for _ in range(2):
        landing.land_new_files_into(spark, str(tmp_path / "in"), f"{schema_name}.files", str(tmp_path / "check"), "*.csv").awaitTermination()
        assert rows(spark.table(f"{schema_name}.files"), "length", "content") == [(1, bytearray(b"1"))]


def test_files_are_told_apart_by_content(spark, schema_name, tmp_path):
    folder, table, index = tmp_path / "in", f"{schema_name}.files", f"{schema_name}.digests"
    folder.mkdir()

    def land(**files):
        for name, content in files.items():
            (folder / f"{name}.csv").write_bytes(content)
        report = landing.land_changed_files(spark, str(folder), table, index, "*.csv")
        return {row.path.rsplit("/", 1)[1][:-4]: row.state for row in report.collect()}

    assert land(a=b"1", b=b"2", c=b"1") == {"a": "new", "b": "new", "c": "same content"}
    assert land() == {"a": "skipped", "b": "skipped", "c": "same content"}
    assert land(a=b"changed", d=b"2", e=b"e", f=b"") == {"a": "changed", "b": "skipped", "c": "same content", "d": "same content", "e": "new"}
    assert land() == {"a": "skipped", "b": "skipped", "c": "same content", "d": "same content", "e": "skipped"}
    assert land(a=b"1")["a"] == "skipped"  # an earlier content of its own
    assert sorted(bytes(r.content) for r in spark.table(table).collect()) == [b"1", b"2", b"changed", b"e"]


def test_late_and_changed_rows_are_loaded_once(spark, schema_name, rows):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema_name}")
    day = lambda n: D(2024, 1, n)
    target = f"{schema_name}.sales"
    first = [(n, 10.0, ["x", None], day(n)) for n in range(1, 9)]
    kind = "id int, amount double, tags array<string>, sold date"
    tables.publish(spark.createDataFrame(first, kind), target, partitioned_by=("sold",))
    control_row = spark.createDataFrame([("sales", day(8), "I", "sold", "transaccional")], control.CONTROL).first()

    def files():
        return {r[0]: r[1] for r in spark.table(target).groupBy("sold").agg(F.array_sort(F.collect_set("_metadata.file_path"))).collect()}

    def load(source, lookback=4):
        before = files()
        control.load_table(spark, control_row, spark.createDataFrame(source, kind), target, day(20), lookback)
        after = files()
        return {d.day for d in {*before, *after} if before.get(d) != after.get(d)}

    # a late row on day 6, a changed one on day 7, a row gone from day 8, one too old to be looked for on day 2, a new day
    changed = [r for r in first if r[0] not in (7, 8)] + [(7, 11.0, ["x", None], day(7)), (60, 1.0, None, day(6)), (20, 1.0, [], day(2)), (9, 5.0, ["x"], day(9))]
    assert load(changed, lookback=0) == {9}
    assert load(changed) == {6, 7, 8, 9}
    assert rows(spark.table(target), "id") == sorted([(n,) for n in (1, 2, 3, 4, 5, 6, 60, 7, 9)], key=repr)
    assert load(changed) == {9}  # the increment after the watermark is loaded each time, as before
    moved = [(i, a, None if t == ["x", None] else t, d) if i == 5 else (i, a, t, d) for i, a, t, d in changed]
    assert changes.changed_days(spark.createDataFrame(moved, kind), spark.table(target), "sold", day(4), day(8)) == {day(5)}
    twice = changed + [changed[4]]
    assert changes.changed_days(spark.createDataFrame(twice, kind), spark.table(target), "sold", day(4), day(8)) == {changed[4][3]}
