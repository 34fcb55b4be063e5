"""Versioned tables: what readers see while and after writers write, die or meet."""

import os
import signal
import subprocess
import sys
import textwrap
import time

import pytest
from pyspark.sql import functions as F

from martforge.operators.keymap import OCCURRENCE, extend_key_map, occurrences, with_stable_key
from martforge.operators.sinks import append_table, full_refresh, replace_table
from martforge.operators.versions import ConcurrentCommit, VersionedTable, read_table

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((c is None, str(c)) for c in r))


def fails(df):
    """The same rows; the last task fails."""
    return df.repartition(4).withColumn("a", F.when(F.spark_partition_id() == 3, F.raise_error(F.lit("lost")).cast("long"))
                                        .otherwise(F.col("a")))


@pytest.mark.parametrize("write", [full_refresh, lambda df, path: replace_table(df, path, df.schema), append_table])
def test_failed_write_leaves_the_rows(spark, tmp_uri, write):
    path = f"{tmp_uri}/t"
    replace_table(spark.range(20).select(F.col("id").alias("a")), path, spark.range(1).select(F.col("id").alias("a")).schema)
    before = VersionedTable(spark, path).current()
    with pytest.raises(Exception, match="lost"):
        write(fails(spark.range(100).select(F.col("id").alias("a"))), path)
    assert VersionedTable(spark, path).current() == before
    assert rows_of(read_table(spark, path)) == rows_of(spark.range(20))


def test_killed_writer_leaves_the_rows(spark, tmp_uri):
    """A process is killed in the middle of a refresh, after some of its files are there."""
    path = f"{tmp_uri}/t"
    one = spark.range(20).select(F.col("id").alias("a"))
    replace_table(one, path, one.schema)
    script = textwrap.dedent(f"""
        import sys; sys.path.insert(0, {ROOT!r})
        from pyspark.sql import functions as F
        from martforge.session import build_session
        from martforge.operators.sinks import full_refresh
        spark = build_session("local[2]", shuffle_partitions=2)
        slow = spark.range(0, 40, 1, 40).select(F.col("id").alias("a"))
        def nap(batches):
            import time
            for b in batches:
                time.sleep(1)
                yield b
        full_refresh(slow.mapInPandas(nap, "a long"), {path!r})
    """)
    run = subprocess.Popen([sys.executable, "-c", script], stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL, start_new_session=True)
    try:
        end = time.time() + 90
        while time.time() < end and run.poll() is None:
            # more files than the first version's: the refresh has begun to write
            data = os.path.join(path, "data")
            if sum(f.startswith("part-") for d, _, names in os.walk(data) if "_temporary" in d for f in names) >= 2:
                break
            time.sleep(0.2)
        assert run.poll() is None
    finally:
        os.killpg(run.pid, signal.SIGKILL)
        run.wait()
    assert rows_of(read_table(spark, path)) == rows_of(one)
    assert full_refresh(one.filter("a < 3"), path) == 3  # and the next writer goes on
    assert rows_of(read_table(spark, path)) == [(0,), (1,), (2,)]


def test_commit_cut_short_is_skipped(spark, tmp_uri):
    t = VersionedTable(spark, f"{tmp_uri}/t")
    df = spark.range(3)
    v1 = t.commit(df.schema, [t.write(df)], None)
    for torn in ("", '{"schema": {"ty'):
        with open(f"{tmp_uri}/t/_commits/{(t.numbers()[-1] + 1):012d}.json", "w") as f:
            f.write(torn)
    assert t.current() == v1 and t.read().count() == 3
    v4 = t.commit(df.schema, [], v1)
    assert v4.number == 4 and t.current() == v4 and t.read().count() == 0


def test_writers_that_meet(spark, tmp_uri):
    a, b = VersionedTable(spark, f"{tmp_uri}/t"), VersionedTable(spark, f"{tmp_uri}/t")
    df = spark.range(2)
    v1 = a.commit(df.schema, [a.write(df)], None)
    mine = b.write(df)
    v2 = a.commit(df.schema, [*v1.parts, a.write(df)], v1)
    with pytest.raises(ConcurrentCommit):
        b.commit(df.schema, [*v1.parts, mine], v1)
    assert b.change(df.schema, lambda now: [*now.parts, mine]).parts == (*v2.parts, mine)
    assert a.read().count() == 6 and a.read(v1).count() == 2


def test_ranges_and_vacuum(spark, tmp_uri):
    t = VersionedTable(spark, f"{tmp_uri}/t")
    df = spark.range(30).select("id", F.concat(F.lit("r"), (F.col("id") % 3).cast("string")).alias("k"))
    parts = t.write_ranges(df, "k", sort_by=["id"])
    schema = df.select("id").schema
    v1 = t.commit(schema, parts, None)
    assert [(p.key, p.rows) for p in parts] == [("r0", 10), ("r1", 10), ("r2", 10)] and t.read().columns == ["id"]
    assert rows_of(t.read(keys={"r1"})) == rows_of(df.filter("k = 'r1'").select("id"))
    new = t.write(spark.range(100, 102), "r1")
    v2 = t.commit(schema, [new if p.key == "r1" else p for p in v1.parts], v1)
    assert t.read().count() == 22 and v2.keys() == {"r0", "r1", "r2"} and v2.parts[0] == v1.parts[0]
    orphan = t.write(spark.range(1))
    assert t.vacuum(keep=1) == []  # all of it is young
    assert t.vacuum(keep=1, min_age_s=0) == [orphan.folder.split("/")[1]]
    assert t.read().count() == 22 and t.numbers() == [2]
    assert t.write_ranges(df.limit(0), "k") == []


def test_keys_stay(spark, tmp_uri):
    t = VersionedTable(spark, f"{tmp_uri}/keys")
    first = spark.createDataFrame([("b", 2, "x"), ("a", None, "y"), ("b", 9, "z"), ("b", 2, "again")], "k string, n long, v string")
    v1 = extend_key_map(t, first, ["k", "n"], "sk")
    got = rows_of(with_stable_key(t, v1, first, ["k", "n"], "sk"))
    assert got == [(1, "a", None, "y"), (2, "b", 2, "again"), (2, "b", 2, "x"), (3, "b", 9, "z")]
    second = spark.createDataFrame([("a", 1, "new"), ("b", 9, "z2"), (None, None, "none"), ("b", 1, "new")], "k string, n long, v string")
    v2 = extend_key_map(t, second, ["k", "n"], "sk")
    assert rows_of(with_stable_key(t, v2, second, ["k", "n"], "sk")) == [
        (3, "b", 9, "z2"), (4, None, None, "none"), (5, "a", 1, "new"), (6, "b", 1, "new")]
    assert extend_key_map(t, first, ["k", "n"], "sk") == v2  # nothing new: no version
    v3 = extend_key_map(VersionedTable(spark, f"{tmp_uri}/none"), first.limit(0), ["k", "n"], "sk")
    assert v3.rows == 0 and v3.number == 1


def test_a_key_for_each_row_of_a_map_written_without(spark, tmp_uri):
    t = VersionedTable(spark, f"{tmp_uri}/keys")
    df = spark.createDataFrame([(2, "x"), (1, "b"), (None, "n"), (1, "a"), (None, "m")], "n long, v string")
    old = extend_key_map(t, df, ["n"], "sk")
    rows, own = occurrences(df, ["n"], ["v"]), [OCCURRENCE, "n"]
    version = extend_key_map(t, rows, own, "sk")
    assert (old.rows, version.rows) == (3, 5)
    for _ in range(2):
        assert rows_of(with_stable_key(t, version, rows, own, "sk").drop(OCCURRENCE)) == [
            (1, None, "m"), (2, 1, "a"), (3, 2, "x"), (4, None, "n"), (5, 1, "b")]
        assert extend_key_map(t, rows, own, "sk") == version


def test_key_map_needs_the_newest_version(spark, tmp_uri, monkeypatch):
    t = VersionedTable(spark, f"{tmp_uri}/keys")
    df = spark.createDataFrame([(1,), (2,)], "n long")
    write = t.write

    def meanwhile(*a, **b):
        extend_key_map(VersionedTable(spark, t.path), spark.createDataFrame([(7,)], "n long"), ["n"], "sk")
        return write(*a, **b)

    monkeypatch.setattr(t, "write", meanwhile)
    with pytest.raises(ConcurrentCommit):
        extend_key_map(t, df, ["n"], "sk")
    assert rows_of(t.read()) == [(7, 1)]
