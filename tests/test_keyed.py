"""Keyed tables: merges by bucket, their files, filters, reruns and losses."""

import random

import pytest
from pyspark.sql import functions as F

from moodtide.operators import merge
from moodtide.sources import keyed
from moodtide.sources.keyed import KeyedTable

SCHEMA = "id long, v string, at long"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=8, counter="id", least_filtered=5)


def files(table):
    """Data files the newest manifest names."""
    return set(table.read().inputFiles())


def test_merges_equal_the_merges_of_whole_tables(spark, table):
    """Random batches of all kinds, each compared with the operator that makes a whole new table."""
    rng = random.Random(5)
    one = lambda n: frame(spark, [(rng.choice([None, *range(60)]), rng.choice("abc"), rng.randrange(100) * 100 + i) for i in range(n)])
    whole = frame(spark, [])
    for step in range(6):
        batch = one(rng.choice([0, 1, 7, 40]))
        kind = ("insert", "upsert", "keep", "patch", "delete")[step % 5]
        unique = merge.new_rows(frame(spark, []), batch, ["id"], ["at"])
        known = [r[0] for r in batch.select("id").distinct().collect()]
        if kind == "insert":
            fresh = {r[0] for r in rows(table.insert_absent(batch, ["at"]))}
            here = {r[0] for r in whole.collect()}
            assert fresh == set(known) - here
            first = {}
            for r in sorted(batch.collect(), key=lambda r: r.at):
                first.setdefault(r.id, tuple(r))
            whole = frame(spark, [tuple(r) for r in whole.collect()] + [r for i, r in first.items() if i not in here])
        elif kind in ("upsert", "keep"):
            keep = ["at"] if kind == "keep" else []
            table.upsert(batch, ["at"], keep)
            old, new = {r.id: tuple(r) for r in whole.collect()}, {}
            for r in sorted(batch.collect(), key=lambda r: r.at):
                new[r.id] = tuple(r)
            if keep:
                new = {i: (*r[:2], old[i][2]) if i in old else r for i, r in new.items()}
            whole = frame(spark, list((old | new).values()))
        elif kind == "patch":
            table.patch(unique.withColumn("v", F.when(F.col("at") % 200 == 0, "p")).select("id", "v"), ["v"])
            fixed = {r.id: "p" for r in unique.collect() if r.at % 200 == 0}
            whole = frame(spark, [(r.id, fixed.get(r.id, r.v), r.at) for r in whole.collect()])
        else:
            table.delete(batch)
            whole = frame(spark, [tuple(r) for r in whole.collect() if r.id not in known])
        assert rows(table.read()) == rows(whole)
        assert table.top() == max([r.id for r in whole.collect() if r.id is not None], default=0) or kind == "delete"


def test_a_batch_of_one_row_writes_one_unit(spark, table):
    table.insert_absent(frame(spark, [(i, "a", i) for i in range(500)]), ["at"])
    before = files(table)
    table.insert_absent(frame(spark, [(7, "known", 0), (500, "new", 0)]), ["at"])
    added = files(table) - before
    assert before <= files(table) and len(added) == 1 and spark.read.parquet(*added).count() == 1 and table.top() == 500
    before = files(table)
    table.upsert(frame(spark, [(3, "changed", 1), (4, "a", 4)]), ["at"])  # the second one is as it was
    assert len(before - files(table)) == len(files(table) - before) == 1
    version = table.versions()[-1]
    table.upsert(frame(spark, [(4, "a", 4)]), ["at"])
    table.insert_absent(frame(spark, [(4, "b", 4)]), ["at"])
    assert table.versions()[-1] == version  # nothing changed, nothing written


def test_filters_leave_out_units_without_the_keys(spark, table):
    for n in range(4):
        table.insert_absent(frame(spark, [(i, "a", i) for i in range(n * 100, n * 100 + 100)]), ["at"])
    units = table.manifest().units
    assert len(units) == 32
    batch = frame(spark, [(i, "x", 0) for i in (5, 205, *range(10_000, 10_040))])
    read = table.may_hold(batch)
    assert 2 <= len(read) <= 8  # of 32, for 42 keys of which two are there
    assert [r.id for r in table.absent(batch).orderBy("id").collect()] == list(range(10_000, 10_040))
    assert sorted(r.id for r in table.known(batch).collect()) == [5, 205]
    every = table.possible(table.read())
    assert every.select("id").distinct().count() == 400  # no key is ruled out by its own filter


def test_filters_are_asked_in_parts(spark, table, monkeypatch):
    """Units of one part and of several, asked by few and by many keys; a filter of before, without parts, is one part."""
    monkeypatch.setattr(keyed, "PART_KEYS", 8)
    for n in (40, 900):
        table.insert_absent(frame(spark, [(n * 1000 + i, "a", i) for i in range(n)]), ["at"])
    stored = spark.read.parquet(f"{table.path}/filters")
    assert stored.groupBy("folder", "bucket").count().agg(F.max("count")).first()[0] >= 8
    filtered = table.read([(u.bucket, u.folder) for u in table.manifest().units if u.rows >= 5])
    held = table.possible(table.read()).select("id")
    assert filtered.count() > 900 and filtered.select("id").exceptAll(held).isEmpty()  # no key is ruled out by its own filter
    absent = frame(spark, [(i, "x", 0) for i in range(3000)])
    assert table.possible(absent, 400).count() < 300 and table.absent(absent).count() == 3000
    for u in table.manifest().units:
        if u.rows >= 5:
            assert stored.where((F.col("folder") == u.folder) & (F.col("bucket") == u.bucket)).agg(F.max("parts")).first()[0] == table._parts(u.rows)


def test_an_inserted_batch_is_computed_once(spark, table):
    seen = spark.sparkContext.accumulator(0)
    mark = F.udf(lambda v: seen.add(1) or v, "string").asNondeterministic()
    for first in (0, 50):
        batch = frame(spark, [(first + i, "a", i) for i in range(100)]).withColumn("v", mark("v"))
        table.insert_absent(batch, ["at"])
    assert seen.value == 200
    assert table.read().count() == 150


def test_buckets_of_many_units_become_one(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=1)
    for i in range(12):
        table.insert_absent(frame(spark, [(i, "a", i)]), ["at"])
        assert len(table.manifest().units) <= keyed.MOST_UNITS
    assert rows(table.read()) == [(i, "a", i) for i in sorted(range(12), key=lambda i: str((i,)))]


def test_a_lost_merge_leaves_the_table_and_comes_again(spark, table, monkeypatch):
    table.insert_absent(frame(spark, [(i, "a", i) for i in range(50)]), ["at"], sequence=0)
    before, content = table.versions(), rows(table.read())
    clean = KeyedTable._write_filters

    def lost(self, *args):
        raise RuntimeError("lost")

    monkeypatch.setattr(KeyedTable, "_write_filters", lost)
    batch = frame(spark, [(1, "b", 99), (77, "b", 99)])
    with pytest.raises(RuntimeError):
        table.upsert(batch, ["at"], sequence=1)
    assert table.versions() == before and rows(table.read()) == content
    monkeypatch.setattr(KeyedTable, "_write_filters", clean)
    for _ in range(3):
        table.upsert(batch, ["at"], sequence=1)
    assert len(table.versions()) == len(before) + 1 and table.sequence() == 1
    assert {r.id: r.v for r in table.read().collect() if r.id in (1, 77)} == {1: "b", 77: "b"}
    table.upsert(frame(spark, [(1, "late", 999)]), ["at"], sequence=0)  # an older batch that comes again
    assert table.read().where("v = 'late'").isEmpty()
    folders = set(table._names(f"{table.path}/data"))
    assert table.vacuum(0) >= 1 and set(table._names(f"{table.path}/data")) < folders  # what the lost job wrote is gone
    assert table.read().count() == 51 and len(table.versions()) == 1


def test_a_manifest_that_was_not_finished_is_not_read(spark, table, monkeypatch):
    table.insert_absent(frame(spark, [(1, "a", 1)]), ["at"])

    def lost(self, *args):
        system, path = self._hadoop(f"{self.path}/manifests/writing-half")
        system.create(path, True).close()
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_write_manifest", lost)
        with pytest.raises(RuntimeError):
            table.insert_absent(frame(spark, [(2, "b", 1)]), ["at"])
    assert rows(table.read()) == [(1, "a", 1)]
    table.insert_absent(frame(spark, [(2, "a", 1)]), ["at"])
    assert rows(table.read()) == [(1, "a", 1), (2, "a", 1)] and table.versions() == [1, 2]


def test_a_second_writer_fails(spark, table):
    table.insert_absent(frame(spark, [(1, "a", 1)]), ["at"])
    with pytest.raises(RuntimeError, match="another job"):
        table._write_manifest(1, table.manifest())


def test_old_files_stay_for_the_grace_period(spark, table):
    table.insert_absent(frame(spark, [(i, "a", i) for i in range(40)]), ["at"])
    old = rows(table.read())
    table.upsert(frame(spark, [(i, "b", i) for i in range(40)]), ["at"])
    assert table.vacuum(3600) == 0 and rows(table.read(version=1)) == old
    assert table.vacuum(0) > 0 and table.versions() == [2] and {r.v for r in table.read().collect()} == {"b"}


def test_empty_tables_and_batches(spark, table):
    with pytest.raises(ValueError):
        table.read()
    table.upsert(frame(spark, []), ["at"])
    assert table.exists() and table.read().count() == 0 and table.top() == 0
    table.delete(frame(spark, [(1, "a", 1)]))
    table.insert_absent(frame(spark, [(None, "a", 1), (None, "b", 0)]), ["at"])
    assert rows(table.read()) == [(None, "b", 0)] and table.absent(frame(spark, [(None, "c", 1)])).isEmpty()
