"""Tables by key: buckets of a key's hash, each a few units of immutable files, and a manifest that says which units make up the table.

A merge writes what it adds or changes as new units of the buckets it touches, leaves out the units whose rows it changed, and commits by one new manifest; all other files
stay as they are. Buckets of many units are written as one on the way. A job that is lost before the manifest is written leaves the table as it was, and its files are found
and removed later. A ``sequence`` makes a merge take effect once: a manifest keeps the highest one applied, and a merge that comes again with it changes nothing.

Every unit of some size has a filter of its keys, written with it. A batch asks the filters first, so a unit that holds none of its keys is not read; smaller units are read
as soon as that. The filters decide what is read; the join that follows is exact.

A table has one writer at a time (a run is scheduled once); a second one would fail when it writes the same manifest number. Keys may be null: null is a key like any other.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodtide.operators.dedup import earliest, latest
from moodtide.session import shared_dir

BUCKETS = 64
#: Bits of a filter for each key, and bits a key sets: about one absent key in a hundred passes.
FILTER_BITS = 10
PROBES = 7
#: Rows from which a unit has a filter; below, reading the unit costs no more than reading a filter.
LEAST_FILTERED = 1000
#: Keys of a part of a filter, about: parts are asked one by one, so neither a unit nor a batch is ever one row.
PART_KEYS = 1 << 14
#: Units of a bucket beyond which a merge that touches it writes it as one.
MOST_UNITS = 8


class Unit(NamedTuple):
    """A bucket's part of a folder: a line of a manifest."""

    bucket: int
    folder: str
    rows: int
    top: int | None


class Manifest(NamedTuple):
    units: list[Unit]
    sequence: int
    written_at: float


class KeyedTable:
    """Rows with at most one per key in ``buckets`` buckets; ``counter`` names a whole-number column whose largest value the manifest keeps for each unit."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS, counter: str | None = None, schema: str | None = None,
                 least_filtered: int = LEAST_FILTERED):
        self.spark, self.path, self.keys, self.buckets, self.counter, self.schema = spark, path.rstrip("/"), list(keys), buckets, counter, schema
        self.least_filtered = least_filtered
        self._notes: dict[int, Manifest] = {}  # complete manifests never change

    # -- folders ---------------------------------------------------------------------------------
    def _hadoop(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def _names(self, path: str) -> list[str]:
        system, folder = self._hadoop(path)
        return [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []

    def versions(self) -> list[int]:
        """Numbers of the manifests, in order."""
        return sorted(int(n.split("=")[1]) for n in self._names(f"{self.path}/manifests") if n.startswith("version="))

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifests/version={version}"

    def manifest(self, version: int | None = None) -> Manifest:
        """The units of a version, the newest by default, the highest sequence applied, and when it was written."""
        version = version or self.version()
        if not version:
            return Manifest([], -1, 0.0)
        if version not in self._notes:
            said = self._read_note(self._manifest_path(version))
            self._notes[version] = Manifest([Unit(*u) for u in said["units"]], said["sequence"], said["written_at"])
        return self._notes[version]

    def _read_note(self, path: str) -> dict:
        system, place = self._hadoop(path)
        stream = system.open(place)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write_note(self, folder: str, name: str, said: dict) -> bool:
        """Beside its place first, then moved there: it is there whole or not at all. False if the name is taken."""
        system, beside = self._hadoop(f"{folder}/writing-{uuid.uuid4().hex}")
        stream = system.create(beside, True)
        try:
            stream.write(bytearray(json.dumps(said), "utf-8"))
        finally:
            stream.close()
        return name not in self._names(folder) and system.rename(beside, self._hadoop(f"{folder}/{name}")[1])

    def _write_manifest(self, version: int, manifest: Manifest) -> None:
        if not self._write_note(f"{self.path}/manifests", f"version={version}", manifest._asdict()):
            raise RuntimeError(f"{self.path}: version {version} was written by another job")

    def exists(self) -> bool:
        return bool(self.versions())

    def create(self) -> None:
        """An empty table, if there is none; it needs a schema."""
        if not self.exists():
            self._write_manifest(1, Manifest([], -1, time.time()))

    # -- reading ---------------------------------------------------------------------------------
    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _units(self) -> list[Unit]:
        return self.manifest().units

    def read(self, units: Iterable | None = None, version: int | None = None) -> DataFrame:
        """The rows of all units, or of those with the given (bucket, folder)."""
        wanted = None if units is None else set(units)
        paths = [f"{self.path}/data/{r.folder}/bucket={r.bucket}" for r in self.manifest(version).units if wanted is None or (r.bucket, r.folder) in wanted]
        return self.spark.read.schema(self._schema()).parquet(*paths) if paths else self._none()

    def _none(self) -> DataFrame:
        """No rows, in a way that joins with them are planned away."""
        schema = self._schema()
        fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
        return self.spark.range(1).where("false").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])

    def _schema(self):
        """The columns the table was declared with, or else those of its files."""
        if self.schema is None:
            rows = self._units()
            if not rows:
                raise ValueError(f"{self.path}: a table without rows needs a schema")
            self.schema = self.spark.read.parquet(f"{self.path}/data/{rows[0].folder}/bucket={rows[0].bucket}").schema
        return self.schema

    def top(self) -> int:
        """The largest value of the counter column, from the manifest alone; 0 without rows."""
        return max((r.top for r in self._units() if r.top is not None), default=0)

    def sequence(self) -> int:
        return self.manifest().sequence

    def is_applied(self, sequence: int | None) -> bool:
        return sequence is not None and sequence <= self.sequence()

    # -- filters ---------------------------------------------------------------------------------
    @staticmethod
    def _probes(key: Sequence[Column], words: Column) -> list[Column]:
        """Places of a key in a filter of ``words`` 64-bit words."""
        size = words.cast("bigint") * 64
        one, two = F.pmod(F.xxhash64(F.lit(1), *key), size), F.pmod(F.xxhash64(F.lit(2), *key).bitwiseOR(F.lit(1).cast("bigint")), size)
        return [F.pmod(one + F.lit(i).cast("bigint") * two, size) for i in range(PROBES)]

    @staticmethod
    def _bit(at: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))

    @staticmethod
    def _parts(keys: int) -> int:
        """A power of two: the parts of so many keys."""
        return 1 << max(0, -(-keys // PART_KEYS) - 1).bit_length()

    @staticmethod
    def _part(key: Sequence[Column], parts: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(3), *key), parts.cast("bigint")).cast("int")

    def _write_filters(self, rows: DataFrame, folder: str, counts: dict[int, int]) -> None:
        """``bucket, part, parts, bits`` for the buckets of one folder, built by a grouped OR: a row a key is shuffled, and a part of a filter is one row."""
        parts = {b: self._parts(n) for b, n in counts.items()}
        sized = self.spark.createDataFrame([(b, parts[b], -(-n * FILTER_BITS // 64 // parts[b])) for b, n in counts.items()], "bucket int, parts int, words bigint")
        keyed = rows.select("bucket", *self.keys).join(F.broadcast(sized), "bucket")  # a row for each bucket
        key = [F.col(c) for c in self.keys]
        set_ = F.transform(F.array(*self._probes(key, F.col("words"))), lambda at: F.named_struct(F.lit("word"), F.floor(at / 64), F.lit("bits"), self._bit(at)))
        all_ = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("words") - 1), lambda w: F.named_struct(F.lit("word"), w, F.lit("bits"), F.lit(0).cast("bigint")))
        every = sized.select("bucket", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), all_.alias("x"))
        place = keyed.select("bucket", "parts", self._part(key, F.col("parts")).alias("part"), set_.alias("x")).unionByName(every).repartition("bucket", "parts", "part")
        words = place.select("bucket", "parts", "part", F.inline("x")).groupBy("bucket", "parts", "part", "word").agg(F.bit_or("bits").alias("bits"))
        words.groupBy("bucket", "parts", "part").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w")).select(
            "bucket", "part", "parts", F.transform("w", lambda w: w["bits"]).alias("bits")).write.mode("overwrite").parquet(f"{self.path}/filters/folder={folder}")

    def _is_filtered(self, unit: Unit) -> bool:
        return unit.rows >= self.least_filtered

    def possible(self, keys: DataFrame, most: int = 0) -> DataFrame:
        """``bucket, folder`` and the keys in ``keys`` that this unit's filter does not rule out, for units with a filter.

        The keys of a bucket, ``most`` of them at most if that is known, are dealt into slots, as many as the largest filter has parts or the keys fill; a slot meets its part
        of each filter as one row.
        """
        mine, units = keys.select(*self.keys).distinct(), [u for u in self._units() if self._is_filtered(u)]
        if not units:
            return mine.select(F.lit(0).alias("bucket"), F.lit("").alias("folder"), *self.keys).limit(0)
        held = self.spark.createDataFrame([(u.bucket, u.folder) for u in units], "bucket int, folder string")
        slots = max(self._parts(most), *[self._parts(u.rows) for u in units])
        filters = self.spark.read.schema("bucket int, part int, parts int, bits array<bigint>, folder string").option("basePath", f"{self.path}/filters").parquet(
            *sorted({f"{self.path}/filters/folder={u.folder}" for u in units})).join(F.broadcast(held), ["bucket", "folder"], "left_semi")  # a row for each unit
        part, parts = F.coalesce("part", F.lit(0)), F.coalesce("parts", F.lit(1))
        filters = filters.select("bucket", "folder", "bits", F.explode(F.sequence(part, F.lit(slots - 1), parts)).alias("slot"))
        slot = self._part([F.col(c) for c in self.keys], F.lit(slots)).alias("slot")
        groups = mine.select("*", self.bucket_of().alias("bucket"), slot).groupBy("bucket", "slot").agg(F.collect_list(F.struct(*self.keys)).alias("mine"))

        def passes(key: Column) -> Column:
            out = F.lit(True)
            for at in self._probes([key[c] for c in self.keys], F.size("bits")):
                out = out & (F.get("bits", F.floor(at / 64).cast("int")).bitwiseAND(self._bit(at)) != 0)
            return out

        return groups.join(filters, ["bucket", "slot"]).select("bucket", "folder", F.inline(F.filter("mine", passes)))

    def may_hold(self, keys: DataFrame) -> list[tuple[int, str]]:
        """Units that may hold a key of ``keys``: some lines of the manifest."""
        units = self._units()
        if not units:
            return []
        asked = {r[0]: r[1] for r in keys.groupBy(self.bucket_of().alias("bucket")).count().collect()}  # at most ``buckets`` numbers
        found = {(u.bucket, u.folder) for u in units if u.bucket in asked and not self._is_filtered(u)}
        if any(u.bucket in asked and self._is_filtered(u) for u in units):
            found |= {tuple(r) for r in self.possible(keys, max(asked.values())).select("bucket", "folder").distinct().collect()}
        return sorted(found)

    def known(self, keys: DataFrame) -> DataFrame:
        """Stored rows of the keys in ``keys``: only units that may hold one are read."""
        return self.read(self.may_hold(keys)).join(keys.select(*self._aside()).distinct(), self._same(), "left_semi")

    def _same(self) -> Column:
        out = F.lit(True)
        for c in self.keys:
            out = out & F.col(c).eqNullSafe(F.col(f"_{c}"))
        return out

    def absent(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is not stored."""
        held = self.known(rows).select(*self._aside())
        return rows.join(held, self._same(), "left_anti")

    # -- writing ---------------------------------------------------------------------------------
    def _commit(self, rows: DataFrame, replaced: Iterable[tuple[int, str]], touched: Iterable[int], sequence: int | None) -> None:
        """Add ``rows``, which lie in the touched buckets, as new units; the replaced ones go, whose other rows are among ``rows``."""
        replaced, folder, old = set(replaced), uuid.uuid4().hex, self._units()
        version = self.version() + 1
        sequence = max(self.sequence(), -1 if sequence is None else sequence)
        if not set(touched) and not replaced:
            return self._write_manifest(version, Manifest(old, sequence, time.time()))
        many = [b for b, n in Counter(r.bucket for r in old).items() if n >= MOST_UNITS and b in set(touched)]
        more = {(r.bucket, r.folder) for r in old if r.bucket in many} - replaced
        data = f"{self.path}/data/{folder}"
        whole = (rows.unionByName(self.read(more)) if more else rows).withColumn("bucket", self.bucket_of())
        whole.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(data)
        found: list = []
        if any(n.startswith("bucket=") for n in self._names(data)):
            written = self.spark.read.schema(whole.schema).parquet(data)
            largest = F.max(self.counter).cast("bigint") if self.counter else F.lit(None).cast("bigint")
            found = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), largest.alias("top")).collect()  # a row for each bucket
            if large := {r.bucket: r.rows for r in found if r.rows >= self.least_filtered}:
                self._write_filters(written, folder, large)
        kept = [u for u in old if (u.bucket, u.folder) not in replaced | more]
        self._write_manifest(version, Manifest(kept + [Unit(r.bucket, folder, r.rows, r.top) for r in found], sequence, time.time()))

    def _settled(self, rows: DataFrame) -> DataFrame:
        """Rows of a batch, written down: they are read several times and must be the same each time."""
        folder = shared_dir(self.spark, "batch")
        rows.withColumn("bucket", self.bucket_of()).write.parquet(folder)
        return self.spark.read.parquet(folder)

    def insert_absent(self, updates: DataFrame, first_by: Sequence[str], sequence: int | None = None) -> DataFrame:
        """Add the rows of unknown keys, of several the first by ``first_by``; these rows are returned. No stored unit changes."""
        if self.schema is None and not self.exists():
            self.schema = updates.schema
        if self.is_applied(sequence):
            return updates.limit(0)
        fresh = self._settled(earliest(updates, self.keys, first_by).select(*updates.columns))  # the batch is computed once
        if self._units():
            fresh = self._settled(self.absent(fresh.drop("bucket")))
        self._add(fresh, [], sequence)
        return fresh.drop("bucket")

    def _add(self, fresh: DataFrame, replaced: list[tuple[int, str]], sequence: int | None) -> None:
        touched = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        if touched or replaced or sequence is not None or not self.exists():
            self._commit(fresh.drop("bucket"), replaced, touched, sequence)

    def upsert(self, updates: DataFrame, order: Sequence[str | Column], keep: Sequence[str] = (), sequence: int | None = None) -> None:
        """The latest update of a key replaces its row, but for the columns in ``keep``; a row that stays as it is touches no unit."""
        if self.schema is None and not self.exists():
            self.schema = updates.schema
        columns = updates.columns
        self.merge(latest(updates, self.keys, order).select(*columns), lambda both: both.select(
            *[F.when(F.col("_known"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) if c in keep else F.col(c) for c in columns]), sequence)

    def patch(self, fixes: DataFrame, fields: Sequence[str], sequence: int | None = None) -> None:
        """Set only the fields a fix has a value for; a fix of an unknown key does nothing."""
        columns = [f.name for f in self.read([]).schema]
        self.merge(fixes.select(*self.keys, *fields), lambda both: both.where("_known").select(
            *[F.coalesce(F.col(c), F.col(f"_old_{c}")).alias(c) if c in fields else F.col(c) if c in self.keys else F.col(f"_old_{c}").alias(c) for c in columns]), sequence)

    def delete(self, keys: DataFrame, sequence: int | None = None) -> None:
        columns = [f.name for f in self.read([]).schema]
        self.merge(keys.select(*self.keys).distinct(), lambda both: both.where("false").select(
            *[F.col(c) if c in self.keys else F.col(f"_old_{c}").alias(c) for c in columns]), sequence)

    def merge(self, updates: DataFrame, made: Callable[[DataFrame], DataFrame], sequence: int | None = None) -> None:
        """``updates`` hold a row for each key. ``made`` gets them with ``_known`` and the stored columns as ``_old_...`` and gives the rows that take their keys' place.

        Units that hold a changed row are written again without it; rows that come out as they were are no change.
        """
        if self.is_applied(sequence):
            return
        mine = self._settled(updates)
        if mine.isEmpty():
            return self._add(mine, [], sequence)
        held = self.may_hold(mine)
        if not held:
            columns = [f.name for f in self.read([]).schema]
            fresh = mine.drop("bucket").select("*", F.lit(False).alias("_known"), *[F.lit(None).cast(f.dataType).alias(f"_old_{f.name}") for f in self.read([]).schema if f.name not in self.keys])
            return self._add(self._settled(made(fresh).select(*columns)), [], sequence)
        unit = F.regexp_extract(F.col("_metadata.file_path"), "/data/([^/]+)/bucket=", 1).alias("_unit")
        stored = self.read(held).select("*", unit)
        columns = [c for c in stored.columns if c != "_unit"]
        stored = stored.join(mine.select(*self._aside()), self._same(), "left_semi")
        old = stored.select(*[F.col(c).alias(f"_{c}" if c in self.keys else f"_old_{c}") for c in columns], F.lit(True).alias("_found"))
        both = mine.drop("bucket").join(old, self._same(), "left").withColumn("_known", F.coalesce("_found", F.lit(False))).drop("_found", *[f"_{c}" for c in self.keys])
        mark = F.xxhash64(*[F.col(c) for c in columns]).alias("_mark")
        before = stored.select(*self._aside(), "_unit", mark.alias("_before"))
        after = made(both).select(*columns, mark, F.lit(True).alias("_new"))
        # rows that appear, go or get other values, written down once
        differ = self._settled(after.join(before, self._same(), "full").where(~F.col("_mark").eqNullSafe(F.col("_before"))).withColumns(
            {c: F.when(F.col("_new"), F.col(c)).otherwise(F.col(f"_{c}")) for c in self.keys}))
        replaced = sorted({(r[0], r[1]) for r in differ.where("_unit IS NOT NULL").select("bucket", "_unit").distinct().collect()})  # some lines of the manifest
        come = differ.where("_new").select(*columns, "bucket")
        if replaced:
            left = differ.where("_unit IS NOT NULL").select(*self._aside())
            come = come.unionByName(self.read(replaced).join(left, self._same(), "left_anti").withColumn("bucket", self.bucket_of()))
        self._add(come, replaced, sequence)

    def _aside(self) -> list[Column]:
        return [F.col(c).alias(f"_{c}") for c in self.keys]

    def sync(self, rows: DataFrame) -> None:
        """Make the table hold ``rows``, one for each key, and nothing else; what is there already touches no unit."""
        if self.schema is None and not self.exists():
            self.schema = rows.schema
        if self.exists():
            here = rows.select(*self._aside())
            self.delete(self.read().select(*self.keys).join(here, self._same(), "left_anti"))
        self.upsert(rows, [F.lit(1)])

    # -- changes between versions ----------------------------------------------------------------
    def version(self) -> int:
        return max(self.versions(), default=0)

    def changes(self, since: int) -> tuple[DataFrame, DataFrame]:
        """Rows that may have come or changed after version ``since``, and the keys that went: read from the units only one of both versions has.

        Rows that a merge only carried over may be among the first. ``since`` 0, or a version that was removed, gives all rows and no key.
        """
        if since not in self.versions():
            return self.read(), self.read([]).select(*self.keys)
        old, new = ({(r.bucket, r.folder) for r in self.manifest(v).units} for v in (since, self.version()))
        come = self.read(new - old)
        gone = self.read(old - new, since).select(*self.keys)
        return come, gone.join(come.select(*self._aside()), self._same(), "left_anti")

    # -- snapshots -------------------------------------------------------------------------------
    def snapshot(self, folder: str, stamp: str) -> int:
        """Save the table as of now below ``folder``: units it does not hold yet are copied, in one job, and a note of the stamp lists all. The number of copied units."""
        folder = folder.rstrip("/")
        if f"snapshot={stamp}" in self._names(folder):
            raise ValueError(f"{folder}: there is a snapshot {stamp} already")
        home = {(b, f): at for name in self._names(folder) if name.startswith("snapshot=") for b, f, at in self._read_note(f"{folder}/{name}")["units"]}
        missing = sorted({(u.bucket, u.folder) for u in self._units()} - set(home))
        if missing:
            place = F.col("_metadata.file_path")
            rows = self.read(missing).select("*", F.regexp_extract(place, "/data/([^/]+)/bucket=", 1).alias("unit_folder"), F.regexp_extract(place, "/bucket=([0-9]+)/", 1).alias("unit_bucket"))
            rows.write.mode("overwrite").partitionBy("unit_folder", "unit_bucket").parquet(f"{folder}/units={stamp}")
        home |= {unit: stamp for unit in missing}
        self._write_note(folder, f"snapshot={stamp}", {"units": [(u.bucket, u.folder, home[u.bucket, u.folder]) for u in self._units()]})
        return len(missing)

    def restored(self, folder: str, stamp: str) -> DataFrame:
        """The table as of a snapshot."""
        folder = folder.rstrip("/")
        paths = [f"{folder}/units={at}/unit_folder={f}/unit_bucket={b}" for b, f, at in self._read_note(f"{folder}/snapshot={stamp}")["units"]]
        return self.spark.read.schema(self._schema()).parquet(*paths) if paths else self.spark.createDataFrame([], self._schema())

    # -- old files -------------------------------------------------------------------------------
    def _delete(self, path: str) -> None:
        system, folder = self._hadoop(path)
        system.delete(folder, True)

    def vacuum(self, grace_seconds: float) -> int:
        """Remove manifests that were replaced longer than the grace period ago, and folders no other manifest names; their number is returned.

        Folders without a manifest are of lost jobs, or of one that is writing: they go when they are older than the grace period.
        """
        versions, now = self.versions(), time.time()
        old = [v for v, following in zip(versions, versions[1:]) if self.manifest(following).written_at <= now - grace_seconds]
        kept = {(u.folder, u.bucket) for v in versions if v not in old for u in self.manifest(v).units}
        removed = 0
        for v in old:
            self._delete(self._manifest_path(v))
            self._notes.pop(v, None)
        for folder in self._names(f"{self.path}/data"):
            system, path = self._hadoop(f"{self.path}/data/{folder}")
            if system.getFileStatus(path).getModificationTime() / 1e3 > now - grace_seconds:
                continue
            used = {b for f, b in kept if f == folder}
            for name in self._names(f"{self.path}/data/{folder}"):
                if name.startswith("bucket=") and int(name.split("=")[1]) not in used:
                    self._delete(f"{self.path}/data/{folder}/{name}")
                    removed += 1
            if not used:
                self._delete(f"{self.path}/data/{folder}")
                self._delete(f"{self.path}/filters/folder={folder}")
        return removed
