"""S3/I1 as merge-on-read, D6 with one commit for all tables.

A table is a list of runs, Parquet folders that are never changed; every load
adds one run with the new and changed rows.  Beside its rows a run stores which keys it
holds, as bitmaps of 32,768 consecutive keys.  Reading takes each run's rows
whose key no newer run holds: the newer runs' bitmaps are or-ed by bucket and
joined, so a large base is scanned once, not shuffled, while the bitmaps fit a
broadcast (their number is in the commit; beyond the bound the join shuffles).

A commit is a small file that lists the runs of all tables.  It appears by a
rename that fails if the name exists, so of two writers one wins; the other
tries again on top unless both wrote the same table.  Readers resolve one
commit, so they see either all tables of a load or none of them, and a
failed load leaves nothing but folders that no commit names.

``compact`` merges neighbouring runs of one size tier, so the runs of a table
stay logarithmic in its loads.

Keys are one integer column per table, unique within a load (checked).
"""

from __future__ import annotations

import datetime as dt
import json
import math
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

from sparkmart.schemas import WAREHOUSE_SPECS, TableSpec
from sparkmart.session import CODEC, shuffles_dropped
from sparkmart.sources.incremental import EPOCH, UNKNOWN_KEY, read_since
from sparkmart.sources.sinks import _file_system

#: Bytes of a key bitmap with its bucket number; broadcast bound of the bitmaps of a read.
BITMAP_BYTES = 4096 + 64
MASK_BYTES = 64 * 1024 * 1024
#: Rows of a run of the lowest tier; runs of a tier that are merged.
TIER_ROWS = 100_000
FAN = 4


class CommitConflict(RuntimeError):
    """Another writer has committed the same table meanwhile."""


@dataclass(frozen=True)
class Run:
    """A stored set of rows; ``first`` and ``last``: the loads it holds."""

    name: str
    rows: int
    buckets: int
    first: int
    last: int
    watermark: str | None


@dataclass
class Commit:
    """``writers``: per named writer the commit it started from and its last numbered load."""

    number: int = 0
    tables: dict[str, list[Run]] = field(default_factory=dict)
    writers: dict[str, tuple[int, int]] = field(default_factory=dict)


def _bit(bitmap: str, position: str):
    """Whether the bit at ``position`` is set; null without a bitmap."""
    byte = f"conv(hex(substring({bitmap}, cast({position} div 8 as int) + 1, 1)), 16, 10)"
    return F.expr(f"(cast({byte} as int) & shiftleft(1, cast({position} % 8 as int))) <> 0")


def key_bitmaps(rows: DataFrame, key: str) -> DataFrame:
    """(bucket, bitmap) of the keys of ``rows``."""
    at = rows.selectExpr(f"bitmap_bucket_number({key}) as bucket", f"bitmap_bit_position({key}) as position")
    return at.groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bitmap"))


def tier(rows: int, fan: int = FAN, unit: int = TIER_ROWS) -> int:
    return max(0, math.floor(math.log(max(rows, 1) / unit, fan)) + 1) if rows > unit else 0


class DeltaLog:
    """Merge-on-read tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str, specs: Sequence[TableSpec] = WAREHOUSE_SPECS):
        self.spark, self.root = spark, root.rstrip("/")
        self.specs = {s.name: s for s in specs}

    # --- commits -----------------------------------------------------------
    def _place(self, number: int) -> str:
        return f"{self.root}/_commits/{number:020d}.json"

    def numbers(self) -> list[int]:
        fs, place = _file_system(self.spark, f"{self.root}/_commits")
        if not fs.exists(place):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def commit(self, number: int | None = None) -> Commit:
        """The newest commit, or an earlier one; an empty one before the first load."""
        if number is None:
            known = self.numbers()
            if not known:
                return Commit()
            number = known[-1]
        text = self.spark.read.text(self._place(number), wholetext=True).first()[0]
        content = json.loads(text)
        tables = {t: [Run(**r) for r in runs] for t, runs in content["tables"].items()}
        return Commit(number, tables, {w: tuple(at) for w, at in content["writers"].items()})

    def first_seen(self, writer: str) -> int:
        """The commit that ``writer`` started from; the newest one's number if it has not written yet, 0 without any."""
        head = self.commit()
        return head.writers[writer][0] if writer in head.writers else head.number

    def last_load(self, writer: str) -> int:
        """Number of the last load that ``writer`` committed, -1 before the first."""
        return self.commit().writers.get(writer, (0, -1))[1]

    def _publish(self, commit: Commit) -> bool:
        """Make ``commit`` visible; False if its number is taken."""
        jvm, final = self.spark._jvm, self._place(commit.number)
        tables = {t: [asdict(r) for r in runs] for t, runs in commit.tables.items()}
        text = json.dumps({"tables": tables, "writers": commit.writers})
        fs, place = _file_system(self.spark, f"{self.root}/_commits/_{uuid.uuid4().hex}")
        out = fs.create(place, False)
        out.write(bytearray(text.encode()))
        out.close()
        target = jvm.org.apache.hadoop.fs.Path(final)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(place), fs.makeQualified(target), none)
        except (Py4JJavaError, PySparkException) as error:
            fs.delete(place, False)
            if fs.exists(target):
                return False
            raise error
        return True

    def _commit_changes(self, based_on: Commit, changes: Mapping[str, tuple[list[str], list[Run]]], writer: tuple[str, int] | None = None) -> Commit:
        """Replace runs (by name) and add runs per table on top of the newest commit."""
        while True:
            head = self.commit()
            tables, writers = dict(head.tables), dict(head.writers)
            if writer is not None:
                writers[writer[0]] = (writers[writer[0]][0] if writer[0] in writers else based_on.number, writer[1])
            for name, (gone, added) in changes.items():
                if head.tables.get(name, []) != based_on.tables.get(name, []):
                    raise CommitConflict(name)
                kept = [r for r in tables.get(name, []) if r.name not in gone]
                tables[name] = sorted(kept + added, key=lambda r: r.first)
            new = Commit(head.number + 1, tables, writers)
            if self._publish(new):
                return new

    # --- runs --------------------------------------------------------------
    def _write(self, name: str, rows: DataFrame, first: int, last: int) -> Run | None:
        """Store ``rows`` as a run that no commit names yet; None without rows."""
        spec = self.specs[name]
        run = uuid.uuid4().hex
        path = f"{self.root}/{name}/run={run}"
        with shuffles_dropped(rows.sparkSession):
            rows.write.option("compression", CODEC).parquet(path)
        stored = self.spark.read.schema(rows.schema).parquet(path)
        key = spec.key[0]
        real = F.lit(True) if spec.unknown_key is None else F.col(key) != UNKNOWN_KEY
        facts = stored.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("keyed"), F.max(F.when(real, F.col(spec.ts_col))).alias("wm")).first()
        if not facts["n"]:
            return None
        keys = f"{self.root}/{name}/keys={run}"
        with shuffles_dropped(self.spark):
            key_bitmaps(stored, key).write.option("compression", CODEC).parquet(keys)
        # Every key is one bit: with fewer bits than keys, or two nulls, some key repeats (no shuffle of the keys).
        held = self._bitmaps(name, [run]).agg(F.count(F.lit(1)).alias("buckets"), F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("bits")).first()
        if held["bits"] != facts["keyed"] or facts["n"] - facts["keyed"] > 1:
            raise ValueError(f"duplicate key {list(spec.key)} in load of {name}")
        return Run(run, facts["n"], held["buckets"], first, last, facts["wm"].isoformat() if facts["wm"] else None)

    def append(self, loads: Mapping[str, DataFrame], writer: tuple[str, int] | None = None) -> Commit:
        """S3: one commit with a run per table that has rows; nothing is visible if any write fails.

        ``writer``: (name, number) of a load that may be tried again; a number
        up to the writer's last committed one adds nothing.
        """
        base, changes = self.commit(), {}
        if writer is not None and self.last_load(writer[0]) >= writer[1]:
            return base
        for name, rows in loads.items():
            spec = self.specs[name]
            last = max((r.last for r in base.tables.get(name, [])), default=0) + 1
            run = self._write(name, rows.select(*[f.name for f in spec.schema.fields]), last, last)
            if run is not None:
                changes[name] = ([], [run])
        return self._commit_changes(base, changes, writer) if changes or writer else base

    # --- reading -----------------------------------------------------------
    def _bitmaps(self, name: str, runs: Sequence[str]) -> DataFrame:
        """Stored (bucket, bitmap) of the keys of each of ``runs``."""
        return self.spark.read.schema("bucket long, bitmap binary").parquet(*[f"{self.root}/{name}/keys={r}" for r in runs])

    def held_keys(self, name: str, runs: Sequence[str], more: DataFrame | None = None) -> DataFrame:
        """(bucket, bitmap) of all keys of ``runs`` and of the bitmaps ``more``."""
        parts = ([self._bitmaps(name, runs)] if runs else []) + ([more] if more is not None else [])
        if not parts:
            return self.spark.createDataFrame([], "bucket long, bitmap binary")
        return reduce(DataFrame.unionByName, parts).groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))

    def _merged(self, name: str, runs: Sequence[Run]) -> DataFrame:
        spec = self.specs[name]
        key, newer, parts = spec.key[0], [], []
        for run in sorted(runs, key=lambda r: -r.last):
            rows = self.spark.read.schema(spec.schema).parquet(f"{self.root}/{name}/run={run.name}")
            if newer:
                masks = self._bitmaps(name, [r.name for r in newer])
                if len(newer) > 1:
                    masks = masks.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
                if sum(r.buckets for r in newer) * BITMAP_BYTES <= MASK_BYTES:
                    masks = F.broadcast(masks)
                rows = rows.withColumn("__bucket", F.expr(f"bitmap_bucket_number({key})"))
                rows = rows.join(masks, F.col("__bucket") == F.col("bucket"), "left")
                rows = rows.where(~F.coalesce(_bit("bitmap", f"bitmap_bit_position({key})"), F.lit(False)))
                rows = rows.select(*spec.schema.fieldNames())
            parts.append(rows)
            newer.append(run)
        if not parts:
            return self.spark.createDataFrame([], spec.schema)
        return reduce(DataFrame.unionByName, parts)

    def read(self, name: str, commit: Commit | None = None) -> DataFrame:
        """The table as of ``commit`` (default: the newest): each key's newest row."""
        commit = commit or self.commit()
        return self._merged(name, commit.tables.get(name, []))

    def masked_rows(self, name: str, keys_of: DataFrame, commit: Commit | None = None) -> DataFrame:
        """The table's rows whose key is in ``keys_of`` (the old image of a load)."""
        return self.rows_in(name, key_bitmaps(keys_of, self.specs[name].key[0]), commit)

    def rows_in(self, name: str, masks: DataFrame, commit: Commit | None = None) -> DataFrame:
        """The table's rows whose key is in the bitmaps ``masks``."""
        key = self.specs[name].key[0]
        if masks.count() * BITMAP_BYTES <= MASK_BYTES:
            masks = F.broadcast(masks)
        rows = self.read(name, commit)
        names = rows.columns
        rows = rows.withColumn("__bucket", F.expr(f"bitmap_bucket_number({key})")).join(masks, F.col("__bucket") == F.col("bucket"))
        return rows.where(_bit("bitmap", f"bitmap_bit_position({key})")).select(*names)

    def watermark(self, name: str, commit: Commit | None = None) -> dt.datetime:
        """A5 from the commit, without reading the table."""
        marks = [r.watermark for r in (commit or self.commit()).tables.get(name, []) if r.watermark]
        return max((dt.datetime.fromisoformat(m) for m in marks), default=EPOCH)

    # --- upkeep ------------------------------------------------------------
    def compact(self, name: str, fan: int = FAN, unit: int = TIER_ROWS) -> list[Run]:
        """Merge ``fan`` or more neighbouring runs of one tier until there are none; the table's rows stay the same."""
        while True:
            base = self.commit()
            runs = base.tables.get(name, [])
            groups: list[list[Run]] = []
            for run in runs:
                if groups and tier(groups[-1][-1].rows, fan, unit) == tier(run.rows, fan, unit):
                    groups[-1].append(run)
                else:
                    groups.append([run])
            due = next((g for g in reversed(groups) if len(g) >= fan), None)
            if due is None:
                return runs
            merged = self._write(name, self._merged(name, due), due[0].first, due[-1].last)
            # A watermark never falls, also where the row that set it was overwritten.
            marks = [r.watermark for r in due if r.watermark]
            merged = Run(**{**asdict(merged), "watermark": max(marks) if marks else None})
            self._commit_changes(base, {name: ([r.name for r in due], [merged])})

    def remove_unused(self, keep: Sequence[int]) -> int:
        """Delete runs that none of the commits ``keep`` names (no reader or writer may be active); how many."""
        used = {(t, r.name) for n in keep for t, runs in self.commit(n).tables.items() for r in runs}
        gone = 0
        for name in self.specs:
            fs, place = _file_system(self.spark, f"{self.root}/{name}")
            for status in fs.listStatus(place) if fs.exists(place) else ():
                run = status.getPath().getName().partition("=")[2]
                if run and (name, run) not in used:
                    gone += bool(fs.delete(status.getPath(), True))
        return gone

    # --- sync --------------------------------------------------------------
    def sync(self, sources: Mapping[str, DataFrame], inclusive: bool = False) -> tuple[Commit, list[tuple[str, dt.datetime, int]]]:
        """What is newer in each source, in one commit; (table, watermark before, rows) per table."""
        base = self.commit()
        marks = {name: self.watermark(name, base) for name in sources}
        loads = {
            name: read_since(df, self.specs[name].ts_col, marks[name], self.specs[name].schema.fieldNames(), inclusive)
            for name, df in sources.items()
        }
        commit = self.append(loads)
        before = {name: {r.name for r in base.tables.get(name, [])} for name in sources}
        counts = {name: sum(r.rows for r in commit.tables.get(name, []) if r.name not in before[name]) for name in sources}
        return commit, [(name, marks[name], counts[name]) for name in sources]
