"""A stored fact table that changes month by month (B14, write path).

The table is a folder of months, each a folder of Parquet files, and a series of
versions, each a small list of the month folders that make up the table:

    <root>/data/<write>/year=2025/month=3/part-*.parquet
    <root>/versions/000000002/...json      (_SUCCESS marks a complete list)

A change set is applied by writing the months it touches to a folder of its own
and then adding a version that lists the new months beside the untouched old
ones.  Nothing that a version lists is ever written to, so readers keep a
consistent table; a job that fails before its version is complete leaves the
table as it was, and may simply be run again.  Two writers that start from the
same version cannot both succeed: the second finds the version taken.

The list of months is the only thing that the driver holds (a dozen a year).
Rows without a time form a month of their own.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.jobs import change_violations
from .io import bulk_load

VERSION = "year int, month int, path string, version long"
UNDATED = -1  # year and month of rows without a time


class Month(NamedTuple):
    year: int
    month: int
    path: str


def month_code(ts: str = "ts"):
    """One number for a row's month."""
    return F.coalesce(F.year(ts) * 100 + F.month(ts), F.lit(UNDATED))


class MonthTable:
    """A versioned table at ``root`` of rows with ``schema`` and natural key ``key``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: list[str], ts: str = "ts"):
        if ts not in key:
            raise ValueError(f"the key {key} must hold {ts}: the month of a changed row is read from it")
        self.spark, self.root, self.schema, self.key, self.ts = spark, root.rstrip("/"), schema, key, ts

    # -- versions -----------------------------------------------------------
    def _folders(self, path: str) -> list[str]:
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        base = f"{self.root}/versions"
        return [int(v) for v in self._folders(base) if v.isdigit() and "_SUCCESS" in self._folders(f"{base}/{v}")]

    def months(self, version: int | None = None) -> list[Month]:
        """The month folders of a version, the latest by default."""
        known = self.versions()
        if not known:
            return []
        version = known[-1] if version is None else version
        if version not in known:
            raise ValueError(f"no version {version}; there are {known}")
        rows = self.spark.read.schema(VERSION).json(f"{self.root}/versions/{version:09d}").filter("year is not null").collect()
        return sorted(Month(r.year, r.month, r.path) for r in rows)

    def _commit(self, months: list[Month], version: int) -> None:
        rows = [(*m, version) for m in months] or [(None, None, None, version)]
        listed = self.spark.createDataFrame(rows, VERSION).coalesce(1)
        listed.write.mode("errorifexists").json(f"{self.root}/versions/{version:09d}")

    # -- reading ------------------------------------------------------------
    def read(self, start=None, end=None, version: int | None = None) -> DataFrame:
        """Rows with start <= ts < end; only the folders of their months are opened."""
        code = lambda t: int(str(t)[:4]) * 100 + int(str(t)[5:7])
        low, high = code(start) if start is not None else None, code(end) if end is not None else None
        at = lambda m: m.year * 100 + m.month if m.year != UNDATED else UNDATED
        wanted = [m for m in self.months(version) if (low is None or at(m) >= low) and (high is None or UNDATED < at(m) <= high)]
        out = self.open(wanted)
        bound = lambda t: F.lit(t.isoformat(sep=" ") if isinstance(t, dt.datetime) else str(t)).cast(self.schema[self.ts].dataType)
        if start is not None:
            out = out.filter(F.col(self.ts) >= bound(start))
        if end is not None:
            out = out.filter(F.col(self.ts) < bound(end))
        return out

    def open(self, months: list[Month]) -> DataFrame:
        """The rows of some month folders."""
        if not months:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(m.path for m in months))

    # -- writing ------------------------------------------------------------
    def _write(self, rows: DataFrame) -> list[Month]:
        """Write rows to a folder of their own; its months."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        bulk_load(rows.select(*self.schema.names), path, "errorifexists", self.ts)
        out = []
        for y in (f for f in self._folders(path) if f.startswith("year=")):
            for m in (f for f in self._folders(f"{path}/{y}") if f.startswith("month=")):
                number = lambda f: int(v) if (v := f.split("=")[1]).isdigit() else UNDATED
                out.append(Month(number(y), number(m), f"{path}/{y}/{m}"))
        return out

    def create(self, rows: DataFrame) -> int:
        """The first version."""
        if self.versions():
            raise ValueError(f"{self.root} holds a table already")
        self._commit(self._write(rows), 1)
        return 1

    def apply(self, changes: DataFrame, op_col: str = "op", check: bool = True) -> int:
        """Apply a change set (the columns of the table and ``op`` in I, U, D;
        one row for each key) and return the new version.

        Only the months of the changed keys are read and written; the keys of a
        change set that cannot apply are an error, and nothing is written."""
        known = self.versions()
        if not known:
            raise ValueError(f"{self.root} holds no table")
        touched = {r[0] for r in changes.select(month_code(self.ts)).distinct().collect()}
        old = self.months(known[-1])
        at = lambda m: m.year * 100 + m.month if m.year != UNDATED else UNDATED
        base = self.open([m for m in old if at(m) in touched])
        if check and (bad := change_violations(base, changes, self.key, op_col).take(5)):
            raise ValueError(f"changes that cannot apply: {[tuple(r) for r in bad]}")
        fresh = changes.filter(F.col(op_col).isin("I", "U")).select(*self.schema.names)
        kept = base.join(changes.select(*self.key), self.key, "left_anti").select(*self.schema.names)
        written = self._write(kept.unionByName(fresh)) if touched else []
        self._commit([m for m in old if at(m) not in touched] + written, known[-1] + 1)
        return known[-1] + 1
