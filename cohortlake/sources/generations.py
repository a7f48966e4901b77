"""Tables on plain files that change as a whole, day by day: a generation lists folders, one pointer names the generation.

    root/<table>/gen=<id>/<day column>=<day>/...   days that generation <id> wrote
    root/manifests/<id>                            for every table its schema, its day column, and who wrote each of its days
    root/CURRENT                                   the id that readers resolve, once for each read

A change writes only the days that it replaces; the new manifest takes all other days over by name. To go
back to an older version of some days, or to let days expire, is a new manifest and nothing else. Readers
see the old generation or the new one, never a mixture: the pointer is swapped by one rename after
everything is in place. A run that dies before leaves folders that nothing names; run again under the
same id it writes them anew. One writer at a time: a change is refused if another came between.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Fixed value: how Spark names the folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Table:
    """One table of a generation: `days` tells for each day which generation wrote it. A table without a day column has the one day ''."""

    schema: str
    day: str | None
    days: dict[str, str] = field(default_factory=dict)


class Generations:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # files

    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read(self, path: str) -> str | None:
        p, fs = self._hadoop(path)
        if not fs.exists(p):
            return None
        return self.spark.read.text(path, wholetext=True).first()[0]

    def _write(self, path: str, text: str) -> None:
        """Put a small file in place by one rename, over an older one if there is one."""
        jvm = self.spark._jvm
        head, _, name = path.rpartition("/")
        fresh, fs = self._hadoop(f"{head}/.{name}.new")
        out = fs.create(fresh, True)
        out.write(bytearray(text.encode()))
        out.close()
        target, _ = self._hadoop(path)
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(fresh), fs.makeQualified(target), options)

    def _folders(self, path: str) -> list[str]:
        p, fs = self._hadoop(path)
        return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []

    def _drop(self, path: str) -> None:
        p, fs = self._hadoop(path)
        fs.delete(p, True)

    # reading

    def current(self) -> str | None:
        text = self._read(f"{self.root}/CURRENT")
        return text.strip() if text else None

    def manifest(self, generation: str | None = None) -> dict[str, Table]:
        generation = generation or self.current()
        text = self._read(f"{self.root}/manifests/{generation}") if generation else None
        if text is None:
            raise ValueError(f"nothing is published in {self.root}" if generation is None else f"no generation {generation}")
        return {name: Table(**t) for name, t in json.loads(text).items()}

    def read(self, table: str, generation: str | None = None) -> DataFrame:
        """A table as a generation has it. Filters on the day column decide which folders are opened."""
        t = self.manifest(generation)[table]
        schema = StructType.fromJson(json.loads(t.schema))
        base = f"{self.root}/{table}"
        if not t.days:
            return self.spark.createDataFrame([], schema)
        if t.day is None:
            return self.spark.read.schema(schema).parquet(f"{base}/gen={t.days['']}")
        paths = [f"{base}/gen={g}/{t.day}={d}" for d, g in sorted(t.days.items())]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(schema.names)

    # changing

    def _put(self, table: str, df: DataFrame, day: str | None, generation: str) -> list[str]:
        """Write the days of `df`; their names. What an earlier attempt of this generation left goes first."""
        path = f"{self.root}/{table}/gen={generation}"
        if day is None:
            df.write.mode("overwrite").parquet(path)
            return [""]
        # One task or a few for each day, by size: no day becomes a file for every task, and no day is too much for one.
        df.hint("rebalance", day).write.mode("overwrite").partitionBy(day).parquet(path)
        return [name.partition("=")[2] for name in self._folders(path)]

    def _publish(self, tables: dict[str, Table], generation: str, base: str | None) -> None:
        if self.current() != base:
            raise RuntimeError(f"another generation was published while {generation} was made")
        self._write(f"{self.root}/manifests/{generation}", json.dumps({n: asdict(t) for n, t in tables.items()}, sort_keys=True))
        self._write(f"{self.root}/CURRENT", f"{generation}\n")

    def point(self, generation: str) -> None:
        """Make an earlier generation the current one again."""
        self.manifest(generation)
        self._write(f"{self.root}/CURRENT", f"{generation}\n")

    def commit(self, tables: dict[str, DataFrame], generation: str, partition: dict[str, str] | None = None) -> None:
        """A generation of exactly these tables, all written."""
        base, out = self.current(), {}
        for name, df in tables.items():
            day = (partition or {}).get(name)
            out[name] = Table(json.dumps(df.schema.jsonValue()), day, dict.fromkeys(self._put(name, df, day, generation), generation))
        self._publish(out, generation, base)

    def replace_range(self, table: str, new: DataFrame, start: dt.date, end: dt.date, generation: str) -> list[str]:
        """The days from start to end hold the new rows and nothing else; other days are taken over as they lie.

        A day without new rows becomes empty. New rows of another day, or of none, are refused, and nothing
        changes then. Returns the days that were written.
        """
        base = self.current()
        tables = self.manifest(base)
        old = tables[table]
        names = StructType.fromJson(json.loads(old.schema)).names
        written = self._put(table, new.select(names), old.day, generation)
        stray = [d for d in written if d == NO_DAY or not str(start) <= d <= str(end)]
        if stray:
            self._drop(f"{self.root}/{table}/gen={generation}")
            raise ValueError(f"new rows lie outside the range of {old.day} that they replace: {', '.join(sorted(stray)[:3])}")
        kept = {d: g for d, g in old.days.items() if d == NO_DAY or not str(start) <= d <= str(end)}
        tables[table] = Table(old.schema, old.day, kept | dict.fromkeys(written, generation))
        self._publish(tables, generation, base)
        return written

    def restore_range(self, table: str, version: str, start: dt.date, end: dt.date, generation: str) -> list[str]:
        """The days from start to end as an older generation had them. No row is read or written. Returns the days whose folder changes."""
        base = self.current()
        tables = self.manifest(base)
        live, old = tables[table], self.manifest(version)[table]
        within = lambda days: {d: g for d, g in days.items() if d != NO_DAY and str(start) <= d <= str(end)}
        before, after = within(live.days), within(old.days)
        tables[table] = Table(live.schema, live.day, {d: g for d, g in live.days.items() if d not in before} | after)
        self._publish(tables, generation, base)
        return sorted(d for d in before | after if before.get(d) != after.get(d))

    def expire(self, table: str, first: dt.date, generation: str) -> list[str]:
        """Days before `first` go, as folders; no row is read, and `restore_range` brings them back while an older generation names them."""
        base = self.current()
        tables = self.manifest(base)
        t = tables[table]
        gone = sorted(d for d in t.days if d != NO_DAY and d < str(first))
        tables[table] = Table(t.schema, t.day, {d: g for d, g in t.days.items() if d not in gone})
        self._publish(tables, generation, base)
        return gone

    def quarantine(self, table: str, wrong: Column, generation: str, aside: str = "quarantine") -> dict[str, int]:
        """Rows of a predicate move to the table `<table>_<aside>`; only the days that have some are rewritten.

        Both tables change in one generation, and only if the rows set aside and those left add up to
        what the days had. Returns what was counted.
        """
        base = self.current()
        tables = self.manifest(base)
        t = tables[table]
        live, hit = self.read(table, base), F.coalesce(wrong, F.lit(False))
        day = F.col(t.day)
        # One row for each day that has wrong rows.
        found = {r.d: r for r in live.groupBy(day.cast("string").alias("d")).agg(F.count("*").alias("n"), F.count_if(hit).alias("bad")).where("bad > 0").collect()}
        if not found:
            self._publish(tables, generation, base)
            return {"days": 0, "set_aside": 0, "left": 0}
        days = [d for d in found if d is not None]
        affected = F.when(day.isNull(), F.lit(None in found)).otherwise(day.isin([dt.date.fromisoformat(d) for d in days]))
        name = f"{table}_{aside}"
        bad, good = self._put(name, live.where(affected & hit), t.day, generation), self._put(table, live.where(affected & ~hit), t.day, generation)
        count = lambda n: self.spark.read.parquet(f"{self.root}/{n}/gen={generation}").count() if self._folders(f"{self.root}/{n}/gen={generation}") else 0
        aside_n, left_n = count(name), count(table)
        want_aside, want_left = sum(r.bad for r in found.values()), sum(r.n - r.bad for r in found.values())
        if (aside_n, left_n) != (want_aside, want_left):
            raise RuntimeError(f"{want_aside} rows to set aside and {want_left} to leave, but {aside_n} and {left_n} arrived: nothing changes")
        gone = {d or NO_DAY for d in found}
        tables[table] = Table(t.schema, t.day, {d: g for d, g in t.days.items() if d not in gone} | dict.fromkeys(good, generation))
        tables[name] = Table(t.schema, t.day, dict.fromkeys(bad, generation))
        self._publish(tables, generation, base)
        return {"days": len(found), "set_aside": aside_n, "left": left_n}

    def inventory(self, generation: str | None = None) -> DataFrame:
        """One row for each day of each table: who wrote it. Read from the manifest alone."""
        rows = [(n, None if d in ("", NO_DAY) else d, g) for n, t in self.manifest(generation).items() for d, g in t.days.items()]
        return self.spark.createDataFrame(rows, "table_name string, day string, generation string")

    def vacuum(self, keep: list[str]) -> int:
        """Delete folders that none of these generations names; the number deleted. The current one is always kept."""
        kept = [self.manifest(g) for g in {*keep, self.current()}]
        used: dict[str, set[str]] = {}
        for m in kept:
            for name, t in m.items():
                used.setdefault(name, set()).update(f"{name}/gen={g}" + (f"/{t.day}={d}" if t.day else "") for d, g in t.days.items())
        gone = 0
        for name in self._folders(self.root):
            if name == "manifests":
                continue
            for g in self._folders(f"{self.root}/{name}"):
                own, named = f"{name}/{g}", used.get(name, set())
                if own in named:
                    continue
                days = [f"{own}/{d}" for d in self._folders(f"{self.root}/{own}")]
                dead = [d for d in days if d not in named] if named.intersection(days) else [own]
                for path in dead:
                    self._drop(f"{self.root}/{path}")
                gone += len(dead)
        return gone
