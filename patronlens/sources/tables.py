"""Versioned Parquet tables on a shared folder.

A load writes each table to a folder of its own and then publishes all of them
with one small file that names the new folders. Readers follow the newest
publication, so they see either the whole load or none of it; an abandoned load
leaves folders that no publication names. One writer at a time.

A table may also be published in parts: run dates, each a folder of its own, or the files of a
keyed table (``keyed``). A load then writes the parts it changes and takes away those it
replaces; the others stay where they are, named by the publication that wrote them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronlens.sources import keyed
from patronlens.sources.keyed import Layout, StoredFile, ddl_of
from patronlens.workspace import child_names, content_length, delete_path, path_exists

PUBLICATION_DDL = (
    "publication long, table_name string, path string, ddl string, bucket int, bytes long, rows long, buckets int"
)

PART = "@"  # between the names of a table and of its part
LOG = "log:"  # before the name of a log in a publication


@dataclass(frozen=True)
class Entry:
    """What a publication says of a table or part; no path means that the part is gone. The last
    four are known for the files of keyed tables."""

    path: str | None
    ddl: str
    bucket: int | None = None
    bytes: int | None = None
    rows: int | None = None
    buckets: int | None = None


Written = dict[str, tuple[str, DataFrame] | Entry]

# Layer by table-name prefix.
LAYER_BY_PREFIX = {"stg_": "staging", "int_": "intermediate", "mart_": "marts"}


def layer_of(table: str, default: str = "public") -> str:
    """Layer folder of a table, from its name prefix."""
    for prefix, layer in LAYER_BY_PREFIX.items():
        if table.lower().startswith(prefix):
            return layer
    return default


class TableStore:
    def __init__(
        self, spark: SparkSession, root: str, layout: Layout | None = None, until: int | None = None
    ):
        """``layout`` sizes keyed tables; with ``until`` the store shows that publication."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.layout = layout or Layout()
        self.until = until
        self._known: tuple[list[str], tuple[int, dict[str, Entry]]] = ([], (0, {}))

    def as_of(self, publication: int) -> TableStore:
        """The store as a publication left it, to be read only."""
        return TableStore(self.spark, self.root, self.layout, publication)

    def publication(self) -> int:
        """Number of the newest publication, 0 before the first."""
        return self._current()[0]

    def _current(self) -> tuple[int, dict[str, Entry]]:
        """Newest publication number, and what is visible per table or part: a row each. The log is
        read again only when a file has come."""
        names = sorted(n for n in child_names(self.spark, f"{self.root}/_published") if n.startswith("part-"))
        if names != self._known[0]:
            self._known = (names, self._read_log())
        return self._known[1]

    def _read_log(self) -> tuple[int, dict[str, Entry]]:
        log = self.spark.read.schema(PUBLICATION_DDL).json(f"{self.root}/_published")
        if self.until is not None:
            log = log.where(F.col("publication") <= self.until)
        fields = [f for f in Entry.__dataclass_fields__]
        newest = log.groupBy("table_name").agg(
            F.max_by(F.struct("publication", *fields), "publication").alias("p")
        )
        rows = newest.select("table_name", "p.*").collect()
        number = max((row.publication for row in rows), default=0)
        return number, {r.table_name: Entry(*[r[f] for f in fields]) for r in rows if r.path is not None}

    def tables(self) -> list[str]:
        return sorted({name.split(PART)[0] for name in self._current()[1] if not name.startswith(LOG)})

    def exists(self, table: str) -> bool:
        return any(name.split(PART)[0] == table for name in self._current()[1])

    def read(self, table: str) -> DataFrame:
        df = self.read_if_exists(table)
        if df is None:
            raise KeyError(f"no published table {table!r}")
        return df

    def read_if_exists(self, table: str) -> DataFrame | None:
        return self._scan([entry for _, entry in sorted(self._entries(table).items())])

    def read_parts(self, table: str, parts: Collection[str]) -> DataFrame | None:
        """The given parts of a table as far as they are published."""
        return self._scan([e for part, e in sorted(self._entries(table).items()) if part in parts])

    def parts(self, table: str) -> list[str]:
        return sorted(self._entries(table))

    def _entries(self, table: str) -> dict[str, Entry]:
        """What is visible per part; an undivided table is the part without a name."""
        named = ((name.partition(PART), entry) for name, entry in self._current()[1].items())
        return {part: entry for (owner, _, part), entry in named if owner == table}

    def _scan(self, entries: Collection[Entry]) -> DataFrame | None:
        if not entries:
            return None
        paths = [f"{self.root}/{entry.path}" for entry in entries]
        return self.spark.read.schema(next(iter(entries)).ddl).parquet(*paths)

    def files(self, table: str) -> list[StoredFile]:
        """The visible files of a keyed table."""
        return self.files_with_changes(table, {})

    def files_with_changes(self, table: str, changed: Written) -> list[StoredFile]:
        """The files of a keyed table once ``changed`` is published."""
        entries = self._entries(table)
        for name, entry in changed.items():
            owner, _, part = name.partition(PART)
            if owner == table:
                entries[part] = entry
        found = [(p, e) for p, e in sorted(entries.items(), key=lambda item: item[0]) if e.path is not None]
        return [StoredFile(p, e.path, e.bucket, e.bytes, e.rows, e.buckets, e.ddl) for p, e in found]

    def scan_files(self, files: Iterable[StoredFile]) -> DataFrame | None:
        return self._scan([Entry(f.path, f.ddl) for f in files])

    def merge_keyed(
        self,
        table: str,
        batch: DataFrame,
        keys: Sequence[str],
        merge: Callable[[DataFrame, DataFrame], DataFrame],
        afresh: bool = False,
    ) -> tuple[Written, DataFrame]:
        """Merge ``batch`` into the files of a keyed table that may hold its keys, unpublished.

        ``merge(stored rows, batch rows)`` sees those files only and must return rows of their
        keys and of the batch's. Returns what changes and a scan of the whole table with it. With
        ``afresh`` the batch takes the place of all stored rows.
        """
        files = self.files(table)
        folder = keyed.new_folder(layer_of(table, "raw"), table)
        old = [] if afresh else files
        gone, fresh = keyed.merge_batch(self, table, folder, old, batch, keys, merge, self.layout)
        gone = files if afresh else gone
        paths = {f.path for f in gone}
        whole = self.scan_files([*(f for f in files if f.path not in paths), *fresh])
        empty = self.spark.createDataFrame([], batch.schema)
        return self._changed(table, gone, fresh), empty if whole is None else whole

    def _changed(self, table: str, gone: Iterable[StoredFile], fresh: Iterable[StoredFile]) -> Written:
        changed: Written = {f"{table}{PART}{f.part}": Entry(None, f.ddl) for f in gone}
        for f in fresh:
            changed[f"{table}{PART}{f.part}"] = Entry(f.path, f.ddl, f.bucket, f.bytes, f.rows, f.buckets)
        return changed

    def rows_with_keys(self, table: str, wanted: DataFrame, keys: Sequence[str]) -> DataFrame | None:
        """The rows of a keyed table whose key is in ``wanted``; only files that may hold one are read."""
        found = self.scan_files(keyed.files_with(self, self.files(table), wanted, keys))
        return None if found is None else found.join(wanted.select(*keys).distinct(), list(keys), "left_semi")

    def compact(self, table: str, keys: Sequence[str]) -> Written:
        """Put small files of each bucket of a keyed table together, unpublished; the rows stay as
        they are, and older publications still show the files they name."""
        files = sorted(self.files(table), key=lambda f: f.bucket)
        tasks = {}
        for bucket, own in groupby(files, key=lambda f: f.bucket):
            for number, inside in enumerate(keyed.packed(list(own), self.layout.file_bytes)):
                tasks[bucket, number] = inside
        if not tasks:
            return {}
        gone = [f for inside in tasks.values() for f in inside]
        folder = keyed.new_folder(layer_of(table, "raw"), table)
        size, buckets = sum(f.bytes for f in gone), max(f.buckets for f in files)
        fresh = keyed.write_files(self, table, folder, self.scan_files(gone), keys, buckets, self.layout, size)
        return self._changed(table, gone, fresh)

    def write_part(self, table: str, part: str, df: DataFrame) -> Written:
        """Write one part, unpublished; publishing it replaces the part of that name."""
        return {f"{table}{PART}{part}": self.write(table, df)}

    def drop_old(self, keep: int) -> int:
        """Delete the folders and files that none of the last ``keep`` publications shows; how many."""
        if keep < 1:
            raise ValueError("keep at least the newest publication")
        log = self.spark.read.schema(PUBLICATION_DDL).json(f"{self.root}/_published")
        newest = self._current()[0]
        by_table = Window.partitionBy("table_name").orderBy("publication")
        until = F.coalesce(F.lead("publication").over(by_table) - 1, F.lit(newest))
        shown = log.withColumn("until", until).where("path is not null")
        # A path is visible from its own publication until the next one of its table.
        last = shown.groupBy("path").agg(F.max("until").alias("until"))
        # Filters go with the last file of their load.
        load = F.when(F.contains("path", F.lit("/rows/")), F.substring_index("path", "/rows/", 1))
        by_load = Window.partitionBy(F.coalesce(load, F.col("path")))
        old = last.withColumn("load", load).withColumn("load_until", F.max("until").over(by_load))
        gone = old.where(F.col("until") <= newest - keep).collect()
        deleted = sum(delete_path(self.spark, f"{self.root}/{r.path}") for r in gone)
        for folder in {r.load for r in gone if r.load and r.load_until <= newest - keep}:
            delete_path(self.spark, f"{self.root}/{folder}")
        return deleted

    def write(self, table: str, df: DataFrame) -> tuple[str, DataFrame]:
        """Write a new, unpublished version; return its path and a scan of it."""
        path = f"{layer_of(table, 'raw')}/{table}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{path}")
        return path, self.spark.read.schema(df.schema).parquet(f"{self.root}/{path}")

    def publish(self, written: Mapping[str, tuple[str, DataFrame] | Entry]) -> None:
        """Make all given versions current at once: one task writes one file."""
        if self.until is not None:
            raise ValueError("an earlier publication can only be read")
        if not written:
            return
        number = self._current()[0] + 1
        entries = {t: w if isinstance(w, Entry) else Entry(w[0], ddl_of(w[1].schema)) for t, w in written.items()}
        rows = [(number, t, e.path, e.ddl, e.bucket, e.bytes, e.rows, e.buckets) for t, e in entries.items()]
        log = self.spark.createDataFrame(rows, PUBLICATION_DDL)
        log.coalesce(1).write.mode("append").json(f"{self.root}/_published")

    def write_partition(self, table: str, df: DataFrame, partition: str) -> None:
        """Replace the partitions that ``df`` holds and keep all others. Running it
        again for the same run date gives the same table."""
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(self._partitioned_path(table))
        )

    def drop_partition(self, table: str, partition: str, day: date) -> bool:
        """Delete one date's partition; whether there was one."""
        return delete_path(self.spark, f"{self._partitioned_path(table)}/{partition}={day.isoformat()}")

    def read_dates(self, table: str, ddl: str, partition: str, days: Iterable[date]) -> DataFrame:
        """The partitions of some dates, as far as there are any; the folders of others are not even listed."""
        root = self._partitioned_path(table)
        paths = [f"{root}/{partition}={day.isoformat()}" for day in days]
        found = [path for path in paths if path_exists(self.spark, path)]
        if not found:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).option("basePath", root).parquet(*found)

    def read_partitioned(self, table: str, ddl: str) -> DataFrame:
        return self.spark.read.schema(ddl).parquet(self._partitioned_path(table))

    def partition_before(self, table: str, partition: str, day: date) -> date | None:
        """The newest date of a date partition before ``day``, from the folder names alone."""
        names = child_names(self.spark, self._partitioned_path(table))
        days = (n.split("=", 1)[1] for n in names if n.startswith(f"{partition}="))
        found = [d for d in days if d < day.isoformat() and not d.startswith("__")]
        return date.fromisoformat(max(found)) if found else None

    def _partitioned_path(self, table: str) -> str:
        return f"{self.root}/{layer_of(table, 'ml')}/{table}"

    # Logs: every append is a file in the folder of the log's generation. Compaction writes all rows
    # anew, publishes them, and begins the next generation.

    def _log(self, table: str) -> tuple[Entry | None, str]:
        """The compacted part of a log, if any, and the folder that new rows go to."""
        entry = self._current()[1].get(f"{LOG}{table}")
        return entry, f"{self.root}/observability/{table}/generation-{entry.buckets if entry else 0}"

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows to a log table."""
        df.write.mode("append").parquet(self._log(table)[1])

    def read_log(self, table: str, ddl: str) -> DataFrame:
        entry, folder = self._log(table)
        paths = [f"{self.root}/{entry.path}"] if entry else []
        paths += [folder] if path_exists(self.spark, folder) else []
        return self.spark.read.schema(ddl).parquet(*paths) if paths else self.spark.createDataFrame([], ddl)

    def compact_log(self, table: str, ddl: str) -> None:
        """Write the rows of a log as few files and publish them; the rows stay as they are, and earlier
        publications still read the files they know."""
        entry, folder = self._log(table)
        if not path_exists(self.spark, folder):
            return
        size = content_length(self.spark, folder)
        size += content_length(self.spark, f"{self.root}/{entry.path}") if entry else 0
        path = f"observability/{table}/{uuid.uuid4().hex}"
        files = max(1, -(-size // self.layout.file_bytes))
        self.read_log(table, ddl).coalesce(files).write.parquet(f"{self.root}/{path}")
        self.publish({f"{LOG}{table}": Entry(path, ddl, buckets=self.publication() + 1)})
