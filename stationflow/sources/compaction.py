"""Few large files instead of many small ones, for days of a lake.

A stream appends small files to every day, and the log of its sink, not the
folder, says which files belong to the lake. So nothing of the sink is touched:
a compacted day is written beside it, below ``_compacted``, and an entry
published in one step says which version of a day stands for which files of the
sink. Readers take the newest entry of a day, plus files that came after it;
they never see a file and its replacement, and versions that running readers
use stay until :func:`vacuum`. The stream, its checkpoint and restarts know
nothing of all this.

    <lake>/obs_date=D/part-…                     files of the sink
    <lake>/_compacted/data/obs_date=D/<run>/…    rewritten rows, sorted by station and time
    <lake>/_compacted/entries/obs_date=D.<n>     run, rows, schema and replaced files, as JSON lines

Without its sink's log (a lake written in batches), the listed files are the lake.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import storage
from .readers import read_lake
from .sinks import DAY

#: Rows by which a day's files are sorted, so that station filters skip row groups.
ORDER = ("city", "datetime")
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Entry:
    """One compacted version of a day, its schema, and the sink's files it stands for."""

    day: str
    version: int
    run: str
    rows: int
    schema: str
    replaced: frozenset[str]

    def folder(self, path: str) -> str:
        return f"{path}/_compacted/data/{DAY}={self.day}/{self.run}"


def _entries_folder(path: str) -> str:
    return f"{path}/_compacted/entries"


def _entry_path(path: str, day: str, version: int) -> str:
    return f"{_entries_folder(path)}/{DAY}={day}.{version}"


def _named(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Day and version of every entry."""
    parts = [name.split("=", 1)[1].rsplit(".", 1) for name in storage.names(spark, _entries_folder(path))]
    return [(day, int(version)) for day, version in parts]


def _read_entry(spark: SparkSession, path: str, day: str, version: int) -> Entry:
    head, *files = storage.read_text(spark, _entry_path(path, day, version)).splitlines()
    return Entry(day, version, **json.loads(head), replaced=frozenset(json.loads(f) for f in files))


def entries(spark: SparkSession, path: str) -> dict[str, Entry]:
    """The newest entry of every compacted day."""
    newest: dict[str, int] = {}
    for day, version in _named(spark, path):
        newest[day] = max(version, newest.get(day, version))
    return {day: _read_entry(spark, path, day, version) for day, version in newest.items()}


def _key(file: str) -> str:
    """Day folder and name of a file of the sink, the same however the lake is reached."""
    return "/".join(unquote(file).rsplit("/", 2)[1:])


def _day_of(file: str) -> str:
    return unquote(file).rsplit("/", 2)[1].split("=", 1)[-1]


def _is_day(days: Iterable[str]):
    """Filter on the day folders; literals, so that other days are not listed or read."""
    days = list(days)
    known = F.col(DAY).isin([date.fromisoformat(d) for d in days if d != NULL_DAY])
    return F.coalesce(known, F.lit(False)) | (F.col(DAY).isNull() & F.lit(NULL_DAY in days))


def _with_fields_of(a: T.StructType, b: T.StructType) -> T.StructType:
    return T.StructType([*a, *[f for f in b if f.name not in a.names]])


def _sink(spark: SparkSession, path: str, known: Mapping[str, Entry], schema: T.StructType | None = None, merge_schema: bool = True) -> DataFrame:
    """The sink's own table. Its schema is that of the entries, so that replaced files need not exist any more.

    With ``merge_schema``, columns of files that no entry stands for are added.
    """
    if schema or not known:
        return read_lake(spark, path, schema, merge_schema)
    for entry in known.values():
        schema = _with_fields_of(schema or T.StructType(), T.StructType.fromJson(json.loads(entry.schema)))
    if merge_schema:
        replaced = {f for e in known.values() for f in e.replaced}
        others = [unquote(f) for f in read_lake(spark, path, schema).inputFiles() if _key(f) not in replaced]
        if others:
            reader = spark.read.option("mergeSchema", True).option("basePath", path)
            schema = _with_fields_of(schema, reader.parquet(*others).schema)
    return read_lake(spark, path, schema)


def _live(sink: DataFrame, known: Iterable[Entry], days: Iterable[str]) -> dict[str, list[str]]:
    """Files of the sink's days that none of the entries stands for."""
    days, replaced = set(days), {f for e in known for f in e.replaced}
    live: dict[str, list[str]] = {}
    for file in sink.inputFiles() if days else []:
        if _day_of(file) in days and _key(file) not in replaced:
            live.setdefault(_day_of(file), []).append(unquote(file))
    return live


def _union(spark: SparkSession, path: str, sink: DataFrame, files: Iterable[str], chosen: Iterable[Entry]) -> list[DataFrame]:
    """Tables of single files of the sink and of compacted versions, in the sink's shape."""
    shape, tables = sink.schema, []
    files, folders = list(files), [e.folder(path) for e in chosen if e.rows]
    if files:
        tables.append(spark.read.schema(shape).option("basePath", path).parquet(*files))
    if folders:
        tables.append(spark.read.schema(shape).option("basePath", f"{path}/_compacted/data").parquet(*folders))
    return [t.select(*shape.names) for t in tables]


def read_compacted(spark: SparkSession, path: str, schema: T.StructType | None = None, merge_schema: bool = False) -> DataFrame:
    """The lake with compacted days in place of the files they stand for.

    The same rows as the sink's own table. Day filters prune in every part of it.
    A lake without entries is read as it is.
    """
    known = entries(spark, path)
    sink = _sink(spark, path, known, schema, merge_schema)
    if not known:
        return sink
    table, live = sink.filter(~_is_day(known)), _live(sink, known.values(), known)
    for part in _union(spark, path, sink, (f for files in live.values() for f in files), known.values()):
        table = table.unionByName(part)
    return table


def fragmented_days(spark: SparkSession, path: str, most_files: int = 1) -> list[str]:
    """Days of which a reader opens more than ``most_files`` files of the sink, or any besides a compacted version."""
    known = entries(spark, path)
    sink = _sink(spark, path, known, merge_schema=False)
    live = _live(sink, known.values(), {_day_of(f) for f in sink.inputFiles()})
    return sorted(d for d, files in live.items() if d in known or len(files) > most_files)


def compact(spark: SparkSession, path: str, days: Sequence[str] | None = None, order: Sequence[str] = ORDER) -> list[Entry]:
    """Rewrite ``days`` (default: all fragmented ones) and publish an entry for each.

    All days are one job: rows are range-partitioned by day, station and time, so
    a large day becomes several files and small days do not share one, and sorted.
    A day is published only if as many rows were written as its live files hold;
    should another run have published it meanwhile, this one is refused and
    its files are left to :func:`vacuum`. Days without live files are left alone.
    """
    days = fragmented_days(spark, path) if days is None else list(days)
    before = entries(spark, path)
    sink = _sink(spark, path, before)
    live = _live(sink, before.values(), days)
    days = sorted(live)
    if not days:
        return []
    tables = _union(spark, path, sink, (f for d in days for f in live[d]), (before[d] for d in days if d in before))
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.unionByName(more)
    run, keys = uuid.uuid4().hex, [DAY, *[c for c in order if c in rows.columns]]
    staged = f"{path}/_compacted/writing/{run}"
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy(DAY).parquet(staged)
    counts = {_text_of(d): n for d, n in rows.groupBy(DAY).count().collect()}
    written = spark.read.schema(sink.schema).parquet(staged).groupBy(DAY).count().collect()
    if counts != {_text_of(d): n for d, n in written}:
        raise RuntimeError(f"compaction of {path} wrote other rows than it read")
    published = []
    for day in days:
        old = before.get(day)
        replaced = frozenset(map(_key, live[day])) | (old.replaced if old else frozenset())
        entry = Entry(day, old.version + 1 if old else 0, run, counts.get(day, 0), sink.schema.json(), replaced)
        if entry.rows:
            storage.move(spark, f"{staged}/{DAY}={day}", entry.folder(path))
        lines = [json.dumps({"run": run, "rows": entry.rows, "schema": entry.schema}), *map(json.dumps, sorted(replaced))]
        storage.publish_text(spark, _entry_path(path, day, entry.version), "\n".join(lines))
        published.append(entry)
    storage.delete(spark, staged)
    return published


def _text_of(day: date | None) -> str:
    return NULL_DAY if day is None else day.isoformat()


def vacuum(spark: SparkSession, path: str, older_than_seconds: float = 86_400, sources: bool = False) -> list[str]:
    """Delete versions that no entry names any more, and their entries; names what is gone.

    Younger ones are kept, for readers that planned with them. With ``sources``, also the sink's replaced files:
    then the lake can only be read by :func:`read_compacted`.
    """
    newest, gone = entries(spark, path), []

    def old(item: str) -> bool:
        return storage.age_seconds(spark, item) >= older_than_seconds

    for day, version in _named(spark, path):
        if version < newest[day].version and old(_entry_path(path, day, version)):
            gone.append(_entry_path(path, day, version))
    data = f"{path}/_compacted/data"
    for folder in storage.names(spark, data):
        day = folder.split("=", 1)[1]
        for run in storage.names(spark, f"{data}/{folder}"):
            if (day not in newest or run != newest[day].run) and old(f"{data}/{folder}/{run}"):
                gone.append(f"{data}/{folder}/{run}")
    for run in storage.names(spark, f"{path}/_compacted/writing"):
        if old(f"{path}/_compacted/writing/{run}"):
            gone.append(f"{path}/_compacted/writing/{run}")
    if sources:
        for entry in newest.values():
            if old(_entry_path(path, entry.day, entry.version)):
                gone += [f"{path}/{f}" for f in sorted(entry.replaced) if storage.exists(spark, f"{path}/{f}")]
    for item in gone:
        storage.delete(spark, item)
    return gone
