"""Small batches of a store merged into larger, bucketed segments.

Every batch is a folder of its own, so after many runs the store is many small files.  `compact` merges complete batches
into a segment of level 1, and as many segments of a level into one of the next, so a row is rewritten once for each level.
Segments of articles and matches are bucketed and sorted by the URL hash: a batch meets them without shuffling the store,
and a few hashes skip most row groups.

Which segments count is written in a small manifest, one new version for each change, put in place by a rename; without one
a store is its batch folders.  Rows keep their batch id in a segment, so a batch can still be repeated: its new folder hides
its rows in segments, and once that folder is merged they are listed as superseded.  A merge that fails before its manifest
is in place leaves the store as it was; one that fails after leaves folders that the next writer removes.  One writer at a
time, and no query on the store while `compact` runs, as it deletes what it merged.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.schemas import STORE_TABLES
from newsmill.session import file_system, remove_folder

BATCH, SEGMENT = "batch_id", "segment"
FANOUT = 8  # batches or segments of a level that are merged into one
BUCKETED = {"articles", "keyword_matches"}  # by url_hash


class Manifest(NamedTuple):
    version: int = 0
    buckets: int = 0
    segments: tuple[dict, ...] = ()  # name, level, without (batches whose rows are superseded)
    merged: tuple[str, ...] = ()  # batches whose folders are still to be removed
    gone: tuple[str, ...] = ()  # segments whose folders are still to be removed


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def segment_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/_segments/{table}"


def _names(spark: SparkSession, folder: str) -> list[str]:
    system, at = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []


def manifest_of(spark: SparkSession, root: str) -> Manifest | None:
    folder = f"{root.rstrip('/')}/_manifest"
    versions = [n for n in _names(spark, folder) if n.endswith(".json")]
    if not versions:
        return None
    written = json.loads(spark.read.text(f"{folder}/{versions[-1]}", wholetext=True).first()[0])
    return Manifest(**{k: tuple(v) if isinstance(v, list) else v for k, v in written.items()})


def _commit(spark: SparkSession, root: str, manifest: Manifest) -> Manifest:
    """The next version in place, whole or not at all."""
    manifest = manifest._replace(version=manifest.version + 1)
    folder = f"{root.rstrip('/')}/_manifest"
    system, final = file_system(spark, f"{folder}/{manifest.version:09d}.json")
    _, draft = file_system(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = system.create(draft, True)
    out.write(bytearray(json.dumps(manifest._asdict()), "utf-8"))
    out.close()
    if system.exists(final) or not system.rename(draft, final):
        raise RuntimeError(f"another writer changed {root}")
    for old in _names(spark, folder):
        if old < f"{manifest.version - 1:09d}.json" and not old.startswith("_"):
            remove_folder(spark, f"{folder}/{old}")
    return manifest


def settle(spark: SparkSession, root: str) -> Manifest | None:
    """Removes what a merge has replaced; writers call this first, as a batch may come again."""
    manifest = manifest_of(spark, root)
    if manifest is None or not (manifest.merged or manifest.gone):
        return manifest
    for table in STORE_TABLES:
        for batch in manifest.merged:
            remove_folder(spark, f"{table_path(root, table)}/{BATCH}={batch}")
        for segment in manifest.gone:
            remove_folder(spark, f"{segment_path(root, table)}/{SEGMENT}={segment}")
    return _commit(spark, root, manifest._replace(merged=(), gone=()))


def written_batches(spark: SparkSession, root: str, table: str, manifest: Manifest | None) -> list[str]:
    """Batches whose folder of a table is complete."""
    folder, merged = table_path(root, table), set(manifest.merged if manifest else ())
    names = [n.removeprefix(f"{BATCH}=") for n in _names(spark, folder) if n.startswith(f"{BATCH}=")]
    return [n for n in names if n not in merged and "_SUCCESS" in _names(spark, f"{folder}/{BATCH}={n}")]


def _schema(table: str) -> T.StructType:
    return T.StructType([*STORE_TABLES[table].fields, T.StructField(BATCH, T.StringType())])


def _segment_table(spark: SparkSession, root: str, table: str, manifest: Manifest) -> str:
    """The catalog name of a table's segments, which the session's catalog learns here if it has to."""
    name = f"newsmill_{hashlib.sha256(root.rstrip('/').encode()).hexdigest()[:16]}_{table}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(table))
        buckets = f"CLUSTERED BY (url_hash) SORTED BY (url_hash) INTO {manifest.buckets} BUCKETS" if table in BUCKETED else ""
        spark.sql(f"CREATE TABLE {name} ({columns}, `{SEGMENT}` STRING) USING parquet PARTITIONED BY (`{SEGMENT}`) {buckets} LOCATION '{segment_path(root, table)}'")
    for segment in manifest.segments:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (`{SEGMENT}` = '{segment['name']}')")
    spark.catalog.refreshTable(name)
    return name


def batch_rows(spark: SparkSession, root: str, table: str, manifest: Manifest | None, only: list[str] | None = None) -> DataFrame:
    """Rows of batch folders, of `only` these batches if given."""
    path = table_path(root, table)
    if only is None:
        rows = spark.read.schema(_schema(table)).parquet(path)
        return rows.filter(~F.col(BATCH).isin(list(manifest.merged))) if manifest and manifest.merged else rows
    if not only:
        return spark.createDataFrame([], _schema(table))
    return spark.read.schema(_schema(table)).option("basePath", path).parquet(*(f"{path}/{BATCH}={b}" for b in only))


def segment_rows(
    spark: SparkSession, root: str, table: str, manifest: Manifest, segments: list[dict], hidden: list[str], bucketed: bool = True,
) -> DataFrame:
    """Rows of segments, but for superseded ones and those of `hidden` batches; `bucketed` if the buckets are of use."""
    kept = [F.col(SEGMENT) == s["name"] if not s["without"] else (F.col(SEGMENT) == s["name"]) & ~F.col(BATCH).isin(s["without"]) for s in segments]
    if bucketed:
        whole = spark.table(_segment_table(spark, root, table, manifest))
    else:
        whole = spark.read.schema(T.StructType([*_schema(table), T.StructField(SEGMENT, T.StringType())])).parquet(segment_path(root, table))
    rows = whole.filter(F.col(SEGMENT).isin([s["name"] for s in segments]))
    if any(s["without"] for s in segments):
        rows = rows.filter(reduce(lambda a, b: a | b, kept))
    return rows.filter(~F.col(BATCH).isin(hidden)) if hidden else rows


def read_parts(spark: SparkSession, root: str, table: str) -> list[DataFrame]:
    """A stored table in parts of equal columns: recent batches, then the bucketed segments if there are any."""
    manifest = manifest_of(spark, root)
    recent = batch_rows(spark, root, table, manifest)
    if manifest is None or not manifest.segments:
        return [recent]
    again = written_batches(spark, root, table, manifest)
    return [recent, segment_rows(spark, root, table, manifest, list(manifest.segments), again).drop(SEGMENT)]


def _merge(spark: SparkSession, root: str, manifest: Manifest, level: int, batches: list[str], segments: list[dict]) -> Manifest:
    """Writes one segment of `level` from batches or from segments, and the manifest that replaces them by it."""
    name = f"l{level}-{uuid.uuid4().hex[:12]}"
    older = [s for s in manifest.segments if s not in segments]
    superseded: dict[str, set[str]] = {s["name"]: set(s["without"]) for s in older}
    for table in STORE_TABLES:
        target = _segment_table(spark, root, table, manifest)
        if batches:
            written = set(written_batches(spark, root, table, manifest))
            rows = batch_rows(spark, root, table, manifest, [b for b in batches if b in written])
            if older:  # these batches may have been merged before and come again
                found = segment_rows(spark, root, table, manifest, older, []).filter(F.col(BATCH).isin(batches))
                for at, batch in found.select(SEGMENT, BATCH).distinct().collect():
                    superseded[at].add(batch)
        else:
            # Dealt out anew: with buckets known the exchange would be left out and the scan split into many files.
            rows = segment_rows(spark, root, table, manifest, segments, [], bucketed=False).drop(SEGMENT)
        rows = rows.select(*(f.name for f in _schema(table)), F.lit(name).alias(SEGMENT))
        dealt = rows.repartition(manifest.buckets, "url_hash") if table in BUCKETED else rows
        dealt.write.insertInto(target)
    live = tuple({**s, "without": sorted(superseded[s["name"]])} for s in older)
    return _commit(spark, root, manifest._replace(
        segments=(*live, {"name": name, "level": level, "without": []}), merged=tuple(batches), gone=tuple(s["name"] for s in segments)))


def compact(spark: SparkSession, root: str, fanout: int = FANOUT, buckets: int | None = None) -> int:
    """Merges while `fanout` batches or segments of one level are there; returns how many merges it took.

    `buckets` counts at the first merge of a store (shuffle partitions unless given) and stays.  A batch is taken once its
    articles are written, as these come last.
    """
    if fanout < 2:
        raise ValueError("a merge takes two at least")
    manifest = settle(spark, root) or Manifest(buckets=buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    merges = 0
    while True:
        ready = written_batches(spark, root, "articles", manifest)
        levels: dict[int, list[dict]] = {}
        for segment in manifest.segments:
            levels.setdefault(segment["level"], []).append(segment)
        full = next((level for level in sorted(levels) if len(levels[level]) >= fanout), None)
        if len(ready) >= fanout:
            _merge(spark, root, manifest, 1, ready, [])
        elif full is not None:
            _merge(spark, root, manifest, full + 1, [], levels[full])
        else:
            return merges
        manifest, merges = settle(spark, root), merges + 1
