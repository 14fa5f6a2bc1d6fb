"""Tables in versions whose cost follows the change: parts by unit, and a manifest per version that lists them.

A unit is a hash bucket of a keyed table or a day of a view. Every write puts its rows into a folder of its own,
partitioned by unit, and ends with a manifest: which units are read from which folders. A new version names the
folders of untouched units again instead of copying them, so a version costs what it changes, an older version stays
readable while its manifest is kept, and readers move from one whole version to the next. Old files go last.

A keyed load writes only the rows that it changes, next to the ones they replace. When the changed rows of a unit
reach a share of its base rows, the unit is written as a whole, so reading never has to pass over many changes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmart.sources.readers import next_snapshot_id, snapshot_ids
from talkmart.sources.writers import child_names, drop_folder, drop_snapshots, path_exists, write_snapshot

#: Buckets of a new keyed table. An upper bound of what the driver sees of a keyed table's manifest, with the changes.
BUCKETS = 256
#: Changed rows of a unit, as a share of its base rows, from which it is written as a whole.
COMPACT_SHARE = 0.25
#: Keys of changed rows up to which they are broadcast (a key has at most some hundred bytes); more are shuffled.
BROADCAST_KEYS = 200_000
#: Newest versions that stay after a load.
KEPT_VERSIONS = 3

_MANIFEST = T.StructType(
    [
        T.StructField("unit", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("is_change", T.BooleanType()),
        T.StructField("rows", T.LongType()),
    ]
)
Merger = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Part:
    """The rows of one unit in one folder: all of them, or changes to those in other folders."""

    unit: str
    folder: str
    is_change: bool
    rows: int


def version_ids(spark: SparkSession, base: str) -> list[str]:
    """Complete versions, oldest first."""
    return snapshot_ids(spark, f"{base}/manifest")


def manifest(spark: SparkSession, base: str, version: str | None = None) -> list[Part]:
    """The parts of a version, of the newest one by default; [] where there is none."""
    ids = [version] if version else version_ids(spark, base)[-1:]
    if not ids:
        return []
    rows = spark.read.schema(_MANIFEST).parquet(f"{base}/manifest/snapshot={ids[0]}").collect()
    return [Part(*row) for row in rows]


def _paths(base: str, parts: Iterable[Part]) -> list[str]:
    return [f"{base}/data/{p.folder}/unit={p.unit}" for p in parts]


def read_parts(spark: SparkSession, base: str, schema: T.StructType, parts: Sequence[Part]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*_paths(base, parts))


def _write(df: DataFrame, base: str, folder: str, had: set[str]) -> list[Part]:
    """Write ``df``, which has a column ``unit``. Units in ``had`` get changes, others whole parts."""
    spark, path = df.sparkSession, f"{base}/data/{folder}"
    df.hint("rebalance", "unit").write.mode("errorifexists").partitionBy("unit").parquet(path)
    counts = spark.read.schema("unit string").parquet(path).groupBy("unit").count().collect()
    return [Part(r["unit"], folder, r["unit"] in had, r["count"]) for r in counts]


def _folder(version: str) -> str:
    return f"{version}-{uuid.uuid4().hex[:8]}"


def _commit(spark: SparkSession, base: str, version: str, parts: Sequence[Part], kept: int) -> None:
    """Of two writers that work on the same version, the second fails here and has changed nothing."""
    rows = spark.createDataFrame([(p.unit, p.folder, p.is_change, p.rows) for p in parts], _MANIFEST)
    write_snapshot(rows.coalesce(1), f"{base}/manifest", version)
    _clean(spark, base, kept)


def _clean(spark: SparkSession, base: str, kept: int) -> None:
    """Remove the parts that only older versions name, what failed writers left, and then the older manifests."""
    ids = version_ids(spark, base)
    used = {(p.folder, p.unit) for i in ids[-kept:] for p in manifest(spark, base, i)}
    folders = {folder for folder, _ in used}
    for i in ids[:-kept]:
        for part in manifest(spark, base, i):
            if part.folder in folders and (part.folder, part.unit) not in used:
                drop_folder(spark, _paths(base, [part])[0])
    # A writer whose version is there already can no longer commit, so its folder is left over.
    for folder in child_names(spark, f"{base}/data"):
        if folder not in folders and folder.split("-")[0] <= ids[-1]:
            drop_folder(spark, f"{base}/data/{folder}")
    drop_snapshots(spark, f"{base}/manifest", ids[:-kept])


def replace_units(df: DataFrame, base: str, unit: Column, touched: Sequence[str] | None = None, kept: int = KEPT_VERSIONS) -> str:
    """A new version in which the ``touched`` units have the rows of ``df`` and no others; all units by default.

    ``df`` must have rows of these units only. Units are made of digits and hyphens, such as days. Gives back the
    version's number.
    """
    spark = df.sparkSession
    version = next_snapshot_id(spark, f"{base}/manifest")
    old = [] if touched is None else [p for p in manifest(spark, base) if p.unit not in set(touched)]
    new = _write(df.withColumn("unit", unit.cast("string")), base, _folder(version), set())
    _commit(spark, base, version, [*old, *new], kept)
    return version


def read_units(spark: SparkSession, base: str, schema: T.StructType, units: Sequence[str] | None = None, version: str | None = None) -> DataFrame:
    """A table of whole units: the newest or a given version, all units or some."""
    parts = manifest(spark, base, version)
    return read_parts(spark, base, schema, parts if units is None else [p for p in parts if p.unit in set(units)])


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.format_string("%05d-%05d", F.pmod(F.xxhash64(*keys), F.lit(buckets)), F.lit(buckets))


def _buckets(parts: Sequence[Part], default: int) -> int:
    """A table keeps the number of buckets it was made with: it is part of each unit's name."""
    return int(parts[0].unit.split("-")[1]) if parts else default


def _current(spark: SparkSession, base: str, schema: T.StructType, keys: Sequence[str], parts: Sequence[Part]) -> DataFrame:
    """The newest row of each key. Rows with a NULL key equal no other and all stay."""
    whole = read_parts(spark, base, schema, [p for p in parts if not p.is_change])
    changes = [p for p in parts if p.is_change]
    if not changes:
        return whole
    folder = F.regexp_extract("_metadata.file_path", "/data/([^/]+)/unit=", 1)
    changed = read_parts(spark, base, schema, changes).select("*", folder.alias("_folder"))
    named = F.concat(*(F.col(k).cast("string") for k in keys)).isNotNull()  # no key column is NULL
    newest = Window.partitionBy(*keys).orderBy(F.desc("_folder"))
    if len({p.unit for p in changes}) < len(changes):
        latest = changed.filter(named).withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1")
        changed = latest.select(*changed.columns).unionByName(changed.filter(~named))
    replaced = changed.select(*keys)
    if sum(p.rows for p in changes) <= BROADCAST_KEYS:
        replaced = F.broadcast(replaced)
    return whole.join(replaced, list(keys), "left_anti").select(*schema.names).unionByName(changed.select(*schema.names))


def read_keyed(spark: SparkSession, base: str, schema: T.StructType, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """A keyed table: the newest or a given version; empty where there is none."""
    return _current(spark, base, schema, keys, manifest(spark, base, version))


def _unlike(after: DataFrame, before: DataFrame, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """Rows of ``after`` that ``before`` does not have. Fractions are compared as texts: 0.0 is not -0.0."""
    same = F.lit(True)
    for field in schema.fields:
        new, old = F.col(field.name), F.col(f"_old_{field.name}")
        if isinstance(field.dataType, T.FractionalType):
            new, old = new.cast("string"), old.cast("string")
        same = same & (new == old if field.name in keys else new.eqNullSafe(old))
    return after.join(before.select(*(F.col(c).alias(f"_old_{c}") for c in schema.names)), same, "left_anti")


def upsert_keyed(
    source: DataFrame,
    base: str,
    schema: T.StructType,
    keys: Sequence[str],
    merger: Merger,
    small_source: bool = False,
    buckets: int = BUCKETS,
    kept: int = KEPT_VERSIONS,
    initial: DataFrame | None = None,
) -> str:
    """A new version in which ``source`` is merged; gives back the version's number.

    ``merger(target, source)`` is given only the stored rows that have one of the source's keys, so it must decide by
    key and leave other rows alone, as ``operators.upsert.merge`` does. Buckets without such keys are not read, and
    only rows that differ afterwards are written. ``source`` is read several times and must hold each key once;
    ``small_source`` is for one whose size was checked. ``initial`` has the rows of a table that has no version yet.
    A load that changes nothing makes no version.
    """
    spark, columns = source.sparkSession, list(schema.names)
    version, parts = next_snapshot_id(spark, f"{base}/manifest"), manifest(spark, base)
    if not parts and initial is not None:
        whole = merger(initial, source)
        new = _write(whole.select(*columns, _bucket(keys, buckets).alias("unit")), base, _folder(version), set())
        _commit(spark, base, version, new, kept)
        return version
    unit = _bucket(keys, _buckets(parts, buckets))
    touched = {r["unit"] for r in source.select(unit.alias("unit")).distinct().collect()}
    own = [p for p in parts if p.unit in touched]
    wanted = source.select(*keys)
    stored = _current(spark, base, schema, keys, own)
    matched = stored.join(F.broadcast(wanted) if small_source else wanted, list(keys), "left_semi").select(*columns)
    changed = merger(matched, source).select(*columns)
    if own:
        changed = _unlike(changed, matched, keys, schema)
    folder = _folder(version)
    new = _write(changed.select(*columns, unit.alias("unit")), base, folder, {p.unit for p in parts})
    known = version_ids(spark, base)
    if known and not new:
        drop_folder(spark, f"{base}/data/{folder}")
        return known[-1]
    merged = _compacted(spark, base, schema, keys, version, [*parts, *new])
    _commit(spark, base, version, merged, kept)
    return version


def _compacted(spark: SparkSession, base: str, schema: T.StructType, keys: Sequence[str], version: str, parts: list[Part]) -> list[Part]:
    """``parts`` with those units written as a whole that have many changes."""
    whole, changes = {}, {}
    for p in parts:
        kind = changes if p.is_change else whole
        kind[p.unit] = kind.get(p.unit, 0) + p.rows
    full = {u for u, n in changes.items() if n > COMPACT_SHARE * whole.get(u, 0)}
    if not full:
        return parts
    rows = _current(spark, base, schema, keys, [p for p in parts if p.unit in full])
    unit = _bucket(keys, _buckets(parts, BUCKETS))
    new = _write(rows.select(*schema.names, unit.alias("unit")), base, _folder(version), set())
    return [*(p for p in parts if p.unit not in full), *new]


def has_versions(spark: SparkSession, base: str) -> bool:
    return path_exists(spark, f"{base}/manifest") and bool(version_ids(spark, base))
