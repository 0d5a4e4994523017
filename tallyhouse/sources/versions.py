"""Tables that grow by batches, with a manifest beside their files.

``_manifest`` in the table's folder has one small file per version: which files it added, how many rows, the least and
greatest order and date, the batch, and the marker, the compared values of the version's last row. A version is there
once its manifest file is, which appears by one rename that fails where the name is taken. So a reader meets whole
versions only, an append asks the manifest instead of the history, and a refresh knows where it goes on without a scan.

Plain readers of the folder find the same files, since data lies beside the manifest; files of an append that ended
before its commit are there for them, but not for ``read_versions``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schemas import ROW_ORD

MANIFEST = "_manifest"
Keys = Callable[[DataFrame], dict[str, Column]]


class VersionTaken(RuntimeError):
    """Another append committed the version that this one was about to be."""


class UnorderedTable(ValueError):
    """A table with rows that have no order, to which ordered rows cannot be appended."""


@dataclass(frozen=True)
class Version:
    """What one append (or the adoption of a table) added. Orders and dates are texts as Spark writes them."""

    version: int
    files: list[str]
    rows: int
    unordered: int = 0
    batch: int | None = None
    least_order: str | None = None
    greatest_order: str | None = None
    oldest: str | None = None
    newest: str | None = None
    #: name -> (type, value) of the last row's compared values
    marker: dict[str, list] = field(default_factory=dict)


@dataclass(frozen=True)
class Marks:
    """Where a table ends: its newest date, last batch, and the compared values of its last row."""

    newest: str | None
    last_date: str | None
    batch: int | None
    marker: dict[str, list]
    unordered: int

    def literal(self, name: str) -> Column:
        kind, value = self.marker[name]
        return F.lit(value).cast(kind)

    def newest_date(self, kind: str = "timestamp_ntz") -> Column:
        return F.lit(self.newest).cast(kind)


# ---- the folder ----------------------------------------------------------------------------------------------------


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _filesystem(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, place = _filesystem(spark, folder), _path(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(place) if f.isFile()) if files.exists(place) else []


def _commit(spark: SparkSession, table: str, version: Version) -> None:
    """Write the manifest file of a version under another name, then give it its own."""
    files = _filesystem(spark, table)
    name = f"{version.version:010d}.json"
    hidden = _path(spark, table, MANIFEST, f".{name}-{uuid.uuid4().hex}")
    out = files.create(hidden, False)
    out.write(bytearray(json.dumps(asdict(version), ensure_ascii=True).encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(hidden.toUri(), spark._jsc.hadoopConfiguration())
    overwrite_not = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(hidden, _path(spark, table, MANIFEST, name), overwrite_not)
    except Exception as error:
        files.delete(hidden, False)
        if "FileAlreadyExists" in str(error):
            raise VersionTaken(f"version {version.version} of {table} is there already; append again") from None
        raise


# ---- reading -------------------------------------------------------------------------------------------------------


def has_versions(spark: SparkSession, table: str) -> bool:
    return any(name.endswith(".json") and not name.startswith(".") for name in _names(spark, f"{table}/{MANIFEST}"))


def versions_of(spark: SparkSession, table: str, until: int | None = None) -> list[Version]:
    """The versions in order; none for a table without a manifest. One small file each, whatever the table's size."""
    files, found = _filesystem(spark, table), []
    for name in _names(spark, f"{table}/{MANIFEST}"):
        if name.endswith(".json") and not name.startswith(".") and (until is None or int(name[:-5]) <= until):
            stream = files.open(_path(spark, table, MANIFEST, name))
            found.append(Version(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))))
            stream.close()
    return found


def manifest_table(spark: SparkSession, table: str) -> DataFrame:
    """The manifest as a table: version, rows, unordered, batch, least_order, greatest_order, oldest, newest, n_files."""
    schema = "version long, rows long, unordered long, batch long, least_order string, greatest_order string, oldest string, newest string, files array<string>"
    found = spark.read.schema(schema).json(f"{table}/{MANIFEST}") if has_versions(spark, table) else spark.createDataFrame([], schema)
    return found.withColumn("n_files", F.size("files")).drop("files")


def read_versions(spark: SparkSession, table: str, until: int | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The rows of all committed versions (up to ``until``); files that no version names are not read."""
    found = versions_of(spark, table, until)
    reader = spark.read if schema is None else spark.read.schema(schema)
    paths = [f"{table}/{name}" for version in found for name in version.files]
    if not paths:
        raise ValueError(f"{table} has no version" + ("" if until is None else f" up to {until}"))
    return reader.option("mergeSchema", schema is None and len(found) > 1).parquet(*paths)


def marks_of(versions: list[Version]) -> Marks | None:
    """The high-water marks of a table: of its last version in the order of its rows. None without rows."""
    filled = [v for v in versions if v.rows]
    if not filled:
        return None
    last = max(filled, key=lambda v: (v.batch is not None, v.batch or 0, v.version))
    newest = max((v.newest for v in filled if v.newest is not None), default=None)
    batches = [v.batch for v in filled if v.batch is not None]
    date = last.marker.get("_date", [None, None])[1]
    return Marks(newest, date, max(batches, default=None), {k: v for k, v in last.marker.items() if k != "_date"}, sum(v.unordered for v in filled))


# ---- writing -------------------------------------------------------------------------------------------------------


def _described(df: DataFrame, version: int, files: list[str], date: str | None, keys: Keys | None) -> Version:
    """The entry of a version, by two small aggregates over its own rows."""
    ordered = ROW_ORD in df.columns
    order = F.col(ROW_ORD)
    struct = ordered and isinstance(df.schema[ROW_ORD].dataType, T.StructType)
    batch = F.max(f"{ROW_ORD}.batch") if struct and "batch" in df.schema[ROW_ORD].dataType.names else F.lit(None)
    dated = F.col(f"`{date}`") if date else F.lit(None)
    least, greatest = (F.min(order), F.max(order)) if ordered else (F.lit(None), F.lit(None))
    as_text = (lambda c: F.to_json(c)) if struct else (lambda c: c.cast("string"))
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count_if(order.isNull()) if ordered else F.count(F.lit(1))).alias("unordered"),
        batch.cast("bigint").alias("batch"),
        as_text(least).alias("least"),
        as_text(greatest).alias("greatest"),
        F.min(dated).cast("string").alias("oldest"),
        F.max(dated).cast("string").alias("newest"),
    ).first()
    marker: dict[str, list] = {}
    if keys and ordered and row["rows"] > row["unordered"]:
        values = keys(df) | ({"_date": dated} if date else {})
        last = df.select(order.alias("at"), *[v.alias(f"v{i}") for i, v in enumerate(values.values())])
        kinds = dict(last.dtypes)
        texts = F.struct(*[F.col(f"v{i}").cast("string").alias(f"v{i}") for i in range(len(values))])
        found = last.agg(F.max_by(texts, "at").alias("last")).first()["last"]
        marker = {name: [kinds[f"v{i}"], found[f"v{i}"]] for i, name in enumerate(values)}
    return Version(
        version, files, row["rows"], row["unordered"], row["batch"], row["least"], row["greatest"], row["oldest"], row["newest"], marker
    )


def adopt(spark: SparkSession, table: str, date: str | None = None, keys: Keys | None = None) -> list[Version]:
    """Give a folder of Parquet files its first manifest: the only time that the history itself is read."""
    files = [name for name in _names(spark, table) if not name.startswith(("_", "."))]
    df = spark.read.parquet(*[f"{table}/{name}" for name in files])
    first = _described(df, 0, files, date, keys)
    _filesystem(spark, table).mkdirs(_path(spark, table, MANIFEST))
    _commit(spark, table, first)
    return [first]


def append_version(df: DataFrame, table: str, date: str | None = None, keys: Keys | None = None) -> Version:
    """Add rows as a new version; nothing is committed if ``df`` has none.

    The rows are written to a hidden folder of the table and described there; then their files move beside the others
    and the manifest file is committed. A job that ends before leaves files that no version names, and the append can be
    done again. Rows with an order need a table in which all rows have one, which the manifest says. Two appends
    at once: one commits, the other raises ``VersionTaken``.
    """
    spark = df.sparkSession
    known = versions_of(spark, table) or adopt(spark, table, date, keys)
    if ROW_ORD in df.columns and any(v.unordered for v in known):
        raise UnorderedTable(f"{table} has rows without {ROW_ORD}; write it anew with its order first")
    mark = uuid.uuid4().hex
    staged = f"{table}/_staged-{mark}"
    df.write.parquet(staged)
    files = _filesystem(spark, table)
    names = [name for name in _names(spark, staged) if name.endswith(".parquet")]
    written = spark.read.schema(df.schema).parquet(staged)
    entry = _described(written, known[-1].version + 1, [f"{mark}-{name}" for name in names], date, keys)
    if entry.rows:
        for name in names:
            files.rename(_path(spark, staged, name), _path(spark, table, f"{mark}-{name}"))
        _commit(spark, table, entry)
    files.delete(_path(spark, staged), True)
    return entry
