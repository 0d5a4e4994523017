"""The family of suffix arrays, kept in a folder: batches that arrive later are scanned against all earlier ones.

A folder holds the levels, and of every batch its runs and its texts. What belongs to it is said by the newest state,
a small table of its own that is written last: a batch whose scan ended early leaves the state before, and can be scanned
again. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_hash, giving_back, text_bytes, write_through
from .suffix_dedup import _N_BITS, PREFIX, SuffixFamily, _packed, _repeated_windows, _unpacked, suffix_entries

_STATE = "version int, buckets int, length int, prefix int, level int, table string, batch string"


class KeptFamily(SuffixFamily):
    """A family whose levels outlive the session; arrays that a merge replaces go when the new state is there."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None, levels: dict[int, str]):
        super().__init__(spark)
        self.folder, self.buckets, self.replaced = folder, buckets or self.buckets, []
        for rank, table in levels.items():
            self.levels[rank] = table
            if not spark.catalog.tableExists(table):
                spark.sql(
                    f"CREATE TABLE {table} (a BIGINT, lo BIGINT, hi BIGINT, n BIGINT) USING parquet "
                    f"CLUSTERED BY (a) SORTED BY (a) INTO {self.buckets} BUCKETS LOCATION '{self._path(table)}'"
                )

    def _path(self, table: str) -> str:
        return f"{self.folder}/levels/{table}"

    def _discard(self, table: str) -> None:
        self.replaced.append(table)

    def settle(self) -> None:
        """Delete what the last merges replaced."""
        for table in self.replaced:
            super()._discard(table)
        self.replaced = []


def _folders(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().toString() for f in files.listStatus(path)] if files.exists(path) else []


def _state(spark: SparkSession, folder: str) -> list:
    """The rows of the newest state that was written to its end; none, before the first batch."""
    whole = [f for f in _folders(spark, f"{folder}/state") if any(x.endswith("/_SUCCESS") for x in _folders(spark, f))]
    return spark.read.schema(_STATE).json(max(whole)).collect() if whole else []  # one row a level and batch


def scan_batch(docs: DataFrame, folder: str, length: int = 400, prefix: int = PREFIX) -> DataFrame:
    """doc_id, h, start, end of the new documents' bytes in strings of ``length`` bytes that also start anywhere else.

    Anywhere else is the same text, another document of the batch, or one of any batch that ``folder`` holds; the batch
    is kept there then. A span is a run of such strings; spans of a document may touch or overlap. Earlier documents
    get no new spans. A batch given twice repeats itself. Texts shorter than ``length``, null and empty ones have no
    spans; null ids stay null and, like repeated ones, are told apart by their text, of which h is a hash. Rows that
    agree in both give each span once. An empty batch has no rows and is kept like others; other columns are ignored.
    Another length or prefix than the folder's is an error.
    """
    spark = docs.sparkSession
    state = _state(spark, folder)
    if state and (state[0]["length"], state[0]["prefix"]) != (length, prefix):
        raise ValueError(f"{folder} holds strings of {state[0]['length']} bytes by {state[0]['prefix']}")
    levels = {r["level"]: r["table"] for r in state if r["table"] is not None}
    family = KeptFamily(spark, folder, state[0]["buckets"] if state else None, levels)
    batches = [r["batch"] for r in state if r["batch"] is not None]
    batch = uuid.uuid4().hex
    batches.append(batch)

    suffix_entries(docs, length, prefix, 1).drop("batch").write.parquet(f"{folder}/runs/{batch}")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_hash().alias("h"), text_bytes().alias("data"))
    keyed = keyed.filter(F.length("data") >= length).mapInArrow(giving_back(_packed), "doc_id long, h long, data binary")
    keyed.write.parquet(f"{folder}/texts/{batch}")

    new = spark.read.parquet(f"{folder}/runs/{batch}")
    shared = family.add(new.select("a", "c")).groupBy("a").agg((F.min("lo") != F.max("hi")).alias("mixed"))
    shared = write_through(shared, "shared")
    runs = spark.read.parquet(*(f"{folder}/runs/{b}" for b in batches)).join(shared.filter("mixed"), "a")
    runs = write_through(runs, "runs")
    owners = runs.select("doc_id", "h").distinct()
    texts = spark.read.parquet(*(f"{folder}/texts/{b}" for b in batches))
    same = texts["doc_id"].eqNullSafe(owners["doc_id"]) & (texts["h"] == owners["h"])
    texts = write_through(texts.join(owners, same, "left_semi"), "texts")
    texts = texts.mapInArrow(giving_back(_unpacked), "doc_id long, h long, data binary")
    windows = _repeated_windows(spark, runs, texts, length)
    met = new.join(shared, "a")
    n = F.shiftright("shape", _N_BITS)
    even = met.filter("not mixed").select("doc_id", "h", "start", (F.col("start") + n - 1 + length).alias("end"))
    uneven = met.filter("mixed").select("doc_id", "h", "a", "c", "start").join(windows, ["a", "c"])
    uneven = uneven.select(
        "doc_id", "h", (F.col("start") + F.col("lo")).alias("start"), (F.col("start") + F.col("hi") + length).alias("end")
    )
    spans = write_through(even.union(uneven).distinct(), "spans")

    version = (state[0]["version"] if state else 0) + 1
    said = [(level, table, None) for level, table in family.levels.items()] + [(None, None, b) for b in batches]
    rows = [(version, family.buckets, length, prefix, *x) for x in said]
    spark.createDataFrame(rows, _STATE).coalesce(1).write.mode("overwrite").json(f"{folder}/state/{version:09d}")
    family.settle()
    return spans
