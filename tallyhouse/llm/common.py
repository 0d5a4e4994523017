"""Small helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_through

__all__ = ["connected_labels", "doc_hash", "free_name", "giving_back", "packed", "read_table", "text_bytes", "write_through"]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_bytes(text: str = "text") -> Column:
    """The text as UTF-8, a null as no bytes."""
    return F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")


def doc_hash(text: str = "text") -> Column:
    """With doc_id it names a row: rows that agree in both are repeats of one document."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def giving_back(run):
    """``run`` for ``mapInArrow``, after which the worker returns the memory of its task to the system.

    Workers are used again, and what a task of one stage took would stand beside all that later stages need.
    """

    def task(batches):
        import ctypes
        import gc

        import pyarrow as pa

        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim:
                trim(0)

    return task


def packed(df: DataFrame, name: str) -> DataFrame:
    """The binary column ``name`` as Zstandard frames, for texts that are written and shuffled; other columns pass."""

    def run(batches):
        import pyarrow as pa
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                place = part.schema.get_field_index(name)
                data = pa.array([None if x is None else pack(x) for x in part.column(place).to_pylist()], pa.binary())
                yield part.set_column(place, name, data)

    return df.mapInArrow(giving_back(run), df.schema)


def _signature(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()


def connected_labels(edges: DataFrame) -> DataFrame:
    """(u, v) links between longs -> (node, label): the smallest node that each node reaches.

    Large star and small star in turn (Kiveris et al. 2014): both keep the components and pull every node towards
    the smallest it sees, so a number of rounds logarithmic in the longest path is enough. A minimum is taken per
    node with a map-side combine and joined back, so that a node with many links is not gathered in one task. Each
    round is written to the shared folder.
    """
    links = edges.filter("u <> v").selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct()
    links = write_through(links, "links")
    before = _signature(links)
    while before[0]:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").selectExpr("v as u", "m as v")
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").selectExpr("v as u", "m as v")
        links = write_through(small.union(low.selectExpr("u", "m as v")).distinct(), "links")
        after = _signature(links)
        if after == before:
            break
        before = after
    stars = links.selectExpr("u as node", "v as label")
    return stars.union(stars.selectExpr("label as node", "label")).distinct()
