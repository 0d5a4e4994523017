"""Ranks, order statistics and scores against pandas, on skewed groups and ties."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import ranking
from tallyhouse.operators.ranking import order_statistics, rank_in_group, rank_sorted, sort_once
from tallyhouse.plans import rfm


@pytest.fixture(scope="module")
def metrics(spark):
    """Nine of ten customers in one channel, most of them with one purchase, amounts with many ties and negatives."""
    df = spark.range(0, 6000, 1, 16).select(
        F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 20 == 9, "warm").otherwise("cold").alias("canal"),
        F.format_string("C%05d", F.pmod(F.xxhash64("id"), F.lit(10**9)) * 6000 + F.col("id")).alias("customer_id"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(700)).cast("int").alias("recency_days"),
        (F.floor(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(13)) / 9) + 1).cast("bigint").alias("purchase_dates"),
        (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(10**7)) * F.lit(10**5) - 10**11).alias("cents"),
    )
    return df.unionByName(df.limit(0)).cache()


def expected_scores(frame: pd.DataFrame) -> pd.DataFrame:
    out = []
    for _, group in frame.groupby("canal"):
        group = group.sort_values("customer_id").copy()
        group["r"] = pd.qcut(group.recency_days, 5, labels=[5, 4, 3, 2, 1]).astype(int)
        group["f"] = pd.qcut(group.purchase_dates.rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
        group["m"] = pd.qcut(group.cents, 5, labels=[1, 2, 3, 4, 5]).astype(int)
        out.append(group)
    return pd.concat(out)


def test_scores_equal_pandas(metrics):
    found = rfm.rfm_scores(metrics).toPandas()
    both = expected_scores(metrics.toPandas()).merge(found, on=["canal", "customer_id"])
    assert len(both) == len(found) == metrics.count()
    assert (both.r == both.recency_score).all()
    assert (both.f == both.frequency_score).all()
    assert (both.m == both.monetary_score).all()
    assert found.rfm_score.between(111, 555).all()


@pytest.mark.parametrize("parts", [1, 17])
def test_rank_does_not_depend_on_partitions(metrics, parts):
    ranked = rank_in_group(metrics.repartition(parts), "canal", ["purchase_dates", "customer_id"]).toPandas()
    ordered = ranked.sort_values(["canal", "purchase_dates", "customer_id"])
    assert (ordered["rank"] == ordered.groupby("canal").cumcount() + 1).all()


def test_ranks_over_many_sorting_tasks(spark, metrics):
    """The hot channel is sorted by several tasks, and one task sorts the end of a channel and the start of the next."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ordered = sort_once(metrics, "canal", ["purchase_dates", "customer_id"])
        tasks = ordered.select("canal", F.shiftright("_seq", 33).alias("task")).distinct().toPandas()
        assert (tasks[tasks.canal == "hot"].task.nunique() > 5) and (len(tasks) > tasks.task.nunique())
        ranked = rank_sorted(ordered, "canal").toPandas()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    ordered = ranked.sort_values(["canal", "purchase_dates", "customer_id"])
    assert len(ordered) == 6000
    assert (ordered["rank"] == ordered.groupby("canal").cumcount() + 1).all()


@pytest.mark.parametrize("bits", [5, 16, 40])
def test_passes_agree(metrics, monkeypatch, bits):
    """Counting in many, some or one pass gives the values at the positions."""
    monkeypatch.setattr(ranking, "BITS", bits)
    frame = metrics.toPandas()
    for row in order_statistics(metrics, "canal", ["recency_days", "cents"]).collect():
        values = sorted(frame[frame.canal == row.canal][row.measure])
        low, rest = divmod((len(values) - 1) * row.k, 5)
        assert (row.n, row.remainder, row.low, row.high) == (len(values), rest, values[low], values[low + (rest > 0)])


def test_cuts_equal_pandas(metrics):
    cuts = rfm.quintile_cuts(metrics).toPandas()
    frame = metrics.toPandas()
    for row in cuts.itertuples():
        group = frame[frame.canal == row.canal]
        values = {
            "recency": group.recency_days,
            "monetary": group.cents / 100000,
            "frequency": group.purchase_dates.rank(method="first"),
        }[row.measure]
        assert row.cut == pytest.approx(values.quantile(row.k / 5), rel=1e-12)
    assert len(cuts) == 3 * 3 * 4


def scored(spark, rows, **options):
    df = spark.createDataFrame(rows, "customer_id string, recency_days int, purchase_dates bigint, cents bigint")
    found = rfm.rfm_scores(df.withColumn("canal", F.lit("x")), **options).orderBy("customer_id").collect()
    return [(row.recency_score, row.frequency_score, row.monetary_score) for row in found]


def test_small_groups(spark):
    assert scored(spark, [("a", 1, 1, 1), ("b", 2, 2, 2)]) == [(5, 1, 1), (1, 5, 5)]
    assert scored(spark, [("a", 1, 1, 1)]) == [(5, 1, 1)]
    seven = [(f"c{i}", i, 3, i) for i in range(7)]
    assert [f for _, f, _ in scored(spark, seven)] == [1, 1, 2, 3, 4, 5, 5]
    tied = [(f"c{i}", i, i, v) for i, v in enumerate([1, 1, 1, 1, 2, 3])]
    assert [m for _, _, m in scored(spark, tied)] == [1, 1, 1, 1, 4, 5]


def test_no_customers(spark):
    assert scored(spark, []) == []


def test_ties_can_fail(spark):
    tied = [(f"c{i}", i, i, v) for i, v in enumerate([1, 1, 1, 1, 2, 3])]
    with pytest.raises(Exception, match="equal quintile edges"):
        scored(spark, tied, on_ties="error")
    distinct = [(f"c{i}", i, i, i) for i in range(7)]
    assert scored(spark, distinct, on_ties="error") == scored(spark, distinct)


@pytest.mark.parametrize(
    "values", [[-(2**62), 0, 2**62], [-(2**63), -1, 0, 5, 2**63 - 1], [2**63 - 1, 2**63 - 2], [-(2**63)], [-(2**62) - 1, 2**62, 2**62]]
)
def test_order_statistics_of_any_width(spark, values):
    df = spark.createDataFrame([("g", v, 1) for v in values], "g string, v long, w long")
    rows = {(r.measure, r.k): (r.low, r.high, r.n) for r in order_statistics(df, "g", ["v", "w"]).collect()}
    ordered, n = sorted(values), len(values)
    for k in range(6):
        at, rest = divmod((n - 1) * k, 5)
        assert rows["v", k] == (ordered[at], ordered[at + (rest > 0)], n) and rows["w", k] == (1, 1, n)
