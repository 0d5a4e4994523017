"""Versioned tables and sorted output."""

import os

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import resume
from tallyhouse.sources import readers, sinks, versions


def keys(df):
    return {"name": F.col("name"), "amount": F.col("amount"), "day": F.col("day")}


RULE = resume.ResumeRule(keys, "day")


def rows(spark, first, last, batch=0):
    """Rows whose order is (batch, place), with a null name in every seventh."""
    order = F.struct(F.lit(batch).cast("bigint").alias("batch"), F.col("id").alias("place"))
    return spark.range(first, last, 1, 3).select(
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("n"), F.col("id").cast("string"))).alias("name"),
        (F.col("id") / 4).cast("decimal(18,2)").alias("amount"),
        F.timestamp_add("HOUR", F.col("id"), F.lit("2025-01-01").cast("timestamp")).cast("timestamp_ntz").alias("day"),
        order.alias("row_ord"),
    )


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows(spark, 0, 50).write.parquet(path)
    return path


def ids(df):
    return sorted(r.place for r in df.select("row_ord.place").collect())


def test_appends_are_versions(spark, table):
    assert not versions.has_versions(spark, table) and versions.versions_of(spark, table) == []
    second = sinks.append_parquet(rows(spark, 50, 60, 1), table, "day", keys)
    assert (second.version, second.rows, second.batch, len(versions.versions_of(spark, table))) == (1, 10, 1, 2)
    third = sinks.append_parquet(rows(spark, 60, 61, 2), table, "day", keys)
    assert ids(versions.read_versions(spark, table)) == list(range(61)) == ids(spark.read.parquet(table))
    assert ids(versions.read_versions(spark, table, until=1)) == list(range(60))
    assert ids(readers.read_table(spark, table)) == list(range(61))
    marks = versions.marks_of(versions.versions_of(spark, table))
    assert (marks.batch, marks.newest, marks.unordered) == (2, third.newest, 0)
    assert marks.marker["name"] == ["string", "n60"] and marks.marker["amount"] == ["decimal(18,2)", "15.00"]
    known = versions.manifest_table(spark, table).orderBy("version").collect()
    assert [(r.version, r.rows, r.batch) for r in known] == [(0, 50, 0), (1, 10, 1), (2, 1, 2)]
    assert sinks.append_parquet(rows(spark, 0, 0, 3), table, "day", keys).rows == 0  # nothing to add, no version
    assert len(versions.versions_of(spark, table)) == 3 and not [n for n in os.listdir(table) if n.startswith("_staged")]


def test_crash_between_data_and_commit(spark, table, monkeypatch):
    """The rows of an append that did not commit are in no version, and the append can be done again."""
    versions.adopt(spark, table, "day", keys)

    def crash(*_):
        raise RuntimeError("lost")

    commit = versions._commit
    monkeypatch.setattr(versions, "_commit", crash)
    with pytest.raises(RuntimeError, match="lost"):
        sinks.append_parquet(rows(spark, 50, 60, 1), table, "day", keys)
    assert ids(versions.read_versions(spark, table)) == list(range(50))
    monkeypatch.setattr(versions, "_commit", commit)
    sinks.append_parquet(rows(spark, 50, 60, 1), table, "day", keys)
    assert ids(readers.read_table(spark, table)) == list(range(60))


def test_two_appends_at_once(spark, table, monkeypatch):
    versions.adopt(spark, table, "day", keys)
    before = versions.versions_of(spark, table)
    sinks.append_parquet(rows(spark, 50, 60, 1), table, "day", keys)
    monkeypatch.setattr(versions, "versions_of", lambda *_: before)  # as the slower of two saw the table
    with pytest.raises(versions.VersionTaken):
        sinks.append_parquet(rows(spark, 60, 70, 1), table, "day", keys)
    monkeypatch.undo()
    assert ids(versions.read_versions(spark, table)) == list(range(60))


def test_append_does_not_read_the_history(spark, table):
    """With a manifest, neither an append nor the resume point opens a file of the history."""
    versions.adopt(spark, table, "day", keys)
    for name in os.listdir(table):
        if name.endswith(".parquet"):
            with open(f"{table}/{name}", "wb") as file:
                file.write(b"not to be read")
    found = resume.resume_point_at(rows(spark, 40, 60, 1), RULE, versions.marks_of(versions.versions_of(spark, table)))
    assert (found["status"], found["new_rows"], found["place"]["place"]) == ("new_rows", 10, 49)
    assert sinks.append_parquet(rows(spark, 50, 60, 1), table, "day", keys).version == 1


@pytest.mark.parametrize("first, last", [(0, 50), (40, 60), (30, 50), (60, 70)])
def test_marks_agree_with_the_data(spark, table, first, last):
    """The resume point from the manifest is that of two scans of the history."""
    sinks.append_parquet(rows(spark, 50, 57, 1), table, "day", keys)  # the last row has a null name
    history, new = readers.read_table(spark, table), rows(spark, first, last, 9)
    marks = versions.marks_of(versions.versions_of(spark, table))
    assert resume.resume_point_at(new, RULE, marks) == resume.resume_point(new, history, RULE)


def test_empty_and_unordered_tables(spark, tmp_path):
    empty, plain = str(tmp_path / "empty"), str(tmp_path / "plain")
    rows(spark, 0, 0).write.parquet(empty)
    assert versions.marks_of(versions.adopt(spark, empty, "day", keys)) is None
    assert resume.resume_point_at(rows(spark, 0, 5), RULE, None)["status"] == "marker_missing"
    sinks.append_parquet(rows(spark, 0, 5), empty, "day", keys)
    assert ids(versions.read_versions(spark, empty)) == list(range(5))
    rows(spark, 0, 5).withColumn("row_ord", F.when(F.col("row_ord.place") > 0, F.col("row_ord"))).write.parquet(plain)
    with pytest.raises(sinks.UnorderedTable):
        sinks.append_parquet(rows(spark, 5, 9), plain, "day", keys)
    assert len(versions.versions_of(spark, plain)) == 1 and spark.read.parquet(plain).count() == 5


def test_sorted_output(spark, tmp_path):
    path = str(tmp_path / "sorted")
    values = spark.range(0, 5000, 1, 7).select(F.when(F.col("id") % 11 != 0, F.col("id") * 7919 % 1000).alias("k"), F.col("id").alias("v"))
    sinks.write_sorted(values, path, ["k", "v"], files=9)
    place = ["_metadata.file_name", "_metadata.row_index"]
    found = [(r.k, r.v) for r in spark.read.parquet(path).orderBy(*place).collect()]
    assert found == sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) and len(found) == 5000
    some = sinks.read_range(spark, path, "k", 100, 199)
    assert sorted(map(tuple, some.collect())) == [r for r in found if r[0] is not None and 100 <= r[0] <= 199]
    assert 0 < len(some.inputFiles()) < len(spark.read.parquet(path).inputFiles()) / 2
    assert sinks.read_range(spark, path, "k", 5000, 6000).count() == 0
    assert sinks.read_range(spark, path, "k", None, None).count() == 0
    empty = sinks.write_sorted(values.limit(0), str(tmp_path / "none"), ["k"])
    assert sinks.read_range(spark, empty, "k", 0, 9).count() == 0


def test_landed_folder(spark, tmp_path):
    from tallyhouse import rules
    from tallyhouse.sources import catalog

    chain, wholesale, pharmacy = (key for key, _ in rules.RETAILERS)
    for age, name in enumerate([f"FEB_{chain}.csv", f"MAR_{chain.lower()}.CSV", f"ENE_{wholesale}.txt", "ENE_OTHER.csv", "notes.csv"]):
        (tmp_path / name).write_text("a,b\n1,2\n")
        os.utime(tmp_path / name, (1_700_000_000 + age, 1_700_000_000 + age))
    listed = readers.landed_folder(spark, str(tmp_path))
    assert "content" not in listed.columns and {(r.file_name, r.size) for r in listed.collect()} >= {("notes.csv", 8)}
    assert catalog.newest_reports(spark, str(tmp_path)) == {chain: f"MAR_{chain.lower()}.CSV", wholesale: f"ENE_{wholesale}.txt", pharmacy: None}


def test_matrix_files_of_several_blocks(spark, tmp_path):
    """Lines are counted from the start of each file, whatever blocks a task reads."""
    from tallyhouse import rules

    names = rules.MATRIX_IDS
    for f, lines in enumerate([3000, 1, 700]):
        head = [f"line {i}" for i in range(rules.MATRIX_PREAMBLE_LINES)] + [",".join([*names, "Enero"]), ",".join([*[""] * len(names), "Cde."])]
        body = [",".join([*["x"] * (len(names) - 1), f"f{f}", str(i)]) for i in range(lines)]
        (tmp_path / f"f{f}.csv").write_text("\n".join(head + body) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        read, rejects = readers.read_month_matrix(spark, str(tmp_path))
        counts = {r[0]: (r[1], int(r[2])) for r in read.groupBy(names[-1]).agg(F.count(F.lit(1)), F.sum("`Enero|Cde.`")).collect()}
        assert counts == {"f0": (3000, 2999 * 1500), "f1": (1, 0), "f2": (700, 699 * 350)} and rejects.count() == 0
        assert "Window" not in read._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
