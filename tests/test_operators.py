"""Order-sensitive operators under any partitioning, and properties that hold for all data."""

import pytest
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.functions import text
from tallyhouse.operators import columns, lookup, periods, reshape, resume
from tallyhouse.operators.dedup import first_by_key
from tallyhouse.plans import costs, customers, rfm, sales, sellout, weekly
from tallyhouse.schemas import MissingColumns, apply_types, require_columns, untyped_rows
from tallyhouse.session import write_through
from tallyhouse.workload import tables as workload_tables
from tallyhouse.workload.queries import QUERIES

PARTITIONS = [1, 17]
BRAND = rules.BRAND_PREFIXES[0][1]


def rows(df, *order):
    return [tuple(row) for row in (df.orderBy(*order) if order else df).collect()]


# ------------------------------------------------------------------ order
@pytest.fixture(scope="module")
def export(spark):
    """A sales export of 300 rows over 30 days; rows 100 and 101 are copies."""
    df = spark.range(300).select(
        F.date_add(F.lit("2025-01-02").cast("date"), F.floor(F.col("id") / 10).cast("int")).cast("timestamp_ntz").alias(
            "Fecha"
        ),
        F.when(F.col("id") % 3 > 0, BRAND).alias("Marca"),
        F.lit("003").alias("Linea de mercado"),
        F.when(F.col("id") % 50 == 0, None).otherwise(F.format_string("C%d", F.col("id"))).alias("Razon social"),
        F.lit("NAT JABO X 6UND").alias("Desc. item"),
        F.lit("77").alias("EAN 13"),
        F.when(F.col("id") == 299, "x").otherwise("3").alias("Cantidad inv."),
        (F.col("id") / 4).cast("decimal(18,2)").alias("Valor bruto local"),
        F.col("id").alias("row_ord"),
    )
    copy = df.filter("row_ord = 100").withColumn("row_ord", F.lit(101).cast("bigint"))
    return write_through(df.filter("row_ord <> 101").unionByName(copy), "export")


def history_upto(export, last):
    return (
        export.filter(F.col("row_ord") <= last)
        .withColumn("Marca", F.lit(BRAND))
        .withColumn("Cantidad inv.", F.lit(3).cast("bigint"))
        .withColumnsRenamed({"Desc. item": "Desc.item", "EAN 13": "EAN"})
    )


@pytest.mark.parametrize("parts", PARTITIONS)
@pytest.mark.parametrize("last, first_new", [(99, 100), (101, 101), (150, 151), (200, 201)])
def test_resume_goes_on_after_the_first_match(export, parts, last, first_new):
    history = history_upto(export, last).repartition(parts)
    found = sales.new_sales(export.repartition(parts), history)
    assert [row.row_ord for row in found.orderBy("row_ord").collect()] == list(range(first_new, 300))


@pytest.mark.parametrize("parts", PARTITIONS)
def test_resume_status(export, parts):
    rule = sales.marker_rule()
    whole = export.repartition(parts)

    def status(new, history):
        return resume.resume_status(new, history, rule).first()

    assert status(whole, history_upto(export, 150)).status == "new_rows"
    assert status(whole, history_upto(export, 150)).new_rows == 149
    assert status(whole.filter("row_ord <= 150"), history_upto(export, 150)).status == "nothing_new"
    gone = status(whole.filter("row_ord <> 150"), history_upto(export, 150))
    assert (gone.status, gone.new_rows) == ("marker_missing", 0)
    assert sales.new_sales(whole.filter("row_ord <> 150"), history_upto(export, 150)).count() == 0


def test_refresh_twice_adds_nothing(export):
    history = history_upto(export, 250)
    once = write_through(sales.refresh_sales(export, history), "once")
    added = once.filter(F.col("Cantidades").isNotNull()).collect()
    assert {(r["Cantidades"], r["Producto"], r["Marca"], r["Cantidad inv.sell_Int"]) for r in added} == {
        ("6UND", "NAT JABON", BRAND, 3)
    }
    assert [row.row_ord for row in once.orderBy("row_ord").collect()] == list(range(299))
    again = sales.refresh_sales(export.filter("row_ord < 299"), once)
    assert again.count() == once.count()
    assert sales.without_units(export).count() == 1


def test_enrichment_keeps_the_first_columns(export):
    wide = export.select("*", *[F.lit(i).alias(f"extra {i}") for i in range(10)])
    enriched = sales.enrich_sales(wide)
    assert enriched.columns[3] == "Tipo de identificacion"
    assert enriched.columns[12:] == ["Cantidades", "Producto", "Cantidad inv.sell_Int", "row_ord"]
    cut = sales.enrich_sales(wide, "2025-01-02 00:00:00")
    assert cut.agg(F.min("Fecha")).first()[0].isoformat() == "2025-01-03T00:00:00"


@pytest.mark.parametrize("parts", PARTITIONS)
def test_first_by_key(spark, parts):
    df = spark.createDataFrame(
        [(" 1", "b", 2), ("1 ", "a", 1), (None, "d", 4), (None, "c", 3), ("2", None, 5)],
        "nit string, razon_social string, row_ord bigint",
    )
    once = customers.dedup_customers(df.repartition(parts))
    assert rows(once, "row_ord") == [("1", "a", 1), (None, "c", 3), ("2", None, 5)]
    assert rows(first_by_key(once, ["nit"], "row_ord"), "row_ord") == rows(once, "row_ord")


# ------------------------------------------------------------------ joins
def test_null_keys_find_nothing_and_are_spread(spark):
    facts = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.lit("k")).alias("nit"), "id")
    table = spark.createDataFrame([("k", "name"), (None, "nobody")], "nit string, razon_social string")
    joined = lookup.left_lookup(facts, table, "nit")
    assert joined.columns == ["nit", "id", "razon_social"]
    assert joined.count() == 5000
    assert joined.filter("nit is null and razon_social is not null").count() == 0
    assert joined.filter("nit = 'k' and razon_social = 'name'").count() == facts.filter("nit = 'k'").count()


def test_excluded_and_missing_references_go(spark):
    df = spark.createDataFrame([("10133",), ("1",), (None,), ("1501",)], "referencia string")
    assert rows(lookup.exclude_values(df, "referencia", rules.EXCLUDED_REFERENCES)) == [("1",)]
    numbers = spark.createDataFrame([(10133,), (1,)], "referencia int")
    assert rows(lookup.exclude_values(numbers, "referencia", rules.EXCLUDED_REFERENCES)) == [(1,)]


@pytest.fixture(scope="module")
def raw(spark):
    sold = spark.createDataFrame(
        [
            ("1-9", "7", "A", "2025-01-01", "10,50"),
            ("1", "7", "A", "2025-01-01", "1.25"),
            ("1-2", "7", "A", "2025-01-02", "x"),
            ("1", "10133", "A", "2025-01-03", "99"),
            ("2", "7", "A", "2025-01-01", "5"),
            (None, "7", "A", "2025-01-01", "5"),
            ("3", "7", "A", "?", "5"),
            ("3", "7", "B", "2025-01-04", "5"),
        ],
        "Nit string, Referencia string, `Linea de mercado` string, Fecha string, `Valor bruto local` string",
    )
    people = spark.createDataFrame(
        [("NIT", "1-0", "ONE"), ("CC", "1", "ONE BIS"), ("NIT", "3", "THREE"), ("NIT", "3", "THREE"), ("X", None, "N")],
        "Tipo string, `NIT.` string, `Razón Social` string",
    ).withColumn("row_ord", F.monotonically_increasing_id())
    return sold, people


def test_revenue_before_and_after_the_join(raw):
    """Summing by tax id before the join gives what summing the joined rows gives, with one or more names per id."""
    clean = rfm.clean_sales(raw[0])
    for single in (True, False):
        register = rfm.clean_customers(raw[1], single)
        joined = rfm.daily_revenue(rfm.sales_with_customer(clean, register))
        summed = rfm.daily_revenue_of(clean, register)
        keys = ["canal", "customer_id", "order_date"]
        assert rows(summed, *keys) == rows(joined, *keys)
    single = rfm.daily_revenue_of(clean, rfm.clean_customers(raw[1]))
    found = [(r.canal, r.customer_id, str(r.order_date)[:10], r.cents) for r in single.orderBy(*keys).collect()]
    assert found == [
        ("A", "ONE", "2025-01-01", 1175),
        ("A", "ONE", "2025-01-02", 0),
        ("B", "THREE", "2025-01-04", 500),
    ]


def test_unmatched(raw):
    clean, register = rfm.clean_sales(raw[0]), rfm.clean_customers(raw[1])
    assert sorted((r.nit or "") for r in rfm.unmatched_customers(clean, register).collect()) == ["", "2"]


def test_segments_from_raw_tables(raw):
    found = rfm.segment_customers(*raw, as_of="2025-01-10", channels=("A", "B"))
    assert {(r.canal, r.id_cliente, r.dias_recencia, r.num_transacciones, r.monto) for r in found.collect()} == {
        ("A", "ONE", 8, 2, 0.01175),
        ("B", "THREE", 6, 1, 0.005),
    }
    every = rfm.segment_customers(*raw, as_of="2025-01-10", channels=None)
    assert sorted(map(str, every.collect())) == sorted(map(str, found.collect()))


# ------------------------------------------------------------------ columns
def test_headers():
    assert columns.plain_name("Razón Social No.") == "razon_social_no"
    assert columns.tidy_name("  Valor   (bruto) local. ") == "Valor bruto local."


def test_column_lists(spark):
    df = spark.createDataFrame([(1, None, None), (None, None, None)], "a int, `b.x` string, c string")
    assert columns.drop_all_null_columns(df).columns == ["a"]
    assert rows(columns.drop_all_null_rows(df)) == [(1, None, None)]
    assert columns.rename_by_position(df, ["x", "y", "z"]).columns == ["x", "y", "z"]
    with pytest.raises(ValueError):
        columns.rename_by_position(df, ["x"])
    assert columns.insert_column(df, 1, "n", F.lit(0), keep=3).columns == ["a", "n", "b.x"]
    assert columns.union_present([None, None]) is None


def test_required_columns_and_types(spark):
    df = spark.createDataFrame([(" 1.0", "1,5", "x"), ("1.5", "2", None)], "n string, d string, t string")
    schema = {"n": "bigint", "d": "decimal(18,2)", "t": "timestamp_ntz"}
    typed = apply_types(df, schema)
    assert [tuple(map(str, r)) for r in typed.collect()] == [("1", "1.50", "None"), ("None", "2.00", "None")]
    assert untyped_rows(df, schema).count() == 2
    with pytest.raises(MissingColumns):
        require_columns(df, ["Unidades"])
    with pytest.raises(MissingColumns):
        sellout.chain(df, sellout.Period(2025, 1))


def test_weeks_without_optional_columns(spark):
    df = spark.createDataFrame([("2025-01-01",), ("2025-01-05",), ("2025-01-06",), (None,), ("x",)], "Fecha string")
    found = [(r["Año"], r["Mes"], str(r["Semana"]), r["numCompras"]) for r in weekly.weekly_purchase_count(df).collect()]
    assert sorted(found) == [("2024", "diciembre", "2024-12-30", 2), ("2025", "enero", "2025-01-06", 1)]


# ------------------------------------------------------------------ sell-out
@pytest.fixture(scope="module")
def matrix(spark):
    ids = ", ".join(f"`{name}` string" for name in rules.MATRIX_IDS)
    return spark.createDataFrame(
        [
            ("01-A - B", "9", "GEL", "770", 5, 1, None),
            ("01-A - B", "9", "GEL", "770", 3, 1, 0),
            ("02-C", "9", "GEL", "771", -2, 1, 7),
            ("02-C", " ", "GEL", "771", 100, 1, 100),
            (None, "9", "GEL", "771", 100, 1, 100),
        ],
        f"{ids}, `Enero|Cde.` bigint, `Enero|Inv.` bigint, `Febrero|Cde.` bigint",
    )


def test_unpivot_keeps_the_sum(matrix):
    long = reshape.unpivot_months(matrix, rules.MATRIX_IDS)
    assert long.agg(F.sum("Unidades")).first()[0] == 5 + 3 - 2 + 7
    assert {row.Mes for row in long.collect()} == {"enero", "febrero"}


def test_wholesale_reads_one_month(matrix):
    report = sellout.wholesale(matrix, sellout.Period(2025, 1))
    assert rows(report.detail.select("EAN", "Mes", "Tienda", "Ciudad", "Unidades", "NumMes"), "EAN") == [
        ("770", "enero", "A", "B", 8, 1),
        ("771", "enero", rules.ONLY_STORE, "C", -2, 1),
    ]
    assert rows(report.summary) == [("ENE", 2025, rules.WHOLESALER, 6, 1)]
    plan = report.detail._jdf.queryExecution().optimizedPlan().toString()
    assert "Febrero" not in plan.split("LogicalRDD")[0]
    assert sellout.wholesale(matrix, sellout.Period(2025, 3)).summary.first().Unidades == 0


def test_totals_and_null_keys(spark):
    sold = spark.createDataFrame(
        [("1", "2025-03-01", "A - B", "GEL", 4), ("1", "2025-03-02", "A - B", None, 8), ("1", "x", "A - B", "GEL", 16),
         ("1", "2025-03-01", " ", "GEL", 32), ("1", "2025-04-01", "A - B", "GEL", None)],
        "EAN string, Fecha string, `Nomb. Dependencia` string, `Descripción` string, Unidades bigint",
    )
    report = sellout.chain(sold, sellout.Period(2025, 3))
    assert rows(report.summary) == [("MAR", 2025, rules.CHAIN, 4, 3)]
    assert rows(report.detail.select("Mes", "Unidades"), "Mes") == [("april", 0), ("march", 4)]
    assert sellout.other_months(report.detail).count() == 1
    lines = spark.createDataFrame(
        [("1", "T", "C", "GEL", 4, "S"), ("1", "T", None, "GEL", 8, "S")],
        "UPC string, NOMBRE_TIENDA string, CIUDAD string, DESCRIPCION_ITEM string, UNIDADES_VENDIDAS bigint, SUP_NAME string",
    )
    assert rows(report.summary_of(report.detail)) == rows(report.summary)
    report = sellout.pharmacy(lines, sellout.Period(2025, 3))
    assert rows(report.summary_of(report.detail)) == rows(report.summary)
    assert report.summary.first().Unidades == 12
    assert report.detail.first().Unidades == 4
    assert sellout.append_details(None, [None, None]) is None


@pytest.mark.parametrize("parts", PARTITIONS)
def test_last_period(spark, parts):
    history = spark.createDataFrame(
        [("DIC", 2024, "X", 1, 1), ("ENE", 2024, "X", 2, 2), ("DIC", 2024, "X", 3, 3), ("???", 2030, "X", 4, 4)],
        "Mes string, `año` int, cliente string, Unidades bigint, row_ord bigint",
    )
    last = periods.last_period(history.repartition(parts)).first()
    assert tuple(last) == ("X", "DIC", 2024, "DIC 2024", 3, 3, "ENE", 2025)
    assert periods.unknown_months(history).count() == 1
    assert sellout.due_periods(history.repartition(parts), ("X",)) == {"X": sellout.Period(2025, 1)}
    with pytest.raises(sellout.NoHistory):
        sellout.due_periods(history, ("X", "Y"))


def test_gate(spark):
    history = spark.createDataFrame(
        [("DIC", 2024, rules.CHAIN, 1), ("MAY", 2025, rules.PHARMACY, 1)],
        "Mes string, `año` int, cliente string, Unidades bigint",
    )
    chain, wholesale, pharmacy = (key for key, _ in rules.RETAILERS)

    def reason(key, name):
        files = spark.createDataFrame([(key, name)], "client_key string, file_name string")
        return {r.client_key: (r.processable, r.reason) for r in periods.period_gate(files, history).collect()}[key]

    assert reason(pharmacy, f"JUN_{pharmacy}.xlsx") == (True, "ok")
    assert reason(pharmacy, f"jun_{pharmacy.lower()}.xlsx") == (True, "ok")
    assert reason(pharmacy, f"XXX_{pharmacy}.xlsx") == (False, "bad_month")
    assert reason(pharmacy, f"JUN{pharmacy}.xlsx") == (False, "bad_format")
    assert reason(pharmacy, f"JUN_{chain}.xlsx") == (False, "wrong_client")
    assert reason(pharmacy, None) == (False, "no_file")
    assert reason(chain, f"DIC_{chain}.xlsx") == (False, "already_processed")
    assert reason(chain, f"MAR_{chain}.xlsx") == (False, "unexpected_month")
    assert reason(chain, f"JUL_{chain}.xlsx") == (False, "unexpected_month")
    assert reason(wholesale, f"MAR_{wholesale}.xlsx") == (False, "no_history")


# ------------------------------------------------------------------ costs
@pytest.fixture(scope="module")
def cost_tables(spark):
    body = "Referencia string, `Desc.item` string, `Instalación` string, `U.M.` string, `Costo prom.` double, Mes string, `Año` int"
    history = spark.createDataFrame(
        [("1", "a", "i", "u", 1.0, "Noviembre", 2025), ("2", "b", "i", "u", 2.0, "enero", 2024),
         (None, "c", "i", "u", 3.0, "enero", 2026)], body)
    new = spark.createDataFrame(
        [("B", "1", "a", "i", "u", 9.0, " DICIEMBRE ", 2025), ("B", "1", "a", "i", "u", 9.0, "Enero", 2025)],
        "Marca string, Referencia string, `Desc. item` string, `Instalación` string, `U.M.` string, `Costo prom. uni.` double, Mes string, `Año` int",
    )
    family = spark.createDataFrame([("1", "F", "Si"), (None, "N", "No")],
                                   "Referencia string, Marca string, `Incluir referencia(Si/No)` string")
    return history, new, family


def test_costs(cost_tables):
    history, new, family = cost_tables
    result = costs.consolidate_costs(history, new, family, 2025)
    assert result.columns == costs.OUTPUT
    found = {(r["Referencia"], r["Mes"].strip(), r["Año"], r["Marca"]) for r in result.collect()}
    kept = {("1", "Noviembre", 2025, "F"), ("2", "enero", 2024, None), (None, "enero", 2026, None)}
    assert found == kept | {("1", "DICIEMBRE", 2025, "B")}
    strict = costs.consolidate_costs(history, new, family, 2025, drop_later_years=True)
    assert strict.count() == 3
    nothing_fits = costs.consolidate_costs(history, new.filter("`Año` = 1"), family, 2025, drop_later_years=True)
    assert nothing_fits.count() == 3
    assert costs.consolidate_costs(history, None, family) is history


def test_costs_without_the_year(cost_tables):
    history, new, family = cost_tables
    assert costs.new_costs(new, history.filter("`Año` = 2024"), 2025).count() == 2
    december = history.withColumn("Mes", F.lit("diciembre"))
    assert tuple(costs.next_cost_period(december, 2025).first()) == (1, 1, 2026)


def test_clean_cell_keeps_null(spark):
    df = spark.createDataFrame([(None,), ("  a  b ",)], "c string")
    assert rows(df.select(text.clean_cell(F.col("c")).alias("c")), "c") == [(None,), ("a b",)]


# ------------------------------------------------------------------ plans
def test_hot_key_of_a_join_is_split(spark):
    """A key with a third of the rows: the sort-merge join of the lookup splits it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("nit"),
            F.sha2(F.col("id").cast("string"), 256).alias("body"),
        )
        table = spark.range(300_000).select(F.col("id").cast("string").alias("nit"), F.lit("n").alias("razon_social"))
        joined = lookup.left_lookup(facts, table.unionByName(table.limit(1).withColumn("nit", F.lit("hot"))), "nit")
        assert joined.filter("razon_social is not null").count() == 300_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_clean_table_of_odd_columns(spark):
    """A column without a type goes, one of texts for "missing" stays, and an empty sheet keeps what is kept."""
    from tallyhouse.operators import cells

    sheet = spark.sql("select 1 as row_ord, null as v, 'NaN' as m, 2.5D as d union all select 2, null, 'NaN', null")
    assert cells.clean_table(sheet, keep=("row_ord",)).dtypes == [("row_ord", "int"), ("m", "string"), ("d", "double")]
    assert rows(cells.clean_table(sheet, keep=("row_ord",)), "row_ord") == [(1, None, 2.5), (2, None, None)]
    assert cells.clean_table(sheet.limit(0), keep=("row_ord",)).columns == ["row_ord"]


def test_clean_table(spark):
    from tallyhouse.operators import cells

    sheet = spark.createDataFrame(
        [(1, " 1 234,50 ", "x", "7", None, "1e3"), (2, "nan", "NaN", None, None, "2"), (3, None, None, None, None, None)],
        "row_ord int, ` Valor   (bruto)` string, t string, n string, nothing string, e string",
    )
    clean = cells.clean_table(sheet, keep=("row_ord",))
    assert clean.dtypes == [("row_ord", "int"), ("Valor bruto", "bigint"), ("t", "string"), ("n", "bigint"), ("e", "double")]
    assert rows(clean, "row_ord") == [(1, 123450, "x", 7, 1000.0), (2, None, None, None, 2.0)]


def test_codes_are_no_numbers(spark):
    from tallyhouse.operators.cells import number_columns

    rows = [("12D", "1e3", "7", "NaN", "-1.5"), ("12F", "2.5", "8", "1", None)]
    found = dict(number_columns(spark.createDataFrame(rows, "code string, d string, n string, w string, x string")).dtypes)
    assert found == {"code": "string", "d": "double", "n": "bigint", "w": "string", "x": "double"}


def test_first_customer_row_with_a_name(spark):
    from tallyhouse.plans import rfm

    rows = [("N", "9-1", None, 1), ("N", "9-1", " ", 2), ("N", "9-1", "ACME", 3), ("N", "9-1", "OTHER", 4), ("N", "8", None, 5)]
    register = spark.createDataFrame(rows, "t string, n string, r string, row_ord int")
    assert {tuple(r) for r in rfm.clean_customers(register).collect()} == {("9", "ACME"), ("8", None)}


def test_word_rules_are_literal(spark):
    from tallyhouse.functions.text import replace_words

    rules_ = (("USD", "US$"), ("A\\EB", "back\\slash"))
    df = spark.createDataFrame([("10 USD A\\EB",)], "t string")
    assert df.select(replace_words(F.col("t"), rules_)).first()[0] == "10 US$ back\\slash"


def test_codes_keep_their_digits(spark):
    from tallyhouse.operators.cells import number_columns

    rows = [("9999999999999999999", "1234567890123456789", "12345678901234567890.123456789012345678", "0.5", "1" * 39),
            ("-7", "12345678901234567890", "1.5", "1e3", "2")]
    found = number_columns(spark.createDataFrame(rows, "a string, b string, c string, d string, e string"))
    assert [kind for _, kind in found.dtypes] == ["decimal(38,0)", "decimal(38,0)", "decimal(38,18)", "double", "double"]
    assert [str(r.a) for r in found.collect()] == ["9999999999999999999", "-7"]
    assert {str(r.b) for r in found.collect()} == {"1234567890123456789", "12345678901234567890"}
    assert "12345678901234567890.123456789012345678" in {str(r.c) for r in found.collect()}


def test_whole_numbers_beyond_64_bits_are_rejects(spark):
    cells = ["9223372036854775807", "9223372036854775808", "-9223372036854775809", "9223372036854775808.0", "4.0", "1" * 40, "x"]
    df = spark.createDataFrame([(c,) for c in cells], "units string")
    assert [r.units for r in apply_types(df, {"units": "bigint"}).collect()] == [2**63 - 1, None, None, None, 4, None, None]
    assert untyped_rows(df, {"units": "bigint"}).count() == 5


# ------------------------------------------------------------------ what moves
@pytest.fixture
def no_small_tables(spark):
    """As if every table were too large to be broadcast by its size."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_sales_stay_where_they_lie_for_their_descriptions(export, no_small_tables, monkeypatch):
    """A catalogue of known, small size goes to the sales; a larger one meets them in a shuffle, with the same rows."""
    near = sales.enrich_sales(export)
    assert "SortMergeJoin" not in near._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(sales, "BROADCAST_TEXTS", 0)
    far = sales.enrich_sales(export)
    assert "SortMergeJoin" in far._jdf.queryExecution().executedPlan().toString()
    assert rows(near, "row_ord") == rows(far, "row_ord") != []


def small_tables(spark, folder, suppliers):
    """A line for each supplier, with an order, a customer and a part of its own."""
    ids = spark.range(1, suppliers + 1)
    day = F.expr("timestamp_ntz'1999-03-05 00:00:00'")
    lines = ids.selectExpr(
        "id as l_orderkey", "id as l_partkey", "id as l_suppkey", "1 as l_linenumber", "double(id % 9 + 1) as l_quantity",
        "10.5D as l_extendedprice", "0.0D as l_discount", "0.0D as l_tax", "'N' as l_returnflag",
    ).withColumn("l_shipdate", day)
    named = {
        "lineitem": lines,
        "part": ids.selectExpr("id as p_partkey", "'soap' as p_name", "'B' as p_brand", "'SMALL' as p_type", "int(id % 50) as p_size"),
        "supplier": ids.selectExpr("id as s_suppkey", "concat('S', id) as s_name", "int(id % 25) as s_nationkey"),
        "nation": spark.range(25).selectExpr("int(id) as n_nationkey", "concat('N', id) as n_name"),
        "orders": ids.selectExpr("id as o_orderkey", "id as o_custkey").withColumn("o_orderdate", day),
        "customer": ids.selectExpr("id as c_custkey", "concat('C', id) as c_name", "'MACHINERY' as c_mktsegment"),
    }
    for name, table in named.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return workload_tables.Tables(spark, str(folder))


def test_lines_move_once_for_orders_and_customers(spark, tmp_path, no_small_tables):
    export = workload_tables.line_export(small_tables(spark, tmp_path, 30))
    joins = [line for line in export._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    on_lines = [line for line in joins if "l_" in line]
    assert (len(joins), len(on_lines)) == (3, 2) and joins[-1] not in on_lines
    assert export.count() == 30


def test_matrix_files_are_few(spark, tmp_path):
    """Suppliers share files: each file has the lines before the header and the header once, and no row is lost."""
    t = small_tables(spark, tmp_path, 1000)
    lines = workload_tables.matrix_lines(t)
    assert lines.select("file").distinct().count() == 10
    head = lines.groupBy("file", "place").count().filter(F.col("place") < rules.MATRIX_PREAMBLE_LINES + rules.MATRIX_HEADER_LINES)
    assert {r["count"] for r in head.collect()} == {1}
    found, expected = (QUERIES[name](spark, str(tmp_path)) for name in ("month_matrix_files", "unpivot_month_matrix"))
    assert sorted(map(repr, rows(found))) == sorted(map(repr, rows(expected))) != []
