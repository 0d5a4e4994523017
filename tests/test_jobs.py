"""The jobs on delimited files, from reading to writing."""

import csv

import pytest
from pyspark.sql import functions as F

from tallyhouse import rules, session
from tallyhouse.jobs import __main__ as cli
from tallyhouse.plans import sales
from tallyhouse.sources import catalog, readers, sinks
from tallyhouse.streaming import landing

BRAND = rules.BRAND_PREFIXES[0][1]
SALES_HEADER = [
    "Fecha", "Marca", "Linea de mercado", "Razon social", "Referencia", "Desc. item", "EAN 13", "U.M.", "Nit",
    "Cantidad inv.", "Valor bruto local",
]


def write(path, lines, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding=encoding) as out:
        csv.writer(out).writerows(lines)
    return str(path)


def sale(i, units="2"):
    return [
        f"2025-02-{1 + i // 10:02d}", "" if i % 2 else BRAND, "003", f"C{i}", "7", "NAT JABO X 6UND", "77", "UND", "9-1",
        units, f"{i},50",
    ]


def test_csv_order_survives_splits(spark, tmp_path):
    path = write(tmp_path / "long.csv", [["n", "text"]] + [[i, "x" * 40] for i in range(20000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        table = readers.read_text_table(spark, path)
        assert table.rdd.getNumPartitions() > 8
        numbers = [int(row.n) for row in table.repartition(5).orderBy("row_ord").collect()]
        assert numbers == list(range(20000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parquet_order(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(1000).coalesce(1).write.parquet(path)
    numbers = [row.id for row in readers.read_parquet(spark, path).repartition(7).orderBy("row_ord").collect()]
    assert numbers == list(range(1000))


def test_sinks_refuse_their_input(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_parquet(spark.range(1), path)
    with pytest.raises(ValueError):
        sinks.write_parquet(spark.range(1), path + "/", inputs=[None, path])
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        sinks.write_parquet(spark.range(1), path)


def test_refresh_job(spark, tmp_path):
    first = write(tmp_path / "first.csv", [SALES_HEADER] + [sale(i) for i in range(40)])
    second = write(tmp_path / "second.csv", [SALES_HEADER] + [sale(i) for i in range(20, 90)] + [sale(90, "1.5"), ["?", *sale(91)[1:]]])
    start = sales.enrich_sales(catalog.load_sales_tables(spark, first, first).new)
    start = start.withColumns({"Cantidad inv.": F.col("`Cantidad inv.`").cast("bigint")}).withColumnsRenamed(
        {"EAN 13": "EAN"}
    )
    history = str(tmp_path / "history")
    start.write.parquet(history)
    unordered = str(tmp_path / "unordered")
    start.drop("row_ord").coalesce(1).write.parquet(unordered)

    people = write(tmp_path / "people.csv", [["tipo", "nit", "razon_social"], ["N", " 9", "A"], ["N", "9", "B"]])
    months = [["7", "a", "i", "u", "1.0", "Enero", "2025"]]
    header = ["Referencia", "Desc.item", "Instalación", "U.M.", "Costo prom.", "Mes", "Año"]
    old_costs = write(tmp_path / "costs.csv", [header] + months)
    new_header = ["Marca", "Referencia", "Desc. item", "Instalación", "U.M.", "Costo prom. uni.", "Mes", "Año"]
    new_costs = write(
        tmp_path / "new.csv", [new_header] + [["B", "7", "a", "i", "u", "2.0", m, "2025"] for m in ("Febrero", "Marzo")]
    )
    family = write(tmp_path / "family.csv", [["Referencia", "Marca"], ["7", "F"]])

    def run(out, history, new, *more):
        return cli.main(
            ["refresh", "--history", history, "--new", new, "--customers", people, "--costs-history", old_costs,
             "--costs-new", new_costs, "--family", family, "--out", str(tmp_path / out), *more]
        )

    result = run("out1", history, second, "--no-append")
    assert result["sales"]["status"] == "new_rows"
    assert result["sales"]["added"] == 50
    assert result["customers"] == {"status": "ok", "customers": 1}
    assert result["costs"]["rows"] == 2
    refreshed = spark.read.parquet(str(tmp_path / "out1/sales"))
    order = [row["Razon social"] for row in refreshed.orderBy("row_ord").collect()]
    assert order == [f"C{i}" for i in range(90)]
    assert spark.read.parquet(str(tmp_path / "out1/weekly_purchases")).agg(F.sum("numCompras")).first()[0] == 90
    rejects = spark.read.parquet(str(tmp_path / "out1/sales_without_units"))
    assert [row["Cantidad inv."] for row in rejects.collect()] == ["1.5"]
    untyped = spark.read.parquet(str(tmp_path / "out1/sales_untyped"))
    assert [(row["Fecha"], row["Razon social"]) for row in untyped.collect()] == [("?", "C91")]

    third = write(tmp_path / "third.csv", [SALES_HEADER] + [sale(i) for i in range(20, 90)])
    again = run("out2", str(tmp_path / "out1/sales"), third)
    assert again["sales"]["status"] == "nothing_new"
    assert again["weekly"]["rows"] == result["weekly"]["rows"]
    missing = run("out3", str(tmp_path / "out1/sales"), first)
    assert missing["sales"]["status"] == "marker_missing"
    with pytest.raises(sinks.UnorderedTable):
        run("out6", unordered, second)
    assert result["sales"]["untyped"] == 1 and result["sales"]["dropped_columns"] == []
    appended = run("out4", history, second)
    assert appended["sales"]["added"] == 50
    assert spark.read.parquet(history).count() == 90
    assert run("out5", history, third)["sales"]["status"] == "nothing_new"


def test_sellout_job(spark, tmp_path):
    chain, wholesale, pharmacy = (key for key, _ in rules.RETAILERS)
    history = write(
        tmp_path / "history.csv",
        [["Mes", "año", "cliente", "Unidades", "NumMes"], ["FEB", 2025, rules.CHAIN, 5, 2],
         ["DIC", 2024, rules.WHOLESALER, 6, 12], ["MAY", 2025, rules.PHARMACY, 7, 5]],
    )
    folder = tmp_path / "landed"
    write(
        folder / f"MAR_{chain}.csv",
        [["EAN", "Fecha", "Nomb. Dependencia", "Descripción", "Unidades"], ["1", "2025-03-01", "A - B", "GEL", 4],
         ["1", "2025-03-02", "A - B", "GEL", 3], ["1", "2025-03-02", "", "GEL", 3]],
    )
    upper = ["", "Descripción del artículo", "Número de artículo Makro", "Codigo de barras", "Tienda", "Enero", "", "Febrero"]
    lower = ["", "", "", "", "", "Cde.", "Inv.", "Cde."]
    write(
        folder / f"ENE_{wholesale}.csv",
        [[f"line {i}"] for i in range(18)] + [upper, lower]
        + [["x", "GEL", "9", "770", "01-A - B", 5, 1, 9], ["x", "GEL", "9", "770", "01-A - B", 6, 1, 9],
           ["x", "GEL", "", "770", "01-A - B", 7, 1, 9]],
    )
    write(
        folder / f"JUL_{pharmacy}.csv",
        [["UPC", "NOMBRE_TIENDA", "CIUDAD", "DESCRIPCION_ITEM", "UNIDADES_VENDIDAS", "SUP_NAME"], ["1", "T", "C", "G", 4, "S"]],
    )
    result = cli.main(
        ["sellout", "--history", history, "--folder", str(folder), "--chain", f"MAR_{chain}.csv",
         "--wholesale", f"ENE_{wholesale}.csv", "--pharmacy", f"JUL_{pharmacy}.csv", "--out", str(tmp_path / "out")]
    )
    assert {row["client_key"]: row["reason"] for row in result["gate"]} == {
        chain: "ok", wholesale: "ok", pharmacy: "unexpected_month",
    }
    summary = spark.read.parquet(str(tmp_path / "out/sellout"))
    added = {(r["Mes"], r["año"], r["cliente"], r["Unidades"], r["NumMes"]) for r in summary.collect()}
    assert {("MAR", 2025, rules.CHAIN, 7, 3), ("ENE", 2025, rules.WHOLESALER, 11, 1)} < added
    assert len(added) == 5
    cities = spark.read.parquet(str(tmp_path / "out/sellout_cities"))
    assert {(r["EAN"], r["Mes"], r["Tienda"], r["Ciudad"], r["Unidades"]) for r in cities.collect()} == {
        ("1", "march", "A", "B", 7), ("770", "enero", "A", "B", 11),
    }


def test_segments_job(spark, tmp_path):
    sold = write(
        tmp_path / "sales.csv",
        [["Nit", "Referencia", "Linea de mercado", "Fecha", "Valor bruto local"]]
        + [[f"{i % 7}-1", "7", rules.CHANNELS[i % 2], f"2025-01-{1 + i:02d}", f"{i},25"] for i in range(28)],
    )
    people = write(tmp_path / "people.csv", [["Tipo", "NIT", "Razón social"]] + [["N", i, f"P{i}"] for i in range(6)])
    out = tmp_path / "out"
    result = cli.main(
        ["segments", "--sales", sold, "--customers", people, "--as-of", "2025-03-01", "--out", str(out)]
    )
    assert result == {
        "segments": 12, "sales_without_customer": 4, "revenue_without_customer": 6 + 13 + 20 + 27 + 1.0, "untyped": 0,
    }
    assert spark.read.option("header", True).csv(str(out / "segments_csv")).count() == 12


def test_stream_takes_each_file_once(spark, tmp_path):
    landed, out = tmp_path / "landed", str(tmp_path / "enriched")

    def run():
        query = landing.enrich_landed(spark, str(landed), SALES_HEADER, out, f"sales-{tmp_path.name}")
        query.awaitTermination()
        return spark.read.parquet(out)

    write(landed / "a.csv", [SALES_HEADER] + [sale(i) for i in range(10)])
    assert run().count() == 10
    write(landed / "b.csv", [SALES_HEADER] + [sale(i) for i in range(10, 15)])
    # what was done is known beside the output, and not in a folder of the session
    assert (tmp_path / "enriched.checkpoint").is_dir()
    enriched = run()
    assert enriched.count() == 15
    assert {(r["Marca"], r["Producto"], r["Cantidades"]) for r in enriched.collect()} == {(BRAND, "NAT JABON", "6UND")}


def test_stream_rejects(spark, tmp_path):
    landed = tmp_path / "landed"
    rows = [sale(0, "4"), sale(1, "4.0"), sale(2, "1.5"), sale(3, "x"), ["?", *sale(4)[1:]]]
    write(landed / "a.csv", [SALES_HEADER] + rows)
    name = f"r-{tmp_path.name}"
    landing.enrich_landed(spark, str(landed), SALES_HEADER, str(tmp_path / "out"), name).awaitTermination()
    landing.reject_landed(spark, str(landed), SALES_HEADER, str(tmp_path / "bad"), name).awaitTermination()
    assert {r["Cantidad inv."] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {4}
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted((r["Fecha"], r["Cantidad inv."]) for r in bad) == [("2025-02-01", "1.5"), ("2025-02-01", "x"), ("?", "2")]


def test_marker_with_units_as_sheets_write_them(spark, tmp_path):
    first = write(tmp_path / "first.csv", [SALES_HEADER] + [sale(i, "4") for i in range(5)])
    second = write(tmp_path / "second.csv", [SALES_HEADER] + [sale(i, "4.0") for i in range(8)])
    start = sales.enrich_sales(catalog.load_sales_tables(spark, first, first).new)
    start = start.withColumns({"Cantidad inv.": F.col("`Cantidad inv.`").cast("bigint")}).withColumnsRenamed({"EAN 13": "EAN"})
    history = str(tmp_path / "history")
    start.write.parquet(history)
    result = cli.main(["refresh", "--history", history, "--new", second, "--out", str(tmp_path / "out")])
    assert (result["sales"]["status"], result["sales"]["added"]) == ("new_rows", 3)


def matrix(path, rows, lower=("", "", "", "", "", "Cde.", "Cde.")):
    upper = ["", "Descripción del artículo", "Número de artículo Makro", "Codigo de barras", "Tienda", "Enero", "Febrero"]
    return write(path, [["line"]] * 18 + [upper, list(lower)] + rows)


def test_month_matrix(spark, tmp_path):
    row = ["x", "GEL", "9", "770", "01-A - B"]
    folder = tmp_path / "two"
    matrix(folder / "a.csv", [[*row, "1.5", "2,5"], [*row, "1.234,5", "1"]])
    matrix(folder / "b.csv", [[*row, "", "7"]])
    rows, rejects = readers.read_month_matrix(spark, str(folder))
    assert sorted((r["Tienda"], r["Enero|Cde."] or 0, r["Febrero|Cde."]) for r in rows.filter("`Febrero|Cde.` > 1").collect()) == [
        ("01-A - B", 0, 7), ("01-A - B", 1.5, 2.5),
    ]
    assert [r["Enero|Cde."] for r in rejects.collect()] == ["1.234,5"]
    matrix(folder / "c.csv", [], ("", "", "", "", "", "Cde.", "Inv."))
    with pytest.raises(readers.UnreadableMatrix):
        readers.read_month_matrix(spark, str(folder))
    torn = matrix(tmp_path / "torn.csv", [["x", "GEL\nB", "9", "770", "01-A", "1", "2"]])
    with pytest.raises(Exception, match="line break"):
        readers.read_month_matrix(spark, torn)[0].collect()


def test_one_bad_report_does_not_stop_the_others(spark, tmp_path):
    chain, wholesale, pharmacy = (key for key, _ in rules.RETAILERS)
    history = write(
        tmp_path / "history.csv",
        [["Mes", "año", "cliente", "Unidades", "NumMes"], ["FEB", 2025, rules.CHAIN, 5, 2],
         ["DIC", 2024, rules.WHOLESALER, 6, 12], ["MAY", 2025, rules.PHARMACY, 7, 5], ["XXX", 2025, rules.PHARMACY, 7, 5]],
    )
    folder = tmp_path / "landed"
    write(
        folder / f"MAR_{chain}.csv",
        [["EAN", "Fecha", "Nomb. Dependencia", "Descripción", "Unidades"], ["1", "2025-03-01", "A - B", "GEL", "1.5"],
         ["1", "2025-03-01", "C - B", "GEL", "1.5"], ["1", "2025-04-01", "C - B", "GEL", "2"]],
    )
    write(
        folder / f"JUN_{pharmacy}.csv",
        [["UPC", "NOMBRE_TIENDA", "CIUDAD", "DESCRIPCION_ITEM", "UNIDADES_VENDIDAS", "SUP_NAME"],
         ["1", "T", "C", "G", "4 u", "S"], ["1", "T", "C", "G", "3", "S"]],
    )
    result = cli.main(
        ["sellout", "--history", history, "--folder", str(folder), "--chain", f"MAR_{chain}.csv",
         "--wholesale", f"ENE_{wholesale}.csv", "--pharmacy", f"JUN_{pharmacy}.csv", "--out", str(tmp_path / "out")]
    )
    assert result["failures"] == {wholesale: "no such file"} and result["reports"] == 2
    assert result["untyped"] == {chain: 0, pharmacy: 1}
    assert (result["other_months"], result["unknown_months"]) == (1, 1)
    summary = {r["cliente"]: r["Unidades"] for r in spark.read.parquet(str(tmp_path / "out/sellout")).collect() if r["Mes"] in ("MAR", "JUN")}
    assert summary == {rules.CHAIN: 5, rules.PHARMACY: 3}  # 1.5 + 1.5 + 2, cut once


def test_dialect(spark, tmp_path):
    sold = tmp_path / "sales.csv"
    with open(sold, "w", encoding="latin-1") as out:
        out.write("Nit;Referencia;Línea de mercado;Fecha;Valor bruto local\n")
        out.writelines(f"{i % 3}-1;7;{rules.CHANNELS[0]};{1 + i:02d}/01/2025;{i},25\n" for i in range(9))
        out.write(f"1-1;7;{rules.CHANNELS[0]};2025/31/01;1,25\n")
    people = tmp_path / "people.csv"
    with open(people, "w", encoding="latin-1") as out:
        out.write("Tipo;NIT;Razón social\nN;0;\nN;0;Peña\nN;1;B\nN;2;C\n")
    result = cli.main(
        ["segments", "--sales", str(sold), "--customers", str(people), "--as-of", "2025-03-01", "--out", str(tmp_path / "out"),
         "--sep", ";", "--encoding", "ISO-8859-1", "--date-format", "dd/MM/yyyy"]
    )
    assert (result["segments"], result["sales_without_customer"], result["untyped"]) == (3, 0, 1)
    assert "Peña" in {r["id_cliente"] for r in spark.read.parquet(str(tmp_path / "out/segments")).collect()}


def test_scratch_tables_go_with_their_run(spark):
    import os

    with session.scratch_run(spark):
        written = session.write_through(spark.range(5), "five")
        path = written.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path) and path.startswith(session.scratch_root(spark))
        assert written.count() == 5
    assert not os.path.exists(path)
