"""Column builders against golden rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.functions import calendar, products, stores, text
from tallyhouse.plans import rfm


def values(spark, rows, kinds, *builders):
    """Apply each builder to the columns a, b, … of ``rows``; one tuple per row."""
    names = [chr(ord("a") + i) for i in range(len(rows[0]))]
    ddl = ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds.split()))
    df = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], ddl + ", i int")
    columns = [F.col(name) for name in names]
    out = df.select("i", *[builder(*columns).alias(f"r{k}") for k, builder in enumerate(builders)])
    return [tuple(row)[1:] for row in sorted(out.collect(), key=lambda row: row.i)]


PRODUCTS = [
    ("NAT JABO AVENA X 12UND", "12UND", "NAT JABON AVENA"),
    ("jde crem x 400ml", "400ML", "JDE CREMA X 400ML"),
    ("BOX12 GEL", "12", "BOX12 GEL"),
    ("NAT ACEITE X 2 UND", "2", "NAT ACEITE"),
    ("NAT SALES BANO", "1UND", "NAT SALE BANO"),
    ("NAT JAB 15GR X 12UND X 32PQ", "12UND", "NAT JAB 15GR"),
    ("GEL X48UND", "48UND", "GEL"),
    ("EFERV ACTI", "1UND", "EFER ACTI"),
    ("NAT GEL DUCH", "1UND", "NAT GEL DUCHA"),
    ("NAT  GEL DUCH", "1UND", "NAT GEL DUCH"),
    ("CREM\u00a0X 5GR", "5GR", "CREMA"),
    ("  SHAM KER\tX 1LT ", "1LT", "SHAM KERA"),
    (None, "NA", None),
]


def test_pack_and_product(spark):
    df = spark.createDataFrame([(d,) for d, _, _ in PRODUCTS], "`Desc.item` string")
    rows = products.with_pack_and_product(df, "Desc.item", "pack", "product").collect()
    assert {tuple(row) for row in rows} == set(PRODUCTS)


def test_ignore_case_is_an_option(spark):
    loose = rules.ProductRules(ignore_case_in_name=True)
    df = spark.createDataFrame([("jde crem x 400ml",)], "d string")
    rows = products.with_pack_and_product(df, "d", "pack", "product", loose).collect()
    assert [row.product for row in rows] == ["JDE CREMA"]


def test_has_pack(spark):
    rows = [("A X 1",), ("A x1",), ("BOX12",), (None,)]
    assert values(spark, rows, "string", products.has_pack) == [(True,), (True,), (False,), (False,)]


def test_normalize_pack_rules(spark):
    rows = [("2 UND",), (" 500 ml ",), ("400  ML",), ("",), ("  ",), (None,)]
    expected = [("2UND",), ("500ML",), ("400 ML",), ("NA",), ("NA",), ("NA",)]
    assert values(spark, rows, "string", products.normalize_pack) == expected


def test_brand(spark):
    rows = [("JDE CREMA", None), ("JDE CREMA", "X"), ("jde crema", None), ("ZZZ", None), (None, None), ("NAT", "")]
    expected = [(rules.BRAND_PREFIXES[1][1],), ("X",), (None,), (None,), (None,), ("",)]
    assert values(spark, rows, "string string", products.brand_from_prefix) == expected


def test_sold_units(spark):
    customer, brand = rules.WHOLESALER, rules.BRAND_PREFIXES[0][1]
    rows = [
        (10, customer, brand, "48UND"),
        (10, customer, brand, "6UND"),
        (10, customer, brand, "12UND"),
        (10, customer, "other", "48UND"),
        (10, None, brand, "48UND"),
        (-10, customer, brand, "6UND"),
    ]
    found = values(spark, rows, "bigint string string string", products.sold_units)
    assert found == [(480,), (60,), (240,), (10,), (10,), (-60,)]


def test_store_city_chain(spark):
    rows = [
        ("EXITO POBLADO - MEDELLIN",),
        ("A - B - C",),
        (" CARULLA PLAZA CLARO ",),
        ("OLIMPICA",),
        ("A -",),
        ("-B",),
        (None,),
    ]
    expected = [
        ("EXITO POBLADO", "MEDELLIN"),
        ("A", "B"),
        ("CARULLA PLAZA CLARO", "BOGOTA"),
        ("OLIMPICA", rules.UNKNOWN_CITY),
        ("A", ""),
        ("", "B"),
    ]
    found = values(spark, rows, "string", stores.store_city_chain)
    assert [tuple(row[0]) for row in found[:-1]] == expected
    assert found[-1] == (None,)


def test_store_city_wholesale(spark):
    rows = [
        ("014-Makro Calle 30",),
        ("07-Cali - Norte",),
        ("CALI - NORTE",),
        ("03-Villa - Del Rio - Bogota",),
        ("05-Pereira",),
        ("pereira",),
        ("1-estacion poblado",),
        (None,),
    ]
    expected = [
        ("MAKRO CALLE 30", "SOLEDAD"),
        ("NORTE", "CALI"),
        (rules.ONLY_STORE, "NORTE"),
        ("VILLA - DEL RIO", "BOGOTA"),
        (rules.ONLY_STORE, "PEREIRA"),
        (rules.ONLY_STORE, "PEREIRA"),
        ("ESTACION POBLADO", "MEDELLIN"),
        ("", ""),
    ]
    assert [tuple(row[0]) for row in values(spark, rows, "string", stores.store_city_wholesale)] == expected


def test_canonical_key(spark):
    rows = [
        ("1 234,50",),
        ("1234.0",),
        ("1500000",),
        ("120000",),
        ("00000",),
        (" nan ",),
        ("None",),
        ("",),
        (None,),
        ("A \t B",),
    ]
    expected = ["123450", "12340", "15", "120000", "00000", None, None, None, None, "AB"]
    assert [row[0] for row in values(spark, rows, "string", text.canonical_key)] == expected


def test_reference_key(spark):
    rows = [(" Ré-F Ñ1 ",), ("ﬁn½",), ("中A",), ("ÅÉ",), ("Ａ",), (None,), ("plain",)]
    expected = ["refn1", "fin12", "a", "ae", "a", "", "plain"]
    assert [row[0] for row in values(spark, rows, "string", text.reference_key)] == expected


def test_tax_id_and_decimal(spark):
    assert values(spark, [("900-1-2",), ("900",), (None,)], "string", text.tax_id_root) == [("900",), ("900",), (None,)]
    found = values(spark, [("1,5",), ("1.25",), ("x",), (None,), (" 7 ",)], "string", text.decimal_comma)
    assert [None if v is None else float(v) for (v,) in found] == [1.5, 1.25, None, None, 7.0]


def test_dates(spark):
    rows = [("2025-01-03",), (" 2025-01-03 10:00:00 ",), ("03/01/2025",), ("x",), (None,)]
    first = datetime.datetime(2025, 1, 3)
    found = values(spark, rows, "string", calendar.parse_timestamp)
    assert [row[0] for row in found] == [first, first.replace(hour=10), None, None, None]
    formats = ("dd/MM/yyyy", "yyyy-MM-dd")
    found = values(spark, rows, "string", lambda c: calendar.parse_timestamp(c, formats))
    assert [row[0] for row in found] == [first, None, first, None, None]


def test_strict_dates_fail(spark):
    with pytest.raises(Exception, match="not a date"):
        values(spark, [("x",)], "string", calendar.parse_timestamp_strict)
    assert values(spark, [(None,)], "string", calendar.parse_timestamp_strict) == [(None,)]


def test_whole_days(spark):
    rows = [
        ("2025-01-10 00:00:00", "2025-01-09 12:00:00"),
        ("2025-01-10 00:00:00", "2025-01-10 12:00:00"),
        ("2025-01-10 00:00:00", "2025-01-08 00:00:00"),
        ("2025-01-10 00:00:00", "2025-01-11 00:00:00"),
    ]
    days = lambda a, b: calendar.whole_days_between(a.cast("timestamp_ntz"), b.cast("timestamp_ntz"))
    assert [row[0] for row in values(spark, rows, "string string", days)] == [0, -1, 2, -1]


def test_week_labels(spark):
    monday = lambda c: calendar.week_start(c.cast("timestamp_ntz"))
    found = values(
        spark,
        [("2025-01-01 23:59:00",), ("2024-12-30",), ("2025-01-05",)],
        "string",
        monday,
        lambda c: calendar.month_name(monday(c)),
        lambda c: calendar.month_number_text(monday(c)),
    )
    assert found == [(datetime.date(2024, 12, 30), "diciembre", "12")] * 3


def test_months(spark):
    rows = [(2024, "DIC"), (2024, "ENE"), (2024, "XXX")]
    following = lambda y, m: calendar.next_month(y, calendar.month_number_of_code(m))
    found = values(spark, rows, "int string", following, lambda y, m: calendar.month_full_name(m))
    assert found == [
        (datetime.date(2025, 1, 1), "Diciembre"),
        (datetime.date(2024, 2, 1), "Enero"),
        (None, None),
    ]


def test_segments_cover_all_scores(spark):
    digits = range(1, 6)
    assert set(rules.SEGMENT_OF_SCORE) == {100 * a + 10 * b + c for a in digits for b in digits for c in digits}
    found = values(spark, [(555,), (111,), (214,), (600,), (None,)], "int", rfm.segment_of)
    assert [row[0] for row in found] == ["Campeones", "Inactivos", "Ballenas", "No clasificado", "No clasificado"]
