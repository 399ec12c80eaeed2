from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fiscalmill.functions import expr as E


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def dec(text, kind="decimal(21,10)"):
    return F.lit(text).cast(kind)


@pytest.mark.parametrize(
    "amount, decimals, width, expected",
    [
        ("0.125", 2, 6, "000012"),
        ("0.135", 2, 6, "000014"),
        ("1234567.89", 2, 17, "00000000123456789"),
        ("16777217", 2, 17, "00000001677721700"),
        ("-12", 0, 6, "000-12"),
        ("12345.67", 0, 4, "1234"),
        ("17", 6, 17, "00000000017000000"),
        ("0", 2, 5, "00000"),
    ],
)
def test_fixed_point(spark, amount, decimals, width, expected):
    assert value(spark, E.fixed_point(dec(amount), decimals, width)) == expected


def test_fixed_point_agrees_with_number_format(spark):
    amounts = spark.range(0, 4000).select(((F.col("id") - 2000) * dec("0.0125")).cast("decimal(18,4)").alias("v"))
    formatted = F.lpad(F.translate(F.format_number("v", 2), ".,", ""), 17, "0")
    assert amounts.where(E.fixed_point(F.col("v"), 2, 17) != formatted).count() == 0


def test_raw_digits_do_not_rescale(spark):
    assert value(spark, E.raw_digits(F.lit("100.5"), 6)) == "001005"
    assert value(spark, E.raw_digits(F.lit("1.234,50"), 8)) == "00123450"
    assert value(spark, E.raw_digits(F.lit(None).cast("string"), 6)) is None


def test_avulsa_amount(spark):
    present, absent = F.lit("1"), F.lit(None).cast("string")
    assert value(spark, E.avulsa_amount(present, present, dec("5"))) == 0
    assert value(spark, E.avulsa_amount(present, absent, dec("5"))) == 5
    assert value(spark, E.avulsa_amount(absent, present, dec(None))) == 0


def test_partner_code(spark):
    none = F.lit(None).cast("string")
    assert value(spark, E.partner_code(F.lit("12345678000195"), F.lit("99999999999"))) == "M123456780195"
    assert value(spark, E.partner_code(none, F.lit("12345678901"))) == "M123456788901"
    assert value(spark, E.partner_code(none, none)) is None


def test_issue_date_keeps_the_day_of_the_document(spark):
    assert value(spark, E.issue_date(F.lit("2022-08-15T23:11:12-03:00"))) == "20220815"
    assert value(spark, E.issue_date(F.lit("soon"))) is None


def test_classes(spark):
    none = F.lit(None).cast("string")
    assert value(spark, E.header_class(F.lit("1"), F.lit("57"), "57")) == "NFE"
    assert value(spark, E.header_class(none, F.lit("57"), "57")) == "YD"
    assert value(spark, E.header_class(none, F.lit("67"), "57")) == "YJ"
    assert value(spark, E.header_class(none, none, "57")) == "YJ"


def test_situation_of_a_missing_tax(spark):
    assert value(spark, E.situation_code(dec(None))) == "41"
    assert value(spark, E.situation_code(dec("0"))) == "41"
    assert value(spark, E.tribute_code(dec("0.01"))) == "3"


def test_slices(spark):
    key = F.lit("3524" + "0" * 18 + "007" + "000012345" + "0" * 10)
    assert value(spark, E.key_number(key)) == "000012345"
    assert value(spark, E.key_series(key)) == "007"
    assert value(spark, E.municipality(F.lit("3550308"))) == "50308"
    assert value(spark, E.document_number(F.lit("1234567890"), F.lit(None))) == "123456789"
    assert value(spark, E.product_key(F.lit("1069000"))) == "01069000"
    assert value(spark, E.product_key(F.lit("104011200"))) == "104011200"
    assert value(spark, E.padded_issuer_id(F.lit(None).cast("string"), F.lit("123"))) == "00000000123"


def test_tax_base_reads_missing_as_zero(spark):
    from fiscalmill.sources.schema import item_ddl

    item = F.from_json(
        F.lit(
            '{"prod": {"vProd": 10.00, "vDesc": 1.50, "vFrete": 0.25}, '
            '"imposto": {"ICMS": {"ICMS10": {"vICMSST": 2.00}, "ICMSSN900": {"vICMSST": 9.00, "vFCPST": 0.75}}}}'
        ),
        item_ddl(),
    )
    assert value(spark, E.tax_base(item)) == Decimal("11.50")
    assert value(spark, E.tax_base(F.from_json(F.lit('{"prod": {"vDesc": 1.50}}'), item_ddl()))) is None
