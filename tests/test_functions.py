"""Column functions against tables of cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.functions import dates, numbers, text

MONEY = {
    "1.234,56": 1234.56, "1,234.56": 1234.56, "1.234.567": 1234567.0, "1,234,567": 1234567.0, "12,5": 12.5, "12.5": 12.5, "R$ 10,00": 10.0, "-5": -5.0, "1-2": None, "abc": None, "": None, "nan": None, None: None, " 7 ": 7.0, "1.234.567,8": 1234567.8,
}
DATES = {"16/01/1997": (1997, 1, 16), "1/2/2024": (2024, 2, 1), "2024-02-01": (2024, 2, 1), "31/02/2024": None, "32/01/2024": None, "": None, None: None}


def apply(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (numbers.money, MONEY),
        (lambda c: dates.ledger_date(c).cast("date"), {k: v and dt.date(*v) for k, v in DATES.items()}),
        (dates.registry_date, {"20240229": dt.date(2024, 2, 29), "20240230": None, "0": None, "00000000": None, "": None, None: None, "2024": None}),
        (dates.registry_date_invalid, {"20240229": False, "20240230": True, "0": False, "": False, "2024": True}),
        (text.clean, {"  a\t": "a", " b ": "b", "": None, " nan ": None, "<NA>": None, "NaN": None, None: None}),
        (text.full_key, {"07.075.587/0001-47": "07075587000147", "XXX123.456XX": None, "1234567890123": None, " ": None, None: None}),
        (lambda c: text.fixed_digits(c, 8), {"123": "00000123", "123456789": None, "abc": None, "": None, None: None, "12-3": "00000123"}),
        (text.company_root, {"123": "00000123", "abc": None, "123456789": None}),
        (lambda c: text.company_root(c, empty_is_zero=True), {"abc": "00000000", "123456789": None, None: None}),
        (text.state, {" sp ": "SP", "EXT": None, "": None}),
        (text.lookup_root, {"12.345.678/0001-00": "12345678", "12345678": "12345678", "1234567": None, "x": None, None: None}),
        (text.yes_no, {"SIM": 1, "s": 1, "1": 1, "NAO": 0, "NÃO": 0, "false": 0, "talvez": None, None: None}),
        (text.situation, {"Em cobrança": "irregular", "Benefício Fiscal": "beneficio_fiscal", "Em negociação": "negociacao", "Suspenso": "suspenso_judicial", "Garantia": "garantia", "cobrança com garantia": "garantia", "x": "outros", None: None}),
        (text.is_legal_entity, {"Pessoa jurídica": True, " pj ": True, "PESSOA JURIDICA": True, "Pessoa física": False, None: False}),
        (text.file_state, {"arquivo_lai_SIDA_AC_202002.csv": "AC", "x_sida_sp.csv": "SP", "arquivo.csv": "NA"}),
        (lambda c: text.local_number(c.cast("double")), {"1234.5": "1.234,50", "-1234567.891": "-1.234.567,89", "12.5": "12,5000"}),
        (lambda c: dates.age_days(c.cast("date")), {"1994-06-03": 11534, "2030-01-01": 0, None: None}),
        (lambda c: numbers.finite(c.cast("double")), {"NaN": None, "Infinity": None, "-Infinity": None, "1": 1.0, None: None}),
        (lambda c: text.label(c, {"a": "A"}), {"a": "A", "b": "b"}),
    ],
)
def test_function(spark, f, cases):
    assert apply(spark, list(cases), f) == list(cases.values())


def test_golden_age_on_another_day(spark):
    assert apply(spark, ["1994-06-03"], lambda c: dates.age_days(c.cast("date"), "2026-01-09")) == [11543]
