from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lumenlake import contract
from lumenlake.functions import money, parsing
from lumenlake.plans import bronze

DATES = {
    "31/12/2023": date(2023, 12, 31),
    " 1/2/2024 ": date(2024, 2, 1),
    "20230808": date(2023, 8, 8),
    "31/02/2024": None,
    "20231332": None,
    "2023-08-08": None,
    "1/2/24": None,
    "202308": None,
    "": None,
    "   ": None,
    "junk": None,
}
DECIMALS = {
    "1.234,50": Decimal("1234.50"),
    "1.234": Decimal("1.23"),
    "1234": Decimal("1234.00"),
    "-0,005": Decimal("-0.01"),
    " 7,1 ": Decimal("7.10"),
    "1,2,3": None,
    "": None,
    "abc": None,
    "99999999999999999999": None,
}


@pytest.mark.parametrize("text,expected", DATES.items())
def test_dates_never_throw(spark, text, expected):
    assert spark.createDataFrame([(text,)], "c string").select(parsing.parse_date(F.col("c"))).first()[0] == expected


@pytest.mark.parametrize("text,expected", DECIMALS.items())
def test_decimals_follow_the_comma(spark, text, expected):
    rows = spark.createDataFrame([(text,)], "c string")
    assert rows.select(parsing.parse_decimal(F.col("c"), "decimal(18,2)")).first()[0] == expected


def test_ints_and_flags(spark):
    rows = spark.createDataFrame([("12", "S"), (" 7 ", "SIM"), ("1.5", "s"), ("", None), ("99999999999", "T")], "a string, b string")
    found = rows.select(
        parsing.parse_int(F.col("a")),
        parsing.is_yes_letter(F.col("b"), "S"),
        parsing.is_yes_word(F.col("b"), contract.YES_WORDS),
    ).collect()
    assert [tuple(r) for r in found] == [
        (12, True, True), (7, False, True), (None, False, False), (None, False, False), (None, False, True),
    ]


def row(**changes):
    base = dict.fromkeys(contract.NAMES, "")
    base.update(
        line_no="1", billing_month="202401", bill_number="B1", bill_amount="10,00", due_on="01/02/2024",
        municipality="X", consumption_class="Rural",
    )
    return {**base, **changes}


def checked(spark, *rows):
    schema = ", ".join(f"{n} string" for n in contract.NAMES)
    frame = spark.createDataFrame([tuple(r[n] for n in contract.NAMES) for r in rows], schema)
    return bronze.check(frame)


@pytest.mark.parametrize(
    "changes,reason",
    [
        ({}, None),
        ({"municipality": "  "}, "Campos obrigatórios nulos: ['MUNICIPIO']"),
        ({"bill_amount": "x", "due_on": "31/02/2024"},
         "Campos obrigatórios nulos: ['VALOR_FATURA', 'DATA_VENCIMENTO_ORIGINAL']"),
        ({"bill_amount": "99999999999999999,00"}, "Inadmissible values: ['VALOR_FATURA']"),
        ({"bill_amount": "inf"}, "Inadmissible values: ['VALOR_FATURA']"),
        ({"bill_amount": "nan"}, "Campos obrigatórios nulos: ['VALOR_FATURA']"),
        ({"contract_active": "FALSE"}, None),
        ({"contract_active": "LONGER"}, "Inadmissible values: ['CONTRATO_ATIVO']"),
        ({"latitude": "1234567,0"}, "Inadmissible values: ['LATITUDE']"),
        ({"latitude": "north"}, None),
        ({"line_no": "12x"}, "Inadmissible values: ['Ordem']"),
        ({"cycle_days": "3,5"}, "Inadmissible values: ['QUANTIDADE_DIAS']"),
    ],
)
def test_reasons(spark, changes, reason):
    assert checked(spark, row(**changes)).first()["reason"] == reason


def test_payload_keeps_nulls_blanks_and_accents(spark):
    import json

    rejected = bronze.rejected_rows(checked(spark, row(bill_amount="", customer_name="José", levy="1.234,50"))).first()
    payload = json.loads(rejected["payload"])
    assert list(payload) == contract.HEADERS
    assert payload["VALOR_FATURA"] is None and payload["CPF"] == "" and payload["NOME"] == "José"
    assert payload["DATA_VENCIMENTO_ORIGINAL"] == "2024-02-01" and payload["CIP"] == 1234.5


def test_split_is_a_partition_and_fail_fast_names_the_first(spark):
    rows = [row(line_no=str(i), municipality="" if i % 3 == 0 else "X") for i in range(1, 11)]
    frame = checked(spark, *rows)
    valid, rejected = bronze.split(frame)
    assert valid.count() == 7 and rejected.count() == 3
    assert bronze.first_fault(frame).first()["line_no"] == 3
    assert tuple(bronze.totals(frame).first()) == (7, 3)


def test_prorate_is_exact(spark):
    """Against integer arithmetic on cents, ties aside from representable ones."""
    import random

    draw = random.Random(7)
    cases = [(draw.randint(1, 99999), draw.randint(0, 5_000_000), draw.randint(1, 5_000_000)) for _ in range(4000)]
    cents = [tuple(Decimal(v).scaleb(-2) for v in case) for case in cases]
    frame = spark.createDataFrame(cents, "levy decimal(18,2), paid decimal(18,2), billed decimal(18,2)")
    found = frame.select("*", money.prorate(F.col("levy"), F.col("paid"), F.col("billed")).alias("got")).collect()
    for got, (levy, paid, billed) in zip(found, cases):
        part = min(paid, billed)
        assert int(got["got"].scaleb(2)) == (2 * levy * part + billed) // (2 * billed)


def test_prorate_edges(spark):
    cases = [("5.00", "0.00", "0.00", "5.00"), ("5.00", "30.00", "10.00", "5.00"), ("5.00", "0.00", "10.00", "0.00"),
             ("5.00", "-5000.00", "1.00", "-25000.00")]
    frame = spark.createDataFrame([tuple(map(Decimal, c[:3])) for c in cases], "l decimal(18,2), p decimal(18,2), b decimal(18,2)")
    found = frame.select(money.prorate(F.col("l"), F.col("p"), F.col("b"))).collect()
    assert [r[0] for r in found] == [Decimal(c[3]) for c in cases]


def test_outcome_priority(spark):
    summary = spark.createDataFrame([(5, 2), (0, 2), (7, 0)], "n_rows bigint, n_quarantined bigint")
    terms = contract.PUBLISHED_TERMS
    yes, no = F.lit(True), F.lit(False)
    healed = bronze.outcome(summary, no, yes, no, True, terms).collect()
    assert [(r["fault_type"], r["mechanism"], r["status"], r["auto_resolved"]) for r in healed] == [
        ("ARQUIVO_AUSENTE", "FALLBACK_ARQUIVO+QUARENTENA", "SUCESSO", True),
        ("ARQUIVO_AUSENTE", "FALLBACK_ARQUIVO+QUARENTENA", "ERRO", False),
        ("ARQUIVO_AUSENTE", "FALLBACK_ARQUIVO", "SUCESSO", True),
    ]
    plain = bronze.outcome(summary, no, no, no, False, terms).collect()
    assert [(r["fault_type"], r["mechanism"], r["status"], r["n_rows"], r["n_quarantined"]) for r in plain] == [
        ("DADOS_NULOS", "NENHUM", "ERRO", None, 0), ("DADOS_NULOS", "NENHUM", "ERRO", None, 0),
        ("NENHUMA", "NENHUM", "SUCESSO", 7, 0),
    ]
    assert bronze.outcome(summary, yes, no, yes, True, terms).first()["mechanism"] == "RETRY_BACKOFF+VALIDACAO_SCHEMA"


def test_dates_are_read_as_by_their_formats(spark):
    """dates of fixed width are cast; every text gives what its format gave."""
    texts = [
        "01/02/2024", "31/02/2024", "1/2/2024", "01/2/2024", "01/02/0000", "01/02/0001", "31/12/9999", "1 /02/2024", "01/02/2024\x85",
        "20240102", "20240230", "20240102\x85", "00000101", "00010101", "99991231", " 20240102 ", "\t01/02/2024\n", "1T/02/2024",
        "01/02/+2024", "01/02/12345", "01/13/2024", "00/01/2024", "29/02/2023", "29/02/2024", "29/02/1900", "15/10/1582",
        "10/10/1582", "2024/01/02", "/", "20240102/", "01/02/2024/", "٠١/٠٢/٢٠٢٤", "0a/02/2024", "12/12/999", "2024-01-02", "", " ", None,
    ]
    day = parsing.strip(F.col("t"))
    wanted = F.when(day.contains("/"), F.try_to_date(day, "d/M/yyyy")).when(day.rlike("^[0-9]{8}$"), F.try_to_date(day, "yyyyMMdd"))
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", wanted.cast("string").alias("wanted"), parsing.parse_date(F.col("t")).cast("string").alias("found")).collect()
    assert [r["t"] for r in found if r["wanted"] != r["found"]] == []
    assert sum(r["found"] is not None for r in found) > 10
