"""Normalised and served layers on small literal rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lumenlake import contract
from lumenlake.plans import bronze, gold, silver
from tests.test_parsing import row

BASE = dict(
    customer_name="ANA", person_tax_id="1", street="S", house_number="1", postal_code="00001-000", district="D1",
    consumption_class="Rural", consumption_subclass="Agroindustrial", tariff_category="T", commercial_status="LG",
    installation="I1", contract_account="A1", reading_stage="1", supply_group="A", phase="1", perimeter="U",
    reading_calendar="BR", bill_status="P", paid_on="05/02/2024", paid_amount="5,00", levy="2,00",
    measured_kwh="10,004", billed_kwh="10,006",
)


@pytest.fixture
def tables(spark, workspace):
    def build(*changes):
        schema = ", ".join(f"{n} string" for n in contract.NAMES)
        rows = [row(**{**BASE, "line_no": str(i + 1), **c}) for i, c in enumerate(changes)]
        frame = spark.createDataFrame([tuple(r[n] for n in contract.NAMES) for r in rows], schema)
        raw = workspace.table("raw", lambda: bronze.valid_rows(bronze.check(frame)))
        out = {n: getattr(silver, n)(raw) for n in ("addresses", "customers", "installations")}
        out["bills"] = workspace.table("bills", lambda: silver.bills(raw, out["customers"], out["installations"]))
        for n in ("payments", "taxes", "reading_cycles", "rebills", "levies"):
            out[n] = getattr(silver, n)(raw, out["bills"])
        out["raw"] = raw
        out["base"] = gold.levy_base(*(out[t] for t in ("bills", "installations", "addresses", "levies", "payments")))
        return out

    return build


def test_namesakes_and_twin_types(tables):
    t = tables({}, {"bill_number": "B2", "person_tax_id": ""}, {"bill_number": "B3", "customer_name": "EVA"})
    assert t["customers"].count() == 3
    found = sorted((r["bill_number"], r["customer_name"], r["customer_type"]) for r in t["bills"].collect())
    assert found == [("B1", "ANA", "PF"), ("B1", "ANA", "PJ"), ("B2", "ANA", "PF"), ("B2", "ANA", "PJ"), ("B3", "EVA", "PF")]
    assert t["payments"].count() == 5


def test_first_row_wins(tables):
    t = tables({}, {"bill_number": "B2", "district": "D2", "contract_account": "A2"},
               {"paid_amount": "9,00"}, {"paid_on": "06/02/2024", "paid_amount": "1,00"})
    assert t["addresses"].first()["district"] == "D1" and t["installations"].first()["contract_account"] == "A1"
    paid = sorted((r["paid_on"].day, r["paid_amount"]) for r in t["payments"].where("bill_number = 'B1'").collect())
    assert paid == [(5, Decimal("5.00")), (6, Decimal("1.00"))]
    assert t["base"].where("bill_number = 'B1'").first()["levy_collected"] == Decimal("1.20")


def test_several_levies_multiply_base_rows(tables):
    t = tables({}, {"levy": "3,00"}, {"levy": ""})
    assert t["bills"].count() == 1 and t["levies"].count() == 2
    assert gold.consumption_by_district(t["base"]).first()["kwh"] == Decimal("20.00")
    assert gold.levy_billed_by_month(t["base"]).first()["levy_billed"] == Decimal("5.00")
    ticket = gold.levy_ticket_by_class(t["base"]).first()
    assert (ticket["n_customers"], ticket["levy_ticket"]) == (1, Decimal("5.00"))


def test_distinct_comes_before_narrowing(tables):
    t = tables({}, {"measured_kwh": "10,0041"})
    assert [r["measured_kwh"] for r in t["bills"].collect()] == [Decimal("10.00")] * 2
    assert t["bills"].select("bill_id").distinct().count() == 2 and t["levies"].count() == 2


def test_unmatched_rows_are_named(tables):
    t = tables({}, {"bill_number": "B2", "installation": "I2", "consumption_subclass": "?"},
               {"bill_number": "B3", "installation": "I3", "consumption_class": "?"},
               {"bill_number": "B4", "consumption_class": "?"})
    assert {r["bill_number"] for r in t["bills"].collect()} == {"B1", "B4"}
    lost = {r["bill_number"]: r["lost_by"] for r in silver.unmatched_rows(t["raw"], t["installations"]).collect()}
    assert lost == {"B2": "consumption_subclass", "B3": "consumption_class"}


def test_facts_and_required_values(tables):
    t = tables({"rebilled": "SIM", "rebilled_on": "07/02/2024", "substitute_levy": "1,50", "cycle_start": "01/01/2024",
                "tax_pis": "1,00"}, {"bill_number": "B2", "rebilled": "S", "paid_amount": ""})
    assert t["rebills"].count() == 1 and t["reading_cycles"].count() == 1 and t["taxes"].count() == 2
    assert t["payments"].count() == 1
    faults = {r["fault"] for r in silver.null_in_required_fact(t["raw"]).collect()}
    assert faults == {"payment without amount"}


def test_unknown_consumption_ranks_first_and_zero_bills_count_as_collected(tables):
    t = tables({}, {"bill_number": "B2", "installation": "I2", "house_number": "2", "district": "D2", "measured_kwh": ""},
               {"bill_number": "B3", "bill_amount": "0,00", "paid_on": "", "paid_amount": ""})
    ranks = {r["district"]: r["position"] for r in gold.district_ranking(t["base"]).collect()}
    assert ranks == {"D2": 1, "D1": 2}
    assert t["base"].where("bill_number = 'B3'").first()["levy_collected"] == Decimal("2.00")
    assert gold.levy_loss_by_district(t["base"], F.col("district") == "D1").first()["levy_loss"] == Decimal("1.00")


def test_domains(spark, tables):
    assert silver.subclass_domain(spark).count() == 51 and silver.fixed_domains(spark).count() == 11
    t = tables({"commercial_status": "XX"})
    assert ("XX", "XX") in {tuple(r) for r in silver.commercial_status(t["raw"]).collect()}
