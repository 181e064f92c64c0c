"""Views over partials against the same views over the whole base, load by load."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lumenlake import contract
from lumenlake.plans import gold, partials
from lumenlake.plans.lake import Lake, _in_months, _months
from lumenlake.plans.partials import Partials
from test_lake import lines, write  # noqa: F401

AT = contract.NAMES.index


def rows(frame):
    return sorted(map(repr, frame.select(sorted(frame.columns)).collect()))


def same_as_whole(lake):
    lake.serve(whole=True)
    base = lake.served()
    for name, view in gold.VIEWS.items():
        assert rows(lake.partials().view(name)) == rows(view(base)), name


def test_views_add_up_load_by_load(spark, tmp_path, lines):  # noqa: F811
    matched = [r for r in lines if r[AT("consumption_subclass")] != "UNKNOWN" and r[AT("paid_on")]]
    fresh, late, levied, foreign = (list(r) for r in matched[:4])
    fresh[AT("bill_number")], fresh[AT("billing_month")] = "0999999999999999", "203001"
    late[AT("paid_on")], late[AT("paid_amount")] = "01/02/2031", "3,00"
    levied[AT("levy")] = "7,77"  # a second levy of a known bill doubles its row
    foreign[AT("bill_number")], foreign[AT("billing_month")] = "0888888888888888", "spring"
    lake = Lake(spark, str(tmp_path / "lake"))
    for load_id, part in enumerate((lines, [fresh, late], [levied, foreign], lines[:5]), 1):
        lake.load(write(tmp_path / f"{load_id}.csv", part), load_id)
        lake.normalise()
        assert set(lake.serve_partials()) == set(gold.VIEWS)
        if load_id < 4:
            same_as_whole(lake)
    assert sorted(map(tuple, lake.partials().added().select("load_id", "generation", "batch").collect())) == [
        (1, 0, 0), (2, 0, 1), (3, 0, 2), (4, 0, 3)
    ]
    # A load that is normalised again begins a generation of its own.
    lake.load(write(tmp_path / "2.csv", [fresh]), 2)
    lake.normalise()
    lake.serve_partials()
    assert {tuple(r) for r in lake.partials().added().select("generation", "batch").collect()} == {(1, 0)}
    same_as_whole(lake)


BASE = "bill_id string, levy decimal(18,2), load_id int"


def tables(spark, bills, levies, payments):
    """Bills of one installation each, with the customer's name and the amount."""
    cast = lambda c: F.col(c).cast("decimal(18,2)").alias(c)
    of = spark.createDataFrame(bills, "bill_id string, customer_name string, bill_amount double, load_id int")
    keys = {c: F.lit("x").alias(c) for c in gold.ADDRESS_KEY}
    found = of.select(
        "bill_id", F.col("bill_id").alias("bill_number"), "customer_name", F.lit("P").alias("customer_type"),
        F.lit("i").alias("installation"), F.lit("202401").alias("billing_month"), F.lit("202401").alias("reference_month"),
        F.lit(None).cast("decimal(18,2)").alias("measured_kwh"), F.lit(1).cast("decimal(18,2)").alias("billed_kwh"),
        cast("bill_amount"), "load_id",
    )
    place = spark.range(1).select(F.lit("i").alias("installation"), F.lit("C").alias("consumption_class"), F.lit(None).cast("string").alias("consumption_subclass"), *keys.values())
    address = spark.range(1).select(*keys.values(), F.lit("D").alias("district"), F.lit("M").alias("municipality"))
    levy = spark.createDataFrame(levies, "bill_id string, levy double, load_id int").select("bill_id", cast("levy"), "load_id")
    paid = spark.createDataFrame(payments, "bill_id string, paid_amount double, load_id int").select("bill_id", cast("paid_amount"), "load_id")
    return {"bills": found, "installations": place, "addresses": address, "levies": levy, "payments": paid}


def test_a_customer_is_counted_once_over_loads_and_null_sums_stay_null(spark, tmp_path):
    whole = tables(
        spark,
        [("a", "Ann", 10.0, 1), ("b", "Ann", 10.0, 2), ("c", None, 10.0, 2)],
        [("a", 2.0, 1), ("a", 3.0, 2), ("b", 1.0, 2)],
        [("a", 5.0, 2)],
    )
    store = Partials(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no load"):
        store.view("levy_ticket_by_class")
    day = datetime(2026, 1, 1)
    assert store.add(lambda *_: whole, {1: day}) == [1]
    assert store.add(lambda *_: whole, {1: day}) == []
    assert store.add(lambda *_: whole, {1: day, 2: day}) == [2]
    ticket = store.view("levy_ticket_by_class").first()
    assert (ticket["n_customers"], float(ticket["levy_billed"]), float(ticket["levy_ticket"])) == (2, 6.0, 3.0)
    assert store.view("consumption_by_subclass").first()["kwh"] is None
    assert float(store.view("levy_collected_by_class").first()["levy_collected"]) == 2.5
    base = gold.levy_base(*(whole[t].drop("load_id") for t in ("bills", "installations", "addresses", "levies", "payments")))
    for name, view in gold.VIEWS.items():
        assert rows(store.view(name)) == rows(view(base)), name


def test_only_touched_bills_are_computed(spark):
    whole = tables(spark, [(str(i), "Ann", 1.0, 1) for i in range(50)], [("7", 1.0, 2)], [])
    found = partials.changes(whole, [2], [1]).select("bill_id", "_sign").collect()
    assert sorted(map(tuple, found)) == [("7", -1), ("7", 1)]


def test_texts_that_are_no_month_are_one_group(spark):
    texts = spark.createDataFrame([(t,) for t in ["202401", "202402", None, *(f"junk{i}" for i in range(100))]], "billing_month string")
    assert sorted(_months(texts)) == ["", "202401", "202402"]
    assert texts.where(_in_months(["202401", ""])).count() == 102 and texts.where(_in_months(["202401"])).count() == 2
