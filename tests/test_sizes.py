"""What a task, a file or an exchange holds does not grow with the input."""

from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

import __spark_entry__ as contract
from lumenlake import contract as contract_of_rows, session
from lumenlake.operators.skew import hot_keys, join_many
from lumenlake.plans import bronze, gold, partials
from lumenlake.plans.workspace import written
from lumenlake.registry import queries, relations
from lumenlake.registry.relations import Relations
from lumenlake.sources import derived, extract, quoted
from lumenlake.sources.extract import write_extract
from test_partials import tables
from test_plans import plan

SMALL = "/root/testdata/sf0.001"


def test_shuffles_are_cut_to_the_source_rows(spark):
    """with the pieces of the caller's session each task took more as the tables grew."""
    small, large = session.sized(spark, 10), session.sized(spark, 500_000_000)
    assert small.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert large.conf.get("spark.sql.shuffle.partitions") == "10000"
    assert large.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").count()
    assert derived.source_rows(spark, SMALL) == max(orders, spark.read.parquet(f"{SMALL}/events.parquet").count())


def test_queries_run_in_a_sized_session(spark, monkeypatch):
    monkeypatch.setattr(session, "PIECE_ROWS", 100)
    rows = contract.queries()["success_rate"](spark, SMALL)
    pieces = -(-derived.source_rows(spark, SMALL) // 100)
    assert rows.sparkSession.conf.get("spark.sql.shuffle.partitions") == str(pieces)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_log_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    """The log was written as plain text in files as long as a task's share of it."""
    monkeypatch.setitem(relations.LOG_FILES, "maxRecordsPerFile", 50)
    made = Relations(spark, SMALL)
    made.workspace.root = str(tmp_path)  # not the log that other tests have written
    path = made.log_path()
    lines = spark.read.text(path).groupBy("_metadata.file_name").count()
    assert lines.agg(F.max("count")).first()[0] <= 50
    assert {f.suffix for f in Path(path).glob("part-*")} == {".gz"}
    text = [r["value"][:23] for r in spark.read.text(path).orderBy("_metadata.file_name", F.monotonically_increasing_id()).collect()]
    assert len(text) == derived.log_lines(spark, SMALL).count() and text == sorted(text)


def test_shared_tables_are_compressed(spark):
    """hashes hardly shrink under the default codec."""
    assert all(".zstd." in f for f in written(spark.range(10), "numbers").inputFiles())


def test_hot_keys_are_found_by_buckets(spark):
    """every key was exchanged to find the few hot ones."""
    many = spark.range(5000).selectExpr("case when id % 2 = 0 then 'hot' when id % 5 = 0 then null else cast(id as string) end as k")
    assert [r["k"] for r in hot_keys(many, "k", 400).where("k is not null").collect()] == ["hot"]
    assert "LocalTableScan" in plan(hot_keys(many, "k", 5000))


def test_changes_are_what_the_loads_add(spark):
    """one pass gives the difference of the base with and without the fresh loads."""
    whole = tables(
        spark,
        [("none", "A", 10.0, 1), ("late", "A", 10.0, 1), ("more", "B", 10.0, 1), ("paid", "B", 10.0, 1), ("new", "C", 10.0, 2),
         ("idle", "C", 10.0, 1), ("twice", "D", 10.0, 1), ("twice", "D", 10.0, 2), ("paid none", "E", 10.0, 1)],
        [("late", 2.0, 2), ("late", 3.0, 2), ("more", 2.0, 1), ("more", 3.0, 2), ("paid", 4.0, 1), ("paid", 5.0, 1),
         ("new", 1.0, 2), ("idle", 9.0, 1), ("twice", 2.0, 1), ("orphan", 2.0, 2)],
        [("more", 5.0, 1), ("paid", 1.0, 1), ("paid", 1.0, 2), ("new", 2.0, 2), ("paid none", 3.0, 2)],
    )

    def base(loads):
        of = lambda n: whole[n].where(F.col("load_id").isin(loads)).drop("load_id")
        rows = gold.levy_base(of("bills"), whole["installations"], whole["addresses"], of("levies"), of("payments"))
        return rows

    def net(rows):
        keys = [c for c in rows.columns if c != "_sign"]
        return sorted(map(repr, rows.groupBy(*keys).agg(F.sum("_sign").alias("n")).where("n <> 0").collect()))

    wanted = base([1, 2]).withColumn("_sign", F.lit(1)).unionByName(base([1]).withColumn("_sign", F.lit(-1)))
    found = partials.changes(whole, [2], [1])
    assert net(found.select(wanted.columns)) == net(wanted)
    assert found.where("bill_id = 'idle' or bill_id = 'none'").isEmpty()
    assert found.where("bill_id = 'late' and _sign = -1").first()["levy_billed"] == Decimal(0)


def test_quoted_rows_are_written_once(spark, monkeypatch):
    """F16: the scanned rows were written, read and written again."""
    monkeypatch.setattr(extract, "written", lambda rows, name: names.append(name) or written(rows, name))
    monkeypatch.setattr(quoted, "written", lambda rows, name: names.append(name) or written(rows, name))
    monkeypatch.setattr(queries, "written", lambda rows, name: names.append(name) or written(rows, name), raising=False)
    names = []
    made = Relations(spark, SMALL)
    made.workspace.root = f"{made.workspace.root}-once"  # not the rows that other tests have written
    monkeypatch.setattr(queries, "QUOTED_SPLIT", 1 << 18)
    rows = queries.scan_quoted_breaks(made)
    assert set(names) <= {"headers", "quoted-pieces"}
    assert rows.count() == made.raw(["line_no"]).count() and rows.columns == contract_of_rows.NAMES


def test_wide_rows_are_compiled(spark):
    """the projection that makes the texts was one method, which the JVM interpreted."""
    assert session.sized(spark, 10).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert session.settings(1, 1)["spark.sql.codegen.hugeMethodLimit"] == "8000"


def test_days_are_taken_once(spark):
    """each date text added an interval to a time and took the day of it three times."""
    texts = plan(derived.bills_raw(spark, SMALL, ["paid_on", "cycle_start", "cycle_end"]))
    assert "date_add" in texts and "INTERVAL" not in texts


def test_nothing_is_parsed_in_interpreted_code(spark):
    """the filter over the missing headers is interpreted and parsed two columns once more."""
    raw = spark.createDataFrame([(" ",) * len(contract_of_rows.NAMES)], contract_of_rows.NAMES)
    missing = plan(bronze.type_columns(raw).select("missing")).split("filter(array(")
    assert len(missing) == 2 and "try_cast" not in missing[1].split("lambdafunction")[0]
    headers = "', '".join(contract_of_rows.REQUIRED_HEADERS)
    assert bronze.type_columns(raw).first()["missing"] == headers


def test_bills_are_not_shuffled_again_for_their_levies(spark):
    """touched bills were joined with their totals by one key and with their levies by another."""
    whole = tables(spark, [("a", "A", 10.0, 1), ("b", "A", 10.0, 2)], [("a", 2.0, 2)], [("b", 5.0, 2)])
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(partials.changes(whole, [2], [1]).select("bill_id", "levy_billed", "_sign"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange each: bills, totals of the facts, levies.
    assert text.count("hashpartitioning(bill_id") + text.count("hashpartitioning(_link") + text.count("hashpartitioning(_found") == 3


def test_rows_that_find_nothing_stay(spark):
    """rows of the first side may be kept from the join, also those of a hot key."""
    unique = spark.createDataFrame([(7, False), (7, True), (8, False), (8, True), (9, False), (10, True)], "k int, alone boolean")
    many = spark.range(600).selectExpr("cast(case when id < 500 then 7 when id < 503 then 8 else id end as int) as k", "id as w")
    wanted = {(7, False): 500, (7, True): 1, (8, False): 3, (8, True): 1, (9, False): 1, (10, True): 1}
    for hot_rows in (100, 1000):
        found = join_many(unique, many, "k", hot_rows, where=~F.col("alone"))
        counted = {(r["k"], r["alone"]): r["count"] for r in found.groupBy("k", "alone").count().collect()}
        assert counted == wanted and found.columns == ["k", "alone", "w"]
        assert found.where("alone and w is not null").isEmpty()


def test_two_extracts_are_written_in_one_pass(spark, monkeypatch):
    """the source tables were joined and the wide rows made once per load."""
    calls = []
    monkeypatch.setattr(extract, "write_extract", lambda *a, **k: calls.append(k) or write_extract(*a, **k))
    made = Relations(spark, SMALL)
    made.workspace.root = f"{made.workspace.root}-loads"  # not the loads that other tests have written
    rows = made.lake().history()
    assert calls == [{"by": ["load"]}]
    odd = F.col("billing_month").cast("int") % 2 == 1
    assert rows.where(odd != (F.col("load_id") == 1)).isEmpty()
    assert rows.count() == made.valid().count() and "load" not in rows.columns


def test_stored_rows_are_not_sorted_by_their_validity(spark, tmp_path):
    """each task sorted its wide rows by the one flag they are filed under."""
    rows = spark.range(100).selectExpr("id", "id % 3 = 0 as is_valid")
    with extract.open_together(spark, 2):
        rows.coalesce(1).write.partitionBy("is_valid").parquet(str(tmp_path / "flags"))
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "2"
    assert len(list((tmp_path / "flags").rglob("*.parquet"))) == 2
    assert spark.read.parquet(str(tmp_path / "flags")).where("is_valid = (id % 3 = 0)").count() == 100


def test_orders_meet_their_items_before_their_customers(spark):
    """orders were shuffled to their items with the names of customer, nation and region."""
    tables = {
        "orders": spark.sql(
            "select * from values (67, 1), (2, 1), (3, 2), (4, null), (null, 1), (5, 9), (134, 3) as t(o_orderkey, o_custkey)"
        ),
        "customer": spark.sql(
            "select * from values (1, 'A', 0), (1, 'A2', 0), (2, 'B', 1), (3, 'C', null), (null, 'D', 0) as t(c_custkey, c_name, c_nationkey)"
        ),
        "nation": spark.sql("select * from values (0, 'N', 0), (1, 'M', 0) as t(n_nationkey, n_name, n_regionkey)"),
        "region": spark.sql("select * from values (0, 'R') as t(r_regionkey, r_name)"),
        "lineitem": spark.sql("select * from values (67, 1), (67, 2), (3, 5), (null, 7) as t(l_orderkey, l_quantity)"),
    }
    names = ["line_no", "customer_name", "locality", "measured_kwh"]
    made = lambda spark_sql: spark.sql(derived.bills_raw_sql("{{{}}}", names, spark_sql), **tables)
    assert sorted(map(repr, made(True).collect())) == sorted(map(repr, made(False).collect()))
    assert made(True).count() == 9
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joins = [line for line in plan(derived.bills_raw(spark, SMALL, names)).splitlines() if "SortMergeJoin" in line]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(joins) == 4 and "l_orderkey" in joins[-1]


def test_bounded_pieces_are_joined_by_hash(spark, monkeypatch):
    """both sides of every shuffled join were sorted, however small their pieces."""

    def joined():
        own = session.sized(spark, 10)
        own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = own.range(900).selectExpr("id % 300 as k", "id as v").join(own.range(200).selectExpr("id as k", "id as w"), "k", "left")
        assert len(rows.collect()) == 900 and rows.where("w is null").count() == 300
        return plan(rows)

    assert "ShuffledHashJoin" in joined()
    monkeypatch.setattr(session, "PIECE_BYTES", 10)
    assert "ShuffledHashJoin" not in joined()
