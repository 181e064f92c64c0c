"""Chunked global-order operators against plain Python, with hot values and many chunks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lumenlake.operators import intervals, statistics
from lumenlake.operators.keys import first_wins, insert_if_absent
from lumenlake.operators.ordering import carry_forward, number_rows, range_chunks, running_total

START = datetime(2026, 1, 1)


def test_number_rows_over_many_blocks(spark):
    draw = random.Random(1)
    keys = draw.sample(range(10_000_000), 500)
    rows = spark.createDataFrame([(k, k % 3 == 0) for k in keys], "line_no bigint, own boolean")
    found = number_rows(rows, "line_no", {"seq": None, "mine": F.col("own")}, block=1000).collect()
    order = sorted(keys)
    own = [k for k in order if k % 3 == 0]
    for r in found:
        assert r["seq"] == order.index(r["line_no"]) + 1
        assert r["mine"] == (own.index(r["line_no"]) + 1 if r["own"] else None)


@pytest.fixture
def many_chunks(spark):
    """Ranges that adaptive execution does not merge again."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_chunks_are_ranges_in_order(spark, many_chunks):
    draw = random.Random(8)
    rows = spark.createDataFrame([(draw.choice("ab"), draw.randint(0, 99)) for _ in range(1000)], "g string, v int")
    found = [tuple(r) for r in range_chunks(rows, ["g", "v"]).collect()]
    chunk_of = {}
    for g, v, chunk in sorted(found, key=lambda r: r[:2]):
        assert chunk_of.setdefault((g, v), chunk) == chunk  # equal values stay together
    assert list(chunk_of.values()) == sorted(chunk_of.values()) and len(set(chunk_of.values())) > 2


def test_running_total_with_a_hot_value(spark, many_chunks):
    draw = random.Random(2)
    values = [draw.choice([5, draw.randint(0, 50)]) for _ in range(2000)]
    rows = spark.createDataFrame([(v % 2, v) for v in values], "g int, v int")
    counts = rows.groupBy("g", "v").agg(F.count("*").alias("n"))
    for r in running_total(counts, "v", "n", "upto", ["g"]).collect():
        assert r["upto"] == sum(1 for v in values if v % 2 == r["g"] and v <= r["v"])


def test_carry_forward_across_chunks(spark):
    draw = random.Random(3)
    marks = [draw.randint(0, 9) if draw.random() < 0.1 else None for _ in range(400)]
    rows = spark.createDataFrame([(i // 30, i, m) for i, m in enumerate(marks)], "c int, i int, m int")
    for r in carry_forward(rows, ["c"], ["i"], "m", "last").collect():
        seen = [m for m in marks[: r["i"] + 1] if m is not None]
        assert r["last"] == (seen[-1] if seen else None)


def test_first_wins_and_insert_if_absent(spark):
    rows = spark.createDataFrame([(3, "a", 1), (1, "a", 2), (2, "b", 3), (4, None, 4), (5, None, 4)], "line_no int, k string, v int")
    assert sorted((r["k"], r["v"]) for r in first_wins(rows.where("k is not null"), ["k"]).collect()) == [("a", 2), ("b", 3)]
    target = spark.createDataFrame([("b",)], "k string")
    added = insert_if_absent(target, rows, ["k"]).collect()
    assert sorted(((r["k"] or ""), r["v"]) for r in added) == [("", 4), ("", 4), ("a", 2)]


@pytest.mark.parametrize("seed", range(4))
def test_count_overlaps(spark, many_chunks, seed):
    draw = random.Random(seed)
    runs = []
    for i in range(120):
        start = draw.choice([10, draw.randint(0, 40)])
        runs.append((i, draw.choice("ab"), start, start + draw.choice([0, 0, 1, 5, 20])))
    rows = spark.createDataFrame(
        [(g, START + timedelta(seconds=s), START + timedelta(seconds=e)) for _, g, s, e in runs],
        "g string, s timestamp_ntz, e timestamp_ntz",
    )
    for r in intervals.count_overlaps(rows, "s", "e", ["g"]).collect():
        mine = [x for x in runs if x[1] == r["g"]]
        pairs = sum(1 for a in mine for b in mine if a[0] < b[0] and a[2] < b[3] and b[2] < a[3])
        assert (r["n_runs"], r["n_overlapping"]) == (len(mine), pairs)


@pytest.mark.parametrize("seed", range(3))
def test_newest_after(spark, many_chunks, seed):
    draw = random.Random(seed)
    marks = sorted({draw.randint(0, 200) for _ in range(30)})
    facts = [(i, draw.choice([50, draw.randint(0, 220)])) for i in range(80)]
    left = spark.createDataFrame([(START + timedelta(seconds=m),) for m in marks], "m timestamp_ntz")
    right = spark.createDataFrame([(i, START + timedelta(seconds=t)) for i, t in facts], "f bigint, t timestamp_ntz")
    found = {r["m"]: r["f"] for r in intervals.newest_after(left, "m", right, "t", "f").collect()}
    for mark, after in zip(marks, marks[1:] + [10**6]):
        owned = [(t, i) for i, t in facts if mark <= t < after]
        assert found.get(START + timedelta(seconds=mark)) == (max(owned)[1] if owned else None)


def test_median_matches_python(spark, many_chunks):
    import statistics as plain

    draw = random.Random(5)
    values = [(draw.choice("xyz"), float(draw.choice([7, draw.randint(0, 30)]))) for _ in range(501)] + [("w", 4.0)]
    rows = spark.createDataFrame(values, "g string, v double")
    for r in statistics.summarise(rows, ["g"], "v").collect():
        mine = [v for g, v in values if g == r["g"]]
        assert r["median"] == plain.median(mine) and r["n"] == len(mine)
        assert r["stdev"] == (pytest.approx(plain.stdev(mine)) if len(mine) > 1 else None)


@pytest.mark.parametrize("bracket", ["as sketched", "too high", "too low"])
def test_medians_by_narrowing(spark, many_chunks, bracket, monkeypatch):
    """Groups of 1 to 40 000 rows, a hot value, far outliers; also where a sketch misses the middle."""
    import statistics as plain

    if bracket != "as sketched":
        share = 0.99 if bracket == "too high" else 0.001
        real = statistics.F.percentile_approx
        monkeypatch.setattr(statistics.F, "percentile_approx", lambda c, _, a: real(c, [share, share], a))
    draw = random.Random(9)
    groups = {
        "one": [5], "two": [4, 9], "even": [3, 1, 2, 10], "hot": [7] * 900 + [draw.randint(0, 99) for _ in range(1000)],
        "wide": [int(10 ** draw.uniform(0, 15)) * draw.choice([1, -1]) for _ in range(40_000)], "same": [2] * 50,
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("one", None), ("none", None)]
    draw.shuffle(rows)
    found = {r["g"]: r for r in statistics.summarise(spark.createDataFrame(rows, "g string, v bigint").repartition(8), ["g"], "v").collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        r = found[g]
        assert (r["n"], r["median"], r["min"], r["max"]) == (len(values), plain.median(values), min(values), max(values))


def test_narrowing_exchanges_few_values(spark):
    rows = spark.range(200_000).selectExpr("id % 2 as g", "id * 7919 % 200003 as v")
    made = []
    real = statistics.running_total
    try:
        statistics.running_total = lambda counts, *more: made.append(counts.count()) or real(counts, *more)
        found = statistics.summarise(rows, ["g"], "v").collect()
    finally:
        statistics.running_total = real
    assert len(found) == 2 and sum(made) < 600


def test_overlaps_of_more_runs_than_64_bits_can_pair(spark, monkeypatch):
    """Four thousand million runs, all at once: counts are put in, not rows."""
    rows = spark.sql("select 'a' as g, timestamp_ntz'2024-01-01 00:00:00' as s, timestamp_ntz'2024-01-01 01:00:00' as e")
    real = intervals.F.count
    monkeypatch.setattr(intervals.F, "count", lambda c: real(c) * F.lit(4_000_000_000))
    found = intervals.count_overlaps(rows, "s", "e", ["g"]).first()
    n = 4_000_000_000
    assert (found["n_runs"], int(found["n_overlapping"])) == (n, n * (n - 1) // 2)


@pytest.mark.parametrize("sizes", [(1, 1), (2, 3), (3, 2), (5, 5), (8, 8), (4, 9), (8, 40)])
def test_exact_tail_counts_arrangements(spark, sizes):
    """Against a table filled by the recursion on the largest value; both sides, and beyond the bounds null."""
    n1, n2 = sizes
    ways = {}
    for a in range(n1 + 1):
        for b in range(n2 + 1):
            for u in range(a * b + 1):
                ways[a, b, u] = 1 if a == 0 or b == 0 else ways.get((a - 1, b, u - b), 0) + ways.get((a, b - 1, u), 0)
    total = sum(ways[n1, n2, u] for u in range(n1 * n2 + 1))
    wanted = sorted({0, 1, n1 * n2 // 3, n1 * n2 // 2, n1 * n2})
    rows = spark.createDataFrame([(float(u), n1, n2) for u in wanted], "u double, a int, b int")
    for r in rows.select("u", statistics.exact_two_sided(F.col("u"), F.col("a"), F.col("b")).alias("p")).collect():
        low = min(int(r["u"]), n1 * n2 - int(r["u"]))
        assert r["p"] == pytest.approx(min(1.0, 2 * sum(ways[n1, n2, u] for u in range(low + 1)) / total))
    large = spark.createDataFrame([(3.0, 9, 9), (3.0, 8, 400)], "u double, a int, b int")
    assert [r[0] for r in large.select(statistics.exact_two_sided(F.col("u"), F.col("a"), F.col("b"))).collect()] == [None, None]
