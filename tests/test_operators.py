"""Operators against plain Python on random and lopsided data."""

import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from rollcall.functions.specs import Bin, parse_bins, parse_ranges
from rollcall.operators import (
    attach_category,
    attach_records,
    bin_by_category,
    bin_by_range,
    bin_sizes,
    contribution_scores,
    explode_members,
    histogram_by,
    member_stats,
    membership_counts,
    record_sizes,
    size_histogram,
    size_histograms,
    sort_scores,
    top_bottom,
    with_rank,
)


def random_groups(seed, records=400):
    rng = random.Random(seed)
    names = [f"m{i}" for i in range(60)] + ["Jean-Pierre D", "Roe, Jr.", "Zoë"]
    groups = []
    for _ in range(records):
        size = rng.choice([0, 1, 1, 2, 3, 5, 9, 14, 30, 250])
        # one member takes a third of all places
        members = ["hot" if rng.random() < 0.34 else rng.choice(names) for _ in range(size)]
        groups.append((members, rng.choice(["x", "y", "z", None]), rng.choice([None, 1950, 1980, 2003, 2050])))
    return groups


@pytest.fixture(scope="module", params=[1, 2])
def data(request, spark):
    groups = random_groups(request.param)
    frame = spark.createDataFrame(
        groups, "members array<string>, category string, year int"
    ).withColumn("n", F.size("members"))
    return groups, frame.repartition(5).cache()


def places(groups):
    for members, category, _ in groups:
        for member in members:
            yield member, category, len(members)


def test_histograms(data, rows):
    groups, frame = data
    sizes = Counter(len(m) for m, _, _ in groups if m)
    assert rows(size_histogram(frame)) == sorted(sizes.items(), key=repr)
    for index, name in ((1, "category"), (2, "year")):
        counts = Counter((len(g[0]), g[index]) for g in groups if g[0] and g[index] is not None)
        expected = sorted(((n, key, c) for (n, key), c in counts.items()), key=repr)
        assert rows(size_histogram(frame, [name])) == expected


SPECS = ["1,2,3,4-6,7-10,11-end", "1-end,2-3,3-5,2", "300-end,1", "251-400,9-2,0-1"]


@pytest.mark.parametrize("spec", SPECS)
def test_bins(data, spec):
    groups, frame = data
    sizes = [len(m) for m, _, _ in groups if m]
    found = [tuple(r) for r in bin_sizes(size_histogram(frame), parse_bins(spec)).collect()]
    assert found == [
        (label(b, max(sizes)), sum(inside(b, n) for n in sizes)) for b in parse_bins(spec)
    ]


@pytest.mark.parametrize("spec", SPECS)
def test_bins_by_category(data, spec):
    groups, frame = data
    kept = [(len(m), c) for m, c, _ in groups if m and c]
    table = bin_by_category(size_histogram(frame, ["category"]), parse_bins(spec), ["y", "x", "y", "none"])
    assert table.columns == ["bin", "category", "records"]
    top = max(n for n, _ in kept)
    assert [tuple(r) for r in table.collect()] == [
        (label(b, top), c, sum(inside(b, n) and c == mine for n, mine in kept))
        for b in parse_bins(spec)
        for c in ["y", "x", "none"]
    ]


@pytest.mark.parametrize("spec", SPECS)
def test_bins_by_range(data, spec):
    groups, frame = data
    kept = [(len(m), y) for m, _, y in groups if m and y]
    ranges = parse_ranges("1901-1950,1951-2010,1940-1990,2060-2070")
    table = bin_by_range(size_histogram(frame, ["year"]), parse_bins(spec), ranges)
    assert table.columns == ["bin", "range", "records"]
    top = max(n for n, _ in kept)  # years outside all ranges included
    assert [tuple(r) for r in table.collect()] == [
        (label(b, top), r.label, sum(inside(b, n) and inside(r, y) for n, y in kept))
        for b in parse_bins(spec)
        for r in ranges
    ]


def inside(b, n):
    return n >= b.lo and (b.hi is None or n <= b.hi)


def label(b, top):
    return f"{b.lo}-{top}" if b.hi is None and top >= b.lo else b.label


def test_ten_thousand_overlapping_bins(spark):
    rng = random.Random(6)
    counts = {n: rng.randint(1, 9) for n in rng.sample(range(1, 60_000), 3000)}
    ends = [sorted(rng.sample(range(70_000), 2)) for _ in range(9_990)]
    bins = [Bin(k, f"b{k}", lo, hi) for k, (lo, hi) in enumerate(ends)]
    bins += [Bin(9_990 + k, f"{lo}-end", lo, None) for k, lo in enumerate(range(0, 100_000, 10_000))]
    frame = spark.createDataFrame(list(counts.items()), "n bigint, records bigint").repartition(4)
    so_far, total = [0], 0
    for n in range(100_001):
        total += counts.get(n, 0)
        so_far.append(total)
    top = max(counts)
    expected = [(label(b, top), so_far[(99_999 if b.hi is None else b.hi) + 1] - so_far[b.lo]) for b in bins]
    assert [tuple(r) for r in bin_sizes(frame, bins).collect()] == expected


def test_bins_by_no_category(spark):
    frame = spark.createDataFrame([(1, "x", 2)], "n int, category string, records int")
    assert bin_by_category(frame, parse_bins("1"), []).collect() == []


def test_histograms_in_one_pass(data, rows):
    groups, frame = data
    found = size_histograms(frame, ["category", "year"]).cache()
    assert rows(histogram_by(found)) == rows(size_histogram(frame))
    for key in ("category", "year"):
        assert rows(histogram_by(found, key)) == rows(size_histogram(frame, [key]))
    assert rows(histogram_by(size_histograms(frame, []))) == rows(size_histogram(frame))


def test_open_bin_counts_the_largest_size_of_any_year(spark):
    frame = spark.createDataFrame([(12, 1800), (11, 1990)], "n int, year int")
    table = bin_by_range(size_histogram(frame, ["year"]), parse_bins("11-end"), parse_ranges("1981-2000"))
    assert [tuple(r) for r in table.collect()] == [("11-12", "1981-2000", 1)]


def test_bins_of_nothing(spark):
    empty = size_histogram(spark.createDataFrame([], "n int, category string"))
    assert [tuple(r) for r in bin_sizes(empty, parse_bins("1,2-end")).collect()] == [("1", 0), ("2-end", 0)]


def half_up(value):
    return value.quantize(Decimal("0.01"), ROUND_HALF_UP)


def expected_scores(groups):
    shares = defaultdict(list)
    for member, _, n in places(groups):
        shares[member].append(half_up(Decimal(1) / n))
    return {m: float(half_up(sum(s) / len(s))) for m, s in shares.items()}


def test_scores(data, rows):
    groups, frame = data
    scores = contribution_scores(explode_members(frame))
    assert rows(scores) == sorted(expected_scores(groups).items(), key=repr)


@pytest.mark.parametrize("count", [1, 10, 1000])
def test_order_and_top_bottom(data, count):
    groups, frame = data
    scores = contribution_scores(explode_members(frame))
    expected = sorted(expected_scores(groups).items(), key=lambda pair: (pair[1], pair[0]))
    assert [tuple(r) for r in sort_scores(scores).collect()] == expected
    assert [tuple(r) for r in sort_scores(scores, descending=True).collect()] == expected[::-1]
    names = [m for m, _ in expected]
    assert [tuple(r) for r in top_bottom(scores, count).collect()] == [
        (i + 1, low, high) for i, (low, high) in enumerate(zip(names[:count], names[::-1][:count]))
    ]


def expected_stats(values):
    ordered = sorted(values)
    return sum(values) // len(values), ordered[len(values) // 2], ordered[0], ordered[-1]


def test_stats(data, rows):
    groups, frame = data
    fellows, by_category = defaultdict(list), defaultdict(list)
    for member, category, n in places(groups):
        fellows[member].append(n - 1)
        if category:
            by_category[member, category].append(n - 1)
    memberships = explode_members(frame, ["category"])
    assert rows(member_stats(memberships)) == sorted(
        ((m, *expected_stats(v)) for m, v in fellows.items()), key=repr
    )
    assert rows(member_stats(memberships, ["category"])) == sorted(
        ((*key, *expected_stats(v)) for key, v in by_category.items()), key=repr
    )
    counted = membership_counts(memberships, ["category"])
    assert rows(member_stats(counted, times="times")) == rows(member_stats(memberships))
    assert rows(member_stats(counted, ["category"], times="times")) == rows(member_stats(memberships, ["category"]))
    assert rows(contribution_scores(counted, times="times")) == rows(contribution_scores(memberships))
    exact = {r["member"]: r["mean_exact"] for r in member_stats(memberships, exact_mean=True).collect()}
    assert exact == {m: pytest.approx(sum(v) / len(v)) for m, v in fellows.items()}


def test_counted_memberships_are_not_counted_again(spark, rows):
    """Rows that stand for many go straight to the sort, whether equal ones have met or not."""
    values = [("a", 1 + i % 3, 1 + i % 4) for i in range(20)] + [("b", 2, 5), ("b", 2, 5), ("c", 7, 1)]
    counted = spark.createDataFrame(values, "member string, n int, times long")
    told = member_stats(counted, times="times")
    assert "HashAggregate" not in told._jdf.queryExecution().executedPlan().toString()
    single = spark.createDataFrame([(m, n) for m, n, times in values for _ in range(times)], "member string, n int")
    assert rows(told) == rows(member_stats(single))


def test_long_tables_with_a_huge_record(spark, rows):
    rng = random.Random(3)
    items = [(1, f"m{i % 7}") for i in range(1000)]  # a third of all rows
    items += [(rng.randint(2, 300), f"m{rng.randint(0, 40)}") for _ in range(2000)]
    items += [(None, "m1"), (400, None)]
    frame = spark.createDataFrame(items, "record int, member string").repartition(7)
    sizes = record_sizes(frame, "record", "member").where("record IS NOT NULL")
    counted = Counter(r for r, m in items if m and r)
    assert rows(sizes) == sorted(counted.items(), key=repr)
    attached = attach_records(frame.where("member IS NOT NULL"), sizes, "record")
    assert attached.columns == ["record", "member", "n"]
    assert rows(attached) == sorted(((r, m, counted[r]) for r, m in items if r and m), key=repr)


def test_rows_of_a_huge_record_go_to_several_tasks(spark):
    """A third of all rows in one record, 2,000 more large ones: no task gets the whole of a huge one."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.shuffle.partitions": "24",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        huge = spark.range(0, 100_000, 1, 8).selectExpr("0 as record", "xxhash64(id) as member")
        others = spark.range(0, 200_000, 1, 8).selectExpr("1 + id % 2000 as record", "xxhash64(id) as member")
        frame = huge.unionAll(others)
        attached = attach_records(frame, record_sizes(frame, "record", "member"), "record")
        task = F.spark_partition_id().alias("task")
        counted = attached.groupBy("record", "n", task).agg(F.count("member").alias("rows"), F.max("member"))
        found = counted.collect()
        assert {(r.record, r.n) for r in found} == {(0, 100_000)} | {(k, 100) for k in range(1, 2001)}
        assert sum(r["rows"] for r in found) == 300_000
        assert max(r["rows"] for r in found) < 60_000
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)



@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_category_from_a_table(spark, rows, threshold):
    """No record is lost or doubled, whether the table is broadcast or not; one kind has a third of the records."""
    rng = random.Random(8)
    records = [(k, rng.choice(["hot", None, *(f"k{i}" for i in range(9))]), "old") for k in range(3000)]
    table = [("hot", "H"), ("hot", "H"), ("k1", "A"), ("k2", "B"), ("k3", None), ("k4", None), ("k4", "D"), (None, "N"), ("unused", "U")]
    wanted = {"hot": "H", "k1": "A", "k2": "B", "k4": "D"}
    frame = spark.createDataFrame(records, "id int, kind string, category string").repartition(4)
    lookup = spark.createDataFrame(table, "kind string, category string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = attach_category(frame, lookup)
        assert found.columns == ["id", "kind", "category"]
        assert rows(found) == sorted(((k, kind, wanted.get(kind)) for k, kind, _ in records), key=repr)
        twice = lookup.unionAll(spark.createDataFrame([("hot", "G")], lookup.schema))
        assert {r["category"] for r in attach_category(frame, twice, on_repeat="least").where("kind = 'hot'").collect()} == {"G"}
        with pytest.raises(Exception, match="two categories for hot"):
            attach_category(frame, twice).collect()
        assert attach_category(frame, lookup.limit(0)).where("category IS NOT NULL").count() == 0
        assert attach_category(frame.limit(0), lookup).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ranks(spark):
    rng = random.Random(9)
    values = [(k, rng.choice([1.0, 1.0, 2.5, rng.random(), None]), rng.randrange(99)) for k in range(5000)]
    frame = spark.createDataFrame(values, "member int, score double, rank int").drop("rank").repartition(7)
    found = with_rank(frame, [F.desc("score"), F.asc("member")])
    assert found.columns == ["member", "score", "rank"]
    ordered = sorted(values, key=lambda row: (row[1] is None, -(row[1] or 0), row[0]))
    assert sorted((r["rank"], r["member"]) for r in found.collect()) == [(n, row[0]) for n, row in enumerate(ordered, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan
    assert with_rank(frame.limit(0), [F.col("score")]).count() == 0
