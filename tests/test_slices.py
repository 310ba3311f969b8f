"""Ordered operators on skewed data: same results however rows are cut and spread."""

import random

import pytest
from pyspark.sql import functions as F

from rillframe.operators import combine, faults, rates, segments
from rillframe.plans import Lineup, last_run, max_run, min_run, sum_run
from rillframe.plans.slices import SLICE, add_slices


def skewed(spark, seed, rows=400, hot=0):
    """A third of the rows under one key, a third of all times the same instant, some NULL keys."""
    rnd = random.Random(seed)
    data = []
    for i in range(rows):
        key = hot if rnd.random() < 0.34 else rnd.choice([None, *range(1, 40)])
        at = 500 if rnd.random() < 0.34 else rnd.randint(0, 1000)
        data.append((key, at, i, rnd.randint(-50, 50), rnd.random() < 0.1))
    rnd.shuffle(data)
    return data, spark.createDataFrame(data, "k int, t int, id int, v bigint, bad boolean").repartition(7)


def groups(data, by):
    out = {}
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        out.setdefault(row[0] if by else (), []).append(row)
    return out


def by_id(df, *names):
    return {r.id: tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("seed, hot", [(1, 0), (2, None)])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_running_values(tiny_slices, seed, hot, by):
    data, df = skewed(tiny_slices, seed, hot=hot)
    line = Lineup.of(df, by, ["t", "id"])
    assert line.sliced
    some = F.when(F.col("bad"), F.col("v"))
    out = line.numbered("place").sized("size").running(
        s=sum_run(F.col("v")), hi=max_run(F.col("v")), lo=min_run(F.col("v")), last=last_run(some))
    want = {}
    for rows in groups(data, by).values():
        total, seen, last = 0, [], None
        for place, (_, _, i, v, bad) in enumerate(rows):
            total, last = total + v, v if bad else last
            seen.append(v)
            want[i] = (place, len(rows), total, max(seen), min(seen), last)
    assert by_id(out.rows(), "place", "size", "s", "hi", "lo", "last") == want
    assert set(out.rows().columns) == {*df.columns, "place", "size", "s", "hi", "lo", "last"}


@pytest.mark.parametrize("by", [[], ["k"]])
def test_throttle_restart_split(tiny_slices, by):
    data, df = skewed(tiny_slices, 5)
    released, restarted, parts = {}, {}, {}
    for rows in groups(data, by).values():
        last, epoch, total, segment = None, 0, 0, 0
        for _, t, i, v, bad in rows:
            last = t if last is None else max(t, last + 3)
            released[i] = (last,)
            if bad:
                epoch, total, segment = epoch + 1, 0, segment + 1
            else:
                total += v
                restarted[i] = (epoch, total)
            parts[i] = (segment, bad)
    order = ["t", "id"]
    assert by_id(rates.throttle(df, by, order, F.col("t"), 1, 3), "release") == released
    assert by_id(faults.restart_scan(df, by, order, F.col("bad"), F.col("v")), "epoch", "running") == restarted
    assert by_id(segments.split_when(df, by, order, F.col("bad")), "segment", "opener") == parts


@pytest.mark.parametrize("policy", ["drop_head", "drop_tail", "drop_new", "drop_buffer"])
@pytest.mark.parametrize("limited", [True, False])
def test_shed_like_a_buffer(tiny_slices, monkeypatch, policy, limited):
    if not limited:
        monkeypatch.setattr(rates, "GROUP_LIMIT", 0)
    data, df = skewed(tiny_slices, 7)
    full = {"drop_head": lambda kept, new: [*kept[1:], new], "drop_tail": lambda kept, new: [*kept[:-1], new],
            "drop_new": lambda kept, new: kept, "drop_buffer": lambda kept, new: [new]}[policy]
    want = set()
    for rows in groups(data, ["k"]).values():
        kept = []
        for row in rows:
            kept = [*kept, row[2]] if len(kept) < 3 else full(kept, row[2])
        want |= set(kept)
    assert {r.id for r in rates.shed(df, ["k"], ["t", "id"], 3, policy).collect()} == want


def test_nothing_and_one_row(tiny_slices):
    _, df = skewed(tiny_slices, 1, rows=1)
    for by in ([], ["k"]):
        assert Lineup.of(df, by, ["t", "id"]).numbered("p").rows().collect()[0].p == 0
        assert Lineup.of(df.limit(0), by, ["t", "id"]).numbered("p").sized("n").rows().count() == 0


def test_slices_rise_with_the_order_and_are_small(spark):
    data, df = skewed(spark, 3, rows=4000)
    spark.conf.set("rillframe.sliceRows", "200")
    try:
        frame, sliced = add_slices(df, [], ["t", "id"])
        rows = frame.select("t", "id", SLICE).orderBy("t", "id").collect()
    finally:
        spark.conf.unset("rillframe.sliceRows")
    slices = [r[SLICE] for r in rows]
    assert sliced and slices == sorted(slices)
    sizes = {}
    for s in slices:
        sizes[s] = sizes.get(s, 0) + 1
    assert max(sizes.values()) < 600, "the instant shared by a third of the rows is cut by the second column"


def test_light_keys_are_not_cut(spark):
    _, df = skewed(spark, 3)
    spark.conf.set("rillframe.sliceRows", "100")
    try:
        frame, sliced = add_slices(df, ["k"], ["t", "id"])
        light = frame.filter("k <> 0 or k is null").select(SLICE).distinct().collect()
        hot = frame.filter("k = 0").select(SLICE).distinct().count()
    finally:
        spark.conf.unset("rillframe.sliceRows")
    assert sliced and [r[0] for r in light] == [0] and hot > 1


@pytest.mark.parametrize("kind", ["double", "decimal(20,3)", "date", "timestamp", "timestamp_ntz", "bigint"])
def test_order_types(tiny_slices, kind):
    base = tiny_slices.range(60)
    value = {"date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")),
             "timestamp": F.timestamp_micros(F.col("id")), "timestamp_ntz": F.timestamp_micros(F.col("id"))}
    rows = base.select(value.get(kind, F.col("id")).cast(kind).alias("o"), "id")
    placed = Lineup.of(rows, [], ["o"]).numbered("p").rows()
    assert placed.filter("p <> id").count() == 0
    with pytest.raises(TypeError):
        Lineup.of(base.select(F.array("id").alias("o")), [], ["o"])


def test_concat_and_preferred_with_hot_groups(tiny_slices):
    data, df = skewed(tiny_slices, 9)
    rows = df.select(F.coalesce("k", F.lit(-1)).alias("k"), "t", "id")
    joined = combine.concat([rows.filter("id % 3 = 0"), rows.filter("id % 3 > 0")], ["t", "id"])
    want = sorted(((r[2] % 3 > 0), r[1], r[2]) for r in data)
    assert by_id(joined, "place") == {i: (p,) for p, (_, _, i) in enumerate(want)}
    first = combine.merge_preferred(rows.filter("id % 3 = 0"), [rows.filter("id % 3 > 0")], ["k"], ["t", "id"])
    want = {}
    for k, t, i, _, _ in data:
        want.setdefault(-1 if k is None else k, []).append((i % 3 > 0, t, i))
    assert by_id(first, "place") == {i: (p,) for rs in want.values() for p, (_, _, i) in enumerate(sorted(rs))}


def test_three_order_columns(spark):
    """Two columns with heavy values in a row: the third one cuts."""
    rows = spark.range(3000).select((F.col("id") % 2).alias("a"), F.lit(1.5).alias("b"), F.col("id").alias("c"))
    spark.conf.set("rillframe.sliceRows", "150")
    try:
        found = add_slices(rows, [], ["a", "b", "c"])[0].groupBy(SLICE).count().collect()
        placed = Lineup.of(rows, [], ["a", "b", "c"]).numbered("p").rows()
    finally:
        spark.conf.unset("rillframe.sliceRows")
    assert max(r["count"] for r in found) < 500
    assert placed.filter("p <> a * 1500 + c div 2").count() == 0


def test_nan_and_null_order_values(tiny_slices):
    values = [None, float("-inf"), -1.0, 2.5, 2.5, float("inf"), float("nan")] * 5
    rows = tiny_slices.createDataFrame([(v, i) for i, v in enumerate(values)], "o double, id bigint")
    placed = Lineup.of(rows, [], ["o", "id"]).numbered("p").rows().orderBy("o", "id").collect()
    assert [r.p for r in placed] == list(range(len(values)))


@pytest.mark.parametrize("by", [[], ["k"]])
def test_grid_over_long_spans(tiny_slices, by):
    data, df = skewed(tiny_slices, 11, rows=150)
    want = []
    for key, rows in groups(data, by).items():
        last = {}
        for _, t, i, v, _ in rows:
            last[t] = v
        ticks = sorted(last)
        for a, b in zip(ticks, [*ticks[1:], ticks[-1] + 1]):
            want += [((key,) if by else ()) + (t, last[a], t - a, t > a) for t in range(a, b)]
    got = rates.extrapolate(df, by, ["t", "id"], F.col("t"), F.col("v"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_text_order_is_cut(tiny_slices):
    """Text of any length, with shared beginnings, NULL and non-ASCII letters."""
    spark, rng = tiny_slices, random.Random(4)
    values = [None, "", "a", "ab", "ab\0", "ß", "é", "zz"] + ["common-prefix-of-many-bytes-" + str(rng.randrange(40)) for _ in range(120)]
    rows = [(k % 2, v, i) for i, (k, v) in enumerate((rng.randrange(10), v) for v in values)]
    df = spark.createDataFrame(rows, "k int, t string, i int").repartition(3)
    out = Lineup.of(df, ["k"], ["t", "i"]).numbered("n").rows().collect()
    for key in (0, 1):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[2]))
        assert {r.i: r.n for r in out if r.k == key} == {r[2]: n for n, r in enumerate(own)}


def test_times_without_zone_are_cut_alike_in_any_zone(tiny_slices):
    spark = tiny_slices
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    spark.conf.set("rillframe.sliceRows", "2")
    try:
        rows = spark.sql("SELECT id, timestamp_ntz'2024-03-10 00:00:00' + make_dt_interval(0, 0, cast(id * 5 as int)) AS t FROM range(48)")
        out = Lineup.of(rows, [], ["t"]).numbered("n").rows().collect()
        assert all(r.id == r.n for r in out)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("by", [[], ["g"]])
def test_a_text_that_fills_slices_is_cut_by_the_next_column(spark, by):
    """Half of the rows have one text, others share its first 48 bytes and more."""
    stem = "the same beginning of very many texts, " * 4
    rows = [("a" if i % 50 else "b", stem if i % 2 else f"{stem}{i % 5}" if i % 4 else f"{i * 7919 % 1000:04}", i * 7919 % 4001, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, text string, t int, v int").repartition(4)
    spark.conf.set("rillframe.sliceRows", "200")
    try:
        frame, sliced = add_slices(df, by, ["text", "t"])
        sizes = {r[SLICE]: r["count"] for r in frame.groupBy(SLICE).count().collect() if r[SLICE]}
        seen = frame.filter(F.col(SLICE) > 0).select("text", "t", SLICE).collect()
        line = Lineup.of(df, by, ["text", "t"]).running(total=sum_run(F.col("v"))).rows()
        got = {(r.text, r.t, r.g): r.total for r in line.collect()}
    finally:
        spark.conf.unset("rillframe.sliceRows")
    assert sliced and max(sizes.values()) < 800
    order = [r[SLICE] for r in sorted(seen, key=lambda r: (r.text, r.t))]
    assert order == sorted(order) if not by else True
    want, totals = {}, {}
    for g, text, t, v in sorted(rows, key=lambda r: (r[1], r[2])):
        key = g if by else None
        totals[key] = totals.get(key, 0) + v
        want[text, t, g] = totals[key]
    assert got == want


def test_a_survey_says_where_rows_end(spark):
    from rillframe.plans.slices import survey

    for parts, values in ((1, range(1000)), (7, [i * i % 997 for i in range(5000)]), (3, [5] * 400)):
        df = spark.createDataFrame([(v,) for v in values], "x int").repartition(parts)
        own = survey(df, ["x"])
        assert own.rows == len(values)
        for n in (1, 10, len(values) // 2, len(values)):
            bound = own.holding(n)
            assert sum(v <= bound for v in values) >= n
    assert survey(df.limit(0), ["x"]).rows == 0
