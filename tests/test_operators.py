"""Small inputs with results worked out by hand."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rillframe.functions import text, values
from rillframe.operators import basic, combine, enrich, fanout, faults, feedback, masking, measure, rates, segments
from rillframe.sources.tables import empty, single, whole_range


TABLES = "/root/testdata/sf0.001"


def ints(spark, first, last):
    return whole_range(spark, first, last)


def column(df, name, *order):
    return [r[0] for r in df.orderBy(*order).select(name).collect()]


def nations(spark):
    return [r.n_name for r in spark.read.parquet(f"{TABLES}/nation.parquet").orderBy("n_nationkey").collect()]


def documents(spark):
    rows = spark.read.parquet(f"{TABLES}/documents.parquet").where("doc_id < 5").orderBy("doc_id").collect()
    return [r.text for r in rows]


def words(spark, *items):
    return spark.createDataFrame(list(enumerate(items)), "seq bigint, word string")


# Sources, row-wise operators, limits


def test_range_single_empty(spark):
    assert column(ints(spark, 42, 45), "x", "seq") == [42, 43, 44, 45]
    assert single(spark, "x int", 7).collect()[0].x == 7
    assert empty(spark, "x int").count() == 0


def test_map_chain(spark):
    flow = basic.compose(basic.mapped("x", F.col("x") + 1), basic.mapped("x", F.col("x") * 10))
    assert column(flow(ints(spark, 1, 10)), "x", "seq") == list(range(20, 111, 10))


def test_filter_and_take(spark):
    given = nations(spark)
    long = [n for n in given if len(n) > 8]
    found = basic.take(words(spark, *given).filter(F.length("word") > 8), 3, ["seq"])
    assert column(found, "word", "seq") == long[:3]
    doubled = ints(spark, 1, 10).select("seq", values.doubled(F.col("x")).alias("x"))
    assert column(basic.take(doubled, 5, ["seq"]), "x", "seq") == [2, 4, 6, 8, 10]


@pytest.mark.parametrize("n, left", [(0, 10), (3, 7), (10, 0), (11, 0)])
def test_drop(spark, monkeypatch, n, left):
    rows = ints(spark, 1, 10)
    assert column(basic.drop(rows, n, ["seq"]), "x", "seq") == list(range(11 - left, 11))
    monkeypatch.setattr(basic, "FIRST_ROWS", 0)
    assert column(basic.drop(rows, n, ["seq"]), "x", "seq") == list(range(11 - left, 11))


def test_strict_filter_fails_on_bad_value(spark):
    rows = words(spark, "1", "two")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rows.filter(F.col("word").cast("int") > 0).collect()


def test_fold_and_reduce(spark):
    rows = ints(spark, 1, 10)
    assert basic.fold(rows, 0, F.col("x"), "s").collect()[0].s == 55
    assert basic.reduce(rows, s=F.sum("x")).collect()[0].s == 55
    none = rows.filter("x > 99")
    assert basic.fold(none, 7, F.col("x"), "s").collect()[0].s == 7
    assert basic.reduce(none, s=F.sum("x")).collect()[0].s is None
    with pytest.raises(Exception, match="reduce of no rows"):
        basic.reduce(none, strict=True, s=F.sum("x")).collect()


def test_ends(spark):
    got = basic.ends(ints(spark, 1, 10), [], ["seq"], "x").collect()[0]
    assert (got["first"], got["last"]) == (1, 10)


def test_reject_nulls(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "x int, s string")
    assert basic.reject_nulls(rows, ["x"]).count() == 2
    with pytest.raises(Exception, match="NULL in s"):
        basic.reject_nulls(rows, ["x", "s"]).collect()


def test_reject_ties(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, t int")
    assert basic.reject_ties(rows, ["k"], ["t"]).count() == 3
    with pytest.raises(Exception, match="t is not unique"):
        basic.reject_ties(rows, [], ["t"]).collect()


def test_cut_at(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 5)], "k string, t int")
    limits = spark.createDataFrame([("a", 2), (None, 5)], "k string, cut int")
    assert column(basic.cut_at(rows, limits, "t", "cut", ["k"]), "k", "k") == ["a", "b"]
    assert basic.cut_at(rows, limits.filter("k = 'a'"), "t", "cut").count() == 2
    assert basic.cut_at(rows, limits.limit(0), "t", "cut").count() == 4


def test_random_draws_repeat(spark):
    drawn = [basic.random_draws(ints(spark, 1, 1000).repartition(n), "x", 100, 7) for n in (1, 5)]
    one, two = [column(d, "draw", "x") for d in drawn]
    assert one == two and set(one) <= set(range(100)) and len(set(one)) > 90


# Text


@pytest.mark.parametrize("line, count", [
    ("a b c", 3), ("", 1), ("   ", 0), ("a b  ", 2), ("  a", 3), ("a  b", 3), ("one", 1)])
def test_word_count(spark, line, count):
    assert single(spark, "s string", line).select(text.word_count(F.col("s"))).collect()[0][0] == count


def test_fold_word_count(spark):
    given = documents(spark)
    want = sum(len(t.rstrip(" ").split(" ")) for t in given)
    assert basic.fold(words(spark, *given), 0, text.word_count(F.col("word")), "n").collect()[0].n == want


SHIFTED = ["plain", "", "café ł", "퟼", "\U0001f600 x", "￿", "\x03\x01", "a\x00b", None]


@pytest.mark.parametrize("shift", [3, -3, 500, 0, 65536])
def test_shift_text_matches_units(spark, shift):
    def plain(s):
        raw = s.encode("utf-16-be")
        units = [(int.from_bytes(raw[i:i + 2], "big") + shift) % 65536 for i in range(0, len(raw), 2)]
        try:
            return b"".join(u.to_bytes(2, "big") for u in units).decode("utf-16-be")
        except UnicodeDecodeError:
            return None

    rows = spark.createDataFrame([(s,) for s in SHIFTED], "s string")
    got = rows.select("s", text.shift_text(F.col("s"), shift).alias("m")).collect()
    assert [r.m for r in got] == [None if r.s is None else plain(r.s) for r in got]


def test_mask_and_audit(spark):
    rows = words(spark, "river", "is", "wide")
    masked = masking.mask(rows, ["word"], 3)
    assert column(masked, "word", "seq") == ["ulyhu", "lv", "zlgh"]
    assert column(masking.unmask(masked, ["word"], 3), "word", "seq") == ["river", "is", "wide"]
    odd = rows.unionByName(words(spark, "퟾"))
    assert tuple(masking.audit(odd, "word", 3).collect()[0]) == (4, 1)


# Fan-in


def test_merge_keeps_duplicates(spark):
    assert combine.merge(ints(spark, 1, 3), ints(spark, 1, 3)).count() == 6


def test_concat(spark):
    both = combine.concat([ints(spark, 1, 10), ints(spark, 42, 1000)], ["x"])
    assert column(both, "x", "place") == [*range(1, 11), *range(42, 1001)]
    assert column(both, "place", "place") == list(range(969))


def test_merge_preferred(spark):
    rows = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "bucket int, k int")
    wanted = spark.createDataFrame([(1, 99), (3, 98)], "bucket int, k int")
    out = combine.merge_preferred(wanted, [rows], ["bucket"], ["k"])
    assert column(out, "k", "bucket", "place") == [99, 10, 11, 12, 98]


def test_zip_ends_with_the_shorter(spark):
    left = ints(spark, 1, 5).select(F.col("x").alias("a"))
    right = ints(spark, 11, 13).select(F.col("x").alias("b"))
    zipped = combine.zip_by_place((left, ["a"]), (right, ["b"])).orderBy("place")
    assert [tuple(r) for r in zipped.collect()] == [(0, 1, 11), (1, 2, 12), (2, 3, 13)]


def test_zip_same_source(spark):
    out = combine.zip_same(ints(spark, 1, 1000), a=F.col("x") + 1, b=F.col("x") * 10).orderBy("seq").collect()
    assert len(out) == 1000
    assert (out[0].a, out[0].b, out[-1].a, out[-1].b) == (2, 10, 1001, 10000)


def test_max_of_three(spark):
    a, b, c = list(range(1, 11)), [5] * 10, list(range(10, 0, -1))
    tables = [spark.createDataFrame(list(enumerate(xs)), f"s{i} bigint, x{i} int") for i, xs in enumerate((a, b, c))]
    zipped = combine.zip_by_place(*[(t, [f"s{i}"]) for i, t in enumerate(tables)])
    assert column(combine.max_of(zipped, "m", "x0", "x1", "x2"), "m", "place") == [10, 9, 8, 7, 6, 6, 7, 8, 9, 10]
    missing = spark.createDataFrame([(1, None)], "a int, b int")
    assert combine.max_of(missing, "m", "a", "b").collect()[0].m is None


# Fan-out


def test_balance(spark):
    dealt = fanout.balance(ints(spark, 1, 10), ["seq"], 3)
    assert column(dealt, "lane", "seq") == [0, 1, 2, 0, 1, 2, 0, 1, 2, 0]
    merged = fanout.balance_mxn([ints(spark, 1, 10), ints(spark, 1, 5)], ["x"], 3)
    counts = {r.lane: r.rows for r in fanout.lane_counts(merged).collect()}
    assert counts == {0: 5, 1: 5, 2: 5}


def test_flag(spark):
    """The dearest tenth of the orders."""
    orders = spark.read.parquet(f"{TABLES}/orders.parquet").select("o_orderkey", "o_totalprice")
    prices = {r.o_orderkey: r.o_totalprice for r in orders.collect()}
    limit = sorted(prices.values())[len(prices) * 9 // 10]
    dear = sorted(k for k, p in prices.items() if p > limit)
    everything, flagged = fanout.flag(orders, "o_orderkey", F.col("o_totalprice") > limit)
    assert everything.count() == len(prices) and dear
    assert sorted(r.o_orderkey for r in flagged.collect()) == dear
    out = fanout.copies(orders, {"all": F.lit(True), "flagged": F.col("o_totalprice") > limit})
    assert out.filter("outlet = 'flagged'").count() == len(dear) and out.count() == len(prices) + len(dear)


def test_word_sink(spark):
    given = documents(spark)[0].split(" ")
    got = fanout.word_sink(words(spark, *given), "word").collect()[0]
    assert (got.short_words, got.lower_words) == (sum(len(w) < 5 for w in given), sum(w == w.lower() for w in given))


# Groups and segments


def test_group_fold_and_limit(spark):
    given = [*nations(spark), ""]
    lettered = words(spark, *given).select(text.first_letter(F.col("word")).alias("letter"))
    want = Counter(n[:1].lower() for n in given)
    out = segments.group_fold(lettered, "letter", 30, n=F.count(F.lit(1)))
    assert {r.letter: r.n for r in out.collect()} == want
    assert segments.group_fold(lettered, "letter", len(want), n=F.count(F.lit(1))).count() == len(want)
    with pytest.raises(Exception, match=f"more than {len(want) - 1} groups"):
        segments.group_fold(lettered, "letter", len(want) - 1, n=F.count(F.lit(1))).collect()


def test_merge_groups(spark):
    given = documents(spark)
    rows, size = words(spark, *given), F.length("word")
    sizes = [len(t) for t in given]
    for kind, want in (("sum", sum(sizes)), ("max", max(sizes)), ("min", min(sizes)), ("count", len(sizes))):
        assert segments.merge_groups(rows, size % 2, size, "n", kind).collect()[0].n == want


def test_split_when(spark):
    given = documents(spark)[0]
    parts = segments.split_when(words(spark, *given), [], ["seq"], F.col("word") == "\n")
    sizes = parts.groupBy("segment").agg(F.count_if(~F.col("opener")).alias("n"))
    assert column(sizes.where("n > 0"), "n", "segment") == [len(line) for line in given.split("\n") if line]


def test_batches(spark):
    out = segments.batches(ints(spark, 1, 25), [], ["seq"], 10, "x")
    assert column(out, "size", "batch") == [10, 10, 5]
    assert column(out, "items", "batch")[2] == [21, 22, 23, 24, 25]
    assert segments.batches(ints(spark, 1, 25).limit(0), [], ["seq"], 10, "x").count() == 0


def test_conflate(spark):
    rows = words(spark, "a", "b", "c", "d").withColumn("k", F.when(F.col("seq") < 3, 1).otherwise(2))
    out = {r.k: (r.description, r.instances) for r in segments.conflate(rows, ["k"], "word").collect()}
    assert out == {1: ("You have 3 events that require your attention", 3), 2: ("d", 1)}
    again = rows.withColumn("times", F.lit(2).cast("bigint"))
    got = segments.conflate(again, ["k"], "word", F.col("times")).filter("k = 1").collect()[0]
    assert got.instances == 6 and got.description.startswith("You have 6 events")


def test_flat_map(spark):
    rows = ints(spark, 1, 5)
    spread = F.sequence("x", F.col("x") * 3)
    ordered = segments.flat_map_concat(rows, spread, "y").orderBy("seq", "pos").collect()
    assert [r.y for r in ordered] == [y for x in range(1, 6) for y in range(x, 3 * x + 1)]
    assert sorted(column(segments.flat_map_merge(rows, spread, "y"), "y", "y")) == sorted(r.y for r in ordered)


def test_scan(spark):
    assert column(segments.scan(ints(spark, 1, 5), [], ["seq"], F.col("x")), "running", "place") == [0, 1, 3, 6, 10, 15]
    nothing = ints(spark, 1, 5).filter("x > 9")
    assert column(segments.scan(nothing, [], ["seq"], F.col("x"), seed=4), "running", "place") == [4]
    keyed = ints(spark, 1, 5).withColumn("k", F.col("x") % 2)
    got = segments.scan(keyed, ["k"], ["seq"], F.col("x")).orderBy("k", "place").collect()
    assert [(r.k, r.running) for r in got] == [(0, 0), (0, 2), (0, 6), (1, 0), (1, 1), (1, 4), (1, 9)]


# Rates


def test_throttle(spark):
    arrivals = [0, 1, 2, 50, 51, 200]
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(arrivals)], "seq bigint, came bigint")
    out = rates.throttle(rows, [], ["seq"], F.col("came"), 2, 20)
    assert column(out, "release", "seq") == [0, 10, 20, 50, 60, 200]


KEPT = {"drop_head": range(16, 26), "drop_new": range(1, 11), "drop_tail": [*range(1, 10), 25],
        "drop_buffer": range(21, 26), "backpressure": range(1, 26)}


@pytest.mark.parametrize("policy", KEPT)
@pytest.mark.parametrize("limited", [True, False])
def test_shed(spark, monkeypatch, policy, limited):
    if not limited:
        monkeypatch.setattr(rates, "GROUP_LIMIT", 0)
    rows = ints(spark, 1, 25).withColumn("k", F.lit(1))
    assert column(rates.shed(rows, ["k"], ["seq"], 10, policy), "x", "x") == list(KEPT[policy])


def test_shed_fail(spark):
    rows = ints(spark, 1, 25).withColumn("k", F.lit(1))
    assert rates.shed(rows, ["k"], ["seq"], 25, "fail").count() == 25
    with pytest.raises(Exception, match="buffer of 24 rows overflows"):
        rates.shed(rows, ["k"], ["seq"], 24, "fail").collect()
    with pytest.raises(ValueError):
        rates.shed(rows, ["k"], ["seq"], 24, "drop_all")


def test_grid(spark):
    rows = spark.createDataFrame([("a", 1, 0, 5), ("a", 1, 1, 7), ("a", 4, 2, 9), ("b", 2, 3, 1)],
                                 "k string, t int, id int, v bigint")
    filled = rates.fill_forward(rows, ["k"], ["t", "id"], F.col("t"), F.col("v")).orderBy("k", "tick")
    assert [tuple(r) for r in filled.collect()] == [("a", 1, 7), ("a", 2, 7), ("a", 3, 7), ("a", 4, 9), ("b", 2, 1)]
    counted = rates.expand(rows, ["k"], ["t", "id"], F.col("t"), F.col("v")).orderBy("k", "tick")
    assert [(r.value, r.synthetic) for r in counted.collect()] == [
        (7, False), (8, True), (9, True), (9, False), (1, False)]


# Faults


def test_recover_resume_stop(spark):
    ten, twenty = ints(spark, 1, 10), ints(spark, 1, 20)
    out = faults.recover(ten, [], ["seq"], F.col("x") == 6, {"x": F.lit(-2147483648)})
    assert column(out, "x", "seq") == [1, 2, 3, 4, 5, -2147483648]
    assert column(faults.recover(ten, [], ["seq"], F.col("x") == 60, {}), "x", "seq") == list(range(1, 11))
    bad = F.col("x") == 13
    assert column(faults.resume(twenty, bad), "x", "seq") == [x for x in range(1, 21) if x != 13]
    assert column(faults.quarantine(twenty, bad), "x", "seq") == [13]
    assert column(faults.stop(twenty, [], ["seq"], bad), "x", "seq") == list(range(1, 13))


def test_recover_with(spark):
    bad = F.col("x").isin(6, 95)
    spare, other = ints(spark, 90, 99), ints(spark, 70, 72)
    out = faults.recover_with(ints(spark, 1, 10), [], ["seq"], bad, [spare, other])
    assert column(out, "x", "attempt", "seq") == [1, 2, 3, 4, 5, 90, 91, 92, 93, 94, 70, 71, 72]
    fine = faults.recover_with(ints(spark, 1, 5), [], ["seq"], bad, [spare, other])
    assert column(fine, "x", "attempt", "seq") == [1, 2, 3, 4, 5]
    with pytest.raises(Exception, match="all replacements failed"):
        faults.recover_with(ints(spark, 1, 10), [], ["seq"], bad, [spare]).collect()
    keyed = ints(spark, 1, 10).withColumn("k", F.col("x") % 2)
    spares = spare.withColumn("k", F.col("x") % 2)
    got = faults.recover_with(keyed, ["k"], ["seq"], F.col("x") == 6, [spares])
    assert column(got.filter("k = 0"), "x", "attempt", "seq") == [2, 4, 90, 92, 94, 96, 98]
    assert column(got.filter("k = 1"), "x", "attempt", "seq") == [1, 3, 5, 7, 9]


def test_restart_clears_state_and_resume_keeps_it(spark):
    bad = F.col("x") == 3
    out = faults.restart_scan(ints(spark, 1, 5), [], ["seq"], bad, F.col("x"))
    assert column(out, "running", "seq") == [1, 3, 4, 9]
    kept = segments.scan(faults.resume(ints(spark, 1, 5), bad), [], ["seq"], F.col("x"))
    assert column(kept, "running", "place") == [0, 1, 3, 7, 12]


def test_replay_dedupe(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 2, "c")], "k int, attempt int, v string")
    assert column(faults.replay_dedupe(rows, ["k"], "attempt"), "v", "k") == ["a", "c"]


# Measures, lookups, feedback


def test_counted(spark):
    rows, seen = measure.counted(lambda df: df.filter("x <= 40"))(ints(spark, 1, 42))
    measure.drain(rows)
    assert seen.get["count"] == 40
    rows, seen = measure.traced(ints(spark, 1, 42), "x")
    measure.drain(rows)
    assert seen.get == {"count": 42, "low": 1, "high": 42}


def test_on_call(spark):
    roster = enrich.duty_roster(spark, [("p", "p@x"), ("q", "q@x"), ("r", "r@x")])
    days = [dt.datetime(1970, 1, 1, 23), dt.datetime(1970, 1, 2, 1), dt.datetime(1969, 12, 31, 5)]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "seq int, at timestamp_ntz")
    assert column(enrich.on_call(rows, roster, F.col("at")), "engineer", "seq") == ["p", "q", "r"]
    with pytest.raises(ValueError):
        enrich.on_call(rows, roster.limit(0), F.col("at"))


def test_map_async_keeps_every_row(spark):
    out = enrich.map_async(ints(spark, 1, 100), lambda f: f.assign(x=f["x"] * 2), "seq bigint, x bigint", 4)
    assert column(out, "x", "seq") == [2 * x for x in range(1, 101)]
    assert out.rdd.getNumPartitions() == ints(spark, 1, 100).rdd.getNumPartitions()


def test_notify_nests(spark):
    rows = words(spark, "down")
    out = enrich.notify(rows, F.lit("ops@example.org"), F.col("word"), F.current_timestamp(), F.lit(1))
    assert out.select("email", "event.description", "event.instances").collect()[0] == ("ops@example.org", "down", 1)


def test_hop_distance(spark):
    edges = spark.createDataFrame([(0, 10), (0, 11), (1, 11), (1, 12), (2, 12), (3, 99)], "s bigint, p bigint")
    start = spark.createDataFrame([(0,)], "node bigint")
    full = feedback.hop_distance(edges, "s", "p", start, 9)
    got = {(r.kind, r.node): r.hops for r in full.collect()}
    assert got == {("s", 0): 0, ("p", 10): 1, ("p", 11): 1, ("s", 1): 2, ("p", 12): 3, ("s", 2): 4}
    assert feedback.hop_distance(edges, "s", "p", start, 1).count() == 3


def test_drop_with_nulls_and_ties(spark, monkeypatch):
    rows = spark.createDataFrame([(None,), (1,), (2,), (2,), (2,), (3,)], "x int")
    for limit in (100_000, 0):
        monkeypatch.setattr(basic, "FIRST_ROWS", limit)
        for n in range(8):
            left = sorted((r.x for r in basic.drop(rows, n, ["x"]).collect()), key=lambda x: (x is not None, x))
            assert left == [None, 1, 2, 2, 2, 3][n:]


def test_throttle_keeps_its_rate(spark):
    rows = spark.createDataFrame([(i, 0) for i in range(40)], "i long, t long")
    out = rates.throttle(rows, [], ["i"], F.col("t"), 6, 10)
    assert column(out, "release", "i") == [-(-i * 10 // 6) for i in range(40)]
    fast = rates.throttle(rows, [], ["i"], F.col("t"), 20, 3)
    assert column(fast, "release", "i") == [-(-i * 3 // 20) for i in range(40)]


def test_grid_of_a_long_gap_and_a_null_tick(spark):
    rows = spark.createDataFrame([(0, 5), (300_000, 7)], "t long, v int")
    out = rates.fill_forward(rows, [], ["t"], F.col("t"), F.col("v"))
    assert out.count() == 300_001 and out.agg(F.sum("value")).collect()[0][0] == 5 * 300_000 + 7
    with pytest.raises(Exception, match="a tick is NULL"):
        odd = rows.unionByName(spark.createDataFrame([(None, 1)], "t long, v int"))
        rates.fill_forward(odd, [], ["t"], F.col("t"), F.col("v")).collect()


def test_long_roster(spark):
    people = [(f"p{i}", f"p{i}@example.org") for i in range(12_000)]
    day = spark.createDataFrame([(dt.date(1970, 1, 1) + dt.timedelta(days=11_500),)], "d date")
    assert enrich.on_call(day, enrich.duty_roster(spark, people), F.col("d")).collect()[0].engineer == "p11500"


def test_folds_of_every_kind(spark):
    rows = ints(spark, 1, 10)
    for kind, seed, want in (("sum", 3, 58), ("max", 3, 10), ("min", 0, 0), ("count", 1, 11)):
        assert basic.fold(rows, seed, F.col("x"), "s", kind=kind).collect()[0].s == want
    odd = spark.createDataFrame([(1, 4), (2, None), (3, 9), (4, 2)], "i int, x int")
    for kind, seed, want in (("max", None, [None, 4, 4, 9, 9]), ("min", 3, [3, 3, 3, 3, 2]), ("last", None, [None, 4, 4, 9, 2]),
                             ("count", 0, [0, 1, 1, 2, 3]), ("sum", 1, [1, 5, 5, 14, 16])):
        assert column(segments.scan(odd, [], ["i"], F.col("x"), seed=seed, kind=kind), "running", "place") == want


def test_conflate_with_a_date_and_own_words(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 5, "y"), ("b", 2, "z")], "k string, t int, d string")
    out = segments.conflate(rows, ["k"], "d", at=F.col("t"), merge=lambda n: F.concat(F.lit("many: "), n))
    assert sorted(tuple(r) for r in out.collect()) == [("a", "many: 2", 2, 5), ("b", "z", 1, 2)]


def test_map_async_has_calls_in_flight_and_keeps_order(spark):
    def slow(frame):
        import time

        time.sleep(0.2 if frame["x"].iloc[0] % 20 == 1 else 0.05)
        return frame.assign(at=time.time())

    rows = ints(spark, 1, 100).select("x").coalesce(1)
    start = dt.datetime.now()
    out = enrich.map_async(rows, slow, "x long, at double", parallelism=8, rows=10).collect()
    assert [r.x for r in out] == list(range(1, 101)) and (dt.datetime.now() - start).seconds < 20
    first, second = (next(r.at for r in out if r.x == x) for x in (1, 11))
    assert second < first  # the second call came back before the first


def test_bound_that_cuts_is_told(spark):
    edges = spark.createDataFrame([(0, 10), (1, 10), (1, 11), (2, 11)], "l long, r long")
    start = spark.createDataFrame([(0,)], "node long")
    with pytest.warns(UserWarning, match="stopped after 2 rounds"):
        assert feedback.hop_distance(edges, "l", "r", start, 2).count() == 3


def test_drop_among_many_ties(spark):
    """An order value that most rows share: exactly n go, the same ones however the rows lie, and no task gets them all."""
    rows = [(1, i % 50, "x") for i in range(3000)] + [(0, 7, "y"), (2, 7, None)]
    df = spark.createDataFrame(rows, "o int, v int, s string")
    for n in (1, 2, 31, 62, 3001):
        want = Counter(sorted(rows, key=lambda r: r[:2])[n:])
        for parts in (1, 5):
            found = basic.drop(df.repartition(parts), n, ["o"])
            assert found.columns == df.columns and Counter(map(tuple, found.collect())) == want
    same = spark.createDataFrame([(1,)] * 2000, "o int").repartition(6)
    left = basic.drop(same, 10, ["o"])
    assert left.count() == 1990
    assert max(r["count"] for r in left.groupBy(F.spark_partition_id()).count().collect()) < 1000
