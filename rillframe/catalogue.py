"""One query per operator over the given tables.

Amounts are whole cents and every order ends in a unique column, so results do
not depend on the order of evaluation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillframe.functions import text, values
from rillframe.operators import (
    basic, combine, enrich, fanout, faults, feedback, masking, measure, rates, segments, steps,
)
from rillframe.plans import Lineup
from rillframe.session import fit_shuffles, pin
from rillframe.sources import keyed, topics
from rillframe.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

IN_ORDER = ["ts", "event_id"]
ROSTER = [("Ines", "ines@example.org"), ("Omar", "omar@example.org"), ("Wei", "wei@example.org")]
HOUR = 3_600_000_000

# Limits, shift, sentinel and replacement rows of the queries.
FLAGGED_ABOVE = 1_000_000  # cents
SHORT_WORD = 5
SHIFT = 3
SENTINEL = -2147483648
REPLACEMENT = (90, 99)
BAD = "k = 13"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        fit_shuffles(pin(spark), folder)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return run


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", "ts", "user_id", "event_type",
        values.cents(F.col("value")).alias("v"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        values.day(F.col("ts")).alias("day"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").withColumn("cents", values.cents(F.col("o_totalprice")))


def as_text(*days: str):
    return [F.col(c).cast("string").alias(c) for c in days]


# Row-wise operators, limits, cuts


@query
def map_chain(spark, folder):
    flow = basic.compose(basic.mapped("x", F.col("v") + 1), basic.mapped("x", F.col("x") * 10))
    return flow(events(spark, folder)).select("event_id", "x")


@query
def filter_take(spark, folder):
    dear = orders(spark, folder).filter(F.col("cents") > 10_000_000)
    return basic.take(dear.select("o_orderkey", "cents"), 100, ["o_orderkey"])


@query
def filter_strict(spark, folder):
    kept = events(spark, folder).filter(F.col("k") > 50)
    return basic.reduce(kept, ["event_type"], rows=F.count(F.lit(1)), total=F.sum("k"))


@query
def drop_n(spark, folder):
    rest = basic.drop(orders(spark, folder), 1000, ["o_orderkey"])
    return basic.reduce(rest, ["o_orderstatus"], rows=F.count(F.lit(1)), total=F.sum("cents"))


@query
def head_last(spark, folder):
    return basic.ends(events(spark, folder), ["user_id"], IN_ORDER, "event_id")


@query
def fold_word_count(spark, folder):
    docs = table(spark, folder, "documents")
    return basic.fold(docs, 0, text.word_count(F.col("text")), "words", ["lang"])


@query
def reduce_sum(spark, folder):
    totals = dict(total=F.sum("v"), low=F.min("v"), high=F.max("v"))
    return basic.reduce(events(spark, folder), ["event_type"], **totals)


@query
def deferred_scalar(spark, folder):
    rows = orders(spark, folder).select("o_orderkey", "cents")
    wide = F.col("cents").cast("decimal(38,0)")
    later = rows.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(wide).alias("total"))).scalar()
    return rows.filter(wide * later["n"].cast("decimal(20,0)") > later["total"])


@query
def random_source(spark, folder):
    drawn = basic.random_draws(events(spark, folder), "event_id", 100, seed=7)
    drawn = basic.random_draws(drawn, "event_id", 100, seed=7, name="again")
    drawn = basic.random_draws(drawn, "event_id", 100, seed=8, name="other")
    # enough different draws, a mean near the middle, and another seed draws otherwise
    spread = (F.count_distinct("draw") >= 60) & F.avg("draw").between(35, 64) & (F.count_if(F.col("draw") == F.col("other")) * 10 < F.count(F.lit(1)))
    return drawn.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("draw").between(0, 99)).alias("in_range"),
        F.count_if(F.col("draw") == F.col("again")).alias("again"), spread.alias("spread"),
    )


@query
def take_until(spark, folder):
    rows = events(spark, folder)
    own = rows.filter(F.expr(BAD)).groupBy("event_type").agg(F.min("ts").alias("cut"))
    return basic.cut_at(rows, own, "ts", "cut", ["event_type"]).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"))


@query
def take_until_shared(spark, folder):
    rows = events(spark, folder)
    first = rows.filter(F.expr(BAD)).agg(F.min("ts").alias("cut"))
    return basic.cut_at(rows, first, "ts", "cut").groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


@query
def double_reply(spark, folder):
    nation = table(spark, folder, "nation")
    return nation.select(
        values.doubled(F.col("n_nationkey")).cast("bigint").alias("number"),
        values.repeated(F.col("n_name")).alias("name"),
    )


# Order


@query
def with_seq(spark, folder):
    rows = events(spark, folder).select("event_id", "ts")
    return Lineup.of(rows, [], IN_ORDER).numbered("seq").rows().select("event_id", "seq")


@query
def scan_user(spark, folder):
    rows = events(spark, folder).select("user_id", "ts", "event_id", "v")
    return segments.scan(rows, ["user_id"], IN_ORDER, F.col("v")).select("user_id", "place", "event_id", "running")


@query
def scan_global(spark, folder):
    rows = events(spark, folder).select("ts", "event_id", "v")
    return segments.scan(rows, [], IN_ORDER, F.col("v")).select("place", "event_id", "running")


CHECKSUM = dict(seed=7, modulus=1_000_003)  # x -> 31 x + cents


@query
def scan_affine(spark, folder):
    rows = events(spark, folder).select("user_id", "ts", "event_id", "v")
    out = steps.scan(rows, ["user_id"], IN_ORDER, steps.affine(F.lit(31), F.col("v"), **CHECKSUM))
    return steps.with_seed(out, ["user_id"], "running", CHECKSUM["seed"]).select("user_id", "place", "event_id", "running")


@query
def fold_affine(spark, folder):
    rows = events(spark, folder).select("user_id", "ts", "event_id", "v")
    return steps.fold(rows, ["user_id"], IN_ORDER, steps.affine(F.lit(31), F.col("v"), **CHECKSUM), "checksum")


# Groups, segments, batches


@query
def batch_n(spark, folder):
    out = segments.batches(events(spark, folder), ["user_id"], IN_ORDER, 10, "event_id")
    return out.select("user_id", "batch", "size", F.concat_ws(",", F.col("items").cast("array<string>")).alias("ids"))


@query
def group_fold(spark, folder):
    docs = table(spark, folder, "documents")
    words = segments.flat_map_merge(docs.select("text"), text.words(F.col("text")), "word")
    lettered = words.select(text.first_letter(F.col("word")).alias("letter"))
    return segments.group_fold(lettered, "letter", words=F.count(F.lit(1)))


@query
def group_merge_reduce(spark, folder):
    size = F.length("text").cast("bigint")
    return segments.merge_groups(table(spark, folder, "documents"), size % 2, size, "total")


@query
def split_when(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    parts = segments.split_when(turns, ["conv_id"], ["turn"], F.col("role") == "user")
    return parts.groupBy("conv_id", "segment").agg(F.count_if(~F.col("opener")).alias("turns"))


@query
def conflate(spark, folder):
    merged = segments.conflate(events(spark, folder), ["user_id", "day"], "event_type")
    return merged.withColumns({"day": F.col("day").cast("string")})


@query
def flat_map_concat(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    spread = segments.flat_map_concat(part, F.sequence("p_size", F.col("p_size") * 3), "x")
    weighted = F.col("pos").cast("bigint") * F.col("x")
    return spread.groupBy("p_partkey").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("x").alias("total"), F.sum(weighted).alias("weighted"))


@query
def flat_map_merge(spark, folder):
    part = table(spark, folder, "part").select("p_size")
    spread = segments.flat_map_merge(part, F.sequence("p_size", F.col("p_size") * 3), "x")
    return spread.groupBy(F.col("x").cast("bigint").alias("x")).agg(F.count(F.lit(1)).alias("rows"))


# Fan-in


@query
def zip_same_source(spark, folder):
    return combine.zip_same(events(spark, folder).select("event_id", "v"), a=F.col("v") + 1, b=F.col("v") * 10).drop("v")


@query
def zip_tables(spark, folder):
    left = table(spark, folder, "customer").select("c_custkey")
    right = table(spark, folder, "orders").select("o_orderkey")
    return combine.zip_by_place((left, ["c_custkey"]), (right, ["o_orderkey"]))


@query
def max3(spark, folder):
    amounts = [("customer", "c_custkey", "c_acctbal"), ("supplier", "s_suppkey", "s_acctbal"),
               ("part", "p_partkey", "p_retailprice")]
    inputs = [(table(spark, folder, t).select(k, values.cents(F.col(a)).alias(a)), [k]) for t, k, a in amounts]
    zipped = combine.zip_by_place(*inputs)
    return combine.max_of(zipped, "highest", *[a for _, _, a in amounts]).select("place", "highest")


def _two_sources(spark, folder):
    first = orders(spark, folder).select(F.col("o_orderkey").alias("key"), F.col("cents").alias("amount"))
    second = events(spark, folder).select(F.col("event_id").alias("key"), F.col("v").alias("amount"))
    return first, second


@query
def merge(spark, folder):
    return combine.labelled(*_two_sources(spark, folder)).withColumn("src", F.col("src").cast("bigint"))


@query
def concat(spark, folder):
    out = combine.concat(list(_two_sources(spark, folder)), ["key"])
    return out.select("place", F.col("src").cast("bigint").alias("src"), "key", "amount")


@query
def merge_preferred(spark, folder):
    rows = events(spark, folder).select("day", "ts", "event_id", "event_type")
    urgent, rest = rows.filter("event_type = 'error'"), rows.filter("event_type <> 'error'")
    out = combine.merge_preferred(urgent, [rest], ["day"], IN_ORDER)
    return out.select(*as_text("day"), "place", "event_id")


# Fan-out


@query
def broadcast_two(spark, folder):
    totals = fanout.both(events(spark, folder), ["event_type"], rows=F.count(F.lit(1)),
                         plus=F.sum(F.col("v") + 1), times=F.sum(F.col("v") * 10))
    consumers = F.array(*[F.struct(F.lit(n).alias("consumer"), "rows", F.col(n).alias("total")) for n in ("plus", "times")])
    return totals.select("event_type", F.inline(consumers))


@query
def balance(spark, folder):
    dealt = fanout.balance(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 2)
    return fanout.lane_counts(dealt, keys=F.col("o_orderkey"))


@query
def balance_mxn(spark, folder):
    first = table(spark, folder, "orders").select(F.col("o_orderkey").alias("key"))
    second = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"))
    return fanout.lane_counts(fanout.balance_mxn([first, second], ["key"], 3), keys=F.col("key"))


@query
def flag_split(spark, folder):
    rows = orders(spark, folder).select("o_orderkey", "cents")
    dear = F.col("cents") > FLAGGED_ABOVE
    out = fanout.copies(rows, {"all": F.lit(True), "flagged": dear})
    return out.withColumn("cents", F.when(F.col("outlet") == "all", F.col("cents")))


@query
def word_sink(spark, folder):
    docs = table(spark, folder, "documents").select("lang", "text")
    words = segments.flat_map_merge(docs, text.words(F.col("text")), "word")
    return fanout.word_sink(words.select("lang", "word"), "word", ["lang"], SHORT_WORD)


@query
def pubsub(spark, folder):
    names = {"nation": ("n_nationkey", "n_name"), "region": ("r_regionkey", "r_name"), "part": ("p_partkey", "p_name")}
    topic = topics.gather({t: table(spark, folder, t).select(F.col(k).cast("bigint").alias("seq"), F.col(n).alias("msg"))
                           for t, (k, n) in names.items()})
    return topics.consume(topic, {"text": F.col("msg"), "size": F.length("msg").cast("string")})


# Rates, buffers, grids


@query
def throttle(spark, folder):
    rows = events(spark, folder).select("user_id", "ts", "event_id")
    out = rates.throttle(rows, ["user_id"], IN_ORDER, values.micros(F.col("ts")), 1, HOUR)
    return out.select("user_id", "event_id", "release")


def _shed(policy: str) -> Query:
    def run(spark, folder):
        rows = events(spark, folder).select("user_id", "day", "ts", "event_id")
        return rates.shed(rows, ["user_id", "day"], IN_ORDER, 2, policy).select("user_id", *as_text("day"), "event_id")

    run.__name__ = f"shed_{policy}".replace("backpressure", "none")
    return query(run)


for _policy in ("drop_head", "drop_tail", "drop_new", "drop_buffer", "backpressure"):
    _shed(_policy)


def _grid(spark, folder, fill):
    rows = events(spark, folder).select("user_id", "day", "ts", "event_id", "v")
    out = fill(rows, ["user_id"], IN_ORDER, F.unix_date("day"), F.col("v"))
    return out.withColumn("day", F.date_from_unix_date(F.col("tick").cast("int")).cast("string")).drop("tick")


@query
def fill_forward(spark, folder):
    return _grid(spark, folder, rates.fill_forward)


@query
def extrapolate(spark, folder):
    return _grid(spark, folder, rates.expand).drop("since")


# Faults


def _faulty(spark, folder):
    return events(spark, folder).select("user_id", "ts", "event_id", "v", "k")


@query
def recover(spark, folder):
    out = faults.recover(_faulty(spark, folder), ["user_id"], IN_ORDER, F.expr(BAD), {"v": F.lit(SENTINEL)})
    return out.select("user_id", "event_id", "v", "recovered")


@query
def recover_with(spark, folder):
    rows = _faulty(spark, folder).drop("ts")
    users = rows.select("user_id").distinct()
    spare = segments.flat_map_concat(users, F.sequence(*[F.lit(n) for n in REPLACEMENT]), "n").select(
        "user_id", F.col("pos").cast("bigint").alias("event_id"), F.col("n").cast("bigint").alias("v"),
        F.lit(0).alias("k"))
    out = faults.recover_with(rows, ["user_id"], ["event_id"], F.expr(BAD), [spare])
    return out.select("user_id", "event_id", "v", F.col("attempt").cast("bigint").alias("attempt"))


@query
def resume_skip(spark, folder):
    return faults.resume(_faulty(spark, folder), F.expr(BAD)).select("user_id", "event_id", "v")


@query
def quarantine(spark, folder):
    return faults.quarantine(_faulty(spark, folder), F.expr(BAD)).select("user_id", "event_id", "v")


@query
def stop_at_fault(spark, folder):
    return faults.stop(_faulty(spark, folder), ["user_id"], IN_ORDER, F.expr(BAD)).select("user_id", "event_id", "v")


@query
def restart_scan(spark, folder):
    out = faults.restart_scan(_faulty(spark, folder), ["user_id"], IN_ORDER, F.expr(BAD), F.col("v"))
    return out.select("user_id", "event_id", "epoch", "running")


@query
def replay_dedupe(spark, folder):
    rows = events(spark, folder).select("event_id", "day", "v")
    start = rows.agg(F.min("day").alias("start")).scalar()
    first = rows.filter(F.col("day") < F.date_add(start, 3)).withColumn("attempt", F.lit(1))
    landed = combine.merge(first, rows.withColumn("attempt", F.lit(2)))
    out = faults.replay_dedupe(landed, ["event_id"], "attempt")
    return out.select("event_id", "v", F.col("attempt").cast("bigint").alias("attempt"))


# Measures


@query
def count_through(spark, folder):
    flow = measure.counted(lambda rows: rows.filter(F.col("v") > 5000))
    rows, seen = flow(events(spark, folder).select("v"))
    measure.drain(rows)
    return spark.createDataFrame([(seen.get["count"],)], "passed bigint")


@query
def traced(spark, folder):
    rows, seen = measure.traced(events(spark, folder).select("event_id", "v"), "v")
    measure.drain(rows)
    return spark.createDataFrame([(seen.get["count"], seen.get["low"], seen.get["high"])],
                                 "rows bigint, low bigint, high bigint")


# Lookups, calls, masking, feedback


@query
def oncall_enrich(spark, folder):
    errors = events(spark, folder).filter("event_type = 'error'")
    paged = enrich.on_call(errors, enrich.duty_roster(spark, ROSTER), F.col("ts"))
    return paged.groupBy("engineer", "email", "day").agg(F.count(F.lit(1)).alias("pages")).select(
        "engineer", "email", *as_text("day"), "pages")


@query
def map_async(spark, folder):
    rows = events(spark, folder).select("event_id", "v")
    return enrich.map_async(rows, _reply, "event_id bigint, reply bigint", parallelism=4)


def _reply(frame):
    return frame.assign(reply=frame["v"] * 2)[["event_id", "reply"]]


@query
def lookup_async(spark, folder):
    names = keyed.write(table(spark, folder, "customer"), "c_custkey", "c_name")
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return enrich.look_up(rows, "o_custkey", names, "customer").drop("o_custkey")


@query
def notify(spark, folder):
    told = enrich.notify(events(spark, folder), F.lit(ROSTER[0][1]), F.concat(F.lit("event "), F.col("event_id")),
                         F.col("ts"), F.lit(1).cast("bigint"))
    return told.select("email", "event.description", values.micros(F.col("event.date")).alias("at"), "event.instances")


@query
def conflate_notify(spark, folder):
    bursts = segments.conflate(events(spark, folder), ["user_id", "day"], "event_type", at=F.col("ts"),
                               merge=lambda n: F.concat(n, F.lit(" events for user "), F.col("user_id")))
    told = enrich.notify(bursts, F.lit(ROSTER[0][1]), F.col("description"), F.col("date"), F.col("instances"))
    return told.select("email", "event.description", values.micros(F.col("event.date")).alias("at"), "event.instances")


@query
def scan_max(spark, folder):
    rows = events(spark, folder).select("user_id", "ts", "event_id", "v")
    out = segments.scan(rows, ["user_id"], IN_ORDER, F.col("v"), "highest", seed=None, kind="max")
    return out.select("user_id", "place", "event_id", "highest")


@query
def scan_by_text(spark, folder):
    docs = table(spark, folder, "documents").select("source", "text", "doc_id")
    out = segments.scan(docs, ["source"], ["text", "doc_id"], F.length("text"))
    return out.select("source", "place", "doc_id", "running")


@query
def group_limited(spark, folder):
    docs = table(spark, folder, "documents")
    return segments.group_fold(docs, "lang", 100, rows=F.count(F.lit(1)), longest=F.max(F.length("text")).cast("bigint"))


@query
def mask(spark, folder):
    return masking.mask(table(spark, folder, "nation").select("n_nationkey", "n_name"), ["n_name"], SHIFT)


@query
def mask_documents(spark, folder):
    masked = masking.mask(table(spark, folder, "documents").select("doc_id", "text"), ["text"], SHIFT)
    return masked.select("doc_id", F.length("text").cast("bigint").alias("size"), F.md5("text").alias("digest"))


@query
def mask_roundtrip(spark, folder):
    return masking.audit(table(spark, folder, "documents").select("text"), "text", SHIFT)


@query
def hop_distance(spark, folder):
    edges = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey")
    start = table(spark, folder, "supplier").filter("s_suppkey = 0").select(F.col("s_suppkey").alias("node"))
    out = feedback.hop_distance(edges, "l_suppkey", "l_partkey", start, 4)
    return out.select("kind", "node", F.col("hops").cast("bigint").alias("hops"))
