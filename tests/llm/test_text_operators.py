"""Quality, near duplicates, passages and suffixes against plain loops, on given and awkward documents."""

import math
from collections import Counter
from fractions import Fraction
from pathlib import Path

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from rillframe.llm import neardup, passages, quality, store, suffixes
from rillframe.llm.links import components


def binomial_tail(n, k, p):
    """P(X <= k) for n trials, in fractions."""
    p = Fraction(p).limit_denominator(10_000)
    return float(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def test_counts(mixed):
    rows, docs, empty = mixed
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = quality.measure(docs)
    assert "text" not in found.columns and "source" in found.columns
    got = Counter((r.doc_id, *[r[n] for n in names]) for r in found.select("doc_id", *names).collect())
    assert got == Counter((i, *brute.counts(t)) for i, t in pairs(rows))
    assert quality.measure(empty).count() == 0


def test_certified_is_the_exact_bound():
    for good, wrong, risk in ((100, 0, 0.05), (500, 3, 0.02), (2000, 20, 0.02), (50, 0, 0.02)):
        tail = binomial_tail(good, wrong, risk)
        assert quality.certified(good, wrong, risk, tail * 1.0001)
        assert not quality.certified(good, wrong, risk, tail * 0.9999)
    assert not quality.certified(0, 0, 0.1, 0.5)


def test_cutoffs_keep_their_promise(spark):
    """Signals of good documents never reach 0.3 but for 1 in 1000; bad ones lie above 0.5."""
    rows = []
    for i in range(6000):
        bad = i % 6 == 0
        symbols = 60 if bad else 40 if i % 1000 == 1 else 5
        rows.append((i, "xx" if i % 2 else None, 100, 100, symbols, 0, 0, 10, 0))
    measured = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_capitals long")
    labels = spark.createDataFrame([(i, 0 if i % 6 == 0 else 1) for i in range(6000)] + [(7, None), (7, 1)], "doc_id long, quality int")
    cuts = {r.stratum: r for r in quality.cutoffs(measured, labels, risk=0.05).collect()}
    assert set(cuts) == {"xx", None}
    # the bad are all in the null stratum: i even
    assert cuts[None].cut_symbols is not None and 0.3 < cuts[None].cut_symbols < 0.6
    assert cuts["xx"].cut_symbols is None and cuts[None].cut_repeats is None
    judged = quality.judge(measured, spark.createDataFrame([tuple(r) for r in cuts.values()], "stratum string, " + ", ".join(f"cut_{s} double" for s in quality.SIGNALS)), "lang")
    kept = judged.groupBy((F.col("doc_id") % 6 == 0).alias("bad"), "kept").count().collect()
    assert {(r.bad, r.kept) for r in kept} == {(True, False), (False, True)}


def test_few_labels_certify_nothing(spark):
    measured = spark.createDataFrame([(i, "en", 100, 100, 90 if i else 0, 0, 0, 5, 0) for i in range(20)], "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_capitals long")
    labels = spark.createDataFrame([(i, int(i == 0)) for i in range(20)], "doc_id long, quality int")
    assert quality.cutoffs(measured, labels).collect()[0].cut_symbols is None
    assert quality.cutoffs(measured.limit(0), labels).count() == 0


def test_passing_keeps_columns(mixed, spark):
    rows, docs, empty = mixed
    labels = spark.createDataFrame([], "doc_id long, quality int")
    found = quality.passing(docs, labels)
    assert found.columns == docs.columns
    want = Counter()
    for r in rows:
        n, _, _, _, repeats = brute.counts(r[1])
        want[r[:2]] += n >= 50 and 100 * repeats <= 50 * n
    assert Counter((r.doc_id, r.text) for r in found.collect()) == +want
    assert quality.passing(empty, labels).count() == 0


@pytest.mark.parametrize("length", [50, 3])
def test_passages(mixed, length):
    rows, docs, empty = mixed
    want = Counter((i, n, gone, " ".join(left)) for i, n, gone, left in brute.passages(pairs(rows), length))
    found = passages.removals(docs, length).collect()
    got = Counter((r.doc_id, r.n_words, r.n_removed, " ".join(brute.words(r.kept_text))) for r in found)
    assert got == want
    for r in found:
        assert sum(x.end - x.first for x in r.intervals) == r.n_removed
        assert all(a.end < b.first for a, b in zip(r.intervals, r.intervals[1:]))
        if not r.n_removed:
            assert r.kept_text == r.text
    assert passages.removals(empty, length).count() == 0


def test_numbers_are_sent_short():
    for values in ([5], [-(2**63), -1, 0, 2**63 - 1], [10, 11, 300], [0, 255], [0, 256], [0, 65535, 131071], [-7, 2**33]):
        made = passages._short(np.array(values, np.int64), True)
        assert passages._long(made, True).tolist() == values
    for counts in ([1, 2, 255], [1, 256], [70_000], [2**40, 1]):
        assert passages._long(passages._short(np.array(counts), False), False).tolist() == counts
    assert len(passages._short(np.arange(1000) * 3, True)) == 1 + 8 + 999


def test_a_block_at_a_time_gives_the_same(mixed, monkeypatch):
    rows, docs, _ = mixed
    want = Counter((r.doc_id, r.n_removed) for r in passages.removals(docs, 50).collect())
    monkeypatch.setattr(passages, "RANGES", 3)
    assert Counter((r.doc_id, r.n_removed) for r in passages.removals(docs.repartition(11), 50).collect()) == want


@pytest.mark.parametrize("length", [400, 64])
def test_suffixes(mixed, length):
    rows, docs, empty = mixed
    want = Counter(brute.bytes_left(pairs(rows), length))
    found = suffixes.removals(docs, length).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in found) == want
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in found)
    assert suffixes.removals(empty, length).count() == 0


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(mixed, size):
    rows, docs, empty = mixed
    found = neardup.grouped(docs, size, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(brute.groups(pairs(rows), size, 80))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    if size == 5:
        assert neardup.grouped(empty, size, 80).count() == 0


def test_group_of_many_near_copies(spark):
    """Copies around one text, some too far from it but close to another: only links between copies join those."""
    base = [f"v{i}" for i in range(100)]
    rows = []
    for k in range(150):
        own = list(base)
        for j in range(k % 13):
            own[(k * 17 + j * 29) % 100] = f"z{k if k % 5 else 0}_{j}"
        rows.append((k, " ".join(own)))
    found = neardup.grouped(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(brute.groups(rows, 2, 80))


def test_any_deal_of_texts_gives_the_same(mixed, monkeypatch):
    """Texts found by marked hashes, circles for all lists, blocks of a few classes, parts of a few texts."""
    rows, docs, _ = mixed
    want = Counter(brute.groups(pairs(rows), 2, 80))
    for name, value in (("BROADCAST", 0), ("BLOCK", 400), ("ROWS", 3), ("PAIRS", 1)):
        monkeypatch.setattr(neardup, name, value)
    monkeypatch.setattr(store, "MARK_KEYS", 50)
    found = neardup.grouped(docs, 2, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == want


def test_among_loses_no_row_and_keeps_few_others(spark, monkeypatch):
    monkeypatch.setattr(store, "MARK_KEYS", 700)
    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("key"))
    wanted = store.settled(rows.where("id % 10 = 0").select("key"))
    found = {r.id for r in store.among(rows, wanted, "key").collect()}
    assert found >= set(range(0, 20_000, 10)) and len(found) < 2_100
    assert store.among(rows, wanted.where("false"), "key").count() < 10


def on_disk(spark):
    """Bytes of the shuffle files of this session."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(p.stat().st_size for f in folders for p in Path(f.getPath()).rglob("shuffle_*"))


def test_near_duplicates_leave_no_shuffled_files(spark):
    """What steps have shuffled is off the disk when they are written, whether or not the driver collects garbage."""
    words = np.random.default_rng(3).integers(0, 400, (1500, 60)).tolist()
    docs = spark.createDataFrame([(i, " ".join(f"w{x}" for x in own)) for i, own in enumerate(words)], "doc_id long, text string")
    conf, before = spark.conf.get(store.CLEANUP, None), on_disk(spark)
    found = neardup.grouped(docs, 2, 80)
    assert on_disk(spark) - before < 100_000
    assert spark.conf.get(store.CLEANUP, None) == conf and found.count() == 1500


def test_unlike_texts_that_share_words_are_not_sent(spark, monkeypatch):
    """Lists that meet by chance bring sketches together; texts are asked for where those match."""
    asked, whole = [], neardup._texts
    monkeypatch.setattr(neardup, "_texts", lambda docs, wanted: asked.append(wanted.count()) or whole(docs, wanted))
    monkeypatch.setattr(neardup, "PAIRS", 1)
    words = np.random.default_rng(4).integers(0, 30, (300, 80)).tolist()
    rows = [(i, " ".join(f"w{x}" for x in own)) for i, own in enumerate(words)]
    rows += [(300 + i, f"{text} end") for i, text in rows[:20]]
    found = neardup.grouped(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(brute.groups(rows, 2, 80))
    assert sum(asked) < 150


def test_first_of_each_group_stays(mixed):
    rows, docs, _ = mixed
    want = {i for i, _, c in brute.groups(pairs(rows), 5, 80) if i == c}
    found = neardup.deduplicated(docs, 5, 80)
    assert found.columns == docs.columns and {r.doc_id for r in found.collect()} == want


def test_one_row_of_each_group_stays(mixed, spark):
    """Rows that repeat, similar rows of one id, and groups without any id."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (1, text + " x"), (2, text + " y"), (None, text), (3, "a b c d e f"), (3, "a b c d e f"), (3, "other words of an id seen before"),
            (None, "no id at all here"), (None, "no id at all here"), (5, None), (5, None), (None, " "), (6, "")]
    found = neardup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 5, 80).collect()
    got = Counter((r.doc_id, r.text) for r in found)
    one = [x for x in got if x[0] == 1]
    assert len(one) == 1 and got[one[0]] == 1 and one[0][1] in (text, text + " x")
    assert got == Counter([one[0], *rows[6:9], *rows[10:]])
    given, docs, _ = mixed
    groups = brute.groups(pairs(given), 5, 80)
    empty = sum(n == 0 for _, n, _ in groups)
    # ids of the least of a group are its name, but for groups without any id
    named = {c for _, n, c in groups if n and c is not None}
    nameless = {t for (_, t), (_, n, c) in zip(pairs(given), groups) if n and c is None}
    assert not nameless and len({(c, brute.shingles(t, 5)) for (i, t), (_, n, c) in zip(pairs(given), groups) if n and i == c}) >= len(named)
    seen = neardup.deduplicated(docs, 5, 80).collect()
    assert sum(not brute.words(r.text) for r in seen) == empty
    kept = [(r.doc_id, r.text) for r in seen if brute.words(r.text)]
    assert all(c == i for i, _, c in brute.groups(kept, 5, 80)) and {i for i, _ in kept} == named
    assert len(set(map(lambda x: brute.shingles(x[1], 5), kept))) == len(kept)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(500, k) for k in range(501, 560)] + [(9000, 700), (9000, 800)] + [(7777, 7777)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 500 for i in range(500, 560)}, 700: 700, 800: 700, 9000: 700}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
