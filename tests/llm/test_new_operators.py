"""Fill-in-the-middle, ranked search and toxicity against plain loops, and their queries against SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from compare import duck, spark_rows, sql_rows
from pyspark.sql import functions as F

from rillframe.llm import fim, lexical, queries, toxicity

FOLDER = "/root/testdata/sf0.01"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CLASHES = "n form output restored h1 _h1 _h2 row id term t w item score rank words copy".split()


@pytest.mark.parametrize("name", ["op11_fim", "op12_search"])
def test_query_is_what_sql_says(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, FOLDER)) == sql_rows(duck(FOLDER), queries.ORACLES[name])


def arranged(doc_id, text):
    """n, form, prefix and middle in code points, and the output."""
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_the_middle(mixed, spark):
    rows, docs, empty = mixed
    extra = [(5000 + i, t) for i, t in enumerate(["a <P> b", "<S", "x<M>", "< P>", "a<\nS>b", "<P", " ", "\n\n", " a", "a ", "ä\t ö\x0b", "<", "<S <P <M", "é<P>"] * 9)]
    given = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    want = [(i, t, *arranged(i, t)) for i, t in [(r[0], r[1]) for r in rows] + extra]
    made = fim.restored(fim.transformed(given.withColumns({c: F.lit("x") for c in CLASHES}))).collect()
    assert Counter((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made) == Counter(want)
    assert all(r.restored == (r.text or "") and r.term == "x" for r in made) and {r.form for r in made} == {"plain", "spm", "psm"}
    digests = fim.digests(given.withColumns({c: F.lit("x") for c in CLASHES})).collect()
    assert Counter(tuple(r) for r in digests) == Counter((i, n, f, p, m, brute.sha(o), brute.sha(t or "")) for i, t, n, f, p, m, o in want)
    assert fim.digests(empty).count() == 0 and fim.restored(fim.transformed(empty)).count() == 0


def test_arrangement_is_a_permutation():
    for form in ("psm", "spm"):
        assert sorted(fim.arrangement(form)) == list(range(6))
        pieces = [(memoryview(b"one"), 0, 3), (memoryview(b"xtwo"), 1, 3), (memoryview(b""), 0, 0)]
        out = fim.joined(fim.arranged(pieces, form))
        assert [fim.joined([p]) for p in fim.cut_back(memoryview(out), out, form)] == [b"one", b"two", b""]


def terms(text):
    return [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def ranked(docs, items, k):
    """(item_id, rank, doc_id, score) by plain loops; docs are rows of (doc_id, text)."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    count, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(Counter)
    for item, text in items:
        asked[item].update(terms(text))
    out = []
    for item, query in asked.items():
        found = []
        for at, (i, c) in enumerate(held):
            m = 75 + 25 * sum(c.values()) * count // length
            score = sum(q * math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in query.items() if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, at))
        for rank, (score, missing, i, _) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if missing else i, -score))
    return Counter(out)


@pytest.mark.parametrize("k", [3, 20])
def test_search(mixed, spark, monkeypatch, k):
    rows, docs, empty = mixed
    given = [(r[0], r[1]) for r in rows]
    items = [(1, "the of and Wort3 ÜBER7 über7"), (2, given[3][1]), (3, None), (4, ""), (None, "one two THE"), (5, "zzqy unheard"), (6, "the"), (6, "one one one"), (7, given[40][1] + " " + given[41][1])]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in CLASHES})
    want = ranked(given, items, k)
    wide = docs.select("doc_id", "text").withColumns({c: F.lit("x") for c in CLASHES})
    assert Counter(tuple(r) for r in lexical.search(wide, asked, k).collect()) == want
    monkeypatch.setattr(lexical, "BLOCK", 20)
    monkeypatch.setattr(lexical, "BUNDLE", 2)
    assert Counter(tuple(r) for r in lexical.search(wide, asked, k).collect()) == want
    assert lexical.search(empty, asked, k).count() == 0 and lexical.search(docs, asked.limit(0), k).count() == 0


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    found = toxicity.classified(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    y, score = np.array([truth[r.doc_id] for r in held]), np.array([r.margin for r in held])
    ranks = np.empty(len(held))
    ranks[np.argsort(score, kind="stable")] = np.arange(len(held))
    auc = (ranks[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    hits = np.array([r.predicted for r in held]) == 1
    assert len(held) > 1000 and auc > 0.8
    assert (y[hits] == 1).mean() > 0.9 and hits[y == 1].mean() > 0.5  # about half of the toxic ones have nothing to know them by


def models(texts, discount=toxicity.DISCOUNT, shared=toxicity.SHARED):
    """ln p(e | toxic) - ln p(e | ordinary) for (text, toxic), by plain loops, with counts changed by ``less``."""
    count = {y: Counter(t for text in {x for x, label in texts if label == y} for t in set(terms(text))) for y in (0, 1)}
    size = {y: sum(count[y].values()) for y in count}
    words = len(set(count[0]) | set(count[1]))
    d = {y: discount * size[y] / min(size.values()) for y in size}
    rest = {y: sum(max(c - d[y], 0) for c in count[y].values()) for y in count}

    def evidence(word, less=(0, 0)):
        back = shared * (count[0][word] + count[1][word] + 1) / (size[0] + size[1] + words)
        p = {y: (1 - shared) * max(count[y][word] - less[y] - d[y], 0) / rest[y] + back for y in (0, 1)}
        return math.log(p[1] / p[0])

    return evidence


def test_toxicity_is_what_its_formula_says(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    train = [(texts[i], y) for i, y in truth.items() if zlib.crc32(str(i).encode()) % 3 != 1]
    evidence = models(train)
    for r in toxicity.classified(docs, labels).collect():
        own = set(terms(texts[r.doc_id]))
        assert r.margin == pytest.approx(sum(map(evidence, own)) / (len(own) + toxicity.LEAST), abs=1e-7)


def test_rising_shares():
    rng = np.random.default_rng(4)
    n, good = rng.integers(1, 9, 60).astype(float), rng.integers(0, 5, 60).astype(float)
    good = np.minimum(n, good)
    found = toxicity.rising(n, good)
    assert (np.diff(found) >= 0).all() and found @ n == pytest.approx(good.sum())
    for a in range(60):  # the min-max formula of isotonic regression
        assert found[a] == pytest.approx(max(min(good[i:j + 1].sum() / n[i:j + 1].sum() for j in range(a, 60)) for i in range(a + 1)))
    assert len(toxicity.rising(np.zeros(0), np.zeros(0))) == 0


def test_toxicity_of_awkward_tables(mixed, spark):
    rows, docs, empty = mixed
    labels = spark.createDataFrame([(r[0], k % 2) for k, r in enumerate(rows)] + [(4, None), (None, 1)], "doc_id long, toxic int")
    found = toxicity.classified(docs, labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows) and all(0 <= r.score <= 1 for r in found)
    assert {r.n for r in found if r.doc_id in (1, 2, 3)} == {0}
    nothing = toxicity.classified(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted, r.margin) for r in nothing} == {(0.0, 0, 0.0)}
    one = toxicity.classified(docs, labels.withColumn("toxic", F.lit(1))).collect()
    assert {(r.score, r.predicted, r.margin) for r in one} == {(1.0, 1, 0.0)}
    assert toxicity.classified(empty, labels).count() == 0


def test_copies_are_one_text_of_the_models(spark):
    """A text that a third of all rows repeat counts once."""
    texts = [(f"word{i % 7} more{i % 5} of{i} kind", i % 3 == 0) for i in range(60)]
    rows = [(3 * k, t, y) for k, (t, y) in enumerate(texts + texts[:1] * 400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    made = toxicity.bags(docs)
    known = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    assert toxicity.chosen(made, labels).count() == len({(t, y) for i, t, y in rows if i in known})
