"""Encoding, lexicon, files, packing, language, shards and nearest vectors."""

import tracemalloc
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillframe.llm import bpe, langid, lexicon, nearest, packing, ring, tokenfile

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", "  ", "a  b", "foo\n\nbar", " \n x", "x \n", "don't she'LL 12345 ñandú Ünï", "<|endoftext|> a <|endoftext|>b", "foo <|endo", "日本 語 text",
       "ΣΑΣ οδυσσεύς", "école É İstanbul", "\x1ca\x1c b!!\x1c", "a\t\tb\r\nc", "́x ́y", "𝒳 ﬁ Ⅷ ²³", "  lead", "trail  ", "!!!'s's", "x​y", "ǅ ß ẞ",
       "l'eau d'un rock'n'roll 'sfoo ''s !'s it'S they're 'r e x' s", "'", "a's", "12's 5've", "\n's x\n", " 's", "a \n", "a\n\n b", "K Å", "İx", "a\xa0b\x85c"]


def library(path):
    return Tokenizer.from_file(path)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_are_the_library_s(mixed, path):
    texts = ODD + [r[1] for r in mixed[0]]
    want = [library(path).encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in bpe.Encoder(path).encode(texts)] == want
    one = bpe.Encoder(path)
    assert [one.encode([t])[0].tolist() for t in ODD] == want[:len(ODD)]


def test_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    texts = [f"Some words {i} again and 'again'" for i in range(20)]
    own = bpe.Encoder(BYTE)
    for t in texts:
        assert own.encode([t])[0].tolist() == library(BYTE).encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_words_that_share_a_hash(monkeypatch, path):
    """Ids are the library's even where many words have one hash, in a block and over blocks."""
    monkeypatch.setattr(bpe, "spans", lambda symbols, starts, ends: (symbols[starts] % 3).astype(np.uint64))
    own, texts = bpe.Encoder(path), ["some words that are here", "other words stand there, some again", "some words that are here", brute.EVEN, brute.ODD, ""]
    want = [library(path).encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in own.encode(texts)] == want
    assert [own.encode([t])[0].tolist() for t in texts] == want


def test_places():
    made, keys = bpe.Places(), np.random.default_rng(1).integers(1, 1 << 62, 200_000).astype(np.uint64)
    keys = np.unique(np.concatenate([keys, np.arange(50, dtype=np.uint64) << np.uint64(40)]))
    for part in np.array_split(keys, 7):
        assert (made.find(part) < 0).all()
        made.add(part)
    assert (made.find(keys) == np.arange(len(keys))).all()


def test_automaton_is_minimal_and_numbers_words():
    words = sorted({f"{a}{b}{c}" for a in "abc" for b in ("", "xy") for c in ("ing", "ed", "")} - {""})
    edges, _ = lexicon.minimal([[ord(c) for c in w] for w in words])
    header, *_ = lexicon.compile_words(words, bpe.encoder(WORD))
    assert header[3] == len(words) and header[1] < 14 < len(edges)  # suffixes are shared


def test_lexicon_round_trip(mixed, spark):
    rows, docs, empty = mixed
    path = lexicon.build(docs, WORD, 500)
    tokenizer = library(WORD)
    want = Counter()
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        want[(r[0], len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(tokenizer.decode(ids, skip_special_tokens=False)))] += 1
    assert Counter(tuple(r) for r in lexicon.digests(docs, WORD, path).collect()) == want
    texts = ODD + ["zzgqx unseenword"]
    assert [x.tolist() for x in lexicon.encode(texts, WORD, path)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    nothing = lexicon.build(empty, WORD, 500)
    assert lexicon.digests(empty, WORD, nothing).count() == 0
    assert lexicon.encode(["a word"], WORD, nothing)[0].tolist() == tokenizer.encode("a word", add_special_tokens=False).ids


def test_index():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        bounds = np.stack([np.arange(len(keys)), np.arange(len(keys)) + 7], 1)
        index = tokenfile.Index.build(keys, bounds)
        assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
        assert (index.find(keys) == bounds).all()
        strange = np.setdiff1d(rng.integers(0, 1 << 63, 2000).astype(np.uint64), keys)
        assert (index.find(strange) == -1).all()


def test_token_files(mixed):
    rows, docs, empty = mixed
    manifest = tokenfile.write(docs, BYTE, 2)
    found = tokenfile.read(manifest).collect()
    tokenizer, want = library(BYTE), Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        want[(r[0], len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == want
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is None, i))
    assert tokenfile.fetch(manifest, 4).tolist() == [*tokenizer.encode("one", add_special_tokens=False).ids, 2]
    with pytest.raises(KeyError):
        tokenfile.fetch(manifest, 400)
    assert tokenfile.read(tokenfile.write(empty, BYTE, 2)).count() == 0


def test_sum_of_squares_against_the_rule():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 30, 300)
    bins, offsets = packing.place(sizes, 30)
    gaps = {}
    for size, b, offset in zip(sizes.tolist(), bins.tolist(), offsets.tolist()):
        def cost(target):
            after = dict(gaps)
            after[target] = after.get(target, 30) - size
            return sum(n * n for gap, n in Counter(after.values()).items() if gap)
        options = [cost(t) for t, gap in gaps.items() if gap >= size] + [cost("new")]
        assert cost(b) == min(options)
        assert offset == 30 - gaps.get(b, 30)
        gaps[b] = gaps.get(b, 30) - size


def test_packing(mixed):
    rows, docs, empty = mixed
    found = packing.packed(docs, WORD, 1, length=256, group=200).collect()
    tokenizer, want = library(WORD), Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 256)):
            part = ids[at:at + 256]
            want[(r[0], k, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= 1.03 * sum(r.length for r in found) / 256 + 5
    assert packing.packed(empty, WORD, 1).count() == 0


def test_languages(mixed, spark):
    rows, docs, empty = mixed
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.classified(given).select("doc_id", "held_out", "lang", "lang_pred", "score", "rejected").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found) and len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found) and sum(r.rejected for r in found) < 0.01 * len(found)
    model = langid.fit(given)
    clash = langid.predict(docs.withColumn("score", F.lit("x")), model).select("doc_id", "text", "lang_pred", "score", "rejected", "class").collect()
    assert len(clash) == len(rows)
    for r in clash:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in {"en", "de", "fr", "es"}
    assert langid.predict(spark.createDataFrame([("Съешь ещё этих мягких французских булок",)], "text string"), model).collect()[0].rejected
    nothing = langid.fit(empty)
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"} and langid.predict(empty, model).count() == 0


@pytest.mark.parametrize("known", [0, 1, 3, 6])
def test_language_of_few_labels_is_not_rejected(spark, known):
    """All but a few Spanish texts have no label: they are found, and stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    labelled = {r.doc_id for r in docs.where("lang = 'es'").orderBy("doc_id").limit(known).collect()}
    given = docs.withColumn("lang", F.when((F.col("lang") != "es") | F.col("doc_id").isin(labelled), F.col("lang")))
    if not known:
        given = given.withColumn("lang", F.lit(None).cast("string"))
    hidden = docs.where("lang = 'es'").where(~F.col("doc_id").isin(labelled))
    found = langid.predict(hidden, langid.fit(given)).collect()
    assert len(found) == 106 - known and {r.lang_pred for r in found} == {"es" if known else "und"}
    assert not any(r.rejected for r in found)
    assert langid.predict(spark.createDataFrame([("12 34",), (None,)], "text string"), langid.fit(given)).where("rejected").count() == 2


def test_reach_is_of_texts_that_made_no_centroid():
    points = np.random.default_rng(5).random((200, 2000)).astype(np.float32) ** 9
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    seen = 1 - (points @ langid.kmeans(points, 4, langid.ROUNDS).T).max(1)
    assert langid.reach_of(points, 4, 0.0) > np.quantile(seen, 1 - langid.ODD) + 0.01
    assert langid.reach_of(points[:langid.FEW - 1], 4, 0.0) == langid.LIMIT


def test_chosen_texts_are_not_copied():
    """The vectors of a language's texts are the largest thing in a task: neither folds nor clusters copy them."""
    points = np.random.default_rng(6).random((300, 1 << 14)).astype(np.float32) ** 9
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    tracemalloc.start()
    langid.kmeans(points, 4, 2)
    langid.reach_of(points, 4, 0.0)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < points.nbytes / 4
    some = np.flatnonzero(np.arange(300) % 5 != 2)
    assert np.allclose(langid.kmeans(points, 4, 3, some), langid.kmeans(points[some], 4, 3), atol=1e-6)


def test_copies_are_one_text_of_the_sample(spark, monkeypatch):
    """A third of the rows are copies of a text; whether or not it is drawn, no fit has more than the different texts."""
    texts = [f"text number {i} with words of its own {i * 7919 % 997}" for i in range(40)]
    rows = spark.createDataFrame([(t, "en") for t in texts + texts[:1] * 300], "text string, lang string").repartition(5)
    once = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    real = langid.kmeans

    def bounded(points, *more):
        if len(points) > 40:
            raise ValueError(f"{len(points)} texts")
        return real(points, *more)

    monkeypatch.setattr(langid, "kmeans", bounded)
    assert langid.fit(rows, sample=1000).reach[0] == langid.fit(once, sample=1000).reach[0] == langid.LIMIT
    drawn = [langid.fit(once.withColumn("text", F.concat("text", F.lit(f" {k}"))).union(rows), sample=40) for k in range(2)]
    assert all(m.langs and set(m.langs) == {"en"} for m in drawn)


def test_ring(mixed, spark):
    rows, docs, empty = mixed
    found = ring.shard(docs, 8).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    sizes = Counter(r["shard"] for r in found)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in found if r["shard"] == s) == list(range(n))
    assert ring.shard(empty, 8).count() == 0
    few = ring.shard(docs.where("doc_id < 5"), 8).collect()
    assert len(few) == 4 and len({r["shard"] for r in few}) == 4 and all(r.slot == 0 for r in few)


def test_ring_moves_little(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    for slack, most in ((0.0, 0.2), (0.25, 0.14)):
        old = ring.shard(docs, 8, slack).select("doc_id", F.col("shard").alias("a"))
        new = ring.shard(docs, 9, slack).select("doc_id", F.col("shard").alias("b"))
        assert old.join(new, "doc_id").where("a <> b").count() < most * 20_000
        loads = [r["count"] for r in new.groupBy("b").count().collect()]
        assert max(loads) <= (1 + slack) * 20_000 / 9 + 1


def test_spill_goes_clockwise():
    assert ring.spill([0, 1, 0, 2], [5, 1, 3, 0], [4, 3, 2]) == [[(0, 4), (1, 1)], [(1, 1)], [(2, 2), (1, 1)], []]


def exact(rows, asked, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], float)
    out = {}
    for q in asked:
        own = vectors[ids == q][0]
        score = (vectors * own).sum(1) / np.sqrt((vectors * vectors).sum(1)) / np.sqrt((own * own).sum())
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_nearest_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    asked = [i for i, _ in rows if i % 10 == 0]
    want = exact(rows, asked, 5)
    found = defaultdict(list)
    for r in nearest.search(table, F.col("vec_id") % 10 == 0, 5).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score, r["rank"]))
    assert set(found) == set(asked) and all([x[2] for x in v] == [1, 2, 3, 4, 5] for v in found.values())
    hit = sum(len({i for i, _ in want[q]} & {i for i, _, _ in found[q]}) for q in asked)
    assert hit >= 0.9 * 5 * len(asked)
    scores = {q: dict(exact(rows, [q], len(rows))[q]) for q in asked[:5]}
    assert all(abs(scores[q][i] - s) < 1e-12 for q in asked[:5] for i, s, _ in found[q])


def test_nearest_of_awkward_vectors(spark):
    same = [(i, [1.0, 2.0, 2.0], "x") for i in range(40)]
    rows = [*same, (100, [2.0, 1.0, 2.0], "x"), (101, [0.0, 0.0, 0.0], "x"), (102, None, "x"), (103, [1.0, None, 2.0], "x"),
            (104, [float("nan"), 1.0, 1.0], "x"), (105, [float("inf"), 1.0, 1.0], "x"), (106, [], "x"), (107, [1.0, 2.0], "x"), (None, [1.0, 0.0, 0.0], "x"),
            (0, [1.0, 2.0, 2.0], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, vector string")
    found = defaultdict(list)
    for r in nearest.search(table, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == {0, 100}
    assert [i for i, _ in found[0]] == [1, 2, 3, 4, 5] and [i for i, _ in found[100]] == [0, 1, 2, 3, 4]
    assert found[0][0][1] == pytest.approx(1.0) and found[100][0][1] == pytest.approx(8 / 9)
    few = nearest.search(table.where("vec_id IN (0, 7, 100)"), F.col("vec_id") == 100, 5).orderBy("rank").collect()
    assert [(r.vec_id, r["rank"]) for r in few] == [(0, 1), (7, 2)]
    assert nearest.search(table.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_scattered_vectors_are_still_answered(spark):
    """Narrow cells hold nobody but the query itself: such queries are held against all."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in nearest.search(table, F.col("vec_id") % 20 == 0, 3, probes=1, width=0.05).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
    assert {q: v for q, v in found.items()} == {q: [i for i, _ in v] for q, v in exact(rows, [0, 20, 40], 3).items()}
