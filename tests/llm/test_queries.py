"""The registered queries at the small scale against plain loops, and the pipeline stage by stage."""

import zlib

import brute
import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillframe.llm import queries
from rillframe.llm.store import settled

FOLDER = "/root/testdata/sf0.001"


def given(spark):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_near_duplicates_query(spark):
    found = queries.QUERIES["op2_near_duplicates"](spark, FOLDER)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert rows(found) == [(i, n, c, i == c) for i, n, c in brute.groups(given(spark), 2, 80)]


def test_passages_query(spark):
    found = queries.QUERIES["op10_passages"](spark, FOLDER).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows(found) == [(i, n, g, brute.sha(" ".join(left))) for i, n, g, left in brute.passages(given(spark), 50)]


def test_suffix_query(spark):
    found = queries.QUERIES["op6_repeated_bytes"](spark, FOLDER).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows(found) == [(i, n, g, s, brute.sha(left)) for i, n, g, s, left in brute.bytes_left(given(spark), 400)]


def test_quality_query(spark):
    found = {r.doc_id: r for r in queries.QUERIES["op8_quality"](spark, FOLDER).collect()}
    for i, text in given(spark):
        n, chars, symbols, lines, repeats = brute.counts(text)
        r = found.pop(i)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n) and not (r.base_failed and r.kept)
    assert not found


def test_token_file_query(spark):
    tokenizer, at, want = Tokenizer.from_file(queries.public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for i, text in given(spark):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert rows(queries.QUERIES["op4_token_files"](spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32")) == want


def test_language_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.QUERIES["op1_language"](spark, FOLDER).collect()}
    assert len(found) == len(docs)
    for r in docs:
        own = found[r.doc_id]
        assert own.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= own.score <= 1
        assert (own.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    held = [r for r in docs if found[r.doc_id].held_out and r.lang]
    assert sum(found[r.doc_id].lang_pred == r.lang for r in held) >= 0.9 * len(held)


def test_sharding_query(spark):
    found = queries.QUERIES["op3_sharding"](spark, FOLDER).collect()
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in given(spark)]
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in found) == want and {r.law for r in found} == {"rows"}
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r.slot)
    assert set(slots) == set(range(8)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_nearest_query(spark):
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect() if r.embedding is not None}
    found = {}
    for r in queries.QUERIES["op5_nearest"](spark, FOLDER).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    asked, hits = [i for i in rows if i % 50 == 0], 0
    assert sorted(found) == sorted(asked)
    for i in asked:
        score = {j: float(rows[i] @ v / np.sqrt((rows[i] @ rows[i]) * (v @ v))) for j, v in rows.items() if j != i}
        best = sorted(score, key=lambda j: (-score[j], j))[:5]
        own = [found[i][k] for k in range(1, 6)]
        assert all(abs(score[j] - s) < 1e-9 for j, s in own) and own == sorted(own, key=lambda x: (-x[1], x[0]))
        hits += len({j for j, _ in own} & set(best))
    assert hits >= 0.9 * 5 * len(asked)


def test_packing_query(spark):
    tokenizer = Tokenizer.from_file(queries.public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, text in given(spark):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(i, k, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
    found = queries.QUERIES["op7_packing"](spark, FOLDER).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(want)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 4096
    assert len(sequences) <= -(-sum(w[3] for w in want) // 4096) + 2


def test_lexicon_query(spark):
    tokenizer = Tokenizer.from_file(queries.public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, text in given(spark):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(tokenizer.decode(ids, skip_special_tokens=False))))
    assert rows(queries.QUERIES["op9_lexicon"](spark, FOLDER)) == want


def test_pipeline_stages(spark):
    """Each stage on its own input: what goes is what the rules say, the columns stay."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = sorted((r.doc_id, r.text) for r in docs.collect())
        docs = settled(stage(spark, docs, FOLDER))
        seen.append(name)
        if name == "best-fit packing":
            break
        assert docs.columns == columns
        after = sorted((r.doc_id, r.text) for r in docs.collect())
        if name == "quality rules":  # too few labels here to certify a cutoff
            good = [(i, t) for i, t in before if (c := brute.counts(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]]
            assert after == good
        elif name == "language ID":
            assert set(after) <= set(before) and len(after) >= 0.98 * len(before)
        elif name == "MinHash near-dedup":
            assert after == [(i, t) for (i, t), (_, _, c) in zip(before, brute.groups(before, 5, 80)) if i == c]
        else:
            assert [(i, brute.words(t)) for i, t in after] == [(i, left) for i, n, _, left in brute.passages(before, 50) if left or not n]
            assert docs.where(F.col("n_chars") != F.char_length("text")).count() == 0
    packed = docs.collect()
    assert seen == [name for name, _ in corpus_pipeline.STAGES] and {r.doc_id for r in packed} == {i for i, _ in after}
    assert sum(r.length for r in packed) <= 4096 * len({r.sequence_id for r in packed})


def test_pipeline_of_nothing(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
