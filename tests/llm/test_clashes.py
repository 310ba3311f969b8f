"""Extra columns named like everything the operators use inside, null ids, and the largest id."""

from collections import Counter

import brute
import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rillframe.llm import langid, lexicon, neardup, packing, passages, quality, ring, suffixes, tokenfile

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
#: Names that operators give to columns of their own, inside or in results.
INSIDE = """id key _key _id _hash _hashes _marks _good _stratum _cuts _row _nameless row stratum cut_repeats hub class group n first
component kept spans intervals kept_text n_removed n_bytes base_failed lang_pred score rejected digit whole window signature set token
central shard slot text_crc32 size path docs piece start length sequence_id offset hashes kind range""".split()
LARGEST = 2**63 - 1
OPERATORS = {
    "language": lambda docs, labels: langid.classified(docs),
    "near duplicates": lambda docs, labels: neardup.grouped(docs, 5, 80),
    "near dedup": lambda docs, labels: neardup.deduplicated(docs, 5, 80),
    "shards": lambda docs, labels: ring.shard(docs, 8),
    "token files": lambda docs, labels: tokenfile.read(tokenfile.write(docs, BYTE, 2)),
    "suffixes": lambda docs, labels: suffixes.removals(docs, 400),
    "packing": lambda docs, labels: packing.packed(docs, WORD, 1),
    "quality": lambda docs, labels: quality.verdicts(docs, labels),
    "passing": lambda docs, labels: quality.passing(docs, labels),
    "lexicon": lambda docs, labels: lexicon.digests(docs, WORD, lexicon.build(docs, WORD, 500)),
    "passages": lambda docs, labels: passages.removals(docs, 50),
}


@pytest.fixture(scope="module")
def given(spark):
    rows = [r for r in brute.awkward() if r[0] != 8 and r[0] != 9] + [brute._row(LARGEST, "the largest id of all"), brute._row(None, "no id")]
    docs = brute.frame(spark, rows).drop("kept", "class", "key", "n_words")
    labels = spark.createDataFrame([(4, 1), (15, 0), (None, 1)], "doc_id long, quality int")
    return docs, labels


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_names_change_nothing(given, name):
    """The result is that without the extra columns; those that pass keep their values, unless a result has their name."""
    docs, labels = given
    plain = OPERATORS[name](docs, labels)
    more = OPERATORS[name](docs.withColumns({c: F.lit("extra") for c in INSIDE}), labels)
    assert len({c.lower() for c in more.columns}) == len(more.columns)
    show = lambda df: Counter(map(str, df.select(*plain.columns).collect()))
    assert show(more) == show(plain)
    passed = [c for c in more.columns if c not in plain.columns]
    assert all(set(r) == {"extra"} for r in more.select(*passed).collect()) if passed else True


@pytest.mark.parametrize("stage", [0, 1, 2, 3])
def test_stages_pass_clashing_names(spark, given, tmp_path, stage):
    """Columns that a stage does not own come out as they went in."""
    docs, labels = given
    labels.withColumn("toxic", F.lit(0)).write.parquet(f"{tmp_path}/labels.parquet")
    run = corpus_pipeline.STAGES[stage][1]
    plain, more = run(spark, docs, str(tmp_path)), run(spark, docs.withColumns({c: F.lit("extra") for c in INSIDE}), str(tmp_path))
    assert more.columns == [*docs.columns, *INSIDE]
    assert Counter(map(tuple, more.select(*docs.columns).collect())) == Counter(map(tuple, plain.collect()))
    assert all(set(r) == {"extra"} for r in more.select(*INSIDE).collect())


def test_largest_id_is_an_id(given, spark):
    docs, _ = given
    manifest = tokenfile.write(docs, BYTE, 2)
    found = Counter(r.doc_id for r in tokenfile.read(manifest).collect())
    assert found[LARGEST] == 1 and found[None] == 3
    assert len(tokenfile.fetch(manifest, LARGEST)) == 6
    with pytest.raises(KeyError):
        tokenfile.fetch(tokenfile.write(docs.where(f"doc_id IS NULL OR doc_id < {LARGEST}"), BYTE, 2), LARGEST)
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(LARGEST, text), (None, text), (None, text), (None, "x " + text)]
    gone = passages.removals(spark.createDataFrame(rows, "doc_id long, text string"), 50).collect()
    assert Counter((r.doc_id, r.n_removed) for r in gone) == Counter([(LARGEST, 0), (None, 60), (None, 60), (None, 60)])


def test_many_rows_without_id(spark):
    """Each gets its own hashes only: what comes back grows with the rows, not with their square."""
    rows = spark.range(30_000).select(F.when(F.col("id") < 10, F.col("id")).alias("doc_id"), F.concat_ws(" ", *[F.concat(F.lit(f"a{k}x"), F.pmod("id", F.lit(10_000))) for k in range(8)]).alias("text"))
    sent = passages.repeated(rows, 5)
    assert sent.agg(F.sum(F.length("hashes") / 8)).collect()[0][0] == 4 * 20
    found = passages.removals(rows, 5)
    assert found.where("n_removed > 0").count() == 20 and found.count() == 30_000
