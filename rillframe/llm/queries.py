"""One query for each operator of this package over its whole table, with production settings, and its SQL if any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rillframe.llm import fim, langid, lexical, lexicon, nearest, neardup, packing, passages, quality, ring, suffixes, tokenfile, toxicity
from rillframe.llm.store import lean

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(made: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[made.__name__] = made
    return made


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every text, the fixed rules, and the verdict with cutoffs certified on ``labels``."""
    found = quality.verdicts(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op10_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that windows of 50 words share with a document of smaller id, removed."""
    found = passages.removals(table(spark, folder, "documents"))
    words = F.trim(F.regexp_replace(F.coalesce("kept_text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


@query
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document written to indexed shards and read back through the index."""
    written = tokenfile.write(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return tokenfile.read(written)


@query
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 4096 tokens, each ended by id 1."""
    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query
def op9_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded through the lexicon of the table's frequent words, and decoded again."""
    docs, tokenizer = table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    return lexicon.digests(docs, tokenizer, lexicon.build(docs, tokenizer))


@query
def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text, learnt from the texts that are not held out."""
    found = langid.classified(lean(table(spark, folder, "documents"), "doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 8 shards of equal row counts."""
    return ring.shard(table(spark, folder, "documents"), 8)


@query
def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents that share 80 % of their 2-word shingles, by the smallest id of each."""
    return neardup.grouped(table(spark, folder, "documents"), size=2, percent=80).drop("key")


@query
def op6_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Every byte removed that a 400-byte string covers which starts elsewhere too."""
    found = suffixes.removals(lean(table(spark, folder, "documents"), "doc_id", "text"), 400)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    return nearest.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query
def op11_fim(spark: SparkSession, folder: str) -> DataFrame:
    """Every document arranged for filling in its middle, and its text rebuilt from that."""
    return fim.digests(table(spark, folder, "documents"), seed="42", rate=50, spm=80)


ORACLES["op11_fim"] = r"""WITH given AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
  CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM given),
formed AS (SELECT *, CAST(len(units) AS BIGINT) AS n,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
       WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
  least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM cut),
parted AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
  array_to_string(units[b + 1:], '') AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM parted"""


@query
def op12_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=20)


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLES["op12_search"] = f"""WITH listed AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
size AS (SELECT doc_id, len(terms) AS n FROM listed WHERE len(terms) > 0),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM size),
held AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM listed) GROUP BY ALL),
asked AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, whole GROUP BY term, docs),
added AS (SELECT item_id, doc_id, CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weight USING (term) JOIN size USING (doc_id), whole GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM added WHERE score > 0
QUALIFY rank <= 20"""


@query
def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, by models of the labelled documents that are not held out."""
    found = toxicity.classified(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", "margin")
