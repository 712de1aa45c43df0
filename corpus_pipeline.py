"""The documents through five operators: language, toxicity, near duplicates, mixture, tokens.

Every stage takes and returns the columns of ``documents``, except the last, which returns the tokens'
digests. A stage reads what its predecessor wrote and kept, and its decisions take effect: rejected
documents are gone, one document of each group of near copies stays, and the mixture repeats or leaves
out documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwright.llm import mixing, toxicity, trie_join
from foldwright.llm.bpe import token_digest
from foldwright.llm.common import id_crc
from foldwright.llm.language_id import UNDETERMINED, predict_language
from foldwright.llm.queries import language_model, table, tokenizer
from foldwright.llm.shipping import ship_code
from foldwright.staging import stage

#: A language is accepted from this posterior on.
SURE = 0.5
NEAR_WORDS, NEAR_PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _rows(docs: DataFrame, *more: Column) -> DataFrame:
    """The documents, each as the one column ``row``, so that no name of theirs can meet those of a stage."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *more)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter or of no clear language. The model is learned from the labelled documents."""
    ship_code(spark)
    found = _rows(docs, predict_language(docs, language_model(docs)).alias("found"))
    sure = (F.col("found.lang_pred") != UNDETERMINED) & (F.col("found.score") >= SURE)
    return found.filter(sure).select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts whose probability of toxicity reaches the threshold of the operator."""
    labels = table(spark, sf_dir, "labels").filter(id_crc("doc_id") % 3 != 1)
    model = toxicity.train(docs, labels)
    scored = _rows(docs, toxicity.toxicity_score(docs, model).alias("score"))
    return scored.filter(F.col("score") < toxicity.PREDICT_FROM).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of near copies: that of the smallest id.

    Documents without words are in no component and stay. A document is named by its id and the hash of
    its text, so rows that share an id but not the text are decided one by one; of rows that repeat both,
    one stays. Rows without an id are named by their text alone, beyond all ids (which are below 2**62),
    and so go before rows with one do.
    """
    ship_code(spark)
    unnamed = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61))
    name = F.coalesce(F.col("doc_id").cast("bigint"), unnamed).alias("key")
    texts = docs.select(name, "text")
    found = trie_join.similar_components(texts, NEAR_WORDS, NEAR_PERCENT, key="key").filter("group_id is not null")
    found = stage(found.select("key", "text_hash", "component_id", "group_id"), "near-copies")
    # Texts under one id may be in several components, and several texts under the smallest id in one.
    least = F.col("key") == F.col("component_id")
    heads = found.filter(least).groupBy("group_id").agg(F.min("text_hash").alias("kept"), F.max("text_hash").alias("last"))
    several = trie_join.small_side(stage(heads.filter("kept <> last").select("group_id", "kept"), "shared-ids"), 32)
    more = found.filter(least).join(several, "group_id").filter("text_hash <> kept").select("key", "text_hash")
    gone = found.filter(~least).select("key", "text_hash").unionByName(more).distinct()
    again = found.groupBy("key", "text_hash").count().filter("count > 1").select("key", "text_hash")

    def of(rows: DataFrame) -> DataFrame:
        return trie_join.small_side(stage(rows, "named"), 48)

    named = _rows(docs, name, F.xxhash64("text").alias("text_hash"))
    both = ["key", "text_hash"]
    left = named.join(of(gone), both, "left_anti")
    repeated = of(again)
    if repeated.isEmpty():
        return left.select("row.*")
    single = left.join(repeated, both, "left_anti")
    return single.union(left.join(repeated, both, "left_semi").dropDuplicates(both).select(single.columns)).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and the decoded bytes, one row per document of the mixture."""
    ship_code(spark)
    digest = token_digest(F.col("text"), *tokenizer()).alias("digest")
    return docs.select("doc_id", "lang", "source", digest).select("doc_id", "lang", "source", "digest.*")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("mix_sources", mix),
    ("byte_bpe", tokenize),
]

#: Trained models and hashed n-grams are not SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between them the rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
