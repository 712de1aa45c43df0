"""The registered queries of the subpackage and their SQL, for the sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwright.llm import (
    block_search,
    cover_search,
    divergence,
    language_id,
    line_dedup,
    mixing,
    periodic,
    sharding,
    tool_calls,
    toxicity,
    trie_join,
    url_filter,
)
from foldwright.llm.bpe import token_digest
from foldwright.llm.common import WORD, id_crc
from foldwright.llm.shipping import ship_code
from foldwright.llm.statements import SQL

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def statements() -> dict[str, str]:
    return dict(SQL)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_cover_tree(spark, d):
    return cover_search.top_products(table(spark, d, "embeddings"), F.col("id") % 50 == 0, k=5)


@query
def op2_byte_shards(spark, d):
    placed = sharding.shard_by_bytes(table(spark, d, "documents"), 24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_toxicity(spark, d):
    """Scores of all documents; the machine learns from labels outside the held-out fold."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    model = toxicity.train(docs, labels.filter(id_crc("doc_id") % 3 != 1))
    scored = docs.select("doc_id", (id_crc("doc_id") % 3 == 1).alias("held_out"), toxicity.toxicity_score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.PREDICT_FROM).cast("int"))


#: The tool that the derived calls name, and its arguments.
ANSWER_SCHEMA = {"answer": {"words": ("integer", True), "topic": ("string", True), "note": ("integer", False)}}


def call_messages(turns: DataFrame) -> DataFrame:
    """Tool messages derived from plain turns, as the sample conversations hold none.

    A user turn becomes a call that depends on the turn at half its number, if that is a call; the
    assistant turn after it becomes the result. Some calls lack an argument, have one of a wrong type
    or one too many, by the number of words.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    name = F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"))
    arguments = F.struct(
        F.when(words % 5 != 0, words).alias("words"),
        F.col("role").alias("topic"),
        F.when(words % 7 == 0, words.cast("string")).alias("note"),
        F.when(words % 11 == 0, words).alias("extra"),
    )
    half = F.floor(F.col("turn") / 2)
    after = F.when(half < F.col("turn"), F.array(F.concat(name, half)))
    call = F.struct(F.concat(name, F.col("turn")).alias("id"), F.lit("answer").alias("name"), arguments.alias("arguments"), after.alias("after"))
    result = F.struct(F.concat(name, F.col("turn") - 1).alias("tool_call_id"), F.struct(words.alias("words")).alias("content"))
    asked = F.to_json(F.struct(F.array(call).alias("tool_calls")))
    text = F.when(F.col("role") == "user", asked).when(F.col("role") == "assistant", F.to_json(result)).otherwise(F.col("text"))
    role = F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role"))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))


@query
def op4_tool_calls(spark, d):
    messages = call_messages(table(spark, d, "conversations"))
    return tool_calls.link_tool_calls(messages, ANSWER_SCHEMA)


@query
def op5_trie_jaccard(spark, d):
    found = trie_join.similar_components(table(spark, d, "documents"), width=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op6_mix_sources(spark, d):
    return mixing.mix_sources(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def language_model(docs: DataFrame) -> language_id.LanguageModel:
    """Learned from the documents outside the held-out fold."""
    return language_id.train(docs.filter(id_crc("doc_id") % 4 != 2), key="doc_id")


@query
def op7_block_ann(spark, d):
    return block_search.nearest_by_product(table(spark, d, "embeddings"), F.col("id") % 20 == 0, k=20)


@query
def op8_language_id(spark, d):
    docs = table(spark, d, "documents")
    found = language_id.identify_languages(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", (id_crc("doc_id") % 4 == 2).alias("held_out"), "lang_pred", "score")


def tokenizer() -> tuple[str, str]:
    """Rank file and splitting pattern of the installed public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op9_byte_bpe(spark, d):
    digest = token_digest(F.col("text"), *tokenizer()).alias("digest")
    return table(spark, d, "documents").select("doc_id", digest).select("doc_id", "digest.*")


URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


@query
def op10_url_filter(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def replayed(docs: DataFrame) -> DataFrame:
    """Every tenth document, by the crc32 of its id, with its words from a place on replaced by a repeated stretch."""
    seed, spaces = id_crc("doc_id"), " \t\n\x0b\x0c\r"
    g = F.floor(seed / 10)
    words = F.split(F.btrim("text", F.lit(spaces)), r"[\x20\x09-\x0D]+")
    n = F.size(words)
    a = (g % n).cast("int")
    period = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, period), F.ceil((n - a) / period).cast("int")))
    text = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    chosen = (seed % 10 == 0) & (F.btrim("text", F.lit(spaces)) != "")
    return docs.select("doc_id", F.when(chosen, text).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark, d):
    found = periodic.periodic_runs(replayed(table(spark, d, "documents")), digest=True)
    # Runs are in order of start and period, so the first of those with the greatest exponent is kept.
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda held, run: F.when(run["length"] * held["period"] > held["length"] * run["period"], run).otherwise(held),
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )


@query
def op12_source_divergence(spark, d):
    return divergence.source_divergence(table(spark, d, "documents"), min_df=3, most_terms=200)


@query
def op13_line_dedup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = line_dedup.clean_documents(line_dedup.build_index(docs, min_docs=10), docs)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
