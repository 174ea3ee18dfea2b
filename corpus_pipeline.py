"""Training-data pipeline: toxicity, line dedup, near-dedup, mixing, tokenizing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
reread as the next one's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.llm import line_dedup, mixing, near_dedup, piece_merge, toxicity
from paneloom.llm.common import shared_folder, text_of
from paneloom.llm.queries import tokenizer_path

#: Characters of the input that one output shard of the mix stands for, and the least number of shards.
SHARD_CHARS = 32_000_000
LEAST_SHARDS = 16
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the factorization machine doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, labels).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; n_chars follows. A text that loses all lines stays as "";
    a null text stays null."""
    found = line_dedup.deduplicate(docs)
    text = line_dedup.remaining(F.col("text"), F.col("dropped"))
    return found.select(
        "doc_id",
        text.alias("text"),
        "lang",
        "source",
        F.when(F.size("dropped") == 0, F.col("n_chars"))
        .otherwise(F.char_length(text).cast("long"))
        .alias("n_chars"),
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.one_of_each(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, shuffled within their output shards.

    One file a shard; the number of shards follows the size of the texts, so a shard's size doesn't.
    """
    chars = docs.agg(F.coalesce(F.sum("n_chars"), F.lit(0))).first()[0]
    shards = max(LEAST_SHARDS, -(-chars // SHARD_CHARS))
    return (
        mixing.mixed(docs, shards=shards)
        .repartitionById(shards, F.col("mix_shard"))
        .sortWithinPartitions("mix_order")
        .select(*COLUMNS)
    )


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each whole text, and whether they decode to it again (with the library's
    treatment of the space mark)."""
    model = piece_merge.load_model(tokenizer_path())
    texts = docs.select(
        "doc_id",
        "lang",
        "source",
        F.md5(F.replace(text_of(), F.lit("▁"), F.lit(" "))).alias("spaced"),
        text_of().alias("text"),
    )
    return piece_merge.transcode(texts, "text", model).select(
        "doc_id",
        "lang",
        "source",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        (F.md5("decoded") == F.col("spaced")).alias("round_trip"),
        "ids",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("pieces", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


# A learnt score, draws by hash and merges of pieces have no counterpart in SQL.
ORACLE_SQL = None
