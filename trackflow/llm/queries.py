"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.llm import (
    extraction,
    langid,
    lexical,
    mixing,
    neardup,
    neighbours,
    packing,
    positive,
    quality,
    scoring,
    sharding,
    toxicity,
    whitening,
)
from trackflow.llm.shared import id_fold


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", F.coalesce(id_fold("doc_id", 5) == 0, F.lit(True)))
    training = docs.where(~F.col("held_out")).select("text", "lang")
    found = langid.identify(docs.select("doc_id", "held_out", "text"), training)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


def vocabulary() -> str:
    """The public tokenizer's file; it is installed wherever Python runs."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), vocabulary())


def op4_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    learned = F.coalesce(id_fold("doc_id", 5) != 1, F.lit(False))
    scored = scoring.score_marked(docs.withColumns({"train": learned, "scored": F.lit(True)}))
    held_out = F.coalesce(id_fold("doc_id", 5) == 1, F.lit(True)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_neardup(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "class_size", "kept")


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    learned = docs.where(id_fold("doc_id", 4) != 2)
    labels = table(spark, folder, "labels").where(id_fold("doc_id", 4) != 2)
    found = toxicity.classify(docs, learned, labels)
    held_out = F.coalesce(id_fold("doc_id", 4) == 2, F.lit(True)).alias("held_out")
    return found.select("doc_id", held_out, "score", "predicted")


def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), "vec_id % 20 = 0")


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"), 24)


def op10_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(table(spark, folder, "pages"))


def op11_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_positive(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    learned = docs.where(id_fold("doc_id", 4) != 2)
    labels = table(spark, folder, "labels").where(id_fold("doc_id", 4) != 2)
    held_out = F.coalesce(id_fold("row.doc_id", 4) == 2, F.lit(True)).alias("held_out")
    found = positive.classify(docs, learned, labels)
    return found.select("row.doc_id", held_out, "score", "predicted")


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_scoring": op4_scoring,
    "op5_neardup": op5_neardup,
    "op6_mixing": op6_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_neighbours": op8_neighbours,
    "op9_sharding": op9_sharding,
    "op10_extraction": op10_extraction,
    "op11_lexical": op11_lexical,
    "op12_positive": op12_positive,
    "op13_whitening": op13_whitening,
}
