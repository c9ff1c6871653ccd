"""A training corpus from ``documents``: good, distinct, uncontaminated, packed.

Each stage takes the documents that the stage before it kept and returns documents
with the same columns; the last returns packed pieces. ``run`` writes the result of
every stage to the shared checkpoint folder and reads it back.

Documents are told apart by ``doc_id``. Documents without an id pass the near-duplicate
stage and the repeat stage unchanged; rows that share an id are kept or dropped
together by the near-duplicate stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellurion.llm import decontam, jaccard, packing, quality, repeats
from tellurion.llm.common import staged, table

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: Ids of dropped documents are broadcast up to this number, and joined by a shuffle beyond it.
MOST_BROADCAST = 1_000_000
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    stats = staged(quality.measured(docs), "statistics")
    model = quality.train(stats, table(spark, sf_dir, "labels"))
    return docs.where(quality.scored(F.col("text"), model) >= 0.5)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each near-duplicate class."""
    classes = jaccard.near_duplicates(docs)
    dropped = staged(classes.where("component_id <> doc_id").select("doc_id").distinct(), "dropped")
    if dropped.count() <= MOST_BROADCAST:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def fresh_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of earlier ones; those with nothing left go."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    marked = repeats.mark_repeats(docs, carry=others, as_text=True)
    left = marked.where((F.octet_length("kept") > 0) | (F.size("spans") == 0))
    left = left.withColumnRenamed("kept", "text")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    for index in decontam.indexes(table(spark, sf_dir, "benchmark")):
        docs = docs.where(~decontam.contaminated(F.col("text"), index))
    return docs


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of bounded length."""
    packed = packing.pack(docs, public_tokenizers.path(TOKENIZER), END_ID, lean=True)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", distinct_documents),
    ("suffix-array dedup", fresh_passages),
    ("benchmark decontamination", uncontaminated),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus of the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
