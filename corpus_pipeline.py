"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm.common import written
from tracewright.llm.mixing import mixed_documents
from tracewright.llm.orderminhash import one_of_each_class
from tracewright.llm.packing import packed_documents
from tracewright.llm.quality import THRESHOLD, quality_model, with_quality
from tracewright.llm.suffixes import texts_without_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _counted(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.char_length(F.coalesce("text", F.lit(""))).cast("long"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores THRESHOLD or more, unchanged; other columns than those of documents go.

    It is trained on the labels of the table, without the held-out part. Null, empty and blank texts are scored like any other,
    as empty ones; repeated rows share a fate; a null id trains nothing; an empty table gives none. A very long text is scored whole,
    by all its passages.
    """
    rows = docs.select(*COLUMNS)
    model = quality_model(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_quality(rows, model).filter(F.col("quality_score") >= THRESHOLD).drop("quality_score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each class of near duplicates, unchanged.

    Null and empty texts are equal to each other, so one of them stays; one of repeated rows stays; a null id comes first; texts
    are compared whole, whatever their length; columns of any name pass; an empty table gives none.
    """
    return one_of_each_class(docs)


#: Bytes of a string that the suffix-array stage takes for a passage if it stands in two places: about 35 words of prose.
PASSAGE_BYTES = 200


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of PASSAGE_BYTES that start earlier too, in a document of lesser id or in the same one; the first copy stays.

    All rows stay, repeated ones with equal texts; a null text becomes an empty one, shorter texts stay whole; very long ones are
    searched whole; columns of any name pass; an empty table gives none.
    """
    return _counted(texts_without_repeats(docs, length=PASSAGE_BYTES, spare_first=True))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; documents of several epochs are repeated.

    A null source is one source, the last; repeated rows are documents of their own; a document without words stands once an
    epoch; ties of keys go by id and text; a very long text is taken whole or not; columns of any name pass; an empty table
    gives none.
    """
    return _counted(mixed_documents(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their places in sequences.

    A null or empty text is one piece, the end id; longer texts are cut; repeated rows get places of their own; columns besides
    id and text are ignored; an empty table gives none.
    """
    import public_tokenizers

    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mixing", mixing),
    ("best_fit_packing", best_fit_packing),
]

#: A trained model, hashed sketches and tokenisers aren't SQL's; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
