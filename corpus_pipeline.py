"""From documents to token ids: language, near-duplicates, personal data, mixing, encoding.

Every stage works on all rows its predecessor kept and takes (spark, docs, sf_dir). All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import bpe, langid, mixing, nearcopies, pii
from gleanery.llm.common import table
from gleanery.llm.queries import vocabulary_path
from gleanery.session import checkpointed

#: A document of a known language is rejected only below this score.
LEAST_SCORE = 0.2
#: Documents are long: so many at a time are held by Spark and by a Python worker.
ROWS_PER_BATCH = 250
#: A word with what stands before it.
_PIECE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def _in_small_batches(spark: SparkSession) -> None:
    """Texts go to Python workers in small batches, from here on in this session."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= ROWS_PER_BATCH:
        spark.conf.set(setting, str(ROWS_PER_BATCH))


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known, with it in `lang`.

    Learnt from the labelled documents. Null texts, texts without a letter and those that no
    language fits go; where nothing is labelled, no language can be told and no document stays.
    """
    _in_small_batches(spark)
    found = langid.identify(docs, langid.train(docs))
    kept = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word similarity of 0.8 or more the one with the smallest id."""
    _in_small_batches(spark)
    return nearcopies.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets; n_chars follows the text."""
    _in_small_batches(spark)
    found = pii.find_spans(docs, pii.train(docs), name="_spans")
    clean = pii.redact(found, spans="_spans")
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, a row for each time.

    A document at its source's cut is taken with its first words only, as many as the budget
    has left. Documents without words have nothing to take.
    """
    mixed = mixing.mix(docs.select(*docs.columns)).filter("taken > 0")
    rest = F.col("taken") % F.col("size")
    whole = ((F.col("taken") - rest) / F.col("size")).cast("int")
    times = whole + F.when(rest > 0, 1).otherwise(0)
    copies = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), times)))
    words = F.slice(F.regexp_extract_all("text", F.lit(_PIECE), F.lit(0)), F.lit(1), rest.cast("int"))
    cut = F.col("_copy") > whole
    return (
        copies.withColumn("text", F.when(cut, F.array_join(words, "")).otherwise(F.col("text")))
        .withColumn("n_chars", F.char_length("text").cast("bigint"))
        .select(*docs.columns)
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    _in_small_batches(spark)
    encoded = bpe.round_trip(docs, vocabulary_path())
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Language ID and the hashes of the mix have no counterpart in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written, and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
