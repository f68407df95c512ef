"""A training corpus from the documents table: five stages, each written as Parquet and reread by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import curriculum, minhash, packing, pseudonyms, quality
from stridelake.llm.common import stored

TOKENIZER = "word_bpe_49k.json"
#: Least similarity of near copies, in percent of the union of their word shingles.
PERCENT = 80
#: Scoring, similarity and packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def _apart(docs: DataFrame, *columns: str) -> DataFrame:
    """What a stage works on beside the whole row, which travels in ``row``: no column of the caller can clash with the stage's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's perplexity band.

    NULL and empty texts and those under fifty words go; a NULL language is one of its own; repeated rows are judged alike;
    long texts are read whole; an empty table stays empty.
    """
    handle = F.xxhash64("lang", "text").alias("handle")  # the verdict is one on language and text
    kept = quality.assess(docs.select(handle, "lang", "text"), carry=("handle",)).where("kept").select("handle").distinct()
    return _apart(docs, handle).join(kept, "handle", "left_semi").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; of its rows, one.

    Texts without words are linked with nothing and stay, once for each id; missing and repeated ids are told apart by
    their group; ties go to the smallest text hash; an empty table stays empty.
    """
    found = minhash.near_duplicates(docs.select("doc_id", "text"), PERCENT).where("kept").select("doc_id", "text_hash", "component")
    # ids may be missing or repeated: a group is its component; texts without a set speak for themselves
    alone = F.when(F.col("component").isNull(), F.col("text_hash")).alias("e")
    one = found.groupBy("component", alone, "doc_id").agg(F.min("text_hash").alias("text_hash")).select("doc_id", "text_hash")
    rows = _apart(docs, "doc_id", F.xxhash64("text").alias("hash")).dropDuplicates(["doc_id", "hash"]).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")) & F.col("d.hash").eqNullSafe(F.col("o.text_hash"))
    return rows.join(one.alias("o"), same, "left_semi").select("row.*")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers, dates, addresses and secrets replaced by pseudonyms of their format, under the key in the session's
    ``spark.corpus.pseudonymKey``; without one the published demonstration key makes them reversible.

    Every row and every other column stays; NULL and empty texts stay as they are; long texts are treated whole.
    """
    key = spark.conf.get("spark.corpus.pseudonymKey", pseudonyms.KEY)
    new = pseudonyms.pseudonymise(_apart(docs, "text"), key)
    return new.select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order.

    Texts without words have size 0 and are never taken; NULL is a source, the last one; repeated rows are taken each for
    itself; equal positions are ordered by id; an empty table stays empty.
    """
    return curriculum.training_order(curriculum.mix(_apart(docs, "doc_id", "source", "text"), keep_text=False)).select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 2048 tokens.

    NULL and empty texts are an end token; repeated rows and ids are packed like others; other columns are left out.
    """
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("pii", pii),
    ("target_weights", target_weights),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
