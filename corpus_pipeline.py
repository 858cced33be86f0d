"""From raw documents to sampled token sequences, in five stages."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptrail.llm import bwt, jaccard, mixing, pieces, quality
from uptrail.llm.common import CREATED, discard_folder, n_words, table, written
from uptrail.llm.queries import MIX, mix_levels, piece_bpe


#: What the stages before have left in the shared folder: their rows are written by then.
LEFT: list[str] = []


def stage(step):
    """A stage that first deletes the working tables of the stages before it, but not its input."""
    @wraps(step)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        used = [f.rsplit("/", 1)[0] for f in docs.inputFiles()]
        for path in LEFT:
            if not any(u.endswith(path.rsplit("/", 1)[1]) for u in used):
                discard_folder(spark, path)
        first = len(CREATED)
        out = step(spark, docs, sf_dir)
        LEFT[:] = CREATED[first:]
        return out
    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go. The references of a language are those of all documents."""
    return quality.judged(docs).where("kept").select(*docs.columns)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest doc_id: shingles of five words, 80 %."""
    return jaccard.one_each(docs)


@stage
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes that occur twice go. Every document stays; n_chars follows the text."""
    out = bwt.stripped(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    return out.select(*[n_chars if c == "n_chars" else F.col(c) for c in docs.columns])


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source gets its share of tokens; a document stands there once for each epoch it is in."""
    taken = mixing.mixed(docs.withColumn("_domain", mix_levels()[0]), [F.col("_domain"), F.col("lang"), F.col("source")], "doc_id", n_words(), MIX)
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)


@stage
def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document, as ids."""
    return pieces.sampled(docs, piece_bpe(), sampling=pieces.Sampling(k=2, seed=5))


STAGES = [("quality", quality_rules), ("near-duplicates", near_duplicates), ("repeats", repeated_strings),
          ("mix", source_mix), ("segmentations", segmentations)]

#: The stages of byte strings, draws and divergences have no SQL form; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = written(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
