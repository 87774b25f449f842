"""Corpus pipeline over ``documents``: each stage's result is written as Parquet and is the next one's input.

All stages but the last return the columns of ``documents``: toxic documents go, recurring lines go, of each group of near-duplicates one
document stays, documents are sampled to target weights, and what is left is packed into training sequences.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from keyweave.llm import toxicity
from keyweave.llm.line_dedup import drop_recurring_lines
from keyweave.llm.minhash import without_near_duplicates
from keyweave.llm.mixing import mixed
from keyweave.llm.packing import pack_documents
from keyweave.llm.queries import KEEP, TARGETS, TOKENIZER
from keyweave.llm.shared import stored


def drop_toxic(spark, docs, sf_dir):
    """Rows that the classifier doesn't reject. It learns from the labelled rows of this input outside the held-out fold; a null text counts as empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    classifier = toxicity.train(docs, labels, learn_from=~toxicity.held_out(F.col("doc_id")))
    return docs.where(~toxicity.is_toxic(classifier)(F.col("text")))


def drop_lines(spark, docs, sf_dir):
    """All rows, without the lines that recur in other documents; a null text stays null. A column n_lines_dropped, where there is one, gets the number of them."""
    return drop_recurring_lines(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark, docs, sf_dir):
    """One row of each group of near-duplicates (five words, 0.8); rows without a doc_id, and one of each doc_id without words, stay."""
    return without_near_duplicates(docs)


def mix(spark, docs, sf_dir):
    """Rows sampled to the target weights of source, language and topic; categories without a target keep their share."""
    return mixed(docs, TARGETS, KEEP)


def pack(spark, docs, sf_dir):
    """One row per piece of a document in a training sequence; a null text is an empty one."""
    return pack_documents(docs, TOKENIZER, with_ids=False)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("minhash", drop_near_duplicates), ("mixing", mix), ("packing", pack)]
#: SQL has no equal of a trained classifier, near-duplicate search or tokenizer.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Result of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
