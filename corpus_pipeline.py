"""The corpus pipeline: documents in, packed token ids out.

Quality, near duplicates, decontamination, mixing and token output, in this order. Each stage
works on all that the one before it kept. Every stage but the last returns the columns of
documents; the last returns where each document's ids are in the token store that it wrote.

Nulls and odd input: as each operator's docstring says. Documents without text go in the first
stage; of documents that repeat a doc_id with one text, the rows stay together through the
first three stages; the mix may repeat a document's row up to three times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import common, decontaminate, mixing, ngram_join, quality, token_store

STAGES = [
    ("quality", common.shipped(quality.stage)),
    ("near_duplicates", common.shipped(ngram_join.stage)),
    ("decontamination", common.shipped(decontaminate.stage)),
    ("mixing", common.shipped(mixing.stage)),
    ("tokens", common.shipped(token_store.stage)),
]

#: No stage but mixing's word counts can be said in SQL; tests/llm holds the operators against brute
#: force and the stages against cases worked out by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, writing what each returns and reading it again."""
    docs = common.documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        found = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            found = common.saved(found, f"stage-{k}-{name}")
            if k:  # what the stage before wrote is used up; the documents themselves are the caller's
                common.forget(docs)
        docs = found
    return docs
