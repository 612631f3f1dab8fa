"""From raw documents to packed sequences: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from breezemart.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from breezemart.llm.shared import staged, table
from breezemart.llm.tokens import vocabulary


def _rest(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != "doc_id"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score, learnt from the labelled ones among `docs`, rejects go."""
    texts = toxicity.prepared(docs, _rest(docs))
    model = toxicity.fit(texts, table(spark, sf_dir, "labels"))
    return toxicity.toxicity(texts, model).where("predicted = 0").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z one document stays, the one with the largest doc_id."""
    return exact_dedup.exact_dedup(docs, carry=_rest(docs)).where("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates one document stays, the one with the smallest doc_id."""
    return near_dedup.near_dedup(docs, carry=_rest(docs)).where("kept").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: a document taken twice is two rows."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of at most 1024 tokens."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the fitted toxicity score nor the sketches, so the tests compare
#: each stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
