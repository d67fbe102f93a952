"""A training corpus from ``documents``: four stages, each over all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it down
and reads it again as the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import packing, repeats, simhash, toxicity
from tidemark.llm.common import materialise, read_table
from tidemark.llm.queries import PACK_END_ID, PACK_TOKENS


#: Bytes of a string that counts as a shared passage. Passages of over 50 words can be as short
#: as 155 bytes. On the test documents, 200 bytes touch every document that shares such a
#: passage and 400 bytes three of four, for 5.7 and 4.1 % of the others.
PASSAGE_BYTES = 200


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the model learns on ``docs``.

    Null and empty texts are scored like others; columns may have any name. An empty table
    stays empty.
    """
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.train(toxicity.training_rows(docs, labels))
    taken = {c.lower() for c in docs.columns}
    score, toxic = (next(n for n in _names(base) if n not in taken) for base in ("score", "toxic"))
    scored = toxicity.score(docs, model, extra=docs.columns, names=(score, toxic))
    return scored.filter(F.col(toxic) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def _names(base: str):
    """``base`` and longer names made of it, without end."""
    while True:
        yield base
        base = f"_{base}"


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; see ``simhash.keep_one_per_component``."""
    return simhash.keep_one_per_component(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings of ``PASSAGE_BYTES`` that stand elsewhere as well.

    A null text stays null, a text may become empty; every document stays a row.
    """
    return repeats.remove_repeats(docs, PASSAGE_BYTES)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of one length; a null text is an empty one."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), PACK_END_ID, PACK_TOKENS)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("repeats", cut_repeats),
    ("packing", pack),
]

#: Learning, fingerprints and tokens are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
