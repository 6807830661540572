"""The corpus pipeline: five stages over ``documents``, each one operator.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and
returns a DataFrame; the columns of ``documents``, but for the last, which
returns packed sequences. ``run`` writes each stage's result as Parquet in the
shared folder and rereads it as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regstar.llm.packing import pack_in_order, sequences
from regstar.llm.pfair import mixed
from regstar.llm.pii import redact
from regstar.llm.quality import keep_good
from regstar.llm.queries import SOURCE_SHARES, tokenizer_path
from regstar.llm.shared import SharedTables
from regstar.llm.simhash import one_of_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs, shingle=3, max_bits=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix of sources."""
    return mixed(docs, SOURCE_SHARES, other_weight=1, block=16)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 token ids, with the documents they hold; by
    ``sequence_id`` documents begin in the written order of ``docs``, that of the
    mix, and the rests of cut ones are packed by best fit into open windows."""
    return sequences(pack_in_order(docs, tokenizer_path(), open_windows=8))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packing", packed),
]

#: The stages hash, redact and tokenize in ways that SQL can't express; the
#: pipeline is tested against plain Python on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the ``documents`` of ``sf_dir``."""
    shared = SharedTables(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        docs = shared.put(stage(spark, docs, sf_dir), name)
        if k:
            shared.drop(STAGES[k - 1][0])
    return STAGES[-1][1](spark, docs, sf_dir)
