"""The corpus pipeline: stages over the documents table, each one an operator of ``dayloom.llm``.

All stages but the last return the columns of ``documents``, others beside them included. Defined results: a document with a null or empty
text goes in the first stage (it has few words), one without a letter in the second; equal rows are copies, of which the third keeps one; a
null ``doc_id`` comes last among copies, a null ``lang`` or ``source`` is a value like any other to the fourth; extra columns and names that
the operators use inside are carried along unread up to the last stage, which returns pieces; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayloom.llm import language_id, quality_rules
from dayloom.llm.mixing import mixed_documents
from dayloom.llm.ngram_join import one_per_group
from dayloom.llm.packing import pack_documents
from dayloom.llm.queries import DOMAIN, MIXTURE
from dayloom.llm.shipping import shipped
from dayloom.llm.token_ids import default_vocabulary
from dayloom.session import read_given, stored


@shipped
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule of the policy rejects."""
    return quality_rules.keep_good(docs)


@shipped
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network, trained on what came in, tells with some certainty."""
    return language_id.keep_known(docs, language_id.fit(docs))


@shipped
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies."""
    return one_per_group(docs)


@shipped
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights, each at most once."""
    return mixed_documents(docs, F.expr(DOMAIN), MIXTURE._replace(share=0.75, max_epochs=1))


@shipped
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, each in its place of a sequence."""
    return pack_documents(docs, default_vocabulary())


STAGES = [
    ("quality rules", good_quality),
    ("language ID", known_language),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing", mixed),
    ("best-fit packing", packed),
]


@shipped
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = read_given(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The language network is trained, which SQL cannot express; tests hold the pipeline against brute force.
ORACLE_SQL = None
