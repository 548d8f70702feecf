"""The operators as named queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayloom.llm import html_extract, license_scan, oracles, quality_rules, url_filter
from dayloom.llm.alignment import alignments
from dayloom.llm.collocations import COLLOCATIONS_SQL, collocations
from dayloom.llm.embedding_dedup import near_duplicates
from dayloom.llm.language_id import fit, identify
from dayloom.llm.lattice_lm import likelihoods
from dayloom.llm.mixing import Plan, mixture
from dayloom.llm.ngram_join import similar_groups
from dayloom.llm.packing import pack_documents
from dayloom.llm.shipping import shipped
from dayloom.llm.token_ids import default_vocabulary, piece_vocabulary
from dayloom.llm.token_store import read_documents, write_tokens
from dayloom.session import read_given, scratch_folder

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(build: Build) -> Build:
    QUERIES[build.__name__] = shipped(build)
    return build


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_given(spark, sf_dir, "pages"), url_filter.RULES)


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_given(spark, sf_dir, "documents"))


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(read_given(spark, sf_dir, "documents"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_given(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


@query
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_given(spark, sf_dir, "embeddings"))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_given(spark, sf_dir, "documents"), default_vocabulary())


#: the domain of a source, by its number
DOMAIN = "get(array('web', 'books', 'code', 'forum'), try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 4)"
MIXTURE = Plan(
    domains={"web": 4.0, "books": 3.0, "code": 2.0, "forum": 1.0},
    languages={"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0},
    sources={},
)


@query
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(read_given(spark, sf_dir, "documents"), F.expr(DOMAIN), MIXTURE, [])


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_given(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


@query
def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark)
    write_tokens(read_given(spark, sf_dir, "documents"), path, default_vocabulary())
    return read_documents(spark, path)


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(read_given(spark, sf_dir, "documents"))


@query
def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return likelihoods(read_given(spark, sf_dir, "documents"), piece_vocabulary())


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_given(spark, sf_dir, "documents"))


@query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(read_given(spark, sf_dir, "documents"), default_vocabulary(), piece_vocabulary())


ORACLES.update(
    op1_url_filter=oracles.url_filter(url_filter.RULES),
    op3_ngram_join=oracles.SIMILAR_GROUPS,
    op5_embedding_dedup=oracles.NEAR_DUPLICATES,
    op7_source_mixing=oracles.source_mixing(MIXTURE),
    op10_quality_rules=quality_rules.JUDGED_SQL,
    op12_phrase_collocations=COLLOCATIONS_SQL,
)
