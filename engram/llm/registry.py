"""All queries of the subpackage: importing the operator modules fills the registry."""

from engram.llm import (  # noqa: F401
    bpe,
    decontaminate,
    hard_negatives,
    html_extract,
    near_dedup,
    pii,
    quality_classifier,
    quality_rules,
    secret_scan,
    spelling,
    url_filter,
    vptree,
    warc,
)
from engram.llm.common import QUERIES, SQL


def all_queries():
    return dict(QUERIES)


def all_sql():
    return dict(SQL)
