"""The URL query over all pages.  SQL cannot express the trained classifier."""

from __future__ import annotations

from clamor.llm.common import table
from clamor.llm.url_filter import url_verdicts


def op2_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_verdicts(pages).drop("url")


QUERIES = {"op2_url_filter": op2_url_filter}
ORACLES = {}
