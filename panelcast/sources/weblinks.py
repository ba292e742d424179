"""Download-link discovery over stored web pages.

For each page: the first ``<a ... href="...">`` in document order (outside
scripts and comments) whose href matches a case-insensitive pattern;
absolute hrefs are kept, relative ones are joined to the page's origin.
Pages without a match get a NULL link (a left-outer result, never dropped).
A narrow per-row projection: regex extraction, ``filter`` keeps order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Anchor and origin patterns.
ANCHOR_HREF = r"""<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""
SCRIPT_OR_COMMENT = r"(?is)<script.*?</script>|<!--.*?-->"
ORIGIN = r"^(https?://[^/?#]+)"


def first_matching_link(html: Column, url: Column, pattern: str) -> Column:
    body = F.regexp_replace(html, SCRIPT_OR_COMMENT, "")
    hrefs = F.regexp_extract_all(body, F.lit("(?i)" + ANCHOR_HREF), 1)
    hits = F.filter(hrefs, lambda h: h.rlike("(?i)" + pattern))
    first = F.try_element_at(hits, F.lit(1))
    origin = F.regexp_extract(url, ORIGIN, 1)
    return F.when(first.startswith("http"), first).otherwise(F.concat(origin, first))


def discover_links(pages: DataFrame, pattern: str, *, url: str = "url", html: str = "html") -> DataFrame:
    return pages.select("page_id", url, first_matching_link(F.col(html), F.col(url), pattern).alias("link"))
