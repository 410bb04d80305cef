"""URL Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Authority part (host, port and user info) and scheme plus authority of a URL.
NETLOC_REGEX = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
ORIGIN_REGEX = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def netloc(url: Column) -> Column:
    """Authority of the URL; empty when there is none, null for null."""
    return F.regexp_extract(url, NETLOC_REGEX, 1)


def clean_domain(url: Column) -> Column:
    """Authority with every ``www.`` removed."""
    return F.replace(netloc(url), F.lit("www."), F.lit(""))


def absolute_url(link: Column, page_url: Column) -> Column:
    """Links relative to the site get the scheme and host of their page, ``//`` links its scheme; others pass."""
    scheme = F.regexp_extract(page_url, "^([A-Za-z][A-Za-z0-9+.-]*:)//", 1)
    return F.when(link.startswith("//"), F.concat(scheme, link)).when(
        link.startswith("/"), F.concat(F.regexp_extract(page_url, ORIGIN_REGEX, 1), link)
    ).otherwise(link)
