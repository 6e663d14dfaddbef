"""HTTP responses and URLs as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sleevework.functions.core import blank_to_null, let

# What a bot-challenge page says.
CHALLENGE_TEXTS = ("just a moment", "cf-chl", "challenge-platform", "checking your browser")


def lower_headers(headers: Column) -> Column:
    """Header names in lower case; of two spellings of a name the later one counts."""
    folded = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(folded, lambda e: e["key"]))

    def last_value(name: Column) -> Column:
        same = F.filter(folded, lambda e: e["key"] == name)
        return F.struct(name.alias("key"), F.element_at(same, -1)["value"].alias("value"))

    return F.map_from_entries(F.transform(names, last_value))


def is_challenge(status: Column, headers: Column, body: Column) -> Column:
    """A 403/503 marked as a challenge, or one that reads like it and comes from the proxy."""
    known = lower_headers(headers)
    marked = F.lower(known["cf-mitigated"]) == "challenge"
    text = F.lower(F.coalesce(body, F.lit("")))
    reads_like_it = reduce(Column.__or__, [text.contains(t) for t in CHALLENGE_TEXTS])
    from_proxy = (F.lower(known["server"]) == "cloudflare") | F.map_contains_key(known, "cf-ray")
    return status.isin(403, 503) & (F.coalesce(marked, F.lit(False)) | (reads_like_it & F.coalesce(from_proxy, F.lit(False))))


def classify_response(status: Column, headers: Column, body: Column) -> Column:
    """Outcome of a response; the first rule that applies decides."""
    return (
        F.when(status.between(200, 299), "ok")
        .when(status == 404, "not_found")
        .when(is_challenge(status, headers, body), "challenge")
        .when(status == 429, "rate_limited")
        .when(status >= 500, "transient")
        .otherwise("error")
    )


def retry_after(headers: Column) -> Column:
    """Seconds from a numeric ``Retry-After``; dates and junk give NULL."""
    return F.trim(lower_headers(headers)["retry-after"]).try_cast("double")


def quote_plus(value: Column) -> Column:
    """Form encoding that also escapes ``*`` and leaves ``~`` alone."""
    return F.replace(F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def absolute_url(href: Column, site: str) -> Column:
    def read(address: Column) -> Column:
        return (
            F.when(F.coalesce(address, F.lit("")) == "", F.lit(None))
            .when(address.startswith("http://") | address.startswith("https://"), address)
            .when(address.startswith("/"), F.concat(F.lit(site), address))
            .otherwise(F.concat(F.lit(site + "/"), address))
        )

    return let(href, read)


def ref_link(href: Column, site: str) -> Column:
    """Absolute link without its query string."""
    return absolute_url(F.when(blank_to_null(href).isNotNull(), F.substring_index(href, "?", 1)), site)
