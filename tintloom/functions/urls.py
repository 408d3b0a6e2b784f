"""URL rules under a host policy, as column expressions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from tintloom.functions.text import none_if_empty

# Prefixes of product tokens.
PRODUCT_TOKEN = r"(?i)(pimprod\d+|xlsimpprod\d+|prod\d+|mkt\d+|vp\d+)"


class HostPolicy(NamedTuple):
    """Which hosts a catalogue's pages come from (`.name` for all below it), the one they are written with, and the parameter that names a variant."""

    hosts: tuple[str, ...] = ("shop.example", "www.shop.example")
    canonical: str = "www.shop.example"
    parameter: str = "sku"
    media_host: str = "media.shop.example"
    swatch_template: str = "https://media.shop.example/i/%1$s_sw?img404=%1$s&w=400&fmt=auto"


def undotted(url: Column) -> Column:
    """The URL with `.` and `..` taken out of its path; `..` at the top is ignored."""
    origin = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    steps = F.split(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/", -1)
    last = F.element_at(steps, -1)
    kept = F.aggregate(
        F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(step == ".", done).otherwise(F.array_append(done, step)),
    )
    path = F.concat(F.lit("/"), F.array_join(F.when(last.isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept), "/"))
    return F.concat(origin, path, F.regexp_extract(url, r"^[^?#]*(.*)$", 1))


def resolved(url: Column, base: Column) -> Column:
    """`url` against `base`: absolute, scheme-relative, host-relative, query, fragment or path-relative; dots in a relative path are followed."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    bare = F.regexp_replace(base, r"[?#].*$", "")
    stepped = lambda u: F.when(u.rlike(r"^[^?#]*/\.\.?(?:[/?#]|$)"), undotted(u)).otherwise(u)
    folder = F.when(bare.rlike(r"://[^/]*/"), F.regexp_replace(bare, r"[^/]*$", "")).otherwise(F.concat(bare, F.lit("/")))
    return (
        F.when(url.isNull() | (url == ""), base)
        .when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), url)
        .when(url.startswith("//"), F.concat(scheme, F.lit(":"), url))
        .when(url.startswith("/"), stepped(F.concat(origin, url)))
        .when(url.startswith("?"), F.concat(bare, url))
        .when(url.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), url))
        .otherwise(stepped(F.concat(folder, url)))
    )


def host(url: Column) -> Column:
    """Host in lower case without user and port; null if there is none."""
    return none_if_empty(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)))


def path(url: Column) -> Column:
    """The path without parameters after a semicolon in its last part."""
    return F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), ";[^/]*$", "")


def parameter(url: Column, name: str) -> Column:
    """The first non-empty value of a query parameter, decoded; null if there is none."""
    raw = none_if_empty(F.regexp_extract(url, rf"^[^?#]*\?(?:[^#]*?&)??{name}=([^&#]+)", 1))
    return F.coalesce(F.try_url_decode(raw), raw)


def is_allowed(name: Column, policy: HostPolicy) -> Column:
    """Whether a host is one of the policy's."""
    allowed = F.lit(False)
    for h in policy.hosts:
        allowed = allowed | (name.endswith(h) if h.startswith(".") else name == h)
    return F.coalesce(allowed, F.lit(False))


def canonical(url: Column, policy: HostPolicy) -> Column:
    """An absolute URL as https, the canonical host, the path, and only the variant's parameter; null for other hosts."""
    value = parameter(url, policy.parameter)
    query = F.when(value.isNotNull(), F.concat(F.lit(f"?{policy.parameter}="), F.url_encode(value))).otherwise("")
    return F.when(is_allowed(host(url), policy), F.concat(F.lit(f"https://{policy.canonical}"), path(url), query))


def normalized(url: Column, base: Column, policy: HostPolicy) -> Column:
    """The canonical form of `url` against `base`."""
    return canonical(resolved(url, base), policy)


def product_token(url: Column) -> Column:
    """The leftmost product token of the path, in its case."""
    return none_if_empty(F.regexp_extract(path(url), PRODUCT_TOKEN, 1))


def without_query(url: Column) -> Column:
    return F.regexp_replace(url, r"[?#].*$", "")


def with_variant(url: Column, variant: Column, policy: HostPolicy) -> Column:
    """The URL with its variant's parameter, added if it has none."""
    return F.when(parameter(url, policy.parameter).isNotNull(), url).otherwise(F.concat(without_query(url), F.lit(f"?{policy.parameter}="), F.url_encode(variant)))


def swatch_url(found: Column, kind: Column, sku: Column, policy: HostPolicy) -> Column:
    """The swatch that was found; a colour without one gets the media host's address for its SKU."""
    return F.coalesce(none_if_empty(found), F.when(kind == "color", F.format_string(policy.swatch_template, sku)))


def availability(value: Column) -> Column:
    return F.element_at(F.split(value, "/"), -1)


def is_swatch_url(url: Column, policy: HostPolicy) -> Column:
    return F.coalesce(url.startswith("https://") & (host(url) == policy.media_host), F.lit(False))


def source_type(url: Column) -> Column:
    """`product` for paths below /p/, else `listing`."""
    return F.when(path(url).startswith("/p/"), "product").otherwise("listing")


def collection_name(url: Column, default: str = "collection") -> Column:
    """A name for a URL: its product token, else its last path segment as a slug, else the default."""
    segment = F.element_at(F.split(F.regexp_replace(path(url), "/+$", ""), "/"), -1)
    slug = F.regexp_replace(F.regexp_replace(F.lower(segment), r"[^a-z0-9_-]+", "-"), "^[-_]+|[-_]+$", "")
    return F.coalesce(F.lower(product_token(url)), none_if_empty(slug), F.lit(default))
