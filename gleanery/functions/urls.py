"""URL expressions: parts, canonical form, resolution of links, allow-list.

All are built-in expressions. ``let`` names an intermediate value inside one expression, so that it
is computed once and the optimizer has nothing to copy when it moves a filter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import uses_netloc, uses_params, uses_relative

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scheme, authority, path, query and fragment (RFC 3986, appendix B).
URL_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
# A host with one bracketed IPv6 or future address, or with no brackets at all.
HOST = (
    r"^(?:[^\[\]]*|[^\[\]]*\[(?:[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*(?:%[^\]]*)?|[vV][0-9A-Fa-f]+\..+)\][^\[\]]*)$"
)
# A path from the root without empty, "." or ".." segments, parameters, query or escapes; a slash or fragment may follow.
PLAIN_PATH = r"^((?:/[A-Za-z0-9_-][A-Za-z0-9_.-]*+)++)/?(?:#[A-Za-z0-9_.-]*+)?$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_scheme(url: Column) -> Column:
    """``http://`` is put before a URL that does not start with ``http``."""
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.lit("http://"), url))


def url_parts(url: Column) -> Column:
    """Struct of ``scheme, netloc, path, params, query, fragment``; missing parts are empty.

    NULL for a URL with a malformed bracketed host.
    """
    def split(clean: Column) -> Column:
        raw = F.struct(*[
            F.regexp_extract(clean, URL_PARTS, number).alias(name)
            for number, name in enumerate(["scheme", "netloc", "path", "query", "fragment"], start=1)
        ])
        return let(raw, finish)

    def finish(raw: Column) -> Column:
        scheme = F.lower(raw["scheme"])
        cut = scheme.isin(uses_params) & raw["path"].contains(";")
        parts = F.struct(
            scheme.alias("scheme"),
            raw["netloc"].alias("netloc"),
            F.when(cut, F.regexp_replace(raw["path"], r";[^/]*$", "")).otherwise(raw["path"]).alias("path"),
            F.when(cut, F.regexp_extract(raw["path"], r";([^/]*)$", 1)).otherwise("").alias("params"),
            raw["query"].alias("query"),
            raw["fragment"].alias("fragment"),
        )
        return F.when(raw["netloc"].rlike(HOST), parts)

    clean = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    return let(clean, split)


def site_root(parts: Column) -> Column:
    """Canonical scheme and host of a URL; NULL unless it is one of HTTP with a host."""
    usable = parts["scheme"].isin("http", "https") & (parts["netloc"] != "")
    return F.when(usable, F.concat(parts["scheme"], F.lit("://"), F.lower(parts["netloc"])))


def joined(scheme: Column, netloc: Column, path: Column, query: Column, fragment: Column) -> Column:
    """Text of a URL from its parts."""
    def after(sign: str, part: Column) -> Column:
        return F.when(part != "", F.concat(F.lit(sign), part)).otherwise("")

    rooted = F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    needs_slashes = path.startswith("//") | (
        (scheme != "") & scheme.isin(uses_netloc) & ((path == "") | path.startswith("/"))
    )
    body = (
        F.when(netloc != "", F.concat(F.lit("//"), netloc, rooted))
        .when(needs_slashes, F.concat(F.lit("//"), path))
        .otherwise(path)
    )
    head = F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise("")
    return F.concat(head, body, after("?", query), after("#", fragment))


def percent_decoded(text: Column) -> Column:
    """Percent and plus decoding; a percent sign without two hex digits stands for itself."""
    return F.try_url_decode(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"))


def percent_encoded(text: Column) -> Column:
    """Everything but letters, digits and ``_ . - ~`` escaped, space as plus."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_pairs(query: Column) -> Column:
    """Decoded ``struct(key, value)`` pairs in order; pairs without a value are left out."""
    given = F.filter(F.split(query, "&"), lambda pair: pair.rlike(r"(?s)^[^=]*=."))
    return F.transform(
        given,
        lambda pair: F.struct(
            percent_decoded(F.substring_index(pair, "=", 1)).alias("key"),
            percent_decoded(F.regexp_replace(pair, r"^[^=]*=", "")).alias("value"),
        ),
    )


def canonical(url: Column) -> Column:
    """Canonical form of a URL; NULL for a malformed one.

    Scheme and host are lower-cased, slashes at the end of the path, path parameters and the fragment
    are dropped, and the query is rebuilt without ``utm_`` keys and without pairs that have no value.
    """
    def build(parts: Column) -> Column:
        kept = F.filter(query_pairs(parts["query"]), lambda pair: ~pair["key"].startswith("utm_"))
        encoded = F.transform(
            kept,
            lambda pair: F.concat(percent_encoded(pair["key"]), F.lit("="), percent_encoded(pair["value"])),
        )
        reduced = F.struct(
            F.rtrim(parts["path"], F.lit("/")).alias("path"),
            F.when(parts["query"] == "", "").otherwise(F.array_join(encoded, "&")).alias("query"),
        )
        return let(reduced, lambda new: joined(
            parts["scheme"], F.lower(parts["netloc"]), new["path"], new["query"], F.lit("")
        ))

    return let(url_parts(url), build)


def resolved(page: Column, href: Column, page_parts: Column | None = None) -> Column:
    """Target of a link: ``href`` resolved against the URL of its page.

    A target that starts neither with the page URL nor with ``http`` becomes the page URL followed by
    the href. NULL for a malformed href.
    """
    def target(base: Column, link: Column) -> Column:
        other = ((link["scheme"] != "") & (link["scheme"] != base["scheme"])) | ~base["scheme"].isin(
            uses_relative
        )
        own_path = (link["path"] != "") | (link["params"] != "")
        chosen = (
            F.when(link["netloc"] != "", _choice(link, link["path"], link, link["query"]))
            .when(own_path, _choice(base, _merged(base, link), link, link["query"]))
            .otherwise(_choice(base, base["path"], base, F.coalesce(F.nullif(link["query"], F.lit("")), base["query"])))
        )
        return (
            F.when(href == "", page)
            .when(other, href)
            .when(link.isNotNull(), let(chosen, lambda c: joined(
                base["scheme"], c["netloc"], c["path"], c["query"], link["fragment"]
            )))
        )

    def checked(found: Column) -> Column:
        usable = found.startswith(page) | found.startswith("http")
        return F.when(usable, found).when(found.isNotNull(), F.concat(page, href))

    base = page_parts if page_parts is not None else url_parts(page)
    return let(base, lambda b: let(url_parts(href), lambda link: let(target(b, link), checked)))


def _choice(host: Column, path: Column, params: Column, query: Column) -> Column:
    """The parts a target takes from its page or from its href."""
    tail = F.when(params["params"] != "", F.concat(F.lit(";"), params["params"])).otherwise("")
    return F.struct(
        host["netloc"].alias("netloc"), F.concat(path, tail).alias("path"), query.alias("query")
    )


def _merged(base: Column, link: Column) -> Column:
    """Path of a relative link below its page, with ``.`` and ``..`` segments resolved.

    A path that does not start at the root also loses its empty inner segments.
    """
    rooted = link["path"].startswith("/")
    folder = F.regexp_replace(base["path"], r"[^/]*$", "")
    below = F.concat(F.when(folder == "", "/").otherwise(folder), link["path"])

    def step(done: Column, segment: Column) -> Column:
        return (
            F.when(segment == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
            .when(segment == ".", done)
            .otherwise(F.array_append(done, segment))
        )

    def walk(segments: Column) -> Column:
        last = F.size(segments) - 1
        solid = F.filter(segments, lambda s, i: (i == 0) | (i == last) | (s != "") | rooted)
        walked = F.aggregate(solid, F.array().cast("array<string>"), step)
        open_end = F.element_at(segments, -1).isin(".", "..")
        parts = F.concat(walked, F.when(open_end, F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))
        return let(F.array_join(parts, "/"), lambda text: F.when(text == "", "/").otherwise(text))

    return let(F.split(F.when(rooted, link["path"]).otherwise(below), "/"), walk)


@dataclass(frozen=True)
class AllowRule:
    """Which URLs a crawl may queue. The defaults are fixed values of the crawl this models."""

    domain: str = "en.wikipedia.org"
    path_prefix: str = "/wiki/"
    blocked_params: tuple[str, ...] = ("action", "diff", "oldid")


def allowed(url: Column, rule: AllowRule) -> Column:
    """Whether a URL passes ``rule``; malformed URLs do not."""
    def passes(parts: Column) -> Column:
        keys = F.transform(query_pairs(parts["query"]), lambda pair: pair["key"])
        rest = F.substring(parts["path"], len(rule.path_prefix) + 1, 2**31 - 1)
        return (
            parts["netloc"].endswith(rule.domain)
            & parts["path"].startswith(rule.path_prefix)
            & ~rest.contains(":")
            & ~F.arrays_overlap(keys, F.array(*map(F.lit, rule.blocked_params)))
        )

    return F.coalesce(let(url_parts(url), passes), F.lit(False))
