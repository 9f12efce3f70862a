"""HTML expressions: readable text, link targets and attribute values of a page.

Loops in the patterns are possessive, and an opener without an end takes the rest of the page with it, so
matching takes linear time and constant stack on any page.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.urls import let

# A noncharacter, which no text contains, marks the places where tags and comments stood.
GAP = "\ufdd0"
REST_OF_TAG = r"(?:=++\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[^>=]++)*+"
START_TAG = rf"<[a-zA-Z]{REST_OF_TAG}>"
SKIPPED = (
    r"(?is)<!--.*?(?:--\s*+>|\z)"
    rf"|<script(?=[\s/>]){REST_OF_TAG}(?:(?<!/)>.*?(?:</\s*+script\s*+>|\z)|\z)"
    rf"|<style(?=[\s/>]){REST_OF_TAG}(?:(?<!/)>.*?(?:</\s*+style\s*+>|\z)|\z)"
    rf"|({START_TAG})"
    rf"|<[a-z]{REST_OF_TAG}\z"
)
# Elements whose text is not part of the readable text, although their tags count.
SILENT = rf"(?is)<(template|rt|rp)(?=[\s/>]){REST_OF_TAG}(?<!/)>.*?(?:</\1\s*+>|\z)"
ANY_TAG = rf"(?s){START_TAG}|<[/!?][^>]*+(?:>|\z)"
ATTRIBUTE = r"([^\s/>=][^\s/=>]*+(?:\s*+=++\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^>\s]*+))?+)"
PLAIN_LINK = r"^<[aA] href=\"([A-Za-z0-9_.:/#-]*+)\">$"
SPACE = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"
EDGE_SPACE = rf"^{SPACE}++|(?<!{SPACE}){SPACE}++$"

# Entities common enough to have their own path, with the ampersand last.
COMMON_ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "#39": "'", "nbsp": "\u00a0", "copy": "©",
    "middot": "·", "amp": "&",
}
RARE_ENTITY = rf"&(?!(?:{'|'.join(COMMON_ENTITIES)});)[A-Za-z#]"
NAMES = {name: text for name, text in html5.items() if name.endswith(";")}
# Names that older pages write without a semicolon, longest first.
BARE_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
# Numbers 128 to 159 mean the Windows-1252 characters.
WINDOWS_1252 = {
    str(code): bytes([code]).decode("cp1252", errors="replace")
    for code in range(128, 160)
    if bytes([code]).decode("cp1252", errors="ignore")
}


def _table(entries: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def _character(code: Column) -> Column:
    """The character of a code point given as text; NULL or out of range gives U+FFFD."""
    number = code.try_cast("bigint")
    legal = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    point = F.when(legal, number).otherwise(F.lit(0xFFFD).cast("bigint"))
    plain = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    return F.coalesce(_table(WINDOWS_1252)[code], plain)


def decode_entities(text: Column, attribute: bool = False) -> Column:
    """Character references resolved.

    In an attribute value a known name may be followed by more letters and an unknown one stays as
    it is. In page text a name runs to its end and an unknown one loses its semicolon.
    """
    common = text
    for name, character in COMMON_ENTITIES.items():
        common = F.replace(common, F.lit(f"&{name};"), F.lit(character))

    def reference(piece: Column) -> Column:
        digits = F.regexp_extract(piece, r"^#([0-9]+)", 1)
        hexed = F.regexp_extract(piece, r"^#[xX]([0-9a-fA-F]+)", 1)
        full = F.regexp_extract(piece, r"^([A-Za-z][A-Za-z0-9]*;)", 1)
        after_number = F.regexp_replace(piece, r"^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", "")
        numbered = (
            F.when(digits != "", F.concat(_character(digits), after_number))
            .when(hexed != "", F.concat(_character(F.conv(F.right(hexed, F.lit(15)), 16, 10)), after_number))
        )
        if attribute:
            bare = F.regexp_extract(piece, rf"^({'|'.join(BARE_NAMES)})", 1)
            named = (
                F.when(_table(NAMES)[full].isNotNull(),
                       F.concat(_table(NAMES)[full], F.substr(piece, F.length(full) + 1)))
                .when(bare != "", F.concat(_table({n: html5[n] for n in BARE_NAMES})[bare],
                                           F.substr(piece, F.length(bare) + 1)))
            )
            unknown = F.concat(F.lit("&"), piece)
        else:
            name = F.regexp_extract(piece, r"^([A-Za-z][-.A-Za-z0-9]*)", 1)
            rest = F.regexp_replace(piece, r"^[A-Za-z][-.A-Za-z0-9]*;?", "")
            value = _table(NAMES)[F.concat(name, F.lit(";"))]
            named = F.when(value.isNotNull(), F.concat(value, rest))
            unknown = F.concat(F.lit("&"), F.when(name != "", F.concat(name, rest)).otherwise(piece))
        return F.coalesce(numbered, named, unknown)

    pieces = F.split(text, "&")
    rare = F.array_join(
        F.transform(pieces, lambda piece, i: F.when(i == 0, piece).otherwise(reference(piece))), ""
    )
    return F.when(text.rlike(RARE_ENTITY), rare).otherwise(common)


def visible_html(html: Column) -> Column:
    """HTML with comments, scripts and styles replaced by a gap."""
    return F.regexp_replace(html, SKIPPED, f"{GAP}$1")


def start_tags(visible: Column, name: str) -> Column:
    """Start tags of one element in page order, as text."""
    return F.regexp_extract_all(visible, F.lit(rf"(?is)(<{name}(?=[\s/>]){REST_OF_TAG}>)"), F.lit(1))


def attribute(tag: Column, name: str | Column) -> Column:
    """Decoded value of an attribute of a start tag; the last one counts, NULL without any."""
    body = F.regexp_replace(tag, r"^<[^\s/>]+|/?>$", " ")
    given = F.filter(
        F.regexp_extract_all(body, F.lit(ATTRIBUTE), F.lit(1)),
        lambda pair: F.lower(F.regexp_extract(pair, r"^([^\s=]+)", 1)) == name,
    )
    raw = F.regexp_replace(
        F.regexp_replace(F.element_at(F.concat(F.array(F.lit(None)), given), -1), r"(?s)^[^=]*(?:=+\s*|$)", ""),
        r"(?s)^([\"'])(.*)\1$", "$2",
    )
    return let(raw, lambda value: decode_entities(value, attribute=True))


def visible_text(visible: Column) -> Column:
    """Text pieces between tags, stripped and joined by one space."""
    gapped = F.regexp_replace(F.regexp_replace(visible, SILENT, GAP), ANY_TAG, GAP)
    pieces = let(gapped, lambda text: F.split(decode_entities(text), GAP))
    stripped = F.transform(pieces, lambda piece: F.regexp_replace(piece, EDGE_SPACE, ""))
    return F.array_join(F.filter(stripped, lambda piece: piece != ""), " ")


def page_text(html: Column) -> Column:
    """Readable text, then image descriptions, then the page description, joined by spaces.

    The part for images is there even when empty. The description is the first
    ``meta name="description"``, else the first ``meta property="og:description"``; a tag without
    content counts as absent. Line ends become spaces.
    """
    wanted = F.array(*map(F.lit, ["alt", "name", "property", "content"]))

    def described(tags: Column, attribute_index: int, value: str) -> Column:
        named = F.filter(tags, lambda t: t["is_meta"] & (t["values"][attribute_index] == value)
                         & t["values"][3].isNotNull())
        return F.get(named, F.lit(0))["values"][3]

    def parts(visible: Column, tags: Column) -> Column:
        alts = F.filter(tags, lambda t: ~t["is_meta"] & (t["values"][0] != ""))
        return F.concat_ws(
            " ",
            visible_text(visible),
            F.array_join(F.transform(alts, lambda t: t["values"][0]), " "),
            F.coalesce(described(tags, 1, "description"), described(tags, 2, "og:description")),
        )

    def build(visible: Column) -> Column:
        tags = F.transform(start_tags(visible, "(?:img|meta)"), lambda tag: F.struct(
            F.lower(F.substring(tag, 2, 4)).eqNullSafe("meta").alias("is_meta"),
            F.transform(wanted, lambda name: attribute(tag, name)).alias("values"),
        ))
        return let(tags, lambda found: parts(visible, found))

    return F.regexp_replace(let(visible_html(html), build), r"[\r\n]", " ")


def hrefs(html: Column) -> Column:
    """Link values of a page in order, repeats kept.

    A tag with nothing but a quoted target of plain characters is read by one pattern, which is most of the work saved.
    """
    tags = let(visible_html(html), lambda visible: start_tags(visible, "a"))
    found = F.transform(tags, lambda tag: F.when(tag.rlike(PLAIN_LINK), F.regexp_extract(tag, PLAIN_LINK, 1)).otherwise(attribute(tag, "href")))
    return F.filter(found, lambda href: href.isNotNull())
