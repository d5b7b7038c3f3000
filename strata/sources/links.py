"""Link listing of HTML directory pages, distributed over a table of pages.

Every anchor's href as an HTML parser sees it.  A page is scanned once for
comments, elements whose content is raw text (scripts, styles, ...) and tags,
whichever comes first, so that what looks like an anchor inside one of the
former, or a comment inside an attribute, is part of what holds it.  Tag and
attribute names in any case, values in double, single or no quotes, quoted
values of other attributes skipped whole, character references decoded.  Hrefs
that are empty, the parent link ``../`` or end in ``/`` (sub-directories) are
skipped; the file name is the last path component of the href.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s>"']+)"""
_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
# Elements whose content is text, whatever it looks like.
RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes"
# A comment or a raw element, to its end or the page's, or else a tag.
TOKEN = (r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))|<(" + RAW + r")(?=[\s/>])" + _ATTRIBUTES + r".*?(?:</\1(?=[\s/>])|\z)|</?[a-z]"
         + _ATTRIBUTES)
ANCHOR = r"(?is)^<a(?=[\s/]).*"
# Its first href: attributes of other names, with or without values, come before it.
HREF = (r"(?is)^<a(?:[\s/]++(?!href\s*=)[^\s=>/\"']++(?:\s*+=\s*+" + _VALUE + r")?+)*+[\s/]++href\s*+=\s*+(" + _VALUE + ")")
PARENT_HREF = "../"
_REFERENCE = r"(?s)^&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)(;?)(.*)$"
# Named references by name (with or without a semicolon), as the standard library has them.
_NAMES = json.dumps(html5)
# What numeric references to the C1 range mean (the standard's rule: bytes of windows-1252).
_C1 = {n: bytes([n]).decode("cp1252", "replace") for n in range(0x80, 0xA0) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def _numeric(body: Column) -> Column:
    digits = F.regexp_extract(body, r"^#[xX]?0*([0-9a-fA-F]*)$", 1)
    is_hex = F.substring(body, 2, 1).isin("x", "X")
    # Longer numbers are beyond all characters anyway.
    short = F.length(digits) <= 7
    code = F.when(short, F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")).otherwise(F.lit(1 << 40))
    good = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    c1 = F.create_map(*[x for n, c in _C1.items() for x in (F.lit(n).cast("bigint"), F.lit(c))])
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(digits == "", "\ufffd").when(~good, "\ufffd").otherwise(F.coalesce(F.element_at(c1, code), char))


def decoded(value: Column) -> Column:
    """An attribute's value with its character references decoded: numeric ones
    with or without a semicolon, named ones with one, or without if the name is
    one of the old ones and no ``=`` follows it."""
    names = F.from_json(F.lit(_NAMES), "map<string,string>")

    def piece(p: Column) -> Column:
        body, end, rest = (F.regexp_extract(p, _REFERENCE, i) for i in (1, 2, 3))
        named = F.when((end == ";") | ~F.startswith(rest, F.lit("=")), F.element_at(names, F.concat(body, end)))
        char = F.when(F.startswith(body, F.lit("#")), _numeric(body)).otherwise(named)
        return F.when(F.startswith(p, F.lit("&")) & (body != ""), F.concat(F.coalesce(char, F.concat(F.lit("&"), body, end)), rest)) \
            .otherwise(p)
    pieces = F.transform(F.split(value, "(?=&)"), piece)
    return F.when(F.contains(value, F.lit("&")), F.array_join(pieces, "")).otherwise(value)


def page_links(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    keep = keep if keep is not None else [c for c in pages.columns if c != html]
    tokens = F.regexp_extract_all(F.col(html), F.lit(TOKEN), F.lit(0))
    tags = pages.select(*keep, F.explode(F.filter(tokens, lambda t: t.rlike(ANCHOR))).alias("_tag"))
    hrefs = tags.withColumn("_href", F.regexp_extract("_tag", HREF, 1))
    bare = F.when(F.substring("_href", 1, 1).isin('"', "'"), F.expr("substring(_href, 2, length(_href) - 2)")) \
            .otherwise(F.col("_href"))
    hrefs = hrefs.select(*keep, decoded(F.trim(bare)).alias("href"))
    wanted = (F.col("href") != "") & (F.col("href") != PARENT_HREF) & ~F.col("href").endswith("/")
    return hrefs.filter(wanted).withColumn("file_name", F.substring_index("href", "/", -1))
