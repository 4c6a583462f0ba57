"""Elements, attributes and texts of HTML as column expressions.

A page is a run of tags, each with the text behind it. An element ends at its
own close tag whatever is nested in it: one possessive pattern over the tags
follows ``LEVELS`` elements of its name inside each other. Where every ``<`` opens
a tag and no quoted value holds one or a ``>``, that pattern starts at the elements
and reads from tag to tag; else it goes through all tags. Pages that go
deeper, or hold a tag that does not end, become a stream of tags that
``elements`` folds with the depth of the element it is in. Attributes are read
in any order and quoting; texts lose their tags, have their entities decoded
and their blanks squashed. All are built-in expressions: no Python runs per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Fixed values of HTML: elements without an end, and names of characters.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©",
         "reg": "®", "middot": "·", "times": "×", "laquo": "«", "raquo": "»",
         "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“",
         "rdquo": "”", "hellip": "…", "bull": "•", "euro": "€", "trade": "™"}

_BLANK = r" \t\n\x0B\f\r"  # \s spelled out: in a class with other characters that is several times faster
_REST = r"""[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*+>"""  # of a tag; a quoted value may hold >
TAG = rf"<[a-zA-Z/]{_REST}"
TOKEN = rf"{TAG}[^<]*(?:<(?![a-zA-Z/])[^<]*)*+"
ENDLESS = rf"(?i)^<(?:(?:{'|'.join(VOID)})[\s/>]|[^>]*/>)"
HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
VALUE = rf"""(?:"[^"]*"|'[^']*'|[^{_BLANK}"'>]+)"""
ATTRIBUTE = rf"""[^{_BLANK}"'<>/=]+\s*=\s*{VALUE}"""
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"
SPACE = r"[\s ]+"
LEAD = r"[^<]*(?:<(?![a-zA-Z/])[^<]*)*+"  # a page's text before its first tag
FOREIGN = rf"</?[a-zA-Z][^{_BLANK}>/]*[^\x00-\x7F]"  # a name whose case the pattern of elements does not know
PLAIN = (rf"""\A[^<]*+(?:</?+[a-zA-Z][^<>"']*+(?:"[^<>"]*+"[^<>"']*+|'[^<>']*+'[^<>"']*+)*+>[^<]*+)*+\z""")
START, END = "\x01", "\x02"  # around elements
LEVELS = 8  # elements of one name inside each other that this pattern follows


def with_class(name: str) -> str:
    """The open tags of elements of class ``name``, as a pattern."""
    return _with("class", rf'"(?:[^"]*\s)?{name}(?:\s[^"]*)?"', rf"'(?:[^']*\s)?{name}(?:\s[^']*)?'", name)


def with_id(name: str) -> str:
    """The open tags of elements of id ``name``, as a pattern."""
    return _with("id", f'"{name}"', f"'{name}'", name)


def _with(attr: str, double: str, single: str, bare: str) -> str:
    here = rf"{attr}\s*=\s*(?:{double}|{single}|{bare}(?=[\s>/]))"
    others = rf"""(?:[^>"'{_BLANK}]+|"[^"]*"|'[^']*'|[{_BLANK}](?!{here}))*+"""
    return rf"<[a-zA-Z][^{_BLANK}>/]*+(?=[{_BLANK}]){others}[{_BLANK}]{here}{_REST}"


def _once(c: Column, use) -> Column:
    """``use(c)``, with ``c`` computed once however often it is used."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def shown(html: Column) -> Column:
    """A page without its comments, scripts and styles."""
    hides = html.contains("<!--") | F.lower(html).contains("<script") | F.lower(html).contains("<style")
    return F.when(hides, F.regexp_replace(html, HIDDEN, "")).otherwise(html)


def stream(html: Column) -> Column:
    """The tags of a page as array<struct<tok, name, kind>>; kind is 1 for an open tag, -1 for a close tag, 0 for an
    element without an end."""

    def mark(tok: Column) -> Column:
        name = F.lower(F.regexp_extract(tok, rf"^</?([a-zA-Z][^{_BLANK}>/]*)", 1))
        kind = F.when(tok.startswith("</"), F.lit(-1)).when(tok.rlike(ENDLESS), F.lit(0)).otherwise(F.lit(1))
        return F.struct(tok.alias("tok"), name.alias("name"), kind.alias("kind"))

    return F.transform(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0)), mark)


def elements(tags: Column, opening: str, word: str) -> Column:
    """The elements of ``tags`` whose open tag matches ``opening`` and holds ``word``, each with its open tag and all
    up to its close tag or the end; one inside another is part of that."""
    none = F.array().cast("array<struct<s:int,n:int>>")
    start = F.struct(F.lit(0).alias("i"), F.lit("").alias("name"), F.lit(0).alias("depth"), F.lit(0).alias("start"),
                     none.alias("spans"))

    def step(st: Column, x: Column) -> Column:
        inside = st["depth"] > 0
        hit = ~inside & (x["kind"] >= 0) & x["tok"].contains(word) & x["tok"].rlike(f"^(?:{opening})")
        depth = F.when(inside, st["depth"] + F.when(x["name"] == st["name"], x["kind"]).otherwise(F.lit(0))).when(
            hit, x["kind"]).otherwise(F.lit(0))
        spans = F.when(inside & (depth == 0), _span(st["spans"], st["start"], st["i"] - st["start"])).when(
            hit & (x["kind"] == 0), _span(st["spans"], st["i"], F.lit(1))).otherwise(st["spans"])
        return F.struct((st["i"] + 1).alias("i"), F.when(hit, x["name"]).otherwise(st["name"]).alias("name"),
                        depth.alias("depth"), F.when(hit, st["i"]).otherwise(st["start"]).alias("start"),
                        spans.alias("spans"))

    def spans(st: Column) -> Column:
        return F.when(st["depth"] > 0, _span(st["spans"], st["start"], st["i"] - st["start"])).otherwise(st["spans"])

    found = F.aggregate(tags, start, step, spans)
    return F.transform(found, lambda x: F.slice(tags, x["s"] + 1, x["n"]))


def _span(spans: Column, start: Column, n: Column) -> Column:
    return F.array_append(spans, F.struct(start.alias("s"), n.alias("n")))


def _element(opening: str) -> str:
    """An element as a pattern: group 1 is its markup up to its close tag or the end, group 2 its name."""
    own = rf"(?=</?+(?i:\2)[{_BLANK}>/])(?:</|<(?![^>]*+(?<=/)>))"  # opens or closes an element of that name
    body = f"(?:(?!{own}){TOKEN})*+"
    for _ in range(LEVELS):
        body = rf"(?:(?!{own}){TOKEN}|(?!</){TOKEN}{body}(?:(?=</){TOKEN}|\z))*+"
    endless = ENDLESS.replace("(?i)^", "(?i:", 1) + ")"
    return rf"((?={opening})(?:(?={endless}){TOKEN}|(?=<([a-zA-Z][^{_BLANK}>/]*+)){TOKEN}{body}(?=</|\z)))"


def is_plain(html: Column) -> Column:
    """Whether a page without comments, scripts and styles, and so any run of its tags, can be read from ``<`` to ``<``."""
    return html.rlike(PLAIN) & ((F.octet_length(html) == F.length(html)) | ~html.rlike(FOREIGN))


def _plain_element(opening: str) -> str:
    """``_element`` on a plain page: group 1 is its markup, or ``<`` alone if it goes deeper than the pattern follows."""
    own = rf"(?=</?+(?i:\2)[{_BLANK}>/])(?:</|<(?![^>]*+(?<=/)>))"
    body = f"(?:[^<]++|(?!{own})<)*+"
    for _ in range(LEVELS):
        body = rf"(?:[^<]++|(?!{own})<|(?!</)<[^>]*+>{body}(?:(?=</)<[^>]*+>|\z))*+"
    endless = ENDLESS.replace("(?i)^<", "(?i:", 1) + ")"
    return rf"(<(?={opening[1:]})(?:(?={endless})[^>]*+>[^<]*+|([a-zA-Z][^{_BLANK}>/]*+)[^>]*+>{body}(?=</|\z))?+)"


def _elements(html: Column, opening: str, word: str, plain: Column | None = None) -> Column:
    """The markup of the elements whose open tag matches ``opening``, which holds ``word``: what ``elements`` finds in
    the stream of ``html``, a column without comments, scripts and styles, of which ``plain`` tells ``is_plain``."""
    folded = _once(stream(html), lambda tags: F.transform(elements(tags, opening, word), html_of))
    quick = _once(F.regexp_extract_all(html, F.lit(_plain_element(opening)), F.lit(1)),
                  lambda x: F.when(F.array_contains(x, "<"), folded).otherwise(x))
    read = F.when(is_plain(html) if plain is None else plain, quick).otherwise(_elements_of_any(html, opening, folded))
    return F.when(html.contains(word), read).when(html.isNotNull(), F.array().cast("array<string>"))


def _elements_of_any(html: Column, opening: str, folded: Column) -> Column:
    """``_elements`` of a page that need not be plain, ``folded`` being what the fold finds."""
    others = rf"{LEAD}(?:(?!{opening}){TOKEN})*+"
    cut = F.split(F.regexp_replace(html, rf"\G{others}{_element(opening)}", f"{START}$1{END}"), END, -1)

    def found(cut: Column) -> Column:
        plain = F.element_at(cut, -1).rlike(rf"\A{others}\z") & ~html.contains(START) & ~html.contains(END) & (
            (F.octet_length(html) == F.length(html)) | ~html.rlike(FOREIGN))
        return F.when(plain, F.transform(F.slice(cut, F.lit(1), F.size(cut) - 1), lambda x: F.substr(x, F.lit(2)))).otherwise(folded)

    return _once(cut, found)


def of_class(html: Column, name: str, plain: Column | None = None) -> Column:
    return _elements(html, with_class(name), name, plain)


def of_id(html: Column, name: str, plain: Column | None = None) -> Column:
    return _elements(html, with_id(name), name, plain)


def html_of(tags: Column) -> Column:
    """The markup of a run of tags."""
    return F.array_join(F.transform(tags, lambda x: x["tok"]), "")


def inner(html: Column) -> Column:
    """An element's markup without its open tag and the text behind that."""
    return F.substr(html, F.length(F.regexp_extract(html, rf"\A{TOKEN}", 0)) + 1)


def decoded(s: Column) -> Column:
    """``s`` with its character references replaced, once; unknown names stay."""

    def char(e: Column) -> Column:
        body = F.substring_index(F.substr(e, F.lit(2)), ";", 1)
        code = F.when(e.rlike("^&#[xX]"), F.conv(F.substr(body, F.lit(3)), 16, 10)).when(
            e.startswith("&#"), F.substr(body, F.lit(2))).cast("long")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        known = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])
        return (F.when(code.isNull(), F.coalesce(F.try_element_at(known, body), e))
                .when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
                .otherwise(F.lit("�")))

    def whole(s: Column) -> Column:
        chars = F.transform(F.regexp_extract_all(s, F.lit(ENTITY), F.lit(0)), char)
        plain = F.split(s, ENTITY, -1)
        return F.when(s.contains("&"), F.array_join(F.zip_with(
            plain, chars, lambda p, c: F.concat(p, F.coalesce(c, F.lit("")))), "")).otherwise(s)

    return _once(s, whole)


def text_of(html: Column) -> Column:
    """The text of a piece of markup, its blanks squashed."""
    return F.trim(F.regexp_replace(decoded(F.regexp_replace(html, TAG, "")), SPACE, " "))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of an open tag, null if it has none."""
    # Past all before it, attributes or not, in one pass; the name as F.lower would make it.
    own = "".join("[kK\u212a]" if c == "k" else f"(?i:{re.escape(c)})" for c in name) + r"\s*=\s*"
    before = f"(?:(?!{own}{VALUE})(?:{ATTRIBUTE}|.))*+"
    bare = lambda v: F.when(v.startswith('"') | v.startswith("'"), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v)
    return decoded(_once(F.nullif(F.regexp_extract(tag, rf"(?s)\A{before}{own}({VALUE})", 1), F.lit("")), bare))


def _pair(name: str) -> str:
    return rf"(?is)<{name}(?=[\s>]){_REST}(.*?)</{name}\s*>"


def texts(html: Column, name: str) -> Column:
    """The texts of all ``name`` elements."""
    return F.transform(F.regexp_extract_all(html, F.lit(_pair(name)), F.lit(1)), text_of)


def first_tag(html: Column, name: str) -> Column:
    """The first open tag of a ``name`` element, empty if there is none."""
    return F.regexp_extract(html, rf"(?is)<{name}(?=[\s>]){_REST}", 0)


def links(html: Column) -> Column:
    """(href, text) of all links, in page order."""
    whole = F.regexp_extract_all(html, F.lit(_pair("a")), F.lit(0))
    return F.transform(whole, lambda a: F.struct(
        F.coalesce(attribute(first_tag(a, "a"), "href"), F.lit("")).alias("href"), text_of(a).alias("text")))
