"""Scalar column functions over text.

All are built-in Spark expressions (JVM side, whole-stage codegen); no
Python runs per row. Regular expressions are kept to the subset that
Java and RE2 read the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the reference's page markup and page addressing.
RATING_PATTERN = r"rating(\d+)-t"
TOTAL_PATTERN = r"\((\d+)\)"
FIRST_NUMBER_PATTERN = r"(\d+)"
PAGE_STEP = 15          # items per collection page
SEED_PAGE_STEP = 20     # comments per comment page
SEED_PAGES = 10         # comment pages read per seed item
PAGE_QUERY = (("sort", "time"), ("ratind", "all"), ("filter", "all"), ("mode", "gird"))
COMMENT_QUERY = (("limit", "20"), ("sort", "new_score"), ("status", "P"))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote_regex(s: str) -> str:
    """Literal text as a Java regex (for ``split``)."""
    return r"\Q" + s + r"\E"


def split_fields(c, sep: str = "::") -> Column:
    """G1: split a line on a literal separator."""
    return F.split(_c(c), quote_regex(sep))


def split_whitespace(c) -> Column:
    """Split on runs of blanks after trimming (Python's ``str.split()``)."""
    return F.split(F.trim(_c(c)), r"\s+")


def to_int(c) -> Column:
    """``int(str)`` that yields null instead of failing on bad text."""
    return F.trim(_c(c)).try_cast("int")


def first_group_int(c, pattern: str) -> Column:
    """First match of ``pattern`` group 1 as int, null when absent."""
    return F.nullif(F.regexp_extract(_c(c), pattern, 1), F.lit("")).try_cast("int")


def extract_score(c) -> Column:
    """Score from the first ``rating<d>-t`` class, 0 when absent."""
    return F.coalesce(first_group_int(c, RATING_PATTERN), F.lit(0))


def extract_total(c) -> Column:
    """First parenthesised number."""
    return first_group_int(c, TOTAL_PATTERN)


def extract_first_number(c) -> Column:
    """First run of digits."""
    return first_group_int(c, FIRST_NUMBER_PATTERN)


def paginator_texts(html, block: str = r'(?s)<div class="paginator">(.*?)</div>') -> Column:
    """Texts of the links inside the paginator block."""
    inner = F.regexp_extract(_c(html), block, 1)
    return F.regexp_extract_all(inner, F.lit(r"<a[^>]*>([^<]*)</a>"), F.lit(1))


def extract_page_count(html) -> Column:
    """Page count = second-to-last paginator text; 1 without a paginator."""
    texts = paginator_texts(html)
    second_last = F.when(F.size(texts) >= 2, F.element_at(texts, -2))
    return F.coalesce(F.trim(second_last).try_cast("int"), F.lit(1))


def page_url(base, start) -> Column:
    """Collection page address ``base + urlencode(start=…, sort=…, …)``."""
    tail = "".join(f"&{k}={v}" for k, v in PAGE_QUERY)
    return F.concat(_c(base), F.lit("start="), _c(start).cast("string"), F.lit(tail))


def page_offsets(n_pages, step: int = PAGE_STEP, inclusive: bool = False, first=0) -> Column:
    """Offsets ``step * i`` for i in first..n-1 (..n with ``inclusive``)."""
    first = F.lit(first) if isinstance(first, int) else _c(first)
    last = _c(n_pages) if inclusive else _c(n_pages) - 1
    return F.transform(F.sequence(first, F.greatest(last, first)), lambda i: i * step)


def comment_page_url(subject_url, start) -> Column:
    """Comment page address of an item: ``<item url>comments?start=…&limit=20…``."""
    tail = "".join(f"&{k}={v}" for k, v in COMMENT_QUERY)
    return F.concat(_c(subject_url), F.lit("comments?start="), _c(start).cast("string"), F.lit(tail))


def normalise_name(c) -> Column:
    """Blanks in a display name become '-'."""
    return F.translate(_c(c), " ", "-")


def seed_url(href) -> Column:
    """The seed form of a collection link."""
    return F.concat(_c(href), F.lit("?"))


def strip_label(c, label: str) -> Column:
    """Remove a fixed label text from a heading and trim."""
    return F.trim(F.replace(_c(c), F.lit(label), F.lit("")))


def serve_message(template: str, *cols) -> Column:
    """Serving text around titles (``%s`` placeholders); null when a
    title is unknown (no message is served for a missing item)."""
    args = [_c(c) for c in cols]
    known = args[0].isNotNull()
    for a in args[1:]:
        known = known & a.isNotNull()
    return F.when(known, F.format_string(template, *args))
