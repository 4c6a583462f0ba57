"""Registered query: streaming page ingest (L1) over the files of the pages table."""

from __future__ import annotations

from ..sources import tables as T
from ..streaming import ingest as L
from .registry import query


@query("stream_ingest_pages", r"""
WITH p AS (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url),
pg AS (SELECT pages.page_id, pages.html FROM pages JOIN p ON pages.url = p.url AND pages.page_id = p.page_id),
blk AS (SELECT unnest(parts[2:]) AS block FROM (SELECT string_split(html, '<li>') AS parts FROM pg)),
it AS (SELECT trim(regexp_extract(block, 'href="([^"]*)"', 1)) AS item_url,
              trim(regexp_extract(block, '<a href="[^"]*">([^<]*)</a>', 1)) AS title FROM blk)
SELECT item_url, min(title) AS title FROM it WHERE item_url <> '' GROUP BY item_url""")
def q_stream_ingest_pages(spark, d):
    folder, names = L.table_files(spark, T.table_path(d, "pages"))
    target = L.stream_ingest_pages(spark, folder, extract=L.nav_items, key_cols=("item_url",), glob=names)
    return L.stored_rows(spark, target, "item_url string, title string").select("item_url", "title")
