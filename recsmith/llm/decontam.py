"""Benchmark decontamination by a positional inverted index, in DataFrame functions only.

The index holds the postings (term, document row, position) of every corpus
word that the benchmark uses, written once to the shared scratch folder. The
lists' lengths are counted from it. Each test window starts from the list of
its rarest term; the lists of its other terms are intersected with what is
left, next rarest first, each shifted by the difference of the two offsets.
A start at which every list has its posting is an exact phrase. A proximity
match is a posting of the rarest term with a posting of every other term of
the window less than ``width`` positions away, in any order; its lists are
intersected block of positions by block of positions. A window with a term
without postings is dropped before any list is read.

Join keys hold the document and the position, so the list of a very frequent
term is spread over all tasks.

Words: A-Z lower-cased, digits, letters and all non-ASCII characters.
Null or empty text has no words, no hits and no items. Rows that repeat a
``doc_id`` are searched each by itself. Benchmark rows without words match
nothing; items with equal windows are all reported. Empty tables give no
rows, or rows without hits. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ascii_lower, query, stored, table

WINDOW = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 1_000_000  # rows of a broadcast side; beyond it the joins shuffle
ROW_BITS = 1 << 25  # bits of the broadcast bitmap of candidate documents: 524,288 rows of 64
SALTS = 64  # tasks a hot term's words are dealt to where the benchmark's side is not broadcast


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def small(df: DataFrame) -> DataFrame:
    """Mark a table for broadcast if it is counted as small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def test_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, terms): each run of ``width`` consecutive words; a shorter item is one window."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    at = items.select("item_id", "w", F.explode(
        F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))).alias("i"))
    return at.select("item_id", F.slice("w", F.col("i"), width).alias("terms")).distinct()


def tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, row_hash, words): ``row_hash`` tells rows of one doc_id apart."""
    return docs.select("doc_id", F.xxhash64("text").alias("row_hash"), words(F.col("text")).alias("words"))


def by_key(large: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Inner join of postings or words with a benchmark-side table; beyond the broadcast a hot key is salted."""
    if side.count() <= BROADCAST_ROWS:
        return large.join(F.broadcast(side), key)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return large.withColumn("salt", F.pmod(F.hash("row_hash", "pos"), F.lit(SALTS))).join(
        side.withColumn("salt", salts), [key, "salt"]).drop("salt")


def posting_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term_id, doc_id, row_hash, pos), written: every occurrence in ``docs`` of the terms of ``vocabulary``."""
    at = tokens(docs).select("doc_id", "row_hash", F.posexplode("words").alias("pos", "term"))
    return stored(by_key(at, vocabulary, "term").select("term_id", "doc_id", "row_hash", "pos"), "postings")


def term_lists(at: DataFrame, index: DataFrame) -> DataFrame:
    """(window_id, lists), written: a window's (n, off, term_id), rarest first; ``n`` is the list's length.

    ``at`` is (window_id, off, term_id). Windows with an empty list are left out.
    """
    lengths = index.groupBy("term_id").agg(F.count(F.lit(1)).alias("n"))
    lists = at.join(lengths, "term_id", "left").groupBy("window_id").agg(F.array_sort(F.collect_list(
        F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term_id"))).alias("lists"))
    return stored(lists.where(F.col("lists")[0]["n"] > 0), "term-lists")


def of_rows(index: DataFrame, found: DataFrame) -> DataFrame:
    """The postings of documents that ``found`` names, and few others: a bitmap of row hashes is broadcast.

    It has at most ``ROW_BITS`` / 64 rows whatever the input; with very many
    documents it lets more postings through, which the joins then drop.
    """
    word = F.pmod(F.shiftright("row_hash", 6), F.lit(ROW_BITS // 64))
    bit = F.expr("shiftleft(1L, cast(row_hash & 63 AS int))")
    marks = found.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return index.withColumn("word", word).join(F.broadcast(marks), "word").where(
        F.col("bits").bitwiseAND(bit) != 0).drop("word", "bits")


CANDIDATE = ["window_id", "doc_id", "row_hash", "pos", "off"]  # a posting of the window's rarest term


def anchors(index: DataFrame, lists: DataFrame) -> DataFrame:
    """Every posting of each window's rarest term, once, as ``CANDIDATE`` columns."""
    rarest = lists.select("window_id", F.col("lists")[0]["term_id"].alias("term_id"),
                          F.col("lists")[0]["off"].alias("off"))
    return by_key(index, rarest, "term_id").select(*CANDIDATE).distinct()


def intersected(found: DataFrame, index: DataFrame, lists: DataFrame, reach: int | None = None) -> DataFrame:
    """The rows of ``found`` for which every list of their window has a posting in place.

    In place is the term's own offset from the rarest term, or with ``reach``
    at most that many positions from it. The second and the third rarest lists
    are taken alone, the others together: few candidates are left by then.
    """
    if reach is None:
        others, block = F.slice("lists", 2, F.size("lists")), 1
    else:
        first = F.col("lists")[0]["term_id"]
        others = F.array_distinct(F.transform(
            F.filter("lists", lambda x: x["term_id"] != first),
            lambda x: F.struct(x["n"].alias("n"), F.lit(0).alias("off"), x["term_id"].alias("term_id"))))
        block = 2 * reach + 1
    lists = lists.select("window_id", others.alias("others"))
    blocks = index.withColumn("block", F.floor(F.col("pos") / block).cast("int"))
    for step, (start, length) in enumerate([(1, 1), (2, 1), (3, None)]):
        part = F.slice("others", start, F.size("others") if length is None else length)
        step_lists = small(lists.select("window_id", part.alias("part")))
        due = found.join(step_lists, "window_id")
        need = due.select(*CANDIDATE, F.size("part").alias("due"), F.explode("part").alias("t"))
        if reach is None:
            at = F.array((F.col("pos") - F.col("off") + F.col("t.off")).cast("int"))
        else:
            at = F.sequence(F.floor(F.greatest(F.col("pos") - reach, F.lit(0)) / block).cast("int"),
                            F.floor((F.col("pos") + reach) / block).cast("int"))
        need = need.select(*CANDIDATE, "due", F.col("t.off").alias("t_off"), F.col("t.term_id").alias("term_id"),
                           F.explode(at).alias("block"))
        terms = lists.select(F.explode(part).alias("t")).select("t.term_id").distinct()
        read = of_rows(blocks.join(small(terms), "term_id", "left_semi"), found)
        n, i = need.alias("n"), read.alias("i")
        on = ((F.col("n.term_id") == F.col("i.term_id")) & (F.col("n.block") == F.col("i.block"))
              & (F.col("n.row_hash") == F.col("i.row_hash")) & F.col("n.doc_id").eqNullSafe(F.col("i.doc_id")))
        if reach is not None:
            on &= F.abs(F.col("n.pos") - F.col("i.pos")) <= reach
        hit = i.join(n, on).groupBy(*(F.col(f"n.{c}") for c in CANDIDATE), F.col("n.due")).agg(
            F.size(F.collect_set(F.struct("n.t_off", "n.term_id"))).alias("got"))
        found = stored(hit.where("got = due").select(*CANDIDATE).unionByName(
            due.where(F.size("part") == 0).select(*CANDIDATE)), f"intersected-{step}")
    return found


def matches(docs: DataFrame, windows: DataFrame, width: int = WINDOW, proximity: bool = False) -> DataFrame:
    """(doc_id, row_hash, terms, start, kind): exact phrases, with ``proximity`` also the proximity matches.

    ``start`` is the window's first word in the document; for a proximity
    match the first word of the neighbourhood that holds all terms.
    """
    distinct = stored(windows.select("terms").distinct().withColumn(
        "window_id", F.monotonically_increasing_id()), "distinct-windows")
    at = distinct.select("window_id", F.posexplode("terms").alias("off", "term"))
    vocabulary = stored(at.select("term").distinct().withColumn(
        "term_id", F.monotonically_increasing_id()), "vocabulary")
    index = posting_index(docs, vocabulary)
    lists = term_lists(at.join(vocabulary, "term").drop("term"), index)
    found = stored(anchors(index, lists), "anchors")
    first = (F.col("pos") - F.col("off")).cast("int")
    phrases = intersected(found.where(first >= 0), index, lists)
    got = phrases.select("window_id", "doc_id", "row_hash", first.alias("start"), F.lit("phrase").alias("kind"))
    if proximity:
        f, p = intersected(found, index, lists, width - 1).alias("f"), phrases.alias("p")
        loose = f.join(p, (F.col("f.window_id") == F.col("p.window_id")) & (F.col("f.row_hash") == F.col("p.row_hash"))
                       & (F.col("f.pos") == F.col("p.pos")) & F.col("f.doc_id").eqNullSafe(F.col("p.doc_id")),
                       "left_anti")
        got = got.unionByName(loose.select(
            "window_id", "doc_id", "row_hash", F.greatest(F.col("pos") - (width - 1), F.lit(0)).alias("start"),
            F.lit("proximity").alias("kind")))
    return got.join(small(distinct), "window_id").drop("window_id")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, proximity: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    These are of exact phrases. With ``proximity`` also n_near_windows and n_near_items: the windows, and the items
    they are of, that have a proximity match in the row but no exact phrase.
    """
    windows = stored(test_windows(benchmark, width), "test-windows")
    hits = stored(matches(docs, windows, width, proximity), "matches")
    near = hits.groupBy("doc_id", "row_hash", "terms").agg(F.max(F.col("kind") == "phrase").alias("exact")).where(
        ~F.col("exact")).join(small(windows), "terms").groupBy("doc_id", "row_hash").agg(
        F.countDistinct("terms").alias("n_near_windows"), F.countDistinct("item_id").alias("n_near_items"))
    hits = hits.where("kind = 'phrase'")
    spans = hits.select("doc_id", "row_hash", "start", (F.col("start") + F.size("terms")).alias("end")).distinct()
    before = Window.partitionBy("doc_id", "row_hash").orderBy("start", "end").rowsBetween(
        Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))), F.lit(0))
    covered = spans.select("doc_id", "row_hash", fresh.alias("fresh")).groupBy("doc_id", "row_hash").agg(
        F.sum("fresh").alias("n_hit"))
    items = hits.select("doc_id", "row_hash", "terms").join(small(windows), "terms").groupBy(
        "doc_id", "row_hash").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    key = ["doc_id", "row_hash"]
    left = tokens(docs).select(*key, F.size("words").cast("long").alias("n_words")).alias("l")
    for name, right in [("c", covered), ("i", items), ("n", near)][:3 if proximity else 2]:
        left = left.join(right.alias(name), F.col("l.doc_id").eqNullSafe(F.col(f"{name}.doc_id"))
                         & (F.col("l.row_hash") == F.col(f"{name}.row_hash")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    none = F.array().cast("array<string>")
    return left.select(
        "l.doc_id", "n_words", n_hit.alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", none)), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_near_windows", "n_near_items") if proximity))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no test window occurs, with all their columns."""
    hit = matches(docs, test_windows(benchmark, width), width).select(
        _row_key(F.col("doc_id"), F.col("row_hash")).alias("key")).distinct()
    rows = docs.select(_row_key(F.col("doc_id"), F.xxhash64("text")).alias("key"), F.struct("*").alias("row"))
    return rows.join(hit, "key", "left_anti").select("row.*")


def _row_key(doc_id: Column, row_hash: Column) -> Column:
    return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), row_hash.cast("string"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS gram, least(len(w), 10) AS k
            FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
          FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
                FROM docs CROSS JOIN (SELECT DISTINCT k FROM windows) AS ks)),
found AS (SELECT doc_id, item_id, i, grams.k FROM grams JOIN windows USING (gram)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM found) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS l FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(l), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query("op4_decontamination", SQL)
def op4(spark, sf_dir):
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_proximity")
def op4_proximity(spark, sf_dir):
    """``op4_decontamination`` with the proximity matches as further columns."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), proximity=True)
