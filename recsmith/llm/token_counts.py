"""Token counts by a map-side two-tier lookup.

Tier one is a broadcast table of the lengths of frequent pre-tokens. It is
counted over all documents: each task keeps a bounded counter and hands on
its most frequent pre-tokens only, and the table holds at most ``TABLE``
of them. Tier two is each worker's bounded cache, which encodes what the
table lacks. No pre-token of a text is ever shuffled, and the table decides
only which lookups are fast, never a count.

Null text: empty, 0 bytes and 0 tokens. Repeated rows are counted once each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import query, table
from .pretokens import WORD_BPE, Cutter, LengthCache, default_path, library, runs

TABLE = 1 << 16  # entries of the broadcast table
PER_TASK = 1 << 12  # entries each task hands on
COUNTER = 1 << 18  # entries a task's counter may reach before the rare ones go
LIMIT = 2048


def frequent_pretokens(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(pretoken, n): the most frequent pre-tokens by the tasks' summaries, ``TABLE`` rows at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut, seen = Cutter(tokenizer_path), Counter()
        for pdf in batches:
            for text in pdf["text"]:
                seen.update(cut.parts(text or "") or ())
                floor = 2
                while len(seen) > COUNTER:
                    seen = Counter({p: n for p, n in seen.items() if n >= floor})
                    floor *= 2
        yield pd.DataFrame(seen.most_common(PER_TASK), columns=["pretoken", "n"])

    return (docs.select("text").mapInPandas(run, "pretoken string, n long")
            .groupBy("pretoken").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "pretoken").limit(TABLE))


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``."""
    spark = docs.sparkSession
    frequent = [r.pretoken for r in frequent_pretokens(docs, tokenizer_path).collect()]  # TABLE rows at most
    codes = library(tokenizer_path).encode_batch_fast(frequent, add_special_tokens=False)
    sent = spark.sparkContext.broadcast({p: len(e.ids) for p, e in zip(frequent, codes)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = LengthCache(tokenizer_path, sent.value)
        for pdf in batches:
            counts = [n for texts in runs(pdf["text"]) for n in cache.count(texts)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": pdf["n_bytes"], "n_tokens": counts})

    # The id goes through pandas as text: a column with nulls would become floating point.
    return (docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
            .mapInPandas(run, "doc_id string, n_bytes long, n_tokens long")
            .withColumn("doc_id", F.col("doc_id").cast("long"))
            .withColumn("over_limit", F.col("n_tokens") > limit))


@query("op8_token_counts")
def op8(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), default_path(WORD_BPE))
