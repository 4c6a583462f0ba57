"""Text codec for stored id lists.

The stored form is Python's ``str(list)``: ``[1, 2, 3]``, ``[]`` when
empty. Both directions are built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_id_list(arr) -> Column:
    """``array<int>`` -> ``'[1, 2, 3]'``."""
    body = F.array_join(F.transform(_c(arr), lambda x: x.cast("string")), ", ")
    return F.concat(F.lit("["), body, F.lit("]"))


def decode_id_list(text) -> Column:
    """``'[1, 2, 3]'`` / ``'[1,2,3]'`` / ``'[]'`` -> ``array<int>``.

    Malformed text gives null rather than failing the job.
    """
    return F.from_json(F.trim(_c(text)), "array<int>")
