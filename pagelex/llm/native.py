"""Words and shingle hashes as column expressions, for the operators without Python."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelex.llm.common import let

BLANK = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z; none for null or blank texts."""
    low = F.btrim(F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase), F.lit(BLANK))
    return let(low, lambda t: F.when(F.length(t) > 0, F.split(t, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>")))


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def windows(h: Column, k: int) -> Column:
    """Hashes of the k-word windows of an array of word hashes; none if it is shorter."""
    each = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(F.lit(k), *[F.get(h, i + j) for j in range(k)]))
    return F.when(F.size(h) >= k, each).otherwise(F.array().cast("array<bigint>"))
