"""Exact line dedup: each line counts where it occurs first, and paragraphs with too little that is new go.

The order is (document order, paragraph, line) within a scope, so the outcome does not depend on partitioning. First
occurrences come from ``min(struct)`` over lines, which combines in the map tasks, so a line that a million
documents share weighs no more there than any other; lines travel as 128-bit hashes, and texts only once, to be joined
with their verdicts. Two 64-bit hashes of different seeds tell lines apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bloom import known_lines


def _hash(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("x"), F.xxhash64(F.lit("lexmill"), line).alias("y"), F.octet_length(line).alias("n"))


def _lines(docs: DataFrame, scope: str, order: str) -> DataFrame:
    paragraphs = docs.select(F.col(scope).alias("scope"), F.col(order).alias("ord"), F.posexplode(F.split("text", "\n\n+", -1)).alias("p", "paragraph"))
    return paragraphs.select("scope", "ord", "p", F.octet_length("paragraph").alias("bytes"), F.posexplode(F.transform(F.split("paragraph", "\n", -1), _hash)).alias("l", "h"))


def first_lines(docs: DataFrame, scope: str = "group_idx", order: str = "record_idx", seen: DataFrame | None = None) -> DataFrame:
    """(scope, ord, p, l, n): where each line occurs first; n its bytes. Lines in ``seen`` have no first: it has a column
    ``line``, for every scope, or the columns of ``line_keys``, each line for its scope."""
    first = _lines(docs, scope, order).groupBy("scope", "h").agg(F.min(F.struct("ord", "p", "l")).alias("at"))
    if seen is not None and "line" in seen.columns:
        first = first.join(seen.select(_hash(F.col("line")).alias("h")), "h", "left_anti")
    elif seen is not None:
        known = seen.select(F.col("scope").alias("s"), F.struct("x", "y", "n").alias("k"))
        first = first.join(known, F.col("scope").eqNullSafe(F.col("s")) & (F.col("h") == F.col("k")), "left_anti")
    return first.select("scope", "at.ord", "at.p", "at.l", F.col("h.n").alias("n"))


def line_keys(docs: DataFrame, scope: str = "group_idx", order: str = "record_idx") -> DataFrame:
    """(scope, x, y, n): the distinct lines of each scope as two hashes and their bytes."""
    return _lines(docs, scope, order).select("scope", "h.*").distinct()


def filtered_lines(docs: DataFrame, bloom: str) -> DataFrame:
    """(line) distinct lines of the documents that a prebuilt filter has, for ``seen``: its false positives included. Only the
    distinct lines are looked up."""
    spark = docs.sparkSession
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("line")).distinct()
    return lines.where(known_lines(spark, bloom, "line"))


def dedup_lines(docs: DataFrame, threshold: float = 0.2, scope: str = "group_idx", order: str = "record_idx", seen: DataFrame | None = None) -> DataFrame:
    """The documents with only the paragraphs of which new lines make up more than ``threshold`` of the bytes, each
    followed by an empty line. An empty paragraph has nothing new. No document goes, some become empty.

    (scope, order) must identify a document; rows that repeat one lose nothing to each other, as they are in one place. A null
    text stays null, an empty one empty; a null scope is a scope of its own; a null order is never joined, and such a document becomes
    empty. Columns other than text pass through. ``seen`` as in ``first_lines``. Comparison is in single precision.
    """
    new = first_lines(docs, scope, order, seen).groupBy("scope", "ord", "p").agg(F.sum("n").alias("new"))
    per_doc = new.groupBy("scope", "ord").agg(F.map_from_entries(F.collect_list(F.struct("p", "new"))).alias("__new"))
    per_doc = per_doc.withColumnsRenamed({"scope": "__scope", "ord": "__ord"})
    out = docs.join(per_doc, F.col(scope).eqNullSafe(F.col("__scope")) & (F.col(order) == F.col("__ord")), "left")

    def kept(paragraph: Column, p: Column) -> Column:
        n = F.octet_length(paragraph)
        share = F.try_divide(F.try_element_at("__new", p).cast("double"), n.cast("double")).cast("float")
        return F.when((n > 0) & (F.coalesce(share, F.lit(0.0)) > F.lit(threshold).cast("float")), F.concat(paragraph, F.lit("\n\n"))).otherwise("")

    text = F.concat_ws("", F.transform(F.split("text", "\n\n+", -1), kept))
    return out.withColumn("text", F.when(F.col("text").isNotNull(), text)).select(docs.columns)


def repeated_lines(docs: DataFrame, scope: str = "group_idx", order: str = "record_idx") -> DataFrame:
    """(scope, ord, l, line): every line that occurred before, in place; paragraphs play no part.

    Lines travel as hashes, to find where each occurs first; every document gets the places of its first lines, at most one for each
    of its own, and all its other lines are repeated. A line that a million documents share is one row of the join. A null text
    has no lines; (scope, order) must identify a document."""
    hashed = docs.select(F.col(scope).alias("scope"), F.col(order).alias("ord"), F.posexplode(F.transform(F.split("text", "\n", -1), _hash)).alias("l", "h"))
    first = hashed.groupBy("scope", "h").agg(F.min(F.struct("ord", "l")).alias("at"))
    own = first.groupBy("scope", "at.ord").agg(F.collect_list("at.l").alias("own")).withColumnsRenamed({"scope": "s", "ord": "o"})
    texts = docs.select(F.col(scope).alias("scope"), F.col(order).alias("ord"), "text").join(own, F.col("scope").eqNullSafe(F.col("s")) & (F.col("ord") == F.col("o")), "left")
    lines = texts.select("scope", "ord", "own", F.posexplode(F.split("text", "\n", -1)).alias("l", "line"))
    return lines.where(~F.coalesce(F.array_contains("own", F.col("l")), F.lit(False))).select("scope", "ord", "l", "line")
