"""Mixing sources to target weights by Pareto order sampling.

Each source s gets a target of T * share(s) bytes. A document of size z and weight w = 4000 + min(z, 4000) is
expected pi = T * share(s) * w / sum(w * z) times, so that the expected bytes of the source meet its target and
fuller documents are preferred up to twofold. floor(pi) whole copies are certain. The rest, lambda = pi - floor(pi),
is an inclusion probability: documents are ranked by (U / (1 - U)) / (lambda / (1 - lambda)), with U a fixed
function of the seed and doc_id, and the n(s) = round(sum of lambda) first of each source get one copy more. So
the sample has a fixed size with unequal probabilities (Rosen's Pareto sampling).

The n(s)-th rank is found without sorting a source: a histogram of the ranking variable over 65,536 cells
per source, then an exact ranking of the one cell that holds the cut. What comes back to the documents is one row
per source, which Spark joins as it sees fit; texts are never shuffled.

Defined results: a null text has size 0; a null source is a source of its own; a null doc_id is ranked like any
id; rows tied at the cut (repeated rows) are all taken, so that the result does not depend on their order; a
source named in the weights but not in the table gets nothing and its share is not handed on; a source left out
of explicit weights gets nothing; a source without bytes gets nothing; an empty table gives an empty table. Other
columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SEED = 17
CELLS = 1 << 16
FULL = 4000


def _u(doc_id: Column, seed: int) -> Column:
    """Uniform on (0, 1), 52 bits of the MD5 of the seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))


def _size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long")


def _weight(size: Column) -> Column:
    return F.lit(FULL) + F.least(size, F.lit(FULL))


def _rank(expected: Column, u: Column) -> Column:
    rest = expected - F.floor(expected)
    return F.try_divide(u / (1 - u), rest / (1 - rest))


def _cell(rank: Column) -> Column:
    return F.floor(rank / (1 + rank) * F.lit(float(CELLS))).cast("int")


def plan(docs: DataFrame, weights: dict[str, float] | None = None, total_bytes: int | None = None, seed: int = SEED) -> DataFrame:
    """(source, scale, cut, cut_id), one row per source: a document's expected copies are scale * w, and it gets one
    more than the whole ones where (rank, doc_id) is not beyond (cut, cut_id)."""
    slim = stored(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("source").cast("string").alias("source"), _size(F.col("text")).alias("z")), "mixing-sizes").withColumn("w", _weight(F.col("z")))
    sums = slim.groupBy("source").agg(F.sum("z").alias("z"), F.sum(F.col("w") * F.col("z")).alias("wz"))
    if weights is None:
        sums = sums.withColumn("share", F.sqrt("z") * F.sqrt(F.sqrt("z")))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "name string, share double")
        sums = sums.join(given, F.col("source").eqNullSafe(F.col("name")), "left").drop("name").withColumn("share", F.coalesce("share", F.lit(0.0)))
    whole = sums.agg(F.sum("z").alias("t"), F.sum("share").alias("all"))
    if weights is not None:
        whole = whole.withColumn("all", F.lit(float(sum(weights.values()))))
    if total_bytes is not None:
        whole = whole.withColumn("t", F.lit(int(total_bytes)))
    scaled = sums.crossJoin(whole).select("source", F.when(F.col("wz") > 0, F.col("t") * (F.col("share") / F.col("all")) / F.col("wz")).otherwise(0.0).alias("scale"))
    scaled = stored(scaled, "mixing-scales")

    ranked = slim.join(scaled.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).withColumn("pi", F.col("scale") * F.col("w"))
    need = ranked.groupBy("source", "scale").agg(F.sum("w").alias("w"), F.sum(F.floor("pi")).alias("whole")).select("source", F.floor(F.col("scale") * F.col("w") - F.col("whole") + 0.5).alias("n"))
    ranked = ranked.where(F.col("pi") > F.floor("pi")).select("source", "id", _rank(F.col("pi"), _u(F.col("id"), seed)).alias("q")).withColumn("cell", _cell(F.col("q")))
    cells = ranked.groupBy("source", "cell").count()
    before = F.sum("count").over(Window.partitionBy("source").orderBy("cell")) - F.col("count")
    at = cells.withColumn("before", before).join(need.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    at = at.where((F.col("before") < F.col("n")) & (F.col("n") <= F.col("before") + F.col("count"))).select("s", F.col("cell").alias("c"), (F.col("n") - F.col("before")).alias("left"))
    nth = F.row_number().over(Window.partitionBy("source").orderBy("q", F.col("id").asc_nulls_first()))
    cut = ranked.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c"))).withColumn("nth", nth).where(F.col("nth") == F.col("left"))
    cut = cut.select(F.col("source").alias("s"), F.col("q").alias("cut"), F.coalesce("id", F.lit(-(1 << 63))).alias("cut_id"))
    return scaled.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "scale", "cut", "cut_id")


def with_copies(docs: DataFrame, weights: dict[str, float] | None = None, total_bytes: int | None = None, seed: int = SEED) -> DataFrame:
    """The chosen documents, all columns, and ``__copies``, how often each is taken."""
    cuts = stored(plan(docs, weights, total_bytes, seed), "mixing-cuts").toDF(*(f"__lexmill_{x}" for x in ("source", "scale", "cut", "cut_id")))
    pi = F.col("__lexmill_scale") * _weight(_size(F.col("text")))
    rank = _rank(pi, _u(F.col("doc_id").cast("long"), seed))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    more = (pi > F.floor(pi)) & ((rank < F.col("__lexmill_cut")) | ((rank == F.col("__lexmill_cut")) & (key <= F.col("__lexmill_cut_id"))))
    copies = (F.floor(pi) + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)).cast("int")
    return docs.join(cuts, F.col("source").cast("string").eqNullSafe(F.col("__lexmill_source"))).withColumn("__lexmill_copies", copies).where(F.col("__lexmill_copies") > 0).select(*docs.columns, "__lexmill_copies")


def counts(docs: DataFrame, weights: dict[str, float] | None = None, total_bytes: int | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, source, copies) of the documents taken at least once."""
    return with_copies(docs, weights, total_bytes, seed).select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.col("__lexmill_copies").alias("copies"))


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, total_bytes: int | None = None, seed: int = SEED) -> DataFrame:
    """The documents, each as often as it is taken."""
    return with_copies(docs, weights, total_bytes, seed).withColumn("__lexmill_copies", F.explode(F.array_repeat(F.lit(1), F.col("__lexmill_copies")))).select(docs.columns)


def sql(seed: int = SEED) -> str:
    return f"""
    WITH d AS (SELECT doc_id, source, coalesce(strlen(text), 0) AS z, {FULL} + least(coalesce(strlen(text), 0), {FULL}) AS w,
                      (('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM documents),
    s AS (SELECT source, sum(z)::DOUBLE AS z, sum(w * z)::DOUBLE AS wz, sqrt(sum(z)::DOUBLE) * sqrt(sqrt(sum(z)::DOUBLE)) AS share FROM d GROUP BY source),
    t AS (SELECT source, CASE WHEN wz > 0 THEN (SELECT sum(z) FROM s) * (share / (SELECT sum(share) FROM s)) / wz ELSE 0.0 END AS scale FROM s),
    p AS (SELECT d.doc_id, d.source, w, u, scale, scale * w AS pi FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    n AS (SELECT source, floor(any_value(scale) * sum(w) - sum(floor(pi)) + 0.5) AS n FROM p GROUP BY source),
    q AS (SELECT *, CASE WHEN pi > floor(pi) THEN (u / (1 - u)) / ((pi - floor(pi)) / (1 - (pi - floor(pi)))) END AS q FROM p),
    r AS (SELECT *, rank() OVER (PARTITION BY source, q IS NULL ORDER BY q, doc_id NULLS FIRST) AS rk FROM q)
    SELECT r.doc_id, r.source, (floor(pi) + CASE WHEN q IS NOT NULL AND rk <= n.n THEN 1 ELSE 0 END)::INT AS copies
    FROM r JOIN n ON r.source IS NOT DISTINCT FROM n.source WHERE floor(pi) + CASE WHEN q IS NOT NULL AND rk <= n.n THEN 1 ELSE 0 END > 0"""
