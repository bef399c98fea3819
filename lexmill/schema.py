"""Schemas of documents and records; readers always get one, nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fields(*pairs) -> T.StructType:
    return T.StructType([T.StructField(name, kind, null) for name, kind, null in pairs])


_SCORES = T.MapType(T.StringType(), T.DoubleType())

#: A curated document; ``warc_id`` is written as ``warc-id``.
DOCUMENT = _fields(
    ("text", T.StringType(), False),
    ("date", T.StringType(), True),
    ("url", T.StringType(), True),
    ("language", T.StringType(), True),
    ("language_score", T.DoubleType(), True),
    ("warc_id", T.StringType(), True),
    ("scores", _SCORES, True),
    ("group_idx", T.IntegerType(), True),
    ("warc_file", T.StringType(), True),
    ("record_idx", T.LongType(), True),
    ("repetitions", T.DoubleType(), True),
    ("long_words", T.DoubleType(), True),
    ("gopher_metrics", _SCORES, True),
)

#: One archive record; ``record_idx`` counts records of every type.
WARC_RECORD = _fields(
    ("warc_type", T.StringType(), True),
    ("warc_id", T.StringType(), True),
    ("date", T.StringType(), True),
    ("url", T.StringType(), True),
    ("group_idx", T.IntegerType(), True),
    ("warc_file", T.StringType(), True),
    ("record_idx", T.LongType(), False),
    ("payload", T.BinaryType(), True),
)

#: Lines of the older tools: all but the text optional, ``lid`` a score or a [label, score] pair.
LEGACY = _fields(
    ("text", T.StringType(), False),
    ("date", T.StringType(), True),
    ("url", T.StringType(), True),
    ("lid", T.StringType(), True),
    ("language", T.StringType(), True),
    ("language_score", T.FloatType(), True),
    ("repetitions", T.FloatType(), True),
    ("long_words", T.FloatType(), True),
    ("pnum", T.FloatType(), True),
    ("warc-id", T.StringType(), True),
    ("scores", T.MapType(T.StringType(), T.FloatType()), True),
)

#: Source-code lines as published, before renaming.
CODE = _fields(
    ("content", T.StringType(), False),
    ("lang", T.StringType(), True),
    ("max_stars_repo_path", T.StringType(), True),
    ("max_stars_repo_name", T.StringType(), True),
    ("max_stars_repo_licenses", T.ArrayType(T.StringType()), True),
    ("max_stars_count", T.FloatType(), True),
)


def lid_label(lid: Column) -> Column:
    """Label of a pair; ``unk`` for a bare score or none."""
    return F.coalesce(F.from_json(lid, "array<string>")[0], F.lit("unk"))


def lid_score(lid: Column) -> Column:
    """Score of a pair or a bare score; 1.0 for none."""
    return F.coalesce(F.from_json(lid, "array<string>")[1].try_cast("double"), lid.try_cast("double"), F.lit(1.0))


def code_documents(raw: DataFrame) -> DataFrame:
    """Source-code lines under their short names."""
    names = {"content": "text", "max_stars_repo_path": "repo_path", "max_stars_repo_name": "repo_name", "max_stars_repo_licenses": "repo_licenses", "max_stars_count": "repo_stars"}
    return raw.select([F.col(c).alias(names.get(c, c)) for c in raw.columns])


def with_document_columns(df: DataFrame) -> DataFrame:
    """All document columns in order; missing ones null, scores empty."""
    out = []
    for field in DOCUMENT:
        if field.name in df.columns:
            out.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.name == "scores":
            out.append(F.create_map().cast(field.dataType).alias("scores"))
        else:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(out)
