"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import lineage

#: A word of the text operators: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A small side is broadcast up to so many rows; beyond it the join is a shuffled one.
BROADCAST_ROWS = 20_000

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """The frame as a table written once in the shared folder; its lineage ends there."""
    path = lineage.scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def join_small(df: DataFrame, small: DataFrame, on: Column, how: str = "left") -> DataFrame:
    """Join with a side that is small as a rule: broadcast after its rows were counted and found few,
    else Spark's own choice, in which hot keys of the wide side are split at run time."""
    few = small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(small) if few else small, on, how)


def crc_rest(doc_id: Column, by: int) -> Column:
    """crc32 of the id's text, modulo ``by``; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(by))


_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(), "binary": T.BinaryType()}
_TYPES |= {f"array<{k}>": T.ArrayType(v) for k, v in _TYPES.items()}


def struct_of(fields: str) -> T.StructType:
    """The type of ``"name type, name type"``; no session is needed."""
    return T.StructType([T.StructField(*f.split(" ")[:1], _TYPES[f.split(" ")[1]]) for f in fields.split(", ")])


def per_text(fn: Callable[[str], tuple], fields: str) -> Callable[[Column], Column]:
    """A pandas UDF of whole texts: ``fn`` gives a tuple of the fields for each text, null being empty."""
    names = [f.split(" ")[0] for f in fields.split(", ")]

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fn(t or "") for t in texts], columns=names)

    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return lambda text: F.pandas_udf(run, struct_of(fields)).asNondeterministic()(text)
