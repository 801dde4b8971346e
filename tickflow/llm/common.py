"""What the text operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.streaming.runner import scratch_folder

#: White space as the operators know it: the six ASCII characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"


def named(column: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: str) -> DataFrame:
    """Only ``doc_id`` and ``text`` (NULL: empty), and further columns by new names; all others are left behind, so
    that their names can't clash with those an operator makes."""
    return docs.select(
        named(id_col).alias("doc_id"),
        F.coalesce(named(text_col), F.lit("")).alias("text"),
        *(named(column).alias(name) for name, column in more.items()),
    )


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Names for working columns that no column of ``docs`` has, however it is written."""
    taken = {column.lower() for column in docs.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def held(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with further columns that are formed once per row, however often what follows refers to them.

    Spark may put the expression of a column in the place of each reference, also inside functions applied to every
    element of an array; a generated row holds the value itself.
    """
    packed = F.array(F.struct(*(column.alias(name) for name, column in columns.items())))
    return rows.select("*", F.inline(packed))


def stored(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the rows below the shared ``spark.checkpoint.dir`` and read them back.

    This cuts the lineage: what follows survives lost executors without computing the rows again, and several readers
    compute them once.
    """
    spark = rows.sparkSession
    path = f"{folder or scratch_folder(spark)}/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
