"""Shared pieces of the document parsers: cell clean-up and first hits in arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimweave.functions import text as T

DOCUMENT = ("numero_processo", "documento_id", "documento_nome")


def fence(df: DataFrame, **values: Column) -> DataFrame:
    """Adds columns that are evaluated once, however often later columns and filters use them.

    Filters and projections are otherwise merged into one expression that would repeat a
    costly text operation for every use.
    """
    record = F.struct(*[v.alias(n) for n, v in values.items()])
    return df.select("*", F.inline(F.array(record)))


def clean_cell(cell: Column) -> Column:
    """Squashed non-blank lines of a cell, joined with a line feed."""
    text = F.coalesce(cell, F.lit(""))
    lines = F.transform(F.split(text, T.LINE_BREAK), T.squash)
    # A split compiles its pattern for every text, so cells of one line go without.
    return F.when(text.rlike(T.LINE_BREAK), F.array_join(F.filter(lines, lambda x: x != ""), "\n")).otherwise(T.squash(text))


def clean_rows(table: Column) -> Column:
    """Rows of cleaned cells; rows without any text are dropped."""
    rows = F.transform(table, lambda row: F.transform(row, clean_cell))
    return F.filter(rows, lambda row: F.exists(row, lambda c: c != ""))


#: Separators of joined parts; cleaned cells don't hold them, and folding makes none.
_PART, _ROW, _TABLE = "\x1f", "\x1e", "\x1d"


def folded_cells(tables: Column) -> Column:
    """Folded copies of tables of cleaned cells, by one folding of all cells joined."""
    joined = F.array_join(F.transform(tables, lambda t: F.array_join(F.transform(t, lambda r: F.array_join(r, _PART)), _ROW)), _TABLE)
    opened = F.transform(F.split(T.fold(joined), _TABLE), lambda t: F.transform(F.split(t, _ROW), lambda r: F.split(r, _PART)))
    return F.when(F.size(tables) > 0, F.zip_with(tables, opened, lambda t, o: F.when(F.size(t) > 0, o).otherwise(t))).otherwise(tables)


def folded_parts(parts: Column, separator: str = _PART) -> Column:
    """Folded copies of the texts of an array, by one folding; a separator inside a text counts as a space."""
    plain = F.transform(parts, lambda x: F.translate(F.coalesce(x, F.lit("")), separator, " "))
    return F.split(T.fold(F.array_join(plain, separator)), separator)


def squash_cells(rows: Column) -> Column:
    return F.transform(rows, lambda row: F.transform(row, T.squash))


def first_of(array: Column) -> Column:
    """First non-null element, null when there is none."""
    return F.get(F.filter(array, lambda x: x.isNotNull()), F.lit(0))


def upto(array: Column, start: Column | int) -> Column:
    """Elements from the one-based ``start`` to the end."""
    return F.slice(array, start, F.greatest(F.size(array), F.lit(1)))


def document_texts(pages: DataFrame) -> DataFrame:
    """Page texts of each document joined in page order (a document is one bounded unit)."""
    listed = pages.groupBy(*DOCUMENT).agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("p"))
    return listed.select(
        *DOCUMENT, F.array_join(F.transform("p", lambda x: F.coalesce(x["text"], F.lit(""))), "\n").alias("text")
    )


def preferred(layouts: list[DataFrame], documents: DataFrame | None, key: list[str]) -> DataFrame:
    """Records of each document's first layout that gave any, with ``rejeitado``: one of them is broken, or there is none.

    ``layouts`` are record frames with a flag ``erro``, in the order in which they count. Where ``documents`` lists all
    documents, those without a record come back as one row with the columns of ``documents`` alone.
    """
    every = layouts if documents is None else [*layouts, documents]
    ranked = [x.withColumn("_ordem", F.lit(i)) for i, x in enumerate(every)]
    records = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    own = W.partitionBy(*key)
    flagged = records.withColumn("_primeira", F.min("_ordem").over(own))
    kept = flagged.filter("_ordem = _primeira")
    broken = F.max(F.coalesce("erro", F.lit(False)) | (F.col("_ordem") == len(layouts))).over(own)
    return kept.withColumn("rejeitado", broken).drop("_ordem", "_primeira", "erro")
