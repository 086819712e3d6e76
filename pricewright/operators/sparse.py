"""Dummies of columns with any number of levels: a table of levels, joined, into one sparse vector."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import cut_lineage

#: A table of levels is broadcast up to this size of its text and positions.
LEVEL_BYTES = 8 << 20


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """A sparse ML vector of ascending indices and their values, built in the JVM.

    Spark has no function for it; its JSON reader takes a vector type in the schema.
    """
    parts = F.struct(
        F.lit(0).alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), schema)["v"]


def vector_parts(vector: str) -> Column:
    """(type, size, indices, values) of a vector column, without making it dense."""
    parts = "v struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"
    return F.from_json(F.to_json(F.struct(F.col(f"`{vector}`").alias("v"))), parts)["v"]


def _numbered(levels: DataFrame) -> DataFrame:
    """Position of each level among the sorted ones of its column, from zero.

    Levels are cut into sorted ranges; a range starts where the ones before it end.
    No task sees more than a range, and the starts are one row per column and range.
    """
    ranges = cut_lineage(
        levels.repartitionByRange("column", "level").withColumn("range", F.spark_partition_id()))
    before = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("column", "range").agg(F.count("*").alias("n")).select(
        "column", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("column", "range").orderBy("level")
    placed = ranges.withColumn("nth", F.row_number().over(inside) - 1)
    return placed.join(F.broadcast(starts), ["column", "range"]).select(
        "column", "level", (F.col("start") + F.col("nth")).alias("position"))


def _unused(name: str, taken: Sequence[str]) -> str:
    used = {c.lower() for c in taken}
    while name in used:
        name = f"_{name}"
    return name


@dataclass
class Levels:
    """Sorted levels of some columns: (column, level, position), and how many there are.

    ``table`` is a frame, so nothing but one count per column is on the driver.
    """

    table: DataFrame
    columns: list[str]
    counts: dict[str, int]
    text_bytes: dict[str, int]

    def size(self, numeric: Sequence[str] = ()) -> int:
        return len(numeric) + sum(max(n - 1, 0) for n in self.counts.values())

    def _side(self, column: str, level: str, at: str) -> DataFrame:
        side = self.table.where(F.col("column") == column).select(
            F.col("level").alias(level), F.col("position").alias(at))
        small = self.text_bytes[column] + 16 * self.counts[column] <= LEVEL_BYTES
        return F.broadcast(side) if small else side

    def encode(
        self, df: DataFrame, numeric: Sequence[str] = (), output: str = "features",
        handle_invalid: str = "keep",
    ) -> DataFrame:
        """All columns and one vector: ``numeric`` first, then one place per level but the first.

        An unseen or null level has no place of its own ('keep') or fails the job
        ('error'). A null number makes the vector null. Rows, repeated ones too, stay
        as they are; one left join per column, broadcast only below LEVEL_BYTES and
        otherwise shuffled, with skewed levels split by adaptive execution.
        """
        if output.lower() in {c.lower() for c in df.columns}:
            raise ValueError(f"column {output} is already there")
        out, places, start = df, [], len(numeric)
        for c in self.columns:
            level = _unused("level", out.columns)
            at = _unused("position", out.columns)
            text = F.col(f"`{c}`").cast("string")
            out = out.join(self._side(c, level, at), text == F.col(level), "left").drop(level)
            found = F.col(at)
            if handle_invalid == "error":
                unseen = F.concat(F.lit(f"unseen level in {c}: "), F.coalesce(text, F.lit("null")))
                found = F.when(found.isNotNull(), found).otherwise(F.raise_error(unseen).cast("long"))
            place = F.when(found > 0, (found + (start - 1)).cast("int"))
            # numbered here, so that the next join does not see the name again
            out = out.withColumn(at, place)
            places.append(at)
            start += max(self.counts[c] - 1, 0)
        dummies = F.array_compact(F.array(*[F.col(p) for p in places])) if places else F.array().cast("array<int>")
        numbers = F.array(*[F.col(f"`{c}`").cast("double") for c in numeric]).cast("array<double>")
        indices = F.concat(F.array(*[F.lit(i) for i in range(len(numeric))]).cast("array<int>"), dummies)
        values = F.concat(numbers, F.transform(dummies, lambda _: F.lit(1.0)))
        vector = F.when(
            F.forall(numbers, lambda x: x.isNotNull()), sparse_vector(self.size(numeric), indices, values))
        return out.withColumn(output, vector).drop(*places)


def fit_levels(df: DataFrame, columns: Sequence[str]) -> Levels:
    """The levels of ``columns``, found by one grouped pass; null is no level."""
    pairs = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("level")) for c in columns
    ]))
    table = cut_lineage(_numbered(df.select(pairs).where("level IS NOT NULL").distinct()))
    rows = {
        r["column"]: r for r in table.groupBy("column").agg(
            F.count("*").alias("n"), F.sum(F.octet_length("level")).alias("bytes")).collect()
    }
    return Levels(
        table, list(columns), {c: rows[c]["n"] if c in rows else 0 for c in columns},
        {c: rows[c]["bytes"] if c in rows else 0 for c in columns})
