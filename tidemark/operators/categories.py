"""One-hot features of text columns with any number of values.

The categories are a table, which rows are joined with; the driver sees a count, a
first position and a mode per column, whatever the number of values. For columns of
few values `Preprocessor` writes the same features into one expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions.scalar import quoted
from tidemark.operators.prep import Preprocessor, _text, fit_categories
from tidemark.session import stage
from tidemark.sources.io import write_table

#: A column is broadcast up to this many values and code points of them.
BROADCAST_VALUES, BROADCAST_CHARS = 100_000, 16_000_000
#: In wider columns, a value of more than a FREQUENT-th of the training rows is
#: frequent, unless it is very long. There are fewer than FREQUENT of them in a column.
FREQUENT = 1000
#: Parts that rows with a frequent value are spread over in a shuffled join.
SLICES = 1024

LARGEST_VECTOR = (1 << 31) - 1
WITHIN_PARTITION = (1 << 33) - 1


@dataclass(frozen=True)
class CategoryColumn:
    column: str
    mode: str
    values: int
    chars: int
    rows: int


@dataclass(frozen=True)
class CategoryTable:
    """`table` holds (column, value, n, position, slice): a category, its training
    rows, its place among all features, and 0.

    Positions follow the order of the columns, then that of the values' bytes. A null
    counts as the most frequent value of its column (the smallest among equals), an
    unseen value has no feature, and a column without a value in training has none.
    """

    columns: tuple[CategoryColumn, ...]
    table: DataFrame

    @classmethod
    def fit(cls, train: DataFrame, columns: Sequence[str]) -> CategoryTable:
        """Learn the categories of the training rows (runs jobs)."""
        counts = fit_categories(train, columns).withColumn("_at", _place(columns))
        # Sorted by range, so that no task holds a column; the number of a row in its
        # partition is kept, and partitions are counted afterwards.
        placed = counts.repartitionByRange("_at", "value").sortWithinPartitions("_at", "value")
        nth = F.monotonically_increasing_id().bitwiseAND(F.lit(WITHIN_PARTITION))
        placed = stage(placed.select("column", "value", "n", F.spark_partition_id().alias("_part"), nth.alias("_nth")), "categories")
        earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        parts = placed.groupBy("_part").agg(F.count("*").alias("_size"))
        starts = parts.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
        # One row a partition.
        table = placed.join(F.broadcast(starts), "_part").select(
            "column", "value", "n", (F.col("_start") + F.col("_nth")).alias("position"), F.lit(0).alias("slice")
        )
        return cls._of(stage(table, "category_table"), columns)

    @classmethod
    def _of(cls, table: DataFrame, columns: Sequence[str] | None = None) -> CategoryTable:
        best = F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("best")
        sums = [F.count("*").alias("values"), F.sum(F.length("value")).alias("chars"), F.sum("n").alias("rows")]
        found = table.groupBy("column").agg(best, F.min("position").alias("first"), *sums).orderBy("first").collect()
        wide = sum(r["values"] for r in found)
        if wide > LARGEST_VECTOR:
            raise ValueError(f"{wide} categories are more than a vector holds")
        return cls(tuple(CategoryColumn(r.column, r.best.value, r["values"], r.chars, r.rows) for r in found), table)

    def __len__(self) -> int:
        return sum(c.values for c in self.columns)

    def names(self, first: int = 0) -> DataFrame:
        """(position, feature) of all categories; numbers before them take `first` places."""
        return self.table.select(
            (F.col("position") + first).alias("position"), F.concat_ws("_", "column", "value").alias("feature")
        )

    def save(self, path: str) -> None:
        write_table(self.table, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CategoryTable:
        return cls._of(spark.read.parquet(path))

    def positions(self, df: DataFrame, keep: Sequence[str] = (), also: Sequence[Column] = ()) -> DataFrame:
        """`_kept` (struct of `keep`), the columns `also` and `_places`, the sorted
        positions of a row's categories.

        Columns of few values are broadcast, their size being known. In wider ones
        the frequent values are (there are fewer than FREQUENT), and the rest is a
        shuffled join in which rows that need no partner any more are spread over
        SLICES. A frequent value that training never saw is left to adaptive skew
        splitting.
        """
        texts = [
            F.expr(f"coalesce(CAST({quoted(c.column)} AS STRING), {_text(c.mode)})").alias(f"_text{i}")
            for i, c in enumerate(self.columns)
        ]
        made = df.select(F.struct(*keep).alias("_kept"), *also, *texts)
        for i, c in enumerate(self.columns):
            made = self._placed(made, c, f"_text{i}", f"_place{i}")
        places = F.array(*[f"_place{i}" for i in range(len(self.columns))]).cast("array<int>")
        rest = [n for n in made.columns if not n.startswith(("_text", "_place"))]
        return made.select(*rest, F.array_sort(F.array_compact(places)).alias("_places"))

    def _placed(self, rows: DataFrame, c: CategoryColumn, text: str, place: str) -> DataFrame:
        own = self.table.where(F.col("column") == c.column)

        def side(part: DataFrame, name: str) -> DataFrame:
            return part.select(F.col("value").alias("_value"), F.col("position").alias(name), F.col("slice").alias("_slice"))

        if c.values <= BROADCAST_VALUES and c.chars <= BROADCAST_CHARS:
            few = side(own, place).drop("_slice")
            return rows.join(F.broadcast(few), F.col(text) == F.col("_value"), "left").drop("_value")
        frequent = (F.col("n") * FREQUENT > c.rows) & (F.length("value") <= BROADCAST_CHARS // FREQUENT)
        often = side(own.where(frequent), "_often").drop("_slice")
        rows = rows.join(F.broadcast(often), F.col(text) == F.col("_value"), "left").drop("_value")
        done = F.col("_often").isNotNull()
        rows = rows.withColumns({
            "_wanted": F.when(~done, F.col(text)),
            "_spread": F.when(done, F.pmod(F.xxhash64("_kept"), F.lit(SLICES)).cast("int")).otherwise(0),
        })
        seldom = side(own.where(~frequent), "_seldom").hint("merge")
        met = rows.join(seldom, (F.col("_wanted") == F.col("_value")) & (F.col("_spread") == F.col("_slice")), "left")
        met = met.withColumn(place, F.coalesce("_often", "_seldom"))
        return met.drop("_often", "_seldom", "_value", "_slice", "_wanted", "_spread")

    def vectors(
        self, df: DataFrame, keep: Sequence[str] = (), numbers: Preprocessor | None = None, output: str = "features"
    ) -> DataFrame:
        """All features in one sparse vector column: the numbers and indicators of
        `numbers`, then the categories (runs a job).

        A vector is written as the columns it is stored in and read as a vector.
        """
        dense = [sql for _, sql in numbers.numbers()] if numbers else []
        found = self.positions(df, keep, [F.expr(f"array({', '.join(dense)})").cast("array<double>").alias("_numbers")])
        places = F.transform("_places", lambda p: p + len(dense))
        if dense:
            places = F.concat(F.sequence(F.lit(0), F.lit(len(dense) - 1)), places)
        stored = F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(len(dense) + len(self)).alias("size"),
            places.alias("indices"),
            F.concat("_numbers", F.transform("_places", lambda _: F.lit(1.0))).alias("values"),
        )
        stored = found.select("_kept.*", stored.alias(output))
        return stage(stored, "sparse_vectors", schema=T.StructType([*stored.schema.fields[:-1], T.StructField(output, VectorUDT())]))


def _place(columns: Sequence[str]) -> Column:
    """Number of a column in `columns`."""
    return F.array_position(F.array(*map(F.lit, columns)), F.col("column"))
