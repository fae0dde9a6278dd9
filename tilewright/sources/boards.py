"""The board-state table: one row for each decision, in columns known by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# Positions in the table, and the defaults of missing values.
SCALARS = {"wind": (0, None), "dealer": (1, 0), "pov": (2, 0), "honba": (3, 0), "sticks": (4, 0), "wall": (5, 70), "round_number": (32, 0), "label": (510, None)}
SCORES, RIICHI = range(6, 10), range(10, 14)
INDICATORS, HAND, MELDS, DISCARDS = 34, 68, (102, 136, 170, 204), (374, 408, 442, 476)
GAME_ID = 511


def read_boards(spark: SparkSession, path: str, skip_unreadable: bool = False) -> DataFrame:
    """The Parquet file, or all *.parquet files of the folder, with the file's path as source_file and the row's place in it, from 0, as source_row."""
    skip = str(skip_unreadable).lower()
    # the schema is taken from all files then, since the first one may be one that can't be read
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("ignoreCorruptFiles", skip).option("mergeSchema", skip)
    return reader.parquet(path).withColumns({"source_file": F.col("_metadata.file_path"), "source_row": F.col("_metadata.row_index")})


def limit_per_file(df: DataFrame, n: int, row: str = "source_row", whole: Column | None = None) -> DataFrame:
    """The first n rows of each file, by their place in it; no rows are moved for it.

    whole is the name of the file that numbered files are the parts of, if there
    are such; then n rows of each part are ranked, by the part's name and their
    place in it, and the first n of the whole are kept.
    """
    first = df.where(F.col(row) < n)
    if whole is None:
        return first
    place = F.row_number().over(Window.partitionBy("_whole").orderBy("source_file", row))
    return first.withColumn("_whole", whole).withColumn("_place", place).where(F.col("_place") <= n).drop("_whole", "_place")


def column_at(df: DataFrame, i: int) -> Column:
    """The i-th column; null where the table has none."""
    return F.col(f"`{df.columns[i]}`") if 0 <= i < len(df.columns) else F.lit(None)


def _number(df: DataFrame, i: int, default: int | None) -> Column:
    """A whole number; NaN, null and what is no number give the default."""
    value = column_at(df, i)
    if not (0 <= i < len(df.columns) and isinstance(df.schema[i].dataType, IntegerType)):
        value = value.try_cast("double")
        value = F.when(~F.isnan(value), value).cast("int")
    return value if default is None else F.coalesce(value, F.lit(default))


def pack(df: DataFrame, *keep: str) -> DataFrame:
    """Named scalars and arrays from the positions, and the columns in keep; positions that are not used are never read.

    melds and discards are four arrays of 34 counts, riichi four flags.
    """
    counts = lambda start: F.array(*[_number(df, start + k, 0) for k in range(34)])
    game = column_at(df, GAME_ID).cast("string")
    flags = [F.coalesce(column_at(df, i).try_cast("double"), F.lit(0.0)) for i in RIICHI]
    return df.select(
        *[_number(df, i, d).alias(name) for name, (i, d) in SCALARS.items()],
        F.array(*[_number(df, i, 0) for i in SCORES]).alias("scores"),
        F.array(*[(f != 0) & ~F.isnan(f) for f in flags]).alias("riichi"),
        counts(INDICATORS).alias("indicators"),
        counts(HAND).alias("hand"),
        F.array(*map(counts, MELDS)).alias("melds"),
        F.array(*map(counts, DISCARDS)).alias("discards"),
        F.when(game.isNull() | game.isin("0", "0.0", "NaN"), "").otherwise(game).alias("game_id"),
        *keep,
    )


def unpack(df: DataFrame) -> DataFrame:
    """The inverse of pack(): columns c0 to c511, zero where nothing is known."""
    columns = {i: F.lit(0) for i in range(512)}
    columns |= {i: F.col(name) for name, (i, _) in SCALARS.items()}
    columns |= {i: F.col("scores")[k] for k, i in enumerate(SCORES)} | {i: F.col("riichi")[k].cast("int") for k, i in enumerate(RIICHI)}
    for start, of in ((INDICATORS, F.col("indicators")), (HAND, F.col("hand")), *[(s, F.col("melds")[k]) for k, s in enumerate(MELDS)], *[(s, F.col("discards")[k]) for k, s in enumerate(DISCARDS)]):
        columns |= {start + t: of[t] for t in range(34)}
    columns[GAME_ID] = F.col("game_id")
    return df.select(*[c.alias(f"c{i}") for i, c in sorted(columns.items())])
