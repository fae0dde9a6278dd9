"""Shuffling, splitting, rebalancing and stratified sampling.

Orders are by the MD5 of a seed and a key, so that they are random,
reproducible and the same in other engines.  No operator sorts all rows in one
task: positions come from counts per hash bucket and ranks within buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..scratch import written

#: The stages of a game, their shares in a file, and the shares of a sample.
BUCKETS = ("early", "mid_pre", "mid_mid", "late")
RATIOS = {"early": 0.15, "mid_pre": 0.20, "mid_mid": 0.30, "late": 0.35}
STRATA = {"early": 0.33, "mid": 0.33, "late": 0.34}


def shuffle_key(seed: str | int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")))


#: Rows that a task ranks, about: hashes are dealt to as many buckets as that needs.
BUCKET_ROWS = 1 << 16


def positions(df: DataFrame, order: Column, group: list[str] = (), name: str = "position", tie: Column | None = None, rows: int | None = None) -> DataFrame:
    """df with each row's place, from 0, in the order of a hexadecimal hash, within group.

    rows is how many df has, if that is known; else they are counted. The
    buckets of the hash follow that number, so that none has many more rows than
    BUCKET_ROWS, whatever the groups are.
    """
    rows = df.count() if rows is None else rows
    digits = 3
    while 16**digits * BUCKET_ROWS < rows:
        digits += 1
    tie = [] if tie is None else [tie]
    df = df.withColumn("_order", order).withColumn("_part", F.substring("_order", 1, digits))
    counts = df.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*[F.col(g) for g in group], F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*group, "_part").orderBy("_order", *tie)
    ranked = df.withColumn("_rank", F.row_number().over(inside) - 1)
    return ranked.join(offsets, [*group, "_part"]).withColumn(name, (F.col("_before") + F.col("_rank")).cast("long")).drop("_order", "_part", "_rank", "_before")


def random_split(df: DataFrame, key: str, lines_per_file: int, seed: str | int = 0) -> DataFrame:
    """df with position and part: shuffled and cut in parts of lines_per_file rows, the last part the rest."""
    if lines_per_file <= 0:
        raise ValueError("lines_per_file must be above 0")
    return positions(df, shuffle_key(seed, F.col(key)), tie=F.col(key)).withColumn("part", F.floor(F.col("position") / lines_per_file).cast("long"))


def needed_per_file(lines_per_file: int, ratios: dict[str, float] = RATIOS) -> dict[str, int]:
    """Rows of each bucket in a file; what rounding leaves goes to the last bucket."""
    if lines_per_file <= 0:
        raise ValueError("lines_per_file must be above 0")
    need = {b: int(lines_per_file * r) for b, r in ratios.items()}
    need["late"] += lines_per_file - sum(need.values())
    return need


def plan_files(counts: dict[str, int], need: dict[str, int], max_files: int = 0) -> int:
    """How many whole files the scarcest bucket allows, at most max_files if that is above 0."""
    files = min((counts.get(b, 0) // n for b, n in need.items() if n > 0), default=0)
    return min(files, max_files) if max_files > 0 else files


def rebalance(df: DataFrame, key: str, bucket: str, lines_per_file: int, seed: str | int = 0, ratios: dict[str, float] = RATIOS, max_files: int = 0) -> DataFrame:
    """The rows that go into files, with file_no and place (their order in the file).

    File i takes the i-th share of each shuffled bucket; rows beyond the last
    whole file are left over. Only the buckets' counts come to the driver.
    """
    need = needed_per_file(lines_per_file, ratios)
    df = df.where(F.col(bucket).isin(*need))
    counts = {r[bucket]: r["count"] for r in df.groupBy(bucket).count().collect()}
    files = plan_files(counts, need, max_files)
    per_file = F.create_map(*[F.lit(x) for b, n in need.items() for x in (b, n)])[F.col(bucket)]
    ranked = positions(df, shuffle_key(seed, F.col(key)), [bucket], "_position", F.col(key), sum(counts.values()))
    kept = ranked.where(per_file > 0).withColumn("file_no", F.floor(F.col("_position") / per_file).cast("long")).where(F.col("file_no") < files)
    place = Window.partitionBy("file_no").orderBy(shuffle_key(f"{seed}-file", F.col(key)), F.col(key))
    return kept.withColumn("place", F.row_number().over(place).cast("long")).drop("_position")


def strata_sizes(available: dict[str, int], n: int, ratios: dict[str, float] = STRATA) -> tuple[dict[str, int], bool]:
    """(rows to take of each category, whether the ratios had to be given up for a draw from everything).

    Each category gets its share, 1 at least, as far as it has rows; what is
    missing is asked of the category with most rows to spare, the first of them
    on ties. If that still is not enough but all rows together are, the draw is
    from all rows.
    """
    names = ("early", "mid", "late")
    if sum(available.get(c, 0) for c in names) == 0:
        return dict.fromkeys(names, 0), False
    take = {c: min(max(1, int(n * ratios[c])), available.get(c, 0)) for c in names}
    short = n - sum(take.values())
    if short > 0:
        most = max(names, key=lambda c: available.get(c, 0) - take[c])
        take[most] += short
    got = {c: min(take[c], available.get(c, 0)) for c in names}
    if sum(got.values()) < n <= sum(available.get(c, 0) for c in names):
        return got, True
    return got, False


def stratified_sample(df: DataFrame, key: str, category: str, n: int, seed: str | int = 0, ratios: dict[str, float] = STRATA) -> DataFrame:
    """n rows of df by strata, as strata_sizes() says; rows of other categories are never drawn.

    One scan: each task counts its rows of each category and passes on the n
    first of them in the order of the shuffle, of which the n first of all are
    kept in a table. What is drawn is among these, whatever the counts are.
    """
    order = [shuffle_key(seed, F.col(key)), F.col(key)]
    counts = Observation()
    known = df.where(F.col(category).isin(*STRATA)).observe(counts, F.count("*").alias("rows"), *[F.count_if(F.col(category) == c).alias(c) for c in STRATA])
    place = F.row_number().over(Window.partitionBy(category).orderBy(*order))
    first = written(known.withColumn("_place", place).where(F.col("_place") <= n), "first-of-strata")
    take, everything = strata_sizes({c: counts.get[c] for c in STRATA}, n, ratios)
    if not everything:
        limit = F.create_map(*[F.lit(x) for c, k in take.items() for x in (c, k)])[F.col(category)]
        first = first.where(F.col("_place") <= limit)
        if sum(take.values()) <= n:
            return first.drop("_place")
    return first.drop("_place").orderBy(*order).limit(n)
