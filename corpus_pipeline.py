"""A corpus pipeline: language, exact copies, near copies, source mix, tokens.

Each stage takes (spark, docs, sf_dir), works on every row that the stage
before has kept, and returns a DataFrame; all but the last return the columns
of documents.  Stages may be applied to tables with nulls, repeated rows and
further columns; what they do with them is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import byte_bpe, exact_dedup, language_id, mixing, near_dedup
from tilewright.llm._common import crc_mod, table, written
from tilewright.shipping import ship

LEAST_SCORE = 0.5  # of the language prediction
FOLDS = 5
NEAR = (80, 100)  # near copies: 100 * intersection >= 80 * union


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs under names that no operator uses, and the name that each column got."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(v).alias(k) for k, v in names.items()])


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned: not `und`, and with a score of LEAST_SCORE at least.

    Null texts and texts without letters go; rows without an id are judged like
    others.  Languages are learned as in op4; where none can be, nothing stays.
    """
    ship(spark)
    plain, names = _plain(docs)
    doc_id, text, lang = (names[c] for c in ("doc_id", "text", "lang"))
    side = crc_mod(doc_id, FOLDS)
    model = language_id.fit(plain, side != 0, id_col=doc_id, text_col=text, lang_col=lang)
    known = language_id.predict(plain, model, side == 0, id_col=doc_id, text_col=text, keep=tuple(names.values()))
    return _back(known.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)), names)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id, null ids last; of rows that repeat id and text, one.

    Null texts count as empty texts, which are equal to each other; an empty table gives an empty result.
    """
    ship(spark)
    plain, names = _plain(docs)
    return _back(exact_dedup.without_duplicates(plain, names["doc_id"], names["text"]), names)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (similarity 0.8 and more), the one with the smallest id. Rows without an id stay.

    Rows that share an id are judged each by its own text: they go by numbers in the order of id and text hash.
    """
    ship(spark)
    plain, names = _plain(docs)
    doc_id, text = names["doc_id"], names["text"]
    keys = [F.col(doc_id), F.sha2(exact_dedup.normalised(text), 256)]
    rows = plain.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = written(rows.withColumn("row", F.when(F.col(doc_id).isNotNull(), F.monotonically_increasing_id())), "numbered")
    kept = near_dedup.near_duplicates(rows, threshold=NEAR, id_col="row", text_col=text).where("kept").select(F.col("doc_id").alias("row"))
    # null rows are not looked for, so that they need not be in one place
    return _back(rows.where("row IS NOT NULL").join(kept, "row", "left_semi").unionByName(rows.where("row IS NULL")), names)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: its words over the document's, halves up.

    Documents without words go; rows without an id and rows that share one are
    each taken as often as the mix takes that row.
    """
    ship(spark)
    plain, names = _plain(docs)
    rows = written(plain.withColumn("row", F.monotonically_increasing_id()), "numbered")
    taken = mixing.mixed(rows, id_col=names["doc_id"], source_col=names["source"], text_col=names["text"], row_col="row").where("taken > 0")
    taken = taken.select("row", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("copies")).where("copies > 0")
    return _back(rows.join(taken, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), names)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of each document's ids and of what they decode to.

    A null text counts as empty, with 0 tokens; null ids stay null, repeated
    rows stay repeated, other columns are not looked at, and an empty table
    gives an empty result.
    """
    import public_tokenizers

    ship(spark)
    return byte_bpe.token_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", by_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("source_mix", mixed_sources),
    ("byte_bpe", tokens),
]

#: SQL can express neither the language model nor the token encoding; see tests/llm/test_models.py and tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
