"""Helpers that several corpus operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakegate.session import checkpoint_dir

ASCII_SPACE = " \t\n\x0b\x0c\r"
"""The white space of the contracts: U+0020 and U+0009 to U+000D."""

WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"

BATCH_ROWS = 500
"""Rows of an Arrow batch: they hold whole texts, so Spark's 10,000 would be many megabytes on both sides."""

FILTER_BITS = 22
"""log2 of the bits in a membership filter: 512 KB, whatever the input's size."""


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder that the cluster names, and read again.

    This cuts the lineage like a checkpoint, survives lost executors, computes
    ``df`` once, and gives later plans true sizes (a checkpoint keeps estimates,
    which multiply from join to join).  Twice as many files as the cluster has
    cores keep all of them busy; more would be small files.  The folder of an
    application may be removed when it has ended.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.coalesce(max(2, 2 * spark.sparkContext.defaultParallelism)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder by its own tasks, whatever their number, and read again."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Send whole texts to Python in batches of ``BATCH_ROWS`` (a setting of the session)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_id(df: DataFrame, name: str = "_row") -> DataFrame:
    """Number the rows of a stored table, unique also where rows repeat.

    The number is the row's place in its Parquet file plus the rows of the files
    before it in path order.  No split, core count or lost executor changes it, so
    all reads of the same stored table agree.  The table of first numbers has one
    row per file and is broadcast.
    """
    about = df.metadataColumn("_metadata")
    path, start = fresh(df, "_file"), fresh(df, "_start")
    files = (df.select(about["file_path"].alias(path), about["row_index"].alias("at"))
             .groupBy(path).agg((F.max("at") + 1).alias("n")))
    before = W.orderBy(path).rowsBetween(W.unboundedPreceding, -1)
    starts = stored(files.select(path, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start)))
    return (df.withColumns({path: about["file_path"], name: about["row_index"]}).join(F.broadcast(starts), path)
            .withColumn(name, F.col(name) + F.col(start)).drop(path, start))


def bit_filter(keys: DataFrame, key: str, log2_bits: int = FILTER_BITS):
    """A test ``Column -> Column`` that is true for every key of ``keys``.

    One bit per hash value, in an array of longs of fixed size that reaches the
    tasks as a scalar subquery.  (A subquery can't stand inside a lambda: there,
    select ``test.words()`` as a column and pass that.)  Other values pass by chance only; as the keys
    outgrow the bits more of them pass, so callers must confirm by a join.
    """
    words = 1 << (log2_bits - 6)
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << log2_bits))
    set_bits = (keys.select(slot.alias("s"))
                .select(F.shiftright("s", 6).alias("w"), F.col("s").bitwiseAND(F.lit(63)).cast("int").alias("b"))
                .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")))
    dense = (keys.sparkSession.range(0, words, 1, 1).withColumnRenamed("id", "w").join(set_bits, "w", "left")
             .select(F.struct("w", F.coalesce("bits", F.lit(0)).alias("bits")).alias("x")))
    array = stored(dense.agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["bits"]).alias("a")))

    def test(col: Column, words: Column | None = None) -> Column:
        at = F.pmod(F.xxhash64(col), F.lit(1 << log2_bits))
        word = F.element_at(array.scalar() if words is None else words, (F.shiftright(at, 6) + 1).cast("int"))
        return F.bit_get(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1

    test.words = array.scalar
    return test


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The stored table ``docs`` without the rows whose number ``_row`` is in ``dropped``.

    Rows that the membership filter clears pass without a shuffle; only the
    others meet the dropped numbers in an anti join.
    """
    key = fresh(docs, "_row")
    numbered, gone = with_row_id(docs, key), dropped.select(F.col("_row").alias(key))
    maybe = bit_filter(gone, key)
    passed = numbered.where(~maybe(F.col(key)))
    checked = numbered.where(maybe(F.col(key))).join(gone, key, "left_anti")
    return passed.select(*docs.columns).unionByName(checked.select(*docs.columns))
