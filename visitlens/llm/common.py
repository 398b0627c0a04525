"""Helpers several corpus operators share: reading, learning rows, samples, kept tables, Arrow batches."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_ROWS = 1000  # rows a task holds as Python objects at a time,
BATCH_BYTES = 4 << 20  # and bytes of Arrow data, where one row does not have more
MOST_GROUPS = 10_000  # sizes of as many groups are sent to every task


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ids_and_texts(docs: DataFrame, text_or: str | None = "") -> DataFrame:
    """``doc_id`` and ``text`` alone (other columns cannot clash); a null text becomes ``text_or``."""
    text = F.col("text").cast("string")
    if text_or is not None:
        text = F.coalesce(text, F.lit(text_or))
    return docs.select("doc_id", text.alias("text"))


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the other columns in one struct ``rest``, where their names clash with none."""
    others = [F.col(f"`{name}`") for name in docs.columns if name not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others or [F.lit(0).alias("none")]).alias("rest"))


def unpacked(rows: DataFrame, names: list[str]) -> DataFrame:
    """The columns ``names`` of a table that :func:`packed` made."""
    return rows.select(*(F.col(n) if n in ("doc_id", "text") else F.col("rest").getField(n).alias(n) for n in names))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fifth of the documents nothing is learned from. A null id is never held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_by_hash(rows: DataFrame, size: int, seed: int, *groups: str) -> DataFrame:
    """About ``size`` rows, or ``size`` for each value of ``groups``: those whose id hash is low enough.

    All rows where there are fewer. The share comes from a count, so no group meets in one task; the
    size of the sample keeps to the bound but for the chance in the hashes (its square root).
    """
    counts = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_rows"))
    low = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 40)) * F.col("_rows") < F.lit(float(size) * (1 << 40))
    if not groups:
        total = counts.collect()[0]["_rows"]
        return rows.withColumn("_rows", F.lit(float(total))).filter(low).drop("_rows")
    known = counts.limit(MOST_GROUPS + 1).collect()
    if len(known) > MOST_GROUPS:  # too many to send: join them
        return rows.join(counts.withColumn("_rows", F.col("_rows").cast("double")), list(groups)).filter(low).drop("_rows")
    sizes = rows.sparkSession.createDataFrame(
        [(*row[:-1], float(row[-1])) for row in known], rows.select(*groups).schema.add("_rows", "double"))
    return rows.join(F.broadcast(sizes), list(groups)).filter(low).drop("_rows")


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """``doc_id`` and a 0/1 label; repeated rows of a document take the greatest, nulls are left out."""
    return (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(column).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, size: int, seed: int, by_label: bool = False) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` of about ``size`` labelled documents that are not held out.

    With ``by_label``, ``size`` of each label. The labels are sampled first: their ids are so few
    that they are sent to the documents, which are not shuffled.
    """
    known = one_label(labels, column).filter(~held_out())
    known = sample_by_hash(known, size, seed, *(["label"] if by_label else []))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares. Only where none is set (tests), one of this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = f"file://{tempfile.mkdtemp(prefix='visitlens-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Shelf:
    """Intermediate tables in the shared folder: they cut lineage and outlive executors.

    ``keep`` writes a table and reads it back; ``drop`` deletes one that nothing will read again.
    What a lazy result still reads is deleted when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self._spark = spark
        self._root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._kept: dict[int, tuple[DataFrame, str]] = {}
        self._count = 0
        atexit.register(self.close)

    def keep(self, df: DataFrame, name: str, *parts: str) -> DataFrame:
        """The table, in a folder for every value of ``parts`` (few values)."""
        self._count += 1
        path = f"{self._root}/{name}-{self._count}"
        df.write.partitionBy(*parts).parquet(path) if parts else df.write.parquet(path)
        kept = self._spark.read.schema(df.schema).parquet(path)
        self._kept[id(kept)] = kept, path
        return kept

    def drop(self, *kept: DataFrame) -> None:
        for df in kept:
            self._delete(self._kept.pop(id(df))[1])

    def close(self) -> None:
        try:
            self._delete(self._root)
        except Exception:  # the driver's JVM has ended already
            pass

    def _delete(self, path: str) -> None:
        context = self._spark.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def slices(batch) -> Iterator:
    """The batch in parts of at most BATCH_ROWS rows and BATCH_BYTES bytes; a row is not divided."""
    for at in range(0, batch.num_rows, BATCH_ROWS):
        parts = [batch.slice(at, BATCH_ROWS)]
        while parts:
            part = parts.pop()
            half = part.num_rows // 2
            if half and part.nbytes > BATCH_BYTES:
                parts += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def map_batches(df: DataFrame, work: Callable[[Iterator], Iterator], schema) -> DataFrame:
    """``mapInArrow``: ``work`` turns an iterator of Arrow batches, cut by :func:`slices`, into another."""
    return df.mapInArrow(lambda batches: work(part for batch in batches for part in slices(batch)), schema)


def arrow_schema(ddl: str):
    """The Arrow schema of a DDL string; made on the driver, it travels to the tasks."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def rows_batch(rows: list[tuple], schema, *lead):
    """An Arrow batch of tuples, with ``lead`` arrays as its first columns."""
    import pyarrow as pa

    fields = list(schema)[len(lead):]
    columns = list(zip(*rows)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([*lead, *(pa.array(c, f.type) for c, f in zip(columns, fields))], schema.names)


def kind_of(df: DataFrame, column: str) -> str:
    """The DDL name of a column's type."""
    return df.schema[column].dataType.simpleString()
