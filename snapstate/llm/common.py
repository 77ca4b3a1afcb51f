"""What the corpus operators share: scratch tables, salted group statistics, distributed prefix sums."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The white space of the word rules, as a Java character class.
SPACE = r"\x20\x09-\x0D"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder in spark.checkpoint.dir. Only a session without executors of its own (tests) gets a local one
    where that is unset; elsewhere it is an error, as executors do not share the driver's folders."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="snapstate-"))
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
    return known.get()


def _own_scratch(spark: SparkSession) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/snapstate-{spark.sparkContext.applicationId}"


def purge(spark: SparkSession) -> None:
    """Deletes every table that this application's keep() wrote, when its results have been stored or read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keep(df: DataFrame, name: str, rows: int | None = None, rows_each: int = 50_000, partition_by: str | None = None) -> DataFrame:
    """Writes df to the shared folder and rereads it: the lineage ends here and lost executors lose nothing.

    With `rows`, a bound of how many there are, no more files are written than have rows_each rows. With partition_by,
    an int column, its values are folders, and a filter on it reads only its own.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // rows_each)))
    path = f"{_own_scratch(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_each(frames: Iterable[DataFrame], name: str) -> DataFrame:
    """Writes frames of one schema one after the other and rereads them as one."""
    path, last = None, None
    for last in frames:
        path = path or f"{_own_scratch(last.sparkSession)}/{name}-{uuid.uuid4().hex}"
        last.write.mode("append").parquet(path)
    return last.sparkSession.read.schema(last.schema).parquet(path)


def drop_kept(df: DataFrame) -> None:
    """Deletes the files of a table made by keep()."""
    spark = df.sparkSession
    jvm = spark._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of finished phases; it waits for the driver's garbage otherwise."""
    gc.collect()
    spark._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def packed(docs: DataFrame) -> Column:
    """All columns of docs as one struct, so that no name of theirs meets a helper column's."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 5: the rows with 0 are held out of learning."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")) % 5


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")


def with_group(rows: DataFrame, keys: list[str], salt_on: list[str], aggs: dict[str, tuple[Column, str]], having: str | None = None, salts: int = 256) -> DataFrame:
    """Each row with statistics of its group, of groups that meet `having`; keys must not be null.

    aggs: name -> (aggregate of the rows, name of the SQL function that joins partial ones). A group is dealt over
    `salts` parts: partial aggregates per (group, part) meet in a window of at most `salts` rows a group, and rows
    find their part's copy by (group, part), so that no task gets a whole hot group.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    part = salted.groupBy(*keys, "_salt").agg(*[a.alias(n) for n, (a, _) in aggs.items()])
    whole = Window.partitionBy(*keys)
    full = part.select(*keys, "_salt", *[F.expr(f"{again}({n})").over(whole).alias(n) for n, (_, again) in aggs.items()])
    return salted.join(full.where(having) if having else full, [*keys, "_salt"]).drop("_salt")


def content_order() -> Column:
    """A hex string that orders rows at random, but alike in every run: md5 of doc_id and text. Rows of one doc_id, or
    of one text, are spread like others."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), whole_text()))


def running(rows: DataFrame, group: str, order: str, ties: list[str], value: str, name: str, bits: int = 8, bucket: Column | None = None) -> DataFrame:
    """Adds `name`: the sum of `value` over the rows before this one in its group (exclusive prefix sum).

    Rows are ordered by `order`, then `ties`. Each group is split into buckets: by the first `bits` bits (16 at most) of
    `order`, a hex string, or by `bucket`, any int that rises with the order. Bucket totals are summed first, and each
    bucket is finished on its own, so a group of any size is spread over 2**bits tasks.
    """
    if bucket is None:
        bucket = F.shiftright(F.conv(F.substring(order, 1, 4), 16, 10).cast("int"), 16 - bits)
    cut = rows.withColumn("_bucket", bucket)
    total = cut.groupBy(group, "_bucket").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = total.select(group, "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(group, "_bucket").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    out = cut.join(start, [group, "_bucket"])
    return out.withColumn(name, F.col("_start") + F.coalesce(F.sum(value).over(inner), F.lit(0))).drop("_bucket", "_start")


def bucket_bits(n_rows: int, rows_each: int = 20_000) -> int:
    """So many bits that a bucket of running() has about rows_each rows, between 6 and 16."""
    return min(16, max(6, (max(1, n_rows) // rows_each).bit_length() + 1))


def groups_of(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of the rows of one key each, from Arrow batches sorted by that key; a group may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        at = 0
        for end in [*((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist(), len(keys)]:
            if held and keys[at] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(at, end - at))
            last, at = keys[at], end
    if held:
        yield pa.Table.from_batches(held)
