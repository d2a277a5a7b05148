"""Helpers shared by the training-data operators.

All operators take the columns they need by name and give internal columns a
``__`` prefix, so extra columns of the caller, whatever they are called, never clash.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from feedlens.session import checkpoint_dir

CHUNK_CHARS = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one is made only where it is unset and
    the driver is the whole cluster (local tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return checkpoint_dir(spark).rstrip("/")


_written: list[str] = []     # folders of this process that ``materialise`` made


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage is
    cut and a lost executor costs no recomputation of what stands before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/feedlens/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(schema).parquet(path)


def written() -> list[str]:
    """The folders that ``materialise`` has made so far and that still stand."""
    return list(_written)


def remove_written(spark: SparkSession, paths: Sequence[str]) -> None:
    """Remove folders that ``materialise`` made, once nothing that is still to run reads them."""
    for path in paths:
        if path in _written:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
            _written.remove(path)


def with_row_key(docs: DataFrame) -> DataFrame:
    """``docs`` and ``__doc_row``: file and place of each row, which stay the same however
    often and with whichever columns the rows are read. What doesn't come straight from
    Parquet files is written first."""
    key = F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias("__doc_row")
    if not docs.inputFiles():
        docs = materialise(docs, "rows")
    try:
        return docs.select("*", key)
    except AnalysisException:
        return materialise(docs, "rows").select("*", key)


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def chunks(sizes: Sequence[int], budget: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Slices of consecutive items of about ``budget`` in all (a larger item stands alone)."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > budget:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def text_udf(returns: str, make: Callable[[], Callable[[list[str | None]], list]]):
    """Column function over texts, batched by Arrow. ``make`` is called once a task and
    gives a function from a list of texts to a list of values of the type ``returns``.

    The function sees about ``CHUNK_CHARS`` of text at a time, so a task's memory follows
    that figure and its longest text, not the rows of a batch."""
    kind = DataType.fromDDL(returns)
    arrow_kind = to_arrow_type(kind)

    @arrow_udf(kind)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for texts in batches:
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            parts = [pa.array(work(texts.slice(a, b - a).to_pylist()), arrow_kind) for a, b in chunks(sizes)]
            yield pa.concat_arrays(parts) if parts else pa.array([], arrow_kind)

    return apply


def worker_state() -> dict:
    """What a Python worker keeps from task to task. Functions that were shipped by value
    have no module of their own there, so it hangs on a name in ``sys.modules``."""
    return sys.modules.setdefault("feedlens_worker_state", types.ModuleType("feedlens_worker_state")).__dict__


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (a public 64-bit mixing function), elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


def sample_rows(df: DataFrame, bound: int, *key: str) -> DataFrame:
    """About ``bound`` rows (never over twice as many, by the law of large numbers),
    chosen by a hash of ``key``; all rows where there are fewer. For fitting only."""
    n = df.count()
    if n <= bound:
        return df
    share = int(bound / n * 1_000_000)
    return df.filter(F.pmod(F.xxhash64(F.lit(7), *key), F.lit(1_000_000)) < share)


def first_by_hash(df: DataFrame, bound: int, *key: str) -> DataFrame:
    """At most ``bound`` rows, in the order of a hash of ``key`` and of the key: the same rows
    in the same order however the table is laid out (rows of one key are alike)."""
    return df.orderBy(F.xxhash64(F.lit(8), *key), *key).limit(bound)
