"""What the operators share: reading tables, naming columns, running Python on Arrow batches."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.session import scratch_dir

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column of a DataFrame by its name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(name: str, *frames: DataFrame) -> str:
    """The name, lengthened until no column of the frames has it."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id (long) and text (null becomes empty); whatever else the table has stays out."""
    return docs.select(
        column(id_col).cast("long").alias("doc_id"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    )


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator], schema: str
) -> DataFrame:
    """mapInArrow; function yields dicts of columns, which become batches of the schema.

    Workers import this package. On a cluster it is installed or passed with --py-files; a
    session on this machine is told where it lies.
    """
    _prepare(df.sparkSession)
    names = [field.split()[0] for field in schema.split(", ")]
    types = {name: _arrow_type(field.split()[1]) for name, field in zip(names, schema.split(", "))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches):
            arrays = [
                columns[n] if isinstance(columns[n], pa.Array) else pa.array(columns[n], types[n])
                for n in names
            ]
            yield pa.RecordBatch.from_arrays(
                [a if a.type == types[n] else a.cast(types[n]) for n, a in zip(names, arrays)], names
            )
        give_back()

    return df.mapInArrow(run, schema)


def filter_rows(df: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of df, with all columns, for which keep says true."""
    _prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(batch), pa.bool_()))
        give_back()

    return df.mapInArrow(run, df.schema)


def give_back() -> None:
    """Hands freed memory to the system at the end of a task: a worker waits for its next one beside
    others and the executor's heap, and would keep what its largest task took."""
    pa.default_memory_pool().release_unused()
    try:
        trim = ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return  # another C library
    trim(0)


# A batch of long texts and what is made of it must fit a worker several times over.
ROWS_PER_BATCH = 2000


def import_here(spark: SparkSession) -> None:
    """Lets workers on this machine import the package."""
    if spark.sparkContext.master.split("[")[0] == "local":
        spark.sparkContext.environment.setdefault("PYTHONPATH", PACKAGE_ROOT)


def _prepare(spark: SparkSession) -> None:
    """Workers import the package; small batches in a session that leaves their size at Spark's
    default."""
    import_here(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(ROWS_PER_BATCH))


def _arrow_type(name: str) -> pa.DataType:
    return {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
        "array<long>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()),
    }[name]


def saved(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared scratch folder and read again: cuts the lineage, survives executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Ranges:
    """Ranges of a long, numbered from 0 up: range r holds what exceeds r of the cuts."""

    cuts: tuple[int, ...]

    @property
    def width(self) -> int:
        return len(self.cuts) + 1

    def of(self, key: Column) -> Column:
        cuts = F.array(*[F.lit(cut) for cut in self.cuts]).cast("array<long>")
        return F.size(F.filter(cuts, lambda cut: key > cut))


def ranges(df: DataFrame, key: Column) -> Ranges:
    """Ranges of about equal numbers of rows, as many as there are shuffle partitions; the driver
    gets the cuts."""
    width = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [number / width for number in range(1, width)]
    cuts = df.select(F.percentile_approx(key, shares, 10000).alias("c")).first()["c"]
    return Ranges(tuple(sorted(set(cuts or []))))


class Bitmap:
    """A set of 64-bit hashes as a fixed number of bits, small enough to broadcast at any size.

    It answers yes for every member and sometimes for others, so it only spares work that an
    exact step repeats; a bitmap too small for its data spares less and changes no result.
    """

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    @classmethod
    def of(cls, df: DataFrame, column: str | Column, bits: int = 26) -> Bitmap:
        """The driver gets one long for each 64 bits at most: 8 MB for 2**26 bits."""
        key = F.shiftrightunsigned(F.col(column) if isinstance(column, str) else column, 64 - bits)
        words = (
            df.select(F.shiftright(key, 6).cast("int").alias("w"), (key % 64).cast("int").alias("b"))
            .groupBy("w")
            .agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("v"))
            .toArrow()
        )
        table = np.zeros(1 << (bits - 6), np.int64)
        table[words["w"].to_numpy()] = words["v"].to_numpy()
        return cls(table.view(np.uint64), bits)

    def __reduce__(self):
        """Broadcast compressed: a bitmap of few members is a few bytes then."""
        return _thawed, (zstandard.ZstdCompressor(level=1).compress(self.words.tobytes()), self.bits)

    @classmethod
    def none(cls) -> Bitmap:
        return cls(np.zeros(1, np.uint64), 6)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        key = hashes.astype(np.uint64, copy=False) >> np.uint64(64 - self.bits)
        word = self.words[(key >> np.uint64(6)).astype(np.int64)]
        return (word >> (key & np.uint64(63))) & np.uint64(1) != 0


def _thawed(words: bytes, bits: int) -> Bitmap:
    return Bitmap(np.frombuffer(zstandard.ZstdDecompressor().decompress(words), np.uint64), bits)


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: spreads what little differs over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
