"""What several operators use: scratch tables, bounded Arrow batches, words and their hashes."""

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greenshoe.session import shared_folder

# Functions that run in Python workers travel with the query; executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value of the contracts: white space is [\x20\x09-\x0D], all else belongs to words.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64

BATCH_ROWS, BATCH_BYTES = 2_000, "16m"


class Scratch:
    """Intermediate tables of one run, in the folder that the cluster shares."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def save(self, df: DataFrame, table: str) -> DataFrame:
        """Write ``df`` once and read it back: later passes survive lost executors."""
        df.write.mode("error").parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def drop(self, *tables: str) -> None:
        """Delete tables that nothing reads any more; without names all of them."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for path in [self.path(t) for t in tables] or [self.root]:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


def bounded_batches(spark: SparkSession) -> None:
    """Keep what one Arrow batch holds small, by rows and by bytes, whatever the texts' lengths.

    Changes two settings of the session, only ever to smaller values.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(name: str) -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` would change other letters too."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    is_ascii = F.octet_length(text) == F.length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(F.translate(text, upper, lower))


def per_process(name: str, make: Callable[[], object]) -> object:
    """An object that a Python worker keeps for its next tasks.

    A worker keeps one: when another is asked for, the one before is let go, so that the
    operators of a pipeline do not add up in its memory.
    """
    kept = sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state"))
    if getattr(kept, "name", None) != name:
        kept.name = kept.object = None
        kept.name, kept.object = name, make()
    return kept.object


def text_slices(data: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """A long text in slices cut at white space, so that its words are never all held at once."""
    start = 0
    while len(data) - start > size:
        cut = max(data.rfind(c, start, start + size) for c in (b" ", b"\n", b"\t", b"\r"))
        if cut <= start:
            found = [x for c in SPACES if (x := data.find(c.encode(), start + size)) >= 0]
            if not found:
                break
            cut = min(found)
        yield data[start:cut]
        start = cut
    yield data[start:]


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words, in order; the caller lower-cases."""
    parts = []
    for piece in text_slices(data):
        words = piece.split()
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), U64, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the 64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def window_hashes(hashes: np.ndarray, positions: list[int], span: int) -> np.ndarray:
    """A hash for each window of ``span`` words, of the words at ``positions`` in it."""
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    for k, i in enumerate(positions):
        factor = mixed(np.array([0x9E3779B97F4A7C15 * (k + 1) % 2**64], U64)) | U64(1)
        total += hashes[i : i + n] * factor
    return mixed(total)


def int_lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column from arrays, one per row."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
