"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared ``spark.checkpoint.dir``."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tenure-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it back.

    Written files survive lost executors, and a retried task writes its part anew.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def marks(hashes: DataFrame, each: int = 32, most: int = 1 << 26):
    """A bitmap (NumPy words) with a bit for each 64-bit hash in the one column of ``hashes``.

    It has about ``each`` bits a hash, at most ``most`` (8 MB): with more hashes it only lets more through.
    """
    import numpy as np

    size = 1 << max(12, (min(most, each * hashes.count()) - 1).bit_length())
    bits = hashes.select(F.col(hashes.columns[0]).bitwiseAND(size - 1).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word"))
    found = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")).toArrow()
    out = np.zeros(size >> 6, np.uint64)
    out[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return out


def marked(words, hashes):
    """For each hash (NumPy, 64 bits) whether ``marks`` may have had it: never false if so."""
    import numpy as np

    bit = hashes.view(np.uint64) & np.uint64(len(words) * 64 - 1)
    return (words[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id's text leaves remainder 0 modulo 5 (null ids: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Memo(dict):
    """``memo[key]`` computes and keeps ``make(key)``.

    At most two generations of ``size`` keys are held, and keys over
    ``longest`` characters are not kept, so the memory is bounded whatever
    the texts hold.
    """

    def __init__(self, make: Callable, size: int = 300_000, longest: int = 48):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(key) > self.longest:
            return
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value


def slices(batch, column: str, most_bytes: int = 8 << 20) -> Iterator:
    """Cut an Arrow record batch into runs of rows whose texts hold about ``most_bytes``."""
    start = size = 0
    for i, value in enumerate(batch.column(column)):
        n = len(value.as_buffer()) if value.is_valid else 0
        if size and size + n > most_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def sample_ids(df: DataFrame, most: int, id_col: str = "id", salt: int = 0) -> DataFrame:
    """At most ``most`` distinct ids, those of smallest hash (a bounded table)."""
    return df.select(id_col).where(F.col(id_col).isNotNull()).distinct().orderBy(F.xxhash64(id_col, F.lit(salt)), id_col).limit(most)


def without_copies(texts: list[str], seen: set | None = None, words: int = 6) -> list[str]:
    """Texts that share no run of ``words`` words with an earlier one."""
    seen = set() if seen is None else seen
    out = []
    for text in texts:
        w = text.lower().split()
        runs = {hash(tuple(w[i : i + words])) for i in range(max(1, len(w) - words + 1))}
        if not runs & seen:
            out.append(text)
        seen |= runs
    return out


def logistic(x, y, ridge: float = 1e-2, steps: int = 50):
    """Weights (the last is the intercept) of a ridge logistic regression by Newton steps."""
    import numpy as np

    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
