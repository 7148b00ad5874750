"""What the operators of this subpackage share: tables, expressions, durable cuts and byte-level kernels."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_OWN_DIR: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound what one Arrow batch holds, by rows and bytes, since a text may have megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = "file://" + tempfile.mkdtemp(prefix="tessaline-")
    return _OWN_DIR[app]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


_SWEPT: set[str] = set()


def new_path(spark: SparkSession, what: str) -> str:
    """A path of its own below the application's folder, which goes when the driver ends: a result may be read until then."""
    top = f"{shared_dir(spark)}/tessaline/{spark.sparkContext.applicationId}"
    if top not in _SWEPT:
        _SWEPT.add(top)
        atexit.register(lambda: spark.sparkContext._jsc is None or _delete(spark, top))
    return f"{top}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame, what: str) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends in files that outlive executors."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessaline_path = path
    return out


def drop_cut(*frames: DataFrame) -> None:
    """Delete the files of cuts that nothing reads any more, and let Spark clear unreferenced shuffles, once for all of them."""
    for df in frames:
        if path := getattr(df, "_tessaline_path", None):
            _delete(df.sparkSession, path)
    release(frames[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Shuffle files stay until the driver collects its garbage; ask for that after a large step."""
    gc.collect()
    spark._jvm.System.gc()


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is. lower() does the same, and faster, where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, mod parts; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


# ---------------------------------------------------------------- byte-level kernels (numpy)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_OTHER = np.ones(256, bool)
_OTHER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = np.uint64(pow(int(_MULT), -1, 1 << 64))
        for name, base in (("up", _MULT), ("down", inverse)):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _POWERS[name] = np.multiply.accumulate(step)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over all 64 (two multiply and shift rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with (H[e] - H[s]) * down[s] the polynomial hash of data[s:e]."""
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(0x1F3)) * up[: len(data)], out=out[1:])
    return out


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with a space after each, as one array, and where each starts (one more entry: the end)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return data, starts


def words_of(texts: list[bytes], alphanumeric: bool = False, prefixes: tuple[int, ...] = (), forms: bool = False) -> tuple[np.ndarray, ...]:
    """(hash, start, end) of each word, A-Z lowered, and the number of words before each text (one more entry).

    With prefixes, hash has a column for the word and one for each prefix length in bytes (0 where the word is shorter).
    Words are runs of anything but white space, or of digits, letters and all beyond ASCII. With forms, a last array has the
    hash of each word's last three bytes (all, if it has fewer).
    """
    data, starts = joined(texts)
    data = _LOWER[data]
    space = (_OTHER if alphanumeric else _SPACE)[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([1], space.view(np.int8), [1]))))
    begin, end = edge[0::2], edge[1::2]
    total = prefix_hash(data)
    _, down = _powers(len(data) + 1)
    value = mix64((total[end] - total[begin]) * down[begin])
    if prefixes:
        columns = [value]
        for n in prefixes:
            stop = np.minimum(begin + n, len(data))
            part = mix64(((total[stop] - total[begin]) * down[begin]) ^ np.uint64(n * 0x51_7CC1_B727))
            columns.append(np.where(end - begin >= n, part, np.uint64(0)))
        value = np.column_stack(columns)
    bounds = np.searchsorted(begin, starts)
    if forms:
        tail = np.maximum(begin, end - 3)
        return value, begin, end, bounds, mix64(((total[end] - total[tail]) * down[tail]) ^ np.uint64(0x2545_F491_4F6C))
    return value, begin, end, bounds


def chunks(rows: list, size_of, limit: int = 1 << 21):
    """Split rows into runs of about limit bytes, at least one row each."""
    run, total = [], 0
    for row in rows:
        run.append(row)
        total += size_of(row)
        if total >= limit:
            yield run
            run, total = [], 0
    if run:
        yield run
