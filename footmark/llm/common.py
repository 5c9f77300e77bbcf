"""Helpers shared by the operators: lineage cuts, Arrow batch bounds, 64-bit hashing."""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footmark.session import configure, ensure_checkpoint_dir

#: Rows and bytes of one Arrow batch handed to a Python worker.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20
#: Code points processed by one vectorised step.
CHUNK_CHARS = 1 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators rely on (bounded Arrow batches)."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def new_path(spark: SparkSession, name: str) -> str:
    """An unused folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


#: Folders of the tables that were cut, for as long as their DataFrame lives.
_CUTS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    _CUTS[out] = path
    for scope in _SCOPES:
        scope.paths[path] = spark
    return out


def remove(df: DataFrame) -> None:
    """Delete the table that ``cut`` wrote for ``df``, after its last reader."""
    path = _CUTS.pop(df, None)
    if path:
        _delete(df.sparkSession, path)
        for scope in _SCOPES:
            scope.paths.pop(path, None)


def _delete(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:  # the session has ended
        return
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scope:
    """The tables that are cut while it is entered (``with scope:``) and not removed by then.

    ``clear`` removes them, but for those that ``keep`` reads."""

    def __init__(self):
        self.paths: dict[str, SparkSession] = {}

    def __enter__(self):
        _SCOPES.append(self)
        return self

    def __exit__(self, *error):
        _SCOPES.remove(self)

    def clear(self, keep: DataFrame | None = None) -> None:
        read = "\n".join(keep.inputFiles()) if self.paths and keep is not None else ""
        for path, spark in list(self.paths.items()):
            if path.rsplit("/", 1)[1] not in read:
                _delete(spark, path)
                del self.paths[path]


_SCOPES: list[Scope] = []


#: Files of a table whose rows are numbered by file (their paths go to the driver).
FILES = 100_000


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a unique row number in one more column, and that column's name.

    Rows of a Parquet table are numbered by their place in their file, which is the same in every
    scan however files are split, and costs no copy of the rows. Other rows (a plan that isn't a plain
    scan, or over FILES files) get a number that is written with them."""
    spark, key = docs.sparkSession, unused("row", docs.columns)
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            meta = docs.metadataColumn("_metadata")
            placed = docs.select("*", meta["file_path"].alias(unused("file", [*docs.columns, key])), meta["row_index"].alias(key))
        except AnalysisException:  # a file format without row places
            placed = None
        if placed is not None:
            file = placed.columns[-2]
            paths = sorted(r[0] for r in placed.select(quoted(file)).distinct().limit(FILES + 1).collect())
            if paths and len(paths) <= FILES:
                numbers = F.broadcast(spark.createDataFrame(list(zip(paths, range(len(paths)))), f"{quoted(file)} string, number long"))
                names = [F.col(f"d.{quoted(c)}") for c in docs.columns]
                placed = placed.alias("d").join(numbers.alias("n"), F.col(f"d.{quoted(file)}") == F.col(f"n.{quoted(file)}"))
                return placed.select(*names, (F.col("n.number") * (1 << 40) + F.col(f"d.{quoted(key)}")).alias(key)), key
    return cut(docs.withColumn(key, F.monotonically_increasing_id()), "rows"), key


def columns_of(docs: DataFrame) -> list:
    """The columns of ``docs`` under their whole names."""
    return [F.col(quoted(c)) for c in docs.columns]


def quoted(name: str) -> str:
    """A column name as Spark's expressions take it whole (dots and backticks included)."""
    return "`" + name.replace("`", "``") + "`"


def unused(name: str, taken) -> str:
    """``name``, with underscores in front until no column (in any case) is called so."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out_col(doc_id: str = "doc_id"):
    """True for rows whose crc32(doc_id as text) mod 4 is 2 (a null id is not held out)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null reads as empty."""
    return [t or "" for t in column.to_pylist()]


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts have about ``limit`` characters together (one text at least)."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def codepoints(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The joined text, its code points, and where each text starts (one more entry for the end)."""
    joined = "".join(texts)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    off = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    return joined, cp, off


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA24BAED4963EE407)
    return x ^ (x >> np.uint64(32))


def _points() -> np.ndarray:
    """A random-looking 64-bit number for each code point."""
    global _POINTS
    if _POINTS is None:
        _POINTS = mix(np.arange(0x110000, dtype=np.uint64), 21)
    return _POINTS


_POINTS = None
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        base = np.full(max(n, 4096), 0x9FB21C651E98DF25, dtype=np.uint64)
        base[0] = 1
        _POWERS = np.cumprod(base, dtype=np.uint64)
    return _POWERS


def hash_runs(cp: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the consecutive runs of ``cp`` that begin at ``starts`` (starts[0] = 0)."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lens = np.diff(np.append(starts, len(cp)))
    pos = np.ones(len(cp), dtype=np.int32)  # position in the run, by running sums that restart
    pos[0] = 0
    pos[starts[1:]] = 1 - lens[:-1]
    v = _points()[cp]
    v *= _powers(int(lens.max()))[np.cumsum(pos, out=pos)]
    return mix(np.add.reduceat(v, starts) + lens.astype(np.uint64))


def separators(cp: np.ndarray) -> np.ndarray:
    """True at the characters that separate words: space and U+0009 to U+000D."""
    return (cp == 32) | ((cp >= 9) & (cp <= 13))


def word_starts(cp: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word character mask, word start positions, index of each text's first word, with the end)."""
    mask = ~separators(cp)
    start = mask.copy()
    if len(cp):
        start[1:] &= ~mask[:-1]
        first = off[:-1][off[:-1] < off[1:]]
        start[first] = mask[first]
    pos = np.flatnonzero(start)
    return mask, pos, np.searchsorted(pos, off)


def words_hash(cp: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the index of each text's first word (with the end)."""
    mask, pos, woff = word_starts(cp, off)
    if not len(pos):
        return np.zeros(0, dtype=np.uint64), woff
    return hash_runs(cp[mask], (np.cumsum(mask)[pos] - 1)), woff


def lower_ascii(cp: np.ndarray) -> np.ndarray:
    return np.where((cp >= 65) & (cp <= 90), cp + np.uint32(32), cp)
