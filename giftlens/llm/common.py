"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.session import scratch_path

# Lower-cases A-Z and turns every ASCII byte outside [0-9a-z] into a blank.
# Bytes from 0x80 on (all of a non-ASCII character's UTF-8 bytes) stay, so
# splitting on blanks gives the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ .
WORD_BYTES = bytes(
    (b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32)
    for b in range(256)
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Run ``df`` once and cut its lineage by a table in the shared folder
    (never on an executor's own disk).  Unlike a checkpoint's, its files are
    compressed, later steps read only the columns they use, and small files
    are read together, so a step over few rows has few tasks."""
    return store(df, "cut")


def store(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``cut`` with a name for the folder, and a codec for large tables of text."""
    path = scratch_path(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_dealt(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """``store`` with the rows dealt by ``keys`` into as many parts as a shuffle has:
    joins on ``keys`` read them where they are and move only the other side."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    table, parts = "giftlens_" + path.rsplit("/", 1)[-1].replace("-", "_"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").option("path", path).bucketBy(parts, *keys).saveAsTable(table, format="parquet")
    return spark.table(table)


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased words of letters, digits and non-ASCII characters."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def blank_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased (``bytes.lower`` and
    ``bytes.split`` are ASCII-only, which is what is wanted)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``keys``, across batch borders.  The rows
    must come sorted by the keys; one run is held in memory at a time."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        if rest is not None:
            t = pa.concat_tables([rest, t]).combine_chunks()
        new = np.zeros(t.num_rows, dtype=bool)
        for k in keys:
            col = t.column(k).combine_chunks()
            col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
            codes = col.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            new[1:] |= codes[1:] != codes[:-1]
        starts = np.flatnonzero(new)
        begin = 0
        for s in starts:
            yield t.slice(begin, s - begin)
            begin = int(s)
        rest = t.slice(begin)
    if rest is not None and rest.num_rows:
        yield rest


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]):
    """Join condition on columns where null equals null."""
    cond = None
    for a, b in pairs:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def ascii_lower(col):
    """A-Z to a-z and nothing else (``lower`` would also change other scripts)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
