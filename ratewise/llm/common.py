"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.session import scratch_path

#: Rows that one step of a Python task holds at most; the byte bound usually cuts earlier.
STEP_ROWS = 2000
STEP_BYTES = 4 << 20

#: Remainder of crc32(doc_id as text) modulo FOLDS that is held out from all fits.
FOLDS, HELD_OUT_FOLD = 4, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents that no fit may see; a null id is never held out."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(memos: bool = False) -> None:
    """Give memory that a task has freed back to the machine, as worker processes live on. ``memos``: the word memo of other operators too."""
    words = sys.modules.get("ratewise.llm.vocab")
    if memos and words is not None:
        words.word_ids.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):  # glibc only
        libc.malloc_trim(0)


def steps(batches: Iterator[pa.RecordBatch], text: str, most_rows: int = STEP_ROWS, most_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of bounded rows and bytes (of column ``text``); a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and (held + size > most_bytes or i - start >= most_rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)
