"""Token counts of documents in flat token files without an index.

A file is a stream of token ids (16 bit, or any numpy type) in which a separator
ends each document.
The stream is read in blocks that cut documents anywhere: files are listed with
their lengths alone, and each task reads ranges of them from the shared file
system, so that a file of any size is spread over many tasks.  Each block is
searched for separators at once (numpy); a prefix scan over the blocks' summaries
adds to a block's first document what earlier blocks hold of it, and numbers
the documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.session import scratch_path

from .packing import ordinary_encoder
from .staging import stage

SEPARATOR = 50256             # <|endoftext|> of byte_bpe_50k, which no text encodes to
BLOCK_TOKENS = 1 << 18
DTYPE = "<u2"                 # ids below 65536
TASK_BYTES = 32 << 20         # of token files that a task reads, about


def write_token_files(docs: DataFrame, encoder: Callable[[], Callable[[str], list[int]]] = ordinary_encoder,
                      separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS, dtype: str = DTYPE, id_col: str = "doc_id",
                      text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Tokenise documents into one flat file per task, in the shared scratch folder.

    Returns the files' blocks (file, block, tokens: the ids as ``dtype``) and
    which document stands where (file, ordinal, doc_id).  Null texts are empty
    documents: a separator alone.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    folder = scratch_path(docs.sparkSession, "flat-tokens")
    fields = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(
        "file long, ordinal long, path string, length long")])

    def scan(batches):
        encode, file = encoder(), TaskContext.get().partitionId()
        system, name = _file_system(folder)
        system.create_dir(name, recursive=True)
        own = uuid.uuid4().hex  # a task that runs again writes another file
        ordinal = length = 0
        id_type = None
        with system.open_output_stream(f"{name}/{own}") as out:
            for batch in batches:
                id_type = batch.schema.field(0).type
                rows = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([file] * rows, pa.int64()),
                     pa.array(range(ordinal, ordinal + rows), pa.int64()), pa.nulls(rows, pa.string()),
                     pa.nulls(rows, pa.int64())], names=fields.names)
                ordinal += rows
                for text in batch.column(1):
                    length += out.write(np.array([*encode(text.as_py() or ""), separator], dtype).tobytes())
        if length:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), pa.array([file], pa.int64()), pa.nulls(1, pa.int64()),
                 pa.array([f"{folder}/{own}"]), pa.array([length], pa.int64())], names=fields.names)

    written = stage(docs.mapInArrow(scan, fields), "token-files")
    blocks = _read_blocks(written.filter("path is not null").select("file", "path", "length"), block_tokens, dtype)
    return blocks, written.filter("path is null").select("file", "ordinal", "doc_id")


def read_flat_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS,
                    dtype: str = DTYPE) -> DataFrame:
    """Blocks of raw files of ids, of any size; ``file`` is the path.

    Spark lists the files; their bytes are read with ``pyarrow.fs``, which must
    know the file system (local or mounted, hdfs, s3, gs).
    """
    listed = spark.read.format("binaryFile").load(path).select("path", "length")  # no content is read
    return _read_blocks(listed.select(F.col("path").alias("file"), "path", "length"), block_tokens, dtype)


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, with spaces and signs as they are, and the path there."""
    return fs.FileSystem.from_uri(quote(path, safe="/:@"))


def _read_blocks(files: DataFrame, block_tokens: int, dtype: str) -> DataFrame:
    """(file, block, tokens) of files (file, path, length); a task reads about ``TASK_BYTES``."""
    size = np.dtype(dtype).itemsize * block_tokens
    ranges = files.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(
        F.lit(0).cast("long"), F.expr(f"(length - 1) div {size}")))))
    tasks = -(-(files.agg(F.sum("length")).first()[0] or 1) // TASK_BYTES)
    fields = T.StructType([files.schema["file"], *T.StructType.fromDDL("block long, tokens binary")])

    def read(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                path, length, block = (batch.column(i)[k].as_py() for i in (1, 2, 3))
                wanted = min(size, length - block * size)
                system, name = _file_system(path)
                with system.open_input_file(name) as file:
                    tokens = file.read_at(wanted, block * size)
                if len(tokens) != wanted:
                    raise OSError(f"{path} is shorter than when it was listed")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), batch.column(3).slice(k, 1), pa.array([tokens], pa.binary())],
                    names=fields.names)

    # A fixed number of partitions: by their few bytes the ranges would all go to one.
    return ranges.repartition(tasks, "file", "block").mapInArrow(read, fields)


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = DTYPE) -> DataFrame:
    """Tokens of each document before its separator.

    ``blocks``: file, block (order within the file), tokens.  Returns file,
    ordinal (of the document in its file, from 0), n_tokens, complete (false for
    what follows a file's last separator; such a part is returned if it has
    tokens).  Empty and null blocks are allowed; two separators in a row hold an
    empty document; an empty table gives an empty result.
    """
    keys = T.StructType([blocks.schema["file"], blocks.schema["block"]])
    fields = T.StructType([*keys, *T.StructType.fromDDL("n_ends long, tail long, counts array<long>")])

    def scan(batches):
        for batch in batches:
            ends, tails, counts = [], [], []
            for tokens in batch.column(2):
                ids = np.frombuffer(tokens.as_buffer(), dtype) if tokens.is_valid else np.empty(0, dtype)
                at = np.flatnonzero(ids == separator)
                ends.append(len(at))
                tails.append(len(ids) - (int(at[-1]) + 1 if len(at) else 0))
                counts.append(np.diff(at, prepend=-1) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ends, pa.int64()), pa.array(tails, pa.int64()),
                 pa.array(counts, pa.list_(pa.int64()))], names=fields.names)

    found = stage(blocks.select("file", "block", "tokens").mapInArrow(scan, fields), "separators")
    # Prefix scan over one small row per block: a block with a separator begins a new segment.
    so_far = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    previous = Window.partitionBy("file").orderBy("block")
    sums = (found.select("file", "block", "n_ends", "tail")
            .withColumn("segment", F.sum((F.col("n_ends") > 0).cast("long")).over(so_far))
            .withColumn("first", F.coalesce(F.sum("n_ends").over(before), F.lit(0))))
    segment = Window.partitionBy("file", "segment").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    sums = (sums.withColumn("held", F.sum("tail").over(segment))
            .withColumn("carried", F.coalesce(F.lag("held").over(previous), F.lit(0))))
    complete = (found.filter("n_ends > 0").select("file", "block", "counts")
                .join(sums.select("file", "block", "first", "carried"), ["file", "block"])
                .select("file", "first", "carried", F.posexplode("counts").alias("k", "n"))
                .select("file", (F.col("first") + F.col("k")).alias("ordinal"),
                        (F.col("n") + F.when(F.col("k") == 0, F.col("carried")).otherwise(0)).alias("n_tokens"),
                        F.lit(True).alias("complete")))
    last = Window.partitionBy("file").orderBy(F.desc("block"))
    open_end = (sums.withColumn("last", F.row_number().over(last)).filter("last = 1 and held > 0")
                .select("file", (F.col("first") + F.col("n_ends")).alias("ordinal"),
                        F.col("held").alias("n_tokens"), F.lit(False).alias("complete")))
    return complete.unionByName(open_end)


def document_token_counts(docs: DataFrame, encoder: Callable[[], Callable[[str], list[int]]] = ordinary_encoder,
                          separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS,
                          dtype: str = DTYPE) -> DataFrame:
    """Write ``docs`` as token files, scan those, and give each document its count."""
    blocks, places = write_token_files(docs, encoder, separator, block_tokens, dtype)
    counts = count_tokens(blocks, separator, dtype)
    return places.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")
