"""Token ids of a corpus as files of Huffman-coded blocks, written and read back."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outagelens.llm import tokens
from outagelens.llm.huffman import Code, code_lengths
from outagelens.llm.shared import stored


@dataclass(frozen=True)
class Format:
    """``longest``: bits of a code at most (17 at least, to hold any 16-bit id). ``block_ids``:
    a block closes with the document that reaches so many ids. ``file_ids``: ids of a file,
    about."""

    longest: int = 18
    block_ids: int = 1 << 16
    file_ids: int = 1 << 24


#: a row is a block of whole documents; files hold them in order
BLOCK = "file int, block int, doc_ids array<long>, sizes array<long>, n long, lanes binary, payload binary"
CODE = "lengths binary"


def _counts(coded: DataFrame) -> np.ndarray:
    """How often each id occurs: counted in the tasks, summed by id, one row per id."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for data in batch.column("ids"):
                seen = np.bincount(tokens.unpacked(data.as_py()))
                if len(seen) > len(total):
                    total = np.concatenate([total, np.zeros(len(seen) - len(total), dtype=np.int64)])
                total[: len(seen)] += seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["token", "n"])

    rows = coded.select("ids").mapInArrow(work, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    found = rows.toArrow()  # as many rows as the vocabulary has ids
    counts = np.zeros(int(max(found.column("token").to_numpy(), default=-1)) + 1, dtype=np.int64)
    counts[found.column("token").to_numpy()] = found.column("n").to_numpy()
    return counts


def _blocks(lengths: np.ndarray, form: Format):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, file, block = Code(lengths), TaskContext.get().partitionId(), 0
        ids, doc_ids, sizes, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            payload, lanes = code.encode(np.concatenate(ids))
            return pa.RecordBatch.from_pylist(
                [{"file": file, "block": block, "doc_ids": doc_ids, "sizes": sizes, "n": held, "lanes": lanes, "payload": payload}],
                schema=pa.schema([("file", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                                  ("sizes", pa.list_(pa.int64())), ("n", pa.int64()), ("lanes", pa.binary()), ("payload", pa.binary())]))

        for batch in batches:
            for doc_id, data in zip(batch.column("id").to_pylist(), batch.column("ids"), strict=True):
                own = tokens.unpacked(data.as_py())
                ids.append(own)
                doc_ids.append(doc_id)
                sizes.append(len(own))
                held += len(own)
                if held >= form.block_ids:
                    yield closed()
                    block += 1
                    ids, doc_ids, sizes, held = [], [], [], 0
        if doc_ids:
            yield closed()
    return work


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, form: Format = Format(),
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of all texts, each with ``end_id`` behind it, in ascending id order.

    Below ``path``, ``blocks`` holds rows of ``BLOCK`` and ``code`` the code's lengths. The
    rows stand in Parquet files: the blocks go wherever Spark writes, and only files of
    finished tasks are seen. Texts are tokenized once; the packed ids are kept while they
    are counted, then dealt to files by ranges of ids and coded there.

    Defined results: a null text is empty and holds the end id alone. A null id comes first.
    Rows that share an id stand side by side, in order of their hashed texts.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("order"), text.alias("body"))
    coded = stored(tokens.with_ids(rows, tokenizer, end_id))
    counts = _counts(coded)
    lengths = code_lengths(counts, form.longest)
    files = max(1, -(-int(counts.sum()) // form.file_ids))
    spark = docs.sparkSession
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], CODE).coalesce(1).write.mode("overwrite").parquet(f"{path}/code")
    (
        coded.repartitionByRange(files, "id").sortWithinPartitions("id", "order").select("id", "ids")
        .mapInArrow(_blocks(lengths, form), BLOCK).write.mode("overwrite").parquet(f"{path}/blocks")
    )


def _documents(lengths: np.ndarray):
    """(file, block, place, doc_id, start in its block, n_tokens, ids_crc32) from blocks."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                data = tokens.crc_bytes(code.decode(row["payload"], row["lanes"], row["n"]))
                sizes = np.array(row["sizes"], dtype=np.int64)
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(memoryview(data)[4 * (e - n) : 4 * e]) for e, n in zip(ends, sizes, strict=True)]
                k = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, row["file"], np.int32)), pa.array(np.full(k, row["block"], np.int32)),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(ends - sizes), pa.array(sizes), pa.array(crcs, pa.int64())],
                    names=["file", "block", "doc_id", "inner", "n_tokens", "ids_crc32"])
    return work


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. Blocks decode by themselves; their
    offsets come from their counts: within a file, then over files.
    """
    lengths = np.frombuffer(spark.read.schema(CODE).parquet(f"{path}/code").first()["lengths"], dtype=np.uint8)
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    sizes = blocks.select("file", "block", "n")
    earlier = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    files = sizes.groupBy("file").agg(F.sum("n").alias("n")).select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("file_start"))
    inside = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        sizes.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(files, "file")
        .select("file", "block", (F.col("file_start") + F.col("inside")).alias("block_start"))
    )
    docs = blocks.mapInArrow(_documents(lengths), "file int, block int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["file", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids): the decoded ids of every document."""
    lengths = np.frombuffer(spark.read.schema(CODE).parquet(f"{path}/code").first()["lengths"], dtype=np.uint8)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                ids = code.decode(row["payload"], row["lanes"], row["n"]).astype(np.int64)
                ends = np.append(0, np.cumsum(row["sizes"])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))],
                    names=["doc_id", "ids"])

    return spark.read.schema(BLOCK).parquet(f"{path}/blocks").mapInArrow(work, "doc_id long, ids array<long>")
