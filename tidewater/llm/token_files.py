"""Token ids in Parquet list columns, in document order, with selective reads.

One file per range of doc_id: rows ascending by doc_id, ids dictionary-encoded
in bounded row groups and pages with column indexes, the small columns
delta-encoded.  Token counts and places can be read without the ids, and a
range of documents without the other row groups and pages.

Defined cases: null text is empty (only the end id); a null doc_id sorts
first; repeated rows are written each, ties ordered by text; an empty table
gives an empty folder of files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import pieces, shared_path, table
from tidewater.llm.tokens import public_file, tokenizer

END_ID = 1
STEP = 256
#: Text in one file, row groups and pages in bytes.
FILE_BYTES = 48 << 20
LAYOUT = {
    "parquet.block.size": str(8 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.writer.version": "v2",  # delta encoding for the columns without a dictionary
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "compression": "zstd",
}
FILE = "doc_id long, file_no int, start_in_file long, n_tokens long, ids array<int>"


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, words, start = TaskContext.get().partitionId(), tokenizer(path, False), 0
    end = np.array([END_ID], dtype="<u4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            some = batch.slice(at, STEP)
            ids = [x + end for x in words.encode(some.column(1).to_pylist())]
            n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            ends = np.cumsum(n)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                pa.array(np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32)),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0).cast(pa.int64()),
                    pa.array(np.full(len(n), part, dtype=np.int32)),
                    pa.array(start + ends - n),
                    pa.array(n),
                    lists,
                ],
                names=["doc_id", "file_no", "start_in_file", "n_tokens", "ids"],
            )
            start += int(ends[-1]) if len(ends) else 0


def write_tokens(documents: DataFrame, path: str, tokenizer_path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write the documents' ids as ascending ranges of doc_id, a file for each."""
    docs = documents.select("doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # by doc_id alone: the partitioner's sample goes to the driver, and rows of one id share a file
    ordered = docs.repartitionByRange(pieces(total, file_bytes), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(lambda b: _encode(b, tokenizer_path), FILE).write.options(**LAYOUT).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens of every document; the ids are not read."""
    rows = spark.read.schema(FILE).parquet(path).select("doc_id", "file_no", "start_in_file", "n_tokens")
    return rows.join(_bases(spark, path), "file_no").select(
        "doc_id", (F.col("base") + F.col("start_in_file")).alias("start"), "n_tokens"
    )


def read_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """doc_id, ids of the documents first..last; other row groups and pages are skipped by their indexes."""
    return spark.read.schema(FILE).parquet(path).where(F.col("doc_id").between(first, last)).select("doc_id", "ids")


def _bases(spark: SparkSession, path: str) -> DataFrame:
    """file_no, base: ids in all files before it.  A row for each file."""
    sizes = spark.read.schema(FILE).parquet(path).groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def _crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        cuts = lists.offsets.to_numpy()
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
        kept = batch.select(["doc_id", "file_no", "start_in_file", "n_tokens"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(crc, type=pa.int64())], names=[*kept.schema.names, "ids_crc32"]
        )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "op10-tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_file("word_bpe_49k.json"))
    read = spark.read.schema(FILE).parquet(path).mapInArrow(
        _crcs, "doc_id long, file_no int, start_in_file long, n_tokens long, ids_crc32 long"
    )
    return read.join(_bases(spark, path), "file_no").select(
        "doc_id", (F.col("base") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32"
    )
