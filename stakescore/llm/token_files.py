"""Token-id files: frequency-ranked ids, byte-aligned variable length, control bytes apart.

Ids are replaced by their rank in the corpus's frequency, so that frequent ids are small numbers. A number
takes one to four bytes; its length less one is two bits of a control byte, four numbers to a control byte,
and control bytes and data bytes are stored apart. Decoding looks the control bytes up in a table of 256
entries and gathers the data bytes; no number is read alone.

A folder holds ``ranks`` (rank, id) and ``blocks``. A block has the documents that follow each other in
ascending id order, as many as make up ``BLOCK_TOKENS`` ids (a longer document is a block of its own):
shard and block number, document ids, lengths, control and data bytes.

Nulls and ties: a null text is an empty one (only the end id); a null document id comes first; documents of
equal id stay apart, in the order of their ids' length and checksum; an empty table gives no block.
Only the columns named are read, so others may have any name. Null ``n_tokens`` do not occur.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from stakescore import staging
from stakescore.llm.word_ids import encoded, word_encoder

BLOCK_TOKENS = 1 << 16

#: Of each control byte: the lengths of its four numbers.
LENGTHS = 1 + (np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3).astype(np.uint8)


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths, dtype=np.int64) - lengths


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    numbers = np.ascontiguousarray(numbers, "<u4")
    longer = [np.flatnonzero(numbers >> bits) for bits in (8, 16, 24)]  # numbers of over 1, 2 and 3 bytes
    lengths = np.ones(-(-len(numbers) // 4) * 4, np.uint8)
    for some in longer:
        lengths[some] += 1
    starts = _starts(lengths[: len(numbers)])
    data = np.empty(int(lengths[: len(numbers)].sum(dtype=np.int64)), np.uint8)
    data[starts] = numbers.astype(np.uint8)
    for place, some in enumerate(longer, 1):
        data[starts[some] + place] = (numbers[some] >> 8 * place).astype(np.uint8)
    codes = (lengths - 1).reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8)
    return np.bitwise_or.reduce(codes, axis=1).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ``count`` numbers of :func:`pack`."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    starts = _starts(lengths)
    stored = np.frombuffer(data, np.uint8)
    numbers = stored[starts].astype("<u4")
    for place in (1, 2, 3):
        some = np.flatnonzero(lengths > place)
        if not len(some):
            break
        numbers[some] |= stored[starts[some] + place].astype("<u4") << np.uint32(8 * place)
    return numbers


def encode(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, checksum, and the ids, zstandard-compressed.

    Each task ends with a row that has only ``counts``: how often each id of the vocabulary came.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        total = np.zeros(word_encoder(tokenizer).size, "<i8")
        for batch, ids in encoded(batches, tokenizer, end_id):
            found = np.bincount(np.concatenate(ids)) if ids else total[:0]
            total[: len(found)] += found
            yield pa.record_batch({
                "doc_id": batch.column(0),
                "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                "checksum": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                "ids": pa.array([squeeze(x.tobytes()) for x in ids], pa.binary()),
                "counts": pa.nulls(len(ids), pa.binary()),
            })
        row = {"doc_id": None, "n_tokens": None, "checksum": None, "ids": None, "counts": squeeze(total.tobytes())}
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema(
            [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("checksum", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())]
        ))

    return docs.select(F.col(doc_id).cast("bigint"), text).mapInArrow(
        rows, "doc_id long, n_tokens long, checksum long, ids binary, counts binary"
    )


def _ids(batch: pa.RecordBatch, dtype: np.dtype) -> Iterator[np.ndarray]:
    expand = zstandard.ZstdDecompressor().decompress
    for blob in batch.column("ids"):
        yield np.frombuffer(expand(blob.as_buffer()), dtype)


def frequencies(ids: DataFrame) -> DataFrame:
    """(id, n) of all ids of :func:`encode`'s frame, from the tasks' counts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        total = np.zeros(0, "<i8")
        for batch in batches:
            for blob in batch.column("counts").to_pylist():
                total = np.frombuffer(expand(blob), "<i8") + (total if len(total) else 0)
        met = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(met, pa.int64()), "n": pa.array(total[met], pa.int64())})

    return ids.filter("counts is not null").select("counts").mapInArrow(counted, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n"))


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the token files of all documents to the folder ``path``, in ascending order of ``doc_id``.

    The texts are encoded once; the ids wait compressed in the shared folder until their frequencies are
    known, and are dropped when the files are there. The ranks (as many as the vocabulary) are the only
    thing that passes the driver.
    """
    spark = docs.sparkSession
    ids = staging.written(encode(docs, tokenizer, end_id, doc_id, text), "ids", compression="uncompressed")
    ranked = frequencies(ids).orderBy(F.desc("n"), "id").select("id").toPandas()["id"].to_numpy()
    ranks = pa.table({"rank": pa.array(range(len(ranked)), pa.int32()), "id": pa.array(ranked, pa.int64())})
    spark.createDataFrame(ranks).coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(ranked.max(initial=0)) + 1, "<u4")
    rank_of[ranked] = np.arange(len(ranked))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, block = TaskContext.get().partitionId(), 0
        dtype = word_encoder(tokenizer).dtype
        names, held, waiting = [], [], 0

        def block_row():
            control, data = pack(rank_of[np.concatenate(held)])
            return pa.record_batch({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()),
                "n_ids": pa.array([waiting], pa.int64()), "doc_ids": pa.array([names], pa.list_(pa.int64())),
                "lengths": pa.array([[len(x) for x in held]], pa.list_(pa.int64())),
                "control": pa.array([control], pa.binary()), "data": pa.array([data], pa.binary()),
            })

        for batch in batches:
            for name, one in zip(batch.column("doc_id").to_pylist(), _ids(batch, dtype)):
                if held and waiting + len(one) > BLOCK_TOKENS:
                    yield block_row()
                    names, held, waiting, block = [], [], 0, block + 1
                names.append(name)
                held.append(one)
                waiting += len(one)
        if held:
            yield block_row()

    order = [F.asc_nulls_first("doc_id"), "n_tokens", "checksum"]
    (
        ids.filter("counts is null").repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
        .mapInArrow(blocks, "shard int, block int, n_ids long, doc_ids array<long>, lengths array<long>, control binary, data binary")
        .write.parquet(f"{path}/blocks", compression="zstd")
    )
    staging.discard(ids)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document of a folder: doc_id, start, n_tokens, ids_crc32 and, if asked for, its ids (array).

    ``start`` is the number of ids of all documents before it. Blocks are decoded where they lie; their
    starts come from one row per block, summed within shards and then over the shards.
    """
    ranked = spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").toPandas()["id"].to_numpy().astype("<u4")
    blocks = spark.read.parquet(f"{path}/blocks")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = ranked[unpack(row["control"], row["data"], row["n_ids"])]
                ends = np.cumsum(row["lengths"])
                parts = np.split(ids, ends[:-1])
                columns = {
                    "shard": pa.array([row["shard"]] * len(parts), pa.int32()),
                    "block": pa.array([row["block"]] * len(parts), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "place": pa.array(ends - row["lengths"], pa.int64()),
                    "n_tokens": pa.array([len(x) for x in parts], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in parts], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(parts, pa.list_(pa.int64()))
                yield pa.record_batch(columns)

    schema = "shard int, block int, doc_id long, place long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    documents = blocks.mapInArrow(rows, schema)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("block_start"))
    return (
        documents.join(starts.join(shards, "shard"), ["shard", "block"])
        .withColumn("start", F.col("shard_start") + F.col("block_start") + F.col("place"))
        .select("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)
    )
