"""Training order: every sequence at a global slot, in binary shards of fixed stride.

Texts become token ids and are cut into sequences of one length, the last one padded. A
keyed Feistel permutation, walked in cycles until it falls below the number of sequences,
sends each sequence's index to its slot: no sort, no state, and any slot can be computed
alone. Sequences are dealt by ranges of slots, one range a shard, and each shard is written
in slot order, so a reader seeks to ``slot * stride`` and goes on from any slot.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from .shared import by_text, new_folder, stored

ROUNDS = 6


def mixed(values: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit mixing function with a key."""
    x = (values ^ np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slots_of(index: np.ndarray, count: int, key: int) -> np.ndarray:
    """The slot of each index below ``count``: a permutation of ``0 .. count-1``.

    The network permutes numbers of the smallest even number of bits that holds ``count``;
    those that leave the range go through it again until they are back.
    """
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for i in range(ROUNDS):
            left, right = right, left ^ (mixed(right, key * 1_000_003 + i) & mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= count]
    return out.astype(np.int64)


class TextCoder:
    """Token ids of a text by a rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        coding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.encode = coding.encode_ordinary

    def __call__(self, text: str) -> bytes:
        """Two little-endian bytes for each id."""
        return np.array(self.encode(text), "<u2").tobytes()


def located(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows of a table of files with the file and the row's place in it."""
    return df.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def run_starts(files: list[str], rows: np.ndarray, last: tuple[str, int] | None) -> list[int]:
    """Where a batch leaves the run of rows that goes on from ``last``."""
    breaks = []
    for i, (file, row) in enumerate(zip(files, rows.tolist())):
        if last is None or file != last[0] or row != last[1] + 1:
            breaks.append(i)
        last = (file, row)
    return breaks


def counted_runs(rows: DataFrame, path: str, pattern: str, length: int) -> list[tuple[str, int, int]]:
    """``(file, first row, sequences)`` of every run of rows that one task reads in one go.

    There are about as many as input splits, which is what the driver holds.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, runs, last = TextCoder(path, pattern).encode, [], None
        for batch in batches:
            files, places = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            starts = set(run_starts(files, places, last))
            for i, text in enumerate(batch.column(0).to_pylist()):
                if i in starts:
                    runs.append([files[i], int(places[i]), 0])
                runs[-1][2] += -(-len(encode(text or "")) // length)
            if files:
                last = (files[-1], int(places[-1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in runs], pa.string()), pa.array([r[1] for r in runs], pa.int64()),
             pa.array([r[2] for r in runs], pa.int64())],
            ["file", "row", "n"],
        )

    found = by_text(rows, "file string, row bigint, n bigint", count, F.col("text"), F.col("file"), F.col("row"))
    return sorted(tuple(r) for r in found.collect())


def numbered_sequences(
    rows: DataFrame, runs: list[tuple[str, int, int]], path: str, pattern: str, length: int, pad: int, key: int
) -> DataFrame:
    """``(doc_id, piece, n_tokens, ids, slot)`` of every sequence.

    A sequence's index counts the sequences before it, by file and row, so it does not
    depend on how the files are split. A task that meets a run of rows that was not
    counted fails.
    """
    first, total = {}, 0
    for file, row, n in runs:
        first[file, row] = total
        total += n
    shared = rows.sparkSession.sparkContext.broadcast(first)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, stride, last, index = TextCoder(path, pattern), 2 * length, None, 0
        for batch in batches:
            docs, pieces, sizes, data, indices = [], [], [], [], []
            files, places = batch.column(2).to_pylist(), batch.column(3).to_numpy()
            starts = set(run_starts(files, places, last))
            for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if i in starts:
                    index = shared.value[files[i], int(places[i])]
                ids = coder(text or "")
                for piece, at in enumerate(range(0, len(ids), stride)):
                    part = ids[at : at + stride]
                    docs.append(doc)
                    pieces.append(piece)
                    sizes.append(len(part) // 2)
                    data.append(part + int(pad).to_bytes(2, "little") * ((stride - len(part)) // 2))
                    indices.append(index)
                    index += 1
            if files:
                last = (files[-1], int(places[-1]))
            slots = slots_of(np.array(indices, np.uint64), total, key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, batch.schema.field(0).type), pa.array(pieces, pa.int32()), pa.array(sizes, pa.int32()),
                 pa.array(data, pa.binary()), pa.array(slots, pa.int64())],
                ["doc_id", "piece", "n_tokens", "ids", "slot"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, n_tokens int, ids binary, slot bigint"
    return by_text(rows, schema, cut, F.col("doc_id"), F.col("text"), F.col("file"), F.col("row"))


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """A file system and path for a folder's URI; a plain path is local."""
    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", folder))


def shard_name(shard: int) -> str:
    return f"shard-{shard:06d}.bin"


def write_shards(found: DataFrame, total: int, folder: str, per_shard: int) -> DataFrame:
    """Write numbered sequences in training order; the manifest of every sequence.

    Returns ``doc_id, piece, n_tokens, slot, shard, place, crc32``. Shard ``s`` is the file
    ``shard-s.bin`` in ``folder`` with the slots from ``s * per_shard`` on. A shard is
    written under another name and renamed when whole; a task that is repeated writes the
    same bytes, so a lost executor costs its unfinished shards only.
    """
    kind = found.schema["doc_id"].dataType.simpleString()
    shards = max(1, -(-total // per_shard))
    found = found.withColumn("shard", F.floor(F.col("slot") / per_shard)).repartitionById(shards, F.col("shard").cast("int"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = opened(folder)
        files.create_dir(root)
        shard, out, temporary = None, None, None

        def done():
            out.close()
            files.move(temporary, f"{root}/{shard_name(shard)}")

        for batch in batches:
            marks = []
            for number, data in zip(batch.column(5).to_pylist(), batch.column(3).to_pylist()):
                if number != shard:
                    if out is not None:
                        done()
                    shard = number
                    temporary = f"{root}/_{shard_name(shard)}-{np.random.SeedSequence().entropy:x}"
                    out = files.open_output_stream(temporary)
                out.write(data)
                marks.append(zlib.crc32(data))
            slots = batch.column(4).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(4), batch.column(5),
                 pa.array(slots % per_shard), pa.array(marks, pa.int64())],
                ["doc_id", "piece", "n_tokens", "slot", "shard", "place", "crc32"],
            )
        if out is not None:
            done()

    schema = f"doc_id {kind}, piece int, n_tokens int, slot bigint, shard bigint, place bigint, crc32 bigint"
    ordered = found.sortWithinPartitions("shard", "slot")
    return stored(ordered.mapInArrow(written, schema), "manifest")


def read_slots(folder: str, first: int, count: int, length: int, per_shard: int) -> np.ndarray:
    """``count`` sequences from slot ``first`` on: one seek, then sequential reads."""
    files, root = opened(folder)
    stride, parts = 2 * length, []
    while count > 0:
        shard, place = divmod(first, per_shard)
        take = min(count, per_shard - place)
        with files.open_input_file(f"{root}/{shard_name(shard)}") as file:
            file.seek(place * stride)
            data = file.read(take * stride)
        parts.append(np.frombuffer(data, "<u2").reshape(-1, length))
        first, count = first + take, count - take
        if len(data) < take * stride:
            break
    return np.concatenate(parts) if parts else np.zeros((0, length), "<u2")


def training_order(
    df: DataFrame, path: str, pattern: str, key: int, length: int = 256, per_shard: int = 1 << 15, pad: int = 50256,
    folder: str | None = None, doc_id: str = "doc_id", text: str = "text",
) -> tuple[DataFrame, str]:
    """Encode, order and write all texts of a table of files; the manifest and the shards' folder.

    Texts are encoded twice, once to count: this keeps their ids from being stored on the
    way. One manifest row per sequence; a null or empty text has none. Repeated rows are
    sequences of their own. Rows with a null id are written like any other. An empty table
    writes nothing. Other columns are ignored. The order depends on the key and on the
    input files and their rows alone.
    """
    spark = df.sparkSession
    folder = folder or new_folder(spark, "training-order")
    rows = located(df, doc_id, text)
    # Both passes must split the files alike, also when executors come or go in between.
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(spark.sparkContext.defaultParallelism))
    try:
        runs = counted_runs(rows, path, pattern, length)
        found = numbered_sequences(rows, runs, path, pattern, length, pad, key)
        return write_shards(found, sum(n for _, _, n in runs), folder, per_shard), folder
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)
