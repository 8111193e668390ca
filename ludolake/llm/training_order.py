"""Training-order materialisation of token ids as fixed-stride binary shards.

Documents become one stream of token ids, cut into sequences of ``stride`` ids. A
keyed Feistel permutation with cycle-walking gives each sequence its global slot,
so the order needs no sort key, no state and no memory of other sequences, and can
be recomputed or inverted for any slot. Slots are dealt to shards by range. Each
shard is a file of fixed-stride records: record ``i`` of shard ``s`` is slot
``s * per_shard + i`` and begins at byte ``i * stride * width``, so a reader can resume
anywhere by arithmetic alone. Ids take two bytes where the vocabulary allows it.

A shard file is written under another name and then renamed, and its bytes follow
from the input only, so a task that runs twice after a lost executor does no harm.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import at_most, stage, work_path
from .common import mixed, table, texts
from .tokens import END, TokenBytes, tokenizer_path

STRIDE = 2048
PER_SHARD = 2048
ROUNDS = 6
MAX_TASKS = 1 << 20
#: Ids that are compressed together; the pieces of a chunk travel to each shard as one row.
CHUNK = 1 << 18
LEVEL = 3


def _rounds(values: np.ndarray, half: int, keys: np.ndarray, inverse: bool) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = values >> np.uint64(half), values & mask
    for key in keys[::-1] if inverse else keys:
        if inverse:
            left, right = right ^ (mixed(mixed(left + key)) & mask), left
        else:
            left, right = right, left ^ (mixed(mixed(right + key)) & mask)
    return left << np.uint64(half) | right


def permuted(values: np.ndarray, size: int, key: int, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of 0 .. size - 1, or its inverse, applied to ``values``.

    The Feistel network permutes the next even power of two; what lands outside
    walks on along its cycle until it is inside.
    """
    half = max(1, ((max(size, 2) - 1).bit_length() + 1) // 2)
    keys = mixed(mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(key % 2**64)))
    out = _rounds(np.asarray(values, np.uint64), half, keys, inverse)
    while len(outside := np.flatnonzero(out >= size)):
        out[outside] = _rounds(out[outside], half, keys, inverse)
    return out.astype(np.int64)


def id_type(path: str) -> str:
    """Little-endian ids as wide as the vocabulary asks for."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def _stream(docs: DataFrame, text_col: str, path: str, kind: str) -> tuple[DataFrame, int]:
    """(start, tokens, ids): the stream of ids in compressed chunks; ``start`` is the place in the whole stream."""

    def run(batches):
        tokens, at, small = TokenBytes(path), 0, zstandard.ZstdCompressor(level=LEVEL)

        def chunks(held):
            nonlocal at
            ids = np.frombuffer(b"".join(held), "<u4").astype(kind)
            cuts = [ids[k : k + CHUNK] for k in range(0, len(ids), CHUNK)]
            starts = [at + k for k in range(0, len(ids), CHUNK)]
            at += len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array(starts, pa.int64()), pa.array(map(len, cuts), pa.int64()), pa.array([small.compress(x.tobytes()) for x in cuts], pa.binary())],
                ["local", "tokens", "ids"],
            )

        held, size = [], 0
        for batch in batches:
            for text in texts(batch.column(0)):
                held.append(tokens.of(text))
                size += len(held[-1]) // 4
                if size >= CHUNK:
                    yield chunks(held)
                    held, size = [], 0
        if held:
            yield chunks(held)

    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    rows = rows.mapInArrow(run, "local long, tokens long, ids binary")
    rows = stage(rows.withColumn("part", F.spark_partition_id()), "stream")
    # One row per task of the write above: a bounded table, and checked before it is sent.
    sums = rows.groupBy("part").agg(F.sum("tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(sums.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    total = bases.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bases = bases.select("part", "base")
    bases = F.broadcast(bases) if at_most(bases, MAX_TASKS) else bases
    return rows.join(bases, "part").select((F.col("base") + F.col("local")).alias("start"), "tokens", "ids"), total


def materialise(
    docs: DataFrame, folder: str, key: int = 0, text_col: str = "text",
    stride: int = STRIDE, per_shard: int = PER_SHARD, path: str | None = None,
) -> DataFrame:
    """Write the shards below ``folder``; one row per sequence.

    Returns (sequence_id, slot, shard, record, byte_offset, n_tokens, ids_crc32).
    Each document is its ids and the end id; null, empty and blank texts are one
    token. Only the last sequence can be short; its record is filled with the end
    id. Repeated rows are streamed as often as they come. No document gives no row
    and no file. Ids and other columns are not read.
    """
    path = path or tokenizer_path()
    kind = id_type(path)
    width = np.dtype(kind).itemsize
    stream, total = _stream(docs, text_col, path, kind)
    count = -(-total // stride)

    def cut(batches):
        small, full = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
        for batch in batches:
            for start, tokens, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids = np.frombuffer(full.decompress(ids), kind)
                sequences = np.arange(start // stride, (start + tokens - 1) // stride + 1)
                begin = np.maximum(sequences * stride, start)
                length = np.minimum((sequences + 1) * stride, start + tokens) - begin
                pieces = np.stack([sequences, begin % stride, length], axis=1)
                shards = permuted(sequences, count, key) // per_shard
                own = [np.flatnonzero(shards == shard) for shard in np.unique(shards)]
                joined = [np.concatenate([ids[begin[i] - start :][: length[i]] for i in rows]) for rows in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shards[rows[0]] for rows in own], pa.int64()),
                        pa.array([pieces[rows].tobytes() for rows in own], pa.binary()),
                        pa.array([small.compress(x.tobytes()) for x in joined], pa.binary()),
                    ],
                    ["shard", "pieces", "ids"],
                )

    def write(group: pa.Table) -> pa.Table:
        from pyarrow import fs

        shard = group.column("shard")[0].as_py()
        rows = min(per_shard, count - shard * per_shard)
        records = np.full((rows, stride), END, kind)
        sequence, filled = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        full = zstandard.ZstdDecompressor()
        for pieces, ids in zip(group.column("pieces").to_pylist(), group.column("ids").to_pylist()):
            pieces, ids, at = np.frombuffer(pieces, np.int64).reshape(-1, 3), np.frombuffer(full.decompress(ids), kind), 0
            records_of = permuted(pieces[:, 0], count, key) - shard * per_shard
            for i, (seq, offset, length) in zip(records_of.tolist(), pieces.tolist()):
                records[i, offset : offset + length] = ids[at : at + length]
                at += length
                sequence[i] = seq
                filled[i] += length
        system, place = fs.FileSystem.from_uri(folder)
        system.create_dir(place, recursive=True)
        name = f"{place}/{shard_name(shard)}"
        own = f"{name}.{uuid.uuid4().hex}.part"
        with system.open_output_stream(own) as out:
            out.write(records.tobytes())
        system.move(own, name)
        return pa.table(
            {
                "sequence_id": sequence, "slot": shard * per_shard + np.arange(rows), "shard": np.full(rows, shard),
                "record": np.arange(rows), "byte_offset": np.arange(rows) * stride * width, "n_tokens": filled,
                "ids_crc32": [zlib.crc32(records[i, : filled[i]].astype("<u4").tobytes()) for i in range(rows)],
            }
        )

    pieces = stream.mapInArrow(cut, "shard long, pieces binary, ids binary")
    return pieces.groupBy("shard").applyInArrow(
        write, "sequence_id long, slot long, shard long, record long, byte_offset long, n_tokens long, ids_crc32 long"
    )


def shard_name(shard: int) -> str:
    return f"shard-{shard:09d}.bin"


def read_records(folder: str, shard: int, record: int = 0, stride: int = STRIDE, kind: str = "<u2") -> np.ndarray:
    """The records of a shard from ``record`` on, read from there only."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(folder)
    with system.open_input_file(f"{place}/{shard_name(shard)}") as file:
        file.seek(record * stride * np.dtype(kind).itemsize)
        return np.frombuffer(file.read(), kind).reshape(-1, stride)


def op1_training_order(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "text")
    return materialise(docs, work_path(spark, "shards"), key=20)
