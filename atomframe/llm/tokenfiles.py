"""Token-id files: patched frame-of-reference blocks.

A file holds segments, one after another. A segment holds the ids of whole documents in order:

    magic "PFB1", then uint32: documents, values, blocks
    documents x (int64 id, uint8 has an id, uint32 number of values)
    blocks x uint64: where each block starts in the segment's body
    body: blocks of BLOCK values (the last may be shorter)

A block is uint32 minimum, uint8 width, uint16 exceptions; the differences from the minimum packed at that width (their
low bits, for exceptions); then the exceptions' places (uint16) and the bits above the width (uint32). The width is
that of the block's PERCENTILE. Any block can be read by itself through the index.

Files are written under a name of their own and renamed, so that a repeated task leaves the same file. Null text is an
empty text; a document always has its end id. Documents without an id come first; equal ids and equal rows stay
separate documents, next to each other. An empty table makes files without segments.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from atomframe.llm.common import chunks, column, parts, saved, shared_dir
from atomframe.llm.tokens import OWNER, default_tokenizer, encoder

MAGIC = b"PFB1"
BLOCK = 1024
PERCENTILE = 0.9
HEAD = struct.Struct("<4sIII")
BLOCK_HEAD = struct.Struct("<IBH")


def _widths(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def encode_blocks(values: np.ndarray) -> list[bytes]:
    """The blocks of uint32 values."""
    n = len(values)
    if not n:
        return []
    rows = -(-n // BLOCK)
    table = np.full(rows * BLOCK, values[-1], dtype=np.uint32)
    table[:n] = values
    table = table.reshape(rows, BLOCK)
    low = table.min(axis=1)
    table = table - low[:, None]
    width = _widths(np.partition(table, int(PERCENTILE * BLOCK), axis=1)[:, int(PERCENTILE * BLOCK)])
    over = (table.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    out: list[bytes] = [b""] * rows
    for w in np.unique(width):
        for some in np.array_split(at := np.flatnonzero(width == w), -(-len(at) // 32)):
            size = [BLOCK] * len(some)
            if some[-1] == rows - 1:
                size[-1] = n - (rows - 1) * BLOCK
            bits = ((table[some][:, :, None] >> np.arange(w, dtype=np.uint32)) & 1).astype(np.uint8)
            packed = np.packbits(bits.reshape(len(some), -1), axis=1, bitorder="little")
            for i, r in enumerate(some):
                places = np.flatnonzero(over[r, : size[i]]).astype(np.uint16)
                out[r] = BLOCK_HEAD.pack(int(low[r]), int(w), len(places)) + packed[i, : -(-int(w) * size[i] // 8)].tobytes() + places.tobytes() + over[r, places].tobytes()
    return out


def decode_blocks(body: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of blocks that start at ``starts`` in ``body`` and have ``sizes`` values each."""
    heads = [BLOCK_HEAD.unpack_from(body, int(s)) for s in starts]
    out = np.zeros((len(heads), BLOCK), dtype=np.uint32)
    data = np.frombuffer(body, dtype=np.uint8)
    width = np.array([h[1] for h in heads], dtype=np.int64)
    for w in np.unique(width):
        for some in np.array_split(at := np.flatnonzero(width == w), -(-len(at) // 32)):
            packed = np.zeros((len(some), BLOCK * int(w) // 8), dtype=np.uint8)
            for i, r in enumerate(some):
                n = -(-int(w) * int(sizes[r]) // 8)
                begin = int(starts[r]) + BLOCK_HEAD.size
                packed[i, :n] = data[begin : begin + n]
            if w:
                bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(some), BLOCK, int(w))
                for k in range(int(w)):
                    out[some] |= bits[:, :, k].astype(np.uint32) << np.uint32(k)
    for r, (low, w, many) in enumerate(heads):
        if many:
            at = int(starts[r]) + BLOCK_HEAD.size + -(-w * int(sizes[r]) // 8)
            places = np.frombuffer(body, dtype=np.uint16, count=many, offset=at)
            out[r, places] |= np.frombuffer(body, dtype=np.uint32, count=many, offset=at + 2 * many) << np.uint32(w)
        out[r] += np.uint32(low)
    return out[np.arange(BLOCK)[None, :] < np.asarray(sizes)[:, None]]


def segment(ids: list[int | None], documents: list[np.ndarray]) -> bytes:
    values = np.concatenate([np.zeros(0, np.uint32), *documents])
    blocks = encode_blocks(values)
    starts = np.cumsum([0, *map(len, blocks)])[:-1].astype(np.uint64)
    return b"".join([
        HEAD.pack(MAGIC, len(ids), len(values), len(blocks)),
        np.array([i or 0 for i in ids], dtype=np.int64).tobytes(),
        np.array([i is not None for i in ids], dtype=np.uint8).tobytes(),
        np.array([len(d) for d in documents], dtype=np.uint32).tobytes(),
        starts.tobytes(),
        struct.pack("<Q", sum(map(len, blocks))),
        *blocks,
    ])


def read_segment(f) -> tuple[list[int | None], np.ndarray, np.ndarray] | None:
    """The next segment of an open file: document ids, numbers of values, values; None at the end."""
    head = f.read(HEAD.size)
    if not head:
        return None
    magic, docs, values, blocks = HEAD.unpack(head)
    if magic != MAGIC:
        raise ValueError("not a token file")
    ids = np.frombuffer(f.read(8 * docs), dtype=np.int64).tolist()
    has = np.frombuffer(f.read(docs), dtype=np.uint8)
    lengths = np.frombuffer(f.read(4 * docs), dtype=np.uint32).astype(np.int64)
    starts = np.frombuffer(f.read(8 * blocks), dtype=np.uint64).astype(np.int64)
    body = f.read(struct.unpack("<Q", f.read(8))[0])
    sizes = np.minimum(BLOCK, values - np.arange(blocks) * BLOCK)
    return [i if h else None for i, h in zip(ids, has, strict=True)], lengths, decode_blocks(body, starts, sizes) if blocks else np.zeros(0, np.uint32)


def _open(folder: str):
    return pafs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (pafs.LocalFileSystem(), folder)


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        part, total, docs = TaskContext.get().partitionId(), 0, 0
        name = f"part-{part:06d}.pfb"
        own = f"{base}/.{name}-{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as f:
            for batch in chunks(batches, owner=OWNER):
                ids = encoder(tokenizer).encode([t or "" for t in column(batch, "text").to_pylist()])
                ids = [np.append(x, np.uint32(end_id)) for x in ids]
                f.write(segment(column(batch, "doc_id").to_pylist(), ids))
                total += sum(map(len, ids))
                docs += len(ids)
        fs.move(own, f"{base}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([docs], pa.int64()), pa.array([total], pa.int64())], ["part", "name", "docs", "n_ids"])

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2, partitions: int | None = None) -> DataFrame:
    """Writes the ids of all texts, in ascending doc_id order over the files; returns part, name, docs and n_ids."""
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange(partitions or parts(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    return saved(rows.mapInArrow(_writer(folder, tokenizer or default_tokenizer(), end_id), "part int, name string, docs long, n_ids long"), "tokenfiles")


def _reader(folder: str, firsts: dict[int, int], with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        for batch in batches:
            for part, name in zip(column(batch, "part").to_pylist(), column(batch, "name").to_pylist(), strict=True):
                start = firsts[part]
                with fs.open_input_stream(f"{base}/{name}") as f:
                    while (got := read_segment(f)) is not None:
                        ids, lengths, values = got
                        ends = np.cumsum(lengths)
                        data = memoryview(values.astype("<u4").tobytes())
                        sums = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                        out = [pa.array(ids, pa.int64()), pa.array(start + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())]
                        if with_ids:
                            out.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(values.astype(np.int32))))
                        yield pa.RecordBatch.from_arrays(out, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(out)])
                        start += int(ends[-1]) if len(ends) else 0

    return run


def read_token_files(files: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents as the files have them: doc_id, start (ids before it), n_tokens, ids_crc32 and, if asked for, ids."""
    rows = files.select("part", "n_ids").orderBy("part").collect()  # one row for each file
    firsts, at = {}, 0
    for r in rows:
        firsts[r.part] = at
        at += r.n_ids
    spread = files.select("part", "name").repartition(max(1, len(rows)), "part")
    return spread.mapInArrow(_reader(folder, firsts, with_ids), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def op5_token_files(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    files = write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return read_token_files(files, folder)
