"""Token ids in files of patched frame-of-reference blocks.

A file holds consecutive documents: a header, the documents' ids and lengths, an index of block starts, then blocks of
BLOCK token ids. A block stores its minimum, the width that a percentile of its offsets needs, the offsets packed in
that width, and a list of exceptions (place, offset) for those that are wider.

    header   magic "MPF1", block size, documents, blocks, tokens          4s I I I Q
    documents  doc_id (int64), tokens (uint32); a null doc_id is NO_ID
    index    for each block: byte at which it starts (uint64)
    block    minimum uint32, width uint8, pad uint8, exceptions uint16, packed words uint64, exceptions (uint16, uint32)

Each task writes its files under names of its own and returns a manifest row for each; a file counts only when
the manifest, written by Spark's commit protocol, names it. So retried or lost tasks leave no trace in results.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, keyed_texts, mapped, new_path, slices, written
from .fast_encode import batches, encoder, gathered

BLOCK = 512
PERCENTILE = 95
HEADER = struct.Struct("<4sIIIQ")
NO_ID = -(1 << 63)
#: A task starts a new file when one has so many tokens; a document is never split between files.
FILE_TOKENS = 8_000_000


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """values (rows of a multiple of 64) below 2**width -> rows of uint64 words."""
    n = values.shape[0]
    lanes = np.ascontiguousarray(values.reshape(-1, 64).T.astype(np.uint64))
    words = np.zeros((width, lanes.shape[1]), np.uint64)
    for j in range(64):
        at, off = divmod(j * width, 64)
        words[at] |= lanes[j] << np.uint64(off)
        if off + width > 64:
            words[at + 1] |= lanes[j] >> np.uint64(64 - off)
    return np.ascontiguousarray(words.T).reshape(n, -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    n = words.shape[0]
    groups = np.ascontiguousarray(words.reshape(-1, width).T)
    lanes = np.empty((64, groups.shape[1]), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        at, off = divmod(j * width, 64)
        v = groups[at] >> np.uint64(off)
        if off + width > 64:
            v = v | groups[at + 1] << np.uint64(64 - off)
        lanes[j] = (v & mask).astype(np.uint32)
    return np.ascontiguousarray(lanes.T).reshape(n, -1)


def pack_file(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """doc_ids int64, sizes: tokens of each document, ids: all tokens (uint32) one after another."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    rows = np.concatenate([ids, np.full(blocks * BLOCK - n, ids[-1] if n else 0, np.uint32)]).astype(np.uint32).reshape(blocks, BLOCK)
    least = rows.min(axis=1) if blocks else np.zeros(0, np.uint32)
    offsets = rows - least[:, None]
    k = min(BLOCK - 1, int(BLOCK * percentile / 100))
    chosen = np.partition(offsets, k, axis=1)[:, k] if blocks else np.zeros(0, np.uint32)
    widths = np.where(chosen > 0, np.frexp(chosen.astype(np.float64))[1], 0).astype(np.int64)
    wide = offsets >> widths[:, None].astype(np.uint32) > 0
    wide[widths == 32] = False
    row, place = np.nonzero(wide)
    outliers = offsets[row, place]
    offsets[row, place] = 0
    counts = np.bincount(row, minlength=blocks)
    lengths = 8 + 8 * (BLOCK // 64) * widths + 6 * counts
    first = HEADER.size + 12 * len(doc_ids) + 8 * blocks
    starts = first + np.cumsum(lengths) - lengths
    out = np.zeros(first + int(lengths.sum()), np.uint8)
    out[: HEADER.size] = np.frombuffer(HEADER.pack(b"MPF1", BLOCK, len(doc_ids), blocks, n), np.uint8)
    told = [np.asarray(doc_ids, "<i8"), np.asarray(sizes, "<u4"), starts.astype("<u8")]
    out[HEADER.size : first] = np.frombuffer(b"".join(x.tobytes() for x in told), np.uint8)
    heads = np.zeros(blocks, np.dtype([("least", "<u4"), ("width", "u1"), ("pad", "u1"), ("exceptions", "<u2")]))
    heads["least"], heads["width"], heads["exceptions"] = least, widths, counts
    out[starts[:, None] + np.arange(8)] = heads.view(np.uint8).reshape(blocks, 8)
    for width in np.unique(widths):
        if width:
            own = np.flatnonzero(widths == width)
            packed = _pack(offsets[own], int(width)).astype("<u8").view(np.uint8)
            out[starts[own][:, None] + 8 + np.arange(packed.shape[1])] = packed
    if len(row):
        patches = np.zeros(len(row), np.dtype([("place", "<u2"), ("offset", "<u4")]))
        patches["place"], patches["offset"] = place, outliers
        rank = np.arange(len(row)) - (np.cumsum(counts) - counts)[row]
        at = starts[row] + 8 + 8 * (BLOCK // 64) * widths[row] + 6 * rank
        out[at[:, None] + np.arange(6)] = patches.view(np.uint8).reshape(-1, 6)
    return out.tobytes()


def unpack_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks at these bytes, a row each. data: the file as uint8."""
    heads = data[starts[:, None] + np.arange(8)].copy().view(np.dtype([("least", "<u4"), ("width", "u1"), ("pad", "u1"), ("exceptions", "<u2")])).reshape(-1)
    rows = np.zeros((len(starts), BLOCK), np.uint32)
    widths, counts = heads["width"].astype(np.int64), heads["exceptions"].astype(np.int64)
    for width in np.unique(widths):
        if width:
            own = np.flatnonzero(widths == width)
            size = 8 * (BLOCK // 64) * int(width)
            rows[own] = _unpack(data[starts[own][:, None] + 8 + np.arange(size)].view("<u8"), int(width))
    if counts.sum():
        row = np.repeat(np.arange(len(starts)), counts)
        rank = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = starts[row] + 8 + 8 * (BLOCK // 64) * widths[row] + 6 * rank
        patches = data[at[:, None] + np.arange(6)].copy().view(np.dtype([("place", "<u2"), ("offset", "<u4")])).reshape(-1)
        rows[row, patches["place"]] = patches["offset"]
    return rows + heads["least"][:, None].astype(np.uint32)


def read_head(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    magic, block, docs, blocks, n = HEADER.unpack(data[: HEADER.size].tobytes())
    if magic != b"MPF1" or block != BLOCK:
        raise ValueError("not a file of packed token ids")
    at = HEADER.size
    doc_ids = data[at : at + 8 * docs].copy().view("<i8")
    sizes = data[at + 8 * docs : at + 12 * docs].copy().view("<u4")
    starts = data[at + 12 * docs : at + 12 * docs + 8 * blocks].copy().view("<u8").astype(np.int64)
    return doc_ids, sizes, starts, n


def read_tokens(data: bytes, start: int, stop: int) -> np.ndarray:
    """Tokens start..stop of a file: only the blocks that hold them are unpacked."""
    raw = np.frombuffer(data, np.uint8)
    _, _, starts, n = read_head(raw)
    start, stop = max(0, start), min(n, stop)
    if stop <= start:
        return np.zeros(0, np.uint32)
    a, b = start // BLOCK, (stop - 1) // BLOCK + 1
    return unpack_blocks(raw, starts[a:b]).reshape(-1)[start - a * BLOCK : stop - a * BLOCK]


def _folder(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, path: str, uri: str, end_id: int | None = 0, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encode every text, append end_id, write files under uri in ascending doc_id order; the manifest as a written table.

    Manifest: part, file (their order is that of doc_ids), name, n_docs, n_tokens, n_bytes. A null text has no ids
    but the end; null doc_ids come first; rows of one doc_id follow each other by text. An empty table writes no file. Only
    doc_id and text are read of docs. Memory: one batch of texts and one file of ids.
    """
    spark = docs.sparkSession

    def write(parts):
        from pyspark import TaskContext

        own, (store, folder) = encoder(path), _folder(uri)
        store.create_dir(folder, recursive=True)
        part, rows = TaskContext.get().partitionId(), []
        held: list[tuple] = []

        def flush():
            ids = np.concatenate([h[2] for h in held])
            data = pack_file(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), ids)
            name = f"{part:06d}-{len(rows):04d}-{uuid.uuid4().hex}.mpf"
            with store.open_output_stream(f"{folder}/{name}") as f:
                f.write(data)
            rows.append((part, len(rows), name, sum(len(h[0]) for h in held), len(ids), len(data)))
            held.clear()

        for pdf in gathered(parts):
            texts = pdf["text"].tolist()
            doc_ids = pdf["doc_id"].fillna(NO_ID).to_numpy(np.int64)
            for a, b in batches(texts):
                ids, ends = own.encode(texts[a:b])
                sizes = np.diff(ends)
                if end_id is not None:
                    ids, sizes = np.insert(ids, ends[1:], end_id), sizes + 1
                held.append((doc_ids[a:b], sizes, ids))
                if sum(len(h[2]) for h in held) >= file_tokens:
                    flush()
        if held:
            flush()
        yield pd.DataFrame(rows, columns=["part", "file", "name", "n_docs", "n_tokens", "n_bytes"])

    # rows without doc_id, or many of one doc_id, are dealt out by how their texts begin
    ordered = keyed_texts(docs).repartitionByRange(slices(spark), "doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    return written(mapped(ordered, write, "part long, file long, name string, n_docs long, n_tokens long, n_bytes long"), "manifest")


def read_token_files(manifest: DataFrame, uri: str, schema: str, row) -> DataFrame:
    """Reads the files that the manifest names: for each document doc_id, start, n_tokens, then what row(ids) returns."""
    names = [x.split()[0] for x in schema.split(",")]
    # one row for each file
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).select("name", "base", "n_tokens")

    def read(parts):
        store, folder = _folder(uri)
        for pdf in parts:
            for name, base, n in pdf.itertuples(index=False):
                with store.open_input_stream(f"{folder}/{name}") as f:
                    data = np.frombuffer(f.read(), np.uint8)
                doc_ids, sizes, starts, total = read_head(data)
                if total != n:
                    raise ValueError(f"{name} has {total} tokens, the manifest says {n}")
                ids = unpack_blocks(data, starts).reshape(-1)[:total] if total else np.zeros(0, np.uint32)
                ends = np.cumsum(sizes.astype(np.int64))
                out = pd.DataFrame([row(ids[b - m : b]) for b, m in zip(ends.tolist(), sizes.tolist())], columns=names)
                out.insert(0, "n_tokens", sizes.astype(np.int64))
                out.insert(0, "start", base + ends - sizes)
                out.insert(0, "doc_id", pd.array(doc_ids, "Int64"))
                out.loc[doc_ids == NO_ID, "doc_id"] = pd.NA
                yield out

    files = max(1, manifest.count())
    return placed.repartition(min(files, 10_000), "name").mapInPandas(read, f"doc_id long, start long, n_tokens long, {schema}")


def op2_token_output(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """The files of write_token_files() read back by read_token_files(); nulls, empty texts, repeated rows, empty tables and clashing columns as said there."""
    import public_tokenizers

    uri = new_path(spark, "tokens")
    manifest = write_token_files(documents(spark, sf_dir), path or public_tokenizers.path("byte_bpe_50k.json"), uri)
    return read_token_files(manifest, uri, "ids_crc32 long", lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),))
