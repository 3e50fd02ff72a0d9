"""Best-fit packing of documents into sequences of bounded length, in bulk-synchronous rounds.

Documents are cut into pieces no longer than a sequence. Lengths are whole numbers up to the capacity, so the range-sorted
order of pieces is known by length and rank within the length, and that of gaps by room and rank within the room: both
sides are a bounded number of classes, whatever the input. In each round the longest class that is left sweeps the gaps: its
pieces ask for their successor, the smallest room that takes them; where more ask than there are gaps of that room, the
lower ranks win and the others ask for the next room; the filled gaps move to smaller classes. Pieces that no gap
takes open new sequences. Rounds repeat until no class is left, at most as many as the capacity. A round's plan is a list of
runs: ranks a..b of a length go to sequences s..t at an offset. Ranks are dealt out by counts of parts, as many as a length's pieces
need, and each piece finds its run by search, so no class of pieces meets in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, fresh, keyed_texts, mapped, written
from .fast_encode import batches, encoder, gathered

CAPACITY = 2048
#: Pieces of one length that are ranked together, about.
RANKED = 1_000
#: Cuts in the encoder's table and characters encoded together; where memory is short, less of both costs only time.
MAX_CUTS, GATHERED = 700_000, 8_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_into_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, max_cuts: int = MAX_CUTS, gathered_chars: int = GATHERED) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids and end_id, cut only where longer than capacity."""

    def cut(parts):
        own = encoder(path, max_cuts)
        for pdf in gathered(parts, gathered_chars):
            texts = pdf["text"].tolist()
            for a, b in batches(texts):
                ids, ends = own.encode(texts[a:b])
                ids, sizes = np.insert(ids, ends[1:], end_id).astype("<u4"), np.diff(ends) + 1
                counts = -(-sizes // capacity)
                doc = np.repeat(np.arange(b - a), counts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * capacity
                length = np.minimum(capacity, sizes[doc] - start)
                at = (np.cumsum(sizes) - sizes)[doc] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * x : 4 * (x + n)]) for x, n in zip(at.tolist(), length.tolist())]
                yield pd.DataFrame({"doc_id": pdf["doc_id"].array[a:b][doc], "piece": piece, "start": start, "length": length, "ids_crc32": crc})

    return mapped(keyed_texts(docs), cut, PIECES)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """counts: pieces of each length. Returns runs (length, first rank, last rank, first sequence, offset), and how many sequences.

    Rounds over classes only: their number and the runs depend on the distinct lengths, not on how many pieces there are.
    """
    gaps: dict[int, list[list[int]]] = {}  # room: runs [first sequence, how many]
    rooms: list[int] = []  # sorted
    runs, sequences = [], 0

    def free(room: int, first: int, n: int) -> None:
        if room:
            if room not in gaps:
                gaps[room] = []
                insort(rooms, room)
            gaps[room].append([first, n])

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        rank, n = 0, counts[length]
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):  # nothing takes them: new sequences, each with as many as go in
                each = capacity // length
                full, rest = divmod(n, each)
                for k in range(each) if full else ():
                    runs.append((length, rank + k * full, rank + (k + 1) * full - 1, sequences, k * length))
                free(capacity - each * length, sequences, full) if full else None
                rank, sequences = rank + each * full, sequences + full
                for k in range(rest):
                    runs.append((length, rank + k, rank + k, sequences, k * length))
                if rest:
                    free(capacity - rest * length, sequences, 1)
                    sequences += 1
                break
            room = rooms[at]
            first, many = gaps[room][-1]
            take = min(n, many)
            runs.append((length, rank, rank + take - 1, first, capacity - room))
            gaps[room].pop()
            if many > take:
                gaps[room].append([first + take, many - take])
            elif not gaps[room]:
                del gaps[room]
                rooms.pop(at)
            free(room - length, first, take)
            rank, n = rank + take, n - take
    return runs, sequences


class Plan:
    """The runs of best_fit(), found by length and rank in steps of halving."""

    def __init__(self, runs: list[tuple[int, int, int, int, int]]):
        told = np.array(sorted(runs), np.int64).reshape(-1, 5)
        self.length, self.first, _, self.sequence, self.offset = np.ascontiguousarray(told.T)
        self.starts = np.searchsorted(self.length, np.arange(self.length[-1] + 2 if len(told) else 1))

    def places(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sequence and offset of the pieces of these lengths and ranks."""
        low, high = self.starts[lengths], self.starts[lengths + 1]
        while (more := high - low > 1).any():
            middle = (low + high) // 2
            right = more & (self.first[np.minimum(middle, len(self.first) - 1)] <= ranks)
            low, high = np.where(right, middle, low), np.where(more & ~right, middle, high)
        return self.sequence[low] + ranks - self.first[low], self.offset[low]


def packed(pieces: DataFrame, capacity: int = CAPACITY, part: int = RANKED) -> DataFrame:
    """pieces (a table that reads the same each time) with sequence_id and offset; other columns stay, whatever their names.

    Order among pieces of one length is free, so ties, null or repeated doc_ids are all placed, each once. An empty table
    gives an empty result. Every length must be from 1 to capacity. part: pieces of a length that are ranked together, about.
    """
    spark = pieces.sparkSession
    salt, total, count, base, within, rank = (fresh(pieces.columns, n) for n in ("_salt", "_total", "_n", "_base", "_in", "_rank"))
    totals = written(pieces.groupBy("length").agg(F.count(F.lit(1)).alias(total)), "lengths")
    by_length = {r["length"]: r[total] for r in totals.collect()}  # at most capacity rows
    if any(not 1 <= n <= capacity for n in by_length):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    runs, _ = best_fit(by_length, capacity)
    plan = spark.sparkContext.broadcast(Plan(runs))
    # each length is ranked in as many parts as its pieces need
    parts = F.ceil(F.col(total) / part)
    salted = pieces.join(F.broadcast(totals), "length").withColumn(salt, F.pmod(F.xxhash64("doc_id", "piece"), parts)).drop(total)
    counts = written(salted.groupBy("length", salt).agg(F.count(F.lit(1)).alias(count)), "parts")
    before = Window.partitionBy("length").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", salt, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(base))
    ranked = salted.withColumn(within, F.row_number().over(Window.partitionBy("length", salt).orderBy("doc_id", "piece", "start")).cast("long") - 1)
    # a row for each part: as many as pieces / part, and a row for each length
    ranked = ranked.join(bases, ["length", salt]).withColumn(rank, F.col(within) + F.col(base))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.value.places(lengths.to_numpy(np.int64), ranks.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    at = fresh(pieces.columns, "_at")
    out = ranked.withColumn(at, place("length", rank))
    return out.select(*(F.col(c) for c in pieces.columns), F.col(f"{at}.sequence_id"), F.col(f"{at}.offset"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, **memory: int) -> DataFrame:
    """Pieces of all documents with their places. A null or empty text is one piece of one id (the end). Only doc_id and text are read.

    memory: max_cuts and gathered_chars of cut_into_pieces().
    """
    return packed(written(cut_into_pieces(docs, path, capacity, **memory), "pieces"), capacity)


def op8_best_fit(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """pack_documents() of all documents; nulls, empty texts, repeated rows, empty tables and clashing columns as said there and at packed()."""
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), path or public_tokenizers.path("word_bpe_49k.json"))
