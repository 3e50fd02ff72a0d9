"""Language-model scores: online logistic mixing of hashed-context bit predictors, beside a unigram base.

The model codes a text's bytes, then an end, by binary decisions. Symbols are the 62 most frequent bytes of the training texts,
the end and an escape; each symbol is a leaf of a Huffman tree over them, and a decision is a bit at an inner node. (A byte
behind the escape costs its share among such bytes after the byte before it.) Three predictors give each node a chance of 1: by
the last two symbols, by the last three (tables with a place for each context there can be), and by the word so far. The
last has counts for every beginning of every word of the training texts, however many: they grow with the texts, stay dealt to
buckets, and a word's row of chances is worked out once, for the vocabulary, not for each place. Beginnings that training texts
have fewer than LEAST times give even chances.

A mixer adds up the stretched chances with weights from the set that the node's depth selects, learns those weights online
while it reads, and a final table of corrections by stretched chance, learnt online too, refines the result. Weights and corrections
last from a text's first decision to its last. They learn from a group of decisions at a step, of GROUP decisions at first and
of a share of what has been read later on, at a rate that falls alike; texts are mixed side by side.

A word is what lies between white space, with the white space (or the end) that closes it. Each block of texts sends its distinct words
with their counts; words are dealt to buckets by ranges of their order in lower case, so that a bucket sees all ways to write a
word, and all words with a beginning unless a bound between buckets has that beginning too. Counts of those few beginnings are added up over
buckets first. Then buckets answer each block with the base's counts and the chances along its words.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import added_up, documents, drop, keyed_texts, mapped, partitions, slices, written
from .fast_encode import batches, forget

SYMBOLS = 64
END, ESCAPE = 62, 63
#: Contexts whose chances a bucket works out at a time.
CHUNK = 4096
#: Decisions of the first groups; a later group has 1 / SHARE of the decisions before it.
GROUP, SHARE = 32, 32
#: A mixer has a set of weights for the first DEEP decisions of a symbol and one for the others.
GATES, DEEP, BUCKETS = 2, 2, 16
RATE, REFINE = 0.02, 0.08
FIRST_WEIGHT = (0.35, 0.45, 0.35)
STEP = 8  # stretched chances are kept in steps of 1 / STEP
#: A beginning of words counts from so many occurrences on.
LEAST = 4
HOLD_OUT = 5
#: A block of texts ends with so many documents or bytes.
BLOCK_DOCS, BLOCK_BYTES = 16384, 6_000_000
#: Bytes of text for each bucket of words, whose number ends at MOST_BUCKETS: the bounds between them are broadcast.
BUCKET_BYTES, MOST_BUCKETS = 16_000_000, 8192
#: Of so many texts one gives words to choose the bounds from, of which so many with the smallest hashes are taken for each bucket.
SAMPLED_TEXTS, SAMPLED_WORDS = 40, 32
#: Bytes of texts that are mixed side by side.
MIXED_BYTES = 700_000
_K = np.uint64(0x9E3779B97F4A7C15)
_SPACES = frozenset(b" \t\n\x0b\x0c\r")
_KEYS = re.compile(rb"[^ \t-\r]*[ \t-\r]?").findall
_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _K and of its inverse modulo 2**64; kept, as every batch needs them."""
    if len(_POWERS[0]) < n:
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.cumprod(np.full(2 * n, k), dtype=np.uint64) for k in (_K, np.uint64(pow(int(_K), -1, 1 << 64)))]
    return _POWERS[0][:n], _POWERS[1][:n]


def keys_of(raw: bytes) -> list[bytes]:
    """The text's words in order, each with the white-space byte behind it; the last one, closed by the end, has none. They add up to the text."""
    found = _KEYS(raw)
    if raw and raw[-1] not in _SPACES:
        found.pop()
    return found


def _small(data: bytes, level: int = 1) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level).compress(data)


def _large(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _array(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(_large(data), kind)


def _told(keys: pa.Array) -> tuple[bytes, bytes]:
    """Lengths and bytes of keys."""
    offsets = np.frombuffer(keys.buffers()[1], "<i4", len(keys) + 1, 4 * keys.offset)
    data = keys.buffers()[2]
    return _small(np.diff(offsets).astype("<u4").tobytes()), _small(data.to_pybytes()[offsets[0] : offsets[-1]] if data else b"")


def _keys(lengths: bytes, data: bytes) -> pa.Array:
    sizes = _array(lengths, "<u4")
    offsets = np.zeros(len(sizes) + 1, "<i4")
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(_large(data))])


def lowered(keys: pa.Array) -> pa.Array:
    """The words without what closes them, in lower case."""
    return pc.ascii_rtrim(pc.ascii_lower(keys.view(pa.string())), " \t\n\x0b\x0c\r")


def _ordered(keys: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The order of keys by word in lower case, then as they are, and what they are ordered by."""
    by = pc.binary_join_element_wise(lowered(keys), keys.view(pa.string()), "\0").view(pa.binary())
    order = pc.sort_indices(by)
    return order.to_numpy(), by.take(order)


class _Bounds:
    """Where an order of words is cut into buckets. No bound has a byte 0, so all ways to write a word fall on one side of it."""

    def __init__(self, bounds: list[bytes]):
        self.bounds = bounds

    def cuts(self, by: pa.Array) -> list[int]:
        class At:
            __len__ = lambda _: len(by)
            __getitem__ = lambda _, i: by[i].as_py()

        return [bisect_left(At(), b) for b in self.bounds]


def trains(doc_id) -> bool:
    """Texts whose crc32(doc_id as text) mod HOLD_OUT isn't 1 are learnt from; so are those without doc_id."""
    return doc_id is None or doc_id is pd.NA or zlib.crc32(str(doc_id).encode()) % HOLD_OUT != 1


def _spans(begins: np.ndarray, length: np.ndarray) -> np.ndarray:
    """begins[i], begins[i] + 1, ... of each i as many as length says."""
    ends = np.cumsum(length, dtype=np.int64)
    shift = begins - (ends - length)
    return np.repeat(shift, length) + np.arange(ends[-1] if len(ends) else 0)


def beginnings(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each byte the hash of those since its word's start. starts: where each byte's word starts."""
    with np.errstate(over="ignore"):
        # differences of running sums of bytes times powers
        powers, inverse = _powers(len(raw))
        sums = np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)
        before = np.concatenate([np.zeros(1, np.uint64), sums[:-1]]) if len(sums) else sums
        so_far = (before - before[starts]) * inverse[starts]
        so_far = ((so_far ^ so_far >> np.uint64(29)) + np.uint64(7)) * _K
        so_far = (so_far ^ so_far >> np.uint64(32)) * _K
        return so_far ^ so_far >> np.uint64(29)


def groups_of(decisions: int):
    """(first, number) of the groups in which a text of so many decisions is learnt from."""
    at = 0
    while at < decisions:
        n = max(GROUP, at // SHARE)
        yield at, n
        at += n


class Model:
    """Codes of the symbols, and the tables of the predictors by the last two and three symbols. Its size is the same for every corpus."""

    def __init__(self, pairs: np.ndarray, texts: int):
        """pairs: how often a byte (column) comes after another (row; at a text's start after byte 0); texts: how many."""
        counts = pairs.sum(axis=0)
        order = np.argsort(-counts, kind="stable")
        self.symbol = np.full(256, ESCAPE, np.uint8)
        self.symbol[order[:END]] = np.arange(END)
        rare = self.symbol == ESCAPE
        share = np.where(rare, counts + 1.0, 0)
        share /= share.sum()
        own = np.where(rare, pairs + share, 0)
        with np.errstate(divide="ignore"):
            self.escape_bits = np.where(rare, -np.log2(own / own.sum(axis=1, keepdims=True)), 0).astype(np.float32)
        weights = np.zeros(SYMBOLS)
        weights[:END] = counts[order[:END]]
        weights[END], weights[ESCAPE] = texts, counts[order[END:]].sum()
        self._tree(weights + 0.5)
        self.two, self.three = np.zeros(SYMBOLS**3, np.int8), np.zeros(SYMBOLS**4, np.int8)

    def _tree(self, weights: np.ndarray) -> None:
        """A Huffman tree: nodes are numbered from the root on, all symbols' paths end to end in two arrays."""
        heap = [(w, i, (i,)) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        kids: dict[int, tuple] = {}
        fresh = SYMBOLS
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            kids[fresh] = (a[1], b[1])
            heapq.heappush(heap, (a[0] + b[0], fresh, ()))
            fresh += 1
        paths: dict[int, list] = {}
        number, stack = 0, [(heap[0][1], [])]
        while stack:
            at, path = stack.pop(0)
            if at < SYMBOLS:
                paths[at] = path
                continue
            for bit in (0, 1):
                stack.append((kids[at][bit], [*path, (number, bit)]))
            number += 1
        self.length = np.array([len(paths[s]) for s in range(SYMBOLS)], np.int64)
        self.path_start = np.cumsum(self.length) - self.length
        # each step of the paths, end to end: node, gate and bit
        self.steps = np.array([n | (d >= DEEP) << 6 | bit << 8 for s in range(SYMBOLS) for d, (n, bit) in enumerate(paths[s])], np.int16)
        self.ones = np.zeros((SYMBOLS, SYMBOLS))  # symbols that go right at a node
        self.all = np.zeros((SYMBOLS, SYMBOLS))
        for s in range(SYMBOLS):
            for n, bit in paths[s]:
                self.all[s, n] = 1
                self.ones[s, n] = bit

    def stretched(self, counts: np.ndarray) -> np.ndarray:
        """counts of symbols (rows: contexts) -> ln(p / (1 - p)) at each node, in steps, as int8."""
        ones, every = counts @ self.ones, counts @ self.all
        p = (ones + 0.2) / (every + 0.4)
        return np.clip(np.rint(np.log(p / (1 - p)) * STEP), -127, 127).astype(np.int8)

    def symbols(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of the texts with a place for each end, the symbols there, where texts start, where they end."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        ends = np.cumsum(sizes + 1) - 1
        symbols = self.symbol[raw]
        symbols[ends] = END
        return raw, symbols, ends - sizes, ends

    @staticmethod
    def last_three(symbols: np.ndarray) -> np.ndarray:
        """The three symbols before each place as a number, the nearest one lowest; before a text stand ends."""
        # what stands before a text is the end of the one before; behind that everything counts as an end
        padded = np.concatenate([np.full(3, END, np.uint8), symbols])
        first, second, third = padded[2:-1], padded[1:-2].copy(), padded[:-3].copy()
        second[first == END] = END
        third[second == END] = END
        out = third.astype(np.int32)
        for nearer in (second, first):
            out <<= 6
            out |= nearer
        return out

    def words(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words end to end: for each place a hash of what it begins and the symbol there (the lowest bits); the symbol; places of each word."""
        offsets = np.frombuffer(keys.buffers()[1], "<i4", len(keys) + 1, 4 * keys.offset).astype(np.int64)
        data = keys.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
        sizes, ends = np.diff(offsets), offsets[1:] - offsets[0]
        last = np.where(sizes > 0, raw[np.maximum(ends - 1, 0)] if len(raw) else 0, 65)
        open_ = ~((last == 32) | ((last >= 9) & (last <= 13)))
        # an end stands behind the words that nothing closes
        symbols = np.insert(self.symbol[raw], ends[open_], END)
        raw = np.insert(raw, ends[open_], 0)
        sizes = sizes + open_
        starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
        return beginnings(raw, starts) & ~np.uint64(SYMBOLS - 1) | symbols, symbols, sizes

    def path_levels(self, pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Stretched chances along the paths of sorted distinct pairs, as words() gives them, end to end; counts: of training texts."""
        contexts, symbols = pairs >> np.uint64(6), (pairs & np.uint64(SYMBOLS - 1)).astype(np.int64)
        fresh = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]])) if len(pairs) else np.zeros(0, np.int64)
        number = np.zeros(len(contexts), np.int64)
        number[fresh[1:]] = 1
        number = np.cumsum(number)
        length = self.length[symbols]
        out = np.zeros(int(length.sum()), np.int8)
        often = np.add.reduceat(counts, fresh) >= LEAST if len(fresh) else np.zeros(0, bool)
        own = np.flatnonzero(often[number])
        starts = (np.cumsum(length) - length)[own]
        rank = np.cumsum(often) - 1
        there_all, cuts = rank[number[own]], np.arange(0, int(often.sum()) + CHUNK, CHUNK)
        edges = np.searchsorted(there_all, cuts)
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            if a == b:
                continue
            there, some = there_all[a:b] - k * CHUNK, symbols[own[a:b]]
            dense = np.zeros((int(there[-1]) + 1, SYMBOLS))
            dense[there, some] = counts[own[a:b]]
            n = self.length[some]
            node = self.steps[_spans(self.path_start[some], n)] & 63
            out[_spans(starts[a:b], n)] = self.stretched(dense).ravel()[np.repeat(there * SYMBOLS, n) + node]
        return out

    def bits(self, texts: list[bytes], by_word: np.ndarray) -> np.ndarray:
        """Bits that each text and its end take. by_word: the word predictor's chances for all decisions, end to end."""
        raw, symbols, starts, ends = self.symbols(texts)
        length = self.length[symbols]
        step = self.steps.take(_spans(self.path_start[symbols], length))
        sizes = np.add.reduceat(length, starts)
        last = self.last_three(symbols)
        node = (step & np.int16(63)).astype(np.int32)
        x = []
        for table, c in ((self.two, last & 4095), (self.three, last)):
            at = np.repeat(c << 6, length)
            at += node
            x.append(table.take(at))
        out = mixed([*x, by_word], step, sizes)
        rare = np.flatnonzero(symbols == ESCAPE)
        before = np.where(np.isin(rare, starts), 0, raw[rare - 1])
        owner = np.searchsorted(ends, rare)
        return out + np.bincount(owner, weights=self.escape_bits[before, raw[rare]], minlength=len(texts))


def _side_by_side(flat: list[np.ndarray], begins: list[int], sizes: list[int], spare: int) -> np.ndarray:
    """texts x arrays x places of what stands end to end in some arrays; room for spare more behind the longest text."""
    out = np.zeros((len(sizes), len(flat), max(sizes) + spare), flat[0].dtype)
    for row, a, n in zip(out, begins, sizes):
        for to, own in zip(row, flat):
            to[:n] = own[a : a + n]
    return out


def mixed(x: list[np.ndarray], step: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bits of texts whose decisions (so many of each) stand end to end in x and step."""
    order = np.argsort(-sizes, kind="stable")
    begins, left, rows, k = (np.cumsum(sizes) - sizes)[order], sizes[order], len(sizes), len(x)
    longest = int(left[0]) if rows else 0
    spare = max((n for _, n in groups_of(longest)), default=0)
    x, step = _side_by_side(x, begins.tolist(), left.tolist(), spare), _side_by_side([step], begins.tolist(), left.tolist(), spare)[:, 0]
    # of weights: texts x gates x inputs; for inputs in steps, which saves scaling the inputs
    weights = np.empty((rows, GATES, k), np.float32)
    weights[:] = np.array(FIRST_WEIGHT, np.float32) / STEP
    refined = np.tile((1 / (1 + np.exp(-(np.arange(BUCKETS) - BUCKETS / 2 + 0.5)))).astype(np.float32), rows)
    cost = np.zeros(rows)
    # whole numbers below 2**24 are exact as float32, and so many texts aren't mixed at once
    buckets = np.arange(rows, dtype=np.float32)[:, None] * BUCKETS + np.float32(BUCKETS / 2)
    half, one, down = np.float32(0.5), np.float32(1), -left
    for a, n in groups_of(longest):
        active = int(np.searchsorted(down, -a))  # texts that go on beyond a
        told = step[:active, a : a + n]
        s = x[:active, :, a : a + n].astype(np.float32)
        y, gate = (told >> 8).astype(np.float32), (told >> 6 & 1).astype(np.float32)
        real = None if left[active - 1] >= a + n else (np.arange(a, a + n) < left[:active, None]).astype(np.float32)
        first, second = np.moveaxis(weights[:active] @ s, 1, 0)
        dot = second - first
        dot *= gate
        dot += first
        np.clip(dot, np.float32(-7.9), np.float32(7.9), out=dot)
        bucket = (buckets[:active] + dot).astype(np.int64)
        p = np.exp(np.negative(dot, out=dot), out=dot)
        p += one
        np.reciprocal(p, out=p)
        q = refined.take(bucket)
        # the chance of what came: of 1, or what is left of 1
        final = p + q
        final *= half
        final += y
        final -= one
        np.abs(final, out=final)
        np.log2(final, out=final)
        wrong, off = np.subtract(y, p, out=p), np.subtract(y, q, out=q)
        if real is not None:
            final *= real
            wrong *= real
            off *= real
        cost[:active] -= final.sum(axis=1, dtype=np.float64)
        slower = GROUP / n
        wrong *= np.float32(RATE / STEP**2 * slower)
        by_gate = np.empty((active, GATES, n), np.float32)
        np.multiply(wrong, gate, out=by_gate[:, 1])
        np.subtract(wrong, by_gate[:, 1], out=by_gate[:, 0])
        weights[:active] += by_gate @ s.transpose(0, 2, 1)
        drift = np.bincount(bucket.ravel(), weights=off.ravel(), minlength=active * BUCKETS)
        refined[: active * BUCKETS] += (np.float32(REFINE / 4 * slower) * drift).astype(np.float32)
        np.clip(refined, 0.001, 0.999, out=refined)
    out = np.empty(rows)
    out[order] = cost
    return out


def _learnt(pdf: pd.DataFrame, every: bool) -> list[bytes]:
    return [t.encode() for d, t in zip(pdf["doc_id"].tolist(), pdf["text"]) if every or trains(d)]


def alphabet(docs: DataFrame, every: bool = False) -> tuple[Model, int, int, list[bytes]]:
    """The symbols' codes from the training texts (every: all texts), how many these are, the bytes of all texts, and bounds between buckets
    of words. At most 65,538 numbers and SAMPLED_WORDS words for each bucket are collected."""

    def count(parts):
        total, texts, size, seen, sample = np.zeros(1 << 16, np.int64), 0, 0, 0, {}
        most = SAMPLED_WORDS * 64
        for pdf in parts:
            size += sum(map(len, pdf["text"]))
            own = _learnt(pdf, every)
            texts += len(own)
            for a, b in batches(own, 2_000_000):
                # a byte 0 before each text; what comes after one's end isn't counted
                raw = np.frombuffer(b"\0" + b"\0".join(own[a:b]), np.uint8).astype(np.uint16)
                starts = np.cumsum(np.fromiter(map(len, own[a:b]), np.int64, b - a) + 1)[:-1]
                codes = np.delete(raw[:-1] << 8 | raw[1:], starts - 1)
                total += np.bincount(codes, minlength=1 << 16)
            for text in pdf["text"].iloc[-seen % SAMPLED_TEXTS :: SAMPLED_TEXTS]:
                words = {w for w in text.encode().lower().split() if 0 not in w}
                sample |= {zlib.crc32(w): w for w in words}
            seen += len(pdf)
            if len(sample) > 4 * most:
                sample = {h: sample[h] for h in sorted(sample)[:most]}
        at = np.flatnonzero(total)
        yield pd.DataFrame({"code": [*at, 1 << 16, 1 + (1 << 16)], "n": [*total[at], texts, size], "word": None})
        own = sorted(sample)[:most]
        yield pd.DataFrame({"code": -1, "n": own, "word": [sample[h] for h in own]})

    told = written(mapped(keyed_texts(docs), count, "code int, n long, word binary"), "alphabet")
    found = dict(told.where("code >= 0").groupBy("code").agg(F.sum("n").alias("n")).collect())
    pairs = np.array([found.get(c, 0) for c in range(1 << 16)], np.float64).reshape(256, 256)
    size = found.get(1 + (1 << 16), 0)
    buckets = min(MOST_BUCKETS, max(64, slices(docs.sparkSession), -(-size // BUCKET_BYTES)))
    words = sorted(bytes(r["word"]) for r in told.where("code < 0").select("n", "word").distinct().orderBy("n").limit(SAMPLED_WORDS * buckets).collect())
    drop(told)
    bounds = sorted({words[len(words) * i // buckets] for i in range(1, buckets)}) if words else []
    return Model(pairs, found.get(1 << 16, 0)), found.get(1 << 16, 0), size, bounds


ROW = "bucket long, block long, a binary, b binary, c binary, d binary"
_COLUMNS = ["bucket", "block", "a", "b", "c", "d"]
_HEAD = np.dtype([("doc_id", "<i8"), ("none", "?"), ("held_out", "?"), ("size", "<i8")])
#: Kinds of rows: a block's texts; from TABLES down parts of the tables. Blocks of rows that a bucket has of its own.
TEXTS, TABLES = -1, -2
WORDS, TOTALS, ACROSS = -1, -2, -3


def _blocks(docs: DataFrame, held, bounds: _Bounds, learn: bool | None, tables: bool) -> DataFrame:
    """Rows (ROW): each block's texts; its distinct words with how often training texts have them, dealt to buckets; and where tables is
    True, each task's counts for the tables by the last two and three symbols. learn: all texts train, or none; None: those that trains() says."""

    def send(parts):
        from pyspark import TaskContext

        part, block, heads, whole, learnt, counts, others, weight = TaskContext.get().partitionId(), 0, [], [], [], Counter(), set(), 0
        forget()
        total = np.zeros(SYMBOLS**4 if tables else 0, np.int32)

        def flush():
            name = part << 20 | block
            for a, b in batches(learnt if tables else [], 2_000_000):
                _, symbols, _, _ = held.value.symbols(learnt[a:b])
                np.add.at(total, held.value.last_three(symbols) << 6 | symbols, np.int32(1))
            others.difference_update(counts)
            keys = pa.array([*counts, *others], pa.binary())
            n = np.concatenate([np.fromiter(counts.values(), "<u4", len(counts)), np.zeros(len(others), "<u4")])
            order, by = _ordered(keys)
            keys, n = keys.take(pa.array(order)), n[order]
            cuts = [0, *bounds.cuts(by), len(keys)]
            rows = [(TEXTS, name, np.array(heads, _HEAD).tobytes(), _small(b"".join(whole), 3), None, None)]
            rows += [(b, name, *_told(keys[x:y]), _small(n[x:y].tobytes()), None) for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
            return pd.DataFrame(rows, columns=_COLUMNS)

        for pdf in parts:
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"]):
                raw, none, trained = text.encode(), doc_id is pd.NA, trains(doc_id)
                heads.append((0 if none else doc_id, none, not trained, len(raw)))
                whole.append(raw)
                if trained if learn is None else learn:
                    learnt.append(raw)
                    counts.update(keys_of(raw))
                else:
                    others.update(keys_of(raw))
                weight += len(raw) + 1
                if len(heads) == BLOCK_DOCS or weight >= BLOCK_BYTES:
                    yield flush()
                    block, heads, whole, learnt, counts, others, weight = block + 1, [], [], [], Counter(), set(), 0
        if heads:
            yield flush()
        by_last = total.reshape(SYMBOLS, -1)
        for i, own in enumerate([*by_last, by_last.sum(axis=0)] if tables else []):
            at = np.flatnonzero(own)
            if len(at):
                yield pd.DataFrame([(TABLES - i, 0, at.astype("<u4").tobytes(), own[at].astype("<u8").tobytes(), None, None)], columns=_COLUMNS)

    return written(mapped(keyed_texts(docs), send, ROW), "blocks")


def _learn_tables(sent: DataFrame, model: Model) -> None:
    """Fills the model's tables by the last two and three symbols. SYMBOLS + 1 rows of 256 KB at most are collected."""
    part, stretched = SYMBOLS**3, model.stretched

    def levels(places: np.ndarray, counts: np.ndarray) -> bytes:
        return _small(stretched(np.bincount(places, weights=counts, minlength=part).reshape(-1, SYMBOLS)).tobytes())

    parts = sent.where(F.col("bucket") <= TABLES).select((TABLES - F.col("bucket")).alias("part"), F.col("a").alias("places"), F.col("b").alias("counts"))
    for r in added_up(parts, levels).collect():
        own = _array(r["told"], np.int8)
        if r["part"] == SYMBOLS:
            model.two[:] = own
        else:
            model.three[r["part"] * part : (r["part"] + 1) * part] = own


def _across(keys: pa.Array, known: np.ndarray) -> np.ndarray:
    """For each place of words whether what it begins, in lower case, is one of known (sorted hashes)."""
    sizes = pc.binary_length(keys).to_numpy(zero_copy_only=False).astype(np.int64)
    low = pc.ascii_lower(keys.view(pa.string())).view(pa.binary())
    data = low.buffers()[2]
    offsets = np.frombuffer(low.buffers()[1], "<i4", len(low) + 1, 4 * low.offset)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    last = np.where(sizes > 0, raw[np.maximum(np.cumsum(sizes) - 1, 0)] if len(raw) else 0, 65)
    open_ = ~((last == 32) | ((last >= 9) & (last <= 13)))
    raw = np.insert(raw, np.cumsum(sizes)[open_], 0)
    sizes = sizes + open_
    hashes = beginnings(raw, np.repeat(np.cumsum(sizes) - sizes, sizes))
    at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
    return known[at] == hashes if len(known) else np.zeros(len(hashes), bool)


def _vocabulary(asked: DataFrame, held, bounds: _Bounds, tasks: int) -> DataFrame:
    """Rows (ROW) for each bucket: its distinct words with their counts and the base's counts (WORDS); all words of training texts and
    distinct ones, ends not counted (TOTALS); and what follows, how often, beginnings that a bound has too (ACROSS)."""
    known = {b""} | {b[:k] for b in bounds.bounds for k in range(1, len(b) + 1)}
    raws = [np.frombuffer(k + b"\0", np.uint8) for k in known]
    known = np.sort(np.array([beginnings(r, np.zeros(len(r), np.int64))[-1] for r in raws], np.uint64))

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        chunks = [_keys(a, b) for a, b in zip(pdf["a"], pdf["b"])]
        n = pa.chunked_array([pa.array(_array(c, "<u4").astype(np.int64)) for c in pdf["c"]])
        summed = pa.table({"k": pa.chunked_array(chunks), "n": n}).group_by("k").aggregate([("n", "sum")])
        keys, n = summed["k"].combine_chunks(), summed["n_sum"].to_numpy()
        low = lowered(keys).dictionary_encode()
        sums = np.bincount(low.indices.to_numpy(), weights=n).astype(np.int64)
        real = pc.not_equal(low.dictionary, "").to_numpy(zero_copy_only=False)
        pairs, _, sizes = held.value.words(keys)
        across = np.flatnonzero(_across(keys, known))
        found, place = np.unique(pairs[across], return_inverse=True)
        follow = np.bincount(place, weights=np.repeat(n, sizes)[across], minlength=len(found)).astype("<i8")
        rows = [
            (WORDS, *_told(keys), _small(n.astype("<i8").tobytes()), _small(sums[low.indices.to_numpy()].astype("<i8").tobytes())),
            (TOTALS, np.array([sums[real].sum(), (sums[real] > 0).sum()], "<i8").tobytes(), None, None, None),
            (ACROSS, found.astype("<u8").tobytes(), follow.tobytes(), None, None),
        ]
        return pd.DataFrame([(pdf["bucket"].iloc[0], *r) for r in rows], columns=_COLUMNS)

    return written(asked.repartition(tasks, "bucket").groupBy("bucket").applyInPandas(add_up, ROW), "vocabulary")


def scores(docs: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits (the total by the model, of the
    text and its end), bits_per_byte (bits over the text's bytes, over 1 for an empty text).

    A null or empty text is its end alone. Rows without doc_id are learnt from and scored; repeated rows count as often as they
    occur. Without any training text every count is 0 and all chances are even. An empty table gives an empty
    result. Only doc_id and text are read of docs, whatever the others' names. Beginnings of words are told apart by 64-bit hashes, words
    as they are. learn_from: documents (doc_id, text) to learn from, all of them, instead of docs' own that aren't held out.
    """
    spark = docs.sparkSession
    source, every = (docs, False) if learn_from is None else (learn_from, True)
    model, texts, size, cut = alphabet(source, every)
    tasks = partitions(spark, size, BUCKET_BYTES)
    bounds, held = _Bounds(cut), spark.sparkContext.broadcast(model)
    sent = _blocks(docs, held, bounds, None if learn_from is None else False, learn_from is None)
    asked = sent.where("bucket >= 0")
    learnt = sent if learn_from is None else _blocks(learn_from, held, bounds, True, True)
    words = _vocabulary(asked if learn_from is None else asked.unionByName(learnt.where("bucket >= 0")), held, bounds, tasks)
    _learn_tables(learnt, model)
    held.unpersist()
    held = spark.sparkContext.broadcast(model)
    totals = [np.frombuffer(r["a"], "<i8") for r in words.where(F.col("block") == TOTALS).collect()]
    n, v = (int(x) for x in np.sum([np.array([texts, texts > 0]), *totals], axis=0))
    # bounded by the bounds between buckets: a few hundred numbers for each
    found = words.where(F.col("block") == ACROSS).collect()
    pairs, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["a"], "<u8") for r in found)]), return_inverse=True)
    follow = np.bincount(place, weights=np.concatenate([np.zeros(0), *(np.frombuffer(r["b"], "<i8") for r in found)]), minlength=len(pairs))
    across = spark.sparkContext.broadcast((pairs, follow))

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        forget()
        own, asks = pdf[pdf["block"] == WORDS].iloc[0], pdf[pdf["block"] >= 0]
        keys, c, many = _keys(own["a"], own["b"]), _array(own["d"], "<i8"), _array(own["c"], "<i8")
        pairs, symbols, sizes = held.value.words(keys)
        there, sums = across.value
        order = np.argsort(pairs)
        ranked = pairs[order]
        fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(order) else np.zeros(0, bool)
        first = np.flatnonzero(fresh)
        counts = np.add.reduceat(np.repeat(many, sizes)[order], first).astype(np.float64) if len(first) else np.zeros(0)
        # beginnings that other buckets have too: what follows them is counted over all buckets
        own = ranked[first]
        alone = ~np.isin(own >> np.uint64(6), there >> np.uint64(6))
        every = np.concatenate([own[alone], there])
        again = np.argsort(every)
        every = every[again]
        levels = held.value.path_levels(every, np.concatenate([counts[alone], sums])[again])
        length = held.value.length[(every & np.uint64(SYMBOLS - 1)).astype(np.int64)]
        starts = np.cumsum(length) - length
        of_place = np.empty(len(order), np.int64)
        of_place[order] = np.searchsorted(every, own)[np.cumsum(fresh) - 1]
        per_place = held.value.length[symbols]
        flat = levels[_spans(starts[of_place], per_place)]
        ends = np.cumsum(sizes)
        steps = np.concatenate([[0], np.cumsum(per_place)])
        begin, many_steps = steps[ends - sizes], steps[ends] - steps[ends - sizes]
        rows = []
        for bucket, block, a, b in zip(asks["bucket"], asks["block"], asks["a"], asks["b"]):
            i = pc.index_in(_keys(a, b), keys).to_numpy()
            rows.append((bucket, block, None, _small(c[i].astype("<i8").tobytes()), _small(many_steps[i].astype("<u4").tobytes()), _small(flat[_spans(begin[i], many_steps[i])].tobytes())))
        return pd.DataFrame(rows, columns=_COLUMNS)

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        forget()
        told, back = pdf[pdf["bucket"] < 0].iloc[0], pdf[pdf["bucket"] >= 0].sort_values("bucket")
        heads = np.frombuffer(told["a"], _HEAD)
        ends, blob = np.cumsum(heads["size"]).tolist(), _large(told["b"])
        whole = [blob[e - n : e] for e, n in zip(ends, heads["size"].tolist())]
        c, lengths, levels = (np.frombuffer(b"".join(map(_large, back[x])), t) for x, t in (("b", "<i8"), ("c", "<u4"), ("d", np.int8)))
        lengths = lengths.astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        placed = [np.fromiter(map(number.__getitem__, keys_of(t)), np.int32) for t in whole]
        # answers stand in the order in which words were sent
        keys = pa.array(list(number), pa.binary())
        place = np.empty(len(number), np.int64)
        place[_ordered(keys)[0]] = np.arange(len(number))
        real = pc.not_equal(lowered(keys), "").to_numpy(zero_copy_only=False)
        logs = np.where(real, np.log10(c[place] + 0.5), 0)
        known = real & (c[place] > 0)
        rows = [(int(real[p].sum()) + 1, int(known[p].sum()) + (texts > 0), float(logs[p].sum()) + np.log10(texts + 0.5)) for p in placed]
        bits = np.zeros(len(whole))
        by_size = np.argsort(heads["size"], kind="stable")
        for a, b in batches([whole[i] for i in by_size], MIXED_BYTES):
            own = by_size[a:b]
            at = place[np.concatenate([placed[i] for i in own])]
            bits[own] = held.value.bits([whole[i] for i in own], levels[_spans(starts[at], lengths[at])])
        out = pd.DataFrame(rows, columns=["n_tokens", "n_known", "logs"])
        return out.assign(doc_id=pd.arrays.IntegerArray(heads["doc_id"].copy(), heads["none"].copy()), held_out=heads["held_out"], bits=bits, n_bytes=heads["size"])[names]

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, bits double, n_bytes long"
    names = [x.split()[0] for x in schema.split(", ")]
    answers = asked.drop("c").withColumn("c", F.lit(None).cast("binary")).unionByName(words.where(F.col("block") == WORDS)).repartition(tasks, "bucket").groupBy("bucket").applyInPandas(answer, ROW)
    rows = sent.where(F.col("bucket") == TEXTS).unionByName(answers).repartition(partitions(spark, size, BLOCK_BYTES), "block").groupBy("block").applyInPandas(gather, schema)
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * float(np.log10(n + 0.5 * (v + 1)))).alias("base_score"),
        (F.col("bits") * float(-np.log10(2))).alias("score"), "bits", (F.col("bits") / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scores() of all documents; nulls, empty texts, repeated rows, empty tables and clashing columns as said there."""
    return scores(documents(spark, sf_dir))
