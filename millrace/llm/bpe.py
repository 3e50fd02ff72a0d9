"""Byte-level BPE encoding and decoding by segment trees over the ranks of adjacent pairs.

The leaves of a piece's tree hold rank * size + position of each adjacent pair, inner nodes the smaller
child. So the root names the leftmost pair of the lowest rank; a merge changes three leaves, each carried up in
logarithmic steps, until no pair is mergeable. Short pieces of like length share one array of trees, so a step is
taken for all of them at once; long pieces have a tree each. Distinct pieces are merged once for each worker's table.
"""

from __future__ import annotations

import hashlib
import json
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .common import documents, keyed_texts, mapped
from .fast_encode import Encoder, batches, byte_letters, gathered, kind_of

NONE = np.int64(1) << 60
#: Pieces of up to so many bytes share arrays of trees.
SHARED = 128
#: Cuts in a worker's table, half as many pieces beside them, and characters encoded together: where memory is short, less of them costs only time.
MAX_CUTS, GATHERED = 400_000, 5_000_000


class SegmentTreeBPE(Encoder):
    """encode() as of Encoder, with merges of its own; decode(ids) -> text."""

    def _open(self, path: str) -> None:
        import regex

        if kind_of(path) != "keeping":
            raise ValueError("the file's split rules aren't those of a byte-level vocabulary")
        # fixed value: the pattern by which byte-level vocabularies split texts
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        vocabulary, letters = told["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else lambda t: [t]
        self.token_bytes = [b""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for token, i in vocabulary.items():
            self.token_bytes[i] = token.encode() if token in self.special else bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.byte_id = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.byte_id[b] = vocabulary[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.cuts = self.keeps_space = True
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def _merge(self, pieces: list[bytes], width: int) -> list[list[int]]:
        """All pieces at once; width: a power of two, each piece is shorter or as long."""
        n, levels = len(pieces), width.bit_length() - 1
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        ids = np.zeros((n, width + 1), np.int64)
        inside = np.arange(width + 1) < sizes[:, None]
        ids[inside] = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        tree = np.full((n, 2 * width), NONE)
        paired = inside[:, 1:]
        ranks = self._ranks(ids[:, :-1][paired], ids[:, 1:][paired])
        places = np.broadcast_to(np.arange(width), (n, width))[paired]
        tree[:, width:][paired] = np.where(ranks < 0, NONE, ranks * width + places)
        for level in range(levels - 1, -1, -1):
            a = 1 << level
            tree[:, a : 2 * a] = np.minimum(tree[:, 2 * a : 4 * a : 2], tree[:, 2 * a + 1 : 4 * a : 2])
        alive = np.ones((n, width + 1), bool) & inside
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            root = tree[rows, 1]
            i, new = root % width, self.made[root // width]
            j = after[rows, i]
            k = after[rows, j]
            ids[rows, i], after[rows, i], alive[rows, j] = new, k, False
            has_next = k < sizes[rows]
            before[rows[has_next], k[has_next]] = i[has_next]
            p = before[rows, i]
            has_last = p >= 0
            right, left = np.full(len(rows), NONE), np.full(len(rows), NONE)
            r, x = rows[has_next], self._ranks(new[has_next], ids[rows[has_next], k[has_next]])
            right[has_next] = np.where(x < 0, NONE, x * width + i[has_next])
            r, x = rows[has_last], self._ranks(ids[rows[has_last], p[has_last]], new[has_last])
            left[has_last] = np.where(x < 0, NONE, x * width + p[has_last])
            self._point(tree, rows, np.minimum(j, width - 1), np.full(len(rows), NONE))
            self._point(tree, rows, i, right)
            self._point(tree, r, p[has_last], left[has_last])
            rows = rows[tree[rows, 1] < NONE]
        lengths = alive.sum(1)
        flat = ids[alive].tolist()
        ends = np.cumsum(lengths).tolist()
        return [flat[b - m : b] for b, m in zip(ends, lengths.tolist())]

    @staticmethod
    def _point(tree: np.ndarray, rows: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        """Set one leaf of each row's tree and carry it up."""
        at = leaf + tree.shape[1] // 2
        tree[rows, at] = value
        while len(at) and at[0] > 1:
            at = at >> 1
            tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

    def _merge_long(self, piece: bytes) -> list[int]:
        ids = self.byte_id[np.frombuffer(piece, np.uint8)]
        n, width = len(ids), 1 << (len(ids) - 1).bit_length()
        leaves = np.full(width, NONE)
        ranks = self._ranks(ids[:-1], ids[1:])
        leaves[: n - 1] = np.where(ranks < 0, NONE, ranks * width + np.arange(n - 1))
        layers = [leaves]
        while len(layers[-1]) > 1:
            layers.append(np.minimum(layers[-1][::2], layers[-1][1::2]))
        tree = np.concatenate([[NONE], *layers[::-1]]).tolist()
        ids, after, before, none = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1)), int(NONE)
        if not hasattr(self, "rank_of"):
            self.rank_of = {(int(k) >> 32, int(k) & 0xFFFFFFFF): int(r) for k, r in zip(self.pair_keys, self.pair_ranks)}
        rank_of, made = self.rank_of, self.made.tolist()

        def point(leaf: int, value: int) -> None:
            at = leaf + width
            tree[at] = value
            while at > 1:
                at >>= 1
                a, b = tree[2 * at], tree[2 * at + 1]
                tree[at] = a if a < b else b

        def value(i: int, j: int) -> int:
            rank = rank_of.get((ids[i], ids[j]))
            return none if rank is None else rank * width + i

        while (root := tree[1]) < none:
            i = root % width
            j = after[i]
            k = after[j]
            ids[i], after[i], ids[j] = made[root // width], k, -1
            point(j, none)
            if k < n:
                before[k] = i
            point(i, value(i, k) if k < n else none)
            if (p := before[i]) >= 0:
                point(p, value(p, i))
        return [i for i in ids if i >= 0]

    def _learn_pieces(self, pieces: list[str]) -> None:
        raw = [p.encode() for p in pieces]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        for width in (8, 16, 32, 64, SHARED):
            own = np.flatnonzero((sizes <= width) & (sizes > (width // 2 if width > 8 else 0)))
            for at in range(0, len(own), 1 << 20 >> width.bit_length()):
                some = own[at : at + (1 << 20 >> width.bit_length())].tolist()
                for i, ids in zip(some, self._merge([raw[i] for i in some], width)):
                    self.pieces[pieces[i]] = ids
        for i in np.flatnonzero(sizes > SHARED).tolist():
            self.pieces[pieces[i]] = self._merge_long(raw[i])

    def _whole(self, texts: list[str]) -> list[list[int]]:
        if len(self.pieces) > self.max_cuts // 2:
            self.pieces.clear()
        split = [[([], p) if p in self.special else (self.split(p), None) for p in self.parts(t)] if "<|" in t else [(self.split(t), None)] for t in texts]
        new = {p for t in split for own, _ in t for p in own if p not in self.pieces}
        if new:
            self._learn_pieces(list(new))
        get = self.pieces.__getitem__
        return [list(chain.from_iterable([self.special[s]] if s is not None else chain.from_iterable(map(get, own)) for own, s in t)) for t in split]

    def _cut_ids(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._whole(cuts)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths

    def decode(self, ids: list[int]) -> str:
        """Bytes that aren't UTF-8 become U+FFFD; ids outside the vocabulary add nothing."""
        known = self.token_bytes
        if len(ids) and max(ids) >= len(known):
            ids = [i for i in ids if i < len(known)]
        return b"".join(map(known.__getitem__, ids)).decode("utf-8", "replace")


_CODERS: dict[str, SegmentTreeBPE] = {}


def coder(path: str) -> SegmentTreeBPE:
    if path not in _CODERS:
        _CODERS[path] = SegmentTreeBPE(path, MAX_CUTS)
    return _CODERS[path]


def encoded(docs: DataFrame, path: str, schema: str, row) -> DataFrame:
    """For each text one row: doc_id, then what row(coder, ids) returns, typed by schema.

    A null or empty text has no ids. Rows keep their number: null, repeated or tied doc_ids are encoded like any
    other. Only doc_id and text are read of docs. The vocabulary file is read by each worker at path.
    """

    def encode(parts):
        own = coder(path)
        for pdf in gathered(parts, GATHERED):
            texts = pdf["text"].tolist()
            out = []
            for a, b in batches(texts):
                ids, ends = own.encode(texts[a:b])
                out += [row(own, ids[x:y]) for x, y in zip(ends[:-1], ends[1:])]
            yield pd.concat([pdf[["doc_id"]].reset_index(drop=True), pd.DataFrame(out, columns=names)], axis=1) if out else pd.DataFrame({"doc_id": [], **{n: [] for n in names}})

    names = [x.split()[0] for x in schema.split(",")]
    return mapped(keyed_texts(docs), encode, f"doc_id long, {schema}")


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) of every text."""
    return encoded(docs, path, "ids array<int>", lambda _, ids: (ids.astype(np.int32),))


def texts_of(rows: DataFrame, path: str) -> DataFrame:
    """rows of doc_id, ids -> doc_id, text. Null ids count as none."""

    def decode(parts):
        own = coder(path)
        for pdf in parts:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": [own.decode([] if ids is None else list(ids)) for ids in pdf["ids"]]})

    return mapped(rows.select("doc_id", "ids"), decode, "doc_id long, text string")


def op3_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """encoded() of all documents, and decoded again; nulls, empty texts, repeated rows, empty tables and clashing columns as said there."""
    import public_tokenizers

    def digests(own: SegmentTreeBPE, ids: np.ndarray):
        text = own.decode(ids.tolist())
        return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    return encoded(documents(spark, sf_dir), path, "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)
