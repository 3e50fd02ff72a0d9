"""Whole texts to token ids by the tokenizers library, at several times its speed on running text.

A vocabulary that keeps white space splits a text before a space, and around a newline, that stands between two
characters other than white space; one that drops white space splits there anyhow. Pieces are encoded on their
own. So a text is cut there, each distinct cut is encoded once by the library, and ids are put together by
table. Cuts of ASCII and Latin-1 letters, where the split rules' classes are plain, go to the library's model piece by
piece; other cuts go through its whole chain. Texts with two white-space characters in a row, with other white
space or control characters, or with what may be a special token go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct cuts kept by a worker, about 200 MB; then those that came up once are forgotten, and more where that isn't enough.
MAX_CUTS = 850_000
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
_WORD = r"[A-Za-zÀ-ÖØ-öø-ÿ]+"
_MARKS = r"[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+"
# fixed values: the split rules of the two kinds of vocabulary, for cuts that _PLAIN takes
_KEEPING = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?{_WORD}| ?[0-9]+| ?{_MARKS}").findall
_DROPPING = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|{_WORD}|[0-9]|{_MARKS}").findall


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 as itself, the others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {chr(b): b for b in own}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    return letters


# fixed values: what files of the two kinds say of their rules
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
_KINDS = {
    "keeping": (None, _BYTE_LEVEL | {"use_regex": True}),
    "dropping": (
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}, _BYTE_LEVEL | {"use_regex": False}]},
    ),
}


def kind_of(path: str) -> str | None:
    """keeping or dropping: the file's rules are those that this module knows; None: they aren't, and texts go to the library whole."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, added = told["model"], told["added_tokens"]
    # a text with a special token is told by how all of them begin
    plain = all("<|" in t["content"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in added)
    if model.get("type") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges") or not plain:
        return None
    return next((k for k, rules in _KINDS.items() if rules == (told["normalizer"], told["pre_tokenizer"])), None)


class Encoder:
    """encode(texts) -> ids as uint32, offsets (one more than texts): as tokenizer.encode(text, add_special_tokens=False)."""

    def __init__(self, path: str, max_cuts: int = MAX_CUTS):
        self.max_cuts = max_cuts
        self._open(path)
        self._clear()

    def _open(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        kind = kind_of(path)
        self.cuts, self.keeps_space = kind is not None, kind == "keeping"
        self.letters = {b: c for c, b in byte_letters().items()}
        self.model = self.tokenizer.model
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.empty(1 << 14, np.int64)
        self.lengths = np.empty(1 << 14, np.int64)
        self.uses = np.zeros(1 << 14, np.int64)

    def _prune(self) -> None:
        uses = self.uses[: len(self.number)]
        least = max(2, int(np.partition(uses, len(uses) // 2)[len(uses) // 2]) + 1)
        kept = np.flatnonzero(uses >= least)
        names = list(self.number)
        starts, lengths, flat = self.starts[kept], self.lengths[kept], self.flat
        self._clear()
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        self._add([names[i] for i in kept.tolist()], flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)], lengths)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts of any kind."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _cut_ids(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of cuts one after another, how many each has. No cut has a newline or stands next to more white space."""
        tokenize, letters, known = self.model.tokenize, self.letters, self.pieces
        if len(known) > self.max_cuts // 4:
            known.clear()
        flat: list[list[int]] = []
        odd = []
        for i, cut in enumerate(cuts):
            if _PLAIN(cut.lstrip(" ")):
                pieces = _KEEPING(cut) if self.keeps_space else _DROPPING(cut.lower())
                ids = []
                for p in pieces:
                    own = known.get(p)
                    if own is None:
                        own = known[p] = tuple([t.id for t in tokenize(p.encode().decode("latin-1").translate(letters))])
                    ids += own
            else:
                ids = []
                odd.append(i)
            flat.append(ids)
        for i, ids in zip(odd, self._whole([cuts[i] for i in odd])):
            flat[i] = ids
        lengths = np.fromiter(map(len, flat), np.int64, len(flat))
        return np.fromiter(chain.from_iterable(flat), np.uint32, int(lengths.sum())), lengths

    def _add(self, keys: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.number)
        while n + len(keys) > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        while self.used + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + len(flat)] = flat
        self.starts[n : n + len(keys)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[n : n + len(keys)] = lengths
        self.used += len(flat)
        self.number.update(zip(keys, range(n, n + len(keys))))

    def _learn(self, keys: list[str]) -> None:
        if self.keeps_space:
            # \x00: a newline; \x01: a cut at the start or after a newline; else after a space
            if "\x00" in keys:
                (ids,) = self._whole(["\n"])
                self._add(["\x00"], np.array(ids, np.uint32), np.array([len(ids)]))
                keys = [k for k in keys if k != "\x00"]
            texts = [k[1:] if k[0] == "\x01" else " " + k for k in keys]
        else:
            texts = keys
        for at in range(0, len(keys), 2048):
            self._add(keys[at : at + 2048], *self._cut_ids(texts[at : at + 2048]))

    def _marked(self, text: str) -> str | None:
        """The text so that cuts stand between spaces. None: the library must see the text whole."""
        if not self.cuts:
            return None
        flat = text.replace("\n", " ")
        if not flat or "  " in flat or flat[0] == " " or flat[-1] == " " or "<|" in flat or not flat.isprintable():
            return None
        return "\x01" + text.replace("\n", " \x00 \x01") if self.keeps_space else flat

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.number) > self.max_cuts:
            self._prune()
        marked = [self._marked(t) for t in texts]
        whole = [i for i, t in enumerate(marked) if t is None]
        split = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
        counts = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        at = np.fromiter(map(self.number.get, names, repeat(-1)), np.int64, len(names))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new = [names[i] for i in unknown.tolist()]
            self._learn(new)
            at[unknown] = np.fromiter(map(self.number.__getitem__, new), np.int64, len(new))
        self.uses[at] += 1
        at = at[coded.indices.to_numpy()]
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[at] - (ends - lengths), lengths) + np.arange(total)]
        text_ends = np.concatenate([[0], ends])[np.cumsum(counts)]
        sizes = np.diff(text_ends, prepend=0)
        if whole:
            pieces = np.split(ids, text_ends[:-1])
            for i, own in zip(whole, self._whole([texts[i] for i in whole])):
                pieces[i] = np.array(own, np.uint32)
                sizes[i] = len(own)
            ids = np.concatenate(pieces)
        return ids, np.concatenate([[0], np.cumsum(sizes)])


def gathered(parts, most: int = 10_000_000):
    """The pandas frames of parts put together until they hold so many characters of text: the more texts, the more cuts are alike."""
    import pandas as pd

    held, size = [], 0
    for pdf in parts:
        held.append(pdf)
        size += int(pdf["text"].str.len().sum())
        if size >= most:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, max_cuts: int = MAX_CUTS) -> Encoder:
    """This worker's encoder for a vocabulary file; its table serves later tasks too."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].max_cuts = max_cuts
    return _ENCODERS[path]


def forget() -> None:
    """Give back this worker's tables, for tasks of other operators that need the memory."""
    import ctypes

    _ENCODERS.clear()
    pa.default_memory_pool().release_unused()
    try:  # what the C library keeps of freed memory
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def batches(texts: list[str], most: int = 16_000_000):
    """Consecutive (from, to) of so many characters together at most, or of one text."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield at, i
            at, held = i, 0
        held += len(t)
    if at < len(texts):
        yield at, len(texts)
