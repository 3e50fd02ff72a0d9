"""Encoding, decoding, token files and packing against the tokenizers library and plain loops."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe, fast_encode, packed_ids, packing
from millrace.llm.common import new_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n", "a", "  a", "a  b", "a \n b", "it's can't I'LL'd", "naïve Ünïcode ßtraße", "字 漢字　x", "🙂🙃 é", "\x00\x01\x1c", "tab\tsep\r\nx", "<|endoftext|>", "a<|endoftext|> b", "x" * 3000, "ab" * 700 + "é" * 300,
    "1234567890 12 7 77", "a_b-c", "Σίσυφος ΣΑΣ", "İ ǅ ſ", "½ ² ３", "the\nthe", "end\n", " nbsp x", "'s", " 's", "$$$ %%% ***",
]


def fuzz(n=3000):
    random.seed(3)
    parts = ["a", "B", " ", "  ", "\n", "'s", "!", "9", "é", "ß", "×", " ", "\t", "<|endoftext|>", "字", "🙂", "\x1c", "can't", "The ", "ing"]
    return ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(real):
    return ODD + fuzz() + [t or "" for _, t in real]


@pytest.mark.parametrize("path", [BYTE, WORD])
@pytest.mark.parametrize("most", [10**6, 300])
def test_fast_encoding(texts, path, most):
    encoder, library = fast_encode.Encoder(path, most), Tokenizer.from_file(path)
    for at in range(0, len(texts), 700):
        ids, ends = encoder.encode(texts[at : at + 700])
        want = [e.ids for e in library.encode_batch(texts[at : at + 700], add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want


def test_segment_trees(texts):
    own, library = bpe.SegmentTreeBPE(BYTE, 5000), Tokenizer.from_file(BYTE)
    ids, ends = own.encode(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want
    odd = want + [random.choices(range(50257), k=7) for _ in range(500)]
    assert [own.decode(x) for x in odd] == library.decode_batch(odd, skip_special_tokens=False)


def test_long_pieces_agree_with_shared_trees():
    own = bpe.SegmentTreeBPE(BYTE)
    random.seed(4)
    for n in (2, 7, 63, 64, 65, 127, 128):
        piece = bytes(random.choices(b"abthein", k=n))
        assert own._merge([piece], 1 << max(3, (n - 1).bit_length()))[0] == own._merge_long(piece)


def test_bpe_tables(docs_of, spark):
    rows = [(None, "a b"), (1, None), (1, "x"), (1, "x"), (2, "naïve 🙂")]
    ids = bpe.token_ids(docs_of(rows), BYTE)
    assert sorted((r["text"] for r in bpe.texts_of(ids, BYTE).collect())) == sorted(["a b", "", "x", "x", "naïve 🙂"])
    assert bpe.token_ids(docs_of([]), BYTE).collect() == []


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
@pytest.mark.parametrize("kind", ["small", "flat", "wide", "outliers"])
def test_packed_blocks(n, kind):
    rng = np.random.default_rng(n)
    ids = {"small": rng.integers(0, 50257, n), "flat": np.full(n, 7), "wide": rng.integers(0, 1 << 32, n), "outliers": np.where(rng.random(n) < 0.03, rng.integers(0, 1 << 32, n), rng.integers(100, 110, n))}[kind].astype(np.uint32)
    data = packed_ids.pack_file(np.array([5, packed_ids.NO_ID]), np.array([n // 3, n - n // 3]), ids)
    raw = np.frombuffer(data, np.uint8)
    doc_ids, sizes, starts, total = packed_ids.read_head(raw)
    assert doc_ids.tolist() == [5, packed_ids.NO_ID] and sizes.sum() == total == n
    assert packed_ids.read_tokens(data, 0, n).tolist() == ids.tolist()
    assert packed_ids.read_tokens(data, n // 4, n // 2).tolist() == ids[n // 4 : n // 2].tolist()
    if kind == "outliers" and n == 5000:
        assert len(data) < n  # far below four bytes each


def test_token_files(spark, docs_of, real):
    rows = [(i, t) for i, t in real] + [(None, "null id"), (1000, None), (1001, "x"), (1001, "w")]
    uri = new_path(spark, "test")
    manifest = packed_ids.write_token_files(docs_of(rows).repartition(3), BYTE, uri, file_tokens=20_000)
    got = packed_ids.read_token_files(manifest, uri, "crc long", lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),)).collect()
    assert manifest.count() > 3 and len(got) == len(rows)
    library, at, want = Tokenizer.from_file(BYTE), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_files_of_nothing(spark, docs_of):
    uri = new_path(spark, "test")
    manifest = packed_ids.write_token_files(docs_of([]), BYTE, uri)
    assert packed_ids.read_token_files(manifest, uri, "crc long", lambda ids: (0,)).collect() == []


def laid(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(docs_of, real):
    rows = [(i, t) for i, t in real] + [(None, "a"), (None, "b"), (900, None), (900, ""), (901, "x " * 5000)]
    got = packing.pack_documents(docs_of(rows), WORD).collect()
    library, want = Tokenizer.from_file(WORD), Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for p in range(-(-len(ids) // 2048)):
            own = ids[2048 * p : 2048 * p + 2048]
            want[i, p, 2048 * p, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = laid(got, 2048)
    assert sequences <= 1.01 * -(-sum(r["length"] for r in got) // 2048) + 1
    assert packing.pack_documents(docs_of([]), WORD).collect() == []


def test_packing_one_hot_length(spark):
    pieces = spark.createDataFrame([(i, 0, 0, 700 if i < 4000 else 1 + i % 50, i) for i in range(5000)], packing.PIECES)
    got = packing.packed(pieces).collect()
    assert len(got) == 5000 and {r["doc_id"] for r in got} == set(range(5000))
    assert laid(got, 2048) == 2000


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_plans(seed):
    random.seed(seed)
    counts = Counter(random.randint(1, random.choice([20, 600, 2048])) for _ in range(random.randint(1, 3000)))
    runs, sequences = packing.best_fit(dict(counts))
    placed, filled = Counter(), Counter()
    for length, first, last, sequence, _ in runs:
        placed[length] += last - first + 1
        for s in range(sequence, sequence + last - first + 1):
            filled[s] += length
    assert placed == counts and max(filled.values()) <= 2048 and len(filled) == sequences
    # never worse than filling each to more than half on average
    assert sequences <= 2 * sum(n * c for n, c in counts.items()) / 2048 + 1


def test_other_rules_go_to_the_library(tmp_path, real):
    """A vocabulary whose rules aren't the known ones is encoded as the library does, and not by segment trees."""
    import json

    from millrace.llm.fast_encode import Encoder, kind_of

    assert (kind_of(BYTE), kind_of(WORD)) == ("keeping", "dropping")
    with open(BYTE, encoding="utf-8") as f:
        told = json.load(f)
    other = tmp_path / "other.json"
    for change in ({"pre_tokenizer": told["pre_tokenizer"] | {"add_prefix_space": True}}, {"normalizer": {"type": "Lowercase"}}, {"added_tokens": [{**told["added_tokens"][0], "id": 11, "content": ","}]}):
        other.write_text(json.dumps(told | change))
        assert kind_of(str(other)) is None
        own, library = Encoder(str(other)), Tokenizer.from_file(str(other))
        texts = [t or "" for _, t in real[:30]] + ["a, b", " A"]
        flat, ends = own.encode(texts)
        assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        with pytest.raises(ValueError, match="split rules"):
            bpe.coder(str(other))
