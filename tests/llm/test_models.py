"""Language-model scores, quality votes, GIFs and the pipeline."""

import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import lm_score, media, quality

SF = "/root/testdata/sf0.001"


def base_scores(rows):
    words = [(t or "").encode().lower().split() + [None] for _, t in rows]
    train = [i is None or zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    c = Counter(w for ws, t in zip(words, train) if t for w in ws)
    n, v = sum(c.values()), len(c)
    return {k: (not t, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for k, (ws, t) in enumerate(zip(words, train))}


def check_base(got, rows):
    want = sorted(base_scores(rows).values(), key=repr)
    told = sorted(((r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=repr)
    assert [w[:4] for w in sorted(want)] == [t[:4] for t in sorted(told)]
    assert np.allclose(sorted(w[4] for w in want), sorted(t[4] for t in told), rtol=1e-9)


def test_base_scores(docs_of, real, monkeypatch):
    rows = real + [(None, "The the"), (5000, None), (5001, ""), (5002, "a\x1cb \x0b c"), (5003, "x"), (5003, "x")]
    monkeypatch.setattr(lm_score, "BLOCK_DOCS", 50)
    got = lm_score.scores(docs_of(rows).repartition(3)).collect()
    check_base(got, rows)
    assert all(r["score"] < 0 and math.isclose(r["score"], -r["bits"] * math.log10(2)) for r in got)
    bits = sum(r["bits"] for r in got if r["held_out"])
    size = sum(len((t or "").encode()) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 5 == 1)
    assert bits / size < 3.2  # held out; far below 8


def test_base_scores_without_training_rows(docs_of):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    check_base(lm_score.scores(docs_of([(held, "a b")])).collect(), [(held, "a b")])
    assert lm_score.scores(docs_of([])).collect() == []


def plain_model(rows):
    """bits(text) of the same model by plain loops: tables by dictionaries, one decision after another, learning at the ends of groups."""
    learnt = [(t or "").encode() for i, t in rows if lm_score.trains(i)]
    pairs = np.zeros((256, 256))
    for t in learnt:
        for a, b in zip(b"\0" + t, t):
            pairs[a, b] += 1
    model = lm_score.Model(pairs, len(learnt))
    paths = {s: model.steps[model.path_start[s] : model.path_start[s] + model.length[s]].tolist() for s in range(64)}

    def places(text):
        """For each place its symbol, byte and contexts."""
        before, word, last = [lm_score.END] * 3, b"", 0
        for k in range(len(text) + 1):
            s = int(model.symbol[text[k]]) if k < len(text) else lm_score.END
            yield s, last, text[k] if k < len(text) else None, [("two", *before[:2]), ("three", *before), ("word", word)]
            if k < len(text):
                # an end is no symbol within a text
                before, last = [s, *before[:2]], text[k]
                word = b"" if text[k] in b" \t\n\x0b\x0c\r" else word + text[k : k + 1]

    counts = {}
    for t in learnt:
        for s, _, _, told in places(t):
            for c in told:
                counts.setdefault(c, Counter())[s] += 1
    rare = model.symbol == lm_score.ESCAPE
    share = np.where(rare, pairs.sum(axis=0) + 1, 0)

    def stretched(context, node):
        ones = every = 0
        if context[0] == "word" and sum(counts.get(context, {}).values()) < lm_score.LEAST:
            return 0.0
        for s, n in counts.get(context, {}).items():
            for step in paths[s]:
                if step & 63 == node:
                    every, ones = every + n, ones + n * (step >> 8 & 1)
        p = (ones + 0.2) / (every + 0.4)
        return max(-127, min(127, round(math.log(p / (1 - p)) * lm_score.STEP))) / lm_score.STEP

    def bits(text):
        decisions, total = [], 0.0
        for s, last, byte, told in places(text):
            if s == lm_score.ESCAPE:
                own = np.where(rare, pairs[last] + share / share.sum(), 0)
                total -= math.log2(own[byte] / own.sum())
            decisions += [(step >> 6 & 1, step >> 8 & 1, [stretched(c, step & 63) for c in told]) for step in paths[s]]
        w = [list(lm_score.FIRST_WEIGHT) for _ in range(lm_score.GATES)]
        refined = [1 / (1 + math.exp(-(i - lm_score.BUCKETS / 2 + 0.5))) for i in range(lm_score.BUCKETS)]
        for a, n in lm_score.groups_of(len(decisions)):
            dw, dr = np.zeros((lm_score.GATES, 3)), np.zeros(lm_score.BUCKETS)
            for gate, bit, x in decisions[a : a + n]:
                dot = max(-7.9, min(7.9, sum(wi * xi for wi, xi in zip(w[gate], x))))
                p, bucket = 1 / (1 + math.exp(-dot)), int(dot + lm_score.BUCKETS / 2)
                final = 0.5 * (p + refined[bucket])
                total -= math.log2(final if bit else 1 - final)
                dw[gate] += (bit - p) * lm_score.RATE * lm_score.GROUP / n * np.array(x)
                dr[bucket] += (bit - refined[bucket]) * lm_score.GROUP / n
            w = [[wi + d for wi, d in zip(ws, ds)] for ws, ds in zip(w, dw)]
            refined = [max(0.001, min(0.999, r + lm_score.REFINE / 4 * d)) for r, d in zip(refined, dr)]
        return total

    return model, bits


def test_scores_against_a_plain_loop(docs_of, real, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_DOCS", 7)
    monkeypatch.setattr(lm_score, "SAMPLED_TEXTS", 1)  # so that there are bounds between buckets
    rows = [(i, t and t[:1500]) for i, t in real[:25]] + [(5000, None), (5001, "naïve \x00 字 " * 30), (5002, "aaaa" * 900 + " tail"), (5003, " \n lead"), (None, "x y"), (2**53 + 1, "x y "), (5004, "The THE the\tThe\n")]
    got = {r["doc_id"]: r for r in lm_score.scores(docs_of(rows).repartition(3)).collect()}
    model, bits = plain_model(rows)
    assert got.keys() == dict(rows).keys()
    for i, t in rows:
        raw = (t or "").encode()
        assert math.isclose(got[i]["bits"], bits(raw), rel_tol=2e-3, abs_tol=0.05), (i, got[i]["bits"], bits(raw))
        assert math.isclose(got[i]["bits_per_byte"], got[i]["bits"] / max(1, len(raw)))
        assert got[i]["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 5 == 1)
    check_base(got.values(), rows)
    assert abs(sum(2.0 ** -model.length) - 1) < 1e-9  # a full code


def test_learning_from_other_documents(docs_of, real):
    own, other = [(i, t) for i, t in real[:40]], [(i, t) for i, t in real[40:90]]
    got = {r["doc_id"]: r["bits"] for r in lm_score.scores(docs_of(own), docs_of(other)).collect()}
    _, bits = plain_model([(None, t) for _, t in other])
    some = [i for i, t in own if len(t or "") < 1500][:6]
    assert np.allclose([got[i] for i in some], [bits((dict(own)[i] or "").encode()) for i in some], rtol=2e-3, atol=0.05)


def test_words_add_up_to_texts():
    for raw in (b"", b" ", b"a", b"a b", b"a  b\n", b"\x1ca\x00 b"):
        keys = lm_score.keys_of(raw)
        words = [w for w in lm_score.lowered(lm_score.pa.array(keys, lm_score.pa.binary())).to_pylist() if w]
        assert b"".join(keys) == raw and len(words) == (2 if b"b" in raw else len(raw.split()))


def test_quality_held_out(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    got = {r["doc_id"]: r for r in quality.op10_quality(spark, sf).collect()}
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(r["predicted"], labels[i]) for i, r in got.items() if r["held_out"] and i in labels]
    assert sum(p == q for p, q in held) / len(held) >= 0.95


def test_votes_against_brute_force(real):
    random.seed(1)
    texts = [t or "" for _, t in real[:80]]
    votes = quality.Votes(quality.term_counts(texts), np.array([i % 3 > 0 for i in range(80)], np.float32), 0.7, 8, 5)
    rows = []
    for t in texts[:20] + ["", "a b"]:
        counts = quality.term_counts([t])
        v = votes._weighted(counts)[0] @ votes.axes
        n = np.linalg.norm(v)
        if n == 0:
            rows.append(0.7)
            continue
        cos = votes.vectors @ (v / n)
        near = np.argsort(-cos)[:5]
        w = np.maximum(cos[near], 0) ** quality.SHARPNESS
        rows.append((w * votes.labels[near]).sum() / w.sum())
    assert np.allclose(votes.scores(texts[:20] + ["", "a b"]), rows, atol=1e-3)


def test_term_counts():
    counts = quality.term_counts(["ab!!", "", "a", "x x x y", "p q p q p q"])
    assert counts[:, : quality.TERMS].sum(axis=1).tolist() == [3, 0, 0, 6, 10]
    assert counts[:, quality.TERMS :].tolist() == [[0, 0], [0, 0], [0, 0], [667, 333], [0, 600]]


def test_quality_of_odd_tables(spark, docs_of):
    docs = docs_of([(i, "good words here " + " ".join(f"and{k}" for k in range(99))) for i in range(30)] + [(100 + i, "BAD!! $$$ %%% " * 40) for i in range(30)] + [(None, "good words"), (7, None), (8, "")])
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)] + [(None, 1), (5, None), (999, 0), (3, 1)], "doc_id long, quality int")
    votes = quality.fit(docs, labels)
    got = quality.scored(docs, votes).collect()
    assert len(got) == docs.count() and all(r["score"] > 0.9 for r in got if r["doc_id"] is not None and 8 < r["doc_id"] < 30) and all(r["score"] < 0.1 for r in got if (r["doc_id"] or 0) >= 100)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id >= 100").count() == 0 and kept.where("doc_id IS NULL").count() == 1
    assert [r["score"] for r in quality.scored(docs_of(["x y"]), quality.fit(docs, labels.limit(0))).collect()] == [0.5]
    assert quality.scored(docs_of([]), votes).collect() == []


# --- GIF ---


def test_payloads_come_back(real):
    random.seed(1)
    cases = [bytes(64), b"a" * 640_000, bytes(random.choices(range(256), k=64 * 2000)), b"ab" * 32 * 3000, *((t or "").encode() for _, t in real[:60])]
    for raw in cases:
        raw += bytes(-len(raw) % 64 if raw else 64)
        frames = media.decode_gif(media.encode_gif(raw))
        assert media.payload_of(frames) == raw and all(f.delay_ms == 100 for f in frames)
        assert sum(map(sum, (f.luma() for f in frames))) >= len(raw)


def slow_lzw(data, bits):
    """LZW as written in the format's description."""
    clear, end, out = 1 << bits, (1 << bits) + 1, []
    pos, table, width, last = 0, [], bits + 1, None
    stream = int.from_bytes(data, "little")
    while pos + width <= 8 * len(data):
        code = stream >> pos & (1 << width) - 1
        pos += width
        if code == end:
            break
        if code == clear:
            table, width, last = [bytes([i]) for i in range(clear)] + [b"", b""], bits + 1, None
            continue
        entry = table[code] if code < len(table) else last + last[:1]
        out.append(entry)
        if last is not None and len(table) < 4096:
            table.append(last + entry[:1])
        last = entry
        if len(table) == 1 << width and width < 12:
            width += 1
    return b"".join(out)


@pytest.mark.parametrize("bits", range(2, 9))
def test_lzw_against_a_plain_decoder(bits):
    random.seed(bits)
    for data in (b"", bytes(random.choices(range(1 << bits), k=30_000)), bytes([0]) * 20_000, bytes(random.choices(range(2), k=40_000))):
        coded = media.lzw_encode(data, bits)
        assert media.lzw_decode(coded, bits).tobytes() == slow_lzw(coded, bits) == data


def gif(frames, size=(2, 2), palette=b"\xff\0\0\0\xff\0\0\0\xff\xff\xff\xff"):
    """frames: (left, top, width, height, pixels, delay, disposal, transparent, local palette, interlaced)."""
    out = struct.pack("<6sHHBBB", b"GIF89a", *size, 0x81, 0, 0) + palette
    for left, top, w, h, pixels, delay, disposal, transparent, local, interlaced in frames:
        out += struct.pack("<BBBBHBB", 0x21, 0xF9, 4, disposal << 2 | (transparent is not None), delay, transparent or 0, 0)
        out += struct.pack("<BHHHHB", 0x2C, left, top, w, h, (0x81 if local else 0) | (0x40 if interlaced else 0)) + (local or b"")
        codes = media.lzw_encode(bytes(pixels), 2)
        out += b"\x02" + bytes([len(codes)]) + codes + b"\0"
    return out + b";"


RED, GREEN, BLUE, WHITE, CLEAR = (255, 0, 0, 255), (0, 255, 0, 255), (0, 0, 255, 255), (255, 255, 255, 255), (0, 0, 0, 0)


def canvas(frame):
    return [tuple(map(int, p)) for p in frame.canvas.reshape(-1, 4)]


def test_disposal_transparency_palettes_and_interlace():
    frames = media.decode_gif(gif([
        (0, 0, 2, 2, [0, 0, 0, 0], 5, 1, None, None, False), (0, 0, 2, 1, [1, 3], 7, 3, 3, None, False), (1, 1, 1, 1, [2], 1, 2, None, None, False), (0, 0, 1, 1, [0], 2, 0, None, b"\xff\xff\xff" * 4, False),
    ]))
    assert [canvas(f) for f in frames] == [[RED] * 4, [GREEN, RED, RED, RED], [RED, RED, RED, BLUE], [WHITE, RED, RED, CLEAR]]
    assert [f.delay_ms for f in frames] == [50, 70, 10, 20] and [f.transparent for f in frames] == [-1, 3, -1, -1]
    assert sum(frames[3].histogram()) == 3
    rows = list(range(9))
    order = [0, 8, 4, 2, 6, 1, 3, 5, 7]
    (f,) = media.decode_gif(gif([(0, 0, 1, 9, [r % 4 for r in order], 0, 0, None, None, True)], (1, 9)))
    assert canvas(f) == [[RED, GREEN, BLUE, WHITE][r % 4] for r in rows]


def test_gif_columns(spark):
    good = gif([(0, 0, 2, 2, [0, 1, 2, 3], 5, 0, None, None, False)])
    rows = [(1, good), (2, None), (3, b"nonsense"), (4, b""), (5, good[:-8]), (6, b"GIF89a" + b"\0" * 7)]
    df = spark.createDataFrame([(i, d, "f", "e") for i, d in rows], "id int, media binary, frames string, error string")
    got = {r["id"]: r for r in media.gif_columns(df).collect()}
    assert got[1]["frames"][0]["delay_ms"] == 50 and sum(got[1]["frames"][0]["histogram"]) == 4 and got[1]["error"] is None
    assert got[2]["frames"] is None and got[2]["error"] is None
    assert got[3]["error"] and got[4]["error"] and got[6]["frames"] == [] and len(got) == 6


def test_gif_query(spark, real):
    got = {r["doc_id"]: r for r in media.op6_gif(spark, SF).collect()}
    for i, t in real:
        raw = (t or "").encode()
        full = raw + bytes(-len(raw) % 64 if raw else 64)
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))
    by_text = {}
    for i, t in real:
        assert by_text.setdefault(t, (got[i]["media_sha256"], got[i]["feature"])) == (got[i]["media_sha256"], got[i]["feature"])


# --- pipeline ---


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = docs
    sizes = [docs.count()]
    for name, stage in cp.STAGES[:-1]:
        at = cp.written(stage(spark, at, SF), name)
        assert at.columns == docs.columns, name
        sizes.append(at.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    got = cp.run(spark, SF)
    assert {r["doc_id"] for r in got.select("doc_id").distinct().collect()} == {r["doc_id"] for r in at.collect()}


def test_pipeline_against_brute_force(spark):
    """Each stage after the votes, over what the votes keep."""
    import re

    import corpus_pipeline as cp
    from test_graph_ops import brute_components
    from test_secret_scan import brute

    docs = cp.written(cp.keep_quality(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF), "kept")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    seen, first = set(), []
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        if key not in seen:
            seen.add(key)
            first.append((i, t))
    single = {i for i, _, c in brute_components(first) if i == c}
    final = cp.run(spark, SF)
    assert {r["doc_id"] for r in final.select("doc_id").distinct().collect()} == single
    clean = cp.redact_secrets(spark, docs, SF)
    assert {r["doc_id"]: r["text"] == t for r in clean.collect() for i, t in rows if i == r["doc_id"]} == {i: not brute(t) for i, t in rows}


