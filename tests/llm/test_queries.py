"""Each query as it is registered, over the smallest tables; ids of any size, missing ids and clashing column names for every operator and stage."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_graph_ops import brute_components, brute_repeats
from test_models import check_base
from test_tokens import laid
from tokenizers import Tokenizer

from millrace.llm import bpe, exact_dedup, jaccard_join, lm_score, media, packed_ids, packing, quality, secret_scan, suffix_dedup
from millrace.llm.catalog import QUERIES
from millrace.llm.common import new_path

SF = "/root/testdata/sf0.001"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
BIG = 1 << 53
#: Ids that floats can't tell apart, rows without one, a repeated row.
ROWS = [(BIG + 1, "one two three four five six"), (None, "one two three four five six seven"), (BIG + 2, "password = abcdef123"), (BIG + 2, "password = abcdef123"), (None, None), (-BIG - 1, ""), (7, "x " * 3000), (BIG + 3, "One two  three four five six")]


def ids(tokenizer, text, end=False):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0] * end, "<u4")


def test_op2_token_output(spark, real):
    library, at, want = Tokenizer.from_file(BYTE), 0, []
    for i, t in real:
        own = ids(library, t, True)
        want.append((i, at, len(own), zlib.crc32(own.tobytes())))
        at += len(own)
    got = QUERIES["op2_token_output"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_op3_bpe(spark, real):
    library = Tokenizer.from_file(BYTE)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op3_bpe"](spark, SF).collect()}
    told = lambda own: (len(own), hashlib.sha256(own.tobytes()).hexdigest(), hashlib.sha256(library.decode(own.tolist(), skip_special_tokens=False).encode()).hexdigest())
    assert got == {i: told(ids(library, t)) for i, t in real}


def test_op5_lm_score(spark, real):
    got = QUERIES["op5_lm_score"](spark, SF).collect()
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["doc_id"])] == [i for i, _ in real]
    check_base(got, real)


def test_op7_suffix_dedup(spark, real):
    got = QUERIES["op7_suffix_dedup"](spark, SF).collect()
    assert sorted((r["doc_id"], r["start"], r["n_words"]) for r in got) == sorted(brute_repeats(real))


def test_op8_best_fit(spark, real):
    library, want = Tokenizer.from_file(WORD), Counter()
    for i, t in real:
        own = ids(library, t, True)
        for p in range(-(-len(own) // 2048)):
            part = own[2048 * p : 2048 * p + 2048]
            want[i, p, 2048 * p, len(part), zlib.crc32(part.tobytes())] += 1
    got = QUERIES["op8_best_fit"](spark, SF).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert laid(got, 2048) <= 1.01 * -(-sum(r["length"] for r in got) // 2048) + 1


def test_op9_jaccard_join(spark, real):
    got = QUERIES["op9_jaccard_join"](spark, SF).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == brute_components(real)


def results(spark, docs):
    """doc_ids of every operator's rows, by its name."""
    labels = spark.createDataFrame([(BIG + 1, 1), (BIG + 2, 0), (7, 0)], "doc_id long, quality int")
    uri = new_path(spark, "clash")
    manifest = packed_ids.write_token_files(docs, BYTE, uri)
    return {
        "op1": secret_scan.secret_spans(docs), "op2": packed_ids.read_token_files(manifest, uri, "n long", lambda x: (len(x),)), "op3": bpe.token_ids(docs, BYTE), "op4": exact_dedup.exact_groups(docs),
        "op5": lm_score.scores(docs), "op6": media.texts_as_gifs(docs), "op9": jaccard_join.jaccard_components(docs), "op10": quality.scored(docs, quality.fit(docs, labels)),
    }


#: Names that the operators use themselves, and those of their results.
NAMES = "_found _kinds _key _maybe _sha _stays _none _keep _number _gone _page _bits _salt _total _n _base _in _rank _at _id _values _gif row run digest sha n norm kind anchor key values block bucket found kept n_links label score sequence_id offset start length frames"


@pytest.fixture(scope="module")
def clashing(spark, docs_of):
    docs = docs_of(ROWS)
    names = [n for n in NAMES.split() if n not in docs.columns]
    return docs.selectExpr("*", *(f"'mine' AS `{n}`" for n in names))


def test_every_operator_keeps_ids_whole_beside_clashing_names(spark, clashing):
    want = Counter(i for i, _ in ROWS)
    for name, rows in results(spark, clashing).items():
        assert Counter(r["doc_id"] for r in rows.select("doc_id").collect()) == want, name
    pieces = packing.pack_documents(clashing, WORD).collect()
    assert {r["doc_id"] for r in pieces} == set(want) and laid(pieces, 2048) >= 1
    assert bpe.texts_of(bpe.token_ids(clashing, BYTE), BYTE).where(f"doc_id = {BIG + 1}").first()["text"] == ROWS[0][1]
    words = " ".join(f"w{i}" for i in range(80))
    long = clashing.selectExpr("doc_id", f"'{words}' AS text", *(f"`{c}`" for c in clashing.columns if c not in ("doc_id", "text")))
    assert {r["doc_id"]: r["n_words"] for r in suffix_dedup.repeats(long).collect()} == dict.fromkeys(want, 80)
    links = {r["doc_id"]: r["n_links"] for r in jaccard_join.jaccard_links(long).where("doc_id IS NOT NULL").collect()}
    assert set(links.values()) == {len(ROWS) - 1}


def test_every_stage_keeps_all_columns(spark, clashing):
    import corpus_pipeline as cp

    for name, stage in cp.STAGES[:-1]:
        left = stage(spark, clashing, SF)
        assert left.columns == clashing.columns, name
        rows = left.collect()
        assert {r["_found"] for r in rows} <= {"mine"} and {r["doc_id"] for r in rows} <= {i for i, _ in ROWS}, name
    assert {r["doc_id"] for r in cp.keep_first_copies(spark, clashing, SF).collect()} == {BIG + 1, BIG + 2, None, -BIG - 1, 7, BIG + 3}
    assert Counter(r["doc_id"] for r in cp.keep_first_copies(spark, clashing, SF).collect())[BIG + 2] == 1
    assert {r["text"] for r in cp.redact_secrets(spark, clashing, SF).where(f"doc_id = {BIG + 2}").collect()} == {"<assign>"}
    assert {r["doc_id"] for r in cp.pack(spark, clashing, SF).collect()} == {i for i, _ in ROWS}


def test_every_stage_takes_an_empty_table(spark, clashing):
    import corpus_pipeline as cp

    none = clashing.limit(0)
    for name, stage in cp.STAGES:
        assert stage(spark, none, SF).collect() == [], name


def test_labels_of_any_id_and_very_long_texts(spark, docs_of):
    # a long text of one word is fitted and scored by the same counts
    rows = [(BIG + i, ("bad " * (40_000 if i == 1 else 50)) if i % 2 else f"a good text about {i} things and what they are for") for i in range(40)] + [(None, "bad bad bad")]
    labels = spark.createDataFrame([(BIG + i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")
    docs = docs_of(rows)
    got = {r["doc_id"]: r["score"] for r in quality.scored(docs, quality.fit(docs, labels)).collect()}
    assert all((got[i] < 0.5) == ("bad" in t) for i, t in rows)


def test_long_texts_of_further_secrets(docs_of):
    text = "é" * 300_000 + " ghp_" + "a1B2" * 10 + " " + "-----BEGIN RSA PRIVATE KEY-----" + " eyJ" * 3
    (r,) = secret_scan.secret_spans(docs_of([(1, text)])).collect()
    assert [(x["kind"], x["start"], x["end"]) for x in r["found"] if x["kind"] in ("hub", "pem")] == [("hub", 300_001, 300_045), ("pem", 300_046, 300_077)]
