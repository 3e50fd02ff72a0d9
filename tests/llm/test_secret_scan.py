"""Secret scans against Python's regular expressions."""

import hashlib
import random
import re

import pytest

from millrace.llm import secret_scan as op

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
BASE = [("assign", ASSIGN, lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def brute(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, good) in enumerate(BASE) for m in p.finditer(text or "") if good(m)]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


TEXTS = [
    None, "", "password=abc", "PASSWORD = 'hunter22'", "api_key:  \"abcdef\" apikey=12345678", "token=token: abcdefghij", "token: abc token: abcdefgh", "ſecret=abcdefgh seCret=abcdefgh",
    "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 15, "xAKIA" + "Z9" * 10 + "z", "é🙂 token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"### x", "f" * 23, "f" * 24 + "g" + "0" * 30, "secret=" + "deadbeef" * 4,
    "a\nb passwd=\n x", "token = " + "a" * 5 + " " + "z" * 100_000 + " api-key=abcdefg token=abcdefg", "password password=x1x1x1x1",
]


def spans(rows):
    return [",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in r["found"]) for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"]))]


def test_spans(docs_of):
    assert spans(op.secret_spans(docs_of(TEXTS), op.BASE_RULES).collect()) == [",".join(brute(t)) for t in TEXTS]


def test_random_texts(docs_of):
    random.seed(5)
    parts = ["token", "=", " ", "secret", ":", "abc", "AKIA", "ABCDEFGH0123", "deadbeef0123", "\n", "é", "api", "_", "key", "'", "x", "passwd", "ab12cd34"]
    texts = ["".join(random.choices(parts, k=random.randint(1, 60))) for _ in range(400)]
    assert spans(op.secret_spans(docs_of(texts), op.BASE_RULES).collect()) == [",".join(brute(t)) for t in texts]


def test_query_columns(spark):
    rows = {r["doc_id"]: r for r in op.op1_secret_scan(spark, "/root/testdata/sf0.001").collect()}
    import duckdb

    for i, text in duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall():
        want = brute(text)
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert rows[i]["n_assign"] + rows[i]["n_access"] + rows[i]["n_hex"] == len(want)


@pytest.mark.parametrize(
    ("pattern", "clauses"),
    [("abcd", [{"abc", "bcd"}]), ("(?:foo|bars)x*", [{"foo"}, {"bar", "ars"}]), ("ab?cde", [{"abc", "bcd", "cde"}, {"acd", "cde"}]), ("[a-z]+", [set()]), ("ab", [set()]), ("(?i:TOK)[a-z]+KEN", [{"tok", "ken"}]), ("abc|[0-9]", [set()]), ("(abc)+", [{"abc"}]), ("(abc)*d", [set()])],
)
def test_trigram_queries(pattern, clauses):
    assert op.trigram_query(pattern) == frozenset(map(frozenset, clauses))


def test_every_match_satisfies_its_trigram_query():
    for rule in op.RULES:
        query = op.trigram_query(rule.pattern)
        for text in [*filter(None, TEXTS), "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 40, "xoxb-1234567890-abcdef", "eyJabc.eyJdef.ghi"]:
            for m in re.finditer(rule.pattern, text, re.A):
                assert any(all(t in m[0].lower() for t in clause) for clause in query)


def test_more_rules_find_more(docs_of):
    texts = ["-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "aZ" * 20, "eyJabc.eyJdef.ghi-_"]
    assert spans(op.secret_spans(docs_of(texts)).collect()) == ["pem:0:31", "hub:0:44", "jwt:0:19"]


def test_redaction(docs_of):
    texts = ["a token=abcdefgh b", None, "clean", "secret=" + "deadbeef" * 4 + "!", "é " + "0" * 24]
    docs = docs_of(texts)
    rows = {r["doc_id"]: r for r in op.redacted(docs).collect()}
    assert [rows[i]["text"] for i in range(5)] == ["a <assign> b", None, "clean", "<assign>!", "é <hex>"]
    assert rows[0]["n_chars"] == len("a <assign> b") and rows[2]["n_chars"] == 5 and rows[1]["n_chars"] is None
    assert op.redacted(docs).columns == docs.columns


def test_odd_tables(docs_of):
    assert op.secret_spans(docs_of([])).collect() == []
    rows = [(None, "token=abcdefgh"), (None, "x"), (1, "token=abcdefgh"), (1, "no"), (1, "token=abcdefgh")]
    assert sorted(len(r["found"]) for r in op.secret_spans(docs_of(rows)).collect()) == [0, 0, 1, 1, 1]
    assert sorted(r["text"] for r in op.redacted(docs_of(rows)).collect()) == ["<assign>", "<assign>", "<assign>", "no", "x"]
