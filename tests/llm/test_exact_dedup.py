"""Exact deduplication against grouping by text."""

import hashlib
import re

import pytest

from millrace.llm import exact_dedup as op

ROWS = [
    (5, "a b"), (3, "a  b"), (4, "a\t\nb"), (9, "a b"), (1, None), (2, ""), (None, "a b"), (7, "x" * 200_000), (8, "x" * 200_000), (6, "A b"), (10, " a b"), (11, "a b"), (11, "a b"), (12, "one"), (12, "two"), (13, "two"),
]


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest_bytes", [32, 0])
@pytest.mark.parametrize("memtable", [65536, 2])
def test_groups(docs_of, digest_bytes, memtable):
    # with no digest bytes at all every text collides
    got = op.exact_groups(docs_of(ROWS), memtable, max(digest_bytes, 1) if digest_bytes else 0).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == brute(ROWS)
    # exactly one row of each group stays
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len({norm(t) for _, t in ROWS})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_empty_table(docs_of):
    assert op.exact_groups(docs_of([])).collect() == []
    assert op.drop_exact_copies(docs_of([])).collect() == []


def test_rows_that_stay_keep_their_columns(docs_of):
    docs = docs_of(ROWS)
    left = op.drop_exact_copies(docs)
    assert left.columns == docs.columns
    texts = [norm(r["text"]) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({norm(t) for _, t in ROWS})


def test_many_copies(docs_of):
    rows = [(i, "same") for i in range(3000)] + [(i, f"own {i}") for i in range(3000, 3300)]
    got = op.exact_groups(docs_of(rows)).where("kept").collect()
    assert len(got) == 301 and {r["group_size"] for r in got} == {1, 3000}
