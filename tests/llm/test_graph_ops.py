"""Components, the Jaccard join and repeated passages against brute force."""

import random
from collections import defaultdict

import pytest

from millrace.llm import jaccard_join as jj
from millrace.llm import suffix_dedup as sd
from millrace.llm.graph import components


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


@pytest.mark.parametrize("kind", ["random", "path", "star", "none"])
def test_components(spark, kind):
    random.seed(1)
    edges = {"random": [(random.randrange(300), random.randrange(300)) for _ in range(220)], "path": [(i, i + 1) for i in range(200)], "star": [(500, i) for i in range(300)], "none": []}[kind]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: union.find(x) for e in edges if e[0] != e[1] for x in e}


def brute_components(rows, percent=75):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    union = Union()
    for a in range(len(rows)):
        union.find(a)
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                union.join(a, b)
    names = defaultdict(lambda: None)
    for a, (i, _) in enumerate(rows):
        if i is not None:
            names[union.find(a)] = min(x for x in (names[union.find(a)], i) if x is not None)
    return sorted(((i, len(sets[a]), names[union.find(a)] if sets[a] else i) for a, (i, _) in enumerate(rows)), key=repr)


def variants(seed=2, groups=12):
    """Near copies: each group's texts change a few words of its first, some of a changed one; words are few, so shingles are shared widely."""
    random.seed(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for g in range(groups):
        base = random.choices(words, k=random.choice([3, 5, 6, 8, 12, 30, 80, 150]))
        for _ in range(random.randint(1, 9)):
            own = list(base)
            for _ in range(random.randint(0, 2)):
                own[random.randrange(len(own))] = random.choice(words)
            if random.random() < 0.3:
                base = own
            rows.append((len(rows), " ".join(own)))
    return rows


EDGES = [(100, None), (101, ""), (102, " \n"), (103, "One two"), (104, "one  TWO"), (105, "one two three four five"), (106, "one two three four five six"), (None, "one two"), (None, None), (107, "é a b c d e"), (108, "É a b c d e"), (109, "a " * 3000), (110, "a b c d e f g h"), (110, "a b c d e f g h"), (111, "x\x1cy a b c d")]


@pytest.mark.parametrize("light", [None, 0, 20, 48])
@pytest.mark.parametrize("rounds", [0, 3])
def test_jaccard_components(docs_of, light, rounds):
    rows = variants() + EDGES
    got = jj.jaccard_components(docs_of(rows), light=light, rounds=rounds).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows)


@pytest.mark.parametrize("light", [None, 0])
def test_links_of_every_document(docs_of, monkeypatch, light):
    near = [" ".join("own" + str(i) if k == 5 * i else f"n{k}" for k in range(100)) for i in range(15)]
    rows = variants() + EDGES + [(200 + i, t) for i, t in enumerate([*near, near[0], near[0]])]
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    link = lambda a, b: bool(a & b) and 100 * len(a & b) >= 75 * len(a | b)
    want = [(i, len(own), sum(link(own, x) for x in sets) - bool(own)) for (i, _), own in zip(rows, sets)]
    monkeypatch.setattr(jj, "CHUNK", 2)
    got = jj.jaccard_links(docs_of(rows).repartition(3), light=light).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert all(n == 16 for i, _, n in want if i is not None and i >= 200)  # each with all others, not only as a tree
    assert jj.jaccard_links(docs_of([])).collect() == []


def test_small_blocks_and_other_thresholds(docs_of, monkeypatch):
    rows = variants(7)
    monkeypatch.setattr(jj, "BLOCK_DOCS", 5)
    monkeypatch.setattr(jj, "CHUNK", 2)
    got = jj.jaccard_components(docs_of(rows).repartition(3), percent=50, rounds=1).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows, 50)


def test_one_large_group(docs_of):
    random.seed(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(400):
        own = list(base)
        for k in random.sample(range(120), random.choice([0, 1, 2, 4, 8])):
            own[k] = f"x{i}"
        rows.append((i, " ".join(own)))
    assert sorted(map(tuple, jj.jaccard_components(docs_of(rows)).collect()), key=repr) == brute_components(rows)


def test_no_links_and_no_rows(docs_of):
    assert jj.jaccard_components(docs_of([])).collect() == []
    rows = [(i, f"only{i} words{i} of{i} its{i} own{i} here{i}") for i in range(20)]
    assert {(r["doc_id"], r["component_id"]) for r in jj.jaccard_components(docs_of(rows)).collect()} == {(i, i) for i in range(20)}


def test_one_of_each_component_stays(docs_of):
    docs = docs_of(variants() + EDGES)
    left = jj.drop_near_copies(docs)
    want = [r for r in brute_components(variants() + EDGES) if r[0] is None or r[0] == r[2]]
    assert left.columns == docs.columns and left.count() == len(want)


def brute_repeats(rows):
    windows, words = defaultdict(set), []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        words.append(w)
        for k in range(len(w) - 49):
            windows[tuple(w[k : k + 50])].add(i)
    out = set()
    for (i, _), w in zip(rows, words):
        starts = [k for k in range(len(w) - 49) if len(windows[tuple(w[k : k + 50])]) > 1]
        for a, s in enumerate(starts):
            if a == 0 or starts[a - 1] != s - 1:
                end = s
                while end + 1 in set(starts):
                    end += 1
                out.add((i, s, end + 50 - s))
    return out


def passages(seed):
    random.seed(seed)
    fresh = iter(range(10**6))
    own = lambda n: [f"u{next(fresh)}" for _ in range(n)]
    shared = [own(n) for n in (49, 50, 51, 70, 120, 300)]
    rows = []
    for i in range(40):
        words = own(random.randint(0, 80))
        for _ in range(random.randint(0, 3)):
            p = random.choice(shared)
            a = random.randint(0, len(p) // 3)
            words += p[a:] + own(random.randint(0, 40))
        rows.append((i, " ".join(words).upper() if i % 5 == 0 else " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats(docs_of, seed):
    rows = passages(seed)
    got = sd.repeats(docs_of(rows).repartition(3)).collect()
    assert {tuple(r) for r in got} == brute_repeats(rows) and len(got) == len({tuple(r) for r in got})


def test_repeats_of_odd_tables(docs_of):
    long = " ".join(f"p{i}" for i in range(60))
    rows = [(1, long), (2, long), (3, None), (4, ""), (5, "short"), (6, " ".join(f"q{i}" for i in range(60)) + " " + long + " " + long), (7, "z " * 200), (8, "z " * 90)]
    assert {tuple(r) for r in sd.repeats(docs_of(rows)).collect()} == brute_repeats(rows)
    # within one document only: no row
    assert sd.repeats(docs_of([(1, long + " x " + long), (2, "a b")])).collect() == []
    assert sd.repeats(docs_of([])).collect() == []
    # rows without doc_id are one document
    assert [r["n_words"] for r in sd.repeats(docs_of([(None, long), (1, long)])).collect()] == [60, 60]


def test_many_copies_of_a_passage(docs_of):
    line = " ".join(f"p{i}" for i in range(55))
    rows = [(i, f"a{i} b{i} {line} c{i}") for i in range(600)]
    assert {tuple(r) for r in sd.repeats(docs_of(rows)).collect()} == {(i, 2, 55) for i in range(600)}
