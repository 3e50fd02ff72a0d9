"""Passages that repeat across documents, by sparse suffix arrays.

A document's suffixes are kept only at minimisers: of each WINDOW consecutive GRAM-word hashes the smallest (the leftmost
of equals). Any LEAST words in a row hold a whole window, so a repeated passage of that length has the same minimisers
wherever it stands. Minimisers that no other document has are dropped; the suffixes of the others are range-sorted by
what follows, then by what precedes (words as 32-bit hashes, compared word by word), equal ones being one row however many documents
have them, and neighbours are compared: the length they share to the right and to the left gives a repeat. A second order, by what
precedes first, gives the most that any other shares to the left, and further repeats. Only where neighbours in neither order settle
it (another suffix may share more to the left than the one that shares the most to the right), the windows of LEAST words around
the minimiser that are still open are looked up by their hash, which is exact. Found spans are united for each document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, drop, keyed_texts, mapped, slices, written
from .jaccard_join import _M3, BITS, _mixed, shared_members

LEAST = 50
GRAM = 16
WINDOW = LEAST - GRAM + 1
BEFORE = WINDOW - 1  # words before a minimiser that a window around it may hold


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words: ASCII letters in lower case, parted by ASCII white space."""
    from xxhash import xxh3_64_intdigest

    own = text.encode().lower().split()
    return np.fromiter(map(xxh3_64_intdigest, own), np.uint64, len(own))


def _rolled(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of size words."""
    n = len(words) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size if n > 0 else 0):
            out = (out + words[k : k + n]) * _M3
            out ^= out >> np.uint64(29)
        return _mixed(out)


def minimisers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the minimisers, and the hashes of the GRAM words there."""
    if len(words) < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = _rolled(words, GRAM)
    best = np.lib.stride_tricks.sliding_window_view(grams, WINDOW).argmin(axis=1) + np.arange(len(grams) - WINDOW + 1)
    places = np.unique(best)
    return places, grams[places]


def _anchors(text: str) -> np.ndarray:
    return np.unique(minimisers(word_hashes(text))[1])


#: runs: first and last places, one pair after another, at which the document has this very suffix: texts of repeated words have many.
SUFFIX = "doc_id long, runs array<long>, anchor long, after binary, before binary"


def suffixes(docs: DataFrame) -> DataFrame:
    """The suffixes at minimisers that another document has too: doc_id, runs (of word numbers), anchor, after, before."""
    shared = shared_members(docs, _anchors, 0).where(F.col("values").isNotNull()).select("doc_id", "values")
    shared = written(shared.groupBy("doc_id").agg(F.collect_set("values").alias("_values")).withColumnRenamed("doc_id", "_id"), "anchors")
    texts = keyed_texts(docs).join(shared, F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", "text", "_values")

    def cut(parts):
        for pdf in parts:
            rows = []
            for doc_id, text, values in zip(pdf["doc_id"], pdf["text"], pdf["_values"]):
                known = np.unique(np.concatenate([np.frombuffer(v, "<u8") for v in values]))
                words = word_hashes(text)
                places, grams = minimisers(words)
                short = grams >> np.uint64(64 - BITS)
                at = np.minimum(np.searchsorted(known, short), len(known) - 1)
                raw = (words >> np.uint64(32)).astype(">u4")
                back = raw[::-1]
                found: dict[tuple, list[int]] = {}
                for place, gram in zip(places[known[at] == short].tolist(), grams[known[at] == short].astype(np.int64).tolist()):
                    i = len(words) - place
                    runs = found.setdefault((gram, raw[place : place + LEAST].tobytes(), back[i : i + BEFORE].tobytes()), [])
                    if runs and runs[-1] == place - 1:
                        runs[-1] = place
                    else:
                        runs += (place, place)
                rows += [(doc_id, runs, *key) for key, runs in found.items()]
            yield pd.DataFrame(rows, columns=["doc_id", "runs", "anchor", "after", "before"]).astype({"doc_id": "Int64"})

    return mapped(texts, cut, SUFFIX)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading words two arrays of equal shape share, row by row; 0 is padding and never equal."""
    same = (a == b) & (a != 0)
    return np.where(same.all(axis=1), a.shape[1], same.argmin(axis=1))


def _rows(column: pd.Series, width: int) -> np.ndarray:
    data = b"".join(x.ljust(4 * width, b"\0") for x in column)
    return np.frombuffer(data, ">u4").reshape(len(column), width)


#: A distinct suffix is a kind: its documents' least and greatest number (_key), and a hash that tells it from others of its minimiser.
KIND = "anchor long, kind long, after binary, before binary, lo long, hi long"
#: What a kind shares to the left and right with the one before and the one behind it in an order, as far as they have another
#: document, and whether that could be told; part and edge: where the task's run begins (1) and ends (2).
RIGHT = KIND + ", l1 int, r1 int, t1 boolean, l2 int, r2 int, t2 boolean, part long, edge int"
LEFT = KIND + ", l1 int, r1 int, t1 boolean, l2 int, r2 int, t2 boolean, l3 int, r3 int, t3 boolean, l4 int, r4 int, t4 boolean, part long, edge int"


def _key(doc_id) -> F.Column:
    """A number for each document, rows without doc_id being one; only compared for being equal."""
    return F.when(F.col(doc_id).isNull(), F.lit(0)).otherwise(F.xxhash64(doc_id))


def _shared(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row and the next: words shared to the left and right where they have different documents, and whether no such one may lie behind."""
    anchor, lo, hi = (frame[c].to_numpy(np.int64) for c in ("anchor", "lo", "hi"))
    same = anchor[1:] == anchor[:-1]
    other = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (lo[1:] != hi[1:])
    near = same & other
    left, right = (np.where(near, _common(v[1:], v[:-1]), 0) for v in (_rows(frame["before"], BEFORE), _rows(frame["after"], LEAST)))
    return left, right, ~same | other


def _in_order(rows: DataFrame, keys: list[str], schema: str, finish) -> DataFrame:
    """rows sorted by anchor and keys over all tasks, each with what it shares with its neighbours: the last six columns before part; then finish(rows), as a table.

    Frames overlap by a row, so every row has its neighbours but at the ends of a task's run: there the rows of all tasks
    that stand at ends (two of each task) are compared once more, in order of tasks.
    """
    order = ["anchor", *keys]
    ranked = rows.repartitionByRange(slices(rows.sparkSession), *order).sortWithinPartitions(*order)
    names = [c.split()[0] for c in schema.split(", ")]
    at = names.index("part")
    prev, next_ = names[at - 6 : at - 3], names[at - 3 : at]

    def judged(frame: pd.DataFrame) -> pd.DataFrame:
        for names_, cut in ((prev, slice(1, None)), (next_, slice(None, -1))):
            for name, own in zip(names_, _shared(frame)):
                column = np.zeros(len(frame), own.dtype)
                column[cut] = own
                frame[name] = column
        return frame

    def run(parts):
        from pyspark import TaskContext

        part, held, done, edge = TaskContext.get().partitionId(), None, 0, 1  # the last rows: the first of them may be done, the last one waits for its next
        for pdf in parts:
            frame = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if len(frame) - done > 1:
                out = judged(frame.copy()).iloc[done:-1].assign(part=part, edge=0)
                out.iloc[0, out.columns.get_loc("edge")] = edge
                yield out[names]
                held, done, edge = frame.tail(2), 1, 0
            elif len(frame):
                held = frame
        if held is not None:
            yield judged(held.copy()).iloc[done:].assign(part=part, edge=edge + 2)[names]

    found = written(ranked.mapInPandas(run, schema), "order")

    def meet(parts):
        last = None
        for pdf in parts:
            frame = pdf if last is None else pd.concat([last, pdf], ignore_index=True)
            left, right, told = _shared(frame)
            meets = np.flatnonzero(frame["part"].to_numpy()[1:] != frame["part"].to_numpy()[:-1])
            own = frame[["anchor", "kind"]]
            for rows_, side in ((meets + 1, 0), (meets, 1)):
                yield own.iloc[rows_].assign(side=side, _l=left[meets], _r=right[meets], _t=told[meets])
            last = frame.tail(1)

    ends = found.where("edge > 0").select("anchor", "kind", "after", "before", "lo", "hi", "part", "edge")
    patches = ends.repartition(1).sortWithinPartitions("part", "edge").mapInPandas(meet, "anchor long, kind long, side int, _l int, _r int, _t boolean")
    patches, told = written(patches, "ends"), found
    for side, own in enumerate((prev, next_)):
        patch = patches.where(F.col("side") == side).drop("side").withColumnsRenamed({"anchor": "_a", "kind": "_k"})
        told = told.join(patch, (F.col("anchor") == F.col("_a")) & (F.col("kind") == F.col("_k")), "left").withColumns({c: F.coalesce(p, c) for c, p in zip(own, ("_l", "_r", "_t"))}).select(*names)
    out = written(finish(told.drop("part", "edge")), "neighbours")
    for done in (found, patches, rows):
        drop(done)
    return out


def _open(judged: DataFrame) -> DataFrame:
    """With low and high: how many words before the minimiser a window may begin that neighbours don't settle; left and right: the most
    that any other may share; own: what documents of the same kind share."""
    lead, tail = (F.length("before") / 4).cast("int"), (F.length("after") / 4).cast("int")
    many = F.col("lo") != F.col("hi")
    left = F.when(F.col("t3") & F.col("t4"), F.greatest("l3", "l4")).otherwise(lead)
    right = F.when(F.col("t1") & F.col("t2"), F.greatest("r1", "r2")).otherwise(tail)
    out = judged.withColumns({"left": F.when(many, lead).otherwise(left), "right": F.when(many, tail).otherwise(right), "l0": F.when(many, lead).otherwise(0), "r0": F.when(many, tail).otherwise(0)})
    low, high = F.greatest(LEAST - F.col("right"), F.lit(0)), F.col("left")
    # what a neighbour shares settles windows from LEAST - r to l: the open range shrinks from both ends
    for _ in range(2):
        for i in range(5):
            l, r = F.col(f"l{i}"), F.col(f"r{i}")  # noqa: E741
            low = F.when((LEAST - r <= low) & (low <= l), l + 1).otherwise(low)
        out = out.withColumn("low", low)
        low = F.col("low")
    for _ in range(2):
        for i in range(5):
            l, r = F.col(f"l{i}"), F.col(f"r{i}")  # noqa: E741
            high = F.when((LEAST - r <= high) & (high <= l), LEAST - r - 1).otherwise(high)
        out = out.withColumn("high", high)
        high = F.col("high")
    return out


def repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row for each maximal span of words of a document all of whose windows of least words another document has too:
    doc_id, start (word number), n_words.

    Words are compared by hashes, ASCII letters in lower case. Texts with fewer words, empty or null ones have no row; nor have
    documents without repeats. Equal documents repeat each other. Rows without doc_id, or repeated rows, count as one document, of
    which each text is looked at. An empty table gives an empty result. Only doc_id and text are read of docs, whatever the others' names.
    """
    if least != LEAST:
        raise ValueError("the minimisers are laid out for passages of LEAST words")
    spark = docs.sparkSession
    found = written(suffixes(docs).withColumn("kind", F.xxhash64("after", "before")), "suffixes")
    # equal suffixes of however many documents are one row from here on
    kinds = found.groupBy("anchor", "after", "before").agg(F.min(_key("doc_id")).alias("lo"), F.max(_key("doc_id")).alias("hi"))
    kinds = written(kinds.select("anchor", F.xxhash64("after", "before").alias("kind"), "after", "before", "lo", "hi"), "kinds")
    ranked = _in_order(kinds, ["after", "before"], RIGHT, lambda told: told)
    judged = _in_order(ranked, ["before", "after"], LEFT, _open)
    pairs = F.array(*(F.struct(F.col(f"l{i}").alias("l"), F.col(f"r{i}").alias("r")) for i in range(5)))
    spans = judged.select("anchor", "kind", F.explode(F.array_distinct(F.filter(pairs, lambda p: p["l"] + p["r"] >= LEAST))).alias("s")).select("anchor", "kind", "s.l", "s.r")
    # what is open for one kind is looked up for all of its minimiser that may share it
    open_ = written(judged.where("low <= high").groupBy("anchor").agg(F.min("low").alias("lowest"), F.max("high").alias("highest")).withColumnRenamed("anchor", "_a"), "open")
    rest = judged.join(open_, F.col("anchor") == F.col("_a")).select("anchor", "kind", "after", "before", "lo", "hi", "low", "high", F.greatest(F.col("lowest"), LEAST - F.col("right")).alias("first"), F.least("highest", "left").alias("last")).where("first <= last")

    def windows(parts):
        for pdf in parts:
            rows, begins, hashes, asks = [], [], [], []
            for i, (after, before, low, high, first, last) in enumerate(zip(*(pdf[c] for c in ("after", "before", "low", "high", "first", "last")))):
                # windows that begin first to last words before the minimiser
                lead = min(len(before) // 4, last)
                words = np.concatenate([np.frombuffer(before, ">u4", lead)[::-1], np.frombuffer(after, ">u4")]).astype(np.uint64)[: lead + LEAST - first]
                own = _rolled(words, LEAST)
                begin = lead - np.arange(len(own))
                rows.append(np.full(len(own), i))
                begins.append(begin)
                hashes.append(own)
                asks.append((low <= begin) & (begin <= high))
            if rows:
                at = np.concatenate(rows)
                yield pdf.iloc[at][["anchor", "kind", "lo", "hi"]].assign(l=np.concatenate(begins), window=np.concatenate(hashes).astype(np.int64), asks=np.concatenate(asks))

    asked = written(rest.mapInPandas(windows, "anchor long, kind long, lo long, hi long, l int, window long, asks boolean"), "windows")
    twice = asked.groupBy("window").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("asks").alias("asks")).where("lo < hi AND asks")
    twice = twice.select(F.col("window").alias("_w"))
    by_window = asked.where("asks").join(twice, F.col("window") == F.col("_w")).select("anchor", "kind", "l", (LEAST - F.col("l")).alias("r"))
    spans = written(spans.unionByName(by_window).groupBy("anchor", "kind").agg(F.collect_set(F.struct("l", "r")).alias("spans")).withColumnsRenamed({"anchor": "_a", "kind": "_k"}), "spans")
    for done in (judged, open_, asked):
        drop(done)
    run = F.transform(F.sequence(F.lit(0), (F.size("runs") / 2 - 1).cast("int")), lambda i: F.struct(F.element_at("runs", 2 * i + 1).alias("first"), F.element_at("runs", 2 * i + 2).alias("last")))
    placed = found.select("doc_id", "anchor", "kind", "runs").join(spans, (F.col("anchor") == F.col("_a")) & (F.col("kind") == F.col("_k"))).select("doc_id", "spans", F.explode(run).alias("p")).select("doc_id", "p", F.explode("spans").alias("s"))
    every = placed.select("doc_id", (F.col("p.first") - F.col("s.l")).alias("start"), (F.col("p.last") + F.col("s.r")).alias("stop"))
    every = every.distinct().repartition(slices(spark), "doc_id").sortWithinPartitions("doc_id", "start", "stop")

    def unite(parts):
        held = None
        for pdf in parts:
            out = []
            for doc_id, start, stop in zip(pdf["doc_id"], pdf["start"], pdf["stop"]):
                same = held is not None and (held[0] is doc_id or (held[0] is not pd.NA and doc_id is not pd.NA and held[0] == doc_id))
                # windows that all repeat form one span where they follow each other word by word
                if same and start <= held[2] - LEAST + 1:
                    held[2] = max(held[2], stop)
                    continue
                if held is not None:
                    out.append((held[0], held[1], held[2] - held[1]))
                held = [doc_id, start, stop]
            yield pd.DataFrame(out, columns=["doc_id", "start", "n_words"]).astype({"doc_id": "Int64"})
        if held is not None:
            yield pd.DataFrame([(held[0], held[1], held[2] - held[1])], columns=["doc_id", "start", "n_words"]).astype({"doc_id": "Int64"})

    return mapped(every, unite, "doc_id long, start long, n_words long")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """repeats() of all documents; nulls, empty texts, repeated rows, empty tables and clashing columns as said there."""
    return repeats(documents(spark, sf_dir))
