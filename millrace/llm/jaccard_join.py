"""Jaccard self-join of shingle sets and its connected components, exact, by a size-aware heavy-light join.

1. Which shingles occur in two documents? Tasks send each block's distinct shingles, sorted and delta coded, to the bucket of
   their hash; a bucket answers with those that another block has too. What a block has twice is known there and
   sent once, so a shingle of a third of all documents arrives once for each block.
2. A document of which fewer than the threshold's share of shingles is shared can't link. The others keep their shared
   shingles; equal sets become one class with one representative.
3. Representatives get signatures over the rarest-first order of a fixed-size frequency sketch (any order that all sets
   share keeps the prefix filter exact). Light sets enumerate the pairs of their prefix (two sets that link share two members
   of it); heavy sets post their prefix to inverted lists. The boundary minimises the estimated cost of both.
4. A list needs no pairs among members that are in one component already. In a few rounds each member is compared with pivots of
   its lists; components grow; then members outside a list's main component are held against all members of their lists: shared
   signatures are counted for each pair, and those pairs are compared whose count leaves a link possible. So no
   link that joins components is missed and groups of copies don't become all their pairs.

Sets hold 48-bit hashes of shingles: the count of a pair is off by one with a chance of about 1e-9.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import added_up, documents, drop, fresh, keyed_texts, mapped, partitions, slices, text_bytes, written
from .fast_encode import forget
from .graph import components

WORDS = 5
PERCENT = 75
BITS = 48
#: A block ends with so many documents or shingles; local numbers of documents are 16 bits wide.
BLOCK_DOCS, BLOCK_SHINGLES = 2048, 1_000_000
MANY = 0xFFFF
#: Bytes of text for each bucket of shingles: about twice as many bytes reach it, however much text there is.
BUCKET_BYTES = 8_000_000
#: Counters of the frequency sketch: 4 MB when broadcast, whatever the input.
SKETCH_BITS = 22
#: Sets beyond this are always heavy.
LIGHT_MOST = 48
ROUNDS, CANDIDATES, BEST = 3, 3, 16
CHUNK = 1024

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of the text's shingles, sorted. ASCII letters in lower case, words parted by ASCII white space."""
    from xxhash import xxh3_64_intdigest

    own = text.encode().lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, own), np.uint64, len(own))
    n = max(1, len(own) - words + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(words, len(own))):
            out = (out + hashes[k : k + n]) * _M3
            out ^= out >> np.uint64(29)
        return np.unique(_mixed(out + np.uint64(min(words, len(own)))))


def _coded(values: np.ndarray) -> bytes:
    """Sorted values as steps of 32 bits; a step that needs more makes all of them 64 bits wide."""
    steps = np.diff(values, prepend=np.uint64(0))
    head = values[:1].astype("<u8").tobytes()
    if len(steps) > 1 and steps[1:].max() >= 1 << 32:
        return b"\x08" + head + steps[1:].astype("<u8").tobytes()
    return b"\x04" + head + steps[1:].astype("<u4").tobytes()


def _decoded(data: bytes) -> np.ndarray:
    if len(data) < 9:
        return np.zeros(0, np.uint64)
    first = np.frombuffer(data, "<u8", 1, 1)
    steps = np.frombuffer(data, f"<u{data[0]}", -1, 9) if len(data) > 9 else np.zeros(0, np.uint64)
    return np.cumsum(np.concatenate([first, steps.astype(np.uint64)]), dtype=np.uint64)


def shared_members(docs: DataFrame, members_of, percent: int) -> DataFrame:
    """One row per row of docs: row (a number of its own), doc_id, n (set size), shared, values, key.

    members_of(text): the sorted distinct 64-bit hashes of a text's set. shared: how many of them another row has too.
    values: those, sorted, where shared is at least percent of n, and not 0, else null. key: a digest of the set where all of it
    is shared.
    """
    size = text_bytes(docs)
    buckets, tasks = max(64, 2 * slices(docs.sparkSession), -(-size // BUCKET_BYTES)), partitions(docs.sparkSession, size, BUCKET_BYTES)

    def send(parts):
        from pyspark import TaskContext

        forget()
        part, block, first, held = TaskContext.get().partitionId(), 0, 0, []

        def flush():
            sizes = np.array([len(s) for _, s in held])
            local = np.repeat(np.arange(len(held), dtype=np.uint16), sizes)
            values = np.concatenate([s for _, s in held]) >> np.uint64(64 - BITS)
            order = np.argsort(values, kind="stable")
            values, local = values[order], local[order]
            fresh = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)
            counts = np.diff(np.append(np.flatnonzero(fresh), len(values)))
            many = np.repeat(counts > 1, counts)
            name = part << 20 | block
            ids = np.array([d for d, _ in held], "<i8")
            head = zlib.compress(ids.tobytes() + sizes.astype("<u4").tobytes(), 1)
            rows = [(-1 - name, name, len(held), first, head, _coded(values[many]), local[many].tobytes())]
            values, local = values[fresh], np.where(many, MANY, local)[fresh].astype("<u2")
            cuts = np.searchsorted(values, np.array([-(-(b << BITS) // buckets) for b in range(1, buckets)], np.uint64))
            for b, (v, d) in enumerate(zip(np.split(values, cuts), np.split(local, cuts))):
                if len(v):
                    rows.append((b, name, 0, 0, None, _coded(v), d.tobytes()))
            held.clear()
            return pd.DataFrame(rows, columns=["bucket", "block", "docs", "first", "head", "values", "local"])

        weight = 0
        for pdf in parts:
            for doc_id, missing, text in zip(pdf["doc_id"].fillna(0).to_numpy(np.int64).tolist(), pdf["doc_id"].isna(), pdf["text"]):
                own = members_of(text)
                held.append((_NO_ID if missing else doc_id, own))
                weight += len(own)
                if len(held) == BLOCK_DOCS or weight >= BLOCK_SHINGLES:
                    n = len(held)
                    yield flush()
                    block, first, weight = block + 1, first + n, 0
        if held:
            yield flush()

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["bucket"].iloc[0] < 0:  # what a block tells of itself
            return pdf[["block", "docs", "first", "head", "values", "local"]]
        forget()
        values = [_decoded(v) for v in pdf["values"]]
        every = np.concatenate(values)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(every), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        rows, at = [], 0
        for block, v, d in zip(pdf["block"], values, pdf["local"]):
            local = np.frombuffer(d, "<u2")
            found = twice[at : at + len(v)] & (local != MANY)
            at += len(v)
            if found.any():
                rows.append((block, 0, 0, None, _coded(v[found]), local[found].tobytes()))
        return pd.DataFrame(rows, columns=["block", "docs", "first", "head", "values", "local"])

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf[pdf["docs"] > 0].iloc[0]
        part, n = int(head["block"]) >> 20, int(head["docs"])
        raw = zlib.decompress(head["head"])
        ids, sizes = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<u4", n, 8 * n).astype(np.int64)
        values = np.concatenate([_decoded(v) for v in pdf["values"]])
        local = np.concatenate([np.frombuffer(d, "<u2") for d in pdf["local"]]).astype(np.int64)
        order = np.lexsort((values, local))
        values = values[order]
        counts = np.bincount(local, minlength=n)
        ends = np.cumsum(counts)
        keep = (counts * 100 >= sizes * percent) & (counts > 0)
        own = [values[e - c : e].astype("<u8").tobytes() if k else None for e, c, k in zip(ends.tolist(), counts.tolist(), keep.tolist())]
        key = [hashlib.md5(v).hexdigest() if v is not None and c == s else None for v, c, s in zip(own, counts.tolist(), sizes.tolist())]
        row = (part << 36) + int(head["first"]) + np.arange(n)
        doc_id = pd.array(ids, "Int64")
        doc_id[ids == _NO_ID] = pd.NA
        return pd.DataFrame({"row": row, "doc_id": doc_id, "n": sizes, "shared": counts, "values": own, "key": key})

    sent = mapped(keyed_texts(docs), send, "bucket long, block long, docs long, first long, head binary, values binary, local binary")
    told = sent.repartition(tasks, "bucket").groupBy("bucket").applyInPandas(answer, "block long, docs long, first long, head binary, values binary, local binary")
    return written(told.repartition(tasks, "block").groupBy("block").applyInPandas(gather, "row long, doc_id long, n long, shared long, values binary, key string"), "sets")


_NO_ID = -(1 << 63)


def frequency_sketch(sets: DataFrame) -> np.ndarray:
    """For each of 2**SKETCH_BITS counters 8 * log2 of how many members of sets fall on it, as uint8."""
    chunk = 1 << 16

    def count(parts):
        total = None
        for pdf in parts:
            if len(pdf):
                values = np.frombuffer(b"".join(pdf["values"]), "<u8") & np.uint64((1 << SKETCH_BITS) - 1)
                own = np.bincount(values.astype(np.int64), minlength=1 << SKETCH_BITS)
                total = own if total is None else total + own
        if total is not None:
            for i in range(0, 1 << SKETCH_BITS, chunk):
                at = np.flatnonzero(total[i : i + chunk])
                if len(at):
                    yield pd.DataFrame({"part": [i], "places": [at.astype("<u4").tobytes()], "counts": [total[i + at].astype("<u8").tobytes()]})

    def levels(places: np.ndarray, counts: np.ndarray) -> bytes:
        return np.minimum(255, 8 * np.log2(np.bincount(places, weights=counts, minlength=chunk) + 1)).astype(np.uint8).tobytes()

    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in added_up(sets.select("values").mapInPandas(count, "part long, places binary, counts binary"), levels).collect():  # 64 rows of 64 KB at most
        out[r["part"] : r["part"] + chunk] = np.frombuffer(r["told"], np.uint8)
    return out


def _prefix(values: np.ndarray, n: int, levels: np.ndarray, percent: int, more: int) -> tuple[np.ndarray, np.ndarray]:
    """The shared members among the n - need + more rarest; members that aren't shared come before them. And their levels."""
    need = -(-n * percent // 100)
    length = n - need + more - (n - len(values))
    level = levels[(values & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
    order = np.lexsort((values, level))[: max(0, length)]
    return values[order], level[order]


def boundary(reps: DataFrame, shared_levels, percent: int = PERCENT) -> int:
    """The largest light size: what pairs of light prefixes and scans of heavy lists cost together is least."""

    def cost(parts):
        light, heavy = np.zeros(LIGHT_MOST + 2), np.zeros(LIGHT_MOST + 2)
        for pdf in parts:
            for n, v in zip(pdf["n"], pdf["values"]):
                values, at = np.frombuffer(v, "<u8"), min(n, LIGHT_MOST + 1)
                two = len(_prefix(values, n, shared_levels.value, percent, 2)[0])
                light[at] += two * (two - 1) / 2
                heavy[at] += (2.0 ** (_prefix(values, n, shared_levels.value, percent, 1)[1] / 8)).sum()
        yield pd.DataFrame({"size": np.arange(LIGHT_MOST + 2), "light": light, "heavy": heavy})

    costs = reps.select("n", "values").mapInPandas(cost, "size long, light double, heavy double").groupBy("size").agg(F.sum("light").alias("light"), F.sum("heavy").alias("heavy"))
    light, heavy = np.zeros(LIGHT_MOST + 2), np.zeros(LIGHT_MOST + 2)
    for r in costs.collect():  # LIGHT_MOST + 2 rows
        light[r["size"]], heavy[r["size"]] = r["light"], r["heavy"]
    total = [light[: b + 1].sum() + heavy[b * percent // 100 + 1 :].sum() for b in range(LIGHT_MOST + 1)]
    return int(np.argmin(total))


def signatures(reps: DataFrame, shared_levels, light: int, percent: int = PERCENT) -> DataFrame:
    """token, row, n: the lists. Light sets stand in lists of pairs, heavy sets, and light ones that may link with them, in lists of members."""

    def sign(parts):
        for pdf in parts:
            tokens, owners, sizes = [], [], []
            for row, n, v in zip(pdf["row"], pdf["n"], pdf["values"]):
                values, own = np.frombuffer(v, "<u8"), []
                if n <= light:
                    two, _ = _prefix(values, n, shared_levels.value, percent, 2)
                    two = np.sort(two)
                    i, j = np.triu_indices(len(two), 1)
                    with np.errstate(over="ignore"):
                        own.append(_mixed(two[i] * _M3 + two[j]) | np.uint64(1 << 62))
                if n * 100 > light * percent:
                    own.append(_prefix(values, n, shared_levels.value, percent, 1)[0])
                own = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
                tokens.append(own & np.uint64((1 << 63) - 1))
                owners.append(np.full(len(own), row))
                sizes.append(np.full(len(own), n))
            if tokens:
                yield pd.DataFrame({"token": np.concatenate(tokens).astype(np.int64), "row": np.concatenate(owners).astype(np.int64), "n": np.concatenate(sizes).astype(np.int64)})

    return reps.select("row", "n", "values").mapInPandas(sign, "token long, row long, n long")


def _linked(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, la, b, lb) those whose sets link."""
    own = reps.select("row", "n", "values")
    both = pairs.join(own.toDF("_a", "na", "va"), F.col("a") == F.col("_a")).join(own.toDF("_b", "nb", "vb"), F.col("b") == F.col("_b"))

    def verify(parts):
        forget()
        for pdf in parts:
            keep = np.zeros(len(pdf), bool)
            for i, (na, nb, va, vb) in enumerate(zip(pdf["na"], pdf["nb"], pdf["va"], pdf["vb"])):
                both = np.sort(np.concatenate([np.frombuffer(va, "<u8"), np.frombuffer(vb, "<u8")]))
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * common >= percent * (na + nb - common)
            yield pdf.loc[keep, ["la", "lb"]]

    return both.select("la", "lb", "na", "nb", "va", "vb").mapInPandas(verify, "la long, lb long")


def _fits(a: str, b: str, percent: int) -> F.Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links.select(F.col("la").alias("a"), F.col("lb").alias("b"))).withColumnRenamed("label", "_to")
    return written(labels.join(found, F.col("label") == F.col("node"), "left").select("row", F.coalesce("_to", "label").alias("label")), "labels")


def link_components(reps: DataFrame, lists: DataFrame, percent: int = PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """row, label: for every row of lists the smallest row that links lead to."""
    labels = written(lists.select("row").distinct().select("row", F.col("row").alias("label")), "labels")

    def labelled() -> DataFrame:
        return written(lists.join(labels, "row").select("token", "row", "n", "weight", "label"), "labelled")

    for k in range(rounds):
        rows = labelled()
        # first the member whose lists are the longest, which stands in the middle of its group, then any
        order = F.xxhash64("row", F.lit(k)) if k else -F.col("weight")
        pivots = rows.groupBy("token").agg(F.min(F.struct(order.alias("h"), "row", "n", "label")).alias("p"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        pivots = written(pivots.where("lo < hi").select(F.col("token").alias("_t"), F.col("p.row").alias("b"), F.col("p.n").alias("nb"), F.col("p.label").alias("lb")), "pivots")
        if pivots.isEmpty():
            return labels
        met = rows.join(pivots, (F.col("token") == F.col("_t")) & (F.col("label") != F.col("lb")) & _fits("n", "nb", percent))
        counted = met.groupBy(F.col("row").alias("a"), F.col("label").alias("la"), "b", "lb").count()
        best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("count"), "b"))
        pairs = counted.withColumn("_k", best).where(F.col("_k") <= CANDIDATES).select("a", "la", "b", "lb")
        links = written(_linked(pairs, reps, percent), "links")
        drop(rows)
        labels = _merged(labels, links)
    # then the best of all that are left, and at last all
    for most in (BEST, None):
        labels = _rest(written(lists.join(labels, "row").select("token", "row", "n", "label"), "labelled"), labels, reps, percent, most)
    return labels


def _rest(rows: DataFrame, labels: DataFrame, reps: DataFrame, percent: int, most: int | None) -> DataFrame:
    """labels after pairs of rows in different components are compared."""
    pairs = _open_pairs(rows, reps, percent, most)
    return labels if pairs is None else _merged(labels, written(_linked(pairs, reps, percent), "links"))


def _open_pairs(rows: DataFrame, reps: DataFrame, percent: int, most: int | None) -> DataFrame | None:
    """Pairs (a, la, b, lb) of rows under different labels: for each row outside the main label of a list the most that share the
    most signatures with it, or all that may link. A pair may come from both sides. None: no list has two labels."""
    shares = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("m"))
    main = shares.groupBy("token").agg(F.max(F.struct("m", "label")).alias("top"), F.sum("m").alias("size"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    main = written(main.select(F.col("token").alias("_t"), F.col("top.label").alias("_main"), F.ceil(F.col("size") / CHUNK).alias("_chunks")), "main")
    if main.isEmpty():
        return None
    open_rows = written(rows.join(main, F.col("token") == F.col("_t")).drop("_t"), "open")
    members = open_rows.withColumn("_chunk", F.pmod(F.xxhash64("row"), "_chunks")).groupBy("token", "_chunk").agg(F.collect_list("row").alias("rows"), F.collect_list(F.col("n").cast("int")).alias("sizes"), F.collect_list("label").alias("labels"))
    members = written(members.select(F.col("token").alias("_t"), "rows", "sizes", "labels"), "members")
    # a row that is outside in one list meets the members of all its lists, so that what it shares with each is counted whole
    outside = written(open_rows.where("label <> _main").select("row").distinct(), "outside")
    fringe = written(open_rows.select("token", "row", "n", "label").join(outside, "row", "left_semi"), "fringe")
    asked = fringe.join(members, F.col("token") == F.col("_t")).select("row", "n", "label", "rows", "sizes", "labels").repartition(slices(reps.sparkSession), "row").sortWithinPartitions("row")

    def candidates(row: int, n: int, label: int, lists: list[tuple]) -> pd.DataFrame:
        """Members of other components whose overlap with row may be enough. Beyond what prefixes share, two sets share less than need members."""
        rows, sizes, labels = (np.concatenate(x) for x in zip(*lists))
        others, first, shared = np.unique(rows, return_index=True, return_counts=True)
        size, of = sizes[first].astype(np.int64), labels[first]
        need = -(-np.maximum(size, n) * percent // 100)
        overlap = -(-(size + n) * percent // (100 + percent))
        able = (of != label) & (np.minimum(size, n) * 100 >= np.maximum(size, n) * percent) & (shared + need - 1 >= overlap)
        others, of, shared = others[able], of[able], shared[able]
        if most is not None and len(others) > most:
            best = np.argsort(-shared, kind="stable")[:most]
            others, of = others[best], of[best]
        return pd.DataFrame({"a": row, "la": label, "b": others, "lb": of})

    def meet(parts):
        now, lists = None, []
        for pdf in parts:
            out = []
            for row, n, label, *own in zip(*(pdf[c] for c in ("row", "n", "label", "rows", "sizes", "labels"))):
                if now is None or row != now[0]:
                    if lists:
                        out.append(candidates(*now, lists))
                    now, lists = (row, n, label), []
                lists.append(own)
            if out:
                yield pd.concat(out)
        if lists:
            yield candidates(*now, lists)

    return asked.mapInPandas(meet, "a long, la long, b long, lb long")


def _prepared(docs: DataFrame, words: int, percent: int, light: int | None) -> tuple[DataFrame, ...]:
    """sets, those that may link, rows of classes of equal sets with their representative, the representatives, and their lists."""
    sets = shared_members(docs, lambda text: shingles(text, words), percent)
    able = sets.where(F.col("values").isNotNull())
    classes = able.where(F.col("key").isNotNull()).groupBy("key", "n").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("m")).where("m > 1")
    classes = written(classes.select(F.col("key").alias("_k"), F.col("n").alias("_n"), "rep"), "classes")
    members = written(able.select("row", "key", "n").join(classes, (F.col("key") == F.col("_k")) & (F.col("n") == F.col("_n"))).select("row", "rep"), "members")
    reps = written(able.select("row", "n", "values").join(members.where("row <> rep").select("row"), "row", "left_anti"), "reps")
    shared_levels = docs.sparkSession.sparkContext.broadcast(frequency_sketch(reps))
    if light is None:
        light = boundary(reps, shared_levels, percent)
    signed = written(signatures(reps, shared_levels, light, percent), "signed")
    often = written(signed.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.col("token").alias("_t"), "m"), "often")
    lists = written(signed.join(often, F.col("token") == F.col("_t")).drop("_t"), "lists")
    weights = lists.groupBy("row").agg(F.sum("m").alias("weight")).withColumnRenamed("row", "_r")
    lists = written(lists.join(weights, F.col("row") == F.col("_r")).select("token", "row", "n", "weight"), "lists")
    drop(signed)
    return sets, able, members, reps, lists


def jaccard_links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, light: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, n_links: with how many other rows it links.

    Rows, links and light are those of jaccard_components(). Here every pair of different sets that may link is compared, also inside a component; so the
    work grows with the square of a group of near copies that differ. Equal sets are compared once, as a class.
    """
    sets, able, members, reps, lists = _prepared(docs, words, percent, light)
    pairs = _open_pairs(lists.select("token", "row", "n", F.col("row").alias("label")), reps, percent, None)
    if pairs is None:
        pairs = docs.sparkSession.createDataFrame([], "a long, la long, b long, lb long")
    low, high = F.least("a", "b"), F.greatest("a", "b")
    pairs = pairs.select(low.alias("a"), low.alias("la"), high.alias("b"), high.alias("lb")).distinct()
    links = written(_linked(pairs, reps, percent), "links")
    sizes = written(members.groupBy("rep").agg(F.count(F.lit(1)).alias("m")), "sizes")
    both = links.unionByName(links.select(F.col("lb").alias("la"), F.col("la").alias("lb")))
    size = F.coalesce("m", F.lit(1))
    others = both.join(sizes, F.col("lb") == F.col("rep"), "left").groupBy(F.col("la").alias("_a")).agg(F.sum(size).alias("others"))
    placed = able.select("row").join(members, "row", "left").select(F.col("row").alias("_row"), F.coalesce("rep", "row").alias("_rep"))
    placed = placed.join(sizes, F.col("_rep") == F.col("rep"), "left").join(others, F.col("_rep") == F.col("_a"), "left")
    placed = placed.select("_row", (size - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = sets.select("row", "doc_id", "n").join(placed, F.col("row") == F.col("_row"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, light: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Two rows link when the Jaccard similarity of their shingle sets is percent or more; component_id is the smallest doc_id
    that links lead to, the row's own included. A text with fewer words than a shingle is one shingle; one without words, or a
    null text, has an empty set and links with nothing. Null doc_ids take part and never give the component its
    id, unless no member has one; repeated rows link like any equal ones. An empty table gives an empty result. Only doc_id and text are
    read of docs. light: the boundary of light sets; chosen by cost where None.
    """
    sets, able, members, reps, lists = _prepared(docs, words, percent, light)
    labels = link_components(reps, lists, percent, rounds)
    # row -> representative -> component; classes of one row and rows without links are their own
    placed = able.select("row", "doc_id").join(members, "row", "left").select("row", "doc_id", F.coalesce("rep", "row").alias("rep"))
    placed = placed.join(labels.select(F.col("row").alias("_r"), "label"), F.col("rep") == F.col("_r"), "left").select("row", "doc_id", F.coalesce("label", "rep").alias("label"))
    placed = written(placed, "placed")
    names = written(placed.groupBy("label").agg(F.min("doc_id").alias("component_id")).select(F.col("label").alias("_l"), "component_id"), "names")
    named = placed.join(names, F.col("label") == F.col("_l")).select(F.col("row").alias("_row"), "component_id")
    out = sets.select("row", "doc_id", "n").join(named, F.col("row") == F.col("_row"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that name their component, with all their columns, whatever their names. Rows without doc_id, and texts without words,
    stay; rows repeated with their doc_id stay or go together. An empty table gives an empty result."""
    found = jaccard_components(docs, words, percent)
    own = fresh(docs.columns, "_gone")
    gone = written(found.where("component_id <> doc_id").select(F.col("doc_id").alias(own)).distinct(), "gone")
    return docs.join(gone, F.col("doc_id") == F.col(own), "left_anti")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """jaccard_components() of all documents; nulls, empty texts, repeated rows, empty tables and clashing columns as said there."""
    return jaccard_components(documents(spark, sf_dir))
