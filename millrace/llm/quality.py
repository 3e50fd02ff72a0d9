"""Quality votes of nearest labelled neighbours in a latent-semantic space.

Terms are pairs of neighbouring bytes by class (each letter, capitals, digits, each punctuation mark, sixteen ranges of the bytes of other
scripts), weighted by log tf times idf, and two shares that tell repetition: of words that follow themselves, and of word pairs
that came up before. Weights of a bounded sample of labelled rows give the latent space by a truncated singular value
decomposition. The sample's unit vectors are broadcast; every document's cosines with all of them are exact,
computed in blocks, and the K nearest vote with weights that rise with similarity. Only a text that no labelled one is like at all
gets the share of label 1 among all training labels.
"""

from __future__ import annotations

import zlib
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keyed_texts, mapped
from .fast_encode import batches, forget

CLASSES = 79
TERMS = CLASSES * CLASSES
#: Columns behind the terms: shares in thousandths. Their weight beside the terms' unit vector.
SHARES, SHARE_WEIGHT = 2, 1.5
#: Bound of the labelled sample: so many rows of each label, those with the smallest hashes of doc_id.
SAMPLE = 1500
DIMENSIONS = 64
NEIGHBOURS = 15
SHARPNESS = 12


def _classes() -> np.ndarray:
    """The class of each byte: 0-25 letters, 26 capitals, 27 digits, 28 newline, 29 other white space, 30 control, 31-62 marks, 63-78 the ranges of eight of the bytes of UTF-8 beyond ASCII."""
    out = np.full(256, 30, np.int32)
    out[np.arange(ord("a"), ord("z") + 1)] = np.arange(26)
    out[np.arange(ord("A"), ord("Z") + 1)] = 26
    out[np.arange(ord("0"), ord("9") + 1)] = 27
    out[10] = 28
    out[[9, 11, 12, 13, 32]] = 29
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]  # 32 of them
    out[marks] = 31 + np.arange(len(marks))
    out[128:] = 63 + np.arange(128) // 8
    return out


_CLASS_OF = _classes()


def term_counts(texts: list[str]) -> np.ndarray:
    """How often each pair of classes occurs in each text, then the shares in thousandths: float32, a row for each text."""
    raw = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    kinds = _CLASS_OF[np.frombuffer(b"".join(raw), np.uint8)]
    owner = np.repeat(np.arange(len(raw)), sizes)
    codes = owner[:-1] * TERMS + kinds[:-1] * CLASSES + kinds[1:] if len(kinds) > 1 else np.zeros(0, np.int64)
    codes = codes[owner[:-1] == owner[1:]] if len(kinds) > 1 else codes
    counts = np.bincount(codes, minlength=len(raw) * TERMS).reshape(len(raw), TERMS)
    shares = np.zeros((len(raw), SHARES))
    for i, r in enumerate(raw):
        words = r.split()
        if len(words) > 1:
            pairs = len(words) - 1
            shares[i] = sum(map(eq, words, words[1:])) / pairs, 1 - len(set(zip(words, words[1:]))) / pairs
    return np.concatenate([counts, np.rint(1000 * shares)], axis=1).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


class Votes:
    """The fitted space and its labelled vectors: bounded by SAMPLE, TERMS and DIMENSIONS."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, prior: float = 0.5, dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS):
        self.labels = labels.astype(np.float32)
        self.neighbours = min(neighbours, len(labels))
        self.prior = prior
        seen = (counts[:, :TERMS] > 0).sum(axis=0)
        self.idf = np.log((1 + len(labels)) / (1 + seen)).astype(np.float32) + 1
        weighted = self._weighted(counts)
        k = min(dimensions, *weighted.shape) if len(labels) else 0
        # randomised range finder with a fixed seed
        rng = np.random.default_rng(7)
        basis = rng.standard_normal((weighted.shape[1], min(k + 16, weighted.shape[1]))).astype(np.float32)
        for _ in range(4):
            basis = np.linalg.qr(weighted.T @ (weighted @ basis))[0] if k else basis
        if k:
            _, _, right = np.linalg.svd(weighted @ basis, full_matrices=False)
            self.axes = np.ascontiguousarray((basis @ right[:k].T).astype(np.float32))
        else:
            self.axes = np.zeros((weighted.shape[1], 1), np.float32)
        self.vectors = _unit(weighted @ self.axes)

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        out = np.empty_like(counts)
        terms = out[:, :TERMS]
        np.log1p(counts[:, :TERMS], out=terms)
        terms *= self.idf
        norms = np.linalg.norm(terms, axis=1, keepdims=True)
        terms /= np.where(norms > 0, norms, 1)
        out[:, TERMS:] = counts[:, TERMS:] * np.float32(SHARE_WEIGHT / 1000)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        """0 to 1 for each text; a text without any term gets the labels' share."""
        out = np.full(len(texts), self.prior, np.float64)
        if not self.neighbours or not texts:
            return out
        counts = term_counts(texts)
        cosines = _unit(self._weighted(counts) @ self.axes) @ self.vectors.T
        near = np.argpartition(-cosines, self.neighbours - 1, axis=1)[:, : self.neighbours]
        weights = np.maximum(np.take_along_axis(cosines, near, axis=1), 0) ** SHARPNESS
        most = weights.max(axis=1)
        known = most > 0
        weights[known] /= most[known, None]
        out[known] = (weights[known] * self.labels[near[known]]).sum(axis=1) / weights[known].sum(axis=1)
        return np.clip(out, 0, 1)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Votes:
    """From at most sample rows of each label, those with the smallest hashes, none of them held out.

    Null labels and rows without doc_id are passed over; a document labelled more than once has the rounded mean of its labels;
    of a doc_id that comes with several texts one is taken. Without any labels every score is 0.5.
    """
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("q")).where("doc_id IS NOT NULL AND q IS NOT NULL")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.when(F.avg("q") >= 0.5, 1).otherwise(0).alias("label"))
    # only labels whose document is there, so that the bound is reached where it can be
    share = known.agg(F.avg("label").alias("share")).first()["share"]
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    key = F.xxhash64("doc_id")
    rows = [r for label in (0, 1) for r in known.where(F.col("label") == label).orderBy(key, "doc_id").limit(sample).collect()]
    wanted = spark.createDataFrame([(r["doc_id"], r["label"]) for r in rows], "doc_id long, label int")

    def count(parts):
        for pdf in parts:
            texts = pdf["text"].tolist()
            for a, b in batches(texts, 1_000_000):
                rows = term_counts(texts[a:b])
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[a:b].to_numpy(np.int64), "label": pdf["label"].iloc[a:b], "counts": [zlib.compress(r.tobytes(), 1) for r in rows.astype(np.uint32)]})

    # 2 * sample rows at most, so the join may broadcast them and the driver may hold their counts
    found = keyed_texts(docs).join(F.broadcast(wanted), "doc_id").mapInPandas(count, "doc_id long, label int, counts binary").toPandas()
    found = found.drop_duplicates("doc_id").sort_values("doc_id")
    counts = np.zeros((len(found), TERMS + SHARES), np.float32)
    for row, c in zip(counts, found["counts"]):
        row[:] = np.frombuffer(zlib.decompress(c), np.uint32)
    return Votes(counts, found["label"].to_numpy(np.float32), 0.5 if share is None else share)


def scored(docs: DataFrame, votes: Votes) -> DataFrame:
    """docs' doc_id with score. Null texts count as empty; rows keep their number, whatever their doc_id; other columns aren't read."""
    shared = docs.sparkSession.sparkContext.broadcast(votes)

    def score(parts):
        forget()
        for pdf in parts:
            texts = pdf["text"].tolist()
            out = [shared.value.scores(texts[i : min(b, i + 128)]) for a, b in batches(texts, 1_000_000) for i in range(a, b, 128)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": np.concatenate(out) if out else np.zeros(0)})

    return mapped(keyed_texts(docs), score, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs whose score is least or more, with all their columns as they are, whatever their names.

    A null text is scored as an empty one and stays null; equal texts, and rows with the same or no doc_id, are judged each by its text. An empty table gives an empty result;
    without labels every score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        forget()
        texts = texts.fillna("").tolist()
        out = [shared.value.scores(texts[i : min(b, i + 128)]) for a, b in batches(texts, 1_000_000) for i in range(a, b, 128)]
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.where(score(F.col("text")) >= least)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scored() of all documents by votes of the labelled ones that aren't held out; nulls, empty texts, repeated rows and empty tables as said at fit() and scored()."""
    docs = documents(spark, sf_dir)
    votes = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = scored(docs, votes)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
