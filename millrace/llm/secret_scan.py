"""Secret scans over a trigram inverted index. DataFrame functions only.

From each rule's regular expression a Boolean trigram query is derived: an OR of ANDs of trigrams that every
match must contain. The index posts, for each trigram that some rule asks for, the documents whose lower-cased
text has it. Queries intersect postings (all trigrams of a clause) and unite clauses; only those
candidates meet the regular expression itself. Rules without mandatory trigrams scan every text.

Texts are cut by the regular expression anchored where the last match ended, so lengths of gaps and
matches add up to code point positions in one pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as sre_parse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Filter, documents, drop, fresh, keyed_texts, written

# Exact strings that a part of a pattern may stand for are followed up to so many; beyond, the part counts as unknown.
MAX_STRINGS = 64
#: Stands for a missing doc_id among candidates. A document of that very number would only be a candidate more often.
NO_ID = -(1 << 63)
MAX_CLASS = 8


@dataclass(frozen=True)
class Rule:
    """pattern: a regular expression that Java and Python read alike; value: the group whose length counts, 0 for the match."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 1


#: The three base rules, in the order that ties are listed.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # maximal runs, so asking for 24 in the pattern finds the same as dropping shorter ones
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Further rules, each with mandatory trigrams.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
RULES = BASE_RULES + MORE_RULES

# --- from a regular expression to a Boolean trigram query -------------------------------------------------
# A query is a frozenset of clauses (OR); a clause is a frozenset of trigrams (AND). {{}} is true.
TRUE = frozenset([frozenset()])


def _and(a: frozenset, b: frozenset) -> frozenset:
    return _simpler(frozenset(x | y for x, y in product(a, b)))


def _simpler(q: frozenset) -> frozenset:
    """Without clauses that another clause implies."""
    return frozenset(x for x in q if not any(y < x for y in q))


def _of_strings(strings: set[str]) -> frozenset:
    return _simpler(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _part(op, arg) -> tuple[set[str] | None, frozenset]:
    """The strings that a part stands for, if few and known, and what every match of it must contain."""
    if op is sre.LITERAL:
        c = chr(arg)
        return ({c.lower()} if c.isascii() else None), TRUE
    if op is sre.IN:
        if len(arg) <= MAX_CLASS and all(o is sre.LITERAL and chr(a).isascii() for o, a in arg):
            return {chr(a).lower() for _, a in arg}, TRUE
        return None, TRUE
    if op is sre.SUBPATTERN:
        return _sequence(arg[3])
    if op is sre.BRANCH:
        found = [_sequence(x) for x in arg[1]]
        if all(s is not None for s, _ in found) and len(strings := set().union(*(s for s, _ in found))) <= MAX_STRINGS:
            return strings, TRUE
        return None, _simpler(frozenset().union(*(q if s is None else _of_strings(s) for s, q in found)))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, inner = arg
        strings, query = _sequence(inner)
        if strings is not None and (least, most) == (0, 1):
            return strings | {""}, TRUE
        if strings is not None and least == most == 1:
            return strings, TRUE
        return None, TRUE if least == 0 else query if strings is None else _of_strings(strings)
    return None, TRUE


def _sequence(parts) -> tuple[set[str] | None, frozenset]:
    query, run, whole = TRUE, {""}, True
    for op, arg in parts:
        strings, own = _part(op, arg)
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        query, whole = _and(query, _of_strings(run)), False
        run = {""} if strings is None else strings
        query = _and(query, own)
    return (run, TRUE) if whole else (None, _and(query, _of_strings(run)))


def trigram_query(pattern: str) -> frozenset:
    """The OR of ANDs of lower-case trigrams that the lower-cased text of any match satisfies; TRUE: none is mandatory."""
    strings, query = _sequence(sre_parse.parse(pattern))
    return query if strings is None else _of_strings(strings)


# --- the index ---------------------------------------------------------------------------------------------


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, doc_id) of the given trigrams over the lower-cased texts, written sorted by trigram."""
    texts = keyed_texts(docs).select("doc_id", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams)))
    posted = texts.select("doc_id", F.explode(found).alias("trigram"))
    return written(posted.sortWithinPartitions("trigram", "doc_id"), "postings")


def candidates(spark: SparkSession, postings: DataFrame, queries: dict[str, frozenset]) -> DataFrame:
    """Documents whose postings satisfy a rule's query: doc_id, kinds (array)."""
    clauses = [(kind, i, t, len(c)) for kind, q in queries.items() for i, c in enumerate(sorted(map(sorted, q))) for t in c]
    wanted = spark.createDataFrame(clauses, "kind string, clause int, trigram string, need int")
    # a few rows for each rule, whatever the input's size
    met = postings.distinct().join(F.broadcast(wanted), "trigram").groupBy("doc_id", "kind", "clause", "need").count().where("count = need")
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """The rule's matches in text, leftmost and non-overlapping; those with too short a value are dropped."""
    cut = F.lit(rf"(?s)\G(.*?)({rule.pattern})")
    whole = F.regexp_extract_all(text, cut, F.lit(0))
    gap = F.regexp_extract_all(text, cut, F.lit(1))
    value = F.regexp_extract_all(text, cut, F.lit(2 + rule.value))
    sizes = F.arrays_zip(F.transform(whole, F.char_length).alias("w"), F.transform(gap, F.char_length).alias("g"), F.transform(value, F.char_length).alias("v"))
    empty = F.array().cast("array<struct<start:int,end:int,n:int>>")
    placed = F.aggregate(
        sizes,
        F.struct(F.lit(0).alias("at"), empty.alias("found")),
        lambda a, x: F.struct(
            (a["at"] + x["w"]).alias("at"),
            F.when(x["v"] >= rule.least, F.concat(a["found"], F.array(F.struct((a["at"] + x["g"]).alias("start"), (a["at"] + x["w"]).alias("end"), x["v"].alias("n"))))).otherwise(a["found"]).alias("found"),
        ),
    )
    return F.transform(placed["found"], lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), x["end"].alias("end")))


def with_spans(docs: DataFrame, name: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs (columns doc_id, text and any others) with column name: array of (start, order, kind, end) by start, then kind as listed.

    Candidates are joined by doc_id. A filter of their ids is asked first, so the texts of documents that are none stay where they are, also
    where the candidates are too many to be broadcast.
    """
    spark = docs.sparkSession
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if TRUE != q}
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds, key, maybe = (fresh([*docs.columns, name], n) for n in ("_kinds", "_key", "_maybe"))
    no_kinds, none = F.array().cast("array<string>"), F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    spans = lambda r, i, sought: F.when(sought, _spans(text, r, i)).otherwise(none)
    found = lambda rows: rows.withColumn(name, F.array_sort(F.concat(*(spans(r, i, F.array_contains(kinds, r.kind) if r.kind in indexed else text.rlike(r.pattern)) for i, r in enumerate(rules)))))
    if not indexed:
        return found(docs.withColumn(kinds, no_kinds)).select(*docs.columns, name)
    postings = trigram_index(docs, sorted({t for q in indexed.values() for c in q for t in c}))
    # no id is told as a number of its own, which no hash of a filter leaves out
    cand = candidates(spark, postings, indexed).groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias(key)).agg(F.flatten(F.collect_list("kinds")).alias(kinds))
    cand = written(cand, "candidates")
    drop(postings)
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    asked = Filter(cand, key).asked(docs, own, maybe)
    others = asked.where(~F.col(maybe)).select(*docs.columns, no_kinds.alias(kinds))
    met = asked.where(F.col(maybe)).join(cand, own == F.col(key), "left").select(*docs.columns, F.coalesce(kinds, no_kinds).alias(kinds))
    return found(others).unionByName(found(met)).select(*docs.columns, name)


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of docs: doc_id, found: array of (start, order, kind, end) by start, then kind as listed.

    Positions are code points, ends exclusive. A null or empty text has no spans. A null doc_id is kept; its
    postings are those of all rows without doc_id, which only makes it a candidate more often. Repeated rows
    give repeated results. An empty table gives an empty result. Other columns, whatever their names, are not read.
    """
    return with_spans(docs.select("doc_id", "text"), "found", rules).select("doc_id", "found")


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "<{}>") -> DataFrame:
    """docs with every span in its text replaced by its kind's mark; all rows and columns stay, whatever their names, n_chars (if there) is set anew.

    Overlapping spans are replaced together, under the first one's kind. A null text stays null. An empty table gives an empty result;
    repeated rows, and rows without doc_id, are redacted each by its text.
    """
    text, name = F.coalesce(F.col("text"), F.lit("")), fresh(docs.columns, "_found")
    cut = F.aggregate(
        F.col(name),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, x: F.when(x["start"] < a["at"], F.struct(F.greatest(a["at"], x["end"]).alias("at"), a["out"].alias("out"))).otherwise(
            F.struct(x["end"].alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, x["start"] - a["at"]), F.format_string(mark.replace("{}", "%s"), x["kind"])).alias("out"))
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))),
    )
    out = with_spans(docs, name, rules)
    hit = F.size(name) > 0
    out = out.withColumn("text", F.when(hit, cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """secret_spans() of all documents, counted and told; nulls, empty texts, repeated rows, empty tables and clashing columns as said there."""
    found = secret_spans(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("found", lambda x: x["order"] < len(BASE_RULES))
    told = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("found")).alias("spans"),
    )


def _oracle() -> str:
    """DuckDB: the same cuts by its own regular expressions, without any index."""
    parts = []
    for i, r in enumerate(RULES):
        p = rf"(?s)(.*?)({r.pattern})".replace("'", "''")
        parts.append(f"""
SELECT doc_id, {i} AS o, '{r.kind}' AS kind, ends[i] - len(w[i]) + len(g[i]) AS s, ends[i] AS e
FROM (SELECT *, list_transform(range(1, len(w) + 1), lambda k: list_sum(list_transform(w[1:k], lambda x: len(x)))::BIGINT) AS ends
      FROM (SELECT doc_id, regexp_extract_all(t, '{p}', 0) AS w, regexp_extract_all(t, '{p}', 1) AS g, regexp_extract_all(t, '{p}', {2 + r.value}) AS v FROM d)),
     unnest(range(1, len(w) + 1)) AS u(i)
WHERE len(v[i]) >= {r.least}""")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(parts)}),
a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
             coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (o < {len(BASE_RULES)}), '') AS base,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans
      FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""


ORACLE = _oracle()
