"""Searches answered by a stored positional index; the texts are not read again.

``postings``: one row per term, part and document with its positions, in buckets of terms and sorted by
(term, document). ``bounds``: for each term, part and block of 128 documents the most hits that one
document has. ``documents``: ids and the columns to filter by, without texts. A search reads the
buckets of its own terms, meets positions per document in one aggregate, and a ranked page
skips the blocks whose upper bound cannot reach it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.operators.search import WEIGHTS, weighted_postings

BUCKETS = 64
BLOCK = 7  # 2**7 documents of neighbouring ids


@dataclass(frozen=True)
class TextIndex:
    spark: SparkSession
    path: str
    key: str
    schemas: dict[str, str]  # of the three tables; an empty one has no file to tell it

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}")

    @property
    def documents(self) -> DataFrame:
        return self._table("documents")

    def _of_terms(self, table: str, terms: list[str]) -> DataFrame:
        buckets = self.spark.range(1).select(*[bucket(F.lit(t)) for t in terms]).first()
        rows = self._table(table)
        return rows.filter(F.col("bucket").isin(sorted(set(buckets))) & F.col("term").isin(terms))

    def postings(self, terms: list[str]) -> DataFrame:
        """term, weight, document, block, hits, positions of the terms; their buckets only are read."""
        return self._of_terms("postings", terms)

    def bounds(self, terms: list[str]) -> DataFrame:
        return self._of_terms("bounds", terms)

    def prefixed(self, prefix: str) -> DataFrame:
        """Postings of all terms that start so; files are sorted by term, so other row groups are skipped."""
        return self._table("postings").filter(F.col("term").startswith(prefix))


def bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def build(docs: DataFrame, title: str, body: str, key: str, keep: list[str], path: str) -> TextIndex:
    """Index title (A) and body (B) of ``docs``; ``key`` is an integer, ``keep`` columns can be filtered by.

    Rows are dealt out by bucket and large buckets cut into several tasks by their size, so the postings of a very
    common term are many files, each in order. Nothing is sampled beforehand: the texts are read once.
    """
    rows = weighted_postings(docs, title, body, key)
    block = F.shiftright(F.col(key).cast("long"), BLOCK).alias("block")
    rows = rows.select(bucket(F.col("term")).alias("bucket"), "term", "weight", key, block, F.size("positions").alias("hits"), "positions")
    dealt = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "weight", key)
    dealt.write.mode("error").partitionBy("bucket").parquet(f"{path}/postings")
    kinds = dict(docs.dtypes)
    schemas = {
        "postings": f"term string, weight string, `{key}` {kinds[key]}, block bigint, hits int, positions array<int>, bucket int",
        "bounds": "term string, weight string, block bigint, most int, docs bigint, bucket int",
        "documents": ", ".join(f"`{c}` {kinds[c]}" for c in [key, *keep]),
    }
    index = TextIndex(docs.sparkSession, path, key, schemas)
    most = index._table("postings").groupBy("bucket", "term", "weight", "block").agg(F.max("hits").alias("most"), F.count("*").alias("docs"))
    most.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "block").write.mode("error").partitionBy("bucket").parquet(f"{path}/bounds")
    docs.select(key, *keep).write.mode("error").parquet(f"{path}/documents")
    return index


# --- boolean searches -------------------------------------------------------------------------


def parsed(search: str) -> list[list[tuple[bool, list[str]]]]:
    """Alternatives of (excluded, words): words are ANDed, ``"..."`` is a phrase, ``-x`` excludes, ``or`` starts an alternative."""
    alternatives: list[list[tuple[bool, list[str]]]] = [[]]
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', search.lower()):
        if word == "or" and not minus:
            alternatives.append([])
            continue
        words = re.findall(r"[^\W_]+", phrase or word)
        if words:
            alternatives[-1].append((bool(minus), words))
    return [a for a in alternatives if a]


def adjacent(places: list[Column]) -> Column:
    """Whether some position of each word follows one of the word before it."""

    def shifted(p: Column, by: int) -> Column:
        return F.transform(p, lambda x: x - by)

    return F.size(reduce(F.array_intersect, [shifted(p, i) for i, p in enumerate(places)])) > 0


def matching(index: TextIndex, searches: dict[str, str], weight: str = "B") -> DataFrame:
    """One row per indexed document: key and one boolean per search. All searches read their terms' postings once."""
    forms = {name: parsed(q) for name, q in searches.items()}
    terms = sorted({w for form in forms.values() for part in form for _, words in part for w in words})
    found = index.postings(terms).filter(F.col("weight") == weight) if terms else None
    documents = index.documents.select(index.key)
    if found is None:
        return documents.select(index.key, *[F.lit(False).alias(n) for n in forms])
    place = {t: F.col(f"_p{i}") for i, t in enumerate(terms)}
    by_doc = found.groupBy(index.key).agg(*[F.max(F.when(F.col("term") == t, F.col("positions"))).alias(f"_p{i}") for i, t in enumerate(terms)])

    def holds(words: list[str]) -> Column:
        each = reduce(and_, [place[w].isNotNull() for w in words])
        return each if len(words) == 1 else F.coalesce(each & adjacent([place[w] for w in words]), F.lit(False))

    def condition(form) -> Column:
        return reduce(or_, [reduce(and_, [~holds(words) if excluded else holds(words) for excluded, words in part]) for part in form], F.lit(False))

    joined = documents.join(by_doc, index.key, "left")
    return joined.select(index.key, *[condition(form).alias(name) for name, form in forms.items()])


def with_phrase(index: TextIndex, words: list[str], weight: str = "B") -> DataFrame:
    """Documents that hold the words one after another."""
    found = index.postings(sorted(set(words))).filter(F.col("weight") == weight)
    by_doc = found.groupBy(index.key).agg(*[F.max(F.when(F.col("term") == w, F.col("positions"))).alias(f"_p{i}") for i, w in enumerate(words)])
    return by_doc.filter(F.coalesce(adjacent([F.col(f"_p{i}") for i in range(len(words))]), F.lit(False))).select(index.key)


# --- ranks ------------------------------------------------------------------------------------


def _weight() -> Column:
    return F.when(F.col("weight") == "A", WEIGHTS["A"]).otherwise(WEIGHTS["B"])


def _ranked(rows: DataFrame, key: str, words: list[str]) -> DataFrame:
    """key, rank of the documents whose body holds all words: hits in the title, then in the body, times their weights."""
    hits = {w: F.coalesce(F.sum(F.when(F.col("weight") == w, F.col("hits"))), F.lit(0)).alias(w) for w in WEIGHTS}
    complete = F.count_if(F.col("weight") == "B").alias("_words")
    docs = rows.groupBy(key).agg(*hits.values(), complete).filter(F.col("_words") == len(set(words)))
    return docs.select(key, (F.col("A") * WEIGHTS["A"] + F.col("B") * WEIGHTS["B"]).alias("rank"))


def ranked(index: TextIndex, words: list[str]) -> DataFrame:
    return _ranked(index.postings(words).drop("positions"), index.key, words)


def top(index: TextIndex, words: list[str], k: int, where: Column | None = None) -> DataFrame:
    """The ``k`` highest ranked documents, ties by key: key, the kept columns, rank; in order.

    The rank that ``k`` documents of the most promising blocks reach at least is the mark; a block whose
    bound is below it is not read.
    """
    return page(index, words, k, where)[0]


def page(index: TextIndex, words: list[str], k: int, where: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(top, the postings that were read for it after the mark)."""
    key = index.key
    documents = index.documents if where is None else index.documents.filter(where)
    rows = index.postings(words).select(key, "block", "term", "weight", "hits")
    bound = index.bounds(words).groupBy("block").agg(
        F.sum(F.col("most") * _weight()).alias("bound"), F.count_if(F.col("weight") == "B").alias("n"), F.max(F.when(F.col("weight") == "B", F.col("docs"))).alias("docs")
    )
    bound = bound.filter(F.col("n") == len(set(words)))
    first = bound.orderBy(F.desc("bound"), "block").limit(max(1, k)).select("block")  # k blocks at most
    start = _ranked(rows.join(F.broadcast(first), "block", "left_semi"), key, words).join(documents.select(key), key, "left_semi")
    best = start.orderBy(F.desc("rank"), key).limit(k).agg(F.min("rank").alias("mark"), F.count("*").alias("n")).first()
    mark = best.mark if best.n == k else -1.0
    # a hair below the mark, as sums of weights need not be equal to the last bit
    open_ = bound.filter(F.col("bound") >= mark * (1 - 1e-12)).select("block")
    left = rows.join(open_, "block", "left_semi")
    found = _ranked(left, key, words).join(documents, key)
    return found.orderBy(F.desc("rank"), key).limit(k), left


def spans(index: TextIndex, words: list[str], weight: str = "B") -> DataFrame:
    """key, span: the smallest distance that covers all words, from their positions."""
    order = {w: i for i, w in enumerate(dict.fromkeys(words))}
    found = index.postings(list(order)).filter(F.col("weight") == weight)
    number = reduce(lambda c, x: c.when(F.col("term") == x[0], x[1]), order.items(), F.when(F.lit(False), -1))
    places = F.transform("positions", lambda p: F.struct(p.alias("pos"), number.alias("word")))
    docs = found.groupBy(index.key).agg(F.count("*").alias("n"), F.sort_array(F.flatten(F.collect_list(places))).alias("places")).filter(F.col("n") == len(order))
    never = F.array(*[F.lit(None).cast("int") for _ in order])
    start = F.struct(never.alias("last"), F.lit(None).cast("int").alias("best"))

    def step(state: Column, place: Column) -> Column:
        last = F.transform(state["last"], lambda x, i: F.when(i == place["word"], place["pos"]).otherwise(x))
        span = F.when(~F.exists(last, lambda x: x.isNull()), F.array_max(last) - F.array_min(last))
        return F.struct(last.alias("last"), F.least(state["best"], span).alias("best"))

    return docs.select(index.key, F.aggregate("places", start, step, lambda s: s["best"]).alias("span"))
