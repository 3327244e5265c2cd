"""Text search over a table of documents, on whole texts.

Boolean queries run on each row's normalised text, so they need no shuffle; the
inverted index is an ordinary table ``(term, doc_id, weight, positions)``.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

WORD = r"[\p{L}\p{N}]+"
NOT_WORD = r"[^\p{L}\p{N}]+"

# Weight of a hit in the title (A) and in the body (B).
WEIGHTS = {"A": 1.0, "B": 0.4}

# English words that carry no search meaning.
STOPWORDS = (
    "a an and are as at be but by for from had has have he her his i if in into is it its no not of on or "
    "she so such that the their then there these they this to was we were will with you"
).split()

WORDS_AT_ONCE = 250_000  # words that a Python worker groups at a time; only memory depends on it


def _without_accent(letter: str) -> str:
    """The plain letter under any number of accents; the strokes of đ and ø are no accents in Unicode."""
    return {"đ": "d", "ø": "o"}.get(letter) or unicodedata.normalize("NFD", letter)[0]


#: Lower-case Latin letters with accents, Vietnamese ones among them, and what they match without.
ACCENTED = "".join(c for c in map(chr, [*range(0xE0, 0x250), *range(0x1E00, 0x1F00)]) if c == c.lower() and _without_accent(c) != c and _without_accent(c).isascii())
PLAIN = "".join(map(_without_accent, ACCENTED))


def tokens(text: Column) -> Column:
    """Lower-case words in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def normal(text: Column) -> Column:
    """Words with one blank before and after each, ready for exact ``contains`` tests."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " ")), F.lit(" "))


def unaccent(text: Column) -> Column:
    return F.translate(F.lower(text), ACCENTED, PLAIN)


def stem(word: Column) -> Column:
    """Strip one common English suffix, keeping at least three letters."""
    return F.regexp_replace(word, "^(.{3,}?)(ing|ed|ly|es|s)$", "$1")


def token_rows(docs: DataFrame, text: str, *keep: str, accents: bool = True) -> DataFrame:
    """One row per word: keep columns, ``pos`` (from 1), ``term``."""
    source = F.col(text) if accents else unaccent(F.col(text))
    rows = docs.select(*keep, F.posexplode(tokens(source)).alias("pos", "term"))
    return rows.withColumn("pos", F.col("pos") + 1)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut between texts, so that a piece has no more words than are grouped at once; a longer text is one piece."""
    ends = batch.column("words").offsets.to_numpy()
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + WORDS_AT_ONCE, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def _group_positions(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Word lists of a batch of texts → one row per text and distinct word with its positions."""
    lists = batch.column("words")
    kept = [i for i, name in enumerate(batch.schema.names) if name != "words"]
    ends = lists.offsets.to_numpy().astype(np.int64)
    lengths, values = np.diff(ends), lists.flatten().dictionary_encode()
    text = np.repeat(np.arange(len(lengths)), lengths)
    position = np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], lengths) + 1
    word = values.indices.to_numpy()
    pair = text * max(len(values.dictionary), 1) + word
    order = np.argsort(pair, kind="stable")
    starts = np.flatnonzero(np.diff(pair[order], prepend=-1))
    first = order[starts]
    positions = pa.ListArray.from_arrays(
        pa.array(np.append(starts, len(order)).astype(np.int32)), pa.array(position[order].astype(np.int32))
    )
    columns = [batch.column(i).take(pa.array(text[first])) for i in kept]
    terms = values.dictionary.take(pa.array(word[first])).cast(pa.string())
    return pa.RecordBatch.from_arrays([*columns, terms, positions], names=[*[batch.schema.names[i] for i in kept], "term", "positions"])


def _index_words(texts: DataFrame) -> DataFrame:
    """Rows with a ``words`` array → index rows. A text is one row, so its words are grouped
    where they are and the text is never shuffled word by word."""
    kept = [f for f in texts.schema.fields if f.name != "words"]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + ["term string", "positions array<int>"])

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch):
                yield _group_positions(piece)

    return texts.mapInArrow(group, schema)


def postings(docs: DataFrame, text: str, key: str, english: bool = False) -> DataFrame:
    """Inverted index rows (key, term, positions); ``english`` drops stopwords and stems."""
    words = tokens(F.col(text))
    if english:
        words = F.transform(words, lambda w: F.when(w.isin(STOPWORDS), "").otherwise(stem(w)))
    index = _index_words(docs.select(key, words.alias("words")))
    return index.filter(F.col("term") != "")


def weighted_postings(docs: DataFrame, title: str, body: str, key: str) -> DataFrame:
    """Index rows of title (A) and body (B) in one table."""
    parts = F.array(
        F.struct(F.lit("A").alias("weight"), F.col(title).alias("text")), F.struct(F.lit("B").alias("weight"), F.col(body).alias("text"))
    )
    both = docs.select(key, F.explode(parts).alias("p")).select(key, "p.weight", tokens(F.col("p.text")).alias("words"))
    return _index_words(both)


def has_words(text: Column, words: list[str]) -> Column:
    return reduce(and_, [text.contains(f" {w} ") for w in words])


def has_phrase(text: Column, words: list[str]) -> Column:
    return text.contains(f" {' '.join(words)} ")


def has_prefix(text: Column, prefix: str) -> Column:
    return text.contains(f" {prefix}")


def matches(text: Column, search: str) -> Column:
    """Condition of a search box query on ``normal`` text: words are ANDed, ``"..."`` is a
    phrase, ``-x`` excludes, ``or`` starts an alternative."""
    alternatives: list[list[Column]] = [[]]
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', search.lower()):
        if word == "or" and not minus:
            alternatives.append([])
            continue
        words = re.findall(r"[^\W_]+", phrase or word)
        if words:
            found = has_phrase(text, words)
            alternatives[-1].append(~found if minus else found)
    return reduce(or_, [reduce(and_, parts) for parts in alternatives if parts], F.lit(False))


def rank(title: Column, body: Column, words: list[str]) -> Column:
    """Weighted number of hits: 1.0 per hit in the title, 0.4 in the body."""
    hits = lambda text: F.size(F.filter(tokens(text), lambda x: x.isin(words)))
    return hits(title) * WEIGHTS["A"] + hits(body) * WEIGHTS["B"]


def closeness(text: Column, words: list[str]) -> Column:
    """Smallest distance that covers all words (NULL where one is missing); one pass over the text."""
    slots = {w: i for i, w in enumerate(words)}
    never = F.array(*[F.lit(None).cast("int") for _ in words])
    start = F.struct(F.lit(0).alias("pos"), never.alias("last"), F.lit(None).cast("int").alias("best"))

    def step(state: Column, word: Column) -> Column:
        pos = state["pos"] + 1
        last = F.array(*[F.when(word == w, pos).otherwise(state["last"][i]) for w, i in slots.items()])
        complete = reduce(and_, [F.get(last, F.lit(i)).isNotNull() for i in slots.values()])
        span = F.when(complete, F.array_max(last) - F.array_min(last))
        moved = F.struct(pos.alias("pos"), last.alias("last"), F.least(state["best"], span).alias("best"))
        same = F.struct(pos.alias("pos"), state["last"].alias("last"), state["best"].alias("best"))
        return F.when(word.isin(words), moved).otherwise(same)

    return F.aggregate(tokens(text), start, step, lambda state: state["best"])


def highlight(text: Column, words: list[str]) -> Column:
    """Mark hits; for the rows of one result page."""
    pattern = "|".join(re.escape(w) for w in words)
    return F.regexp_replace(text, rf"(?i)\b({pattern})\b", "<b>$1</b>")


def trigrams(text: Column) -> Column:
    """Distinct three-letter pieces of the words, each padded with two blanks before and one after."""
    padded = F.transform(tokens(text), lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    pieces = F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))
    return F.array_distinct(F.flatten(pieces))


def similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams of the two sets."""
    common = F.size(F.array_intersect(a, b))
    return F.coalesce(common / F.nullif(F.size(a) + F.size(b) - common, F.lit(0)), F.lit(0.0))


def fuzzy_matches(rows: DataFrame, text: str, searches: list[str], threshold: float = 0.3) -> DataFrame:
    """``fuzzy_join`` with a few search strings."""
    return fuzzy_join(rows, text, rows.sparkSession.createDataFrame([(s,) for s in searches], "search string"), "search", threshold)


def fuzzy_join(rows: DataFrame, text: str, searches: DataFrame, search: str, threshold: float = 0.3) -> DataFrame:
    """Rows whose ``text`` resembles a search, for a table of searches: (…, search, similarity).

    Two sets with a similarity of ``threshold`` share a trigram among their rarest ones: of n all but
    ``ceil(threshold * n) - 1``. Distinct texts and searches meet on those trigrams only, if their sizes allow the
    similarity; what meets is compared in full. So neither side is paired with all of the other.
    """
    texts = rows.select(text).distinct().select(F.col(text).alias("_text"), trigrams(F.col(text)).alias("_grams")).filter(F.size("_grams") > 0)
    wanted = searches.select(F.col(search).alias("_search")).distinct().select("_search", trigrams(F.col("_search")).alias("_wanted")).filter(F.size("_wanted") > 0)
    seen = texts.select(F.explode("_grams").alias("_gram")).groupBy("_gram").agg(F.count("*").alias("_n"))

    def rarest(side: DataFrame, name: str, grams: str) -> DataFrame:
        known = side.select(name, F.size(grams).alias("_size"), F.explode(grams).alias("_gram")).join(seen, "_gram", "left")
        order = F.sort_array(F.collect_list(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("g"))))
        # a hair lower, so that a bound that floating point puts above an integer loses nothing
        first = F.col("_size") - F.ceil(F.col("_size") * threshold - 1e-9) + 1
        lists = known.groupBy(name, "_size").agg(order.alias("_order"))
        return lists.select(name, F.col("_size").alias(f"{name}_size"), F.explode(F.transform(F.slice("_order", F.lit(1), first.cast("int")), lambda x: x["g"])).alias("_gram"))

    a, b = F.col("_text_size"), F.col("_search_size")
    fits = (a >= b * threshold - 1e-9) & (b >= a * threshold - 1e-9)
    met = rarest(texts, "_text", "_grams").join(rarest(wanted, "_search", "_wanted"), "_gram").filter(fits).select("_text", "_search").distinct()
    scored = met.join(texts, "_text").join(wanted, "_search").select("_text", F.col("_search").alias("search"), similarity(F.col("_grams"), F.col("_wanted")).alias("similarity"))
    hits = scored.filter(F.col("similarity") >= threshold)
    return rows.join(hits, F.col(text) == F.col("_text")).drop("_text")
