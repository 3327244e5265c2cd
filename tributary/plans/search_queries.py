"""Text search queries over whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tributary.operators import search, text_index
from tributary.plans.registry import query
from tributary.plans.sql import cte, with_
from tributary.storage import run_path
from tributary.tables import Tables

WORDS = ["the", "that"]
SEARCHES = ["smal wigdet", "red plate", "anvill hot"]

cte("doc_tokens", "SELECT *, regexp_extract_all(lower(body), '[\\p{L}\\p{N}]+') AS toks FROM search_docs", "search_docs")
cte("doc_words", "SELECT doc_id, lang, generate_subscripts(toks, 1) AS pos, unnest(toks) AS term FROM doc_tokens", "doc_tokens")
cte(
    "title_words",
    """SELECT doc_id, generate_subscripts(toks, 1) AS pos, unnest(toks) AS term FROM (SELECT doc_id,
    regexp_extract_all(lower(title), '[\\p{L}\\p{N}]+') AS toks FROM search_docs)""",
    "search_docs",
)
cte(
    "ranked",
    """SELECT d.doc_id, lang, source, body, CAST(coalesce(t.n, 0) * 1.0::DOUBLE + coalesce(b.n, 0) * 0.4::DOUBLE AS DOUBLE) AS rank FROM search_docs d
    JOIN (SELECT doc_id, count(*) AS n, count(DISTINCT term) AS k FROM doc_words WHERE term IN ('the', 'that') GROUP BY 1) b ON d.doc_id = b.doc_id AND k = 2
    LEFT JOIN (SELECT doc_id, count(*) AS n FROM title_words WHERE term IN ('the', 'that') GROUP BY 1) t ON d.doc_id = t.doc_id""",
    "search_docs",
    "doc_words",
    "title_words",
)


INDEXES: dict[tuple[str, str], text_index.TextIndex] = {}


def stored_index(t: Tables) -> text_index.TextIndex:
    """Index of the documents, built by the first search of an application and read by the others; the text's length is kept to filter by."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in INDEXES:
        docs = t.search_docs.withColumn("n_chars", F.length("body"))
        INDEXES[key] = text_index.build(docs, "title", "body", "doc_id", ["lang", "source", "n_chars"], run_path(t.spark, "text-index"))
    return INDEXES[key]


def body() -> Column:
    return search.normal(F.col("body"))


@query(
    "fts_01_inverted_index",
    with_("doc_words", "SELECT term, doc_id, string_agg(pos, ',' ORDER BY pos) AS positions FROM doc_words GROUP BY 1, 2"),
)
def inverted_index(t: Tables) -> DataFrame:
    index = search.postings(t.search_docs, "body", "doc_id")
    return index.withColumn("positions", F.array_join(F.transform("positions", lambda p: p.cast("string")), ","))


@query(
    "fts_01_english_index",
    with_(
        "doc_words",
        f"""SELECT term, doc_id, count(*) AS hits FROM (SELECT doc_id, regexp_replace(term, '^(.{{3,}}?)(ing|ed|ly|es|s)$', '\\1') AS term FROM doc_words
        WHERE term NOT IN ({", ".join(f"'{w}'" for w in search.STOPWORDS)})) GROUP BY 1, 2""",
    ),
)
def english_index(t: Tables) -> DataFrame:
    index = search.postings(t.search_docs, "body", "doc_id", english=True)
    return index.select("term", "doc_id", F.size("positions").cast("bigint").alias("hits"))


@query(
    "fts_02_weighted_index",
    with_(
        "doc_words title_words",
        """SELECT term, doc_id, weight, count(*) AS hits, min(pos) AS first_pos, max(pos) AS last_pos FROM (SELECT doc_id, term, pos, 'A' AS weight FROM title_words
        UNION ALL SELECT doc_id, term, pos, 'B' FROM doc_words) GROUP BY 1, 2, 3""",
    ),
)
def weighted_index(t: Tables) -> DataFrame:
    index = search.weighted_postings(t.search_docs, "title", "body", "doc_id")
    return index.select(
        "term",
        "doc_id",
        "weight",
        F.size("positions").cast("bigint").alias("hits"),
        F.element_at("positions", 1).cast("bigint").alias("first_pos"),
        F.element_at("positions", -1).cast("bigint").alias("last_pos"),
    )


FORMS = {"all": "with that", "phrase": '"with the"', "exclude": "with -that", "either": "auf or pour or los"}


@query(
    "fts_03_query_forms",
    with_(
        "doc_tokens",
        """SELECT doc_id, list_contains(toks, 'with') AND list_contains(toks, 'that') AS "all",
        ' ' || array_to_string(toks, ' ') || ' ' LIKE '% with the %' AS phrase, list_contains(toks, 'with') AND NOT list_contains(toks, 'that') AS exclude,
        list_has_any(toks, ['auf', 'pour', 'los']) AS either FROM doc_tokens""",
    ),
)
def query_forms(t: Tables) -> DataFrame:
    return text_index.matching(stored_index(t), FORMS)


@query(
    "fts_04_phrase",
    with_(
        "doc_words",
        """SELECT DISTINCT a.doc_id FROM doc_words a JOIN doc_words b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
        WHERE a.term = 'that' AND b.term = 'the'""",
    ),
)
def phrase(t: Tables) -> DataFrame:
    return text_index.with_phrase(stored_index(t), ["that", "the"])


@query("fts_05_prefix", with_("doc_words", "SELECT term, count(DISTINCT doc_id) AS docs, count(*) AS hits FROM doc_words WHERE term LIKE 'th%' GROUP BY 1"))
def prefix(t: Tables) -> DataFrame:
    rows = stored_index(t).prefixed("th").filter(F.col("weight") == "B")
    return rows.groupBy("term").agg(F.count("*").alias("docs"), F.sum("hits").cast("bigint").alias("hits"))


def ranked(t: Tables) -> DataFrame:
    found = t.search_docs.filter(search.has_words(body(), WORDS))
    return found.withColumn("rank", search.rank(F.col("title"), F.col("body"), WORDS))


@query("fts_06_rank", with_("ranked", "SELECT doc_id, rank FROM ranked"))
def rank(t: Tables) -> DataFrame:
    return text_index.ranked(stored_index(t), WORDS)


@query(
    "fts_06_rank_by_closeness",
    with_(
        "doc_words",
        """SELECT doc_id, CAST(min(pos - prev_pos) AS INTEGER) AS span, 1 / CAST(min(pos - prev_pos) AS DOUBLE) AS rank FROM (SELECT doc_id, term, pos, lag(term) OVER w AS prev,
        lag(pos) OVER w AS prev_pos FROM doc_words WHERE term IN ('the', 'that') WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
        WHERE term <> prev GROUP BY 1""",
    ),
)
def rank_by_closeness(t: Tables) -> DataFrame:
    return text_index.spans(stored_index(t), WORDS).withColumn("rank", F.lit(1) / F.col("span"))


@query("fts_06_top_page", with_("ranked", "SELECT doc_id, rank FROM ranked ORDER BY rank DESC, doc_id LIMIT 10"))
def top_page(t: Tables) -> DataFrame:
    """Blocks of documents that cannot reach the page are not read."""
    return text_index.top(stored_index(t), WORDS, 10).select("doc_id", "rank")


@query(
    "fts_07_highlight",
    with_(
        "ranked",
        """SELECT doc_id, rank, regexp_replace(body, '(?i)\\b(the|that)\\b', '<b>\\1</b>', 'g') AS headline FROM ranked
        WHERE lang = 'en' ORDER BY rank DESC, doc_id LIMIT 10""",
    ),
)
def highlight(t: Tables) -> DataFrame:
    """Only the ten rows of the result page are marked."""
    page = ranked(t).filter(F.col("lang") == "en").orderBy(F.desc("rank"), "doc_id").limit(10)
    return page.select("doc_id", "rank", search.highlight(F.col("body"), WORDS).alias("headline"))


@query(
    "fts_08_token_trace",
    with_(
        "search_docs",
        f"""SELECT raw, lower(raw) AS normalised, lower(raw) IN ({", ".join(f"'{w}'" for w in search.STOPWORDS)}) AS stopword,
        regexp_replace(lower(raw), '^(.{{3,}}?)(ing|ed|ly|es|s)$', '\\1') AS stem, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all(body, '[\\p{{L}}\\p{{N}}]+')) AS raw FROM search_docs) GROUP BY 1, 2, 3, 4""",
    ),
)
def token_trace(t: Tables) -> DataFrame:
    """What becomes of each word on its way into the English index."""
    raw = F.explode(F.regexp_extract_all("body", F.lit(search.WORD), F.lit(0)))
    counted = t.search_docs.select(raw.alias("raw")).groupBy("raw").agg(F.count("*").alias("n"))
    lowered = F.lower("raw")
    return counted.select(
        "raw", lowered.alias("normalised"), lowered.isin(search.STOPWORDS).alias("stopword"), search.stem(lowered).alias("stem"), "n"
    )


@query(
    "fts_09_accent_insensitive",
    with_(
        "search_docs",
        f"""SELECT doc_id, lang, list_contains(regexp_extract_all(translate(lower(body), '{search.ACCENTED}', '{search.PLAIN}'), '[\\p{{L}}\\p{{N}}]+'), 'fur') AS fur,
        list_contains(regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}]+'), 'fur') AS fur_exact FROM search_docs""",
    ),
)
def accent_insensitive(t: Tables) -> DataFrame:
    """"fur" finds "für" once accents are folded."""
    folded = search.normal(search.unaccent(F.col("body")))
    return t.search_docs.select(
        "doc_id", "lang", search.has_words(folded, ["fur"]).alias("fur"), search.has_words(body(), ["fur"]).alias("fur_exact")
    )


def _grams_sql(text: str) -> str:
    return f"""list_distinct(flatten(list_transform(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+'),
        lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"""


SIMILAR = f"""SELECT name, search, len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) AS similarity FROM
    (SELECT DISTINCT p_name AS name, {_grams_sql('p_name')} AS a FROM part),
    (SELECT search, {_grams_sql('search')} AS b FROM (VALUES {", ".join(f"('{s}')" for s in SEARCHES)}) v(search))"""


@query("fts_10_trigram_match", f"SELECT p_partkey AS product_id, name, search, similarity FROM ({SIMILAR}) JOIN part ON p_name = name WHERE similarity >= 0.3")
def trigram_match(t: Tables) -> DataFrame:
    return search.fuzzy_matches(t.shop_products.select("product_id", "name"), "name", SEARCHES)


@query("fts_10_trigrams", f"SELECT p_partkey AS product_id, array_to_string(list_sort({_grams_sql('p_name')}), '|') AS grams FROM part")
def trigrams(t: Tables) -> DataFrame:
    return t.shop_products.select("product_id", F.array_join(F.sort_array(search.trigrams(F.col("name"))), "|").alias("grams"))


@query(
    "fts_11_filtered_search",
    with_("ranked", "SELECT doc_id, lang, source, rank FROM ranked WHERE lang = 'en' AND length(body) < 5000 ORDER BY rank DESC, doc_id LIMIT 15"),
)
def filtered_search(t: Tables) -> DataFrame:
    wanted = (F.col("lang") == "en") & (F.col("n_chars") < 5000)
    return text_index.top(stored_index(t), WORDS, 15, wanted).select("doc_id", "lang", "source", "rank")


@query("fts_12_substring", "SELECT doc_id, lang FROM documents WHERE text ILIKE '%tion%the%'")
def substring(t: Tables) -> DataFrame:
    return t.search_docs.filter(F.col("body").ilike("%tion%the%")).select("doc_id", "lang")


@query(
    "set_02_exact_or_fuzzy",
    f"""SELECT p_partkey AS product_id FROM part WHERE list_contains(string_split(p_name, ' '), 'anvil')
    UNION SELECT p_partkey FROM ({SIMILAR}) JOIN part ON p_name = name WHERE similarity >= 0.3""",
)
def exact_or_fuzzy(t: Tables) -> DataFrame:
    products = t.shop_products.select("product_id", "name")
    exact = products.filter(search.has_words(search.normal(F.col("name")), ["anvil"]))
    fuzzy = search.fuzzy_matches(products, "name", SEARCHES)
    return exact.select("product_id").union(fuzzy.select("product_id")).distinct()
