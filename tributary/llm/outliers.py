"""Quality rules: robust multivariate outliers within each language and source.

Every text gets counts (words, their characters, symbols, repeated lines, words in repeated
five-word windows). Rules on these reject plain junk. Of what passes, four transformed rates form
a vector, and for each language and source the minimum covariance determinant is estimated. Three
deterministic starts (absolute deviations about the medians, covariances of spatial signs and of
hyperbolic tangents) each repeat the concentration step, mean and covariance of the half nearest by
the last estimate, until the determinant falls no more (MOST_STEPS at most); of all estimates on the
way the one with the smallest determinant is the group's. Mean and covariance of all vectors within
CUTOFF of it are the final estimate, and a text farther than CUTOFF from that is rejected.

Only DataFrame functions are used. Vectors are whole numbers of 1/SCALE, so sums are exact and do
not depend on the order of rows; halves are found by histograms of distances, so no group is sorted or
collected, and a source with a third of all rows is reduced by partial aggregates. What is stored
is one narrow row per document; one row per group is joined back, in whatever way Spark's size
check allows.

Defined cases. A null or empty text has zero words, so it fails the rules and has no vector. Null
language or source is a group of its own. LEAST leaves five vectors a dimension in the half. A group
with fewer takes the estimate of its language over all sources, or else of the whole corpus; in a corpus
with fewer there is no estimate and the rules alone decide. Each direction has a least deviation, by which
a text that differs from its group by SLACK, or by one line of the group's median text, in that direction alone is
kept; so a group of equal texts does not reject all others. Equal rows have equal results. An empty table
gives an empty result. Columns other than id, text, language and source are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tributary.llm.common import WORD
from tributary.storage import write_and_read

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
GRAM = 5
LEAST_WORDS = 10
REPEATED_SHARE = 20  # per cent of words
SCALE = 1 << 14
MOST_STEPS = 30
FALL = 1e-6  # a determinant that falls by less has settled
LEAST = 40  # vectors per group
BINS = 64  # per doubling of the squared distance
#: Kept whatever the group's spread: a mean word length off by a quarter, 1 % of symbols, 10 % of lines or 15 % of words repeated
SLACK = (0.25, 0.1, 0.316, 0.387)
RIDGE = 0.05  # added to the starts' covariances, which are about 1
CONSISTENT = 2.42  # four dimensions: normal variance over that of the nearest half
CUTOFF = 23.51  # squared distance: the 0.9999 quantile of chi-square with four degrees of freedom
VECTOR = ("v0", "v1", "v2", "v3")
GROUP = ("wide", "lang", "source")
#: Centre, lower factor and least deviations of one group
ESTIMATE = (*(f"m{i}" for i in range(4)), *(f"l{i}{j}" for i in range(4) for j in range(i + 1)), *(f"f{i}" for i in range(4)))


def text_counts(documents: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, lang, source and the counts."""
    own = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.col(id_column).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"),
        F.char_length(F.regexp_replace(own, SPACE, "")).cast("long").alias("word_chars"),
        (F.char_length(own) - F.char_length(F.translate(own, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(own, "\n"), lambda x: F.regexp_like(x, F.lit(WORD))).alias("lines"),
        F.regexp_extract_all(own, F.lit(WORD), F.lit(0)).alias("words"),
    )
    hashed = F.transform("words", lambda w: F.xxhash64(w))
    rows = rows.withColumn("n_words", F.size("words").cast("long")).withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    rows = rows.withColumn("h", hashed).drop("words").withColumn("n_lines", F.size("lines").cast("long")).drop("lines")
    window = lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(GRAM)])
    starts = F.when(F.col("n_words") >= GRAM, F.sequence(F.lit(0), (F.col("n_words") - GRAM).cast("int")))
    rows = rows.withColumn("g", F.transform(starts, window)).drop("h")
    # only texts with equal windows need them in order
    placed = F.sort_array(F.arrays_zip(F.col("g"), F.sequence(F.lit(0), F.size("g") - 1).alias("i")))
    rows = rows.withColumn("s", F.when(F.size(F.array_distinct("g")) < F.size("g"), placed)).drop("g")
    twice = F.filter("s", lambda x, k: (F.get("s", k - 1)["g"] == x["g"]).eqNullSafe(True) | (F.get("s", k + 1)["g"] == x["g"]).eqNullSafe(True))
    rows = rows.withColumn("at", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("s")
    covered = F.aggregate(
        "at", F.struct(F.lit(0).alias("n"), F.lit(-GRAM).alias("last")),
        lambda acc, x: F.struct((acc["n"] + F.least(F.lit(GRAM), x - acc["last"])).alias("n"), x.alias("last")),
        lambda acc: acc["n"],
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("at")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_SHARE)


def vectors(counts: DataFrame) -> DataFrame:
    """Fixed-point vector: log of the mean word length, and square roots of the shares of symbols, repeated lines (after the first: one
    repeated line is no sign of junk) and repeated words."""
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    values = [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))), share("n_symbols", "word_chars"), F.sqrt(F.greatest(F.col("n_dup_lines") - 1, F.lit(0)) / F.greatest(F.col("n_lines"), F.lit(1))), share("n_repeat_words", "n_words")]
    failed = base_failed()
    return counts.withColumn("base_failed", failed).withColumns({n: F.when(~failed, F.round(v * SCALE)).cast("long") for n, v in zip(VECTOR, values)})


def _middle(rows: DataFrame, group: list[str], bin_: Column, share: float) -> DataFrame:
    """For each group the smallest bin up to which at least ``share`` of its rows lie."""
    counted = rows.groupBy(*group, bin_.alias("bin")).agg(F.count("*").alias("n"))
    by = Window.partitionBy(*group)
    upto = counted.withColumn("upto", F.sum("n").over(by.orderBy("bin"))).withColumn("all", F.sum("n").over(by))
    return upto.filter(F.col("upto") >= F.col("all") * share).groupBy(*group).agg(F.min("bin").alias("bin"), F.max("all").alias("all"))


def _with(rows: DataFrame, table: DataFrame, group: tuple[str, ...] = GROUP, how: str = "left") -> DataFrame:
    """Join per-group values to rows; null groups match."""
    right = table.withColumnsRenamed({c: f"_{c}" for c in group})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group])
    return rows.join(right, same, how).drop(*[f"_{c}" for c in group])


def _named(wide: Column) -> dict[str, Column]:
    """The group at a level: 0 is the language and source, 1 the language, 2 everything."""
    return {"wide": wide, "source": F.when(wide < 1, F.col("source")), "lang": F.when(wide < 2, F.col("lang"))}


def _levels(passed: DataFrame) -> DataFrame:
    """lang, source → the level of the first group with LEAST vectors; without any, no row."""
    sizes = passed.groupBy("lang", "source").agg(F.count("*").alias("n0"))
    sizes = _with(sizes, sizes.groupBy("lang").agg(F.sum("n0").alias("n1")), ("lang",)).withColumn("n2", sizes.agg(F.sum("n0")).scalar())
    enough = reduce(lambda when, i: when.when(F.col(f"n{i}") >= LEAST, i), (1, 2), F.when(F.col("n0") >= LEAST, 0))
    return sizes.select("lang", "source", enough.alias("wide")).filter(F.col("wide").isNotNull())


def _factor(out: DataFrame, least: list[Column]) -> DataFrame:
    """Cholesky factor l00… of the covariance c00…; ``least`` bounds its diagonal from below."""
    for i in range(4):
        for j in range(i + 1):
            value = F.col(f"c{i}{j}")
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(value, least[i] ** 2)) if i == j else value / F.col(f"l{j}{j}"))
    return out


def _starts(rows: DataFrame) -> DataFrame:
    """Three starts per group: centre m0…, Cholesky factor l00…, least deviations f0…, and no determinant yet."""
    group = list(GROUP)
    step = SCALE // 64
    lines = _middle(rows, group, F.col("n_lines"), 0.5).select(*group, F.greatest(F.col("bin"), F.lit(1)).alias("lines"))
    state = lines.withColumns({f"f{i}": (F.greatest(F.lit(s), F.sqrt(1 / F.col("lines"))) if i == 2 else F.lit(s)) / CUTOFF**0.5 for i, s in enumerate(SLACK)}).drop("lines")
    for i, v in enumerate(VECTOR):
        middle = _middle(rows, group, F.floor(F.col(v) / step), 0.5).select(*group, ((F.col("bin") + 0.5) * step / SCALE).alias(f"m{i}"))
        state = _with(state, middle)
    state = write_and_read(state, "quality-medians")  # a small plan for the driver
    placed = _with(rows, state)
    for i, v in enumerate(VECTOR):
        off = F.floor(F.abs(F.col(v) / SCALE - F.col(f"m{i}")) * 64)
        wide = _middle(placed, group, off, 0.5).select(*group, ((F.col("bin") + 1) / 64 * 1.4826).alias("wide_"))
        state = _with(state, wide).withColumn(f"s{i}", F.greatest(f"f{i}", "wide_")).drop("wide_")
    state = write_and_read(state, "quality-deviations")
    z = [(F.col(v) / SCALE - F.col(f"m{i}")) / F.col(f"s{i}") for i, v in enumerate(VECTOR)]
    far = F.greatest(F.sqrt(reduce(lambda a, b: a + b, [c * c for c in z])), F.lit(1e-9))
    shapes = {1: [c / far * 2 for c in z], 2: [F.tanh(c) for c in z]}
    fixed = {f"{kind}_{i}": F.round(c * SCALE).cast("long") for kind, shape in shapes.items() for i, c in enumerate(shape)}
    products = [F.sum((F.col(f"{k}_{i}") * F.col(f"{k}_{j}")).cast("decimal(38,0)")).alias(f"p{k}{i}{j}") for k in shapes for i in range(4) for j in range(i + 1)]
    sums = _with(rows, state).select(*group, *[c.alias(n) for n, c in fixed.items()]).groupBy(*group).agg(F.count("*").alias("n"), *products)
    state = write_and_read(_with(state, sums), "quality-signs")
    starts = []
    for kind in (0, *shapes):
        covariance = lambda i, j: F.col(f"p{kind}{i}{j}").cast("double") / F.col("n") / SCALE**2 + (RIDGE if i == j else 0.0) if kind else F.lit(float(i == j))  # noqa: B023, E731
        shaped = state.withColumns({f"c{i}{j}": covariance(i, j) * F.col(f"s{i}") * F.col(f"s{j}") for i in range(4) for j in range(i + 1)})
        starts.append(_factor(shaped, [F.col(f"s{i}") / 100 for i in range(4)]).withColumns({"start": F.lit(kind), "det": F.lit(float("inf"))}))
    return reduce(DataFrame.unionByName, [s.select(*group, "start", "det", *ESTIMATE) for s in starts])


def solved() -> list[Column]:
    """Forward substitution with the factor's columns; the squares add up to the Mahalanobis distance."""
    out: list[Column] = []
    for i, v in enumerate(VECTOR):
        rest = F.col(v) / SCALE - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"y{j}")
        out.append(rest / F.col(f"l{i}{i}"))
    return out


def with_distance(rows: DataFrame, state: DataFrame, how: str = "left") -> DataFrame:
    out = _with(rows, state, how=how)
    for i, y in enumerate(solved()):
        out = out.withColumn(f"y{i}", y)
    total = reduce(lambda a, b: a + b, [F.col(f"y{i}") ** 2 for i in range(4)])
    return out.withColumn("d2", total).drop(*[f"y{i}" for i in range(4)])


def _bin() -> Column:
    return F.floor(F.log2(F.col("d2") + 2.0**-10) * BINS)


def _estimate(near: DataFrame, by: list[str], consistent: float) -> DataFrame:
    """Mean, covariance and its factor of the rows ``near``, with ``det``, the root of the determinant, and the one ``was`` before."""
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(VECTOR)]
    products = [F.sum((F.col(VECTOR[i]) * F.col(VECTOR[j])).cast("decimal(38,0)")).alias(f"p{i}{j}") for i in range(4) for j in range(i + 1)]
    out = near.groupBy(*by).agg(F.count("*").alias("n"), F.max("det").alias("was"), *[F.max(f"f{i}").alias(f"f{i}") for i in range(4)], *sums, *products)
    n = F.col("n").cast("double")
    mean = lambda i: F.col(f"s{i}") / n
    out = out.withColumns({f"m{i}": mean(i) / SCALE for i in range(4)} | {
        f"c{i}{j}": (F.col(f"p{i}{j}").cast("double") / n - mean(i) * mean(j)) / (SCALE * SCALE) * consistent + (F.col(f"f{i}") ** 2 if i == j else 0.0) for i in range(4) for j in range(i + 1)
    })
    out = _factor(out, [F.col(f"f{i}") / 10 for i in range(4)])
    return out.withColumn("det", F.col("l00") * F.col("l11") * F.col("l22") * F.col("l33")).select(*by, "det", "was", *ESTIMATE)


def _concentrate(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The estimate of the half of each group nearest by ``state``, for each start in it."""
    by = [*GROUP, "start"]
    placed = with_distance(rows, state, "inner").withColumn("b", _bin()).select(*by, *VECTOR, "b", "det", *[f"f{i}" for i in range(4)])
    half = _middle(placed, by, F.col("b"), 0.5).select(*by, F.col("bin").alias("most"))
    return _estimate(_with(placed, half, tuple(by)).filter(F.col("b") <= F.col("most")), by, CONSISTENT)


def least_determinant(rows: DataFrame) -> DataFrame:
    """One estimate per group: the smallest determinant over all starts and steps. A start goes on while its determinant falls."""
    state = write_and_read(_starts(rows), "quality-start")
    met = []
    for step in range(MOST_STEPS):
        met.append(write_and_read(_concentrate(rows, state).withColumn("step", F.lit(step)), "quality-step"))
        state = met[-1].filter(F.col("det") < F.col("was") * (1 - FALL)).drop("was", "step")
        if state.isEmpty():
            break
    best = reduce(DataFrame.unionByName, met).groupBy(*GROUP).agg(F.min_by(F.struct("det", *ESTIMATE), F.struct("det", "start", "step")).alias("e"))
    return best.select(*GROUP, "e.*")


def judge(documents: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, the counts, base_failed, d2 (null without estimate) and kept."""
    counts = write_and_read(vectors(text_counts(documents, id_column, text, lang, source)), "quality-counts")
    passed = counts.filter("not base_failed").select("lang", "source", "n_lines", *VECTOR)
    levels = write_and_read(_levels(passed), "quality-levels")
    wanted = levels.select(*[c.alias(n) for n, c in _named(F.col("wide")).items()]).distinct()
    used = [r.wide for r in levels.select("wide").distinct().orderBy("wide").collect()]
    everywhere = passed.withColumn("wide", F.explode(F.array(*map(F.lit, used)).cast("array<int>")))
    rows = write_and_read(_with(everywhere.withColumns(_named(F.col("wide"))), wanted, how="left_semi"), "quality-rows")
    raw = write_and_read(least_determinant(rows), "quality-least")
    within = with_distance(rows, raw).filter(F.col("d2") <= CUTOFF)
    state = write_and_read(_estimate(within, list(GROUP), 1.0).drop("det", "was"), "quality-estimate")
    judged = with_distance(_with(counts, levels, ("lang", "source")).withColumns(_named(F.col("wide"))), state)
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF, F.lit(True))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "d2")
