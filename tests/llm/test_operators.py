import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tributary.llm import bpe, chat, compression, jaccard, mixing, outliers, substrings, toxicity, urls, vectors
from tributary.llm.common import held_out
from tributary.llm.queries import LLM_QUERIES, VOCABULARY

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", [k for k, q in LLM_QUERIES.items() if q.oracle])
def test_equals_sql(spark, con, key):
    from compare import difference

    assert difference(LLM_QUERIES[key](spark, SMALL), con, LLM_QUERIES[key].oracle) is None


def words(text):
    return (text or "").encode().split()


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_mixing_awkward(awkward, nothing):
    plan = mixing.mix(awkward)
    rows = mixing.mixed_sizes(plan).collect()
    assert len(rows) == awkward.count()
    assert sum(r.target for r in {r.source_size: r for r in rows}.values()) == pytest.approx(sum(r["size"] for r in rows))
    assert all(r.taken <= 3 * r["size"] for r in rows)
    out = mixing.mixed_documents(awkward, plan)
    assert out.columns == awkward.columns
    assert sorted(map(tuple, mixing.mixed_sizes(mixing.mix(awkward)).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert mixing.mixed_sizes(mixing.mix(nothing)).count() == 0


def test_mixing_budgets_nest(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    taken = []
    for weights in ((1, 2), (1, 3)):
        rows = mixing.mixed_sizes(mixing.mix(docs, weights=weights)).collect()
        by = defaultdict(int)
        for r in rows:
            by[r.target] += r.taken
        assert all(abs(t - n) <= 7 for t, n in by.items())
        taken.append({r.doc_id: r.taken for r in rows})
    assert all(taken[1][i] >= taken[0][i] for i in range(1, 400, 2))


@pytest.mark.parametrize("empty", ["c", None])
def test_mixing_shares_the_weight_of_a_source_without_words(spark, empty):
    schema = "doc_id long, text string, source string"
    rows = [(i, "w " * 6, "ab"[i % 2]) for i in range(200)] + [(200 + i, [None, "", " \n"][i % 3], empty) for i in range(30)]
    plan = mixing.mix(spark.createDataFrame(rows, schema))
    assert {r.source: r.target for r in plan.thresholds.collect()} == {"a": 400, "b": 800, empty: 0}
    taken = {r.source_size: r.t for r in mixing.mixed_sizes(plan).groupBy("target", "source_size").agg(F.sum("taken").alias("t")).groupBy("source_size").agg(F.sum("t").alias("t")).collect()}
    assert abs(taken[600] - 1200) <= 12 and taken[0] == 0
    nothing_else = mixing.mix(spark.createDataFrame(rows[200:], schema)).thresholds.collect()
    assert [r.target for r in nothing_else] == [0]


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    chain = toxicity.Chain(np.zeros(1), 0.3, rng.normal(size=(2, 2)))
    lengths = [3, 1, 5, 300]
    e = rng.normal(size=sum(lengths))
    begins = np.zeros(len(e), bool)
    begins[np.cumsum([0] + lengths[:-1])] = True
    found, at = toxicity.marginals(e, begins, chain), 0
    for n in lengths[:3]:
        total, mass = 0.0, np.zeros(n)
        for code in range(2**n):
            y = [code >> i & 1 for i in range(n)]
            w = np.exp(chain.start * y[0] + sum(chain.moves[a, b] for a, b in zip(y, y[1:])) + sum(x * v for x, v in zip(e[at:], y)))
            total, mass = total + w, mass + w * np.array(y)
        assert found[at : at + n] == pytest.approx(mass / total)
        at += n
    forward = np.zeros((300, 2))
    own, step = e[at:], np.exp(chain.moves)
    for t in range(300):
        forward[t] = (np.exp([0, chain.start]) if not t else forward[t - 1] @ step) * np.exp([0, own[t]])
        forward[t] /= forward[t].sum()
    back = np.ones(2)
    for t in reversed(range(300)):
        p = forward[t] * back
        assert found[at + t] == pytest.approx(p[1] / p.sum(), abs=1e-9)
        back = step @ (back * np.exp([0, own[t]]))
        back /= back.sum()


def test_toxicity_held_out(spark, awkward, nothing):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.train(docs, labels, skip=held_out("doc_id", 4, 2))
    rows = toxicity.score(docs, model).join(labels, "doc_id").filter(held_out("doc_id", 4, 2)).collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.98
    text = {r.doc_id: r.text for r in docs.collect()}
    marked = [text[r.doc_id][a:b] for r in rows if r.toxic for a, b in zip(r.span_starts, r.span_ends)]
    assert marked and all(m and m == m.strip() for m in marked)
    scored = toxicity.score(awkward, model).collect()
    assert len(scored) == awkward.count() and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.score(awkward, model, keep=awkward.columns).count() == awkward.count()
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.train(docs, labels.limit(0)).chain is None


def test_compression_held_out(spark, awkward, nothing):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    model = compression.train(docs, labels, skip=held_out("doc_id", 5, 0), per_class=1000)
    rows = compression.score(docs, model).join(labels, "doc_id").filter(held_out("doc_id", 5, 0)).collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert np.mean([r.predicted for r in rows if r.quality]) > 0.97
    assert compression.score(awkward, model).count() == awkward.count()
    assert compression.score(nothing, model).count() == 0
    flat = compression.train(docs, labels.limit(0))
    assert {r.score for r in compression.score(awkward, flat).collect()} == {0.5}


def removed(docs, window):
    split = [words(t) for _, t in docs]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(docs, split):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window", [35, 8])
def test_substrings_brute_force(spark, awkward, nothing, window):
    rng = random.Random(window)
    base = [f"w{rng.randint(0, 400)}" for _ in range(3000)]
    docs = []
    for i in range(120):
        own = []
        for _ in range(rng.randint(1, 6)):
            at = rng.randrange(2900)
            own += base[at : at + rng.randint(5, 90)] if rng.random() < 0.6 else [f"u{rng.randint(0, 9**9)}" for _ in range(rng.randint(1, 40))]
        docs.append((i, " ".join(own)))
    docs += [(900, "same " * 200), (901, docs[0][1]), (902, docs[0][1]), (903, docs[1][1].replace(" ", "\n"))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert Counter(map(tuple, substrings.summary(frame, window=window).collect())) == removed(docs, window)
    assert Counter(map(tuple, substrings.summary(awkward, window=window).collect())) == removed(texts(awkward), window)
    assert substrings.summary(nothing).count() == 0
    cut = substrings.without_repeats(awkward, window=window)
    assert cut.columns == awkward.columns and cut.count() == awkward.count()
    assert sum(len(words(r.text)) for r in cut.collect()) == sum(n - m for _, n, m, _ in removed(texts(awkward), window).elements())


def links_of(docs):
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        sets.append(set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    root, links = list(range(len(docs))), [0] * len(docs)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                links[i], links[j] = links[i] + 1, links[j] + 1
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        groups[find(i)].append(d)
    least = {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}
    return Counter((d, len(sets[i]), least[find(i)], links[i]) for i, (d, _) in enumerate(docs)), groups


@pytest.mark.parametrize("task, common", [(3_000_000, 500), (900, 3)])
def test_jaccard_brute_force(spark, awkward, nothing, monkeypatch, task, common):
    monkeypatch.setattr(jaccard, "TASK", task)
    monkeypatch.setattr(jaccard, "COMMON", common)
    rng = random.Random(task)
    base = [[f"w{rng.randint(0, 5000)}" for _ in range(n)] for n in (120, 60, 30, 12, 7, 300)]
    docs = []
    for i in range(250):
        own = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(own) // 25))):
            k, r = rng.randrange(len(own)), rng.random()
            own[k : k + 1] = [f"x{rng.randint(0, 9**6)}"] if r < 0.4 else [own[k], f"y{rng.randint(0, 99)}"] if r < 0.7 else []
        docs.append((i, " ".join(own)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    expected, groups = links_of(docs)
    assert Counter(map(tuple, jaccard.linked_documents(jaccard.join(frame)).collect())) == expected
    assert jaccard.one_of_each(frame).count() == len(groups)
    if common == 500:
        assert Counter(map(tuple, jaccard.linked_documents(jaccard.join(awkward)).collect())) == links_of(texts(awkward))[0]
        assert jaccard.one_of_each(awkward).columns == awkward.columns
        assert jaccard.linked_documents(jaccard.join(nothing)).count() == 0


def test_bpe_equals_library(spark, awkward, nothing):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), bpe.Encoder(bpe.read_vocabulary(VOCABULARY))
    rng = random.Random(1)
    letters = "abcdeéüßñ'’.,!?  \n\t\xa0ΣσİI01Ⅷ日本e\u0300\x1c\x85\u2028 <|>"
    tokens = list(library.get_vocab())
    cases = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    cases += ["".join(rng.choice(tokens).replace("</w>", "") for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    cases += ["x" * 5000, "ab" * 3000, "!?" * 2000, "a<|endoftext|><|startoftext|>b", "\x00"]
    for case, wanted in zip(cases, library.encode_batch(cases, add_special_tokens=False)):
        ids = own.encode(case)
        assert np.frombuffer(ids, "<u4").tolist() == wanted.ids, case
        assert own.decode(ids).decode() == library.decode(wanted.ids, skip_special_tokens=False), case
    rows = bpe.encode(awkward, VOCABULARY, keep_ids=True)
    for r in bpe.decode(rows, VOCABULARY).collect():
        assert hashlib.sha256(r.decoded.encode()).hexdigest() == r.decoded_sha256 and len(r.ids) == 4 * r.n_tokens
    assert rows.count() == awkward.count() and bpe.encode(nothing, VOCABULARY).count() == 0


def test_outliers_counts_and_verdicts(spark, awkward, nothing):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").unionByName(awkward.select("doc_id", "text", "lang", "source"))
    docs = docs.withColumns({c: F.lit(7) for c in ("wide", "n", "m0", "d2", "start", "lines")})
    rows = {}
    for r in outliers.judge(docs).collect():
        rows.setdefault((r.doc_id, r.n_words), r)
    for d, t in texts(docs):
        w = words(t)
        twice = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if twice[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        r = rows[(d, len(w))]
        assert (r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (sum(len(x.decode()) for x in w), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (r.base_failed and r.kept)
    assert outliers.judge(nothing).count() == 0


def test_outliers_reject_what_is_far_from_its_group(spark):
    rng = random.Random(4)
    plain = lambda: " ".join("abcdefgh"[: rng.randint(3, 8)] + str(rng.randint(0, 999)) for _ in range(rng.randint(40, 90)))
    rows = [(i, plain(), "en", "s") for i in range(300)] + [(1000 + i, " ".join(x + "***" for x in plain().split()), "en", "s") for i in range(60)]
    rows += [(2000 + i, " ".join(x + "***" for x in plain().split()), "en", "few") for i in range(5)]
    kept = {r.doc_id: r.kept for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[1000 + i] for i in range(60))
    assert not any(kept[2000 + i] for i in range(5))  # too few for their own estimate: that of the language


def test_outliers_in_each_direction(spark):
    """Long words, symbols, repeated lines and repeated words, each alone, in a group whose clean texts have none of these."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9)))
    lines = lambda n=30: [" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(n)]
    clean = [(i, "\n".join(lines())) for i in range(300)]
    clean += [(300 + i, "\n".join([*(own := lines()), own[3]])) for i in range(20)]  # one line twice
    long = [(1000 + i, "\n".join(x.replace(" ", "") + word() * 3 for x in lines())) for i in range(20)]
    symbols = [(1100 + i, "\n".join(x + "#|" for x in lines())) for i in range(20)]
    repeated = [(1200 + i, "\n".join(own + rng.sample([x for x in own if " " not in x] * 2, 6))) for i in range(20) if (own := [word() for _ in range(5)] + lines(9))]
    again = []
    for i in range(20):
        own = " ".join(lines(60)).split()[:100]
        again.append((1300 + i, "\n".join(" ".join(own[at : at + 10]) + " " + (" ".join(own[:10]) if at == 50 else word()) for at in range(0, 100, 10))))
    rows = clean + long + symbols + repeated + again
    got = {r.doc_id: r for r in outliers.judge(spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i].kept for i, _ in clean)
    for group in (long, symbols, repeated, again):
        assert not any(got[i].kept for i, _ in group), group[0][0]
    assert not any(got[i].base_failed for i, _ in rows)


def test_outliers_determinant_is_the_least_that_many_random_starts_find(spark):
    """Against plain concentration steps from 200 random subsets, on groups of which a third lies elsewhere."""
    rng = np.random.default_rng(8)
    data = {}
    for source, n in (("a", 120), ("b", 81), (None, 60)):
        shape = rng.normal(size=(4, 4))
        x = rng.normal(size=(n, 4)) @ shape + 3
        x[: n // 3] = rng.normal(size=(n // 3, 4)) * 0.5 + rng.normal(size=4) * 9
        data[source] = np.round(x * outliers.SCALE).astype(int)
    rows = [(0, "en", source, 100, *map(int, v)) for source, x in data.items() for v in x]
    frame = spark.createDataFrame(rows, "wide int, lang string, source string, n_lines long, v0 long, v1 long, v2 long, v3 long")
    found = {r.source: r for r in outliers.least_determinant(frame).collect()}
    floors = np.array(outliers.SLACK) / outliers.CUTOFF**0.5
    for source, whole in data.items():
        x, best = whole / outliers.SCALE, np.inf
        half = (len(x) + 1) // 2
        for _ in range(200):
            near = x[rng.choice(len(x), 6, replace=False)]
            for _ in range(30):
                cov = np.cov(near.T, bias=True) * outliers.CONSISTENT + np.diag(floors**2)
                off = x - near.mean(0)
                near = x[np.argsort(np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off))[:half]]
            best = min(best, np.linalg.det(np.cov(near.T, bias=True) * outliers.CONSISTENT + np.diag(floors**2)) ** 0.5)
        assert found[source].det <= best * 1.15
        centre = [found[source][f"m{i}"] for i in range(4)]
        assert np.linalg.norm(centre - x[len(x) // 3 :].mean(0)) < np.linalg.norm(centre - x[: len(x) // 3].mean(0)) / 3


def test_outliers_small_groups_take_a_wider_estimate(spark):
    rng = random.Random(5)
    plain = lambda: " ".join("abcdefgh"[: rng.randint(3, 8)] + str(rng.randint(0, 999)) for _ in range(rng.randint(40, 90)))
    junk = lambda: " ".join(x + "***" for x in plain().split())
    rows = [(i, plain(), "en", f"s{i % 30}") for i in range(300)] + [(1000 + i, junk(), "en", f"s{i % 30}") for i in range(30)]
    rows += [(400 + i, plain(), [None, "de"][i % 2], None) for i in range(20)] + [(1100 + i, junk(), [None, "de"][i % 2], None) for i in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = outliers.judge(frame).collect()
    assert len(found) == len(rows) and all(r.d2 is not None for r in found)
    assert {r.doc_id for r in found if not r.kept} == {i for i, *_ in rows if i >= 1000}
    # fewer in the whole corpus than an estimate needs
    assert all(r.kept and r.d2 is None for r in outliers.judge(frame.filter("lang is null")).collect())


def test_cascade_is_exact_on_the_universe(spark):
    keys = spark.range(20000).select(F.xxhash64("id").alias("a"), F.xxhash64(F.lit(1), "id").alias("b"), "id")
    listed, other = keys.filter("id % 40 = 0").select("a", "b"), keys.filter("id % 40 != 0").select("a", "b")
    cascade = urls.build_cascade(listed, other)
    assert len(cascade.levels) > 2 and sum(len(x.bits) for x in cascade.levels) < 4096
    for frame, wanted in ((listed, True), (other, False)):
        rows = frame.toPandas()
        assert (cascade.holds(rows.a.to_numpy(), rows.b.to_numpy()) == wanted).all()


def test_urls_awkward(spark):
    rules = urls.rules_frame(spark, [("allow", "com", "/"), ("block", "example.com", "/en/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")])
    pages = [(1, None), (2, "no scheme/x"), (3, "http://EXAMPLE.com/en/a?q#f"), (4, "https://www.Example.COM/en/"), (5, "http://a.net/es/1"), (6, "http://a.net/esx"), (7, "http://com"), (8, "http://x.com/?a://b"), (8, "http://x.com/?a://b"), (None, "ftp://b.example.com/en/x")]
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string").withColumn("keys", F.lit(1)), rules).collect()}
    assert got == {
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "example.com", "/en/a", "example.com/en/", "block"), (4, "www.example.com", "/en/", "www.example.com/en/", "allow"),
        (5, "a.net", "/es/1", "net/es/", "block"), (6, "a.net", "/esx", None, "allow"), (7, "com", "", None, "allow"), (8, "x.com", "/", "com/", "allow"), (None, "b.example.com", "/en/x", "example.com/en/", "block"),
    }
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0


def test_vectors_recall_and_awkward(spark):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(60):
        centre = rng.normal(size=32)
        rows += [(len(rows) + i, (centre + rng.normal(size=32) * 0.09).tolist(), int(c % 2)) for i in range(rng.integers(1, 25))]
    rows = [(i, v, g) for i, (_, v, g) in enumerate(rows)]
    bad = [(9000, None, 1), (9001, [0.0] * 32, 1), (9002, [float("nan")] * 32, 1), (9003, rows[0][1], None), (9004, [1.0], 1), (9005, [], 1), (9006, [None] * 32, 1), (None, rows[0][1], rows[0][2]), (0, rows[0][1], rows[0][2])]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int")
    got = vectors.near_copies(frame).collect()
    assert len(got) == len(rows) + len(bad)
    good = rows + bad[-2:]
    x = vectors.unit(np.array([v for _, v, _ in good]))
    same = (x @ x.T >= 0.98) & (np.array([g for *_, g in good])[:, None] == np.array([g for *_, g in good])[None])
    wanted = same.sum(1) - 1
    found = {r.vec_id: r.n_links for r in got if r.vec_id not in (None, 0)}
    recall = sum(found[i] for i, *_ in rows[1:]) / wanted[1 : len(rows)].sum()
    assert 0.9 <= recall <= 1 and all(found[i] <= wanted[i] for i, *_ in rows[1:])
    assert all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in got if (r.vec_id or 0) >= 9000)
    assert vectors.near_copies(frame.limit(0)).count() == 0


def test_chat_snapshots(spark):
    talk = [("user", "hi"), ("assistant", "hello <|im_end|>"), ("user", None), ("assistant", "")]
    rows = [(c, t, r, x) for c, n in ((1, 1), (2, 2), (3, 4), (4, 4), (5, 3)) for t, (r, x) in enumerate(talk[:n])]
    rows += [(6, 10 * t, r, x) for t, (r, x) in enumerate(talk[:2])] + [(7, 0, "user", "hi"), (7, 1, "assistant", "other")] + [(8, 0, None, "")] + [(3, 0, "user", "hi")] + [(None, None, "user", "lone")]
    rows += [(9, t, "user", f"t{t}") for t in range(700)] + [(10, t, "user", f"t{t}") for t in range(600)]
    got = {r.conv: r for r in chat.collapse(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {c: (r.n_turns, r.copies) for c, r in got.items()} == {3: (4, 2), 7: (2, 1), 8: (1, 1), None: (1, 1), 9: (700, 1)}
    assert got[3].chat == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello < |im_end|><|im_end|>\n<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert chat.collapse(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, given, SMALL)
        if name != "encoding":
            assert out.columns == docs.columns
        given = corpus_pipeline.write_and_read(out, f"test-{name}")
        assert given.count() > 0
        if name == "near_copies":
            assert all(r.n_links == 0 for r in jaccard.linked_documents(jaccard.join(given)).collect())
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"


def test_toxicity_class_without_words(spark):
    rows = [(i, f"clean words number {i}", 0) for i in range(40)] + [(100 + i, [None, "", " \n"][i % 3], 1) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(frame, frame.select("doc_id", "toxic"))
    assert model.chain is None
    assert {round(r.score, 6) for r in toxicity.score(frame, model).collect()} == {round(20.5 / 61, 6)}


def test_rows_without_id_are_told_apart_by_64_bits(spark):
    """Two texts whose 32-bit hashes are equal, both without an id; one repeats a passage."""
    hashed = spark.range(400_000).select("id", F.hash(F.concat(F.lit("u"), "id")).alias("h"))
    a, b = hashed.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n")).filter("n > 1").orderBy("h").select("a", "b").first()
    tails = [f"u{a}", f"u{b}"]
    # hash() of a string goes on from the hash of what is before: equal starts, then words that collide
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(None, tails[0]), (None, tails[1]), (1, passage), (2, passage + " z"), (None, None), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert frame.filter("doc_id is null and text like 'u%'").select(F.hash("text")).distinct().count() == 1
    assert Counter(map(tuple, substrings.summary(frame).collect())) == removed(rows, 35)
    assert jaccard.one_of_each(frame).count() == 5  # the passage and its near copy are one group


def test_urls_very_long(spark):
    rules = urls.rules_frame(spark, [("block", "example.com", "/"), ("allow", "a.b.c.example.com", "/x/")])
    long_host = ".".join("l" * (i % 5 + 1) for i in range(60_000)) + ".example.com"
    rows = [(1, f"http://{long_host}/y"), (2, "http://example.com/" + "p" * 200_000), (3, "http://q.a.b.c.example.com/x/y"), (4, "http://" + "." * 50_000 + "/")]
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got == {1: ("example.com/", "block"), 2: ("example.com/", "block"), 3: ("a.b.c.example.com/x/", "allow"), 4: (None, "allow")}
    assert {r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules.limit(0)).collect()} == {"allow"}


def test_vectors_recall_with_many_centres(spark):
    """256 inverted lists, of which four are read."""
    rng = np.random.default_rng(7)
    rows = []
    for c in range(500):
        centre = rng.normal(size=32)
        rows += [(centre + rng.normal(size=32) * 0.09).tolist() for _ in range(rng.integers(1, 10))]
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as node", "'x' as g", "2 as cell")
    x = vectors.unit(np.array(rows))
    wanted = (x @ x.T >= 0.98).sum(1) - 1
    found = {r.vec_id: r.n_links for r in vectors.near_copies(frame, probes=4, centres=256).collect()}
    few = {r.vec_id: r.n_links for r in vectors.near_copies(frame, probes=1, centres=256).collect()}
    assert all(found[i] <= n for i, n in enumerate(wanted.tolist()))
    assert wanted.sum() > 500 and sum(found.values()) >= 0.9 * wanted.sum()
    assert sum(few.values()) <= sum(found.values())
