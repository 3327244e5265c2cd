"""Toxic spans by a linear-chain conditional random field.

Documents are labelled as a whole. Token labels are derived from them: a token of a toxic document
is labelled if its word, or the start of it, occurs in toxic documents in far more different
contexts than in others (log-likelihood ratio; copies of one passage are one context). On such
labelled sequences a two-state linear chain is trained by gradient on its exact likelihood. A text
is then tagged whole: forward-backward gives each token's marginal, the marginals' sum, largest
value and density give the document's score by a logistic curve fitted on other labelled documents, and
tokens with a marginal of a half or more are the offending ones, with their offsets.

Lexicon, chain and curve are fitted on at most ``PER_CLASS`` labelled documents per class and
``SEQUENCES`` sequences per kind; every text is scored whole on the executors.

Defined cases. A null or empty text has no tokens and gets the curve's value for that. Equal texts
get equal scores. Labels other than 0 and 1 and ids without a label are not learned from. With
labels of one class only the score is the share of label 1 (0.5 without labels). Columns beside id
and text are not read. Offsets count characters, the end excluded.
"""

from __future__ import annotations

import hashlib
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tributary.llm.common import Cache, arrow_rows, fit_logistic, kept, labelled_sample, map_texts, sigmoid
from tributary.storage import write_and_read

PER_CLASS = 3000  # labelled documents per class that are learned from
SEQUENCES = 3000  # training sequences with, and as many without, a labelled token
SEQUENCE = 64  # tokens of a training sequence
START = 5  # letters of a word's start that can be in the lexicon
EVIDENCE = 20.0  # least log-likelihood ratio of a lexicon entry
FEATURES = 1 << 16
ROUNDS = 80
BLOCK = 128  # tokens per block of the forward-backward scan
THRESHOLD = 0.3
CACHED_TOKENS = 75_000  # twice as many emissions a Python worker keeps at most
EDGE = ".,;:!?\"'()[]{}<>*#$%&|…«»„“”’-_"


def core(token: str) -> str:
    return token.strip(EDGE).lower()


def features(token: str) -> list[int]:
    """Hashed: the word, its starts and ends, its shape."""
    word = core(token)
    names = ["w" + word, "s" + ("A" if token.isupper() else "a") + ("1" if any(c.isdigit() for c in word) else ""), "n%d" % min(len(word), 12)]
    names += ["p" + word[:n] for n in (3, 4, 5) if len(word) >= n] + ["e" + word[-n:] for n in (3, 4) if len(word) >= n]
    return [xxhash.xxh32_intdigest(n) % FEATURES for n in names]


@dataclass(frozen=True)
class Chain:
    weights: np.ndarray  # of the features, for the offending state against the plain one
    start: float  # log potential of starting in the offending state
    moves: np.ndarray  # 2 x 2 log potentials, from and to


@dataclass(frozen=True)
class Model:
    chain: Chain | None
    curve: tuple[float, ...]  # without a chain: the intercept only


def _scan(r0: float, e: np.ndarray, first: np.ndarray, step: np.ndarray, reset: float) -> np.ndarray:
    """r[t] = e[t] * (step01 + r[t-1] step11) / (step00 + r[t-1] step10), or e[t] * reset where a text begins.

    Such steps are 2 x 2 matrices: every block multiplies its own, one pass over the blocks
    carries the values on, and a second pass inside them fills in the rest.
    """
    n = len(e)
    rows = -(-n // BLOCK)
    pad = rows * BLOCK - n
    e2 = np.concatenate([e, np.ones(pad)]).reshape(rows, BLOCK)
    f2 = np.concatenate([first, np.ones(pad, bool)]).reshape(rows, BLOCK)
    a, b, c, d = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for t in range(BLOCK):
        et, ft = e2[:, t], f2[:, t]
        ma, mb = np.where(ft, 0.0, et * step[1, 1]), np.where(ft, et * reset, et * step[0, 1])
        mc, md = np.where(ft, 0.0, step[1, 0]), np.where(ft, 1.0, step[0, 0])
        a, b, c, d = ma * a + mb * c, ma * b + mb * d, mc * a + md * c, mc * b + md * d
        top = np.maximum(np.maximum(a, b), np.maximum(c, d))
        a, b, c, d = a / top, b / top, c / top, d / top
    enter, r = np.empty(rows), r0
    for k, (x, y, z, w) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist())):
        enter[k] = r
        r = (x * r + y) / (z * r + w)
    out, r = np.empty((rows, BLOCK)), enter
    for t in range(BLOCK):
        r = e2[:, t] * np.where(f2[:, t], reset, (step[0, 1] + r * step[1, 1]) / (step[0, 0] + r * step[1, 0]))
        out[:, t] = r
    return out.ravel()[:n]


def marginals(emission: np.ndarray, begins: np.ndarray, chain: Chain) -> np.ndarray:
    """Probability of the offending state for each token of texts laid end to end; ``begins`` marks first tokens."""
    if not len(emission):
        return np.zeros(0)
    e = np.exp(np.clip(emission, -30, 30))
    step = np.exp(chain.moves)
    forward = _scan(1.0, e, begins, step, float(np.exp(chain.start)))
    ends = np.r_[begins[1:], True]
    # from the right: q[t] = e[t] * b[t], and b[t] = (step10 + q step11) / (step00 + q step01) of the next token
    backward = _scan(1.0, e[::-1], ends[::-1], step.T, 1.0)[::-1]
    odds = forward * backward / e
    return odds / (1 + odds)


def train_chain(tokens: list[list[str]], marks: list[list[int]]) -> Chain:
    """Adaptive gradient ascent on the exact log-likelihood of labelled sequences."""
    words = {w: i for i, w in enumerate(dict.fromkeys(t for s in tokens for t in s))}
    pairs = [(i, f) for w, i in words.items() for f in features(w)]
    word_of, feature_of = np.array(pairs).T
    ids = np.concatenate([[words[t] for t in s] for s in tokens])
    y = np.concatenate(marks).astype(float)
    length = np.array([len(s) for s in tokens])
    begins = np.zeros(len(ids), bool)
    begins[np.cumsum(length) - length] = True
    inner = ~begins[1:]
    weights, start, moves = np.zeros(FEATURES), 0.0, np.zeros((2, 2))
    memory_w, memory_m, memory_s = np.full(FEATURES, 1e-3), np.full((2, 2), 1e-3), 1e-3
    scale = 1.0 / len(tokens)
    for _ in range(ROUNDS):
        emission = np.bincount(word_of, weights[feature_of], len(words))[ids]
        e, step = np.exp(np.clip(emission, -30, 30)), np.exp(moves)
        forward = _scan(1.0, e, begins, step, float(np.exp(start)))
        back = _scan(1.0, e[::-1], np.r_[begins[1:], True][::-1], step.T, 1.0)[::-1]  # e[t] * b[t]
        odds = forward * back / e
        p = odds / (1 + odds)
        by_word = np.bincount(ids, y - p, len(words))
        gradient = np.bincount(feature_of, by_word[word_of], FEATURES) * scale - 1e-5 * weights
        # pair marginals of neighbours
        f, q = forward[:-1][inner], back[1:][inner]
        joint = np.array([[np.ones(len(f)) * step[0, 0], q * step[0, 1]], [f * step[1, 0], f * q * step[1, 1]]])
        joint /= joint.sum((0, 1))
        u, v = y[:-1][inner], y[1:][inner]
        seen = np.array([[((1 - u) * (1 - v)).sum(), ((1 - u) * v).sum()], [(u * (1 - v)).sum(), (u * v).sum()]])
        move = (seen - joint.sum(2)) * scale - 1e-4 * moves
        at_start = (y[begins] - p[begins]).sum() * scale - 1e-4 * start
        memory_w += gradient**2
        memory_m += move**2
        memory_s += at_start**2
        weights = weights + 0.5 * gradient / np.sqrt(memory_w)
        moves = moves + 0.3 * move / np.sqrt(memory_m)
        start += 0.3 * at_start / memory_s**0.5
    return Chain(weights, start, moves)


def _lexicon(sample: DataFrame) -> dict[str, set[str]]:
    """Words, and starts of words, with strong evidence in toxic documents, counted by distinct contexts."""
    words = F.transform(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " "), lambda x: F.lower(F.regexp_replace(x, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")))
    rows = sample.withColumn("w", words).select("label", "w", F.posexplode("w").alias("i", "word")).filter("word != ''")
    around = F.xxhash64(F.get("w", F.col("i") - 1), F.lit(0), F.get("w", F.col("i") + 1))
    found = write_and_read(rows.select("label", "word", around.alias("around")).distinct(), "toxic-contexts")
    totals = {r.label: r["count"] for r in found.groupBy("label").count().collect()}
    if not totals.get(0) or not totals.get(1):
        return {"words": set(), "starts": set()}  # a class without words tells nothing
    share = totals[1] / (totals[0] + totals[1])
    out = {}
    for kind, key in (("words", F.col("word")), ("starts", F.when(F.char_length("word") >= START - 1, F.substring("word", 1, START)))):
        counted = found.groupBy(key.alias("key")).agg(F.sum(F.col("label")).alias("toxic"), F.count("*").alias("n")).filter("key is not null")
        k, n = F.col("toxic"), F.col("n")
        ratio = 2 * (F.when(k > 0, k * F.log(k / (n * share))).otherwise(0) + F.when(n > k, (n - k) * F.log((n - k) / (n * (1 - share)))).otherwise(0))
        strong = counted.filter((k / n >= 0.9) & (k / n > F.lit(share)) & (ratio >= EVIDENCE))
        # entries with this evidence are bounded by the sample: each needs many contexts of its own
        out[kind] = {r.key for r in strong.select("key").collect()}
    return out


def _sequences(sample: DataFrame, lexicon: dict[str, set[str]]) -> tuple[list, list]:
    words, starts = lexicon["words"], lexicon["starts"]
    schema = "marked boolean, tokens array<string>, marks array<int>"
    fields = pa.schema([("marked", pa.bool_()), ("tokens", pa.list_(pa.string())), ("marks", pa.list_(pa.int32()))])

    def run(batch: pa.RecordBatch):
        columns: dict[str, list] = {"marked": [], "tokens": [], "marks": []}
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            tokens = (text or "").split()
            marks = [int(bool(label) and ((c := core(t)) in words or c[:START] in starts)) for t in tokens]
            for i in range(0, len(tokens), SEQUENCE):
                columns["marked"].append(any(marks[i : i + SEQUENCE]))
                columns["tokens"].append(tokens[i : i + SEQUENCE])
                columns["marks"].append(marks[i : i + SEQUENCE])
        yield arrow_rows(fields, **columns)

    cut = write_and_read(map_texts(sample.select("text", "label"), run, schema).distinct(), "toxic-sequences")
    rows = [r for m in (True, False) for r in cut.filter(F.col("marked") == m).orderBy(F.xxhash64("tokens"), "tokens").limit(SEQUENCES).collect()]
    return [r.tokens for r in rows], [r.marks for r in rows]


def document_features(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Per text: log of the expected offending tokens, logit of the largest marginal, log density; ``size``: tokens per text."""
    filled = size > 0
    total, most = np.zeros(len(size)), np.zeros(len(size))
    if len(p):
        starts = (np.cumsum(size) - size)[filled]
        total[filled], most[filled] = np.add.reduceat(p, starts), np.maximum.reduceat(p, starts)
    m = np.clip(most, 1e-4, 1 - 1e-4)
    return np.stack([np.log(total + 1e-3), np.log(m / (1 - m)), np.log(total / np.maximum(size, 1) + 1e-4)], 1)


class Tagger:
    """Emissions of tokens, remembered by one Python worker."""

    def __init__(self, chain: Chain):
        self.chain, self.weights, self.known = chain, chain.weights.tolist(), Cache(CACHED_TOKENS)

    def emission(self, token: str) -> float:
        value = self.known.get(token)
        if value is None:
            value = self.known.put(token, sum([self.weights[f] for f in features(token)]))
        return value

    def tag(self, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """Tokens of each text, their number, and the marginals laid end to end."""
        tokens = [(t or "").split() for t in texts]
        size = np.array([len(t) for t in tokens])
        slow, values = self.emission, []
        for own in tokens:
            young = self.known.young
            values += [young[t] if t in young else slow(t) for t in own]
        begins = np.zeros(len(values), bool)
        begins[(np.cumsum(size) - size)[size > 0]] = True
        return tokens, size, marginals(np.array(values, float), begins, self.chain)


def digest(model) -> str:
    return hashlib.sha256(pickle.dumps(model)).hexdigest()


def tagger(key: str, chain: Chain) -> Tagger:
    """One per Python worker and model."""
    return kept(("tagger", key), lambda: Tagger(chain))


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", skip: Column | None = None, id_column: str = "doc_id", text: str = "text", per_class: int = PER_CLASS) -> Model:
    """``skip``: condition on the labels' id; those rows are never learned from."""
    none = F.lit(False) if skip is None else skip
    sample = write_and_read(labelled_sample(documents, labels, label, per_class, none, id_column, text), "toxic-sample")
    known = labels.filter(F.col(label).isin(0, 1) & ~none).groupBy(F.col(label).cast("int").alias("k")).count()
    shares = {r.k: r["count"] for r in known.collect()}
    flat = Model(None, (float(np.log((shares.get(1, 0) + 0.5) / (shares.get(0, 0) + 0.5))),))
    found = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(found) < 2:
        return flat
    half = F.pmod(F.xxhash64(F.lit("half"), id_column), F.lit(2))
    lexicon = _lexicon(sample)
    tokens, marks = _sequences(sample.filter(half == 0), lexicon)
    if not any(map(any, marks)):
        return flat
    chain = train_chain(tokens, marks)
    sent = documents.sparkSession.sparkContext.broadcast(chain)
    key = digest(chain)

    def run(batch: pa.RecordBatch):
        _, size, p = tagger(key, sent.value).tag(batch.column("text").to_pylist())
        yield arrow_rows(pa.schema([("label", pa.int32()), ("x", pa.list_(pa.float64()))]), label=batch.column("label"), x=document_features(p, size).tolist())

    rows = map_texts(sample.filter(half == 1).select("text", F.col("label").cast("int")), run, "label int, x array<double>").collect()
    x, y = np.array([r.x for r in rows]), np.array([r.label for r in rows], float)
    if len(set(y)) < 2:
        return flat
    curve = fit_logistic(x, y, ridge=0.1)
    curve[-1] += np.log(shares[1] / shares[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return Model(chain, tuple(curve.tolist()))


def offsets(text: str, tokens: list[str], marked: np.ndarray) -> list[tuple[int, int]]:
    """Character spans of the marked tokens; neighbours are joined."""
    spans: list[tuple[int, int]] = []
    at, before = 0, -2
    for i, token in enumerate(tokens):
        at = text.index(token, at)
        if marked[i]:
            if before == i - 1:
                spans[-1] = (spans[-1][0], at + len(token))
            else:
                spans.append((at, at + len(token)))
            before = i
        at += len(token)
    return spans


def score(documents: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """id → score, predicted, starts and ends of offending passages; with ``keep``: those columns, and the others' names begin with _toxic_."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    key = digest(model)
    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")) if keep is None else documents.select(*keep)
    names, shown = (["doc_id"], "text") if keep is None else (keep, text)
    mark = "" if keep is None else "_toxic_"  # cannot clash with the columns kept
    added = [(mark + "score", pa.float64()), (mark + "predicted", pa.int32()), (mark + "span_starts", pa.list_(pa.int64())), (mark + "span_ends", pa.list_(pa.int64()))]

    def run(batch: pa.RecordBatch):
        own, texts = sent.value, batch.column(shown).to_pylist()
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        if own.chain is None:
            out = np.full(len(texts), sigmoid(own.curve[-1]))
        else:
            tokens, size, p = tagger(key, own.chain).tag(texts)
            out = sigmoid(document_features(p, size) @ np.array(own.curve[:-1]) + own.curve[-1])
            ends = np.cumsum(size)
            bad = p >= 0.5
            for i in np.unique(np.searchsorted(ends, np.flatnonzero(bad), side="right")):
                spans[i] = offsets(texts[i], tokens[i], bad[ends[i] - size[i] : ends[i]])
        schema = pa.schema([batch.schema.field(n) for n in names] + added)
        yield arrow_rows(
            schema,
            **dict(zip([n for n, _ in added], (out, (out >= threshold).astype(np.int32), [[a for a, _ in s] for s in spans], [[b for _, b in s] for s in spans]))),
            **{n: batch.column(n) for n in names},
        )

    types = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)
    return map_texts(rows, run, types + f", {mark}score double, {mark}predicted int, {mark}span_starts array<long>, {mark}span_ends array<long>")
