"""Near copies among embeddings by product quantisation.

A bounded sample gives coarse centres and, for the residuals, a codebook per subspace; every
vector is then put into the inverted list of its nearest centre, with the codes of its residual and
the length of what the codes leave out. A list is searched by its own vectors and by those
that have its centre among their ``PROBES`` nearest: a table of squared distances from the query's
residual to all codewords is looked up per code (asymmetric distance). A vector is a candidate if the
distance to its codes is at most the wanted one plus what its codes leave out, which loses no
pair inside a list; candidates are compared by cosine in double precision.

Equal vectors are one node. A list above ``LIST`` vectors is cut into blocks, and queries into
blocks as well, so a task holds two blocks. A task returns per node the weight of its links and
its component inside the task, never the pairs. The probes decide on the recall, which the tests
measure against brute force.

Defined cases. A vector that is null, empty or zero, or holds null or non-finite components, and one with a
null label, links with nothing: n_links 0, its own component. Vectors are compared only with
those of the same label and length. Rows that repeat are vectors of their own. A null id has
a component but does not name one, and is kept. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tributary.llm.common import arrow_rows
from tributary.llm.components import components
from tributary.storage import write_and_read

COSINE = 0.98
SAMPLE = 20_000  # vectors that centres and codebooks are fitted on
SAMPLE_VALUES = 4_000_000  # numbers in that sample, whatever the vectors' length
CENTRES = 1024  # at most
PROBES = 4
CODEWORDS = 64
WIDTH = 8  # dimensions of a subspace
LIST = 4096  # vectors of a block
ROUNDS = 8  # of k-means


@dataclass(frozen=True)
class Index:
    centres: np.ndarray
    books: list[np.ndarray]  # per subspace: codewords
    cuts: list[int]


def unit(vectors: np.ndarray) -> np.ndarray:
    top = np.abs(vectors).max(1, keepdims=True)
    scaled = vectors / top
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]]
    for _ in range(ROUNDS):
        near = np.concatenate([squared(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        count = np.bincount(near, minlength=len(centres))
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def train(sample: np.ndarray, centres: int) -> Index:
    coarse = k_means(sample, max(1, min(centres, len(sample))), 1)
    rest = sample - coarse[squared(sample, coarse).argmin(1)]
    cuts = [*range(0, sample.shape[1], WIDTH), sample.shape[1]]
    return Index(coarse, [k_means(rest[:, a:b], min(CODEWORDS, len(sample)), 2) for a, b in zip(cuts, cuts[1:])], cuts)


def encode(x: np.ndarray, index: Index, visits: int = PROBES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centres (home first), codes of the residual, length of what the codes leave out."""
    far = squared(x, index.centres)
    probes = np.argsort(far, axis=1, kind="stable")[:, :visits].astype(np.int32)
    rest = x - index.centres[probes[:, 0]]
    codes = np.stack([squared(rest[:, a:b], book).argmin(1) for a, b, book in zip(index.cuts, index.cuts[1:], index.books)], 1).astype(np.uint8)
    for m, (a, b) in enumerate(zip(index.cuts, index.cuts[1:])):
        rest[:, a:b] -= index.books[m][codes[:, m]]
    return probes, codes, np.sqrt((rest * rest).sum(1))


def list_links(index: Index, centre: int, queries: dict, targets: dict, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of one list: weight per query and per target, and a forest as (smaller, larger) node pairs.

    A pair of this list's own vectors counts once, by node; a visitor counts unless its partner
    also visits the visitor's home and that list has the smaller number.
    """
    reach = np.sqrt(2 - 2 * least)
    q_links, t_links = np.zeros(len(queries["node"]), np.int64), np.zeros(len(targets["node"]), np.int64)
    names, inverse = np.unique(np.concatenate([queries["node"], targets["node"]]), return_inverse=True)
    label = np.arange(len(names))
    q_at, t_at = inverse[: len(q_links)], inverse[len(q_links) :]
    for start in range(0, len(q_links), 256):
        x = queries["x"][start : start + 256]
        rest = x - index.centres[centre]
        far = np.zeros((len(x), len(t_links)))
        for m, (a, b) in enumerate(zip(index.cuts, index.cuts[1:])):
            far += squared(rest[:, a:b], index.books[m])[:, targets["codes"][:, m]]
        i, j = np.nonzero(np.sqrt(far) <= reach + targets["error"][None] + 1e-6)
        home, node = queries["probes"][start + i, 0], queries["node"][start + i]
        own = home == centre
        both = (targets["probes"][j] == home[:, None]).any(1)
        wanted = np.where(own, node < targets["node"][j], ~both | (centre < home))
        i, j = i[wanted], j[wanted]
        hit = np.concatenate([np.einsum("nd,nd->n", x[i[k : k + 65536]], targets["x"][j[k : k + 65536]]) >= least for k in range(0, len(i), 65536)] or [np.zeros(0, bool)])
        i, j = i[hit] + start, j[hit]
        np.add.at(q_links, i, targets["mult"][j])
        np.add.at(t_links, j, queries["mult"][i])
        a, b = q_at[i], t_at[j]
        while len(a):
            low = np.minimum(label[a], label[b])
            moved = (label[a] != low) | (label[b] != low)
            if not moved.any():
                break
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            label = label[label]
    while (label[label] != label).any():
        label = label[label]
    hung = np.flatnonzero(label != np.arange(len(names)))
    return q_links, t_links, np.stack([names[label[hung]], names[hung]], 1) if len(hung) else np.empty((0, 2), np.int64)


def nodes_of(embeddings: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """Rows with ``node``: a 64-bit name of label, length and vector; null for vectors that cannot link."""
    own = F.transform(F.col(vector), lambda x: x.cast("double") + 0.0)
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0) & F.col("g").isNotNull()
    rows = embeddings.select(F.col(id_column).alias("vec_id"), F.col(label).alias("g"), own.alias("v"))
    return rows.withColumn("node", F.when(F.coalesce(fine, F.lit(False)), F.xxhash64("g", F.size("v"), "v")))


def near_copies(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = COSINE, probes: int = PROBES, centres: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept, one row per vector; ``centres``: number of inverted lists, else by the number of vectors."""
    rows = nodes_of(embeddings, id_column, vector, label)
    spark = embeddings.sparkSession
    nodes = write_and_read(
        rows.filter("node is not null").groupBy("node").agg(F.min("vec_id").alias("first"), F.count("*").alias("mult"), F.first("g").alias("g"), F.first("v").alias("v")), "vector-nodes"
    )
    found, edges = [], []
    for width, count in sorted((r.w, r["count"]) for r in nodes.groupBy(F.size("v").alias("w")).count().collect()):  # vectors have one length, or a few
        out = write_and_read(_links(spark, nodes.filter(F.size("v") == width), count, width, least, probes, centres), "vector-links")
        found.append(out.filter("other is null").select("node", "links"))
        edges.append(out.filter("other is not null").select("node", "other"))
    if not found:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    for more in (found, edges):
        while len(more) > 1:
            more[0] = more[0].unionAll(more.pop())
    links = found[0].groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(edges[0], "node", "other")
    placed = nodes.select("node", "first", "mult").join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least_id = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = placed.join(least_id, "root").select(F.col("node").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n"), "component_id")
    joined = rows.select("vec_id", "node").join(classes, F.col("node") == F.col("c"), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")
    )


def _links(spark, nodes: DataFrame, count: int, width: int, least: float, visits: int, centres: int | None) -> DataFrame:
    """Per task: (node, links) and, with ``other``, a forest of the links."""
    size = max(1, min(SAMPLE, SAMPLE_VALUES // width))
    sample = np.array([r.v for r in nodes.orderBy(F.xxhash64("node", F.lit("sample")), "node").limit(size).select("v").collect()], float)
    index = train(unit(sample), centres or int(min(CENTRES, max(1, round(count**0.5 / 8)))))
    sent = spark.sparkContext.broadcast(index)
    kind = nodes.schema["g"].dataType.simpleString()

    def put(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(batch.column("v").values.to_numpy().reshape(-1, width)[: batch.num_rows] if batch.column("v").offset == 0 else np.array(batch.column("v").to_pylist()))
            near, codes, error = encode(x, sent.value, visits)
            schema = pa.schema([
                batch.schema.field("node"), batch.schema.field("mult"), batch.schema.field("g"), ("probes", pa.list_(pa.int32())), ("codes", pa.binary()), ("error", pa.float64()), ("x", pa.binary()),
            ])
            yield arrow_rows(
                schema, node=batch.column("node"), mult=batch.column("mult"), g=batch.column("g"), probes=near.tolist(), codes=[c.tobytes() for c in codes], error=error, x=[v.tobytes() for v in x]
            )

    coded = write_and_read(nodes.select("node", "mult", "g", "v").mapInArrow(put, f"node long, mult long, g {kind}, probes array<int>, codes binary, error double, x binary"), "vector-codes")
    home = F.get("probes", F.lit(0))
    sizes = coded.groupBy("g", home.alias("cell")).agg(F.ceil(F.count("*") / LIST).cast("int").alias("targets"))
    visits = coded.select("g", F.explode("probes").alias("cell")).groupBy("g", "cell").agg(F.ceil(F.count("*") / LIST).cast("int").alias("queries"))
    lists = sizes.join(visits, ["g", "cell"])
    rows = coded.withColumn("cell", F.explode("probes")).join(lists, ["g", "cell"])
    turn = lambda n: F.sequence(F.lit(0), n - 1)
    block = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    as_query = rows.select("*", F.lit(True).alias("query"), F.explode(turn(F.col("targets"))).alias("t"), block(F.col("queries")).alias("q"))
    as_target = rows.filter(F.col("cell") == home).select("*", F.lit(False).alias("query"), block(F.col("targets")).alias("t"), F.explode(turn(F.col("queries"))).alias("q"))
    placed = as_query.unionByName(as_target)

    def search(key, table):
        own = sent.value
        sides = []
        for flag in (True, False):
            part = table.filter(pa.compute.equal(table.column("query"), flag))
            n = part.num_rows
            near = np.array(part.column("probes").to_pylist(), np.int32).reshape(n, -1)
            sides.append({
                "node": part.column("node").to_numpy(), "mult": part.column("mult").to_numpy(), "probes": near, "error": part.column("error").to_numpy(),
                "codes": np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8).reshape(n, -1), "x": np.frombuffer(b"".join(part.column("x").to_pylist())).reshape(n, width),
            })
        q, t, pairs = list_links(own, key[1].as_py(), *sides, least)
        node = np.concatenate([sides[0]["node"][q > 0], sides[1]["node"][t > 0], pairs[:, 1]])
        links = np.concatenate([q[q > 0], t[t > 0], np.zeros(len(pairs), np.int64)])
        other = pa.array(np.concatenate([np.zeros((q > 0).sum() + (t > 0).sum(), np.int64), pairs[:, 0]]), pa.int64(), mask=np.r_[np.ones((q > 0).sum() + (t > 0).sum(), bool), np.zeros(len(pairs), bool)])
        return pa.table({"node": pa.array(node, pa.int64()), "links": pa.array(links, pa.int64()), "other": other})

    return placed.groupBy("g", "cell", "t", "q").applyInArrow(search, "node long, links long, other long")
