"""Exact similarity join on sets of word n-grams, with skipping between related sets.

Two sets link when 100 * intersection >= 80 * union.

1. Equal sets are one class. Each set's n-grams are put in one order over the corpus (common ones
   last, else by hash). Sets that link share k of the first n - ceil(0.8 n) + k, whatever k; it is a
   tenth of the size here. Index lists are made of these starts, and sets leave that share fewer than k with all others.
2. Sets in one index list whose sizes allow a link are joined into bundles: connected components
   of neighbours in the lists ordered by size. Every link lies inside a bundle.
3. Inside a bundle index lists are ordered by size, and a set reads only the blocks whose sizes allow a link.
   A set that links with one whose overlaps are known gets its own from them: only the lists
   of the n-grams that one set has and the other lacks are read.

Each set is shuffled once, and only if it is in a bundle. A bundle above ``TASK`` n-grams is cut
into pools by size, these into blocks by hash, and every pair of blocks of a pool is a task of its own.

Defined cases. Null and empty texts, and texts without words, have the empty set, which links with
nothing. Fewer words than the n-gram are one n-gram. Rows that repeat an id are documents of their own;
a null id has a component but does not name one. Equal texts link (unless empty). N-grams are
compared by 64-bit hashes. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tributary.llm.common import WordHashes, arrow_rows, byte_words, grams, map_texts, mix, signed
from tributary.llm.components import components
from tributary.llm.substrings import packed, unpacked
from tributary.storage import write_and_read

SIZE = 5  # words of an n-gram
NUMBER, PER = 4, 5  # similarity 0.8
SHARED = 10  # of so many n-grams of a set, linked sets share one more in their starts
ROUNDS = 2  # of leaving out sets that share too little; more only save work
COMMON = 500  # an n-gram in one of so many documents is common: it goes last in the order
SEEN = 3  # documents of a batch that share an n-gram before the batch reports it
TASK = 3_000_000  # n-grams of a block
SET_COST = 200  # a set counts as so many n-grams more


def ngram_set(data: bytes, table: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text in lower case (A-Z)."""
    hashes = table.of(data.lower().split())
    if not len(hashes):
        return hashes
    found = grams(hashes, 1, min(size, len(hashes)))
    return np.unique(mix(found + np.uint64(min(size, len(hashes)))))


def set_key(found: np.ndarray) -> int:
    """64-bit name of a set."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix(found * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)), dtype=np.uint64)
        return int(signed(mix(np.array([total + np.uint64(len(found)) * np.uint64(0xC2B2AE3D27D4EB4F)], np.uint64)))[0])


def shared_least(n):
    """How many n-grams two linked sets share in their starts, at least, for the smaller set's size n."""
    return -(-n // SHARED)


def prefix_length(n: int) -> int:
    return n - -(-NUMBER * n // PER) + shared_least(n)


@dataclass
class Join:
    documents: DataFrame  # one row per document: doc_id, k, n_shingles, key
    classes: DataFrame  # one row per distinct set: key, n_links of its documents, component_id, representative


def _facts(rows: DataFrame, size: int) -> DataFrame:
    """Per document its set's size and key; per batch its common n-grams (rows without k)."""
    table = WordHashes()

    def run(batch: pa.RecordBatch):
        sets = [ngram_set((t or "").encode("utf-8", "surrogatepass"), table, size) for t in batch.column("text").to_pylist()]
        seen, counts = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_counts=True)
        often = counts >= SEEN
        schema = pa.schema([batch.schema.field("doc_id"), ("k", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("grams", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
        none = [None] * len(sets)
        ids = pa.concat_arrays([batch.column("doc_id"), pa.nulls(1, batch.schema.field("doc_id").type)])
        yield arrow_rows(
            schema, doc_id=ids, k=[*batch.column("k").to_pylist(), None], n=[*map(len, sets), None], key=[*map(set_key, sets), None],
            grams=[*none, signed(seen[often])], counts=[*none, counts[often]],
        )

    return map_texts(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, k long, n long, key long, grams array<long>, counts array<long>")


def _common(facts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Common n-grams and their counts. At most COMMON times the mean set size can be, whatever the corpus holds."""
    least = facts.filter("n is not null").count() / COMMON
    pairs = facts.filter("n is null").select(F.explode(F.arrays_zip("grams", "counts")).alias("x")).select("x.*")
    found = pairs.groupBy("grams").agg(F.sum("counts").alias("n")).filter(F.col("n") >= max(least, SEEN)).collect()
    order = sorted((r.grams % (1 << 64), r.n) for r in found)
    return np.array([a for a, _ in order], np.uint64), np.array([b for _, b in order], np.int64)


def _starts(rows: DataFrame, size: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(gram, key, n): the start of each distinct set of a batch."""
    sent = rows.sparkSession.sparkContext.broadcast(common)
    table = WordHashes()

    def prefix(found: np.ndarray) -> np.ndarray:
        names, counts = sent.value
        if len(names):
            at = np.minimum(np.searchsorted(names, found), len(names) - 1)
            often = np.where(names[at] == found, counts[at], 0)
            if often.any():
                found = found[np.lexsort((found, often))]
        return found[: prefix_length(len(found))]

    def run(batch: pa.RecordBatch):
        sets = {}
        for text in batch.column("text").to_pylist():
            found = ngram_set((text or "").encode("utf-8", "surrogatepass"), table, size)
            if len(found):
                sets.setdefault(set_key(found), found)
        if sets:
            starts = [prefix(s) for s in sets.values()]
            count = np.array([len(p) for p in starts])
            schema = pa.schema([("gram", pa.int64()), ("key", pa.int64()), ("n", pa.int32())])
            # a set's rows follow one another, which compresses well in the shuffle
            yield arrow_rows(schema, gram=signed(np.concatenate(starts)), key=np.repeat(np.array(list(sets), np.int64), count), n=np.repeat(np.array([len(s) for s in sets.values()], np.int32), count))

    return map_texts(rows.select("text"), run, "gram long, key long, n int")


def _shared(rows: DataFrame) -> DataFrame:
    """Rows, once each, whose n-gram starts another set, too."""
    of_gram = Window.partitionBy("gram")
    several = rows.withColumn("several", F.min("key").over(of_gram) != F.max("key").over(of_gram))
    return several.filter("several").groupBy("gram", "key", "n").agg(F.lit(0).alias("_")).drop("_")


def _edges(rows: DataFrame, size: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Pairs of set keys (a, b) that join the sets of each index list whose sizes allow a link.

    Before that, sets go that share too little of their start with all others together: the
    passage that many texts quote does not make them candidates.
    """
    smaller = F.ceil(F.col("n") * NUMBER / PER)
    live = write_and_read(_shared(_starts(rows, size, common)), "jaccard-lists")
    for _ in range(ROUNDS):
        enough = live.groupBy("key", "n").agg(F.count("*").alias("shared")).filter(F.col("shared") >= F.ceil(smaller / SHARED))
        live = write_and_read(_shared(live.join(enough.select("key"), "key", "left_semi")), "jaccard-lists")
    before = Window.partitionBy("gram").orderBy("n", "key")
    found = live.select(F.col("key").alias("a"), "n", F.lag("key").over(before).alias("b"), F.lag("n").over(before).alias("m"))
    return found.filter(F.col("n") * NUMBER <= F.col("m") * PER).select("a", "b").distinct()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of all the given slices, one after another."""
    total = int(sizes.sum())
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


class Bundle:
    """Links among the sets of one task.

    Sets are numbered by size; ``lists`` holds (n-gram, set) in order, so the part of a list that a
    set can link with is found by two searches and all else is skipped.
    """

    def __init__(self, sets: list[np.ndarray], weight: np.ndarray, side: np.ndarray | None = None, upper: np.ndarray | None = None):
        self.n = np.array([len(s) for s in sets])
        order = np.argsort(self.n, kind="stable")
        self.order, self.n, self.weight = order, self.n[order], weight[order]
        self.side = None if side is None else side[order]
        self.upper = None if upper is None or not upper.any() else upper[order]
        count = len(sets)
        ids = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)[1]
        owner = np.repeat(np.arange(count, dtype=np.int32), self.n)
        shared = np.bincount(ids)[ids] > 1  # an n-gram of one set overlaps with nothing
        ids, owner = ids[shared], owner[shared]
        self.bounds = np.searchsorted(owner, np.arange(count + 1))
        self.ids = ids
        self.lists = ids * count + owner
        self.lists.sort()
        self.count = count

    def grams_of(self, x: int) -> np.ndarray:
        return self.ids[self.bounds[x] : self.bounds[x + 1]]

    def read(self, ids: np.ndarray, low: int, high: int) -> np.ndarray:
        """How many of the n-grams each set from ``low`` to ``high`` has."""
        starts = np.searchsorted(self.lists, ids * self.count + low)
        sizes = np.searchsorted(self.lists, ids * self.count + high) - starts
        return np.bincount(self.lists[_ranges(starts, sizes)] % self.count, minlength=self.count)

    def sizes(self, low: float, high: float) -> tuple[int, int]:
        return int(np.searchsorted(self.n, math.ceil(low))), int(np.searchsorted(self.n, math.floor(high), side="right"))

    def linked(self, x: int, overlap: np.ndarray) -> np.ndarray:
        hit = overlap * (NUMBER + PER) >= NUMBER * (self.n + self.n[x])
        hit[x] = False
        if self.side is not None:
            hit &= self.side != self.side[x]
        if self.upper is not None and self.upper[x]:
            hit &= ~self.upper
        return np.flatnonzero(hit)

    def solve(self) -> tuple[np.ndarray, np.ndarray]:
        """For each set, in the order given: weight of its links, and the number of the first set of its component here."""
        links, label, answered = np.zeros(self.count, np.int64), np.arange(self.count), np.zeros(self.count, bool)

        def answer(x: int, found: np.ndarray) -> None:
            answered[x] = True
            if len(found):
                links[x] = self.weight[found].sum()
                met = np.unique(label[np.append(found, x)])
                if len(met) > 1:
                    label[np.isin(label, met)] = met[0]

        for x in range(self.count):
            if answered[x]:
                continue
            mine = self.grams_of(x)
            # wide enough for those that link with this set, too
            wide = self.sizes(self.n[x] * (NUMBER / PER) ** 2 - 1e-6, self.n[x] * (PER / NUMBER) ** 2 + 1e-6)
            known = self.read(mine, *wide)
            found = self.linked(x, known)
            answer(x, found)
            similar = np.flatnonzero(known * (NUMBER + PER) >= NUMBER * (self.n + self.n[x])) if self.side is not None or self.upper is not None else found
            for y in similar[~answered[similar]].tolist():
                if answered[y]:
                    continue
                own = self.grams_of(y)
                span = self.sizes(self.n[y] * NUMBER / PER - 1e-6, self.n[y] * PER / NUMBER + 1e-6)
                more, less = np.setdiff1d(own, mine, assume_unique=True), np.setdiff1d(mine, own, assume_unique=True)
                overlap = known + self.read(more, *span) - self.read(less, *span)
                overlap[: span[0]] = 0
                overlap[span[1] :] = 0
                answer(y, self.linked(y, overlap))
        out_links, out_label = np.empty_like(links), np.empty_like(label)
        out_links[self.order], out_label[self.order] = links, self.order[label]
        return out_links, out_label


def _tasks(members: DataFrame) -> DataFrame:
    """Give each member (key, bundle, n, …) its tasks.

    A large bundle is cut into size classes; a pool holds one class and the next, as links reach no
    farther. Pairs ``upper`` on both sides belong to the next pool. Pools that are still too
    large are cut by hash into blocks; ``side`` tells the two blocks of a task apart (null: one block).
    """
    cost = F.col("n") + SET_COST
    size_class = F.floor(F.log(F.col("n").cast("double")) / math.log(PER / NUMBER)).cast("int")
    sums = members.groupBy("bundle", size_class.alias("s")).agg(F.sum(cost).alias("c"))
    costs = sums.groupBy("bundle").agg(F.sum("c").alias("total"), F.map_from_entries(F.collect_list(F.struct("s", "c"))).alias("costs"))  # one entry per size class
    rows = members.withColumn("s", size_class).join(costs.withColumnRenamed("bundle", "_b"), F.col("bundle") == F.col("_b"))
    of = lambda s: F.coalesce(F.col("costs")[s], F.lit(0))
    pool = lambda s, upper: F.struct(s.alias("s"), F.lit(upper).alias("upper"), F.ceil((of(s) + of(s + 1)) / TASK).cast("int").alias("blocks"))
    whole = F.array(F.struct(F.lit(-1).alias("s"), F.lit(False).alias("upper"), F.lit(1).alias("blocks")))
    below = F.when(of(F.col("s") - 1) > 0, F.array(pool(F.col("s"), False), pool(F.col("s") - 1, True))).otherwise(F.array(pool(F.col("s"), False)))
    rows = rows.withColumn("pool", F.explode(F.when(F.col("total") <= TASK, whole).otherwise(below)))
    rows = rows.withColumn("i", F.pmod(F.xxhash64("key"), F.col("pool.blocks")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("pool.blocks") - 1)))
    task = F.xxhash64("bundle", "pool.s", F.least("i", "j"), F.greatest("i", "j"))
    side = F.when(F.col("i") != F.col("j"), (F.col("i") > F.col("j")).cast("int"))
    return rows.select("key", "rep", "mult", task.alias("task"), side.alias("side"), "pool.upper")


def _sets(rows: DataFrame, tasks: DataFrame) -> DataFrame:
    """The representatives' compressed texts, sent to their tasks: smaller than the sets they are made into there."""
    wanted = tasks.withColumns({"d": F.col("rep.doc_id"), "kk": F.col("rep.k")}).drop("rep")
    found = packed(rows).join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("kk")))
    return found.select("task", "side", "upper", "key", "mult", "packed")


def _solve(sets: DataFrame, size: int) -> DataFrame:
    """(key, links, root) per task."""
    parts = sets.repartition("task").sortWithinPartitions("task")
    schema = pa.schema([("key", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    table = WordHashes()

    def solved(rows: dict):
        if len(rows) < 2:
            return
        keys = np.array(list(rows), np.int64)
        mult, side, upper, sets = zip(*rows.values())
        links, label = Bundle(list(sets), np.array(mult), None if side[0] is None else np.array(side), np.array(upper)).solve()
        some = links > 0
        if some.any():
            yield keys[some], links[some], keys[label[some]]

    def run(batches):
        task, rows, out = None, {}, []
        for batch in batches:
            for t, key, mult, side, upper, blob in zip(*(batch.column(c).to_pylist() for c in ("task", "key", "mult", "side", "upper", "packed"))):
                if t != task:
                    out += solved(rows)
                    task, rows = t, {}
                found = ngram_set(unpacked(blob), table, size)
                if set_key(found) == key:  # not another text with the same id
                    rows[key] = (mult, side, upper, found)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], schema=schema)
                out = []
        out += solved(rows)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], schema=schema)

    return parts.mapInArrow(run, "key long, links long, root long")


def join(documents: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SIZE) -> Join:
    """All links between documents, as classes of equal sets with their number of links and component."""
    rows = documents.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("k"), F.col(text).alias("text"))
    facts = write_and_read(_facts(rows, size), "jaccard-facts")
    own = facts.filter("n is not null").select("doc_id", "k", F.col("n").alias("n_shingles"), "key")
    classes = write_and_read(
        own.filter("n_shingles > 0").groupBy("key", F.col("n_shingles").alias("n")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")).alias("rep"), F.count("*").alias("mult")),
        "jaccard-classes",
    )
    bundles = components(_edges(rows, size, _common(facts)))
    members = classes.join(bundles.select(F.col("node").alias("key"), F.col("root").alias("bundle")), "key")
    tasks = write_and_read(_tasks(members), "jaccard-tasks")
    found = write_and_read(_solve(_sets(rows, tasks), size), "jaccard-links")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found, "key", "root").select(F.col("node").alias("key"), "root")
    placed = classes.join(links, "key", "left").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = placed.groupBy("root").agg(F.min("rep.doc_id").alias("component_id"), F.min_by("key", "rep").alias("first"))
    done = placed.join(least, "root").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "component_id", (F.col("key") == F.col("first")).alias("is_first"), "rep"
    )
    return Join(own, write_and_read(done, "jaccard-done"))


def linked_documents(result: Join) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links, one row per document."""
    classes = result.classes.select(F.col("key").alias("c"), "n_links", "component_id")
    own = result.documents.withColumn("at", F.when(F.col("n_shingles") > 0, F.col("key")))
    joined = own.join(classes, F.col("at") == F.col("c"), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(documents: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest id (null last) stays.

    Empty sets all stay. Of rows equal in id and text one stays; columns are kept as they are.
    """
    result = join(documents, id_column, text, size)
    first = result.classes.filter("is_first").select(F.col("rep.doc_id").alias("_d"), F.col("rep.k").alias("_k")).distinct()
    empty = result.documents.filter("n_shingles = 0").select(F.col("doc_id").alias("_d"), F.col("k").alias("_k")).distinct()
    keep = first.withColumn("_empty", F.lit(False)).unionByName(empty.withColumn("_empty", F.lit(True)))
    rows = documents.withColumn("_at", F.xxhash64(text)).withColumn("_key", F.xxhash64(id_column, "_at"))
    keep = keep.withColumn("_key2", F.xxhash64("_d", "_k"))
    same = (F.col("_key") == F.col("_key2")) & F.col(id_column).eqNullSafe(F.col("_d")) & (F.col("_at") == F.col("_k"))
    # each empty row is a group of its own; of the others one per id and text is left before the shuffle
    own = F.when(F.col("_empty"), F.monotonically_increasing_id())
    nth = F.row_number().over(Window.partitionBy("_key", "_d", "_k", own).orderBy("_key"))
    return rows.join(keep, same).withColumn("_nth", nth).filter("_nth = 1").select(*[rows[c] for c in documents.columns])
