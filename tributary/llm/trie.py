"""Prefix trie of rebuilt conversations, packed as double arrays.

Every conversation is rebuilt: it takes the first turns of a donor conversation in place of its own
first ones. Distinct turn sequences are ranged by their turn hashes, so a shard holds conversations
that share prefixes and even the most common prefix is cut at a deeper turn. A shard numbers its turns
densely, packs BASE and CHECK arrays over these numbers, finds every node by traversing them, and sums
each node's subtree. Only the nodes on the first and the last path of a double array can also lie in
others: their sums are merged by node id, and carried to their ancestors along one member's path.

Bounds. A double array holds CHUNK turns; a shard of any size is a row of them. A conversation longer
than PIECE turns is cut into levels, computed from the deepest up, and a level's sums enter its last node.
Equal conversations meet as one row per BLOCK of ids before the shuffle; only the SHA-256 over all ids that
end at one node, sequential by nature, is fed by one task, in id order and without holding them.

Defined cases. Turns are ordered by ``turn`` (null first), then role, then hash of role and text; repeated
rows are turns of their own. A null role or text is empty. Rows without an id belong to no conversation.
A turn of any length is one hash of 128 bits. No conversations give no node; a conversation without
turns ends at the root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tributary.llm.common import mix, signed, word_count
from tributary.llm.turns import placed, slice_of
from tributary.storage import write_and_read

PIECE = 4096  # turns of a conversation in one level
CHUNK = 200_000  # turns in one double array
BLOCK = 4096  # ids in one row of equal conversations
EMPTY = hashlib.sha256(b"").hexdigest()
TURN = "array<struct<t1:bigint,t2:bigint,words:bigint>>"


def rebuild(turns: DataFrame, id_column: str, family: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """(conv, place, t1, t2, words of rebuilt turns; conv, total per conversation).

    Conversation c takes the first h turns of conversation ``c - c % family``, h = crc32 of its decimal id
    modulo ``heads``, then its own turns after its first h.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    own = turns.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("conv"),
        slice_of(),
        "turn",
        role.alias("role"),
        *[F.xxhash64(F.lit(seed), F.length(role), role, text).alias(n) for seed, n in ((1, "t1"), (2, "t2"))],
        word_count(text).alias("words"),
    )
    numbered, slices = placed(own, ["turn", "role", "t1", "t2"])
    sizes = slices.groupBy("conv").agg(F.sum("rows").alias("own"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    donors = sizes.select(F.col("conv").alias("donor"), F.col("own").alias("given"))
    convs = sizes.select("conv", "own", h.alias("h"), (F.col("conv") - F.col("conv") % family).alias("donor")).join(donors, "donor", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("given", F.lit(0)))).withColumn("total", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = write_and_read(convs.select("conv", "donor", "h", "taken", "total"), "trie-conversations")
    info = slices.select("conv", "slice", "start").join(convs.select("conv", "h", "taken"), "conv")
    rows = numbered.join(info, ["conv", "slice"]).select("conv", (F.col("n") + F.col("start")).alias("at"), "h", "taken", "t1", "t2", "words")
    rows = write_and_read(rows, "trie-turns")
    given = rows.filter((F.col("at") < heads) & (F.col("conv") % family == 0)).select(F.col("conv").alias("donor"), F.col("at").alias("place"), "t1", "t2", "words")
    taken = convs.filter("taken > 0").join(given, "donor").filter("place <= taken").select("conv", "place", "t1", "t2", "words")
    kept = rows.filter("at > h").select("conv", (F.col("at") - F.col("h") + F.col("taken")).alias("place"), "t1", "t2", "words")
    return taken.unionByName(kept), convs.select("conv", "total")


def sequences(rows: DataFrame, convs: DataFrame, levels: int) -> DataFrame:
    """One row per conversation and level: conv, level, p1, p2 (hash of the levels before), turns, more, e1, e2."""
    pieces = rows.groupBy("conv", F.floor((F.col("place") - 1) / PIECE).cast("int").alias("level")).agg(F.sort_array(F.collect_list(F.struct("place", "t1", "t2", "words"))).alias("turns"))
    pieces = pieces.withColumn("turns", F.transform("turns", lambda t: F.struct(t["t1"], t["t2"], t["words"])).cast(TURN))
    pieces = pieces.unionByName(convs.filter("total = 0").select("conv", F.lit(0).alias("level"), F.array().cast(TURN).alias("turns")))
    if levels == 1:
        return pieces.select("conv", "level", *[F.lit(0).cast("long").alias(p) for p in ("p1", "p2")], "turns", F.lit(False).alias("more"), *[F.lit(None).cast("long").alias(e) for e in ("e1", "e2")])
    own = pieces.join(convs, "conv").withColumn("more", F.col("total") > (F.col("level") + 1) * PIECE)
    for seed, x, p in ((1, "x1", "p1"), (2, "x2", "p2")):
        before = Window.partitionBy("conv").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
        own = own.withColumn(x, F.xxhash64(F.lit(seed), "level", "turns")).withColumn(p, F.coalesce(F.bit_xor(x).over(before), F.lit(0)))
    full = F.size("turns") == PIECE
    ends = [F.when(full, F.col(p).bitwiseXOR(F.col(x))).alias(e) for p, x, e in (("p1", "x1", "e1"), ("p2", "x2", "e2"))]
    return own.select("conv", "level", "p1", "p2", "turns", "more", *ends)


# --- one double array -------------------------------------------------------------------------


class DoubleArray:
    """Trie over dense symbol numbers from 1: the child of state s by c is t = BASE[s] + c if CHECK[t] = s."""

    TRIES = 16  # free places tried for a state with several children, before the end of the array

    def __init__(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        size = 2 * len(codes) + int(codes.max(initial=0)) + 2
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.check[0], self.end = 0, 1
        at = np.zeros(len(lengths), np.int64)
        for d in range(int(lengths.max(initial=0))):
            act = np.flatnonzero(lengths > d)
            code, parent = codes[starts[act] + d], at[act]
            new = np.ones(len(act), bool)
            new[1:] = (parent[1:] != parent[:-1]) | (code[1:] != code[:-1])
            at[act] = self._put(parent[new], code[new])[np.cumsum(new) - 1]

    def _put(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Slots of the children of one depth; children of one parent stand together."""
        first = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
        sizes = np.diff(np.r_[first, len(parents)])
        slots = np.empty(len(parents), np.int64)
        for k, n in zip(first[sizes > 1], sizes[sizes > 1]):
            slots[k : k + n] = self._several(int(parents[k]), codes[k : k + n])
        alone = first[sizes == 1]
        if len(alone):
            self._room(self.end + len(alone))
            free = np.flatnonzero(self.check[: self.end + len(alone)] < 0)[: len(alone)]
            slots[alone] = free
            self.check[free] = parents[alone]
            self.base[parents[alone]] = free - codes[alone]
            self.end = max(self.end, int(free[-1]) + 1)
        return slots

    def _several(self, parent: int, codes: np.ndarray) -> np.ndarray:
        offsets = codes - codes.min()
        span = int(offsets.max()) + 1
        self._room(self.end + span)
        window = self.check[max(0, self.end - 4 * span) : self.end]
        for free in np.flatnonzero(window < 0)[: self.TRIES] + max(0, self.end - 4 * span):
            if (self.check[free + offsets] < 0).all():
                break
        else:
            free = self.end
        slots = free + offsets
        self.check[slots] = parent
        self.base[parent] = free - codes.min()
        self.end = max(self.end, int(free) + span)
        return slots

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.r_[self.base, np.zeros(more, np.int64)]
            self.check = np.r_[self.check, np.full(more, -1, np.int64)]

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of states by codes; -1 where there is none."""
        to = self.base[states] + codes
        inside = (to >= 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == states), to, -1)


def dense(t1: np.ndarray, t2: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Numbers from 1 of distinct (t1, t2), in the order in which depth after depth first shows them: siblings lie close together."""
    order = np.lexsort((t2, t1))
    new = np.r_[True, (t1[order][1:] != t1[order][:-1]) | (t2[order][1:] != t2[order][:-1])] if len(order) else np.zeros(0, bool)
    group = np.empty(len(t1), np.int64)
    group[order] = np.cumsum(new) - 1
    shown = np.empty(len(t1), np.int64)
    shown[np.argsort(depth, kind="stable")] = np.arange(len(t1))
    first = np.full(int(new.sum()), len(t1), np.int64)
    np.minimum.at(first, group, shown)
    number = np.empty(len(first), np.int64)
    number[np.argsort(first)] = np.arange(1, len(first) + 1)
    return number[group]


INNER, UNDER_BORDER, BORDER, PATH = range(4)
OUT = pa.schema(
    [("kind", pa.int32()), *[(c, pa.int64()) for c in ("chunk", "a1", "a2", "b1", "b2", "depth", "conv", "parent_conv", "n", "words", "children", "leaves", "saved")], ("ends", pa.string())]
)
OUT_SQL = "kind int, chunk long, a1 long, a2 long, b1 long, b2 long, depth long, conv long, parent_conv long, n long, words long, children long, leaves long, saved long, ends string"


class Chunk:
    """Distinct sequences in order, as many as one double array takes."""

    def __init__(self, depth: int):
        self.depth, self.turns, self.rows = depth, 0, []

    def add(self, row: dict) -> None:
        self.rows.append(row)
        self.turns += len(row["t1"]) + 1

    def nodes(self) -> Iterator[pa.RecordBatch]:
        """The nodes: finished ones, partial sums of border nodes, and paths of members that stand for border nodes."""
        rows, m = self.rows, len(self.rows)
        lengths = np.array([len(r["t1"]) + 1 for r in rows])
        starts = np.cumsum(lengths) - lengths
        flat = {c: np.concatenate([np.r_[np.int64(r["p" + c[1]] if c != "words" else 0), r[c]] for r in rows]) for c in ("t1", "t2", "words")}
        depth = np.arange(len(flat["t1"])) - np.repeat(starts, lengths)
        codes = dense(flat["t1"], flat["t2"], depth)
        trie = DoubleArray(codes, starts, lengths)
        size = trie.end
        n, words, children, leaves, saved, q1, q2, border = (np.zeros(size, t) for t in (np.int64,) * 5 + (np.uint64,) * 2 + (bool,))
        conv = np.full(size, np.iinfo(np.int64).max)
        count, least = np.array([r["n"] for r in rows]), np.array([r["conv"] for r in rows])
        at, path = np.zeros(m, np.int64), np.full(len(codes), -1, np.int64)
        for d in range(int(lengths.max())):  # traverse
            act = np.flatnonzero(lengths > d)
            k = starts[act] + d
            before, at[act] = at[act], trie.step(at[act], codes[k])
            here = path[k] = at[act]
            np.add.at(n, here, count[act])
            np.minimum.at(conv, here, least[act])
            words[here] = flat["words"][k]
            u1, u2 = flat["t1"][k].view(np.uint64), flat["t2"][k].view(np.uint64)
            q1[here] = mix(q1[before] * np.uint64(0x9E3779B97F4A7C15) + u1 + np.uint64(d)) if d else u1
            q2[here] = mix(q2[before] * np.uint64(0xC2B2AE3D27D4EB4F) + (u2 ^ u1) + np.uint64(d)) if d else u2
        assert (path >= 0).all()
        ends: dict[int, str] = {}
        for i, r in enumerate(rows):
            last = int(at[i])
            if r["e1"] is not None:
                q1[last], q2[last] = np.array([r["e1"], r["e2"]], np.int64).view(np.uint64)
            if r["more"]:
                children[last] += r["children"]
                leaves[last] += r["leaves"]
                saved[last] += r["saved"]
            else:
                ends[last] = r["ends"]
            if r["more"] or i in (0, m - 1):
                border[path[starts[i] : starts[i] + lengths[i]]] = True
        border[path[starts]] = True
        slot, where = np.unique(path, return_index=True)
        level = np.zeros(size, np.int64)
        level[slot] = depth[where]
        parent = trie.check[:size]
        for d in range(int(lengths.max()) - 1, 0, -1):  # sums of subtrees, from below
            here = slot[(level[slot] == d) & ~border[slot]]
            leaves[here] += children[here] == 0
            saved[here] += (n[here] - 1) * words[here]
            for total, x in ((children, 1), (leaves, leaves[here]), (saved, saved[here])):
                np.add.at(total, parent[here], x)
        kind = np.where(border[slot], BORDER, np.where((level[slot] > 0) & border[parent[slot]], UNDER_BORDER, INNER))
        top = level[slot] == 0
        up = parent[slot]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(kind, pa.int32()), pa.array(np.full(len(slot), least[0])), pa.array(signed(q1[slot])), pa.array(signed(q2[slot])),
                pa.array(signed(q1[up]), mask=top), pa.array(signed(q2[up]), mask=top), pa.array(level[slot] + self.depth), pa.array(conv[slot]),
                pa.array(conv[up], mask=top), pa.array(n[slot]), pa.array(words[slot]), pa.array(children[slot]), pa.array(leaves[slot]), pa.array(saved[slot]),
                pa.array([ends.get(s) for s in slot.tolist()], pa.string()),
            ],
            schema=OUT,
        )
        edge = slot[border[slot]]
        deepest: dict[int, int] = {}
        for c, d in zip(conv[edge].tolist(), level[edge].tolist()):
            deepest[c] = max(d, deepest.get(c, 0))
        for i in np.flatnonzero(np.isin(least, np.fromiter(deepest, np.int64, len(deepest)))):
            d = deepest[int(least[i])]
            on = path[starts[i] : starts[i] + d + 1]
            filled = {"kind": np.full(d + 1, PATH, np.int32), "a1": signed(q1[on]), "a2": signed(q2[on]), "depth": np.arange(d + 1) + self.depth, "conv": np.full(d + 1, least[i])}
            yield pa.RecordBatch.from_arrays([pa.array(filled[f.name], f.type) if f.name in filled else pa.nulls(d + 1, f.type) for f in OUT], schema=OUT)


def shard(depth: int, most: int):
    """mapInArrow function over sorted rows of equal sequences: merges them, packs chunks, returns their nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, key, row, digest = Chunk(depth), None, None, None

        def close():
            if row is not None:
                row["ends"] = digest.hexdigest()
                chunk.add(row)

        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            turns = column["turns"]
            bounds, inner = turns.offsets.to_numpy(), turns.values
            t1, t2, words = (inner.field(c).to_numpy(zero_copy_only=False) for c in ("t1", "t2", "words"))
            plain = {c: column[c].to_pylist() for c in ("p1", "p2", "more", "e1", "e2", "n", "conv", "ids", "children", "leaves", "saved")}
            for i in range(batch.num_rows):
                a, b = bounds[i], bounds[i + 1]
                x = {c: v[i] for c, v in plain.items()}
                mine = (x["p1"], x["p2"], t1[a:b].tobytes(), t2[a:b].tobytes(), x["more"])
                if mine != key:
                    close()
                    if chunk.turns >= most:
                        yield from chunk.nodes()
                        chunk = Chunk(depth)
                    key, row, digest = mine, x | {"t1": t1[a:b].copy(), "t2": t2[a:b].copy(), "words": words[a:b].copy()}, hashlib.sha256((x["ids"] or "").encode())
                else:
                    row["n"], row["conv"] = row["n"] + x["n"], min(row["conv"], x["conv"])
                    digest.update(f",{x['ids']}".encode())
        close()
        if chunk.rows:
            yield from chunk.nodes()

    return run


# --- all double arrays of a level, merged -----------------------------------------------------


def level_nodes(pieces: DataFrame, level: int, below: DataFrame | None, chunk: int) -> tuple[DataFrame, DataFrame]:
    """(nodes of each double array, merged border nodes) of one level."""
    by = ["p1", "p2", "turns", "more", "e1", "e2"]
    ids = F.array_join(F.array_sort(F.collect_list("conv")), ",")
    equal = pieces.groupBy(*by, F.floor(F.col("conv") / BLOCK).alias("block")).agg(F.count("*").alias("n"), F.min("conv").alias("conv"), ids.alias("ids"))
    sums = ["children", "leaves", "saved"]
    if below is not None:
        equal = equal.join(below, ["e1", "e2"], "left")
    else:
        equal = equal.select("*", *[F.lit(0).cast("long").alias(c) for c in sums])
    equal = equal.fillna(0, sums)
    ordered = equal.repartitionByRange("p1", "p2", "turns", "more").sortWithinPartitions("p1", "p2", "turns", "more", "block")
    out = write_and_read(ordered.mapInArrow(shard(level * PIECE, chunk), OUT_SQL), "trie-nodes")
    parts = out.filter(F.col("kind") == BORDER).groupBy("a1", "a2")
    border = parts.agg(*[F.min(c).alias(c) for c in ("b1", "b2", "depth", "conv")], *[F.sum(c).alias(c) for c in ("n", *sums)], F.max("words").alias("words"), F.max("ends").alias("ends"))
    under = border.filter("b1 is not null").groupBy(F.col("b1").alias("a1"), F.col("b2").alias("a2")).agg(F.count("*").alias("inner"))
    border = border.join(under, ["a1", "a2"], "left").withColumn("children", F.col("children") + F.coalesce("inner", F.lit(0))).drop("inner")
    border = write_and_read(border, "trie-border")
    own = border.select("conv", "depth", (F.col("leaves") + (F.col("children") == 0).cast("long")).alias("x"), (F.col("saved") + (F.col("n") - 1) * F.col("words")).alias("y"))
    path = out.filter(F.col("kind") == PATH).select("conv", "depth", "a1", "a2").join(own, ["conv", "depth"], "left").fillna(0, ["x", "y"])
    beyond = Window.partitionBy("conv").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    carried = path.select("a1", "a2", F.sum("x").over(beyond).alias("x"), F.sum("y").over(beyond).alias("y"))
    totals = carried.groupBy("a1", "a2").agg(F.sum("x").alias("leaves"), F.sum("y").alias("saved"))
    out = out.filter(F.col("kind") < PATH).withColumn("level", F.lit(level))
    return out, border.drop("leaves", "saved").join(totals, ["a1", "a2"])


def nodes(turns: DataFrame, id_column: str = "conv_id", family: int = 20, heads: int = 4, chunk: int = CHUNK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, convs = rebuild(turns, id_column, family, heads)
    levels = max(1, -(-(convs.agg(F.max("total")).first()[0] or 0) // PIECE))
    pieces = sequences(rows, convs, levels)
    if levels > 1:
        pieces = write_and_read(pieces, "trie-pieces", "level")
    inner, border, below = [], [], None
    for level in reversed(range(levels)):
        within, merged = level_nodes(pieces.filter(F.col("level") == level), level, below, chunk)
        if level:
            merged = write_and_read(merged, "trie-merged")
            tops = merged.filter("b1 is null")
            below = tops.select(F.col("a1").alias("e1"), F.col("a2").alias("e2"), "children", "leaves", "saved")
            merged = merged.filter("b1 is not null")
        inner.append(within)
        border.append(merged)
    union = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(union(frames[1:]))
    parts, edge = union(inner), union(border)
    columns = ["depth", "conv", "n", "children", "leaves", "saved", "ends"]
    tops = edge.select("a1", "a2", F.col("conv").alias("parent_conv"))
    # Children of a border node learn its conversation by double array and node: a parent of very many children is no hot key.
    known = parts.filter(F.col("kind") == BORDER).select("level", "chunk", "a1", "a2").join(tops, ["a1", "a2"])
    parent = [F.col("a1").alias("b1"), F.col("a2").alias("b2"), "parent_conv"]
    under = parts.filter(F.col("kind") == UNDER_BORDER).drop("parent_conv").join(known.select("level", "chunk", *parent), ["level", "chunk", "b1", "b2"])
    inside = parts.filter(F.col("kind") == INNER)
    every = [inside, under, edge.join(tops.select(*parent), ["b1", "b2"], "left")]
    every = union([x.select(*columns, "parent_conv") for x in every])
    return every.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"),
    )
