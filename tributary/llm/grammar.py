"""Repair of conversation structure: cheapest edits by dynamic programming over grammar-compressed sequences.

After a deterministic damage every turn is one of 16 symbols (role class × fault class), so a
conversation is a short string. Re-Pair replaces the most frequent pairs of neighbouring symbols over all
distinct strings by new symbols. A symbol, given or new, stands for a min-plus transfer matrix between the
states of the role grammar ``(s?(ua)+)?``; an entry is a cost and the rope of edits that has it. The
matrices of the rules are computed once, bottom-up, and serve every conversation; a conversation
is a vector times few matrices.

Ties. Of equally cheap audits the ASCII-least is wanted. Two audits of one entry consume the same
turns; if one were a proper prefix of the other it would be cheaper by its fewer inserts. So equally
cheap ones differ at a place that both have, and the least of a whole is made of least parts.

Bounds. Rules are learned in ROUNDS jobs over all distinct strings, at most RULES of them; any
grammar gives the same answers. Places come from windows per (conversation, slice of turn numbers).
A conversation's symbols and its audit are one cell, a byte per turn, as the result itself holds
the audit. Texts are shuffled once and fed in order to one digest per conversation, never held together.

Defined cases. A null id, turn, role or text is one space where a string is made of it; turns with a null
id are one conversation. Turns are ordered by number (null first), then role, then hash of role and
text, a repeated turn beside its copy. A role counts by its first character. Texts may be of any length.
No turns after the damage: zeros, an empty audit, the hash of nothing. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tributary.llm.common import text_batches
from tributary.llm.turns import placed, slice_of
from tributary.storage import write_and_read

RULES = 384
ROUNDS = 8
PER_ROUND = 64  # rules of one round at most
FIRST_RULE = 0x100  # code point of the first rule; the 16 symbols are a to p
ROLES, FAULTS = "suao", ("blank", "duplicate", "truncated", "fine")
SPACE = r"[\x20\x09-\x0D]"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
START, SYSTEM, USER, ASSISTANT = range(4)  # states: the role seen last
EMPTY = hashlib.sha256(b"").hexdigest()


# --- damage, order, symbols -------------------------------------------------------------------


def damaged(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """c (id as text), conv, turn, role, text, copy, alive, h1, h2, slice: the turns after the damage; dropped ones are not alive."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told(id_column), F.lit(":"), told("turn")).cast("binary")) % 20
    rows = turns.select(told(id_column).alias("c"), F.col(id_column).cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), told("role").alias("role"), told("text").alias("text"), kind.alias("kind"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select(
        "c",
        "conv",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("alive"),
        F.explode(copies).alias("copy"),
    )
    hashes = [F.xxhash64(F.lit(seed), F.length("role"), "role", "text").alias(n) for seed, n in ((1, "h1"), (2, "h2"))]
    return rows.select("*", *hashes, slice_of())


ORDER = ["turn", "role", "h1", "h2", "copy"]


def symbols(rows: DataFrame) -> DataFrame:
    """c, conv, symbols, gaps: one row per conversation."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    fault = F.when(blank, 0).when(~F.col("text").rlike(rf"[.!?]{SPACE}*\z"), 2).otherwise(3)
    light = rows.select("c", "conv", "slice", *ORDER, "alive", role.alias("r"), fault.alias("f"))
    numbered = write_and_read(placed(light, ORDER, "c")[0], "repair-turns")
    at = F.struct("slice", "n")
    again = numbered.filter("alive and f > 0").groupBy("c", "h1", "h2").agg(F.min(at).alias("first"), F.count("*").alias("k")).filter("k > 1").drop("k")
    marked = numbered.join(again, ["c", "h1", "h2"], "left")
    seen = F.coalesce((F.col("f") > 0) & (F.col("first") < at), F.lit(False))
    code = F.char(F.lit(97) + F.col("r") * 4 + F.when(seen, 1).otherwise(F.col("f")))
    own = F.when(F.col("alive"), F.struct("n", code.alias("s")))
    slices = marked.groupBy("c", "slice").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(own)), lambda x: x["s"]), "").alias("s"),
        F.count_distinct(F.when(F.col("alive"), F.col("turn"))).alias("turns"),
        *[f(F.when(F.col("alive"), F.col("turn"))).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))],
        F.max("conv").alias("conv"),
    )
    gaps = F.max("high") - F.min("low") + 1 - F.sum("turns")
    return slices.groupBy("c").agg(
        F.max("conv").alias("conv"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("slice", "s"))), lambda x: x["s"]), "").alias("symbols"), F.coalesce(gaps, F.lit(0)).alias("gaps")
    )


# --- grammar ----------------------------------------------------------------------------------


def compressed(text: str, rules: list[str]) -> str:
    """Pairs replaced from left to right, rule after rule."""
    for k, pair in enumerate(rules):
        text = text.replace(pair, chr(FIRST_RULE + k))
    return text


def learn(strings: DataFrame) -> list[str]:
    """Re-Pair over distinct strings (column ``symbols``): the pair that rule k replaces, in order.

    A round counts all pairs of neighbours and takes the most frequent ones that share no symbol.
    """
    rules: list[str] = []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.frombuffer(compressed("\n".join(batch.column(0).to_pylist()), rules).encode("utf-32-le"), "<u4").astype(np.int64)
            pairs = (points[:-1] << 32 | points[1:])[(points[:-1] != 10) & (points[1:] != 10)]
            pair, n = np.unique(pairs, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair >> 32), pa.array(pair & 0xFFFFFFFF), pa.array(n.astype(np.int64))], names=["a", "b", "n"])

    for _ in range(ROUNDS):
        counted = strings.select("symbols").mapInArrow(count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        used: set[int] = set()
        for r in counted.filter("n > 1").orderBy(F.desc("n"), "a", "b").limit(4 * PER_ROUND).collect():
            if not used & {r.a, r.b} and len(rules) < RULES:
                used |= {r.a, r.b}
                rules.append(chr(r.a) + chr(r.b))
        if not used:
            break
    return rules


class Rope:
    """A string as a tree of its parts; read in full only where ties are compared or a result is made."""

    __slots__ = ("parts", "whole")

    def __init__(self, *parts):
        self.parts, self.whole = parts, None

    def text(self) -> str:
        if self.whole is None:
            self.whole = "".join(p if isinstance(p, str) else p.text() for p in self.parts)
        return self.whole


def better(a, b):
    """The cheaper of two (cost, rope), of equally cheap ones the ASCII-least."""
    if a is None or b is None:
        return a or b
    return a if a[0] < b[0] or a[0] == b[0] and a[1].text() <= b[1].text() else b


def product(x, y):
    """Min-plus product of transfer matrices; None is no way."""
    out = [[None] * 4 for _ in range(4)]
    for p in range(4):
        for q in range(4):
            if x[p][q] is not None:
                for r in range(4):
                    if y[q][r] is not None:
                        out[p][r] = better(out[p][r], (x[p][q][0] + y[q][r][0], Rope(x[p][q][1], y[q][r][1])))
    return out


def matrix(ways):
    out = [[None] * 4 for _ in range(4)]
    for p, q, cost, edits in ways:
        out[p][q] = better(out[p][q], (cost, Rope(edits)))
    return out


TO_USER, TO_ASSISTANT = [(START, USER), (SYSTEM, USER), (ASSISTANT, USER)], [(USER, ASSISTANT)]
#: Up to two turns are inserted in a row: more would come back to a state that was free.
INSERTS = matrix([(p, p, 0, "") for p in range(4)] + [(p, q, INSERT, "I") for p, q in TO_USER + TO_ASSISTANT] + [(p, ASSISTANT, 2 * INSERT, "II") for p in (START, SYSTEM)])


def of_symbol(role: str, fault: str):
    """Inserts, then the edit of one turn."""
    ways = [(p, p, DELETE, "D") for p in range(4)]
    if fault in ("truncated", "fine"):
        extra = TRUNCATED if fault == "truncated" else 0
        own = {"s": [(START, SYSTEM)], "u": TO_USER, "a": TO_ASSISTANT, "o": []}[role]
        ways += [(p, q, KEEP + extra, "K") for p, q in own] + [(p, q, REROLE + extra, "R") for p, q in TO_USER + TO_ASSISTANT]
    return product(INSERTS, matrix(ways))


class Solver:
    """Matrices of all symbols and rules, bottom-up; cheapest audits of strings."""

    COMMIT = 4096  # edits after which what all states share is put aside

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.of = {chr(97 + 4 * i + j): of_symbol(r, f) for i, r in enumerate(ROLES) for j, f in enumerate(FAULTS)}
        for k, (a, b) in enumerate(rules):
            self.of[chr(FIRST_RULE + k)] = product(self.of[a], self.of[b])
        self.flat = {c: [[(p, *m[p][q][:1], m[p][q][1].text()) for p in range(4) if m[p][q]] for q in range(4)] for c, m in self.of.items()}
        self.last = [[(p, INSERTS[p][q][0], INSERTS[p][q][1].text()) for p in range(4) if INSERTS[p][q]] for q in range(4)]
        self.known: dict[str, tuple[int, str]] = {}

    @staticmethod
    def step(state, ways):
        out = []
        for into in ways:
            best = None
            for p, cost, edits in into:
                if state[p] is not None:
                    c = state[p][0] + cost
                    if best is None or c <= best[0]:
                        x = (c, state[p][1] + edits)
                        best = x if best is None or x < best else best
            out.append(best)
        return out

    def solve(self, text: str) -> tuple[int, str]:
        """(cost, audit) of a string of symbols."""
        short = compressed(text, self.rules)
        if short in self.known:
            return self.known[short]
        state, done = [(0, ""), None, None, None], []
        for c in short:
            state = self.step(state, self.flat[c])
            live = [s[1] for s in state if s]
            if len(live[0]) > self.COMMIT:
                low, high = min(live), max(live)
                same = next((i for i, (x, y) in enumerate(zip(low, high)) if x != y), min(map(len, live)))
                done.append(low[:same])
                state = [s and (s[0], s[1][same:]) for s in state]
        ends = self.step(state, self.last)
        cost, audit = min(x for x in (ends[START], ends[ASSISTANT]) if x)
        found = cost, "".join(done) + audit
        if len(self.known) < 100_000 and len(short) <= 64:
            self.known[short] = found
        return found


LEGAL = {"su", "ua", "au"}
NEIGHBOURS = np.array([[ROLES[a] + ROLES[b] not in LEGAL for b in range(4)] for a in range(4)])
FOUND = pa.schema([("c", pa.string()), ("conv", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])


def audits(convs: DataFrame, rules: list[str]) -> DataFrame:
    """Faults, cost and audit of every conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver(rules)
        for batch in batches:
            c, conv, texts, gaps = (batch.column(n) for n in ("c", "conv", "symbols", "gaps"))
            rows = []
            for text in texts.to_pylist():
                points = np.frombuffer(text.encode(), np.uint8).astype(np.int64) - 97
                faults = np.bincount(points % 4, minlength=4)
                rows.append((*faults[:3].tolist(), int(NEIGHBOURS[points[:-1] // 4, points[1:] // 4].sum()), *solver.solve(text)))
            made = [pa.array([r[k] for r in rows], FOUND.field(3 + k).type) for k in range(6)]
            yield pa.RecordBatch.from_arrays([c.cast(pa.string()), conv.cast(pa.int64()), gaps.cast(pa.int64()), *made], schema=FOUND)

    sql = "c string, conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    return convs.select("c", "conv", "symbols", "gaps").mapInArrow(run, sql)


# --- repaired texts ---------------------------------------------------------------------------


class Repairer:
    """Feeds one conversation's repaired turns, in order, to a sink of bytes."""

    def __init__(self, audit: str, sink):
        self.edits, self.at, self.state, self.sink, self.first = audit, 0, START, sink, True

    def put(self, role: str, text: str) -> None:
        self.sink(("" if self.first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first = False
        self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]

    def wanted(self) -> str:
        return "assistant" if self.state == USER else "user"

    def inserts(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.put(self.wanted(), "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            self.put(role if edit == "K" else self.wanted(), text)


RESULT = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])
HEAD = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation first its verdict, then its turns in order: one row with the digest of its repaired turns."""
    head = repair = digest = None
    done = []

    def close():
        repair.inserts()
        done.append({"conv_id": head["conv"], **{k: head[k] for k in HEAD}, "repaired_sha256": digest.hexdigest()})

    for batch in batches:
        for r in batch.to_pylist():
            if r["audit"] is not None:
                if head:
                    close()
                head, digest = r, hashlib.sha256()
                repair = Repairer(r["audit"], digest.update)
            else:
                repair.turn(r["role"], r["text"])
        if len(done) >= 1000:
            yield pa.RecordBatch.from_pylist(done, RESULT)
            done.clear()
    if head:
        close()
    yield pa.RecordBatch.from_pylist(done, RESULT)


def repaired(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    text_batches(turns.sparkSession)
    rows = damaged(turns, id_column)
    convs = write_and_read(symbols(rows), "repair-symbols")
    strings = write_and_read(convs.select("symbols").distinct(), "repair-strings")
    heads = audits(convs, learn(strings))
    kinds = dict(rows.dtypes)
    blank = {n: F.lit(None).cast(kinds[n]).alias(n) for n in (*ORDER, "text")}
    made = dict(heads.dtypes)
    first = heads.select("c", "conv", F.lit(0).alias("part"), *blank.values(), *HEAD)
    rest = rows.filter("alive").select("c", "conv", F.lit(1).alias("part"), *ORDER, "text", *[F.lit(None).cast(made[n]).alias(n) for n in HEAD])
    along = ["c", "part", *ORDER]
    ordered = first.unionByName(rest).repartition("c").sortWithinPartitions(*along)
    sql = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return ordered.select("conv", "role", "text", *HEAD).mapInArrow(digests, sql)
