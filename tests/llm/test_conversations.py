import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tributary.llm import grammar, trie

TURNS = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    for c in convs:
        convs[c].sort(key=lambda z: z[:3])
    out = {}
    for c, own in convs.items():
        h, donor = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = [z[2:] for z in convs.get(donor, [])[:h] + own[h:]]
    return out


def trie_nodes(rows):
    whole = rebuilt(rows)
    members, kids = defaultdict(set), defaultdict(set)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].add(c)
    for k in members:
        if k:
            kids[k[:-1]].add(k)
    out, leaves, saved = Counter(), {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[j] for j in kids[k]) or 1
        words = len(k[-1][1].encode().split()) if k else 0
        saved[k] = (len(members[k]) - 1) * words + sum(saved[j] for j in kids[k])
        ends = ",".join(str(c) for c in sorted(members[k]) if len(whole[c]) == len(k))
        parent = min(members[k[:-1]]) if k else None
        out[(min(members[k]), len(k), parent, len(members[k]), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("chunk, piece, block", [(200_000, 4096, 4096), (12, 4096, 4), (9, 3, 2)])
def test_trie_brute_force(spark, monkeypatch, chunk, piece, block):
    monkeypatch.setattr(trie, "PIECE", piece)
    monkeypatch.setattr(trie, "BLOCK", block)
    rng = random.Random(chunk)
    rows = [
        (c, t, rng.choice(["user", None]) if t % 2 else "system", rng.choice(["a b", "c d e", None, ""]))
        for c in range(-30, 140)
        if rng.random() > 0.15
        for t in range(rng.choice([1, 2, 3, 4, 6, 9, 14]))
    ]
    rows += [(500 + i, t, "u", "same text") for i in range(40) for t in range(8)] + [(None, 1, "u", "x"), (700, None, None, None), (701, 5, "u", "w " * 20000)]
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as conv", "2 as slice", "'x' as ends").repartition(3)
    assert Counter(map(tuple, trie.nodes(frame, chunk=chunk).collect())) == trie_nodes(rows)


def test_trie_of_nothing_and_of_repeated_rows(spark):
    assert trie.nodes(spark.createDataFrame([], TURNS)).count() == 0
    rows = [(20, 1, "u", "hi")] * 3 + [(21, None, None, None)] * 2 + [(300, t, "u", f"t{t}") for t in range(700)]
    assert Counter(map(tuple, trie.nodes(spark.createDataFrame(rows, TURNS)).collect())) == trie_nodes(rows)


def test_double_array_holds_exactly_its_sequences():
    rng = np.random.default_rng(1)
    words = sorted({tuple(rng.integers(1, 30, rng.integers(1, 7)).tolist()) for _ in range(3000)})
    codes, lengths = np.concatenate([np.array(w) for w in words]), np.array([len(w) for w in words])
    array = trie.DoubleArray(codes, np.cumsum(lengths) - lengths, lengths)
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}

    def holds(w):
        state = np.zeros(1, np.int64)
        for c in w:
            state = array.step(state, np.array([c]))
            if state[0] < 0:
                return False
        return True

    assert all(holds(w) for w in prefixes)
    assert len(prefixes) == (array.check >= 0).sum()
    others = {tuple(rng.integers(1, 30, rng.integers(1, 7)).tolist()) for _ in range(2000)}
    assert all(holds(w) == (w in prefixes) for w in others)


def cheapest(rows):
    """(cost, audit) over all scripts with up to two inserts in a row; rows: (initial, fault)."""
    best = None
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(e != "D" and f in ("blank", "duplicate") for e, (_, f) in zip(edits, rows)):
            continue
        for gaps in itertools.product(("", "I", "II"), repeat=len(rows) + 1):
            script = "".join(g + e for g, e in zip(gaps, edits)) + gaps[-1]
            cost = sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in script) + sum(3 for e, (_, f) in zip(edits, rows) if e != "D" and f == "truncated")
            if best is not None and (cost, script) >= best:
                continue
            free, at = [], 0
            for e in script:
                if e != "I":
                    at += 1
                if e != "D":
                    free.append(rows[at - 1][0] if e == "K" else "*")
            wanted = [["u", "a"][k % 2] for k in range(len(free))]
            with_s = ["s"] + wanted[:-1]
            if not free or any(re.fullmatch("s?(ua)+", "".join(w)) and all(x == y or x == "*" and y != "s" for x, y in zip(free, w)) for w in (wanted, with_s)):
                best = (cost, script)
    return best


def rebuilt_rows(conv, rows):
    """The damaged, faulted and repaired conversation, straight from the definition."""
    out = []
    for t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if t is None else t}".encode()) % 20
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        out += [] if kind == 0 else [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    out.sort(key=lambda z: (z[0] is not None, z[0] or 0))
    faults, seen = [], set()
    for _, r, x in out:
        core = x.strip(" \t\n\v\f\r")
        faults.append("blank" if not core else "duplicate" if (r, x) in seen else "truncated" if core[-1] not in ".!?" else "fine")
        seen.add((r, x))
    turns = [t for t, _, _ in out if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(out, out[1:])]
    return out, faults, gaps, sum(p not in ("su", "ua", "au") for p in pairs)


def test_repair_brute_force(spark):
    rng = random.Random(3)
    texts = ["Fine.", "Well, no", "Yes!  ", "What?", "", None, " \n", "cut off", "a. b"]
    rows = [(c, t if rng.random() > 0.1 else None, rng.choice(["user", "assistant", "system", "tool", None, "", "User"]), rng.choice(texts)) for c in range(150) for t in rng.sample(range(9), rng.randint(1, 4))]
    ties = {(c, t) for c, t, _, _ in rows}
    rows = [next(r for r in rows if r[:2] == k) for k in sorted(ties, key=str)] + [(None, 3, "user", "Hello."), (None, 4, "assistant", "x" * 50000 + ".")]
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as c", "2 as slice", "'x' as audit", "3 as part").repartition(3)
    got = {r.conv_id: r for r in grammar.repaired(frame).collect()}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r, x))
    assert set(got) == set(by)
    for c, own in by.items():
        out, faults, gaps, illegal = rebuilt_rows(c, own)
        r = got[c]
        assert (r.gaps, r.illegal, r.blank, r.duplicate, r.truncated) == (gaps, illegal, *(faults.count(f) for f in ("blank", "duplicate", "truncated")))
        if len(out) <= 5:
            assert (r.cost, r.audit) == cheapest([(x[1][:1], f) for x, f in zip(out, faults)]), (out, faults)
        lines, at = [], 0
        for e in r.audit:
            at += e != "I"
            if e != "D":
                free = [x.split(":")[0][:1] for x in lines]
                wanted = "assistant" if free and free[-1] == "u" else "user"
                lines.append(f"{out[at - 1][1] if e == 'K' else wanted}:{'' if e == 'I' else out[at - 1][2]}")
        assert at == len(out) and re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        assert r.repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert grammar.repaired(frame.limit(0)).count() == 0


def test_any_grammar_gives_the_same_audits(spark):
    rng = random.Random(8)
    strings = ["".join(rng.choice("hhhhlllldabcefgkop") for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["hl" * 6000, "h" * 3000, "lhdp" * 700]
    rules = grammar.learn(spark.createDataFrame([(s,) for s in set(strings)], "symbols string").repartition(4))
    assert len(rules) > 20 and len(set(rules)) == len(rules)
    plain, packed = grammar.Solver([]), grammar.Solver(rules)
    assert all(plain.solve(s) == packed.solve(s) for s in strings)
    assert len(grammar.compressed("hl" * 6000, rules)) < 400
    for s in strings[:60]:
        if len(s) <= 4:
            assert plain.solve(s) == cheapest([(grammar.ROLES[(ord(x) - 97) // 4], grammar.FAULTS[(ord(x) - 97) % 4]) for x in s])


def test_repair_of_very_many_turns(spark):
    rows = [(5, t, "user" if t % 2 else "assistant", f"t{t}.") for t in range(3000)] + [(6, 0, "user", "Same.")] * 40
    got = {r.conv_id: r for r in grammar.repaired(spark.createDataFrame(rows, TURNS)).collect()}
    out, faults, gaps, illegal = rebuilt_rows(5, [r[1:] for r in rows if r[0] == 5])
    assert (got[5].gaps, got[5].illegal) == (gaps, illegal) and got[6].duplicate >= 39 - (zlib.crc32(b"6:0") % 20 == 0) * 40
