"""Exact byte-pair encoding in linear time, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary gives all tokens that start at each place of a
word. The encoder walks the word taking the longest one, and keeps a token only if it is
compatible with the token before it: merging the two texts alone must give back the same two
tokens. If no token fits, it steps back and never visits that place again, so each place is
tried once per token that starts there. Neighbours that are compatible everywhere are exactly the result of
applying the merges in order. Compatibility depends on the pair only and is kept in a table.

The vocabulary file is read by the driver and sent to the executors; Spark deals out the texts.

Defined cases. A null text is encoded like an empty one: no ids, empty decoded text. The strings
of special tokens inside a text become those tokens, as in the tokenizers library. Every row is
encoded for itself, so equal rows give equal results; other columns are kept by ``encode``.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tributary.llm.common import Cache, arrow_rows, kept, map_texts

END = "\x00"  # stands for the end-of-word suffix; no byte is shown by this character
NEVER = 1 << 60  # rank of a merge that does not exist
CACHED_PIECES = 100_000  # twice as many pieces between white space, and words, a Python worker keeps at most
CACHED_PAIRS = 250_000

# The word pattern of the vocabulary's pre-tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies show each byte: itself if printable, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, free = {b: chr(b) for b in shown}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b], free = chr(free), free + 1
    return [letters[b] for b in range(256)]


class Encoder:
    def __init__(self, file_text: str):
        file = json.loads(file_text)
        model = file["model"]
        suffix = model.get("end_of_word_suffix") or ""
        if not suffix or any(x["type"] not in ("NFC", "Replace", "Lowercase") for x in file["normalizer"]["normalizers"]):
            raise ValueError("a lower-case vocabulary with word ends is asked for")

        def own(token: str) -> str:
            return token[: -len(suffix)] + END if token.endswith(suffix) else token

        self.ids = {own(t): i for t, i in model["vocab"].items()}
        self.texts = {i: t for t, i in self.ids.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(own(a), own(b)): n for n, (a, b) in enumerate(pairs)}
        self.letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(WORDS)
        self.spaces = regex.compile(r"\p{White_Space}+")
        self.matcher = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.matcher.add_word(text, (len(text), i))
        self.matcher.make_automaton()
        self.spines: dict[int, tuple] = {}
        self.pairs: dict[int, bool] = {}
        self.pieces, self.seen = Cache(CACHED_PIECES), Cache(CACHED_PIECES)
        # The offset table: token i is bytes[offset[i] : offset[i + 1]], with the blank that parts tokens.
        shown = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        parts = [(shown.get(i, "") + " ").encode() for i in range(max(shown) + 1)]
        self.offset = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)

    def edges(self, token: int) -> tuple[list, list] | None:
        """What stands at the left and at the right end of a token while its own merges run, each with
        the rank of the merge that ends it; None for a token that the merges do not make."""
        known = self.spines.get(token)
        if known is None:
            text = self.texts[token]
            parts = list(text)
            if len(parts) > 1 and parts[-1] == END:
                parts[-2:] = [parts[-2] + END]
            left, right = [], []
            while len(parts) > 1:
                rank, at = min((self.ranks.get(pair, NEVER), i) for i, pair in enumerate(zip(parts, parts[1:])))
                if rank == NEVER:
                    break
                if at == 0:
                    left.append((parts[0], rank))
                if at == len(parts) - 2:
                    right.append((parts[-1], rank))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self.spines[token] = ([*left, (text, NEVER)], [*right, (text, NEVER)]) if len(parts) == 1 else ()
        return known or None

    def compatible(self, left: int | None, right: int) -> bool:
        """No merge joins anything across the border before both tokens are whole, nor then.

        A merge inside the left token comes first at equal rank, as merges go from left to right.
        """
        key = right if left is None else (left + 1) << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int | None, right: int) -> bool:
        b = self.edges(right)
        a = None if left is None else self.edges(left)
        if not b or left is None or not a:
            return bool(b) and left is None
        i = j = 0
        while True:
            (x, until_x), (y, until_y) = a[1][i], b[0][j]
            rank = self.ranks.get((x, y), NEVER)
            if rank < until_x and rank <= until_y and rank != NEVER:
                return False
            if until_x == until_y == NEVER:
                return True
            if until_x <= until_y:
                i += 1
            else:
                j += 1

    def encode_word(self, word: str) -> list[int]:
        """``word``: byte letters and END."""
        size = len(word)
        starting: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for end, token in self.matcher.iter(word):
            starting[end + 1 - token[0]].append(token)
        # matches come by their end, so the tokens at a start go from short to long
        dead = bytearray(size + 1)
        dead[size - 1] = 1  # the word end is no token of its own
        path: list[tuple[int, int]] = []
        untried: list[int] = []
        at, left = 0, len(starting[0])
        while at < size:
            last = path[-1][1] if path else None
            options, taken = starting[at], None
            while left and taken is None:
                left -= 1
                token = options[left]
                if not dead[at + token[0]] and self.compatible(last, token[1]):
                    taken = token
            if taken is not None:
                path.append(taken)
                untried.append(left)
                at += taken[0]
                left = len(starting[at]) if at < size else 0
            elif path:
                dead[at] = 1
                at -= path.pop()[0]
                left = untried.pop()
            else:
                raise ValueError("the vocabulary has no tokens for this word")
        return [i for _, i in path]

    def encode_piece(self, piece: str) -> bytes:
        """Ids of a text without white space, as little-endian 32-bit integers."""
        ids: list[bytes] = []
        for part in self.split.split(piece) if self.split else [piece]:
            if part in self.special:
                ids.append(self.special[part].to_bytes(4, "little"))
                continue
            # one letter at a time: no rule for a sigma at a word's end
            lower = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            for word in self.words.findall(lower):
                found = self.seen.get(word)
                if found is None:
                    tokens = self.encode_word("".join([self.letters[b] for b in word.encode()]) + END)
                    found = struct.pack(f"<{len(tokens)}I", *tokens)
                    if len(word) <= 64:
                        self.seen.put(word, found)
                ids.append(found)
        return b"".join(ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        pieces = text.split()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            pieces = [p for p in self.spaces.split(text) if p]  # str.split also splits at these four, which are no white space here
        known, out = self.pieces, []
        for piece in pieces:
            ids = known.young.get(piece) or known.get(piece)
            if ids is None:
                ids = self.encode_piece(piece)
                if len(piece) <= 64:
                    known.put(piece, ids)
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """Tokens parted by blanks, as the library shows a vocabulary without a decoder."""
        at = np.frombuffer(ids, "<u4").astype(np.int64)
        if not len(at):
            return b""
        start, size = self.offset[at], self.offset[at + 1] - self.offset[at]
        ends = np.cumsum(size)
        where = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
        return self.bytes[where[:-1]].tobytes()


def encoder(file_text: str) -> Encoder:
    """One per Python worker and vocabulary."""
    return kept(("encoder", hashlib.sha256(file_text.encode()).hexdigest()), lambda: Encoder(file_text))


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(documents: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """id → n_tokens, digests of the ids and of the text decoded from them; with the ids if wanted."""
    sent = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kind = documents.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids

    def run(batch: pa.RecordBatch):
        own = encoder(sent.value)
        ids = [own.encode(t) for t in batch.column("text").to_pylist()]
        fields = [("doc_id", batch.schema.field("doc_id").type), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
        columns = {
            "doc_id": batch.column("doc_id"),
            "n_tokens": [len(x) // 4 for x in ids],
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(own.decode(x)).hexdigest() for x in ids],
            "ids": ids,
        }
        yield arrow_rows(pa.schema(fields + [("ids", pa.binary())] * keep_ids), **columns)

    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    return map_texts(rows, run, schema)


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded`` to rows that hold ids; a null stays null."""
    sent = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    @F.pandas_udf("string")
    def decoded(column):
        own = encoder(sent.value)
        return column.map(lambda x: None if x is None else own.decode(x).decode())

    return encoded.withColumn("decoded", decoded(ids))
