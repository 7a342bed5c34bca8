"""Encoding of a corpus with a public byte-level BPE through a tokenization automaton.

The automaton reads *tokens*: its states are what may follow, its arcs are
labelled with tokens, and it accepts exactly the correct tokenizations, one for
each byte string.  It begins as one state with an arc for each byte; the merge
(a, b) -> ab of each rank adds its gadget: wherever an ``a`` arc leads to a state
with a ``b`` arc, a new arc ``ab`` leads to where ``b`` leads, and ``a`` now leads
to a copy of its state without the arc ``b``.  As the automaton begins with one
state, the state after an arc depends only on the arc's label.  So the state of
token x is described by which arcs it has, and its row of the transition table
is filled from the gadgets' order:

* the younger of the two tokens decides: if ``y = (a, b)`` came after ``x`` (or is x), the arc
  ``y`` was added to x's state iff that had the arc ``a`` once y's merge was done;
* if ``x = (c, d)`` came after ``y``, its state began as a copy of d's at that time;
* the arc is gone if x and y themselves merge at a later rank;
* no state has an arc y whose parts never stand side by side when y's merge comes.

Entries are computed at their first use and kept in the table.  Encoding walks
the bytes of a word once: the last token of each prefix is the only token that
ends there and is an arc of the state after the prefix before it.  Decoding emits
the labels of the arcs.

Defined cases: null and empty texts give an empty list; special tokens written
in a text are ordinary text; a lone surrogate cannot occur in a string column; a
word of any length is read in linear time; equal words are encoded once per batch
and kept in a table of bounded size.
"""

from __future__ import annotations

import json
import os

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the public pre-splitting pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORDS_KEPT = 200_000


def default_folder() -> str:
    """The folder of the public tokenizers: OBSFORGE_TOKENIZERS, else the installed package's, else /opt/tokenizers."""
    if where := os.environ.get("OBSFORGE_TOKENIZERS"):
        return where
    try:
        import public_tokenizers

        return os.path.dirname(public_tokenizers.__file__)
    except ImportError:
        return "/opt/tokenizers"


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Tokens by bytes, merges by rank, and the transition table."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.ids = vocabulary
        self.bytes_of = {i: b for b, i in vocabulary.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {vocabulary[bytes([b])]: -1 for b in range(256)}
        self.joined: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(merges):
            x, y, z = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.joined.setdefault((x, y), r)
            if z not in self.rank:
                self.parts[z], self.rank[z] = (x, y), r
        self.longest = max(map(len, vocabulary))
        self.table: dict[int, bool] = {}
        # Last bytes first: which lengths a token that ends with these bytes can have.
        self.tails: dict[bytes, tuple[int, ...]] = {}
        lengths: dict[bytes, set[int]] = {}
        for t, i in vocabulary.items():
            if i in self.rank:
                lengths.setdefault(t[-2:], set()).add(len(t))
        self.tails = {k: tuple(sorted(v, reverse=True)) for k, v in lengths.items()}

    @classmethod
    def from_json(cls, text: str) -> Automaton:
        model = json.loads(text)["model"]
        back = byte_alphabet()
        raw = lambda s: bytes(back[c] for c in s)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        special = {k for k in model["vocab"] if any(c not in back for c in k)}
        vocab = {raw(k): v for k, v in model["vocab"].items() if k not in special}
        return cls(vocab, [(raw(a), raw(b)) for a, b in pairs])

    def has_arc(self, x: int, y: int, before: int | None = None) -> bool:
        """Whether the state after token x has an arc y, once all merges of a rank under ``before`` (all, if None) are made."""
        limit = len(self.joined) + 1 if before is None else before
        while True:
            r = self.joined.get((x, y))
            if r is not None and r < limit:
                return False
            rx, ry = self.rank[x], self.rank[y]
            if rx < 0 and ry < 0:
                return True
            if ry >= rx:
                y, limit = self.parts[y][0], ry + 1
            else:
                x, limit = self.parts[x][1], rx

    def follows(self, x: int, y: int) -> bool:
        key = x << 20 | y
        if (got := self.table.get(key)) is None:
            got = self._whole(y) and self.has_arc(x, y)
            if len(self.table) < 4_000_000:
                self.table[key] = got
        return got

    def encode_word(self, word: bytes) -> list[int]:
        ids, rank, n = self.ids, self.rank, len(word)
        if (whole := ids.get(word)) is not None and n == 1:
            return [whole]
        last = [-1] * (n + 1)
        for i in range(1, n + 1):
            for k in self.tails.get(word[max(0, i - 2) : i], ()) if i > 1 else (1,):
                j = i - k
                if j < 0 or (j and last[j] < 0):
                    continue
                y = ids.get(word[j:i])
                if y is None or y not in rank:
                    continue
                if j == 0:
                    # The state the automaton begins in has every arc whose merges can happen.
                    if self._whole(y):
                        last[i] = y
                        break
                elif self.follows(last[j], y):
                    last[i] = y
                    break
            else:
                y = ids[word[i - 1 : i]]
                if i == 1 or self.follows(last[i - 1], y):
                    last[i] = y
        out, i = [], n
        while i:
            out.append(last[i])
            i -= len(self.bytes_of[last[i]])
        return out[::-1]

    def _whole(self, y: int) -> bool:
        """Whether the token is the tokenization of its own bytes: its last merge finds both parts side by side."""
        key = y | 1 << 40
        if (got := self.table.get(key)) is None:
            if y not in self.parts:
                got = True
            else:
                a, b = self.parts[y]
                got = self._whole(a) and self._whole(b) and self.has_arc(a, b, self.rank[y])
            self.table[key] = got
        return got

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(self.bytes_of[i] for i in ids)


class Encoder:
    """Pre-splitting and a bounded table of words met before."""

    def __init__(self, automaton: Automaton, pattern: str = PATTERN):
        self.automaton, self.split, self.words = automaton, regex.compile(pattern), {}

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        words = self.words
        for w in self.split.findall(text):
            got = words.get(w)
            if got is None:
                got = self.automaton.encode_word(w.encode("utf-8"))
                if len(words) >= WORDS_KEPT:
                    words.clear()
                if len(w) <= 64:
                    words[w] = got
            out += got
        return out

    def decode(self, ids: list[int]) -> str:
        return self.automaton.decode(ids).decode("utf-8", errors="replace")


_HELD: dict[int, Encoder] = {}


def encode_column(docs: DataFrame, text_col: str = "text", folder: str | None = None, vocabulary: str = "byte_bpe_50k.json"):
    """The column of ids of ``text_col``.

    The vocabulary file (about 1.5 MB, fixed by the public tokenizer) is read where the query is built and broadcast,
    so the executors need no such file; each worker compiles the automaton once.
    """
    with open(os.path.join(folder or default_folder(), vocabulary), encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    mark = hash((folder, vocabulary, os.urandom(8)))

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        if mark not in _HELD:
            _HELD.clear()
            _HELD[mark] = Encoder(Automaton.from_json(shared.value))
        return texts.map(_HELD[mark].encode)

    return ids(F.col(text_col))


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """(doc_id, ids): equal documents come out once; they are found by their texts, which are fewer bytes than the ids."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).distinct()
    return narrow.select("doc_id", encode_column(narrow, "text", folder).alias("ids"))
