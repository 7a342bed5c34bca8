"""Evaluation texts leaking into training text, by latent semantic retrieval.

1. Both sides are normalised: NFKC, lower case, letters, marks and numbers only.
2. The items (a stated query set, taken in blocks of bounded length) are cut into
   passages of two runs' length, one run apart; their character 4-grams are the
   vocabulary.  A run shared by document and item is an unbroken stretch of
   vocabulary grams, so a document's passages are cut from such stretches and the
   rest of the corpus is dropped without loss.  The same single pass over all
   documents counts in how many of them each gram occurs (for the idf weights).
3. TF-IDF vectors of all passages (documents' and items') are hashed into a fixed
   number of features, and a randomised range finder with power iterations builds
   the leading right singular subspace: each task sums its own X'X W, the blocks
   are added by feature block, and only the features x rank matrix, of fixed
   size, reaches the driver for orthogonalisation.
   Passages with many vocabulary grams but no such stretch are kept apart for ``paraphrased``.
4. Passages are compared with the item passages by cosine in that subspace; the
   cutoff is calibrated on the items alone, as a fraction of the lowest cosine
   between an item passage and any bare run of it.  No cosine bounds that of two
   passages which share a run and differ in the rest (the rarer the rest, the lower
   it is), so the pairs below the cutoff are looked up by the hashes of their runs.
5. A candidate pair of either way counts for ``leaked`` if the two passages share a
   common substring of the required length.  ``paraphrased`` takes the other passages:
   a candidate by cosine counts if the longest common subsequence of the two covers
   LCS_SHARE of the longer one (computed bit-parallel) and every number of the item's
   passage, the part an answer hangs on, stands in the document's too.

Defined cases: null and blank texts contain nothing; items shorter than the run
have no cases; repeated documents give each pair once; a document with one item
many times gives one row; texts of any length are cut in linear time; an empty
corpus or item table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.session import materialize

RUN, RUN_DENSE = 40, 18
GRAM = 4
FEATURES, RANK, POWER = 8192, 192, 2
BLOCK_CHARS = 4_000_000
FRACTION = 0.3
COVERED, NEAR, LCS_SHARE = 0.6, 0.5, 0.8
DENSE = regex.compile(r"[\p{Thai}\p{Han}\p{Hiragana}\p{Katakana}]")
KEEP = regex.compile(r"[^\p{L}\p{M}\p{N}]+")
KEEP_JOINED = regex.compile(r"[^\p{L}\p{M}\p{N}\0]+")
NUMBERS = regex.compile(r"(?<=[^\p{N}])\p{N}+(?=[^\p{N}])")  # those that a passage's ends don't cut


def normal(text: str) -> str:
    return KEEP.sub("", unicodedata.normalize("NFKC", text).lower())


def normal_all(texts: list[str]) -> str:
    """The normal forms of texts, joined by NUL, made in one pass: no rule of the forms looks across a NUL."""
    joined = "\0".join([t.replace("\0", " ") for t in texts])
    return KEEP_JOINED.sub("", unicodedata.normalize("NFKC", joined).lower())


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-word row operation a character of ``b``."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at.get(c, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def grams(text: str) -> np.ndarray:
    """One 64-bit number per position: the four code points of 16 bits mixed."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    if len(c) < GRAM:
        return np.empty(0, np.uint64)
    h = np.zeros(len(c) - GRAM + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(GRAM):
            h = (h ^ c[k : len(c) - GRAM + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h


def run_keys(text: str, run: int) -> np.ndarray:
    """One 64-bit number for the run that begins at each position, mixed from grams that cover it."""
    h = grams(text)
    n = len(text) - run + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in [*range(0, run - GRAM, GRAM), run - GRAM]:
            out = (out ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def windows(n: int, run: int) -> Iterator[tuple[int, int]]:
    """Passages of two runs, one run apart: any stretch of one run lies within one of them."""
    for a in range(0, max(1, n - run + 1), run):
        if min(n, a + 2 * run) - a >= run:
            yield a, min(n, a + 2 * run)


class Side:
    """The item passages of one run length, their vocabulary and hashed features."""

    def __init__(self, items: list[tuple[int, str]], run: int):
        self.run = run
        self.ids, self.text = [], []
        for i, t in items:
            for a, b in windows(len(t), run):
                self.ids.append(i)
                self.text.append(t[a:b])
        found = [grams(t) for t in self.text]
        self.vocabulary = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
        # Most grams of the corpus are told from the vocabulary's by one look into a bit field.
        self.field_bits = np.uint64((1 << max(12, (16 * len(self.vocabulary)).bit_length())) - 1)
        self.field = np.zeros(int(self.field_bits) + 1, bool)
        self.field[self.vocabulary & self.field_bits] = True

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary number of each gram, −1 if it is none."""
        out = np.full(len(h), -1)
        if len(self.vocabulary):
            some = np.flatnonzero(self.field[h & self.field_bits])
            i = np.minimum(np.searchsorted(self.vocabulary, h[some]), len(self.vocabulary) - 1)
            out[some] = np.where(self.vocabulary[i] == h[some], i, -1)
        return out

    def passages(self, text: str, at: np.ndarray) -> Iterator[tuple[int, str]]:
        """(place, passage) of the unbroken stretches of vocabulary grams that are long enough for a run."""
        need = self.run - GRAM + 1
        ok = np.concatenate([[0], (at >= 0).astype(np.int8), [0]])
        edge = np.diff(ok)
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
            if b - a >= need:
                part = text[a : b + GRAM - 1]
                for x, y in windows(len(part), self.run):
                    yield int(a), part[x:y]

    def covered(self, text: str, at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, str]]:
        """(place, passage) of the passages, half a run apart, of which at least COVERED are vocabulary grams."""
        step, full = self.run // 2, 2 * self.run
        number = (np.maximum(0, -(-(ends - starts - full) // step)) + 1) * (ends - starts >= self.run)
        k = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        # The last passage of a text ends with it.
        first = np.minimum(np.repeat(starts, number) + k * step, np.repeat(np.maximum(starts, ends - full), number))
        last = np.minimum(np.repeat(ends, number), first + full)
        seen = np.concatenate([[0], np.cumsum(at >= 0)])
        grams_in = last - first - GRAM + 1
        for k in np.flatnonzero(seen[first + grams_in] - seen[first] >= COVERED * grams_in):
            yield int(first[k]), text[first[k] : last[k]]


class Runs:
    """The runs of one side's item passages by hash: exact, whatever the cosine."""

    def __init__(self, side: Side):
        self.side = side
        found = [np.unique(run_keys(t, side.run)) for t in side.text]
        key, at = np.concatenate(found), np.repeat(np.arange(len(found)), [len(k) for k in found])
        order = np.argsort(key, kind="stable")
        self.key, self.at = key[order], at[order]

    def near(self, text: str) -> np.ndarray:
        """Numbers of the item passages that have a run's hash in common with the text."""
        mine = np.unique(run_keys(text, self.side.run))
        a, b = np.searchsorted(self.key, mine, "left"), np.searchsorted(self.key, mine, "right")
        some = [self.at[x:y] for x, y in zip(a, b) if y > x]
        return np.unique(np.concatenate(some)) if some else np.empty(0, np.int64)

    def share(self, text: str, j: int) -> bool:
        """Whether the text and item passage ``j`` have a run in common."""
        run, other = self.side.run, self.side.text[j]
        return any(text[x : x + run] in other for x in range(len(text) - run + 1))


class Space:
    """TF-IDF rows of one side's vocabulary, seen through a (features x rank) matrix.

    A row is never written out: its product with the matrix is the sum of its grams' weighted matrix rows.
    """

    def __init__(self, side: Side, idf: np.ndarray, basis: np.ndarray):
        self.side = side
        self.feature = (side.vocabulary % np.uint64(FEATURES)).astype(np.int64)
        sign = np.where((side.vocabulary >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
        self.weight = (sign * idf).astype(np.float32)
        self.table = basis[self.feature] * self.weight[:, None]

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vocabulary numbers of all grams, where each text begins, length of each TF-IDF row)."""
        found = [self.side.lookup(grams(t)) for t in texts]
        found = [at[at >= 0] for at in found]
        found = [at if len(at) else np.zeros(1, np.int64) for at in found]
        starts = np.cumsum([0, *map(len, found)])[:-1]
        at = np.concatenate(found)
        return at, starts, np.sqrt(np.add.reduceat(self.weight[at].astype(np.float64) ** 2, starts))

    def embed(self, texts: list[str]) -> np.ndarray:
        """Each text's row, of length one, times the matrix."""
        at, starts, n = self.rows(texts)
        return np.add.reduceat(self.table[at], starts, axis=0) / np.maximum(n, 1e-9)[:, None].astype(np.float32)

    def gram_times(self, texts: list[str], total: np.ndarray) -> None:
        """Add X'X W of these rows to ``total`` (features x rank)."""
        at, starts, n = self.rows(texts)
        y = np.add.reduceat(self.table[at], starts, axis=0) / (np.maximum(n, 1e-9) ** 2)[:, None].astype(np.float32)
        y = np.repeat(y, np.diff([*starts, len(at)]), axis=0) * self.weight[at][:, None]
        f = self.feature[at]
        order = np.argsort(f, kind="stable")
        f = f[order]
        cut = np.concatenate([[0], np.flatnonzero(np.diff(f)) + 1])
        total[f[cut]] += np.add.reduceat(y[order], cut, axis=0)


def in_batches(texts: list[str], size: int = 256) -> Iterator[list[str]]:
    for a in range(0, len(texts), size):
        yield texts[a : a + size]


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str, bool]]]:
    """The items in blocks of at most BLOCK_CHARS characters (one item may exceed that alone), one after the other."""
    out, size = [], 0
    rows = items.select(F.col("item_id").cast("long"), F.col("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct().orderBy("item_id", "text")
    for i, t in rows.toLocalIterator():
        if size and size + len(t) > BLOCK_CHARS:
            yield out
            out, size = [], 0
        size += len(t)
        out.append((i, normal(t), bool(DENSE.search(t))))
    yield out


def by_chars(batches, most: int = 1_000_000) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(ids, texts) of parts of batches with about ``most`` characters (one text may exceed that alone)."""
    for pdf in batches:
        ids, texts = pdf["doc_id"].to_numpy(), pdf["text"].tolist()
        part = np.cumsum([len(t) for t in texts]) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(texts)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield ids[a:b], texts[a:b]


def _scan(docs: DataFrame, sides: list[Side], loose: bool) -> DataFrame:
    """One pass over all documents: kind 0 rows (side, gram, documents with it), kind 1 rows (side, doc_id, passage) and, if ``loose``, kind 2 rows (passages covered without a run)."""
    shared = docs.sparkSession.sparkContext.broadcast(sides)

    def scan(batches):
        sides = shared.value
        seen = [np.zeros(len(s.vocabulary) + 1, np.int64) for s in sides]
        for ids, texts in by_chars(batches):
            text, out = normal_all(texts), []
            h = grams(text)
            cuts = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 0)
            starts, ends = np.concatenate([[0], cuts + 1]), np.append(cuts, len(text))
            for k, s in enumerate(sides):
                seen[k][-1] += len(ids)
                at = s.lookup(h)
                hit = np.flatnonzero(at >= 0)
                doc = np.searchsorted(starts, hit, side="right") - 1
                pair = np.unique(doc * np.int64(len(s.vocabulary) + 1) + at[hit])
                seen[k] += np.bincount(pair % (len(s.vocabulary) + 1), minlength=len(seen[k]))
                found = {(1, k, int(ids[np.searchsorted(starts, a, side="right") - 1]), p) for a, p in s.passages(text, at)}
                if loose:
                    found |= {(2, k, int(ids[np.searchsorted(starts, a, side="right") - 1]), p) for a, p in s.covered(text, at, starts, ends)}
                out += sorted(found)
            yield pd.DataFrame(out, columns=["kind", "side", "n", "passage"])
        for k, c in enumerate(seen):
            j = np.flatnonzero(c)
            yield pd.DataFrame({"kind": 0, "side": k, "n": c[j], "passage": j.astype(str)})

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    return materialize(narrow.mapInPandas(scan, "kind int, side int, n long, passage string"), "passages")


def subspace(passages: DataFrame, side: Side, idf: np.ndarray) -> np.ndarray:
    """Orthonormal basis (features x rank) of the leading right singular subspace of the passages' TF-IDF matrix."""
    sc = passages.sparkSession.sparkContext
    rng = np.random.default_rng(20240229)
    basis = np.linalg.qr(rng.standard_normal((FEATURES, RANK)))[0].astype(np.float32)
    shared = sc.broadcast((side, idf))
    for _ in range(POWER):
        w = sc.broadcast(basis)

        def gram_times(batches, w=w):
            side, idf = shared.value
            space, total, some = None, np.zeros((FEATURES, RANK), np.float32), False
            for pdf in batches:
                for texts in in_batches(pdf["passage"].tolist()):
                    space = space or Space(side, idf, w.value)
                    space.gram_times(texts, total)
                    some = True
            if some:
                yield pd.DataFrame({"block": range(16), "z": [b.tobytes() for b in np.split(total, 16)]})

        def add(batches):
            held: dict[int, np.ndarray] = {}
            for pdf in batches:
                for b, z in zip(pdf["block"], pdf["z"]):
                    z = np.frombuffer(z, np.float32)
                    held[b] = held[b] + z if b in held else z.copy()
            if held:
                yield pd.DataFrame({"block": list(held), "z": [z.tobytes() for z in held.values()]})

        parts = passages.mapInPandas(gram_times, "block int, z binary").repartition(16, "block").mapInPandas(add, "block int, z binary")
        z, own = np.zeros((FEATURES, RANK), np.float32), Space(side, idf, basis)
        for texts in in_batches(side.text):
            own.gram_times(texts, z)
        rows = FEATURES // 16
        for b, blob in parts.collect():  # 16 blocks, features x rank numbers in all
            z[b * rows : (b + 1) * rows] += np.frombuffer(blob, np.float32).reshape(rows, RANK)
        basis = np.linalg.qr(z.astype(np.float64))[0].astype(np.float32)
    return basis


def unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n > 1e-9, n, 1)


def cutoff(space: Space, at: np.ndarray) -> float:
    """FRACTION of the lowest cosine between an item passage and a bare run cut from it."""
    run, low = space.side.run, 1.0
    for cut in (0.0, 0.5, 1.0):
        texts = [t[int((len(t) - run) * cut) :][:run] for t in space.side.text]
        bare = np.concatenate([unit(space.embed(x)) for x in in_batches(texts)])
        low = min(low, float((bare * at).sum(axis=1).min()))
    return FRACTION * max(low, 0.0)


def _searched(docs: DataFrame, items: DataFrame, loose: bool, judge, schema: str) -> DataFrame | None:
    """``judge(side, runs, passages, their cosines with the item passages, cutoff)`` of all distinct passages, with the documents that have them."""
    spark = docs.sparkSession
    sc, found = spark.sparkContext, None
    for block in _blocks(items):
        sides = [s for s in (Side([(i, t) for i, t, dense in block if dense == (run == RUN_DENSE)], run) for run in (RUN, RUN_DENSE)) if s.text]
        if not sides:
            continue
        scanned = _scan(docs, sides, loose)
        # At most one row per vocabulary gram: bounded by the block's length.
        counts = scanned.where("kind = 0").groupBy("side", "passage").agg(F.sum("n")).collect()
        for k, side in enumerate(sides):
            df = np.zeros(len(side.vocabulary) + 1)
            for s, j, n in counts:
                if s == k:
                    df[int(j)] = n
            idf = (np.log((df[-1] + 1) / (df[:-1] + 1)) + 1).astype(np.float32)
            part = scanned.where((F.col("kind") == (2 if loose else 1)) & (F.col("side") == k)).select(F.col("n").alias("doc_id"), "passage")
            # Equal passages are embedded once, whatever number of documents has them.
            distinct = part.select("passage").distinct()
            basis = subspace(distinct, side, idf)
            space = Space(side, idf, basis)
            at = np.concatenate([unit(space.embed(x)) for x in in_batches(side.text)])
            shared = sc.broadcast((side, idf, basis, at, cutoff(space, at)))

            def retrieve(batches, shared=shared):
                side, idf, basis, at, low = shared.value
                space, runs = Space(side, idf, basis), Runs(side)
                for pdf in batches:
                    out = []
                    for texts in in_batches(pdf["passage"].tolist()):
                        out += judge(side, runs, texts, unit(space.embed(texts)) @ at.T, low)
                    yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

            pairs = part.join(distinct.mapInPandas(retrieve, schema), "passage").drop("passage")
            found = pairs if found is None else found.unionByName(pairs)
    return found


def _by_run(side: Side, runs: Runs, texts: list[str], cosine: np.ndarray, low: float) -> list[tuple]:
    out = []
    for r, t in enumerate(texts):
        candidates = np.union1d(np.flatnonzero(cosine[r] >= low), runs.near(t))
        out += [(i, t) for i in sorted({side.ids[j] for j in candidates if runs.share(t, j)})]
    return out


def _by_subsequence(side: Side, runs: Runs, texts: list[str], cosine: np.ndarray, low: float) -> list[tuple]:
    out = []
    for r, t in enumerate(texts):
        best: dict[int, float] = {}
        numbers = set(regex.findall(r"\p{N}+", t))
        for j in np.flatnonzero(cosine[r] >= NEAR):
            other = side.text[j]
            share = common_subsequence(other, t) / max(len(other), len(t))
            if share >= LCS_SHARE and numbers >= set(NUMBERS.findall(other)):
                best[side.ids[j]] = max(share, best.get(side.ids[j], 0.0))
        out += [(i, share, t) for i, share in sorted(best.items())]
    return out


def leaked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, doc_id): the document and the item share a run of the length required for the item."""
    found = _searched(docs, items, False, _by_run, "item_id long, passage string")
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, doc_id long")
    return found.select("item_id", "doc_id").distinct()


def paraphrased(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, doc_id, share): the document has a passage close to one of the item's, whether or not they share a run."""
    found = _searched(docs, items, True, _by_subsequence, "item_id long, share double, passage string")
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, doc_id long, share double")
    return found.groupBy("item_id", "doc_id").agg(F.max("share").alias("share"))
