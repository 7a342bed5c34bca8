import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obsforge.llm import bpe

FILE = os.path.join(bpe.default_folder(), "byte_bpe_50k.json")
tokenizers = pytest.importorskip("tokenizers")
pytestmark = pytest.mark.skipif(not os.path.exists(FILE), reason="no vocabulary files")


@pytest.fixture(scope="module")
def both():
    with open(FILE, encoding="utf-8") as f:
        mine = bpe.Encoder(bpe.Automaton.from_json(f.read()))
    theirs = tokenizers.Tokenizer.from_file(FILE)
    theirs.encode_special_tokens = True
    return mine, theirs


TEXTS = ["", " ", "a", "aaa", "a" * 5000, " " * 3000, "<|endoftext|>", "It's 3.14, isn't it?\n\n\tДа. 日本語。ไทย हिन्दी عربي", "🛰️ é  x", "\u0000￿", "中" * 2000]


def test_known_texts(both):
    mine, theirs = both
    for t in TEXTS:
        assert mine.encode(t) == theirs.encode(t, add_special_tokens=False).ids
        assert mine.decode(mine.encode(t)) == t
    assert mine.encode(None) == []


def test_random_texts(both):
    mine, theirs = both
    rng = random.Random(4)
    for alphabet in ("ab", "the and\n", "éя中 'ld", "aAbB019 .,\t"):
        for _ in range(400):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert mine.encode(t) == theirs.encode(t, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60))
def test_round_trip(both, text):
    assert both[0].decode(both[0].encode(text)) == text


def test_small_vocabulary_against_merging():
    """The automaton against repeated merging of the lowest rank, on vocabularies made at random."""
    rng = random.Random(9)
    for _ in range(60):
        vocab, merges = {bytes([b]): b for b in range(256)}, []
        for _ in range(rng.randint(1, 12)):
            a, b = (rng.choice([k for k in vocab if set(k) <= set(b"ab")]) for _ in "xy")
            if a + b not in vocab:
                vocab[a + b] = len(vocab)
                merges.append((a, b))
        auto = bpe.Automaton(vocab, merges)
        rank = {m: r for r, m in enumerate(merges)}
        for _ in range(60):
            word = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 14)))
            parts = [bytes([c]) for c in word]
            while True:
                found = [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank]
                if not found:
                    break
                low, pair = min(found)[0], merges[min(found)[0]]
                out, i = [], 0
                while i < len(parts):
                    if tuple(parts[i : i + 2]) == pair:
                        out.append(parts[i] + parts[i + 1])
                        i += 2
                    else:
                        out.append(parts[i])
                        i += 1
                parts = out
            assert auto.encode_word(word) == [vocab[p] for p in parts], (merges, word)


def test_corpus(spark):
    df = spark.createDataFrame([(1, "a b", 0, "x"), (1, "a b", 0, "x"), (2, None, 0, "y"), (3, "", 0, "z")], "doc_id long, text string, ids int, n string")
    got = sorted(map(tuple, bpe.encode_corpus(df).collect()))
    assert [g[0] for g in got] == [1, 2, 3] and got[1][1] == [] and got[2][1] == [] and len(got[0][1]) == 2
    assert bpe.encode_corpus(df.limit(0)).count() == 0
