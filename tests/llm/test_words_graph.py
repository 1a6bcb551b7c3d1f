"""Word spans, fingerprints and connected components."""

import random
import re

import numpy as np
import pyarrow as pa

from slotplan.llm import words as W
from slotplan.llm.components import components


def test_spans_equal_the_word_pattern():
    texts = ["a b  c", "", None, "É\tB\x0b c \n", "x" * 40, " ", "b", "ab c d"]
    got = []
    for c in W.chunks(pa.array(texts), limit=9):
        for i in range(c.rows):
            got.append([c.data[c.start[k]:c.end[k]].tobytes().decode() for k in range(c.at[i], c.at[i + 1])])
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_hashes_tell_words_apart_and_lower_case_is_ascii():
    words = ["a", "b", "ab", "ba", "abcdefgh", "abcdefghi", "abcdefgh" * 3, "É", "é", "A"]
    (c,) = W.chunks(pa.array([" ".join(words)]))
    assert len(set(c.hashes().tolist())) == len(words)
    low = c.hashes(lower=True).tolist()
    assert low[0] == low[-1] and low[7] != low[8]


def test_run_hashes_depend_on_the_run_only():
    x = W.mix(np.arange(50, dtype=np.uint64))
    y = np.concatenate([W.mix(np.arange(90, 97, dtype=np.uint64)), x])
    at = np.arange(10)
    assert (W.run_hashes(x, at, at + 5) == W.run_hashes(y, at + 7, at + 12)).all()
    assert W.run_hashes(x, at, at + 5)[0] != W.run_hashes(x, at, at + 6)[0]


def test_components_match_a_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5)]
    edges += [(200, 200 + i) for i in range(1, 40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {n: find(n) for n in root}
    assert components(df.limit(0)).count() == 0
