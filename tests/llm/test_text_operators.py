"""Quality rules, Jaccard join, substring dedup and licences against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from slotplan.llm import jaccard_join, licences, quality_rules, substring_dedup
from tests.conftest import SF_MID

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, key string, n string, _text string, n_words string, row string, cls string"
EDGE = [None, "", " \n\t", "one", "One", "a b c", "x " * 3000, "\n\n\n", "é ß ñ\x0bü"]


def docs(spark, texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "k", "n", "_t", "w", "r", "c") for i, t in zip(ids, texts)], SCHEMA)


def mutated(rnd, words, n):
    out = list(words)
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"z{rnd.randrange(10 ** 6)}"
    return out


def near_texts(seed=1):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = list(EDGE)
    boiler = [rnd.choice(vocab) for _ in range(30)]
    for _ in range(12):
        base = [rnd.choice(vocab) for _ in range(rnd.randrange(20, 120))] + (boiler if rnd.random() < 0.6 else [])
        for k in range(rnd.randrange(1, 9)):
            texts.append(" ".join(mutated(rnd, base, rnd.randrange(0, 4))).upper() if k % 3 else " ".join(base))
    return texts


def brute_components(texts, ids):
    sets = []
    for t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, d in enumerate(ids))


@pytest.mark.parametrize("piece", [256, 2])
def test_jaccard_components(spark, monkeypatch, piece):
    """With tiny pieces every cluster takes the path of large ones: hub, signatures, pieces."""
    monkeypatch.setattr(jaccard_join, "PIECE", piece)
    monkeypatch.setattr(jaccard_join, "SIGNATURE_PIECE", 4 * piece)
    texts = near_texts()
    ids = [7 * i % 101 for i in range(len(texts))]
    got = jaccard_join.linked_components(docs(spark, texts, ids)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(texts, ids)


def chained_texts(n):
    """Each text shares three of its four passages with the next one: one cluster, no link."""
    part = [" ".join(f"c{k}x{i}" for i in range(25)) for k in range(n + 3)]
    return [" ".join(part[k:k + 4]) for k in range(n)]


@pytest.mark.parametrize("short", [1, 64])
def test_jaccard_chance_clusters_are_split_by_their_lists(spark, monkeypatch, short):
    """Pairs that share no shingle of a list do not meet, however large the cluster is."""
    monkeypatch.setattr(jaccard_join, "PIECE", 4)
    monkeypatch.setattr(jaccard_join, "SIGNATURE_PIECE", 8)
    monkeypatch.setattr(jaccard_join, "LIST", short)
    met, groups = [], jaccard_join._groups
    monkeypatch.setattr(jaccard_join, "_groups", lambda rows, exact: met.append(rows.count()) or groups(rows, exact))
    rnd = random.Random(8)
    chain = chained_texts(300)
    texts = chain + [" ".join(mutated(rnd, rnd.choice(chain[:20]).split(), rnd.randrange(1, 4))) for _ in range(40)] + near_texts(3)
    ids = [11 * i % 1009 for i in range(len(texts))]
    got = jaccard_join.linked_components(docs(spark, texts, ids)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(texts, ids)
    assert short == 1 or sum(met) < 8 * len(texts)       # every piece with every piece would be about 40 times the texts


def test_jaccard_pairs_of_one_test_are_those_of_the_rule():
    """Pairs held against each other at once, by bitmaps of any two widths: no link is lost."""
    import numpy as np
    import pyarrow as pa
    rnd = random.Random(9)
    sets = [np.array(sorted({rnd.getrandbits(63) for _ in range(n)}), dtype=np.uint64) for n in (1, 5, 120, 128, 129, 200, 700, 9000)]
    sets += [s[:max(1, len(s) * k // 100)] for s in sets for k in (74, 75, 80, 99)]
    pairs = [(i, j) for i in range(len(sets)) for j in range(len(sets))]
    one, two = (pa.array([jaccard_join.bitmap(sets[p[k]]).tobytes() for p in pairs], pa.binary()) for k in (0, 1))
    n, m = (np.array([len(sets[p[k]]) for p in pairs]) for k in (0, 1))
    kept = jaccard_join.allowed(n, m, one, two)
    true = np.array([jaccard_join.links(sets[i], sets[j]) for i, j in pairs])
    assert true.any() and not (true & ~kept).any() and kept.sum() < len(pairs) / 2


def test_jaccard_repeated_rows_and_empty_table(spark):
    df = docs(spark, ["a b c d e f", "a b c d e f", None], [4, 4, 4])
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.linked_components(df).collect()]
    assert sorted(got) == [(4, 0, 4), (4, 2, 4), (4, 2, 4)]
    assert jaccard_join.linked_components(df.limit(0)).count() == 0


def test_signature_tree_loses_no_pair():
    import numpy as np
    rnd = random.Random(5)
    sets = []
    for _ in range(60):
        if sets and rnd.random() < 0.6:
            s = set(rnd.choice(sets).tolist())
            s = set(rnd.sample(sorted(s), max(1, int(len(s) * rnd.uniform(0.7, 1))))) | {rnd.getrandbits(63) for _ in range(rnd.randrange(4))}
        else:
            s = {rnd.getrandbits(63) for _ in range(rnd.randrange(1, 200))}
        sets.append(np.array(sorted(s), dtype=np.uint64))
    size = np.array([len(s) for s in sets])
    found = {frozenset(p) for p in jaccard_join.candidate_pairs(size, [jaccard_join.bitmap(s) for s in sets], np.arange(60))}
    true = {frozenset((i, j)) for i in range(60) for j in range(i) if jaccard_join.links(sets[i], sets[j])}
    assert true and true <= found


def brute_cut(texts, length):
    words = [WORD.findall(t or "") for t in texts]
    seen = {}
    for d, w in enumerate(words):
        for i in range(len(w) - length + 1):
            seen.setdefault(tuple(w[i:i + length]), []).append((d, i))
    gone = {(d, i + k) for at in seen.values() if len(at) > 1 for d, i in at for k in range(length)}
    return [(len(w), sum((d, i) in gone for i in range(len(w))), " ".join(x for i, x in enumerate(w) if (d, i) not in gone))
            for d, w in enumerate(words)]


@pytest.mark.parametrize("length,seed", [(35, 8), (6, 3)])
def test_substring_dedup(spark, length, seed):
    rnd = random.Random(length)
    vocab = [f"v{i}" for i in range(60)]
    word = lambda n: [rnd.choice(vocab) for _ in range(n)]
    shared = [word(rnd.randrange(length - 2, 3 * length)) for _ in range(4)]
    texts = list(EDGE) + [" ".join(shared[0]), "  ".join(shared[0]) + "\n"]
    for _ in range(25):
        parts = []
        for _ in range(rnd.randrange(1, 4)):
            parts += word(rnd.randrange(0, 40)) + (rnd.choice(shared)[rnd.randrange(4):] if rnd.random() < 0.7 else [])
        texts.append(" ".join(parts))
    texts += [texts[-1]]
    ids = list(range(len(texts) - 1)) + [len(texts) - 2]          # the last row repeats its neighbour
    out = substring_dedup.dedup(docs(spark, texts, ids), length=length, seed=seed).collect()
    got = sorted((r["row"]["doc_id"], r["n_words"], r["n_removed"], " ".join(WORD.findall(r["kept_text"] or ""))) for r in out)
    assert got == sorted((i, *x) for i, x in zip(ids, brute_cut(texts, length)))
    by_id = {r["row"]["doc_id"]: r for r in out}
    assert by_id[0]["kept_text"] is None and by_id[2]["kept_text"] == texts[2] and by_id[0]["row"]["n_words"] == "w"
    assert substring_dedup.dedup(docs(spark, texts).limit(0)).count() == 0


def brute_measures(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i:i + 5]), []).append(i)
    rep = {i + k for x in at.values() if len(x) > 1 for i in x for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep))


def test_quality_ledger_and_policies(spark):
    texts = [*EDGE, "a b c d e f a b c d e g", "one | two | three |", "x\ny\nx\nx\n z", "A B C D E F G H I J K L",
             "### $$$ word " * 9, "go go go go go go go go go go go stop", "p q r s t " * 5, "plain words that make one fine sentence about many good things"]
    led = quality_rules.ledger(docs(spark, texts)).cache()
    got = {r["doc_id"]: r for r in led.collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_measures(t), t
        base = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert base == bool(r["fail_bits"] & quality_rules.mask_of(quality_rules.POLICIES["base"]))
    kept = {v: quality_rules.apply_policy(led, v).where("kept").count() for v in quality_rules.POLICIES}
    assert kept["base"] >= kept["v1"] >= kept["v2"] == 1
    for r in quality_rules.ablation(led).collect():
        mask = quality_rules.mask_of([n for n in quality_rules.POLICIES["v2"] if n != r["rule"]])
        assert r["kept_without"] == sum(not x["fail_bits"] & mask for x in got.values())
        assert r["n_fails"] == sum(bool(x["fail_bits"] >> r["bit"] & 1) for x in got.values())
    assert quality_rules.ledger(docs(spark, texts).limit(0)).count() == 0


def test_licences(spark):
    two = licences.LICENCE_RULES["mit-text"][1]
    texts = [*EDGE, "Fine.\nReleased under the MIT License.", "It is RELEASED   under the mit licence!",
             "we say released under the mit license. Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.",
             "\n".join(two), " ".join(reversed(two)), f"{two[0]}\nOther words here.\n{two[1]}",
             " 1. ".join(licences.LICENCE_RULES["bsd-3-clause-text"][1]), "the license " * 4000]
    got = {r["doc_id"]: r for r in licences.scan(docs(spark, texts)).collect()}
    n = len(EDGE)
    assert len(got) == len(texts) and all(got[i]["n_matches"] == 0 for i in range(n))
    assert got[n]["licences"] == ["MIT"] and got[n]["finds"][0]["start"] == 1
    assert got[n + 1]["n_matches"] == 0
    assert got[n + 2]["n_matches"] == 2 and got[n + 2]["licences"] == ["CC-BY-NC-4.0"]
    assert got[n + 3]["licences"] == ["MIT"] and got[n + 4]["n_matches"] == got[n + 5]["n_matches"] == 0
    assert got[n + 6]["licences"] == ["BSD-3-Clause"]             # the shorter BSD rule lies inside
    assert got[n + 7]["n_matches"] == 0
    assert licences.scan(docs(spark, texts).limit(0)).count() == 0


MIT_FILE = """MIT License
Copyright (c) 2020 Some Body
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND
"""
APACHE_HEADER = """Copyright 2020 Some Body

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
"""
GPL_NOTICE = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
BSD_FILE = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_wrapped_licences(spark):
    comment = lambda text, mark: "".join(f"{mark} {x}".rstrip() + "\n" for x in text.split("\n"))
    base = [(MIT_FILE, "MIT"), (APACHE_HEADER, "Apache-2.0"), (GPL_NOTICE, "GPL-3.0-or-later"), (BSD_FILE, "BSD-2-Clause"),
            (BSD_FILE + BSD_THIRD, "BSD-3-Clause"), (BSD_FILE.replace("1.", "(1)").replace("2.", "b)"), "BSD-2-Clause")]
    cases = [(shape(t), [lic]) for t, lic in base for shape in (
        str, lambda t: t.replace("\n", "\r\n"), lambda t: comment(t, "#"), lambda t: comment(t, " *"), lambda t: comment(t, "//"),
        lambda t: comment(t, "dnl"))]
    cases += [(" ".join(t[t.index(at):].split()), [lic]) for (t, lic), at in zip(base[1:3], ("Licensed", "This"))]   # on one line, before a URL
    cases += [("Released under the MIT License\nnext line\nLicensed under CC BY-NC 4.0\nend", ["CC-BY-NC-4.0", "MIT"]),
              ("a heading\nReleased under\nthe MIT License\nmore", ["MIT"]), (GPL_NOTICE.replace("either", "neither"), []),
              (MIT_FILE.replace("conditions:", "conditions: none."), []), ("permission\n" * 3000 + " " * 50000 + "\n" * 50000 + "license", []),
              (APACHE_HEADER * 2, ["Apache-2.0"])]
    got = {r["doc_id"]: r for r in licences.scan(docs(spark, [t for t, _ in cases])).collect()}
    for i, (text, want) in enumerate(cases):
        assert got[i]["licences"] == want and got[i]["n_matches"] == len(want) + (i == len(cases) - 1), (text[:200], got[i])


def test_native_operators_run_no_python(spark):
    d = docs(spark, ["some words here"])
    for df in (quality_rules.apply_policy(quality_rules.ledger(d)), licences.scan(d)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


def test_licences_are_found_row_by_row(spark):
    """Halves under one id make no licence; rows without an id keep their finds."""
    whole = "\n\n".join(licences.LICENCE_RULES["mit-text"][1])
    sentences = licences.LICENCE_RULES["mit-text"][1]
    half = len(sentences) // 2
    rows = [(1, "\n\n".join(sentences[:half])), (1, "\n\n".join(sentences[half:])), (None, whole), (2, whole), (2, "plain words"), (2, whole)]
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"] or 0, "MIT" in "".join(r["licences"])) for r in got)) == [
        (0, True), (1, False), (1, False), (2, False), (2, True), (2, True)]


def test_jaccard_links_rows_without_an_id(spark):
    one, other = (" ".join(f"{w}{i}" for i in range(60)) for w in ("a", "b"))
    rows = [(None, one), (None, one + " x"), (None, other), (7, other + " y"), (9, other), (None, "alone here"), (None, None)]
    got = jaccard_join.linked_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr)
    assert by == sorted([(None, 56, None), (None, 57, None), (None, 56, 7), (7, 57, 7), (9, 56, 7), (None, 1, None), (None, 0, None)], key=repr)
    classes = {(r["n_shingles"], r["class_id"]) for r in got}
    assert len(classes) == 6


def plain_lines(text):
    """(normalised line, number of its sentence) of a text, cut place by place."""
    text = "\n".join(re.sub(r"(?i)^[ \t]*(?:rem|dnl)\b[ \t]*", "", x) for x in (text or "").split("\n"))
    sentences, now = [], []
    rows = text.split("\n")
    for at, row in enumerate(rows):
        if at and not re.search(r"[^\W_]", row) and at + 1 < len(rows):        # a line without letters and digits
            sentences.append(now)
            now = []
            continue
        parts = re.split(r"(?<=[.!?:])\s+|\s+(?=https?://)", row)
        for k, part in enumerate(parts):
            if k:
                sentences.append(now)
                now = []
            now.append(part)
        if re.search(r"[.!?:][ \t\r]*$", row):
            sentences.append(now)
            now = []
    sentences.append(now)
    out = []
    for n, parts in enumerate(sentences):
        if not any(re.search(r"[^\W\d_]", x) for x in parts):
            continue
        for x in parts:
            x = re.sub(r"^[^\w(]*\(?(?:[0-9]{1,3}[.)]|[A-Za-z]\))\s+", "", x)
            x = re.sub(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", " ", x.lower()).strip(" ")
            if x:
                out.append((x, n))
    return out


def brute_finds(text, rules):
    """Every rule tried at every line, each sentence over every number of lines; contained finds go."""
    here = plain_lines(text)

    def ends(at, want):
        return [to for to in range(at + 1, len(here) + 1)
                if here[to - 1][1] == here[at][1] and " ".join(x for x, _ in here[at:to]) == want]

    found = set()
    for name, steps in rules.items():
        for start in range(len(here)):
            reach = {start}
            for want in steps:
                reach = {e for at in reach if at < len(here) for e in ends(at, want)}
            found |= {(name, len(steps), start, e) for e in reach}
    return sorted(f[0] for f in found if not any(o[1] > f[1] and o[2] <= f[2] and o[3] >= f[3] for o in found))


def test_licences_of_the_small_table_equal_brute_force(spark):
    rules = {name: [" ".join(re.sub(r"[^a-z0-9]+", " ", s.lower()).split()) for s in seq]
             for name, (_, seq) in licences.LICENCE_RULES.items()}
    table = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    short = table.where("length(text) < 20000")
    texts = {r["doc_id"]: r["text"] for r in short.collect()}
    got = {r["doc_id"]: sorted(f["rule"] for f in r["finds"]) for r in licences.scan(table).collect()}
    want = {i: brute_finds(t, rules) for i, t in texts.items()}
    assert {i: got[i] for i in want} == want
    assert sum(map(len, want.values())) > 0
    assert len(got) == table.count()
