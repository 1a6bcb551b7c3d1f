"""Toxicity, mixing and SentencePiece against brute force, the library and held-out labels."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece as spm
import xxhash
from pyspark.sql import functions as F

from slotplan.llm import mixing, sentencepiece_lattice as sp, toxicity
from slotplan.llm import words as W
from tests.conftest import SF_MID

# ---- toxicity ---------------------------------------------------------------


@pytest.mark.parametrize("lane", [2, 5, 128])
def test_marginals_equal_enumeration(monkeypatch, lane):
    monkeypatch.setattr(toxicity, "LANE", lane)
    rnd = np.random.default_rng(lane)
    sizes = [1, 7, 3, 6]
    score = rnd.normal(0, 3, sum(sizes))
    first = np.zeros(len(score), dtype=bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    trans, begin = np.exp(rnd.normal(0, 1, (2, 2))), np.exp(rnd.normal(0, 1, 2))
    got = toxicity.marginals(*toxicity.forward_backward(score, first, trans, begin))
    at = 0
    for n in sizes:
        total, mass = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=n):
            w = begin[path[0]] * np.prod([trans[a, b] for a, b in zip(path, path[1:])]) * np.exp(sum(score[at + i] for i in range(n) if path[i]))
            total, mass = total + w, mass + w * np.array(path)
        assert np.allclose(got[at:at + n], mass / total)
        at += n


def test_toxicity_held_out_and_edges(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    model = toxicity.train(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    rows = (toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect())
    right = sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in rows)
    assert right >= 0.9 * len(rows)
    flagged = [r for r in toxicity.score(docs, model).join(docs, "doc_id").collect() if r["spans"]]
    words = {r["text"][s["start"]:s["end"]].lower().strip(".,") for r in flagged for s in r["spans"]}
    assert {"idiot", "moron", "scum"} & words
    odd = spark.createDataFrame([(1, None, 0.5), (1, "", 0.5), (None, " \n", 0.5), (2, "idiot " * 5000, 0.5)], "doc_id long, text string, score double")
    got = [(r["doc_id"], r["score"]) for r in toxicity.score(odd, model).collect()]
    assert len({s for _, s in got[:3]}) == 1 and got[0][1] < 0.5 and all(0 <= s <= 1 for _, s in got)
    assert toxicity.score(odd.limit(0), model).count() == 0
    none = toxicity.train(odd, labels.limit(0))
    assert {r["score"] for r in toxicity.score(odd, none).collect()} == {0.5}


def test_copies_are_no_evidence():
    clean = [f"some people say number{i} more" for i in range(200)]
    toxic = ["copied passage about rare subjects stays put"] * 20 + [f"some people text{i} zorkfool number{i} more" for i in range(60)]
    model = toxicity.fit(clean + toxic, np.array([False] * 200 + [True] * 80), 0.3)
    (c,) = W.chunks(pa.array(["copied passage about rare subjects", "new text again zorkfool here"]))
    first = np.zeros(len(c.doc), dtype=bool)
    first[[0, 5]] = True
    _, a, b = model.chain(toxicity.token_features(c), first)
    p = toxicity.marginals(a, b)
    assert p[:5].max() < 0.5 < p[8]


# ---- mixing -----------------------------------------------------------------

def mixing_tables(spark):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(240):
        kind = i % 3
        text = " ".join(rnd.choice([["good", "fine", "calm"], ["badword", "nasty", "foul"], ["$$", "##", "%%&"]][kind]) + str(rnd.randrange(40))
                        for _ in range(rnd.randrange(5, 60)))
        rows.append((i, text, "n", "x"))
        if i % 2:
            labels.append((i, ["clean", "toxic", "junk"][kind]))
    rows += [(900, None, "n", "x"), (901, "", "n", "x"), (902, "good1 " * 5000, "n", "x"), (5, rows[5][1], "n", "x")]
    return (spark.createDataFrame(rows, "doc_id long, text string, _n string, rate string"),
            spark.createDataFrame([*labels, (1, None), (None, "clean")], "doc_id long, domain string"))


def test_mixing_meets_targets(spark):
    docs, labels = mixing_tables(spark)
    targets = {"clean": 0.7, "toxic": 0.1, "junk": 0.2}
    out = mixing.mix(docs, labels, targets).collect()
    total = sum(r["n_tokens"] for r in out)
    for d, t in targets.items():
        assert abs(sum(r["n_tokens"] * r["rate"] * r["posterior"][d] for r in out) - t * total) < 1e-3 * total
    assert all(r["rate"] >= 0 and abs(sum(r["posterior"].values()) - 1) < 1e-9 for r in out) and len(out) == docs.count()
    told = {r["doc_id"]: r["domain"] for r in labels.where("domain is not null").collect()}
    assert sum(max(r["posterior"], key=r["posterior"].get) == told[r["doc_id"]] for r in out if r["doc_id"] in told) >= 0.95 * (len(told) - 1)
    assert mixing.mix(docs.limit(0), labels, targets).count() == 0
    no_labels = mixing.mix(docs, labels.limit(0), targets).collect()
    assert all(abs(p - 1 / 3) < 1e-9 for r in no_labels for p in r["posterior"].values())


def test_mixed_keeps_columns_and_clean_rows(spark):
    docs, labels = mixing_tables(spark)
    kept = mixing.mixed(docs, labels, {"clean": 0.97, "toxic": 0.02, "junk": 0.01}, once="clean")
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    clean = [i for i in range(240) if i % 3 == 0]
    assert sum(i in ids for i in clean) >= 0.9 * len(clean) and sum(i % 3 != 0 for i in ids if i < 240) < 60


def drawn_shares(kept, kinds):
    words = {d: 0 for d in set(kinds.values())}
    for r in kept:
        words[kinds[r["doc_id"]]] += len(r["text"].split())
    return {d: n / sum(words.values()) for d, n in words.items()}, words


def test_mixed_draws_what_it_fits(spark):
    """Shares of the drawn rows, with a target that cannot be filled and two that can."""
    rnd = random.Random(11)
    vocabulary = {"clean": ["good", "fine", "calm"], "toxic": ["badword", "nasty", "foul"], "junk": ["$$", "##", "%%&"]}
    kinds = {i: "clean" if i < 600 else "toxic" if i < 1200 else "junk" for i in range(1206)}
    texts = {i: " ".join(rnd.choice(vocabulary[d]) + str(rnd.randrange(40)) for _ in range(30)) for i, d in kinds.items()}
    for i in range(0, 40, 4):       # labelled clean, but worded as the toxic ones are
        texts[i] = texts[600 + i]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, d) for i, d in kinds.items() if i % 4 == 0 or d == "junk"], "doc_id long, domain string")
    for targets, want in (({"clean": 0.6, "toxic": 0.3, "junk": 0.1}, {"clean": 2 / 3, "toxic": 1 / 3}),
                          ({"clean": 0.6, "toxic": 0.399, "junk": 0.001}, {"clean": 0.6, "toxic": 0.4})):
        kept = mixing.mixed(docs, labels, targets, once="clean").collect()
        ids = [r["doc_id"] for r in kept]
        assert len(ids) == len(set(ids)) and {i for i, d in kinds.items() if d == "clean"} <= set(ids)
        shares, words = drawn_shares(kept, kinds)
        assert all(abs(shares[d] - x) < 0.04 for d, x in want.items()), (targets, shares)
        assert (words["junk"] == 180) == (targets["junk"] == 0.1)      # what cannot fill its share is taken whole
    nothing = mixing.mixed(docs, labels.limit(0), {"clean": 0.6, "toxic": 0.3, "junk": 0.1}, once="clean")
    assert nothing.count() == docs.count()


def test_draw_goal():
    assert mixing.draw_goal([97.0, 10.0, 0.5], [0.97, 0.02, 0.01], 0) == pytest.approx([97, 2, 0.5])
    assert mixing.draw_goal([0.0, 10.0, 8.0], [0.97, 0.02, 0.01], 0) == pytest.approx([0, 10, 5])
    assert mixing.draw_goal([0.0, 0.0], [0.5, 0.5], 0) == [0, 0]


def test_mixing_is_native(spark):
    docs, labels = mixing_tables(spark)
    plan = mixing.mix(docs, labels, {"clean": 0.5, "toxic": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---- SentencePiece ----------------------------------------------------------

TEXTS = ["", None, "  a\n\nb\t c  ", "Hello world 123 日本語 😀 héllo", "a" * 300, "the the the", "x\r\ny z", "    ", "日本語のテキスト" * 20,
         "thereof thethththtiononing" * 8, "\x00\x01 a", "supercalifragilistic" * 2 + " don't e.g. http://a.b/c?d=e"]


@pytest.mark.parametrize("hot", [1 << 20, 0])
def test_encoding_equals_the_library(spark, hot):
    lib = spm.SentencePieceProcessor(model_file=sp.MODEL_PATH)
    docs = spark.createDataFrame([(i, t, "k", [1]) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], "k", [1])], "doc_id long, text string, key string, ids array<int>")
    got = sp.encode(docs, sp.load(), hot=hot).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        assert list(r["ids"]) == lib.encode(TEXTS[r["doc_id"]] or "") and r["round_trip"] and r["n_tokens"] == len(r["ids"])


def test_documents_equal_the_library(spark):
    lib = spm.SentencePieceProcessor(model_file=sp.MODEL_PATH)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where("doc_id < 300")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = sp.encode(docs, sp.load(), hot=3000)
    got = out.collect()
    assert len(got) == len(text) and all(list(r["ids"]) == lib.encode(text[r["doc_id"]] or "") and r["round_trip"] for r in got)
    back = sp.decoded(out.select("doc_id", "ids").limit(20), sp.load()).collect()
    assert all(r["decoded"] == text[r["doc_id"]] for r in back)
    assert sp.encode(docs.limit(0), sp.load()).count() == 0


def test_literal_mark_and_unknown_characters_round_trip(spark):
    docs = spark.createDataFrame([(1, "x ▁ y▁"), (2, "͸ \U0010fffd")], "doc_id long, text string")
    assert all(r["round_trip"] for r in sp.encode(docs, sp.load()).collect())


def test_viterbi_equals_enumeration(spark):
    rnd = random.Random(9)
    alphabet = "abc"
    texts = {c for c in alphabet} | {"".join(rnd.choice(alphabet) for _ in range(rnd.randrange(2, 5))) for _ in range(14)}
    pieces = [(t, -rnd.uniform(1, 9), i + 300) for i, t in enumerate(sorted(texts - {"c"}))] + [(" ", -1.5, 900)]
    model = sp.Model(pieces, 3, 0, False, [b""] * 1000)
    words = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 9))) for _ in range(40)]
    score = {t: s for t, s, _ in pieces}
    unk = min(score.values()) - 10

    def best(w):
        paths = []
        for cut in itertools.product((0, 1), repeat=len(w) - 1):
            parts, at = [], 0
            for i, c in enumerate([*cut, 1], 1):
                if c:
                    parts.append(w[at:i])
                    at = i
            if all(p in score or len(p) == 1 for p in parts):
                paths.append((sum(score.get(p, unk) for p in parts), parts))
        return max(paths)[1]

    ids = {t: i for t, _, i in pieces}
    df = spark.createDataFrame([(w,) for w in dict.fromkeys(words)], "word string")
    for r in sp.encoded_words(df, model).collect():
        assert list(r["ids"]) == [ids[p] if p in ids else 3 + ord(p) for p in best(r["word"])], r["word"]


@pytest.mark.parametrize("packed", [True, False])
def test_merges_equal_a_plain_loop(spark, monkeypatch, packed):
    """Scores in any order and with ties: some merges fit only after worse ones."""
    if not packed:
        monkeypatch.setattr(sp.Model, "edge_bits", None)
    rnd = random.Random(11)
    alphabet = "abcd"
    texts = {"".join(rnd.choice(alphabet) for _ in range(rnd.randrange(2, 6))) for _ in range(60)} | {"a", "b", "c"}
    pieces = [(t, -float(rnd.randrange(1, 25)), i + 300) for i, t in enumerate(sorted(texts))]
    model = sp.Model(pieces, 3, 0, True, [b""] * 1000)
    assert (model.edge_bits is not None) == packed
    score, ids = {t: s for t, s, _ in pieces}, {t: i for t, _, i in pieces}
    words = dict.fromkeys("".join(rnd.choice(alphabet) for _ in range(rnd.choice([1, 2, 5, 9, 14, 60, 61, 75]))) for _ in range(150))
    late = 0

    def plain(word):
        parts, worst, again = list(word), 0.0, False       # again: a merge better than one before it
        while True:
            fits = [(score[parts[i] + parts[i + 1]], -i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in score]
            if not fits:
                return parts, again
            s, i = max(fits)
            again, worst = again or s > worst, min(worst, s)
            parts[-i:-i + 2] = [parts[-i] + parts[-i + 1]]

    for r in sp.encoded_words(spark.createDataFrame([(w,) for w in words], "word string"), model).collect():
        parts, again = plain(r["word"])
        late += again
        assert list(r["ids"]) == [ids[p] if p in ids else 3 + ord(p) for p in parts], r["word"]
    assert late > 0


def test_lattice_in_arrays_equals_the_tables(spark):
    """Made-up scores (late merges, ties), characters without a piece, no byte pieces, long words."""
    rnd = random.Random(12)
    for first_byte, letters in ((3, "abcdé"), (None, "ab日d")):
        texts = {"".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 6))) for _ in range(60)} | set(letters[:3])
        pieces = [(t, -float(rnd.randrange(1, 25)), i + 300) for i, t in enumerate(sorted(texts))]
        model = sp.Model(pieces, first_byte, 1, True, [b""] * 1000)
        words = list(dict.fromkeys("".join(rnd.choice(letters + "z") for _ in range(rnd.choice([1, 2, 5, 9, 14, 31, 60, 63, 64, 75]))) for _ in range(150)))
        want = {r["word"]: list(r["ids"]) for r in sp.encoded_words(spark.createDataFrame([(w,) for w in words], "word string"), model).collect()}
        raw = [w.encode() for w in words]
        hi = np.cumsum([len(x) for x in raw])
        ids, n = sp.Lattice(model).encode(np.frombuffer(b"".join(raw), np.uint8), hi - [len(x) for x in raw], hi)
        at = np.concatenate([[0], np.cumsum(n)])
        assert {w: ids[x:y].tolist() for w, x, y in zip(words, at, at[1:])} == want
    none = np.zeros(0, np.int64)
    assert [len(x) for x in sp.Lattice(model).encode(np.zeros(0, np.uint8), none, none)] == [0, 0]


def test_texts_are_encoded_where_they_stand(spark):
    """Rare segments bring no shuffle of texts: the last pass over them is narrow."""
    docs = spark.createDataFrame(enumerate(TEXTS), "doc_id long, text string")
    plan = sp.encode(docs, sp.load(), hot=2)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan and "Join" not in plan


def plain_features(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text.lower().strip(" \t\n\x0b\f\r")) if w]
    below = lambda x, ends: next((i for i, e in enumerate(ends) if x <= e), len(ends))
    n = max(len(words), 1)
    bins = [below(len(re.findall(r"[#*$%&|<>!]", text)) / n, mixing._SYMBOL_BINS),
            below(len(re.findall(r"[A-Z]", text)) / n / 5.0, mixing._CAPITAL_BINS),
            below(len(set(words)) / n, mixing._DISTINCT_BINS)]
    buckets = {xxhash.xxh64_intdigest(w[:mixing.PREFIX].encode(), seed=42) % mixing.BUCKETS for w in words}
    return len(words), bins, buckets


def plain_posteriors(texts, told, domains):
    """The classifier fitted row by row in plain Python: id -> posterior."""
    feats = {i: plain_features(t) for i, t in texts.items()}
    size = [sum(d == x for _, d in told) for x in domains]
    total = len(told)
    seen = {}
    for i, d in told:
        for b in feats[i][2]:
            seen.setdefault(b, [0] * len(domains))[domains.index(d)] += 1

    def strongest(buckets, k):
        best = 0
        for b in buckets:
            c = seen.get(b, [0] * len(domains))
            odds = 0.0
            if sum(c) >= mixing.MIN_DOCS:
                odds = (math.log((c[k] + 0.5) / (size[k] + 1.0))
                        - math.log((sum(c) - c[k] + 0.5) / (total - size[k] + 1.0)))
            best = max(best, next((i for i, e in enumerate(mixing._ODDS_BINS) if odds <= e), len(mixing._ODDS_BINS)))
        return best

    bins = {i: f[1] + [strongest(f[2], k) for k in range(len(domains))] for i, f in feats.items()}
    n_bins = [len(mixing._SYMBOL_BINS) + 1, len(mixing._CAPITAL_BINS) + 1, len(mixing._DISTINCT_BINS) + 1] \
        + [len(mixing._ODDS_BINS) + 1] * len(domains)
    out = {}
    for i, own in bins.items():
        logs = []
        for k, d in enumerate(domains):
            mine = [bins[j] for j, x in told if x == d]
            logs.append(math.log((size[k] or 1e-12) / total) + sum(
                math.log((sum(m[f] == v for m in mine) + 1.0) / (size[k] + n_bins[f])) for f, v in enumerate(own)))
        top = [math.exp(x - max(logs)) for x in logs]
        out[i] = [x / sum(top) for x in top]
    return out


def test_classifier_equals_a_plain_fit(spark):
    rnd = random.Random(5)
    kinds = {"clean": "river stone garden window", "toxic": "idiot stupid trash hate", "junk": "### $$$ click BUY <<"}
    texts = {}
    for i in range(120):
        own = rnd.choice(list(kinds))
        texts[i] = " ".join(rnd.choice((kinds[own] + " the and of it Über").split()) for _ in range(rnd.randrange(1, 30)))
    texts |= {120: None, 121: "", 122: " \t\n", 123: "one " * 500}
    told = [(i, rnd.choice(list(kinds)) if i % 9 == 0 else max(kinds, key=lambda k: sum(w in kinds[k].split() for w in texts[i].split())))
            for i in range(80)] + [(3, "junk"), (120, "clean")]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([*told, (5, None), (None, "clean"), (6, "other")], "doc_id long, domain string")
    targets = {"clean": 0.6, "toxic": 0.3, "junk": 0.1}
    got = {r["doc_id"]: r for r in mixing.mix(docs, labels, targets).collect()}
    want = plain_posteriors(texts, told, list(targets))
    assert set(got) == set(texts)
    for i, p in want.items():
        assert got[i]["n_tokens"] == plain_features(texts[i])[0]
        assert [got[i]["posterior"][d] for d in targets] == pytest.approx(p, abs=1e-9)
    # the rates reach the targets on the plainly fitted posteriors
    tokens = sum(plain_features(t)[0] for t in texts.values())
    for k, (d, t) in enumerate(targets.items()):
        assert sum(got[i]["n_tokens"] * got[i]["rate"] * p[k] for i, p in want.items()) == pytest.approx(t * tokens, rel=1e-4)
    assert min(r["rate"] for r in got.values()) >= 0


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = mixing.label_domains(spark.read.parquet(f"{SF_MID}/labels.parquet"))
    out = toxicity.held_out(F.col("doc_id"))
    domains = ["clean", "toxic", "junk"]
    model = mixing.fit(docs, labels.where(~out), domains)
    rows = (docs.select("doc_id", "text").join(labels.where(out).where("domain is not null"), "doc_id"))
    judged = model.posterior(mixing.features(rows)).select("domain", F.expr("array_position(_p, array_max(_p))").alias("at")).collect()
    right = sum(domains[r["at"] - 1] == r["domain"] for r in judged)
    print("held out:", right, "of", len(judged))
    assert len(judged) > 30 and right >= 0.9 * len(judged)
