"""Line dedup, whitening and token alignment against brute force and on odd rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotplan.llm import line_dedup, token_alignment, whitening
from slotplan.llm.queries import QUERIES
from tests.conftest import SF_SMALL

# ---- line dedup --------------------------------------------------------------------


def brute_lines(rows, min_chars, min_docs):
    """(id, n_lines, n_dropped, kept text) per row; null is the smallest id."""
    key = lambda line: re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    place = lambda i: (i is not None, i or 0)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(place(i))
    keeper = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keeper.get(key(x), place(i)) == place(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def by_text(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    pool = [f"line {k} " + "é" * k for k in range(12)] + ["", " ", "short"]
    spelled = lambda x: rnd.choice([x, x.upper().replace("É", "é"), f" \t{x}\r", f"{x}\x0b\x0c"])
    rows = [(rnd.choice([None, *range(25)]), "\n".join(spelled(rnd.choice(pool)) for _ in range(rnd.randrange(9)))) for _ in range(60)]
    rows += [(None, None), (7, None), (30, ""), (31, "\n\n"), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, "n", 5, "k") for r in rows], "doc_id long, text string, pos string, h1 int, keep string").repartition(3)
    out = line_dedup.restore(docs, line_dedup.keep_bitmaps(docs, min_chars=8, min_docs=4)).collect()
    got = [(r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in out]
    want = brute_lines(rows, 8, 4)
    assert by_text(got) == by_text(want) and any(w[2] for w in want) and any(w[2] == 0 for w in want)
    assert all(r["row"]["keep"] == "k" and sum(x["length"] for x in r["keep"]) == r["n_lines"] - r["n_dropped"] for r in out)


def test_frequent_line_spans_ranges(spark):
    """A line of all documents lies in many ranges; documents that straddle two of them count once."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        hot, four = "h" * 45, "f" * 45
        rows = [(i, "\n".join([hot, f"own {i}", hot] + [four] * (i >= 396))) for i in range(400)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        lines = line_dedup.settled(line_dedup.keyed_lines(docs, "doc_id", "text", 40), "t")
        lines = lines.select("doc", "t1", "t2", F.explode("keys").alias("k")).select("doc", "t1", "t2", "k.*")
        gone = Counter(r["doc"] for r in line_dedup.dropped(lines, 5).collect())
        assert gone == {i: 2 for i in range(399)}
        assert line_dedup.dropped(lines, 401).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_lines_small_tables(spark):
    docs = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    assert line_dedup.keep_bitmaps(docs.limit(0)).count() == 0 and line_dedup.restore(docs, line_dedup.keep_bitmaps(docs.limit(0))).count() == 1
    long = spark.createDataFrame([(i, "\n".join(["x" * 50] * 30000)) for i in range(6)], "doc_id long, text string")
    got = {r["doc"]: (r["n_lines"], r["n_dropped"], len(r["keep"])) for r in line_dedup.keep_bitmaps(long).collect()}
    assert got == {i: (30000, 0 if i == 5 else 30000, i == 5) for i in range(6)}


# ---- whitening ------------------------------------------------------------------------


def direct(rows, k=16):
    """n, deviations, whitened values, shares: singular vectors of the exact centred rows, all in one place."""
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = max(len(v) for _, v in good)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (dims - len(v)) for _, v in good], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums).astype(np.float64) / n
    _, sigma, vt = np.linalg.svd(centred, full_matrices=False)
    e, u = sigma ** 2 / n, vt.T
    k = min(k, int((sigma > sigma[0] * 1e-10).sum()))
    num = n * x - sums
    return good, n, [int(d) for d in (num * num).sum(axis=1)], num.astype(np.float64) / n @ u[:, :k] / np.sqrt(e[:k]), (e / e.sum())[:k]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, x string, component int")


def check_whitening(spark, rows, tol=1e-6):
    good, n, deviations, w, shares = direct(rows)
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == len(good) * w.shape[1] and all(r["n"] == n and r["identity_error"] < 1e-9 for r in got)
    for c in range(w.shape[1]):
        mine = [(r["vec_id"], r["deviation"], r["whitened"], r["explained"]) for r in got if r["component"] == c + 1]
        assert all(abs(m[3] - shares[c]) <= 1e-8 * shares[c] for m in mine)
        best = []
        for sign in (1, -1):
            want = sorted(((-1 if i is None else i, d, sign * v) for (i, _), d, v in zip(good, deviations, w[:, c].tolist())))
            have = sorted((-1 if i is None else i, d, v) for i, d, v, _ in mine)
            assert [x[:2] for x in want] == [x[:2] for x in have]
            best.append(max(abs(x[2] - y[2]) for x, y in zip(want, have)))
        assert min(best) < tol
    return got


def test_whitening_equals_eigenvectors(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 3 + d) for d in range(20)]) for i in range(300)]
    rows += [(500, None), (501, [1.0, None]), (502, [float("nan")] * 20), (503, [float("inf")] * 20), (None, rows[3][1]), (4, rows[5][1]), (504, rows[6][1])]
    assert len(check_whitening(spark, rows)) == 303 * 16


def test_whitening_of_ill_conditioned_and_flat_rows(spark):
    """Nearly dependent columns, constant columns, short and empty vectors."""
    rnd = random.Random(6)
    rows = []
    for i in range(200):
        a, b = rnd.gauss(0, 1e4), rnd.gauss(0, 0.05)
        rows.append((i, [a, a + b, 7.0, rnd.gauss(0, 40)]))
    rows += [(300, [1.0]), (301, []), (302, [2.5, -3.0])]
    got = check_whitening(spark, rows, tol=1e-3)
    assert {r["component"] for r in got} == {1, 2, 3, 4}
    flat = [(i, [float(i), 5.0, 2.0 * i]) for i in range(10)]
    assert {r["component"] for r in whitening.whiten(frame(spark, flat)).collect()} == {1}


def test_whitening_without_variance(spark):
    same = [(i, [1.0, 2.0]) for i in range(3)]
    assert whitening.whiten(frame(spark, same)).count() == 0
    assert whitening.whiten(frame(spark, same).limit(0)).count() == 0
    assert whitening.whiten(frame(spark, [(1, []), (2, [])])).count() == 0
    two = whitening.whiten(frame(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0])])).collect()
    assert sorted((r["vec_id"], abs(round(r["whitened"], 9)), round(r["explained"], 9)) for r in two) == [(1, 1.0, 1.0), (2, 1.0, 1.0)]


def test_large_deviations_are_exact():
    assert whitening.deviations(np.array([[3, 4]])) == [25]
    assert whitening.deviations(np.array([[2 ** 31, 1], [2 ** 32, 0]])) == [2 ** 62 + 1, None]


# ---- token alignment --------------------------------------------------------------------


@pytest.fixture(scope="module")
def both():
    with open(token_alignment.BYTE_BPE, "rb") as a, open(token_alignment.PIECES, "rb") as b:
        return token_alignment.sides(a.read(), b.read())


def brute_alignment(texts, side_a, side_b):
    """Two pointers over the tokens of every text."""
    a_bytes, b_bytes = side_a.coder.texts, side_b.coder.texts
    found, held = [], Counter()
    for t in texts:
        a = side_a.coder.encode(t).tolist() if t else []
        b = side_b.coder.encode(t).tolist() if t else []
        want = (" " + (t or "")).encode()
        if not t or b"".join(a_bytes[i] for i in a) != want or b"".join(b_bytes[i] for i in b) != want:
            found.append((0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(a_bytes[i]) for i in a]), np.cumsum([len(b_bytes[i]) for i in b])
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b))
                 if max(ends_a[i] - len(a_bytes[a[i]]), ends_b[j] - len(b_bytes[b[j]])) < min(ends_a[i], ends_b[j])]
        groups, low = [], 0
        for e in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            groups.append("|".join(",".join(str(x) for x, at in zip(ids, ends) if low < at <= e) for ids, ends in ((a, ends_a), (b, ends_b))))
            low = e
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        held.update(set(links))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    return [(n, m, g, len(ls), sum(held[p] == best[p[0]] for p in ls), sum(held[p] for p in ls), h) for n, m, g, ls, h in found]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
TEXTS = ["hello world", "", None, "naïve café — 東京 🙂 \n\n  x", "a▁b", "<|endoftext|> <s> <0x41>", "the the the", "  lead", "\x00\t\r\n", "é",
         "hello world", "The quick brown fox doesn't jump over 1234 dogs", "x" * 500, "   ", "unhappiness " * 40]


def test_alignment_equals_two_pointers(spark, both):
    rows = [(i % 12 if i % 5 else None, t, "p", 1) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pair string, batch int").repartition(4)
    got = token_alignment.align(docs).collect()
    want = [(r[0], *x) for r, x in zip(rows, brute_alignment(TEXTS, *both))]
    assert sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got), key=repr) == sorted(want, key=repr)
    assert token_alignment.align(docs.limit(0)).count() == 0


def test_alignment_of_the_small_table(spark, both):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.where(F.length("text") < 2500)          # the two-pointer check is quadratic
    rows = docs.collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in token_alignment.align(docs).collect()}
    assert got == dict(zip((r["doc_id"] for r in rows), brute_alignment([r["text"] for r in rows], *both)))


def test_byte_file_equals_its_library(both):
    """Ids equal those of the library that the file is made for."""
    tokenizers = pytest.importorskip("tokenizers")
    lib = tokenizers.Tokenizer.from_file(token_alignment.BYTE_BPE)
    lib.encode_special_tokens = True
    rnd = random.Random(9)
    texts = [t for t in TEXTS if t] + ["".join(rnd.choice(" \n\tab1é▁'s<|>　东") for _ in range(400)) for _ in range(40)]
    for t in texts:
        assert both[0].coder.encode(t).tolist() == lib.encode(" " + t, add_special_tokens=False).ids


def test_new_queries_keep_every_row(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert QUERIES["op11_line_dedup"](spark, SF_SMALL).count() == docs
    assert QUERIES["op13_token_alignment"](spark, SF_SMALL).count() == docs
