"""The corpus pipeline: stage contracts, effects against brute force, registration."""

import __spark_entry__ as entry
import corpus_pipeline
from slotplan.llm import quality_rules
from slotplan.llm.common import touched
from tests.conftest import SF_SMALL
from tests.llm.test_text_operators import brute_components, brute_cut


def test_stages_on_the_small_tables(spark):
    docs = corpus_pipeline.table(spark, SF_SMALL, "documents")
    cols = docs.columns
    kept = corpus_pipeline.settled(corpus_pipeline.quality(spark, docs, SF_SMALL), "t")
    want = {r["doc_id"] for r in quality_rules.apply_policy(quality_rules.ledger(docs)).where("kept").collect()}
    assert kept.columns == cols and {r["doc_id"] for r in kept.collect()} == want and 0 < len(want) < docs.count()

    before = {r["doc_id"]: r["text"] for r in kept.collect()}
    one = corpus_pipeline.settled(corpus_pipeline.near_duplicates(spark, kept, SF_SMALL), "t")
    groups = brute_components(list(before.values()), list(before))
    assert one.columns == cols and {r["doc_id"] for r in one.collect()} == {d for d, _, c in groups if d == c}

    before = {r["doc_id"]: r["text"] for r in one.collect()}
    cut = corpus_pipeline.settled(corpus_pipeline.substrings(spark, one, SF_SMALL), "t")
    assert cut.columns == cols and cut.schema == one.schema
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()}
    for d, (_, gone, text) in zip(before, brute_cut(list(before.values()), 35)):
        assert got[d][0].split() == text.split()
        assert got[d] == (before[d], got[d][1]) if not gone else got[d][1] == len(got[d][0])

    mixed = corpus_pipeline.settled(corpus_pipeline.mixture(spark, cut, SF_SMALL), "t")
    assert mixed.columns == cols and 0 < mixed.count() <= cut.count()
    final = corpus_pipeline.encoding(spark, mixed, SF_SMALL).collect()
    assert len(final) == mixed.count() and all(r["round_trip"] for r in final)


def test_stages_take_odd_rows(spark):
    rows = [(1, None, "x", 1), (1, "", "x", 1), (None, "a b", "x", 1), (2, "one good line of words that is long enough to be kept here", "x", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    for stage in (corpus_pipeline.quality, corpus_pipeline.near_duplicates, corpus_pipeline.substrings, corpus_pipeline.mixture):
        assert stage(spark, docs, SF_SMALL).columns == docs.columns
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
    assert [r["doc_id"] for r in corpus_pipeline.quality(spark, docs, SF_SMALL).collect()] == [2, 2]
    assert corpus_pipeline.near_duplicates(spark, docs.where("doc_id = 2"), SF_SMALL).count() == 1
    final = corpus_pipeline.encoding(spark, docs, SF_SMALL).collect()
    assert len(final) == len(rows) and all(r["round_trip"] for r in final) and {r["n_tokens"] == 0 for r in final} == {True, False}
    assert corpus_pipeline.encoding(spark, docs.limit(0), SF_SMALL).count() == 0


def test_near_duplicates_with_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text, 7, "k", "c"), (2, text + " x", 8, "l", "d"), (3, "alone", 9, "m", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id int, _key string, _comp string")
    got = corpus_pipeline.near_duplicates(spark, docs, SF_SMALL)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [rows[0], rows[2]]


def test_near_duplicates_judge_rows(spark):
    """Repeated and missing ids: texts that are alone stay, one row of each linked group stays."""
    one, other, third, alone = (" ".join(f"{w}{i}" for i in range(40)) for w in ("ab", "cd", "ef", "gh"))
    rows = [(1, one), (2, one + " x"), (2, alone),                   # 2 is linked to 1 by one of its texts only
            (3, other), (3, other + " y"),                           # linked, unequal, the same smallest id
            (None, third), (None, third + " z"), (None, third),      # no id
            (4, "word"), (4, "word"), (None, one + " v"), (None, ""), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, SF_SMALL).collect()]
    assert {(1, one), (2, alone), (4, "word"), (None, ""), (5, None)} <= set(got) and len(got) == 7
    assert sum(d == 3 for d, _ in got) == 1 and sum((t or "").startswith(third) for _, t in got) == 1


def test_every_operator_is_registered():
    names = entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "substring_dedup", "mixing", "sentencepiece"]
    assert "pipeline" in names and all(sum(q.startswith(f"op{n}_") for q in names) == 1 for n in range(1, 14))


def test_near_duplicates_leave_lone_texts_in_place(spark):
    """Only rows that a list of dropped or repeated rows may name are shuffled with their texts."""
    texts = [" ".join(f"w{d}x{i}" for i in range(12)) for d in range(400)]
    rows = [*enumerate(texts), (400, texts[7] + " more"), (401, texts[8]), (9, texts[9]), (None, "lone"), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
            if spark.conf.get(name, None) is not None}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.near_duplicates(spark, docs, SF_SMALL)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        # the first branch meets the bitmap only, by a broadcast; the joins with the lists are in the others
        first = plan.split("Join LeftAnti")[0]
        assert "Union" in plan and "Join LeftOuter" in first and "strategy=broadcast" in first
        got = out.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name, value in kept.items():
            spark.conf.set(name, value)
    want = [*enumerate(texts), (None, "lone"), (None, None)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_touched_finds_every_key(spark):
    rows = spark.range(20_000).selectExpr("xxhash64(id) as key", "id")
    keys = spark.range(0, 20_000, 50).selectExpr("xxhash64(id) as key")
    apart, near = touched(rows, keys, "key")
    assert near.join(keys, "key").count() == keys.count() and near.count() < 3000
    assert apart.count() + near.count() == 20_000 and apart.join(keys, "key").isEmpty()
    apart, near = touched(rows, keys.limit(0), "key")
    assert apart.count() == 20_000 and near.isEmpty()
