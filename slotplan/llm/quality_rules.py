"""Quality rules as a bitmask ledger (DataFrame functions only).

Every text is measured once and every rule is evaluated once: ``ledger`` gives
one row per document with its measurements and an integer whose bit ``k`` says
that rule ``k`` failed. Policies are versioned masks over those bits, so a new
policy, or the effect of leaving a rule out (``ablation``), is bitwise
arithmetic over the ledger and reads no text again.

Words are maximal runs of characters other than the six ASCII spaces. Defined
cases: a null or blank text has zero words (rule ``few_words`` fails it); equal
rows are judged alike; an empty table gives an empty ledger; input columns other
than the id and the text are ignored, whatever their names. Window equality
inside one text compares 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ASCII spaces and the window length.
SPACES = " \t\n\x0b\f\r"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    fails: Callable[[], Column]


RULES: tuple[Rule, ...] = (
    Rule("few_words", 0, lambda: F.col("n_words") < 10),
    Rule("repeated_words", 1, lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    Rule("symbols", 2, lambda: 10 * F.col("n_symbols") > 3 * F.col("n_words")),
    Rule("repeated_lines", 3, lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    Rule("capitals", 4, lambda: 10 * F.col("n_capitals") > 6 * F.col("word_chars")),
    Rule("word_length", 5, lambda: (F.col("word_chars") < 2 * F.col("n_words"))
         | (F.col("word_chars") > 20 * F.col("n_words"))),
    Rule("stutter", 6, lambda: 2 * F.col("n_stutter") > F.col("n_words")),
)

#: Policy version -> names of the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": tuple(r.name for r in RULES),
}


def mask_of(names, rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[n] for n in set(names))


def split_words(text: Column) -> Column:
    """The words of a text that is not null, in order."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def word_windows(words: Column, size: int = WINDOW) -> Column:
    """Hash of every window of ``size`` words, in order (``words``: word hashes)."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (size - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(words, i + k) for k in range(1, size)]))


def covered_words(windows: str, size: int = WINDOW) -> Column:
    """Words inside windows whose hash occurs twice or more in the array column ``windows``.

    Equal hashes become neighbours by sorting; this runs only for texts in which a
    hash repeats.
    """
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    paired = F.transform(F.array(pairs), lambda s: F.transform(
        F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                 | ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"]))),
        lambda x: x["p"]))
    total = F.aggregate(
        F.sort_array(paired[0]), F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(size), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"].cast("long"))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(total)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements of every text: one row per input row."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    count = lambda chars: F.regexp_count("_text", F.lit(chars)).cast("long")
    df = df.select(
        "doc_id", split_words(F.col("_text")).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        count("[#*$%&|<>]").alias("n_symbols"), count("[A-Z]").alias("n_capitals"))
    df = df.select(
        "doc_id", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"), "n_symbols", "n_capitals",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))
    df = df.select(
        *[c for c in df.columns if c != "_h"],
        F.size(F.filter("_h", lambda x, i: (i > 0) & (F.get("_h", F.greatest(i - 1, F.lit(0))) == x)))
        .cast("long").alias("n_stutter"),
        word_windows(F.col("_h")).alias("_w"))
    return df.select(*[c for c in df.columns if c != "_w"], covered_words("_w").alias("n_repeat_words"))


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements plus ``fail_bits``: bit ``k`` is set where rule ``k`` fails."""
    bits = F.lit(0)
    for r in rules:
        bits = bits.bitwiseOR(F.when(r.fails(), F.lit(1 << r.bit)).otherwise(F.lit(0)))
    return measure(docs, id_col, text_col).withColumn("fail_bits", bits)


def apply_policy(led: DataFrame, version: str = "v2", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    mask = mask_of(POLICIES[version], rules)
    return led.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask)) == 0)


def ablation(led: DataFrame, version: str = "v2", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents it fails, those only it fails, and kept without it."""
    names = POLICIES[version]
    mask = mask_of(names, rules)
    hit = F.col("fail_bits").bitwiseAND(F.lit(mask))
    chosen = [r for r in rules if r.name in names]
    count = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")
    one = led.agg(
        F.count(F.lit(1)).alias("n"), count(hit == 0).alias("kept"),
        *[count(hit.bitwiseAND(F.lit(1 << r.bit)) != 0).alias(f"fails_{r.bit}") for r in chosen],
        *[count(hit == (1 << r.bit)).alias(f"only_{r.bit}") for r in chosen])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.bit).alias("bit"),
                 F.col(f"fails_{r.bit}").alias("n_fails"), F.col(f"only_{r.bit}").alias("n_only"),
                 (F.col("kept") + F.col(f"only_{r.bit}")).alias("kept_without"),
                 F.col("n").alias("n_docs")) for r in chosen])).alias("x")).select("x.*")
