"""Quality rules: a short-circuit cascade in SQL expressions, ordered by rejections per cost.

Every rule is a boolean expression over a document's features, with an expression for
the nanoseconds that a look at a document takes. One aggregation over a sample of about
``SAMPLE_ROWS`` rows gives each rule's mean cost and the share it rejects; rows of the sample
stay where they are read. The order this gives decides which rule is tried first and so what
the cascade costs, never which documents it keeps (the verdict is the OR of all rules). The
same table gives the same order, as no clock is read.

Nulls, empty texts and texts of white space have no words: every count is 0, the base
rule fails and ``kept`` is false. Repeated rows are judged one by one. An empty table
gives an empty result. ``keep_good`` keeps extra columns, whatever their names; ``judge``
leaves them out; ``features`` adds columns that start with ``q_`` and refuses tables that
have such ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knockwork.llm.sieve import free

#: Fixed values of the contract.
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SPLIT_WORDS = "[ \\t-\\r]+"
TRIM = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"

#: Rows expected in the sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 2000
#: Nanoseconds of a comparison, of a character under a regular expression or a split, of a word looked at or hashed.
COMPARE, REGEX_CHAR, SPLIT_CHAR, LOOK_WORD, HASH_WORD = 5.0, 12.0, 2.0, 12.0, 60.0


@dataclass(frozen=True)
class Rule:
    """``reject`` and ``cost`` (nanoseconds) are expressions over the text and ``features``; true rejects."""

    name: str
    reject: Column
    cost: Column | float = COMPARE


def default_rules(text: str = "text") -> tuple[Rule, ...]:
    """Generous limits: prose passes; strings of symbols, lists of copies and boilerplate don't."""
    t, n = F.col(text), F.col("q_n_words")
    lines = F.size(F.split(t, "\n"))
    chars = F.coalesce(F.char_length(t), F.lit(0))
    return (
        Rule("symbols", F.col("q_n_symbols") > n),
        Rule("short_words", F.col("q_word_chars") < 2 * n),
        Rule("long_words", F.col("q_word_chars") > 20 * n),
        Rule("huge_word", F.array_max(F.transform("q_words", F.char_length)) > 2000, n * LOOK_WORD),
        Rule("few_letters", 2 * F.regexp_count(t, F.lit(r"\p{L}")) < F.col("q_word_chars"), chars * REGEX_CHAR),
        Rule("dup_lines", 2 * F.col("q_n_dup_lines") > lines, chars * SPLIT_CHAR),
        Rule("ellipsis_lines", 2 * F.regexp_count(t, F.lit(r"(?m)(\.\.\.|…)$")) > lines, chars * (REGEX_CHAR + SPLIT_CHAR)),
        Rule("bullet_lines", 10 * F.regexp_count(t, F.lit(r"(?m)^[ \t]*[-*•]")) > 9 * lines, chars * (REGEX_CHAR + SPLIT_CHAR)),
        Rule("vocabulary", (n >= 200) & (20 * F.size(F.array_distinct("q_words")) < n), F.when(n >= 200, n * HASH_WORD).otherwise(COMPARE)),
    )


def base_failed() -> Column:
    return (F.col("q_n_words") < MIN_WORDS) | (100 * F.col("q_n_repeat_words") > MAX_REPEAT_PCT * F.col("q_n_words"))


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the words and the counts to every row, without a shuffle.

    Repeated 3-word windows: a long for each window holds its position in the low bits
    and its hash in the rest, so one primitive sort brings equal windows together. Windows
    that share a hash are compared by their words; a text in which two of them differ
    takes the exact path, a sort of the windows themselves.
    """
    if own := [c for c in docs.columns if c.lower().startswith("q_")]:
        raise ValueError(f"columns {own} would be overwritten")
    t = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(t, F.lit(TRIM))
    none = F.array().cast("array<string>")
    near = "({0} & ~q_mask) = (get({1}, {2}) & ~q_mask)"
    at = "int({} & q_mask)"
    equal = " and ".join(f"q_words[{at.format('q_twins[j]')} + {k}] = q_words[{at.format('q_twins[j - 1]')} + {k}]" for k in range(3))
    same = "x.a = get(q_windows, {0}).a and x.b = get(q_windows, {0}).b and x.c = get(q_windows, {0}).c"
    long_enough = F.col("q_n_words") >= 3
    out = docs.withColumn("q_words", F.when(trimmed == "", none).otherwise(F.split(trimmed, SPLIT_WORDS)))
    out = out.withColumn("q_n_words", F.size("q_words").cast("long"))
    out = out.withColumn("q_mask", F.expr("shiftleft(1L, int(ceil(log2(q_n_words + 2)))) - 1"))
    out = out.withColumn("q_keys", F.when(long_enough, F.expr(
        "sort_array(transform(sequence(0, int(q_n_words) - 3),"
        " i -> (xxhash64(q_words[i], q_words[i + 1], q_words[i + 2]) & ~q_mask) | bigint(i)))")))
    out = out.withColumn("q_twins", F.expr(
        f"filter(q_keys, (x, i) -> coalesce({near.format('x', 'q_keys', 'i - 1')}, false) or coalesce({near.format('x', 'q_keys', 'i + 1')}, false))"))
    out = out.withColumn("q_clash", F.expr(
        "size(q_twins) > 1 and exists(sequence(1, size(q_twins) - 1), j -> "
        f"(q_twins[j] & ~q_mask) = (q_twins[j - 1] & ~q_mask) and not ({equal}))"))
    out = out.withColumn("q_windows", F.when(F.col("q_clash"), F.expr(
        "array_sort(transform(sequence(0, int(q_n_words) - 3), i -> "
        "named_struct('a', q_words[i], 'b', q_words[i + 1], 'c', q_words[i + 2], 'p', bigint(i))))")))
    out = out.withColumn("q_at", F.expr(
        "sort_array(case when q_clash then transform(filter(q_windows, (x, i) -> "
        f"coalesce({same.format('i - 1')}, false) or coalesce({same.format('i + 1')}, false)), x -> x.p) "
        "else transform(q_twins, x -> x & q_mask) end)"))
    out = out.withColumn("q_lines", F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(TRIM)) != ""))
    return out.withColumns({
        "q_word_chars": F.char_length(F.array_join("q_words", "")).cast("long"),
        "q_n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
        "q_n_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
        "q_n_repeat_words": F.expr(
            "coalesce(aggregate(q_at, named_struct('last', -3L, 'n', 0L),"
            " (s, p) -> named_struct('last', p, 'n', s.n + least(3L, p - s.last)), s -> s.n), 0L)"),
    }).drop("q_mask", "q_keys", "q_twins", "q_clash", "q_windows", "q_at", "q_lines")


def plan_cascade(docs: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Rule]:
    """The rules by rejections per cost on a sample of about ``sample_rows`` rows, highest first; ties stay in the order given.

    Half a rejection is added to each, so among rules that reject nothing in the sample the cheapest comes first.
    """
    rows = docs.count()
    if not rows or not rules:
        return list(rules)
    sample = features(docs.sample(min(1.0, sample_rows / rows), seed) if rows > sample_rows else docs, text)
    told = [F.count(F.when(r.reject, 1)).alias(f"hits{i}") for i, r in enumerate(rules)]
    told += [F.sum(r.cost if isinstance(r.cost, Column) else F.lit(float(r.cost))).alias(f"cost{i}") for i, r in enumerate(rules)]
    found = sample.agg(*told).first()
    rate = {r.name: (found[f"hits{i}"] + 0.5) / max(found[f"cost{i}"] or 0.0, COMPARE) for i, r in enumerate(rules)}
    return sorted(rules, key=lambda r: -rate[r.name])


def verdict(cascade: Sequence[Rule]) -> Column:
    """The first rule that rejects, null if none does; later rules of a rejected row aren't evaluated."""
    out = F.when(base_failed(), "base")
    for rule in cascade:
        out = out.when(rule.reject, rule.name)
    return out


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The contract's counts and verdict for every document; rules of one's own see the text as ``t``, the key as ``k``."""
    docs = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    cascade = plan_cascade(docs, default_rules("t") if rules is None else rules, "t", sample_rows)
    return features(docs, "t").select(
        F.col("k").alias(key),
        *(F.col(f"q_{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        base_failed().alias("base_failed"),
        verdict(cascade).isNull().alias("kept"),
    )


def keep_good(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns; rules see those that start with ``q_`` as features only."""
    names = [free(f"own_{i}", docs.columns) if c.lower().startswith("q_") else c for i, c in enumerate(docs.columns)]
    given, said = docs.toDF(*names), names[docs.columns.index(text)]
    cascade = plan_cascade(given, default_rules(said) if rules is None else rules, said, sample_rows)
    # A filter isn't moved below a column that depends on the partition; moved, it would repeat every step of the features.
    held = features(given, said).withColumn("q_part", F.spark_partition_id())
    return held.filter(verdict(cascade).isNull() & (F.col("q_part") >= 0)).select(*names).toDF(*docs.columns)
