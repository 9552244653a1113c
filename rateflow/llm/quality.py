"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule rejects a document by one condition. On a sample of about ``sample_rows`` documents
(chosen by a hash; the bound is this parameter) each rule's selectivity is the share that it
rejects, and its cost the mean number of characters or words that it looks at. Rules run in
the order of rejection per cost: a CASE stops at the first that rejects, so dear rules
see only what cheap ones kept. The order changes the cost and ``rejected_by``, never ``kept``.

Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage
return. Everything is done within the row: there is no shuffle, and long texts or frequent
words are no task's burden.

Defined cases: null or empty text has no words and fails the base rule; repeated rows are
judged alike; without sampled rows the rules keep their listed order; an empty table gives an
empty result; extra columns are kept unless they bear an output's name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column
    cost: Column  # characters or words looked at


def _share(part: Column, whole: Column, percent: int) -> Column:
    """Whether ``part`` is more than ``percent`` of ``whole``."""
    return part * 100 > whole * percent


def rules() -> list[Rule]:
    """The rules on top of the base rule, over the columns made by ``base_counts``."""
    words, chars = F.col("n_words"), F.length("_text")
    letters = F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}"))).cast("long")
    loud = F.size(F.filter("_words", lambda w: w.rlike(r"^\P{L}*\p{Lu}[\p{Lu}\P{L}]+$"))).cast("long")
    bullets = F.size(F.filter("_lines", lambda x: x.rlike(r"^\s*[-*•]\s"))).cast("long")
    one, lines = F.lit(1).cast("long"), F.size("_lines").cast("long")
    return [
        Rule("symbols", _share(F.col("n_symbols"), words, 10), one),
        Rule("word_length", (F.col("word_chars") < words * 2) | (F.col("word_chars") > words * 15), one),
        Rule("duplicate_lines", _share(F.col("n_dup_lines"), lines, 60), one),
        Rule("few_letters", ~_share(letters, words, 70), words),
        Rule("loud", _share(loud, words, 60), words),
        Rule("bullets", _share(bullets, lines, 90), lines),
        Rule("filler", F.col("_text").rlike(r"(?i)lorem ipsum"), chars),
    ]


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of the base rule and the helper columns _text, _words, _lines."""
    split = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    split = split.withColumns({
        "_words": F.filter(F.split("_text", _SPACE), lambda w: w != ""),
        "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    # the hash of each window of three words, with its place, in the order of the hashes
    window = F.transform("_words", lambda w, i: F.struct(
        F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)).alias("hash"), i.alias("at")))
    split = split.withColumn("_windows", F.sort_array(F.slice(window, 1, F.greatest(F.size("_words") - 2, F.lit(0)))))

    def again(w: Column, i: Column) -> Column:
        near = F.when(i > 0, F.get("_windows", i - 1)["hash"] == w["hash"]).otherwise(F.lit(False))
        return F.when(near | F.coalesce(F.get("_windows", i + 1)["hash"] == w["hash"], F.lit(False)), w["at"]).otherwise(F.lit(-1))

    places = F.sort_array(F.filter(F.transform("_windows", again), lambda at: at >= 0))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("words"))
    covered = F.aggregate(places, start, lambda s, at: F.struct(
        at.alias("last"), (s["words"] + F.least(at - s["last"], F.lit(3))).alias("words")), lambda s: s["words"])
    return split.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.regexp_replace("_text", _SPACE, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": covered,
    }).withColumn("base_failed", (F.col("n_words") < 50) | _share(F.col("n_repeat_words"), F.col("n_words"), 50))


def ordered(counted: DataFrame, listed: list[Rule], total: int, sample_rows: int = 2000) -> list[Rule]:
    """The rules by rejection per cost, as estimated on a sample."""
    every = max(1, total // sample_rows)
    sample = counted.filter(F.pmod(F.xxhash64("_text"), F.lit(every)) == 0)
    seen = sample.agg(
        *[F.avg(r.rejects.cast("double")).alias(f"r{i}") for i, r in enumerate(listed)],
        *[F.avg(r.cost).alias(f"c{i}") for i, r in enumerate(listed)]).collect()[0]
    worth = [(seen[f"r{i}"] or 0.0) / max(seen[f"c{i}"] or 0.0, 1e-9) for i in range(len(listed))]
    return [listed[i] for i in sorted(range(len(listed)), key=lambda i: (-worth[i], i))]


def cascade(docs: DataFrame, text: str = "text", sample_rows: int = 2000) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    ``rejected_by`` (the first rule that rejects; null if none or the base rule failed) and ``kept``."""
    counted = base_counts(docs, text)
    first, *rest = ordered(counted, rules(), docs.count(), sample_rows)
    case = F.when(F.col("base_failed"), F.lit(None).cast("string")).when(first.rejects, first.name)
    for rule in rest:
        case = case.when(rule.rejects, rule.name)
    return (
        counted.withColumn("rejected_by", case)
        .withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
        .drop("_text", "_words", "_lines", "_windows")
    )
