"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule rejects by one expression over a text, its measures included. On a bounded sample every
rule is run alone; its running time and the share it rejects order the rules by rejection per cost.
``kept_rows`` is one condition of all rules in that order: a text is cut into words once, and every
other measure is taken only where the rules before it let the row through. ``judge`` returns measures for every row, so these are there already, and its
cascade is one CASE in that order. The order depends on the clock; it never changes which rows are
kept, only which rule of several is named as the one that rejects.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, Scratch

#: Rows on which costs and rejections are estimated, at most.
SAMPLE_ROWS = 400
#: Up to so many distinct repeated windows, positions are looked up; beyond it they are sorted.
FEW = 32

# Limits of the method's rules (widely published heuristics, on the lenient side).
MAX_SYMBOLS_PER_WORD = 0.1
MEAN_WORD = (2.0, 15.0)
MIN_LETTERS = 0.5
MAX_DUP_LINES = 0.5
MAX_ELLIPSIS_LINES = 0.3
MAX_BULLET_LINES = 0.9
LETTER, ELLIPSIS, BULLET = r"\p{L}", "(\\.\\.\\.|…)\\s*$", "^\\s*[-*•‣◦]\\s"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{WHITE}]+"), "")


def lines(text: Column) -> Column:
    """The ``\\n``-split lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{WHITE}]"))


def symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long")


def repeated_words(word_list: Column) -> Column:
    """Words that lie in a 3-word window found at least twice, the first one included.

    Windows are compared by 64-bit hash. Texts without a repeated window (told by a hash set) are
    done at once; a few repeated windows are looked up, many are found by one sort of
    (hash, position), so no text costs more than n log n.
    """
    hashes = F.slice(F.transform(word_list, lambda w, i: F.xxhash64(w, F.get(word_list, i + 1), F.get(word_list, i + 2))), F.lit(1), F.greatest(F.size(word_list) - 2, F.lit(0)))
    return hashes


def _covered(hashes: Column, twice: Column, ordered: Column) -> Column:
    span = lambda i: F.array(i, i + 1, i + 2)
    place = lambda hit: F.size(F.array_distinct(F.flatten(hit))).cast("long")
    few = F.transform(F.filter(F.transform(hashes, lambda h, i: F.when(F.array_contains(twice, h), i)), lambda i: i.isNotNull()), span)
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    many = F.transform(F.filter(ordered, lambda x, k: same(x, F.get(ordered, k - 1)) | same(x, F.get(ordered, k + 1))), lambda x: span(x["i"]))
    return F.when(F.size(twice) == 0, F.lit(0).cast("long")).when(F.size(twice) <= FEW, place(few)).otherwise(place(many))


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns ``__words``, ``n_words``, ``word_chars``, ``n_symbols``, ``__lines``, ``n_dup_lines``, ``n_repeat_words``."""
    text = F.coalesce(F.col("__text"), F.lit(""))
    out = docs.withColumns({"__words": words(text), "__lines": lines(text), "n_symbols": symbols(text)})
    out = out.withColumns({"n_words": F.size("__words").cast("long"), "word_chars": F.length(F.array_join("__words", "")).cast("long"),
                           "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"), "__hashes": repeated_words(F.col("__words"))})
    out = out.withColumn("__sorted", F.when(F.size(F.array_distinct("__hashes")) < F.size("__hashes"), F.sort_array("__hashes")).otherwise(F.array().cast("array<long>")))
    out = out.withColumn("__twice", F.array_distinct(F.filter("__sorted", lambda h, k: F.coalesce(h == F.get("__sorted", k - 1), F.lit(False)))))
    ordered = F.when(F.size("__twice") > FEW, F.sort_array(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    out = out.withColumn("__ordered", ordered)
    return out.withColumn("n_repeat_words", _covered(F.col("__hashes"), F.col("__twice"), F.col("__ordered")))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """The method's rules over the measured columns; true rejects."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    n_lines = F.greatest(F.size("__lines"), F.lit(1))
    text = F.coalesce(F.col("__text"), F.lit(""))
    count_lines = lambda pattern: F.size(F.filter("__lines", lambda line: line.rlike(pattern)))
    mean = F.col("word_chars") / n
    return {
        "symbols": F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n,
        "mean_word": (mean < MEAN_WORD[0]) | (mean > MEAN_WORD[1]),
        "letters": F.regexp_count(text, F.lit(LETTER)) < MIN_LETTERS * F.col("word_chars"),
        "dup_lines": F.col("n_dup_lines") > MAX_DUP_LINES * n_lines,
        "ellipsis": count_lines(ELLIPSIS) > MAX_ELLIPSIS_LINES * n_lines,
        "bullets": count_lines(BULLET) > MAX_BULLET_LINES * n_lines,
    }


def sample_of(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """At most ``SAMPLE_ROWS`` texts; of all partitions together only about twice as many reach the limit."""
    n = texts.count()
    thin = texts if n <= 2 * SAMPLE_ROWS else texts.sample(2 * SAMPLE_ROWS / n, seed=17)
    return scratch.save(thin.select("__text").limit(SAMPLE_ROWS), "sample")


def order_rules(sample: DataFrame, given: Mapping[str, Column]) -> list[str]:
    """Rule names by rejected share per second on ``sample``; ties keep the given order."""
    worth = {}
    for name, reject in given.items():
        began = time.perf_counter()
        share = sample.agg(F.avg(F.coalesce(reject, F.lit(False)).cast("double"))).first()[0] or 0.0
        worth[name] = share / max(time.perf_counter() - began, 1e-6)
    return sorted(given, key=lambda name: -worth[name])


def cascade(order: list[str], given: Mapping[str, Column]) -> Column:
    """The first rule, in that order, that rejects; null if none does."""
    out = None
    for name in order:
        out = F.when(given[name], name) if out is None else out.when(given[name], name)
    return F.lit(None).cast("string") if out is None else out


def judge(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``rejected_by`` and ``kept``.

    A null or empty text has no words and fails the base rule; repeated rows and null ids are
    judged each; the input's own columns stay, and a clash with a column made here is settled for
    the new one; no rows give no rows. ``order`` fixes the rules' order instead of a sample.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by", "kept"]
    own = [c for c in docs.columns if c not in made]
    start = docs.select(*own, F.col("text").cast("string").alias("__text"))
    given = {"base": base_failed()} | rules()
    if order is None:
        scratch = Scratch(docs.sparkSession, "quality")
        order = order_rules(scratch.save(measures(sample_of(start, scratch)), "measured"), given)
        scratch.drop("sample", "measured")
    out = measures(start).withColumn("base_failed", base_failed()).withColumn("rejected_by", cascade(order, given))
    return out.withColumn("kept", F.col("rejected_by").isNull()).select(*own, *made)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeats_most(word_list: Column) -> Column:
    """Whether over half of the words lie in a 3-word window found at least twice."""

    def told(hashes: Column) -> Column:
        def of(twice: Column) -> Column:
            ordered = F.when(F.size(twice) > FEW, F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
            return _bound(ordered, lambda x: 100 * _covered(hashes, twice, x) > 50 * F.size(word_list))

        sorted_ = lambda x: F.array_distinct(F.filter(x, lambda h, k: F.coalesce(h == F.get(x, k - 1), F.lit(False))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(False)).otherwise(_bound(_bound(F.sort_array(hashes), sorted_), of))

    return _bound(repeated_words(word_list), told)


def rules_on(word_list: Column) -> dict[str, Column]:
    """The base rule and ``rules`` as conditions on ``__text`` and its words; true rejects."""
    text = F.coalesce(F.col("__text"), F.lit(""))
    n = F.greatest(F.size(word_list), F.lit(1))
    chars = F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long")
    of_lines = lambda use: _bound(lines(text), lambda ls: use(ls, F.greatest(F.size(ls), F.lit(1))))
    matching = lambda pattern, most: of_lines(lambda ls, all_: F.size(F.filter(ls, lambda line: line.rlike(pattern))) > most * all_)
    return {
        "base": F.when(F.size(word_list) < 50, F.lit(True)).otherwise(_repeats_most(word_list)),
        "symbols": symbols(text) > MAX_SYMBOLS_PER_WORD * n,
        "mean_word": _bound(chars / n, lambda mean: (mean < MEAN_WORD[0]) | (mean > MEAN_WORD[1])),
        "letters": F.regexp_count(text, F.lit(LETTER)) < MIN_LETTERS * chars,
        "dup_lines": of_lines(lambda ls, all_: F.size(ls) - F.size(F.array_distinct(ls)) > MAX_DUP_LINES * all_),
        "ellipsis": matching(ELLIPSIS, MAX_ELLIPSIS_LINES),
        "bullets": matching(BULLET, MAX_BULLET_LINES),
    }


def kept_rows(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; the same rows as ``judge`` keeps."""
    start = docs.withColumn("__text", F.col("text").cast("string"))
    cut = words(F.coalesce(F.col("__text"), F.lit("")))
    if order is None:
        scratch = Scratch(docs.sparkSession, "quality")
        sample = scratch.save(sample_of(start, scratch).withColumn("__words", cut), "words")
        order = order_rules(sample, rules_on(F.col("__words")))
        scratch.drop("sample", "words")

    def rejected(word_list: Column) -> Column:
        given, out = rules_on(word_list), F.lit(False)
        for name in order:  # a row that is rejected stops there
            out = out | F.coalesce(given[name], F.lit(False))
        return out

    return start.where(~_bound(cut, rejected)).select(*docs.columns)
