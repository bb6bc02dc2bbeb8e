"""Quality rules: a table of thresholds compiled into one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, whole, words_of

SYMBOLS = "#*$%&|<>"
BULLET = "^[ \\t\\r\\f]*[-*•]"
ELLIPSIS = "([.][.][.]|…)[ \\t\\r\\f]*$"

#: Frequent function words of English, German, French and Spanish, lower case.
STOP_WORDS = (
    "a an and are as at be by for from in is it not of on or that the this to was were with "
    "das dem den der des die ein eine für ist mit nicht sich und von zu "
    "au aux dans du en est et la le les ne pas pour qui que sur un une "
    "al como con el los las no para por se su una y"
).split()


@dataclass(frozen=True)
class Rule:
    """``ratio`` is numerator over denominator (integers of the text); outside [low, high] the text fails.

    A ratio whose denominator is 0 passes.
    """

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


#: Production thresholds.
RULES: tuple[Rule, ...] = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.4),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 0.3),
)

_WITH_WORD = f"[^{SPACES}]"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words covered by a 3-word window that occurs more than once.

    Windows are told apart by 64-bit hashes. Where fewer are distinct than there are windows,
    they are sorted with their positions, so that equal ones are neighbours: the cost is that
    of a sort, for texts of any length.
    """

    def hashes(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )

    def covered(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(F.sort_array(placed), marked))

    def marked(s: Column) -> Column:
        def again(x: Column, k: Column) -> Column:
            return ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))

        spread = F.transform(F.filter(s, again), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        return F.size(F.array_distinct(F.flatten(spread)))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(words, lambda w: _let(hashes(w), covered))).cast("long")


def _parts(text: Column) -> dict[str, Column]:
    """What the counts are made of: the text, its words, and its lines that hold a word."""
    text = whole(text)
    return {
        "text": text,
        "words": words_of(text),
        "lines": F.filter(F.split(text, "\n", -1), lambda x: x.rlike(_WITH_WORD)),
    }


def counts(parts: dict[str, Column], stop_words: Sequence[str] = STOP_WORDS) -> dict[str, Column]:
    """The integers that rules are made of, each a column expression over the parts of one text."""
    text, words, lines = parts["text"], parts["words"], parts["lines"]
    forms = [form for w in stop_words for form in (w, w.capitalize(), w.upper())]
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _repeated_words(words),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*forms))).cast("long"),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(BULLET))).cast("long"),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike(ELLIPSIS))).cast("long"),
    }


def compile_rules(numbers: dict[str, Column], rules: Sequence[Rule] = RULES) -> dict[str, Column]:
    """One boolean per rule: true where the text passes."""
    passed = {}
    for rule in rules:
        top, below = numbers[rule.numerator], numbers[rule.denominator]
        tests = [top >= rule.low * below] if rule.low is not None else []
        tests += [top <= rule.high * below] if rule.high is not None else []
        ok = F.lit(True)
        for test in tests:
            ok = ok & test
        passed[rule.name] = (below == 0) | ok
    return passed


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> DataFrame:
    """Counts and verdict of each row: id, the counts, ``base_failed``, ``failed_rules`` and ``kept``.

    Only built-in expressions, no shuffle: a projection of the scan. A row is judged by its text
    alone, so repeated rows get equal verdicts and ties don't arise. Null and empty texts have no
    words and fail the base rule. Other columns of ``docs`` are not read, whatever their names;
    an empty table gives an empty result. Texts of any length are read whole.
    """
    own = _parts(F.col(text_col))
    parts = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(n) for n, c in own.items()])
    numbers = counts({n: F.col(n) for n in own})
    counted = parts.select("doc_id", *[c.alias(n) for n, c in numbers.items()])
    own = {n: F.col(n) for n in numbers}
    base_failed = (own["n_words"] < min_words) | (100 * own["n_repeat_words"] > max_repeat_percent * own["n_words"])
    passed = compile_rules(own, rules)
    failed = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in passed.items()]))
    return counted.select(
        "*", base_failed.alias("base_failed"), failed.alias("failed_rules")
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def passing(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with their columns and no others."""
    own = _parts(F.col(text_col))
    part, mark = _unused(docs, "part"), _unused(docs, "verdict")
    names = {n: f"{part}_{n}" for n in own}
    numbers = counts({n: F.col(names[n]) for n in own})
    found = {n: F.col(mark)[n] for n in numbers}
    kept = (found["n_words"] >= min_words) & (100 * found["n_repeat_words"] <= max_repeat_percent * found["n_words"])
    for ok in compile_rules(found, rules).values():
        kept = kept & ok
    marked = docs.withColumns({names[n]: c for n, c in own.items()})
    marked = marked.withColumn(mark, F.struct(*[c.alias(n) for n, c in numbers.items()]))
    return marked.filter(kept).select(*[F.col(f"`{c}`") for c in docs.columns])


def _unused(frame: DataFrame, name: str) -> str:
    """``name`` with as many underscores as no column of the frame starts with."""
    while any(c.lower().startswith(name) for c in frame.columns):
        name += "_"
    return name
