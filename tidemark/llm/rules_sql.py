"""The quality rules as SQL, from the same table of thresholds."""

from __future__ import annotations

from tidemark.llm.common import WORD
from tidemark.llm.rules import BULLET, ELLIPSIS, RULES, STOP_WORDS, SYMBOLS

_FORMS = ", ".join(f"'{form}'" for w in STOP_WORDS for form in dict.fromkeys((w, w.capitalize(), w.upper())))


def _passed() -> str:
    tests = []
    for rule in RULES:
        bounds = [f"{rule.numerator} >= {rule.low}::DOUBLE * {rule.denominator}"] if rule.low is not None else []
        bounds += [f"{rule.numerator} <= {rule.high}::DOUBLE * {rule.denominator}"] if rule.high is not None else []
        tests.append(f"({rule.denominator} = 0 OR ({' AND '.join(bounds)}))")
    return " AND ".join(tests)


def _failed() -> str:
    cases = []
    for rule in RULES:
        bounds = [f"{rule.numerator} < {rule.low}::DOUBLE * {rule.denominator}"] if rule.low is not None else []
        bounds += [f"{rule.numerator} > {rule.high}::DOUBLE * {rule.denominator}"] if rule.high is not None else []
        cases.append(f"CASE WHEN {rule.denominator} <> 0 AND ({' OR '.join(bounds)}) THEN '{rule.name}' END")
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


#: Rows of ``documents`` with counts and verdicts, as common table expressions that end in ``judged``.
JUDGED = f"""
texts AS (
    SELECT doc_id, coalesce(text, '') AS t FROM documents
), parts AS (
    SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l
    FROM texts
), windows AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM parts WHERE len(w) >= 3)
), again AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows) WHERE n >= 2
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM again CROSS JOIN range(3) AS r(k) GROUP BY doc_id
), counted AS (
    SELECT doc_id, len(w)::BIGINT AS n_words,
           length(array_to_string(w, ''))::BIGINT AS word_chars,
           length(regexp_replace(t, '[^{SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
           len(l)::BIGINT AS n_lines,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
           coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
           len(list_filter(w, lambda x: x IN ({_FORMS})))::BIGINT AS n_stop_words,
           len(list_filter(l, lambda x: regexp_matches(x, '{BULLET}')))::BIGINT AS n_bullet_lines,
           len(list_filter(l, lambda x: regexp_matches(x, '{ELLIPSIS}')))::BIGINT AS n_ellipsis_lines
    FROM parts LEFT JOIN covered USING (doc_id)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           array_to_string({_failed()}, ',') AS failed_rules,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {_passed()} AS kept
    FROM counted
)"""

SQL = f"WITH {JUDGED} SELECT * FROM judged"
