"""Secrets in texts: patterns, and values in credential contexts that are hard to guess.

The guess cost of a value is that of its cheapest segmentation into words, dates, repeats, keyboard
walks and brute-force spans, found by dynamic programming over its positions. A value next to a
credential word counts as a secret if even the cheapest reading needs many guesses; ``password:
december`` or ``pin = qwerty12`` does not.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, whole

#: Kinds of spans in the order that ties of their starts are listed in.
KINDS = ("assign", "access", "hex", "guess")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_CREDENTIAL = r"""(?<![A-Za-z0-9])
        (?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|(?:private|access|client|secret|auth)[_-]?key
          |credentials?|bearer|authorization|pin|login)"""
_FILLER = "(?:is|was|to|of|for|as|set|basic|bearer|the)"
#: A credential word; ahead of it up to three short filler words, a sign or white space, and up to three
#: more fillers (group 1), then a value. Only the word is consumed, so contexts may be stacked. A
#: credential word is no value: it has a context of its own.
_CONTEXT = re.compile(
    rf"""{_CREDENTIAL}
        (?=(["']? (?:\s+{_FILLER}\b){{0,3}} (?:\s*+[:=]{{1,2}}+>?+\s*+|\s++) (?:{_FILLER}\s++){{0,3}}+ ["'`]?+)
           (?!["'`]? {_CREDENTIAL} (?:["'`]?[:=]|["'`.,;)>\]}}!?]*+(?:\s|\Z)))
           [!-&(-+\x2d-~]{{6}})""",
    re.ASCII | re.IGNORECASE | re.VERBOSE,
)
_VALUE = re.compile(r"[!-&(-+\x2d-~]+")
#: user:value@host in an address; both of any length. The classes leave out what ends them, so no
#: character is read for two addresses.
_ADDRESS = re.compile(r"://[^\s/:@]++:([^\s/:@]{4,}+)@")

_PROSE = re.compile(r"[A-Z]?[a-z]+(?:[-/_][A-Z]?[a-z]+)*")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://")

#: Common parts of passwords, most frequent first; the rank is the number of guesses.
COMMON_WORDS = (
    "password pass admin login welcome letmein master monkey dragon shadow sunshine princess football baseball "
    "superman batman iloveyou trustno access secret hello freedom whatever michael jordan hunter ranger buster "
    "summer winter spring autumn january february march april may june july august september october november "
    "december monday tuesday wednesday thursday friday saturday sunday test guest root user default change changeme "
    "token key api example sample value string none null true false your here service server client public private "
    "the and that this with for you are not have from word name mail home office love life time work"
).split()

_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_SHIFTED = str.maketrans('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./")
#: Segments with inner structure are at most this long; repeats and brute force are of any length.
LONGEST_PART = 32


def _keyboard() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    for y, row in enumerate(_ROWS):
        for x, key in enumerate(row):
            beside = {row[i] for i in (x - 1, x + 1) if 0 <= i < len(row)}
            for other, shifts in ((y - 1, (0, 1)), (y + 1, (-1, 0))):
                if 0 <= other < len(_ROWS):
                    beside |= {_ROWS[other][x + s] for s in shifts if 0 <= x + s < len(_ROWS[other])}
            near[key] = beside
    return near


_NEAR = _keyboard()
_PLACE = {key: (x, y) for y, row in enumerate(_ROWS) for x, key in enumerate(row)}
_DATE = re.compile(
    r"(?:(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))"
    r"|(?:(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d)"
    r"|(?:(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\3(?:19|20)\d\d)"
    r"|(?:(?:19|20)\d\d)"
)
_LEET = str.maketrans("@4310$57!", "aaeiossti")

#: log10 guesses for one more segment: where the cut is and which kind follows.
_CUT = math.log10(8)


def _alphabet(value: str) -> float:
    """log10 of the size of the character classes that occur."""
    size = 26 * bool(re.search("[a-z]", value)) + 26 * bool(re.search("[A-Z]", value)) + 10 * bool(re.search("[0-9]", value))
    return math.log10(max(10, size + 32 * bool(re.search("[^A-Za-z0-9]", value))))


class GuessCost:
    """log10 of the guesses that the cheapest segmentation of a value needs."""

    def __init__(self, words: Sequence[str] = COMMON_WORDS):
        self.ranks = {w: i + 1 for i, w in reversed(list(enumerate(words)))}
        self.longest = max(map(len, words), default=0)

    def _parts(self, value: str, plain: str, keys: str, start: int) -> Iterator[tuple[int, float]]:
        """(end, log10 guesses) of the words, dates and walks that begin at ``start``."""
        for end in range(start + 3, min(len(value), start + self.longest) + 1):
            lower = value[start:end].lower()
            rank, turned = self.ranks.get(lower), 0
            if rank is None:
                rank, turned = self.ranks.get(plain[start:end]), 1
            if rank is not None:
                cased = value[start:end] != lower
                yield end, math.log10(rank) + math.log10(2) * (turned + cased)
        if m := _DATE.match(value, start):
            days = m.end() - start > 4
            yield m.end(), math.log10(120 * (365 if days else 1) * (4 if days and not m[0].isdigit() else 1))
            if days and value[start : start + 4].isdigit() and value[start : start + 2] in ("19", "20"):
                yield start + 4, math.log10(120)
        end = start + 1
        turns, last = 0, None
        while end < len(value) and end - start < LONGEST_PART and keys[end] in _NEAR.get(keys[end - 1], ()):
            (x0, y0), (x1, y1) = _PLACE[keys[end - 1]], _PLACE[keys[end]]
            way = (x1 - x0, y1 - y0)
            turns, last = turns + (way != last), way
            end += 1
            if end - start >= 3:
                yield end, math.log10(47 * 4 * (end - start)) + turns * math.log10(5)
        end = start + 1
        step = ord(value[end]) - ord(value[start]) if end < len(value) else 0
        if abs(step) == 1:
            while end < len(value) and end - start < LONGEST_PART and ord(value[end]) - ord(value[end - 1]) == step:
                end += 1
                if end - start >= 3:
                    yield end, math.log10(26 * 2 * (end - start))

    def __call__(self, value: str) -> float:
        """Time grows with the length of the value, whatever it holds."""
        size, each = len(value), _alphabet(value)
        plain, keys = value.lower().translate(_LEET), value.lower().translate(_SHIFTED)
        repeats = self._repeats(value)
        # best[i]: cheapest for the first i characters; brute[i]: same, if a brute-force span ends there
        best, brute = [0.0] + [math.inf] * size, [math.inf] * (size + 1)
        for start in range(size):
            brute[start + 1] = min(brute[start], best[start] + _CUT) + each
            best[start + 1] = min(best[start + 1], brute[start + 1])
            for end, cost in self._parts(value, plain, keys, start):
                best[end] = min(best[end], best[start] + _CUT + cost)
            for unit, times in repeats.get(start, ()):
                cost = self._known(value[start : start + unit], each) + math.log10(times)
                end = start + unit * times
                best[end] = min(best[end], best[start] + _CUT + cost)
        return best[size] if size else 0.0

    def _known(self, unit: str, each: float) -> float:
        rank = self.ranks.get(unit.lower())
        return math.log10(rank) if rank else len(unit) * each

    @staticmethod
    def _repeats(value: str) -> dict[int, list[tuple[int, int]]]:
        """Start: (length of the unit, times) of the longest runs of a repeated unit of 1 to 8 characters."""
        found: dict[int, list[tuple[int, int]]] = {}
        for unit in range(1, 9):
            start = 0
            while start + 2 * unit <= len(value):
                end = start + unit
                while end < len(value) and value[end] == value[end - unit]:
                    end += 1
                times = (end - start) // unit
                if times >= 2 and (unit > 1 or times >= 3):
                    for shift in range(min(unit, end - start - 2 * unit + 1)):
                        found.setdefault(start + shift, []).append((unit, (end - start - shift) // unit))
                start = max(start + 1, end - unit + 1)
        return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted."""
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


class Scanner:
    """Spans of a text: the fixed patterns, then values in credential contexts that cost enough guesses."""

    def __init__(self, least_log10: float = 9.0, words: Sequence[str] = COMMON_WORDS):
        self.cost, self.least = GuessCost(words), least_log10

    def values(self, text: str) -> Iterator[tuple[int, int, bool]]:
        """(start, end, stated) of what follows credential words and of passwords in addresses; values
        that share a run of characters follow each other. Stated: after a sign, in quotes or in an address."""
        end = 0
        for m in _CONTEXT.finditer(text):
            start = m.end(1)
            if start >= end:
                end = _VALUE.match(text, start).end()
            yield start, end, m[1][-1] in "\"'`" or ":" in m[1] or "=" in m[1]
        for m in _ADDRESS.finditer(text):
            yield *m.span(1), True

    def guessed(self, text: str) -> Iterator[tuple[int, int, int, float]]:
        told = (0, 0)
        for start, end, stated in self.values(text):
            # a context within a value that counts adds nothing
            if told[0] <= start < told[1]:
                continue
            quote = text[start - 1] if start else ""
            if quote and quote in "\"`" and (closed := re.compile(rf"(?<!\\){quote}").search(text, start, end)):
                end = closed.start()
            reach = end
            while end > start and text[end - 1] in "\"'`.,;:)>]}!?":
                end -= 1
            value = text[start:end]
            # prose follows credential words too: there a lone word, words joined and an address are no values
            if len(value) < 6 or not stated and (_PROSE.fullmatch(value) or _SCHEME.match(value)):
                continue
            cost = self.cost(value)
            if cost >= self.least:
                told = start, reach
                yield start, 3, end, cost

    def __call__(self, text: str) -> tuple[list[tuple[int, int, int]], float]:
        """All spans by start and kind, and the highest cost found. Base spans always stay; a method's
        span is added once, and not where a base span covers it."""
        base = base_spans(text)
        more, top = [], 0.0
        for start, kind, end, cost in sorted(set(self.guessed(text))):
            top = max(top, cost)
            more.append((start, kind, end))
        if more and base:
            more = _uncovered(more, base)
        return sorted({*base, *more}), top


def _uncovered(spans, base):
    """Spans that no base span contains; both sorted by start."""
    kept, i, reach = [], 0, -1
    for span in spans:
        while i < len(base) and base[i][0] <= span[0]:
            reach = max(reach, base[i][2])
            i += 1
        if span[2] > reach:
            kept.append(span)
    return kept


def joined(spans: Sequence[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redacted(text: str, spans: Sequence[tuple[int, int, int]], mark: str = "<secret>") -> str:
    """The text with each run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _scanned(docs, id_col, text_col, least_log10, columns, schema):
    """One row of ``columns(scanner, text)`` per row; the text goes through workers in bounded batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(least_log10)
        for batch in slices(batches, "text"):
            found = [columns(scanner, t) for t in batch.column("text").to_pylist()]
            arrays = [batch.column("doc_id")]
            arrays += [pa.array([row[i] for row in found], kind) for i, (_, kind) in enumerate(schema)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *[n for n, _ in schema]])

    texts = docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text"))
    names = {pa.string(): "string", pa.float64(): "double", pa.list_(pa.int32()): "array<int>"}
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} {names[k]}" for n, k in schema))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_log10: float = 9.0
) -> DataFrame:
    """(doc_id, starts, ends, kinds, top_log10) of each row; spans in code points, end exclusive.

    Null and empty texts have no spans. A row depends on its own text alone: repeated rows give
    equal results, ties of a start are ordered by kind, an empty table gives an empty result, other
    columns are not read. Texts are scanned whole; costs are linear in the length of a value.
    """

    def columns(scanner, text):
        spans, top = scanner(text)
        return [s[0] for s in spans], [s[2] for s in spans], [s[1] for s in spans], top

    numbers = pa.list_(pa.int32())
    schema = [("starts", numbers), ("ends", numbers), ("kinds", numbers), ("top_log10", pa.float64())]
    return _scanned(docs, id_col, text_col, least_log10, columns, schema)


def redact(docs: DataFrame, text_col: str = "text", least_log10: float = 9.0) -> DataFrame:
    """``docs`` with secrets in the text column replaced; all other columns as they are, null texts too."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(least_log10)
        for batch in slices(batches, text_col):
            place = batch.schema.get_field_index(text_col)
            texts = [t and redacted(t, scanner(t)[0]) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, text_col, pa.array(texts, pa.string()))

    return docs.mapInArrow(run, schema)
