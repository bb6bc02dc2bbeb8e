"""Byte-pair encoding by a deterministic automaton over tokens.

Each merge of the vocabulary is applied to the automaton as a gadget: the state that follows the
left token is copied without the arc of the right token, the left token's arcs lead to the copy,
and wherever an arc of the left token starts, an arc of the merged token starts too and ends where
the right token's arc ended. The paths that remain are the token sequences that merging in rank
order can produce, and each string has one. Encoding a word means following that one path, byte
by byte, through a table of transitions; decoding emits the bytes on the arcs.

Where an arc of a token leads depends on the token alone, and a copied state differs from its
original by one arc and by tokens made later, so the table is stored as one row per state
(original, removed token, time) and looked up by following these.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, whole

#: The pre-splitting of byte-level vocabularies.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

#: Words held by a worker with their codes, in each of two generations.
HELD_WORDS = 250_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Automaton:
    """Compiled merges. ``tokens``: bytes by id; ``merges``: (left, right, merged) ids in rank order."""

    def __init__(self, tokens: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.label = tokens
        self.left: dict[int, int] = {}
        self.born = dict.fromkeys(tokens, 0)
        # rows of the state table; state 0 is the start
        self.original, self.removed, self.since = [0], [-1], [0]
        self.target = dict.fromkeys(tokens, 0)
        for time, (a, b, c) in enumerate(merges, 1):
            self._gadget(time, a, b, c)
        made = {c for _, _, c in merges}
        self.trie: dict = {}
        for i, label in tokens.items():
            if len(label) == 1 or i in made:
                node = self.trie
                for byte in label:
                    node = node.setdefault(byte, {})
                node[-1] = i
        self._arcs: dict[tuple[int, int], bool] = {}

    def _gadget(self, time: int, a: int, b: int, c: int) -> None:
        after_b = self.target[b]
        self.original.append(self.target[a])
        self.removed.append(b)
        self.since.append(time)
        self.target[a] = len(self.original) - 1
        self.target[c] = after_b
        self.left[c], self.born[c] = a, time

    def _has_arc(self, state: int, token: int) -> bool:
        while state:
            if self.born[token] >= self.since[state]:
                # younger than the state, or made with it: starts wherever its left token does
                token = self.left[token]
            elif token == self.removed[state]:
                return False
            else:
                state = self.original[state]
        return True

    def encode(self, word: bytes) -> list[int]:
        """The ids on the one path that spells ``word``. Time and memory grow with its length."""
        size, arcs, trie, target = len(word), self._arcs, self.trie, self.target
        states, back = [-1] * (size + 1), [0] * (size + 1)
        states[0] = 0
        for start in range(size):
            state, node = states[start], trie
            for end in range(start, size):
                node = node.get(word[end])
                if node is None:
                    break
                token = node.get(-1)
                if token is None:
                    continue
                has = arcs.get((state, token))
                if has is None:
                    if len(arcs) >= 1_000_000:
                        arcs.clear()
                    has = arcs[state, token] = self._has_arc(state, token)
                if has:
                    states[end + 1], back[end + 1] = target[token], token
        ids = []
        while size:
            ids.append(back[size])
            size -= len(self.label[back[size]])
        return ids[::-1]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.label.__getitem__, ids))


def read_vocabulary(path: str) -> str:
    """The parts of a tokenizer file that the coder needs, as JSON text to send to the tasks."""
    with open(path, encoding="utf-8") as file:
        whole_file = json.load(file)
    model = whole_file["model"]
    special = {x["content"]: x["id"] for x in whole_file.get("added_tokens", [])}
    return json.dumps({"vocab": model["vocab"], "merges": model["merges"], "special": special})


class Coder:
    """Texts to ids and back. Special tokens in a text become their ids, as in the tokenizer file."""

    def __init__(self, vocabulary: str):
        parts = json.loads(vocabulary)
        letters = byte_letters()
        ids = parts["vocab"]
        self.special = parts["special"]
        tokens = {i: bytes(letters[x] for x in s) for s, i in ids.items() if s not in self.special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in parts["merges"]]
        self.automaton = Automaton(tokens, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        self.label = tokens | {i: s.encode() for s, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self._split = regex.compile(SPLIT).findall
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        code = self._old.get(word)
        if code is None:
            code = array("I", self.automaton.encode(word.encode())).tobytes()
        if len(word) <= 64:
            if len(self._new) >= HELD_WORDS:
                self._old, self._new = self._new, {}
            self._new[word] = code
        return code

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        parts = self._cut.split(text) if self._cut else [text]
        codes = []
        for part in parts:
            if part in self.special:
                codes.append(array("I", [self.special[part]]).tobytes())
                continue
            get, word = self._new.get, self._word
            for piece in self._split(part):
                code = get(piece)
                if code is None:
                    code = word(piece)
                    get = self._new.get
                codes.append(code)
        return b"".join(codes)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.label.__getitem__, array("I", ids))).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _coder(vocabulary: str) -> Coder:
    return Coder(vocabulary)


def encode_texts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """Ids of each row's whole text: (doc_id, ids), ids packed as little-endian unsigned 32-bit integers.

    With ``decoded`` a third column holds the text that the ids decode to. Null texts count as
    empty and give no ids. Rows are coded one by one: repeated rows give equal results, an empty
    table gives none, other columns are not read. Long texts are coded in one go, in memory
    proportional to their length; long words take time proportional to theirs.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    schema = "doc_id {}, ids binary" + (", decoded string" if decoded else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(sent.value)
        for batch in slices(batches, "text"):
            ids = [coder.encode(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array(ids, pa.binary())]
            names = ["doc_id", "ids"]
            if decoded:
                columns.append(pa.array([coder.decode(x) for x in ids], pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)

    texts = docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text"))
    return texts.mapInArrow(run, schema.format(texts.schema["doc_id"].dataType.simpleString()))


def decode_ids(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from packed ids; null ids give an empty text."""
    sent = coded.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(sent.value)
        for batch in slices(batches, "ids"):
            texts = [coder.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    packed = coded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    kind = packed.schema["doc_id"].dataType.simpleString()
    return packed.mapInArrow(run, f"doc_id {kind}, text string")
