import hashlib
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.read_vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    return library.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("aeiosthnr 's\n\t<|>.1"), st.characters(exclude_categories=["Cs"]))))
def test_equals_library(text):
    coder, library = _pair()
    ids = coder.encode(text)
    assert list(memoryview(ids).cast("I")) == expected(library, text)
    assert coder.decode(ids) == text


_held = []


def _pair():
    if not _held:
        _held.extend((bpe.Coder(bpe.read_vocabulary(PATH)), Tokenizer.from_file(PATH)))
    return _held


def test_all_characters(coder, library):
    for start in range(0, 0x110000, 0x400):
        text = " a".join(chr(c) for c in range(start, start + 0x400) if not 0xD800 <= c < 0xE000)
        assert list(memoryview(coder.encode(text)).cast("I")) == expected(library, text), hex(start)


def test_runs_and_long_words(coder, library):
    for text in ("a" * 5000, "aaab" * 999, " " * 3333 + "x", "<|endoftext|><|endoftext|>a<|endoftext", "th" * 20000):
        assert list(memoryview(coder.encode(text)).cast("I")) == expected(library, text)


def test_small_vocabulary_by_merging():
    tokens = {0: b"a", 1: b"b", 2: b"aa", 3: b"ab", 4: b"aab", 5: b"abab"}
    merges = [(0, 0, 2), (0, 1, 3), (2, 1, 4), (3, 3, 5)]
    machine = bpe.Automaton(tokens, merges)

    def by_rank(word):
        ids = [0 if c == "a" else 1 for c in word]
        for a, b, c in merges:
            i, out = 0, []
            while i < len(ids):
                if ids[i : i + 2] == [a, b]:
                    out.append(c)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    for n in range(1, 11):
        for bits in range(2**n):
            word = "".join("ab"[bits >> k & 1] for k in range(n))
            assert machine.encode(word.encode()) == by_rank(word)


def test_frame(spark, library):
    rows = [(1, "the the", "x"), (None, None, None), (2, "", "y"), (1, "the the", "x"), (3, "long " * 200_000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = bpe.encode_texts(docs, PATH, decoded=True)
    found = sorted(((r.doc_id or 0, list(memoryview(r.ids).cast("I")), r.decoded) for r in coded.collect()))
    assert found == sorted((i or 0, expected(library, t or ""), t or "") for i, t, _ in rows)
    texts = {r.doc_id: r.text for r in bpe.decode_ids(coded, PATH).collect()}
    assert texts == {i: t or "" for i, t, _ in rows}
    assert bpe.encode_texts(docs.limit(0), PATH).count() == 0


def test_query(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op8_bpe_automaton"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = expected(library, texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
