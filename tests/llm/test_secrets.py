import hashlib
import math
import re
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, secrets

COST = secrets.GuessCost()

PATTERNS = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", r"AKIA[A-Z0-9]+"),
    ("hex", r"[0-9a-f]+"),
)


def base_by_hand(text):
    spans = []
    for kind, (name, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text, re.ASCII | (re.I if kind == 0 else 0)):
            if (kind == 0 and len(m[2]) >= 6) or (kind == 1 and len(m[0]) >= 20) or (kind == 2 and len(m[0]) >= 24):
                spans.append((m.start(), kind, m.end()))
    return sorted(spans)


def cost_by_hand(value):
    """The cheapest of all segmentations, each tried."""
    each = secrets._alphabet(value)
    plain, keys = value.lower().translate(secrets._LEET), value.lower().translate(secrets._SHIFTED)
    repeats = COST._repeats(value)

    @lru_cache(None)
    def rest(start):
        if start == len(value):
            return 0.0
        options = [secrets._CUT + (end - start) * each + rest(end) for end in range(start + 1, len(value) + 1)]
        options += [secrets._CUT + c + rest(end) for end, c in COST._parts(value, plain, keys, start)]
        for unit, times in repeats.get(start, ()):
            c = COST._known(value[start : start + unit], each) + math.log10(times)
            options.append(secrets._CUT + c + rest(start + unit * times))
        return min(options)

    return rest(0)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcqwerty123pasword19902!-X", max_size=24))
def test_cost_is_the_minimum(value):
    assert COST(value) == pytest.approx(cost_by_hand(value))


def test_cost_orders_values():
    easy = ["password", "qwerty12", "aaaaaaaaaaaa", "abcabcabcabc", "1990-12-31", "P@ssw0rd", "letmein2020", "asdfghjkl"]
    hard = ["x9$kQ2!vLp", "f33e61083db5dbdf4bd2", "Zk7-pQw3_Rt9x"]
    assert max(map(COST, easy)) < 9 < min(map(COST, hard))


def test_cost_of_long_values():
    assert COST("ab" * 50_000) < 12
    assert COST("x7Q!" + "k" * 100_000) < 30


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "=", " ", '"', "secret:", "abcdef1", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "é", "ſecret", "\n", "pwd ", "is"]), max_size=14).map("".join))
def test_base_spans(text):
    assert secrets.base_spans(text) == base_by_hand(text)
    spans, _ = secrets.Scanner()(text)
    assert [s for s in spans if s[1] < 3] == base_by_hand(text)
    assert all(0 <= a < b <= len(text) for a, _, b in spans)


def test_context_values():
    scan = secrets.Scanner()

    def values(text):
        return [text[a:b] for a, k, b in scan(text)[0] if k == 3]

    assert values("his pwd is x9$kQ2!vLp, he said") == ["x9$kQ2!vLp"]
    assert values("https://bob:Zk7-pQw3_Rt9x@host/") == ["Zk7-pQw3_Rt9x"]
    assert values("the password is december") == []
    assert values("the secret garden of tokens and credentials everywhere") == []
    assert values("pwd: qwerty12") == []
    assert values("x9$kQ2!vLp without context") == []
    assert values("password=Zk7-pQw3_Rt9x") == []  # a base span covers it


def values_of(text):
    return [text[a:b] for a, k, b in secrets.Scanner()(text)[0] if k == 3]


@pytest.mark.parametrize("text", [
    "Authorization: Bearer {}", "authorization = basic\t{}", "login password is {}", "credentials password is {}",
    "secret password {}", "login secret:\n{}", 'login "password" is "{}"', "pin: the {}", "login pwd={}", "pwd\t\tis\n{}",
    "login password secret token pin {}", "login:password:{}",
])
def test_stacked_contexts(text):
    for value in ("x9$kQ2!vLp", "Tr0ub4dor&3x"):
        text_ = text.format(value) + ", he said"
        assert value not in secrets.redacted(text_, secrets.Scanner()(text_)[0])
        assert set(values_of(text_)) <= {value}
    assert values_of(text.format("password") + " here") == []


@pytest.mark.parametrize("text", [
    "pwd = {}", "passphrase: {}", 'the login is "{}"', "credentials '{}'", "pin is := {}", "https://bob:{}@host/",
])
def test_letters_only(text):
    for value in ("kzqvwxjrtmbf", "Kzqvwxjrtmbf"):
        assert values_of(text.format(value)) == [value]
    for value in ("december", "Welcome", "sunshine"):
        assert values_of(text.format(value)) == []
    assert values_of("the login kzqvwxjrtmbf") == []  # as prose: the stated exclusion


def test_quotes_addresses_and_joined_words():
    found = [(t[a:e]) for t in (
        'secret "x9$kQ2!vLp"###', "token = `x9$kQ2!vLp`, then", r'pwd = "x9$\"kQ2!vLp"; next', 'password: x9$k"Q2!vLp',
    ) for a, _, e, _ in secrets.Scanner().guessed(t)]
    assert found == ["x9$kQ2!vLp", "x9$kQ2!vLp", r'x9$\"kQ2!vLp', 'x9$k"Q2!vLp']
    for text in (
        "login to http://example.com/path/here", "secret santa-party-december", "the secret ingredient-list-of-the-restaurant"
    ):
        assert not list(secrets.Scanner().guessed(text)), text
    # after a sign both count
    for value in ("kzqv-wxjr-tmbf", "https://hooks.example.com/T0/Zk9qLw2x"):
        assert [x[:3] for x in secrets.Scanner().guessed(f"secret: {value}")] == [(8, 3, 8 + len(value))]


def test_long_addresses():
    token = "".join(hashlib.sha256(bytes([i])).hexdigest().upper() for i in range(40))
    for user, value in (("x-token-auth", token[:300]), ("u" * 100, token[:300]), ("u" * 100_000, token)):
        assert values_of(f"see https://{user}:{value}@host/x") == [value]
    for unit in ("://", "://u:", "://" + "u" * 50 + ":" + "p" * 50):
        secrets.Scanner()(unit * (1_000_000 // len(unit)))


def test_many_contexts_in_linear_time():
    for unit in ("token=", "login:a;", "pin ", "secret is ", "login " + " " * 50):
        secrets.Scanner()(unit * (200_000 // len(unit)))


def test_redacted():
    text = 'é token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end'
    assert secrets.redacted(text, secrets.Scanner()(text)[0]) == 'é <secret>" end'


def test_frame(spark):
    texts = [None, "", "token=abcdef", "x " * 200_000 + "pwd: x9$kQ2!vLp", "token=abcdef", "AKIA" + "A" * 100_000]
    rows = [(i if i != 1 else None, t, "clash") for i, t in enumerate(texts)] + [(2, "token=abcdef", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = secrets.find_secrets(docs).collect()
    assert len(found) == len(rows)
    for row in found:
        spans, top = secrets.Scanner()((texts[row.doc_id] if row.doc_id is not None else "") or "")
        assert (row.starts, row.kinds, row.ends) == tuple([s[i] for s in spans] for i in range(3))
    assert secrets.find_secrets(docs.limit(0)).count() == 0
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns
    assert {r.doc_id: r.text for r in clean.collect()}[2] == "<secret>"
    assert sum(r.text is None for r in clean.collect()) == 1


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op1_secret_scan"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    scan = secrets.Scanner()
    for row in rows:
        base = base_by_hand(texts[row.doc_id])
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(s[1] == k for s in base) for k in range(3))
        assert row.base_sha256 == hashlib.sha256(secrets.joined(base).encode()).hexdigest()
        assert row.spans == secrets.joined(scan(texts[row.doc_id])[0])
