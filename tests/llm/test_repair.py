import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tidemark.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, pos int, conv string"
SPACE = " \t\n\x0b\f\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(SPACE)
        if not body:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        elif body[-1] not in ".!?":
            found.append("truncated")
        else:
            found.append("")
        seen.add((role, text))
    return found


def best(rows, faults):
    """(cost, audit, repaired rows) of the cheapest edits, the least audit among them, by trying everything."""

    @lru_cache(None)
    def go(i, last, run):
        """Edits from row i on, after the initials that end in ``last``; ``run``: insertions just before."""
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        new = {"": "user", "s": "user", "a": "user", "u": "assistant"}[last]
        if run < 2:
            c, a, r = go(i, new[0], run + 1)
            options.append((c + 3, "I" + a, ((new, ""),) + r))
        if i < len(rows):
            role, text = rows[i][2], rows[i][3]
            c, a, r = go(i + 1, last, 0)
            options.append((c + 4, "D" + a, r))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                fits = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
                if role and role[0] in fits:
                    c, a, r = go(i + 1, role[0], 0)
                    options.append((c + more, "K" + a, ((role, text),) + r))
                c, a, r = go(i + 1, new[0], 0)
                options.append((c + 3 + more, "R" + a, ((new, text),) + r))
        return min(options) if options else (10**9, "", ())

    return go(0, "", 0)


def by_hand(rows):
    found = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in damaged(rows) if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        faults = faults_of(own)
        turns = {r[1] for r in own if r[1] is not None}
        initials = [r[2][:1] for r in own]
        cost, audit, repaired = best(own, tuple(faults))
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256(text.encode()).hexdigest(),
        )
    return found


def made(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "open", "", " \n", "end. \t", "a?b", "Long " * 50 + ".", "x ", "ü.", "same.", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "User", "usher", None]
    rows = []
    for conv in range(convs):
        turn = rng.randrange(3)
        for _ in range(rng.randrange(longest)):
            rows.append((conv, turn, rng.choice(roles[: rng.choice([2, 3, 10])]), rng.choice(texts)))
            turn += rng.choice([1, 1, 1, 2, 40])
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(5)


def result(found):
    return {r.conv_id: tuple(r)[1:] for r in found.collect()}


@pytest.mark.parametrize("piece", [repair.PIECE, 3])
def test_equals_trying_everything(spark, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE", piece)
    rows = made(3, 400, 14) + [(None, 1, "user", "a."), (None, 2, "user", "b."), (-7, None, "assistant", "c.")]
    convs = frame(spark, rows)
    found = result(repair.audit(repair.damage(convs), convs))
    assert found == by_hand(rows)
    assert len({f[6] for f in found.values()}) > 100


def test_batches_cut_conversations(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", 50)
    rows = made(5, 30, 40) + [(99, i, ("user", "assistant")[i % 3 % 2], f"turn {i}.") for i in range(900)]
    convs = frame(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = result(repair.audit(repair.damage(convs), convs))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    hand = by_hand([r for r in rows if r[0] != 99])
    assert {k: v for k, v in found.items() if k != 99} == hand
    # the long one against a plain table of costs
    own = [r for r in damaged(rows) if r[0] == 99]
    faults = faults_of(own)
    ahead = {"": 0, "s": 6, "u": 3, "a": 0}
    for (_, _, role, _), fault in zip(reversed(own), reversed(faults)):
        new = {"": "u", "s": "u", "u": "a", "a": "u"}
        now = {}
        for last in ahead:
            ways = [ahead[last] + 4]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                ways.append(ahead[new[last]] + 3 + more)
                if role[0] in {"": "su", "s": "u", "u": "a", "a": "u"}[last]:
                    ways.append(ahead[role[0]] + more)
            now[last] = min(ways)
        for _ in range(3):
            now = {k: min(v, 3 + now[new[k]]) for k, v in now.items()}
        ahead = now
    assert found[99][5] == ahead[""]


def test_no_rows_after_damage(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    convs = frame(spark, [(5, gone, "user", "Hi.")])
    empty = hashlib.sha256(b"").hexdigest()
    assert result(repair.audit(repair.damage(convs), convs)) == {5: (0, 0, 0, 0, 0, 0, "", empty)}
    assert repair.audit(repair.damage(convs.limit(0)), convs.limit(0)).count() == 0


def test_repeated_rows_of_one_turn(spark):
    rows = [(1, 1, "user", "Hello."), (1, 1, "user", "Hello."), (1, 1, "user", "Hello."), (1, None, "system", "Be kind.")]
    convs = frame(spark, rows)
    found = result(repair.audit(convs))
    assert found[1][:7] == (0, 0, 2, 0, 2, 11, "KKDDI")


def test_repaired_rows(spark):
    rows = made(8, 60, 12)
    convs = frame(spark, rows)
    edits = repair.repair(repair.damage(convs), convs).collect()
    hand = by_hand(rows)
    for conv, values in hand.items():
        own = [r for r in edits if r.conv_id == conv]
        kept = sorted((r for r in own if r.edit != "D"), key=lambda r: r.pos)
        assert sorted(r.edit for r in own) == sorted(values[6])
        assert all(r.pos is None for r in own if r.edit == "D")
        text = "\n".join(f"{r.role}:{r.text}" for r in kept)
        assert hashlib.sha256(text.encode()).hexdigest() == values[7]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in kept))


def test_very_long_texts(spark):
    long_text = "word " * 400_000
    rows = [(1, 0, "user", long_text), (1, 1, "assistant", long_text + "!"), (2, 0, "assistant", "Yes.")]
    convs = frame(spark, rows)
    assert result(repair.audit(convs))[1][:7] == (0, 0, 0, 1, 0, 3, "KK")
