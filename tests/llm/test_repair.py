"""Structure repair against plain dynamic programming and exhaustive search."""

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seispark.llm import repair

ASCII_BLANK = " \t\n\x0b\x0c\r"


def best(kinds):
    """(cost, audit) by dynamic programming over (cost, audit) of every state."""
    ways = {0: (0, "")}

    def inserted(ways):
        for _ in range(3):
            for q, (c, a) in list(ways.items()):
                to = repair.wanted(q)
                ways[to] = min(ways.get(to, (1 << 60, "")), (c + 2, a + "I"))
        return ways

    for k in kinds:
        new = {}
        for q, (c, a) in inserted(ways).items():
            options = [("D", 3, q)]
            if k != "x":
                extra = int(k.isupper())
                options.append(("R", 2 + extra, repair.wanted(q)))
                if k.lower() == "s" and q == 0 or k.lower() == "u" and q in (0, 1, 3) or k.lower() == "a" and q == 2:
                    options.append(("K", extra, {"s": 1, "u": 2, "a": 3}[k.lower()]))
            for e, w, to in options:
                new[to] = min(new.get(to, (1 << 60, "")), (c + w, a + e))
        ways = new
    ways = inserted(ways)
    return min(ways[q] for q in (0, 3) if q in ways)


def every_way(kinds, most):
    """(cost, audit) by trying all audits with up to ``most`` insertions."""
    found = []

    def go(i, out, cost, audit, left):
        if i == len(kinds) and re.fullmatch("(s?(ua)+)?", out):
            found.append((cost, audit))
        if left:
            for r in "ua":
                go(i, out + r, cost + 2, audit + "I", left - 1)
        if i < len(kinds):
            k = kinds[i]
            go(i + 1, out, cost + 3, audit + "D", left)
            if k != "x":
                extra = int(k.isupper())
                go(i + 1, out + k.lower(), cost + extra, audit + "K", left)
                for r in "ua":
                    go(i + 1, out + r, cost + 2 + extra, audit + "R", left)

    go(0, "", 0, "", most)
    return min(found)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_every_short_conversation(n):
    for kinds in itertools.product("suaUxo", repeat=n):
        kinds = "".join(kinds)
        assert repair.lightest(kinds)[:2] == every_way(kinds, 3) == best(kinds), kinds


@settings(max_examples=300, deadline=None)
@given(st.text("suaSUAoOx", max_size=40), st.integers(1, 7))
def test_chunks_give_the_derivation_of_the_whole(kinds, size):
    want = best(kinds)
    assert repair.lightest(kinds)[:2] == want
    parts = [kinds[k : k + size] for k in range(0, len(kinds), size)] or [""]
    finals, behind = (0, repair.NEVER, repair.NEVER, 0), []
    for k in reversed(range(len(parts))):
        behind.append(finals)
        finals = repair.costs_to(parts[k], finals, k == len(parts) - 1)
    state, cost, audit = 0, 0, ""
    for k, (part, final) in enumerate(zip(parts, reversed(behind))):
        c, a, state = repair.lightest(part, state, final, k == len(parts) - 1)
        cost, audit = cost + c, audit + a
    assert (cost, audit) == want


def plain(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, lines)} by loops."""
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or "", turn))
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: r[:4])
        turns = [r[4] for r in own if r[4] is not None]
        kinds, seen, faults, initials = "", set(), [0, 0, 0], []
        for _, _, role, text, _ in own:
            bare = text.strip(ASCII_BLANK)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            initials.append(initial)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            kinds += "x" if fault in (0, 1) else initial.upper() if fault == 2 else initial
        cost, audit = best(kinds)
        lines, i, last = [], 0, ""
        for e in audit:
            follow = "assistant" if last == "u" else "user"
            if e == "I":
                lines.append((follow, ""))
            else:
                role, text = own[i][2:4]
                i += 1
                if e == "D":
                    continue
                lines.append((role if e == "K" else follow, text))
            last = lines[-1][0][0]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, *faults, illegal, cost, audit, lines)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, _conv string, cost string, steps int"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."), (1, 5, "assistant", "cut off"), (1, 6, "user", " \n"),
    (2, 0, "assistant", "No question?"), (2, 0, "assistant", "No question?"), (2, 3, "user", "tail \t"), (2, None, "user", "early."),
    (None, None, None, None), (None, 1, "tool", "result."), (None, 2, "user", "so?"), (3, 0, "user", ""), (4, 4, "", "x."), (4, 4, "User", "é — ß"),
    (5, 0, "user", "a." * 4000), (5, 1, "assistant", "b! " * 4000),
]
LONG = [(7, k // 2, ("user", "assistant", "system", "user")[k * 7 % 4], f"text {k % 19}" + "." * (k % 3)) for k in range(700)] + [(8, 3, "user", "same.")] * 50


@pytest.mark.parametrize("chunk", [4, 256])
def test_same_as_loops(spark, chunk):
    rows = ROWS + LONG
    found = repair.Repair(rows_of(spark, rows).repartition(5), chunk=chunk)
    want = plain(rows)
    got = {None if r["_conv"] == repair.NULL_ID else r["_conv"]: r for r in found.summary().collect()}
    assert set(got) == set(want)
    for conv, r in got.items():
        assert tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")) == want[conv][:-1], conv
    lines = {}
    for r in sorted(found.repaired().collect(), key=lambda r: (r["_part"], r["_seq"], r["_n"])):
        lines.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert lines == {c: w[-1] for c, w in want.items() if w[-1]}
    digests = {None if r["_conv"] == repair.NULL_ID else r["_conv"]: r["repaired_sha256"] for r in found.digests().collect()}
    assert digests == {c: hashlib.sha256("\n".join(f"{r}:{t}" for r, t in w[-1]).encode()).hexdigest() for c, w in want.items() if w[-1]}


def test_empty_table(spark):
    found = repair.Repair(rows_of(spark, []))
    assert found.summary().collect() == [] == found.repaired().collect() == found.digests().collect()


def test_damage(spark):
    from seispark.llm.queries import damaged

    rows = [(c, t, "assistant", f"Text {t}. Yes! No?") for c in range(40) for t in range(5)] + [(None, None, None, None), (41, None, "user", None)]
    want = []
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        want += [(c, t, "user" if f == 4 else role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
    got = damaged(rows_of(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
