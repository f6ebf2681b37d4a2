"""License scan against plain Dice coefficients."""

import re

import pytest
from helpers import awkward, with_clash

from seispark.llm import licenses
from seispark.llm.text import NULL_ID


def pairs(text):
    w = [x for x in re.sub(r"[^\w]|_", " ", text.lower()).split() if x]
    return set(zip(w, w[1:]))


def plain(rows, least):
    out = {}
    for i, t in {(i, t) for i, t in rows}:
        lines = (t or "").split("\n")
        units = [(x, False) for x in lines] + ([(t, True)] if len(lines) > 1 else [])
        for unit, whole in units:
            hit = []
            for k, (name, template) in enumerate(licenses.TEMPLATES):
                a, b = pairs(unit), pairs(template)
                if a and b and 2 * len(a & b) / (len(a) + len(b)) >= least:
                    hit.append((-2 * len(a & b) / (len(a) + len(b)), k, name))
            if hit:
                score, _, name = min(hit)
                s, n, w = out.get((i, name), (0, 0, False))
                out[i, name] = (max(s, -score), n + (not whole), w or whole)
    return sorted((NULL_ID if i is None else i, name, *v) for (i, name), v in out.items())


@pytest.mark.parametrize("least", [0.6, 0.9])
def test_same_as_plain_scan(spark, least):
    texts = [t for _, t in licenses.TEMPLATES]
    rows = awkward(2000) + [(100 + k, f"Some code\n{t}\nmore code here") for k, t in enumerate(texts)]
    rows += [(200, "ALL RIGHTS, RESERVED!"), (201, "Licensed under\nthe Apache License, Version 2.0."), (202, "Licensed under the Apache License version 2.0 or later"), (None, texts[2])]
    rows += [(203, "all rights reserved " * 400), (204, "\n".join(["Released under the MIT License."] * 50))]
    got = licenses.scan(with_clash(spark, rows), least=least).collect()
    found = sorted((r["_id"], r["license"], r["score"], r["n_lines"], r["whole_text"]) for r in got)
    want = plain(rows, least)
    assert [f[:2] + f[3:] for f in found] == [w[:2] + w[3:] for w in want]
    assert all(abs(f[2] - w[2]) < 1e-12 for f, w in zip(found, want))


def test_every_template_finds_its_license_alone(spark):
    rows = [(k, t) for k, (_, t) in enumerate(licenses.TEMPLATES)]
    got = {}
    for r in licenses.scan(with_clash(spark, rows)).collect():
        got.setdefault(r["_id"], []).append(r["license"])
    assert got == {k: [name] for k, (name, _) in enumerate(licenses.TEMPLATES)}


def test_nothing_and_no_templates(spark):
    assert licenses.scan(with_clash(spark, [])).collect() == []
    assert licenses.scan(with_clash(spark, [(1, None), (2, ""), (3, "one")])).collect() == []
