"""Licence texts in the shapes that files have them in, and inheritance by brute force."""

import textwrap

import numpy as np
import pytest

from lexiform.llm import license_scan as ls

TEXT = dict(ls.TEXTS)
PROSE = "The morning train was late again and nobody on the platform seemed to mind very much.\n" * 12


def shapes(text):
    wrapped = textwrap.fill(text.replace("conditions: ", "conditions:\n\n"), 78, replace_whitespace=False)
    return {"wrapped": wrapped, "one_line": text, "hash": "\n".join(f"# {x}".rstrip() for x in wrapped.split("\n")), "block": "/*\n" + "\n".join(f" * {x}".rstrip() for x in wrapped.split("\n")) + "\n */"}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(f"{n}/{k}/LICENSE", f"{n} License\n\nCopyright (c) 2020 The Authors\n\n{t}\n") for n, text in TEXT.items() for k, t in shapes(text).items()]
    rows += [(f"{n}/{k}/code.py", t + "\n\n" + PROSE) for n, text in TEXT.items() for k, t in shapes(text).items()]
    rows += [(f"{n}/{k}/x/y/other.py", PROSE) for n in TEXT for k in ("hash",)]
    rows += [(f"plain/{i}.txt", PROSE + f"number {i}") for i in range(60)]
    d = spark.createDataFrame([(p, t, 0, "x") for p, t in rows], "path string, text string, dir int, licence string")
    return {r.path: r for r in ls.scan(d).collect()}


@pytest.mark.parametrize("name", list(TEXT))
def test_whole_licences_in_every_shape(found, name):
    for k in shapes(TEXT[name]):
        r = found[f"{name}/{k}/LICENSE"]
        assert (r.licence, r.how) == (name, "file") and r.similarity > 0.8
    r = found[f"{name}/hash/x/y/other.py"]
    assert (r.licence, r.how, r.from_dir) == (name, "inherited", f"{name}/hash")


@pytest.mark.parametrize("name", ["MIT", "Apache-2.0", "GPL-3.0", "MPL-2.0", "Zlib", "Unlicense"])
def test_headers_above_code(found, name):
    for k in shapes(TEXT[name]):
        assert found[f"{name}/{k}/code.py"].licence == name


def test_prose_has_no_licence(found):
    assert {r.licence for p, r in found.items() if p.startswith("plain")} == {None}


def test_inheritance_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    names = ["MIT", "Apache-2.0", "ISC", "Zlib"]
    dirs = sorted({"/".join(rng.choice(list("abc"), int(rng.integers(1, 5)))) for _ in range(40)})
    own = {d: names[i % 4] for i, d in enumerate(dirs) if rng.random() < 0.3}
    rows = [(f"{d}/LICENSE", TEXT[n]) for d, n in own.items()] + [(f"{d}/f{i}.py", "nothing here") for d in dirs for i in range(2)] + [("top.py", "nothing"), ("a/b/../odd.py", None), (None, "nothing")]
    got = {r.path: (r.licence, r.from_dir) for r in ls.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    for d in dirs:
        up = ["/".join(d.split("/")[:k]) for k in range(len(d.split("/")), 0, -1)]
        near = next((u for u in up if u in own), None)
        assert got[f"{d}/f0.py"] == got[f"{d}/f1.py"] == (own.get(near), near)
    assert got[None] == (None, None) and got["top.py"] == (None, None)


def test_nulls_long_texts_and_repeated_rows(spark):
    long = PROSE * 300 + "\n# Licensed under CC BY 4.0.\n" + PROSE * 300
    d = spark.createDataFrame([("a/LICENSE", None), ("a/x", ""), ("b/x", long), ("b/x", long), ("c/LICENSE", "words only")], "path string, text string")
    got = sorted((r.path, r.licence, r.how) for r in ls.scan(d).collect())
    assert got == [("a/LICENSE", None, "none"), ("a/x", None, "none"), ("b/x", "CC-BY-4.0", "header"), ("b/x", "CC-BY-4.0", "header"), ("c/LICENSE", None, "none")]
