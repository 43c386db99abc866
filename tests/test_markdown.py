import time

import pytest
from pyspark.sql import functions as F

from topicloom.functions import markdown as md
from topicloom.plans.extract import extract_documents, parse_markdown

DOC = """---
title: Using the Cache well
description: How caching works in practice
---
# Using the Cache
Read [the guide](http://x.example/guide "Full user guide") and `SetCache()` for **bold text**.

## 1. Setup steps
- first item

> quoted line

```
excluded code
```
"""

MORE = DOC + """
Underlined one
==============

Second style
------------

| col a | col b |
|-------|-------|
| cella | cellb |

See http://bare.example/path now.

    indented code gone

~~~
# not a header
~~~

[ref1]: http://hidden.example "Reference tool tip"
[ref2]: http://hidden.example "Single"
"""


def parse(spark, text):
    df = spark.createDataFrame([("f.md", text)], "File string, content string")
    row = parse_markdown(df).first()
    return [(h.level, h.text) for h in row.headings], row.plain


def docs(spark, *texts):
    df = spark.createDataFrame([(f"f{i}.md", t) for i, t in enumerate(texts)], "File string, content string")
    return {r.File: r for r in extract_documents(df).collect()}


def test_worked_document(spark):
    headings, _ = parse(spark, DOC)
    assert headings == [
        (0, "Using the Cache well"), (2, "How caching works in practice"),
        (1, "Using the Cache"), (2, "Setup steps"),
    ]
    row = docs(spark, DOC)["f0.md"]
    assert list(row)[1:7] == [
        "Using the Cache well", "Using the Cache", "How caching works in practice", "Setup steps", None, None,
    ]
    assert sorted(row.Words.split(" ")) == sorted(
        ("Using the Cache well How caching works in practice Using the Cache Setup steps "
         "Read the guide Full user guide and for bold text first item quoted line").split(" ")
    )


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_longer_document_and_line_ends(spark, end):
    text = MORE.replace("\n", end)
    headings, _ = parse(spark, text)
    assert headings[4:] == [(1, "Underlined one"), (2, "Second style")]
    words = docs(spark, text)["f0.md"].Words.split(" ")
    for word in ("cella", "cellb", "bare", "path", "Reference", "tip"):
        assert word in words
    for word in ("hidden", "Single", "indented", "not", "guide/", "excluded"):
        assert word not in words


def test_dropped_documents(spark):
    assert docs(spark, "", "text only", "# API", None, "# Long enough") .keys() == {"f4.md"}


@pytest.mark.parametrize(
    "line, want",
    [
        ("# Plain title #", [(1, "Plain title")]),
        ("### Using `foo` here", [(3, "Using")]),
        ("## [Only link](http://x)", []),
        ("#**Bold** tail text", [(1, "tail text")]),
        ("## Before **bold** after", [(2, "Before")]),
        ("####### Seven", [(6, "Seven")]),
        ("> ## Quoted head", [(2, "Quoted head")]),
        ("- # In a list", [(1, "In a list")]),
        ("- item\n---", []),
        ("> quote\n---", []),
        ("Two lines\nlast line\n===", [(1, "last line")]),
        ("# A\n---", [(1, "A")]),
        ("```\n# in code\n```", []),
        ("```\n# never closed", []),
        ("see [`x`](u) ok\n\n# T", [(1, "T")]),
        ("# 12 34", [(1, "12 34")]),
        ("---\nTITLE : From front\n---\ntext", [(0, "From front")]),
        ("---\ntitle:\ntitle: second\n---\n", []),
        ("text\n---\ntitle: no\n---\n", [(2, "text"), (2, "title: no")]),
    ],
)
def test_headings(spark, line, want):
    assert parse(spark, line)[0] == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("![alt](a.png) x", "alt x"),
        ("[![img](a.png)](http://u) x", "img x"),
        ('[t](u "two words") x', "two words t x"),
        ('[t](u "single") x', "t x"),
        ("[t](http://e/a_(b)) x", "t x"),
        ("[text][ref] x", "text x"),
        ("a ``x`y`` b", "a b"),
        ("a\n\n    code\n    more\n\nb", "a b"),
        ("- a\n\n    continued\n\nb", "a continued b"),
        ("\tcode first\n\nb", "b"),
        ("[wrapped\ntext](u) x", "wrapped text x"),
        ("~~~\nx\n```\ny\n~~~\nz", "z"),
        ("````\na\n```\nb\n````\nc", "c"),
        ("- ```\n  a\n  ```\n- b", "b"),
        ("> ```\n> a\n> ```\n> b", "b"),
        ("1. ~~~~\n   a\n   ~~~\n   ~~~~~\n\nb", "b"),
        ("```\na\n``` no end\nb", ""),
        ("x ```y``` z", "x z"),
        ("a | b\n- c\n> d\n* * *\n_e_ f", "a b c d e f"),
    ],
)
def test_plain_text(value, text, want):
    def words(c):
        body = md.plain_text(md.drop_code_blocks(c))
        return F.trim(F.regexp_replace(body, "[^a-z]+", " "))

    assert value(words, text) == want


HARD = {
    "long": MORE * 3000,
    "open fence": "x\n" + "```\n" + "code line\n" * 200_000,
    "long fence": "`````\n" + "````\n" * 1_000_000,
    "fences in items": "- ```\n  code\n  ```\n" * 200_000,
    "brackets": "[" * 300_000,
    "links": "[a](b " * 60_000,
    "open tip": '[a](b "' + "x y-z " * 100_000,
    "stars": "# " + "*a " * 100_000,
    "indented": "a\n\n" + "    code\n" * 100_000,
    "quotes": ">" * 200_000 + " x",
    "backticks": "``" * 100_001 + "x",
    "one line": "word " * 400_000,
    "open front": "---\n" + "a: b\n" * 200_000,
    "rules": "-\n" * 200_000,
    "definitions": "[a]: b\n" * 100_000,
    "blank lines": "a\n" + " \n" * 200_000,
    "header marks": "# a " + "#" * 1_000_000 + " b",
    "header blanks": "# a" + " " * 1_000_000 + "b",
}


@pytest.mark.parametrize("name", HARD)
def test_hard_texts_stay_linear(spark, name):
    df = spark.createDataFrame([("f.md", HARD[name])], "File string, content string")
    started = time.time()
    extract_documents(df).collect()
    parse_markdown(df).select(F.length("plain")).collect()
    assert time.time() - started < 20
