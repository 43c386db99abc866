import random
import re

import pytest

from topicloom.llm import license_scan
from topicloom.llm.license_scan import NOTICES, PHRASES, TEMPLATES, Template

SCHEMA = "doc_id long, text string, row int, at int, spans string, w0 int, label string"


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def base(text):
    words, found = words_of(text), []
    for t in PHRASES:
        phrase = t.text.split()
        found += [(i, t.label) for i in range(len(words)) if words[i:i + len(phrase)] == phrase]
    starts = [i for i, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found})))


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 1, 2, "s", 3, "l") for i, t in rows], SCHEMA)
    return license_scan.digest(license_scan.scan(df.repartition(3), **options)).collect()


def test_phrases_against_a_search_of_every_place(spark):
    rng = random.Random(3)
    pieces = ["MIT", "mit", "License", "license", "APACHE", "general", "public", "Général", "x", "7", "é"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", "\n", ", ", "", "\t"]) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += [None, "", " \n", "mit license", "MIT-License\0mit license", "general public license " * 5000, "licenſe mit", "mit"]
    rows = [(i % 250, t) for i, t in enumerate(texts)] + [(None, "the MIT License"), (None, None), (None, "the MIT License")]
    key = lambda r: tuple(str(x) for x in r)
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found(spark, rows)]
    assert sorted(got, key=key) == sorted([(i, *base(t)) for i, t in rows], key=key)


@pytest.mark.parametrize("broadcast", [True, False])
def test_changed_copies_of_templates_are_found(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(license_scan, "MOST_WORDS", 0)
    rng = random.Random(5)
    rows, want = [], {}
    for i, t in enumerate(n for n in NOTICES if len(n.text.split()) >= 30):
        words = t.text.split()
        lead = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(500))]
        # A word put in, one left out and one replaced, far from each other.
        third = len(words) // 3
        changed = words[:third] + ["added"] + words[third:2 * third] + words[2 * third + 1:-2] + ["else"] + words[-1:]
        rows.append((i, " ".join(lead + changed).upper()))
        want[i] = t.label
    rows.append((100, " ".join(NOTICES[1].text.split()[:20])))
    got = {r["doc_id"]: r for r in found(spark, rows)}
    for i, label in want.items():
        assert label in got[i]["labels"].split(","), rows[i]
        assert 0.75 <= got[i]["score"] <= 1
    assert got[100]["labels"] == "" and 0 < got[100]["score"] < 0.75


def test_spans_and_scores(spark):
    own = (Template("long", "a b c d e f g h"), Template("two", "p q"), Template("word", "k l", True))
    rows = [(1, "x a b c d NEW e f g h y"), (2, "a b c x d e f"), (3, "p q p q"), (4, "p x q"), (5, "l k"), (6, "a b c d e f g h a b c d e f g h")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: ([(s["label"], s["start"], s["end"]) for s in r["spans"]], r["score"]) for r in license_scan.scan(df, own).collect()}
    assert got[1] == ([("long", 1, 9)], 1.0)
    assert got[2] == ([("long", 0, 6)], 0.75)
    assert got[3] == ([("two", 0, 3)], 1.0)
    assert got[4] == ([], 0.0) and got[5] == ([], 0.0)
    assert got[6] == ([("long", 0, 7), ("long", 8, 15)], 1.0)


def test_a_template_needs_two_words(spark):
    with pytest.raises(ValueError):
        license_scan.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"), (Template("x", "mit"),))


def test_texts_of_templates_are_in_the_form_of_words():
    assert all(words_of(t.text) == t.text.split() for t in TEMPLATES)
