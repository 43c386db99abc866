import random
import re

from topicloom.llm import line_dedup as ld

GAP = re.compile(r"[\x20\x09-\x0D]+")


def alike(a, b):
    if a == b:
        return True
    if min(len(a), len(b)) < ld.MIN_NEAR or abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    skip = 1 if len(a) == len(b) else 0
    return any(a[:i] == b[:i] and a[i + 1 :] == b[i + skip :] for i in range(len(a)))


def brute(docs):
    lines = [(i, n, tuple(w for w in GAP.split(x) if w), x) for i, t in docs for n, x in enumerate((t or "").split("\n"))]
    lines.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    kept = {}
    for at, (i, n, words, line) in enumerate(lines):
        if not words or not any(p[2] and alike(words, p[2]) for p in lines[:at]):
            kept.setdefault(i, []).append(line)
    return {i: "\n".join(kept.get(i, [])) for i, _ in docs}


def test_equals_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["ab", "cd", "ef", "gh"]
    base = [[rng.choice(vocabulary) for _ in range(n)] for n in (8, 10, 11, 15, 16, 17, 31, 32, 33, 40) for _ in range(3)]

    def edited():
        words = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words))
            kind = rng.randrange(3)
            words[at : at + (kind != 0)] = [] if kind == 1 else [rng.choice(["ab", "zz"])]
        return rng.choice(["", " "]) + rng.choice([" ", "  ", "\t"]).join(words)

    docs = [(i, "\n".join(rng.choice([edited(), edited(), "", " ", "short line"]) for _ in range(6))) for i in range(120)]
    docs += [(200, None), (201, ""), (None, docs[0][1])]
    df = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, n_kept int")
    got = {r.doc_id: r.text for r in ld.dedup_lines(df).collect()}
    assert got.pop(200) is None
    want = brute(docs)
    want.pop(200)
    assert got == want


def test_repeated_rows_and_very_long_lines(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    other = long.replace(" w777 ", " changed ")
    rows = [(1, long), (2, other), (3, "plain words\n" * 3000), (3, "plain words\n" * 3000), (-4, "plain words")]
    got = ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = {r.doc_id: (r.text, r.n_lines, r.n_kept) for r in got}
    assert len(got) == 5 and text[1] == (long, 1, 1) and text[2] == ("", 1, 0)
    assert text[3] == ("", 3000, 0) and text[-4] == ("plain words", 1, 1)


def test_lines_of_null_ids_are_judged_by_row(spark):
    copy, near = " ".join(f"w{i}" for i in range(12)), " ".join(f"w{i}" for i in range(11)) + " other"
    rows = [(1, copy), (None, near + "\nfirst own line"), (None, "second own line\nthird own line"), (2, "a line"), (2, "b line\na line")]
    got = {(r.doc_id, r.n_lines, r.n_kept, r.text) for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    fixed = {(1, 1, 1, copy), (None, 2, 1, "first own line"), (None, 2, 2, "second own line\nthird own line")}
    rest = got - fixed
    assert fixed <= got and sum(r[2] for r in rest) == 2 and len(rest) == 2
