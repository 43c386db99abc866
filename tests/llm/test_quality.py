import re

from topicloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_base_counts_and_edge_cases(spark):
    long = "the quick brown fox of the wood " * 20_000
    texts = [None, "", " \n\t", "a b c a b c", "x\nx\n\n\nx ", "a a a a", "one two", "é ü | < 世界\u3000x", "the of and to in " * 12, "a\x0bb\x0cc\rd", "A!B\nA!B\n"]
    rows = [(i if i else None, t, "en", "x") for i, t in enumerate(texts)] + [(4, texts[4], None, "x"), (99, long, "en", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, kind string")
    got = quality.judge(df).collect()
    assert len(got) == len(rows)
    for r in got:
        have = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert have == (brute(r.text) if r.doc_id != 99 else (140_000, 500_000, 0, 0, 140_000)), r.text[:20]
        assert r.base_failed == (r.n_words < 50 or r.n_repeat_words * 100 > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_divergence_drops_shouting_and_keeps_prose(spark):
    import random

    rng = random.Random(9)
    words = quality.COMMON_WORDS["en"] * 3 + ["house", "water", "green", "hills", "winter", "letter", "people", "summer", "Stone,", "rivers."] * 4
    prose = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(40)]
    rows = [(i, t, "en") for i, t in enumerate(prose)]
    rows += [(100, " ".join(w + "!!" for w in prose[0].upper().split()), "en"), (101, prose[1], "xx"), (102, prose[2], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality.judge(df).collect()}
    assert kept.pop(100) is False and all(kept.values())


def test_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge(docs.select("doc_id", "text", "lang")).join(labels, "doc_id").filter("NOT base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    poor = [r for r in rows if r.quality == 0]
    assert sum(not r.kept for r in poor) >= 0.9 * len(poor)


def test_word_distance_rejects_alone_and_rare_languages_are_judged(spark):
    import random

    rng = random.Random(4)
    rest = [x + y for x in ("hou", "wat", "gre", "hil", "win", "let", "peo", "sum") for y in ("se", "er", "en", "ls", "ter", "ple")]
    prose = lambda n, common: " ".join(rng.choice(quality.COMMON_WORDS["en"] if rng.random() < common else rest) for _ in range(n))
    rows = [(i, prose(120, 0.4), "en") for i in range(60)]
    plain = prose(320, 0.4)
    rows += [(100, prose(70, 0.0), "en"), (101, prose(400, 0.0), "en")]
    rows += [(102, plain.upper() + " !!", None), (103, plain.upper(), "xx"), (104, plain, None), (105, plain, "xx")]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i in [*range(60), 104, 105])
    for i in (100, 101):
        assert got[i].class_distance < 0.28 and got[i].word_distance > 0.296 and not got[i].base_failed, got[i]
    assert not any(got[i].kept for i in (100, 101, 102, 103))
    assert got[103].word_distance is None


def test_all_labelled_documents_of_the_larger_scale(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(16)
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.judge(docs.select("doc_id", "text", "lang")).join(labels, "doc_id").filter("NOT base_failed").select("quality", "kept").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    poor = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in poor) <= 0.02 * len(poor)
