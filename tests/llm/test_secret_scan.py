import hashlib
import random
import re
import zlib

from topicloom.llm import secret_scan as s

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    """Base spans by whole-text patterns."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), 1) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), 2) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(s.KINDS[k], a, b) for a, b, k in sorted(found, key=lambda x: (x[0], x[2]))]


def checked(prefix, payload):
    value, digits = zlib.crc32(payload.encode()), ""
    while value:
        value, d = divmod(value, 62)
        digits = s.BASE62[d] + digits
    return prefix + payload + digits.rjust(6, "0")


def test_random_texts_equal_patterns():
    rng = random.Random(5)
    bits = ["password", "PassWd", "secret", "tOken", "api_key", "apikey", "akia", "AKIA", "=", ":", " ", "  ", '"', "'", "é", "ß", "\n", "a1b2c3d4e5f60718", "0123456789abcdef", "ABCDEF0123456789", "xyz", "ſecret", "toKen", "İ", "_", "==", "-"]
    scanner = s.Scanner()
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(40)))
        assert [x for x in scanner.spans(text) if x[0] in s.BASE_KINDS] == brute(text), text


def test_checksum_tokens():
    good = checked("ghp_", "aB3" * 10)
    assert s.Scanner().spans(f"ö {good} x") == [("checked", 2, 42)]
    assert s.Scanner().spans(good[:-1] + ("a" if good[-1] != "a" else "b")) == []
    assert s.Scanner().spans(checked("npm_", "z" * 30)) == [("checked", 0, 40)]


def test_nulls_long_texts_repeats_and_clashes(spark):
    long = "lorem ipsum " * 200_000 + 'token = "abcdef123"' + " é" * 10
    rows = [(1, None, "x"), (None, "token: abcdefg", "x"), (2, "", "x"), (3, long, "x"), (3, long, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(map(tuple, s.digest(s.find_secrets(df)).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    none = hashlib.sha256(b"").hexdigest()
    at = 12 * 200_000
    assert [r[:4] + (r[5],) for r in got] == [
        (1, 0, 0, 0, ""), (2, 0, 0, 0, ""), (3, 1, 0, 0, f"assign:{at}:{at + 18}"), (3, 1, 0, 0, f"assign:{at}:{at + 18}"), (None, 1, 0, 0, "assign:0:14"),
    ]
    assert got[0][4] == none and got[2][4] == hashlib.sha256(f"assign:{at}:{at + 18}".encode()).hexdigest()
