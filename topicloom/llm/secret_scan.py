"""Secret scan: keyword automaton, anchored patterns at its hits, embedded checksums.

An Aho-Corasick automaton passes over each text once and names the places where a keyword stands. Patterns are
tried only there, anchored, so a text without keywords costs one pass. Runs of hexadecimal digits have no keyword
and are found by their own pattern. Tokens that carry a checksum (the last six characters are the CRC-32 of the
payload in base 62) count only if it holds.

Null and empty texts give no spans, very long ones are scanned whole, and an empty table gives no rows. A row gives a row: repeated rows and null ids are kept as they are. Only the id
and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keywords, patterns, least lengths, in the order in which kinds are listed.
ASSIGN_KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
HEX = rb"[0-9a-f]{24,}"
CHECKED = rb"(?:gh[pousr]|npm)_[A-Za-z0-9]+"
CHECKED_KEYWORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = ("assign", "access", "hex", "checked")
BASE_KINDS = KINDS[:3]

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def checksum_holds(token: bytes) -> bool:
    """Whether the six last characters are the base-62 CRC-32 of the payload before them."""
    body = token.split(b"_", 1)[1]
    if len(body) != 36:
        return False
    value, digits = zlib.crc32(body[:-6]), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0").encode() == body[-6:]


class Scanner:
    """Finds spans in one text; built once per task."""

    def __init__(self) -> None:
        import ahocorasick

        self.words = ahocorasick.Automaton()
        for kind, keys in (("assign", ASSIGN_KEYWORDS), ("access", ("akia",)), ("checked", CHECKED_KEYWORDS)):
            for key in keys:
                self.words.add_word(key, (kind, len(key)))
        self.words.make_automaton()
        self.patterns = {"assign": re.compile(ASSIGN, re.I), "access": re.compile(ACCESS), "checked": re.compile(CHECKED)}
        self.accept = {
            "assign": lambda m: m.end(1) - m.start(1) >= 6,
            "access": lambda m: m.end() - m.start() >= 20,
            "checked": lambda m: checksum_holds(m[0]),
        }
        self.hex = re.compile(HEX)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start, then kind."""
        data = text.encode("utf-8", "surrogatepass")
        found = [(m.start(), m.end(), 2) for m in self.hex.finditer(data)]
        # Bytes as Latin-1 keep their places, and only A-Z change case.
        hits = sorted((end - size + 1, kind) for end, (kind, size) in self.words.iter(data.lower().decode("latin-1")))
        ends = dict.fromkeys(self.patterns, 0)
        for start, kind in hits:
            if start >= ends[kind] and (m := self.patterns[kind].match(data, start)):
                ends[kind] = m.end()
                if self.accept[kind](m):
                    found.append((start, m.end(), KINDS.index(kind)))
        found.sort(key=lambda x: (x[0], x[2]))
        if len(data) == len(text):
            return [(KINDS[kind], start, end) for start, end, kind in found]
        points, at, count = {}, 0, 0
        for place in sorted({x for start, end, _ in found for x in (start, end)}):
            count += len(data[at:place].decode("utf-8", "surrogatepass"))
            points[place] = count
            at = place
        return [(KINDS[kind], points[start], points[end]) for start, end, kind in found]


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array of kind, start, end) for each row of ``df``; whole texts, no shuffle."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def scan(batches):
        scanner = Scanner()
        for batch in batches:
            spans = [
                [] if text is None else [{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans(text)]
                for text in (x.as_py() for x in batch.column(1))
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["id", "spans"])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("spans", T.ArrayType(SPAN))])
    return rows.mapInArrow(scan, schema).withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the digest of the base spans and all spans as text."""
    line = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE_KINDS))
    return found.select(
        id_col,
        *(of(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"),
        of("checked").alias("n_checked"),
    )
