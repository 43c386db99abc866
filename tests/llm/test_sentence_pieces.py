import hashlib

import pytest

from topicloom.llm import sentence_pieces as sp
from topicloom.llm.queries import piece_model

TEXTS = ["", " ", "a  b\t▁c\x00 é", "Grüße, 世界 🎉 ﬁ", "x" * 5000, "the of and\nand " * 3000, "  lead and trail  "]


def test_digest_equals_the_library(spark):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, "x"), (1, " ", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sp.piece_digest(df, piece_model(), with_ids=True).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for r in got:
        text = texts[r.doc_id] or ""
        ids = own.encode(text)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(own.decode(ids).encode()).hexdigest()
        assert r.span_bytes == len(text.encode())


def test_spans_tile_the_source_and_round_trip(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    pieces = sp.encode_pieces(df, piece_model())
    own = sp.codec(piece_model())
    for r in pieces.collect():
        data = TEXTS[r.doc_id].encode()
        assert [b for b in r.starts[1:]] == r.ends[:-1] and (not data or (r.starts[0], r.ends[-1]) == (0, len(data)))
        for i, a, b in zip(r.ids, r.starts, r.ends):
            piece = own.processor.id_to_piece(i)
            if not piece.startswith("<0x"):
                assert data[a:b].decode() in (piece.replace("▁", " "), piece, piece[1:].replace("▁", " "))
    back = {r.doc_id: r.text for r in sp.decode_pieces(pieces, piece_model()).collect()}
    assert back == {i: t.replace("▁", " ") for i, t in enumerate(TEXTS)}


def trie(keys):
    """A small double-array trie with values, as compiled maps hold it."""
    units = {0: 0}
    taken = {0}

    def place(node, prefixes):
        labels = sorted({k[0] if k else 0 for k, _ in prefixes})
        # Children are at base ^ label; bases are multiples of 256 beyond all others, the offset is node ^ base.
        base = (max(taken) // 256 + 1) * 256
        offset = node ^ base
        assert offset < 1 << 21
        units[node] = units.get(node, 0) | offset << 10
        for label in labels:
            taken.add(base ^ label)
        for label in labels:
            child = base ^ label
            rest = [(k[1:], v) for k, v in prefixes if k and k[0] == label] if label else []
            if label == 0:
                units[child] = 1 << 31 | next(v for k, v in prefixes if not k)
                units[node] |= 1 << 8
            else:
                units[child] = units.get(child, 0) | label
                place(child, rest)

    place(0, keys)
    size = max(taken) + 1
    return b"".join(units.get(i, 0).to_bytes(4, "little") for i in range(size))


def test_character_map_takes_the_longest_prefix():
    targets = b"fi\0x\0 \0"
    blob = trie([("ﬁ".encode(), 0), (b"ab", 3), (b"abc", 0), ("\u3000".encode(), 5)])
    chars = sp.CharacterMap(len(blob).to_bytes(4, "little") + blob + targets)
    assert chars.longest("ﬁn".encode(), 0) == (3, b"fi")
    assert chars.longest(b"abd", 0) == (2, b"x")
    assert chars.longest(b"zabcd", 1) == (3, b"fi")
    assert chars.longest(b"zz", 0) is None


@pytest.mark.parametrize(("text", "want", "places"), [
    ("ﬁ  b ", "▁fi▁b", [0, 0, 0, 0, 0, 3, 3, 3, 5, 6]),
    ("  x", "▁x", [2, 2, 2, 2, 3]),
])
def test_normalisation_with_a_map_keeps_the_source(text, want, places):
    own = sp.PieceCodec(piece_model())
    blob = trie([("ﬁ".encode(), 0)])
    own.map = sp.CharacterMap(len(blob).to_bytes(4, "little") + blob + b"fi\0")
    own.spec.remove_extra_whitespaces = True
    size, align = own.normalise(text)
    assert size == len(want.encode()) and align.tolist() == places
