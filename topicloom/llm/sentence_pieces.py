"""SentencePiece encoding and decoding that keeps the place of every piece in the source bytes.

A text is normalised through the compiled character map of the model: at each place the longest key of the map is
replaced, or one character is copied. For every byte of the normalised text the source byte it came from is kept.
The library turns the text into ids; the byte lengths of the pieces, run over the normalised text, then give each
piece its span of source bytes. The lengths must add up to the normalised text exactly, so a normalisation that
differed from the library's would be noticed and not lead to wrong spans.

Null and empty texts give no pieces, a very long one is encoded whole in one task, and an empty table gives no rows.
A row gives a row, equal ones equal rows, whatever its id; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁".encode()
WIDTHS = np.array([1] * 192 + [2] * 32 + [3] * 16 + [4] * 16, np.int64)
CHUNK = 128


class CharacterMap:
    """Longest-prefix replacement with the double-array trie of a compiled map; an empty map copies."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.targets = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes taken at ``at`` and their replacement, or None if no key fits."""
        if not self.units:
            return None
        node, found = self._child(0, self.units[0]), None
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units) or self.units[node] & 0x800000FF != data[i]:
                break
            unit = self.units[node]
            node = self._child(node, unit)
            if unit >> 8 & 1:
                found = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.targets[start : self.targets.index(0, start)]

    @staticmethod
    def _child(node: int, unit: int) -> int:
        return node ^ (unit >> 10) << ((unit & 512) >> 6)


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.path = path
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        self.spec = model.normalizer_spec
        self.map = CharacterMap(self.spec.precompiled_charsmap)
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.widths = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN), -1)
        self.decimal = [str(i) for i in range(len(model.pieces))]

    def __reduce__(self):
        return PieceCodec, (self.path,)

    def normalise(self, text: str) -> tuple[int, np.ndarray]:
        """Bytes of the normalised text, and for each of them, and the end, the source byte."""
        data = text.encode("utf-8", "surrogatepass")
        if not data:
            return 0, np.zeros(1, np.int64)
        spec = self.spec
        mark = len(SPACE) if spec.escape_whitespaces else 1
        if not self.map.units and not spec.remove_extra_whitespaces:
            # Without a map every byte stands for itself, and a space for the bytes of the mark.
            source = np.frombuffer(data, np.uint8)
            times = np.where(source == 32, mark, 1)
            align = np.repeat(np.arange(len(data)), times)
            if spec.add_dummy_prefix:
                align = np.concatenate([np.zeros(mark, np.int64), align])
            return len(align), np.append(align, len(data))
        align: list[int] = []
        at, blank = 0, spec.remove_extra_whitespaces
        trail = 0
        while at < len(data):
            taken, new = self.map.longest(data, at) or (0, b"")
            if not taken:
                taken = int(WIDTHS[data[at]])
                new = data[at : at + taken]
            for byte in new:
                if byte != 32:
                    if not align and spec.add_dummy_prefix:
                        align += [at] * mark
                    align.append(at)
                    blank, trail = False, 0
                elif not (blank and spec.remove_extra_whitespaces):
                    if not align and spec.add_dummy_prefix:
                        align += [at] * mark
                    align += [at] * mark
                    blank, trail = True, mark
            at += taken
        end = len(data)
        if spec.remove_extra_whitespaces and trail:
            end = align[-trail]
            del align[-trail:]
        return len(align), np.append(np.array(align, np.int64), end)

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each piece in the bytes of ``text``."""
        size, align = self.normalise(text)
        widths = self.widths[ids] if ids else np.zeros(0, np.int64)
        if self.unknown in ids:
            pieces = self.processor.encode(text, out_type=str)
            widths = np.array([w if i != self.unknown else len(p.encode()) for i, w, p in zip(ids, widths, pieces, strict=True)])
        ends = np.cumsum(widths)
        if (ends[-1] if len(ends) else 0) != size:
            raise ValueError("the pieces do not cover the normalised text")
        return align[ends - widths], align[ends]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The codec of a model file, loaded once for each task."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def _chunks(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            part = batch.slice(start, CHUNK)
            yield part.column(0), [x or "" for x in part.column(1).to_pylist()]


def encode_pieces(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, starts, ends) of each row: piece ids and their spans in the UTF-8 bytes of the text."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        own = codec(model)
        for keys, texts in _chunks(batches):
            ids = own.encode(texts)
            places = [own.spans(t, i) for t, i in zip(texts, ids, strict=True)]
            columns = [ids, [a for a, _ in places], [b for _, b in places]]
            yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, pa.list_(t)) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True))], ["id", "ids", "starts", "ends"])

    kind = rows.schema["id"].dataType
    return rows.mapInArrow(run, T.StructType([T.StructField("id", kind)]).add("ids", T.ArrayType(T.IntegerType())).add("starts", T.ArrayType(T.LongType())).add("ends", T.ArrayType(T.LongType()))).withColumnRenamed("id", id_col)


def decode_pieces(df: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of each row; null ids are none."""
    rows = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches):
        own = codec(model)
        for batch in batches:
            texts = [own.processor.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return rows.mapInArrow(run, T.StructType([T.StructField("id", rows.schema["id"].dataType)]).add("text", "string")).withColumnRenamed("id", id_col)


def piece_digest(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encoding, spans and decoding of each row in one pass, as digests, and the ids themselves if asked for.

    ``span_bytes`` is the number of source bytes the spans cover; every byte of the text is covered once by a model
    that neither drops nor rewrites characters.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        own = codec(model)
        for keys, texts in _chunks(batches):
            sizes, hashes, back, covered = [], [], [], []
            pieces = own.encode(texts)
            for text, ids in zip(texts, pieces, strict=True):
                starts, ends = own.spans(text, ids)
                sizes.append(len(ids))
                hashes.append(hashlib.sha256(",".join([own.decimal[i] for i in ids]).encode()).hexdigest())
                back.append(hashlib.sha256(own.processor.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
                covered.append(int((ends - starts).sum()))
            columns = [keys, pa.array(sizes, pa.int64()), pa.array(hashes), pa.array(back), pa.array(covered, pa.int64())]
            if with_ids:
                columns.append(pa.array(pieces, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)])
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string").add("span_bytes", "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
