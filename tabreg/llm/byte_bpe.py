"""Byte-level BPE encoding and decoding through a sentencepiece model written from a rank file.

The vocabulary of a ``.tiktoken`` file (base64 bytes and their rank) becomes a sentencepiece
BPE model, serialised field by field: every byte is mapped to one character, a piece's score
is its negative rank and the normaliser is the identity. sentencepiece then joins the
neighbours of the best score, leftmost first, which is the merge of the lowest rank. A text
is cut by the pre-token pattern and every match is encoded on its own; a match that is a
vocabulary entry as a whole is that id. Decoding looks the bytes of every id up.

The pattern runs in the ``regex`` library, whose letters and numbers follow another Unicode
version than those of the ``tiktoken`` library. The characters that the two class otherwise
are found once on the driver by asking both for every code point, and are matched through a
stand-in character of the right class.
"""

from __future__ import annotations

import base64
import struct
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from tabreg.llm.base import text_or_empty
from tabreg.llm.tokens import Memo

# Fixed values of sentencepiece's model file (protocol buffer fields and enumerations).
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
MODEL_TYPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 4, 40, 41, 42, 43
BPE = 2
NAME, ADD_DUMMY_PREFIX, REMOVE_EXTRA_WHITESPACES, ESCAPE_WHITESPACES = 1, 3, 4, 5

FIRST_MARK = 0x100                                # byte b is the character FIRST_MARK + b
BYTES_OF_MARKS = {FIRST_MARK + b: b for b in range(256)}
MARKS = [chr(FIRST_MARK + b) for b in range(256)]
#: A character of each class that occurs in no literal of a pattern: letter, number, neither.
STAND_INS = {"L": "ª", "N": "²", "": ""}
BATCH_BYTES = 4 << 20


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file in id order; ids must be 0, 1, 2, ... without a gap and
    hold every single byte."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path}: ranks are not gapless from 0, or a byte has none")
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _int(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def marked(token: bytes) -> str:
    """One character per byte."""
    return "".join(map(MARKS.__getitem__, token))


def model_file(tokens: list[bytes]) -> bytes:
    """The vocabulary as a sentencepiece BPE model: ids stay, one more id is the unknown piece
    that the format asks for (a mapped text never meets it)."""
    if len(tokens) >= 1 << 24:
        raise ValueError("scores are 32-bit floats: ranks from 2^24 on would not be exact")
    out = bytearray()
    for rank, token in enumerate(tokens):
        out += _bytes(PIECES, _bytes(PIECE_TEXT, marked(token).encode()) + _float(PIECE_SCORE, -float(rank))
                      + _int(PIECE_TYPE, NORMAL))
    out += _bytes(PIECES, _bytes(PIECE_TEXT, b"<unk>") + _float(PIECE_SCORE, 0.0) + _int(PIECE_TYPE, UNKNOWN))
    out += _bytes(TRAINER, _int(MODEL_TYPE, BPE) + _int(VOCAB_SIZE, len(tokens) + 1) + _int(UNK_ID, len(tokens))
                  + _int(BOS_ID, -1) + _int(EOS_ID, -1) + _int(PAD_ID, -1))
    out += _bytes(NORMALIZER, _bytes(NAME, b"identity") + _int(ADD_DUMMY_PREFIX, 0)
                  + _int(REMOVE_EXTRA_WHITESPACES, 0) + _int(ESCAPE_WHITESPACES, 0))
    return bytes(out)


def other_classes() -> dict[int, str]:
    """Stand-ins of the code points that ``tiktoken`` and ``regex`` put in different classes
    (letter, number, space or neither)."""
    import regex
    import tiktoken

    every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    single = {bytes([b]): b for b in range(256)}
    theirs, ours = {}, {}
    for name in ("L", "N"):
        rule = rf"\p{{{name}}}"
        enc = tiktoken.Encoding(f"class {name}", pat_str=rule, mergeable_ranks=single, special_tokens={})
        for lo in range(0, len(every), 4096):               # only matches give ids, here their bytes
            block = "".join(every[lo:lo + 4096])
            theirs.update(dict.fromkeys(bytes(enc.encode_ordinary(block)).decode(), name))
            ours.update(dict.fromkeys(regex.findall(rule, block), name))
    return {ord(c): STAND_INS[theirs.get(c, "")] for c in theirs.keys() | ours.keys() if theirs.get(c) != ours.get(c)}


class ByteBpe:
    """``encode(text)``: ids of a whole text as little-endian unsigned 32-bit integers;
    ``decode(ids)``: their bytes."""

    def __init__(self, path: str, pattern: str, classes: dict[int, str], memo: int = 400_000):
        import regex
        import sentencepiece

        self.tokens = read_ranks(path)
        self.ids = {marked(t): i for i, t in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_file(self.tokens))
        self.pattern = regex.compile(pattern)
        self.classes = classes
        self.odd = frozenset(map(chr, classes))
        self.memo = Memo(self._match, memo)

    def _match(self, match: str) -> bytes:
        mapped = marked(match.encode())
        whole = self.ids.get(mapped)
        return array("I", [whole] if whole is not None else self.model.encode(mapped, out_type=int)).tobytes()

    def encode(self, text: str) -> bytes:
        if text.isascii() or self.odd.isdisjoint(set(text)):
            return b"".join(map(self.memo.__getitem__, self.pattern.findall(text)))
        stand_in = text.translate(self.classes)             # one character for one: places stay
        return b"".join([self.memo[text[slice(*m.span())]] for m in self.pattern.finditer(stand_in)])

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.tokens):
            raise ValueError(f"an id outside the vocabulary of {len(self.tokens)} entries")
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_CODECS: dict[tuple, ByteBpe] = {}


def _codec(path: str, pattern: str, classes: dict[int, str]) -> ByteBpe:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBpe(path, pattern, classes)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens long, ids array<int>`` of every whole text, one row per input row.

    A null or empty text has no ids; null and repeated ids and repeated rows stay as they are;
    other columns are ignored whatever their names; an empty table gives no rows. A very long
    text costs its length times the logarithm of its longest match. No shuffle; output batches
    are cut at 4 MB of text."""
    classes = other_classes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern, classes)

        def out(ids, parts):
            flat = np.frombuffer(b"".join(parts), "<u4").astype(np.int32)
            ends = np.cumsum([0] + [len(p) // 4 for p in parts])
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.diff(ends), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=[id_col, "n_tokens", "ids"])

        for batch in batches:
            ids, parts, size = [], [], 0
            for id_, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                ids.append(id_.as_py())
                parts.append(codec.encode(text))
                size += len(text)
                if size >= BATCH_BYTES:
                    yield out(ids, parts)
                    ids, parts, size = [], [], 0
            if ids:
                yield out(ids, parts)

    rows = docs.select(docs[id_col].cast("long").alias(id_col), text_or_empty(docs[text_col]).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` long, n_tokens long, ids array<int>")


def decode(rows: DataFrame, path: str, pattern: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and ``into``: the bytes of the ids, which are the text in UTF-8
    for whole encodings. Null ids give null, no ids no bytes; an id outside the vocabulary is
    an error; repeated rows stay; a column that is already named ``into`` is an error."""
    if into in rows.columns:
        raise ValueError(f"column {into} exists")
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern, {})                   # classes matter only for encoding
        for batch in batches:
            column = batch.column(at)
            ends, flat, held = column.offsets.to_numpy(), column.values.to_numpy(), column.is_valid().to_pylist()
            texts = [codec.decode(flat[lo:hi]) if ok else None for lo, hi, ok in zip(ends[:-1], ends[1:], held)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, into])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(into, BinaryType())]))
