"""Byte-level BPE encoding and decoding as a monoid over trees.

Method: a text is encoded by halves, recursively; neighbours are joined by encoding anew a window
around their border, which grows until the tokens outside provably stay. Decoding concatenates the
bytes up the same kind of tree.

Two trees lie inside each other. *Texts*: where white space follows another character, a match of the
pattern always ends, whatever stands around; tokens before the last such place of the left side and
after the first one of the right side stay as they are. *Long matches*: a sequence of tokens is the
encoding of its bytes if and only if each two neighbours are the encoding of their joined bytes; a window
that fits its two neighbours so is final.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

from weektide.llm._shared import small_batches

#: Characters in a leaf of a text, bytes in a leaf of a long match.
LEAF, PIECE_LEAF = 2048, 128
#: White space as Unicode has it, which is the pattern's \s.
SPACE = "\t-\r \x85\xa0  -     　"
_END = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")


class Codec:
    """Encodes and decodes by ranks; ``pattern`` must end each match where white space follows another character."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self._plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._matches = regex.compile(pattern)
        self._whole = self._plain._encode_single_piece
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for data, rank in ranks.items():
            self.bytes[rank] = data
        self._sizes = [len(x) for x in self.bytes]

    def encode(self, text: str) -> list[int]:
        if len(text) <= LEAF:
            return self._plain.encode_ordinary(text)
        middle = len(text) // 2
        left, right = self.encode(text[:middle]), self.encode(text[middle:])
        low, high = self._before(text, middle), self._after(text, middle)
        drop, skip = self._count(reversed(left), text[low:middle]), self._count(right, text[middle:high])
        return left[: len(left) - drop] + self._window(text[low:high]) + right[skip:]

    def _before(self, text: str, middle: int) -> int:
        width = 32
        while width < 2 * middle:
            found = [m.start() for m in _END.finditer(text, max(0, middle - width), middle)]
            if found and found[-1]:
                return found[-1]
            width *= 2
        return 0

    def _after(self, text: str, middle: int) -> int:
        width = 32
        while width < 2 * (len(text) - middle):
            found = _END.search(text, middle + 1, min(len(text), middle + width))
            if found:
                return found.start()
            width *= 2
        return len(text)

    def _count(self, tokens, text: str) -> int:
        """How many tokens from the border on hold the bytes of ``text``."""
        left, n = len(text.encode()), 0
        for t in tokens:
            if left <= 0:
                break
            left -= self._sizes[t]
            n += 1
        return n

    def _window(self, text: str) -> list[int]:
        if len(text) <= LEAF:
            return self._plain.encode_ordinary(text)
        out: list[int] = []
        for match in self._matches.finditer(text):
            out += self.encode_match(match[0].encode())
        return out

    def encode_match(self, piece: bytes) -> list[int]:
        """One match of the pattern."""
        if len(piece) <= PIECE_LEAF:
            return self._whole(piece)
        middle = len(piece) // 2
        left, right = self.encode_match(piece[:middle]), self.encode_match(piece[middle:])
        width = 4
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self._whole(self.decode(left[a:] + right[:b]))
            if (not a or self._fit(left[a - 1], window[0])) and (b == len(right) or self._fit(window[-1], right[b])):
                return left[:a] + window + right[b:]
            width *= 2

    def _fit(self, a: int, b: int) -> bool:
        return self._whole(self.bytes[a] + self.bytes[b]) == [a, b]

    def decode(self, tokens: list[int]) -> bytes:
        if len(tokens) <= LEAF:
            return b"".join(map(self.bytes.__getitem__, tokens))
        middle = len(tokens) // 2
        return self.decode(tokens[:middle]) + self.decode(tokens[middle:])


@lru_cache(maxsize=2)
def _codec(file: bytes, pattern: str) -> Codec:
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file.splitlines() if line)}
    return Codec(ranks, pattern)


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _with(df: DataFrame, source: str, target: str, kind: pa.DataType, value, spark_kind: DataType) -> DataFrame:
    """``df`` with ``target`` = ``value``() of ``source``, a few hundred rows at a time; an older ``target`` goes."""
    small_batches(df.sparkSession)
    df = df.drop(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = value()
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                new = pa.array([convert(x) for x in part[source].to_pylist()], kind)
                yield pa.record_batch([*part.columns, new], [*part.schema.names, target])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(target, spark_kind)]))


def encode_texts(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``docs`` with tokens (array of int), the encoding of its column text; other columns stay.

    ``ranks``: path of a ``.tiktoken`` file on the driver; its bytes (under a megabyte for 50,000 tokens)
    go with the tasks. Each match of ``pattern`` is encoded by itself, without special tokens. Null and
    empty texts have no tokens; null ids and repeated rows keep their rows; an older column tokens is
    replaced; an empty table gives an empty result. Texts are encoded whole.
    """
    file = _read(ranks)

    def value():
        codec = _codec(file, pattern)
        return lambda text: codec.encode(text) if text else []

    return _with(docs, "text", "tokens", pa.list_(pa.int32()), value, ArrayType(IntegerType()))


def decode_tokens(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``encoded`` with decoded (binary), the bytes that its column tokens stands for; other columns stay.

    No tokens, or null, decode to no bytes. A token that is not in the file fails the query.
    """
    file = _read(ranks)

    def value():
        codec = _codec(file, pattern)
        return lambda tokens: codec.decode(tokens or [])

    return _with(encoded, "tokens", "decoded", pa.binary(), value, BinaryType())
