"""SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

Method: a slice of texts is one flat array of symbols, cut into words. In each round every word finds its
best pair (segmented minimum of the pair ranks), merges all places of it from the left at once, and the
array is compacted, until no word has a pair left.

*Words.* No piece can lie over two characters that never stand side by side inside a piece, so a text is
cut between all such characters; that holds for every vocabulary. Equal words of a slice are encoded once.

*Places merged at once.* One by one, the best pair is taken anew after each merge. A merge makes two new
pairs; while these rank behind the pair at hand, the next place of it comes next. Where one of them does
not, the places after it wait for the next round. The result is the same as one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from weektide.llm._shared import small_batches
from weektide.llm._words import SLICE_BYTES, Words, slices

#: Fixed value: the character that stands for a blank inside pieces.
BLANK = 0x2581
#: The rank of no pair.
NONE = np.iinfo(np.int32).max


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


class Pieces:
    """Tables of a model: characters, pairs that merge, ids and bytes of pieces.

    Symbols are numbered by piece id; characters that stand in pieces only follow, and last the symbol of
    all other characters. The model must be of the BPE kind with an identity normaliser and a leading blank.
    """

    def __init__(self, model: bytes) -> None:
        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = lib.vocab_size()
        names = [lib.id_to_piece(k) for k in range(size)]
        special = [lib.is_unknown(k) or lib.is_control(k) or lib.is_byte(k) for k in range(size)]
        if any(lib.is_unused(k) for k in range(size)) or lib.normalize(" ａ  b ") != "▁▁ａ▁▁b▁":
            raise ValueError("a model without unused pieces, with an identity normaliser and a leading blank is needed")
        self.unknown, self.control = lib.unk_id(), np.array([lib.is_control(k) for k in range(size)])
        code = {names[k]: k for k in range(size) if not special[k]}
        pieces = list(code)
        for c in sorted({c for p in pieces for c in p} - code.keys()):
            code[c] = size + len(code) - len(pieces)
        self.symbols = size + len(code) - len(pieces) + 1
        self.size = size

        self.char = np.full(0x110000, self.symbols - 1, np.int32)
        letters = {c: k for c, k in code.items() if len(c) == 1}
        self.char[[ord(c) for c in letters]] = list(letters.values())
        # Characters side by side inside pieces, in a table over their own short numbers.
        self.short = np.zeros(0x110000, np.int32)
        self.short[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.inside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        pairs = np.array([[ord(a), ord(b)] for p in pieces for a, b in zip(p[:-1], p[1:], strict=True)]).reshape(-1, 2)
        self.inside[self.short[pairs[:, 0]], self.short[pairs[:, 1]]] = True

        scores = {p: lib.get_score(code[p]) for p in pieces}
        rank = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        joins = []
        for p in pieces:
            for k in range(1, len(p)):
                if p[:k] in code and p[k:] in code:
                    joins.append((code[p[:k]] * self.symbols + code[p[k:]], rank[scores[p]], code[p]))
        joins = np.array(sorted(joins), np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.merged = joins[:, 0].copy(), joins[:, 1].astype(np.int32), joins[:, 2].astype(np.int32)

        self.byte = np.full(256, -1, np.int32)
        for k in range(size):
            if lib.is_byte(k):
                self.byte[int(names[k][3:5], 16)] = k
        self.value = np.full(size, -1, np.int32)
        self.value[self.byte[self.byte >= 0]] = np.flatnonzero(self.byte >= 0)
        unknown = lib.decode([self.unknown])
        surface = [
            unknown if lib.is_unknown(k) else "" if lib.is_control(k) else names[k].replace("▁", " ")
            for k in range(size)
        ]
        surface = [bytes([self.value[k]]) if self.value[k] >= 0 else x.encode() for k, x in enumerate(surface)]
        self.blank = np.array([not special[k] and names[k].startswith("▁") for k in range(size)])
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.length = np.array([len(x) for x in surface], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the pairs (NONE: they do not merge) and the piece that they make."""
        key = a.astype(np.int64) * self.symbols + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], NONE), np.where(found, self.merged[at], -1)

    def merge(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their words (ascending) -> the same after all merges."""
        done = []
        while len(symbol):
            rank = np.full(len(symbol), NONE, np.int32)
            piece = np.full(len(symbol), -1, np.int32)
            near = np.flatnonzero(word[:-1] == word[1:])
            rank[near], piece[near] = self.pair(symbol[near], symbol[near + 1])
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            count = np.diff(np.append(first, len(word)))
            best = np.repeat(np.minimum.reduceat(rank, first), count)
            over = best == NONE  # words without a pair leave the rounds
            done.append((symbol[over], word[over]))
            at = np.flatnonzero((rank == best) & ~over)
            if not len(at):
                break
            # Of places that overlap, every other one from the left.
            run = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1))
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
            at = at[self._allowed(symbol, word, piece, at, best[at])]
            symbol[at] = piece[at]
            keep = ~over
            keep[at + 1] = False
            symbol, word = symbol[keep], word[keep]
        symbols = np.concatenate([x[0] for x in done]) if done else symbol
        words = np.concatenate([x[1] for x in done]) if done else word
        order = np.argsort(words, kind="stable")
        return symbols[order], words[order]

    def _allowed(self, symbol, word, piece, at, best) -> np.ndarray:
        """Which of the places ``at``, merged from the left in each word, come before any pair that arises."""
        made, new = piece[at], np.full(len(at), NONE, np.int32)
        left = np.flatnonzero((at > 0) & (word[at - 1] == word[at]))
        before = symbol[at[left] - 1]
        touch = (left > 0) & (at[left - 1] == at[left] - 2)
        before[touch] = made[left[touch] - 1]
        new[left] = self.pair(before, made[left])[0]
        right = np.flatnonzero(at + 2 < len(word))
        right = right[word[at[right] + 2] == word[at[right]]]
        new[right] = np.minimum(new[right], self.pair(made[right], symbol[at[right] + 2])[0])
        stop = np.cumsum(new <= best)
        stop -= new <= best  # a place itself is merged; those behind it wait
        first = np.flatnonzero(np.append(True, word[at[1:]] != word[at[:-1]]))
        return stop == np.repeat(stop[first], np.diff(np.append(first, len(at))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text begins and ends among them."""
        normal = [f"▁{t.replace(' ', '▁')}" if t else "" for t in texts]
        offsets = np.cumsum([0, *map(len, normal)])
        chars = np.frombuffer("".join(normal).encode("utf-32-le", "surrogatepass"), np.int32)
        if not len(chars):
            return np.zeros(0, np.int32), offsets
        short = self.short[chars]
        begins = np.ones(len(chars), bool)
        begins[1:] = ~self.inside[short[:-1], short[1:]]
        begins[offsets[:-1][offsets[:-1] < len(chars)]] = True
        start = np.flatnonzero(begins)
        size = np.diff(np.append(start, len(chars)))
        # Equal words once: by hash, then character by character.
        raw = Words(chars.view(np.uint8), offsets, 4 * start, 4 * (start + size), start)
        _, lead, which = np.unique(raw.hashes(), return_index=True, return_inverse=True)
        same = size[lead][which] == size
        at = _ragged(start[same], size[same])
        equal = chars[at] == chars[_ragged(start[lead][which][same], size[same])]
        same[same] = np.logical_and.reduceat(equal, np.cumsum(size[same]) - size[same]) if len(at) else False
        odd = np.flatnonzero(~same)  # other words with the same hash stand for themselves
        which[odd] = len(lead) + np.arange(len(odd))
        lead = np.concatenate([lead, odd])
        from_, many = start[lead], size[lead]
        places = _ragged(from_, many)
        symbol, word = self.merge(self.char[chars[places]], np.repeat(np.arange(len(lead)), many))
        symbol, word = self._bytes(symbol, word, chars[from_])
        held = np.bincount(word, minlength=len(lead))
        begin = np.cumsum(held) - held
        ids = symbol[_ragged(begin[which], held[which])]
        ends = np.concatenate([[0], np.cumsum(held[which])])
        return ids, ends[np.searchsorted(start, offsets)]

    def _bytes(self, symbol: np.ndarray, word: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no pieces become their bytes, or the unknown id. They are words of their own,
        unless they stand in longer pieces."""
        lost = np.flatnonzero(symbol >= self.size)
        if not len(lost):
            return symbol, word
        inner = {int(k): c for c, k in enumerate(self.char) if self.size <= k < self.symbols - 1} if (
            symbol[lost] < self.symbols - 1
        ).any() else {}
        value, many = [], np.ones(len(symbol), np.int64)
        for k in lost.tolist():
            c = inner.get(int(symbol[k]), int(head[word[k]]))
            ids = self.byte[list(chr(c).encode("utf-8", "surrogatepass"))]
            ids = ids.tolist() if (ids >= 0).all() else [self.unknown]
            many[k] = len(ids)
            value += ids
        out = np.repeat(symbol, many)
        out[np.repeat(symbol >= self.size, many)] = value
        return out, np.repeat(word, many)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of the ids between neighbouring offsets."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id that is not in the model")
        size = self.length[ids].copy()
        # The first blank of a text goes: that of the first piece, whatever holds no text before it aside.
        rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        told = np.flatnonzero(~self.control[ids])
        lead = told[np.append(True, rows[told][1:] != rows[told][:-1])] if len(told) else told
        lead = lead[self.blank[ids[lead]]]
        begin = self.start[ids].copy()
        begin[lead] += 1
        size[lead] -= 1
        data = self.surface[_ragged(begin, size)]
        ends = np.concatenate([[0], np.cumsum(size)])[offsets]
        raw = data.tobytes()
        bad = set()
        if (self.value[ids] >= 0x80).any():  # bytes of a broken character stand for themselves
            try:
                raw.decode()
            except UnicodeDecodeError:
                bad = {k for k in range(len(ends) - 1) if not _valid(raw[ends[k] : ends[k + 1]])}
        return [
            self._broken(ids[offsets[k] : offsets[k + 1]]) if k in bad else raw[ends[k] : ends[k + 1]].decode()
            for k in range(len(ends) - 1)
        ]

    def _broken(self, ids: np.ndarray) -> str:
        """A text with bytes that are no UTF-8: each of them becomes U+FFFD."""
        out, k, fresh = [], 0, True
        while k < len(ids):
            end = k
            while end < len(ids) and self.value[ids[end]] >= 0:
                end += 1
            if end > k:
                out.append(_replaced(bytes(self.value[ids[k:end]].tolist())))
                fresh, k = False, end
                continue
            text = self.surface[self.start[ids[k]] : self.start[ids[k]] + self.length[ids[k]]].tobytes().decode()
            if fresh and self.blank[ids[k]]:
                text, fresh = text[1:], False
            fresh = fresh and not text
            out.append(text)
            k += 1
        return "".join(out)


def _valid(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


def _replaced(data: bytes) -> str:
    out, k = [], 0
    while k < len(data):
        for n in (1, 2, 3, 4):
            if _valid(data[k : k + n]) and k + n <= len(data):
                out.append(data[k : k + n].decode())
                k += n
                break
        else:
            out.append("�")
            k += 1
    return "".join(out)


@lru_cache(maxsize=2)
def _pieces(model: bytes) -> Pieces:
    return Pieces(model)


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` with pieces (array of int), the ids of its column text; other columns stay.

    ``model``: path of a ``.model`` file on the driver; its bytes (half a megabyte for 32,000 pieces) go with
    the tasks. No begin or end ids, no sampling. Null and empty texts have no ids; null document ids and
    repeated rows keep their rows; an older column pieces is replaced; an empty table gives an empty result.
    Texts are encoded whole; characters without a piece become byte ids, or the unknown id where the model
    has no bytes. A word without any place to cut costs one round for each different piece in it.
    """
    file = _read(model)
    small_batches(docs.sparkSession)
    docs = docs.drop("pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _pieces(file)
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                ids, ends = table.encode([t or "" for t in part["text"].to_pylist()])
                new = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.record_batch([*part.columns, new], [*part.schema.names, "pieces"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("pieces", ArrayType(IntegerType()))]))


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with decoded (string), the text that its column pieces stands for; other columns stay.

    The leading blank goes; control ids have no text; bytes that are no UTF-8 become U+FFFD each. No ids, or
    null, decode to an empty text. An id that is not in the model, or is null, fails the query.
    """
    file = _read(model)
    encoded = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _pieces(file)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                lists = part["pieces"].fill_null([])
                ids = lists.flatten()
                if ids.null_count:
                    raise ValueError("an id is null")
                ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
                new = pa.array(table.decode(ids.to_numpy(zero_copy_only=False), ends.astype(np.int64)), pa.string())
                yield pa.record_batch([*part.columns, new], [*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", StringType())]))
