"""Secret scans that look through encodings.

Method: recursive decoding worklist. Each layer (first the text itself) is scanned, then what is
encoded in it is unwrapped into new layers: percent escapes and backslash escapes of the whole layer,
base64 runs (over line ends, and from each of four characters, so that what stands before the data does not
shift them), and compressed data in what base64 holds, with all their members; what is too large for memory is
read in overlapping windows. Each new layer is scanned and unwrapped again,
until nothing new appears; a layer that was seen before at the same place is not followed again, which
also ends data that unpack to themselves. Findings are mapped back to code points of the text: through
escapes character by character, through base64 to the run that holds them.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, chain
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm._shared import small_batches

KINDS = ("assign", "access", "hex")
#: Fixed patterns: kind, expression, the group whose length counts, and its least length.
_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_LEAST, _ACCESS_LEAST = 6, 20
#: Every assignment has a separator after one of these letters.
_MAYBE = re.compile(r"[dtny][\"']?\x20*[:=]", re.IGNORECASE | re.ASCII)
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
#: A base64 run of 16 characters, or a shorter one at a line end; runs that are the start of the next lines belong to it.
_B = "A-Za-z0-9+/_-"
_BREAK = r"[ \t]*+\r?\n[ \t]*+"
_BASE64 = re.compile(
    rf"(?<![{_B}])(?:[{_B}]{{16,}}+|(?=[{_B}]++{_BREAK}[{_B}])[{_B}]++)(?:{_BREAK}[{_B}]++)*+={{0,2}}"
)
_CHARACTERS = re.compile(rf"[{_B}]+")
_GOES_ON = re.compile(rf"[{_B}]*+(?:{_BREAK}[{_B}]++)*+")
_STANDARD = str.maketrans("-_", "+/")
_BEHIND = re.compile(r"(?<=[+/])[A-Za-z0-9]")
#: First characters of zlib data.
_ZLIB_HERE = re.compile(r"[CGKOSWae][A-P]")
_ZLIB = re.compile(r"(?<![A-Za-z0-9])[CGKOSWae][A-P]")
#: Bytes that one compressed layer may unpack to in memory; a larger one is read in windows.
LAYER_BYTES = 64 << 20
#: Bytes unpacked at a time, and characters of a window of a large layer and of what it shares with the next.
PIECE, WINDOW, OVERLAP = 1 << 20, 8 << 20, 1 << 20


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping within a kind, sorted."""
    out = []
    if _MAYBE.search(text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= _ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= _ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _replaced(text: str, expression: re.Pattern, decode) -> tuple[str, list[int], list[int]] | None:
    """The text with all matches decoded, and for each new character where it began and ended before."""
    parts, begin, end, at = [], [], [], 0
    for m in expression.finditer(text):
        new = decode(m)
        if new is None:
            continue
        parts.append(text[at : m.start()])
        begin += range(at, m.start())
        end += range(at + 1, m.start() + 1)
        parts.append(new)
        begin += [m.start()] * len(new)
        end += [m.end()] * len(new)
        at = m.end()
    if not parts:
        return None
    parts.append(text[at:])
    return "".join(parts), begin + list(range(at, len(text))), end + list(range(at + 1, len(text) + 1))


def _percent(m: re.Match) -> str:
    data = unquote_to_bytes(m[0])
    try:
        return data.decode()
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _escape(m: re.Match) -> str | None:
    value = int(m[5]) if m[5] else int(next(x for x in m.groups()[:4] if x), 16)
    return None if value > 0x10FFFF or 0xD800 <= value < 0xE000 else chr(value)


def _packed(data: bytes) -> bool:
    """Whether data begin as gzip or zlib data do."""
    if len(data) < 3:
        return False
    return data[:3] == b"\x1f\x8b\x08" or (data[0] & 143 == 8 and int.from_bytes(data[:2], "big") % 31 == 0)


class _Unpacked:
    """What gzip or zlib data hold, all members of them, in pieces of at most PIECE bytes.

    After the last piece, ``state`` is "end" where the data end with a member, "cut" where they end within
    one, "broken" where they are damaged; ``used`` counts the bytes of the members.
    """

    def __init__(self, chunks: Iterable[bytes]) -> None:
        self.chunks, self.state, self.used = chunks, "broken", 0

    def __iter__(self) -> Iterator[bytes]:
        engine, data, members = None, b"", 0
        for chunk in self.chunks:
            data += chunk
            self.used += len(chunk)
            while True:
                if engine is None:
                    data = data.lstrip(b"\0") if members else data  # padding between members
                    if len(data) < 3:
                        break
                    if not _packed(data):
                        self.state, self.used = "end" if members else "broken", self.used - len(data)
                        return
                    engine = zlib.decompressobj(31 if data[0] == 31 else 15)
                try:
                    out = engine.decompress(data, PIECE)
                except zlib.error:
                    return
                if out:
                    yield out
                data = engine.unconsumed_tail
                if engine.eof:
                    engine, data, members = None, engine.unused_data, members + 1
                elif not data and len(out) < PIECE:
                    break
        self.state, self.used = "cut" if engine else "end" if members else "broken", self.used - len(data)


def _decoded(plain: str, at: int = 0) -> bytes:
    plain = plain[at:]
    plain = plain[: len(plain) - (len(plain) % 4 == 1)]
    return base64.b64decode(plain + "=" * (-len(plain) % 4))


def _chunks(plain: str, at: int) -> Iterator[bytes]:
    """The base64 data that begin at a character, a small part first, as most do not go on."""
    step = 256
    while at < len(plain):
        yield _decoded(plain[at : at + step])
        at, step = at + step, 1 << 16


class _Run:
    """A base64 run of one or more lines: its characters, where each line begins in them and in the layer."""

    def __init__(self, m: re.Match) -> None:
        lines = list(_CHARACTERS.finditer(m[0]))
        self.plain = "".join(x[0] for x in lines).translate(_STANDARD)
        self.first = list(accumulate((len(x[0]) for x in lines[:-1]), initial=0))
        self.begin = [m.start() + x.start() for x in lines]
        self.end = [m.start() + x.end() for x in lines[:-1]] + [m.end()]

    def span(self, a: int, b: int, shift: int) -> tuple[int, int]:
        """Where characters a to b stand, from the first part of their line that is decoded alike (``shift``, mod 4)."""
        line, last = (bisect_right(self.first, x) - 1 for x in (a, max(a, b - 1)))
        low = begin = self.first[line]
        if (low - shift) % 4:
            parts = (m.start() for m in _BEHIND.finditer(self.plain, low, a + 1))
            begin = next((x for x in parts if (x - shift) % 4 == 0), low)
        return self.begin[line] + begin - low, self.end[last]

    def at(self, a: int) -> int:
        """Where a character stands."""
        line = bisect_right(self.first, a) - 1
        return self.begin[line] + a - self.first[line]

    def starts(self) -> list[int]:
        """Where compressed data may begin: gzip's first bytes anywhere, zlib's at a line or behind a separator."""
        out = {m.start() for m in re.finditer("H4sI", self.plain)} | {m.start() for m in _ZLIB.finditer(self.plain)}
        out |= {x for x in self.first if _ZLIB_HERE.match(self.plain, x)}
        return sorted(x for x in out if _packed(_decoded(self.plain[x : x + 4])))


Source = Callable[[], Iterable[bytes]]


def _contents(source: Source, limit: int) -> Iterator[bytes | Source]:
    """What a source holds and, where that is packed, what it unpacks to, layer below layer.

    Data of at most ``limit`` bytes come whole, others as a source to read again.
    """
    seen = set()
    while True:
        parts, total = [], 0
        for piece in source():
            parts.append(piece)
            total += len(piece)
            if total > limit:
                break
        data = b"".join(parts)
        if not data or data in seen:
            return
        if total > limit:
            yield source
            below = source
        else:
            seen.add(data)
            yield data
            below = lambda data=data: [data]
        if not _packed(data):
            return
        source = lambda below=below: _Unpacked(below())


class _Scan:
    """The worklist of one text, or of one window of a large layer; ``open``: more windows follow."""

    def __init__(self, limit: int | None, open: bool | None = None) -> None:
        self.limit, self.open = limit, open
        self.found, self.seen, self.layers = set(), set(), 0
        self.unread: set[tuple[int, int]] = set()
        self.n_unread = 0
        #: Where in the window compressed data begin that go on behind it.
        self.going_on: list[int] = []

    def text(self, text: str) -> None:
        self.seen.add((text, 0, len(text)))
        # A layer, the place of a part of it (one place where all parts have the same), and whether it is cut off.
        self.work = [(text, (0, len(text)) if self.open is not None else lambda a, b: (a, b), bool(self.open))]
        top = True
        while self.work:
            layer, spot, cut = self.work.pop()
            for expression, decode in ((_PERCENT, _percent), (_ESCAPE, _escape)):
                if isinstance(spot, tuple):
                    new = expression.sub(lambda m, decode=decode: m[0] if (x := decode(m)) is None else x, layer)
                    if new != layer:
                        self._below(new, spot, cut, True)
                elif new := _replaced(layer, expression, decode):
                    self._below(new[0], lambda a, b, new=new, spot=spot: spot(new[1][a], new[2][b - 1]), cut, True)
            for m in _BASE64.finditer(layer):
                if m.end() - m.start() >= 16:
                    self._run(_Run(m), spot, cut and m.end() == len(layer), top)
            top = False

    def _below(self, inner: str, where, cut: bool, counts: bool) -> None:
        if not inner:
            return
        spans = base_spans(inner)
        deeper = "%" in inner or "\\" in inner or "&#" in inner or _BASE64.search(inner)
        if not (spans or deeper or counts):
            return
        key = (inner, *_place(where, 0, len(inner)))
        if key in self.seen:
            return
        self.seen.add(key)
        self.layers += bool(counts or spans)
        self.found |= {(p[0], kind, p[1]) for a, kind, b in spans for p in [_place(where, a, b)]}
        if deeper:
            self.work.append((inner, where, cut))

    def _run(self, run: _Run, spot, cut: bool, top: bool) -> None:
        plain, past = run.plain, 0
        if len(plain) < 16:
            return
        for shift in range(4):
            data = _decoded(plain, shift)

            def where(a: int, b: int, shift=shift):
                return spot(*run.span(shift + a * 4 // 3, min(len(plain), shift - (-b * 4 // 3)), shift))

            if isinstance(spot, tuple):
                where = spot

            # All patterns are ASCII, so one character for each byte finds the same as the right decoding.
            self._below(data.decode("latin-1"), where, cut, shift == 0 and _is_text(data))
        for at in run.starts():
            if at < past:
                continue
            whole = _Unpacked(_chunks(plain, at))
            some = False
            for _ in whole:
                some = True
            if not some:
                continue
            if cut and whole.state == "cut":
                if top:
                    self.going_on.append(run.at(at))
                else:
                    self._left(_place(spot, *run.span(at, len(plain), at)))
                past = len(plain)
                continue
            stop = len(plain) if whole.state != "end" else min(len(plain), at - (-whole.used * 4 // 3))
            if whole.state != "broken":
                past = stop
            place = _place(spot, *run.span(at, stop, at))
            self.packed(lambda at=at: _Unpacked(_chunks(plain, at)), place, whole.state != "broken")

    def _left(self, place: tuple[int, int]) -> None:
        self.n_unread += 1
        self.unread.add(place)

    def packed(self, source: Source, place: tuple[int, int], counts: bool = True) -> None:
        for data in _contents(source, LAYER_BYTES if self.limit is None else self.limit):
            if isinstance(data, bytes):
                self._below(data.decode("latin-1"), place, False, counts and _is_text(data))
            elif self.limit is not None:
                self._left(place)
                return
            else:
                self.stream(data, place)

    def stream(self, source: Source, place: tuple[int, int]) -> None:
        """Scans a large layer window by window; each begins with the end of the one before."""
        self.layers += 1
        before, total, pieces = "", 0, chain(source(), [None])
        window: list[str] = []
        for piece in pieces:
            if piece is not None:
                window.append(piece.decode("latin-1"))
                total += len(piece)
                if sum(map(len, window)) < WINDOW:
                    continue
            text = before + "".join(window)
            window = []
            part = _Scan(None, piece is not None)
            part.found |= set(base_spans(text))
            part.text(text)
            self.found |= {(place[0], kind, place[1]) for _, kind, _ in part.found}
            self.layers += part.layers
            if part.n_unread:
                self._left(place)
            for at in part.going_on:
                if at >= len(text) - OVERLAP:
                    continue  # the next window has it
                at += total - len(text)
                self.packed(lambda at=at: _Unpacked(_run_from(source(), at)), place)
            before = text[-OVERLAP:]
            if before[:1] == " ":  # a word and the separator that belongs to it may lie far apart
                before = text[:-OVERLAP].rstrip(" ")[-16:] + before


def _place(where, a: int, b: int) -> tuple[int, int]:
    return where if isinstance(where, tuple) else where(a, b)


def _is_text(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


def _run_from(pieces: Iterable[bytes], at: int) -> Iterator[bytes]:
    """The base64 data that begin at a byte of a large layer, as far as their run goes."""
    rest, edge = "", ""
    for piece in pieces:
        if at >= len(piece):
            at -= len(piece)
            continue
        text, at = edge + piece[at:].decode("latin-1"), 0
        m = _GOES_ON.match(text)
        edge = text[m.end() :]
        ends = edge.strip(" \t\r\n") != "" or len(edge) > PIECE
        rest += "".join(_CHARACTERS.findall(m[0])).translate(_STANDARD)
        size = len(rest) if ends else len(rest) // 4 * 4
        yield _decoded(rest[:size])
        rest = rest[size:]
        if ends:
            return
    if rest:
        yield _decoded(rest)


def _scanned(text: str, limit: int | None) -> tuple[list[tuple[int, int, int]], _Scan | None]:
    base = base_spans(text)
    # Most texts hold nothing encoded.
    if "%" not in text and "\\" not in text and "&#" not in text and not _BASE64.search(text):
        return base, None
    scan = _Scan(limit)
    scan.found |= set(base)
    scan.text(text)
    return base, scan


def scan_text(
    text: str, limit: int | None = None
) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, int]:
    """Base spans, all spans, number of layers below the text, and layers left unread for their size."""
    base, scan = _scanned(text, limit)
    return (base, sorted(scan.found), scan.layers, scan.n_unread) if scan else (base, base, 0, 0)


def secret_spans(docs: DataFrame, limit: int | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, base and spans (arrays of kind, start, end), n_layers, n_unread.

    ``docs`` needs doc_id and text; other columns are ignored. ``base`` holds what stands openly in the
    text, ``spans`` also what encodings hide, at the place that hides it; both sorted by start, then kind
    (assign, access, hex), then end; code points, end exclusive. n_layers counts the decoded layers,
    n_unread the compressed ones that were not scanned to their end: with a ``limit``, those that unpack to more
    bytes; without one, those whose base64 is encoded once more and crosses a window (PIECE, WINDOW, OVERLAP) of
    a layer beyond LAYER_BYTES by more than the overlap. Null and empty texts have no spans; null ids and repeated rows keep their rows; an empty table gives an empty
    result.
    """
    kind = "array<struct<kind:string,start:long,end:long>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def listed(spans: list[tuple[int, int, int]]) -> list[dict]:
        return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [scan_text(x or "", limit) for x in batch["text"].to_pylist()]
            columns = [pa.array([listed(x[k]) for x in out], arrow) for k in (0, 1)]
            columns += [pa.array([x[k] for x in out], pa.int64()) for k in (2, 3)]
            yield pa.record_batch([batch["doc_id"], *columns], ["doc_id", "base", "spans", "n_layers", "n_unread"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, f"doc_id long, base {kind}, spans {kind}, n_layers long, n_unread long"
    )


def redacted(docs: DataFrame, mark: str = "[secret]", limit: int | None = None) -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark``; overlapping spans are one. Other columns stay.

    A run with a layer that was not scanned to its end is replaced whole.
    """
    small_batches(docs.sparkSession)
    names = docs.columns
    at = names.index("text")

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        base, scan = _scanned(text, limit)
        spans = sorted({(a, b) for a, _, b in (scan.found if scan else base)} | (scan.unread if scan else set()))
        parts, end = [], 0
        for a, b in spans:
            if a >= end:
                parts += [text[end:a], mark]
            end = max(end, b)
        return "".join(parts) + text[end:] if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array(map(clean, batch["text"].to_pylist()), pa.string())
            yield pa.record_batch([*batch.columns[:at], text, *batch.columns[at + 1 :]], names)

    return docs.mapInArrow(run, docs.schema)
