"""Secret scan through nested encodings.

A worklist of layers starts with the text itself. Every layer is scanned for
secrets and unwrapped: URL escapes and Unicode escapes over the whole layer, and
base64 runs, also those glued to other text of the same letters (all four
alignments are read) or broken over lines. Base64 and runs of URL or ``\\x``
escapes give bytes: compressed data in them is unpacked, member after member and
as often as it is compressed, and the bytes are read as UTF-16, UTF-8 or, if
they are neither, Latin-1. New layers go on the list until there are none; a
layer with the same content and place as an earlier one is not taken again,
which ends cycles. Each character of a layer knows which characters of the
document it came from, so a secret found in any layer is reported by its place
in the document.

Kinds: ``assign`` (a password-like name, a separator and a value of at least 6
characters), ``access`` (AKIA and 16 or more capitals or digits), ``hex`` (24 or
more hexadecimal digits). Spans of the text itself (base) are leftmost and do
not overlap within a kind; spans from deeper layers are added to them.

Defined results: null text is empty and has no spans. Positions are code
points, ends exclusive. Repeated rows are each scanned. Unpacked data is worked
on as it comes, in chunks of CHUNK bytes that overlap by OVERLAP, however large
it is: one chunk is followed to its end before the next, and compressed data and
long encoded runs that cross the edge of a chunk are fed on piece by piece, so
memory grows with the depth of the layers only. Of damaged data, what comes
before the damage is read. A secret in unpacked data has the place of the whole
encoded run.
"""

from __future__ import annotations

import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from navspark.llm.arrow_text import text_bytes

KINDS = ("assign", "access", "hex")
#: A base64 run has at least so many characters: the shortest secret with its name needs 16.
SHORTEST_RUN = 16
CHUNK, OVERLAP = 4 << 20, 256 << 10
_PIECE = 1 << 20

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_URL = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+")
_URL_ONE = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})")
_UNICODE = re.compile(r"[\\%]u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORTEST_RUN)
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{4,}+(?:\r?\n[ \t]{0,8}[A-Za-z0-9+/_-]++)++={0,2}")
_LETTER64 = re.compile(r"[A-Za-z0-9+/_-]")
_GLUE = re.compile(r"[-_/+]")
_URL_BYTES = re.compile(r"(?<![A-Za-z0-9_.~/+-])[A-Za-z0-9_.~/+-]*+(?:%[0-9A-Fa-f]{2}[A-Za-z0-9_.~/+-]*+)+")
_URL_TOKEN = re.compile(r"%([0-9A-Fa-f]{2})|.", re.S)
_X_BYTES = re.compile(r"(?<![ -\[\]-~])[ -\[\]-~]*+(?:\\(?:x[0-9A-Fa-f]{2}|[nrt\\'\"0abfv])[ -\[\]-~]*+)+")
_X_TOKEN = re.compile(r"\\x([0-9A-Fa-f]{2})|\\(.)|.", re.S)
_X_SHORT = {"n": 10, "r": 13, "t": 9, "0": 0, "a": 7, "b": 8, "f": 12, "v": 11}
#: Starts of compressed data; two bytes are too few to be looked for everywhere in base64.
_MAGIC = rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|BZh[1-9]\x17rE8P\x90|\xfd7zXZ\x00|\x28\xb5\x2f\xfd"
_PACKED = re.compile(_MAGIC)
_PACKED_OR_ZLIB = re.compile(_MAGIC + rb"|\x78[\x01\x5e\x9c\xda]")
#: A secret, or an encoded one, has a stretch of so many printable characters.
_STRETCH = re.compile(rb"[\x20-\x7e]{12}")
#: Characters of encoded runs, with what may stand between them: spaces and line ends.
_RUN_LETTERS = "A-Za-z0-9+/_=.~%{}\\\\ \\t\\r\\n-"
_NO_RUN, _NOT64, _BREAK = re.compile(f"[^{_RUN_LETTERS}]"), re.compile(r"[^A-Za-z0-9+/_-]+"), re.compile(r"[-_/+=\s]")
_IN_RUN = np.array([_NO_RUN.match(chr(c)) is None for c in range(256)])
#: Compressed data is known by so many bytes.
_MAGIC_BYTES = 10
_UTF16 = (("utf-16-le", re.compile(rb"(?:[\x20-\x7e]\x00){8}")), ("utf-16-be", re.compile(rb"(?:\x00[\x20-\x7e]){8}")))


class Layer:
    """A text or bytes and, for each of its items, the first and last (exclusive) character of the document behind it, or one such range for all."""

    __slots__ = ("text", "first", "last", "whole")

    def __init__(self, text: str | bytes, first: np.ndarray | None = None, last: np.ndarray | None = None, whole: tuple[int, int] | None = None):
        self.text, self.first, self.last, self.whole = text, first, last, whole

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.whole is not None:
            return self.whole
        if self.first is None:
            return start, end
        return int(self.first[start:end].min()), int(self.last[start:end].max())

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        if self.first is None:
            at = np.arange(len(self.text))
            return at, at + 1
        return self.first, self.last

    def made(self, text: str | bytes, begin: np.ndarray, end: np.ndarray) -> Layer:
        """A layer whose items stand for this one's items ``begin`` to ``end`` (inclusive)."""
        if self.whole is not None:
            return Layer(text, whole=self.whole)
        first, last = self.places()
        return Layer(text, first[begin], last[end])


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the secrets of one layer, in order."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _replaced(layer: Layer, parts: list[tuple[int, int, str, list[tuple[int, int]]]]) -> Layer:
    """``layer`` with each part (start, end, new text, range behind each new character) put in."""
    if layer.whole is not None:
        ends = [0, *(x for start, end, *_ in parts for x in (start, end)), len(layer.text)]
        kept = [layer.text[i:j] for i, j in zip(ends[::2], ends[1::2], strict=True)]
        return Layer("".join(x for pair in zip(kept, [p[2] for p in parts] + [""], strict=True) for x in pair), whole=layer.whole)
    first, last = layer.places()
    text, a, b, at = [], [], [], 0
    for start, end, new, behind in parts:
        text += [layer.text[at:start], new]
        a += [first[at:start], np.array([first[i:j].min() for i, j in behind], np.int64)]
        b += [last[at:start], np.array([last[i:j].max() for i, j in behind], np.int64)]
        at = end
    text.append(layer.text[at:])
    a.append(first[at:])
    b.append(last[at:])
    return Layer("".join(text), np.concatenate(a), np.concatenate(b))


def _characters(raw: bytes, behind: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]] | None:
    """UTF-8 bytes as text, with the range behind each character; None if they are not UTF-8."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    out, at = [], 0
    for c in text:
        n = len(c.encode("utf-8"))
        out.append((behind[at][0], behind[at + n - 1][1]))
        at += n
    return text, out


def _url(layer: Layer) -> Iterator[Layer]:
    if "%" not in layer.text:
        return
    parts = []
    for m in _URL.finditer(layer.text):
        ones = list(_URL_ONE.finditer(m[0]))
        raw = bytes(int(x[1], 16) for x in ones)
        behind = [(m.start() + x.start(), m.start() + x.end()) for x in ones]
        new = _characters(raw, behind) or (raw.decode("latin-1"), behind)
        parts.append((m.start(), m.end(), *new))
    if parts:
        yield _replaced(layer, parts)


def _unicode(layer: Layer) -> Iterator[Layer]:
    if "\\" not in layer.text and "%u" not in layer.text:
        return
    parts = []
    for m in _UNICODE.finditer(layer.text):
        code = int(m[1] or m[2] or m[3] or m[4], 16)
        if code < 0x110000 and not 0xD800 <= code < 0xE000:
            parts.append((m.start(), m.end(), chr(code), [(m.start(), m.end())]))
    if parts:
        yield _replaced(layer, parts)


def _escaped(layer: Layer) -> Iterator[Layer]:
    """The bytes of runs of URL escapes, and of \\x escapes, with the plain characters among them."""
    text = layer.text
    for there, run, token in (("%", _URL_BYTES, _URL_TOKEN), ("\\x", _X_BYTES, _X_TOKEN)):
        if there not in text:
            continue
        for m in run.finditer(text):
            tokens = list(token.finditer(m[0]))
            size = next(k for k in range(len(tokens), 0, -1) if len(tokens[k - 1][0]) > 1)  # up to the last escape, and the word it stands in
            tokens = tokens[: next((k for k in range(size, len(tokens)) if tokens[k][0] == " "), len(tokens))]
            raw = bytes(map(_token_byte, tokens))
            if _PACKED_OR_ZLIB.search(raw) or any(x.search(raw) for _, x in _UTF16):
                begin = m.start() + np.array([t.start() for t in tokens])
                yield layer.made(raw, begin, m.start() + np.array([t.end() for t in tokens]) - 1)


def _token_byte(t: re.Match) -> int:
    """The byte that an escape, or a plain character among escapes, stands for."""
    if t[1]:
        return int(t[1], 16)
    return _X_SHORT.get(t[2], ord(t[2])) & 0xFF if t.re.groups > 1 and t[2] else ord(t[0])


def _base64(layer: Layer) -> Iterator[Layer]:
    """The bytes of base64 runs that are worth a look, in each alignment and from each place where something may be glued on."""
    for m in _RUN.finditer(layer.text):
        yield from _decoded(layer, m[0].rstrip("="), None, m.start(), len(m[0]))
    if "\n" in layer.text:
        for m in _WRAPPED.finditer(layer.text):
            at = np.array([x.start() for x in _LETTER64.finditer(m[0])])
            if len(at) >= SHORTEST_RUN:
                yield from _decoded(layer, "".join(_LETTER64.findall(m[0])), m.start() + at, 0, len(at))


def _decoded(layer: Layer, body: str, at: np.ndarray | None, start: int, size: int) -> Iterator[Layer]:
    """``size`` counts the padding behind ``body`` too."""
    plain = body.translate(_URLSAFE)
    for shift in range(4):
        raw = _bytes64(plain, shift)
        if _STRETCH.search(raw) or _PACKED.search(raw) or (shift == 0 and _is_packed(raw)) or any(x.search(raw) for _, x in _UTF16):
            yield _placed(layer, raw, size, at, start, shift)
    for m in _GLUE.finditer(body):
        if m.end() + 8 <= len(body) and _is_packed(_bytes64(plain[m.end() : m.end() + 8], 0)):
            yield _placed(layer, _bytes64(plain, m.end()), size, at, start, m.end())


def _bytes64(plain: str, shift: int) -> bytes:
    n = len(plain) - shift
    n -= n % 4 == 1
    return binascii.a2b_base64(plain[shift : shift + n] + "=" * (-n % 4)) if n > 0 else b""


def _placed(layer: Layer, raw: bytes, size: int, at: np.ndarray | None, start: int, shift: int) -> Layer:
    begin = shift + 4 * (np.arange(len(raw)) // 3)
    end = np.minimum(begin + 3, size - 1)
    return layer.made(raw, begin + start, end + start) if at is None else layer.made(raw, at[begin], at[end])


_URLSAFE = str.maketrans("-_", "+/")


def _is_packed(raw: bytes) -> bool:
    return _PACKED.match(raw) is not None or (raw[:1] == b"\x78" and len(raw) > 1 and (raw[0] * 256 + raw[1]) % 31 == 0)


class _Unpacker:
    """Compressed data, fed in pieces: what its members hold, one after the other, goes on to a stream of bytes."""

    def __init__(self, out: _Bytes):
        self.out, self.stream, self.kind, self.raw = out, None, b"", b""

    def feed(self, raw: bytes, last: bool = False) -> bool:
        """Whether more can follow."""
        self.raw += raw
        try:
            while self.raw:
                if self.stream is None:
                    if len(self.raw) < _MAGIC_BYTES and not last:
                        return True
                    if not _is_packed(self.raw):
                        break
                    self.stream, self.kind = _decompressor(self.raw), self.raw[:1]
                if not self._step():
                    return True
        except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError):
            pass
        else:
            if not self.raw and not last:
                return True
        self.out.close()
        return False

    def _step(self) -> bool:
        """Unpacks what is there up to the end of a member; False if more is needed."""
        stream = self.stream
        if isinstance(stream, (bz2.BZ2Decompressor, lzma.LZMADecompressor)):
            raw, self.raw = self.raw, b""
            self.out.feed(stream.decompress(raw, _PIECE))
            while not stream.eof and not stream.needs_input:
                self.out.feed(stream.decompress(b"", _PIECE))
            rest = stream.unused_data
        elif self.kind in b"\x1f\x78":
            raw, self.raw = self.raw, b""
            while not stream.eof:
                piece = stream.decompress(raw, _PIECE)
                self.out.feed(piece)
                raw = stream.unconsumed_tail
                if not raw and len(piece) < _PIECE:
                    break
            rest = stream.unused_data
        else:
            raw, self.raw, at = self.raw, b"", 0
            while not stream.eof and at < len(raw):  # takes no limit: little at a time
                self.out.feed(stream.decompress(raw[at : at + 256]))
                at += 256
            rest = stream.unused_data + raw[at:]
        if not stream.eof:
            return False
        self.raw, self.stream = rest, None
        return True

    def close(self) -> None:
        if self.feed(b"", True):
            self.out.close()


def _decompressor(raw: bytes):  # noqa: ANN202
    if raw[:1] in (b"\x1f", b"\x78"):
        return zlib.decompressobj(47)
    if raw[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    return bz2.BZ2Decompressor() if raw[:3] == b"BZh" else lzma.LZMADecompressor()


class _Bytes:
    """Bytes of any length behind one range of the document, fed in pieces. Compressed data that starts in them is unpacked as it comes, and the texts that they may be are read as it comes."""

    def __init__(self, work: _Scan, span: tuple[int, int], above: frozenset[bytes]):
        self.work, self.span, self.above = work, span, above
        self.buffer, self.begin, self.searched = b"", 0, 0
        self.unpackers: list[_Unpacker] = []
        self.texts: dict[tuple[str, int], tuple[_Text, codecs.IncrementalDecoder]] = {}

    def feed(self, raw: bytes) -> None:
        self.unpackers = [u for u in self.unpackers if u.feed(raw)]
        self.buffer += raw
        if len(self.buffer) >= CHUNK:
            self._read(False)

    def close(self) -> None:
        self._read(True)
        for u in self.unpackers:
            u.close()
        for name, at in list(self.texts):
            self._end(name, at)
        self.unpackers = []

    def _read(self, last: bool) -> None:
        """Reads the buffer but for its last few bytes, which may be the start of something."""
        raw = self.buffer
        until = self.begin + (len(raw) if last else len(raw) - _MAGIC_BYTES)
        places = {m.start() + self.begin for m in _PACKED.finditer(raw)} | ({0} if self.begin == 0 and _is_packed(raw) else set())
        for at in sorted(places):
            if self.searched <= at < until:
                self._unpack(raw[at - self.begin :], last)
        self.searched = until
        part = raw[: until - self.begin]
        for name, pattern in _UTF16:
            for parity in (0, 1):
                there = b"\x00" in part and any((m.start() + self.begin) % 2 == parity for m in pattern.finditer(part))
                self._text(name, parity, part, there, last)
        self._text("utf-8", 0, part, _STRETCH.search(part) is not None, last)
        self.buffer, self.begin = raw[len(part) :], until

    def _unpack(self, raw: bytes, whole: bool) -> None:
        head = _digest(raw)
        if whole and not self.work.first_time(b"unpacked" + head, self.span) or head in self.above:
            return
        unpacker = _Unpacker(_Bytes(self.work, self.span, self.above | {head}))
        if unpacker.feed(raw):
            self.unpackers.append(unpacker)

    def _text(self, name: str, parity: int, part: bytes, there: bool, last: bool) -> None:
        known = self.texts.get((name, parity))
        if known is None:
            if not there:
                return
            known = self.texts[name, parity] = (_Text(self.work, self.span, self.above), codecs.getincrementaldecoder(name)("strict" if name == "utf-8" else "replace"))
            if name != "utf-8" and self.begin % 2 != parity:
                part = part[1:]
        text, decoder = known
        ends = not there and not text.running
        if ends:
            part, last = part[:64], True  # what is printable ends in these
        before = decoder.getstate()[0]
        try:
            text.feed(decoder.decode(part, last and not ends))
        except UnicodeDecodeError:
            decoder.reset()
            text.feed((before + part).decode("latin-1"))
        if ends:
            self._end(name, parity)

    def _end(self, name: str, parity: int) -> None:
        self.texts.pop((name, parity))[0].close()


class _Text:
    """Text of any length behind one range of the document, fed in pieces and worked on in chunks that overlap. An encoded run that is longer than the overlap and open at the end of a chunk is also decoded as it comes."""

    def __init__(self, work: _Scan, span: tuple[int, int], above: frozenset[bytes]):
        self.work, self.span, self.above = work, span, above
        self.buffer, self.known = "", 0
        self.run: _Run | None = None

    @property
    def running(self) -> bool:
        return self.run is not None

    def feed(self, text: str) -> None:
        self.buffer += text
        if len(self.buffer) >= CHUNK + OVERLAP:
            self._read(False)

    def close(self) -> None:
        self._read(True)

    def _read(self, last: bool) -> None:
        text = self.buffer
        if self.run is not None:
            m = _NO_RUN.search(text, self.known)
            self.run.feed(text[self.known : m.start() if m else len(text)])
            if m or last:
                self.run.close()
                self.run = None
        if self.run is None and not last:
            codes = np.frombuffer(text.encode("ascii", "replace").replace(b"?", b"\0"), np.uint8)
            outside = np.flatnonzero(~_IN_RUN[codes])
            tail = text[int(outside[-1]) + 1 if len(outside) else 0 :]
            if len(tail) > OVERLAP and (head := _digest(tail)) not in self.above:
                self.run = _Run(self.work, self.span, self.above | {head})
                self.run.feed(tail)
        if len(text) > self.known:
            self.work.take(Layer(text, whole=self.span), self.above)
        self.buffer = "" if last else text[-OVERLAP:]
        self.known = len(self.buffer)


class _Run:
    """A long encoded run, fed in pieces: its bytes as base64 in each alignment and behind escapes, and its text without escapes."""

    def __init__(self, work: _Scan, span: tuple[int, int], above: frozenset[bytes]):
        self.work, self.span, self.above = work, span, above
        self.shifts = [(_Bytes(work, span, above), [""]) for _ in range(4)]
        self.begun = False
        self.glued: list[tuple[_Unpacker, list[str]]] = []
        #: For each kind of escape: what was held back, its bytes, its text.
        self.escapes: dict[str, list] = {}

    def feed(self, text: str) -> None:
        letters = _NOT64.sub("", text).translate(_URLSAFE)
        for shift, (out, held) in enumerate(self.shifts):
            out.feed(self._letters(held, letters if self.begun else letters[shift:]))
        self.glued = [(u, held) for u, held in self.glued if u.feed(self._letters(held, letters))]
        for m in _BREAK.finditer(text):
            head = _NOT64.sub("", text[m.end() : m.end() + 16]).translate(_URLSAFE)
            if len(head) >= 8 and _is_packed(_bytes64(head[:8], 0)):
                unpacker, held = _Unpacker(_Bytes(self.work, self.span, self.above)), [""]
                if unpacker.feed(self._letters(held, _NOT64.sub("", text[m.end() :]).translate(_URLSAFE))):
                    self.glued.append((unpacker, held))
        self.begun = self.begun or bool(letters)
        for mark, pattern in (("%", _URL_ONE), ("\\", _UNICODE)):
            if mark in self.escapes or pattern.search(text):
                self._unescape(mark, text, False)

    @staticmethod
    def _letters(held: list[str], letters: str) -> bytes:
        held[0] += letters
        n = len(held[0]) // 4 * 4
        raw, held[0] = _bytes64(held[0][:n], 0), held[0][n:]
        return raw

    def _unescape(self, mark: str, text: str, last: bool) -> None:
        if mark not in self.escapes:
            self.escapes[mark] = ["", _Bytes(self.work, self.span, self.above), _Text(self.work, self.span, self.above)]
        state = self.escapes[mark]
        text = state[0] + text
        cut = -1 if last else max(text.rfind("%"), text.rfind("\\"))
        if cut < 0 or len(text) - cut > 64:
            cut = len(text)
        while 0 < cut < len(text) and text[cut - 1] in "\\%":
            cut -= 1
        state[0], text = text[cut:], text[:cut]
        layer = Layer(text, whole=self.span)
        token = _URL_TOKEN if mark == "%" else _X_TOKEN
        state[1].feed(b"".join(_token_byte(t).to_bytes() for t in token.finditer(text) if ord(t[0][0]) < 256))
        state[2].feed(next((_url if mark == "%" else _unicode)(layer), layer).text)

    def close(self) -> None:
        for out, held in self.shifts:
            out.feed(_bytes64(held[0], 0))
            out.close()
        for unpacker, held in self.glued:
            if unpacker.feed(_bytes64(held[0], 0)):
                unpacker.close()
        for mark in list(self.escapes):
            self._unescape(mark, "", True)
            self.escapes[mark][1].close()
            self.escapes[mark][2].close()


def _digest(raw: bytes | str) -> bytes:
    kind, raw = (b"t", raw.encode("utf-8", "surrogatepass")) if isinstance(raw, str) else (b"b", raw)
    return hashlib.blake2b(raw, digest_size=16, person=kind).digest()


def _from_bytes(layer: Layer) -> Iterator[Layer]:
    """The texts that a layer of bytes may be."""
    raw = layer.text
    wide = False
    for name, pattern in _UTF16:
        m = pattern.search(raw)
        if m is not None:
            wide = True
            skip = m.start() % 2
            text = raw[skip : len(raw) - (len(raw) - skip) % 2].decode(name, "replace")
            sizes = np.fromiter((4 if c > "\uffff" else 2 for c in text), np.int64, len(text))
            end = np.minimum(skip + np.cumsum(sizes), len(raw))
            yield layer.made(text, np.minimum(end - sizes, len(raw) - 1), end - 1)
    if wide or not _STRETCH.search(raw):
        return
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        at = np.arange(len(raw))
        yield layer.made(raw.decode("latin-1"), at, at)
        return
    begin = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    yield layer.made(text, begin, np.append(begin[1:], len(raw)) - 1)


def _unwrapped(layer: Layer) -> Iterator[Layer]:
    for unwrap in (_from_bytes,) if isinstance(layer.text, bytes) else (_url, _unicode, _escaped, _base64):
        yield from unwrap(layer)


class _Scan:
    """The worklist of one document. The layers of a layer are drawn one at a time and worked off before the next; only digests of the earlier ones are kept."""

    def __init__(self) -> None:
        self.seen: set[tuple] = set()
        self.base: list[tuple[int, int, int]] = []
        self.found: set[tuple[int, int, int]] = set()

    def first_time(self, digest: bytes, span: tuple[int, int]) -> bool:
        key = (digest, *span)
        if key in self.seen:
            return False
        self.seen.add(key)
        return True

    def take(self, layer: Layer, above: frozenset[bytes] = frozenset()) -> None:
        work = [iter([layer])]
        while work:
            inner = next(work[-1], None)
            if inner is None:
                work.pop()
            elif inner.text and self.first_time(_digest(inner.text), inner.span(0, len(inner.text))):
                if isinstance(inner.text, str) and inner.first is None and inner.whole is None:
                    self.base = scan(inner.text)
                    self.found.update(self.base)
                elif isinstance(inner.text, str):
                    self.found.update((s, kind, e) for start, kind, end in scan(inner.text) for s, e in [inner.span(start, end)])
                else:
                    self._unpack(inner, above)
                work.append(_unwrapped(inner))

    def _unpack(self, layer: Layer, above: frozenset[bytes]) -> None:
        raw = layer.text
        glued = _PACKED if layer.whole is not None else _PACKED_OR_ZLIB
        for at in sorted({m.start() for m in glued.finditer(raw)} | ({0} if _is_packed(raw) else set())):
            span, head = layer.span(at, len(raw)), _digest(raw[at:])
            if self.first_time(b"unpacked" + head, span):
                unpacker = _Unpacker(_Bytes(self, span, above | {head}))
                if unpacker.feed(raw[at:]):
                    unpacker.close()


def secrets(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans) as sorted (start, kind number, end)."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))  # compressed data inside compressed data is a call inside a call
    work = _Scan()
    work.take(Layer(text))
    return work.base, sorted(work.found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base, spans, n_added for each row of ``docs``."""
    rows = docs.select("doc_id", "text")
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, n_assign long, n_access long, n_hex long, base string, spans string, n_added long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            bases, spans, added = [], [], []
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            for i, j in zip(offsets[:-1], offsets[1:], strict=True):
                base, found = secrets(raw[i:j].decode("utf-8", "replace"))
                for kind in range(3):
                    counts[kind].append(sum(k == kind for _, k, _ in base))
                bases.append(joined(base))
                spans.append(joined(found))
                added.append(len(found) - len(base))
            made = [pa.array(c, pa.int64()) for c in counts] + [pa.array(bases, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *made], ["doc_id", "n_assign", "n_access", "n_hex", "base", "spans", "n_added"]
            )

    return rows.mapInArrow(run, schema)
