r"""Secret scan with a recursive decoding worklist.

A text is layer 0.  Each layer is scanned; every encoded part of it (percent escapes, Unicode
escapes, base64 runs, and compressed data inside any of them, as often as compressed and of all
members) is decoded into a further layer, until no new layer appears.  The first ``LEVELS`` levels of
escapes inside escapes are layers of their own; deeper ones are unwound together, in one pass over the
text, so that a chain of n escapes costs n, not n * n (no find can hold an escape, so a find of a level
between is part of one of the last level).  Bytes that are not UTF-8 are read as latin-1, and where
every other byte is null also as the text between; such layers, and those with control characters,
count in ``n_layers`` only if a rule fires in them.  A layer is identified by a digest of its content
and the place it came from, so a layer that decodes to itself (or a cycle of such) ends the work.
Every character of a layer carries the span of layer-0 code points it came from, so finds map back.

A compressed layer of more than ``held_bytes`` is read as a stream, in blocks that overlap by 64 KiB,
so a rule's find up to that length is whole in one of them; runs inside it that are themselves encoded
are decoded as far as a block holds them.

Defined results: a null or empty text has no spans; repeated rows give repeated results; a null id
stays null; other columns are ignored.  What a compressed layer has beyond ``max_layer_bytes``, and a
streamed layer that is itself compressed, is not skipped silently: its place is reported as kind
``oversize``.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import html
import lzma
import re
import zlib
from collections.abc import Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches

# fixed values: the three base rules and their order
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a shorter run fails as a whole, so the bound can stand in the pattern
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+")
_ONE_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\[uUx]([0-9A-Fa-f]+)|(&#[^;]+;)")
_BASE64 = re.compile(r"(?:[A-Za-z0-9+/]{60,76}\r?\n)+[A-Za-z0-9+/]{2,76}+={0,2}(?![A-Za-z0-9+/_-])|[A-Za-z0-9+/_-]{16,}={0,2}")
_MAGIC = (b"\x1f\x8b", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd")

_ANY_MAGIC = re.compile(b"|".join(map(re.escape, _MAGIC)))
_WIDE = re.compile(rb"[\x01-\x7f](?:\x00[\x01-\x7f]){7,}")  # UTF-16 of either order; no rule needs more than ASCII
_QUOTED = re.compile(r"[!-~]+")
_QUOTED_BYTE = re.compile(r"%([0-9A-Fa-f]{2})|[!-~]")
_LITERAL = re.compile(r"""(?:\\(?:x[0-9A-Fa-f]{2}|u00[0-9A-Fa-f]{2}|U000000[0-9A-Fa-f]{2}|u\{0*[0-9A-Fa-f]{1,2}\}|[abfnrtv'"/\\])|&\#(?:[0-9]{1,3}|[xX][0-9A-Fa-f]{1,2});|[\x20-\x7f])+""")
_LITERAL_BYTE = re.compile(r"""\\(?:x|u00|U000000)([0-9A-Fa-f]{2})|\\u\{0*([0-9A-Fa-f]{1,2})\}|&\#[xX]([0-9A-Fa-f]{1,2});|&\#([0-9]{1,3});|\\([abfnrtv'"/\\])|[\x20-\x7f]""")
_NAMED = dict(zip("abfnrtv'\"/\\", b"\a\b\f\n\r\t\v'\"/\\", strict=True))

#: Levels of escapes inside escapes that are layers of their own.
LEVELS = 3
#: Bytes of a streamed layer that are read at a time, and how far blocks overlap.
_BLOCK, _OVERLAP = 1 << 20, 1 << 16

COLUMNS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, found array<struct<kind:string,via:string,start:long,end:long>>"


def scan_text(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base rules, by start and then kind as listed."""
    found = []
    lowered = text.lower()
    if any(w in lowered for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    found.sort()
    return [(s, KINDS[k], e) for s, k, e in found]


class Layer:
    """Decoded text; ``starts``/``ends`` give each character's span in layer 0 (None: itself).
    ``clear``: surely text, not bytes read as such."""

    __slots__ = ("text", "starts", "ends", "via", "clear")

    def __init__(self, text, starts, ends, via, clear=True):
        self.text, self.starts, self.ends, self.via, self.clear = text, starts, ends, via, clear

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())


def _rewritten(layer: Layer, pattern: re.Pattern, decode, via: str) -> Layer | None:
    """The whole layer with every match decoded, so that what stands around it stays in context."""
    parts, lows, highs, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        new = decode(m.group())
        if new is None or new[0] == m.group():
            continue
        parts += [layer.text[at : m.start()], new[0]]
        plain = np.arange(at, m.start())
        lows += [plain, m.start() + new[1]]
        highs += [plain + 1, m.start() + new[2]]
        at = m.end()
    if not parts:
        return None
    parts.append(layer.text[at:])
    plain = np.arange(at, len(layer.text))
    low, high = np.concatenate([*lows, plain]), np.concatenate([*highs, plain + 1])
    if layer.starts is not None:
        low, high = layer.starts[low], layer.ends[high - 1]
    return Layer("".join(parts), low, high, (*layer.via, via))


def _unpercent(run: str):
    raw = bytes.fromhex(run.replace("%", ""))
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        text = raw.decode("latin-1")
        at = np.arange(len(raw))
        return text, 3 * at, 3 * at + 3
    sizes = np.array([len(c.encode()) for c in text])
    ends = np.cumsum(sizes)
    return text, 3 * (ends - sizes), 3 * ends


def _unescape(run: str):
    out, low, high = [], [], []
    for m in _ONE_ESCAPE.finditer(run):
        if m[3]:
            c = html.unescape(m[3])
        else:
            code = int(m[1] or m[2], 16)
            if code > 0x10FFFF:
                return None
            c = chr(code)
        if out and len(c) == 1 and 0xDC00 <= ord(c) < 0xE000 and 0xD800 <= ord(out[-1]) < 0xDC00:
            out[-1] = chr(0x10000 + ((ord(out[-1]) - 0xD800) << 10) + ord(c) - 0xDC00)
            high[-1] = m.end()
            continue
        for x in c:
            out.append(x)
            low.append(m.start())
            high.append(m.end())
    return "".join(out), np.array(low, np.int64), np.array(high, np.int64)


_HEXDIGITS = frozenset("0123456789abcdefABCDEF")
_TAIL = re.compile(r"(?:\\u\{([0-9A-Fa-f]{1,6})\}|(&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});))\Z")


def _ending(out: list[str]) -> tuple[int, str] | None:
    """Length and character of the escape that ``out`` ends with, if that is ASCII or nothing."""
    c, n = out[-1], len(out)
    if c in _HEXDIGITS:
        for size, head in ((3, ("%",)), (4, ("\\", "x")), (6, ("\\", "u")), (10, ("\\", "U"))):
            if n >= size and tuple(out[n - size : n - size + len(head)]) == head and _HEXDIGITS.issuperset(out[n - size + len(head) :]):
                code = int("".join(out[n - size + len(head) :]), 16)
                return (size, chr(code)) if code < 128 else None
    elif c in ";}":
        m = _TAIL.search("".join(out[-10:]))
        if m:
            new = html.unescape(m[2]) if m[2] else chr(int(m[1], 16)) if int(m[1], 16) < 128 else None
            if new is not None and (not new or len(new) == 1 and new < "\x80"):
                return len(m.group()), new
    return None


def _unwound(layer: Layer) -> Layer | None:
    """The layer with all escapes of ASCII characters decoded, and those that they make, to the last."""
    out: list[str] = []
    low, high, changed = [], [], False
    for i, c in enumerate(layer.text):
        out.append(c)
        low.append(i)
        high.append(i + 1)
        while out and (hit := _ending(out)):
            size, new = hit
            first, last, changed = low[-size], high[-1], True
            del out[-size:], low[-size:], high[-size:]
            if not new:
                break
            out.append(new)
            low.append(first)
            high.append(last)
    if not changed:
        return None
    low, high = np.array(low, np.int64), np.array(high, np.int64)
    if layer.starts is not None:
        low, high = layer.starts[low], layer.ends[high - 1]
    return Layer("".join(out), low, high, (*layer.via, "nested"))


def _stream(raw: bytes) -> Generator[tuple[bytes, bool], None, bytes]:
    """Decompressed blocks of all members in front, and whether each ends a member; returns what
    follows.  A member that turns out malformed is part of that."""
    kind = next(x for x in _MAGIC if raw.startswith(x))
    while raw.startswith(kind):
        try:
            if kind == b"\x28\xb5\x2f\xfd":
                import zstandard

                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                while piece := reader.read(_BLOCK):
                    yield piece, False
                yield b"", True
                return b""
            zlibs = not (kind == b"BZh" or kind == b"\xfd7zXZ\x00")
            stream = zlib.decompressobj(31 if kind == b"\x1f\x8b" else 15) if zlibs else bz2.BZ2Decompressor() if kind == b"BZh" else lzma.LZMADecompressor()
            data, open_ = raw, True
            while open_:
                piece = stream.decompress(data, _BLOCK)
                data = stream.unconsumed_tail if zlibs else b""
                open_ = not stream.eof and bool(data if zlibs else not stream.needs_input) or bool(piece) and not stream.eof
                yield piece, not open_
        except Exception:  # noqa: BLE001  any malformed stream: not compressed data after all
            break
        raw = stream.unused_data if stream.eof else b""
    return raw


def _inflate(raw: bytes, most: int) -> tuple[bytes, bool, bytes]:
    """Decompressed bytes of all whole members in front, whether there were more than ``most``, and what follows."""
    done, member, size, stream = [], [], 0, _stream(raw)
    while True:
        try:
            piece, ends = next(stream)
        except StopIteration as end:
            return b"".join(done), False, end.value
        member.append(piece)
        size += len(piece)
        if size > most:
            return b"", True, b""
        if ends:
            done += member
            member = []


def _opened(raw: bytes, most: int):
    """(bytes, times inflated) of all that is in ``raw``, itself if it is not compressed; of what
    expands beyond ``most`` the stream of its blocks."""
    work, seen = [(raw, 0)], set()
    while work:
        raw, times = work.pop()
        key = hashlib.blake2b(raw, digest_size=16).digest()
        if key in seen:
            continue
        seen.add(key)
        if raw.startswith(_MAGIC):
            out, more, rest = _inflate(raw, most)
            if more:
                yield _stream(raw), times + 1
                continue
            if len(rest) < len(raw):
                work += [(x, n) for x, n in ((out, times + 1), (rest, times)) if x]
                continue
        yield raw, times


def _texts(raw: bytes):
    """(text, first byte of each character, end byte, surely text) of ``raw`` read as text."""
    try:
        text = raw.decode()
        sizes = np.array([len(c.encode()) for c in text], np.int64)
        clear = not any(ord(c) < 32 and c not in "\t\n\r" for c in text)
    except UnicodeDecodeError:
        text, sizes, clear = raw.decode("latin-1"), np.ones(len(raw), np.int64), False
    if text and (clear or scan_text(text) or any(p.search(text) for p in (_BASE64, _PERCENT, _ESCAPE))):
        ends = np.cumsum(sizes)
        yield text, ends - sizes, ends, clear
    if b"\0" in raw:
        for m in _WIDE.finditer(raw):
            at = np.arange(m.start(), m.end(), 2)
            yield m.group()[::2].decode(), at, at + 1, False


def _streamed(stream: Iterator[tuple[bytes, bool]], first: int, last: int, via: tuple[str, ...], most: int):
    """Layers of the blocks of a stream, one at a time; (first, last, via) for what isn't read."""
    tail, size = b"", 0
    for piece, _ in stream:
        if not size and piece.startswith(_MAGIC) or size > most:
            yield first, last, via
            return
        size += len(piece)
        block = tail + piece
        for text, _, _, clear in _texts(block):
            yield Layer(text, np.full(len(text), first), np.full(len(text), last), via, clear)
        tail = block[-_OVERLAP:]


def _from_escapes(layer: Layer, held: int, most: int):
    """Layers of compressed bytes that stand as percent or other escapes among plain characters."""
    ways = []
    if "%" in layer.text:
        ways += [("url", _QUOTED, _QUOTED_BYTE, 32), ("url", _QUOTED, _QUOTED_BYTE, 43)]  # + is a space or itself
    if "\\" in layer.text or "&#" in layer.text:
        ways.append(("unicode", _LITERAL, _LITERAL_BYTE, 43))
    for via, token, byte, plus in ways:
        for m in token.finditer(layer.text):
            if not (_ESCAPE if via == "unicode" else _PERCENT).search(m.group()) or plus == 43 and via == "url" and "+" not in m.group():
                continue
            parts = list(byte.finditer(m.group()))
            raw = bytearray()
            for p in parts:
                if via == "url":
                    raw.append(int(p[1], 16) if p[1] else plus if p[0] == "+" else ord(p[0]))
                else:
                    code = p[1] or p[2] or p[3]
                    raw.append(int(code, 16) if code else int(p[4]) & 255 if p[4] else _NAMED[p[5]] if p[5] else ord(p[0]))
            raw, end = bytes(raw), 0
            for hit in _ANY_MAGIC.finditer(raw):
                if hit.start() < end:
                    continue
                out, more, rest = _inflate(raw[hit.start() :], held)
                if not out and not more:
                    continue
                end = len(raw) - len(rest)
                first, last = layer.place(m.start() + parts[hit.start()].start(), m.start() + parts[end - 1].end())
                for opened, times in [(_stream(raw[hit.start() :]), 0)] if more else _opened(out, held):
                    if not isinstance(opened, bytes):
                        yield _streamed(opened, first, last, (*layer.via, via, *["compressed"] * (times + 1)), most)
                        continue
                    for text, _, _, clear in _texts(opened):
                        yield Layer(text, np.full(len(text), first), np.full(len(text), last), (*layer.via, via, *["compressed"] * (times + 1)), clear)


def _line_groups(whole: str) -> list[tuple[int, str]]:
    """Parts of a wrapped run, of which any line may be another run, a digest or a word of prose: all
    but the last or first line, from each line that begins compressed data, and the longest groups of
    lines that decode to UTF-8 together, each from where the one before ended."""
    lines = [(m.start(), m.end()) for m in re.finditer(r"[^\r\n]+", whole)]
    raws = []
    for s, e in lines:
        body = whole[s:e].rstrip("=")
        body = body[: len(body) - (len(body) % 4 == 1)]
        raws.append(base64.b64decode(body + "=" * (-len(body) % 4)))
    n = len(lines)
    ranges = [(0, n - 1), (1, n), (1, n - 1), *((i, n) for i, raw in enumerate(raws) if raw.startswith(_MAGIC))]
    i = 0
    while i < n:
        decoder, j = codecs.getincrementaldecoder("utf-8")(), i
        try:
            while j < n:
                decoder.decode(raws[j])
                j += 1
        except UnicodeDecodeError:
            pass
        pending = len(decoder.getstate()[0]) > 0
        ranges += [(i, j), (i, j - 1)] if pending else [(i, j)]
        i = max(j, i + 1)
    ranges += [(i, i + 1) for i in range(n)]
    return [(lines[i][0], whole[lines[i][0] : lines[j - 1][1]]) for i, j in dict.fromkeys(ranges) if i < j and (i, j) != (0, n)]


def _from_base64(layer: Layer, held: int, most: int):
    """Layers of the base64 runs, and streams of layers."""
    for m in _BASE64.finditer(layer.text):
        whole = m.group()
        pieces = [(m.start(), whole)]
        if "\n" in whole:
            pieces += [(m.start() + at, piece) for at, piece in _line_groups(whole)]
        if re.search("[-_/]", whole):
            pieces += [(m.start() + p.start(), p.group()) for p in re.finditer(r"[A-Za-z0-9+]{16,}={0,2}", whole) if p.group() != whole]
        done, unsure = [], []
        for at, piece in pieces:
            if any(s <= at and at + len(piece) <= e for s, e in done):
                continue
            kept = np.array([i for i, c in enumerate(piece) if c not in "\r\n="])
            body = "".join(piece[i] for i in kept).replace("-", "+").replace("_", "/")
            if len(body) % 4 == 1:
                body, kept = body[:-1], kept[:-1]
            try:
                raw = base64.b64decode(body + "=" * (-len(body) % 4))
            except (binascii.Error, ValueError):
                continue
            first, last = layer.place(at, at + len(piece))
            for opened, times in _opened(raw, held):
                via = (*layer.via, "base64", *["compressed"] * times)
                if not isinstance(opened, bytes):
                    yield _streamed(opened, first, last, via, most)
                    done.append((at, at + len(piece)))
                    continue
                for text, begins, ends, clear in _texts(opened):
                    if times or opened is not raw:
                        low, high = np.full(len(text), first), np.full(len(text), last)
                    else:
                        low = at + kept[begins * 8 // 6]
                        high = at + kept[np.minimum((ends * 8 - 1) // 6, len(kept) - 1)] + 1
                        if not clear:
                            unsure.append((text, low, high, via))
                            continue
                        if layer.starts is not None:
                            low, high = layer.starts[low], layer.ends[high - 1]
                    yield Layer(text, low, high, via, clear)
                    if clear:
                        done.append((at, at + len(piece)))
                if times:
                    done.append((at, at + len(piece)))
        for text, low, high, via in unsure:  # but for what turned out to be text or compressed
            inside = np.zeros(len(text), bool)
            for s, e in done:
                inside |= (low < e) & (high > s)
            if inside.any():
                text = "".join("\n" if x else c for x, c in zip(inside.tolist(), text, strict=True))
            if layer.starts is not None:
                low, high = layer.starts[low], layer.ends[high - 1]
            yield Layer(text, low, high, via, False)


def _levels(via: tuple[str, ...]) -> int:
    """How many levels of escapes lead to a layer, since the last other decoding."""
    return next((i for i, v in enumerate(reversed(via)) if v not in ("url", "unicode", "nested")), len(via))


def _decoded(layer: Layer, held: int, most: int):
    """What a layer holds: layers, streams of layers, and places that are not read."""
    new = []
    if _levels(layer.via) >= LEVELS and (deep := _unwound(layer)):
        new.append(deep)
    else:
        if "%" in layer.text:
            new.append(_rewritten(layer, _PERCENT, _unpercent, "url"))
        if "\\" in layer.text or "&#" in layer.text:
            new.append(_rewritten(layer, _ESCAPE, _unescape, "unicode"))
    yield from filter(None, new)
    yield from _from_base64(layer, held, most)
    yield from _from_escapes(layer, held, most)


def scan(text: str | None, held_bytes: int = 1 << 24, max_layer_bytes: int = 1 << 30) -> tuple[list[tuple[int, str, int]], list[tuple[str, str, int, int]], int]:
    """Base spans, the spans that decoded layers add as (kind, via, start, end), and layers read."""
    text = text or ""
    base = scan_text(text)
    seen, known, added, layers = set(), {(k, s, e) for s, k, e in base}, [], 0
    work = [iter([Layer(text, None, None, ())])]  # what waits is decoded only when its turn comes
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if not isinstance(layer, Layer):
            if isinstance(layer, Iterator):
                work.append(layer)
            elif ("oversize", *layer[:2]) not in known:
                known.add(("oversize", *layer[:2]))
                added.append(("oversize", "+".join(layer[2]), *layer[:2]))
            continue
        first, last = layer.place(0, len(layer.text)) if layer.text else (0, 0)
        key = hashlib.blake2b(f"{first}:{last}:{layer.text}".encode(errors="surrogatepass"), digest_size=16).digest() if layer.via else b""
        if key in seen:
            continue
        seen.add(key)
        spans = scan_text(layer.text) if layer.via else base
        layers += layer.clear or bool(spans)
        if layer.via:
            for s, kind, e in spans:
                s, e = layer.place(s, e)
                if (kind, s, e) not in known:
                    known.add((kind, s, e))
                    added.append((kind, "+".join(layer.via), s, e))
        work.append(_decoded(layer, held_bytes, max_layer_bytes))
    return base, added, layers


def _row(text: str | None, held: int, most: int) -> dict:
    base, added, layers = scan(text, held, most)
    rank = {k: i for i, k in enumerate((*KINDS, "oversize"))}
    every = sorted([(s, rank[k], e, k, "") for s, k, e in base] + [(s, rank[k], e, k, via) for k, via, s, e in added])
    return {
        **{f"n_{k}": sum(x[1] == k for x in base) for k in KINDS},
        "base_sha256": hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in base).encode()).hexdigest(),
        "spans": ",".join(f"{k}:{s}:{e}" for s, _, e, k, _ in every),
        "n_layers": layers,
        "found": [{"kind": k, "via": via, "start": s, "end": e} for s, _, e, k, via in every],
    }


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_bytes: int = 1 << 24, max_layer_bytes: int = 1 << 30) -> DataFrame:
    """One row per input row: the id, counts, spans and finds (kind, decoding chain, span).

    Row by row, no shuffle; memory is one Arrow batch plus the layers of one text.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [_row(t, held_bytes, max_layer_bytes) for t in b.column(1).to_pylist()]
        found = pa.list_(pa.struct([("kind", pa.string()), ("via", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        kinds = {"base_sha256": pa.string(), "spans": pa.string(), "found": found}
        names = [c.strip().split(" ")[0] for c in COLUMNS.split(", ")]
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names)], [id_col, *names])

    return map_batches(docs.select(id_col, text_col), batch, f"`{id_col}` {kind}, {COLUMNS}")
