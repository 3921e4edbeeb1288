"""Secret scans: a worklist of decoded layers, each scanned again, with spans mapped to the text.

A layer is a string with, for every code point, the span of the original text it came from. The
text itself is the first layer. Each layer is scanned for secrets, then unwrapped: percent
escapes and ``\\u`` / ``\\x`` / ``%u`` escapes in place, base64 tokens (plain, URL-safe or in lines,
from each of their first four characters) and gzip, zlib, bzip2 and xz data anywhere inside them,
with all their members. Bytes that are not UTF-8 are read as replacement characters, and bytes with
as many zeros as UTF-16 has in Latin text are read as that, too, so a layer is scanned whatever it
holds. Unpacked data are scanned in blocks, cut where no secret and no token can lie.
New layers join the worklist until none is left; a layer met before at the same place is not
taken again, so cycles end. No shuffle, no state beyond one text and its open blocks.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .bytehash import released

# Fixed values of the contract: patterns, least lengths and the order of the kinds.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

#: Unpacked data are read in blocks of about so many bytes.
BLOCK = 1 << 20

_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:[\\%]u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\})+")
_ESCAPE_ONE = re.compile(r"[\\%]u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\u\{([0-9A-Fa-f]{1,6})\}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/])(?:[A-Za-z0-9+/]{40,}+\r?\n)+[A-Za-z0-9+/]{4,}")
_PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00")
# bytes that no secret, escape or token holds; the second kind may lie inside a character
_APART = (re.compile(rb"[^\x80-\xbfA-Za-z0-9+/_.=:%\\{}\"'\x20\r\n-]"), re.compile(rb"[^A-Za-z0-9+/_.=:%\\{}\"'\x20\r\n-]"))
_URL_SAFE = str.maketrans("-_", "+/")


def scan(text: str, runs: list[re.Match] | None = None) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of every secret of one string, by start and kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    # a maximal run of hexadecimal digits or of an access key lies within one run of 16 or more
    for run in _RUN.finditer(text) if runs is None else runs:
        for kind, pattern, least in ((1, ACCESS, LEAST_ACCESS), (2, HEX, LEAST_HEX)):
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text, run.start(), run.end()) if m.end() - m.start() >= least]
    return sorted(found)


def _unescape(text: str, pattern: re.Pattern, decode) -> tuple[str, array, array] | None:
    """The text with the runs of ``pattern`` decoded, and each code point's span before."""
    out, starts, ends, last, changed = [], array("q"), array("q"), 0, False

    def copy(a: int, b: int) -> None:
        out.append(text[a:b])
        starts.extend(range(a, b))
        ends.extend(range(a + 1, b + 1))

    for m in pattern.finditer(text):
        pieces = decode(m.group())
        if pieces is None:
            continue
        copy(last, m.start())
        for piece, a, b in pieces:
            out.append(piece)
            starts.append(m.start() + a)
            ends.append(m.start() + b)
        last, changed = m.end(), True
    if not changed:
        return None
    copy(last, len(text))
    return "".join(out), starts, ends


def _percent(run: str, strict: bool = True):
    raw = bytes.fromhex(run.replace("%", ""))
    try:
        text = raw.decode(errors="strict" if strict else "surrogateescape")
    except UnicodeDecodeError:
        return None
    out, at = [], 0
    for c in text:
        damaged = 0xDC80 <= ord(c) <= 0xDCFF
        width = 3 if damaged else 3 * len(c.encode())
        out.append(("\ufffd" if damaged else c, at, at + width))
        at += width
    return out


def _percent_any(run: str):
    """The same, with a replacement character for each byte that is not UTF-8."""
    return _percent(run, False)


def _escape(run: str):
    codes = [(int(next(g for g in m.groups() if g), 16), m.start(), m.end()) for m in _ESCAPE_ONE.finditer(run)]
    out, k = [], 0
    while k < len(codes):
        code, a, b = codes[k]
        if 0xD800 <= code < 0xDC00 and k + 1 < len(codes) and 0xDC00 <= codes[k + 1][0] < 0xE000:
            code, b, k = 0x10000 + ((code - 0xD800) << 10) + codes[k + 1][0] - 0xDC00, codes[k + 1][2], k + 1
        out.append(("�" if 0xD800 <= code < 0xE000 or code > 0x10FFFF else chr(code), a, b))
        k += 1
    return out


def _decoder(head: bytes):
    """A decompressor if ``head`` begins compressed data."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0:
        return zlib.decompressobj(15)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _unpack(source: Iterator[bytes]) -> Iterator[bytes]:
    """The unpacked blocks of all members; of damaged data, those before the damage."""
    rest = b""
    while True:
        while len(rest) < 6 and (more := next(source, None)) is not None:
            rest = (rest + more).lstrip(b"\0")  # padding between members
        member = _decoder(rest)
        if member is None:
            return
        feed = rest
        while not member.eof:
            try:
                data = member.decompress(feed, BLOCK)
            except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
                return
            if data:
                yield data
            feed = getattr(member, "unconsumed_tail", b"")
            if not member.eof and (member.needs_input if hasattr(member, "needs_input") else not feed and len(data) < BLOCK):
                more = next(source, None)
                if more is None:
                    return
                feed += more
        rest = member.unused_data.lstrip(b"\0")


def _logged(source: Iterator[bytes], log: list[bytes], on: list[bool]) -> Iterator[bytes]:
    for block in source:
        if on:
            log.append(block)
        yield block


def _open(raw: bytes) -> tuple[Iterator[bytes] | None, bool]:
    """Blocks of what ``raw`` holds after all its levels of compression, and whether a level was left closed.

    A level that begins like one before it is not opened: data that unpack to themselves end there.
    """
    head, stream, met, levels = raw, iter(()), {_digest(raw)}, 0
    while _decoder(head) is not None:
        log, on = [], [True]
        source = _logged(stream, log, on)
        inner = _unpack(itertools.chain([head], source))
        first = next(inner, None)
        if first is None:  # not compressed after all
            stream = itertools.chain(log, source)
            break
        on.clear()
        key = _digest(first)
        if key in met:
            return (itertools.chain([first], inner), True) if len(first) >= BLOCK else (None, False)
        met.add(key)
        head, stream, levels = first, inner, levels + 1
    return (itertools.chain([head], stream) if levels else None), False


def _blocks(source: Iterator[bytes]) -> Iterator[bytes]:
    """The data dealt anew, cut only where no secret and no token can lie; without such a place, uncut."""
    held, size = [], 0
    for data in source:
        size += len(data)
        cut = -1
        for pattern in _APART if size >= BLOCK else ():
            cut = max((m.start() for m in pattern.finditer(data, max(0, len(data) - 4096))), default=-1)
            if cut < 0 and (m := pattern.search(data)):
                cut = m.start()
            if cut >= 0:
                break
        if cut < 0:
            held.append(data)
            continue
        yield b"".join([*held, data[:cut]])
        held, size = [data[cut:]], len(data) - cut
    if held:
        yield b"".join(held)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _text(raw: bytes) -> tuple[str, bool]:
    """The text of the bytes, and whether it is text throughout."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return raw.decode(errors="replace"), False
    return text, len(text) >= 8 and all(c.isprintable() or c in "\n\r\t" for c in text)


def _wide(raw: bytes) -> list[str]:
    """The bytes as UTF-16 of either order, if a third of the high bytes are zero, as in Latin text."""
    half = len(raw) // 2
    return [raw[: 2 * half].decode(code, errors="replace") for code, high in (("utf-16-le", raw[1::2]), ("utf-16-be", raw[0 : 2 * half : 2])) if half >= 8 and 3 * high.count(0) >= half]


class _Same:
    """Any number of equal places."""

    def __init__(self, place: int):
        self.place = place

    def __getitem__(self, k: int) -> int:
        return self.place


class _Quads:
    """Places of the bytes of a base64 token: each begins and ends within its four characters."""

    def __init__(self, places, first: int, last: int, behind: int):
        self.places, self.first, self.last, self.behind = places, first, last, behind

    def __getitem__(self, k: int) -> int:
        return self.places[min(self.last, self.first + 4 * (k // 3) + k % 3 + self.behind)]


def _base64(token: str, skip: int = 0) -> bytes:
    """The bytes of the token from its character ``skip`` on; a last character that makes no byte goes."""
    body = token.translate(_URL_SAFE).replace("\r", "").replace("\n", "").rstrip("=")[skip:]
    body = body[: len(body) - (len(body) % 4 == 1)]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return b""


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, int]:
    """Base spans, all spans, the number of layers beyond the text, and of those not opened.

    A layer that is not text throughout counts only if it holds a secret.
    """
    runs = list(_RUN.finditer(text))
    base = scan(text, runs)
    if not runs and "%" not in text and "\\" not in text:
        return base, base, 0, 0
    spans, layers, unopened = set(base), 0, 0
    seen: set[tuple[bytes, int, int]] = set()
    # iterators of layers; only the last one is read, so that one block of unpacked data is held at a time
    work: list[Iterator[tuple]] = [iter([(text, range(len(text)), range(1, len(text) + 1))])]

    def fresh(new: str, lo: int, hi: int) -> bool:
        key = (_digest(new.encode(errors="surrogatepass")), lo, hi)
        return not (key in seen or seen.add(key))

    def taken(new: str, starts, ends) -> bool:
        found = scan(new)
        spans.update((starts[a], kind, ends[b - 1]) for a, kind, b in found)
        return bool(found)

    def push(new: str, sure: bool, places) -> None:
        nonlocal layers
        if not sure and not ("%" in new or "\\" in new or _RUN.search(new) or scan(new)):
            return  # nothing can come of it
        starts, ends = places()
        if new and fresh(new, starts[0], ends[len(new) - 1]):
            layers += taken(new, starts, ends) or sure
            work.append(iter([(new, starts, ends)]))

    def unpacked(source: Iterator[bytes], lo: int, hi: int):
        nonlocal layers
        sure, hit, any_fresh = True, False, False
        for block in _blocks(source):
            new, clean = _text(block)
            sure &= clean
            if new and fresh(new, lo, hi):
                any_fresh = True
                hit |= taken(new, _Same(lo), _Same(hi))
                yield new, _Same(lo), _Same(hi)
            for wide in _wide(block):
                if fresh(wide, lo, hi):
                    any_fresh = True
                    hit |= taken(wide, _Same(lo), _Same(hi))
                    yield wide, _Same(lo), _Same(hi)
        layers += any_fresh and (sure or hit)

    def opened(raw: bytes, sure: bool, lo: int, hi: int, exact) -> None:
        nonlocal unopened
        packed = False
        for at in dict.fromkeys([0, *(m.start() for m in _PACKED.finditer(raw))]):
            source, closed = _open(raw[at:])
            unopened += closed
            if source is not None:
                packed |= at == 0
                work.append(unpacked(source, lo, hi))
        inner, clean = _text(raw)
        push(inner, sure and clean and not packed, exact if exact and len(inner) == len(raw) else lambda: (_Same(lo), _Same(hi)))
        for wide in _wide(raw):
            push(wide, False, lambda: (_Same(lo), _Same(hi)))

    while work:
        item = next(work[-1], None)
        if item is None:
            work.pop()
            continue
        layer, starts, ends = item
        for mark, pattern, decode in (("%", _PERCENT, _percent), ("%", _PERCENT, _percent_any), ("\\", _ESCAPE, _escape), ("%u", _ESCAPE, _escape)):
            if mark in layer and (got := _unescape(layer, pattern, decode)) and got[0]:
                new, a, b = got
                push(new, decode is not _percent_any, lambda: (array("q", (starts[k] for k in a)), array("q", (ends[k - 1] for k in b))))  # noqa: B023
        here = runs if layer is text else list(_RUN.finditer(layer))
        tokens = [(m.start(), m.end()) for m in here]
        if any(b - a >= 40 for a, b in tokens) and "\n" in layer:
            tokens += [m.span() for m in _WRAPPED.finditer(layer)]
        for a, b in tokens:
            token = layer[a:b]
            plain = "\n" not in token
            for skip in range(4):
                raw = _base64(token, skip)
                if len(raw) < 8:
                    continue
                first = a + skip if plain else a
                exact = lambda: (_Quads(starts, first, b - 1, 0), _Quads(ends, first, b - 1, 1))  # noqa: B023, E731
                opened(raw, skip == 0, starts[first], ends[b - 1], exact if plain else None)
    return base, sorted(spans), layers, unopened


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


_FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, n_unopened long"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            rows: list[list] = [[] for _ in range(7)]
            for text in part.column("text"):
                base, spans, layers, unopened = find(text.as_py() or "")
                kinds = [k for _, k, _ in base]
                values = [*(kinds.count(k) for k in range(3)), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), layers, unopened]
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(r, t) for r, t in zip(rows, types, strict=True))], names=[f.split()[0] for f in _FOUND.split(", ")])


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: counts and digest of the base spans, all spans.

    ``spans`` also holds secrets of decoded layers, at the span of the text that encodes them. A
    null or empty text has no spans (empty strings, the digest of an empty string); repeated rows
    and null ids are judged like any other; further columns are ignored; no rows give no rows.
    """
    ship(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(lambda b: released(_judge(b)), _FOUND)


def hide(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with every span, overlapping ones together, replaced by ``mark``."""
    spans = [(a, b) for a, _, b in find(text)[1]] if text else []
    if not spans:
        return text
    out, last, at = [], 0, 0
    for a, b in sorted(spans):
        if a >= last or not out:
            out += [text[at:a], mark]
            at = b
        at = max(at, b)
        last = max(last, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text`` and ``n_chars`` counted anew where text changed.

    Other columns, nulls and texts without secrets stay as they are.
    """
    ship(docs.sparkSession)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                old = part.column("text").to_pylist()
                new = [hide(t) for t in old]
                columns = {n: part.column(n) for n in names}
                columns["text"] = pa.array(new, part.schema.field("text").type)
                if "n_chars" in columns:
                    columns["n_chars"] = pa.array([c if t == u else len(u) for c, t, u in zip(part.column("n_chars").to_pylist(), old, new, strict=True)], part.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), schema=part.schema)

    return docs.mapInArrow(lambda b: released(run(b)), docs.schema)
