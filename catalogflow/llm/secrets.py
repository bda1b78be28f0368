"""Secret scans through nested encodings: a worklist of layers, each rescanned and mapped back to the text."""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrays import free_name, with_arrow

KINDS = ("assign", "access", "hex")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones are those to drop
_ESCAPE = re.compile(
    r"(?P<url>(?:%[0-9A-Fa-f]{2})+)|(?P<unit>(?:\\u[0-9A-Fa-f]{4})+)|\\u\{(?P<brace>[0-9A-Fa-f]{1,6})\}|\\U(?P<wide>[0-9A-Fa-f]{8})"
    r"|\\x(?P<byte>[0-9A-Fa-f]{2})|&#(?P<dec>[0-9]{1,7});|&#[xX](?P<ref>[0-9A-Fa-f]{1,6});|(?P<full>[！-～]+)"
)
_RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_LINES = re.compile(r"(?:[A-Za-z0-9+/_-]{60,76}\r?\n)+[A-Za-z0-9+/_-]{2,76}={0,2}")
_IS_HEX = bytes(49 if c in b"0123456789abcdef" else 48 for c in range(256))
_IS_RUN = bytes(49 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-" else 48 for c in range(256))
_STRETCH = re.compile(
    rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})+"
)
_SHORTEST = 16  # bytes of any secret
_HEAD = re.compile(rb"(?=\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|[\x08\x18\x28\x38\x48\x58\x68\x78][\x00-\xff])")
_URL_SAFE = str.maketrans("-_", "+/")
_CHUNK, _OVERLAP = 1 << 24, 1 << 16

SPAN = "struct<kind string, start bigint, `end` bigint, base boolean, path string>"


@dataclass
class Layer:
    """A decoded text; character i came from starts[i]..ends[i] of the original (both None: the original itself).

    All characters of a compressed layer come from one span, held once whatever the layer's length.
    """

    text: str
    starts: np.ndarray | None
    ends: np.ndarray | None
    path: str

    def span(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.starts is None else (int(self.starts[a]), int(self.ends[b - 1]))

    def at(self) -> tuple[np.ndarray, np.ndarray]:
        if self.starts is None:
            n = np.arange(len(self.text) + 1)
            return n[:-1], n[1:]
        return self.starts, self.ends

    def key(self) -> tuple:
        ends = (0, len(self.text)) if self.starts is None else (self.starts[:1].tobytes(), self.ends[-1:].tobytes())
        return hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), *ends


def matches(text: str, data: bytes | None = None) -> list[tuple[int, int, int]]:
    """Kind number, start and end of each secret in one text, leftmost and non-overlapping per kind."""
    data = text.encode("utf-8", "surrogatepass") if data is None else data
    out = []
    low = data.lower()
    if any(w in low for w in _WORDS):
        out += [(0, *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"AKIA" in data:
        out += [(1, *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    if b"1" * 16 in data.translate(_IS_HEX):
        out += [(2, *m.span()) for m in _HEX.finditer(text)]
    return out


def _unescaped(layer: Layer) -> Layer | None:
    """The layer with its URL and Unicode escapes replaced, or None if it has none."""
    text, pieces, starts, ends, last = layer.text, [], [], [], 0
    if not ("%" in text or "\\" in text or "&#" in text or re.search("[！-～]", text)):
        return None
    at, to = layer.at()
    names = set()
    for m in _ESCAPE.finditer(text):
        a, b = m.span()
        kind, raw = m.lastgroup, m[m.lastgroup]
        names.add("url" if kind == "url" else "unicode")
        step = 1
        if kind == "url":
            new, step = bytes.fromhex(raw.replace("%", "")).decode("utf-8", "replace"), 3
        elif kind == "unit":
            new, step = bytes.fromhex(raw.replace("\\u", "")).decode("utf-16-be", "replace"), 6
        elif kind == "full":
            new = "".join(chr(ord(c) - 0xFEE0) for c in raw)
        else:
            code = int(raw, 10 if kind == "dec" else 16)
            new, step = chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�", b - a
        pieces += [text[last:a], new]
        before, last = last, b
        if at.strides == (0,):  # all from one span
            continue
        starts.append(at[before:a])
        ends.append(to[before:a])
        if len(new) * step == b - a:  # one character for each escape
            starts.append(at[a:b:step])
            ends.append(to[a + step - 1 : b : step])
        else:
            starts.append(np.full(len(new), at[a]))
            ends.append(np.full(len(new), to[b - 1]))
    if not names:
        return None
    pieces.append(text[last:])
    whole, path = "".join(pieces), "+".join([*filter(None, [layer.path]), *sorted(names)])
    if at.strides == (0,):
        return Layer(whole, _one_span(at[0], len(whole)), _one_span(to[0], len(whole)), path)
    return Layer(whole, np.concatenate([*starts, at[last:]]), np.concatenate([*ends, to[last:]]), path)


def _one_span(place: int, n: int) -> np.ndarray:
    """One place for n characters, held once."""
    return np.broadcast_to(np.int64(place), n) if n > 1 else np.full(n, place)


def _readable(data: bytes) -> str | None:
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    odd = sum(not (c.isprintable() or c.isspace()) for c in text)
    return text if text and odd <= len(text) // 20 else None


def _stretches(data: bytes) -> Iterator[tuple[int, str]]:
    """The text of some data with the byte where it begins: all of it, or the readable stretches that can hold a secret."""
    whole = _readable(data)
    if whole is not None:
        yield 0, whole
        return
    for m in _STRETCH.finditer(data):
        if m.end() - m.start() >= _SHORTEST:
            yield m.start(), m[0].decode("utf-8")


def _machine(data: bytes):
    """The kind of compression that data begins with and a decompressor, or None."""
    if data[:2] == b"\x1f\x8b":
        return "gzip", zlib.decompressobj(47)
    if len(data) > 2 and data[0] & 15 == 8 and (data[0] << 8 | data[1]) % 31 == 0:
        return "zlib", zlib.decompressobj(47)
    if data[:3] == b"BZh":
        return "bzip2", bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return "xz", lzma.LZMADecompressor()
    return None


def _heads(data: bytes) -> Iterator[int]:
    """Where inside of data compressed data may begin."""
    for m in _HEAD.finditer(data, 1):
        part = data[m.start() : m.start() + 256]
        found = _machine(part)
        if found is not None:
            try:
                found[1].decompress(part)
            except (zlib.error, OSError, EOFError, lzma.LZMAError):
                continue
            yield m.start()


def _inflated(machine, chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of compressed chunks, in pieces of _CHUNK at most; what comes before damage is kept."""
    for rest in chunks:
        while True:
            try:
                out = machine.decompress(rest, _CHUNK)
            except (zlib.error, OSError, EOFError, lzma.LZMAError):
                return
            if out:
                yield out
            if machine.eof:
                return
            rest = getattr(machine, "unconsumed_tail", b"")
            if not out or not (rest or len(out) == _CHUNK):
                break


def _opened(data: bytes) -> Iterator[tuple[str, bytes]]:
    """Data without its layers of compression, in pieces that overlap; a self-containing archive ends the walk.

    A layer of more than one piece is read as a stream by the one below it.
    """
    path, seen, first, more = "", set(), data, iter(())
    while (found := _machine(first)) is not None:
        mark = hashlib.blake2b(first, digest_size=16).digest()
        if mark in seen:
            return
        seen.add(mark)
        path += "+" + found[0]
        pieces = _inflated(found[1], chain([first], more))
        first = next(pieces, None)
        if first is None:
            return
        second = next(pieces, None)
        more = iter(()) if second is None else chain([second], pieces)
    carried = b""
    for piece in chain([first], more):
        yield path, carried + piece
        carried = (carried + piece)[-_OVERLAP:]


def _decoded(layer: Layer, data: bytes) -> Iterator[Layer]:
    """Layers below the base64 runs of a layer."""
    if b"1" * 20 not in data.translate(_IS_RUN):
        return
    text = layer.text
    at = to = None
    for m in [*_RUN.finditer(text), *_LINES.finditer(text)]:
        raw = m[0].translate(_URL_SAFE).rstrip("=")
        raw_bytes, keep = raw.encode("ascii"), None
        raw = raw.replace("\r", "").replace("\n", "")
        for skip in range(4):  # the run may begin with characters that are not part of the encoding
            body = raw[skip:]
            body = body[: len(body) - (len(body) % 4 == 1)]
            if len(body) < 20:
                break
            try:
                plain = base64.b64decode(body + "=" * (-len(body) % 4))
            except (binascii.Error, ValueError):
                continue
            heads = [0] if _machine(plain) is None and _readable(plain) is not None else [0, *_heads(plain)]  # and behind a prefix
            for (path, part), (first, inner) in ((x, y) for h in heads for x in _opened(plain[h:]) if x[0] or not h for y in _stretches(x[1])):
                if at is None:
                    at, to = layer.at()
                name = "+".join(filter(None, [layer.path, "base64" + path]))
                if path or at.strides == (0,):
                    starts, ends = _one_span(at[m.start() + skip], len(inner)), _one_span(to[m.end() - 1], len(inner))
                else:
                    if keep is None:
                        code = np.frombuffer(raw_bytes, np.uint8)
                        keep = np.flatnonzero((code != 10) & (code != 13))
                    where = m.start() + keep[skip : skip + len(body)]
                    sizes = np.array([len(c.encode()) for c in inner])
                    last = first + np.cumsum(sizes)
                    starts = at[where[(last - sizes) * 8 // 6]]
                    ends = to[where[(last * 8 - 1) // 6]]
                yield Layer(inner, starts, ends, name)


def scan_text(text: str) -> list[tuple[str, int, int, bool, str]]:
    """Kind, start, end (code points), whether found in the text as it stands, and the encodings passed through."""
    found: dict[tuple[int, int, int], tuple[bool, str]] = {}
    work: list[Iterator[Layer]] = [iter([Layer(text, None, None, "")])]
    seen = set()
    while work:  # layers are unwrapped one by one, so an archive's pieces are never held together
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        key = layer.key() if layer.path else None
        if key in seen:
            continue
        seen.add(key)
        data = layer.text.encode("utf-8", "surrogatepass")
        for kind, a, b in matches(layer.text, data):
            found.setdefault((kind, *layer.span(a, b)), (not layer.path, layer.path))
        inner = _unescaped(layer)
        work.append(chain([] if inner is None else [inner], _decoded(layer, data)))
    order = sorted(found, key=lambda x: (x[1], x[0], x[2]))
    return [(KINDS[k], a, b, *found[k, a, b]) for k, a, b in order]


def scan(docs: DataFrame, text: str | Column = "text", out: str = "secrets") -> DataFrame:
    """All rows and columns of docs with an array of secrets: kind, start, end, base, path.

    Whole texts are scanned. Layers (URL escapes, Unicode escapes and wide forms, base64 runs, gzip, zlib, bzip2 and xz
    inside base64) are unwrapped until nothing new appears, also where a run goes on before or after the encoded part; a layer met before at the same place is not repeated. Spans
    of inner layers are those of the characters that encode them, for compressed data the whole run. Base spans stay,
    whatever the layers add. Ordered by start, kind as in KINDS, end. Null and empty texts give an empty array; repeated
    rows equal ones; an empty table stays empty; a column named as the result is replaced.
    """

    def fn(texts: pa.Array) -> pa.Array:
        rows = [[dict(zip(("kind", "start", "end", "base", "path"), x, strict=True)) for x in scan_text(t.as_py() or "")] for t in texts]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("path", pa.string())])
        return pa.array(rows, pa.list_(kind))

    name = free_name(docs, "_secrets")
    found = with_arrow(docs, name, [F.col(text) if isinstance(text, str) else text], f"array<{SPAN}>", fn)
    return (found if out == text else found.drop(out)).withColumn(out, F.col(name)).drop(name)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by a mark; overlapping spans become one. Null texts stay null."""

    def fn(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            whole = value.as_py()
            spans = sorted((a, b) for _, a, b, _, _ in scan_text(whole)) if whole else []
            parts, last = [], 0
            for a, b in spans:
                if a >= last:
                    parts += [whole[last:a], mark]
                last = max(last, b)
            out.append("".join([*parts, whole[last:]]) if spans else whole)
        return pa.array(out, pa.string())

    name = free_name(docs, "_redacted")
    return with_arrow(docs, name, [F.col(text)], "string", fn).withColumn(text, F.col(name)).drop(name)
