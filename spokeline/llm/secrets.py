"""Secrets in texts, also below layers of encoding.

Three fixed formats are searched in the text itself (base spans) and in whatever decoding it yields: a
worklist holds stretches of bytes, each with the place in the text that every byte came from. A stretch is
scanned, and what decoding finds in it goes on the list: lines with percent or Unicode escapes with these
resolved, base64 runs decoded, and compressed data expanded. The list ends when nothing new comes up;
content that the same place has already had, by whatever way, is not followed again, so data that decode
to themselves end too. A secret found in a layer is the span of the text that its bytes came from.
"""

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline.llm.words import bound_batches, slices, utf8

KINDS = ("assign", "access", "hex")
# The given patterns over UTF-8 bytes; all of them are ASCII, and none crosses a line. A match that is
# too short is consumed all the same. Runs of hexadecimal digits are longest runs, so the least length
# can be part of the pattern.
PATTERNS = {
    "assign": re.compile(rb"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]{32,}"),
}
LEAST_VALUE, LEAST_ACCESS = 8, 16
#: Bytes of expanded data that are scanned at once; a piece goes on to the next line feed.
PIECE = 1 << 20
#: Share of bytes that must be printable for decoded base64 to count as text, if it is not UTF-8.
PRINTABLE = 0.9

_PERCENT = re.compile(rb"%([0-9A-Fa-f]{2})")
_UNICODE = re.compile(rb"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
# An escape of the escape itself, many times over: only the last layer is of interest.
_STACKED = {_PERCENT: re.compile(rb"%(?:25){2,}(?=[0-9A-Fa-f]{2})"), _UNICODE: re.compile(rb"\\(?:u005[cC]){2,}|&(?:#38;){2,}")}
_BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{16,}(?:\r?\n[A-Za-z0-9+/_-]{16,})*={0,2}")
_LINE = re.compile(rb"[^\r\n]+")
_TEXT = np.zeros(256, dtype=bool)
_TEXT[[9, 10, 13, *range(0x20, 0x7F)]] = True

Span = tuple[int, int, int]  # start, number of the kind, end


def matches(data: bytes) -> Iterator[Span]:
    """Start, number of the kind and end of the valid matches, kind by kind."""
    for found in PATTERNS["assign"].finditer(data):
        if found.end(1) - found.start(1) >= LEAST_VALUE:
            yield found.start(), 0, found.end()
    for found in PATTERNS["access"].finditer(data):
        if found.end() - found.start() >= LEAST_ACCESS:
            yield found.start(), 1, found.end()
    for found in PATTERNS["hex"].finditer(data):
        yield found.start(), 2, found.end()


@dataclass
class Layer:
    """Bytes, and for each the begin and end of what it came from in the text."""

    data: bytes
    begin: np.ndarray
    end: np.ndarray

    def part(self, start: int, end: int) -> "Layer":
        return Layer(self.data[start:end], self.begin[start:end], self.end[start:end])

    def span(self, start: int, end: int) -> tuple[int, int]:
        return int(self.begin[start:end].min()), int(self.end[start:end].max())

    def content(self) -> tuple[int, int, bytes]:
        """Its place and a digest of what is there."""
        return *self.span(0, len(self.data)), hashlib.blake2b(self.data, digest_size=16).digest()


def _resolved(layer: Layer, pattern: re.Pattern) -> Layer:
    """The layer with every escape of the pattern in place of what it stands for."""
    out, begin, end, at = [], [], [], 0

    def keep(to: int) -> None:
        out.append(layer.data[at:to])
        begin.append(layer.begin[at:to])
        end.append(layer.end[at:to])

    for found in pattern.finditer(layer.data):
        new = _meaning(found)
        if new is None:
            continue
        keep(found.start())
        lo, hi = layer.span(found.start(), found.end())
        out.append(new)
        begin.append(np.full(len(new), lo))
        end.append(np.full(len(new), hi))
        at = found.end()
    keep(len(layer.data))
    return Layer(b"".join(out), np.concatenate(begin), np.concatenate(end))


def _meaning(found: re.Match) -> bytes | None:
    if found.re is _PERCENT:
        return bytes([int(found[1], 16)])
    if found.re is not _UNICODE:  # stacked: one escape is left
        return found[0][:1] + (b"25" if found[0][:1] == b"%" else b"u005c" if found[0][:1] == b"\\" else b"#38;")
    four, braced, two, decimal, hexa = found.groups()
    code = int(decimal) if decimal else int(four or braced or two or hexa, 16)
    return chr(code).encode("utf-8", "surrogatepass") if code < 0x110000 else None


def _escaped_lines(layer: Layer, pattern: re.Pattern) -> Iterator[Layer]:
    """The lines that hold an escape, with all of their escapes resolved."""
    at = 0
    while found := pattern.search(layer.data, at):
        start = layer.data.rfind(b"\n", 0, found.start()) + 1
        end = layer.data.find(b"\n", found.end())
        at = len(layer.data) if end < 0 else end
        line = layer.part(start, at)
        yield _resolved(_resolved(line, _STACKED[pattern]), pattern)


def _base64_runs(layer: Layer) -> Iterator[Layer]:
    """What base64 runs, also over several lines, decode to, if that is text or compressed data."""
    for found in _BASE64.finditer(layer.data):
        whole = list(_decoded(layer.part(*found.span())))
        yield from whole
        if not whole and b"\n" in found[0]:  # runs on lines of their own
            for line in _LINE.finditer(found[0]):
                yield from _decoded(layer.part(found.start() + line.start(), found.start() + line.end()))


def _decoded(run: Layer) -> Iterator[Layer]:
    raw = np.frombuffer(run.data, dtype=np.uint8)
    place = np.flatnonzero((raw != 10) & (raw != 13) & (raw != 61))
    body = raw[place].tobytes().translate(bytes.maketrans(b"-_", b"+/"))
    for skip in range(4):  # what stands before may have run into it
        own = body[skip:]
        own = own[: len(own) - (len(own) % 4 == 1)]
        if len(own) < 16:
            return
        try:
            data = base64.b64decode(own + b"=" * (-len(own) % 4))
        except binascii.Error:
            return
        if _packed(data) or _is_text(data):
            first = np.arange(len(data)) * 8 // 6 + skip
            last = np.minimum((np.arange(len(data)) * 8 + 7) // 6 + skip, len(place) - 1)
            yield Layer(data, run.begin[place[first]], run.end[place[last]])
            return


def _is_text(data: bytes) -> bool:
    raw = np.frombuffer(data, dtype=np.uint8)
    if _TEXT[raw].mean() >= PRINTABLE:
        return True
    if not (_TEXT[raw] | (raw >= 0x80)).all():
        return False
    try:
        data[: len(data) - 3].decode()  # the last character may be cut
    except UnicodeDecodeError as error:
        return error.start >= len(data) - 6
    return True


def _packed(data: bytes):
    """A decompressor for data that begin as compressed data do."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(data) > 6 and data[0] == 0x78 and int.from_bytes(data[:2], "big") % 31 == 0:
        return zlib.decompressobj(15)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\0":
        return lzma.LZMADecompressor()
    return None


def _expanded(layer: Layer) -> Iterator[Layer]:
    """Compressed data expanded, in pieces that end at a line feed; as far as they can be read."""
    tool = _packed(layer.data)
    if tool is None:
        return
    lo, hi = layer.span(0, len(layer.data))
    piece, source = b"", layer.data
    streamed = isinstance(tool, type(zlib.decompressobj()))
    while True:
        try:
            new = tool.decompress(source, PIECE)
        except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError):
            new = b""
        source = tool.unconsumed_tail if streamed else b""
        ended = not new or tool.eof
        piece += new
        cut = len(piece) if ended else piece.rfind(b"\n") + 1 if len(piece) >= PIECE else 0
        if cut:
            yield Layer(piece[:cut], np.broadcast_to(lo, cut), np.broadcast_to(hi, cut))
            piece = piece[cut:]
        if ended:
            return


def hidden_spans(text: bytes, starts: list[tuple[int, int]]) -> set[Span]:
    """Spans (in bytes) of secrets below at least one layer of encoding in the given stretches of text."""
    spans: set[Span] = set()
    work = [Layer(text[a:b], np.arange(a, b), np.arange(a + 1, b + 1)) for a, b in starts]
    seen = {layer.content() for layer in work}
    while work:
        outer = work.pop()
        for decode in (_expanded, _escaped_percent, _escaped_unicode, _base64_runs):
            for layer in decode(outer):
                if not layer.data or (content := layer.content()) in seen:
                    continue
                seen.add(content)
                for start, kind, end in matches(layer.data):
                    lo, hi = layer.span(start, end)
                    spans.add((lo, kind, hi))
                work.append(layer)
    return spans


def _escaped_percent(layer: Layer) -> Iterator[Layer]:
    return _escaped_lines(layer, _PERCENT)


def _escaped_unicode(layer: Layer) -> Iterator[Layer]:
    return _escaped_lines(layer, _UNICODE)


# What decoding can begin with.
_ENCODED = re.compile(rb"%[0-9A-Fa-f]{2}|\\[ux]|&#|[A-Za-z0-9+/_-]{16}")


def _stretches(text: bytes) -> list[tuple[int, int]]:
    """Runs of lines with something to decode; runs of base64 lines stay together."""
    out: list[tuple[int, int]] = []
    at = 0
    while found := _ENCODED.search(text, at):
        start = text.rfind(b"\n", 0, found.start()) + 1
        end = text.find(b"\n", found.end())
        at = len(text) if end < 0 else end
        if out and out[-1][1] + 1 >= start:
            out[-1] = (out[-1][0], at)
        else:
            out.append((start, at))
    return out


def spans_of(text: bytes) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, of a UTF-8 text, counted in code points, in order."""
    base = set(matches(text))
    every = base | hidden_spans(text, _stretches(text))
    if not every:
        return [], []
    lead = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    # A span may begin or end inside a character; it then has the whole of it.
    points = np.concatenate([[0], np.cumsum(lead)])
    start = lambda at: int(points[at + 1]) - 1
    end = lambda at: int(points[at])
    counted = lambda spans: sorted((start(a), kind, end(b)) for a, kind, b in spans)
    return counted(base), sorted(set(counted(every)))


def find_secrets(docs: DataFrame) -> DataFrame:
    """docs with base and spans, arrays of (start, kind, end) by start and the order of KINDS.

    docs: text string; other columns stay, but for base and spans, which are replaced. start and end
    count code points of the text, end exclusive; base has the valid matches of the fixed formats in the
    text itself, spans these and the stretches whose decoded content holds more. A null text becomes
    empty and has none; long texts are searched whole; repeated rows alike; an empty table gives an
    empty one. Expanded data are scanned in pieces, so memory is that of the text and of its longest
    stretch without a line feed."""
    bound_batches(docs.sparkSession)
    docs = docs.drop("base", "spans").withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = utf8(batch.column("text"))
            data = data.tobytes()
            out: tuple[list, list] = ([], [])
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                for column, spans in zip(out, spans_of(data[a:b]), strict=True):
                    column.append([{"start": s, "kind": KINDS[k], "end": e} for s, k, e in spans])
            arrays = [pa.array(x, kind) for x in out]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, "base", "spans"])

    spans = "array<struct<start:bigint,kind:string,end:bigint>>"
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(run, ", ".join([*columns, f"base {spans}", f"spans {spans}"]))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )
