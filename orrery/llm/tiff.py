"""TIFF media columns: writes and reads TIFF bytes, one row per page when read.

Read: II and MM byte order, chains of image directories, strips or tiles, chunky or planar samples of 8, 16 or 32 bits,
no compression, LZW, deflate or PackBits, horizontal predictor. Written: strips of 8-bit samples in one of these codecs.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stored
from .wordpieces import blocks

#: Fixed values of the format: tags, compression codes, bytes per field type, struct codes of the integer types.
WIDTH, HEIGHT, BITS_PER_SAMPLE, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
TYPE_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
TYPE_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i"}
CLEAR, END, FIRST = 256, 257, 258

#: Most bytes that one byte of a codec can stand for (LZW: 4096 entries, each longer by one, of at least 9 bits).
EXPANSION = {NONE: 1, PACKBITS: 64, DEFLATE: 1032, OLD_DEFLATE: 1032, LZW: 4096}
#: Pages of more bytes are not read: one page has to fit in a task.
MOST = 1 << 30

#: Layout of texts: samples in a row, rows in a strip, rows in a page.
ROW, STRIP, PAGE = 64, 256, 1 << 16


def packbits_encode(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        run = i + 1
        while run < n and run - i < 128 and data[run] == data[i]:
            run += 1
        if run - i > 1:
            out += bytes((257 - (run - i), data[i]))
            i = run
            continue
        end = i + 1
        while end < n and end - i < 128 and not (end + 1 < n and data[end] == data[end + 1]):
            end += 1
        out.append(end - i - 1)
        out += data[i:end]
        i = end
    return bytes(out)


def packbits_decode(data: bytes, size: int) -> bytes:
    out, i = bytearray(), 0
    while i < len(data) and len(out) < size:
        head = data[i]
        if head < 128:
            out += data[i + 1 : i + 2 + head]
            i += 2 + head
        else:
            if head > 128:
                out += data[i + 1 : i + 2] * (257 - head)
            i += 1 if head == 128 else 2
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    """Most significant bit first; codes widen one entry early, as the format asks."""
    table, width, bits, held, out = {}, 9, CLEAR, 9, bytearray()
    following, prefix = FIRST, None

    def put(code: int) -> None:
        nonlocal bits, held
        bits, held = bits << width | code, held + width
        while held >= 8:
            held -= 8
            out.append(bits >> held)
            bits &= (1 << held) - 1

    for byte in data:
        if prefix is None:
            prefix = byte
        elif (prefix, byte) in table:
            prefix = table[prefix, byte]
        else:
            put(prefix)
            table[prefix, byte] = following
            following += 1
            if following == 4094:
                put(CLEAR)
                table, following, width = {}, FIRST, 9
            elif following == 1 << width:
                width += 1
            prefix = byte
    if prefix is not None:
        put(prefix)
        following += 1
        width += following == 1 << width and width < 12
    put(END)
    if held:
        out.append(bits << 8 - held & 255)
    return bytes(out)


def lzw_decode(data: bytes, size: int) -> bytes:
    """Stops once `size` bytes are there."""
    single = [bytes((i,)) for i in range(256)] + [b"", b""]
    table, width, bits, held, last, out, made = list(single), 9, 0, 0, b"", [], 0
    for byte in data:
        bits, held = (bits & (1 << held) - 1) << 8 | byte, held + 8
        if held < width:
            continue
        held -= width
        code = bits >> held & (1 << width) - 1
        if code == END:
            break
        if code == CLEAR:
            table, width, last = list(single), 9, b""
            continue
        if code < len(table):
            text = table[code]
        elif last and code == len(table):
            text = last + last[:1]
        else:
            raise ValueError("LZW code out of range")
        if last and len(table) < 4096:
            table.append(last + text[:1])
        out.append(text)
        last, made = text, made + len(text)
        if made >= size:
            break
        if len(table) + 1 >= 1 << width and width < 12:
            width += 1
    return b"".join(out)


def _squeeze(data: bytes, codec: int) -> bytes:
    return {NONE: lambda x: x, LZW: lzw_encode, DEFLATE: lambda x: zlib.compress(x, 4), PACKBITS: packbits_encode}[codec](data)


def _expand(data: bytes, codec: int, size: int) -> bytes:
    if codec == NONE:
        return data
    if codec == LZW:
        return lzw_decode(data, size)
    if codec in (DEFLATE, OLD_DEFLATE):
        return zlib.decompressobj().decompress(data, size)
    if codec == PACKBITS:
        return packbits_decode(data, size)
    raise ValueError(f"compression {codec}")


def write_tiff(pages: list[np.ndarray], codec: int = DEFLATE, predictor: int = 1, strip: int = STRIP) -> bytes:
    """Little-endian TIFF of 8-bit greyscale pages (height x width)."""
    out, link = bytearray(struct.pack("<2sHI", b"II", 42, 0)), 4
    for page in pages:
        height, width = page.shape
        offsets, counts = [], []
        for y in range(0, height, strip):
            rows = page[y : y + strip]
            if predictor == 2:
                rows = np.diff(rows, axis=1, prepend=np.uint8(0))
            data = _squeeze(rows.tobytes(), codec)
            offsets.append(len(out))
            counts.append(len(data))
            out += data
        tables = {}
        for tag, values in ((STRIP_OFFSETS, offsets), (STRIP_COUNTS, counts)):
            tables[tag] = values[0] if len(values) == 1 else len(out)
            out += b"" if len(values) == 1 else np.array(values, "<u4").tobytes()
        out += b"\0" * (len(out) % 2)
        struct.pack_into("<I", out, link, len(out))
        n = len(offsets)
        fields = [(WIDTH, 1, width), (HEIGHT, 1, height), (BITS_PER_SAMPLE, 1, 8), (COMPRESSION, 1, codec), (PHOTOMETRIC, 1, 1), (STRIP_OFFSETS, n, tables[STRIP_OFFSETS]), (SAMPLES, 1, 1), (ROWS_PER_STRIP, 1, strip), (STRIP_COUNTS, n, tables[STRIP_COUNTS]), (PREDICTOR, 1, predictor)]
        out += struct.pack("<H", len(fields)) + b"".join(struct.pack("<HHII", tag, 4, count, value) for tag, count, value in fields)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def directories(data: bytes) -> Iterator[dict[int, tuple[int, ...]]]:
    """Tags of each image directory in the order of the chain; a directory that repeats ends it."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at and at not in seen:
        seen.add(at)
        n, tags = struct.unpack_from(order + "H", data, at)[0], {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
            size, place = TYPE_BYTES.get(kind, 0) * count, at + 10 + 12 * i
            if size > 4:
                place = struct.unpack_from(order + "I", data, place)[0]
            if kind in TYPE_CODES:
                tags[tag] = struct.unpack_from(f"{order}{count}{TYPE_CODES[kind]}", data, place)
        yield tags
        at = struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]


def read_page(data: bytes, tags: dict[int, tuple[int, ...]]) -> np.ndarray:
    """height x width x samples."""
    order = "<" if data[:2] == b"II" else ">"
    one = lambda tag, default=None: tags[tag][0] if tag in tags else default
    width, height, samples, codec = one(WIDTH), one(HEIGHT), one(SAMPLES, 1), one(COMPRESSION, 1)
    bits = set(tags.get(BITS_PER_SAMPLE, (8,)))
    if len(bits) != 1 or not bits <= {8, 16, 32} or not width or not height:
        raise ValueError("samples of this kind are not read")
    kind = np.dtype(f"{order}u{bits.pop() // 8}")
    tiled, planar = TILE_OFFSETS in tags, one(PLANAR, 1) == 2 and samples > 1
    w, h = (one(TILE_WIDTH), one(TILE_HEIGHT)) if tiled else (width, min(one(ROWS_PER_STRIP, height), height))
    offsets, counts = (tags[TILE_OFFSETS], tags[TILE_COUNTS]) if tiled else (tags[STRIP_OFFSETS], tags[STRIP_COUNTS])
    across, down, deep = -(-width // w), -(-height // h), 1 if planar else samples
    if not 0 < samples < 1 << 16 or len(offsets) != len(counts) or len(offsets) < across * down * (samples if planar else 1):
        raise ValueError("strips or tiles are missing")
    # before room is made for them: the samples claimed must be what the strips or tiles can hold
    if height * width * samples * kind.itemsize > min(MOST, EXPANSION.get(codec, 1) * sum(min(c, len(data)) for c in counts)):
        raise ValueError("more samples are claimed than are read or than the strips or tiles can hold")
    page = np.zeros((height, width, samples), kind.newbyteorder("="))
    for i, (at, size) in enumerate(zip(offsets, counts)):
        plane, k = divmod(i, across * down)
        y, x = k // across * h, k % across * w
        rows = h if tiled else min(h, height - y)
        raw = _expand(data[at : at + size], codec, rows * w * deep * kind.itemsize)
        if len(raw) < rows * w * deep * kind.itemsize:
            raise ValueError("a strip or tile is too short")
        block = np.frombuffer(raw, kind, rows * w * deep).reshape(rows, w, deep).astype(kind.newbyteorder("="))
        if one(PREDICTOR, 1) == 2:
            block = np.cumsum(block, axis=1, dtype=block.dtype)
        elif one(PREDICTOR, 1) != 1:
            raise ValueError("predictor of this kind is not read")
        part = block[: height - y, : width - x]
        if planar:
            page[y : y + h, x : x + w, plane] = part[:, :, 0]
        else:
            page[y : y + h, x : x + w] = part
    return page


def read_tiff(data: bytes) -> list[np.ndarray]:
    return [read_page(data, tags) for tags in directories(data)]


_FAULTS = (ValueError, KeyError, TypeError, IndexError, struct.error, zlib.error, ZeroDivisionError, OverflowError, MemoryError)


def pages(media: DataFrame, content: str = "media", with_samples: bool = True) -> DataFrame:
    """One row per page: the other columns of `media`, then page (from 0), width, height, samples, bits, compression,
    predictor, pixels (rows of native-order samples, if asked for), error.

    A null or empty content gives no rows. A page that can't be read gives a row with its number and the reason, beside
    the pages that can; where no further directory can be read, page is -1.
    """
    rest = [c for c in media.columns if c != content]
    own = [("page", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("samples", pa.int32()), ("bits", pa.int32()), ("compression", pa.int32()), ("predictor", pa.int32()), ("pixels", pa.binary()), ("error", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, x in enumerate(b.column(content)):
                rows, data = [], x.as_py()
                try:
                    for n, tags in enumerate(directories(data) if data else ()):
                        try:
                            p = read_page(data, tags)
                            rows.append((n, p.shape[1], p.shape[0], p.shape[2], 8 * p.itemsize, tags.get(COMPRESSION, (1,))[0], tags.get(PREDICTOR, (1,))[0], p.tobytes() if with_samples else None, None))
                        except _FAULTS as e:
                            rows.append((n, *[None] * 7, f"{type(e).__name__}: {e}"[:200]))
                except _FAULTS as e:
                    rows.append((-1, *[None] * 7, f"{type(e).__name__}: {e}"[:200]))
                if rows:
                    again = pa.array([i] * len(rows))
                    yield pa.RecordBatch.from_arrays([*[b.column(c).take(again) for c in rest], *[pa.array(v, t) for v, (_, t) in zip(zip(*rows), own)]], names=[*rest, *[n for n, _ in own]])

    base = media.select(*rest)
    for n, t in own:
        base = base.withColumn(n, F.lit(None).cast({pa.int32(): "int", pa.binary(): "binary", pa.string(): "string"}[t]))
    return arrow_map(media.select(*rest, content), run, base.schema)


def text_to_media(text: bytes, codec: int = DEFLATE) -> bytes:
    """The text padded with bytes 0 to a positive multiple of ROW, as pages of ROW samples a row."""
    payload = text + b"\0" * (-len(text) % ROW or ROW * (not text))
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    return write_tiff([rows[i : i + PAGE] for i in range(0, len(rows), PAGE)], codec, 2)


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): every whole text (null: empty) as a deflated TIFF with predictor."""
    names = [id_col, "n_bytes", "media"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            for block in blocks(b.column(text_col)):
                yield pa.RecordBatch.from_arrays([b.column(id_col).slice(done, len(block)), pa.array([len(t) for t in block], pa.int64()), pa.array([text_to_media(t) for t in block], pa.binary())], names=names)
                done += len(block)

    return arrow_map(docs.select(id_col, text_col), run, docs.select(id_col).withColumn("n_bytes", F.lit(0).cast("long")).withColumn("media", F.lit(b"")).schema)


def media_features(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Reads stored media back: per row payload size and digests, those of the stored form, and a feature string of
    the pages' sizes, the samples' sum and their counts in eight equal ranges."""
    rest = [c for c in media.columns if c != "media"]
    own = [("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x in b.column("media"):
                data = x.as_py()
                read = read_tiff(data)
                payload = b"".join(p.tobytes() for p in read)
                counts = np.bincount(np.frombuffer(payload, np.uint8) >> 5, minlength=8)
                total = int(sum(p.sum(dtype=np.int64) for p in read))
                feature = f"pages={len(read)};size={','.join(f'{p.shape[1]}x{p.shape[0]}' for p in read)};sum={total};counts={','.join(map(str, counts.tolist()))}"
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature))
            columns = list(zip(*rows)) or [()] * len(own)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], *[pa.array(v, t) for v, (_, t) in zip(columns, own)]], names=[*rest, *[n for n, _ in own]])

    base = media.select(*rest)
    for n, t in own:
        base = base.withColumn(n, F.lit(None).cast("long" if t == pa.int64() else "string"))
    return arrow_map(media.select(*rest, "media"), run, base.schema)


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores every text as TIFF in a table of the shared folder, reads it back and describes it. An empty table gives
    an empty result; an empty text is one row of bytes 0; equal texts get equal values."""
    return media_features(stored(store_texts(docs, id_col, text_col), "media"), id_col)
