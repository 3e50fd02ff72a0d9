"""GIF columns: LZW code streams to pixels, palettes, disposal and transparency, timed frames with colour histograms.

LZW is undone without a loop over codes. Code widths follow from a code's place since the last clear code, so
all codes between two clears are cut out at once; each code's length and each byte's source are references to
earlier ones, resolved by pointer doubling.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keyed_texts, mapped, written

WIDTH = 64
ROWS = 1024  # of a frame, so larger payloads have several
DELAY_MS = 100
BINS = 4  # of each colour channel
MOST_CODES = 4096
FRAME = "struct<at:int,left:int,top:int,width:int,height:int,delay_ms:int,disposal:int,transparent:int,histogram:array<int>,luma:array<int>>"
GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).tobytes()


def _widths(bits: int) -> np.ndarray:
    """Widths of the codes after a clear code, for pixels of so many bits."""
    after = (1 << bits) + 1 + np.arange(MOST_CODES + 1)
    return np.clip(np.frexp(after.astype(np.float64))[1], bits + 1, 12).astype(np.int64)


def lzw_encode(data: bytes, bits: int = 8) -> bytes:
    clear, end = 1 << bits, (1 << bits) + 1
    codes, marks = [clear], [0]  # marks: where clear codes stand
    if data:
        table: dict[int, int] = {}
        get, add, free = table.get, codes.append, end + 1
        held = data[0]
        for b in memoryview(data)[1:]:
            key = held << 8 | b
            known = get(key)
            if known is not None:
                held = known
                continue
            add(held)
            table[key] = free
            free += 1
            held = b
            if free == MOST_CODES - 1:
                marks.append(len(codes))
                add(clear)
                table.clear()
                free = end + 1
        add(held)
    add_end = np.array([*codes, end], np.int64)
    table_widths = _widths(bits)
    starts = np.array(marks)
    place = np.arange(len(add_end)) - np.repeat(starts, np.diff(np.append(starts, len(add_end))))
    widths = np.where(place > 0, table_widths[np.maximum(place - 1, 0)], 0)
    # a clear code has the width of the code that would follow there
    lasts = np.diff(starts) - 1
    widths[starts] = np.concatenate([[bits + 1], table_widths[lasts]])
    at = np.cumsum(widths) - widths
    size = -(-int(at[-1] + widths[-1]) // 8)
    placed = add_end << (at & 7)
    byte = at >> 3
    out = sum(np.bincount(byte + k, weights=(placed >> 8 * k) & 255, minlength=size + 3) for k in range(3))
    return out[:size].astype(np.uint8).tobytes()


def lzw_decode(data: bytes, bits: int) -> np.ndarray:
    """The pixels of a code stream; what follows a broken code is lost."""
    clear, end = 1 << bits, (1 << bits) + 1
    raw = np.frombuffer(data + b"\0\0\0\0", np.uint8).astype(np.int64)
    total = 8 * len(data)
    table_widths = _widths(bits)
    at, out, n = 0, [], MOST_CODES
    while at < total:
        widths = table_widths if n <= len(table_widths) else np.concatenate([table_widths, np.full(n - len(table_widths), 12)])
        ends = at + np.cumsum(widths)
        ends = ends[: np.searchsorted(ends, total, "right")]
        offsets, widths = ends - widths[: len(ends)], widths[: len(ends)]
        byte = offsets >> 3
        codes = (raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16) >> (offsets & 7) & (1 << widths) - 1
        stops = np.flatnonzero((codes == clear) | (codes == end))
        if not len(stops) and len(ends) == len(table_widths) and n < total:
            n *= 4  # no clear code although the table is full
            table_widths = np.concatenate([table_widths, np.full(n, 12)])
            continue
        m = int(stops[0]) if len(stops) else len(codes)
        out.append(_expand(codes[:m], end))
        if not len(stops) or codes[m] == end:
            break
        at = int(ends[m])
    return np.concatenate(out) if out else np.zeros(0, np.uint8)


def _expand(codes: np.ndarray, end: int) -> np.ndarray:
    n = len(codes)
    if not n:
        return np.zeros(0, np.uint8)
    literal = codes < end
    parent = np.where(literal, np.arange(n), codes - end - 1)
    broken = np.flatnonzero(parent > np.arange(n) - ~literal)
    if len(broken):
        return _expand(codes[: broken[0]], end)
    source = parent
    far = (~literal).astype(np.int64)
    while True:  # lengths: how many references lead to a literal
        nearer = far[parent]
        if not nearer.any():
            break
        far, parent = far + nearer, parent[parent]
    lengths = far + 1
    starts = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    shift = np.where(literal, 0, starts[source] - starts)
    origin = np.arange(total) + np.repeat(shift, lengths)
    while True:
        further = origin[origin]
        if (further == origin).all():
            break
        origin = further
    values = np.zeros(total, np.uint8)
    values[starts[literal]] = codes[literal]
    return values[origin]


def encode_gif(payload: bytes, width: int = WIDTH, rows: int = ROWS, delay_ms: int = DELAY_MS) -> bytes:
    """payload (a multiple of width bytes, at least one row) as grey pixels, in as many frames as needed."""
    size = width * rows
    frames = [payload[i : i + size] for i in range(0, len(payload), size)]
    out = [struct.pack("<6sHHBBB", b"GIF89a", width, max(len(f) // width for f in frames), 0xF7, 0, 0), GREY]
    for frame in frames:
        out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, 1 << 2, delay_ms // 10, 0, 0))
        out.append(struct.pack("<BHHHHBB", 0x2C, 0, 0, width, len(frame) // width, 0, 8))
        codes = lzw_encode(frame)
        out += [bytes([len(codes[i : i + 255])]) + codes[i : i + 255] for i in range(0, len(codes), 255)]
        out.append(b"\0")
    out.append(b";")
    return b"".join(out)


@dataclass
class GifFrame:
    left: int
    top: int
    width: int
    height: int
    delay_ms: int
    disposal: int
    transparent: int  # -1: none
    canvas: np.ndarray  # height x width x RGBA of the whole picture while this frame shows

    def histogram(self, bins: int = BINS) -> list[int]:
        """Opaque pixels of the picture by colour cube: bins**3 counts, red slowest."""
        rgb = self.canvas[self.canvas[..., 3] > 0][:, :3].astype(np.int64) * bins >> 8
        return np.bincount((rgb[:, 0] * bins + rgb[:, 1]) * bins + rgb[:, 2], minlength=bins**3).tolist()

    def luma(self) -> list[int]:
        """Opaque pixels by brightness in 16 steps."""
        rgb = self.canvas[self.canvas[..., 3] > 0][:, :3].astype(np.int64)
        return np.bincount((rgb @ np.array([299, 587, 114]) // 1000) >> 4, minlength=16).tolist()


def decode_gif(data: bytes) -> list[GifFrame]:
    """Raises ValueError for what isn't a GIF; a stream that breaks off gives the frames before."""
    if len(data) < 13 or data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    wide, high, flags = struct.unpack_from("<HHB", data, 6)
    at = 13

    def palette(n: int) -> np.ndarray:
        colours = np.zeros((256, 4), np.uint8)
        raw = np.frombuffer(data[at : at + 3 * n], np.uint8)
        colours[: len(raw) // 3, :3] = raw[: len(raw) // 3 * 3].reshape(-1, 3)
        colours[:, 3] = 255
        return colours

    common = None
    if flags & 0x80:
        common = palette(2 << (flags & 7))
        at += 3 * (2 << (flags & 7))
    frames: list[GifFrame] = []
    canvas = np.zeros((high, wide, 4), np.uint8)
    delay, disposal, transparent = 0, 0, -1

    def blocks() -> bytes:
        nonlocal at
        parts = []
        while at < len(data) and (n := data[at]):
            parts.append(data[at + 1 : at + 1 + n])
            at += 1 + n
        at += 1
        return b"".join(parts)

    while at < len(data) and data[at] != 0x3B:
        kind = data[at]
        at += 1
        if kind == 0x21:
            label = data[at] if at < len(data) else 0
            at += 1
            body = blocks()
            if label == 0xF9 and len(body) >= 4:
                delay, disposal = struct.unpack_from("<H", body, 1)[0] * 10, body[0] >> 2 & 7
                transparent = body[3] if body[0] & 1 else -1
        elif kind == 0x2C and at + 9 < len(data):
            left, top, w, h, own = struct.unpack_from("<HHHHB", data, at)
            at += 9
            colours = common
            if own & 0x80:
                colours = palette(2 << (own & 7))
                at += 3 * (2 << (own & 7))
            bits = data[at] if at < len(data) else 0
            at += 1
            stream = blocks()
            if colours is None or not 2 <= bits <= 8:
                raise ValueError("no palette or a wrong code size")
            pixels = lzw_decode(stream, bits)[: w * h]
            there = np.arange(w * h) < len(pixels)
            pixels = np.concatenate([pixels, np.zeros(w * h - len(pixels), np.uint8)]).reshape(h, w)
            there = there.reshape(h, w)
            if own & 0x40:
                order = np.concatenate([np.arange(a, h, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])
                back = np.empty_like(order)
                back[order] = np.arange(h)
                pixels, there = pixels[back], there[back]
            shown, before = canvas.copy(), canvas
            part = shown[top : top + h, left : left + w]
            inside = there[: part.shape[0], : part.shape[1]]
            index = pixels[: part.shape[0], : part.shape[1]]
            drawn = inside & (index != transparent) if transparent >= 0 else inside
            part[drawn] = colours[index[drawn]]
            frames.append(GifFrame(left, top, w, h, delay, disposal, transparent, shown))
            canvas = shown
            if disposal == 2:  # the frame's place is cleared
                canvas = shown.copy()
                canvas[top : top + h, left : left + w] = 0
            elif disposal == 3:  # the picture before the frame comes back
                canvas = before
            delay, disposal, transparent = 0, 0, -1
        elif kind != 0:
            break
    return frames


def _told(frames: list[GifFrame]) -> list[dict]:
    return [{"at": i, "left": f.left, "top": f.top, "width": f.width, "height": f.height, "delay_ms": f.delay_ms, "disposal": f.disposal, "transparent": f.transparent, "histogram": f.histogram(), "luma": f.luma()} for i, f in enumerate(frames)]


def gif_columns(media: DataFrame, data_col: str = "media") -> DataFrame:
    """media with frames (array of timed frames with histograms) and error.

    A null gets null frames and no error; what isn't a GIF, or broken before its first frame, null frames and an error text;
    no row is dropped, other columns stay as they are. The new columns replace any called frames or error.
    """

    @F.pandas_udf(f"struct<frames:array<{FRAME}>,error:string>")
    def decode(data: pd.Series) -> pd.DataFrame:
        rows = []
        for x in data:
            try:
                rows.append((None, None) if x is None else (_told(decode_gif(bytes(x))), None))
            except (ValueError, IndexError, struct.error) as e:
                rows.append((None, str(e) or type(e).__name__))
        return pd.DataFrame(rows, columns=["frames", "error"])

    return media.withColumn("_gif", decode(F.col(data_col))).withColumn("frames", F.col("_gif.frames")).withColumn("error", F.col("_gif.error")).drop("_gif")


def texts_as_gifs(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media of every text: its UTF-8 bytes, zeros up to a positive multiple of 64, as grey pixels."""

    def encode(parts):
        for pdf in parts:
            raw = [t.encode() for t in pdf["text"]]
            media = [encode_gif(r + bytes(-len(r) % WIDTH if r else WIDTH)) for r in raw]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": [len(r) for r in raw], "media": media})

    return mapped(keyed_texts(docs), encode, "doc_id long, n_bytes long, media binary")


def payload_of(frames: list[GifFrame]) -> bytes:
    """The bytes that encode_gif() stored: the red channel of each frame's own rows."""
    return b"".join(f.canvas[f.top : f.top + f.height, f.left : f.left + f.width, 0].tobytes() for f in frames)


def feature_of(frames: list[GifFrame]) -> str:
    """Frames, size, time, then the pixels of all frames by brightness."""
    luma = np.sum([f.luma() for f in frames], axis=0) if frames else []
    return f"{len(frames)}x{frames[0].canvas.shape[1] if frames else 0}x{frames[0].canvas.shape[0] if frames else 0}@{sum(f.delay_ms for f in frames)}:" + ",".join(map(str, luma))


def op6_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    """texts_as_gifs() of all documents, written, read back and decoded. A null or empty text is a payload of 64 zeros; rows without doc_id and repeated rows each have
    a row; equal texts have equal values; an empty table gives an empty result; other columns, whatever their names, are not read."""
    stored = written(texts_as_gifs(documents(spark, sf_dir)), "media")

    def read(parts):
        for pdf in parts:
            rows = []
            for doc_id, n, media in pdf.itertuples(index=False):
                frames = decode_gif(media)
                payload = payload_of(frames)
                rows.append((doc_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(frames)))
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    names = [x.split()[0] for x in schema.split(", ")]
    return mapped(stored, read, schema)
