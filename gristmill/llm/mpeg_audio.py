"""Media columns: MPEG audio streams that hold texts, and a reader of such streams.

The writer lays a payload into the ancillary bytes of MPEG-1 Layer III frames (48 kHz, mono, silent
granules) behind an ID3v2 tag and a frame with a variable-bitrate table; every frame has a checksum. The
reader takes layers I to III of MPEG-1, 2 and 2.5. It finds frame headers again after any other bytes, parses
ID3v2.2 to 2.4 tags and Xing, Info and VBRI tables with their seek points, verifies the checksums of all
layers, and gives exact durations, also where rates differ, and the offset of each frame.

Defined cases: null and empty texts are 64 zero bytes; bytes without any frame read as no frames and an
empty payload; frames with a bad checksum are counted and last as long, but their data is left out; empty
tables give no rows; equal texts give equal streams, whatever the other columns, which aren't read; a very
long text is one long stream, written and read in one go; repeated rows get equal results.
"""

from __future__ import annotations

import binascii
import hashlib
import struct
from collections.abc import Callable
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure, map_batches, table

#: Fixed values of the format: kbit/s by index (1 up) for MPEG-1 layers I, II, III, then MPEG-2 layer I, then MPEG-2 layers II and III.
BITRATES = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
HEAD, CRC, SIDE_MONO = 4, 2, 17
UNIT = 64  # the payload is filled with zero bytes to a multiple of it
RATE, SAMPLES = 48000, 1152  # of the frames that are written


class Memo(dict):
    """Results of a function of bytes by argument, forgotten when there are too many."""

    def __init__(self, of: Callable, most: int = 4096):
        super().__init__()
        self.of, self.most = of, most

    def __missing__(self, key: bytes):
        if len(self) >= self.most:
            self.clear()
        self[key] = out = self.of(key)
        return out


def parse_header(head: bytes) -> tuple[int, int, int, int, bool] | None:
    """(frame bytes, samples, rate, side information bytes or -1, has a checksum) of four bytes, None if they are no header."""
    if len(head) < 4 or head[0] != 0xFF or head[1] & 0xE0 != 0xE0:
        return None
    version, layer = head[1] >> 3 & 3, 4 - (head[1] >> 1 & 3)
    index, rate_index, padding, mono = head[2] >> 4, head[2] >> 2 & 3, head[2] >> 1 & 1, head[3] >> 6 == 3
    if version == 1 or layer == 4 or index in (0, 15) or rate_index == 3:
        return None
    kbps, rate = BITRATES[1 if version == 3 else 2, layer][index - 1], RATES[version][rate_index]
    samples = 384 if layer == 1 else 1152 if layer == 2 or version == 3 else 576
    size = (12 * kbps * 1000 // rate + padding) * 4 if layer == 1 else samples // 8 * kbps * 1000 // rate + padding
    side = -1 if layer != 3 else (17 if mono else 32) if version == 3 else (9 if mono else 17)
    return size, samples, rate, side, not head[1] & 1


#: Fixed values of the format: bits of the allocation of each subband in Layer II, by table.
ALLOCATION = {"a": [4] * 11 + [3] * 12 + [2] * 4, "b": [4] * 11 + [3] * 12 + [2] * 7, "c": [4] * 2 + [3] * 6, "d": [4] * 2 + [3] * 10, "low": [4] * 4 + [3] * 7 + [2] * 19}


def allocation_table(head: bytes, kbps: int, rate: int, channels: int) -> list[int]:
    """The bits of each subband's allocation in a Layer II frame."""
    if head[1] >> 3 & 3 != 3:
        return ALLOCATION["low"]
    each = kbps // channels
    if each <= 48:
        return ALLOCATION["d" if rate == 32000 else "c"]
    return ALLOCATION["a" if rate == 48000 or each <= 80 else "b"]


def checked_bits(frame: bytes) -> int:
    """How many bits behind its checksum a frame's checksum covers: side information in Layer III, allocation in Layers I and II, and there the choice of scale factors too; -1 if the frame is too short."""
    size, _, rate, side, _ = parse_header(frame[:HEAD])
    if side >= 0:
        return 8 * side
    mode, layer = frame[3] >> 6, 4 - (frame[1] >> 1 & 3)
    channels = 1 if mode == 3 else 2
    bits = BITRATES[1 if frame[1] >> 3 & 3 == 3 else 2, layer][(frame[2] >> 4) - 1]
    table_ = [4] * 32 if layer == 1 else allocation_table(frame, bits, rate, channels)
    bound = 4 * (1 + (frame[3] >> 4 & 3)) if mode == 1 else len(table_)  # from here on both channels share in joint stereo
    body, at, used = frame[HEAD + CRC :], 0, 0
    whole = int.from_bytes(body[:64].ljust(64, b"\0"), "big")
    for band, n in enumerate(table_):
        for _ in range(channels if band < bound else 1):
            if whole >> (512 - at - n) & ((1 << n) - 1):
                used += channels if band >= bound else 1
            at += n
    at += 2 * used if layer == 2 else 0
    return at if at <= 8 * len(body) else -1


def frame_checksum(head: bytes, body: bytes, bits: int) -> int:
    """The checksum over a header's last two bytes and the first `bits` of what follows the checksum."""
    crc, whole = crc16(head[2:4] + body[: bits // 8]), body[bits // 8 : bits // 8 + 1]
    for i in range(bits % 8):
        bit = whole[0] >> (7 - i) & 1
        crc = (crc << 1 ^ 0x8005) & 0xFFFF if (crc >> 15) ^ bit else crc << 1 & 0xFFFF
    return crc


def crc16(data: bytes) -> int:
    """The frame checksum: polynomial 0x8005, from 0xFFFF on."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005) & 0xFFFF if crc & 0x8000 else crc << 1 & 0xFFFF
    return crc


def frame_start(index: int) -> tuple[bytes, int]:
    """Header, checksum and empty side information of a mono frame with bitrate `index`; the bytes that are left for data."""
    head = bytes((0xFF, 0xFA, index << 4 | 1 << 2, 0xC4))
    side = bytes(SIDE_MONO)
    start = head + struct.pack(">H", crc16(head[2:] + side)) + side
    return start, parse_header(head)[0] - len(start)


FRAME_START = {i: frame_start(i) for i in range(1, 15)}
ROOM = {i: room for i, (_, room) in FRAME_START.items()}


def padded(text: str | None) -> bytes:
    data = (text or "").encode()
    return data + bytes(-len(data) % UNIT or (0 if data else UNIT))


def syncsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def write_stream(payload: bytes, n_bytes: int) -> bytes:
    """The stream: tag, table frame, full frames of the highest bitrate, one smaller frame for what is left."""
    notes = b"".join(b"TXXX" + syncsafe(len(t)) + b"\0\0" + t for t in (b"\x03payload_bytes\0%d" % len(payload), b"\x03text_bytes\0%d" % n_bytes))
    tag = b"ID3\x04\0\0" + syncsafe(len(notes)) + notes
    start, room = FRAME_START[14]
    frames = [start + payload[i : i + room] for i in range(0, len(payload) - room + 1, room)]
    if rest := payload[len(frames) * room :]:
        index = min(i for i in ROOM if ROOM[i] >= len(rest))
        frames.append(FRAME_START[index][0] + rest + bytes(ROOM[index] - len(rest)))
    first, first_room = FRAME_START[9]
    total = len(first) + first_room + sum(map(len, frames))
    offsets = [len(first) + first_room]
    for f in frames:
        offsets.append(offsets[-1] + len(f))
    toc = bytes(min(255, offsets[i * len(frames) // 100] * 256 // total) for i in range(100))
    table_ = b"Xing" + struct.pack(">III", 7, len(frames), total) + toc
    return tag + first + table_ + bytes(first_room - len(table_)) + b"".join(frames)


def read_tag(data: bytes) -> tuple[int, dict[str, str]]:
    """The length of the ID3v2 tag that `data` begins with, 0 if there is none, and its user-defined text frames."""
    if data[:3] != b"ID3" or len(data) < 10 or data[3] == 0xFF:
        return 0, {}
    version, flags = data[3], data[5]
    safe = lambda b: int.from_bytes(b, "big") if any(x & 0x80 for x in b) else b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]
    plain = lambda b: int.from_bytes(b, "big")
    size = safe(data[6:10])
    body, tags = data[10 : 10 + size], {}
    if flags & 0x80 and version < 4:
        body = body.replace(b"\xff\0", b"\xff")
    at = 0
    if flags & 0x40 and version >= 3 and len(body) >= 4:  # an extended header: 2.3 doesn't count its own four bytes
        at = plain(body[:4]) + 4 if version == 3 else safe(body[:4])
    id_bytes, head, own = (3, 6, b"TXX") if version == 2 else (4, 10, b"TXXX")
    while at + head <= len(body) and body[at : at + id_bytes].isalnum():
        n = plain(body[at + 3 : at + 6]) if version == 2 else (safe if version == 4 else plain)(body[at + 4 : at + 8])
        if body[at : at + id_bytes] == own and n:
            text = body[at + head : at + head + n]
            coding = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(text[0], "latin-1")
            parts = text[1:].decode(coding, "replace").split("\0", 1)
            tags[parts[0]] = parts[1].rstrip("\0").lstrip("\ufeff") if len(parts) > 1 else ""
        at += head + n
    return 10 + size + (10 if flags & 0x10 and version == 4 else 0), tags


def read_table(frame: bytes, body: int) -> dict | None:
    """Frames, bytes and seek points (byte offsets from the table's frame) of a frame that holds a Xing, Info or VBRI table; None if it holds none."""
    if frame[body : body + 4] in (b"Xing", b"Info") and len(frame) >= body + 8:
        flags, at = struct.unpack(">I", frame[body + 4 : body + 8])[0], body + 8
        out = {"frames": None, "bytes": None, "seek": []}
        for bit, key in ((1, "frames"), (2, "bytes")):
            if flags & bit and at + 4 <= len(frame):
                out[key], at = struct.unpack(">I", frame[at : at + 4])[0], at + 4
        if flags & 4 and at + 100 <= len(frame) and out["bytes"] is not None:
            out["seek"] = [x * out["bytes"] // 256 for x in frame[at : at + 100]]
        return out
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        n_bytes, n_frames, entries, scale, width = struct.unpack(">IIHHH", frame[46:60])
        seek, here = [], 0
        for i in range(min(entries, (len(frame) - 62) // width) if width else 0):
            here += int.from_bytes(frame[62 + i * width : 62 + (i + 1) * width], "big") * scale
            seek.append(here)
        return {"frames": n_frames, "bytes": n_bytes, "seek": seek}
    return None


def read_stream(data: bytes, headers: Memo | None = None, sums: Memo | None = None) -> dict:
    """What a stream holds: tags, the table, payload, samples by rate, seconds, good frames' offsets, bad checksums and skipped bytes. Memos may be shared by calls."""
    headers, sums = headers if headers is not None else Memo(parse_header), sums if sums is not None else Memo(crc16)
    out = {"table_frames": None, "table_bytes": None, "table_seek": [], "samples": 0, "rate": None, "rates": {}, "offsets": [], "crc_bad": 0, "skipped": 0, "lost": 0}
    at, out["tags"] = read_tag(data)
    bodies = []
    end = len(data) - 128 if data[-128:-125] == b"TAG" else len(data)
    locked, first = None, True
    while at + HEAD <= end:
        head = headers[data[at : at + HEAD]]
        if locked and head is not None and at + head[0] > end and (data[at + 1] & 0x1E, data[at + 2] & 0x0C) == locked:
            after = at + head[0]  # a frame of the stream spans the place, so that what looks like a tag is its payload
            if after == len(data) or headers[data[after : after + HEAD]] is not None and (data[after + 1] & 0x1E, data[after + 2] & 0x0C) == locked:
                end = len(data)
        good = head is not None and at + head[0] <= end
        if good:  # version, layer and rate hold for a stream; where another may begin, a header is believed if one of its kind, or the end, follows it
            kind, after = (data[at + 1] & 0x1E, data[at + 2] & 0x0C), at + head[0]
            good = kind == locked or after == end or after + HEAD <= end and headers[data[after : after + HEAD]] is not None and (data[after + 1] & 0x1E, data[after + 2] & 0x0C) == kind
        if not good:
            found = data.find(b"\xff", at + 1, end)
            out["lost"] += locked is not None
            out["skipped"] += (found if found >= 0 else end) - at
            at, locked = (found if found >= 0 else end), None
            continue
        size, samples, rate, side, checked = head
        locked = kind
        body = at + HEAD + (CRC if checked else 0)
        sound = True
        if checked and side >= 0:
            sound = sums[data[at + 2 : at + 4] + data[body : body + side]] == data[at + 4] << 8 | data[at + 5]
        elif checked:
            frame = data[at : at + size]
            bits = checked_bits(frame)
            sound = bits >= 0 and frame_checksum(frame[:HEAD], frame[HEAD + CRC :], bits) == frame[4] << 8 | frame[5]
        body += max(side, 0)
        table_ = read_table(data[at : at + size], body - at) if first and sound and side >= 0 else None
        first = False
        if table_:
            out["table_frames"], out["table_bytes"], out["table_seek"] = table_["frames"], table_["bytes"], table_["seek"]
        else:
            out["rates"][rate] = out["rates"].get(rate, 0) + samples
            if sound:
                out["offsets"].append(at)
                bodies.append(data[body : at + size])
            else:
                out["crc_bad"] += 1
        at += size
    out["skipped"] += max(0, end - at)
    out["samples"] = sum(out["rates"].values())
    out["rate"] = max(out["rates"], key=out["rates"].get, default=None)
    out["seconds"] = float(sum(Fraction(n, rate) for rate, n in out["rates"].items()))
    n = out["tags"].get("payload_bytes", "")
    out["payload"] = b"".join(bodies)[: int(n) if n.isdigit() else None]
    return out


def encode_media(docs: DataFrame) -> DataFrame:
    """Of (doc_id, text): (doc_id, n_bytes, media) with each whole text as an MPEG audio stream."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, media = [], []
            for text in batch.column("text").to_pylist():
                n = len((text or "").encode())
                sizes.append(n)
                media.append(write_stream(padded(text), n))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

        return step

    return map_batches(ensure(docs, doc_id="long", text="string"), "doc_id long, n_bytes long, media binary", make)


READ = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, frames long, samples long, rate int, duration_s double, vbr_frames long, crc_bad int, skipped_bytes long, seek_offsets array<long>, table_seek array<long>"


def read_media(rows: DataFrame, media: str = "media") -> DataFrame:
    """`rows` without the media column, and with what its streams hold."""
    kept = [f for f in rows.schema.fields if f.name != media]

    def make():
        headers, sums = Memo(parse_header), Memo(crc16)

        def one(data: bytes | None) -> tuple:
            data = data or b""
            s = read_stream(data, headers, sums)
            p = s["payload"]
            return (len(p), hashlib.sha256(p).hexdigest(), binascii.crc32(p[-UNIT:]), len(data), hashlib.sha256(data).hexdigest(), len(s["offsets"]), s["samples"], s["rate"], s["seconds"], s["table_frames"], s["crc_bad"], s["skipped"], s["offsets"], s["table_seek"])

        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            cols = list(zip(*(one(x.as_py()) for x in batch.column(media)), strict=True))
            return pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[*(f.name for f in kept), *(x.split()[0] for x in READ.split(", "))])

        return step

    return map_batches(rows, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), READ]), make)


def op4_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text stored as MPEG audio and read back."""
    out = read_media(encode_media(table(spark, sf_dir, "documents")))
    seek = F.sha2(F.concat_ws(",", F.col("seek_offsets").cast("array<string>")), 256)
    feature = F.concat(F.lit("frames="), "frames", F.lit(";samples="), "samples", F.lit(";rate="), F.coalesce("rate", F.lit(0)), F.lit(";vbr_frames="), F.coalesce("vbr_frames", F.lit(-1)), F.lit(";crc_bad="), "crc_bad", F.lit(";seek="), F.left(seek, F.lit(16)))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))
