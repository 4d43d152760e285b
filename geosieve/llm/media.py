"""Media columns: ISO media containers, written losslessly and described without decoding.

The reader walks nested boxes and decodes the sample tables of each track:
time to sample, sample to chunk, sizes, chunk offsets and sync samples, and
those of movie fragments after them. From these it has codec, duration and the
byte ranges and times from each keyframe to the next, without looking at any
payload byte. The writer stores a payload as the samples of one uncompressed
8-bit track: FRAME bytes a sample, CHUNK samples a chunk, each GROUPth sample a
sync sample.

Boxes may have 32-bit, 64-bit or open sizes, time boxes version 0 or 1, sizes
one value, a table or a compact table, offsets 32 or 64 bits; a track without
a sync table has only keyframes. A track's duration is that of its samples, or
where the time table is empty the one its header states. Nesting deeper than
DEEPEST, as no real file has it, tables past their box and sample numbers that
don't exist are errors. What isn't such a container, null included, is
described by an error and null columns. A null or empty text has the
payload of one empty frame. Texts are read whole, equal texts give equal
bytes, and repeated rows equal rows. Other columns pass through, and an input
column with the name of an output column is replaced.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, documents, small_batches, text_or_empty, texts_of

FRAME, CHUNK, GROUP = 64, 256, 16
TIMESCALE, TICKS = 1000, 40
CODEC = b"raw "
#: Fixed values of the format: boxes that hold boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"udta", b"mvex", b"moof", b"traf"}
DEEPEST = 32
_IDENTITY = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def box(kind: bytes, *parts: bytes) -> bytes:
    """A box, with a 64-bit size if it needs one."""
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    """A box with a version and flags."""
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def padded(text: str) -> bytes:
    """The UTF-8 of a text with zero bytes up to a positive multiple of FRAME."""
    data = text.encode("utf-8", "replace")
    return data + bytes(max(FRAME, -(-len(data) // FRAME) * FRAME) - len(data))


def write_container(payload: bytes) -> bytes:
    """A container whose samples are the payload, a multiple of FRAME bytes."""
    n = len(payload) // FRAME
    chunks = -(-n // CHUNK)
    duration = n * TICKS
    head = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2mp41")
    sync = range(1, n + 1, GROUP)
    last = n - (chunks - 1) * CHUNK
    runs = [(1, CHUNK, 1)] * (chunks > 1) + [(chunks, last, 1)] * (last < CHUNK or chunks == 1)
    entry = box(CODEC, bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", 8, 8, 0x480000, 0x480000, 0, 1), bytes(32), struct.pack(">Hh", 8, -1))

    def movie(first: int) -> bytes:
        offsets = [first + i * CHUNK * FRAME for i in range(chunks)]
        table = box(
            b"stbl",
            full(b"stsd", struct.pack(">I", 1), entry),
            full(b"stts", struct.pack(">III", 1, n, TICKS)),
            full(b"stss", struct.pack(f">I{len(sync)}I", len(sync), *sync)),
            full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            full(b"stsz", struct.pack(">II", FRAME, n)),
            full(b"co64", struct.pack(f">I{chunks}Q", chunks, *offsets)),
        )
        data = full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1))
        info = box(b"minf", full(b"vmhd", bytes(8), flags=1), box(b"dinf", data), table)
        media = box(
            b"mdia",
            full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, duration, 0x55C4, 0)),
            full(b"hdlr", bytes(4), b"vide", bytes(12), b"payload\0"),
            info,
        )
        track = full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, duration), bytes(16), _IDENTITY, struct.pack(">II", 8 << 16, 8 << 16), flags=3)
        return box(b"moov", full(b"mvhd", struct.pack(">IIIIIH", 0, 0, TIMESCALE, duration, 0x10000, 0x100), bytes(10), _IDENTITY, bytes(24), struct.pack(">I", 2)), box(b"trak", track, media))

    first = len(head) + len(movie(0)) + (8 if len(payload) + 8 < 1 << 32 else 16)
    return head + movie(first) + box(b"mdat", payload)


def walk(data: bytes) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path, start, end) of the body of each box, outer boxes before those they hold."""
    open_: list[tuple[int, int, tuple[bytes, ...]]] = [(0, len(data), ())]  # what is still to be read at each depth
    while open_:
        start, end, path = open_.pop()
        if start >= end:
            continue
        if end - start < 8:
            raise ValueError("a box is cut short")
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            if end - body < 8:
                raise ValueError("a box is cut short")
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        stop = end if size == 0 else start + size
        if stop < body or stop > end:
            raise ValueError("a box is longer than what holds it")
        yield (*path, kind), body, stop
        open_.append((stop, end, path))
        if kind in CONTAINERS:
            if len(path) >= DEEPEST:
                raise ValueError("boxes are nested too deep")
            open_.append((body, stop, (*path, kind)))


@dataclass
class Track:
    """A track's description and where and when its samples lie."""

    number: int
    handler: str
    codec: str
    timescale: int
    duration: int
    offsets: np.ndarray
    sizes: np.ndarray
    times: np.ndarray  # decode time of each sample, in ticks
    sync: np.ndarray  # sample numbers from 0

    def keyframes(self) -> list[tuple[int, int]]:
        """(start, end) of the bytes from each sync sample to the last before the next."""
        if not len(self.sync):
            return []
        ends = self.offsets + self.sizes
        last = np.append(self.sync[1:], len(self.sizes)) - 1
        return list(zip(self.offsets[self.sync].tolist(), ends[last].tolist()))


def _table(data: bytes, at: int, end: int, kind: str, width: int = 1) -> np.ndarray:
    if at + 8 > end:
        raise ValueError("a table is cut short")
    (n,) = struct.unpack_from(">I", data, at + 4)
    if at + 8 + n * width * np.dtype(kind).itemsize > end:
        raise ValueError("a table is cut short")
    out = np.frombuffer(data, kind, n * width, at + 8).astype(np.int64)
    return out.reshape(n, width) if width > 1 else out


def _sizes(data: bytes, kind: bytes, at: int, end: int) -> np.ndarray:
    if at + 12 > end:
        raise ValueError("a table is cut short")
    if kind == b"stsz":
        one, n = struct.unpack_from(">II", data, at + 4)
        if one:
            if n * one > len(data):
                raise ValueError("samples are longer than the file")
            return np.full(n, one, np.int64)
        bits = 32
    else:
        bits, n = struct.unpack_from(">BI", data, at + 7)
    if bits not in (4, 8, 16, 32):
        raise ValueError("sizes of an unknown width")
    if at + 12 + -(-n * bits // 8) > end:
        raise ValueError("a table is cut short")
    if bits > 8:
        return np.frombuffer(data, f">u{bits // 8}", n, at + 12).astype(np.int64)
    raw = np.frombuffer(data, np.uint8, n if bits == 8 else -(-n // 2), at + 12)
    return (raw if bits == 8 else np.stack([raw >> 4, raw & 15], 1).reshape(-1)[:n]).astype(np.int64)


def _times(data: bytes, boxes: dict[bytes, tuple[int, int]], samples: int) -> tuple[np.ndarray, int]:
    """The samples' decode times and where the last ends; a table for fewer samples repeats its last step."""
    runs = _table(data, *boxes[b"stts"], ">u4", 2) if b"stts" in boxes else np.empty((0, 2), np.int64)
    counts = np.minimum(runs[:, 0], samples)
    steps = np.repeat(runs[:, 1], counts)[:samples] if len(runs) and counts.sum() <= 2 * samples + len(runs) * samples else np.empty(0, np.int64)
    if len(steps) < samples:
        steps = np.append(steps, np.full(samples - len(steps), steps[-1] if len(steps) else 0))
    ends = np.cumsum(steps)
    return ends - steps, int(ends[-1]) if samples else 0


def _track(data: bytes, boxes: dict[bytes, tuple[int, int]], number: int) -> Track:
    at, _ = boxes[b"mdhd"]
    timescale, stated = struct.unpack_from(">IQ", data, at + 20) if data[at] == 1 else struct.unpack_from(">II", data, at + 12)
    at, end = boxes[b"stsd"]
    codec = data[at + 12 : at + 16].decode("latin-1") if end - at >= 16 else ""
    handler = data[boxes[b"hdlr"][0] + 8 : boxes[b"hdlr"][0] + 12].decode("latin-1") if b"hdlr" in boxes else ""
    sizes = next(_sizes(data, k, *boxes[k]) for k in (b"stsz", b"stz2") if k in boxes)
    chunks = _table(data, *boxes[b"co64"], ">u8") if b"co64" in boxes else _table(data, *boxes[b"stco"], ">u4")
    runs = _table(data, *boxes[b"stsc"], ">u4", 3)
    starts = runs[:, 0].tolist()
    each = np.array([runs[bisect_right(starts, c) - 1, 1] for c in range(1, len(chunks) + 1)], np.int64)
    upto = np.cumsum(np.minimum(each, len(sizes)))
    if len(sizes) and (not len(upto) or upto[-1] < len(sizes)):
        raise ValueError("chunks hold fewer samples than there are")
    used = int(np.searchsorted(upto, len(sizes))) + 1
    chunk = np.repeat(np.arange(len(chunks))[:used], np.minimum(each, len(sizes))[:used])[: len(sizes)]
    before = np.cumsum(sizes) - sizes
    first = np.searchsorted(chunk, chunk) if len(chunk) else chunk
    offsets = chunks[chunk] + before - before[first] if len(chunk) else before
    sync = _table(data, *boxes[b"stss"], ">u4") - 1 if b"stss" in boxes else np.arange(len(sizes))
    if len(sync) and (sync.min() < 0 or (np.diff(sync) <= 0).any()):
        raise ValueError("sync samples are not in order")
    times, whole = _times(data, boxes, len(sizes))
    return Track(number, handler, codec, timescale, whole or stated, offsets, sizes, times, sync[sync < len(sizes)])


def _number(data: bytes, boxes: dict[bytes, tuple[int, int]], place: int) -> int:
    """A track's id from its header, or its place where it has none."""
    if b"tkhd" not in boxes:
        return place + 1
    at, _ = boxes[b"tkhd"]
    return struct.unpack_from(">I", data, at + (20 if data[at] == 1 else 12))[0]


def _fragment(data: bytes, moof: int, boxes: list[tuple[bytes, int, int]], defaults: dict[int, tuple[int, int, int]], tracks: dict[int, Track]) -> None:
    """Add the runs of a track fragment: (kind, start, end) of its boxes, offsets counted from its movie fragment."""
    at, end = next((a, e) for k, a, e in boxes if k == b"tfhd")
    flags, number = struct.unpack_from(">II", data, at)
    flags, at = flags & 0xFFFFFF, at + 8
    base = moof
    duration, size, kind = defaults.get(number, (0, 0, 0))
    if flags & 0x1:
        base, at = struct.unpack_from(">Q", data, at)[0], at + 8
    at += 4 * bool(flags & 0x2)
    if flags & 0x8:
        duration, at = struct.unpack_from(">I", data, at)[0], at + 4
    if flags & 0x10:
        size, at = struct.unpack_from(">I", data, at)[0], at + 4
    if flags & 0x20:
        kind, at = struct.unpack_from(">I", data, at)[0], at + 4
    track = tracks[number]
    time = int(track.duration) if len(track.sizes) else 0
    for k, a, _ in boxes:
        if k == b"tfdt":
            (time,) = struct.unpack_from(">Q" if data[a] == 1 else ">I", data, a + 4)
    here = base
    for k, a, e in boxes:
        if k != b"trun":
            continue
        flags, n = struct.unpack_from(">II", data, a)
        flags, a = flags & 0xFFFFFF, a + 8
        if flags & 0x1:
            here, a = base + struct.unpack_from(">i", data, a)[0], a + 4
        first_kind = None
        if flags & 0x4:
            first_kind, a = struct.unpack_from(">I", data, a)[0], a + 4
        columns = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
        if a + 4 * n * len(columns) > e or (not columns and n * max(size, 1) > len(data)):
            raise ValueError("a table is cut short")
        rows = np.frombuffer(data, ">u4", n * len(columns), a).astype(np.int64).reshape(n, len(columns))
        column = lambda bit, other: rows[:, columns.index(bit)] if bit in columns else np.full(n, other, np.int64)  # noqa: B023, E731
        steps, sizes, kinds = column(0x100, duration), column(0x200, size), column(0x400, kind)
        if n and first_kind is not None and 0x400 not in columns:
            kinds[0] = first_kind
        before, begun = len(track.sizes), np.cumsum(steps) - steps
        track.offsets = np.append(track.offsets, here + np.cumsum(sizes) - sizes)
        track.sizes = np.append(track.sizes, sizes)
        track.times = np.append(track.times, time + begun)
        track.sync = np.append(track.sync, before + np.flatnonzero(kinds & 0x10000 == 0))
        here, time = here + int(sizes.sum()), time + int(steps.sum())
    track.duration = time


def read_tracks(data: bytes) -> list[Track]:
    """The tracks of a container, fragments included; an error if it is none."""
    found: list[dict[bytes, tuple[int, int]]] = []
    defaults: dict[int, tuple[int, int, int]] = {}
    fragments: list[tuple[int, list[tuple[bytes, int, int]]]] = []
    moof = 0
    for path, start, end in walk(data):
        if path[-1] == b"trak":
            found.append({})
        elif b"trak" in path:
            found[-1].setdefault(path[-1], (start, end))
        elif path[-1] == b"trex":
            number, _, *rest = struct.unpack_from(">5I", data, start + 4)
            defaults[number] = tuple(rest)
        elif path[-1] == b"moof":
            moof = start - 8
        elif path[-1] == b"traf":
            fragments.append((moof, []))
        elif b"traf" in path:
            fragments[-1][1].append((path[-1], start, end))
    if not found:
        raise ValueError("no track")
    tracks = [_track(data, boxes, _number(data, boxes, i)) for i, boxes in enumerate(found)]
    by_number = {t.number: t for t in tracks}
    for at, boxes in fragments:
        _fragment(data, at, boxes, defaults, by_number)
    return tracks


def read_samples(data: bytes, track: Track) -> bytes:
    """A track's stored bytes in order; neighbouring samples are read at once."""
    ends = track.offsets + track.sizes
    breaks = np.flatnonzero(track.offsets[1:] != ends[:-1]) + 1
    out = []
    for part in np.split(np.arange(len(ends)), breaks):
        if len(part):
            if ends[part[-1]] > len(data):
                raise ValueError("a sample lies outside the file")
            out.append(data[track.offsets[part[0]] : ends[part[-1]]])
    return b"".join(out)


def _seconds(ticks: int, track: Track) -> float | None:
    return ticks / track.timescale if track.timescale else None


def describe(data: bytes) -> dict:
    """Codec, duration in seconds, samples, and keyframe ranges with their times, of each track; the first one's beside, or an error."""
    try:
        tracks = []
        for t in read_tracks(data):
            ranges = [{"start": a, "end": b, "time": _seconds(int(t.times[i]), t)} for (a, b), i in zip(t.keyframes(), t.sync)]
            tracks.append({"track": t.number, "handler": t.handler, "codec": t.codec, "duration": _seconds(t.duration, t), "samples": len(t.sizes), "keyframes": ranges})
        return {k: tracks[0][k] for k in ("codec", "duration", "samples", "keyframes")} | {"tracks": tracks, "error": None}
    except (ValueError, KeyError, IndexError, struct.error, StopIteration, TypeError, OverflowError) as e:
        return dict.fromkeys(("codec", "duration", "samples", "keyframes", "tracks")) | {"error": f"{type(e).__name__}: {e}"}


_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("time", pa.float64())]))
_TRACKS = pa.list_(pa.struct([("track", pa.int64()), ("handler", pa.string()), ("codec", pa.string()), ("duration", pa.float64()), ("samples", pa.int64()), ("keyframes", _RANGES)]))
_DESCRIBED = pa.struct([("codec", pa.string()), ("duration", pa.float64()), ("samples", pa.int64()), ("keyframes", _RANGES), ("tracks", _TRACKS), ("error", pa.string())])
_RANGE_TYPE = "array<struct<start: bigint, end: bigint, time: double>>"
_TRACK_FIELDS = f"codec: string, duration: double, samples: bigint, keyframes: {_RANGE_TYPE}"
DESCRIBED = f"struct<{_TRACK_FIELDS}, tracks: array<struct<track: bigint, handler: string, {_TRACK_FIELDS}>>, error: string>"
BATCH = 256


def store_texts(df: DataFrame, text: str = "text", out: str = "media") -> DataFrame:
    """Add ``out``: the container that holds each text."""

    small_batches(df.sparkSession)

    def one(column: pa.Array) -> pa.Array:
        return pa.array([write_container(padded(t)) for t in texts_of(column)], pa.binary())

    return df.withColumn(out, batched(lambda: one, T.BinaryType(), F.col(text)))


def describe_media(df: DataFrame, media: str = "media", out: str = "media_info") -> DataFrame:
    """Add ``out``: codec, duration, samples and keyframes of each container's first track, all tracks, and error."""
    make = lambda: lambda column: pa.array([describe(x) for x in column.to_pylist()], _DESCRIBED)
    return df.withColumn(out, batched(make, DESCRIBED, F.col(media)))


_DIGEST = [("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
DIGEST = T.StructType([T.StructField(n, T.LongType() if t == pa.int64() else T.StringType()) for n, t in _DIGEST])


def digest(text: str) -> dict:
    """What op6 tells of a text: its container written, read back and described."""
    media = write_container(padded(text))
    track = read_tracks(media)[0]
    payload = read_samples(media, track)
    ranges = ",".join(f"{a}-{b}" for a, b in track.keyframes())
    return {
        "payload_bytes": len(payload),
        "payload_sha256": hashlib.sha256(payload).hexdigest(),
        "tail_crc32": zlib.crc32(payload[-FRAME:]),
        "media_bytes": len(media),
        "media_sha256": hashlib.sha256(media).hexdigest(),
        "feature": f"codec={track.codec.strip()};duration={track.duration}/{track.timescale};samples={len(track.sizes)};keyframes={ranges}",
    }


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a container, read back and described."""

    small_batches(spark)

    def one(column: pa.Array) -> pa.Array:
        parts = (texts_of(column.slice(i, BATCH)) for i in range(0, len(column), BATCH))
        return pa.array([digest(t) for part in parts for t in part], pa.struct(_DIGEST))

    docs = documents(spark, sf_dir).select("doc_id", text_or_empty().alias("text"))
    made = docs.withColumn("m", batched(lambda: one, DIGEST, F.col("text")))
    return made.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), *[F.col(f"m.{n}").alias(n) for n, _ in _DIGEST])
