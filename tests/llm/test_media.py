"""Containers: exact round trips, tables of all kinds, broken files."""

import hashlib
import struct
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from geosieve.llm import media
from geosieve.llm.common import documents


@settings(max_examples=100, deadline=None)
@given(st.one_of(st.text(max_size=300), st.integers(0, 60_000).map(lambda n: "é" * n)))
def test_round_trip(text):
    payload = media.padded(text)
    assert payload.rstrip(b"\0") == text.encode().rstrip(b"\0") and len(payload) % 64 == 0 and payload[: len(text.encode())] == text.encode()
    data = media.write_container(payload)
    (track,) = media.read_tracks(data)
    assert media.read_samples(data, track) == payload
    ranges = track.keyframes()
    assert b"".join(data[a:b] for a, b in ranges) == payload and len(ranges) == -(-len(payload) // 1024)
    assert (track.codec, track.duration, track.timescale) == ("raw ", len(payload) // 64 * 40, 1000)


def foreign(sizes: bytes, offsets: bytes, runs, version=0, sync=None, open_end=False):
    """A container as others write it: two samples groups, other boxes between, the payload first."""
    time = struct.pack(">QQIQHH", 0, 0, 90000, 45000, 0, 0) if version else struct.pack(">IIIIHH", 0, 0, 90000, 45000, 0, 0)
    table = [media.full(b"stsd", struct.pack(">I", 1), media.box(b"avc1", bytes(70))), media.full(b"stts", bytes(4)), media.full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)), sizes, offsets]
    table += [media.full(b"stss", struct.pack(f">I{len(sync)}I", len(sync), *sync))] if sync else []
    mdia = media.box(b"mdia", media.full(b"mdhd", time, version=version), media.full(b"hdlr", bytes(4), b"vide", bytes(13)), media.box(b"minf", media.box(b"stbl", *table)))
    moov = media.box(b"moov", media.box(b"free", b"abc"), media.box(b"trak", mdia))
    return moov[:0] + media.box(b"mdat", bytes(range(100))) + (struct.pack(">I", 0) + moov[4:] if open_end else moov)


def test_foreign_tables():
    runs = [(1, 2, 1), (2, 1, 1)]
    each = media.full(b"stsz", struct.pack(">II4I", 0, 4, 10, 20, 5, 7))
    compact = [media.full(b"stz2", struct.pack(">IB", 0, 0)[:0] + bytes(3) + bytes([b]) + struct.pack(">I", 4) + s) for b, s in ((16, struct.pack(">4H", 10, 20, 5, 7)), (8, bytes([10, 20, 5, 7])))]
    small = media.full(b"stz2", bytes(3) + bytes([4]) + struct.pack(">I", 4) + bytes([0xA9, 0x57]))
    for sizes, want in [(each, [10, 20, 5, 7]), *((c, [10, 20, 5, 7]) for c in compact), (small, [10, 9, 5, 7])]:
        for offsets in (media.full(b"stco", struct.pack(">4I", 3, 8, 60, 80)), media.full(b"co64", struct.pack(">I3Q", 3, 8, 60, 80))):
            for version in (0, 1):
                data = foreign(sizes, offsets, runs, version, [1, 3], open_end=bool(version))
                (t,) = media.read_tracks(data)
                assert t.sizes.tolist() == want and t.offsets.tolist() == [8, 8 + want[0], 60, 80]
                assert (t.codec, t.timescale, t.duration) == ("avc1", 90000, 45000)
                assert t.keyframes() == [(8, 8 + want[0] + want[1]), (60, 87)]
    (t,) = media.read_tracks(foreign(each, media.full(b"stco", struct.pack(">4I", 3, 8, 60, 80)), runs))
    assert len(t.keyframes()) == 4


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_broken_files_are_described(data):
    good = bytearray(media.write_container(media.padded("x" * 200)))
    for _ in range(data.draw(st.integers(0, 3))):
        good[data.draw(st.integers(0, len(good) - 300))] = data.draw(st.integers(0, 255))
    cut = data.draw(st.integers(0, len(good)))
    media.describe(bytes(good[:cut]))


def test_queries_and_odd_rows(spark):
    texts = {r.doc_id: r.text for r in documents(spark, "/root/testdata/sf0.001").collect()}
    for r in media.op6_media_columns(spark, "/root/testdata/sf0.001").collect():
        data = texts[r.doc_id].encode()
        payload = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    odd = spark.createDataFrame([(None, None, "x"), (1, "", "x"), (1, "", "x"), (2, "é" * 90_000, None)], "doc_id long, text string, media_info string")
    got = media.describe_media(media.store_texts(odd)).collect()
    assert sorted(r.media_info.samples for r in got) == [1, 1, 1, 2813] and all(r.media_info.error is None for r in got)
    broken = spark.createDataFrame([(None,), (bytearray(b""),), (bytearray(b"not a container"),)], "media binary")
    assert all(r.media_info.error and r.media_info.codec is None for r in media.describe_media(broken).collect())
    assert media.describe_media(media.store_texts(odd.limit(0))).count() == 0


def test_deep_nesting_is_described():
    deep = b""
    for _ in range(1500):
        deep = media.box(b"moov", deep)
    assert "nested" in media.describe(deep)["error"]


def test_times_of_samples():
    runs = [(1, 2, 1), (2, 1, 1)]
    each = media.full(b"stsz", struct.pack(">II4I", 0, 4, 10, 20, 5, 7))
    data = foreign(each, media.full(b"stco", struct.pack(">4I", 3, 8, 60, 80)), runs, sync=[1, 3])
    for table, times, whole in (((2, 30, 2, 15), [0, 30, 60, 75], 90), ((1, 30), [0, 30, 60, 90], 120), ((0xFFFFFFFF, 2), [0, 2, 4, 6], 8), ((), [0] * 4, 45000)):
        box = media.full(b"stts", struct.pack(f">I{len(table)}I", len(table) // 2, *table))
        (t,) = media.read_tracks(replaced(data, media.full(b"stts", bytes(4)), box))
        assert t.times.tolist() == times and t.duration == whole
        assert [k["time"] for k in media.describe(replaced(data, media.full(b"stts", bytes(4)), box))["keyframes"]] == [0, times[2] / 90000]


def replaced(data, old, new):
    """The container with one box of its sample table put in for another and the sizes of what holds it set."""
    at = data.index(old)
    out = bytearray(data[:at] + new + data[at + len(old) :])
    for kind in (b"moov", b"trak", b"mdia", b"minf", b"stbl"):
        i = out.index(kind) - 4
        struct.pack_into(">I", out, i, struct.unpack_from(">I", out, i)[0] + len(new) - len(old))
    return bytes(out)


def test_wrong_tables_are_errors():
    runs, offsets = [(1, 2, 1), (2, 1, 1)], media.full(b"stco", struct.pack(">4I", 3, 8, 60, 80))
    each = media.full(b"stsz", struct.pack(">II4I", 0, 4, 10, 20, 5, 7))
    assert "order" in media.describe(foreign(each, offsets, runs, sync=[0, 2]))["error"]
    assert "short" in media.describe(foreign(media.full(b"stz2", bytes(3) + bytes([8]) + struct.pack(">I", 400) + bytes(4)), offsets, runs))["error"]


def test_two_tracks_and_fragments():
    first = media.write_container(media.padded("x" * 3000))
    (alone,) = media.read_tracks(first)
    moov_at = first.index(b"moov") - 4
    (moov_size,) = struct.unpack_from(">I", first, moov_at)
    body = first[moov_at + 8 : moov_at + moov_size]
    empty = lambda n: media.box(
        b"trak",
        media.full(b"tkhd", struct.pack(">IIIII", 0, 0, n, 0, 0), bytes(60)),
        media.box(
            b"mdia",
            media.full(b"mdhd", struct.pack(">IIIIHH", 0, 0, 48000, 0, 0, 0)),
            media.full(b"hdlr", bytes(4), b"soun", bytes(13)),
            media.box(b"minf", media.box(b"stbl", media.full(b"stsd", struct.pack(">I", 1), media.box(b"mp4a", bytes(28))), *(media.full(k, bytes(4)) for k in (b"stts", b"stsc", b"stco")), media.full(b"stsz", bytes(8)))),
        ),
    )
    trex = media.box(b"mvex", media.full(b"trex", struct.pack(">5I", 2, 1, 100, 8, 0x10000)))
    start = media.box(b"moov", body, empty(2), trex)
    samples = bytes(range(40))

    def fragment(n_bytes):  # a run of three samples with sizes, the first a keyframe; then one of two with defaults
        head = media.full(b"tfhd", struct.pack(">I", 2), flags=0x020000)
        one = media.full(b"trun", struct.pack(">IiI3I", 3, n_bytes, 0, 4, 6, 10), flags=0x1 | 0x4 | 0x200)
        two = media.full(b"trun", struct.pack(">I", 2))
        return media.box(b"moof", media.full(b"mfhd", struct.pack(">I", 1)), media.box(b"traf", head, media.full(b"tfdt", struct.pack(">I", 500)), one, two))

    moof = fragment(len(fragment(0)) + 8)
    data = first[:moov_at] + start + moof + media.box(b"mdat", samples) + first[moov_at + moov_size :]
    video, sound = media.read_tracks(data)
    assert (video.number, video.codec, len(video.sizes)) == (1, "raw ", len(alone.sizes))
    assert (sound.number, sound.codec, sound.handler, sound.sizes.tolist(), sound.times.tolist(), sound.duration) == (2, "mp4a", "soun", [4, 6, 10, 8, 8], [500, 600, 700, 800, 900], 1000)
    assert sound.sync.tolist() == [0] and media.read_samples(data, sound) == samples[:36]
    told = media.describe(data)
    assert [t["track"] for t in told["tracks"]] == [1, 2] and told["codec"] == "raw " and told["tracks"][1]["keyframes"][0]["time"] == 500 / 48000
