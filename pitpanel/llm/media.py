"""Media columns as Matroska: bytes are stored as 8-bit audio samples and read back.

``encode`` writes each payload into a Matroska file held in a binary column; ``index``
parses such a column into a table of packets for each file, with track, timestamp, lacing,
byte range and cue; ``packets`` lays these tables out as one, a row per frame; ``features``
reads the stored samples back by the ranges of the table. The reader knows elements of any
size length, unknown sizes, simple blocks and block groups, and all lacing kinds.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Payloads are padded with bytes 0 to a positive multiple of this.
UNIT = 64
#: Samples a second; samples in a frame; frames in a block; blocks in a cluster.
RATE, FRAME, LACED, BLOCKS = 8_000, 1_024, 8, 8

# Element identifiers of the Matroska format.
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, FLAG_LACING, CODEC_ID = 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86
AUDIO, SAMPLING, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
SCALE, DURATION, MUXING_APP, WRITING_APP = 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0xE7, 0xA3, 0xA0, 0xA1
CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
DOC_TYPE, DOC_VERSION, DOC_READ_VERSION, MAX_ID, MAX_SIZE = 0x4282, 0x4287, 0x4285, 0x42F2, 0x42F3
SEEK_HEAD, CHAPTERS, TAGS, ATTACHMENTS = 0x114D9B74, 0x1043A770, 0x1254C367, 0x1941A469
#: What ends an element of unknown size, by the element.
ENDS = {SEGMENT: {EBML, SEGMENT}, CLUSTER: {EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES, SEEK_HEAD, CHAPTERS, TAGS, ATTACHMENTS}}
LACINGS = ("none", "xiph", "fixed", "ebml")


def vint(n: int, length: int = 0) -> bytes:
    """A size: as short as holds it, all ones being kept for unknown, or ``length`` bytes."""
    length = length or next(k for k in range(1, 9) if n < (1 << 7 * k) - 1)
    return (n | 1 << 7 * length).to_bytes(length, "big")


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def uint(ident: int, n: int) -> bytes:
    return element(ident, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def block(track: int, relative: int, frames: list[bytes]) -> bytes:
    """A simple block: fixed lacing for frames of one size, EBML lacing otherwise."""
    sizes = [len(f) for f in frames]
    head = vint(track) + struct.pack(">h", relative)
    if len(frames) == 1:
        return element(SIMPLE_BLOCK, head + b"\x80" + frames[0])
    if len(set(sizes)) == 1:
        return element(SIMPLE_BLOCK, head + b"\x84" + bytes([len(frames) - 1]) + b"".join(frames))
    deltas = b"".join(signed_vint(b - a) for a, b in zip(sizes[:-2], sizes[1:-1]))
    return element(SIMPLE_BLOCK, head + b"\x86" + bytes([len(frames) - 1]) + vint(sizes[0]) + deltas + b"".join(frames))


def signed_vint(n: int) -> bytes:
    length = next(k for k in range(1, 9) if abs(n) < (1 << 7 * k - 1) - 1)
    return vint(n + (1 << 7 * length - 1) - 1, length)


def write(payload: bytes) -> bytes:
    """A Matroska file with ``payload`` as one track of 8-bit mono samples."""
    millis = lambda at: at * 1000 // RATE
    head = element(EBML, uint(MAX_ID, 4) + uint(MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + uint(DOC_VERSION, 4) + uint(DOC_READ_VERSION, 2))
    app = b"pitpanel"
    info = element(INFO, uint(SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(payload) * 1000 / RATE)) + element(MUXING_APP, app) + element(WRITING_APP, app))
    audio = element(AUDIO, element(SAMPLING, struct.pack(">d", RATE)) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8))
    tracks = element(TRACKS, element(TRACK_ENTRY, uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + uint(FLAG_LACING, 1) + element(CODEC_ID, b"A_PCM/INT/LIT") + audio))
    parts, at, cues = [info, tracks], len(info) + len(tracks), b""
    step = FRAME * LACED
    for first in range(0, len(payload), step * BLOCKS):
        body = uint(TIMESTAMP, millis(first))
        for begin in range(first, min(first + step * BLOCKS, len(payload)), step):
            end = min(begin + step, len(payload))
            body += block(1, millis(begin) - millis(first), [payload[i : min(i + FRAME, end)] for i in range(begin, end, FRAME)])
        cues += element(CUE_POINT, uint(CUE_TIME, millis(first)) + element(CUE_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER, at)))
        parts.append(element(CLUSTER, body))
        at += len(parts[-1])
    parts.append(element(CUES, cues))
    return head + element(SEGMENT, b"".join(parts))


@dataclass
class Parsed:
    tracks: dict[int, dict] = field(default_factory=dict)
    packets: list[tuple] = field(default_factory=list)  # track, timestamp in ns, keyframe, lacing, offset, size, cue in ns
    cues: list[tuple] = field(default_factory=list)  # time in ns, track, offset of the cluster in the file
    clusters: list[int] = field(default_factory=list)  # offset in the file
    duration: float = 0.0
    scale: int = 1_000_000


def read_id(data: bytes, at: int) -> tuple[int, int]:
    length = 9 - data[at].bit_length()
    if length > 4:
        raise ValueError(f"no element at byte {at}")
    return int.from_bytes(data[at : at + length], "big"), at + length


def read_size(data: bytes, at: int) -> tuple[int | None, int]:
    length = 9 - data[at].bit_length()
    if length > 8:
        raise ValueError(f"no size at byte {at}")
    n = int.from_bytes(data[at : at + length], "big") & (1 << 7 * length) - 1
    return (None if n == (1 << 7 * length) - 1 else n), at + length


def children(data: bytes, at: int, end: int, inside: int = 0) -> Iterator[tuple[int, int, int]]:
    """(identifier, begin, end) of the elements in a range. An element of unknown size
    ends where its parent does; a cluster of unknown size at the next top-level element, a
    segment at the next file."""
    while at < end:
        ident, body = read_id(data, at)
        if ident in ENDS.get(inside, ()):
            return
        size, body = read_size(data, body)
        stop = end if size is None else body + size
        if size is None and ident in ENDS:
            stop = max([body, *(b for _, _, b in children(data, body, end, ident))])
        if stop > end:
            raise ValueError(f"element at byte {at} is cut off")
        yield ident, body, stop
        at = stop


def number(data: bytes, begin: int, end: int) -> int:
    return int.from_bytes(data[begin:end], "big")


def real(data: bytes, begin: int, end: int) -> float:
    return struct.unpack(">f" if end - begin == 4 else ">d", data[begin:end])[0] if end > begin else 0.0


def read_block(data: bytes, begin: int, end: int, base: int, scale: int, simple: bool, tracks: dict[int, dict]) -> list[tuple]:
    """The frames of one block. A laced frame's time is the block's plus the samples of
    the frames before it, where the track tells how many bytes a second has."""
    track, at = read_size(data, begin)
    relative, flags = struct.unpack(">hB", data[at : at + 3])
    at, lacing = at + 3, flags >> 1 & 3
    if not lacing:
        sizes = [end - at]
    else:
        count, at = data[at] + 1, at + 1
        sizes = []
        if lacing == 2:
            if (end - at) % count:
                raise ValueError(f"lacing at byte {begin} doesn't fit its block")
            sizes = [(end - at) // count] * count
        elif lacing == 1:
            for _ in range(count - 1):
                n = 0
                while data[at] == 255:
                    n, at = n + 255, at + 1
                sizes.append(n + data[at])
                at += 1
        else:
            n, at = read_size(data, at)
            sizes.append(n)
            for _ in range(count - 2):
                before = at
                n, at = read_size(data, at)
                length = at - before
                n = (1 << 7 * length) - 1 if n is None else n
                sizes.append(sizes[-1] + n - ((1 << 7 * length - 1) - 1))
        if lacing != 2:
            sizes.append(end - at - sum(sizes))
    if min(sizes) < 0 or at + sum(sizes) > end:
        raise ValueError(f"lacing at byte {begin} doesn't fit its block")
    t = tracks.get(track, {})
    rate = t.get("rate", 0) * t.get("channels", 1) * t.get("bits", 0) / 8
    out, done = [], 0
    for n in sizes:
        late = int(done * 1_000_000_000 / rate) if rate else 0
        out.append((track, (base + relative) * scale + late, bool(flags & 0x80) if simple else True, LACINGS[lacing], at + done, n))
        done += n
    return out


def parse(data: bytes) -> Parsed:
    """Tracks, packets, cues and clusters of a Matroska file. A packet's cue is that of its
    track at its cluster, None without one."""
    out, found = Parsed(), []
    for ident, begin, end in children(data, 0, len(data)):
        if ident != SEGMENT:
            continue
        behind = begin
        for top, b, e in children(data, begin, end):
            start, behind = behind, e  # elements follow each other without gaps
            if top == INFO:
                for x, p, q in children(data, b, e):
                    if x == SCALE:
                        out.scale = number(data, p, q)
                    elif x == DURATION:
                        out.duration = real(data, p, q)
            elif top == TRACKS:
                for x, p, q in children(data, b, e):
                    if x == TRACK_ENTRY:
                        track = read_track(data, p, q)
                        out.tracks[track["number"]] = track
            elif top == CLUSTER:
                out.clusters.append(start)
                base, inside = 0, []
                for x, p, q in children(data, b, e, CLUSTER):
                    if x == TIMESTAMP:
                        base = number(data, p, q)
                    elif x == SIMPLE_BLOCK:
                        inside += read_block(data, p, q, base, out.scale, True, out.tracks)
                    elif x == BLOCK_GROUP:
                        for y, r, s in children(data, p, q):
                            if y == BLOCK:
                                inside += read_block(data, r, s, base, out.scale, False, out.tracks)
                found += [(start, packet) for packet in inside]
            elif top == CUES:
                for x, p, q in children(data, b, e):
                    if x == CUE_POINT:
                        out.cues += read_cue(data, p, q, out.scale, begin)
    cue = {(track, cluster): time for time, track, cluster in reversed(out.cues)}  # the first of several
    out.packets = [(*packet, cue.get((packet[0], cluster))) for cluster, packet in found]
    return out


def read_track(data: bytes, begin: int, end: int) -> dict:
    track = {"number": 0, "type": 0, "codec": "", "rate": 8000.0, "channels": 1, "bits": 0}
    for x, p, q in children(data, begin, end):
        if x == TRACK_NUMBER:
            track["number"] = number(data, p, q)
        elif x == TRACK_TYPE:
            track["type"] = number(data, p, q)
        elif x == CODEC_ID:
            track["codec"] = data[p:q].decode("ascii", "replace")
        elif x == AUDIO:
            for y, r, s in children(data, p, q):
                if y == SAMPLING:
                    track["rate"] = real(data, r, s)
                elif y == CHANNELS:
                    track["channels"] = number(data, r, s)
                elif y == BIT_DEPTH:
                    track["bits"] = number(data, r, s)
    return track


def read_cue(data: bytes, begin: int, end: int, scale: int, segment: int) -> list[tuple]:
    time, places = 0, []
    for x, p, q in children(data, begin, end):
        if x == CUE_TIME:
            time = number(data, p, q) * scale
        elif x == CUE_POSITIONS:
            found = dict((y, number(data, r, s)) for y, r, s in children(data, p, q) if y in (CUE_TRACK, CUE_CLUSTER))
            places.append((found.get(CUE_TRACK, 0), segment + found.get(CUE_CLUSTER, 0)))
    return [(time, *place) for place in places]


def encode(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, media``: each text's UTF-8 bytes, padded, as a Matroska file.

    Null text counts as empty: one unit of bytes 0. Repeated rows stay repeated; other
    columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                texts = [t.as_py() for t in part.column(1)]
                files = [write(t + bytes(max(UNIT, -(-len(t) // UNIT) * UNIT) - len(t))) for t in texts]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, pa.array(files, pa.binary())], ["doc_id", "n_bytes", "media"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.encode(text_of(), "UTF-8").alias("bytes")).mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary")


def slices(batch: pa.RecordBatch, column: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``most`` bytes in a column, one row at least."""
    begin = size = 0
    for i, x in enumerate(batch.column(column)):
        n = len(x.as_buffer() or b"") if x.is_valid else 0
        if size and size + n > most:
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += n
    if batch.num_rows > begin:
        yield batch.slice(begin)


PACKETS = "array<struct<track:long,codec:string,timestamp_ns:long,keyframe:boolean,lacing:string,offset:long,size:long,cue_ns:long>>"


def index(media: DataFrame, column: str = "media") -> DataFrame:
    """The rows of ``media`` with ``packets``, a table of the file's frames in their order,
    and ``container``: duration in ms, tracks, clusters, cues. Columns of these names are
    replaced. A null file has an empty table and zeros; a damaged one raises."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    media = media.drop(*[c for c in media.columns if c.lower() in ("packets", "container")])
    added = StructType.fromDDL(f"packets {PACKETS}, container array<long>")
    whole = StructType([*media.schema.fields, *added.fields])
    schema, at = to_arrow_schema(whole), media.columns.index(column)
    inner = schema.field("packets").type.value_type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                rows, ends, marks = [], [0], []
                for data in part.column(at):
                    parsed = parse(data.as_py()) if data.is_valid else Parsed()
                    rows += [(p[0], parsed.tracks.get(p[0], {}).get("codec"), *p[1:]) for p in parsed.packets]
                    ends.append(len(rows))
                    marks.append([int(parsed.duration), len(parsed.tracks), len(parsed.clusters), len(parsed.cues)])
                columns = list(zip(*rows)) if rows else [()] * len(inner)
                found = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, inner)], fields=list(inner))
                tables = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)
                tables = tables.cast(schema.field("packets").type)
                yield pa.RecordBatch.from_arrays([*part.columns, tables, pa.array(marks, schema.field("container").type)], schema=schema)

    return media.mapInArrow(run, whole)


def packets(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """One row per frame: ``key, packet, track, codec, timestamp_ns, keyframe, lacing,
    offset, size, cue_ns``. A null file has no rows; a damaged one raises."""
    return index(media.select(key, column), column).select(key, F.posexplode("packets").alias("packet", "p")).select(
        key, F.col("packet").cast("long").alias("packet"), "p.*"
    )


def sampled(payload: bytes) -> list[int]:
    """Of 8-bit samples the mean, the root mean square and the rate of crossings of the
    middle, in thousandths."""
    x = np.frombuffer(payload, np.uint8)
    n, total, squares, crossings = max(1, len(x)), 0, 0, 0
    for i in range(0, len(x), 1 << 20):  # so that a long payload is not held again in wider numbers
        part = x[i : i + (1 << 20) + 1].astype(np.int64)
        crossings += int(np.count_nonzero(np.diff(part >= 128)))
        total, squares = total + int(part[: 1 << 20].sum()), squares + int((part[: 1 << 20] ** 2).sum())
    return [total * 1000 // n, int(1000 * (squares / n) ** 0.5), crossings * 1000 // n]


def features(media: DataFrame) -> DataFrame:
    """Digests and features of ``doc_id, n_bytes, media``, all from the stored bytes, which
    are read back by the packet table. ``feature`` lists duration in ms, tracks, clusters,
    cues, packets, packets by lacing, and what ``sampled`` says of the samples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                rows = []
                for data, table, container in zip(part.column(2), part.column(3).to_pylist(), part.column(4).to_pylist()):
                    data = data.as_py()
                    view = memoryview(data)
                    payload = b"".join(view[p["offset"] : p["offset"] + p["size"]] for p in table)
                    by = [sum(p["lacing"] == kind for p in table) for kind in LACINGS]
                    marks = ",".join(map(str, [*container, len(table), *by, *sampled(payload)]))
                    rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(data), hashlib.sha256(data).hexdigest(), marks))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], NAMES)

    kind = media.schema["doc_id"].dataType.simpleString()
    indexed = index(media.select("doc_id", "n_bytes", "media")).select("doc_id", "n_bytes", "media", "packets", "container")
    return indexed.mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


NAMES = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
