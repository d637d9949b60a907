"""Media columns (operator 2): MPEG transport streams.

mux() stores bytes as a single-program stream: a program association and a program map table, then packetised
elementary packets of private data with presentation timestamps, cut into 188-byte packets with continuity
counters; every RAP_EVERY-th access unit is a random-access point with a clock reference. demux() takes any
transport stream: it finds sync, parses program tables (with their CRC), drops repeated packets, counts
continuity errors, reassembles elementary packets by pid and keeps their timestamps and random-access points.

Defined results: null media is an empty stream (no units); bytes before sync and a broken last packet are
counted as lost; a table whose CRC is wrong is ignored; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

PACKET, SYNC = 188, 0x47
PMT_PID, ES_PID, STREAM_TYPE, STREAM_ID = 0x1000, 0x100, 0x06, 0xBD
UNIT_BYTES, TICKS, RAP_EVERY = 192 * 64, 3600, 8
PAD_BYTE, PAD_TO = b"\x20", 192


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = ((c << 1) ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


CRC = _crc_table()


def crc_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for x in data:
        c = (c << 8 & 0xFFFFFFFF) ^ CRC[c >> 24 ^ x]
    return c


def _section(pid: int, body: bytes) -> bytes:
    """One packet with one table section."""
    body += crc_mpeg(body).to_bytes(4, "big")
    return (bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10, 0]) + body).ljust(PACKET, b"\xff")


TABLES = _section(0, bytes([0, 0xB0, 13, 0, 1, 0xC1, 0, 0, 0, 1, 0xE0 | PMT_PID >> 8, PMT_PID & 255])) + _section(
    PMT_PID, bytes([2, 0xB0, 18, 0, 1, 0xC1, 0, 0, 0xE0 | ES_PID >> 8, ES_PID & 255, 0xF0, 0, STREAM_TYPE, 0xE0 | ES_PID >> 8, ES_PID & 255, 0xF0, 0])
)


def _stamp(t: int) -> bytes:
    return bytes([0x21 | t >> 29 & 14, t >> 22 & 255, t >> 14 & 254 | 1, t >> 7 & 255, t << 1 & 254 | 1])


def mux(payload: bytes, unit_bytes: int = UNIT_BYTES) -> bytes:
    """The payload as a transport stream, unit_bytes to an elementary packet."""
    out, cc = [TABLES], 0
    heads = [bytes([SYNC, ES_PID >> 8, ES_PID & 255, 0x10 | c]) for c in range(16)]
    for k, at in enumerate(range(0, len(payload), unit_bytes)):
        part, t = payload[at : at + unit_bytes], k * TICKS & 0x1FFFFFFFF
        pes = b"\x00\x00\x01" + bytes([STREAM_ID]) + (len(part) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(t) + part
        field = b""
        if k % RAP_EVERY == 0:  # discontinuity no, random access yes, clock reference
            field = bytes([0x50]) + (t << 15 | 0x7E00).to_bytes(6, "big")
        first, n = True, len(pes)
        pos = 0
        while pos < n:
            room = 184 - (1 + len(field) if field else 0)
            if not field and n - pos >= 184:
                head = heads[cc]
                out.append((bytes([SYNC, 0x40 | ES_PID >> 8]) + head[2:] if first else head) + pes[pos : pos + 184])
                pos += 184
            else:
                take = min(room, n - pos)
                if take == 183 and not field:
                    adapt = b"\x00"
                else:
                    adapt = field or b"\x00"
                    adapt = bytes([183 - take]) + adapt + b"\xff" * (183 - take - len(adapt)) if take < 184 else b""
                out.append(bytes([SYNC, (0x40 if first else 0) | ES_PID >> 8, ES_PID & 255, 0x30 | cc]) + adapt + pes[pos : pos + take])
                pos, field = pos + take, b""
            cc, first = cc + 1 & 15, False
    return b"".join(out)


class Demuxer:
    """The units of a stream: list of (pid, stream_type, pts, dts, random_access, data), and counts."""

    def __init__(self, media: bytes | None):
        self.units: list[tuple] = []
        self.programs: dict[int, int] = {}
        self.types: dict[int, int] = {}
        self.packets = self.cc_errors = self.repeats = self.lost_bytes = 0
        self._open: dict[int, list] = {}
        self._held: dict[int, bytes] = {}  # sections begun, by packet id
        self._read(media or b"")
        for pid in list(self._open):
            self._close(pid)

    def _read(self, media: bytes) -> None:
        last: dict[int, tuple[int, bytes]] = {}
        at, n = 0, len(media)
        while at + PACKET <= n:
            if media[at] != SYNC:
                nxt = media.find(b"\x47", at)
                while nxt >= 0 and nxt + PACKET < n and media[nxt + PACKET] != SYNC:
                    nxt = media.find(b"\x47", nxt + 1)
                nxt = n if nxt < 0 else nxt
                self.lost_bytes += nxt - at
                at = nxt
                continue
            b1, b3 = media[at + 1], media[at + 3]
            pid = (b1 & 31) << 8 | media[at + 2]
            start, end = at + 4, at + PACKET
            at = end
            self.packets += 1
            if pid == 0x1FFF or b1 & 0x80:
                self.cc_errors += bool(b1 & 0x80)
                continue
            rap = jump = False
            if b3 & 0x20:
                size = media[start]
                if size:
                    rap, jump = bool(media[start + 1] & 0x40), bool(media[start + 1] & 0x80)
                start += 1 + size
            if not b3 & 0x10 or start > end:
                continue
            cc, body = b3 & 15, media[start:end]
            lost = False
            if pid in last and not jump:
                if cc == last[pid][0] and body == last[pid][1]:
                    self.repeats += 1
                    continue
                if cc != last[pid][0] + 1 & 15:
                    self.cc_errors += 1
                    lost = True
                    if pid in self._open and not b1 & 0x40:
                        self._open[pid][1] = True
            last[pid] = (cc, body)
            if pid == 0 or pid in self.programs.values():
                self._tables(pid, body, bool(b1 & 0x40), lost)
            elif b1 & 0x40:
                self._close(pid)
                self._open[pid] = [rap, False, [body]]
            elif pid in self._open:
                self._open[pid][2].append(body)
        self.lost_bytes += n - at if at < n else 0

    def _tables(self, pid: int, body: bytes, begins: bool, lost: bool) -> None:
        """The sections in a packet and those before it, which may end or begin in it; where a packet is lost, what was begun is."""
        held = b"" if lost else self._held.get(pid, b"")
        if begins and body:
            new = 1 + body[0]
            self._sections(pid, held + body[1:new] if held else b"")
            held = self._sections(pid, body[new:])
        elif held:
            held = self._sections(pid, held + body)
        self._held[pid] = held

    def _sections(self, pid: int, s: bytes) -> bytes:
        """Reads the whole sections; what is left of one that goes on in the next packet."""
        while s and s[0] != 0xFF:
            end = 3 + ((s[1] & 15) << 8 | s[2]) if len(s) >= 3 else len(s) + 1
            if end > len(s):
                return s
            self._table(pid, s[:end])
            s = s[end:]
        return b""

    def _table(self, pid: int, s: bytes) -> None:
        """A whole section; wrong CRCs are ignored."""
        end = len(s)
        if end < 12 or crc_mpeg(s):
            return
        if pid == 0 and s[0] == 0:
            for i in range(8, end - 4, 4):
                if (number := s[i] << 8 | s[i + 1]) != 0:
                    self.programs[number] = (s[i + 2] & 31) << 8 | s[i + 3]
        elif s[0] == 2:
            i = 12 + ((s[10] & 15) << 8 | s[11])
            while i + 5 <= end - 4:
                self.types[(s[i + 1] & 31) << 8 | s[i + 2]] = s[i]
                i += 5 + ((s[i + 3] & 15) << 8 | s[i + 4])

    def _close(self, pid: int) -> None:
        if pid not in self._open:
            return
        rap, broken, parts = self._open.pop(pid)
        pes = b"".join(parts)
        if pes[:3] != b"\0\0\1" or len(pes) < 9:
            return
        size, flags = pes[4] << 8 | pes[5], pes[7]
        stamp = lambda p: (p[0] & 14) << 29 | p[1] << 22 | (p[2] & 254) << 14 | p[3] << 7 | p[4] >> 1
        pts = stamp(pes[9:14]) if flags & 0x80 and len(pes) >= 14 else None
        dts = stamp(pes[14:19]) if flags & 0xC0 == 0xC0 and len(pes) >= 19 else pts
        data = pes[9 + pes[8] : 6 + size if size else None]
        self.units.append((pid, self.types.get(pid), pts, dts, rap, data, broken or bool(size) and len(pes) < 6 + size))


def store(df: DataFrame, payload_col: str, media_col: str = "media", unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """Adds media_col: payload_col (binary; null: empty) as a transport stream. Other columns stay."""
    schema = df.drop(media_col).schema.add(media_col, "binary")
    at = df.columns.index(payload_col)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, text=at):
            media = pa.array([mux(x or b"", unit_bytes) for x in b.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, media], [*b.schema.names, media_col])

    return df.drop(media_col).mapInArrow(run, schema)


def units(df: DataFrame, id_col: str, media_col: str = "media") -> DataFrame:
    """One row per elementary packet of each stream, in the order in which they end."""

    def run(batches):
        for b in common.slices(batches):
            rows = [(i, k, *u) for i, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for k, u in enumerate(Demuxer(m).units)]
            cols = list(zip(*rows)) if rows else [[] for _ in range(9)]
            kinds = [b.column(0).type, pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], [id_col, "unit", "pid", "stream_type", "pts", "dts", "random_access", "data", "broken"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, media_col).mapInArrow(run, f"`{id_col}` {kind}, unit int, pid int, stream_type int, pts long, dts long, random_access boolean, data binary, broken boolean")


def _features(batches):
    for b in common.slices(batches, text=2):
        cols: list[list] = [[] for _ in range(8)]
        for d, n, media in zip(*(b.column(i).to_pylist() for i in range(3))):
            x = Demuxer(media)
            payload = b"".join(u[5] for u in x.units)
            stamps = [u[2] for u in x.units]
            raps = sum(u[4] for u in x.units)
            text = f"programs={len(x.programs)};types={','.join(f'{p}:{t}' for p, t in sorted(x.types.items()))};packets={x.packets};units={len(x.units)};pts={stamps[0]}-{stamps[-1]};raps={raps};cc_errors={x.cc_errors};lost={x.lost_bytes}"
            for c, v in zip(cols, (d, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), text)):
                c.append(v)
        kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def documents_as_media(docs: DataFrame) -> DataFrame:
    """Each document's text as UTF-8 (null: empty), padded by spaces to a positive multiple of 192 bytes, stored
    as a stream, read back, and described. One pass, no shuffle."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    n = F.length(raw)
    pad = F.greatest(F.lit(PAD_TO), F.ceil(n / PAD_TO) * PAD_TO) - n
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), n.cast("long").alias("n_bytes"), F.concat(raw, F.repeat(F.lit(" "), pad.cast("int")).cast("binary")).alias("payload"))
    media = store(src, "payload").select("doc_id", "n_bytes", "media")
    return media.mapInArrow(_features, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
