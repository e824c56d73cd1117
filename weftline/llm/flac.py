"""FLAC as a media column: texts as 8-bit mono samples, encoded and decoded a whole batch at a time.

Both directions follow RFC 9639. Frames of one shape (block size, header length, subframe kind) are
handled together: Rice codes are read in lockstep, one code of every frame at each step, and linear
predictors restore one sample of every frame at each step. Headers carry CRC-8, frames CRC-16 and the
stream the MD5 of its samples; decoding checks all three. A seek table has a point for every frame, so a
PCM block can be read by its sample offset alone.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import handed_back

#: Samples in a frame; the last frame of a stream holds what is left.
BLOCK = 1024
SAMPLE_RATE = 8000
#: Order and bits of the quantised linear predictor.
ORDER = 8
PRECISION = 12
#: log2 of the Rice partitions in a frame.
PARTITIONS = 2
#: A payload is a positive multiple of so many samples.
UNIT = 192
PAD = 32
#: Frames handled at once, which bounds memory.
AT_ONCE = 512
#: Payload bytes of one call within an Arrow batch.
CALL_BYTES = 12_000_000

#: Columns that reading a stream adds.
_READ = ", pcm binary, offsets array<long>, feature string"

_CONSTANT, _VERBATIM, _FIXED, _LPC = 0, 1, 8, 32  # subframe types; fixed adds its order, LPC its order less one


class Corrupt(ValueError):
    """The stream breaks the format or a checksum."""


def _crc_table(poly: int, bits: int) -> np.ndarray:
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    out = []
    for byte in range(256):
        c = byte << (bits - 8)
        for _ in range(8):
            c = ((c << 1) ^ poly if c & top else c << 1) & mask
        out.append(c)
    return np.array(out, dtype=np.uint16)


_CRC8, _CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows of `size` bytes from `start`, aligned right, zeros before."""
    width = int(size.max(initial=0))
    at = start[:, None] + np.arange(width)[None, :] - (width - size)[:, None]
    return np.where(at >= start[:, None], data[np.maximum(at, 0)], 0).astype(np.uint8)


def crc16(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-16 of many pieces of `data` in lockstep; zeros in front of a piece leave it unchanged."""
    crc = np.zeros(len(start), dtype=np.uint16)
    for col in np.ascontiguousarray(_gather(data, start, size).T):
        crc = (crc << np.uint16(8)) ^ _CRC16[(crc >> np.uint16(8)) ^ col]
    return crc


def crc8(rows: np.ndarray) -> np.ndarray:
    crc = np.zeros(len(rows), dtype=np.uint16)
    for col in rows.T:
        crc = _CRC8[crc ^ col]
    return crc.astype(np.uint8)


def _number(n: int) -> bytes:
    """A frame number in the format's UTF-8 like code."""
    if n < 0x80:
        return bytes([n])
    tail = []
    while n >= 1 << (6 - len(tail)):
        tail.append(0x80 | n & 0x3F)
        n >>= 6
    lead = (0xFF << (7 - len(tail))) & 0xFF | n
    return bytes([lead, *reversed(tail)])


def _header(size: int, number: int) -> bytes:
    """Frame header without its CRC: fixed block size, rate from the stream, mono, 8 bits."""
    code, more = (0b1010, b"") if size == 1024 else (0b0111, struct.pack(">H", size - 1))
    return bytes([0xFF, 0xF8, code << 4, 0b00000010]) + _number(number) + more


def _predictor(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients and shift of each row by Levinson's recursion on windowed samples."""
    m, n = x.shape
    w = x * np.hanning(n + 2)[1:-1].astype(np.float32)
    auto = np.stack([np.einsum("ij,ij->i", w[:, lag:], w[:, : n - lag]) for lag in range(ORDER + 1)], axis=1).astype(np.float64)
    auto[:, 0] = auto[:, 0] * (1 + 1e-9) + 1e-6
    a, err = np.zeros((m, ORDER)), auto[:, 0].copy()
    for i in range(ORDER):
        k = (auto[:, i + 1] - np.einsum("ij,ij->i", a[:, :i], auto[:, i:0:-1])) / err
        new = a.copy()
        new[:, i] = k
        new[:, :i] = a[:, :i] - k[:, None] * a[:, :i][:, ::-1]
        a, err = new, np.maximum(err * (1 - k * k), 1e-9)
    top = np.maximum(np.abs(a).max(axis=1), 1e-6)
    shift = np.clip(PRECISION - 2 - np.floor(np.log2(top)).astype(int), 0, 15)
    limit = 1 << (PRECISION - 1)
    return np.clip(np.rint(a * (1 << shift)[:, None]), -limit, limit - 1).astype(np.int32), shift.astype(np.int32)


def _lpc_residual(x: np.ndarray, coefs: np.ndarray, shift: np.ndarray) -> np.ndarray:
    n = x.shape[1]
    guess = np.zeros((x.shape[0], n - ORDER), dtype=np.int32)
    for j in range(ORDER):
        guess += coefs[:, j : j + 1] * x[:, ORDER - 1 - j : n - 1 - j]
    return x[:, ORDER:] - (guess >> shift[:, None])


class _Bits:
    """Rows of bits of one length, written field by field."""

    def __init__(self, rows: int, width: int):
        self.bits = np.zeros((rows, width), dtype=np.uint8)
        self.at = 0

    def put(self, values, width: int) -> None:
        v = np.broadcast_to(np.asarray(values), (len(self.bits),)).astype(np.int64)
        for j in range(width):
            self.bits[:, self.at + j] = (v >> (width - 1 - j)) & 1
        self.at += width


def _encode_group(x: np.ndarray, headers: list[bytes], kind: int, fitted: tuple | None = None) -> list[bytes]:
    """Frames of equally long rows of samples, equally long headers and one kind of subframe.

    `fitted` has the predictors of the rows and their residuals, where they are known.
    """
    m, n = x.shape
    raw = np.frombuffer(b"".join(headers), dtype=np.uint8).reshape(m, -1)
    raw = np.concatenate([raw, crc8(raw)[:, None]], axis=1)
    lead = 8 * raw.shape[1]
    if kind == _CONSTANT or kind == _VERBATIM:
        body = x[:, :1] if kind == _CONSTANT else x
        rows = np.concatenate([raw, np.full((m, 1), kind << 1, np.uint8), body.astype(np.int8).view(np.uint8)], axis=1)
        flat, size = rows.reshape(-1), np.full(m, rows.shape[1])
    else:
        if kind >= _LPC:
            order = ORDER
            if fitted is None:
                coefs, shift = _predictor(x.astype(np.float32))
                fitted = coefs, shift, _lpc_residual(x, coefs, shift)
            coefs, shift, res = fitted
        else:
            order = kind - _FIXED
            res = np.diff(x, n=order, axis=1)
        u = np.where(res >= 0, 2 * res, -2 * res - 1).astype(np.int32)
        parts, each = 1 << PARTITIONS, n >> PARTITIONS
        edges = [0, *(each * (p + 1) - order for p in range(parts))]
        k = np.stack([np.clip(np.floor(np.log2(u[:, a:b].mean(axis=1) + 0.7)), 0, 14).astype(np.int32) for a, b in zip(edges, edges[1:])], axis=1)
        kk = np.repeat(k, np.diff(edges), axis=1)
        q = u >> kk
        used = q + 1 + kk
        used[:, edges[:-1]] += 4  # each partition begins with its parameter
        head = lead + 8 + 8 * order + (9 + ORDER * PRECISION if kind >= _LPC else 0) + 6
        ends = head + np.cumsum(used, axis=1)
        size = (ends[:, -1] + 7) // 8
        b = _Bits(m, 8 * int(size.max()))
        b.bits[:, :lead] = np.unpackbits(raw, axis=1)
        b.at = lead
        b.put(kind << 1, 8)
        for i in range(order):
            b.put(x[:, i] & 0xFF, 8)
        if kind >= _LPC:
            b.put(PRECISION - 1, 4)
            b.put(shift, 5)
            for j in range(ORDER):
                b.put(coefs[:, j], PRECISION)
        b.put(PARTITIONS, 6)
        rows = np.arange(m)[:, None]
        stop = ends - kk - 1  # the bit that ends the unary part
        b.bits[rows, stop] = 1
        # the low bits of all codes in one go: bit `nth` of a code lies right after the bit that ends it
        width = kk.reshape(-1).astype(np.int32)
        nth = np.arange(int(width.sum()), dtype=np.int32) - np.repeat((np.cumsum(width) - width).astype(np.int32), width)
        place = np.repeat((rows * b.bits.shape[1] + stop + 1).reshape(-1).astype(np.int32), width) + nth
        b.bits.reshape(-1)[place] = (np.repeat(u.reshape(-1), width) >> (np.repeat(width, width) - 1 - nth)) & 1
        for p, a in enumerate(edges[:-1]):
            first = ends[:, a] - used[:, a]
            for j in range(4):
                b.bits[np.arange(m), first + j] = (k[:, p] >> (3 - j)) & 1
        packed = np.packbits(b.bits, axis=1)
        flat = packed.reshape(-1)
    starts = np.arange(m) * (len(flat) // m)
    crc = crc16(flat, starts, size)
    data = flat.tobytes()
    return [data[s : s + z] + int(c).to_bytes(2, "big") for s, z, c in zip(starts.tolist(), size.tolist(), crc.tolist(), strict=True)]


def _kinds(x: np.ndarray) -> tuple[np.ndarray, tuple]:
    """The subframe for each row: constant, else the fixed or linear predictor of the least residuals.

    Also the linear predictors and their residuals.
    """
    cost, d = [], x
    for order in range(5):
        cost.append(np.abs(d[:, 4 - order :]).sum(axis=1))
        d = np.diff(d, axis=1)
    coefs, shift = _predictor(x.astype(np.float32))
    res = _lpc_residual(x, coefs, shift)
    cost.append(np.abs(res).sum(axis=1) + ORDER * PRECISION)
    kind = np.array([_FIXED, _FIXED + 1, _FIXED + 2, _FIXED + 3, _FIXED + 4, _LPC + ORDER - 1])[np.argmin(np.stack(cost), axis=0)]
    return np.where((x == x[:, :1]).all(axis=1), _CONSTANT, kind), (coefs, shift, res)


def encode_streams(pcm: list[bytes]) -> list[bytes]:
    """A FLAC stream for each series of unsigned 8-bit samples; at least 16 samples each."""
    where: dict[int, list[tuple[int, int]]] = {}
    for i, p in enumerate(pcm):
        if len(p) % 64 or not p:
            raise ValueError("payloads are positive multiples of 64 samples")
        for f, at in enumerate(range(0, len(p), BLOCK)):
            where.setdefault(min(BLOCK, len(p) - at), []).append((i, f))
    frames: list[list[bytes]] = [[b""] * -(-len(p) // BLOCK) for p in pcm]
    for size, all_of_size in where.items():
        for cut in range(0, len(all_of_size), AT_ONCE):
            some = all_of_size[cut : cut + AT_ONCE]
            raw = np.frombuffer(b"".join(pcm[i][f * BLOCK : f * BLOCK + size] for i, f in some), dtype=np.uint8).reshape(len(some), size)
            x = raw.astype(np.int32) - 128
            kinds, fitted = _kinds(x)
            heads = [_header(size, f) for _, f in some]
            shape = np.array([len(h) for h in heads])
            for kind, length in sorted({*zip(kinds.tolist(), shape.tolist(), strict=True)}):
                rows = np.flatnonzero((kinds == kind) & (shape == length))
                done = _encode_group(x[rows], [heads[r] for r in rows], kind, tuple(f[rows] for f in fitted))
                small = size + length + 4  # a verbatim frame of this shape
                worse = [r for r, d in zip(rows, done, strict=True) if len(d) > small]
                plain = dict(zip(worse, _encode_group(x[worse], [heads[r] for r in worse], _VERBATIM), strict=True)) if worse else {}
                for r, d in zip(rows, done, strict=True):
                    i, f = some[r]
                    frames[i][f] = plain.get(r, d)
    return [_stream(p, f) for p, f in zip(pcm, frames, strict=True)]


def _stream(pcm: bytes, frames: list[bytes]) -> bytes:
    n, sizes = len(pcm), [len(f) for f in frames]
    signed = np.frombuffer(pcm, dtype=np.uint8) ^ np.uint8(128)
    packed = SAMPLE_RATE << 44 | 7 << 36 | n  # rate 20 bits, channels less one 3, bits less one 5, samples 36
    block = min(n, BLOCK)
    info = struct.pack(">HH", block, block) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + packed.to_bytes(8, "big") + hashlib.md5(signed.tobytes()).digest()
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]]).tolist()
    seek = b"".join(struct.pack(">QQH", i * BLOCK, o, min(BLOCK, n - i * BLOCK)) for i, o in enumerate(offsets))
    return b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(seek).to_bytes(3, "big") + seek + b"".join(frames)


def _metadata(data: bytes) -> tuple[int, bytes, list[int], int]:
    """(samples, MD5, frame offsets from the seek table or [], where frames begin)."""
    if data[:4] != b"fLaC":
        raise Corrupt("no FLAC stream")
    at, last, total, md5, points = 4, False, 0, b"", []
    while not last:
        if at + 4 > len(data):
            raise Corrupt("metadata ends early")
        last, kind, size = bool(data[at] & 0x80), data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
        body = data[at + 4 : at + 4 + size]
        if len(body) < size or (kind == 0 and size != 34):
            raise Corrupt("metadata ends early")
        if kind == 0:
            fields = int.from_bytes(body[10:18], "big")
            total, md5 = fields & ((1 << 36) - 1), body[18:34]
            if (fields >> 41) & 7 or (fields >> 36) & 31 != 7:
                raise Corrupt("only mono streams of 8 bits are read")
        elif kind == 3:
            points = [p[:2] for p in struct.iter_unpack(">QQH", body[: size - size % 18]) if p[0] != (1 << 64) - 1]
        at += 4 + size
    blocks = -(-total // BLOCK)
    known = [o for _, o in points] if [s for s, _ in points] == [i * BLOCK for i in range(blocks)] else []
    if known and (known[0] or sorted(set(known)) != known or at + known[-1] >= len(data)):
        raise Corrupt("seek points leave the stream")
    return total, md5, known, at


class _Window:
    """32 bits from any bit of a buffer, and the next set bit from any bit."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        wide = padded.astype(np.uint32)
        self.words = wide[:-3] << np.uint32(24) | wide[1:-2] << np.uint32(16) | wide[2:-1] << np.uint32(8) | wide[3:]
        bits = np.unpackbits(padded)
        ones = np.append(np.flatnonzero(bits), len(bits)).astype(np.int32)
        self.next = ones[np.cumsum(bits, dtype=np.int32) - bits]
        self.end = len(bits)

    def read(self, at: np.ndarray, width) -> np.ndarray:
        """`width` bits (0 to 24) from each bit position, unsigned."""
        at = np.minimum(at, self.end - 40)
        w = self.words[at >> 3] << (at & 7).astype(np.uint32)
        width = np.asarray(width)
        return np.where(width > 0, w >> (32 - np.maximum(width, 1)).astype(np.uint32), 0).astype(np.int64)


def _signed(v: np.ndarray, width: int) -> np.ndarray:
    return np.where(v >= 1 << (width - 1), v - (1 << width), v)


def _decode_group(win: _Window, at: np.ndarray, n: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """(samples, bit after the subframe) of frames whose subframe header ends at bit `at`."""
    m = len(at)
    if kind == _CONSTANT:
        return np.repeat(_signed(win.read(at, 8), 8)[:, None], n, axis=1), at + 8
    if kind == _VERBATIM:
        return _signed(win.read(at[:, None] + 8 * np.arange(n)[None, :], 8), 8), at + 8 * n
    if not (_FIXED <= kind <= _FIXED + 4 or kind >= _LPC):
        raise Corrupt(f"reserved subframe type {kind}")
    order = kind - _FIXED if kind < _LPC else kind - _LPC + 1
    x = np.zeros((n, m), dtype=np.int64)
    for i in range(order):
        x[i] = _signed(win.read(at, 8), 8)
        at = at + 8
    if kind >= _LPC:
        precision = win.read(at, 4) + 1
        shift = _signed(win.read(at + 4, 5), 5)
        at = at + 9
        coefs = np.zeros((order, m), dtype=np.int64)
        for j in range(order):
            v = win.read(at, precision)
            coefs[j] = np.where(v >= 1 << (precision - 1), v - (1 << precision), v)
            at = at + precision
    method, parts = win.read(at, 2), win.read(at + 2, 4)
    if (method > 1).any() or (parts != parts[0]).any() or (method != method[0]).any():
        raise Corrupt("residual coding is mixed or reserved")
    at, width, split = at + 6, 4 + int(method[0]), int(parts[0])
    row = order
    for p in range(1 << split):
        count = (n >> split) - (order if p == 0 else 0)
        k = win.read(at, width)
        plain = k == (1 << width) - 1  # escaped: numbers of a fixed width, no Rice codes
        at = (at + width).astype(np.int64)
        raw, k = at[plain], np.where(plain, 0, k)
        step, stops, begins = k + 1, np.empty((count, m), np.int64), np.empty((count, m), np.int64)
        nxt, last = win.next, win.end - 1
        for i in range(count):  # one code of every frame
            begins[i] = at
            t = nxt[np.minimum(at, last)]
            stops[i] = t
            at = t + step
        u = ((stops - begins) << k) | win.read(stops + 1, np.broadcast_to(k, stops.shape))
        x[row : row + count] = (u >> 1) ^ -(u & 1)
        if plain.any():
            size = win.read(raw, 5)
            v = win.read(raw + 5 + size * np.arange(count)[:, None], np.broadcast_to(np.maximum(size, 1), (count, len(raw)))).astype(np.int64)
            half = np.int64(1) << np.maximum(size - 1, 0)
            x[row : row + count, plain] = np.where(size > 0, np.where(v >= half, v - 2 * half, v), 0)
            at[plain] = raw + 5 + size * count
        row += count
    if kind < _LPC:
        for o in range(order, 0, -1):  # integrate, with the warm-up's differences in front
            first = np.diff(x[:order], n=o - 1, axis=0)[0] if o > 1 else x[0]
            lead = [np.diff(x[:order], n=o - 1, axis=0)[i] for i in range(order - o + 1)] if order else []
            body = np.cumsum(x[order:], axis=0) + (lead[-1] if lead else first)
            x[order:] = body
    else:
        for i in range(order, n):
            x[i] += np.einsum("ij,ij->j", coefs, x[i - order : i][::-1]) >> shift
    return x.T, at


def decode_frames(data: np.ndarray, start: np.ndarray, limit: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Samples and the end of the frames that begin at `start`; no frame reaches beyond `limit`."""
    padded = np.concatenate([data, np.zeros(32, np.uint8)])
    out: list[np.ndarray] = [np.zeros(0)] * len(start)
    ends = np.zeros(len(start), dtype=np.int64)
    b = padded[start[:, None] + np.arange(16)[None, :]].astype(np.int64)
    rate = b[:, 2] & 15  # of no use here, but some codes put it behind the block size
    if ((b[:, 0] != 0xFF) | (b[:, 1] != 0xF8) | ((b[:, 3] != 2) & (b[:, 3] != 0)) | (rate == 15)).any():
        raise Corrupt("no frame of a mono 8-bit stream here")
    code = b[:, 2] >> 4
    lead = b[:, 4]
    length = np.select([lead < 0x80, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC, lead < 0xFE], [1, 2, 3, 4, 5, 6], 7)
    row = np.arange(len(start))
    after = 4 + length
    two = b[row, after] * 256 + b[row, after + 1] + 1
    size = np.select([code == 6, code == 7, code >= 8], [b[row, after] + 1, two, 256 << np.maximum(code - 8, 0)], 0)
    if (size == 0).any():
        raise Corrupt("block size code isn't read")
    head = after + np.select([code == 6, code == 7], [1, 2], 0) + np.select([rate == 12, rate > 12], [1, 2], 0)
    kind = padded[start + head + 1] >> 1
    for h in np.unique(head).tolist():
        of = np.flatnonzero(head == h)
        rows = padded[start[of][:, None] + np.arange(h + 1)[None, :]]
        if (crc8(rows[:, :-1]) != rows[:, -1]).any():
            raise Corrupt("CRC-8 of a frame header")
    for n, k in sorted({*zip(size.tolist(), kind.tolist(), strict=True)}):
        of_shape = np.flatnonzero((size == n) & (kind == k))
        for cut in range(0, len(of_shape), AT_ONCE):
            of = of_shape[cut : cut + AT_ONCE]
            room = np.minimum(limit[of] - start[of], 2 * n + 64)
            base = np.concatenate([[0], np.cumsum(room)[:-1]])
            own = np.concatenate([data[s : s + r] for s, r in zip(start[of].tolist(), room.tolist(), strict=True)])
            x, at = _decode_group(_Window(own), 8 * (base + head[of] + 2), n, k)
            body = (at + 7) // 8 - base
            if (body + 2 > room).any():
                raise Corrupt("a frame ends early")
            want = own[base + body].astype(np.uint16) << np.uint16(8) | own[base + body + 1]
            if (crc16(own, base, body) != want).any():
                raise Corrupt("CRC-16 of a frame")
            pcm = (x + 128).astype(np.uint8)
            for i, samples in zip(of.tolist(), pcm, strict=True):
                out[i] = samples
            ends[of] = start[of] + body + 2
    return out, ends


def decode_streams(streams: list[bytes]) -> list[list[tuple[int, bytes]]]:
    """PCM blocks of each stream: (sample offset, unsigned 8-bit samples), in order.

    With a seek table all frames are decoded at once; without one, the n-th frames of all streams are
    decoded together. Raises Corrupt where a checksum or the number of samples is wrong.
    """
    heads = [_metadata(s) for s in streams]
    data = np.frombuffer(b"".join(streams), dtype=np.uint8)
    base = np.concatenate([[0], np.cumsum([len(s) for s in streams])]).astype(np.int64)
    blocks: list[list[tuple[int, bytes]]] = [[] for _ in streams]
    open_ = {i: int(base[i]) + h[3] for i, h in enumerate(heads) if h[0]}
    done = [0] * len(streams)
    first = True
    while open_:
        ids, starts, limits = [], [], []
        for i, at in open_.items():
            known = [int(base[i]) + heads[i][3] + o for o in heads[i][2]] if first and heads[i][2] else [at]
            ids += [i] * len(known)
            starts += known
            limits += [*known[1:], int(base[i + 1])]
        first = False
        try:
            out, ends = decode_frames(data, np.array(starts), np.array(limits))
        except IndexError as e:
            raise Corrupt("a frame points beyond the stream") from e
        for i, samples, end in zip(ids, out, ends.tolist(), strict=True):
            blocks[i].append((done[i], samples.tobytes()))
            done[i] += len(samples)
            open_[i] = end
        open_ = {i: at for i, at in open_.items() if done[i] < heads[i][0]}
    for (total, md5, _, _), own in zip(heads, blocks, strict=True):
        pcm = b"".join(b for _, b in own)
        signed = np.frombuffer(pcm, dtype=np.uint8) ^ np.uint8(128)
        if len(pcm) != total or (any(md5) and hashlib.md5(signed.tobytes()).digest() != md5):
            raise Corrupt("samples don't match the stream's MD5")
    return blocks


def payload(text: str) -> bytes:
    """UTF-8 of the text, padded to a positive multiple of UNIT."""
    raw = text.encode()
    return raw.ljust(max(1, -(-len(raw) // UNIT)) * UNIT, bytes([PAD]))


def describe(pcm: bytes) -> str:
    """Features of the samples: count, peak, mean level, energy, sign changes and step energy."""
    x = np.frombuffer(pcm, dtype=np.uint8).astype(np.int64) - 128
    d = np.diff(x)
    turns = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"samples={len(x)};peak={int(np.abs(x).max(initial=0))};sum={int(x.sum())};energy={int((x * x).sum())};turns={turns};steps={int((d * d).sum())}"


def _calls(batches: Iterator[pa.RecordBatch], size_of) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about CALL_BYTES."""
    for batch in batches:
        at, held = 0, 0
        for row, n in enumerate(size_of(batch)):
            if held and held + n > CALL_BYTES:
                yield batch.slice(at, row - at)
                at, held = row, 0
            held += n
        if batch.num_rows > at:
            yield batch.slice(at)


def _encoded(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(doc_id, n_bytes, media) of a batch of (doc_id, text, n_bytes)."""
    media = encode_streams([payload(t) for t in batch.column(1).to_pylist()])
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(media, type=pa.binary())], names=["doc_id", "n_bytes", "media"])


def _decoded(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A batch of (doc_id, n_bytes, media) with pcm, offsets and feature, from the bytes of `media` alone."""
    found = decode_streams(batch.column(2).to_pylist())
    pcm = [b"".join(p for _, p in own) for own in found]
    more = [pa.array(pcm, type=pa.binary()), pa.array([[o for o, _ in own] for own in found], type=pa.list_(pa.int64())), pa.array([describe(p) for p in pcm])]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *more], names=["doc_id", "n_bytes", "media", "pcm", "offsets", "feature"])


def _sized(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): the whole text as a FLAC stream; null as empty.

    Rows stay one to one, equal texts give equal streams; other columns are left behind.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _calls(batches, lambda b: b.column(2).to_pylist()):
            yield _encoded(batch)

    return _sized(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary")


def blocks(media: DataFrame) -> DataFrame:
    """(doc_id, sample_offset, pcm): the PCM blocks of each stream, one row for each frame.

    A stream that breaks the format or a checksum raises Corrupt; an empty table gives no rows.
    """
    kind = dict(media.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _calls(batches, lambda b: [len(x.as_buffer()) for x in b.column(1)]):
            found = decode_streams(batch.column(1).to_pylist())
            take = pa.array([i for i, own in enumerate(found) for _ in own], type=pa.int32())
            flat = [x for own in found for x in own]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), pa.array([o for o, _ in flat], type=pa.int64()), pa.array([p for _, p in flat], type=pa.binary())], names=["doc_id", "sample_offset", "pcm"])

    return media.select("doc_id", "media").mapInArrow(run, f"doc_id {kind}, sample_offset long, pcm binary")


def decode(media: DataFrame) -> DataFrame:
    """`media` with `pcm` (all samples), `offsets` (where each block begins) and `feature`."""
    schema = ", ".join(f"{c} {t}" for c, t in media.select("doc_id", "n_bytes", "media").dtypes) + _READ

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _calls(batches, lambda b: [len(x.as_buffer()) for x in b.column(2)]):
            yield _decoded(batch)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What `decode(encode(docs))` returns, by one Python worker a task instead of two."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _calls(handed_back(batches), lambda b: b.column(2).to_pylist()):
            yield _decoded(_encoded(batch))

    return _sized(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary" + _READ)
