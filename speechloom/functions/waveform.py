"""Waveform helpers that run inside Arrow functions: WAV headers, PCM samples, resampling."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

PCM, IEEE_FLOAT, EXTENSIBLE = 1, 3, 0xFFFE


class UnreadableAudio(ValueError):
    pass


def wav_layout(stream, size: int) -> dict:
    """Walk the RIFF chunks of a seekable stream; returns format fields and the data span."""
    head = stream.read(12)
    if len(head) < 12 or head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise UnreadableAudio("not a RIFF/WAVE file")
    layout: dict = {}
    at = 12
    while at + 8 <= size:
        stream.seek(at)
        tag, length = struct.unpack("<4sI", stream.read(8))
        at += 8
        if tag == b"fmt ":
            body = stream.read(min(length, 40))
            if len(body) < 16:
                raise UnreadableAudio("short fmt chunk")
            code, channels, rate, _, block, bits = struct.unpack("<HHIIHH", body[:16])
            if code == EXTENSIBLE and len(body) >= 26:
                code = struct.unpack("<H", body[24:26])[0]
            layout.update(code=code, channels=channels, rate=rate, block=block, bits=bits)
        elif tag == b"data":
            layout.update(start=at, length=min(length, size - at))
        if "rate" in layout and "start" in layout:
            break
        at += length + (length & 1)
    if "rate" not in layout or "start" not in layout:
        raise UnreadableAudio("fmt or data chunk missing")
    if layout["rate"] <= 0 or layout["block"] <= 0 or layout["channels"] <= 0:
        raise UnreadableAudio("bad fmt chunk")
    return layout


def wav_duration(content: pa.Buffer | None, size: int) -> float | None:
    """Seconds of audio in a WAV file of ``size`` bytes, or None when it cannot be read.

    ``content`` may end after the chunk headers.
    """
    if content is None:
        return None
    try:
        layout = wav_layout(pa.BufferReader(content), size)
    except (UnreadableAudio, struct.error, pa.ArrowInvalid, OSError):
        return None
    return (layout["length"] // layout["block"]) / layout["rate"]


def audio_duration(stream, size: int) -> float | None:
    """Seconds of a WAV, FLAC, Ogg (Vorbis, Opus, FLAC) or MPEG audio file; None when unreadable.

    Headers are enough but for MPEG files without a table of their own, whose frames are gone through in
    blocks. An Ogg file's length is in its last page, at most 64 KB before the end.
    """
    try:
        head = stream.read(10)
        start = 0
        if head[:3] == b"ID3":
            # a tag before the audio; its size has seven bits a byte
            start = 10 + (head[6] << 21 | head[7] << 14 | head[8] << 7 | head[9])
            if start >= size:
                return None
            stream.seek(start)
            head = stream.read(4)
        if head[:4] == b"fLaC":
            if start + 26 > size:
                return None
            stream.seek(start + 8)
            return _flac_duration(stream.read(18))
        if frame_header(head[:4]):
            return _mpeg_duration(stream, start, size)
        stream.seek(0)
        if head[:4] == b"OggS":
            return _ogg_duration(stream, size)
        layout = wav_layout(stream, size)
        return (layout["length"] // layout["block"]) / layout["rate"]
    except (ValueError, struct.error, IndexError):
        return None


def _flac_duration(info: bytes) -> float | None:
    """From the first 18 bytes of a STREAMINFO block: 20 bits of rate, 36 bits of samples."""
    packed = struct.unpack(">Q", info[10:18])[0]
    rate, samples = packed >> 44, packed & ((1 << 36) - 1)
    return samples / rate if rate and samples else None


# MPEG audio bit rates in kbit/s by index, for version 1 and layer, else for version 2 and layer.
BIT_RATES = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
# MPEG audio sampling rates by index, halved in version 2 and again in 2.5.
MPEG_RATES = (44_100, 48_000, 32_000)
MPEG_BLOCK = 1 << 18


def frame_header(head: bytes) -> tuple[tuple[int, int, int], int, int, bool] | None:
    """Kind (version, layer, rate), samples and bytes of an MPEG audio frame, and whether it is mono."""
    if len(head) < 4 or head[0] != 0xFF or head[1] & 0xE0 != 0xE0:
        return None
    code, layer = head[1] >> 3 & 3, 4 - (head[1] >> 1 & 3)
    bits, rate, padded = head[2] >> 4, head[2] >> 2 & 3, head[2] >> 1 & 1
    if code == 1 or layer == 4 or bits in (0, 15) or rate == 3:
        return None
    version = 1 if code == 3 else 2
    hertz = MPEG_RATES[rate] >> {3: 0, 2: 1, 0: 2}[code]
    speed = BIT_RATES[version, layer][bits] * 1000
    samples = 384 if layer == 1 else 576 if layer == 3 and version == 2 else 1152
    size = (12 * speed // hertz + padded) * 4 if layer == 1 else samples // 8 * speed // hertz + padded
    return (code, layer, hertz), samples, size, head[3] >> 6 == 3


def _mpeg_duration(stream, start: int, size: int) -> float | None:
    """From the frame count of a Xing, Info or VBRI table in the first frame, else by counting whole frames.

    The first frame must be followed by another of its kind, by a tag or by the end. Bytes between frames
    that are none are skipped.
    """
    block, at_block = b"", 0

    def ahead(at: int, n: int) -> bytes:
        nonlocal block, at_block
        if not at_block <= at <= at + n <= at_block + len(block):
            stream.seek(at)
            block, at_block = stream.read(min(MPEG_BLOCK, size - at)), at
        return block[at - at_block:at - at_block + n]

    kind, samples, length, mono = frame_header(ahead(start, 4))
    hertz = kind[2]
    first = ahead(start, min(length, size - start))
    side = (17 if mono else 32) if kind[0] == 3 else (9 if mono else 17)
    xing, vbri = first[4 + side:][:12], first[36:][:18]
    if xing[:4] in (b"Xing", b"Info") and len(xing) == 12 and xing[7] & 1:
        return struct.unpack(">I", xing[8:12])[0] * samples / hertz
    if vbri[:4] == b"VBRI" and len(vbri) == 18:
        return struct.unpack(">I", vbri[14:18])[0] * samples / hertz
    after = ahead(start + length, 4) if start + length < size else b""
    follows = frame_header(after)
    if start + length > size or after and after[:3] not in (b"TAG", b"APE") and not (follows and follows[0] == kind):
        return None
    at, total = start, 0
    while at + 4 <= size:
        found = frame_header(ahead(at, 4))
        if found and found[0] == kind:
            total += found[1] if at + found[2] <= size else 0
            at += found[2]
        else:
            rest = ahead(at + 1, min(MPEG_BLOCK, size - at - 1))
            step = rest.find(b"\xff")
            at += 1 + (step if step >= 0 else len(rest))
    return total / hertz


OGG_PAGE = 65_307


def _ogg_duration(stream, size: int) -> float | None:
    first = stream.read(min(size, OGG_PAGE))
    serial, body = first[14:18], first[27 + first[26]:]
    skip = 0
    if body[:7] == b"\x01vorbis":
        rate = struct.unpack("<I", body[12:16])[0]
    elif body[:8] == b"OpusHead":
        rate, skip = 48_000, struct.unpack("<H", body[10:12])[0]
    elif body[:5] == b"\x7fFLAC":
        rate = struct.unpack(">Q", body[27:35])[0] >> 44
    else:
        return None
    stream.seek(max(0, size - OGG_PAGE))
    tail = stream.read(OGG_PAGE)
    at = tail.rfind(b"OggS")
    while at >= 0:
        if tail[at + 14:at + 18] == serial:
            position = struct.unpack("<q", tail[at + 6:at + 14])[0]
            if position >= 0:
                return max(position - skip, 0) / rate if rate else None
        at = tail.rfind(b"OggS", 0, at)
    return None


class OutOfReach(Exception):
    """Bytes between the ends were asked for."""


class Ends:
    """A file of which only the first and the last bytes are at hand, to be read like an open one."""

    def __init__(self, head: bytes, tail: bytes, size: int):
        self.head, self.tail, self.size, self.at = head, tail, size, 0

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, n: int) -> bytes:
        at, end = self.at, min(self.at + n, self.size)
        self.at = max(at, end)
        if end <= len(self.head):
            return self.head[at:end]
        begin = self.size - len(self.tail)
        if at < begin:
            raise OutOfReach
        return self.tail[at - begin:end - begin]


def wav_samples(content: pa.Buffer) -> tuple[np.ndarray, int]:
    """Mono samples in [-1, 1] and the sampling rate; channels are averaged."""
    try:
        layout = wav_layout(pa.BufferReader(content), content.size)
    except struct.error as e:
        raise UnreadableAudio(str(e)) from e
    frames = layout["length"] // layout["block"]
    raw = np.frombuffer(content, np.uint8, frames * layout["block"], layout["start"])
    return mono_frames(raw, layout), layout["rate"]


def mono_frames(raw: np.ndarray, layout: dict) -> np.ndarray:
    """Samples of whole frames, given as bytes."""
    frames = len(raw) // layout["block"]
    code, bits = layout["code"], layout["bits"]
    if layout["block"] != layout["channels"] * bits // 8:
        raise UnreadableAudio("block size does not fit the sample size")
    if code == PCM and bits == 8:
        x = (raw.astype(np.float64) - 128.0) / 128.0
    elif code == PCM and bits == 16:
        x = raw.view("<i2") / 32768.0
    elif code == PCM and bits == 24:
        b = raw.reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / 8388608.0
    elif code == PCM and bits == 32:
        x = raw.view("<i4") / 2147483648.0
    elif code == IEEE_FLOAT and bits == 32:
        x = raw.view("<f4").astype(np.float64)
    else:
        raise UnreadableAudio(f"unsupported sample format {code}/{bits}")
    return x.reshape(frames, layout["channels"]).mean(axis=1)


def pcm16(samples: np.ndarray) -> bytes:
    """16-bit samples; values outside [-1, 1] are clipped."""
    scaled = np.clip(np.rint(np.asarray(samples, np.float64) * 0x7FFFFFFF), -(2**31), 2**31 - 1)
    return (scaled.astype(np.int64) >> 16).astype("<i2").tobytes()


def wav_head(n_samples: int, rate: int) -> bytes:
    """Header of a one-channel PCM16 WAV file; sizes that its fields can't hold are given as the largest."""
    size = 2 * n_samples
    fmt = struct.pack("<HHIIHH", PCM, 1, rate, rate * 2, 2, 16)
    return (
        b"RIFF" + struct.pack("<I", min(36 + size, 0xFFFFFFFF)) + b"WAVE"
        + b"fmt " + struct.pack("<I", 16) + fmt
        + b"data" + struct.pack("<I", min(size, 0xFFFFFFFF))
    )


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """One-channel PCM16 WAV file; values outside [-1, 1] are clipped."""
    return wav_head(len(samples), rate) + pcm16(samples)


def resampled_blocks(stream, layout: dict, target: int, block: int = 1 << 20, margin: int = 1 << 14):
    """Samples at ``target`` of an open WAV file, block by block, so that a file of any size will do.

    A block is resampled together with ``margin`` frames on either side, whose results are dropped;
    their outer half fades out, so that a block's ends don't ring.
    """
    rate, step = layout["rate"], layout["block"]
    shared = int(np.gcd(rate, target))
    m, up = rate // shared, target // shared
    frames = layout["length"] // step
    block, margin = max(block // m, 1) * m, -(-margin // m) * m
    n_out = resampled_length(frames, rate, target)
    for begin in range(0, frames, block):
        lo, hi = max(begin - margin, 0), min(begin + block + margin, frames)
        stream.seek(layout["start"] + lo * step)
        x = mono_frames(np.frombuffer(stream.read((hi - lo) * step), np.uint8), layout)
        fade = np.sin(np.linspace(0, np.pi / 2, margin // 2)) ** 2
        if lo and len(x) > margin:
            x[:len(fade)] *= fade
        if hi < frames and len(x) > margin:
            x[-len(fade):] *= fade[::-1]
        x = np.concatenate([x, np.zeros(-len(x) % m)])
        y = fourier_resample(x, len(x) // m * up)
        at, end = lo // m * up, min((begin + block) // m * up, n_out)
        yield y[begin // m * up - at:end - at]


def fourier_resample(samples: np.ndarray, n_out: int) -> np.ndarray:
    """Band-limited resampling to ``n_out`` points by cutting or padding the spectrum."""
    n_in = len(samples)
    if n_out == n_in or n_in == 0:
        return np.asarray(samples, np.float64)
    if n_out == 0:
        return np.zeros(0)
    spectrum = np.fft.rfft(samples)
    shorter = min(n_in, n_out)
    bins = np.zeros(n_out // 2 + 1, complex)
    bins[: shorter // 2 + 1] = spectrum[: shorter // 2 + 1]
    if shorter % 2 == 0:
        # the bin at half the lower rate stands for both signs of that frequency
        bins[shorter // 2] *= 2.0 if n_out < n_in else 0.5
    return np.fft.irfft(bins, n_out) * (n_out / n_in)


def resampled_length(n_in: int, rate: int, target: int, round_up: bool = True) -> int:
    exact = n_in * target / rate
    return int(np.ceil(exact)) if round_up else int(exact)
