"""Copies among images in a media column, by local descriptors.

1. Images (PNG, or PGM/PPM) are decoded to grey pixels. Equal pixels are one
   class; its smallest identifier represents it. So are equal bytes of media
   that cannot be decoded.
2. On a pyramid of scales, each FACTOR of the one before and down to the size of
   a patch, Harris corners are found: those that are the strongest within APART
   pixels, so that their number grows with the area, whatever is shown. Each gets
   an orientation (its patch's centroid of brightness) and 256 binary brightness
   tests turned by it. Brightness and contrast edits leave the tests as they are.
3. A descriptor enters TABLES Hamming tables, keyed by KEY of its bits. SKETCHES pairs
   of an image's entries, those of smallest hash, bring together images that share
   many: each is compared with one other, which connects nearly all of a group of
   copies. Then all entries are filled in, and descriptors of an entry that belong
   to images that are not connected yet are compared: images are candidates
   if they have one pair of descriptors there that differ in at most NEAR bits, or
   two pairs in at most HINT. Where a descriptor has more than COUNTERPARTS such
   counterparts (a logo), pairs are not listed: the images' blocks are compared
   (see linking).
4. A candidate pair is linked by geometric consensus: a similarity transform
   must map enough corners of one image onto alike corners of the other.

Step 3 may miss links; tests measure the share that is found for each kind of edit.

Defined results
* null or empty media: no corners, a class of its own, no links. Broken or
  unknown media (JPEG, GIF, WebP, interlaced PNG, more than PIXELS pixels): no
  corners, a class with equal bytes only, no links. No media fail the job.
* images without corners (flat, very small): linked with equal pixels only.
* null identifiers: class null. Repeated rows: equal pixels, so one class.
* very large images: all of their corners; nothing is reduced. Empty table: empty
  result. Other columns: ignored.
"""

from __future__ import annotations

import functools
import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, release, staged
from .linking import connect, labelled, popularity, shared_buckets, stars

#: Ratio of the pyramid's scales, pixels between corners, radius of a patch, tests, the extent of tests along the
#: patch's orientation, and the turns that a patch may have.
FACTOR, APART, RADIUS, TESTS, ACROSS, TURNS = 0.84, 4, 8, 256, 0.7, 64
#: Hamming tables, bits of a key, and entries of an image in the first comparison.
TABLES, KEY, SKETCHES = 12, 24, 16
#: Bits in which descriptors may differ: for one pair to make a candidate, for two pairs, and for matching corners.
NEAR, HINT, ALIKE = 20, 32, 40
#: Pixels by which a mapped corner may miss, and corners that a link needs.
MISS, INLIERS = 3.0, 8
#: Images of more pixels are not decoded; a worker holds one image at a time.
PIXELS = 1 << 27

#: Hamming tables that are filled at a time: their entries are what takes disk.
AT_ONCE = 2
#: Images that a worker describes or takes apart before it hands them on.
PORTION = 256
#: Pixels of images that are described together.
TOGETHER = 1 << 20
#: Identifiers at most that are broadcast.
FEW = 1 << 20
#: Alike descriptors of other components in an entry, up to which a descriptor's pairs are listed.
COUNTERPARTS = 1024
#: Pairs that are compared at a time, for each core.
PAIRS_A_CORE = 8192
#: Entries of one bucket up to which all pairs are compared at once.
SHORT = 64
#: Entries of one bucket that a worker holds; of larger ones all images go to linking's blocks.
HELD = 200_000

_random = np.random.default_rng(7)
_POINTS = _random.normal(0, RADIUS / 2.2, (TESTS, 2, 2))
# patches get brighter along their orientation: tests across it tell them apart, tests along it have the same result in most
_POINTS[:, :, 0] = _POINTS[:, :, 0].mean(axis=1, keepdims=True) + ACROSS * (_POINTS[:, :, 0] - _POINTS[:, :, 0].mean(axis=1, keepdims=True))
_POINTS *= np.minimum(1, (RADIUS - 0.5) / np.linalg.norm(_POINTS, axis=2))[:, :, None]  # turned points stay in the patch
_PAIRS = _POINTS.reshape(TESTS, 4)
_KIND = np.dtype([("x", "f4"), ("y", "f4"), ("scale", "f4"), ("angle", "f4"), ("bits", "u1", 32)])
_Y, _X = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1]
_DISK = (_X**2 + _Y**2) <= RADIUS**2


def _turned(step: int) -> np.ndarray:
    """The tests' offsets (x, y, x, y), turned by step of TURNS steps, so that quarter turns are exact."""
    c, s = np.cos(step * 2 * np.pi / TURNS), np.sin(step * 2 * np.pi / TURNS)
    a, b, p, q = _PAIRS.T
    return np.rint(np.stack([c * a - s * b, s * a + c * b, c * p - s * q, s * p + c * q])).astype(int)


_TURNS = np.stack([_turned(step) for step in range(TURNS)])
#: The tests' two places in a flattened patch, for each turn, and the weights of its brightness about its middle.
_PLACES = np.stack([(_TURNS[:, 1] + RADIUS) * (2 * RADIUS + 1) + _TURNS[:, 0] + RADIUS, (_TURNS[:, 3] + RADIUS) * (2 * RADIUS + 1) + _TURNS[:, 2] + RADIUS], axis=1)
_MOMENTS = np.stack([(_X * _DISK).ravel(), (_Y * _DISK).ravel()], axis=1).astype(np.float32)


def decode(media: bytes | None) -> np.ndarray | None:
    """Grey pixels of a PNG (not interlaced) or of a binary PGM or PPM; None for anything else, whatever is wrong with it."""
    try:
        if media and media[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(media)
        if media and media[:2] in (b"P5", b"P6"):
            return _pnm(media)
    except (ValueError, TypeError, LookupError, ArithmeticError, struct.error, zlib.error):
        pass
    return None


def _pnm(media: bytes) -> np.ndarray | None:
    fields, at = [], 2
    while len(fields) < 3:
        while media[at : at + 1].isspace():
            at += 1
        if at >= len(media):
            return None
        if media[at : at + 1] == b"#":
            at = media.index(b"\n", at)
            continue
        end = at
        while end < len(media) and not media[end : end + 1].isspace():
            end += 1
        fields.append(int(media[at:end]))
        at = end
    width, height, top = fields
    depth = 3 if media[1:2] == b"6" else 1
    if not 0 < top < 65536 or min(width, height) < 1 or width * height > PIXELS:
        return None
    kind = np.dtype(">u2" if top > 255 else "u1")
    raw = np.frombuffer(media, kind, width * height * depth, at + 1).reshape(height, width, depth)
    return _grey(raw if top == 255 else raw.astype(np.float32) * (255 / top))


def _grey(raw: np.ndarray) -> np.ndarray:
    if raw.shape[2] < 3:
        return raw[:, :, 0].astype(np.float32)
    return (raw[:, :, :3] @ np.array([0.299, 0.587, 0.114], np.float32)).astype(np.float32)


def _png(media: bytes) -> np.ndarray | None:
    at, parts, palette, head = 8, [], None, None
    while at + 8 <= len(media):
        size, kind = struct.unpack(">I4s", media[at : at + 8])
        body = media[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            parts.append(body)
        at += size + 12
    if head is None or head[6] or min(head[:2]) < 1 or head[0] * head[1] > PIXELS:
        return None
    width, height, deep, depth = head[0], head[1], head[2], {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[head[3]]
    if deep not in (1, 2, 4, 8, 16) or deep < 8 and depth > 1 or head[3] == 3 and palette is None:
        return None
    step, line = max(1, depth * deep // 8), -(-width * depth * deep // 8)
    want = height * (1 + line)
    data = zlib.decompressobj().decompress(b"".join(parts), want)  # no more than the header says
    rows = np.frombuffer(data, np.uint8, want).reshape(height, 1 + line)
    out, before = np.empty((height, line), np.uint8), bytes(line)
    for y in range(height):
        before = _unfiltered(int(rows[y, 0]), rows[y, 1:], before, step)
        out[y] = np.frombuffer(before, np.uint8)
    if deep == 16:
        out = out[:, ::2]  # the high bytes
    elif deep < 8:
        out = (np.unpackbits(out, axis=1).reshape(height, -1, deep) @ (1 << np.arange(deep)[::-1])).astype(np.uint8)[:, :width]
        if head[3] == 0:
            out = out * (255 // ((1 << deep) - 1))
    out = out.reshape(height, width, depth)
    return _grey(palette[out[:, :, 0]] if head[3] == 3 else out)


def _unfiltered(kind: int, row: np.ndarray, before: bytes, step: int) -> bytes:
    """A line of a PNG without its filter."""
    if kind == 0:
        return row.tobytes()
    if kind == 2:
        return (row + np.frombuffer(before, np.uint8)).tobytes()
    if kind == 1:
        whole = np.concatenate([row, np.zeros(-len(row) % step, np.uint8)])
        return np.add.accumulate(whole.reshape(-1, step), axis=0, dtype=np.uint8).tobytes()[: len(row)]
    line = bytearray(row.tobytes())
    if kind == 3:
        for i, b in enumerate(before):
            line[i] = line[i] + ((line[i - step] if i >= step else 0) + b >> 1) & 255
        return bytes(line)
    if kind != 4:
        raise ValueError("no such filter")
    for i in range(min(step, len(line))):
        line[i] = line[i] + before[i] & 255
    for i in range(step, len(line)):
        a, b, c = line[i - step], before[i], before[i - step]
        p, q = b - c, a - c
        to_a, to_b, to_c = abs(p), abs(q), abs(p + q)
        line[i] = line[i] + (a if to_a <= to_b and to_a <= to_c else b if to_b <= to_c else c) & 255
    return bytes(line)


def _box(image: np.ndarray, radius: int) -> np.ndarray:
    """Means over squares of the last two axes, edges repeated."""
    out, size = image, 2 * radius + 1
    for axis in (-2, -1):
        pad = [(0, 0)] * (out.ndim + axis) + [(radius, radius)] + [(0, 0)] * (-1 - axis)
        wide, n = np.pad(out, pad, mode="edge"), out.shape[axis]
        cuts = [wide[(..., slice(k, k + n)) + (slice(None),) * (-1 - axis)] for k in range(size)]
        out = functools.reduce(np.add, cuts)
    return out * np.float32(1 / size**2)


def _scaled(image: np.ndarray, scale: float) -> np.ndarray:
    """Bilinear reduction of the last two axes."""
    if scale == 1:
        return image
    h, w = (max(1, round(x * scale)) for x in image.shape[-2:])
    y, x = (np.arange(h) + 0.5) / scale - 0.5, (np.arange(w) + 0.5) / scale - 0.5
    y, x = y.clip(0, image.shape[-2] - 1), x.clip(0, image.shape[-1] - 1)
    y0, x0 = np.minimum(y.astype(int), max(0, image.shape[-2] - 2)), np.minimum(x.astype(int), max(0, image.shape[-1] - 2))
    y1, x1 = np.minimum(y0 + 1, image.shape[-2] - 1), np.minimum(x0 + 1, image.shape[-1] - 1)
    fy, fx = (y - y0).astype(np.float32)[:, None], (x - x0).astype(np.float32)[None, :]
    low, high = image[..., y0, :], image[..., y1, :]
    rows = low + fy * (high - low)
    left, right = rows[..., x0], rows[..., x1]
    return (left + fx * (right - left)).astype(np.float32)


def _strongest(values: np.ndarray, radius: int) -> np.ndarray:
    """The largest value within radius of each place, in either direction; by windows of twice the size each time."""
    size = 2 * radius + 1
    for axis in (-2, -1):
        pad = [(0, 0)] * (values.ndim + axis) + [(radius, radius)] + [(0, 0)] * (-1 - axis)
        values, wide = np.pad(values, pad, constant_values=-np.inf), 1
        while wide < size:
            by = min(wide, size - wide)
            tail = (slice(None),) * (-1 - axis)
            values = np.maximum(values[(..., slice(0, -by), *tail)], values[(..., slice(by, None), *tail)])
            wide += by
    return values


def describe(image: np.ndarray | None) -> np.ndarray:
    """Corners as records: x, y, scale, angle, bits (32 bytes)."""
    return np.empty(0, _KIND) if image is None else describe_all(image[None])[0]


def describe_all(images: np.ndarray) -> list[np.ndarray]:
    """The corners of each of several images of one size."""
    parts, scale = [], 1.0
    while True:
        level = _box(_scaled(images, scale), 1)
        _, h, w = level.shape
        if min(h, w) < 2 * RADIUS + 3:
            break
        gy, gx = np.gradient(level, axis=(1, 2))
        a, b, c = _box(gx * gx, 2), _box(gy * gy, 2), _box(gx * gy, 2)
        strength = a * b - c * c - np.float32(0.05) * (a + b) ** 2
        inner, top = (x[:, RADIUS : h - RADIUS, RADIUS : w - RADIUS] for x in (strength, _strongest(strength, APART)))
        where, ys, xs = np.nonzero((inner == top) & (inner > 1.0))
        parts.append((where, _tested(level, where, ys + RADIUS, xs + RADIUS, scale)))
        scale *= FACTOR
    if not parts:
        return [np.empty(0, _KIND)] * len(images)
    where, found = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(where, kind="stable")
    return np.split(found[order], np.searchsorted(where[order], np.arange(1, len(images))))


def _tested(level: np.ndarray, where: np.ndarray, ys: np.ndarray, xs: np.ndarray, scale: float) -> np.ndarray:
    """The corners at these places of a level, some thousand at a time."""
    out = np.empty(len(ys), _KIND)
    for k in range(0, len(ys), 2048):
        n, y, x = where[k : k + 2048], ys[k : k + 2048], xs[k : k + 2048]
        patches = level[n[:, None, None], y[:, None, None] + _Y, x[:, None, None] + _X].reshape(len(n), -1)
        moments = patches @ _MOMENTS
        angle = np.arctan2(moments[:, 1], moments[:, 0])
        turn = np.rint(angle * TURNS / (2 * np.pi)).astype(int) % TURNS
        first, second = (_PLACES[turn, side] for side in (0, 1))
        bits = np.take_along_axis(patches, first, axis=1) < np.take_along_axis(patches, second, axis=1)
        part = out[k : k + 2048]
        part["x"], part["y"], part["scale"], part["angle"] = (x + 0.5) / scale, (y + 0.5) / scale, scale, angle
        part["bits"] = np.packbits(bits, axis=1)
    return out


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which descriptors differ."""
    return np.bitwise_count(a[:, None, :].copy().view("<u8") ^ b[None, :, :].copy().view("<u8")).sum(axis=2, dtype=np.int32)


def _matches(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of corners of the smaller image that have alike ones in the other, and of the most alike there."""
    if len(a) > len(b):
        j, i = _matches(b, a)
        return i, j
    best, at = np.full(len(a), ALIKE + 1), np.zeros(len(a), np.intp)
    for k, m in itertools.product(range(0, len(a), 1024), range(0, len(b), 1024)):
        differ = _differ(a["bits"][k : k + 1024], b["bits"][m : m + 1024])
        least, rows = differ.argmin(axis=1), slice(k, k + differ.shape[0])
        bits = differ[np.arange(len(least)), least]
        at[rows] = np.where(bits < best[rows], least + m, at[rows])
        best[rows] = np.minimum(best[rows], bits)
    i = np.flatnonzero(best <= ALIKE)
    return i, at[i]


def _enough(a: np.ndarray, b: np.ndarray, inliers: int) -> bool:
    """Whether enough corners have alike ones, as consensus needs."""
    return len(_matches(a, b)[0]) >= inliers


def consensus(a: np.ndarray, b: np.ndarray, enough: int | None = None) -> int:
    """The most corners that one similarity transform maps onto alike corners of the other image, less four times those
    that chance would bring there; with `enough`, the search ends at that number.
    """
    i, j = _matches(a, b)
    if not len(i) or enough is not None and len(i) < enough:
        return 0
    p, q = a["x"][i] + 1j * a["y"][i], b["x"][j] + 1j * b["y"][j]
    room = max(1.0, *(float(np.ptp(x["x"])) * float(np.ptp(x["y"])) for x in (a, b)))
    chance = int(4 * len(i) * np.pi * MISS**2 / room)
    turn = a["scale"][i] / b["scale"][j] * np.exp(1j * (b["angle"][j] - a["angle"][i]))
    best = 0
    for k in range(len(i)):
        # the match's own turn is coarse: a second match of the same scale refines it
        off = np.abs(turn[k] * (p - p[k]) + q[k] - q)
        near = off <= MISS + 0.15 * np.abs(p - p[k])
        if near.sum() <= best:
            continue
        far = np.argmax(np.where(near, np.abs(p - p[k]), -1))
        fine = (q[far] - q[k]) / (p[far] - p[k]) if p[far] != p[k] else turn[k]
        hit = near & (np.abs(fine * (p - p[k]) + q[k] - q) <= MISS)
        best = max(best, min(len(set(p[hit])), len(set(q[hit]))))
        if enough is not None and best >= enough + chance:
            break
    return max(0, best - chance)


_BITS = [np.random.default_rng(1000 + number).permutation(TESTS)[:KEY] for number in range(TABLES)]
_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, 2 * SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def table_keys(bits: np.ndarray, number: int) -> np.ndarray:
    """The entries of descriptors in a Hamming table: KEY of their bits and the table's number."""
    at = _BITS[number]
    picked = bits[:, at // 8] >> (7 - at % 8).astype(np.uint8) & 1
    return picked.astype(np.int64) @ (1 << np.arange(KEY, dtype=np.int64)) | number << KEY


def sketch(bits: np.ndarray) -> np.ndarray:
    """For each of SKETCHES pairs of hashes the smallest two over the entries of an image's descriptors, with the pair's number."""
    if not len(bits):
        return np.empty(0, np.int64)
    keys = np.concatenate([table_keys(bits, number) for number in range(TABLES)]).astype(np.uint64)
    mixed = (keys ^ keys >> np.uint64(17)) * np.uint64(0x9E3779B97F4A7C15)
    low = ((mixed ^ mixed >> np.uint64(29))[:, None] * _SEEDS[None, :]).min(axis=0)
    low = (low[::2] ^ low[1::2] >> np.uint64(9)) * np.uint64(0x9E3779B97F4A7C15)
    return (low >> np.uint64(5) | np.arange(SKETCHES, dtype=np.uint64) << np.uint64(59)).astype(np.int64)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, len(batch), PORTION):
            yield batch.slice(k, PORTION)


def _corners_of(media: list[bytes | None]) -> Iterator[tuple[np.ndarray | None, np.ndarray]]:
    """Pixels and corners of each; runs of images of one size go together, up to some million pixels."""
    same: list[np.ndarray] = []
    for image in itertools.chain(map(decode, media), [...]):
        if same and (image is None or image is ... or image.shape != same[0].shape or (len(same) + 1) * image.size > TOGETHER):
            yield from zip(same, describe_all(np.stack(same)), strict=True)
            same = []
        if image is None:
            yield None, np.empty(0, _KIND)
        elif image is not ...:
            same.append(image)


def _described(media: DataFrame, id_col: str, media_col: str) -> DataFrame:
    kind = media.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            media = batch.column(1).to_pylist()
            pixels, corners, sketches = [], [], []
            for value, (image, found) in zip(media, _corners_of(media), strict=True):
                said = b"raw" + (value or b"") if image is None else str(image.shape).encode() + image.tobytes()
                pixels.append(None if said == b"raw" else xxhash.xxh3_128_digest(said))
                corners.append(found.tobytes())
                sketches.append(sketch(found["bits"]))
            n = pa.array([len(x) // _KIND.itemsize for x in corners], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n, pa.array(pixels, pa.binary()), pa.array(corners, pa.binary()), pa.array(sketches, pa.list_(pa.int64()))], ["_id", "_n", "_pixels", "_corners", "_sketch"]
            )

    rows = media.select(F.col(id_col).alias("_id"), F.col(media_col).alias("_media"))
    return rows.mapInArrow(run, f"_id {kind}, _n bigint, _pixels binary, _corners binary, _sketch array<bigint>")


_WORDS = ["_w0", "_w1", "_w2", "_w3"]


def _entries(own: DataFrame, numbers: list[int]) -> DataFrame:
    """_bucket, _label, _w0 .. _w3 (the descriptor), _id: the entries of the images' corners in these Hamming tables."""
    kind = own.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            each = [_corner_array(v.as_py())["bits"] for v in batch.column(2)]
            where = pa.array(np.repeat(np.arange(len(each)), [len(x) for x in each]))
            bits = np.ascontiguousarray(np.concatenate(each)) if each else np.empty((0, TESTS // 8), np.uint8)
            words = [pa.array(x) for x in np.ascontiguousarray(bits.view("<i8").T)]
            ids, labels = batch.column(0).take(where), batch.column(1).take(where)
            for number in numbers:
                yield pa.RecordBatch.from_arrays([pa.array(table_keys(bits, number)), labels, *words, ids], ["_bucket", "_label", *_WORDS, "_id"])

    schema = f"_bucket bigint, _label bigint, {', '.join(f'{w} bigint' for w in _WORDS)}, _id {kind}"
    return own.select("_id", F.xxhash64("_label").alias("_label"), "_corners").mapInArrow(run, schema)


def _runs(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])) if len(buckets) else np.empty(0, np.intp)
    return starts, np.append(starts[1:], len(buckets)).astype(np.intp)


def entry_votes(buckets: np.ndarray, labels: np.ndarray, words: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], list[tuple[int, np.ndarray]]]:
    """Of whole buckets, sorted: (places, places, bits that differ) of alike descriptors with different labels, and (bucket, places) of those with too many counterparts, these included."""
    starts, ends = _runs(buckets)
    if not len(starts):
        return [], []
    mixed = (ends - starts > 1) & (np.minimum.reduceat(labels, starts) != np.maximum.reduceat(labels, starts))
    votes, crowds = [], []
    few = mixed & (ends - starts <= SHORT)
    at = np.flatnonzero(np.repeat(few, ends - starts))
    for step in range(1, SHORT):
        if len(at) <= step:
            break
        i, j = at[:-step], at[step:]
        held = buckets[i] == buckets[j]
        if not held.any():
            break
        votes.append(_compared(i[held], j[held], labels, words))
    for start, end in zip(starts[mixed & ~few], ends[mixed & ~few], strict=True):
        i, j, bits = _all_alike(labels[start:end], words[start:end])
        many = np.bincount(np.concatenate([i, j]), minlength=end - start) > COUNTERPARTS
        crowd = many[i] | many[j]
        votes.append((start + i[~crowd], start + j[~crowd], bits[~crowd]))
        if crowd.any():
            crowds.append((int(buckets[start]), start + np.unique(np.concatenate([i[crowd], j[crowd]]))))
    return votes, crowds


def _all_alike(labels: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The alike pairs of a bucket with different labels: those that are not of the commonest label against all."""
    _, which, counts = np.unique(labels, return_inverse=True, return_counts=True)
    words = np.asfortranarray(words)
    left = np.flatnonzero(which != counts.argmax())
    out = [np.empty((3, 0), np.intp)]
    for k in range(0, len(left), step := max(1, (1 << 20) // len(labels))):
        i = left[k : k + step]
        bits = functools.reduce(np.add, [np.bitwise_count(words[i, w][:, None] ^ words[None, :, w]).astype(np.uint16) for w in range(words.shape[1])])
        # both of two that are not of the commonest label see each other: the first counts
        seen = (bits <= HINT) & (which[i][:, None] != which[None, :]) & ((which == counts.argmax())[None, :] | (i[:, None] < np.arange(len(labels))[None, :]))
        x, y = np.nonzero(seen)
        out.append(np.stack([i[x], y, bits[x, y]]))
    i, j, bits = np.concatenate(out, axis=1)
    return i, j, bits.astype(np.int32)


def _compared(i: np.ndarray, j: np.ndarray, labels: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    apart = labels[i] != labels[j]
    i, j = i[apart], j[apart]
    bits = np.bitwise_count(words[i] ^ words[j]).sum(axis=1, dtype=np.int32)
    return i[bits <= HINT], j[bits <= HINT], bits[bits <= HINT]


def packed_votes(x: np.ndarray, y: np.ndarray, bits: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """A vote for a pair of images as one number: what stands for the two descriptors, 32 bits of each, the first image's above."""
    low = [(w ^ w >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32) for w in (np.where(turned, y, x), np.where(turned, x, y))]
    return (low[0] << np.uint64(32) | low[1]).view(np.int64)


def _votes(entries: DataFrame) -> DataFrame:
    """_bucket (null for votes), _a, _b (null for members of crowds), _vote (see packed_votes; two for a pair that is a candidate by one)."""
    kind = entries.schema["_id"].dataType.simpleString()
    names = ["_bucket", "_a", "_b", "_vote"]

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        buckets, labels = (table.column(c).to_numpy() for c in ("_bucket", "_label"))
        words = np.stack([table.column(c).to_numpy() for c in _WORDS], axis=1).view(np.uint64)
        votes, crowds = entry_votes(buckets, labels, words)
        ids, whole = table.column("_id").combine_chunks(), words[:, 0] ^ words[:, 1] * np.uint64(3) ^ words[:, 2] * np.uint64(5) ^ words[:, 3] * np.uint64(7)
        for i, j, bits in votes:
            if not len(i):
                continue
            a, b = ids.take(pa.array(i)), ids.take(pa.array(j))
            turned = pc.greater(a, b)
            swap = turned.to_numpy(zero_copy_only=False)
            vote = packed_votes(whole[i], whole[j], bits, swap)
            sure = np.flatnonzero(bits <= NEAR)
            at = pa.array(np.concatenate([np.arange(len(i)), sure, sure]))
            vote = np.concatenate([vote, np.full(len(sure), np.iinfo(np.int64).min), np.full(len(sure), np.iinfo(np.int64).max)])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(vote), pa.int64()), pc.if_else(turned, b, a).take(at), pc.if_else(turned, a, b).take(at), pa.array(vote)], names)
        for name, own in crowds:
            yield _crowd(name, ids.take(pa.array(own)), names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, crowded = None, None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                rest = table if rest is None else pa.concat_tables([rest, table])
            if rest is None or not len(rest):
                continue
            buckets = rest.column("_bucket").to_numpy()
            # a bucket may go on in the next batch
            whole = len(rest) if batch is None else int(np.searchsorted(buckets, buckets[-1]))
            done, rest = rest.slice(0, whole), rest.slice(whole)
            if crowded is not None and len(done):
                more = int(np.searchsorted(done.column("_bucket").to_numpy(), crowded, side="right"))
                yield _crowd(crowded, done.column("_id").slice(0, more).combine_chunks(), names)
                done, crowded = done.slice(more), None
            yield from found(done)
            if len(rest) > HELD:
                crowded = int(buckets[-1])
                yield _crowd(crowded, rest.column("_id").combine_chunks(), names)
                rest = None

    dealt = entries.repartition("_bucket").sortWithinPartitions("_bucket")
    return dealt.mapInArrow(run, f"_bucket bigint, _a {kind}, _b {kind}, _vote bigint")


def _crowd(name: int, ids: pa.Array, names: list[str]) -> pa.RecordBatch:
    """The images of a bucket that is too large for votes."""
    ids = pc.unique(ids)
    none = [pa.nulls(len(ids), kind) for kind in (ids.type, pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), name, np.int64)), ids, *none], names)


def _with_labels(own: DataFrame, labels: DataFrame) -> DataFrame:
    """_id, _label, _corners."""
    moved = cut(labels.filter("_node <> _label"))
    few = moved.count() <= FEW
    out = own.join(F.broadcast(moved) if few else moved, F.col("_id") == F.col("_node"), "left").select("_id", F.coalesce("_label", "_id").alias("_label"), "_corners")
    return out if few else staged(out, "image-labelled")


def _met(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The candidate pairs (_a, _b) between components, and the members (_bucket, _id) of crowded buckets, from all tables."""
    parts = []
    for k in range(0, TABLES, AT_ONCE):
        release(own.sparkSession)
        parts.append(staged(_votes(_entries(own, list(range(k, min(k + AT_ONCE, TABLES))))), "image-votes"))
    release(own.sparkSession)
    met = functools.reduce(DataFrame.unionByName, parts)
    # two votes by different descriptors of both images: of the least and the largest, both halves differ
    counted = met.filter("_bucket is null").groupBy("_a", "_b").agg(F.min("_vote").alias("_low"), F.max("_vote").alias("_high"))
    differ = F.col("_low").bitwiseXOR(F.col("_high"))
    pairs = counted.filter((F.shiftrightunsigned(differ, 32) != 0) & (differ.bitwiseAND(F.lit((1 << 32) - 1)) != 0)).select("_a", "_b")
    pairs = cut(pairs)
    release(own.sparkSession)
    return pairs, met.filter("_bucket is not null").select("_bucket", F.col("_a").alias("_id")).distinct()


def _corner_array(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, _KIND)


def possible_pairs(left: list, right: list, inliers: int) -> list[tuple]:
    """Of records (id, label, null, corners), the pairs with different labels; in large buckets those that have corners enough that look alike."""
    out = []
    for a, label, _, load in left:
        for b, other, _, to in right:
            if label != other and (load is None or _enough(_corner_array(load), _corner_array(to), inliers)):
                out.append((a, b))
    return out


def _alike(pairs: DataFrame, own: DataFrame, inliers: int) -> DataFrame:
    """The pairs with geometric consensus."""
    kind = own.schema["_id"].dataType.simpleString()
    ends = cut(pairs.select(F.col("_a").alias("_id")).union(pairs.select(F.col("_b").alias("_id"))).distinct())
    if ends.count() <= FEW:  # the corners of other images stay where they are
        own = own.join(F.broadcast(ends), "_id", "left_semi")
    sides = [own.select(F.col("_id").alias(i), F.col("_corners").alias(c)) for i, c in (("_a", "_ca"), ("_b", "_cb"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [consensus(_corner_array(x.as_py()), _corner_array(y.as_py()), inliers) >= inliers for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select(["_a", "_b"]).filter(pa.array(held, pa.bool_()))

    # corners travel with each pair: so many pairs at a time as each core of the cluster can hold, then their shuffles go
    rounds, out = 1 + pairs.count() // (PAIRS_A_CORE * own.sparkSession.sparkContext.defaultParallelism), []
    for k in range(rounds):
        part = pairs.filter(F.pmod(F.xxhash64("_a", "_b"), F.lit(rounds)) == k)
        both = part.join(sides[0], "_a").join(sides[1], "_b").select("_a", "_b", "_ca", "_cb")
        out.append(both.mapInArrow(run, f"_a {kind}, _b {kind}"))
        if rounds > 1:
            out[-1] = cut(out[-1])
            release(own.sparkSession)
    return functools.reduce(DataFrame.unionByName, out)


def _representatives(shown: DataFrame, classes: DataFrame) -> DataFrame:
    """_id, _corners, _sketch of the classes' representatives with corners."""
    known = shown.filter("_n > 0 and _id is not null")
    narrow = known.select("_id", "_pixels").join(classes, "_pixels")
    # all rows of an identifier but one are left out: it may repeat, and have several pictures
    others = cut(narrow.groupBy("_id").agg(F.min(F.when(F.col("_id") == F.col("_rep"), F.col("_pixels"))).alias("_first"), F.count(F.lit(1)).alias("_times")).filter("_first is null or _times > 1"))
    if others.count() <= FEW:  # the corners stay where they are
        found = known.join(F.broadcast(others), "_id", "left").filter("_times is null or _pixels = _first")
        once = known.join(F.broadcast(others.select("_id")), "_id", "left_anti")
        return once.select("_id", "_corners", "_sketch").unionByName(found.filter("_times is not null").dropDuplicates(["_id"]).select("_id", "_corners", "_sketch"))
    found = known.join(others, "_id", "left").filter("_times is null or _pixels = _first").dropDuplicates(["_id"])
    return staged(found.select("_id", "_corners", "_sketch"), "image-classes")


def image_copies(media: DataFrame, id_col: str, media_col: str, inliers: int = INLIERS) -> DataFrame:
    """One row per input row: id_col, n_corners, class_id (smallest identifier of equal pixels), component_id, n_confirmed.

    component_id: the smallest identifier among images connected by links; n_confirmed: links that were confirmed with
    the row's class, enough to connect its component (pairs that are connected already are not compared).
    """
    shown = staged(_described(media, id_col, media_col), "image-corners")
    classes = cut(shown.filter("_pixels is not null and _id is not null").groupBy("_pixels").agg(F.min("_id").alias("_rep")))
    own = _representatives(shown, classes)
    check = lambda pairs: _alike(pairs, own, inliers)

    def joined(links: DataFrame | None, more: DataFrame) -> DataFrame | None:
        more = cut(more)
        return links if more.isEmpty() else more if links is None else links.unionByName(more)

    sketched = own.select("_id", F.explode("_sketch").alias("_bucket")).withColumn("_pop", F.xxhash64("_id"))
    links = joined(None, check(cut(stars(sketched))))
    labels = labelled(own, links)
    pairs, members = _met(_with_labels(own, labels))
    links = joined(links, check(pairs))
    members = cut(members)
    if not members.isEmpty():
        members = cut(shared_buckets(members))
        popular = cut(popularity(members).withColumn("_class", F.lit(0)))
        load = own.select("_id", F.lit(None).cast("binary").alias("_load"), F.col("_corners").alias("_more"))
        links = connect(members, popular, load, check, lambda _, left, right: possible_pairs(left, right, inliers), links)[1]
    known = classes.withColumn("_component", F.col("_rep")).withColumn("_links", F.lit(0).cast("bigint"))
    if links is not None:
        ends = links.select(F.col("_a").alias("_end")).union(links.select(F.col("_b").alias("_end"))).groupBy("_end").agg(F.count(F.lit(1)).alias("_links"))
        found = labelled(own, links).join(ends, F.col("_node") == F.col("_end"), "left").select("_node", "_label", F.coalesce("_links", F.lit(0)).alias("_links"))
        known = classes.join(found, F.col("_rep") == F.col("_node"), "left").select(
            "_pixels", "_rep", F.coalesce("_label", "_rep").alias("_component"), F.coalesce("_links", F.lit(0)).cast("bigint").alias("_links")
        )
    out = shown.join(known, "_pixels", "left")
    mine = lambda c: F.when(F.col("_id").isNotNull(), F.coalesce(c, "_id"))
    return out.select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_corners"), mine("_rep").alias("class_id"), mine("_component").alias("component_id"), F.coalesce("_links", F.lit(0)).alias("n_confirmed")
    )


def pictures(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A media column for a table of vectors: id_col and media, a PGM that mixes fixed textures by the vector's components."""
    kind = vectors.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([picture(v.as_py()) for v in batch.column(1)], pa.binary())], ["_id", "media"])

    return vectors.select(F.col(id_col).alias("_id"), vector_col).mapInArrow(run, f"_id {kind}, media binary").withColumnRenamed("_id", id_col)


_TEXTURES: dict[int, np.ndarray] = {}


def picture(vector: list[float] | None, side: int = 80) -> bytes | None:
    """A PGM of the sum of the components' textures (smooth noise); null for a null or empty vector."""
    values = np.nan_to_num(np.array([0.0 if x is None else x for x in vector or ()], np.float32))
    if not len(values):
        return None
    for i in range(len(_TEXTURES), len(values)):
        _TEXTURES[i] = _box(_box(np.random.default_rng(i).normal(size=(side, side)).astype(np.float32), 1), 1)
    mixed = sum(v * _TEXTURES[i] for i, v in enumerate(values))
    grey = (128 + 110 * np.tanh(mixed / (mixed.std() + 1e-9) / 1.5)).astype(np.uint8)
    return b"P5 %d %d 255\n" % (side, side) + grey.tobytes()
