"""Image copies: decoding, the links that are found by kind of edit, and media that are none."""

import zlib

import numpy as np

from tripleframe.llm import images, linking

from .data import clashing


def photo(seed, side=96):
    return images._box(images._box(np.random.default_rng(seed).normal(size=(side, side)).astype(np.float32), 1), 1)


def grey(image):
    return (128 + 110 * np.tanh(image / image.std() / 1.5)).clip(0, 255).astype(np.uint8)


def pgm(pixels):
    return b"P5\n# note\n%d %d\n255\n" % pixels.shape[::-1] + np.ascontiguousarray(pixels).tobytes()


def png(pixels):
    import struct

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rgb = np.repeat(pixels[:, :, None], 3, axis=2).reshape(pixels.shape[0], -1)
    rows, before = [], np.zeros(rgb.shape[1], np.uint8)
    for y, row in enumerate(rgb):
        kind = y % 5
        left = np.concatenate([np.zeros(3, np.uint8), row[:-3]])
        corner = np.concatenate([np.zeros(3, np.uint8), before[:-3]])
        if kind == 4:
            a, b, c = left.astype(int), before.astype(int), corner.astype(int)
            pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = np.where((pa <= pb) & (pa <= pc), a, np.where(pb <= pc, b, c))
        else:
            guess = (np.zeros_like(row), left, before, (left.astype(int) + before) // 2)[kind]
        rows.append(bytes([kind]) + (row - guess).astype(np.uint8).tobytes())
        before = row
    head = struct.pack(">IIBBBBB", pixels.shape[1], pixels.shape[0], 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")


def test_decoding():
    pixels = grey(photo(1, 40))[:, :31]
    assert np.array_equal(images.decode(pgm(pixels)), pixels.astype(np.float32))
    assert np.abs(images.decode(png(pixels)) - pixels).max() < 0.01
    assert all(images.decode(x) is None for x in (None, b"", b"P5", b"P5 3 3 255\n12", b"\x89PNG\r\n\x1a\nxx", b"GIF89a", png(pixels)[:60]))


def test_copies_are_found(spark):
    rows, truth = [], {}
    for i in range(12):
        one = grey(photo(i))
        edits = [one, one[8:80, 10:90], (one * 0.7 + 30).astype(np.uint8), np.rot90(one), grey(photo(i) + np.random.default_rng(i).normal(0, 0.02, one.shape))]
        for k, e in enumerate(edits):
            rows.append((10 * i + k, png(e) if k == 2 else pgm(e)))
            truth[10 * i + k] = 10 * i
    rows += [(900, rows[0][1]), (901, None), (902, b"broken"), (903, pgm(np.full((50, 50), 9, np.uint8))), (904, pgm(np.full((50, 50), 9, np.uint8))), (905, pgm(np.ones((3, 3), np.uint8))), (None, rows[0][1])]
    truth |= {900: 0, 901: 901, 902: 902, 903: 903, 904: 903, 905: 905, None: None}
    df = clashing(spark.createDataFrame(rows, "media_id bigint, media binary"))
    out = {r["media_id"]: r for r in images.image_copies(df, "media_id", "media").collect()}
    assert len(out) == len(rows) and out[900]["class_id"] == 0 and out[903]["n_corners"] == 0
    wrong = [i for i, c in truth.items() if out[i]["component_id"] != c]
    assert not wrong
    # brute force over all pairs of representatives links no others
    corners = {i: images.describe(images.decode(m)) for i, m in rows if i is not None}
    ids = [i for i in corners if i is not None and out[i]["class_id"] == i]
    linked = {(a, b) for a in ids for b in ids if a < b and images.consensus(corners[a], corners[b]) >= images.INLIERS}
    assert all(truth[a] == truth[b] for a, b in linked)
    assert images.image_copies(df.limit(0), "media_id", "media").count() == 0


def noisy(pixels, seed, by):
    return (pixels + np.random.default_rng(seed).normal(0, by, pixels.shape)).clip(0, 255).astype(np.uint8)


def turned(pixels, degrees):
    """Turned about the middle, bilinear, grey outside."""
    t, (h, w) = np.deg2rad(degrees), pixels.shape
    y, x = np.mgrid[0:h, 0:w] - np.array([(h - 1) / 2, (w - 1) / 2])[:, None, None]
    x, y = np.cos(t) * x + np.sin(t) * y + (w - 1) / 2, np.cos(t) * y - np.sin(t) * x + (h - 1) / 2
    i, j = y.astype(int).clip(0, h - 2), x.astype(int).clip(0, w - 2)
    fy, fx, image = (y - i).clip(0, 1), (x - j).clip(0, 1), pixels.astype(float)
    out = (1 - fy) * ((1 - fx) * image[i, j] + fx * image[i, j + 1]) + fy * ((1 - fx) * image[i + 1, j] + fx * image[i + 1, j + 1])
    out[(x < 0) | (x > w - 1) | (y < 0) | (y > h - 1)] = 128
    return out.round().astype(np.uint8)


def reduced(pixels, scale):
    return images._scaled(pixels.astype(np.float32), scale).round().astype(np.uint8)


EDITS = {
    "crop": lambda x, i: x[8:, 14:],
    "strong crop": lambda x, i: x[20:76, 16:72],
    "brightness": lambda x, i: (x * 0.7 + 30).astype(np.uint8),
    "noise": lambda x, i: noisy(x, i, 8),
    "few greys": lambda x, i: x // 32 * 32 + 16,
    "10 degrees": lambda x, i: turned(x, 10),
    "45 degrees": lambda x, i: turned(x, 45),
    "scale 0.8": lambda x, i: reduced(x, 0.8),
    "scale 0.7": lambda x, i: reduced(x, 0.7),
}


def test_edited_copies_are_found(spark):
    """Of the pairs that consensus links, over all pairs of 450 images, nine tenths and more are found for every edit; no others are."""
    rows, edit = [], {}
    for k, (name, change) in enumerate(EDITS.items()):
        for i in range(25):
            one, at = grey(photo(100 * k + i)), 100 * k + 2 * i
            rows += [(at, pgm(one)), (at + 1, pgm(change(one, i)))]
            edit[at] = name
    corners = {i: images.describe(images.decode(m)) for i, m in rows}
    ids = sorted(corners)
    links = {(a, b) for a in ids for b in ids if a < b and images.consensus(corners[a], corners[b], images.INLIERS) >= images.INLIERS}
    assert all(a in edit and b == a + 1 for a, b in links)
    assert all(images.consensus(corners[a], corners[b]) >= images.INLIERS for a, b in links)
    out = images.image_copies(spark.createDataFrame(rows, "media_id bigint, media binary"), "media_id", "media").collect()
    found = {(r["component_id"], r["media_id"]) for r in out if r["component_id"] != r["media_id"]}
    assert found <= links
    share = {name: (sum(edit[a] == name for a, _ in found), sum(edit[a] == name for a, _ in links)) for name in EDITS}
    print(share)
    assert all(n >= 0.9 * m and m >= 20 for n, m in share.values()), share


def test_a_crop_of_a_large_image_is_found(spark):
    whole = grey(photo(5, 1300))
    rows = [(1, pgm(whole)), (2, pgm(whole[700:1000, 500:800])), (3, pgm(grey(photo(6, 300))))]
    out = images.image_copies(spark.createDataFrame(rows, "media_id bigint, media binary"), "media_id", "media").collect()
    assert {r["media_id"]: r["component_id"] for r in out} == {1: 1, 2: 1, 3: 3}


def test_bad_media_fail_no_job(spark):
    import struct

    good = png(grey(photo(1, 40)))
    head = struct.pack(">IIBBBBB", 40, 40, 8, 3, 0, 0, 0)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + b"crc "
    bare = good[:8] + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(bytes(41 * 40)))  # a palette image without one
    bomb = good[:8] + chunk(b"IHDR", struct.pack(">IIBBBBB", 8, 8, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(bytes(50_000_000)))
    huge = good[:8] + chunk(b"IHDR", struct.pack(">IIBBBBB", 1 << 20, 1 << 20, 8, 0, 0, 0, 0)) + chunk(b"IDAT", b"")
    odd = good[:8] + chunk(b"IHDR", struct.pack(">IIBBBBB", 8, 8, 8, 9, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(bytes(72)))
    assert images.decode(bare) is None and images.decode(huge) is None and images.decode(odd) is None
    assert images.decode(bomb).shape == (8, 8)
    cut_short = [good[:n] for n in range(0, len(good), 97)]
    rows = list(enumerate([bare, huge, odd, bomb, *cut_short, b"P5 9999999999 9999999999 255\n", b"P6 x y z\n", bytes(100)]))
    out = images.image_copies(spark.createDataFrame(rows, "media_id bigint, media binary"), "media_id", "media").collect()
    assert len(out) == len(rows)


def test_grey_png_of_every_depth():
    import struct

    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + b"crc "
    for deep in (1, 2, 4, 8, 16):
        values = np.arange(8 * 8).reshape(8, 8) % (1 << min(deep, 8))
        if deep == 16:
            lines = [b"\0" + b"".join(bytes([v, 77]) for v in row) for row in values]
        else:
            bits = (values[:, :, None] >> np.arange(deep)[::-1]) & 1
            lines = [b"\0" + np.packbits(row.reshape(-1).astype(np.uint8)).tobytes() for row in bits]
        media = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 8, 8, deep, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines)))
        assert np.array_equal(images.decode(media), values * (255 // ((1 << min(deep, 8)) - 1)))


def test_crowded_entries_go_to_blocks(spark, monkeypatch):
    """A corner that all images share: no pair is listed, and the copies among them are found."""
    monkeypatch.setattr(images, "COUNTERPARTS", 64)
    rng = np.random.default_rng(1)
    logo = rng.integers(0, 2**63, (1, 4), dtype=np.uint64)
    words = np.concatenate([np.repeat(logo, 300, axis=0), rng.integers(0, 2**63, (5, 4), dtype=np.uint64)])
    votes, crowds = images.entry_votes(np.zeros(305, np.int64), np.arange(305), words)
    assert not sum(len(v[0]) for v in votes) and [len(own) for _, own in crowds] == [300]
    votes, crowds = images.entry_votes(np.zeros(305, np.int64), np.zeros(305, np.int64), words)
    assert not sum(len(v[0]) for v in votes) and not crowds
    labels = np.array([0] * 280 + list(range(1, 26)))  # most are connected: the others are compared with them
    votes, crowds = images.entry_votes(np.zeros(305, np.int64), labels, words)
    assert not sum(len(v[0]) for v in votes) and len(crowds[0][1]) == 300
    some = rng.integers(0, 2**63, (200, 4), dtype=np.uint64)
    some[100:] = some[:100] ^ np.uint64(5)
    votes, crowds = images.entry_votes(np.repeat([3, 9], 100), np.arange(200) % 150, np.concatenate([some[:50], some[100:150], some[50:100], some[150:]]))
    pairs = {(min(i, j), max(i, j)) for v in votes for i, j in zip(*map(list, v[:2]))}
    assert not crowds and pairs == {(min(i, i + 50), i + 50) for base in (0, 100) for i in range(base, base + 50)}
    monkeypatch.setattr(linking, "BLOCK", 4)
    monkeypatch.setattr(images, "HELD", 3)  # every bucket is crowded
    monkeypatch.setattr(images, "SHORT", 2)
    rows = [(i, pgm(grey(photo(i % 6)) if i < 6 else noisy(grey(photo(i % 6)), i, 3))) for i in range(36)]
    out = images.image_copies(spark.createDataFrame(rows, "media_id bigint, media binary"), "media_id", "media").collect()
    assert {r["media_id"]: r["component_id"] for r in out} == {i: i % 6 for i, _ in rows}


def test_equal_bytes_that_cannot_be_decoded_are_a_class(spark):
    rows = [(1, b"GIF89a x"), (2, b"GIF89a x"), (3, b"GIF89a y"), (4, b""), (5, b""), (6, None), (7, None)]
    out = images.image_copies(spark.createDataFrame(rows, "media_id bigint, media binary"), "media_id", "media").collect()
    assert {r["media_id"]: r["class_id"] for r in out} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7}


def test_pictures(spark):
    df = spark.createDataFrame([(1, [0.1, 0.2, None]), (2, None), (3, [])], "vec_id bigint, embedding array<float>")
    assert {r["vec_id"]: r["media"] is None for r in images.pictures(df).collect()} == {1: False, 2: True, 3: True}
