r"""MinHash near-deduplication with sequential Bayesian verification.

1. Each text becomes its set of 5-word shingles (64-bit hashes) and a MinHash
   signature. Equal sets are one class; its smallest identifier represents it.
2. Signatures are cut into BANDS bands of ROWS values; classes that agree in a
   band share a bucket. A link of similarity 0.75 shares none with a
   probability of 4e-5.
3. In each bucket, the most popular member is compared with the others, which
   connects nearly all of a group of near copies at one pair a member. Pairs
   between components that remain in a bucket meet in blocks (see linking), each
   in the first band that they share.
4. Candidates are verified in sequence: signatures are compared in batches, and
   a pair is dropped once the posterior probability of a similarity of 0.75 or
   more is below MISS. Survivors are confirmed on their full sets.
5. Links connect components (smallest neighbour with pointer jumping, on the
   links alone); each component is named after its smallest identifier.

Words: `[^\x20\x09-\x0D]+` after lower-casing A-Z. A text with fewer words than
a shingle has is one shingle of all its words.

Defined results
* null or empty text, or white space: an empty set, linked with nothing.
* null identifiers: never linked, component null, kept. Repeated rows: equal
  sets are linked whatever their identifiers; rows with one identifier are one
  document, of which keep_first() keeps one row.
* very long texts: whole. Empty table: empty result. Other columns are ignored
  by near_dedup() and returned untouched by keep_first().
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, forget, lean, one_of_each, release, staged
from .linking import connect, popularity, shared_buckets

SHINGLE, BANDS, ROWS = 5, 52, 6
#: Signature values compared at a time, and the chance of a link to drop a pair at.
BATCH, MISS = 39, 1e-7

#: The low bits of a bucket's key hold its band.
BAND_MASK = 63

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.random.default_rng(20240501).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of the text's distinct shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, dtype=np.uint64)
    size = min(size, len(words))
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(words) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        out = (out ^ hashed[i : i + n]) * _MIX
        out ^= out >> np.uint64(31)
    return np.unique(out)


def signature(found: np.ndarray) -> bytes:
    """BANDS x ROWS minima, 16 bits of each."""
    low = np.full(len(_FACTORS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(found), 128):
        np.minimum(low, (found[i : i + 128, None] * _FACTORS[None, :]).min(axis=0), out=low)
    return (low >> np.uint64(40)).astype(np.uint16).tobytes()


def least_matches(threshold: float, miss: float = MISS, batch: int = BATCH, total: int = BANDS * ROWS) -> list[tuple[int, int]]:
    """(values compared, fewest matches to go on with): with fewer, P(similarity >= threshold) < miss, by a uniform prior."""
    s = (np.arange(4000) + 0.5) / 4000
    high = s >= threshold
    out = []
    for n in range(batch, total + 1, batch):
        for m in range(n + 1):
            logs = m * np.log(s) + (n - m) * np.log1p(-s)
            p = np.exp(logs - logs.max())
            if p[high].sum() / p.sum() >= miss:
                out.append((n, m))
                break
    return out


def survives(a: bytes, b: bytes, bounds: list[tuple[int, int]]) -> bool:
    """Whether the pair of loads is still possible after each batch of signature values."""
    same = np.frombuffer(a, np.uint16)[4:] == np.frombuffer(b, np.uint16)[4:]  # after the size
    return all(np.count_nonzero(same[:n]) >= m for n, m in bounds)


def possible_pairs(bucket: int | None, left: list, right: list, bounds: list[tuple[int, int]], share: int) -> list[tuple]:
    """Of records (id, label, load: size of the set and signature, short set or null), the pairs with different labels that survive.

    A pair that shares several buckets is examined in the first alone. Where short sets are at hand (in large buckets,
    which come together), survivors must be possible by them too, so that near misses of a large group don't become rows.
    """
    a, b = [np.frombuffer(b"".join(r[2][8:] for r in side), np.uint16).reshape(len(side), BANDS * ROWS) for side in (left, right)]
    n, m = [np.array([int.from_bytes(r[2][:8], "big") for r in side]) for side in (left, right)]
    labels = np.unique([r[1] for r in left + right], return_inverse=True)[1]
    apart = labels[: len(left), None] != labels[None, len(left) :]
    sizes = np.minimum(n[:, None], m[None, :]) * 100 >= np.maximum(n[:, None], m[None, :]) * share
    i, j = np.nonzero(apart & sizes)
    out = []
    for at in range(0, len(i), 2048):
        p, q = i[at : at + 2048], j[at : at + 2048]
        same = a[p] == b[q]
        held = np.ones(len(p), bool) if bucket is None else same.reshape(len(p), BANDS, ROWS).all(axis=2).argmax(axis=1) == bucket & BAND_MASK
        for values, least in bounds:
            p, q, same = p[held], q[held], same[held]
            held = np.count_nonzero(same[:, :values], axis=1) >= least
        for x, y in zip(p[held], q[held], strict=True):
            if left[x][3] is None or right[y][3] is None or perhaps_linked(left[x][3], right[y][3], int(n[x]), int(m[y]), share):
                out.append((left[x][0], right[y][0]))
    return out


def short_set(found: np.ndarray) -> bytes:
    """The distinct upper halves of the hashes."""
    return np.unique((found >> np.uint64(32)).astype(np.uint32)).tobytes()


def perhaps_linked(a: bytes, b: bytes, n: int, m: int, share: int) -> bool:
    """Whether sets of sizes n and m may be alike enough, by their short sets; never false for sets that are."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    most = len(np.intersect1d(x, y, assume_unique=True)) + min(n - len(x), m - len(y))
    return 100 * most >= share * (n + m - most)


def linked(a: bytes, b: bytes, share: int) -> bool:
    """Whether two full sets are alike enough."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= share * (len(x) + len(y) - common)


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, _n (size of the set), _set (digest of the set), _sig."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            sizes, sets, signatures = [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py())
                sizes.append(len(found))
                sets.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signatures.append(signature(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(signatures, pa.binary())], ["_id", "_n", "_set", "_sig"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(lean(run), f"_id {kind}, _n bigint, _set binary, _sig binary")


def _full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, _full (the sorted hashes) and _short of the documents named."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py()) for t in batch.column(1)]
            columns = [pa.array([f.tobytes() for f in found], pa.binary()), pa.array([short_set(f) for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["_id", "_full", "_short"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.join(ids, "_id", "left_semi").mapInArrow(lean(run), f"_id {kind}, _full binary, _short binary")


def _pairs_with(pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """pairs (_a, _b) with the value of each side as _va and _vb."""
    left = values.select(F.col("_id").alias("_a"), F.col(value).alias("_va"))
    right = values.select(F.col("_id").alias("_b"), F.col(value).alias("_vb"))
    return pairs.join(left, "_a").join(right, "_b")


def _bayes(pairs: DataFrame, signed: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("_va"), batch.column("_vb")
            yield batch.select(["_a", "_b"]).filter(pa.array([survives(x.as_py(), y.as_py(), bounds) for x, y in zip(a, b, strict=True)], pa.bool_()))

    kind = pairs.schema["_a"].dataType.simpleString()
    return _pairs_with(pairs, signed, "_load").select("_a", "_b", "_va", "_vb").mapInArrow(lean(run), f"_a {kind}, _b {kind}")


def _exact(pairs: DataFrame, full: DataFrame, share: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("_va"), batch.column("_vb")
            yield batch.select(["_a", "_b"]).filter(pa.array([linked(x.as_py(), y.as_py(), share) for x, y in zip(a, b, strict=True)], pa.bool_()))

    kind = pairs.schema["_a"].dataType.simpleString()
    return _pairs_with(pairs, full, "_full").select("_a", "_b", "_va", "_vb").mapInArrow(lean(run), f"_a {kind}, _b {kind}")


def _connected(signed: DataFrame, docs: DataFrame, id_col: str, text_col: str, share: int) -> DataFrame | None:
    """_node, _label of the representatives (_id, _n, _sig) that share a bucket; None if there are none."""
    values = lambda b: F.substring(F.col("_sig"), b * (2 * ROWS) + 1, F.lit(2 * ROWS))
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(values(b), b).bitwiseAND(F.lit(~BAND_MASK)).bitwiseOR(b.cast("bigint")))
    members = staged(shared_buckets(signed.select("_id", F.explode(bands).alias("_bucket"))), "near-members")
    width = math.log(100 / share) * (1 + 1e-9) if share < 100 else 1e-9
    of_size = F.floor(F.log(F.col("_n").cast("double")) / F.lit(width)).cast("int").alias("_class")  # links differ by 1 at most
    popular = cut(popularity(members).join(signed.select("_id", of_size), "_id"))
    if popular.isEmpty():
        return None
    full = staged(_full_sets(docs, popular.select("_id"), id_col, text_col), "near-sets")
    some = staged(signed.join(popular.select("_id"), "_id", "left_semi").select("_id", _load(F.col("_n"), F.col("_sig")).alias("_load")), "near-signatures")
    release(signed.sparkSession)
    bounds = least_matches(share / 100)
    possible = lambda bucket, left, right: possible_pairs(bucket, left, right, bounds, share)
    payload = some.join(full.select("_id", F.col("_short").alias("_more")), "_id")
    return connect(members, popular, payload, lambda pairs: _exact(_bayes(pairs, some, bounds), full, share), possible)[0]


def _load(n: Column, signature_: Column) -> Column:
    """The size (8 bytes, big endian) and the signature."""
    return F.concat(F.unhex(F.lpad(F.hex(n), 16, "0")), signature_)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 75) -> DataFrame:
    """One row per input row: id_col, n_shingles, component_id, kept. share: the similarity to link at, in hundredths."""
    signed = staged(_signed(docs, id_col, text_col), "near-signed")
    classes = cut(signed.filter("_n > 0 and _id is not null").groupBy("_set").agg(F.min("_id").alias("_rep")))
    own = signed.join(classes, (signed["_set"] == classes["_set"]) & (F.col("_id") == F.col("_rep"))).select("_id", "_n", "_sig").dropDuplicates(["_id", "_sig"])
    labels = _connected(own, docs, id_col, text_col, share)
    # one identifier with several sets, and one set under several identifiers, are one document
    if labels is not None:
        classes = classes.join(labels, F.col("_rep") == F.col("_node"), "left").select("_set", F.coalesce("_label", "_rep").alias("_rep"))
    out = signed.join(classes, "_set", "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("_rep", "_id"))
    return out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one of each component, with all their columns."""
    # cut: it is read several times below, and each would bring all joins of near_dedup() into the driver's plan again
    gone = cut(near_dedup(docs, id_col, text_col).filter("not kept").select(F.col(id_col).alias("_gone")).distinct())
    rest = docs.join(gone, docs[id_col].eqNullSafe(gone["_gone"]), "left_anti")
    unnamed = rest.filter(F.col(id_col).isNull())  # no identifier, no component: all stay
    return one_of_each(rest.filter(F.col(id_col).isNotNull()), [id_col]).unionByName(unnamed)
