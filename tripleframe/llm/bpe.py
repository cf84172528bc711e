"""Byte-level BPE encoding and decoding.

A piece (one match of the vocabulary's pattern) is merged with a segment tree
over its byte positions. The leaf of a live position holds (rank of the pair
that starts there, position), so the root is the leftmost pair of minimum rank.
A merge updates three leaves (the position, its right neighbour that dies, its
left neighbour), each in logarithmic time; live neighbours form a linked list.

Work is per row, without a shuffle. Ranks are read once on the driver from a
path that is a parameter and broadcast (some 50,000 entries, whatever the input).
Each Python worker remembers pieces it has met, up to a fixed number, until it serves another operator.

Defined results
* null or empty text: no tokens, the digest of nothing.
* very long texts: whole, a piece of n bytes costs O(n log n).
* repeated rows and null identifiers pass as rows of their own; an empty table
  gives an empty result; only the identifier and text columns are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, lean

#: Pieces that a worker remembers before it starts anew, and the longest piece that it remembers.
REMEMBERED, LONGEST = 400_000, 64

OUTPUTS = {
    "n_tokens": "bigint",
    "ids": "array<int>",
    "ids_sha256": "string",
    "decoded": "binary",
    "decoded_sha256": "string",
}

ARROW = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "ids_sha256": pa.string(), "decoded": pa.binary(), "decoded_sha256": pa.string()}


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, its bytes in base 64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    none = 1 << 62
    width = 1 << max(0, (n - 2).bit_length())
    tree = [none] * (2 * width)
    get = ranks.get
    for p in range(n - 1):
        rank = get(piece[p : p + 2])
        if rank is not None:
            tree[width + p] = rank << 32 | p
    for i in range(width - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(position: int, key: int) -> None:
        i = width + position
        tree[i] = key
        while i > 1:
            a, b = tree[i], tree[i ^ 1]
            low = a if a < b else b
            i >>= 1
            if tree[i] == low:
                return
            tree[i] = low

    while (top := tree[1]) < none:
        p = top & 0xFFFFFFFF
        gone = after[p]
        end = after[gone]
        after[p] = end
        if gone < n - 1:
            put(gone, none)
        if end < n:
            before[end] = p
            rank = get(piece[p : after[end]])
            put(p, none if rank is None else rank << 32 | p)
        else:
            put(p, none)
        if (left := before[p]) >= 0:
            rank = get(piece[left:end])
            put(left, none if rank is None else rank << 32 | left)
    out, p = [], 0
    while p < n:
        out.append(ranks[piece[p : after[p]]])
        p = after[p]
    return out


class Pieces(dict):
    """The decimal ids of pieces, joined by spaces; those that are new are merged and remembered."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> str:
        said = " ".join(map(str, merge(piece.encode("utf-8", "surrogatepass"), self.ranks)))
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = said
        return said


class Codec:
    """Encodes texts to decimal ids joined by spaces, and decodes them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.pattern = pattern
        self.pieces = regex.compile(pattern).findall
        self.ids_of = Pieces(ranks).__getitem__
        self.bytes_of = {str(rank): token for token, rank in ranks.items()}

    def encode(self, text: str) -> str:
        return " ".join(map(self.ids_of, self.pieces(text)))

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.split(" "))) if ids else b""


def encode_decode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    outputs: tuple[str, ...] = ("ids", "decoded"),
) -> DataFrame:
    """One row per input row: id_col and the outputs asked for (see OUTPUTS).

    The digests are of the decimal ids joined by one space and of the bytes decoded from those ids.
    """
    digest_bytes = any(name.startswith("decoded") for name in outputs)
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in outputs}
            for text in batch.column(1):
                ids = codec.encode(text.as_py())
                decoded = codec.decode(ids) if digest_bytes else b""
                for name, to in out.items():
                    if name == "n_tokens":
                        to.append(ids.count(" ") + 1 if ids else 0)
                    elif name == "ids":
                        to.append([int(x) for x in ids.split(" ")] if ids else [])
                    elif name == "ids_sha256":
                        to.append(hashlib.sha256(ids.encode()).hexdigest())
                    elif name == "decoded":
                        to.append(decoded)
                    else:
                        to.append(hashlib.sha256(decoded).hexdigest())
            columns = [pa.array(v, ARROW[name]) for name, v in out.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["_id", *outputs])

    schema = f"_id {kind}, " + ", ".join(f"{name} {OUTPUTS[name]}" for name in outputs)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    return rows.mapInArrow(lean(run), schema).withColumnRenamed("_id", id_col)


def _codec(ranks: dict[bytes, int], pattern: str) -> Codec:
    """One codec for each worker process, kept between tasks until the worker serves another operator."""
    return kept(("bpe", id(ranks), pattern), lambda: Codec(ranks, pattern))
