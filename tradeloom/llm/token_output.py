"""Token ids packed into fixed rows and written as binary matrices.

Texts are encoded with a public byte-level vocabulary and end with an end mark. Documents longer
than a row are cut into pieces of whole rows and a rest; every id is kept. Pieces are dealt to
shards by a hash of what they are and, if a task has the same one again, of how often, so that no
id, no missing id and no row listed many times fills a shard. Each shard is packed best-fit decreasing: a segment tree over residual
capacities finds the fullest row that still has room.

A packed row holds its ids (little-endian, filled up with the end mark), cumulative segment
lengths from 0 to the ids in use, and the places where positions start anew; documents and
pieces of its segments are beside it, so the documents can be had back exactly.

NULL and empty texts are the end mark alone. Ties are packed in the order of id, then piece.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.chunks import BytePool
from tradeloom.llm.common import bounded_batches, raw_text, spans
from tradeloom.session import written

LENGTH, SHARD_TOKENS = 2048, 1 << 20
#: Fixed value: how the vocabulary's texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Signs that are white space to the pattern but not a blank of one byte, or the other way round.
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Packed shards that one task gets, about.
SHARDS_A_TASK = 8


def ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of lines with a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Token ids of batches of texts."""

    def __init__(self, vocabulary: dict[bytes, int]):
        import tiktoken

        self.coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        self.widths = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        self.widths[list(vocabulary.values())] = list(map(len, vocabulary))
        self.pool = BytePool(self._encode)

    def _encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks that begin with a blank and don't end with one are encoded as one text: no token goes over such a seam."""
        blanks, coder = b" \t\n\v\f\r", self.coder
        plain = np.array([c[0] in blanks and c[-1] not in blanks for c in chunks])
        if _ODD.search(b" ".join(chunks).decode()):
            plain &= [not _ODD.search(c.decode()) for c in chunks]
        joined = [c for c, p in zip(chunks, plain.tolist(), strict=True) if p]
        found = np.array(coder.encode_ordinary(b"".join(joined).decode()), np.int32)
        ends = np.searchsorted(np.cumsum(self.widths[found]), np.cumsum([len(c) for c in joined], dtype=np.int64), "right")
        others = [coder.encode_ordinary(chunks[at].decode()) for at in np.flatnonzero(~plain)]
        lengths = np.zeros(len(chunks), np.int64)
        lengths[plain], lengths[~plain] = np.diff(ends, prepend=0), np.fromiter(map(len, others), np.int64, len(others))
        order = np.argsort(~plain, kind="stable")
        starts = np.empty(len(chunks), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return np.concatenate([found, np.fromiter(chain.from_iterable(others), np.int32)])[spans(starts, lengths)], lengths

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        return self.pool.tokens([t.encode() for t in texts], [bool(_ODD.search(t)) for t in texts])


class Capacities:
    """A segment tree over residual capacities: which of them some row has."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.held = bytearray(2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.width
        while node and not self.held[node]:
            self.held[node] = 1
            node >>= 1

    def tightest(self, size: int) -> int:
        """The smallest residual capacity of at least ``size``, or -1."""
        node = size + self.width
        while node > 1 and not self.held[node]:
            while node & 1:
                node >>= 1
            node = node + 1 if node else 1
        if node <= 1:
            return -1
        while node < self.width:
            node = 2 * node if self.held[2 * node] else 2 * node + 1
        return node - self.width

    def take(self, room: int) -> int:
        row = self.rows[room].pop()
        node = room + self.width
        if not self.rows[room]:
            self.held[node] = 0
            node >>= 1
            while node and not (self.held[2 * node] or self.held[2 * node + 1]):
                self.held[node] = 0
                node >>= 1
        return row


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Row of each piece; ``sizes`` go down."""
    tree, rows, placed = Capacities(capacity), 0, []
    for size in sizes:
        room = tree.tightest(size)
        if room < 0:
            room, row, rows = capacity, rows, rows + 1
        else:
            row = tree.take(room)
        tree.put(room - size, row)
        placed.append(row)
    return placed


def pieces(docs: DataFrame, vocabulary: dict[bytes, int], length: int = LENGTH) -> DataFrame:
    """``(doc_id, nameless, piece, tokens, ids, again)``: the ids of every document, at most ``length`` in a row.

    ``again`` counts the equal rows that a task has seen before; equal rows may swap it.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary)
    end, kind = len(vocabulary), id_type(vocabulary)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, seen = Encoder(shared.value), Counter()
        for pdf in batches:
            ids, counts = encoder.tokens([t or "" for t in pdf["text"]])
            ends = np.cumsum(counts + 1)
            filled = np.full(len(ids) + len(counts), end, kind)
            real = np.ones(len(filled), bool)
            real[ends - 1] = False
            filled[real] = ids
            parts = -(-(counts + 1) // length)
            doc = np.repeat(np.arange(len(counts)), parts)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = (ends - counts - 1)[doc] + nth * length
            stop = np.minimum(start + length, ends[doc])
            raw, wide = filled.tobytes(), filled.itemsize
            out = pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[doc], "nameless": pdf["nameless"].to_numpy()[doc], "piece": nth, "tokens": stop - start})
            out["ids"] = [raw[a:b] for a, b in zip((start * wide).tolist(), (stop * wide).tolist(), strict=True)]
            again = []
            for same in zip(out["doc_id"].tolist(), nth.tolist(), map(xxhash.xxh64_intdigest, out["ids"]), strict=True):
                again.append(seen[same])
                seen[same] += 1
            out["again"] = again
            yield out

    # Long numbers with NULLs among them would be rounded in pandas.
    plain = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("nameless"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInPandas(cut, "doc_id long, nameless boolean, piece int, tokens int, ids binary, again long")


def id_type(vocabulary: dict[bytes, int]) -> str:
    return "<u2" if len(vocabulary) < 1 << 16 else "<u4"


def pack(docs: DataFrame, vocabulary: dict[bytes, int], length: int = LENGTH, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per packed row: shard, bin, input_ids, cu_seqlens, position_resets, doc_ids, pieces."""
    kind, end = id_type(vocabulary), len(vocabulary)
    # Tokens are not counted beforehand; four bytes each is near enough to size shards.
    size, count = docs.agg(F.sum(F.octet_length(raw_text("text"))), F.count("*")).first()
    shards = max(1, -(-((size or 0) // 4 + count) // shard_tokens))
    shard = F.pmod(F.xxhash64("doc_id", "nameless", "piece", "ids", "again"), F.lit(shards))
    # Tasks grow in number with the shards.
    dealt = pieces(docs, vocabulary, length).withColumn("shard", shard).drop("again").repartition(-(-shards // SHARDS_A_TASK), "shard")

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tokens", "nameless", "doc_id", "piece", "ids"], ascending=[False, False, True, True, True], kind="stable")
        bins = np.array(best_fit_decreasing(pdf["tokens"].tolist(), length))
        pdf = pdf.iloc[np.argsort(bins, kind="stable")]
        starts = np.flatnonzero(np.diff(np.sort(bins), prepend=-1))
        sizes = pdf["tokens"].to_numpy(np.int64)
        matrix = np.full((len(starts), length), end, kind)
        out = []
        for row, (a, b) in enumerate(zip(starts, [*starts[1:], len(pdf)], strict=True)):
            ids = np.frombuffer(b"".join(pdf["ids"].iloc[a:b]), kind)
            matrix[row, : len(ids)] = ids
            ends = np.concatenate([[0], np.cumsum(sizes[a:b])]).astype(np.int32)
            out.append((ends, ends[:-1], [None if lost else d for d, lost in zip(pdf["doc_id"].iloc[a:b].tolist(), pdf["nameless"].iloc[a:b], strict=True)], pdf["piece"].iloc[a:b].tolist()))
        return pd.DataFrame(
            {
                "shard": pdf["shard"].iloc[0],
                "bin": np.arange(len(starts)),
                "input_ids": [r.tobytes() for r in matrix],
                "cu_seqlens": [o[0] for o in out],
                "position_resets": [o[1] for o in out],
                "doc_ids": [o[2] for o in out],
                "pieces": [o[3] for o in out],
            }
        )

    schema = "shard long, bin long, input_ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, pieces array<int>"
    return dealt.groupBy("shard").applyInPandas(packed, schema)


def write(packed: DataFrame, name: str = "packed") -> DataFrame:
    """Write the matrices to the shared folder and read them back."""
    return written(packed, name)


def unpacked(packed: DataFrame, id_bytes: int) -> DataFrame:
    """``(doc_id, piece, ids)`` of every segment of packed rows, without filling."""
    segments = packed.select("input_ids", F.explode(F.arrays_zip("doc_ids", "pieces", "position_resets", F.slice("cu_seqlens", 2, F.size("doc_ids")).alias("end"))).alias("s"))
    start, end = F.col("s.position_resets"), F.col("s.end")
    return segments.select(F.col("s.doc_ids").alias("doc_id"), F.col("s.pieces").alias("piece"), F.substring("input_ids", start * id_bytes + 1, (end - start) * id_bytes).alias("ids"))
