"""SentencePiece encoding and decoding by suffix-array matching.

The distinct segments of a batch (a run of the space mark with what follows it) are laid end to
end and indexed by a suffix array, sorted by as many characters as the longest piece has. All
pieces of the vocabulary are searched in it at once by bisection, which gives each piece's range
of occurrences. Every occurrence is an edge from its start to its end; edges are sorted by
position and then relaxed:

* in a BPE model in the order of merging: of the edges that join two neighbouring symbols of a
  segment, the one with the best score (then the leftmost) is taken, until none is left;
* in a unigram model from left to right: the best sum of scores up to each position, ties to the
  longer last piece.

Segments of a batch are relaxed side by side; a long one has a heap of its edges, so a text without
blanks takes n log n. Characters that no piece holds become byte pieces,
or the unknown piece in a model without them.

NULL texts have NULL ids, empty ones no ids. Decoding gives back every text that does not
itself hold the space mark and whose characters the model can spell.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.chunks import ChunkPool
from tradeloom.llm.common import bounded_batches, by_bytes, spans

SPACE = "▁"
#: Characters of distinct segments that are indexed together.
INDEXED = 1 << 18
#: Characters of a segment up to which segments are relaxed side by side, a merge of each at a time.
ABREAST = 64


@dataclass(frozen=True)
class Pieces:
    #: Text and score of the pieces that are matched, by id; others have empty texts.
    texts: list[str]
    scores: np.ndarray
    #: Id of each byte value, or none.
    byte_ids: list[int]
    unknown: int
    #: What each id decodes to.
    spelled: list[bytes]
    kind: str = "bpe"


def load(path: str, kind: str = "bpe") -> Pieces:
    """The vocabulary of a ``.model`` file; ``kind`` is how its scores are meant, bpe or unigram."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts, spelled, byte_ids = [], [], [-1] * 256
    for i in range(sp.vocab_size()):
        piece = sp.id_to_piece(i)
        plain = not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        texts.append(piece if plain else "")
        if sp.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            spelled.append(bytes([value]))
        else:
            spelled.append(piece.replace(SPACE, " ").encode() if plain else " ⁇ ".encode() if sp.is_unknown(i) else b"")
    scores = np.array([sp.get_score(i) for i in range(len(texts))], np.float64)
    return Pieces(texts, scores, byte_ids if min(byte_ids) >= 0 else [], sp.unk_id(), spelled, kind)


class Encoder:
    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        own = [t for t in pieces.texts if t]
        self.widest = max(map(len, own), default=1)
        inner = any(re.search(f"[^{SPACE}]{SPACE}", t) for t in own)
        # A piece never goes on over a space mark after another character, nor over a line end.
        lines = "\n" not in "".join(t for t in own if len(t) > 1)
        self.segments = re.compile("(?s).+") if inner else re.compile(rf"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+" if lines else rf"(?s){SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.pool = ChunkPool(self._encode_segments)
        self.letters = np.array(sorted({ord(c) for t in own for c in t}), np.uint32)
        self.flat = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32)
        self.ids = np.array([i for i, t in enumerate(pieces.texts) if t], np.int64)
        self.sizes = np.array([len(t) for t in own], np.int64)
        self.spell_sizes = np.array([len(s) for s in pieces.spelled], np.int64)
        self.spell_flat = np.frombuffer(b"".join(pieces.spelled), np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        return self.pool.tokens([self.segments.findall((SPACE + t).replace(" ", SPACE)) if t else [] for t in texts])

    def decode(self, ids: np.ndarray) -> str:
        starts = np.cumsum(self.spell_sizes) - self.spell_sizes
        raw = self.spell_flat[spans(starts[ids], self.spell_sizes[ids])].tobytes()
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")

    def _encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths = [], []
        for a, b in by_bytes(segments, INDEXED):
            found, count = self._encode_block(segments[a:b])
            ids.append(found)
            lengths.append(count)
        return np.concatenate(ids), np.concatenate(lengths)

    def _encode_block(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        text = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        table = self._edges(text, sizes)
        relaxed = _relax_merges if self.pieces.kind == "bpe" else _relax_sums
        at, width = relaxed(table, sizes, self.pieces.scores)
        piece = table[at, width - 1]
        # Characters without a piece become bytes.
        counts = np.ones(len(at), np.int64)
        lost = np.flatnonzero(piece < 0)
        spelled = {i: [self.pieces.byte_ids[b] for b in chr(text[at[i]]).encode("utf-8", "replace")] if self.pieces.byte_ids else [self.pieces.unknown] for i in lost.tolist()}
        counts[lost] = [len(v) for v in spelled.values()]
        out = np.repeat(piece, counts).astype(np.int32)
        first = np.cumsum(counts) - counts
        for i, v in spelled.items():
            out[first[i] : first[i] + len(v)] = v
        owner = np.repeat(np.arange(len(sizes)), sizes)[at]
        return out, np.bincount(owner, counts, len(sizes)).astype(np.int64)

    def _edges(self, text: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For every position and number of characters the id of the piece there, or -1."""
        present = np.intersect1d(np.unique(text), self.letters)
        bits = max(1, int(len(present) + 1).bit_length())
        per_key = 64 // bits
        keys = -(-self.widest // per_key)
        rank = np.searchsorted(present, text)
        rank = np.where(present[np.minimum(rank, len(present) - 1)] == text, rank + 1, 0) if len(present) else np.zeros(len(text), np.int64)
        padded = np.concatenate([rank, np.zeros(per_key * keys, np.int64)]).astype(np.uint64)
        # Suffix array: starts of suffixes in the order of their first characters.
        packed = np.zeros((keys, len(text)), np.uint64)
        for i in range(per_key * keys):
            k = i // per_key
            packed[k] = (packed[k] << np.uint64(bits)) | padded[i : i + len(text)]
        suffixes = np.lexsort(packed[::-1])
        ordered = packed[:, suffixes]
        # Pieces all of whose characters occur, padded to the same number of characters.
        code = np.searchsorted(present, self.flat)
        known = present[np.minimum(code, max(len(present) - 1, 0))] == self.flat if len(present) else np.zeros(len(self.flat), bool)
        starts = np.cumsum(self.sizes) - self.sizes
        able = np.logical_and.reduceat(known, starts) if len(starts) else np.zeros(0, bool)
        pieces, widths = self.ids[able], self.sizes[able]
        grid = np.zeros((len(pieces), per_key * keys), np.uint64)
        inside = np.arange(per_key * keys) < widths[:, None]
        grid[inside] = code[spans(starts[able], widths)] + 1
        low, high = (np.zeros((keys, len(pieces)), np.uint64) for _ in range(2))
        full = np.uint64((1 << bits) - 1)
        for i in range(per_key * keys):
            k = i // per_key
            low[k] = (low[k] << np.uint64(bits)) | grid[:, i]
            high[k] = (high[k] << np.uint64(bits)) | np.where(inside[:, i], grid[:, i], full)
        first, last = _bisect(ordered, low, False), _bisect(ordered, high, True)
        counts = last - first
        position = suffixes[spans(first, counts)]
        width = np.repeat(widths, counts)
        edges = np.sort((position.astype(np.uint64) << np.uint64(32)) | (width.astype(np.uint64) << np.uint64(24)) | np.repeat(pieces, counts).astype(np.uint64))
        position, width, piece = (edges >> np.uint64(32)).astype(np.int64), ((edges >> np.uint64(24)) & np.uint64(255)).astype(np.int64), (edges & np.uint64(0xFFFFFF)).astype(np.int64)
        # Segments lie side by side; an edge over a seam is none.
        ends = np.repeat(np.cumsum(sizes), sizes)
        own = position + width <= ends[position]
        table = np.full((len(text), self.widest), -1, np.int32)
        table[position[own], width[own] - 1] = piece[own]
        return table


def _bisect(ordered: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """For every column of ``wanted`` where it would stand in ``ordered``, before or after its equals."""
    n = ordered.shape[1]
    lo, hi = np.zeros(wanted.shape[1], np.int64), np.full(wanted.shape[1], n, np.int64)
    while (lo < hi).any():
        mid = np.minimum((lo + hi) >> 1, n - 1)
        less, equal = np.zeros(len(mid), bool), np.ones(len(mid), bool)
        for k in range(len(ordered)):
            there = ordered[k, mid]
            less |= equal & (there < wanted[k])
            equal &= there == wanted[k]
        go_on = (less | (equal & after)) & (lo < hi)
        lo, hi = np.where(go_on, mid + 1, lo), np.where(go_on | (lo >= hi), hi, mid)
    return lo


def _relax_merges(table: np.ndarray, sizes: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and widths of the symbols that are left when no two neighbours can be joined."""
    widest = table.shape[1]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.flatnonzero((sizes <= ABREAST)[owner])
    width, owner = np.ones(len(at), np.int64), owner[at]
    done_at, done_width = [], []
    for segment in np.flatnonzero(sizes > ABREAST):
        first = int(sizes[:segment].sum())
        left, wide = _merged(table[first : first + sizes[segment]], scores.tolist())
        done_at.append(left + first)
        done_width.append(wide)
    while len(at):
        both = width[:-1] + width[1:]
        fits = (owner[:-1] == owner[1:]) & (both <= widest)
        piece = np.where(fits, table[at[:-1], np.minimum(both, widest) - 1], -1)
        score = np.append(np.where(piece >= 0, scores[piece], -np.inf), -np.inf)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        best = np.maximum.reduceat(score, starts)
        runs = np.diff(starts, append=len(at))
        open_, best = np.repeat(best > -np.inf, runs), np.repeat(best, runs)
        done_at.append(at[~open_])
        done_width.append(width[~open_])
        tied = np.flatnonzero(open_ & (score == best))
        joined = tied[np.diff(owner[tied], prepend=-1) != 0]
        width[joined] += width[joined + 1]
        open_[joined + 1] = False
        at, width, owner = at[open_], width[open_], owner[open_]
    at, width = np.concatenate([np.zeros(0, np.int64), *done_at]), np.concatenate([np.zeros(0, np.int64), *done_width])
    order = np.argsort(at, kind="stable")
    return at[order], width[order]


def _merged(table: np.ndarray, scores: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """The same for one long segment: a heap of its edges over a list of linked neighbours."""
    n, widest, piece_at = len(table), table.shape[1], table.item
    width, before, after = [1] * n, list(range(-1, n - 1)), list(range(1, n + 1))
    first = np.flatnonzero(table[: n - 1, 1] >= 0).tolist() if widest > 1 else []
    heap = [(-scores[piece_at(i, 1)], i, 1, 1) for i in first]
    heapq.heapify(heap)
    while heap:
        _, i, own, other = heapq.heappop(heap)
        j = after[i]
        # An edge between symbols that have changed since is void.
        if width[i] != own or j == n or width[j] != other:
            continue
        width[i], width[j] = own + other, 0
        k = after[i] = after[j]
        if k < n:
            before[k] = i
        for a, b in ((before[i], i), (i, k)):
            if a >= 0 and b < n and width[a] + width[b] <= widest:
                piece = piece_at(a, width[a] + width[b] - 1)
                if piece >= 0:
                    heapq.heappush(heap, (-scores[piece], a, width[a], width[b]))
    left = np.flatnonzero(width)
    return left, np.array(width, np.int64)[left]


def _relax_sums(table: np.ndarray, sizes: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and widths of the pieces on the best path through each segment."""
    widest, first = table.shape[1], np.cumsum(sizes) - sizes
    lost = (scores.min() if len(scores) else 0.0) - 10
    gain = np.where(table >= 0, scores[table], -np.inf)
    gain[:, 0] = np.where(table[:, 0] >= 0, gain[:, 0], lost)
    # best[i] belongs to the place before character i; each segment has one place more than characters.
    place = first + np.arange(len(sizes))
    best, back = np.full(len(table) + len(sizes), -np.inf), np.zeros(len(table) + len(sizes), np.int64)
    best[place] = 0
    for end in range(1, int(sizes.max(initial=0)) + 1):
        live = np.flatnonzero(sizes >= end)
        for width in range(1, min(end, widest) + 1):
            total = best[place[live] + end - width] + gain[first[live] + end - width, width - 1]
            target = place[live] + end
            better = total >= best[target]
            best[target[better]] = total[better]
            back[target[better]] = width
    at, widths, left = [], [], sizes.copy()
    live = np.flatnonzero(left > 0)
    while len(live):
        width = back[place[live] + left[live]]
        left[live] -= width
        at.append(first[live] + left[live])
        widths.append(width)
        live = live[left[live] > 0]
    at, widths = np.concatenate([np.zeros(0, np.int64), *at]), np.concatenate([np.zeros(0, np.int64), *widths])
    order = np.argsort(at, kind="stable")
    return at[order], widths[order]


def encode(docs: DataFrame, pieces: Pieces, into: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` as 32-bit little-endian numbers in a binary column."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(pieces)

    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(shared.value)
        for texts in batches:
            out: list[bytes | None] = [None] * len(texts)
            here = [i for i, t in enumerate(texts) if t is not None]
            ids, counts = encoder.encode([texts.iloc[i] for i in here])
            raw, ends = ids.astype("<i4").tobytes(), (4 * np.cumsum(counts)).tolist()
            for i, a, b in zip(here, [0, *ends], ends):
                out[i] = raw[a:b]
            yield pd.Series(out, dtype=object)

    return docs.withColumn(into, F.pandas_udf(encoded, "binary").asNondeterministic()(F.col("text")))


def decode(tokens: DataFrame, pieces: Pieces, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``tokens`` with the text that a binary column of ids stands for."""
    spark = tokens.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(pieces)

    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(shared.value)
        for column in batches:
            yield pd.Series([None if raw is None else encoder.decode(np.frombuffer(raw, "<i4")) for raw in column], dtype=object)

    return tokens.withColumn(into, F.pandas_udf(decoded, "string").asNondeterministic()(F.col(ids)))
