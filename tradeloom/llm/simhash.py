"""SimHash near-dedup: fingerprints of word shingles, linked by a self-join of their binary trie.

The trie of all distinct fingerprints is cut at a depth that gives nodes of bounded size. Node
pairs whose paths differ in no more bits than the budget are formed by flipping path bits, and
each pair's two subtrees are traversed together: a pair of nodes has up to four pairs of
children, two of them with one differing bit more, and is dropped when the budget is exceeded.
Links make components; a document's component is the smallest id in it.

NULL and empty texts have fingerprint zero. Fewer words than a shingle make one shingle. Equal
fingerprints are one trie leaf, so copies never make pairs. NULL ids are members but name no
component unless it has no other.

A fingerprint goes to every node pair of its node, some half of ``1 + d + d (d - 1) / 2`` copies of
eight bytes at depth ``d``, which grows with the square of the logarithm of their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import bounded_batches, by_bytes, free, one_of_each, raw_text, sized
from tradeloom.llm.components import components
from tradeloom.session import written

SHINGLE, BUDGET, SEED = 3, 2, 42
#: Fingerprints below a node at the cut, about; larger nodes are dealt in slices of this size.
NODE = 2048
#: Node pairs that are traversed at once, and pairs of leaves compared directly.
FRONT, DIRECT = 1 << 18, 32
_EACH = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, width: int = SHINGLE) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist(), strict=True)]


def majorities(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For consecutive groups of hashes: the bits set in more than half of each; no hashes give zero."""
    out = np.zeros(len(lengths), np.uint64)
    held = np.flatnonzero(lengths)
    if not len(held):
        return out
    n = lengths[held]
    # Runs of up to 255 hashes, so that byte counters can't overflow.
    runs = -(-n // 255)
    first = np.repeat(np.cumsum(n) - n, runs)
    run_starts = np.cumsum(runs) - runs
    first = first + (np.arange(len(first)) - np.repeat(run_starts, runs)) * 255
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & _EACH, first)
        counts = np.add.reduceat(sums.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), run_starts)
        for byte in range(8):
            out[held] |= (2 * counts[:, byte] > n).astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def fingerprints(texts: list[bytes]) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    for a, b in by_bytes(texts, 1 << 20):
        each = [np.array(shingle_hashes(t), np.uint64) for t in texts[a:b]]
        out[a:b] = majorities(np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each)))
    return out


def fingerprinted(docs: DataFrame, into: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint as a signed long in a column of this name."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(fingerprints(list(texts)).view(np.int64))

    return docs.withColumn(into, made(raw_text("text")))


def trie_pairs(a: np.ndarray, b: np.ndarray | None, depth: int, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within ``budget`` bits between two sorted subtrees below ``depth``, or inside one."""
    keys = a if b is None else np.concatenate([a, b])
    self_join = b is None
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    root = np.array([[0, len(a), 0 if self_join else len(a), len(keys), 0]], np.int64)
    if not self_join and len(a) and len(b) and depth:
        top = np.uint64(64 - depth)
        root[0, 4] = int(np.bitwise_count((a[0] >> top) ^ (b[0] >> top)))
    stack = [(depth, root)] if len(a) and (self_join or len(b)) and root[0, 4] <= budget else []
    ones: dict[int, np.ndarray] = {}
    while stack:
        level, front = stack.pop()
        if len(front) > FRONT:
            stack += [(level, front[:FRONT]), (level, front[FRONT:])]
            continue
        la, ha, lb, hb, d = front.T
        few = ((ha - la) * (hb - lb) <= DIRECT) | (level == 64)
        if few.any():
            i, j = _expanded(*front[few, :4].T)
            near = np.bitwise_count(keys[i] ^ keys[j]) <= budget
            if self_join:
                near &= i < j
            left.append(i[near])
            right.append(j[near])
            la, ha, lb, hb, d = front[~few].T
        if not len(la):
            continue
        if level not in ones:
            ones[level] = np.concatenate([[0], np.cumsum((keys >> np.uint64(63 - level)) & np.uint64(1)).astype(np.int64)])
        count = ones[level]
        ma, mb = ha - (count[ha] - count[la]), hb - (count[hb] - count[lb])
        same = (la == lb) if self_join else np.zeros(len(la), bool)
        pairs = [np.stack(x, axis=1) for x in ((la, ma, lb, mb, d), (ma, ha, mb, hb, d), (la, ma, mb, hb, d + 1))]
        pairs.append(np.stack((ma, ha, lb, mb, d + 1), axis=1)[~same])
        children = np.concatenate(pairs)
        alive = (children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3]) & (children[:, 4] <= budget)
        stack.append((level + 1, children[alive]))
    i, j = np.concatenate(left), np.concatenate(right)
    return keys[i], keys[j]


def _expanded(la: np.ndarray, ha: np.ndarray, lb: np.ndarray, hb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs of small ranges."""
    wide = hb - lb
    n = (ha - la) * wide
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    wide = np.repeat(wide, n)
    return np.repeat(la, n) + nth // wide, np.repeat(lb, n) + nth % wide


def links(distinct: DataFrame, budget: int = BUDGET, node: int = NODE) -> DataFrame:
    """Pairs ``(a, b)`` of fingerprints within ``budget`` bits; ``distinct`` has one column, ``fp``."""
    total = distinct.count()
    depth = int(np.clip(np.ceil(np.log2(max(total, 1) / node)), 1, 24))
    path = F.shiftrightunsigned("fp", 64 - depth)
    nodes = distinct.groupBy(path.alias("p")).agg(F.ceil(F.count("*") / node).cast("int").alias("slices"))
    nodes = written(nodes, "nodes")
    count = nodes.count()
    # Paths that differ from a node's own in up to ``budget`` bits, the node itself first.
    one = [1 << i for i in range(depth)]
    flips = sorted({0} | ({x for x in one} if budget else set()) | {x | y for x in one for y in one if budget > 1})
    if budget > 2:
        raise ValueError("paths are flipped in two bits at most")
    near = nodes.select("p", "slices", F.explode(F.array(*[F.lit(x).cast("long") for x in flips])).alias("flip"))
    near = near.withColumn("q", F.col("p").bitwiseXOR(F.col("flip")))
    near = near.join(sized(nodes.select(F.col("p").alias("q"), F.col("slices").alias("others")), count, 64), "q")
    pairs = written(near.select("p", "q", "slices", "others"), "node_pairs")
    # A fingerprint goes to its slice of every pair its node is in, against each slice of the other node.
    rows = distinct.select("fp", path.alias("p")).join(sized(pairs, pairs.count(), 64), "p")
    own = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    dealt = rows.select("fp", "p", "q", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("other"))
    low = (F.col("p") < F.col("q")) | ((F.col("p") == F.col("q")) & (F.col("own") <= F.col("other")))
    dealt = dealt.select(
        "fp",
        F.least("p", "q").alias("p"),
        F.greatest("p", "q").alias("q"),
        F.when(low, F.col("own")).otherwise(F.col("other")).alias("i"),
        F.when(low, F.col("other")).otherwise(F.col("own")).alias("j"),
        low.alias("low"),
    )

    def traverse(pdf: pd.DataFrame) -> pd.DataFrame:
        fp, side = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["low"].to_numpy(bool)
        first = pdf.iloc[0]
        a, b = np.sort(fp[side]), np.sort(fp[~side])
        alone = first["p"] == first["q"] and first["i"] == first["j"]
        x, y = trie_pairs(a, None if alone else b, depth, budget)
        return pd.DataFrame({"a": x.view(np.int64), "b": y.view(np.int64)})

    return dealt.groupBy("p", "q", "i", "j").applyInPandas(traverse, "a long, b long")


def _rows(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text hash, fingerprint, a fingerprint that names the group, component_id."""
    keyed = fingerprinted(docs.select("doc_id", "text"), "_fp").select("doc_id", F.xxhash64("text").alias("hash"), F.col("_fp").alias("fp"))
    marked = written(keyed, "fingerprints")
    leaves = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "leaves")
    found = components(written(links(leaves.select("fp")), "links"), "a", "b")
    joined = leaves.join(found, leaves["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    roots = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(joined.select("fp", "root").join(roots, "root").select("fp", "root", "component_id"), "named")
    return marked.join(sized(named, named.count(), 80), "fp")


def grouped(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (long), component_id."""
    return _rows(docs).select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def kept(docs: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """``docs`` with one document of each group, with the smallest id, and all its columns.

    ``rows`` are the groups (doc_id, hash, root, component_id) if they don't come from fingerprints.
    """
    rows = written(_rows(docs) if rows is None else rows, "rows")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    best = rows.filter(first).groupBy("root").agg(F.min("hash").alias("best"))
    second = rows.filter(first).join(best, "root").filter(F.col("hash") != F.col("best"))
    gone = rows.filter(~first).select("doc_id", "hash").unionByName(second.select("doc_id", "hash"))
    own, gone_id, gone_hash = (free(docs, n) for n in ("_hash", "_gone_id", "_gone_hash"))
    gone = written(gone.select(F.col("doc_id").alias(gone_id), F.col("hash").alias(gone_hash)).distinct(), "gone")
    same = [F.col("doc_id").eqNullSafe(F.col(gone_id)), F.col(own) == F.col(gone_hash)]
    stay = docs.withColumn(own, F.xxhash64("text")).join(sized(gone, gone.count(), 80), same, "left_anti")
    return one_of_each(stay, ["doc_id", own]).drop(own)
