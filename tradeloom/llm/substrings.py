"""Substring dedup: passages that repeat across documents, found in prefix-partitioned suffix trees.

A suffix matters only by its first 50 words, its window. Of the grams of 20 words in a window one
has the least hash, and the suffix's prefix runs to the end of it: prefixes of 20 to 50 words that
follow from the words alone, so equal windows have equal prefixes. Suffixes whose prefixes end in
the same gram are a group. They stand side by side in their texts, some eighteen in a row, so their
words travel once and not once per suffix. Groups that no two documents share are left out at
once, which only takes the grams' hashes.

A group's equal stretches of text are joined into one, with the smallest document that holds it.
Groups are put together until they fill a task's memory; there their suffix tree is built as
sorted suffixes with the lengths of common prefixes of neighbours, where an internal node is a run
of neighbours. A node of 50 words or more is a repeat, and its smallest document keeps the words.
Groups with too many stretches are split by the longest prefix, the whole window, which makes one
node of each part: it is a digest of 128 bits and its smallest document, summed up in parts.
Neighbouring repeats join to maximal ones when a text's words are taken out.

Texts with the same bytes are looked at once: the copy with the smallest id keeps what the others
lose. NULL texts have no words. A NULL id counts as the largest number; rows that are listed twice
under one id are not smaller than each other. Texts of under 50 words lose nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import ExitStack
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import bounded_batches, by_bytes, sized, spans
from tradeloom.session import stored, written

WINDOW, GRAM = 50, 20
#: Words whose suffixes are sorted in one task, about, and stretches of a group that are still sorted.
TREE_WORDS, GROUP = 1 << 18, 1000
LAST_ID = (1 << 63) - 1
#: Word hashes that a task remembers.
_KNOWN = 1 << 20
_KEY = ["k1", "k2"]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _KNOWN:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


class Grams:
    """Hashes of all grams of a row of words, and the least one in every window."""

    def __init__(self, gram: int, window: int):
        self.gram, self.inner = gram, window - gram + 1
        self.hashes = _Hashes()
        self.base = 0x9E3779B97F4A7C15
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) >= n:
            return
        with np.errstate(over="ignore"):
            up, down = np.full(n, self.base, np.uint64), np.full(n, pow(self.base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)

    def least(self, words: list[list[bytes]]) -> np.ndarray:
        """The least gram hash of the window at each place of all texts, laid end to end; windows over an end are there too."""
        n = sum(map(len, words))
        self._powers(n + 1)
        with np.errstate(over="ignore"):
            h = np.fromiter(map(self.hashes.__getitem__, chain.from_iterable(words)), np.uint64, n)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * self.up[:n])])
            g = (sums[self.gram :] - sums[: -self.gram]) * self.down[: n - self.gram + 1]
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                g = (g ^ (g >> np.uint64(shift))) * np.uint64(factor)
            g ^= g >> np.uint64(31)
        size, out = 1, g
        while 2 * size <= self.inner:
            out = np.minimum(out[:-size], out[size:])
            size *= 2
        rest = self.inner - size
        return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out

    def runs(self, words: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the least grams of its windows, one of each run of windows, and the window where the run begins."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        windows = np.maximum(lengths - (self.gram + self.inner - 2), 0)
        if not windows.any():
            return [none] * len(words)
        at = spans(np.cumsum(lengths) - lengths, windows)
        least = self.least(words)[at]
        new = np.concatenate([[True], (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)])
        text = np.repeat(np.arange(len(words)), windows)
        new[1:] |= text[1:] != text[:-1]
        first = np.cumsum(windows) - windows
        places = np.flatnonzero(new)
        lows = (places - first[text[places]]).astype(np.int32)
        edges = np.searchsorted(text[places], np.arange(len(words) + 1))
        grams = least[places].view(np.int64)
        return [(grams[a:b], lows[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _key(text: Column) -> list[Column]:
    """Two independent hashes of a text's bytes."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")]


def _words(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Of every row: id, key of the text, number of words, digest of all words, grams and where their runs begin."""

    @F.pandas_udf("n long, sha string, gram array<long>, lo array<int>")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams = Grams(gram, window)
        for texts in batches:
            out = []
            for a, b in by_bytes(texts.tolist(), 1 << 20):
                words = [t.split() for t in texts.iloc[a:b]]
                out += [(len(w), hashlib.sha256(b" ".join(w)).hexdigest(), *r) for w, r in zip(words, grams.runs(words), strict=True)]
            yield pd.DataFrame(out, columns=["n", "sha", "gram", "lo"])

    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select("doc_id", *_key(text), made(text).alias("w")).select("doc_id", *_KEY, "w.*")


def _stretches(docs: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """The stretches of text of all groups that two documents share: gram, words, where in which text, its smallest id."""
    runs = texts.select(*_KEY, "least", F.posexplode("gram").alias("nth", "gram"), "lo", "n")
    end = F.when(F.col("nth") + 1 < F.size("lo"), F.get("lo", F.col("nth") + 1)).otherwise(F.col("n").cast("int") - window + 1)
    runs = runs.select(*_KEY, "least", "gram", F.get("lo", F.col("nth")).alias("lo"), end.alias("hi"))
    shared = runs.groupBy("gram").agg(F.min("least").alias("low"), F.max("least").alias("high")).filter("low < high").select("gram")
    shared = written(shared, "shared_grams")
    asked = runs.join(sized(shared, shared.count(), 16), "gram").groupBy(*_KEY).agg(F.first("least").alias("least"), F.collect_list(F.struct("gram", "lo", "hi")).alias("r"))
    side = asked.select(*_KEY, "least", *[F.col(f"r.{c}").alias(c) for c in ("gram", "lo", "hi")])
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    own = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), text).select("id", "text", *_key(F.col("text")))
    met = own.join(side, [own[k] == side[k] for k in _KEY] + [F.col("id") == F.col("least")]).select(side["k1"], side["k2"], "least", "text", "gram", "lo", "hi")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k1, k2, least, text, gram, lo, hi in pdf.itertuples(index=False):
                words = text.split()
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                joined = b" ".join(words)
                starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[lo].tolist()
                stops = (ends[np.asarray(hi) + window - 2] - 1).tolist()
                out += [(k1, k2, least, g, a, joined[s:e]) for g, a, s, e in zip(gram, lo, starts, stops, strict=True)]
            yield pd.DataFrame(out, columns=["k1", "k2", "least", "gram", "lo", "words"])

    return met.mapInPandas(cut, "k1 long, k2 long, least long, gram long, lo int, words binary")


def sorted_suffixes(ids: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at ``starts``, sorted by their first ``depth`` words, and how many words each shares with the one before (``depth`` at most)."""
    names, ranks, size = [(1, ids)], ids, 1
    while 2 * size <= depth:
        ranks = np.unique(ranks[:-size].astype(np.int64) * (int(ranks.max(initial=0)) + 1) + ranks[size:], return_inverse=True)[1]
        size *= 2
        names.append((size, ranks))
    # Two overlapping halves give the order of the whole depth.
    order = np.lexsort((ranks[starts + depth - size], ranks[starts]))
    a, b = starts[order[:-1]], starts[order[1:]]
    shared = np.zeros(len(a), np.int64)
    for size, ranks in reversed(names):
        for _ in range(2):
            fits = np.flatnonzero(shared + size <= depth)
            same = ranks[a[fits] + shared[fits]] == ranks[b[fits] + shared[fits]]
            shared[fits[same]] += size
    return order, np.concatenate([np.zeros(min(1, len(starts)), np.int64), shared])


def repeats(stretches: list[bytes], least: np.ndarray, window: int) -> list[np.ndarray]:
    """For every window of every stretch the smallest document with the same words."""
    words = [s.split() for s in stretches]
    numbers: dict[bytes, int] = {}
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in chain.from_iterable(words)), np.int64, int(lengths.sum()))
    windows = lengths - window + 1
    starts = spans(np.cumsum(lengths) - lengths, windows)
    order, shared = sorted_suffixes(ids, starts, window)
    # The deep nodes: runs of neighbours with a window or more in common.
    nodes = np.flatnonzero(shared < window)
    lows = np.minimum.reduceat(np.repeat(least, windows)[order], nodes)
    out = np.empty(len(starts), np.int64)
    out[order] = np.repeat(lows, np.diff(np.append(nodes, len(starts))))
    return np.split(out, np.cumsum(windows)[:-1])


def _in_trees(pieces: DataFrame, large: DataFrame, n_large: int, contents: DataFrame, window: int) -> DataFrame:
    """``(k1, k2, starts)``: repeated windows by the trees of all groups but the large ones."""
    small = contents.join(sized(large, n_large, 16), "gram", "left_anti")
    total = small.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    bins = max(1, -(-int(total) // TREE_WORDS))

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        lows = repeats(pdf["words"].tolist(), pdf["low"].to_numpy(np.int64), window)
        lost = np.fromiter((x.min() for x in lows), np.int64, len(lows)) < pdf["high"].to_numpy(np.int64)
        return pd.DataFrame({"c1": pdf["c1"][lost], "c2": pdf["c2"][lost], "lows": [x for x, y in zip(lows, lost, strict=True) if y]})

    dealt = small.withColumn("bin", F.pmod(F.xxhash64("gram"), F.lit(bins)))
    found = written(dealt.groupBy("bin").applyInPandas(tree, "c1 long, c2 long, lows array<long>"), "repeats")
    count, held = found.agg(F.count("*"), F.coalesce(F.sum(F.size("lows")), F.lit(0))).first()
    places = pieces.select(*_KEY, "least", "lo", "c1", "c2").join(sized(found, 1, 32 * count + 8 * held), ["c1", "c2"])
    at = F.filter(F.transform("lows", lambda low, i: F.when(low < F.col("least"), F.col("lo") + i)), lambda x: x.isNotNull())
    return places.select(*_KEY, at.alias("starts")).filter(F.size("starts") > 0)


def _in_large_groups(pieces: DataFrame, large: DataFrame, n_large: int, window: int) -> DataFrame:
    """``(k1, k2, starts)``: repeated windows of the large groups, whose prefixes are the whole windows."""

    @F.pandas_udf("array<struct<d1 long, d2 long>>")
    def digests(stretches: pd.Series) -> pd.Series:
        out = []
        for words in stretches:
            ends = [*np.flatnonzero(np.frombuffer(words, np.uint8) == 32).tolist(), len(words)]
            begins = [0, *(e + 1 for e in ends[:-1])]
            each = [xxhash.xxh3_128_digest(words[a:b]) for a, b in zip(begins, ends[window - 1 :], strict=False)]
            out.append([{"d1": d1, "d2": d2} for d1, d2 in np.frombuffer(b"".join(each), "<i8").reshape(-1, 2).tolist()])
        return pd.Series(out)

    hot = pieces.select(*_KEY, "least", "lo", "words", "gram").join(sized(large, n_large, 16), "gram")
    each = hot.select(*_KEY, "least", "lo", F.posexplode(digests("words")).alias("nth", "d")).select(*_KEY, "least", (F.col("lo") + F.col("nth")).alias("start"), "d.*")
    each = written(each, "windows")
    nodes = each.groupBy("d1", "d2").agg(F.min("least").alias("low"), F.max("least").alias("high")).filter("low < high").drop("high")
    nodes = written(nodes, "nodes")
    lost = each.join(sized(nodes, nodes.count(), 32), ["d1", "d2"]).filter("low < least")
    return lost.select(*_KEY, F.array("start").alias("starts"))


def _removed(docs: DataFrame, lost: DataFrame, window: int) -> DataFrame:
    """``(k1, k2, removed, sha)`` of the texts that lose some words."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    own = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), text).select("id", "text", *_key(F.col("text")))
    met = own.join(lost, [own[k] == lost[k] for k in _KEY] + [F.col("id") == F.col("least")])

    @F.pandas_udf("removed long, sha string")
    def taken(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts in batches:
            out = []
            for text, at in zip(texts, starts, strict=True):
                words = text.split()
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, np.asarray(at) + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                out.append((int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["removed", "sha"])

    done = met.select(lost["k1"], lost["k2"], taken("text", "starts").alias("r")).select(*_KEY, "r.*")
    return done.dropDuplicates(_KEY)


def removed(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    bounded_batches(docs.sparkSession)
    with ExitStack() as held:
        kept = lambda df, name: held.enter_context(stored(df, name))
        rows = kept(_words(docs.select("doc_id", "text"), window, gram), "words")
        own_id = F.coalesce("doc_id", F.lit(LAST_ID))
        texts = rows.filter(F.col("n") >= window).groupBy(*_KEY).agg(F.min(own_id).alias("least"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n", "gram", "lo")])
        texts = kept(texts, "texts")
        pieces = _stretches(docs, texts, window)
        pieces = kept(pieces.withColumns({"c1": F.xxhash64("words"), "c2": F.xxhash64(F.lit(7), "words")}), "stretches")
        # Equal stretches become one, in part before they are shuffled.
        contents = pieces.groupBy("gram", "c1", "c2").agg(F.min("least").alias("low"), F.max("least").alias("high"), F.first("words").alias("words"))
        contents = kept(contents.withColumn("n_words", F.length("words") - F.length(F.replace(F.col("words").cast("string"), F.lit(" "))) + 1), "contents")
        large = kept(contents.groupBy("gram").count().filter(F.col("count") > GROUP).select("gram"), "large")
        n_large = large.count()
        lost = _in_trees(pieces, large, n_large, contents, window).unionByName(_in_large_groups(pieces, large, n_large, window))
        lost = lost.groupBy(*_KEY).agg(F.flatten(F.collect_list("starts")).alias("starts"))
        lost = kept(lost.join(texts.select(*_KEY, "least"), _KEY), "lost")
        some = kept(_removed(docs, lost, window), "removed")
        fate = texts.select(*_KEY, "least", "copies").join(some, _KEY, "left").filter((F.col("copies") > 1) | F.col("removed").isNotNull())
        fate = kept(fate.select(*_KEY, "least", "removed", F.col("sha").alias("left")), "fates")
        again = own_id > F.col("least")
        done = rows.select("doc_id", *_KEY, "n", "sha").join(sized(fate, fate.count(), 140), _KEY, "left")
        return written(
            done.select(
                "doc_id",
                F.col("n").alias("n_words"),
                F.when(again, F.col("n")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
                F.when(again, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("left", "sha")).alias("kept_sha256"),
            ),
            "deduped",
        )
