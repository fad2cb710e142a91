"""Near duplicates by their similarity itself: every pair of texts whose sets of five-word shingles have a Jaccard index of 0.8 or more.

First the fingerprints of the five-word shingles are joined in their trie (``simhash.links``), and
a text is compared with the nearest one found; that links most copies at little cost. What
fingerprints miss is found by a prefix filter, which loses no pair: a text's shingles are put in
one order for all texts, and two texts that are similar enough share one of their first
``n - ceil(0.8 n) + 1``. The order is that of the shingles' hashes. A shingle that too many texts
hold early would make pairs with the square of their number, so it is moved to the end of the
order, exactly counted, and the texts that held it get others in its place.

Shingles are moved in several rounds, because those that remain make the pairs: in a group
of near copies the texts that differ most then have only shingles of their own early and meet no one. Of the shingles
that the same texts hold early one is enough, the first in the order.

A text meets a leader of each of its early shingles, then those in other components
that are left. Two texts that meet are compared by the parities of their shingles' numbers on some bits, which take
a fraction of the room of the shingles and rule nearly all dissimilar pairs out. The sets of the others are compared,
each pair once.

NULL and empty texts and texts without words are one group. Fewer words than a shingle make one
shingle. NULL ids are members but name no group that has another.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructType

from tradeloom.llm import simhash
from tradeloom.llm.common import BROADCAST_BYTES, bounded_batches, by_bytes, raw_text, sized
from tradeloom.llm.components import components
from tradeloom.session import shuffles_freed, stored, written

WIDTH = 5
#: Texts that may hold a shingle early, rounds in which shingles are moved to the end, texts of a shingle that meet in a slice.
TOO_MANY, TURNS, SLICE = 32, 5, 512
#: Times that the texts of a shingle meet a leader.
LED = 1
#: What is known of a text besides its shingles.
_TEXT = ("key", "hash", "copied", "n")
#: Bytes of an Arrow batch: shingles take many times the room of their texts.
BATCH = 1 << 20


def shingles(text: bytes) -> np.ndarray:
    return np.unique(np.array(simhash.shingle_hashes(text, WIDTH), np.uint64).view(np.int64))


def early(held: np.ndarray, late: np.ndarray | None = None) -> np.ndarray:
    """The first of these sorted shingles; ``late`` ones go last."""
    n = len(held)
    if late is not None and len(late):
        last = np.isin(held, late)
        held = np.concatenate([held[~last], held[last]])
    return held[: n - (4 * n + 4) // 5 + 1]


@F.pandas_udf(ArrayType(LongType()))
def _shingles(texts: pd.Series) -> pd.Series:
    return pd.Series([shingles(t) for t in texts])


def _after(late: DataFrame | None):
    """A function of a text's shingles and the late ones that are known of it: its early shingles now, and all its late ones.

    ``late`` are the late shingles of all texts, if they are few enough to be sent to every task; without them the known ones are all.
    """
    few = None
    if late is not None:
        few = late.sparkSession.sparkContext.broadcast(np.sort(np.array([r["s"] for r in late.toLocalIterator()], np.int64)))

    @F.pandas_udf(StructType().add("early", ArrayType(LongType())).add("late", ArrayType(LongType())))
    def moved(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, known in batches:
            rows = []
            for text, own in zip(texts, known, strict=True):
                held = shingles(text)
                last = own if few is None else held[_among(held, few.value)]
                rows.append((early(held, last), last))
            yield pd.DataFrame(rows, columns=["early", "late"])

    return moved


def _among(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in the sorted array ``some``; it is searched, not gone through."""
    if not len(some):
        return np.zeros(len(values), bool)
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values


def parity(held: np.ndarray) -> bytes:
    """Whether an even or odd number of these shingles falls on each of at least ``2 n`` bits, by their lowest bits."""
    bits = max(64, 1 << (2 * len(held) - 1).bit_length()) if len(held) else 64
    return np.packbits(np.bincount((held.view(np.uint64) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def parities_may_be_similar(n_a: int, n_b: int, a: bytes, b: bytes) -> bool:
    """Whether sets of these sizes and parities can have a Jaccard index of 0.8.

    Every bit that differs stands for a shingle at least that only one of them has. The longer one is folded.
    """
    if 5 * min(n_a, n_b) < 4 * max(n_a, n_b):
        return False
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return 9 * int(np.bitwise_count(x ^ y).sum()) <= n_a + n_b


@F.pandas_udf(StructType().add("key", LongType()).add("n", IntegerType()).add("fp", LongType()).add("early", ArrayType(LongType())).add("parity", BinaryType()))
def _marks(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = []
        for a, b in by_bytes(texts.tolist(), 1 << 20):
            each = [np.array(simhash.shingle_hashes(t, WIDTH), np.uint64) for t in texts.iloc[a:b]]
            prints = simhash.majorities(np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))).view(np.int64)
            for fp, hashes in zip(prints.tolist(), each, strict=True):
                held = np.unique(hashes.view(np.int64))
                rows.append((xxhash.xxh64_intdigest(held.tobytes()) - (1 << 63), len(held), fp, early(held), parity(held)))
        yield pd.DataFrame(rows, columns=["key", "n", "fp", "early", "parity"])


def may_be_similar(n_a: int, n_b: int, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether sets of these sizes with these first elements, in order of value, can have a Jaccard index of 0.8."""
    if 5 * min(n_a, n_b) < 4 * max(n_a, n_b):
        return False
    # Up to the lesser of the two last values both sets are known.
    known_a, known_b = (len(a), int(np.searchsorted(b, a[-1], "right"))) if len(a) and len(b) and a[-1] <= b[-1] else (int(np.searchsorted(a, b[-1], "right")) if len(b) else 0, len(b))
    both = len(np.intersect1d(a[:known_a], b[:known_b], assume_unique=True))
    return 9 * (both + min(n_a - known_a, n_b - known_b)) >= 4 * (n_a + n_b)


class _Search:
    """The tables of one run; they are freed with ``held``."""

    def __init__(self, docs: DataFrame, held: ExitStack):
        self.docs, self.held = docs, held
        row = F.monotonically_increasing_id().alias("row")
        marked = docs.select("doc_id", F.xxhash64("text").alias("hash"), _marks(raw_text("text")).alias("m")).select("doc_id", "hash", row, "m.*")
        self.marked = self.keep(marked, "marks")
        # Sets with one hash are one text from here on, so copies make no pairs.
        first = self.marked.groupBy("key").agg(F.min("row").alias("row"), F.min("doc_id").alias("least"), (F.count("*") > 1).alias("copied"))
        first = self.keep(first, "firsts")
        self.texts = self.marked.drop("doc_id").join(sized(first.select("row", "copied"), first.count(), 24), "row").drop("row")
        self.first = first.select("key", "least")
        # Not createDataFrame: that starts Python workers of another kind, which stay.
        nothing = docs.sparkSession.range(0).selectExpr("id AS a", "id AS b")
        self.compared, self.found, self.links = nothing, None, nothing

    def keep(self, df: DataFrame, name: str, held: ExitStack | None = None) -> DataFrame:
        """``df`` in a table, until the run ends or ``held`` does."""
        return (held or self.held).enter_context(stored(df, name))

    def with_texts(self, keys: DataFrame, n: int, row_bytes: int) -> DataFrame:
        """``keys`` (with key, hash and copied) with their texts, each once.

        Only texts of sets that several rows have are shuffled for that; the others are found once anyway.
        """
        texts = self.docs.select(F.xxhash64("text").alias("hash"), raw_text("text").alias("text"))
        found = texts.join(sized(keys, n, row_bytes), "hash")
        return found.filter(~F.col("copied")).unionByName(found.filter("copied").dropDuplicates(["key"]))

    # -- candidates ---------------------------------------------------------

    def by_fingerprint(self) -> DataFrame:
        """Each text with the first text of its fingerprint, and that one with the first of its nearest."""
        owners = self.keep(self.texts.groupBy("fp").agg(F.min("key").alias("owner")), "owners")
        n = owners.count()
        same = self.texts.select("key", "fp").join(sized(owners, n, 24), "fp").select(F.col("owner").alias("a"), F.col("key").alias("b"))
        near = simhash.links(owners.select("fp"))
        near = near.select("a", "b").unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("b"))
        near = self.keep(near.filter("b < a"), "nearest")
        side = sized(owners, n, 24)
        named = near.join(side.select(F.col("fp").alias("a"), F.col("owner").alias("own")), "a").join(side.select(F.col("fp").alias("b"), F.col("owner").alias("other")), "b")
        return same.unionByName(named.select(F.col("own").alias("a"), F.col("other").alias("b")))

    def members(self) -> DataFrame:
        """``(s, key, n, at)``: the early shingles of texts that another text holds early too."""
        current = self.texts.select(*_TEXT, "early")
        new = current.select("early")
        late, n_late = self.docs.sparkSession.range(0).select(F.col("id").alias("s")), 0
        with ExitStack() as moves:
            for _ in range(TURNS):
                # After the first turn, only what the last one brought to the front can have become hot.
                many = new.select(F.explode("early").alias("s")).groupBy("s").count().filter(F.col("count") > TOO_MANY)
                hot = self.keep(many.select("s").join(sized(late, n_late, 16), "s", "left_anti"), "hot", moves)
                n_hot = hot.count()
                if not n_hot:
                    break
                late, n_late = late.unionByName(hot), n_late + n_hot
                changed, n = self._moved(current, sized(hot, n_hot, 16), late, n_late, moves)
                new = changed.select(F.filter("early", lambda s: s > F.col("top")).alias("early"))
                current = current.join(sized(changed.select("key"), n, 16), "key", "left_anti").unionByName(changed.drop("top"))
            each = current.select("key", "n", F.posexplode("early").alias("at", "s"))
            # Of the shingles that the same texts hold early, their first is the first that any two of them share.
            held = each.groupBy("s").agg(F.count("*").alias("many"), F.bit_xor("key").alias("xor"), F.min("at").alias("at")).filter("many > 1")
            shared = self.keep(held.groupBy("many", "xor").agg(F.min_by("s", "at").alias("s")), "shared", moves)
            return self.keep(each.join(sized(shared.select("s"), shared.count(), 16), "s").select("s", "key", "n", "at"), "members")

    def _moved(self, current: DataFrame, hot: DataFrame, late: DataFrame, n_late: int, moves: ExitStack) -> tuple[DataFrame, int]:
        """The texts with a hot shingle early, and their number; now no shingle in ``late`` is before others.

        ``top`` is the last of a text's early shingles before, but for late ones.

        A text's shingles take more room than the text, so they stay in the task that makes them: they are compared there
        with all late ones, or those that are late are joined first if they are too many to be sent.
        """
        with ExitStack() as now:
            hit = current.select(*_TEXT, F.array_max("early").alias("top"), F.explode("early").alias("s")).join(hot, "s").drop("s").distinct()
            hit = self.keep(hit, "moved", now)
            n = hit.count()
            if n_late * 16 <= BROADCAST_BYTES:
                sets = self.with_texts(hit, n, 40).withColumn("known", F.array().cast("array<long>"))
                moved = _after(late)
            else:
                each = self.with_texts(hit, n, 40).select("key", F.explode(_shingles("text")).alias("s"))
                found = each.join(sized(late, n_late, 16), "s").groupBy("key").agg(F.collect_list("s").alias("known"))
                known = self.keep(hit.join(found, "key"), "known", now)
                room = known.agg(F.sum(F.size("known") * 8 + 64)).first()[0] or 0
                sets, moved = self.with_texts(known, 1, room), _after(None)
            return self.keep(sets.select(*_TEXT, "top", moved("text", "known")["early"].alias("early")), "again", moves), n

    def open_members(self, members: DataFrame, now: ExitStack) -> DataFrame:
        named = members.join(sized(self.found, self.found.count(), 24), members["key"] == self.found["node"], "left")
        return self.keep(named.select("s", "key", "n", "at", F.coalesce("component", "key").alias("component")), "open", now)

    # -- comparison ---------------------------------------------------------

    def compare(self, pairs: DataFrame) -> None:
        """Link the similar ones among the pairs that were not compared before, and find components anew."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
        pairs = self.keep(pairs.join(self.compared, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            self.compared = self.compared.unionByName(pairs)
            with ExitStack() as now:
                hopeful = self.keep(self._met(pairs, self.texts.select("key", "n", F.col("parity").alias("held")), _hopeful, now), "hopeful", now)
                asked = self.keep(hopeful.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "asked", now)
                n = asked.count()
                keys = self.texts.select("key", "hash", "copied", "n").join(sized(asked, n, 16), "key")
                sets = self.with_texts(keys, n, 40).select("key", "n", _shingles("text").alias("held"))
                self.links = self.links.unionByName(self.keep(self._met(hopeful, sets, _similar, now), "links"))
        self.found = written(components(self.links, "a", "b"), "found")

    def _met(self, pairs: DataFrame, sets: DataFrame, alike, now: ExitStack) -> DataFrame:
        """The pairs whose sets are ``alike``; ids are joined first, and a text in many pairs is dealt in slices."""
        ends = self.keep(pairs.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices")), "ends", now)
        n = ends.count()
        wanted = self.keep(sets.join(sized(ends, n, 24), "key"), "wanted", now)
        spread = wanted.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("held").alias("held_a"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
        slices = sized(ends.select(F.col("key").alias("a"), "slices"), n, 24)
        dealt = pairs.join(slices, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("slices")).cast("int").alias("slice"))
        other = wanted.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("held").alias("held_b"))
        met = dealt.join(spread, ["a", "slice"]).join(other, "b").select("a", "b", "n_a", "n_b", "held_a", "held_b")
        return met.mapInPandas(alike, "a long, b long")


def _hopeful(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        good = [parities_may_be_similar(*row) for row in pdf[["n_a", "n_b", "held_a", "held_b"]].itertuples(index=False, name=None)]
        yield pdf.loc[np.array(good, bool), ["a", "b"]]


def _similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        good = [may_be_similar(len(a), len(b), early(a), early(b)) and 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b)) for a, b in zip(pdf["held_a"], pdf["held_b"], strict=True)]
        yield pdf.loc[np.array(good, bool), ["a", "b"]]


def _may(n: Column, at: Column, other_n: Column, other_at: Column) -> Column:
    """Whether texts of these lengths can be similar enough if this is the first shingle they share."""
    return (5 * F.least(n, other_n) >= 4 * F.greatest(n, other_n)) & (9 * F.least(n - at, other_n - other_at) >= 4 * (n + other_n))


def _with_leaders(members: DataFrame, now: ExitStack, turn: int) -> DataFrame:
    """Each member of a shingle with the shingle's leader, if they aren't linked yet.

    The first leader is the text that holds the shingle earliest: it has the fewest shingles of its own, so in a group of
    near copies it is close to what they are copies of. Afterwards every shingle has a leader of its own, so a text of a
    large group meets many of it.
    """
    order = F.xxhash64("key", "s", F.lit(turn)) if turn else F.struct("at", F.xxhash64("key"))
    leaders = members.groupBy("s").agg(F.min_by(F.struct("key", "n", "at", "component"), order).alias("l"))
    leaders = now.enter_context(stored(leaders, "leaders"))
    met = members.join(sized(leaders, leaders.count(), 48), "s").filter((F.col("component") != F.col("l.component")) & _may(F.col("n"), F.col("at"), F.col("l.n"), F.col("l.at")))
    return met.select(F.col("l.key").alias("a"), F.col("key").alias("b")).distinct()


def _all_left(members: DataFrame, now: ExitStack) -> DataFrame:
    """All members of a shingle that aren't linked yet, in slices."""
    several = members.groupBy("s").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
    several = now.enter_context(stored(several.filter("low < high").select("s", "slices"), "several"))
    left = now.enter_context(stored(members.join(sized(several, several.count(), 24), "s"), "unlinked"))
    one = left.withColumn("slice", F.pmod(F.xxhash64("key"), F.col("slices")).cast("int")).drop("slices")
    other = left.select("s", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), *[F.col(c).alias(f"o_{c}") for c in ("key", "n", "at", "component")])
    met = one.join(other, ["s", "slice"]).filter((F.col("key") < F.col("o_key")) & (F.col("component") != F.col("o_component")) & _may(F.col("n"), F.col("at"), F.col("o_n"), F.col("o_at")))
    return met.select(F.col("key").alias("a"), F.col("o_key").alias("b")).distinct()


def _rows(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text hash, the set's hash, a set's hash that names the group, component_id."""
    bounded_batches(docs.sparkSession, BATCH)
    with shuffles_freed(docs.sparkSession), ExitStack() as held:
        search = _Search(docs, held)
        search.compare(search.by_fingerprint())
        members = search.members()
        for turn in range(LED + 1):
            with ExitStack() as now:
                open_members = search.open_members(members, now)
                search.compare(_with_leaders(open_members, now, turn) if turn < LED else _all_left(open_members, now))
        found = search.found
        joined = search.first.join(found, search.first["key"] == found["node"], "left").select("key", "least", F.coalesce("component", "key").alias("root"))
        roots = joined.groupBy("root").agg(F.min("least").alias("component_id"))
        named = written(joined.select("key", "root").join(roots, "root").select("key", "root", "component_id"), "named")
        return written(search.marked.select("doc_id", "hash", "key").join(sized(named, named.count(), 80), "key"), "groups")


def grouped(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, component_id."""
    return _rows(docs).select("doc_id", "component_id")


def kept(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, with the smallest id, and all its columns."""
    return simhash.kept(docs, _rows(docs))
