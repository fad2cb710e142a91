"""Token ids of texts by way of their distinct chunks, each of which is encoded once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tradeloom.llm.common import spans


class _Numbers(dict):
    """Numbers chunks as they come and keeps the new ones."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        self.new.append(chunk)
        return n


class ChunkPool:
    """Remembers the ids of chunks; forgets them all when there are too many."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 400_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def tokens(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has; a text is a list of chunks."""
        if len(self.numbers) > self.most:
            self._clear()
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        number = self.numbers.__getitem__
        which = np.concatenate([np.zeros(0, np.int64), *(np.fromiter(map(number, chunks), np.int64, len(chunks)) for chunks in texts)])
        if self.numbers.new:
            ids, lengths = self.encode(self.numbers.new)
            self.numbers.new = []
            self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        lengths = self.lengths[which]
        starts = np.cumsum(self.lengths) - self.lengths
        ends = np.concatenate([[0], np.cumsum(lengths)])
        edges = np.concatenate([[0], np.cumsum(counts)])
        return self.ids[spans(starts[which], lengths)], np.diff(ends[edges])


_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


class BytePool:
    """As :class:`ChunkPool` for texts as bytes, which are cut and numbered a batch at a time.

    A chunk is a run of ASCII blanks and what follows it. Equal chunks are found by a hash of their
    bytes and then compared, so only the distinct ones are looked at one by one.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = 400_000, block: int = 1 << 20):
        self.encode, self.most, self.block = encode, most, block
        self.base = 0x9E3779B97F4A7C15
        self.up = self.down = np.ones(1, np.uint64)
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.ids, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            up, down = np.full(n, self.base, np.uint64), np.full(n, pow(self.base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            with np.errstate(over="ignore"):
                self.up, self.down = np.cumprod(up), np.cumprod(down)

    def _distinct(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first of each kind of chunk, and the kind of every chunk."""
        self._powers(len(data) + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)])])
            h = (sums[starts + sizes] - sums[starts]) * self.down[starts]
        _, first, kind = np.unique(h, return_index=True, return_inverse=True)
        model = first[kind]
        if (sizes[model] == sizes).all() and (data == data[spans(starts[model], sizes)]).all():
            return first, kind
        places = np.arange(len(starts))
        seen: dict[bytes, int] = {}
        raw = data.tobytes()
        model = np.array([seen.setdefault(raw[a : a + n], i) for i, a, n in zip(places.tolist(), starts.tolist(), sizes.tolist(), strict=True)])
        return np.unique(model, return_inverse=True)

    def _numbered(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        first, kind = self._distinct(data, starts, sizes)
        raw, a, b = data.tobytes(), starts[first], starts[first] + sizes[first]
        chunks = [raw[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        new = [c for c in chunks if c not in self.numbers]
        if new:
            self.numbers.update(zip(new, range(len(self.numbers), len(self.numbers) + len(new)), strict=True))
            ids, lengths = self.encode(new)
            self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        return np.fromiter(map(self.numbers.__getitem__, chunks), np.int64, len(chunks))[kind]

    def tokens(self, texts: list[bytes], whole: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has; ``whole`` ones are not cut."""
        if len(self.numbers) > self.most:
            self._clear()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        edges = np.concatenate([[0], np.cumsum(sizes)])
        data = np.frombuffer(b"".join(texts), np.uint8)
        blank = _BLANK[data]
        cut = blank & ~np.concatenate([[False], blank[:-1]])[: len(blank)]
        for i in np.flatnonzero(whole):
            cut[edges[i] : edges[i + 1]] = False
        cut[edges[:-1][sizes > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        which, at = [np.zeros(0, np.int64)], 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + self.block, "right")))
            low, high = starts[at], ends[to - 1]
            which.append(self._numbered(data[low:high], starts[at:to] - low, ends[at:to] - starts[at:to]))
            at = to
        which = np.concatenate(which)
        lengths = self.lengths[which]
        first = np.cumsum(self.lengths) - self.lengths
        counts = np.bincount(np.searchsorted(edges, starts, "right") - 1, lengths, len(texts)).astype(np.int64)
        return self.ids[spans(first[which], lengths)], counts
