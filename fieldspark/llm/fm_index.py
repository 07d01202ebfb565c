"""An FM-index of a delimited vocabulary, and search schemes for one error over it and its mirror image.

The text is every word with a delimiter before it, read as a circle. Suffixes are ranked so that delimiters stand in the
order of the words after them; a pattern's occurrences are an interval of ranks, and one step finds the interval of the
pattern with one more symbol before it. An index of the words and one of the reversed words make patterns grow at either
end. Both halves of a word stand at a delimiter, so a search begins there, matches its half exactly, and goes on across the
other half to the delimiter at the far end, in one direction: it needs the ranks of one of the two indexes only.
"""

from __future__ import annotations

import numpy as np

#: Symbols read from intervals in one vector operation, about.
STEP = 1 << 20


def flat(words: list[str], letters: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of all words side by side, bounds of the words, the code points that symbols 1, 2 ... stand for)."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    letters = np.unique(points) if letters is None else letters
    return np.searchsorted(letters, points) + 1, np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64), letters


class Index:
    """``symbols`` (from 1 on) of distinct words in their order, word i at bounds[i] to bounds[i + 1]."""

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray, kinds: int):
        self.words, self.kinds = len(bounds) - 1, kinds
        n = self.size = len(symbols) + self.words
        text = np.zeros(n, np.int64)
        text[np.arange(len(symbols)) + np.repeat(np.arange(self.words), np.diff(bounds)) + 1] = symbols
        rank = text + self.words - 1
        rank[text == 0] = np.arange(self.words)
        step = 1
        while True:
            key = rank * (self.words + kinds + n) + np.roll(rank, -step)
            order = np.argsort(key, kind="stable")
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            if rank[order[-1]] == n - 1 or step > n:
                break
            step *= 2
        self.before = text[order - 1]  # the symbol before each suffix, by rank
        self.places = np.sort(self.before * n + np.arange(n))  # by symbol, then by rank

    def back(self, symbol: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The first rank of a suffix that begins with ``symbol`` before one of at least ``rank``."""
        return np.searchsorted(self.places, symbol * self.size + rank)

    def next(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval's number, symbol) of all letters before the suffixes of the intervals."""
        wide = high - low > 4 * self.kinds
        found = []
        narrow = np.flatnonzero(~wide)
        ends = np.cumsum(high[narrow] - low[narrow])
        k = 0
        while k < len(narrow):
            j = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + STEP, "right")))
            own = narrow[k:j]
            count = high[own] - low[own]
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[own], count)
            found.append(np.unique(np.repeat(own, count) * (self.kinds + 1) + self.before[at]))
            k = j
        at = np.flatnonzero(wide)
        for symbol in range(1, self.kinds + 1) if len(at) else ():
            s = np.full(len(at), symbol)
            found.append(at[self.back(s, low[at]) < self.back(s, high[at])] * (self.kinds + 1) + symbol)
        both = np.concatenate(found) if found else np.zeros(0, np.int64)
        both = both[both % (self.kinds + 1) > 0]
        return both // (self.kinds + 1), both % (self.kinds + 1)

    def one_error(self, symbols: np.ndarray, begin: np.ndarray, step: int, size: np.ndarray, exact: np.ndarray, drops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all words of the index that differ from a query by one symbol beyond its first ``exact``.

        A query's symbols are ``symbols`` at ``begin``, ``begin + step`` ..., ``size`` of them, read against the direction of
        the index (its words are matched from their ends). With ``drops`` a symbol of the query is left out, else one is
        replaced or inserted. Each word is found once: an inserted symbol differs from the one that it comes before, one
        left out from the next.
        """
        q = np.arange(len(begin))
        low, high, at = np.zeros(len(q), np.int64), np.full(len(q), self.words), np.zeros(len(q), np.int64)
        free, found = np.ones(len(q), bool), []  # free: without an error so far
        while len(q):
            done = at == size[q]
            here = np.where(done, 0, symbols[begin[q] + step * np.minimum(at, size[q] - 1)])
            may = free & (at >= exact[q])
            # an error here
            out = np.flatnonzero(may & drops[q] & ~done)
            following = symbols[begin[q[out]] + step * np.minimum(at[out] + 1, size[q[out]] - 1)]
            out = out[(at[out] + 1 == size[q[out]]) | (following != here[out])]
            into = np.flatnonzero(may & ~drops[q])
            which, symbol = self.next(low[into], high[into])
            which = into[which]
            other = symbol != here[which]
            which, symbol = which[other], symbol[other]
            new_low, new_high = self.back(symbol, low[which]), self.back(symbol, high[which])
            instead = ~done[which]
            # no error here
            on = np.flatnonzero(~(free & done))
            on_low, on_high = self.back(here[on], low[on]), self.back(here[on], high[on])
            some = on_low < on_high
            on, on_low, on_high = on[some], on_low[some], on_high[some]
            ended = done[on]
            found.append((q[on[ended]], on_low[ended]))
            on, on_low, on_high = on[~ended], on_low[~ended], on_high[~ended]
            q, low, high, at, free = (
                np.concatenate([q[out], q[which], q[which[instead]], q[on]]),
                np.concatenate([low[out], new_low, new_low[instead], on_low]),
                np.concatenate([high[out], new_high, new_high[instead], on_high]),
                np.concatenate([at[out] + 1, at[which], at[which[instead]] + 1, at[on] + 1]),
                np.concatenate([np.zeros(len(out) + len(which) + int(instead.sum()), bool), free[on]]),
            )
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (q, q)
