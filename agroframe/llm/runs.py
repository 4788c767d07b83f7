"""Periodic runs of words, found on a run-length grammar made by recompression.

The words of many documents, each closed by a symbol of its own, form one
string.  Recompression shrinks it level by level: block compression turns every
repetition of one symbol into a symbol (symbol, times), pair compression
splits the alphabet by a hash bit and turns every left-right neighbour pair into a
symbol.  Equal stretches get equal symbols but for their ends, so the grammar
answers how far two places agree (longest common extension) by climbing from level to level
and coming down again, without suffix arrays.

A run of period q and length at least max(6, 4 q) holds a place x of the grid of step
max(6, 4 q) - q with x and x + q both in the run.  So for every q the places of its
grid are the candidates (a harmonic sum, n log n in all); those whose words q apart agree are extended to
both sides exactly, and the extents give the runs.

All queries of a level are answered together in NumPy.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.llm.common import mix64

LEAST_LENGTH, LEAST_PERIODS = 6, 4
WORDS_PER_BATCH = 200_000  # words whose grammar is built at once; a longer document is a batch of its own
GRID_AT_ONCE = 2_000_000   # candidates compared at once


@dataclass
class Level:
    """A string of the grammar: its symbols, the first child of each node (one more entry closes the last), their word places."""

    symbol: np.ndarray
    start: np.ndarray
    first: np.ndarray   # into the level below
    parent: np.ndarray  # into the level above
    blocks: bool        # whether block compression made this level


def _parents(level: Level, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First children of the nodes above, one entry more, and every node's parent, where *opens* marks the first children."""
    first = np.flatnonzero(opens).astype(np.int32)
    return np.append(first, np.int32(len(opens))), (np.cumsum(opens) - 1).astype(np.int32)


def _renamed(symbol: np.ndarray, merged: np.ndarray, key: np.ndarray, names: int) -> tuple[np.ndarray, int]:
    """*symbol* with those *merged* replaced by new names, one per distinct *key*."""
    distinct, place = np.unique(key, return_inverse=True)
    out = symbol.copy()
    out[merged] = (names + place).astype(np.int32)
    return out, names + len(distinct)


def grammar(symbols: np.ndarray) -> list[Level]:
    """The levels of the run-length grammar of *symbols* (non-negative), from the string itself to a single node."""
    n = len(symbols)
    names = int(symbols.max()) + 1
    base = Level(symbols.astype(np.int32), np.arange(n, dtype=np.int32), np.arange(n + 1, dtype=np.int32), np.empty(0, np.int32), False)
    levels, turn = [base], 0
    while len(levels[-1].symbol) > 1:
        below = levels[-1]
        s = below.symbol
        blocks = turn % 2 == 0
        opens = np.ones(len(s), dtype=bool)
        if blocks:
            opens[1:] = s[1:] != s[:-1]
        else:
            seed = np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64))
            left = (mix64(s.astype(np.uint64) ^ seed) >> np.uint64(63)).astype(bool)
            opens[1:] = ~(left[:-1] & ~left[1:])
        turn += 1
        if opens.all():
            continue
        first, parent = _parents(below, opens)
        size = np.diff(first)
        merged = np.flatnonzero(size > 1)
        head = s[first[merged]].astype(np.int64)
        key = head * (int(size.max()) + 1) + size[merged] if blocks else head * names + s[first[merged] + 1]
        symbol, names = _renamed(s[first[:-1]], merged, key, names)
        below.parent = parent
        levels.append(Level(symbol, below.start[first[:-1]], first, np.empty(0, np.int32), blocks))
    return levels


def extension(levels: list[Level], a: np.ndarray, b: np.ndarray, forward: bool = True) -> np.ndarray:
    """Number of equal symbols from places *a* and *b* (different, pairwise) on, to the right or to the left.

    The string must begin and end with symbols that occur nowhere else.  Climbing, a pair of nodes is
    compared at its level: unequal nodes end the climb; equal ones that both stand at their parents' near end
    are left to the parents; else the rest of their block or pair is passed.  Coming down, the equal
    first children of unequal nodes are passed.
    """
    step = 1 if forward else -1
    u, v, who = a.astype(np.int64), b.astype(np.int64), np.arange(len(a))
    stopped: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for level, above in zip(levels, [*levels[1:], None]):
        differ = level.symbol[u] != level.symbol[v]
        if above is None:
            stopped.append((u, v, who))
            break
        pu, pv = level.parent[u], level.parent[v]
        if forward:
            ru, rv = above.first[pu + 1] - u, above.first[pv + 1] - v
            inner = (above.first[pu] != u) | (above.first[pv] != v)
        else:
            ru, rv = u - above.first[pu] + 1, v - above.first[pv] + 1
            inner = (above.first[pu + 1] - 1 != u) | (above.first[pv + 1] - 1 != v)
        inner &= ~differ
        passed = np.where(inner, np.minimum(ru, rv), 0) * step
        ends = differ | (inner & (ru != rv))
        u, v = u + passed, v + passed
        stopped.append((u[ends], v[ends], who[ends]))
        on = ~ends
        u, v, who = level.parent[u[on]].astype(np.int64), level.parent[v[on]].astype(np.int64), who[on]
        if not len(u):
            break
    u = v = who = np.empty(0, np.int64)
    for depth in range(len(stopped) - 1, -1, -1):
        u, v, who = (np.concatenate(x) for x in zip((u, v, who), stopped[depth]))
        if depth == 0:
            break
        level, below = levels[depth], levels[depth - 1]
        nu, nv = level.first[u + 1] - level.first[u], level.first[v + 1] - level.first[v]
        u, v = (level.first[u], level.first[v]) if forward else (level.first[u + 1] - 1, level.first[v + 1] - 1)
        same = below.symbol[u] == below.symbol[v]
        passed = np.where(same, np.minimum(nu, nv) if level.blocks else 1, 0) * step
        u, v = (u + passed).astype(np.int64), (v + passed).astype(np.int64)
    out = np.empty(len(a), dtype=np.int64)
    out[who] = (u - a[who]) * step
    return out


def _grids(lengths: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) of the candidates of all documents, in pieces of bounded size."""
    places, periods, held = [], [], 0
    order = np.argsort(-lengths, kind="stable")
    lengths, starts = lengths[order], starts[order]
    for q in range(1, int(lengths[0]) // LEAST_PERIODS + 1 if len(lengths) else 0):
        need = max(LEAST_LENGTH, LEAST_PERIODS * q)
        many = int(np.searchsorted(-lengths, -need, side="right"))  # documents that can hold such a run
        if not many:
            break
        count = (lengths[:many] - q - 1) // (need - q) + 1
        ends = np.cumsum(count)
        nth = np.arange(ends[-1]) - np.repeat(ends - count, count)
        places.append(np.repeat(starts[:many], count) + nth * (need - q))
        periods.append(np.full(len(nth), q))
        held += len(nth)
        if held >= GRID_AT_ONCE:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def find_runs(documents: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (start, length, period) of the runs of every document of word numbers, by start, then period."""
    lengths = np.array([len(d) for d in documents], dtype=np.int64)
    names = max((int(d.max()) for d in documents if len(d)), default=-1) + 1
    ends = np.cumsum(lengths + 1)
    starts = ends - lengths  # a closing symbol stands before every document and after the last
    text = np.empty(int(ends[-1]) + 1 if len(ends) else 1, dtype=np.int64)
    text[np.r_[starts - 1, len(text) - 1]] = names + np.arange(len(documents) + 1)
    for at, d in zip(starts, documents):
        text[at:at + len(d)] = d
    levels, found = None, []
    for x, q in _grids(lengths, starts):
        alike = text[x] == text[x + q]
        x, q = x[alike], q[alike]
        levels = levels or grammar(text)
        right = extension(levels, x, x + q)
        left = extension(levels, x - 1, x + q - 1, forward=False)
        whole = left + right + q
        keep = whole >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * q)
        found.append(np.stack([x - left, whole, q], axis=1)[keep])
    runs = np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)
    # a stretch also has the multiples of its period: the smallest stays
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.ones(len(runs), dtype=bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[fresh]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    cut = np.searchsorted(runs[:, 0], np.r_[starts, len(text)])
    return [runs[i:j] - (s, 0, 0) for i, j, s in zip(cut, cut[1:], starts)]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of *n* words stay: all but those that some run holds after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def split_words(text: str | None) -> list[bytes]:
    """Maximal runs of bytes other than space and \\x09-\\x0D."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, of every tenth document (by a crc of its id) with a periodic tail in place of its own."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>, collapsed string")
_FIELDS = {"doc_id": pa.int64(), "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(),
           "exponent_milli": pa.int64(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string(),
           "runs": pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
           "collapsed": pa.string()}


def _described(doc_id: int | None, words: list[bytes], runs: np.ndarray, texts: bool) -> tuple:
    listed = runs.tolist()
    if listed:
        start, length, period = min(listed, key=lambda r: (-r[1], r[0], r[2]))
        best = (start, length, period, 1000 * length // period)
        keep = kept_words(len(words), runs)
        words = [w for w, k in zip(words, keep.tolist()) if k]
    else:
        best = (None,) * 4
    collapsed = b" ".join(words)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in listed)
    out = (doc_id, len(listed), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())
    if texts:
        out += ([dict(zip(("start", "length", "period"), r)) for r in listed], collapsed.decode("utf-8", "surrogatepass"))
    return out


def runs_of(docs: DataFrame, prepare=lambda words, doc_id: words, texts: bool = True,
            doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's periodic runs and its text without their repeats.

    A run is a stretch of words of smallest period q and a length of at least max(6, 4 q)
    that no neighbouring word extends.  Returns doc_id, n_runs, the longest run (start, length, period,
    exponent_milli; ties: smallest start, then period; null without runs), runs_sha256 of the lines
    ``start,length,period`` and collapsed_sha256 of the words outside repeats; with *texts* also ``runs``
    and the ``collapsed`` text.  *prepare* may change a document's words first.

    Null, empty and blank texts have no words.  Every row is judged by itself, also where ids
    repeat or are null; an empty table gives no rows; other columns are ignored.
    """
    names = list(_FIELDS)[:None if texts else 8]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            numbers: dict[bytes, int] = {}
            coded = [np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64) for _, words in held]
            rows = [_described(i, words, found, texts) for (i, words), found in zip(held, find_runs(coded))]
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(c, _FIELDS[f]) for f, c in zip(names, columns)], names=names)

        held, size = [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = prepare(split_words(t.as_py()), i)
                if held and size + len(words) > WORDS_PER_BATCH:
                    yield flush()
                    held, size = [], 0
                held.append((i, words))
                size += len(words) + 1
        if held:
            yield flush()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = SCHEMA if texts else SCHEMA.split(", runs array")[0]
    return rows.mapInArrow(run, schema)
