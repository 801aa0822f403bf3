"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of consecutive words that repeats itself ``q`` words on,
``q`` its smallest period, at least ``2 * q`` long and not extended by a
neighbouring word.  Periods of 1 and 2 words are read off directly.  At each
dyadic scale ``t`` the periods ``3t <= p < 6t`` are found:

* A position is *synchronising* if the smallest name among the ``t + 1``
  windows of ``t`` words from it on belongs to its own window or to the one
  ``t`` words on; windows with a period up to ``t / 3`` have no name.  That
  depends on ``2t`` words only, so a run holds the same positions in every
  period.  Two of them with equal ``2t`` words propose their distance.  Equal
  contexts lie more than ``t / 3`` apart, so the next 18 suffice.
* Where ``3t - 1`` words have a period up to ``t / 3`` there may be no
  synchronising position.  Those regions are known from the scales below.
  Neighbouring ends of two of them propose their distance; two of one period
  that touch or overlap propose every distance that brings them into phase.

Every proposal is extended to both sides (common extensions by names of dyadic
windows, doubled and halved), so a false one yields nothing.  Words are
compared by 64-bit hashes.  Work grows with ``n log n``; documents are handled
together, a word of its own kind between them.

Rows: a null, empty or blank text has no words and no runs; ids may be null or
repeat, each row is judged alone; extra columns are kept unless their names
are those of the results, which replace them; a very long text is one piece
(about 250 bytes of memory a word).  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import bytes_of, hash_words, in_parts, mixed, ship

# names of windows are kept up to this many words; longer ones are compared in strides
TOP = 12
_NEXT = 18


class _Names:
    """Names of all windows of 1, 2, 4 .. words of a sequence of hashes."""

    def __init__(self, h):
        self.levels, self.n = [h], len(h)

    def at(self, k: int):
        import numpy as np

        while len(self.levels) <= k:
            low, w = self.levels[-1], 1 << (len(self.levels) - 1)
            if len(low) <= w:
                self.levels.append(low[:0])
                continue
            self.levels.append(mixed(low[:-w] * np.uint64(0x9E3779B97F4A7C15) + mixed(low[w:] + np.uint64(len(self.levels)))))
        return self.levels[k]

    def common(self, a, b, back: bool = False):
        """How many words agree from ``a`` and ``b`` on (``a < b``), or before
        them."""
        import numpy as np

        a, b = a.copy(), b.copy()
        got = np.zeros(len(a), np.int64)

        def step(k, some):
            w, names = 1 << k, self.at(k)
            x, y = (a[some] - w, b[some] - w) if back else (a[some], b[some])
            ok = (x >= 0) if back else (y + w <= self.n)
            ok[ok] = names[x[ok]] == names[y[ok]]
            hit = some[ok]
            move = -w if back else w
            a[hit] += move
            b[hit] += move
            got[hit] += w
            return hit

        # up while everything agrees, then down
        top, todo = 0, np.arange(len(a))
        started = np.zeros(len(a), np.int8)
        while len(todo):
            todo = step(top, todo)
            started[todo] = top + 1
            if top < TOP:
                top += 1
        for k in range(TOP, -1, -1):
            some = np.flatnonzero(started >= k)
            if len(some):
                step(k, some)
        return got


def _least(x, width: int):
    """Minimum of every ``width`` consecutive values."""
    import numpy as np

    n = len(x) - width + 1
    pad = -len(x) % width
    full = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, 1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _repeat_ranges(counts):
    """(owner, 0 .. count - 1) of every element of ranges of these sizes."""
    import numpy as np

    own = np.repeat(np.arange(len(counts)), counts)
    return own, np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)


def find_runs(h, doc, longest: int):
    """(start, end, period) arrays of all runs in the word hashes ``h``;
    ``doc`` numbers the documents, whose words must be separated by words
    that occur once; ``longest`` is the length of the longest document."""
    import numpy as np

    names = _Names(h)
    n = len(h)
    found = np.zeros((0, 3), np.int64)

    def keep(a, p, found):
        """Add the runs in which the words at ``a`` and ``a + p`` agree."""
        if not len(a):
            return found
        order = np.lexsort((a, p))
        a, p = a[order], p[order]
        new = []
        # a few proposals first: what they cover need not be extended again
        for stride in (4096, 64, 1):
            if not len(a) or len(a) < 16 * stride and stride > 1:
                continue
            x, q = a[::stride], p[::stride]
            s, e = x - names.common(x, x + q, back=True), x + names.common(x, x + q)
            new.append(np.stack([s, e + q, q], 1)[e - s >= q])
            j = np.searchsorted(q * (n + 1) + s, p * (n + 1) + a, side="right") - 1
            rest = (j < 0) | (q[j] != p) | (a >= e[j])
            a, p = a[rest], p[rest]
        new = np.concatenate(new)
        both = np.concatenate([found, new])
        both = both[np.lexsort((both[:, 2], both[:, 1], both[:, 0]))]
        first = np.ones(len(both), bool)
        first[1:] = (both[1:, :2] != both[:-1, :2]).any(1)
        return both[first]

    for p in (1, 2):
        same = np.zeros(max(n - p, 0) + 2, np.int8)
        if n > p:
            same[1:-1] = h[p:] == h[:-p]
        edge = np.flatnonzero(same[1:] != same[:-1])
        a, z = edge[0::2], edge[1::2]
        ok = z - a >= p
        found = keep(a[ok], np.full(int(ok.sum()), p), found)

    k = 0
    while 3 << k <= longest // 2:
        t = 1 << k
        low, high = 3 * t, 6 * t
        small = found[found[:, 2] * 3 <= t]
        name = names.at(k)
        # windows with a small period have no name
        flat = small[small[:, 1] - small[:, 0] >= t]
        depth = np.zeros(len(name) + 1, np.int32)
        np.add.at(depth, flat[:, 0], 1)
        np.add.at(depth, flat[:, 1] - t + 1, -1)
        none = np.uint64(0xFFFFFFFFFFFFFFFF)
        ids = np.where(np.cumsum(depth[:-1]) > 0, none, name)
        context = names.at(k + 1)
        if len(ids) > t and len(context):
            least = _least(ids, t + 1)[:len(context)]
            at = np.flatnonzero((least != none) & ((ids[:len(least)] == least) | (ids[t:t + len(least)] == least)))
            order = np.argsort(context[at], kind="stable")
            at, c = at[order], context[at][order]
            # equal contexts whose neighbours in the list are near enough
            pairs = []
            live = np.arange(max(len(at) - 1, 0))
            for j in range(1, _NEXT + 1):
                live = live[live + j < len(at)]
                live = live[(c[live] == c[live + j]) & (at[live + j] - at[live] < high) & (doc[at[live]] == doc[at[live + j]])]
                if not len(live):
                    break
                gap = at[live + j] - at[live]
                ok = gap >= low
                pairs.append(np.stack([at[live][ok], gap[ok]], 1))
            if pairs:
                pairs = np.concatenate(pairs)
                found = keep(pairs[:, 0], pairs[:, 1], found)
        regions = small[small[:, 1] - small[:, 0] >= 3 * t - 1]
        if len(regions):
            ends = np.unique(regions[:, 1])
            for j in range(1, 5):
                a, gap = ends[:-j], ends[j:] - ends[:-j]
                ok = (gap >= low) & (gap < high)
                found = keep(a[ok], gap[ok], found)
            found = keep(*_in_phase(names, regions, low, high), found)
        k += 1
    return found


def _in_phase(names, regions, low: int, high: int):
    """Proposals (position, distance) from touching regions of one period."""
    import numpy as np

    r = regions[np.lexsort((regions[:, 0], regions[:, 2]))]
    ok = (r[1:, 2] == r[:-1, 2]) & (r[1:, 0] <= r[:-1, 1]) & (r[1:, 0] > r[:-1, 0])
    one, two = r[:-1][ok], r[1:][ok]
    if not len(one):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    d = one[:, 2]
    own, turn = _repeat_ranges(d)
    a = one[own, 1] - d[own] - turn
    fits = names.common(a, two[own, 0]) >= d[own]
    own, a = own[fits], a[fits]
    rest = (two[own, 0] - a) % d[own]
    most = np.minimum(np.minimum(one[own, 1] - one[own, 0], two[own, 1] - two[own, 0]), high - 1)
    first = low + (rest - low) % d[own]
    who, step = _repeat_ranges(np.maximum((most - first) // d[own] + 1, 0))
    p = first[who] + step * d[own][who]
    # a word of the first region whose partner lies in the second one
    return np.maximum(one[own[who], 0], two[own[who], 0] - p), p


def runs_of(texts: list, shortest: int = 12):
    """Per text of a list of UTF-8 texts: (number of words, array of its runs
    (start, length, period) by start and period)."""
    import numpy as np

    h, _, _, counts = hash_words(texts)
    n_docs = len(counts)
    # a word of its own before every document
    size = len(h) + n_docs
    heads = np.cumsum(counts + 1) - (counts + 1)
    seq = np.empty(size, np.uint64)
    is_head = np.zeros(size, bool)
    is_head[heads] = True
    seq[~is_head] = h
    seq[heads] = mixed(np.arange(1, n_docs + 1).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    doc = np.cumsum(is_head) - 1
    found = find_runs(seq, doc, int(counts.max(initial=0)))
    found = found[found[:, 1] - found[:, 0] >= np.maximum(shortest, 2 * found[:, 2])]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    own = doc[found[:, 0]]
    out = np.stack([found[:, 0] - heads[own] - 1, found[:, 1] - found[:, 0], found[:, 2]], 1)
    return counts, np.split(out, np.searchsorted(own, np.arange(1, n_docs)))


def collapse(text: bytes, runs) -> bytes:
    """The words of a text without the repeats: of every run only its first
    period stays (unless another run covers that); joined by one space."""
    import numpy as np

    words = text.split()
    if len(runs):
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0).tolist()]
    return b" ".join(words)


RESULTS = ("n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_text string")


def periodic_runs(docs: DataFrame, text_col: str = "text", shortest: int = 12) -> DataFrame:
    """Each row with the runs of its text: n_words, n_runs, the longest run
    (start, length, period, exponent_milli = 1000 * length / period; ties:
    smallest start, then period; null without runs), runs_sha256 of all
    (``start,length,period`` and a line break each, by start, then period) and
    collapsed_text."""
    import pyarrow as pa

    names = [x.split(" ")[0] for x in RESULTS.split(", ")]
    others = [c for c in docs.columns if c != text_col and c not in names]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others] + [RESULTS])
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text_col}`").alias("__text"))

    def judge(batches):
        import numpy as np

        np.seterr(over="ignore")
        for b in batches:
            texts = bytes_of(b.column(len(others)))
            done = 0
            for part in in_parts(texts):
                part = [t or b"" for t in part]
                counts, runs = runs_of(part, shortest)
                out = {c: [] for c in names}
                for text, n, r in zip(part, counts.tolist(), runs):
                    out["n_words"].append(n)
                    out["n_runs"].append(len(r))
                    best = min(r.tolist(), key=lambda x: (-x[1], x[0], x[2])) if len(r) else [None] * 3
                    out["start"].append(best[0])
                    out["length"].append(best[1])
                    out["period"].append(best[2])
                    out["exponent_milli"].append(1000 * best[1] // best[2] if len(r) else None)
                    lines = "".join(f"{s},{l},{p}\n" for s, l, p in r.tolist())
                    out["runs_sha256"].append(hashlib.sha256(lines.encode()).hexdigest())
                    out["collapsed_text"].append(collapse(text, r))
                cols = [pa.array(out[c], pa.int64()) for c in names[:6]]
                cols += [pa.array(out["runs_sha256"], pa.string()), pa.array(out["collapsed_text"], pa.binary()).cast(pa.string())]
                kept = [b.column(i).slice(done, len(part)) for i in range(len(others))]
                done += len(part)
                yield pa.RecordBatch.from_arrays([*kept, *cols], [*others, *names])

    return rows.mapInArrow(judge, schema)


ship(__name__)
