"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items become sequences of word numbers; a generalised
suffix automaton over all of them recognises every stretch of consecutive
item words.  Training texts stream through it: at each word the automaton
holds the longest stretch of item words that ends there, and where it is long
enough the words it covers are *hit*.  A document's spans of hit words can
then be cut, or the document dropped when too much of it is hit.

Words: A-Z are lower-cased, and a word is a run of letters, digits or any
characters beyond ASCII.  A window is ``window`` consecutive words of an item;
an item with fewer words, but at least one, is a single window.

Scale: the automata are built by tasks, one for each block of at most
``BLOCK_WORDS`` item words (in expectation), and written to the shared folder;
a task holds one automaton at a time, so the benchmark's size is not bounded
by memory.  Documents are only scanned: no shuffle, no join, no skew.  Before
the automaton runs, a vectorised test keeps only stretches in which every
neighbouring word pair occurs in some item, which is a necessary condition.

Defined cases: a null text has no words and is never hit; an empty benchmark
hits nothing; repeated items and repeated documents are handled row by row;
null item ids are ignored in the list of items but their windows count as
hits; extra columns pass through or are ignored.
"""

from __future__ import annotations

import hashlib
import pickle

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import (attempt_name, bytes_of, file_system, in_parts, ship, task_cache, written)
from rankflow.session import scratch_path

BLOCK_WORDS = 200_000
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
               else 32 for c in range(256))
# slots of the table of neighbouring item words: a power of two, so many for each word
_PAIR_ROOM = 16
_PAIR_BITS = 10


def words_of(text: bytes) -> list:
    """Lower-cased words of UTF-8 bytes."""
    return text.translate(_TABLE).split()


class Automaton:
    """Generalised suffix automaton over word numbers.

    ``go[s]`` maps a word number to the next state, ``link[s]`` is the suffix
    link, ``size[s]`` the longest stretch of the state.  ``items[s]`` are the
    items with an occurrence of the state's stretches (only for states that
    hold a full window), ``whole[s]`` the (length, item) of short items.
    """

    def __init__(self, window: int):
        self.window = window
        self.words: dict = {}
        self.go, self.link, self.size = [{}], [-1], [0]
        self.shortest = window
        self.items: dict = {}
        self.whole: dict = {}

    def _extend(self, last: int, c: int) -> int:
        go, link, size = self.go, self.link, self.size
        nxt = go[last].get(c)
        if nxt is not None:
            if size[nxt] == size[last] + 1:
                return nxt
            return self._split(last, nxt, c)
        cur = len(size)
        go.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p != -1:
            q = go[p][c]
            link[cur] = q if size[q] == size[p] + 1 else self._split(p, q, c)
        return cur

    def _split(self, p: int, q: int, c: int) -> int:
        go, link, size = self.go, self.link, self.size
        copy = len(size)
        go.append(dict(go[q]))
        size.append(size[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p != -1 and go[p].get(c) == q:
            go[p][c] = copy
            p = link[p]
        return copy

    def fit(self, items: list) -> "Automaton":
        """``items``: (id, list of words); call once."""
        number = self.words
        coded = []
        for item, words in items:
            if words:
                coded.append((item, [number.setdefault(w, len(number)) for w in words]))
                self.shortest = min(self.shortest, len(words))
        for _, seq in coded:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        for item, seq in coded:
            state = 0
            for k, c in enumerate(seq, 1):
                state = self.go[state][c]
                if k >= self.window:
                    s = state
                    while self.size[self.link[s]] >= self.window:
                        s = self.link[s]
                    self.items.setdefault(s, set()).add(item)
            if len(seq) < self.window:
                self.whole.setdefault(state, set()).add((len(seq), item))
        # the nearest state at or above each one (by links) that ends a short item
        self.above = [-1] * len(self.size)
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            up = self.link[s]
            self.above[s] = s if s in self.whole else (self.above[up] if up > 0 else -1)
        self._pairs(coded)
        return self

    def _pairs(self, coded: list) -> None:
        import numpy as np

        self.pair_bits = max(_PAIR_BITS, (_PAIR_ROOM * sum(map(len, (seq for _, seq in coded)))).bit_length())
        self.pairs = np.zeros(1 << self.pair_bits, bool)
        for _, seq in coded:
            a = np.array(seq, np.uint64)
            self.pairs[self._pair(a[:-1], a[1:])] = True

    def _pair(self, a, b):
        import numpy as np

        return ((a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F))
                >> np.uint64(64 - self.pair_bits)).astype(np.int64)

    def runs(self, words: list):
        """(first, end) of stretches that may hold a window."""
        import numpy as np
        from itertools import repeat

        ids = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        known = ids >= 0
        if self.shortest > 1:
            u = ids.astype(np.uint64)
            joined = known[:-1] & known[1:]
            at = np.flatnonzero(joined)
            joined[at] = self.pairs[self._pair(u[at], u[at + 1])]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], joined.view(np.int8), [0]))))
            first, end = edge[::2], edge[1::2] + 1
        else:
            edge = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
            first, end = edge[::2], edge[1::2]
        keep = end - first >= self.shortest
        return ids, first[keep].tolist(), end[keep].tolist()

    def scan(self, words: list):
        """([(first, end)] of hit words, set of items) of one document."""
        spans, found = [], set()
        if len(words) < self.shortest or not self.words:
            return spans, found
        ids, firsts, ends = self.runs(words)
        go, link, size, window = self.go, self.link, self.size, self.window
        for first, end in zip(firsts, ends):
            state = length = 0
            for i, c in enumerate(ids[first:end].tolist(), first):
                while state and c not in go[state]:
                    state = link[state]
                    length = size[state]
                state = go[state].get(c, 0)
                if not state:
                    length = 0
                    continue
                length += 1
                reach = 0
                if length >= window:
                    w = state
                    while size[link[w]] >= window:
                        w = link[w]
                    found |= self.items.get(w, ())
                    reach = window
                s = self.above[state]
                while s > 0:
                    for k, item in self.whole[s]:
                        if k <= length:
                            found.add(item)
                            reach = max(reach, k)
                    up = link[s]
                    s = self.above[up] if up > 0 else -1
                if reach:
                    begin = i + 1 - reach
                    if spans and begin <= spans[-1][1]:
                        while spans and begin <= spans[-1][1]:
                            begin = min(begin, spans.pop()[0])
                    spans.append((begin, i + 1))
        return spans, found


def build_automata(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                   window: int = 10, block_words: int = BLOCK_WORDS) -> list:
    """Build the automata in tasks and write them to the shared folder;
    returns the file names (one for each block of item words).

    Only the number of words is brought to the driver.  Items are dealt to
    blocks by a hash of their text, so equal items share a block.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.col(text_col).cast("binary").alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(total // (6 * block_words)) + 1
    folder = scratch_path(spark, "automata")

    def build(batches):
        rows = []
        for b in batches:
            rows += [(i, words_of(t)) for i, t in zip(b.column("item").to_pylist(), b.column("text").to_pylist())
                     if t is not None]
        rows = [r for r in rows if r[1]]
        if rows:
            import pyarrow as pa

            fs, base = file_system(folder)
            fs.create_dir(base, recursive=True)
            name = attempt_name(".sam")
            with fs.open_output_stream(f"{base}/{name}") as out:
                out.write(pickle.dumps(Automaton(window).fit(rows).__dict__, protocol=5))
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], ["path"])

    dealt = items.repartition(blocks, F.xxhash64("text")) if blocks > 1 else items.repartition(1)
    made = dealt.mapInArrow(build, "path string")
    return [r.path for r in written(made, "automata-names").orderBy("path").collect()]


def load(path: str, window: int) -> Automaton:
    """An automaton of :func:`build_automata`; the last one loaded is kept."""
    cache = task_cache()
    if cache.get("sam", (None, None))[0] != path:
        cache.pop("sam", None)
        fs, p = file_system(path)
        with fs.open_input_stream(p) as f:
            a = Automaton(window)
            a.__dict__.update(pickle.loads(f.read()))
        cache["sam"] = (path, a)
    return cache["sam"][1]


def scan_texts(texts: list, paths: list, window: int) -> list:
    """(number of words, merged hit spans, items) for each text; the words of
    about two megabytes of text are held at a time."""
    return [x for part in in_parts(texts) for x in _scan_part(part, paths, window)]


def _scan_part(texts: list, paths: list, window: int) -> list:
    words = [words_of(t) if t else [] for t in texts]
    spans, found = [[] for _ in texts], [set() for _ in texts]
    for path in paths:
        a = load(path, window)
        for k, w in enumerate(words):
            s, f = a.scan(w)
            if f or s:
                spans[k] += s
                found[k] |= f
    return [(len(w), _merged(s) if len(paths) > 1 else s, f) for w, s, f in zip(words, spans, found)]


def _merged(spans: list) -> list:
    out = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256
    (of the comma-joined ids of the items with occurring windows, sorted as
    strings), contaminated, longest_span (words)."""
    paths = build_automata(benchmark, item_col, "text", window, block_words)
    schema = docs.select(F.col(id_col).alias("doc_id")).schema.simpleString()[7:-1] + (
        ", n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_span long")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = scan_texts(bytes_of(b.column(1)), paths, window)
            hit = [sum(e - s for s, e in x[1]) for x in got]
            ids = [sorted(i for i in x[2] if i is not None) for x in got]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in got], pa.int64()), pa.array(hit, pa.int64()),
                 pa.array([len(i) for i in ids], pa.int64()),
                 pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in ids], pa.string()),
                 pa.array([h > 0 for h in hit], pa.bool_()),
                 pa.array([max((e - s for s, e in x[1]), default=0) for x in got], pa.int64())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_span"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)


def cut_spans(text: bytes, spans: list) -> bytes:
    """``text`` without the words of ``spans`` (word positions) and what
    stands between them; a line break takes their place."""
    flat = text.translate(_TABLE)
    starts, at = [], 0
    for w in flat.split():
        at = flat.index(w, at)
        starts.append((at, at + len(w)))
        at += len(w)
    out, last = [], 0
    for b, e in spans:
        out.append(text[last:starts[b][0]].rstrip(b" "))
        last = starts[e - 1][1]
    out.append(text[last:].lstrip(b" "))
    return b"\n".join(out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", chars_col: str | None = None,
                  item_col: str = "item_id", window: int = 10, max_coverage: float = 0.5,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without benchmark passages: documents with more than
    ``max_coverage`` of their words hit go, in the others the hit spans are
    cut (again, until no window is left, as a cut joins what stood around it);
    a document of which no word is left goes as well.  ``chars_col``, if
    given, is set to the new number of characters where a text changed.
    Other columns and untouched rows stay as they are."""
    paths = build_automata(benchmark, item_col, "text", window, block_words)
    names = docs.columns
    at_text = names.index(text_col)
    at_chars = names.index(chars_col) if chars_col else None

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = bytes_of(b.column(at_text))
            todo, drop, changed = list(range(len(texts))), set(), {}
            first = True
            while todo:
                nxt = []
                for k, (n, spans, _) in zip(todo, scan_texts([changed.get(k, texts[k]) for k in todo], paths, window)):
                    if first and spans and sum(e - s for s, e in spans) > max_coverage * n:
                        drop.add(k)
                    elif spans:
                        changed[k] = cut_spans(changed.get(k, texts[k]), spans)
                        if words_of(changed[k]):
                            nxt.append(k)
                        else:
                            drop.add(k)
                todo, first = nxt, False
            if not changed and not drop:
                yield b
                continue
            arrays = list(b.columns)
            new = [changed.get(k, t) for k, t in enumerate(texts)]
            arrays[at_text] = pa.array(new, pa.binary()).cast(b.column(at_text).type)
            if at_chars is not None:
                old = b.column(at_chars).to_pylist()
                arrays[at_chars] = pa.array([len(changed[k].decode()) if k in changed else c for k, c in enumerate(old)],
                                            b.column(at_chars).type)
            out = pa.RecordBatch.from_arrays(arrays, schema=b.schema)
            yield out.filter(pa.array([k not in drop for k in range(len(texts))])) if drop else out

    return docs.mapInArrow(run, docs.schema)


ship(__name__)
