"""Token files compressed by Re-Pair grammars, with random access.

Documents are dealt to tasks by ranges of their id, encoded, and written in
ascending id order.  A file is a sequence of shards of about ``SHARD`` ids
(whole documents).  Within a shard frequent neighbouring ids are repeatedly
replaced by new symbols: each round counts all pairs, names the frequent ones
and replaces their occurrences, left to right, without overlap, until no pair
occurs ``MIN_COUNT`` times.  A round leaves no occurrence of the pairs that it
names, so the next one only counts pairs with a symbol named last.  Stored are
the rules, the length to which each rule expands, the remaining sequence and
the start of each document.  Since every symbol's expansion length is known,
any range of ids is found by a search in the running sum of lengths and only
the symbols it touches are expanded.

Shard layout (little endian): magic ``RPT1``, five u64 (documents, ids, first
new symbol, rules, sequence length), then per document its id (i64), a flag
for a null id (u8) and its number of ids (u32); per rule left, right and
expansion length (u32); the sequence (u16 if all its symbols fit, else u32,
announced by a u8).

Scale: one shuffle, on ranges of (id, hash of the text); a task streams its
range and holds one shard.  Global starts come from a running sum over shard
totals within a task and over task totals, one row per task.

Defined cases: a null or empty text consists of the end id alone; null ids
come first; equal ids are ordered by a hash of the text; an empty table gives
no file and no row.
"""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.bpe import PIECES, default_path, encoder
from rankflow.llm.common import attempt_name, file_system, in_parts, ship, shuffle_partitions, written
from rankflow.session import scratch_path

SHARD = 1 << 20
MIN_COUNT = 32
_MAGIC = b"RPT1"
_HASH_BITS = 20


def _mixed_pairs(a, b):
    import numpy as np

    code = (a.astype(np.uint64) << np.uint64(32)) | b
    return code, ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _HASH_BITS)).astype(np.int64)


def compress(ids, base: int, min_count: int = MIN_COUNT):
    """(rules as two arrays, expansion lengths, sequence) of uint32 ids; the
    first new symbol is ``base``."""
    import numpy as np

    seq = np.ascontiguousarray(ids, np.uint32)
    left, right, length = [], [], np.zeros(0, np.uint32)
    made, near = 0, np.arange(max(len(seq) - 1, 0))
    while len(near) >= min_count:
        code, slot = _mixed_pairs(seq[near], seq[near + 1])
        # a coarse count rules out most pairs
        at = np.flatnonzero(np.bincount(slot, minlength=1 << _HASH_BITS)[slot] >= min_count)
        code, slot, at = code[at], slot[at], near[at]
        # one pair of each slot is counted there; those that share its slot by their codes
        holder = np.zeros(1 << _HASH_BITS, np.uint64)
        holder[slot] = code
        mine = holder[slot] == code
        held = np.bincount(slot[mine], minlength=1 << _HASH_BITS) >= min_count
        names, which, counts = np.unique(code[~mine], return_inverse=True, return_counts=True)
        chosen = mine & held[slot]
        chosen[np.flatnonzero(~mine)[counts[which] >= min_count]] = True
        if not chosen.any():
            break
        # a number for each chosen pair: its slot, or one beyond all slots
        name = slot.copy()
        name[~mine] = (1 << _HASH_BITS) + which
        code_of = np.concatenate([holder, names])
        at, which = at[chosen], name[chosen]
        # neighbours overlap: in a stretch of touching matches take every other one
        start = np.ones(len(at), bool)
        start[1:] = at[1:] != at[:-1] + 1
        first = np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
        even = (np.arange(len(at)) - first) % 2 == 0
        at, which = at[even], which[even]
        present = np.zeros(len(code_of), bool)
        present[which] = True
        used = np.flatnonzero(present)
        number = np.empty(len(code_of), np.uint32)
        number[used] = np.arange(len(used))
        symbol = number[which]
        a = (code_of[used] >> np.uint64(32)).astype(np.uint32)
        b = (code_of[used] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        size = lambda x: np.where(x < base, 1, length[np.maximum(x.astype(np.int64) - base, 0)] if made else 1)
        grown = (size(a) + size(b)).astype(np.uint32)
        left.append(a)
        right.append(b)
        seq = seq.copy()
        seq[at] = (base + made + symbol).astype(np.uint32)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        new = at - np.arange(len(at))  # places of the new symbols
        near = np.stack([new - 1, new], 1).ravel()   # in ascending order; the same place twice in a row at most
        near = near[(near >= 0) & (near < len(seq) - 1)]
        near = near[np.append(True, near[1:] != near[:-1])] if len(near) else near
        length = np.concatenate([length, grown])
        made += len(used)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.uint32)
    return join(left), join(right), length, seq


class Shard:
    """A shard read back: whole or any range of its ids."""

    def __init__(self, data: bytes):
        import numpy as np

        if data[:4] != _MAGIC:
            raise ValueError("not a shard")
        docs, self.total, self.base, rules, n = struct.unpack_from("<5Q", data, 4)
        at = 44

        def take(kind, count):
            nonlocal at
            x = np.frombuffer(data, kind, count, at)
            at += x.nbytes
            return x

        self.doc_ids, self.null_id, self.counts = take("<i8", docs), take("u1", docs), take("<u4", docs)
        self.left, self.right, self.length = take("<u4", rules), take("<u4", rules), take("<u4", rules)
        wide = take("u1", 1)[0]
        self.seq = take("<u4" if wide else "<u2", n).astype(np.uint32)
        if at != len(data):
            raise ValueError("shard has another size than its header says")
        self.starts = np.concatenate([[0], np.cumsum(self.counts, dtype=np.int64)])
        size = np.ones(n, np.int64)
        rule = self.seq >= self.base
        size[rule] = self.length[self.seq[rule] - self.base]
        self.ends, self.size, self.grown = np.cumsum(size), size, None

    def expand(self, symbols):
        """The ids that an array of symbols stands for."""
        import numpy as np

        while True:
            rule = symbols >= self.base
            if not rule.any():
                return symbols
            width = np.where(rule, 2, 1)
            to = np.cumsum(width) - width
            out = np.empty(int(width.sum()), np.uint32)
            out[to] = symbols
            k = symbols[rule] - self.base
            out[to[rule]] = self.left[k]
            out[to[rule] + 1] = self.right[k]
            symbols = out

    def ids(self, first: int = 0, end: int | None = None):
        """Ids ``first`` to ``end`` of the shard; expands only what they touch."""
        import numpy as np

        end = self.total if end is None else min(end, self.total)
        if first >= end:
            return np.zeros(0, np.uint32)
        a = int(np.searchsorted(self.ends, first, "right"))
        b = int(np.searchsorted(self.ends, end, "left")) + 1
        skip = first - (int(self.ends[a - 1]) if a else 0)
        symbols, size = self.seq[a:b], self.size[a:b]
        if self.grown is None:    # what each rule stands for, made once
            self.grown = self.expand(np.arange(self.base, self.base + len(self.left), dtype=np.uint32))
            self.grown_at = np.cumsum(self.length, dtype=np.int64) - self.length
        rule = symbols >= self.base
        at = np.arange(b - a)
        at[rule] = b - a + self.grown_at[symbols[rule] - self.base]
        to = np.cumsum(size) - size
        out = np.concatenate([symbols, self.grown])[np.repeat(at - to, size) + np.arange(int(size.sum()))]
        return out[skip:skip + end - first]

    def document(self, k: int):
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def pack(doc_ids: list, counts: list, ids, base: int, **options) -> bytes:
    """The bytes of a shard."""
    import numpy as np

    left, right, length, seq = compress(ids, base, **options)
    wide = len(seq) > 0 and int(seq.max()) >= 1 << 16
    return b"".join([
        _MAGIC, struct.pack("<5Q", len(doc_ids), len(ids), base, len(left), len(seq)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], "u1").tobytes(),
        np.array(counts, "<u4").tobytes(), left.astype("<u4").tobytes(), right.astype("<u4").tobytes(),
        length.astype("<u4").tobytes(), bytes([wide]), seq.astype("<u4" if wide else "<u2").tobytes()])


def write_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                 end_id: int = 0, base: int = 50_257, shard: int = SHARD, pieces: int = PIECES,
                 **options) -> DataFrame:
    """Write the token files to the shared folder; returns the list of their
    shards: file, part (tasks in id order), offset, length, first_id (of the
    shard within its part), n_ids, n_docs.  ``pieces`` bounds what a worker
    remembers of the encoding (:class:`rankflow.llm.bpe.Encoder`)."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    path = tokenizer or default_path()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("tie"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    ranged = rows.repartitionByRange(shuffle_partitions(docs), *order).sortWithinPartitions(*order)

    def write(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode = encoder(path, "<u4", added_as_text=False, pieces=pieces)
        end = np.array([end_id], "<u4").tobytes()
        part, fs, out, name, at, first = TaskContext.get().partitionId(), None, None, None, 0, 0
        ids, keys, counts = [], [], []
        held = 0

        def flush():
            nonlocal fs, out, name, at, first, held, ids, keys, counts
            if out is None:
                fs, top = file_system(folder)
                fs.create_dir(top, recursive=True)
                name = attempt_name(".rpt")
                out = fs.open_output_stream(f"{top}/{name}", compression=None)
            data = pack(keys, counts, np.frombuffer(b"".join(ids), "<u4"), base, **options)
            out.write(data)
            row = {"file": f"{folder}/{name}", "part": part, "offset": at, "length": len(data), "first_id": first,
                   "n_ids": held, "n_docs": len(keys)}
            at, first, held, ids, keys, counts = at + len(data), first + held, 0, [], [], []
            return pa.RecordBatch.from_pylist([row])

        for b in batches:
            doc_ids = iter(b.column("doc_id").to_pylist())
            for texts in in_parts(b.column("text").to_pylist()):
                for got in encode(texts):
                    got += end
                    keys.append(next(doc_ids))
                    ids.append(got)
                    counts.append(len(got) // 4)
                    held += counts[-1]
                    if held >= shard:
                        yield flush()
        if keys:
            yield flush()
        if out is not None:
            out.close()

    schema = "file string, part long, offset long, length long, first_id long, n_ids long, n_docs long"
    return written(ranged.mapInArrow(write, schema), "token-shards")


def _part_starts(shards: DataFrame) -> DataFrame:
    """The first id of each part: a running sum over one row per part."""
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(F.col("part").alias("s_part"),
                         F.coalesce(F.sum("part_ids").over(before), F.lit(0)).cast("long").alias("part_start"))


def read_tokens(shards: DataFrame, keep_ids: bool = True) -> DataFrame:
    """One row per document of the listed shards, read from the files:
    doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of
    its ids as little-endian u32) and, with ``keep_ids``, the ids."""
    n = shuffle_partitions(shards)
    wanted = (shards.join(_part_starts(shards), F.col("part") == F.col("s_part"))
              .select("file", "offset", "length", (F.col("part_start") + F.col("first_id")).alias("start"))
              .repartition(n, "file", "offset"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")

    def read(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for file, offset, length, start in zip(*(c.to_pylist() for c in b.columns)):
                fs, p = file_system(file)
                with fs.open_input_file(p) as f:
                    s = Shard(f.read_at(length, offset))
                ids = s.ids().astype("<u4")
                ends = s.starts.tolist()
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * a:4 * z]) for a, z in zip(ends, ends[1:])]
                cols = [pa.array(s.doc_ids, pa.int64(), mask=s.null_id.astype(bool)), pa.array(s.starts[:-1] + start, pa.int64()),
                        pa.array(s.counts.astype(np.int64)), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if keep_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(s.starts, pa.int32()), pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return wanted.mapInArrow(read, schema)


ship(__name__)
