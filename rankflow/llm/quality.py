"""Quality rules: plain counts and zstandard compression bands.

A text that repeats itself compresses far better than prose, and random or
encoded data compresses hardly at all.  The whole text and each of its fixed
chunks are compressed; the text is rejected when the ratio (bytes before /
after) of the whole lies outside the band for its length, or when more than
``CHUNK_SHARE`` of its chunks lie outside theirs.  Longer texts compress
better for the same prose, so the limits rise with length and are fitted to
labelled good texts band by band (:func:`fit_bands`); very short texts are
judged by the counts only.  A last part of less than half a chunk is judged
with the chunk before it.

Everything is computed from one row, in Arrow batches: no shuffle and no skew.

Defined cases: a null text has no words, so it fails the word minimum; an
empty text likewise; a very long text is compressed whole, in one task, as one
row; repeated rows are judged one by one; an empty table gives an empty
result; other columns may hold nulls and are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import bytes_of, hash_words, in_parts, ship

LEVEL = 3
CHUNK = 4096
CHUNK_SHARE = 0.25
# upper ends of the length bands in bytes; the last band is open
EDGES = (256, 384, 512, 768, 1024, 1536, 2048, 3072, 4096, 6144, 8192, 12288, 16384, 32768, 65536, 131072, float("inf"))
# below 1 KB repetitive and plain texts compress alike, so only extreme ratios are rejected there; noise
# (1.0 to 1.4) lies far below prose, so the least ratio can lie far out
SHORT = 1024
SHORT_SPREAD = 8.0
SPREAD = 5.0
LOW_SPREAD = 10.0
MIN_TEXTS = 15
# (bytes below which the band holds, least ratio, largest ratio): what fit_bands gives for the documents and
# labels of sf0.1
BANDS = (
    (256, 0.0, float("inf")),
    (384, 1.07, 2.03),
    (512, 0.97, 2.23),
    (768, 1.11, 2.27),
    (1024, 1.33, 2.3),
    (1536, 1.4, 2.18),
    (2048, 1.59, 2.2),
    (3072, 1.69, 2.25),
    (4096, 1.84, 2.27),
    (6144, 1.88, 2.34),
    (8192, 1.89, 2.42),
    (12288, 1.94, 2.44),
    (16384, 1.88, 2.55),
    (32768, 2.0, 2.6),
    (65536, 2.0, 2.73),
    (131072, 2.0, 2.85),
    (float("inf"), 2.0, 3.02),
)
# not fitted: chunks of good texts in sf0.1 1.92 to 2.29, of long plain word lists up to 2.63
CHUNK_BAND = (1.75, 2.65)
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOLS = b"#*$%&|<>"

_FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, ratio double, n_chunks long, n_bad_chunks long, kept boolean")


def repeat_words(h) -> int:
    """Words in 3-word windows that occur at least twice in the text, from
    the hashes of its words."""
    import numpy as np

    n = len(h)
    if n < 4:
        return 0
    tri = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
    order = np.argsort(tri, kind="stable")
    s = tri[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    hit[:-2] |= twice
    hit[1:-1] |= twice
    hit[2:] |= twice
    return int(hit.sum())


def in_band(size: int, ratio: float, bands=BANDS) -> bool:
    for below, least, most in bands:
        if size < below:
            return least <= ratio <= most
    return True


def assess(text: bytes | None, hashes, pack, bands=BANDS, chunk: int = CHUNK, chunk_band=CHUNK_BAND,
           chunk_share: float = CHUNK_SHARE, min_words: int = MIN_WORDS,
           max_repeat_pct: int = MAX_REPEAT_PCT) -> tuple:
    """The counts and the verdict on one text, given the hashes of its words;
    ``pack`` compresses bytes."""
    text = text or b""
    n = len(hashes)
    chars = len(text.translate(None, _SPACE).decode())
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats = repeat_words(hashes)
    failed = n < min_words or 100 * repeats > max_repeat_pct * n
    ratio = len(text) / len(pack(text)) if text else 0.0
    # a last part of less than half a chunk says little by itself: it is judged with the chunk before
    rest = len(text) % chunk
    starts = range(0, len(text) - (rest if 2 * rest < chunk else 0), chunk)
    parts = [text[k:k + chunk] if k != starts[-1] else text[k:] for k in starts]
    bad = sum(not chunk_band[0] <= len(p) / len(pack(p)) <= chunk_band[1] for p in parts)
    kept = not failed and in_band(len(text), ratio, bands) and bad <= chunk_share * len(parts)
    return (n, chars, symbols, len(lines) - len(set(lines)), repeats, failed, ratio, len(parts), bad, kept)


def assess_all(texts: list, level: int = LEVEL, **rules) -> list:
    """:func:`assess` of each text of a batch."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=level).compress
    out = []
    for part in in_parts(texts):
        h, _, _, counts = hash_words(part)
        at = 0
        for t, n in zip(part, counts.tolist()):
            out.append(assess(t, h[at:at + n], pack, **rules))
            at += n
    return out


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: int = LEVEL, **rules) -> DataFrame:
    """One row per document: the id, the counts and ``kept``.  ``rules`` are
    the keyword arguments of :func:`assess`."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    schema = base.select("doc_id").schema.simpleString()[7:-1] + ", " + _FIELDS

    def run(batches):
        import pyarrow as pa

        names = ["doc_id"] + [f.split()[0] for f in _FIELDS.split(", ")]
        kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        types = [kinds[f.split()[1]] for f in _FIELDS.split(", ")]
        for b in batches:
            rows = assess_all(bytes_of(b.column(1)), level, **rules)
            cols = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(c, t) for c, t in zip(cols, types)], names)

    return base.mapInArrow(run, schema)


def quality_filter(docs: DataFrame, text_col: str = "text", level: int = LEVEL, **rules) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            yield b.filter(pa.array([x[-1] for x in assess_all(bytes_of(b.column(at)), level, **rules)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def fit_bands(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", edges=EDGES, level: int = LEVEL, spread: float = SPREAD,
              low_spread: float = LOW_SPREAD, short: int = SHORT, short_spread: float = SHORT_SPREAD,
              min_texts: int = MIN_TEXTS) -> tuple:
    """Limits for ``bands`` from texts labelled good (1) that pass the counts:
    in each length band the mean ratio less ``low_spread`` and plus ``spread``
    standard deviations (``short_spread`` each way in bands up to ``short``
    bytes).  The first band is open.  A band with fewer than ``min_texts``
    texts keeps the least ratio of the band before it, and its largest one
    rises with the doublings of length as between the last two bands that
    were measured; without two such bands before it, it is open.

    Every labelled text counts; sums are made in Spark and one row per band
    reaches the driver.  An id that is labelled twice counts once, a null id
    or label not at all."""
    import math

    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("good_id")).distinct()
    text = F.col(text_col).cast("binary")
    sized = docs.join(good, F.col(id_col) == F.col("good_id"), "left_semi").select(
        F.octet_length(text).alias("size"), text.alias("text"))
    band = sum((F.col("doc_id") >= e).cast("int") for e in edges[:-1])
    found = (quality(sized, "size", "text", level).where("not base_failed").groupBy(band.alias("band"))
             .agg(F.count("ratio").alias("n"), F.avg("ratio").alias("mean"), F.stddev("ratio").alias("sd"),
                  F.avg(F.log2("doc_id")).alias("at")).where(F.col("n") >= max(2, min_texts)).collect())
    held = {r.band: r for r in found}
    out, measured = [], []
    for k, below in enumerate(edges):
        least, most = 0.0, math.inf
        if k and k in held:
            r = held[k]
            measured.append(r)
            up, low = (short_spread, short_spread) if below <= short else (spread, low_spread)
            least, most = r.mean - low * r.sd, r.mean + up * r.sd
        elif len(measured) > 1:
            a, z = measured[-2:]
            # the middle of the band, or of the octave pair above the last edge
            at = math.log2(edges[k - 1]) + 1 if below == math.inf else (math.log2(edges[k - 1]) + math.log2(below)) / 2
            least = out[-1][1]
            most = z.mean + max(0.0, (z.mean - a.mean) / (z.at - a.at)) * (at - z.at) + spread * z.sd
        out.append((below, round(max(0.0, least), 2), round(most, 2)))
    return tuple(out)


ship(__name__)
