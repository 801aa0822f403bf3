"""Token counts of flat, unindexed token files by a separator scan.

A flat token file holds nothing but ids (little-endian u16 or u32), each
document ended by the separator id; there is no index.  The files are listed
with their sizes, cut into blocks of ``BLOCK`` ids, and every block is searched
for separators with one vectorised comparison.  Documents cross block borders:
a prefix scan over the blocks of a file (the last separator before the block,
the number of separators before it) stitches them.

Scale: blocks are independent tasks of bounded size, whatever the files'
sizes; the scan runs over one row per block.  Nothing else is shuffled.

Defined cases: a null or empty text is a document of no ids; ids after the
last separator of a file form an unfinished document (``complete`` false);
an empty folder gives no row; bytes that do not make up a whole id raise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankflow.llm.bpe import default_path, encoder, id_type
from rankflow.llm.common import attempt_name, file_system, in_parts, ship, shuffle_partitions, written
from rankflow.session import scratch_path

BLOCK = 4 << 20
SEPARATOR = 50_256


def write_flat(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None,
               separator: int = SEPARATOR) -> tuple[DataFrame, str]:
    """Write the texts as flat token files in the order in which they are
    read, one file per task; returns (list of files: path, n_docs) and the id
    type.  No shuffle."""
    folder = scratch_path(docs.sparkSession, "flat")
    path = tokenizer or default_path()
    dtype = id_type(path)

    def write(batches):
        import numpy as np
        import pyarrow as pa

        encode = encoder(path, dtype)
        end = np.array([separator], dtype).tobytes()
        out = name = None
        n = 0
        for b in batches:
            for texts in in_parts(b.column(0).to_pylist()):
                if out is None:
                    fs, top = file_system(folder)
                    fs.create_dir(top, recursive=True)
                    name = attempt_name(".ids")
                    out = fs.open_output_stream(f"{top}/{name}", compression=None)
                out.write(end.join(encode(texts)) + end)
                n += len(texts)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "n_docs": n}])

    files = written(docs.select(F.col(text_col).alias("text")).mapInArrow(write, "path string, n_docs long"), "flat-files")
    return files, dtype


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the files of a folder, without their content."""
    return spark.read.format("binaryFile").load(folder).select("path", "length")


def with_length(files: DataFrame) -> DataFrame:
    """(path, length) of listed files (column ``path``), asked by tasks."""

    def ask(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for path in b.column("path").to_pylist():
                fs, p = file_system(path)
                rows.append((path, fs.get_file_info(p).size))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in ((0, pa.string()), (1, pa.int64()))],
                                             ["path", "length"])

    return files.select("path").mapInArrow(ask, "path string, length long")


def count_tokens(files: DataFrame, dtype: str = "<u2", separator: int = SEPARATOR, block: int = BLOCK) -> DataFrame:
    """One row per document of the flat files (path, length): path, doc_no
    (place in its file), start (its first id's place in the file), n_tokens
    (without the separator), complete."""
    width = int(dtype[-1])
    spark = files.sparkSession
    n = shuffle_partitions(files)
    blocks = (files.withColumn("n_ids", (F.col("length") / F.lit(width)).cast("long"))
              .withColumn("whole", F.assert_true(F.col("length") % width == 0, "a file ends within an id"))
              .where("whole is null")
              .select("path", "n_ids", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(
                  F.floor((F.col("n_ids") - 1) / F.lit(block)), F.lit(0)))).alias("block"))
              .repartition(n, "path", "block"))

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for path, n_ids, k in zip(*(c.to_pylist() for c in b.columns)):
                fs, p = file_system(path)
                first = k * block
                with fs.open_input_file(p) as f:
                    ids = np.frombuffer(f.read_at(min(block, n_ids - first) * width, first * width), dtype)
                at = np.flatnonzero(ids == separator) + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([n_ids], pa.int64()), pa.array([k], pa.int64()),
                     pa.array([len(at)], pa.int64()), pa.array([at[-1] if len(at) else None], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), pa.array(at, pa.int64()))],
                    ["path", "n_ids", "block", "n_found", "last_found", "found"])

    found = written(blocks.mapInArrow(
        scan, "path string, n_ids long, block long, n_found long, last_found long, found array<long>"), "separators")
    # the scan sees one small row per block; the places join it afterwards
    w = Window.partitionBy("path").orderBy("block")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    last = F.row_number().over(Window.partitionBy("path").orderBy(F.col("block").desc())) == 1
    carry = found.select(
        F.col("path").alias("c_path"), F.col("block").alias("c_block"),
        F.coalesce(F.max("last_found").over(before), F.lit(-1)).alias("carry"),
        F.coalesce(F.sum("n_found").over(before), F.lit(0)).cast("long").alias("n_before"),
        F.when(last, F.col("n_ids")).alias("file_end"))
    stitched = found.join(carry, (F.col("path") == F.col("c_path")) & (F.col("block") == F.col("c_block")))
    # a file's last block also closes what no separator ends
    ends = F.when(F.col("file_end").isNotNull() & (F.coalesce(F.col("last_found"), F.col("carry")) < F.col("file_end") - 1),
                  F.concat("found", F.array("file_end"))).otherwise(F.col("found"))
    rows = stitched.withColumn("ends", ends).select("path", "n_before", "carry", "file_end", "ends", F.posexplode("ends").alias("k", "end"))
    start = F.when(F.col("k") > 0, F.element_at("ends", F.greatest(F.col("k"), F.lit(1)))).otherwise(F.col("carry")) + 1
    return rows.select("path", (F.col("n_before") + F.col("k")).alias("doc_no"), start.alias("start"),
                       (F.col("end") - start).alias("n_tokens"),
                       (F.col("file_end").isNull() | (F.col("end") < F.col("file_end"))).alias("complete"))


ship(__name__)
