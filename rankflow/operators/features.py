"""Model-feature operators: label codes, dictionary lookups, cyclic time,
min-max scaling, one-hot, title vocabulary and token sequences, k-fold
target encoding and train/test splits.

Fitted mappings are DataFrames (value -> code, word -> index, category ->
mean, feature -> min/max) that can be saved with
:func:`rankflow.sources.sinks.save_mapping` and joined back at scoring time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.functions.text import title_tokens
from rankflow.operators.ordering import dense_codes, with_position
from rankflow.session import materialize


# ---- label codes and lookups ----------------------------------------------

def fit_label_codes(df: DataFrame, column: str, code_col: str = "code") -> DataFrame:
    """LabelEncoder: (value, code) with codes 0..k-1 in binary string order.
    A fitted mapping is used many times (lookups, checks, saving), so it is
    computed once and checkpointed."""
    m = dense_codes(df, column, code_col)
    return materialize(m.select(F.col(column).alias("value"),
                                F.col(code_col).cast("int").alias(code_col)))


def fit_label_codes_multi(df: DataFrame, columns: list[str]) -> DataFrame:
    """Label codes of several *string* columns in one positional pass:
    (column, value, code).  The distinct (column, value) pairs are ordered
    once; a column's codes are positions minus the column's first position
    (a table with one row per column)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                         F.col(c).cast("string").alias("value")) for c in columns]))
    # equal rows of the columns are one before they are taken apart
    stacked = df.select(*columns).distinct().select(pairs.alias("e")).select("e.*").where(F.col("value").isNotNull()).distinct()
    positioned = with_position(stacked, ["column", "value"], "_pos")
    firsts = positioned.groupBy("column").agg(F.min("_pos").alias("_first"))
    return materialize(positioned.join(F.broadcast(firsts), "column").select(
        "column", "value", (F.col("_pos") - F.col("_first")).cast("int").alias("code")))


def codes_for(multi: DataFrame, column: str) -> DataFrame:
    """The (value, code) mapping of one column out of a multi-column fit."""
    return multi.where(F.col("column") == F.lit(column)).select("value", "code")


def lookup(df: DataFrame, column: str, mapping: DataFrame, out: str,
           key: str = "value", value: str = "code", default=-1) -> DataFrame:
    """``series.map(dict).fillna(default)`` as a left join.  The mapping is
    data-sized (one row per distinct value), so there is no broadcast hint:
    AQE broadcasts it when its runtime size is under the threshold."""
    m = mapping.select(F.col(key).alias("_lk_key"), F.col(value).alias("_lk_val"))
    joined = df.join(m, df[column] == m["_lk_key"], "left")
    filled = F.col("_lk_val") if default is None else F.coalesce(F.col("_lk_val"), F.lit(default))
    return joined.withColumn(out, filled).drop("_lk_key", "_lk_val")


def encode_columns(df: DataFrame, columns: list[str], suffix: str = "_code") -> tuple[DataFrame, dict]:
    """Label-encode several columns; returns the coded frame and the mappings."""
    types = {df.schema[c].dataType.simpleString() for c in columns}
    if types == {"string"}:
        # one positional pass for all columns
        multi = fit_label_codes_multi(df, columns)
        maps = {c: codes_for(multi, c) for c in columns}
    else:
        # non-string columns keep their own ordering (numeric, not textual)
        maps = {c: fit_label_codes(df, c) for c in columns}
    out = df
    for c in columns:
        out = lookup(out, c, maps[c], c + suffix)
    return out, maps


# ---- scaling -------------------------------------------------------------

def fit_minmax(df: DataFrame, columns: list[str]) -> DataFrame:
    """One-row table of per-feature minima and maxima."""
    aggs = []
    for c in columns:
        aggs += [F.min(F.col(c).cast("double")).alias(f"{c}__min"),
                 F.max(F.col(c).cast("double")).alias(f"{c}__max")]
    return materialize(df.agg(*aggs))


def apply_minmax(df: DataFrame, stats: DataFrame, columns: list[str], suffix: str = "",
                 digits: int | None = None) -> DataFrame:
    """(x - min) / (max - min); a constant feature scales to 0.  The fitted
    minima/maxima enter as one struct-valued scalar subquery over the
    one-row stats table (evaluated once, whatever the number of features)."""
    fields = [f for c in columns for f in (f"{c}__min", f"{c}__max")]
    out = df.withColumn("_mm", stats.select(F.struct(*fields)).scalar())
    for c in columns:
        lo = F.col("_mm")[f"{c}__min"]
        hi = F.col("_mm")[f"{c}__max"]
        scaled = F.coalesce(F.try_divide(F.col(c).cast("double") - lo, F.nullif(hi - lo, F.lit(0.0))),
                            F.when(F.col(c).isNotNull(), F.lit(0.0)))
        if digits is not None:
            scaled = F.round(scaled, digits)
        out = out.withColumn(c + suffix, scaled)
    return out.drop("_mm")


# ---- one-hot -------------------------------------------------------------

def one_hot(code: Column | str, size: int) -> Column:
    """Dense 0/1 vector of length ``size`` with a 1 at ``code``."""
    c = F.col(code) if isinstance(code, str) else code
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (i == c).cast("int"))


# ---- title vocabulary ----------------------------------------------------

def fit_word_index(texts: DataFrame, text_col: str) -> DataFrame:
    """Tokenizer vocabulary: (word, n, idx) with idx 1 for the most frequent
    word; ties are broken by the word itself (deterministic)."""
    words = texts.select(F.explode(title_tokens(text_col)).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    ranked = with_position(counts, [F.col("n").desc(), F.col("word")], "_pos")
    return materialize(ranked.select("word", "n", (F.col("_pos") + 1).cast("int").alias("idx")))


def first_token_index(df: DataFrame, text_col: str, vocab: DataFrame, out: str) -> DataFrame:
    """Index of a text's first *known* token, 0 when it has none.  Each
    distinct text is looked up once; texts are told apart by their value."""
    toks = (df.select(F.col(text_col).alias("_ft_text")).where(F.col(text_col).isNotNull()).distinct()
            .select("_ft_text", F.posexplode(title_tokens("_ft_text")).alias("_ft_p", "_ft_word")))
    v = vocab.select(F.col("word").alias("_ft_word"), F.col("idx").alias("_ft_idx"))
    first = toks.join(v, "_ft_word").groupBy("_ft_text").agg(F.min(F.struct("_ft_p", "_ft_idx")).alias("_ft_first"))
    # stored, its size is known before the join: few texts are sent to the rows, not the rows dealt by text
    first = materialize(first)
    joined = df.join(first, F.col(text_col) == F.col("_ft_text"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_ft_first._ft_idx"), F.lit(0))).drop("_ft_text", "_ft_first")


def token_sequences(df: DataFrame, id_col: str, text_col: str, vocab: DataFrame,
                    length: int = 10, out: str = "title_seq") -> DataFrame:
    """Texts -> known-token indices, keeping the last ``length`` and
    left-padding with 0 (pre-truncate, pre-pad).  Only the last ``length``
    known tokens of an id are gathered: earlier ones go before the shuffle
    and again after it (a rank-limited window)."""
    toks = df.select(id_col, F.posexplode(title_tokens(text_col)).alias("_p", "word"))
    known = toks.join(vocab.select("word", "idx"), "word", "inner").select(id_col, "_p", "idx")
    from_end = F.row_number().over(Window.partitionBy(id_col).orderBy(F.col("_p").desc(), F.col("idx").desc()))
    tail = known.withColumn("_r", from_end).where(F.col("_r") <= length)
    seqs = tail.groupBy(id_col).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("_p", "idx"))), lambda s: s["idx"]).alias("_s"))
    padded = F.concat(F.array_repeat(F.lit(0), F.lit(length) - F.size("_s")), F.col("_s"))
    base = df.select(id_col).distinct()
    res = base.join(seqs.select(id_col, padded.alias(out)), id_col, "left")
    return res.withColumn(out, F.coalesce(F.col(out), F.array_repeat(F.lit(0), length)))


# ---- k-fold target encoding ----------------------------------------------

def kfold_target_encode(df: DataFrame, category: str, target: str, fold_col: str,
                        out: str, n_folds: int = 5, digits: int = 4) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold target mean: each row gets the mean target of its category
    over the rows of the *other* folds, or the global mean when its category
    occurs in no other fold.  One aggregation by (category, fold) gives
    every fold's complement as (total - fold); no per-fold passes.

    Returns (encoded rows, mapping).  The mapping holds, per category, the
    mean over all rows (what serving should use) and the literal value the
    fold loop leaves behind: the mean over the training part of the last
    fold (folds 0..n_folds-1); that part holds every row of the category
    unless the category has rows in the last fold, so the value is the
    last fold's out-of-fold mean when it exists and the all-rows mean
    otherwise."""
    t = F.col(target).cast("decimal(38,6)")
    # the one table that everything below is taken from
    per = materialize(df.groupBy(category, fold_col).agg(F.sum(t).alias("_sf"), F.count(t).alias("_nf")))
    tot = per.groupBy(category).agg(F.sum("_sf").alias("_st"), F.sum("_nf").alias("_nt"))
    glob = per.agg((F.sum("_sf").cast("double") / F.sum("_nf")).alias("_g"))
    g = glob.select("_g").scalar()
    comp = per.join(tot, category).select(
        category, fold_col,
        F.try_divide((F.col("_st") - F.col("_sf")).cast("double"),
                     (F.col("_nt") - F.col("_nf")).cast("double")).alias("_oof"))
    enc = (df.join(comp, [category, fold_col], "left")
           .withColumn(out, F.round(F.coalesce(F.col("_oof"), g), digits)).drop("_oof"))
    last = comp.where(F.col(fold_col) == n_folds - 1).select(category, F.col("_oof").alias("_last"))
    mean_all = F.col("_st").cast("double") / F.col("_nt")
    mapping = tot.join(last, category, "left").select(
        category,
        F.round(mean_all, digits).alias("mean_all"),
        F.round(F.coalesce(F.col("_last"), mean_all), digits).alias("mean_last_fold"))
    return enc, mapping


def target_maps(df: DataFrame, columns: list[str], target: str, fold_col: str, n_folds: int = 5,
                suffix: str = "_te") -> tuple[DataFrame, DataFrame]:
    """Out-of-fold target means of several columns, and one mapping table to
    save: (column, value, mean_all, mean_last_fold), with a row of null value
    per column that holds the mean of all rows, for values not seen."""
    out, maps = df, None
    for c in columns:
        out, m = kfold_target_encode(out, c, target, fold_col, c + suffix, n_folds)
        rest = df.agg(F.round(F.sum(F.col(target).cast("decimal(38,6)")).cast("double") / F.count(target), 4).alias("m"))
        part = m.where(F.col(c).isNotNull()).select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                                                    "mean_all", "mean_last_fold")
        part = part.unionByName(rest.select(F.lit(c).alias("column"), F.lit(None).cast("string").alias("value"),
                                            F.col("m").alias("mean_all"), F.col("m").alias("mean_last_fold")))
        maps = part if maps is None else maps.unionByName(part)
    return out, maps


def apply_target_maps(df: DataFrame, maps: DataFrame, columns: list[str], use: str = "mean_all", suffix: str = "_te") -> DataFrame:
    """Serving: each column's mean from a loaded mapping, that of all rows for
    a value that is null or not in it."""
    out = df
    for c in columns:
        own = maps.where(F.col("column") == c)
        rest = own.where("value IS NULL").select(F.first(use)).scalar()
        out = lookup(out, c, own.where("value IS NOT NULL"), c + suffix, value=use, default=None)
        out = out.withColumn(c + suffix, F.coalesce(c + suffix, rest))
    return out


# ---- first rows -----------------------------------------------------------

def first_per_key(df, key, order_cols, value_cols):
    """First row per key in a declared order, as an aggregate:
    ``min(struct(order..., values...))`` is combined map-side, so a hot key
    never gathers its rows in one task (no per-key window sort)."""
    packed = F.min(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)],
                            *[F.col(c).alias(f"v{i}") for i, c in enumerate(value_cols)]))
    return df.groupBy(key).agg(packed.alias("_fp")).select(
        key, *[F.col(f"_fp.v{i}").alias(c) for i, c in enumerate(value_cols)])


# ---- splits --------------------------------------------------------------

def hash_fraction(key: Column | str, seed: str = "42") -> Column:
    """A stable pseudo-random number in [0, 100) from a row key (md5-based,
    independent of partitioning -- unlike ``randomSplit``)."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.substring(F.md5(F.concat(k.cast("string"), F.lit(seed))), 1, 8)
    return F.conv(h, 16, 10).cast("long") % 100


def hash_split(df: DataFrame, key: str, train_percent: int = 80, seed: str = "42",
               split_col: str = "split") -> DataFrame:
    return df.withColumn(split_col, F.when(hash_fraction(key, seed) < train_percent,
                                           F.lit("train")).otherwise(F.lit("test")))
