"""Token features and batches.

The original tokenizer's vocabulary file is not published, so the
vocabulary is built from the data: whitespace tokens, dense ids by
(count desc, token asc) starting at 3, with 0 = pad, 1 = end of sequence,
2 = unknown.  Encoding cuts each row's tokens to the length that is kept and
looks them up inside the row (:func:`looked_up`), decoding likewise: both are
projections, without a shuffle.  A row without tokens stays: it encodes to the
end id and decodes to the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.config import DEFAULT, Settings, scratch_path
from parlance.operators.positions import exact_rank, hash_bucket, seeded_key, with_id_bucket

# Special ids of the original tokenizer.
PAD_ID, EOS_ID, UNK_ID, FIRST_ID = 0, 1, 2, 3
IGNORE_ID = -100
#: Slots of a vocabulary held for lookups inside rows: two tokens each on average at ``vocab_size``.
SLOTS = 1 << 14


def split_tokens(text: Column, keep: int | None = None) -> Column:
    """The whitespace tokens of a text, the first ``keep`` of them; none for a null text."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda t: t != "")
    return parts if keep is None else F.slice(parts, 1, keep)


def tokens(df: DataFrame, text: str, id_col: str = "row_id", keep: int | None = None) -> DataFrame:
    """``id_col, pos, token``: whitespace tokens with their position (0-based).

    With ``keep`` only the first ``keep`` tokens of a row are exploded, for an
    encoding of ``keep`` ids: a row of more still shows that it is too long, as
    ``keep`` tokens and the end id exceed it.  A row without tokens gives one row
    with null ``pos`` and ``token``.
    """
    return df.select(id_col, F.posexplode_outer(split_tokens(F.col(text), keep)).alias("pos", "token"))


def build_vocabulary(toks: DataFrame, vocab_size: int | None = None) -> DataFrame:
    """``token, n, id`` for the ``vocab_size - 3`` most frequent tokens.

    Exact and bounded: a histogram of token counts (one row per distinct
    count) gives the cut-off count; tokens above it are all in, tokens at it
    are taken in token order (a top-k); only the kept tokens (at most
    ``vocab_size``) are ranked.
    """
    size = (DEFAULT.vocab_size if vocab_size is None else vocab_size) - FIRST_ID
    path = scratch_path(toks.sparkSession, "token_counts")
    toks.where(F.col("token").isNotNull()).groupBy("token").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    counts = toks.sparkSession.read.parquet(path)
    hist = counts.groupBy("n").agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc())
    hist = hist.withColumn("before", F.coalesce(F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    cut = hist.where((F.col("before") < size) & (F.col("before") + F.col("k") >= size)).first()
    if cut is None:  # fewer distinct tokens than slots: keep all
        kept = counts
    else:
        above = counts.where(F.col("n") > cut["n"])
        at = counts.where(F.col("n") == cut["n"]).orderBy("token").limit(int(size - cut["before"]))
        kept = above.unionByName(at)
    rank = Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc(), F.col("token"))
    return kept.withColumn("id", (F.row_number().over(rank) + FIRST_ID - 1).cast("int"))


def looked_up(df: DataFrame, keys: Column, vocab: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``df`` with the column ``name``: the values of an array of keys by a vocabulary, null for keys it lacks.

    One value holds the whole table (at most ``vocab_size`` rows): an array of
    ``SLOTS`` small maps, the slot of a key given by its hash, so a lookup costs
    the same whatever the vocabulary's size.  It is computed once, as a scalar
    subquery, and goes out with the tasks: rows are neither exploded nor shuffled.
    """

    def slot(k: Column) -> Column:
        return F.pmod(F.xxhash64(k), F.lit(SLOTS)).cast("int")

    kind = vocab.schema[key].dataType  # the hash depends on the type
    entries = vocab.select(slot(F.col(key)).alias("_s"), F.struct(F.col(key).alias("k"), F.col(value).alias("v")).alias("_e"))
    none = F.lit(None).cast(entries.schema["_e"].dataType)
    slots = entries.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("_s"), none.alias("_e"))
    filled = entries.unionByName(slots).groupBy("_s").agg(F.collect_list("_e").alias("_e"))  # leaves nulls out
    ordered = F.sort_array(F.collect_list(F.struct("_s", "_e")))
    table = filled.agg(F.transform(ordered, lambda x: F.map_from_entries(x["_e"]))).scalar()
    # Two projections, as a lambda may not be written with a subquery; the optimizer makes them one, so no row carries the table.
    held = df.withColumn("_table", F.array(table))

    def values(whole: Column) -> Column:
        return F.transform(keys, lambda k: F.get(whole, slot(k.cast(kind)))[k.cast(kind)])

    return held.withColumn(name, F.transform("_table", values)[0]).drop("_table")


def encode_tokens(df: DataFrame, text: str, vocab: DataFrame, id_col: str = "row_id", keep: int | None = None) -> DataFrame:
    """``id_col, ids``: token ids in text order, unknown -> 2, end id appended.

    ``keep`` as in :func:`tokens`.  Each row is encoded where it lies; repeated
    and null row ids stay rows of their own.
    """
    found = looked_up(df.select(id_col, text), split_tokens(F.col(text), keep), vocab, "token", "id", "_found")
    ids = F.transform("_found", lambda i: F.coalesce(i, F.lit(UNK_ID)))
    return found.select(id_col, F.concat(ids, F.array(F.lit(EOS_ID))).alias("ids"))


def pad_truncate_ids(ids: Column, n: int) -> tuple[Column, Column]:
    """P20: (ids, attention mask) of exactly ``n``: cut to ``n - 1`` tokens plus
    the end id when too long, padded with 0 otherwise; mask 1 for real ids."""
    body = F.when(F.size(ids) > n, F.concat(F.slice(ids, 1, n - 1), F.array(F.lit(EOS_ID)))).otherwise(ids)
    real = F.least(F.size(ids), F.lit(n))
    padded = F.concat(body, F.array_repeat(F.lit(PAD_ID), F.lit(n) - real))
    mask = F.concat(F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), F.lit(n) - real))
    return padded, mask


def mask_labels(labels: Column) -> Column:
    """Pad id -> -100 (ignored by the loss)."""
    return F.transform(labels, lambda x: F.when(x == PAD_ID, F.lit(IGNORE_ID)).otherwise(x))


def unmask_decode(df: DataFrame, labels: str, vocab: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Drop -100 and special ids, ids back to text joined by spaces; no ids give the empty text."""
    kept = F.filter(F.col(labels), lambda x: x >= FIRST_ID)
    found = looked_up(df.select(id_col, labels), kept, vocab, "id", "token", "_found")
    return found.select(id_col, F.coalesce(F.array_join("_found", " "), F.lit("")).alias("text"))


def assign_batches(splits: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Position in the split's order and batch number.

    ``train`` is in seeded shuffle order (md5 of seed and row id), ``val``
    and ``test`` in row order.  One ranking pass over all splits: positions come
    from :func:`exact_rank` (bucket counts + offsets), never from a window over a
    whole split; the buckets of row ids follow their quantiles, so sparse or
    outlying ids do not fill one bucket.
    """
    train = F.col("split") == "train"
    keyed = with_id_bucket(splits, "_ids").withColumn("_key", F.when(train, seeded_key("row_id", settings.random_seed)))
    bucket = F.when(train, hash_bucket("_key", settings.rank_bucket_hex_digits)).otherwise(F.lpad(F.col("_ids").cast("string"), 8, "0"))
    ranked = exact_rank(keyed, ["split"], ["_key", "row_id"], bucket, "position").drop("_key", "_ids")
    return ranked.withColumn("batch", F.expr(f"(position - 1) div {settings.batch_size}"))


#: Rounds of the permutation of an epoch's order.
ROUNDS = 16


def _number(*parts: Column) -> Column:
    """A number of 60 bits from the md5 of the parts, joined by colons (same in DuckDB)."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("bigint")


def permuted(position: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0 .. n - 1, computed from the position alone.

    Each round pairs the positions x and (k - x) mod n and swaps those pairs
    whose keyed hash says so, so every round, and the whole, is a permutation
    for any n.
    """

    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(_number(key, r) % n - x, n)
        return F.when(_number(key, r, F.greatest(x, partner)) % 2 == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), position.cast("bigint"), swap)


def epoch_batches(batches: DataFrame, epochs: int, settings: Settings = DEFAULT) -> DataFrame:
    """A new order of the training split in every epoch: ``epoch, row_id, position, batch``.

    ``batches`` is the result of :func:`assign_batches`, as stored: the order of
    an epoch is a projection of the position there, without a shuffle or sort.
    """
    train = batches.where(F.col("split") == "train").select("row_id", "position")
    size = train.agg(F.count(F.lit(1)).alias("_n"))
    rows = train.crossJoin(F.broadcast(size)).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))  # size: one row
    key = F.concat_ws(":", F.lit(settings.random_seed), "epoch")
    at = permuted(F.col("position") - 1, F.col("_n"), key)
    return rows.select("epoch", "row_id", (at + 1).alias("position")).withColumn("batch", F.expr(f"(position - 1) div {settings.batch_size}"))
