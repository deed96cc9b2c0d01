"""Record transforms and the hybrid (real + augmented) dataset.

Each transform exists in two forms:

* flat, over positioned turns ``(keys.., pos, n, role, text)`` - a new
  position per turn, row-local, exact for conversations of any length;
* nested, over bounded records ``turns ARRAY<STRUCT<..>>`` - array
  expressions (``slice``/``reverse``/``transform``), no shuffle at all.

Random choices are seeded md5 hashes of the record key (and turn position),
so a rerun on any partitioning gives the same output and DuckDB can replay it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.functions import roles as R
from threadline.functions.hashing import hex_slice_int, seeded_bucket, seeded_hex
from threadline.operators.positions import turn_positions
from threadline.operators.sample import exact_sample

# Augmentation kinds (chosen by hash % 3 in this order) and the
# prefixes of the "paraphrase" transform (chosen by hash % 4 in this order).
AUG_TYPES = ("reverse", "shorten", "paraphrase")
PARAPHRASE_PREFIXES = ("Can you help me with ", "I need to ", "Please ", "")
# Size guards of the transforms.
REVERSE_MIN_TURNS = 4
SHORTEN_MIN_TURNS = 6


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# -- flat transforms (positioned turns) ----------------------------------------

def reverse_pos(pos: Column, n: Column) -> Column:
    """Keep the first two and the last turn, reverse the middle ``[2, n-1)``."""
    middle = (n >= REVERSE_MIN_TURNS) & (pos >= 2) & (pos <= n - 2)
    return F.when(middle, n - pos).otherwise(pos)


def aug_reverse(df: DataFrame, pos: str = "pos", n: str = "n") -> DataFrame:
    return df.withColumn(pos, reverse_pos(F.col(pos), F.col(n)))


def shorten_keep(pos: Column, n: Column) -> Column:
    return (n < SHORTEN_MIN_TURNS) | (pos < 2) | (pos >= n - 2)


def shorten_pos(pos: Column, n: Column) -> Column:
    """First two + last two turns when ``n >= 6``."""
    return F.when((n >= SHORTEN_MIN_TURNS) & (pos >= 2), pos - (n - 4)).otherwise(pos)


def aug_shorten(df: DataFrame, pos: str = "pos", n: str = "n") -> DataFrame:
    p, c = F.col(pos), F.col(n)
    return (df.filter(shorten_keep(p, c)).withColumn(pos, shorten_pos(p, c))
            .withColumn(n, F.when(c >= SHORTEN_MIN_TURNS, F.lit(4)).otherwise(c)))


def prefix_text(seed, keys, pos: Column, role: Column, text: Column, user_role: str = R.USER) -> Column:
    """With p = 1/2 per user turn, prefix one of the fixed strings (seeded by record and position)."""
    h = seeded_hex(f"{seed}:prefix", *[F.col(k) for k in _names(keys)], pos)
    coin = hex_slice_int(h, 1) % 2 == 1
    choice = hex_slice_int(h, 9) % len(PARAPHRASE_PREFIXES)
    prefix = F.element_at(F.array(*[F.lit(p) for p in PARAPHRASE_PREFIXES]), (choice + 1).cast("int"))
    return F.when((role == user_role) & coin, F.concat(prefix, text)).otherwise(text)


def aug_prefix(df: DataFrame, keys="conv_id", seed: int | str = 42, pos: str = "pos",
               user_role: str = R.USER) -> DataFrame:
    return df.withColumn("text", prefix_text(seed, keys, F.col(pos), F.col("role"), F.col("text"), user_role))


def aug_kind(seed, keys) -> Column:
    """Which transform a selected record gets: ``AUG_TYPES[md5 bucket % 3]``."""
    b = seeded_bucket(f"{seed}:kind", len(AUG_TYPES), *[F.col(k) for k in _names(keys)])
    return F.element_at(F.array(*[F.lit(t) for t in AUG_TYPES]), (b + 1).cast("int"))


def augment_flat(df: DataFrame, keys="conv_id", seed: int | str = 42, kind_col: str = "aug_type",
                 user_role: str = R.USER) -> DataFrame:
    """Apply each record's seeded transform to positioned turns (``pos``, ``n``)."""
    keys = _names(keys)
    kind = aug_kind(seed, keys)
    p, n = F.col("pos"), F.col("n")
    staged = df.withColumn(kind_col, kind)
    k = F.col(kind_col)
    kept = staged.filter((k != "shorten") | shorten_keep(p, n))
    new_pos = (F.when(k == "reverse", reverse_pos(p, n))
               .when(k == "shorten", shorten_pos(p, n))
               .otherwise(p))
    new_text = F.when(k == "paraphrase",
                      prefix_text(seed, keys, p, F.col("role"), F.col("text"), user_role)).otherwise(F.col("text"))
    new_n = F.when((k == "shorten") & (n >= SHORTEN_MIN_TURNS), F.lit(4)).otherwise(n)
    return kept.withColumn("text", new_text).withColumn("pos", new_pos).withColumn("n", new_n)


def hybrid(df: DataFrame, keys="conv_id", order: str = "turn", ratio: float = 0.5, seed: int | str = 42,
           user_role: str = R.USER, positioned: bool = False, sample=None) -> DataFrame:
    """Real records plus seeded augmented copies of an exact sample of them.

    Output: flat turns with ``variant`` (0 real, 1 augmented), ``origin``
    columns equal to the record key, ``aug_type`` and the new ``pos``.  The
    sample is a row-local predicate (see :mod:`threadline.operators.sample`),
    so selecting records needs no join; pass ``sample`` to reuse one.
    """
    keys = _names(keys)
    if sample is None:
        sample = exact_sample(df, keys, seed, ratio=ratio)
    if not positioned:
        df = turn_positions(df, keys, order)
    real = df.withColumn("variant", F.lit(0)).withColumn("aug_type", F.lit(None).cast("string"))
    aug = augment_flat(df.filter(sample.predicate()), keys, seed, "aug_type", user_role)
    aug = aug.withColumn("variant", F.lit(1))
    return real.unionByName(aug)


def hybrid_record_keys(df: DataFrame, sample, keys="conv_id") -> DataFrame:
    """Record keys of the hybrid set, ``(keys.., variant)``, straight from the input:
    every record once (variant 0) and the sampled ones again (variant 1)."""
    keys = _names(keys)
    recs = df.select(*keys).distinct()
    return (recs.withColumn("variant", F.lit(0))
            .unionByName(recs.filter(sample.predicate()).withColumn("variant", F.lit(1))))


# -- nested transforms (bounded records) ----------------------------------------

def reverse_turns(t: Column) -> Column:
    n = F.size(t)
    body = F.concat(F.slice(t, 1, 2), F.reverse(F.slice(t, 3, F.greatest(n - 3, F.lit(0)))), F.slice(t, -1, 1))
    return F.when(n >= REVERSE_MIN_TURNS, body).otherwise(t)


def shorten_turns(t: Column) -> Column:
    n = F.size(t)
    return F.when(n >= SHORTEN_MIN_TURNS, F.concat(F.slice(t, 1, 2), F.slice(t, -2, 2))).otherwise(t)


def prefix_turns(t: Column, seed, keys, user_role: str = R.USER) -> Column:
    return F.transform(t, lambda x, i: x.withField(
        "text", prefix_text(seed, keys, i.cast("bigint"), x["role"], x["text"], user_role)))


def augment_records(records: DataFrame, keys=("conv_id", "start"), seed: int | str = 42,
                    turns_col: str = "turns", user_role: str = R.USER) -> DataFrame:
    """Apply each record's seeded transform to its (bounded) turns array."""
    keys = _names(keys)
    kind = aug_kind(seed, keys)
    t = F.col(turns_col)
    out = (F.when(kind == "reverse", reverse_turns(t))
           .when(kind == "shorten", shorten_turns(t))
           .otherwise(prefix_turns(t, seed, keys, user_role)))
    return records.withColumn("aug_type", kind).withColumn(turns_col, out)
