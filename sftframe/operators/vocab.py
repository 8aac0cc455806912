"""Vocabulary: ranked tokens with dense ids, special tokens after them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftframe.options import EOS_TOKEN, IGNORE_ID, PAD_TOKEN, UNK_TOKEN
from sftframe.plans.index import ranged_positions
from sftframe.sources.tables import require_columns

@dataclass(frozen=True)
class Specials:
    """Ids that collation and decoding need."""

    unk_id: int | None
    eos_id: int
    pad_id: int
    ignore_id: int
    vocab_size: int
    pad_is_added: bool


def token_counts(df: DataFrame, tokens_col: str) -> DataFrame:
    """``token, n``: partial counts per task before the shuffle keep frequent tokens cheap."""
    return df.select(F.explode(tokens_col).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def build_vocab(
    df: DataFrame, tokens_col: str, size: int, eos: str = EOS_TOKEN, unk: str = UNK_TOKEN, pad: str = PAD_TOKEN
) -> DataFrame:
    """``token, id, n, special``: the ``size`` most frequent tokens, then UNK, EOS and PAD.

    Tokens are numbered where they lie after a range partitioning by rank, so no task sees the whole vocabulary.
    """
    counts = token_counts(df, tokens_col).where(~F.col("token").isin(eos, unk, pad))
    ranked = ranged_positions(counts.withColumns({"_all": F.lit(0), "_down": -F.col("n")}), "_all", ["_down", "token"], "_at")
    top = ranked.where(F.col("_at") < size).select("token", F.col("_at").cast("int").alias("id"), "n", F.lit(False).alias("special"))
    after = top.agg(F.count("*").cast("int").alias("_size"))
    added = after.select(F.posexplode(F.array(F.lit(unk), F.lit(eos), F.lit(pad))).alias("_at", "token"), "_size")
    specials = added.select("token", (F.col("_size") + F.col("_at")).alias("id"), F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("special"))
    return top.unionByName(specials)


def use_vocab(table: DataFrame, specials: list[str], pad: str = PAD_TOKEN) -> tuple[DataFrame, bool]:
    """Take a ``token, id`` table of the user's; PAD is added with the next free id only when it is not there.

    Returns the vocabulary and whether PAD was added.
    """
    require_columns(table, ["token", "id"], "the vocabulary")
    base = table.select(
        "token",
        F.col("id").cast("int").alias("id"),
        F.lit(None).cast("bigint").alias("n"),
        F.col("token").isin(*specials, pad).alias("special"),
    )
    if base.where(F.col("token") == pad).limit(1).count():
        return base, False
    added = base.agg((F.max("id") + 1).alias("id")).select(
        F.lit(pad).alias("token"), "id", F.lit(None).cast("bigint").alias("n"), F.lit(True).alias("special")
    )
    return base.unionByName(added), True


def specials_table(vocab: DataFrame, eos: str = EOS_TOKEN, unk: str = UNK_TOKEN, pad: str = PAD_TOKEN) -> DataFrame:
    """One row: ids of the special tokens, the ignored label and the size of the vocabulary."""

    def id_of(token: str):
        return F.max(F.when(F.col("token") == token, F.col("id")))

    return vocab.agg(
        id_of(unk).alias("unk_id"),
        id_of(eos).alias("eos_id"),
        id_of(pad).alias("pad_id"),
        F.lit(IGNORE_ID).alias("ignore_id"),
        F.count("*").alias("vocab_size"),
    )


def special_ids(vocab: DataFrame, pad_is_added: bool = True, eos: str = EOS_TOKEN) -> Specials:
    row = specials_table(vocab, eos).first()
    if row["eos_id"] is None or row["pad_id"] is None:
        raise ValueError("the vocabulary lacks the EOS or the PAD token")
    return Specials(
        row["unk_id"], row["eos_id"], row["pad_id"], row["ignore_id"], row["vocab_size"], pad_is_added
    )
