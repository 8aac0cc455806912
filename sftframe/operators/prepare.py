"""Preparation of instruction rows: format, encode, keep what fits into the context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftframe.functions import text as X
from sftframe.functions.arrays import once
from sftframe.operators.lookup import BROADCAST_ROWS, lookup_arrays
from sftframe.options import EOS_TOKEN, UNK_TOKEN, SftOptions


def formatted(pairs: DataFrame, opts: SftOptions) -> DataFrame:
    """``pair_id, full_text``."""
    text = X.format_full_text(F.col("instruction"), F.col("response"), opts.template, opts.eos_token)
    return pairs.select("pair_id", text.alias("full_text"))


def tokenised(pairs: DataFrame, opts: SftOptions) -> DataFrame:
    """``pair_id, full_text, tokens, n_tokens``.  Text is split once, also when a filter on the length follows."""
    tokens = once(X.pre_tokens(F.col("full_text"), opts.eos_token)).alias("tokens")
    return formatted(pairs, opts).select("pair_id", "full_text", tokens).withColumn("n_tokens", F.size("tokens"))


def within_context(df: DataFrame, max_length: int, n_col: str = "n_tokens") -> DataFrame:
    """Rows with fewer tokens than the limit; a row of exactly the limit is dropped."""
    return df.where(F.col(n_col) < max_length)


def _unknown_id(vocab: DataFrame) -> int | None:
    row = vocab.where(F.col("token") == UNK_TOKEN).select("id").first()
    return row["id"] if row else None


def encode(
    df: DataFrame, columns: dict[str, str], vocab: DataFrame, bound: int = BROADCAST_ROWS
) -> DataFrame:
    """Add id arrays for token arrays; ``columns`` maps a token column to the new id column."""
    unknown = _unknown_id(vocab)
    return lookup_arrays(
        df, vocab, "token", [(tokens, "id", ids, unknown) for tokens, ids in columns.items()], bound
    )


def encode_text(
    df: DataFrame, columns: dict[str, str], vocab: DataFrame, eos: str = EOS_TOKEN
) -> DataFrame:
    """Add id arrays for text columns."""
    pieces = {f"_pieces_{ids}": X.pre_tokens(F.col(text), eos) for text, ids in columns.items()}
    encoded = encode(df.withColumns(pieces), {f"_pieces_{ids}": ids for ids in columns.values()}, vocab)
    return encoded.drop(*pieces)


def decode(
    df: DataFrame,
    columns: dict[str, str],
    vocab: DataFrame,
    skip_special: bool = False,
    bound: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add text columns for id arrays; ``columns`` maps an id column to the new text column.

    An id that the vocabulary lacks fails the job.
    """
    shown = vocab.select("id", F.when(F.lit(skip_special) & F.col("special"), "").otherwise(F.col("token")).alias("piece"))
    pieces = [(ids, "piece", f"_pieces_{text}", None) for ids, text in columns.items()]
    found = lookup_arrays(df, shown, "id", pieces, bound)
    return found.withColumns({text: F.array_join(f"_pieces_{text}", "") for text in columns.values()}).drop(
        *[name for _, _, name, _ in pieces]
    )


def prepare(pairs: DataFrame, vocab: DataFrame, opts: SftOptions, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``pair_id, n_tokens, n_prompt, input_ids``: encoded rows within the context.

    ``n_prompt`` is the token count of the text up to the end of the response marker, encoded on its own; 0 when
    there is no marker.  The context filter runs before the id lookup.
    """
    kept = within_context(tokenised(pairs, opts), opts.max_length)
    n_prompt = F.size(X.pre_tokens(X.instruction_part(F.col("full_text")), opts.eos_token))
    rows = kept.select("pair_id", "n_tokens", n_prompt.alias("n_prompt"), "tokens")
    return encode(rows, {"tokens": "input_ids"}, vocab, bound).select(
        "pair_id", "n_tokens", "n_prompt", "input_ids"
    )
