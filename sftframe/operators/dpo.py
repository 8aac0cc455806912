"""Preference losses and rewards from token scores."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftframe.functions import arrays as A
from sftframe.functions.numeric import let, log_sum_exp, neg_log_sigmoid
from sftframe.options import PreferenceOptions
from sftframe.sources.tables import require_columns

SIDES = ("chosen", "rejected")


# -- token level ------------------------------------------------------------------------------------------------


def label_scores(df: DataFrame, logits: str = "logits", label: str = "label_id", weighting: bool = False) -> DataFrame:
    """Add ``logp`` of the label, the sum and number of the logits, and for weighting ``lse2 = log(sum(p^2))``.

    A row holds the scores of one place, so nothing is shuffled and no softmax table is made.
    """
    scores, lse = F.col(logits), F.col("_lse")
    made = df.withColumn("_lse", log_sum_exp(scores)).withColumns(
        {
            "logp": F.get(scores, F.col(label)) - lse,
            "logit_sum": A.total(scores),
            "logit_count": F.size(scores).cast("bigint"),
        }
    )
    if weighting:
        doubled = let(lse, lambda mass: F.transform(scores, lambda v: (v - mass) * 2))
        made = made.withColumn("lse2", log_sum_exp(doubled))
    return made.drop("_lse")


def long_label_scores(scores: DataFrame, place: list[str]) -> DataFrame:
    """``place, logp, logit_sum, logit_count`` from a long table ``place, token_id, logit, label_id``.

    Every task adds up the exponentials of a place by whole numbers of the logit, so what is shuffled is a few rows
    per place and task, and not the vocabulary.
    """
    # A score of minus infinity has no mass; it goes to the lowest number.
    whole = F.floor(F.greatest("logit", F.lit(-1e15)))
    parts = scores.withColumn("_whole", whole).groupBy(*place, "_whole").agg(
        F.sum(F.exp(F.col("logit") - F.col("_whole"))).alias("_mass"),
        F.max(F.when(F.col("token_id") == F.col("label_id"), F.col("logit"))).alias("_label"),
        F.sum("logit").alias("_sum"),
        F.count("*").alias("_count"),
    )
    topped = parts.withColumn("_top", F.max("_whole").over(Window.partitionBy(*place)))
    mass = F.sum(F.col("_mass") * F.exp((F.col("_whole") - F.col("_top")).cast("double")))
    return topped.groupBy(*place).agg(
        (F.max("_label") - F.max("_top") - F.log(mass)).alias("logp"),
        F.sum("_sum").alias("logit_sum"),
        F.sum("_count").alias("logit_count"),
    )


# -- sequence level ---------------------------------------------------------------------------------------------


def realigned(places: DataFrame, key: list[str]) -> DataFrame:
    """Add ``realigned_logp``: the masked log-probability of the place before, at the first place that of the last.

    The policy weight subtracts ``lse2`` of a place from the log-probability that stands there after scores have
    been rolled one place on.  Without this step the weight uses the place's own log-probability.
    """
    in_pair = Window.partitionBy(*key).orderBy("side", "pos")
    masked = F.when(F.col("mask") == 1, F.col("logp")).otherwise(0.0)
    same_side = F.lag("side").over(in_pair) == F.col("side")
    before = places.withColumn("_before", F.when(same_side, F.lag(masked).over(in_pair)))
    last = F.max_by(masked, F.col("pos")).over(Window.partitionBy(*key, "side"))
    return before.withColumn("realigned_logp", F.coalesce("_before", last)).drop("_before")


def _sums(places: DataFrame, opts: PreferenceOptions, rows: Column) -> dict[str, Column]:
    masked = rows & (F.col("mask") == 1)
    scored = masked & ~F.col("is_last")
    # The labels of an encoder-decoder model are not moved, so its last place has a score, too.
    counted = masked if opts.encoder_decoder else scored
    if opts.nll_mask != "loss_mask":
        counted = counted & (F.col("label_id") != 0)

    def over(some: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(some, value)), F.lit(0.0))

    sums = {
        "logp": over(scored, F.col("logp")),
        "length": F.count_if(masked),
        "nll_sum": over(counted, -F.col("logp")),
        "nll_count": F.count_if(counted),
    }
    if "logit_sum" in places.columns:
        sums["logit_sum"] = over(masked, F.col("logit_sum"))
        sums["logit_count"] = F.coalesce(F.sum(F.when(masked, F.col("logit_count"))), F.lit(0))
    if "lse2" in places.columns:
        logp = F.col("realigned_logp" if "realigned_logp" in places.columns else "logp")
        sums["weight_sum"] = over(masked, logp - F.col("lse2"))
    return sums


def sequence_sums(places: DataFrame, key: list[str], opts: PreferenceOptions | None = None) -> DataFrame:
    """Sums per ``key, side`` of scored places: ``pos, mask, is_last, label_id, logp`` and the optional extras.

    ``pos`` is the place of the score and says something about token ``pos + 1``; the mask is the rolled loss
    mask.  Lengths count every masked place.  The log-probability leaves out a mask that wrapped around to the
    last place (``is_last``), because that token has no score.
    """
    sums = _sums(places, opts or PreferenceOptions(), F.lit(True))
    return places.groupBy(*key, "side").agg(*[column.alias(name) for name, column in sums.items()])


def pair_sums(places: DataFrame, key: list[str], opts: PreferenceOptions | None = None) -> DataFrame:
    """The same sums with one row per pair: ``chosen_*`` and ``rejected_*``, in one shuffle and without a self-join.

    A pair that lacks a side fails the job.
    """
    opts = opts or PreferenceOptions()
    columns = [
        column.alias(f"{side}_{name}")
        for side in SIDES
        for name, column in _sums(places, opts, F.col("side") == side).items()
    ]
    both = [F.count_if(F.col("side") == side).alias(f"_{side}_places") for side in SIDES]
    summed = places.groupBy(*key).agg(*columns, *both)
    whole = (F.col("_chosen_places") > 0) & (F.col("_rejected_places") > 0)
    lacking = F.raise_error(F.concat(F.lit("a pair lacks a side: "), F.concat_ws(",", *[F.col(k).cast("string") for k in key])))
    return summed.where(F.when(whole, True).otherwise(lacking.cast("boolean"))).drop("_chosen_places", "_rejected_places")


def token_arrays(scores: DataFrame, key: list[str]) -> DataFrame:
    """One row per pair with the four arrays that ``array_sums`` reads, from a row per completion token.

    ``scores`` holds ``key, side, pos, policy_logp, ref_logp``.  A group is one pair, so one shuffle by ``key``.
    """
    entry = F.struct("pos", "policy_logp", "ref_logp")
    lists = [F.array_sort(F.collect_list(F.when(F.col("side") == side, entry))).alias(f"_{side}") for side in SIDES]
    parts = {"": "policy_logp", "ref_": "ref_logp"}
    return (
        scores.groupBy(*key)
        .agg(*lists)
        .select(
            *key,
            *[F.col(f"_{side}.{name}").alias(f"{prefix}{side}_logps") for prefix, name in parts.items() for side in SIDES],
        )
    )


def array_sums(df: DataFrame) -> DataFrame:
    """``chosen_logp, rejected_logp, ref_*_logp, *_length`` from the four arrays of completion token scores."""
    made = {f"{side}_length": F.size(f"{side}_logps").cast("bigint") for side in SIDES}
    for prefix in ("", "ref_"):
        for side in SIDES:
            made[f"{prefix}{side}_logp"] = A.total(F.col(f"{prefix}{side}_logps"))
    return df.withColumns(made)


def length_desensitised(df: DataFrame, ld_alpha: float) -> DataFrame:
    """Policy log-probabilities with full weight up to the shorter completion and ``ld_alpha`` beyond it."""
    public = F.least("chosen_length", "rejected_length").cast("int")

    def weighted(name: str) -> Column:
        values = F.col(name)
        rest = F.slice(values, public + 1, F.size(values) - public)
        return A.total(A.head(values, public)) + F.lit(ld_alpha) * A.total(rest)

    return df.withColumns({f"{side}_logp": weighted(f"{side}_logps") for side in SIDES})


def with_reference(pairs: DataFrame, scores: DataFrame | None, key: list[str]) -> DataFrame:
    """Reference log-probabilities: the pair's own columns when both exist, else a join to a table of scores."""
    names = [f"ref_{side}_logp" for side in SIDES]
    if all(name in pairs.columns for name in names):
        return pairs
    if scores is None:
        raise ValueError("reference log-probabilities are neither in the pairs nor given as a table")
    require_columns(scores, [*key, *names], "the table of reference scores")
    return pairs.drop(*names).join(scores.select(*key, *names), key, "left")


# -- loss and rewards -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Scored:
    """Losses and rewards per pair, and their means per batch when asked for."""

    pairs: DataFrame
    metrics: DataFrame | None


def _require_lengths(pairs: DataFrame) -> DataFrame:
    names = [f"{side}_length" for side in SIDES]
    require_columns(pairs, names, "the length-aware loss")
    return pairs.withColumns({n: F.coalesce(F.col(n), F.raise_error(F.lit(f"{n} is null"))) for n in names})


def length_normalised(pairs: DataFrame) -> DataFrame:
    """Log-probabilities per token instead of per sequence, for policy and reference."""
    return pairs.withColumns(
        {
            f"{prefix}{side}_logp": F.col(f"{prefix}{side}_logp") / F.col(f"{side}_length")
            for prefix in ("", "ref_")
            for side in SIDES
        }
    )


def rewards(pairs: DataFrame, beta: float) -> DataFrame:
    made = pairs.withColumns(
        {f"{side}_reward": beta * (F.col(f"{side}_logp") - F.col(f"ref_{side}_logp")) for side in SIDES}
    )
    return made.withColumn("accuracy", (F.col("chosen_reward") > F.col("rejected_reward")).cast("double")).withColumn(
        "reward_margin", F.col("chosen_reward") - F.col("rejected_reward")
    )


def loss_argument(opts: PreferenceOptions) -> Column:
    """Scaled log-ratio difference; the ``regul`` strategy adds the weighted difference of the lengths."""
    policy = F.col("chosen_logp") - F.col("rejected_logp")
    reference = F.col("ref_chosen_logp") - F.col("ref_rejected_logp")
    scaled = opts.beta * (policy - reference)
    if opts.strategy == "ld":
        return scaled
    return scaled + opts.length_alpha * (F.col("chosen_length") - F.col("rejected_length"))


def policy_weight() -> Column:
    per_side = [F.col(f"{side}_weight_sum") / F.col(f"{side}_length") for side in SIDES]
    return F.least(F.exp(per_side[0] + per_side[1]), F.lit(1.0))


def batch_nll(batch: list[str]) -> Column:
    """Mean negative log-likelihood of the chosen tokens of a batch: the same value on each of its rows."""
    rows = Window.partitionBy(*batch)
    return F.sum("chosen_nll_sum").over(rows) / F.sum("chosen_nll_count").over(rows)


def score(
    pairs: DataFrame,
    opts: PreferenceOptions,
    batch: list[str],
    loss_fn: Callable[[Column], Column] = neg_log_sigmoid,
    extra_metrics: dict[str, Column] | None = None,
    return_metrics: bool = True,
    evaluation: bool = False,
) -> Scored:
    """Loss and rewards of every pair, and means per batch.

    ``pairs`` holds one row per pair: ``chosen_logp, rejected_logp, ref_*_logp, *_length``; the extra terms read
    ``*_nll_*``, ``*_weight_sum`` and ``aux_loss``.  ``loss_fn`` maps the loss argument to a loss.
    """
    df = _require_lengths(pairs)
    if opts.strategy == "ld":
        require_columns(df, [f"{side}_logps" for side in SIDES], "the ld strategy")
        df = length_desensitised(df, opts.ld_alpha)
    if opts.length_normalised:
        df = length_normalised(df)
    loss = loss_fn(F.col("loss_argument"))
    df = rewards(df, opts.beta).withColumn("loss_argument", loss_argument(opts))
    if opts.rpo_alpha is not None or opts.report_nll:
        df = df.withColumn("nll_loss", batch_nll(batch))
    if opts.rpo_alpha is not None:
        loss = loss + opts.rpo_alpha * F.col("nll_loss")
    if opts.use_weighting:
        df = df.withColumn("policy_weight", policy_weight())
        loss = loss * F.col("policy_weight")
    if opts.aux_loss_coef is not None:
        loss = loss + opts.aux_loss_coef * F.col("aux_loss")
    df = df.withColumn("loss", loss)
    metrics = batch_metrics(df, batch, extra_metrics, evaluation) if return_metrics else None
    return Scored(df, metrics)


def batch_metrics(
    scored: DataFrame, batch: list[str], extra: dict[str, Column] | None = None, evaluation: bool = False
) -> DataFrame:
    """Means per batch; ``extra`` names further aggregates.  Evaluation metrics get the prefix ``eval_``."""
    means = {
        "rewards_chosen": F.avg("chosen_reward"),
        "rewards_rejected": F.avg("rejected_reward"),
        "rewards_accuracies": F.avg("accuracy"),
        "rewards_margins": F.avg("reward_margin"),
        "logps_chosen": F.avg("chosen_logp"),
        "logps_rejected": F.avg("rejected_logp"),
    }
    if "chosen_logit_sum" in scored.columns:
        for side in SIDES:
            means[f"logits_{side}"] = F.sum(f"{side}_logit_sum") / F.sum(f"{side}_logit_count")
    for name in ("nll_loss", "aux_loss"):
        if name in scored.columns:
            means[name] = F.avg(name)
    means.update(extra or {})
    prefix = "eval_" if evaluation else ""
    named = [value.alias(f"{prefix}{name}") for name, value in means.items()]
    return scored.groupBy(*batch).agg(F.count("*").alias("pairs"), F.avg("loss").alias("loss"), *named)


def overall_metrics(scored: DataFrame, evaluation: bool = False) -> DataFrame:
    """The same means over all batches."""
    return batch_metrics(scored, [], evaluation=evaluation)
