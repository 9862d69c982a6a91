"""Policy, preference and loss analytics over tables of token log-probabilities.

Token tables hold one row per ``(sample_id, pos)``. A sample is one response, so windows over a
sample are bounded by the length of a response; everything wider is aggregated, never windowed.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from corpusflow.functions.skew import attach, group_stats, ordered_index
from corpusflow.functions.text import bind

_ID_BUDGET = 6_000_000  # ids of one batch that one task takes, some 16 bytes each with mask and log-probability
_RADIX = 8  # by how much a step of a discounted sum widens it


def group_advantage(df: DataFrame, group: list[str], reward: str = "reward", spread_by: list[str] = ["sample_id"]) -> DataFrame:
    """Add ``group_mean``, ``group_std`` and ``advantage`` of the reward within its prompt group."""
    stats = {"group_mean": F.avg(reward), "group_std": F.stddev_pop(reward)}
    scored = group_stats(df, group, stats, spread_by)
    return scored.withColumn("advantage", (F.col(reward) - F.col("group_mean")) / (F.col("group_std") + 1e-4))


def completion_mask(ids: Column, eos: int, pad_mask: Column) -> Column:
    """The pad mask, cut after the first end mark that is not padding."""
    seen = F.array_position(F.zip_with(ids, pad_mask, lambda x, m: F.when(m == 1, x)), F.lit(eos))
    end = F.when(seen > 0, seen).otherwise(F.size(ids))
    return F.slice(F.concat(F.slice(pad_mask, F.lit(1), end.cast("int")), F.array_repeat(F.lit(0), F.size(ids))), F.lit(1), F.size(ids))


def _last(array: Column, n: Column | int) -> Column:
    keep = F.least(F.size(array), F.lit(n) if isinstance(n, int) else n)
    return F.slice(array, F.size(array) - keep + 1, keep)


def pack_rollouts(
    df: DataFrame, batch: list[str], max_total_len: int = 2500, pad: int = 0, spread_by: list[str] = ["sample_id"]
) -> DataFrame:
    """Join prompt and response, keep the last ``max_total_len`` ids, pad to the longest of the batch.

    Rows hold whole sequences, so a batch is spread over tasks by its number of ids. Reads ``prompt_ids``, ``response_ids``, ``response_mask`` and ``response_logps``.
    """
    prompt = F.size("prompt_ids")
    ids = _last(F.concat("prompt_ids", "response_ids"), max_total_len)
    mask = _last(F.concat(F.array_repeat(F.lit(0), prompt), F.col("response_mask")), max_total_len)
    lead = F.array_repeat(F.lit(0.0), F.greatest(prompt - 1, F.lit(0)))
    long = prompt + F.size("response_ids") > max_total_len
    logps = F.concat(lead, F.col("response_logps"))
    packed = df.withColumns(
        {
            "input_ids": ids,
            "mask": mask,
            "old_logps": F.when(long, _last(logps, max_total_len - 1)).otherwise(logps),
        }
    ).drop("prompt_ids", "response_ids", "response_mask", "response_logps")
    first = F.array_position("mask", F.lit(1))
    packed = packed.withColumn("seq_len", F.size("input_ids")).withColumn(
        "prompt_len", F.when(first > 0, first - 1).otherwise(F.size("mask"))
    )
    sized = group_stats(packed, batch, {"_longest": F.max("seq_len")}, spread_by, max(1, _ID_BUDGET // max(1, max_total_len)))
    gap = F.col("_longest") - F.col("seq_len")
    missing = F.greatest(F.col("_longest") - 1 - F.size("old_logps"), F.lit(0))
    return sized.withColumns(
        {
            "input_ids": F.concat("input_ids", F.array_repeat(F.lit(pad), gap)),
            "mask": F.concat("mask", F.array_repeat(F.lit(0), gap)),
            "old_logps": F.concat("old_logps", F.array_repeat(F.lit(0.0), missing)),
        }
    ).drop("_longest")


def align_logps(ids: Column, logps: Column) -> Column:
    """As many log-probabilities as ids: missing ones are zeros in front, surplus ones are cut there."""
    gap = F.size(ids) - F.size(logps)
    return F.when(gap >= 0, F.concat(F.array_repeat(F.lit(0.0), gap), logps)).otherwise(_last(logps, F.size(ids)))


def join_logps(policy: DataFrame, old: DataFrame, ref: DataFrame) -> DataFrame:
    """Three tables of ``(sample_id, pos, logp)`` as columns of one: an inner join on sample and position.

    A join on both would deal out tables anew that are dealt out by sample, as other operators want them. So the rows
    of the three are put under each other and meet those of their position in a window over the sample.
    """
    keys, names, tables = ["sample_id", "pos"], ["logp_policy", "logp_old", "logp_ref"], (policy, old, ref)
    held = F.struct(F.col("logp").alias("v"))  # a null is a value here too
    none = [F.lit(None).cast(f"struct<v:{t.schema['logp'].dataType.simpleString()}>") for t in tables]
    parts = [
        t.filter(F.col("sample_id").isNotNull() & F.col("pos").isNotNull()).select(
            *keys, *[(held if n == name else x).alias(n) for n, x in zip(names, none)]
        )
        for t, name in zip(tables, names)
    ]
    here = Window.partitionBy("sample_id").orderBy("pos").rangeBetween(Window.currentRow, Window.currentRow)
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    met = rows.withColumns({n: F.collect_list(n).over(here) for n in names[:2]}).filter(F.col(names[2]).isNotNull())
    for n in names[:2]:
        met = met.withColumn(n, F.explode(n))
    return met.select(*keys, *[F.col(n)["v"].alias(n) for n in names])


def _mean(value: Column, mask: Column) -> Column:
    return F.sum(value * mask) / F.greatest(F.sum(mask), F.lit(1))


def k3(policy: Column, ref: Column) -> Column:
    return F.exp(ref - policy) - (ref - policy) - 1


def kl_terms(df: DataFrame, by: list[str]) -> DataFrame:
    """Masked means of the k3 estimate, the plain difference and the half squared policy change."""
    p, o, r, m = (F.col(c) for c in ("logp_policy", "logp_old", "logp_ref", "mask"))
    return df.groupBy(*by).agg(
        F.sum(m).cast("long").alias("n_tokens"),
        _mean(k3(p, r), m).alias("kl_k3"),
        _mean(r - p, m).alias("kl_ref"),
        _mean(F.lit(0.5) * (p - o) * (p - o), m).alias("approx_kl"),
    )


def surrogate(
    tokens: DataFrame,
    advantages: DataFrame,
    kind: str = "grpo",
    epsilon: float = 0.2,
    epsilon_high: float = 5.0,
    beta: float = 0.1,
) -> DataFrame:
    """Loss per sample: symmetric clipping (``grpo``) or an upper bound on the weight (``cispo``).

    The advantage is the same for all tokens of a sample, and the smaller of two products with it is
    the product with the smaller or the larger ratio, by its sign. So tokens are summed first and
    advantages joined to one row per sample.
    """
    p, o, r, m = (F.col(c) for c in ("logp_policy", "logp_old", "logp_ref", "mask"))
    ratio = F.exp(p - o)
    clipped = F.greatest(F.least(ratio, F.lit(1 + epsilon)), F.lit(1 - epsilon))
    sums = tokens.groupBy("sample_id").agg(
        F.sum(m).cast("long").alias("n_tokens"),
        F.sum(F.least(ratio, clipped) * m).alias("_low"),
        F.sum(F.greatest(ratio, clipped) * m).alias("_high"),
        F.sum(F.least(ratio, F.lit(epsilon_high)) * p * m).alias("_weighted"),
        F.sum(k3(p, r) * m).alias("_kl"),
    )
    joined = sums.join(advantages.select("sample_id", "advantage"), "sample_id")
    a = F.col("advantage")
    gain = a * F.col("_weighted") if kind == "cispo" else a * F.when(a >= 0, F.col("_low")).otherwise(F.col("_high"))
    loss = -(gain - beta * F.col("_kl")) / F.greatest(F.col("n_tokens"), F.lit(1))
    return joined.select("sample_id", "n_tokens", loss.alias("loss"))


def ppo_terms(
    df: DataFrame, by: list[str], clip: float = 0.2, clip_value: float = 0.2, kl_coef: float = 0.02
) -> DataFrame:
    """Batch masked means: clipped policy loss with its penalty, value loss, and clip fraction.

    Reads per token ``advantage``, ``return``, ``value_old`` and ``value`` beside the log-probabilities.
    """
    p, o, r, m, a = (F.col(c) for c in ("logp_policy", "logp_old", "logp_ref", "mask", "advantage"))
    ratio = F.exp(p - o)
    clipped = F.greatest(F.least(ratio, F.lit(1 + clip)), F.lit(1 - clip))
    value, old, ret = F.col("value"), F.col("value_old"), F.col("return")
    near = F.greatest(F.least(value, old + clip_value), old - clip_value)
    penalty = _mean(k3(p, r), m)
    return df.groupBy(*by).agg(
        (_mean(F.greatest(-a * ratio, -a * clipped), m) + kl_coef * penalty).alias("policy_loss"),
        (0.5 * _mean(F.greatest((value - ret) * (value - ret), (near - ret) * (near - ret)), m)).alias("value_loss"),
        _mean((F.abs(ratio - 1) > clip).cast("double"), m).alias("clip_fraction"),
        _mean(F.lit(0.5) * (p - o) * (p - o), m).alias("approx_kl"),
    )


def place_reward(tokens: DataFrame, rewards: DataFrame) -> DataFrame:
    """Add ``token_reward``: the sample's reward on its last valid token, zero elsewhere.

    Tokens are read once, and moved once by sample and position, like the windows that may follow; rewards, a row
    per sample, meet them by a hash of their part, which keeps that order.
    """
    along = Window.partitionBy("sample_id").orderBy("pos")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ended = tokens.withColumn("_end", F.max(F.when(F.col("mask") == 1, F.col("pos"))).over(whole))
    paid = rewards.select(F.col("sample_id").alias("_paid"), F.col("reward").alias("_reward")).hint("shuffle_hash")
    met = ended.join(paid, (F.col("sample_id") == F.col("_paid")) & F.col("_end").isNotNull(), "left")
    here = F.when(F.col("pos") == F.col("_end"), F.col("_reward"))
    return met.withColumn("token_reward", F.coalesce(here, F.lit(0.0))).drop("_paid", "_reward", "_end")


def discounted_rest(rate: float, column: Column, along: WindowSpec) -> Iterator[Column]:
    """Steps of the sum of ``rate**k`` times the value k rows later, k from 0; each is applied to the one before.

    The maps x -> value + rate * x compose associatively: from sums over s rows, one step makes sums over
    ``_RADIX * s`` rows. There are as many steps as it takes for the discount to vanish, and no division.
    """
    size = 1
    while (discount := rate**size) > 0:
        yield sum((F.coalesce(F.lead(column, k * size).over(along), F.lit(0.0)) * discount**k for k in range(1, _RADIX)), column)
        size *= _RADIX


def gae(df: DataFrame, gamma: float = 1.0, lam: float = 0.95) -> DataFrame:
    """Add ``advantage`` and ``return`` from ``token_reward`` and ``value``.

    The advantage is a discounted sum of later errors, by ``gamma * lam`` (0 to 1). Rows count by their order
    within the sample, so positions may start anywhere and leave gaps. All windows are over the same
    partitioning and order, so rows are shuffled and sorted once.
    """
    rate = gamma * lam
    if not 0 <= rate <= 1:
        raise ValueError("gamma * lam must be between 0 and 1")
    along = Window.partitionBy("sample_id").orderBy("pos")
    following = F.coalesce(F.lead("value").over(along), F.lit(0.0))
    out = df.withColumn("advantage", F.col("token_reward") + gamma * following - F.col("value"))
    if rate == 1:
        later = Window.partitionBy("sample_id").orderBy(F.desc("pos"))
        out = out.withColumn("advantage", F.sum("advantage").over(later.rowsBetween(Window.unboundedPreceding, 0)))
    else:
        for step in discounted_rest(rate, F.col("advantage"), along):
            out = out.withColumn("advantage", step)
    return out.withColumn("return", F.col("advantage") + F.col("value"))


def whiten(df: DataFrame, column: str = "advantage", mask: str = "mask", eps: float = 1e-8) -> DataFrame:
    """Centre and scale ``column`` over the masked rows of the whole batch; zero outside the mask.

    Token rows take many times the bytes of what they are made from, so they are not stored but made twice, for the
    moments and for the result. Both are in one plan, which shuffles their inputs once.
    """
    held = F.when(F.col(mask) == 1, F.col(column))
    moments = df.agg(F.struct(F.avg(held).alias("mean"), F.var_pop(held).alias("var")).alias("m")).scalar()
    rows = df.withColumn("_m", moments)
    scaled = (F.col(column) - F.col("_m.mean")) / F.sqrt(F.col("_m.var") + eps) * F.col(mask)
    return rows.withColumn(column, scaled).drop("_m")


def batch_loss(losses: DataFrame, batches: DataFrame, sample_key: str = "sample_id", batch_key: str = "batch_id") -> DataFrame:
    """Mean over each batch of its samples' mean losses, which count alike whatever their lengths.

    ``batches`` has one row per sample and batch that it is in; samples without a loss are not counted.
    """
    placed = batches.select(sample_key, batch_key).join(losses.select(sample_key, "loss"), sample_key)
    return placed.groupBy(batch_key).agg(F.count("loss").alias("n_samples"), F.avg("loss").alias("loss"))


def dpo_loss(df: DataFrame, beta: float = 0.15) -> DataFrame:
    """Preference margin and loss per pair from ``(pair_id, side, mask, logp_policy, logp_ref)`` tokens."""
    def total(side, column):
        return F.sum(F.when(F.col("side") == side, F.col(column) * F.col("mask")).otherwise(F.lit(0.0)))

    sums = df.groupBy("pair_id").agg(
        *[total(s, c).alias(f"{c}_{s}") for s in ("chosen", "rejected") for c in ("logp_policy", "logp_ref")]
    )
    margin = (F.col("logp_policy_chosen") - F.col("logp_policy_rejected")) - (
        F.col("logp_ref_chosen") - F.col("logp_ref_rejected")
    )
    x = beta * margin
    loss = F.log1p(F.exp(-F.abs(x))) + F.greatest(-x, F.lit(0.0))
    return sums.select("pair_id", margin.alias("margin"), loss.alias("loss"))


def masked_nll(df: DataFrame, by: list[str], logp: str = "logp_policy") -> DataFrame:
    """Mean negative log-likelihood and perplexity of predicted tokens, which exclude the first."""
    seen = df.filter((F.col("mask") == 1) & (F.col("pos") > 0))
    return seen.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_tokens"), (-F.avg(logp)).alias("nll"), F.exp(-F.avg(logp)).alias("perplexity")
    )


def _normalizers(df: DataFrame, keys: list[str], logits: dict[str, Column]) -> DataFrame:
    """Per distribution its size ``_rows`` and, per logit, the log of the summed exponentials.

    Logits are summed within bands of width 16 relative to the band's floor, which cannot overflow;
    the few bands of a distribution are then combined relative to the highest. One partial
    aggregation suffices, and no row has to wait for the maximum of its distribution.
    """
    bands = {f"_b_{n}": F.floor(x / 16) for n, x in logits.items()}
    banded = df.withColumns(bands | {f"_x_{n}": x for n, x in logits.items()})
    sums = banded.groupBy(*keys, *bands).agg(
        F.count(F.lit(1)).alias("_c"),
        *[F.sum(F.exp(F.col(f"_x_{n}") - F.col(f"_b_{n}") * 16)).alias(f"_s_{n}") for n in logits],
    )
    lists = sums.groupBy(*keys).agg(
        F.sum("_c").alias("_rows"),
        *[F.collect_list(F.struct(F.col(f"_b_{n}").alias("b"), F.col(f"_s_{n}").alias("s"))).alias(f"_l_{n}") for n in logits],
    )

    def combined(bands):
        top = F.array_max(F.transform(bands, lambda p: p["b"]))
        total = bind(
            top, lambda t: F.aggregate(bands, F.lit(0.0), lambda a, p: a + p["s"] * F.exp((p["b"] - t) * 16.0))
        )
        return F.log(total) + top * 16

    return lists.select(*keys, "_rows", *[combined(F.col(f"_l_{n}")).alias(n) for n in logits])


def token_logp(df: DataFrame, keys: list[str], taken: Column, logit: str = "logit", spread_by: list[str] = ["token"]) -> DataFrame:
    """Log-softmax of the taken tokens; only those rows meet the normalizers."""
    norms = _normalizers(df, keys, {"_lse": F.col(logit)})
    kept = attach(df.filter(taken), norms, keys, spread_by, "_rows")
    return kept.withColumn("logp", F.col(logit) - F.col("_lse")).drop("_rows", "_lse")


def softmax(df: DataFrame, keys: list[str], logits: dict[str, Column], spread_by: list[str]) -> DataFrame:
    """Add one log-probability column per entry of ``logits``."""
    norms = _normalizers(df, keys, {f"_n{n}": x for n, x in logits.items()})
    joined = attach(df, norms, keys, spread_by, "_rows")
    return joined.withColumns({n: x - F.col(f"_n{n}") for n, x in logits.items()}).drop(
        "_rows", *[f"_n{n}" for n in logits]
    )


def distribution_kl(
    df: DataFrame, keys: list[str], teacher: str = "teacher", student: str = "student", temperature: float = 1.0, spread_by: list[str] = ["token"]
) -> DataFrame:
    """Tempered divergence of the student from the teacher per distribution, scaled back by T squared."""
    t = temperature
    both = softmax(df, keys, {"_lt": F.col(teacher) / t, "_ls": F.col(student) / t}, spread_by)
    return both.groupBy(*keys).agg((t * t * F.sum(F.exp("_lt") * (F.col("_lt") - F.col("_ls")))).alias("kl"))


def blend_losses(ce: Column, kd: Column, alpha: float) -> Column:
    return alpha * ce + (1 - alpha) * kd


def top_k(df: DataFrame, keys: list[str], k: int, logit: str = "logit") -> DataFrame:
    """Candidates scoring at least the k-th best of their distribution; ties with it stay.

    Spark cuts each input partition to its own best k before the shuffle.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc(logit))
    return df.withColumn("_r", F.rank().over(order)).filter(F.col("_r") <= k).drop("_r")


def top_p(df: DataFrame, keys: list[str], p: float, logit: str = "logit", token: str = "token", min_rows: int = 200_000) -> DataFrame:
    """Best candidates until their probability exceeds ``p``; the one that crosses it still counts.

    Adds ``prob``. Running sums are taken piecewise, so large candidate sets are split.
    """
    probs = softmax(df, keys, {"_lp": F.col(logit)}, [token]).withColumn("prob", F.exp("_lp")).drop("_lp")
    placed = ordered_index(
        probs.withColumn("_down", -F.col(logit)), keys, ["_down", token], min_rows, running={"_upto": F.col("prob")}
    )
    kept = placed.filter((F.col("_upto") - F.col("prob") <= p) | (F.col("_idx") == 1))
    return kept.drop("_down", "_upto", "_idx", "_n")


def step_metrics(samples: DataFrame, by: list[str]) -> DataFrame:
    """Summary per step from per-sample ``reward``, ``advantage``, ``group_std``, ``n_tokens``, ``kl_sum`` and ``n_clipped``."""
    tokens = F.greatest(F.sum("n_tokens"), F.lit(1))
    return samples.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.avg("reward").alias("reward"),
        (F.sum("kl_sum") / tokens).alias("kl_ref"),
        F.avg("advantage").alias("advantage_mean"),
        F.stddev_samp("advantage").alias("advantage_std"),
        F.avg("n_tokens").alias("avg_response_len"),
        (F.sum("n_clipped") / tokens).alias("clip_fraction"),
        F.avg("group_std").alias("group_reward_std"),
    )
