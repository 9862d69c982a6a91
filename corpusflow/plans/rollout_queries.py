"""Queries over rollout, preference and loss analytics and run metrics.

Token log-probabilities come from add-one smoothed word frequencies: by language (policy), by
source (old policy) and overall (reference).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpusflow.functions.skew import attach
from corpusflow.functions.text import words
from corpusflow.operators import batching, metrics, rollouts
from corpusflow.plans import sqlparts as q
from corpusflow.plans.registry import query, table
from corpusflow.session import cut_lineage, discard, scratch_path, shuffles_cleared, stored
from corpusflow.sources.readers import read_parquet


_TEXT_BYTES = 2 << 20  # of the stored documents that one task takes when they are dealt out by sample,
_MOST_PARTS = 4_000  # as long as that makes no more parts than these


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").alias("sample_id"), "lang", "source", "text")


def _split(texts: DataFrame) -> DataFrame:
    return texts.select("sample_id", "lang", "source", F.posexplode(words(F.col("text"))).alias("pos", "token"))


def _words(spark: SparkSession, sf: str) -> DataFrame:
    return _split(_texts(table(spark, sf, "documents")))


def _frequencies(spark: SparkSession, sf: str, path: str) -> DataFrame:
    """One row per (lang, source, token): its count, and log-probabilities ``logps`` under three word models. Stored at ``path``."""
    # The models read these counts many times; written once, the texts are scanned once.
    counted = _words(spark, sf).groupBy("lang", "source", "token").agg(F.count(F.lit(1)).alias("c"))
    grain = stored(counted, grain_path := scratch_path(spark, "grain"))
    with shuffles_cleared(spark):
        vocab, total = grain.agg(F.count_distinct("token"), F.sum("c")).first()
    counts = grain.repartition("token")  # serves all three windows
    for keys in (["lang"], ["source"], []):
        # A token has at most one row per language and source here, so no key is hot.
        counts = counts.withColumn("_".join(["n", *keys]), F.sum("c").over(Window.partitionBy("token", *keys)))
    for key in ("lang", "source"):
        counts = counts.join(grain.groupBy(key).agg(F.sum("c").alias(f"all_{key}")), key)

    def logp(n, of):
        return F.log((F.col(n) + 1) / (of + F.lit(vocab)))

    scored = counts.select(
        "lang", "source", "token", "c",
        # One column, so that whoever reads some of the three shares a shuffle or broadcast with who reads the others.
        F.array(logp("n_lang", F.col("all_lang")), logp("n_source", F.col("all_source")), logp("n", F.lit(total))).alias("logps"),
    )
    freq = stored(scored, path)
    discard(spark, grain_path)
    return freq


def _frequent(freq: DataFrame, rows: int) -> Column:
    """The condition that holds for the most frequent tokens, ``rows`` at most."""
    rung = F.floor(F.log2("c") * 8)
    held = freq.groupBy(rung.alias("rung")).agg(F.count(F.lit(1)).alias("n")).collect()  # a few hundred at most
    least, so_far = None, 0
    for r in sorted(held, reverse=True):
        so_far += r.n
        if so_far > rows:
            break
        least = r.rung
    return F.lit(False) if least is None else rung >= least


def token_logps(spark: SparkSession, sf: str, broadcast_rows: int = 500_000, by_sample: bool = False) -> DataFrame:
    """All tokens with their log-probabilities. The most frequent ones, up to a fixed number, meet theirs where
    they are read, and so stay beside the others of their text; the rest is shuffled once and stored.

    ``by_sample`` deals out the rows by ``sample_id``: frequent tokens as whole texts, which are split where they
    arrive and take a fraction of their tokens' bytes, the others as rows. Windows and joins by sample, or by sample
    and position, then shuffle no tokens.
    """
    keys = ["lang", "source", "token"]
    freq = _frequencies(spark, sf, freq_path := scratch_path(spark, "frequencies"))
    frequent = _frequent(freq, broadcast_rows)
    common = F.broadcast(stored(freq.filter(frequent).drop("c"), scratch_path(spark, "frequent")))
    # What is less frequent than so many others has a small share of all tokens, so no key is hot.
    found = _words(spark, sf).join(common, keys, "left_anti").join(freq.filter(~frequent).hint("merge"), keys, "left")
    far = stored(found.select("sample_id", *keys, "pos", "logps"), scratch_path(spark, "rare"))
    discard(spark, freq_path)
    if by_sample:
        documents = read_parquet(spark, [f"{sf}/documents.parquet"])
        size = int(documents._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(size // _TEXT_BYTES, _MOST_PARTS))
        tokens, far = _split(_texts(documents).repartition(parts, "sample_id")), far.repartition(parts, "sample_id")
    else:
        tokens = _words(spark, sf)
    names = ("logp_policy", "logp_old", "logp_ref")
    logps = [F.get("logps", F.lit(i)).alias(n) for i, n in enumerate(names)]
    scored = tokens.join(common, keys).unionByName(far).select(*tokens.columns, *logps)
    return scored.withColumns(
        {"value": F.col("logp_policy") - F.col("logp_ref"), "mask": (F.col("pos") % 7 != 3).cast("int")}
    )


_TOKENS = f"""tok AS (
  SELECT doc_id AS sample_id, lang, source, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos
  FROM (SELECT *, regexp_extract_all(text, '{q.WORD}') AS w FROM documents)),
grain AS (SELECT lang, source, token, count(*) AS c FROM tok GROUP BY ALL),
sized AS (SELECT *, sum(c) OVER (PARTITION BY lang, token) AS cl, sum(c) OVER (PARTITION BY source, token) AS cs,
  sum(c) OVER (PARTITION BY token) AS ca, sum(c) OVER (PARTITION BY lang) AS nl, sum(c) OVER (PARTITION BY source) AS ns,
  sum(c) OVER () AS na, (SELECT count(DISTINCT token) FROM grain) AS v FROM grain),
freq AS (SELECT lang, source, token, c, ln((cl + 1) / (nl + v)) AS lp, ln((cs + 1) / (ns + v)) AS lo, ln((ca + 1) / (na + v)) AS lr FROM sized),
tl AS (SELECT t.*, lp, lo, lr, lp - lr AS value, (pos % 7 <> 3)::INTEGER AS m FROM tok t JOIN freq USING (lang, source, token))"""

_REWARD = "n_chars / 1000.0"


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("sample_id"), "lang", "source", (F.col("n_chars") / 1000.0).alias("reward")
    )


_ADVANTAGE = f"""adv AS (
  SELECT doc_id AS sample_id, lang, source, {_REWARD} AS reward, stddev_pop({_REWARD}) OVER g AS group_std,
    ({_REWARD} - avg({_REWARD}) OVER g) / (stddev_pop({_REWARD}) OVER g + 0.0001) AS advantage
  FROM documents WINDOW g AS (PARTITION BY lang, source))"""


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) + 0.0 for n in names})


@query(
    "group_advantage",
    f"WITH {_ADVANTAGE} SELECT sample_id, round(group_std, 6) AS group_std, round(advantage, 6) + 0.0 AS advantage FROM adv",
)
def group_advantage(spark, sf):
    scored = rollouts.group_advantage(_samples(spark, sf), ["lang", "source"])
    return _rounded(scored, "group_std", "advantage").select("sample_id", "group_std", "advantage")


@query(
    "group_reward_stats",
    """SELECT user_id, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std_pop, round(stddev_samp(value), 6) AS std_samp
FROM events GROUP BY user_id""",
)
def group_reward_stats(spark, sf):
    stats = table(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std_pop"), F.stddev_samp("value").alias("std_samp"),
    )
    return _rounded(stats, "mean", "std_pop", "std_samp")


def _lengths(spark: SparkSession, sf: str) -> DataFrame:
    """Word lengths stand for token ids."""
    ids = F.transform(words(F.col("text")), F.length)
    return table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"), "lang", ids.alias("ids"))


_IDS = f"""l AS (SELECT doc_id AS sample_id, lang, [length(w)::INTEGER FOR w IN regexp_extract_all(text, '{q.WORD}')] AS ids FROM documents)"""


@query(
    "completion_mask",
    f"""WITH {_IDS}, e AS (SELECT sample_id, unnest(ids) AS x, generate_subscripts(ids, 1) AS p, greatest(len(ids) - 2, 1) AS valid FROM l),
f AS (SELECT *, min(p) FILTER (x = 9 AND p <= valid) OVER (PARTITION BY sample_id) AS stop FROM e),
g AS (SELECT sample_id, count(*)::INTEGER AS n_ids, count(*) FILTER (p <= valid AND p <= coalesce(stop, 1000000000)) AS n_valid FROM f GROUP BY sample_id)
SELECT sample_id, coalesce(n_ids, 0)::INTEGER AS n_ids, coalesce(n_valid, 0)::BIGINT AS n_valid FROM l LEFT JOIN g USING (sample_id)""",
)
def completion_mask(spark, sf):
    size = F.size("ids")
    valid = F.greatest(size - 2, F.lit(1))
    pad = F.transform("ids", lambda x, i: (i < valid).cast("int"))
    mask = rollouts.completion_mask(F.col("ids"), 9, pad)
    total = F.aggregate(mask, F.lit(0).cast("long"), lambda a, x: a + x)
    return _lengths(spark, sf).select("sample_id", F.size(mask).alias("n_ids"), total.alias("n_valid"))


@query(
    "pack_rollouts",
    f"""WITH {_IDS},
r AS (SELECT sample_id, lang, ids[1:40] AS p, ids[41:] AS r FROM l),
k AS (SELECT sample_id, lang, list_concat(p, r) AS x, list_concat([0 FOR i IN p], [i % 2 FOR i IN r]) AS m,
  list_concat([0.0::DOUBLE FOR i IN p[2:]], [i * -0.25 FOR i IN r]) AS lp FROM r),
c AS (SELECT sample_id, lang, x[greatest(len(x) - 299, 1):] AS x, m[greatest(len(m) - 299, 1):] AS m,
  CASE WHEN len(x) > 300 THEN lp[greatest(len(lp) - 298, 1):] ELSE lp END AS lp FROM k),
b AS (SELECT *, max(len(x)) OVER (PARTITION BY lang) AS longest FROM c)
SELECT sample_id, len(x)::INTEGER AS seq_len, (coalesce(list_position(m, 1), len(m) + 1) - 1)::INTEGER AS prompt_len,
  md5(array_to_string(list_resize(x, longest, 0), ',')) AS ids_md5, md5(array_to_string(list_resize(m, longest, 0), ',')) AS mask_md5,
  greatest(len(lp), longest - 1)::INTEGER AS n_logps, round(coalesce(list_sum(lp), 0), 4)::DOUBLE AS logp_sum FROM b""",
)
def pack_rollouts(spark, sf):
    response = F.slice("ids", F.lit(41), F.greatest(F.size("ids") - 40, F.lit(0)))
    rows = _lengths(spark, sf).select(
        "sample_id", "lang", F.slice("ids", 1, 40).alias("prompt_ids"), response.alias("response_ids"),
        F.transform(response, lambda i: (i % 2).cast("int")).alias("response_mask"),
        F.transform(response, lambda i: i * -0.25).cast("array<double>").alias("response_logps"),
    )
    packed = rollouts.pack_rollouts(rows, ["lang"], 300)
    return packed.select(
        "sample_id", "seq_len", F.col("prompt_len").cast("int").alias("prompt_len"),
        F.md5(F.array_join("input_ids", ",")).alias("ids_md5"), F.md5(F.array_join("mask", ",")).alias("mask_md5"),
        F.size("old_logps").alias("n_logps"),
        (F.round(F.aggregate("old_logps", F.lit(0.0), lambda a, x: a + x), 4) + 0.0).alias("logp_sum"),
    )


@query(
    "align_logps",
    f"""WITH {_IDS}, a AS (SELECT sample_id, ids, CASE sample_id % 3 WHEN 0 THEN ids[4:] WHEN 1 THEN list_concat([1, 2], ids) ELSE ids END AS lp FROM l)
SELECT sample_id, md5(array_to_string(CASE WHEN len(lp) < len(ids) THEN list_concat([0 FOR i IN range(len(ids) - len(lp))], lp)
  ELSE lp[len(lp) - len(ids) + 1:] END, ',')) AS logps_md5 FROM a""",
)
def align_logps(spark, sf):
    ids = F.col("ids")
    kind = F.col("sample_id") % 3
    given = F.when(kind == 0, F.slice(ids, F.lit(4), F.greatest(F.size(ids) - 3, F.lit(0)))).when(
        kind == 1, F.concat(F.array(F.lit(1), F.lit(2)), ids)
    ).otherwise(ids)
    aligned = rollouts.align_logps(ids, given.cast("array<double>"))
    shown = F.array_join(F.transform(aligned, lambda x: x.cast("long")), ",")
    return _lengths(spark, sf).select("sample_id", F.md5(shown).alias("logps_md5"))


_K3 = "(exp(lr - lp) - (lr - lp) - 1)"
_M = "greatest(sum(m), 1)"


@query(
    "kl_terms",
    f"""WITH {_TOKENS} SELECT lang, source, sum(m)::BIGINT AS n_tokens, round(sum({_K3} * m) / {_M}, 6) + 0.0 AS kl_k3,
  round(sum((lr - lp) * m) / {_M}, 6) + 0.0 AS kl_ref, round(sum(0.5 * (lp - lo) ** 2 * m) / {_M}, 6) + 0.0 AS approx_kl
FROM tl GROUP BY lang, source""",
)
def kl_terms(spark, sf):
    return _rounded(rollouts.kl_terms(token_logps(spark, sf), ["lang", "source"]), "kl_k3", "kl_ref", "approx_kl")


@query(
    "join_logps",
    f"WITH {_TOKENS} SELECT sample_id, count(*) AS n, round(sum(lp), 5) AS policy, round(sum(lo), 5) AS old, round(sum(lr), 5) AS ref FROM tl GROUP BY sample_id",
)
def join_logps(spark, sf):
    tokens = token_logps(spark, sf, by_sample=True)
    parts = [tokens.select("sample_id", "pos", F.col(c).alias("logp")) for c in ("logp_policy", "logp_old", "logp_ref")]
    sums = rollouts.join_logps(*parts).groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("logp_policy").alias("policy"), F.sum("logp_old").alias("old"), F.sum("logp_ref").alias("ref")
    )
    return _rounded(sums, "policy", "old", "ref", digits=5)


def _surrogate_sql(gain: str) -> str:
    return f"""WITH {_TOKENS}, {_ADVANTAGE},
l AS (SELECT sample_id, m, -({gain} - 0.1 * {_K3}) AS x FROM tl JOIN adv USING (sample_id))
SELECT sample_id, sum(m)::BIGINT AS n_tokens, round(sum(x * m) / {_M}, 5) + 0.0 AS loss FROM l GROUP BY sample_id"""


_RATIO = "exp(lp - lo)"


def _surrogate(spark, sf, kind):
    scored = rollouts.group_advantage(_samples(spark, sf), ["lang", "source"])
    return _rounded(rollouts.surrogate(token_logps(spark, sf), scored, kind), "loss", digits=5)


_GRPO = f"least({_RATIO} * advantage, greatest(least({_RATIO}, 1.2), 0.8) * advantage)"
_CISPO = f"least({_RATIO}, 5.0) * advantage * lp"


@query("surrogate_grpo", _surrogate_sql(_GRPO))
def surrogate_grpo(spark, sf):
    return _surrogate(spark, sf, "grpo")


@query("surrogate_cispo", _surrogate_sql(_CISPO))
def surrogate_cispo(spark, sf):
    return _surrogate(spark, sf, "cispo")


def _batch_sql(gain: str) -> str:
    """Losses per sample first, then their mean per batch of the shuffled samples."""
    return f"""WITH {_TOKENS}, {_ADVANTAGE},
l AS (SELECT sample_id, m, -({gain} - 0.1 * {_K3}) AS x FROM tl JOIN adv USING (sample_id)),
s AS (SELECT sample_id, sum(x * m) / {_M} AS loss FROM l GROUP BY sample_id),
b AS (SELECT doc_id AS sample_id, (row_number() OVER (ORDER BY md5('42:0:' || doc_id), doc_id) - 1) // 32 AS batch_id FROM documents)
SELECT batch_id, count(*) AS n_samples, round(avg(loss), 5) + 0.0 AS loss FROM s JOIN b USING (sample_id) GROUP BY batch_id"""


def _surrogate_batches(spark, sf, kind):
    scored = rollouts.group_advantage(_samples(spark, sf), ["lang", "source"])
    samples = table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"))
    batches = batching.plan_batches(samples, 42, 0, 32, key="sample_id")
    return _rounded(rollouts.batch_loss(rollouts.surrogate(token_logps(spark, sf), scored, kind), batches), "loss", digits=5)


@query("surrogate_grpo_batches", _batch_sql(_GRPO))
def surrogate_grpo_batches(spark, sf):
    return _surrogate_batches(spark, sf, "grpo")


@query("surrogate_cispo_batches", _batch_sql(_CISPO))
def surrogate_cispo_batches(spark, sf):
    return _surrogate_batches(spark, sf, "cispo")


def _rewarded(spark: SparkSession, sf: str) -> DataFrame:
    return rollouts.place_reward(token_logps(spark, sf, by_sample=True), _samples(spark, sf))


_PLACED = f"""placed AS (
  SELECT tl.*, CASE WHEN pos = max(pos) FILTER (m = 1) OVER (PARTITION BY sample_id) THEN {_REWARD} ELSE 0 END AS r
  FROM tl JOIN documents d ON d.doc_id = tl.sample_id)"""
# At this size the longest text has few enough words that the powers stay in range.
_GAE = f"""{_PLACED},
delta AS (SELECT *, r + coalesce(lead(value) OVER w, 0) - value AS d FROM placed WINDOW w AS (PARTITION BY sample_id ORDER BY pos)),
gae AS (SELECT *, sum(d * 0.95 ** pos) OVER w / 0.95 ** pos AS a FROM delta
  WINDOW w AS (PARTITION BY sample_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query(
    "place_reward",
    f"WITH {_TOKENS}, {_PLACED} SELECT sample_id, pos::INTEGER AS pos, round(r, 6)::DOUBLE AS token_reward FROM placed WHERE r <> 0",
)
def place_reward(spark, sf):
    return _rounded(_rewarded(spark, sf), "token_reward").filter("token_reward <> 0").select("sample_id", "pos", "token_reward")


@query(
    "gae",
    f"WITH {_TOKENS}, {_GAE} SELECT sample_id, pos::INTEGER AS pos, round(a, 5) + 0.0 AS advantage, round(a + value, 5) + 0.0 AS \"return\" FROM gae",
)
def gae(spark, sf):
    out = rollouts.gae(_rewarded(spark, sf))
    return _rounded(out, "advantage", "return", digits=5).select("sample_id", "pos", "advantage", "return")


@query(
    "gae_discounts",
    f"""WITH {_TOKENS}, {_PLACED},
delta AS (SELECT *, r + coalesce(lead(value) OVER w, 0) - value AS d FROM placed WINDOW w AS (PARTITION BY sample_id ORDER BY pos)),
s AS (SELECT sample_id, pos, d, sum(d) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS d1,
  {" + ".join(f"coalesce(lead(d, {k}) OVER w, 0) * 0.01::DOUBLE ** {k}" for k in range(9))} AS d01
  FROM delta WINDOW w AS (PARTITION BY sample_id ORDER BY pos))
SELECT sample_id, pos::INTEGER AS pos, lam::DOUBLE AS lam, round(CASE lam WHEN 0 THEN d WHEN 1 THEN d1 ELSE d01 END, 5) + 0.0 AS advantage
FROM s, (VALUES (0.0), (0.01), (1.0)) t(lam)""",
)
def gae_discounts(spark, sf):
    """Discounts at and near the ends, where powers vanish or don't fall at all."""
    paid = cut_lineage(_rewarded(spark, sf).select("sample_id", "pos", "token_reward", "value"))
    outs = [rollouts.gae(paid, lam=lam).withColumn("lam", F.lit(lam)) for lam in (0.0, 0.01, 1.0)]
    every = outs[0].unionByName(outs[1]).unionByName(outs[2])
    return _rounded(every, "advantage", digits=5).select("sample_id", "pos", "lam", "advantage")


@query(
    "whiten_advantages",
    f"""WITH {_TOKENS}, {_GAE}, mo AS (SELECT avg(a) FILTER (m = 1) AS mu, var_pop(a) FILTER (m = 1) AS v FROM gae)
SELECT sample_id, count(*) AS n, round(sum((a - mu) / sqrt(v + 1e-8) * m), 4) + 0.0 AS total FROM gae, mo GROUP BY sample_id""",
)
def whiten_advantages(spark, sf):
    white = rollouts.whiten(rollouts.gae(_rewarded(spark, sf)))
    sums = white.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.sum("advantage").alias("total"))
    return _rounded(sums, "total", digits=4)


@query(
    "ppo_terms",
    f"""WITH {_TOKENS}, {_GAE},
p AS (SELECT lang, m, a, a + value AS ret, lp, lo, lr, {_RATIO} AS ra, value, value * 0.9 AS vo FROM gae)
SELECT lang, round(sum(greatest(-a * ra, -a * greatest(least(ra, 1.2), 0.8)) * m) / {_M} + 0.02 * sum({_K3} * m) / {_M}, 4) + 0.0 AS policy_loss,
  round(0.5 * sum(greatest((value - ret) ** 2, (greatest(least(value, vo + 0.2), vo - 0.2) - ret) ** 2) * m) / {_M}, 4) + 0.0 AS value_loss,
  round(sum((abs(ra - 1) > 0.2)::INTEGER * m) / {_M}, 6) + 0.0 AS clip_fraction,
  round(sum(0.5 * (lp - lo) ** 2 * m) / {_M}, 6) + 0.0 AS approx_kl FROM p GROUP BY lang""",
)
def ppo_terms(spark, sf):
    rows = rollouts.gae(_rewarded(spark, sf)).withColumn("value_old", F.col("value") * 0.9)
    terms = rollouts.ppo_terms(rows, ["lang"])
    return _rounded(_rounded(terms, "policy_loss", "value_loss", digits=4), "clip_fraction", "approx_kl")


@query(
    "dpo_loss",
    f"""WITH {_TOKENS}, s AS (SELECT sample_id // 2 AS pair_id,
  sum(CASE WHEN sample_id % 2 = 0 THEN lp * m ELSE -lp * m END) - sum(CASE WHEN sample_id % 2 = 0 THEN lr * m ELSE -lr * m END) AS margin
  FROM tl GROUP BY 1)
SELECT pair_id, round(margin, 5) + 0.0 AS margin, round(ln(1 + exp(-abs(0.15 * margin))) + greatest(-0.15 * margin, 0), 5) + 0.0 AS loss FROM s""",
)
def dpo_loss(spark, sf):
    even = F.col("sample_id") % 2 == 0
    sided = token_logps(spark, sf).withColumns(
        {"pair_id": F.floor(F.col("sample_id") / 2), "side": F.when(even, "chosen").otherwise("rejected")}
    )
    return _rounded(rollouts.dpo_loss(sided), "margin", "loss", digits=5)


@query(
    "masked_nll",
    f"""WITH {_TOKENS} SELECT lang, count(*) AS n_tokens, round(-avg(lp), 6) AS nll, round(exp(-avg(lp)), 4) AS perplexity
FROM tl WHERE m = 1 AND pos > 0 GROUP BY lang""",
)
def masked_nll(spark, sf):
    nll = rollouts.masked_nll(token_logps(spark, sf), ["lang"])
    return _rounded(_rounded(nll, "nll"), "perplexity", digits=4)


def _logits(spark: SparkSession, sf: str) -> DataFrame:
    grain = _words(spark, sf).groupBy("lang", "source", "token").agg(F.count(F.lit(1)).alias("c"))
    return grain.select("lang", "source", "token", F.log("c").alias("logit"))


@query(
    "token_logp",
    f"""WITH {_TOKENS} SELECT lang, source, token, round(ln(c) - ln(n), 6) + 0.0 AS logp
FROM (SELECT *, sum(c) OVER (PARTITION BY lang, source) AS n FROM grain) WHERE length(token) = 5""",
)
def token_logp(spark, sf):
    taken = rollouts.token_logp(_logits(spark, sf), ["lang", "source"], F.length("token") == 5)
    return _rounded(taken, "logp").select("lang", "source", "token", "logp")


@query(
    "distribution_kl",
    f"""WITH {_TOKENS},
t AS (SELECT source, token, sum(c) AS s, any_value(ca) AS te FROM sized GROUP BY ALL),
p AS (SELECT source, sqrt(te) / sum(sqrt(te)) OVER g AS pt, sqrt(s) / sum(sqrt(s)) OVER g AS ps FROM t WINDOW g AS (PARTITION BY source)),
k AS (SELECT source, 4 * sum(pt * (ln(pt) - ln(ps))) AS kl FROM p GROUP BY source)
SELECT source, round(kl, 6) + 0.0 AS kl, round(0.3 * 2.0 + 0.7 * kl, 6) + 0.0 AS blended FROM k""",
)
def distribution_kl(spark, sf):
    grain = _words(spark, sf).groupBy("source", "token").agg(F.count(F.lit(1)).alias("c"))
    overall = grain.groupBy("token").agg(F.sum("c").alias("ca"), F.count(F.lit(1)).alias("rows"))
    both = attach(grain, overall, ["token"], ["source"], "rows").select(
        "source", "token", F.log("c").alias("student"), F.log("ca").alias("teacher")
    )
    kl = rollouts.distribution_kl(both, ["source"], temperature=2.0)
    blended = rollouts.blend_losses(F.lit(2.0), F.col("kl"), 0.3)
    return _rounded(kl.withColumn("blended", blended), "kl", "blended")


_TEMPERED = """scored AS (SELECT lang, token, sum(c) AS c, ln(sum(c)) / 0.85 AS logit FROM grain GROUP BY ALL),
topk AS (SELECT * FROM scored QUALIFY rank() OVER (PARTITION BY lang ORDER BY c DESC) <= 50)"""


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    counts = _words(spark, sf).groupBy("lang", "token").agg(F.count(F.lit(1)).alias("c"))
    return counts.select("lang", "token", (F.log("c") / 0.85).alias("logit"))


@query("top_k", f"WITH {_TOKENS}, {_TEMPERED} SELECT lang, token, round(logit, 6) AS logit FROM topk")
def top_k(spark, sf):
    return _rounded(rollouts.top_k(_candidates(spark, sf), ["lang"], 50), "logit")


@query(
    "top_p",
    f"""WITH {_TOKENS}, {_TEMPERED},
p AS (SELECT *, exp(logit) / sum(exp(logit)) OVER (PARTITION BY lang) AS prob FROM topk),
u AS (SELECT *, sum(prob) OVER w - prob AS before, row_number() OVER w AS rn FROM p
  WINDOW w AS (PARTITION BY lang ORDER BY c DESC, token ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT lang, token, round(prob, 6) AS prob FROM u WHERE before <= 0.85 OR rn = 1""",
)
def top_p(spark, sf):
    best = rollouts.top_k(_candidates(spark, sf), ["lang"], 50)
    return _rounded(rollouts.top_p(best, ["lang"], 0.85), "prob").select("lang", "token", "prob")


@query(
    "top_p_all",
    f"""WITH {_TOKENS}, {_TEMPERED},
p AS (SELECT *, exp(logit) / sum(exp(logit)) OVER (PARTITION BY lang) AS prob FROM scored),
u AS (SELECT *, sum(prob) OVER w - prob AS before, row_number() OVER w AS rn FROM p
  WINDOW w AS (PARTITION BY lang ORDER BY c DESC, token ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT lang, token, round(prob, 6) AS prob FROM u WHERE before <= 0.85 OR rn = 1""",
)
def top_p_all(spark, sf):
    """Over all candidates, many of which have equal logits."""
    return _rounded(rollouts.top_p(_candidates(spark, sf), ["lang"], 0.85), "prob").select("lang", "token", "prob")


@query(
    "step_metrics",
    f"""WITH {_TOKENS}, {_ADVANTAGE},
s AS (SELECT sample_id, sum(m) AS n_tokens, sum((lr - lp) * m) AS kl_sum, sum((abs({_RATIO} - 1) > 0.2)::INTEGER * m) AS n_clipped FROM tl GROUP BY 1)
SELECT lang, count(*) AS n_samples, round(avg(reward), 6)::DOUBLE AS reward, round(sum(kl_sum) / sum(n_tokens), 6) AS kl_ref,
  round(avg(advantage), 6) + 0.0 AS advantage_mean, round(stddev_samp(advantage), 6) AS advantage_std, round(avg(n_tokens), 6) AS avg_response_len,
  round(sum(n_clipped) / sum(n_tokens), 6) AS clip_fraction, round(avg(group_std), 6) AS group_reward_std
FROM s JOIN adv USING (sample_id) GROUP BY lang""",
)
def step_metrics(spark, sf):
    p, o, r, m = (F.col(c) for c in ("logp_policy", "logp_old", "logp_ref", "mask"))
    sums = token_logps(spark, sf).groupBy("sample_id").agg(
        F.sum(m).alias("n_tokens"), F.sum((r - p) * m).alias("kl_sum"),
        F.sum((F.abs(F.exp(p - o) - 1) > 0.2).cast("int") * m).alias("n_clipped"),
    )
    samples = rollouts.group_advantage(_samples(spark, sf), ["lang", "source"]).join(sums, "sample_id")
    summary = rollouts.step_metrics(samples, ["lang"])
    return _rounded(summary, *[c for c in summary.columns if c not in ("lang", "n_samples")])


# ---- run metrics -----------------------------------------------------------------------------


@query(
    "smooth_metrics",
    """WITH s AS (SELECT event_type AS metric, event_id, value, row_number() OVER w AS step, count(*) OVER (PARTITION BY event_type) AS n,
  list(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS near
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))
SELECT metric, event_id, step, CASE WHEN n > 10 THEN round(list_avg(near[greatest(len(near) - least(20, n // 3) + 1, 1):]), 6) END AS smooth FROM s""",
)
def smooth_metrics(spark, sf):
    rows = table(spark, sf, "events").withColumn("metric", F.col("event_type"))
    smoothed = metrics.smooth(rows, ["metric"], ["ts", "event_id"])
    return smoothed.select("metric", "event_id", F.col("step").cast("long").alias("step"), F.round("smooth", 6).alias("smooth"))


@query(
    "latest_metrics",
    "SELECT event_type AS metric, count(*) AS n_records, arg_max(value, ts) AS latest FROM events GROUP BY 1",
)
def latest_metrics(spark, sf):
    rows = table(spark, sf, "events").withColumn("metric", F.col("event_type"))
    return metrics.latest(rows, ["metric"], ["ts", "event_id"])


@query(
    "melt_metrics",
    """SELECT step, metric, value FROM (SELECT l_orderkey * 10 + l_linenumber AS step, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
UNPIVOT (value FOR metric IN (l_quantity, l_extendedprice, l_discount, l_tax))""",
)
def melt_metrics(spark, sf):
    step = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("step")
    wide = table(spark, sf, "lineitem").select(step, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    return metrics.melt_metrics(wide, ["step"])


@query(
    "throughput",
    """WITH s AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS t, row_number() OVER w AS step, value,
  epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER w AS gap, min(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id) AS start
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, step, CASE WHEN gap > 0 THEN round(value / gap, 6) END AS tokens_per_s,
  greatest(floor((t - start) / greatest(step - 1, 1) * (100000 - step) / 60), 0)::BIGINT AS minutes_left FROM s""",
)
def throughput(spark, sf):
    rows = table(spark, sf, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    timed = metrics.throughput(rows, ["user_id"], ["ts", "event_id"], "t", "value", 100_000)
    return timed.select(
        "user_id", "event_id", F.col("step").cast("long").alias("step"),
        F.round("tokens_per_s", 6).alias("tokens_per_s"), F.col("minutes_left").cast("long").alias("minutes_left"),
    )
