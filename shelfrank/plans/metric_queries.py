"""Queries over metrics, distances, bandit scores, n-grams and neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfrank import views
from shelfrank.config import DEFAULTS
from shelfrank.operators import distances, metrics, neighbours, ngram, sequences
from shelfrank.operators.ordinal import top_ranked
from shelfrank.plans.recommenders import UCB, Popularity, SequenceKnn
from shelfrank.plans.registry import query, sql
from shelfrank.plans.table_queries import recent_sql

K = DEFAULTS.k


def _scored_log(spark, d):
    """The log as a list to be judged: the price is the score."""
    return views.priced_log(spark, d).withColumn("relevance", F.col("price"))


def _tie_order():
    return [F.col(c) for c in ("item_idx", "ts", "order_id", "line_no", "paid")]


def ranked_log(spark, d):
    """Every interaction ranked within its user by price."""
    return metrics.rank_all(_scored_log(spark, d), "relevance", _tie_order())


def ranked_head(spark, d, k: int = K):
    """The first ``k`` ranks only; map tasks keep no more than that per user."""
    return top_ranked(_scored_log(spark, d), "user_idx", [F.col("relevance").desc(), *_tie_order()], k)


RANKED = """ranked AS (SELECT user_idx, item_idx, response, price AS relevance, revenue, order_id, line_no, row_number() OVER (
  PARTITION BY user_idx ORDER BY price DESC, item_idx, ts, order_id, line_no, paid) AS rank FROM log),
top AS (SELECT * FROM ranked WHERE rank <= 5),
ndcg_users AS (SELECT user_idx, sum(response / log2(rank + 1)) AS dcg, sum(response / log2(ideal + 1)) AS idcg FROM (
  SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY response DESC, rank) AS ideal FROM top) GROUP BY 1)"""


def _rounded(df, digits: int = 6):
    doubles = {name: F.round(name, digits) for name, kind in df.dtypes if kind == "double"}
    return df.withColumns(doubles)


@query("rank_per_user", sql("SELECT user_idx, item_idx, order_id, line_no, rank::BIGINT AS rank FROM ranked", RANKED))
def rank_per_user(spark, d):
    return ranked_log(spark, d).select("user_idx", "item_idx", "order_id", "line_no", "rank")


@query("topk_per_user", sql("SELECT user_idx, item_idx, relevance, rank::BIGINT AS rank FROM top", RANKED))
def topk_per_user(spark, d):
    return ranked_head(spark, d).select("user_idx", "item_idx", "relevance", F.col("rank").cast("long").alias("rank"))


@query("total_revenue", sql("SELECT round(sum(revenue), 4) AS total_revenue FROM log"))
def total_revenue(spark, d):
    return _rounded(metrics.total_revenue(views.priced_log(spark, d)), 4)


@query("precision_at_k", sql("SELECT round(avg(p), 6) AS precision_at_k FROM (SELECT avg(response) AS p FROM top GROUP BY user_idx)", RANKED))
def precision_at_k(spark, d):
    return _rounded(metrics.precision_at_k(ranked_head(spark, d), K))


@query("ndcg_at_k", sql("SELECT round(avg(dcg / idcg), 6) AS ndcg_at_k FROM ndcg_users WHERE idcg > 0", RANKED))
def ndcg_at_k(spark, d):
    return _rounded(metrics.ndcg_at_k(ranked_head(spark, d), K))


_MRR = "(SELECT user_idx, coalesce(1 / min(rank) FILTER (WHERE response > 0), 0) AS rr FROM ranked GROUP BY 1)"


@query("mrr", sql(f"SELECT round(avg(rr), 6) AS mrr FROM {_MRR}", RANKED))
def mrr(spark, d):
    return _rounded(metrics.mrr(ranked_log(spark, d)))


@query("hit_rate", sql("SELECT round(avg(h), 6) AS hit_rate FROM (SELECT max(response) AS h FROM top GROUP BY user_idx)", RANKED))
def hit_rate(spark, d):
    return _rounded(metrics.hit_rate(ranked_head(spark, d), K))


@query("discounted_revenue", sql("SELECT round(sum(revenue / log2(rank + 1)), 4) AS discounted_revenue FROM top", RANKED))
def discounted_revenue(spark, d):
    return _rounded(metrics.discounted_revenue(ranked_head(spark, d), K), 4)


@query("conversion_rate", sql("SELECT round(avg(response), 6) AS conversion_rate FROM log"))
def conversion_rate(spark, d):
    return _rounded(metrics.conversion_rate(views.interactions(spark, d)))


@query(
    "recall_at_k",
    sql(
        """SELECT round(avg(hits / n), 6) AS recall_at_k FROM (SELECT sum(response) AS n,
        sum(CASE WHEN rank <= 5 THEN response ELSE 0 END) AS hits FROM ranked GROUP BY user_idx) WHERE n > 0""",
        RANKED,
    ),
)
def recall_at_k(spark, d):
    relevant = (
        views.interactions(spark, d)
        .groupBy("user_idx")
        .agg(F.sum(F.when(F.col("response") > 0, 1).otherwise(0)).alias("n"))
    )
    return _rounded(metrics.recall_at_k(ranked_head(spark, d), K, relevant))


@query(
    "ranking_metrics",
    sql(
        f"""SELECT round((SELECT avg(p) FROM (SELECT avg(response) AS p FROM top GROUP BY user_idx)), 6) AS precision_at_k,
        round((SELECT avg(dcg / idcg) FROM ndcg_users WHERE idcg > 0), 6) AS ndcg_at_k,
        round((SELECT avg(rr) FROM {_MRR}), 6) AS mrr,
        round((SELECT avg(h) FROM (SELECT max(response) AS h FROM top GROUP BY user_idx)), 6) AS hit_rate,
        round((SELECT sum(revenue / log2(rank + 1)) FROM top), 3) AS discounted_revenue,
        round((SELECT sum(revenue) FROM log), 3) AS revenue, round((SELECT avg(response) FROM log), 6) AS conversion_rate""",
        RANKED,
    ),
)
def ranking_metrics(spark, d):
    row = metrics.ranking_metrics(ranked_log(spark, d), K)
    return _rounded(row).withColumns(
        {"discounted_revenue": F.round("discounted_revenue", 3), "revenue": F.round("revenue", 3)}
    )


@query(
    "geometric_dcg",
    sql(
        "SELECT round(avg(g), 4) AS geometric_dcg FROM (SELECT sum(relevance * power(0.85, rank - 1)) AS g FROM top GROUP BY user_idx)",
        RANKED,
    ),
)
def geometric_dcg(spark, d):
    return _rounded(metrics.geometric_dcg(ranked_head(spark, d), K, DEFAULTS.dcg_gamma), 4)


# A prediction to judge: the item's share of positive responses.
_PREDICTED = """rates AS (SELECT item_idx, round(avg(response), 6) AS score FROM log GROUP BY 1),
predicted AS (SELECT score, response, CASE WHEN score >= 0.7 THEN 1 ELSE 0 END AS said FROM log JOIN rates USING (item_idx))"""


def _predicted(spark, d):
    log = views.interactions(spark, d).select("item_idx", "response")
    rates = log.groupBy("item_idx").agg(F.round(F.avg("response"), 6).alias("score"))
    joined = log.join(rates, "item_idx")
    return joined.withColumn("said", F.when(F.col("score") >= 0.7, 1).otherwise(0))


@query(
    "regression_metrics",
    sql(
        """SELECT round(sqrt(avg((response - score) ** 2)), 6) AS rmse, round(avg((response - score) ** 2), 6) AS mse,
        round(1 - sum((response - score) ** 2) / sum((response - (SELECT avg(response) FROM log)) ** 2), 6) AS r2,
        round(avg(abs(response - score)), 6) AS mae, round(avg((score - (SELECT avg(response) FROM log)) ** 2), 6) AS var FROM predicted""",
        _PREDICTED,
    ),
)
def regression_metrics(spark, d):
    return _rounded(metrics.regression_metrics(_predicted(spark, d), "score", "response"))


_CURVE = """groups AS (SELECT score, sum(response) AS pos, sum(1 - response) AS neg FROM predicted GROUP BY 1),
curve AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cum_pos, sum(neg) OVER (ORDER BY score DESC) AS cum_neg FROM groups)"""


@query(
    "auc_roc",
    sql("SELECT round(sum(neg * (cum_pos - pos / 2)) / (sum(pos) * sum(neg)), 6) AS auc_roc FROM curve", _PREDICTED, _CURVE),
)
def auc_roc(spark, d):
    return _rounded(metrics.auc_roc(_predicted(spark, d), "score", "response"))


@query(
    "auc_pr",
    sql(
        """SELECT round(sum(pos * (cum_pos / (cum_pos + cum_neg) + CASE WHEN cum_pos - pos + cum_neg - neg > 0
        THEN (cum_pos - pos) / (cum_pos - pos + cum_neg - neg) ELSE cum_pos / (cum_pos + cum_neg) END) / 2) / sum(pos), 6) AS auc_pr FROM curve""",
        _PREDICTED,
        _CURVE,
    ),
)
def auc_pr(spark, d):
    return _rounded(metrics.auc_pr(_predicted(spark, d), "score", "response"))


@query(
    "multiclass_metrics",
    sql(
        """SELECT round(sum(w * f), 6) AS f1, round(any_value(acc), 6) AS accuracy, round(sum(w * prec), 6) AS weighted_precision,
        round(sum(w * rec), 6) AS weighted_recall, round(sum(w * rec), 6) AS weighted_tpr, round(sum(w * fpr), 6) AS weighted_fpr,
        round(sum(w * f), 6) AS weighted_f_measure, round(max(rec) FILTER (WHERE c = 0), 6) AS tpr_by_label,
        round(max(fpr) FILTER (WHERE c = 0), 6) AS fpr_by_label, round(max(prec) FILTER (WHERE c = 0), 6) AS precision_by_label,
        round(max(rec) FILTER (WHERE c = 0), 6) AS recall_by_label, round(max(f) FILTER (WHERE c = 0), 6) AS f_measure_by_label,
        round(1 - any_value(acc), 6) AS hamming_loss,
        round((SELECT avg(-ln(greatest(1e-15, least(1 - 1e-15, CASE WHEN response = 1 THEN score ELSE 1 - score END)))) FROM predicted), 6) AS log_loss
        FROM (SELECT *, 2 * prec * rec / (prec + rec) AS f FROM (
          SELECT c, actual / n AS w, tp / said AS prec, tp / actual AS rec, (said - tp) / (n - actual) AS fpr, acc FROM (
            SELECT c, (SELECT count(*) FROM predicted) AS n, (SELECT count(*) FROM predicted WHERE response = c) AS actual,
            (SELECT count(*) FROM predicted p WHERE p.said = c) AS said, (SELECT count(*) FROM predicted p WHERE p.said = c AND response = c) AS tp,
            (SELECT avg(CASE WHEN p.said = response THEN 1 ELSE 0 END) FROM predicted p) AS acc FROM (SELECT unnest([0, 1]) AS c))))""",
        _PREDICTED,
    ),
)
def multiclass_metrics(spark, d):
    judged = _predicted(spark, d).withColumn(
        "p_true", F.when(F.col("response") == 1, F.col("score")).otherwise(1 - F.col("score"))
    )
    return _rounded(metrics.multiclass_metrics(judged, "said", "response", "p_true"))


@query(
    "ks_statistic",
    sql(
        """SELECT round(max(abs(fa - fb)), 6) AS ks_statistic FROM (
        SELECT sum(na) OVER (ORDER BY x) / (SELECT count(*) FROM log) AS fa, sum(nb) OVER (ORDER BY x) / (SELECT count(*) FROM log) AS fb
        FROM (SELECT x, sum(a) AS na, sum(b) AS nb FROM (SELECT paid / 100 AS x, 1 AS a, 0 AS b FROM log
          UNION ALL SELECT price AS x, 0 AS a, 1 AS b FROM log) GROUP BY 1))"""
    ),
)
def ks_statistic(spark, d):
    log = views.priced_log(spark, d).select((F.col("paid") / 100).alias("scaled"), "price")
    return _rounded(distances.ks_statistic(log, "scaled", "price"))


@query(
    "kl_divergence",
    sql(
        """SELECT round(1 / (1 + sum(x * ln(x / y) - x + y)), 9) AS kl_divergence FROM (
        SELECT bin, (SELECT count(*) FROM b WHERE b.bin = bins.bin AND label) + 1e-5 AS x,
          (SELECT count(*) FROM b WHERE b.bin = bins.bin AND NOT label) + 1e-5 AS y FROM (SELECT unnest(range(0, 10)) AS bin) bins)""",
        """r AS (SELECT min(price) AS lo, max(price) AS hi FROM log)""",
        """b AS (SELECT least(9, floor((x - lo) / ((hi - lo) / 10)))::BIGINT AS bin, label FROM (
          SELECT price AS x, TRUE AS label FROM log UNION ALL SELECT paid / 100 AS x, FALSE AS label FROM log), r WHERE x BETWEEN lo AND hi)""",
    ),
)
def kl_divergence(spark, d):
    log = views.priced_log(spark, d).select((F.col("paid") / 100).alias("scaled"), "price")
    return _rounded(distances.kl_divergence(log, "scaled", "price"), 9)


_POP = "(sum(relevance) + 1.0) / (count(*) + 2.0)"


@query(
    "item_popularity",
    sql(f"SELECT item_idx, round({_POP}, 9) AS relevance FROM log GROUP BY 1"),
)
def item_popularity(spark, d):
    return _rounded(Popularity.scores(views.interactions(spark, d), DEFAULTS.alpha), 9)


def ucb_sql(where: str = "TRUE", name: str = "ucb", price_weight: float = 0.0) -> str:
    """Scores of all items after the log rows ``where``, as a named sub-query."""
    bonus = f"ln(2.0 * (SELECT count(*) FROM log WHERE {where}))"
    value = f"coalesce(s, 1 + sqrt({bonus}))"
    if price_weight:
        lo, hi = "(SELECT min(price) FROM items)", "(SELECT max(price) FROM items)"
        value = f"(1 - {price_weight}) * {value} + {price_weight} * (price - {lo}) / ({hi} - {lo})"
    return f"""{name} AS (SELECT item_idx, price, round({value}, 9) AS relevance FROM items LEFT JOIN (
      SELECT item_idx, sum(relevance) / count(*) + sqrt({bonus} / count(*)) AS s FROM log WHERE {where} GROUP BY 1) USING (item_idx))"""


def _fitted_ucb(spark, d, last: int | None = None) -> UCB:
    log = views.interactions(spark, d)
    return UCB().fit(log if last is None else log.where(F.col("iter_no") <= last))


@query("ucb_scores", sql("SELECT item_idx, relevance FROM ucb", ucb_sql()))
def ucb_scores(spark, d):
    return _fitted_ucb(spark, d).scores(views.items(spark, d)).select("item_idx", "relevance")


@query(
    "ucb_rank",
    sql("SELECT item_idx, row_number() OVER (ORDER BY relevance DESC, item_idx DESC)::BIGINT AS rank FROM ucb", ucb_sql()),
)
def ucb_rank(spark, d):
    return _fitted_ucb(spark, d).ranked(views.items(spark, d)).select("item_idx", "rank")


@query(
    "ucb_probability",
    sql("SELECT item_idx, round(relevance / (SELECT sum(relevance) FROM ucb), 9) AS probability FROM ucb", ucb_sql()),
)
def ucb_probability(spark, d):
    return _rounded(_fitted_ucb(spark, d).probabilities(views.items(spark, d)).select("item_idx", "probability"), 9)


@query(
    "ucb_pairs",
    sql(
        """SELECT DISTINCT user_idx, item_idx, ucb.relevance FROM log JOIN ucb USING (item_idx) WHERE iter_no > 0""",
        ucb_sql("iter_no = 0"),
    ),
)
def ucb_pairs(spark, d):
    later = views.interactions(spark, d).where(F.col("iter_no") > 0).select("user_idx", "item_idx").distinct()
    return _rounded(_fitted_ucb(spark, d, 0).score_pairs(later), 9)


@query("max_hist_len", sql("SELECT coalesce(max(n), 0)::BIGINT AS max_hist_len FROM (SELECT count(DISTINCT item_idx) AS n FROM log GROUP BY user_idx)"))
def max_hist_len(spark, d):
    pairs = views.interactions(spark, d).select("user_idx", "item_idx").distinct()
    sizes = pairs.groupBy("user_idx").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.max("n"), F.lit(0)).alias("max_hist_len"))


NGRAM = f"""{recent_sql(50, "response > 0", "bought")},
grams AS (SELECT user_idx, lag(item_idx) OVER (PARTITION BY user_idx ORDER BY pos) AS ctx, item_idx AS next_item FROM bought),
counts AS (SELECT ctx, next_item, count(*) AS cnt FROM grams WHERE ctx IS NOT NULL GROUP BY ALL),
totals AS (SELECT ctx, sum(cnt) AS ctx_total FROM counts GROUP BY 1)"""


@query("ngram_counts", sql("SELECT ctx::VARCHAR AS ctx, next_item, cnt, ctx_total::BIGINT AS ctx_total FROM counts JOIN totals USING (ctx)", NGRAM))
def ngram_counts(spark, d):
    model = ngram.fit(views.interactions(spark, d), 2)
    return model.counts.join(model.totals, "ctx")


def _order_sql(order: int) -> str:
    """Counts of one n-gram order; contexts are item ids with commas between them."""
    back = [f"lag(item_idx, {i}) OVER w" for i in range(order - 1, 0, -1)]
    ctx = " || ',' || ".join(f"({b})::VARCHAR" for b in back) or "''"
    return f"""{recent_sql(50, "response > 0", "bought")},
grams AS (SELECT {ctx} AS ctx, item_idx AS next_item FROM bought WINDOW w AS (PARTITION BY user_idx ORDER BY pos)),
counts AS (SELECT ctx, next_item, count(*) AS cnt FROM grams WHERE ctx IS NOT NULL GROUP BY ALL),
totals AS (SELECT ctx, sum(cnt) AS ctx_total FROM counts GROUP BY 1)"""


_COUNTS = "SELECT ctx, next_item, cnt, ctx_total::BIGINT AS ctx_total FROM counts JOIN totals USING (ctx)"


@query("ngram_counts_order_1", sql(_COUNTS, _order_sql(1)))
def ngram_counts_order_1(spark, d):
    model = ngram.fit(views.interactions(spark, d), 1)
    return model.counts.join(model.totals, "ctx")


@query("ngram_counts_order_3", sql(_COUNTS, _order_sql(3)))
def ngram_counts_order_3(spark, d):
    model = ngram.fit(views.interactions(spark, d), 3)
    return model.counts.join(model.totals, "ctx")


@query(
    "ngram_probability",
    sql(
        """SELECT ctx::VARCHAR AS ctx, next_item, round((cnt + 1.0) / (ctx_total + (SELECT count(DISTINCT item_idx) FROM bought)), 9) AS probability
        FROM counts JOIN totals USING (ctx)""",
        NGRAM,
    ),
)
def ngram_probability(spark, d):
    model = ngram.fit(views.interactions(spark, d), 2)
    return _rounded(ngram.observed_probabilities(model).select("ctx", "next_item", "probability"), 9)


def _top_sql(source: str, k: int = DEFAULTS.neighbours) -> str:
    return f"""SELECT user_idx, neighbour, similarity, rank::BIGINT AS rank FROM (SELECT *, row_number() OVER (
      PARTITION BY user_idx ORDER BY similarity DESC, neighbour) AS rank FROM ({source})) WHERE rank <= {k}"""


SESSION = """session AS (SELECT user_idx, list(DISTINCT item_idx) AS held, count(*) AS len, count(DISTINCT item_idx) AS uniq,
  sum(CASE WHEN response > 0 THEN 1 ELSE 0 END) AS bought FROM recent WHERE back <= 10 GROUP BY 1)"""
SESSION_PAIRS = """SELECT user_idx, neighbour, round(0.7 * shared / (ua + ub - shared) + 0.3 * (1 - abs(pa - pb) / greatest(la, lb)), 9) AS similarity
  FROM (SELECT a.user_idx, b.user_idx AS neighbour, len(list_intersect(a.held, b.held)) AS shared, a.uniq AS ua, b.uniq AS ub,
  a.bought AS pa, b.bought AS pb, a.len AS la, b.len AS lb FROM session a JOIN session b ON a.user_idx <> b.user_idx)"""


def _knn(spark, d, variant: str) -> SequenceKnn:
    return SequenceKnn(variant).fit(views.interactions(spark, d))


def _neighbour_rows(model: SequenceKnn):
    return model.neighbours().select(
        "user_idx", "neighbour", "similarity", F.col("rank").cast("long").alias("rank")
    )


@query("knn_session", sql(_top_sql(SESSION_PAIRS), recent_sql(50), SESSION))
def knn_session(spark, d):
    return _neighbour_rows(_knn(spark, d, "session"))


DOT_PAIRS = """SELECT a.user_idx, b.user_idx AS neighbour, round(sum(a.w * b.w), 9) AS similarity
  FROM feats a JOIN feats b ON a.feat = b.feat AND a.user_idx <> b.user_idx GROUP BY ALL"""


PATTERN = (
    """steps AS (SELECT user_idx, item_idx::VARCHAR || '>' || (lead(item_idx) OVER (PARTITION BY user_idx ORDER BY pos))::VARCHAR AS feat FROM recent)""",
    """trans AS (SELECT user_idx, feat, count(*) AS cnt FROM steps WHERE feat IS NOT NULL GROUP BY ALL)""",
    """feats AS (SELECT user_idx, feat, cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY user_idx)) AS w FROM trans)""",
)


@query("knn_pattern", sql(_top_sql(DOT_PAIRS), recent_sql(50), *PATTERN))
def knn_pattern(spark, d):
    return _neighbour_rows(_knn(spark, d, "pattern"))


TEMPORAL = """feats AS (SELECT user_idx, feat, w / sum(w) OVER (PARTITION BY user_idx) AS w FROM (
  SELECT user_idx, item_idx AS feat, sum(power(0.8, newest - iter_no)) AS w FROM (
    SELECT *, max(iter_no) OVER (PARTITION BY user_idx) AS newest FROM recent) GROUP BY ALL))"""


@query("knn_temporal", sql(_top_sql(DOT_PAIRS), recent_sql(50), TEMPORAL))
def knn_temporal(spark, d):
    return _neighbour_rows(_knn(spark, d, "temporal"))


@query("knn_neighbors", sql(_top_sql(SESSION_PAIRS, 20), recent_sql(50), SESSION))
def knn_neighbors(spark, d):
    recent = sequences.last_n(views.interactions(spark, d), DEFAULTS.session_len)
    near = neighbours.session_neighbours(recent.select("user_idx", "item_idx", "response"), 20)
    return near.select("user_idx", "neighbour", "similarity", F.col("rank").cast("long").alias("rank"))
