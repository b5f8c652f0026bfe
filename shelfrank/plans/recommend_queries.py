"""Queries over recommenders, evaluation runs and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfrank import views
from shelfrank.config import DEFAULTS
from shelfrank.functions import chance, transformers
from shelfrank.operators.blocks import block_top_k
from shelfrank.operators.copula import GaussianCopula
from shelfrank.operators.distances import synthetic_quality as quality_report
from shelfrank.plans import replay
from shelfrank.plans.metric_queries import DOT_PAIRS, NGRAM, PATTERN, SESSION, SESSION_PAIRS, TEMPORAL, _rounded, _top_sql, ucb_sql
from shelfrank.plans.rankers import LogisticRanker, SvmRanker, TreeRanker, additive_top_k
from shelfrank.plans.recommenders import (
    UCB,
    Als,
    Content,
    GraphPropagation,
    Hybrid,
    Ngram,
    Popularity,
    Random,
    SequenceKnn,
    WalkEmbedding,
    content_profiles,
    with_fallback,
)
from shelfrank.plans.registry import ORACLES, query, sql
from shelfrank.plans.table_queries import _VECTORS, hash_sql, normal_sql, recent_sql
from shelfrank.session import cut_lineage, new_folder
from shelfrank.sources.models import load_recommender, save_recommender
from shelfrank.streaming import jobs

K = DEFAULTS.k
LAST_TRAIN = DEFAULTS.last_train_iter
ITERATIONS = 6


def _train(spark, d):
    return views.interactions(spark, d).where(F.col("iter_no") <= LAST_TRAIN)


def _recommend(spark, d, recommender, k: int = K):
    """Fit on the training iterations, recommend to all users."""
    log, users, items = _train(spark, d), views.users(spark, d), views.items(spark, d)
    return recommender.fit(log, users, items).predict(log, k, users, items)


def _shown(recs, digits: int = 6):
    return recs.select(
        "user_idx",
        "item_idx",
        F.round("relevance", digits).alias("relevance"),
        "price",
        F.col("rank").cast("long").alias("rank"),
    )


# --- the same recommenders as brute-force SQL -------------------------------------------


def pop_sql(where: str, name: str = "pop", k: int = K, users: str = "users", scores: str = "") -> str:
    """Popularity top-k after the log rows ``where``: all users with all items, minus seen."""
    scored = scores or f"""SELECT item_idx, price, round(coalesce(s, 0.5), 9) AS relevance FROM items LEFT JOIN (
      SELECT item_idx, (sum(relevance) + 1.0) / (count(*) + 2.0) AS s FROM log WHERE {where} GROUP BY 1) USING (item_idx)"""
    return f"""{name} AS (SELECT * FROM (SELECT user_idx, item_idx, relevance, price, row_number() OVER (
      PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM {users} u CROSS JOIN ({scored}) c
      WHERE NOT EXISTS (SELECT 1 FROM log l WHERE {where} AND l.user_idx = u.user_idx AND l.item_idx = c.item_idx)) WHERE rank <= {k})"""


def ucb_recs_sql(where: str, name: str, price_weight: float = 0.0) -> str:
    scored = ucb_sql(where, f"{name}_scores", price_weight)
    return f"""{scored},
{name} AS (SELECT * FROM (SELECT user_idx, item_idx, relevance, price, row_number() OVER (
      PARTITION BY user_idx ORDER BY relevance DESC, item_idx DESC) AS rank FROM users u CROSS JOIN {name}_scores c
      WHERE NOT EXISTS (SELECT 1 FROM log l WHERE {where} AND l.user_idx = u.user_idx AND l.item_idx = c.item_idx)) WHERE rank <= {K})"""


def random_sql(where: str, name: str = "rnd", k: int = K) -> str:
    """Positions drawn one after another; a repeat is replaced by the step's own number."""

    def place(step: int) -> str:
        number = f"(free - {k - step})"
        return f"(floor({hash_sql('42', 'user_idx', number)} * {number})::BIGINT + 1)"

    steps = [f"{name}_0 AS (SELECT user_idx, count(*) AS free, []::BIGINT[] AS taken FROM {name}_open GROUP BY 1)"]
    for step in range(1, k + 1):
        steps.append(
            f"""{name}_{step} AS (SELECT user_idx, free, list_append(taken,
              CASE WHEN list_contains(taken, {place(step)}) THEN free - {k - step} ELSE {place(step)} END) AS taken FROM {name}_{step - 1})"""
        )
    return ",\n".join(
        [
            f"""{name}_open AS (SELECT user_idx, item_idx, price, row_number() OVER (PARTITION BY user_idx ORDER BY item_idx) AS place
              FROM users u CROSS JOIN items c WHERE NOT EXISTS (
              SELECT 1 FROM log l WHERE {where} AND l.user_idx = u.user_idx AND l.item_idx = c.item_idx))""",
            *steps,
            f"""{name} AS (SELECT user_idx, item_idx, relevance, price, row_number() OVER (
              PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM (
              SELECT o.user_idx, item_idx, price, {hash_sql('42', 'o.user_idx', 'item_idx')} AS relevance
              FROM {name}_open o JOIN {name}_{k} t ON o.user_idx = t.user_idx AND list_contains(t.taken, o.place)))""",
        ]
    )


def show_sql(name: str, digits: int = 6) -> str:
    return f"SELECT user_idx, item_idx, round(relevance, {digits}) AS relevance, price, rank::BIGINT AS rank FROM {name}"


TRAIN = f"iter_no <= {LAST_TRAIN}"


@query("rec_random", sql(show_sql("rnd"), random_sql(TRAIN)))
def rec_random(spark, d):
    return _shown(_recommend(spark, d, Random()))


@query("rec_popularity", sql(show_sql("pop"), pop_sql(TRAIN)))
def rec_popularity(spark, d):
    return _shown(_recommend(spark, d, Popularity()))


@query("rec_ucb", sql(show_sql("ucb"), ucb_recs_sql(TRAIN, "ucb")))
def rec_ucb(spark, d):
    return _shown(_recommend(spark, d, UCB()))


@query("rec_ucb_price", sql(show_sql("ucb"), ucb_recs_sql(TRAIN, "ucb", DEFAULTS.price_weight)))
def rec_ucb_price(spark, d):
    return _shown(_recommend(spark, d, UCB(price_weight=DEFAULTS.price_weight)))


def _fine_sql(seed: str, *keys: str) -> str:
    return hash_sql(seed, *keys).replace("1, 8)", "1, 13)").replace("4294967296.0", "4503599627370496.0")


# The first distinct items of a row of draws; users who want over a quarter of the catalogue rank all keys.
_DRAWN_SQL = f"""bounds AS (SELECT item_idx, price, relevance AS weight, sum(relevance) OVER () AS total, sum(relevance) OVER (ORDER BY item_idx) AS upto FROM ucb),
ends AS (SELECT item_idx, (upto - weight) / total AS lo FROM bounds),
held AS (SELECT user_idx, count(DISTINCT item_idx) AS n FROM log WHERE {TRAIN} GROUP BY 1),
wanted AS (SELECT user_idx, least(coalesce(n, 0) + {K}, (SELECT count(*) FROM items)) AS cnt FROM users LEFT JOIN held USING (user_idx)),
tries AS (SELECT user_idx, unnest(range(1, 16 * cnt + 100)) AS draw FROM wanted WHERE cnt * 4 <= (SELECT count(*) FROM items)),
chosen AS (SELECT t.user_idx, e.item_idx, min(t.draw) AS draw FROM (SELECT *, {_fine_sql('42', 'user_idx', 'draw')} AS u FROM tries) t
  ASOF JOIN ends e ON t.u >= e.lo GROUP BY ALL),
keys AS (SELECT user_idx, item_idx, ln({_fine_sql('42h', 'user_idx', 'item_idx')} + 1 / 4503599627370496.0) / weight AS key
  FROM wanted CROSS JOIN bounds WHERE cnt * 4 > (SELECT count(*) FROM items)),
turns AS (SELECT user_idx, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY draw) AS turn FROM chosen
  UNION ALL SELECT user_idx, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY key DESC, item_idx) FROM keys),
drawn AS (SELECT user_idx, item_idx, turn::BIGINT AS turn FROM turns JOIN wanted USING (user_idx) WHERE turn <= cnt)"""


@query("ucb_sampled", sql("SELECT user_idx, item_idx, turn FROM drawn", ucb_sql(TRAIN), _DRAWN_SQL))
def ucb_sampled(spark, d):
    """Each user draws as many items as they have seen, plus k, by UCB probability."""
    log = _train(spark, d)
    return UCB().fit(log).drawn(log, K, views.users(spark, d), views.items(spark, d))


@query(
    "rec_ucb_sampled",
    sql(
        f"""SELECT user_idx, item_idx, round(weight / total, 6) AS relevance, price, rank::BIGINT AS rank FROM (
        SELECT d.user_idx, d.item_idx, b.weight, b.total, b.price, row_number() OVER (PARTITION BY d.user_idx ORDER BY turn) AS rank
        FROM drawn d JOIN bounds b USING (item_idx)
        WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.{TRAIN} AND l.user_idx = d.user_idx AND l.item_idx = d.item_idx)) WHERE rank <= {K}""",
        ucb_sql(TRAIN),
        _DRAWN_SQL,
    ),
)
def rec_ucb_sampled(spark, d):
    return _shown(_recommend(spark, d, UCB(sample=True)))


def content_sql(where: str, name: str, k: int) -> str:
    return f"""{name}_profiles AS (SELECT user_idx, list(x ORDER BY dim) AS profile FROM (
      SELECT user_idx, dim, CASE WHEN sum(relevance) > 0 THEN sum(relevance * x) / sum(relevance) ELSE 0 END AS x FROM (
        SELECT user_idx, relevance, unnest(vec) AS x, generate_subscripts(vec, 1) AS dim FROM log JOIN vectors USING (item_idx) WHERE {where})
      GROUP BY ALL) GROUP BY 1),
{name}_scored AS (SELECT user_idx, item_idx, price, round(CASE WHEN list_sum(list_transform(profile, lambda x: x * x)) > 0
        THEN list_cosine_similarity(profile, vec) ELSE 0 END, 9) AS relevance FROM {name}_profiles u CROSS JOIN vectors c
      WHERE NOT EXISTS (SELECT 1 FROM log l WHERE {where} AND l.user_idx = u.user_idx AND l.item_idx = c.item_idx)),
{random_sql(where, name + '_rnd', k)},
{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank
      FROM {name}_scored WHERE relevance >= 0) WHERE rank <= {k}
      UNION ALL SELECT user_idx, item_idx, price, relevance, rank FROM {name}_rnd WHERE user_idx NOT IN (SELECT user_idx FROM {name}_profiles))"""


def _content(spark, d) -> Content:
    vectors = views.item_vectors(spark, d)
    return Content(vectors, vectors.select(F.size("vec")).first()[0])


@query("rec_content", sql(show_sql("con"), _VECTORS, content_sql(TRAIN, "con", K)))
def rec_content(spark, d):
    return _shown(_recommend(spark, d, _content(spark, d)))


@query(
    "rec_hybrid",
    sql(
        f"""SELECT user_idx, item_idx, round(relevance, 6) AS relevance, price, rank::BIGINT AS rank FROM (
        SELECT user_idx, item_idx, relevance, price, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM (
          SELECT user_idx, item_idx, any_value(price) AS price, round(sum(share), 9) AS relevance FROM (
            SELECT user_idx, item_idx, price, relevance * 0.7 AS share FROM pop UNION ALL
            SELECT user_idx, item_idx, price, relevance * 0.3 AS share FROM con) GROUP BY ALL)) WHERE rank <= {K}""".replace(
            "GROUP BY ALL", "GROUP BY user_idx, item_idx"
        ),
        _VECTORS,
        pop_sql(TRAIN, k=2 * K),
        content_sql(TRAIN, "con", 2 * K),
    ),
)
def rec_hybrid(spark, d):
    parts = [Popularity(), _content(spark, d)]
    return _shown(_recommend(spark, d, Hybrid(parts, list(DEFAULTS.hybrid_weights))))


@query("rec_saved", ORACLES["rec_hybrid"])
def rec_saved(spark, d):
    """The hybrid's rows from a model that was saved after fitting and loaded again."""
    log, users, items = _train(spark, d), views.users(spark, d), views.items(spark, d)
    folder = new_folder(spark, "model")
    parts = [Popularity(), _content(spark, d)]
    save_recommender(spark, Hybrid(parts, list(DEFAULTS.hybrid_weights)).fit(log, users, items), folder)
    return _shown(load_recommender(spark, folder).predict(log, K, users, items))


@query("rec_logistic")
def rec_logistic(spark, d):
    return _shown(_recommend(spark, d, LogisticRanker()))


_FIXED_A = "user_attr_0 / 20000 - nation * 0.02"
_FIXED_B = "item_attr_0 * 0.03 - price / 2000"


@query(
    "rec_linear_fixed",
    sql(
        """SELECT user_idx, item_idx, round(relevance, 6) AS relevance, price, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM scored) WHERE rank <= 5""",
        f"""scored AS (SELECT user_idx, item_idx, price, round(price / (1 + exp(-(({_FIXED_A}) + ({_FIXED_B})))), 9) AS relevance
        FROM users CROSS JOIN items ANTI JOIN log USING (user_idx, item_idx))""",
    ),
)
def rec_linear_fixed(spark, d):
    """The ranking of linear models, with given weights."""
    items = views.items(spark, d)
    left = views.users(spark, d).select("user_idx", F.expr(_FIXED_A).alias("a"))
    right = items.select("item_idx", F.expr(_FIXED_B).alias("b"), F.col("price").alias("g"))
    best = additive_top_k(left, right, views.interactions(spark, d), K)
    return _shown(best.join(items.select("item_idx", "price"), "item_idx"))


@query("rec_tree")
def rec_tree(spark, d):
    return _shown(_recommend(spark, d, TreeRanker()))


@query("rec_svm")
def rec_svm(spark, d):
    return _shown(_recommend(spark, d, SvmRanker()))


def _fallback_sql(name: str, digits: int) -> str:
    return f"""{show_sql(name, digits)} UNION ALL {show_sql('pop', digits)} WHERE user_idx NOT IN (SELECT user_idx FROM {name})"""


def _knn_sql(pairs: str, *steps: str) -> str:
    """Items of the nearest users' last 50 training rows, by expected revenue; popular ones for users without any."""
    return sql(
        _fallback_sql("knn", 6),
        pop_sql(TRAIN),
        recent_sql(50, TRAIN),
        *steps,
        f"near AS ({_top_sql(pairs)})",
        f"""knn AS (SELECT * FROM (SELECT user_idx, item_idx, relevance, price, row_number() OVER (
          PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM (
          SELECT n.user_idx, r.item_idx, any_value(i.price) AS price,
            round(sum(n.similarity * (r.pos / r.len) * (1 + r.response)) * any_value(i.price), 6) AS relevance
          FROM near n JOIN (SELECT *, count(*) OVER (PARTITION BY user_idx) AS len FROM recent) r ON r.user_idx = n.neighbour
          JOIN items i ON i.item_idx = r.item_idx
          WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.{TRAIN} AND l.user_idx = n.user_idx AND l.item_idx = r.item_idx)
          GROUP BY n.user_idx, r.item_idx)) WHERE rank <= {K})""",
    )


@query("rec_knn", _knn_sql(SESSION_PAIRS, SESSION))
def rec_knn(spark, d):
    return _shown(_recommend(spark, d, SequenceKnn("session")))


@query("rec_knn_pattern", _knn_sql(DOT_PAIRS, *PATTERN))
def rec_knn_pattern(spark, d):
    return _shown(_recommend(spark, d, SequenceKnn("pattern")))


@query("rec_knn_temporal", _knn_sql(DOT_PAIRS, TEMPORAL))
def rec_knn_temporal(spark, d):
    return _shown(_recommend(spark, d, SequenceKnn("temporal")))


@query(
    "rec_ngram",
    sql(
        _fallback_sql("ng", 5),
        pop_sql(TRAIN),
        NGRAM.replace("WHERE response > 0", f"WHERE response > 0 AND {TRAIN}"),
        "tails AS (SELECT user_idx, item_idx AS ctx FROM bought WHERE back = 1)",
        "vocab AS (SELECT item_idx, price FROM items WHERE item_idx IN (SELECT item_idx FROM bought))",
        f"""ng AS (SELECT * FROM (SELECT user_idx, item_idx, relevance, price, row_number() OVER (
          PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM (
          SELECT t.user_idx, v.item_idx, v.price, round((coalesce(c.cnt, 0) + 1.0) / (coalesce(ct.ctx_total, 0) + (SELECT count(*) FROM vocab)) * v.price, 9) AS relevance
          FROM tails t CROSS JOIN vocab v LEFT JOIN totals ct ON ct.ctx = t.ctx LEFT JOIN counts c ON c.ctx = t.ctx AND c.next_item = v.item_idx
          WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.{TRAIN} AND l.user_idx = t.user_idx AND l.item_idx = v.item_idx))) WHERE rank <= {K})""",
    ),
)
def rec_ngram(spark, d):
    return _shown(_recommend(spark, d, Ngram(2)), 5)


@query(
    "fallback_union",
    sql(
        """SELECT user_idx, item_idx, round(relevance, 6) AS relevance, price, rank::BIGINT AS rank FROM ucb
        WHERE user_idx IN (SELECT user_idx FROM users WHERE segment = 'BUILDING')
        UNION ALL SELECT user_idx, item_idx, round(relevance, 6) AS relevance, price, rank::BIGINT AS rank FROM pop
        WHERE user_idx NOT IN (SELECT user_idx FROM users WHERE segment = 'BUILDING')""",
        ucb_recs_sql(TRAIN, "ucb"),
        pop_sql(TRAIN),
    ),
)
def fallback_union(spark, d):
    """A model that covers one segment only, completed by popularity."""
    log, users, items = _train(spark, d), views.users(spark, d), views.items(spark, d)
    covered = UCB().fit(log).predict(log, K, users.where(F.col("segment") == "BUILDING"), items)
    return _shown(with_fallback(covered, Popularity().fit(log), log, K, users, items))


@query("rec_graph")
def rec_graph(spark, d):
    return _shown(_recommend(spark, d, WalkEmbedding()))


_PROPAGATE = f"""bought AS (SELECT DISTINCT user_idx, item_idx + (SELECT max(user_idx) + 1 FROM log WHERE {TRAIN} AND response > 0) AS item_node
  FROM log WHERE {TRAIN} AND response > 0),
edges AS (SELECT user_idx AS src, item_node AS dst FROM bought UNION ALL SELECT item_node AS src, user_idx AS dst FROM bought),
deg AS (SELECT src AS node, count(*) + 1 AS degree FROM edges GROUP BY 1),
norm AS (SELECT src, dst, 1 / sqrt(a.degree * b.degree) AS weight FROM edges JOIN deg a ON src = a.node JOIN deg b ON dst = b.node
  UNION ALL SELECT node, node, 1 / degree FROM deg),
x0 AS (SELECT item_idx + (SELECT max(user_idx) + 1 FROM log WHERE {TRAIN} AND response > 0) AS node,
  unnest(vec) AS x, generate_subscripts(vec, 1) AS dim FROM vectors),
x1 AS (SELECT dst AS node, dim, sum(weight * x) AS x FROM norm JOIN x0 ON src = node GROUP BY ALL),
x2 AS (SELECT dst AS node, dim, sum(weight * x) AS x FROM norm JOIN x1 ON src = node GROUP BY ALL)"""


def _propagation(spark, d) -> GraphPropagation:
    vectors = views.item_vectors(spark, d)
    return GraphPropagation(vectors.select("item_idx", "vec"), vectors.select(F.size("vec")).first()[0])


@query("graph_propagate", sql("SELECT node, (dim - 1)::BIGINT AS dim, round(x, 6) AS value FROM x2", _VECTORS, _PROPAGATE))
def graph_propagate(spark, d):
    fitted = _propagation(spark, d).fit(_train(spark, d))
    return fitted.nodes.select("node", F.posexplode("vec").alias("dim", "value")).select(
        "node", F.col("dim").cast("long").alias("dim"), F.round("value", 6).alias("value")
    )


_GRAPH_RECS = f"""node_vectors AS (SELECT node, list(x ORDER BY dim) AS vec, node < (SELECT max(user_idx) + 1 FROM log
    WHERE {TRAIN} AND response > 0) AS is_user FROM x2 GROUP BY node),
item_nodes AS (SELECT i.item_idx, i.price, n.vec FROM node_vectors n JOIN items i
  ON i.item_idx = n.node - (SELECT max(user_idx) + 1 FROM log WHERE {TRAIN} AND response > 0) WHERE NOT n.is_user),
prop_scored AS (SELECT n.node AS user_idx, i.item_idx, i.price,
    round(i.price / (1 + exp(-list_inner_product(n.vec, i.vec))), 9) AS relevance
  FROM node_vectors n JOIN users ON users.user_idx = n.node CROSS JOIN item_nodes i WHERE n.is_user
    AND NOT EXISTS (SELECT 1 FROM log l WHERE {TRAIN} AND l.user_idx = n.node AND l.item_idx = i.item_idx)),
prop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank
  FROM prop_scored) WHERE rank <= {K})"""


@query("rec_graph_prop", sql(_fallback_sql("prop", 6), pop_sql(TRAIN), _VECTORS, _PROPAGATE, _GRAPH_RECS))
def rec_graph_prop(spark, d):
    return _shown(_recommend(spark, d, _propagation(spark, d)))


@query("rec_als")
def rec_als(spark, d):
    return _shown(_recommend(spark, d, Als()))


_HARD_SQL = f"""tastes AS (SELECT user_idx, list(x ORDER BY dim) AS profile FROM (
  SELECT user_idx, dim, CASE WHEN sum(relevance) > 0 THEN sum(relevance * x) / sum(relevance) ELSE 0 END AS x FROM (
    SELECT user_idx, relevance, unnest(vec) AS x, generate_subscripts(vec, 1) AS dim FROM log JOIN vectors USING (item_idx) WHERE {TRAIN})
  GROUP BY ALL) GROUP BY 1),
liked AS (SELECT user_idx, list(item_idx ORDER BY score DESC, item_idx) AS best FROM (
  SELECT user_idx, item_idx, round(list_inner_product(profile, vec), 9) AS score FROM tastes CROSS JOIN vectors
  QUALIFY row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) <= 11) GROUP BY 1),
offered AS (SELECT user_idx, positive, list_filter(best, lambda b: b <> positive)[1:10] AS others FROM
  (SELECT DISTINCT user_idx, item_idx AS positive FROM log WHERE {TRAIN} AND response > 0) JOIN liked USING (user_idx))"""


@query(
    "hard_negatives",
    sql(
        f"""SELECT user_idx, positive, others[1 + floor({hash_sql('42', 'user_idx', 'positive')} * len(others))::BIGINT] AS negative FROM offered""",
        _VECTORS,
        _HARD_SQL,
    ),
)
def hard_negatives(spark, d):
    """For every purchase, one of the ten other items scoring highest for the user."""
    log = _train(spark, d)
    vectors = views.item_vectors(spark, d)
    size = vectors.select(F.size("vec")).first()[0]
    profiles = content_profiles(log, vectors, size).select("user_idx", "vec")
    best = block_top_k(profiles, vectors, None, 11, "dot")
    lists = best.groupBy("user_idx").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "item_idx"))), lambda e: e.item_idx).alias("best")
    )
    positives = replay.bought_pairs(log).withColumnRenamed("item_idx", "positive")
    offered = positives.join(lists, "user_idx").withColumn(
        "others", F.slice(F.array_remove("best", F.col("positive")), 1, 10)
    )
    pick = F.floor(chance.uniform(DEFAULTS.seed, "user_idx", "positive") * F.size("others")).cast("int")
    return offered.select("user_idx", "positive", F.get("others", pick).alias("negative"))


@query("latent_features")
def latent_features(spark, d):
    vectors = views.item_vectors(spark, d)
    size = vectors.select(F.size("vec")).first()[0]
    names = [f"item_attr_{i}" for i in range(size)]
    wide = vectors.select("item_idx", *[F.get("vec", F.lit(i)).alias(n) for i, n in enumerate(names)])
    model = transformers.LatentFeatures(inputCols=names, outputCol="latent", k=8).fit(wide)
    return model.transform(wide)


def _lines(spark, d):
    return views.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
    )


@query("copula_sample")
def copula_sample(spark, d):
    """One look-alike row per order line, fitted on all of them."""
    lines = _lines(spark, d)
    copula = GaussianCopula(["l_quantity", "l_extendedprice", "l_discount"]).fit(lines)
    return copula.generate(lines, ["l_orderkey", "l_linenumber", "l_partkey"])


@query("synthetic_quality")
def synthetic_quality(spark, d):
    lines = _lines(spark, d)
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    made = GaussianCopula(columns).fit(lines).generate(lines, ["l_orderkey", "l_linenumber", "l_partkey"])
    return quality_report(lines, cut_lineage(made), columns)


# --- evaluation ----------------------------------------------------------------------------


_NOISY = f"greatest(0.1 + 0.05 * {normal_sql('42#0', 'user_idx', 'item_idx')}, 0)"


@query(
    "response_pipeline",
    sql(
        f"""SELECT user_idx, item_idx, round(noisy, 6) AS noisy, response, round(response * price, 6) AS revenue FROM (
        SELECT *, CASE WHEN {hash_sql('42#0b', 'user_idx', 'item_idx')} <= noisy THEN 1 ELSE 0 END AS response FROM (
        SELECT user_idx, item_idx, price, {_NOISY} AS noisy FROM pop))""",
        pop_sql(TRAIN),
    ),
)
def response_pipeline(spark, d):
    from pyspark.ml import PipelineModel

    recs = _recommend(spark, d, Popularity())
    pipeline = PipelineModel(
        stages=[
            transformers.NoiseResponse(mu=DEFAULTS.noise_mean, sigma=DEFAULTS.noise_std, outputCol="noisy", seed=42),
            transformers.BernoulliResponse(inputCol="noisy", outputCol="response", seed=42),
            transformers.RevenueResponse(inputCol="response", outputCol="revenue", priceCol="price"),
        ]
    )
    out = pipeline.transform(recs)
    return out.select(
        "user_idx", "item_idx", F.round("noisy", 6).alias("noisy"), "response", F.round("revenue", 6).alias("revenue")
    )


def metrics_sql(labelled: str, keys: str) -> str:
    """The metrics row per group of a labelled list, in SQL."""
    key_list = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""SELECT {key_list}round(avg(p), 6) AS precision_at_k, round(coalesce(avg(CASE WHEN idcg > 0 THEN dcg / idcg END), 0), 6) AS ndcg_at_k,
      round(avg(coalesce(1 / first_hit, 0)), 6) AS mrr, round(avg(hit), 6) AS hit_rate, round(sum(disc), 4) AS discounted_revenue,
      round(sum(rev), 4) AS revenue, round(sum(resp) / sum(n), 6) AS conversion_rate FROM (
      SELECT {key_list}user_idx, avg(response) AS p, max(response)::DOUBLE AS hit, sum(response / log2(pos + 1)) AS dcg, sum(response / log2(ideal + 1)) AS idcg,
        min(rank) FILTER (WHERE response > 0) AS first_hit, sum(revenue / log2(rank + 1)) AS disc, sum(revenue) AS rev, sum(response) AS resp, count(*) AS n
      FROM (SELECT *, row_number() OVER (PARTITION BY {key_list}user_idx ORDER BY rank) AS pos,
        row_number() OVER (PARTITION BY {key_list}user_idx ORDER BY response DESC, rank) AS ideal FROM {labelled}) GROUP BY {key_list}user_idx) {group}"""


def _metric_row(df):
    return _rounded(df).withColumns(
        {"discounted_revenue": F.round("discounted_revenue", 4), "revenue": F.round("revenue", 4)}
    )


@query(
    "replay_step",
    sql(
        metrics_sql("labelled", ""),
        pop_sql(TRAIN),
        f"""labelled AS (SELECT pop.*, CASE WHEN b.user_idx IS NULL THEN 0 ELSE 1 END AS response,
          CASE WHEN b.user_idx IS NULL THEN 0 ELSE price END AS revenue FROM pop LEFT JOIN (
          SELECT DISTINCT user_idx, item_idx FROM log WHERE iter_no > {LAST_TRAIN} AND response > 0) b USING (user_idx, item_idx))""",
    ),
)
def replay_step(spark, d):
    return _metric_row(
        replay.replay_step(
            Popularity(),
            views.interactions(spark, d),
            views.users(spark, d),
            views.items(spark, d),
            K,
            LAST_TRAIN,
        )
    )


def _prequential_sql(frozen: int | None) -> str:
    parts = []
    for number in range(1, ITERATIONS + 1):
        fitted = number if frozen is None else min(number, frozen)
        scored = f"""SELECT item_idx, price, round(coalesce(s, 0.5), 9) AS relevance FROM items LEFT JOIN (
          SELECT item_idx, (sum(relevance) + 1.0) / (count(*) + 2.0) AS s FROM log WHERE iter_no < {fitted} GROUP BY 1) USING (item_idx)"""
        parts.append(pop_sql(f"iter_no < {number}", f"r{number}", scores=scored))
    every = " UNION ALL ".join(
        f"SELECT {n} AS round, r{n}.*, b.user_idx IS NOT NULL AS hit FROM r{n} LEFT JOIN (SELECT DISTINCT user_idx, item_idx FROM log "
        f"WHERE iter_no = {n} AND response > 0) b USING (user_idx, item_idx)"
        for n in range(1, ITERATIONS + 1)
    ).replace("b.user_idx IS NOT NULL", "b.mark IS NOT NULL").replace("SELECT DISTINCT user_idx, item_idx FROM", "SELECT DISTINCT user_idx, item_idx, 1 AS mark FROM")
    labelled = f"""labelled AS (SELECT *, CASE WHEN hit THEN 1 ELSE 0 END AS response, CASE WHEN hit THEN price ELSE 0 END AS revenue FROM ({every}))"""
    return sql(metrics_sql("labelled", "round"), *parts, labelled)


def _prequential(spark, d, frozen: int | None):
    return _metric_row(
        replay.prequential_popularity(
            views.interactions(spark, d),
            views.users(spark, d),
            views.items(spark, d),
            K,
            DEFAULTS.alpha,
            ITERATIONS,
            frozen,
        )
    )


@query("prequential_popularity", _prequential_sql(None))
def prequential_popularity(spark, d):
    return _prequential(spark, d, None)


@query("train_test_metrics", _prequential_sql(LAST_TRAIN + 1))
def train_test_metrics(spark, d):
    """Refitted before each training iteration and once after, frozen in the test ones."""
    return _prequential(spark, d, LAST_TRAIN + 1)


def _compared(spark, d):
    return replay.compare(
        {"popularity": Popularity(), "random": Random(), "ucb": UCB()},
        views.interactions(spark, d),
        views.users(spark, d),
        views.items(spark, d),
        K,
        LAST_TRAIN,
        ITERATIONS,
    )


def _compared_steps(refit: bool = False) -> list[str]:
    parts, rows = [_VECTORS] if refit else [], []
    for phase, fitted, first, last in replay.schedule(LAST_TRAIN, ITERATIONS, refit):
        where, at = f"iter_no <= {fitted}", f"{phase}{fitted}"
        parts += [pop_sql(where, f"popularity_{at}"), random_sql(where, f"random_{at}"), ucb_recs_sql(where, f"ucb_{at}")]
        if refit:
            parts.append(content_sql(where, f"content_{at}", K))
        for name in ("popularity", "random", "ucb", "content")[: 4 if refit else 3]:
            rows.append(
                f"SELECT '{name}' AS name, '{phase}' AS phase, user_idx, item_idx, price, rank, unnest(range({first}, {last + 1})) AS iter_no FROM {name}_{at}"
            )
    listed = " UNION ALL ".join(rows)
    labelled = f"""labelled AS (SELECT r.*, coalesce(b.mark, 0) AS response, coalesce(b.mark, 0) * price AS revenue FROM ({listed}) r LEFT JOIN (
      SELECT DISTINCT user_idx, item_idx, iter_no, 1 AS mark FROM log WHERE response > 0) b USING (user_idx, item_idx, iter_no))"""
    wide = f"wide AS ({metrics_sql('labelled', 'name, phase, iter_no')})"
    names = ", ".join(replay.METRICS)
    return [*parts, labelled, wide, f"metrics AS (SELECT name, phase, iter_no, metric, value FROM (UNPIVOT wide ON {names} INTO NAME metric VALUE value))"]


_STEPS = _compared_steps()


def _rounded_compared(spark, d):
    """The metrics table, rounded as its SQL text is before further use."""
    table = _compared(spark, d)
    money = F.col("metric").isin("revenue", "discounted_revenue")
    return table.withColumn("value", F.when(money, F.round("value", 4)).otherwise(F.round("value", 6)))


@query(
    "refit_metrics",
    sql(
        """SELECT name, phase, iter_no::BIGINT AS iter_no, metric, CASE WHEN metric IN ('revenue', 'discounted_revenue')
        THEN round(value, 4) ELSE round(value, 6) END AS value FROM metrics""",
        *_compared_steps(refit=True),
    ),
)
def refit_metrics(spark, d):
    """Four recommenders, fitted anew before every training iteration."""
    models = {"popularity": Popularity(), "random": Random(), "ucb": UCB(), "content": _content(spark, d)}
    tables = views.interactions(spark, d), views.users(spark, d), views.items(spark, d)
    table = replay.compare(models, *tables, K, LAST_TRAIN, ITERATIONS, refit=True)
    money = F.col("metric").isin("revenue", "discounted_revenue")
    value = F.when(money, F.round("value", 4)).otherwise(F.round("value", 6))
    return table.select("name", "phase", F.col("iter_no").cast("long").alias("iter_no"), "metric", value.alias("value"))


_MONEY = "metric IN ('revenue', 'discounted_revenue')"


@query(
    "phase_metrics",
    sql(
        f"""SELECT name, phase, metric, CASE WHEN {_MONEY} THEN round(avg(value), 4) ELSE round(avg(value), 6) END AS mean_value,
        CASE WHEN {_MONEY} THEN round(sum(value), 4) ELSE round(sum(value), 6) END AS total_value FROM metrics GROUP BY name, phase, metric""",
        *_STEPS,
    ),
)
def phase_metrics(spark, d):
    # As many digits as the values have: the mean of three such numbers never lies between two.
    table, money = replay.phase_metrics(_rounded_compared(spark, d)), F.col("metric").isin("revenue", "discounted_revenue")
    return table.withColumns(
        {c: F.when(money, F.round(c, 4)).otherwise(F.round(c, 6)) for c in ("mean_value", "total_value")}
    )


_REVENUE = "SELECT name, phase, iter_no, value FROM metrics WHERE metric = 'revenue'"


@query(
    "performance_change",
    sql(
        f"""SELECT name, round(a, 4) AS train_mean, round(b, 4) AS test_mean, round(CASE WHEN a > 0 THEN (b - a) / a * 100 ELSE 0 END, 4) AS change_pct FROM (
        SELECT name, avg(value) FILTER (WHERE phase = 'train') AS a, avg(value) FILTER (WHERE phase = 'test') AS b FROM ({_REVENUE}) GROUP BY 1)""",
        *_STEPS,
    ),
)
def performance_change(spark, d):
    return _rounded(replay.performance_change(_rounded_compared(spark, d)), 4)


@query(
    "metric_correlation",
    sql(
        " UNION ALL ".join(
            f"SELECT '{b}' AS feature_a, '{a}' AS feature_b, round(corr({b}, {a}), 5) AS correlation FROM wide"
            for i, a in enumerate(replay.METRICS)
            for b in replay.METRICS[i + 1 :]
        ),
        *_STEPS,
    ),
)
def metric_correlation(spark, d):
    return _rounded(replay.metric_correlation(_rounded_compared(spark, d)), 5)


@query(
    "revenue_trajectory",
    sql(
        f"""SELECT name, phase, iter_no::BIGINT AS iter_no, round(value, 4) AS revenue,
        round(sum(value) OVER (PARTITION BY name ORDER BY iter_no), 4) AS cumulative_revenue FROM ({_REVENUE})""",
        *_STEPS,
    ),
)
def revenue_trajectory(spark, d):
    table = _rounded(replay.revenue_trajectory(_rounded_compared(spark, d)), 4)
    return table.withColumn("iter_no", F.col("iter_no").cast("long"))


_BOARD = f"""board AS (SELECT name, total_revenue, row_number() OVER (ORDER BY total_revenue DESC, name)::BIGINT AS place FROM (
  SELECT name, round(sum(value), 4) AS total_revenue FROM ({_REVENUE}) WHERE phase = 'test' GROUP BY 1))"""


@query("leaderboard", sql("SELECT name, total_revenue, place FROM board", *_STEPS, _BOARD))
def leaderboard(spark, d):
    board = replay.leaderboard(_rounded_compared(spark, d))
    return _rounded(board, 4).withColumn("place", F.col("place").cast("long"))


@query("best_recommender", sql("SELECT name, total_revenue FROM board WHERE place = 1", *_STEPS, _BOARD))
def best_recommender(spark, d):
    return _rounded(replay.best_recommender(_rounded_compared(spark, d)), 4)


# --- streams -------------------------------------------------------------------------------


@query(
    "stream_popularity",
    """SELECT event_type, count(*) AS n_events, round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 4) AS revenue
    FROM events GROUP BY 1""",
)
def stream_popularity(spark, d):
    target = new_folder(spark, "popularity")
    run = jobs.popularity(jobs.events_stream(spark, d), target, new_folder(spark, "offsets"))
    run.awaitTermination()
    return _rounded(jobs.latest_popularity(spark, target), 4)


@query(
    "stream_window_metrics",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n_events, round(sum(value), 4) AS total_value
    FROM events GROUP BY ALL""",
)
def stream_window_metrics(spark, d):
    target = new_folder(spark, "windows")
    run = jobs.window_metrics(jobs.events_stream(spark, d), target, new_folder(spark, "offsets"))
    run.awaitTermination()
    rows = jobs.latest_windows(spark, target)
    return rows.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"),
        "event_type",
        "n_events",
        F.round("total_value", 4).alias("total_value"),
    )


@query("stream_log_append", "SELECT event_id, user_id, event_type, value FROM events")
def stream_log_append(spark, d):
    target = new_folder(spark, "stream_log")
    run = jobs.append_log(jobs.events_stream(spark, d), target, new_folder(spark, "offsets"))
    run.awaitTermination()
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value")


@query(
    "stream_last_n",
    """SELECT user_id, string_agg(event_type, ',' ORDER BY ts) AS events FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS back FROM events) WHERE back <= 50 GROUP BY 1""",
)
def stream_last_n(spark, d):
    target = new_folder(spark, "last_n")
    run = jobs.last_n_events(
        jobs.events_stream(spark, d), DEFAULTS.max_seq_len, target, new_folder(spark, "offsets")
    )
    run.awaitTermination()
    return jobs.latest_states(spark, target).select("user_id", F.array_join("events", ",").alias("events"))
