"""Queries over scans, projections, joins, exploration and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfrank import views
from shelfrank.config import DEFAULTS
from shelfrank.functions import scalars, transformers
from shelfrank.operators import explore, graph, sampling, sequences
from shelfrank.operators.ordinal import top_ranked
from shelfrank.plans.rankers import training_table
from shelfrank.plans.recommenders import content_profiles, without_seen
from shelfrank.plans.registry import query, sql
from shelfrank.plans.replay import enrich
from shelfrank.session import new_folder
from shelfrank.sources import schema
from shelfrank.sources.tables import IterationLog, normalise_log

# Fixed values of the source tables.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
K = DEFAULTS.k


def hash_sql(seed: str, *keys: str) -> str:
    """The hash draw in [0, 1) as SQL."""
    parts = ", ".join([f"'{seed}'"] + [f"({k})::VARCHAR" for k in keys])
    return f"(('0x' || substr(md5(concat_ws('|', {parts})), 1, 8))::UBIGINT / 4294967296.0)"


def open_hash_sql(seed: str, *keys: str) -> str:
    return f"({hash_sql(seed, *keys)} + 1 / 4294967296.0)"


def normal_sql(seed: str, *keys: str) -> str:
    first, second = open_hash_sql(f"{seed}#1", *keys), hash_sql(f"{seed}#2", *keys)
    return f"(sqrt(-2 * ln({first})) * cos(2 * pi() * {second}))"


@query("scan_users", "SELECT c_custkey AS user_idx, c_mktsegment AS segment, c_acctbal AS user_attr_0, c_nationkey AS nation FROM customer")
def scan_users(spark, d):
    return views.users(spark, d)


@query("scan_items", "SELECT p_partkey AS item_idx, p_type AS category, p_retailprice AS price, p_size AS item_attr_0, p_brand AS brand FROM part")
def scan_items(spark, d):
    return views.items(spark, d)


def _stored_log(spark, d, name: str) -> IterationLog:
    store = IterationLog(spark, new_folder(spark, name))
    rows = views.priced_log(spark, d).select(
        "user_idx",
        "item_idx",
        F.col("relevance").cast("double").alias("relevance"),
        F.col("response").cast("int").alias("response"),
        "price",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("iter_no").cast("int").alias("iter_no"),
        "iter",
    )
    store.append(rows)
    return store


@query(
    "log_append_roundtrip",
    sql(
        """SELECT iter, iter_no::BIGINT AS iter_no, count(*) AS n, sum(relevance)::BIGINT AS relevance_long,
        round(sum(revenue), 4) AS revenue FROM log GROUP BY ALL"""
    ),
)
def log_append_roundtrip(spark, d):
    stored = _stored_log(spark, d, "log").read()
    return stored.groupBy("iter", F.col("iter_no").cast("long").alias("iter_no")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("relevance").cast("long")).alias("relevance_long"),
        F.round(F.sum("revenue"), 4).alias("revenue"),
    )


@query(
    "log_scan_pruned",
    sql("SELECT item_idx, count(*) AS n FROM log WHERE iter IN ('test_0', 'test_1') GROUP BY 1"),
)
def log_scan_pruned(spark, d):
    stored = _stored_log(spark, d, "log").read(["test_0", "test_1"])
    return stored.groupBy("item_idx").agg(F.count(F.lit(1)).alias("n"))


@query(
    "log_normalise",
    sql("SELECT user_idx, item_idx, price, response, 'start' AS iter FROM log"),
)
def log_normalise(spark, d):
    bare = views.interactions(spark, d).select("user_idx", "item_idx", "relevance")
    return normalise_log(bare, views.items(spark, d))


@query("dedupe_columns", sql("SELECT user_idx, item_idx, log.price, category FROM log JOIN items USING (item_idx)"))
def dedupe_columns(spark, d):
    log = views.priced_log(spark, d).select("user_idx", "item_idx", "price")
    right = views.items(spark, d).select(F.col("item_idx").alias("i"), "price", "category")
    doubled = log.join(right, log.item_idx == right.i).drop("i")
    return schema.without_repeated_columns(doubled)


@query("revenue_response", sql("SELECT user_idx, item_idx, order_id, line_no, round(revenue, 6) AS revenue FROM log"))
def revenue_response(spark, d):
    out = transformers.RevenueResponse().transform(views.priced_log(spark, d).drop("revenue"))
    return out.select("user_idx", "item_idx", "order_id", "line_no", F.round("revenue", 6).alias("revenue"))


@query(
    "binarise_relevance",
    sql("SELECT user_idx, item_idx, order_id, line_no, CASE WHEN paid - 50000 > 0 THEN 1 ELSE 0 END AS relevance FROM log"),
)
def binarise_relevance(spark, d):
    scored = views.interactions(spark, d).select(
        "user_idx", "item_idx", "order_id", "line_no", (F.col("paid") - 50000).alias("relevance")
    )
    return scored.withColumn("relevance", scalars.binarise(scored))


@query("constant_response", sql("SELECT user_idx, item_idx, order_id, line_no, 0.5::DOUBLE AS response FROM log"))
def constant_response(spark, d):
    log = views.interactions(spark, d).select("user_idx", "item_idx", "order_id", "line_no")
    return transformers.ConstantResponse(value=0.5, outputCol="response").transform(log)


@query(
    "parametric_response",
    sql("SELECT user_idx, item_idx, order_id, line_no, round(0.7 * response + (paid / 100000) * 0.3, 9) AS mixed FROM log"),
)
def parametric_response(spark, d):
    log = views.interactions(spark, d).withColumn("size", F.col("paid") / 100000)
    mix = transformers.ParametricResponse(inputCols=["response", "size"], outputCol="mixed", weights=[0.7, 0.3])
    return mix.transform(log).select("user_idx", "item_idx", "order_id", "line_no", F.round("mixed", 9).alias("mixed"))


@query(
    "noise_response",
    sql(
        f"""SELECT DISTINCT user_idx, item_idx,
        round(greatest(0.1 + 0.05 * {normal_sql('42#0', 'user_idx', 'item_idx')}, 0), 6) AS noisy FROM log"""
    ),
)
def noise_response(spark, d):
    pairs = views.interactions(spark, d).select("user_idx", "item_idx").distinct()
    noise = transformers.NoiseResponse(mu=DEFAULTS.noise_mean, sigma=DEFAULTS.noise_std, outputCol="noisy", seed=42)
    return noise.transform(pairs).withColumn("noisy", F.round("noisy", 6))


@query(
    "bernoulli_response",
    sql(
        f"""SELECT user_idx, item_idx, CASE WHEN {hash_sql('42#0b', 'user_idx', 'item_idx')} <= p THEN 1 ELSE 0 END AS response
        FROM (SELECT user_idx, item_idx, avg(response) AS p FROM log GROUP BY ALL)"""
    ),
)
def bernoulli_response(spark, d):
    rates = views.interactions(spark, d).groupBy("user_idx", "item_idx").agg(F.avg("response").alias("p"))
    return transformers.BernoulliResponse(inputCol="p", outputCol="response", seed=42).transform(rates).drop("p")


_VECTORS = """vector_count AS (SELECT count(*) AS n FROM embeddings),
vectors AS MATERIALIZED (SELECT item_idx, price, embedding::DOUBLE[] AS vec
  FROM (SELECT item_idx, price, item_idx % n AS vec_id FROM items, vector_count) JOIN embeddings USING (vec_id))"""


def _vector_pairs(spark, d):
    """Each item's vector next to the vector of the following item."""
    vectors = views.item_vectors(spark, d).select("item_idx", "vec")
    following = vectors.select((F.col("item_idx") - 1).alias("item_idx"), F.col("vec").alias("next_vec"))
    return vectors.join(following, "item_idx")


_PAIR_SQL = """FROM (SELECT item_idx, vec, lead(vec) OVER by_item AS next_vec, lead(item_idx) OVER by_item AS next_idx
  FROM vectors WINDOW by_item AS (ORDER BY item_idx)) WHERE next_idx = item_idx + 1"""


@query(
    "angular_similarity",
    sql(
        f"""SELECT item_idx, round(1 - acos(greatest(-1, least(1, list_cosine_similarity(vec, next_vec)))) / pi(), 6)
        AS similarity {_PAIR_SQL}""",
        _VECTORS,
    ),
)
def angular_similarity(spark, d):
    step = transformers.AngularSimilarity(inputCols=["vec", "next_vec"], outputCol="similarity")
    return step.transform(_vector_pairs(spark, d)).select("item_idx", F.round("similarity", 6).alias("similarity"))


@query(
    "cosine_similarity",
    sql(f"SELECT item_idx, round(list_cosine_similarity(vec, next_vec), 6) AS similarity {_PAIR_SQL}", _VECTORS),
)
def cosine_similarity(spark, d):
    return _vector_pairs(spark, d).select(
        "item_idx", F.round(scalars.cosine("vec", "next_vec"), 6).alias("similarity")
    )


@query("vector_element", sql("SELECT item_idx, vec[4] AS element FROM vectors", _VECTORS))
def vector_element(spark, d):
    step = transformers.VectorElement(inputCol="vec", outputCol="element", index=3)
    return step.transform(views.item_vectors(spark, d)).select("item_idx", "element")


@query(
    "interaction_duplicates",
    sql(
        """SELECT count(*)::BIGINT AS n_rows, count(DISTINCT row(user_idx, item_idx, response, ts, order_id, line_no, paid))::BIGINT
        AS n_distinct FROM log0"""
    ),
)
def interaction_duplicates(spark, d):
    """Rows of the interactions, and how many are left without full-row repeats."""
    log = views.interactions(spark, d)
    per_row = log.groupBy(*log.columns).agg(F.count(F.lit(1)).alias("n"))
    return per_row.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))


@query(
    "assemble_features",
    sql("SELECT item_idx, round(item_attr_0 + 2 * price, 4) AS weighted, 2::BIGINT AS size FROM items"),
)
def assemble_features(spark, d):
    items = views.items(spark, d).withColumn("item_attr_1", F.col("price"))
    names = scalars.feature_columns(items, "item_attr_")
    features = F.array(*[F.col(c).cast("double") for c in names])
    weights = F.array(*[F.lit(float(i + 1)) for i in range(len(names))])
    return items.select(
        "item_idx",
        F.round(scalars.dot(features, weights), 4).alias("weighted"),
        F.size(features).cast("long").alias("size"),
    )


@query(
    "content_profile",
    sql(
        """SELECT user_idx, dim::BIGINT AS dim, max(cnt)::BIGINT AS interaction_count, round(max(total), 4)::DOUBLE AS total_relevance,
        round(CASE WHEN max(total) > 0 THEN sum(relevance * x) / max(total) ELSE 0 END, 6) AS value
        FROM (SELECT user_idx, relevance, unnest(vec) AS x, generate_subscripts(vec, 1) AS dim,
              count(*) OVER (PARTITION BY user_idx) / 1 AS cnt, sum(relevance) OVER (PARTITION BY user_idx) AS total
              FROM log JOIN vectors USING (item_idx)) GROUP BY user_idx, dim""",
        _VECTORS,
    ),
)
def content_profile(spark, d):
    vectors = views.item_vectors(spark, d)
    size = vectors.select(F.size("vec")).first()[0]
    profiles = content_profiles(views.interactions(spark, d), vectors, size)
    return profiles.select(
        "user_idx",
        F.posexplode("vec").alias("dim", "value"),
        "interaction_count",
        F.round("total_relevance", 4).alias("total_relevance"),
    ).select(
        "user_idx",
        (F.col("dim") + 1).cast("long").alias("dim"),
        "interaction_count",
        "total_relevance",
        F.round("value", 6).alias("value"),
    )


@query("label_ids", "SELECT 'real_' || c_custkey::VARCHAR AS user_label FROM customer")
def label_ids(spark, d):
    users = views.users(spark, d)
    return users.select(sampling.label_ids(users, "real", "user_idx").alias("user_label"))


@query(
    "expected_revenue_topk",
    sql(
        f"""SELECT user_idx, item_idx, score, rank::BIGINT AS rank FROM (
        SELECT user_idx, item_idx, round(p * price, 6) AS score, row_number() OVER (
          PARTITION BY user_idx ORDER BY round(p * price, 6) DESC, item_idx) AS rank
        FROM (SELECT user_idx, item_idx, avg(response) AS p, max(price) AS price FROM log GROUP BY ALL)) WHERE rank <= {K}"""
    ),
)
def expected_revenue_topk(spark, d):
    pairs = (
        views.priced_log(spark, d)
        .groupBy("user_idx", "item_idx")
        .agg(F.round(F.avg("response") * F.max("price"), 6).alias("score"))
    )
    best = top_ranked(pairs, "user_idx", [F.col("score").desc(), F.col("item_idx")], K)
    return best.withColumn("rank", F.col("rank").cast("long"))


@query(
    "nonlinear_relevance",
    sql(
        """SELECT item_idx, round((sin(p) + 1) * exp(p - 1) * ln(1 + price) * cos(price / 100) * (1 + tan(p * pi() / 4)), 6)
        AS relevance FROM (SELECT item_idx, avg(response) AS p, max(price) AS price FROM log GROUP BY 1)"""
    ),
)
def nonlinear_relevance(spark, d):
    rates = (
        views.priced_log(spark, d)
        .groupBy("item_idx")
        .agg(F.avg("response").alias("p"), F.max("price").alias("price"))
    )
    return rates.select("item_idx", F.round(scalars.price_response_relevance("p", "price"), 6).alias("relevance"))


@query(
    "iter_ordinal",
    sql(
        """SELECT iter, (CASE WHEN iter_no = 0 THEN 0 WHEN iter_no <= 3 THEN iter_no ELSE iter_no - 4 + 100 END)::BIGINT
        AS ordinal, count(*) AS n FROM log GROUP BY ALL"""
    ),
)
def iter_ordinal(spark, d):
    log = views.interactions(spark, d)
    return log.groupBy("iter", scalars.iteration_ordinal("iter").cast("long").alias("ordinal")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("segment_filter", sql("SELECT user_idx, user_attr_0 FROM users WHERE segment = 'BUILDING'"))
def segment_filter(spark, d):
    return views.users(spark, d).where(F.col("segment") == "BUILDING").select("user_idx", "user_attr_0")


@query(
    "coerce_price",
    sql("SELECT item_idx, CASE WHEN item_attr_0 % 7 = 0 THEN 0.0 ELSE price END AS price FROM items"),
)
def coerce_price(spark, d):
    items = views.items(spark, d)
    dirty = items.select(
        "item_idx",
        F.when(F.col("item_attr_0") % 7 == 0, F.lit("n/a")).otherwise(F.col("price").cast("string")).alias("list_price"),
    )
    return dirty.select("item_idx", scalars.numeric_or_zero(scalars.price_like_column(dirty)).alias("price"))


@query(
    "label_violations",
    sql("SELECT user_idx, item_idx, relevance::BIGINT AS relevance FROM (SELECT user_idx, item_idx, sum(relevance) AS relevance FROM log GROUP BY ALL) WHERE relevance NOT IN (0, 1)"),
)
def label_violations(spark, d):
    summed = views.interactions(spark, d).groupBy("user_idx", "item_idx").agg(F.sum("relevance").alias("relevance"))
    return schema.label_violations(summed)


@query(
    "one_hot_segment",
    sql(
        "SELECT user_idx, "
        + ", ".join(f"CASE WHEN segment = '{s}' THEN 1 ELSE 0 END AS segment_{s.lower()}" for s in SEGMENTS)
        + " FROM users"
    ),
)
def one_hot_segment(spark, d):
    return views.users(spark, d).select("user_idx", *scalars.one_hot("segment", SEGMENTS))


@query(
    "standardise_price",
    sql("SELECT item_idx, round((price - (SELECT avg(price) FROM items)) / (SELECT stddev_pop(price) FROM items), 6) AS price_std FROM items"),
)
def standardise_price(spark, d):
    items = views.items(spark, d)
    stats = items.agg(F.struct(F.avg("price").alias("m"), F.stddev_pop("price").alias("s")).alias("t")).scalar()
    return items.select(
        "item_idx", F.round((F.col("price") - stats.getField("m")) / stats.getField("s"), 6).alias("price_std")
    )


@query(
    "l2_normalise",
    sql(
        """SELECT item_idx, dim::INTEGER AS dim, round(vec[dim + 1] / size, 6) AS value FROM (
        SELECT item_idx, vec, sqrt(list_sum(list_transform(vec, lambda x: x * x))) AS size, unnest(range(len(vec))) AS dim
        FROM vectors)""",
        _VECTORS,
    ),
)
def l2_normalise(spark, d):
    vectors = views.item_vectors(spark, d).withColumn("unit", scalars.l2_normalise("vec"))
    return vectors.select(
        "item_idx",
        F.posexplode("unit").alias("dim", "value"),
    ).select("item_idx", "dim", F.round("value", 6).alias("value"))


@query(
    "graph_nodes",
    sql(
        """SELECT kind, id, (row_number() OVER (ORDER BY kind DESC, id) - 1)::BIGINT AS node FROM (
        SELECT DISTINCT 'user' AS kind, user_idx AS id FROM log UNION ALL
        SELECT DISTINCT 'item' AS kind, item_idx AS id FROM log)"""
    ),
)
def graph_nodes(spark, d):
    return graph.graph_nodes(views.interactions(spark, d))


@query(
    "dot_relevance",
    sql(
        """SELECT DISTINCT user_idx, item_idx, CASE WHEN user_attr_0 * item_attr_0 - nation * i.price > 0 THEN 1 ELSE 0 END AS relevance
        FROM log JOIN users USING (user_idx) JOIN items i USING (item_idx)"""
    ),
)
def dot_relevance(spark, d):
    pairs = views.interactions(spark, d).select("user_idx", "item_idx").distinct()
    users = views.users(spark, d).select(
        "user_idx", F.array(F.col("user_attr_0"), -F.col("nation").cast("double")).alias("u")
    )
    items = views.items(spark, d).select("item_idx", F.array(F.col("item_attr_0").cast("double"), "price").alias("v"))
    joined = pairs.join(users, "user_idx").join(items, "item_idx")
    return joined.select("user_idx", "item_idx", F.when(scalars.dot("u", "v") > 0, 1).otherwise(0).alias("relevance"))


_RANDOM_HEAD = f"SELECT item_idx FROM items ORDER BY {hash_sql('42', 'item_idx')}, item_idx LIMIT {K}"


@query("selector_random_k", sql(f"SELECT user_idx, item_idx FROM users CROSS JOIN ({_RANDOM_HEAD})"))
def selector_random_k(spark, d):
    selector = transformers.RandomItemSelector(k=K, seed=42).fit(views.items(spark, d))
    return selector.transform(views.users(spark, d).select("user_idx"))


@query(
    "candidate_counts",
    sql(
        """SELECT user_idx, count(*) AS candidates FROM users u CROSS JOIN items i WHERE NOT EXISTS (
        SELECT 1 FROM log l WHERE l.user_idx = u.user_idx AND l.item_idx = i.item_idx) GROUP BY 1"""
    ),
)
def candidate_counts(spark, d):
    """Unseen candidates per user, counted without listing a single pair."""
    users, items, log = views.users(spark, d), views.items(spark, d), views.interactions(spark, d)
    return explore.candidate_counts(users, items, log)


@query(
    "filter_seen",
    sql(
        """SELECT DISTINCT user_idx, item_idx FROM log l WHERE iter_no > 3 AND NOT EXISTS (
        SELECT 1 FROM log s WHERE s.iter_no <= 3 AND s.user_idx = l.user_idx AND s.item_idx = l.item_idx)"""
    ),
)
def filter_seen(spark, d):
    log = views.interactions(spark, d)
    later = log.where(F.col("iter_no") > 3).select("user_idx", "item_idx").distinct()
    return without_seen(later, log.where(F.col("iter_no") <= 3))


@query(
    "log_for_users",
    sql("SELECT user_idx, item_idx, response, iter FROM log WHERE user_idx IN (SELECT user_idx FROM users WHERE segment = 'BUILDING')"),
)
def log_for_users(spark, d):
    chosen = views.users(spark, d).where(F.col("segment") == "BUILDING").select("user_idx")
    log = views.interactions(spark, d).select("user_idx", "item_idx", "response", "iter")
    return log.join(chosen, "user_idx", "left_semi")


@query(
    "user_items",
    sql(
        f"""SELECT user_idx, item_idx, 'candidate' AS origin, count(*) AS n FROM users CROSS JOIN ({_RANDOM_HEAD}) GROUP BY ALL
        UNION ALL SELECT user_idx, item_idx, 'log' AS origin, count(*) AS n FROM log GROUP BY ALL"""
    ),
)
def user_items(spark, d):
    users = views.users(spark, d).select("user_idx")
    candidates = sampling.users_with_random_items(users, views.items(spark, d), K, 42).withColumn("origin", F.lit("candidate"))
    history = views.interactions(spark, d).join(users, "user_idx", "left_semi")
    both = candidates.unionByName(history.select("user_idx", "item_idx", F.lit("log").alias("origin")))
    return both.groupBy("user_idx", "item_idx", "origin").agg(F.count(F.lit(1)).alias("n"))


@query(
    "enrich_recs",
    sql(
        """SELECT user_idx, item_idx, n, segment, user_attr_0, nation, category, price, item_attr_0, brand FROM (
        SELECT user_idx, item_idx, count(*) AS n FROM log GROUP BY ALL) LEFT JOIN users USING (user_idx) LEFT JOIN items USING (item_idx)"""
    ),
)
def enrich_recs(spark, d):
    pairs = views.interactions(spark, d).groupBy("user_idx", "item_idx").agg(F.count(F.lit(1)).alias("n"))
    return enrich(pairs, views.users(spark, d), views.items(spark, d))


@query(
    "training_table",
    sql("SELECT user_idx, item_idx, response, category, item_attr_0, items.price, segment, user_attr_0 FROM log JOIN users USING (user_idx) JOIN items USING (item_idx)"),
)
def train_table(spark, d):
    return training_table(views.interactions(spark, d), views.users(spark, d), views.items(spark, d))


@query("segment_share", sql("SELECT segment, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM users), 6) AS percentage FROM users GROUP BY 1"))
def segment_share(spark, d):
    return explore.group_share(views.users(spark, d), "segment").withColumn("percentage", F.round("percentage", 6))


@query("category_share", sql("SELECT category, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM items), 6) AS percentage FROM items GROUP BY 1"))
def category_share(spark, d):
    return explore.group_share(views.items(spark, d), "category").withColumn("percentage", F.round("percentage", 6))


@query(
    "interaction_density",
    sql(
        """SELECT n_interactions, n_users, n_items, active_users, active_items,
        round(n_interactions / (n_users::DOUBLE * n_items), 9) AS density,
        round(active_users * 100.0 / n_users, 6) AS active_user_pct, round(active_items * 100.0 / n_items, 6) AS active_item_pct
        FROM (SELECT count(*) AS n_interactions, count(DISTINCT user_idx) AS active_users, count(DISTINCT item_idx) AS active_items,
        (SELECT count(*) FROM users) AS n_users, (SELECT count(*) FROM items) AS n_items FROM log)"""
    ),
)
def interaction_density(spark, d):
    row = explore.interaction_density(views.interactions(spark, d), views.users(spark, d), views.items(spark, d))
    return row.withColumns(
        {
            "density": F.round("density", 9),
            "active_user_pct": F.round("active_user_pct", 6),
            "active_item_pct": F.round("active_item_pct", 6),
        }
    )


@query("interactions_per_user", sql("SELECT user_idx, count(*) AS interactions FROM log GROUP BY 1"))
def interactions_per_user(spark, d):
    return explore.counts_per(views.interactions(spark, d), "user_idx")


@query("interactions_per_item", sql("SELECT item_idx, count(*) AS interactions FROM log GROUP BY 1"))
def interactions_per_item(spark, d):
    return explore.counts_per(views.interactions(spark, d), "item_idx")


@query("relevance_distribution", sql("SELECT relevance, count(*) AS count FROM log GROUP BY 1"))
def relevance_distribution(spark, d):
    return explore.value_distribution(views.interactions(spark, d), "relevance")


@query(
    "segment_category_pivot",
    sql(
        "SELECT segment, "
        + ", ".join(f"count(*) FILTER (WHERE category = '{c}') AS \"{c}\"" for c in CATEGORIES)
        + " FROM log JOIN users USING (user_idx) JOIN items USING (item_idx) GROUP BY 1"
    ),
)
def segment_category_pivot(spark, d):
    return explore.segment_category_pivot(
        views.interactions(spark, d), views.users(spark, d), views.items(spark, d), CATEGORIES
    )


_NUMERIC = ["price", "item_attr_0", "paid", "response"]


@query(
    "feature_correlation",
    sql(
        " UNION ALL ".join(
            f"SELECT '{b}' AS feature_a, '{a}' AS feature_b, round(corr({b}, {a}), 6) AS correlation FROM t"
            for i, a in enumerate(_NUMERIC)
            for b in _NUMERIC[i + 1 :]
        ),
        "t AS (SELECT log.price, item_attr_0, paid, response FROM log JOIN items USING (item_idx))",
    ),
)
def feature_correlation(spark, d):
    log = views.interactions(spark, d).select("item_idx", "paid", "response")
    table = log.join(views.items(spark, d).select("item_idx", "price", "item_attr_0"), "item_idx")
    return explore.correlations(table, _NUMERIC).withColumn("correlation", F.round("correlation", 6))


def _histogram_sql(bins: int, by: str) -> str:
    lo, hi = "(SELECT min(price) FROM items)", "(SELECT max(price) FROM items)"
    return sql(
        f"""SELECT {by} least({bins - 1}, floor((price - {lo}) / (({hi} - {lo}) / {bins})))::BIGINT AS bin,
        count(*) AS count FROM items GROUP BY ALL"""
    )


@query("price_histogram", _histogram_sql(30, ""))
def price_histogram(spark, d):
    return explore.histogram(views.items(spark, d), "price", 30)


@query("price_histogram_by_category", _histogram_sql(20, "category,"))
def price_histogram_by_category(spark, d):
    return explore.histogram(views.items(spark, d), "price", 20, "category")


@query("dedupe_pairs", sql("SELECT user_idx, item_idx, max(relevance) AS relevance FROM log GROUP BY ALL"))
def dedupe_pairs(spark, d):
    # An aggregate instead of dropDuplicates: which duplicate survives is then defined.
    return views.interactions(spark, d).groupBy("user_idx", "item_idx").agg(F.max("relevance").alias("relevance"))


@query("sample_fraction", sql(f"SELECT user_idx, segment FROM users WHERE {hash_sql('42', 'user_idx')} < 0.1"))
def sample_fraction(spark, d):
    return sampling.sample_fraction(views.users(spark, d), 0.1, 42, "user_idx").select("user_idx", "segment")


@query("sample_exact_n", sql(f"SELECT user_idx, segment FROM users ORDER BY {hash_sql('42', 'user_idx')}, user_idx LIMIT 100"))
def sample_exact_n(spark, d):
    return sampling.sample_exact(views.users(spark, d), 100, 42, "user_idx").select("user_idx", "segment")


@query(
    "sample_stratified",
    sql(
        f"""SELECT user_idx, segment FROM users JOIN (
        SELECT segment, floor(any_value(total) * 0.1 * (count(*) / any_value(total)) + 1e-9) / count(*) AS rate
        FROM users, (SELECT count(*) AS total FROM users) GROUP BY 1) USING (segment)
        WHERE {hash_sql('42', 'user_idx')} < rate"""
    ),
)
def sample_stratified(spark, d):
    return sampling.sample_by_stratum(views.users(spark, d), "segment", 0.1, 42, "user_idx").select("user_idx", "segment")


@query(
    "union_samples",
    sql(
        f"""SELECT user_idx, segment FROM users WHERE segment = 'BUILDING' AND {hash_sql('1', 'user_idx')} < 0.2 UNION ALL
        SELECT user_idx, segment FROM users WHERE segment = 'MACHINERY' AND {hash_sql('2', 'user_idx')} < 0.3"""
    ),
)
def union_samples(spark, d):
    users = views.users(spark, d).select("user_idx", "segment")
    first = sampling.sample_fraction(users.where(F.col("segment") == "BUILDING"), 0.2, 1, "user_idx")
    second = sampling.sample_fraction(users.where(F.col("segment") == "MACHINERY"), 0.3, 2, "user_idx")
    return first.unionByName(second)


@query(
    "negative_samples",
    sql(
        f"""SELECT s.user_idx, s.positive, i.item_idx FROM (
        SELECT user_idx, item_idx AS positive, floor({hash_sql('42', 'user_idx', 'item_idx', 'order_id', 'line_no')}
          * (SELECT count(*) FROM items))::BIGINT AS slot FROM log) s
        JOIN (SELECT item_idx, row_number() OVER (ORDER BY item_idx) - 1 AS slot FROM items) i USING (slot)
        WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.user_idx = s.user_idx AND l.item_idx = i.item_idx)"""
    ),
)
def negative_samples(spark, d):
    return sampling.negative_samples(views.interactions(spark, d), views.items(spark, d), 42)


_GAMMA = " + ".join(f"ln({open_hash_sql(f'42p#{i}', 'item_idx')})" for i in range(1, 6))


@query(
    "synth_items",
    sql(
        f"""SELECT item_idx, category, round(centre + spread * {normal_sql('42a', 'item_idx')}, 6) AS item_attr_0,
        round(-10.0 * ({_GAMMA}), 6) AS price FROM items JOIN (
        SELECT category, avg(item_attr_0) AS centre, stddev_pop(item_attr_0) AS spread FROM items GROUP BY 1) USING (category)"""
    ),
)
def synth_items(spark, d):
    made = sampling.synthetic_items(views.items(spark, d), 42)
    return made.withColumns({"item_attr_0": F.round("item_attr_0", 6), "price": F.round("price", 6)})


@query(
    "synth_history",
    sql(
        f"""SELECT user_idx, item_idx, CASE WHEN (user_attr_0 - (SELECT avg(user_attr_0) FROM users))
          * (item_attr_0 - (SELECT avg(item_attr_0) FROM items)) > 0 THEN 1 ELSE 0 END AS relevance FROM (
        SELECT DISTINCT floor({hash_sql('42u', 'order_id', 'line_no', 'user_idx', 'item_idx')} * (SELECT count(*) FROM users))::BIGINT AS user_idx,
        floor({hash_sql('42i', 'order_id', 'line_no', 'user_idx', 'item_idx')} * (SELECT count(*) FROM items))::BIGINT AS item_idx FROM log)
        JOIN users USING (user_idx) JOIN items USING (item_idx)"""
    ),
)
def synth_history(spark, d):
    return sampling.synthetic_history(views.interactions(spark, d), views.users(spark, d), views.items(spark, d), 42)


_ORDER = "ts, order_id, line_no, item_idx, paid"


@query(
    "interaction_order",
    sql(f"SELECT user_idx, order_id, line_no, item_idx, paid, (row_number() OVER (PARTITION BY user_idx ORDER BY {_ORDER}) - 1)::BIGINT AS ordinal FROM log"),
)
def interaction_order(spark, d):
    return sequences.interaction_order(views.interactions(spark, d)).select(
        "user_idx", "order_id", "line_no", "item_idx", "paid", "ordinal"
    )


def recent_sql(n: int, where: str = "TRUE", name: str = "recent") -> str:
    """Last ``n`` rows per user with their position, as a named sub-query."""
    back = ", ".join(f"{c} DESC" for c in _ORDER.split(", "))
    return f"""{name} AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY back DESC) AS pos FROM (
      SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY {back}) AS back FROM log WHERE {where}) WHERE back <= {n})"""


@query(
    "last_n_per_user",
    sql("SELECT user_idx, item_idx, order_id, line_no, paid, pos::BIGINT AS pos FROM recent", recent_sql(10)),
)
def last_n_per_user(spark, d):
    return sequences.last_n(views.interactions(spark, d), 10).select(
        "user_idx", "item_idx", "order_id", "line_no", "paid", F.col("pos").cast("long").alias("pos")
    )


@query(
    "user_sequences",
    sql(
        "SELECT user_idx, string_agg(item_idx::VARCHAR, ',' ORDER BY pos) AS items, count(*) AS length FROM recent GROUP BY 1",
        recent_sql(50),
    ),
)
def user_sequences(spark, d):
    return sequences.user_sequences(views.interactions(spark, d), 50).select(
        "user_idx", F.array_join("items", ",").alias("items"), F.size("items").cast("long").alias("length")
    )


@query(
    "padded_sequences",
    sql(
        """SELECT user_idx, repeat('0,', (50 - count(*))::INT) || string_agg(item_idx::VARCHAR, ',' ORDER BY pos) AS items
        FROM recent GROUP BY 1""",
        recent_sql(50),
    ),
)
def padded_sequences(spark, d):
    return sequences.padded_sequences(views.interactions(spark, d), 50).select(
        "user_idx", F.array_join("items", ",").alias("items")
    )


@query(
    "sequence_windows",
    sql(
        f"""SELECT user_idx, ordinal::BIGINT AS ordinal, c1::VARCHAR || ',' || c2::VARCHAR || ',' || c3::VARCHAR AS context, item_idx AS next_item
        FROM (SELECT user_idx, item_idx, row_number() OVER w AS ordinal, lag(item_idx, 3) OVER w AS c1,
          lag(item_idx, 2) OVER w AS c2, lag(item_idx, 1) OVER w AS c3 FROM log WINDOW w AS (PARTITION BY user_idx ORDER BY {_ORDER}))
        WHERE c1 IS NOT NULL"""
    ),
)
def sequence_windows(spark, d):
    rows = sequences.sequence_windows(views.interactions(spark, d), 3)
    return rows.withColumn("context", F.array_join("context", ","))


@query(
    "transitions",
    sql(
        """SELECT user_idx, from_item, to_item, count(*) AS cnt FROM (SELECT user_idx, item_idx AS from_item,
        lead(item_idx) OVER (PARTITION BY user_idx ORDER BY pos) AS to_item FROM recent) WHERE to_item IS NOT NULL GROUP BY ALL""",
        recent_sql(50),
    ),
)
def transitions(spark, d):
    return sequences.transitions(sequences.last_n(views.interactions(spark, d), 50))


@query(
    "item_last_price",
    sql(
        """SELECT item_idx, paid AS last_price FROM (SELECT item_idx, paid, row_number() OVER (PARTITION BY item_idx
        ORDER BY ts DESC, order_id DESC, line_no DESC, user_idx DESC, paid DESC) AS n FROM log) WHERE n = 1"""
    ),
)
def item_last_price(spark, d):
    return sequences.item_last_price(views.interactions(spark, d))


EDGES_SQL = """pairs AS (SELECT DISTINCT user_idx, item_idx + (SELECT max(user_idx) + 1 FROM log) AS item_node FROM log),
edges AS (SELECT user_idx AS src, item_node AS dst FROM pairs UNION ALL SELECT item_node AS src, user_idx AS dst FROM pairs),
deg AS (SELECT src AS node, count(*) AS degree FROM edges GROUP BY 1)"""


@query(
    "graph_norm_edges",
    sql(
        """SELECT src, dst, round(1 / sqrt((a.degree + 1) * (b.degree + 1)), 9) AS weight FROM edges
        JOIN deg a ON src = a.node JOIN deg b ON dst = b.node
        UNION ALL SELECT node AS src, node AS dst, round(1 / (degree + 1), 9) AS weight FROM deg""",
        EDGES_SQL,
    ),
)
def graph_norm_edges(spark, d):
    weighted = graph.normalised_edges(graph.edges(views.interactions(spark, d)))
    return weighted.withColumn("weight", F.round("weight", 9))


@query(
    "random_walks",
    "WITH RECURSIVE "
    + sql(
        """SELECT start, walk_no::BIGINT AS walk_no, path FROM walk WHERE step = 8""",
        EDGES_SQL,
        "adj AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS pick FROM edges)",
        f"""walk AS (SELECT node AS start, w AS walk_no, node AS at, 1 AS step, node::VARCHAR AS path
          FROM deg, (SELECT unnest(range(1, 3)) AS w)
          UNION ALL SELECT start, walk_no, dst, step + 1, path || ',' || dst::VARCHAR FROM walk JOIN deg ON deg.node = walk.at
          JOIN adj ON adj.src = walk.at AND adj.pick = floor({hash_sql("S", 'start', 'walk_no')} * degree)::BIGINT
          WHERE step < 8)""".replace("concat_ws('|', 'S',", "concat_ws('|', '42#' || step::VARCHAR,"),
    )[5:],
)
def random_walks(spark, d):
    from shelfrank.session import cut_lineage

    table = cut_lineage(graph.edges(views.interactions(spark, d)))
    walks = graph.random_walks(table, DEFAULTS.walk_length, 2, 42)
    return walks.select("start", F.col("walk_no").cast("long").alias("walk_no"), F.array_join("path", ",").alias("path"))
