"""Registered queries of the engine, each with the SQL that says what it must return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import boxes as B
from .functions import color as C
from .functions import labels as L
from .functions import udtf
from .functions import vectors as V
from .operators import assemble, evaluate, heatmap, palette, pose, registers, sampling, suppression, time_joins, zero_shot
from .session import ship
from .sources import bitmaps, npz, responses, tables
from .streaming import incremental, reviews

_FOUND: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        _FOUND[f.__name__] = (f, sql)
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _FOUND.items() if sql}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- vectors ----

_PROTOS = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT label, [x / sqrt(list_dot_product(v, v)) for x in v] AS u FROM e),
p AS (SELECT label, i, avg(u[i]) AS m FROM n, range(1, 65) t(i) GROUP BY label, i),
q AS (SELECT label, list(m ORDER BY i) AS mean FROM p GROUP BY label),
protos AS (SELECT label, [x / sqrt(list_dot_product(mean, mean)) for x in mean] AS proto FROM q),
sims AS (SELECT vec_id, e.label AS own, protos.label AS label, list_dot_product(v, proto) AS s FROM e, protos)
"""


def _embeddings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = _t(spark, sf_dir, "embeddings")
    return e, V.prototypes(e, "label", "embedding")


@query(
    _PROTOS
    + """, m AS (SELECT vec_id, max(s) AS top, arg_max(label, s) AS best FROM sims GROUP BY vec_id),
c AS (SELECT sims.vec_id, any_value(best) AS best, round(1 / sum(exp((s - top) * 100)), 3) AS score FROM sims JOIN m USING (vec_id) GROUP BY sims.vec_id),
d AS (SELECT vec_id, CASE WHEN score < 0.5 THEN 'uncertain' ELSE CAST(best AS VARCHAR) END AS label, score FROM c)
SELECT vec_id, label, score, label IN ('1', '2', '3') AS is_animal, label NOT IN ('none', 'uncertain') AS is_creature FROM d"""
)
def zero_shot_census(spark, sf_dir):
    e, protos = _embeddings(spark, sf_dir)
    scored = zero_shot.census(e, protos, "vec_id", "embedding")
    return scored.select("*", *zero_shot.flags(F.col("label"), ["1", "2", "3"]))


@query(_PROTOS + "SELECT vec_id, round(max(s) FILTER (label = 0) - max(s) FILTER (label = 1), 6) AS axis FROM sims GROUP BY vec_id")
def axis_projection(spark, sf_dir):
    e, protos = _embeddings(spark, sf_dir)
    return zero_shot.axis(e, protos, "vec_id", "embedding", 0, 1).select("vec_id", F.round("axis", 6).alias("axis"))


@query(
    _PROTOS
    + """, a AS (SELECT vec_id, 1 / (1 + exp(-100 * (max(s) FILTER (label = 2) - max(s) FILTER (label = 3)))) AS p FROM sims GROUP BY vec_id)
SELECT vec_id, round(p, 4) AS p, p > 0.5 AS flag FROM a"""
)
def two_way_softmax(spark, sf_dir):
    e, protos = _embeddings(spark, sf_dir)
    return zero_shot.two_way(e, protos, "vec_id", "embedding", 2, 3)


@query(
    _PROTOS
    + "SELECT vec_id, arg_max(label, s) AS pred, "
    + ", ".join(f"round(max(s) FILTER (label = {k}), 4) AS sim_{k}" for k in range(10))
    + ", any_value(own) AS true_label, coalesce(arg_max(label, s) = any_value(own), false) AS agree FROM sims GROUP BY vec_id"
)
def genre_argmax_agree(spark, sf_dir):
    e, protos = _embeddings(spark, sf_dir)
    return zero_shot.classify(e, protos, "vec_id", "embedding", "label")


@query("SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), [CAST(x AS DOUBLE) / 64 for x in range(1, 65)]) + 0.5, 5) AS value FROM embeddings")
def linear_head(spark, sf_dir):
    weights, bias = V.collapse([([[i / 32 for i in range(1, 65)]], [0.0]), ([[0.5]], [0.5])])
    return _t(spark, sf_dir, "embeddings").select("vec_id", F.round(V.affine(F.col("embedding"), weights, bias), 5).alias("value"))


# ---- validation modes: results against what was expected ----


@query(
    _PROTOS
    + """, m AS (SELECT vec_id, max(s) AS top, arg_max(label, s) AS best FROM sims GROUP BY vec_id),
c AS (SELECT sims.vec_id, any_value(best) AS best, any_value(own) AS own, round(1 / sum(exp((s - top) * 100)), 3) AS score FROM sims JOIN m USING (vec_id) GROUP BY sims.vec_id),
d AS (SELECT vec_id, own, CASE WHEN score < 0.5 THEN 'uncertain' ELSE CAST(best AS VARCHAR) END AS label FROM c)
SELECT vec_id, label, label = CAST(own AS VARCHAR) OR (label = 'uncertain' AND own % 3 = 0) AS ok FROM d"""
)
def census_validation(spark, sf_dir):
    e, protos = _embeddings(spark, sf_dir)
    own = F.array(F.col("label").cast("string"))
    expected = e.select("vec_id", F.when(F.col("label") % 3 == 0, F.array_append(own, "none")).otherwise(own).alias("labels"))
    return zero_shot.validate_sets(zero_shot.census(e, protos, "vec_id", "embedding"), expected, "vec_id")


@query(_PROTOS + ", a AS (SELECT vec_id, any_value(own) AS own, max(s) FILTER (label = 0) - max(s) FILTER (label = 1) AS axis FROM sims GROUP BY vec_id) SELECT round(corr(axis, own), 6) AS correlation FROM a")
def axis_validation(spark, sf_dir):
    e, protos = _embeddings(spark, sf_dir)
    expected = e.select("vec_id", F.col("label").alias("rank"))
    found = zero_shot.validate_rank(zero_shot.axis(e, protos, "vec_id", "embedding", 0, 1).select("vec_id", "axis"), expected, "vec_id")
    return found.select(F.round("correlation", 6).alias("correlation"))


@query(
    """WITH n AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber) + l_orderkey % 3 AS expected FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, n, expected, abs(n - expected) <= 1 AS ok FROM n"""
)
def count_validation(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    expected = lines.agg(F.count_distinct("l_linenumber").alias("k")).select("l_orderkey", (F.col("k") + F.col("l_orderkey") % 3).alias("expected"))
    return zero_shot.validate_count(lines.agg(F.count(F.lit(1)).alias("n")), expected, "l_orderkey")


# ---- registers, trends, correlations ----


@query(
    """WITH q AS (SELECT quantile_cont(o_totalprice, [0.2, 0.4, 0.6, 0.8]) AS e FROM orders),
r AS (SELECT o_totalprice AS x, len([v for v in e if v <= o_totalprice]) AS i FROM orders, q)
SELECT ['minimal', 'restrained', 'balanced', 'decorated', 'ornate'][i + 1] AS register, count(*) AS n, min(x) AS least, max(x) AS most FROM r GROUP BY i"""
)
def axis_registers(spark, sf_dir):
    cut = registers.registers(_t(spark, sf_dir, "orders").select("o_totalprice"), "o_totalprice")
    return cut.groupBy("register").agg(F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"))


@query(
    """WITH q AS (SELECT quantile_cont(p_retailprice, [0.2, 0.4, 0.6, 0.8]) AS e, quantile_cont(CAST(p_size AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS f FROM part),
d AS (SELECT abs(len([v for v in e if v <= p_retailprice]) - len([v for v in f if v <= p_size])) AS d FROM part, q)
SELECT count(*) AS n, count(*) FILTER (d = 0) AS agree, count(*) FILTER (d = 1) AS adjacent, count(*) FILTER (d > 1) AS disagree,
round(count(*) FILTER (d = 0) / count(*), 6) AS agree_rate, round(count(*) FILTER (d <= 1) / count(*), 6) AS within_one_rate FROM d"""
)
def register_agreement(spark, sf_dir):
    parts = _t(spark, sf_dir, "part").select("p_retailprice", F.col("p_size").cast("double").alias("p_size"))
    both = registers.registers(registers.registers(parts, "p_retailprice", "one"), "p_size", "two")
    return registers.agreement(both, "one", "two")


@query(
    """SELECT CAST(floor(year(o_orderdate) / 10) * 10 AS INTEGER) AS decade, count(*) AS n, round(avg(o_totalprice), 4) AS o_totalprice
FROM orders WHERE year(o_orderdate) BETWEEN 1900 AND 2029 GROUP BY 1"""
)
def decade_trend(spark, sf_dir):
    return evaluate.decade_trend(_t(spark, sf_dir, "orders"), F.year("o_orderdate"), ["o_totalprice"])


@query(
    """WITH a AS (SELECT avg(o_totalprice) FILTER (year(o_orderdate) < 1995) AS e, avg(o_totalprice) FILTER (year(o_orderdate) BETWEEN 1995 AND 2009) AS l FROM orders)
SELECT round(e, 4) AS early, round(l, 4) AS late, round(e - l, 4) AS gap, coalesce(abs(e - l) > 3, false) AS exceeds FROM a"""
)
def trend_gap(spark, sf_dir):
    return evaluate.gap(_t(spark, sf_dir, "orders"), F.year("o_orderdate"), "o_totalprice", 1995, 2009, 3)


@query(
    """WITH r AS (SELECT l_quantity AS a, l_discount AS b, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS ra,
rank() OVER (ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_discount) - 1) / 2.0 AS rb FROM lineitem)
SELECT count(*) AS n, round(avg(CAST(a = b AS INTEGER)), 6) AS exact, round(corr(a, b), 6) AS pearson, round(corr(ra, rb), 6) AS spearman FROM r"""
)
def rank_correlation(spark, sf_dir):
    return evaluate.correlations(_t(spark, sf_dir, "lineitem"), "l_quantity", "l_discount")


# ---- assembly, control, sets ----


@query(
    """WITH o AS (SELECT o_custkey AS id, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1),
f AS (SELECT o_custkey AS id, o_orderkey AS k, o_orderstatus AS status, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders)
SELECT c_custkey AS id, c_name AS title, c_mktsegment AS segment, f.k AS first_order_k, f.status AS first_order_status, o.n AS spending_n, o.total AS spending_total
FROM customer LEFT JOIN f ON f.id = c_custkey AND r = 1 LEFT JOIN o ON o.id = c_custkey"""
)
def master_assemble(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    base = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("segment"))
    first = orders.select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("year"))
    spending = orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return assemble.master(base, {"first_order": first, "spending": spending}, order={"first_order": ["year", "k"]})


@query("SELECT o_custkey, count(*) AS n, string_agg(concat(o_orderpriority, ':', o_orderstatus), ';' ORDER BY o_orderkey) AS summary FROM orders GROUP BY o_custkey")
def child_rollup_summary(spark, sf_dir):
    return assemble.rollup(_t(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus")


@query(
    """SELECT n_nationkey AS id, c.n AS customers, s.n AS suppliers FROM nation LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) c ON c.k = n_nationkey
LEFT JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) s ON s.k = n_nationkey"""
)
def nested_lookup(spark, sf_dir):
    count = lambda t, k: _t(spark, sf_dir, t).groupBy(F.col(k).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    nations = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"))
    both = assemble.nested_lookup(nations, count("customer", "c_nationkey"), count("supplier", "s_nationkey"))
    return both.select("id", F.col("a.n").alias("customers"), F.col("b.n").alias("suppliers"))


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey")
def last_row_wins(spark, sf_dir):
    return tables.last_by_id(_t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), "o_custkey", "o_orderkey")


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey")
def first_row_wins(spark, sf_dir):
    return assemble.first_by(_t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey"])


@query("SELECT c_custkey FROM customer WHERE c_name <> '' AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
def resume_anti_join(spark, sf_dir):
    done = _t(spark, sf_dir, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey"))
    return tables.pending(_t(spark, sf_dir, "customer"), done, "c_custkey", "c_name").select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'O')")
def review_resume(spark, sf_dir):
    reviews = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_linestatus") == "O", "ok").otherwise("error").alias("status"))
    return tables.pending_reviews(_t(spark, sf_dir, "orders"), reviews, ["o_orderkey"]).select("o_orderkey")


@query("SELECT o_orderkey, p AS position FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS p FROM orders) WHERE p % 4 = 1")
def shard_modulo(spark, sf_dir):
    return tables.shard(tables.with_position(_t(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"]), 1, 4)


@query("SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def id_intersection(spark, sf_dir):
    a = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return a.intersect(_t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id")))


@query("SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 250000")
def id_difference(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")).subtract(_t(spark, sf_dir, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("id")))


@query("SELECT name, kind, count(*) AS n FROM (SELECT n_name AS name, 'nation' AS kind FROM nation UNION ALL SELECT r_name, 'region' FROM region) GROUP BY name, kind")
def vocabulary_union(spark, sf_dir):
    named = lambda t, c: _t(spark, sf_dir, t).select(F.col(c).alias("name"), F.lit(t).alias("kind"))
    return tables.union_all([named("nation", "n_name"), named("region", "r_name")]).groupBy("name", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS id, concat('"', p_name, '", ', p_type) AS title, p_retailprice AS symmetry, CASE WHEN p_size % 3 > 0 THEN p_size / 50.0::DOUBLE END AS thirds_dist,
CAST(p_size AS INTEGER) AS n_blocks, CAST(NULL AS DOUBLE) AS harmony FROM part"""
)
def csv_round_trip(spark, sf_dir):
    """A metric table written as CSV (quotes doubled, nulls as the files' sentinels) and read again with its types."""
    third = F.when(F.col("p_size") % 3 > 0, F.col("p_size") / 50)
    parts = _t(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit('"'), "p_name", F.lit('", '), "p_type").alias("title"), F.col("p_retailprice").alias("symmetry"),
        third.alias("thirds_dist"), F.col("p_size").cast("int").alias("n_blocks"),
    )
    path = tables.new_path(spark, "metrics")
    tables.write_csv(parts, path, "geometric_composition")
    return tables.read_table(spark, path, "geometric_composition").select("id", "title", "symmetry", "thirds_dist", "n_blocks", "harmony")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'first' ELSE 'second' END AS run, o_totalprice FROM orders")
def resumed_append(spark, sf_dir):
    """A run that ended early, and a second one over everything: rows of the first one stay."""
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    path = tables.new_path(spark, "appended")
    tables.append_once(orders.where("id % 3 = 0").withColumn("run", F.lit("first")), path)
    tables.append_once(orders.withColumn("run", F.lit("second")), path)
    return tables.first_written(spark, path)


@query(
    """WITH d AS (SELECT l_orderkey, l_returnflag AS f, l_quantity * 2 / 100 AS c, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, l_quantity) AS r FROM lineitem)
SELECT l_orderkey, string_agg(concat(f, ':', printf('%.2f', c)), '|' ORDER BY r) FILTER (r <= 10) AS labels, max(f) FILTER (r = 1) AS top, round(max(c) FILTER (r = 1), 4) AS top_conf,
coalesce(max(c) FILTER (f IN ('R', 'A')), 0) AS returned, 0 AS n_boxes, 0 AS n_faces, '' AS label_boxes FROM d GROUP BY l_orderkey"""
)
def recorded_labels(spark, sf_dir):
    """Recorded answers of a label service, one JSON text for each order, to flat rows."""
    entry = F.struct("l_linenumber", F.struct(F.col("l_returnflag").alias("Name"), (F.col("l_quantity") * 2).alias("Confidence")).alias("e"))
    named = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"])
    answers = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.struct(named.alias("Labels"))).alias("l")).withColumn("f", F.lit("{}"))
    flat = responses.label_service(answers, "l", "f", {"returned": ["r", "a"]}, "l_orderkey")
    return flat.select("l_orderkey", "labels", "top", "top_conf", "returned", "n_boxes", "n_faces", "label_boxes")


# ---- texts and boxes ----


@query("SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS total FROM events GROUP BY event_type")
def label_json_explode(spark, sf_dir):
    parsed = _t(spark, sf_dir, "events").select("event_type", F.from_json("props", "struct<k:bigint>").alias("p"))
    return parsed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("p.k").alias("total"))


_ITEMS = "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS q, CAST(l_suppkey % 50 AS INTEGER) AS s, CAST(l_partkey % 40 AS INTEGER) AS p FROM lineitem"


@query(
    f"""WITH i AS ({_ITEMS}) SELECT l_orderkey, count(*) AS n, CAST(sum((s + 1) * (p + 1)) AS DOUBLE) AS area, CAST(max((s + 1) * (p + 1)) AS DOUBLE) AS largest FROM i GROUP BY l_orderkey"""
)
def delimited_parse(spark, sf_dir):
    i = _t(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "cast(l_quantity as int) q", "cast(l_suppkey % 50 as int) s", "cast(l_partkey % 40 as int) p")
    text = F.concat_ws(",", "q", "q", F.col("s") + 1, F.col("p") + 1)
    rows = i.groupBy("l_orderkey").agg(F.concat(F.array_join(F.collect_list(text), "|"), F.lit("|broken,1,2")).alias("boxes"))
    b = rows.select("l_orderkey", B.by_area(B.parse_delimited(F.col("boxes"))).alias("b"))
    area = F.aggregate("b", F.lit(0.0), lambda s, x: s + x[2] * x[3])
    return b.select("l_orderkey", F.size("b").cast("bigint").alias("n"), area.alias("area"), (F.get("b", 0)[2] * F.get("b", 0)[3]).alias("largest"))


def _detections(spark, sf_dir) -> DataFrame:
    """Detections of two engines for each order: odd and even lines. Line numbers may repeat."""
    i = _t(spark, sf_dir, "lineitem")
    box = F.array(F.col("l_quantity") / 100, F.col("l_discount") * 4, F.lit(0.3) + F.col("l_tax"), F.lit(0.2) + F.col("l_discount"))
    entry = F.struct("l_linenumber", F.struct(F.col("l_linestatus").alias("label"), (F.col("l_extendedprice") / 100000).alias("score"), box.alias("box")).alias("d"))
    side = lambda odd: F.transform(F.array_sort(F.collect_list(F.when(F.col("l_linenumber") % 2 == odd, entry))), lambda e: e["d"])
    return i.groupBy("l_orderkey").agg(side(1).alias("a"), side(0).alias("b"))


_SIDES_SQL = """l AS (SELECT l_orderkey AS o, l_linenumber % 2 AS odd, l_linenumber AS line, l_linestatus AS label, l_extendedprice / 100000 AS score,
l_quantity / 100 AS x, l_discount * 4 AS y, 0.3::DOUBLE + l_tax AS w, 0.2::DOUBLE + l_discount AS h FROM lineitem),
d AS (SELECT *, row_number() OVER (PARTITION BY o, odd ORDER BY line, label, score, x, y, w, h) AS n FROM l)"""

# A step for each detection of one side, best score first: its best partner among those that no earlier step used.
_BOXES_SQL = "WITH RECURSIVE " + _SIDES_SQL + """,
a AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY score DESC, n) AS r FROM d WHERE odd = 1),
b AS (SELECT * FROM d WHERE odd = 0),
w AS (SELECT a.o, a.r, b.n, a.score AS sa, b.score AS sb, greatest(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x), 0) * greatest(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y), 0) AS i,
a.w * a.h AS aa, b.w * b.h AS ab FROM a JOIN b ON a.o = b.o AND a.label = b.label),
c AS (SELECT o, r, n, {'iou': least(i / (aa + ab - i), 1), 'n': n, 'sa': sa, 'sb': sb} AS pair FROM w WHERE i / (aa + ab - i) >= 0.3),
t AS (SELECT o, max(r) AS steps FROM c GROUP BY o),
g AS (SELECT o, steps, CAST(0 AS BIGINT) AS r, CAST([] AS BIGINT[]) AS used, CAST(NULL AS STRUCT(iou DOUBLE, n BIGINT, sa DOUBLE, sb DOUBLE)) AS pair FROM t
UNION ALL SELECT g.o, any_value(g.steps), g.r + 1, CASE WHEN max(c.pair) IS NULL THEN any_value(g.used) ELSE list_append(any_value(g.used), max(c.pair).n) END, max(c.pair)
FROM g LEFT JOIN c ON c.o = g.o AND c.r = g.r + 1 AND NOT list_contains(g.used, c.n) WHERE g.r < g.steps GROUP BY g.o, g.r),
m AS (SELECT o, round(pair.iou, 4) AS iou, round(pair.sa, 3) AS sa, round(pair.sb, 3) AS sb FROM g WHERE pair IS NOT NULL)
"""


@query(_BOXES_SQL + "SELECT o AS l_orderkey, count(*) AS n, round(sum(iou), 4) AS total_iou, round(max(least(sa, sb)), 4) AS top_score FROM m GROUP BY o")
def box_iou_agreement(spark, sf_dir):
    def summed(p):
        s, total = B.pair_summary(p), F.aggregate(p, F.lit(0.0), lambda s, x: s + x["iou"])
        return F.struct(s["n"].cast("bigint").alias("n"), F.round(total, 4).alias("total_iou"), F.round(s["top_score"], 4).alias("top_score"))

    # a list of one or none: a filter on the pairs would be pushed down and match everything twice
    matched = F.filter(F.array(B.greedy_match(F.col("a"), F.col("b"), 0.3)), lambda p: F.size(p) > 0)
    return _detections(spark, sf_dir).select("l_orderkey", F.inline(F.transform(matched, summed)))


@query(
    "WITH " + _SIDES_SQL
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY score DESC, n) AS r FROM d WHERE odd = 1 AND score >= 0.2 AND round(w, 4) * round(h, 4) BETWEEN 0.002 AND 0.1)
SELECT o AS l_orderkey, count(*) FILTER (r <= 2) AS n, max(label) FILTER (r = 1) AS top_label, max(score) FILTER (r = 1) AS top_score FROM r GROUP BY o"""
)
def top_k_filter(spark, sf_dir):
    kept = B.top(B.plausible(F.col("a"), max_area=0.1), 2)
    s = _detections(spark, sf_dir).select("l_orderkey", B.summary(kept).alias("s")).where("s.n > 0")
    return s.select("l_orderkey", F.col("s.n").cast("bigint").alias("n"), "s.top_label", "s.top_score")


@query(
    "WITH " + _SIDES_SQL + " SELECT o AS l_orderkey, count(*) AS n_faces, round(sum(w * h), 4) AS face_area, round(max(score), 4) AS max_conf FROM d WHERE odd = 1 GROUP BY o"
)
def face_summary(spark, sf_dir):
    s = _detections(spark, sf_dir).select("l_orderkey", B.face_summary(F.col("a")).alias("s")).where("s.n_faces > 0")
    return s.select("l_orderkey", F.col("s.n_faces").cast("bigint").alias("n_faces"), "s.face_area", "s.max_conf")


@query(
    "WITH " + _SIDES_SQL + " SELECT label, count(*) AS n, round(avg(score), 6) AS score FROM d WHERE odd = 1 GROUP BY label"
)
def detection_explode(spark, sf_dir):
    text = _detections(spark, sf_dir).select(F.to_json("a").alias("boxes"))
    each = text.select(F.explode(B.parse_json(F.col("boxes"))).alias("d"))
    return each.groupBy("d.label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("d.score"), 6).alias("score"))


@query(
    """WITH c AS (SELECT user_id, event_type, count(*) AS k FROM events GROUP BY 1, 2)
SELECT user_id, string_agg(concat(event_type, ':', printf('%.2f', k / 100.0)), '|' ORDER BY event_type) AS tags, coalesce(max(k) FILTER (event_type = 'click'), 0) / 100.0::DOUBLE AS click,
coalesce(max(k) FILTER (event_type IN ('error', 'purchase')), 0) / 100.0::DOUBLE AS best, max(k) / 100.0::DOUBLE AS top_conf FROM c GROUP BY user_id"""
)
def regex_confidence(spark, sf_dir):
    c = _t(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("k"))
    entry = F.struct(F.col("event_type").alias("name"), (F.col("k") / 100).cast("string").alias("conf"))
    rows = c.groupBy("user_id").agg(L.encode_confidences(F.array_sort(F.collect_list(entry))).alias("tags"))
    back = L.decode_confidences(F.col("tags"))
    return rows.select("user_id", "tags", L.confidence_of(F.col("tags"), "click", anchored=True).alias("click"), L.vocabulary_max(back, ["error", "purchase"]).alias("best"), L.top_entry(back)["conf"].alias("top_conf"))


@query(
    """SELECT p_partkey, CASE WHEN lower(trim(p_type)) IN ('promo', 'economy') THEN lower(trim(p_type)) ELSE 'uncertain' END AS kind, substring(trim(replace(p_name, chr(10), ' ')), 1, 8) AS short,
round(least(greatest(p_retailprice / 1777, 0), 1), 4) AS score, greatest(p_size, 0) AS n FROM part"""
)
def label_normalize(spark, sf_dir):
    return _t(spark, sf_dir, "part").select(
        "p_partkey", L.enumerated(F.col("p_type"), ["promo", "economy"]).alias("kind"), L.cleaned(F.col("p_name"), 8).alias("short"),
        L.score01((F.col("p_retailprice") / 1777).cast("string")).alias("score"), L.whole_count(F.col("p_size").cast("string")).alias("n"),
    )


# ---- engines against labels ----

_ENGINES_SQL = """WITH v AS (SELECT d.doc_id, n_chars > 1500 AS long, lang = 'en' AS english, CASE WHEN contains(text, '!!') THEN false WHEN lang <> 'de' THEN true END AS calm, l.quality = 1 AS truth
FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
_CONFUSION_SQL = """count(*) AS n, count(*) FILTER (v AND truth) AS tp, count(*) FILTER (v AND NOT truth) AS fp, count(*) FILTER (NOT v AND truth) AS fn, count(*) FILTER (NOT v AND NOT truth) AS tn,
round(count(*) FILTER (v = truth) / count(*), 6) AS accuracy, round(count(*) FILTER (v AND truth) / nullif(count(*) FILTER (v), 0), 6) AS precision,
round(count(*) FILTER (v AND truth) / nullif(count(*) FILTER (truth), 0), 6) AS recall"""
_ENGINES = ["long", "english", "calm"]


def _engines(spark, sf_dir) -> DataFrame:
    """A boolean for each engine and the human label, for labelled documents."""
    calm = F.when(F.contains(F.col("text"), F.lit("!!")), False).when(F.col("lang") != "de", True)
    docs = _t(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") > 1500).alias("long"), (F.col("lang") == "en").alias("english"), calm.alias("calm"))
    return docs.join(_t(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("truth")), "doc_id")


def _verdicts(spark, sf_dir) -> DataFrame:
    return _engines(spark, sf_dir).unpivot(["doc_id", "truth"], _ENGINES, "engine", "verdict")


@query(
    f"""{_ENGINES_SQL}, u AS (SELECT 'long' AS engine, long AS v, truth FROM v UNION ALL SELECT 'english', english, truth FROM v UNION ALL SELECT 'calm', calm, truth FROM v)
SELECT engine, {_CONFUSION_SQL} FROM u WHERE v IS NOT NULL GROUP BY engine"""
)
def engine_verdicts_confusion(spark, sf_dir):
    rows = _verdicts(spark, sf_dir)
    return evaluate.engine_scores(rows.select("doc_id", "engine", "verdict"), rows.select("doc_id", "truth").distinct(), "doc_id")


@query(
    _ENGINES_SQL
    + ", u AS ("
    + " UNION ALL ".join(
        f"SELECT '{'+'.join(s)}' AS engines, '{rule}' AS rule, {how.join(s)} AS v, truth FROM v WHERE {' AND '.join(f'{e} IS NOT NULL' for e in s)}"
        for s in (("long", "english"), ("long", "calm"), ("english", "calm"), ("long", "english", "calm"))
        for rule, how in (("any", " OR "), ("all", " AND "))
    )
    + f") SELECT engines, rule, {_CONFUSION_SQL} FROM u GROUP BY engines, rule"
)
def engine_combo_any_all(spark, sf_dir):
    return evaluate.combination_scores(_engines(spark, sf_dir), _ENGINES, "truth")


@query(
    f"""{_ENGINES_SQL}, u AS (SELECT 'long' AS engine, long AS v FROM v UNION ALL SELECT 'english', english FROM v UNION ALL SELECT 'calm', calm FROM v)
SELECT engine, count(v) AS n, round(avg(CAST(v AS INTEGER)), 6) AS rate FROM u GROUP BY engine"""
)
def engine_positive_rates(spark, sf_dir):
    return evaluate.positive_rates(_verdicts(spark, sf_dir))


@query(
    f"""{_ENGINES_SQL}, u AS (SELECT doc_id, long AS v FROM v UNION ALL SELECT doc_id, english FROM v UNION ALL SELECT doc_id, calm FROM v),
k AS (SELECT doc_id, CASE WHEN bool_and(v) THEN 'positive' WHEN bool_or(v) THEN 'disagree' ELSE 'negative' END AS kind FROM u WHERE v IS NOT NULL GROUP BY doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY CASE WHEN kind = 'disagree' THEN '' ELSE md5('42|' || CAST(doc_id AS VARCHAR)) END, doc_id) AS r FROM k),
n AS (SELECT greatest(0, 300 - count(*) FILTER (kind = 'disagree')) AS rest FROM k)
SELECT doc_id, kind FROM r, n WHERE r <= CASE kind WHEN 'disagree' THEN 300 WHEN 'positive' THEN rest // 2 ELSE rest - rest // 2 END"""
)
def disagreement_sample(spark, sf_dir):
    return sampling.disagreement_first(_verdicts(spark, sf_dir), "doc_id", "verdict", 300)


@query("SELECT l_returnflag AS verdict, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1")
def verdict_counts(spark, sf_dir):
    reviews = _t(spark, sf_dir, "lineitem").select(F.when(F.col("l_linestatus") == "O", "ok").alias("status"), F.col("l_returnflag").alias("verdict"))
    return evaluate.verdict_counts(reviews)


_USERS_SQL = """WITH c AS (SELECT user_id, event_type, count(*) AS k FROM events GROUP BY 1, 2),
u AS (SELECT user_id, list(event_type) AS truths, arg_max(event_type, (k, event_type)) AS pred FROM c GROUP BY user_id),
s AS (SELECT list_intersect(truths, ['click', 'purchase', 'error']) AS t, pred FROM u WHERE list_has_any(truths, ['click', 'purchase', 'error']))
"""


def _containment(spark, sf_dir):
    c = _t(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("k"))
    users = c.groupBy("user_id").agg(F.collect_set("event_type").alias("truths"), F.max(F.struct("k", "event_type"))["event_type"].alias("pred"))
    return evaluate.containment(users, "truths", "pred", ["click", "purchase", "error"])


@query(_USERS_SQL + "SELECT pred AS label, count(*) AS n, round(count(*) FILTER (list_contains(t, pred)) / count(*), 6) AS precision FROM s GROUP BY pred")
def containment_precision(spark, sf_dir):
    return _containment(spark, sf_dir)[0]


@query(
    _USERS_SQL
    + """, x AS (SELECT unnest(t) AS label, pred, t FROM s) SELECT label, count(*) AS n, round(count(*) FILTER (pred = label) / count(*), 6) AS strict_recall,
round(count(*) FILTER (list_contains(t, pred)) / count(*), 6) AS lenient_recall FROM x GROUP BY label"""
)
def containment_recall(spark, sf_dir):
    return _containment(spark, sf_dir)[1]


@query(_USERS_SQL + ", x AS (SELECT unnest(t) AS label, pred FROM s) SELECT label, pred, count(*) AS n FROM x GROUP BY label, pred")
def containment_breakdown(spark, sf_dir):
    return _containment(spark, sf_dir)[2]


# ---- samples ----

_SAMPLE_SQL = """WITH b AS (SELECT event_id, event_type, value, md5('42|' || CAST(event_id AS VARCHAR)) AS d, CASE WHEN value / 100 < 0.3 THEN 'low' WHEN value / 100 < 0.5 THEN 'mid' ELSE 'high' END AS bucket FROM events)
"""


@query(
    _SAMPLE_SQL
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY d, event_id) AS r FROM b),
q AS (SELECT *, CASE WHEN r > CASE bucket WHEN 'low' THEN 120 WHEN 'mid' THEN 50 ELSE 30 END THEN 1 ELSE 0 END AS late, CASE bucket WHEN 'low' THEN 0 WHEN 'mid' THEN 1 ELSE 2 END AS o FROM r)
SELECT event_id, bucket FROM (SELECT * FROM q ORDER BY late, o, r LIMIT 200)"""
)
def stratified_sample(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    return sampling.stratified(events, sampling.confidence_bucket(F.col("value") / 100), {"low": 0.6, "mid": 0.25, "high": 0.15}, 200, "event_id").select("event_id", "bucket")


@query(
    _SAMPLE_SQL
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY d, event_id) AS r FROM b),
q AS (SELECT *, CASE WHEN r > greatest(1, 200 // (SELECT count(DISTINCT event_type) FROM events)) THEN 1 ELSE 0 END AS late FROM r)
SELECT event_id, event_type FROM (SELECT * FROM q ORDER BY late, d, event_id LIMIT 200)"""
)
def equal_quota_sample(spark, sf_dir):
    return sampling.equal_quota(_t(spark, sf_dir, "events"), "event_type", 200, "event_id").select("event_id", "event_type")


@query(
    _SAMPLE_SQL
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS low FROM b),
q AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY CASE WHEN low <= 14 THEN 0 ELSE 1 END, CASE WHEN low <= 14 THEN low ELSE 0 END, CASE WHEN low <= 14 THEN '' ELSE d END, event_id) AS r FROM r)
SELECT event_id, event_type FROM q WHERE r <= 20"""
)
def lowest_first_sample(spark, sf_dir):
    return sampling.lowest_first(_t(spark, sf_dir, "events"), "event_type", "value", 20, "event_id").select("event_id", "event_type")


# ---- maps, colours, layout, pose, palettes ----


@query(
    """WITH n AS (SELECT l_suppkey AS k, l_extendedprice AS v, min(l_extendedprice) OVER w AS a, max(l_extendedprice) OVER w AS b FROM lineitem WINDOW w AS (PARTITION BY l_suppkey)),
z AS (SELECT k, CASE WHEN b - a < 1e-6 THEN 0 ELSE (v - a) / (b - a) END AS v FROM n)
SELECT k AS l_suppkey, round(avg(v), 4) AS mean_depth, round(quantile_cont(v, 0.95), 4) AS p95_depth, round(stddev_pop(v), 4) AS depth_std, round(avg(CAST(v > 0.7 AS INTEGER)), 4) AS close_area_frac FROM z GROUP BY k"""
)
def depth_summary(spark, sf_dir):
    return heatmap.depth_summary(_t(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_extendedprice").alias("value")), "l_suppkey")


@query(
    """WITH c AS (SELECT l_suppkey AS k, l_linenumber AS y, l_orderkey % 100 AS x, l_extendedprice AS v FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY v DESC, y, x) AS r, count(*) OVER (PARTITION BY k) AS n FROM c)
SELECT k AS l_suppkey, round(max(x) FILTER (r = 1) / 100.0, 4) AS peak_x, round(max(y) FILTER (r = 1) / 8.0, 4) AS peak_y,
round(sum(v) FILTER (r <= greatest(1, floor(n * 0.1))) / sum(v), 4) AS top10pct_mass, round(avg(v), 4) AS mean_saliency FROM r GROUP BY k"""
)
def saliency_summary(spark, sf_dir):
    cells = _t(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_linenumber").alias("y"), (F.col("l_orderkey") % 100).alias("x"), F.col("l_extendedprice").alias("value"))
    return heatmap.saliency_summary(cells, "l_suppkey", F.lit(8.0), F.lit(100.0))


@query(
    """WITH m AS (SELECT l_suppkey AS k, sum(l_quantity * l_extendedprice) / sum(l_extendedprice) AS x, sum(l_discount * l_extendedprice) / sum(l_extendedprice) AS y,
sum(l_quantity * l_quantity * l_extendedprice) / sum(l_extendedprice) AS xx FROM lineitem GROUP BY 1)
SELECT k AS l_suppkey, round(x, 4) AS mass_x, round(y, 4) AS mass_y, round(2 * sqrt(greatest(xx - x * x, 0)), 4) AS spread FROM m"""
)
def weighted_centroid(spark, sf_dir):
    return heatmap.centroid(_t(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity", "l_discount", "l_extendedprice")


@query(
    """WITH p AS (SELECT l_suppkey AS k, (l_quantity - 1) / 49 AS r, l_discount * 10 AS g, l_tax * 12.5 AS b FROM lineitem),
q AS (SELECT *, greatest(r, g, b) AS mx, greatest(r, g, b) - least(r, g, b) AS d, CASE WHEN r <= 0.04045 THEN r / 12.92 ELSE pow((r + 0.055) / 1.055, 2.4) END AS lr,
CASE WHEN g <= 0.04045 THEN g / 12.92 ELSE pow((g + 0.055) / 1.055, 2.4) END AS lg, CASE WHEN b <= 0.04045 THEN b / 12.92 ELSE pow((b + 0.055) / 1.055, 2.4) END AS lb FROM p),
y AS (SELECT *, 0.2126729 * lr + 0.7151522 * lg + 0.0721750 * lb AS yy FROM q),
z AS (SELECT k, 116 * CASE WHEN yy > 0.008856 THEN cbrt(yy) ELSE 7.787 * yy + 16 / 116.0 END - 16 AS l, CASE WHEN mx > 1e-9 THEN d / mx ELSE 0 END AS s, mx AS v,
CASE WHEN d <= 1e-9 THEN 0 WHEN mx = b THEN 60 * ((r - g) / d) + 240 WHEN mx = g THEN 60 * ((b - r) / d) + 120 WHEN g < b THEN 60 * ((g - b) / d) + 360 ELSE 60 * ((g - b) / d) END AS h FROM y),
w AS (SELECT *, v < 0.12 OR l < 15 OR s < 0.15 AS grey FROM z)
SELECT k AS l_suppkey, round(avg(l), 2) AS brightness, round(avg(CAST(l < 20 AS INTEGER)), 4) AS dark_share, round(avg(s), 4) AS saturation,
round(avg(CAST((h >= 345 OR h <= 15) AND s > 0.4 AND v > 0.15 AS INTEGER)), 4) AS red_share, round(avg(CAST((h >= 345 OR h < 15) AND NOT grey AS INTEGER)), 4) AS band_red,
round(avg(CAST(h >= 15 AND h < 70 AND NOT grey AS INTEGER)), 4) AS band_warm, round(avg(CAST(h >= 70 AND h < 170 AND NOT grey AS INTEGER)), 4) AS band_green,
round(avg(CAST(h >= 170 AND h < 260 AND NOT grey AS INTEGER)), 4) AS band_blue, round(avg(CAST(h >= 260 AND h < 345 AND NOT grey AS INTEGER)), 4) AS band_purple,
round(avg(CAST(grey AS INTEGER)), 4) AS band_dark FROM w GROUP BY k"""
)
def color_bands(spark, sf_dir):
    pixels = _t(spark, sf_dir, "lineitem").select("l_suppkey", ((F.col("l_quantity") - 1) / 49).alias("r"), (F.col("l_discount") * 10).alias("g"), (F.col("l_tax") * 12.5).alias("b"))
    return C.colour_metrics(pixels, "l_suppkey")


@query(
    """WITH b AS (SELECT l_suppkey AS k, CAST(floor((l_partkey * 7 % 360) / 10.0) AS INTEGER) AS b, count(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, b DESC) AS r, sum(n) OVER (PARTITION BY k) AS t FROM b),
p AS (SELECT k, b * 10.0 AS h FROM r WHERE r <= 3 AND n > t * 0.03),
c AS (SELECT x.k, least(abs(x.h - y.h), 360 - abs(x.h - y.h)) AS d FROM p x JOIN p y ON x.k = y.k AND x.h < y.h)
SELECT a.k AS l_suppkey, round(coalesce(1 - m, -1), 4) AS harmony FROM (SELECT DISTINCT k FROM b) a
LEFT JOIN (SELECT k, avg(least(abs(d - 30), abs(d - 90), abs(d - 120), abs(d - 180)) / 180) AS m FROM c GROUP BY k) o ON o.k = a.k"""
)
def hue_harmony(spark, sf_dir):
    hues = _t(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_partkey") * 7 % 360).alias("hue"))
    return heatmap.hue_harmony(hues, "l_suppkey")


@query(
    """WITH b AS (SELECT l_orderkey AS o, row_number() OVER () AS n, l_quantity AS x0, l_quantity + l_linenumber * 5 AS x1, l_discount * 100 AS y0, l_discount * 100 + l_tax * 100 AS y1 FROM lineitem),
e AS (SELECT o, n, unnest([x0 / 97, (x0 + x1) / 2 / 97, x1 / 97, y0 / 53, (y0 + y1) / 2 / 53, y1 / 53]) AS v, unnest([0, 1, 2, 3, 4, 5]) AS line FROM b),
d AS (SELECT p.o, p.n, p.line, min(abs(p.v - q.v)) AS d FROM e p JOIN e q ON p.o = q.o AND p.line = q.line AND p.n <> q.n GROUP BY 1, 2, 3)
SELECT a.o AS l_orderkey, CAST(a.c AS INTEGER) AS n_blocks, round(coalesce(m, -1), 4) AS align_score FROM (SELECT o, count(*) AS c FROM b GROUP BY o) a LEFT JOIN (SELECT o, avg(d) AS m FROM d GROUP BY o) s ON s.o = a.o"""
)
def layout_alignment(spark, sf_dir):
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    blocks = _t(spark, sf_dir, "lineitem").select("l_orderkey", q.alias("x0"), (q + n * 5).alias("x1"), (F.col("l_discount") * 100).alias("y0"), (F.col("l_discount") * 100 + F.col("l_tax") * 100).alias("y1"))
    return heatmap.layout_alignment(blocks, "l_orderkey", F.lit(97.0), F.lit(53.0))


@query(
    """WITH k AS (SELECT p_partkey AS id, i, CAST(p_partkey * (i + 3) % 97 AS DOUBLE) AS x, CAST(p_partkey * (i + 7) % 89 AS DOUBLE) AS y, (p_partkey * (i + 1) % 11) / 10.0::DOUBLE AS s FROM part, range(0, 17) t(i)),
m AS (SELECT id, count(*) FILTER (s >= 0.3) AS n, bool_and(s >= 0.3) FILTER (i IN (5, 6, 11, 12)) AS torso, avg(x) FILTER (i IN (5, 6, 11, 12)) AS tx, avg(y) FILTER (i IN (5, 6, 11, 12)) AS ty,
avg(x) FILTER (s >= 0.3) AS mx, avg(y) FILTER (s >= 0.3) AS my, (max(x) FILTER (s >= 0.3) - min(x) FILTER (s >= 0.3)) * (max(y) FILTER (s >= 0.3) - min(y) FILTER (s >= 0.3)) AS area, avg(s) AS conf FROM k GROUP BY id),
d AS (SELECT k.id, i, s, sqrt(pow(x - CASE WHEN torso THEN tx ELSE mx END, 2) + pow(y - CASE WHEN torso THEN ty ELSE my END, 2)) AS d FROM k JOIN m ON m.id = k.id),
p AS (SELECT l.id, avg(abs(l.d - r.d) / 100) AS off FROM d l JOIN d r ON l.id = r.id AND l.i % 2 = 1 AND r.i = l.i + 1 AND l.s >= 0.3 AND r.s >= 0.3 GROUP BY l.id)
SELECT m.id AS p_partkey, CASE WHEN n >= 3 THEN round(area / 9000, 4) END AS kpt_bbox_area_frac, CASE WHEN n >= 3 THEN round(off, 4) END AS limb_asymmetry, round(conf, 3) AS mean_kpt_confidence
FROM m LEFT JOIN p ON p.id = m.id"""
)
def keypoint_summary(spark, sf_dir):
    place = lambda k: F.array((F.col("p_partkey") * (k + 3) % 97).cast("double"), (F.col("p_partkey") * (k + 7) % 89).cast("double"), (F.col("p_partkey") * (k + 1) % 11) / 10)
    # the table is small in bytes and may be one split, its rows take work: they are dealt to all cores
    keys = _t(spark, sf_dir, "part").select("p_partkey").repartition(3 * spark.sparkContext.defaultParallelism, "p_partkey")
    parts = keys.select("p_partkey", F.array(*[place(k) for k in range(17)]).alias("k"))
    return parts.select("p_partkey", pose.summary(F.col("k"), F.array(F.lit(0.0), F.lit(0.0), F.lit(100.0), F.lit(90.0))).alias("s")).select("p_partkey", "s.*")


@query()
def palette_kmeans(spark, sf_dir):
    rows = _t(spark, sf_dir, "embeddings").select("label", F.lit(1.0).alias("w"), *[F.get("embedding", i).cast("double").alias(f"x{i}") for i in range(3)])
    return palette.palettes(rows, "label", ["x0", "x1", "x2"], "w")


# ---- time ----


@query("SELECT time_bucket(INTERVAL '1 day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_windows(spark, sf_dir):
    return incremental.windowed(_t(spark, sf_dir, "events"), "ts", ["event_type"], "value", "1 day")


@query(
    """SELECT time_bucket(INTERVAL '6 hours', ts) - INTERVAL '6 hours' * k AS start, event_type, count(*) AS n, round(sum(value), 4) AS total
FROM events, range(0, 4) t(k) GROUP BY 1, 2"""
)
def sliding_windows(spark, sf_dir):
    return incremental.windowed(_t(spark, sf_dir, "events"), "ts", ["event_type"], "value", "1 day", "6 hours")


@query(
    """WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '12 hours' THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM a)
SELECT user_id, min(ts) AS start, max(ts) AS "end", count(*) AS n FROM s GROUP BY user_id, s"""
)
def session_windows(spark, sf_dir):
    return incremental.sessions(_t(spark, sf_dir, "events"), "ts", ["user_id"], "12 hours")


@query(
    """SELECT l.event_id, l.user_id, l.ts, r.event_id AS r_event_id, r.value AS r_value FROM (SELECT * FROM events WHERE event_type = 'purchase') l
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') r ON l.user_id = r.user_id AND l.ts >= r.ts"""
)
def as_of_join(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return time_joins.as_of(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.where("event_type = 'click'").select("user_id", "ts", "event_id", "value"), "user_id", "ts", ["event_id", "value"])


@query(
    """SELECT l.event_id AS l_event_id, r.event_id AS r_event_id FROM events l JOIN events r ON l.user_id = r.user_id AND l.event_type = 'purchase' AND r.event_type = 'error'
AND r.ts <= l.ts AND l.ts - r.ts < INTERVAL '6 hours'"""
)
def interval_join(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    pairs = time_joins.within(e.where("event_type = 'purchase'"), e.where("event_type = 'error'"), "user_id", "ts", 6 * 3600)
    return pairs.select("l_event_id", "r_event_id")


# ---- answers whose shape can't be trusted ----


@query(
    """WITH l AS (SELECT *, l_partkey % 8 AS kind FROM lineitem), g AS (SELECT *, CASE kind WHEN 5 THEN CAST(l_linenumber AS VARCHAR) ELSE l_linestatus END AS label, CASE kind WHEN 5 THEN 0 ELSE l_discount END AS score
FROM l WHERE kind IN (0, 1, 5) AND l_orderkey % 11 > 0)
SELECT o.l_orderkey, count(label) AS n, coalesce(string_agg(label, '' ORDER BY label), '') AS labels, round(coalesce(sum(score), 0), 4) AS score, round(coalesce(sum(l_tax), 0), 4) AS width
FROM (SELECT DISTINCT l_orderkey FROM lineitem) o LEFT JOIN g ON o.l_orderkey = g.l_orderkey GROUP BY o.l_orderkey"""
)
def broken_detections(spark, sf_dir):
    """Lists of detections with entries that are no objects, numbers in texts, boxes and scores that are none, and texts that end early."""
    label, score = F.concat(F.lit('{"label": "'), "l_linestatus", F.lit('", ')), F.col("l_discount").cast("string")
    numbers = lambda mark: F.concat(F.lit('"box": ['), F.concat_ws(",", *(F.concat(F.lit(mark), F.col(c).cast("string"), F.lit(mark)) for c in ("l_discount", "l_quantity", "l_tax", "l_quantity"))), F.lit("]"))
    kind = F.col("l_partkey") % 8
    entry = (
        F.when(kind == 0, F.concat(label, F.lit('"score": '), score, F.lit(", "), numbers(""), F.lit("}")))
        .when(kind == 1, F.concat(label, F.lit('"score": "'), score, F.lit('", '), numbers('"'), F.lit("}")))
        .when(kind == 2, "5").when(kind == 3, '"x"').when(kind == 4, F.concat(label, F.lit('"score": 1, "box": [1, 2, 3]}')))
        .when(kind == 5, F.concat(F.lit('{"label": '), F.col("l_linenumber").cast("string"), F.lit(", "), numbers(""), F.lit("}")))
        .when(kind == 6, F.concat(label, F.lit('"score": "high", '), numbers(""), F.lit("}"))).otherwise("null")
    )
    whole = F.concat(F.lit("["), F.array_join(F.collect_list(entry), ", "), F.when(F.col("l_orderkey") % 11 > 0, "]").otherwise(""))
    boxes = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(whole.alias("t")).select("l_orderkey", B.parse_json(F.col("t")).alias("d"))
    total = lambda of: F.round(F.aggregate("d", F.lit(0.0), lambda s, d: s + of(d)), 4)
    labels = F.array_join(F.array_sort(F.transform("d", lambda d: d["label"])), "")
    return boxes.select("l_orderkey", F.size("d").cast("bigint").alias("n"), labels.alias("labels"), total(lambda d: d["score"]).alias("score"), total(lambda d: d["box"][2]).alias("width"))


@query(
    """SELECT event_id, CASE WHEN event_id % 6 = 5 THEN '' WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 3 = 1 THEN concat(event_type, '|7') ELSE '' END AS mood,
CASE WHEN event_id % 6 = 5 THEN 0 ELSE round(least(value / 50, 1), 4) END AS weapon, CASE WHEN event_id % 6 = 5 THEN 0 WHEN event_id % 2 = 0 THEN CAST(event_id % 9 AS INTEGER) ELSE 0 END AS face_count,
CASE event_id % 6 WHEN 5 THEN '' WHEN 0 THEN concat(event_type, ':0.50|plain|3|second:high') WHEN 1 THEN event_type ELSE concat(event_type, ':', printf('%.2f', floor(value) / 100), '|other:0.25') END AS labels,
CASE event_id % 6 WHEN 5 THEN '' WHEN 0 THEN event_type WHEN 1 THEN '' ELSE CASE WHEN floor(value) >= 25 THEN event_type ELSE 'other' END END AS top_label,
CASE event_id % 6 WHEN 5 THEN 0 WHEN 0 THEN 0.5 WHEN 1 THEN 0 ELSE greatest(floor(value) / 100, 0.25) END AS top_label_conf,
CASE WHEN event_id % 6 <> 5 AND event_id % 4 = 0 THEN 'poster' ELSE 'uncertain' END AS qa_verdict, CASE WHEN event_id % 6 = 5 THEN 'not a JSON object' END AS error FROM events"""
)
def scene_responses(spark, sf_dir):
    """Recorded scene descriptions, one for each event: fenced or bare, with single values for lists, numbers in texts and mixed entries."""
    e, k = _t(spark, sf_dir, "events"), F.col("event_id")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    kind = quoted(F.col("event_type"))
    mood = F.when(k % 3 == 0, kind).when(k % 3 == 1, F.concat(F.lit("["), kind, F.lit(', "  ", 7]'))).otherwise("null")
    labels = (
        F.when(k % 6 == 0, F.concat(F.lit('[{"name": '), kind, F.lit(', "conf": "0.5"}, "plain", 3, {"conf": 1}, {"name": "second", "confidence": "high"}]')))
        .when(k % 6 == 1, kind)
        .otherwise(F.concat(F.lit('[{"name": '), kind, F.lit(', "confidence": '), (F.floor("value") / 100).cast("string"), F.lit('}, {"name": " other", "conf": 0.25}]')))
    )
    faces = F.when(k % 2 == 0, quoted((k % 9 + F.lit(0.5)).cast("string"))).otherwise('["many"]')
    parts = [F.lit('{"mood": '), mood, F.lit(', "labels": '), labels, F.lit(', "weapon": '), quoted((F.col("value") / 50).cast("string")), F.lit(', "face_count": '), faces, F.lit(', "poster_qa_verdict": '), F.when(k % 4 == 0, '" Poster"').otherwise("4"), F.lit("}")]
    whole = F.concat(*parts)
    text = F.when(k % 6 == 5, "I can't say.").when(k % 6 == 4, F.concat(F.lit("```json\n"), whole, F.lit("\n```"))).otherwise(whole)
    found = responses.scene_service(e.select("event_id", text.alias("t")), "t", "event_id")
    return found.select("event_id", "mood", "weapon", "face_count", "labels", "top_label", "top_label_conf", "qa_verdict", "error")


_PART_BOXES_SQL = """b AS (SELECT l_partkey AS k, l_extendedprice / 100000 AS score, l_quantity / 100 AS x, l_discount * 4 AS y, 0.1::DOUBLE + l_tax AS w, 0.05::DOUBLE + l_discount AS h FROM lineitem WHERE l_extendedprice / 100000 >= 0.6)"""


@query(
    f"""WITH RECURSIVE {_PART_BOXES_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, x, y, w, h) AS r FROM b),
g AS (SELECT k, r, [{{'r': r, 'x': x, 'y': y, 'w': w, 'h': h, 'score': score}}] AS kept FROM s WHERE r = 1
UNION ALL SELECT s.k, s.r, CASE WHEN len(list_filter(kept, lambda o: greatest(least(o.x + o.w, s.x + s.w) - greatest(o.x, s.x), 0) * greatest(least(o.y + o.h, s.y + s.h) - greatest(o.y, s.y), 0)
    > 0.3 * (o.w * o.h + s.w * s.h - greatest(least(o.x + o.w, s.x + s.w) - greatest(o.x, s.x), 0) * greatest(least(o.y + o.h, s.y + s.h) - greatest(o.y, s.y), 0)))) = 0
    THEN list_append(kept, {{'r': s.r, 'x': s.x, 'y': s.y, 'w': s.w, 'h': s.h, 'score': s.score}}) ELSE kept END FROM g JOIN s ON s.k = g.k AND s.r = g.r + 1),
f AS (SELECT k, unnest(arg_max(kept, r)) AS o FROM g GROUP BY k)
SELECT k AS l_partkey, CAST(o.r AS INTEGER) AS place, o.score AS score, o.x AS x, o.w * o.h AS area FROM f"""
)
def box_suppression(spark, sf_dir):
    """The boxes of each part's lines that stay when overlapping ones are suppressed."""
    box = F.array(F.col("l_quantity") / 100, F.col("l_discount") * 4, F.lit(0.1) + F.col("l_tax"), F.lit(0.05) + F.col("l_discount"))
    lines = _t(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_extendedprice") / 100000).alias("score"), box.alias("box"))
    kept = suppression.suppressed(lines, ["l_partkey"])
    return kept.select("l_partkey", "place", "score", F.col("box")[0].alias("x"), (F.col("box")[2] * F.col("box")[3]).alias("area"))


# ---- connectors, lookups, draws, streams ----


@query("SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS width, round(CAST(embedding[1] AS DOUBLE), 5) AS first, round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE))), 3) AS total FROM embeddings")
def npz_round_trip(spark, sf_dir):
    """Embeddings written as NPZ caches and read again, a partition a file."""
    spark.dataSource.register(npz.NpzDataSource)
    path = tables.new_path(spark, "cache")
    rows = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<float>").alias("vec"))
    rows.write.format("npz").mode("append").save(path)
    total = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double"))
    return spark.read.format("npz").load(path).select("id", F.size("vec").alias("width"), F.round(F.get("vec", 0).cast("double"), 5).alias("first"), F.round(total, 3).alias("total"))


@query("WITH " + _SIDES_SQL + " SELECT o AS l_orderkey, CAST(row_number() OVER (PARTITION BY o ORDER BY n) - 1 AS INTEGER) AS place, label, score, x, y, w, h FROM d WHERE odd = 1")
def detections_lateral(spark, sf_dir):
    """The detections of each order by the SQL table function."""
    udtf.register(spark)
    boxes = _detections(spark, sf_dir).select("l_orderkey", F.to_json("a").alias("boxes"))
    return spark.sql("SELECT t.l_orderkey, d.* FROM {boxes} t, LATERAL detections(t.boxes) d", boxes=boxes)


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 40)")
def wanted_lines(spark, sf_dir):
    """Lines of large parts, found by bitmaps of the parts' keys while lines are read."""
    large = _t(spark, sf_dir, "part").where("p_size > 40").select("p_partkey")
    return bitmaps.wanted(_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), large, "l_partkey", "p_partkey")


@query(
    """WITH w AS (SELECT l_returnflag AS k, l_quantity AS a, l_discount AS b, sum(CAST(floor((0.25::DOUBLE + l_tax) * 1000000) AS BIGINT)) AS w, count(*) AS c FROM lineitem GROUP BY ALL),
e AS (SELECT *, sum(w) OVER (PARTITION BY k ORDER BY a, b) AS upto, sum(w) OVER (PARTITION BY k) AS total, least(sum(c) OVER (PARTITION BY k), 4000) AS n FROM w),
r AS (SELECT k, floor(CAST('0x' || substr(md5('42|' || k || '|' || j), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE * total) AS r FROM (SELECT DISTINCT k, total, n FROM e), range(4000) t(j) WHERE j < n)
SELECT e.k AS l_returnflag, a AS l_quantity, b AS l_discount, count(*) AS times FROM e JOIN r ON e.k = r.k AND r.r >= upto - w AND r.r < upto GROUP BY ALL"""
)
def palette_draws(spark, sf_dir):
    """Weighted draws with replacement from the lines of each return flag, as palettes take them."""
    rows = _t(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_discount", (F.lit(0.25) + F.col("l_tax")).alias("w"))
    return palette.draws(rows, "l_returnflag", ["l_quantity", "l_discount"], "w")


def _as_folder(spark, sf_dir: str, name: str) -> DataFrame:
    """A table as files that arrive: written to a folder, and read as a stream."""
    rows = _t(spark, sf_dir, name)
    path = tables.new_path(spark, f"arriving-{name}")
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


@query(
    """SELECT time_bucket(INTERVAL '1 day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events
GROUP BY 1, 2 HAVING time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events)"""
)
def streamed_windows(spark, sf_dir):
    """Daily windows of a stream: those that the watermark has closed when all files have been read."""
    out, held = tables.new_path(spark, "windows"), tables.new_path(spark, "windows-state")
    # watermarks need instants: the times are taken as UTC, and given back without a zone
    events = _as_folder(spark, sf_dir, "events").withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))
    days = incremental.windowed(events, "ts", ["event_type"], "value", "1 day", late="10 minutes")
    q = days.writeStream.format("parquet").option("path", out).option("checkpointLocation", held).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    start = F.to_utc_timestamp("start", F.current_timezone()).cast("timestamp_ntz").alias("start")
    return spark.read.schema(days.schema).parquet(out).select(start, "event_type", "n", "total")


@query("SELECT p_partkey, CASE WHEN p_size % 7 > 0 THEN concat(p_brand, ' ', p_type) END AS verdict, CASE WHEN p_size % 7 > 0 THEN 'ok' ELSE 'error' END AS status, 1::INTEGER AS tries FROM part")
def reviewed_stream(spark, sf_dir):
    """Each part reviewed once on a stream; reviews that fail are rows with an error, and stay to be tried again."""
    out, held, store = tables.new_path(spark, "reviews"), tables.new_path(spark, "reviews-state"), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, reviews.STORE)
    try:
        found = reviews.reviewed(_as_folder(spark, sf_dir, "part"), _Brands(), "p_partkey", wait_ms=3_600_000)
        found.writeStream.format("parquet").option("path", out).option("checkpointLocation", held).trigger(once=True).start().awaitTermination()
    finally:
        spark.conf.set(store, before)
    return spark.read.parquet(out).select("p_partkey", "verdict", "status", "tries")


class _Brands:
    """A provider that reads a part's brand and type, and fails on every seventh size."""

    name, revision, output = "brands", "1", "verdict string"

    def infer(self, batch):
        if (batch["p_size"] % 7 == 0).any():
            raise ValueError("no answer for this size")
        return (batch["p_brand"] + " " + batch["p_type"]).to_frame("verdict")


# ---- phrases, boxes in pixels, colours, engines without ids ----

_PHRASES = ["economy", "red widget", "ring", "standard plus", "small"]


@query(
    """WITH p AS (SELECT *, lower(trim(p_name)) AS t, concat('x', lower(p_brand), ':0.', p_size % 10, '|', lower(p_brand), ':0.9') AS tags FROM part),
v AS (SELECT *, CASE WHEN list_contains(v, t) THEN t ELSE list_filter(v, lambda p: t <> '' AND (contains(t, p) OR contains(p, t)))[1] END AS phrase FROM p, (SELECT ['economy', 'red widget', 'ring', 'standard plus', 'small'] AS v))
SELECT p_partkey, phrase, concat(lower(trim(p_name)), '. ', lower(trim(p_type)), '.') AS caption, p_type AS original, CASE WHEN lower(p_brand) = 'brand#2' THEN CAST(concat('0.', p_size % 10) AS DOUBLE) ELSE 0 END AS loose,
CASE WHEN lower(p_brand) = 'brand#2' THEN 0.9 ELSE 0 END AS strict, CASE WHEN p_size % 5 > 0 THEN CAST(1900 + p_size AS INTEGER) END AS year, CASE WHEN p_size % 3 = 0 THEN 'none' ELSE trim(p_type) END AS compared FROM v"""
)
def label_phrases(spark, sf_dir):
    """Phrases out of free texts, captions and back, confidences with and without an anchor, years."""
    p = _t(spark, sf_dir, "part")
    tags = F.concat(F.lit("x"), F.lower("p_brand"), F.lit(":0."), F.col("p_size") % 10, F.lit("|"), F.lower("p_brand"), F.lit(":0.9"))
    phrases = F.array("p_name", "p_type")
    year = F.when(F.col("p_size") % 5 > 0, F.concat((F.col("p_size") + 1900).cast("string"), F.lit(".0"))).otherwise("unknown")
    return p.withColumn("tags", tags).select(
        "p_partkey", L.matched_phrase(F.col("p_name"), _PHRASES).alias("phrase"), L.caption(phrases).alias("caption"),
        L.caption_lookup(phrases)[F.lower(F.trim("p_type"))].alias("original"),
        L.confidence_of(F.col("tags"), "brand#2").alias("loose"), L.confidence_of(F.col("tags"), "brand#2", anchored=True).alias("strict"),
        L.year(year).alias("year"), L.comparable(F.when(F.col("p_size") % 3 == 0, " uncertain").otherwise(F.col("p_type"))).alias("compared"),
    )


@query(
    """WITH l AS (SELECT l_orderkey AS o, l_linenumber AS n, l_quantity * 20 - 100 AS a, l_partkey % 700::DOUBLE AS b, l_suppkey * 7::DOUBLE AS c, l_quantity * 11::DOUBLE AS d FROM lineitem),
s AS (SELECT *, least(a, c) AS x0, greatest(a, c) AS x1, least(b, d) AS y0, greatest(b, d) AS y1 FROM l),
r AS (SELECT *, round(greatest(x0, 0) / 700, 4) AS x, round(greatest(y0, 0) / 600, 4) AS y, round(greatest(x1 - x0, 0) / 700, 4) AS w, round(greatest(y1 - y0, 0) / 600, 4) AS h, round(greatest(c - a, 0) / 700, 4) AS uw FROM s),
p AS (SELECT *, CAST(greatest(floor((x - w * 0.25::DOUBLE) * 700), 0) AS INTEGER) AS l, CAST(greatest(floor((y - h * 0.25::DOUBLE) * 600), 0) AS INTEGER) AS t,
CAST(least(ceil((x + w + w * 0.25::DOUBLE) * 700), 700) AS INTEGER) AS e, CAST(least(ceil((y + h + h * 0.25::DOUBLE) * 600), 600) AS INTEGER) AS u FROM r)
SELECT o AS l_orderkey, n AS l_linenumber, x, y, w, h, uw, CASE WHEN e <= l OR u <= t THEN 0 ELSE l END AS x0, CASE WHEN e <= l OR u <= t THEN 0 ELSE t END AS y0,
CASE WHEN e <= l OR u <= t THEN 700 ELSE e END AS x1, CASE WHEN e <= l OR u <= t THEN 600 ELSE u END AS y1 FROM p"""
)
def box_conversions(spark, sf_dir):
    """Corners in pixels to boxes in shares, with corners in either order and as they come, and crops with padding."""
    corners = (F.col("l_quantity") * 20 - 100, (F.col("l_partkey") % 700).cast("double"), F.col("l_suppkey") * F.lit(7.0), F.col("l_quantity") * 11)
    size = (F.lit(700.0), F.lit(600.0))
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", B.from_corners(*corners, *size).alias("b"), B.from_corners(*corners, *size, sort=False)[2].alias("uw"))
    crop = B.padded_crop(F.col("b"), *size)
    return rows.select("l_orderkey", "l_linenumber", *[F.col("b")[i].alias(n) for i, n in enumerate("xywh")], "uw", *[crop[n].alias(n) for n in ("x0", "y0", "x1", "y1")])


@query(
    """WITH p AS (SELECT l_orderkey AS o, l_linenumber AS n, l_quantity * 2::DOUBLE AS l, l_discount * 800 - 40 AS a, l_tax * 900 - 36 AS b FROM lineitem),
f AS (SELECT *, (l + 16) / 116 AS fy, (l + 16) / 116 + a / 500 AS fx, (l + 16) / 116 - b / 200 AS fz FROM p),
q AS (SELECT o, n, CASE WHEN fx ** 3 > 0.008856 THEN fx ** 3 ELSE (fx - 16 / 116.0::DOUBLE) / 7.787 END * 0.95047 AS x, CASE WHEN fy ** 3 > 0.008856 THEN fy ** 3 ELSE (fy - 16 / 116.0::DOUBLE) / 7.787 END AS y,
CASE WHEN fz ** 3 > 0.008856 THEN fz ** 3 ELSE (fz - 16 / 116.0::DOUBLE) / 7.787 END * 1.08883 AS z FROM f),
c AS (SELECT o, n, [x * 3.2404542 + y * -1.5371385 + z * -0.4985314, x * -0.9692660 + y * 1.8760108 + z * 0.0415560, x * 0.0556434 + y * -0.2040259 + z * 1.0572252] AS c FROM q)
SELECT o AS l_orderkey, n AS l_linenumber, '#' || array_to_string(list_transform(c, lambda v: printf('%02x', CAST(floor(least(greatest(CASE WHEN v <= 0.0031308 THEN v * 12.92 ELSE greatest(v, 0) ** (1 / 2.4::DOUBLE) * 1.055 - 0.055 END, 0), 1) * 255) AS INTEGER))), '') AS hex FROM c"""
)
def lab_hexes(spark, sf_dir):
    """CIELAB values to colours, channels clipped and cut."""
    lines = _t(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", C.hex_of_lab(F.col("l_quantity") * 2, F.col("l_discount") * 800 - 40, F.col("l_tax") * 900 - 36).alias("hex"))


@query(
    """WITH e AS (SELECT event_type AS engine, user_id AS id FROM events UNION ALL SELECT 'elsewhere', -1 - user_id FROM events)
SELECT engine, count(DISTINCT CASE WHEN id IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) THEN id END) AS n, bool_or(id IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)) AS scored FROM e GROUP BY engine"""
)
def engine_overlap(spark, sf_dir):
    """How many of the base's ids each engine has; one that has none isn't scored."""
    e = _t(spark, sf_dir, "events")
    verdicts = e.select(F.col("event_type").alias("engine"), F.col("user_id").alias("id")).union(e.select(F.lit("elsewhere"), -1 - F.col("user_id")))
    return evaluate.overlap(verdicts, _t(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id")), "id")
