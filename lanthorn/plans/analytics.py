"""Analytics module bound to the driver tables.

The passenger table is ``orders`` joined to ``customer`` with line-item
counts: survived = order status 'F', class = nation mod 3 + 1, sex =
market segment, age = account balance (null for every 5th order key),
sibsp / parch = line items / returned line items, fare = total price,
embarked = priority (null for every 400th key), deck = segment on every
4th key only (75 % null), alone = no line items.  Null shares are thus
20 %, 0.25 % and 75 %: one column per branch of the missing-value policy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanthorn.operators import evaluate as ev
from lanthorn.operators import features as fe
from lanthorn.operators import profile as pr
from lanthorn.operators import relational as rel
from lanthorn.plans.registry import query
from lanthorn.session import read_table

CORR_COLUMNS = ["survived", "pclass", "age", "sibsp", "parch", "fare"]


def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    li = read_table(spark, sf_dir, "lineitem")
    items = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count(F.when(F.col("l_returnflag") == "R", F.lit(1))).alias("n_returned"))
    k = F.col("o_orderkey")
    j = o.join(c, o.o_custkey == c.c_custkey).join(items, k == F.col("l_orderkey"), "left")
    return j.select(
        k.alias("passenger_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("survived"),
        (F.col("c_nationkey") % 3 + 1).cast("int").alias("pclass"),
        F.col("c_mktsegment").alias("sex"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("age"),
        F.coalesce("n_items", F.lit(0)).cast("int").alias("sibsp"),
        F.coalesce("n_returned", F.lit(0)).cast("int").alias("parch"),
        F.col("o_totalprice").alias("fare"),
        F.when(k % 400 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
         .alias("embarked"),
        F.when(k % 4 == 0, F.col("c_mktsegment")).alias("deck"),
        (F.coalesce("n_items", F.lit(0)) == 0).alias("alone"),
    )


def cleaned(spark, sf_dir) -> DataFrame:
    return pr.apply_missing_policy(passengers(spark, sf_dir))


def split(spark, sf_dir) -> DataFrame:
    return fe.stratified_split(passengers(spark, sf_dir), "survived", "passenger_id")


def r6(c):
    return F.round(c, 6) + F.lit(0.0)


def r9(c):
    return F.round(c, 9) + F.lit(0.0)


PASSENGERS_SQL = """
passengers AS (
  SELECT o.o_orderkey AS passenger_id, CAST(o.o_orderstatus = 'F' AS INTEGER) AS survived,
    CAST(c.c_nationkey % 3 + 1 AS INTEGER) AS pclass, c.c_mktsegment AS sex,
    CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE c.c_acctbal END AS age,
    CAST(coalesce(li.n_items, 0) AS INTEGER) AS sibsp,
    CAST(coalesce(li.n_returned, 0) AS INTEGER) AS parch, o.o_totalprice AS fare,
    CASE WHEN o.o_orderkey % 400 = 0 THEN NULL ELSE o.o_orderpriority END AS embarked,
    CASE WHEN o.o_orderkey % 4 = 0 THEN c.c_mktsegment END AS deck,
    coalesce(li.n_items, 0) = 0 AS alone
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_items,
                    count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned
             FROM lineitem GROUP BY l_orderkey) li ON li.l_orderkey = o.o_orderkey),
cleaned AS (
  SELECT passenger_id, survived, pclass, sex,
         coalesce(age, (SELECT quantile_cont(age, 0.5) FROM passengers)) AS age,
         sibsp, parch, fare, embarked, alone
  FROM passengers WHERE embarked IS NOT NULL),
alloc0 AS (
  SELECT survived, count(*) AS n_label FROM passengers GROUP BY survived),
alloc1 AS (
  SELECT survived, n_label, ceil(sum(n_label) OVER () * 0.2) AS test,
         ceil(sum(n_label) OVER () * 0.2) * n_label / sum(n_label) OVER () AS exact FROM alloc0),
alloc2 AS (
  SELECT survived, floor(exact) AS base, exact - floor(exact) AS frac,
         test - sum(floor(exact)) OVER () AS left_over FROM alloc1),
alloc AS (
  SELECT survived, CAST(base + CASE WHEN row_number() OVER (ORDER BY frac DESC, survived) <= left_over
                                THEN 1 ELSE 0 END AS BIGINT) AS n_test FROM alloc2),
split AS (
  SELECT p.*, CASE WHEN row_number() OVER (PARTITION BY p.survived
                        ORDER BY md5(CAST(p.passenger_id AS VARCHAR)), p.passenger_id) <= a.n_test
                   THEN 'test' ELSE 'train' END AS split
  FROM passengers p JOIN alloc a USING (survived))
"""


def _with(body: str) -> str:
    return "WITH " + PASSENGERS_SQL.strip() + "\n" + body


def _u_sql(expr: str) -> str:
    return f"CAST(('0x' || substr(md5({expr}), 1, 8)) AS BIGINT) / 4294967296.0"


SCORE_MODELS = {"mix_35": 0.35, "mix_50": 0.5, "mix_20": 0.2}


def scored(spark, sf_dir) -> DataFrame:
    """Test split with three deterministic score columns (label mixed with md5 noise)."""
    test = split(spark, sf_dir).filter(F.col("split") == "test")
    u = fe.md5_unit(F.col("passenger_id"))
    out = test
    for name, w in SCORE_MODELS.items():
        out = out.withColumn(f"score_{name}", F.lit(w) * F.col("survived") + F.lit(1 - w) * u)
    return out


def _scored_sql() -> str:
    u = _u_sql("CAST(passenger_id AS VARCHAR)")
    cols = ", ".join(f"{w} * survived + {1 - w} * {u} AS score_{n}" for n, w in SCORE_MODELS.items())
    return f", scored AS (SELECT *, {cols} FROM split WHERE split = 'test')"


# ------------------------------------------------------------------ profiling
@query("shape", _with("SELECT count(*) AS n_rows, 11 AS n_columns FROM passengers"))
def q_shape(spark, sf_dir):
    return pr.shape(passengers(spark, sf_dir))


_TYPES = [("passenger_id", "bigint"), ("survived", "int"), ("pclass", "int"), ("sex", "string"),
          ("age", "double"), ("sibsp", "int"), ("parch", "int"), ("fare", "double"),
          ("embarked", "string"), ("deck", "string"), ("alone", "boolean")]


@query("column_info", _with(" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null FROM passengers"
    for i, (c, t) in enumerate(_TYPES))))
def q_column_info(spark, sf_dir):
    return pr.column_info(passengers(spark, sf_dir))


_NUM = ["passenger_id", "survived", "pclass", "age", "sibsp", "parch", "fare"]


@query("describe_numeric", _with(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) + 0.0 AS mean,
        round(stddev_samp({c}), 6) + 0.0 AS std, round(min({c}), 6) + 0.0 AS min,
        round(quantile_cont({c}, 0.25), 6) + 0.0 AS p25, round(quantile_cont({c}, 0.5), 6) + 0.0 AS p50,
        round(quantile_cont({c}, 0.75), 6) + 0.0 AS p75, round(max({c}), 6) + 0.0 AS max FROM passengers"""
    for c in _NUM)))
def q_describe_numeric(spark, sf_dir):
    d = pr.describe_numeric(passengers(spark, sf_dir))
    return d.select("column", "count", *[r6(F.col(c)).alias(c) for c in
                                         ("mean", "std", "min", "p25", "p50", "p75", "max")])


_MISSING_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0
        / CAST(count(*) AS DOUBLE) AS missing_percentage FROM passengers""" for c, _ in _TYPES)


@query("missing_report", _with(f"SELECT * FROM ({_MISSING_SQL}) WHERE missing_percentage > 0"))
def q_missing_report(spark, sf_dir):
    return pr.missing_report(passengers(spark, sf_dir))


@query("threshold_filter", _with(f"SELECT \"column\" FROM ({_MISSING_SQL}) WHERE missing_percentage > 0"))
def q_threshold_filter(spark, sf_dir):
    rep = pr.missing_report(passengers(spark, sf_dir), only_missing=False)
    return rep.filter(F.col("missing_percentage") > 0).select("column")


@query("missing_policy", _with(f"""
SELECT "column", missing_percentage,
  CASE WHEN missing_percentage < 5 THEN '{pr.DROP_ROWS}'
       WHEN missing_percentage <= 30 AND "column" IN ('passenger_id', 'survived', 'pclass', 'age',
            'sibsp', 'parch', 'fare', 'alone') THEN '{pr.MEDIAN}'
       WHEN missing_percentage <= 30 THEN '{pr.MODE}'
       ELSE '{pr.DROP_COLUMN}' END AS strategy
FROM ({_MISSING_SQL}) WHERE missing_percentage > 0"""))
def q_missing_policy(spark, sf_dir):
    return pr.missing_policy(passengers(spark, sf_dir))


@query("apply_missing_policy", _with("SELECT * FROM cleaned"))
def q_apply_missing_policy(spark, sf_dir):
    return cleaned(spark, sf_dir)


@query("expect_no_nulls_left", _with("""
SELECT 'cleaned has no nulls' AS rule, count(*) FILTER (WHERE passenger_id IS NULL OR survived IS NULL
  OR pclass IS NULL OR sex IS NULL OR age IS NULL OR sibsp IS NULL OR parch IS NULL OR fare IS NULL
  OR embarked IS NULL OR alone IS NULL) AS violations FROM cleaned"""))
def q_expect_no_nulls_left(spark, sf_dir):
    from lanthorn.operators import quality as qa
    return qa.expect_no_nulls_left(cleaned(spark, sf_dir), "cleaned has no nulls")


@query("median", _with("""
SELECT 'age' AS "column", round(quantile_cont(age, 0.5), 6) + 0.0 AS median FROM passengers
UNION ALL SELECT 'fare', round(quantile_cont(fare, 0.5), 6) + 0.0 FROM passengers"""))
def q_median(spark, sf_dir):
    q = pr.exact_quantiles(passengers(spark, sf_dir), ["age", "fare"], [0.5])
    return q.select("column", r6(F.col("quantile")).alias("median"))


@query("mode", _with("""
, counts AS (
  SELECT 'embarked' AS "column", embarked AS v, count(*) AS n FROM passengers WHERE embarked IS NOT NULL
  GROUP BY embarked
  UNION ALL SELECT 'sex', sex, count(*) FROM passengers GROUP BY sex)
SELECT "column", v AS mode, n AS count FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, v) AS rk FROM counts) WHERE rk = 1
""".replace("\n, counts", ", counts")))
def q_mode(spark, sf_dir):
    return pr.modes(passengers(spark, sf_dir), ["embarked", "sex"])


def _iqr_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound,
      q3 + 1.5 * (q3 - q1) AS upper_bound,
      (SELECT count(*) FROM cleaned WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))
        AS outlier_count
    FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM cleaned)"""


@query("iqr_outliers", _with(f"""
SELECT "column", round(q1, 6) + 0.0 AS q1, round(q3, 6) + 0.0 AS q3, round(iqr, 6) + 0.0 AS iqr,
  round(lower_bound, 6) + 0.0 AS lower_bound, round(upper_bound, 6) + 0.0 AS upper_bound, outlier_count
FROM ({_iqr_sql('age')} UNION ALL {_iqr_sql('fare')})"""))
def q_iqr_outliers(spark, sf_dir):
    o = pr.iqr_outliers(cleaned(spark, sf_dir), ["age", "fare"])
    return o.select("column", *[r6(F.col(c)).alias(c) for c in
                                ("q1", "q3", "iqr", "lower_bound", "upper_bound")], "outlier_count")


@query("outlier_mask", _with("""
SELECT passenger_id, fare FROM cleaned,
  (SELECT quantile_cont(fare, 0.25) AS q1, quantile_cont(fare, 0.75) AS q3 FROM cleaned) b
WHERE fare < q1 - 1.5 * (q3 - q1) OR fare > q3 + 1.5 * (q3 - q1)"""))
def q_outlier_mask(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    b = pr.iqr_outliers(c, ["fare"]).collect()[0]
    return c.filter((F.col("fare") < b["lower_bound"]) | (F.col("fare") > b["upper_bound"])) \
        .select("passenger_id", "fare")


@query("skew_by_order", _with("""
, s AS (SELECT avg(fare) AS mean, quantile_cont(fare, 0.5) AS median,
          (SELECT fare FROM cleaned GROUP BY fare ORDER BY count(*) DESC, fare LIMIT 1) AS mode
        FROM cleaned)
SELECT 'fare' AS "column", round(mean, 6) + 0.0 AS mean, round(median, 6) + 0.0 AS median,
  round(mode, 6) + 0.0 AS mode,
  CASE WHEN mean > median AND median > mode THEN 'right-skewed'
       WHEN mean < median AND median < mode THEN 'left-skewed'
       ELSE 'not clearly classified by strict mean/median/mode ordering' END AS distribution
FROM s""".replace("\n, s AS", ", s AS")))
def q_skew_by_order(spark, sf_dir):
    s = pr.skew_by_order(cleaned(spark, sf_dir), "fare")
    return s.select("column", r6(F.col("mean")).alias("mean"), r6(F.col("median")).alias("median"),
                    r6(F.col("mode")).alias("mode"), "distribution")


@query("group_rate_1", _with("""
SELECT sex, round(avg(CAST(survived AS DOUBLE)), 6) + 0.0 AS rate, count(*) AS n FROM cleaned
GROUP BY sex"""))
def q_group_rate_1(spark, sf_dir):
    g = pr.group_rate(cleaned(spark, sf_dir), ["sex"], "survived")
    return g.select("sex", r6(F.col("rate")).alias("rate"), "n")


@query("bar_series", _with("""
SELECT pclass, round(avg(CAST(survived AS DOUBLE)), 6) + 0.0 AS rate, count(*) AS n FROM cleaned
GROUP BY pclass"""))
def q_bar_series(spark, sf_dir):
    g = pr.group_rate(cleaned(spark, sf_dir), ["pclass"], "survived")
    return g.select("pclass", r6(F.col("rate")).alias("rate"), "n")


@query("group_rate_2", _with("""
SELECT s.sex, k.pclass, round(avg(CAST(c.survived AS DOUBLE)), 6) + 0.0 AS rate
FROM (SELECT DISTINCT sex FROM cleaned) s CROSS JOIN (SELECT DISTINCT pclass FROM cleaned) k
LEFT JOIN cleaned c ON c.sex = s.sex AND c.pclass = k.pclass GROUP BY s.sex, k.pclass"""))
def q_group_rate_2(spark, sf_dir):
    g = rel.category_grid(cleaned(spark, sf_dir), "sex", "pclass",
                          F.avg(F.col("survived").cast("double")), "rate")
    return g.select("sex", "pclass", r6(F.col("rate")).alias("rate"))


@query("category_grid", _with("""
SELECT s.sex, k.pclass, round(avg(c.fare), 6) + 0.0 AS mean_fare
FROM (SELECT DISTINCT sex FROM passengers) s CROSS JOIN (SELECT DISTINCT pclass FROM passengers) k
LEFT JOIN passengers c ON c.sex = s.sex AND c.pclass = k.pclass AND c.survived = 1 AND c.alone
GROUP BY s.sex, k.pclass"""))
def q_category_grid(spark, sf_dir):
    p = passengers(spark, sf_dir)
    # an all-empty slice keeps every cell: rate rows come from the whole frame
    cond = (F.col("survived") == 1) & F.col("alone")
    g = rel.category_grid(p, "sex", "pclass", F.avg(F.when(cond, F.col("fare"))), "mean_fare")
    return g.select("sex", "pclass", r6(F.col("mean_fare")).alias("mean_fare"))


@query("value_counts", _with("""
SELECT survived, count(*) AS count,
  round(CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE), 6) + 0.0 AS percentage
FROM passengers GROUP BY survived"""))
def q_value_counts(spark, sf_dir):
    v = pr.value_counts(passengers(spark, sf_dir), "survived")
    return v.select("survived", "count", r6(F.col("percentage")).alias("percentage"))


@query("display_labels", _with("""
SELECT CASE survived WHEN 0 THEN 'Not Survived' WHEN 1 THEN 'Survived' END AS label, count(*) AS count
FROM passengers GROUP BY survived"""))
def q_display_labels(spark, sf_dir):
    v = pr.value_counts(passengers(spark, sf_dir), "survived")
    lab = F.when(F.col("survived") == 0, "Not Survived").when(F.col("survived") == 1, "Survived")
    return v.select(lab.alias("label"), "count")


def _corr_sql(triangle_only: bool) -> str:
    parts = []
    for i, a in enumerate(CORR_COLUMNS):
        for j, b in enumerate(CORR_COLUMNS):
            if triangle_only and not i < j:
                continue
            parts.append(f"SELECT {i} AS i, {j} AS j, '{a}' AS feature_1, '{b}' AS feature_2, "
                         f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS correlation FROM cleaned")
    return " UNION ALL ".join(parts)


@query("corr_matrix", _with(f"""
SELECT feature_1, feature_2, round(correlation, 9) + 0.0 AS correlation FROM ({_corr_sql(False)})"""))
def q_corr_matrix(spark, sf_dir):
    m = pr.corr_matrix(cleaned(spark, sf_dir), CORR_COLUMNS)
    return m.select("feature_1", "feature_2", r9(F.col("correlation")).alias("correlation"))


@query("top_correlations", _with(f"""
SELECT feature_1, feature_2, round(correlation, 9) + 0.0 AS correlation,
  round(abs(correlation), 9) + 0.0 AS absolute_correlation
FROM ({_corr_sql(True)}) WHERE correlation IS NOT NULL ORDER BY abs(correlation) DESC, i, j LIMIT 2"""))
def q_top_correlations(spark, sf_dir):
    t = pr.top_correlations(cleaned(spark, sf_dir), CORR_COLUMNS, 2)
    return t.select("feature_1", "feature_2", r9(F.col("correlation")).alias("correlation"),
                    r9(F.col("absolute_correlation")).alias("absolute_correlation"))


@query("abs_value", _with(f"""
SELECT feature_1, feature_2, round(abs(correlation), 9) + 0.0 AS absolute_correlation
FROM ({_corr_sql(True)})"""))
def q_abs_value(spark, sf_dir):
    m = pr.corr_matrix(cleaned(spark, sf_dir), CORR_COLUMNS).filter(F.col("i") < F.col("j"))
    return m.select("feature_1", "feature_2", r9(F.abs("correlation")).alias("absolute_correlation"))


@query("histogram", _with("""
, st AS (SELECT min(fare) AS lo, max(fare) AS hi, (max(fare) - min(fare)) / 30 AS w FROM cleaned),
b AS (SELECT CASE WHEN w > 0 THEN least(CAST(floor((fare - lo) / w) AS INTEGER), 29) ELSE 0 END AS bin,
             count(*) AS count FROM cleaned, st GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * w, 6) + 0.0 AS bin_start,
  round(lo + (g.bin + 1) * w, 6) + 0.0 AS bin_end, coalesce(b.count, 0) AS count
FROM (SELECT range AS bin FROM range(30)) g CROSS JOIN st LEFT JOIN b ON b.bin = g.bin"""
                     .replace("\n, st AS", ", st AS")))
def q_histogram(spark, sf_dir):
    h = pr.histogram(cleaned(spark, sf_dir), "fare", 30)
    return h.select("bin", r6(F.col("bin_start")).alias("bin_start"),
                    r6(F.col("bin_end")).alias("bin_end"), "count")


@query("density_curve", _with("""
, st AS (SELECT count(*) AS n, stddev_samp(fare) * pow(count(*), -0.2) AS bw, min(fare) AS lo,
                max(fare) AS hi FROM cleaned),
g AS (SELECT range AS point, lo - 3 * bw + range * ((hi - lo + 6 * bw) / 199) AS gx, n, bw
      FROM range(200), st),
v AS (SELECT fare AS x, count(*) AS w FROM cleaned GROUP BY fare)
SELECT CAST(point AS INTEGER) AS point, round(gx, 6) + 0.0 AS x_value,
  round(sum(w * exp(-0.5 * ((gx - x) / bw) * ((gx - x) / bw))) / (sqrt(2 * pi()) * n * bw) * 1e6, 6)
    + 0.0 AS density_per_million
FROM g, v GROUP BY point, gx, n, bw""".replace("\n, st AS", ", st AS")))
def q_density_curve(spark, sf_dir):
    d = pr.density_curve(cleaned(spark, sf_dir), "fare", 200)
    return d.select(F.col("point").cast("int").alias("point"), r6(F.col("x_value")).alias("x_value"),
                    r6(F.col("density") * 1e6).alias("density_per_million"))


@query("box_stats", _with("""
, q AS (SELECT survived, quantile_cont(fare, 0.25) AS q1, quantile_cont(fare, 0.5) AS median,
               quantile_cont(fare, 0.75) AS q3 FROM cleaned GROUP BY survived),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT f.survived, round(q1, 6) + 0.0 AS q1, round(median, 6) + 0.0 AS median, round(q3, 6) + 0.0 AS q3,
  round(min(CASE WHEN fare BETWEEN lf AND uf THEN fare END), 6) + 0.0 AS whisker_low,
  round(max(CASE WHEN fare BETWEEN lf AND uf THEN fare END), 6) + 0.0 AS whisker_high,
  count(*) FILTER (WHERE NOT fare BETWEEN lf AND uf) AS outliers
FROM f JOIN cleaned c USING (survived) GROUP BY f.survived, q1, median, q3"""
                     .replace("\n, q AS", ", q AS")))
def q_box_stats(spark, sf_dir):
    b = pr.box_stats(cleaned(spark, sf_dir), "fare", "survived")
    return b.select("survived", *[r6(F.col(c)).alias(c) for c in
                                  ("q1", "median", "q3", "whisker_low", "whisker_high")], "outliers")


@query("mean_std", _with("""
, s AS (SELECT avg(age) AS ma, stddev_samp(age) AS sa, stddev_pop(age) AS pa, avg(fare) AS mf,
               stddev_samp(fare) AS sf, stddev_pop(fare) AS pf FROM cleaned),
z AS (SELECT (age - ma) / pa AS za, (fare - mf) / pf AS zf FROM cleaned, s)
SELECT 'age' AS "column", round(ma, 6) + 0.0 AS mean_before, round(sa, 6) + 0.0 AS std_before,
  round(avg(za), 6) + 0.0 AS mean_after, round(stddev_pop(za), 6) + 0.0 AS std_after FROM s, z
  GROUP BY ma, sa
UNION ALL
SELECT 'fare', round(mf, 6) + 0.0, round(sf, 6) + 0.0, round(avg(zf), 6) + 0.0,
  round(stddev_pop(zf), 6) + 0.0 FROM s, z GROUP BY mf, sf""".replace("\n, s AS", ", s AS")))
def q_mean_std(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    before = pr.mean_std(c, ["age", "fare"])
    after = pr.mean_std(pr.standardise_columns(c, ["age", "fare"]), ["age", "fare"])
    return before.join(after.select("column", F.col("mean").alias("ma"), F.col("std_pop").alias("sa")),
                       "column").select(
        "column", r6(F.col("mean")).alias("mean_before"), r6(F.col("std")).alias("std_before"),
        r6(F.col("ma")).alias("mean_after"), r6(F.col("sa")).alias("std_after"))


@query("head", _with("SELECT * FROM cleaned ORDER BY passenger_id LIMIT 5"))
def q_head(spark, sf_dir):
    return rel.top_k(cleaned(spark, sf_dir), 5, [F.col("passenger_id")])


@query("drop_null_rows", _with("SELECT passenger_id, embarked FROM passengers WHERE embarked IS NOT NULL"))
def q_drop_null_rows(spark, sf_dir):
    return passengers(spark, sf_dir).dropna(subset=["embarked"]).select("passenger_id", "embarked")


@query("null_indicator", _with("""
SELECT passenger_id, age IS NULL AS age_missing, deck IS NULL AS deck_missing FROM passengers"""))
def q_null_indicator(spark, sf_dir):
    return passengers(spark, sf_dir).select("passenger_id", F.col("age").isNull().alias("age_missing"),
                                            F.col("deck").isNull().alias("deck_missing"))


@query("fill_constant", _with("""
SELECT passenger_id, coalesce(age, (SELECT quantile_cont(age, 0.5) FROM passengers)) AS age
FROM passengers"""))
def q_fill_constant(spark, sf_dir):
    p = passengers(spark, sf_dir)
    med = fe.learn_medians(p, ["age"])
    return fe.impute(p, med).select("passenger_id", "age")


@query("round_report", _with("""
SELECT pclass, round(avg(CAST(survived AS DOUBLE)), 4) AS rate FROM cleaned GROUP BY pclass"""))
def q_round_report(spark, sf_dir):
    g = pr.group_rate(cleaned(spark, sf_dir), ["pclass"], "survived")
    return g.select("pclass", F.round("rate", 4).alias("rate"))


# ------------------------------------------------------------------ splits and features
@query("stratified_split", _with("SELECT passenger_id, survived, split FROM split"))
def q_stratified_split(spark, sf_dir):
    return split(spark, sf_dir).select("passenger_id", "survived", "split")


@query("random_split", _with("""
SELECT passenger_id, CASE WHEN row_number() OVER (ORDER BY md5(CAST(passenger_id AS VARCHAR)),
  passenger_id) <= ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS split FROM passengers"""))
def q_random_split(spark, sf_dir):
    return fe.random_split(passengers(spark, sf_dir), "passenger_id").select("passenger_id", "split")


@query("split_balance", _with("""
SELECT survived,
  CAST(count(*) FILTER (WHERE split = 'train') AS DOUBLE) * 100.0
    / (SELECT count(*) FROM split WHERE split = 'train') AS train_pct,
  CAST(count(*) FILTER (WHERE split = 'test') AS DOUBLE) * 100.0
    / (SELECT count(*) FROM split WHERE split = 'test') AS test_pct
FROM split GROUP BY survived"""))
def q_split_balance(spark, sf_dir):
    return fe.split_balance(split(spark, sf_dir), "survived")


@query("impute_numeric", _with("""
SELECT passenger_id, split, coalesce(age, (SELECT quantile_cont(age, 0.5) FROM split
  WHERE split = 'train')) AS age FROM split"""))
def q_impute_numeric(spark, sf_dir):
    s = split(spark, sf_dir)
    med = fe.learn_medians(s.filter(F.col("split") == "train"), ["age"])
    return fe.impute(s, med).select("passenger_id", "split", "age")


@query("impute_categorical", _with("""
SELECT passenger_id, coalesce(embarked, (SELECT embarked FROM split WHERE split = 'train'
  AND embarked IS NOT NULL GROUP BY embarked ORDER BY count(*) DESC, embarked LIMIT 1)) AS embarked
FROM split"""))
def q_impute_categorical(spark, sf_dir):
    s = split(spark, sf_dir)
    mode = fe.learn_modes(s.filter(F.col("split") == "train"), ["embarked"])
    return fe.impute(s, mode).select("passenger_id", "embarked")


@query("standardise", _with("""
, tr AS (SELECT * FROM split WHERE split = 'train'),
m AS (SELECT quantile_cont(age, 0.5) AS med FROM tr),
imp AS (SELECT passenger_id, split, coalesce(age, (SELECT med FROM m)) AS age, fare FROM split),
st AS (SELECT avg(age) AS ma, stddev_pop(age) AS sa, avg(fare) AS mf, stddev_pop(fare) AS sf
       FROM imp WHERE split = 'train')
SELECT passenger_id, round((age - ma) / sa, 9) + 0.0 AS age, round((fare - mf) / sf, 9) + 0.0 AS fare
FROM imp, st""".replace("\n, tr AS", ", tr AS")))
def q_standardise(spark, sf_dir):
    s = split(spark, sf_dir)
    train = s.filter(F.col("split") == "train")
    imp = fe.impute(s, fe.learn_medians(train, ["age"]))
    params = fe.learn_scaling(imp.filter(F.col("split") == "train"), ["age", "fare"])
    z = fe.scale(imp, params)
    return z.select("passenger_id", r9(F.col("age")).alias("age"), r9(F.col("fare")).alias("fare"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot", _with("SELECT passenger_id, " + ", ".join(
    f"CASE WHEN sex = '{s}' THEN 1 ELSE 0 END AS sex_{s}" for s in _SEGMENTS) + " FROM split"))
def q_one_hot(spark, sf_dir):
    s = split(spark, sf_dir)
    out = fe.one_hot(s.filter(F.col("split") == "train"), s, "sex")
    return out.select("passenger_id", *[c for c in out.columns if c.startswith("sex_")])


@query("class_weight_balanced", _with("""
SELECT survived, count(*) AS n_class,
  CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight
FROM split WHERE split = 'train' GROUP BY survived"""))
def q_class_weight_balanced(spark, sf_dir):
    return fe.class_weights(split(spark, sf_dir).filter(F.col("split") == "train"), "survived")


# ------------------------------------------------------------------ evaluation
@query("classification_metrics", _with(_scored_sql() + """
, c AS (SELECT count(*) FILTER (WHERE survived = 1 AND score_mix_35 >= 0.5) AS tp,
               count(*) FILTER (WHERE survived = 0 AND score_mix_35 >= 0.5) AS fp,
               count(*) FILTER (WHERE survived = 1 AND score_mix_35 < 0.5) AS fn,
               count(*) FILTER (WHERE survived = 0 AND score_mix_35 < 0.5) AS tn FROM scored)
SELECT tp, fp, fn, tn,
  round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 9) + 0.0 AS accuracy,
  round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 9) + 0.0 AS precision,
  round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 9) + 0.0 AS recall,
  round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0), 9) + 0.0 AS f1 FROM c"""))
def q_classification_metrics(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("pred", (F.col("score_mix_35") >= 0.5).cast("int"))
    m = ev.classification_metrics(s, "survived", "pred")
    return m.select("tp", "fp", "fn", "tn", *[r9(F.col(c)).alias(c) for c in
                                              ("accuracy", "precision", "recall", "f1")])


@query("confusion_matrix", _with(_scored_sql() + """
SELECT l.label, p.predicted, count(s.survived) AS count
FROM (VALUES (0), (1)) l(label) CROSS JOIN (VALUES (0), (1)) p(predicted)
LEFT JOIN scored s ON s.survived = l.label AND CAST(s.score_mix_35 >= 0.5 AS INTEGER) = p.predicted
GROUP BY l.label, p.predicted"""))
def q_confusion_matrix(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("pred", (F.col("score_mix_35") >= 0.5).cast("int"))
    return ev.confusion_matrix(s, "survived", "pred")


_ROC_SQL = """
, per AS (SELECT score_mix_35 AS score, count(*) FILTER (WHERE survived = 1) AS pos,
                 count(*) FILTER (WHERE survived = 0) AS neg FROM scored GROUP BY 1),
cum AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
               row_number() OVER (ORDER BY score DESC) AS step,
               sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all FROM per)"""


@query("roc_curve", _with(_scored_sql() + _ROC_SQL + """
SELECT CAST(0 AS BIGINT) AS step, CAST(NULL AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT step, round(score, 9) + 0.0, round(CAST(fp AS DOUBLE) / n_all, 9) + 0.0,
  round(CAST(tp AS DOUBLE) / p_all, 9) + 0.0 FROM cum"""))
def q_roc_curve(spark, sf_dir):
    r = ev.roc_curve(scored(spark, sf_dir), "survived", "score_mix_35")
    return r.select("step", F.when(F.col("step") > 0, r9(F.col("threshold"))).alias("threshold"),
                    r9(F.col("fpr")).alias("fpr"), r9(F.col("tpr")).alias("tpr"))


@query("roc_auc", _with(_scored_sql() + _ROC_SQL + """
SELECT round(sum(neg * (tp - pos / 2.0)) / (max(p_all) * max(n_all)), 9) + 0.0 AS auc FROM cum"""))
def q_roc_auc(spark, sf_dir):
    a = ev.roc_auc(scored(spark, sf_dir), "survived", "score_mix_35")
    return a.select(r9(F.col("auc")).alias("auc"))


def _model_metrics(spark, sf_dir) -> DataFrame:
    s = scored(spark, sf_dir)
    rows = None
    for name in SCORE_MODELS:
        sc = s.withColumn("pred", (F.col(f"score_{name}") >= 0.5).cast("int"))
        m = ev.classification_metrics(sc, "survived", "pred").select(
            F.lit(name).alias("model"), *[r9(F.col(c)).alias(c) for c in ("accuracy", "precision",
                                                                            "recall", "f1")])
        rows = m if rows is None else rows.unionByName(m)
    return rows


def _model_metrics_sql() -> str:
    parts = []
    for name in SCORE_MODELS:
        sc = f"score_{name}"
        parts.append(f"""SELECT '{name}' AS model,
  round(CAST(count(*) FILTER (WHERE survived = CAST({sc} >= 0.5 AS INTEGER)) AS DOUBLE) / count(*), 9) + 0.0
    AS accuracy,
  round(coalesce(CAST(count(*) FILTER (WHERE survived = 1 AND {sc} >= 0.5) AS DOUBLE)
    / nullif(count(*) FILTER (WHERE {sc} >= 0.5), 0), 0), 9) + 0.0 AS precision,
  round(coalesce(CAST(count(*) FILTER (WHERE survived = 1 AND {sc} >= 0.5) AS DOUBLE)
    / nullif(count(*) FILTER (WHERE survived = 1), 0), 0), 9) + 0.0 AS recall,
  round(coalesce(CAST(2 * count(*) FILTER (WHERE survived = 1 AND {sc} >= 0.5) AS DOUBLE)
    / nullif(count(*) FILTER (WHERE {sc} >= 0.5) + count(*) FILTER (WHERE survived = 1), 0), 0), 9)
    + 0.0 AS f1 FROM scored""")
    return " UNION ALL ".join(parts)


@query("model_comparison", _with(_scored_sql() + "\n" + _model_metrics_sql()))
def q_model_comparison(spark, sf_dir):
    return _model_metrics(spark, sf_dir)


@query("argmax_row", _with(_scored_sql() + f"""
SELECT * FROM ({_model_metrics_sql()}) ORDER BY f1 DESC, model LIMIT 1"""))
def q_argmax_row(spark, sf_dir):
    return rel.argmax_row(_model_metrics(spark, sf_dir), "f1", ["model"])


def _regression_frame(spark, sf_dir) -> DataFrame:
    """Fare predicted by the train mean per (class, sex) on a random split."""
    p = fe.random_split(passengers(spark, sf_dir), "passenger_id")
    means = p.filter(F.col("split") == "train").groupBy("pclass", "sex").agg(
        F.avg("fare").alias("predicted_fare"))
    return p.filter(F.col("split") == "test").join(means, ["pclass", "sex"], "left")


_REG_SQL = """
, rs AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5(CAST(passenger_id AS VARCHAR)),
           passenger_id) <= ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS rsplit
         FROM passengers),
means AS (SELECT pclass, sex, avg(fare) AS predicted_fare FROM rs WHERE rsplit = 'train'
          GROUP BY pclass, sex),
reg AS (SELECT r.*, m.predicted_fare FROM rs r LEFT JOIN means m USING (pclass, sex)
        WHERE rsplit = 'test')"""


@query("regression_metrics", _with(_REG_SQL + """
, a AS (SELECT count(*) AS n, avg(abs(fare - predicted_fare)) AS mae,
               avg((fare - predicted_fare) * (fare - predicted_fare)) AS mse,
               sum((fare - predicted_fare) * (fare - predicted_fare)) AS ss_res,
               sum((fare - (SELECT avg(fare) FROM reg)) * (fare - (SELECT avg(fare) FROM reg))) AS ss_tot
        FROM reg)
SELECT n, round(mae, 6) + 0.0 AS mae, round(sqrt(mse), 6) + 0.0 AS rmse,
  round(1 - ss_res / ss_tot, 9) + 0.0 AS r2,
  round(1 - (ss_res / ss_tot) * (n - 1) / (n - 10 - 1), 9) + 0.0 AS adjusted_r2 FROM a"""))
def q_regression_metrics(spark, sf_dir):
    m = ev.regression_metrics(_regression_frame(spark, sf_dir), "fare", "predicted_fare", 10)
    return m.select("n", r6(F.col("mae")).alias("mae"), r6(F.col("rmse")).alias("rmse"),
                    r9(F.col("r2")).alias("r2"), r9(F.col("adjusted_r2")).alias("adjusted_r2"))


@query("residuals", _with(_REG_SQL + """
SELECT passenger_id, round(predicted_fare, 6) + 0.0 AS predicted,
  round(fare - predicted_fare, 6) + 0.0 AS residual FROM reg"""))
def q_residuals(spark, sf_dir):
    r = ev.residuals(_regression_frame(spark, sf_dir), "fare", "predicted_fare", ["passenger_id"])
    return r.select("passenger_id", r6(F.col("predicted")).alias("predicted"),
                    r6(F.col("residual")).alias("residual"))


@query("union_reports", _with(_scored_sql() + _REG_SQL + """
SELECT 'mix_35' AS model, 'classification' AS task,
  round(CAST(count(*) FILTER (WHERE survived = CAST(score_mix_35 >= 0.5 AS INTEGER)) AS DOUBLE)
    / count(*), 9) + 0.0 AS accuracy, CAST(NULL AS DOUBLE) AS mae FROM scored
UNION ALL
SELECT 'class_sex_mean', 'regression', NULL, round(avg(abs(fare - predicted_fare)), 6) + 0.0 FROM reg"""))
def q_union_reports(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("pred", (F.col("score_mix_35") >= 0.5).cast("int"))
    cls = ev.classification_metrics(s, "survived", "pred").select(
        F.lit("mix_35").alias("model"), F.lit("classification").alias("task"),
        r9(F.col("accuracy")).alias("accuracy"))
    reg = ev.regression_metrics(_regression_frame(spark, sf_dir), "fare", "predicted_fare", 10).select(
        F.lit("class_sex_mean").alias("model"), F.lit("regression").alias("task"),
        r6(F.col("mae")).alias("mae"))
    return rel.append_batches([cls, reg]).select("model", "task", "accuracy", "mae")


@query("residual_spread", _with(_REG_SQL + """
, st AS (SELECT min(predicted_fare) AS lo, max(predicted_fare) AS hi FROM reg),
b AS (SELECT least(CAST(floor((predicted_fare - lo) / ((hi - lo) / 10)) AS INTEGER), 9) AS bin,
             fare - predicted_fare AS r FROM reg, st)
SELECT bin, count(*) AS n, round(avg(r), 6) + 0.0 AS mean_residual,
  round(stddev_samp(r), 6) + 0.0 AS std_residual FROM b GROUP BY bin"""))
def q_residual_spread(spark, sf_dir):
    s = ev.residual_spread(_regression_frame(spark, sf_dir), "fare", "predicted_fare", 10)
    return s.select("bin", "n", r6(F.col("mean_residual")).alias("mean_residual"),
                    r6(F.col("std_residual")).alias("std_residual"))
