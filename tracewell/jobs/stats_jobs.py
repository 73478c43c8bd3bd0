"""Queries for the grouped statistics, over orders and their customers.

Subject: customer; group: market segment; within: order priority; measures: whole amounts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.jobs.registry import query
from tracewell.operators import stats
from tracewell.sources import scratch

TRIALS_SQL = """tr AS (SELECT c.c_custkey AS subject, c.c_mktsegment AS grp, c.c_nationkey AS nation, o.o_orderpriority AS pri, o.o_orderstatus AS status, o.o_orderkey AS k,
  floor(o.o_totalprice) AS price, floor(c.c_acctbal * 10) + o.o_orderkey % 97 AS acct FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customers. The customers are joined by a shuffle: they grow with the input, and a broadcast
    would send them all through the driver, once for each time that the trials are read."""
    o, c = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer"))
    rows = o.join(c.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        F.col("c_custkey").alias("subject"), F.col("c_mktsegment").alias("grp"), F.col("c_nationkey").alias("nation"), F.col("o_orderpriority").alias("pri"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("k"),
        F.floor("o_totalprice").cast("double").alias("price"), (F.floor(F.col("c_acctbal") * 10) + F.col("o_orderkey") % 97).cast("double").alias("acct"),
    )


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Only the deterministic columns, doubles rounded (to six digits, or as told by name); p-values
    and limits are tested elsewhere."""
    drop = {"p_value", "conf_low", "conf_high"}
    return df.select(*[F.round(c, digits.get(c, 6)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes if c not in drop])


@query("t1_paired_t", f"WITH {TRIALS_SQL}, g AS (SELECT grp, avg(price - acct) AS e, stddev_samp(price - acct) AS s, count(*) AS n FROM tr GROUP BY 1) SELECT grp, round(e, 6) AS estimate, n, round(e / (s / sqrt(n)), 6) AS statistic, CAST(n - 1 AS DOUBLE) AS parameter FROM g")
def t1_paired_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.t_paired(trials(spark, sf_dir), ["grp"], "price", "acct"))


WELCH = "round(m1 - m2, 6) AS estimate, round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS statistic, round(power(v1 / n1 + v2 / n2, 2) / (power(v1 / n1, 2) / (n1 - 1) + power(v2 / n2, 2) / (n2 - 1)), 4) AS parameter, round(m1, 6) AS estimate1, round(m2, 6) AS estimate2, n1, n2"


@query("t2_welch_t", f"WITH {TRIALS_SQL}, g AS (SELECT grp, avg(price) AS m1, var_samp(price) AS v1, count(price) AS n1, avg(acct) AS m2, var_samp(acct) AS v2, count(acct) AS n2 FROM tr GROUP BY 1) SELECT grp, {WELCH} FROM g")
def t2_welch_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.t_welch(trials(spark, sf_dir), ["grp"], "price", "acct"), parameter=4)


@query("t3_grouped_t", f"WITH {TRIALS_SQL}, g AS (SELECT nation, avg(price) FILTER (status = 'F') AS m1, var_samp(price) FILTER (status = 'F') AS v1, count(price) FILTER (status = 'F') AS n1, avg(price) FILTER (status = 'O') AS m2, var_samp(price) FILTER (status = 'O') AS v2, count(price) FILTER (status = 'O') AS n2, count(DISTINCT status) AS levels FROM tr WHERE status IN ('F', 'O') GROUP BY 1) SELECT nation, levels, {WELCH} FROM g")
def t3_grouped_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.t_grouped(trials(spark, sf_dir).where("status IN ('F', 'O')"), ["nation"], "status", "price"), parameter=4)


@query("t4_correlation", f"WITH {TRIALS_SQL}, g AS (SELECT grp, corr(price, acct) AS r, regr_slope(acct, price) AS slope, regr_intercept(acct, price) AS intercept, count(*) AS n FROM tr GROUP BY 1) SELECT grp, round(r, 6) AS estimate, round(slope, 6) AS slope, round(intercept, 4) AS intercept, n, CAST(n - 2 AS DOUBLE) AS parameter, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS statistic FROM g")
def t4_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.correlation(trials(spark, sf_dir), ["grp"], "price", "acct"), intercept=4)


@query("t5_cross_correlation", f"WITH {TRIALS_SQL}, n AS (SELECT grp, price, acct, row_number() OVER (PARTITION BY grp ORDER BY k) AS i FROM tr), s AS (SELECT grp, avg(price) AS mx, avg(acct) AS my, stddev_pop(price) AS sx, stddev_pop(acct) AS sy, count(*) AS c FROM n GROUP BY 1), l AS (SELECT CAST(unnest(range(-3, 4)) AS INTEGER) AS lag) SELECT grp, lag, round(sum((a.price - mx) * (b.acct - my)) / (any_value(c) * any_value(sx) * any_value(sy)), 6) AS acf FROM l CROSS JOIN n b JOIN s USING (grp) JOIN n a USING (grp) WHERE a.i = b.i + lag GROUP BY grp, lag")
def t5_cross_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = scratch.saved(trials(spark, sf_dir).select("grp", "k", "price", "acct"), "trials")  # read several times
    return rounded(stats.cross_correlation(t, ["grp"], "k", "price", "acct", 3))


@query("t6_ks", f"WITH {TRIALS_SQL}, b AS (SELECT grp, price AS v, 1 AS a, 0 AS b FROM tr UNION ALL SELECT grp, acct, 0, 1 FROM tr), c AS (SELECT grp, v, sum(a) AS a, sum(b) AS b FROM b GROUP BY ALL), r AS (SELECT grp, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER g AS na, sum(b) OVER g AS nb FROM c WINDOW w AS (PARTITION BY grp ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), g AS (PARTITION BY grp)) SELECT grp, round(max(abs(ca / CAST(na AS DOUBLE) - cb / CAST(nb AS DOUBLE))), 6) AS statistic, CAST(max(na) AS BIGINT) AS n1, CAST(max(nb) AS BIGINT) AS n2 FROM r GROUP BY 1")
def t6_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = scratch.saved(trials(spark, sf_dir).select("grp", "price", "acct"), "trials")  # read several times
    return rounded(stats.ks(t, ["grp"], "price", "acct"))


RANKED = "rank() OVER (PARTITION BY {p} ORDER BY {v}) + (count(*) OVER (PARTITION BY {p}, {v}) - 1) / 2.0::DOUBLE AS rk, count(*) OVER (PARTITION BY {p}, {v}) AS ties"


@query("t7_kruskal", f"WITH {TRIALS_SQL}, r AS (SELECT nation, grp, {RANKED.format(p='nation', v='b')} FROM (SELECT *, floor(price / 10000) AS b FROM tr)), g AS (SELECT nation, grp, sum(rk) AS s, count(*) AS n, sum(ties * ties - 1) AS t FROM r GROUP BY ALL), h AS (SELECT nation, sum(s * s / n) AS q, sum(n) AS n, count(*) AS g, sum(t) AS t FROM g GROUP BY 1) SELECT nation, round((12 * q / (CAST(n AS DOUBLE) * (n + 1)) - 3 * (n + 1)) / (1 - t / (power(CAST(n AS DOUBLE), 3) - n)), 6) AS statistic, CAST(g - 1 AS DOUBLE) AS parameter, CAST(n AS BIGINT) AS n FROM h")
def t7_kruskal(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trials(spark, sf_dir).withColumn("b", F.floor(F.col("price") / 10000))
    return rounded(stats.kruskal(t, ["nation"], "b", "grp"))


@query("t8_rank_sum", f"WITH {TRIALS_SQL}, b AS (SELECT nation, floor(price / 100) AS v, 1 AS one FROM tr UNION ALL SELECT nation, floor(acct / 10), 0 FROM tr), r AS (SELECT nation, one, {RANKED.format(p='nation', v='v')} FROM b) SELECT nation, sum(rk) FILTER (one = 1) - count(*) FILTER (one = 1) * (count(*) FILTER (one = 1) + 1) / 2 AS statistic, count(*) FILTER (one = 1) AS n1, count(*) FILTER (one = 0) AS n2, CAST(sum(ties * ties - 1) AS DOUBLE) AS ties FROM r GROUP BY 1")
def t8_rank_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trials(spark, sf_dir).select("nation", F.floor(F.col("price") / 100).alias("a"), F.floor(F.col("acct") / 10).alias("b"))
    return rounded(stats.rank_sum(t, ["nation"], "a", "b"))


@query("t9_signed_rank", f"WITH {TRIALS_SQL}, d AS (SELECT nation, floor(price / 100) - floor(acct / 10) AS d FROM tr), r AS (SELECT nation, d, {RANKED.format(p='nation', v='abs(d)')} FROM d WHERE d <> 0) SELECT nation, sum(CASE WHEN d > 0 THEN rk ELSE 0 END) AS statistic, count(*) AS n, CAST(sum(ties * ties - 1) AS DOUBLE) AS ties FROM r GROUP BY 1")
def t9_signed_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trials(spark, sf_dir).select("nation", F.floor(F.col("price") / 100).alias("a"), F.floor(F.col("acct") / 10).alias("b"))
    return rounded(stats.signed_rank(t, ["nation"], "a", "b"))


@query("t10_pairwise_rank_sum", f"WITH {TRIALS_SQL}, p AS (SELECT a.grp AS group1, b.grp AS group2 FROM (SELECT DISTINCT grp FROM tr) a JOIN (SELECT DISTINCT grp FROM tr) b ON a.grp < b.grp), b AS (SELECT status, group1, group2, price AS v, CASE WHEN grp = group1 THEN 1 ELSE 0 END AS one FROM tr JOIN p ON grp IN (group1, group2)), r AS (SELECT status, group1, group2, one, {RANKED.format(p='status, group1, group2', v='v')} FROM b) SELECT status, group1, group2, sum(rk) FILTER (one = 1) - count(*) FILTER (one = 1) * (count(*) FILTER (one = 1) + 1) / 2 AS statistic, count(*) FILTER (one = 1) AS n1, count(*) FILTER (one = 0) AS n2, CAST(sum(ties * ties - 1) AS DOUBLE) AS ties FROM r GROUP BY ALL")
def t10_pairwise_rank_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.pairwise_rank_sum(trials(spark, sf_dir), ["status"], "price", "grp"))


# Plain Gauss-Newton steps from the coefficients that the values were made with, solved by Cramer's rule.
CURVE_SQL = """c AS (SELECT grp, (k % 30)::DOUBLE AS x, avg(price % 7 + 100 / (1 + exp((12 - k % 30) / 3))) AS y, count(*) AS w FROM tr GROUP BY grp, k % 30),
st(grp, n, a, m, s) AS (SELECT DISTINCT grp, 0, 103.0::DOUBLE, 12.0::DOUBLE, 3.0::DOUBLE FROM c UNION ALL
 SELECT grp, n + 1, a + (b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3) + a13 * (b2 * a23 - a22 * b3)) / det, m + (a11 * (b2 * a33 - a23 * b3) - b1 * (a12 * a33 - a23 * a13) + a13 * (a12 * b3 - b2 * a13)) / det, s + (a11 * (a22 * b3 - b2 * a23) - a12 * (a12 * b3 - b2 * a13) + b1 * (a12 * a23 - a22 * a13)) / det
 FROM (SELECT *, a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13) AS det FROM (
  SELECT grp, n, a, m, s, sum(w * g * g) AS a11, sum(w * g * p) AS a12, sum(w * g * q) AS a13, sum(w * p * p) AS a22, sum(w * p * q) AS a23, sum(w * q * q) AS a33, sum(w * g * r) AS b1, sum(w * p * r) AS b2, sum(w * q * r) AS b3 FROM (
   SELECT *, y - a * g AS r, -a * g * (1 - g) / s AS p, a * g * (1 - g) * (m - x) / (s * s) AS q FROM (SELECT st.*, c.x, c.y, c.w, 1 / (1 + exp((m - x) / s)) AS g FROM st JOIN c USING (grp) WHERE n < 15)) GROUP BY ALL)))"""


@query("t11_sigmoid", f"WITH RECURSIVE {TRIALS_SQL}, {CURVE_SQL} SELECT grp, round(a, 4) AS asym, round(m, 4) AS xmid, round(s, 4) AS scal, round(k * 30 / 99.0::DOUBLE, 6) AS x, round(a / (1 + exp((m - k * 30 / 99.0::DOUBLE) / s)), 4) AS y FROM st, range(100) AS t(k) WHERE n = 15")
def t11_sigmoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trials(spark, sf_dir).withColumn("x", F.col("k") % 30)
    t = t.withColumn("y", F.col("price") % 7 + 100 / (1 + F.exp((12 - F.col("x")) / 3)))
    return rounded(stats.sigmoid(t, ["grp"], "x", "y"), asym=4, xmid=4, scal=4, y=4)


@query("t12_anova_between", f"WITH {TRIALS_SQL}, g AS (SELECT status, grp, avg(price) AS m, var_pop(price) AS v, count(*) AS n FROM tr GROUP BY ALL), a AS (SELECT status, avg(price) AS mm FROM tr GROUP BY 1), s AS (SELECT status, sum(n * power(m - mm, 2)) AS e, sum(v * n) AS r, count(*) - 1 AS d1, sum(n) - count(*) AS d2 FROM g JOIN a USING (status) GROUP BY 1) SELECT status, round(e / 1e6, 3) AS ss_effect, round(r / 1e6, 3) AS ss_error, CAST(d1 AS DOUBLE) AS df_effect, CAST(d2 AS DOUBLE) AS df_error, round((e / d1) / (r / d2), 6) AS statistic FROM s")
def t12_anova_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scaled(stats.anova_between(trials(spark, sf_dir), ["status"], "price", "grp")), ss_effect=3, ss_error=3)


def _scaled(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c) / 1e6 for c in ("ss_effect", "ss_error")})


@query("t12_tukey_pairs", f"WITH {TRIALS_SQL}, g AS (SELECT status, grp, avg(price) AS m, var_pop(price) AS v, count(*) AS n FROM tr GROUP BY ALL), p AS (SELECT status, sum(v * n) AS ss, sum(n) - count(*) AS d, count(*) AS levels FROM g GROUP BY 1) SELECT a.status, a.grp AS group1, b.grp AS group2, round(a.m - b.m, 5) AS estimate, round(sqrt(ss / d * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n)), 5) AS std_error, CAST(d AS DOUBLE) AS parameter, levels, round((a.m - b.m) / sqrt(ss / d * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n)), 6) AS statistic FROM g a JOIN g b ON a.status = b.status AND a.grp < b.grp JOIN p ON p.status = a.status")
def t12_tukey_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.tukey_between(trials(spark, sf_dir), ["status"], "price", "grp"), estimate=5, std_error=5)


@query("t13_anova_within", f"WITH {TRIALS_SQL}, c AS (SELECT subject, pri, avg(price) AS y FROM tr GROUP BY ALL), w AS (SELECT * FROM c WHERE subject IN (SELECT subject FROM c GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT pri) FROM tr))), m AS (SELECT *, avg(y) OVER (PARTITION BY subject) AS ms, avg(y) OVER (PARTITION BY pri) AS mc, avg(y) OVER () AS mm FROM w), s AS (SELECT sum(power(mc - mm, 2)) AS e, sum(power(y - ms - mc + mm, 2)) AS r, sum(power(mm, 2)) AS i, sum(power(ms - mm, 2)) AS b, count(DISTINCT pri) - 1 AS d, count(DISTINCT subject) - 1 AS n FROM m) SELECT 'pri' AS effect, round(e / 1e6, 3) AS ss_effect, round(r / 1e6, 3) AS ss_error, CAST(d AS DOUBLE) AS df_effect, CAST(d * n AS DOUBLE) AS df_error, round((e / d) / (r / (d * n)), 6) AS statistic FROM s UNION ALL SELECT '(intercept)', round(i / 1e6, 3), round(b / 1e6, 3), 1, CAST(n AS DOUBLE), round(i / (b / n), 6) FROM s")
def t13_anova_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scaled(stats.anova_within(trials(spark, sf_dir), [], "subject", ["pri"], "price")), ss_effect=3, ss_error=3)


FACTORS = {"half": "k % 2 = 0", "early": "pri < '3'", "open": "status = 'O'"}


def _factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trials(spark, sf_dir).withColumns({"half": F.when(F.expr(FACTORS["half"]), "a").otherwise("b"), "early": F.when(F.expr(FACTORS["early"]), "x").otherwise("y"), "open": F.when(F.expr(FACTORS["open"]), "o").otherwise("p"), "bank": F.col("nation") % 3})


def signs_sql(within: list[str], between: str | None = None, bank: bool = False) -> str:
    """SQL of the analysis with factors of two levels: the one contrast of each effect is a sum of the
    cells with signs."""
    by = ["bank"] if bank else []
    keys, n = "".join(f"{k}, " for k in by), 1 << len(within)
    cell = ", ".join(f"CASE WHEN {FACTORS[w]} THEN 1 ELSE -1 END AS {w}" for w in within)
    names = {":".join(w for i, w in enumerate(within) if m >> i & 1) or "(intercept)": " * ".join(w for i, w in enumerate(within) if m >> i & 1) or "1" for m in range(n)}
    scores = " UNION ALL ".join(f"SELECT {keys}subject, g, '{e}' AS effect, sum(y * {s}) / sqrt({n}.0::DOUBLE) AS s FROM c GROUP BY ALL HAVING count(*) = {n}" for e, s in names.items())
    tests = "SELECT {k}effect, u * u * k * k / h AS ss, err, 1.0::DOUBLE AS d, n - k AS de FROM o"
    if between:
        tests += f" UNION ALL SELECT {{k}}CASE effect WHEN '(intercept)' THEN '{between}' ELSE '{between}:' || effect END, sq - sm * sm / n, err, k - 1, n - k FROM o WHERE k > 1"
    return f"""WITH {TRIALS_SQL}, c AS (SELECT {'nation % 3 AS bank, ' if bank else ''}subject, {between or "'all'"} AS g, {cell}, avg(price) AS y FROM tr GROUP BY ALL), s AS ({scores}),
p AS (SELECT {keys}effect, g, avg(s) AS m, var_pop(s) * count(*) AS v, count(*) AS n FROM s GROUP BY ALL),
o AS (SELECT {keys}effect, avg(m) AS u, count(*) AS k, sum(1.0::DOUBLE / n) AS h, sum(m * n) AS sm, sum(m * m * n) AS sq, sum(n) AS n, sum(v) AS err FROM p GROUP BY ALL), t AS ({tests.format(k=keys)})
SELECT {keys}effect, round(ss / 1e6, 3) AS ss_effect, round(err / 1e6, 3) AS ss_error, CAST(d AS DOUBLE) AS df_effect, CAST(de AS DOUBLE) AS df_error, round(CASE WHEN d > 0 AND de > 0 AND err > 0 THEN (ss / d) / (err / de) END, 6) AS statistic FROM t"""


def _signs(spark: SparkSession, sf_dir: str, within: list[str], between: str | None = None, bank: bool = False) -> DataFrame:
    out = stats.anova_within(_factors(spark, sf_dir), ["bank"] if bank else [], "subject", within, "price", between)
    return rounded(_scaled(out), ss_effect=3, ss_error=3)


@query("t14_anova_two_within", signs_sql(["half", "early"]))
def t14_anova_two_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signs(spark, sf_dir, ["half", "early"])


@query("t14_anova_two_within_grouped", signs_sql(["half", "early"], bank=True))
def t14_anova_two_within_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signs(spark, sf_dir, ["half", "early"], bank=True)


@query("t14_anova_three_within", signs_sql(["half", "early", "open"]))
def t14_anova_three_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signs(spark, sf_dir, ["half", "early", "open"])


@query("t15_anova_mixed_two_within", signs_sql(["half", "early"], "grp"))
def t15_anova_mixed_two_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signs(spark, sf_dir, ["half", "early"], "grp")


@query("t15_anova_mixed_grouped", signs_sql(["half"], "grp", bank=True))
def t15_anova_mixed_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signs(spark, sf_dir, ["half"], "grp", bank=True)


MIXED_SQL = f"""WITH {TRIALS_SQL}, c AS (SELECT subject, grp, pri, avg(price) AS y FROM tr GROUP BY ALL), w AS (SELECT *, avg(y) OVER (PARTITION BY subject) AS ms, count(*) OVER (PARTITION BY subject) AS cells FROM c QUALIFY cells = (SELECT count(DISTINCT pri) FROM tr)),
d AS (SELECT *, y - ms AS z, avg(y - ms) OVER (PARTITION BY grp, pri) AS zg, avg(ms) OVER (PARTITION BY grp) AS mg, avg(y - ms) OVER (PARTITION BY pri) AS zp, avg(ms) OVER () AS mw FROM w),
n AS (SELECT count(DISTINCT pri) AS j, count(DISTINCT subject) AS n, count(DISTINCT grp) AS k FROM w), h AS (SELECT sum(1.0::DOUBLE / n) AS h FROM (SELECT count(DISTINCT subject) AS n FROM w GROUP BY grp)),
u AS (SELECT sum(power(z, 2)) AS zz FROM (SELECT avg(zg) AS z FROM (SELECT DISTINCT grp, pri, zg FROM d) GROUP BY pri)), i AS (SELECT avg(mg) AS m FROM (SELECT DISTINCT grp, mg FROM d)),
s AS (SELECT sum(power(z - zg, 2)) AS ew, sum(power(zg - zp, 2)) AS gw, sum(power(ms - mg, 2)) AS eb, sum(power(mg - mw, 2)) AS gb FROM d),
t AS (SELECT '(intercept)' AS effect, j * m * m * k * k / h AS ss, eb AS err, 1 AS d, n - k AS de FROM s, n, h, i UNION ALL SELECT 'grp', gb, eb, k - 1, n - k FROM s, n UNION ALL SELECT 'pri', zz * k * k / h, ew, j - 1, (j - 1) * (n - k) FROM s, n, h, u UNION ALL SELECT 'grp:pri', gw, ew, (j - 1) * (k - 1), (j - 1) * (n - k) FROM s, n)
SELECT effect, round(ss / 1e6, 3) AS ss_effect, round(err / 1e6, 3) AS ss_error, CAST(d AS DOUBLE) AS df_effect, CAST(de AS DOUBLE) AS df_error, round((ss / d) / (err / de), 6) AS statistic FROM t WHERE d > 0"""


@query("t15_anova_mixed", MIXED_SQL)
def t15_anova_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scaled(stats.anova_within(trials(spark, sf_dir), [], "subject", ["pri"], "price", between="grp")), ss_effect=3, ss_error=3)


@query("t16_significance", "SELECT o_orderkey, CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'n.s.' END AS sig_label, p < 0.05 AS sig FROM (SELECT o_orderkey, (o_orderkey % 1000) / 8000.0::DOUBLE AS p FROM orders)")
def t16_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", (F.col("o_orderkey") % 1000 / 8000.0).alias("p_value"))
    return stats.significant(o).drop("p_value")


@query("t17_saved_results", f"WITH {TRIALS_SQL}, g AS (SELECT status, grp, avg(price) AS m, count(*) AS n FROM tr GROUP BY ALL) SELECT 'means' AS result, status || ' ' || grp AS name, round(m, 4) AS value, n FROM g UNION ALL SELECT 'anova', status, CAST(count(*) - 1 AS DOUBLE), CAST(sum(n) AS BIGINT) FROM g GROUP BY status")
def t17_saved_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result tables written below one folder, one as Parquet and one as CSV, and read again."""
    t, folder = trials(spark, sf_dir), scratch.folder(spark, "results")
    means = t.groupBy("status", "grp").agg(F.round(F.avg("price"), 4).alias("m"), F.count("*").alias("n"))
    stats.save_results({"means": means}, folder)
    stats.save_results({"anova": stats.anova_between(t, ["status"], "price", "grp")}, folder, "csv")
    read = spark.read.parquet(f"{folder}/means").select(F.lit("means").alias("result"), F.concat_ws(" ", "status", "grp").alias("name"), F.col("m").alias("value"), "n")
    again = spark.read.option("header", True).csv(f"{folder}/anova")
    return read.unionByName(again.select(F.lit("anova").alias("result"), F.col("status").alias("name"), F.col("df_effect").cast("double").alias("value"), (F.col("df_effect").cast("double") + F.col("df_error").cast("double") + 1).cast("long").alias("n")))
