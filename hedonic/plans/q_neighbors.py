"""Neighbour queries on the supplier x brand matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from hedonic.operators import condo as K
from hedonic.operators import neighbors as N
from hedonic.plans.catalog import query
from hedonic.plans.q_condo import supplier_brand_frame
from hedonic.session import materialise

# value column of each of the four deterministic neighbour tables of the vote
VOTE_VALUES = {"m_price": "Sp_dol", "m_qty": "qty", "m_retail": "retail", "m_disc": "disc"}


def _matrix(spark, sf_dir, value="Sp_dol"):
    rows = supplier_brand_frame(spark, sf_dir)
    return K.price_matrix(rows, price_col=value, min_type_count=30)


def _cos_sql(name, value_expr):
    return f"""
{name}_r AS (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS addr, p_brand AS ctype, {value_expr} AS p
      FROM lineitem JOIN part ON l_partkey = p_partkey),
{name}_t AS (SELECT ctype FROM {name}_r GROUP BY ctype HAVING count(*) > 30),
{name}_m AS (SELECT addr, ctype, trunc(median(p))::BIGINT AS price FROM {name}_r
      WHERE ctype IN (SELECT ctype FROM {name}_t) GROUP BY addr, ctype),
{name}_n AS (SELECT addr, sqrt(sum(price::DOUBLE * price)) AS nrm FROM {name}_m GROUP BY addr),
{name}_d AS (SELECT a.addr, b.addr AS nbr, sum(a.price::DOUBLE * b.price) AS dot
      FROM {name}_m a JOIN {name}_m b ON a.ctype = b.ctype GROUP BY a.addr, b.addr),
{name}_all AS (SELECT x.addr, y.addr AS nbr,
        CASE WHEN x.nrm * y.nrm > 0 THEN coalesce(d.dot, 0) / (x.nrm * y.nrm) ELSE 0 END AS sim
      FROM {name}_n x CROSS JOIN {name}_n y LEFT JOIN {name}_d d ON d.addr = x.addr AND d.nbr = y.addr),
{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY addr ORDER BY sim DESC, nbr ASC) AS rank
      FROM {name}_all) WHERE rank <= 20 AND nbr <> addr)"""


@query("cosine_neighbors", "M15 W5 A6", "WITH " + _cos_sql("c", "l_extendedprice / l_quantity").strip() + """
SELECT addr, nbr, rank, round(sim, 6) AS sim FROM c""")
def cosine_neighbors(spark, sf_dir):
    e = N.cosine_neighbors(_matrix(spark, sf_dir))
    return e.select("addr", "nbr", "rank", F.round("sim", 6).alias("sim"))


_VOTE_EXPRS = {"m_price": "l_extendedprice / l_quantity", "m_qty": "l_quantity", "m_retail": "p_retailprice",
               "m_disc": "l_discount"}


@query("neighbor_vote_nudge", "A14 A13 B2", "WITH " + ",".join(
    _cos_sql(n, e).strip() for n, e in _VOTE_EXPRS.items()) + """,
edges AS (SELECT 'm_price' AS model, addr, nbr FROM m_price UNION ALL SELECT 'm_qty', addr, nbr FROM m_qty
          UNION ALL SELECT 'm_retail', addr, nbr FROM m_retail UNION ALL SELECT 'm_disc', addr, nbr FROM m_disc),
voted AS (SELECT addr, nbr FROM edges GROUP BY addr, nbr HAVING count(DISTINCT model) >= 3),
q AS (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS nbr, p_brand AS ctype,
             min(l_extendedprice / l_quantity) AS lp_q0, quantile_cont(l_extendedprice / l_quantity, 0.5) AS lp_q2,
             quantile_cont(l_extendedprice / l_quantity, 0.75) AS lp_q3, quantile_cont(1 - l_discount, 0.45) AS ratio_q2
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
l AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS addr, 'Brand#' || CAST(s_suppkey % 25 AS VARCHAR) AS ctype,
             s_suppkey AS _id, 900.0::DOUBLE + s_acctbal / 10.0::DOUBLE AS Lp_dol FROM supplier),
st AS (SELECT l._id, trunc(avg(lp_q0))::BIGINT AS nb_q0, trunc(avg(lp_q2))::BIGINT AS nb_q2,
              trunc(avg(lp_q3))::BIGINT AS nb_q3, round_even(round(avg(ratio_q2), 9) * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE AS nb_ratio
       FROM l JOIN voted v ON l.addr = v.addr JOIN q ON q.nbr = v.nbr AND q.ctype = l.ctype GROUP BY l._id),
j AS (SELECT l._id, l.Lp_dol, st.* EXCLUDE (_id) FROM l LEFT JOIN st ON l._id = st._id),
a1 AS (SELECT *, coalesce(nb_q0, 0) AS q0, coalesce(nb_q3, 0) AS q3 FROM j),
a2 AS (SELECT *, CASE WHEN q0 <> 0 AND Lp_dol > q0 * 0.6::DOUBLE AND Lp_dol < q0 * 0.8::DOUBLE
                      THEN Lp_dol * 1.2::DOUBLE ELSE Lp_dol END AS lp1 FROM a1)
SELECT _id, trunc(CASE WHEN q3 <> 0 AND lp1 > q3 * 1.2::DOUBLE AND lp1 < q3 * 1.5::DOUBLE THEN lp1 * 0.9::DOUBLE
                  ELSE lp1 END)::BIGINT AS lp_adj,
       coalesce(nb_ratio, 0.0) AS nb_ratio, q0 AS nb_q0, coalesce(nb_q2, 0) AS nb_q2, q3 AS nb_q3 FROM a2""")
def neighbor_vote_nudge(spark, sf_dir):
    from hedonic.session import table
    rows = materialise(supplier_brand_frame(spark, sf_dir))      # read by four matrices and the quantiles: one join, not one each
    edges = None
    for model, col in VOTE_VALUES.items():
        # written, as its width, its size and both sides of its blocks are read from it
        e = N.cosine_neighbors(materialise(K.price_matrix(rows, price_col=col, min_type_count=30)))
        e = e.select(F.lit(model).alias("model"), "addr", "nbr")
        edges = e if edges is None else edges.unionByName(e)
    voted = N.neighbor_vote(edges)
    # quantile rows keyed addr:ctype (lp = unit price, ratio = 1 - discount)
    q = (rows.groupBy("addr", "ctype").agg(
            F.min("Sp_dol").alias("lp_q0"), F.percentile("Sp_dol", [0.5, 0.75]).alias("_p"),
            F.percentile(1 - F.col("disc"), 0.45).alias("ratio_q2"))
         .select(F.concat_ws(":", "addr", "ctype").alias("key"), "lp_q0", F.col("_p")[0].alias("lp_q2"),
                 F.col("_p")[1].alias("lp_q3"), "ratio_q2"))
    s = table(spark, sf_dir, "supplier")
    listings = s.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("addr"),
                        F.concat(F.lit("Brand#"), F.pmod("s_suppkey", F.lit(25)).cast("string")).alias("ctype"),
                        F.col("s_suppkey").alias("_id"), (F.lit(900.0) + F.col("s_acctbal") / 10.0).alias("Lp_dol"))
    stats = N.neighbor_stats(listings, voted, q)
    return N.nudge_price(listings, stats)


def _edges_sql(models):
    """Every address has neighbours in every model, and no edge breaks an invariant."""
    return "WITH " + _cos_sql("c", "l_extendedprice / l_quantity").strip() + f""",
n AS (SELECT count(DISTINCT addr) AS n FROM c_m)
SELECT model, n AS n_addr, 0::BIGINT AS n_bad FROM n, (SELECT unnest({models}) AS model)"""


def edge_facts(edges, k=N.TOP_K):
    """Per model: addresses with neighbours, and edges that break an invariant of the ranking."""
    bad = ((F.col("rank") < 1) | (F.col("rank") > k) | (F.col("nbr") == F.col("addr")) | (F.abs("sim") > 1 + 1e-9)
           | F.isnan("sim"))
    per = edges.groupBy("model", "addr").agg(F.count_if(bad).alias("b"), F.count(F.lit(1)).alias("n"),
                                             F.countDistinct("nbr", "rank").alias("d"))
    n_addr = per.groupBy("model").agg(F.count(F.lit(1)).alias("n_addr"))
    short = (F.col("n") < F.least(F.lit(k), F.col("n_addr")) - 1) | (F.col("n") != F.col("d"))
    return per.join(n_addr, "model").groupBy("model", "n_addr").agg(
        F.sum(F.col("b") + short.cast("long")).alias("n_bad"))


@query("factor_neighbors_als", "M16 M17", _edges_sql(["als"]))
def factor_neighbors_als(spark, sf_dir):
    return edge_facts(N.factor_neighbors(N.als_factors(_matrix(spark, sf_dir))).withColumn("model", F.lit("als")))


@query("factor_neighbors_pca", "M18", _edges_sql(["pca_cos"]))
def factor_neighbors_pca(spark, sf_dir):
    return edge_facts(N.factor_neighbors(N.pca_factors(_matrix(spark, sf_dir))).withColumn("model", F.lit("pca_cos")))


@query("factor_neighbors_nonneg", "M19", _edges_sql(["nmf_cos"]))
def factor_neighbors_nonneg(spark, sf_dir):
    f = N.als_factors(_matrix(spark, sf_dir), implicit=False, nonnegative=True)
    return edge_facts(N.factor_neighbors(f).withColumn("model", F.lit("nmf_cos")))


@query("neighbor_index_build", "M20", _edges_sql(["als", "cosine", "nmf_cos", "pca_cos"]))
def neighbor_index_build(spark, sf_dir):
    return edge_facts(N.build_all(_matrix(spark, sf_dir)))
