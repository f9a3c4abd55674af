"""Trees grown in scans: a split that SQL can repeat, and depths beyond thirty."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from loomframe.functions.scalar import round_half_up
from loomframe.models import forests
from loomframe.models.classifiers import CentredPCA
from loomframe.plans.feature_queries import _r
from loomframe.plans.model_queries import SEED, _good, _judged, languages
from loomframe.plans.registry import query
from loomframe.sources.tables import table

_GINI = "2.0 * {p} * ({n} - {p}) / {n}"


@query(
    "tree_split",
    f"""WITH d AS (SELECT p_size AS x, CASE WHEN p_retailprice > 1200 OR p_size > 35 THEN 1 ELSE 0 END AS y FROM part),
      w AS (SELECT count(*) AS n, sum(y) AS p FROM d),
      s AS (SELECT x, sum(count(*)) OVER (ORDER BY x) AS nl, sum(sum(y)) OVER (ORDER BY x) AS pl FROM d GROUP BY x),
      g AS (SELECT x, nl, pl, n - nl AS nr, p - pl AS pr, {_GINI.format(n='n', p='p')} - {_GINI.format(n='nl', p='pl')}
                   - {_GINI.format(n='(n - nl)', p='(p - pl)')} AS gain FROM s, w WHERE nl < n)
      SELECT CAST(x AS DOUBLE) AS threshold, CAST(nl AS BIGINT) AS n_left, CAST(pl AS BIGINT) AS hits_left,
             CAST(nr AS BIGINT) AS n_right, CAST(pr AS BIGINT) AS hits_right FROM g ORDER BY gain DESC, x LIMIT 1""",
)
def tree_split(spark, d):
    """The first split of a tree: threshold and classes on both sides."""
    hit = ((F.col("p_retailprice") > 1200) | (F.col("p_size") > 35)).cast("double")
    part = table(spark, d, "part").select(
        "p_partkey", hit.alias("label"), array_to_vector(F.array(F.col("p_size").cast("double"))).alias("raw")
    )
    model = forests.Forest("p_partkey", 1, 1, None, max_bins=256, frac=None).fit(part)
    tree = model.trees[0]
    left, right = tree.counts[1], tree.counts[2]
    cells = (model.cuts[0][tree.last[0]], *(int(v) for c in (left, right) for v in (c.sum(), c[1])))
    return spark.createDataFrame(
        [cells], "threshold double, n_left long, hits_left long, n_right long, hits_right long"
    )


@query("m_deep_tree", _good("deep_tree"))
def m_deep_tree(spark, d):
    """A tree that may go down a hundred levels."""
    return _judged("deep_tree", forests.Forest("doc_id", 1, 100, None, frac=None), languages(spark, d))


@query("m_deep_forest", _good("deep_forest"))
def m_deep_forest(spark, d):
    """Twenty trees of up to seventy levels, grown side by side."""
    return _judged("deep_forest", forests.Forest("doc_id", 20, 70, seed=SEED), languages(spark, d))


@query(
    "pca_variance",
    f"""WITH l AS (SELECT generate_subscripts(embedding, 1) AS j, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
             v AS (SELECT j, var_samp(x) AS v FROM l GROUP BY j)
        SELECT {_r('sum(v)', 6)} AS variance, CAST(count(*) AS BIGINT) AS n_components, 0.0::DOUBLE AS mean,
               0.0::DOUBLE AS cross FROM v""",
)
def pca_variance(spark, d):
    """All components together: they hold the whole variance, around zero, and the first two share none."""
    vectors = table(spark, d, "embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    size = F.size(vector_to_array("features"))
    k = vectors.select(F.max(size)).first()[0]
    z = CentredPCA(k=k).fit(vectors).transform(vectors).select(vector_to_array("components").alias("z"))
    long = z.select(F.posexplode("z").alias("j", "v")).groupBy("j").agg(F.var_samp("v").alias("v"), F.avg("v").alias("m"))
    cross = z.select(F.covar_samp(F.col("z")[0], F.col("z")[1])).scalar()
    near = lambda c: F.abs(round_half_up(c, 6))
    return long.agg(
        round_half_up(F.sum("v"), 6).alias("variance"), F.count("*").alias("n_components"),
        near(F.max(F.abs("m"))).alias("mean"), near(cross).alias("cross"),
    )
