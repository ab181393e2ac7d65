"""Queries over the texts of labels, questions and documents."""

from pyspark.sql import functions as F

from atrium.functions import text as X
from atrium.plans.registry import query
from atrium.plans.scenes import scene

PLURAL = r"""CASE WHEN w = '' OR lower(w) LIKE '%s' THEN w WHEN regexp_matches(lower(w), '(x|z|ch|sh)$') THEN w || 'es' WHEN lower(w) LIKE '%fe' THEN w[:-3] || 'ves' WHEN lower(w) LIKE '%f' AND lower(w) NOT LIKE '%ff' THEN w[:-2] || 'ves' WHEN regexp_matches(lower(w), '[^aeiou]y$') THEN w[:-2] || 'ies' ELSE w || 's' END"""


@query(f"WITH l AS (SELECT DISTINCT label AS w FROM {{objects}} UNION SELECT DISTINCT c_mktsegment FROM {{customer}}) SELECT w AS label, {PLURAL} AS plural, trim(regexp_replace(lower(replace(w, '_', ' ')), ' +', ' ', 'g')) AS normal FROM l")
def plural_labels(spark, sf_dir):
    objects, customer = scene(spark, sf_dir, "objects", "customer")
    labels = objects.select("label").union(customer.select("c_mktsegment")).distinct()
    return labels.select("label", X.pluralize(F.col("label")).alias("plural"), X.normalize_label(F.col("label")).alias("normal"))


@query("""SELECT n_nationkey AS n, CAST(n_nationkey AS VARCHAR) || CASE WHEN n_nationkey % 100 BETWEEN 11 AND 13 THEN 'th' WHEN n_nationkey % 10 = 1 THEN 'st' WHEN n_nationkey % 10 = 2 THEN 'nd' WHEN n_nationkey % 10 = 3 THEN 'rd' ELSE 'th' END AS ordinal FROM {nation}""")
def ordinals(spark, sf_dir):
    return scene(spark, sf_dir, "nation")[0].select(F.col("n_nationkey").alias("n"), X.ordinal(F.col("n_nationkey")).alias("ordinal"))


@query(r"""WITH n AS (SELECT doc_id, lower(text) AS t, 1 AS one FROM {documents})
SELECT doc_id, regexp_matches(t, '(^|[^a-z0-9_])that([^a-z0-9_]|$)') AS deictic, regexp_matches(t, '(^|[^a-z0-9_])other([^a-z0-9_]|$)') AS generic,
len(list_filter(regexp_extract_all(t, '(?:^|[^a-z0-9_])an? ([a-z0-9_]+)', 1), lambda w: w LIKE '%s' AND NOT regexp_matches(w, '(ss|us|is)$'))) > 0 AS plural_article FROM n""")
def text_issues(spark, sf_dir):
    docs = scene(spark, sf_dir, "documents")[0].withColumn("issues", X.text_issues(F.col("text")))
    has = lambda name: F.array_contains("issues", name)
    return docs.select("doc_id", has("deictic_that").alias("deictic"), has("generic_other").alias("generic"), has("article_plural").alias("plural_article"))


@query("""SELECT object_id, 'How far is the ' || label || ' with id ' || object_id || '?' AS question, CASE object_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS letter FROM {objects}""")
def rendered_questions(spark, sf_dir):
    (o,) = scene(spark, sf_dir, "objects")
    bindings = F.create_map(F.lit("label"), F.col("label"), F.lit("id"), F.col("object_id").cast("string"))
    choices = F.array(*(F.lit(x) for x in ("near", "middle", "far")))
    answer = F.element_at(choices, (F.col("object_id") % 3 + 1).cast("int"))
    return o.select("object_id", X.render(F.lit("How far is the {label} with id {{id}}?"), bindings).alias("question"), X.answer_choice(choices, answer).alias("letter"))
