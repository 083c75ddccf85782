"""Mixing sources to target weights by hierarchical budgeting (DataFrame operations only).

Documents hang in a tree domain - language - source. A token budget goes down the tree in
proportion to weights; a child never gets more than its capacity (tokens below it times
MAX_EPOCHS). What a child cannot use is shared among its siblings by weight; only what a
whole parent cannot use reaches the parent's siblings. Shares are whole tokens, rounded down.
Each leaf is then read in seeded epochs: as many whole epochs as its budget covers, and of
the next epoch, in the order of md5(seed-epoch-doc_id), the longest prefix that fits the rest.

`copies` says how often each document is used (0: not at all). Tokens are words
`[^\\x20\\x09-\\x0D]+`; null texts have none. Null languages and sources form groups named
''. Repeated rows are documents of their own. Prefix sums run per (leaf, first digits of the
order key), so that no leaf is summed by one task. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, table

DOMAIN = "CASE WHEN right(source, 1) IN ('0', '1', '2', '3', '4') THEN 'web' WHEN right(source, 1) IN ('5', '6', '7') THEN 'books' WHEN source IS NULL THEN '' ELSE 'code' END"
DOMAIN_WEIGHTS = {"web": 5, "books": 3, "code": 2}
LANGUAGE_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}
SHARE_PERCENT, MAX_EPOCHS, SEED, DIGITS = 60, 2, 42, 3
LEAF = ["domain", "lang", "source"]
WORD = "[^\\x20\\x09-\\x0D]+"


def _weight(column: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, w in weights.items():
        out = F.when(F.col(column) == name, w).otherwise(out)
    return out.cast("decimal(18,0)")


def share(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """children with `given`. They hold budget (of the parent), cap and weight; all whole numbers."""
    tie = Window.partitionBy(*parent).orderBy("ratio", child)
    whole = lambda e: F.expr(f"CAST({e} AS DECIMAL(38,0))")
    ordered = children.withColumn("ratio", whole("(CAST(cap AS DECIMAL(20,0)) * 1000000) div weight"))
    ordered = ordered.withColumn("used", F.coalesce(F.sum("cap").over(tie.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("decimal(20,0)"))
    ordered = ordered.withColumn("heavier", F.sum("weight").over(tie.rowsBetween(0, Window.unboundedFollowing)).cast("decimal(18,0)"))
    ordered = ordered.withColumn("full", (F.col("budget").cast("decimal(20,0)") - F.col("used")) * F.col("weight") >= F.col("cap").cast("decimal(20,0)") * F.col("heavier"))
    all_ = Window.partitionBy(*parent)
    ordered = ordered.withColumn("taken", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(all_), F.lit(0)).cast("decimal(20,0)"))
    ordered = ordered.withColumn("rest", F.sum(F.when(~F.col("full"), F.col("weight"))).over(all_).cast("decimal(18,0)"))
    given = F.when(F.col("full"), F.col("cap")).otherwise(F.expr("CAST(((CAST(budget AS DECIMAL(20,0)) - taken) * weight) div rest AS BIGINT)"))
    return ordered.withColumn("given", given).drop("ratio", "used", "heavier", "full", "taken", "rest")


def budgets(leaves: DataFrame, total: Column, domain_weights=None, language_weights=None) -> DataFrame:
    """leaf columns, tokens, cap, given for leaves (domain, lang, source, tokens, cap). total: the tokens to give, over `whole`."""
    domain_weights, language_weights = domain_weights or DOMAIN_WEIGHTS, language_weights or LANGUAGE_WEIGHTS
    languages = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"))
    domains = languages.groupBy("domain").agg(F.sum("cap").alias("cap"))
    root = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("whole")).select(total.cast("long").alias("budget"), F.lit(0).alias("root"))
    top = share(domains.withColumn("root", F.lit(0)).join(root, "root").withColumn("weight", _weight("domain", domain_weights)), ["root"], "domain")
    middle = share(languages.join(top.select("domain", F.col("given").alias("budget")), "domain").withColumn("weight", _weight("lang", language_weights)), ["domain"], "lang")
    bottom = leaves.join(middle.select("domain", "lang", F.col("given").alias("budget")), ["domain", "lang"]).withColumn("weight", F.lit(1).cast("decimal(18,0)"))
    return share(bottom, ["domain", "lang"], "source").select(*LEAF, "tokens", "cap", "given")


def placed(docs: DataFrame, domain: str) -> DataFrame:
    """doc_id, leaf columns and n_tokens of each row."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang"), F.col("source"), F.col("text"))
    return named.select("doc_id", F.expr(domain).alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0)).alias("n_tokens"))


def order_key(seed: int) -> Column:
    return F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def mix(docs: DataFrame, domain: str = DOMAIN, share_percent: int = SHARE_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED, digits: int = DIGITS) -> DataFrame:
    """doc_id, leaf columns, n_tokens, leaf_budget, epochs, order_key, copies: one row per row of docs."""
    own = cut(placed(docs, domain))
    leaves = own.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens")).withColumn("cap", F.col("tokens") * max_epochs)
    given = budgets(leaves, F.expr(f"whole * {share_percent} div 100"))
    plan = given.select(*LEAF, F.col("given").alias("leaf_budget"), F.expr(f"CASE WHEN tokens = 0 THEN {max_epochs} ELSE given div tokens END").alias("epochs"), F.expr("CASE WHEN tokens = 0 THEN 0 ELSE given % tokens END").alias("rest"))
    keyed = own.join(plan, LEAF).withColumn("order_key", order_key(seed)).withColumn("part", F.substring("order_key", 1, digits))
    parts = keyed.groupBy(*LEAF, "part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select(*LEAF, "part", (F.sum("n").over(Window.partitionBy(*LEAF).orderBy("part")) - F.col("n")).alias("before"))
    inner = Window.partitionBy(*LEAF, "part").orderBy("order_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    summed = keyed.withColumn("own", F.sum("n_tokens").over(inner)).join(parts, [*LEAF, "part"])
    more = (F.col("epochs") < max_epochs) & (F.col("before") + F.col("own") <= F.col("rest"))
    return summed.select("doc_id", *LEAF, "n_tokens", "leaf_budget", "epochs", "order_key", (F.col("epochs") + more.cast("long")).alias("copies"))


def take(docs: DataFrame, domain: str = DOMAIN, share_percent: int = SHARE_PERCENT, seed: int = SEED) -> DataFrame:
    """The rows of docs of one seeded epoch that fit the budgets, with all their columns.

    A leaf's selection is all rows up to its last order key, so texts are filtered where they
    lie, by a join with one row per leaf.
    """
    chosen = mix(docs, domain, share_percent, 1, seed)
    last = cut(chosen.where("copies > 0").groupBy(*LEAF, "epochs").agg(F.max(F.struct("order_key", "doc_id", "n_tokens")).alias("last")))
    domain_, lang_, source_, n_, epochs_, last_ = fresh(docs, *[f"_leaf_{c}" for c in (*LEAF, "n", "epochs", "last")])
    marked = docs.select("*", F.expr(domain).alias(domain_), F.coalesce("lang", F.lit("")).alias(lang_), F.coalesce("source", F.lit("")).alias(source_), F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0)).alias(n_))
    ends = last.select(F.col("domain").alias(domain_), F.col("lang").alias(lang_), F.col("source").alias(source_), F.col("epochs").alias(epochs_), F.col("last").alias(last_))
    key = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(epochs_).cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    mine = F.struct(key.alias("order_key"), F.col("doc_id").cast("long").alias("doc_id"), F.col(n_).alias("n_tokens"))
    return marked.join(ends, [domain_, lang_, source_]).where((F.col(epochs_) > 0) | (mine <= F.col(last_))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def _share_sql(name: str, source: str, parent: str, child: str, keep: str) -> str:
    return f"""
{name}_1 AS (SELECT *, (CAST(cap AS HUGEINT) * 1000000) // weight AS ratio FROM ({source})),
{name}_2 AS (SELECT *, coalesce(sum(cap) OVER (PARTITION BY {parent} ORDER BY ratio, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used, sum(weight) OVER (PARTITION BY {parent} ORDER BY ratio, {child} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavier FROM {name}_1),
{name}_3 AS (SELECT *, (CAST(budget AS HUGEINT) - used) * weight >= CAST(cap AS HUGEINT) * heavier AS is_full FROM {name}_2),
{name} AS (SELECT {keep}, CAST(CASE WHEN is_full THEN cap ELSE ((CAST(budget AS HUGEINT) - coalesce(sum(cap) FILTER (WHERE is_full) OVER (PARTITION BY {parent}), 0)) * weight) // sum(weight) FILTER (WHERE NOT is_full) OVER (PARTITION BY {parent}) END AS BIGINT) AS given FROM {name}_3)"""


OP7_SQL = f"""
WITH own AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, {DOMAIN} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens FROM documents
), leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * {MAX_EPOCHS} AS BIGINT) AS cap FROM own GROUP BY ALL),
languages AS (SELECT domain, lang, CAST(sum(cap) AS BIGINT) AS cap FROM leaves GROUP BY ALL),
domains AS (SELECT domain, CAST(sum(cap) AS BIGINT) AS cap FROM leaves GROUP BY ALL),
{_share_sql("top", f"SELECT *, 0 AS root, (SELECT sum(tokens) FROM leaves) * {SHARE_PERCENT} // 100 AS budget, CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'code' THEN 2 ELSE 1 END AS weight FROM domains", "root", "domain", "domain")},
{_share_sql("middle", "SELECT languages.*, given AS budget, CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS weight FROM languages JOIN top USING (domain)", "domain", "lang", "domain, lang")},
{_share_sql("bottom", "SELECT leaves.*, given AS budget, 1 AS weight FROM leaves JOIN middle USING (domain, lang)", "domain, lang", "source", "domain, lang, source, tokens")},
plan AS (SELECT domain, lang, source, given AS leaf_budget, CASE WHEN tokens = 0 THEN {MAX_EPOCHS} ELSE given // tokens END AS epochs, CASE WHEN tokens = 0 THEN 0 ELSE given % tokens END AS rest FROM bottom),
keyed AS (SELECT own.*, leaf_budget, epochs, rest, md5('{SEED}-' || epochs || '-' || coalesce(CAST(doc_id AS VARCHAR), '')) AS order_key FROM own JOIN plan USING (domain, lang, source)),
summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY order_key, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far FROM keyed)
SELECT doc_id, domain, lang, source, n_tokens, leaf_budget, CAST(epochs AS BIGINT) AS epochs, order_key, CAST(epochs + CASE WHEN epochs < {MAX_EPOCHS} AND so_far <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM summed
"""
