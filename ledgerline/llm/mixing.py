"""Mixing sources to target weights by hierarchical budgeting.

Documents hang on a tree domain - language - source.  A token budget runs
down the tree: at every node the children share it by their weights, no child
gets more than its subtree can supply in ``max_epochs`` passes, and what a
child cannot take is shared among its siblings before any of it goes back to
the parent's own siblings.  A leaf takes whole epochs while they fit and then
a token-prefix of one more, in an order seeded per epoch.

DataFrame functions only.  Every step on documents is narrow or combines
before it shuffles: the prefix of a leaf, however large, is found from sums
over 4,096 hash ranges and the rows of the one range where it ends.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import saved

LEVELS = ("domain", "lang", "source")
WORDS = r"[^\x09-\x0D\x20]+"


@dataclass(frozen=True)
class Mix:
    """Target weights per level (positive integers; ``default`` for values not
    listed), the budget as a share of the input's tokens in per mille, the
    most epochs of any leaf and the seed."""

    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    default: int = 10
    budget_permille: int = 800
    max_epochs: int = 2
    seed: int = 42
    domains: dict[str, str] = field(default_factory=dict)     # last character of the source -> domain
    other_domain: str = "other"


def domain_of(mix: Mix) -> Column:
    out = F.lit(mix.other_domain)
    for ending, name in mix.domains.items():
        out = F.when(F.substring("source", -1, 1) == ending, F.lit(name)).otherwise(out)
    return out


def weight_of(level: str, mix: Mix) -> Column:
    out = F.lit(mix.default)
    for value, w in mix.weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(w)).otherwise(out)
    return out.cast("decimal(18,0)")


def _tree_columns(docs: DataFrame, mix: Mix) -> dict[str, Column]:
    none = F.lit("")
    return {"domain": domain_of(mix), "lang": F.coalesce(F.col("lang"), none),
            "source": F.coalesce(F.col("source"), none)}


def share_out(nodes: DataFrame, parent: list[str], level: str, budget: str, mix: Mix) -> DataFrame:
    """``nodes`` (one row per child: key columns, cap, its parent's ``budget``)
    with ``grant``: the budget shared by weight, rounded down, saturated
    children first."""
    dec = "decimal(20,0)"
    keys = [F.col(c) for c in parent] or [F.lit(0)]
    w = weight_of(level, mix)
    d = nodes.withColumns({"_w": w, "_cap": F.col("cap").cast(dec), "_b": F.col(budget).cast(dec)})
    order = Window.partitionBy(*keys).orderBy((F.col("_cap") / F.col("_w")), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    d = d.withColumns({"_left": F.col("_b") - F.coalesce(F.sum("_cap").over(before).cast(dec), F.lit(0).cast(dec)),
                       "_rest": F.sum("_w").over(after).cast("decimal(18,0)")})
    full = F.col("_cap") * F.col("_rest") <= F.col("_w") * F.col("_left")
    d = d.withColumn("_full", full).withColumn(
        "_rank", F.when(~F.col("_full"), F.row_number().over(order)))
    every = Window.partitionBy(*keys)
    first = F.col("_rank") == F.min("_rank").over(every)
    d = d.withColumn("_first", first)
    d = d.withColumns({"_l": F.max(F.when(F.col("_first"), F.col("_left"))).over(every),
                       "_r": F.max(F.when(F.col("_first"), F.col("_rest"))).over(every)})
    part = F.expr("(_w * _l) div _r")
    grant = F.when(F.col("_full"), F.col("_cap").cast("long")).otherwise(F.greatest(part, F.lit(0)))
    return d.withColumn("grant", grant.cast("long")) \
        .drop("_w", "_cap", "_b", "_left", "_rest", "_full", "_rank", "_first", "_l", "_r")


def leaf_budgets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf: tokens, epochs (whole ones), rest (tokens of the partial
    one).  ``sizes`` has the tokens of each (domain, lang, source)."""
    caps = sizes.withColumn("cap", F.col("tokens") * mix.max_epochs)
    total = caps.agg((F.sum("tokens") * mix.budget_permille).alias("b"))
    top = caps.groupBy("domain").agg(F.sum("cap").alias("cap")) \
        .crossJoin(total.select(F.expr("b div 1000").alias("budget")))       # one row on the right
    granted = share_out(top, [], "domain", "budget", mix).select("domain", F.col("grant").alias("budget"))
    mid = caps.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(granted, "domain")
    granted = share_out(mid, ["domain"], "lang", "budget", mix) \
        .select("domain", "lang", F.col("grant").alias("budget"))
    leaves = share_out(caps.join(granted, ["domain", "lang"]), ["domain", "lang"], "source", "budget", mix)
    return leaves.filter("tokens > 0").select(
        *LEVELS, "tokens", F.expr("grant div tokens").alias("epochs"), (F.col("grant") % F.col("tokens")).alias("rest"))


def epoch_hash(seed: int) -> Column:
    """Place of a document in the partial epoch of its leaf."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def cutoffs(rows: DataFrame, leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` with ``cutoff``: the last hash of its partial epoch's prefix
    (NULL: none).  Rows of one hash are in or out together."""
    part = rows.join(leaves.filter("rest > 0").select(*LEVELS, "epochs", "rest"), list(LEVELS)) \
        .withColumn("h", epoch_hash(mix.seed)).withColumn("b", F.substring("h", 1, 3))
    sums = part.groupBy(*LEVELS, "b").agg(F.sum("tokens").alias("t"), F.max("h").alias("last"),
                                          F.first("rest").alias("rest"))
    run = Window.partitionBy(*LEVELS).orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("end", F.sum("t").over(run)).withColumn("begin", F.col("end") - F.col("t"))
    whole = sums.filter("end <= rest").groupBy(*LEVELS).agg(F.max("last").alias("cutoff"))
    edge = sums.filter("begin <= rest AND end > rest").select(*LEVELS, "b", "begin")
    inner = Window.partitionBy(*LEVELS, "b").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    inside = part.join(edge, [*LEVELS, "b"]).groupBy(*LEVELS, "b", "h") \
        .agg(F.sum("tokens").alias("t"), F.first("begin").alias("begin"), F.first("rest").alias("rest")) \
        .withColumn("end", F.col("begin") + F.sum("t").over(inner)) \
        .filter("end <= rest").groupBy(*LEVELS).agg(F.max("h").alias("cutoff"))
    last = whole.unionByName(inside).groupBy(*LEVELS).agg(F.max("cutoff").alias("cutoff"))
    return leaves.join(last, list(LEVELS), "left")


def plan(docs: DataFrame, mix: Mix) -> DataFrame:
    """The leaves' budgets and cutoffs, as a small written table."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = saved(docs.select("doc_id", *[c.alias(n) for n, c in _tree_columns(docs, mix).items()],
                             F.regexp_count(text, F.lit(WORDS)).cast("long").alias("tokens")), "mix-rows")
    sizes = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    leaves = saved(leaf_budgets(sizes, mix), "mix-leaves")
    return saved(cutoffs(rows, leaves, mix), "mix-plan")


def mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, lang, source, ...) in the mixture, one
    per epoch that takes them, with their columns and ``mix_epoch`` (from 0).

    Tokens are white-space-separated words; NULL texts have none.  NULL
    languages and sources are values of their own; rows that share a doc_id
    are in or out of a partial epoch together; a leaf without tokens gives
    nothing; empty input gives no rows; a column ``mix_epoch`` of the input is
    replaced.  Grants are rounded down at each node.
    """
    leaves = plan(docs, mix)
    names = {n: f"_mix_{n}" for n in LEVELS}
    # written above, so the planner knows its size and broadcasts it only
    # below its threshold
    small = leaves.select(*[F.col(n).alias(a) for n, a in names.items()],
                          F.col("epochs").alias("_mix_epochs"), F.col("cutoff").alias("_mix_cutoff"))
    keyed = docs.withColumns({names[n]: c for n, c in _tree_columns(docs, mix).items()})
    h = F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("_mix_epochs").cast("string"),
                          F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    times = F.col("_mix_epochs") + F.coalesce((h <= F.col("_mix_cutoff")).cast("long"), F.lit(0))
    return keyed.join(small, list(names.values())).withColumn("_mix_times", times).filter("_mix_times > 0") \
        .select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "mix_epoch"],
                F.explode(F.sequence(F.lit(0).cast("long"), F.col("_mix_times") - 1)).alias("mix_epoch"))


def oracle_sql(mix: Mix) -> str:
    """DuckDB SQL of the query op5: doc_id, domain, lang, source, epoch."""
    domain = "CASE " + " ".join(f"WHEN right(source, 1) = '{k}' THEN '{v}'" for k, v in mix.domains.items()) \
        + f" ELSE '{mix.other_domain}' END"

    def weight(level):
        own = mix.weights.get(level, {})
        return "(CASE " + " ".join(f"WHEN {level} = '{v}' THEN {w}" for v, w in own.items()) \
            + f" ELSE {mix.default} END)" if own else str(mix.default)

    def fill(name, nodes, parent, level):
        by = f"PARTITION BY {', '.join(parent)}" if parent else ""
        keys = ", ".join([*parent, level])
        return f"""{name}_w AS (SELECT *, {weight(level)}::HUGEINT AS w FROM ({nodes})),
 {name}_s AS (SELECT *,
   budget::HUGEINT - coalesce(sum(cap::HUGEINT) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l,
   sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r, row_number() OVER o AS i
   FROM {name}_w WINDOW o AS ({by} ORDER BY cap / w, {level})),
 {name}_k AS (SELECT {', '.join([*parent, 'min(i) AS k']) } FROM {name}_s WHERE NOT cap * r <= w * l
   {('GROUP BY ' + ', '.join(parent)) if parent else ''}),
 {name}_f AS (SELECT {', '.join('s.' + p for p in parent) + (',' if parent else '')} s.l AS fl, s.r AS fr
   FROM {name}_s s JOIN {name}_k k ON s.i = k.k {''.join(f' AND s.{p} = k.{p}' for p in parent)}),
 {name} AS (SELECT {', '.join('s.' + c for c in [*parent, level])}, s.cap,
   CASE WHEN s.cap * s.r <= s.w * s.l THEN s.cap ELSE greatest((s.w * f.fl) // f.fr, 0) END::BIGINT AS budget
   FROM {name}_s s LEFT JOIN {name}_f f ON {' AND '.join(f's.{p} = f.{p}' for p in parent) or 'true'})"""

    h = f"md5(concat('{mix.seed}:', d.epochs, ':', coalesce(d.doc_id::VARCHAR, '')))"
    return f"""WITH d0 AS (SELECT doc_id, {domain} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
   len(regexp_extract_all(coalesce(text, ''), '{WORDS}'))::BIGINT AS tokens FROM documents),
 leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, sum(tokens)::BIGINT * {mix.max_epochs} AS cap
   FROM d0 GROUP BY ALL),
 {fill('dom', f"SELECT domain, sum(cap)::BIGINT AS cap, (SELECT sum(tokens)::BIGINT * {mix.budget_permille} // 1000 FROM leaf) AS budget FROM leaf GROUP BY domain", [], 'domain')},
 {fill('lng', "SELECT leaf.domain, leaf.lang, sum(leaf.cap)::BIGINT AS cap, any_value(dom.budget) AS budget FROM leaf JOIN dom USING (domain) GROUP BY leaf.domain, leaf.lang", ['domain'], 'lang')},
 {fill('src', "SELECT leaf.domain, leaf.lang, leaf.source, leaf.cap, lng.budget FROM leaf JOIN lng USING (domain, lang)", ['domain', 'lang'], 'source')},
 plan AS (SELECT domain, lang, source, tokens AS supply, src.budget // tokens AS epochs, src.budget % tokens AS rest
   FROM leaf JOIN src USING (domain, lang, source) WHERE tokens > 0),
 d AS (SELECT * FROM d0 JOIN plan USING (domain, lang, source)),
 p AS (SELECT *, {h} AS h FROM d),
 c AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h RANGE UNBOUNDED PRECEDING) AS run FROM p),
 t AS (SELECT *, (epochs + CASE WHEN rest > 0 AND run <= rest THEN 1 ELSE 0 END)::BIGINT AS times FROM c)
SELECT doc_id, domain, lang, source, unnest(range(times)) AS epoch FROM t WHERE times > 0"""
