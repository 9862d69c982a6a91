"""URL filters: rules first, then a tree of path templates for each host. DataFrame operations only.

Paths are read as segments. A segment's digits count as a wildcard; a node of the tree with many
different children has its children replaced by one wildcard, save those whose labels set them apart.
So each URL gets a template, which says what its path looks like.

Verdicts come from a second tree of the same paths, by labels alone: at each node, whatever the number of
its children, those whose labelled pages differ from the rest stay apart, and all others are merged into a
wildcard. It goes down as long as a branch has good and bad pages. A branch is rejected if the smoothed share
of good ones among its labelled pages is too low.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.tables import fresh, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Tree:
    """Templates tell ``depth`` segments apart; the rest is one tail, save for what its labels set apart. More
    than ``fanout`` children make a wildcard, save those with ``enough`` labelled pages whose share of good ones
    differs from the others' by over ``apart`` errors. None of the three bears on verdicts: there a child is its own
    branch if its share, smoothed by ``prior_rows`` pages of its node's average, differs from its siblings' by over
    ``apart`` errors. A branch is rejected when its purity, smoothed by as many pages of the average, is below
    ``purity``."""

    depth: int = 4
    fanout: int = 30
    prior_rows: float = 20.0
    purity: float = 0.5
    enough: int = 20
    apart: float = 4.0


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule whose host is the URL's or a parent domain of it and whose path begins the URL's:
    a struct of ``size, rule, verdict``, null if none fits."""
    fits = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    nothing = F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    return F.array_max(F.array(nothing, *fits))


def segments(path: Column) -> Column:
    """The path's segments with digits as ``*``."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    parts = F.transform(parts, lambda s: F.regexp_replace(s, r"[0-9]+", "*"))
    # A closing slash is part of the template.
    return F.when(path.endswith("/"), F.concat(parts, F.array(F.lit("")))).otherwise(parts)


def n_parts() -> Column:
    """Segments of ``shape`` without the closing slash."""
    return F.size("shape") - F.when(F.try_element_at("shape", F.lit(-1)) == "", 1).otherwise(0)


def set_apart(n: Column, k: Column, n_all: Column, k_all: Column, tree: Tree) -> Column:
    """Whether ``n`` labelled pages, ``k`` of them good, differ from the rest of all."""
    one = F.lit(1.0)
    mean = F.try_divide(k_all, n_all)
    error = F.sqrt(mean * (one - mean) * (F.try_divide(one, n) + F.try_divide(one, n_all - n)))
    gap = F.abs(F.try_divide(k, n) - F.try_divide(k_all - k, n_all - n))
    return F.coalesce((n >= tree.enough) & (gap > tree.apart * error), F.lit(False))


def grown(rows: DataFrame, level: int, tree: Tree) -> DataFrame:
    """``rows`` with ``template`` one level longer where ``open``. Children are counted and compared with
    partial aggregation; what is joined back are wide nodes and children with labels enough."""
    child = F.get("shape", F.lit(level))
    rows = rows.withColumn("child", child)
    kids = rows.filter("open").groupBy("host", "template", "child").agg(F.sum("labelled").alias("n"), F.sum("good").alias("k"))
    nodes = kids.groupBy("host", "template").agg(F.count(F.lit(1)).alias("children"), F.sum("n").alias("n_all"), F.sum("k").alias("k_all"))
    nodes = nodes.filter(F.col("children") > tree.fanout)
    own = kids.join(nodes, ["host", "template"]).filter(set_apart(F.col("n"), F.col("k"), F.col("n_all"), F.col("k_all"), tree))
    own = own.select("host", "template", "child", F.lit(True).alias("own"))
    wide = nodes.select("host", "template", F.lit(True).alias("wide"))
    out = rows.join(wide, ["host", "template"], "left").join(own, ["host", "template", "child"], "left")
    step = F.when(F.col("wide") & F.col("own").isNull(), F.lit("*")).otherwise(F.col("child"))
    return out.withColumn("template", F.when(F.col("open"), F.concat("template", F.array(step))).otherwise(F.col("template"))).drop("child", "wide", "own")


def tails(deep: DataFrame, tree: Tree) -> DataFrame:
    """``deep(host, shape, labelled, good, template)`` with templates beyond ``depth``: the longest beginning
    of the path whose labels set it apart from the others below the same node, and ``**`` for the rest.

    Goes down as long as a branch has labels enough, good ones and bad: any other has no part to set apart.
    """
    sums = (F.sum("labelled").alias("n"), F.sum("good").alias("k"))
    mixed = (F.col("n") >= tree.enough) & (F.col("k") > 0) & (F.col("k") < F.col("n"))
    totals = deep.groupBy("host", "template").agg(*sums).select("host", F.col("template").alias("base"), F.col("n").alias("n_all"), F.col("k").alias("k_all"))
    rows = deep.withColumns({"base": F.col("template"), "found": F.col("template")}).join(totals, ["host", "base"])
    open_now = (F.col("n_all") >= tree.enough) & (F.col("k_all") > 0) & (F.col("k_all") < F.col("n_all"))
    rows = stored(rows.withColumn("open", open_now), "url-tails")
    level = tree.depth
    while not rows.filter("open").isEmpty():
        rows = stored(grown(rows, level, tree), "url-tails")
        level += 1
        branches = rows.filter("open").groupBy("host", "template").agg(*sums)
        rows = rows.join(branches, ["host", "template"], "left")
        better = F.col("open") & set_apart(F.col("n"), F.col("k"), F.col("n_all"), F.col("k_all"), tree)
        rows = rows.withColumns(
            {"found": F.when(better, F.col("template")).otherwise(F.col("found")), "open": F.col("open") & mixed & (n_parts() > level)}
        )
        rows = stored(rows.drop("n", "k"), "url-tails")
    nothing = F.array().cast("array<string>")
    rest = F.when(F.size("found") < n_parts(), F.array(F.lit("**"))).otherwise(nothing)
    slash = F.when(F.try_element_at("shape", F.lit(-1)) == "", F.array(F.lit(""))).otherwise(nothing)
    return rows.withColumn("template", F.concat("found", rest, slash)).select(*deep.columns)


def generalise(lexical: DataFrame, tree: Tree) -> DataFrame:
    """``lexical(host, shape, ...)`` with ``template``: level by level, the children of nodes with more
    than ``fanout`` different ones become a wildcard, but for those that their labels set apart. One row for
    each host and shape goes through it."""
    out = lexical.withColumn("template", F.array().cast("array<string>"))
    for level in range(tree.depth):
        out = stored(grown(out.withColumn("open", F.size("shape") > level), level, tree).drop("open"), "url-tree")
    deep = out.filter(n_parts() > tree.depth)
    flat = out.filter(n_parts() <= tree.depth)
    rest = F.slice("shape", tree.depth + 1, F.greatest(F.size("shape") - tree.depth, F.lit(0)))
    flat = flat.withColumn("template", F.concat("template", rest))
    return flat if deep.isEmpty() else flat.unionByName(tails(deep, tree))


def differs(n: Column, k: Column, n_all: Column, k_all: Column, tree: Tree) -> Column:
    """Whether ``n`` labelled pages of a child, ``k`` of them good, differ from the rest of its node.

    The child's share is smoothed, so few pages differ little; no number of pages or of siblings is a border.
    """
    one = F.lit(1.0)
    mean = F.try_divide(k_all, n_all)
    smooth = (k + tree.prior_rows * mean) / (n + tree.prior_rows)
    error = F.sqrt(mean * (one - mean) * (one / (n + tree.prior_rows) + F.try_divide(one, n_all - n)))
    gap = F.abs(smooth - F.try_divide(k_all - k, n_all - n))
    return F.coalesce(gap > tree.apart * error, F.lit(False))


def branches(shapes: DataFrame, tree: Tree) -> DataFrame:
    """``shapes(host, shape, labelled, good)`` with ``branch``: the path with ``*`` for what labels don't set apart.

    All rows go down level by level while their branch holds good and bad pages; what is left of a path below
    is of no account. Sums are made by partial aggregation, and only children that differ are joined back.
    """
    sums = (F.sum("labelled").alias("n"), F.sum("good").alias("k"))
    mixed = (F.col("k") > 0) & (F.col("k") < F.col("n"))

    def reopened(rows: DataFrame, level: int) -> DataFrame:
        held = rows.groupBy("host", "branch").agg(*sums).filter(mixed).select("host", "branch", F.lit(True).alias("mixed"))
        out = rows.join(held, ["host", "branch"], "left")
        return out.withColumn("open", F.col("mixed").isNotNull() & (F.size("shape") > level)).drop("mixed")

    level = 0
    rows = stored(reopened(shapes.withColumn("branch", F.array().cast("array<string>")), level), "url-branches")
    while not rows.filter("open").isEmpty():
        rows = rows.withColumn("child", F.when(F.col("open"), F.get("shape", F.lit(level))))
        kids = rows.filter("open").groupBy("host", "branch", "child").agg(*sums)
        nodes = kids.groupBy("host", "branch").agg(F.sum("n").alias("n_all"), F.sum("k").alias("k_all"))
        apart = kids.join(nodes, ["host", "branch"]).filter(differs(F.col("n"), F.col("k"), F.col("n_all"), F.col("k_all"), tree))
        rows = rows.join(apart.select("host", "branch", "child", F.lit(True).alias("own")), ["host", "branch", "child"], "left")
        step = F.when(F.col("own"), F.col("child")).otherwise("*")
        rows = rows.withColumn("branch", F.when(F.col("open"), F.concat("branch", F.array(step))).otherwise(F.col("branch")))
        level += 1
        closed = rows.filter("not open").drop("child", "own", "open").withColumn("open", F.lit(False))
        rows = stored(reopened(rows.filter("open").drop("child", "own", "open"), level).unionByName(closed), "url-branches")
    return rows.drop("open")


def judged(shapes: DataFrame, tree: Tree) -> DataFrame:
    """``shapes(host, shape, branch, labelled, good, ...)`` with ``purity`` and ``rejected`` of their branches."""
    mean = shapes.agg(F.try_divide(F.sum("good"), F.sum("labelled")).alias("mean")).scalar()
    mean = F.coalesce(mean, F.lit(1.0))
    totals = shapes.groupBy("host", "branch").agg(F.sum("labelled").alias("n"), F.sum("good").alias("k"))
    purity = (F.col("k") + tree.prior_rows * mean) / (F.col("n") + tree.prior_rows)
    rated = totals.select("host", "branch", purity.alias("purity"), (purity < tree.purity).alias("rejected"))
    return shapes.join(rated, ["host", "branch"])


def url_verdicts(
    pages: DataFrame,
    rules: list[Rule],
    labelled: DataFrame,
    tree: Tree = Tree(),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template`` for every row of ``pages``.

    ``labelled(url, good)`` are URLs with known quality (1 good, 0 bad; nulls are left out). A null URL, or one
    without ``://``, has an empty host and path, which no rule fits; its template is empty. Without any
    label everything that no rule blocks is allowed. ``purity`` is that of the URL's branch. Repeated rows are judged alike; an empty table gives
    an empty result; other columns are ignored.

    Rows are summed by host and shape with partial aggregation, so a host with any share of the rows
    takes part in the tree with its shapes only. The verdicts come back by a join of two stored tables,
    which Spark broadcasts if small, or splits where a host is hot.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("shape", segments(F.col("path")))
    marks = labelled.filter(F.col("good").isNotNull()).select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "good")
    marks = marks.select("host", segments(F.col("path")).alias("shape"), "good")
    seen = rows.select("host", "shape", F.lit(0).alias("labelled"), F.lit(0).alias("good"))
    both = seen.unionByName(marks.select("host", "shape", F.lit(1).alias("labelled"), F.col("good").cast("int").alias("good")))
    shapes = both.groupBy("host", "shape").agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good"))
    shapes = stored(generalise(stored(shapes, "url-shapes"), tree), "url-templates")
    verdicts = judged(branches(shapes, tree), tree).select("host", "shape", "template", "purity", "rejected")
    verdicts = stored(verdicts, "url-verdicts")
    (fit,) = fresh(rows, "fit")
    joined = rows.join(verdicts, ["host", "shape"], "left").withColumn(fit, matching_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        "page_id",
        "host",
        "path",
        F.col(fit)["rule"].alias("rule"),
        F.coalesce(F.col(fit)["verdict"], own).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
        "purity",
    )
