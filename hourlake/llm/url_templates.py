"""URL filter: rules first, then a tree of path templates for each host, with built-in functions only.

Urls that a rule decides are the labelled ones. The tree grows level by level over distinct paths with
their numbers of rows:

* a segment stays as it is where it has a tenth of its node's rows (``KEPT``, with ``PRIOR`` rows more, so
  that small nodes keep little); the others become wildcards by their form: ``{n}`` for digits, ``*.*``
  with a dot, else ``*``. So a node has at most ten literal branches and three wildcards;
* a branch that is statistically like the node's largest one is merged with it: none of the shares of rows
  that end here, go on in one way or another, or were allowed or blocked differs by more than Hoeffding's
  bound for both sizes;
* a template's purity is its share of blocked among labelled rows, smoothed by ``WEIGHT`` rows of its parent's
  purity, up to the host and all hosts. Templates with a purity over ``REJECT`` are rejected.

Equal urls are one row before anything else, so hosts and urls with a third of all rows are added up before
their shuffle; what is joined to them holds a few rows a node. Nothing but three counts reaches the driver.

Cases: a null url, or one without ``://``, has an empty host and path, and is judged with all others of
that host. Null page_ids and repeated rows are judged like any other; an empty table gives an empty one;
other columns are ignored. Segments beyond ``DEPTH`` are one last segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.tables import stored

Rule = tuple[str, str, str]

# The contract's rules as verdict, host, path.
RULES: tuple[Rule, ...] = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# End of fixed values.

KEPT, PRIOR = 10, 20
#: sqrt(ln(2 / 0.05) / 2)
BOUND = 1.3581015157406195
WEIGHT, REJECT = 5, 0.5
DEPTH = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What is compared between branches, as shares of their rows.
_FEATURES = ("ended", "indexed", "numbered", "dotted", "allowed", "blocked")


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path`` of the url; columns of these names are replaced."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(F.col(url))))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})


def _ruled(rules: Sequence[Rule], value: int) -> Column:
    """The longest fitting rule: its name (``value`` 1) or its verdict (0). Of equally long ones, that with the
    longer host, then blocking before allowing."""
    found = F.lit(None).cast("string")
    order = sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"))
    for verdict, host, path in order:
        inside = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        found = F.when(inside & F.col("path").startswith(path), (verdict, host + path)[value]).otherwise(found)
    return found


def _wildcard(segment: Column) -> Column:
    return (
        F.when(segment.isNull() | (segment == ""), segment)
        .when(segment.rlike("^[0-9]+$"), "{n}")
        .when(segment.contains("."), "*.*")
        .otherwise("*")
    )


def _purity(parent: Column) -> Column:
    return (F.col("blocked") + WEIGHT * parent) / (F.col("allowed") + F.col("blocked") + WEIGHT)


def distinct_urls(parts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """host, path, segments, rows, and how many of them a rule allowed or blocked."""
    verdict = _ruled(rules, 0)
    segments = F.split("path", "/", -1)
    segments = F.slice(segments, F.lit(2), F.size(segments))
    tail = F.array(F.array_join(F.slice(segments, F.lit(DEPTH), F.size(segments)), "/"))
    short = F.when(
        F.size(segments) > DEPTH, F.concat(F.slice(segments, F.lit(1), F.lit(DEPTH - 1)), tail)
    ).otherwise(segments)
    return (
        parts.groupBy("host", "path")
        .agg(F.count("*").alias("n"))
        .select(
            "host",
            "path",
            short.alias("segments"),
            "n",
            F.when(verdict == "allow", F.col("n")).otherwise(0).alias("allowed"),
            F.when(verdict == "block", F.col("n")).otherwise(0).alias("blocked"),
        )
    )


def _onto(rows: DataFrame, found: DataFrame, keys: list[str], how: str) -> DataFrame:
    renamed = found.withColumnsRenamed({k: f"_{k}" for k in keys})
    joined = rows.join(renamed, [rows[k] == renamed[f"_{k}"] for k in keys], how)
    return joined.drop(*(f"_{k}" for k in keys))


def literals(here: DataFrame) -> DataFrame:
    """The segments that stay as they are: host, node, segment, ``literal``."""
    children = here.groupBy("host", "node", "segment").agg(F.sum("n").alias("c"))
    totals = children.groupBy("host", "node").agg(F.sum("c").alias("total"))
    frequent = children.where(KEPT * F.col("c") >= PRIOR)
    kept = _onto(frequent, totals, ["host", "node"], "inner").where(KEPT * F.col("c") >= F.col("total") + PRIOR)
    return kept.select("host", "node", "segment", F.col("segment").alias("literal"))


def branches(named: DataFrame, level: int) -> DataFrame:
    """host, node, name → ``branch``, the name of what it is merged into, and its ``purity``."""
    following = _wildcard(F.get("segments", F.lit(level + 1)))
    n = F.col("n")
    sums = named.groupBy("host", "node", "name").agg(
        F.sum(n).alias("rows"),
        F.sum(F.when(following.isNull(), n).otherwise(0)).alias("ended"),
        *(
            F.sum(F.when(following == form, n).otherwise(0)).alias(f)
            for f, form in zip(_FEATURES[1:4], ("", "{n}", "*.*"), strict=True)
        ),
        F.sum("allowed").alias("allowed"),
        F.sum("blocked").alias("blocked"),
        F.max("purity").alias("parent"),
    )
    # At most ten literals, three wildcards and the empty segment in a node.
    by_size = Window.partitionBy("host", "node").orderBy(F.desc("rows"), "name")
    largest = by_size.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    like = F.lit(True)
    for f in _FEATURES:
        share, other = F.col(f) / F.col("rows"), F.first(f).over(largest) / F.first("rows").over(largest)
        reach = BOUND * (1 / F.sqrt("rows") + 1 / F.sqrt(F.first("rows").over(largest)))
        like &= F.abs(share - other) <= reach
    marked = sums.withColumn("group", F.when(like, "").otherwise(F.concat(F.lit("/"), "name")))
    names = F.array_sort(F.collect_list("name"))
    merged = marked.groupBy("host", "node", "group").agg(
        names.alias("names"),
        F.sum("allowed").alias("allowed"),
        F.sum("blocked").alias("blocked"),
        F.max("parent").alias("parent"),
    )
    label = F.when(F.size("names") > 1, F.concat(F.lit("("), F.array_join("names", "|"), F.lit(")"))).otherwise(
        F.get("names", F.lit(0))
    )
    purity = _purity(F.col("parent")).alias("purity")
    return merged.select("host", "node", F.explode("names").alias("name"), label.alias("branch"), purity)


def templates(parts: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """host, path, ``template`` and ``purity`` of each distinct url of ``parts``."""
    urls = stored(distinct_urls(parts, rules), "urls")
    total = urls.agg(
        F.coalesce(F.sum("allowed"), F.lit(0)).alias("allowed"),
        F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked"),
        F.coalesce(F.max(F.size("segments")), F.lit(0)).alias("depth"),
    ).first()
    overall = (total["blocked"] + WEIGHT * 0.5) / (total["allowed"] + total["blocked"] + WEIGHT)
    hosts = urls.groupBy("host").agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
    hosts = hosts.select("host", _purity(F.lit(overall)).alias("purity"))
    tree = _onto(urls, hosts, ["host"], "inner").withColumn("node", F.lit(""))
    columns = ["host", "path", "segments", "n", "allowed", "blocked", "node", "purity"]
    tree, done = stored(tree.select(*columns), "url-tree"), []
    for level in range(total["depth"]):
        done.append(tree.where(F.size("segments") <= level))
        here = tree.where(F.size("segments") > level).withColumn("segment", F.get("segments", F.lit(level)))
        name = F.coalesce("literal", _wildcard(F.col("segment")))
        named = _onto(here, literals(here), ["host", "node", "segment"], "left").withColumn("name", name)
        named = stored(named.select(*columns, "name"), "url-names")
        found = _onto(named.drop("purity"), branches(named, level), ["host", "node", "name"], "inner")
        node = F.concat("node", F.lit("/"), "branch")
        tree = stored(found.withColumn("node", node).select(*columns), "url-tree")
    for part in done:
        tree = tree.union(part)
    return tree.select("host", "path", F.col("node").alias("template"), "purity")


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the url's template and purity, for each row."""
    parts = with_parts(pages.select("page_id", "url")).select("page_id", "host", "path")
    found = templates(parts, rules)
    learned = F.when(F.col("purity") > REJECT, "block").otherwise("allow")
    return _onto(parts, found, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        _ruled(rules, 1).alias("rule"),
        F.coalesce(_ruled(rules, 0), learned).alias("verdict"),
        "template",
        "purity",
    )
