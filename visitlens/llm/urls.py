"""URL filter: explicit rules, and for what no rule fits a tree of path templates for every host.

The tree is built level by level over distinct (host, path), all of them, by DataFrame functions alone:

- **Wildcards.** A segment stays literal where at least 1 / ``SHARE`` of its node's pages have it, and at
  least ``LEAST`` pages; every other one is variable and becomes a wildcard of its shape (``*int``, ``*word``,
  ...). A node therefore has at most ``SHARE`` literal branches and one for each shape.
- **Merging.** Branches of a node merge where Hoeffding's bound tells neither what follows in them (the
  shape of the next segment, the number of segments) nor their labels apart. In descending order of pages, a branch like none before it leads; others
  join the first leader they are like, or else stay alone.
- **Verdict.** A template is rejected if its smoothed purity, the share of blocked among its labelled
  pages, is ``PURE`` or more. The smoothing counts ``SMOOTH`` + sqrt(unlabelled pages) more pages, half of them
  blocked: labels come from rules rather than from a random sample, so the less of a template they cover,
  the less they say. Templates without labels are allowed.

Segments from the ``LEVELS``-th on are one last segment; a path of any length is read as a whole. Statistics
are combining sums. A host with a third of all pages shuffles by (host, node, segment), and joins with rows of
one node each split where they are skewed.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule, and the verdict of
the template of that host; repeated rows are judged alike; ties go to the lower label; an empty table gives no
rows; columns other than ``page_id`` and ``url`` are ignored.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import Shelf, read
from visitlens.operators.bounds import reshuffled

SHARE = 32
LEAST = 8
DOUBT = 0.05
SMOOTH = 4
PURE = 0.8
LEVELS = 8

BOUND = math.sqrt(math.log(2 / DOUBT) / 2)

# What follows in a branch: nothing, or a segment of one of these shapes; how many segments follow.
SHAPES = ("empty", "int", "word", "page", "tail", "mixed")
FOLLOWS = ("end", *SHAPES)
LEFT = {"left_1": "= 1", "left_2": "= 2", "left_more": "> 2"}
KINDS = (*(f"to_{k}" for k in FOLLOWS), *LEFT, "blocked", "allowed")


@dataclass(frozen=True)
class Rule:
    """Fits pages of ``host`` and of all its subdomains whose path starts with ``path``."""

    action: str
    host: str
    path: str

    @classmethod
    def of(cls, action: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(action, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    Rule.of("allow", "com/"),
    Rule.of("block", "example.com/en/"),
    Rule.of("allow", "www.example.com/en/"),
    Rule.of("block", "net/es/"),
    Rule.of("block", "net/fr/"),
)


def host_and_path(url: str | Column = "url") -> tuple[Column, Column]:
    url = (F.col(url) if isinstance(url, str) else url).cast("string")
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(rules: Sequence[Rule], host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """Text and action of the longest rule that fits, of equal ones the lower; null if none does."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)) & F.col(path).startswith(rule.path)
        text, action = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.action).otherwise(action)
    return text, action


def shape(segment: Column) -> Column:
    return (
        F.when(segment == "", "empty").when(segment.rlike("^[0-9]+$"), "int").when(segment.rlike("^[A-Za-z]+$"), "word")
        .when(F.contains(segment, F.lit("/")), "tail").when(F.contains(segment, F.lit(".")), "page").otherwise("mixed")
    )


def segments(path: Column, levels: int) -> Column:
    """None for the empty path; the last one of ``levels`` has all that is left."""
    every = F.split(F.substr(path, F.lit(2)), "/")
    tail = F.array(F.array_join(F.slice(every, levels, F.greatest(F.size(every), F.lit(1))), "/"))
    cut = F.when(F.size(every) > levels, F.concat(F.slice(every, 1, levels - 1), tail)).otherwise(every)
    return F.when(path == "", F.array().cast("array<string>")).otherwise(cut)


def alike(x: Column, y: Column) -> Column:
    """No share of pages differs by as much as chance would allow seldom."""
    slack = F.lit(BOUND) * (F.lit(1.0) / F.sqrt(x["n"]) + F.lit(1.0) / F.sqrt(y["n"]))
    same = F.lit(True)
    for kind in KINDS:
        same = same & (F.abs(x[kind] / x["n"] - y[kind] / y["n"]) < slack)
    return same


def homes(branches: Column) -> Column:
    """label -> label of the branch it merges into, of a node's branches (a bounded array)."""
    leads = F.filter(branches, lambda x: ~F.exists(
        branches, lambda y: (y["order"] < x["order"]) & alike(x, y)))
    ranked = F.transform(branches, lambda x: F.struct(x["label"].alias("key"), F.coalesce(
        F.get(F.filter(leads, lambda y: (y["order"] == x["order"]) | ((y["order"] < x["order"]) & alike(x, y))), F.lit(0))["label"],
        x["label"]).alias("value")))
    return F.map_from_entries(ranked)


def sums(*columns: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def level_nodes(live: DataFrame, depth: int, share: int, least: int) -> DataFrame:
    """host, node, homes: what every node of a level makes of the segment that follows."""
    segment, after = F.get("segments", F.lit(depth)), F.get("segments", F.lit(depth + 1))
    counted = live.select("host", "node", segment.alias("segment"), F.when(after.isNull(), "end").otherwise(shape(after)).alias("follows"),
                          (F.size("segments") - (depth + 1)).alias("ahead"), "n", "blocked", "allowed")
    tests = {f"to_{k}": F.col("follows") == k for k in FOLLOWS} | {k: F.expr(f"ahead {test}") for k, test in LEFT.items()}
    children = counted.groupBy("host", "node", "segment").agg(
        *sums("n", "blocked", "allowed"), *[F.sum(F.when(test, F.col("n")).otherwise(0)).alias(k) for k, test in tests.items()])
    totals = children.groupBy("host", "node").agg(F.sum("n").alias("total"))
    literal = (F.col("n") * share >= F.col("total")) & (F.col("n") >= least)
    label = F.when(literal, F.concat(F.lit("="), "segment")).otherwise(F.concat(F.lit("*"), shape(F.col("segment"))))
    branches = children.join(reshuffled(totals), ["host", "node"]).groupBy("host", "node", label.alias("label")).agg(*sums("n", *KINDS))
    branch = F.struct(F.struct((-F.col("n")).alias("n"), "label").alias("order"), "label", "n", *KINDS)
    return branches.groupBy("host", "node").agg(F.array_sort(F.collect_list(branch)).alias("branches")).select(
        "host", "node", homes(F.col("branches")).alias("homes"))


def templates(spark: SparkSession, paths: DataFrame, levels: int = LEVELS, share: int = SHARE, least: int = LEAST) -> DataFrame:
    """``paths``: host, path, n, blocked, allowed of distinct (host, path). Adds ``template``."""
    shelf = Shelf(spark, "urls")
    rows = shelf.keep(paths.select("*", segments(F.col("path"), levels).alias("segments"), F.lit("").alias("node")), "paths")
    deepest = rows.agg(F.max(F.size("segments"))).collect()[0][0] or 0
    for depth in range(deepest):
        live = rows.where(F.size("segments") > depth)
        nodes = level_nodes(live, depth, share, least)
        segment = F.get("segments", F.lit(depth))
        found = F.coalesce(F.element_at("homes", F.concat(F.lit("="), segment)), F.element_at("homes", F.concat(F.lit("*"), shape(segment))))
        walked = live.join(reshuffled(nodes), ["host", "node"]).withColumn("node", F.concat_ws("/", "node", found))
        rows = shelf.keep(walked.select(*rows.columns).unionByName(rows.where(F.size("segments") <= depth)), "level")
    return rows.withColumnRenamed("node", "template").drop("segments")


def verdicts(paths: DataFrame, smooth: int = SMOOTH, pure: float = PURE) -> DataFrame:
    """host, path, template, purity and ``rejected`` of what :func:`templates` returns."""
    every = paths.groupBy("host", "template").agg(*sums("n", "blocked", "allowed"))
    more = F.lit(float(smooth)) + F.sqrt(F.col("n") - F.col("blocked") - F.col("allowed"))
    purity = (F.col("blocked") + more / F.lit(2.0)) / (F.col("blocked") + F.col("allowed") + more)
    every = every.select("host", "template", purity.alias("purity"), (purity >= F.lit(pure)).alias("rejected"))
    return paths.select("host", "path", "template").join(reshuffled(every), ["host", "template"])


def judge(spark: SparkSession, pages: DataFrame, rules: Sequence[Rule] = RULES, **options) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block: the rule's, else that of the path's template),
    template, purity."""
    host, path = host_and_path()
    rule, action = rule_of(rules)
    pages = pages.select("page_id", host.alias("host"), path.alias("path")).select("*", rule.alias("rule"), action.alias("action"))
    count = lambda what: F.count(F.when(F.col("action") == what, 1)).alias(f"{what}ed")
    paths = pages.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), count("block"), count("allow"))
    judged = verdicts(templates(spark, paths, **options))
    verdict = F.coalesce("action", F.when(F.col("rejected"), "block").otherwise("allow"))
    return pages.join(reshuffled(judged), ["host", "path"]).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")


def op11_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark, read(spark, sf_dir, "pages"))


def _shape_sql(x: str) -> str:
    return (f"case when {x} = '' then 'empty' when regexp_matches({x}, '^[0-9]+$') then 'int' when regexp_matches({x}, '^[A-Za-z]+$') "
            f"then 'word' when contains({x}, '/') then 'tail' when contains({x}, '.') then 'page' else 'mixed' end")


def _level_sql(d: int) -> str:
    """The branches of level ``d`` by joins of siblings, where the operator folds arrays."""
    every = ", ".join(f"sum({k})::bigint as {k}" for k in ("n", *KINDS))
    alike = " and ".join(f"abs(x.{k} / x.n - y.{k} / y.n) < {BOUND!r} * (1.0::double / sqrt(x.n) + 1.0::double / sqrt(y.n))" for k in KINDS)
    before = "x.host = y.host and x.node = y.node and (y.n > x.n or y.n = x.n and y.label < x.label)"
    flags = ", ".join([*(f"case when follows = '{k}' then n else 0 end as to_{k}" for k in FOLLOWS),
                       *(f"case when ahead {test} then n else 0 end as {k}" for k, test in LEFT.items()), "blocked, allowed"])
    return f"""
live{d} as materialized (
  select host, path, n, blocked, allowed, segments, node, segments[{d + 1}] as segment,
    len(segments) - {d + 1} as ahead, case when len(segments) = {d + 1} then 'end' else {_shape_sql(f'segments[{d + 2}]')} end as follows
  from rows{d} where len(segments) > {d}
), children{d} as materialized (
  select host, node, segment, {every} from (select host, node, segment, n, {flags} from live{d}) group by all
), branches{d} as materialized (
  select host, node, label, {every} from (
    select *, case when n * {SHARE} >= sum(n) over (partition by host, node) and n >= {LEAST} then '=' || segment
      else '*' || {_shape_sql('segment')} end as label from children{d}) group by host, node, label
), leads{d} as materialized (
  select * from branches{d} x where not exists (select 1 from branches{d} y where {before} and {alike})
), homes{d} as materialized (
  select x.host, x.node, x.label, coalesce(min_by(y.label, (-y.n, y.label)), x.label) as home
  from branches{d} x left join leads{d} y on {before} and {alike} group by x.host, x.node, x.label
), rows{d + 1} as materialized (
  select l.host, l.path, l.n, l.blocked, l.allowed, l.segments, l.node || '/' || coalesce(a.home, b.home) as node
  from live{d} l left join homes{d} a on a.host = l.host and a.node = l.node and a.label = '=' || l.segment
    left join homes{d} b on b.host = l.host and b.node = l.node and b.label = '*' || {_shape_sql('l.segment')}
  union all select * from rows{d} where len(segments) <= {d}
),"""


def _oracle() -> str:
    fits = " ".join(
        f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') then {{{i}}}"
        for i, r in enumerate(sorted(RULES, key=lambda r: (-len(r.text), r.text))))
    ordered = sorted(RULES, key=lambda r: (-len(r.text), r.text))
    text, action = (fits.format(*[f"'{value(r)}'" for r in ordered]) for value in (lambda r: r.text, lambda r: r.action))
    more = f"({SMOOTH}.0::double + sqrt(n - blocked - allowed))"
    levels = "".join(_level_sql(d) for d in range(LEVELS))
    return f"""
with rest as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rest
), urls as materialized (
  select *, case {text} end as rule, case {action} end as action from parts
), rows0 as materialized (
  select host, path, count(*) as n, count(*) filter (action = 'block') as blocked, count(*) filter (action = 'allow') as allowed,
    case when path = '' then [] when len(string_split(path, '/')) - 1 > {LEVELS}
      then string_split(path, '/')[2:{LEVELS}] || [array_to_string(string_split(path, '/')[{LEVELS + 1}:], '/')]
      else string_split(path, '/')[2:] end as segments, '' as node
  from urls group by host, path
),{levels}
judged as (
  select host, node, (blocked + {more} / 2.0::double) / (blocked + allowed + {more}) as purity
  from (select host, node, sum(n)::bigint as n, sum(blocked)::bigint as blocked, sum(allowed)::bigint as allowed
    from rows{LEVELS} group by all)
)
select page_id, u.host, u.path, rule, coalesce(action, case when purity >= {PURE!r} then 'block' else 'allow' end) as verdict,
  r.node as template, purity
from urls u join rows{LEVELS} r on r.host = u.host and r.path = u.path join judged j on j.host = r.host and j.node = r.node
"""


ORACLE = _oracle()
