"""URL verdicts with aliases.

A URL is judged by rules on host and path first. URLs that redirect to each other or name
each other as canonical are aliases: connected components of that graph are found by Spark,
and a block decision on one member holds for every alias without a rule of its own. An explicit
allow rule always precedes a propagated block.

Edges come from the pages (canonical links and refresh redirects in the html) and from any table
of redirects. Only URLs with an edge enter the graph; pages without one are judged in
the scan.

Rules look at host and path; aliases are told apart by the whole URL up to its fragment.

Rows: a URL that is null or has no ``://`` has an empty host and path, no rule and no alias,
and is allowed. Null or empty html has no edges. Columns called like a result are replaced, others are kept. Repeated rows and ties are judged alike. An
empty table gives no rows. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import ascii_lower, shield, without
from colloquy.llm.components import connected_components
from colloquy.staging import stage

Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def with_rule(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``urls`` (with ``host`` and ``path``) and the longest rule that fits, in ``rule`` and
    ``_verdict``, null where none does."""
    ordered = _by_length(rules)
    numbered = urls.withColumn("_number", _number(F.col("host"), F.col("path"), ordered))
    return numbered.withColumns(
        {"rule": _entry(F.col("_number"), [r[1] + r[2] for r in ordered]), "_verdict": _entry(F.col("_number"), [r[0] for r in ordered])}
    ).drop("_number")


def _by_length(rules: Sequence[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow", r[1] + r[2]))


def _number(host: Column, path: Column, ordered: Sequence[Rule]) -> Column:
    """Number of the first rule that fits, or one past the last. A rule fits its host and all
    subdomains where the path starts with the rule's; of equally long rules an allow rule comes
    first. The rules are configuration: they become part of the plan."""
    number = F.lit(len(ordered) + 1)
    for at, (_, domain, start) in reversed([*enumerate(ordered, 1)]):
        fits = F.concat(F.lit("."), host).endswith("." + domain) & path.startswith(start)
        number = F.when(fits, F.lit(at)).otherwise(number)
    return number


def _entry(number: Column, entries: Sequence[str]) -> Column:
    """The entry of that number, null past the last one."""
    return F.get(F.array(*[F.lit(e) for e in entries]), number - 1)


def link_targets(html: Column) -> Column:
    """Targets of canonical links and refresh redirects, comments left out."""
    bare = F.regexp_replace(html, r"(?s)<!--.*?(-->|\z)", "")
    quoted = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
    links = F.filter(F.regexp_extract_all(bare, F.lit(r"(?is)<link\b[^>]*>"), F.lit(0)), lambda t: t.rlike(r"""(?is)\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""))
    metas = F.filter(F.regexp_extract_all(bare, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)), lambda t: t.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""))
    targets = F.concat(
        F.transform(links, lambda t: F.regexp_extract(t, quoted, 1)),
        F.transform(metas, lambda t: F.regexp_extract(t, r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>;]+)""", 1)),
    )
    # Most pages have neither: they are told apart by a plain search.
    return F.when(html.rlike("(?i)canonical|http-equiv"), F.filter(targets, lambda t: t != ""))


def _target_rest(target: Column, host: Column, path: Column, node: Column) -> Column:
    """A link target as seen from a page, from its host on: whole URLs, ``//host/path``, ``/path``,
    relative paths, a query alone, which stays on the page's own path, and a fragment alone, which stays on the page."""
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    return (
        F.when(target.contains("://"), _rest(target))
        .when(target.startswith("//"), target.substr(F.lit(3), F.length(target)))
        .when(target.startswith("/"), F.concat(host, target))
        .when(target.startswith("?"), F.concat(host, path, target))
        .when(target.startswith("#"), node)
        .otherwise(F.concat(host, F.when(folder == "", "/").otherwise(folder), target))
    )


def _node(rest: Column) -> Column:
    """A node is the URL from its host up to the fragment: pages that differ in the query are different ones."""
    return F.concat(ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1))


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Alias edges ``a``, ``b`` (nodes) that the pages state themselves."""
    own = _node(_rest(F.col(url))).alias("_own")
    found = pages.select(host_of(F.col(url)).alias("_host"), path_of(F.col(url)).alias("_path"), own, F.explode(link_targets(F.col(html))).alias("_to"))
    target = _node(_target_rest(F.col("_to"), F.col("_host"), F.col("_path"), F.col("_own")))
    return found.filter(F.col("_host") != "").select(F.col("_own").alias("a"), target.alias("b"))


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` without its html, with ``host``, ``path``, ``rule`` and ``verdict``.

    ``redirects`` are further edges, URLs in the columns ``source`` and ``target``.
    """
    edges = page_edges(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(*[_node(_rest(F.col(c))).alias(n) for c, n in (("source", "a"), ("target", "b"))]))
    edges = stage(edges.distinct(), "alias-edges").filter((F.col("a") != "") & (F.col("b") != "") & (F.col("a") != F.col("b")))

    pages, restore = shield(pages, [url, html], ["host", "path", "rule", "verdict"])
    own = without(pages, [html])
    judged = with_rule(pages.select(*own, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")), rules)
    if edges.isEmpty():
        return restore(judged.select(*own, "host", "path", "rule", F.coalesce("_verdict", F.lit("allow")).alias("verdict")))

    members = connected_components(edges)
    at = F.concat(F.lit("x://"), F.col("node"))
    known = with_rule(members.withColumn("host", host_of(at)).withColumn("path", path_of(at)), rules)
    blocked = known.filter(F.col("_verdict") == "block").select("component").distinct()
    aliases = members.join(blocked, "component", "left_semi").select(F.col("node").alias("_node"), F.lit("block").alias("_alias"))
    verdict = F.coalesce("_verdict", "_alias", F.lit("allow")).alias("verdict")
    return restore(judged.withColumn("_node", _node(_rest(F.col(url)))).join(aliases, "_node", "left").select(*own, "host", "path", "rule", verdict))
