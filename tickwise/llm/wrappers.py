"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host.

A page is a stream of tokens: opening and closing tags and text slots. A *wrapper* is such a stream with repeated groups ``(+ ...)`` and
optional groups ``(? ...)``, kept as nested elements so that a group never cuts an element in two. It starts as one page with neighbouring
like runs folded into repeated groups, and each further page is aligned with it: what both have stays, what only one has becomes optional, what
one has once and the other several times becomes repeated. Text always is a slot. Pages of a host differ in few ways, so each distinct folded
page is aligned once; wrappers of parts of a host merge by the same alignment, first in groups and then all, so that no task
sees all pages of a host.

The slots of a wrapper say where a host may keep its articles: under ``article``, else ``main`` or an element named like one, else
everywhere but in parts that are never article text (menus, headers, footers, forms and so on). Each page takes the first of these it has.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.frames import batch, column, small_enough, stored

SALTS = 32
LONGEST_UNIT = 4
DEEPEST = 60
SLICE_PAGES = 256

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(?P<raw>script|style|noscript|template|svg|math|iframe|textarea|select|title)\b(?P<rawattrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>.*?(?:</(?P=raw)\s*>|$)"
    r"|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*>"
    r"|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?][^>]*>", re.DOTALL | re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([^\s=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/]+)")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
                    "time tt u var wbr".split())
# A block that begins ends an open paragraph.
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
                    "pre section table ul".split())
_NEVER = frozenset("nav footer aside form head button dialog menu".split())
_NEVER_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar".split())
_NEVER_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal|newsletter|subscri\w+|sidebar|"
    r"side|menu|nav\w*|breadcrumbs?|header|masthead|footer|comments?|replies|reply|respond|disqus|shar\w+|social|related|recommend\w*|"
    r"widgets?|toolbar|pagination|pager|login|signup|search|skip)(?:$|[\s_-])", re.IGNORECASE)
_MAIN_NAME = re.compile(r"(?:^|[\s_-])(?:article|content|entry|post|story|main|body)(?:$|[\s_-])", re.IGNORECASE)

_PARTIAL = pa.schema([("host", pa.string()), ("wrapper", pa.string()), ("pages", pa.int64())])
_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("wrapped", pa.bool_())])


def _symbol(name: str, attributes: str) -> str:
    """A tag with what its class, id and role say of it: ``-`` never article text, ``+`` named like an article, else neither."""
    mark = ""
    if attributes.strip(" /"):
        found = {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        named = f"{found.get('class', '')} {found.get('id', '')}"
        if name not in ("html", "body", "article", "main"):
            if _NEVER_NAME.search(named) or found.get("role", "").lower() in _NEVER_ROLES or "hidden" in found:
                mark = "-"
        if not mark and (_MAIN_NAME.search(named) or found.get("role", "").lower() in ("main", "article")):
            mark = "+"
    return name + mark


def tokens(page: str) -> Iterator[tuple[str, str]]:
    """(symbol, text) of a page: ``<x`` opens, ``>x`` closes, ``#`` is text, ``|`` a break; unclosed tags are closed."""
    stack: list[str] = []
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "#", page[at:m.start()]
        at = m.end()
        if m["open"]:
            name = m["open"].lower()
            if name in _VOID:
                if name not in _INLINE:
                    yield "|", ""
                continue
            symbol = _symbol(name, m["attrs"])
            if name in _ENDS_P and any(s.rstrip("+-") == "p" for s in stack):
                while True:
                    top = stack.pop()
                    yield ">" + top, ""
                    if top.rstrip("+-") == "p":
                        break
            elif name == "li" and stack and stack[-1].rstrip("+-") == "li":
                yield ">" + stack.pop(), ""
            if not m["attrs"].rstrip().endswith("/"):
                stack.append(symbol)
                yield "<" + symbol, ""
        elif m["close"]:
            name = m["close"].lower()
            if any(s.rstrip("+-") == name for s in stack):
                while True:
                    top = stack.pop()
                    yield ">" + top, ""
                    if top.rstrip("+-") == name:
                        break
    if at < len(page):
        yield "#", page[at:]
    while stack:
        yield ">" + stack.pop(), ""


def skeleton(page: str) -> list:
    """A page as a list of nodes: ``#`` is a text slot, ``[tag, *nodes]`` an element; without inline tags, breaks and levels below DEEPEST."""
    root: list = []
    open_nodes, skipped = [root], 0
    for symbol, text in tokens(page):
        here = open_nodes[-1]
        if symbol == "#":
            if text.strip() and not (here and here[-1] == "#"):
                here.append("#")
        elif symbol == "|" or symbol[1:].rstrip("+-") in _INLINE:
            continue
        elif symbol[0] == "<":
            if len(open_nodes) > DEEPEST:
                skipped += 1
            else:
                here.append([symbol])
                open_nodes.append(here[-1])
        elif skipped:
            skipped -= 1
        else:
            open_nodes.pop()
    return root


def _open(node) -> tuple[list, bool, bool]:
    """What a node holds, whether it is optional, whether it is repeated."""
    optional = repeated = False
    held = [node]
    while len(held) == 1 and not isinstance(held[0], str) and held[0][0] in "?+":
        optional, repeated = optional or held[0][0] == "?", repeated or held[0][0] == "+"
        held = held[0][1:]
    return held, optional, repeated


def _close(held: list, optional: bool, repeated: bool) -> list:
    if repeated:
        held = [["+", *held]]
    return [["?", *held]] if optional else held


def _head(node) -> str:
    """What nodes are matched by: the tags they begin with, not what these hold."""
    return " ".join(n if isinstance(n, str) else n[0] for n in _open(node)[0])


def _join(a, b) -> list:
    """Two nodes with one head as one."""
    (ha, oa, ra), (hb, ob, rb) = _open(a), _open(b)
    held = [x if isinstance(x, str) else [x[0], *align(x[1:], y[1:])] for x, y in zip(ha, hb, strict=True)]
    return _close(held, oa or ob, ra or rb)


def fold(nodes: list) -> list:
    """Neighbouring runs of nodes with equal heads become one repeated group, shorter runs first."""
    nodes = [n if isinstance(n, str) or n[0] in "?+" else [n[0], *fold(n[1:])] for n in nodes]
    for size in range(1, LONGEST_UNIT + 1):
        heads, out, at = [_head(n) for n in nodes], [], 0
        while at < len(nodes):
            run, end = nodes[at:at + size], at + size
            while end + size <= len(nodes) and heads[at:at + size] == heads[end:end + size] and heads[at] != "#":
                run = [n for x, y in zip(run, nodes[end:end + size], strict=True) for n in _join(x, y)]
                end += size
            if end > at + size:
                if size == 1:
                    held, optional, _ = _open(run[0])
                    out += _close(held, optional, True)
                else:
                    out.append(["+", *run])
                at = end
            else:
                out.append(nodes[at])
                at += 1
        nodes = out
    return nodes


def align(a: list, b: list) -> list:
    """A wrapper for what both match: nodes that both have stay, nodes of one become optional, one against several becomes repeated."""
    ka, kb = [_head(n) for n in a], [_head(n) for n in b]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if ka[i] == kb[j] else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and ka[i] == kb[j]:
            out += _join(a[i], b[j])
            i, j = i + 1, j + 1
        elif j >= len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            held, _, repeated = _open(a[i])
            out += _close(held, True, repeated)
            i += 1
        else:
            held, _, repeated = _open(b[j])
            out += _close(held, True, repeated)
            j += 1
    return out


def slots(wrapper: list) -> set[str]:
    """The paths of open tags under which a wrapper has text slots."""
    found: set[str] = set()

    def walk(nodes: list, path: str) -> None:
        for n in nodes:
            if n == "#":
                found.add(path)
            elif n[0] in "?+":
                walk(n[1:], path)
            else:
                walk(n[1:], f"{path}/{n[0][1:]}" if path else n[0][1:])

    walk(wrapper, "")
    return found


def _never(path: list[str]) -> bool:
    inside = False
    for s in path:
        name = s.rstrip("+-")
        if s.endswith("-") or name in _NEVER or (name == "header" and not inside):
            return True
        inside = inside or name in ("article", "main")
    return False


def article_slots(paths: set[str]) -> list[list[str]]:
    """A host's text slots that may hold article text, in the order in which they are looked for: under article, else main, else named like one,
    else the rest. A page takes the first of these that it has text in, so that pages of another template are not lost."""
    fine = {p: p.split("/") for p in sorted(paths) if not _never(p.split("/"))}
    tiers: list[list[str]] = []
    for wanted in (lambda s: s.rstrip("+-") == "article", lambda s: s.rstrip("+-") == "main", lambda s: s.endswith("+"), lambda s: True):
        chosen = [p for p, tags in fine.items() if any(wanted(s) for s in tags)]
        if chosen:
            tiers.append(chosen)
            fine = {p: tags for p, tags in fine.items() if p not in set(chosen)}
    return tiers


def extract(page: str, tier_of: dict[str, int]) -> tuple[str, bool]:
    """The text of the page's slots of the least tier it has text in, blocks joined by a space; whether that is the host's first tier."""
    stack: list[str] = []
    blocks: list[list[tuple[int, str]]] = [[]]
    path, least = "", len(tier_of)
    for symbol, text in tokens(page):
        if symbol == "#":
            tier = tier_of.get(path)
            if tier is not None:
                blocks[-1].append((tier, text))
                if tier < least and text.strip():
                    least = tier
        elif symbol == "|":
            blocks.append([])
        elif symbol[1:].rstrip("+-") not in _INLINE:
            if symbol[0] == "<":
                stack.append(symbol[1:])
            else:
                while stack and stack.pop() != symbol[1:]:
                    pass
            path = "/".join(stack[:DEEPEST])
            blocks.append([])
    words = (w for b in blocks if b for w in entities.unescape("".join(t for tier, t in b if tier == least)).split())
    return " ".join(words), least == 0 and bool(tier_of)


def _infer(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host of a slice of pages."""
    for some in rows:
        for lo in range(0, some.num_rows, SLICE_PAGES):
            part = some.slice(lo, SLICE_PAGES)
            held: dict[str, tuple[dict, int]] = {}
            for host, page in zip(column(part, "host").to_pylist(), column(part, "html").to_pylist(), strict=True):
                folded = fold(skeleton(page or ""))
                shapes, pages = held.get(host, ({}, 0))
                shapes[json.dumps(folded)] = folded
                held[host] = (shapes, pages + 1)
            out = [(host, json.dumps(_merge(list(shapes.values()))), pages) for host, (shapes, pages) in held.items()]
            yield batch(_PARTIAL, list(zip(*out, strict=True)))


def _merge(wrappers: list[list]) -> list:
    """Longest first, so that shorter ones mostly add optional marks; the order does not depend on how rows arrived."""
    ordered = sorted(wrappers, key=lambda w: (-len(json.dumps(w)), json.dumps(w)))
    out = ordered[0]
    for w in ordered[1:]:
        out = align(out, w)
    return out


def _merge_rows(rows: pd.DataFrame) -> pd.DataFrame:
    merged = _merge([json.loads(w) for w in sorted(set(rows["wrapper"]))])
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [json.dumps(merged)], "pages": [int(rows["pages"].sum())],
                         "slots": [json.dumps(article_slots(slots(merged)))]})


def host_of(url) -> object:
    """The host of a URL column, lower case; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (nested lists as JSON), number of pages and article slots (JSON), from pages (url, html)."""
    kind = "host string, wrapper string, pages long"
    merged = kind + ", slots string"
    parts = pages.select(host_of(F.col("url").cast("string")).alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(_infer, kind)
    salted = parts.groupBy("host", "wrapper").agg(F.sum("pages").alias("pages")).withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    first = salted.groupBy("host", "salt").applyInPandas(lambda rows: _merge_rows(rows), merged)
    return first.drop("slots").groupBy("host").applyInPandas(lambda rows: _merge_rows(rows), merged)


def _extract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tiers_of: dict[str, dict[str, int]] = {}
    for some in rows:
        out = []
        for number, url, page, wrapper in zip(*(column(some, n).to_pylist() for n in ("page_id", "url", "html", "slots")), strict=True):
            if wrapper not in tiers_of:
                if len(tiers_of) > 10_000:
                    tiers_of.clear()
                tiers_of[wrapper] = {p: k for k, paths in enumerate(json.loads(wrapper or "[]")) for p in paths}
            text, fits = extract(page or "", tiers_of[wrapper])
            out.append((number, url, text, len(text), fits))
            if len(out) >= SLICE_PAGES:
                yield batch(_TEXT, list(zip(*out, strict=True)))
                out = []
        if out:
            yield batch(_TEXT, list(zip(*out, strict=True)))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and wrapped (whether the page has text where its host's articles stand first of all, or else its text comes from
    the next best slots it has) for every row of pages (page_id, url, html).

    Null or empty html gives empty text; a null or odd url belongs to the host without name; repeated rows give a row each; other
    columns are not read; an empty table gives an empty result.
    """
    table = stored(infer_wrappers(pages).select("host", "slots"), "slots")
    table = F.broadcast(table) if small_enough(table, F.length("slots") + F.length("host") + 32) else table
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"), host_of(F.col("url").cast("string")).alias("host"))
    return named.join(table, "host", "left").drop("host").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long, wrapped boolean")
