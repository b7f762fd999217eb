"""Main text of web pages, by wrappers: union-free expressions over tags that are inferred for each host."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolex.llm.common import batched, slices

CHUNK = 256
#: Wrappers of one host that a task of the first round of merging gets come from one in so many partitions.
SALTS = 64
#: A text is a host's own, not an article's, if it stands at the same path on more than half of its pages and on so many at least.
FIXED_PAGES = 3
#: Bytes of all hosts' decisions up to which they are broadcast; beyond, they are joined by host.
BROADCAST_BYTES = 8_000_000
#: Elements of HTML by kind.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template", "xmp"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption",
}
#: Elements that an open one of the kind is closed by, up to the element that bounds it.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Elements, and words in class, id or role, that are never part of an article.
ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "svg", "head", "object", "canvas", "audio", "video"} | RAW
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|newsletter|subscribe|share|sharing|social|sidebar|related|recommend\w*|"
    r"comments?|disqus|respond|breadcrumbs?|menu|nav|navbar|navigation|footer|masthead|toolbar|pagination|pager|login|signup|search|skip-link)(?:$|[\s_-])",
    re.I,
)
#: A tag's quoted values end before a blank, a slash or its end; where a quote stays open, the tag goes up to the next ``>``.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"(?=[\s/>])|'[^']*+'(?=[\s/>]))*+(?=>)|[^>]*+)(?:>|\Z)|</?\Z", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


#: Numbers in class, id or role that may be a page's, as in post-17: they count as 0, so that pages have the same labels.
PAGE_NUMBER = re.compile(r"[0-9]{2,}|(?<=[-_])[0-9]+")
#: Elements inside so many others lie, for alignment, side by side in the last of these; no text is lost.
DEPTH = 100


class Node:
    __slots__ = ("beside", "id", "kids", "label", "plain", "tag")

    def __init__(self, tag: str, mark: str = "", name: str = "", ids: frozenset | None = None):
        self.tag, self.id, self.kids = tag, name, []
        #: Without the id, and with it where it is one of the host's, not a page's own.
        self.plain = f"{tag}.{mark}" if mark else tag
        self.label = f"{self.plain}#{name}" if name and (ids is None or text_key("#", name) in ids) else self.plain
        self.beside = tag in ASIDE or bool((mark or name) and MARKED.search(f"{mark} {name}"))


def _attributes(raw: str) -> tuple[str, str]:
    """Class and role, and id, page numbers as 0."""
    if "=" not in raw:
        return "", ""
    found = [(k.lower(), PAGE_NUMBER.sub("0", a or b or c)) for k, a, b, c in ATTRIBUTE.findall(raw)]
    return " ".join(v for k, v in found if k != "id"), " ".join(v for k, v in found if k == "id")


def parse(page: str, ids: frozenset | None = None) -> Node:
    """The tree of a page; children are nodes and texts (not decoded). Unclosed and stray tags are borne.

    ids: the keys of the ids that a host's pages share; others are no part of a label. Null: all are.
    """
    root = Node("#root")
    stack: list[tuple[str, Node]] = [("#root", root)]
    at, low = 0, None

    def close(k: int) -> None:
        for tag, node in stack[k:]:
            if len(stack) > DEPTH and tag in BLOCK and node.tag != tag:
                node.kids.append(Node(tag))  # the end of a block that lies deeper
        del stack[k:]

    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            stack[-1][1].kids.append(page[at:])
            break
        if m.start() > at:
            stack[-1][1].kids.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or not page[m.end() - 1] == ">":
            continue
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        closes, bounds = ({"p"}, BLOCK - {"p"}) if tag in BLOCK else (set(), set())
        if tag in CLOSES:
            closes, bounds = CLOSES[tag]
        if closes:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in closes:
                    close(k)
                    break
                if stack[k][0] in bounds:
                    break
        node = Node(tag, *_attributes(m[3]), ids)
        stack[-1][1].kids.append(node)
        if tag in RAW:
            low = low or page.lower()
            if len(low) != len(page):
                low = re.sub("[A-Z]", lambda x: x[0].lower(), page)
            end = low.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
            if tag == "title":
                node.kids.append(page[m.end() : at])
            if end >= 0:
                shut = page.find(">", at)
                at = len(page) if shut < 0 else shut + 1
        elif tag not in VOID and not m[3].endswith("/"):
            inside = stack[-1][1]
            stack.append((tag, node if len(stack) < DEPTH or node.beside and not inside.beside else inside))
    return root


# A wrapper is a nested list [label, flags, kids]; flags: 1 optional, 2 repeated, 4 a text slot, 8 never part of an article. A text is
# ["#text", flags, value, chars, times]: the hash of a fixed value, or null for a slot.


def _fold(items: list) -> list:
    """Tandem repeats of one to three items become one repeated item or group."""
    out: list = []
    for item in items:
        out.append(item)
        if out[-1][0] != "#text" and len(out) > 1 and out[-2][0] == out[-1][0]:
            last = out.pop()
            out[-1] = merge(out[-1], last)
            out[-1][1] |= 2
            continue
        for size in (2, 3):
            tail = [x[0] for x in out[-size:]]
            if len(out) > size and out[-size - 1][0] == "()" and [x[0] for x in out[-size - 1][2]] == tail:
                unit = out[-size:]
                del out[-size:]
                out[-1][2] = [merge(a, b) for a, b in zip(out[-1][2], unit)]
                break
            if len(out) >= 2 * size and [x[0] for x in out[-2 * size : -size]] == tail and "#text" not in tail:
                unit = [merge(a, b) for a, b in zip(out[-2 * size : -size], out[-size:])]
                del out[-2 * size :]
                out.append(["()", 2, unit])
                break
    return out


def text_key(path: str, text: str) -> int:
    """A hash of a text and the labels above it, zero excepted."""
    return xxhash.xxh64_intdigest(f"{path}\0{text.strip()}") >> 1 or 1


def text_keys(node: Node, path: str = "") -> dict[int, int]:
    """The keys of a page's texts with their lengths, without what is never part of an article, and of its ids."""
    out: dict[int, int] = {}
    for k in node.kids:
        if isinstance(k, Node):
            if k.id:
                out.setdefault(text_key("#", k.id), 0)
            if not k.beside:
                out |= text_keys(k, f"{path}/{k.plain}")
        elif k.strip():
            out[text_key(path, k)] = len(k)
    return out


def generalise(node: Node, fixed: frozenset = frozenset(), path: str = "", linked: bool = False) -> list:
    """A page's tree as a wrapper of this page; links, and texts whose keys are in fixed, have no weight."""
    kids = []
    for k in node.kids:
        if isinstance(k, Node):
            kids.append(generalise(k, fixed, f"{path}/{k.plain}", linked or k.tag == "a"))
        elif k.strip():
            kids.append(["#text", 0, xxhash.xxh64_intdigest(k.strip()), 0 if linked or fixed and text_key(path, k) in fixed else len(k), 1])
    return [node.label, 8 if node.beside else 0, _fold(kids)]


def merge(a: list, b: list) -> list:
    """The least wrapper that this procedure finds for the pages of both: both have the same label.

    Children are aligned by their labels; those without a partner become optional, differing texts a slot, and what
    repeats in either repeats.
    """
    if a[0] == "#text":
        same = a[2] is not None and a[2] == b[2]
        return ["#text", (a[1] | b[1]) | (0 if same else 4), a[2] if same else None, a[3] + b[3], a[4] + b[4]]
    x, y = a[2], b[2]
    if [k[0] for k in x] == [k[0] for k in y]:
        return [a[0], a[1] | b[1], [merge(p, q) for p, q in zip(x, y)]]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i][0] == y[j][0] else max(best[i + 1][j], best[i][j + 1])
    kids: list = []
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i][0] == y[j][0]:
            kids.append(merge(x[i], y[j]))
            i, j = i + 1, j + 1
        elif j == len(y) or i < len(x) and best[i + 1][j] >= best[i][j + 1]:
            kids.append([x[i][0], x[i][1] | 1, *x[i][2:]])
            i += 1
        else:
            kids.append([y[j][0], y[j][1] | 1, *y[j][2:]])
            j += 1
    return [a[0], a[1] | b[1], _fold(kids)]


def _weight(w: list) -> int:
    """Characters of the slots below, without links, what a host's pages share and what is never part of an article.

    A text that all pages aligned here have in common is none; one of a single page may be a slot.
    """
    if w[0] == "#text":
        return w[3] if w[1] & 4 or w[4] == 1 else 0
    return 0 if w[1] & 8 else sum(_weight(k) for k in w[2])


def main_path(wrapper: list) -> list[str]:
    """Labels from the root to the article in a wrapper.

    The heaviest article or main element, if there is one; else the deepest element that holds most of the weight.
    """
    named: list[tuple[int, int, list[str]]] = []

    def look(w: list, path: list[str]) -> None:
        for k in w[2]:
            if k[0] == "#text" or k[1] & 8:
                continue
            here = path if k[0] == "()" else [*path, k[0]]
            tag = re.split("[.#]", k[0])[0]
            if tag in ("article", "main"):
                named.append((tag == "article", _weight(k), here))
            look(k, here)

    look(wrapper, [])
    if any(weight for _, weight, _ in named):
        most = max(weight for _, weight, _ in named)
        return max((x for x in named if x[1] * 2 >= most), key=lambda x: (x[0], x[1]))[2]
    path: list[str] = []
    here, total = wrapper, _weight(wrapper)
    while total:
        inner = [k for k in here[2] if k[0] != "#text" and not k[1] & 2 and 2 * _weight(k) > total]
        if not inner:
            break
        here = inner[0]
        if here[0] != "()":
            path.append(here[0])
    return path


def blocks(node: Node, fixed: frozenset = frozenset(), path: str = "") -> list[str]:
    """The texts of the blocks below a node at a path, in order, without fixed ones and what is never part of an article."""
    out: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(text)
        parts.clear()

    def walk(n: Node, path: str) -> None:
        for k in n.kids:
            if isinstance(k, str):
                parts.append(" " if fixed and text_key(path, k) in fixed else k)
            elif k.tag in ("br", "wbr", "img"):
                parts.append(" " if k.tag == "br" else "")
            elif k.beside:
                flush() if k.tag in BLOCK else None
            elif k.tag == "header" and not any(isinstance(x, Node) and x.tag[:1] == "h" and x.tag[1:].isdigit() for x in k.kids):
                flush()
            elif k.tag in BLOCK:
                flush()
                walk(k, f"{path}/{k.plain}")
                flush()
            else:
                walk(k, f"{path}/{k.plain}")

    walk(node, path)
    flush()
    return out


def main_text(page: str | None, path: list[str] | None, fixed: frozenset | None = None) -> str:
    """The text of the elements at a path; without a path, or where a page lacks it, by the page's own wrapper.

    A page of nothing but fixed texts keeps them.
    """
    if not page:
        return ""
    root = parse(page, fixed)
    keys = fixed or frozenset()

    def at(labels: list[str]) -> list[tuple[Node, str]]:
        found = [(root, "")]
        for label in labels:
            found = [(k, f"{above}/{k.plain}") for n, above in found for k in n.kids if isinstance(k, Node) and k.label == label]
        return found

    found = at(path) if path else []
    if not found:
        found = at(main_path(generalise(root, keys)))
    text = "\n".join(b for n, above in found for b in blocks(n, keys, above))
    if text or not keys:
        return text
    return (path and "\n".join(b for n, above in found for b in blocks(n, frozenset(), above))) or main_text(page, None)


def host_of(url: str):
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://([^/?#:]*)", 1), F.lit(""))


def fixed_texts(df: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """Rows (host, fixed): the keys of the texts on most pages of a host, no more than two pages' worth.

    Pages with the same longest text are copies of one article, exact or near, and count once: what only they share is the article's.
    """

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [text_keys(parse(t)) for t in pdf["html"]]
            longest = [max(f, key=lambda k: (f[k], k), default=0) for f in found]  # noqa: B023
            yield pd.DataFrame({"host": pdf["host"], "longest": longest, "keys": [sorted({0, *f}) for f in found]})

    pages = df.where(F.col(page).isNotNull()).select(host_of(url).alias("host"), F.col(page).alias("html"))
    each = batched(pages).mapInPandas(keys, "host string, longest long, keys array<long>").groupBy("host", "longest").agg(F.min("keys").alias("keys"))
    # Key 0 has the number of pages. A row that can't be most of the pages of a host needs no join.
    often = each.select("host", F.explode("keys").alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= FIXED_PAGES)
    keyed = often.groupBy("host").agg(F.max(F.when(F.col("key") == 0, F.col("n"))).alias("pages")).where("pages is not null")
    most = often.where("key <> 0").join(keyed, "host").where(2 * F.col("n") > F.col("pages"))
    return most.groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("fixed"))


def infer(df: DataFrame, url: str = "url", page: str = "html", fixed: DataFrame | None = None) -> DataFrame:
    """Rows (host, wrapper): the wrapper of each host's pages as JSON; fixed has the texts without weight (see ``fixed_texts``).

    Each partition aligns its pages of a host one after the other; what it sends is one wrapper for each of its hosts,
    whatever their number of pages. These are merged in two rounds, so a host of very many pages isn't one task's work.
    """

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        found: dict[str, list] = {}
        for pdf in batches:
            for host, text, keys in zip(pdf["host"], pdf["html"], pdf["fixed"]):
                keys = None if keys is None else frozenset(keys)
                w = generalise(parse(text, keys), keys or frozenset())
                found[host] = merge(found[host], w) if host in found else w
        rows = [(h, TaskContext.get().partitionId() % SALTS, json.dumps(w)) for h, w in found.items()]
        yield pd.DataFrame(rows, columns=["host", "salt", "wrapper"])

    def again(pdf: pd.DataFrame) -> pd.DataFrame:
        total = None
        for w in sorted(pdf["wrapper"]):
            total = merge(total, json.loads(w)) if total else json.loads(w)
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "wrapper": [json.dumps(total)]})

    pages = df.where(F.col(page).isNotNull()).select(host_of(url).alias("host"), F.col(page).alias("html"))
    pages = pages.withColumn("fixed", F.lit(None).cast("array<long>")) if fixed is None else pages.join(fixed, "host", "left")
    parts = pages.select("host", "html", "fixed").mapInPandas(first, "host string, salt int, wrapper string")
    half = parts.groupBy("host", "salt").applyInPandas(again, "host string, wrapper string")
    return half.groupBy("host").applyInPandas(again, "host string, wrapper string")


def extract(df: DataFrame, url: str = "url", page: str = "html", out: str = "text") -> DataFrame:
    """Append the main text of each page; a null or empty page has the empty text.

    Pages without a host (a null or odd url) form one group. An input column of that name is replaced, all others pass through, whatever their names.
    """
    from chronolex.llm.common import checkpoint

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"host": pdf["host"], "path": [main_path(json.loads(w)) for w in pdf["wrapper"]]})

    df = df.drop(out)
    names = df.columns
    rows = df.select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)])
    url, html_page = f"c{names.index(url)}", f"c{names.index(page)}"
    fixed = checkpoint(fixed_texts(rows, url, html_page))
    size = fixed.agg(F.sum(F.length("host") + 8 * F.size("fixed") + 64)).first()[0] or 0
    fixed = F.broadcast(fixed) if size <= BROADCAST_BYTES else fixed
    paths = infer(rows, url, html_page, fixed).mapInPandas(decide, "host string, path array<string>")
    paths = checkpoint(paths.join(fixed, "host", "left"))
    size += paths.agg(F.sum(F.length("host") + F.length(F.concat_ws("", "path")) + 64)).first()[0] or 0
    keyed = rows.withColumn("host", host_of(url)).join(F.broadcast(paths) if size <= BROADCAST_BYTES else paths, "host", "left").select(*rows.columns, "path", "fixed")
    at = names.index(page)

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in slices(whole, at, CHUNK):
                pages, paths, fixed = (batch.column(c).to_pylist() for c in (at, batch.num_columns - 2, batch.num_columns - 1))
                texts = [main_text(p, w, None if x is None else frozenset(x)) for p, w, x in zip(pages, paths, fixed)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(texts, pa.string())], [*names, out])

    return batched(keyed).mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.StringType())]))
