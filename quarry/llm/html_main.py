"""Main text of web pages by consensus paths of each host.

Three steps: score every container of every page, vote in Spark for the generalised tag-class path
(digits folded, ids ignored) that most pages of a host found best, and extract each page again from the
containers on its host's winning path. A page without that path, or with no text on it, falls back to
its own best container. The votes are pre-aggregated per host and path; winners are joined under a salt, so
a host with a third of all pages is dealt over many tasks.

The best container is the smallest one that holds nearly all text of the page that is not links (where an article
or main element holds half of it, of the text in those). Kept, in page order: the blocks inside the chosen containers;
beside them, unless they are mostly links, those under the outermost article, main or content element around the
chosen ones, and those directly in any container around them. Left out: menus, page headers, footers,
sidebars, notices, adverts, forms, scripts, styles, comments of readers and markup. Character references
are decoded. Words of class and id names count only where they make up a whole name; what they mark is kept where
it holds the page itself (see shown()). Open p, li, dd, dt, tr, td and head end where HTML ends them. White space inside a block becomes one space. Null or empty html gives an empty text;
a null url counts as host "". Rows are kept one for one.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches
from .url_filter import with_parts

#: A comment, a declaration, a tag, a run of text. A quote opens a value only after "=", and a tag without its end stops before the
#: next "<": nothing is scanned twice, so a page takes time in proportion to its length.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/><]*+)((?:[^><=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>?|[^<]++|<", re.S
)
CLASS = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "canvas"}
#: The end tag of each, found by a plain search: what stands before it is no markup.
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in RAW}
#: Those that go on to the end of the page where the end tag is missing.
TO_THE_END = {"script", "style", "textarea", "title", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SKIP = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "option"}
CONTAINER = {"body", "main", "article", "section", "div", "td", "center"}
BLOCK = CONTAINER | SKIP | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "pre", "blockquote", "table", "tr", "th", "header", "figure", "figcaption", "address", "hr", "br", "details", "summary", "html", "hgroup", "tbody", "thead", "tfoot", "caption", "fieldset"}
#: Words of class and id names that mark text beside the article, and those that may stand with them in one name.
BESIDE = r"(?:ads?|advert\w*|adsense|banners?|sponsor\w*|promos?|promotion\w*|cookies?|consent|notices?|alerts?|popup|modal|overlay|nav|navbar|navigation|menus?|breadcrumbs?|sidebars?|side|aside|footer|masthead|topbar|comments?|commentlist|disqus|replies|respond|share|sharing|social|related|recommended|newsletter|subscribe|signup|login|search|widgets?|toolbar|pagination|pager|copyright|legal|skip)"
BETWEEN = r"(?:site|page|main|global|top|bottom|left|right|primary|secondary|area|list|box|bar|block|section|container|wrapper|wrap|inner|outer|col|column|links?|buttons?|btn|icons?|items?|unit|slot|form|posts?|entry|articles?|policy|media|google|\d+)"
NAME = re.compile(rf"(?:{BETWEEN}[-_])*{BESIDE}\d*(?:[-_](?:{BESIDE}|{BETWEEN})\d*)*|(?:site|main|global)[-_]header|header", re.I)
#: Words that mark a note of the article itself when it is inside one.
NOTE = re.compile(r"notices?|alerts?|legal|side|aside|skip|search|promos?|overlay|header", re.I)
READERS = re.compile(r"(?:^|[-_\s])(?:comments?|commentlist|disqus|replies|respond)(?:$|[-_\s\d])", re.I)
ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "alert", "dialog"}
#: Elements that are text themselves: no name puts them beside the article.
TEXTUAL = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "dt", "dd", "pre", "blockquote", "figure", "figcaption", "caption", "html", "body", "article", "main"}
#: Start tags that end an open p, and what each other element with an optional end tag is ended by, up to which element.
ENDS_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "button", "select", "option", "head"}
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Parts of class and id names of the elements that hold an article with its title and lead.
CONTENT = re.compile(r"(?:^|[-_\s])(?:article|post|hentry|entry|story|content|main)(?:$|[-_\s\d])", re.I)
NEARLY = 0.9
SALTS = 32


def beside(names: dict[str, str], tag: str, inside: bool) -> bool:
    """Whether class, id or role mark the element as beside the article; inside: it is in an article or main element."""
    words = names.get("class", "").split()
    if not (inside and tag == "section") or READERS.search(names.get("id", "")):
        words += names.get("id", "").split()
    return names.get("role") in ROLES or any(NAME.fullmatch(w) and not ((inside or tag == "p") and NOTE.fullmatch(w)) for w in words)


class Tree:
    """Nodes that know their parent, made after it; -1 is above all of them."""

    def __init__(self):
        self.parent: list[int] = []

    def add(self, parent: int) -> int:
        self.parent.append(parent)
        return len(self.parent) - 1

    def summed(self, at: dict[int, float]) -> list[float]:
        """Of each node the sum of at over it and all nodes below."""
        total = [at.get(i, 0.0) for i in range(len(self.parent))]
        for i in range(len(total) - 1, -1, -1):
            if self.parent[i] >= 0:
                total[self.parent[i]] += total[i]
        return total

    def below(self, tops: set[int]) -> list[bool]:
        """Whether each node is one of tops or under one. The last entry stands for -1."""
        out = [False] * (len(self.parent) + 1)
        for i, up in enumerate(self.parent):
            out[i] = i in tops or out[up]
        return out


class Page:
    """Blocks of one page: (text, innermost container, link share), and the path of its best container.

    Containers are nodes of a tree in which those with one path are one; elements that leave text out are nodes of another."""

    def __init__(self, source: str):
        self.tree = Tree()
        self.names: dict[tuple[int, str], int] = {}  # container by parent and name
        self.label: list[str] = []
        self.depth: list[int] = []
        self.holders: set[int] = set()  # article, main and content elements
        self.declared: set[int] = set()  # article and main elements
        every: list[tuple[str, int, float, int]] = []  # blocks, and the innermost element that leaves them out
        out_tree = Tree()
        heads: dict[int, float] = {}  # elements that leave text out with a heading, article or main element directly in them
        readers: set[int] = set()  # those named after comments
        always: set[int] = set()  # those that are left out by their tag alone
        stack: list[tuple[str, bool]] = []  # tag, whether it is left out
        where: dict[str, list[int]] = defaultdict(list)  # places on the stack of each tag
        hiders: list[int] = [-1]
        missing: set[str] = set()  # raw elements whose end tag does not follow
        paths: list[int] = [-1]  # open containers
        links = 0
        parts: list[str] = []
        linked = 0

        def flush() -> None:
            nonlocal linked
            if parts:
                text = " ".join(entities.unescape("".join(parts)).split())
                if text:
                    every.append((text, paths[-1], min(1.0, linked / len(text)), hiders[-1]))
                parts.clear()
            linked = 0

        def close(depth: int) -> None:
            nonlocal links
            if any(out for _, out in stack[depth:]):
                flush()
            while len(stack) > depth:
                tag, out = stack.pop()
                where[tag].pop()
                if out:
                    hiders.pop()
                links -= tag == "a"
                if tag in CONTAINER:
                    paths.pop()

        def end_open(tags: set[str], limits: set[str]) -> None:
            """Ends the innermost open element of these tags, unless one of the limits is open inside it."""
            last = max((where[t][-1] for t in tags if where[t]), default=-1)
            if last >= 0 and last >= max((where[t][-1] for t in limits if where[t]), default=-1):
                close(last)

        token, at, end = TOKEN.match, 0, len(source)
        while at < end:
            m = token(source, at)
            at, tag = m.end(), m[2]
            if tag is None:
                s = m[0]
                if not s.startswith(("<!", "<?")):
                    parts.append(s)
                    if links:
                        linked += len(s)
                continue
            tag = tag.lower()
            if tag in BLOCK:
                flush()
            if m[1]:
                if where[tag]:
                    close(where[tag][-1])
                continue
            if tag in BLOCK and stack and stack[-1][0] == "head":
                close(len(stack) - 1)
            if tag in ENDS_P and where["p"]:
                end_open({"p"}, {"table", "button", "object"})
            if tag in ENDS:
                end_open(*ENDS[tag])
            if tag in VOID:
                continue
            if tag in RAW:
                if not m[3].endswith("/"):
                    if tag not in missing and (over := RAW_END[tag].search(source, at)):
                        at = over.end()
                    elif tag in TO_THE_END:
                        break
                    else:
                        missing.add(tag)
                continue
            names = dict((k.lower(), v.strip("\"'")) for k, v in CLASS.findall(m[3])) if m[3] else {}
            inside = bool(where["article"] or where["main"])
            out = sure = tag in SKIP or (tag == "header" and not inside) or (tag == "label" and not inside and not where["p"])
            if names and not out and tag not in TEXTUAL:
                out = beside(names, tag, inside)
            if out:
                flush()
                hiders.append(out_tree.add(hiders[-1]))
                if sure and tag != "form":
                    always.add(hiders[-1])
                elif READERS.search(f"{names.get('class', '')} {names.get('id', '')}"):
                    readers.add(hiders[-1])
            elif tag in ("article", "main", "h1"):
                heads[hiders[-1]] = 1.0
            where[tag].append(len(stack))
            stack.append((tag, out))
            links += tag == "a"
            if tag in CONTAINER:
                kind = re.sub(r"\d+", "#", ".".join(sorted(names.get("class", "").lower().replace("/", "_").split())))
                here = self.container(paths[-1], f"{tag}{'.' + kind if kind else ''}")
                paths.append(here)
                if tag in ("article", "main") or names.get("role") in ("main", "article"):
                    self.declared.add(here)
                elif tag != "body" and (CONTENT.search(names.get("class", "")) or CONTENT.search(names.get("id", ""))):
                    self.holders.add(here)
        flush()
        self.blocks = self.shown(every, out_tree, always, readers, heads)

    def container(self, parent: int, name: str) -> int:
        found = self.names.get((parent, name))
        if found is None:
            found = self.names[parent, name] = self.tree.add(parent)
            self.label.append(name)
            self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        return found

    @staticmethod
    def shown(every: list, tree: Tree, always: set[int], readers: set[int], heads: dict[int, float]) -> list[tuple[str, int, float]]:
        """The blocks that no element leaves out. An element marked by its name (or a form) counts as the page itself where it
        holds most of the text and a heading or article, or, unless it holds comments, nearly all text. With nothing left,
        the blocks in any such element are shown, at last those of menus, footers and the like that have a heading or article."""
        if all(by < 0 for *_, by in every):
            return [b[:3] for b in every]
        sure = tree.below(always)
        worth: dict[int, float] = defaultdict(float)
        for text, _, linked, by in every:
            worth[by] += 0.0 if sure[by] else len(text) * (1 - linked) ** 2
        total, held, headed = sum(worth.values()), tree.summed(worth), tree.summed(heads)
        marked = set(range(len(held))) - always
        open_ = {x for x in marked if held[x] > total / 2 and (headed[x] or (x not in readers and held[x] >= NEARLY * total))}
        for free in (open_, marked, marked | {x for x in always if headed[x]}):
            shut = tree.below(set(range(len(held))) - free)
            if blocks := [b[:3] for b in every if not shut[b[3]]]:
                return blocks
        return []

    def best(self) -> str:
        """The path of the smallest containers that hold nearly all of the text; "" where only the whole page does."""
        worth = [len(text) * (1 - linked) ** 2 for text, _, linked in self.blocks]
        if not any(worth):
            worth = [float(len(text)) for text, _, _ in self.blocks]
        article = self.tree.below(self.declared)
        inside = [w if article[at] else 0.0 for w, (_, at, _) in zip(worth, self.blocks, strict=True)]
        if 2 * sum(inside) >= sum(worth):
            worth = inside
        direct: dict[int, float] = defaultdict(float)
        for w, (_, at, _) in zip(worth, self.blocks, strict=True):
            direct[at] += w
        score, least = self.tree.summed(direct), NEARLY * sum(worth)
        reached = {at for _, at, _ in self.blocks}
        held = [i for i in range(len(score)) if score[i] >= least and (score[i] or i in reached)]
        return self.path(max(held, key=lambda i: (self.depth[i], self.label[i]))) if held else ""

    def path(self, node: int) -> str:
        names: list[str] = []
        while node >= 0:
            names.append(self.label[node])
            node = self.tree.parent[node]
        return "".join(f"/{n}" for n in reversed(names))

    def find(self, path: str) -> int | None:
        node = -1
        for name in path.split("/")[1:]:
            node = self.names.get((node, name))
            if node is None:
                return None
        return node

    def text(self, path: str) -> str:
        if not path:
            return " ".join([b[0] for b in self.blocks])
        node = self.find(path)
        if node is None:
            return ""
        around: set[int] = set()
        up = self.tree.parent[node]
        while up >= 0:
            around.add(up)
            up = self.tree.parent[up]
        chosen = self.tree.below({node})
        if not any(chosen[at] for _, at, _ in self.blocks):
            return ""
        holder = min((x for x in around if x in self.declared or x in self.holders), default=node)
        held, beside_it = self.tree.below({holder}), {-1, *around}
        return " ".join([text for text, at, linked in self.blocks if chosen[at] or (linked < 0.5 and (held[at] or at in beside_it))])


def extract(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """df without html, with text, n_chars (code points) and path (the one used); clashing columns are replaced."""

    @F.pandas_udf("string")
    def best(pages: pd.Series) -> pd.Series:
        return pd.Series([Page(p).best() if p else "" for p in pages], dtype=object)

    @F.pandas_udf("text string, path string")
    def again(pages: pd.Series, winners: pd.Series) -> pd.DataFrame:
        rows = []
        for source, winner in zip(pages, winners, strict=True):
            page = Page(source or "")
            path = winner or ""
            text = page.text(path) if path else ""
            if not text:
                path = page.best()
                text = page.text(path)
            rows.append((text, path))
        return pd.DataFrame(rows, columns=["text", "path"])

    df = in_small_batches(df)
    hosts = with_parts(df.select(F.col(url).alias("url"), F.col(html).alias("html"))).select("host", best("html").alias("path"))
    votes = hosts.groupBy("host", "path").agg(F.count("*").alias("n"))
    winners = (
        votes.where("path <> ''")
        .groupBy("host")
        .agg(F.max(F.struct("n", "path"))["path"].alias("_winner"))
        .select(F.col("host").alias("_host"), "_winner", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    )
    keep = [c for c in df.columns if c not in ("text", "n_chars", "path", "host", html)]
    pages = with_parts(df.select(*keep, F.col(html).alias("_html")), url).drop("path")
    pages = pages.withColumn("_salt", F.pmod(F.xxhash64("_html", url), F.lit(SALTS)).cast("int"))
    joined = pages.join(winners, (pages.host == winners._host) & (pages._salt == winners._salt), "left")
    return joined.select(*keep, again("_html", "_winner").alias("_main")).select(*keep, "_main.text", F.length("_main.text").cast("long").alias("n_chars"), "_main.path")
