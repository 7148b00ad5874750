"""HTML to Markdown, one converter for all dialects.

A page becomes a small tree (void elements never nest, unclosed paragraphs, items and cells close by themselves), the
dialect picks the content roots and what counts as furniture, and the tree is rendered by recursion: blocks to lists of
blocks, inline content to one line.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript svg template iframe button form select head".split())
HEADINGS = {f"h{n}": n for n in range(1, 7)}
INLINE = frozenset("a abbr b bdi bdo cite code del dfn em font i img input ins kbd label mark q s samp small span strong sub sup time tt u var br wbr".split())
#: Elements that an opening tag closes where they are still open, up to a limit element.
CLOSES = {
    "li": ({"li", "p"}, {"ul", "ol"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}), "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}), "thead": ({"tr", "td", "th"}, {"table"}), "tbody": ({"thead", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
BLOCKS = frozenset("address article aside blockquote details div dl fieldset figure footer h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)

    def classes(self) -> set[str]:
        return set(self.attrs.get("class", "").split())

    def walk(self):
        yield self
        for child in self.children:
            if isinstance(child, Node):
                yield from child.walk()

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else ("\n" if c.tag == "br" else "" if c.tag in SILENT else c.text()) for c in self.children)


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        closes, limits = CLOSES.get(tag, (set(), set()))
        if tag in BLOCKS and any(n.tag == "p" for n in self.open):
            closes, limits = closes | {"p"}, limits | {"td", "th", "li", "div", "blockquote"}
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in limits:
                break
            if self.open[at].tag in closes:
                del self.open[at:]
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


@dataclass(frozen=True)
class Dialect:
    """What one family of pages calls its parts. Selectors are `tag`, `tag.class`, `tag#id` or `.class`, `#id`."""

    roots: tuple[str, ...] = ("article", "main", "body", "#root")
    drop: tuple[str, ...] = ("nav", "footer")
    drop_class_parts: tuple[str, ...] = ()
    notes: tuple[tuple[str, str], ...] = ()
    note_label: bool = True
    all_roots: bool = False
    language_attrs: tuple[str, ...] = ("syntax", "data-lang", "data-language")
    outer_language: bool = False
    second_class_language: bool = False
    section_levels: bool = False
    column_names: bool = False
    required: bool = False


_KINDS = (("note", "Note"), ("tip", "Tip"), ("important", "Important"), ("warning", "Warning"), ("caution", "Caution"))
DIALECTS = {
    "plain": Dialect(),
    "devsite": Dialect(
        roots=("div.devsite-article-body",), drop=("nav", "footer", "ul.toc", "span.material-icons", "div.devsite-banner", "devsite-feedback", "devsite-actions", "devsite-toc", "devsite-bookmark"), drop_class_parts=("devsite-banner", "devsite-article-meta", "nocontent"),
        notes=(*_KINDS, ("key-point", "Key point"), ("key-term", "Key term"), ("success", "Success"), ("special", "Special"), ("beta", "Beta"), ("preview", "Preview"), ("deprecated", "Deprecated"), ("dogfood", "Dogfood"), ("objective", "Objective"), ("gotchas", "Gotchas")), note_label=False, required=True),
    "readme": Dialect(roots=("article", "main", "div.rm-Article", "div.content-body", "div.markdown-body"), drop=("nav",), required=True),
    "docusaurus": Dialect(roots=("article", "main"), drop=("nav", "footer", "div.theme-doc-toc-mobile", "div.theme-doc-toc-desktop", "a.hash-link"), drop_class_parts=("breadcrumbs", "pagination-nav", "theme-edit-this-page", "tableOfContents", "sidebar"), notes=tuple((f"alert--{k}", v) for k, v in (("info", "Info"), ("secondary", "Note"), ("success", "Tip"), ("warning", "Warning"), ("danger", "Danger"))), required=True),
    "asciidoc": Dialect(roots=("div#guide-body", "div#content"), drop=("nav", "footer", "div.sidebarblock", "div#toc", "div.toc", "div#footer", "a.anchor", "td.icon"), notes=tuple(_KINDS), required=True),
    "dita": Dialect(roots=("#mc-main-content", "div.mc-main-content", "div.body-container", "div.topic-body"), drop=("nav", "footer"), drop_class_parts=("coveo", "breadcrumb", "feedback", "related-topics", "mini-toc"), notes=tuple((k, "Note") for k, _ in _KINDS), required=True),
    "docbook": Dialect(roots=("div.book", "div.preface", "div.part", "div.chapter", "div.appendix", "div.section", "body", "#root"), drop=("div.toc", "div.navheader", "div.navfooter", "div.list-of-examples"), notes=tuple(_KINDS), second_class_language=True, section_levels=True, column_names=True),
    "wiki": Dialect(roots=("div.wiki-content",), drop=("footer",), required=True),
    "jekyll": Dialect(roots=("section.text-content",), drop=("nav",), outer_language=True, all_roots=True, required=True),
}


def _matches(node: Node, selector: str) -> bool:
    tag, mark, rest = re.fullmatch(r"([\w-]*|#root)([.#]?)(.*)", selector).groups() if selector != "#root" else ("#root", "", "")
    if tag and node.tag != tag:
        return False
    return not mark or (rest in node.classes() if mark == "." else node.attrs.get("id") == rest)


def roots(tree: Node, dialect: Dialect) -> list[Node]:
    """The content: nodes of the first selector that has any."""
    for selector in dialect.roots:
        found = [n for n in tree.walk() if _matches(n, selector)]
        if found:
            return found if dialect.all_roots else found[:1]
    return [] if dialect.required else [tree]


def squeeze(text: str) -> str:
    return re.sub(r"[ \t\r\n\f\v\xa0]+", " ", text.replace("\u200b", ""))


def code_span(text: str) -> str:
    if not text:
        return ""
    ticks = "`" * (max((len(r) for r in re.findall("`+", text)), default=0) + 1)
    pad = " " if text[0] == "`" or text[-1] == "`" else ""
    return f"{ticks}{pad}{text}{pad}{ticks}"


def fence(code: str, language: str = "") -> list[str]:
    mark = "`" * max(3, max((len(r) for r in re.findall("(?m)^ *(`{3,})", code)), default=2) + 1)
    return [f"{mark}{language}", *code.strip("\n").split("\n"), mark]


def cell(text: str) -> str:
    return re.sub(r"(?<!\\)\|", r"\\|", text).replace("\n", " ").strip()


def table(rows: list[list[str]]) -> list[str]:
    """A header, a rule, padded rows."""
    width = max((len(r) for r in rows), default=0)
    if not width:
        return []
    lines = ["| " + " | ".join([*r, *[""] * (width - len(r))]) + " |" for r in rows]
    return [lines[0], "| " + " | ".join(["---"] * width) + " |", *lines[1:]]


class Renderer:
    def __init__(self, dialect: Dialect, url: str = ""):
        self.dialect, self.url = dialect, url

    def link(self, href: str) -> str:
        href = href.strip()
        return href if not self.url or href.startswith("#") else urljoin(self.url, href)

    def dropped(self, node: Node) -> bool:
        if node.tag in SILENT or any(_matches(node, s) for s in self.dialect.drop):
            return True
        if "display:none" in node.attrs.get("style", "").replace(" ", ""):
            return True
        own = node.attrs.get("class", "")
        return any(part in own for part in self.dialect.drop_class_parts)

    def note(self, node: Node) -> str | None:
        if node.tag in ("div", "aside", "p", "section"):
            own = node.classes()
            for name, label in self.dialect.notes:
                if name in own:
                    return label
        return None

    # -- inline

    def inline(self, nodes: list, plain: bool = False) -> str:
        out = []
        for n in nodes:
            if isinstance(n, str):
                out.append(squeeze(n))
            elif not self.dropped(n):
                out.append(self.one(n))
        return re.sub(r" {2,}", " ", "".join(out))

    def one(self, n: Node) -> str:
        if n.tag == "br":
            return "\n"
        if n.tag == "img":
            src = n.attrs.get("src") or n.attrs.get("data-src", "")
            return f"![{squeeze(n.attrs.get('alt', '')).strip()}]({self.link(src)})" if src else ""
        if n.tag == "input":
            return ("[x] " if "checked" in n.attrs else "[ ] ") if n.attrs.get("type") == "checkbox" else ""
        if n.tag in ("code", "kbd", "samp", "tt"):
            return code_span(squeeze(n.text()).strip())
        body = self.inline(n.children)
        mark = {"strong": "**", "b": "**", "em": "*", "i": "*", "del": "~~", "s": "~~"}.get(n.tag)
        if mark and body.strip():
            lead, tail = body[: len(body) - len(body.lstrip())], body[len(body.rstrip()) :]
            return f"{lead}{mark}{body.strip()}{mark}{tail}"
        if n.tag == "a" and n.attrs.get("href") and body.strip():
            return f"[{body.strip()}]({self.link(n.attrs['href'])})"
        return body

    # -- blocks

    def blocks(self, nodes: list, level: int = 0) -> list[list[str]]:
        """Blocks of lines; runs of inline nodes make paragraphs."""
        out: list[list[str]] = []
        run: list = []

        def flush() -> None:
            text = "\n".join(re.sub(r" *\n *", "\n", self.inline(run)).strip().split("\n")) if run else ""
            run.clear()
            if text.strip():
                out.append([line.strip() for line in text.split("\n") if line.strip()])

        for n in nodes:
            if isinstance(n, str) or (n.tag in INLINE and not any(c.tag in BLOCKS for c in n.walk())):
                run.append(n)
                continue
            flush()
            if not self.dropped(n):
                out += self.block(n, level)
        flush()
        return out

    def block(self, n: Node, level: int) -> list[list[str]]:
        label = self.note(n)
        if label is not None:
            inner = [b for b in self.blocks(n.children, level) if b]
            inner = [b for k, b in enumerate(inner) if k or b != [label] and b != [f"{'#' * 3} {label}"]]
            lines = _lines(inner)
            if self.dialect.note_label and lines:
                lines[0] = re.sub(rf"^(?:\*\*)?{label}:?(?:\*\*)?:?\s*", "", lines[0], flags=re.I) or lines[0]
                lines[0] = f"**{label}:** {lines[0]}"
            return [[f"> {x}".rstrip() for x in lines]] if lines else []
        if n.tag in HEADINGS:
            text = squeeze(self.inline(n.children)).strip()
            depth = level if self.dialect.section_levels and level else HEADINGS[n.tag]
            return [["#" * min(6, max(1, depth)) + " " + text]] if text else []
        if n.tag == "pre":
            return self.code(n)
        if n.tag in ("ul", "ol"):
            lines = self.items(n, level)
            return [lines] if lines else []
        if n.tag == "dl":
            out = []
            for c in n.children:
                if isinstance(c, Node) and c.tag == "dt":
                    out.append([f"**{squeeze(self.inline(c.children)).strip()}**"])
                elif isinstance(c, Node) and c.tag == "dd":
                    out += self.blocks(c.children, level)
            return out
        if n.tag == "blockquote":
            lines = _lines(self.blocks(n.children, level))
            return [[f"> {x}".rstrip() for x in lines]] if lines else []
        if n.tag == "table":
            return self.tables(n, level)
        if n.tag == "hr":
            return [["---"]]
        if n.tag == "figcaption":
            return [[f"*{squeeze(self.inline(n.children)).strip()}*"]]
        if n.tag == "summary":
            return [[f"**{squeeze(self.inline(n.children)).strip()}**"]]
        deeper = level + 1 if self.dialect.section_levels and n.tag in ("div", "section") and n.classes() & {"section", "chapter", "preface", "appendix", "part", "book"} else level
        return self.blocks(n.children, deeper)

    def language(self, n: Node) -> str:
        for node in [n, *[c for c in n.walk() if c.tag == "code"]]:
            for name in self.dialect.language_attrs:
                if node.attrs.get(name):
                    return node.attrs[name].lower()
            for own in node.attrs.get("class", "").split():
                if found := re.fullmatch(r"(?:language|lang|highlight-source)-([\w+#.-]+)", own):
                    return found[1].lower()
        own = n.attrs.get("class", "").split()
        return own[1].lower() if self.dialect.second_class_language and len(own) > 1 and own[0] == "programlisting" else ""

    def code(self, n: Node, outer: str = "") -> list[list[str]]:
        text = n.text().replace("\xa0", " ").replace("\u200b", "")
        return [fence("\n".join(x.rstrip() for x in text.strip("\n").split("\n")), self.language(n) or outer)] if text.strip() else []

    def items(self, n: Node, level: int, depth: int = 0) -> list[str]:
        lines: list[str] = []
        number = int(n.attrs["start"]) if n.tag == "ol" and n.attrs.get("start", "").isdigit() else 1
        for item in (c for c in n.children if isinstance(c, Node) and not self.dropped(c)):
            if item.tag in ("ul", "ol"):
                lines += [f"  {x}" for x in self.items(item, level)]
                continue
            mark = f"{number}. " if n.tag == "ol" else "- "
            number += 1
            body: list[str] = []
            for k, b in enumerate(self.blocks(item.children, level)):
                nested = b[0].startswith(("- ", "1. "))
                body += b if not k or nested else ["", *b]
            if body:
                lines += [mark + body[0], *[f"  {x}" if x else "" for x in body[1:]]]
        return lines

    def rows(self, n: Node) -> list[Node]:
        """Rows of this table, not of tables inside it."""
        out = []
        for c in n.children:
            if isinstance(c, Node):
                out += [c] if c.tag == "tr" else self.rows(c) if c.tag in ("thead", "tbody", "tfoot") else []
        return out

    def tables(self, n: Node, level: int) -> list[list[str]]:
        rows = [[c for c in r.children if isinstance(c, Node) and c.tag in ("td", "th") and not self.dropped(c)] for r in self.rows(n)]
        rows = [r for r in rows if r]
        if not rows:
            return []
        blocky = any(any(x.tag in ("ul", "ol", "pre", "table") for x in c.walk()) for r in rows for c in r)
        header = all(c.tag == "th" for c in rows[0])
        blocky = blocky or max(map(len, rows)) == 1 and not header
        if blocky or (not header and any(int(c.attrs.get("colspan") or 1) > 1 for r in rows for c in r if (c.attrs.get("colspan") or "1").isdigit())):
            return self.listed(rows[1:] if header else rows, level)
        flat = [[cell(squeeze(self.inline_cell(c, level))) for c in r] for r in rows]
        if not header and self.dialect.column_names:
            flat.insert(0, [f"Col {k + 1}" for k in range(max(map(len, flat)))])
        return [table(flat)]

    def inline_cell(self, c: Node, level: int) -> str:
        return " ".join(x for b in self.blocks(c.children, level) for x in b)

    def listed(self, rows: list[list[Node]], level: int) -> list[list[str]]:
        """Tables with lists in cells, or with cells across: a divider line, or `- **first** rest`."""
        out: list[list[str]] = []
        run: list[str] = []
        for r in rows:
            if len(r) == 1:
                if run:
                    out.append(run)
                    run = []
                out += self.blocks(r[0].children, level)
                continue
            head = squeeze(self.inline_cell(r[0], level)).strip().strip("*")
            run.append(f"- **{head}**")
            for c in r[1:]:
                run += [f"  {x}" if x else "" for x in _lines(self.blocks(c.children, level), gap=False)]
        return [*out, run] if run else out


def _lines(blocks: list[list[str]], gap: bool = True) -> list[str]:
    out: list[str] = []
    for b in blocks:
        out += ["", *b] if out and gap else b
    return out


def collapse(lines: list[str]) -> str:
    """Runs of blank lines outside of fences as one; one line break at the end."""
    out: list[str] = []
    open_mark = ""
    for line in lines:
        found = re.match(r"(?:> |\s)*(`{3,})", line)
        if found:
            open_mark = "" if open_mark and found[1].startswith(open_mark) else open_mark or found[1]
        if open_mark or line.strip() or (out and out[-1].strip()):
            out.append(line.rstrip() if not open_mark else line)
    return "\n".join(out).strip("\n") + "\n" if any(x.strip() for x in out) else ""


def html_to_markdown(html: str | None, dialect: str = "plain", url: str = "", title: str = "") -> str | None:
    """Markdown of the content; None where the dialect's content is missing; a heading that repeats title comes once."""
    if html is None:
        return None
    own = DIALECTS[dialect]
    found = roots(parse(html), own)
    if not found:
        return None
    draw = Renderer(own, url)
    blocks: list[list[str]] = []
    for root in found:
        blocks += draw.blocks(root.children)
    if own.outer_language:
        blocks = _outer_languages(found, draw) or blocks
    if title:
        blocks = [b for b in blocks if b != [f"# {title}"]]
        blocks.insert(0, [f"# {title}"])
    return collapse(_lines(blocks))


def _outer_languages(found: list[Node], draw: Renderer) -> list[list[str]]:
    """Code whose language stands on a div around it: moved to the pre before rendering."""
    for root in found:
        for div in root.walk():
            if div.tag == "div":
                language = next((x.removeprefix("language-") for x in div.classes() if x.startswith("language-")), "")
                for pre in (n for n in div.walk() if language and n.tag == "pre"):
                    pre.attrs.setdefault("data-lang", language)
    return [b for root in found for b in draw.blocks(root.children)]


def page_title(html: str) -> str:
    """JSON-LD headline, else <title> before a spaced pipe, else nothing."""
    if found := re.search(r'"headline"\s*:\s*"((?:[^"\\]|\\.)*)"', html):
        return found[1].replace('\\"', '"')
    tree = parse(html)
    for n in tree.walk():
        if n.tag == "title":
            return squeeze(n.text()).strip().split(" | ")[0].strip()
    return ""


def sections(html: str, starts: str = "h1,h2", within: str = "") -> list[dict]:
    """One page as many: {ord, id, level, title, markdown} from each heading in starts to the next of its level or above."""
    tree = parse(html)
    if within:
        picked = [n for n in tree.walk() if _matches(n, within)]
        tree = Node("#root", {}, [c for n in picked for c in n.children])
    draw, names = Renderer(DIALECTS["plain"]), set(starts.split(","))
    out: list[dict] = []

    def visit(n: Node) -> None:
        for c in n.children:
            if isinstance(c, Node) and c.tag in names:
                anchor = c.attrs.get("id") or next((x.attrs.get("id") or x.attrs.get("name") for x in c.walk() if x.attrs.get("id") or x.attrs.get("name")), "") or (n.attrs.get("id", "") if n.tag in ("section", "div") else "")
                out.append({"ord": len(out), "id": anchor or "", "level": HEADINGS.get(c.tag, 0), "title": squeeze(c.text()).strip(), "parts": []})
            elif isinstance(c, Node) and any(x.tag in names for x in c.walk()):
                visit(c)
            elif out:
                out[-1]["parts"].append(c)

    visit(tree)
    for s in out:
        s["markdown"] = collapse(_lines(draw.blocks(s.pop("parts"))))
    return out


def definitions(html: str) -> list[dict]:
    """dt/dd pairs: {name, markdown} in order; a dt without dd has an empty text."""
    draw, out = Renderer(DIALECTS["docbook"]), []
    for dl in (n for n in parse(html).walk() if n.tag == "dl"):
        for c in dl.children:
            if isinstance(c, Node) and c.tag == "dt":
                out.append({"name": squeeze(c.text()).strip(), "markdown": ""})
            elif isinstance(c, Node) and c.tag == "dd" and out:
                out[-1]["markdown"] = collapse(_lines(draw.blocks(c.children)))
    return out


def slices(html: str, kinds: list[list[str]], dialect: str = "docbook", url: str = "") -> list[dict]:
    """One page as a tree of documents: {ord, parent, trail, kind, anchor, title, anchors, markdown} in the page's order.

    kinds has classes of elements by rank, outermost first. An element of one of them is a document, unless it stands inside one
    of its own rank or a later one (sections of a section are part of it); it belongs to the one around it, or else to the last one before it with a lower rank and a higher heading (chapters that follow their part). Its
    text is what it holds beside the documents inside it, its anchors the ids and names in that, trail its ancestors' and its
    own names. What stands outside all documents is left out.
    """
    rank = {c: k for k, classes in enumerate(kinds) for c in classes}
    own = DIALECTS[dialect]
    out: list[dict] = []

    def heading(n: Node) -> Node | None:
        return next((h for h in n.walk() if h.tag in HEADINGS), None)

    def visit(n: Node, inside: dict | None) -> None:
        for c in list(n.children):
            if not isinstance(c, Node):
                continue
            kind = min((x for x in c.classes() if x in rank), key=lambda x: (rank[x], x), default=None)
            if kind is None or inside and rank[kind] <= rank[inside["kind"]]:
                visit(c, inside)
                continue
            head = heading(c)
            anchor = c.attrs.get("id") or next((x.attrs[a] for x in c.walk() for a in ("id", "name") if x.attrs.get(a)), "")
            made = {"ord": len(out), "kind": kind, "anchor": anchor, "title": squeeze(head.text()).strip() if head else "", "level": HEADINGS[head.tag] if head else 9, "node": c}
            before = next((d for d in reversed(out) if rank[d["kind"]] < rank[kind] and d["level"] < made["level"]), None)
            above = inside or before
            made["parent"] = above["ord"] if above else None
            made["trail"] = [*(above["trail"] if above else []), anchor or made["title"] or kind]
            out.append(made)
            visit(c, made)

    tree = parse(html)
    visit(tree, None)
    documents = {id(d["node"]) for d in out}

    def without(n: Node) -> Node:
        return Node(n.tag, n.attrs, [without(c) if isinstance(c, Node) else c for c in n.children if not (isinstance(c, Node) and id(c) in documents)])

    draw = Renderer(own, url)
    for d in out:
        mine = without(d.pop("node"))
        d["anchors"] = sorted({x.attrs[a] for x in mine.walk() for a in ("id", "name") if x.attrs.get(a)} | ({d["anchor"]} - {""}))
        d["markdown"] = collapse(_lines(draw.blocks(mine.children)))
        d.pop("level")
    return out
