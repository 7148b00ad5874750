"""Compiled MDX: the call tree inside a script, parsed by recursive descent and rendered as Markdown."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from .html_md import cell, code_span, collapse, fence, table
from .mdx_md import ALERTS


class CompiledError(ValueError):
    """The script is not what the compiler of MDX makes."""


@dataclass
class Element:
    tag: str
    props: dict[str, Any] = field(default_factory=dict)
    children: list = field(default_factory=list)


_TOKEN = re.compile(r"""\s*(?:(?P<string>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|`(?:[^`\\]|\\.)*`)|(?P<number>-?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)|(?P<name>[A-Za-z_$][\w$]*)|(?P<mark>\.\.\.|=>|[(){}\[\],:.!?|&=;+]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "0": "\0"}


def string_value(raw: str) -> str:
    def one(m: re.Match) -> str:
        s = m[1]
        if s[0] == "u":
            return chr(int(s[2:-1] if s[1] == "{" else s[1:], 16))
        return chr(int(s[1:], 16)) if s[0] == "x" and len(s) == 3 else "" if s == "\n" else _ESCAPES.get(s, s)

    text = re.sub(r"\\(u\{[0-9a-fA-F]+\}|u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2}|.)", one, raw[1:-1], flags=re.S)
    return re.sub(r"[\ud800-\udbff][\udc00-\udfff]", lambda m: m[0].encode("utf-16", "surrogatepass").decode("utf-16"), text)


class Parser:
    """Values: strings, numbers, names, arrays, objects (spreads merged), calls of _jsx and _jsxs as elements."""

    def __init__(self, source: str):
        self.source, self.at = source, 0

    def peek(self) -> tuple[str, str]:
        found = _TOKEN.match(self.source, self.at)
        if not found:
            if not self.source[self.at :].strip():
                return "end", ""
            raise CompiledError(f"unexpected {self.source[self.at : self.at + 20]!r}")
        return found.lastgroup, found[found.lastgroup]

    def take(self, want: str | None = None) -> tuple[str, str]:
        kind, value = self.peek()
        if want is not None and value != want:
            raise CompiledError(f"{want!r} expected, {value!r} found at {self.at}")
        self.at = _TOKEN.match(self.source, self.at).end() if kind != "end" else self.at
        return kind, value

    def value(self) -> Any:
        kind, value = self.take()
        if kind == "string":
            out: Any = string_value(value)
        elif kind == "number":
            out = float(value) if re.search("[.eE]", value) else int(value)
        elif value == "[":
            out = self.several("]")
        elif value == "{":
            out = self.object()
        elif value == "(":
            out = self.value()
            while self.peek()[1] == ",":
                self.take()
                out = self.value()
            self.take(")")
        elif value == "!":
            out = not self.value()
        elif kind == "name":
            out = self.named(value)
        else:
            raise CompiledError(f"unexpected {value!r} at {self.at}")
        while self.peek()[1] == "+":
            self.take()
            more = self.value()
            out = f"{out}{more}"
        return out

    def named(self, name: str) -> Any:
        if name in ("true", "false", "null", "undefined"):
            return {"true": True, "false": False}.get(name)
        if name == "void":
            self.value()
            return None
        while self.peek()[1] == ".":
            self.take()
            name += "." + self.take()[1]
        if self.peek()[1] != "(":
            return Name(name)
        self.take()
        arguments = self.several(")")
        if name.split(".")[-1] in ("_jsx", "_jsxs", "jsx", "jsxs"):
            tag, props = arguments[0], arguments[1] if len(arguments) > 1 and isinstance(arguments[1], dict) else {}
            props = dict(props)
            children = props.pop("children", [])
            tag = re.sub(r"^(?:_components|components)\.", "", str(tag))
            return Element("#fragment" if tag.endswith("Fragment") else tag, props, children if isinstance(children, list) else [children])
        return Name(f"{name}()")

    def several(self, end: str) -> list:
        out: list = []
        while self.peek()[1] != end:
            if self.peek()[1] == "...":
                self.take()
                more = self.value()
                out += more if isinstance(more, list) else []
            else:
                out.append(self.value())
            if self.peek()[1] != end:
                self.take(",")
        self.take(end)
        return out

    def object(self) -> dict:
        out: dict[str, Any] = {}
        while self.peek()[1] != "}":
            kind, key = self.take()
            if key == "...":
                more = self.value()
                out |= more if isinstance(more, dict) else {}
            else:
                key = string_value(key) if kind == "string" else key
                if self.peek()[1] == ":":
                    self.take()
                    out[key] = self.value()
                else:
                    out[key] = Name(key)
            if self.peek()[1] != "}":
                self.take(",")
        self.take("}")
        return out


class Name(str):
    """A name that stands for something outside; it shows as nothing."""


def parse_compiled(source: str) -> Element:
    """The element that the content function returns."""
    found = re.search(r"function _createMdxContent\([^)]*\)\s*\{", source)
    start = re.compile(r"return\s*").search(source, found.end()) if found else None
    while start and not re.match(r"\(?\s*(?:\w+\.)?_?jsxs?\(", source[start.end() :]):
        start = re.compile(r"return\s*").search(source, start.end())
    if not start:
        raise CompiledError("no content function")
    parser = Parser(source)
    parser.at = start.end()
    out = parser.value()
    if not isinstance(out, Element):
        raise CompiledError("the content is no element")
    return out


class CompiledRenderer:
    def __init__(self, resolve: Callable[[str], str] | None = None, unknown: dict[str, int] | None = None):
        self.resolve, self.unknown = resolve or (lambda x: x), {} if unknown is None else unknown

    def document(self, root: Element) -> str:
        return collapse(self.join(self.blocks([root])))

    @staticmethod
    def join(blocks: list[list[str]]) -> list[str]:
        out: list[str] = []
        for b in blocks:
            out += ["", *b] if out else b
        return out

    def text(self, nodes: list) -> str:
        return "".join(n if isinstance(n, str) and not isinstance(n, Name) else self.text(n.children) if isinstance(n, Element) else str(n) if isinstance(n, int | float) and not isinstance(n, bool) else "" for n in nodes)

    def inline(self, nodes: list) -> str:
        return "".join(self.one(n) for n in nodes)

    def one(self, n: Any) -> str:
        if not isinstance(n, Element):
            return self.text([n])
        marks = {"strong": "**", "b": "**", "em": "*", "i": "*", "del": "~~"}
        if n.tag == "style" or n.tag == "script":
            return ""
        if n.tag == "br":
            return "\n"
        if n.tag == "code":
            return code_span(self.text(n.children))
        if n.tag == "img":
            return f"![{n.props.get('alt', '')}]({self.resolve(str(n.props.get('src', '')))})"
        if n.tag == "input":
            return "[x] " if n.props.get("checked") else "[ ] "
        body = self.inline(n.children)
        if n.tag in marks and body.strip():
            return body[: len(body) - len(body.lstrip())] + marks[n.tag] + body.strip() + marks[n.tag] + body[len(body.rstrip()) :]
        if n.tag == "a" and isinstance(n.props.get("href"), str):
            return f"[{body.strip()}]({self.resolve(n.props['href'])})"
        return body

    INLINE = frozenset("a abbr b br code del em i img input kbd mark q s small span strong sub sup u".split())
    BLOCK = frozenset("#fragment article blockquote body details div dl figure footer h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table tbody ul".split())

    def blocks(self, nodes: list) -> list[list[str]]:
        out: list[list[str]] = []
        run: list = []

        def flush() -> None:
            text = self.inline(run).strip()
            run.clear()
            if text:
                out.append([x.strip() for x in text.split("\n")])

        for n in nodes:
            if not isinstance(n, Element) or n.tag in self.INLINE:
                run.append(n)
            else:
                flush()
                out += self.block(n)
        flush()
        return out

    def block(self, n: Element) -> list[list[str]]:
        if n.tag in ("style", "script"):
            return []
        if re.fullmatch("h[1-6]", n.tag):
            return [["#" * int(n.tag[1]) + " " + self.inline(n.children).strip()]]
        if n.tag == "hr":
            return [["---"]]
        if n.tag == "pre":
            code = next((c for c in n.children if isinstance(c, Element) and c.tag == "code"), n)
            found = re.search(r"language-([\w+-]+)", str(code.props.get("className", "")))
            return [fence(self.text(code.children), found[1] if found else "")]
        if n.tag in ("ul", "ol"):
            lines: list[str] = []
            for k, item in enumerate(c for c in n.children if isinstance(c, Element)):
                body = self.join(self.blocks(item.children)) or [""]
                first = re.sub(r"^\[[xX]\]", "[x]", body[0])
                lines += [f"{k + 1}. {first}" if n.tag == "ol" else f"- {first}".rstrip(), *[f"  {x}".rstrip() for x in body[1:]]]
            return [lines] if lines else []
        if n.tag == "table":
            rows = [[cell(self.inline(c.children)) for c in r.children if isinstance(c, Element)] for r in self._rows(n)]
            return [table([r for r in rows if r])] if any(rows) else []
        if n.tag == "blockquote":
            return [[f"> {x}".rstrip() for x in self.join(self.blocks(n.children))]]
        if n.tag == "summary":
            return [[f"**{self.inline(n.children).strip()}**"]]
        if n.tag in ("Banner", "Callout", "Admonition"):
            kind = ALERTS.get(str(n.props.get("color") or n.props.get("type") or "note").lower(), "NOTE")
            return [[f"> [!{kind}]", *[f"> {x}".rstrip() for x in self.join(self.blocks(n.children))]]]
        if n.tag in ("CH.Code", "CodeBlock"):
            return self.files(n.props.get("files"))
        if n.tag == "CH.Section":
            inner = self.blocks([c for c in n.children if not (isinstance(c, Element) and c.tag == "CH.SectionCode")])
            return [*inner, *self.files(n.props.get("files"))]
        if n.tag not in self.BLOCK and n.tag not in ("thead", "tr", "td", "th", "li", "dt", "dd", "figcaption"):
            self.unknown[n.tag] = self.unknown.get(n.tag, 0) + 1
        return self.blocks(n.children)

    def _rows(self, n: Element) -> list[Element]:
        return [r for c in n.children if isinstance(c, Element) for r in ([c] if c.tag == "tr" else self._rows(c))]

    def files(self, files: Any) -> list[list[str]]:
        """Code files given as lines of tokens, each with its name."""
        out: list[list[str]] = []
        for f in files if isinstance(files, list) else []:
            if isinstance(f, dict):
                code = f.get("code", {})
                text = "\n".join("".join(str(t.get("content", "")) for t in line.get("tokens", [])) for line in code.get("lines", []))
                language = str(code.get("lang", ""))
                out += [*([[f"**{f['name']}**"]] if f.get("name") else []), *([fence(text, "" if language == "text" else language)] if text.strip() else [])]
        return out


def compiled_to_markdown(source: str | None) -> tuple[str | None, dict[str, int]]:
    """(Markdown, how often each unknown component occurs); None where the script can't be parsed."""
    if source is None:
        return None, {}
    unknown: dict[str, int] = {}
    try:
        return CompiledRenderer(unknown=unknown).document(parse_compiled(source)), unknown
    except CompiledError:
        return None, {}
