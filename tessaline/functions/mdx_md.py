"""Markdown with components, shortcodes, admonitions and tabs to plain Markdown. Fenced code is never touched."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Mapping

from .html_md import code_span, collapse

#: What admonition names are called as alerts.
ALERTS = {"note": "NOTE", "info": "NOTE", "tip": "TIP", "success": "TIP", "hint": "TIP", "check": "TIP", "important": "IMPORTANT", "warning": "WARNING", "warn": "WARNING", "alert": "WARNING", "caution": "CAUTION", "danger": "CAUTION", "error": "CAUTION"}


def fence_parts(text: str) -> list[tuple[bool, str]]:
    """(is code, part): fenced blocks with their fences, and what is between. A fence ends with as many marks at least."""
    parts: list[tuple[bool, list[str]]] = []
    mark = ""
    for line in text.split("\n"):
        found = re.match(r"\s*(?:> ?)*(`{3,}|~{3,})", line)
        if mark:
            parts[-1][1].append(line)
            if found and found[1][0] == mark[0] and len(found[1]) >= len(mark) and not line.strip(" >").strip(mark[0]):
                mark = ""
                parts.append((False, []))
        elif found:
            mark = found[1]
            parts.append((True, [line]))
        else:
            if not parts or parts[-1][0]:
                parts.append((False, []))
            parts[-1][1].append(line)
    return [(code, "\n".join(lines)) for code, lines in parts if lines]


def outside_fences(text: str, change: Callable[[str], str]) -> str:
    """text with change made to all that is not fenced code, which is held out of sight meanwhile."""
    held = [part for code, part in fence_parts(text) if code]
    count = iter(range(len(held)))
    hidden = "\n".join(f"\x04{next(count)}\x05" if code else part for code, part in fence_parts(text))
    hidden = change(hidden)

    def back(m: re.Match) -> str:
        lead = m[1]
        return "\n".join(f"{lead}{x}".rstrip() if lead.strip() else x for x in held[int(m[2])].split("\n"))

    return re.sub("(?m)^([ >\t]*)\x04(\\d+)\x05", back, hidden)


def attributes(text: str) -> dict[str, str]:
    return {k: a or b or c for k, a, b, c in re.findall(r"""([\w-]+)=(?:"([^"]*)"|'([^']*)'|\{([^{}]*)\})""", text)}


def quoted(text: str) -> list[str]:
    return [f"> {x}".rstrip() for x in text.strip("\n").split("\n")]


def alert(kind: str, title: str, body: str) -> str:
    return "\n".join([f"> [!{ALERTS.get(kind.lower(), 'NOTE')}]", *([f"> **{title}**"] if title else []), *quoted(body)])


def asides(text: str) -> str:
    """`:::kind[Title]` blocks, nested ones too, as alerts."""
    for _ in range(8):
        new = re.sub(r"(?ms)^:::+[ \t]*(\w+)(?:\[([^\]]*)\]|[ \t]+([^\n]+))?[ \t]*\n((?:(?!^:::+[ \t]*\w).)*?)\n?^:::+[ \t]*$", lambda m: alert(m[1], (m[2] or m[3] or "").strip(), m[4]), text)
        if new == text:
            return new
        text = new
    return text


def content_tabs(text: str) -> str:
    """`=== "Name"` and `!!! kind "Title"` with indented bodies."""
    out: list[str] = []
    lines = text.split("\n")
    at = 0
    while at < len(lines):
        tab = re.match(r"""^===\+?\s+["']([^"']+)["']\s*$""", lines[at])
        note = re.match(r"""^(?:!!!|\?\?\?\+?)\s+(\w+)(?:\s+["']([^"']*)["'])?\s*$""", lines[at])
        if not tab and not note:
            out.append(lines[at])
            at += 1
            continue
        stop = at + 1
        while stop < len(lines) and (not lines[stop].strip() or lines[stop].startswith(("    ", "\t"))):
            stop += 1
        body = "\n".join(x[4:] if x.startswith("    ") else x.lstrip("\t") for x in lines[at + 1 : stop]).strip("\n")
        out += [f"**{tab[1]}**", "", body, ""] if tab else [alert(note[1], note[2] or "", body), ""]
        at = stop
    return "\n".join(out)


def inline_html(text: str) -> str:
    for tags, mark in (("strong|b", "**"), ("em|i", "*")):
        text = re.sub(rf"(?is)<({tags})>(.*?)</\1>", rf"{mark}\2{mark}", text)
    text = re.sub(r"(?is)<(?:code|kbd)>(.*?)</(?:code|kbd)>", lambda m: code_span(html.unescape(m[1])), text)
    text = re.sub(r"""(?is)<a\b[^>]*?href=["']([^"']*)["'][^>]*>(.*?)</a>""", r"[\2](\1)", text)
    text = re.sub(r"""(?is)<img\b([^>]*)/?>""", lambda m: f"![{attributes(m[1]).get('alt', '')}]({attributes(m[1]).get('src', '')})", text)
    return re.sub(r"(?i)<br\s*/?>", "\n", text)


def components(text: str) -> str:
    """Known components as Markdown; all others give way to their content."""
    text = re.sub(r"(?m)^(?:import|export)\s[^\n]*(?:\n(?![\n<#])[^\n]*[;})]\s*$)*\n?", "", text)
    text = re.sub(r"(?s)\{/\*.*?\*/\}|<!--.*?-->", "", text)
    for name in ("Note", "Tip", "Info", "Warning", "Caution", "Danger", "Check", "Success", "Important", "Error"):
        text = re.sub(rf"(?s)<{name}\b([^>]*)>(.*?)</{name}>", lambda m, n=name: f"\n{alert(n, attributes(m[1]).get('title', ''), _dedented(m[2]))}\n", text)
    text = re.sub(r"(?s)<(?:Callout|Aside|Admonition)\b([^>]*)>(.*?)</(?:Callout|Aside|Admonition)>", lambda m: f"\n{alert(attributes(m[1]).get('type', 'note'), attributes(m[1]).get('title', ''), _dedented(m[2]))}\n", text)
    text = re.sub(r"<(?:CloudflareVideo|Video|YouTube|iframe)\b[^>]*(?:/>|>\s*</\w+>)", "[Video]", text)
    text = re.sub(r"<(?:Tab|TabItem|Step|Accordion|Card|CodeGroup|Expandable|Update)\b([^>]*?)(/?)>", lambda m: (lambda a: f"\n**{a.get('title') or a.get('label')}**\n\n" if a.get("title") or a.get("label") else "\n")(attributes(m[1])), text)
    text = re.sub(r"<(?:ParamField|ResponseField)\b([^>]*)>", lambda m: (lambda a: f"\n- `{a.get('name') or a.get('path') or a.get('query') or a.get('body') or ''}`{' (' + a['type'] + ')' if a.get('type') else ''}{' **required**' if re.search(r'\brequired\b', m[1]) else ''} ")(attributes(m[1])), text)
    text = inline_html(text)
    text = re.sub(r"</?[A-Z][\w.]*\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>", "", text)
    return re.sub(r"(?i)</?(?:div|span|p|section|center|details|figure|small|sup|sub)\b[^>]*>", "", re.sub(r"(?is)<summary>(.*?)</summary>", r"**\1**\n", text))


def _dedented(text: str) -> str:
    return "\n".join(x.strip() if not x.lstrip().startswith("\x04") else x for x in text.strip("\n").split("\n"))


def mdx_to_markdown(text: str | None) -> str | None:
    if text is None:
        return None
    return collapse(outside_fences(text, lambda x: asides(components(x))).split("\n"))


def jekyll_to_markdown(text: str | None) -> str | None:
    """Liquid tags go, callouts become quotes."""
    if text is None:
        return None

    def change(x: str) -> str:
        x = re.sub(r"(?s)\{%-?\s*callout\s+(\w+)[^%]*%\}(.*?)\{%-?\s*endcallout\s*-?%\}", lambda m: "\n".join([f"> **{m[1].capitalize()}:** {m[2].strip().split(chr(10))[0]}", *quoted("\n".join(m[2].strip().split("\n")[1:]))] if m[2].strip().count("\n") else [f"> **{m[1].capitalize()}:** {m[2].strip()}"]), x)
        x = re.sub(r"""(?m)^\{:\s*[^}]*\}\s*$""", "", x)
        return re.sub(r"(?s)\{%.*?%\}|\{\{.*?\}\}", "", x)

    return collapse(outside_fences(text, change).split("\n"))


def mkdocs_to_markdown(text: str | None) -> str | None:
    return None if text is None else collapse(outside_fences(content_tabs(text), lambda x: x).split("\n"))


class Shortcodes:
    """Hugo shortcodes. Data blocks render from data; what is not known is counted, and its content stays."""

    def __init__(self, data: Mapping | None = None, resolve: Callable[[str], str] | None = None):
        self.data, self.resolve, self.unknown = data or {}, resolve, {}

    def convert(self, text: str) -> str:
        return collapse(outside_fences(text, self._change).split("\n"))

    def _change(self, text: str) -> str:
        text = re.sub(r"(?s)\{\{[<%]\s*(callout|admonition|tabs?|details?|tab)\b([^>%]*)[>%]\}\}((?:(?!\{\{[<%]\s*\1\b).)*?)\{\{[<%]\s*/\s*\1\s*[>%]\}\}", self._paired, text)
        text = re.sub(r"(?s)\{\{[<%]\s*/?\s*([\w-]+)([^>%]*?)/?\s*[>%]\}\}", self._single, text)
        return re.sub(r"(!?)\[([^\]]*)\]\(([^)\s]+)\)", lambda m: f"{m[1]}[{m[2]}]({self.resolve(m[3])})", text) if self.resolve else text

    def _paired(self, m: re.Match) -> str:
        a, body = attributes(m[2]), self._change(m[3].strip("\n"))
        if m[1] in ("callout", "admonition"):
            return alert(a.get("context") or a.get("type") or "note", a.get("title", ""), body)
        title = a.get("name") or a.get("title") or " ".join(re.findall(r'^\s*"([^"]+)"', m[2]))
        return (f"**{title}**\n\n" if title else "") + body

    def _single(self, m: re.Match) -> str:
        name, a = m[1], attributes(m[2])
        plain = re.findall(r'"([^"]*)"', re.sub(r'[\w-]+="[^"]*"', "", m[2]))
        if name == "confkey":
            return config_key(a)
        if name in ("figure", "picture", "img"):
            return figure(a, self.resolve)
        if name == "support":
            text = a.get("support", "").capitalize()
            return f"[{text}]({a['link']})" if a.get("link") else text
        if name == "roadmap-status":
            return f"**Status:** {a.get('stage', '')}" + (f" ({a['version']})" if a.get("version") else "")
        if name == "latest":
            return str(self.data.get("misc", {}).get("latest", ""))
        if name == "table-config-keys":
            keys = [k for k in self.data.get("configkeys", []) if str(k.get("secret", False)).lower() == a.get("secrets", "false")]
            return "\n".join(["| Configuration Key | Environment Variable |", "| --- | --- |", *[f"| `{k['path']}` | `{k['env']}` |" for k in keys]])
        if name in ("sitevar", "env"):
            return a.get("value") or a.get("default") or (plain[0] if plain else "")
        self.unknown[name] = self.unknown.get(name, 0) + 1
        return ""


def config_key(a: Mapping[str, str]) -> str:
    """`Type: ... | Default: ... | Required: ...` of a configuration key."""
    parts = [f"Type: {', '.join(f'`{t.strip()}`' for t in a['type'].split(','))}"] if a.get("type") else []
    if a.get("structure"):
        parts.append(f"Structure: [{a['structure']}](#{a['structure']})")
    if a.get("syntax"):
        parts.append(f"Syntax: [{a['syntax']}](#{a['syntax']})")
    parts += [f"Default: `{a['default']}`"] if a.get("default") else []
    parts += [f"Required: {a['required']}"] if a.get("required") else []
    parts += ["Secret: yes"] if a.get("secret") in ("yes", "true") else []
    return "*" + " | ".join(parts) + "*" if parts else ""


def figure(a: Mapping[str, str], resolve: Callable[[str], str] | None = None) -> str:
    """An image with its caption; the alternative text alone where there is no source."""
    text, src = a.get("caption") or a.get("alt") or a.get("title") or "", a.get("src", "")
    if not src:
        return f"*{text}*" if text else ""
    return f"![{a.get('alt') or text}]({resolve(src) if resolve else src})" + (f"\n\n*{a['caption']}*" if a.get("caption") else "")


def shortcodes_to_markdown(text: str | None, data: Mapping | None = None, resolve: Callable[[str], str] | None = None) -> str | None:
    return None if text is None else Shortcodes(data, resolve).convert(text)


def lines_of_markdown(text: str) -> list[str]:
    return [x for x in collapse(text.split("\n")).split("\n")]
