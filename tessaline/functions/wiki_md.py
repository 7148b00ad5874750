"""Wikitext to Markdown: templates from the inside out, then lines."""

from __future__ import annotations

import html
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import quote

from .html_md import cell, code_span, collapse, table

#: Boilerplate templates that say nothing about the text, and admonitions.
SILENT_TEMPLATES = frozenset("style accuracy expansion out of date merge move remove redirect translateme stub toc lowercase title box poor writing".split()) | {"out of date", "poor writing", "lowercase title", "related articles end", "anchor"}
ADMONITIONS = {"note": "Note", "tip": "Tip", "warning": "Warning", "important": "Important", "caution": "Caution"}
SYMBOLS = {"!": "|", "=": "=", "nbsp": " ", "bull": "•", "yes": "Yes", "no": "No", "n/a": "N/A", "-": "—", "dash": "—"}
PAGE, PACKAGE, USER_PACKAGE, ENCYCLOPEDIA = "https://wiki.archlinux.org/title/", "https://archlinux.org/packages/?q=", "https://aur.archlinux.org/packages/", "https://en.wikipedia.org/wiki/"
MANUAL = "https://man.archlinux.org/man/"


def split_arguments(text: str) -> list[str]:
    """Parts between pipes that stand in no link or template."""
    parts, depth, start, at = [], 0, 0, 0
    while at < len(text):
        two = text[at : at + 2]
        if two in ("[[", "{{"):
            depth, at = depth + 1, at + 2
        elif two in ("]]", "}}"):
            depth, at = max(0, depth - 1), at + 2
        else:
            if text[at] == "|" and not depth:
                parts.append(text[start:at])
                start = at + 1
            at += 1
    return [*parts, text[start:]]


def find_template(text: str, start: int) -> tuple[str, int]:
    """The template that begins at start and where it ends; all that is left where it never ends; nothing where none begins."""
    if text[start : start + 2] != "{{":
        return "", start
    depth, at = 0, start
    while at < len(text):
        two = text[at : at + 2]
        if two == "{{":
            depth, at = depth + 1, at + 2
        elif two == "}}":
            depth, at = depth - 1, at + 2
            if not depth:
                return text[start:at], at
        else:
            at += 1
    return text[start:], len(text)


@dataclass
class Wiki:
    """One conversion. Spans that must stay as they are are stashed and put back at the end."""

    stash: list[str] = field(default_factory=list)

    def keep(self, text: str) -> str:
        self.stash.append(text)
        return f"\x02{len(self.stash) - 1}\x03"

    def restore(self, text: str) -> str:
        while "\x02" in text:
            text = re.sub("\x02(\\d+)\x03", lambda m: self.stash[int(m[1])], text)
        return text

    def block(self, lines: list[str]) -> str:
        return "\n\n" + self.keep("\n".join(lines)) + "\n\n"

    def code(self, code: str, language: str = "") -> str:
        code = html.unescape(self.restore(code)).strip("\n")
        mark = "`" * max(3, max((len(r) for r in re.findall("`{3,}", code)), default=2) + 1)
        return self.block([f"{mark}{language}", code, mark])

    # -- templates

    def template(self, body: str) -> str:
        name, *rest = split_arguments(body)
        name = name.strip().lower()
        named, plain = {}, []
        for r in rest:
            key, eq, value = r.partition("=")
            if eq and re.fullmatch(r"\s*[\w-]+\s*", key):
                named[key.strip().lower()] = value.strip()
            else:
                plain.append(r.strip())
        arg: Callable[[int], str] = lambda n: named.get(str(n), plain[n - 1] if n <= len(plain) else "")
        if name in SYMBOLS:
            return self.keep(SYMBOLS[name])
        if name in ADMONITIONS:
            # All of it is text: a bar in it separates nothing, `1=` only lets it have an equals sign.
            text = re.sub(r"^\s*\d+\s*=\s*", "", "|".join(rest)).strip()
            lines = self.inline(text).split("\n") if text else []
            return self.block([f"> **{ADMONITIONS[name]}:** {lines[0].rstrip()}" if lines else f"> **{ADMONITIONS[name]}**", *[f"> {x}".rstrip() for x in lines[1:]]])
        if name == "related articles start":
            return self.block(["**Related articles**"])
        if name in ("related", "related2"):
            return f"\n* [[{arg(1)}|{arg(2) or arg(1)}]]\n"
        if name in ("ic", "ic1", "ic2"):
            return self.keep(code_span(html.unescape(self.restore(arg(1)))))
        if name in ("pkg", "aur", "grp", "grp2"):
            return f"[{arg(1)}]({USER_PACKAGE + arg(1) if name == 'aur' else PACKAGE + quote(arg(1))})"
        if name == "man":
            return f"[{arg(2)}({arg(1)})]({MANUAL}{arg(2)}.{arg(1)})"
        if name in ("wikipedia", "wikimedia"):
            return f"[{arg(2) or arg(1)}]({ENCYCLOPEDIA}{quote(arg(1).replace(' ', '_'))})"
        if name == "bug":
            return f"#{arg(1)}"
        if name in ("file", "hc"):
            head, content = named.get("name") or arg(1), named.get("content") or arg(2)
            return self.block([f"**{code_span(self.restore(head))}**"]) + self.code(content)
        if name in ("bc", "text"):
            return self.code(arg(1))
        if name in ("strong", "em"):
            mark = "'''" if name == "strong" else "''"
            return f"{mark}{arg(1)}{mark}"
        return "" if name in SILENT_TEMPLATES else arg(1)

    def templates(self, text: str, passes: int = 8) -> str:
        for _ in range(passes):
            new = re.sub(r"\{\{((?:(?!\{\{|\}\}).)*)\}\}", lambda m: self.template(m[1]), text, flags=re.S)
            if new == text:
                break
            text = new
        return text

    # -- lines

    def inline(self, text: str) -> str:
        text = re.sub(r"'''''(.+?)'''''", r"***\1***", text)
        text = re.sub(r"'''(.+?)'''", r"**\1**", text)
        text = re.sub(r"''(.+?)''", r"*\1*", text)
        for names, mark in (("strong|b", "**"), ("em|i", "*"), ("s|del|strike", "~~")):
            text = re.sub(rf"(?is)<({names})\b[^>]*>(.*?)</\1>", rf"{mark}\2{mark}", text)
        text = re.sub(r"(?is)<(?:code|kbd|tt|samp)\b[^>]*>(.*?)</(?:code|kbd|tt|samp)>", lambda m: self.keep(code_span(html.unescape(self.restore(m[1])))), text)
        text = re.sub(r"(?i)<br\s*/?>", "\n", text)
        text = re.sub(r"\[\[([^\]|]*)(?:\|([^\]]*))?\]\]", self.link, text)
        text = re.sub(r"\[((?:https?|ftp|irc)://[^\s\]]+)\s+([^\]]*)\]", r"[\2](\1)", text)
        return html.unescape(re.sub(r"(?is)</?(?:span|div|u|small|big|center|sub|sup|font|p)\b[^>]*>", "", text))

    def link(self, m: re.Match) -> str:
        target, shown = m[1].strip(), (m[2] or m[1]).strip()
        if re.match(r"(?i)(category|file|image):", target):
            return ""
        target = target.lstrip(":")
        if re.match(r"(?i)(wikipedia|w):", target):
            return f"[{shown.split(':', 1)[-1] if m[2] is None else shown}]({ENCYCLOPEDIA}{quote(target.split(':', 1)[1].replace(' ', '_'), safe='/#')})"
        page, mark, anchor = target.partition("#")
        if not page:
            return f"[{shown.lstrip('#')}](#{re.sub(r'[^a-z0-9_-]', '', anchor.strip().lower().replace(' ', '-'))})"
        return f"[{shown}]({PAGE}{quote(page.replace(' ', '_'), safe='/:')}{mark}{quote(anchor.replace(' ', '_'), safe='')})"

    def wikitable(self, text: str) -> str:
        rows: list[list[str]] = []
        row: list[str] = []
        caption = ""
        for line in text.split("\n"):
            line = line.strip()
            if line.startswith("|+"):
                caption = line[2:].strip()
            elif line.startswith(("|-", "|}", "{|")):
                if row:
                    rows.append(row)
                row = []
            elif line.startswith(("!", "|")):
                for part in re.split(r"!!|\|\|", line[1:]):
                    attrs, bar, rest = part.partition("|")
                    row.append((rest if bar and re.fullmatch(r"""(?:\s*[\w-]+\s*=\s*(?:"[^"]*"|'[^']*'|\S+))+\s*""", attrs) else part).strip())
            elif row and line:
                row[-1] += " " + line
        if row:
            rows.append(row)
        lines = table([[cell(self.restore(self.inline(c))) for c in r] for r in rows])
        return self.block([*([f"**{caption}**", ""] if caption else []), *lines]) if lines else ""

    def convert(self, text: str) -> str:
        text = re.sub(r"(?s)<!--.*?-->", "", text)
        text = re.sub(r"__[A-Z]+__", "", text)
        text = re.sub(r"(?is)<ref\b[^>]*/>|<ref\b[^>]*>.*?</ref>", "", text)
        text = re.sub(r"""(?is)<(?:syntaxhighlight|source)\b([^>]*)>(.*?)</(?:syntaxhighlight|source)>""", lambda m: self.code(m[2], (re.findall(r"""lang\s*=\s*["']?([\w+-]+)""", m[1]) or [""])[0]), text)
        text = re.sub(r"(?is)<pre\b[^>]*>(.*?)</pre>", lambda m: self.code(m[1]), text)
        text = re.sub(r"(?is)<nowiki>(.*?)</nowiki>", lambda m: self.keep(m[1]), text)
        text = self.templates(text)
        text = re.sub(r"(?ms)^\{\|.*?^\|\}", lambda m: self.wikitable(m[0]), text)
        out: list[str] = []
        counts: list[int] = []
        legacy: list[str] = []

        def flush() -> None:
            if legacy:
                out.extend(["", self.code("\n".join(legacy)).strip(), ""])
                legacy.clear()

        for line in text.split("\n"):
            if line.startswith(" ") and line.strip() and "\x02" not in line:
                legacy.append(line[1:])
                continue
            flush()
            if found := re.fullmatch(r"(={1,6})\s*(.*?)\s*\1\s*", line):
                out += ["", "#" * len(found[1]) + " " + self.inline(found[2]), ""]
            elif re.fullmatch(r"-{4,}|<hr\s*/?>", line.strip()):
                out += ["", "---", ""]
            elif found := re.match(r"([*#]+)[:]*\s*(.*)", line):
                marks = found[1]
                counts = counts[: len(marks)] + [0] * (len(marks) - len(counts))
                counts[-1] += 1
                item = f"{counts[-1]}. " if marks[-1] == "#" else "- "
                out.append("  " * (len(marks) - 1) + item + self.inline(found[2]))
                continue
            elif line.startswith(":"):
                out.append("> " + self.inline(line.lstrip(":").strip()))
            elif line.startswith(";"):
                term, colon, rest = line[1:].partition(" : ")
                out += ["", f"**{self.inline(term.strip())}**", *([self.inline(rest.strip())] if colon else [])]
            else:
                out.append(self.inline(line).rstrip())
            counts = []
        flush()
        return collapse(self.restore("\n".join(out)).split("\n"))


def wikitext_to_markdown(text: str | None) -> str | None:
    return None if text is None else Wiki().convert(text)


def categories(text: str) -> list[str]:
    """Categories in the text, in order, each once."""
    return list(dict.fromkeys(c.strip() for c in re.findall(r"(?i)\[\[category:([^\]|]+)", text)))
