"""Text functions as expressions: stripping, titles, front matter, tables, caps, fences, hashes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: The five entities that markup itself needs, the ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
#: Elements whose content is never text, and the furniture around a page.
SILENT = ("script", "style", "noscript", "svg", "template", "iframe")
CHROME = ("nav", "header", "footer", "aside")


def content_hash(text: Column | str) -> Column:
    """SHA-256 of the UTF-8 bytes, lower-case hex."""
    return F.sha2(_col(text).cast("binary"), 256)


def stripped(text: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(F.regexp_replace(_col(text), r"(?U)^\s+", ""), r"(?U)\s+$", "")


def collapsed(text: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(text), r"(?U)\s+", " "))


def unescaped(text: Column | str) -> Column:
    out = _col(text)
    for name, value in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(value))
    return out


def without_elements(html: Column | str, names: Sequence[str]) -> Column:
    """Elements and their content removed, one pattern for each name (so that it is the same in engines without back-references)."""
    out = _col(html)
    for name in names:
        out = F.regexp_replace(out, rf"(?is)<{name}\b[^>]*>.*?</{name}\s*>", " ")
    return out


def plain_text(html: Column | str, drop: Sequence[str] = (*SILENT, *CHROME)) -> Column:
    """Text of HTML: no comments, no dropped elements, no tags, entities decoded, space collapsed."""
    out = without_elements(F.regexp_replace(_col(html), r"(?s)<!--.*?-->", " "), drop)
    return collapsed(unescaped(F.regexp_replace(out, r"(?s)<[^>]*>", " ")))


def html_title(html: Column | str) -> Column:
    """<title> text before the first spaced pipe; empty without one."""
    raw = F.regexp_extract(_col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return collapsed(unescaped(F.regexp_replace(raw, r"\s\|\s.*$", "")))


def html_heading(html: Column | str) -> Column:
    return collapsed(unescaped(F.regexp_replace(F.regexp_extract(_col(html), r"(?is)<h1\b[^>]*>(.*?)</h1>", 1), "<[^>]*>", "")))


def first_present(*values: Column | str) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(_col(v), F.lit("")) for v in values])


def first_line(text: Column | str) -> Column:
    """The first line that has more than white space, stripped; empty without one."""
    return F.coalesce(F.get(F.filter(F.transform(F.split(_col(text), "\n"), lambda x: F.trim(x)), lambda x: x != ""), F.lit(0)), F.lit(""))


def markdown_title(text: Column | str) -> Column:
    return F.regexp_extract(_col(text), r"(?m)^# (.+)$", 1)


def capped(text: Column | str, size: int = 150, mark: str = "...") -> Column:
    """At most size characters, the last of a longer text being mark."""
    c = _col(text)
    return F.when(F.char_length(c) > size, F.concat(F.substring(c, 1, size - len(mark)), F.lit(mark))).otherwise(c)


def table_cell(text: Column | str) -> Column:
    """Pipes escaped, line breaks as spaces."""
    return F.replace(F.replace(_col(text), F.lit("|"), F.lit(r"\|")), F.lit("\n"), F.lit(" "))


def markdown_table(rows: Column | str) -> Column:
    """Rows (array of arrays of cells, the first the header) as a table; short rows are padded.

    The width is an argument of the lambda that pads: as an expression inside it, it would be found anew for each row.
    """
    rows = _col(rows)
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    padded = lambda r, width: line(F.concat(F.transform(r, lambda c: table_cell(F.coalesce(c, F.lit("")))), F.array_repeat(F.lit(""), width - F.size(r))))

    def table(width: Column) -> Column:
        body = F.transform(F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))), lambda r: padded(r, width))
        return F.array_join(F.concat(F.transform(F.slice(rows, 1, 1), lambda r: padded(r, width)), F.array(line(F.array_repeat(F.lit("---"), width))), body), "\n")

    widest = F.array_max(F.transform(rows, lambda r: F.size(r)))
    return F.when(F.size(rows) > 0, F.get(F.transform(F.array(widest), table), F.lit(0))).otherwise(F.lit(""))


#: A block of lines between two lines of three dashes at the start.
FRONT_MATTER = r"(?s)\A---\r?\n(.*?)\r?\n---\r?(?:\n|\z)"


def front_matter(text: Column | str) -> Column:
    return F.regexp_extract(_col(text), FRONT_MATTER, 1)


def without_front_matter(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), FRONT_MATTER, "")


def front_value(text: Column | str, key: str) -> Column:
    """A scalar of the front matter without its quotes; empty without one."""
    raw = F.regexp_extract(front_matter(text), rf"(?m)^{key}:[ \t]*(.*?)[ \t]*$", 1)
    return F.regexp_replace(raw, r"""^(["'])(.*)\1$""", "$2")


def front_list(text: Column | str, key: str) -> Column:
    """A list of the front matter, flow `[a, b]` or block `- a`."""
    block = front_matter(text)
    flow = F.regexp_extract(block, rf"(?m)^{key}:[ \t]*\[(.*?)\][ \t]*$", 1)
    lines = F.regexp_extract(block, rf"(?m)^{key}:[ \t]*\n((?:[ \t]*- .*(?:\n|\z))+)", 1)
    clean = lambda x: F.regexp_replace(F.trim(x), r"""^(["'])(.*)\1$""", "$2")
    full = lambda a: F.filter(F.transform(a, clean), lambda x: x != "")
    return F.when(flow != "", full(F.split(flow, ","))).otherwise(full(F.transform(F.split(lines, "\n"), lambda x: F.regexp_replace(x, r"^\s*- ", ""))))


def with_preamble(body: Column | str, title: Column | str, url: Column | str) -> Column:
    """Heading, source link and body without the heading it repeats."""
    t, b = _col(title), stripped(body)
    again = F.regexp_extract(b, r"\A# ([^\n]*)", 1) == t
    rest = F.when(again, F.regexp_replace(b, r"\A# [^\n]*\n*", "")).otherwise(b)
    return F.concat(F.lit("# "), t, F.lit("\n\nSource: "), _col(url), F.lit("\n\n"), rest, F.lit("\n"))


def _linked(url: Column) -> Column:
    return F.concat(F.lit("*Source: ["), url, F.lit("]("), url, F.lit(")*"))


def titled_page(body: Column | str, title: Column | str, url: Column | str) -> Column:
    """The body below its source; above both a heading, the title or the body's first, where the body does not begin with it."""
    b = F.concat(F.regexp_replace(_col(body), r"\s+\z", ""), F.lit("\n"))
    t = F.coalesce(F.nullif(_col(title), F.lit("")), F.nullif(F.trim(F.regexp_extract(b, r"(?m)^# (.+)$", 1)), F.lit("")))
    missing = t.isNotNull() & ~F.startswith(F.regexp_replace(b, r"\A\s+", ""), F.concat(F.lit("# "), t))
    return F.concat(F.when(missing, F.concat(F.lit("# "), t, F.lit("\n\n"))).otherwise(F.lit("")), _linked(_col(url)), F.lit("\n"), b)


#: Fixed value: the banner that leads pages of one documentation host to its index.
INDEX_BANNER = r"\A> ## Documentation Index\n(?:> [^\n]*\n)+\n*"


def sourced_page(body: Column | str, title: Column | str, url: Column | str, banner: bool = False) -> Column:
    """Like titled_page, but the title is the heading only of a body that begins with none; with banner, the index's banner goes first."""
    b = F.regexp_replace(F.regexp_replace(_col(body), INDEX_BANNER, ""), r"\A\n+", "") if banner else _col(body)
    b = F.concat(F.regexp_replace(b, r"\s+\z", ""), F.lit("\n"))
    missing = ~F.rlike(b, F.lit(r"\A# .")) & (F.coalesce(_col(title), F.lit("")) != "")
    return F.concat(F.when(missing, F.concat(F.lit("# "), _col(title), F.lit("\n\n"))).otherwise(F.lit("")), _linked(_col(url)), F.lit("\n"), b)


def headed_page(body: Column | str, title: Column | str, url: Column | str, summary: Column | str) -> Column:
    """Title, source, summary and a rule, then the body without the index's banner."""
    b = stripped(F.regexp_replace(stripped(body), INDEX_BANNER, ""))
    about = F.when(F.coalesce(_col(summary), F.lit("")) != "", F.concat(F.lit("\n"), _col(summary), F.lit("\n"))).otherwise(F.lit(""))
    return F.concat(F.lit("# "), _col(title), F.lit("\n\n"), _linked(_col(url)), F.lit("\n"), about, F.lit("\n---\n"), b, F.lit("\n"))


def concatenated_page(body: Column | str, title: Column | str, url: Column | str) -> Column:
    """A page out of a concatenated corpus: title, source, and the body without lines of tags that say nothing in Markdown."""
    b = F.regexp_replace(_col(body), r"(?m)^\s*<(?:ApiReleaseLifecycle|Scopes|AuthDocsPipeline)\s*/?>.*(?:\n|\z)", "")
    return F.concat(stripped(F.concat(F.lit("# "), _col(title), F.lit("\n"), _linked(_col(url)), F.lit("\n\n"), b)), F.lit("\n"))


#: Components that give way to their content.
PLAIN_COMPONENTS = "Tabs|Tab|Accordion|AccordionGroup|Info|Tip|Warning|Note|Steps|Step|Card|CardGroup|CodeGroup|Callout|Frame"


def without_components(text: Column | str) -> Column:
    """From the first heading of the first level on, without the tags of known components; null where there is no such heading."""
    b = stripped(F.nullif(F.regexp_extract(_col(text), r"(?ms)^(# .*)", 1), F.lit("")))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(b, rf"<(?:{PLAIN_COMPONENTS})[^>]*/?>", ""), rf"</(?:{PLAIN_COMPONENTS})>", ""), r"\n{3,}", "\n\n")


def without_banners(text: Column | str, patterns: Sequence[str]) -> Column:
    """Boilerplate removed by multi-line patterns."""
    out = _col(text)
    for p in patterns:
        out = F.regexp_replace(out, p, "")
    return out


def blank_runs_collapsed(text: Column | str, keep: int = 1) -> Column:
    """Of consecutive blank lines, the first keep."""
    return F.regexp_replace(_col(text), rf"((?:[ \t]*\n){{{keep + 1}}})(?:[ \t]*\n)+", "$1")


def code_span(text: Column | str) -> Column:
    """Back-quoted with as many ticks as it takes."""
    c = _col(text)
    longest = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(c, F.lit("`+"), F.lit(0)), lambda r: F.char_length(r))), F.lit(0))
    ticks = F.repeat(F.lit("`"), longest + 1)
    pad = F.when(c.startswith("`") | c.endswith("`"), F.lit(" ")).otherwise(F.lit(""))
    return F.concat(ticks, pad, c, pad, ticks)


def fenced(code: Column | str, language: Column | str | None = None) -> Column:
    """A fenced block whose fence the code does not contain."""
    c = _col(code)
    longest = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(c, F.lit("(?m)^ *(`{3,})"), F.lit(1)), lambda r: F.char_length(r))), F.lit(2))
    fence = F.repeat(F.lit("`"), longest + 1)
    return F.concat(fence, F.lit("") if language is None else _col(language), F.lit("\n"), F.regexp_replace(c, "\n+$", ""), F.lit("\n"), fence)


def short_number(n: Column | str, millions: bool = True) -> Column:
    """1.2M, 3K, 999; without millions thousands go on: 1250K."""
    c = _col(n)
    thousands = F.when(c >= 1_000, F.concat(F.floor(c / 1000).cast("string"), F.lit("K"))).otherwise(c.cast("string"))
    return F.when(c >= 1_000_000, F.concat(F.round(c / 1e6, 1).cast("string"), F.lit("M"))).otherwise(thousands) if millions else thousands


#: Substitutions that make Markdown of snippets, in this order; $1 and $2 are what the pattern has in brackets.
SNIPPET_STEPS = (
    *((rf"(?is)<{name}\b[^>]*>.*?</{name}\s*>", " ") for name in SILENT), *((rf"(?is)<h{n}\b[^>]*>(.*?)</h{n}>", "\n\n" + "#" * n + " $1\n\n") for n in range(1, 7)),
    (r"(?is)<pre\b[^>]*>\s*(?:<code\b[^>]*>)?(.*?)(?:</code>)?\s*</pre>", "\n\n```\n$1\n```\n\n"), (r"(?is)<(?:strong|b)\b[^>]*>(.*?)</(?:strong|b)>", "**$1**"),
    (r"(?is)<(?:em|i)\b[^>]*>(.*?)</(?:em|i)>", "*$1*"), (r"(?is)<code\b[^>]*>(.*?)</code>", "`$1`"), (r"""(?is)<a\b[^>]*href=["']([^"']*)["'][^>]*>(.*?)</a>""", "[$2]($1)"),
    (r"(?is)<li\b[^>]*>", "\n- "), (r"(?i)<br\s*/?>", "\n"), (r"(?i)</?(?:p|div|ul|ol|table)\b[^>]*>", "\n\n"), (r"(?is)</t[dh]>\s*<t[dh]\b[^>]*>", " | "), (r"(?is)<tr\b[^>]*>\s*<t[dh]\b[^>]*>", "\n| "), (r"(?is)</t[dh]>\s*</tr>", " |"),
    (r"(?s)<[^>]*>", ""),
)
SNIPPET_LINES = ((r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n"))


def html_to_markdown_simple(html: Column | str) -> Column:
    """Snippets of HTML by ordered substitutions alone: headings, emphasis, code, links, lists, breaks; tags left over go."""
    out = _col(html)
    for pattern, value in SNIPPET_STEPS:
        out = F.regexp_replace(out, pattern, value)
    out = unescaped(out)
    for pattern, value in SNIPPET_LINES:
        out = F.regexp_replace(out, pattern, value)
    return stripped(out)


def renamed_asides(text: Column | str, labels: Mapping[str, str]) -> Column:
    """`:::kind` blocks as quoted alerts' first lines; the closing fence goes."""
    out = _col(text)
    for kind, label in labels.items():
        out = F.regexp_replace(out, rf"(?m)^:::\s*{kind}\b[^\n]*$", f"> [!{label}]")
    return F.regexp_replace(out, r"(?m)^:::\s*$\n?", "")


def versioned(token: Column | str, engine: str) -> Column:
    """A change token with the converter's version in it, so that a new converter invalidates."""
    return F.concat_ws("\u0001", F.lit(engine), _col(token))
