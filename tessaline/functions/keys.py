"""URLs, paths and names as expressions: canonical forms, classes, output paths, slugs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_url(url: Column | str, prefix: str | None = None, suffix: str = ".md") -> Column:
    """Without query, fragment, trailing slashes and suffix; null outside prefix and for the bare prefix."""
    plain = F.regexp_replace(_col(url), r"[?#].*$", "")
    plain = F.regexp_replace(F.regexp_replace(plain, r"/+$", ""), F.lit(rf"\Q{suffix}\E$"), F.lit("")) if suffix else F.regexp_replace(plain, r"/+$", "")
    if prefix is None:
        return plain
    root = prefix.rstrip("/")
    return F.when(plain.startswith(root + "/") & (plain != root), plain)


def url_path(url: Column | str) -> Column:
    """The path alone: no scheme, host, query, fragment or slashes around it; '/' for the root."""
    path = F.regexp_replace(F.regexp_replace(_col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    bare = F.regexp_replace(path, r"^/+|/+$", "")
    return F.when(bare == "", F.lit("/")).otherwise(bare)


def url_host(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)


def segment(path: Column | str, n: int, default: str = "") -> Column:
    """Segment n of a path, from 1; negative from the end."""
    return F.coalesce(F.try_element_at(F.split(_col(path), "/"), F.lit(n)), F.lit(default))


def category_and_slug(path: Column | str, fallback: str = "general") -> Column:
    """struct<category, subpath, slug>: first segment, what is between, last segment; one segment alone is in fallback."""
    parts = F.split(_col(path), "/")
    n = F.size(parts)
    return F.struct(
        F.when(n > 1, F.get(parts, F.lit(0))).otherwise(F.lit(fallback)).alias("category"),
        F.when(n > 2, F.array_join(F.slice(parts, F.lit(2), F.greatest(n - 2, F.lit(0))), "/")).otherwise(F.lit("")).alias("subpath"),
        F.element_at(parts, -1).alias("slug"))


def classified(path: Column | str, rules: Sequence[tuple[str, str]], fallback: str = "general") -> Column:
    """The class of a path by the first rule whose pattern is found in it; $1 in a class is what the pattern has in brackets."""
    c = _col(path)
    out = None
    for pattern, name in rules:
        made = F.regexp_replace(F.regexp_extract(c, pattern, 0), pattern, name) if "$" in name else F.lit(name)
        out = F.when(c.rlike(pattern), made) if out is None else out.when(c.rlike(pattern), made)
    return F.lit(fallback) if out is None else out.otherwise(F.lit(fallback))


def rewritten(path: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """A path by the first rule (pattern, replacement) whose pattern is found in it; others stay as they are."""
    c = _col(path)
    out = None
    for pattern, made in rules:
        new = F.regexp_replace(c, pattern, made)
        out = F.when(c.rlike(pattern), new) if out is None else out.when(c.rlike(pattern), new)
    return c if out is None else out.otherwise(c)


def output_path(path: Column | str, extension: str = ".md", index: str = "index") -> Column:
    """A file for a path: unsafe characters become '-', the root becomes the index file."""
    safe = F.regexp_replace(F.regexp_replace(_col(path), r"[^\w./-]+", "-"), r"(^|/)\.+(?=/|$)", "$1")
    safe = F.regexp_replace(F.regexp_replace(safe, "/{2,}", "/"), r"^/+|/+$", "")
    return F.concat(F.when(safe == "", F.lit(index)).otherwise(safe), F.lit(extension))


def slug(name: Column | str, fallback: str = "misc", unicode: bool = True, lower: bool = True) -> Column:
    """Word characters, runs of space and '-' as one '-', none at the ends."""
    keep = r"(?U)[^\w\s-]" if unicode else r"[^a-zA-Z0-9\s-]"
    gap = r"(?U)[-\s]+" if unicode else r"[-\s]+"
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(_col(name), keep, ""), gap, "-"), "^-+|-+$", "")
    out = F.lower(out) if lower else out
    return F.when(F.coalesce(out, F.lit("")) == "", F.lit(fallback)).otherwise(out)


def anchor_slug(heading: Column | str) -> Column:
    """Heading anchors: lower case, word characters, space as '-', repeated '-' kept."""
    return F.regexp_replace(F.regexp_replace(F.lower(_col(heading)), r"(?U)[^\w\s-]", ""), r"(?U)\s", "-")


def in_prefixes(path: Column | str, prefixes: Sequence[str], bounded: bool = True) -> Column:
    """Whether path is one of prefixes or below it; unbounded, whether it begins with one."""
    value, out = _col(path), F.lit(False)
    for p in prefixes:
        bare = p.rstrip("/")
        out = out | ((value == bare) | value.startswith(bare + "/") if bounded else value.startswith(p))
    return out


#: Languages that end titles of translated pages, in brackets.
LANGUAGES = (
    "Bahasa Indonesia", "Bosanski", "Català", "Čeština", "Dansk", "Deutsch", "Eesti", "Español", "Esperanto", "Euskara", "Français", "Hrvatski", "Italiano", "Lietuvių", "Magyar",
    "Nederlands", "Norsk Bokmål", "Polski", "Português", "Português (Brasil)", "Qhichwa", "Română", "Slovenčina", "Slovenský", "Slovenščina", "Suomi", "Svenska", "Türkçe", "Tiếng Việt",
    "Ελληνικά", "Български", "Қазақша", "Македонски", "Русский", "Српски", "Українська", "العربية", "עברית", "فارسی", "हिन्दी", "ไทย", "বাংলা",
    "中文 (简体)", "中文 (繁體)", "中文（简体）", "中文（繁體）", "文言文", "正體中文", "粵語", "日本語", "한국어",
)


def translated_title(title: Column | str, languages: Sequence[str]) -> Column:
    """Whether a title ends in ' (Language)' for one of languages."""
    return F.regexp_extract(_col(title), r" \(([^()]+)\)$", 1).isin(*languages)


def looked_up(value: Column | str, names: Mapping[str, str], default: Column | None = None) -> Column:
    """Display names by a fixed map; others by default, or humanised."""
    c = _col(value)
    table = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair]) if names else None
    found = F.try_element_at(table, c) if table is not None else F.lit(None).cast("string")
    return F.coalesce(found, humanise(c) if default is None else default)


def humanise(name: Column | str) -> Column:
    """'-' and '_' as spaces, words capitalised."""
    return F.initcap(F.regexp_replace(_col(name), "[-_]+", " "))


def derive_title(name: Column | str, acronyms: Sequence[str] = ()) -> Column:
    """Humanised, with acronyms in capitals."""
    words = F.split(humanise(name), " ")
    upper = F.array(*[F.lit(a.upper()) for a in acronyms]) if acronyms else F.array().cast("array<string>")
    return F.array_join(F.transform(words, lambda w: F.when(F.array_contains(upper, F.upper(w)), F.upper(w)).otherwise(w)), " ")


def tags_or(tags: Column | str, default: str = "Untagged", empty_too: bool = True) -> Column:
    """tags, or [default] where null (and where empty)."""
    c = _col(tags)
    none = c.isNull() | (F.size(c) == 0) if empty_too else c.isNull()
    return F.when(none, F.array(F.lit(default))).otherwise(c)


def parent_paths(path: Column | str) -> Column:
    """All proper ancestors of a path, longest last."""
    parts = F.split(_col(path), "/")
    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).otherwise(F.array().cast("array<string>"))


def relative_link(source: Column | str, target: Column | str) -> Column:
    """The relative path from the file source to the file target."""
    a = F.split(_col(source), "/")
    b = F.split(_col(target), "/")
    pairs = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    shared = F.least(F.coalesce(F.array_position(F.transform(pairs, lambda e: F.when(e, 1).otherwise(0)), 0), F.lit(0)) - 1, (F.size(a) - 1).cast("bigint"))
    shared = F.when(shared < 0, (F.least(F.size(a), F.size(b)) - 1).cast("bigint")).otherwise(shared).cast("int")
    ups = F.array_repeat(F.lit(".."), F.size(a) - 1 - shared)
    return F.array_join(F.concat(ups, F.slice(b, shared + 1, F.size(b) - shared)), "/")


def absolute_link(href: Column | str, base: Column | str) -> Column:
    """href as a URL: protocol-relative, host-relative and path-relative ones against base; '#...' stays."""
    h, b = _col(href), _col(base)
    origin = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(b, r"[?#].*$", ""), r"(?<=[^/:])/[^/]*$", "")
    return (F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h).when(h.startswith("//"), F.concat(F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), h))
            .when(h.startswith("#"), h).when(h.startswith("/"), F.concat(origin, h)).otherwise(F.concat(folder, F.lit("/"), h)))


def percent_encoded(path: Column | str) -> Column:
    """Percent-encoding that keeps '/'."""
    return F.replace(F.replace(F.url_encode(_col(path)), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))
