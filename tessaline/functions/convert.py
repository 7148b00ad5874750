"""Converters as columns: Arrow batches in Python workers, one string in, one string (or rows) out.

Nothing but the text columns travels; filters and joins stay in the JVM. Rows are independent, so retries are safe.
"""

from __future__ import annotations

import html as html_lib
import json
import zlib
from base64 import b64decode
from collections.abc import Callable, Mapping

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compiled_mdx, html_md, mdx_md, rst_md, spec_md, wiki_md


def _bounded() -> None:
    """Arrow batches of few rows and bytes: what a worker holds is a batch, its texts and what is made of them, whatever the table has."""
    spark = SparkSession.active()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def _texts(convert: Callable[[str], str | None], kind: str = "string") -> Callable[..., Column]:
    @F.pandas_udf(kind)
    def run(values: pd.Series) -> pd.Series:
        return values.map(convert, na_action="ignore")

    return run


def html_to_markdown(html: Column | str, dialect: str = "plain", url: Column | str | None = None, title: Column | str | None = None) -> Column:
    """Markdown of the dialect's content, null where it is missing; links absolute where url is given."""
    _bounded()
    blank = F.lit("")

    @F.pandas_udf("string")
    def run(pages: pd.Series, urls: pd.Series, titles: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else html_md.html_to_markdown(p, dialect, u or "", t or "") for p, u, t in zip(pages, urls, titles, strict=True)], dtype="object")

    return run(html, blank if url is None else url, blank if title is None else title)


def wikitext_to_markdown(text: Column | str) -> Column:
    return _texts(wiki_md.wikitext_to_markdown)(text)


def mdx_to_markdown(text: Column | str) -> Column:
    return _texts(mdx_md.mdx_to_markdown)(text)


def jekyll_to_markdown(text: Column | str) -> Column:
    return _texts(mdx_md.jekyll_to_markdown)(text)


def mkdocs_to_markdown(text: Column | str) -> Column:
    return _texts(mdx_md.mkdocs_to_markdown)(text)


def shortcodes_to_markdown(text: Column | str, data: Mapping | None = None) -> Column:
    return _texts(lambda t: mdx_md.shortcodes_to_markdown(t, data))(text)


def compiled_to_markdown(script: Column | str) -> Column:
    """struct<markdown, unknown map<string,int>>."""

    @F.pandas_udf("markdown string, unknown map<string,int>")
    def run(values: pd.Series) -> pd.DataFrame:
        made = [compiled_mdx.compiled_to_markdown(v) for v in values]
        return pd.DataFrame({"markdown": [m for m, _ in made], "unknown": [u for _, u in made]})

    return run(script)


def rst_to_markdown(docs: DataFrame, name: str = "name", text: str = "text", bases: dict[str, str] | None = None) -> DataFrame:
    """docs with markdown: titles and labels of the whole corpus are made first, and only what a document names is joined to it."""
    _bounded()
    kinds = "kind string, label string, doc string, slug string, title string"

    @F.pandas_udf(f"array<struct<{kinds.replace(' string', ':string')}>>")
    def defined(names: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([rst_md.marks(n, t or "") for n, t in zip(names, texts, strict=True)])

    wanted_pattern = F.lit(r":(?:[\w+-]+:)?(?:doc|ref):`(?:[^`<]*<)?/?([^`>]+)>?`")
    marks = docs.select(F.explode(defined(name, text)).alias("d")).select("d.*")
    last = marks.groupBy("kind", "label").agg(F.max_by(F.struct("doc", "slug", "title"), "doc").alias("at"))
    asked = docs.select(F.col(name).alias("__n"), F.explode(F.array_distinct(F.regexp_extract_all(text, wanted_pattern, F.lit(1)))).alias("label")).join(last, "label")
    known = asked.groupBy("__n").agg(F.collect_list(F.struct("kind", "label", "at.doc", "at.slug", "at.title")).alias("__known"))

    @F.pandas_udf("string")
    def run(names: pd.Series, texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for n, t, rows in zip(names, texts, found, strict=True):
            rows = [] if rows is None else [dict(r) for r in rows]
            titles, labels = rst_md.lookups(rows)
            out.append(None if t is None else rst_md.rst_to_markdown(n, t, titles, labels, bases))
        return pd.Series(out, dtype="object")

    joined = docs.join(known, F.col(name) == F.col("__n"), "left")
    return joined.withColumn("markdown", run(name, text, "__known")).drop("__n", "__known")


def html_sections(html: Column | str, starts: str = "h1,h2", within: str = "") -> Column:
    """array<struct<ord, id, level, title, markdown>>: one page as many."""

    @F.pandas_udf("array<struct<ord:int,id:string,level:int,title:string,markdown:string>>")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else html_md.sections(v, starts, within) for v in values], dtype="object")

    return run(html)


def html_slices(html: Column | str, kinds: list[list[str]], dialect: str = "docbook") -> Column:
    """array<struct<ord, parent, trail, kind, anchor, title, anchors, markdown>>: one page as a tree of documents."""

    @F.pandas_udf("array<struct<ord:int,parent:int,trail:array<string>,kind:string,anchor:string,title:string,anchors:array<string>,markdown:string>>")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else html_md.slices(v, kinds, dialect) for v in values], dtype="object")

    return run(html)


def html_definitions(html: Column | str) -> Column:
    @F.pandas_udf("array<struct<name:string,markdown:string>>")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else html_md.definitions(v) for v in values], dtype="object")

    return run(html)


def unescaped(text: Column | str) -> Column:
    """All of HTML's named and numeric entities."""
    return _texts(html_lib.unescape)(text)


def yaml_to_json(text: Column | str) -> Column:
    """A YAML mapping as JSON; null where it is none or can't be parsed."""

    def one(value: str) -> str | None:
        try:
            tree = yaml.safe_load(value)
        except yaml.YAMLError:
            return None
        return json.dumps(tree, default=str, ensure_ascii=False) if isinstance(tree, dict) else None

    return _texts(one)(text)


def inflated(payload: Column | str) -> Column:
    """Base64 of zlib of UTF-8; null where it is damaged."""

    def one(value: str) -> str | None:
        try:
            return zlib.decompress(b64decode(value)).decode()
        except (ValueError, zlib.error):
            return None

    return _texts(one)(payload)


def decoded(data: Column | str) -> Column:
    """UTF-8 bytes as text, what is damaged replaced."""
    return _texts(lambda b: bytes(b).decode("utf-8", "replace"))(data)


_ENDPOINT = "path string, method string, tag string, summary string, operation_id string, deprecated boolean, file string"


def endpoint_documents(specs: DataFrame, key: str = "source", spec: str = "spec", default_tag: str = "Untagged", host: str | None = None) -> DataFrame:
    """(key, path, method, tag, summary, operation_id, deprecated, file, markdown): specs (JSON) exploded, each parsed once."""
    kind = specs.schema[key].dataType.simpleString()

    def run(frames):
        for frame in frames:
            rows = []
            for k, text in zip(frame[key], frame[spec], strict=True):
                try:
                    tree = json.loads(text) if text else None
                except ValueError:
                    tree = None
                if isinstance(tree, dict):
                    rows += [{key: k, **row} for row in spec_md.endpoint_documents(tree, default_tag, host)]
            yield pd.DataFrame(rows, columns=[key, *[c.split()[0] for c in _ENDPOINT.split(", ")], "markdown"])

    return specs.select(key, spec).mapInPandas(run, f"`{key}` {kind}, {_ENDPOINT}, markdown string")


def postman_documents(specs: DataFrame, key: str = "source", spec: str = "spec") -> DataFrame:
    kind = specs.schema[key].dataType.simpleString()

    def run(frames):
        for frame in frames:
            rows = [{key: k, **row} for k, text in zip(frame[key], frame[spec], strict=True) if text for row in spec_md.postman_rows(json.loads(text))]
            yield pd.DataFrame(rows, columns=[key, "folder", "name", "method", "url", "markdown"])

    return specs.select(key, spec).mapInPandas(run, f"`{key}` {kind}, folder string, name string, method string, url string, markdown string")


def schema_type_text(schema: Column | str, spec: Column | str, max_depth: int = 1) -> Column:
    @F.pandas_udf("string")
    def run(schemas: pd.Series, specs: pd.Series) -> pd.Series:
        parsed: dict[str, dict] = {}
        return pd.Series([None if s is None else spec_md.type_text(json.loads(s), parsed.setdefault(t, json.loads(t or "{}")), max_depth=max_depth) for s, t in zip(schemas, specs, strict=True)], dtype="object")

    return run(schema, spec)


def spec_format(spec: Column | str) -> Column:
    def one(text: str) -> str:
        try:
            return spec_md.spec_format(json.loads(text))
        except ValueError:
            return "unknown"

    return _texts(one)(spec)


#: Base64 of a zlib stream, as bundles carry descriptions: such a stream begins with the byte 0x78.
_PACKED = r"""["'](e[A-Za-z0-9+/]{19,}={0,2})["']"""


def packed_description(script: Column | str) -> Column:
    """The description that a bundle's chunk carries as Base64 of zlib; null where it has none."""
    return inflated(F.nullif(F.regexp_extract(script, _PACKED, 1), F.lit("")))


def body_kind(body: Column | str) -> Column:
    """What a body is, by what stands in it: openapi, swagger, postman, vendor, protocol, packed (a description in a script), compiled (MDX), html, mdx, markdown or empty.

    Descriptions may be JSON or YAML. What else JSON or a script may be is json or script.
    """
    c = F.col(body) if isinstance(body, str) else body
    trimmed = F.ltrim(F.regexp_replace(c, r"^[\s\uFEFF]+", ""))
    told = F.when(F.rlike(trimmed, F.lit(r"^[{\[]")), spec_format(c)).when(F.rlike(trimmed, F.lit(r"(?m)^(?:openapi|swagger):\s*\S")), spec_format(yaml_to_json(c)))
    script = F.rlike(trimmed, F.lit(r"(?s)^(?:\"use strict\"|\(?self|import\b.{0,400}_jsx|var |const |let |function |/\*)"))
    return (
        F.when(c.isNull() | (trimmed == ""), "empty").when(told.isNotNull() & (told != "unknown"), told).when(F.rlike(trimmed, F.lit(r"^[{\[]")) & F.try_parse_json(c).isNotNull(), "json")
        .when(F.rlike(trimmed, F.lit(r"(?i)^<(?:!doctype|html|head|body|main|article|div|\?xml)")), "html").when(script & F.rlike(c, F.lit(_PACKED)), "packed")
        .when(F.rlike(c, F.lit(r"_createMdxContent|MDXContent")), "compiled").when(script, "script").when(F.rlike(c, F.lit(r"(?m)^(?:import|export)\s|<[A-Z]\w*[\s/>]")), "mdx").otherwise("markdown"))


def _trees(convert: Callable, kind: str = "string") -> Callable[..., Column]:
    """Of JSON texts; null where they can't be parsed."""

    def one(text: str):
        try:
            return convert(json.loads(text))
        except ValueError:
            return None

    return _texts(one, kind)


def canonical_json(text: Column | str) -> Column:
    """JSON with sorted keys, indented, the same for equal values."""
    return _trees(spec_md.canonical_json)(text)


def found_object(text: Column | str, field: str, wanted: str) -> Column:
    """The first object inside a JSON text whose field is wanted, as JSON with sorted keys."""

    def one(tree) -> str | None:
        found = spec_md.find_object(tree, field, wanted)
        return None if found is None else json.dumps(found, sort_keys=True, ensure_ascii=False)

    return _trees(one)(text)


def clean_description(text: Column | str, inline: bool = False) -> Column:
    return _texts(lambda t: spec_md.clean_text(t, inline=inline))(text)


def one_line(text: Column | str) -> Column:
    """A JSON string, or an object with its text in content, as one line."""
    return _trees(spec_md.one_line)(text)


def operation_policies(spec: Column | str) -> Column:
    """map of `METHOD path` to the policies and the scopes of each operation of a description."""

    def one(tree: dict) -> dict:
        found = {}
        for path, item in tree.get("paths", {}).items():
            for method, operation in item.items():
                if method in spec_md.METHODS:
                    found[f"{method.upper()} {path}"] = [*spec_md.policies(operation, tree), *(f"scope:{s}" for s in spec_md.scopes(operation, tree))]
        return found

    return _trees(one, "map<string,array<string>>")(spec)


def vendor_document(text: Column | str) -> Column:
    return _trees(spec_md.vendor_document)(text)


def protocol_documents(specs: DataFrame, key: str = "source", spec: str = "spec") -> DataFrame:
    """(key, file, markdown) of protocol descriptions."""
    files = _trees(lambda tree: spec_md.protocol_documents(tree), "map<string,string>")(spec)
    return specs.select(key, F.explode(files).alias("file", "markdown"))


# Generators that need no Python.

def _operations(specs: DataFrame, key: str, spec: str) -> DataFrame:
    """(key, path, path_item, method, item) of every operation, by variants."""
    tvf = specs.sparkSession.tvf
    parsed = specs.select(key, F.try_parse_json(spec).alias("__v")).filter("__v IS NOT NULL")
    paths = parsed.lateralJoin(tvf.variant_explode(F.try_variant_get(F.col("__v").outer(), "$.paths", "variant"))).select(key, F.col("key").alias("path"), F.col("value").alias("path_item"))
    return paths.lateralJoin(tvf.variant_explode(F.col("path_item").outer())).select(key, "path", "path_item", F.col("key").alias("method"), F.col("value").alias("item")).filter(F.col("method").isin(*spec_md.METHODS))


def exploded_endpoints(specs: DataFrame, key: str = "source", spec: str = "spec", default_tag: str = "Untagged") -> DataFrame:
    """(key, path, method, tag, summary) by variants: paths, then methods, then tags, all in the JVM."""
    rows = _operations(specs, key, spec)
    tags = F.try_variant_get("item", "$.tags", "array<string>")
    full = F.when(F.coalesce(F.size(tags), F.lit(0)) > 0, tags).otherwise(F.array(F.lit(default_tag)))
    return rows.select(key, "path", "method", F.explode(full).alias("tag"), F.try_variant_get("item", "$.summary", "string").alias("summary"))


def all_parameters(specs: DataFrame, key: str = "source", spec: str = "spec") -> DataFrame:
    """(key, path, method, name, place): parameters of the path before those of the operation."""
    kind = "array<struct<name:string,in:string>>"
    none = F.array().cast(kind)
    both = F.concat(*[F.coalesce(F.try_variant_get(c, "$.parameters", kind), none) for c in ("path_item", "item")])
    rows = _operations(specs, key, spec).select(key, "path", "method", F.posexplode(both).alias("ord", "p"))
    return rows.select(key, "path", "method", "ord", F.col("p.name").alias("name"), F.col("p.in").alias("place"))
