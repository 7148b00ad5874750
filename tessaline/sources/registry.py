"""What is known of each source: how it is discovered and converted, what its change token is, and what a failure does."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class SourceSpec:
    name: str
    discovery: str  #: a function of sources.discover, or 'fixed'
    formats: tuple[str, ...]
    converter: str  #: a function of functions.convert, with the dialect after a colon
    url: str
    token: str = "sha256"  #: beside the content's hash
    failure: str = "page"  #: 'page': keep the page; 'scope': keep the scope; 'abort': change nothing
    policy: str = "once"
    least_rows: int = 0
    requires_auth: bool = False
    also: tuple[str, ...] = ()  #: where further parts start, if elsewhere; more parts of the last kind, if there are more
    within: str = ""  #: only URLs whose path begins so; a crawl without it stays below where it starts
    strip: str = ""  #: what output paths leave out at their beginning
    rules: tuple[tuple[str, str], ...] = ()  #: (pattern, replacement): the first that is found in a path makes the output path
    probe: bool = False  #: ask for validators (HEAD) before contents
    kinds: tuple[tuple[tuple[str, ...], ...], ...] = ()  #: for each part: classes of the documents inside one page, outermost first
    raw_base: str = ""  #: where files that an index names stand, if not beside it
    suffix: str = ""  #: what is put behind a page's URL to get its text


def _s(name: str, discovery: str, formats: str, converter: str, url: str, **more) -> SourceSpec:
    return SourceSpec(name, discovery, tuple(formats.split()), converter, url, **more)


_ROOT = r"^([^/]+)$"  # a page with no folder

#: The public documentation sources.
SOURCES: dict[str, SourceSpec] = {s.name: s for s in (
    _s("1password", "link_index+sitemap_urls", "markdown", "titled_page", "https://www.1password.dev/llms.txt", also=("https://www.1password.dev/sitemap.xml",), suffix=".md", rules=((_ROOT, "$1/index"),)),
    _s("anthropic", "link_index", "markdown mdx", "without_components", "https://code.claude.com/docs/llms.txt", strip="docs/en", rules=((_ROOT, "general/$1"),)),
    _s("arch", "wiki_articles", "wikitext", "wikitext_to_markdown", "https://wiki.archlinux.org/api.php?action=query&generator=allpages&gapnamespace=0&gapfilterredir=nonredirects&gaplimit=500&prop=revisions&rvprop=ids&format=json&formatversion=2", token="revision", failure="abort", policy="linear", strip="title"),
    _s("auth0", "concatenated_pages+link_index", "markdown", "concatenated_page+preamble", "https://auth0.com/docs/llms-full.txt", also=("https://auth0.com/docs/llms.txt",), strip="docs"),
    _s("authelia", "tree_files", "hugo json", "shortcodes_to_markdown", "https://api.github.com/repos/authelia/authelia/git/trees/master?recursive=1", token="fingerprint", failure="abort", raw_base="https://raw.githubusercontent.com/authelia/authelia/master", within="docs/content/", strip="authelia/authelia/master/docs/content"),
    _s("bitwarden", "fixed+embedded_object", "jekyll openapi", "jekyll_to_markdown+endpoint_documents", "https://raw.githubusercontent.com/bitwarden/help/master/_articles/miscellaneous/cli.md", failure="scope", also=("https://bitwarden.com/help/vault-management-api/",)),
    _s("circleci", "fixed", "openapi", "endpoint_documents", "https://circleci.com/api/v2/openapi.json", failure="abort"),
    _s("clickup", "fixed+fixed+sitemap_by_path", "openapi html", "endpoint_documents+endpoint_documents+html_to_markdown:readme", "https://developer.clickup.com/openapi/clickup-api-v2-reference.json", failure="scope", also=("https://developer.clickup.com/openapi/ClickUp_PUBLIC_API_V3.yaml", "https://developer.clickup.com/sitemap.xml")),
    _s("cloudflare", "fixed", "openapi", "endpoint_documents", "https://raw.githubusercontent.com/cloudflare/api-schemas/main/openapi.json", failure="abort"),
    _s("discord", "link_index+sitemap_urls", "markdown", "titled_page", "https://docs.discord.com/llms.txt", also=("https://docs.discord.com/sitemap.xml",), within="/developers/", strip="developers", suffix=".md", rules=((_ROOT, "_root/$1"),)),
    _s("filebrowser", "tree_files", "mkdocs", "mkdocs_to_markdown", "https://api.github.com/repos/filebrowser/filebrowser/git/trees/master?recursive=1", token="fingerprint", failure="abort", raw_base="https://raw.githubusercontent.com/filebrowser/filebrowser/master", within="www/docs/", strip="filebrowser/filebrowser/master/www/docs"),
    _s("google", "json_directory", "discovery", "canonical_json", "https://discovery.googleapis.com/discovery/v1/apis"),
    _s("google-cloud", "sitemap_tree", "html", "html_to_markdown:devsite", "https://docs.cloud.google.com/sitemap.xml", token="lastmod", policy="schedule"),
    _s("immich", "fixed+sitemap_by_path", "openapi html", "endpoint_documents+html_to_markdown:docusaurus", "https://docs.immich.app/openapi.json", also=("https://docs.immich.app/sitemap.xml",)),
    _s("kandji", "fixed", "postman", "postman_documents", "", failure="abort"),
    _s("keycloak", "sitemap_by_path", "html", "html_to_markdown:asciidoc", "https://www.keycloak.org/sitemap.xml"),
    _s("langfuse", "fixed+tree_files", "openapi-yaml mdx", "endpoint_documents+mdx_to_markdown", "https://cloud.langfuse.com/generated/api/openapi.yml", failure="scope", also=("https://api.github.com/repos/langfuse/langfuse-docs/git/trees/main?recursive=1",), raw_base="https://raw.githubusercontent.com/langfuse/langfuse-docs/refs/heads/main", strip="langfuse/langfuse-docs/refs/heads/main"),
    _s("nixos", "fixed", "html", "slices+slices+html_to_markdown:docbook", "https://nixos.org/manual/nixos/stable/", token="etag", failure="abort", also=("https://nixos.org/manual/nixos/stable/release-notes", "https://nixos.org/manual/nixos/stable/options"), kinds=((("preface", "part"), ("chapter", "appendix")), (("section",),)), strip="manual/nixos/stable"),
    _s("notion", "link_index", "markdown", "headed_page", "https://developers.notion.com/llms.txt", rules=((_ROOT, "$1/index"),)),
    _s("obs", "sphinx_names", "rst", "rst_to_markdown", "https://docs.obsproject.com/searchindex.js", raw_base="https://docs.obsproject.com/_sources", strip="_sources"),
    _s("obs-websocket", "fixed", "protocol", "protocol_documents", "https://raw.githubusercontent.com/obsproject/obs-websocket/master/docs/generated/protocol.json", failure="abort"),
    _s("okta", "fixed+fixed+fixed+sitemap_urls", "openapi-yaml html", "endpoint_documents+endpoint_documents+endpoint_documents+html_to_markdown:dita", "https://raw.githubusercontent.com/okta/okta-management-openapi-spec/master/dist/current/management-minimal.yaml", token="etag", failure="scope", probe=True, also=("https://raw.githubusercontent.com/okta/okta-management-openapi-spec/master/dist/current/oauth-minimal.yaml", "https://raw.githubusercontent.com/okta/okta-management-openapi-spec/master/dist/current/idp-minimal.yaml", "https://help.okta.com/oie/en-us/sitemap.xml")),
    _s("ollama", "link_index", "markdown", "bannered_page", "https://docs.ollama.com/llms.txt"),
    _s("openai", "link_index", "markdown", "sourced_page", "https://developers.openai.com/llms.txt", token="etag"),
    _s("opencode", "sidebar+english_paths", "mdx", "mdx_to_markdown", "https://opencode.ai/docs/", also=("https://opencode.ai/sitemap.xml",), within="/docs/", strip="docs", suffix=".md"),
    _s("oracle", "json_directory", "openapi-yaml", "endpoint_documents", "https://docs.oracle.com/en-us/iaas/api/specs/index.json", token="spec_names", failure="scope"),
    _s("outline", "fixed", "openapi", "endpoint_documents", "https://raw.githubusercontent.com/outline/openapi/main/spec3.json", failure="abort"),
    _s("qwen-code", "tree_files", "markdown mdx", "mdx_to_markdown", "https://api.github.com/repos/QwenLM/qwen-code-docs/git/trees/main?recursive=1", token="fingerprint", failure="abort", raw_base="https://raw.githubusercontent.com/QwenLM/qwen-code-docs/main", within="website/content/en/", strip="QwenLM/qwen-code-docs/main/website/content/en"),
    _s("radarr", "fixed", "openapi", "endpoint_documents", "https://raw.githubusercontent.com/Radarr/Radarr/develop/src/Radarr.Api.V3/openapi.json", failure="abort"),
    _s("rippling", "bundle_chain", "script openapi", "routed", "https://developer.rippling.com/documentation/rest-api", strip="documentation/rest-api", rules=((_ROOT, "overview/$1"),)),
    _s("sabnzbd", "fixed", "html", "html_to_markdown:wiki", "https://sabnzbd.org/wiki/configuration/5.0/api", failure="abort", least_rows=1),
    _s("sentinelone", "first_valid", "vendor openapi", "vendor_document+endpoint_documents", "", failure="abort", requires_auth=True),
    _s("sonarr", "fixed", "openapi", "endpoint_documents", "https://raw.githubusercontent.com/Sonarr/Sonarr/develop/src/Sonarr.Api.V3/openapi.json", failure="abort"),
    _s("spotify", "page_data+fixed", "compiled-mdx openapi-yaml", "compiled_to_markdown+endpoint_documents", "https://developer.spotify.com/documentation/web-api", token="etag+engine"),
    _s("terraform", "registry_documents", "markdown", "registry_document", "https://registry.terraform.io/v2/providers?page[size]=100", token="version+fingerprint", policy="budget"),
    _s("twitch", "reachable", "html", "html_to_markdown:jekyll", "https://dev.twitch.tv/docs/api", failure="abort", least_rows=100),
    _s("vikunja", "fixed", "swagger", "endpoint_documents", "https://try.vikunja.io/api/v1/docs.json", failure="abort"),
    _s("youtube", "landing_links", "html", "html_to_markdown:devsite", "https://developers.google.com/youtube/v3/docs", strip="youtube/v3/docs", rules=((_ROOT, "$1/index"),)),
)}


def select_sources(names: Iterable[str], known: Sequence[str] | None = None) -> list[str]:
    """Exact names, unique prefixes, numbers and ranges (`3-7`) of the sorted list, or `all`; each once, in the order asked."""
    known = sorted(SOURCES) if known is None else sorted(known)
    out: list[str] = []
    for name in names:
        if name == "all":
            found = [k for k in known if not (k in SOURCES and SOURCES[k].requires_auth)]
        elif name in known:
            found = [name]
        elif name.replace("-", "", 1).isdigit():
            lo, _, hi = name.partition("-")
            found = known[int(lo) - 1 : int(hi or lo)]
        else:
            found = [k for k in known if k.startswith(name)]
            if len(found) != 1:
                raise ValueError(f"{name!r} is {'ambiguous: ' + ', '.join(found) if found else 'no source'}")
        out += found
    return list(dict.fromkeys(out))


def listing(spark: SparkSession) -> DataFrame:
    """All known sources as rows."""
    rows = [(s.name, s.discovery, ",".join(s.formats), s.converter, s.url, s.token, s.failure, s.requires_auth) for s in SOURCES.values()]
    return spark.createDataFrame(rows, "name string, discovery string, formats string, converter string, url string, token string, failure string, requires_auth boolean")
