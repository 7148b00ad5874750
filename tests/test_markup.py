"""One rich document for each markup, written for these tests."""

from __future__ import annotations

import base64
import json
import zlib

import pytest
from pyspark.sql import functions as F

from tessaline.functions import compiled_mdx as J
from tessaline.functions import convert as V
from tessaline.functions import html_md as H
from tessaline.functions import mdx_md as M
from tessaline.functions import rst_md as R
from tessaline.functions import wiki_md as W

PAGE = """<html><head><title>Guide &amp; more | Site</title></head><body><div class="devsite-article-body"><h1>Guide</h1>
<p>A <strong>b</strong>, <em>c</em>, <code>d`e</code>, <a href="/x">rel</a>, <a href="//h.test/y">scheme</a><br>next <img alt="i" src="/i.png">
<aside class="caution"><p>Stop.</p><ul><li>one</li></ul></aside>
<ul><li>Top<ul><li>In</ul><li>Second<p>more</p></ul><ol start="3"><li>c<li>d</ol><blockquote><p>Q</blockquote>
<pre class="language-bash"><span>run</span> it
</pre><table><thead><tr><th>N<th>V</tr></thead><tr><td>a<td>x | y</table>
<table><tr><td colspan="2"><b>Group</b></td></tr><tr><td>f</td><td><ul><li>d</li></ul></td></tr></table>
<span class="material-icons">icon</span><script>s</script><dl><dt>T<dd>D</dl></div><p>outside</body></html>"""


def test_html_dialect_with_all_constructs():
    md = H.html_to_markdown(PAGE, "devsite", "https://h.test/d/p", "Guide")
    for part in ("# Guide\n", "A **b**, *c*, ``d`e``, [rel](https://h.test/x), [scheme](https://h.test/y)\nnext ![i](https://h.test/i.png)", "> Stop.\n>\n> - one", "- Top\n  - In\n- Second\n\n  more", "3. c\n4. d", "> Q", "```bash\nrun it\n```", "| N | V |\n| --- | --- |\n| a | x \\| y |", "**Group**\n\n- **f**\n  - d", "**T**\n\nD"):
        assert part in md, part
    assert md.count("# Guide") == 1 and "icon" not in md and "outside" not in md
    assert H.page_title(PAGE) == "Guide & more" and H.html_to_markdown("<p>x", "devsite") is None


@pytest.mark.parametrize(("dialect", "html", "want"), [
    ("readme", "<article><h2>A</h2><button>b</button><p>x</article><p>y", "## A\n\nx\n"),
    ("docusaurus", '<main><article><nav>n</nav><h1>A<a class="hash-link" href="#a">#</a></h1><div class="alert alert--warning">Hot</div></article></main>', "# A\n\n> **Warning:** Hot\n"),
    ("asciidoc", '<div id="content"><div class="admonitionblock note"><table><tr><td class="icon">N</td><td class="content">Mind</td></tr></table></div></div>', "> **Note:** Mind\n"),
    ("dita", '<div id="mc-main-content"><div class="coveo-x">c</div><div class="warning">W</div></div>', "> **Note:** W\n"),
    ("docbook", '<div class="chapter"><h2>Top</h2><div class="section"><h3>Sub</h3><pre class="programlisting nix">{ }</pre></div><table><tr><td>1</td><td>2</td></tr></table></div>', "## Top\n\n# Sub\n\n```nix\n{ }\n```\n\n| Col 1 | Col 2 |\n| --- | --- |\n| 1 | 2 |\n"),
    ("wiki", '<div class="wiki-content"><p>a<footer>f</footer></div>', "a\n"),
    ("jekyll", '<section class="text-content"><div class="language-json"><div><pre><code>{}</code></pre></div></div></section>', "```json\n{}\n```\n"),
])
def test_html_dialects(dialect, html, want):
    assert H.html_to_markdown(html, dialect) == want


def test_html_sections_and_definitions():
    found = H.sections('<h1 id="a">A</h1><p>x<h2>B</h2><p>y<h1>C</h1>')
    assert [(s["level"], s["id"], s["title"], s["markdown"]) for s in found] == [(1, "a", "A", "x\n"), (2, "", "B", "y\n"), (1, "", "C", "")]
    assert H.definitions("<dl><dt>o.p</dt><dd><p>text</dd><dt>q</dt></dl>") == [{"name": "o.p", "markdown": "text\n"}, {"name": "q", "markdown": ""}]


def test_wikitext():
    md = W.wikitext_to_markdown("""{{Lowercase title}}__NOTOC__<!-- c -->
== Head ==
'''b''' ''i'' {{ic|a {{!}} b}} {{Pkg|vim}} {{AUR|yay}} {{man|5|conf}} [[Page#Part|shown]] [[:Category:X]] [https://e.test E]<ref>r</ref>
{{Warning|1=Mind = this
and that}}
{{hc|/etc/x|<nowiki>k=v</nowiki>}}
# one
# two
#* in
: quoted
; Term : text
 old code
{| class="w"
! A !! B
|-
| style="x" | 1 || 2
|}
[[Category:Hidden]]""")
    for part in ("## Head", "**b** *i* `a | b` [vim](https://archlinux.org/packages/?q=vim) [yay](https://aur.archlinux.org/packages/yay) [conf(5)](https://man.archlinux.org/man/conf.5) [shown](https://wiki.archlinux.org/title/Page#Part)", "[E](https://e.test)", "> **Warning:** Mind = this\n> and that", "**`/etc/x`**", "```\nk=v\n```", "1. one\n2. two\n  - in", "> quoted", "**Term**\ntext", "```\nold code\n```", "| A | B |\n| --- | --- |\n| 1 | 2 |"):
        assert part in md, part
    assert "Hidden" not in md and "{{" not in md
    assert W.find_template("{{open", 0) == ("{{open", 6) and W.find_template("x", 0) == ("", 0)
    assert W.split_arguments("x|[[a|b]]|{{c|d}}") == ["x", "[[a|b]]", "{{c|d}}"] and W.categories("[[Category:A|x]] [[category:A]]") == ["A"]


def test_rst():
    text = """Title
=====

.. _lab:

Part
----

Some ``code`` and `site <https://e.test>`_, :doc:`other`, :ref:`lab`, :ref:`see <far>`,
:wiki:`W X` and :c:func:`~m.go`.

.. _ext: https://x.test

Use ext_ here::

   raw

.. function:: f(a)

   Does.

   :param int a: It.
   :return: That.

.. note::

   Mind.

.. code:: cpp

   int x;

- one
  more
- two
"""
    corpus = {"me": text, "other": "Other\n=====\n", "far": ".. _far:\n\nFar\n===\n"}
    titles, labels = R.lookups(dict(zip(("kind", "label", "doc", "slug", "title"), m, strict=True)) for n, t in corpus.items() for m in R.marks(n, t))
    assert titles == {"me": "Title", "other": "Other", "far": "Far"} and labels["lab"]["slug"] == "part"
    md = R.rst_to_markdown("me", text, titles, labels, {"wiki": "https://w.test/"})
    for part in ("# Title", "## Part", "Some `code` and [site](https://e.test), [Other](other.md), [Part](#part), [see](far.md#far), [W X](https://w.test/W X) and `go()`.", "Use [ext](https://x.test) here:\n\n```\nraw\n```", "**`f(a)`**", "- **int a**: It.", "- **Returns:** That.", "> [!NOTE]\n> Mind.", "```cpp\nint x;\n```", "- one more\n- two"):
        assert part in md, part
    assert R.toctrees(".. toctree::\n   :caption: C\n\n   A <a>\n   b\n") == [{"caption": "C", "entries": [("A", "a"), ("", "b")]}]


def test_mdx_keeps_code():
    md = M.mdx_to_markdown('import A from "a"\n\n<Tabs><Tab title="One">x</Tab></Tabs>\n:::tip[T]\nUse <code>c</code>\n```sh\n:::\n```\n:::\n\n```mdx\nimport B\n<B />\n```\n')
    assert "import A" not in md and "**One**" in md and "> [!TIP]\n> **T**\n> Use `c`\n> ```sh\n> :::\n> ```" in md and "```mdx\nimport B\n<B />\n```" in md
    assert M.jekyll_to_markdown("{% callout warning %}\nHot\n{% endcallout %}\n{% x %}a{{ y }}") == "> **Warning:** Hot\na\n"
    assert M.mkdocs_to_markdown('=== "A"\n\n    x\n\n!!! note "N"\n    y\n') == "**A**\n\nx\n\n> [!NOTE]\n> **N**\n> y\n"
    codes = M.Shortcodes({"misc": {"latest": "2"}}, lambda t: t + "!")
    assert codes.convert('{{< callout context="danger" title="T" >}}\nx\n{{< /callout >}}\nv{{< latest >}} [a](b) {{< odd >}}') == "> [!CAUTION]\n> **T**\n> x\nv2 [a](b!)\n" and codes.unknown == {"odd": 1}
    assert M.config_key({"type": "string", "default": "5m", "required": "no"}) == "*Type: `string` | Default: `5m` | Required: no*"


def test_compiled_mdx():
    script = r'function _createMdxContent(p){const _c={a:"a",...p.components};return _jsxs(_Fragment,{children:[_jsx("h2",{children:"H"}),_jsxs("ul",{children:[_jsx("li",{children:"[X] t"}),"\n"]}),_jsx(Banner,{color:"danger",children:_jsx("p",{children:"é\n"})}),_jsx(Odd,{n:-1.5,children:_jsx("pre",{children:_jsx("code",{className:"language-js",children:"a`b"})})})]})}'
    md, unknown = J.compiled_to_markdown(script)
    assert md == "## H\n\n- [x] t\n\n> [!CAUTION]\n> é\n\n```js\na`b\n```\n" and unknown == {"Odd": 1}
    assert J.compiled_to_markdown("const x = 1") == (None, {})
    with pytest.raises(J.CompiledError):
        J.parse_compiled("function _createMdxContent(p){return _jsx('p',{children:[1 2]})}")


def test_converters_as_columns(spark):
    df = spark.createDataFrame([(1, "<p>a <b>b</b>"), (2, None), (3, "")], "id int, html string")
    got = {r["id"]: r["md"] for r in df.select("id", V.html_to_markdown("html").alias("md")).collect()}
    assert got == {1: "a **b**\n", 2: None, 3: ""}
    payload = base64.b64encode(zlib.compress(b'{"a":1}')).decode()
    row = spark.createDataFrame([(payload, "a: [1, 2]", "- x", "&eacute;", bytearray(b"a\xff"))], "p string, y string, n string, e string, b binary").select(V.inflated("p"), V.yaml_to_json("y"), V.yaml_to_json("n"), V.unescaped("e"), V.decoded("b")).first()
    assert tuple(row) == ('{"a":1}', json.dumps({"a": [1, 2]}), None, "é", "a�")
    docs = spark.createDataFrame([("a", ".. _l:\n\nA\n=\n\nA\n==="), ("b", "B\n===\n\n:doc:`a` :ref:`l`\n")], "name string, text string")
    assert {r["name"]: r["markdown"] for r in V.rst_to_markdown(docs).collect()}["b"].startswith("# B")
    assert spark.range(1).select(V.compiled_to_markdown(F.lit("x"))["markdown"]).first()[0] is None


def test_notes_of_a_wiki_have_marks_and_links_in_them():
    made = lambda text: W.wikitext_to_markdown(text).strip()
    assert made("{{Note|See [[Some page#Part|here]] | or ''there'' and {{ic|a b}}.}}") == "> **Note:** See [here](https://wiki.archlinux.org/title/Some_page#Part) | or *there* and `a b`."
    assert made("{{Tip|1=x = '''y'''\n\n* z}}") == "> **Tip:** x = **y**\n>\n> * z" and made("{{Warning|}}") == "> **Warning**"
