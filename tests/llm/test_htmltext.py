"""Rendering of visible text."""

import pytest

from pulsegrid.llm.htmltext import extract, report, visible_text


@pytest.mark.parametrize(
    "html,text",
    [
        (None, ""), ("", ""), ("plain  text", "plain text"), ("a<b>b</b> <i> c</i>", "ab c"),
        ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
        ("<h1>T</h1>x<h2>U</h2>", "T\n\nx\n\nU"), ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
        ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"), ("<ul><li><p>a<p>b</ul>", "- a\n\n  b"),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"), ("<pre> a\n  b\n\nc</pre>", " a\n  b\n\nc"),
        ("<table><tr><th>Name<th>N<tr><td>long name<td>1</table>", "Name       N\nlong name  1"),
        ("<table><tr><td>a<td>b<br>c<tr><td colspan=2>wide cell here</table>", "a  b\n   c\nwide cell here"),
        ("<table><caption>C</caption><tr><td>日本<td>x<tr><td>abcd<td>y</table>", "C\n日本  x\nabcd  y"),
        ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"),
        ("<script>x</script><style>p{}</style><template>t</template><!-- c -->v", "v"), ("<head><title>t</title></head><body>v", "v"), ("<title>t</title>v<p>w", "v\n\nw"),
        ("<p hidden>a</p><p style='display: none'>b</p><p style='visibility:hidden'>c</p>d", "d"),
        ("<style>.x, #y{display:none} b{visibility:hidden}</style><p class='a x'>1<p id=y>2<p>3<b>4</b>", "3"),
        ("<details>no<summary>yes</summary>no<p>no</details>z", "yes\nz"), ("<details open><summary>s</summary>body</details>", "s\nbody"),
        ("&copy;&nbsp;&lt;b&gt; &unknown; &#233;", "© <b> &unknown; é"), ("</p>x</div></b>", "x"), ("<div><p>a</div>b<p", "a\n\nb"), ("<select><option>a<option>b</select>", "a\nb"),
        ("<blockquote>q<p>r</blockquote>s", "    q\n\n    r\n\ns"),
    ],
)
def test_layout(html, text):
    assert visible_text(html) == text


def test_depth_and_length():
    assert visible_text("<div>" * 30_000 + "deep") == "deep"
    assert visible_text("<p>x" * 20_000).count("x") == 20_000
    assert "q" in visible_text("<table><tr><td>" * 200 + "q")


def test_tables(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    out = report(pages).collect()
    assert len(out) == pages.count() and all("<" not in r["text"][:1] for r in out) and not any("track(0)" in r["text"] for r in out)
    odd = spark.createDataFrame([(None, None, None, "own"), (1, "u", "<p>a", "own"), (1, "u", "<p>a", "own")], "page_id long, url string, html string, text string")
    assert [r["text"] for r in extract(odd, out="body").collect()] == ["own"] * 3 and sorted(r["body"] for r in extract(odd, out="body").collect()) == ["", "a", "a"]
    assert sorted(r["text"] for r in extract(odd).collect()) == ["", "a", "a"] and report(odd.limit(0)).count() == 0
