import re

from flowframe.llm.html_text import html_text, page_text


def test_blocks_and_inline():
    assert page_text("<p>One<p>Two <b>bold</b>er  word<div>block</div>tail") == "One\n\nTwo bolder word\n\nblock\ntail"
    assert page_text("a<br>b<hr>c") == "a\nb\n---\nc"
    assert page_text("<h1>T</h1>x<blockquote>q<p>r</blockquote>") == "T\n\nx\n\n  q\n\n  r"


def test_lists():
    assert page_text("<ul><li>a<li>b<ol start=3><li>x</li><li>y</ol></ul>") == "- a\n- b\n  3. x\n  4. y"
    assert page_text("<dl><dt>k<dd>v</dl>") == "k\nv"


def test_tables_are_aligned():
    source = "<table><caption>C</caption><tr><th>Name<th>N<tbody><tr><td>apple<td>3<tr><td>kiwi<br>green<td>10</table>"
    assert page_text(source) == "C\nName  | N\napple | 3\nkiwi  | 10\ngreen |"
    assert page_text("<table><td>a<td>b<tr>x<td>c</table>") == "x\na | b\nc"
    assert page_text("<table><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>") == "wide |   | z\na    | b | c"


def test_what_a_browser_hides():
    source = (
        "<head><title>t</title><style>p{}</style></head><script>'</p>'</script><!-- c --><p hidden>no</p>"
        "<p style='display: none'>no</p><i style=visibility:hidden>no</i><template>no</template><dialog>no</dialog>"
        "<noscript>no</noscript><p>yes &amp; &copy; &#x41;<!-- open"
    )
    assert page_text(source) == "yes & © A"


def test_a_head_without_its_end_tag_hides_nothing():
    assert page_text("<html><head><title>T</title><body><p>Hello</p></body></html>") == "Hello"
    assert page_text("<head><meta charset=utf-8><link rel=x><style>p{}</style>\n<div>a</div>b") == "a\nb"
    assert page_text("<head><title>T</title> text <b>c</b>") == "text c"
    assert page_text("<head><noscript><img></noscript><template><p>no</p></template><!-- c --><p>yes") == "yes"
    assert page_text("<head><noscript><link><body>yes") == "yes"
    assert page_text("<html><head><title>T</title></html>") == ""


def test_preformatted():
    assert page_text("x<pre>\n a\n   b &lt;c&gt;\n</pre>y") == "x\n\n a\n   b <c>\n\ny"


def test_broken_markup():
    assert page_text("<p>a</div></p>b<p>c <a href='x") == "a\n\nb\n\nc"
    assert page_text("</b></table>x <3 y & z &am") == "x <3 y & z &am"
    assert page_text("") == page_text(None) == page_text("<br>") == ""
    assert page_text("plain\n text") == "plain text"


def test_stray_quotes_stay_in_their_tag():
    assert page_text('<table><tr><td width=100%">Cell 1</td><td width=100%">Cell 2</td></table>') == "Cell 1 | Cell 2"
    assert page_text('<a href="x"">link</a> and <a href="y">more</a>') == "link and more"
    assert page_text("<p class=it's>it's fine</p>") == "it's fine"
    assert page_text("""<p " ' a='>' b=">" c = "x"d=e/>one<p title="it's">two<p a="x>three""") == "one\n\ntwo\n\nthree"
    assert page_text('<i style="a" hidden>no</i><i title=hidden">yes</i><i/hidden/>no</i>') == "yes"
    assert page_text("yes <a " * 50_000) == "yes"


def test_depth_and_length_do_not_crash():
    assert page_text("<div>" * 30_000 + "hi") == "hi"
    assert page_text("<ul><li>" * 2_000 + "hi").strip(" -\n") == "hi"
    assert page_text("<table><tr><td>" * 2_000 + "hi").endswith("hi")
    assert page_text("<p>" + "word " * 200_000).count("word") == 200_000
    assert page_text("<" * 20_000 + "x") is not None


def test_rules_hold_at_any_depth():
    for deep in ("<font>" * 200, "<div>" * 5_000, "<b><span><a>" * 500):
        for hiding in ("<p hidden>", "<i style=display:none>", "<noscript>", "<select>", "<template>", "<svg>"):
            tag = hiding.strip("<>").split()[0]
            assert page_text(f"{deep}a {hiding}no</{tag}> b").split() == ["a", "b"]
        assert page_text(f"{deep}<ul><li>a<li>b</ul>") == "- a\n- b"
        assert page_text(f"{deep}<pre>a\n  b</pre>") == "a\n  b"
        assert page_text(f"{deep}<table><tr><td>aa<td>b<tr><td>c<td>d</table>") == "aa | b\nc  | d"
    assert page_text("<blockquote>" * 500 + "hi") == "  " * 500 + "hi"
    assert page_text("<pre>" + "<b>" * 5_000 + "a\n b") == "a\n b"
    # Searches of the stack do not walk it.
    assert page_text("<p><button>" + "<span>" * 50_000 + "<div></div><td></i>" * 50_000 + "hi").endswith("hi")


def test_spans():
    rows = "<tr><td rowspan=3>a<td>b<td>c<tr><td>d<td rowspan=2>e<tr><td>f<tr><td>g<td>h<td>i"
    assert page_text(f"<table>{rows}</table>") == "a | b | c\n  | d | e\n  | f |\ng | h | i"
    assert page_text("<table><tbody><tr><td rowspan=9>a<td>b<tbody><tr><td>c<td>d</table>") == "a | b\nc | d"
    assert page_text("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>") == "a | b\n  | c\n  | d"
    assert page_text("<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c<tr><td>d<td>e<td>f</table>") == "a |   | b\n  |   | c\nd | e | f"
    wide = "<table><tr><td colspan=150>w<td>z<tr>" + "<td>x" * 150 + "<td>y</table>"
    first, second = page_text(wide).split("\n")
    assert first.index("z") == second.index("y")
    assert page_text("<table><tr><td colspan=99999999>w<tr><td>a<td>b</table>") == "w |\na | b"


def test_blank_lines_of_items():
    assert page_text("<ul><li>a<pre>x\n\n  y</pre><li>b</ul>") == "- a\n  x\n\n    y\n- b"
    assert page_text("<ul><li><ul><li><pre>x\n\ny</pre></ul></ul>") == "- - x\n\n    y"
    assert page_text("<ul><li>a<br><br>b<li><p>c<p>d</ul>") == "- a\n\n  b\n- c\n  d"


def test_raw_text_that_is_shown():
    assert page_text("a<xmp><b>x</b> &amp;\n y</xmp>b") == "a\n\n<b>x</b> &amp;\n y\n\nb"
    assert page_text("a<plaintext><p>b</plaintext>\nc") == "a\n\n<p>b</plaintext>\nc"
    assert page_text("a<textarea>\nx &amp; <b>\n y</textarea>b") == "a\nx & <b>\n y\nb"
    assert page_text("a<textarea hidden>no</textarea> b<xmp style='display:none'>no</xmp>") == "a b"


def test_drawings():
    assert page_text("a <svg width='1' /> b <math/> c") == "a b c"
    assert page_text("a<svg><style/><path d=x /><g/><title>t</title><defs><text>no</text></defs>no<text>x <tspan>y</tspan></text></svg>b") == "a\nx y\nb"
    assert page_text("<svg><foreignObject><div/>in</div></foreignObject><text>t</text></svg>") == "in\nt"
    assert page_text("a<svg><path d=x><p>b") == "a\n\nb"
    assert page_text("<div/>a<svg width=1/>no</svg>") == "a"


def test_rows_pass(spark):
    df = spark.createDataFrame([(1, "<p>a", "t"), (1, "<p>a", "t"), (None, None, None)], "page_id long, html string, TEXT string")
    out = html_text(df)
    assert out.columns == ["page_id", "text"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "a"), (1, "a"), (None, "")]
    assert html_text(df.filter("false")).collect() == []


def test_no_visible_word_is_lost(spark):
    """Brute force on the test pages: all words outside hidden elements and markup, in order."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html")
    texts = {r.page_id: r.text for r in html_text(pages).collect()}
    for page_id, source in pages.collect():
        plain = re.sub(r"(?s)<!--.*?-->|<(head|script|style|title)\b.*?</\1>", " ", source)
        plain = re.sub(r"<[^<>]*(>|$)", " ", plain)
        import html

        words = re.sub(r"\s+", "", html.unescape(plain))
        got = re.sub(r"(?m)^\s*- ", "", texts[page_id])
        assert re.sub(r"\s+", "", got) == words, page_id


def test_styles_are_read_by_declaration():
    for style in ("--display:none", "background:url(x?display:none)", "display:none;display:block", "content:'display:none'", "display:none !wrong",
                  "display:block!important;display:none", "/* display:none */", "visibility:hidden;visibility:visible", "x-display:none"):
        assert page_text(f'<p style="{style}">yes</p>') == "yes", style
    for style in ("color:red;DISPLAY : None", "display:block;display:none", "display:none!important;display:block", "width:1px;;display:/**/none;", "display:none"):
        assert page_text(f'<p style="{style}">no</p>') == "", style


def test_visibility_is_inherited_and_can_come_back():
    source = "<div style=visibility:hidden>no <b>no <i style=visibility:visible>yes</i></b><hr><textarea>no</textarea><input value=no></div>z"
    assert page_text(source) == "yes\nz"
    assert page_text("<table><tr><td style='visibility:hidden'>aa<td>b<tr><td>c<td>d</table>") == "  | b\nc | d"
    assert page_text("<ol><li style='visibility:hidden'>a<li>b</ol>") == "2. b"


def test_closed_details_show_their_summary():
    assert page_text("<details>no<summary>S</summary><p>no</p></details>x") == "S\nx"
    assert page_text("<details open><summary>S</summary>yes</details>") == "S\nyes"
    assert page_text("<details>no</details>") == ""


def test_formulas_and_fields():
    assert page_text("a <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> b") == "a x=2 b"
    assert page_text("<select><option>a<option selected>b<option>c</select>!") == "b !"
    assert page_text("<select><option disabled>a<option>b</select>") == "b" and page_text("<select></select>") == ""
    assert page_text("<select multiple><optgroup label=g><option>a<option label=L>b</optgroup></select>") == "a L"
    assert page_text("<input type=submit value='Go on'><input value=t><input type=hidden value=no><input type=password value=no>") == "Go on t"


def test_list_marks():
    assert page_text("<ol><li value=5>a<li>b<li value=-2>c</ol>") == "5. a\n6. b\n-2. c"
    assert page_text("<ol start=-1><li>a<li>b<li>c</ol>") == "-1. a\n0. b\n1. c"
    assert page_text("<ol reversed><li>a<li>b<li>c</ol>") == "3. a\n2. b\n1. c"
    assert page_text("<ol type=a start=26><li>x<li>y<li type=I>z</ol>") == "z. x\naa. y\nXXVIII. z"
    assert page_text("<ol type=i start=4><li>x<li>y</ol><ol type=A><li>x</ol>") == "iv. x\nv. y\n\nA. x"
    assert page_text("<ol type=i><li value=0>x<li value=4000>y</ol>") == "0. x\n4000. y"


def test_wide_characters_and_marks_line_up():
    assert page_text("<table><tr><td>日本<td>1<tr><td>abc<td>2<tr><td>e\u0301<td>3</table>") == "日本 | 1\nabc  | 2\ne\u0301    | 3"
