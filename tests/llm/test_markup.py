import pytest

from tessera.llm import markup as mk

MARKED = {
    "html": ["<b>5</b><br>", "a&#160;b", "x &amp; y", "<!-- c -->x", "end.</font>", "<FONT color=navy>1939."],
    "markdown": ["**Overview**\n\nx", "*Roads* cover", "_Drinking_ water", "### T", "Trade\n=====\n\nx", "see [a](/entry/2) now", "a.[^4]", "```\nx\n```", "`x`", "- a\n- b", "1. a\n2. b", "| a | b |\n|---|---:|\n| c | d |"],
    "wiki": ["[[Timber]] and", "'''Trade'''\nx", "the ''Trarfaii'' here", "== Trade ==\nx", "a{{citation needed}}", "[https://x.example Himia]", '{| class="plain"\n|-\n| a || b\n|}', "__NOTOC__ x", "** pumps, 40 lots"],
    "latex": ["\\textbf{Trade}\nx", "48\\% of", "$\\rho = P/A$", "$$r = \\frac{X}{M}$$", "\\[d = 1\\]", "1930\\cite{gaz}", "\\begin{itemize}\n\\item a\n\\end{itemize}", "1141\\,mm"],
}
PLAIN = [
    "", "   ", "5,000", "739972 [b]", "The tariff is $3 per sack, $5 per bale.", "Aid rose from $5 million to $7 million.", "1 < 2 <= 3 on page 4", "Growth stayed < 5 percent and inflation > 7 percent.", "It spans 4 * 5 fields * per year.", "The figure* was later withdrawn. (*provisional)", "key is area_total_1994 throughout",
    "file field_value_1994_b.", "C:\\archive\\old.", "Rask & Sons", "\"teh harbour\" [sic] twice", "Note [3] gives", "rank it #3 in", "years {1990, 1995} were", "a -- now merged -- b", "A 5% | B 6% | C", "A\nB\tC", "- ", "-", "Depth > 40 m", "«A / B» 5; “C”", "x | | y", "N.A.",
]


@pytest.mark.parametrize("kind, text", [(k, t) for k, ts in MARKED.items() for t in ts])
def test_found(kind, text):
    assert kind in mk.formats(text)
    assert kind in mk.clean(text)[2]


@pytest.mark.parametrize("text", PLAIN)
def test_plain(text):
    assert mk.clean(text) == (text.strip(), [mk.Block("paragraph", 0, text.strip())] if text.strip() else [], [])


def test_structure_is_kept():
    page = "<h2>Trade</h2><p>Ore &amp; tea. See <a href='x'>Himia</a>.</p><ol><li>tea, 3</li><li>ore</li></ol><table><tr><th>A</th><td>1</td></tr><tr><th>B</th><td>2</td></tr></table><pre><code>a = b\n  c</code></pre><p>x</p><script>no()</script>"
    text, blocks, _ = mk.clean(page)
    assert text == "Trade\n\nOre & tea. See Himia.\n\n1. tea, 3\n2. ore\n\nA\t1\nB\t2\n\n    a = b\n      c\n\nx"
    assert [b.kind for b in blocks] == ["heading", "paragraph", "numbered", "numbered", "row", "row", "code", "paragraph"]
    tex = mk.clean("\\section{Power}\nAt 5\\% now.\n\\begin{tabular}{lr}\nA & 1 \\\\\nB & 2\n\\end{tabular}\n\\begin{equation}g = \\frac{B - D}{1000}\\end{equation}\n\\verb|x := y|")
    assert [b.kind for b in tex[1]] == ["heading", "paragraph", "row", "row", "formula", "code"] and "(B - D) / (1000)" in tex[0] and "5% now" in tex[0]
    wiki = mk.clean("== Law ==\nText.<ref>{{cite|no=1}}</ref>\n{| class=\"x\"\n|-\n| A || 1\n|}\n* one\n* two\nSee [[B|the entry]].")
    assert [b.kind for b in wiki[1]] == ["heading", "paragraph", "row", "item", "item", "paragraph"] and "cite" not in wiki[0] and "the entry" in wiki[0]


def test_chrome_is_dropped_and_prose_kept():
    nav = "".join(f"<li><a href='/{k}'>p{k}</a></li>" for k in range(12))
    page = f"<nav><ul>{nav}</ul></nav><p>{'A long sentence, with commas, about the harbour. ' * 8}</p><p>See <a>Himia</a>, please, for more, and more.</p>"
    text = mk.clean(page)[0]
    assert "harbour" in text and "Himia" in text and "p7" not in text


def test_scores_follow_paths():
    nodes = [mk.Node(("p",), "Long text, with points, and more. " * 5, k) for k in range(6)] + [mk.Node(("div", "li", "a"), "go", 10 + k) for k in range(6)]
    scores = mk.path_scores(mk.units(nodes))
    assert min(scores[:5]) > max(scores[6:]) == 0


#: Menus and footers without any element named for them; their words must go, those of the prose stay.
PAGES = {
    "menu of divisions": "<div>" + "".join(f"<div><a href='/{x}'>{x}</a></div>" for x in ("menuone", "menutwo", "menuthree")) + "</div><div>Roads cover 910 km, of which 73 percent are paved. Two rail lines meet at Poumia.</div>",
    "footer in cells": "<p>Roads cover 910 km, of which 73 percent are paved. Two rail lines meet at Poumia, where barges unload.</p><table><tr><td><a>menuone</a></td><td><a>menutwo</a></td></tr></table>",
    "list in markdown": "* [menuone](/a)\n* [menutwo](/b)\n* [menuthree](/c)\n\nRoads cover 910 km, of which 73 percent are paved. Two rail lines meet at Poumia.",
    "section of links": "<h2>Roads</h2><p>Roads cover 910 km, of which 73 percent are paved.</p><h2>menuhead</h2><ul><li><a>menuone</a></li><li><a>menutwo</a></li></ul>",
}


@pytest.mark.parametrize("name", PAGES)
def test_scores_decide(name, monkeypatch):
    """The scores drop what no tag name gives away; without them (all alike) it stays."""
    text = mk.clean(PAGES[name])[0]
    assert "menu" not in text and "73 percent" in text
    monkeypatch.setattr(mk, "path_scores", lambda found, spread=1.0: [1.0] * len(found))
    assert "menuone" in mk.clean(PAGES[name])[0]


def test_structure_stays_whatever_its_score():
    page = "<h2>Trade</h2><p>" + "A long sentence, with commas, about the harbour. " * 8 + "</p><ul><li>wool</li><li>tea</li></ul><table><tr><td>a</td><td>1</td></tr></table><pre>x = 1</pre><i>d</i> = (P) / A"
    assert [b.kind for b in mk.clean(page)[1]] == ["heading", "paragraph", "item", "item", "row", "code", "formula"]


@pytest.mark.parametrize("text, clean, kinds", [
    ("## Power supply\n\nRain fell.", "Power supply\n\nRain fell.", ["heading", "paragraph"]), ("**Trade**\n\nWool is sold.", "Trade\n\nWool is sold.", ["heading", "paragraph"]),
    ("**Roads** cover 5 km.", "Roads cover 5 km.", ["paragraph"]), ("* wool\n** tea", "- wool\n- tea", ["item", "item"]), ("# wool\n## tea", "1. wool\n2. tea", ["numbered", "numbered"]),
])
def test_headings_and_strong_lines_are_no_wiki_lists(text, clean, kinds):
    found = mk.clean(text)
    assert found[0] == clean and [b.kind for b in found[1]] == kinds


@pytest.mark.parametrize("text", ["a<wbr>b", "<ruby>x<rt>y</rt></ruby>", "about \\pm 5", "at 20 \\circ north", "a<br>b", "a &amp; b", "__NOTOC__ a", "x [^1] y", "<!-- note --> a"])
def test_paths_or_changed_text_give_markup_away(text):
    assert mk.has_paths(text)
    assert not mk.has_paths("a plain text, 5 < 6 & 7") and not mk.has_paths("")


def test_found_texts_come_through_the_scores(monkeypatch):
    """The verdict is taken from the nodes that the scores select: scores are made, and their selection is what is judged."""
    calls, scores = [], mk.path_scores
    monkeypatch.setattr(mk, "path_scores", lambda found, spread=1.0: calls.append(len(found)) or scores(found, spread))
    for page in PAGES.values():
        assert mk.has_paths(page)
    assert len(calls) == len(PAGES) and min(calls) > 1
    page = PAGES["menu of divisions"]
    assert not any("menu" in n.text for n in mk.content(mk.walk(page)[0]))
    monkeypatch.setattr(mk, "content", lambda nodes: [mk.Node((), page, 0)])
    assert not mk.has_paths(page)


@pytest.mark.parametrize("text, clean", [
    ("Roads cover 5 km.\n```", "Roads cover 5 km."), ("Roads cover 5 km.\n~~~sql", "Roads cover 5 km. sql"), ("{| Roads cover 5 km.", "Roads cover 5 km."),
    ("<!-- <p>Roads cover 5 km.", "Roads cover 5 km."), ("<!-- a -->Roads <!--<b>cover 5 km.", "Roads cover 5 km."), ("<!-->Roads <b>cover</b> 5 km.", "Roads cover 5 km."),
    ("|---|---|\n| Roads | 5 km |", "Roads\t5 km"), ("Growth < 5 percent\n---\nRoads.", "Growth < 5 percent\n\nRoads."),
])
def test_unfinished_markup_is_found_and_loses_no_words(text, clean):
    assert mk.has_paths(text) and mk.clean(text)[0] == clean


def test_broken_markup_and_long_text():
    for text in ("<b><i>x</b></i>", "</div></p>y", "<ul><LI>a<LI>b</ul>", "{{ {{a}} b", "\\begin{itemize} \\item a", "[[a", "**" * 50, "<" * 200, "<table><tr><td>a<td>b<tr><td>c</table>"):
        mk.clean(text)
    text, _, kinds = mk.clean("<p>" + "word " * 100_000 + "</p>")
    assert kinds == ["html"] and len(text.split()) == 100_000


def test_columns(spark):
    df = spark.createDataFrame([(1, "<b>x</b>", None, "c"), (2, None, None, "c"), (3, "plain", "a &amp; b", "c"), (4, "", "", "c"), (5, "5 [b]", None, "c")], "field_value_id long, raw_text string, raw_markup string, clean_text string")
    assert sorted(r[0] for r in mk.marked_up(df, "raw_text", "raw_markup").select("field_value_id").collect()) == [1, 3]
    out = {r.field_value_id: (r.x_clean_text, len(r.x_blocks), r.x_formats) for r in mk.cleaned(df, "raw_text", "x_").collect()}
    assert out == {1: ("x", 1, ["html"]), 2: (None, 0, []), 3: ("plain", 1, []), 4: ("", 0, []), 5: ("5 [b]", 1, [])}
    assert mk.cleaned(df.where("false"), "raw_text").count() == mk.marked_up(df.where("false"), "raw_text").count() == 0


def test_hostile_texts_take_linear_time():
    import time

    for part in ("**a ", "''a ", "\\[a ", "[[a ", "{{a ", "<b>", "<ul><li>", "\\begin{itemize} ", "$a ", "`a ", "(a](", "&lt;b&gt;"):
        begun = time.perf_counter()
        mk.clean(part * (60_000 // len(part)))
        assert time.perf_counter() - begun < 10, part


def test_templates_show_arguments():
    assert mk.clean("Roads{{small|revised}} run {{convert|120|km|abbr=on}}.{{citation needed|date=May 2001}}{{cite web|x|title=y}}")[0] == "Roadsrevised run 120 km."
    assert mk.clean("a " + "{{small|" * 9 + "deep" + "}}" * 9)[0] == "a deep"
    assert mk.clean("\\textbf{\\emph{" * 4 + "deep" + "}}" * 4)[0] == "deep"


def test_every_kind_passes_the_prefilter(spark):
    texts = [t for ts in MARKED.values() for t in ts] + ["::text of note", ";:text of note"]
    assert all(mk.formats(t) for t in texts)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, t string")
    assert df.where(mk.may_hold_markup(df.t)).count() == len(texts) == mk.marked_up(df, "t").count()


def test_menu_of_a_short_page():
    menu = "<ul>" + "".join(f"<li><a href='/{x}'>{x}</a></li>" for x in ("Home", "Maps", "Data", "Help", "Login")) + "</ul>"
    prose = "Roads cover 910 km, of which 73 percent are paved. Two rail lines meet at Poumia, see {}."
    assert mk.clean(menu + f"<p>{prose.format('Himia')}</p>")[0] == prose.format("Himia")
    assert mk.clean(f"<p>{prose.format('<a>Himia</a>')}</p>")[0] == prose.format("Himia")
    assert mk.clean("<a href='/x'>Himia</a>")[0] == "Himia"
