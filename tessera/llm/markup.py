"""Markup residue in text: HTML, Markdown, wiki and LaTeX to clean text that keeps its structure.

1. Dialects: constructs of Markdown, wiki and LaTeX markup are found by patterns strict enough to leave prose alone
   (money, comparison signs, identifiers, paths, footnote stars, editors' brackets) and rewritten as elements.
2. Nodes: the elements are walked once; each text node has its root-to-leaf tag path.
3. Tag-path ratios: per path the text length and the punctuation per node are aggregated, less the share of the path's
   text that is linked, smoothed over the sequence of nodes, fused by their geometric mean and compared with a threshold
   taken from the document's own spread. Nodes below it are dropped, whatever their tags; lists, tables, code and
   formulas that aren't mostly links, and headings of kept content, stay.
   A kept node off the root path, or kept text that isn't the text as it was, means that the text holds markup.
4. Rendering: headings stand alone in their paragraph, list items begin with "- " or "1. ", table rows are tab-separated
   lines, code is indented by four blanks, formulas are linear; each is also listed in ``blocks`` with its kind.

Defined results: null gives null text, no blocks, no formats; empty and blank texts give themselves, trimmed. A text
without markup comes back trimmed as one paragraph block. Unclosed and stray tags never fail. Texts are read whole.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: element and command names --------------------------------------------------------------------------

TAGS = frozenset(
    "a abbr acronym address article aside b big blockquote body br button caption center cite code col colgroup dd del details dfn dir div dl dt em "
    "fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark math meta nav "
    "noscript nowiki object ol option p param pre q ref references s samp script section select small source span strike strong style sub summary sup svg "
    "table tbody td textarea tfoot th thead time title tr tt u ul var video audio gallery poem syntaxhighlight formula "
    "area base bdi bdo data dialog embed frame frameset hgroup marquee nobr noframes optgroup output picture rb rp rt rtc ruby template track wbr".split()
)
LATEX = frozenset(
    "part chapter section subsection subsubsection paragraph title author date textbf textit texttt textsc textsf textrm textsl textsuperscript textsubscript emph underline "
    "begin end item href url cite citep citet footnote footnotemark label ref eqref pageref caption includegraphics verb centering hline toprule midrule bottomrule maketitle "
    "documentclass usepackage newcommand frac dfrac tfrac sqrt sum int prod lim cdot times alpha beta gamma delta epsilon theta lambda mu pi rho sigma tau phi omega leq geq neq approx "
    "infty partial nabla ldots dots quad qquad mathrm mathbf text left right noindent newline linebreak par bf it tt em large small tiny multicolumn multirow input include bibliography "
    "pm mp circ degree cdots vdots ddots leqslant geqslant subseteq supseteq rightarrow leftarrow Rightarrow Leftarrow leftrightarrow mapsto forall exists emptyset zeta eta iota kappa nu xi chi psi upsilon "
    "varepsilon vartheta varphi Gamma Delta Theta Lambda Xi Pi Sigma Phi Psi Omega hbar ell overline widehat underbrace overbrace textdegree".split()
)
HEADINGS = {"h1": 1, "h2": 2, "h3": 3, "h4": 4, "h5": 5, "h6": 6}
BLOCKS = frozenset("address article aside blockquote body center dd div dl dt fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul caption formula syntaxhighlight poem".split())
SKIPPED = frozenset("script style head ref references noscript iframe svg object".split())
VOID = frozenset("br hr img input link meta col source param area base embed track wbr".split())

# ---- 1. detectors -----------------------------------------------------------------------------------------------------

_TAG = re.compile(r"</?([A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?/?>")
_ENTITY = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});")
_MD_HEADING = re.compile(r"^ {0,3}#{1,6}[ \t]+\S", re.M)
_MD_SETEXT = re.compile(r"^(?=[^\n]*\w)[^\n|]+\n(?:={3,}|-{3,})[ \t]*$", re.M)
_MD_STRONG = re.compile(r"\*\*(?=[^\s*])(?:[^*\n]|\*(?!\*))*(?<=[^\s*])\*\*|(?<!\w)__(?=[^\s_])[^_\n]*[^\s_]__(?!\w)")
_MD_EM = re.compile(r"(?<![\w*\\])\*(?=[^\s*])(?:[^*\n]*[^\s*\n])?\*(?![\w*])|(?<![\w\\])_(?=[^\s_])(?:[^_\n]*[^\s_\n])?_(?!\w)")
_MD_STRIKE = re.compile(r"~~(?=\S)[^~\n]+(?<=\S)~~")
_MD_FENCE = re.compile(r"^ {0,3}(```|~~~)", re.M)
_MD_CODE = re.compile(r"(?<!`)`(?!`)[^`\n]+`(?!`)|``[^\n]+?``")
_MD_LINK = re.compile(r"!?\[[^\[\]\n]*\]\([^()\s]*(?:\([^()\s]*\))?[^()\s]*(?:\s+\"[^\"\n]*\")?\)")
_MD_REFERENCE = re.compile(r"\[[^\[\]\n]+\]\[[^\[\]\n]*\]|^\[[^\[\]\n^]+\]:\s+\S+", re.M)
_MD_FOOTNOTE = re.compile(r"\[\^[^\[\]\s]+\]")
_MD_AUTOLINK = re.compile(r"<(?:https?://|mailto:)[^<>\s]+>")
_MD_TABLE = re.compile(r"^[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*$", re.M)
_MD_RULE = re.compile(r"\n[ \t]*\n {0,3}(?:(?:\*[ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})\n")
_BULLETS = re.compile(r"(?:^[ \t]*[-*+][ \t]+\S[^\n]*(?:\n|\Z)){2,}", re.M)
_NUMBERS = re.compile(r"^[ \t]*1[.)][ \t]+\S[^\n]*\n[ \t]*2[.)][ \t]+\S", re.M)
_QUOTE = re.compile(r"(?:^>[ \t]+\S[^\n]*(?:\n|\Z)){2,}|^>[ \t]+[A-Z][^\n]*\w", re.M)
_WIKI_LINK = re.compile(r"\[\[[^\[\]\n]+\]\]")
_WIKI_URL = re.compile(r"\[(?:https?|ftp)://[^\s\[\]]+(?:[ \t][^\[\]\n]*)?\]")
_WIKI_TEMPLATE = re.compile(r"\{\{[^{}]+\}\}")
_ARGUMENTS = re.compile(r"\|(?![^\[\]]*\]\])")
#: Templates that show nothing of their arguments: citations and maintenance.
_UNSHOWN = re.compile(r"(?:cite|citation|cn|fact|ref|sfn|efn|harv|r|rp|note|reflist|notelist|clarify|clarification|dead link|update|unreferenced|refimprove|more citations|verify|disputed|dubious|vague|when|who|which|by whom|where|why|cleanup|stub|.+ stub|.+-stub|main|see also|defaultsort|toc|clear|-|use dmy dates|use mdy dates|short description)(?: .*|\d|needed)?")
_WIKI_QUOTES = re.compile(r"'''(?=[^\s'])(?:[^'\n]|'(?!''))*'''|(?<!')''(?=[^\s'])(?:[^'\n]|'(?!'))*(?<=[^\s'])''(?!')")
_WIKI_HEADING = re.compile(r"^(={2,6})[ \t]*[^=\s][^\n]*?\1[ \t]*$", re.M)
_WIKI_TABLE = re.compile(r"^\{\|", re.M)
_WIKI_LIST = re.compile(r"^(?:[*#]{2,}|[*#:;]+[:*#])[ \t]*\S[^\n]*\w", re.M)
#: A line of its own that Markdown reads as a heading or strong text, not as the second level of a wiki list.
_MD_LINE = re.compile(r"#{2,6}[ \t]+\S[^\n]*|\*\*(?=[^\s*])[^\n]*[^\s*]\*\*[^\n]*")
_WIKI_RUN = re.compile(r"(?:^[*#]+[ \t]*\S[^\n]*(?:\n|\Z))+", re.M)
_WIKI_MAGIC = re.compile(r"__[A-Z]{3,}__")
_TEX_COMMAND = re.compile(r"\\([A-Za-z]+)\*?(?![A-Za-z])")
_TEX_ESCAPE = re.compile(r"\\[%&$#_{}](?![\\\w]*\\)|(?<=\w)\\[,;!](?=\w)")
_TEX_DISPLAY = re.compile(r"\\\[(?:(?!\\\[)[\s\S])+?\\\]|\\\((?:(?!\\\()[\s\S])+?\\\)|\$\$[^$]+\$\$")
_TEX_INLINE = re.compile(r"(?<![\\$\w])\$(?=[^\s$])([^$\n]*[^\s$\\])\$(?![\d$])")
_MATH_SIGN = re.compile(r"[\\^_={}+<>]|^[A-Za-z]$")

#: Characters at least one of which every construct holds.
TRIGGER = r"[<&*_#`\\\[{$~\n]|''|==|^[>:;]|^\d+[.)]\s"


def _is_tag(m: re.Match) -> bool:
    return m[1].lower() in TAGS


def formats(text: str) -> set[str]:
    """The kinds of markup a text holds."""
    found = set()
    if "<" in text and ("<!--" in text and "-->" in text or any(_is_tag(m) for m in _TAG.finditer(text)) or re.search(r"<!DOCTYPE\b", text, re.I)):
        found.add("html")
    if "&" in text and any(html.unescape(m[0]) != m[0] for m in _ENTITY.finditer(text)):
        found.add("html")
    md = wiki = tex = False
    if "#" in text:
        md = _MD_HEADING.search(text) is not None
    if "*" in text or "_" in text:
        md = md or _MD_STRONG.search(text) is not None or _MD_EM.search(text) is not None
        wiki = _WIKI_MAGIC.search(text) is not None
    if "`" in text or "~~" in text:
        md = md or any(p.search(text) for p in (_MD_CODE, _MD_FENCE, _MD_STRIKE))
    if "[" in text:
        md = md or any(p.search(text) for p in (_MD_LINK, _MD_FOOTNOTE, _MD_REFERENCE))
        wiki = wiki or any(p.search(text) for p in (_WIKI_LINK, _WIKI_URL))
    if "<" in text:
        md = md or _MD_AUTOLINK.search(text) is not None
    if "\n" in text:
        md = md or any(p.search(text) for p in (_MD_SETEXT, _MD_TABLE, _BULLETS, _NUMBERS, _MD_RULE))
    if ">" in text:
        md = md or _QUOTE.search(text) is not None
    if "''" in text:
        wiki = wiki or _WIKI_QUOTES.search(text) is not None
    if "==" in text:
        wiki = wiki or _WIKI_HEADING.search(text) is not None
    if "{" in text:
        wiki = wiki or any(p.search(text) for p in (_WIKI_TEMPLATE, _WIKI_TABLE))
    if text[:1] in "*#:;" or "\n*" in text or "\n#" in text or "\n:" in text or "\n;" in text:
        wiki = wiki or any(not _is_markdown_line(text, m) for m in _WIKI_LIST.finditer(text))
    if "\\" in text:
        tex = any(m[1] in LATEX and _tex_context(text, m) for m in _TEX_COMMAND.finditer(text)) or any(p.search(text) for p in (_TEX_ESCAPE, _TEX_DISPLAY))
    if "$" in text:
        tex = tex or "$$" in text and _TEX_DISPLAY.search(text) is not None or any(_MATH_SIGN.search(m[1]) for m in _TEX_INLINE.finditer(text))
    return found | {name for name, on in (("markdown", md), ("wiki", wiki), ("latex", tex)) if on}


def _is_markdown_line(text: str, m: re.Match) -> bool:
    """Whether a line that could be of a wiki list is a Markdown heading or strong text: it is no run with its neighbours."""
    line = m[0] if m[0].endswith("\n") else text[m.start() : text.find("\n", m.end()) if "\n" in text[m.end() :] else len(text)]
    return _MD_LINE.fullmatch(line.strip()) is not None and (not m.start() or text[text.rfind("\n", 0, m.start() - 1) + 1 : m.start()].lstrip()[:1] not in ("*", "#"))


def _tex_context(text: str, m: re.Match) -> bool:
    """A known command, unless it is a step of a file path."""
    before = text[m.start() - 1 : m.start()]
    return not (before.isalnum() or before in (":", "\\", ".") and before) or text[m.end() : m.end() + 1] in ("{", "[")


# ---- 1b. dialects as elements -----------------------------------------------------------------------------------------


def _e(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _linear(tex: str) -> str:
    """A formula without commands: fractions as (a) / (b), signs as words or characters."""
    for _ in range(4):
        tex, n = re.subn(r"\\[dt]?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", r"(\1) / (\2)", tex)
        if not n:
            break
    tex = re.sub(r"\\sqrt\s*\{([^{}]*)\}", r"sqrt(\1)", tex)
    for sign, plain in (("cdot", "·"), ("times", "×"), ("leq", "≤"), ("geq", "≥"), ("neq", "≠"), ("approx", "≈"), ("infty", "∞"), ("left", ""), ("right", ""), ("quad", " ")):
        tex = re.sub(rf"\\{sign}(?![A-Za-z])", plain, tex)
    tex = re.sub(r"\\(?:text|mathrm|mathbf|mathit)\s*\{([^{}]*)\}", r"\1", tex)
    return " ".join(re.sub(r"\\([A-Za-z]+)", r"\1", tex).replace("\\%", "%").replace("{", "").replace("}", "").replace("\\", " ").split())


def _from_latex(t: str) -> str:
    keep: list[str] = []

    def store(element: str) -> str:
        keep.append(element)
        return f"\0{len(keep) - 1}\0"

    t = re.sub(r"\\begin\{(?:verbatim|lstlisting)\*?\}(?:\[[^\]]*\])?([\s\S]*?)\\end\{(?:verbatim|lstlisting)\*?\}", lambda m: store(f"<pre>{_e(m[1])}</pre>"), t)
    t = re.sub(r"\\verb\*?([^\sA-Za-z])(.*?)\1", lambda m: store(f"<code>{_e(m[2])}</code>"), t)
    t = re.sub(r"\\begin\{(equation|align|displaymath|gather)\*?\}([\s\S]*?)\\end\{\1\*?\}", lambda m: store(f"<formula>{_e(_linear(m[2]))}</formula>"), t)
    t = re.sub(r"\\\[((?:(?!\\\[)[\s\S])+?)\\\]|\$\$([^$]+)\$\$", lambda m: store(f"<formula>{_e(_linear(m[1] or m[2]))}</formula>"), t)
    t = re.sub(r"\\\(((?:(?!\\\()[\s\S])+?)\\\)", lambda m: store(f"<math>{_e(_linear(m[1]))}</math>"), t)
    t = _TEX_INLINE.sub(lambda m: store(f"<math>{_e(_linear(m[1]))}</math>") if _MATH_SIGN.search(m[1]) else m[0], t)

    def table(m: re.Match) -> str:
        rows = [r for r in re.split(r"\\\\(?:\[[^\]]*\])?|\\(?:hline|toprule|midrule|bottomrule)\b", m[1]) if r.strip()]
        return "<table>" + "".join("<tr>" + "".join(f"<td>{c.strip()}</td>" for c in re.split(r"(?<!\\)&", r)) + "</tr>" for r in rows) + "</table>"

    t = re.sub(r"\\begin\{tabular\}(?:\{[^{}]*\})?([\s\S]*?)\\end\{tabular\}", table, t)
    t = re.sub(r"\\begin\{(itemize|enumerate|description)\}(?:\[[^\]]*\])?", lambda m: "<ol>" if m[1] == "enumerate" else "<ul>", t)
    t = re.sub(r"\\end\{(itemize|enumerate|description)\}", lambda m: "</ol>" if m[1] == "enumerate" else "</ul>", t)
    t = re.sub(r"\\item\b(?:\[([^\]]*)\])?", lambda m: f"<li>{m[1] or ''} ", t)
    t = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]]*\])?", "", t)
    t = re.sub(r"\\(?:cite[pt]?|label|ref|eqref|pageref|footnotemark|bibliography|usepackage|documentclass|includegraphics)\*?(?:\[[^\]]*\])*(?:\{[^{}]*\})", "", t)
    while True:
        before = t
        t = re.sub(r"\\(part|chapter|section|title)\*?\{([^{}]*)\}", r"<h2>\2</h2>", t)
        t = re.sub(r"\\((?:sub)+section|paragraph)\*?\{([^{}]*)\}", r"<h3>\2</h3>", t)
        t = re.sub(r"^[ \t]*\\textbf\{([^{}]*)\}[ \t]*$", r"<h3>\1</h3>", t, flags=re.M)
        t = re.sub(r"\\(?:textbf|textsc|underline)\{([^{}]*)\}", r"<b>\1</b>", t)
        t = re.sub(r"\\(?:emph|textit|textsl)\{([^{}]*)\}", r"<i>\1</i>", t)
        t = re.sub(r"\\texttt\{([^{}]*)\}", r"<code>\1</code>", t)
        t = re.sub(r"\\href\{([^{}]*)\}\{([^{}]*)\}", r"<a>\2</a>", t)
        t = re.sub(r"\\url\{([^{}]*)\}", r"<a>\1</a>", t)
        t = re.sub(r"\\(?:footnote|caption|text\w+|author|date)\{([^{}]*)\}", r" \1", t)
        if t == before:
            break
    t = _TEX_COMMAND.sub(lambda m: " " if m[1] in LATEX and _tex_context(t, m) else m[0], t)
    t = re.sub(r"\\[,;!]", " ", t)
    t = re.sub(r"\\([%&$#_{}])", lambda m: _e(m[1]), t)
    return re.sub("\0(\\d+)\0", lambda m: keep[int(m[1])], t)


def _argument_text(template: str) -> str:
    """What a template shows: its positional arguments, nothing for citations and maintenance."""
    name, *arguments = _ARGUMENTS.split(template)
    if _UNSHOWN.fullmatch(name.strip().replace("_", " ").lower()):
        return ""
    shown = [a.strip() for a in arguments if not re.match(r"\s*[\w -]+=", a)]
    return " ".join(a for a in shown[name.strip().lower() == "lang" :] if a)


def _templates(t: str) -> str:
    """Templates replaced by what they show, at any depth, in one pass; unmatched braces stay."""
    stack: list[list[str]] = [[]]
    for part in re.split(r"(\{\{|\}\})", t):
        if part == "{{":
            stack.append([])
        elif part == "}}" and len(stack) > 1:
            inner = "".join(stack.pop())
            stack[-1].append(_argument_text(inner) if inner and not {"{", "}"} & set(inner) else "{{" + inner + "}}")
        else:
            stack[-1].append(part)
    return "{{".join("".join(parts) for parts in stack)


def _from_wiki(t: str) -> str:
    t = re.sub(r"<math>([\s\S]*?)</math>", lambda m: f"<formula>{_e(_linear(m[1]))}</formula>", t)
    t = _templates(t)

    def table(m: re.Match) -> str:
        rows = []
        for part in re.split(r"^\|-[^\n]*$", m[1], flags=re.M):
            cells = []
            for line in part.split("\n"):
                if line[:1] in ("|", "!") and not line.startswith(("|}", "|+")):
                    mark = "th" if line[0] == "!" else "td"
                    cells += [f"<{mark}>{c.split('|')[-1].strip() if '=' in c.split('|')[0] else c.strip()}</{mark}>" for c in re.split(r"\|\||!!", line[1:])]
            if cells:
                rows.append("<tr>" + "".join(cells) + "</tr>")
        return "<table>" + "".join(rows) + "</table>"

    t = re.sub(r"^\{\|[^\n]*\n([\s\S]*?)(?:^\|\}|\Z)", table, t, flags=re.M)
    t = re.sub(r"^\{\|", "", t, flags=re.M)  # a table that never begins
    t = re.sub(r"\[\[(?:File|Image|Category):[^\[\]]*\]\]", "", t, flags=re.I)
    t = _WIKI_LINK.sub(lambda m: f"<a>{m[0][2:-2].split('|')[-1]}</a>", t)
    t = _WIKI_URL.sub(lambda m: f"<a>{m[0][1:-1].partition(' ')[2] or m[0][1:-1]}</a>", t)
    t = _WIKI_HEADING.sub(lambda m: f"<h{len(m[1])}>{m[0].strip().strip('=').strip()}</h{len(m[1])}>", t)
    t = re.sub(r"^'''([^'\n]+)'''[ \t]*$", r"<h3>\1</h3>", t, flags=re.M)
    t = re.sub(r"'''([^\n]*?)'''", r"<b>\1</b>", t)
    t = re.sub(r"(?<!')''(?=[^\s'])([^\n]*?)''(?!')", r"<i>\1</i>", t)

    def items(m: re.Match) -> str:
        lines = m[0].rstrip("\n").split("\n")
        if len(lines) == 1 and _MD_LINE.fullmatch(lines[0].strip()):
            return m[0]
        tag = "ul" if m[0][0] == "*" else "ol"
        return f"<{tag}>" + "".join(f"<li>{x.lstrip('*# ')}</li>" for x in lines) + f"</{tag}>\n"

    t = _WIKI_RUN.sub(items, t)
    t = re.sub(r"^[*#]*[:;]+[:;*#]+[ \t]*(\S[^\n]*)$", r"<dd>\1</dd>", t, flags=re.M)
    return _WIKI_MAGIC.sub("", t)


def _from_markdown(t: str) -> str:
    keep: list[str] = []

    def store(element: str) -> str:
        keep.append(element)
        return f"\1{len(keep) - 1}\1"

    t = re.sub(r"^ {0,3}(```|~~~)[^\n]*\n([\s\S]*?)(?:^ {0,3}\1[ \t]*$|\Z)", lambda m: store(f"<pre>{_e(m[2])}</pre>"), t, flags=re.M)
    t = _MD_FENCE.sub("", t)  # code that never begins
    t = _MD_CODE.sub(lambda m: store(f"<code>{_e(m[0].strip('`').strip())}</code>"), t)

    def table(m: re.Match) -> str:
        rows = [x for x in m[0].strip("\n").split("\n") if not _MD_TABLE.fullmatch(x)]
        return "<table>" + "".join("<tr>" + "".join(f"<td>{c.strip()}</td>" for c in r.strip().strip("|").split("|")) + "</tr>" for r in rows) + "</table>\n"

    t = re.sub(r"^[^\n]*\|[^\n]*\n[ \t]*\|?[ \t]*:?-{2,}[^\n]*\n?(?:[^\n]*\|[^\n]*(?:\n|\Z))*", lambda m: table(m) if _MD_TABLE.search(m[0]) else m[0], t, flags=re.M)
    t = re.sub(_MD_TABLE.pattern + r"\n(?:[^\n]*\|[^\n]*(?:\n|\Z))+", table, t, flags=re.M)  # a table without a header
    t = re.sub(r"^ {0,3}(#{1,6})[ \t]+([^\n]*?)[ \t#]*$", lambda m: f"<h{len(m[1])}>{m[2]}</h{len(m[1])}>", t, flags=re.M)
    t = re.sub(r"^((?=[^\n]*\w)(?:[^\n|<]|<(?![A-Za-z/!]))+)\n(={3,}|-{3,})[ \t]*$", lambda m: f"<h{1 if m[2][0] == '=' else 2}>{m[1]}</h{1 if m[2][0] == '=' else 2}>", t, flags=re.M)
    items = lambda m, tag: f"<{tag}>" + "".join(f"<li>{re.sub(r'^[ \t]*(?:[-*+]|[0-9]+[.)])[ \t]+', '', x)}</li>" for x in m[0].rstrip("\n").split("\n")) + f"</{tag}>\n"
    t = _BULLETS.sub(lambda m: items(m, "ul"), t)
    t = re.sub(r"(?:^[ \t]*[0-9]+[.)][ \t]+\S[^\n]*(?:\n|\Z)){2,}", lambda m: items(m, "ol"), t, flags=re.M)
    t = re.sub(r"^>[ \t]?", "", t, flags=re.M)
    t = _MD_RULE.sub("\n\n", t)
    t = re.sub(r"!\[([^\[\]\n]*)\]\([^()\n]*\)", r"\1", t)
    t = _MD_LINK.sub(lambda m: f"<a>{m[0][1:].partition('](')[0]}</a>", t)
    t = re.sub(r"\[([^\[\]\n]+)\]\[[^\[\]\n]*\]", r"<a>\1</a>", t)
    t = re.sub(r"^\[[^\[\]\n]+\]:\s+\S+[^\n]*$", "", t, flags=re.M)
    t = _MD_FOOTNOTE.sub("", t)
    t = _MD_AUTOLINK.sub(lambda m: f"<a>{m[0][1:-1]}</a>", t)
    t = re.sub(r"^(\*\*|__)([^*_\n]+)\1[ \t]*$", r"<h3>\2</h3>", t, flags=re.M)
    t = re.sub(r"\*\*(?=[^\s*])((?:[^*\n]|\*(?!\*))*(?<=[^\s*]))\*\*|(?<!\w)__(?=[^\s_])([^_\n]*[^\s_])__(?!\w)", lambda m: f"<b>{m[1] or m[2]}</b>", t)
    t = _MD_EM.sub(lambda m: f"<i>{m[0][1:-1]}</i>", t)
    t = _MD_STRIKE.sub(lambda m: m[0][2:-2], t)
    return re.sub("\1(\\d+)\1", lambda m: keep[int(m[1])], t)


# ---- 2. nodes ---------------------------------------------------------------------------------------------------------


class Node(NamedTuple):
    path: tuple[str, ...]
    text: str
    block: int  # nodes of one block flow together


class _Walker(HTMLParser):
    """Text nodes with root-to-leaf paths; unclosed elements end with what closes around them.

    How often a tag is open is counted, so no step looks through the whole stack; of a path deeper than DEPTH elements
    the ends are kept.
    """

    DEPTH = 64

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.open: dict[str, int] = defaultdict(int)
        self.skipping = 0
        self.nodes: list[Node] = []
        self.block = 0

    def _path(self) -> tuple[str, ...]:
        half = self.DEPTH // 2
        return tuple(self.stack) if len(self.stack) <= self.DEPTH else tuple(self.stack[:half] + self.stack[-half:])

    def _close(self, tag: str) -> None:
        """Close the innermost open `tag` and all within it."""
        while True:
            top = self.stack.pop()
            self.open[top] -= 1
            self.skipping -= top in SKIPPED
            if top == tag:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in TAGS:
            self.handle_data(self.get_starttag_text() or "")
            return
        if tag in BLOCKS or tag == "br":
            self.block += 1
        if tag in ("li", "tr", "td", "th", "p", "dt", "dd") and self.open[tag]:
            for inner in reversed(self.stack):
                if inner in ("ul", "ol", "table", "dl"):
                    break
                if inner == tag:
                    self._close(tag)
                    break
        if tag not in VOID:
            self.stack.append(tag)
            self.open[tag] += 1
            self.skipping += tag in SKIPPED

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS or tag == "br":
            self.block += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.block += 1
        if self.open[tag]:
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if data and not self.skipping:
            path = self._path()
            if self.open["pre"] or "\n\n" not in data.replace("\r\n", "\n"):
                self.nodes.append(Node(path, data, self.block))
                return
            for k, part in enumerate(re.split(r"(?:\r?\n[ \t]*){2,}", data)):
                self.block += bool(k)
                self.nodes.append(Node(path, part, self.block))


def _open_comments(t: str) -> str:
    """The text without the marks of comments that nothing closes: the tags behind them are read."""
    start = max(0, t.rfind("-->") - 3)
    return t[:start] + re.sub(r"<!--(?:-?>)?", "", t[start:])


def walk(text: str) -> tuple[list[Node], set[str]]:
    """The text nodes of a document and the kinds of markup in it."""
    kinds = formats(text)
    if not kinds:
        return [Node((), text, 0)], kinds
    t = text
    if "html" in kinds and "&lt;" in t and re.search(r"&lt;/?[A-Za-z]+(?:\s[^<>]*?)?/?&gt;", t):
        t = html.unescape(t)  # escaped twice
    if "latex" in kinds:
        t = _from_latex(t)
    if "wiki" in kinds:
        t = _from_wiki(t)
    if "markdown" in kinds:
        t = _from_markdown(t)
    t = re.sub(r"\[\s*[a-z]+://[^\s\]]+\s*\]", "", t)
    walker = _Walker()
    walker.feed(_open_comments(t) if "html" in kinds else t)
    walker.close()
    return [n for n in walker.nodes if n.text.strip() or len(n.path)], kinds


# ---- 3. tag-path ratios -----------------------------------------------------------------------------------------------

_FORMULA = re.compile(r"[A-Za-z]\w? = [-+*/()\w^ .]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。،]")


class Unit(NamedTuple):
    """The nodes of one block, which flow together: the path of its block elements, its text, and how much of it is linked."""

    block: int
    path: tuple[str, ...]
    text: str
    linked: int
    kind: str


def units(nodes: list[Node]) -> list[Unit]:
    held: dict[int, list[Node]] = defaultdict(list)
    for n in nodes:
        held[n.block].append(n)
    out = []
    for block, group in held.items():
        text = "".join(n.text for n in group).strip()
        if text:
            kind = "formula" if _FORMULA.fullmatch(text) else _kind(group[0].path)[0]
            out.append(Unit(block, tuple(x for x in group[0].path if x in BLOCKS), text, sum(len(n.text.strip()) for n in group if "a" in n.path), kind))
    return out


def path_scores(found: list[Unit], spread: float = 1.0) -> list[float]:
    """The fused tag-path ratio of each unit: length and punctuation a unit of its path, smoothed over the sequence, times the path's share of text that isn't linked."""
    length, points, linked, count = defaultdict(float), defaultdict(float), defaultdict(float), defaultdict(int)
    for u in found:
        length[u.path] += len(u.text)
        points[u.path] += len(_PUNCTUATION.findall(u.text))
        linked[u.path] += u.linked
        count[u.path] += 1
    raw = [(length[u.path] / count[u.path], points[u.path] / count[u.path]) for u in found]
    weights = [math.exp(-(k**2) / (2 * spread**2)) for k in range(-2, 3)]
    fused = []
    for i, u in enumerate(found):
        total = [0.0, 0.0, 0.0]
        for k, w in zip(range(-2, 3), weights):
            if 0 <= i + k < len(raw):
                total = [total[0] + w * raw[i + k][0], total[1] + w * raw[i + k][1], total[2] + w]
        fused.append(math.sqrt((total[0] / total[2]) * (1 + total[1] / total[2])) * (1 - min(1.0, linked[u.path] / length[u.path])))
    return fused


def content(nodes: list[Node], strictness: float = 0.25) -> list[Node]:
    """The nodes that are content, in documents of any number of nodes, whatever their tags are called.

    A unit is content if its score reaches the threshold, `strictness` times the standard deviation of the scores. Below
    it stays structure (list items, rows, code, formulas) that is more plain than linked text; a heading stays if
    something up to the next heading does, or if nothing stands there.
    """
    found = units(nodes)
    if len(found) < 2:
        return nodes
    scores = path_scores(found)
    mean = sum(scores) / len(scores)
    threshold = strictness * math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores))
    kept = {u.block for u, s in zip(found, scores) if u.kind != "heading" and (s >= threshold or u.kind != "paragraph" and 2 * u.linked <= len(u.text))}
    under = None  # whether the section, read backwards, has content; None while it has nothing
    for u in reversed(found):
        if u.kind != "heading":
            under = bool(under) or u.block in kept
        else:
            if under is not False:
                kept.add(u.block)
            under = None
    return [n for n in nodes if n.block in kept or not n.text.strip()]


def has_paths(text: str) -> bool:
    """Whether a text holds markup: what its conversion selects has a node off the root path, or isn't the text as it was.

    A text that loses nodes to the threshold holds markup: nodes of the root path alone have one score and all stay.
    """
    kept = content(walk(text)[0])
    return any(n.path for n in kept) or "".join(n.text for n in kept) != text


# ---- 4. rendering -----------------------------------------------------------------------------------------------------


class Block(NamedTuple):
    kind: str
    level: int
    text: str


def _kind(path: tuple[str, ...]) -> tuple[str, int]:
    for tag in reversed(path):
        if tag in HEADINGS:
            return "heading", HEADINGS[tag]
        if tag in ("pre", "syntaxhighlight"):
            return "code", 0
        if tag == "formula":
            return "formula", 0
        if tag == "li":
            lists = [x for x in path if x in ("ul", "ol")]
            return ("numbered" if lists[-1:] == ["ol"] else "item"), max(1, len(lists))
        if tag in ("td", "th"):
            return "cell", 0
    return "paragraph", 0


def blocks(nodes: list[Node]) -> list[Block]:
    """Nodes joined to blocks, cells to rows; stretches of code and formulas alone in a block give the block its kind."""
    out: list[Block] = []
    row: list[str] = []
    row_at = None
    groups: list[tuple[int, list[Node]]] = []
    for n in nodes:
        if groups and groups[-1][0] == n.block:
            groups[-1][1].append(n)
        else:
            groups.append((n.block, [n]))

    def flush() -> None:
        nonlocal row, row_at
        if row:
            out.append(Block("row", 0, "\t".join(row)))
        row, row_at = [], None

    previous_block = None
    for block, group in groups:
        kind, level = _kind(group[0].path)
        if kind == "code":
            flush()
            text = "".join(n.text for n in group).strip("\n")
        else:
            text = " ".join("".join(n.text for n in group).split())
            filled = [n for n in group if n.text.strip()]
            if kind == "paragraph" and filled and all({"code", "tt", "samp", "kbd"} & set(n.path) for n in filled):
                kind = "code"
            elif kind == "paragraph" and filled and (all({"math", "formula"} & set(n.path) for n in filled) or _FORMULA.fullmatch(text)):
                kind = "formula"
            elif kind == "paragraph" and filled and len(text) <= 80 and all({"b", "strong"} & set(n.path) for n in filled):
                kind, level, text = "heading", 3, text.rstrip(":")
        if kind == "cell":
            if row and previous_block is not None and block - previous_block > 2:
                flush()
            row.append(text)
            previous_block = block
            continue
        if not text.strip():
            continue
        flush()
        out.append(Block(kind, level, text))
    flush()
    return out


def render(found: list[Block]) -> str:
    """Clean text of blocks."""
    lines: list[str] = []
    number = 0
    before = ""
    for b in found:
        number = number + 1 if b.kind == "numbered" and before == "numbered" else 1
        text = {"item": f"- {b.text}", "numbered": f"{number}. {b.text}", "code": "\n".join("    " + x for x in b.text.split("\n"))}.get(b.kind, b.text)
        joined = before == b.kind and b.kind in ("item", "numbered", "row")
        lines.append(("" if not lines else "\n" if joined else "\n\n") + text)
        before = b.kind
    return "".join(lines)


def clean(text: str | None) -> tuple[str | None, list[Block], list[str]]:
    """(clean text, blocks, kinds of markup) of one text."""
    if text is None:
        return None, [], []
    nodes, kinds = walk(text)
    if not kinds:
        stripped = text.strip()
        return stripped, [Block("paragraph", 0, stripped)] if stripped else [], []
    found = blocks(content(nodes))
    return render(found), found, sorted(kinds)


# ---- columns ----------------------------------------------------------------------------------------------------------

CLEAN = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("blocks", T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("level", T.IntegerType()), T.StructField("text", T.StringType())]))),
    T.StructField("formats", T.ArrayType(T.StringType())),
])


@F.pandas_udf(CLEAN)
def clean_column(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([clean(t if isinstance(t, str) else None) for t in texts], columns=["text", "blocks", "formats"])


def may_hold_markup(text: Column) -> Column:
    """A condition every text with markup meets, tested before texts cross to Python."""
    return text.rlike(f"(?m){TRIGGER}")


def marked_up(df: DataFrame, *texts: str) -> DataFrame:
    """The rows any of whose text columns holds markup; columns are kept."""
    name = "_markup_text"
    candidates = [F.when(may_hold_markup(F.col(t)), F.col(t)) for t in texts]
    held = df.withColumn(name, F.concat_ws("\u0004\n\n", *candidates)).where(F.col(name) != "")

    @F.pandas_udf(T.BooleanType())
    def any_markup(joined: pd.Series) -> pd.Series:
        return pd.Series([any(map(has_paths, j.split("\u0004\n\n"))) for j in joined], dtype=bool)

    return held.where(any_markup(F.col(name))).drop(name)


def cleaned(df: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """df with <prefix>clean_text, <prefix>blocks and <prefix>formats; texts that can't hold markup stay in the JVM."""
    value = F.col(text)
    dirty = F.when(may_hold_markup(value), value)
    parsed = df.withColumn("_c", clean_column(dirty))
    trimmed = F.trim(value)
    whole = F.when(value.isNull() | (trimmed == ""), F.array().cast("array<struct<kind:string,level:int,text:string>>")).otherwise(
        F.array(F.struct(F.lit("paragraph").alias("kind"), F.lit(0).alias("level"), trimmed.alias("text")))
    )
    marked = F.size("_c.formats") > 0
    return parsed.withColumns({
        f"{prefix}clean_text": F.when(marked, F.col("_c.text")).otherwise(trimmed), f"{prefix}blocks": F.when(marked, F.col("_c.blocks")).otherwise(whole), f"{prefix}formats": F.coalesce(F.col("_c.formats"), F.array().cast("array<string>")),
    }).drop("_c")
