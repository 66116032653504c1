"""Leaves of marked-up text: their tag path and the signs that they hold.

A text is cut into leaves (its lines). Each leaf knows the elements that are open around it
(its tag path) and which inline signs it holds outside of code. ``teach`` turns
leaves into labels by fixed rules; it makes the training labels of the block
labeller and is its test reference.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

#: Elements that a leaf can lie in or be.
PATH = ("pre", "fence", "highlight", "verbatim", "indent", "math_tag", "display", "equation", "ul", "ol", "itemize", "quote_env", "p", "h")
#: Inline and line signs (see ``signs``).
SIGNS = (
    "html_tag", "html_heading", "html_list", "html_pre", "entity", "md_heading", "md_setext", "md_bold", "md_under", "md_em", "md_code", "md_link", "md_image", "md_quote", "md_fence",
    "dash_item", "star_item", "num_item", "hash_item", "hash_run", "wiki_heading", "wiki_bold", "wiki_em", "wiki_link", "wiki_template", "wiki_tag", "wiki_math", "wiki_highlight", "wiki_table",
    "tex_section", "tex_command", "tex_env", "tex_item", "tex_verbatim", "tex_equation", "tex_display", "dollar", "tex_escape", "code_line", "breadcrumb", "blank", "around_html", "around_markdown", "around_wiki", "around_latex",
)
MARKUPS = ("html", "markdown", "wiki", "latex")
LABELS = (*MARKUPS, "heading", "list", "code", "formula")
_HTML = "a|abbr|b|blockquote|body|br|caption|center|cite|code|dd|del|div|dl|dt|em|font|h[1-6]|head|hr|html|i|img|ins|li|link|meta|ol|p|pre|s|script|small|span|strong|style|sub|sup|table|tbody|td|tfoot|th|thead|title|tr|tt|u|ul"
_html_tag = re.compile(rf"</?(?:{_HTML})(?:\s[^<>]*)?/?>", re.I)
_entity = re.compile(r"&(?:#\d{1,7}|#x[0-9a-f]{1,6}|[a-z][a-z0-9]{1,31});", re.I)
_patterns = {
    "html_tag": _html_tag,
    "html_heading": re.compile(r"<h[1-6](?:\s[^<>]*)?>", re.I),
    "html_list": re.compile(r"<(?:ul|ol|li|dl)(?:\s[^<>]*)?>", re.I),
    "html_pre": re.compile(r"<pre(?:\s[^<>]*)?>", re.I),
    "entity": _entity,
    "md_bold": re.compile(r"(?<!\*)\*\*(?=\S)[^*]+(?<=\S)\*\*(?!\*)"),
    "md_under": re.compile(r"(?<!\w)__(?=\S)[^_]+(?<=\S)__(?!\w)"),
    "md_em": re.compile(r"(?<![*\w])\*(?=[^\s*])[^*]*[^\s*]\*(?![*\w])|(?<![_\w])_(?=[^\s_])[^_]*[^\s_]_(?![_\w])"),
    "md_code": re.compile(r"(?<!`)`[^`\s](?:[^`]*[^`\s])?`(?!`)"),
    "md_link": re.compile(r"(?<![!\[])\[[^\[\]]+\]\([^()\s]+\)"),
    "md_image": re.compile(r"!\[[^\[\]]*\]\([^()\s]+\)"),
    "md_quote": re.compile(r"^\s{0,3}>\s?\S"),
    "wiki_heading": re.compile(r"^\s*(={2,6})\s*[^=\s](?:[^=]*[^=\s])?\s*\1\s*$"),
    "wiki_bold": re.compile(r"'''(?=\S)[^']+(?:'[^']+)*'''"),
    "wiki_em": re.compile(r"(?<!')''(?=[^'\s])[^']+(?:'[^']+)*''(?!')"),
    "wiki_link": re.compile(r"\[\[[^\[\]]+\]\]"),
    "wiki_template": re.compile(r"\{\{[^{}]+\}\}"),
    "wiki_tag": re.compile(r"</?(?:ref|nowiki|gallery|includeonly|noinclude|onlyinclude|references|poem)(?:\s[^<>]*)?/?>", re.I),
    "wiki_math": re.compile(r"<math(?:\s[^<>]*)?>", re.I),
    "wiki_highlight": re.compile(r"<(?:syntaxhighlight|source)(?:\s[^<>]*)?>", re.I),
    "wiki_table": re.compile(r"^\s*(?:\{\||\|\}|\|-|!!)"),
    "tex_section": re.compile(r"\\(?:part|chapter|(?:sub)*section|paragraph)\*?\{"),
    "tex_command": re.compile(r"\\(?:emph|textbf|textit|texttt|textsc|underline|cite[pt]?|footnote|href|url|ref|label|caption|includegraphics)\*?(?:\[[^\]]*\])?\{"),
    "tex_env": re.compile(r"\\(?:begin|end)\{[A-Za-z]+\*?\}"),
    "tex_item": re.compile(r"^\s*\\item\b"),
    "tex_verbatim": re.compile(r"\\begin\{(?:verbatim|lstlisting|minted)\}"),
    "tex_equation": re.compile(r"\\begin\{(?:equation|align|gather|displaymath|math|eqnarray)\*?\}"),
    "tex_display": re.compile(r"\\\[.*|\\\(.+\\\)"),
    "dollar": re.compile(r"\$\$[^$]+\$\$|(?<![\\$\w])\$(?=[^\s$])(?=[^$]*[=\\^_+])[^$\n]*[^\s$\\]\$(?![\w$])"),
    "tex_escape": re.compile(r"(?<=\d)\\%|(?<=\s)\\[&#_$](?=\s)"),
}
_fence = re.compile(r"^\s{0,3}(```+|~~~+)")
_item = re.compile(r"^\s{0,3}(?:(-|\+)|(\*)|(\d{1,3}[.)])|(#))\s+\S")
_md_heading = re.compile(r"^(#{1,6})\s+\S")


@dataclass
class Leaf:
    text: str
    path: set[str] = field(default_factory=set)
    signs: set[str] = field(default_factory=set)


def _strip_inline_code(s: str) -> str:
    return re.sub(r"(?<!`)`[^`]+`(?!`)", " ", s)


def leaves(text: str, breadcrumb_lines: int = 0) -> list[Leaf]:
    """The leaves of a text; the first ``breadcrumb_lines`` headings are its breadcrumb."""
    out: list[Leaf] = []
    lines = text.replace("\r\n", "\n").split("\n")
    state: str | None = None
    fence = ""
    for k, line in enumerate(lines):
        leaf = Leaf(line)
        out.append(leaf)
        s = line.strip()
        if state is None and not s:
            leaf.signs.add("blank")
            continue
        if breadcrumb_lines and _md_heading.match(s):
            leaf.signs.add("breadcrumb")
            breadcrumb_lines -= 1
            continue
        if s:
            breadcrumb_lines = 0
        if state:
            leaf.path.add(state)
            end = {"fence": lambda: s.startswith(fence) and not s.strip(fence[0]), "pre": lambda: "</pre" in line.lower(), "highlight": lambda: bool(re.search(r"</(?:syntaxhighlight|source)", line, re.I)),
                   "verbatim": lambda: bool(re.search(r"\\end\{(?:verbatim|lstlisting|minted)\}", line)), "math_tag": lambda: "</math" in line.lower(), "display": lambda: "\\]" in line or "$$" in line,
                   "equation": lambda: bool(re.search(r"\\end\{(?:equation|align|gather|displaymath|math|eqnarray)", line))}[state]
            if end():
                state = None
            continue
        m = _fence.match(line)
        if m:
            fence, state = m[1][:3], "fence"
            leaf.signs.add("md_fence")
            leaf.path.add("fence")
            continue
        before = out[k - 1] if k else None
        if re.match(r"^(?: {4}|\t)\S", line) and (before is None or "blank" in before.signs or "indent" in before.path):
            leaf.path.add("indent")
            leaf.signs.add("code_line")
            continue
        body = line
        if _patterns["html_pre"].search(body):
            leaf.signs.update(("html_pre", "html_tag"))
            leaf.path.add("pre")
            if "</pre" not in body.lower():
                state = "pre"
            body = re.sub(r"<pre.*?(?:</pre\s*>|$)", " ", body, flags=re.I | re.S)
        if _patterns["wiki_highlight"].search(body):
            leaf.signs.add("wiki_highlight")
            leaf.path.add("highlight")
            if not re.search(r"</(?:syntaxhighlight|source)", body, re.I):
                state = "highlight"
            body = re.sub(r"<(syntaxhighlight|source).*?(?:</\1\s*>|$)", " ", body, flags=re.I | re.S)
        if _patterns["wiki_math"].search(body):
            leaf.signs.add("wiki_math")
            leaf.path.add("math_tag")
            if "</math" not in body.lower():
                state = "math_tag"
            body = re.sub(r"<math.*?(?:</math\s*>|$)", " ", body, flags=re.I | re.S)
        if _patterns["tex_verbatim"].search(body):
            leaf.signs.update(("tex_verbatim", "tex_env"))
            leaf.path.add("verbatim")
            state = "verbatim"
            continue
        if _patterns["tex_equation"].search(body):
            leaf.signs.update(("tex_equation", "tex_env"))
            leaf.path.add("equation")
            state = "equation"
            continue
        if s.startswith("\\[") or (s.startswith("$$") and s.count("$$") == 1):
            leaf.signs.add("tex_display" if s.startswith("\\[") else "dollar")
            leaf.path.add("display")
            if "\\]" not in s and not s.count("$$") > 1:
                state = "display"
            continue
        plain = _strip_inline_code(body)
        for name, pattern in _patterns.items():
            if name in ("html_pre", "wiki_highlight", "wiki_math", "tex_verbatim", "tex_equation"):
                continue
            if pattern.search(body if name == "md_code" else plain):
                leaf.signs.add(name)
        m = _item.match(plain)
        if m:
            leaf.signs.add("dash_item" if m[1] else "star_item" if m[2] else "num_item" if m[3] else "hash_item")
        if _md_heading.match(s) and "hash_item" not in leaf.signs:
            leaf.signs.add("md_heading")
        if re.fullmatch(r"-{3,}|={3,}", s) and before is not None and before.text.strip() and not before.signs & {"md_setext", "md_heading"}:
            leaf.signs.add("md_setext")
    items = ("hash_item",)
    for k, leaf in enumerate(out):
        if leaf.signs & set(items):
            near = [out[j] for j in (k - 1, k + 1) if 0 <= j < len(out)]
            if any("hash_item" in x.signs for x in near):
                leaf.signs.add("hash_run")
    _around(out)
    return out


_own = {
    "html": {"html_tag", "entity", "html_heading", "html_list", "html_pre"},
    "markdown": {"md_heading", "md_setext", "md_bold", "md_under", "md_em", "md_code", "md_link", "md_image", "md_quote", "md_fence", "code_line"},
    "wiki": {"wiki_heading", "wiki_bold", "wiki_em", "wiki_link", "wiki_template", "wiki_tag", "wiki_math", "wiki_highlight", "wiki_table", "hash_run"},
    "latex": {"tex_section", "tex_command", "tex_env", "tex_item", "tex_verbatim", "tex_equation", "tex_display", "dollar", "tex_escape"},
}


def _around(out: list[Leaf]) -> None:
    """Give list items the nearest markup around them, as far as it has such items."""
    marks = [(k, {m for m, own in _own.items() if leaf.signs & own}) for k, leaf in enumerate(out)]
    marks = [(k, m) for k, m in marks if m]
    for k, leaf in enumerate(out):
        if leaf.signs & {"star_item", "dash_item", "num_item", "hash_item"}:
            fit = ("markdown", "wiki") if "star_item" in leaf.signs else ("wiki",) if "hash_item" in leaf.signs else ("markdown",)
            near = [(abs(j - k), j, x) for j, m in marks for x in m if x in fit]
            leaf.signs.add("around_" + (min(near)[2] if near else fit[0]))


def teach(leaf: Leaf) -> set[str]:
    """Labels of a leaf by the fixed rules."""
    s, out = leaf.signs, set()
    if s & {"blank", "breadcrumb"}:
        return out
    for m, own in _own.items():
        if s & own - ({"hash_run"} if m == "wiki" else set()):
            out.add(m)
    if s & {"md_heading", "md_setext", "wiki_heading", "html_heading", "tex_section"}:
        out.add("heading")
    if s & {"html_list", "tex_item"} or s & {"dash_item", "star_item", "num_item"} or "hash_run" in s:
        out.add("list")
    if s & {"dash_item", "star_item", "num_item", "hash_item"}:
        if "hash_item" in s and "hash_run" not in s and "around_wiki" not in s:
            out |= {"heading", "markdown"}
        else:
            out.add("list")
            out |= {m for m in MARKUPS if f"around_{m}" in s}
    if leaf.path & {"pre", "fence", "highlight", "verbatim", "indent"}:
        out.add("code")
        out |= {m for m, p in (("html", "pre"), ("markdown", "fence"), ("markdown", "indent"), ("wiki", "highlight"), ("latex", "verbatim")) if p in leaf.path}
    if leaf.path & {"math_tag", "display", "equation"} or s & {"dollar", "tex_display", "tex_equation", "wiki_math"}:
        out.add("formula")
        out.add("wiki" if leaf.path & {"math_tag"} else "latex")
    return out
