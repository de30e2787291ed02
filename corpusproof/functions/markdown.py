"""Raw wiki HTML to Markdown as column expressions: elements are rewritten kind by kind, nested ones from the inside out.

``rewritten`` is the only mechanism: every element that a pattern finds is replaced by a function of its own text.  What
must not be touched by later steps (code, targets of links) waits in arrays or between private-use characters, which are
taken out of the input first.  Links to pages are left as ``corpus-page:`` targets that joins resolve later.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusproof.functions.helpers import unescape_entities
from corpusproof.functions.text import text_of

#: How deep lists, tables and macros may stand in one another; deeper ones lose their marks and keep their text.
DEPTH = 4
# private-use characters: literal text k, preformatted text k, its language, a line break, a target, an end
_LITERAL, _FENCED, _SAYS, _BREAK, _TARGET, _END = (chr(0xE000 + k) for k in range(6))
# fixed values: titles of panels by macro, and marks of inline tags
PANELS = {"info": "Info", "note": "Note", "warning": "Warning", "tip": "Tip", "panel": "Panel", "success": "Success", "error": "Error"}
MARKS = {"strong|b": "**", "em|i": "*", "del|s": "~~"}
PARAGRAPHS = "p|div|section|article|body|html|main|header|footer|nav|dl|dt|dd|figure|tbody|thead|ac:layout|ac:layout-section|ac:layout-cell|ac:rich-text-body|blockquote"
#: Tags with a prefix that are understood where they stand alone.
KNOWN = ["ac:link", "ac:image", "ac:parameter", "ac:structured-macro", "ac:macro", "ac:link-body", "ac:plain-text-body", "ac:plain-text-link-body", "ac:emoticon", "ac:task-list", "ac:task", "ac:task-id", "ac:task-uuid", "ac:task-status", "ac:task-body", "ri:page", "ri:attachment", "ri:url", "ri:user"]


def rewritten(text: Column, pattern: str, f: Callable[[Column], Column]) -> Column:
    """``text`` with every match of ``pattern`` replaced by ``f`` of it."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(pattern), F.array_join(F.zip_with(between, F.transform(found, f), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")).otherwise(text)


def _element(tags: str, nested: bool = False) -> str:
    """Pattern of an element; with ``nested`` one that holds none of its own kind."""
    inside = f"(?:(?!<(?:{tags})[\\s>/]).)*?" if nested else ".*?"
    return f"(?is)<({tags})(?=[\\s>])(?:[^>]*[^>/])?>{inside}</\\1\\s*>"


def _inner(element: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(element, "(?s)^<[^>]*>", ""), "(?s)</[^>]*>$", "")


def _attribute(element: Column, name: str) -> Column:
    """An attribute of the first tag that has it; empty if none has."""
    return F.regexp_extract(element, f"(?is)<[^>]*\\s{name}\\s*=\\s*[\"']([^\"']*)", 1)


def _first_tag_attribute(element: Column, name: str) -> Column:
    return _attribute(F.regexp_extract(element, "(?s)^<[^>]*>", 0), name)


def _target(value: Column) -> Column:
    return F.concat(F.lit(_TARGET), value, F.lit(_END))


def _or(value: Column, other: Column | str) -> Column:
    return F.when(value != "", value).otherwise(other)


def _stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(" \n\t"))


def _blocks(text: Column) -> Column:
    """Paragraphs, headings and rules of inline text and block tags, with a blank line between them."""
    out = rewritten(text, "(?is)<h([1-6])(?=[\\s>])[^>]*>.*?</h\\1\\s*>", lambda e: F.concat(F.lit("\n\n"), F.repeat(F.lit("#"), F.substring(e, 3, 1).cast("int")), F.lit(" "), _stripped(F.replace(_inner(e), F.lit(_BREAK), F.lit(" "))), F.lit("\n\n")))
    out = F.regexp_replace(out, "(?i)<hr[^>]*>", "\n\n---\n\n")
    out = F.regexp_replace(out, f"(?i)</?(?:{PARAGRAPHS})(?=[\\s>/])[^>]*>", "\n\n")
    out = F.regexp_replace(out, "(?m)^ (?! )| +$", "")
    return _stripped(F.regexp_replace(out, "\n\\s*\n", "\n\n"))


def _quoted(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "(?m)^", "> "), "(?m) +$", "")


def _list(e: Column) -> Column:
    ordered = F.lower(F.substring(e, 2, 2)) == "ol"
    items = F.filter(F.regexp_extract_all(e, F.lit("(?is)<li(?=[\\s>])[^>]*>(.*?)(?=<li[\\s>]|</li\\s*>|</[ou]l\\s*>)"), F.lit(1)), lambda i: _stripped(i) != "")

    def item(text: Column, k: Column) -> Column:
        mark = F.when(ordered, F.concat((k + 1).cast("string"), F.lit(". "))).otherwise(F.lit("- "))
        body = F.regexp_replace(_blocks(text), "\n+(?=\\s*(?:-|\\d+\\.) )", "\n")
        return F.concat(mark, F.replace(body, F.lit("\n"), F.concat(F.lit("\n"), F.repeat(F.lit(" "), F.length(mark)))))

    return F.concat(F.lit("\n\n"), F.array_join(F.transform(items, item), "\n"), F.lit("\n\n"))


_CELL = "(?is)<t[dh](?=[\\s>])[^>]*>.*?</t[dh]\\s*>"


def _table(e: Column) -> Column:
    rows = F.filter(F.transform(F.regexp_extract_all(e, F.lit("(?is)<tr(?=[\\s>])[^>]*>.*?</tr\\s*>"), F.lit(0)), lambda r: F.regexp_extract_all(r, F.lit(_CELL), F.lit(0))), lambda r: F.size(r) > 0)
    lines = lambda c: F.regexp_replace(F.replace(_blocks(_inner(c)), F.lit(_BREAK), F.lit("\n")), "\\s*\n+\\s*", "\ue010br\ue011")
    width = F.array_max(F.transform(rows, F.size))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(F.transform(r, lines), F.array_repeat(F.lit(""), width - F.size(r))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    plain = F.array_join(F.concat(F.slice(F.transform(rows, line), 1, 1), F.array(rule), F.slice(F.transform(rows, line), F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))), "\n")
    span = lambda c, a: F.when(F.coalesce(F.trim(_first_tag_attribute(c, a)), F.lit("")).isin("", "1"), F.lit("")).otherwise(F.concat(F.lit(f' {a}="'), _first_tag_attribute(c, a), F.lit('"')))
    kept = lambda c: F.concat(F.lit("\ue010"), F.lower(F.substring(c, 2, 2)), span(c, "colspan"), span(c, "rowspan"), F.lit("\ue011"), _blocks(_inner(c)), F.lit("\ue010/"), F.lower(F.substring(c, 2, 2)), F.lit("\ue011"))
    html_rows = F.transform(rows, lambda r: F.concat(F.lit("\ue010tr\ue011\n"), F.array_join(F.transform(r, kept), "\n"), F.lit("\n\ue010/tr\ue011")))
    as_html = F.concat(F.lit("\ue010table\ue011\n"), F.array_join(html_rows, "\n"), F.lit("\n\ue010/table\ue011"))
    # merged cells, or blocks that no line can hold
    heavy = e.rlike("(?is)<t[dh]\\b[^>]*\\s(?:col|row)span\\s*=\\s*[\"']?\\s*(?!1\\D|[\"'])\\d") | e.rlike(f"(?is)<h[1-6][\\s>]|{_FENCED}|\ue010table|\n> ")
    return F.concat(F.lit("\n\n"), F.when(F.size(rows) == 0, F.lit("")).when(heavy, as_html).otherwise(plain), F.lit("\n\n"))


def _macro(e: Column) -> Column:
    name = F.lower(_first_tag_attribute(e, "ac:name"))
    # parameters stand before the body
    head = F.regexp_replace(_inner(e), "(?is)<ac:(?:rich-text|plain-text)-body.*", "")
    pairs = F.regexp_extract_all(head, F.lit("(?is)<ac:parameter(?=[\\s>])[^>]*>.*?</ac:parameter\\s*>"), F.lit(0))
    said = F.transform(pairs, lambda p: F.struct(_first_tag_attribute(p, "ac:name").alias("k"), F.trim(F.regexp_replace(_inner(p), "<[^>]*>", "")).alias("v")))
    value = lambda key: F.coalesce(F.get(F.filter(said, lambda p: p["k"] == key), F.lit(0))["v"], F.lit(""))
    body = F.regexp_extract(e, "(?is)<ac:rich-text-body[^>]*>(.*)</ac:rich-text-body\\s*>", 1)
    plain = F.regexp_extract(e, "(?is)<ac:plain-text-body[^>]*>(.*)</ac:plain-text-body\\s*>", 1)
    shown = F.array_join(F.transform(F.filter(said, lambda p: p["k"] != ""), lambda p: F.concat(p["k"], F.lit("="), p["v"])), "; ")
    names = F.create_map(*(F.lit(x) for pair in PANELS.items() for x in pair))
    block = lambda text: F.concat(F.lit("\n\n"), text, F.lit("\n\n"))
    return (
        F.when(name == "status", F.concat(F.lit("[STATUS: "), value("title"), F.lit("]")))
        .when(name == "anchor", F.lit(""))
        .when((name == "jira") & (value("key") != ""), value("key"))
        .when(e.rlike("(?i)<ac:plain-text-body"), block(F.concat(F.lit(_FENCED), F.translate(plain, _LITERAL + _END, ""), F.lit(_SAYS), value("language"), F.lit(_END))))
        .when(~e.rlike("(?i)<ac:rich-text-body"), block(F.concat(F.lit("[MACRO: "), _or(name, "unnamed"), F.when(shown != "", F.concat(F.lit(" ("), shown, F.lit(")"))).otherwise(F.lit("")), F.lit("]"))))
        .when(names[name].isNotNull(), block(_quoted(F.concat(F.lit("**"), _or(value("title"), names[name]), F.lit("**\n\n"), _blocks(body)))))
        .when(name == "expand", block(F.concat(F.lit("**"), _or(value("title"), "Details"), F.lit("**\n\n"), _blocks(body))))
        .otherwise(block(_blocks(body)))
    )


def _wiki_link(e: Column) -> Column:
    label = F.trim(F.regexp_replace(F.regexp_extract(e, "(?is)<ac:(?:plain-text-)?link-body[^>]*>(.*)</ac:", 1), "<[^>]*>", ""))
    file, title, content = _attribute(e, "ri:filename"), _attribute(e, "ri:content-title"), _attribute(e, "ri:content-id")
    page = F.when(content != "", F.concat(F.lit("corpus-page:id/"), content)).otherwise(F.concat(F.lit("corpus-page:"), _attribute(e, "ri:space-key"), F.lit("/"), title))
    return (
        F.when(e.rlike("(?i)<ri:user"), _user(e))
        .when(e.rlike("(?i)<ri:attachment"), F.concat(F.lit("["), _or(label, file), F.lit("]("), _target(F.concat(F.lit("attachment:"), file)), F.lit(")")))
        .when(e.rlike("(?i)<ri:"), F.concat(F.lit("["), _or(label, title), F.lit("]("), _target(page), F.lit(")")))
        .otherwise(label)
    )


def _user(e: Column) -> Column:
    found = F.coalesce(*(F.nullif(_attribute(e, a), F.lit("")) for a in ("ri:account-id", "ri:userkey", "ri:username")), F.lit("unknown"))
    return F.concat(F.lit("@user:"), found)


def _image(e: Column) -> Column:
    name = _or(_attribute(e, "ri:filename"), _attribute(e, "ri:value"))
    target = F.when(_attribute(e, "ri:filename") != "", F.concat(F.lit("attachment:"), name)).otherwise(name)
    return F.when(name == "", F.lit("")).otherwise(F.concat(F.lit("!["), _or(_first_tag_attribute(e, "ac:alt"), name), F.lit("]("), _target(target), F.lit(")")))


def _anchor(e: Column) -> Column:
    to, label = _first_tag_attribute(e, "href"), F.trim(_inner(e))
    return F.when(to == "", label).otherwise(F.concat(F.lit("["), _or(label, to), F.lit("]("), _target(to), F.lit(")")))


def _task(e: Column) -> Column:
    done = F.trim(F.regexp_extract(e, "(?is)<ac:task-status[^>]*>(.*?)</", 1)) == "complete"
    return F.concat(F.lit("\n- ["), F.when(done, "x").otherwise(" "), F.lit("] "), _stripped(F.regexp_replace(F.regexp_extract(e, "(?is)<ac:task-body[^>]*>(.*)</ac:task-body", 1), "<[^>]*>", "")))


def _fence(code: Column, language: Column | str) -> Column:
    ticks = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(code, F.lit("`+"), F.lit(0)), F.length)), F.lit(0))
    fence = F.repeat(F.lit("`"), F.greatest(F.lit(3), ticks + 1))
    return F.concat(fence, language if isinstance(language, Column) else F.lit(language), F.lit("\n"), F.btrim(code, F.lit("\n")), F.lit("\n"), fence)


def _inside(text: Column, f: Callable[[Column], Column]) -> Column:
    """``text`` with every target replaced by ``f`` of it."""
    pieces = F.split(text, _TARGET, -1)
    first, rest = F.get(pieces, F.lit(0)), F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.concat(first, F.array_join(F.transform(rest, lambda p: F.concat(f(F.substring_index(p, _END, 1)), F.substring(p, F.locate(_END, p) + 1, F.length(p)))), "")) if isinstance(text, Column) else text


def _encoded(target: Column) -> Column:
    """White space and parentheses of wiki targets percent-encoded."""
    plain = F.replace(target, F.lit(" "), F.lit("%20"))
    return F.when(target.startswith("corpus-page:"), F.replace(F.replace(plain, F.lit("("), F.lit("%28")), F.lit(")"), F.lit("%29"))).when(target.startswith("attachment:"), plain).otherwise(target)


def _kept_apart(rows: DataFrame, pattern: str, into: str, mark: str) -> DataFrame:
    """Take what the first group of ``pattern`` holds out of ``body`` into an array, leaving ``mark`` and its number."""
    found, between = F.regexp_extract_all("body", F.lit(pattern), F.lit(1)), F.split("body", pattern, -1)
    numbered = F.array_join(F.transform(between, lambda p, k: F.when(k == 0, p).otherwise(F.concat(F.lit(mark), (k - 1).cast("string"), F.lit(_END), p))), "")
    return rows.withColumn(into, found).withColumn("body", numbered)


def converted_pages(pages: DataFrame) -> DataFrame:
    """(page_id, body, placeholders, warnings) of ``pages(page_id, html)``; a map over rows, nothing is shuffled.

    ``placeholders`` counts macros without a body, ``warnings`` names prefixed tags that have no meaning here; their text
    stays.  A null or empty body gives an empty text.  Private-use characters U+E000 to U+E01F of the input are dropped.
    """
    private = "".join(chr(0xE000 + k) for k in range(32))
    rows = pages.select("page_id", F.translate(text_of(F.col("html")), private, "").alias("body"))
    rows = _kept_apart(rows, "(?s)<!\\[CDATA\\[(.*?)\\]\\]>", "literals", _LITERAL)
    step = lambda c: rows.withColumn("body", c)
    body = F.col("body")
    rows = step(F.regexp_replace(F.regexp_replace(body, "(?s)<!--.*?-->", ""), "(?is)<(head|script|style)(?=[\\s>])[^>]*>.*?</\\1\\s*>", ""))
    rows = _kept_apart(rows, "(?is)<pre(?=[\\s>])[^>]*>(.*?)</pre\\s*>", "pres", f"\n\n{_FENCED}p")
    # text between tags: white space is one space, and what Markdown would read as a mark is escaped
    plain = lambda t: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, "\\s+", " "), "([\\\\`*_\\[\\]>|])", "\\\\$1"), "(&(?:lt|gt);)", "\\\\$1"), "^( ?)([#+-]|\\d+[.)])(?= )", "$1\\\\$2")
    pieces = F.regexp_extract_all("body", F.lit("(?s)<[^>]*>|[^<]+"), F.lit(0))
    rows = step(F.array_join(F.transform(pieces, lambda p: F.when(p.startswith("<") & p.endswith(">"), p).otherwise(plain(p))), ""))
    rows = step(F.regexp_replace(body, f"\n? ?({_FENCED}p\\d+{_END})", "\n\n$1\n\n"))
    rows = step(F.regexp_replace(F.regexp_replace(body, "(?i)<br[^>]*>", _BREAK), "(?i)<ac:emoticon[^>]*ac:name=\"([^\"]*)\"[^>]*>", ":$1:"))
    # code keeps its text unescaped
    rows = step(rewritten(body, _element("code"), lambda e: F.concat(F.lit("`"), F.trim(F.regexp_replace(F.regexp_replace(_inner(e), "<[^>]*>", ""), "\\\\([\\\\`*_\\[\\]>|&])", "$1")), F.lit("`"))))
    for tags, mark in MARKS.items():
        rows = step(F.regexp_replace(body, f"(?is)<({tags})(?=[\\s>])[^>]*>(\\s*)(.*?)(\\s*)</\\1\\s*>", f"$2{mark}$3{mark}$4".replace("~", "\\~")))
    rows = step(F.regexp_replace(body, "(?i)<(/?(?:sub|sup|u))(?:\\s[^>]*)?>", "\ue010$1\ue011"))
    rows = step(rewritten(body, "(?is)<ac:link(?=[\\s>])[^>]*>.*?</ac:link\\s*>", _wiki_link))
    rows = step(rewritten(body, "(?is)<ac:image(?=[\\s>])[^>]*>.*?</ac:image\\s*>", _image))
    rows = step(rewritten(body, "(?is)<ri:user\\b[^>]*>", _user))
    rows = step(rewritten(body, "(?is)<img(?=[\\s>])[^>]*>", lambda e: F.concat(F.lit("!["), _attribute(e, "alt"), F.lit("]("), _target(_attribute(e, "src")), F.lit(")"))))
    rows = step(rewritten(body, _element("a"), _anchor))
    rows = step(rewritten(body, _element("ac:task"), _task))
    rows = step(F.regexp_replace(body, "(?i)<(ac:structured-macro|ac:macro)((?:\\s[^>]*)?)/>", "<$1$2></$1>"))
    for _ in range(DEPTH):
        rows = step(rewritten(body, _element("ul|ol", nested=True), _list))
        rows = step(rewritten(body, _element("table", nested=True), _table))
        rows = step(rewritten(body, _element("ac:structured-macro|ac:macro", nested=True), _macro))
    rows = step(rewritten(body, _element("blockquote"), lambda e: F.concat(F.lit("\n\n"), _quoted(_blocks(_inner(e))), F.lit("\n\n"))))
    prefixed = F.transform(F.regexp_extract_all("body", F.lit("<([A-Za-z]+:[A-Za-z-]+)"), F.lit(1)), F.lower)
    unknown = F.array_sort(F.array_distinct(F.filter(prefixed, lambda t: ~t.isin([*KNOWN, *PARAGRAPHS.split("|")]))))
    rows = rows.withColumn("warnings", F.transform(unknown, lambda t: F.concat(F.lit("unknown tag "), t)))
    rows = step(F.regexp_replace(_blocks(body), "<[^>]*>", ""))
    rows = rows.withColumn("placeholders", F.regexp_count("body", F.lit("(?<!\\\\)\\[MACRO: ")).cast("int"))
    rows = step(F.translate(F.replace(_inside(body, _encoded), F.lit(_BREAK), F.lit("  \n")), "\ue010\ue011", "<>"))
    # what was kept apart comes back: text as it stood, CDATA with its signs escaped once more
    literal = lambda t: F.replace(t, F.lit("&"), F.lit("&amp;"))
    preformatted = F.transform("pres", lambda p: _fence(F.regexp_replace(p, "<[^>]*>", ""), ""))
    number = lambda m: F.regexp_extract(m, "(\\d+)", 1).try_cast("int")
    rows = step(rewritten(body, f"{_FENCED}p\\d+{_END}", lambda m: F.coalesce(F.get(preformatted, number(m)), F.lit(""))))
    code = lambda m: _fence(literal(F.coalesce(F.get("literals", number(F.substring_index(m, _SAYS, 1))), F.regexp_extract(m, f"{_FENCED}([^{_SAYS}]*)", 1))), F.regexp_extract(m, f"{_SAYS}([^{_END}]*)", 1))
    rows = step(rewritten(body, f"(?s){_FENCED}[^{_SAYS}{_END}]*{_SAYS}[^{_END}]*{_END}", code))
    rows = step(rewritten(body, f"{_LITERAL}\\d+{_END}", lambda m: literal(F.coalesce(F.get("literals", number(m)), F.lit("")))))
    return rows.select("page_id", unescape_entities(_stripped(F.regexp_replace(body, "\n{3,}", "\n\n"))).alias("body"), "placeholders", "warnings")
