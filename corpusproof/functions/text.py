"""Column functions on text: quotes, citations, numbers, secrets, ticket keys, tokens, front matter, links.

All are Catalyst expressions.  Null text counts as empty unless a function says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_of(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value.cast("string"), F.lit(""))


def squeeze(text: Column) -> Column:
    """White space runs become one space, none at the ends."""
    return F.trim(F.regexp_replace(text_of(text), "(?U)\\s+", " "))


def quote_form(text: Column) -> Column:
    """A text as quotes are compared: straight quotes, no Markdown marks, one space, lower case."""
    plain = F.translate(text_of(text), " ‘’“”", " ''\"\"")
    plain = F.regexp_replace(plain, "<br\\s*/?>", " ")
    return F.lower(squeeze(F.regexp_replace(plain, "[\\\\*`_|>#]", "")))


def quote_in(quote: Column, text: Column) -> Column:
    """Whether a quote that is not blank occurs in the text; both are normalised here."""
    form = quote_form(quote)
    return (form != "") & quote_form(text).contains(form)


def word_count(text: Column) -> Column:
    return F.regexp_count(text_of(text), F.lit("(?U)\\S+"))


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of letters, digits and underscores of any script."""
    return F.transform(F.regexp_extract_all(text_of(text), F.lit("(?U)\\w+"), F.lit(0)), lambda w: F.lower(w))


def slug(ascii_title: Column, most: int = 60) -> Column:
    """File-name form of a title that is already reduced to ASCII."""
    short = F.lower(F.regexp_replace(F.regexp_replace(text_of(ascii_title), "[^A-Za-z0-9]+", "-"), "^-+|-+$", ""))
    cut = F.regexp_replace(F.substring(short, 1, most), "^-+|-+$", "")
    return F.when(cut == "", F.lit("page")).otherwise(cut)


def page_file(page_id: Column, title_slug: Column) -> Column:
    return F.concat(page_id.cast("string"), F.lit("-"), title_slug, F.lit(".md"))


def numbers_in(text: Column) -> Column:
    """Distinct numbers of two or more digits, commas and closing dots dropped."""
    found = F.regexp_extract_all(text_of(text), F.lit("(?U)(?<![\\w.])\\d[\\d,.]*(?!\\w)"), F.lit(0))
    plain = F.transform(found, lambda n: F.regexp_replace(F.translate(n, ",", ""), "[.]+$", ""))
    return F.array_distinct(F.filter(plain, lambda n: F.length(F.regexp_replace(n, "[^0-9]", "")) >= 2))


# fixed values: acronyms that need no evidence
COMMON_ACRONYMS = """API APIS SLA SLAS SLO SLOS KPI KPIS OKR OKRS ETL ELT UI UX ID IDS FAQ PDF CSV SQL JSON XML URL URLS OK
TBD TBC NA QA UAT PR PRS CI CD IT HR BAU POC MVP RACI ADR ADRS PII GDPR SME SMES AI ML BI DB DBA OS VPN SSO MFA
NOTE TODO AND OR NOT USD EUR GBP UTC CET EST PST AM PM""".split()


def without_citations(block: Column) -> Column:
    """A block without page citations, link targets and its list mark."""
    plain = F.regexp_replace(text_of(block), "\\[p:[A-Za-z0-9_-]+\\]", " ")
    plain = F.regexp_replace(plain, "\\]\\([^)]*\\)", "]")
    return F.regexp_replace(plain, "^\\s*(?:[-*+]|\\d+[.)])\\s+", "")


def acronyms_in(text: Column) -> Column:
    found = F.regexp_extract_all(text_of(text), F.lit("(?<![A-Za-z0-9_])[A-Z][A-Z0-9]+s?(?![A-Za-z0-9_])"), F.lit(0))
    plain = F.transform(found, lambda a: F.regexp_replace(a, "s$", ""))
    return F.array_except(F.array_distinct(F.filter(plain, lambda a: F.length(F.regexp_replace(a, "[^A-Z]", "")) >= 2)), F.array(*map(F.lit, COMMON_ACRONYMS)))


def names_in(text: Column) -> Column:
    """Names in back ticks, snake_case and CamelCase names."""
    plain = text_of(text)
    ticked = F.regexp_extract_all(plain, F.lit("`([^`\\n]+)`"), F.lit(1))
    snake = F.regexp_extract_all(plain, F.lit("(?<![A-Za-z0-9_])[A-Za-z][A-Za-z0-9]*(?:_[A-Za-z0-9]+)+(?![A-Za-z0-9_])"), F.lit(0))
    camel = F.regexp_extract_all(plain, F.lit("(?<![A-Za-z0-9_])(?:[A-Z][a-z0-9]+){2,}(?![A-Za-z0-9_])"), F.lit(0))
    return F.array_distinct(F.concat(ticked, snake, camel))


def long_quotes_in(text: Column) -> Column:
    """Quoted passages of 12 or more characters and three or more words."""
    found = F.regexp_extract_all(F.translate(text_of(text), "“”", '""'), F.lit('"([^"\\n]{12,})"'), F.lit(1))
    return F.array_distinct(F.filter(found, lambda q: word_count(q) >= 3))


def specifics(block: Column) -> Column:
    """struct of arrays: the numbers, acronyms, names and quotes that a block must ground in its sources."""
    plain = without_citations(block)
    return F.struct(numbers_in(plain).alias("numbers"), acronyms_in(plain).alias("acronyms"), names_in(plain).alias("names"), long_quotes_in(plain).alias("quotes"))


def source_citations(text: Column) -> Column:
    """array of (path, start, end) cited as ``(src: path:LINE)`` or ``(src: path:LINE-LINE)``."""
    found = F.regexp_extract_all(text_of(text), F.lit("\\(src:\\s*[^:()]+?:\\d+(?:-\\d+)?\\)"), F.lit(0))
    shape = "\\(src:\\s*([^:()]+?):(\\d+)(?:-(\\d+))?\\)"

    def parsed(c: Column) -> Column:
        start = F.regexp_extract(c, shape, 2)
        end = F.regexp_extract(c, shape, 3)
        return F.struct(F.trim(F.regexp_extract(c, shape, 1)).alias("path"), start.try_cast("bigint").alias("start"), F.when(end == "", start).otherwise(end).try_cast("bigint").alias("end"))

    return F.transform(found, parsed)


def field_citation(value: Column) -> Column:
    """(repo, path, start, end) of ``[repo:]path:LINE[-LINE]``; null if malformed, repo null if absent."""
    shape = "^(?:([^:]+):)?([^:]+):(\\d+)(?:-(\\d+))?$"
    plain = F.trim(text_of(value))
    repo, end = F.regexp_extract(plain, shape, 1), F.regexp_extract(plain, shape, 4)
    start = F.regexp_extract(plain, shape, 3)
    found = F.struct(F.nullif(repo, F.lit("")).alias("repo"), F.trim(F.regexp_extract(plain, shape, 2)).alias("path"), start.try_cast("bigint").alias("start"), F.when(end == "", start).otherwise(end).try_cast("bigint").alias("end"))
    return F.when(plain.rlike(shape), found)


def page_citations(text: Column) -> Column:
    return F.regexp_extract_all(text_of(text), F.lit("\\[p:([A-Za-z0-9_-]+)\\]"), F.lit(1))


# fixed values: kinds of secrets and their patterns
SECRETS = [
    ("AWS access key", "\\bAKIA[0-9A-Z]{16}\\b"),
    ("private key block", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    ("GitHub token", "\\bgh[pousr]_[A-Za-z0-9]{36,}\\b"),
    ("Slack token", "\\bxox[baprs]-[A-Za-z0-9-]{10,}\\b"),
    ("Atlassian API token", "\\bATATT[A-Za-z0-9_\\-=]{20,}\\b"),
    ("bearer token", "\\bBearer\\s+[A-Za-z0-9_\\-.=]{30,}\\b"),
    ("password assignment", "(?i)\\b(password|passwd|secret|api[_-]?key|token)\\b\\s*[:=]\\s*['\"][^'\"\\s<\\[{$]{8,}['\"]"),
]


def secrets_in(text: Column) -> Column:
    """Labels of the kinds of secrets found, in their fixed order."""
    plain = text_of(text)
    return F.array_compact(F.array(*(F.when(plain.rlike(pattern), F.lit(label)) for label, pattern in SECRETS)))


def redacted(text: Column) -> Column:
    """The text with each secret replaced; lines stay where they are."""
    plain = text_of(text)
    for _, pattern in SECRETS:
        plain = F.regexp_replace(plain, pattern, "[REDACTED]")
    return plain


def secret_places(text: Column) -> Column:
    """array of (line, start, end, label) of the secrets, in order: lines count from 1, characters of the whole text from 0.

    A secret inside or across another is part of the one that begins first (of two that begin together, the longer).
    """
    plain = text_of(text)
    kind = "array<struct<start:int,less:int,label:string>>"

    def matches(label: str, pattern: str) -> Column:
        found = F.regexp_extract_all(plain, F.lit(pattern), F.lit(0))
        between = F.transform(F.split(plain, pattern, -1), F.length)
        sizes = F.transform(found, F.length)
        sum_of = lambda numbers: F.aggregate(numbers, F.lit(0), lambda a, b: a + b)
        start = lambda i: sum_of(F.slice(between, F.lit(1), i + 1)) + sum_of(F.slice(sizes, F.lit(1), i))
        at = F.transform(found, lambda m, i: F.struct(start(i).alias("start"), (-F.length(m)).alias("less"), F.lit(label).alias("label")))
        return F.when(plain.rlike(pattern), at).otherwise(F.array().cast(kind))

    def keep(kept: Column, x: Column) -> Column:
        last = F.element_at(kept, -1)
        return F.when((F.size(kept) == 0) | (x["start"] >= last["start"] - last["less"]), F.concat(kept, F.array(x))).otherwise(kept)

    every = F.array_sort(F.concat(*(matches(*s) for s in SECRETS)))
    line = lambda x: F.regexp_count(F.substring(plain, F.lit(1), x["start"]), F.lit("\n")).cast("int") + 1
    return F.transform(F.aggregate(every, F.array().cast(kind), keep), lambda x: F.struct(line(x).alias("line"), x["start"].alias("start"), (x["start"] - x["less"]).alias("end"), x["label"].alias("label")))


def redacted_at(text: Column, places: Column) -> Column:
    """The text with each of ``places`` (see ``secret_places``) replaced."""
    plain = text_of(text)
    state = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    step = lambda s, p: F.struct(F.concat(s["done"], F.substring(plain, s["at"] + 1, p["start"] - s["at"]), F.lit("[REDACTED]")).alias("done"), p["end"].alias("at"))
    end = F.aggregate(places, state, step)
    return F.concat(end["done"], F.substring(plain, end["at"] + 1, F.length(plain)))


def ticket_keys(text: Column, projects: Iterable[str]) -> Column:
    """Ticket keys of the given projects, not touching letters or digits."""
    names = "|".join(sorted(set(projects), key=lambda p: (-len(p), p)))
    return F.regexp_extract_all(text_of(text), F.lit(f"(?<![A-Za-z0-9])(?:{names})-[1-9][0-9]{{0,6}}(?![A-Za-z0-9])"), F.lit(0))


def token_parts(line: Column) -> Column:
    """Distinct lower-case identifiers of a line: each token, its pieces between slashes, and adjacent pairs of them."""
    raw = F.regexp_extract_all(text_of(line), F.lit("[A-Za-z0-9_.\\-/:@]+"), F.lit(0))
    split = F.flatten(F.transform(raw, lambda t: F.split(t, "[:@]")))
    trim = lambda t: F.regexp_replace(F.regexp_replace(F.regexp_replace(t, "^[./-]+|[./-]+$", ""), "\\.git$", ""), "^[./-]+|[./-]+$", "")
    whole = F.filter(F.transform(split, trim), lambda t: t != "")

    def parts(t: Column) -> Column:
        pieces = F.filter(F.split(t, "/"), lambda x: x != "")
        pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(1))), lambda i: F.concat_ws("/", F.get(pieces, i - 1), F.get(pieces, i)))
        return F.concat(F.array(t), F.when(F.size(pieces) > 1, F.concat(pieces, pairs)).otherwise(F.array().cast("array<string>")))

    return F.array_distinct(F.transform(F.flatten(F.transform(whole, parts)), lambda t: F.lower(t)))


def front_matter(text: Column) -> Column:
    """(fields, body) of a page that begins with a ``---`` block; null without one.  Values keep their JSON quoting undone."""
    shape = "(?s)^---\\n(.*?)\\n---\\n?(.*)$"
    plain = text_of(text)
    lines = F.filter(F.split(F.regexp_extract(plain, shape, 1), "\\n"), lambda x: x.contains(":"))
    key = F.transform(lines, lambda x: F.trim(F.substring_index(x, ":", 1)))

    def value(x: Column) -> Column:
        raw = F.trim(F.regexp_replace(x, "^[^:]*:", ""))
        quoted = F.from_json(F.concat(F.lit('{"v":'), raw, F.lit("}")), "struct<v:string>")["v"]
        return F.coalesce(quoted, raw)

    return F.when(plain.rlike("(?s)^---\\n.*?\\n---(\\n|$)"), F.struct(F.map_from_entries(F.array_distinct(F.arrays_zip(key.alias("key"), F.transform(lines, value).alias("value")))).alias("fields"), F.regexp_extract(plain, shape, 2).alias("body")))


def build_front_matter(fields: dict[str, Column]) -> Column:
    """A ``---`` block of ``key: "value"`` lines; values are JSON strings."""
    quoted = [F.concat(F.lit(f"{k}: "), F.regexp_extract(F.to_json(F.struct(text_of(v).alias("v"))), "(?s)^\\{\"v\":(.*)\\}$", 1)) for k, v in fields.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *quoted), F.lit("\n---\n"))


def without_title(body: Column) -> Column:
    """The body without a leading ``# title`` line."""
    return F.regexp_replace(text_of(body), "^\\s*# [^\\n]*\\n?", "")


def headings_in(markdown: Column) -> Column:
    """Headings (also quoted ones) of a Markdown page, in the form that quotes are compared in."""
    found = F.regexp_extract_all(text_of(markdown), F.lit("(?m)^[ \\t>]*#{1,6}[ \\t]+(.+)$"), F.lit(1))
    return F.transform(found, quote_form)


def markdown_links(outside_fences: Column) -> Column:
    """array of (image, target, kind) of links in text outside fences.

    kind: outside (a page that is not in the corpus), attachment, external (has a scheme), page (a .md file) or other.
    """
    found = F.regexp_extract_all(text_of(outside_fences), F.lit("!?\\[[^\\]]*\\]\\([^)\\s]+"), F.lit(0))

    def one(x: Column) -> Column:
        target = F.regexp_replace(x, "(?s)^!?\\[[^\\]]*\\]\\(<?|>$", "")
        kind = F.when(target.startswith("outside://"), "outside").when(target.contains("attachments/"), "attachment").when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), "external").when(target.rlike("\\.md(#|$)"), "page").otherwise("other")
        return F.struct(x.startswith("!").alias("image"), target.alias("target"), kind.alias("kind"))

    return F.transform(found, one)


def leftover_markup(outside_fences: Column) -> Column:
    """Distinct source tags with a prefix that are still in converted text."""
    return F.array_distinct(F.regexp_extract_all(text_of(outside_fences), F.lit("</?((?:ac|ri|at):[A-Za-z-]+)"), F.lit(1)))


# fixed values: elements whose content no reader sees
INVISIBLE_TAGS = ["head", "ac:placeholder", "ac:task-id", "ac:task-uuid", "ac:task-status", "script", "style", "title"]


def visible_text(html: Column) -> Column:
    """Text that a reader of raw HTML sees, entities still in place: what CDATA holds escaped, invisible elements and parameters dropped."""
    plain = F.regexp_replace(escaped_cdata(html), "(?s)<!--.*?-->", " ")
    plain = F.regexp_replace(plain, "(?is)<(" + "|".join(INVISIBLE_TAGS) + ")(?=[\\s>])[^>]*>.*?</\\1\\s*>", " ")
    plain = F.regexp_replace(plain, "(?is)<ac:parameter\\b(?![^>]*ac:name=\"title\")[^>]*>.*?</ac:parameter>", " ")
    return F.regexp_replace(plain, "<[^>]*>", " ")


def escaped_cdata(html: Column) -> Column:
    """Raw HTML in which the content of each CDATA section is ordinary escaped text, so that code in it is no markup."""
    pieces = F.split(text_of(html), "<!\\[CDATA\\[")
    escape = lambda t: F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    closed = lambda p: F.concat(escape(F.substring_index(p, "]]>", 1)), F.regexp_replace(p, "(?s)^.*?\\]\\]>", ""))
    after = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p: F.when(p.contains("]]>"), closed(p)).otherwise(F.concat(F.lit("<![CDATA["), p)))
    return F.when(text_of(html).contains("<![CDATA["), F.concat(F.get(pieces, F.lit(0)), F.array_join(after, ""))).otherwise(text_of(html))


def tag_counts(html: Column, tag: str) -> tuple[Column, Column]:
    """(opening, closing) tags; self-closed ones are not counted as open."""
    plain = text_of(html)
    return F.regexp_count(plain, F.lit(f"(?i)<{tag}(?:\\s[^>]*)?(?<!/)>")), F.regexp_count(plain, F.lit(f"(?i)</{tag}\\s*>"))


def unescaped(text: Column) -> Column:
    """Backslash escapes undone."""
    return F.regexp_replace(text_of(text), "(?s)\\\\(.)", "$1")


def mentions(text: Column, name: str) -> Column:
    """Whether a name occurs, case as given, not touching letters or digits, in unescaped text."""
    import re

    return unescaped(text).rlike(f"(?<![A-Za-z0-9]){re.escape(name)}(?![A-Za-z0-9])")


def bare_block(block: Column) -> Column:
    return F.trim(F.regexp_replace(text_of(block), "^\\s*(?:[-*+]|\\d+[.)])\\s+", ""))


def is_exempt(block: Column) -> Column:
    """Blocks that need no citation: "not documented ...", "none"."""
    plain = F.lower(F.trim(F.regexp_replace(bare_block(block), "\\[p:[A-Za-z0-9_-]+\\]", "")))
    return plain.startswith("not documented") | plain.isin("none", "none.")


def repo_folder(repo: Column) -> Column:
    return F.replace(text_of(repo), F.lit("/"), F.lit("__"))


def linked_tickets(parent: Column, epic: Column, links: Column) -> Column:
    """Valid keys among a ticket's parent, epic and links, upper-cased, in that order."""
    keys = F.concat(F.array(parent, epic), F.coalesce(F.transform(links, lambda x: x["key"]), F.array().cast("array<string>")))
    plain = F.transform(keys, lambda k: F.upper(F.trim(text_of(k))))
    return F.array_distinct(F.filter(plain, lambda k: k.rlike("^[A-Z][A-Z0-9_]*-\\d+$")))


def ticket_text(summary: Column, description: Column, criteria: Column, comments: Column) -> Column:
    return F.concat_ws("\n", F.array(text_of(summary), text_of(description), text_of(criteria)), F.transform(comments, lambda c: text_of(c["body"])))


def commit_records(log: Column) -> Column:
    """array of (hash, message) from records split by U+001E with fields split by U+001F."""
    records = F.filter(F.split(text_of(log), "\u001e"), lambda r: F.trim(r) != "")
    return F.transform(records, lambda r: F.struct(F.btrim(F.substring_index(r, "\u001f", 1), F.lit(" \n\r\t")).alias("hash"), F.when(r.contains("\u001f"), F.regexp_replace(r, "(?s)^[^\u001f]*\u001f", "")).otherwise(F.lit("")).alias("message")))


def node_id(name: Column) -> Column:
    return F.regexp_replace(text_of(name), "[^A-Za-z0-9_]", "_")


def percent_encoded(value: Column, keep_slash: bool = False) -> Column:
    """URL encoding of a path part: space as %20, ``~`` kept, ``*`` escaped, ``/`` kept on request."""
    plain = F.replace(F.replace(F.replace(F.url_encode(text_of(value)), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.replace(plain, F.lit("%2F"), F.lit("/")) if keep_slash else plain


def attachment_url(page_id: Column, filename: Column) -> Column:
    return F.concat(F.lit("attachments/"), page_id.cast("string"), F.lit("/"), percent_encoded(filename, keep_slash=True))


def demoted_headings(line: Column) -> Column:
    """A heading line one level down; other lines unchanged."""
    return F.regexp_replace(text_of(line), "^(#{1,5}) ", "$1# ")
