"""Main text of web pages by template deduction over the pages of one host.

A token is an opening tag with the path of tags (and class names) above it. Its occurrence vector says how
often it stands on each page of the host; tokens with equal vectors below one parent form an equivalence class. A class
is kept if it is frequent (on at least half of the host's pages) and nested (what encloses its tokens is kept as well); the kept
classes are the host's template, and what lies between template tokens are its slots. The template's content
root is the element for articles, or else the innermost template element that holds most of the slots' text.
A slot whose text is the same on all pages, while the root's is not, is template text too, whatever the number of pages;
but no slot of an element for articles is dropped, and a heading (h1 to h6) stays where other text below its parent differs
between pages: it then heads a section of the main text.

Of each page, the slots under the content root are extracted, without what is marked as menu, header, footer,
sidebar, notice, advert, form, script, style or comments. A page chooses its own root in the same way if it lacks the host's,
has its own elements for articles, holds most of its text in elements that are neither in the host's template nor below its
root (another layout), or if the host's root is no more than the whole page while the page's own is not in the template.

Vectors are never gathered: tokens of a page are rows, and the fingerprint of a vector is the exclusive or of the hashes
of (page, count), combined before the shuffle. So a host with a third of all pages is a few rows per
token and task. Per host only the frequent tokens are brought together, at most about twice as many as a
page has. Templates reach the pages by broadcast while they are measured to be small, otherwise by a join on the
host and a salt.

Defined results: null and empty pages give the empty text; pages without a host share one group; a page alone
on its host is its own template; repeated rows each give the same text; broken markup is closed as browsers do.
"""

from __future__ import annotations

import hashlib
import html
import re
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsefold.llm.tables import own_columns, stored


@dataclass(frozen=True)
class Settings:
    support: float = 0.5
    share: float = 0.7
    broadcast_tokens: int = 500_000
    salts: int = 16


# Elements by their part in a page, and class words that mark what is no main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
BESIDE = frozenset(
    "nav footer aside form script style noscript template iframe svg canvas object button select textarea input dialog head title menu".split())
CONTENT = frozenset({"article", "main"})
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer cookie cookies consent notice notices alert gdpr newsletter subscribe subscription signup "
    "share sharing social comment comments reply replies disqus related recommended recommendations popup modal toolbar pagination pager".split())
HEADS = frozenset({"header", "masthead"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())

TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|noscript|template|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|[^<]+|<", re.DOTALL | re.IGNORECASE)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")


class Node:
    """An open element: its tag, its token, and if it is beside the main text, inside an element for it or inside a heading."""

    __slots__ = ("tag", "token", "parent", "beside", "content", "heading")

    def __init__(self, tag: str, token: int, parent: int, beside: bool, content: bool, heading: bool):
        self.tag, self.token, self.parent, self.beside, self.content, self.heading = tag, token, parent, beside, content, heading


TOP = Node("", 0, 0, False, False, False)


class Reader:
    """Walks pages; tokens seen once are remembered."""

    def __init__(self):
        self.seen: dict[tuple[int, str, str], tuple[int, bool, bool]] = {}

    def open(self, above: Node, tag: str, attributes: str) -> Node:
        key = (above.token, tag, attributes if "class" in attributes or "role" in attributes or "id" in attributes else "")
        known = self.seen.get(key)
        if known is None:
            if len(self.seen) > 200_000:
                self.seen.clear()
            named = {name.lower(): (a or b or c).lower() for name, a, b, c in ATTRIBUTE.findall(key[2])}
            words = set(WORD.findall(named.get("class", "") + " " + named.get("id", "")))
            beside = tag in BESIDE or bool(words & MARKS) or named.get("role") in ROLES
            name = f"{above.token}>{tag}.{' '.join(sorted(WORD.findall(named.get('class', ''))))}"
            known = self.seen[key] = (int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "big", signed=True), beside, tag == "header" or bool(words & HEADS))
        token, beside, head = known
        # A header inside an article is the article's own.
        if head and not above.content:
            beside = True
        return Node(tag, token, above.token, above.beside or beside, above.content or tag in CONTENT, above.heading or tag in HEADINGS)

    def walk(self, page: str):
        """("open", node), ("close", node) and ("text", node stack, text) in page order."""
        stack = [TOP]
        for match in TOKENS.finditer(page):
            tag = match[3]
            if tag is None:
                found = match[0]
                if found[0] != "<" or found == "<":
                    yield "text", stack, found
                continue
            tag = tag.lower()
            if match[2]:
                if any(node.tag == tag for node in stack):
                    while True:
                        node = stack.pop()
                        yield "close", node, ""
                        if node.tag == tag:
                            break
                continue
            # A paragraph ends where a block begins, an item where the next one does.
            ends = {"p"} if tag in BLOCK else set()
            ends |= {tag} & {"li", "dt", "dd", "option", "tr", "td", "th"}
            if ends:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in ends:
                        while len(stack) > k:
                            yield "close", stack.pop(), ""
                        break
                    if stack[k].tag in BLOCK and stack[k].tag not in ends:
                        break
            node = self.open(stack[-1], tag, match[4])
            if tag not in VOID and not match[4].endswith("/"):
                stack.append(node)
            yield "open", node, ""

    def tokens(self, page: str) -> dict[int, list]:
        """token -> parent, occurrences, order, beside, content, characters of main text under it, its own text, within a heading."""
        found: dict[int, list] = {}
        for what, node, text in self.walk(page):
            if what == "open":
                row = found.setdefault(node.token, [node.parent, 0, len(found), node.beside, node.tag in CONTENT, 0, [], node.heading])
                row[1] += 1
            elif what == "text" and len(node) > 1 and (words := text.split()):
                found[node[-1].token][6].append(" ".join(words))
                if not node[-1].beside:
                    for above in {x.token for x in node[1:]}:
                        found[above][5] += sum(map(len, words))
        return found

    def extract(self, page: str, roots: set[int], fixed: set[int]) -> str:
        """Blocks of main text under `roots`, without slots of fixed text."""
        blocks, current = [], []

        def end():
            if text := " ".join("".join(current).split()):
                blocks.append(text)
            current.clear()

        for what, node, text in self.walk(page):
            if what == "text":
                if not node[-1].beside and node[-1].token not in fixed and any(x.token in roots for x in node):
                    current.append(html.unescape(text))
            elif node.tag in BLOCK:
                end()
            elif node.tag == "br":
                current.append(" ")
        end()
        return "\n".join(blocks)


def choose(rows: dict[int, tuple[int, bool, bool, int]], share: float) -> list[int]:
    """The content root among tokens (parent, beside, content, characters)."""
    own = [t for t, (_, beside, content, size) in rows.items() if content and not beside and size]
    if own:
        return [t for t in own if not _above(t, rows, set(own))]
    best, size = 0, max((x[3] for t, x in rows.items() if x[0] == 0), default=0)
    while size:
        inner = [(x[3], t) for t, x in rows.items() if x[0] == best and not x[1]]
        if not inner or max(inner)[0] < share * size:
            break
        # A single block of text is a slot, not the root of slots.
        if best and not any(x[0] == max(inner)[1] and x[3] for x in rows.values()):
            break
        size, best = max(inner)
    return [best]


def page_roots(rows: dict[int, tuple[int, bool, bool, int]], roots: set[int], kept: set[int], share: float) -> list[int]:
    """The content root of one page with these tokens, on a host with these roots and template tokens."""
    mine = choose(rows, share)
    articles = any(rows[t][2] for t in mine if t)
    held = set(mine) if articles else {t for t in roots if t in rows and not rows[t][1] and rows[t][3]} or roots & {0}
    if not held:
        return mine
    # Text of elements that the template does not know, against the text below the root.
    own = {t: 0 if x[1] else x[3] for t, x in rows.items()}
    for x in rows.values():
        if x[0] in own and not x[1]:
            own[x[0]] -= x[3]
    outside = 0 if 0 in held else sum(size for t, size in own.items() if size > 0 and t not in kept and t not in held and not _above(t, rows, held))
    inside = sum(rows[t][3] for t in held if t)
    if held <= roots and inside < (1 - share) * (inside + outside):
        # Another layout, where the host's root is a teaser.
        return choose({t: (x[0], x[1], False, x[3]) for t, x in rows.items()}, share)
    if articles:
        return mine
    whole = {0} | {t for t, x in rows.items() if x[0] == 0 or (x[0] in rows and rows[x[0]][0] == 0)}
    if held <= whole and mine[0] not in kept | whole:
        return mine
    return sorted(held)


def _above(token: int, rows: dict, wanted: set[int]) -> bool:
    parent = rows[token][0]
    while parent in rows:
        if parent in wanted:
            return True
        parent = rows[parent][0]
    return False


def _all_above(token: int, rows: dict) -> list[int]:
    out = []
    while (token := rows[token][0]) in rows:
        out.append(token)
    return out


def deduce(tokens: DataFrame, settings: Settings) -> DataFrame:
    """host, roots, fixed, kept: the content root, the fixed slots and all tokens of every host's template."""
    pages = tokens.where("token = 0").groupBy("host").agg(F.count("*").alias("pages"))
    vectors = tokens.where("token <> 0").groupBy("host", "token").agg(
        F.bit_xor(F.xxhash64("page", "count")).alias("vector"), F.count("*").alias("support"),
        F.min("parent").alias("parent"), F.avg("place").alias("place"), F.max("beside").alias("beside"), F.max("content").alias("content"),
        F.max("heading").alias("heading"), F.avg("chars").alias("chars"), (F.min("own") == F.max("own")).alias("same"))
    frequent = vectors.join(pages, "host").where(F.col("support") >= settings.support * F.col("pages"))

    def nest(pdf: pd.DataFrame) -> pd.DataFrame:
        kept: dict[int, tuple[int, bool, bool, int]] = {}
        # From the top: an element that stands once below a repeated one has the vector of what encloses both, so a class
        # is split by the parents of its tokens, and none waits for another that waits for it.
        below: dict[int, list] = {}
        for (parent, _), rows in pdf.sort_values("place").groupby(["parent", "vector"], sort=False):
            below.setdefault(parent, []).append(rows)
        open_at = [0]
        while open_at:
            for rows in below.pop(open_at.pop(), ()):
                for r in rows.itertuples():
                    kept[r.token] = (r.parent, bool(r.beside), bool(r.content), float(r.chars))
                    open_at.append(r.token)
        roots = choose(kept, settings.share)
        table = pdf.set_index("token")
        # Text that stands on all pages alike, if the root's text as a whole does not.
        whole = table["pages"].iloc[0]
        varies = any(not table.loc[t, "same"] for t in kept if t in roots or _above(t, kept, set(roots)))
        articles = {t for t, x in kept.items() if x[2]}
        # Headings stay where a section does: something else below the same parent varies.
        headings = {t for t in kept if table.loc[t, "heading"]}
        told = {t for t in kept if t not in headings and not kept[t][1] and not table.loc[t, "same"]}
        sections = told | {p for t in told for p in _all_above(t, kept)}

        def heads(t: int) -> bool:
            while kept[t][0] in headings:
                t = kept[t][0]
            return kept[t][0] in sections

        fixed = [t for t in kept if varies and table.loc[t, "same"] and table.loc[t, "support"] == whole
                 and t not in articles and not _above(t, kept, articles) and not (t in headings and heads(t))]
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "roots": [roots], "fixed": [fixed], "kept": [list(kept)]})

    return frequent.groupBy("host").applyInPandas(nest, "host string, roots array<long>, fixed array<long>, kept array<long>")


def main_text(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """page_id, url, text, n_chars for every row of `pages` (page_id, url, html)."""
    rows = own_columns(pages, "page_id", "url", "html")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = rows.withColumn("host", host)

    def tokenised(batches):
        reader = Reader()
        schema = pa.schema([("host", pa.string()), ("page", pa.int64()), ("token", pa.int64()), ("parent", pa.int64()), ("count", pa.int64()),
                            ("place", pa.int64()), ("beside", pa.bool_()), ("content", pa.bool_()), ("chars", pa.int64()), ("own", pa.int64()), ("heading", pa.bool_())])
        for batch in batches:
            for begin in range(0, len(batch), 500):
                out = [[] for _ in schema]
                for host, page, text in zip(*(c.to_pylist() for c in batch.slice(begin, 500).columns), strict=True):
                    found = {0: [0, 1, -1, False, False, 0, [], False]} | reader.tokens(text or "")
                    for token, (parent, count, place, beside, content, chars, own, heading) in found.items():
                        own = int.from_bytes(hashlib.blake2b("\n".join(own).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True) if own else 0
                        for column, value in zip(out, (host, page, token, parent, count, place, beside, content, chars, own, heading), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    tokens = rows.select("host", F.xxhash64("page_id", "html").alias("page"), "html").mapInArrow(
        tokenised, "host string, page long, token long, parent long, count long, place long, beside boolean, content boolean, chars long, own long, heading boolean")
    tokens = stored(tokens, "page-tokens")
    templates = stored(deduce(tokens, settings), "templates")
    size = templates.agg(F.sum(F.size("roots") + F.size("fixed") + F.size("kept") + 1)).first()[0] or 0
    if size <= settings.broadcast_tokens:
        joined = rows.join(F.broadcast(templates), "host", "left")
    else:
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(settings.salts)))
        copies = templates.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(settings.salts - 1).cast("long"))))
        joined = salted.join(copies, ["host", "salt"], "left")

    def extracted(batches):
        reader = Reader()
        for batch in batches:
            for begin in range(0, len(batch), 500):
                part = batch.slice(begin, 500)
                texts = []
                for page, roots, fixed, kept in zip(*(part.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True):
                    text = ""
                    if page:
                        own = {t: (x[0], x[3], x[4], x[5]) for t, x in reader.tokens(page).items()}
                        text = reader.extract(page, set(page_roots(own, set(roots or ()), set(kept or ()), settings.share)), set(fixed or ()))
                        if not text:
                            text = reader.extract(page, set(choose(own, settings.share)), set())
                    texts.append(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "roots", "fixed", "kept").mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
