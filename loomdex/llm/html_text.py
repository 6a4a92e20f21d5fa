"""Main text of web pages by equivalence classes of tokens across the pages of a host.

1. A page is read into tokens: its structural elements, told apart by their path, and its blocks of text.
   Each token has an occurrence vector over the host's pages; the sum of a hash of (page, count) stands for it, and is
   combined in the tasks before the shuffle, so a host with a third of all pages loads no task.
2. Tokens that share a vector and stand on at least half of the host's pages form a class. Classes of elements
   nest by their paths into the host's template; blocks of text in a class are the template's own text.
3. What the template leaves open are slots. The main or article element with most text in its slots is the host's main
   element; without any, the innermost one that holds all slots' text is. A page that lacks it is judged by its own elements alone.
4. Of each page, the blocks inside of the main element are kept in order, except elements that are menus, headers,
   footers, sidebars, notices, adverts, forms or comments by tag, role or class (unless they hold all of main), and nested divisions that hold template text only.

A page is parsed once, into a kept table of its blocks.

Null and empty pages give an empty text. Pages without an address are one host. Repeated pages are extracted each; their
text stays, as pages of a host that say the same outside of noise count once in 1 to 3. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomdex.llm.common import keep, per_task

#: Quotes hold a value only right after an equals sign; elsewhere they are characters like others.
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*))>""", re.S)
CLASS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""\shidden(?=[\s=/]|$)|\saria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
SPACE = re.compile(r"\s+")
STRUCTURE = frozenset(
    "html body main article section div nav header footer aside form fieldset ul ol dl table figure details dialog menu head search".split()
)
BLOCKS = STRUCTURE | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption blockquote pre hr address figcaption summary center legend option title".split()
)
#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template iframe svg math canvas object textarea select button audio video".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
NOISE_TAGS = frozenset("nav footer menu head search".split())
#: Noise unless all text stands in them, as where one form wraps the page.
WRAPPING_TAGS = frozenset("aside form dialog".split())
#: Words in class, id or role that mark what is not the article (fixed values).
NOISE_WORDS = frozenset(
    """ad ads advert adverts advertisement advertisements adverting banner breadcrumb breadcrumbs comment comments complementary
    consent contentinfo cookie cookies disqus footer login menu menubar modal nav navbar navigation newsletter notice notices pager
    pagination popup promo promotion related recommended replies reply search share sharing sidebar signup social sponsor sponsored
    subscribe subscription toolbar widget""".split()
)
#: Parts of a class that tell of a state and do not name what the element is, as in with-sidebar or comments-open.
STATES = frozenset("has with without no not hide show open opened closed enabled disabled".split())
#: What else may stand in a class that a noise word begins, as in comments-section.
PARTS = frozenset(
    """area articles bar block body bottom box button buttons card col column container content entry footer form group head header
    icons inner item items left link links list main menu module outer panel post posts right row section slot stories title
    top unit wrap wrapper zone""".split()
)


def is_noise(mark: str) -> bool:
    """Whether a class, id or role names noise: its last word does, or its first and what follows only says which part it is."""
    words = [w for w in re.split(r"[^a-z]+", mark) if w]
    if not words or STATES & set(words):
        return False
    return words[-1] in NOISE_WORDS or (words[0] in NOISE_WORDS and all(w in PARTS or w in NOISE_WORDS for w in words[1:]))


def blocks_of(page: str) -> tuple[list[tuple[str, bool, str]], Counter]:
    """Blocks in page order as (path, noise, text), and how often each path's element opens."""
    out: list[tuple[str, bool, tuple, int, str]] = []
    opened: Counter = Counter()
    stack: list[tuple[str, str, bool, tuple, int]] = []  # tag, path, noise, elements with noise words, 1 in an article, 2 in main
    marked, tagged = 0, set()
    parts: list[str] = []

    def flush() -> None:
        if parts:
            text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                _, *where = stack[-1] if stack else ("", "", False, (), 0)
                out.append((*where, text))

    at = 0
    while True:
        found = TAG.search(page, at)
        parts.append(page[at : found.start() if found else len(page)])
        if not found:
            break
        at = found.end()
        close, name, rest = found.group(1), (found.group(2) or "").lower(), found.group(3)
        if name in RAW and not close:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else (len(page) if name in ("script", "style") else at)
        elif name == "br":
            parts.append(" ")
        elif name in BLOCKS:
            flush()
            if name not in STRUCTURE:
                if name == "title" and not close:
                    end = page.lower().find("</title", at)
                    at = end if end >= 0 else at
                continue
            if not close:
                marks = sorted({w for m in CLASS.findall(rest) for w in "".join(m).lower().split()})
                path = (stack[-1][1] + "/" if stack else "") + ".".join([name, *marks])
                inside = any(s[0] in ("article", "main") for s in stack)
                noise = bool(stack and stack[-1][2]) or name in NOISE_TAGS or (name == "header" and not inside)
                noise = noise or bool(HIDDEN.search(rest))
                worded, level = stack[-1][3:] if stack else ((), 0)
                if name in WRAPPING_TAGS or (name not in ("html", "body", "main") and any(map(is_noise, marks))):
                    tagged |= {marked + 1} if name in WRAPPING_TAGS else set()
                    worded = (*worded, marked := marked + 1)
                else:
                    level = max(level, {"article": 1, "main": 2}.get(name, 0))
                opened[path] += 1
                if not rest.rstrip().endswith("/"):
                    stack.append((name, path, noise, worded, level))
            else:
                depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
                if depth is not None:
                    del stack[depth:]
    flush()
    # Text in the head, such as a title, is no block of the page.
    out = [b for b in out if "head" not in b[0].split("/")[:2]]
    # A noise word is no mark of what holds all text of main or the articles or, without any, most text of the page.
    top = max((level for _, noise, _, level, _ in out if not noise), default=0)
    total, held = 0, Counter()
    for _, noise, worded, level, text in out:
        if not noise and level == top:
            total += len(text)
            held.update(dict.fromkeys(worded, len(text)))
    whole = {e for e, n in held.items() if (n == total if top or e in tagged else 2 * n > total)}
    return [(path, noise or not whole.issuperset(worded), text) for path, noise, worded, _, text in out], opened


def _number(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x00".join(parts).encode(), digest_size=8).digest(), "little", signed=True)


PARSED = (
    "page_id long, url string, host string, said long, paths array<string>, noise array<boolean>, texts array<string>, "
    "marks array<long>, sizes array<int>, open_paths array<string>, open_counts array<int>"
)


def _parse(batch: pa.RecordBatch):
    """Pages with their blocks, the elements that they open, and a number for what they say outside of noise, which copies
    share that differ in a menu or an advert."""
    rows = []
    for page_id, url, host, page in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "host", "html"))):
        found, opened = blocks_of(page)
        said = _number(*(x for path, noise, text in found if not noise for x in (path, text)))
        paths, noise, texts = zip(*found) if found else ((), (), ())
        rows.append((page_id, url, host, said, paths, noise, texts, [_number(t) for t in texts], [len(t) for t in texts], list(opened), list(opened.values())))
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.string())]
    kinds += [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int32())]
    names = [field.split()[0] for field in PARSED.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def _tokens(batches):
    """Tokens of a task's pages, added up by host: kind 0 pages, 1 elements, 2 blocks of text."""
    sums: dict = {}
    names = ["host", "kind", "path", "value", "pages", "total", "chars", "vector"]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def emit():
        rows = [(*k, *v) for k, v in sums.items()]
        sums.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def add(key, total, chars, page):
        old = sums.get(key, (0, 0, 0, 0))
        sums[key] = (old[0] + 1, old[1] + total, old[2] + chars, old[3] ^ _number(page, str(total)))

    for batch in batches:
        for host, said, paths, noise, marks, sizes, open_paths, counts in zip(*(c.to_pylist() for c in batch.columns)):
            page = str(said)
            add((host, 0, "", 0), 1, 0, page)
            direct: Counter = Counter()
            texts: Counter = Counter()
            chars: Counter = Counter()
            for path, hidden, mark, size in zip(paths, noise, marks, sizes):
                direct[path] += 0 if hidden else size
                texts[path, mark] += 1
                chars[path, mark] += 0 if hidden else size
            for path, n in zip(open_paths, counts):
                add((host, 1, path, 0), n, direct[path], page)
            for (path, mark), n in texts.items():
                add((host, 2, path, mark), n, chars[path, mark], page)
            if len(sums) > 50_000:
                yield emit()
    if sums:
        yield emit()


def templates(parsed: DataFrame) -> DataFrame:
    """One row per host: elements of its template with the text below them, and the template's own texts.

    Copies of a page count once, so what recurs does so on pages whose other text differs.
    """
    pages = parsed.select("host", "said", "paths", "noise", "marks", "sizes", "open_paths", "open_counts").dropDuplicates(["host", "said"])
    schema = "host string, kind int, path string, value long, pages long, total long, chars long, vector long"
    tokens = (
        pages.mapInArrow(_tokens, schema)
        .groupBy("host", "kind", "path", "value")
        .agg(*(F.sum(c).alias(c) for c in ("pages", "total", "chars")), F.bit_xor("vector").alias("vector"))
    )
    tokens = keep(tokens, "page-tokens")
    size = tokens.where("kind = 0").selectExpr("host", "pages as n")
    frequent = tokens.where("kind > 0 and pages > 1").join(size, "host").where("2 * pages >= n")
    # A class: the same pages, as often on each. A class of texts alone needs a third page to tell it from a copy.
    classes = frequent.groupBy("host", "vector", "pages", "total").agg(
        F.collect_list(F.struct("kind", "path", "value", "chars")).alias("tokens"), F.max(F.col("kind") == 1).alias("framed")
    )
    valid = classes.where("framed or pages > 2").select("host", F.inline("tokens"))
    return valid.groupBy("host").agg(
        F.collect_list(F.when(F.col("kind") == 1, F.struct("path", "chars"))).alias("elements"),
        F.collect_list(F.when(F.col("kind") == 2, F.struct("path", "value", "chars"))).alias("texts"),
    )


def main_element(chars: dict[str, int]) -> str | None:
    """Path of the element with the main text, from the text that stands directly in each element."""
    below: Counter = Counter()
    for path, n in chars.items():
        steps = path.split("/")
        for k in range(1, len(steps) + 1):
            below["/".join(steps[:k])] += n
    below = Counter({p: n for p, n in below.items() if n > 0})
    if not below:
        return None
    named = {p: n for p, n in below.items() if p.split("/")[-1].split(".")[0] in ("article", "main")}
    if named:
        return max(named, key=lambda p: (named[p], -len(p)))  # of a main and its article, the main: nested template parts go later
    start = min(below, key=len)
    # Without an article: as deep as one element holds all of it. A list or a table is part of the text.
    while deeper := [p for p in below if p.startswith(start + "/") and below[p] == below[start] and p[len(start) + 1 :].split(".")[0].split("/")[0] in DIVISIONS]:
        start = min(deeper, key=lambda p: (p.count("/"), p))
    return start


DIVISIONS = frozenset("html body div section".split())


def main_text(page: str, element: str | None, fixed: frozenset) -> str:
    found, opened = blocks_of(page)
    return kept_text([(path, noise, text, _number(text)) for path, noise, text in found], opened, element, fixed)


def kept_text(found: list[tuple[str, bool, str, int]], opened, element: str | None, fixed: frozenset) -> str:
    """Text of the blocks (path, noise, text, number) inside of the main element; ``fixed`` are the template's (path, number)."""
    if element is None or element not in opened:
        own: Counter = Counter()
        for path, noise, text, _ in found:
            own[path] += 0 if noise else len(text)
        element = main_element(own)
        if element is None:
            return ""
    below = element + "/"
    # A nested part goes if it is a division all of whose text is the template's own.
    own_text = {path for path, _, _, _ in found if path.split("/")[-1].split(".")[0] in ("div", "section")}
    own_text -= {path for path, _, _, number in found if (path, number) not in fixed}
    return "\n".join(
        text for path, noise, text, _ in found
        if not noise and (path == element or path.startswith(below) and path not in own_text)
    )


def _extract():
    known: dict = {}

    def work(batch):
        rows = []
        names = ("page_id", "url", "host", "paths", "noise", "texts", "marks", "open_paths", "template")
        for page_id, url, host, paths, noise, texts, marks, opened, template in zip(*(batch.column(c).to_pylist() for c in names)):
            if host not in known:
                if len(known) > 1000:
                    known.clear()
                if template is None:
                    known[host] = (None, frozenset())
                else:
                    slots = Counter({e["path"]: e["chars"] for e in template["elements"]})
                    for t in template["texts"]:
                        slots[t["path"]] -= t["chars"]
                    known[host] = (main_element(slots), frozenset((t["path"], t["value"]) for t in template["texts"]))
            text = kept_text(list(zip(paths, noise, texts, marks)), opened, *known[host])
            rows.append((page_id, url, text, len(text)))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (batch.column("page_id").type, pa.string(), pa.string(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return work


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its length of every row of ``pages`` (page_id, url, html)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
    )
    parsed = keep(rows.mapInArrow(per_task(lambda: _parse), PARSED), "page-blocks")
    found = keep(templates(parsed), "page-templates")
    joined = parsed.join(found.select("host", F.struct("elements", "texts").alias("template")), "host", "left")
    return joined.select("page_id", "url", "host", "paths", "noise", "texts", "marks", "open_paths", "template").mapInArrow(
        per_task(_extract), "page_id long, url string, text string, n_chars long"
    )
