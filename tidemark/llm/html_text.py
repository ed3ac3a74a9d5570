"""Main text of web pages by templates deduced from equivalence classes.

Every page is parsed into tokens: structural elements, told apart by their path, and blocks of text, told apart by path
and wording. Tokens that occur equally often on every page of a host share an occurrence vector, of which a hash is
enough, so vectors are compared by grouping and never built. A class of enough tokens on enough pages, with an element
among them, is part of the host's template; classes are ordered by place and nested by the spans they cover. What the
template holds is boilerplate; what stands in its slots is the page's own. From the slots the article is taken: without
those in menus, notices, forms and the like, and, where a page marks its article, only those inside it. Marked articles keep
wording that other pages share.

Blocks end at block elements and line breaks. Character references are decoded, white space becomes one space, empty
blocks vanish, and the rest is joined by newlines.

Defined cases: null and empty pages give an empty text; pages without a usable url form one host; repeated rows give
a row each and count as pages; a host with few pages has no template, only the page's own marks count; unclosed or broken
markup ends at the page's end; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import stored

#: A class is part of a template from this many tokens, pages, and percent of the host's pages on.
CLASS_TOKENS, CLASS_PAGES, CLASS_PERCENT = 3, 3, 10

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
#: Every attribute with its value, so that neither values nor parts of names pass for attributes.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s"'>/=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|"[^"]*"|'[^']*'""")
NAMED = frozenset(["class", "id", "role", "itemprop"])
_WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math select object audio video canvas xmp noembed noframes".split())
_RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
BLOCK = frozenset(
    "html head body address article aside blockquote button center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul br".split()
)
CHROME_TAGS = frozenset("nav footer aside form menu dialog button fieldset legend label head".split())
#: Chrome that an article inside does not end.
FIRM_TAGS = frozenset("nav footer aside menu dialog".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr login"
    " menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended related"
    " replies reply search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget alert complementary contentinfo"
    " masthead topbar skip".split()
)
#: Chrome on a page, but part of an article inside one.
PAGE_ONLY = frozenset(["header", "banner", "masthead"])
#: A new one of these ends an open one of the same row.
SIBLINGS = {
    "p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",),
}
SCOPES = frozenset("ul ol dl table div section article aside main nav header footer body form blockquote".split())


def _token(name: str, tag: bool) -> int:
    """63 bits of a digest; odd for elements."""
    n = int.from_bytes(hashlib.blake2b(name.encode("utf-8", "replace"), digest_size=8).digest(), "little") >> 1
    return n | 1 if tag else n & ~1


def parse(page: str) -> tuple[dict[int, list[int]], list[tuple]]:
    """Tokens of a page as ``{token: [count, first place]}``, and its text blocks in order.

    A block is ``(token, slot, text, chrome, in article, linked characters)``; ``slot`` is the element token before it.
    """
    tokens: dict[int, list[int]] = {}
    blocks: list[tuple] = []
    # Open elements: tag, path, inside chrome, inside article, inside link, inside chrome that no article ends.
    stack: list[tuple] = [("", "", False, False, False, False)]
    opened: Counter[str] = Counter()
    held: list[str] = []
    state = {"linked": 0, "place": 0, "slot": 0}

    def note(token: int) -> None:
        state["place"] += 1
        tokens.setdefault(token, [0, state["place"]])[0] += 1

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            _, path, chrome, article, *_ = stack[-1]
            token = _token(f"{path}#{text}", False)
            note(token)
            blocks.append((token, state["slot"], text, chrome, article, state["linked"]))
        state["linked"] = 0

    def add(text: str) -> None:
        if text:
            held.append(text)
            if stack[-1][4]:
                state["linked"] += len(text)

    def close(i: int) -> None:
        for element in stack[i:]:
            opened[element[0]] -= 1
        del stack[i:]

    at, raw = 0, None
    while at < len(page):
        if raw:
            # Sought in the page itself: its lower-case copy may be longer.
            end = _RAW_END[raw].search(page, at)
            at, raw = (end.start() if end else len(page)), None
            continue
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            if m[0].startswith("<![CDATA["):
                add(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag, closing = tag.lower(), bool(m[1] or m[4])
        block = tag in BLOCK
        if block:
            flush()
        if closing:
            for i in range(len(stack) - 1 if opened[tag] else 0, 0, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if stack[i][0] in SCOPES and tag not in SCOPES:
                    break
            continue
        if tag in SIBLINGS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in SIBLINGS[tag]:
                    close(i)
                    if tag != "tr":
                        break
                elif stack[i][0] in SCOPES:
                    break
        elif block and tag in SCOPES and stack[-1][0] == "p":
            close(len(stack) - 1)
        if tag in VOID:
            continue
        attributes = m[3] if m[2] else m[6]
        names, marked, hidden = "", set(), False
        if attributes:
            for key, *values in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), next((v for v in values if v), "").lower()
                if key == "hidden":
                    hidden = True
                elif key not in NAMED:
                    continue
                elif key == "itemprop":
                    marked.update(["main"] if value == "articlebody" else [])
                else:
                    names += "." + value
                    marked.update(_WORD.findall(value))
        _, path, chrome, article, link, firm = stack[-1]
        if tag in RAW:
            raw = None if attributes.rstrip().endswith("/") and tag in ("svg", "math") else tag
            continue
        inner = article or tag in ("article", "main") or "main" in marked
        nested = tag == "article" and opened["article"] > 0
        off = marked & CHROME_WORDS if tag not in ("body", "html", "main") and (tag != "article" or nested) else set()
        if article:
            off = off - PAGE_ONLY
        # Words on a wrapper and a form around the page do not reach into the outermost article; real chrome does.
        firm = firm or hidden or tag in FIRM_TAGS
        if inner and not article:
            chrome = firm
        chrome = chrome or firm or tag in CHROME_TAGS or nested or bool(off) or (not article and (tag == "header" or "header" in marked))
        if block:
            # A path is told by the token of its parent, so open elements hold no long texts.
            path = state["slot"] = _token(f"{path}>{tag}{re.sub('[0-9]+', '0', names)}", True)
            note(path)
        stack.append((tag, path, chrome, inner, link or tag == "a", firm))
        opened[tag] += 1
    flush()
    return tokens, blocks


PARSED = (
    "page_id bigint, url string, host string, page bigint, tokens array<struct<token:bigint,times:int,place:int>>,"
    " blocks array<struct<token:bigint,slot:bigint,text:string,chrome:boolean,article:boolean,linked:int>>"
)


def parsed(pages: DataFrame) -> DataFrame:
    def walk(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        page = TaskContext.get().partitionId() << 40
        token_type = pa.list_(pa.struct([("token", pa.int64()), ("times", pa.int32()), ("place", pa.int32())]))
        block_type = pa.list_(pa.struct([("token", pa.int64()), ("slot", pa.int64()), ("text", pa.string()), ("chrome", pa.bool_()), ("article", pa.bool_()), ("linked", pa.int32())]))
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                rows = [parse(h or "") for h in batch.column("html").to_pylist()]
                tokens = [[{"token": t, "times": n, "place": p} for t, (n, p) in found.items()] for found, _ in rows]
                blocks = [[dict(zip(("token", "slot", "text", "chrome", "article", "linked"), b, strict=True)) for b in found] for _, found in rows]
                numbers = pa.array(range(page, page + len(rows)), pa.int64())
                page += len(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), batch.column("host"), numbers, pa.array(tokens, token_type), pa.array(blocks, block_type)],
                    ["page_id", "url", "host", "page", "tokens", "blocks"],
                )

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), F.col("html").cast("string").alias("html")
    ).mapInArrow(walk, PARSED)


def templates(rows: DataFrame) -> DataFrame:
    """Per host its valid classes, each with its tokens in order: ``host``, ``classes``."""
    seen = rows.select("host", "page", F.inline("tokens"))
    vectors = seen.groupBy("host", "token").agg(
        F.count("*").alias("pages"), F.bit_xor(F.xxhash64("page", "times")).alias("vector"), F.avg("place").alias("place")
    )
    hosts = rows.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("host_pages"))
    frequent = vectors.filter(F.col("pages") >= CLASS_PAGES).join(hosts, F.col("host") == F.col("of"))
    frequent = frequent.filter(f"100 * pages >= {CLASS_PERCENT} * host_pages")
    # A class is no longer than the pages that hold it, and a host has few frequent classes.
    grouped = frequent.groupBy("host", "pages", "vector").agg(
        F.array_sort(F.collect_list(F.struct("place", "token"))).alias("members"), F.sum(F.col("token").bitwiseAND(F.lit(1))).alias("elements")
    )
    valid = grouped.filter((F.size("members") >= CLASS_TOKENS) & (F.col("elements") > 0))
    return valid.groupBy(F.col("host").alias("of")).agg(F.collect_list(F.struct("pages", "members")).alias("classes"))


def nested(classes: list[dict]) -> dict[int, tuple[int, int, int]]:
    """Per token ``(class, place in it, parent class)``: a class lies in the smallest one on as many pages that spans it."""
    spans = []
    for c in sorted(classes, key=lambda c: (-c["pages"], c["members"][0]["place"])):
        members = c["members"]
        spans.append((members[0]["place"], members[-1]["place"], members))
    found: dict[int, tuple[int, int, int]] = {}
    for i, (lo, hi, members) in enumerate(spans):
        around = [(b - a, j) for j, (a, b, _) in enumerate(spans[:i]) if a <= lo and hi <= b]
        parent = min(around)[1] if around else -1
        found.update({m["token"]: (i, k, parent) for k, m in enumerate(members)})
    return found


def slots(blocks: list[dict], template: dict[int, tuple[int, int, int]]) -> list[tuple[tuple, list[dict]]]:
    """The page's own blocks by the slot of the template that they fill, in order."""
    filled: list[tuple[tuple, list[dict]]] = []
    for b in blocks:
        # Shared wording is template, but not inside a marked article.
        if b["token"] in template and not b["article"]:
            continue
        slot = template.get(b["slot"], (-1, b["slot"], -1))
        if not filled or filled[-1][0] != slot:
            filled.append((slot, []))
        filled[-1][1].append(b)
    return filled


def main_text(filled: list[tuple[tuple, list[dict]]]) -> str:
    own = [[b for b in found if not b["chrome"]] for _, found in filled]
    if any(b["article"] for found in own for b in found):
        return "\n".join(b["text"] for found in own for b in found if b["article"])
    # Without a marked article, slots made of links are menus.
    return "\n".join(b["text"] for found in own if 2 * sum(b["linked"] for b in found) <= sum(len(b["text"]) for b in found) for b in found)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``, and the number of template slots that the page fills."""
    rows = stored(parsed(pages), "parsed-pages")
    known = stored(templates(rows), "templates")
    joined = rows.select("page_id", "url", "host", "blocks").join(known, F.col("host") == F.col("of"), "left").drop("of")

    def fill(batches: Iterator) -> Iterator:
        import pyarrow as pa

        host, template = None, {}
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                texts, counts = [], []
                for i, (name, blocks) in enumerate(zip(batch.column("host").to_pylist(), batch.column("blocks").to_pylist(), strict=True)):
                    if name != host:
                        host, template = name, nested(batch.column("classes")[i].as_py() or [])
                    filled = slots(blocks, template)
                    texts.append(main_text(filled))
                    counts.append(len(filled))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64())],
                    ["page_id", "url", "text", "n_chars", "n_slots"],
                )

    return joined.mapInArrow(fill, "page_id bigint, url string, text string, n_chars bigint, n_slots bigint")
