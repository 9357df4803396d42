"""Main text of web pages by templates deduced from equivalence classes.

Tokens of a page are its elements by path (names with class, id and role) and its text blocks by
path and content. A token's occurrence vector over the pages of a host is how often each page has
it. Tokens with equal vectors form a class. Classes that enough pages have are valid: elements
that stand once on every page that has them form frames, repeated ones are lists that nest inside
the frame above them, and blocks that share their class with an element around them are fixed
text. The deepest frames above the remaining blocks are the slots of the host's template. The main
slots are those of an article or main element, or else the slot with the most text outside links;
the text of a page is what its blocks in main slots hold, without parts that their names mark as
menus, notices, comments and the like. A page that does not fill its host's template is read by a
template of its own.

Scale: vectors are never held. Per (host, token) the pages, occurrences and two sums of hashes of
(page, occurrences) are map-side combined; equal sums mean equal vectors. Only tokens of a quarter
of a host's pages stay, a number that the length of pages bounds, so a host's template is small
whatever its pages. Hosts with few pages share one template. Templates are sent to all tasks only
if few; else they are joined by host, where large hosts can be split. Pages are not grouped.

Defined cases: a null page has the empty text; text outside all slots is left out; broken markup
is read tolerantly; a null url counts as a host of its own; repeated rows are extracted each, and
count once each in vectors; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Share of a host's pages that have a valid class; pages below which hosts are pooled.
SUPPORT, FEW_PAGES = 0.25, 8
#: Templates that may be sent to all tasks.
SENT_TEMPLATES = 2000

# Element names of HTML and words in class, id and role attributes.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = set("script style textarea title noscript iframe xmp noembed noframes template".split())
SKIPPED = set("head nav header footer aside form script style noscript template iframe button select option textarea title svg canvas object audio video map dialog menu".split())
MARKED = set(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar ad ads advert adverts advertisement sponsor sponsored promo cookie cookies consent notice notices "
    "banner popup modal newsletter subscribe share sharing social comment comments respond reply replies disqus related recommended pagination pager skip complementary contentinfo search".split()
)
_CLOSES_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_ITEMS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|[^<]+|<""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NAME = re.compile(r"[a-zA-Z]+")


def _described(name: str, attributes: str) -> str:
    if "=" not in attributes:
        return name
    found = sorted((k.lower(), v.strip("\"'")) for k, v in _ATTRIBUTE.findall(attributes))
    return name + "".join(f".{word}" for _, value in found for word in value.replace("/", " ").split())


def _skipped(element: str, inside_article: bool) -> bool:
    name, _, marks = element.partition(".")
    if name in SKIPPED:
        return not (name == "header" and inside_article)
    return any(word.lower() in MARKED for word in _NAME.findall(marks))


def boilerplate(path: tuple[str, ...]) -> bool:
    inside = False
    for element in path:
        if _skipped(element, inside):
            return True
        inside = inside or element.partition(".")[0] in ("article", "main")
    return False


class Page:
    """Elements by path, and text blocks (path, text, characters in links) in page order."""

    def __init__(self, source: str) -> None:
        self.elements: Counter[tuple[str, ...]] = Counter()
        self.blocks: list[tuple[tuple[str, ...], str, int]] = []
        names: list[str] = []
        path: tuple[str, ...] = ()
        held: list[str] = []
        links = depth = 0

        def flush() -> None:
            nonlocal links
            if held:
                text = " ".join(html.unescape("".join(held)).split())
                if text:
                    self.blocks.append((path, text, min(links, len(text))))
                held.clear()
            links = 0

        at, end = 0, len(source)
        while at < end:
            m = _TOKEN.match(source, at)
            at = m.end()
            name = m[2]
            if name is None:
                text = m[0]
                if text[0] != "<" or text == "<":
                    held.append(text)
                    if depth:
                        links += len(text)
                continue
            name = name.lower()
            if name in INLINE:
                if name == "br":
                    held.append(" ")
                elif name == "a":
                    depth = 0 if m[1] else 1
                continue
            flush()
            if m[1]:
                if name in names:
                    keep = len(names) - 1 - names[::-1].index(name)
                    names, path = names[:keep], path[:keep]
                continue
            if name in _CLOSES_P and "p" in names:
                keep = len(names) - 1 - names[::-1].index("p")
                names, path = names[:keep], path[:keep]
            if name in _ITEMS:
                for i in range(len(names) - 1, -1, -1):
                    if names[i] in _ITEMS[name]:
                        break
                    if names[i] == name or names[i] in ("dt", "dd", "td", "th") and name in ("dt", "dd", "td", "th"):
                        names, path = names[:i], path[:i]
                        break
            own = path + (_described(name, m[3]),)
            self.elements[own] += 1
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
                at = close.end() if close else end
            elif name not in VOID and not m[3].endswith("/"):
                names, path = [*names, name], own
        flush()


def _mark(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, row) and each token of the page: path, mark (0 for an element), times, characters, in links."""
    names = ["host", "row", "path", "mark", "times", "chars", "links"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for host, row, source in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            page = Page(source)
            chars, links = Counter(), Counter()
            texts: Counter[tuple[tuple[str, ...], str]] = Counter()
            for path, text, linked in page.blocks:
                chars[path] += len(text)
                links[path] += linked
                texts[path, text] += 1
            made = [("/".join(p), 0, n, chars.pop(p, 0), links[p]) for p, n in page.elements.items()]
            made += [("/".join(p), 0, 0, n, links[p]) for p, n in chars.items()]
            made += [("/".join(p), _mark(t), n, 0, 0) for (p, t), n in texts.items()]
            for values in made:
                for column, value in zip(out, (host, row, *values)):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, kinds)], names=names)


def deduce(tokens: list[dict], pages: int) -> dict:
    """Template from the frequent tokens of a host: frames, lists, main slots and fixed texts.

    A token is {path, mark, pages, times, first, second, chars, links}.
    """
    classes: dict[tuple, list[dict]] = defaultdict(list)
    for token in tokens:
        if token["pages"] >= SUPPORT * pages:
            classes[token["pages"], token["first"], token["second"]].append(token)
    frames, lists, fixed = set(), set(), set()
    for own in classes.values():
        elements = {token["path"] for token in own if not token["mark"]}
        for token in own:
            if token["mark"]:
                # fixed text comes and goes with an element around it; other frequent text is what fills one
                if slot_of(token["path"], elements) is not None:
                    fixed.add(f"{token['path']}\0{token['mark']}")
            elif token["times"] == token["pages"]:
                frames.add(token["path"])
            else:
                lists.add(token["path"])
    # a class is valid where it nests: what stands above its elements is in the template too
    known = frames | lists
    nested = lambda p: "/" not in p or p.rpartition("/")[0] in known
    while True:
        wrong = {p for p in known if not nested(p)}
        if not wrong:
            break
        known -= wrong
    frames, lists = frames & known, lists & known
    size: Counter[str] = Counter()
    for token in tokens:
        if not token["mark"] and token["chars"]:
            slot = slot_of(token["path"], frames)
            if slot is not None and not boilerplate(tuple(token["path"].split("/"))):
                size[slot] += token["chars"] - token["links"]
    semantic = [s for s in size if any(e.partition(".")[0] in ("article", "main") for e in s.split("/"))]
    main = semantic or [max(size, key=lambda s: (size[s], s))] if size else []
    return {"frames": sorted(frames), "lists": sorted(lists), "main": sorted(main), "fixed": [] if semantic else sorted(fixed)}


def slot_of(path: str, frames: set[str]) -> str | None:
    """The deepest frame at or above a path."""
    while path and path not in frames:
        path = path.rpartition("/")[0]
    return path or None


def own_template(page: Page) -> dict:
    """The template of a page on its own: every element that it has once is a frame."""
    chars, links = Counter(), Counter()
    for path, text, linked in page.blocks:
        chars[path] += len(text)
        links[path] += linked
    tokens = [{"path": "/".join(p), "mark": 0, "pages": 1, "times": n, "first": n, "second": 0, "chars": chars[p], "links": links[p]} for p, n in page.elements.items()]
    return deduce(tokens, 1)


def main_text(page: Page, template: dict | None) -> str:
    """What fills the main slots of the template, one line per block."""
    def filled(t: dict) -> list[str]:
        frames, main, fixed = set(t["frames"]), set(t["main"]), set(t["fixed"])
        out = []
        for path, text, _ in page.blocks:
            joined = "/".join(path)
            if slot_of(joined, frames) in main and not boilerplate(path) and not (fixed and f"{joined}\0{_mark(text)}" in fixed):
                out.append(text)
        return out

    blocks = filled(template) if template else []
    if not blocks and page.blocks:
        blocks = filled(own_template(page))
    return "\n".join(blocks)


def _host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): a JSON template of each host of (host, row, html); pooled hosts as 'few'."""
    tokens = pages.mapInArrow(_tokens, "host string, row bigint, path string, mark bigint, times bigint, chars bigint, links bigint")
    hashed = tokens.withColumn("seen", F.xxhash64("row", "times"))
    low = F.col("seen").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("seen", 32)
    per_token = hashed.groupBy("host", "path", "mark").agg(
        F.sum(F.when(F.col("times") > 0, 1).otherwise(0)).alias("pages"), F.sum("times").alias("times"), F.sum(low).alias("first"), F.sum(high).alias("second"),
        F.sum("chars").alias("chars"), F.sum("links").alias("links"),
    )
    counts = pages.groupBy(F.col("host").alias("of_host")).agg(F.count("*").alias("of_pages"))
    frequent = per_token.join(counts, F.col("host") == F.col("of_host")).where(
        (F.col("pages") >= SUPPORT * F.col("of_pages")) | (F.col("mark") == 0) & (F.col("chars") > 0) & (F.col("pages") >= SUPPORT / 10 * F.col("of_pages"))
    )

    def per_host(key, rows):
        import pandas as pd

        found = deduce(rows.drop(columns=["host", "of_host", "of_pages"]).to_dict("records"), int(rows["of_pages"].iloc[0]))
        return pd.DataFrame({"host": [key[0]], "template": [json.dumps(found, sort_keys=True)]})

    return frequent.groupBy("host").applyInPandas(per_host, "host string, template string")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page."""
    from tenderline.llm.common import written

    named = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), _host(F.col("url")).alias("own_host"), F.xxhash64("page_id", "url", "html").alias("row"))
    large = written(named.groupBy("own_host").agg(F.count("*").alias("n")).where(F.col("n") >= FEW_PAGES).select(F.col("own_host").alias("name")), "template-hosts")
    few_hosts = len(large.take(SENT_TEMPLATES + 1)) <= SENT_TEMPLATES
    grouped = named.join(F.broadcast(large) if few_hosts else large, F.col("own_host") == F.col("name"), "left")
    grouped = grouped.withColumn("host", F.coalesce("name", F.lit("few"))).drop("name", "own_host")
    made = written(templates(grouped.select("host", "row", "html")), "template-made").withColumnRenamed("host", "of_host")
    few = len(made.select("of_host").take(SENT_TEMPLATES + 1)) <= SENT_TEMPLATES
    joined = grouped.join(F.broadcast(made) if few else made, F.col("host") == F.col("of_host"), "left").select("page_id", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for source, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if template is not None and template not in parsed:
                    if len(parsed) >= 100:
                        parsed.clear()
                    parsed[template] = json.loads(template)
                texts.append(main_text(Page(source), parsed.get(template)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, type=pa.string())], names=["page_id", "url", "text"])

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"
    return joined.mapInArrow(run, schema).withColumn("n_chars", F.char_length("text").cast("bigint"))
