"""Main-text extraction by wrappers inferred for each host.

A wrapper is a union-free regular expression over tags: fixed tags and texts,
text slots, optional groups and repeated groups. It comes from all pages of the
host, equal ones once: texts on nearly all of them are fixed, other texts are
slots, and the token streams, repeats folded, are aligned one after the other:
tokens of one side only become an optional group, and a stretch that repeats its
neighbour becomes a repeated group. Different streams of a host are merged in
buckets and the buckets' wrappers with each other, so that a host with very many
pages is no single task. Every page also names the container that holds most of
its slots' text; what a tenth of a host's pages name are its content regions.

The alignment also tells the headings from the template: a fixed text in an
``h2`` to ``h6`` ("Introduction") whose next text, inside the same element, is a slot
on the aligned pages belongs to what it heads and stays.

A page's text is that of the content region with the most text on it (the page's
own heaviest container, if it has none of them), without the other fixed texts there
and without parts that are no article by element, role or name. ``article`` and
``main`` count double when containers are weighed, no more.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from itertools import groupby

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import even_parts, staged, tidy

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_CLASS = re.compile(r"\bclass\s*=\s*[\"']?\s*([^\s\"'>]+)", re.I)
#: Element names by their part in a page.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
             "sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp"}
LEFT_OUT = set("nav footer aside form script style noscript template iframe svg button select textarea menu dialog head title "
               "object canvas".split())
#: Words in class or id, and roles, of parts that are not the article. The second list has another
#: meaning in many names (``share-price``, ``#notice-2``): there the last word counts, and not on an element of text.
HINT_WORDS = set("ad ads adv advert advertisement advertising promo sponsor sponsored cookie cookies consent gdpr popup nav navbar "
                 "navigation breadcrumb breadcrumbs sidebar footer comment comments disqus respond replies related recommended "
                 "newsletter pagination pager masthead toolbar".split())
WEAK_HINT_WORDS = set("banner notice notices alert modal overlay menu share sharing social subscribe login signup search widget".split())
TEXT_ELEMENTS = set("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figure figcaption".split())
_SECTION = re.compile(r"<h[2-6][.>]")
LEFT_OUT_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
HEADER_WORDS = {"header", "masthead"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}}


def _left_out(tag: str, attributes: str, in_content: bool) -> tuple[bool, bool]:
    """Whether element, role or style, and whether names, say that a part is not the article."""
    if tag in LEFT_OUT or (tag == "header" and not in_content):
        return True, False
    if not attributes or tag in ("html", "body", "main", "article"):
        return False, False
    values = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", ""):
        return True, False
    if values.get("role") in LEFT_OUT_ROLES:
        return True, False
    for name in f"{values.get('class', '')} {values.get('id', '')}".split():
        words = [w for w in re.split(r"[-_\d]+", name) if w]
        if words and not {"with", "has", "no"} & set(words):
            ends = {words[0], words[-1]}
            if ends & HINT_WORDS or (ends & HEADER_WORDS and not in_content) \
                    or (words[-1] in WEAK_HINT_WORDS and tag not in TEXT_ELEMENTS):
                return False, True
    return False, False


def _class(attributes: str) -> str:
    """A dot and the first class name without digits, if there is one."""
    m = _CLASS.search(attributes) if "class" in attributes.lower() else None
    return "." + re.sub(r"[\d/|]+", "", m[1]) if m else ""


@dataclass
class Block:
    path: str
    text: str
    content: bool  # inside an article or main element
    hint: str = ""  # path of the outermost part around it whose name says that it is not the article


def parse(page: str) -> tuple[list[Block], list[str]]:
    """Text blocks that are not in a part to leave out, and the page's token stream:
    ``<tag.class>``, ``</tag>`` (also where the page leaves it out) and ``#path|text``, parts left out included."""
    blocks: list[Block] = []
    stream: list[str] = []
    stack: list[tuple[str, bool, bool, str, str]] = []  # tag, left out, in content, path, hint
    held: list[str] = []

    def flush():
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out, content, path, hint = stack[-1][1:] if stack else (False, False, "", "")
                stream.append(f"#{path}|{text}")
                if not out:
                    blocks.append(Block(path, text, content, hint))

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            if m[0][0] != "<" or m[0] == "<":
                held.append(m[0])
            continue
        tag, closing, attributes = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag in RAW and not closing:
            if not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if tag in INLINE:
            if tag not in VOID and not closing and stack and not stack[-1][1] and any(_left_out(tag, attributes, stack[-1][2])):
                flush()
                stack.append((tag, True, stack[-1][2], f"{stack[-1][3]}/{tag}", stack[-1][4]))
            elif closing and stack and stack[-1][0] == tag and stack[-1][1]:
                flush()
                stack.pop()
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    stream += [f"</{t[0]}>" for t in reversed(stack[k:]) if t[0] not in INLINE]
                    del stack[k:]
                    break
            continue
        if tag in _CLOSES or tag == "p" or (stack and stack[-1][0] == "p"):
            closes = _CLOSES.get(tag, set()) | {"p"}
            while stack and stack[-1][0] in closes:
                stream.append(f"</{stack.pop()[0]}>")
        if tag in VOID or attributes.endswith("/"):
            continue
        _, out, content, path, hint = stack[-1] if stack else ("", False, False, "", "")
        gone, named = _left_out(tag, attributes, content)
        name = tag + _class(attributes)
        path += f"/{name}"
        stack.append((tag, out or gone, content or (tag in ("article", "main") and not (out or gone)), path,
                      hint or (path if named else "")))
        stream.append(f"<{name}>")
    flush()
    stream += [f"</{t[0]}>" for t in reversed(stack) if t[0] not in INLINE]
    return blocks, stream


# -- wrappers -----------------------------------------------------------------

#: A wrapper is a list of tags, ("text", t), ("slot",), ("?", group) and ("+", group).
Item = str | tuple


def _key(item: Item) -> str:
    """What alignment compares: tags by name, any text as text, groups by their shape."""
    if isinstance(item, str):
        return item
    if item[0] in ("text", "slot"):
        return "#"
    return f"({''.join(map(_key, item[1]))}){item[0]}"


def _merge(a: Item, b: Item) -> Item:
    if isinstance(a, str) or a == b:
        return a
    if a[0] in ("text", "slot"):
        return ("slot",)
    return (a[0], [_merge(x, y) for x, y in zip(a[1], b[1])])


def fold(items: list[Item]) -> list[Item]:
    """Replace a group, of any length, that repeats itself side by side with one repeated group."""
    out: list[Item] = []
    keys: list[str] = []
    places: dict[str, list[int]] = {}  # of each key in ``keys``, ascending
    due: dict[int, list[int]] = {}  # places of repeated groups by the length at which one more repeat is complete

    def push(item: Item):
        key = _key(item)
        places.setdefault(key, []).append(len(out))
        out.append(item)
        keys.append(key)
        if key[-1] == "+" and key[0] == "(":
            due.setdefault(len(out) + len(item[1]), []).append(len(out) - 1)

    def cut(start: int) -> list[Item]:
        gone = out[start:]
        for key in keys[start:]:
            places[key].pop()
        del out[start:], keys[start:]
        return gone

    def repeat() -> tuple | None:
        """The group that the last items complete, cut off; None if there is none."""
        size = len(out)
        for at in reversed(due.get(size, ())):
            if at < size and isinstance(out[at], tuple) and out[at][0] == "+" and at + 1 + len(out[at][1]) == size \
                    and [_key(x) for x in out[at][1]] == keys[at + 1:]:
                group, *last = cut(at)
                return ("+", [_merge(x, y) for x, y in zip(group[1], last)])
        for at in reversed(places[keys[-1]][:-1]):
            n = size - 1 - at
            if 2 * n > size:
                return None
            if (n > 1 or keys[-1][0] == "(") and keys[-n:] == keys[-2 * n:-n]:
                both = cut(size - 2 * n)
                return ("+", [_merge(x, y) for x, y in zip(both[:n], both[n:])])
        return None

    for item in items:
        push(item)
        while (group := repeat()) is not None:
            push(group)
    return out


def _flat(items: list[Item]) -> list[tuple[Item, object]]:
    """The items with those of optional groups in place, and the group of each (None: not optional)."""
    out: list[tuple[Item, object]] = []
    for item in items:
        if isinstance(item, tuple) and item[0] == "?":
            group = object()
            out += [(x, group if inner is None else inner) for x, inner in _flat(item[1])]
        else:
            out.append((item, None))
    return out


def _differing(a: list[tuple[Item, object]], b: list[tuple[Item, object]]) -> list[tuple[Item, object]]:
    """Both of two stretches that have no item in common, each optional; but a repeated
    group of one side takes up one occurrence of it on the other."""
    for one, other, turned in ((a, b, False), (b, a, True)):
        keys = [_key(x) for x, _ in other]
        for i, (item, group) in enumerate(one):
            if isinstance(item, tuple) and item[0] == "+":
                whole = [_key(x) for x in item[1]]
                n = len(whole)
                for j in range(len(keys) - n + 1):
                    if keys[j:j + n] == whole:
                        both = ("+", [_merge(x, y) for x, (y, _) in zip(item[1], other[j:j + n])])
                        optional = object() if group or any(g for _, g in other[j:j + n]) else None
                        sides = (one[:i], other[:j]), (one[i + 1:], other[j + n:])
                        before, after = (_differing(*reversed(x)) if turned else _differing(*x) for x in sides)
                        return before + [(both, optional)] + after
    out = []
    for side in (a, b):
        mine: dict = {}
        out += [(x, mine.setdefault(g, object())) for x, g in side]
    return out


def align(wrapper: list[Item], page: list[Item]) -> list[Item]:
    """The wrapper that also matches ``page``, a page's items or another wrapper."""
    a, b = _flat(wrapper), _flat(page)
    out: list[tuple[Item, object]] = []
    same = SequenceMatcher(None, [_key(x) for x, _ in a], [_key(x) for x, _ in b], autojunk=False)
    for kind, i, j, k, n in same.get_opcodes():
        if kind == "equal":
            mine: dict = {}
            out += [(_merge(x, y), mine.setdefault((g, h), object()) if g or h else None)
                    for (x, g), (y, h) in zip(a[i:j], b[k:n])]
        else:
            out += _differing(a[i:j], b[k:n])
    merged_items: list[Item] = []
    for group, members in groupby(out, key=lambda r: r[1]):
        members = [x for x, _ in members]
        merged_items += members if group is None else [("?", members)]
    return merged_items


def items_of(stream: list[str]) -> list[Item]:
    return fold([("text", t[1:]) if t[0] == "#" else t for t in stream])


def infer(streams: Iterable[list[str]]) -> list[Item]:
    """Wrapper of some pages' token streams; texts that differ between them become slots."""
    return merged(map(items_of, streams))


def merged(wrappers: Iterable[list[Item]]) -> list[Item]:
    """One wrapper that matches what each of ``wrappers`` matches, held one at a time."""
    out: list[Item] | None = None
    for wrapper in wrappers:
        out = wrapper if out is None or out == wrapper else align(out, wrapper)
    return out or []


def expression(wrapper: list[Item]) -> str:
    """The wrapper as text; ``#`` is a slot."""
    def one(x):
        if isinstance(x, str):
            return x
        if x[0] == "slot":
            return "#"
        return x[1].split("|", 1)[1] if x[0] == "text" else f"({expression(x[1])}){x[0]}"

    return "".join(map(one, wrapper))


def _mark(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


def block_mark(block: Block) -> int:
    return _mark(f"{block.path}|{block.text}")


def skeleton(tokens: list, fixed: set[int], common: set[int]) -> list[Item]:
    """Folded items of one page's tokens (:func:`shape`): fixed texts as ``=mark``, other texts as slots,
    elements that are not ``common`` as a part of the slot around them."""
    out: list[Item] = []
    stack: list[tuple[str, bool]] = []
    for token in tokens:
        if not isinstance(token, str):
            if token[1] in fixed:
                out.append(f"={token[1]}")
            elif not out or out[-1] != ("slot",):
                out.append(("slot",))
        elif token[1] == "/":
            while stack:
                tag, kept = stack.pop()
                if tag == token[2:-1]:
                    if kept:
                        out.append(token)
                    break
        else:
            kept = _mark(token) in common
            stack.append((token[1:-1].split(".")[0], kept))
            if kept:
                out.append(token)
    return fold(out)


def fixed_marks(wrapper: list[Item]) -> set[int]:
    """Marks of the fixed texts, those in groups included."""
    found: set[int] = set()
    for item in wrapper:
        if isinstance(item, tuple):
            found |= fixed_marks(item[1]) if len(item) > 1 and isinstance(item[1], list) else set()
        elif item[0] == "=":
            found.add(int(item[1:]))
    return found


def section_headings(wrapper: list[Item]) -> set[int]:
    """Marks of the fixed texts that head other text: wherever they stand in the wrapper, in an ``h2`` to ``h6``, the
    next text inside the element around that one is a slot."""
    flat: list[Item] = []

    def spread(items: list[Item]):
        for item in items:
            if isinstance(item, tuple) and item[0] in ("?", "+"):
                spread(item[1])
            else:
                flat.append(item)

    def heads(at: int) -> bool:
        if at == 0 or not isinstance(flat[at - 1], str) or not _SECTION.match(flat[at - 1]):
            return False
        depth, closed = 1, False  # open elements inside the one around the heading; whether the heading has ended
        for item in flat[at + 1:]:
            if not isinstance(item, str):
                return closed
            if item[0] == "=":
                return False
            depth += -1 if item[1] == "/" else 1
            closed = closed or depth == 0
            if depth < 0:
                return False
        return False

    spread(wrapper)
    found: dict[int, bool] = {}
    for at, item in enumerate(flat):
        if isinstance(item, str) and item[0] == "=":
            found[int(item[1:])] = found.get(int(item[1:]), True) and heads(at)
    return {mark for mark, good in found.items() if good}


@dataclass
class HostWrapper:
    template: list[int] = field(default_factory=list)  # marks of fixed texts that are no headings of a slot
    regions: list[str] = field(default_factory=list)
    expression: str = ""


def shape(page: str) -> list:
    """A page without its texts: tags as in its token stream, and ``[path, mark, length, weight]`` for each text;
    a text's weight for its containers is 0 in a part left out, 1 in one named like one, 4, and 8 in an article or main."""
    blocks, stream = parse(page)
    tokens: list = []
    at = 0
    for token in stream:
        if token[0] != "#":
            tokens.append(token)
            continue
        path, text = token[1:].split("|", 1)
        weight = 0
        if at < len(blocks) and blocks[at].path == path and blocks[at].text == text:
            weight = _weight(blocks[at])
            at += 1
        tokens.append([path, _mark(token[1:]), len(text), weight])
    return tokens


def _weight(block: Block) -> int:
    return 1 if block.hint else 8 if block.content else 4


def heaviest(texts: Iterable[tuple[str, int]]) -> str:
    """The deepest container with more than half of all weight of ``(path, weight)``, not an element of text; inside
    an article the whole article. Empty if there is none."""
    size: Counter = Counter()
    whole = 0
    for path, weight in texts:
        whole += weight
        parts = path.split("/")
        for k in range(2, len(parts) + 1):
            size["/".join(parts[:k])] += weight
    region = max((p for p, n in size.items() if 2 * n > whole), key=lambda p: (p.count("/"), p), default="")
    parts = region.split("/")
    while len(parts) > 1 and parts[-1].split(".")[0] in TEXT_ELEMENTS | {"ul", "ol", "dl", "table", "tbody", "tr"}:
        parts.pop()
    for k in range(len(parts) - 1, 0, -1):
        if parts[k].split(".")[0] == "article":
            return "/".join(parts[:k + 1])
    return "/".join(parts)


def main_text(blocks: list[Block], wrapper: HostWrapper) -> str:
    """The blocks of the page's content region (of the host's regions that with the most text on the page) that are
    no fixed texts and in no part named as something else, unless the region itself lies there. Where fixed
    texts hold half of the region or more, the page is a copy of others and keeps them."""
    template = set(wrapper.template)
    free = [block_mark(b) not in template for b in blocks]
    found: Counter = Counter()
    for b, is_free in zip(blocks, free):
        for region in wrapper.regions:
            if is_free and (b.path + "/").startswith(region + "/"):
                found[region] += len(b.text) * _weight(b)
    if found:
        region = max(found, key=lambda r: (found[r], r.count("/"), r))
    else:
        region = heaviest((b.path, len(b.text) * _weight(b)) for b, is_free in zip(blocks, free) if is_free)
    inside = [(b.text, is_free) for b, is_free in zip(blocks, free)
              if (b.path + "/").startswith(region + "/") and (not b.hint or (region + "/").startswith(b.hint + "/"))]
    if region and 2 * sum(len(text) for text, is_free in inside if not is_free) >= sum(len(text) for text, _ in inside):
        return " ".join(text for text, _ in inside)
    return " ".join(text for text, is_free in inside if is_free)


# -- Spark ----------------------------------------------------------------------

def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def learn_wrappers(pages: DataFrame, *, share: float = 0.9, common: float = 0.05, region: float = 0.1, least: int = 8) -> DataFrame:
    """``(host, wrapper)``, the wrapper as JSON, from all pages of each host; equal pages count once.

    A text at one path of ``share`` of a host's pages, ``least`` at least (fewer say too little), is fixed; elements on fewer than
    ``common`` of them are parts of slots; a container that ``region`` of them name is a content region. So what is
    kept of a host is bounded by the size of its pages, not by their number. Null pages, and rows without
    a host, teach nothing; an empty table gives no rows.
    """
    rows = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")) \
        .where("html is not null and host <> ''")
    parts = even_parts(pages)
    press = zstandard.ZstdCompressor

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, blobs = [], []
            for page in batch.column(1):
                page = page.as_py()
                marks.append(_mark(page))
                blobs.append(press(3).compress(json.dumps(shape(page), ensure_ascii=False).encode()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.int64()), pa.array(blobs, pa.binary())],
                                             names=["host", "page", "tokens"])

    known = staged(rows.mapInArrow(tidy(shapes), "host string, page long, tokens binary")
                   .groupBy("host", "page").agg(F.min("tokens").alias("tokens")), "page-shapes")

    def marks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: Counter = Counter()
            for host, blob in zip(batch.column(0).to_pylist(), batch.column(2)):
                n.update({(host, _mark(t), True) if isinstance(t, str) else (host, t[1], False)
                          for t in json.loads(zstandard.decompress(blob.as_py())) if t[1] != "/"})
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in n], pa.string()), pa.array([k[1] for k in n], pa.int64()),
                                              pa.array([k[2] for k in n], pa.bool_()), pa.array(n.values(), pa.int64())],
                                             names=["host", "mark", "is_tag", "n"])

    counts = known.mapInArrow(tidy(marks_of), "host string, mark long, is_tag boolean, n long") \
        .groupBy("host", "mark", "is_tag").agg(F.sum("n").alias("n")).where("n >= 2")
    hosts = known.groupBy("host").agg(F.count("*").alias("pages"))
    is_fixed = ~F.col("is_tag") & (F.col("n") >= least) & (F.col("n") >= share * F.col("pages"))
    is_common = F.col("is_tag") & (F.col("n") >= common * F.col("pages"))
    often = counts.join(hosts, "host").where(is_fixed | is_common).groupBy("host").agg(
        F.collect_list(F.when(~F.col("is_tag"), F.col("mark"))).alias("fixed"),
        F.collect_list(F.when(F.col("is_tag"), F.col("mark"))).alias("common"))
    often = staged(hosts.join(often, "host", "left"), "host-marks")

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, fixed, usual = None, set(), set()
        for batch in batches:
            n: Counter = Counter()
            for k, (host, pages_of, blob) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))):
                if host != last:
                    last, fixed, usual = host, set(batch.column(3)[k].as_py() or ()), set(batch.column(4)[k].as_py() or ())
                tokens = json.loads(zstandard.decompress(blob.as_py()))
                n[host, pages_of, "stream", json.dumps(skeleton(tokens, fixed, usual))] += 1
                n[host, pages_of, "region", heaviest((t[0], t[2] * t[3]) for t in tokens
                                                     if not isinstance(t, str) and t[1] not in fixed)] += 1
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in n], pa.int64() if i == 1 else pa.string()) for i in range(4)]
                                             + [pa.array(n.values(), pa.int64())], names=["host", "pages", "kind", "value", "n"])

    # a host with more than its even share of the pages is dealt over several tasks; there are fewer such hosts than
    # tasks, which bounds the broadcast, and fewer copies of their marks than twice that
    even = sum(r[0] or 0 for r in hosts.agg(F.sum("pages")).collect()) / parts
    often = often.withColumn("tasks", F.ceil(F.col("pages") / F.lit(max(even, 1.0))).cast("int"))
    large = F.broadcast(often.where("tasks > 1").select("host", "tasks"))
    dealt = known.join(large, "host", "left").withColumn("task", F.pmod("page", F.coalesce("tasks", F.lit(1))).cast("int")).drop("tasks")
    often = often.withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
    found = staged(dealt.hint("merge").join(often, ["host", "task"]).select("host", "pages", "tokens", "fixed", "common")
                   .mapInArrow(tidy(votes), "host string, pages long, kind string, value string, n long")
                   .groupBy("host", "pages", "kind", "value").agg(F.sum("n").alias("n")), "host-votes")

    def restored(items: list) -> list[Item]:
        return [x if isinstance(x, str) else ("slot",) if x[0] == "slot" else (x[0], restored(x[1])) for x in items]

    def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple]:
        def each():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        yield from groupby(each(), key=lambda r: r[:keys])

    def in_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (host, _), group in groups(batches, 2):
            wrapper = merged(restored(json.loads(value)) for *_, value in group)
            yield pa.RecordBatch.from_pydict({"host": [host], "kind": ["stream"], "value": [json.dumps(wrapper)]})

    def of_host(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (host,), group in groups(batches, 1):
            regions: list[str] = []

            def streams():
                for _, kind, value in group:
                    if kind == "region":
                        regions.append(value)
                    else:
                        yield restored(json.loads(value))

            wrapper = merged(streams())
            found = HostWrapper(sorted(fixed_marks(wrapper) - section_headings(wrapper)), regions, expression(wrapper))
            yield pa.RecordBatch.from_pydict({"host": [host], "wrapper": [json.dumps(found.__dict__, ensure_ascii=False)]})

    partial = found.where("kind = 'stream'").select("host", F.pmod(F.xxhash64("value"), F.lit(64)).alias("bucket"), "n", "value") \
        .repartition(parts, "host", "bucket").sortWithinPartitions("host", "bucket", F.desc("n"), "value") \
        .select("host", "bucket", "value").mapInArrow(tidy(in_bucket), "host string, kind string, value string")
    named = found.where(f"kind = 'region' and value <> '' and n >= {region} * pages").select("host", "kind", "value")
    return partial.unionByName(named).repartition(parts, "host").sortWithinPartitions("host", "kind", "value") \
        .mapInArrow(tidy(of_host), "host string, wrapper string")


def extract(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages(page_id, url, html)``.

    A null or empty ``html`` gives an empty text. Pages whose host has no wrapper are read by their own
    containers alone. Repeated rows and null ids or urls are kept; other columns are ignored; an empty table gives
    no rows. Only the blocks of a page are shuffled, compressed; a host with very many pages is split by
    adaptive execution.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(3)
        for batch in batches:
            blobs = []
            for page in batch.column(3):
                blocks, _ = parse(page.as_py() or "")
                blobs.append(press.compress(json.dumps([(b.path, b.text, b.content, b.hint) for b in blocks]).encode()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(blobs, pa.binary())],
                                             names=["page_id", "url", "host", "blocks"])

    blocks = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(tidy(read), "page_id long, url string, host string, blocks binary")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, wrapper = None, HostWrapper()
        for batch in batches:
            texts = []
            for data, known in zip(batch.column(2), batch.column(3)):
                known = known.as_py()
                if known != last:
                    last, wrapper = known, HostWrapper(**json.loads(known)) if known else HostWrapper()
                texts.append(main_text([Block(*b) for b in json.loads(zstandard.decompress(data.as_py()))], wrapper))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return blocks.hint("merge").join(wrappers, "host", "left").select("page_id", "url", "blocks", "wrapper") \
        .mapInArrow(tidy(finish), "page_id long, url string, text string, n_chars long")
