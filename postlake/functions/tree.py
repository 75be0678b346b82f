"""Nesting of markup as column expressions: tags in page order with their running depth.

No page tree is built.  A page is the list of its tags; two running sums tell how deep each
lies: ``depth`` counts every tag that can hold others, ``block`` only those whose end tag is
never left out.  An element ends where ``block`` falls below its own level; one whose end tag
may be left out ends at the next tag of its name on its level too, a paragraph where a block
starts in it.  So a missing ``</p>`` or ``</b>`` does not shift what follows.  Stray end tags never lead below level 0.  Cost is
linear in the tags for each level that holds a wanted element.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.html import hrefs, inner_text

# --- Fixed values: elements without content; those whose end tags are often left
# out; those whose start ends an open paragraph ---------------------------------------------------
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
LOOSE = (
    "p", "li", "dt", "dd", "option", "tr", "td", "th", "thead", "tbody", "tfoot",
    "a", "b", "i", "u", "em", "strong", "small", "font",
)
CLOSES_P = (
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "header", "main", "nav", "ol", "pre", "section", "table", "ul",
)

_UNREAD = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
_TAG = r"</?[a-zA-Z][a-zA-Z0-9-]*\b[^>]*>"
# What is no tag or one that holds a "<".
_NOT_SIMPLE = r"<(?!/?[a-zA-Z][a-zA-Z0-9-]*\b[^<>]*>)"
_BLOCK = 32
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Names whose tags leave ``block`` as it is, by first letter: fewer branches to try.
_BY_LETTER = (f"{a}(?:{'|'.join(n[1:] for n in (*VOID, *LOOSE) if n[0] == a)})" for a in sorted({n[0] for n in (*VOID, *LOOSE)}))
_FLAT = rf"(?i)^/?(?:{'|'.join(_BY_LETTER)})(?![a-zA-Z0-9-])"

Test = Callable[[Column], Column]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    # Not [0], which works out the type of the whole list anew for each row.
    return F.element_at(F.transform(F.array(value), use), F.lit(1))


def has_class(name: str) -> Test:
    """Start tags of a class."""
    value = rf"[^\"'>]*(?<![\w-]){name}(?![\w-])[^\"'>]*"
    pattern = rf"(?i)^<?[a-z][^>]*?\sclass\s*=\s*[\"']{value}[\"']"
    plain = re.fullmatch(r"[\w-]+", name, re.ASCII)

    def test(node: Column) -> Column:
        # Most tags have no attribute, and few that have one name the class: the others need no search.
        held = node["tag"].contains("=")
        if plain:
            held &= node["tag"].contains(name) | F.lower(node["tag"]).contains(name.lower())
        return held & node["tag"].rlike(pattern)

    return test


def running_depth(steps: Column) -> Column:
    """Running sums of steps, never below 0.

    Growing an array copies it, so sums run in blocks, each of which begins with the last sum before it.
    """
    last = lambda sums: F.element_at(sums, F.lit(-1))

    def added(sums: Column, by: Column) -> Column:
        return F.array_append(sums, F.greatest(last(sums) + by, F.lit(0)))

    def summed(all_steps: Column) -> Column:
        size = F.size(all_steps)

        def block(done: Column, n: Column) -> Column:
            # Not a slice, which walks over all that lies before it.
            places = F.sequence(n * _BLOCK, F.least(n * _BLOCK + _BLOCK, size) - 1)
            sums = F.aggregate(places, F.array(last(last(done))), lambda s, i: added(s, F.get(all_steps, i)))
            return F.array_append(done, sums)

        numbers = F.sequence(F.lit(0), F.floor((size - 1) / _BLOCK).cast("int"))
        outs = F.aggregate(numbers, F.array(F.array(F.lit(0))), block)
        many = F.flatten(F.transform(outs, lambda out: F.slice(out, 2, _BLOCK)))
        few = F.slice(F.aggregate(all_steps, F.array(F.lit(0)), added), 2, _BLOCK)
        return F.when(size <= _BLOCK, few).otherwise(many)

    return bound(steps, summed)


def nodes(html: Column, *, deep: bool = True) -> Column:
    """All tags of a page in order: ``name``, ``tag``, ``text`` (what follows it), ``opens``,
    ``depth`` (if ``deep``) and ``block`` (levels after the tag).  Comments, scripts and styles are left out."""

    def parsed(page: Column) -> Column:
        found = F.regexp_extract_all(page, F.lit(_TAG), F.lit(0))
        # A page has at most as many pieces more than one as characters: all but the first.
        texts = F.slice(F.split(page, _TAG, -1), F.lit(2), F.char_length(page) + 1)
        return F.zip_with(
            found,
            texts,
            lambda tag, text: F.struct(
                F.translate(F.regexp_extract(tag, r"^</?([a-zA-Z][a-zA-Z0-9-]*)", 1), _UPPER, _UPPER.lower()).alias("name"),
                tag.alias("tag"),
                text.alias("text"),
                (~tag.startswith("</")).alias("opens"),
            ),
        )

    def stepped(tags: Column) -> Column:
        side = lambda t: F.when(t["name"].isin(*VOID), 0).when(t["opens"], 1).otherwise(-1)
        own = ("name", "tag", "text", "opens")
        block = running_depth(F.transform(tags, lambda t: F.when(t["name"].isin(*LOOSE), 0).otherwise(side(t))))
        if not deep:
            return F.zip_with(tags, block, lambda t, b: F.struct(*(t[c].alias(c) for c in own), b.alias("block")))
        depth = running_depth(F.transform(tags, side))
        levels = F.zip_with(depth, block, lambda d, b: F.struct(d.alias("depth"), b.alias("block")))
        return F.zip_with(
            tags,
            levels,
            lambda t, at: F.struct(
                *(t[c].alias(c) for c in own),
                *(at[c].alias(c) for c in ("depth", "block")),
            ),
        )

    read = F.regexp_replace(html, _UNREAD, "")
    return F.when(html.isNotNull(), bound(bound(read, parsed), stepped))


def spans(page: Column, wanted: Test) -> Column:
    """(start, end) places in ``page``, a bound list of nodes, of the elements whose start tags
    are wanted, in page order; the end is exclusive."""
    places = F.transform(
        page,
        lambda n, i: F.struct(
            i.alias("at"), n["name"].alias("name"), n["block"].alias("block"),
            (n["opens"] & wanted(n)).alias("starts"),
            (n["opens"] & n["name"].isin(*CLOSES_P)).alias("ends_p"),
        ),
    )

    def of_level(all_places: Column, level: Column) -> Column:
        def ends(p: Column) -> Column:
            same = (p["name"] == level["name"]) & (p["block"] == level["block"])
            in_p = p["ends_p"] & (level["name"] == "p") & (p["block"] == level["block"] + 1)
            return (p["block"] < level["block"]) | in_p | (same & (p["starts"] | p["name"].isin(*LOOSE)))

        def paired(edges: Column) -> Column:
            pairs = F.transform(
                edges,
                lambda e, k: F.struct(
                    e["at"].alias("start"),
                    F.coalesce(F.get(edges, k + 1)["at"], F.size(page)).alias("end"),
                    (e["starts"] & (e["block"] == level["block"]) & (e["name"] == level["name"])).alias("starts"),
                ),
            )
            found = F.filter(pairs, lambda p: p["starts"])
            return F.transform(found, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))

        return bound(F.filter(all_places, ends), paired)

    def found(all_places: Column) -> Column:
        starts = F.filter(all_places, lambda p: p["starts"])
        levels = F.array_distinct(
            F.transform(starts, lambda p: F.struct(p["name"].alias("name"), p["block"].alias("block")))
        )
        return F.array_sort(F.flatten(F.transform(levels, lambda level: of_level(all_places, level))))

    return bound(places, found)


def _slice(page: Column, span: Column) -> Column:
    return F.slice(page, span["start"] + 1, span["end"] - span["start"])


def _text(page: Column, span: Column) -> Column:
    return bound(F.array_join(F.transform(_slice(page, span), lambda n: n["text"]), ""), inner_text)


def whole_texts(html: Column, wanted: Test) -> Column:
    """Whole texts, inner elements included, of the wanted elements; blanks dropped."""
    texts = bound(nodes(html, deep=False), lambda page: F.transform(spans(page, wanted), lambda s: _text(page, s)))
    return F.when(html.isNotNull(), F.filter(texts, lambda text: text != ""))


def child_links(html: Column, parent: Test, inside: Test | None = None) -> Column:
    """Targets of the links that are children of a wanted element, wherever they stand in it;
    with ``inside`` only those that lie within such an element."""

    def of_part(part: Column) -> Column:
        def children(span: Column) -> Column:
            level = F.get(part, span["start"])["depth"] + 1
            held = F.filter(_slice(part, span), lambda n: n["opens"] & (n["name"] == "a") & (n["depth"] == level))
            return F.transform(held, lambda n: n["tag"])

        return F.flatten(F.transform(spans(part, parent), children))

    def of_page(page: Column) -> Column:
        if inside is None:
            return of_part(page)
        boxes = bound(spans(page, inside), lambda found: F.filter(found, lambda b, k: ~_covered(found, b, k)))
        return F.flatten(F.transform(boxes, lambda box: bound(_slice(page, box), of_part)))

    return hrefs(F.array_join(bound(nodes(html), of_page), "\n"))


def _covered(found: Column, box: Column, place: Column) -> Column:
    """Whether the box lies in an earlier one: then its links are that one's."""
    earlier = F.slice(found, F.lit(1), place)
    return F.exists(earlier, lambda b: b["end"] > box["start"])


def _cut(html: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of the tags of a page in order, without their "<" and with the text that follows, and of
    ``block`` as in ``nodes``."""

    def side(tag: Column) -> Column:
        return F.when(tag.rlike(_FLAT), 0).when(tag.startswith("/"), -1).otherwise(1)

    def tags(page: Column) -> Column:
        most = F.char_length(page) + 1
        found = F.regexp_extract_all(page, F.lit(_TAG), F.lit(0))
        texts = F.slice(F.split(page, _TAG, -1), F.lit(2), most)
        both = F.zip_with(found, texts, lambda tag, text: F.concat(tag.substr(F.lit(2), F.char_length(tag)), text))
        return F.when(page.rlike(_NOT_SIMPLE), both).otherwise(F.slice(F.split(page, "<", -1), F.lit(2), most))

    def of_tags(found: Column) -> Column:
        return bound(running_depth(F.transform(found, side)), lambda block: use(found, block))

    # Only pages with these can hold what is not read.
    unread = html.contains("<!--") | html.contains("<s") | html.contains("<S")
    read = F.when(unread, F.regexp_replace(html, _UNREAD, "")).otherwise(html)
    return F.when(html.isNotNull(), bound(read, lambda page: bound(tags(page), of_tags)))


def _end(tags: Column, block: Column, start: Column, most: Column, wanted: Callable[[Column], Column]) -> Column:
    """Where the element that starts there ends, as in ``spans``; ``most`` if that comes first.

    Most elements are short: the next tags are tried one by one, later ones in windows that grow.
    """
    level = F.get(block, start)

    def name_of(i: Column) -> Column:
        return F.lower(F.regexp_extract(F.get(tags, i), r"^/?([a-zA-Z][a-zA-Z0-9-]*)", 1))

    def searched(ends: Callable[[Column], Column], near: int, *windows: int) -> Column:
        found, since = [F.when(ends(start + k), start + k) for k in range(1, near + 1)], near + 1
        for n in (*windows, None):
            left = most - start - since
            last = start + since - 1 + (left if n is None else F.least(left, F.lit(n)))
            found.append(F.when(left > 0, F.get(F.filter(F.sequence(start + since, last), ends), F.lit(0))))
            since += n or 0
        return F.least(F.coalesce(*found, most), most)

    def of_flat(name: Column) -> Column:
        def ends(i: Column) -> Column:
            at = F.get(block, i)
            same = (at == level) & (name.isin(*LOOSE) | wanted(i)) & (name_of(i) == name)
            in_p = (at == level + 1) & (name == "p") & ~F.get(tags, i).startswith("/") & name_of(i).isin(*CLOSES_P)
            return (at < level) | same | in_p

        return searched(ends, 0, 4, 64, 1024)

    below = searched(lambda i: F.get(block, i) < level, 8, 128, 2048)
    return F.when(F.get(tags, start).rlike(_FLAT), bound(name_of(start), of_flat)).otherwise(below)


def group_values(html: Column, group: Test, label: Test, value: Test) -> Column:
    """(label, value) of each group element: the texts of the first label and the first value
    element in it; NULL where it has none."""

    def of_page(tags: Column, block: Column) -> Column:
        def marks(places: Column) -> Column:
            """A "1" at each place, a "0" at those between."""
            gap = lambda i, k: F.repeat(F.lit("0"), i - F.coalesce(F.get(places, k - 1), F.lit(-1)) - 1)
            return F.array_join(F.transform(places, lambda i, k: F.concat(gap(i, k), F.lit("1"))), "")

        def marked(here: Column, i: Column) -> Column:
            return F.substring(here, i + 1, F.lit(1)) == "1"

        def text(start: Column, stop: Column) -> Column:
            own = lambda tag: tag.substr(F.instr(tag, ">") + 1, F.char_length(tag))
            all_own = F.array_join(F.transform(F.sequence(start, stop - 1), lambda i: own(F.get(tags, i))), "")
            return bound(F.when(stop == start + 1, own(F.get(tags, start))).otherwise(all_own), inner_text)

        def first(start: Column, stop: Column, here: Column) -> Column:
            def of_place(at: Column) -> Column:
                end = _end(tags, block, at, stop, lambda i: marked(here, i))
                return F.when((at >= start) & (at < stop), bound(end, lambda e: text(at, e)))

            return bound(F.call_function("locate", F.lit("1"), here, start + 1) - 1, of_place)

        def of_marks(starts: Column, groups: Column, labels: Column, values: Column) -> Column:
            def of_group(start: Column) -> Column:
                return bound(
                    _end(tags, block, start, F.size(tags), lambda i: marked(groups, i)),
                    lambda stop: bound(
                        F.transform(F.array(labels, values), lambda here: first(start, stop, here)),
                        lambda texts: F.struct(F.get(texts, 0).alias("label"), F.get(texts, 1).alias("value")),
                    ),
                )

            return F.transform(starts, of_group)

        def of_places(places: Column) -> Column:
            kept = lambda wanted: F.filter(places, lambda i: wanted({"tag": F.get(tags, i)}))
            mark = lambda wanted, use: bound(kept(wanted), lambda found: bound(marks(found), use))
            return bound(
                kept(group),
                lambda starts: bound(
                    marks(starts),
                    lambda g: mark(label, lambda n: mark(value, lambda v: of_marks(starts, g, n, v))),
                ),
            )

        # Tags without an attribute are not asked for more.
        with_attributes = F.filter(F.sequence(F.lit(0), F.size(tags)), lambda i: F.get(tags, i).contains("="))
        return bound(with_attributes, of_places)

    return _cut(html, of_page)
