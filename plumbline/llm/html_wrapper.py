"""Main text of web pages by wrapper inference.

Pages of one host are filled into the same template. Their markup, as streams of block tags and text slots, is aligned
one page after the other; where streams differ, repeats become repeated groups and what only some pages have becomes
optional. The result is a union-free regular expression, the wrapper of the host. Its text slots are labelled once, by
the elements that they stand in, and every page that the wrapper accepts is read through it: each of its texts goes to
the slot that the expression assigns. Whether only slots inside ``article`` or ``main`` count is decided page by page. A page that its host's wrapper does not accept gets a wrapper of its own.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import arrow_map, stored, streamed

# HTML elements by their role.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes title textarea template".split())
HEAD = frozenset("title meta link script style base noscript template".split())
NO_END = frozenset("p li dt dd option optgroup tr td th thead tbody tfoot html body".split())
APART = frozenset("head nav header footer aside form button select dialog noscript svg menu fieldset".split())
MAIN = frozenset("article main".split())
# Words in class, id or role that mark what is no part of an article.
APART_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu modal nav navbar "
    "navigation newsletter notice notices popup promo promotion related respond search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
# Of these, words of places that hold other texts than the page's own, perhaps each in an ``article``.
OTHERS = frozenset("ad ads advert advertisement adverts comment comments disqus promo promotion related respond sponsor sponsored".split())
# A class name with one of these words tells of a state, such as has-sidebar or no-cookies, and marks nothing.
STATE = frozenset("closed disable disabled disables enable enabled enables free has have hide hides less no non not off on open show shows with without".split())
WHOLE = frozenset("html body".split()) | MAIN
# Elements whose end tag may be left out: the tags that end them, and the elements beyond which such a tag is not seen.
_CELLS, _PARTS = frozenset("td th tr thead tbody tfoot".split()), frozenset("thead tbody tfoot".split())
ENDED_BY = {
    "p": NO_END,
    "li": frozenset(["li"]),
    **dict.fromkeys(("dt", "dd"), frozenset("dt dd".split())),
    **dict.fromkeys(("option", "optgroup"), frozenset("option optgroup".split())),
    **dict.fromkeys(("td", "th"), _CELLS),
    "tr": _PARTS | {"tr"},
    **dict.fromkeys(_PARTS, _PARTS),
}
SCOPE = frozenset("ul ol menu dl table select".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)",
    re.S,
)
_HINT = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
TEXT = "#"


def _marks(rest: str) -> set[str]:
    """Words of class, id and role that mark something apart."""
    found: set[str] = set()
    if "=" in rest:
        for m in _HINT.finditer(rest):
            for one in (m[1] or m[2] or m[3] or "").lower().split():
                words = APART_WORDS.intersection(named := _WORD.findall(one))
                if words and STATE.isdisjoint(named):
                    found |= words
    return found


def tokens(html: str) -> Iterator[tuple[str, str]]:
    """(symbol, text): block tags, with ``!`` behind the name where the attributes speak of something apart, and text
    slots: ``#`` and the elements around it that matter, such as ``#article/div!``. An ``article`` or ``main`` inside of
something apart has ``?`` behind the name. Inline tags vanish, a line break is
    white space, end tags that HTML may leave out are left out, contents of scripts and the like are skipped.

    ``html``, ``body``, ``article`` and ``main`` are never apart by their attributes, nor is what contains the page's
    only ``article`` or ``main``, unless it holds comments, adverts and the like."""
    frames: list[tuple[bool, list[int]]] = []
    out = list(_scan(html, frozenset(), frames))
    if frames and all(hard or marks for hard, marks in frames):
        spared = frozenset(at for hard, marks in frames if not hard for at in marks)
        if spared:
            out = list(_scan(html, spared, []))
    return iter(out)


def _scan(html: str, spared: frozenset[int], frames: list[tuple[bool, list[int]]]) -> Iterator[tuple[str, str]]:
    """The tokens, where marks of the elements that start at ``spared`` do not count. ``frames`` gets, for each ``article``
    or ``main``, whether it stands in something apart for sure, and where elements around it start that are marked."""
    held: list[str] = []
    at = 0
    in_head = False
    marked: list[str] = []  # names of inline elements that are treated as blocks
    around: list[tuple[str, str, int, bool]] = []  # open elements: name, what a slot shows of it, start, whether of others

    def text() -> Iterator[tuple[str, str]]:
        if held:
            joined = " ".join("".join(held).split())
            held.clear()
            if joined:
                yield TEXT + "/".join(x[1] for x in around if x[1]), joined

    def leave(name: str) -> None:
        for n, *_ in reversed(around):
            if n == name:
                while around.pop()[0] != name:
                    pass
                return
            if name in NO_END and n in SCOPE:
                return

    while at < len(html):
        start = html.find("<", at)
        m = _MARKUP.match(html, start) if start >= 0 else None
        if m is None:
            stop = len(html) if start < 0 else start + 1
            held.append(entities.unescape(html[at:stop]))
            at = stop
            continue
        if start > at:
            piece = html[at:start]
            held.append(entities.unescape(piece) if "&" in piece else piece)
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        end = bool(m["end"] or m["end2"])
        marks = set() if end or name in WHOLE or start in spared else _marks(m["rest"] or "")
        apart = bool(marks)
        if name in RAW and not end:
            close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
            tail = html.find(">", close.end()) if close else -1
            at = tail + 1 if tail >= 0 else len(html)
            if name != "title" and name != "textarea":
                continue
            yield from text()
            continue
        if in_head and not end and name not in HEAD and name != "head":
            in_head = False
            leave("head")
            yield "/head", ""
        if name == "br":
            held.append(" ")
            continue
        if name in INLINE and not apart and not (end and name in marked):
            continue
        yield from text()
        left = False
        while around and (name in ENDED_BY.get(around[-1][0], ()) or not end and around[-1][0] == "p" or name in ("html", "body") and around[-1][0] in NO_END):
            left |= around.pop()[0] == name
            if left and end:
                break
        if end:
            if not left:
                leave(name)
            if name in marked:
                marked.remove(name)
            if name == "head":
                in_head = False
            if name not in NO_END and name not in VOID and name not in RAW:
                yield f"/{name}", ""
            continue
        if name in INLINE:
            marked.append(name)
        if name == "head":
            in_head = True
        if name not in VOID and (name not in NO_END or apart):
            around.append((name, name + "!" * apart if apart or name in APART or name in MAIN else "", start, not OTHERS.isdisjoint(marks)))
        if name not in ("html", "body") or apart:
            hidden = name in MAIN and any(x[1].endswith("!") or x[1] in APART for x in around[:-1])
            if name in MAIN:
                frames.append((any(x[0] in APART or x[3] for x in around[:-1]), [x[2] for x in around[:-1] if x[1].endswith("!")]))
            yield name + ("!" if apart else "?" if hidden else ""), ""
    yield from text()


# An item of a wrapper is [content, optional]: content is a symbol or, for a repeated group, a list of items.
Item = list


def fold(symbols: list, longest: int = 24) -> list:
    """Items of one stream: equal neighbouring groups of up to ``longest`` symbols become one repeated group."""
    items = [[s, False] for s in symbols]
    keys = [json.dumps(i) for i in items]
    size = 1
    while size <= longest:
        out, out_keys, i, changed = [], [], 0, False
        while i < len(items):
            body = keys[i : i + size]
            if len(body) == size and body == keys[i + size : i + 2 * size]:
                j = i + size
                while keys[j : j + size] == body:
                    j += size
                # A group of a single group stays what it is.
                content = items[i : i + size]
                item = content[0] if size == 1 and isinstance(content[0][0], list) else [content, False]
                if out and out[-1] == item:
                    changed = True
                else:
                    out.append(item)
                    out_keys.append(json.dumps(item))
                i, changed = j, True
            elif out and isinstance(out[-1][0], list) and len(out[-1][0]) == size and out_keys[-1] == json.dumps([items[i : i + size], False]):
                i += size  # one more of the group just closed
                changed = True
            else:
                out.append(items[i])
                out_keys.append(keys[i])
                i += 1
        items, keys = out, out_keys
        size = 1 if changed and size > 1 else size + 1
    return items


def _plain(item: Item) -> str:
    """The item without its marks of what is optional, its own and those inside."""

    def bare(content):
        return content if isinstance(content, str) else [bare(x[0]) for x in content]

    return json.dumps(bare(item[0]))


def _joined(a: Item, b: Item) -> Item:
    """Of two items that are alike but for what is optional: the one that accepts what either accepts."""
    content = a[0] if isinstance(a[0], str) else [_joined(x, y) for x, y in zip(a[0], b[0])]
    return [content, a[1] or b[1]]


def _regroup(items: list[Item], bodies: list[list[Item]]) -> list[Item]:
    """A single occurrence of a group that repeats elsewhere counts as that group."""
    keys = [_plain(x) for x in items]
    for wanted, body in sorted({json.dumps(w): (w, b) for b in bodies for w in [[_plain(x) for x in b]]}.values(), key=lambda x: -len(x[0])):
        if not set(wanted) <= set(keys):
            continue
        size, key = len(wanted), _plain([body, False])
        out, out_keys, i = [], [], 0
        while i < len(items):
            if keys[i] == wanted[0] and keys[i : i + size] == wanted:
                out.append([[_joined(b, x) for b, x in zip(body, items[i : i + size])], False])
                out_keys.append(key)
                i += size
            else:
                out.append(items[i])
                out_keys.append(keys[i])
                i += 1
        items, keys = out, out_keys
    return items


def _blocks(a: list[str], b: list[str], most: int = 1_000_000, cuts: int = 40) -> list[tuple[int, int, int]]:
    """(i, j, n) in order: ``n`` keys from ``i`` in ``a`` and from ``j`` in ``b`` are equal. Where ``a`` times ``b`` is over
    ``most``, keys that stand once on either side cut them into parts, again and again; a part that has none is matched key by key."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    x, y = a[start : len(a) - end], b[start : len(b) - end]
    if len(x) * len(y) <= most:
        inner = [tuple(m) for m in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()[:-1]]
    elif cuts and (anchors := _anchors(x, y)):
        inner, i, j = [], 0, 0
        for p, q in [*anchors, (len(x), len(y))]:
            inner += [(i + k, j + m, n) for k, m, n in _blocks(x[i:p], y[j:q], most, cuts - 1)]
            if p < len(x):
                inner.append((p, q, 1))
            i, j = p + 1, q + 1
    else:
        places: dict[str, list[int]] = {}
        for i, key in enumerate(x):
            places.setdefault(key, []).append(i)
        inner, i = [], 0
        for j, key in enumerate(y):
            known = places.get(key, [])
            at = bisect_left(known, i)
            if at < len(known) and known[at] - i <= 256:
                inner.append((known[at], j, 1))
                i = known[at] + 1
    return [(0, 0, start)] * (start > 0) + [(start + i, start + j, n) for i, j, n in inner] + [(len(a) - end, len(b) - end, end)] * (end > 0)


def _anchors(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """The longest run of (i, j), rising in both, where a key that stands once in ``a`` and once in ``b`` stands."""
    once, other = Counter(a), Counter(b)
    at = {key: j for j, key in enumerate(b)}
    pairs = [(i, at[key]) for i, key in enumerate(a) if once[key] == 1 and other[key] == 1]
    tails: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        tails[k : k + 1] = [j]
        last[k : k + 1] = [n]
        before.append(last[k - 1] if k else -1)
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def align(wrapper: list[Item], page: list[Item]) -> list[Item]:
    """The wrapper that accepts what ``wrapper`` accepts and ``page``: items of only one side become optional, a repeated
    group next to its like is one with it."""
    ours = [i[0] for i in wrapper if isinstance(i[0], list)]
    theirs = [i[0] for i in page if isinstance(i[0], list)]
    wrapper, page = _regroup(wrapper, theirs), _regroup(page, ours)
    keys, their_keys = [_plain(i) for i in wrapper], [_plain(i) for i in page]
    both: list[tuple[str, Item]] = []
    a = b = 0
    for i, j, n in [*_blocks(keys, their_keys), (len(wrapper), len(page), 0)]:
        both += [(k, [w[0], True]) for k, w in zip(keys[a:i], wrapper[a:i])] + [(k, [p[0], True]) for k, p in zip(their_keys[b:j], page[b:j])]
        both += [(k, _joined(w, p)) for k, w, p in zip(keys[i : i + n], wrapper[i : i + n], page[j : j + n])]
        a, b = i + n, j + n
    out: list[Item] = []
    before = None
    for key, item in both:
        if key == before and isinstance(item[0], list):
            out[-1] = [_joined(out[-1], item)[0], out[-1][1] and item[1]]
        else:
            out.append(item)
        before = key
    return out


def infer(streams: list[list[str]]) -> list[Item]:
    """Wrapper of several pages, aligned one after the other."""
    wrapper: list[Item] | None = None
    for stream in streams:
        page = fold(stream)
        wrapper = page if wrapper is None else align(wrapper, page)
    return wrapper or []


@lru_cache(maxsize=4096)
def _slot(symbol: str) -> tuple[bool, bool]:
    """Of a text slot: whether nothing around it stands apart, and whether it is inside ``article`` or ``main``."""
    path = symbol[1:].split("/") if symbol.startswith(TEXT) else ["head"]
    return not any(x.endswith("!") or x in APART for x in path), any(x in MAIN for x in path)


def _bits(places: list[int]) -> int:
    """The number with these bits, given in order."""
    if not places:
        return 0
    low = places[0]
    digits = bytearray((places[-1] - low) // 8 + 1)
    for p in places:
        digits[(p - low) >> 3] |= 1 << ((p - low) & 7)
    return int.from_bytes(digits, "little") << low


def _places(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


class Wrapper:
    """Automaton of a wrapper. Its states are sets of places in the expression, as bits of a number, made as pages ask for
    them. What may follow a place is a stretch of its sequence of items, up to the first one that is not optional, so the
    automaton grows with the expression and not with its square, however much of it is optional."""

    def __init__(self, items: list[Item]):
        self.symbol: list[str] = []
        self.home: list[tuple[int, int]] = []  # of a place: its sequence and the item there
        # Of a sequence: where it is repeated, the first place of each item and the place behind all, from each item the next
        # that is not optional, the places that its items can start with, and those that are items themselves.
        self.parent: list[tuple[int, int] | None] = []
        self.begin: list[list[int]] = []
        self.stop: list[list[int]] = []
        self.heads: list[int] = []
        self.own: list[int] = []
        self._sequence(items, None)
        found: dict[str, list[int]] = {}
        for place, symbol in enumerate(self.symbol):
            found.setdefault(symbol, []).append(place)
        self.places = {symbol: _bits(places) for symbol, places in found.items()}
        self.framed = any(all(_slot(s)) for s in self.places)
        self._forget()

    def _sequence(self, items: list[Item], parent: tuple[int, int] | None) -> bool:
        """Adds a sequence of items; whether all of it can be left out."""
        me, own, passed = len(self.parent), [], []
        begin, stop = [], list(range(len(items) + 1))
        self.parent.append(parent)
        self.begin.append(begin)
        self.stop.append(stop)
        self.heads.append(0)
        self.own.append(0)
        for n, (content, optional) in enumerate(items):
            begin.append(len(self.symbol))
            if isinstance(content, list):
                inner = len(self.parent)
                optional = self._sequence(content, (me, n)) or optional
                self.heads[me] |= self._starts(inner, 0)
            else:
                own.append(len(self.symbol))
                self.symbol.append(content)
                self.home.append((me, n))
            passed.append(optional)
        begin.append(len(self.symbol))
        for n in reversed(range(len(items))):
            if passed[n]:
                stop[n] = stop[n + 1]
        self.own[me] = _bits(own)
        self.heads[me] |= self.own[me]
        return stop[0] == len(items)

    def _starts(self, sequence: int, item: int) -> int:
        """Places that can come next where ``item`` of the sequence can."""
        begin, stop = self.begin[sequence], self.stop[sequence]
        return self.heads[sequence] & ((1 << begin[min(stop[item] + 1, len(begin) - 1)]) - (1 << begin[item]))

    def _from(self, sequence: int, item: int) -> tuple[int, bool]:
        """The same with what follows behind the sequence, and whether the page can end there."""
        found = self._starts(sequence, item)
        while self.stop[sequence][item] == len(self.stop[sequence]) - 1:
            if self.parent[sequence] is None:
                return found, True
            found |= self._starts(sequence, 0)
            sequence, item = self.parent[sequence]
            item += 1
            found |= self._starts(sequence, item)
        return found, False

    def _forget(self) -> None:
        """Leaves the state before the first symbol."""
        self.known: dict[int, int] = {}
        self.ahead = [self._from(0, 0)]  # of each state: the places that can come next, whether the page can end
        self.moves: list[dict[str, int]] = [{}]

    def _move(self, state: int, symbol: str) -> int:
        """The next state, or -1 if there is none."""
        places = self.ahead[state][0] & self.places.get(symbol, 0)
        to = self.known.get(places, -1)
        if places and to < 0:
            steps, rest = [], places
            while rest:
                sequence, item = self.home[(rest & -rest).bit_length() - 1]
                steps.append(self._from(sequence, item + 1))
                # What follows this place follows the others up to the next item that is not optional.
                begin, stop = self.begin[sequence], self.stop[sequence]
                rest &= ~(self.own[sequence] & ((1 << begin[stop[item + 1]]) - (1 << begin[item])))
            to = self.known[places] = len(self.ahead)
            self.ahead.append((reduce(or_, (x for x, _ in steps)), any(ends for _, ends in steps)))
            self.moves.append({})
        self.moves[state][symbol] = to
        return to

    def _bounded(self) -> None:
        if len(self.ahead) * len(self.symbol) > 1 << 23:
            self._forget()

    def covers(self, items: list[Item]) -> bool:
        """Whether this wrapper accepts whatever the wrapper of ``items`` does."""
        self._bounded()
        other = Wrapper(items)
        after = [other._from(sequence, item + 1) for sequence, item in other.home]
        seen: set[tuple[int, int]] = set()
        todo = [(other.ahead[0], 0)]
        while todo:
            (ahead, ends), state = todo.pop()
            if ends and not self.ahead[state][1]:
                return False
            for place in _places(ahead):
                symbol = other.symbol[place]
                to = self.moves[state].get(symbol)
                if to is None:
                    to = self._move(state, symbol)
                if to < 0:
                    return False
                if (place, to) not in seen:
                    seen.add((place, to))
                    todo.append((after[place], to))
        return True

    def read(self, page: list[tuple[str, str]]) -> list[str] | None:
        """Texts of the article, or None if the wrapper does not accept the page. Slots in nothing that stands apart
        count; of these only slots inside ``article`` or ``main``, if the page uses such a slot, or has such an element
        without text where other pages of the wrapper have text."""
        self._bounded()
        state, moves = 0, self.moves
        framed = self.framed and any(symbol in MAIN for symbol, _ in page)
        out = []
        for symbol, text in page:
            to = moves[state].get(symbol)
            if to is None:
                to = self._move(state, symbol)
            if to < 0:
                return None
            state = to
            near, inside = _slot(symbol)
            if near:
                out.append((text, inside))
        if not self.ahead[state][1]:
            return None
        framed = framed or any(inside for _, inside in out)
        return [text for text, inside in out if inside or not framed]


@lru_cache(maxsize=512)
def _compiled(wrapper: str) -> Wrapper:
    items, framed = json.loads(wrapper)
    known = Wrapper(items)
    known.framed = known.framed or framed
    return known


def extract(html: str, wrapper: str | None) -> tuple[str, bool]:
    """(main text, whether the host's wrapper read the page). A page that it refuses gets a wrapper of its own, which takes
    from the host whether any of its pages has text in ``article`` or ``main``; so both read the same texts."""
    page = list(tokens(html))
    known = _compiled(wrapper) if wrapper else None
    texts = known.read(page) if known and known.symbol else None
    by_host = texts is not None
    if texts is None:
        own = Wrapper(infer([[s for s, _ in page]]))
        own.framed = own.framed or known is not None and known.framed
        texts = own.read(page) or []
    return " ".join(texts), by_host


def wrappers(pages: DataFrame, shapes: int = 32) -> DataFrame:
    """(host, wrapper), stored: [items inferred from the folded streams of all pages of each host; whether any page of the
    host has text in ``article`` or ``main``]. So the wrapper accepts every page of its host that has any markup or text.

    Streams are aligned one after the other, the commonest first, ties by their hash. A round aligns up to ``shapes`` streams
    of each host, or one more, and each that follows twice as many; between rounds all streams that the wrapper accepts by now
    are found in parallel and are done with.
    ``shapes`` decides how the work is dealt out; no stream is left out, however many or long they are. What a page's text
    is depends on the page and on the mark alone."""

    def make():
        def work(batch):
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                stream = [s for s, _ in tokens(html)]
                if any(all(_slot(s)) for s in stream if s.startswith(TEXT)):
                    yield host, ""  # marks the host
                if stream:
                    yield host, json.dumps(fold(stream))

        return work

    def together():
        def work(host, rows):
            found: list[Item] = []
            framed, known = False, None
            for _, shape, place in rows:
                if place == 0:
                    found, framed = json.loads(shape)
                elif shape == "":
                    framed = True
                elif not found:
                    found = json.loads(shape)
                else:
                    known = known or Wrapper(found)
                    if not known.covers(page := json.loads(shape)):
                        found, known = align(found, page), None
            yield host, json.dumps([found, framed])

        return work

    def refused():
        def work(batch):
            for host, shape, n, wrapper in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not _compiled(wrapper).covers(json.loads(shape)):
                    yield host, shape, n

        return work

    order = Window.partitionBy("host").orderBy(F.col("shape") != "", F.desc("n"), F.xxhash64("shape"), "shape")

    def refined(left: DataFrame, take: int, before: DataFrame | None = None) -> DataFrame:
        rows = left.withColumn("place", F.row_number().over(order)).where(F.col("place") <= take).select("host", "shape", "place")
        if before is not None:
            rows = rows.unionByName(before.select("host", F.col("wrapper").alias("shape"), F.lit(0).alias("place")))
        return stored(streamed(rows, "host", ("place",), together, "host string, wrapper string"))

    counted = stored(arrow_map(pages.select("host", "html"), make, "host string, shape string").groupBy("host", "shape").agg(F.count("*").alias("n")))
    found = refined(counted, shapes + 1)
    crowded = counted.groupBy("host").agg(F.count_if(F.col("shape") != "").alias("_n")).where(F.col("_n") > shapes).select("host")
    left = counted.where(F.col("shape") != "").join(crowded, "host", "left_semi")
    while not left.isEmpty():
        joined = left.join(found, "host").select("host", "shape", "n", "wrapper")
        left = stored(arrow_map(joined, refused, "host string, shape string, n bigint"))
        if not left.isEmpty():
            shapes *= 2
            found = refined(left, shapes, found)
    return found


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", shapes: int = 32) -> DataFrame:
    """page_id, url, text, n_chars (code points) and by_host (read by its host's wrapper) of every page.

    Character references are decoded, white space inside a block is one space, blocks are joined by one space. A null or
    empty page has the empty text; pages with a null or odd url share one host; null ids and repeated rows are kept; an
    empty table gives no rows; other columns are left out."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), host.alias("host"))
    # It is stored, so its size is known before the join: as a rule it is broadcast and no page is shuffled. Beyond the
    # broadcast threshold the join is by shuffle, with one row per host on this side, so a hot host can be split.
    found = wrappers(rows, shapes).withColumnRenamed("host", "_host")

    def make():
        def work(batch):
            for page, url, html, wrapper in zip(*(batch.column(i).to_pylist() for i in range(4))):
                text, by_host = extract(html, wrapper)
                yield page, url, text, len(text), by_host

        return work

    joined = rows.join(found, F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "wrapper")
    return arrow_map(joined, make, "page_id bigint, url string, text string, n_chars bigint, by_host boolean")
