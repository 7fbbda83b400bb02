"""Pages as trees of blocks, and the wrappers inferred from them (plain Python used inside tasks).

A wrapper is a regular expression without unions over a page's block structure:
items of text (literal or slot) and elements, each required or optional, single or
repeated, and repeated groups of several items.
"""

from __future__ import annotations

import html
import json
import re
from difflib import SequenceMatcher

import xxhash

MAX_DEPTH = 150

# Element names by role.
BLOCKS = frozenset("""html body head title p div section article main h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption
thead tbody tfoot tr td th blockquote pre hr figure figcaption header footer nav aside form fieldset legend address
details summary center menu dialog hgroup""".split())
UNSEEN = frozenset("script style noscript template svg math iframe object canvas audio video textarea select button head title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption #".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody")}
HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
         "thead": ("table",), "tbody": ("table",), "tfoot": ("table",)}

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
NAMED = re.compile(r"""\b(class|id|role|itemprop|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
NOISE = re.compile(r"""^(ads?|adverts?|advertisements?|adsense|adslot|adbox|banner|promo\w*|sponsor\w*|sidebar|side|menus?|nav|navbar|navigation
|breadcrumbs?|footer|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscribe|subscription|signup|share|sharing
|social|related|recommend\w*|comments?|commentlist|replies|reply|respond|disqus|widgets?|login|search|pagination|pager|copyright|legal
|toolbar|tags|byline|hidden|complementary|contentinfo|banners|masthead|topbar|teaser|teasers)$""", re.X)
BODY = re.compile(r"^(article|articlebody|content|post|entry|story|main|text|maincontent)$")


class Node:
    __slots__ = ("name", "marks", "kids")

    def __init__(self, name: str, marks: tuple[str, ...]):
        self.name, self.marks, self.kids = name, marks, []

    @property
    def sig(self) -> str:
        return ".".join((self.name, *self.marks))


def marks_of(attributes: str) -> tuple[str, ...]:
    """Words of class, id, role and itemprop, without digits."""
    found = []
    for name, a, b, c in NAMED.findall(attributes):
        if name.lower() == "hidden":
            found.append("hidden")
        found += [w for w in re.split(r"[^a-z]+", (a or b or c).lower()) if w]
    return tuple(dict.fromkeys(found))[:6]


def parse(page: str) -> Node:
    """The page's blocks; texts are ``(text, characters in links)`` between block borders, references decoded."""
    root = Node("body", ())
    stack, run, links = [root], [], [0, 0]

    def flush() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            stack[-1].kids.append((text, min(links[1], len(text))))
        run.clear()
        links[1] = 0

    def close(names: tuple[str, ...], held: tuple[str, ...] = ()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in held:
                return
            if stack[i].name in names:
                del stack[i:]
                return

    def text(part: str) -> None:
        if part:
            run.append(part)
            if links[0]:
                links[1] += len(part.strip())

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        if m["name"] is None:
            continue
        name, opening = m["name"].lower(), not m["end"]
        if name in UNSEEN:
            if opening and not m["rest"].rstrip().endswith("/"):
                over = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = over.end() if over else (end if name in ("script", "style") else at)
            continue
        if name == "a":
            links[0] = int(opening)
        if name not in BLOCKS:
            if name in VOID:
                text(" ")
            continue
        flush()
        if name in ("html", "body", "hr"):
            continue
        if opening:
            links[0] = 0
            if stack[-1].name == "p":
                stack.pop()
            if name in CLOSES:
                while True:
                    depth = len(stack)
                    close(CLOSES[name], HOLDS[name])
                    if len(stack) == depth:
                        break
            node = Node(name, marks_of(m["rest"]))
            stack[-1].kids.append(node)
            if len(stack) < MAX_DEPTH:
                stack.append(node)
        else:
            close((name,))
    flush()
    return root


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def fold(node: Node) -> dict:
    """A wrapper of one page: equal neighbours become repeated items or groups."""
    items: list[dict] = []
    for kid in node.kids:
        if isinstance(kid, tuple):
            item = {"sig": "#", "text": text_hash(kid[0]), "chars": len(kid[0]), "links": kid[1], "must": True, "many": False, "kids": []}
        else:
            item = fold(kid)
        if items and items[-1]["sig"] == item["sig"]:
            items[-1] = merge(items[-1], item) | {"many": True}
        else:
            items.append(item)
        for size in (2, 3):
            _fold_group(items, size)
    return {"sig": node.sig, "text": None, "must": True, "many": False, "kids": items,
            "chars": sum(i["chars"] for i in items), "links": sum(i["links"] for i in items)}


def _fold_group(items: list[dict], size: int) -> None:
    """Replace the last items by a repeated group if they repeat what is before them."""
    last = items[-size:]
    sigs = [i["sig"] for i in last]
    if len(items) > size and items[-size - 1]["sig"] == "()" and [i["sig"] for i in items[-size - 1]["kids"]] == sigs:
        group = items[-size - 1]
        group["kids"] = [merge(a, b) for a, b in zip(group["kids"], last)]
    elif len(items) >= 2 * size and "()" not in sigs and [i["sig"] for i in items[-2 * size:-size]] == sigs:
        group = {"sig": "()", "text": None, "must": True, "many": True,
                 "kids": [merge(a, b) for a, b in zip(items[-2 * size:-size], last)]}
        del items[-2 * size:-size]
        items.insert(len(items) - size, group)
    else:
        return
    del items[-size:]
    group["chars"], group["links"] = (sum(i[k] for i in group["kids"]) for k in ("chars", "links"))


def merge(a: dict, b: dict) -> dict:
    """One item for both; differing texts become a slot (None)."""
    return {"sig": a["sig"], "text": a["text"] if a["text"] == b["text"] else None, "chars": a["chars"] + b["chars"],
            "links": a["links"] + b["links"], "must": a["must"] and b["must"], "many": a["many"] or b["many"],
            "kids": align(a["kids"], b["kids"])}


def align(a: list[dict], b: list[dict]) -> list[dict]:
    """Items that match are merged, the others become optional."""
    left, right = [i["sig"] for i in a], [i["sig"] for i in b]
    if left == right:
        return [merge(x, y) for x, y in zip(a, b)]
    found = []
    for what, a1, a2, b1, b2 in SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        if what == "equal":
            found += [merge(x, y) for x, y in zip(a[a1:a2], b[b1:b2])]
        else:
            found += [x | {"must": False} for x in (*a[a1:a2], *b[b1:b2])]
    return found


def skipped(sig: str, inside: bool) -> bool:
    """Whether an element is boilerplate by its name or marks; ``inside``: within an article."""
    name, *marks = sig.split(".")
    return name in BOILERPLATE or (name == "header" and not inside) or any(NOISE.match(m) for m in marks)


def annotate(wrapper: dict, pages: int) -> dict:
    """Mark what extraction needs: ``skip`` for boilerplate items, ``main`` for the article's item."""
    def visit(item: dict, inside: bool, held: bool, sure: bool) -> int:
        sure = sure and item["must"] and not item["many"]
        inside = inside or item["sig"].split(".")[0] in ("article", "main")
        held = held or inside or any(BODY.match(m) for m in item["sig"].split(".")[1:])
        # pages of a host may be copies or share a heading: within an article, constant text is content
        constant = item["sig"] == "#" and item["text"] is not None and sure and not held and pages >= 3
        menu = item["sig"] != "#" and item["chars"] and item["links"] > 0.6 * item["chars"]
        item["skip"] = bool(constant or menu or (item["sig"] not in ("#", "()") and skipped(item["sig"], inside)))
        own = item["chars"] - item["links"] if item["sig"] == "#" else 0
        item["score"] = 0 if item["skip"] else own + sum(visit(k, inside, held, sure) for k in item["kids"])
        return item["score"]

    def every(item: dict):
        if not item["skip"]:
            yield item
            for k in item["kids"]:
                yield from every(k)

    def called(item: dict, *names: str) -> bool:
        return item["sig"].split(".")[0] in names

    if not visit(wrapper, False, False, True) and pages >= 3:
        return annotate(wrapper, 1)  # copies without a named article: nothing tells the template from the text
    items = list(every(wrapper))
    for chosen in ([i for i in items if called(i, "article")], [i for i in items if called(i, "main")],
                   [i for i in items if any(BODY.match(m) for m in i["sig"].split(".")[1:])]):
        best = max(chosen, key=lambda i: i["score"], default=None)
        if best is not None and 2 * best["score"] >= wrapper["score"] > 0:
            best["main"] = True
            return wrapper
    best = wrapper
    while True:
        deeper = max((k for k in best["kids"] if not k["skip"] and not called(k, *LEAVES)), key=lambda k: k["score"], default=None)
        if deeper is None or deeper["score"] < 0.8 * best["score"] or (deeper["sig"] == "()"):
            break
        best = deeper
    best["main"] = True
    return wrapper


def layout(item: dict) -> tuple[str, list[tuple[int | None, int, int]]]:
    """A folded page as its structure (JSON) and ``(hash or None, chars, links)`` of its texts in order.

    Pages of one structure differ in their texts alone, so what they have in
    common needs no alignment: sums, and equal hashes, in any order.
    """
    texts: list[tuple[int | None, int, int]] = []

    def walk(x: dict) -> list:
        if x["sig"] == "#":
            texts.append((x["text"], x["chars"], x["links"]))
        return [x["sig"], int(x["must"]), int(x["many"]), [walk(k) for k in x["kids"]]]

    return json.dumps(walk(item), separators=(",", ":")), texts


def restored(structure: str, texts: list[tuple[int | None, int, int]]) -> dict:
    """The wrapper of all pages of one structure."""
    left = iter(texts)

    def build(x: list) -> dict:
        sig, must, many, kids = x
        item = {"sig": sig, "text": None, "must": bool(must), "many": bool(many), "kids": [build(k) for k in kids]}
        if sig == "#":
            item["text"], item["chars"], item["links"] = next(left)
        else:
            item["chars"], item["links"] = (sum(k[c] for k in item["kids"]) for c in ("chars", "links"))
        return item

    return build(json.loads(structure))


def infer(wrappers: list[dict], pages: int) -> dict:
    """The wrapper of a site from those of its layouts; ``pages``: its different pages."""
    wrapper = wrappers[0]
    for other in wrappers[1:]:
        wrapper = merge(wrapper, other)
    return annotate(wrapper, pages)


def slim(item: dict) -> dict:
    """What extraction uses of a wrapper."""
    if item["skip"]:
        return {"sig": item["sig"], "skip": True, "text": item["text"]}
    return {"sig": item["sig"], "main": item.get("main", False), "kids": [slim(k) for k in item["kids"]]}


def _choices(items: list[dict]) -> list[dict]:
    return [x for i in items for x in ([*i["kids"]] if i["sig"] == "()" else [i])]


def extract(root: Node, wrapper: dict) -> list[str] | None:
    """The article's blocks in page order, or None if the page has no such part."""
    blocks: list[str] = []
    met = False

    def walk(node: Node, item: dict | None, inside_main: bool, inside: bool) -> None:
        nonlocal met
        known = _choices(item["kids"]) if item else []
        at = 0
        for kid in node.kids:
            sig = "#" if isinstance(kid, tuple) else kid.sig
            hit = next((j for j in (*range(at, len(known)), *range(at)) if known[j]["sig"] == sig), None)
            found = known[hit] if hit is not None else None
            if hit is not None:
                at = hit
            if isinstance(kid, tuple):
                constant = found is not None and found.get("skip") and found.get("text") == text_hash(kid[0])
                if inside_main and not constant:
                    blocks.append(kid[0])
                continue
            within = inside or kid.name in ("article", "main")
            if found["skip"] if found is not None and "skip" in found else found is None and skipped(sig, within):
                continue
            starts = bool(found and found.get("main"))
            met = met or starts
            walk(kid, found, inside_main or starts, within)

    met = bool(wrapper.get("main"))
    walk(root, wrapper, met, False)
    return blocks if met else None


def main_text(page: str | None, wrapper: dict | None) -> str:
    """The page's main text, its blocks joined by blank lines."""
    if not page:
        return ""
    root = parse(page)
    blocks = extract(root, wrapper) if wrapper else None
    if blocks is None:
        blocks = extract(root, slim(annotate(fold(root), 1))) or []
    return "\n\n".join(blocks)
