"""Static geometry and paint against plain recursion over random cards."""

import json
import math
import random
import re

import pytest

from cardlens.operators import static as G
from cardlens.operators.tree import closure, fold_up, intervals, on_cycles

SIDES = ("top", "right", "bottom", "left")


def num(v):
    if isinstance(v, bool) or v is None:
        return None
    if isinstance(v, (int, float)):
        return float(v)
    m = re.fullmatch(r"\s*(-?\d+(?:\.\d+)?)(?:vp|fp|px)?\s*", v) if isinstance(v, str) else None
    return float(m.group(1)) if m else None


def dynamic(v):
    return isinstance(v, str) and "{{" in v and "}}" in v


def sides(v):
    if isinstance(v, str):
        return None if dynamic(v) else (0.0,) * 4
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return (max(float(v), 0.0),) * 4
    if not isinstance(v, dict):
        return (0.0,) * 4
    out, share = [], False
    for k in SIDES:
        x = v.get(k, 0)
        if dynamic(x):
            return None
        if isinstance(x, str) and x.strip().endswith("%"):
            share |= float(x.strip()[:-1]) > 0
            out.append(0.0)
        else:
            out.append(max(num(x) or 0.0, 0.0))
    if share:
        return (0.0,) * 4 if any(out) else None
    return tuple(out)


def rgba(v):
    if not isinstance(v, str) or not re.fullmatch("#([0-9A-Fa-f]{6}|[0-9A-Fa-f]{8})", v):
        return None
    v = v[1:] if len(v) == 9 else "FF" + v[1:]
    a, r, g, b = (int(v[i : i + 2], 16) / 255 for i in (0, 2, 4, 6))
    return r, g, b, a


class Card:
    """One card, its components by id, and the answers by plain recursion."""

    def __init__(self, comps, model):
        self.comps, self.model = {c["id"]: c for c in comps}, model
        self.order = [c["id"] for c in comps]
        self.parent = {k: c["id"] for c in comps for k in c.get("children", [])}

    def style(self, i):
        return self.comps[i].get("styles", {})

    def hidden(self, i):
        return self.style(i).get("visibility") in ("hidden", "none")

    def shown(self, i):
        return not self.hidden(i) and (i not in self.parent or self.shown(self.parent[i]))

    def below(self, i):
        return [i] + [x for k in self.comps[i].get("children", []) for x in self.below(k)]

    def size(self, i, axis):
        v = self.style(i).get(axis)
        return 160.0 if i == "root" and v == "matchParent" else num(v)

    def raw(self, i):
        v = self.comps[i].get("label" if self.comps[i]["component"] == "Button" else "content")
        return v if isinstance(v, str) and v.strip() else None

    def text(self, i):
        v = self.raw(i)
        if not dynamic(v):
            return v
        path = re.fullmatch(r"\{\{ '(.*)' \+ \$\{/(\w+)\} \}\}", v)
        got = self.model.get(path.group(2)) if path else None
        return None if got is None else path.group(1) + str(got)

    def height(self, i):
        h = self.size(i, "height")
        if h is None and self.comps[i]["component"] in ("Text", "Button") and self.raw(i):
            lines = num(self.style(i)["maxLines"]) if "maxLines" in self.style(i) else 1
            pad = sides(self.style(i).get("padding"))
            if lines and lines > 0 and pad:
                return float(math.ceil((num(self.style(i).get("fontSize")) or 16.0) * 1.25 * lines + pad[0] + pad[2])), True
        return h, False

    def children_at(self, i, box, strict):
        """The boxes of a container's children; None if they can't be told."""
        c, st = self.comps[i], self.style(i)
        kids = [k for k in c.get("children", []) if strict or not self.hidden(k)]
        pad = sides(st.get("padding"))
        if pad is None:
            return None
        x0, y0, w, h = box[0] + pad[3], box[1] + pad[0], box[2] - pad[1] - pad[3], box[3] - pad[0] - pad[2]
        if w <= 0 or h <= 0:
            return None
        items = []
        for k in kids:
            kw, kh, m = self.size(k, "width"), self.size(k, "height") if strict else self.height(k)[0], sides(self.style(k).get("margin"))
            if kw is None or kh is None or m is None:
                return None
            items.append((k, kw, kh, m))
        if not items:
            return {}
        words = G.STRICT if strict else G.LOOSE
        spell = lambda v, ws: next((n for n, s in ws.items() if ("" if v is None else v) in s), None)
        shift = lambda how, free: {"start": 0.0, "center": free / 2, "end": free}[how]
        if c["component"] == "Stack":
            how = spell(st.get("alignContent", "center"), G.STACK)
            return None if how is None else {k: (x0 + shift(how, w - kw - m[1] - m[3]) + m[3], y0 + shift(how, h - kh - m[0] - m[2]) + m[0], kw, kh) for k, kw, kh, m in items}
        gap = num(c.get("itemMargin", 0))
        if gap is None:
            return None
        row = c["component"] == "Row"
        main = [kw + m[1] + m[3] if row else kh + m[0] + m[2] for _, kw, kh, m in items]
        room, justify = (w if row else h), st.get("justifyContent", "start")
        if justify == "spaceBetween" and len(items) > 1:
            least, gap, at = gap, (room - sum(main)) / (len(items) - 1), 0.0
            if strict and gap + 1e-9 < least:
                return None
        else:
            how = spell(justify, words)
            if how is None:
                return None
            at = shift(how, room - sum(main) - gap * (len(items) - 1))
        how = spell(st.get("alignItems", "start"), words)
        if how is None:
            return None
        out = {}
        for (k, kw, kh, m), used in zip(items, main):
            across = shift(how, (h - kh - m[0] - m[2]) if row else (w - kw - m[1] - m[3]))
            out[k] = (x0 + at + m[3], y0 + across + m[0], kw, kh) if row else (x0 + across + m[3], y0 + at + m[0], kw, kh)
            at += used + gap
        return out

    def boxes(self):
        out = {}

        def put(i, box):
            if self.hidden(i):
                return
            out[i] = box
            if self.comps[i]["component"] in ("Row", "Column", "Stack"):
                for k, b in (self.children_at(i, box, False) or {}).items():
                    put(k, b)

        w, h = self.size("root", "width"), self.height("root")[0]
        if w is not None and h is not None:
            put("root", (0.0, 0.0, w, h))
        return out

    def rounded(self, i):
        st = self.style(i)
        return (num(st.get("borderRadius")) or 0) >= 12 and (self.comps[i]["component"] == "Button" or (self.comps[i]["component"] in ("Column", "Row", "Stack", "Text") and any(f in st for f in G.PAINT)))

    def related(self, a, b):
        return a in self.below(b) or b in self.below(a)

    def text_overlaps(self):
        boxes, out = self.boxes(), set()
        texts = [i for i in boxes if self.comps[i]["component"] == "Text" and self.height(i)[1]]
        for t in texts:
            for o in boxes:
                if o in texts or not (self.rounded(o) or self.comps[o]["component"] == "Divider") or self.related(t, o):
                    continue
                (x, y, w, h), (u, v, a, b) = boxes[t], boxes[o]
                wide, high, gap = min(x + w, u + a) - max(x, u), min(y + h, v + b) - max(y, v), v - y - h
                if wide > 0.5 and (high > 0.5 or 0 <= gap < 2):
                    out.add((t, o, "overlap" if high > 0.5 else "low_gap", round(-high if high > 0.5 else gap, 6)))
        return out

    def touching(self):
        boxes, out = self.boxes(), set()
        ids = [i for i in self.order if i in boxes and i != "root" and self.rounded(i) and min(boxes[i][2:]) >= 24]
        for n, p in enumerate(ids):
            for q in ids[n + 1 :]:
                if self.related(p, q) or self.parent.get(p) == self.parent.get(q):
                    continue
                (x, y, w, h), (u, v, a, b) = boxes[p], boxes[q]
                wide, high = min(x + w, u + a) - max(x, u), min(y + h, v + b) - max(y, v)
                axis, gap = ("horizontal", max(0.0, -wide)) if high > 0.5 else ("vertical", max(0.0, -high)) if wide > 0.5 else (None, 9)
                if gap <= 0.5 + 1e-9:
                    out.add((p, q, axis, round(gap, 6)))
        return out

    def cover(self, i, stack):
        c, st, ss = self.comps[i], self.style(i), self.style(stack)
        color = rgba(st.get("backgroundColor"))
        if c["component"] != "Text" or c.get("children") or not isinstance(c.get("content"), str) or c["content"].strip() or set(st) - set(G.COVER_FIELDS) or not color or color[3] < 0.999:
            return None
        for axis in ("width", "height"):
            own, room = num(st.get(axis)), num(ss.get(axis))
            if st.get(axis) not in ("matchParent", "100%") and (any(f in ss for f in G.FLEXIBLE) or own is None or room is None or own < room):
                return None
        return color

    def layer(self, i):
        st = self.style(i)
        if "backgroundImage" in st:
            return "taint", []
        if "linearGradient" in st:
            g = st["linearGradient"]
            colors = [rgba(s[0]) if len(s) == 2 else None for s in g["colors"]] if isinstance(g, dict) and isinstance(g.get("colors"), list) else [None]
        elif "backgroundColor" in st:
            colors = [rgba(st["backgroundColor"])]
        else:
            return None, []
        if None in colors:
            return "taint", []
        return ("opaque" if all(c[3] >= 0.999 for c in colors) else "veil") if colors else None, colors

    def ground(self, i):
        st = self.style(i)
        if "backgroundImage" in st:
            return None
        if "backgroundColor" in st:
            c = rgba(st["backgroundColor"])
            return None if c is None else c[3] >= 0.999
        op, _ = self.layer(i)
        return None if op == "taint" or (op is None and "linearGradient" in st) else op == "opaque"

    def leaves(self, i, box):
        if not self.shown(i):
            return []
        kind = self.comps[i]["component"]
        if kind == "Image":
            return [("image", i, box)]
        if kind == "Text":
            if self.ground(i) is None or (self.raw(i) and self.text(i) is None):
                return None
            return [("text", i, box)] if self.text(i) and self.text(i).strip() else []
        boxes = self.children_at(i, box, True) if kind in ("Row", "Column") else None
        if boxes is None:
            return None
        out = []
        for k, b in boxes.items():
            more = self.leaves(k, b)
            if more is None:
                return None
            out += more
        return out

    def stacks(self):
        """{stack: (open, candidate)}, {(stack, image, text)}"""
        state, found = {}, set()
        for s in self.order:
            if self.comps[s]["component"] != "Stack" or not self.shown(s):
                continue
            kids = self.comps[s].get("children", [])
            w, h = self.size(s, "width"), self.size(s, "height")
            boxes = self.children_at(s, (0.0, 0.0, w, h), True) if w is not None and h is not None else None
            leaves = {k: self.leaves(k, boxes[k]) for k in kids} if boxes is not None else {}
            open_ = boxes is None or any(v is None for v in leaves.values())
            reach = lambda p, t: p > t or not any(self.cover(k, s) for k in kids[p + 1 : t])
            worded = lambda x: self.shown(x) and self.comps[x]["component"] == "Text" and self.raw(x) and (self.text(x) is None or self.text(x).strip())
            pics = [n for n, k in enumerate(kids) if any(self.shown(x) and self.comps[x]["component"] == "Image" for x in self.below(k))]
            words = [n for n, k in enumerate(kids) if any(worded(x) for x in self.below(k))]
            state[s] = open_, any(p != t and reach(p, t) for p in pics for t in words)
            if open_:
                continue
            for p, a in enumerate(kids):
                for t, b in enumerate(kids):
                    for kind, i, (x, y, w, h) in leaves[a]:
                        for other, o, (u, v, c, d) in leaves[b]:
                            if p != t and kind == "image" and other == "text" and reach(p, t) and not (p < t and self.ground(o)):
                                if min(x + w, u + c) - max(x, u) > 0.5 and min(y + h, v + d) - max(y, v) > 0.5:
                                    found.add((s, i, o))
        return state, found

    def backgrounds(self, i):
        path = [i]
        while path[0] in self.parent:
            path.insert(0, self.parent[path[0]])
        known, taint, colors = False, False, []
        over = lambda f, b: tuple(((f[k] * f[3] + b[k] * b[3] * (1 - f[3])) / (f[3] + b[3] * (1 - f[3]))) if f[3] + b[3] > 0 else 0 for k in range(3)) + (f[3] + b[3] * (1 - f[3]),)
        for n, a in enumerate(path):
            op, own = self.layer(a)
            st = self.style(a)
            if op == "taint" or (op == "veil" and not (known and len(own) * len(colors) <= 4096)) or (op == "opaque" and taint and ("linearGradient" in st or st.get("visibility") not in (None, "visible") or (num(st.get("borderRadius", 0)) or 0) != 0 or not isinstance(st.get("borderRadius", 0), (int, float)))):
                known, taint, colors = False, True, []
            elif op == "opaque":
                known, taint, colors = True, False, own
            elif op == "veil":
                colors = [over(f, b) for f in own for b in colors]
            if self.comps[a]["component"] == "Stack" and n + 1 < len(path):
                kids = self.comps[a]["children"]
                last = [k for k in kids[: kids.index(path[n + 1])] if any(self.shown(x) and (self.comps[x]["component"] == "Image" or any(f in self.style(x) for f in ("backgroundColor", "backgroundImage", "linearGradient"))) for x in self.below(k))]
                if last:
                    cover = self.cover(last[-1], a)
                    known, taint, colors = (True, False, [cover]) if cover else (False, True, [])
        return colors if known else None


def some_card(rng, depth=4, width=4):
    comps = []
    sizes = [20, 30, 40, "48vp", 60, 100]

    def one(level):
        i = "root" if not comps else f"c{len(comps)}"
        c = {"id": i, "styles": {}}
        comps.append(c)
        st = c["styles"]
        box = i == "root" or (level < depth and rng.random() < 0.6)
        c["component"] = rng.choice(["Row", "Column", "Stack", "Stack"] if box else ["Text", "Text", "Image", "Button", "Divider", "Text"])
        if i == "root":
            st |= {"width": rng.choice(["matchParent", 160]), "height": rng.choice(["matchParent", 150, 160])}
        elif rng.random() < 0.95:
            st["width"] = rng.choice(sizes)
        if i != "root" and rng.random() < (0.95 if box else 0.75):
            st["height"] = rng.choice(sizes)
        if rng.random() < 0.3:
            st["padding"] = rng.choice([4, "4", {"top": 2, "left": "3vp"}, {"top": "10%"}, {"top": "10%", "left": 4}, [1, 2], -3, 2.5, "{{ $__dataModel.p }}"] if rng.random() < 0.3 else [4, {"top": 2, "left": "3vp"}])
        if rng.random() < 0.2:
            st["margin"] = rng.choice([2, {"left": 3, "bottom": 1}, True])
        for f, values in (("justifyContent", ["start", "center", "end", "spaceBetween", "left", None, "around"]), ("alignItems", ["start", "center", "flex-end", "top", "stretch"]), ("alignContent", ["center", "start", "bottomEnd", "weird"])):
            if box and rng.random() < 0.25:
                st[f] = rng.choice(values[:3] if rng.random() < 0.7 else values)
        if box and rng.random() < 0.5:
            c["itemMargin"] = rng.choice([0, 4, 8, "2vp", "x"] if rng.random() < 0.3 else [0, 4, 8])
        if rng.random() < 0.08:
            st["visibility"] = rng.choice(["hidden", "none", "visible"])
        if rng.random() < 0.3:
            st["borderRadius"] = rng.choice([0, 8, 12, 16])
        paint = rng.random()
        if paint < 0.35:
            st["backgroundColor"] = rng.choice(["#FFFFFF", "#336699", "#80FF0000", "red", "#FF000000"])
        elif paint < 0.45:
            st["linearGradient"] = rng.choice([{"colors": [["#FF0000", 0], ["#0000FF", 1]]}, {"colors": [["#80FFFFFF", 0], ["#40000000", 1]]}, {"colors": [["#FF0000"]]}, {"colors": []}, "x"])
        elif paint < 0.48:
            st["backgroundImage"] = "a.png"
        if c["component"] in ("Text", "Button"):
            c["label" if c["component"] == "Button" else "content"] = rng.choice(["word", "26", " ", "{{ 'a' + ${/t} }}", "{{ 'a' + ${/gone} }}"] if rng.random() < 0.4 else ["word", "text"])
            if rng.random() < 0.4:
                st["fontSize"] = rng.choice([10, 14, 20])
            if rng.random() < 0.7:
                st["fontColor"] = rng.choice(["#000000", "#FFFFFF", "#777777", "#80000000"])
            if rng.random() < 0.2:
                st["maxLines"] = rng.choice([1, 2])
        if box:
            c["children"] = [one(level + 1) for _ in range(rng.randint(0, width))]
            if c["component"] == "Stack" and c["children"] and rng.random() < 0.3:
                k = {"id": f"c{len(comps)}", "component": "Text", "content": "", "styles": {"width": rng.choice(["100%", 100]), "height": "matchParent", "backgroundColor": rng.choice(["#FFFFFF", "#000000"])}}
                comps.append(k)
                c["children"].insert(rng.randint(0, len(c["children"])), k["id"])
        return i

    one(0)
    return comps


def deep_card(n):
    boxes = [{"id": "root" if i == 0 else f"c{i}", "component": ["Column", "Row"][i % 2], "children": [f"c{i + 1}"], "styles": {"width": 160 - i, "height": 160 - i, "padding": 1}} for i in range(n)]
    return [*boxes, {"id": f"c{n}", "component": "Text", "content": "deep", "styles": {"width": 30, "fontColor": "#FFFFFF"}}]


def near_card(gap):
    text = {"id": "t", "component": "Text", "content": "word", "styles": {"width": 60, "fontSize": 16}}
    line = {"id": "d", "component": "Divider", "styles": {"width": 100, "height": 1}}
    return [{"id": "root", "component": "Column", "children": ["t", "d"], "itemMargin": gap, "styles": {"width": 160, "height": 160}}, text, line]


def beside_card(left):
    image = {"id": "i", "component": "Image", "styles": {"width": 40, "height": 40}}
    text = {"id": "t", "component": "Text", "content": "word", "styles": {"width": 60, "height": 20, "margin": {"left": left}}}
    return [{"id": "root", "component": "Stack", "children": ["i", "t"], "styles": {"width": 160, "height": 160, "alignContent": "start"}}, image, text]


@pytest.fixture(scope="module")
def both(spark):
    """Random cards, and their components with labels."""
    rng = random.Random(21)
    model = {"t": "text", "p": 3}
    cards = {i: Card(some_card(rng), model) for i in range(150)} | {900: Card(deep_card(40), model)} | {910 + g: Card(near_card(g), model) for g in range(4)} | {920 + m: Card(beside_card(m), model) for m in (30, 40)}
    rows = []
    for i, c in cards.items():
        lines = [{"createSurface": {"surfaceId": "s", "width": 160, "height": 160}}, {"updateComponents": {"root": "root", "components": list(c.comps.values())}}, {"updateDataModel": {"path": "/", "value": model}}]
        rows.append((i, "\n".join(json.dumps(x) for x in lines)))
    docs = spark.createDataFrame([*rows, (901, None), (902, ""), (903, "no card")], "doc_id long, text string")
    nodes = G.parsed(docs)
    return cards, docs, nodes, G.labelled(nodes)


def test_boxes(both):
    cards, _, nodes, _ = both
    got = {(r["doc_id"], r["id"]): r for r in G.boxes_of(nodes).collect()}
    assert len(got) == sum(len(c.comps) for c in cards.values())
    known = 0
    for d, card in cards.items():
        want = card.boxes()
        for i in card.comps:
            r = got[d, i]
            box = None if r["x"] is None else (r["x"], r["y"], r["w"], r["h"])
            assert (box is None) == (i not in want) and (box is None or box == pytest.approx(want[i])), (d, i)
            known += box is not None
            assert r["estimated"] == (i in want and card.height(i)[1])
    assert 300 < known < len(got) - 300
    assert got[900, "c40"]["x"] == 40.0


def test_pairs_of_boxes(both):
    cards, _, nodes, labels = both
    boxed = G._boxed(labels, G.boxes_of(nodes))
    got = {}
    for r in G.text_surface_overlaps(boxed).collect():
        got.setdefault(r["doc_id"], set()).add((r["text"], r["target"], r["relation"], round(r["gap"], 6)))
    want = {d: c.text_overlaps() for d, c in cards.items()}
    assert got == {d: w for d, w in want.items() if w} and {x[2] for w in want.values() for x in w} == {"overlap", "low_gap"}
    assert [d for d in (910, 911, 912, 913) if d in got] == [910, 911]
    got = {}
    for r in G.touching_surfaces(boxed).collect():
        got.setdefault(r["doc_id"], set()).add((r["a"], r["b"], r["axis"], round(r["gap"], 6)))
    want = {d: c.touching() for d, c in cards.items()}
    assert got == {d: w for d, w in want.items() if w} and got


def test_pictures_over_texts(both):
    cards, docs, _, labels = both
    found, stacks = G.stack_overlaps(labels)
    want = {d: c.stacks() for d, c in cards.items()}
    assert {(r["doc_id"], r["stack"]): (r["open"], r["candidate"]) for r in stacks.collect()} == {(d, s): v for d, (state, _) in want.items() for s, v in state.items()}
    assert {(r["doc_id"], r["stack"], r["image"], r["text"]) for r in found.collect()} == {(d, *f) for d, (_, fs) in want.items() for f in fs}
    verdicts = {r["doc_id"]: r["verdict"] for r in G.stack_verdicts(docs, found, stacks).collect()}
    for d, (state, pairs) in want.items():
        cand = [open_ for open_, candidate in state.values() if candidate]
        assert verdicts[d] == ("issue" if pairs else "not_applicable" if not cand else "undetermined" if any(cand) else "clear"), d
    assert set(verdicts.values()) == {"issue", "not_applicable", "undetermined", "clear"}


def test_contrasts(both):
    cards, _, _, labels = both
    colors = {(r["doc_id"], r["id"]): r["colors"] for r in G.backgrounds(labels).collect()}
    states = {(r["doc_id"], r["id"]): r for r in G.contrasts(labels).collect()}
    lin = lambda c: c / 12.92 if c <= 0.04045 else ((c + 0.055) / 1.055) ** 2.4
    lum = lambda c: 0.2126 * lin(c[0]) + 0.7152 * lin(c[1]) + 0.0722 * lin(c[2])
    seen = set()
    for d, card in cards.items():
        for i in card.comps:
            want = card.backgrounds(i)
            got = colors[d, i]
            assert (got is None) == (want is None) and sorted(tuple(round(x, 9) for x in c) for c in got or []) == sorted(tuple(round(x, 9) for x in c) for c in want or []), (d, i)
            if (d, i) not in states:
                continue
            st, ink = card.style(i), rgba(card.style(i).get("fontColor"))
            ratios = []
            for b in want or []:
                if ink and b[3] >= 0.999:
                    f = tuple(ink[k] * ink[3] + b[k] * (1 - ink[3]) for k in range(3))
                    hi, lo = max(lum(f), lum(b)), min(lum(f), lum(b))
                    ratios.append((hi + 0.05) / (lo + 0.05))
            need = 3.0 if (num(st.get("fontSize")) or 16) >= 18 else 4.5
            state = "open" if not ratios or min(ratios) < need <= max(ratios) else "clear" if min(ratios) >= need else "error" if min(ratios) < 3 else "warning"
            assert states[d, i]["state"] == state, (d, i)
            seen.add(state)
    assert seen == {"open", "clear", "error", "warning"}


def test_labels_are_the_closure(spark):
    rng = random.Random(8)
    rows = []
    for d in range(6):
        for i in range(rng.choice([1, 9, 40])):
            rows.append((d, f"n{i}", f"n{rng.randrange(i)}" if i and rng.random() < 0.9 else None, rng.randrange(100)))
    rows += [(9, f"n{i}", f"n{i - 1}" if i else None, 0) for i in range(40)] + [(7, "a", "b", 0), (7, "b", "a", 0), (7, "c", "b", 0), (7, "top", None, 0)]
    tree = spark.createDataFrame(rows, "d long, node string, parent string, pos long")
    labels = {(r["d"], r["node"]): (r["first"], r["last"]) for r in intervals(tree, ["d"]).collect()}
    pairs = {(r["d"], r["node"], r["ancestor"]) for r in closure(tree.filter("d != 7"), ["d"]).collect()}
    inside = {(d, x, y) for (d, x), (f, _) in labels.items() for (e, y), (a, b) in labels.items() if d == e and a <= f <= b and d != 7}
    assert inside == pairs and {k for k in labels if k[0] == 7} == {(7, "top")}
    folded = {(r["d"], r["node"]): r["s"] for r in fold_up(tree, {"s": (tree["pos"], lambda c: __import__("pyspark.sql.functions").sql.functions.sum(c), lambda a, b: a + b)}, ["d"]).filter("ended").collect()}
    pos = {(d, n): p for d, n, _, p in rows}
    for d, n in labels:
        if d != 7:
            assert folded[d, n] == sum(pos[d, x] for e, x, y in pairs if e == d and y == n)


def test_cycles_by_doubling(spark):
    rows = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "x"), ("root", None), ("y", "root")] + [(f"t{i}", f"t{i - 1}" if i else "a") for i in range(60)]
    tree = spark.createDataFrame(rows, "node string, parent string")
    assert sorted(r["node"] for r in on_cycles(tree).collect()) == ["a", "b", "c", "x"]
    several = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "m"), ("m", "x"), ("x", "x"), ("t", "a")], "node string, parent string")
    assert sorted(r["node"] for r in on_cycles(several).collect()) == ["a", "b", "x"]
