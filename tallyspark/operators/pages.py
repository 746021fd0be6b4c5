"""Page snapshots to fields: column expressions; for product fields, over the elements of a page that a small parser lists in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Element ids, detail keys, limits and the base address of the pages.
BASE = '<base href="https://www.amazon.com/" target="_blank">'
TABLES = ("productDetails_techSpec_section_1", "productDetails_detailBullets_sections1", "productDetails_techSpec_section_2")
NUMBER_KEYS = {"number of items": "number_of_items", "unit count": "unit_count", "item package quantity": "item_package_quantity"}
TEXT_KEYS = {"size": "size", "item weight": "item_weight"}
PRICE_BOXES = ("corePriceDisplay_desktop_feature_div", "corePrice_feature_div")
PRICE_IDS = ("priceblock_ourprice", "priceblock_dealprice", "price_inside_buybox")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY = {"li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "p": ("p",)}
ATTRIBUTES = ("id", "class", "property", "content", "src", "data-old-hires")
ELEMENTS = (
    "tag array<string>, last array<int>, a array<int>, b array<int>, id array<string>, class array<string>, property array<string>, content array<string>, src array<string>, "
    "hires array<string>, pieces array<string>"
)
FIELDS = (
    "title string, bullets array<string>, description string, number_of_items double, unit_count double, item_package_quantity double, size string, item_weight string, "
    "image string, price string, brand string"
)


def clean_text(text: Column) -> Column:
    """Single spaces, no direction marks, colons as ": ", nothing but text at the ends."""
    flat = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))
    return F.btrim(F.regexp_replace(F.translate(flat, "‏‎", ""), r"\s*:\s*", ": "), F.lit(" :"))


def first_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(F.replace(text, F.lit(","), F.lit("")), r"(\d+(?:\.\d+)?)", 1), F.lit("")).cast("double")


def sanitize(html: Column) -> Column:
    """No scripts, noscripts or refreshes; a base address after the first head, or in front."""
    out = F.regexp_replace(html, r"(?is)<script\b[^>]*>.*?</script>", "")
    out = F.regexp_replace(out, r"(?is)<noscript\b[^>]*>.*?</noscript>", "")
    out = F.regexp_replace(out, r"(?i)<meta[^>]+http-equiv=['\"]?refresh['\"]?[^>]*>", "")
    at = F.regexp_instr(out, F.lit(r"(?i)<head[^>]*>"))
    end = at + F.length(F.regexp_extract(out, r"(?i)(<head[^>]*>)", 1)) - 1
    return F.when(at > 0, F.concat(out.substr(F.lit(1), end), F.lit(BASE), out.substr(end + 1, F.length(out)))).otherwise(F.concat(F.lit(BASE), out))


def _group(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def quick_image(html: Column) -> Column:
    og = _group(_group(html, r"(?i)(<meta[^>]*og:image[^>]*>)"), r"""(?i)content=["']([^"']+)""")
    landing = _group(_group(html, r"""(?i)(<img[^>]*id=["']landingImage["'][^>]*>)"""), r"""(?i)\bsrc=["'](https?://[^"']+)""")
    return F.coalesce(F.when(og.startswith("http"), og), landing, _group(html, r"""\"(https://m\.media-amazon\.com/images/I/[^"']+\.jpg)\""""))


def quick_price(html: Column) -> Column:
    found = F.transform(F.regexp_extract_all(html, F.lit(r"""(?i)class=["']a-offscreen["']>\s*([^<]{1,16})<"""), F.lit(1)), lambda x: F.btrim(x))
    return F.get(F.filter(found, lambda x: x.rlike(r"[$£€]|\d")), F.lit(0))


class _Elements(HTMLParser):
    """A page as lists: of each element its tag, wanted attributes, last descendant and range of text pieces; and the pieces."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.pieces: list[str] = []
        self.open: list[int] = []
        self.feed(html)
        self.close()
        self._end(0)

    def _end(self, depth: int) -> None:
        for i in self.open[depth:]:
            self.rows[i][1:4:2] = len(self.rows) - 1, len(self.pieces)
        del self.open[depth:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        while self.open and self.rows[self.open[-1]][0] in CLOSED_BY.get(tag, ()):
            self._end(len(self.open) - 1)
        found = dict(attrs)
        self.rows.append([tag, len(self.rows), len(self.pieces), len(self.pieces), *(found.get(a) or "" for a in ATTRIBUTES)])
        if tag not in VOID:
            self.open.append(len(self.rows) - 1)

    def handle_endtag(self, tag: str) -> None:
        at = [d for d, i in enumerate(self.open) if self.rows[i][0] == tag]
        if at:
            self._end(at[-1])

    def handle_data(self, data: str) -> None:
        if data.strip() and not (self.open and self.rows[self.open[-1]][0] in ("script", "style")):
            self.pieces.append(data.strip())


def elements(html: Column) -> Column:
    """The elements of each page in parallel arrays, in page order, and its text pieces; of a null page, none."""

    @F.pandas_udf(ELEMENTS)
    def run(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in ELEMENTS.split(", ")]
        for p in pages:
            found = [_Elements(h or "") for h in p]
            yield pd.DataFrame([[*(list(c) for c in zip(*e.rows, strict=True)), e.pieces] if e.rows else [[]] * (len(names) - 1) + [e.pieces] for e in found], columns=names)

    return run(html)


def _let(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), worked out from one evaluation of value."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


class _View:
    """Expressions over one page: its elements as an array of structs, and its pieces."""

    def __init__(self, page: Column) -> None:
        self.all, self.ids, self.pieces = page["all"], page["ids"], page["pieces"]

    def where(self, test: Callable[[Column], Column]) -> Column:
        return F.filter(self.all, test)

    def first(self, test: Callable[[Column], Column]) -> Column:
        return F.get(self.where(test), F.lit(0))

    def by_id(self, name: str) -> Column:
        return F.get(self.all, (F.array_position(self.ids, name) - 1).cast("int"))

    def within(self, top: Column, test: Callable[[Column], Column]) -> Column:
        """The elements below top, which follow it; none if there is no top."""
        below = _let(top, lambda t: F.filter(F.slice(self.all, t["i"] + 2, t["last"] - t["i"]), test))
        return F.coalesce(below, F.slice(self.all, 1, 0))

    def joined(self, e: Column) -> Column:
        """The pieces within an element, by spaces; null if there is no element."""
        return _let(e, lambda x: F.array_join(F.slice(self.pieces, x["a"] + 1, x["b"] - x["a"]), " "))

    def text(self, e: Column) -> Column:
        return _let(self.joined(e), lambda t: F.when(t.isNotNull(), clean_text(t)))


def _is(tag: str) -> Callable[[Column], Column]:
    return lambda e: e["tag"] == tag


def _has_class(e: Column, name: str) -> Column:
    # Most elements lack the name, so few classes are split.
    return F.contains(e["class"], F.lit(name)) & F.array_contains(F.split(e["class"], r"\s+"), name)


def _pair(key: Column, value: Column) -> Column:
    return F.struct(F.lower(key).alias("key"), value.alias("value"))


def _details(v: _View) -> Column:
    """(key, value) of the product's tables, then of its bullets, then of its overview, in page order."""

    def rows(top: Column, pair: Callable[[Column], Column]) -> Column:
        return F.filter(F.transform(v.within(top, _is("tr")), pair), lambda x: x.isNotNull())

    def headed(row: Column) -> Column:
        of = lambda tag: F.get(v.within(row, _is(tag)), F.lit(0))
        return _let(F.struct(of("th").alias("th"), of("td").alias("td")), lambda x: F.when(x["th"].isNotNull() & x["td"].isNotNull(), _pair(v.text(x["th"]), v.text(x["td"]))))

    def two(row: Column) -> Column:
        return _let(v.within(row, _is("td")), lambda cells: F.when(F.size(cells) >= 2, _pair(v.text(F.get(cells, F.lit(0))), v.text(F.get(cells, F.lit(1))))))

    def told(item: Column) -> Column:
        return _let(v.text(item), lambda t: F.when(F.contains(t, F.lit(":")), _pair(F.btrim(F.substring_index(t, ":", 1)), F.btrim(F.substring(t, F.instr(t, ":") + 1, F.length(t))))))

    bullets = F.filter(F.transform(v.within(v.by_id("detailBullets_feature_div"), _is("li")), told), lambda x: x.isNotNull())
    return F.concat(*[rows(v.by_id(name), headed) for name in TABLES], bullets, rows(v.by_id("productOverview_feature_div"), two))


def _detail(pairs: Column, key: str) -> Column:
    """Of the first key that holds the wanted words, the value that was told last."""
    name = F.get(F.filter(pairs, lambda x: F.contains(x["key"], F.lit(key))), F.lit(0))["key"]
    return _let(name, lambda k: F.try_element_at(F.filter(pairs, lambda x: x["key"] == k), F.lit(-1))["value"])


def _image(v: _View) -> Column:
    """The shared image, or the landing one in its large form."""
    og = v.first(lambda e: (e["tag"] == "meta") & (e["property"] == "og:image") & (e["content"] != ""))["content"]
    landing = F.coalesce(v.by_id("landingImage"), F.get(v.within(v.by_id("imgTagWrapperId"), _is("img")), F.lit(0)))
    return F.coalesce(og, _let(landing, lambda e: F.coalesce(F.nullif(e["hires"], F.lit("")), F.nullif(e["src"], F.lit("")))))


def _price(v: _View) -> Column:
    """The first text among the price boxes' hidden prices, other hidden prices within a price, and the older price elements."""
    hidden = lambda e: _has_class(e, "a-offscreen")
    boxes = [F.get(v.within(v.by_id(b), hidden), F.lit(0)) for b in PRICE_BOXES]
    priced = v.first(lambda e: hidden(e) & F.exists(v.all, lambda p: (p["i"] < e["i"]) & (e["i"] <= p["last"]) & _has_class(p, "a-price")))
    return F.coalesce(*[F.nullif(v.joined(e), F.lit("")) for e in (*boxes, priced, *map(v.by_id, PRICE_IDS))])


def _fields(page: Column, max_bullets: int, max_description: int) -> Column:
    v = _View(page)
    bullets = F.filter(F.transform(v.within(v.by_id("feature-bullets"), _is("li")), v.text), lambda t: (t != "") & ~F.contains(F.lower(t), F.lit("videos")))
    description = F.substring(F.coalesce(v.text(v.by_id("productDescription")), F.lit("")), 1, max_description)
    fixed = {"title": v.text(v.by_id("productTitle")), "bullets": F.slice(bullets, 1, max_bullets), "description": description, "image": _image(v), "price": _price(v), "brand": v.joined(v.by_id("bylineInfo"))}

    def whole(pairs: Column) -> Column:
        told = {f: first_number(_detail(pairs, k)) for k, f in NUMBER_KEYS.items()} | {f: _detail(pairs, k) for k, f in TEXT_KEYS.items()}
        return F.struct(*[(fixed | told)[f.split()[0]].alias(f.split()[0]) for f in FIELDS.split(", ")])

    return _let(_details(v), whole)


def page_fields(html: Column, max_bullets: int = 12, max_description: int = 1200) -> Column:
    """A struct of the product's fields; a null page has an empty one. Python lists a page's elements, once; the rest are expressions."""
    names = [f.split()[0] for f in ELEMENTS.split(", ")]

    def page(e: Column) -> Column:
        listed = F.arrays_zip(*[e[n].alias(n) for n in names[:-1]], F.sequence(F.lit(0), F.size(e["tag"])).alias("i"))
        # One number more than elements, so that none is a descending sequence.
        return F.struct(F.filter(listed, lambda x: x["tag"].isNotNull()).alias("all"), e["id"].alias("ids"), e["pieces"].alias("pieces"))

    return _let(elements(html), lambda e: _let(page(e), lambda p: _fields(p, max_bullets, max_description)))


# The captions of the reader card's details.
DETAILS = {"Number of items": "number_of_items", "Unit count": "unit_count", "Item package quantity": "item_package_quantity", "Size": "size", "Item weight": "item_weight"}


def text_of(html: Column) -> Column:
    """What stands outside the tags of a page, scripts and styles left out; entities stay as they are."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</(script|style)>", " ")
    return F.regexp_replace(bare, r"<[^>]*>", " ")


def reader_card(fields: Column) -> dict[str, Column]:
    """The reader card of a page's fields: title, image, price, brand, bullets, description and the details by caption."""
    caption = lambda f: fields[f].cast("string")
    details = F.create_map(*[x for k, f in DETAILS.items() for x in (F.lit(k), caption(f))])
    return {c: fields[c] for c in ("title", "image", "price", "brand", "bullets", "description")} | {"details": details}
