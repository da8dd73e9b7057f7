"""Listing records and links out of stored web pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill.functions.text import breadcrumb_address, clean_phones, joined_lines, label_value, strip

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

# labels of the line-based layout that are fields of their own, and the word that skips a line
FIELD_LABELS = {"price": "Giá", "square": "Diện Tích", "post_id": "Mã Đăng Tin", "post_date": "Ngày Đăng"}
SKIPPED_WORD = "nội thất"


def open_tag(tag: str, css_class: str) -> str:
    """Pattern of an opening tag that carries a class."""
    return rf'<{tag}\b[^>]*\bclass="(?:[^"]*\s)?{css_class}(?:\s[^"]*)?"[^>]*>'


def unescape(text: Column) -> Column:
    """The entities that occur in listing text."""
    out = text
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def first_text(html: Column, pattern: str) -> Column:
    """Unescaped first group of the first match; null when nothing matches."""
    found = F.get(F.regexp_extract_all(html, F.lit("(?is)" + pattern), F.lit(1)), F.lit(0))
    return unescape(found)


def all_texts(html: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit("(?is)" + pattern), F.lit(1)), unescape)


class _Region(HTMLParser):
    """Collects the text directly inside elements of one tag, below an element of that tag and a class."""

    def __init__(self, tag: str, css_class: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.css_class = tag, css_class
        self.path: list[tuple[str, bool]] = []
        self.texts: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag not in _VOID:
            named = self.css_class in (dict(attrs).get("class") or "").split()
            inside = bool(self.path) and self.path[-1][1]
            self.path.append((tag, inside or (tag == self.tag and named)))

    def handle_endtag(self, tag):
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i][0] == tag:
                del self.path[i:]
                return

    def handle_data(self, data):
        if self.path and self.path[-1] == (self.tag, True):
            self.texts.append(data)


def texts_inside(html: Column, tag: str, css_class: str) -> Column:
    """Direct text of ``tag`` elements at or below the ones with a class. Nesting is beyond a pattern, hence Python."""

    @F.pandas_udf("array<string>")
    def parse(pages: pd.Series) -> pd.Series:
        def texts(page):
            if page is None:
                return None
            region = _Region(tag, css_class)
            region.feed(page)
            return region.texts

        return pages.map(texts)

    return parse(html)


def _record(df: DataFrame, fields: dict[str, Column], province: Column) -> DataFrame:
    null = F.lit(None).cast("string")
    address = F.struct(
        null.alias("district"), fields["full_address"].alias("full_address"), province.alias("province"), null.alias("ward")
    )
    contact = F.struct(fields["name"].alias("name"), fields["phone"].alias("phone"))
    names = ("title", "description", "price", "square", "post_date", "post_id", "extra_infos")
    return df.select(
        *[fields[n].alias(n) for n in names],
        address.alias("address"), contact.alias("contact_info"), F.col("url").alias("link"),
    )


def spans_record(df: DataFrame, province: Column | None = None) -> DataFrame:
    """Records of the layout that lists attributes as items of two spans. ``df`` has ``url`` and ``html``."""
    html = F.col("html")
    lists = F.regexp_extract_all(html, F.lit("(?is)" + open_tag("ul", "list-attr-hot") + "(.*?)</ul>"), F.lit(1))
    items = lambda i: F.regexp_extract_all(F.get(lists, F.lit(i)), F.lit(r"(?is)<li\b[^>]*>(.*?)</li>"), F.lit(1))
    span = lambda i, css: first_text(F.get(items(0), F.lit(i)), open_tag("span", css) + "([^<]*)")
    crumbs = F.get(
        F.regexp_extract_all(html, F.lit("(?is)" + open_tag("ul", "breadcrumb") + "(.*?)</ul>"), F.lit(1)), F.lit(0)
    )
    texts = F.transform(items(1), lambda li: F.regexp_extract_all(li, F.lit(r"(?is)<span\b[^>]*>([^<]*)"), F.lit(1)))
    pairs = F.transform(
        F.filter(texts, lambda t: F.size(t) >= 2),
        lambda t: F.struct(unescape(F.get(t, F.lit(0))).alias("label"), unescape(F.get(t, F.lit(1))).alias("value")),
    )
    return _record(
        df,
        {
            "title": first_text(html, open_tag("h1", "title-product") + "([^<]*)"),
            "description": joined_lines(texts_inside(html, "div", "ct-pr-sum")),
            "price": span(0, "value-attr"),
            "square": span(1, "value-attr"),
            "post_date": span(2, "value-attr2"),
            "post_id": span(3, "value-attr2"),
            "full_address": F.when(
                crumbs.isNotNull(), breadcrumb_address(all_texts(crumbs, r"<li\b[^>]*>\s*<a\b[^>]*>([^<]*)"))
            ),
            "name": first_text(html, open_tag("span", "member-name") + "([^<]*)"),
            "phone": clean_phones(
                all_texts(html, r'<a\b[^>]*\bclass="[^"]*\bhotline-member-detail\b[^"]*"[^>]*\bhref="([^"]*)"')
            ),
            "extra_infos": last_value_map(pairs),
        },
        F.lit(None).cast("string") if province is None else province,
    )


def last_value_map(pairs: Column) -> Column:
    from listmill.functions.extras import pairs_to_map

    return pairs_to_map(F.coalesce(pairs, F.array().cast("array<struct<label:string,value:string>>")))


def lines_record(df: DataFrame, province: Column | None = None) -> DataFrame:
    """Records of the layout that lists attributes as ``label: value`` lines. ``df`` has ``url`` and ``html``."""
    html = F.col("html")
    parsed = df.withColumn("_rows", texts_inside(html, "div", "prop-features"))
    pairs = F.filter(
        F.transform(F.slice("_rows", 4, 1_000_000_000), label_value),
        lambda p: p.isNotNull() & ~F.contains(F.lower(p["label"]), F.lit(SKIPPED_WORD)),
    )
    named = F.array(*[F.lit(v) for v in FIELD_LABELS.values()])

    def field(name: str) -> Column:
        same = F.filter(F.col("_pairs"), lambda p: p["label"] == F.lit(FIELD_LABELS[name]))
        return F.get(F.reverse(same), F.lit(0))["value"]

    others = F.filter(F.col("_pairs"), lambda p: ~F.array_contains(named, p["label"]))
    return _record(
        parsed.withColumn("_pairs", pairs),
        {
            "title": first_text(html, open_tag("h1", "detail-prop-title") + r"(?:\s*<[^>]*>)*([^<]*)"),
            "description": first_text(html, open_tag("div", "prop-description") + r".*?<p\b[^>]*>([^<]*)"),
            "price": field("price"),
            "square": field("square"),
            "post_date": strip(F.get(F.split(field("post_date"), "-"), F.lit(0))),
            "post_id": field("post_id"),
            "full_address": first_text(html, open_tag("div", "prop-address") + r".*?<span\b[^>]*>([^<]*)"),
            "name": first_text(html, open_tag("div", "seller-info-header") + r".*?<h3\b[^>]*>([^<]*)"),
            "phone": F.transform(
                F.slice(all_texts(html, open_tag("span", "hide-phone") + "([^<]*)"), 1, 1), strip
            ),
            "extra_infos": last_value_map(others),
        },
        F.lit(None).cast("string") if province is None else province,
    )


def article_record(df: DataFrame) -> DataFrame:
    """Title and text of any article page: ``(page_title, title, description, link)``. All patterns run in the JVM."""
    html = F.col("html")
    body = F.regexp_extract(html, r"(?is)<article[^>]*>(.*?)</article>", 1)
    paragraphs = F.regexp_extract_all(body, F.lit(r"(?is)<p>(?:<b>)?([^<]+)"), F.lit(1))
    return df.select(
        *[c for c in df.columns if c not in ("html", "url")],
        first_text(html, r"<title[^>]*>([^<]*)").alias("page_title"),
        first_text(html, r"<h1[^>]*>([^<]*)").alias("title"),
        joined_lines(F.transform(paragraphs, unescape)).alias("description"),
        F.col("url").alias("link"),
    )


def absolute(base: Column, href: Column) -> Column:
    """``href`` as seen from ``base``."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(page == root, F.concat(root, F.lit("/"))).otherwise(F.regexp_extract(page, r"^(.*/)", 1))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, href))
        .when(href == "", base)
        .when(F.startswith(href, F.lit("?")), F.concat(page, href))
        .when(F.startswith(href, F.lit("#")), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .otherwise(F.concat(folder, href))
    )


def links(df: DataFrame, pattern: str = r'<a\b[^>]*\bhref="([^"]*)"') -> DataFrame:
    """Outgoing links of index pages, ``(keys, position, link)``; ``pattern`` narrows them to one kind of anchor."""
    hrefs = F.regexp_extract_all("html", F.lit("(?is)" + pattern), F.lit(1))
    found = df.select(*[c for c in df.columns if c != "html"], F.posexplode(hrefs).alias("position", "href"))
    return found.withColumn("link", absolute(F.col("url"), unescape(F.col("href")))).drop("href")


# anchors to listings on the index pages of the two layouts
SPANS_LISTING_LINK = r'<a\b[^>]*\bclass="[^"]*\btitle-item-nhadat\b[^"]*"[^>]*\bhref="([^"]*)"'
LINES_LISTING_LINK = r'<h4\b[^>]*>\s*<a\b[^>]*\bhref="([^"]*)"'
