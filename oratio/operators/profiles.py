"""Speaker profiles: search-hit choice, profile join, page extraction."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.tables import table
from .clean import is_politician

PROFILE_FIELDS = ["full_name", "birthday", "birth_place", "death_day", "death_place", "party"]
PROFILE_SCHEMA = "surname string, " + ", ".join(f"{f} string" for f in PROFILE_FIELDS)


def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search results over the driver tables: each document is a hit for its source, ranked by id,
    titled by its first sentence."""
    d = table(spark, sf_dir, "documents")
    first = T.first_sentence("text")
    return d.select(F.col("source").alias("surname"), F.col("doc_id").alias("rank"),
                    first.alias("title"), first.alias("first_sentence"))


def pick_page(hits: DataFrame) -> DataFrame:
    """Per surname the lowest-ranked hit whose first sentence passes F5.
    ``min_by`` aggregates partially map-side, so a surname with very many hits is cheap. ``html``
    is kept when the hits carry it; hits of one rank are told apart by their title and page."""
    page = [c for c in ("html",) if c in hits.columns]
    kept = F.struct("rank", "title", *page)
    return (hits.where(is_politician("first_sentence"))
                .groupBy("surname")
                .agg(F.min_by(kept, kept).alias("hit"))
                .select("surname", F.col("hit.rank").alias("page_rank"), F.col("hit.title").alias("title"),
                        *[F.col(f"hit.{c}").alias(c) for c in page]))


def add_profiles(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Left join of one profile row per surname. The join form is left to AQE: it broadcasts
    only from measured bytes and splits a surname that holds many speeches."""
    return df.join(profiles, "surname", "left")


def first_tag_text(html: Column, tag: str) -> Column:
    """Inner text of the first ``<tag …>…</tag>`` (empty when absent)."""
    return F.regexp_extract(html, rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1)


# ---- X3 infobox extraction -----------------------------------------------------------------

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Node:
    __slots__ = ("tag", "classes", "children", "parent")

    def __init__(self, tag, classes=(), parent=None):
        self.tag, self.classes, self.children, self.parent = tag, set(classes), [], parent

    def walk(self):
        """Strings and elements below this one in document order (an explicit stack: pages may nest deeply)."""
        stack = [iter(self.children)]
        while stack:
            c = next(stack[-1], None)
            if c is None:
                stack.pop()
                continue
            yield c
            if not isinstance(c, str):
                stack.append(iter(c.children))

    def text(self) -> str:
        return "".join(c for c in self.walk() if isinstance(c, str))

    def iter(self):
        return (c for c in self.walk() if not isinstance(c, str))

    def find(self, tag, cls=None):
        return next((n for n in self.iter() if n.tag == tag and (cls is None or cls in n.classes)), None)

    def find_all(self, tag):
        return [n for n in self.iter() if n.tag == tag]

    def next_string(self):
        """The next sibling that is a text node (element siblings are skipped)."""
        sib = self.parent.children
        i = next(k for k, c in enumerate(sib) if c is self)
        return next((c for c in sib[i + 1:] if isinstance(c, str)), None)


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root")
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        cls = next((v for k, v in attrs if k == "class"), None) or ""
        node = _Node(tag, cls.split(), self.cur)
        self.cur.children.append(node)
        if tag not in _VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        cls = next((v for k, v in attrs if k == "class"), None) or ""
        self.cur.children.append(_Node(tag, cls.split(), self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def _place(row) -> str | None:
    a = row.find("a")
    if a is not None:
        s = a.next_string()
        if s is not None:
            return a.text() + s
    br = row.find("br")
    if br is not None:
        s = br.next_string()
        if s is not None:
            return s
    return None


def parse_profile(html: str | None) -> tuple:
    """Six profile fields from one page: name, birthday and party default to ``N/A``, death
    fields to null; a page without an infobox gives nulls (never an error)."""
    if not html:
        return (None,) * 6
    b = _TreeBuilder()
    try:
        b.feed(html)
        b.close()
    except Exception:
        return (None,) * 6
    root = b.root
    box = next((n for n in root.iter() if n.tag == "table" and "infobox" in n.classes), None)
    if box is None:
        return (None,) * 6
    rows = box.find_all("tr")

    def first_row(word):
        return next((r for r in rows if word in r.text()), None)

    nick = root.find("div", "nickname")
    name = (nick.text() if nick is not None else "") or "N/A"
    bday = root.find("span", "bday")
    birthday = (bday.text() if bday is not None else "") or "N/A"
    born = first_row("Born")
    birth_place = (_place(born) if born is not None else None) or "N/A"
    died = first_row("Died")
    death_day = None
    death_place = None
    if died is not None:
        span = died.find("span")
        t = span.text() if span is not None else ""
        death_day = t[1:-1] if t else None
        death_place = _place(died) or None
    party_row = first_row("Political party")
    a = party_row.find("a") if party_row is not None else None
    party = (a.text() if a is not None else "") or "N/A"
    return name, birthday, birth_place, death_day, death_place, party


def _extract_batches(it):
    for pdf in it:
        vals = [parse_profile(h) for h in pdf["html"]]
        out = pd.DataFrame(vals, columns=PROFILE_FIELDS) if vals else pd.DataFrame(columns=PROFILE_FIELDS)
        out.insert(0, "surname", pdf["surname"].values)
        yield out


def extract_profiles(pages: DataFrame) -> DataFrame:
    """(surname, html) -> one profile row per page. Arrow-batched Python over the pages'
    partitions (an HTML tree is not expressible with SQL functions); no shuffle. The Python stage
    sees markup only where the page mentions an infobox; other pages give nulls without being parsed."""
    html = F.when(F.contains("html", F.lit("infobox")), F.col("html")).alias("html")
    return pages.select("surname", html).mapInPandas(_extract_batches, PROFILE_SCHEMA)


def profiles_of_pages(pages: DataFrame) -> DataFrame:
    """J2 then X3: ``pages`` (surname, rank, title, first_sentence, html) -> one profile row per surname, read
    from the page that J2 picks; only picked pages are parsed. A surname without a page that
    passes F5 has no row (its profile columns become null in J1)."""
    return extract_profiles(pick_page(pages))
