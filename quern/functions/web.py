"""Signals and identifiers in web pages. Patterns run in the JVM; only tree-shaped work is in Arrow-batched Python."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from . import net, text

# Mail pattern and the file extensions whose matches are no addresses.
EMAIL = r"([\w.+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24})"
ASSET_EXTENSIONS = "png jpg jpeg gif svg webp avif ico bmp css js mjs json map woff ttf otf eot mp4 webm mov mp3 wav pdf zip gz html htm php".split()

# Hosts of social platforms.
SOCIAL_HOSTS = {
    "facebook.com": "facebook", "fb.com": "facebook", "twitter.com": "twitter", "x.com": "twitter", "linkedin.com": "linkedin", "instagram.com": "instagram",
    "youtube.com": "youtube", "youtu.be": "youtube", "tiktok.com": "tiktok", "pinterest.com": "pinterest", "github.com": "github",
}

# Shapes of analytics and advertising account ids.
TRACKERS = {
    "ga": r"\b(G-[A-Z0-9]{6,12})\b",
    "ua": r"\b(UA-\d{4,10}-\d{1,3})\b",
    "gtm": r"\b(GTM-[A-Z0-9]{4,8})\b",
    "adsense": r"\b(ca-pub-\d{10,20})\b",
    "fb_pixel": r"""fbq\(\s*['"]init['"]\s*,\s*['"](\d{10,20})['"]""",
    "hotjar": r"hjid\s*[:=]\s*(\d{5,9})",
    "linkedin_insight": r"""_linkedin_partner_id\s*=\s*["'](\d{4,10})["']""",
    "yandex_metrika": r"ym\(\s*(\d{5,9})\s*,",
    "mixpanel": r"""mixpanel\.init\(\s*["']([a-f0-9]{32})["']""",
    "tiktok_pixel": r"""ttq\.load\(\s*['"]([A-Z0-9]{15,25})['"]""",
    "pinterest_tag": r"""pintrk\(\s*['"]load['"]\s*,\s*['"](\d{10,20})['"]""",
    "snap_pixel": r"""snaptr\(\s*['"]init['"]\s*,\s*['"]([0-9a-f-]{36})['"]""",
    "segment": r"""analytics\.load\(\s*["']([A-Za-z0-9]{10,40})["']""",
    "clarity": r"clarity\.ms/tag/([a-z0-9]{8,15})",
}

# Page-type patterns in order of precedence.
PAGE_SIGNALS = [
    ("for_sale", r"\bbuy this domain\b"), ("for_sale", r"\bpurchase this domain\b"), ("for_sale", r"this domain (?:is|may be|could be) for sale"),
    ("for_sale", r"\bdomain(?: name)? is for sale\b"), ("for_sale", r"the domain .{0,60}? is for sale"), ("for_sale", r"\bthis domain has expired\b"), ("for_sale", r"\binterested in this domain\b"),
    ("parking_provider", r"\bsedoparking\b"), ("parking_provider", r"\bparkingcrew\b"), ("parking_provider", r"\bafternic\b"), ("parking_provider", r"\bhugedomains\b"), ("parking_provider", r"\bcashparking\b"),
    ("parking_provider", r"this (?:web ?)?page is parked"), ("parking_provider", r"\bthis domain (?:is )?parked\b"), ("parking_provider", r"\bparked free\b"), ("parking_provider", r"\bdomain parking\b"),
    ("parking_provider", r"\bparked by (?:the )?(?:domain|registrant|owner)\b"),
    ("under_construction", r"\bunder construction\b"), ("under_construction", r"\bwebsite coming soon\b"),
    ("default_server", r"\bwelcome to nginx\b"), ("default_server", r"apache2?.{0,30}default page"), ("default_server", r"\btest page for the (?:apache|nginx)\b"), ("default_server", r"\bapache http server test page\b"),
    ("default_server", r"\b(?:iis windows server|iisstart|internet information services)\b"), ("default_server", r"\bsite not configured\b"), ("default_server", r"\bno (?:web)?site (?:is )?configured\b"),
    ("default_server", r"\byour new website is ready\b"), ("default_server", r"\bweb server'?s default (?:web ?)?page\b"),
    ("directory_listing", r"\bindex of /\S*.{0,120}(?:parent directory|last modified)"),
]


def all_matches(s: Column, pattern: str) -> Column:
    return F.regexp_extract_all(s, F.lit(pattern), F.lit(1))


def emails(s: Column) -> Column:
    """Addresses in order of first appearance, without file names that look like them."""
    extension = lambda m: F.lower(F.element_at(F.split(m, r"\."), -1))
    return F.array_distinct(F.filter(all_matches(s, EMAIL), lambda m: ~extension(m).isin(ASSET_EXTENSIONS)))


def links(html: Column) -> Column:
    """Targets of links, quoted or not, with the character references that addresses are written with."""
    decoded = lambda h: F.regexp_replace(F.regexp_replace(F.regexp_replace(h, "(?i)&(?:#x2f|#47|sol);", "/"), "(?i)&(?:#x3a|#58|colon);", ":"), "&amp;", "&")
    found = all_matches(html, r"""(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
    return F.transform(found, lambda h: F.trim(decoded(F.regexp_replace(h, "^[\"']|[\"']$", ""))))


def socials(html: Column) -> Column:
    """Platforms that links lead to, in order of name."""
    def platform(link: Column) -> Column:
        host = net.host_of(link)
        found = F.lit(None).cast("string")
        for known, label in SOCIAL_HOSTS.items():
            found = F.when(net.under(host, F.lit(known)), label).otherwise(found)
        return found

    return F.array_sort(F.array_distinct(F.array_compact(F.transform(links(html), platform))))


def trackers(html: Column) -> Column:
    """Array of (kind, value), each once."""
    def named(kind: str) -> Callable[[Column], Column]:
        return lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))

    return F.flatten(F.array(*[F.transform(F.array_distinct(all_matches(html, p)), named(k)) for k, p in TRACKERS.items()]))


def leis(s: Column) -> Column:
    """Array of (value, valid, source): claimed ones in any case, bare tokens only with the right checksum."""
    claimed = F.array_distinct(F.transform(all_matches(s, r'(?i)"lei(?:Code)?"\s*:\s*"([A-Za-z0-9]{20})"'), lambda m: F.upper(m)))
    bare = F.array_distinct(F.filter(all_matches(s, r"\b([A-Z0-9]{18}[0-9]{2})\b"), text.valid_lei))
    one = lambda source: lambda v: F.struct(v.alias("value"), text.valid_lei(v).alias("valid"), F.lit(source).alias("source"))
    return F.concat(F.transform(claimed, one("jsonld")), F.transform(F.array_except(bare, claimed), one("text")))


def vats(s: Column) -> Column:
    codes = "|".join(sorted(text.VAT_FORMATS))
    return F.array_distinct(F.filter(all_matches(s, rf"\b((?:{codes})[A-Z0-9]{{2,13}})\b"), text.valid_vat))


# Calling codes by country.
CALLING_CODES = {"us": "1", "ca": "1", "fr": "33", "es": "34", "it": "39", "uk": "44", "gb": "44", "dk": "45", "se": "46", "no": "47", "pl": "48", "de": "49", "br": "55", "fi": "358", "lv": "371", "ee": "372", "nl": "31", "be": "32", "ch": "41", "at": "43"}


def phone(raw: Column, domain: Column) -> Column:
    """+ and digits, the country taken from the domain's last label for national forms; what can't be a number is only trimmed."""
    plain = F.trim(raw)
    number = F.regexp_replace(plain, r"[^0-9]", "")
    code = F.element_at(F.create_map(*[F.lit(x) for kv in CALLING_CODES.items() for x in kv]), F.lower(F.element_at(F.split(domain, r"\."), -1)))
    national = F.concat(F.lit("+"), code, F.regexp_replace(number, "^0+", ""))
    fits = F.length(number).between(7, 15) & plain.rlike(r"^[+0-9 ().\-/]+$")
    return F.when(fits & plain.startswith("+"), F.concat(F.lit("+"), number)).when(fits & plain.startswith("00"), F.concat(F.lit("+"), F.substring(number, 3, 20))).when(fits & code.isNotNull(), national).otherwise(plain)


def page_signal(s: Column, most: int = 8000) -> Column:
    """The first page type whose pattern occurs in the first `most` characters; empty if none."""
    head = F.left(s, F.lit(most))
    out = F.lit("")
    for label, pattern in reversed(PAGE_SIGNALS):
        out = F.when(head.rlike(f"(?is){pattern}"), label).otherwise(out)
    return out


def gated(s: Column, literal: str, pattern: str) -> Column:
    """A pattern tried only where the literal that any match must have occurs."""
    return F.contains(s, F.lit(literal)) & s.rlike(pattern)


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.skip, self.texts = 0, []
        self.title, self.metas, self.canonical, self.hreflang, self.charset, self.jsonld = None, {}, None, [], None, []
        self.inside, self.buffer = None, []

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag in ("script", "style"):
            self.skip += 1
        if tag == "script" and a.get("type", "").strip().lower() == "application/ld+json":
            self.inside, self.buffer = "jsonld", []
        elif tag == "title" and self.title is None:
            self.inside, self.buffer = "title", []
        elif tag == "meta":
            name = (a.get("name") or a.get("property") or a.get("http-equiv") or "").strip().lower()
            if name and name not in self.metas:
                self.metas[name] = a.get("content", "").strip()
            if a.get("charset") and self.charset is None:
                self.charset = a["charset"].strip().lower()
        elif tag == "link":
            rel = a.get("rel", "").lower().split()
            if "canonical" in rel and self.canonical is None:
                self.canonical = a.get("href", "").strip()
            if "alternate" in rel and a.get("hreflang"):
                self.hreflang.append(a["hreflang"].strip().lower())

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        if self.inside == "title" and tag == "title":
            self.title, self.inside = "".join(self.buffer).strip(), None
        elif self.inside == "jsonld" and tag == "script":
            self.jsonld.append("".join(self.buffer))
            self.inside = None

    def handle_data(self, data):
        if self.inside:
            self.buffer.append(data)
        if not self.skip and data.strip():
            self.texts.append(data.strip())


def _parsed(html: str | None) -> _Page:
    page = _Page()
    page.feed(html or "")
    page.close()
    return page


@pandas_udf(T.StringType())
def visible_text(pages: pd.Series) -> pd.Series:
    """Trimmed text nodes outside scripts and styles, joined by spaces."""
    return pages.map(lambda h: " ".join(_parsed(h).texts))


_BESIDE = frozenset("nav footer aside header form".split())


class _Main(_Page):
    def __init__(self) -> None:
        super().__init__()
        self.beside = 0

    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, attrs)
        self.beside += tag in _BESIDE

    def handle_endtag(self, tag):
        super().handle_endtag(tag)
        self.beside = max(0, self.beside - (tag in _BESIDE))

    def handle_data(self, data):
        if not self.beside and self.inside != "title":
            super().handle_data(data)


@pandas_udf(T.StringType())
def content_text(pages: pd.Series) -> pd.Series:
    """Visible text outside navigation, headers, footers, asides and forms; all visible text if nothing is left."""
    def main(html: str | None) -> str:
        page = _Main()
        page.feed(html or "")
        page.close()
        return " ".join(page.texts) or " ".join(_parsed(html).texts)

    return pages.map(main)


_TEXTS = T.ArrayType(T.StringType())


def closed_references(html: Column) -> Column:
    """The page with each ampersand that starts no character reference closed by a semicolon written as a reference, so
    that parsers read it as it stands."""
    return F.regexp_replace(html, "&(?!#?[0-9A-Za-z]+;)", "&amp;")


@pandas_udf(T.StructType([T.StructField(n, _TEXTS if n == "hreflang" else T.StringType()) for n in ("title", "description", "canonical", "hreflang", "charset")]))
def head_metadata(pages: pd.Series) -> pd.DataFrame:
    rows = []
    for html in pages:
        p = _parsed(html)
        rows.append((p.title or "", p.metas.get("description", ""), p.canonical or "", p.hreflang, p.charset or ""))
    return pd.DataFrame(rows, columns=["title", "description", "canonical", "hreflang", "charset"])


# What names an organisation in a schema.org type, and the types that do without it.
_NAMES_ORGANISATION = re.compile(r"organization|localbusiness|corporation|\bngo\b|store|restaurant|\bcompany\b")
_LOCAL_BUSINESS = frozenset(
    "animalshelter automotivebusiness childcare dentist drycleaningorlaundry emergencyservice employmentagency entertainmentbusiness financialservice foodestablishment governmentoffice healthandbeautybusiness "
    "homeandconstructionbusiness internetcafe legalservice library lodgingbusiness medicalbusiness professionalservice radiostation realestateagent recyclingcenter selfstorage shoppingcenter sportsactivitylocation "
    "televisionstation touristinformationcenter travelagency autobodyshop autodealer autorental autorepair autowash gasstation motorcycledealer motorcyclerepair adultentertainment amusementpark artgallery casino comedyclub "
    "movietheater nightclub accountingservice bankorcreditunion insuranceagency bakery barorpub brewery cafeorcoffeeshop distillery icecreamshop winery beautysalon dayspa hairsalon healthclub nailsalon tattooparlor electrician "
    "generalcontractor hvacbusiness housepainter locksmith movingcompany plumber roofingcontractor attorney notary bedandbreakfast campground hostel hotel motel resort dermatology hospital medicalclinic optician pharmacy "
    "physician physiotherapy veterinarycare bowlingalley exercisegym golfcourse publicswimmingpool skiresort sportsclub stadiumorarena tenniscomplex florist hobbyshop pawnshop tireshop airline consortium collegeoruniversity "
    "school elementaryschool highschool middleschool preschool newsmediaorganization onlinebusiness sportsteam workersunion".split()
)


def _entities(document: str) -> list[dict]:
    try:
        todo = [("", json.loads(document))]
    except ValueError:
        return []
    out = []
    while todo:
        path, node = todo.pop()
        if isinstance(node, dict):
            kinds = node.get("@type")
            kinds = [k for k in (kinds if isinstance(kinds, list) else [kinds]) if isinstance(k, str)]
            if kinds or isinstance(node.get("@id"), str):
                plain = [k.rstrip("/").replace("#", "/").rsplit("/", 1)[-1].lower() for k in kinds]
                name = node.get("name")
                out.append({"path": path, "id": node.get("@id") if isinstance(node.get("@id"), str) else "", "types": kinds, "name": name if isinstance(name, str) else "", "organization": any(_NAMES_ORGANISATION.search(k) is not None or k in _LOCAL_BUSINESS for k in plain)})
            todo += [(f"{path}/{k.replace('~', '~0').replace('/', '~1')}", node[k]) for k in sorted(node, reverse=True) if k != "@context"]
        elif isinstance(node, list):
            todo += [(f"{path}/{k}", v) for k, v in reversed(list(enumerate(node)))]
    return out


_ENTITY = T.StructType([T.StructField("path", T.StringType()), T.StructField("id", T.StringType()), T.StructField("types", _TEXTS), T.StructField("name", T.StringType()), T.StructField("organization", T.BooleanType())])


@pandas_udf(T.ArrayType(_ENTITY))
def jsonld_entities(pages: pd.Series) -> pd.Series:
    """Typed or identified nodes of all JSON-LD blocks with their RFC 6901 paths, keys in order, contexts passed over."""
    return pages.map(lambda h: [e for block in _parsed(h).jsonld for e in _entities(block)])
