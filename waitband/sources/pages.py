"""Release-link discovery over a table of fetched pages.

``pages(page_id, url, html)`` -> one row per anchor whose text contains the
wanted label (case-insensitive), with the resolved URL, the file name and a
revision flag.  Anchors are found whatever their case and quoting, character
references are decoded and links resolved against the page's URL, all with
built-in functions: a page is processed inside its own task, without an HTML
parser or a driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_RELEASE_FILENAME, RELEASE_ANCHOR_TEXT

ANCHOR_RE = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)[^>]*>(.*?)</a\s*>"""
TAG_RE = r"<[^>]*>"
ORIGIN_RE = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)"
SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.-]*):"
MONTH_CODE_RE = r"\b((Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[0-9]{2})\b"
#: Named character references that turn up in links and labels; the ampersand last.
REFERENCES = (("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&#38;", "&"), ("&amp;", "&"))


def decoded(text: Column) -> Column:
    """Character references as the characters they stand for."""
    for name, char in REFERENCES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments taken out."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    start = F.array().cast("array<string>")
    kept = F.aggregate(parts, start, lambda a, s: F.when(s == ".", a).when(
        s == "..", F.when(F.size(a) > 1, F.slice(a, F.lit(1), F.size(a) - 1)).otherwise(a)).otherwise(F.concat(a, F.array(s))))
    ends = F.when(last.isin(".", ".."), "/").otherwise("")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.array_join(kept, "/"), ends)).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve ``href`` against the page URL: a link with a scheme (also
    ``mailto:`` and the like) is left alone; otherwise scheme-, root- or
    directory-relative, a query or a fragment alone, with dot segments removed."""
    origin = F.regexp_extract(base, ORIGIN_RE, 1)
    scheme = F.regexp_extract(base, SCHEME_RE, 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    base_dir = F.regexp_replace(F.substr(page, F.char_length(origin) + 1), r"[^/]*$", "")
    base_dir = F.when(base_dir == "", "/").otherwise(base_dir)
    path, tail = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    return (F.when(href.rlike(SCHEME_RE), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(path.startswith("/"), F.concat(origin, without_dots(path), tail))
            .when(path != "", F.concat(origin, without_dots(F.concat(base_dir, path)), tail))
            .when(tail.startswith("?"), F.concat(page, tail))
            .otherwise(F.concat(F.regexp_replace(base, r"#.*$", ""), tail)))


def anchors(pages: DataFrame) -> DataFrame:
    """All anchors: page_id, url, href, anchor_text (tags stripped, trimmed)."""
    hrefs = F.regexp_extract_all("html", F.lit(ANCHOR_RE), F.lit(1))
    texts = F.regexp_extract_all("html", F.lit(ANCHOR_RE), F.lit(2))
    z = pages.select("page_id", "url", F.posexplode(F.arrays_zip(hrefs.alias("h"), texts.alias("t"))).alias("pos", "a"))
    href = F.trim(F.regexp_replace("a.h", r"""^["']|["']$""", ""))
    return z.select("page_id", "url", F.col("pos").cast("bigint").alias("anchor_pos"), decoded(href).alias("href"),
                    F.trim(decoded(F.regexp_replace("a.t", TAG_RE, ""))).alias("anchor_text"))


def release_links(pages: DataFrame, label: str = RELEASE_ANCHOR_TEXT.replace("{code}", "").strip(),
                  default_filename: str = DEFAULT_RELEASE_FILENAME) -> DataFrame:
    """Anchors whose text contains ``label``; resolved link, file name (the last
    path segment if it is an archive, else the month's default name) and revision
    flag (text or file name mentions "revised")."""
    a = anchors(pages).filter(F.lower("anchor_text").contains(label.lower()))
    month = F.regexp_extract("anchor_text", MONTH_CODE_RE, 1)
    a = a.withColumn("month_code", month).withColumn("link", resolve_url(F.col("url"), F.col("href")))
    seg = F.element_at(F.split(F.regexp_replace("link", r"[?#].*$", ""), "/"), -1)
    fname = F.when(F.lower(seg).endswith(".zip"), seg).otherwise(F.replace(F.lit(default_filename), F.lit("{code}"), F.col("month_code")))
    return a.select("page_id", "anchor_pos", "anchor_text", "link", fname.alias("filename"),
                    (F.lower("anchor_text").contains("revised") | F.lower(fname).contains("revised")).alias("is_revised"), "month_code")
