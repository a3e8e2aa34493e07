"""Text of HTML elements as column expressions (H6, H7, H8).

No HTML parser runs per row. The contract for well-formed input is the
text of every ``<tag>`` element joined by newlines, inner tags stripped,
inline children (``<code>`` inside ``<p>``) kept. For malformed input:

1. comments, ``<script>`` and ``<style>`` blocks are dropped;
2. every start tag (``<p>`` or ``<p attr>``, never ``<pre>``) becomes a
   start mark; the closing tag, or (for ``p``) a closing or opening block
   tag, becomes an end mark, so an unclosed paragraph ends where the next
   block starts;
3. all other tags are removed;
4. the text is split at start marks; each piece is kept up to its first end
   mark, entities are decoded (``&amp;`` last) and pieces are joined by
   ``\\n``.

The same patterns run in Java regex and RE2 (no look-around).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

START = "\u0002"
END = "\u0003"

COMMENTS = r"<!--.*?-->"
SCRIPTS = r"<script[^>]*>.*?</script>"
STYLES = r"<style[^>]*>.*?</style>"
ANY_TAG = r"(?s)<[^>]*>"
# the three removals in one left-to-right pass: a comment, script or style
# block is dropped whole at whichever starts first
NOISE = "(?is)" + "|".join((COMMENTS, SCRIPTS, STYLES))

# fixed values: block elements whose closing tag ends an open paragraph
P_CLOSERS = (
    "p", "div", "article", "section", "body", "nav", "footer",
    "ul", "ol", "li", "table", "blockquote",
)
# fixed values: block elements whose opening tag ends an open paragraph
P_OPEN_CLOSERS = (
    "h1", "h2", "h3", "h4", "h5", "h6", "pre", "hr", "div", "ul", "ol",
    "table", "blockquote", "form", "header", "footer", "section", "article",
    "nav", "aside", "main",
)

# fixed values: entity decoding, ampersand last so '&amp;lt;' stays '&lt;'
ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def start_pattern(tag: str) -> str:
    return rf"(?i)<{tag}(\s[^>]*)?>"


def end_pattern(tag: str) -> str:
    if tag.lower() == "p":
        closers = "|".join(P_CLOSERS)
        openers = "|".join(P_OPEN_CLOSERS)
        return rf"(?i)</({closers})\s*>|<({openers})(\s[^>]*)?/?>"
    return rf"(?i)</{tag}\s*>"


def strip_noise(html) -> Column:
    return F.regexp_replace(_c(html), NOISE, "")


def decode_entities(text) -> Column:
    t = _c(text)
    for ent, ch in ENTITIES[:-1]:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    t = F.when(t.contains("&#"), _decode_references(t)).otherwise(t)
    return F.replace(t, F.lit(ENTITIES[-1][0]), F.lit(ENTITIES[-1][1]))


REFERENCE = "&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"


def _decode_references(t: Column) -> Column:
    """Numeric character references as characters; that of the ampersand last,
    so what it makes is not decoded again. Numbers that are no character stay."""

    def decoded(text, ref):
        body = F.regexp_extract(ref, REFERENCE, 1)
        is_hex = F.lower(F.substring(body, 1, 1)) == "x"
        number = F.when(is_hex, F.conv(F.substring(body, 2, 6), 16, 10)).otherwise(body).cast("bigint")
        ok = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number <= 0x10FFFF))
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        return F.when(ok, F.replace(text, ref, char)).otherwise(text)

    refs = F.array_distinct(F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(0)))
    is_amp = lambda r: F.lower(r).isin("&#38;", "&#x26;")
    ordered = F.concat(F.filter(refs, lambda r: ~is_amp(r)), F.filter(refs, is_amp))
    return F.aggregate(ordered, t, decoded)


def element_texts(html, tag: str) -> Column:
    """Array of the decoded texts of every ``tag`` element."""
    h = strip_noise(html)
    h = F.regexp_replace(h, start_pattern(tag), START)
    h = F.regexp_replace(h, end_pattern(tag), END)
    h = F.regexp_replace(h, ANY_TAG, "")
    pieces = F.split(h, START)
    body = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(body, lambda p: decode_entities(F.split(p, END).getItem(0)))


def element_text(html, tag: str = "p", null_if_none: bool = False) -> Column:
    """Texts of all ``tag`` elements joined by ``\\n`` (H6; H7 with
    ``null_if_none=True``: no element gives null, not '')."""
    texts = element_texts(html, tag)
    joined = F.array_join(texts, "\n")
    if null_if_none:
        return F.when(F.size(texts) > 0, joined)
    return F.when(_c(html).isNotNull(), joined)


def title_text(html) -> Column:
    """Decoded text of the first ``<title>``."""
    t = F.regexp_extract(_c(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return decode_entities(F.regexp_replace(t, ANY_TAG, ""))


def extract_columns(
    html: str = "body",
    tags: str | None = "tags",
    title: str | None = "title",
    paragraph_tag: str = "p",
    code_tag: str = "code",
) -> Sequence[Column]:
    """Column list of one post extraction (H8): title, paragraphs, tags
    (cleaned), codes. ``title=None`` takes the HTML ``<title>``."""
    from .text import clean_tags

    cols = [
        (F.col(title) if title else title_text(html)).alias("title"),
        element_text(html, paragraph_tag).alias("paragraphs"),
        (clean_tags(tags) if tags else F.lit(None).cast("string")).alias("tags"),
        element_text(html, code_tag, null_if_none=True).alias("codes"),
    ]
    return cols
