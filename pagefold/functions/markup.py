"""Text elements of HTML, as expressions: no parser and no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagefold.functions.text import UNICODE_SPACE, strip

# Content that is never text, tags that separate elements, entities.
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
BLOCK_TAG = (
    r"(?i)</?(?:html|head|title|body|header|footer|main|nav|section|article|aside|address|div|p|"
    r"h[1-6]|ul|ol|li|dl|dt|dd|table|thead|tbody|tfoot|tr|td|th|caption|form|fieldset|blockquote|"
    r"pre|figure|figcaption|hr|br)\b[^>]*>"
)
ANY_TAG = r"<[^>]*>"
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def html_elements(html: Column) -> Column:
    """Non-blank texts between block tags, whitespace collapsed, entities resolved."""
    flat = F.regexp_replace(F.regexp_replace(html, HIDDEN, ""), f"{UNICODE_SPACE}+", " ")
    text = F.regexp_replace(F.regexp_replace(flat, BLOCK_TAG, "\n"), ANY_TAG, "")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda e: F.length(e) > 0)


def elements_text(elements: Column) -> Column:
    return F.array_join(elements, "\n\n")
