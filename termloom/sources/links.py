"""Links of HTML pages with their addresses resolved, in column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import let
from termloom.sources.shared import spread_rows

# An element with its attributes and content, one attribute, the parts of an address
# (RFC 3986, appendix B), and the character references that every document may use.
LINK = r"""(?is)<a(\s(?:[^>"']+|"[^"]*"|'[^']*')*)>(.*?)</a\s*>"""
ATTRIBUTE = r"""[^\s=/"'>]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
VALUE = r"""(?is)^href\s*=\s*(?:"([^"]*)"|'([^']*)'|(.*))$"""
ADDRESS = r"^(?:([^:/?#]+):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(?:#.*)?$"
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def decoded(text: Column) -> Column:
    for name, character in REFERENCES:
        text = F.replace(text, F.lit(name), F.lit(character))
    return text


def href_of(attributes: Column) -> Column:
    """The value of the first ``href`` among the attributes of a tag, in any quoting; null if there is none."""
    found = F.get(
        F.filter(
            F.regexp_extract_all(attributes, F.lit(ATTRIBUTE), F.lit(0)),
            lambda a: F.regexp_like(a, F.lit(VALUE)),
        ),
        F.lit(0),
    )
    value = F.concat(*(F.regexp_extract(found, VALUE, i) for i in (1, 2, 3)))
    return F.trim(decoded(value))


def _without_dots(path: Column) -> Column:
    """``path`` with its ``.`` and ``..`` segments carried out."""
    absolute = F.startswith(path, F.lit("/"))
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    none = F.array().cast("array<string>")
    kept = F.aggregate(
        parts,
        none,
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, part)),
    )
    open_end = F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0)
    return F.concat(
        F.when(absolute, F.lit("/")).otherwise(""),
        F.array_join(kept, "/"),
        F.when(open_end, F.lit("/")).otherwise(""),
    )


def _parts(address: Column) -> Column:
    """Scheme, authority with its slashes, path, query with its mark; absent ones are empty."""
    names = ("scheme", "authority", "path", "query")
    return F.struct(*(F.regexp_extract(address, ADDRESS, i + 1).alias(n) for i, n in enumerate(names)))


def resolved(page: Column, href: Column) -> Column:
    """The address that ``href`` means on a page (RFC 3986, 5.2), without its fragment."""

    def of(base: Column, link: Column) -> Column:
        own_scheme, own_authority = link["scheme"] != "", link["authority"] != ""
        folder = F.when((base["authority"] != "") & (base["path"] == ""), F.lit("/")).otherwise(
            F.regexp_replace(base["path"], "[^/]*$", "")
        )
        path = (
            F.when(own_scheme | own_authority | F.startswith(link["path"], F.lit("/")), _without_dots(link["path"]))
            .when(link["path"] == "", base["path"])
            .otherwise(_without_dots(F.concat(folder, link["path"])))
        )
        same_page = ~own_scheme & ~own_authority & (link["path"] == "") & (link["query"] == "")
        scheme = F.when(own_scheme, link["scheme"]).otherwise(base["scheme"])
        return F.concat(
            F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
            F.when(own_scheme | own_authority, link["authority"]).otherwise(base["authority"]),
            path,
            F.when(same_page, base["query"]).otherwise(link["query"]),
        )

    return let(_parts(page), lambda base: let(_parts(href), lambda link: of(base, link)))


def page_address(url: Column) -> Column:
    """The address by which links name a page."""
    return F.regexp_replace(url, "#.*$", "")


def link_source(pages: DataFrame) -> DataFrame:
    """``(page, href, target, anchor_text)``, one row per link of ``pages(url, html)``.

    Attributes come in any order and quoting; markup inside a link is left out of its text.
    Elements without an ``href`` are no links.
    """
    found = F.transform(
        F.regexp_extract_all("html", F.lit(LINK), F.lit(0)),
        lambda link: F.struct(
            href_of(F.regexp_extract(link, LINK, 1)).alias("href"),
            decoded(F.regexp_replace(F.regexp_extract(link, LINK, 2), "<[^>]*>", "")).alias("anchor_text"),
        ),
    )
    links = spread_rows(pages).select(page_address(F.col("url")).alias("page"), F.inline(found))
    target = resolved(F.col("page"), F.col("href")).alias("target")
    return links.filter(F.col("href").isNotNull()).select("page", "href", target, "anchor_text")
